"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.llm import language, mixing, near_duplicates, negatives, neighbours, ordinal, packing, periodic, pitman_yor
from vitalis.llm import pseudonyms, repair, repeats, sketches
from vitalis.llm.common import WORD
from vitalis.session import scratch_path

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_repair_grammar")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "grammar")
    repair.write_grammar(_documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return repair.read_digests(spark, path)


@query("op2_budget_mix")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir))


LEAST_GOOD = 0.5  # probability of the best grade that a kept document has at least


def grade_of_labels() -> Column:
    """Grades of labelled documents: 0 toxic, 1 poor, 2 good; null without a label."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)


def graded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> ordinal.Ordinal:
    return ordinal.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), grade_of_labels(), classes=3)


@query("op3_ordinal_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier selects, with their grade and tail probability."""
    docs = _documents(spark, sf_dir)
    return ordinal.grade(docs, graded(spark, docs, sf_dir), at_least=2, least_tail=LEAST_GOOD)


NEAREST_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    list_reduce(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op4_block_matrix_join", NEAREST_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.nearest(vectors, F.col("id") % 20 == 0, k=20)


@query("op5_block_anchors")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_documents(spark, sf_dir), digest=True)


@query("op6_pitman_yor")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(_documents(spark, sf_dir))


@query("op7_bbit_minhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_documents(spark, sf_dir))


#: The demonstration key; a deployment passes its own secret.
PSEUDONYM_KEY = b"vitalis demonstration key"


@query("op8_feistel_pseudonyms")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.digests(_documents(spark, sf_dir), PSEUDONYM_KEY)


@query("op9_bounded_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query("op10_invertible_sketches")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(_documents(spark, sf_dir), pieces=True)


NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.e, r.e), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id AND len(a.e) = len(r.e)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


@query("op11_lemp_negatives", NEGATIVES_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", negatives.whole("embedding").alias("vector"), label.alias("label"))
    return negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def _id_crc(column: str) -> Column:
    """crc32 of the decimal id; 0 (that of no characters) for null."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


@query("op12_bayes_languages")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = language.learn(docs, _id_crc("id") % 4 != 2)
    held_out = (_id_crc("doc_id") % 4 == 2).alias("held_out")
    return language.identify(docs, model).select("doc_id", held_out, "lang_pred", "score")


def with_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): documents whose id's hash ends in 0 repeat a stretch of their words to the end. A null id changes nothing."""
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))

    def altered(words: Column) -> Column:
        n, g = F.size(words), F.floor(_id_crc("doc_id") / 10).cast("long")
        a = F.pmod(g, n).cast("int")
        period = (F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1).cast("int")
        again = F.transform(F.sequence(F.lit(0), n - a - 1), lambda k: F.get(words, a + F.pmod(k, period)))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " "))

    once = F.element_at(F.transform(F.array(words), altered), 1)  # a lambda's argument is computed once
    chosen = F.col("doc_id").isNotNull() & (_id_crc("doc_id") % 10 == 0)
    return docs.select("doc_id", F.when(chosen, once).otherwise(F.col("text")).alias("text"))


@query("op13_automaton_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_periods(_documents(spark, sf_dir)))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("longest", longest)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.s")).alias("start"), F.col("longest.l").alias("length"),
        (-F.col("longest.p")).alias("period"), F.expr("1000 * longest.l DIV -longest.p").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
