"""The corpus pipeline: graded documents, one of each near-duplicate group, pseudonyms, a mix, packs.

Every stage reads all that the one before kept. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.llm import mixing, near_duplicates, ordinal, packing, pseudonyms, queries
from vitalis.llm.common import small_batches, stage, word_count


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are of the best grade with probability 1/2 or more. Nulls count as empty
    texts; all rows and columns that stay are unchanged."""
    model = queries.graded(spark, docs, sf_dir)
    columns = docs.columns
    graded = docs.withColumn("__place", F.col("doc_id"))
    chosen = ordinal.grade(graded, model, at_least=2, id_col="__place", keep=columns, least_tail=queries.LEAST_GOOD)
    return small_batches(chosen.select(*(F.col(f"`{c}`") for c in columns)), "graded")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest id. Rows without id and texts without words stay.

    Texts that share an id are documents of their own: each stays unless its own text is linked, ties going to
    the smaller hash of the text. Of rows with one id and one text the first in JSON order stays.
    """
    repeated = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    repeated = stage(repeated.select("doc_id", F.lit(True).alias("__again")), "repeated-ids")
    own = F.xxhash64("doc_id", "text").bitwiseOR(F.lit(-(2**63)))  # negative, for the texts of repeated ids only
    marked = docs.join(repeated, "doc_id", "left").withColumn("__own", F.when(F.col("__again"), own).otherwise(F.col("doc_id")))
    found = near_duplicates.near_duplicates(marked.select("__own", "text"), "__own").filter("__own IS NOT NULL")
    names = marked.filter("__again").select("__own", F.col("doc_id").alias("__name")).distinct()
    place = F.struct(F.coalesce("__name", "__own").alias("name"), F.col("__own").alias("own"))
    found = stage(found.join(names, "__own", "left").select("__own", "component_id", place.alias("__place")), "named-components")
    first = found.groupBy("component_id").agg(F.min("__place").alias("__first"))
    gone = stage(found.join(first, "component_id").filter("__place <> __first").select("__own"), "linked-documents")
    left = marked.join(gone, "__own", "left_anti")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    wordless = F.coalesce(word_count("text") == 0, F.lit(True))
    plain = left.filter(F.col("__again").isNull() | wordless).select(*columns)
    row = F.struct(*columns)
    once = left.filter(F.col("__again") & ~wordless).groupBy("__own").agg(F.min_by(row, F.to_json(row)).alias("__row"))
    return plain.unionByName(once.select(*(F.col(f"__row.`{c}`") for c in docs.columns)))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, its text with personal data permuted; null texts stay null."""
    return small_batches(pseudonyms.pseudonymise(docs, queries.PSEUDONYM_KEY), "pseudonyms")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Rows that share an id (null included) are taken
    equally often; documents without words are in no budget and go."""
    copies = mixing.mix(docs).groupBy("doc_id").agg(F.max("copies").alias("__copies")).filter("__copies > 0")
    copies = copies.withColumnRenamed("doc_id", "__doc_id")
    taken = docs.join(copies, F.col("doc_id").eqNullSafe(F.col("__doc_id")))
    return taken.select(*(F.col(f"`{c}`") for c in docs.columns), F.explode(F.sequence(F.lit(1), "__copies"))).drop("col")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2,048 ids."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality", select_quality),
    ("near_duplicates", drop_near_duplicates),
    ("pseudonyms", hide_personal_data),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: SQL can't state the classifier's fit, the hashes and the tokenizer; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what one returns is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
