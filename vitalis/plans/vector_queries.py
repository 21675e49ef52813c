"""Vector search, nearest-neighbour models and class re-balancing over the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalis.operators import ivf, splits, vectors
from vitalis.plans.core_queries import rounded
from vitalis.plans.registry import query, table
from vitalis.session import durable, scratch_path


def checksum(vector: str):
    """A position-weighted sum that two equal vectors share."""
    terms = F.transform(vector, lambda x, i: x.cast("double") * (i + 1))
    return F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)


@query(
    "vector_add",
    """
    select concat('id', vec_id) as id, concat('topic ', label) as document, cast(label as varchar) as topic,
           round(list_sum([cast(cast(x / n as float) as double) * i for x, i in e]), 3) as checksum
    from (select *, cast(embedding as double[]) as e, sqrt(list_sum([x * x for x in cast(embedding as double[])])) as n from embeddings)
    """,
)
def vector_add(spark, d):
    store = vectors.VectorTable(spark, scratch_path(spark, "vectors"))
    store.create("topics")
    rows = table(spark, d, "embeddings").select(
        F.concat(F.lit("id"), "vec_id").alias("id"),
        F.concat(F.lit("topic "), "label").alias("document"),
        F.create_map(F.lit("topic"), F.col("label").cast("string")).alias("metadata"),
        "embedding",
    )
    store.add("topics", rows)
    return store.vectors("topics").select(
        "id", "document", F.element_at("metadata", F.lit("topic")).alias("topic"), F.round(checksum("embedding"), 3).alias("checksum")
    )


_PAIRS_SQL = """
select q.vec_id as query_id, v.vec_id as id, v.label,
       round(list_inner_product(cast(q.embedding as double[]), cast(v.embedding as double[])), 9) as score
from embeddings q, embeddings v where q.vec_id % 20 = 0 and q.vec_id <> v.vec_id
"""


def _as_queries(df):
    """The stated query set: every vector whose id is divisible by 20 searches among all."""
    return df.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def _as_vectors(df):
    return df.select(F.col("vec_id").alias("id"), "embedding", F.create_map(F.lit("topic"), F.col("label").cast("string")).alias("metadata"))


@query(
    "vector_topk",
    f"""
    select query_id, id, cast(rank as integer) as rank, round(score, 5) + 0.0 as score from
      (select *, row_number() over (partition by query_id order by score desc, id) as rank from ({_PAIRS_SQL})) where rank <= 10
    """,
)
def vector_topk(spark, d):
    rows = table(spark, d, "embeddings")
    hits = vectors.search(_as_queries(rows), _as_vectors(rows), 10, skip_same=True)
    return rounded(hits, 5, "score")


@query(
    "vector_topk_filtered",
    f"""
    select query_id, id, cast(rank as integer) as rank, round(score, 5) + 0.0 as score from
      (select *, row_number() over (partition by query_id order by score desc, id) as rank from ({_PAIRS_SQL}) where label = 3) where rank <= 10
    """,
)
def vector_topk_filtered(spark, d):
    rows = table(spark, d, "embeddings")
    hits = vectors.search(_as_queries(rows), _as_vectors(rows), 10, where={"topic": "3"}, skip_same=True)
    return rounded(hits, 5, "score")


@query("vector_topk_ivf")
def vector_topk_ivf(spark, d):
    """Approximate neighbours of the query set from an inverted file, with the recall measured when it was tuned."""
    rows = table(spark, d, "embeddings")
    index = ivf.IvfIndex.build(_as_vectors(rows)).tune(10)
    return index.search(_as_queries(rows), 10, skip_same=True).withColumn("measured_recall", F.lit(index.recall))


@query(
    "vector_ivf_recall",
    """
    select count(*) as n_hits, true as reaches_recall, true as scores_are_exact from
      (select q.vec_id, row_number() over (partition by q.vec_id order by v.vec_id) as r from embeddings q, embeddings v
       where q.vec_id % 20 = 0 and q.vec_id <> v.vec_id) where r <= 10
    """,
)
def vector_ivf_recall(spark, d):
    """Against the exact search over the whole query set: 0.9 of the true neighbours, and the same scores."""
    rows = table(spark, d, "embeddings")
    found = durable(ivf.IvfIndex.build(_as_vectors(rows)).tune(10).search(_as_queries(rows), 10, skip_same=True))
    exact = durable(vectors.search(_as_queries(rows), _as_vectors(rows), 10, skip_same=True))
    recall = ivf.recall_of(found, exact)
    both = found.join(exact.select("query_id", "id", F.col("score").alias("true_score")), ["query_id", "id"])
    same = both.agg(F.max(F.abs(F.col("score") - F.col("true_score")))).first()[0]
    return found.agg(F.count(F.lit(1)).alias("n_hits")).select(
        "n_hits", F.lit(bool(recall >= 0.9)).alias("reaches_recall"), F.lit(bool(same < 1e-6)).alias("scores_are_exact")
    )


@query("vector_topk_lsh")
def vector_topk_lsh(spark, d):
    """Approximate neighbours of the query set; recall against the exact search is tested."""
    rows = table(spark, d, "embeddings")
    dim = len(rows.select("embedding").first()[0])
    return rounded(vectors.search_approx(_as_queries(rows), _as_vectors(rows), 10, dim, tables=24, skip_same=True), 5, "score")


@query(
    "results_json",
    f"""
    select query_id, cast(count(*) as integer) as n_results, true as parses, min(id) as smallest_id from
      (select *, row_number() over (partition by query_id order by score desc, id) as rank from ({_PAIRS_SQL})) where rank <= 10 group by query_id
    """,
)
def results_json(spark, d):
    """One JSON text of ranked results per query, read back to check that it is whole."""
    hits = vector_topk(spark, d)
    ordered = F.array_sort(F.array_agg(F.struct("rank", "id", "score")))
    texts = hits.groupBy("query_id").agg(F.to_json(F.struct(ordered.alias("results"))).alias("json"))
    back = F.from_json("json", "results array<struct<rank:int,id:bigint,score:double>>")["results"]
    ids = F.transform(back, lambda h: h["id"])
    places = F.transform(back, lambda h: h["rank"])
    return texts.select(
        "query_id",
        F.size(back).alias("n_results"),
        (places == F.sequence(F.lit(1), F.size(back))).alias("parses"),
        F.array_min(ids).alias("smallest_id"),
    )


_NEAREST_SQL = """
with r as (select vec_id, label, cast(embedding as double[]) as e,
             cast(concat('0x', substr(md5(concat_ws('|', vec_id, 'knn')), 1, 8)) as bigint) % 10000 < 8000 as train from embeddings),
h as (select t.vec_id as id, n.vec_id as nid, n.label, round(list_distance(t.e, n.e) * list_distance(t.e, n.e), 9) as dist
      from r t, r n where not t.train and n.train),
votes as (select id, label, count(*) as votes from
            (select *, row_number() over (partition by id order by dist, nid) as rank from h) where rank <= 5 group by id, label)
"""


def _knn_sides(spark, d):
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    parts = splits.split(rows, ["id"], {"train": 0.8, "test": 0.2}, "knn")
    return parts.filter("split = 'train'"), parts.filter("split = 'test'")


@query(
    "knn_classify",
    f"""
    {_NEAREST_SQL} select id, label as prediction, votes from
      (select *, row_number() over (partition by id order by votes desc, label) as best from votes) where best = 1
    """,
)
def knn_classify(spark, d):
    return vectors.knn_classify(*_knn_sides(spark, d), 5)


@query("knn_proba", f"{_NEAREST_SQL} select id, label, votes / 5 as probability from votes")
def knn_proba(spark, d):
    return vectors.knn_proba(*_knn_sides(spark, d), 5)


@query(
    "smote_minority",
    """
    with sizes as (select label, count(*) as n from embeddings group by label),
    least as (select label, n from sizes order by n, label limit 1),
    need as (select n as n_min, (select max(n) from sizes) - n as need from least),
    m as (select vec_id as id, cast(embedding as double[]) as e from embeddings where label = (select label from least)),
    r as (select id, e, row_number() over (order by md5(concat_ws('|', id, 'smote')), id) as rn from m),
    c as (select id as base_id, e, unnest(range(cast(floor((need - rn + n_min) / n_min) as bigint))) as copy from r, need),
    p as (select *, cast(concat('0x', substr(md5(concat_ws('|', base_id, copy, 'smote-neighbour')), 1, 8)) as bigint) % 10000 % 5 + 1 as pick,
                 (cast(concat('0x', substr(md5(concat_ws('|', base_id, copy, 'smote-gap')), 1, 8)) as bigint) % 10000) / 10000.0::double as gap from c),
    h as (select a.id as base_id, b.id as neighbour_id, b.e as f, row_number() over (partition by a.id
            order by round(list_distance(a.e, b.e) * list_distance(a.e, b.e), 9), b.id) as rank from m a, m b where a.id <> b.id)
    select (select label from least) as label, p.base_id, cast(copy as integer) as copy, neighbour_id, gap,
           round(list_sum([(x[1] + gap * (x[2] - x[1])) * i for x, i in list_zip(e, f)]), 4) + 0.0 as checksum
    from p join h on p.base_id = h.base_id and p.pick = h.rank
    """,
)
def smote_minority(spark, d):
    made = vectors.smote(table(spark, d, "embeddings"), "vec_id", "label", "embedding")
    return made.select("label", "base_id", "copy", "neighbour_id", "gap", (F.round(checksum("embedding"), 4) + F.lit(0.0)).alias("checksum"))
