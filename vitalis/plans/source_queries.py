"""Sources, sinks, the run log and images, written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalis.functions.text import file_stem
from vitalis.operators import images
from vitalis.plans import ranks
from vitalis.plans.core_queries import rounded
from vitalis.plans.frames import FEATURES, LINE_KEY_SQL, activity, keyed_lines
from vitalis.plans.registry import query, table
from vitalis.plans.vector_queries import checksum
from vitalis.session import scratch_path
from vitalis.sources import files, tables
from vitalis.sources.runlog import RunLog


@query("src_csv", "select conv_id, turn, role, md5(text) as digest, length(text) as n_chars from conversations")
def src_csv(spark, d):
    """Quoted free text with commas, quotes and line breaks."""
    rows, path = table(spark, d, "conversations"), scratch_path(spark, "csv")
    tables.write_csv(rows, path, header=True, quote_all=True)
    back = tables.read_table(spark, path, rows.schema, line_breaks=True)
    return back.select("conv_id", "turn", "role", F.md5("text").alias("digest"), F.length("text").cast("bigint").alias("n_chars"))


@query("src_csv_semicolon", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def src_csv_semicolon(spark, d):
    rows, path = table(spark, d, "customer"), scratch_path(spark, "csv")
    tables.write_csv(rows, path, header=True, sep=";")
    return tables.read_table(spark, path, rows.schema, sep=";")


@query(
    "src_flat_vectors",
    """
    select cast(label as varchar) as label, count(*) as n, round(sum(embedding[1 + 8 * 2 + 5]), 4) as one_pixel, 8 as height, 8 as width
    from embeddings group by label
    """,
)
def src_flat_vectors(spark, d):
    """Flattened rows in compressed text below one folder per class, rebuilt to 8 x 8 x 1."""
    path = scratch_path(spark, "flat")
    flat = F.array_join(F.col("embedding").cast("array<string>"), ",")
    table(spark, d, "embeddings").select(flat.alias("value"), F.col("label").alias("class")).write.partitionBy("class").option(
        "compression", "gzip"
    ).text(path)
    rows = files.read_flat_vectors(spark, path, 8, 8, 1, partitions=8)
    shaped = rows.select("label", files.as_image("pixels", 8, 8, 1).alias("image"))
    return shaped.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("image")[2][5][0].cast("double")), 4).alias("one_pixel"),
        F.max(F.size("image")).alias("height"),
        F.max(F.size(F.col("image")[0])).alias("width"),
    )


@query(
    "src_entity_files",
    """
    select cast(user_id % 10 as varchar) as subject, case user_id % 3 when 0 then 'bike' when 1 then 'run' else 'walk' end as activity,
           event_id, value, row_number() over (partition by user_id % 10, user_id % 3 order by event_id) - 1 as seq from events
    """,
)
def src_entity_files(spark, d):
    """Folders named subject_activity; the sequence is made from a time-ordered key, never from file order."""
    path = scratch_path(spark, "entities")
    events = table(spark, d, "events")
    name = F.concat_ws("_", F.col("user_id") % 10, activity())
    events.select("event_id", "value", name.alias("entity")).write.partitionBy("entity").csv(path, header=True)
    rows = files.read_entity_files(spark, path, ["subject", "activity"], "event_id bigint, value double", by="folder")
    ranked = ranks.ordered_rank(rows.drop("block", "line"), ["subject", "activity"], "event_id", "event_id", "seq")
    return ranked.select("subject", "activity", "event_id", "value", "seq")


@query(
    "read_splits",
    """
    select split, count(*) as n, cast(sum(doc_id) as bigint) as key_sum from (select doc_id, case when cast(concat('0x', substr(md5(concat_ws('|', doc_id, 'parts')), 1, 8))
      as bigint) % 10000 < 8000 then 'train' else 'test' end as split from documents) group by split
    """,
)
def read_splits(spark, d):
    from vitalis.operators.splits import split

    path = scratch_path(spark, "splits")
    docs = split(table(spark, d, "documents"), ["doc_id"], {"train": 0.8, "test": 0.2}, "parts")
    docs.write.partitionBy("split").parquet(path)
    read = tables.read_splits(spark, {name: f"{path}/split={name}" for name in ("train", "test")})
    return read.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("key_sum"))


_NAMES = [f"f{i:02d}" for i in range(64)]


@query(
    "vector_to_columns",
    "select vec_id, label as target, " + ", ".join(f"embedding[{i + 1}] as {n}" for i, n in enumerate(_NAMES)) + " from embeddings",
)
def vector_to_columns(spark, d):
    rows = table(spark, d, "embeddings").withColumnRenamed("label", "target")
    return tables.vector_to_columns(rows, "embedding", _NAMES)


@query(
    "read_documents",
    """
    select doc_id, cast(p - 1 as integer) as page_no, md5(pages[p]) as digest from
      (select doc_id, string_split(text, chr(10)) as pages, unnest(range(1, len(string_split(text, chr(10))) + 1)) as p from documents)
    """,
)
def read_documents(spark, d):
    """Pages of each document; the line break stands in for the page mark."""
    pages = tables.split_pages(table(spark, d, "documents"), "doc_id", "text", mark="\n")
    return pages.select("doc_id", "page_no", F.md5("text").alias("digest"))


@query("sink_csv_roundtrip", f"select l_returnflag, {', '.join(FEATURES)}, {LINE_KEY_SQL} as row_key from lineitem")
def sink_csv_roundtrip(spark, d):
    path = scratch_path(spark, "csv")
    rows = keyed_lines(spark, d).select("l_returnflag", *FEATURES, "row_key")
    tables.write_csv(rows, path)
    return tables.read_table(spark, path, rows.schema, header=False)


@query("sink_training_set", f"select {LINE_KEY_SQL} as row_key, l_quantity, l_extendedprice, l_discount, l_tax from lineitem")
def sink_training_set(spark, d):
    base = scratch_path(spark, "sets")
    path = tables.write_training_set(keyed_lines(spark, d).select("row_key", *FEATURES), base, "price-model")
    return spark.read.parquet(path)


@query(
    "sink_vectors",
    "select vec_id, round(list_sum([x * i for x, i in cast(embedding as double[])]), 4) + 0.0 as checksum from embeddings",
)
def sink_vectors(spark, d):
    path = scratch_path(spark, "arrays")
    tables.write_vectors(table(spark, d, "embeddings").select("vec_id", "embedding"), path)
    return rounded(spark.read.parquet(path).select("vec_id", checksum("embedding").alias("checksum")), 4, "checksum")


@query(
    "run_log",
    """
    select cast(n_nationkey as varchar) as run_id, n_name as name, cast(count(*) as double) as n_customers, round(avg(c_acctbal), 4) as balance, true as ended
    from customer join nation on c_nationkey = n_nationkey group by n_nationkey, n_name
    """,
)
def run_log(spark, d):
    """One run per nation with a parameter and two metrics, read back wide."""
    log = RunLog(spark, scratch_path(spark, "runs"), "balances")
    people = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    runs = people.groupBy("n_nationkey", "n_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("c_acctbal"), 4).alias("b"))

    def entry(kind, key, value):
        return F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"), value.cast("string").alias("value"))

    parts = F.array(
        entry("param", "name", F.col("n_name")),
        entry("metric", "n_customers", F.col("n")),
        entry("metric", "balance", F.col("b")),
        entry("status", "ended", F.lit("true")),
    )
    log.log_frame(runs.select(F.col("n_nationkey").alias("run_id"), F.inline(parts)))
    return log.runs(params=("name",), metrics=("n_customers", "balance"))


def _pictures(spark, d):
    """Grey 8 x 8 pictures in Spark's image layout, made from the embeddings."""
    rows = table(spark, d, "embeddings")
    level = F.transform("embedding", lambda x: F.least(F.greatest(F.floor(x.cast("double") * 255 + 128), F.lit(0)), F.lit(255)))
    data = F.unhex(F.array_join(F.transform(level, lambda v: F.lpad(F.hex(v), 2, "0")), ""))
    origin = F.concat(F.lit("file:/pictures/"), F.col("label").cast("string"), F.lit("/"), F.col("vec_id").cast("string"), F.lit(".png"))
    image = F.struct(
        origin.alias("origin"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"),
        F.lit(0).alias("mode"), data.alias("data"),
    )
    return rows.select("vec_id", "label", origin.alias("origin"), image.alias("image"))


_LEVELS_SQL = "list_transform(cast(embedding as double[]), lambda x: least(greatest(floor(x * 255 + 128), 0), 255))"


@query(
    "image_manifest_join",
    """
    select p_partkey, p_brand as patient_id, p_size % 2 as mask, i.vec_id is not null as has_image, m.vec_id is not null as has_mask
    from part left join embeddings i on i.vec_id = p_partkey and i.label = p_partkey % 10
    left join embeddings m on m.vec_id = p_partkey + 1 and m.label = p_partkey % 10
    """,
)
def image_manifest_join(spark, d):
    folder = (F.col("p_partkey") % 10).cast("string")
    manifest = table(spark, d, "part").select(
        "p_partkey",
        F.col("p_brand").alias("patient_id"),
        (F.col("p_size") % 2).alias("mask"),
        F.concat_ws("/", folder, F.concat(F.col("p_partkey"), F.lit(".png"))).alias("image_path"),
        F.concat_ws("/", folder, F.concat(F.col("p_partkey") + 1, F.lit(".png"))).alias("mask_path"),
    )
    joined = files.join_manifest(manifest, _pictures(spark, d), ["image_path", "mask_path"], root="/pictures")
    return joined.select(
        "p_partkey", "patient_id", "mask", F.col("image_path_image").isNotNull().alias("has_image"), F.col("mask_path_image").isNotNull().alias("has_mask")
    )


@query(
    "image_ingest",
    f"""
    select vec_id, label as folder, vec_id % 50 = 0 as unreadable, case when vec_id % 50 <> 0 then 64 end as pixels,
           case when vec_id % 50 <> 0 then cast(list_sum({_LEVELS_SQL}) as bigint) end as brightness
    from (select vec_id, embedding, coalesce(cast(label as varchar), 'none') as label from embeddings)
    """,
)
def image_ingest(spark, d):
    """Every embedding as a PNG file in the folder of its label, one file in fifty cut short, read as an image folder."""
    folder = scratch_path(spark, "image-folder")
    grey = _pictures(spark, d).select(
        "vec_id", F.coalesce(F.col("label").cast("string"), F.lit("none")).alias("label"), F.col("image.data").alias("data"),
        (F.col("vec_id") % 50 == 0).alias("cut"),
    )
    paths = files.write_pngs(grey.select(F.concat_ws("/", "label", F.concat("vec_id", F.lit(".png"))).alias("path"), "data", "cut"), folder, 8, 8)
    rows = files.read_images(spark, paths)
    seen = F.col("image").isNotNull()
    data = F.hex("image.data")  # a grey picture may be read as three equal channels
    level = F.transform(
        F.sequence(F.lit(0), F.col("image.height") * F.col("image.width") - 1),
        lambda i: F.conv(F.substring(data, i * F.col("image.nChannels") * 2 + 1, F.lit(2)), 16, 10).cast("bigint"),
    )
    return rows.select(
        file_stem(F.col("origin")).cast(table(spark, d, "embeddings").schema["vec_id"].dataType).alias("vec_id"), F.col("label").alias("folder"),
        F.col("error").isNotNull().alias("unreadable"), F.when(seen, F.col("image.height") * F.col("image.width")).alias("pixels"),
        F.when(seen, F.aggregate(level, F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("brightness"),
    )


@query(
    "image_prep",
    f"""
    with l as (select vec_id, {_LEVELS_SQL} as v from embeddings)
    select vec_id, r * 4 + c as cell, round((v[r * 16 + c * 2 + 1] + v[r * 16 + c * 2 + 2] + v[r * 16 + c * 2 + 9] + v[r * 16 + c * 2 + 10]) / 4 / 255, 5) as level
    from l, (select cast(unnest(range(4)) as integer) as r), (select cast(unnest(range(4)) as integer) as c)
    """,
)
def image_prep(spark, d):
    """Halved pictures: each new pixel is the mean of four."""
    small = images.prep_images(_pictures(spark, d).select("vec_id", "label", "image"), 4, "grey")
    cells = small.select("vec_id", F.posexplode("pixels").alias("cell", "level"))
    return cells.select("vec_id", "cell", F.round(F.col("level").cast("double"), 5).alias("level"))


@query(
    "image_augment",
    """
    select vec_id, copy, 64 as n_pixels, true as in_range, round(((cast(concat('0x', substr(md5(concat_ws('|', vec_id, copy, 'turn')), 1, 8)) as bigint)
      % 10000) / 10000.0::double * 2 - 1) * 15, 6) + 0.0 as degrees from embeddings, (select cast(unnest([1, 2, 3]) as integer) as copy)
    """,
)
def image_augment(spark, d):
    """Rotated copies hold only values of their source picture."""
    ready = images.prep_images(_pictures(spark, d).select("vec_id", "label", "image"), 8, "grey")
    turned = images.augment(ready.withColumn("source", F.col("pixels")), "vec_id", 3, 15.0)
    return turned.select(
        "vec_id",
        "copy",
        F.size("pixels").alias("n_pixels"),
        (F.size(F.array_except("pixels", "source")) == 0).alias("in_range"),
        (F.round("degrees", 6) + F.lit(0.0)).alias("degrees"),
    )
