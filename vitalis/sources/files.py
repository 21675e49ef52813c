"""Sources whose folder or file names carry data: entity files, class folders, images."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.functions.scalars import reshape
from vitalis.functions.text import file_stem, parent_name


def _folder(path: Column) -> Column:
    """Parent folder name; for ``column=value`` folders the value."""
    return F.regexp_replace(parent_name(path), "^[^=]*=", "")


def read_flat_vectors(
    spark: SparkSession, path: str, height: int, width: int, channels: int, partitions: int | None = None
) -> DataFrame:
    """Header-less rows of numbers, one flattened image each, class = folder name.

    Lines are cut into one array, so a row may have any number of values without becoming that
    many columns. Compressed files cannot be split: give ``partitions`` to spread their rows.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    values = F.transform(F.split("value", ","), lambda x: x.cast("float"))
    rows = lines.select(_folder(F.col("_metadata.file_path")).alias("label"), values.alias("pixels"))
    size = height * width * channels
    checked = F.when(F.size("pixels") == size, F.col("pixels")).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {size} values per line, found "), F.size("pixels").cast("string")))
    )
    rows = rows.withColumn("pixels", checked.cast("array<float>"))
    return rows.repartition(partitions) if partitions else rows


def as_image(pixels: Column | str, height: int, width: int, channels: int) -> Column:
    """Flat pixels as height x width x channels."""
    per_row = reshape(pixels, height, width * channels)
    return F.transform(per_row, lambda line: reshape(line, width, channels))


def read_entity_files(
    spark: SparkSession, folder: str, fields: Sequence[str], schema: str | T.StructType, by: str = "file"
) -> DataFrame:
    """One CSV per entity; the parts of its name, joined by ``_``, become leading columns.

    ``by`` says whether the file or its folder is named after the entity. ``block`` and ``line``
    give the order of the rows within a file.
    """
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").csv(folder, header=True)
    path = F.col("_metadata.file_path")
    name = F.split(file_stem(path) if by == "file" else _folder(path), "_")
    return rows.select(
        *[F.try_element_at(name, F.lit(i + 1)).alias(f) for i, f in enumerate(fields)],
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        *rows.columns,
    )


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded images below a folder with the name of the folder each lies in as label.

    A file that can't be decoded keeps its row, with a null image and the reason in ``error``.
    """
    images = spark.read.format("image").option("recursiveFileLookup", "true").load(folder)
    broken = F.col("image.height") < 0
    return images.select(
        F.when(~broken, F.col("image")).alias("image"),
        F.col("image.origin").alias("origin"),
        parent_name("image.origin").alias("label"),
        F.when(broken, "unreadable").alias("error"),
    )


def grey_png(pixels: bytes, height: int, width: int) -> bytes:
    """A grey picture of 8 bits, rows from the top, as a PNG file."""

    def part(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    lines = b"".join(b"\0" + pixels[r * width : (r + 1) * width] for r in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")


def write_pngs(pictures: DataFrame, folder: str, height: int, width: int) -> str:
    """Write each row (path, data, cut) as a PNG file below ``folder``; a ``cut`` row loses all but its first bytes.

    The tasks write to the shared folder by themselves; a task run again writes the same files.
    """
    pairs = pictures.select("path", "data", "cut")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bare = re.sub("^file:/+", "/", folder)
        store, root = fs.FileSystem.from_uri(bare) if "://" in bare else (fs.LocalFileSystem(), bare)
        for batch in batches:
            rows = batch.to_pylist()
            for parent in {f"{root}/{r['path']}".rsplit("/", 1)[0] for r in rows}:
                store.create_dir(parent, recursive=True)
            for row in rows:
                made = grey_png(row["data"], height, width)
                with store.open_output_stream(f"{root}/{row['path']}") as out:
                    out.write(made[:16] if row["cut"] else made)
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(rows)], pa.int64())})

    pairs.mapInArrow(write, "n bigint").agg(F.sum("n")).collect()
    return folder


def normalized_path(path: Column | str) -> Column:
    """Path without scheme, leading ``./`` and doubled slashes, in one form for joining."""
    p = F.col(path) if isinstance(path, str) else path
    bare = F.regexp_replace(F.regexp_replace(p, "^[a-z]+:/*", "/"), r"^\./", "")
    return F.regexp_replace(bare, "/+", "/")


def join_manifest(manifest: DataFrame, images: DataFrame, path_columns: Sequence[str], root: str = "") -> DataFrame:
    """Resolve each path column of a manifest to its image; an unresolved path gives a null image.

    ``images`` has ``origin`` and ``image``; manifest paths are relative to ``root``.
    """
    pictures = images.select(normalized_path("origin").alias("_origin"), "image")
    joined = manifest
    for c in path_columns:
        side = pictures.select(F.col("_origin").alias(f"_p_{c}"), F.col("image").alias(f"{c}_image"))
        full = normalized_path(F.concat(F.lit(f"{root.rstrip('/')}/" if root else ""), F.col(c)))
        joined = joined.join(side, full == F.col(f"_p_{c}"), "left").drop(f"_p_{c}")
    return joined
