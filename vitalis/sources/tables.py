"""Tables, splits, documents and vectors: reading and writing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.operators.joins import union_splits


def read_table(
    spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "csv", sep: str = ",",
    header: bool = True, line_breaks: bool = False,
) -> DataFrame:
    """A delimited (or other) file with a given schema; nothing is inferred, bad lines fail the job.

    ``line_breaks`` admits line breaks inside quoted fields; such files cannot be split, so each
    is read by one task.
    """
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    return spark.read.schema(schema).csv(
        path, header=header, sep=sep, multiLine=line_breaks, escape='"', quote='"', mode="FAILFAST"
    )


def write_csv(df: DataFrame, path: str, header: bool = False, sep: str = ",", quote_all: bool = False) -> None:
    """Delimited text without an index; by default without a header, target first."""
    df.write.mode("overwrite").csv(path, header=header, sep=sep, escape='"', quote='"', quoteAll=quote_all)


def write_training_set(df: DataFrame, base: str, prefix: str, channel: str = "train") -> str:
    """Write a training matrix below ``base/prefix/channel`` and return the path."""
    path = f"{base.rstrip('/')}/{prefix}/{channel}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_vectors(df: DataFrame, path: str) -> None:
    """Arrays of numbers as Parquet."""
    df.write.mode("overwrite").parquet(path)


def read_splits(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """A dataset with named splits as one frame with a ``split`` column."""
    return union_splits({name: spark.read.parquet(path) for name, path in paths.items()})


def vector_to_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Elements of a vector as named columns, next to the other columns."""
    rest = [c for c in df.columns if c != vector]
    return df.select(*rest, *[F.col(vector)[i].alias(n) for i, n in enumerate(names)])


def split_pages(df: DataFrame, key: str, text: str, mark: str = "\f") -> DataFrame:
    """One row per page (key, page_no, text) of a text whose pages are parted by ``mark``."""
    return df.select(key, F.posexplode(F.split(text, f"\\Q{mark}\\E")).alias("page_no", "text"))


def read_documents(spark: SparkSession, folder: str, mark: str = "\f") -> DataFrame:
    """All text files below a folder, one row per page (path, page_no, text)."""
    whole = spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True)
    return split_pages(whole.select(F.col("_metadata.file_path").alias("path"), "value"), "path", "value", mark)
