"""Column selection, filters, encoding and row addressing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.plans import ranks
from vitalis.session import travelling


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def project_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the given columns, in the given order, under new names."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def split_target(df: DataFrame, target: str, drop: Sequence[str] = ()) -> tuple[list[str], DataFrame]:
    """Feature names and a frame of (features..., target) without the dropped columns."""
    features = [c for c in df.columns if c != target and c not in drop]
    return features, df.select(*features, target)


def not_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where none of the columns is null or NaN."""
    return df.dropna(subset=list(columns))


def filter_group_size(df: DataFrame, key: str, min_exclusive: int) -> DataFrame:
    """Rows of groups with more than ``min_exclusive`` rows.

    Counts are aggregated before the shuffle and come back by a semi join, so a large group
    is never gathered; a short list of keys travels to the rows instead.
    """
    keep = df.groupBy(key).count().filter(F.col("count") > min_exclusive).select(key)
    return df.join(travelling(keep), key, "left_semi")


def head_by(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def row_at(df: DataFrame, order: Sequence[Column | str], position: int) -> DataFrame:
    """The single row at a 0-based position of an explicit order."""
    return df.orderBy(*order).offset(position).limit(1)


def sample_where(df: DataFrame, condition: Column, n: int, key: Sequence[str], seed: str) -> DataFrame:
    """``n`` rows that satisfy ``condition``, drawn without replacement in md5 order."""
    return (
        df.filter(condition)
        .withColumn("_h", ranks.hash_key(key, seed))
        .orderBy("_h", *key)
        .limit(n)
        .drop("_h")
    )


def encode_binary(column: Column | str, zero: str) -> Column:
    """0 for the ``zero`` value, 1 for everything else, null included."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c == zero, 0).otherwise(1)


def map_labels(column: Column | str, mapping: Mapping, missing: str = "null") -> Column:
    """Look a label up in a fixed mapping; an unmapped value gives null or fails the job."""
    if missing not in ("null", "error"):
        raise ValueError("missing must be 'null' or 'error'")
    c = F.col(column) if isinstance(column, str) else column
    found = None
    for value, label in mapping.items():
        hit = c == F.lit(value)
        found = F.when(hit, F.lit(label)) if found is None else found.when(hit, F.lit(label))
    if missing == "error":
        text = F.concat(F.lit("label without mapping: "), F.coalesce(c.cast("string"), F.lit("null")))
        found = found.otherwise(F.raise_error(text))
    return found


def sorted_levels(df: DataFrame, column: str, max_levels: int = 1000) -> list:
    """The sorted distinct values of a categorical column; refuses a column with too many."""
    rows = (
        df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).limit(max_levels + 1).collect()
    )
    if len(rows) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} levels; pass the levels or use an index instead")
    return [r[0] for r in rows]


def one_hot(
    df: DataFrame,
    column: str,
    levels: Sequence | None = None,
    drop_first: bool = True,
    max_levels: int = 1000,
) -> DataFrame:
    """One 0/1 column per level, named by the level, in place of the source column."""
    levels = list(levels) if levels is not None else sorted_levels(df, column, max_levels)
    kept = levels[1:] if drop_first else levels
    dummies = [F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)).alias(str(v)) for v in kept]
    return df.select(*[c for c in df.columns if c != column], *dummies)


def label_vector(column: Column | str, levels: Sequence) -> Column:
    """0/1 vector over the sorted levels."""
    c = F.col(column) if isinstance(column, str) else column
    return F.array(*[F.coalesce((c == F.lit(v)).cast("double"), F.lit(0.0)) for v in levels])


def argmax(vector: Column | str) -> Column:
    """0-based position of the largest element; the first one on ties."""
    v = F.col(vector) if isinstance(vector, str) else vector
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def with_row_id(df: DataFrame, order: str, key: str, out: str = "row_id") -> DataFrame:
    """Number all rows from 0 in (``order``, ``key``) order without a single-task sort."""
    return ranks.ordered_rank(df, [], order, key, out).drop("group_total")
