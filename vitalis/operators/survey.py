"""Design-based estimates for stratified, clustered, weighted samples.

Every estimate here is a smooth function of weighted sums, and its variance needs only the
totals of a linearised score per primary sampling unit (PSU). Those totals are linear in the
PSU's own sums, so each operator reads the rows once, reduces them to one line per PSU, and
takes estimate and standard error from that small table:

    Var = sum_h n_h / (n_h - 1) * (sum_c t_hc^2 - (sum_c t_hc)^2 / n_h)

``n_h`` counts all PSUs of the design, also those without a row in the domain; these have a
total of zero and need no line of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalis.functions.stats import t_quantile, t_two_sided
from vitalis.session import durable


def rescale_weight(df: DataFrame, weight: str, cycles: int, out: str) -> DataFrame:
    """Weight of pooled survey cycles: the per-cycle weight over their number."""
    return df.withColumn(out, F.col(weight) / F.lit(float(cycles)))


@dataclass(frozen=True)
class SurveyDesign:
    """Rows with stratum, PSU (nested in its stratum) and weight; a domain marks rows, it drops none."""

    df: DataFrame
    strata: str
    psu: str
    weight: str
    within: Column | None = None

    def domain(self, condition: Column) -> SurveyDesign:
        both = condition if self.within is None else self.within & condition
        return replace(self, within=both)

    @property
    def in_domain(self) -> Column:
        return F.lit(True) if self.within is None else F.coalesce(self.within, F.lit(False))

    def summary(self) -> DataFrame:
        """One line per stratum: PSUs, rows, weight."""
        return self.df.groupBy(F.col(self.strata).alias("stratum")).agg(
            F.count_distinct(F.col(self.psu)).alias("n_psu"),
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(self.weight).alias("weight"),
        )

    def counts(self) -> DataFrame:
        """Rows of the design and of the domain."""
        return self.df.agg(
            F.count(F.lit(1)).alias("n_design"), F.count_if(self.in_domain).alias("n_domain")
        )


def _psu_sums(design: SurveyDesign, sums: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One line per (by, stratum, PSU) with the given sums, written once: the only scan of the rows.

    No row is filtered out before, so every unit of the design has a line.
    """
    units = design.df.groupBy(*by, F.col(design.strata).alias("_h"), F.col(design.psu).alias("_c"))
    return durable(units.agg(*[F.sum(c).alias(name) for name, c in sums.items()]))


def _strata_sizes(totals: DataFrame) -> DataFrame:
    units = totals.select("_h", "_c").distinct()
    return units.groupBy("_h").agg(F.count(F.lit(1)).alias("_n_h"))


def _variances(sizes: DataFrame, scored: DataFrame, scores: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Variance per score (same column names) and per ``by`` from the PSU totals."""
    per_stratum = scored.groupBy(*by, "_h").agg(
        *[F.sum(s).alias(f"_s_{s}") for s in scores], *[F.sum(F.col(s) * F.col(s)).alias(f"_q_{s}") for s in scores]
    )
    sized = per_stratum.join(sizes, "_h")
    n = F.when(F.col("_n_h") > 1, F.col("_n_h")).otherwise(
        F.raise_error(F.lit("a stratum with a single primary unit has no variance estimate")).cast("bigint")
    )
    parts = [
        F.sum(n / (n - 1) * (F.col(f"_q_{s}") - F.col(f"_s_{s}") * F.col(f"_s_{s}") / n)).alias(s) for s in scores
    ]
    return sized.groupBy(*by).agg(*parts) if by else sized.agg(*parts)


def _means(totals: DataFrame, sizes: DataFrame, by: Sequence[str], na_rm: bool) -> DataFrame:
    """Estimate and standard error per ``by`` from the PSU sums _w, _wy, _na (missing) and _in (in the domain)."""
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    weight = F.nullif("_sum_w", F.lit(0.0))
    scored = (
        totals.withColumns(
            {"_sum_w": F.sum("_w").over(group), "_sum_wy": F.sum("_wy").over(group), "_missing": F.sum("_na").over(group)}
        )
        .withColumn("estimate", F.col("_sum_wy") / weight)
        .withColumn("score", (F.col("_wy") - F.col("estimate") * F.col("_w")) / weight)
    )
    means = scored.groupBy(*by).agg(
        F.max("estimate").alias("estimate"), F.max("_missing").alias("_missing"), F.sum("_in").alias("_in")
    )
    spread = _variances(sizes, scored, ["score"], by)
    joined = means.join(spread, list(by)) if by else means.withColumn("score", spread.scalar())
    known = F.lit(True) if na_rm else F.col("_missing") == 0
    return joined.filter(F.col("_in") > 0).select(
        *by, F.when(known, F.col("estimate")).alias("estimate"), F.when(known, F.sqrt("score")).alias("se")
    )


def _without_null_groups(totals: DataFrame, by: Sequence[str]) -> DataFrame:
    return totals.dropna(subset=list(by)) if by else totals


def svy_by(design: SurveyDesign, y: Column | str, by: Sequence[str] = (), na_rm: bool = False) -> DataFrame:
    """Weighted mean and its standard error, overall or per group; rows with a null group are left out.

    With missing outcomes the result is null unless ``na_rm``.
    """
    value = F.col(y) if isinstance(y, str) else y
    used = design.in_domain & value.isNotNull()
    w = F.col(design.weight)
    totals = _psu_sums(
        design,
        {
            "_w": F.when(used, w).otherwise(0.0),
            "_wy": F.when(used, w * value).otherwise(0.0),
            "_na": F.when(design.in_domain & value.isNull(), 1).otherwise(0),
            "_in": F.when(design.in_domain, 1).otherwise(0),
        },
        by,
    )
    return _means(_without_null_groups(totals, by), _strata_sizes(totals), by, na_rm)


def svy_mean(design: SurveyDesign, y: Column | str, na_rm: bool = True) -> DataFrame:
    return svy_by(design, y, (), na_rm)


def svy_prop(
    design: SurveyDesign, column: str, levels: Sequence, by: Sequence[str] = (), na_rm: bool = True
) -> DataFrame:
    """Weighted share of each level with its standard error, overall or per group.

    The rows are not multiplied by the levels: the weight of every level is summed per PSU, and
    only those sums become one line per level.
    """
    used = design.in_domain & F.col(column).isNotNull()
    w = F.col(design.weight)
    sums = {
        "_w": F.when(used, w).otherwise(0.0),
        "_na": F.when(design.in_domain & F.col(column).isNull(), 1).otherwise(0),
        "_in": F.when(design.in_domain, 1).otherwise(0),
    }
    for i, v in enumerate(levels):
        sums[f"_l{i}"] = F.when(used & (F.col(column) == F.lit(v)), w).otherwise(0.0)
    totals = _psu_sums(design, sums, by)
    lines = F.array(*[F.struct(F.lit(v).alias("level"), F.col(f"_l{i}").alias("_wy")) for i, v in enumerate(levels)])
    long = _without_null_groups(totals, by).select(*by, "_h", "_c", "_w", "_na", "_in", F.inline(lines))
    return _means(long, _strata_sizes(totals), [*by, "level"], na_rm)


def _degrees(totals: DataFrame) -> int:
    """PSUs minus strata among those with a used row (``_n`` > 0)."""
    seen = totals.filter("_n > 0")
    units, strata = seen.agg(F.count_distinct("_h", "_c"), F.count_distinct("_h")).first()
    return units - strata


def svy_ttest(design: SurveyDesign, y: str, group: str, levels: Sequence, confidence: float = 0.95) -> DataFrame:
    """Difference of two group means (second minus first level): estimate, se, t, df, p and interval."""
    first, second = levels
    w, value = F.col(design.weight), F.col(y)
    used = design.in_domain & value.isNotNull() & F.col(group).isin(first, second)
    sums = {"_n": F.when(used, 1).otherwise(0)}
    for i, v in enumerate((first, second)):
        side = used & (F.col(group) == F.lit(v))
        sums[f"_w{i}"] = F.when(side, w).otherwise(0.0)
        sums[f"_wy{i}"] = F.when(side, w * value).otherwise(0.0)
    totals = _psu_sums(design, sums)
    w0, wy0, w1, wy1 = totals.agg(F.sum("_w0"), F.sum("_wy0"), F.sum("_w1"), F.sum("_wy1")).first()
    m0, m1 = wy0 / w0, wy1 / w1
    scored = totals.withColumn(
        "score", (F.col("_wy1") - m1 * F.col("_w1")) / w1 - (F.col("_wy0") - m0 * F.col("_w0")) / w0
    )
    se = _variances(_strata_sizes(totals), scored, ["score"]).first()[0] ** 0.5
    df = _degrees(totals) - 1
    t = (m1 - m0) / se
    reach = t_quantile(0.5 + confidence / 2, df) * se
    return design.df.sparkSession.createDataFrame(
        [(m1 - m0, se, t, df, t_two_sided(t, df), m1 - m0 - reach, m1 - m0 + reach)],
        "estimate double, se double, statistic double, df int, p_value double, conf_low double, conf_high double",
    )


@dataclass(frozen=True)
class Term:
    """A named column of a linear model."""

    name: str
    value: Column


def factor_terms(column: str, levels: Sequence) -> list[Term]:
    """0/1 terms of all levels but the first, the baseline; a null value makes every term null."""
    return [Term(f"{column}{v}", (F.col(column) == F.lit(v)).cast("double")) for v in levels[1:]]


def interaction(a: Sequence[Term], b: Sequence[Term]) -> list[Term]:
    return [Term(f"{x.name}:{y.name}", x.value * y.value) for y in b for x in a]


def svy_glm(design: SurveyDesign, y: str, terms: Sequence[Term], max_terms: int = 200) -> DataFrame:
    """Weighted linear model with design-based standard errors, as a tidy coefficient table.

    One scan gives the normal equations of every PSU; they add up to those of the model, and
    with the solution they give the PSU score totals, so the rows are not read again.
    """
    if len(terms) > max_terms:
        raise ValueError(f"{len(terms)} terms exceed {max_terms}")
    names = ["(Intercept)", *[t.name for t in terms]]
    columns = [F.lit(1.0), *[t.value for t in terms]]
    p, w, value = len(names), F.col(design.weight), F.col(y)
    used = design.in_domain & value.isNotNull()
    for t in terms:
        used = used & t.value.isNotNull()
    weight = F.when(used, w).otherwise(0.0)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]

    def safe(c: Column) -> Column:  # a row out of the model has weight 0 and must not carry a null
        return F.coalesce(c, F.lit(0.0))

    sums = {f"a{i}_{j}": weight * safe(columns[i] * columns[j]) for i, j in pairs}
    sums |= {f"b{i}": weight * safe(columns[i] * value) for i in range(p)}
    sums["_n"] = F.when(used, 1).otherwise(0)
    totals = _psu_sums(design, sums)
    whole = totals.agg(*[F.sum(c).alias(c) for c in sums]).first()
    normal = np.zeros((p, p))
    for i, j in pairs:
        normal[i, j] = normal[j, i] = whole[f"a{i}_{j}"]
    beta = np.linalg.solve(normal, np.array([whole[f"b{i}"] for i in range(p)]))
    inverse = np.linalg.inv(normal)

    def score(i: int) -> Column:
        total = F.col(f"b{i}")
        for j in range(p):
            total = total - F.col(f"a{min(i, j)}_{max(i, j)}") * float(beta[j])
        return total

    scored = totals.select("_h", "_c", *[score(i).alias(f"s{i}") for i in range(p)])
    influence = [
        sum((F.col(f"s{i}") * float(inverse[k, i]) for i in range(p)), F.lit(0.0)).alias(f"u{k}") for k in range(p)
    ]
    spread = _variances(_strata_sizes(totals), scored.select("_h", "_c", *influence), [f"u{k}" for k in range(p)]).first()
    df = _degrees(totals) + 1 - p
    rows = []
    for k, name in enumerate(names):
        se = float(spread[f"u{k}"]) ** 0.5
        t = float(beta[k]) / se
        rows.append((name, float(beta[k]), se, t, t_two_sided(t, df) if df > 0 else None))
    return design.df.sparkSession.createDataFrame(
        rows, "term string, estimate double, std_error double, statistic double, p_value double"
    )


def linear_combo(tidy: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Sum of the selected coefficients."""
    return tidy.filter(F.col("term").isin(*terms)).agg(F.sum("estimate").alias("estimate"))
