"""Expectations, constraints, profiles, outliers, drift and alerts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from tidemark.operators.quantiles import column_quantiles, exact_quantiles


@dataclass(frozen=True)
class Expectation:
    """A rule as a SQL predicate; ``warn`` keeps, ``drop`` removes, ``fail`` stops."""

    name: str
    rule: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(f"unknown action {self.action!r}")

    def holds(self) -> Column:
        """A null predicate does not hold."""
        return F.coalesce(F.expr(self.rule), F.lit(False))


def as_rows(one: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """Turn the single row of an aggregate into one row per struct."""
    return one.select(F.inline(F.array(*rows)))


def expectation_metrics(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Passed and failed rows of every rule, in one pass over the data."""
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(e.holds()).alias(f"p{i}") for i, e in enumerate(rules)],
    )
    return as_rows(
        one,
        [
            F.struct(
                F.lit(e.name).alias("expectation"),
                F.lit(e.action).alias("action"),
                F.col(f"p{i}").alias("passed"),
                (F.col("n") - F.col(f"p{i}")).alias("failed"),
            )
            for i, e in enumerate(rules)
        ],
    )


def enforce(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Rows that may go on; a broken ``fail`` rule raises on the executor that meets it."""
    for e in rules:
        if e.action == "drop":
            df = df.filter(e.holds())
        elif e.action == "fail":
            stop = F.raise_error(F.lit(f"expectation {e.name!r} failed")).cast("boolean")
            df = df.filter(F.when(e.holds(), F.lit(True)).otherwise(stop))
    return df


def check_report(df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """Rows that break each CHECK; as in SQL a null passes."""
    one = df.agg(
        *[F.count_if(~F.coalesce(F.expr(r), F.lit(True))).alias(f"v{i}") for i, r in enumerate(checks.values())]
    )
    return as_rows(
        one,
        [
            F.struct(F.lit(name).alias("check_name"), F.col(f"v{i}").alias("violations"))
            for i, name in enumerate(checks)
        ],
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    cond = [F.col(f"c.{c}") == F.col(f"p.{p}") for c, p in on]
    known = child
    for c, _ in on:
        known = known.filter(F.col(c).isNotNull())
    return known.alias("c").join(parent.select(*[p for _, p in on]).alias("p"), cond, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Number of orphans; child rows are counted per key before they meet the parent."""
    keys = [c for c, _ in on]
    counted = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    lost = orphans(counted, parent, on)
    return lost.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("violations"))


def profile(df: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """One row per column: counts, null rate, distinct, min, max and, for numbers, mean and median.

    Exact distinct counts are subqueries of one column each: together they read
    the table once, and the main pass is not multiplied by the columns. The
    medians of all columns come from one more read.
    """
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    distinct = [
        df.select(F.col(f"`{f.name}`").alias("c")).distinct().agg(F.count("c")).scalar()
        for f in (df.schema.fields if exact_distinct else [])
    ]
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    medians = column_quantiles(df, numbers, ["0.5"]).select("column_name", F.col("quantiles")[0].alias("median"))
    for i, f in enumerate(df.schema.fields):
        c, number = F.col(f"`{f.name}`"), isinstance(f.dataType, NumericType)
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"d{i}"))
        aggs += [
            F.count(c).alias(f"k{i}"),
            F.min(c).cast("string").alias(f"a{i}"),
            F.max(c).cast("string").alias(f"z{i}"),
        ]
        if number:
            aggs += [
                F.avg(c).alias(f"m{i}"),
            ]
        none = F.lit(None).cast("double")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col("n").alias("rows"),
                F.col(f"k{i}").alias("non_null"),
                F.when(F.col("n") > 0, (F.col("n") - F.col(f"k{i}")) / F.col("n")).alias("null_rate"),
                (distinct[i] if exact_distinct else F.col(f"d{i}")).alias("n_distinct"),
                F.col(f"a{i}").alias("min_value"),
                F.col(f"z{i}").alias("max_value"),
                (F.round(f"m{i}", 4) if number else none).alias("mean"),
            )
        )
    # One row per column on both sides.
    return as_rows(df.agg(*aggs), rows).join(F.broadcast(medians), "column_name", "left")


def zscores(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    """Rows further than ``threshold`` deviations from the mean.

    Mean and deviation are a scalar subquery of the same plan: nothing is
    collected and nothing is joined.
    """
    stats = df.agg(F.struct(F.avg(column).alias("mean"), F.stddev(column).alias("sd"))).scalar()
    z = (F.col(column) - stats["mean"]) / F.nullif(stats["sd"], F.lit(0.0))
    return df.withColumn("z", z).filter(F.abs("z") > threshold)


def drift(baseline: DataFrame, current: DataFrame, column: str, buckets: int = 10) -> DataFrame:
    """Mean shift in baseline deviations and the population stability index.

    Buckets are the baseline's exact quantiles; both sides are counted per bucket.
    A side without values has no psi, a baseline without spread no shift and no ratio.
    """
    shares = [str(Decimal(i) / buckets) for i in range(1, buckets)]
    cuts = exact_quantiles(baseline, [], column, shares).scalar()

    def counted(df: DataFrame, side: str) -> DataFrame:
        below = F.lit(0)
        for i in range(buckets - 1):
            below = below + (cuts[i] < F.col(column)).cast("int")
        part = df.filter(F.col(column).isNotNull()).select(below.alias("bucket"))
        return part.groupBy("bucket").agg(F.count(F.lit(1)).alias(side))

    def stats(df: DataFrame) -> Column:
        row = F.struct(F.avg(column).alias("mean"), F.stddev(column).alias("sd"), F.count(column).alias("n"))
        return df.agg(row).scalar()

    b, c = stats(baseline), stats(current)
    per_bucket = counted(baseline, "b").join(counted(current, "c"), "bucket", "full_outer").fillna(0)
    p = F.greatest(F.col("b") / F.nullif(b["n"], F.lit(0)), F.lit(1e-6))
    q = F.greatest(F.col("c") / F.nullif(c["n"], F.lit(0)), F.lit(1e-6))
    both = (b["n"] > 0) & (c["n"] > 0)
    psi = per_bucket.select(F.when(both, (q - p) * F.ln(q / p)).alias("part")).agg(F.sum("part").alias("psi"))
    spread = F.nullif(b["sd"], F.lit(0.0))
    return psi.select(
        F.round(b["mean"], 4).alias("baseline_mean"),
        F.round(c["mean"], 4).alias("current_mean"),
        F.round((c["mean"] - b["mean"]) / spread, 6).alias("mean_shift"),
        F.round(c["sd"] / spread, 6).alias("sd_ratio"),
        F.round("psi", 6).alias("psi"),
    )


def evaluate_alerts(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Join metrics to rules ``(alert, metric, op, threshold, muted)`` and judge each."""
    v, limit = F.col("value"), F.col("threshold")
    tests = {">": v > limit, "<": v < limit, ">=": v >= limit, "<=": v <= limit, "==": v == limit, "!=": v != limit}
    hit = F.lit(None).cast("boolean")
    for op, test in tests.items():
        hit = F.when(F.col("op") == op, test).otherwise(hit)
    state = F.when(hit.isNull(), "UNKNOWN").when(~hit, "OK").when(F.col("muted"), "MUTED").otherwise("TRIGGERED")
    return rules.join(metrics, "metric", "left").withColumn("state", state)
