"""Data-quality checks, fused: a suite is one aggregate over one scan, however many checks it holds.

Null rules: a null fails not-null only; it passes in-set and at-least; it is one more value for
uniqueness; and a minimum over no values fails. A check on a missing column fails and leaves the others be.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clicklake.schemas import (
    BRONZE_EVENT_TYPES,
    BRONZE_ROW_RANGE,
    BROWSERS,
    DEVICE_TYPES,
    QUALITY,
    SILVER_EVENT_TYPES,
)


@dataclass(frozen=True)
class Check:
    """``counts`` are aggregates to compute; ``failing`` and ``passed`` are built from them and ``total``."""

    name: str
    column: str = ""
    counts: dict[str, str] = field(default_factory=dict)
    failing: str = "0"
    passed: str = "{failing} = 0"


def column_exists(column: str) -> Check:
    return Check("column_exists", column)


def not_null(column: str) -> Check:
    return Check("not_null", column, {"nulls": f"count_if(`{column}` IS NULL)"}, "{nulls}")


def unique(column: str) -> Check:
    counts = {"values": f"count(DISTINCT `{column}`)", "has_null": f"count_if(`{column}` IS NULL)"}
    return Check("unique", column, counts, "total - {values} - if({has_null} > 0, 1, 0)")


def in_set(column: str, allowed: Iterable[str]) -> Check:
    values = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in allowed)
    return Check("in_set", column, {"outside": f"count_if(`{column}` NOT IN ({values}))"}, "{outside}")


def at_least(column: str, low: float) -> Check:
    return Check("at_least", column, {"below": f"count_if(`{column}` < {low})"}, "{below}")


def minimum(column: str, low: float) -> Check:
    counts = {"below": f"count_if(`{column}` < {low})", "smallest": f"min(`{column}`)"}
    return Check("minimum", column, counts, "{below}", "coalesce({smallest} >= " + f"{low}, false)")


def row_count(low: int, high: int) -> Check:
    return Check("row_count", "", {}, "0", f"total BETWEEN {low} AND {high}")


def bronze_suite(row_range: tuple[int, int] = BRONZE_ROW_RANGE) -> list[Check]:
    # The columns that raw clicks must have.
    required = [
        "click_id", "user_id", "session_id", "page_url", "event_type", "event_timestamp", "created_at", "updated_at",
    ]
    return [column_exists(c) for c in required] + [
        not_null("click_id"),
        unique("click_id"),
        in_set("event_type", BRONZE_EVENT_TYPES),
        row_count(*row_range),
    ]


def silver_suite() -> list[Check]:
    return [column_exists(c) for c in ("domain", "device_type", "browser", "event_date")] + [
        not_null("domain"),
        in_set("device_type", DEVICE_TYPES),
        in_set("browser", BROWSERS),
    ]


def strict_suite() -> list[Check]:
    """The stricter click suite: key and user present, key unique, user not negative, four event types."""
    return [
        column_exists("click_id"),
        column_exists("user_id"),
        not_null("click_id"),
        not_null("user_id"),
        unique("click_id"),
        at_least("user_id", 0),
        in_set("event_type", SILVER_EVENT_TYPES),
    ]


SUITES = {"bronze": bronze_suite, "silver": silver_suite, "strict": strict_suite}


def measure_checks(df: DataFrame, checks: list[Check], layer: str, **measures: Column) -> DataFrame:
    """One row, lazily, by one aggregate: ``results``, an array of check rows, and any further measures."""
    present = set(df.columns)
    aggregates = [F.count(F.lit(1)).alias("total"), *(m.alias(name) for name, m in measures.items())]
    rows: list[Column] = []
    for i, check in enumerate(checks):
        if check.column and check.column not in present:
            passed, failing = "false", "total"
        else:
            names = {label: f"c{i}_{label}" for label in check.counts}
            aggregates += [F.expr(sql).alias(names[label]) for label, sql in check.counts.items()]
            failing = check.failing.format(**names)
            passed = check.passed.format(failing=f"({failing})", **names)
        rows.append(
            F.struct(
                F.lit(layer).alias("layer"),
                F.lit(check.name).alias("check"),
                F.lit(check.column).alias("column"),
                F.expr(passed).alias("passed"),
                F.expr(failing).cast("long").alias("failing_rows"),
                F.col("total").alias("total_rows"),
            )
        )
    return df.agg(*aggregates).select("total", *measures, F.array(*rows).alias("results"))


def run_checks(df: DataFrame, checks: list[Check], layer: str) -> DataFrame:
    """One row per check, exploded from the single row of one aggregate."""
    pct = F.when(F.col("total_rows") > 0, F.col("failing_rows").cast("double") * 100 / F.col("total_rows"))
    exploded = measure_checks(df, checks, layer).select(F.inline("results"))
    return exploded.withColumn("failing_pct", F.coalesce(pct, F.lit(0.0))).select(*QUALITY.fieldNames())


def summarize(results: DataFrame) -> DataFrame:
    """Passed, failed and total checks per layer, the pass rate in percent, and overall success."""
    return (
        results.groupBy("layer")
        .agg(F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))
        .withColumn("total", F.col("passed") + F.col("failed"))
        .withColumn("pass_rate", F.col("passed").cast("double") * 100 / F.col("total"))
        .withColumn("success", F.col("failed") == 0)
    )


@dataclass(frozen=True)
class Summary:
    passed: int
    failed: int
    failures: tuple[str, ...]

    @property
    def total(self) -> int:
        return self.passed + self.failed

    @property
    def pass_rate(self) -> float:
        return self.passed * 100.0 / self.total if self.total else 0.0

    @property
    def success(self) -> bool:
        return self.failed == 0


def collect_summary(results: DataFrame) -> Summary:
    """Check rows are one per check of a suite, so they may come to the driver."""
    rows = results.collect()
    failures = tuple(
        f"{r['layer']}: {r['check']}({r['column']}) failed, {r['failing_rows']} of {r['total_rows']} rows "
        f"({r['failing_pct']:.2f}%)"
        for r in rows
        if not r["passed"]
    )
    return Summary(len(rows) - len(failures), len(failures), failures)


def null_report(df: DataFrame, key: str = "click_id") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(key).isNull()).alias("null_click_ids")
    )


class SchemaError(ValueError):
    """A column is missing or has another type than declared."""


def validate_schema(df: DataFrame, expected: StructType) -> list[str]:
    """Extra columns come back as warnings; missing or retyped ones raise. Looks at the schema only."""
    actual = {f.name: f.dataType for f in df.schema}
    declared = {f.name: f.dataType for f in expected}
    problems = [f"missing column {name}" for name in declared if name not in actual]
    problems += [
        f"column {name} is {actual[name].simpleString()}, not {dtype.simpleString()}"
        for name, dtype in declared.items()
        if name in actual and actual[name].typeName() != dtype.typeName()
    ]
    if problems:
        raise SchemaError("; ".join(problems))
    return [f"new column {name}" for name in actual if name not in declared]
