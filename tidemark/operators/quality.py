"""Declarative data tests: one row per test with its number of failures."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import CATEGORIES


@dataclass(frozen=True)
class RowTest:
    """Every row must satisfy ``ok``; a null outcome passes."""

    name: str
    table: str
    ok: Column

    def bad(self) -> Column:
        return ~F.coalesce(self.ok, F.lit(True))


@dataclass(frozen=True)
class UniqueTest:
    """No two rows share ``key``; null keys are left out."""

    name: str
    table: str
    key: Column

    def duplicates(self, df: DataFrame) -> DataFrame:
        keyed = df.select(self.key.alias("key")).filter(F.col("key").isNotNull())
        return keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")


@dataclass(frozen=True)
class SingularTest:
    """A frame of offending rows that must be empty."""

    name: str
    table: str
    rows: DataFrame = field(compare=False)


def not_null(table: str, column: str) -> RowTest:
    return RowTest(f"not_null_{table}_{column}", table, F.col(column).isNotNull())


def accepted_values(table: str, column: str, values) -> RowTest:
    return RowTest(f"accepted_values_{table}_{column}", table, F.col(column).isin(*values))


def value_range(table: str, column: str, low, high, when: Column | None = None, tag: str = "") -> RowTest:
    inside = F.col(column).between(low, high)
    ok = inside if when is None else ~when | inside
    return RowTest(f"range_{table}_{column}{tag}", table, ok)


def matches(table: str, column: str, pattern: str) -> RowTest:
    return RowTest(f"matches_{table}_{column}", table, F.col(column).rlike(pattern))


def unique(table: str, column: str) -> UniqueTest:
    return UniqueTest(f"unique_{table}_{column}", table, F.col(column))


def unique_on(table: str, name: str, *columns: str, separator: str = "-") -> UniqueTest:
    # plain concatenation: a null part makes the key null, as in SQL
    parts = [F.col(columns[0]).cast("string")]
    for c in columns[1:]:
        parts += [F.lit(separator), F.col(c).cast("string")]
    return UniqueTest(f"unique_{table}_{name}", table, F.concat(*parts))


def negative_sums(daily: DataFrame, table: str = "user_daily_features") -> SingularTest:
    bad = daily.filter("daily_txn_sum < 0").select("user_id", "event_date", "daily_txn_sum")
    return SingularTest("assert_no_negative_sums", table, bad)


def model_tests(daily: DataFrame, categories=CATEGORIES) -> list:
    """The tests of the raw, daily and rolling tables."""
    raw, day, roll = "raw_transactions", "user_daily_features", "user_rolling_features"
    return [
        unique(raw, "transaction_id"),
        *[not_null(raw, c) for c in ("transaction_id", "user_id", "amount", "timestamp")],
        accepted_values(raw, "category", categories),
        *[not_null(day, c) for c in ("user_id", "event_date", "daily_txn_count")],
        accepted_values(day, "has_anomaly", [0, 1]),
        unique_on(day, "user_id_event_date", "user_id", "event_date"),
        *[not_null(roll, c) for c in ("user_id", "event_date")],
        negative_sums(daily, day),
    ]


def generator_tests(table: str = "raw_transactions") -> list:
    """Range and shape rules of generated transactions."""
    anomaly = F.col("is_anomaly")
    required = ("transaction_id", "user_id", "amount", "category", "merchant_id", "timestamp", "is_anomaly")
    return [
        *[not_null(table, c) for c in required],
        value_range(table, "amount", 500.0, 5000.0, anomaly, "_anomalous"),
        value_range(table, "amount", 5.0, 200.0, ~anomaly, "_normal"),
        matches(table, "user_id", "^user_[0-9]+$"),
        matches(table, "timestamp", r"(Z|[+-]\d{2}:?\d{2})$"),
    ]


def run_tests(tables: dict[str, DataFrame], tests: list) -> DataFrame:
    """``(test, failures, passed)``, one row per test.

    All row tests of a table are counted in a single pass over it.
    """
    parts = []
    for table in dict.fromkeys(t.table for t in tests if isinstance(t, RowTest)):
        mine = [t for t in tests if isinstance(t, RowTest) and t.table == table]
        counted = tables[table].agg(*[F.count_if(t.bad()).alias(f"c{i}") for i, t in enumerate(mine)])
        pairs = [F.struct(F.lit(t.name).alias("test"), F.col(f"c{i}").alias("failures")) for i, t in enumerate(mine)]
        parts.append(counted.select(F.inline(F.array(*pairs))))
    for t in tests:
        if isinstance(t, UniqueTest):
            rows = t.duplicates(tables[t.table])
        elif isinstance(t, SingularTest):
            rows = t.rows
        else:
            continue
        parts.append(rows.agg(F.count("*").alias("failures")).select(F.lit(t.name).alias("test"), "failures"))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failures") == 0)


def failing_rows(tables: dict[str, DataFrame], test) -> DataFrame:
    """The rows (or duplicated keys) behind a failed test."""
    if isinstance(test, RowTest):
        return tables[test.table].filter(test.bad())
    if isinstance(test, UniqueTest):
        return test.duplicates(tables[test.table])
    return test.rows


def assert_passed(report: DataFrame) -> None:
    """Raise with the names of failed tests. A report has one row per test."""
    failed = report.filter(~F.col("passed")).orderBy("test").collect()
    if failed:
        raise AssertionError("failed tests: " + ", ".join(f"{r['test']} ({r['failures']})" for r in failed))
