"""Data tests on tables: not null, unique, unique combination of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _verdict(df: DataFrame) -> DataFrame:
    status = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    return df.select("table", "test", "columns", "failures", status.alias("status"))


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL, for all columns of a table in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)])
    rows = F.inline(
        F.array(
            *[
                F.struct(F.lit(c).alias("columns"), F.col(f"_{i}").alias("failures"))
                for i, c in enumerate(columns)
            ]
        )
    )
    return _verdict(
        counts.select(rows).select(
            F.lit(table).alias("table"), F.lit("not_null").alias("test"), "columns", "failures"
        )
    )


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count; nulls group together."""
    # Counts are combined on the map side, so a hot key ships one row per task.
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def _count_of(dup: DataFrame, table: str, test: str, columns: Sequence[str]) -> DataFrame:
    return _verdict(
        dup.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(table).alias("table"),
            F.lit(test).alias("test"),
            F.lit(",".join(columns)).alias("columns"),
            "failures",
        )
    )


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values that occur more than once; nulls are not compared."""
    found = duplicates(df.filter(F.col(column).isNotNull()), [column])
    return _count_of(found, table, "unique", [column])


def unique_combination(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; nulls count as equal."""
    found = duplicates(df, columns)
    return _count_of(found, table, "unique_combination_of_columns", columns)


def run_tests(df: DataFrame, table: str, tests: dict) -> DataFrame:
    """All tests declared for a table as (table, test, columns, failures, status).

    The table is read once, whatever the number of keys.
    """
    columns = list(tests.get("not_null", []))
    found = [("unique", [c]) for c in tests.get("unique", [])]
    found += [("unique_combination_of_columns", list(c)) for c in tests.get("unique_combination", [])]
    if not found:
        return not_null(df, table, columns)
    # One scan: Expand makes a row per key and its own columns, and counts are combined on the map side,
    # so a hot key ships one row per task.  Nulls are counted in the rows of the first key.
    held = list(dict.fromkeys(c for _, key in found for c in key))
    alias = {c: f"_key{i}" for i, c in enumerate(held)}
    keyed = df.select(*[F.col(c).alias(alias[c]) for c in held], *[F.col(c).isNull().alias(f"_null{i}") for i, c in enumerate(columns)])
    sets = [[F.col(alias[c]) for c in key] for _, key in found]
    nulls = [F.count_if(F.col(f"_null{i}")).alias(f"_null{i}") for i in range(len(columns))]
    grouped = keyed.groupingSets(sets, *[F.col(alias[c]) for c in held]).agg(
        F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set"), *nulls
    )

    def number(key: list[str]) -> int:
        """grouping_id of a key: a bit for every column it lacks, the first column highest."""
        return sum(1 << (len(held) - 1 - i) for i, c in enumerate(held) if c not in key)

    def twice(kind: str, key: list[str]):
        several = (F.col("_set") == number(key)) & (F.col("_n") > 1)
        return several & F.col(alias[key[0]]).isNotNull() if kind == "unique" else several

    first = F.col("_set") == number(found[0][1])
    counts = grouped.agg(
        *[F.count_if(twice(kind, key)).alias(f"_twice{i}") for i, (kind, key) in enumerate(found)],
        *[F.coalesce(F.sum(F.when(first, F.col(f"_null{i}"))), F.lit(0)).alias(f"_null{i}") for i in range(len(columns))],
    )

    def verdict(test: str, named: str, failures: str):
        return F.struct(F.lit(test).alias("test"), F.lit(named).alias("columns"), F.col(failures).alias("failures"))

    verdicts = [verdict("not_null", c, f"_null{i}") for i, c in enumerate(columns)]
    verdicts += [verdict(kind, ",".join(key), f"_twice{i}") for i, (kind, key) in enumerate(found)]
    return _verdict(counts.select(F.lit(table).alias("table"), F.inline(F.array(*verdicts))))
