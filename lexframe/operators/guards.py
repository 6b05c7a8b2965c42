"""Guards and build assertions: each returns the offending rows; an empty result passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def duplicate_keys(df: DataFrame, keys: list[str], sample: str | None = None, samples: int = 5) -> DataFrame:
    """Repeated keys with their count and, when asked, the smallest few sample values.

    Samples come from repeated rows only and are cut to ``samples`` with a bounded top-k, so a
    key repeated in a third of all rows never collects its rows.
    """
    from lexframe.operators.order import top_k

    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if sample is None:
        return repeated
    some = top_k(df.select(*keys, sample).dropDuplicates(), keys, [F.col(sample)], samples)
    shown = some.groupBy(*keys).agg(F.sort_array(F.collect_list(sample)).alias("samples"))
    return repeated.join(shown, keys)


def overlap_rows(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Disjointness guard: rows of ``a`` whose key is also in ``b``."""
    return a.join(b.select(*keys), keys, "left_semi")


def outside_rows(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Subset guard: rows of ``a`` whose key is not in ``b``."""
    return a.join(b.select(*keys), keys, "left_anti")


def multiset_difference(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """Rows whose multiplicity differs, with both counts; one shuffle for both directions."""
    tagged = a.select(*cols, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        b.select(*cols, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    return (
        tagged.groupBy(*cols).agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))
        .where("n_left <> n_right")
    )


def set_difference(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """Rows present on one side only."""
    diff = multiset_difference(a, b, cols).where("n_left = 0 or n_right = 0")
    return diff.withColumn("side", F.when(F.col("n_right") == 0, "left").otherwise("right")).select(*cols, "side")


def stale_keys(existing: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    return existing.select(key).join(wanted.select(key), key, "left_anti")


def common_values(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    return a.select(*cols).intersect(b.select(*cols))


def any_overlap(a: Column, b: Column) -> Column:
    return F.arrays_overlap(a, b)


def union_lists(a: DataFrame, b: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The union and the rows breaking disjointness (must be empty)."""
    return a.unionByName(b), overlap_rows(b, a, [key])


def expect_counts(actual: DataFrame, expected: DataFrame, key: str, value: str) -> DataFrame:
    """Names whose measured value differs from the declared one."""
    return (
        expected.select(key, F.col(value).alias("expected")).join(actual.select(key, F.col(value).alias("actual")), key, "full_outer")
        .where(~F.col("expected").eqNullSafe(F.col("actual")))
    )


Rule = tuple[str, Column, Column]


def validate(df: DataFrame, keys: list[str], rules: list[Rule]) -> DataFrame:
    """One row per violation.  A rule is (name, broken-condition, path); nulls count as unbroken."""
    found = F.array(*[
        F.when(broken, F.struct(F.lit(name).alias("rule"), path.cast("string").alias("path"))) for name, broken, path in rules
    ])
    hits = df.select(*keys, F.explode(F.filter(found, lambda x: x.isNotNull())).alias("_v"))
    return hits.select(*keys, "_v.rule", "_v.path")


def gate(violations: DataFrame, what: str) -> None:
    """Fail the build when any violation exists, quoting the first five."""
    head = violations.limit(5).collect()
    if head:
        raise ValueError(f"{what}: {[r.asDict() for r in head]}")
