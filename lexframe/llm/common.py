"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: white space of the word rules (space and U+0009 to U+000D), as characters and as a class body
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it in lambdas."""
    return F.transform(F.array(value), body)[0]


def named(name: str, df: DataFrame | None = None) -> Column:
    """The column of exactly this name (of ``df``, where given), whatever characters it holds."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(quoted) if df is None else df[quoted]


def packed_row(names: list[str], df: DataFrame | None = None) -> Column:
    """The columns of these names in one struct, so that no name of theirs meets a name of an operator's own."""
    return F.struct(*[named(c, df).alias(f"c{i}") for i, c in enumerate(names)], F.lit(0).alias("end"))


def unpacked(row: str | Column, names: list[str]) -> list[Column]:
    """The columns that ``packed_row`` packed, with their names."""
    row = F.col(row) if isinstance(row, str) else row
    return [row[f"c{i}"].alias(c) for i, c in enumerate(names)]


def words(text: Column) -> Column:
    """Runs of characters outside the white space class; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+"), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where the session names none (tests) it is a folder in the warehouse, which all share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
