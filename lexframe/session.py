"""Session set-up and the reliable cut of lineage used by the few iterative jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "lexframe", cores: str = "*", partitions: int | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    if not SparkSession.getActiveSession():
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.driver.memory", "12g")
            .config("spark.ui.enabled", "false")
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the cluster's checkpoint folder (survives lost executors).

    The folder is ``spark.checkpoint.dir``; where it is unset (tests) it lies in the warehouse, which
    driver and executors share as well.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return df.checkpoint(eager=True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
