"""Session construction, table access and checkpoints shared by operators, queries, tests and bench."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "quarrylens") -> SparkSession:
    """A local session with the settings the queries assume (UTC, AQE)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables under ``sf_dir`` (any path Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors share: the one that ``spark.checkpoint.dir`` names.

    Only a session whose executors live on this machine gets a temporary folder where none is set; a cluster without a shared
    folder is refused, since an executor's own disk is lost with it."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, with its lineage cut."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()
