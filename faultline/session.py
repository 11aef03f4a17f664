"""Session settings that matter to the jobs."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "faultline", **conf: str) -> SparkSession:
    """A session for tests and benchmarks. On a cluster the submitted session is used as it is."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # The first Python worker may take long to import its libraries on a busy machine.
        .config("spark.python.authenticate.socketTimeout", "60s")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_checkpoints(spark: SparkSession) -> None:
    """Point reliable checkpoints at the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster it would not be shared.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="faultline-checkpoints-")
    context.setCheckpointDir(folder)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint: what follows may read it several times without computing it again.

    Plans that use an aggregate twice are not always recognised as equal once Spark has pruned columns and pushed
    filters into each use; then the facts below would be scanned for every use.
    """
    use_checkpoints(df.sparkSession)
    return df.checkpoint()
