"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings, safe to apply to a session somebody else created. Sizes of
# shuffle partitions are left to AQE: it starts from spark.sql.shuffle.partitions
# and merges or splits towards the advisory size.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, name: str = "tradeloom") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own.

    Its scratch folder is on this machine, as are all its executors.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tradeloom-"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
