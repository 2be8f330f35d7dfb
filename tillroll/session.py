"""Session settings for a run of a given size."""

from __future__ import annotations

from pyspark.sql import SparkSession

TARGET_PARTITION = 256 * 1024**2


def settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings that keep a task near 256 MB whatever the input.

    Shuffles start with enough partitions for the whole input and adaptive execution
    merges the small ones.  A partition of a plain join is split when it is far above
    the median; keys known to be hot are spread by the join itself.
    """
    partitions = max(cores, -(-input_bytes // TARGET_PARTITION))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * TARGET_PARTITION),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION if partitions > cores else 64 * 1024**2),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION),
    }


def local_session(name: str, cores: int, memory: str = "16g", input_bytes: int = 0) -> SparkSession:
    """A session on this machine, without the web UI."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        # Call-site capture for error messages costs a round trip per column operation.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings(input_bytes, cores).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
