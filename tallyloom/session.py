"""Session settings for clusters and for tests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

CLUSTER = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A group larger than this in one shuffle partition is split.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    # Split it even where that costs another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Plans over hundreds of columns are built from as many expressions; recording where in the
    # Python source each was made takes longer than making it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Whole texts cross to Python; bound a batch by rows as well as by bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def shuffle_partitions(input_bytes: int, per_partition: int = 128 << 20, floor: int = 200) -> int:
    """Initial shuffle partitions for an input size; adaptive execution merges what is too small."""
    return max(floor, min(100_000, -(-input_bytes // per_partition)))


def build_session(
    app: str = "tallyloom",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(CLUSTER)
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
