"""Session settings for large runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Merge small shuffle partitions up to the target size, not just down to the core count.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def shuffle_partitions(largest_shuffle_bytes: int, partition_bytes: int = 128 * 2**20) -> int:
    """Partitions that keep each shuffle task near ``partition_bytes``, never under 200."""
    return max(200, -(-largest_shuffle_bytes // partition_bytes))


def configure(
    builder: SparkSession.Builder, largest_shuffle_bytes: int
) -> SparkSession.Builder:
    """Apply the settings, with shuffles sized for the largest one expected.

    Adaptive execution merges partitions that turn out small, so a generous estimate
    costs little, while a low one makes tasks spill.
    """
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.config(
        "spark.sql.shuffle.partitions", str(shuffle_partitions(largest_shuffle_bytes))
    )
