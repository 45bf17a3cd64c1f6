"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on for plans that adapt to the data; sizes are left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


MIB = 1024**2


def sized_for(shuffled_bytes: int) -> dict[str, str]:
    """Shuffle and scan sizes for a job that shuffles about so many bytes.

    A task gets about 200 MiB of a shuffle, until there would be more than 40,000 partitions; beyond that
    the partitions grow (their sorts spill), because every map task writes a piece for every partition.
    Scan tasks grow with them for the same reason. Adaptive execution merges what turns out small.
    """
    partitions = min(max(200, -(-shuffled_bytes // (200 * MIB))), 40_000)
    scan = min(max(128 * MIB, shuffled_bytes // 100_000), 1024 * MIB)
    return {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.files.maxPartitionBytes": str(scan)}


def spark_session(app: str = "tidemark", shuffled_bytes: int | None = None, **conf: str) -> SparkSession:
    """A session with ``DEFAULTS``; ``conf`` wins over them. For a job of many terabytes give
    ``shuffled_bytes``, the size of the largest source that is deduplicated."""
    builder = SparkSession.builder.appName(app)
    sized = sized_for(shuffled_bytes) if shuffled_bytes else {}
    for key, value in {**DEFAULTS, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session (tests, one machine) gets a temporary folder when the setting is absent;
    on a cluster such a folder would be invisible to the other machines, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and cut its lineage, so that later passes read the same rows even
    after executors are lost."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder name in the shared folder that nothing else has."""
    return f"{shared_dir(spark).rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, with what is in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
