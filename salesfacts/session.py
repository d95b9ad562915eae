"""Session helpers for tests, the bench and local runs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "salesfacts") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Call-site capture on every Column call costs several py4j round trips
        # each; the job builds wide projections, so plan building is much faster off.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # The monthly roll-up and the final DISTINCT are wide aggregates whose
        # generated methods exceed the JVM's 8000-byte JIT limit; let the JIT
        # compile them instead of interpreting them (only applies when this
        # builder starts the JVM).
        .config("spark.driver.extraJavaOptions", os.environ.get("SALESFACTS_DRIVER_JAVA_OPTS", "-XX:-DontCompileHugeMethods"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def require_ansi(spark: SparkSession) -> None:
    """The job's results depend on ANSI mode: without it bad input becomes NULL silently."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("spark.sql.ansi.enabled must be true")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's spark.checkpoint.dir. Where it is unset, a local session
    (tests) gets a scratch folder; on a cluster that is an error, since executors
    do not share a machine's folders."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="salesfacts-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cluster_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20,
                 shuffle_bytes: int | None = None, max_shuffle_partitions: int = 100_000) -> dict[str, str]:
    """Settings for a cluster run, sized from the bytes the job scans.

    * scans split at ``partition_bytes`` (Parquet row groups permitting);
    * the initial shuffle width covers the largest shuffle, the daily
      aggregates, at ``partition_bytes`` per partition. Only the pruned columns
      are shuffled, after map-side partial aggregation, so ``shuffle_bytes``
      defaults to an eighth of the input. At least 2 waves of the cluster's
      cores, at most ``max_shuffle_partitions`` (map-status size on the
      driver grows with maps x reducers); AQE coalesces small partitions and
      splits skewed ones at run time;
    * broadcasts are decided from measured sizes (AQE), with a 64 MB cap;
    * executors JIT the wide aggregate methods.
    """
    est = shuffle_bytes if shuffle_bytes is not None else input_bytes // 8
    shuffle = min(max_shuffle_partitions, max(2 * total_cores, -(-est // partition_bytes)))
    return {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        # A material list too big to broadcast filters the fact scans by a Bloom filter, 10 bits a material or so.
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4g",
        "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "10000000",
        "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "40000000",
        "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(1 << 28),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
        "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
