"""Session settings the library is written for."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

from martflow.operators import files

ADAPTIVE = {
    # Adaptive execution sizes partitions, splits skewed join partitions and
    # turns shuffled joins with a small side into broadcast joins at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even if the grouping after it then needs a shuffle of
    # its own: a shuffle of folded rows costs less than one task with a third
    # of all rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
SETTINGS = {**ADAPTIVE, "spark.sql.session.timeZone": "UTC"}

MIB = 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, at_least: int, partition_bytes: int, most: int | None) -> int:
    wanted = max(at_least, math.ceil(shuffled_bytes / partition_bytes))
    return wanted if most is None else min(wanted, max(most, at_least))


def prepare(
    spark: SparkSession,
    *inputs: str,
    shuffled_bytes: int | None = None,
    partition_bytes: int = 128 * MIB,
    most_partitions: int | None = None,
    adaptive: bool = True,
) -> SparkSession:
    """Fit a running session to what its next plans shuffle; returns it.

    Sets one shuffle partition per ``partition_bytes``; adaptive execution merges
    those that turn out small, but it cannot make more of them. What is shuffled
    is the stored size of ``inputs``, or ``shuffled_bytes`` where there are no
    files to measure, as for a catalogue or a database. The setting is only
    raised. Without ``adaptive`` nothing but this setting is touched.

    There is no bound unless ``most_partitions`` gives one. Without it 100 TiB
    make 819,200 partitions; the driver holds about a byte per scan task and
    partition in the tracker of map outputs, so for such inputs read more bytes
    in a scan task (``spark.sql.files.maxPartitionBytes``) or give a bound and
    larger executors. A bound of 20,000 costs 5 GiB a partition at 100 TiB.
    """
    for name, value in ADAPTIVE.items() if adaptive else ():
        spark.conf.set(name, value)
    size = sum(files.size(spark, path) for path in inputs) if shuffled_bytes is None else shuffled_bytes
    present = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = shuffle_partitions(size, present, partition_bytes, most_partitions)
    if wanted != present:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


def local_session(cpus: int = 8, app_name: str = "martflow", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks.

    On a cluster use the cluster's own session together with ``SETTINGS``.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Noting the Python line of every column costs more than small queries do.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, folder: str | None = None) -> str:
    """The shared folder for intermediate tables.

    The given one, else that of ``spark.checkpoint.dir`` or
    ``SparkContext.setCheckpointDir``, else one below the session's warehouse.
    What the session names is shared by all its executors, also where it is a
    local path, as of a folder that every machine has mounted. A given folder
    of one machine is refused on a cluster: executors could not see it.
    """
    if not folder:
        named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch").rstrip("/")
    found = folder.rstrip("/")
    local = found.startswith(("file:", "/")) and spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:")
    if local and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{found} is a folder of one machine; set spark.checkpoint.dir to one every executor can reach")
    return found
