"""Session settings and the few plan-time helpers that need a running session."""

from __future__ import annotations

import re
import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A group no larger than this may be handled by one task (one window partition,
# one percentile buffer, one Python group). Larger groups take the split form.
GROUP_ROWS_CONF = "spark.obsframe.maxGroupRows"
GROUP_ROWS_DEFAULT = 1_000_000

# A side is broadcast only after its materialised size was counted against this.
BROADCAST_CELLS_CONF = "spark.obsframe.maxBroadcastCells"
BROADCAST_CELLS_DEFAULT = 2_000_000


def local_session(cores: int | str = 8, app: str = "obsframe") -> SparkSession:
    """Session for tests and the local benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(GROUP_ROWS_CONF, str(GROUP_ROWS_DEFAULT)))


def broadcast_cells(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_CELLS_CONF, str(BROADCAST_CELLS_DEFAULT)))


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only in a local session without it."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="obsframe-"))
        current = sc.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so later stages neither recompute nor reshuffle it."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by ``keys`` into a stated number of tasks.

    Before heavy per-group work: left to itself, adaptive execution would merge
    the partitions by their few bytes and run all groups in one task.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *keys)


def same(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> Column:
    """Null-safe equality over column pairs: a null key is a key like any other."""
    return reduce(
        lambda a, b: a & b, [left[lc].eqNullSafe(right[rc]) for lc, rc in pairs.items()]
    )


def bounded_rows(small: DataFrame) -> bool:
    """Whether an already materialised frame is small enough, counted, to be broadcast."""
    rows = max(1, broadcast_cells(small.sparkSession) // max(1, len(small.columns)))
    return small.limit(rows + 1).count() <= rows


def bounded(small: DataFrame) -> DataFrame:
    """Hint a broadcast for an already materialised frame if its counted size allows it."""
    return F.broadcast(small) if bounded_rows(small) else small


def attach(rows: DataFrame, stats: DataFrame, on: tuple[str, ...], how: str = "left") -> DataFrame:
    """Bring per-group statistics back to the rows they came from.

    The statistics are materialised once and counted; below the bound the rows
    are not shuffled at all, above it Spark joins the two sides by their key.
    """
    small = bounded(cut(stats))
    return link(rows, small, on, how)


def link(rows: DataFrame, other: DataFrame, on: tuple[str, ...], how: str = "left") -> DataFrame:
    """Null-safe equi-join that keeps one copy of the join columns."""
    if not on:  # ``other`` is a global aggregate: one row
        return link(rows.withColumn("__all", F.lit(1)), other.withColumn("__all", F.lit(1)), ("__all",), how).drop("__all")
    names = {c: f"__j_{c}" for c in on}
    for old, new in names.items():
        other = other.withColumnRenamed(old, new)
    return rows.join(other, same(rows, other, names), how).drop(*names.values())
