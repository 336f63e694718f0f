"""How many partitions a shuffle should have, by the size of what is read."""

from __future__ import annotations

from pyspark.sql import DataFrame

SHUFFLE_BYTES = 8 << 20
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_UNKNOWN = 1 << 60  # Spark's size of a relation that it knows nothing about is larger


def _leaves(df: DataFrame) -> list[int]:
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the relations that ``df`` reads, as far as Spark knows them; runs no job.

    The sum over the leaves of the plan: Spark's own figure for a join is the
    product of its sides.
    """
    return sum(size for size in _leaves(df) if size < _UNKNOWN)


def partitions(df: DataFrame, each: int) -> int:
    """A partition per ``each`` of stored bytes, and one per core at least.

    Where Spark does not know the size of all that is read, the session's number
    of shuffle partitions at least.
    """
    session = df.sparkSession
    least = session.sparkContext.defaultParallelism
    if any(size >= _UNKNOWN for size in _leaves(df)):
        least = int(session.conf.get("spark.sql.shuffle.partitions"))
    return max(-(-stored_bytes(df) // each), least)


def surely_below(df: DataFrame, limit: int) -> bool:
    """Whether all that ``df`` reads is known to Spark and at most ``limit`` stored bytes; runs no job."""
    return sum(_leaves(df)) <= limit


def lean_shuffles(df: DataFrame) -> None:
    """Let Spark hand a task ``SHUFFLE_BYTES`` of shuffled rows where it puts small partitions together.

    That size counts compressed bytes. Rows of ids and short tags shrink tenfold
    and are sorted several times in one stage, so that Spark's own 64 MB take
    gigabytes of a task. An explicit number of partitions would keep adaptive
    execution from splitting a frequent key. Another setting of the session stays.
    """
    conf = df.sparkSession.conf
    if conf.get(ADVISORY).lower() in ("67108864b", "67108864", "64m", "64mb"):
        conf.set(ADVISORY, str(SHUFFLE_BYTES))
