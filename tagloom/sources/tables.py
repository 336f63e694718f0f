"""Reading and writing the relational tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators.sizes import surely_below
from tagloom.schemas import ALL_BATCHES, COOCCURRENCE, LOADED, RELEASED, STATUS_LOG, TABLES


LOADS_BYTES = 4 << 20  # of stored loads and states, that joins broadcast


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors reach, for checkpoints and written tables.

    It is the session's ``spark.checkpoint.dir``. Where that is unset, a session
    whose executors are threads of the driver gets a temporary folder; on a
    cluster, where executors would write to their own disks, it is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        configured = tempfile.mkdtemp(prefix="tagloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A folder name below :func:`shared_dir` that nobody else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def batch_text(tweets: DataFrame, batch: str | None = None) -> DataFrame:
    """Ids and texts of one batch, or of all with ``None`` or ``"None"``."""
    if batch is not None and batch != ALL_BATCHES:
        tweets = tweets.where(F.col("batch_name") == batch)
    return tweets.select("tweet_id", "text")


def new_batches(batches: DataFrame) -> DataFrame:
    """Names of the batches that wait for processing."""
    return batches.where(F.col("batch_status") == "NEW").select("batch_name")


def read_cooccurrence(spark: SparkSession, path: str) -> DataFrame:
    """The stored co-occurrence table."""
    return spark.read.schema(COOCCURRENCE).parquet(path)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def reset_tables(spark: SparkSession, database: str, names: tuple[str, ...] = tuple(TABLES)) -> None:
    """Create the output tables, empty; existing ones are emptied."""
    for name in names:
        empty = spark.createDataFrame([], TABLES[name])
        empty.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")


def _open(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A Parquet table, or None as long as nothing was written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, empty as long as nothing was written."""
    table = _open(spark, path, schema)
    if table is None:  # of a size that Spark knows
        return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
    return table


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def live_loads(spark: SparkSession, out: str) -> DataFrame:
    """batch_name, load: the last load that has written a batch below ``out``."""
    rows = read_if_exists(spark, f"{out}/batches", LOADED)
    return rows.groupBy("batch_name").agg(F.max("load").alias("load"))


def batch_states(spark: SparkSession, out: str) -> DataFrame:
    """batch_name, load, batch_status, released, live: every load that registered a batch below ``out``.

    A load registers its batches as NEW; the status log (``status``, written by
    :func:`set_stored_status`) holds later changes, of which the one with the
    largest ``seq`` counts. A load is released once it has been SUCCESS, whatever
    came after, as posts that were given back keep their name ``NONE``. ``live``
    marks the last load of each batch. One row per registered batch and load, so
    the table grows with the loads, not with the posts.
    """
    registered = read_if_exists(spark, f"{out}/batches", LOADED).select("batch_name", "load").distinct()
    log = read_if_exists(spark, f"{out}/status", STATUS_LOG)
    latest = log.groupBy("batch_name", "load").agg(
        F.max_by("batch_status", "seq").alias("_status"),
        F.max(F.col("batch_status") == "SUCCESS").alias("_released"),
    )
    last = registered.groupBy("batch_name").agg(F.max("load").alias("_last"))
    return (
        registered.join(latest, ["batch_name", "load"], "left")
        .join(last, "batch_name")
        .select(
            "batch_name",
            "load",
            F.coalesce("_status", F.lit("NEW")).alias("batch_status"),
            F.coalesce("_released", F.lit(False)).alias("released"),
            (F.col("load") == F.col("_last")).alias("live"),
        )
    )


def visible_loads(spark: SparkSession, out: str) -> DataFrame:
    """batch_name, load, released, shown: loads whose rows are read, and the batch name they show.

    These are the last load of every batch and all released loads; released
    rows show ``NONE``.
    """
    states = batch_states(spark, out).where(F.col("live") | F.col("released"))
    shown = F.when(F.col("released"), F.lit(RELEASED)).otherwise(F.col("batch_name"))
    return states.select("batch_name", "load", "released", shown.alias("shown"))


def set_stored_status(spark: SparkSession, out: str, name: str, status: str) -> bool:
    """Set the status of a stored batch (its last load); ``SUCCESS`` also releases its posts.

    The change is appended to the status log below ``out``; no table of posts is
    rewritten, so it costs the same for a batch of any size. Released posts show
    the batch name ``NONE`` from then on, also after the batch is loaded again.
    An unknown name changes nothing and gives False. One writer at a time.
    """
    from tagloom.schemas import STATUSES

    if status not in STATUSES:
        raise ValueError(f"unknown status {status!r}")
    live = live_loads(spark, out).where(F.col("batch_name") == name).first()
    if live is None:
        return False
    log = read_if_exists(spark, f"{out}/status", STATUS_LOG)
    seq = (log.agg(F.max("seq")).first()[0] or 0) + 1
    change = spark.createDataFrame([(name, live.load, status, seq)], STATUS_LOG)
    change.coalesce(1).write.mode("append").parquet(f"{out}/status")
    return True


def release_stored_batch(spark: SparkSession, out: str, name: str) -> bool:
    """Give back the posts of a stored batch: it is set to SUCCESS (see :func:`set_stored_status`)."""
    return set_stored_status(spark, out, name, "SUCCESS")


def read_ingested(
    spark: SparkSession, out: str, table: str, loads: DataFrame | None = None, batch: str | None = None
) -> DataFrame:
    """A table written by ``write_ingest``.

    ``batches``: a row per batch with its latest status. Other tables: the rows
    of each batch's last load, and of every released load with the batch name
    ``NONE``. ``loads`` (batch_name, load, shown, as :func:`visible_loads`) may
    leave loads out. Loads to read are a small table that Spark joins to the
    rows by (batch_name, load); it is broadcast where its stored size is known to
    be below ``LOADS_BYTES``, as the rows of a few batches, shuffled by these
    columns, would fill as few tasks.

    ``batch`` keeps the rows that show that name (``"None"``: all). Its loads are
    looked up first, a few rows of the register, so that the scan reads their
    ``load=`` folders only and pushes the stored names down to Parquet.
    """
    if table == "batches":
        states = batch_states(spark, out).where("live").select("batch_name", "batch_status")
        return states if batch is None or batch == ALL_BATCHES else states.where(F.col("batch_name") == batch)
    rows = spark.read.parquet(f"{out}/{table}")
    loads = visible_loads(spark, out) if loads is None else loads
    if batch is not None and batch != ALL_BATCHES:
        wanted = loads.where(F.col("shown") == batch).select("batch_name", "load", "shown").collect()
        loads = spark.createDataFrame(wanted, "batch_name string, load long, shown string")
        rows = rows.where(
            F.col("load").isin(sorted({r.load for r in wanted})) & F.col("batch_name").isin(sorted({r.batch_name for r in wanted}))
        )
        loads = F.broadcast(loads)  # the loads of one name
    elif surely_below(loads, LOADS_BYTES):
        loads = F.broadcast(loads)
    columns = [F.col("shown").alias(c) if c == "batch_name" else c for c in rows.columns if c != "load"]
    return rows.join(loads.select("batch_name", "load", "shown"), ["batch_name", "load"]).select(*columns)
