"""What several of the operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.sources.tables import fresh_dir

SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
BATCH_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here.

    Every later plan sees the same rows, also those that hold ids which depend
    on how the rows were dealt out when they were written.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lean_batches(spark: SparkSession) -> None:
    """Let Spark hand texts to Python in batches of ``BATCH_BYTES`` at most.

    Texts may be of any length, so a number of rows bounds nothing. A smaller
    setting of the session stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name)
    if now.rstrip("b") in ("-1", "67108864"):  # no bound, or Spark's own
        spark.conf.set(name, str(BATCH_BYTES))


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def with_key(docs: DataFrame, key: Column) -> DataFrame:
    """_doc, _key, _all: the id, a key and the whole row, so that no column of ``docs`` can clash."""
    return docs.select(F.col("doc_id").alias("_doc"), key.alias("_key"), F.struct("*").alias("_all"))


def once_per_key(keyed: DataFrame) -> DataFrame:
    """Rows of :func:`with_key`, one per (_doc, _key).

    Whole rows are shuffled to drop repeats only if a count of the keys (an id
    and a hash a row, combined before the shuffle) finds any.
    """
    repeated = keyed.groupBy("_doc", "_key").count().where("count > 1")
    return keyed if repeated.isEmpty() else keyed.dropDuplicates(["_doc", "_key"])


def hash52(*parts: Column | str) -> Column:
    """52 bits of the MD5 of the parts' texts, joined by ``/``; other engines have it too."""
    joined = F.concat_ws("/", *(p if isinstance(p, Column) else F.lit(p) for p in parts))
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("long")


def spread(docs: DataFrame, *order: str) -> DataFrame:
    """Stage rows in the order of some columns, with a ``row_id`` that grows along it.

    ``row_id >> 33`` numbers the ranges ("chunks") that the rows were dealt to.
    A last sort key per row keeps a value that very many rows share from
    filling one range.
    """
    keys = [*order, "_row"]
    ranged = (
        docs.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_row")
    )
    return staged(ranged.withColumn("row_id", F.monotonically_increasing_id()), "spread")


def running(rows: DataFrame, size: Column, out: str, *groups: str) -> DataFrame:
    """Add ``out``: the sum of ``size`` over the rows before, by ``row_id``, per group.

    ``rows`` come from :func:`spread`. No task sees a whole group: it is summed
    chunk by chunk, and the sums of the chunks (a row per group and chunk) are
    added up and joined back.
    """
    rows = rows.withColumn("_chunk", F.shiftright("row_id", 33)).withColumn("_size", size)
    before = Window.partitionBy(*groups).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        rows.groupBy(*groups, "_chunk")
        .agg(F.sum("_size").alias("_sum"))
        .withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .drop("_sum")
    )
    for g in groups:
        bases = bases.withColumnRenamed(g, f"_of_{g}")
    same = F.col("_chunk") == F.col("_of_chunk")
    for g in groups:
        same &= F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    within = (
        Window.partitionBy("_chunk", *groups)
        .orderBy("row_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn(out, F.coalesce(F.sum("_size").over(within), F.lit(0)))
        .join(bases.withColumnRenamed("_chunk", "_of_chunk"), same)
        .withColumn(out, (F.col(out) + F.col("_base")).cast("long"))
        .drop("_chunk", "_size", "_base", "_of_chunk", *(f"_of_{g}" for g in groups))
    )
