"""Files as they arrive: filter and store them once, keep progress, and stop each source at its budget.

Every job runs with ``availableNow``: it takes what has arrived since the last run and ends. The checkpoint
folder remembers the files taken, so an interrupted run goes on where it stopped. Batch outputs are folders
named by the batch, overwritten if a batch is run again, so a repeated batch adds nothing.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.order import by_position
from sluice.operators.cut import find_boundaries
from sluice.operators.cut_table import boundary_table, keep_by_table
from sluice.operators.stage import Stage, plain
from sluice.operators.stats import source_totals
from sluice.sources.tables import is_folder, table

PROGRESS_SCHEMA = "source string, samples long, tokens long, batch_id long"
# What each source has taken up to and with a batch: only the latest batch before one is read.
TOTALS_SCHEMA = "source string, samples long, tokens long, total_samples long, total_tokens long"


def arriving(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int | None = None,
    pattern: str | None = None, file_format: str = "parquet",
) -> DataFrame:
    """Files of a folder as a stream, oldest first."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def ingest(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Store new rows; a second run over the same files stores nothing."""
    query = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", out)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest_with_progress(rows: DataFrame, tokens: str, out: str, progress: str, checkpoint: str) -> StreamingQuery:
    """Store new rows and, per batch, the samples and tokens of each source.

    The totals are taken from the batch as it was stored, so the sources are read once.
    """
    spark = rows.sparkSession
    schema = plain(rows.schema)

    def store(batch: DataFrame, batch_id: int) -> None:
        path = f"{out}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        stored = spark.read.schema(schema).parquet(path)
        totals = source_totals(stored, F.col(tokens))
        totals.coalesce(1).write.mode("overwrite").parquet(f"{progress}/batch_id={batch_id}")

    return _run(rows, store, checkpoint)


def ingest_budgeted(
    rows: DataFrame,
    position: str,
    tokens: str,
    targets: DataFrame,
    out: str,
    progress: str,
    checkpoint: str,
    total: int | None = None,
) -> StreamingQuery:
    """Per source, accept arriving rows until the tokens accepted so far reach the source's target.

    ``targets`` has (source, target), and with a ``total`` the sources' ``source_order``. Sources without a target are left
    out. Rows of a batch are taken in position order, earlier batches before later ones. What a source has taken is read
    from the record of the batch before, and the batch is cut by the distributed search of ``boundary_table``: a source that
    makes up most of the stream is not gathered into one task, and however many sources there are, none of their rows
    comes to the driver. The row that reaches the target is kept; a source yields its first row even for a target of 0.

    A ``total`` bounds all sources together, in their order. What an earlier source will have taken when it is done is not
    known while it is still arriving, so a later one is accepted as far as the earlier ones may leave of the total, by what
    they have taken so far; ``read_under_total`` then says which of its rows are within the total.
    """
    spark = rows.sparkSession
    order = by_position(position)

    def store(batch: DataFrame, batch_id: int) -> None:
        before = batch_totals(spark, progress, batch_id - 1)
        limits = _limits(targets, before, total)
        with Stage(spark) as stage:
            wanted = batch.join(limits.where("limit > 0").select(F.col("source").alias("_open")), F.col("source") == F.col("_open"), "left_semi")
            weights = stage.write(wanted.select("source", position, tokens), "weights", narrow=True)
            ends, count = boundary_table(weights.rows, order, limits, "source", stage, weight=tokens, rows_known=weights.count)
            keep_by_table(wanted, ends, count, order, "source").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            taken = ends.select("source", F.col("kept_rows").alias("samples"), F.col("kept_weight").alias("tokens"))
            record = before.select("source", "total_samples", "total_tokens").join(taken, "source", "full").na.fill(0)
            record.select(
                "source", "samples", "tokens", (F.col("total_samples") + F.col("samples")).alias("total_samples"),
                (F.col("total_tokens") + F.col("tokens")).alias("total_tokens"),
            ).coalesce(1).write.mode("overwrite").parquet(f"{progress}/batch_id={batch_id}")

    return _run(rows, store, checkpoint)


def _limits(targets: DataFrame, before: DataFrame, total: int | None) -> DataFrame:
    """(source, limit): what each source may still take."""
    state = targets.join(before.select("source", "total_tokens"), "source", "left")
    started, taken = F.col("total_tokens").isNotNull(), F.coalesce("total_tokens", F.lit(0))
    if total is None:
        return state.select("source", F.when(started, F.col("target") - taken).otherwise(F.greatest(F.lit(1), "target")).alias("limit"))
    # A row for each configured source, in their order.
    so_far = Window.partitionBy(F.lit(0)).orderBy("source_order").rowsBetween(Window.unboundedPreceding, 0)
    left = total - F.sum(taken).over(so_far)
    fresh = F.when((F.col("source_order") > 0) & (left <= 0), F.lit(0)).otherwise(F.greatest(F.lit(1), F.least("target", left)))
    return state.select("source", F.when(started, F.least(F.col("target") - taken, left)).otherwise(fresh).alias("limit"))


def read_under_total(
    spark: SparkSession, position: str, tokens: str, targets: DataFrame, total: int, out: str, progress: str, schema: T.StructType
) -> DataFrame:
    """The accepted rows that the sources' targets and the total leave, as if the stream had ended now.

    Sources follow each other in ``source_order``, a row for each. A source takes rows until its target or the total is reached; so an
    earlier one's excess shrinks a later one. Records tell in which batch a source's end falls: only that batch is searched.
    """
    batches, accepted = read_progress(spark, progress), read_batches(spark, out, schema)
    spent, parts = 0, []
    for index, source in enumerate(targets.orderBy("source_order").collect()):
        if index and spent >= total:
            break
        limit, own = max(1, min(source["target"], total - spent)), F.col("source") == source["source"]
        running = Window.partitionBy("source").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
        before = batches.where(own).withColumn("before", F.coalesce(F.sum("tokens").over(running), F.lit(0)))
        last = before.where(F.col("before") + F.col("tokens") >= limit).orderBy("batch_id").first()
        mine = accepted.where(own)
        if last is None:
            spent += batches.where(own).agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
            parts.append(mine)
            continue
        batch = mine.where(F.col("batch_id") == last["batch_id"])
        end = find_boundaries(batch, by_position(position), limit - last["before"], weight=tokens)[""]
        parts.append(mine.where((F.col("batch_id") < last["batch_id"]) | (F.col("batch_id") == last["batch_id"]) & end.keeps()))
        spent += last["before"] + end.weight
    return reduce(DataFrame.unionByName, parts) if parts else accepted.limit(0)


def read_batches(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches, with their ``batch_id``."""
    with_batch = T.StructType([*plain(schema).fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(with_batch).option("basePath", out).parquet(out)


def read_progress(spark: SparkSession, progress: str) -> DataFrame:
    """(source, samples, tokens, batch_id); empty before the first batch."""
    if not is_folder(spark, progress):
        return table(spark, [], PROGRESS_SCHEMA)
    return spark.read.schema(PROGRESS_SCHEMA).parquet(progress)


def batch_totals(spark: SparkSession, progress: str, batch_id: int) -> DataFrame:
    """(source, samples, tokens, total_samples, total_tokens): the record of a batch, empty before the first.

    Every batch leaves one before the next begins: an interrupted batch is run again first.
    """
    path = f"{progress}/batch_id={batch_id}"
    return spark.read.schema(TOTALS_SCHEMA).parquet(path) if is_folder(spark, path) else table(spark, [], TOTALS_SCHEMA)


def _run(rows: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    query = (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
