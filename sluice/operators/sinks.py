"""Outputs: split tables, JSON-lines shards of exact size, metadata records and names."""

import time
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, Row, functions as F, types as T

from sluice.operators.publish import attempt, publish, published
from sluice.operators.rank import ranked, width
from sluice.operators.stage import Stage, plain
from sluice.operators.stats import by_source, record_measures
from sluice.sources.tables import delete_path, folder_names, is_folder, read_small, write_small

# Fixed value: rows per JSON-lines shard.
SHARD_ROWS = 100_000

DATA_FOLDER, METADATA_FOLDER, MARKER_FOLDER, PROGRESS_FOLDER = "data", "metadata", "markers", "progress"
# The fields of a progress record.
PROGRESS_SCHEMA = (
    "progress struct<total_tokens: long, tokens_per_source: map<string,long>, examples_per_source: map<string,long>, "
    "examples_collected: long>, timestamp double"
)
RESUME_FIELDS = ("next_position", "last_position")
RECORD_SCHEMA = ", ".join([PROGRESS_SCHEMA, *[f"{c}s map<string,long>" for c in RESUME_FIELDS]])
LATEST_FILE = f"{PROGRESS_FOLDER}/_latest"


def write_splits(rows: DataFrame, path: str, measures: Sequence[Column] = (), small: Sequence[str] = ()) -> dict:
    """Write all splits together, one folder per split, so that reading one split prunes the others.

    Every task leaves a file per split. Those of the ``small`` splits are tiny, so these splits are read
    back and written again as few files; the others are not shuffled. Returns the ``measures``, collected by
    the writing pass itself, with the seconds it took.
    """
    seen, data = Observation(), f"{path}/{DATA_FOLDER}"
    started = time.monotonic()
    observed = rows.observe(seen, F.count("*").alias("rows_written"), *measures)
    observed.write.mode("overwrite").partitionBy("split").parquet(data)
    if small:
        _gather(rows.sparkSession, data, f"{path}/_{DATA_FOLDER}", plain(rows.schema), small)
    return {**seen.get, "seconds": time.monotonic() - started}


def publish_splits(rows: DataFrame, path: str, measures: Sequence[Column] = (), small: Sequence[str] = ()) -> dict:
    """``write_splits`` as an attempt that is published when all of it is written."""
    folder = attempt(path)
    seen = write_splits(rows, folder, measures, small)
    publish(rows.sparkSession, path, folder)
    return seen


def _gather(spark, data: str, aside: str, schema: T.StructType, splits: Sequence[str]) -> None:
    """The splits as few files, by way of a folder beside the data."""
    rows = spark.read.schema(schema).parquet(data).where(F.col("split").isin(*splits))
    rows.hint("rebalance").write.mode("overwrite").parquet(aside)
    gathered = spark.read.schema(schema).parquet(aside)
    writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("split")
    writer.parquet(data)
    delete_path(spark, aside)


def read_splits(spark, path: str, schema: T.StructType, split: str | None = None) -> DataFrame:
    """Rows of all splits or of one, of what is published at the path; an empty split has the same schema."""
    rows = spark.read.schema(schema).parquet(f"{published(spark, path)}/{DATA_FOLDER}")
    return rows if split is None else rows.where(F.col("split") == split)


def with_shards(
    rows: DataFrame,
    keys: Sequence[Column],
    stage: Stage,
    shard_rows: int = SHARD_ROWS,
    partitions: int | None = None,
    rows_known: int | None = None,
) -> DataFrame:
    """``rows`` with their global ``position`` in the order of ``keys`` and the ``shard`` it falls into.

    Every shard has exactly ``shard_rows`` rows, the last one the remainder.
    """
    placed, _ = ranked(rows, keys, stage, "position", partitions, rows_known)
    return placed.withColumn("shard", F.floor(F.col("position") / shard_rows))


def write_shards(rows: DataFrame, path: str, partitions: int | None = None) -> None:
    """JSON lines, one file per shard, in the order of ``position``; nulls are written, non-ASCII text stays readable.

    A shard's rows meet in one task, which holds few shards at a time: they are sorted by it.
    """
    partitions = partitions or width(rows)
    together = rows.repartition(*([partitions] if partitions else []), "shard").sortWithinPartitions("shard", "position")
    together.write.mode("overwrite").option("ignoreNullFields", False).partitionBy("shard").json(path)


def write_bounded_files(rows: DataFrame, path: str, file_rows: int = SHARD_ROWS) -> None:
    """JSON lines in files of at most ``file_rows`` rows, without ordering or numbering the rows."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).option(
        "maxRecordsPerFile", file_rows
    ).json(path)


def write_metadata(spark, figures: dict, schema: T.StructType | str, path: str) -> None:
    """One record as one JSON line beside the data."""
    record = spark.createDataFrame([figures], schema)
    record.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(
        f"{path}/{METADATA_FOLDER}"
    )


def read_markers(spark, path: str) -> DataFrame:
    return spark.read.schema("token string, id long").json(f"{published(spark, path)}/{MARKER_FOLDER}")


def read_metadata(spark, schema: T.StructType | str, path: str) -> DataFrame:
    return spark.read.schema(schema).json(f"{published(spark, path)}/{METADATA_FOLDER}")


def write_progress(totals: DataFrame, path: str, step: int) -> None:
    """The totals so far, with the time, as the record of one step; written again if the step is run again.

    ``totals`` has (source, samples, tokens), and may say at which ``next_position`` a source goes on, and its
    ``last_position``. The record is made where they are, without the driver. A pointer to it follows: a record
    without one is of a step that did not finish.
    """
    totals = totals.withColumns({c: F.lit(None).cast("long") for c in RESUME_FIELDS if c not in totals.columns})
    record = totals.agg(
        F.struct(*record_measures()).alias("progress"),
        (F.unix_micros(F.current_timestamp()) / 1e6).alias("timestamp"),
        *[by_source(c).alias(f"{c}s") for c in RESUME_FIELDS],
    )
    record.coalesce(1).write.mode("overwrite").json(f"{path}/{PROGRESS_FOLDER}/step={step}")
    write_small(totals.sparkSession, f"{path}/{LATEST_FILE}", str(step))


def read_progress(spark, path: str) -> DataFrame:
    """The records of all steps with their ``step``; none before the first."""
    folder = f"{path}/{PROGRESS_FOLDER}"
    if not is_folder(spark, folder):
        return spark.createDataFrame([], f"{RECORD_SCHEMA}, step long")
    return spark.read.schema(f"{RECORD_SCHEMA}, step long").json(folder)


def latest_progress(spark, path: str) -> Row | None:
    """The record of the last finished step, with its ``step``: the pointer and one record are read, whatever their number.

    The pointer may be missing for a moment while it is replaced; then the names of the records tell the last one.
    """
    step = read_small(spark, f"{path}/{LATEST_FILE}")
    if step is None:
        folder = f"{path}/{PROGRESS_FOLDER}"
        steps = [int(n.removeprefix("step=")) for n in folder_names(spark, folder) if n.startswith("step=")]
        whole = [s for s in sorted(steps, reverse=True) if "_SUCCESS" in folder_names(spark, f"{folder}/step={s}")]
        if not whole:
            return None
        step = whole[0]
    record = spark.read.schema(RECORD_SCHEMA).json(f"{path}/{PROGRESS_FOLDER}/step={step}")
    return record.withColumn("step", F.lit(int(step)).cast("long")).first()


def write_markers(markers: DataFrame, path: str) -> None:
    """(token, id) of the markers beside the data."""
    markers.coalesce(1).write.mode("overwrite").json(f"{path}/{MARKER_FOLDER}")


def budget_name(prefix: str, size: str, total_tokens: int, samples: int, day: date) -> str:
    """Name from the size label, millions of tokens, samples and the day."""
    return f"{prefix}-{size.lower()}-{total_tokens / 1_000_000:.1f}Mt-{samples}pt-{day:%Y%m%d}"


def thousands_name(prefix: str, rows: int, tokens: int, suffix: str = "512-seq") -> str:
    """Name from whole thousands of rows and tokens."""
    return f"{prefix}-{rows // 1000}K-samples-{tokens // 1000}K-tokens-{suffix}"
