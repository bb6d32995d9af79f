"""Opening sources as DataFrames with explicit schemas."""

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


@dataclass(frozen=True)
class Source:
    """A named input: where it lies, which column is its text, which rows pass, its share of the mixture.

    ``subset`` and ``split`` are parts of the path, so choosing them prunes before anything is read.
    ``predicate`` is a SQL condition; columns it needs that may be absent go into ``optional``.
    """

    name: str
    path: str
    subset: str | None = None
    split: str | None = None
    text_column: str = "text"
    predicate: str | None = None
    optional: dict[str, str] = field(default_factory=dict)
    ratio: float = 0.0
    format: str = "parquet"

    def location(self) -> str:
        return "/".join([self.path.rstrip("/"), *[p for p in (self.subset, self.split) if p]])

    def with_subset(self, subset: str | None) -> "Source":
        """The same source with another subset; None keeps the registered one."""
        return replace(self, subset=subset) if subset else self


def table(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """A small table from lists; no rows give an empty table of the same schema."""
    return spark.createDataFrame(rows, schema)


def open_source(
    spark: SparkSession, source: Source, schema: T.StructType | str | None = None, on_missing: str = "error"
) -> DataFrame:
    """Rows of a source; with ``on_missing="empty"`` one that cannot be opened has no rows.

    A source that may be missing needs a ``schema``.
    """
    if on_missing not in ("error", "empty"):
        raise ValueError(f"on_missing must be error or empty, got {on_missing}")
    reader = spark.read.format(source.format)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(source.location())
    except AnalysisException:
        if on_missing == "error" or schema is None:
            raise
        return table(spark, [], schema)


def open_sources(
    spark: SparkSession,
    sources: Iterable[Source],
    schema: T.StructType | str | None = None,
    on_missing: str = "error",
) -> dict[str, DataFrame]:
    """The rows of each source of a mixture, by name."""
    return {source.name: open_source(spark, source, schema, on_missing) for source in sources}


def optional(rows: DataFrame, column: str, type_name: str = "string") -> Column:
    """The column if the rows have it with this type, otherwise a typed null."""
    types = dict(rows.dtypes)
    if types.get(column) == type_name:
        return F.col(column)
    return F.lit(None).cast(type_name)


def tagged_text(rows: DataFrame, source: Source, *keep: str) -> DataFrame:
    """The source's accepted rows as (kept columns, text, source)."""
    if source.predicate:
        rows = rows.withColumns({c: optional(rows, c, t) for c, t in source.optional.items()})
        rows = rows.where(F.expr(source.predicate))
    return rows.select(
        *keep, F.col(source.text_column).alias("text"), F.lit(source.name).alias("source")
    )


def read_shards(spark: SparkSession, pattern: str, schema: T.StructType | str) -> DataFrame:
    """JSON-lines shards by glob. Spark keeps no order between files: shards carry a position column."""
    return spark.read.schema(schema).json(pattern)


def read_string_fields(spark: SparkSession, path: str, *fields: str) -> DataFrame:
    """JSON lines whose fields count only if they are strings; numbers, lists and absent fields are null.

    A string schema would turn 12 into "12"; here the type is looked at first.
    """
    parsed = spark.read.text(path).select(F.parse_json("value").alias("v"))
    return parsed.select(*[_string_field(F.col("v"), f).alias(f) for f in fields])


def _string_field(value: Column, name: str) -> Column:
    item = F.variant_get(value, f"$['{name}']", "variant")
    return F.when(F.schema_of_variant(item) == "STRING", F.variant_get(value, f"$['{name}']", "string"))


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns, in order and with their types; other columns are dropped."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def spread(rows: DataFrame) -> DataFrame:
    """Spread a scan over all cores if it is too small to fill them; a large scan stays as it is.

    For work that costs much per row, on input of fewer splits than cores. ``rows`` must be a plain scan.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if planned_splits(rows) < cores else rows


def planned_splits(rows: DataFrame) -> float:
    """Size of the rows in scan splits, as the optimizer estimates it; exact for a plain scan, no job runs."""
    split_bytes = rows.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() / split_bytes


def part_limit(rows: DataFrame) -> int:
    """Files that a result of these rows, no larger than they are, needs at most: two a scan split, and one a core.

    Shuffles may have many more parts than that, and each file of a part costs a task, a writer, and on a local disk
    without Hadoop's native library a process that sets its mode.
    """
    return max(rows.sparkSession.sparkContext.defaultParallelism, int(min(2 * planned_splits(rows), 1 << 30)) + 1)


def single_source_splits(rows: DataFrame) -> int | None:
    """``planned_splits`` of rows that are read from the files of one source; None where the size is a guess."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    if leaves.size() != 1 or leaves.head().getClass().getSimpleName() != "LogicalRelation":
        return None
    return int(planned_splits(rows)) + 1


def _place(spark: SparkSession, path: str):
    """A path and the file system it belongs to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def is_folder(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place) and files.getFileStatus(place).isDirectory()


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder through the file system it belongs to."""
    place, files = _place(spark, path)
    return files.delete(place, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder; none if there is no such folder."""
    place, files = _place(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []


def write_small(spark: SparkSession, path: str, text: str, replace_it: bool = True) -> bool:
    """Write a small file at once: a reader finds the old one, the new one, or for a moment none, but never a part.

    A file that is not to be replaced is written only if there is none of that name; False if there is one.
    """
    place, files = _place(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    out = files.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if replace_it:
        files.delete(place, False)
    elif files.exists(place):
        files.delete(aside, False)
        return False
    return files.rename(aside, place)


def modified(spark: SparkSession, path: str) -> int | None:
    """When a file was last written, in milliseconds of the file system's clock; None if there is none."""
    place, files = _place(spark, path)
    return files.getFileStatus(place).getModificationTime() if files.exists(place) else None


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    place, files = _place(spark, path)
    if not files.exists(place):
        return None
    source = files.open(place)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()
