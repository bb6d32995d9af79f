"""What several operators of this package share."""

import atexit
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from sluice.operators.stage import Stage

_stages: list[Stage] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query_stage(spark: SparkSession) -> Stage:
    """The stage folder of one query; its result is read lazily, so it stays until ``release``."""
    stage = Stage(spark)
    _stages.append(stage)
    return stage


@atexit.register
def release() -> None:
    """Remove the stage folders of all queries, as long as their session lives."""
    while _stages:
        stage = _stages.pop()
        if stage.spark.sparkContext._jsc is not None:
            stage.close()


def per_text(prepare: Callable[[], Callable[[str], object]], kind: pa.DataType, ddl: str) -> Callable[[Column], Column]:
    """An Arrow function of a text column. ``prepare`` runs once in a task and gives the function of one text.

    A null text is passed as an empty one. One text at a time is held as a Python string. The function counts
    as non-deterministic, so that Spark evaluates it once however often its column is used.
    """

    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = prepare()
        for batch in batches:
            yield pa.array([one(value.as_py() or "") for value in batch], kind)

    return arrow_udf(work, ddl).asNondeterministic()


def text_key(text: Column) -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def matrix(column: pa.Array, width: int = 0, fill: int = 0) -> np.ndarray:
    """Lists of longs as rows of one width, at least ``width``, shorter ones filled up."""
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    width = max(width, int(sizes.max(initial=0)))
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(column), width)
    out = np.full((len(column), width), fill, np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out
