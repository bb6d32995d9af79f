"""A pass over tables of files, taken a lot of files at a time: a job that dies goes on after its last finished lot.

A file belongs to a lot by a hash of its path, so no list of files is kept, and a lot's scan prunes the files of the others
before it opens any. A lot's rows go to a folder of their own, then a record of the totals so far. A lot that was
interrupted left no record; it is run again and overwrites its folder. A plan, whatever the rows depend on, is written
before the first lot; a run with another plan is refused, as its rows would not fit those that are there.
"""

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.operators import sinks
from sluice.operators.stage import plain
from sluice.sources.tables import is_folder, read_small, write_small

LOTS = 64
ROWS_FOLDER, PLAN_FILE, LOT = "rows", "_plan", "sluice_lot"

Part = Callable[[DataFrame], DataFrame]


def lot_of(lots: int) -> Column:
    """The lot of the file that a row is read from."""
    return F.pmod(F.xxhash64("_metadata.file_path"), F.lit(lots))


def write_lots(
    spark: SparkSession, rows_of: Callable[[Part], DataFrame], path: str, plan: Mapping, lots: int = LOTS,
    tokens: str | None = None, group: Column | None = None, max_lots: int | None = None,
) -> bool:
    """Write the rows to ``path`` from where the last run stopped; False if ``max_lots`` ended it before.

    ``rows_of`` makes the rows of the inputs as a function narrows them: it must apply that to each of its inputs, right
    where it is read from files, and make every row from one input row (no join or aggregate of different files).
    ``plan`` is what all runs must agree on, as JSON. Records have totals by ``group``, a string of few values.
    """
    _agree(spark, path, json.dumps({"lots": lots, **plan}, sort_keys=True, default=str))
    last = sinks.latest_progress(spark, path)
    first = last["step"] + 1 if last else 0
    totals = {}
    if last:
        counts, sums = (last["progress"][f] for f in ("examples_per_source", "tokens_per_source"))
        totals = {name: (counts[name], sums[name]) for name in counts}
    for lot in range(first, lots):
        if max_lots is not None and lot - first == max_lots:
            return False
        rows = rows_of(lambda scan: scan.where(lot_of(lots) == lot))
        folder = f"{path}/{ROWS_FOLDER}/{LOT}={lot}"
        rows.write.mode("overwrite").parquet(folder)
        for name, count, weight in _totals(spark.read.schema(plain(rows.schema)).parquet(folder), tokens, group):
            before = totals.get(name, (0, 0))
            totals[name] = (before[0] + count, before[1] + weight)
        record = [(name, count, weight) for name, (count, weight) in totals.items()]
        sinks.write_progress(spark.createDataFrame(record, "source string, samples long, tokens long"), path, lot)
    return True


def read_lots(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows of all finished lots, with the columns of ``like``."""
    folder, last = f"{path}/{ROWS_FOLDER}", sinks.latest_progress(spark, path)
    if last is None or not is_folder(spark, folder):
        return spark.createDataFrame([], plain(like.schema))
    rows = spark.read.schema(plain(like.schema).add(LOT, "long")).parquet(folder)
    return rows.where(F.col(LOT) <= last["step"]).drop(LOT)


def _agree(spark: SparkSession, path: str, plan: str) -> None:
    place = f"{path}/{PLAN_FILE}"
    if not write_small(spark, place, plan, replace_it=False) and read_small(spark, place) != plan:
        raise ValueError(f"{path} was begun with other inputs or parameters: {read_small(spark, place)}, not {plan}")


def _totals(rows: DataFrame, tokens: str | None, group: Column | None) -> list[tuple[str, int, int]]:
    """(group, rows, tokens) of a lot that is written, from the columns that this needs."""
    weight = F.coalesce(F.sum(tokens), F.lit(0)).cast("long") if tokens else F.lit(0).cast("long")
    name = group if group is not None else F.lit("")
    return [tuple(r) for r in rows.groupBy(name.alias("name")).agg(F.count("*"), weight.alias("tokens")).collect()]
