"""Running figures of a pass while it runs: rows, tokens and tokens a second, as its tasks end.

The tokens go through a function that leaves them as they are and counts them. Only that column goes to Python and back.
A task's counts reach the driver with its end, once for each task of a writing stage however often it is tried, so the
last figures are the totals; a record is noted as they arrive, at most one in so many seconds.
"""

import threading
import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import AccumulatorParam
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.functions import arrow_udf

RECORD_SCHEMA = "seconds double, rows long, tokens long, tokens_per_second double"
EVERY_SECONDS = 10.0


class _Totals(AccumulatorParam):
    """(rows, tokens) added up. On the driver, where ``noted`` is a function, each new sum is passed to it."""

    noted = None

    def zero(self, value):
        return 0, 0

    def addInPlace(self, value1, value2):
        total = value1[0] + value2[0], value1[1] + value2[1]
        if self.noted:
            self.noted(total)
        return total

    def __reduce__(self):
        return _Totals, ()


class Meter:
    """Figures of one pass over rows; ``column`` goes into the pass, ``records`` may be read at any time."""

    def __init__(self, spark: SparkSession, every: float = EVERY_SECONDS):
        self.spark, self.every = spark, every
        self._lock, self._records, self._last = threading.Lock(), [], (0, 0)
        self._started = time.monotonic()
        totals = _Totals()
        self._totals = spark.sparkContext.accumulator((0, 0), totals)
        totals.noted = self._note

    def column(self, tokens: Column) -> Column:
        """The same numbers, counted as they pass; a null counts as a row without tokens."""
        totals = self._totals

        def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                totals.add((len(batch), pc.sum(batch).as_py() or 0))
                yield batch

        return arrow_udf(counted, "long").asNondeterministic()(tokens.cast("long"))

    def _note(self, total: tuple[int, int]) -> None:
        with self._lock:
            self._last, seconds = total, time.monotonic() - self._started
            if not self._records or seconds - self._records[-1][0] >= self.every:
                self._records.append(self._record(seconds, total))

    @staticmethod
    def _record(seconds: float, total: tuple[int, int]) -> tuple[float, int, int, float]:
        return seconds, *total, total[1] / seconds if seconds > 0 else 0.0

    def records(self) -> list[tuple[float, int, int, float]]:
        """(seconds, rows, tokens, tokens a second), rising; the last is of what has been counted by now."""
        with self._lock:
            behind = self._last != (self._records[-1][1:3] if self._records else (0, 0))
            return [*self._records, *([self._record(time.monotonic() - self._started, self._last)] if behind else [])]

    def table(self) -> DataFrame:
        return self.spark.createDataFrame(self.records(), RECORD_SCHEMA)
