"""What every plan returns: rows with a split, and how to save them with their figures."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from sluice.functions.bpe import Vocabulary
from sluice.operators import sinks
from sluice.operators.cut import Boundary
from sluice.operators.lots import LOTS, Part, read_lots, write_lots
from sluice.operators.publish import attempt, publish
from sluice.operators.rank import partitions_for
from sluice.operators.stage import Stage, plain


@dataclass
class Corpus:
    """Rows with a ``split`` column, the figures known before writing, and what to measure on writing.

    ``tokens`` names the token count column, ``row_count`` is the number of rows as the plan knows it. ``rows_of``
    makes the rows that come from a part of the inputs, and ``ends`` is where they were cut.
    """

    rows: DataFrame
    names: tuple[str, str]
    figures: dict
    figure_types: str
    vocabulary: Vocabulary | None = None
    tokens: str | None = None
    row_count: int | None = None
    rows_of: Callable[[Part], DataFrame] | None = None
    ends: Sequence[Boundary | None] = ()

    def metadata_schema(self) -> str:
        counts = ", ".join(f"{n}_samples long" for n in self.names)
        tokens = ", total_tokens long, mean_tokens_per_sample double" if self.tokens else ""
        return f"{self.figure_types}, {counts}, total_samples long{tokens}, location string, created string"

    def save(self, path: str) -> dict:
        """Write splits, metadata and markers and publish them at once: a run that dies on the way leaves ``path`` as it
        was. The figures come from the writing pass, not a second one."""
        spark, folder = self.rows.sparkSession, attempt(path)
        measures = [
            F.count_if(F.col("split") == name).alias(f"{name}_samples") for name in self.names
        ]
        if self.tokens:
            measures.append(F.coalesce(F.sum(self.tokens), F.lit(0)).alias("total_tokens"))
        seen = sinks.write_splits(self.rows, folder, measures, small=self.names[1:])
        rows = seen["rows_written"]
        record = dict(self.figures)
        record |= {f"{name}_samples": seen[f"{name}_samples"] for name in self.names}
        record["total_samples"] = rows
        if self.tokens:
            record["total_tokens"] = seen["total_tokens"]
            record["mean_tokens_per_sample"] = seen["total_tokens"] / rows if rows else 0.0
        record["location"] = path
        record["created"] = datetime.now(timezone.utc).isoformat()
        sinks.write_metadata(spark, record, self.metadata_schema(), folder)
        if self.vocabulary:
            sinks.write_markers(self.vocabulary.marker_table(spark), folder)
        publish(spark, path, folder)
        return record

    def in_lots(self, path: str, lots: int = LOTS, max_lots: int | None = None) -> "Corpus | None":
        """The corpus with its rows written to ``path`` lot by lot, from where an earlier run stopped; None if ``max_lots``
        ended it before. The inputs must be read from files, the same ones in every run."""
        ends = [(end.last, end.rows) if end else None for end in self.ends]
        figures = {k: v for k, v in self.figures.items() if k != "name"}  # which may have the day in it
        plan = {"figures": figures, "ends": ends, "rows": self.row_count}
        if not write_lots(self.rows.sparkSession, self.rows_of, path, plan, lots, self.tokens, F.col("split"), max_lots):
            return None
        return replace(self, rows=read_lots(self.rows.sparkSession, path, self.rows), rows_of=None)

    def save_shards(
        self, path: str, keys: Sequence[Column], stage: Stage, shard_rows: int = sinks.SHARD_ROWS
    ) -> None:
        """Write the rows as JSON-lines shards of exact size, in the order of ``keys``.

        The rows are staged before: ordering them evaluates them twice.
        """
        staged = stage.write(self.rows, "unordered")
        partitions = partitions_for(self.rows.sparkSession, staged.count)
        sinks.write_shards(sinks.with_shards(staged.rows, keys, stage, shard_rows, partitions), path, partitions)

    def read(self, path: str, split: str | None = None) -> DataFrame:
        return sinks.read_splits(self.rows.sparkSession, path, plain(self.rows.schema), split)
