"""Corpus statistics: partial aggregates on narrow columns."""

from pyspark.sql import Column, DataFrame, functions as F


def token_measures(tokens: Column) -> list[Column]:
    """Number, total, mean (0 for none), smallest and largest of the token counts that are not null."""
    return [
        F.count(tokens).alias("samples"),
        F.coalesce(F.sum(tokens), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.avg(tokens), F.lit(0.0)).alias("mean_tokens"),
        F.min(tokens).alias("min_tokens"),
        F.max(tokens).alias("max_tokens"),
    ]


def retention_measures(kept: Column) -> list[Column]:
    """Rows before and after a filter, and the percentage kept."""
    before, after = F.count("*"), F.count_if(kept)
    return [
        before.alias("original_rows"),
        after.alias("filtered_rows"),
        F.when(before > 0, after / before * 100).otherwise(0.0).alias("retained_percent"),
    ]


def token_stats(rows: DataFrame, tokens: str = "tokencount") -> DataFrame:
    return rows.agg(*token_measures(F.col(tokens)))


def retention(rows: DataFrame, kept: Column) -> DataFrame:
    return rows.agg(*retention_measures(kept))


def source_totals(rows: DataFrame, tokens: Column | None = None) -> DataFrame:
    """Samples and tokens per source."""
    measures = [F.count("*").alias("samples")]
    if tokens is not None:
        measures.append(F.sum(tokens).alias("tokens"))
    return rows.groupBy("source").agg(*measures)


def source_totals_with_overall(rows: DataFrame, tokens: Column) -> DataFrame:
    """``source_totals`` and one more row, with a null source, over all of them."""
    return rows.rollup("source").agg(F.count("*").alias("samples"), F.sum(tokens).alias("tokens"))


def by_source(measure: str) -> Column:
    """A map of the measure by source, sources in name order; those without a value are left out."""
    pairs = F.collect_list(F.when(F.col(measure).isNotNull(), F.struct("source", measure)))
    return F.map_from_entries(F.array_sort(pairs))


def record_measures() -> list[Column]:
    """The figures of a progress record over (source, samples, tokens) rows, one for each configured source."""
    return [
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("total_tokens"),
        by_source("tokens").alias("tokens_per_source"),
        by_source("samples").alias("examples_per_source"),
        F.coalesce(F.sum("samples"), F.lit(0)).alias("examples_collected"),
    ]


def progress_record(totals: DataFrame) -> DataFrame:
    return totals.agg(*record_measures())


def split_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("split").agg(F.count("*").alias("samples"))


def require_rows(count: int, what: str = "rows collected") -> None:
    if count == 0:
        raise ValueError(f"no {what}")
