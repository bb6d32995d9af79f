"""

The reference's inputs are stood in for by two tables: ``documents`` is web text, except its source
``src0``, which is math text; in ``conversations`` each user turn followed by an assistant turn is a
(prompt, text) pair. Budgets and targets are shares of the tables, so they grow with them.
"""

from __future__ import annotations

import atexit
import os
import sys
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import query_sql
from query_sql import BUDGET_RATIOS, CLUSTER_GAP, CLUSTERS, LONG_TEXT, PAD, SEED, SHARD
from sluice.functions import text as tx
from sluice.functions.bpe import Vocabulary, decoded, positions_of, token_count, token_ids
from sluice.functions.order import by_position, shuffled
from sluice.operators import checks, mixture, sinks, split, stats
from sluice.operators.budget import BudgetSource, coupled_budgets, take_budgets
from sluice.operators.cut import find_boundaries, inside, keep, share_of_total
from sluice.operators.cut_table import boundary_table, keep_by_table
from sluice.operators.draw import draw
from sluice.operators.meter import Meter
from sluice.operators.stage import Stage
from sluice.plans.inspection import first_row_report
from sluice.plans.instruct import MAX_TOKENS, VAL_RATIO, capped_instruct_corpus, count_in_lots, instruct_corpus
from sluice.plans.pretrain import pretrain_by_samples, pretrain_by_tokens
from sluice.plans.resumable import take_by_tokens, taken_corpus
from sluice.sources.tables import (
    Source, conform, open_source, open_sources, optional, read_shards, read_string_fields, spread, tagged_text,
)
from sluice.streaming import ingest as streams

# The language-model operators can be taken away: the other queries do without them.
try:
    import corpus_pipeline
    from sluice.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "sluice.llm"):
        raise
    corpus_pipeline = llm_queries = None

PAIR = ("conv_id", "turn")
MERGES = (b"an", b"on", b"ion")
DAY = date(2024, 5, 6)
# Files of few rows, so that small tables too have several in each lot.
LOTS, LOT_FILE_ROWS = 4, 1000
SHARD_SCHEMA = "position long, text string, source string, shard long"

_stages: list[Stage] = []


# Inputs


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_source(spark, Source("documents", f"{sf_dir}/documents.parquet"))


def estimated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, token_count) of all documents."""
    return documents(spark, sf_dir).select(
        "doc_id", "source", tx.estimated_tokens(F.col("text")).alias("token_count")
    )


def mixture_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rows = documents(spark, sf_dir).withColumnRenamed("lang", "language")
    web, math = BUDGET_RATIOS
    return {web: rows.where("source <> 'src0'"), math: rows.where("source = 'src0'").drop("language")}


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns joined to the next turn by (conversation, turn): a long conversation spreads over all tasks."""
    turns = spread(open_source(spark, Source("conversations", f"{sf_dir}/conversations.parquet")))
    users = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    answers = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), "text"
    )
    return users.join(answers, ["conv_id", "turn"])


def instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs as instructions, with the conversation's system turn as context.

    A conversation that holds most pairs is split by the adaptive skew join.
    """
    turns = open_source(spark, Source("conversations", f"{sf_dir}/conversations.parquet"))
    context = turns.where("role = 'system'").select("conv_id", F.col("text").alias("context"))
    return (
        pairs(spark, sf_dir)
        .join(context, "conv_id", "left")
        .select(
            *PAIR,
            F.col("prompt").alias("instruction"),
            "context",
            F.col("text").alias("response"),
            F.lit(None).cast("string").alias("category"),
        )
    )


def formatted(spark: SparkSession, sf_dir: str, separator: str = "\n") -> DataFrame:
    return pairs(spark, sf_dir).select(
        *PAIR,
        tx.chat(tx.strip(F.col("prompt")), tx.strip(F.col("text")), separator).alias("formattedconversation"),
    )


def counted(spark: SparkSession, sf_dir: str, vocabulary: Vocabulary, separator: str = "\n") -> DataFrame:
    return formatted(spark, sf_dir, separator).withColumn(
        "tokencount", token_count(F.col("formattedconversation"), vocabulary)
    )


def public_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary.from_file(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def staged(spark: SparkSession) -> Stage:
    """Stage folder of one query. Its result is read lazily, so the folder stays until ``release``."""
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


def half_of(rows: DataFrame) -> int:
    return rows.agg(F.coalesce(F.sum("token_count"), F.lit(0))).first()[0] // 2


# Filters and formats


def min_length_english(spark, sf_dir):
    web = Source(
        "web", f"{sf_dir}/documents.parquet", optional={"lang": "string"},
        predicate="lang IS NULL OR lang = 'en'",
    )
    rows = tagged_text(open_source(spark, web), web, "doc_id")
    return rows.where(tx.long_enough(F.col("text")))


def nonblank_stripped(spark, sf_dir):
    padded = F.concat(F.lit(PAD), F.col("text"), F.lit(PAD))
    rows = documents(spark, sf_dir).select("doc_id", padded.alias("text"))
    return rows.where(tx.non_blank(F.col("text"))).select("doc_id", tx.strip(F.col("text")).alias("text"))


def string_fields(spark, sf_dir):
    value = F.when(F.col("lang") == "en", F.to_json(F.struct(F.col("source").alias("id"), "text"))).otherwise(
        F.to_json(F.struct(F.col("source").alias("id"), F.col("n_chars").alias("text")))
    )
    lines = documents(spark, sf_dir).select(value.alias("value"))
    path = f"{staged(spark).path}/lines"
    lines.write.mode("overwrite").text(path)
    return read_string_fields(spark, path, "id", "text").groupBy("id").agg(
        F.count("*").alias("n_lines"), F.count("text").alias("n_texts"), F.sum(F.length("text")).alias("n_chars")
    )


def chat_pairs_newline(spark, sf_dir):
    return formatted(spark, sf_dir)


def chat_pairs_literal(spark, sf_dir):
    return formatted(spark, sf_dir, "\\n")


def conformed_columns(spark, sf_dir):
    rows = documents(spark, sf_dir)
    schema = spark.createDataFrame([], "text string, source string, url string, token_count bigint").schema
    full = rows.withColumns(
        {"url": optional(rows, "url"), "token_count": tx.estimated_tokens(F.col("text")).cast("int")}
    )
    return conform(full, schema)


def preview(spark, sf_dir):
    rows = formatted(spark, sf_dir).withColumn("key", shuffled(SEED, *PAIR).hash_text())
    return rows.orderBy("key", *PAIR).limit(1).select(
        *PAIR, tx.preview(F.col("formattedconversation")).alias("preview")
    )


# Tokens


def token_estimate_by_source(spark, sf_dir):
    return stats.source_totals(estimated(spark, sf_dir), F.col("token_count"))


def token_estimate_overall(spark, sf_dir):
    return stats.source_totals_with_overall(estimated(spark, sf_dir), F.col("token_count"))


def by_conversation(rows: DataFrame) -> DataFrame:
    return rows.groupBy("conv_id").agg(
        F.count("*").alias("samples"), F.sum("tokencount").alias("tokens"), F.max("tokencount").alias("longest")
    )


def bpe_count_bytes(spark, sf_dir):
    return by_conversation(counted(spark, sf_dir, Vocabulary.bytes_only()))


def bpe_count_merges(spark, sf_dir):
    return by_conversation(counted(spark, sf_dir, Vocabulary.with_merges(*MERGES)))


def bpe_count_50k(spark, sf_dir):
    return by_conversation(counted(spark, sf_dir, public_vocabulary()))


def bpe_documents_50k(spark, sf_dir):
    rows = spread(documents(spark, sf_dir)).select(
        "source", token_count(F.col("text"), public_vocabulary()).alias("token_count")
    )
    return stats.source_totals(rows, F.col("token_count"))


def token_ids_head(spark, sf_dir):
    vocabulary = public_vocabulary()
    ids = formatted(spark, sf_dir).select(
        *PAIR, token_ids(F.col("formattedconversation"), vocabulary).alias("ids")
    )
    heads = ids.groupBy(F.slice("ids", 1, 50).alias("head")).agg(F.count("*").alias("samples"))
    return heads.withColumn("text", decoded(F.col("head"), vocabulary))


def decode_roundtrip(spark, sf_dir):
    vocabulary = public_vocabulary()
    rows = spread(documents(spark, sf_dir)).select("source", "text", token_ids(F.col("text"), vocabulary).alias("ids"))
    back = rows.select("source", "text", decoded(F.col("ids"), vocabulary).alias("back"))
    return back.groupBy("source").agg(
        F.count("*").alias("samples"), F.count_if(F.col("back") == F.col("text")).alias("same"),
        F.sum(F.length("back")).alias("n_chars"),
    )


def sample_inspection(spark, sf_dir):
    corpus = _instruct(spark, sf_dir, Vocabulary.bytes_only())
    key = shuffled(SEED, *PAIR).key()
    report = first_row_report(corpus.rows, [key], Vocabulary.bytes_only())
    places = {c: F.concat_ws(",", F.col(c).cast("array<string>")) for c in ("starts", "ends")}
    return report.select("preview", "tokens", *[v.alias(c) for c, v in places.items()])


def sample_inspection_50k(spark, sf_dir):
    corpus, key = _instruct(spark, sf_dir, public_vocabulary()), shuffled(SEED, *PAIR).key()
    return first_row_report(corpus.rows, [key], public_vocabulary())


def marker_positions(spark, sf_dir):
    vocabulary = Vocabulary.bytes_only()
    marks = vocabulary.special_ids()
    ids = formatted(spark, sf_dir).select(
        *PAIR, token_ids(F.col("formattedconversation"), vocabulary).alias("ids")
    )

    def places(marker):
        return F.concat_ws(",", positions_of(F.col("ids"), marks[marker]).cast("array<string>"))

    return ids.select(
        *PAIR, places(tx.TURN_START).alias("starts"), places(tx.TURN_END).alias("ends")
    )


def length_capped(spark, sf_dir):
    rows = counted(spark, sf_dir, Vocabulary.bytes_only(), "\\n")
    return rows.where(F.col("tokencount") < MAX_TOKENS)


def length_capped_50k(spark, sf_dir):
    rows = counted(spark, sf_dir, public_vocabulary(), "\\n")
    return rows.where(F.col("tokencount") < MAX_TOKENS)


def token_stats(spark, sf_dir):
    return stats.token_stats(counted(spark, sf_dir, Vocabulary.bytes_only()))


def retention(spark, sf_dir):
    rows = counted(spark, sf_dir, Vocabulary.bytes_only(), "\\n")
    return stats.retention(rows, F.col("tokencount") < MAX_TOKENS)


# Cuts


def first_n_seeded(spark, sf_dir):
    usable = documents(spark, sf_dir).where(tx.non_blank(F.col("text"))).select("doc_id", "source")
    conditions = ("source <> 'src0'", "source = 'src0'")
    counts = [F.count_if(F.expr(c)).alias(f"rows_{i}") for i, c in enumerate(conditions)]
    ids = staged(spark).write(usable, "ids", counts, narrow=True)
    drawn = []
    for i, condition in enumerate(conditions):
        ends = find_boundaries(
            ids.rows.where(condition), shuffled(SEED + i, "doc_id"), share_of_total(0.3),
            rows_known=ids.figures[f"rows_{i}"],
        )
        drawn.append(F.expr(condition) & inside(ends))
    return usable.where(drawn[0] | drawn[1])


def drawn_sample(spark, sf_dir):
    rows = documents(spark, sf_dir)
    usable, count = rows.where(tx.language_is(F.col("lang"))).select("doc_id", "text"), rows.count()
    return draw(usable, ("doc_id",), count // 10, SEED, count, staged(spark), "sample").rows


def token_budget_per_source(spark, sf_dir):
    rows = documents(spark, sf_dir).withColumn("token_count", tx.estimated_tokens(F.col("text")))
    weights = staged(spark).write(rows.select("doc_id", "source", "token_count"), "weights", narrow=True)
    ends = find_boundaries(
        weights.rows, by_position("doc_id"), share_of_total(0.5), weight="token_count", group="source",
        rows_known=weights.count,
    )
    return keep(rows, ends, "source").select("doc_id", "text", "source", "token_count")


def token_budget_per_conversation(spark, sf_dir):
    """The first turns of each conversation, up to half its tokens: as many groups as there are conversations."""
    turns = open_source(spark, Source("conversations", f"{sf_dir}/conversations.parquet"))
    rows = turns.select("conv_id", "turn", "role", tx.estimated_tokens(F.col("text")).alias("token_count"))
    order = by_position("turn")
    ends, count = boundary_table(rows, order, share_of_total(0.5), "conv_id", staged(spark), weight="token_count")
    return keep_by_table(rows, ends, count, order, "conv_id")


def token_budget_coupled(spark, sf_dir):
    inputs = mixture_inputs(spark, sf_dir)
    rows = {
        name: r.where(tx.long_enough(F.col("text"))).select(
            "doc_id", "text", F.lit(name).alias("source"), tx.estimated_tokens(F.col("text")).alias("token_count")
        )
        for name, r in inputs.items()
    }
    total = half_of(rows["fineweb_edu"].unionByName(rows["open_web_math"]))
    targets = mixture.source_targets(total, BUDGET_RATIOS)
    ordered = [BudgetSource(name, inputs[name], rows[name], targets[name]) for name in BUDGET_RATIOS]
    cuts = coupled_budgets(ordered, total, "doc_id", F.col("token_count"), staged(spark))
    return take_budgets(ordered, cuts, ["doc_id", "source", "token_count"]).withColumn(
        "source_order", F.col("source_order").cast("long")
    )


def taken_first(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", "source")
    return split.take(rows, shuffled(SEED, "doc_id"), rows.count() // 4)


def skipped_first(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", "source")
    return split.skip(rows, by_position("doc_id"), rows.count() // 4)


# Mixtures


def sample_plan(spark, sf_dir):
    budgets = token_estimate_by_source(spark, sf_dir).select(
        "source",
        (F.col("tokens") * 100).alias("total_tokens"),
        F.lit(0.01).alias("secondary_share"),
        (F.col("source") != "src0").alias("with_secondary"),
    )
    return mixture.sample_plan(budgets)


def mixture_share(spark, sf_dir):
    label = F.when(F.col("source") == "src0", "open_web_math").otherwise("fineweb_edu")
    rows = estimated(spark, sf_dir).withColumn("source", label)
    totals = stats.source_totals(rows, F.col("token_count"))
    plan = mixture.plan_table(spark, mixture.preset_tokens("tiny"), BUDGET_RATIOS)
    return mixture.achieved_shares(plan, totals)


def progress_record(spark, sf_dir):
    """The nested record of all documents, made and written where the totals are, and read back."""
    path = staged(spark).path
    sinks.write_progress(token_estimate_by_source(spark, sf_dir), path, 0)

    def by_name(field):
        return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(f"progress.{field}")))).alias(field)

    return sinks.read_progress(spark, path).select(
        "progress.total_tokens",
        by_name("tokens_per_source"),
        by_name("examples_per_source"),
        "progress.examples_collected",
        (F.col("timestamp") > 1e9).alias("has_time"),
    )


def failed_checks(spark, sf_dir):
    """Plans and filters of each source: shares of another source's tokens, above 1 for most, and rows left by a filter
    that empties some."""
    totals = token_estimate_by_source(spark, sf_dir)
    least = F.min("tokens").over(Window.partitionBy(F.lit(0)))  # a row for each source
    shares = totals.select("source", (F.col("tokens") / (least * 2)).alias("share"))
    long_ones = stats.source_totals(documents(spark, sf_dir).where(F.length("text") >= LONG_TEXT))
    return checks.share_checks(shares, "source", "share").unionByName(checks.row_checks(totals, long_ones, "source"))


# Splits


def split_permutation(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", "source")
    return split.permutation_split(rows, "doc_id", val_ratio=VAL_RATIO, seed=SEED)


def split_permuted_order(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", "text")
    return split.permuted_split(rows, "doc_id", val_ratio=VAL_RATIO, seed=SEED, stage=staged(spark))


def split_take_skip(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", "source")
    return split.take_skip_split(rows, "doc_id", val_ratio=VAL_RATIO, seed=SEED)


def split_sizes(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id")
    by_permutation = split.permutation_split(rows, "doc_id", val_ratio=0.015, seed=SEED)
    by_take_skip = split.take_skip_split(rows, "doc_id", val_ratio=0.015, seed=SEED)
    return (
        stats.split_sizes(by_permutation).withColumn("rule", F.lit("permutation"))
        .unionByName(stats.split_sizes(by_take_skip).withColumn("rule", F.lit("take_skip")))
    )


def split_extremes(spark, sf_dir):
    """Splits with an empty side, written and read back."""
    rows, sizes = documents(spark, sf_dir).select("doc_id"), []
    for ratio in (0.0, 1.0):
        path = staged(spark).path
        divided = split.permutation_split(rows, "doc_id", val_ratio=ratio, seed=SEED)
        sinks.write_splits(divided, path)
        for name in ("train", "val"):
            back = sinks.read_splits(spark, path, divided.schema, name)
            sizes.append(back.agg(F.lit(ratio).alias("ratio"), F.lit(name).alias("split"), F.count("*").alias("samples")))
    return sizes[0].unionByName(sizes[1]).unionByName(sizes[2]).unionByName(sizes[3])


# Sources


def subset_source(spark, sf_dir):
    """The registered subset of a source and another one, each opened by its folder."""
    path = f"{staged(spark).path}/web"
    rows = documents(spark, sf_dir)
    for subset in ("en", "fr"):
        rows.where(F.col("lang") == subset).drop("lang").write.parquet(f"{path}/{subset}/train")
    web = Source("web", path, subset="en", split="train")
    chosen = [open_source(spark, s).withColumn("subset", F.lit(s.subset)) for s in (web, web.with_subset("fr"))]
    return chosen[0].unionByName(chosen[1]).select("doc_id", "source", "subset")


def missing_source(spark, sf_dir):
    """A mixture of which one source cannot be opened: it has no rows."""
    sources = [Source("present", f"{sf_dir}/documents.parquet"), Source("missing", f"{sf_dir}/no-such-table.parquet")]
    opened = open_sources(spark, sources, documents(spark, sf_dir).schema, on_missing="empty")
    counted_rows = [
        rows.agg(F.lit(name).alias("source"), F.count("*").alias("samples"), F.count("text").alias("texts"))
        for name, rows in opened.items()
    ]
    return counted_rows[0].unionByName(counted_rows[1])


# Outputs


def sharded(spark, sf_dir, stage):
    rows = documents(spark, sf_dir).where(tx.long_enough(F.col("text")))
    rows = rows.select("doc_id", "text", "source")
    return sinks.with_shards(rows, [F.col("source"), F.col("doc_id")], stage, SHARD)


def shard_counts(spark, sf_dir):
    stage = staged(spark)
    sinks.write_shards(sharded(spark, sf_dir, stage), f"{stage.path}/shards")
    shards = read_shards(spark, f"{stage.path}/shards", SHARD_SCHEMA).withColumn("file", F.input_file_name())
    return shards.groupBy("shard").agg(
        F.count("*").alias("samples"), F.min("position").alias("first"), F.max("position").alias("last"),
        F.count_distinct("file").alias("files"),
    )


def shard_roundtrip(spark, sf_dir):
    stage = staged(spark)
    rows = sharded(spark, sf_dir, stage).select("position", "text", "source", "shard")
    sinks.write_shards(rows, f"{stage.path}/shards")
    return read_shards(spark, f"{stage.path}/shards", SHARD_SCHEMA)


def bounded_files(spark, sf_dir):
    stage = staged(spark)
    rows = documents(spark, sf_dir).select("doc_id", "text", "source")
    sinks.write_bounded_files(rows, f"{stage.path}/files", SHARD)
    files = spark.read.schema("doc_id long, text string, source string").json(f"{stage.path}/files")
    per_file = files.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("samples"))
    return per_file.agg(
        F.sum("samples").alias("samples"), (F.max("samples") <= SHARD).alias("within_limit")
    )


def split_roundtrip(spark, sf_dir):
    stage = staged(spark)
    rows = split_permutation(spark, sf_dir)
    # A first corpus, replaced at once by the second.
    for corpus in (rows.where("split = 'val'"), rows):
        sinks.publish_splits(corpus, stage.path, small=["val"])
    return sinks.read_splits(spark, stage.path, rows.schema)


def chunk_roundtrip(spark, sf_dir):
    chunks = staged(spark).write(estimated(spark, sf_dir), "chunks", file_rows=25_000).rows
    return chunks.groupBy("source").agg(F.count("*").alias("samples"), F.sum("token_count").alias("tokens"))


def _instruct(spark, sf_dir, vocabulary):
    stage = staged(spark)
    source = stage.write(pairs(spark, sf_dir), "pairs")
    return instruct_corpus(
        spread(source.rows), PAIR, vocabulary, stage, target_rows=source.count * 3 // 4, input_rows=source.count
    )


def run_metadata(spark, sf_dir):
    corpus, path = _instruct(spark, sf_dir, Vocabulary.with_merges(*MERGES)), staged(spark).path
    corpus.save(path)
    return sinks.read_metadata(spark, corpus.metadata_schema(), path).drop("created", "location", "format_version")


def written_totals(spark, sf_dir):
    """The running figures of a write, as its own pass observes them."""
    rows = estimated(spark, sf_dir).withColumn("split", F.lit("train"))
    seen = sinks.write_splits(rows, staged(spark).path, [F.sum("token_count").alias("tokens")])
    return spark.createDataFrame(
        [(seen["rows_written"], seen["tokens"], seen["tokens"] / seen["seconds"] > 0)],
        "samples long, tokens long, has_rate boolean",
    )


def running_figures(spark, sf_dir):
    """The figures of one write as its tasks end: they rise, several times, to the totals."""
    rows, meter = estimated(spark, sf_dir).repartition(8).withColumn("split", F.lit("train")), Meter(spark, every=0)
    sinks.write_splits(rows.withColumn("token_count", meter.column(F.col("token_count"))), staged(spark).path)
    in_order = Window.partitionBy(F.lit(0)).orderBy("seconds", "rows")  # a row for each task
    before = [F.coalesce(F.lag(c).over(in_order), F.lit(0)).alias(f"{c}_before") for c in ("rows", "tokens")]
    return meter.table().select("*", *before).agg(
        F.max("rows").alias("samples"),
        F.max("tokens").alias("tokens"),
        (F.count("*") > 1).alias("several"),
        F.every((F.col("rows") > F.col("rows_before")) & (F.col("tokens") > F.col("tokens_before"))).alias("rising"),
        F.every(F.col("tokens_per_second") > 0).alias("has_rate"),
    )


def marker_sidecar(spark, sf_dir):
    vocabulary = Vocabulary.bytes_only()
    marks = vocabulary.special_ids()
    ids = formatted(spark, sf_dir).select(token_ids(F.col("formattedconversation"), vocabulary).alias("ids"))
    per_row = ids.select(*[F.size(positions_of(F.col("ids"), i)).alias(token) for token, i in marks.items()])
    found = per_row.agg(*[F.coalesce(F.sum(f"`{t}`"), F.lit(0)).alias(t) for t in marks]).unpivot(
        [], list(marks), "token", "occurrences"
    )
    path = staged(spark).path
    sinks.write_markers(vocabulary.marker_table(spark), path)
    return sinks.read_markers(spark, path).join(found, "token")


def corpus_name(spark, sf_dir):
    seen = stats.token_stats(estimated(spark, sf_dir), "token_count").first()
    names = [
        ("budget", sinks.budget_name("corpus", "Tiny", seen["total_tokens"], seen["samples"], DAY)),
        ("thousands", sinks.thousands_name("corpus", seen["samples"], seen["total_tokens"])),
    ]
    return spark.createDataFrame(names, "kind string, name string")


# Streams


def _arrivals(spark, sf_dir, take, rows=None):
    """Let documents, all if no ``rows`` are given, arrive in two lots of several files, by position, and take what has
    arrived after each, and once more; ``take`` is given the stream."""
    stage = staged(spark)
    if rows is None:
        rows = documents(spark, sf_dir).select("doc_id", "source", tx.estimated_tokens(F.col("text")).alias("token_count"), "text")
    half = rows.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    for lot in (F.col("doc_id") <= half, F.col("doc_id") > half, None):
        if lot is not None:
            rows.where(lot).repartition(3).write.mode("append").parquet(f"{stage.path}/in")
        take(streams.arriving(spark, f"{stage.path}/in", rows.schema), stage.path)
    return rows.schema, stage.path


def ingest_resumed(spark, sf_dir):
    def take(rows, path):
        streams.ingest(rows.where(tx.long_enough(F.col("text"))), f"{path}/out", f"{path}/checkpoint")

    schema, path = _arrivals(spark, sf_dir, take)
    return spark.read.schema(schema).parquet(f"{path}/out").select("doc_id", "source", "token_count")


def progress_by_batch(spark, sf_dir):
    def take(rows, path):
        streams.ingest_with_progress(rows, "token_count", f"{path}/out", f"{path}/progress", f"{path}/checkpoint")

    _, path = _arrivals(spark, sf_dir, take)
    progress = streams.read_progress(spark, f"{path}/progress")
    return progress.groupBy("source").agg(
        F.sum("samples").alias("samples"), F.sum("tokens").alias("tokens"), F.max("batch_id").alias("last_batch")
    )


def stream_budget(spark, sf_dir):
    halves = token_estimate_by_source(spark, sf_dir).select("source", F.expr("tokens div 2").alias("target"))
    targets = staged(spark).write(halves, "targets").rows

    def take(rows, path):
        streams.ingest_budgeted(
            rows, "doc_id", "token_count", targets, f"{path}/out", f"{path}/progress", f"{path}/checkpoint"
        )

    schema, path = _arrivals(spark, sf_dir, take)
    return streams.read_batches(spark, f"{path}/out", schema).select("doc_id", "source", "token_count")


def stream_budget_coupled(spark, sf_dir):
    """``token_budget_coupled`` over rows that arrive in two lots, each with rows of both sources."""
    inputs = [
        rows.where(tx.long_enough(F.col("text"))).select("doc_id", F.lit(name).alias("source"), tx.estimated_tokens(F.col("text")).alias("token_count"))
        for name, rows in mixture_inputs(spark, sf_dir).items()
    ]
    rows = inputs[0].unionByName(inputs[1])
    total = half_of(rows)
    planned = mixture.source_targets(total, BUDGET_RATIOS)
    targets = spark.createDataFrame([(n, t, i) for i, (n, t) in enumerate(planned.items())], "source string, target long, source_order long")

    def take(arriving, path):
        streams.ingest_budgeted(
            arriving, "doc_id", "token_count", targets, f"{path}/out", f"{path}/progress", f"{path}/checkpoint", total
        )

    schema, path = _arrivals(spark, sf_dir, take, rows)
    kept = streams.read_under_total(spark, "doc_id", "token_count", targets, total, f"{path}/out", f"{path}/progress", schema)
    return kept.join(targets, "source").select("doc_id", "source", "token_count", "source_order")


# Whole corpora


def instruct(spark, sf_dir):
    return _instruct(spark, sf_dir, Vocabulary.with_merges(*MERGES)).rows


def instruct_resumed(spark, sf_dir):
    """``instruct`` over files, a lot of files at a time, stopped after one of them and taken up again."""
    stage, vocabulary = staged(spark), Vocabulary.with_merges(*MERGES)
    source = stage.write(pairs(spark, sf_dir), "pairs", file_rows=LOT_FILE_ROWS)
    for max_lots in (1, None):
        corpus = instruct_corpus(
            source.rows, PAIR, vocabulary, stage, target_rows=source.count * 3 // 4, input_rows=source.count
        ).in_lots(f"{stage.path}/lots", LOTS, max_lots)
    return corpus.rows


def instruct_50k(spark, sf_dir):
    return _instruct(spark, sf_dir, public_vocabulary()).rows


def instruct_capped(spark, sf_dir):
    vocabulary = Vocabulary.with_merges(*MERGES)
    return capped_instruct_corpus(instructions(spark, sf_dir), PAIR, vocabulary, staged(spark)).rows


def instruct_capped_resumed(spark, sf_dir):
    """``instruct_capped`` with the counting done a lot of files at a time, stopped and taken up again."""
    stage, vocabulary = staged(spark), Vocabulary.with_merges(*MERGES)
    source = stage.write(instructions(spark, sf_dir), "instructions", file_rows=LOT_FILE_ROWS)
    path = f"{stage.path}/lots"
    count_in_lots(source.rows, vocabulary, path, lots=LOTS, max_lots=1)
    return capped_instruct_corpus(
        source.rows, PAIR, vocabulary, stage, input_rows=source.count, counted_path=path, lots=LOTS
    ).rows


def instruct_capped_50k(spark, sf_dir):
    return capped_instruct_corpus(instructions(spark, sf_dir), PAIR, public_vocabulary(), staged(spark)).rows


def by_samples(spark, sf_dir):
    rows = documents(spark, sf_dir)
    web, math = rows.where("source <> 'src0'"), rows.where("source = 'src0'")
    counts = rows.agg(F.count_if(F.col("source") != "src0"), F.count_if(F.col("source") == "src0")).first()
    return pretrain_by_samples(
        web, math, ("doc_id",), staged(spark), total_tokens=200 * sum(counts), input_rows=tuple(counts)
    ).rows


def by_samples_resumed(spark, sf_dir):
    """``by_samples`` over files, a lot of files at a time, stopped after one of them and taken up again."""
    stage = staged(spark)
    rows = stage.write(documents(spark, sf_dir), "documents", file_rows=LOT_FILE_ROWS).rows
    web, math = rows.where("source <> 'src0'"), rows.where("source = 'src0'")
    counts = rows.agg(F.count_if(F.col("source") != "src0"), F.count_if(F.col("source") == "src0")).first()
    for max_lots in (1, None):
        corpus = pretrain_by_samples(
            web, math, ("doc_id",), stage, total_tokens=200 * sum(counts), input_rows=tuple(counts)
        ).in_lots(f"{stage.path}/lots", LOTS, max_lots)
    return corpus.rows


def by_tokens(spark, sf_dir):
    inputs = mixture_inputs(spark, sf_dir)
    total = half_of(estimated(spark, sf_dir))
    corpus = pretrain_by_tokens(inputs, "doc_id", staged(spark), total)
    return corpus.rows.select("doc_id", "text", "source", "split")


def resumed(spark, sf_dir):
    """``by_tokens`` in steps, stopped after two of them and taken up again."""
    inputs, path = mixture_inputs(spark, sf_dir), staged(spark).path
    tokens, count = estimated(spark, sf_dir).agg(F.sum("token_count"), F.count("*")).first()
    for max_steps in (2, None):
        take_by_tokens(inputs, "doc_id", path, tokens // 2, step_rows=max(1, count // 5), max_steps=max_steps)
    return taken_corpus(spark, path, "doc_id", staged(spark), tokens // 2).rows.select("doc_id", "text", "source", "split")


def resumed_sparse(spark, sf_dir):
    """``resumed`` by positions in far clusters over nearly 2^60: the steps follow the rows."""
    place = F.expr(f"doc_id % {CLUSTERS} * {CLUSTER_GAP} + doc_id")
    inputs = {name: rows.withColumn("place", place) for name, rows in mixture_inputs(spark, sf_dir).items()}
    path = staged(spark).path
    tokens, count = estimated(spark, sf_dir).agg(F.sum("token_count"), F.count("*")).first()
    for max_steps in (2, None):
        take_by_tokens(inputs, "place", path, tokens // 2, step_rows=max(1, count // 5), max_steps=max_steps)
    return taken_corpus(spark, path, "place", staged(spark), tokens // 2).rows.select(
        F.col("place").alias("position"), "text", "source", "split"
    )


def by_exact_tokens(spark, sf_dir):
    inputs = mixture_inputs(spark, sf_dir)
    total = documents(spark, sf_dir).agg(F.sum(F.octet_length("text"))).first()[0] // 2
    inputs = {name: spread(rows) for name, rows in inputs.items()}
    corpus = pretrain_by_tokens(inputs, "doc_id", staged(spark), total, vocabulary=Vocabulary.bytes_only())
    return corpus.rows.select("doc_id", "text", "source", "split")


def entry(spark: SparkSession) -> DataFrame:
    """The token-budget mix of sf0.001: rows and estimated tokens per source and split."""
    rows = by_tokens(spark, "/root/testdata/sf0.001")
    return rows.groupBy("source", "split").agg(
        F.count("*").alias("samples"), F.sum(tx.estimated_tokens(F.col("text"))).alias("tokens")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return reference_queries()
    return reference_queries() | llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}


def reference_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "min_length_english": min_length_english,
        "nonblank_stripped": nonblank_stripped,
        "string_fields": string_fields,
        "chat_pairs_newline": chat_pairs_newline,
        "chat_pairs_literal": chat_pairs_literal,
        "conformed_columns": conformed_columns,
        "preview": preview,
        "token_estimate_by_source": token_estimate_by_source,
        "token_estimate_overall": token_estimate_overall,
        "bpe_count_bytes": bpe_count_bytes,
        "bpe_count_merges": bpe_count_merges,
        "bpe_count_50k": bpe_count_50k,
        "bpe_documents_50k": bpe_documents_50k,
        "token_ids_head": token_ids_head,
        "decode_roundtrip": decode_roundtrip,
        "marker_positions": marker_positions,
        "sample_inspection": sample_inspection,
        "sample_inspection_50k": sample_inspection_50k,
        "length_capped": length_capped,
        "length_capped_50k": length_capped_50k,
        "token_stats": token_stats,
        "retention": retention,
        "first_n_seeded": first_n_seeded,
        "drawn_sample": drawn_sample,
        "token_budget_per_source": token_budget_per_source,
        "token_budget_per_conversation": token_budget_per_conversation,
        "token_budget_coupled": token_budget_coupled,
        "taken_first": taken_first,
        "skipped_first": skipped_first,
        "sample_plan": sample_plan,
        "mixture_share": mixture_share,
        "progress_record": progress_record,
        "failed_checks": failed_checks,
        "split_permutation": split_permutation,
        "split_permuted_order": split_permuted_order,
        "split_take_skip": split_take_skip,
        "split_sizes": split_sizes,
        "split_extremes": split_extremes,
        "subset_source": subset_source,
        "missing_source": missing_source,
        "shard_counts": shard_counts,
        "shard_roundtrip": shard_roundtrip,
        "bounded_files": bounded_files,
        "split_roundtrip": split_roundtrip,
        "chunk_roundtrip": chunk_roundtrip,
        "run_metadata": run_metadata,
        "written_totals": written_totals,
        "running_figures": running_figures,
        "marker_sidecar": marker_sidecar,
        "corpus_name": corpus_name,
        "ingest_resumed": ingest_resumed,
        "progress_by_batch": progress_by_batch,
        "stream_budget": stream_budget,
        "stream_budget_coupled": stream_budget_coupled,
        "instruct_corpus": instruct,
        "instruct_resumed": instruct_resumed,
        "instruct_corpus_50k": instruct_50k,
        "instruct_capped": instruct_capped,
        "instruct_capped_resumed": instruct_capped_resumed,
        "instruct_capped_50k": instruct_capped_50k,
        "pretrain_by_samples": by_samples,
        "pretrain_by_samples_resumed": by_samples_resumed,
        "pretrain_by_tokens": by_tokens,
        "pretrain_by_exact_tokens": by_exact_tokens,
        "pretrain_resumed": resumed,
        "pretrain_resumed_sparse": resumed_sparse,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for every query that SQL can express; the others are compared in the tests."""
    if llm_queries is None:
        return query_sql.oracle_sql()
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return query_sql.oracle_sql() | llm_queries.ORACLES | whole
