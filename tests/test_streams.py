import time

import pytest
from pyspark.sql import Window, functions as F

from sluice.streaming import ingest as streams

SCHEMA = "pos long, source string, tokens long"


def arrive(spark, folder, rows):
    """One file, later than those before it."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    time.sleep(0.02)


@pytest.fixture
def folder(spark, tmp_path):
    for start in (0, 10, 20):
        arrive(spark, tmp_path / "in", [(i, "ab"[i % 3 == 0], 1 + i % 4) for i in range(start, start + 10)])
    return tmp_path


def stream(spark, folder):
    return streams.arriving(spark, str(folder / "in"), SCHEMA, files_per_batch=1)


def places(folder):
    return [str(folder / name) for name in ("out", "progress", "checkpoint")]


def test_ingest_takes_each_file_once(spark, folder):
    out, _, checkpoint = places(folder)
    kept = stream(spark, folder).where("tokens > 1")
    streams.ingest(kept, out, checkpoint)
    before = spark.read.parquet(out).count()
    streams.ingest(kept, out, checkpoint)
    assert spark.read.parquet(out).count() == before
    arrive(spark, folder / "in", [(30, "a", 5), (31, "a", 1)])
    streams.ingest(kept, out, checkpoint)
    assert spark.read.parquet(out).count() == before + 1


def test_progress_per_batch_adds_up(spark, folder):
    out, progress, checkpoint = places(folder)
    rows = stream(spark, folder)
    for _ in range(2):
        streams.ingest_with_progress(rows, "tokens", out, progress, checkpoint)
    by_batch = streams.read_progress(spark, progress)
    assert by_batch.select("batch_id").distinct().count() == 3
    expected = spark.read.schema(SCHEMA).parquet(str(folder / "in"))
    assert by_batch.agg(F.sum("tokens"), F.sum("samples")).first() == expected.agg(F.sum("tokens"), F.count("*")).first()
    assert streams.read_batches(spark, out, rows.schema).count() == 30


def walk(rows, targets):
    kept, spent = [], {}
    for position, source, tokens in sorted(rows):
        if source in spent and spent[source] >= targets[source]:
            continue
        kept.append(position)
        spent[source] = spent.get(source, 0) + tokens
    return kept


def coupled_walk(rows, targets, total):
    kept, spent = [], 0
    for index, (source, target) in enumerate(targets.items()):
        if index and spent >= total:
            break
        own = 0
        for position, _, tokens in sorted(r for r in rows if r[1] == source):
            if own and (own >= target or spent >= total):
                break
            kept.append(position)
            own, spent = own + tokens, spent + tokens
    return sorted(kept)


def targets_table(spark, targets):
    return spark.createDataFrame([(s, t, i) for i, (s, t) in enumerate(targets.items())], "source string, target long, source_order int")


def arrived(spark, folder):
    return [tuple(r) for r in spark.read.schema(SCHEMA).parquet(str(folder / "in")).collect()]


def take(spark, folder, targets, total=None):
    out, progress, checkpoint = places(folder)
    rows = stream(spark, folder)
    streams.ingest_budgeted(rows, "pos", "tokens", targets_table(spark, targets), out, progress, checkpoint, total)
    return streams.read_batches(spark, out, rows.schema)


@pytest.mark.parametrize("targets", [{"a": 21, "b": 9}, {"a": 0, "b": 1000}, {"b": 5}])
def test_budget_over_batches_equals_a_walk(spark, folder, targets):
    kept = take(spark, folder, targets)
    everything = [r for r in arrived(spark, folder) if r[1] in targets]
    assert sorted(r["pos"] for r in kept.collect()) == walk(everything, targets)
    totals = streams.batch_totals(spark, places(folder)[1], 2).select("source", "total_samples", "total_tokens")
    sums = kept.groupBy("source").agg(F.count("*"), F.sum("tokens"))
    assert sorted(map(tuple, totals.collect())) == sorted(map(tuple, sums.collect()))


@pytest.mark.parametrize("total", [1, 9, 30, 45, 1000])
@pytest.mark.parametrize("targets", [{"a": 21, "b": 9}, {"b": 16, "a": 30}, {"a": 500, "b": 0}])
def test_total_over_arriving_rows_equals_a_walk(spark, folder, targets, total):
    """Rows of both sources in every batch: what the later one may take is known when the earlier one is done."""
    accepted = take(spark, folder, targets, total)
    out, progress, _ = places(folder)

    def under_total():
        kept = streams.read_under_total(spark, "pos", "tokens", targets_table(spark, targets), total, out, progress, stream(spark, folder).schema)
        return sorted(r["pos"] for r in kept.collect())

    assert under_total() == coupled_walk(arrived(spark, folder), targets, total)
    if total != 30:
        return
    arrive(spark, folder / "in", [(i, "ab"[i % 2], 3) for i in range(30, 50)])
    take(spark, folder, targets, total)
    assert under_total() == coupled_walk(arrived(spark, folder), targets, total)
    # Each source's accepted rows are bounded too, not only what is read of them.
    sums = {r["source"]: r["t"] for r in accepted.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    assert all(sums.get(s, 0) < max(1, t) + 4 for s, t in targets.items())


def test_many_sources_stay_a_table(spark, tmp_path, monkeypatch):
    rows = spark.range(30_000).select(F.col("id").alias("pos"), (F.col("id") % 12_000).cast("string").alias("source"), (F.col("id") % 3 + 1).alias("tokens"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    targets = rows.select("source", F.lit(2).cast("long").alias("target")).distinct()
    out, progress, checkpoint = places(tmp_path)
    streams.ingest_budgeted(stream(spark, tmp_path), "pos", "tokens", targets, out, progress, checkpoint)
    earlier = Window.partitionBy("source").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    expected = rows.withColumn("before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))).where("before < 2").select("pos")
    kept = streams.read_batches(spark, out, rows.schema).select("pos")
    assert kept.exceptAll(expected).count() == 0 == expected.exceptAll(kept).count()


def test_a_repeated_batch_adds_nothing(spark, folder):
    targets = {"a": 30, "b": 9}
    once = sorted(tuple(r) for r in take(spark, folder, targets).collect())
    # As after a crash between storing the last batch and committing it: the batch is run again.
    for commit in sorted((folder / "checkpoint" / "commits").glob("*2*")):
        commit.unlink()
    assert sorted(tuple(r) for r in take(spark, folder, targets).collect()) == once


def test_resumed_equals_one_run(spark, folder):
    targets = {"a": 33, "b": 14}
    take(spark, folder, targets)
    arrive(spark, folder / "in", [(i, "ab"[i % 2], 3) for i in range(30, 36)])
    kept = take(spark, folder, targets).collect()
    assert sorted(r["pos"] for r in kept) == walk(arrived(spark, folder), targets)


def test_json_lines_arrive_too(spark, tmp_path):
    spark.createDataFrame([(1, "a", 2), (2, "b", 3)], SCHEMA).write.json(str(tmp_path / "in"))
    rows = streams.arriving(spark, str(tmp_path / "in"), SCHEMA, file_format="json", pattern="*.json")
    streams.ingest(rows, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
