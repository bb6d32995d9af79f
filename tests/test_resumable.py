"""Steps, interrupted anywhere, against one run of the whole."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import sinks
from sluice.sources import tables
from sluice.plans import resumable as R
from sluice.plans.pretrain import BUDGET_SOURCES, pretrain_by_tokens

WEB, MATH = (s.name for s in BUDGET_SOURCES)


@pytest.fixture
def inputs(spark):
    def rows(n, every):
        text = F.repeat(F.lit("abcd"), (F.col("id") % 17 + 10).cast("int"))
        return spark.range(n).select(F.col("id").alias("pos"), F.when(F.col("id") % every == 0, "x").otherwise(text).alias("text"))

    return {WEB: rows(400, 7).withColumn("language", F.lit("en")), MATH: rows(90, 5)}


def taken(rows):
    return sorted((r["pos"], r["source"], r["split"]) for r in rows.collect())


@pytest.mark.parametrize("total", [1, 700, 3000, 10**6])
def test_steps_equal_one_run(spark, stage, inputs, total):
    whole = pretrain_by_tokens(inputs, "pos", stage, total)
    path = f"{stage.path}/steps"
    for _ in range(100):
        if R.take_by_tokens(inputs, "pos", path, total, step_rows=37, max_steps=3):
            break
    corpus = R.taken_corpus(spark, path, "pos", stage, total)
    assert taken(corpus.rows) == taken(whole.rows)
    assert corpus.figures == whole.figures
    steps = R.progress(spark, path).step
    assert R.take_by_tokens(inputs, "pos", path, total, step_rows=37) and R.progress(spark, path).step == steps


def test_an_interrupted_step_is_run_again(spark, stage, inputs, monkeypatch):
    path, write = f"{stage.path}/steps", sinks.write_progress

    def dies(*arguments):
        if arguments[2] == 2:
            raise RuntimeError("lost")
        write(*arguments)

    monkeypatch.setattr(sinks, "write_progress", dies)
    with pytest.raises(RuntimeError):
        R.take_by_tokens(inputs, "pos", path, 3000, step_rows=40)
    assert R.progress(spark, path).step == 1
    before = R.taken_rows(spark, path, "pos").count()
    assert before == sum(R.progress(spark, path).examples.values())  # the rows of the lost step do not count
    monkeypatch.setattr(sinks, "write_progress", write)
    assert R.take_by_tokens(inputs, "pos", path, 3000, step_rows=40)
    whole = pretrain_by_tokens(inputs, "pos", stage, 3000)
    assert taken(R.taken_corpus(spark, path, "pos", stage, 3000).rows) == taken(whole.rows)


SPREADS = {
    "far apart": [i * 2**54 for i in range(60)],
    "clusters": [c * 10**15 + i for c in range(6) for i in range(10 if c % 2 else 1)],
    "one far away": [*range(30), 10**18],
    "growing": [3**i for i in range(38)],
}


@pytest.mark.parametrize("spread", SPREADS)
def test_steps_follow_the_rows(spark, stage, spread):
    """Positions over nearly all 64 bits take a number of steps that follows the rows, not the positions."""
    rows = [(p, "abcd" * 13, "en") for p in SPREADS[spread]]
    inputs = {name: spark.createDataFrame(rows[:n], "pos long, text string, language string") for name, n in ((WEB, 99), (MATH, 3))}
    path = f"{stage.path}/steps"
    while not R.take_by_tokens(inputs, "pos", path, 10**6, step_rows=10, max_steps=5):
        pass
    whole = pretrain_by_tokens(inputs, "pos", stage, 10**6)
    assert taken(R.taken_corpus(spark, path, "pos", stage, 10**6).rows) == taken(whole.rows)
    assert R.progress(spark, path).step <= R.OVERFULL * len(rows) // 10 + 1


def test_next_range(spark):
    scan = spark.createDataFrame([(p,) for p in [5, 6, 7, 10**6, *range(2 * 10**6, 2 * 10**6 + 90)]], "pos long")
    high = 2 * 10**6 + 89
    assert R.next_range(scan, "pos", 0, high, 6, 6) == (5, 41)  # three of six
    assert R.next_range(scan, "pos", 0, high, 10, 10) == (5, 2 * 10**6 + 5)  # no fuller than a step
    assert R.next_range(scan, "pos", 10, high, 10**7, 10) == (10**6, 2 * 10**6 + 8)
    assert R.next_range(scan, "pos", high - 3, high, 1, 10) == (high - 3, high)


def test_a_restart_reads_one_record_and_no_source_again(spark, stage, inputs, monkeypatch):
    path = f"{stage.path}/steps"
    R.take_by_tokens(inputs, "pos", path, 10**6, step_rows=20, max_steps=8)
    monkeypatch.setattr(sinks, "read_progress", lambda *_: pytest.fail("all records read"))
    monkeypatch.setattr(R, "position_span", lambda *_: pytest.fail("all positions read"))
    now = R.progress(spark, path)
    assert now.step == 7 and set(now.last_positions) == {WEB} and now.last_positions[WEB] == 399
    assert not R.take_by_tokens(inputs, "pos", path, 10**6, step_rows=20, max_steps=1)
    assert R.progress(spark, path).step == 8


def test_a_lost_pointer_is_found_again(spark, stage, inputs):
    path = f"{stage.path}/steps"
    R.take_by_tokens(inputs, "pos", path, 10**6, step_rows=50, max_steps=3)
    tables.delete_path(spark, f"{path}/{sinks.LATEST_FILE}")
    # A record that was being written has no mark of success.
    spark.range(1).write.json(f"{path}/{sinks.PROGRESS_FOLDER}/step=3")
    tables.delete_path(spark, f"{path}/{sinks.PROGRESS_FOLDER}/step=3/_SUCCESS")
    assert R.progress(spark, path).step == 2


def test_shards_and_record(spark, stage, inputs):
    path = f"{stage.path}/steps"
    R.take_by_tokens(inputs, "pos", path, 2000, step_rows=100)
    corpus = R.taken_corpus(spark, path, "pos", stage, 2000)
    corpus.save_shards(f"{path}/shards", [F.col("source"), F.col("pos")], stage, 25)
    files = spark.read.json(f"{path}/shards").withColumn("file", F.input_file_name())
    shards = files.groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("file").alias("f"))
    sizes = [tuple(r) for r in shards.orderBy("shard").select("n", "f").collect()]
    assert all(s == (25, 1) for s in sizes[:-1]) and sizes[-1][0] == corpus.row_count - 25 * (len(sizes) - 1)
    last = sinks.read_progress(spark, path).orderBy(F.col("step").desc()).first()
    assert last["progress"]["total_tokens"] == corpus.figures["total_tokens"] and last["timestamp"] > 1e9


def test_nothing_to_take(spark, stage, inputs):
    empty = {name: rows.limit(0) for name, rows in inputs.items()}
    assert R.take_by_tokens(empty, "pos", f"{stage.path}/none", 10)
    with pytest.raises(ValueError, match="no rows"):
        R.taken_corpus(spark, f"{stage.path}/none", "pos", stage, 10)
