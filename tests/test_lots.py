"""Lots of files, interrupted anywhere, against one run of the whole."""

import pytest
from pyspark.sql import functions as F

from sluice.functions.bpe import Vocabulary
from sluice.operators import lots as L, sinks
from sluice.plans.instruct import capped_instruct_corpus, count_in_lots, counted_instructions, instruct_corpus
from sluice.plans.pretrain import pretrain_by_samples

BYTES = Vocabulary.bytes_only()


@pytest.fixture
def files(spark, stage):
    """(id, prompt, text) in some twenty files, with blank ones among them."""
    text = F.when(F.col("id") % 7 == 0, " ").otherwise(F.concat(F.lit(" t"), F.repeat(F.lit("ab "), (F.col("id") % 5).cast("int"))))
    rows = spark.range(200).repartition(20, "id").select("id", F.concat(F.lit("p"), "id").alias("prompt"), text.alias("text"))
    return stage.write(rows, "files").rows


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_a_file_is_in_one_lot_and_others_are_not_opened(spark, files):
    of = files.select("*", F.col("_metadata.file_path").alias("path"), L.lot_of(4).alias("lot"))
    assert of.select("path", "lot").distinct().count() == of.select("path").distinct().count() > 4
    per_lot = [files.where(L.lot_of(4) == k) for k in range(4)]
    assert sorted(r["id"] for lot in per_lot for r in lot.collect()) == list(range(200))
    sizes = []
    for lot in per_lot:
        scan = lot._jdf.queryExecution().executedPlan().collectLeaves().head()
        sizes.append(scan.relation().location().listFiles(scan.partitionFilters(), scan.dataFilters()).head().files().size())
    assert sum(sizes) == of.select("path").distinct().count() and max(sizes) < sum(sizes)


@pytest.mark.parametrize("target", [1, 60, 10_000])
def test_instruct_lots_equal_one_run(spark, stage, files, target):
    make = lambda: instruct_corpus(files, ("id",), BYTES, stage, target)
    path, whole = f"{stage.path}/lots", make()
    assert make().in_lots(path, 5, 2) is None
    assert sinks.latest_progress(spark, path)["step"] == 1
    assert make().in_lots(path, 5, 0) is None
    taken = make().in_lots(path, 5)
    assert rows_of(taken.rows) == rows_of(whole.rows)
    total = sinks.latest_progress(spark, path)["progress"]
    assert total["examples_collected"] == whole.rows.count()
    assert total["total_tokens"] == whole.rows.agg(F.sum("tokencount")).first()[0]
    assert rows_of(make().in_lots(path, 5).rows) == rows_of(whole.rows)
    record = taken.save(f"{stage.path}/saved")
    assert record["total_samples"] == whole.row_count and rows_of(taken.read(f"{stage.path}/saved").select(*whole.rows.columns)) == rows_of(whole.rows)


@pytest.mark.parametrize("dies_at", [0, 2, 4])
def test_an_interrupted_lot_is_run_again(spark, stage, files, monkeypatch, dies_at):
    path, write = f"{stage.path}/lots", sinks.write_progress

    def dies(*arguments):
        if arguments[2] == dies_at:
            raise RuntimeError("lost")
        write(*arguments)

    make = lambda: instruct_corpus(files, ("id",), BYTES, stage, 90)
    monkeypatch.setattr(sinks, "write_progress", dies)
    with pytest.raises(RuntimeError):
        make().in_lots(path, 5)
    before = L.read_lots(spark, path, make().rows)
    last = sinks.latest_progress(spark, path)
    assert before.count() == (last["progress"]["examples_collected"] if last else 0)
    monkeypatch.setattr(sinks, "write_progress", write)
    assert rows_of(make().in_lots(path, 5).rows) == rows_of(make().rows)


def test_another_plan_is_refused(spark, stage, files):
    path = f"{stage.path}/lots"
    instruct_corpus(files, ("id",), BYTES, stage, 90).in_lots(path, 5, 1)
    for target, seed, n in ((91, 42, 5), (90, 43, 5), (90, 42, 6)):
        with pytest.raises(ValueError, match="other inputs"):
            instruct_corpus(files, ("id",), BYTES, stage, target, seed=seed).in_lots(path, n)


def test_samples_of_two_sources(spark, stage, files):
    other = stage.write(files.where("id % 3 = 0").repartition(6, "id"), "other").rows
    make = lambda: pretrain_by_samples(files, other, ("id",), stage, total_tokens=80_000, secondary_share=0.2)
    whole, path = make(), f"{stage.path}/lots"
    assert make().in_lots(path, 3, 1) is None
    assert rows_of(make().in_lots(path, 3).rows) == rows_of(whole.rows)
    assert len({r["source"] for r in whole.rows.select("source").collect()}) == 2


def test_capped_rows_are_counted_in_lots(spark, stage, files):
    rows = files.select("id", F.col("prompt").alias("instruction"), F.col("text").alias("response"), F.lit(1).alias("lot"))
    rows = stage.write(rows.repartition(9, "id"), "named").rows
    cap = int(counted_instructions(rows, BYTES).agg(F.median("tokencount")).first()[0])
    path, whole = f"{stage.path}/lots", capped_instruct_corpus(rows, ("id",), BYTES, stage, max_tokens=cap)
    whole_rows = rows_of(whole.rows)
    assert not count_in_lots(rows, BYTES, path, lots=4, max_lots=3)
    taken = capped_instruct_corpus(rows, ("id",), BYTES, stage, max_tokens=cap, counted_path=path, lots=4)
    assert rows_of(taken.rows) == whole_rows and taken.figures == whole.figures
    assert 0 < whole.figures["filtered_rows"] < whole.figures["original_rows"] == 200


def test_empty_files(spark, stage):
    rows = stage.write(spark.createDataFrame([], "id long, instruction string, response string"), "none").rows
    assert count_in_lots(rows, BYTES, f"{stage.path}/lots", lots=2)
    assert L.read_lots(spark, f"{stage.path}/lots", rows).count() == 0
