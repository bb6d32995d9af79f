"""A corpus that is replaced while its writer dies: readers find the old one or the new one, whole."""

from pyspark.sql import DataFrameWriter, functions as F

from sluice.operators import publish as P, sinks
from sluice.plans.corpus import Corpus
from sluice.sources import tables


class Died(Exception):
    pass


def corpus(spark, n):
    rows = spark.range(n).select("id", F.lit(n).alias("run"), F.when(F.col("id") % 5 == 0, "val").otherwise("train").alias("split"))
    return Corpus(rows, ("train", "val"), {"run": n}, "run long", row_count=n)


def dies_at(monkeypatch, step):
    """Let the writer die at its ``step``-th write, before or after it is done; the count of writes so far."""
    writes = [0]

    def counted(write):
        def guarded(*arguments, **options):
            writes[0] += 1
            if writes[0] == step:
                raise Died
            return write(*arguments, **options)

        return guarded

    for owner, name in ((DataFrameWriter, "parquet"), (DataFrameWriter, "json"), (P, "write_small"), (P, "delete_path"), (sinks, "delete_path")):
        monkeypatch.setattr(owner, name, counted(getattr(owner, name)))
    return writes


def test_a_run_that_dies_leaves_the_old_corpus_or_the_new(spark, tmp_path, monkeypatch):
    path, run = str(tmp_path / "corpus"), 20
    corpus(spark, run).save(path)
    step, outcomes = 0, set()
    while True:
        step, new = step + 1, run + 5
        with monkeypatch.context() as patch:
            writes = dies_at(patch, step)
            try:
                corpus(spark, new).save(path)
                died = False
            except Died:
                died = True
        back, record = corpus(spark, 0).read(path).collect(), sinks.read_metadata(spark, "run long, total_samples long", path).first()
        (found,) = {r["run"] for r in back}
        assert found in (run, new) and len(back) == found == record["run"] == record["total_samples"]
        assert corpus(spark, 0).read(path, "val").count() == -(-found // 5)
        outcomes.add((died, found == new))
        run = found
        if not died:
            break
    assert writes[0] >= 5 and {(True, False), (False, True)} <= outcomes
    # What was replaced is gone but for one.
    assert len(P._numbers(spark, path)) == P.KEPT


def test_two_at_a_time_follow_each_other(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "corpus")
    numbers = [P.publish(spark, path, P.attempt(path))]
    monkeypatch.setattr(P, "_numbers", lambda *_: [])  # as if both had looked before either wrote
    numbers.append(P.publish(spark, path, last := P.attempt(path)))
    monkeypatch.undo()
    assert numbers == [1, 2] and P.published(spark, path) == last


def test_what_is_not_published_is_read_as_it_lies(spark, tmp_path):
    rows = spark.range(4).select("id", F.lit("train").alias("split"))
    sinks.write_splits(rows, str(tmp_path))
    assert P.published(spark, str(tmp_path)) == str(tmp_path)
    assert sinks.read_splits(spark, str(tmp_path), rows.schema).count() == 4


def test_a_small_file_is_whole_or_absent(spark, tmp_path):
    path = str(tmp_path / "folder" / "file")
    assert tables.read_small(spark, path) is None and tables.modified(spark, path) is None
    assert tables.write_small(spark, path, "a") and tables.write_small(spark, path, "bé")
    assert tables.read_small(spark, path) == "bé"
    assert not tables.write_small(spark, path, "c", replace_it=False) and tables.read_small(spark, path) == "bé"
    assert tables.folder_names(spark, str(tmp_path / "folder")) == ["file"]
