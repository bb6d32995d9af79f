import json
import os
import time
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from sluice.functions.order import shuffled
from sluice.operators import rank, sinks, stage as stages
from sluice.operators.rank import partitions_for, ranked
from sluice.operators.stage import Stage, checkpoint_root
from sluice.sources.tables import (
    Source, conform, is_folder, open_source, optional, read_shards, read_string_fields, spread, table, tagged_text,
)
from tests.plans import physical_plan

SCHEMA = "id long, text string"


@pytest.fixture
def corpus(spark, tmp_path):
    for subset in ("small", "large"):
        rows = spark.range(4).select("id", F.concat(F.lit(subset), "id").alias("text"))
        rows.write.parquet(f"{tmp_path}/web/{subset}/train")
    return Source("web", f"{tmp_path}/web", "small", "train")


def test_subset_overrides_the_registered_one(spark, corpus):
    assert open_source(spark, corpus, SCHEMA).where("text like 'small%'").count() == 4
    assert open_source(spark, corpus.with_subset("large"), SCHEMA).where("text like 'large%'").count() == 4
    assert corpus.with_subset(None) == corpus


def test_missing_source(spark, tmp_path):
    gone = Source("gone", f"{tmp_path}/gone")
    with pytest.raises(AnalysisException):
        open_source(spark, gone, SCHEMA)
    rows = open_source(spark, gone, SCHEMA, on_missing="empty")
    assert rows.count() == 0 and rows.columns == ["id", "text"]
    with pytest.raises(ValueError):
        open_source(spark, gone, SCHEMA, on_missing="ignore")


def test_optional_columns_and_predicates(spark):
    english = Source("web", "", predicate="language IS NULL OR language = 'en'", optional={"language": "string"})
    full = table(spark, [(1, "a", "en"), (2, "b", "fr"), (3, "c", None)], "id long, text string, language string")
    assert sorted(r["id"] for r in tagged_text(full, english, "id").collect()) == [1, 3]
    assert tagged_text(full.drop("language"), english, "id").count() == 3
    assert tagged_text(full, Source("math", ""), "id").count() == 3
    numbers = full.withColumn("language", F.lit(7))
    assert tagged_text(numbers, english, "id").count() == 3
    assert numbers.select(optional(numbers, "language").alias("x")).dtypes == [("x", "string")]


def test_string_fields_of_json_lines(spark, tmp_path):
    lines = ['{"text": "a"}', '{"text": 12}', '{"text": ["x"]}', '{"text": null}', "{}", '{"text": "", "n": "b"}']
    (tmp_path / "lines.jsonl").write_text("\n".join(lines))
    rows = read_string_fields(spark, str(tmp_path / "lines.jsonl"), "text", "n").collect()
    assert sorted((r["text"] or "", r["text"] is None) for r in rows) == [("", False)] + [("", True)] * 4 + [("a", False)]
    assert [r["n"] for r in rows if r["n"]] == ["b"]


def test_conform_orders_and_casts(spark):
    rows = table(spark, [(1, "a", 2)], "n int, text string, more int")
    schema = table(spark, [], "text string, n bigint").schema
    assert conform(rows, schema).dtypes == [("text", "string"), ("n", "bigint")]


def test_small_scans_spread_and_large_ones_do_not(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert "RoundRobin" in physical_plan(spread(rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert "RoundRobin" not in physical_plan(spread(rows))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_narrow_rows_of_many_splits_leave_few_files(spark, stage):
    rows = spark.range(0, 20_000, numPartitions=40)
    files = {}
    for split_bytes in ("1g", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        try:
            assert stage.write(rows, split_bytes, narrow=True).count == 20_000
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        files[split_bytes] = len(spark.read.parquet(f"{stage.path}/{split_bytes}").inputFiles())
    assert files["1g"] == 40 and files["1k"] < 10


def test_stage_lives_in_the_checkpoint_folder_and_goes(spark):
    with pytest.raises(RuntimeError), Stage(spark) as stage:
        assert stage.path.startswith(checkpoint_root(spark))
        assert stage.write(spark.range(3).toDF("id"), "t").count == 3
        assert is_folder(spark, stage.path)
        raise RuntimeError
    assert not is_folder(spark, stage.path)


def test_folders_of_dead_runs_go_with_the_next(spark, tmp_path):
    """A lease that has run out is that of a dead driver; a live one, and a folder without one, stay."""
    root = str(tmp_path / "shared")
    with Stage(spark, root) as live:
        live.write(spark.range(3), "t")
        folders = {name: tmp_path / "shared" / name for name in ("stage-dead", "stage-slow", "stage-new", "other")}
        for name, folder in folders.items():
            folder.mkdir()
            if name != "stage-new":
                (folder / stages.LEASE).write_text("")
        for name, age in (("stage-dead", 1.5), ("stage-slow", 0.5), ("other", 9)):
            then = time.time() - age * stages.LEASE_SECONDS
            os.utime(folders[name] / stages.LEASE, (then, then))
        with Stage(spark, root) as second:
            # The first stage of a session has swept; the next session's first one does.
            assert folders["stage-dead"].exists()
            assert stages.sweep(spark, root, second.path) == ["stage-dead"]
            assert sorted(p.name for p in (tmp_path / "shared").iterdir()) == sorted(["stage-new", "stage-slow", "other", live.path[-38:], second.path[-38:]])
        assert live.read(T.StructType([T.StructField("id", T.LongType())]), "t").count() == 3


def test_an_owner_renews_its_leases(spark, tmp_path):
    root = str(tmp_path / "shared")
    with Stage(spark, root) as stage, Stage(spark, root) as closed:
        lease = tmp_path / "shared" / stage.path.rsplit("/", 1)[1] / stages.LEASE
        os.utime(lease, (1, 1))
        closed.close()
        stages.renew_all()
        assert lease.stat().st_mtime > 1e9 and not is_folder(spark, closed.path)


def test_an_empty_stage_table_keeps_its_schema(spark, stage):
    rows = stage.write(spark.range(3).toDF("id").where("id > 5"), "t").rows
    assert rows.count() == 0 and rows.dtypes == [("id", "bigint")]


@pytest.mark.parametrize("partitions", [1, 5])
def test_ranks_are_dense(spark, stage, partitions):
    values = [*range(30), 10**9, 10**15, *range(10**15 + 1, 10**15 + 9)]
    rows = table(spark, [(v,) for v in values], "id long").repartition(partitions)
    placed, total = ranked(rows, [F.col("id")], stage, "place")
    assert total == len(values)
    assert [r["id"] for r in placed.orderBy("place").collect()] == sorted(values)
    assert sorted(r["place"] for r in placed.collect()) == list(range(len(values)))


def test_shards_have_exact_sizes(spark, stage):
    rows = table(spark, [(i * 7, f"é {i}", None) for i in range(25)], "id long, text string, note string")
    sharded = sinks.with_shards(rows, [F.col("id")], stage, 10)
    path = f"{stage.path}/shards"
    sinks.write_shards(sharded, path)
    back = read_shards(spark, path, "id long, text string, note string, position long, shard long")
    assert {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()} == {0: 10, 1: 10, 2: 5}
    assert [r["text"] for r in back.orderBy("position").collect()] == [f"é {i}" for i in range(25)]
    one = read_shards(spark, f"{path}/shard=2/*.json", "id long, text string, position long")
    assert sorted(r["position"] for r in one.collect()) == [20, 21, 22, 23, 24]


def test_json_lines_keep_nulls_and_characters(spark, tmp_path):
    rows = table(spark, [("é漢\U0001d49c", None)], "text string, source string")
    sinks.write_bounded_files(rows.coalesce(1), str(tmp_path / "out"))
    (part,) = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part")]
    line = part.read_text(encoding="utf-8")
    assert "é漢\U0001d49c" in line and json.loads(line) == {"text": "é漢\U0001d49c", "source": None}


def test_files_are_bounded(spark, tmp_path):
    sinks.write_bounded_files(spark.range(25).coalesce(1), str(tmp_path / "out"), 10)
    sizes = [len(p.read_text().splitlines()) for p in (tmp_path / "out").glob("part-*")]
    assert sorted(sizes) == [5, 10, 10]


def test_reading_one_split_prunes_the_other(spark, tmp_path):
    rows = table(spark, [(1, "train"), (2, "train"), (3, "val")], "id long, split string")
    seen = sinks.write_splits(rows, str(tmp_path), [F.sum("id").alias("sum")])
    assert (seen["rows_written"], seen["sum"]) == (3, 6) and seen["seconds"] > 0
    val = sinks.read_splits(spark, str(tmp_path), rows.schema, "val")
    assert [r["id"] for r in val.collect()] == [3]
    assert "PartitionFilters: [isnotnull(split" in physical_plan(val)
    assert sinks.read_splits(spark, str(tmp_path), rows.schema, "other").count() == 0
    assert sorted(p for p in os.listdir(tmp_path / "data") if "=" in p) == ["split=train", "split=val"]


def test_metadata_round_trip(spark, tmp_path):
    schema = "progress struct<total_tokens: long, tokens_per_source: map<string,long>>, timestamp double"
    sinks.write_metadata(spark, {"progress": (5, {"a": 5}), "timestamp": 1.5}, schema, str(tmp_path))
    record = sinks.read_metadata(spark, schema, str(tmp_path)).first()
    assert record["progress"]["tokens_per_source"] == {"a": 5} and record["timestamp"] == 1.5


def test_names():
    day = date(2024, 5, 6)
    assert sinks.budget_name("x", "Tiny", 5_250_000, 9963, day) == "x-tiny-5.2Mt-9963pt-20240506"
    assert sinks.thousands_name("x", 14_999, 1_234_567) == "x-14K-samples-1234K-tokens-512-seq"


def test_preview_takes_one_row_without_sorting_all(spark):
    rows = spark.range(50).withColumn("key", shuffled(1, "id").hash_text())
    assert "TakeOrderedAndProject" in physical_plan(rows.orderBy("key", "id").limit(1))


def test_many_rows_get_more_partitions(spark):
    assert partitions_for(spark, None) is None and partitions_for(spark, 10**6) is None
    assert partitions_for(spark, 10**9) == 5000


def test_stage_files_are_bounded(spark, stage):
    assert stage.write(spark.range(25).coalesce(1), "t", file_rows=10).count == 25
    assert len(spark.read.parquet(f"{stage.path}/t").inputFiles()) == 3


@pytest.mark.parametrize("many", [8192, 1])
def test_hash_ranks_are_dense(spark, stage, many, monkeypatch):
    monkeypatch.setattr(rank, "MANY_PARTITIONS", many)
    order = shuffled(3, "id")
    placed, total = rank.ranked_by_hash(spark.range(500), order, stage, "place", 6)
    found = placed.withColumn("hash", order.hash_text()).orderBy("place").collect()
    assert total == 500 and [r["place"] for r in found] == list(range(500))
    assert [r["hash"] for r in found] == sorted(r["hash"] for r in found)


def test_small_splits_are_few_files(spark, tmp_path):
    rows = spark.range(0, 400, 1, 20).withColumn("split", F.when(F.col("id") % 10 == 0, "val").otherwise("train"))
    assert "Exchange" not in physical_plan(rows)
    seen = sinks.write_splits(rows, str(tmp_path), [F.sum("id").alias("sum")], small=["val"])
    files = {s: len(list((tmp_path / "data" / f"split={s}").glob("*.parquet"))) for s in ("train", "val")}
    assert files["val"] == 1 and files["train"] == 20 and (seen["rows_written"], seen["sum"]) == (400, 79_800)
    back = sinks.read_splits(spark, str(tmp_path), rows.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert sorted(os.listdir(tmp_path)) == ["data"]


def test_moves_are_as_wide_as_the_source(spark, stage, monkeypatch):
    rows = stage.write(spark.range(1000), "t").rows
    assert rank.width(rows) is None and rank.width(rows, 10**9) == 5000
    monkeypatch.setattr("sluice.sources.tables.planned_splits", lambda _: 700.5)
    assert rank.width(rows.where("id > 3")) == 701
    assert rank.width(rows.join(rows, "id")) is None and rank.width(spark.createDataFrame([(1,)], "id long")) is None
