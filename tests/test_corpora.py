from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from sluice.functions.bpe import Vocabulary
from sluice.operators import sinks
from sluice.plans.instruct import capped_instruct_corpus, instruct_corpus
from sluice.plans.pretrain import BUDGET_SOURCES, SAMPLE_SOURCES, pretrain_by_samples, pretrain_by_tokens
from sluice.sources.tables import Source, open_source
from tests.plans import physical_plan

BYTES = Vocabulary.bytes_only()


def pairs(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, prompt string, text string")


def test_instruct_corpus_counts_accepted_rows(spark, stage):
    rows = pairs(spark, [("", "x"), (None, "x"), (" ", "x"), *[(f" p{i} ", f"t{i}\n") for i in range(30)]])
    corpus = instruct_corpus(rows, ("id",), BYTES, stage, target_rows=20, val_ratio=0.1)
    found = corpus.rows.collect()
    assert len(found) == 20 and all(r["id"] >= 2 for r in found)
    assert sum(r["split"] == "train" for r in found) == 18
    for r in found:
        assert r["prompt"] == r["prompt"].strip() and r["text"] == r["text"].strip()
        assert r["tokencount"] == len(r["formattedconversation"].replace("<|im_start|>", "S").replace("<|im_end|>", "E"))


def test_target_beyond_the_source_keeps_all(spark, stage):
    rows = pairs(spark, [("p", "t")] * 5)
    assert instruct_corpus(rows, ("id",), BYTES, stage, target_rows=100).rows.count() == 5


def test_empty_inputs_are_errors(spark, stage):
    nothing = pairs(spark, []).withColumnsRenamed({"prompt": "instruction", "text": "response"})
    with pytest.raises(ValueError, match="no rows"):
        instruct_corpus(pairs(spark, [("", "")]), ("id",), BYTES, stage)
    with pytest.raises(ValueError, match="no rows remaining"):
        capped_instruct_corpus(nothing, ("id",), BYTES, stage)
    text = spark.createDataFrame([], "id long, text string")
    with pytest.raises(ValueError):
        pretrain_by_samples(text, text, ("id",), stage)
    with pytest.raises(ValueError):
        pretrain_by_tokens({"fineweb_edu": text, "open_web_math": text}, "id", stage)


def test_capped_corpus_keeps_empty_turns_and_all_columns(spark, stage):
    rows = spark.createDataFrame(
        [(0, None, "c", None, "qa"), (1, " a ", None, "b", "qa"), (2, "x" * 600, None, "y", "qa")],
        "id long, instruction string, context string, response string, category string",
    )
    corpus = capped_instruct_corpus(rows, ("id",), BYTES, stage, val_ratio=0.5)
    found = {r["id"]: r for r in corpus.rows.collect()}
    assert sorted(found) == [0, 1]
    assert found[0]["formattedconversation"] == (
        "<|im_start|>user\\n\\n<|im_end|>\\n<|im_start|>assistant\\n\\n<|im_end|>"
    )
    assert found[1]["instruction"] == " a " and "context" in corpus.rows.columns
    assert corpus.figures["original_rows"] == 3 and corpus.figures["filtered_rows"] == 2


def test_saving_writes_splits_metadata_and_markers(spark, stage, tmp_path):
    rows = pairs(spark, [(f"p{i}", f"t{i}") for i in range(40)])
    corpus = instruct_corpus(rows, ("id",), BYTES, stage, target_rows=30, val_ratio=0.1)
    record = corpus.save(str(tmp_path))
    assert (record["train_samples"], record["val_samples"], record["total_samples"]) == (27, 3, 30)
    back = corpus.read(str(tmp_path))
    assert back.agg(F.sum("tokencount")).first()[0] == record["total_tokens"]
    assert record["mean_tokens_per_sample"] == record["total_tokens"] / 30
    assert corpus.read(str(tmp_path), "val").count() == 3
    stored = sinks.read_metadata(spark, corpus.metadata_schema(), str(tmp_path)).first()
    assert stored["total_tokens"] == record["total_tokens"] and stored["seed"] == 42
    markers = sinks.read_markers(spark, str(tmp_path)).collect()
    assert {r["token"]: r["id"] for r in markers}["<|im_end|>"] == 258


def test_saving_a_mixture_keeps_its_maps(spark, stage, tmp_path):
    text = spark.range(50).withColumn("text", F.concat(F.lit(" text "), "id"))
    corpus = pretrain_by_samples(
        text, text, ("id",), stage, total_tokens=10_000, secondary_share=0.4, val_ratio=0.1
    )
    record = corpus.save(str(tmp_path))
    assert record["samples_per_source"] == {"fineweb-edu": 12, "open-web-math": 5}
    assert (record["pretrain_train_samples"], record["pretrain_val_samples"]) == (15, 2)
    stored = sinks.read_metadata(spark, corpus.metadata_schema(), str(tmp_path)).first()
    assert stored["token_ratios"] == {"fineweb-edu": 0.6, "open-web-math": 0.4}
    assert stored["name"].startswith("pretrain-tiny-0.0Mt-17pt-") and stored["subset"] == "sample-10BT"


def test_sample_sources_open_by_subset(spark, stage):
    primary, _ = (replace(s, path=f"{stage.path}/{s.path}") for s in SAMPLE_SOURCES)
    for subset in ("sample-10BT", "full"):
        rows = spark.range(2).select("id", F.lit(subset).alias("text"))
        rows.write.parquet(primary.with_subset(subset).location())
    for chosen, expected in ((None, "sample-10BT"), ("full", "full")):
        rows = open_source(spark, primary.with_subset(chosen), "id long, text string")
        assert {r["text"] for r in rows.collect()} == {expected}


def test_without_the_secondary_source(spark, stage):
    text = spark.range(50).withColumn("text", F.lit("x"))
    corpus = pretrain_by_samples(text, text, ("id",), stage, total_tokens=5_000, with_secondary=False)
    assert {r["source"] for r in corpus.rows.collect()} == {"fineweb-edu"} and corpus.rows.count() == 10
    with pytest.raises(ValueError):
        pretrain_by_samples(text, text, ("id",), stage, secondary_share=1.5)


def test_token_mix_reports_what_it_kept(spark, stage):
    web = spark.createDataFrame(
        [(i, "w" * 80, lang) for i, lang in enumerate(["en", "fr", None, "en", "en"])],
        "id long, text string, language string",
    )
    math = spark.createDataFrame([(0, "m" * 49), (1, "m" * 80), (2, "m" * 80)], "id long, text string")
    corpus = pretrain_by_tokens(
        {"web": web, "math": math}, "id", stage, 60, (replace(BUDGET_SOURCES[0], name="web", ratio=0.6),
        Source("math", "", ratio=0.4)), val_ratio=0.25,
    )
    assert corpus.figures["tokens_per_source"] == {"web": 40, "math": 20}
    assert sorted((r["source"], r["id"]) for r in corpus.rows.collect()) == [("math", 1), ("web", 0), ("web", 2)]
    assert {r["split"] for r in corpus.rows.collect()} == {"train"}


def test_a_mixture_as_shards(spark, stage):
    text = spark.range(30).withColumn("text", F.concat(F.lit("x" * 80), "id"))
    web, math = BUDGET_SOURCES
    corpus = pretrain_by_tokens({web.name: text, math.name: text}, "id", stage, 400, val_ratio=0.1)
    path = f"{stage.path}/shards"
    corpus.save_shards(path, [F.col("source_order"), F.col("id")], stage, 4)
    back = spark.read.schema("text string, source string, position long, shard long").json(path)
    rows = back.orderBy("position").collect()
    assert [r["shard"] for r in rows] == [i // 4 for i in range(corpus.row_count)]
    assert [r["source"] for r in rows] == [web.name] * 20


def test_plans_move_no_text_and_count_once(spark, stage, sf_dir):
    rows = registry.by_tokens(spark, sf_dir)
    assert "Exchange" not in physical_plan(rows) and "Join" not in physical_plan(rows)
    source = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("id"), F.col("text").alias("prompt"), "text"
    )
    plan = physical_plan(instruct_corpus(source, ("id",), BYTES, stage, target_rows=50).rows)
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan and "Join" not in plan


def test_exact_budgets_weigh_only_the_range_read(spark, stage):
    text = spark.range(40).withColumn("text", F.concat(F.lit("é" * 50), "id"))
    web, math = BUDGET_SOURCES
    inputs = {web.name: text, math.name: text.where("id < 1")}
    corpus = pretrain_by_tokens(inputs, "id", stage, 1000, val_ratio=0.1, vocabulary=BYTES)
    kept = [r["text"] for r in corpus.rows.where(F.col("source") == web.name).orderBy("id").collect()]
    sizes = [len(t.encode()) for t in kept]
    assert sum(sizes[:-1]) < 990 <= sum(sizes)
    assert "ArrowEvalPython" not in physical_plan(corpus.rows)
