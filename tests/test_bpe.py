import tracemalloc
from functools import cache

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as registry
from sluice.functions import bpe
from sluice.functions.bpe import Vocabulary, _encoder_factory, decoded, positions_of, segments, token_count, token_ids
from tests.plans import physical_plan

TEXTS = [
    "", " ", "Hello world", "<|im_start|>user\nhi\n<|im_end|>", "literal \\n text", "é\U0001d49c 漢字\u3000",
    "a" * 3000, "<|endoftext|> in the text", "tabs\t\tand\n\n\nlines  ", "<|im_start|><|im_start|>",
    "a <|im_end|> b", "<|im_start", "it's 12,345.67 don't",
]


@pytest.fixture(scope="module")
def public():
    return Vocabulary.from_file(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@cache
def other_tokenizer():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.add_special_tokens(["<|im_start|>", "<|im_end|>"])
    return tokenizer


def other_ids(text):
    return other_tokenizer().encode(text, add_special_tokens=False).ids


@cache
def encoder():
    return _encoder_factory(Vocabulary.from_file(public_tokenizers.path("byte_bpe_50k.tiktoken")))()


@pytest.fixture(scope="module")
def second_implementation():
    return other_ids


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")


def test_ids_of_the_extended_vocabulary(spark, public):
    assert public.special_ids() == {"<|endoftext|>": 50256, "<|im_start|>": 50257, "<|im_end|>": 50258}
    assert public.size == 50259
    table = {r["token"]: r["id"] for r in public.marker_table(spark).collect()}
    assert table["pad"] == 50256 and table["vocabulary size"] == 50259


def test_ids_equal_second_implementation(spark, public, second_implementation):
    rows = rows_of(spark, TEXTS).select(
        "i", token_ids(F.col("text"), public).alias("ids"), token_count(F.col("text"), public).alias("n")
    )
    found = {r["i"]: r for r in rows.collect()}
    for i, text in enumerate(TEXTS):
        assert list(found[i]["ids"]) == second_implementation(text), text
        assert found[i]["n"] == len(found[i]["ids"])


ALPHABET = "".join(chr(c) for c in range(0x00, 0x180)) + "\u1680\u2003\u2028\u3000\u4e2d\u6587\u0436\u05d0\U0001f600"


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.text(ALPHABET, max_size=40), st.sampled_from(["<|im_start|>", "<|im_end|>", "\n"]))))
def test_any_text_equals_second_implementation(parts):
    text = "".join(parts)
    assert encoder().encode(text, allowed_special="all") == other_ids(text)


LONG = [" " * 2_000_000, "\n" * 2_000_000 + "x", "a" + " \n" * 1_000_000 + " b  ", "\u3000" * 20_001 + "c" + "\t" * 20_000]


@pytest.mark.parametrize("run", [9_999, 10_000, 10_001, 30_000])
@pytest.mark.parametrize("blank", [" ", "\n", " \n", "\u00a0", "\x1c"])
@pytest.mark.parametrize("after", ["", "x", " y", "<|im_end|>", "'s"])
def test_long_runs_of_blanks_equal_second_implementation(run, blank, after):
    text = "a" + blank * run + after
    assert [i for s in segments(text, Vocabulary.bytes_only().specials) for i in encoder().encode(s, allowed_special="all")] == other_ids(text)


def test_a_junk_row_leaves_the_others_counted(spark, public):
    rows = rows_of(spark, ["one", *LONG, "two words"]).coalesce(1)
    found = [r["n"] for r in rows.select("i", token_count(F.col("text"), public).alias("n")).orderBy("i").collect()]
    assert found[0] == 1 and found[-1] == 2 and found[1] == 2_000_000 and all(n > 0 for n in found)


def test_counts_of_pairs_equal_second_implementation(spark, public, second_implementation, sf_dir):
    for separator in ("\n", "\\n"):
        for r in registry.counted(spark, sf_dir, public, separator).collect():
            assert r["tokencount"] == len(second_implementation(r["formattedconversation"]))


def test_capped_corpus_equals_second_implementation(spark, second_implementation, sf_dir):
    all_rows = registry.formatted(spark, sf_dir, "\\n").collect()
    expected = {
        (r["conv_id"], r["turn"]) for r in all_rows if len(second_implementation(r["formattedconversation"])) < 508
    }
    rows = registry.instruct_capped_50k(spark, sf_dir).collect()
    assert {(r["conv_id"], r["turn"]) for r in rows} == expected
    assert sorted(r["permuted"] for r in rows) == list(range(len(expected)))


def test_decoding_returns_the_text(spark, public):
    rows = rows_of(spark, TEXTS).select("i", "text", token_ids(F.col("text"), public).alias("ids"))
    for r in rows.withColumn("back", decoded(F.col("ids"), public)).collect():
        assert r["back"] == r["text"]


def test_nulls_stay_null(spark, public):
    rows = spark.createDataFrame([(None,)], "text string").select(
        token_count(F.col("text"), public).alias("n"), token_ids(F.col("text"), public).alias("ids")
    )
    assert rows.first() == (None, None)


def test_bytes_vocabulary_counts_bytes_and_markers(spark):
    vocabulary = Vocabulary.bytes_only()
    rows = rows_of(spark, ["é a", "<|im_start|>x<|im_end|>"])
    counted = rows.select("i", token_count(F.col("text"), vocabulary).alias("n"))
    assert [r["n"] for r in counted.orderBy("i").collect()] == [4, 3]


def test_marker_positions_count_from_zero(spark):
    rows = spark.createDataFrame([([7, 1, 7],), ([],), ([2],)], "ids array<int>")
    found = rows.select(positions_of(F.col("ids"), 7).alias("p")).collect()
    assert [list(r["p"]) for r in found] == [[0, 2], [], []]


def test_a_filter_on_the_count_runs_the_encoder_once(spark, public):
    rows = rows_of(spark, TEXTS).withColumn("n", token_count(F.col("text"), public)).where("n < 508")
    assert physical_plan(rows).count("ArrowEvalPython") == 1


class Caught:
    """Stands in for ``arrow_udf`` and gives the function that workers would run."""

    def __init__(self, work, _):
        self.work = work

    def asNondeterministic(self):  # noqa: N802
        return lambda _: self.work


def test_ids_and_texts_of_a_batch_are_never_all_python_objects(monkeypatch, public):
    monkeypatch.setattr(bpe, "arrow_udf", Caught)
    texts = [f"{i} words, " * 2500 for i in range(300)] + [None, ""]
    ids, back = token_ids(None, public), decoded(None, public)
    list(back(ids(iter([pa.array(["warm up"])]))))
    most = []
    for work, batch in ((ids, pa.array(texts)), (back, None)):
        batch = batch if batch is not None else pa.concat_arrays(parts)
        tracemalloc.start()
        parts = list(work(iter([batch])))
        most.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert sum(map(len, parts)) == len(texts)
    assert pa.concat_arrays(parts).to_pylist() == texts
    assert max(most) < 24 << 20, most


def test_decoding_in_pieces_cuts_no_character(spark, public, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 3)
    monkeypatch.setattr(bpe, "PART", 2)
    monkeypatch.setattr(bpe, "arrow_udf", Caught)
    rows = pa.array([*TEXTS, None, "漢字é\U0001d49c" * 50, ""])
    ids = list(token_ids(None, public)(iter([rows])))
    assert len(ids) > 3 and pa.concat_arrays(ids).type == pa.list_(pa.int32())
    assert pa.concat_arrays(list(decoded(None, public)(iter(ids)))).to_pylist() == rows.to_pylist()
    cut = next(decoded(None, public)(iter([pa.array([other_ids("漢")[:1], None, []], pa.list_(pa.int32()))])))
    assert cut.to_pylist()[0] == encoder().decode(other_ids("漢")[:1])
