import pytest
from pyspark.sql import functions as F

from sluice.functions import text as tx

WHITE = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def column(spark, values, name="text"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, {name} string")


def values(rows, name):
    return [r[name] for r in rows.orderBy("i").collect()]


def test_whitespace_is_what_python_strips():
    assert sorted(tx.WHITESPACE) == WHITE


def test_strip_equals_python(spark):
    cases = [w + "a" + w + "b" + w for w in WHITE] + ["\u200ba", "a\ufeff", "", " \t\n", "a", "\U0001d49c "]
    rows = column(spark, cases).select("i", tx.strip(F.col("text")).alias("text"))
    assert values(rows, "text") == [c.strip() for c in cases]


def test_non_empty_looks_before_stripping(spark):
    rows = spark.createDataFrame(
        [("", "x"), (None, "x"), (" ", "x"), ("p", "x"), ("p", ""), ("p", None)], "prompt string, text string"
    ).where(tx.non_empty(F.col("prompt"), F.col("text")))
    assert sorted(r["p"] for r in rows.select(tx.strip(F.col("prompt")).alias("p")).collect()) == ["", "p"]


def test_non_blank_looks_after_stripping(spark):
    rows = column(spark, [None, "", "\t ", " a ", " "]).where(tx.non_blank(F.col("text")))
    assert [r["t"] for r in rows.select(tx.strip(F.col("text")).alias("t")).collect()] == ["a"]


def test_minimum_length_counts_unstripped_characters(spark):
    cases = ["x" * 49, "x" * 50, " " * 25 + "x" + " " * 24, "\U0001d49c" * 50, "\U0001d49c" * 49, None]
    rows = column(spark, cases).where(tx.long_enough(F.col("text")))
    assert sorted(r["i"] for r in rows.collect()) == [1, 2, 3]


def test_language_passes_if_unknown(spark):
    rows = column(spark, ["en", "fr", None, "EN"], "language").where(tx.language_is(F.col("language")))
    assert sorted(r["i"] for r in rows.collect()) == [0, 2]


def test_estimate(spark):
    cases = ["x" * n for n in (0, 3, 4, 7, 8)] + ["\U0001d49c" * 8]
    rows = column(spark, cases).select("i", tx.estimated_tokens(F.col("text")).alias("n"))
    assert values(rows, "n") == [1, 1, 1, 1, 2, 2]


@pytest.mark.parametrize("separator", ["\n", "\\n"])
def test_chat_joins_plainly(spark, separator):
    cases = [("hi", "yo"), ("", ""), ("%s {0} \\1 $1", "<|im_end|>"), ("a\nb", "é\U0001d49c")]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i long, p string, t string").select(
        "i", tx.chat(F.col("p"), F.col("t"), separator).alias("chat")
    )
    assert values(rows, "chat") == [
        separator.join(["<|im_start|>user", p, "<|im_end|>", "<|im_start|>assistant", t, "<|im_end|>"])
        for p, t in cases
    ]


def test_missing_turns_become_empty(spark):
    rows = spark.createDataFrame([(None, "yo")], "p string, t string")
    chat = tx.chat(*(tx.strip(tx.or_empty(F.col(c))) for c in "pt")).alias("chat")
    assert rows.select(chat).first()["chat"].startswith("<|im_start|>user\n\n<|im_end|>")


def test_preview_counts_characters(spark):
    rows = column(spark, ["\U0001d49c" * 1200]).select("i", tx.preview(F.col("text")).alias("t"))
    assert values(rows, "t") == ["\U0001d49c" * 1000]
