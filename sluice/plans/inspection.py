"""A look at one row of a corpus."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sluice.functions.bpe import Vocabulary, decoded, positions_of, token_ids
from sluice.functions.text import TURN_END, TURN_START, preview

# Fixed value: token ids shown.
SHOWN_IDS = 50


def first_row_report(
    rows: DataFrame, keys: Sequence[Column], vocabulary: Vocabulary, split: str = "train"
) -> DataFrame:
    """Preview, ids and marker places of the split's first row; only that row is tokenized."""
    text, marks = F.col("formattedconversation"), vocabulary.special_ids()
    named = [key.alias(f"_key{i}") for i, key in enumerate(keys)]
    texts = rows.where(F.col("split") == split).select(text, *named)
    first = texts.orderBy(*[f"_key{i}" for i in range(len(named))]).limit(1).select(text)
    tokenized = first.withColumn("ids", token_ids(text, vocabulary))
    return tokenized.select(
        preview(text).alias("preview"),
        F.size("ids").cast("long").alias("tokens"),
        F.slice("ids", 1, SHOWN_IDS).alias("head"),
        positions_of(F.col("ids"), marks[TURN_START]).alias("starts"),
        positions_of(F.col("ids"), marks[TURN_END]).alias("ends"),
    ).withColumn("decoded", decoded(F.col("head"), vocabulary))
