"""The training-data pipeline: documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns the documents that it leaves, the last one the pieces of sequences.
Between stages ``run`` writes a table, so that a stage reads what the one before it has decided, once, and a lost
executor costs no more than a stage.

A stage's own tables lie in a folder that goes when the next stage begins; those of the last one stay while its result
may be read.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm import decontaminate, packing, quality_rules, repeats, simhash
from sluice.llm.common import query_stage, table
from sluice.llm.queries import token_vocabulary
from sluice.operators.stage import Stage

#: No SQL has the fingerprints, suffixes and tokens; tests compare ``run`` with brute force.
ORACLE_SQL = None

_left: list[Stage] = []


def _stage(spark: SparkSession, last: bool = False) -> Stage:
    while _left:
        _left.pop().close()
    stage = query_stage(spark)
    if not last:
        _left.append(stage)
    return stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.filtered(docs, quality_rules.WEB)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, the one with the smallest id."""
    return simhash.one_of_each(docs, _stage(spark))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur anywhere else are cut out, in whole characters; their documents stay."""
    kept = repeats.without_repeats(docs, repeats.repeated_spans(docs, _stage(spark)))
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of a benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), _stage(spark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens as pieces of sequences."""
    return packing.pack_documents(docs, token_vocabulary(), _stage(spark, last=True))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, between = table(spark, sf_dir, "documents"), query_stage(spark)
    *steps, (_, last) = STAGES
    for i, (_, step) in enumerate(steps):
        docs = between.write(step(spark, docs, sf_dir), f"stage-{i}").rows
    return last(spark, docs, sf_dir)
