"""The queries of this package, with production parameters over whole tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm import collocations, decontaminate, hilbert, html_text, licenses, packing, quality_model, quality_rules, repeats, simhash, topk, warc, whitening
from sluice.llm.queries_sql import ORACLES
from sluice.llm.common import query_stage, table


def token_vocabulary() -> str:
    import public_tokenizers

    return packing.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), token_vocabulary(), query_stage(spark))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), query_stage(spark))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"), licenses.known(spark))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = query_stage(spark).write(quality_rules.ledger(table(spark, sf_dir, "documents")), "ledger")
    return quality_rules.judged(ledger.rows)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), query_stage(spark))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), query_stage(spark))
    return decontaminate.figures(found)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return repeats.removal_digests(docs, repeats.repeated_spans(docs, query_stage(spark)))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.shards(table(spark, sf_dir, "documents"), query_stage(spark))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), query_stage(spark))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), query_stage(spark))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), query_stage(spark))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), query_stage(spark))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_warc": op2_warc,
    "op3_license_scan": op3_license_scan,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_decontamination": op6_decontamination,
    "op7_html_extraction": op7_html_extraction,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_sharding": op9_sharding,
    "op10_simhash": op10_simhash,
    "op11_whitening": op11_whitening,
    "op12_collocations": op12_collocations,
    "op13_top_k": op13_top_k,
}
