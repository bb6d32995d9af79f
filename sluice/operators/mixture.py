"""Planning a mixture: budgets, sample counts and shares. Plan tables have one row per source."""

from math import ceil, trunc

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# The preset token budgets and the tokens assumed per sample.
PRESET_TOKENS = {
    "tiny": 5_000_000,
    "small": 50_000_000,
    "base": 250_000_000,
    "medium": 1_000_000_000,
    "large": 3_000_000_000,
    "xl": 10_000_000_000,
    "xxl": 40_000_000_000,
}
PRIMARY_TOKENS_PER_SAMPLE = 500
SECONDARY_TOKENS_PER_SAMPLE = 800


def preset_tokens(size: str) -> int:
    """Budget of a size name; an unknown name gets the smallest preset."""
    return PRESET_TOKENS.get(size, PRESET_TOKENS["tiny"])


def check_share(name: str, share: float) -> None:
    if not 0.0 <= share <= 1.0:
        raise ValueError(f"{name} must lie in [0.0, 1.0], got {share}")


def two_source_budget(total: int, secondary_share: float, with_secondary: bool = True) -> tuple[int, int]:
    """(primary, secondary) tokens: the secondary part is rounded down, the primary is the remainder."""
    check_share("secondary_share", secondary_share)
    secondary = trunc(total * secondary_share) if with_secondary else 0
    return total - secondary, secondary


def planned_samples(tokens: int, tokens_per_sample: int) -> int:
    """Samples that carry the tokens, at least one; none for no tokens."""
    return max(1, ceil(tokens / tokens_per_sample)) if tokens > 0 else 0


def source_targets(total: int, ratios: dict[str, float]) -> dict[str, int]:
    """Each source's token target, rounded down."""
    return {name: trunc(total * ratio) for name, ratio in ratios.items()}


def sample_plan(plans: DataFrame) -> DataFrame:
    """Budgets and samples for many plans at once: (total_tokens, secondary_share, with_secondary)."""
    secondary = F.when(
        F.col("with_secondary"), (F.col("total_tokens") * F.col("secondary_share")).cast("long")
    ).otherwise(F.lit(0).cast("long"))

    def samples(tokens: str, per_sample: int):
        needed = F.greatest(F.lit(1).cast("long"), F.ceil(F.col(tokens) / per_sample))
        return F.when(F.col(tokens) > 0, needed).otherwise(F.lit(0).cast("long"))

    return (
        plans.withColumn("secondary_tokens", secondary)
        .withColumn("primary_tokens", F.col("total_tokens") - F.col("secondary_tokens"))
        .withColumn("primary_samples", samples("primary_tokens", PRIMARY_TOKENS_PER_SAMPLE))
        .withColumn("secondary_samples", samples("secondary_tokens", SECONDARY_TOKENS_PER_SAMPLE))
    )


def plan_table(spark: SparkSession, total: int, ratios: dict[str, float]) -> DataFrame:
    """(source, planned_share, planned_tokens), one row per configured source."""
    targets = source_targets(total, ratios)
    rows = [(name, float(ratio), targets[name]) for name, ratio in ratios.items()]
    return spark.createDataFrame(rows, "source string, planned_share double, planned_tokens long")


def achieved_shares(plan: DataFrame, totals: DataFrame) -> DataFrame:
    """The plan beside what was achieved; ``totals`` has (source, samples, tokens), one row per source."""
    joined = plan.join(totals, "source", "left").na.fill(0, ["samples", "tokens"])
    all_tokens = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    return joined.select(
        "source",
        "planned_share",
        "planned_tokens",
        "samples",
        "tokens",
        F.when(all_tokens > 0, F.col("tokens") / all_tokens).otherwise(0.0).alias("achieved_share"),
    )
