"""Checks as rows: what a plan would refuse, and results that are empty, in a table that a job can store or act on.

``check_share`` and ``require_rows`` raise at the first fault of a run. Over many plans, or many sources, a fault is a
row with its reason beside those that pass.
"""

from pyspark.sql import Column, DataFrame, functions as F


def _checked(rows: DataFrame, check: str, subject: str, passed: Column, reason: Column) -> DataFrame:
    sound = F.coalesce(passed, F.lit(False))
    return rows.select(
        F.lit(check).alias("check"), F.col(subject).cast("string").alias("subject"), sound.alias("passed"),
        F.when(~sound, reason).alias("reason"),
    )


def share_checks(plans: DataFrame, subject: str, share: str) -> DataFrame:
    """A row for each plan: its share lies in [0.0, 1.0]. A null or NaN share does not."""
    value = F.col(share)
    found = F.coalesce(value.cast("string"), F.lit("null"))
    return _checked(plans, "share", subject, value.between(0.0, 1.0) & ~F.isnan(value), F.concat(F.lit(f"{share} must lie in [0.0, 1.0], got "), found))


def row_checks(expected: DataFrame, counts: DataFrame, subject: str, what: str = "rows collected") -> DataFrame:
    """A row for each expected subject: ``counts``, of (subject, samples), has rows of it."""
    joined = expected.select(subject).distinct().join(counts.select(subject, "samples"), subject, "left")
    return _checked(joined, "rows", subject, F.col("samples") > 0, F.lit(f"no {what}"))


def raise_failures(checks: DataFrame, most: int = 10) -> None:
    """Raise a ValueError that names the first failures, if there are any."""
    failures = checks.where(~F.col("passed")).orderBy("check", "subject").limit(most).collect()
    if failures:
        raise ValueError("; ".join(f"{r['subject']}: {r['reason']}" for r in failures))
