import threading

import pytest
from pyspark.sql import functions as F

from sluice.operators.meter import Meter
from tests.plans import physical_plan


@pytest.mark.parametrize("partitions", [1, 6])
def test_records_rise_to_the_totals(spark, tmp_path, partitions):
    rows = spark.range(0, 5000, 1, partitions).select("id", (F.col("id") % 7).alias("tokens"), F.lit("text").alias("text"))
    meter = Meter(spark, every=0)
    rows.withColumn("tokens", meter.column(F.col("tokens"))).write.parquet(str(tmp_path / "out"))
    records = meter.records()
    assert len(records) == partitions  # one as each task ends
    assert all(a[0] <= b[0] and a[1] < b[1] and a[2] <= b[2] for a, b in zip(records, records[1:]))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert records[-1][1:3] == tuple(back.agg(F.count("*"), F.sum("tokens")).first())
    assert back.exceptAll(rows).count() == 0 == rows.exceptAll(back).count()
    assert [tuple(r) for r in meter.table().collect()] == records


def test_records_are_there_while_the_pass_runs(spark, tmp_path):
    """A reader on the driver sees figures before the last task has ended."""
    slow = F.udf(lambda i: __import__("time").sleep(1.5 if i == 9 else 0) or i, "long")
    rows = spark.range(0, 10, 1, 2).select(slow("id").alias("tokens"))
    meter, seen = Meter(spark, every=0), []
    write = threading.Thread(target=lambda: rows.select(meter.column(F.col("tokens")).alias("tokens")).write.parquet(str(tmp_path / "out")))
    write.start()
    while write.is_alive():
        seen.append(meter.records())
        write.join(0.05)
    assert any(r and r[-1][1] == 5 for r in seen) and meter.records()[-1][1:3] == (10, 45)


def test_at_most_one_record_in_so_many_seconds(spark):
    meter = Meter(spark, every=3600)
    rows = spark.range(0, 100, 1, 8).select(meter.column(F.col("id")).alias("id"))
    rows.write.format("noop").mode("overwrite").save()
    assert len(meter.records()) == 2 and meter.records()[-1][1:3] == (100, 4950)


def test_nulls_and_no_rows(spark):
    meter = Meter(spark, every=0)
    assert meter.records() == [] and meter.table().count() == 0
    rows = spark.sql("SELECT CAST(NULL AS long) AS n").select(meter.column(F.col("n")).alias("n"))
    assert rows.collect()[0]["n"] is None and meter.records()[-1][1:3] == (1, 0)


def test_only_the_numbers_go_to_python(spark, tmp_path):
    spark.range(10).select("id", F.lit("text").alias("text")).write.parquet(str(tmp_path / "in"))
    meter = Meter(spark)
    rows = spark.read.parquet(str(tmp_path / "in"))
    plan = physical_plan(rows.withColumn("n", meter.column(F.col("id"))))
    assert "ArrowEvalPython [counted(id" in plan and "Exchange" not in plan
