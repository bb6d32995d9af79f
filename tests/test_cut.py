import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sluice.functions.order import by_position, shuffled
from sluice.operators.cut import find_boundaries, inside, keep, share_of_total
from tests.plans import physical_plan

SMALL = {"bucket_bits": 2, "window_rows": 3}


def table(spark, rows, partitions=3):
    return spark.createDataFrame(rows, "id long, source string, w long").repartition(partitions)


def prefix(rows, limit):
    """Ids kept by walking the rows (id, weight) in order."""
    kept, spent = [], 0
    for row_id, weight in rows:
        if spent >= limit:
            break
        kept.append(row_id)
        spent += weight
    return kept


def ids(rows):
    return sorted(r["id"] for r in rows.collect())


def seeded(seed, row_ids):
    return sorted(row_ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize(("target", "kept"), [(8, 2), (9, 3), (0, 0), (1, 1), (100, 3), (12, 3), (13, 3)])
def test_the_row_that_reaches_the_limit_is_kept(spark, target, kept):
    rows = table(spark, [(i, "a", 4) for i in range(3)])
    ends = find_boundaries(rows, by_position("id"), target, weight="w")
    assert ids(keep(rows, ends)) == list(range(kept))
    assert (ends[""].rows, ends[""].weight) == (kept, 4 * kept)


@pytest.mark.parametrize("spread", ["dense", "clustered", "far apart", "negative"])
def test_position_cuts_equal_a_walk_however_positions_lie(spread, spark):
    rng = random.Random(spread)
    positions = {
        "dense": range(60),
        "clustered": [*range(40), 10**12, 10**15, *range(10**15 + 1, 10**15 + 20)],
        "far apart": rng.sample(range(2**62), 60),
        "negative": rng.sample(range(-(2**40), 2**40), 60),
    }[spread]
    data = [(p, rng.choice("aaaab"), rng.randint(0, 9)) for p in positions]
    rows = table(spark, data)
    limits = {"a": 70, "b": 15}
    ends = find_boundaries(rows, by_position("id"), limits, weight="w", group="source", **SMALL)
    known = {"rows_known": len(data)}
    assert ends == find_boundaries(rows, by_position("id"), limits, weight="w", group="source", **known)
    for source, limit in limits.items():
        expected = prefix(sorted((p, w) for p, s, w in data if s == source), limit)
        assert ids(keep(rows, ends, "source").where(F.col("source") == source)) == expected
        assert ends[source].rows == len(expected)
        assert ends[source].weight == sum(w for p, _, w in data if p in expected)
        assert ends[source].total_rows == sum(1 for _, s, _ in data if s == source)


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_seeded_cuts_do_not_depend_on_partitions(spark, partitions):
    rows = table(spark, [(i, "a", 1) for i in range(200)], partitions)
    for search in ({}, SMALL, {"rows_known": 200}):
        ends = find_boundaries(rows, shuffled(5, "id"), 77, **search)
        assert ids(keep(rows, ends)) == sorted(seeded(5, range(200))[:77])


def test_seeds_draw_different_rows(spark):
    rows = table(spark, [(i, "a", 1) for i in range(200)])
    drawn = [ids(keep(rows, find_boundaries(rows, shuffled(s, "id"), 50))) for s in (1, 2)]
    assert drawn[0] != drawn[1]


def test_ids_of_several_columns(spark):
    rows = table(spark, [(i // 2, "ab"[i % 2], 1) for i in range(40)])
    ends = find_boundaries(rows, shuffled(3, "source", "id"), 11)
    expected = sorted(
        ((i, s) for i in range(20) for s in "ab"),
        key=lambda r: hashlib.md5(f"3:{r[1]}:{r[0]}".encode()).hexdigest(),
    )[:11]
    assert sorted((r["id"], r["source"]) for r in keep(rows, ends).collect()) == sorted(expected)


def test_share_of_total_truncates(spark):
    rows = table(spark, [(i, "a", 1) for i in range(60)])
    ends = find_boundaries(rows, by_position("id"), share_of_total(1 - 0.02))
    assert ends[""].rows == int(60 * (1 - 0.02)) == 58


def test_groups_kept_whole_cut_or_left_out(spark):
    data = [(i, s, 1) for i, s in enumerate("aabbbccd")]
    rows = table(spark, data)
    for search in ({}, SMALL, {"rows_known": 8}):
        ends = find_boundaries(rows, by_position("id"), {"a": 9, "b": 2, "c": 0}, group="source", **search)
        assert ids(keep(rows, ends, "source")) == [0, 1, 2, 3]
        assert ends["a"].whole and ends["c"].rows == 0 and ends["d"].rows == 0
        assert (ends["b"].rows, ends["b"].total_rows) == (2, 3)


def test_rows_without_a_group_are_dropped(spark):
    rows = table(spark, [(i, "a" if i % 2 else None, 1) for i in range(10)])
    for search in ({}, {"rows_known": 10}):
        ends = find_boundaries(rows, by_position("id"), 3, group="source", **search)
        assert list(ends) == ["a"] and ids(keep(rows, ends, "source")) == [1, 3, 5]


def test_no_rows_no_boundary(spark):
    rows = table(spark, [(1, "a", 1)]).where("id > 1")
    ends = find_boundaries(rows, by_position("id"), 5)
    assert ends == {} and keep(rows, ends).count() == 0


def test_equal_positions_are_refused(spark):
    rows = table(spark, [(7, "a", 1) for _ in range(20)])
    for search in ({}, SMALL, {"rows_known": 20}):
        with pytest.raises(ValueError, match="not unique"):
            find_boundaries(rows, by_position("id"), 10, **search)


def test_the_end_of_a_position_cut_reaches_the_scan(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = physical_plan(rows.where(inside(find_boundaries(rows, by_position("doc_id"), 50))))
    assert "LessThanOrEqual(doc_id,49)" in plan and "Exchange" not in plan and "Join" not in plan


def test_cutting_shuffles_no_text(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ends = find_boundaries(rows, by_position("doc_id"), 5, group="source")
    for kept in (keep(rows, ends, "source"), rows.where(inside(find_boundaries(rows, shuffled(1, "doc_id"), 50)))):
        assert "Exchange" not in physical_plan(kept)


@pytest.mark.parametrize("known", [None, 4])
@pytest.mark.parametrize("order", [by_position("i"), shuffled(1, "i")])
@pytest.mark.parametrize("limit", [2, 100])
def test_rows_without_a_place_are_refused(spark, known, order, limit):
    rows = spark.createDataFrame([(1,), (2,), (None,), (4,)], "i long")
    with pytest.raises(Exception, match="row without i"):
        find_boundaries(rows, order, limit, rows_known=known, window_rows=2 if known is None else 500)


def test_many_groups_are_refused(spark, monkeypatch):
    from sluice.operators import cut

    monkeypatch.setattr(cut, "MAX_GROUPS", 5)
    rows = spark.range(30).withColumn("g", (F.col("id") % 6).cast("string"))
    for known in (None, 30):
        with pytest.raises(ValueError, match="at most 5 groups"):
            find_boundaries(rows, by_position("id"), 2, group="g", rows_known=known)
    assert len(find_boundaries(rows.where("g < 5"), by_position("id"), 2, group="g")) == 5
