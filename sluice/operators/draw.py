"""The first rows of a seeded order, as a sample of an exact size."""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from sluice.functions.order import shuffled
from sluice.operators.cut import Boundary, find_boundaries, keep
from sluice.operators.stage import Stage, plain

# A draw of few rows stages the ids of twice the share of the order that would hold them if every row were
# usable; a draw that needs more than a quarter of the source stages the ids of all usable rows.
HEADROOM = 2
FEW = 0.25
# The smallest share probed, well above what an order can still tell apart, and the growth after a probe
# without any usable row.
LEAST_SHARE = 2.0**-28
GROWTH = 16


@dataclass(frozen=True)
class Drawn:
    """The rows drawn, their ids alone, their number, and where the draw ends."""

    rows: DataFrame
    ids: DataFrame
    count: int
    ends: Mapping[str, Boundary]


def draw(
    usable: DataFrame, ids: tuple[str, ...], n: int, seed: int, source_rows: int, stage: Stage, name: str
) -> Drawn:
    """The first ``n`` usable rows of the seeded order, or all of them.

    Ids are staged, never a text, whatever the share: of the beginning of the order that should hold the rows, of more
    of it if too few rows there were usable, or of all usable rows once a large part is needed. The rows are then read
    where they lie, by a filter; nothing is shuffled.
    """
    order = shuffled(seed, *ids)
    usable_ids = usable.select(*ids)
    beginning = _beginning(usable_ids, ids, n, seed, source_rows, stage, name)
    if beginning is None:
        staged = stage.write(usable_ids, f"{name}-ids", narrow=True)
        beginning = staged.rows, staged.count
    staged_ids, count = beginning
    ends = find_boundaries(staged_ids, order, n, rows_known=count)
    return Drawn(keep(usable, ends), keep(staged_ids, ends), ends[""].rows if ends else 0, ends)


def _beginning(
    usable_ids: DataFrame, ids: tuple[str, ...], n: int, seed: int, source_rows: int, stage: Stage, name: str
) -> tuple[DataFrame, int] | None:
    """The ids of at least ``n`` usable rows from the beginning of the order and their number; None if that is a large part."""
    order, parts, count, start = shuffled(seed, *ids), [], 0, 0.0
    end = max(LEAST_SHARE, HEADROOM * n / source_rows) if source_rows else 1.0
    while end <= FEW:
        parts.append(f"{name}/{len(parts)}")
        count += stage.write(usable_ids.where(order.share(start, end)), parts[-1], narrow=True).count
        if count >= n:
            return stage.read(plain(usable_ids.schema), *parts), count
        # By the density found, but never more than so many times the share that has been looked at.
        start, end = end, end * min(GROWTH, HEADROOM * n / count if count else GROWTH)
    return None
