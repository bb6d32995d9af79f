"""Total orders of rows that do not depend on partitioning."""

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

HASH_DIGITS = 32
SHARE_DIGITS = 8


@dataclass(frozen=True)
class Order:
    """Rows by a long position, or by a seeded hash of their ids (``seed`` set).

    The ids together must be unique and not null.
    """

    ids: tuple[str, ...]
    seed: int | None = None

    @property
    def seeded(self) -> bool:
        return self.seed is not None

    def hash_text(self) -> Column:
        parts = [F.col(c).cast("string") for c in self.ids]
        return F.md5(F.concat_ws(":", F.lit(str(self.seed)), *parts))

    def buckets(self, span: tuple[int, int], bits: int) -> Iterator[tuple[int, Column]]:
        """Ever finer buckets that sort like the order, each ``bits`` finer than the one before.

        Positions are cut into ranges of 2^depth, hashes by their first ``depth`` hexadecimal digits.
        """
        if self.seeded:
            step = -(-bits // 4)
            for depth in range(step, HASH_DIGITS + step, step):
                yield min(depth, HASH_DIGITS), F.substring(self.hash_text(), 1, depth)
            return
        depth = (span[1] - span[0]).bit_length()
        while True:
            depth = max(0, depth - bits)
            yield depth, F.shiftright(F.col(self.ids[0]).cast("long"), depth)
            if depth == 0:
                return

    def share(self, start: float, end: float) -> Column:
        """The rows of a seeded order from one share of it to another, 0 and 1 being its ends."""
        first, stop = (int(s * 16**SHARE_DIGITS) for s in (start, end))
        part = self.hash_text() >= f"{first:0{SHARE_DIGITS}x}"
        return part & (self.hash_text() < f"{stop:0{SHARE_DIGITS}x}") if end < 1 else part

    def keys(self) -> list[Column]:
        ids = [F.col(c) for c in self.ids]
        return [self.hash_text(), *ids] if self.seeded else ids

    def key(self) -> Column:
        keys = self.keys()
        return keys[0] if len(keys) == 1 else F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])

    def literal(self, last: tuple) -> Column:
        """The key of the row whose keys are ``last``, as a literal."""
        values = [F.lit(v) for v in last]
        return values[0] if len(values) == 1 else F.struct(*[v.alias(f"k{i}") for i, v in enumerate(values)])


def by_position(column: str) -> Order:
    """Ascending order of a unique long column."""
    return Order((column,))


def shuffled(seed: int, *ids: str) -> Order:
    """A reproducible, uniform-looking permutation of the rows."""
    return Order(tuple(ids), seed)
