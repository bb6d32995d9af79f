"""Exact byte-level BPE tokens, counted in Arrow batches.

A ``Vocabulary`` is read once on the driver (about 1 MB for 50,257 entries) and travels inside the
UDF; each Python worker builds the encoder once and keeps it for later tasks. The encoder lets go of
the ids it does not need: a count never turns them into Python lists. One text at a time is held as Python
objects, and ids and texts are handed on in parts of a bounded size, so a worker's memory is that of an Arrow batch.
"""

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from sluice.functions.text import TURN_END, TURN_START

# The public 50,257-entry vocabulary splits text by this pattern
# and names its end-of-text token so.
# The branch for blanks at the end of a text is its own and changes no token: without it, a long run of
# them exhausts the matcher.
SPLIT_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s++$|\s+(?!\S)|\s+"
)
END_OF_TEXT = "<|endoftext|>"
# Fixed value: the blanks of that pattern.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A longer run of blanks before other text exhausts the matcher too, so the text is cut there.
LONG_RUN = 10_000
#: Ids, or characters of text, that a part holds before it is handed on, and ids that are Python objects at once.
PART, PIECE = 1 << 20, 1 << 16


@dataclass(frozen=True)
class Vocabulary:
    """Byte-level merges as rank lines (``base64 rank``), plus tokens that are never split.

    Special tokens take the ids after the ranks, in order: end-of-text first, then the markers.
    """

    rank_lines: bytes
    specials: tuple[str, ...] = (END_OF_TEXT, TURN_START, TURN_END)

    @classmethod
    def from_file(cls, path: str) -> "Vocabulary":
        with open(path, "rb") as lines:
            return cls(lines.read())

    @classmethod
    def bytes_only(cls) -> "Vocabulary":
        """No merges: every byte is one token, every marker is one token."""
        return cls(b"\n".join(base64.b64encode(bytes([i])) + b" %d" % i for i in range(256)))

    @classmethod
    def with_merges(cls, *merges: bytes) -> "Vocabulary":
        """The single bytes and, in this order, what pairs of earlier tokens merge to."""
        ranks = [*cls.bytes_only().rank_lines.splitlines()]
        return cls(b"\n".join([*ranks, *(base64.b64encode(m) + b" %d" % (256 + i) for i, m in enumerate(merges))]))

    @property
    def base_size(self) -> int:
        return sum(1 for line in self.rank_lines.splitlines() if line.strip())

    @property
    def size(self) -> int:
        return self.base_size + len(self.specials)

    def special_ids(self) -> dict[str, int]:
        return {token: self.base_size + i for i, token in enumerate(self.specials)}

    def marker_table(self, spark: SparkSession):
        """(token, id) of the special tokens; padding reuses end-of-text."""
        ids = self.special_ids()
        rows = [(token, ids[token]) for token in self.specials]
        rows += [("pad", ids[END_OF_TEXT]), ("vocabulary size", self.size)]
        return spark.createDataFrame(rows, "token string, id int")


def segments(text: str, specials: Iterable[str] = ()) -> list[str]:
    """The text, cut before the last blank of each long run that other text follows.

    The pattern cuts there as well: all but the last blank of a run are one match, and the last one begins
    the next. So the segments' tokens are those of the text. A run before a special token ends there.
    """
    if len(text) <= LONG_RUN:
        return [text]
    other = "".join(f"(?!{re.escape(s)})" for s in specials)
    runs = re.finditer(f"(?<![{BLANKS}])[{BLANKS}]{{{LONG_RUN},}}+{other}(?=[^{BLANKS}])", text)
    cuts = [0, *(m.end() - 1 for m in runs), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])] if len(cuts) > 2 else [text]


def _encoder_factory(vocabulary: Vocabulary):
    """A function that builds or finds the encoder; it is shipped whole to the workers."""
    lines, specials = vocabulary.rank_lines, vocabulary.special_ids()
    name = hashlib.sha256(lines + repr(specials).encode()).hexdigest()
    pattern = SPLIT_PATTERN

    def encoder():
        import tiktoken

        known = tiktoken.registry.ENCODINGS
        if name not in known:
            pairs = (line.split() for line in lines.splitlines() if line.strip())
            known[name] = tiktoken.Encoding(
                name,
                pat_str=pattern,
                mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
                special_tokens=specials,
            )
        return known[name]

    return encoder


def token_count(text: Column, vocabulary: Vocabulary) -> Column:
    """Exact number of tokens; null for null.

    Marked non-deterministic so that a filter on the count is not pushed below it and evaluated twice; so
    filter first what can be filtered, and give the count a column before aggregating it.
    """
    encoder, specials = _encoder_factory(vocabulary), vocabulary.specials

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder().encode_to_numpy

        def size(text: str) -> int:
            return sum(encode(part, allowed_special="all").size for part in segments(text, specials))

        for batch in batches:
            yield pa.array([size(s.as_py()) if s.is_valid else None for s in batch], pa.int64())

    return arrow_udf(count, T.LongType()).asNondeterministic()(text)


def _lists(rows: list[np.ndarray | None]) -> pa.Array:
    """Lists of ids from their arrays, without a Python object for each id."""
    sizes = [0 if r is None else r.size for r in rows]
    values = np.concatenate([np.zeros(0, np.int32), *(r.view(np.int32) for r in rows if r is not None)])
    missing = pa.array([r is None for r in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(values, pa.int32()), mask=missing)


def token_ids(text: Column, vocabulary: Vocabulary) -> Column:
    """Token ids in order; null for null."""
    encoder, specials = _encoder_factory(vocabulary), vocabulary.specials

    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder().encode_to_numpy

        def all_ids(text: str) -> np.ndarray:
            return np.concatenate([encode(part, allowed_special="all") for part in segments(text, specials)])

        for batch in batches:
            found, held = [], 0
            for text in batch:
                found.append(all_ids(text.as_py()) if text.is_valid else None)
                held += found[-1].size if text.is_valid else 0
                if held >= PART:
                    yield _lists(found)
                    found, held = [], 0
            yield _lists(found)

    return arrow_udf(ids, T.ArrayType(T.IntegerType())).asNondeterministic()(text)


def decoded(ids: Column, vocabulary: Vocabulary) -> Column:
    """Text of token ids; bytes cut in the middle of a character become U+FFFD."""
    encoder = _encoder_factory(vocabulary)

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bytes_of = encoder().decode_bytes

        def text_of(own: np.ndarray) -> str:
            parts = [bytes_of(own[at : at + PIECE].tolist()) for at in range(0, own.size, PIECE)]
            return b"".join(parts).decode(errors="replace")

        for batch in batches:
            texts, held = [], 0
            for row in batch:
                texts.append(text_of(row.values.to_numpy()) if row.is_valid else None)
                held += len(texts[-1]) if row.is_valid else 0
                if held >= PART:
                    yield pa.array(texts, pa.string())
                    texts, held = [], 0
            yield pa.array(texts, pa.string())

    return arrow_udf(decode, T.StringType()).asNondeterministic()(ids)


def positions_of(ids: Column, token_id: int) -> Column:
    """0-based positions of one id in an id array."""
    marked = F.transform(ids, lambda x, i: F.when(x == token_id, i))
    return F.filter(marked, lambda i: i.isNotNull())
