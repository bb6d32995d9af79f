"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, each text scanned once.

A window is ``window`` consecutive words of an item (all of a shorter item's words); a document word inside any
occurrence of a window is hit. The automaton holds seeds, not windows: any window of w words covers one of the
item's blocks of (w + 1) / 2 words at multiples of that length, so it is enough to find the blocks, each by its first
bytes. Where a seed is found and the whole block follows, the windows of the text that cover it are looked up among the
items'. A window is known once, by a digest of 128 bits, with the group of items that share it, so passages common to many
items cost no more than others. Texts are compared as normalised bytes; hits are mapped to characters of the original.

The items are read into every worker, which keeps its automaton from task to task, so their size is checked: beyond
``part_bytes`` they are dealt to several automata, each of which scans the documents, one after the other.

Cases: a null or empty text has no words and is never contaminated; an item without words has no window; rows of one
item id are one item with several texts; an item with a null id hits words, but is not listed; repeated documents
each return a row; empty tables give no rows, or no hits; other columns are ignored.
"""

import hashlib
import pickle
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sluice.llm.common import per_text, text_key
from sluice.operators.stage import Stage

WINDOW = 13
#: Bytes of item texts in one automaton; README has the memory that they take in a worker.
PART_BYTES = 20 << 20
#: First bytes of a block by which it is found: fewer take less memory, more find fewer blocks in vain.
SEED_BYTES = 24
SHARE = 20

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "struct<n_words:long,words:array<struct<start:int,end:int>>,spans:array<struct<start:int,end:int>>,items:array<string>>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_KIND = pa.struct([("n_words", pa.int64()), ("words", _SPAN), ("spans", _SPAN), ("items", pa.list_(pa.string()))])


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_LETTERS).split()


def _joined(words: list[bytes]) -> str:
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def seeds_of(words: list[bytes], window: int) -> list[tuple[int, int]]:
    """(place, length) of the blocks by which occurrences of an item's windows are found."""
    if len(words) < window:
        return [(0, len(words))] if words else []
    size = (window + 1) // 2
    return [(at, size) for at in range(0, len(words) - size + 1, size)]


_digest = xxhash.xxh3_128_digest


class Phrases:
    """Sequences of words by their digests, each with a number, in sorted arrays of 20 bytes a sequence."""

    def __init__(self, digests: np.ndarray, numbers: np.ndarray):
        self.high, self.low = np.ascontiguousarray(digests[:, 0]), np.ascontiguousarray(digests[:, 1])
        self.numbers = numbers

    def __len__(self) -> int:
        return len(self.numbers)

    def find(self, digests: bytearray) -> np.ndarray:
        """The number of each of the digests, -1 for one that is not known."""
        high, low = np.frombuffer(digests, np.uint64).reshape(-1, 2).T
        found, at, left = np.full(len(high), -1, np.int64), np.searchsorted(self.high, high), np.arange(len(high))
        while len(left):
            left = left[at[left] < len(self.high)]
            left = left[self.high[at[left]] == high[left]]
            same = self.low[at[left]] == low[left]
            found[left[same]] = self.numbers[at[left[same]]]
            left = left[~same]
            at[left] += 1
        return found


def _sorted_pairs(digests: bytearray, owners: array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (digest, owner) in order, and where each digest begins."""
    keys, own = np.frombuffer(digests, np.uint64).reshape(-1, 2), np.frombuffer(owners, np.int32)
    order = np.lexsort((own, keys[:, 1], keys[:, 0]))
    keys, own = keys[order], own[order]
    other = np.ones(len(own), bool)
    other[1:] = (keys[1:] != keys[:-1]).any(axis=1) | (own[1:] != own[:-1])
    keys, own = keys[other], own[other]
    heads = np.ones(len(own), bool)
    heads[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    return keys, own, np.flatnonzero(heads)


@dataclass(frozen=True)
class Known:
    """The automaton of the items' seeds (None without any), what a seed's number says (its length, and of how many words
    the blocks are that begin with it), the blocks, the group of each window, and the ids of each group's items."""

    automaton: object
    shapes: list[tuple[int, tuple[int, ...]]]
    blocks: Phrases
    windows: Phrases
    groups: list[frozenset[str | None]]


def build(items: list[tuple[str | None, str]], window: int) -> Known:
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    shapes: dict[tuple[int, tuple[int, ...]], int] = {}
    named: list[tuple[int, tuple[int, ...]]] = []
    ids: dict[str | None, int] = {}
    windows, owners, blocks = bytearray(), array("i"), bytearray()
    for item, text in items:
        words, number = words_of(text), ids.setdefault(item, len(ids))
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            windows += _digest(b" ".join(words[at : at + size]))
            owners.append(number)
        for at, block in seeds_of(words, window):
            blocks += _digest(b" ".join(words[at : at + block]))
            seed = _joined(words[at : at + block])[:SEED_BYTES]
            before = automaton.get(seed, -1)
            sizes = named[before][1] if before >= 0 else ()
            if block not in sizes:
                shape = (len(seed), tuple(sorted((*sizes, block))))
                if shape not in shapes:
                    shapes[shape] = len(named)
                    named.append(shape)
                automaton.add_word(seed, shapes[shape])
    if len(automaton):
        automaton.make_automaton()
    keys, own, heads = _sorted_pairs(windows, owners)
    ends = np.append(heads[1:], len(own))
    numbers, groups = own[heads].copy(), [frozenset([item]) for item in ids]
    names, shared = list(ids), {}
    for i in np.flatnonzero(ends - heads > 1):
        who = own[heads[i] : ends[i]].tobytes()
        if who not in shared:
            shared[who] = len(groups)
            groups.append(frozenset(names[n] for n in np.frombuffer(who, np.int32)))
        numbers[i] = shared[who]
    block_keys, _, block_heads = _sorted_pairs(blocks, array("i", bytes(4 * (len(blocks) // 16))))
    known_blocks = Phrases(block_keys[block_heads], np.zeros(len(block_heads), np.int32))
    return Known(automaton if len(automaton) else None, named, known_blocks, Phrases(keys[heads], numbers), groups)


def _words_at(joined: str, blank: int, size: int) -> bytes | None:
    """The ``size`` words after a blank, None if there are fewer."""
    end = blank
    for _ in range(size):
        end = joined.find(" ", end + 1)
        if end < 0:
            return None
    return joined[blank + 1 : end].encode("latin-1")


def runs_in(words: list[bytes], known: Known, window: int) -> tuple[list[tuple[int, int]], set[int]]:
    """Merged word runs inside occurrences of windows, and the groups of items that these come from."""
    joined, places, digests = _joined(words), [], bytearray()
    for last, shape in known.automaton.iter(joined):
        length, sizes = known.shapes[shape]
        blank = last - length + 1
        for block in sizes:
            phrase = _words_at(joined, blank, block)
            if phrase is not None:
                places.append((blank, block))
                digests += _digest(phrase)
    real = np.flatnonzero(known.blocks.find(digests) >= 0)
    if not len(real):
        return [], set()
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    spans = {}
    for i in real:
        blank, block = places[i]
        first = bisect_left(starts, blank)
        spans[first, block] = None  # an item of so few words
        for before in range(max(0, first + block - window), min(first, len(words) - window) + 1):
            spans[before, window] = None
    looked_up = list(spans)
    digests = bytearray().join(_digest(b" ".join(words[first : first + size])) for first, size in looked_up)
    groups = known.windows.find(digests)
    inside = np.flatnonzero(groups >= 0)
    runs = [(looked_up[i][0], sum(looked_up[i])) for i in inside]
    return merged(runs), set(groups[inside].tolist())


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


def scanner(items: list[tuple[str | None, str]], window: int) -> Callable[[str], dict]:
    known = build(items, window)

    def scan(text: str) -> dict:
        words = words_of(text)
        runs, groups = runs_in(words, known, window) if known.automaton and words else ([], set())
        spans = []
        if runs:
            at = [m.span() for m in _WORD.finditer(text)]
            spans = [(at[a][0], at[b - 1][1]) for a, b in runs]
        pairs = lambda xs: [{"start": a, "end": b} for a, b in xs]
        ids = sorted(frozenset().union(*(known.groups[g] for g in groups)) - {None})
        return {"n_words": len(words), "words": pairs(runs), "spans": pairs(spans), "items": ids}

    return scan


_last: tuple[tuple[bytes, int], Callable[[str], dict]] | None = None


def _worker_scanner(pickled: bytes, window: int) -> Callable[[str], dict]:
    """The scanner of pickled items, kept by a worker from one task to the next."""
    global _last
    key = (hashlib.sha256(pickled).digest(), window)
    if _last is None or _last[0] != key:
        _last = (key, scanner(pickle.loads(pickled), window))
    return _last[1]


def _parts(benchmark: DataFrame, item_col: str, text_col: str, part_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items, dealt to lists of at most about ``part_bytes`` each, of which the driver holds one at a time."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("text IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // part_bytes) or 1
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
        yield [tuple(r) for r in own.collect()]


def _scan(docs: DataFrame, items: list[tuple[str | None, str]], window: int) -> Callable[[Column], Column]:
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(items))
    return per_text(lambda: _worker_scanner(shared.value, window), _KIND, SCHEMA)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    stage: Stage,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(id, text_key, n_words, words, spans, items) of every row.

    ``words`` are the hit runs as word numbers, ``spans`` the same as characters of the text, ``items`` the ids of
    items with occurring windows, sorted as strings.
    """
    scans = []
    for items in _parts(benchmark, item_col, item_text_col, part_bytes):
        hits = _scan(docs, items, window)(F.col(text_col)).alias("s")
        scans.append(docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("text_key"), hits).select("id", "text_key", "s.*"))
    found = scans[0]
    if len(scans) > 1:
        found = _combined([stage.write(scan, f"scan-{i}").rows for i, scan in enumerate(scans)])
    return found.withColumnRenamed("id", id_col)


def _combined(scans: list[DataFrame]) -> DataFrame:
    """Rows of the first scan with what any scan has hit. A scan's runs are few, and those of one text."""
    key = ["id", "text_key"]
    hits = None
    for scan in scans:
        own = scan.where(F.size("words") > 0).select(*key, F.arrays_zip("words", "spans").alias("runs"), "items")
        hits = own if hits is None else hits.unionByName(own)
    union = lambda runs: F.aggregate(
        F.array_sort(runs),
        F.lit([]).cast("array<struct<words:struct<start:int,end:int>,spans:struct<start:int,end:int>>>"),
        lambda done, r: F.when(
            (F.size(done) > 0) & (r["words"]["start"] <= F.element_at(done, -1)["words"]["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(_longer(F.element_at(done, -1), r))),
        ).otherwise(F.concat(done, F.array(r))),
    )
    by_row = hits.groupBy(*key).agg(
        union(F.flatten(F.collect_set("runs"))).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    ).select(F.col("id").alias("i"), F.col("text_key").alias("k"), "runs", "items")
    first = scans[0].select(*key, "n_words")
    empty = "array<struct<start:int,end:int>>"
    return first.join(by_row, F.col("id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")), "left").select(
        *key,
        "n_words",
        F.coalesce(F.col("runs.words"), F.lit([]).cast(empty)).alias("words"),
        F.coalesce(F.col("runs.spans"), F.lit([]).cast(empty)).alias("spans"),
        F.coalesce("items", F.lit([]).cast("array<string>")).alias("items"),
    )


def _longer(a, b):
    parts = [F.struct(a[p]["start"].alias("start"), F.greatest(a[p]["end"], b[p]["end"]).alias("end")).alias(p) for p in ("words", "spans")]
    return F.struct(*parts)


def hit_words(runs: Column) -> Column:
    return F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])


def clean(
    docs: DataFrame, benchmark: DataFrame, stage: Stage, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, part_bytes: int = PART_BYTES, share: int = SHARE,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated. With one automaton rows are judged where they are read; with
    several, the ids of contaminated ones are joined."""
    parts = _parts(benchmark, item_col, item_text_col, part_bytes)
    only, more = next(parts), next(parts, None)
    if more is None:
        rows = docs.select(F.struct("*").alias("_row"), _scan(docs, only, window)(F.col(text_col)).alias("_s"))
        hit = hit_words(F.col("_s.words"))
        return rows.where((hit == 0) | (share * hit < F.col("_s.n_words"))).select("_row.*")
    found = contamination(docs, benchmark, stage, id_col, text_col, item_col, item_text_col, window, part_bytes)
    bad = found.withColumn("hit", hit_words(F.col("words"))).where((F.col("hit") > 0) & (share * F.col("hit") >= F.col("n_words")))
    bad = stage.write(bad.select(F.col(id_col).alias("_i"), F.col("text_key").alias("_k")).distinct(), "contaminated", narrow=True).rows
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_key"))
    return rows.join(bad, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k")), "left_anti").select("_row.*")


def figures(found: DataFrame, id_col: str = "doc_id", share: int = SHARE) -> DataFrame:
    """Numbers and the verdict: contaminated if at least one in ``share`` words is hit."""
    return found.withColumn("n_hit", hit_words(F.col("words"))).select(
        id_col,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
