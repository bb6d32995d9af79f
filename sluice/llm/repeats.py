"""Exact substring deduplication over sampled suffix arrays, sorted deep-shallow.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts anywhere else, in the same text or another.

1. Each window of LENGTH bytes has an anchor: the place of the smallest hash among its SEED-byte strings, the last of
   equals. Equal windows have equal anchors. Neighbouring windows with one anchor are a run; a run's context is what
   its windows cover, at most 2 * LENGTH - SEED bytes. About one byte in 84 is an anchor.
2. Runs whose anchor string occurs once are unique and go. Two runs of equal contexts are repeats through and through:
   that settles the inside of every repeated passage by counting, with partial aggregation.
3. What is left are contexts that differ but share an anchor, the ends of passages. Only those meet: the suffixes at
   their anchors and the reversed prefixes before them are sorted deep-shallow (``suffixes``), which gives common
   prefixes in both directions. Windows at a distance d before the anchor are equal where the prefixes agree in d
   bytes and the suffixes in LENGTH - d.
4. An anchor with more than ``group_rows`` differing contexts does not meet in one task: its windows are counted by a
   128-bit digest, which spreads them evenly and is as exact.

Texts travel twice, by id: to cut out contexts, and to be rid of the repeats. Everything else is narrow.

Cases: a null text is empty; texts under LENGTH bytes keep everything; repeated rows are repeats of each other, as
any two rows with equal texts; ids may be null; an empty table gives an empty one; other columns are ignored. Very
long texts are read in pieces, which may only cut a run in two. Stretches that repeat themselves at every few bytes, also
megabytes of one byte, take two runs a piece (``collapsed``).
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from sluice.llm.common import text_key
from sluice.llm.suffixes import deep_shallow
from sluice.operators.stage import Stage
from sluice.sources.tables import part_limit

LENGTH = 200
SEED = 32
PIECE = 1 << 21
GROUP_ROWS = 4096
CHUNK_ROWS = 16384
_PLACE_BITS = 22
_RANDOM = np.random.default_rng(20240506).integers(0, 1 << 64, 256, dtype=np.uint64)
_FACTORS = np.random.default_rng(7).integers(0, 1 << 63, 6, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# Anchors


def _seed_hashes(raw: np.ndarray) -> np.ndarray:
    """Hashes of the SEED-byte strings, by doubling their length."""
    h, size, turn = _RANDOM[raw], 1, 0
    while size < SEED:
        h = h[:-size] * _FACTORS[turn] + h[size:]
        h ^= h >> np.uint64(31)
        size, turn = 2 * size, turn + 1
    return h * _FACTORS[turn]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def runs_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key (the anchor string's hash), first window, number of windows and anchor's distance of each run."""
    hashes = _seed_hashes(raw)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    places = low - np.arange(len(hashes), dtype=np.uint64)  # the last of equals is the smallest
    chosen = _sliding_min((hashes & ~low) | places, LENGTH - SEED + 1)
    anchors = (low - (chosen & low)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
    sizes = np.diff(np.r_[first, len(anchors)])
    at = anchors[first]
    return hashes[at].view(np.int64), first, sizes, at - first


RUN = "key long, ctx long, start long, n int, ahead int, stretch long"
RUN_COLUMNS = [c.split()[0] for c in RUN.split(", ")]


def collapsed(key: np.ndarray, ctx: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs to hand on, and for each the end of the stretch of equal runs that it begins, 0 if it begins none.

    A text that repeats itself at every few bytes has a run a period, with one anchor string and one context. Two of a
    stretch are enough to be found repeats, of each other and of any other run; the first covers the stretch.
    """
    new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])])
    last = np.r_[new[1:], len(key)] - 1
    ends = np.zeros(len(key), np.int64)
    ends[new] = np.where(last > new, first[last] + n[last] + LENGTH - 1, 0)
    kept = np.union1d(new, np.minimum(new + 1, last))
    return kept, ends[kept]


def _text_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        texts, parts, rows, size = batch.column("text"), [], [], 0
        for row in range(batch.num_rows):
            whole = texts[row].as_buffer()
            if whole is None or whole.size < LENGTH:
                continue
            for at in range(0, whole.size - LENGTH + 1, PIECE):
                piece = memoryview(whole)[at : at + PIECE + LENGTH - 1]
                key, first, n, ahead = runs_of(np.frombuffer(piece, np.uint8))
                ctx = np.array([digest(piece[a:b]) for a, b in zip(first.tolist(), (first + n + LENGTH - 1).tolist())], np.uint64).view(np.int64)
                kept, ends = collapsed(key, ctx, first, n)
                ends[ends > 0] += at
                parts.append((key[kept], ctx[kept], first[kept] + at, n[kept].astype(np.int32), ahead[kept].astype(np.int32), ends))
                rows.append(np.full(len(kept), row))
                size += len(kept)
                if size >= 100_000:
                    yield _run_batch(batch, parts, rows)
                    parts, rows, size = [], [], 0
        if parts:
            yield _run_batch(batch, parts, rows)


def _run_batch(batch: pa.RecordBatch, parts: list, rows: list) -> pa.RecordBatch:
    take = pa.array(np.concatenate(rows))
    columns = [batch.column(c).take(take) for c in ("id", "text_key")]
    columns += [pa.array(np.concatenate(c)) for c in zip(*parts)]
    return pa.RecordBatch.from_arrays(columns, names=["id", "text_key", *RUN_COLUMNS])


def text_runs(texts: DataFrame) -> DataFrame:
    """(id, text_key, key, ctx, start, n, ahead, stretch) of the runs of (id, text_key, text)."""
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(_text_runs, f"id {kind}, text_key long, {RUN}")


# Ends of passages


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, wanted = batch.column("text"), batch.column("wanted")
        for row in range(batch.num_rows):
            raw = memoryview(texts[row].as_buffer())
            runs = wanted[row].values
            start, n = runs.field("start").to_numpy(), runs.field("n").to_numpy()
            cut = [bytes(raw[a:b]) for a, b in zip(start.tolist(), (start + n + LENGTH - 1).tolist())]
            take = pa.array(np.full(len(cut), row))
            columns = [batch.column(c).take(take) for c in ("id", "text_key")]
            columns += [runs.field(c) for c in ("key", "copies", "start", "n", "ahead", "hot")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cut, pa.binary())], names=["id", "text_key", "key", "copies", "start", "n", "ahead", "hot", "context"])


def repeated_windows(group: np.ndarray, copies: np.ndarray, n: np.ndarray, ahead: np.ndarray, contexts: list[bytes]) -> np.ndarray:
    """Which windows of each context occur again in its group; one row a context, a column for each distance d
    of a window's start before the anchor."""
    after = [c[a : a + LENGTH] for c, a in zip(contexts, ahead.tolist())]
    before = [c[:a][::-1] for c, a in zip(contexts, ahead.tolist())]
    count = len(contexts)
    order_after, same_after = deep_shallow(after, group)
    order_before, same_before = deep_shallow(before, group)
    out = np.zeros((count, LENGTH - SEED + 1), bool)
    class_after, class_before = np.empty(count, np.int64), np.empty(count, np.int64)
    nearest, farthest = ahead - n + 1, ahead
    for d in range(out.shape[1]):
        own = np.flatnonzero((nearest <= d) & (d <= farthest))
        if len(own) < 2:
            continue
        class_after[order_after] = np.cumsum(same_after < LENGTH - d)
        class_before[order_before] = np.cumsum(same_before < d)
        pair = class_after[own] * (count + 1) + class_before[own]
        _, kind = np.unique(pair, return_inverse=True)
        out[own, d] = np.bincount(kind, copies[own])[kind] > 1
    return out


def _spans(found: np.ndarray, keep: np.ndarray, start: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte and end of the stretches that repeated windows cover."""
    found = np.pad(found & keep[:, None], ((0, 0), (1, 1))).astype(np.int8)
    step = np.diff(found, axis=1)
    row, low = np.nonzero(step == 1)
    _, high = np.nonzero(step == -1)  # distances low .. high - 1 before the anchor
    base = start[row] + ahead[row]
    return row, base - (high - 1), base - low + LENGTH


def _sorted_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts come with equal keys together; whole groups are worked on, many at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < CHUNK_ROWS:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        keys = rows.column("key").to_numpy()
        whole = int(np.searchsorted(keys, keys[-1], "left"))
        if whole:
            yield _span_batch(rows.slice(0, whole))
        rest = rows.slice(whole).combine_chunks().to_batches()
        held, size = list(rest), sum(r.num_rows for r in rest)
    if size:
        yield _span_batch(pa.Table.from_batches(held).combine_chunks())


def _span_batch(rows: pa.Table) -> pa.RecordBatch:
    column = lambda c: rows.column(c).to_numpy()
    copies, start, ahead = column("copies"), column("start"), column("ahead").astype(np.int64)
    found = repeated_windows(column("key"), copies, column("n").astype(np.int64), ahead, rows.column("context").to_pylist())
    row, first, end = _spans(found, copies == 1, start, ahead)
    take = pa.array(row)
    columns = [rows.column(c).take(take).combine_chunks() for c in ("id", "text_key")]
    columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) and c.num_chunks else c for c in columns]
    columns = [pa.array([], c.type) if isinstance(c, pa.ChunkedArray) else c for c in columns]
    return pa.RecordBatch.from_arrays([*columns, pa.array(first), pa.array(end)], names=["id", "text_key", "first", "end"])


def _window_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        n, cut = batch.column("n").to_numpy(), batch.column("context").to_pylist()
        row = np.repeat(np.arange(len(n)), n)
        place = np.concatenate([np.arange(k) for k in n]) if len(n) else np.zeros(0, np.int64)
        words = np.frombuffer(b"".join([digest(c[i : i + LENGTH]) for c, k in zip(cut, n.tolist()) for i in range(k)]), np.int64).reshape(-1, 2)
        take = pa.array(row)
        columns = [batch.column(c).take(take) for c in ("id", "text_key", "copies")]
        first = batch.column("start").to_numpy()[row] + place
        yield pa.RecordBatch.from_arrays([*columns, pa.array(first), pa.array(words[:, 0].copy()), pa.array(words[:, 1].copy())], names=["id", "text_key", "copies", "first", "d1", "d2"])


# Spans of whole tables


def repeated_spans(docs: DataFrame, stage: Stage, id_col: str = "doc_id", text_col: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """(id, text_key, spans): overlapping byte ranges [first, end) to remove, of the texts that have any."""
    texts = keyed(docs, id_col, text_col)
    kind = texts.schema["id"].dataType.simpleString()
    parts = part_limit(docs)
    runs = text_runs(texts)
    # Written, so that the join is one of two plain shuffles, whose hot keys Spark splits.
    shared = stage.write(runs.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "keys", narrow=True, parts=parts).rows
    runs = stage.write(runs.join(shared, "key"), "runs", narrow=True, parts=parts).rows

    least = F.min(F.struct("id", "text_key", "start", "n", "ahead")).alias("r")
    classes = stage.write(runs.groupBy("key", "ctx").agg(F.count("*").alias("copies"), least), "contexts", narrow=True, parts=parts).rows
    whole = classes.where("copies > 1").select("key", "ctx")
    inside = runs.join(whole, ["key", "ctx"]).select(
        "id", "text_key", F.col("start").alias("first"), F.greatest(F.col("start") + F.col("n") + LENGTH - 1, "stretch").alias("end")
    )

    mixed = classes.groupBy("key").agg(F.count("*").alias("c"), F.min("copies").alias("m")).where("c > 1 AND m = 1")
    mixed = stage.write(mixed.select("key", (F.col("c") > group_rows).alias("hot")), "mixed", narrow=True, parts=parts).rows
    ends = classes.join(mixed, "key")
    wanted = ends.groupBy("r.id", "r.text_key").agg(F.collect_list(F.struct("key", "copies", "r.start", "r.n", "r.ahead", "hot")).alias("wanted"))
    of_text = texts.join(
        wanted.select(F.col("id").alias("i"), F.col("text_key").alias("k"), "wanted"),
        F.col("id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")),
    )
    columns = f"id {kind}, text_key long, key long, copies long, start long, n int, ahead int, hot boolean, context binary"
    cut = stage.write(of_text.select("id", "text_key", "text", "wanted").mapInArrow(_cut_contexts, columns), "ends", narrow=True, parts=parts).rows

    span = f"id {kind}, text_key long, first long, end long"
    sorted_ = cut.where("NOT hot").repartition("key").sortWithinPartitions("key").mapInArrow(_sorted_spans, span)
    windows = cut.where("hot").mapInArrow(_window_digests, f"id {kind}, text_key long, copies long, first long, d1 long, d2 long")
    often = windows.groupBy("d1", "d2").agg(F.sum("copies").alias("c")).where("c > 1").select("d1", "d2")
    counted = windows.where("copies = 1").join(often, ["d1", "d2"]).select("id", "text_key", "first", (F.col("first") + LENGTH).alias("end"))
    spans = inside.unionByName(sorted_).unionByName(counted)
    # A set, as rows repeated with their id have the same spans; those of one text are no more than its runs.
    return spans.groupBy("id", "text_key").agg(F.collect_set(F.struct("first", "end")).alias("spans"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(s) for s in out]


def kept_parts(raw: memoryview, spans: list[tuple[int, int]]) -> list[memoryview]:
    """What lies between merged spans."""
    ends = [0, *(b for _, b in spans)]
    starts = [*(a for a, _ in spans), len(raw)]
    return [raw[a:b] for a, b in zip(ends, starts)]


def whole_characters(raw: memoryview, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to whole characters, so that what is kept stays valid UTF-8."""
    out = []
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def with_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, spans): each whole row of ``docs`` as a struct with its spans, null if it has none."""
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("text_key"))
    found = spans.select(F.col("id").alias("i"), F.col("text_key").alias("k"), "spans")
    joined = rows.join(found, F.col("id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")), "left")
    return joined.select("row", "spans").coalesce(part_limit(docs))


def _pairs(spans) -> list[tuple[int, int]]:
    if not spans.is_valid:
        return []
    return merged(list(zip(spans.values.field("first").to_pylist(), spans.values.field("end").to_pylist())))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans, out = batch.column("text"), batch.column("spans"), []
        for row in range(batch.num_rows):
            whole = texts[row].as_buffer()
            raw = memoryview(whole if whole is not None else b"")
            gone = _pairs(spans[row])
            left = hashlib.sha256()
            for part in kept_parts(raw, gone):
                left.update(part)
            out.append((len(raw), sum(b - a for a, b in gone), len(gone), left.hexdigest()))
        columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))] if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def removal_digests(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    texts = docs.select(F.col(id_col), F.col(text_col))
    rows = with_spans(texts, spans, id_col, text_col).select(F.col(f"row.{id_col}").alias("id"), F.col(f"row.{text_col}").alias("text"), "spans")
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_digests, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("id", id_col)


def _kept_texts(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for row in range(len(texts)):
        whole, gone = texts[row].as_buffer(), _pairs(spans[row])
        if whole is None or not gone:
            out.append(texts[row].as_py())
            continue
        raw = memoryview(whole)
        out.append(b"".join(kept_parts(raw, whole_characters(raw, gone))).decode())
    return pa.array(out, pa.string())


def without_repeats(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the spans cut from their texts, in whole characters; a null text stays null."""
    cut = arrow_udf(_kept_texts, "string").asNondeterministic()
    rows = with_spans(docs, spans, id_col, text_col)
    return rows.withColumn("left", cut(F.col(f"row.{text_col}"), "spans")).select(
        *[F.col("left" if c == text_col else f"row.`{c}`").alias(c) for c in docs.columns]
    )
