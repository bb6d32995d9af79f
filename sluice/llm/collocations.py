"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

1. ``stripes``: each task cuts its texts into pieces and words and counts, for every prefix of ``level`` words, the
   words that follow it in the piece. What follows nothing (the piece ends, or the extension cannot be frequent) is
   counted under ``END``, so that a stripe always sums to its prefix's total. Prefixes are dealt to buckets by hash, and
   the stripes of a bucket leave the task together, compressed.
2. ``merged``: the stripes of a bucket meet, and those of one prefix are added elementwise. One structure then holds the prefix's total, its
   frequent extensions, and the largest of them, which decides whether the prefix is subsumed to the right.
3. Levels 0 to ``most_words`` - 1 follow each other. A phrase can only be frequent if the phrases it is made of are,
   so a level keeps prefixes and extensions that pass a filter of the frequent phrases of the level before: bits by
   hash, ``FILTER_BITS`` of them whatever the corpus, which let some others pass but none fail. Counts are exact.
4. ``collocations``: the frequent phrases meet the totals of their parts; subsumed ones go; the best of each language.

A prefix with more than a ``HEAVY_SHARE`` of all words is heavy (there are at most 1 / HEAVY_SHARE of them): its
stripes are dealt by the hash of the following word, so no stripe is held whole in one task. The empty prefix always is.

Cases: a null text is empty; a null lang is ``und``; empty texts and texts of separators have no words; repeated rows
count each; ties of score go by number, then by phrase; an empty table gives an empty one; a text of any length is cut
into slices at blanks; other columns are ignored, whatever their names.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from sluice.operators.stage import Stage

MIN_COUNT = 10
MOST_WORDS = 3
SUBSUMED_PERCENT = 50
TOP = 2000
SCALE = 1_000_000
HEAVY_SHARE = 1 / 4096
HEAVY_PARTS = 256
FILTER_BITS = 1 << 27
#: Bytes of text that a task counts before it hands on its stripes.
FLUSH_BYTES = 16 << 20
#: Stands for the end of a piece. A full stop parts pieces, so it is never a word.
END = b"."

_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_LOWER = bytes(range(256)).lower()
_TABLE = _LOWER.translate(bytes.maketrans(_SEPARATORS + b"\t", END * len(_SEPARATORS) + b" "))
#: A stripe: its language and prefix as one label, the following words, each with a space, and their counts.
STRIPE = pa.schema([("label", pa.binary()), ("words", pa.binary()), ("counts", pa.binary())])
BUCKET_DDL = "bucket int, stripes binary"
MERGED_DDL = "lang string, prefix binary, total long, words array<binary>, counts array<long>"
MERGED = pa.schema(
    [("lang", pa.string()), ("prefix", pa.binary()), ("total", pa.int64()), ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))]
)
#: Buckets for each of the session's shuffle partitions; entries of a bucket that are held before they are added.
BUCKETS, HELD = 8, 2_000_000


# Words as numbers


def words_of(text: bytes) -> pa.Array:
    """The words and ends of a text whose separators are full stops and whose blanks are spaces."""
    chars = np.frombuffer(text, np.uint8)
    word, end = chars != 32, chars == END[0]
    starts = word.copy()
    starts[1:] &= ~word[:-1] | end[1:] | end[:-1]
    chars, starts = chars[word], np.flatnonzero(starts[word])
    return _strings(np.append(starts, len(chars)), chars)


def _strings(offsets: np.ndarray, chars) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(chars)])


def hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words.to_pylist()), np.uint64, len(words))


def _mixed(before, word):
    """The hash of a phrase from that of its words but the last, and that of the last; numbers or arrays of uint64."""
    with np.errstate(over="ignore"):
        mixed = (before ^ word) * np.uint64(0x9E3779B97F4A7C15)
        return mixed ^ mixed >> np.uint64(29)


def _of_lang(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode()))


def _places(phrases: np.ndarray) -> np.ndarray:
    return (phrases & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def frequent_bits(stripe_rows: DataFrame) -> bytes:
    """The filter of the extensions of ``merged`` rows: a bit for each hash. At most FILTER_BITS / 64 numbers come to
    the driver, whatever the rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, words = batch["words"], hashes(batch["words"].flatten())
            prefixes = []
            for lang, prefix in zip(batch["lang"].to_pylist(), batch["prefix"].to_pylist()):
                phrase = _of_lang(lang)
                for word in prefix.split(b" ") if prefix else ():
                    phrase = _mixed(phrase, np.uint64(xxhash.xxh64_intdigest(word)))
                prefixes.append(phrase)
            sizes = lists.value_lengths().to_numpy()
            yield pa.record_batch([pa.array(_places(_mixed(np.repeat(np.array(prefixes, np.uint64), sizes), words)))], names=["at"])

    places = stripe_rows.where(F.size("words") > 0).select("lang", "prefix", "words").mapInArrow(work, "at long")
    bits = places.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
    rows, out = bits.toArrow(), np.zeros(FILTER_BITS // 64, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.tobytes()


# Stripes of a task


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[first], np.diff(np.append(first, len(keys)))


def _windows(t: np.ndarray, words: int, level: int, phrase_fits: np.ndarray, suffix_fits: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Prefixes of ``level`` words and the word after them, of numbers below ``words``: (the words of each prefix, the
    prefix of each extension, the extension, its count), sorted by prefix.

    Only places where ``phrase_fits`` begin a prefix; where ``suffix_fits`` is false, the extension counts as an end.
    """
    starts = np.flatnonzero(phrase_fits)
    after = np.where(suffix_fits[starts], t[starts + level], 0)
    prefix, tables = np.zeros(len(starts), np.int64), {}
    for width in range(level):
        if len(prefix) and (int(prefix.max()) + 1) * words * words >= 1 << 63:
            tables[width] = np.unique(prefix)
            prefix = np.searchsorted(tables[width], prefix)
        prefix = prefix * words + t[starts + width]
    keys, counts = _counted(prefix * words + after)
    prefix, after = keys // words, keys % words
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), prefix[1:] != prefix[:-1])))
    number = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(keys))))
    left, parts = prefix[new], []
    for width in range(level - 1, -1, -1):
        parts.insert(0, left % words)
        left = left // words
        if width in tables:
            left = tables[width][left]
    return parts, number, after, counts


def _stripes(text: bytes, level: int, lang: str, buckets: int, known: np.ndarray | None, heavy: set[bytes]) -> tuple[pa.Table | None, np.ndarray, bytes]:
    """The stripes of a text of one language, their buckets, and the end of it whose prefixes are yet to be counted."""
    coded = words_of(END + text).dictionary_encode()  # so number 0 is the end of a piece
    words, t = coded.dictionary, coded.indices.to_numpy()[1:].astype(np.int64)
    tail = words.take(pa.array(t[max(0, len(t) - level) :] if level else t[:0])).to_pylist()
    rest = b" ".join(tail) + b" " if any(w != END for w in tail) else b""
    places = max(0, len(t) - level)
    digests = hashes(words)
    is_word = t > 0

    def fits(first: int) -> np.ndarray:
        """Whether the ``level`` words from each place, or from the one after it, are a phrase, and may be frequent."""
        own, phrase = np.ones(places, bool), np.full(places, _of_lang(lang))
        for i in range(first, first + level):
            own &= is_word[i : i + places]
            phrase = _mixed(phrase, digests[t[i : i + places]])
        if known is not None:
            at = _places(phrase)
            own &= known[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) == 1
        return own

    parts, prefix, after, counts = _windows(t, len(words), level, fits(0) if level else is_word[:places], fits(1) if known is not None else np.ones(places, bool))
    if not len(prefix):
        return None, np.zeros(0, np.int64), rest
    names = [words.take(pa.array(p)) for p in parts]
    labels = pc.binary_join_element_wise(*names, pa.scalar(b" ", pa.binary())) if level > 1 else names[0] if level else pa.array([b""], pa.binary())
    part = np.zeros(len(prefix), np.uint64)
    hot = np.flatnonzero(pc.is_in(labels, pa.array(list(heavy), pa.binary())).to_numpy(zero_copy_only=False)) if level else np.array([0])
    if len(hot):
        own = np.isin(prefix, hot)
        part[own] = digests[after[own]] % np.uint64(HEAVY_PARTS)
        order = np.lexsort((part, prefix))
        prefix, after, counts, part = prefix[order], after[order], counts[order], part[order]
    first = np.flatnonzero(np.concatenate(([True], (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1]))))
    hashed = np.full(len(labels), _of_lang(lang))
    for p in parts:
        hashed = _mixed(hashed, digests[p])
    bucket = _mixed(hashed[prefix[first]], part[first]) % np.uint64(buckets)
    # Words end with a space, so the words of a stripe are a stretch of all of them.
    empty, space = pa.scalar(b"", pa.binary()), pa.scalar(b" ", pa.binary())
    spaced = pc.binary_join_element_wise(words, empty, space).take(pa.array(after))
    at = np.frombuffer(spaced.buffers()[1], np.int32)[: len(spaced) + 1]
    bounds = np.append(first, len(prefix))
    name = lang.encode()
    whole_labels = pc.binary_join_element_wise(pa.scalar(b"%d:%s" % (len(name), name), pa.binary()), labels, empty)
    stripe_columns = [
        whole_labels.take(pa.array(prefix[first])),
        pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(at[bounds]), spaced.buffers()[2]]),
        _strings(8 * bounds, counts.astype("<i8")),
    ]
    return pa.Table.from_arrays(stripe_columns, schema=STRIPE), bucket.astype(np.int64), rest


def _bundles(tables: list[pa.Table], buckets: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """The stripes of each bucket together."""
    bucket = np.concatenate(buckets)
    order = np.argsort(bucket, kind="stable")
    table, bucket = pa.concat_tables(tables).combine_chunks().take(pa.array(order)), bucket[order]
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, STRIPE, options=options) as out:
            out.write_table(table.slice(a, b - a))
        yield int(bucket[a]), sink.getvalue().to_pybytes()


def slices(text: bytes) -> Iterator[bytes]:
    """The text with separators as full stops and blanks as spaces, in slices that end where a word does."""
    text, at = text.translate(_TABLE), 0
    while at < len(text):
        end = at + FLUSH_BYTES
        ends = [i for i in (text.find(b" ", end), text.find(END, end)) if i >= 0] if end < len(text) else []
        end = min(ends, default=len(text))
        yield text[at:end]
        at = end


def stripes(docs: DataFrame, level: int, buckets: int, known=None, heavy: Iterable[tuple[str, bytes]] = ()) -> DataFrame:
    """(bucket, stripes) of (lang, text) rows, a prefix's stripe in several of them. ``known`` is a broadcast filter."""
    heavy_by_lang: dict[str, set[bytes]] = {}
    for lang, phrase in heavy:
        heavy_by_lang.setdefault(lang, set()).add(phrase)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(known.value, np.uint64) if known else None
        buffers, size = {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            """Count the prefixes that are whole; the rest begins the next buffer."""
            nonlocal buffers, size
            left, tables, places = {}, [], []
            for lang, texts in buffers.items():
                table, bucket, rest = _stripes(b"".join(texts), level, lang, buckets, bits, heavy_by_lang.get(lang, set()))
                if table is not None:
                    tables.append(table)
                    places.append(bucket)
                if rest:
                    left[lang] = [rest]
            buffers, size = left, 0
            if tables:
                numbers, blobs = zip(*_bundles(tables, places))
                yield pa.record_batch([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "stripes"])

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                for piece in slices(text.as_py()):
                    buffers.setdefault(lang, []).append(piece)
                    size += len(piece)
                    if size >= FLUSH_BYTES:
                        yield from flush()
                buffers.setdefault(lang, []).append(END)
        for texts in buffers.values():
            texts.append(END * (level + 1))
        yield from flush()

    return docs.mapInArrow(work, BUCKET_DDL)


# Stripes of all tasks


@dataclass
class Entries:
    """Counts of (label, word): the labels, and for each entry the number of its label, its word and its count."""

    labels: pa.Array
    of: np.ndarray
    words: pa.Array
    counts: np.ndarray

    @staticmethod
    def read(bundle: bytes) -> "Entries":
        table = pa.ipc.open_stream(bundle).read_all().combine_chunks()
        labels, words, counts = (c.chunk(0) for c in table.columns)
        sizes = np.diff(np.frombuffer(counts.buffers()[1], np.int32)[counts.offset : counts.offset + len(counts) + 1]) // 8
        numbers = np.frombuffer(b"".join(counts.to_pylist()), "<i8")
        return Entries(labels, np.repeat(np.arange(len(labels)), sizes), words_of(b"".join(words.to_pylist())), numbers)

    @staticmethod
    def added(parts: list["Entries"]) -> "Entries":
        """Stripes added elementwise: each label and word once, sorted by label."""
        labels = pa.chunked_array([p.labels for p in parts], pa.binary()).combine_chunks().dictionary_encode()
        words = pa.chunked_array([p.words for p in parts], pa.binary()).combine_chunks().dictionary_encode()
        first = np.cumsum([0, *[len(p.labels) for p in parts]])
        of = labels.indices.to_numpy().astype(np.int64)[np.concatenate([p.of + f for p, f in zip(parts, first)])]
        keys = of * len(words.dictionary) + words.indices.to_numpy()
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        counts = np.add.reduceat(np.concatenate([p.counts for p in parts])[order], new)
        return Entries(labels.dictionary, keys[new] // len(words.dictionary), words.dictionary.take(pa.array(keys[new] % len(words.dictionary))), counts)

    def rows(self, min_count: int) -> pa.RecordBatch:
        """Rows of ``MERGED`` of added entries."""
        named = [label.split(b":", 1) for label in self.labels.to_pylist()]
        starts = np.searchsorted(self.of, np.arange(len(named)))
        is_word = pc.not_equal(self.words, pa.scalar(END, pa.binary())).to_numpy(zero_copy_only=False)
        keep = np.flatnonzero((self.counts >= min_count) & is_word)
        offsets = pa.array(np.searchsorted(self.of[keep], np.arange(len(named) + 1)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name[: int(size)].decode() for size, name in named], pa.string()),
                pa.array([name[int(size) :] for size, name in named], pa.binary()),
                pa.array(np.add.reduceat(self.counts, starts), pa.int64()),
                pa.ListArray.from_arrays(offsets, self.words.take(pa.array(keep))),
                pa.ListArray.from_arrays(offsets, pa.array(self.counts[keep], pa.int64())),
            ],
            schema=MERGED,
        )


def merged(rows: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Rows of ``MERGED_DDL``: each prefix's total and its extensions of at least ``min_count``, in several rows if it is heavy."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, bucket = [], 0, None
        for batch in batches:
            for number, bundle in zip(batch["bucket"].to_pylist(), batch["stripes"]):
                if number != bucket and held:
                    yield Entries.added(held).rows(min_count)
                    held, size = [], 0
                bucket = number
                held.append(Entries.read(bundle.as_buffer()))
                size += len(held[-1].counts)
                if size > HELD:
                    held = [Entries.added(held)]
                    size = len(held[0].counts) // 2  # so that what has been added is seldom added again
        if held:
            yield Entries.added(held).rows(min_count)

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(work, MERGED_DDL)


def extensions(stripe_rows: DataFrame) -> DataFrame:
    """(lang, prefix, phrase, a) of the frequent extensions."""
    pairs = stripe_rows.select("lang", "prefix", F.explode(F.arrays_zip("words", "counts")).alias("e"))
    phrase = F.when(F.octet_length("prefix") > 0, F.concat("prefix", F.lit(b" "), "e.words")).otherwise(F.col("e.words"))
    return pairs.select("lang", "prefix", phrase.alias("phrase"), F.col("e.counts").alias("a"))


def phrase_counts(
    docs: DataFrame, stage: Stage, lang_col: str = "lang", text_col: str = "text", most_words: int = MOST_WORDS, min_count: int = MIN_COUNT
) -> list[DataFrame]:
    """The merged stripes of prefixes of 0 to ``most_words`` - 1 words."""
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    )
    levels, known, heavy, words = [], None, [], 0
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for level in range(most_words):
        rows = stage.write(merged(stripes(texts, level, buckets, known, heavy), min_count), f"level-{level}", [F.coalesce(F.sum("total"), F.lit(0)).alias("n")])
        levels.append(rows.rows)
        words = words or rows.figures["n"]
        if level + 1 < most_words:
            found = extensions(rows.rows)
            # At most 1 / HEAVY_SHARE phrases of one length hold so much of all words.
            hot = found.where(F.col("a") >= max(min_count, HEAVY_SHARE * words))
            heavy = [(r["lang"], bytes(r["phrase"])) for r in hot.collect()]
            known = docs.sparkSession.sparkContext.broadcast(frequent_bits(rows.rows))
    return levels


def _score(k: int) -> Column:
    """floor(SCALE * a * a / (l * r)) of the cut after ``k`` words; decimals of 38 digits are exact where 64 bits are not."""
    wide = "cast({} as decimal(15,0))".format
    return F.expr(f"({wide('a')} * {wide('a')} * cast({SCALE} as decimal(7,0))) div ({wide(f'l{k}')} * {wide(f'r{k}')})")


def candidates(levels: list[DataFrame], subsumed_percent: int = SUBSUMED_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the frequent phrases of two words or more that no longer one subsumes."""
    found = [extensions(rows).select("lang", F.col("prefix").cast("string").alias("prefix"), F.col("phrase").cast("string").alias("phrase"), "a") for rows in levels]
    out = []
    for words, phrases in enumerate(found[1:], start=2):
        own, cuts = F.split("phrase", " "), phrases
        for k in range(1, words):
            # The first part is a prefix, and its stripe sums to its total; the rest is an extension of another one.
            first = levels[k].groupBy("lang", F.col("prefix").cast("string").alias(f"first{k}")).agg(F.sum("total").alias(f"l{k}"))
            rest = found[words - k - 1].select("lang", F.col("phrase").alias(f"rest{k}"), F.col("a").alias(f"r{k}"))
            cuts = cuts.withColumns({f"first{k}": F.array_join(F.slice(own, 1, k), " "), f"rest{k}": F.array_join(F.slice(own, k + 1, words), " ")})
            cuts = cuts.join(first, ["lang", f"first{k}"]).join(rest, ["lang", f"rest{k}"])
        scores = [F.struct(_score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, words)]
        scored = cuts.select("lang", "phrase", "a", (F.least(*scores) if words > 2 else scores[0]).alias("best")).select("lang", "phrase", "a", "best.*").drop("k")
        if words < len(levels):
            # A longer phrase with this one at its start is in this one's stripe, one with it at its end in another.
            tail = F.array_join(F.slice(own, 2, words), " ")
            right = levels[words].select("lang", F.col("prefix").cast("string").alias("phrase"), F.array_max("counts").alias("longer"))
            left = found[words].select("lang", tail.alias("phrase"), F.col("a").alias("longer"))
            longest = right.unionByName(left).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
            kept = scored.join(longest, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < subsumed_percent * F.col("a"), F.lit(True)))
            scored = kept.drop("longer")
        out.append(scored)
    return reduce(DataFrame.unionByName, out)


def collocations(
    docs: DataFrame, stage: Stage, lang_col: str = "lang", text_col: str = "text", most_words: int = MOST_WORDS, min_count: int = MIN_COUNT, top: int = TOP
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language, n its words."""
    levels = phrase_counts(docs, stage, lang_col, text_col, most_words, min_count)
    words = levels[0].groupBy("lang").agg(F.sum("total").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # Every task hands on no more than its own best.
    best = candidates(levels).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
