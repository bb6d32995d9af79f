"""Best-fit packing of token sequences, certified by lower bounds.

1. ``pieces``: each text's ids, cut into pieces of at most ``LIMIT`` tokens.
2. Full pieces are sequences of their own. The others are dealt evenly to partitions, and each packs its own by best
   fit decreasing, longest first into the fullest sequence that has room.
3. Dual feasible functions give each partition a number of sequences below which no packing exists. A partition that
   meets its bound is certified and done, but for its emptiest sequence, which rounding up may have cost it.
4. Partitions with a gap keep their full sequences and hand in the documents of those with free space. These are
   dealt anew, twice as many to a partition, and packed again, until all are certified or one partition is left.

Only (id, piece, length) meet in packing; texts are read once. The exchange rounds move what lies in sequences with
free space. Ids are encoded word by word: a space between two non-blank characters always starts a token of the
byte-level vocabulary, so that a chunk's ids do not depend on its neighbours and can be remembered.

Cases: a null text is an empty one, with its end id alone; repeated rows are packed as rows of their own; ids may be
null; an empty table gives an empty one; other columns are ignored.
"""

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sluice.functions.bpe import SPLIT_PATTERN
from sluice.operators.stage import Stage

LIMIT = 1024
END_ID = 2
#: Chunks in a generation of those whose ids a worker remembers, each about 200 bytes.
REMEMBERED = 400_000
#: Pieces dealt to one partition; a partition's packing works on lengths and needs a few bytes for each.
PARTITION_ROWS = 100_000

_OTHER_BLANK = re.compile(r"[^\S \n]")
_SPACE_BESIDE_BLANK = re.compile(r"\s | \s|^ | $")


# Ids


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, by a tokenizer's JSON.

    Chunks are remembered in two generations: when the younger one is full it becomes the older, and what is asked
    for again moves up. New chunks are encoded by a second encoder of the same vocabulary and merges, which takes a
    quarter of the time for single words; a vocabulary that it cannot follow, and texts whose blanks or special
    tokens bind chunks together, go to the tokenizer itself.
    """

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        ranks = merge_ranks(json.loads(vocabulary))
        self.words = None
        if ranks:
            from tiktoken import Encoding

            self.words = Encoding("words", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: A text that holds one of these is encoded whole.
        self.special = [t["content"] for t in json.loads(vocabulary).get("added_tokens", [])]

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.words is None or any(s in text for s in self.special) or space_beside_blank(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        chunks = text.replace(" ", "\0 ").split("\0") if "\0" not in text else _chunks(text)
        found = list(map(self.known.get, chunks))
        if None in found:
            new = self._learn({c for c, f in zip(chunks, found) if f is None})
            found = [new[c] if f is None else f for c, f in zip(chunks, found)]
        return b"".join(found)

    def _learn(self, missing: set[str]) -> dict[str, bytes]:
        older, encode, new = self.older.get, self.words.encode_ordinary, {}
        for chunk in missing:
            ids = older(chunk)
            new[chunk] = array("I", encode(chunk)).tobytes() if ids is None else ids
        self.known.update(new)
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        return new


def merge_ranks(model: dict) -> dict[bytes, int] | None:
    """A byte-level vocabulary as ranks, if ids ascend in the order of the merges; otherwise None."""
    vocabulary, merges = model["model"].get("vocab", {}), model["model"].get("merges", [])
    steps = [model.get("pre_tokenizer") or {}, model.get("normalizer"), model.get("post_processor")]
    plain = steps[0].get("type") == "ByteLevel" and steps[0].get("use_regex") and not steps[0].get("add_prefix_space")
    if not plain or steps[1] or steps[2] or model["model"].get("type") != "BPE":
        return None
    # The bytes that print stand for themselves, the others for the characters from 256 on.
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    of = {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in model.get("added_tokens", [])}
    if any(c not in of for token in vocabulary if token not in special for c in token):
        return None
    made = [vocabulary.get("".join(m.split(" ")) if isinstance(m, str) else "".join(m)) for m in merges]
    if made != list(range(256, 256 + len(merges))):
        return None
    return {bytes(of[c] for c in token): i for token, i in vocabulary.items() if token not in special}


def _chunks(text: str) -> list[str]:
    first, *rest = text.split(" ")
    return [first, *[" " + chunk for chunk in rest]]


def space_beside_blank(text: str) -> bool:
    """Whether a space has no other character than a blank, or none, on one of its sides."""
    if _OTHER_BLANK.search(text):
        return _SPACE_BESIDE_BLANK.search(text) is not None
    return text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text


_encoders: dict[int, Encoder] = {}


def encoder_of(vocabulary: str) -> Encoder:
    """The worker's own encoder, kept with what it remembers from task to task."""
    key = zlib.crc32(vocabulary.encode())
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def cut_lengths(length: int, limit: int) -> list[int]:
    """Piece lengths of a document: whole ones, and before them the rest."""
    whole, rest = divmod(length, limit)
    return [rest] * (rest > 0) + [limit] * whole


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32), with ``keep_ids`` also ``ids``. ``vocabulary`` is a tokenizer's JSON, a
    few MB whatever the data, and travels to the workers as a broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            texts, rows, out, ids = batch.column("text"), [], [], []
            for row in range(batch.num_rows):
                raw = encoder.encode(texts[row].as_py() or "") + end
                start = 0
                for piece, length in enumerate(cut_lengths(len(raw) // 4, limit)):
                    own = raw[4 * start : 4 * (start + length)]
                    rows.append(row)
                    out.append((piece, start, length, zlib.crc32(own)))
                    if keep_ids:
                        ids.append(np.frombuffer(own, "<i4"))
                    start += length
            columns = list(zip(*out)) if out else [[], [], [], []]
            columns = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            columns += [pa.array(ids, pa.list_(pa.int32()))] * keep_ids
            names = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows, pa.int64())), *columns], names=names)

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


# One partition


def lower_bound(lengths: np.ndarray, limit: int = LIMIT) -> int:
    """Sequences that any packing needs: the best of the dual feasible functions that round lengths to k parts, or
    that count long ones whole and short ones not at all. Exact whole numbers."""
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=limit + 1).astype(np.int64)
    size = np.arange(limit + 1, dtype=np.int64)
    best = -(-int((counts * size).sum()) // limit)
    for k in range(1, 101):
        scaled = size * (k + 1)
        rounded = np.where(scaled % limit == 0, size * k, (scaled // limit) * limit)  # in units of limit * k
        best = max(best, -(-int((counts * rounded).sum()) // (limit * k)))
    below = np.cumsum(counts * size)
    above = np.cumsum(counts[::-1])[::-1]
    for short in range(1, limit // 2 + 1):  # longer than limit - short: whole; shorter than short: nothing
        whole = int(above[limit - short + 1])
        middle = int(below[limit - short] - below[short - 1])
        best = max(best, whole + -(-middle // limit))
    return best


def best_fit(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, and each sequence's free space, by best fit decreasing.

    Sequences with equal room are alike, so they are kept in piles by their room, and a bit set of the rooms in use
    finds the smallest that suffices.
    """
    order = np.argsort(-lengths, kind="stable")
    piles: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms, used = 0, []
    place, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for row, length in zip(order.tolist(), lengths[order].tolist()):
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            pile = piles[room]
            sequence = pile.pop()
            if not pile:
                rooms &= ~(1 << room)
        else:
            room, sequence = limit, len(used)
            used.append(0)
        place[row], offset[row] = sequence, used[sequence]
        used[sequence] += length
        room -= length
        if room:
            piles[room].append(sequence)
            rooms |= 1 << room
    return place, offset, limit - np.array(used, np.int64)


def _packer(limit: int, turn: int):
    """Packs each partition's rows. Rows of sequences that are not to move again are ``done``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        lengths = rows.column("length").to_numpy()
        place, offset, room = best_fit(lengths, limit)
        gap = len(room) - lower_bound(lengths, limit)
        emptiest = place == room.argmax()  # rounding up costs each partition up to one sequence
        done = (room[place] == 0) | ((gap == 0) & ~emptiest)
        sequence = (turn << 56) + (TaskContext.get().partitionId() << 32) + place
        extra = [pa.array(c) for c in (sequence, offset, done, np.full(len(place), gap))]
        for name, column in zip(("sequence_id", "offset", "done", "gap"), extra):
            rows = rows.append_column(name, column)
        yield from rows.to_batches(max_chunksize=50_000)

    return pack


# All partitions


def packed(parts: DataFrame, stage: Stage, limit: int = LIMIT, partition_rows: int = PARTITION_ROWS, name: str = "pack") -> DataFrame:
    """``parts`` (columns row_id, length and others) with sequence_id and offset; staged (row_id, length) meet only."""
    whole = parts.where(F.col("length") == limit).select("row_id", F.col("row_id").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = parts.where(F.col("length") < limit).select("row_id", "length")
    count = left.count()
    schema = "row_id long, length long, sequence_id long, offset long, done boolean, gap long"
    places, turn = [], 1
    while count:
        # Hashes deal evenly. Each round brings twice as many together, which had not met before.
        wanted = max(1, -(-count // (partition_rows << turn - 1)))
        dealt = left.repartition(wanted, F.xxhash64("row_id", F.lit(turn)))
        still_open = F.sum(F.when(F.col("done"), 0).otherwise(1)).alias("open")
        out = stage.write(dealt.select("row_id", "length").mapInArrow(_packer(limit, turn), schema), f"{name}-{turn}", [still_open])
        open_rows = out.figures["open"] or 0
        last = wanted == 1 or open_rows == 0
        rows = out.rows if last else out.rows.where("done")
        places.append(rows.select("row_id", "sequence_id", "offset"))
        if last:
            break
        left, count = out.rows.where("NOT done").select("row_id", "length"), open_rows
        turn += 1
    for p in places:
        whole = whole.unionByName(p)
    return parts.join(whole, "row_id")


def pack_documents(
    docs: DataFrame, vocabulary: str, stage: Stage, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = END_ID,
    partition_rows: int = PARTITION_ROWS,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    cut = pieces(docs, vocabulary, id_col, text_col, limit, end_id)
    parts = stage.write(cut.withColumn("row_id", F.monotonically_increasing_id()), "pieces").rows
    return packed(parts, stage, limit, partition_rows).select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def sequences(docs: DataFrame, places: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, for unique ids."""
    own = pieces(docs, vocabulary, id_col, text_col, limit, end_id, keep_ids=True).select(F.col("id").alias(id_col), "piece", "ids")
    parts = places.join(own, [id_col, "piece"]).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"))


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()
