"""A quality classifier: histogram gradient-boosted trees over statistics of a text.

``statistics`` reads each whole text once and leaves a narrow row of numbers, staged. A model is fitted to a bounded
sample of the labelled rows of it (``SAMPLE_ROWS``): values are cut into at most ``BINS`` bins at quantiles, a level of
a tree is split by the best of the histograms' cuts of all its nodes at once, and each tree fits the gradients that
the trees before it left. Trees are flattened to arrays, a row a tree, so that a batch of texts walks down all trees
by array indexing, one step a level.

Labels, language, source and id are no inputs: ``FEATURES`` is all a score depends on.

Cases: a null or empty text has zeros for statistics and a score like any other; a null id counts as an empty one for
the folds; rows without a label train nothing, a document with two labels trains as two rows; without labels of both
kinds, every score is the share of label 1, or a half without labels; an empty table gives an empty one.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from sluice.llm.common import per_text
from sluice.operators.stage import Stage

#: Labelled rows that a model is fitted to, at most.
SAMPLE_ROWS = 40_000
FOLDS = 5
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
LEAST_ROWS = 20
SHRINK = 1.0
CUT = 0.3

FEATURES = (
    "log_words", "chars_a_word", "distinct_words", "distinct_pairs", "equal_neighbours", "repeated_fives", "top_word", "lines", "equal_lines",
    "words_a_line", "capitals", "loud_words", "symbols", "marks", "commas", "stops", "digits", "other_letters", "long_words", "short_words",
    "worst_line_capitals", "worst_line_symbols", "word_entropy",
)
_SYMBOLS, _MARKS = b"#*$%&|<>~^_=+{}[]\\@", b"!?"


def _share(raw: bytes, of: bytes) -> int:
    return len(raw) - len(raw.translate(None, of))


_UPPER, _DIGITS = bytes(range(65, 91)), b"0123456789"
_HIGH = bytes(range(192, 256))


def measures(text: str) -> list[float]:
    """The statistics of one text, in the order of FEATURES."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = sum(map(len, words))
    counts = Counter(words)
    pairs = set(zip(words, words[1:]))
    fives = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    sizes = [len(w) for w in words]
    worst_capitals = worst_symbols = 0.0
    for x in lines:
        if len(x) >= 20:
            worst_capitals = max(worst_capitals, _share(x, _UPPER) / len(x))
            worst_symbols = max(worst_symbols, _share(x, _SYMBOLS) / len(x))
    entropy = -sum(c * math.log(c / n) for c in counts.values()) / n
    return [
        math.log(n),
        chars / n,
        len(counts) / n,
        len(pairs) / max(1, n - 1),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - len(set(fives)) / len(fives) if fives else 0.0,
        counts.most_common(1)[0][1] / n,
        math.log(len(lines)),
        1 - len(set(lines)) / len(lines),
        n / len(lines),
        _share(raw, _UPPER) / chars,
        sum(w.isupper() for w in words) / n,
        _share(raw, _SYMBOLS) / n,
        _share(raw, _MARKS) / n,
        raw.count(b",") / n,
        raw.count(b".") / n,
        _share(raw, _DIGITS) / chars,
        _share(raw, _HIGH) / chars,
        sum(s > 14 for s in sizes) / n,
        sum(s < 3 for s in sizes) / n,
        worst_capitals,
        worst_symbols,
        entropy / math.log(n) if n > 1 else 0.0,
    ]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, statistics array<double>) of every row."""
    work = per_text(lambda: measures, pa.list_(pa.float64()), "array<double>")
    return docs.select(F.col(id_col).alias("id"), work(F.col(text_col)).alias("statistics"))


# Trees


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth as arrays: a node n has the children 2n + 1 and 2n + 2; a value above the node's
    threshold goes right. ``feature`` and ``threshold`` hold a row of nodes a tree, ``leaf`` a row of leaves."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of label 1."""
        total = np.full(len(rows), self.base)
        if len(self.feature):
            inner = self.feature.shape[1]
            tree = np.arange(len(self.feature))[None, :]
            node = np.zeros((len(rows), len(self.feature)), np.int64)
            row = np.arange(len(rows))[:, None]
            for _ in range(int(math.log2(inner + 1))):
                right = rows[row, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            total += self.leaf[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def bin_edges(rows: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    shares = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(column, shares, method="lower")) for column in rows.T]


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boosted trees for labels 0 and 1, by the second-order gain of the logistic loss."""
    inner = (1 << depth) - 1
    none = Trees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if not len(labels):
        return none
    positive = labels.mean()
    if not 0 < positive < 1:
        return Trees(float(np.clip(np.log(max(positive, 1e-6) / max(1 - positive, 1e-6)), -14, 14)), none.feature, none.threshold, none.leaf)
    edges = bin_edges(rows)
    binned = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, rows.T)], axis=1)
    n_features, width = rows.shape[1], BINS
    cells = binned + np.arange(n_features) * width  # a histogram's cell of each value
    base = float(np.log(positive / (1 - positive)))
    total = np.full(len(rows), base)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = p - labels, p * (1 - p)
        node = np.zeros(len(rows), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            place = ((node - first)[:, None] * (n_features * width) + cells).ravel()
            size = count * n_features * width
            histogram = lambda w: np.bincount(place, np.repeat(w, n_features), size).reshape(count, n_features, width)
            g, h, n = histogram(gradient), histogram(weight), histogram(np.ones(len(rows)))
            gl, hl, nl = g.cumsum(2), h.cumsum(2), n.cumsum(2)
            gt, ht, nt = gl[:, :, -1:], hl[:, :, -1:], nl[:, :, -1:]
            gain = gl**2 / (hl + SHRINK) + (gt - gl) ** 2 / (ht - hl + SHRINK) - gt**2 / (ht + SHRINK)
            gain[(nl < LEAST_ROWS) | (nt - nl < LEAST_ROWS)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            cut = np.full(count, width)  # in bins; all go left where nothing is gained
            for k in np.flatnonzero(gain.reshape(count, -1)[np.arange(count), best] > 1e-9):
                f, cut[k] = divmod(int(best[k]), width)
                feature[first + k] = f
                threshold[first + k] = edges[f][cut[k]] if cut[k] < len(edges[f]) else np.inf
            own = node - first
            right = binned[np.arange(len(rows)), feature[node]] > cut[own]
            node = 2 * node + 1 + right
        own = node - inner
        leaf = -rate * np.bincount(own, gradient, inner + 1) / (np.bincount(own, weight, inner + 1) + SHRINK)
        total += leaf[own]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(base, np.stack(features), np.stack(thresholds), np.stack(leaves))


# Tables


def fold(id_col: str):
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def training_rows(rows: DataFrame, labels: DataFrame, id_col: str, label_col: str, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``sample_rows`` labelled rows outside of the held-out fold, by hash."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label IN (0, 1)")
    own = rows.where(fold("id") != 0).join(known, "id").select("id", "statistics", "label")
    count = own.count()
    if count > sample_rows:
        # The first of them by hash, so that the same rows are taken each time; few more than these are put in order.
        hashed = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
        share = (sample_rows + 8 * math.sqrt(sample_rows)) / count
        own = own.where(hashed < int((1 << 30) * share) + 1).orderBy(hashed, "id", "statistics", "label").limit(sample_rows)
    table = own.select("statistics", "label").toArrow()
    values = table.column("statistics").combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, float).reshape(-1, len(FEATURES)), table.column("label").to_numpy().astype(float)


def scored(rows: DataFrame, model: Trees) -> DataFrame:
    """(id, held_out, score, predicted) of staged statistics. The model is a few 10 kB and travels with the task."""

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = np.asarray(batch.flatten().to_numpy(zero_copy_only=False), float).reshape(len(batch), -1)
            parts = [model.scores(values[i : i + 2048]) for i in range(0, len(values), 2048)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    scores = arrow_udf(score, "double").asNondeterministic()
    out = rows.select("id", (fold("id") == 0).alias("held_out"), scores("statistics").alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))


def quality(docs: DataFrame, labels: DataFrame, stage: Stage, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id, held_out, score, predicted) of every row, by a model of the rows that are not held out."""
    rows = stage.write(statistics(docs, id_col, text_col), "statistics", narrow=True).rows
    model = fit(*training_rows(rows, labels, id_col, label_col))
    return scored(rows, model).withColumnRenamed("id", id_col)
