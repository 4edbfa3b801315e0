"""Document quality by histogram gradient-boosted trees over document statistics.

The statistics (lengths, character classes, repetition of words and lines, entropy) come from the
whole text, vectorised over many texts at once. Trees are complete and of fixed depth; all trees
together are three flat arrays (feature, threshold, leaf value), and a batch of texts walks each
level of each tree in one numpy step.

The trees are fitted on a bounded sample of labelled documents (``sample`` rows); prediction reads
every text. Defined results: null and empty texts have the statistics of an empty text and get a
score; without labelled rows every score is 0.5; several labels of one id are averaged (0.5 and
more counts as 1); repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tectonic.llm import hashing as H
from tectonic.llm.common import prepare

SAMPLE = 20_000
BINS, DEPTH, TREES, RATE = 64, 5, 80, 0.15
MARKS = b"*#$%&!|_=<>{}[]@~^"


def _per(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[i]:first[i + 1]] (0 for none)."""
    sums = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return sums[first[1:]] - sums[first[:-1]]


def _repetition(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the count of the most frequent value in each stretch."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    distinct = np.bincount(owner[at], minlength=len(first) - 1)
    most = np.zeros(len(first) - 1)
    np.maximum.at(most, owner[at], np.diff(np.append(at, len(hashes))))
    return distinct, most


def _classes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts x 256) byte counts."""
    n, out = len(offsets) - 1, None
    out = np.zeros(n * 256)
    for low in range(0, len(data), 1 << 20):
        piece = data[low:low + (1 << 20)]
        owner = np.searchsorted(offsets, np.arange(low, low + len(piece)), "right") - 1
        out += np.bincount(owner * 256 + piece, minlength=n * 256)
    return out.reshape(n, 256)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts x statistics) of whole texts."""
    size = np.diff(offsets).astype(np.float64)
    some = np.maximum(size, 1)
    counts = _classes(data, offsets)

    def share(codes) -> np.ndarray:
        return counts[:, list(codes)].sum(axis=1) / some

    starts, ends, first = H.word_spans(data, offsets)
    words = np.diff(first).astype(np.float64)
    many = np.maximum(words, 1)
    length = (ends - starts).astype(np.float64)
    hashes = H.word_hashes(data, starts, ends, lower=True)
    owner = np.repeat(np.arange(len(words)), np.diff(first))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    last, head = data[ends - 1], data[starts]
    alnum = ((H.LOWER[last] >= 97) & (H.LOWER[last] <= 122)) | ((last >= 48) & (last <= 57)) | (last > 127)
    distinct, most = _repetition(hashes, first)
    mean = _per(length, first) / many
    spread = np.sqrt(np.maximum(_per(length * length, first) / many - mean * mean, 0))
    # lines
    feed = np.zeros(len(data) + 1, bool)
    feed[offsets] = True
    feed[1:] |= data == 10 if len(data) else False
    line = np.flatnonzero(feed[:-1]) if len(data) else np.zeros(0, np.int64)
    line_end = np.append(line[1:], len(data))
    line_first = np.searchsorted(line, offsets)
    line_hash = H.word_hashes(data, line, line_end)
    lines = np.diff(line_first).astype(np.float64)
    line_distinct, line_most = _repetition(line_hash, line_first)
    p = counts / some[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    return np.stack([
        np.log1p(size), np.log1p(words), mean, spread, entropy, size / np.maximum(lines, 1),
        share(range(97, 123)), share(range(65, 91)), share(range(48, 58)), share(range(128, 256)),
        share([9, 10, 11, 12, 13, 32]), share([10]), share(MARKS), share(b".,;:?"), share(b"!"), share(b"|"),
        share(b"/-_@"), distinct / many, most / many, _per(again, first) / many,
        _per(~alnum, first) / many, _per((head >= 65) & (head <= 90), first) / many,
        line_distinct / np.maximum(lines, 1), line_most / np.maximum(lines, 1),
        np.log1p(_per(length > 30, first)),
    ], axis=1)


class Trees:
    """Boosted complete trees in flat arrays. ``feature`` and ``threshold`` hold the inner nodes
    of tree t at [t, node] in level order, ``leaf`` the values below them."""

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray, base: float):
        self.feature, self.threshold, self.leaf, self.base = feature, threshold, leaf, base

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(feature)] if node.size else 0
        return 1 / (1 + np.exp(-total))


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
          bins: int = BINS, smooth: float = 5.0) -> Trees:
    """Fit logistic loss; each level's histograms are one weighted bincount per feature."""
    n, width = x.shape if len(x) else (0, 0)
    inner = (1 << depth) - 1
    if not n:
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), 0.0)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    codes = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], axis=1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    margin = np.full(n, base)
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        pull, weight = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            best = np.full(count, 1e-6)
            for f in range(width):
                place = (node - first) * bins + codes[:, f]
                g = np.bincount(place, pull, count * bins).reshape(count, bins).cumsum(axis=1)
                h = np.bincount(place, weight, count * bins).reshape(count, bins).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + smooth) + (all_g - g)**2 / (all_h - h + smooth) - all_g**2 / (all_h + smooth)
                gain[(h < 1) | (all_h - h < 1)] = 0
                gain[:, len(edges[f]):] = 0
                cut = gain.argmax(axis=1)
                value = gain[np.arange(count), cut]
                for k in np.flatnonzero(value > best).tolist():
                    best[k], feature[t, first + k], threshold[t, first + k] = value[k], f, edges[f][cut[k]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        below = node - inner
        leaf[t] = rate * np.bincount(below, pull, inner + 1) / (np.bincount(below, weight, inner + 1) + smooth)
        margin += leaf[t][below]
    return Trees(feature, threshold, leaf, base)


def _statistic_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = H.text_buffer(batch.column(1))
        for i, j in H.slices(offsets):
            x = statistics(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array([row.tobytes() for row in x], pa.binary())], ["y", "x"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fit on documents (doc_id, text) and labels (doc_id, quality)."""
    prepare(docs.sparkSession)
    each = labels.where("doc_id is not null and quality is not null").groupBy("doc_id") \
        .agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    count = each.count()
    rate = min(1.0, sample / max(count, 1)) * 1_000_000
    chosen = each.where(F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1_000_000)) < rate).limit(2 * sample)
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .join(F.broadcast(chosen), "doc_id").select("y", "text") \
        .mapInArrow(_statistic_rows, "y int, x binary").limit(4 * sample).toArrow()
    x = np.frombuffer(b"".join(table["x"].to_pylist()), np.float64)
    y = np.array(table["y"].to_pylist(), np.float64)
    return boost(x.reshape(len(y), -1) if len(y) else np.zeros((0, 0)), y)


def _score_rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = H.text_buffer(batch.column(1))
            scores = [model.value.score(statistics(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
                      for i, j in H.slices(offsets)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                ["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Trees) -> DataFrame:
    """doc_id and score (0 to 1) of each row's whole text."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few flat arrays of fixed size
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score_rows(shared), "doc_id long, score double")


def _accepted_rows(model, text_at: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = H.text_buffer(batch.column(text_at))
            scores = [model.value.score(statistics(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
                      for i, j in H.slices(offsets)]
            keep = np.concatenate(scores) >= threshold if scores else np.zeros(0, bool)
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def accepted(docs: DataFrame, model: Trees, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_accepted_rows(shared, docs.columns.index("text"), threshold), docs.schema)
