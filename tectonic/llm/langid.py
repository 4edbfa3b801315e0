"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over hashed byte n-grams
(logistic regression on square-rooted relative frequencies) predicts the language's bit. Decoding
is loss-weighted: a language's loss is the mean of log(1 + exp(-bit * margin)) over the code,
weighted by how well each classifier does on that language; the least loss wins. A text whose two
best languages are nearly as likely is flagged ambiguous.

Up to five languages get the exhaustive code (2**(n-1) - 1 bits), more a random code with the
largest least distance of several seeded draws. The classifiers are fitted on a sample of every
language: ``sample_rows`` labelled rows dealt evenly, at most ``per_language`` each (expected) and
at least one. A row is 8 KB of features, so the driver gets 256 MB at most, or one row a language
where there are more languages than ``sample_rows``. Prediction reads whole texts, slice by slice.

Defined results: a null text or one without any letter is ``und`` with score 0; without labelled
rows everything is ``und``; rows with a null label are not learned from; a null id is not held
out; repeated rows are predicted alike and learned from once; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tectonic.llm import hashing as H
from tectonic.llm.common import prepare

DIMENSIONS, SHORT = 2048, 512  # of all n-grams; the first SHORT are for one and two bytes
PER_LANGUAGE, SAMPLE_ROWS = 800, 1 << 15
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts x DIMENSIONS) square roots of relative n-gram frequencies, lower case for A-Z."""
    n = len(offsets) - 1
    counts = np.zeros(n * DIMENSIONS)
    for low in range(0, len(data), 1 << 20):
        # two bytes of overlap, so every n-gram starts in one piece
        piece = H.LOWER[data[low:low + (1 << 20) + 2]].astype(np.uint32)
        own = min(1 << 20, len(data) - low)
        at = np.arange(low, low + len(piece))
        owner = np.searchsorted(offsets, at, "right") - 1
        base = owner * DIMENSIONS
        one = piece[:own] * np.uint32(2654435761) >> np.uint32(23)
        counts += np.bincount(base[:own] + one, minlength=len(counts))
        for size, first, room in ((2, 0, SHORT), (3, SHORT, DIMENSIONS - SHORT)):
            m = min(own, len(piece) - size + 1)
            if m <= 0:
                continue
            gram = piece[:m].copy()
            for j in range(1, size):
                gram = gram * np.uint32(257) + piece[j:m + j]
            gram = (gram * np.uint32(2654435761)) >> np.uint32(8)
            same = owner[:m] == owner[size - 1:m + size - 1]
            counts += np.bincount((base[:m] + first + gram % np.uint32(room))[same], minlength=len(counts))
    counts = counts.reshape(n, DIMENSIONS)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """(languages x bits) of -1 and 1."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= 5:
        columns = np.arange(1, 1 << (n - 1))  # the first language's bits are all 1
        bits = (columns[None, :] >> np.arange(n - 1)[:, None]) & 1
        return np.vstack((np.ones(len(columns), np.int8), 1 - 2 * bits)).astype(np.int8)
    best, score = None, -1
    for seed in range(50):
        code = np.random.default_rng(seed).choice([-1, 1], (n, math.ceil(10 * math.log2(n)))).astype(np.int8)
        code = code[:, np.abs(code.sum(axis=0)) < n]
        wide = code.astype(np.float32)
        distance = ((code.shape[1] - wide @ wide.T) // 2 + code.shape[1] * np.eye(n, dtype=np.float32)).min()
        if distance > score:
            best, score = code, distance
    return best


class Model:
    """Languages, their codewords, the classifiers' weights and the decoding weights."""

    def __init__(self, languages: list[str], x: np.ndarray, y: np.ndarray, steps: int = 200):
        self.languages, self.code = languages, codewords(len(languages))
        bits = self.code.shape[1] if languages else 0
        self.weights, self.bias = np.zeros((DIMENSIONS, bits), np.float32), np.zeros(bits, np.float32)
        if not languages:
            return
        targets = self.code[y].astype(np.float32)
        share = np.bincount(y, minlength=len(languages))[y].astype(np.float32)
        each = (1 / (share * len(languages)))[:, None]  # languages weigh alike
        speed_w, speed_b = np.zeros_like(self.weights), np.zeros_like(self.bias)
        for _ in range(steps):
            pull = -targets * each / (1 + np.exp(np.clip(targets * (x @ self.weights + self.bias), -30, 30)))
            speed_w = 0.9 * speed_w - 60 * (x.T @ pull + 1e-6 * self.weights)
            speed_b = 0.9 * speed_b - 2 * pull.sum(axis=0)
            self.weights += speed_w
            self.bias += speed_b
        right = (np.sign(x @ self.weights + self.bias) == targets).astype(np.float64)
        sums = np.stack([right[y == c].mean(axis=0) if (y == c).any() else np.ones(bits)
                         for c in range(len(languages))])
        self.trust = sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-9)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language of each row, its probability, and that of the second best."""
        margins = x @ self.weights + self.bias
        loss = np.stack([(np.logaddexp(0, -margins * self.code[c]) * self.trust[c]).sum(axis=1)
                         for c in range(len(self.languages))], axis=1) * self.code.shape[1]
        odds = np.exp(loss.min(axis=1, keepdims=True) - loss)
        odds /= odds.sum(axis=1, keepdims=True)
        ranked = np.sort(odds, axis=1)
        second = ranked[:, -2] if odds.shape[1] > 1 else np.zeros(len(x))
        return odds.argmax(axis=1), ranked[:, -1], second


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = H.text_buffer(batch.column(1))
        for i, j in H.slices(offsets):
            x = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array([row.tobytes() for row in x], pa.binary()),
                 batch.column(2).slice(i, j - i)], ["lang", "x", "place"])


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on rows (doc_id, text, lang), a bounded sample of each language."""
    prepare(labelled.sparkSession)
    labelled = labelled.where("text is not null and lang is not null") \
        .withColumn("place", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 53)))
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("count"), F.min("place").alias("least")).collect()
    each = max(1, min(per_language, sample_rows // max(1, len(sizes))))
    rates = labelled.sparkSession.createDataFrame(
        [(lang, least, (each << 53) / count) for lang, count, least in sizes], "lang string, least long, rate double")
    sample = labelled.join(F.broadcast(rates), "lang") \
        .where((F.col("place") < F.col("rate")) | (F.col("place") == F.col("least"))) \
        .select("lang", "text", "place")
    table = sample.mapInArrow(_feature_rows, "lang string, x binary, place long") \
        .dropDuplicates(["lang", "place"]).select("lang", "x").toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    place = {lang: i for i, lang in enumerate(languages)}
    x = np.frombuffer(b"".join(table["x"].to_pylist()), np.float32).reshape(-1, DIMENSIONS)
    return Model(languages, x, np.array([place[v] for v in table["lang"].to_pylist()], np.int64))


def _predict_rows(model, ambiguous_below: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            offsets, data = H.text_buffer(batch.column(1))
            langs, scores, unclear = [], [], []
            texts = batch.column(1)
            for i, j in H.slices(offsets):
                letters = [own.languages and t is not None and LETTER.search(t) is not None
                           for t in texts.slice(i, j - i).to_pylist()]
                if any(letters):
                    best, first, second = own.decode(features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
                for r, has in enumerate(letters):
                    langs.append(own.languages[best[r]] if has else UNDETERMINED)
                    scores.append(float(first[r]) if has else 0.0)
                    unclear.append(bool(first[r] - second[r] < ambiguous_below) if has else True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(unclear, pa.bool_())], ["doc_id", "lang_pred", "score", "ambiguous"])
    return run


def predict(docs: DataFrame, model: Model, ambiguous_below: float = 0.2) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of each row's whole text."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one codeword a language
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _predict_rows(shared, ambiguous_below), "doc_id long, lang_pred string, score double, ambiguous boolean")


def _accepted_rows(model, text_at: int, ambiguous_below: float, sure: float):
    judge = _predict_rows(model, ambiguous_below)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(text_at)
            judged = next(judge(iter([pa.RecordBatch.from_arrays([text, text], ["doc_id", "text"])])))
            _, lang, score, unclear = judged.columns
            good = np.asarray(lang.to_pylist(), object) != UNDETERMINED
            doubtful = unclear.to_numpy(zero_copy_only=False) & (score.to_numpy() < sure)
            yield batch.filter(pa.array(good & ~doubtful, pa.bool_()))
    return run


def accepted(docs: DataFrame, model: Model, ambiguous_below: float = 0.2, sure: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text has a language: not undetermined, and not both ambiguous
    and below ``sure``. Without any learned language every row is undetermined."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_accepted_rows(shared, docs.columns.index("text"), ambiguous_below, sure), docs.schema)
