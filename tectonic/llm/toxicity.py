"""Toxicity scores from a weighted lexicon, matched by Aho-Corasick in folded text.

Folding maps letters that look alike to one letter (accents, full-width and mathematical letters,
Cyrillic and Greek lookalikes), drops invisible characters and combining marks, and
reads digits and signs as letters inside words that also hold a letter (``1d1ot``; 1 is read as i,
so terms with an l are also looked for with i instead). Words are then
joined by single spaces, and one automaton finds the lexicon's terms (whole words and beginnings of
words) together with the exception phrases in one pass over the whole text. A term inside an
exception phrase does not count; of the terms that start at the same word the heaviest does.

The weights are log odds of a term's document frequencies in toxic and clean labelled documents,
kept if a likelihood ratio test supports them against as many terms as there are. A phrase of a term and a neighbouring word that
clean documents hold much more often than toxic ones becomes an exception. The score is a logistic
function of the summed weight and of the weight per word, fitted on the same documents: a bounded
sample, ``sample`` labelled documents at most from each class (expected), written once and read
by the three fitting passes. The driver gets the lexicon and two numbers a sampled document.

Defined results: null and empty texts have no hits and get the score of such texts; without labels
of both classes nothing is toxic (score 0); null labels are not learned from, an id labelled more
than once counts as the majority says; a null id is scored but not learned from; repeated rows are
scored alike; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tectonic.llm.common import Workspace, prepare

SAMPLE, TERMS, PHRASES = 10_000, 5_000, 1_000
SHORTEST, LONGEST = 3, 8  # lengths of the beginnings of words
CHANCE, WEIGHT = 0.05, 1.5  # expected number of terms kept by chance alone, least log odds

# Digits and signs read as letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
# Cyrillic and Greek letters that look like Latin ones.
LOOKALIKES = dict(zip("авеһіјкмнорсԛѕтухԁԝӏαβεηικνορτυχ", "abehijkmhopcqstyxdwiabenikvoptux"))
# Invisible characters (soft hyphen, zero-width and directional marks).
INVISIBLE = "­​‌‍‎‏⁠﻿"
# Blocks of accented, full-width, enclosed and mathematical letters.
BLOCKS = ((0x41, 0x5B), (0xC0, 0x250), (0x1E00, 0x1F00), (0x2100, 0x2150), (0x2460, 0x2500),
          (0xFF00, 0xFF5F), (0x1D400, 0x1D800))


def _fold_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for first, last in BLOCKS:
        for point in range(first, last):
            base = unicodedata.normalize("NFKD", chr(point)).lower()[:1]
            if base.isascii() and base.isalnum():
                table[point] = base
    for letter, base in LOOKALIKES.items():
        table[ord(letter)] = table[ord(letter.upper())] = base
    for point in [*map(ord, INVISIBLE), *range(0x300, 0x370)]:
        table[point] = None
    return table


FOLD = _fold_table()
SUBSTITUTE = str.maketrans(SUBSTITUTES)
MIXED = re.compile(r"(?<![\w@$])[\w@$]*[0-9@$][\w@$]*")  # from a token's start, so linear
WORD = re.compile(r"[^\W_]+")


def _read_digits(found: re.Match) -> str:
    token = found[0]
    return token.translate(SUBSTITUTE) if any(map(str.isalpha, token)) else token


def words(text: str | None) -> list[str]:
    """The folded words of a text."""
    return WORD.findall(MIXED.sub(_read_digits, (text or "").lower().translate(FOLD)))


def terms(word: str) -> list[str]:
    """The terms of a word, as they stand in folded text: beginnings, and the word itself."""
    return [" " + word[:n] for n in range(SHORTEST, min(LONGEST, len(word) - 1) + 1)] + [f" {word} "]


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    logit: tuple[float, float, float] | None = None  # constant, summed weight, weight per word

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    """The automaton of a lexicon; built in each task."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        read_as_i = {term.replace("l", "i"): weight for term, weight in lexicon.weights.items()}
        for term, weight in (read_as_i | lexicon.weights).items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, own: list[str]) -> dict[int, float]:
        """Weight by start of each counted hit in the words joined by spaces."""
        if not own or not len(self.automaton):
            return {}
        weight: dict[int, float] = {}
        excepted: list[tuple[int, int]] = []
        for end, (size, value) in self.automaton.iter(f" {' '.join(own)} "):
            start = end - size + 1
            if value is None:
                excepted.append((start, end))
            else:
                weight[start] = max(value, weight.get(start, 0.0))
        for start, end in excepted:
            for at in [at for at in weight if start <= at < end] if len(weight) < end - start else range(start, end):
                weight.pop(at, None)
        return weight

    def features(self, text: str | None) -> tuple[float, float]:
        """(log of the summed weight, log of the weight per hundred words), both from 0."""
        own = words(text)
        total = sum(self.hits(own).values())
        return float(np.log1p(total)), float(np.log1p(100 * total / len(own))) if own else 0.0

    def score(self, text: str | None) -> float:
        if self.lexicon.logit is None:
            return 0.0
        constant, a, b = self.lexicon.logit
        x, y = self.features(text)
        return float(1 / (1 + np.exp(-np.clip(constant + a * x + b * y, -500, 500))))


def _counted(make, name: str):
    """Documents of each class in which each string of ``make()(text)`` occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_document, counts = make(), (Counter(), Counter())
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic].update(per_document(text))
        every = list(counts[0].keys() | counts[1].keys())
        for low in range(0, len(every), 1 << 16):
            own = every[low:low + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.string()), pa.array([counts[1][t] for t in own], pa.int64()),
                 pa.array([counts[0][t] for t in own], pa.int64())], [name, "toxic", "clean"])
    return run


def _document_terms(text: str | None) -> set[str]:
    return {term for word in set(words(text)) for term in terms(word)}


def _document_phrases(matcher: Matcher):
    """The neighbours of every hit, as phrases of two words."""
    def phrases(text: str | None) -> set[str]:
        own = words(text)
        found = matcher.hits(own)
        out, at = set(), 0
        for i, word in enumerate(own):
            if at in found:
                if i:
                    out.add(f" {own[i - 1]} {word} ")
                if i + 1 < len(own):
                    out.add(f" {word} {own[i + 1]} ")
            at += len(word) + 1
        return out
    return phrases


def _feature_rows(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for batch in batches:
            found = [matcher.features(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([f[i] for f in found], pa.float64()) for i in (0, 1))], ["y", "sum", "share"])
    return run


def _logit(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge-penalised logistic regression by Newton's method, both classes weighing the same."""
    design = np.column_stack((np.ones(len(x)), x))
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        pull = design.T @ (weight * (y - p)) - 0.1 * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(3)
        step = np.linalg.solve(curve, pull)
        beta += step
        if np.abs(step).max() < 1e-10:
            break
    return tuple(beta.tolist())


def _log_odds(count: str, total: int):
    return F.log((F.col(count) + 0.5) / (F.lit(total) - F.col(count) + 0.5))


def _likelihood_ratio(toxic: int, clean: int):
    both = F.col("toxic") + F.col("clean")

    def part(count: str, total: int):
        expected = both * F.lit(total / (toxic + clean))
        return F.when(F.col(count) > 0, F.col(count) * F.log(F.col(count) / expected)).otherwise(0.0)
    return 2 * (part("toxic", toxic) + part("clean", clean))


def _told_apart(found: list[tuple[str, float, float]]) -> dict[str, float]:
    """Of terms that begin one another, the one with the best ratio (the longest of equal ones)."""
    kept: dict[str, float] = {}
    within: set[str] = set()  # every beginning of a kept term
    for term, weight, _ in sorted(found, key=lambda f: (-f[2], -len(f[0]), f[0])):
        beginnings = {term[:n] for n in range(2, len(term) + 1)}
        if term not in within and not any(b in kept for b in beginnings):
            kept[term] = weight
            within |= beginnings
    return kept


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """Lexicon learned from documents (doc_id, text) and labels (doc_id, toxic); ``exceptions`` are
    phrases in which terms do not count, besides the learned ones."""
    given = [f" {' '.join(words(phrase))} " for phrase in exceptions if words(phrase)]
    work = Workspace(docs.sparkSession)
    each = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id") \
        .agg((F.avg("toxic") >= 0.5).cast("int").alias("y"))
    sizes = {row["y"]: row["n"] for row in each.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Lexicon(exceptions=given)
    place = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(1_000_000))
    rate = F.when(F.col("y") == 1, min(1.0, sample / sizes[1])).otherwise(min(1.0, sample / sizes[0]))
    chosen = each.where(place < rate * 1_000_000).limit(4 * sample)  # twice what is expected at most
    texts = work.save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                      .join(F.broadcast(chosen), "doc_id").select("y", "text"))
    found = texts.agg(F.sum("y"), F.count("*")).first()
    toxic = int(found[0] or 0)
    clean = int(found[1]) - toxic
    if not toxic or not clean:
        return Lexicon(exceptions=given)
    weight = (_log_odds("toxic", toxic) - _log_odds("clean", clean)).alias("weight")
    ratio = _likelihood_ratio(toxic, clean)
    counted = work.save(texts.mapInArrow(_counted(lambda: _document_terms, "term"), "term string, toxic long, clean long")
                        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
                        .where("toxic + clean > 3"))
    # exp(-ratio / 2) bounds the chance of one term, so all of them together stay below CHANCE
    support = 2 * float(np.log(max(counted.count(), 1) / CHANCE))
    best = counted.where(ratio >= support).select("term", weight, ratio.alias("ratio")).where(F.col("weight") >= WEIGHT) \
        .orderBy(F.desc("ratio"), "term").limit(TERMS).collect()
    lexicon = Lexicon(_told_apart([(row["term"], row["weight"], row["ratio"]) for row in best]), given)
    found_terms = Lexicon(lexicon.weights)
    phrases = texts.mapInArrow(_counted(lambda: _document_phrases(Matcher(found_terms)), "phrase"),
                               "phrase string, toxic long, clean long") \
        .groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    harmless = phrases.where(F.col("clean") >= 3).where(
        F.col("clean") / F.lit(clean) > 4 * F.col("toxic") / F.lit(toxic))
    lexicon.exceptions += [row["phrase"] for row in harmless.orderBy(F.desc("clean"), "phrase").limit(PHRASES).collect()]
    rows = texts.mapInArrow(_feature_rows(lexicon), "y int, sum double, share double").toArrow()
    lexicon.logit = _logit(np.column_stack((rows["sum"].to_numpy(), rows["share"].to_numpy())),
                           rows["y"].to_numpy().astype(np.float64))
    work.drop(texts, counted)
    return lexicon


def _score_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = shared.value.matcher()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([matcher.score(text.as_py()) for text in batch.column(1)], pa.float64())],
                ["doc_id", "score"])
    return run


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id and score (0 to 1) of each row's whole text."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # TERMS and PHRASES entries at most
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score_rows(shared), "doc_id long, score double")
