"""Removal of word windows that already occur in a document with a smaller id, by
difference-cover anchors.

Runs of ``anchor`` words are hashed only where the word position modulo the period lies in a
difference cover. For any two positions some shift below the period brings both onto the cover,
so two equal windows of ``window = anchor + period - 1`` words always share an aligned anchor.
With the period 31 (cover of 6) about one position in five is hashed.

Anchors that occur in several documents are extended to windows:

* if all hashed occurrences of an anchor also agree on everything a window around it could reach,
  all its windows are repeats in every document but the smallest;
* the remaining windows around shared anchors (near the ends of matches) are hashed themselves
  (two 64-bit hashes over independent word hashes) and decided by their own smallest document. The smallest document that holds such a
  window shares an aligned anchor with each of the others, so its window is always among them.
  Windows that always follow one another are decided as one chain: only its ends are joined back.

Anchor and window hashes are aggregated (map-side combined) before they are joined back, so a
passage that a third of all documents share is one row; the join back can be split by AQE.
Texts move once, keyed by document; the marks of repeated rows are one set, so m equal rows cost m
times one row, not its square.

Defined results: windows are judged on the input; a null or short text has no window; rows that
share an id are not sources for one another; rows with a null id neither remove nor lose
anything; repeated rows are treated alike. Extra columns are returned unchanged, except that
``n_words`` and ``n_removed`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tectonic.llm import hashing as H
from tectonic.llm.common import Workspace

UNDECIDED, REPEATED = 0, 1
OTHER = H.Powers(0xD6E8FEB86659FD93)


def difference_cover(period: int) -> list[int]:
    """A smallest set of residues whose differences reach every residue."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return list(cover)
    return [0]


def _words(data: np.ndarray, offsets: np.ndarray):
    starts, ends, first = H.word_spans(data, offsets)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(starts)) - first[:-1][owner]
    return starts, ends, first, counts, owner, place, H.word_hashes(data, starts, ends)


def _anchor_rows(window: int, period: int, cover: list[int]):
    anchor, reach = window - period + 1, period - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.zeros(period, bool)
        marked[cover] = True
        for batch in batches:
            offsets, data = H.text_buffer(batch.column(2))
            for i, j in H.slices(offsets):
                own = offsets[i:j + 1] - offsets[i]
                _, _, _, counts, owner, place, words = _words(data[offsets[i]:offsets[j]], own)
                if not len(words):
                    continue
                sums, left = H.prefix_sums(words), counts[owner] - place
                at = np.flatnonzero((left >= anchor) & marked[place % period] & (counts[owner] >= window))
                low = np.maximum(at - reach, at - place[at])
                high = np.minimum(at + anchor + reach, at + left[at])
                clip = ((at - low) * (2 * window) + (high - at)).astype(H.U64)
                rows = pa.array(owner[at] + i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(H.span_hashes(sums, at, at + anchor).view(np.int64)),
                     pa.array(H.mix(H.span_hashes(sums, low, high) ^ clip).view(np.int64)),
                     batch.column(0).take(rows), batch.column(1).take(rows),
                     pa.array(place[at].astype(np.int64))],
                    ["hash", "around", "doc_id", "print", "place"])
    return run


def _window_spans(marks: np.ndarray, state: int, n: int, window: int, reach: int) -> np.ndarray:
    """Flags of the window starts around the marked anchors of one state."""
    places = marks[marks % 2 == state] // 2
    steps = np.zeros(n + 2, np.int64)
    low, high = np.maximum(places - reach, 0), np.minimum(places, n - window) + 1
    good = high > low
    np.add.at(steps, low[good], 1)
    np.add.at(steps, high[good], -1)
    return np.cumsum(steps)[:n] > 0


def _open_windows(window: int, period: int, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).flatten()[text_at]
            marked = np.flatnonzero(np.asarray(batch.column(3).is_valid()))
            for r in marked.tolist():
                marks = batch.column(3)[r].values.to_numpy()
                if not (marks % 2 == UNDECIDED).any():
                    continue
                offsets, data = H.text_buffer(texts.slice(r, 1))
                starts, ends, *_, words = _words(data, offsets)
                n = len(words)
                spans = [_window_spans(marks, s, n, window, period - 1) for s in (UNDECIDED, REPEATED)]
                at = np.flatnonzero(spans[0] & ~spans[1])
                if not len(at):
                    continue
                one = H.span_hashes(H.prefix_sums(words), at, at + window)
                up, down = OTHER.upto(n + 1)
                other = H.word_hashes(data, starts, ends, seed=2)
                sums = np.concatenate((np.zeros(1, H.U64), np.cumsum(other * up[:n])))
                two = H.mix((sums[at + window] - sums[at]) * down[at])
                after = np.zeros(len(at), H.U64)  # the next window, if it is open too
                after[:-1] = np.where(np.diff(at) == 1, one[1:], H.U64(0))
                # a row for each distinct window: lines that a text repeats make few of them
                order = np.lexsort((two, one))
                one, two, after, at = (values[order].view(np.int64) for values in (one, two, after, at))
                first = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
                bounds = np.append(first, len(at)) * 8
                places = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(first), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(at.tobytes())])
                rows = pa.array(np.full(len(first), r))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one[first]), pa.array(two[first]), pa.array(np.minimum.reduceat(after, first)),
                     pa.array(np.maximum.reduceat(after, first)), pa.array(np.diff(bounds) // 8),
                     batch.column(0).take(rows), batch.column(1).take(rows), places.cast(pa.binary())],
                    ["one", "two", "after", "after_too", "n", "doc_id", "print", "places"])
    return run


def _cut(window: int, period: int, text_at: int, names: list[str], one_space: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, marks, repeated = batch.column(0).flatten(), batch.column(1), batch.column(2)
            texts = columns[text_at].cast(pa.binary()).to_pylist()
            sizes, removed, out = [], [], []
            for r, raw in enumerate(texts):
                if marks[r].is_valid or repeated[r].is_valid:
                    data = np.frombuffer(raw, np.uint8)
                    starts, ends, _ = H.word_spans(data, np.array([0, len(data)]))
                    n = len(starts)
                    begin = np.zeros(n, bool)
                    if marks[r].is_valid:
                        begin |= _window_spans(marks[r].values.to_numpy(), REPEATED, n, window, period - 1)
                    if repeated[r].is_valid:
                        steps = np.zeros(n + 1, np.int64)
                        for chain in repeated[r].as_py():  # places of a chain's first and last window
                            places = np.frombuffer(chain["places"], np.int64)
                            if chain["ends"] >= 2:
                                np.add.at(steps, places, 1)
                            if chain["ends"] % 2:
                                np.add.at(steps, places + 1, -1)
                        begin |= np.cumsum(steps)[:n] > 0
                    at = np.flatnonzero(begin)
                    steps = np.zeros(n + 1, np.int64)
                    np.add.at(steps, at, 1)
                    np.add.at(steps, np.minimum(at + window, n), -1)
                    keep = np.cumsum(steps)[:n] == 0
                    sizes.append(n)
                    removed.append(int(n - keep.sum()))
                    if one_space:
                        raw = b" ".join(raw[a:b] for a, b in zip(starts[keep].tolist(), ends[keep].tolist()))
                    elif removed[-1]:
                        edge = np.flatnonzero(np.diff(np.concatenate(([False], ~keep, [False])).astype(np.int8)))
                        pieces, last = [], 0
                        for a, b in edge.reshape(-1, 2).tolist():
                            pieces.append(raw[last:starts[a]])
                            last = len(raw) if b == n else starts[b]
                        raw = b"".join([*pieces, raw[last:]])
                else:
                    words = (raw or b"").split()
                    sizes.append(len(words))
                    removed.append(0)
                    if one_space:
                        raw = b" ".join(words)
                out.append(raw)
            columns[text_at] = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64())],
                [*names, "n_words", "n_removed"])
    return run


def _chain_ends(found: DataFrame, work: Workspace) -> DataFrame:
    """(one, two, low, ends) of the first and last window of every chain: ends is 2 for the first, 1
    for the last, 3 for a chain of one. Two windows are tied if every place of the one is followed
    by the other and the other has no more places; they then lie in the same documents, side by
    side, and are decided together, so a document gets a row or two for a chain instead of one for
    each of its windows."""
    windows = work.save(found.groupBy("one", "two").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum("n").alias("places"),
        F.min("after").alias("after"), F.max("after_too").alias("after_too"))
        .where("low < high").select("one", "two", "low", "places", F.expr(
            "case when after = after_too and after <> 0 then after end").alias("after")))
    tied = work.save(windows.where("after is not null").select(
        F.col("one").alias("first_one"), F.col("two").alias("first_two"), F.col("after").alias("one"), "places")
        .join(windows.select("one", "two", "places"), ["one", "places"]).select("first_one", "first_two", "one", "two"))
    starts = windows.join(tied.select("one", "two"), ["one", "two"], "left_anti").select(
        "one", "two", "low", F.lit(2).alias("end"))
    stops = windows.join(tied.select(F.col("first_one").alias("one"), F.col("first_two").alias("two")), ["one", "two"],
                         "left_anti").select("one", "two", "low", F.lit(1).alias("end"))
    return work.save(starts.unionByName(stops).groupBy("one", "two").agg(
        F.min("low").alias("low"), F.sum("end").alias("ends")))


def remove_repeated_windows(docs: DataFrame, window: int = 50, period: int = 31,
                            one_space: bool = False, id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the repeated words cut out of the text, plus n_words and
    n_removed. ``one_space`` joins the kept words by one space; otherwise the spacing between
    kept words stays as it was and a text that loses nothing is returned unchanged."""
    if period > window:
        raise ValueError("the period must not exceed the window")
    work = Workspace(docs.sparkSession)
    docs = docs.select(*[c for c in docs.columns if c not in ("n_words", "n_removed")])
    key = [F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("print")]
    texts = docs.select(*key, F.col(f"`{text_col}`").alias("text"))
    anchors = texts.where("doc_id is not null and text is not null").mapInArrow(
        _anchor_rows(window, period, difference_cover(period)),
        "hash long, around long, doc_id long, print long, place long")
    shared = anchors.groupBy("hash").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        (F.min("around") == F.max("around")).alias("alike")).where("low < high").drop("high")
    state = F.when(F.col("alike"), REPEATED).otherwise(UNDECIDED)
    marks = work.save(
        anchors.select("hash", "doc_id", "print", "place").join(shared, "hash")
        .where("not alike or low < doc_id")
        .groupBy("doc_id", "print").agg(F.collect_set(F.col("place") * 2 + state).alias("marks")))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key)
    # One exchange of the rows by key serves both joins below.
    marked = keyed.join(marks, ["doc_id", "print"], "left")
    text_at = docs.columns.index(text_col)
    found = marked.select("doc_id", "print", "row", "marks").mapInArrow(
        _open_windows(window, period, text_at), "one long, two long, after long, after_too long, n long, "
        "doc_id long, print long, places binary")
    ends = _chain_ends(found, work)
    repeated = found.select("one", "two", "doc_id", "print", "places").join(ends, ["one", "two"]).where("doc_id > low") \
        .groupBy("doc_id", "print").agg(F.collect_set(F.struct("ends", "places")).alias("repeated"))
    schema = StructType([*docs.schema.fields, StructField("n_words", LongType()), StructField("n_removed", LongType())])
    return marked.join(repeated, ["doc_id", "print"], "left").select("row", "marks", "repeated").mapInArrow(
        _cut(window, period, text_at, docs.columns, one_space), schema)
