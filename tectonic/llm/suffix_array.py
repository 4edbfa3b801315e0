"""Removal of byte strings of a fixed length that occur at any other place of the corpus, the same
document included, by suffix sorting in shards.

Every window of ``length`` bytes is routed by the least hash of its ``gram``-byte substrings, so
equal windows meet whatever document they are in. Neighbouring windows with the same least hash
travel as one piece (its text is the union of the windows). Pieces whose hash occurs once cannot
repeat and are dropped before any text moves; identical pieces collapse to one with a count
(aggregated map-side), so copies of any number are one row. The texts of the remaining distinct
pieces are dealt into shards of bounded size, and each shard is sorted by external induced suffix
sorting (``induced``): a window is repeated if a neighbour in suffix order shares ``length``
symbols with it, or if its piece was counted more than once. A hash whose distinct pieces alone
are more than a shard holds (a common line in ever different surroundings) is not sorted: each of
its windows goes by two 64-bit hashes of its own bytes, counted map-side, so no task holds the
pieces of one hash.

Defined results: null counts as empty; matches never cross documents; strings are judged on the
input; repeated rows repeat all their windows; a null id is a document like any other. Extra
columns are returned unchanged, except that ``n_bytes``, ``n_removed``, ``spans`` and ``kept`` are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tectonic.llm import hashing as H
from tectonic.llm.common import Workspace
from tectonic.llm.induced import MEMORY, repeated_starts

GRAM, SHARD_BYTES, SEGMENT = 32, 4 << 20, 1 << 20
BROADCAST_KEYS = 1 << 20  # 8 bytes each
SYMBOLS = H.mix(np.arange(1, 257).astype(H.U64))


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """least (np.minimum or np.maximum) of every ``width`` consecutive values."""
    span = 1
    while 2 * span <= width:
        values = least(values[:-span], values[span:])
        span *= 2
    return least(values[:len(values) - (width - span)], values[width - span:]) if width > span else values


def pieces(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(text, start, windows, key, content hash, whether the key's substring occurs again) of the
    maximal runs of windows with the same least hash; ``offsets`` count from the start of data."""
    none = np.zeros(0, np.int64)
    sizes = np.diff(offsets)
    if not (sizes >= length).any():
        return none, none, none, none.view(H.U64), none.view(H.U64), none.astype(bool)
    sums = H.prefix_sums(data.astype(H.U64) + H.U64(1))
    _, down = H.POWERS.upto(len(sums))
    grams = H.mix((sums[gram:] - sums[:-gram]) * down[:len(sums) - gram])
    width = length - gram + 1
    key = _sliding(grams, width, np.minimum)
    long_ones = np.flatnonzero(sizes >= length)
    first, last = offsets[long_ones], offsets[long_ones + 1] - length + 1
    steps = np.zeros(len(key) + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, last, -1)
    inside = np.cumsum(steps)[:-1] > 0
    breaks = np.append(True, key[1:] != key[:-1])
    breaks[first] = True
    starts = np.flatnonzero(inside & breaks)
    stops = np.sort(np.concatenate((starts, last)))
    ends = stops[np.searchsorted(stops, starts, "right")]
    # places of the key's substring inside each piece: those that are least in some window
    padded = np.concatenate((np.zeros(width - 1, H.U64), key, np.zeros(width - 1, H.U64)))
    spots = np.flatnonzero(_sliding(padded, width, np.maximum) == grams)
    low, high = np.searchsorted(spots, starts), np.searchsorted(spots, ends - 1 + width)
    seen = np.zeros(len(starts), np.int64)
    live, at = np.arange(len(starts)), low.copy()
    while len(live):
        live = live[(at[live] < high[live]) & (seen[live] < 2)]
        seen[live] += grams[spots[at[live]]] == key[starts[live]]
        at[live] += 1
    text = np.searchsorted(offsets, starts, "right") - 1
    raw = memoryview(data)  # long pieces: a digest, the windows' polynomial is for short ones only
    content = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in
                           zip(starts.tolist(), (ends - 1 + length).tolist())), H.U64, len(starts))
    return text, starts - offsets[text], ends - starts, key[starts], content, seen > 1


def _segments(offsets: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first text, byte offsets) of buffers to work on: several texts, or a stretch of a long
    one that overlaps the next stretch by length - 1 bytes."""
    for i, j in H.slices(offsets, SEGMENT):
        if j - i == 1 and offsets[j] - offsets[i] > SEGMENT + length:
            for low in range(int(offsets[i]), int(offsets[j]) - length + 1, SEGMENT):
                yield i, np.array([low, min(low + SEGMENT + length - 1, int(offsets[j]))])
        else:
            yield i, offsets[i:j + 1]


def _piece_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = H.text_buffer(batch.column(2))
            for i, own in _segments(offsets, length):
                text, start, windows, key, content, again = pieces(data[own[0]:own[-1]], own - own[0], length, gram)
                if not len(text):
                    continue
                rows = pa.array(text + i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), batch.column(0).take(rows),
                     batch.column(1).take(rows), pa.array((start + own[:-1][text] - offsets[text + i]).astype(np.int64)),
                     pa.array(windows.astype(np.int64)), pa.array(again)],
                    ["key", "content", "doc", "print", "start", "windows", "again"])
    return run


def _piece_texts(length: int, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # repeated rows: their copies are counted, one text is enough
        for batch in batches:
            texts = batch.column(0).flatten()[text_at]
            for r in np.flatnonzero(np.asarray(batch.column(1).is_valid())).tolist():
                row = batch.column(2)[r].as_py(), batch.column(3)[r].as_py()
                if row in seen:
                    continue
                seen.add(row)
                raw = texts[r].as_py().encode()
                wanted = batch.column(1)[r].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w[name] for w in wanted], pa.int64()) for name in ("key", "content", "copies", "windows")]
                    + [pa.array([w["crowded"] for w in wanted], pa.bool_()),
                       pa.array([raw[w["start"]:w["start"] + w["windows"] + length - 1] for w in wanted], pa.binary())],
                    ["key", "content", "copies", "windows", "crowded", "text"])
    return run


def _single_windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = H.text_buffer(batch.column(3))
            for i, j in H.slices(offsets, SEGMENT // 4):
                own, piece = offsets[i:j + 1] - offsets[i], data[offsets[i]:offsets[j]]
                counts = np.diff(own) - length + 1
                row = np.repeat(np.arange(j - i), counts)
                low = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                at = own[row] + low
                first, second = (H.span_hashes(H.prefix_sums(values), at, at + length).view(np.int64)
                                 for values in (piece.astype(H.U64) + H.U64(1), SYMBOLS[piece]))
                rows = pa.array(row + i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first), pa.array(second), *(batch.column(c).take(rows) for c in range(3)), pa.array(low)],
                    ["first", "second", "key", "content", "copies", "low"])
    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, lows, highs = [], [], []
        for r, own in enumerate(batch.column(2)):
            own = np.unique(own.values.to_numpy())
            breaks = np.flatnonzero(np.diff(own) > 1)
            rows += [r] * (len(breaks) + 1)
            lows += own[np.append(0, breaks + 1)].tolist()
            highs += (own[np.append(breaks, len(own) - 1)] + 1).tolist()
        rows = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(lows, pa.int64()), pa.array(highs, pa.int64())],
            ["key", "content", "low", "high"])


def _ranges_by_window(texts: DataFrame, length: int) -> DataFrame:
    """The ranges of repeated windows of each piece, found by the hashes of single windows."""
    windows = texts.select("key", "content", "copies", "text").mapInArrow(
        _single_windows(length), "first long, second long, key long, content long, copies long, low long")
    repeated = windows.groupBy("first", "second").agg(F.sum("copies").alias("n")).where("n > 1")
    return windows.join(repeated, ["first", "second"], "left_semi") \
        .groupBy("key", "content").agg(F.collect_list("low").alias("lows")) \
        .mapInArrow(_runs, "key long, content long, low long, high long")


def _sort_shard(length: int, memory: int):
    def run(key, table):
        table = table.combine_chunks()
        texts = table["text"].to_pylist()
        windows, copies = table["windows"].to_numpy(), table["copies"].to_numpy()
        joined = np.frombuffer(b"\xff".join([*texts, b""]), np.uint8)
        # bytes of UTF-8 stay below FF: it ends each piece and sorts first
        flags = repeated_starts(joined + np.uint8(1), length, memory)
        ends = np.cumsum([len(t) + 1 for t in texts])
        starts = ends - np.array([len(t) + 1 for t in texts])
        rows, lows, highs = [], [], []
        for r, (at, n, many) in enumerate(zip(starts.tolist(), windows.tolist(), (copies > 1).tolist())):
            edges = np.array([0, n]) if many else \
                np.flatnonzero(np.diff(np.concatenate(([0], flags[at:at + n].view(np.int8), [0]))))
            rows += [r] * (len(edges) // 2)
            lows += edges[::2].tolist()
            highs += edges[1::2].tolist()
        rows = pa.array(rows, pa.int64())
        return pa.table({"key": table["key"].take(rows), "content": table["content"].take(rows),
                         "low": pa.array(lows, pa.int64()), "high": pa.array(highs, pa.int64())})
    return run


def _cut(text_at: int, names: list[str]):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, cover = batch.column(0).flatten(), batch.column(1)
            sizes, removed, spans, kept = [], [], [], []
            for r, raw in enumerate(columns[text_at].cast(pa.binary()).to_pylist()):
                raw, own, rest, last = raw or b"", [], [], 0
                if cover[r].is_valid:
                    for low, high in sorted((s["low"], s["high"]) for s in cover[r].as_py()):
                        if own and low <= own[-1]["end"]:
                            own[-1]["end"] = max(own[-1]["end"], high)
                        else:
                            own.append({"start": low, "end": high})
                for span in own:
                    rest.append(raw[last:span["start"]])
                    last = span["end"]
                rest.append(raw[last:])
                kept.append(b"".join(rest))
                sizes.append(len(raw))
                removed.append(len(raw) - len(kept[-1]))
                spans.append(own)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, spans_type), pa.array(kept, pa.binary())],
                [*names, "n_bytes", "n_removed", "spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, length: int = 200, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
                   memory: int = MEMORY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` plus n_bytes, n_removed, spans (the maximal removed byte ranges) and
    kept (the remaining bytes). ``shard_bytes`` sizes the shards to be sorted and is what the pieces
    of one hash may hold to be sorted, ``memory`` is what
    a sort's queues may hold before they go to disk."""
    if gram > length:
        raise ValueError("gram must not exceed length")
    work = Workspace(docs.sparkSession)
    added = ("n_bytes", "n_removed", "spans", "kept")
    docs = docs.select(*[c for c in docs.columns if c not in added])
    text = F.col(f"`{text_col}`")
    key = [F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64(text).alias("print")]
    found = work.save(docs.select(*key, text.alias("text")).where("text is not null").mapInArrow(
        _piece_rows(length, gram),
        "key long, content long, doc long, print long, start long, windows long, again boolean"))
    keys = found.groupBy("key").agg(
        F.count("*").alias("n"), F.max("again").alias("again"),
        (F.min("content") != F.max("content")).alias("mixed")) \
        .where("n > 1 or again").select("key", (F.col("mixed") | F.col("again")).alias("mixed"))
    shared = work.save(found.drop("again").join(keys, "key"))
    mixed = shared.where("mixed")
    distinct = work.save(mixed.groupBy("key", "content").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc", "print", "start", "windows")).alias("at")))
    sizes = distinct.groupBy("key").agg(F.sum(F.col("at.windows") + length).alias("bytes"))
    large = F.col("bytes") > shard_bytes
    total, n_crowded = sizes.agg(F.coalesce(F.sum(F.when(~large, F.col("bytes"))), F.lit(0)), F.count_if(large)).first()
    marked = distinct.withColumn("crowded", F.lit(False))
    if n_crowded:
        crowded = work.save(sizes.where(large).select("key", F.lit(True).alias("found")))
        marked = distinct.join(F.broadcast(crowded) if n_crowded <= BROADCAST_KEYS else crowded, "key", "left") \
            .withColumn("crowded", F.col("found").isNotNull())
    wanted = work.save(marked.select("at.doc", "at.print", F.struct(
        "key", "content", "copies", "at.start", "at.windows", "crowded").alias("piece"))
        .groupBy("doc", "print").agg(F.collect_list("piece").alias("pieces")))
    shards = max(1, -(-total // shard_bytes))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key)
    text_at = docs.columns.index(text_col)
    texts = keyed.join(wanted, ["doc", "print"], "left").select("row", "pieces", "doc", "print").mapInArrow(
        _piece_texts(length, text_at),
        "key long, content long, copies long, windows long, crowded boolean, text binary")
    if n_crowded:
        texts = work.save(texts)
    ranges = texts.where("not crowded").groupBy(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")).applyInArrow(
        _sort_shard(length, memory), "key long, content long, low long, high long")
    if n_crowded:
        ranges = ranges.union(_ranges_by_window(texts.where("crowded"), length))
    covered = mixed.join(ranges, ["key", "content"]).select(
        "doc", "print", (F.col("start") + F.col("low")).alias("low"),
        (F.col("start") + F.col("high") + (length - 1)).alias("high")) \
        .union(shared.where("not mixed").select(
            "doc", "print", F.col("start"), F.col("start") + F.col("windows") + (length - 1)))
    # a set: m equal rows have m times the same spans
    spans = work.save(covered.groupBy("doc", "print").agg(F.collect_set(F.struct("low", "high")).alias("cover")))
    schema = StructType([*docs.schema.fields, StructField("n_bytes", LongType()), StructField("n_removed", LongType()),
                         StructField("spans", ArrayType(StructType([StructField("start", LongType()),
                                                                    StructField("end", LongType())]))),
                         StructField("kept", BinaryType())])
    return keyed.join(spans, ["doc", "print"], "left").select("row", "cover").mapInArrow(
        _cut(text_at, docs.columns), schema)
