"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch (one per document, ``t`` coordinates): in round i every shingle is hashed to a bin and a
value; a bin keeps the least value of the earliest round that reached it. The first t rounds
place shingles in random bins, round t + b places every shingle in bin b, so all bins are filled
after 2t rounds at most, and a document stops after the first round that fills its last bin (one
to three rounds for most texts). Agreement of two sketches estimates the Jaccard similarity with
the concentration of t independent samples.

Banding: ``rows`` coordinates per band; with t = 128 and rows = 4, two documents at similarity
0.8 share no band with probability (1 - 0.8**4)**32 < 1e-7.

Links are confirmed on whole shingle sets. Documents with the same set collapse to one class
first (aggregated map-side), so a group of copies is one node. A band bucket never emits all its
pairs at once: every member is tested against the bucket's smallest member; buckets whose members
then still lie in different components are resolved by all cross-component pairs if they are
small, and larger ones block against block: a task computes the whole-set intersections of two
blocks as matrix products and emits only a spanning forest of the links. Nothing is capped or
dropped, and what a bucket emits grows in proportion to its members.

Defined results: a text without words (or null) has an empty set and is linked with nothing;
fewer words than the shingle length give the whole sequence as one shingle; rows with equal
sets are linked; rows with a null id are linked with nothing; rows that share an id count as one
document where they represent a class, but every class is compared by its own text. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tectonic.llm import hashing as H
from tectonic.llm.common import Workspace, connected_components

SMALL_BUCKET = 64
BLOCK = 512
UNFILLED = H.U64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, concatenated, and their offsets."""
    starts, ends, first = H.word_spans(data, offsets)
    words = H.word_hashes(data, starts, ends, lower=True)
    sums = H.prefix_sums(words)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words))
    start = place[place + shingle <= np.repeat(first[1:], counts)]
    end = start + shingle
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    hashes = H.span_hashes(sums, np.concatenate((start, first[short])),
                           np.concatenate((end, first[short + 1])))
    owners = np.concatenate((owner[start], short))
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[new], np.searchsorted(owners[new], np.arange(len(counts) + 1))


def sketch(hashes: np.ndarray, offsets: np.ndarray, t: int) -> np.ndarray:
    """(texts x t) fast similarity sketches of concatenated sets (rows of empty sets stay
    unfilled)."""
    n = len(offsets) - 1
    filled = np.full(n * t, UNFILLED)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    shift = H.U64(64 - (2 * t - 1).bit_length())
    low = (H.U64(1) << shift) - H.U64(1)
    for i in range(2 * t):
        if not len(hashes):
            break
        x = H.mix(hashes + H.U64((H.BASE * (2 * i + 1)) & (2**64 - 1)))
        if i < t:
            place = owner * t + (((x >> H.U64(40)) * H.U64(t)) >> H.U64(24)).astype(np.int64)
        else:
            place = owner * t + (i - t)
        np.minimum.at(filled, place, (H.U64(i) << shift) | (H.mix(x) & low))
        open_texts = (filled.reshape(n, t) == UNFILLED).any(axis=1)
        still = open_texts[owner]
        hashes, owner = hashes[still], owner[still]
    return filled.reshape(n, t)


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of the key."""
    n, t = sketches.shape
    parts = H.mix(sketches).reshape(n, t // rows, rows)
    keys = np.tile(np.arange(t // rows, dtype=H.U64), (n, 1))
    for j in range(rows):
        keys = H.mix(keys * H.U64(H.BASE) + parts[:, :, j])
    return keys


def _sketch_rows(shingle: int, t: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = H.text_buffer(batch.column(1))
            sizes, ids, bands = [], [], []
            for i, j in H.slices(offsets):
                own = offsets[i:j + 1] - offsets[i]
                hashes, at = shingle_sets(data[offsets[i]:offsets[j]], own, shingle)
                sizes.append(np.diff(at))
                ids += [hashlib.blake2b(hashes[a:b], digest_size=16).digest() if b > a else None
                        for a, b in zip(at[:-1], at[1:])]
                bands.append(band_keys(sketch(hashes, at, t), rows))
            n = len(ids)
            bands = np.concatenate(bands).view(np.int64).ravel() if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.concatenate(sizes) if n else [], pa.int64()),
                 pa.array(ids, pa.binary()),
                 pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * (t // rows), bands)],
                ["doc_id", "print", "n_shingles", "set_id", "bands"])
    return run


def _set_rows(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = H.text_buffer(batch.column(1))
            for i, j in H.slices(offsets):
                own = offsets[i:j + 1] - offsets[i]
                hashes, at = shingle_sets(data[offsets[i]:offsets[j]], own, shingle)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i),
                     pa.ListArray.from_arrays(at.astype(np.int32), hashes.view(np.int64))],
                    ["id", "print", "shingles"])
    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("print").alias("pa"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("print").alias("pb"), F.col("shingles").alias("sb"))
    both = pairs.join(left, ["a", "pa"]).join(right, ["b", "pb"]).select(
        "a", "b", (F.size("sa") + F.size("sb")).cast("long").alias("n"),
        F.size(F.array_intersect("sa", "sb")).cast("long").alias("common"))
    return both.where(F.col("common") * 100 >= (F.col("n") - F.col("common")) * percent).select("a", "b")


def _block_links(percent: int):
    """Links across components inside one pair of blocks of a bucket: whole-set intersections of
    all members at once as matrix products over the shingles that occur twice, reduced to a
    spanning forest of the components met."""
    def run(key, table):
        ids, labels = table["id"].to_numpy(), table["label"].to_numpy()
        lists = table["shingles"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        tokens, place = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        owner = np.repeat(np.arange(len(ids)), sizes)
        twice = np.bincount(place, minlength=len(tokens)) > 1
        column = np.cumsum(twice) - 1
        owner, place = owner[twice[place]], column[place[twice[place]]]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        common = np.zeros((len(ids), len(ids)), np.float32)
        for at in range(0, int(twice.sum()), 4096):
            low, high = np.searchsorted(place, [at, at + 4096])
            dense = np.zeros((len(ids), 4096), np.float32)
            dense[owner[low:high], place[low:high] - at] = 1
            common += dense @ dense.T
        total = (sizes[:, None] + sizes[None, :]).astype(np.int64)
        common = common.astype(np.int64)
        linked = (common * 100 >= (total - common) * percent) & (labels[:, None] < labels[None, :])
        x, y = np.nonzero(linked)
        _, once = np.unique(np.stack((labels[x], labels[y])), axis=1, return_index=True)
        root = {}

        def find(v):
            while root.get(v, v) != v:
                v = root[v]
            return v

        edges = []
        for i, j in zip(x[once].tolist(), y[once].tolist()):
            u, v = find(int(labels[i])), find(int(labels[j]))
            if u != v:
                root[max(u, v)] = min(u, v)
                edges.append((int(ids[i]), int(ids[j])))
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()),
                         "b": pa.array([e[1] for e in edges], pa.int64())})
    return run


def near_duplicates(docs: DataFrame, *args, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; options as in ``judged``."""
    return judged(docs, *args, **options).drop("print")


def judged(docs: DataFrame, shingle: int = 5, percent: int = 80, t: int = 128,
                    rows: int = 4, id_col: str = "doc_id", text_col: str = "text",
                    small_bucket: int = SMALL_BUCKET, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, print (xxhash64 of its text), n_shingles, component_id, kept."""
    if t % rows:
        raise ValueError("t must be a multiple of rows")
    work = Workspace(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"),
                        F.xxhash64(F.col(text_col).cast("string")).alias("print"))
    sketches = work.save(texts.mapInArrow(
        _sketch_rows(shingle, t, rows),
        "doc_id long, print long, n_shingles long, set_id binary, bands array<long>"))
    classes = work.save(
        sketches.where("doc_id is not null and set_id is not null").groupBy("set_id")
        .agg(F.min(F.struct("doc_id", "print")).alias("at"), F.first("n_shingles").alias("n"),
             F.first("bands").alias("bands"))
        .select("set_id", F.col("at.doc_id").alias("id"), F.col("at.print").alias("print"), "n", "bands"))

    # Buckets with two members or more, and every member's test against the smallest one.
    banded = classes.select("id", "print", "n", F.explode("bands").alias("bucket"))
    heads = banded.groupBy("bucket").agg(
        F.min(F.struct("id", "n", "print")).alias("head"), F.max("id").alias("last")) \
        .where("head.id < last").select("bucket", "head")
    buckets = work.save(banded.join(heads, "bucket"))

    def close(x, y):
        return F.least(x, y) * 100 >= F.greatest(x, y) * percent

    pairs = work.save(
        buckets.where((F.col("id") != F.col("head.id")) & close(F.col("n"), F.col("head.n")))
        .select(F.col("head.id").alias("a"), F.col("head.print").alias("pa"),
                F.col("id").alias("b"), F.col("print").alias("pb")).distinct())
    # Every member of a shared bucket may be tested in some round; only their texts move.
    members = buckets.select("id", F.col("print").alias("own")).distinct()
    sets = work.save(
        texts.join(members, (texts["doc_id"] == members["id"]) & (texts["print"] == members["own"]), "left_semi")
        .groupBy("doc_id", "print").agg(F.min("text").alias("text")).select("doc_id", "text", "print")
        .mapInArrow(_set_rows(shingle), "id long, print long, shingles array<long>"))
    edges = work.save(_linked(pairs, sets, percent))
    components = work.save(connected_components(edges, work))

    # Buckets that still hold several components: all pairs across components of small ones ...
    labelled = buckets.join(components, "id", "left").select(
        "bucket", "id", "print", "n", F.coalesce("component", "id").alias("label"))
    mixed = labelled.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.count("*").alias("size")).where("low < high")
    remaining = work.save(labelled.join(mixed.select("bucket", "size"), "bucket"))
    small = remaining.where(F.col("size") <= small_bucket)
    one, two = small.alias("x"), small.alias("y")
    fresh = one.join(two, F.col("x.bucket") == F.col("y.bucket")) \
        .where((F.col("x.id") < F.col("y.id")) & (F.col("x.label") != F.col("y.label"))
               & close(F.col("x.n"), F.col("y.n"))) \
        .select(F.col("x.id").alias("a"), F.col("x.print").alias("pa"),
                F.col("y.id").alias("b"), F.col("y.print").alias("pb")).distinct() \
        .join(pairs, ["a", "pa", "b", "pb"], "left_anti")
    # ... and block against block inside large ones.
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("id", "print"), blocks).cast("int")
    dealt = remaining.where(F.col("size") > small_bucket) \
        .select("bucket", "id", "print", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")) \
        .select("bucket", "id", "print", "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    across = dealt.join(sets, ["id", "print"]).groupBy("bucket", "i", "j") \
        .applyInArrow(_block_links(percent), "a long, b long")
    edges = work.save(components.select(F.col("id").alias("a"), F.col("component").alias("b"))
                      .union(_linked(fresh, sets, percent)).union(across))
    components = connected_components(edges, work)
    work.drop(sets)
    roots = classes.select("set_id", "id").join(components, "id", "left") \
        .select(F.col("set_id").alias("class"), F.coalesce("component", "id").alias("root"))
    out = sketches.select("doc_id", "print", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_id")).alias("set_id"))
    return out.join(roots, out["set_id"] == roots["class"], "left").select(
        "doc_id", "print", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"),
        F.coalesce(F.col("root"), F.col("doc_id")).eqNullSafe(F.col("doc_id")).alias("kept"))
