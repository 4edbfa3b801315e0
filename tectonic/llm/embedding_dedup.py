"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosine
verification in double precision, and distributed connected components.

Vectors are compared within a label (and dimension). Equal vectors of a label collapse to one
class with a multiplicity first. Each table hashes a vector to the signs of ``bits`` random
hyperplanes; two vectors at cosine c agree on a bit with p = 1 - acos(c) / pi. ``bits`` follows
from the number of vectors (buckets of about ``target`` vectors), and the number of tables from
the wanted bound on the chance to miss a pair at the threshold: (1 - p**bits)**tables <= miss.
``bits`` ends at 30, so that a sign fits an integer; a label of more than target * 2**30 vectors
gets larger buckets, which are dealt as blocks like any other. A vector travels once for each of
its buckets with more than one member, with the signs of the earlier tables only.

A bucket is verified as matrix products. Buckets above ``block`` vectors are dealt as pairs of
blocks to several tasks, so no group grows beyond two blocks and no bucket is capped. A pair that
meets in several tables counts in the first of them, so each task returns only link counts per
vector and a spanning forest, never the pairs.

Defined results: a null label, and a vector that is null, empty, zero or holds a null or
non-finite component, has no links; repeated rows link with each other; a null id gets no
component of its own and no links; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tectonic.llm.common import Workspace, connected_components

SEED = 20_240_601
TARGET, BLOCK, MISS = 256, 1024, 1e-6


def plan_tables(vectors: int, threshold: float, target: int = TARGET, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for the largest label's number of vectors."""
    bits = min(30, max(2, math.ceil(math.log2(max(vectors, 1) / target)))) if vectors > target else 2
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - agree))


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, largest component between a half and one: cosines and signs
    stay as they are, and products neither overflow nor vanish."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, initial=0))[1][:, None])


def _signature_rows(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            values, starts = batch.column(1).values.to_numpy(), batch.column(1).offsets.to_numpy()
            out = np.zeros((len(ids), tables), np.int32)
            sizes = np.diff(starts)
            for d in np.unique(sizes).tolist():
                if d not in planes:
                    planes[d] = np.random.default_rng((SEED, d)).standard_normal((d, bits * tables))
                rows = np.flatnonzero(sizes == d)
                above = (_scaled(values[starts[rows][:, None] + np.arange(d)].astype(np.float64)) @ planes[d]) > 0
                out[rows] = (above.reshape(len(rows), tables, bits) * weights).sum(axis=2)
            offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))], ["id", "signs"])
    return run


def _verify(threshold: float):
    def run(key, table):
        n = table.num_rows
        ids, own, copies = (table[c].to_numpy() for c in ("id", "own", "copies"))
        at = key[0].as_py()
        unit = _scaled(table["embedding"].combine_chunks().flatten().to_numpy().astype(np.float64).reshape(n, -1))
        length = np.sqrt((unit * unit).sum(axis=1))
        signs = table["signs"].combine_chunks().flatten().to_numpy().reshape(n, at)
        linked = (unit @ unit.T) >= threshold * np.outer(length, length)
        np.fill_diagonal(linked, False)
        if key[-2].as_py() != key[-1].as_py():
            linked &= own[:, None] != own[None, :]
        x, y = np.nonzero(linked)
        first = ~(signs[x] == signs[y]).any(axis=1)
        x, y = x[first], y[first]
        links = np.bincount(x, weights=copies[y], minlength=n).astype(np.int64)
        label = np.arange(n)
        while len(x):
            least = label.copy()
            np.minimum.at(least, x, label[y])
            least = least[least]
            if (least == label).all():
                break
            label = least
        hub, some = ids[label], links > 0
        return pa.table({"id": ids[some], "hub": hub[some], "links": links[some]})
    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label", target: int = TARGET,
                    block: int = BLOCK, miss: float = MISS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    work = Workspace(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
                          F.col(f"`{vector_col}`").alias("embedding"))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() \
        & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) \
        & F.exists("embedding", lambda v: v != 0)
    classes = work.save(rows.where(F.coalesce(good, F.lit(False))).groupBy("label", "embedding").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    most = classes.groupBy("label").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    bits, tables = plan_tables(most, threshold, target, miss)
    signs = work.save(classes.select("id", "embedding").mapInArrow(
        _signature_rows(bits, tables), "id long, signs array<int>"))
    kinds = classes.select("id", "label", F.size("embedding").alias("dim"))
    placed = signs.join(kinds, "id").select("id", "label", "dim", F.posexplode("signs").alias("place", "sign"))
    bucket = ["place", "label", "dim", "sign"]
    sizes = placed.groupBy(*bucket).agg(F.count("*").alias("size")).where("size > 1") \
        .select(*bucket, F.ceil(F.col("size") / F.lit(block)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id", "place"), F.col("blocks")).cast("int")
    dealt = placed.join(sizes, bucket).select(
        *bucket, "id", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")) \
        .select(*bucket, "id", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    found = work.save(
        dealt.join(classes.select("id", "embedding", "copies"), "id").join(signs, "id")
        .withColumn("signs", F.slice("signs", F.lit(1), F.col("place")))
        .groupBy(*bucket, "i", "j").applyInArrow(_verify(threshold), "id long, hub long, links long"))
    components = connected_components(found.select(F.col("id").alias("a"), F.col("hub").alias("b")), work)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    summary = classes.join(links, "id", "left").join(components, "id", "left").select(
        F.col("label").alias("own_label"), F.col("embedding").alias("own_embedding"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component", "id").alias("root"))
    use = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    return use.join(summary, F.col("good") & (use["label"] == summary["own_label"])
                    & (use["embedding"] == summary["own_embedding"]), "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"),
        F.coalesce("root", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"))
