"""Clustering of integer vectors around moving centroids with a LAESA pivot table.

Every kept vector's Euclidean distances to a few fixed pivots are computed once and stored beside
it in a written table. In each round the driver knows the centroids' distances to the same pivots
(a k x pivots matrix), so |d(vector, pivot) - d(centroid, pivot)|, at its largest over the pivots,
bounds the distance of every centroid from below. The centroid with the least bound gets its exact
squared distance first; centroids whose bound stays above that are passed over, and all others get
exact integer distances. Bounds are widened by far more than their rounding error, so the exact
distances alone decide and ties go to the smaller number.

A round reads the stored table once and shuffles one partial sum per task, centroid and component;
nothing but the centroids (k x dimensions numbers) reaches the driver.

Defined results: a vector takes part if it has exactly ``dimensions`` components, none null or
non-finite; others have no row. Component x counts as floor(scale * x), exactly, however large:
sums travel as limbs of 30 bits and vectors beyond 2**27 are compared in Python's integers. A
distance or an inertia above the largest long is given as that long (the assignment is still
exact). With fewer vectors than ``k`` there are as many centroids as vectors, without any the
result is empty. Repeated rows are vectors of their own; equal start hashes (repeated ids) are
ordered by components. A null id takes part but starts no centroid unless too few others are
there. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tectonic.llm.common import Workspace

PIVOTS = 16
PLAIN = 1 << 27  # components up to this keep a squared distance of 64 components below 2**63
LIMB = 30
LARGEST = (1 << 63) - 1
CHUNK = 1 << 15  # exact distances computed at once


def _integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * values): int64 where every component is plain, else Python integers."""
    if not values.size or np.abs(values).max() * scale <= PLAIN:
        return np.floor(values * scale).astype(np.int64)

    def exact(x: float) -> int:
        top, bottom = float(x).as_integer_ratio()
        return scale * top // bottom

    return np.array([[exact(x) for x in row] for row in values.tolist()], object)


def _plain(values: np.ndarray) -> bool:
    return not values.size or bool((np.abs(values) <= PLAIN).all())


def _squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired rows (int64 or Python integers)."""
    if _plain(left) and _plain(right):
        apart = left.astype(np.int64) - right.astype(np.int64)
        return np.einsum("ij,ij->i", apart, apart)
    apart = left.astype(object) - right.astype(object)
    return (apart * apart).sum(axis=1)


def _lengths(squares: np.ndarray) -> np.ndarray:
    """Square roots as doubles; infinite where the square has no double."""
    out = np.empty(len(squares))
    for i, s in enumerate(squares.tolist()):
        try:
            out[i] = float(s) ** 0.5
        except OverflowError:
            out[i] = np.inf
    return out


def pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(vectors x pivots) Euclidean distances."""
    if _plain(vectors) and _plain(pivots):
        out = np.empty((len(vectors), len(pivots)))
        for j, pivot in enumerate(pivots.astype(np.int64)):
            apart = vectors.astype(np.int64) - pivot
            out[:, j] = np.sqrt(np.einsum("ij,ij->i", apart, apart).astype(np.float64))
        return out
    columns = [_lengths(_squared(vectors, np.broadcast_to(p, vectors.shape))) for p in pivots]
    return np.stack(columns, axis=1) if columns else np.zeros((len(vectors), 0))


def nearest(vectors: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray):
    """(nearest centroid, squared distance, number of exact distances) of every vector, from the
    stored pivot distances ``table``."""
    n, k = len(vectors), len(centroids)
    own = pivot_distances(centroids, pivots)
    with np.errstate(invalid="ignore"):
        bound = np.zeros((n, k))
        for j in range(own.shape[1]):
            np.maximum(bound, np.nan_to_num(np.abs(table[:, j, None] - own[None, :, j]), nan=0.0, posinf=0.0), out=bound)
    wide = not (_plain(vectors) and _plain(centroids))
    exact = np.full((n, k), None if wide else np.iinfo(np.int64).max, object if wide else np.int64)
    guess = bound.argmin(axis=1)
    rows = np.arange(n)
    exact[rows, guess] = _squared(vectors, centroids[guess])
    limit = _lengths(exact[rows, guess]) if wide else np.sqrt(exact[rows, guess].astype(np.float64))
    # distances are good to one part in 2**50; a part in 10**9 and 10**-6 are far more than that
    open_pairs = bound * (1 - 1e-9) - 1e-6 <= (limit * (1 + 1e-9))[:, None]
    open_pairs[rows, guess] = False
    at, which = np.nonzero(open_pairs)
    for low in range(0, len(at), CHUNK):
        a, c = at[low:low + CHUNK], which[low:low + CHUNK]
        exact[a, c] = _squared(vectors[a], centroids[c])
    if wide:
        best = np.array([min((d, c) for c, d in enumerate(row) if d is not None)[1] for row in exact.tolist()], np.int64)
    else:
        best = exact.argmin(axis=1)  # the first of equal ones
    return best, exact[rows, best], 1 + open_pairs.sum(axis=1)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)


def _with_pivots(pivots: np.ndarray, dimensions: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _integers(_matrix(batch.column(1), dimensions), scale)
            far = pivot_distances(vectors, pivots)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(far), pa.list_(pa.float64()))],
                ["vec_id", "embedding", "far"])
    return run


def _assigned(batch: pa.RecordBatch, centroids, pivots, dimensions: int, scale: int):
    vectors = _integers(_matrix(batch.column(1), dimensions), scale)
    return vectors, *nearest(vectors, _matrix(batch.column(2), len(pivots)), centroids, pivots)


def _limbs(total: int) -> list[int]:
    """Signed digits of base 2**LIMB, least first."""
    sign, rest, out = (-1 if total < 0 else 1), abs(total), []
    while rest:
        out.append(sign * (rest & ((1 << LIMB) - 1)))
        rest >>= LIMB
    return out or [0]


def _partial_sums(centroids: np.ndarray, pivots: np.ndarray, dimensions: int, scale: int):
    """One row per centroid, component and limb with this task's sum; place -1 is the count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        for batch in batches:
            vectors, best, _, _ = _assigned(batch, centroids, pivots, dimensions, scale)
            for c in np.unique(best).tolist():
                members = vectors[best == c]
                mine = [len(members), *(int(v) for v in members.sum(axis=0).tolist())]
                sums[c] = [a + b for a, b in zip(sums[c], mine)] if c in sums else mine
        rows = [(c, place - 1, power, limb) for c, totals in sums.items() for place, total in enumerate(totals)
                for power, limb in enumerate(_limbs(total))]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int64()) for column in columns], ["cluster", "place", "power", "limb"])
    return run


def _final_rows(centroids: np.ndarray, pivots: np.ndarray, dimensions: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, best, squares, tried = _assigned(batch, centroids, pivots, dimensions, scale)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.int32()),
                 pa.array([min(int(s), LARGEST) for s in squares.tolist()], pa.int64()),
                 pa.array(tried, pa.int64())], ["vec_id", "cluster", "distance", "n_exact"])
    return run


def _moved(rows, centroids: np.ndarray) -> np.ndarray:
    """Centroids replaced by the floor of their members' mean; those without members stay."""
    totals: dict[tuple[int, int], int] = {}
    for row in rows:
        at = row["cluster"], row["place"]
        totals[at] = totals.get(at, 0) + (row["total"] << (LIMB * row["power"]))
    out = [[totals[c, j] // totals[c, -1] for j in range(centroids.shape[1])] if totals.get((c, -1)) else own
           for c, own in enumerate(centroids.tolist())]
    return np.array(out, np.int64 if all(abs(x) < 1 << 62 for own in out for x in own) else object)


def spread_out(points: np.ndarray, count: int) -> np.ndarray:
    """``count`` of the points, each the farthest from those before it."""
    chosen = [0]
    nearest_of = pivot_distances(points, points[:1])[:, 0]
    while len(chosen) < min(count, len(points)):
        chosen.append(int(nearest_of.argmax()))
        nearest_of = np.minimum(nearest_of, pivot_distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, dimensions: int = 64,
            salt: str = "2:", pivots: int = PIVOTS) -> DataFrame:
    """One row per kept vector of ``vectors`` (vec_id, embedding): vec_id, cluster, distance
    (squared, to the final centroid), cluster_inertia, inertia, centroid_sha256 (of the centroid's
    components joined by commas) and n_exact (the centroids that got an exact distance in the last
    assignment)."""
    if dimensions > 64:
        raise ValueError("at most 64 components")
    spark = vectors.sparkSession
    work = Workspace(spark)
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        (F.size("embedding") == dimensions)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    order = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    start = kept.orderBy(order.asc_nulls_last(), "embedding").limit(k).select("embedding").collect()
    if not start:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, "
                                         "inertia long, centroid_sha256 string, n_exact long")
    centroids = _integers(np.array([row["embedding"] for row in start], np.float64), scale)
    fixed = spread_out(centroids, pivots)
    element = kept.schema["embedding"].dataType.elementType.simpleString()
    stored = work.save(kept.mapInArrow(
        _with_pivots(fixed, dimensions, scale), f"vec_id long, embedding array<{element}>, far array<double>"))
    for _ in range(rounds):
        sums = stored.mapInArrow(_partial_sums(centroids, fixed, dimensions, scale),
                                 "cluster long, place long, power long, limb long")
        totals = sums.groupBy("cluster", "place", "power").agg(F.sum("limb").alias("total"))
        centroids = _moved(totals.collect(), centroids)  # k x (dimensions + 1) numbers
    final = work.save(stored.mapInArrow(
        _final_rows(centroids, fixed, dimensions, scale), "vec_id long, cluster int, distance long, n_exact long"))
    inertia = {row["cluster"]: int(row["total"]) for row in final.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    total = min(sum(inertia.values()), LARGEST)
    of = [(c, min(inertia[c], LARGEST), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest())
          for c, own in enumerate(centroids.tolist()) if c in inertia]
    by_cluster = F.create_map(*[x for c, own, digest in of for x in (
        F.lit(c), F.struct(F.lit(own).cast("long").alias("inertia"), F.lit(digest).alias("digest")))])[F.col("cluster")]
    return final.withColumn("_of", by_cluster).select(
        "vec_id", "cluster", "distance", F.col("_of.inertia").alias("cluster_inertia"),
        F.lit(total).cast("long").alias("inertia"), F.col("_of.digest").alias("centroid_sha256"), "n_exact")
