"""Exact top-k search by integer inner product over norm-sorted vectors.

Vectors are quantised to floor(scale * x). Candidates are dealt into blocks of descending length
(range partitioning on the norm), queries into blocks too, and each pair of blocks is one task.
A task walks its candidates by descending length in small groups. With q and c rotated by the
singular vectors of the candidates (fitted on a bounded sample: any rotation is exact, a fitted
one prunes better), the product is a partial sum over the leading components plus a residual that
Cauchy-Schwarz bounds by the residual lengths. A query leaves the walk once its length times the
next candidate's length cannot reach its k-th best score; pairs whose partial sum plus residual
bound cannot reach it are not scored. Remaining pairs get exact integer scores.

The longest block runs first; the k-th best scores it gives are the starting thresholds in all
other blocks. A query's threshold over its length is the length that a candidate needs to reach it.
Queries are dealt into blocks of ascending need, and only pairs of blocks in which the longest
candidate has the least need are formed at all: a block of short candidates is copied to few
blocks of queries. For this the driver sees one number for each block (8 bytes for 8,192 candidates
and for 1,024 queries). Ties go to the smaller id.

Equal vectors have equal scores, so of each distinct vector only the k + 1 rows with the smallest
ids are candidates, each distinct query vector is searched once for its k + 1 best rows, and every
query row then takes the first k of them that are not itself. A vector that holds a third of all
rows costs no more than any other.

Defined results: components and scores outside the range of a long become its nearest value
(scores are summed exactly first);
null vectors and vectors with a null or non-finite component take no part;
repeated rows are rows of their own (only the query's own row is left out); vectors of other
dimensions are compared over the leading components they share; a null id takes no part; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tectonic.llm.common import Workspace

CANDIDATES, QUERIES, STEP, SAMPLE = 8192, 1024, 512, 4096
SLACK = 1e-6  # covers rounding of the rotated sums, relative to the product of lengths


def _matrix(lists: pa.ChunkedArray, dim: int) -> np.ndarray:
    lists = lists.combine_chunks()
    values, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
    out = np.zeros((len(lists), dim), np.int64)
    for r, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
        out[r, :b - a] = values[a:b]
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of all rows; through floating point where that is exact, and by integers
    of any size where a long could overflow."""
    largest = a.shape[1]
    for part in (a, b):
        largest *= max(abs(int(part.min(initial=0))), int(part.max(initial=0)))
    if largest < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if largest < 1 << 63:
        return a @ b.T
    limits = np.iinfo(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, limits.min, limits.max).astype(np.int64)


def reached(longest: list[float], needs: list[float]) -> tuple[list[int], list[int]]:
    """For each candidate block the number of query blocks that it can still serve, and for each
    query block the number of candidate blocks that can serve it. ``longest`` descends, ``needs``
    ascends, so both are counts from the first block on."""
    lengths, needs = np.asarray(longest, np.float64), np.asarray(needs, np.float64)
    return (np.searchsorted(needs, lengths, "right").tolist(),
            np.searchsorted(-lengths, -needs, "right").tolist())


def search(queries: np.ndarray, own: np.ndarray, floor: np.ndarray, candidates: np.ndarray,
           ids: np.ndarray, rows: np.ndarray, rotation: np.ndarray, lead: int, k: int,
           step: int = STEP) -> tuple[list[list[tuple[int, int]]], int]:
    """For each query its best (score, id) among the candidates that reach ``floor`` (the best
    k-th score known so far), and the number of exact scores. ``own`` and ``rows`` are row
    numbers, ``ids`` break ties."""
    length = np.sqrt((candidates.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((ids, -length))
    candidates, ids, rows, length = candidates[order], ids[order], rows[order], length[order]
    turned_q, turned_c = queries @ rotation, candidates @ rotation
    length_q = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    rest_q = np.sqrt((turned_q[:, lead:] ** 2).sum(axis=1))
    rest_c = np.sqrt((turned_c[:, lead:] ** 2).sum(axis=1))
    best: list[list[tuple[int, int]]] = [[] for _ in queries]
    floor, scored = floor.astype(np.float64).copy(), 0
    lowest = float(np.iinfo(np.int64).min)
    floor[floor <= lowest] = -np.inf  # such a score may stand for any below it
    for at in range(0, len(candidates), step):
        part = slice(at, at + step)
        slack = SLACK * length_q * length[at] + SLACK
        live = np.flatnonzero(length_q * length[at] + slack >= floor)
        if not len(live):
            break
        reach = turned_q[live, :lead] @ turned_c[part, :lead].T + rest_q[live, None] * rest_c[None, part]
        wanted = reach + slack[live, None] >= floor[live, None]
        hit = wanted.any(axis=1)
        live, wanted = live[hit], wanted[hit]
        if not len(live):
            continue
        scored += int(wanted.sum())
        exact = _exact(queries[live], candidates[part])
        for r, q in enumerate(live.tolist()):
            use = np.flatnonzero(wanted[r] & (exact[r] >= floor[q]) & (rows[part] != own[q]))
            if not len(use):
                continue
            use = use[np.lexsort((ids[part][use], -exact[r][use]))[:k]]
            merged = best[q] + list(zip(exact[r][use].tolist(), ids[part][use].tolist()))
            merged.sort(key=lambda s: (-s[0], s[1]))
            best[q] = merged[:k]
            if len(best[q]) == k:
                worst = float(best[q][-1][0])
                floor[q] = max(floor[q], worst if worst > lowest else -np.inf)
    return best, scored


def _search_blocks(rotation: np.ndarray, lead: int, k: int):
    def run(key, left, right):
        names = ("query_row", "vec_id", "row", "score")
        rows = {name: [] for name in names}
        if left.num_rows and right.num_rows:
            right = right.sort_by([("vec_id", "ascending"), ("row", "ascending")])
            dim, place = len(rotation), np.arange(right.num_rows)
            best, _ = search(_matrix(left["ints"], dim), np.full(left.num_rows, -1), left["floor"].to_numpy(),
                             _matrix(right["ints"], dim), place, place, rotation, lead, k)
            ids, numbers = right["vec_id"].to_numpy(), right["row"].to_numpy()
            for query, found in zip(left["row"].to_pylist(), best):
                for score, at in found:
                    for name, value in zip(names, (query, ids[at], numbers[at], score)):
                        rows[name].append(value)
        return pa.table({name: pa.array(values, pa.int64()) for name, values in rows.items()})
    return run


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding", candidate_block: int = CANDIDATES,
          query_block: int = QUERIES, lead: int = 16, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best rows. ``is_query`` is a column
    condition on ``vec_id``."""
    spark = vectors.sparkSession
    work = Workspace(spark)
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = work.save(
        vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
        .select("vec_id", F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("ints"))
        .withColumn("norm", F.sqrt(F.aggregate(
            "ints", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))))
        .withColumn("row", F.monotonically_increasing_id()))
    copies = Window.partitionBy("ints").orderBy("vec_id", "row")
    candidates = work.save(rows.withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= k + 1).drop("nth"))
    n, dim = candidates.agg(F.count("*"), F.coalesce(F.max(F.size("ints")), F.lit(0))).first()
    fitted = _matrix(candidates.orderBy(F.xxhash64("vec_id")).limit(sample).select("ints").toArrow()["ints"], dim)
    rotation = np.linalg.svd(fitted, full_matrices=True)[2].T if len(fitted) >= dim else np.eye(dim)
    blocks = max(1, -(-n // candidate_block))
    dealt = work.save(candidates.repartitionByRange(blocks, F.col("norm").desc(), "vec_id", "row").select(
        "vec_id", "ints", "norm", "row", F.spark_partition_id().alias("c")))
    queries = work.save(rows.where(is_query).groupBy("ints", "norm").agg(F.min("row").alias("row")))
    query_blocks = max(1, -(-queries.count() // query_block))

    def best(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInArrow(
            _search_blocks(rotation, lead, k + 1), "query_row long, vec_id long, row long, score long")

    longest = [(r.c, r.norm) for r in dealt.groupBy("c").agg(F.max("norm").alias("norm")).orderBy("c").collect()]
    start = longest[0][0] if longest else 0
    found = work.save(best(
        queries.select("ints", "row", F.lit(float("-inf")).alias("floor"), F.lit(start).alias("c"),
                       F.pmod(F.xxhash64("row"), F.lit(query_blocks)).cast("int").alias("q")),
        dealt.where(F.col("c") == start).select(
            "*", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"))))
    if len(longest) > 1:
        floors = found.groupBy("query_row").agg(
            F.when(F.count("*") > k, F.min("score")).cast("double").alias("floor"))
        # The margin keeps every candidate that rounding could let through in the walk.
        need = F.when((F.col("floor") > 0) & (F.col("norm") > 0),
                      F.col("floor") / F.col("norm") * (1 - 4 * SLACK)).otherwise(F.lit(0.0))
        ready = work.save(
            queries.join(floors, queries["row"] == floors["query_row"], "left")
            .select("ints", "row", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"), need.alias("need"))
            .repartitionByRange(query_blocks, "need", "row").withColumn("q", F.spark_partition_id()))
        needs = [(r.q, r.need) for r in ready.groupBy("q").agg(F.min("need").alias("need")).orderBy("q").collect()]
        serves, served = reached([norm for _, norm in longest], [need for _, need in needs])
        # Block numbers may have gaps (empty ranges), so pairs go by position among those with rows.
        places = spark.createDataFrame([(c, i, m) for i, ((c, _), m) in enumerate(zip(longest, serves))],
                                       "c int, place int, serves int")
        spans = spark.createDataFrame([(q, i, m) for i, ((q, _), m) in enumerate(zip(needs, served))],
                                      "q int, turn int, served int")
        left = ready.join(spans, "q").where("served > 1").select(
            "ints", "row", "floor", F.col("turn").alias("q"),
            F.explode(F.sequence(F.lit(1), F.col("served") - 1)).alias("c"))
        right = dealt.join(places, "c").where("place > 0 and serves > 0").select(
            "vec_id", "ints", "row", F.col("place").alias("c"),
            F.explode(F.sequence(F.lit(0), F.col("serves") - 1)).alias("q"))
        found = found.union(best(left, right))
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    best_rows = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1) \
        .groupBy("query_row").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "row", "score"))).alias("best"))
    answers = queries.select("ints", F.col("row").alias("query_row")).join(best_rows, "query_row").drop("query_row")
    return rows.where(is_query).join(answers, "ints").select(
        F.col("vec_id").alias("query_id"),
        F.posexplode(F.slice(F.filter("best", lambda r: r["row"] != F.col("row")), 1, k)).alias("rank", "hit")) \
        .select("query_id", (F.col("rank") + 1).alias("rank"), "hit.vec_id", "hit.score")
