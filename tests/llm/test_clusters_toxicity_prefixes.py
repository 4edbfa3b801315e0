"""Pivot-table clustering, lexicon toxicity and the prefix trie against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tectonic.llm import centroids, prefix_trie, toxicity
from tectonic.llm.oracle import SQL
from tectonic.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --- clustering --------------------------------------------------------------------------

def brute_clusters(rows, k, rounds, size, salt="2:"):
    kept = [(i, [floor(Fraction(x) * 256) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}{r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in order[:k]]

    def squared(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min((squared(v, c), j) for j, c in enumerate(middle)) for _, v in kept]

    for _ in range(rounds):
        at = assign()
        for j in range(len(middle)):
            own = [v for (_, v), (_, c) in zip(kept, at) if c == j]
            if own:
                middle[j] = [sum(xs) // len(own) for xs in zip(*own)]
    top = (1 << 63) - 1
    at = [(min(d, top), c) for d, c in assign()]
    total = min(sum(d for d, _ in at), top)
    return sorted((repr(i), c, d, min(sum(e for e, o in at if o == c), top), total,
                   hashlib.sha256(",".join(map(str, middle[c])).encode()).hexdigest())
                  for (i, _), (d, c) in zip(kept, at))


def clustered(df, **options):
    return sorted((repr(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                  for r in centroids.cluster(df, **options).collect())


def test_clusters(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, 1.0, -2.5]) + rng.random() / 8 for _ in range(6)]) for i in range(90)]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (200, rows[7][1]), (None, rows[8][1]), (201, None), (202, [1.0] * 5),
             (203, [1.0] * 7), (204, [0.0] * 5 + [None]), (205, [float("nan")] * 6), (206, [float("inf")] * 6), (207, [0.0] * 6)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "vec_id long, embedding array<double>, cluster string, far int").repartition(3)
    for k, rounds in ((7, 3), (200, 2), (1, 1)):
        assert clustered(table, k=k, rounds=rounds, dimensions=6) == brute_clusters(rows, k, rounds, 6)
    nothing = table.where("vec_id = 201")
    assert clustered(nothing, dimensions=6) == []
    assert clustered(table.limit(0), dimensions=6) == []
    tries = centroids.cluster(table, k=40, rounds=2, dimensions=6).agg(F.sum("n_exact"), F.count("*")).first()
    assert tries[1] <= tries[0] < 40 * tries[1]


def test_huge_components_stay_exact(spark):
    rows = [(i, [float(i) * 10.0 ** (i % 5 * 9), -1e300 if i == 7 else 0.5]) for i in range(12)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert clustered(table, k=4, rounds=3, dimensions=2) == brute_clusters(rows, 4, 3, 2)


def test_pruning_keeps_the_nearest():
    rng = np.random.default_rng(5)
    points = rng.integers(-300, 300, (400, 64))
    middle = np.concatenate((points[:20] + 3, points[:20] + 3))  # ties go to the smaller number
    pivots = centroids.spread_out(middle, 16)
    best, squares, tried = centroids.nearest(points, centroids.pivot_distances(points, pivots), middle, pivots)
    every = ((points[:, None, :] - middle[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (squares == every.min(axis=1)).all()
    assert tried[:20].max() < 40


# --- toxicity ----------------------------------------------------------------------------

CLEAN = "the river runs past the old mill and further down to the quiet sea".split()


def corpus():
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        own = [rng.choice(CLEAN) for _ in range(rng.randint(5, 60))]
        bad = i % 5 == 0
        if bad:
            own[rng.randrange(len(own))] = rng.choice(["grumbo", "Zwartish", "zwartling"])
        elif i % 19 == 0:
            own.insert(rng.randrange(len(own)), "grumbo soup")
        rows.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, y string")
    marks = spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, marks)
    assert " grumbo soup " in lexicon.exceptions and any(t.startswith(" zwa") for t in lexicon.weights)
    odd = [(1000, None), (1001, ""), (1002, " \t"), (None, "grumbo"), (1003, "gr𝐮mb0 by the sea"), (1004, "a ｇｒｕｍｂｏ here"),
           (1005, "grumbo soup and grumbo soup"), (1006, "x" * 200_000), (1007, "the sea " * 40_000 + "grumbo"),
           (1008, "zwаrt​ish"), (1008, "zwаrt​ish")]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    got = {r.doc_id: r.score for r in toxicity.score(table, lexicon).collect()}
    matcher = lexicon.matcher()
    for i, text in rows + odd:
        assert abs(got[i] - matcher.score(text)) < 1e-12 and abs(got[i] - brute_toxicity(lexicon, text)) < 1e-9
    right = sum((got[i] >= 0.5) == bool(bad) for i, bad in labels)
    assert right == len(labels)
    assert [got[i] >= 0.5 for i in (1000, 1001, 1002, None, 1003, 1004, 1005, 1006, 1008)] == \
        [False, False, False, True, True, True, False, False, True]
    assert got[1001] <= got[1007] < got[1004]  # one hit in a long text counts for less
    for nothing in (marks.limit(0), marks.where("toxic = 0")):
        assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, nothing)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), lexicon).count() == 0
    given = toxicity.fit(docs, marks, exceptions=("Zwartish river",))
    assert given.matcher().hits(toxicity.words("zwartish river")) == {}


def brute_toxicity(lexicon, text):
    """Every term tried at every word."""
    own = toxicity.words(text)
    joined = " " + " ".join(own) + " "
    total, at = 0.0, 0
    covered = set()
    for phrase in lexicon.exceptions:
        start = joined.find(phrase)
        while start >= 0:
            covered |= set(range(start, start + len(phrase) - 1))
            start = joined.find(phrase, start + 1)
    for word in own:
        if at not in covered:
            total += max((w for t, w in lexicon.weights.items()
                          if joined.startswith(t, at) or joined.startswith(t.replace("l", "i"), at)), default=0.0)
        at += len(word) + 1
    constant, a, b = lexicon.logit
    x = constant + a * np.log1p(total) + b * (np.log1p(100 * total / len(own)) if own else 0)
    return 1 / (1 + np.exp(-x))


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/labels.parquet")
    got = QUERIES["op12_lexicon_toxicity"](spark, sf)
    wrong = got.where("held_out").join(truth, "doc_id").agg(F.count("*"), F.sum((F.col("predicted") != F.col("toxic")).cast("int"))).first()
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert wrong[0] > 50 and wrong[1] <= 0.05 * wrong[0]


def test_folding():
    assert toxicity.words("You 1D10T! 455 $tup1d Wörthleß") == ["you", "idiot", "455", "stupid", "worthleß"]


# --- prefixes ----------------------------------------------------------------------------

def brute_prefixes(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, turn_hash(role, text), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        out, todo = [], [node]
        while todo:
            out.append(todo.pop())
            todo += children.get(out[-1], [])
        return out

    result = []
    for node, convs in members.items():
        inside = below(node)
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(node))))
        result.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                       len(children.get(node, [])), sum(not children.get(x) for x in inside),
                       sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in inside if x),
                       hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(result, key=repr)


def turn_hash(role, text):
    digest = hashlib.sha256(f"{len(role or '')}:{role or ''}:{text or ''}".encode()).hexdigest()
    return int(digest[:15], 16), int(digest[15:30], 16)


SCHEMA = "conv_id long, turn long, role string, text string"


def prefixes(df, **options):
    return sorted(map(tuple, prefix_trie.prefix_nodes(df, **options).collect()), key=repr)


@pytest.mark.parametrize("shard_rows", [1, 7, 1 << 15])
def test_prefixes(spark, shard_rows):
    rng = random.Random(7)
    rows = []
    for c in [*range(60), -3, -5, -10, 1001, 2004]:
        if c % 7 == 3:
            continue
        same = c % 3 == 0  # a third of all conversations are copies
        for turn in range(11 if same else rng.randint(1, 12)):
            rows.append((c, turn, "user" if turn % 2 else "assistant", f"é{turn}" if same else rng.choice(["a", "bb", "ü"])))
    rows += [(None, 1, "user", "x"), (70, None, None, None), (70, None, "user", None), (70, 2, "", ""), (70, 2, "", ""),
             (71, 0, "user", "long " * 50_000), (72, 5, "u", "a"), (72, 5, "u", "b"), (4, 0, "user", "a")]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", depth int, part string").repartition(5)
    assert prefixes(table, shard_rows=shard_rows) == brute_prefixes(rows)


def test_a_long_conversation_is_spread(spark):
    rows = [(10, i, "user", f"turn {i % 50}") for i in range(3000)] + [(11, i, "user", f"turn {i % 50}") for i in range(2000)]
    rows += [(c, 0, "user", "turn 0") for c in range(20, 40)]
    table = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefixes(table, shard_rows=400)
        parts = prefix_trie.numbered_turns(table).where("conv_id = 10").groupBy("part").count().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # too deep for the brute force of all nodes' subtrees: the chain is known
    assert len(got) == len({(r[0], r[1]) for r in got}) and max(r[1] for r in got) == 3000
    assert sum(r[5] for r in got if r[1] == 0) == sum(1 for r in got if r[4] == 0)
    assert parts > 1


def test_prefixes_of_nothing(spark):
    assert prefixes(spark.createDataFrame([], SCHEMA)) == []
    assert prefixes(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)) == []


def test_double_array_against_a_dictionary():
    rng = np.random.default_rng(8)
    for n in (1, 5, 400):
        parents = np.array([int(rng.integers(-1, i)) for i in range(n)])
        symbols = np.empty(n, np.int64)
        for p in range(-1, n):
            own = np.flatnonzero(parents == p)
            symbols[own] = rng.choice(np.arange(1, n + 5), len(own), replace=False)
        array = prefix_trie.DoubleArray(parents, symbols)
        assert len(set(array.state.tolist())) == n
        for i in range(n):
            above = np.array([0 if parents[i] < 0 else array.state[parents[i]]])
            assert array.step(above, symbols[i:i + 1])[0] == array.state[i]
            missing = np.setdiff1d(np.arange(1, n + 5), symbols[parents == parents[i]])
            assert (array.step(np.repeat(above, len(missing)), missing) == -1).all()
        assert sorted(np.concatenate(list(array.levels())).tolist()) == sorted(array.state.tolist())


@pytest.mark.parametrize("name", ["op11_laesa_centroids", "op13_double_array_prefixes"])
def test_equal_the_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for table in ("conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))
