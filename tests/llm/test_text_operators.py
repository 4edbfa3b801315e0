"""Operators on documents against brute force, on the smallest table and on awkward rows."""

import glob
import hashlib
import os
import random
import time
import tracemalloc
import zlib
from fractions import Fraction

from llm import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tectonic.llm import bpe, common, hashing, induced, langid, minhash, packing, quality, substring, suffix_array
from tectonic.llm.common import Workspace, connected_components
from tectonic.llm.queries import RANKS, WORDS

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def awkward(spark):
    """With extra columns whose names the operators use themselves."""
    return spark.createDataFrame(brute.AWKWARD, brute.SCHEMA).withColumns(
        {name: F.lit("extra") for name in ("key", "hash", "bucket", "n_words", "n_removed", "spans", "kept", "score",
                                           "ids", "row", "component", "low", "shard", "print", "marks")})


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], brute.SCHEMA)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def same(got, expected):
    def order(rows):
        return sorted(rows, key=repr)
    assert order(got) == order(expected)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(400, i) for i in range(401, 450)]
    links += [(i, i + 1) for i in range(500, 540)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"), Workspace(spark))
    ids = {x for pair in links if pair[0] != pair[1] for x in pair}
    assert {r.id: r.component for r in found.collect()} == brute.components(ids, [p for p in links if p[0] != p[1]])


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, awkward, empty, size):
    for table in (docs, awkward):
        got = minhash.near_duplicates(table, size).where("doc_id is not null").collect()
        expected = brute.near_duplicates(pairs(table), size)
        assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
            (d, n, c, c == d) for d, (n, c) in expected.items()}
        assert len(got) == table.where("doc_id is not null").count()
    assert minhash.near_duplicates(empty, size).count() == 0


def test_near_duplicates_large_mixed_bucket(spark):
    """A family of near copies whose members are and are not linked, all in common buckets."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(150):
        rate = rng.choice([0.01, 0.03, 0.06, 0.1])
        rows.append((d, " ".join(f"n{rng.random()}" if rng.random() < rate else w for w in base)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(table, 2, small_bucket=4, block=16).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(rows, 2)


def test_near_duplicates_of_clashing_ids(spark):
    """Two texts of one id: each is compared by itself, and only the copy of a smaller id goes."""
    import corpus_pipeline
    def text(name, *odd):
        return " ".join(odd + tuple(f"{name}{i}" for i in range(100)))
    rows = [(5, text("a")), (5, text("z")), (9, text("z", "new")), (7, text("q")), (3, text("m")), (8, text("m")), (8, text("k"))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.n_shingles): r.component_id for r in minhash.near_duplicates(table, 5).collect()}
    assert found[(9, 97)] == 5 and found[(7, 96)] == 7
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, table, SF).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([rows[0], rows[1], rows[3], rows[4], rows[6]])


def test_sketch_fills_every_bin():
    hashes = hashing.mix(np.arange(7, dtype=np.uint64))
    found = minhash.sketch(hashes, np.array([0, 1, 1, 7]), 64)
    assert (found[0] != minhash.UNFILLED).all() and (found[2] != minhash.UNFILLED).all()
    assert (found[1] == minhash.UNFILLED).all()


@pytest.mark.parametrize("period", [1, 2, 7, 13, 31])
def test_difference_cover(period):
    cover = substring.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_repeated_windows(docs, awkward, empty):
    for table in (docs, awkward):
        got = substring.remove_repeated_windows(table, one_space=True)
        assert got.columns == [c for c in table.columns if c not in ("n_words", "n_removed")] + ["n_words", "n_removed"]
        same([(r.doc_id, r.n_words, r.n_removed, r.text or "") for r in got.collect()],
             brute.repeated_windows(pairs(table)))
    assert substring.remove_repeated_windows(empty).count() == 0


def test_repeated_windows_keep_spacing(awkward):
    got = {(r.doc_id, r.n_removed): r.text for r in substring.remove_repeated_windows(awkward).collect()}
    assert got[(3, 0)] == " \t\n" and got[(13, 60)] == "lead alpha" and got[(14, 60)] == "other start "


def test_suffixes_against_sorting():
    rng = np.random.default_rng(0)
    for it in range(300):
        text = rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(1, 60))).astype(np.uint8)
        text = np.tile(text, int(rng.integers(1, 4)))
        cap, raw = int(rng.integers(1, 40)), text.tobytes()
        buckets = list(induced.suffix_buckets(text, cap, memory=1 if it % 3 == 0 else 1 << 20))[::-1]
        order = np.concatenate([b[0] for b in buckets]).tolist()
        prefix = np.concatenate([b[1] for b in buckets]).tolist()
        expected = sorted(range(len(raw)), key=lambda i: raw[i:])
        assert [raw[i:i + cap] for i in order] == [raw[i:i + cap] for i in expected]
        for a, b, lcp in zip(order, order[1:], prefix[1:]):
            n = 0
            while n < cap and max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            assert lcp == n


@pytest.mark.parametrize("shard_bytes,memory", [(4 << 20, 64 << 20), (20_000, 5_000)])
def test_byte_repeats(docs, awkward, empty, shard_bytes, memory):
    for table in (docs, awkward):
        got = suffix_array.remove_repeats(table, shard_bytes=shard_bytes, memory=memory)
        same([(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r["kept"])) for r in got.collect()],
             brute.byte_repeats(pairs(table)))
    assert suffix_array.remove_repeats(empty).count() == 0


def test_byte_repeats_around_a_common_line(spark, monkeypatch):
    """A line of 100 bytes with ever different text around it: no shard holds all its pieces."""
    rng, shard_bytes = random.Random(7), 4000
    line = "".join(rng.choice("abcdefgh ") for _ in range(100))
    words = ["".join(rng.choice("ijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(400)]
    rows = []
    for d in range(300):
        around = [" ".join(rng.choices(words, k=40)) for _ in range(2)]
        if d % 9 == 1:  # only the left or the right of the line as in the row before
            around[d % 2] = rows[-1][1].split(line)[d % 2]
        rows.append((d, line.join(around)))
    rows += [rows[5], rows[5], rows[6], (400, rows[8][1] + rows[8][1]), (401, "é" + line * 4), (None, rows[9][1])]
    sort_shard = suffix_array._sort_shard

    def bounded(length, memory):
        run = sort_shard(length, memory)

        def checked(key, table):
            if sum(len(t) for t in table["text"].to_pylist()) > 5 * shard_bytes:
                raise ValueError("a shard is too large")
            return run(key, table)
        return checked

    monkeypatch.setattr(suffix_array, "_sort_shard", bounded)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_array.remove_repeats(table, shard_bytes=shard_bytes).collect()
    same([(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r["kept"])) for r in got], brute.byte_repeats(rows))
    assert sum(r.n_removed for r in got) > 0


def test_packing(docs, awkward, empty):
    tokenizer = Tokenizer.from_file(WORDS)
    for table in (docs, awkward):
        pieces = packing.pack(table, WORDS, 2, size=256, shard_tokens=5000).collect()
        expected = [(r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in table.collect()]
        assert sum(r.length for r in pieces) == sum(len(ids) for _, ids in expected)
        unique = {d: ids for d, ids in expected if d is not None and d != 10}
        for d, ids in unique.items():
            own = sorted((r for r in pieces if r.doc_id == d), key=lambda r: r.start)
            assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
            assert b"".join(bytes(r.ids) for r in own) == np.array(ids, "<u4").tobytes()
            assert {r.doc_tokens for r in own} == {len(ids)}
        by_sequence = {}
        for r in pieces:
            by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for own in by_sequence.values():
            own.sort()
            total = sum(n for _, n in own)
            assert [o for o, _ in own] == np.cumsum([0] + [n for _, n in own])[:-1].tolist()
            assert total == 256 or total & (total - 1) == 0
    assert packing.pack(empty, WORDS, 2).count() == 0


def test_packing_keeps_proportions(docs):
    pieces = packing.pack(docs, WORDS, 2, size=4096, shard_tokens=1 << 15).toPandas()
    share = pieces.groupby("source").length.sum() / pieces.length.sum()
    full = pieces.groupby("sequence_id").length.sum()
    full = pieces[pieces.sequence_id.isin(full[full == 4096].index)]
    each = full.pivot_table(index="sequence_id", columns="source", values="length", aggfunc="sum").fillna(0) / 4096
    assert (each - share).abs().max().max() < 0.02


def naive_round_robin(queues, shares, deficits, sizes):
    """The schedule written out: quanta in order of the queues, then the largest deficit first."""
    left, owed = list(queues), list(deficits)
    for size in sizes:
        takes, room = [], size
        owed = [o + size * float(share) for o, share in zip(owed, shares)]
        for q in range(len(left)):
            take = max(0, min(int(owed[q]), left[q], room))
            if take:
                takes.append((q, take))
            left[q], owed[q], room = left[q] - take, owed[q] - take, room - take
        while room:
            waiting = [q for q in range(len(left)) if left[q]]
            q = max(waiting, key=lambda q: (owed[q], -q))
            others = [owed[o] for o in waiting if o != q]
            take = min(left[q], room, max(1, int(owed[q] - max(others))) if others else room)
            takes.append((q, take))
            left[q], owed[q], room = left[q] - take, owed[q] - take, room - take
        yield takes


def test_schedule_and_pieces():
    rng = random.Random(5)
    for _ in range(200):
        documents = [[rng.randint(1, 90) for _ in range(rng.randint(1, 30))] for _ in range(rng.randint(1, 9))]
        queues = [sum(d) for d in documents]
        weights = [q * rng.randint(1, 3) for q in queues]
        shares, owed = [Fraction(w, sum(weights)) for w in weights], [rng.random() for _ in queues]
        sizes = packing.capacities(sum(queues), 64)
        plan = list(packing.round_robin(queues, shares, owed, sizes))
        assert plan == list(naive_round_robin(queues, shares, owed, sizes))
        lengths = [n for d in documents for n in d]
        tokens = [(row, i) for row, n in enumerate(lengths) for i in range(n)]
        heads = np.cumsum([0] + queues)[:-1].tolist()
        expected = []
        for takes in plan:
            expected.append([])
            for q, n in takes:
                expected[-1] += tokens[heads[q]:heads[q] + n]
                heads[q] += n
        got = [[None] * n for n in sizes]
        cut = packing.cut_pieces(np.array(lengths), iter(plan))
        for row, at, n, sequence, offset in zip(*(cut[c].tolist() for c in ("row", "at", "length", "sequence", "offset"))):
            assert got[sequence][offset:offset + n] == [None] * n
            got[sequence][offset:offset + n] = [(row, at + i) for i in range(n)]
        assert got == expected


def test_packing_many_sources_and_empty_texts(spark):
    rows = spark.range(6000).selectExpr("id as doc_id", "concat('s', id % 3000) as source", "if(id % 2 = 0, '', 'two words') as text") \
        .union(spark.range(6000, 60000).selectExpr("id", "'bulk'", "cast(null as string)"))
    pieces = packing.pack(rows, WORDS, 2, size=4096).toPandas()
    assert sorted(pieces.doc_id.unique()) == list(range(60000))
    assert pieces.groupby("doc_id").length.sum().eq(pieces.groupby("doc_id").doc_tokens.first()).all()
    sizes = pieces.groupby("sequence_id").length.sum()
    assert all(n & (n - 1) == 0 for n in sizes) and (sizes == 4096).sum() == sizes.sum() // 4096
    share = (pieces.source == "bulk").mul(pieces.length).groupby(pieces.sequence_id).sum() / sizes
    whole = pieces.length[pieces.source == "bulk"].sum() / pieces.length.sum()
    assert (share[sizes == 4096] - whole).abs().max() < 0.02


def test_temporary_tables_are_deleted(spark, docs):
    before = len(common._OPENED)
    with common.temporary_tables():
        minhash.near_duplicates(docs.limit(20)).write.format("noop").mode("overwrite").save()
        folders = [work.root for work in common._OPENED[before:]]
        assert folders and all(os.listdir(f.removeprefix("file:")) for f in folders)
    assert not any(os.path.exists(f.removeprefix("file:")) for f in folders)
    assert len(common._OPENED) == before


def test_stitching():
    own = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("ab A1 \n\t  '’st.!é　\x1c漢😀́½") for _ in range(rng.randint(1, 60)))
        size, overlap = rng.choice([3, 5, 8, 13]), rng.choice([0, 1, 2, 4])
        chunks = [text[k * size:(k + 1) * size + overlap] for k in range((len(text) + size - 1) // size)]
        found = bpe.stitch(own.pattern, chunks, [bpe.boundaries(own.pattern, c) for c in chunks], size)
        assert "".join(found) == text
        assert [i for s in found for i in own.ids(s).tolist()] == own.encoding.encode_ordinary(text)


@pytest.mark.parametrize("chunk,overlap", [(1 << 16, 1 << 10), (700, 40)])
def test_byte_bpe(docs, awkward, empty, chunk, overlap):
    own = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    for table in (docs, awkward):
        encoded = bpe.encode(table, RANKS, public_tokenizers.PATTERN, chunk, overlap)
        got = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
        same([(r.doc_id, r.ids, bytes(r.decoded)) for r in got],
             [(d, own.encoding.encode_ordinary(t or ""), (t or "").encode()) for d, t in pairs(table)])
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_language(docs, awkward, empty):
    learned = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2")
    model = langid.fit(learned)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    held = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) > 0.95
    odd = langid.predict(awkward, model).collect()
    assert len(odd) == awkward.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in odd if r.doc_id in (1, 2, 3, 11))
    assert all(0 <= r.score <= 1 for r in odd)
    none = langid.fit(empty)
    assert {r.lang_pred for r in langid.predict(awkward, none).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0 and langid.accepted(awkward, none).count() == 0
    assert langid.accepted(docs, model).count() == docs.count()


def test_every_language_is_learned(spark):
    """More languages than the sample has rows to spare, one of them with a single row."""
    rng = random.Random(8)
    rows = [(k * 1000 + i, " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{rng.choice('xyz')}" for _ in range(30)), f"l{k:03}")
            for k in range(300) for i in range(1 if k == 7 else 4)]
    rows += [(None, "repeated", "l000")] * 50
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(langid.fit(table).languages) == 300
    assert len(langid.fit(table, sample_rows=100).languages) == 300


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9, 30])
def test_codewords(n):
    code = langid.codewords(n).astype(int)
    assert code.shape[0] == n and len({tuple(row) for row in code}) == n
    if n > 5:
        assert ((code.shape[1] - code @ code.T) // 2 + 1000 * np.eye(n, dtype=int)).min() >= 3


def test_features_do_not_depend_on_slices():
    data = np.frombuffer("ab\nçde".encode() * 300_000, np.uint8)
    whole = langid.features(data, np.array([0, len(data)]))
    assert np.allclose((whole**2).sum(), 1, atol=1e-3)
    assert np.allclose(whole, langid.features(data[:7 * 1000], np.array([0, 7000])), atol=2e-2)


def test_quality(spark, docs, awkward, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels.where("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1"))
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    held = [(r.doc_id, r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([(got[d] >= 0.5) == (y == 1) for d, y in held]) > 0.85
    odd = quality.score(awkward, model).collect()
    assert len(odd) == awkward.count() and all(0 <= r.score <= 1 for r in odd)
    blank = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(awkward, blank).collect()} == {0.5}
    assert quality.score(empty, model).count() == 0


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.boost(x[:3000], y[:3000], trees=30, depth=3)
    assert ((model.score(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.97


def test_digest_queries(spark):
    from tectonic.llm import queries
    own = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    texts = dict(pairs(spark.read.parquet(f"{SF}/documents.parquet")))
    for r in queries.byte_bpe(spark, SF).collect():
        ids = own.encoding.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.exact_repeats(spark, SF).collect()}
    assert got == {d: (n, gone, spans, hashlib.sha256(kept).hexdigest())
                   for d, n, gone, spans, kept in brute.byte_repeats(list(texts.items()))}


def thue_morse():
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_long_words_of_two_letters_are_told_apart(spark):
    one, two = thue_morse()
    rest = " ".join(f"w{i}" for i in range(49))
    rows = [(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"q{one}z"), (4, f"q{two}z")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring.remove_repeated_windows(table).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    few = spark.createDataFrame([(1, f"{one} x"), (2, f"{two} x")], "doc_id long, text string")
    assert all(r.kept for r in minhash.near_duplicates(few, shingle=2, percent=80).collect())
    expected = brute.byte_repeats(rows)
    same([(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_array.remove_repeats(table).collect()],
         expected)


def test_repeated_rows_cost_in_proportion(spark):
    """The marks and spans of m equal rows are those of one row, not m times as many."""
    text = " ".join(f"word{i}" for i in range(400))
    rows = [(5, text)] * 300 + [(1, text)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {(r.doc_id, r.n_removed) for r in substring.remove_repeated_windows(table).collect()} == {(5, 400), (1, 0)}
    got = suffix_array.remove_repeats(table)
    assert {(r.n_removed, len(r.spans)) for r in got.collect()} == {(len(text), 1)}


def test_a_shared_passage_is_joined_back_by_its_ends(spark, monkeypatch):
    """Documents share a passage in ever different surroundings: two rows a chain of windows."""
    rng = random.Random(9)
    passage = " ".join(f"shared{i}" for i in range(63))

    def around(d):
        return " ".join(f"d{d}w{rng.randrange(10**6)}" for _ in range(45))
    rows = [(d, f"{around(d)} {passage} {around(d)}") for d in range(1, 61)]
    rows += [(100 + d, f"{around(d)} {' '.join(passage.split()[5:60])} {around(d)}") for d in range(5)]
    joined = []
    ends = substring._chain_ends
    monkeypatch.setattr(substring, "_chain_ends", lambda found, work: joined.append((found, ends(found, work))) or joined[-1][1])
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_removed, r.text) for r in substring.remove_repeated_windows(table, one_space=True).collect()]
    same(got, brute.repeated_windows(rows))
    found, chains = joined[0]
    # 14 windows in 60 documents, of which 6 are in five more: chains of 5, 6 and 3 windows
    assert found.join(chains, ["one", "two"]).where("doc_id > low").count() == 59 * 6 + 5 * 2 < 59 * 14 < found.count()


def test_lines_that_texts_repeat_are_few_windows(spark):
    """Texts that repeat a line many times: a row for each distinct window of a text, not for each place."""
    lines = [" ".join(f"{c}{i}" for i in range(7)) for c in "abc"]
    rows = [(d, " ".join([f"start{d}", *[lines[d % 3]] * (20 + d), f"end{d}"])) for d in range(1, 25)]
    rows += [(50, "again " * 300), (51, "again " * 120 + "x"), (51, "again " * 120 + "x"), (52, "again " * 49)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_removed, r.text) for r in substring.remove_repeated_windows(table, one_space=True).collect()]
    same(got, brute.repeated_windows(rows))


def test_shuffle_files_of_a_saved_table_are_deleted(spark):
    work = Workspace(spark)
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}

    before = files()
    saved = work.save(spark.range(50_000).groupBy((F.col("id") % 30_000).alias("k")).agg(F.count("*").alias("n")))
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and saved.count() == 30_000
    twice = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert len(twice.collect()) == len(twice.collect()) == 7  # files that are missed are made again
    work.close()


def test_names_of_suffixes_are_hashed_in_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    text = np.concatenate([rng.integers(1, 5, 400), np.full(300, 7), np.tile(rng.integers(1, 200, 60), 4)]).astype(np.uint8)
    whole = induced.repeated_starts(text, 20)
    monkeypatch.setattr(induced, "BLOCK", 16)
    assert (induced.repeated_starts(text, 20) == whole).all() and whole.any() and not whole.all()
    seen = {}
    for i in range(len(text) - 19):
        seen.setdefault(text[i:i + 20].tobytes(), []).append(i)
    again = sorted(i for places in seen.values() if len(places) > 1 for i in places)
    assert np.flatnonzero(whole).tolist() == again


def test_a_shard_sort_stays_small():
    """The names' hashes took some 60 bytes for each symbol of the whole text."""
    text = np.random.default_rng(4).integers(1, 60, 1 << 20).astype(np.uint8)
    tracemalloc.start()
    induced.repeated_starts(text, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 75 * len(text)
