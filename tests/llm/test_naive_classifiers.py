"""Language and quality scores against features, decoding and trees written out for one text at a time."""

import math
from collections import Counter

from llm import brute
import numpy as np
import pytest

from tectonic.llm import langid, quality
from tectonic.llm.common import crc_mod

from conftest import SF001


@pytest.fixture(scope="module")
def texts(spark):
    """The documents of the smallest scale and the awkward rows under ids of their own."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang")
    rows = [(-1000 - i, t, lang) for i, (_, t, lang, _) in enumerate(brute.AWKWARD)]
    both = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    return both, {r["doc_id"]: r["text"] for r in both.collect()}


def lowered(raw):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in raw)


def gram_features(text):
    raw, counts = lowered((text or "").encode()), Counter()
    for size, first, room in ((1, 0, None), (2, 0, 512), (3, 512, 1536)):
        for i in range(len(raw) - size + 1):
            gram = 0
            for byte in raw[i:i + size]:
                gram = (gram * 257 + byte) % 2**32
            mixed = gram * 2654435761 % 2**32
            counts[mixed >> 23 if room is None else first + (mixed >> 8) % room] += 1
    x = np.zeros(2048)
    for place, count in counts.items():
        x[place] = math.sqrt(count / counts.total())
    return x


def decoded(model, x):
    margins = [float(x @ model.weights[:, b]) + float(model.bias[b]) for b in range(model.code.shape[1])]
    loss = [len(margins) * sum(w * math.log1p(math.exp(-m * c)) for m, c, w in zip(margins, code, trust))
            for code, trust in zip(model.code, model.trust)]
    odds = [math.exp(min(loss) - v) for v in loss]
    return [o / sum(odds) for o in odds]


def test_languages(texts):
    docs, by_id = texts
    model = langid.fit(docs.where(crc_mod("doc_id", 4) != 2))
    got = langid.predict(docs, model).collect()
    assert len(got) == len(by_id) and len(model.languages) >= 4
    for row in got:
        text = by_id[row["doc_id"]]
        if not any(c.isalpha() for c in text or ""):
            assert (row["lang_pred"], row["score"], row["ambiguous"]) == ("und", 0.0, True)
            continue
        odds = decoded(model, gram_features(text))
        first, second = sorted(odds, reverse=True)[:2]
        assert row["score"] == pytest.approx(first, abs=1e-4)
        if first - second > 1e-3:
            assert row["lang_pred"] == model.languages[odds.index(first)]
        if abs(first - second - 0.2) > 1e-3:
            assert row["ambiguous"] == (first - second < 0.2)


def naive_statistics(text):
    raw = (text or "").encode()
    some, words = max(len(raw), 1), [w.encode() for w in brute.words(text)]
    many, sizes, low = max(len(words), 1), [len(w) for w in words], [lowered(w) for w in words]
    lines = [line for line in raw.split(b"\n")]
    lines = [line + b"\n" for line in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
    mean = sum(sizes) / many

    def share(codes):
        return sum(b in codes for b in raw) / some

    def good_end(b):
        return b > 127 or chr(b).isalnum()

    return [
        math.log1p(len(raw)), math.log1p(len(words)), mean,
        math.sqrt(max(sum(s * s for s in sizes) / many - mean * mean, 0)),
        -sum(c / some * math.log2(c / some) for c in Counter(raw).values()), len(raw) / max(len(lines), 1),
        share(range(97, 123)), share(range(65, 91)), share(range(48, 58)), share(range(128, 256)),
        share(b"\t\n\v\f\r "), share(b"\n"), share(b"*#$%&!|_=<>{}[]@~^"), share(b".,;:?"), share(b"!"), share(b"|"),
        share(b"/-_@"), len(set(low)) / many, max(Counter(low).values(), default=0) / many,
        sum(a == b for a, b in zip(low, low[1:])) / many, sum(not good_end(w[-1]) for w in words) / many,
        sum(65 <= w[0] <= 90 for w in words) / many, len(set(lines)) / max(len(lines), 1),
        max(Counter(lines).values(), default=0) / max(len(lines), 1), math.log1p(sum(s > 30 for s in sizes)),
    ]


def walked(model, x):
    total = model.base
    for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if x[feature[node]] > threshold[node] else 1)
        total += leaf[node - len(feature)]
    return 1 / (1 + math.exp(-total))


def statistics_of(some):
    raws = [(t or "").encode() for t in some]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raws])))
    return quality.statistics(np.frombuffer(b"".join(raws), np.uint8), offsets)


def test_quality_statistics(texts):
    some = list(texts[1].values())
    np.testing.assert_allclose(statistics_of(some), [naive_statistics(t) for t in some], rtol=1e-9, atol=1e-9)
    assert statistics_of([""]).shape == (1, 25)


def test_quality_scores(spark, texts):
    docs, by_id = texts
    labels = spark.read.parquet(f"{SF001}/labels.parquet").where(crc_mod("doc_id", 3) != 1)
    model = quality.fit(docs, labels)
    x = dict(zip(by_id, statistics_of(list(by_id.values()))))
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert got.keys() == x.keys() and len(model.feature) == quality.TREES
    assert all(got[d] == pytest.approx(walked(model, x[d]), abs=1e-12) for d in x)


def test_the_best_first_cut():
    """The root of the first tree is the cut of greatest gain among all edges of all statistics."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (400, 3)).astype(float)
    y = ((x[:, 1] > 4) ^ (rng.random(400) < 0.1)).astype(float)
    tree = quality.boost(x, y, trees=1, depth=1)
    p = y.mean()

    def gain(f, cut, smooth=5.0):
        left = x[:, f] <= cut
        total = 0.0
        for part, sign in ((left, 1), (~left, 1), (left | ~left, -1)):
            total += sign * (y[part] - p).sum()**2 / (part.sum() * p * (1 - p) + smooth)
        return total

    best = max(((gain(f, c), f, c) for f in range(3) for c in np.unique(x[:, f])[:-1]))
    assert (tree.feature[0, 0], tree.threshold[0, 0]) == (best[1], best[2]) == (1, 4.0)
