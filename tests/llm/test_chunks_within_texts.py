"""Chunks of texts that stay in one task."""

import random

import public_tokenizers
import pytest
from llm import brute
from pyspark.sql import functions as F

from tectonic.llm import bpe
from tectonic.llm.queries import RANKS

from conftest import SF001, SF01


@pytest.mark.parametrize("size,overlap", [(1, 1), (7, 2), (40, 8), (300, 0), (bpe.WITHIN, bpe.WITHIN_OVERLAP)])
def test_chunks_equal_whole_texts(size, overlap):
    own = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(size)
    texts = ["", "a", " \n", "x" * 3000, " " * 2500 + "y", "one's two  three\n\n" * 200, "日本語 text 123456 " * 120]
    texts += ["".join(rng.choices("ab A1 \n\t  '’st.!é　漢😀½", k=rng.randrange(2500))) for _ in range(40)]
    for text in texts:
        assert bpe.encode_in_chunks(own, text, size, overlap).tolist() == own.encoding.encode_ordinary(text)


def test_most_documents_are_cut(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    cut = docs.where(F.length("text") > bpe.WITHIN).count()
    assert 2 * cut > docs.count()


def test_documents_by_small_chunks(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-100 - i, r[1]) for i, r in enumerate(brute.AWKWARD)], "doc_id long, text string"))
    own = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    got = {r["doc_id"]: r["ids"] for r in
           bpe.encode(docs, RANKS, public_tokenizers.PATTERN, within=90, within_overlap=12).collect()}
    assert got == {r["doc_id"]: own.encoding.encode_ordinary(r["text"] or "") for r in docs.collect()}
