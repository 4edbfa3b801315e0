"""Byte-level BPE encoding of whole texts and decoding, for rank files.

A text is cut into chunks that overlap; chunks are pre-tokenised in parallel. A match of the
pattern depends only on the text from its start on, so two neighbouring chunks agree from the
first boundary that both have inside their overlap: there the pieces of one are stitched to the
pieces of the next. Where an overlap holds no common boundary (a run longer than the overlap),
the earlier chunk is pre-tokenised on into the next one until both meet. The stitched stretches
begin and end at piece boundaries, so they are encoded in parallel (each piece separately, by the
merges of the rank file), and a text's ids are put together in order.
Decoding concatenates the raw bytes of the ids.

Texts of up to ``chunk`` characters are cut into smaller chunks (``within``) and stitched in the task
that reads them, without an exchange; longer ones travel as chunks. One text's ids are the unit that
must fit a task, as the result holds them in one row.

Defined results: a null or empty text has no ids. Repeated rows are encoded each. Other columns
are not needed and not returned.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tectonic.llm.common import prepare

CHUNK, OVERLAP = 1 << 16, 1 << 10  # characters of a chunk that travels, and of its overlap
WITHIN, WITHIN_OVERLAP = 1 << 10, 1 << 6  # of a chunk of a text that stays in its task
SPACE = regex.compile(r"\s")
_ENCODERS: dict = {}


class Encoder:
    """The merges of a rank file, its pattern, and the raw bytes of each id."""

    def __init__(self, ranks: str, pattern: str):
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.raw = [b""] * (max(table.values(), default=-1) + 1)
        for token, rank in table.items():
            self.raw[rank] = token

    def ids(self, stretch: str) -> np.ndarray:
        """Ids of a text that ends at a piece boundary after a character other than white space.
        The pattern looks ahead only to end a run of white space, so such a text has the same
        pieces on its own."""
        return self.encoding.encode_to_numpy(stretch, disallowed_special=())


def encoder(ranks: str, pattern: str) -> Encoder:
    """The worker's encoder, loaded once per process."""
    if (ranks, pattern) not in _ENCODERS:
        _ENCODERS[ranks, pattern] = Encoder(ranks, pattern)
    return _ENCODERS[ranks, pattern]


def boundaries(pattern, text: str) -> list[int]:
    """Starts of the pieces of a text."""
    return [m.start() for m in pattern.finditer(text)]


def stitch(pattern, chunks: list[str], starts: list[list[int]], size: int) -> list[str]:
    """Stretches that begin and end at piece boundaries, end after a character other than white
    space (or with the text), and together are the whole text.
    Chunk k begins at k * size and overlaps the next; ``starts`` are its piece starts."""
    out, k, text, own, base = [], 0, chunks[0], starts[0], 0
    begin = 0  # absolute position from which this chunk's pieces are wanted
    while True:
        last = k + 1 == len(chunks)
        if last:
            out.append(text[begin - base:])
            return [stretch for stretch in out if stretch]
        # The last piece of a chunk may go on after its end; its start is still a boundary.
        edge = (k + 1) * size

        def is_end(p: int) -> bool:
            return base + p > begin and not SPACE.match(text, p - 1)

        mine = {base + p for p in own[bisect_left(own, edge - base):] if is_end(p)}
        meet = next((edge + p for p in starts[k + 1] if edge + p in mine), None) if mine else None
        if meet is None:
            go_on = next((p for p in reversed(own) if is_end(p)), begin - base)
            out.append(text[begin - base:go_on])
            text = text[go_on:] + chunks[k + 1][base + len(text) - edge:]
            base = begin = base + go_on
            own, k = boundaries(pattern, text), k + 1
            continue
        out.append(text[begin - base:meet - base])
        k, text, own, base, begin = k + 1, chunks[k + 1], starts[k + 1], edge, meet


def encode_in_chunks(own: Encoder, text: str, size: int, overlap: int) -> np.ndarray:
    """Ids of a whole text by overlapping chunks of ``size`` characters."""
    chunks = [text[at:at + size + overlap] for at in range(0, len(text), size)]
    if len(chunks) <= 1:
        return own.ids(text)
    found = stitch(own.pattern, chunks, [boundaries(own.pattern, c) for c in chunks], size)
    return np.concatenate([own.ids(stretch) for stretch in found])


def _int_lists(lists: list) -> pa.Array:
    ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    flat = np.concatenate([np.asarray(x, np.int32) for x in lists]) if lists else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _encode_texts(ranks: str, pattern: str, size: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks, pattern)
        for batch in batches:
            ids = [encode_in_chunks(own, text, size, overlap) if text else () for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _int_lists(ids)], ["doc_id", "ids"])
    return run


def _chunk_rows(size: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
                for k in range(0, (len(text) + size - 1) // size):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row], pa.int64()), pa.array([doc], pa.int64()), pa.array([k], pa.int32()),
                         pa.array([text[k * size:(k + 1) * size + overlap]])], ["row", "doc_id", "k", "text"])
    return run


def _chunk_starts(pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in batches:
            starts = _int_lists([boundaries(compiled, t) for t in batch.column(3).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, starts], ["row", "doc_id", "k", "text", "starts"])
    return run


def _stretches(pattern: str, size: int):
    def run(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: r["k"])
        found = stitch(regex.compile(pattern), [r["text"] for r in rows], [r["starts"] for r in rows], size)
        n = len(found)
        return pa.table({"row": pa.array([rows[0]["row"]] * n, pa.int64()),
                         "doc_id": pa.array([rows[0]["doc_id"]] * n, pa.int64()),
                         "k": pa.array(range(n), pa.int32()), "text": pa.array(found, pa.string())})
    return run


def _encode_stretches(ranks: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks, pattern)
        for batch in batches:
            ids = [own.ids(text) for text in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _int_lists(ids)], ["row", "doc_id", "k", "ids"])
    return run


def encode(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP,
           id_col: str = "doc_id", text_col: str = "text", within: int = WITHIN,
           within_overlap: int = WITHIN_OVERLAP) -> DataFrame:
    """doc_id and ids (array<int>) of each row's whole text. ``ranks`` is the path of a rank
    file that every executor can open."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    one = F.coalesce(F.length("text"), F.lit(0)) <= chunk
    short = texts.where(one).mapInArrow(
        _encode_texts(ranks, pattern, within, within_overlap), "doc_id long, ids array<int>")
    rows = "row long, doc_id long, k int, "
    whole = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").where(~one) \
        .mapInArrow(_chunk_rows(chunk, overlap), rows + "text string") \
        .repartition("row", "k") \
        .mapInArrow(_chunk_starts(pattern), rows + "text string, starts array<int>") \
        .groupBy("row").applyInArrow(_stretches(pattern, chunk), rows + "text string") \
        .repartition("row", "k") \
        .mapInArrow(_encode_stretches(ranks, pattern), rows + "ids array<int>") \
        .groupBy("row").agg(F.first("doc_id").alias("doc_id"),
                            F.flatten(F.sort_array(F.collect_list(F.struct("k", "ids")))["ids"]).alias("ids")) \
        .select("doc_id", "ids")
    return short.unionByName(whole)


def list_slices(column: pa.Array) -> Iterator[np.ndarray]:
    """The values of each list of a column (null: none)."""
    values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    for a, b, valid in zip(offsets[:-1].tolist(), offsets[1:].tolist(), column.is_valid()):
        yield values[a:b] if valid.as_py() else values[:0]


def _decode_ids(ranks: str, pattern: str, at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = encoder(ranks, pattern).raw
        for batch in batches:
            out = [b"".join(map(raw.__getitem__, ids.tolist())) for ids in list_slices(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names)
    return run


def decode(encoded: DataFrame, ranks: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """The rows of ``encoded`` plus ``decoded``: the raw bytes of their ids (null: none)."""
    prepare(encoded.sparkSession)
    encoded = encoded.select(*[c for c in encoded.columns if c != "decoded"])
    return encoded.mapInArrow(
        _decode_ids(ranks, pattern, encoded.columns.index(ids_col), [*encoded.columns, "decoded"]),
        StructType([*encoded.schema.fields, StructField("decoded", BinaryType())]))
