"""Mixture-controlled packing of documents into fixed-size sequences by deficit round-robin.

The documents of a source form a queue of tokens. Every window takes from each queue its quantum
(window size times the source's share of all tokens); what rounding or an exhausted queue leaves
is a deficit that the source carries into the next window, and free room goes to the queues with
the largest deficits. So each window holds the target proportions up to rounding.

Distribution: a queue is cut at the points where the fluid schedule crosses from one shard to the
next (closed form, from the source's token total); the fraction lost by that rounding is the
deficit the shard starts with. Each shard then holds every source in the target proportions, has
the same size whatever the sources' sizes (a source with a third of all rows is spread over all
shards), and is packed on its own. A queue's order is the order of the input. The rest of a shard
fills sequences of the powers of two it consists of, so nothing is padded. A shard holds at most
``shard_tokens`` tokens and, as no document is without a token, as many rows; its pieces are cut in
arrays, not row by row.

Each document is its ids and the end id; every id lies in one piece. Defined results: a null text
is empty (one end id); a null source is the source ''; repeated rows are packed each; extra
columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from fractions import Fraction
from heapq import heapify, heappop, heappush
from struct import pack as pack_values

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tectonic.llm.common import Workspace

SHARD_TOKENS = 1 << 22
CACHED_WORDS = 500_000
BROADCAST_ROWS = 100_000  # of five numbers and a name each
_WORDS: dict = {}


class WordIds(dict):
    """The ids of words between white space, as little-endian bytes of ``width`` each; recent
    words and pieces stay in memory. The tokenizer drops white space and splits at it, so words
    can be encoded one by one.

    Where the tokenizer normalizes by NFC and lower case and splits by one pattern, a word of
    plain Latin characters is split here and only its pieces go to the tokenizer's model: most
    of a call's time is otherwise the alignment of normalized text, which packing does not need.
    Every other word (and any that holds an added token) is encoded by the whole tokenizer."""

    # Characters that NFC leaves alone beside each other and that are lower-cased singly.
    PLAIN = re.compile(r"[\x00-\x7f\u00a1-\u012f\u0131-\u017f]+")

    def __init__(self, path: str, end_id: int):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        largest = max(self.tokenizer.get_vocab_size() - 1, end_id, *added, 0)
        self.width = 2 if largest < 1 << 16 else 4
        self.form = "<%d" + ("H" if self.width == 2 else "I")
        self.added = re.compile("|".join(re.escape(t.content) for t in added.values()) or "(?!)").search
        self.end = self._raw([end_id])
        self.pieces: dict[str, bytes] = {}
        self.split = self._pattern()
        # The byte-level alphabet: printable bytes are themselves, the rest follow from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        self.alphabet = {b: b if b in own else next(rest) for b in range(256)}

    def _pattern(self):
        """The pattern that splits plain words, or None for a tokenizer of another make."""
        parts = json.loads(self.tokenizer.to_str())
        steps = (parts["normalizer"] or {}).get("normalizers", [])
        cuts = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
        if [x["type"] for x in steps] != ["NFC", "Replace", "Lowercase"] or \
                steps[1]["pattern"] != {"Regex": r"\s+"} or \
                [x["type"] for x in cuts] != ["Split", "ByteLevel"] or \
                not re.fullmatch(r"('\w+\||\[(\^\\s)?(\\p\{[LN]\})+\]\+?\|?)*", cuts[0]["pattern"]["Regex"]) or \
                (cuts[0]["behavior"], cuts[0]["invert"]) != ("Removed", True) or \
                cuts[1]["add_prefix_space"] or cuts[1]["use_regex"]:
            return None
        # The same pattern with the plain letters and numbers written out.
        plain = [chr(c) for c in range(0x180) if self.PLAIN.fullmatch(chr(c))]
        listed = {kind: "".join(c for c in plain if unicodedata.category(c)[0] == kind) for kind in "LN"}
        return re.compile(re.sub(r"\\p\{([LN])\}", lambda m: listed[m[1]], cuts[0]["pattern"]["Regex"]), re.ASCII)

    def _raw(self, ids: list[int]) -> bytes:
        return pack_values(self.form % len(ids), *ids)

    def _piece(self, piece: str) -> bytes:
        if (raw := self.pieces.get(piece)) is None:
            symbols = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.alphabet)
            raw = self._raw([t.id for t in self.tokenizer.model.tokenize(symbols)])
            if len(piece) <= 64:
                if len(self.pieces) >= CACHED_WORDS:
                    self.pieces.clear()
                self.pieces[piece] = raw
        return raw

    def __missing__(self, text: str) -> bytes:
        if self.split and (text.isascii() or self.PLAIN.fullmatch(text)) and not self.added(text):
            parts = self.split.findall(text.lower())
            raw = self._piece(parts[0]) if len(parts) == 1 else b"".join(map(self._piece, parts))
        else:
            raw = self._raw(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(text) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[text] = raw
        return raw

    def encode(self, texts: pa.StringArray) -> list[bytes]:
        """The ids of each text and the end id; each distinct word of the batch is looked up once."""
        words = pc.ascii_split_whitespace(texts)
        first = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy())))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(list(map(self.__getitem__, distinct)), pa.large_binary()).take(coded.indices)
        if not len(ids):
            return [self.end] * len(texts)
        bounds = np.frombuffer(ids.buffers()[1], np.int64)[:len(ids) + 1][first].tolist()
        data = memoryview(ids.buffers()[2])
        return [bytes(data[i:j]) + self.end for i, j in zip(bounds, bounds[1:])]


def _token_rows(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, end_id) not in _WORDS:
            _WORDS[path, end_id] = WordIds(path, end_id)
        words = _WORDS[path, end_id]
        part, taken = TaskContext.get().partitionId(), {}
        for batch in batches:
            start, sizes = [], []
            out = words.encode(batch.column(2))
            for source, ids in zip(batch.column(1).to_pylist(), out):
                start.append(taken.get(source, 0))
                sizes.append(len(ids) // words.width)
                taken[source] = start[-1] + sizes[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(sizes), pa.int32()), batch.column(0), batch.column(1),
                 pa.array(start, pa.int64()), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())],
                ["part", "doc_id", "source", "at", "doc_tokens", "ids"])
    return run


def _ids(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")


def _shard_rows(shards: int):
    """Cut each document where its source's queue crosses from one shard into the next."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {name: [] for name in ("shard", "doc_id", "source", "total", "at", "start", "doc_tokens", "width", "ids")}
            for r in batch.to_pylist():
                ids, at, end, total = _ids(r["ids"], r["doc_tokens"]), r["at"] + r["base"], 0, r["total"]
                while end < len(ids):
                    shard = ((at + end + 1) * shards - 1) // total
                    cut = min(len(ids), (shard + 1) * total // shards - at)
                    for name, value in (("shard", shard), ("doc_id", r["doc_id"]), ("source", r["source"]),
                                        ("total", total), ("at", at + end), ("start", end),
                                        ("doc_tokens", r["doc_tokens"]), ("width", ids.itemsize),
                                        ("ids", ids[end:cut].tobytes())):
                        rows[name].append(value)
                    end = cut
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.string() if k == "source" else pa.binary() if k == "ids" else pa.int64())
                 for k, v in rows.items()], list(rows))
    return run


def capacities(tokens: int, size: int) -> list[int]:
    """Full sequences, then the powers of two that the rest consists of."""
    rest = tokens % size
    return [size] * (tokens // size) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def round_robin(queues: list[int], shares: list[Fraction], deficits: list[float],
                sizes: list[int]) -> Iterator[list[tuple[int, int]]]:
    """For each sequence size, the (queue, tokens) it takes in order. ``queues`` are the tokens
    waiting, ``shares`` the target proportions, ``deficits`` what each is owed at the start. Whole
    quanta are taken as arrays; free room goes to the largest deficits by a heap."""
    left, owed = np.array(queues, np.int64), np.array([float(d) for d in deficits])
    shares = np.array([float(share) for share in shares])
    for size in sizes:
        owed += size * shares
        take = np.clip(np.floor(owed), 0, left).astype(np.int64)
        take = np.clip(take, 0, np.maximum(size - (np.cumsum(take) - take), 0))
        left -= take
        owed -= take
        some = np.flatnonzero(take)
        takes, room = list(zip(some.tolist(), take[some].tolist())), size - int(take.sum())
        if room:
            waiting = np.flatnonzero(left)
            heap = list(zip((-owed[waiting]).tolist(), waiting.tolist()))
            heapify(heap)
        while room:
            due, q = heappop(heap)
            # Up to the next largest deficit, or all that is free if no other queue waits.
            n = min(int(left[q]), room, max(1, int(heap[0][0] - due)) if heap else room)
            takes.append((q, n))
            left[q] -= n
            owed[q] -= n
            room -= n
            if left[q]:
                heappush(heap, (float(-owed[q]), q))
        yield takes


def cut_pieces(lengths: np.ndarray, plan) -> dict[str, np.ndarray]:
    """The pieces of a shard in the order of its sequences, as arrays: row and place in the row
    (``at``), place in the shard (``begin``), length, sequence and offset. ``lengths`` are the rows'
    tokens, queue by queue; ``plan`` takes every token."""
    queue, size, number, offset = (array("q") for _ in range(4))
    for n, takes in enumerate(plan):
        done = 0
        for q, take in takes:
            queue.append(q)
            size.append(take)
            number.append(n)
            offset.append(done)
            done += take
    queue, size, number, offset = (np.frombuffer(v, np.int64) for v in (queue, size, number, offset))
    # Takes of a queue follow one another in its tokens, so both documents and takes cut one line.
    order = np.argsort(queue, kind="stable")
    size, number, offset = size[order], number[order], offset[order]
    row_from, take_from = np.cumsum(lengths) - lengths, np.cumsum(size) - size
    start = np.union1d(row_from, take_from)
    length = np.diff(start, append=lengths.sum())
    row = np.searchsorted(row_from, start, "right") - 1
    take = np.searchsorted(take_from, start, "right") - 1
    pieces = {"row": row, "at": start - row_from[row], "begin": start, "length": length,
              "sequence": number[take], "offset": offset[take] + start - take_from[take]}
    order = np.lexsort((pieces["offset"], pieces["sequence"]))
    return {name: values[order] for name, values in pieces.items()}


def _pack(size: int, shards: int, tokens: int):
    def run(key, table):
        shard = key[0].as_py()
        order = pc.sort_indices(table, [("source", "ascending"), ("at", "ascending")])
        width = table["width"][0].as_py()
        raw = pa.concat_arrays(table["ids"].cast(pa.large_binary()).chunks).take(order)
        ends = np.frombuffer(raw.buffers()[1], np.int64)[:len(raw) + 1]
        ids = np.frombuffer(raw.buffers()[2], f"<u{width}", ends[-1] // width)
        lengths = np.diff(ends) // width
        coded = table["source"].combine_chunks().dictionary_encode().indices.to_numpy()[order.to_numpy()]
        first = np.flatnonzero(np.diff(coded, prepend=-1))  # sources are in order: one run each
        totals = table["total"].to_numpy()[order.to_numpy()[first]].tolist()
        waiting = np.add.reduceat(lengths, first).tolist()
        owed = [shard * t / shards - shard * t // shards for t in totals]
        cut = cut_pieces(lengths, round_robin(
            waiting, [Fraction(t, tokens) for t in totals], owed, capacities(sum(waiting), size)))
        rows = order.take(pa.array(cut.pop("row")))
        bounds = np.concatenate(([0], np.cumsum(cut["length"])))
        # The ids of all pieces one after another: each token's place before the cut.
        places = np.repeat(cut.pop("begin") - bounds[:-1], cut["length"])
        places += np.arange(bounds[-1])
        data = ids[places].astype("<u4")
        del places
        return pa.table({
            "doc_id": table["doc_id"].take(rows), "start": table["start"].to_numpy()[rows.to_numpy()] + cut.pop("at"),
            "length": cut["length"],
            "ids": pa.Array.from_buffers(pa.binary(), len(rows), [
                None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(data)]),
            "doc_tokens": table["doc_tokens"].take(rows), "sequence_id": (shard << 32) + cut["sequence"],
            "offset": cut["offset"], "source": table["source"].take(rows)})
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, size: int = 4096, shard_tokens: int = SHARD_TOKENS,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset, source. ``tokenizer`` is the path of a tokenizer file that
    every executor can open."""
    if size & (size - 1):
        raise ValueError("the sequence size must be a power of two")
    work = Workspace(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source"),
                        F.col(f"`{text_col}`").alias("text"))
    tokens = work.save(texts.mapInArrow(
        _token_rows(tokenizer, end_id),
        "part int, doc_id long, source string, at long, doc_tokens long, ids binary"))
    # Where each input partition begins in each queue: one row per partition and source.
    sums = tokens.groupBy("source", "part").agg(F.sum("doc_tokens").alias("n"))
    before = Window.partitionBy("source").orderBy("part")
    starts = work.save(sums.select(
        "source", "part", (F.sum("n").over(before) - F.col("n")).alias("base"),
        F.sum("n").over(Window.partitionBy("source")).alias("total"), "n"))
    total, rows = starts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    shards = max(1, -(-total // shard_tokens))
    starts = starts.drop("n")
    placed = tokens.join(F.broadcast(starts) if rows <= BROADCAST_ROWS else starts, ["source", "part"])
    cut = placed.mapInArrow(
        _shard_rows(shards), "shard long, doc_id long, source string, total long, at long, start long, "
                             "doc_tokens long, width long, ids binary")
    return cut.groupBy("shard").applyInArrow(
        _pack(size, shards, max(total, 1)),
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
        "offset long, source string")
