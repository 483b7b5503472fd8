"""Packing by lexical retrieval: each window holds a seed document and the texts most like it."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deq.llm.common import forget_digests, in_arrow, narrowed, utf8
from deq.session import materialize

#: Texts in one shard of the index.
SHARD = 1024

#: Shards that one task builds and packs, about.
SHARDS_A_TASK = 4

#: Saturation of term counts and weight of lengths in BM25.
K1, B = 1.2, 0.75

#: How byte-level tokenizers of this family cut a text before merging; a fixed value.
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_LOADED: dict = {}


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write visible Latin-1 characters as they are, other bytes from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class ByteEncoder:
    """Token ids by a byte-level vocabulary file of ``tokenizers``.

    Where the ids are also the merge ranks, which is tried out on a probe, the ranks are handed to
    ``tiktoken``, which is several times faster; otherwise ``tokenizers`` itself encodes.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.slow, self.fast = Tokenizer.from_file(path), None
        self.size = self.slow.get_vocab_size()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of, special = _byte_of_character(), {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        if all(c in byte_of for t in vocabulary for c in t):
            ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items()}
            self.fast = tiktoken.Encoding(path, pat_str=_CUTS, mergeable_ranks=ranks, special_tokens=special)
            probe = " ".join(["It's  here,\n\n 12.5 isn't naïve 漢字\t", *special, "unbelievably", "\x85x\x1c "])
            if self.fast.encode(probe, allowed_special="all") != self.slow.encode(probe, add_special_tokens=False).ids:
                self.fast = None

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def encoder(path: str) -> ByteEncoder:
    if path not in _LOADED:
        forget_digests()
        _LOADED[path] = ByteEncoder(path)
    return _LOADED[path]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenized(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Per document its number of tokens, digests of its full windows, and the ids after them (``tail``)."""

    def encode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own, rows = encoder(path), []
        for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            ids = np.append(own.ids(text.decode()), np.uint32(end_id))
            full = len(ids) // capacity * capacity
            crcs = [_crc(ids[at : at + capacity]) for at in range(0, full, capacity)]
            rows.append((doc_id, len(ids), crcs, ids[full:].astype("<u4" if own.size > 1 << 16 else "<u2").tobytes()))
        columns = list(zip(*rows)) or [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "doc_tokens", "crcs", "tail"])

    return in_arrow(narrowed(docs), encode, "doc_id long, doc_tokens long, crcs array<long>, tail binary")


def _tails(column: pa.Array, wide: bool) -> list[np.ndarray]:
    return [np.frombuffer(t, "<u4" if wide else "<u2").astype(np.int64) for t in column.to_pylist()]


def _document_counts(tails: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """How many tails hold each token, how many tails there are, and all their tokens."""
    wide = size > 1 << 16

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for ids in _tails(batch.column(0), wide):
                df[np.unique(ids)] += 1
                n, total = n + 1, total + len(ids)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[seen, -1, -2]), pa.array(np.r_[df[seen], n, total])], ["token", "n"])

    # One number per token of the vocabulary reaches the driver.
    rows = tails.select("tail").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    found = {r.token: r.n for r in rows}
    return np.array([found.get(t, 0) for t in range(size)], np.int64), found.get(-1, 0), found.get(-2, 0)


def bm25(tf: np.ndarray, idf: np.ndarray, length: np.ndarray | int, mean: float) -> np.ndarray:
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


class ShardIndex:
    """An inverted index over the tokens of some texts, with the BM25 weight of each posting."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, mean: float):
        lengths = np.array([len(t) for t in texts])
        pairs, tf = np.unique(
            np.repeat(np.arange(len(texts)), lengths) * len(idf) + np.concatenate(texts), return_counts=True
        )
        text, token = pairs // len(idf), pairs % len(idf)
        weight = bm25(tf, idf[token], lengths[text], mean)
        _, term, df = np.unique(token, return_inverse=True, return_counts=True)
        by_term = np.argsort(term, kind="stable")
        self.n = len(texts)
        self.text, self.weight = text[by_term], weight[by_term]
        self.last = np.cumsum(df)
        self.first = self.last - df
        #: The terms of each text, all of which make its query.
        self.terms = np.split(term, np.searchsorted(text, np.arange(1, self.n)))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every text for the terms of one of them."""
        first, last = self.first[self.terms[seed]], self.last[self.terms[seed]]
        size = last - first
        posting = np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)
        return np.bincount(self.text[posting], self.weight[posting], self.n)


def packed_shard(texts: list[np.ndarray], idf: np.ndarray, mean: float, capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (text, start, length) that hold every token of the texts once.

    The longest unused text is the next seed. Its unused neighbours follow, best first, as far as
    they fit; then the best neighbour that does not is cut to fill the window to the end, and the rest
    of it stays unused. Only what remains last may not fill a window; it is cut at powers of two.
    """
    index = ShardIndex(texts, idf, mean)
    left = np.array([len(t) for t in texts])
    done = np.zeros(len(texts), np.int64)
    sequences: list[list[tuple[int, int, int]]] = []
    for seed in np.argsort(-left, kind="stable"):
        while left[seed]:
            window, room = [(int(seed), int(done[seed]), int(left[seed]))], capacity - int(left[seed])
            done[seed] += left[seed]
            left[seed] = 0
            near = np.argsort(-index.scores(seed), kind="stable") if room else np.empty(0, np.int64)
            near = near[left[near] > 0]
            at = 0
            while room and at < len(near):
                fitting = np.flatnonzero(left[near[at:]] <= room)
                if not len(fitting):
                    break
                at += int(fitting[0])
                text, n = int(near[at]), int(left[near[at]])
                window.append((text, int(done[text]), n))
                done[text] += n
                left[text] = 0
                room -= n
                at += 1
            near = near[left[near] > 0]
            if room and len(near):
                text = int(near[0])
                window.append((text, int(done[text]), room))
                done[text] += room
                left[text] -= room
                room = 0
            sequences += _at_powers_of_two(window) if room else [window]
    return sequences


def _at_powers_of_two(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A window that is not full as sequences whose lengths are powers of two, longest first."""
    total = sum(n for _, _, n in window)
    rest, out = window[::-1], []
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        out.append([])
        while room:
            text, start, n = rest.pop()
            out[-1].append((text, start, min(n, room)))
            if n > room:
                rest.append((text, start + room, n - room))
            room -= min(n, room)
    return out


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def neighbour_pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """Pack documents, each closed by ``end_id``, into sequences of ``capacity`` tokens with those most like them.

    Full windows of a long document are sequences of their own. What is left of each document, less
    than a window, is dealt to shards of ``SHARD`` texts in the order of its two tokens of highest
    BM25 weight, so that texts alike meet; a token that very many share spans many shards. Each shard
    holds an inverted index with the weights of all its texts; document counts are those of the whole
    table. Sequences are full, or (the last ones of a shard) have the length of a power of two.

    Null and empty texts are the end id alone. Repeated rows are packed each; null ids stay null. An
    empty table gives no rows; other columns are not read. The numbers that reach the driver and the
    tasks are one per token of the vocabulary.
    """
    size = encoder(tokenizer_path).size
    wide = size > 1 << 16
    tokens = materialize(tokenized(docs, tokenizer_path, capacity, end_id))
    full = tokens.select("doc_id", "doc_tokens", F.posexplode("crcs").alias("_pos", "ids_crc32")).select(
        "doc_id", (F.col("_pos") * F.lit(capacity).cast("long")).alias("start"), F.lit(capacity).cast("long").alias("length"),
        "ids_crc32", "doc_tokens", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    tails = tokens.where(F.octet_length("tail") > 0).select("doc_id", "doc_tokens", "tail")
    df, n, total = _document_counts(tails, size)
    if not n:
        return full
    idf, mean = np.log1p((n - df + 0.5) / (df + 0.5)), total / n
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def topic(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        first, second = [], []
        for ids in _tails(batch.column(2), wide):
            own, tf = np.unique(ids, return_counts=True)
            best = own[np.argsort(-bm25(tf, shared.value[own], len(ids), mean), kind="stable")[:2]]
            first.append(int(best[0]))
            second.append(int(best[-1]))
        arrays = [pa.array(first, pa.int32()), pa.array(second, pa.int32()), *batch.columns]
        yield pa.RecordBatch.from_arrays(arrays, ["_first", "_second", "doc_id", "doc_tokens", "tail"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting = TaskContext.get().partitionId() << 33, []

        def shard(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            out = []
            for window in packed_shard([r[2] for r in rows], shared.value, mean, capacity):
                offset, number = 0, number + 1
                for text, start, length in window:
                    doc_id, doc_tokens, ids = rows[text]
                    crc = _crc(ids[start : start + length])
                    out.append((doc_id, doc_tokens - len(ids) + start, length, crc, doc_tokens, 2 * number, offset))
                    offset += length
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

        for batch in batches:
            waiting += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _tails(batch.column(2), wide))
            while len(waiting) >= SHARD:
                yield shard(waiting[:SHARD])
                waiting = waiting[SHARD:]
        if waiting:
            yield shard(waiting)

    keyed = in_arrow(tails, topic, "_first int, _second int, doc_id long, doc_tokens long, tail binary")
    order = ["_first", "_second", "_spread", "doc_id"]
    keyed = keyed.withColumn("_spread", F.xxhash64("doc_id", "tail"))
    dealt = keyed.repartitionByRange(max(1, -(-n // (SHARD * SHARDS_A_TASK))), *order).sortWithinPartitions(*order)
    return full.unionByName(dealt.select("doc_id", "doc_tokens", "tail").mapInArrow(pack, PIECES))
