"""Best-fit-decreasing packing of token sequences."""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deq.llm.common import forget_digests, in_arrow, narrowed, ranked, utf8

#: Distinct chunks of text in each of the two generations that one Python worker remembers.
REMEMBERED = 350_000

#: Chunks that are encoded for the first time go to the tokenizer in texts of so many.
TOGETHER = 500

#: Stands between chunks of such a text; a chunk that holds it is encoded on its own.
_BETWEEN = "\x00"

#: 1 for ASCII letters, 2 for comma and full stop, 4 for breaks.
_KINDS = np.array([1 if chr(c).isalpha() and c < 128 else 2 if c in b".," else 4 if c in b" \t\n\x0b\x0c\r" else 0 for c in range(256)], np.uint8)


def stops_apart(text: bytes) -> bytes:
    """A blank before each comma or full stop between a letter and a break: such a stop is a token of its own."""
    padded = np.frombuffer(text + b" ", np.uint8)
    kinds = _KINDS[padded]
    stops = np.flatnonzero((kinds[1:-1] == 2) & (kinds[:-2] == 1) & (kinds[2:] == 4)) + 1
    return np.insert(padded, stops, 32).tobytes() if len(stops) else text

_LOADED: dict = {}


class ChunkEncoder:
    """Token ids of white-space separated chunks, remembered as little-endian bytes.

    Chunks are remembered in two generations: when the younger one is full the older one is dropped,
    but what was met again meanwhile has moved to the younger one, so frequent chunks stay.

    Usable for tokenizers that drop white space, ignore case and never join letters to stops or
    across white space, which is tried out when the tokenizer is loaded.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.between = self._ids([_BETWEEN])[0][0]
        probe = "ab, Cd.\n'll é.\t12 x.y ... it's"
        if np.frombuffer(self.encode([probe.encode()])[0], "<u4").tolist() != self._ids([probe])[0]:
            raise ValueError("this tokenizer's chunks cannot be encoded on their own")

    def _new(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks without a remembered one, many chunks at a time."""
        out = []
        for at in range(0, len(chunks), TOGETHER):
            words = [w.decode("utf-8", "replace") for w in chunks[at : at + TOGETHER]]
            ids = np.array(self._ids([f" {_BETWEEN} ".join(words)])[0], "<u4")
            cuts = np.flatnonzero(ids == self.between)
            if len(cuts) != len(words) - 1:
                out += [array("I", i).tobytes() for i in self._ids(words)]
                continue
            whole, ends = ids.tobytes(), (4 * np.r_[cuts, len(ids)]).tolist()
            out += [whole[lo:hi] for lo, hi in zip([0, *(e + 4 for e in ends)], ends)]
        return out

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """All ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        # Lower case could spell out a special token that the text does not hold.
        chunks = [stops_apart(d if b"<|" in d else d.lower()).split() for d in texts]
        missing = set().union(*chunks).difference(self.known)
        again = missing & self.older.keys()
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        new = list(missing - again)
        self.known.update(zip(new, self._new(new)))
        return [b"".join(map(self.known.__getitem__, words)) for words in chunks]


def encoded(path: str, texts: list[bytes]) -> list[bytes]:
    forget_digests()
    if path not in _LOADED:
        _LOADED[path] = ChunkEncoder(path)
    encoder = _LOADED[path]
    return [ids for at in range(0, len(texts), 200) for ids in encoder.encode(texts[at : at + 200])]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens, each document closed by ``end_id``.

    A null or empty text is the end id alone. ``with_ids`` adds the ids themselves. Repeated rows
    give repeated pieces; an empty table gives none.
    """
    closing = np.asarray([end_id], "<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, ids = [], []
        for doc_id, own in zip(batch.column(0).to_pylist(), encoded(tokenizer_path, utf8(batch.column(1)))):
            whole = own + closing
            for piece, at in enumerate(range(0, len(whole), 4 * capacity)):
                part = whole[at : at + 4 * capacity]
                rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                if with_ids:
                    ids.append(np.frombuffer(part, "<u4").astype(np.int32))
        columns = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            arrays.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(arrays, names)

    return in_arrow(narrowed(docs), cut, PIECES + (", ids array<int>" if with_ids else ""))


class OpenBins:
    """Counts of open bins by remaining capacity, in a segment tree."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)

    def add(self, remaining: int, n: int) -> None:
        at = self.leaves + remaining
        while at:
            self.tree[at] += n
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of an open bin that still holds ``least``."""
        at = self.leaves + least
        if not self.tree[at]:
            # Climb until a branch to the right holds something, then descend to its left-most leaf.
            while at > 1 and (at & 1 or not self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at *= 2
                if not self.tree[at]:
                    at += 1
        return at - self.leaves


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go, by best fit in order of decreasing length.

    ``counts`` holds how many pieces have each length. Pieces of one length are alike, so the bins
    of one remaining capacity are filled together: a tightest bin stays the tightest until it is
    too full for the length. Rows are (length, first rank, end rank, first bin, pieces per bin,
    first offset); their number depends on the capacity, not on the data.
    """
    bins, runs, plan, opened = OpenBins(capacity), {}, [], 0

    def put(remaining: int, first: int, n: int) -> None:
        if n and remaining:
            runs.setdefault(remaining, []).append((first, n))
            bins.add(remaining, n)

    for length in sorted(counts, reverse=True):
        rank, end = 0, counts[length]
        while rank < end:
            room = bins.tightest(length)
            if room is None:
                room, fits = capacity, capacity // length
                first, n = opened, -(-(end - rank) // fits)
                opened += n
            else:
                first, n = runs[room].pop()
                bins.add(room, -n)
                fits = room // length
            full = min(n, (end - rank) // fits)
            if full:
                plan.append((length, rank, rank + full * fits, first, fits, capacity - room))
                put(room - fits * length, first, full)
                rank += full * fits
            if full < n and rank < end:
                rest = end - rank
                plan.append((length, rank, end, first + full, rest, capacity - room))
                put(room - rest * length, first + full, 1)
                full, rank = full + 1, end
            if full < n:
                put(room, first + full, n - full)
    return plan


def best_fit_pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have a ``length`` of 1 to ``capacity``.

    Best-fit decreasing over all pieces at once: only the counts per length, at most ``capacity``
    numbers, reach the driver, and the plan made of them is joined to the pieces by their rank
    within their length. Gapless offsets; a piece's place among equals is arbitrary but fixed.
    """
    spark = pieces.sparkSession
    rows = ranked(pieces, "length", ["doc_id", "piece", "start"])
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("piece lengths must lie between 1 and the capacity")
    plan = spark.createDataFrame(
        best_fit_plan(counts, capacity), "length long, _from long, _to long, _bin long, _per long, _offset long"
    )
    within = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    nth = F.col("_rank") - F.col("_from")
    placed = rows.join(F.broadcast(plan.withColumnRenamed("length", "_length")), (F.col("length") == F.col("_length")) & within)
    return placed.select(
        *pieces.columns,
        (F.col("_bin") + F.floor(nth / F.col("_per"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + F.pmod(nth, F.col("_per")) * F.col("length")).alias("offset"),
    )
