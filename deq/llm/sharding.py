"""Consistent hashing with virtual nodes and bounded loads."""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deq.llm.common import narrowed, ranked

#: The ring is divided into 2 ** RING_BITS cells; virtual nodes sit on cell borders.
RING_BITS = 12
VIRTUAL_NODES = 64


def ring_owners(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[int]:
    """The shard of the next virtual node clockwise, for every cell of the ring.

    A node's places depend on its own number alone, so a further shard takes over cells and
    changes no other.
    """
    size = 1 << RING_BITS
    nodes: dict[int, tuple[int, int]] = {}
    for shard in range(shards):
        for replica in range(virtual_nodes):
            digest = xxhash.xxh3_64_intdigest(f"{shard}/{replica}".encode())
            cell, claim = digest >> (64 - RING_BITS), (digest & 0xFFFFFFFF, shard)
            nodes[cell] = min(nodes.get(cell, claim), claim)
    owners, at = [0] * size, nodes[min(nodes)][1]
    for cell in range(size - 1, -1, -1):
        at = nodes[cell][1] if cell in nodes else at
        owners[cell] = at
    return owners


def bounded_plan(counts: dict[int, int], shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int, int, int, int]]:
    """Runs of a cell's rows and their shard: (cell, first rank, end rank, shard, first slot).

    Every shard holds its share of the rows, one more for the first shards if the rows do not
    divide evenly. A shard first fills up with the rows of its own cells in the order of the ring;
    rows that find it full go on clockwise to the next shard that has room.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    slots, owners, size = [0] * shards, ring_owners(shards, virtual_nodes), 1 << RING_BITS
    plan, waiting = [], []

    def take(cell: int, rank: int, end: int, shard: int) -> int:
        n = min(end - rank, room[shard] - slots[shard])
        if n:
            plan.append((cell, rank, rank + n, shard, slots[shard]))
            slots[shard] += n
        return rank + n

    for cell in sorted(counts):
        rank = take(cell, 0, counts[cell], owners[cell])
        if rank < counts[cell]:
            waiting.append((cell, rank, counts[cell]))
    for cell, rank, end in waiting:
        for step in range(1, size):
            if rank == end:
                break
            rank = take(cell, rank, end, owners[(cell + step) % size])
        for shard in range(shards):  # a shard all of whose nodes were outbid owns no cell
            rank = take(cell, rank, end, shard)
    return plan


def ring_shards(docs: DataFrame, shards: int = 8, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """One row per document with its shard and its place there, by a bounded-load ring.

    Columns: doc_id, size (UTF-8 bytes plus 1; a null text has none), text_crc32, shard, slot
    (gapless from 0 in each shard), moved (whether the row overflowed its first shard). Row counts
    of shards differ by one at most. The ring position is the hash of doc_id, or of the text where
    doc_id is null. Equal rows are told apart by rank. Only the counts of the ring's cells, a
    fixed number, reach the driver.
    """
    spark = docs.sparkSession
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    place = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.coalesce("text", F.lit("")))))
    slim = narrowed(docs).select(
        "doc_id",
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.shiftrightunsigned(place, 64 - RING_BITS).cast("int").alias("_cell"),
    )
    rows = ranked(slim, "_cell", ["doc_id", "text_crc32", "size"])
    counts = {r[0]: r[1] for r in rows.groupBy("_cell").count().collect()}
    owners = ring_owners(shards, virtual_nodes)
    plan = [(*run, owners[run[0]] != run[3]) for run in bounded_plan(counts, shards, virtual_nodes)]
    runs = spark.createDataFrame(plan, "_c int, _from long, _to long, shard int, _slot long, moved boolean")
    within = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    return rows.join(F.broadcast(runs), (F.col("_cell") == F.col("_c")) & within).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"), "moved"
    )
