"""Consistent-hash ring with virtual nodes and bounded loads (operator 3).

The ring is divided into ``2 ** RING_BITS`` bins. A document's id hashes to a bin; each shard owns
``VIRTUAL_NODES`` bins chosen by hash, and a bin belongs to the next virtual node clockwise. Every
shard has a bound; documents beyond it continue clockwise to the next virtual node whose shard has
room. With bounds that add up to the number of documents, shard sizes differ by one at most.

Which documents overflow needs only the count of each arc (the bins before a virtual node): the
first in ring order stay, the rest go on. Counts per bin are summed in Spark; the driver sees one
row for each virtual node, and sends back at most about twice as many segments (arc, ranks, shard).
The rank of a document in its arc is a prefix sum over bins plus a row number within its bin.

Defined cases: a null text has size 16 and the checksum of an empty text; a null id is a key like
any other. Documents with equal ids are ordered by size and checksum; equal rows are
interchangeable. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import written

RING_BITS = 16
VIRTUAL_NODES = 64


def virtual_nodes(shards: int) -> list[tuple[int, int]]:
    """(bin, shard) in ring order; a shard's nodes don't depend on the number of shards."""
    taken: dict[int, int] = {}
    for shard in range(shards):
        for node in range(VIRTUAL_NODES):
            at = int.from_bytes(hashlib.md5(f"{shard}/{node}".encode()).digest()[:8], "big") >> (64 - RING_BITS)
            while at in taken:
                at = (at + 1) % (1 << RING_BITS)
            taken[at] = shard
    return sorted(taken.items())


def bounded_segments(arcs: list[int], owners: list[int], bounds: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot): who takes which documents of each arc.

    Every arc first fills its own shard in ring order; what is left goes on clockwise, always to
    the next virtual node whose shard has room.
    """
    room, used, segments = list(bounds), [0] * len(bounds), []

    def take(arc: int, first: int, n: int, shard: int) -> int:
        n = min(n, room[shard])
        if n:
            segments.append((arc, first, first + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return n

    placed = [take(arc, 0, n, shard) for arc, (n, shard) in enumerate(zip(arcs, owners))]
    for arc, n in enumerate(arcs):
        at = arc
        while placed[arc] < n:
            at = (at + 1) % len(owners)
            placed[arc] += take(arc, placed[arc], n - placed[arc], owners[at])
    return segments


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, home_shard (the ring's owner), shard and slot of every document."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id").alias("key"),
    )
    rows = written(keyed.withColumn("bin", F.shiftrightunsigned("key", 64 - RING_BITS).cast("int")), "ring")

    nodes = virtual_nodes(shards)
    places, owners = [at for at, _ in nodes], [shard for _, shard in nodes]
    arc_of = [bisect.bisect_left(places, b) % len(places) for b in range(1 << RING_BITS)]
    bins = spark.createDataFrame(list(enumerate(arc_of)), "bin int, arc int")  # fixed by RING_BITS
    counts = rows.groupBy("bin").agg(F.count("*").alias("n")).join(bins, "bin")
    before = Window.partitionBy("arc").orderBy(F.expr(f"pmod(bin - {places[-1]} - 1, {1 << RING_BITS})"))
    counts = written(counts.select("bin", "arc", "n", (F.sum("n").over(before) - F.col("n")).alias("before")), "ring-counts")

    arcs = [0] * len(nodes)
    for r in counts.groupBy("arc").agg(F.sum("n").alias("n")).collect():  # one row for each virtual node
        arcs[r["arc"]] = r["n"]
    total = sum(arcs)
    bounds = [total // shards + (shard < total % shards) for shard in range(shards)]
    segments = spark.createDataFrame(bounded_segments(arcs, owners, bounds), "arc int, first long, last long, shard int, slot long")
    homes = spark.createDataFrame(list(enumerate(owners)), "arc int, home_shard int")

    within = Window.partitionBy("bin").orderBy("key", "doc_id", "size", "text_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(within) - 1).join(counts, "bin")
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).drop("n", "before")
    placed = ranked.join(F.broadcast(segments.join(F.broadcast(homes), "arc")), "arc")
    placed = placed.where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    return placed.select("doc_id", "size", "text_crc32", "home_shard", "shard", (F.col("slot") + F.col("rank") - F.col("first")).alias("slot"))
