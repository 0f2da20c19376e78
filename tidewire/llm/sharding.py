"""Shards of nearly equal bytes: minimax contiguous partition of ordered atomic groups (native).

Equal texts are one atomic group. The groups stand in an order: first those larger than a fair share, each in a shard
of its own (no cut can divide them), then the others by the hash of their text. Over these the smallest feasible
capacity is found by binary search, a greedy pass checks a capacity, and the shards are cut where the greedy pass at
that capacity cuts.

The driver never sees all groups. It first gets sums of groups by hash prefix (65,536 at most). Taking such a block
once as divisible and once as atomic gives a lower and an upper bound of the capacity, and so an interval that each cut
must lie in; only blocks in those intervals are split further, until every block in them is one group.

Nulls and edge cases: a null text has 0 bytes, crc32 0 and is in a group with the other null texts, apart from empty
ones; a null id is kept; rows that repeat are each put into a shard; an empty table gives no rows; fewer groups than
shards leave shards empty; other columns are ignored.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read_table, stage

SHARDS = 24
#: Hex digits of a group's key, and of the first blocks.
KEY, FIRST = 32, 4
#: Rows of one slot-numbering task, roughly.
SLOT_ROWS = 20_000


@dataclass(frozen=True)
class Node:
    """The groups whose key begins with ``key``; ``atomic`` if that is one group."""

    key: str
    size: int
    atomic: bool


def _greedy(nodes: list[Node], sums: list[int], capacity: int, shards: int, fluid: bool) -> list[float] | None:
    """Positions of the cuts at this capacity (bytes before them), or None if it needs more shards.

    fluid: a block that isn't atomic may be divided anywhere.
    """
    cuts, at = [], 0
    while at < sums[-1]:
        if len(cuts) == shards:
            return None
        i = bisect.bisect_right(sums, at + capacity) - 1
        to = sums[i]
        if fluid and i < len(nodes) and not nodes[i].atomic:
            to = at + capacity
        if to <= at:
            return None
        cuts.append(to)
        at = to
    return cuts


def _smallest(nodes: list[Node], sums: list[int], shards: int, fluid: bool) -> int:
    lo, hi = max(1, -(-sums[-1] // shards)), max(1, sums[-1])
    while lo < hi:
        mid = (lo + hi) // 2
        if _greedy(nodes, sums, mid, shards, fluid) is None:
            lo = mid + 1
        else:
            hi = mid
    return lo


def _sums(nodes: list[Node]) -> list[int]:
    out = [0]
    for x in nodes:
        out.append(out[-1] + x.size)
    return out


def _own(nodes: list[Node], shards: int) -> tuple[list[Node], list[Node], int]:
    """Atomic groups that are larger than a fair share of the rest get shards of their own."""
    alone: list[Node] = []
    rest = list(nodes)
    total = sum(x.size for x in nodes)
    for x in sorted((x for x in nodes if x.atomic), key=lambda x: (-x.size, x.key)):
        if shards <= 1 or x.size * shards <= total:
            break
        alone.append(x)
        total -= x.size
        shards -= 1
    taken = {x.key for x in alone}
    return alone, [x for x in rest if x.key not in taken], shards


def cut_groups(nodes_of, shards: int) -> tuple[list[str], list[str]]:
    """Keys of the groups with shards of their own, and the first keys of the second and later of the other shards.

    nodes_of(prefixes, digits) returns the nodes of that many digits below the prefixes (all, if None).
    """
    nodes = sorted(nodes_of(None, FIRST), key=lambda x: x.key)
    while True:
        alone, rest, left = _own(nodes, shards)
        sums = _sums(rest)
        if not sums[-1]:
            return [x.key for x in alone], []
        # below, no block is larger than a small part of a shard
        split = {x.key for x in rest if not x.atomic and x.size * left * 50 > sums[-1]}
        if not split:
            early = _greedy(rest, sums, _smallest(rest, sums, left, True), left + len(rest), False)
            late = _greedy(rest, sums, _smallest(rest, sums, left, False), left, True)
            for i, a in enumerate(early[:left]):
                first = bisect.bisect_right(sums, a) - 1
                last = bisect.bisect_left(sums, late[i] if i < len(late) else sums[-1])
                split |= {x.key for x in rest[first : last + 1] if not x.atomic}
        if not split:
            break
        finer = [x for n in {len(k) for k in split} for x in nodes_of(sorted(k for k in split if len(k) == n), min(KEY, n + FIRST))]
        nodes = sorted([x for x in nodes if x.key not in split] + finer, key=lambda x: x.key)
    capacity = _smallest(rest, sums, left, False)
    cuts = _greedy(rest, sums, capacity, left, False)
    return [x.key for x in alone], [rest[bisect.bisect_left(sums, c)].key for c in cuts[:-1]]


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard), one for each row of docs."""
    text = F.col("text")
    bytes_ = F.coalesce(text, F.lit("")).cast("binary")
    slim = stage(
        docs.select(
            "doc_id",
            (F.octet_length(bytes_) + F.lit(8)).cast("bigint").alias("size"),
            F.crc32(bytes_).alias("text_crc32"),
            F.coalesce(F.substring(F.sha2(text, 256), 1, KEY), F.lit("0" * KEY)).alias("key"),
        ),
        "shard-rows",
    )
    groups = stage(slim.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "shard-groups")
    total = groups.agg(F.sum("n")).first()[0] or 0

    def nodes_of(prefixes: list[str] | None, digits: int) -> list[Node]:
        at = groups if prefixes is None else groups.filter(F.substring("key", 1, len(prefixes[0])).isin(prefixes))
        rows = at.groupBy(F.substring("key", 1, digits).alias("k")).agg(F.sum("size").alias("s"), F.count("*").alias("g"), F.min("key").alias("only")).collect()
        return [Node(r["only"] if r["g"] == 1 else r["k"], int(r["s"]), r["g"] == 1) for r in rows]

    alone, firsts = cut_groups(nodes_of, shards)
    key = F.col("key")
    place = F.lit(len(alone))
    for k in firsts:
        place = place + (key >= F.lit(k)).cast("int")
    for i, k in reversed(list(enumerate(alone))):
        place = F.when(key == F.lit(k), F.lit(i)).otherwise(place)
    parts = max(1, -(-total // (shards * SLOT_ROWS)))
    slim = slim.withColumn("shard", place).withColumn("part", F.pmod(F.xxhash64("doc_id", "key"), F.lit(parts)))
    counts = slim.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select("shard", "part", F.coalesce(before, F.lit(0)).alias("before"))
    nth = F.row_number().over(W.partitionBy("shard", "part").orderBy("doc_id", "key"))
    out = slim.withColumn("nth", nth - 1).join(counts, ["shard", "part"])
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("nth")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read_table(spark, sf_dir, "documents"))
