"""Sharding by minimax contiguous partition.

Groups (rows with equal text) are atomic and ordered by the hash of their text.
The smallest feasible shard capacity is found by binary search with a greedy
check over the ordered group sizes, and the order is cut there. The order is
known to the driver only as a fixed number of hash ranges with their sizes;
ranges in which a cut may fall are split further until the answer is exact, so
what the driver sees does not grow with the table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vetrow.llm.common import save, save_counted, tasks_for

RANGE_BITS = 16
SLOT_ROWS = 20_000
KEY_BITS = 64


@dataclass
class Ranges:
    """Ordered hash ranges: ``low`` (first hash), ``shift`` (free low bits), sizes, largest group, groups."""

    low: np.ndarray
    shift: np.ndarray
    size: np.ndarray
    largest: np.ndarray
    groups: np.ndarray

    @property
    def prefix(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.size)])

    @property
    def whole(self) -> np.ndarray:
        """Ranges that hold one group (or one hash) and cannot be cut."""
        return (self.groups == 1) | (self.shift == 0)


def greedy_cuts(prefix: np.ndarray, capacity: int, shards: int) -> np.ndarray:
    """End index of each shard when every shard takes all it can hold."""
    cuts, at = [], 0
    for _ in range(shards):
        at = max(at, int(np.searchsorted(prefix, prefix[at] + capacity, "right")) - 1)
        cuts.append(at)
    return np.array(cuts)


def divisible_ends(r: Ranges, capacity: int, shards: int) -> np.ndarray:
    """End positions (in bytes) of the greedy check when ranges of several groups may be cut anywhere."""
    prefix, whole, at, ends = r.prefix, r.whole, 0, []
    for _ in range(shards):
        to = min(at + capacity, int(prefix[-1]))
        j = int(np.searchsorted(prefix, to, "right")) - 1
        if j < len(whole) and whole[j]:
            to = max(at, int(prefix[j]))
        ends.append(to)
        at = to
    return np.array(ends)


def smallest(low: int, high: int, feasible) -> int:
    """Binary search of the smallest feasible capacity in [low, high]; high is feasible."""
    while low < high:
        mid = (low + high) // 2
        if feasible(mid):
            high = mid
        else:
            low = mid + 1
    return low


def capacity_bounds(r: Ranges, shards: int) -> tuple[int, int]:
    """Smallest capacity if ranges were divisible (a lower bound) and if they were atomic (reached for certain)."""
    total, prefix = int(r.size.sum()), r.prefix
    least = max(-(-total // shards), int(r.largest.max()))
    low = smallest(least, total, lambda c: divisible_ends(r, c, shards)[-1] >= total)
    high = smallest(max(low, int(r.size.max())), total, lambda c: greedy_cuts(prefix, c, shards)[-1] == len(r.size))
    return low, high


def to_split(r: Ranges, low: int, high: int, shards: int) -> np.ndarray:
    """Ranges of several groups in which a cut may fall for a capacity in [low, high]."""
    prefix, open_ = r.prefix, ~r.whole
    stuck = open_ & (r.size > low)
    if stuck.any():
        return np.flatnonzero(stuck)
    first = prefix[greedy_cuts(prefix, low, shards)]
    last = divisible_ends(r, high, shards)
    hit = np.zeros(len(r.size), bool)
    for a, b in zip(first, last):
        hit |= (prefix[1:] >= a) & (prefix[:-1] <= b)
    return np.flatnonzero(hit & open_)


def fair_share(sizes: np.ndarray, shards: int) -> float:
    """What a shard should hold when groups above an even share have shards of their own."""
    total, alone = float(sizes.sum()), 0
    for size in np.sort(sizes)[::-1][: shards - 1]:
        if size <= total / (shards - alone):
            break
        total -= size
        alone += 1
    return total / (shards - alone)


def balanced_cuts(prefix: np.ndarray, capacity: int, shards: int) -> np.ndarray:
    """Cuts within ``capacity`` that keep what is left evenly spread: as near the fair share of
    the remaining shards as the capacity of this and of all later shards allows."""
    n, sizes = len(prefix) - 1, np.diff(prefix)
    earliest = [n]
    for _ in range(shards):
        earliest.append(int(np.searchsorted(prefix, prefix[earliest[-1]] - capacity, "left")))
    earliest = earliest[::-1]
    cuts, at = [], 0
    for k in range(1, shards + 1):
        target = prefix[at] + fair_share(sizes[at:], shards - k + 1)
        j = min(int(np.searchsorted(prefix, target, "left")), n)
        if j > at + 1 and target - prefix[j - 1] <= prefix[j] - target:
            j -= 1
        latest = int(np.searchsorted(prefix, prefix[at] + capacity, "right")) - 1
        at = max(at, min(max(j, at + 1, earliest[k]), latest, n))
        cuts.append(at)
    cuts[-1] = n
    return np.array(cuts)


def _ranges(groups: DataFrame, shift: int, parents: DataFrame | None = None) -> Ranges:
    """Sizes by hash range; with ``parents`` (low, parent_shift), only inside those ranges."""
    source = groups
    if parents is not None:
        parent_shift = parents.first()["parent_shift"]
        source = groups.join(F.broadcast(parents.select(F.col("low").alias("_low"))),
                             F.shiftleft(F.shiftright("key", parent_shift), parent_shift) == F.col("_low"), "left_semi")
    rows = source.groupBy(F.shiftright("key", shift).alias("bucket")).agg(
        F.sum("weight").alias("size"), F.max("weight").alias("largest"), F.count(F.lit(1)).alias("groups")).collect()
    rows.sort(key=lambda x: x["bucket"])
    return Ranges(
        np.array([x["bucket"] << shift for x in rows], np.int64), np.full(len(rows), shift),
        np.array([x["size"] for x in rows], np.int64), np.array([x["largest"] for x in rows], np.int64),
        np.array([x["groups"] for x in rows], np.int64))


def minimax_cuts(groups: DataFrame, shards: int, range_bits: int = RANGE_BITS) -> tuple[list[int], int]:
    """First hash of every shard but the first (fewer if shards stay empty), and the smallest capacity.

    ``groups`` has ``key`` (signed 64-bit hash, the order) and ``weight``."""
    spark = groups.sparkSession
    r = _ranges(groups, KEY_BITS - range_bits)
    if not len(r.size):
        return [], 0
    while True:
        low, high = capacity_bounds(r, shards)
        if low == high:
            break
        index = to_split(r, low, high, shards)
        if not len(index):
            high = low = smallest(int(r.size.max()), int(r.size.sum()),
                                  lambda c: greedy_cuts(r.prefix, c, shards)[-1] == len(r.size))
            break
        shift = int(r.shift[index].max())
        index = index[r.shift[index] == shift][: 1 << (range_bits - 4)]
        bits = max(1, min(shift, range_bits - int(np.ceil(np.log2(len(index) + 1)))))
        parents = spark.createDataFrame([(int(r.low[i]), shift) for i in index], "low long, parent_shift int")
        finer = _ranges(groups, shift - bits, parents)
        keep = np.ones(len(r.size), bool)
        keep[index] = False
        joined = [np.concatenate([getattr(r, f)[keep], getattr(finer, f)]) for f in ("low", "shift", "size", "largest", "groups")]
        order = np.argsort(joined[0], kind="stable")
        r = Ranges(*(x[order] for x in joined))
    cuts = balanced_cuts(r.prefix, high, shards)
    return [int(r.low[c]) for c in cuts[:-1] if c < len(r.low)], high


def shard_documents(docs: DataFrame, shards: int = 16, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal rows to ``shards`` shards of near-equal bytes, rows of equal text together.

    Returns ``doc_id, size, text_crc32, key, shard, slot, capacity``: ``size`` is the
    UTF-8 length plus 1 (a null text counts as empty and belongs to the group of
    empty texts), ``key`` the 64-bit hash of the text that orders the groups
    (texts whose hashes collide stay together), ``slot`` a gapless number
    inside the shard. No shard exceeds ``capacity``, the least possible largest
    shard; a group larger than an even share therefore gets a shard that large.
    Repeated ids are separate rows with slots of their own, an empty table
    gives an empty result, other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows, count = save_counted(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key")), "shard-rows")
    groups = save(rows.groupBy("key").agg(F.sum("size").alias("weight")), "shard-groups")
    cuts, capacity = minimax_cuts(groups, shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("key") >= F.lit(cut)).cast("int")
    salts = tasks_for(count, SLOT_ROWS, 64)
    placed = rows.withColumn("shard", shard.cast("int")).withColumn(
        "salt", F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(17)), F.lit(salts)))
    before = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "salt").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "salt").orderBy("doc_id", "key")
    return placed.join(offsets, ["shard", "salt"]).select(
        "doc_id", "size", "text_crc32", "key", "shard",
        (F.col("offset") + F.row_number().over(inside) - 1).cast("long").alias("slot"),
        F.lit(capacity).cast("long").alias("capacity"))
