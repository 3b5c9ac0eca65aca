"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``nodes`` places on the ring; a key belongs to the first node clockwise
of its own place. A shard takes keys up to its capacity, keys that find it full go on
clockwise to the next node whose shard has room. With slack 0 capacities are the even
counts themselves, so counts differ by one at most; with slack e they are (1 + e) times
the mean, which moves fewer keys when a shard is added.

Keys are ranked inside their arc, and the overflow is worked out on arc counts alone
(shards x nodes numbers), so the driver never sees a key. A rank then names the shard and
the place in it at once. Hot keys (one id in a third of the rows) are ranked in parts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from talkloom.llm.numbering import ranked
from talkloom.llm.work import Work

NODES = 64
ARC, PLACE, ROW, RANK = "__talkloom_arc", "__talkloom_place", "__talkloom_row", "__talkloom_rank"


def ring(shards: int, nodes: int) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, clockwise; places are signed 64-bit."""
    return sorted((xxhash.xxh64_intdigest(f"{s}/{v}") - (1 << 63), s) for s in range(shards) for v in range(nodes))


def capacities(total: int, shards: int, slack: float) -> list[int]:
    if slack > 0:
        return [math.ceil((1 + slack) * total / shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def overflow(counts: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot): arc counts dealt clockwise under the capacities."""
    room, used, out = list(room), [0] * len(room), []
    waiting = [(arc, 0, n, arc) for arc, n in enumerate(counts) if n]
    while waiting:
        on = []
        for arc, lo, hi, node in waiting:
            shard = owners[node]
            taken = min(hi - lo, room[shard])
            if taken:
                out.append((arc, lo, lo + taken, shard, used[shard]))
                room[shard] -= taken
                used[shard] += taken
            if lo + taken < hi:
                on.append((arc, lo + taken, hi, (node + 1) % len(owners)))
        waiting = on
    return out


def shard_rows(docs: DataFrame, shards: int, nodes: int = NODES, slack: float = 0.0, id_col: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """id, ``carry`` columns, shard, slot (gapless from 0 in each shard), one row per row.

    Null ids share one key; repeated rows are separate rows with the same key. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    work = Work(spark)
    places = ring(shards, nodes)
    ends = [p for p, _ in places]
    place = F.xxhash64(F.lit(0), F.col(id_col))
    rows = docs.select(id_col, *carry, place.alias(PLACE), F.monotonically_increasing_id().alias(ROW))
    rows = rows.withColumn(ARC, arc_of(ends)(PLACE))
    rows = work.keep(rows, "keys")
    numbered, counts = ranked(rows, ARC, ROW, [PLACE], RANK)
    per_arc = [0] * len(places)
    for r in counts.collect():  # shards x nodes rows at most
        per_arc[r[ARC]] = r["n"]
    parcels = overflow(per_arc, [s for _, s in places], capacities(sum(per_arc), shards, slack))
    plan = spark.createDataFrame(parcels, f"{ARC} int, lo long, hi long, shard int, base long")
    lo, hi = F.col("lo"), F.col("hi")
    placed = numbered.join(F.broadcast(plan), [ARC])  # arcs and their splits only
    return placed.where((F.col(RANK) >= lo) & (F.col(RANK) < hi)).select(id_col, *carry, "shard", (F.col("base") + F.col(RANK) - lo).alias("slot"))


def arc_of(ends: list[int]):
    """The arc of a place: the first node at or after it, around the ring."""
    sorted_ends = np.array(ends, np.int64)

    @F.pandas_udf("int")
    def arc(place: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(sorted_ends, place.to_numpy(), "left") % len(sorted_ends)).astype(np.int32))

    return arc
