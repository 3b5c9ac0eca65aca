"""Near duplicates by b-bit minwise hashing, every link confirmed on whole shingle sets.

1. A text becomes the set of its word shingles (64-bit hashes); equal sets are one from here on. Of
   ``HASHES`` minima per set, groups of ``ROWS`` whole minima make ``BANDS`` band keys, and the lowest
   ``BITS`` bits of each are packed into a signature. Minima are not kept.
2. Band keys are counted; sets that share none with another set are done.
3. Sets lie next to each other by the set they share most band keys with (the smallest of equals), cut into chunks of
   bounded size. In a chunk, pairs are estimated by the bit counts of their signatures, corrected for bits that agree
   by chance, and those not ruled out are compared on their whole sets. These links make components.
4. Completion: within every band key that still holds several components, pairs of different components are estimated. A
   key with few pairs left sends them to be compared by a join; one with many gets the whole sets of its members instead
   and compares on the spot. So what is sent grows with the sets, not with their pairs, and every pair that
   the estimate does not rule out is tested. A key of many or large sets is dealt as a grid of blocks.

A pair at the threshold of 0.8 shares no band key with probability (1 - 0.8^5)^32 = 3e-6, and its estimate
falls below the cut, ``SIGMAS`` standard deviations under the threshold, with probability 3e-7.
The driver sees counts only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from talkloom.llm.cells import CELL, Overlap, by_cell
from talkloom.llm.components import connected
from talkloom.llm.jaccard_join import fingerprint
from talkloom.llm.signature_tree import UnionFind, similar
from talkloom.llm.textbytes import Words, mix, shingle_sets, slices
from talkloom.llm.work import Work, small

SHINGLE = 4
ROWS, BANDS, BITS = 5, 32, 2
HASHES = ROWS * BANDS
SIGMAS = 5
#: Sets of a chunk: bytes of their tokens, and their number.
CHUNK_BYTES, CHUNK_SETS = 2 << 20, 1 << 11
#: Sets of a key that are compared in one piece; larger keys are dealt as a grid.
BLOCK_SETS = 1 << 11
#: A key with more open pairs per set than this gets the sets themselves.
PAIRS_PER_SET = 4
PIECE_ROWS = 1 << 18
PIECE_BYTES = 16 << 20
#: Pairs compared at once.
PAIRS = 1 << 12
U = np.uint64
_NUMBERS = mix(np.arange(1, 2 * HASHES + 1, dtype=U))
_SALT, _TIMES = _NUMBERS[:HASHES], _NUMBERS[HASHES:] | U(1)
_EACH = 64 // BITS
_ODD = U(sum(1 << i for i in range(0, 64, BITS)))


def minima(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(HASHES, sets): the least hash of every set under each of the hash functions. No set is empty."""
    out = np.empty((HASHES, len(starts)), U)
    for i in range(HASHES):
        out[i] = np.minimum.reduceat((tokens ^ _SALT[i]) * _TIMES[i], starts)
    return out


def signatures(least: np.ndarray) -> np.ndarray:
    """(sets, words): the lowest bits of the minima, packed."""
    low = (mix(least) & U((1 << BITS) - 1)).reshape(-1, _EACH, least.shape[1])
    shift = (np.arange(_EACH, dtype=U) * U(BITS))[None, :, None]
    return np.bitwise_or.reduce(low << shift, axis=1).T


def band_keys(least: np.ndarray) -> np.ndarray:
    """(sets, BANDS): a hash of each group of whole minima."""
    bands = least.reshape(BANDS, ROWS, -1)
    key = np.repeat(mix(np.arange(1, BANDS + 1, dtype=U))[:, None], least.shape[1], 1)
    for r in range(ROWS):
        key = mix(key ^ bands[:, r]) + bands[:, r]
    return mix(key).T.astype(np.int64)


def matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the packed values agree, for arrays of signatures that broadcast against each other."""
    unlike = a ^ b
    any_bit = unlike.copy()
    for i in range(1, BITS):
        any_bit |= unlike >> U(i)
    return HASHES - np.bitwise_count(any_bit & _ODD).sum(-1, dtype=np.int64)


def estimate(agreed):
    """Jaccard similarity from agreeing values: unlike minima agree by chance in one of 2^BITS cases."""
    chance = 0.5**BITS
    return (agreed / HASHES - chance) / (1 - chance)


def least_matches(num: int, den: int) -> int:
    """Fewer agreeing values than this rule a pair out."""
    chance = 0.5**BITS
    p = num / den + (1 - num / den) * chance
    return int(np.floor(HASHES * p - SIGMAS * np.sqrt(HASHES * p * (1 - p))))


def described(docs: DataFrame) -> DataFrame:
    """(id, text) to id, n, fp, sig, keys. Without words n = 0 and the rest is null."""
    id_type = docs.schema["id"].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in slices(batch):
                sets = list(shingle_sets(Words(data, off), SHINGLE))
                n = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(n)
                fp = np.zeros(len(sets), np.int64)
                sig: list = [None] * len(sets)
                keys: list = [None] * len(sets)
                if len(some):
                    full = [sets[i] for i in some]
                    least = minima(np.concatenate(full), np.cumsum(np.append(0, n[some][:-1])))
                    fp[some] = [fingerprint(s) for s in full]
                    for i, s, k in zip(some.tolist(), signatures(least), band_keys(least)):
                        sig[i], keys[i] = s.tobytes(), k
                columns = [rows.column("id"), pa.array(n), pa.array(fp, mask=n == 0), pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "fp", "sig", "keys"])

    return docs.mapInArrow(describe, f"id {id_type}, n long, fp long, sig binary, keys array<long>")


def whole_sets(docs: DataFrame) -> DataFrame:
    """(text) to fp, tokens."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, off in slices(batch):
                own = [s for s in shingle_sets(Words(data, off), SHINGLE) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([fingerprint(s) for s in own], pa.int64()), pa.array([s.tobytes() for s in own], pa.binary())], ["fp", "tokens"])

    return docs.select("text").mapInArrow(sets, "fp long, tokens binary")


def open_ends(label: np.ndarray, n: np.ndarray, sig: np.ndarray, num: int, den: int, block: np.ndarray | None = None, now=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, of different labels that sizes and estimates do not rule out, in batches of at most ``PAIRS``.

    ``block``: only pairs from different blocks. ``now`` gives newer labels, asked for again every few rows.
    """
    least = least_matches(num, den)
    for low in range(0, len(n), 64):
        label = label if now is None else now()
        a, b = np.arange(low, min(low + 64, len(n))), np.arange(low, len(n))
        may = (label[a][:, None] != label[b]) & (a[:, None] < b) & (den * np.minimum(n[a][:, None], n[b]) >= num * np.maximum(n[a][:, None], n[b]))
        if block is not None:
            may &= block[a][:, None] != block[b]
        i, j = np.nonzero(may)
        for at in range(0, len(i), PAIRS):
            x, y = a[i[at : at + PAIRS]], b[j[at : at + PAIRS]]
            near = matches(sig[x], sig[y]) >= least
            if near.any():
                yield x[near], y[near]


def link_sets(fps: np.ndarray, own: list[np.ndarray], sig: np.ndarray, num: int, den: int, label: np.ndarray | None = None, block: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join all similar sets (of different labels and blocks, where these are given) into components."""
    found, edges = UnionFind(len(own)), []
    overlap = Overlap(own)

    def join(x: np.ndarray, y: np.ndarray) -> None:
        for i, j in zip(x.tolist(), y.tolist()):
            if found.root(i) != found.root(j):
                found.join(i, j)
                edges.append((int(fps[i]), int(fps[j])))

    if label is not None:
        first: dict[int, int] = {}
        for i, name in enumerate(label.tolist()):
            found.join(first.setdefault(name, i), i)
    else:  # the head and the one before first: most of a group becomes one component at once
        for low in range(1, len(own), PAIRS):
            i = np.arange(low, min(low + PAIRS, len(own)))
            for j in (np.zeros_like(i), i - 1):
                alike = overlap.similar(j, i, num, den)
                join(j[alike], i[alike])
    for x, y in open_ends(found.roots(), overlap.n, sig, num, den, block, found.roots):
        alike = overlap.similar(x, y, num, den)
        join(x[alike], y[alike])
    return edges


def chunk_links(sets: DataFrame, chunks: int, num: int, den: int) -> DataFrame:
    """(a, b): links between sets (fp, rep, sig, tokens) of one ``rep`` and chunk."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple[int, bytes, bytes]] = []
        rep, held = None, 0

        def edges() -> pa.RecordBatch:
            fps = np.array([r[0] for r in run], np.int64)
            sig = np.frombuffer(b"".join(r[1] for r in run), U).reshape(len(run), -1)
            ends = link_sets(fps, [np.frombuffer(r[2], U) for r in run], sig, num, den)
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in ends], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            for own_rep, fp, sig, tokens in zip(*(batch.column(c).to_pylist() for c in ("rep", "fp", "sig", "tokens"))):
                if run and (own_rep != rep or held + len(tokens) > CHUNK_BYTES or len(run) >= CHUNK_SETS):
                    if len(run) > 1:
                        yield edges()
                    run, held = [], 0
                if run and run[-1][0] == fp:
                    continue  # a repeated id brought the same set twice
                rep = own_rep
                run.append((fp, sig, tokens))
                held += len(tokens)
        if len(run) > 1:
            yield edges()

    dealt = sets.select("rep", "fp", "sig", "tokens").repartitionByRange(chunks, "rep", "fp").sortWithinPartitions("rep", "fp")
    return dealt.mapInArrow(link, "a long, b long")


def cells_of(members: DataFrame, live: DataFrame, work: Work) -> DataFrame:
    """(key, i, j, block, fp, label, n, sig): the sets of band keys that hold several labels, large ones as a grid of blocks."""
    rows = work.keep(members.select("key", "fp").join(live.select("fp", "label", "n"), "fp"), "labelled")
    keys = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("held"), F.sum("n").alias("tokens")).where("low < high")
    blocks = F.expr(f"cast(ceil(greatest(held / {BLOCK_SETS}, 8 * tokens / {CHUNK_BYTES})) as int)")
    keys = work.keep(keys.select("key", blocks.alias("blocks")), "keys")
    rows = rows.select("key", "fp").join(keys, "key").join(live, "fp").withColumn("block", F.expr("cast(pmod(xxhash64(fp), blocks) as int)"))
    cells = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cells = cells.select("key", F.expr("least(block, other)").alias("i"), F.expr("greatest(block, other)").alias("j"), "block", "fp", "label", "n", "sig")
    return work.keep(cells, "cells")


def estimated(cells: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, key, i, j): pairs left open in cells of few, and the cells of many (a, b null)."""

    def meet(cell: tuple, columns: list) -> pa.RecordBatch:
        fps, label, n, block = (np.array(columns[k], np.int64) for k in (0, 1, 2, 4))
        sig = np.frombuffer(b"".join(columns[3]), U).reshape(len(fps), -1)
        ends: list[tuple[int, int]] = []
        many = False
        for x, y in open_ends(label, n, sig, num, den, block if cell[1] != cell[2] else None):
            ends += zip(np.minimum(fps[x], fps[y]).tolist(), np.maximum(fps[x], fps[y]).tolist())
            if len(ends) > PAIRS_PER_SET * len(fps):
                many = True
                break
        rows = [(None, None, *cell)] if many else [(*e, None, None, None) for e in ends]
        kinds = [pa.int64()] * 3 + [pa.int32()] * 2
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["a", "b", *CELL])

    pieces = -(-cells.count() // PIECE_ROWS)
    return by_cell(cells, pieces, ["fp", "label", "n", "sig", "block"], meet, "a long, b long, key long, i int, j int")


def linked_on_the_spot(cells: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): links between the sets (fp, label, sig, block, tokens) of every cell."""

    def link(cell: tuple, columns: list) -> pa.RecordBatch:
        fps, label, block = (np.array(columns[k], np.int64) for k in (0, 1, 3))
        sig = np.frombuffer(b"".join(columns[2]), U).reshape(len(fps), -1)
        ends = link_sets(fps, [np.frombuffer(t, U) for t in columns[4]], sig, num, den, label, block if cell[1] != cell[2] else None)
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in ends], pa.int64()) for k in (0, 1)], ["a", "b"])

    size = cells.agg(F.sum(F.length("tokens"))).first()[0] or 0
    return by_cell(cells, -(-size // PIECE_BYTES), ["fp", "label", "sig", "block", "tokens"], link, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that are similar by their whole sets (fp, tokens)."""

    @F.pandas_udf("boolean")
    def alike(a, b):
        import pandas as pd

        return pd.Series([similar(np.frombuffer(x, U), np.frombuffer(y, U), num, den) for x, y in zip(a, b)], dtype=bool)

    left, right = (sets.select(F.col("fp").alias(x), F.col("tokens").alias(f"{x}_tokens")) for x in ("a", "b"))
    return pairs.join(left, "a").join(right, "b").where(alike("a_tokens", "b_tokens")).select("a", "b").distinct()


def linked(slim: DataFrame, sets: DataFrame, work: Work, num: int, den: int) -> DataFrame | None:
    """(v, root) over all links between the sets (fp, first, n, sig, keys) of ``slim`` (id, text); None where there are none."""
    bands = sets.select("fp", F.explode("keys").alias("key"))
    open_keys = bands.groupBy("key").agg(F.min("fp").alias("rep"), F.max("fp").alias("top")).where("rep < top").select("key", "rep")
    members = work.keep(bands.join(work.keep(open_keys, "open"), "key"), "members")
    reps = members.groupBy("fp").agg(F.mode("rep", True).alias("rep"))
    live = work.keep(sets.select("fp", "first", "n", "sig").join(reps, "fp"), "live")
    wanted = small(live.select(F.col("first").alias("wanted")).distinct(), 16)
    tokens = whole_sets(slim.join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi"))
    whole = work.keep(tokens.join(small(live.select("fp", "rep", "sig"), 80), "fp"), "whole")
    size = whole.agg(F.sum(F.length("tokens"))).first()[0] or 0
    if not size:
        return None
    chunks = max(work.spark.sparkContext.defaultParallelism, -(-size // (4 * CHUNK_BYTES)))
    edges = work.keep(chunk_links(whole, chunks, num, den), "links")
    roots = connected(edges, work)
    label = F.coalesce("root", "fp").alias("label")
    labelled = work.keep(live.join(roots.withColumnRenamed("v", "fp"), "fp", "left").select("fp", "n", "sig", label), "labels")
    cells = cells_of(members, labelled, work)
    found = work.keep(estimated(cells, num, den), "found")
    tokens = whole.select("fp", "tokens")
    few = confirmed(found.where("a is not null").select("a", "b").distinct(), tokens, num, den)
    crowded = small(found.where("a is null").select(*CELL), 16)
    many = cells.join(crowded, CELL, "left_semi").join(tokens, "fp")
    more = work.keep(few, "few").unionByName(work.keep(linked_on_the_spot(work.keep(many, "many"), num, den), "spot"))
    return roots if more.isEmpty() else connected(edges.unionByName(more), work)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable by links), kept (whether that is its own).

    Documents link when 100 * intersection >= percent * union of their sets of four-word shingles. One without words, null
    or empty, has an empty set and is its own component. Null ids are larger than all others: such a row is kept
    only where no row of its component has an id. Rows that repeat an id are each kept or not as that id
    is. An empty table gives no rows. Sets are told apart by 64 bits.
    """
    work = Work(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    rows = work.keep(described(slim), "rows")
    full = rows.where("fp is not null")
    same = [F.first(c).alias(c) for c in ("n", "sig", "keys")]
    sets = work.keep(full.groupBy("fp").agg(F.min("id").alias("first"), *same), "sets")
    roots = linked(slim, sets, work, percent, 100)
    named = sets.select("fp", "first")
    if roots is not None:
        named = named.join(roots.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        lowest = named.groupBy("root").agg(F.min("first").alias("component"))
        named = named.select("fp", "root").join(lowest, "root").select("fp", "component")
    else:
        named = named.withColumnRenamed("first", "component")
    named = work.keep(named, "names")
    id_ = F.col("id")
    done = full.select("id", "n", "fp").join(named, "fp").select("id", "n", "component")
    empty = rows.where("fp is null").select("id", "n", id_.alias("component"))
    out = done.unionByName(empty)
    return out.select(id_.alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), id_.eqNullSafe(F.col("component")).alias("kept"))
