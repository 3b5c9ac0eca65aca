"""Exact join of texts by Jaccard similarity of five-word shingles, as components.

1. Every text becomes a set of 64-bit shingle hashes; equal sets are one from here on.
2. In hash order, two sets similar by 3/4 share at least l(n) of their first n/4 + l(n)
   tokens (prefix filter). Tokens go to buckets, packed, and each set learns how many of its
   prefix tokens another set has; with fewer than the least l it has no link at all.
3. The remaining sets are sorted by several min-hash orders, cut into chunks of bounded
   size, and each chunk is joined with itself by a signature tree. These
   links make components.
4. Completion: prefix tokens are counted again, now between different components. Components
   that cannot have a link to another are done; so are those that share less than three quarters of
   their whole sets with others. For the rest, in an order of tokens
   that puts rare ones first, sets meet by prefix token, and a signature tree per token and the places
   of the token rule out pairs. At most one pair per set leaves a token and is compared exactly; a token
   with more gets the whole sets and compares them where they meet, in a grid of blocks
   if it is large. So no link is lost, whatever step 3 missed.

Nothing is emitted per pair inside a group, and the driver sees counts only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from talkloom.llm.cells import Overlap, by_cell
from talkloom.llm.components import connected
from talkloom.llm.signature_tree import Tree, UnionFind, bitmaps, link, similar
from talkloom.llm.textbytes import Words, mix, shingle_sets, slices
from talkloom.llm.work import Work, small

ORDERS = 3
#: Tokens of a counting bucket, and bytes of the sets of one chunk.
BUCKET_TOKENS = 1 << 18
CHUNK_BYTES = 4 << 20
SKETCH = 1 << 16
PAIR_BITS = 2048
#: Sets of a token that are compared in one piece; more form a grid of blocks.
HOT_SETS = 1 << 11
#: A token with more open pairs per set than this gets the whole sets.
PAIRS_PER_SET = 2
PIECE_ROWS = 1 << 17
ROWS_PER_BATCH = 1 << 13
U = np.uint64


def need(n):
    """Prefix tokens that a set of n shares with any similar set of n or more."""
    return -(-n // 12)


def prefix_length(n):
    return n - -(-3 * n // 4) + need(n)


def least(n: str) -> str:
    """SQL: ``need`` of the smallest size similar to n."""
    return f"ceil(ceil({n} * 0.75) / 12)"


def fingerprint(tokens: np.ndarray) -> int:
    """One odd signed 64-bit number per set."""
    total = int(mix(tokens + U(0x2545F4914F6CDD1D)).sum(dtype=U)) + len(tokens) * 0x9E3779B97F4A7C15
    return (int(mix(np.array([total & (1 << 64) - 1], U))[0]) | 1) - (1 << 63)


def prefixes(docs: DataFrame) -> DataFrame:
    """(id, text) to id, n, fp, prefix. No words: n = 0, the rest null."""
    id_type = docs.schema["id"].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in slices(batch):
                n, fp, prefix = [], [], []
                for tokens in shingle_sets(Words(data, off)):
                    n.append(len(tokens))
                    fp.append(fingerprint(tokens) if len(tokens) else None)
                    prefix.append(tokens[: prefix_length(len(tokens))].tobytes() if len(tokens) else None)
                yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(n, pa.int64()), pa.array(fp, pa.int64()), pa.array(prefix, pa.binary())], ["id", "n", "fp", "prefix"])

    return docs.mapInArrow(sets, f"id {id_type}, n long, fp long, prefix binary")


def full_sets(docs: DataFrame) -> DataFrame:
    """(text) to fp, n, tokens and, per order, the three smallest hashes of the set."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = [mix(np.array([r + 1], U))[0] for r in range(ORDERS)]
        for batch in batches:
            for _, data, off in slices(batch):
                columns: list[list] = [[] for _ in range(3 + 3 * ORDERS)]
                for tokens in shingle_sets(Words(data, off)):
                    if not len(tokens):
                        continue
                    row = [fingerprint(tokens), len(tokens), tokens.tobytes()]
                    for salt in salts:
                        h = mix(tokens ^ salt)
                        low = np.sort(np.partition(h, 2)[:3] if len(h) > 3 else h).astype(np.int64).tolist()
                        row += (low * 3)[:3]
                    for column, value in zip(columns, row):
                        column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.binary()] + [pa.int64()] * (3 * ORDERS)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    names = ["fp", "n", "tokens"] + [f"k{r}{i}" for r in range(ORDERS) for i in range(3)]
    return docs.select("text").mapInArrow(sets, "fp long, n long, tokens binary, " + ", ".join(f"{x} long" for x in names[3:]))


def shared_counts(sets: DataFrame, buckets: int) -> DataFrame:
    """(label, tokens) to (label, shared): tokens of a label that some other label has too.

    Each batch sends a token once per label, or, if it saw it under several labels, counts it on the spot
    and sends one mark that the token is shared.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column("tokens").to_pylist()
            if not blobs:
                continue
            token = np.frombuffer(b"".join(blobs), U)
            label = np.repeat(batch.column("label").to_numpy(), [len(b) // 8 for b in blobs])
            order = np.lexsort((label, token))
            token, label = token[order], label[order]
            fresh = np.ones(len(token), bool)
            fresh[1:] = (token[1:] != token[:-1]) | (label[1:] != label[:-1])
            token, label = token[fresh], label[fresh]
            head = np.ones(len(token), bool)
            head[1:] = token[1:] != token[:-1]
            size = np.diff(np.append(np.flatnonzero(head), len(token)))
            many = np.repeat(size > 1, size)
            done, times = np.unique(label[many], return_counts=True)
            send = ~many | head
            label = np.where(many, 0, label)[send]  # 0 marks a token as shared; labels are odd
            token = token[send]
            bucket = (token % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            token, label, bucket = token[order], label[order], bucket[order]
            at = np.searchsorted(bucket, np.arange(buckets + 1))
            share = np.searchsorted(np.arange(len(done)) * buckets // max(1, len(done)), np.arange(buckets + 1))
            rows: list[list] = [[], [], [], [], []]
            for b in range(buckets):
                x, y = slice(at[b], at[b + 1]), slice(share[b], share[b + 1])
                if at[b + 1] > at[b] or share[b + 1] > share[b]:
                    for column, value in zip(rows, (b, token[x].tobytes(), label[x].tobytes(), done[y].tobytes(), times[y].astype(np.int64).tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *(pa.array(c, pa.binary()) for c in rows[1:])], ["bucket", "token", "label", "done", "times"])

    def count(table: pa.Table) -> pa.Table:
        def all_of(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

        token, label = all_of("token", U), all_of("label", np.int64)
        order = np.lexsort((label, token))
        token, label = token[order], label[order]
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (label[1:] != label[:-1])
        token, label = token[fresh], label[fresh]
        head = np.flatnonzero(np.append(True, token[1:] != token[:-1])[: len(token)])
        size = np.diff(np.append(head, len(token)))
        marked = np.zeros(len(size), bool)
        if len(head):
            marked = np.logical_or.reduceat(label == 0, head)
        seen = np.repeat((size > 1) | marked, size) & (label != 0)
        found, times = np.unique(label[seen], return_counts=True)
        label, shared = summed(np.concatenate([found, all_of("done", np.int64)]), np.concatenate([times.astype(np.int64), all_of("times", np.int64)]))
        part = (mix(label.astype(U)) % U(buckets)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, label, shared = part[order], label[order], shared[order]
        at = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)]).tolist()
        cuts = list(zip(at, [*at[1:], len(part)]))
        blobs = [pa.array([x[a:b].tobytes() for a, b in cuts], pa.binary()) for x in (label, shared)]
        return pa.table({"part": pa.array(part[at], pa.int32()), "label": blobs[0], "shared": blobs[1]})

    def summed(label: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distinct, inverse = np.unique(label, return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, inverse, n)
        return distinct, total

    def add(table: pa.Table) -> pa.Table:
        label, shared = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.int64) for c in ("label", "shared"))
        return pa.table(dict(zip(("label", "shared"), summed(label, shared))))

    packed = sets.select("label", "tokens").mapInArrow(deal, "bucket int, token binary, label binary, done binary, times binary")
    # the counts of a bucket go on packed too, by parts of the labels
    counted = packed.groupBy("bucket").applyInArrow(count, "part int, label binary, shared binary")
    return counted.groupBy("part").applyInArrow(add, "label long, shared long")


def buckets_for(tokens: int) -> int:
    return max(1, -(-tokens // BUCKET_TOKENS))


def chunk_links(sets: DataFrame, order: int, chunks: int) -> DataFrame:
    """(a, b): links found by signature trees over chunks of the sets in one min-hash order."""
    keys = [f"k{order}{i}" for i in range(3)] + ["fp"]

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fps: list[int] = []
        own: list[np.ndarray] = []
        held = 0

        def edges() -> pa.RecordBatch:
            roots = link(own)
            ids = np.array(fps, np.int64)
            moved = np.flatnonzero(roots != np.arange(len(roots)))
            return pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[roots[moved]])], ["a", "b"])

        for batch in batches:
            for fp, blob in zip(batch.column("fp").to_pylist(), batch.column("tokens").to_pylist()):
                if held + len(blob) > CHUNK_BYTES and own:
                    yield edges()
                    fps, own, held = [], [], 0
                fps.append(fp)
                own.append(np.frombuffer(blob, U))
                held += len(blob)
        if own:
            yield edges()

    dealt = sets.select(*keys, "tokens").repartitionByRange(chunks, *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(trees, "a long, b long")


def sketch_of(sets: DataFrame) -> np.ndarray:
    """How often tokens occur, by hash cell: fixes one order of tokens for all, rare ones first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for blob in batch.column("tokens").to_pylist():
                total += np.bincount((np.frombuffer(blob, U) >> U(40)).astype(np.int64) % SKETCH, minlength=SKETCH)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(total[cell])], ["cell", "n"])

    out = np.zeros(SKETCH, np.int64)
    for r in sets.select("tokens").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # SKETCH rows at most
        out[r["cell"]] = r["n"]
    return out


def prefix_rows(sets: DataFrame, sketch: np.ndarray) -> DataFrame:
    """(token, at, fp, label, n, bits): the prefix tokens of every set and their places, rare ones first."""
    levels = np.log2(sketch + 1).astype(np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(b, U) for b in batch.column("tokens").to_pylist()]
            if not own:
                continue
            firsts = []
            for tokens in own:
                rare = levels[(tokens >> U(40)).astype(np.int64) % SKETCH]
                n = len(tokens)
                firsts.append(tokens[np.lexsort((tokens, rare))[: n - -(-3 * n // 4) + 1]])
            k = np.array([len(f) for f in firsts])
            owner = np.repeat(np.arange(len(own)), k)
            bits = pa.array([m.tobytes() for m in bitmaps(own, PAIR_BITS)], pa.binary())
            for low in range(0, len(owner), ROWS_PER_BATCH):
                part = owner[low : low + ROWS_PER_BATCH]
                at = np.arange(low, low + len(part)) - (np.cumsum(k) - k)[part]
                token = np.concatenate([firsts[i] for i in range(part[0], part[-1] + 1)])[at[0] :][: len(part)]
                columns = [pa.array(token.astype(np.int64)), pa.array(at)] + [batch.column(c).take(pa.array(part)) for c in ("fp", "label", "n")]
                yield pa.RecordBatch.from_arrays([*columns, bits.take(pa.array(part))], ["token", "at", "fp", "label", "n", "bits"])

    return sets.select("fp", "label", "n", "tokens").mapInArrow(deal, "token long, at long, fp long, label long, n long, bits binary")


def met(rows: DataFrame, pieces: int) -> DataFrame:
    """(a, b, token, rep): open pairs of tokens with few, and the tokens with many (a, b null), named by the smallest of their sets.

    A pair is open at a token if bitmaps and sizes allow it and so do the places of the token: the first
    token two similar sets share leaves enough behind it in both.
    """

    def meet(cell: tuple, columns: list) -> pa.RecordBatch:
        fp, label, n, at = (np.array(columns[k], np.int64) for k in range(4))
        ends: list[tuple[int, int]] = []
        if (label != label[0]).any():
            label = np.unique(label, return_inverse=True)[1]  # the tree takes negative numbers for mixed nodes
            maps = np.frombuffer(b"".join(columns[4]), U).reshape(len(fp), -1)
            order = np.argsort(n, kind="stable")
            for i, j in Tree(maps[order], n[order]).pairs(lambda: label[order]):
                i, j = order[i], order[j]
                enough = 7 * np.minimum(n[i] - at[i], n[j] - at[j]) >= 3 * (n[i] + n[j])
                i, j = i[enough], j[enough]
                ends += zip(np.minimum(fp[i], fp[j]).tolist(), np.maximum(fp[i], fp[j]).tolist())
                if len(ends) > PAIRS_PER_SET * len(fp):
                    break
        many = len(ends) > PAIRS_PER_SET * len(fp)
        out = [(None, None, cell[0], int(fp.min()))] if many else [(*e, None, None) for e in ends]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], ["a", "b", "token", "rep"])

    cells = rows.select(F.col("token").alias("key"), F.lit(0).alias("i"), F.lit(0).alias("j"), "fp", "label", "n", "at", "bits")
    return by_cell(cells, pieces, ["fp", "label", "n", "at", "bits"], meet, "a long, b long, token long, rep long")


def linked_on_the_spot(cells: DataFrame, pieces: int) -> DataFrame:
    """(a, b): links that join the similar sets (fp, label, block, tokens) of every cell, by a signature tree and whole sets."""

    def act(cell: tuple, columns: list) -> pa.RecordBatch:
        fp, label, block = (np.array(columns[k], np.int64) for k in range(3))
        own = [np.frombuffer(t, U) for t in columns[3]]
        whole, found, ends = Overlap(own), UnionFind(len(own)), []
        first: dict[int, int] = {}
        for i, name in enumerate(label.tolist()):
            found.join(first.setdefault(name, i), i)
        order = np.argsort(whole.n, kind="stable")
        tree = Tree(bitmaps([own[i] for i in order]), whole.n[order])
        for i, j in tree.pairs(lambda: found.roots()[order]):
            i, j = order[i], order[j]
            apart = found.roots()[i] != found.roots()[j]
            if cell[1] != cell[2]:
                apart &= block[i] != block[j]
            i, j = i[apart], j[apart]
            alike = whole.similar(i, j, 3, 4)
            for x, y in zip(i[alike].tolist(), j[alike].tolist()):
                if found.root(x) != found.root(y):
                    found.join(x, y)
                    ends.append((int(fp[x]), int(fp[y])))
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in ends], pa.int64()) for k in (0, 1)], ["a", "b"])

    return by_cell(cells, pieces, ["fp", "label", "block", "tokens"], act, "a long, b long")


def completed(rest: DataFrame, work: Work) -> DataFrame:
    """(a, b): links between sets (fp, label, n, tokens) of different labels, enough to join all components that belong together."""
    rows = work.keep(prefix_rows(rest, sketch_of(rest)), "prefixes")
    counts = rows.groupBy("token").agg(F.count("*").alias("held"), F.min("fp").alias("rep"))
    hot = work.keep(counts.where(F.col("held") > HOT_SETS).select("token", "rep"), "hot")
    cold = rows.join(small(hot.select("token"), 8), "token", "left_anti")
    found = work.keep(met(cold, -(-rows.count() // PIECE_ROWS)), "found")
    sets = rest.select("fp", "tokens")
    few = work.keep(compared(found.where("a is not null").select("a", "b").distinct(), sets), "few")
    # tokens of one passage have much the same sets: those with the same smallest one make one cell, where each set comes once
    many = hot.unionByName(found.where("a is null").select("token", "rep"))
    members = work.keep(rows.select("token", "fp", "label", "n").join(small(many, 16), "token").groupBy("rep", "fp").agg(F.min("label").alias("label"), F.min("n").alias("n")), "members")
    blocks = F.expr(f"cast(ceil(greatest(count(*) / {HOT_SETS}, 8 * sum(n) / {CHUNK_BYTES})) as int)")
    cells = members.join(members.groupBy("rep").agg(blocks.alias("blocks")), "rep").withColumn("block", F.expr("cast(pmod(xxhash64(fp), blocks) as int)"))
    cells = cells.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cells = work.keep(cells.select(F.col("rep").alias("key"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp", "label", "n"), "cells")
    size = cells.agg(F.sum("n")).first()[0]
    if not size:
        return few
    return few.unionByName(work.keep(linked_on_the_spot(cells.join(sets, "fp"), -(-8 * size // CHUNK_BYTES)), "spot"))


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are similar, by their whole sets."""

    @F.pandas_udf("boolean")
    def alike(a, b):
        import pandas as pd

        return pd.Series([similar(np.frombuffer(x, U), np.frombuffer(y, U)) for x, y in zip(a, b)], dtype=bool)

    left, right = (sets.select(F.col("fp").alias(x), F.col("tokens").alias(f"{x}_tokens")) for x in ("a", "b"))
    return pairs.join(left, "a").join(right, "b").where(alike("a_tokens", "b_tokens")).select("a", "b")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable by links).

    A document without words has an empty set and is its own component. Null ids never name a
    component that has another id. Repeated rows each give a row; an empty table gives none.
    """
    work = Work(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    rows = work.keep(prefixes(slim), "rows")
    unique = work.keep(rows.where("fp is not null").groupBy("fp").agg(F.min("id").alias("first"), F.min("n").alias("n")), "unique")
    total = rows.agg(F.sum(F.expr("length(prefix) div 8"))).first()[0] or 0
    counts = shared_counts(rows.where("fp is not null").select(F.col("fp").alias("label"), F.col("prefix").alias("tokens")), buckets_for(total))
    live = counts.withColumnRenamed("label", "fp").join(unique, "fp").where(f"shared >= {least('n')}").select("fp", "first")
    live = work.keep(live, "live")
    ids = small(live.select(F.col("first").alias("wanted")).distinct(), 16)
    sets = work.keep(full_sets(slim.join(ids, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")), "sets")
    roots = linked(sets, work)
    if roots is None:
        return rows.join(unique.select("fp", "first"), "fp", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("first", "id").alias("component_id"))
    named = unique.join(roots.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component"))
    names = named.select("fp", "root").join(lowest, "root").select("fp", "component")
    return rows.join(names, "fp", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def linked(sets: DataFrame, work: Work) -> DataFrame | None:
    """(v, root) over all links between the sets; None where there are none."""
    size = sets.agg(F.sum(F.length("tokens"))).first()[0] or 0
    if not size:
        return None
    chunks = max(1, -(-size // CHUNK_BYTES))
    edges = chunk_links(sets, 0, chunks)
    for order in range(1, ORDERS):
        edges = edges.unionByName(chunk_links(sets, order, chunks))
    edges = work.keep(edges.distinct(), "links")
    roots = connected(edges, work)
    labelled = sets.select("fp", "n", "tokens").join(roots.withColumnRenamed("v", "fp"), "fp", "left").withColumn("label", F.coalesce("root", "fp")).drop("root")
    labelled = work.keep(labelled, "labelled")
    part = labelled.select("label", F.expr(f"substring(tokens, 1, cast(8 * (n - ceil(n * 0.75) + ceil(n / 12)) as int))").alias("tokens"))
    counts = shared_counts(part, buckets_for(size // 24))
    bound = labelled.groupBy("label").agg(F.min(F.expr(least("n"))).alias("least"))
    open_ = work.keep(counts.join(bound, "label").where("shared >= least").select("label"), "open")
    rest = work.keep(labelled.join(small(open_, 8), "label", "left_semi"), "rest")
    # whole sets now: three quarters of a set with a link are tokens of another component
    counts = shared_counts(rest.select("label", "tokens"), buckets_for(size // 8))
    bound = rest.groupBy("label").agg(F.min(F.expr("ceil(n * 0.75)")).alias("least"))
    open_ = work.keep(counts.join(bound, "label").where("shared >= least").select("label"), "still_open")
    rest = work.keep(rest.join(small(open_, 8), "label", "left_semi").dropDuplicates(["fp"]), "rest")
    if rest.isEmpty():
        return roots
    more = completed(rest, work)
    return roots if more.isEmpty() else connected(edges.unionByName(more), work)
