"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, exact completion, exact edit distance.

Texts are sequences of word hashes. The CGK embedding walks over a sequence with shared
random bits: step j copies the current word and moves on if the bit of (j, word) says so.
Two sequences of small edit distance then differ in few places (a number bounded by
its square, independent of the length), so a few sampled places agree with good probability: they are the LSH key, and several
walks with several samples each find most passages. What they miss, more of it the nearer to the limit
of edits and the longer the item, is completed exactly: an edit breaks two of an item's pairs of neighbouring words at
most, so of any 2 * edits + 1 of its pairs, the rarest here, one stands in every passage within the limit.

Items are put into size classes; windows of a class have its size, start at every word,
and are embedded like the first words of an item. A window that shares fewer neighbouring word
pairs with the items than any item within the distance must share is skipped unembedded: that
loses nothing. Hits of keys and of pairs are verified by the exact edit distance of the whole item to the best
stretch around the window, in words.

The item index is broadcast in blocks of ``BLOCK_ITEMS`` items, a fixed size, each block against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from talkloom.llm.textbytes import Words, mix, run_hash, slices, text_buffer
from talkloom.llm.work import Work

#: Edits allowed, as a share of an item's words: similarity of 0.75 or more.
EDITS = 0.25
WALKS, SAMPLES, PLACES = 4, 10, 4
CLASS_STEP = 4
BLOCK_ITEMS = 20_000
WINDOWS_AT_ONCE = 1 << 15
U = np.uint64


def size_class(words: int) -> int:
    return words if words < CLASS_STEP else words // CLASS_STEP * CLASS_STEP


def embed(windows: np.ndarray, walk: int) -> np.ndarray:
    """(windows, size) of word hashes to the first 1.25 * size places of the CGK embedding."""
    n, size = windows.shape
    at = np.zeros(n, np.int64)
    rows = np.arange(n)
    padded = np.concatenate([windows, np.zeros((n, 1), U)], axis=1)
    out = np.empty((n, max(1, size * 5 // 4)), U)
    for j in range(out.shape[1]):
        word = padded[rows, at]
        out[:, j] = word
        bit = (mix(word ^ U((walk * 0x9E3779B97F4A7C15 + j * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)) >> U(63)).astype(np.int64)
        at = np.minimum(at + bit, size)
    return out


def samples(size: int) -> np.ndarray:
    """(walks, samples, places): which places of the embedding make a key, one from each stretch of it."""
    rng = np.random.default_rng(size)
    length = max(1, size * 5 // 4)
    return ((np.arange(PLACES) + rng.random((WALKS, SAMPLES, PLACES))) * length / PLACES).astype(np.int64)


def keys(embedded: np.ndarray, places: np.ndarray, walk: int) -> np.ndarray:
    """(windows, samples) keys of one walk."""
    out = np.empty((len(embedded), SAMPLES), U)
    for s in range(SAMPLES):
        total = np.full(len(embedded), walk * SAMPLES + s + 1, U)
        for p in places[walk, s]:
            total = mix(total ^ embedded[:, p])
        out[:, s] = total
    return out


def edit_span(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end): the stretch of ``text`` nearest to ``item`` in word edits."""
    m, n = len(item), len(text)
    cost = np.zeros(n + 1, np.int64)
    start = np.arange(n + 1)
    steps = np.arange(n + 1)
    for i in range(m):
        diagonal = cost[:-1] + (text != item[i])
        down = cost[1:] + 1
        best = np.concatenate([[cost[0] + 1], np.minimum(diagonal, down)])
        origin = np.concatenate([[start[0]], np.where(diagonal <= down, start[:-1], start[1:])])
        # an insertion chain: the least of best[k] + (j - k) for k <= j
        slack = best - steps
        low = np.minimum.accumulate(slack)
        source = np.maximum.accumulate(np.where(slack == low, steps, 0))
        cost, start = low + steps, origin[source]
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


class Index:
    """The items of one block: per size class their LSH keys, and the word pairs of all."""

    def __init__(self, ids: list, texts: list):
        data, off = text_buffer(pa.array(texts, pa.string()))
        words = Words(data, off)
        self.ids = ids
        self.items = [words.hash[a:b] for a, b in zip(words.bound[:-1], words.bound[1:])]
        self.classes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.places: dict[int, np.ndarray] = {}
        self.key_cells: dict[int, np.ndarray] = {}
        by_class: dict[int, list[int]] = {}
        for i, item in enumerate(self.items):
            if len(item):
                by_class.setdefault(size_class(len(item)), []).append(i)
        for size, members in by_class.items():
            heads = np.array([self.items[i][:size] for i in members])
            self.places[size] = samples(size)
            found = np.concatenate([keys(embed(heads, w), self.places[size], w) for w in range(WALKS)], axis=1)
            flat, who = found.ravel(), np.repeat(np.array(members), found.shape[1])
            order = np.argsort(flat, kind="stable")
            self.classes[size] = flat[order], who[order]
            self.key_cells[size] = np.zeros(1 << 20, bool)
            self.key_cells[size][(flat >> U(44)).astype(np.int64)] = True
        self.own_pairs = [run_hash(x, 2) for x in self.items]
        self.longest = {size: max(len(self.items[i]) for i in members) for size, members in by_class.items()}
        every, items_with = np.unique(np.concatenate([np.zeros(0, U), *map(np.unique, self.own_pairs)]), return_counts=True)
        self.pairs, self.rare = every, items_with == 1
        #: pairs of each class's poorest item that no other item has
        own_rare = [int(self.rare[np.searchsorted(every, x)].sum()) for x in self.own_pairs]
        self.poorest = {size: min(int(self.rare[np.searchsorted(every, run_hash(self.items[i][:size], 2))].sum()) if own_rare[i] else 0 for i in members) for size, members in by_class.items()}
        self.single = np.unique(np.concatenate([x for x in self.items if len(x)])) if any(map(len, self.items)) else np.zeros(0, U)
        # the pairs of each item one of which every passage within the limit holds; an item of one word has none and one key
        self.lengths = np.array([len(x) for x in self.items], np.int64)
        self.allowed = (EDITS * self.lengths).astype(np.int64)
        with_pairs = [k for k, x in enumerate(self.own_pairs) if len(x)]
        rarest = [np.lexsort((self.own_pairs[k], items_with[np.searchsorted(every, self.own_pairs[k])]))[: 2 * self.allowed[k] + 1] for k in with_pairs]
        flat = np.concatenate([np.zeros(0, U), *(self.own_pairs[k][r] for k, r in zip(with_pairs, rarest))])
        order = np.argsort(flat, kind="stable")
        self.sure = flat[order]
        self.sure_item = np.repeat(np.array(with_pairs, np.int64), [len(r) for r in rarest])[order]
        self.sure_place = np.concatenate([np.zeros(0, np.int64), *rarest])[order]
        # a small table of hash cells answers most look-ups of pairs
        self.cells = np.zeros(1 << 20, bool)
        self.cells[(self.pairs >> U(44)).astype(np.int64)] = True

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Per word: whether it and the next one are a pair of some item; of one item only."""
        pair = run_hash(words.hash, 2)
        out, rare = np.zeros(len(words.hash), bool), np.zeros(len(words.hash), bool)
        maybe = np.flatnonzero(self.cells[(pair >> U(44)).astype(np.int64)])
        if len(maybe) and len(self.pairs):
            place = np.minimum(np.searchsorted(self.pairs, pair[maybe]), len(self.pairs) - 1)
            out[maybe] = self.pairs[place] == pair[maybe]
            rare[maybe] = out[maybe] & self.rare[place]
        last = words.bound[1:][np.diff(words.bound) > 0] - 1
        out[last] = rare[last] = False
        return out, rare

    def complete(self, words: Words, doc: np.ndarray, total: np.ndarray, found: set[tuple[int, int, int]]) -> None:
        """Adds (text, item, word place) of every passage within the limit of edits; ``total`` counts pairs of items before a word."""
        pair = run_hash(words.hash, 2)
        at = np.flatnonzero(np.diff(total[: len(pair) + 1]))
        lo = np.searchsorted(self.sure, pair[at], "left")
        n = np.searchsorted(self.sure, pair[at], "right") - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        part = np.cumsum(n) // WINDOWS_AT_ONCE
        for own in np.split(np.arange(len(n)), np.flatnonzero(np.diff(part)) + 1):
            if not len(own):
                continue
            before = np.cumsum(n[own]) - n[own]
            k = np.arange(int(n[own].sum())) - np.repeat(before - lo[own], n[own])
            item = self.sure_item[k]
            text = np.repeat(doc[at[own]], n[own])
            start = np.repeat(at[own], n[own]) - self.sure_place[k]
            length, allowed = self.lengths[item], self.allowed[item]
            # the passage lies in [a, b), and its unbroken pairs with it
            a = np.maximum(words.bound[text], start - allowed)
            b = np.minimum(words.bound[text + 1], start + length + allowed)
            fit = total[b - 1] - total[a] >= length - 1 - 2 * allowed
            found.update(zip(text[fit].tolist(), item[fit].tolist(), start[fit].tolist()))

    def candidates(self, words: Words) -> set[tuple[int, int, int]]:
        """(text, item, word place) of key hits."""
        found: set[tuple[int, int, int]] = set()
        n = len(words.hash)
        if not n:
            return found
        doc = words.doc()
        total, rare = (np.concatenate([[0], np.cumsum(h)]) for h in self.hits(words))
        self.complete(words, doc, total, found)
        padded = np.concatenate([words.hash, np.zeros(max(self.classes, default=0), U)])
        for size, (known, who) in self.classes.items():
            edits = int(EDITS * self.longest[size])
            least = size - 1 - 2 * edits  # pairs that must remain
            least_rare = self.poorest[size] - 2 * edits
            if max(least, least_rare) > 0:
                fit = np.ones(n, bool)
                for low, count in ((least, total), (least_rare, rare)):
                    if low > 0:
                        reach = np.concatenate([count[size - 1 : n], np.full(min(n, size - 1), count[n])])
                        fit &= reach - count[:n] >= low
                starts = np.flatnonzero(fit)
            else:  # so short that nothing can be ruled out by pairs: windows that hold a word of an item
                starts = np.flatnonzero(np.isin(words.hash, self.single))
            for at in range(0, len(starts), WINDOWS_AT_ONCE):
                part = starts[at : at + WINDOWS_AT_ONCE]
                grid = part[:, None] + np.arange(size)
                windows = np.where(grid < words.bound[doc[part] + 1][:, None], padded[grid], U(0))
                for walk in range(WALKS):
                    key = keys(embed(windows, walk), self.places[size], walk)
                    key = key.ravel()
                    maybe = np.flatnonzero(self.key_cells[size][(key >> U(44)).astype(np.int64)])
                    lo = np.searchsorted(known, key[maybe], "left")
                    hi = np.searchsorted(known, key[maybe], "right")
                    for k in np.flatnonzero(hi > lo).tolist():
                        place = int(part[maybe[k] // SAMPLES])
                        for item in set(who[lo[k] : hi[k]].tolist()):
                            found.add((int(doc[place]), item, place))
        return found

    def matches(self, words: Words) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word, words, distance): the best verified stretch per text and item."""
        places: dict[tuple[int, int], list[int]] = {}
        for text, item, place in self.candidates(words):
            places.setdefault((text, item), []).append(place)
        out = []
        for (text, item), spots in places.items():
            want = self.items[item]
            allowed = int(EDITS * len(want))
            lo, hi = int(words.bound[text]), int(words.bound[text + 1])
            best = None
            spots.sort()
            at = 0
            while at < len(spots):  # neighbouring windows are verified in one stretch
                to = at
                while to + 1 < len(spots) and spots[to + 1] - spots[to] <= len(want):
                    to += 1
                a, b = max(lo, spots[at] - allowed - 1), min(hi, spots[to] + len(want) + allowed + 1)
                at = to + 1
                shared = np.isin(self.own_pairs[item], run_hash(words.hash[a:b], 2)).sum()
                if shared < len(want) - 1 - 2 * allowed:  # each edit breaks two pairs at most
                    continue
                distance, start, end = edit_span(want, words.hash[a:b])
                if distance <= allowed and (best is None or (distance, a + start) < best[:2]):
                    best = (distance, a + start, a + end)
            if best:
                out.append((text, item, best[1] - lo, best[2] - best[1], best[0]))
        return out


def find_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item found in it: id, item, first_word, n_words, edits, similarity.

    Null and empty texts and items match nothing; repeated rows each give their rows; null ids
    are returned as they are. Empty tables give no rows.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()
    items = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).where(F.length(F.trim("text")) > 0)
    item_type = items.schema["item"].dataType.simpleString()
    schema = f"id {id_type}, item {item_type}, first_word long, n_words long, edits long, similarity double"

    def against(index):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = index.value
            item_kind = pa.array(found.ids[:1]).type if found.ids else pa.int64()
            for batch in batches:
                for rows, data, off in slices(batch):
                    hits = found.matches(Words(data, off))
                    t, i, first, n, edits = (list(x) for x in zip(*hits)) if hits else ([],) * 5
                    share = [1 - e / max(len(found.items[k]), m) for e, k, m in zip(edits, i, n)]
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("id").take(pa.array(t, pa.int64())), pa.array([found.ids[k] for k in i], item_kind), *(pa.array(x, pa.int64()) for x in (first, n, edits)), pa.array(share, pa.float64())],
                        ["id", "item", "first_word", "n_words", "edits", "similarity"],
                    )

        return search

    count = items.count()
    blocks = -(-count // BLOCK_ITEMS)
    out = None
    kept = Work(spark).keep(items, "items") if blocks > 1 else items
    for block in range(blocks):  # a block is a bounded broadcast
        rows = kept.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect() if blocks > 1 else kept.collect()
        part = slim.mapInArrow(against(spark.sparkContext.broadcast(Index([r["item"] for r in rows], [r["text"] for r in rows]))), schema)
        out = part if out is None else out.unionByName(part)
    out = out if out is not None else spark.createDataFrame([], schema)
    return out.withColumnsRenamed({"id": id_col, "item": item_id})
