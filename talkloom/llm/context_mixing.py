"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is a sequence of words and one end. Frequent words are coded by the bits of a Huffman
code made from the counts of the training texts; any other word by an escape and its bytes, eight bits
each. Every bit is predicted by three contexts:

* in a word code: the place in the code alone; with the word before; with the state of the text, which
  is the commonest of the ``STATES`` most frequent words so far;
* in a spelled word: the bits of this byte so far after the last two, three and five bytes.

All contexts but the first are hashed into tables of counts gathered over the corpus. The
predictions are added up in the logistic domain under weights chosen by a gate (kind of bit and
depth in its code); weights follow the errors of the text as it goes, and an adaptive
probability map refines the outcome. All of it moves on with every word, so a
prediction rests on earlier words of its own text and on the corpus alone, and all texts of a
slice, which are of like length, advance together in numpy. Weights and map of the first word are
learned online over all training texts, each slice predicted from the counts of the others.
The bits of a word are laid out once per slice, with their part of each hash; counting adds up equal
words under equal contexts before it looks at bits.

What is learned from the corpus: the counts of all words (a table that stays distributed; the
most frequent ``FREQUENT`` are broadcast), the bit counts of the contexts, tables of fixed size, and
the weights and the probability map every text starts from.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from talkloom.llm.textbytes import _LOWER, Words, mix, slices
from talkloom.llm.work import Work

FREQUENT = 1 << 18
#: Words seen less often are spelled, so that escape and spelling are learned at any size.
LEAST = 4
STATES = 32
BEFORE = 63
#: Hashed cells per table: spelling after two bytes, and the two richer contexts.
NEAR_BITS, RICH_BITS = 18, 20
SLICE = 1 << 20
#: Bytes of text that are scored together, and their bits that are laid out at once.
SCORED, BLOCK_BITS = 1 << 22, 1 << 17
#: Contexts of a word in the keys that are counted, and keys whose bits are counted at once.
KEYS, KEYS_AT_ONCE = 64, 1 << 16
#: Bits of a word code that are mixed; deeper ones, rarely seen, are predicted by their place in the code alone.
MIXED_DEPTH = 64
HELD_WORDS = 2_000_000
DEPTHS = 8
GATES = 2 * DEPTHS
APM_CELLS = 24
APM_TRUST = 24.0
RATE = 0.003
#: Bits of training texts that move the common weights at once, and by how much.
LEARN_BITS, LEARN_RATE = 1 << 12, 0.05
PIECE = 1 << 12
U = np.uint64
W = np.uint32
#: Spelling: 0 and five bits for the commonest bytes, 1 and eight bits for the others.
SHORT = b" abcdefghijklmnopqrstuvwxyz.,-'_"
BYTE_LENGTH = np.full(256, 9, np.int64)
BYTE_CODE = np.arange(256, 512).astype(W)
BYTE_LENGTH[list(SHORT)] = 6
BYTE_CODE[list(SHORT)] = np.arange(len(SHORT))
#: Factors of the context hashes.
NODE, STATE, STATED, PREVIOUS, FOLLOWED = W(0x9E3779B1), W(0x85EBCA6B), W(0xC2B2AE35), W(0x27D4EB2F), W(0x165667B1)
NODE_STATED, STATE_STATED = (W(0xC2B2AE35 * x & 0xFFFFFFFF) for x in (0x9E3779B1, 0x85EBCA6B))
#: This times FOLLOWED is NODE.
UNFOLLOWED = W(0x9E3779B1 * pow(0x165667B1, -1, 1 << 32) & 0xFFFFFFFF)
NEAR, RICH = W(32 - NEAR_BITS), W(32 - RICH_BITS)
#: The bits of every byte, byte after byte: place in the code times the factor of its context, twice the gate and the bit.
_of = np.repeat(np.arange(256), BYTE_LENGTH)
BYTE_FIRST = np.cumsum(BYTE_LENGTH) - BYTE_LENGTH
_j = np.arange(len(_of)) - BYTE_FIRST[_of]
_left = (BYTE_LENGTH[_of] - _j).astype(W)
_tree = ((W(1) << _j.astype(W)) | (BYTE_CODE[_of] >> _left)) * STATED
TREE_NODE, TREE_FOLLOWED = _tree * NODE, _tree * UNFOLLOWED
BYTE_KIND = (2 * (DEPTHS + np.minimum(_j, DEPTHS - 1)) + ((BYTE_CODE[_of] >> (_left - W(1))) & W(1))).astype(np.uint8)


class Code:
    """The Huffman code: symbols are the frequent words by rank, then the end, then the escape."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, ends: int, others: int):
        self.words = len(hashes)
        self.end, self.escape = self.words, self.words + 1
        order = np.argsort(hashes)
        self.sorted, self.rank, self.counts = hashes[order], order.astype(np.int32), counts
        weights = [*counts.tolist(), max(ends, 1), max(others, 1)]
        heap = [(w, i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        n = len(weights)
        up = np.zeros(2 * n, np.int64)
        side = np.zeros(2 * n, np.uint8)
        total = np.array([*weights, *[0] * n], np.float64)
        new = n
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            up[a[1]] = up[b[1]] = new
            side[b[1]] = 1
            total[new] = a[0] + b[0]
            heapq.heappush(heap, (a[0] + b[0], new))
            new += 1
        root = new - 1
        #: per inner node: log odds of a 1
        ones = np.zeros(2 * n)
        inside = np.arange(root)
        np.add.at(ones, up[inside], total[inside] * side[inside])
        inner = total[n:new]
        self.odds = np.log((ones[n:new] + 0.01) / (inner - ones[n:new] + 0.01)).astype(np.float32)
        self.up, self.side = up[:new].astype(np.int32), side[:new]
        self.lay_out()

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("words", "end", "escape", "sorted", "rank", "counts", "odds", "up", "side")}

    def __setstate__(self, state: dict) -> None:
        """The paths are several times the size of the tree, so a task lays them out itself."""
        self.__dict__.update(state)
        self.lay_out()

    def lay_out(self) -> None:
        n, root = self.words + 2, len(self.up) - 1
        up, side = self.up, self.side
        at, paths = np.arange(n), []
        while (moving := at != root).any():
            paths.append((np.where(moving, up[at] - n, -1), side[at]))
            at = np.where(moving, up[at], root)
        self.nodes = np.array([p[0] for p in paths], np.int32).T  # (symbols, depth), leaf first, -1 beyond the root
        self.bits = np.array([p[1] for p in paths], np.uint8).T
        self.length = (self.nodes >= 0).sum(1)
        # (symbols, depth) from the root down
        level = (self.length[:, None] - 1).astype(np.int16) - np.arange(self.nodes.shape[1], dtype=np.int16)
        deep = level >= MIXED_DEPTH
        self.tail, few = np.zeros(n), np.flatnonzero(deep.any(1))
        z = np.where(self.bits[few] == 1, -1.0, 1.0) * self.odds[np.maximum(self.nodes[few], 0)]
        self.tail[few] = -(np.logaddexp(0, np.where(deep[few], z, -np.inf)) / np.log(10)).sum(1)
        keep = (level >= 0) & ~deep
        self.length = keep.sum(1)
        self.first = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.nodes, self.bits, self.depth = self.nodes[keep], self.bits[keep], level[keep].astype(np.int8)
        self.inner = len(self.odds)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """The symbol of each word, best in the order of hashes; the escape for words that are not frequent."""
        if not len(hashes) or not self.words:
            return np.full(len(hashes), self.escape)
        place = np.minimum(np.searchsorted(self.sorted, hashes), self.words - 1)
        return np.where(self.sorted[place] == hashes, self.rank[place], self.escape)


def spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place): the places starts[i] .. starts[i] + sizes[i] - 1 of every i."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    before = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    return owner, np.arange(len(owner)) - before[owner] + starts[owner]


class Events:
    """The words of a slice of texts and their bits: value, gate and the cell of each context.

    A token is a word or the end of a text. ``node``, ``stated``, ``followed`` and ``kind`` hold, per place, the bits of
    the distinct words: first those of the code, then from ``spelled`` on those of the words that are spelled.
    """

    def __init__(self, words: Words, code: Code):
        self.code, docs = code, len(words.bound) - 1
        distinct, number = np.unique(words.hash, return_inverse=True)
        symbol = np.append(code.symbols(distinct), code.end)
        self.symbol = symbol[number]
        # tokens: the words of each text, then its end
        self.number = np.insert(number, words.bound[1:], len(distinct))
        self.token_symbol = symbol[self.number]
        self.doc, self.step = spread(np.zeros(docs, np.int64), np.diff(words.bound) + 1)
        before = np.minimum(np.concatenate([[BEFORE], self.token_symbol[:-1]]), BEFORE)
        before[self.step == 0] = BEFORE
        self.before, self.state = before, self.states(self.token_symbol, self.step)
        listed, at = np.unique(symbol, return_inverse=True)
        size = code.length[listed]
        _, place = spread(code.first[listed], size)
        node = code.nodes[place]
        mixed = node.astype(W) * NODE
        # spelling of the other words, closed by a space
        some = np.zeros(len(distinct), np.int64)
        some[number] = np.arange(len(number))
        self.rare = np.flatnonzero(symbol == code.escape)
        which = some[self.rare]
        letters = words.end[which] - words.start[which] + 1
        own, place_of = spread(words.start[which], letters)
        low = np.append(_LOWER[words.data], np.uint8(32))
        letter = place_of - words.start[which][own]
        byte = np.where(letter == letters[own] - 1, 32, low[np.minimum(place_of, len(low) - 1)]).astype(W)
        last = [np.where(letter >= k, low[np.maximum(place_of - k, 0)], 0).astype(W) for k in (1, 2, 3, 4, 5)]
        length = BYTE_LENGTH[byte]
        place_in = np.repeat(BYTE_FIRST[byte] - (np.cumsum(length) - length), length)
        place_in += np.arange(len(place_in))
        near = last[0] | last[1] << W(8)
        wide = near | last[2] << W(16)
        far = (wide | last[3] << W(24)) * FOLLOWED ^ last[4] * STATE
        two, three, five = (np.repeat((k * PREVIOUS ^ k >> W(15)) * f, length) for k, f in ((near, NODE), (wide, NODE), (far, UNFOLLOWED)))
        tree = TREE_NODE[place_in]
        two += tree
        three += tree
        five += TREE_FOLLOWED[place_in]
        two >>= NEAR
        self.spelled = len(node)
        self.node = np.concatenate([node, two.astype(np.int32) + np.int32(code.inner)])
        self.stated = np.concatenate([mixed * STATED, three])
        self.followed = np.concatenate([mixed, five])
        #: twice the gate, and the bit
        self.kind = np.concatenate([2 * np.minimum(code.depth[place], DEPTHS - 1).astype(np.uint8) + code.bits[place], BYTE_KIND[place_in]])
        #: per distinct word, then for the end: where its bits in the code and in the spelling begin, and how many they are
        self.first, self.size = np.zeros((len(symbol), 2), np.int64), np.zeros((len(symbol), 2), np.int64)
        self.first[:, 0], self.size[:, 0] = (np.cumsum(size) - size)[at], size[at]
        self.size[self.rare, 1] = np.bincount(own, length, len(self.rare))
        self.first[:, 1] = self.spelled + np.cumsum(self.size[:, 1]) - self.size[:, 1]

    def lengths(self) -> np.ndarray:
        """Per token: how many bits it has."""
        return self.size.sum(1)[self.number]

    def expand(self, tokens: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of every bit of the tokens, in their order: kind, place among the distinct words, cells of the two hashed contexts, gate of its text."""
        number = self.number[tokens]
        first, size = self.first[number].ravel(), self.size[number].ravel()

        def both(code: np.ndarray, spelled: np.ndarray | int) -> np.ndarray:
            return np.repeat(np.stack([code, np.broadcast_to(spelled, code.shape)], 1).ravel(), size)

        place = np.repeat(first - (np.cumsum(size) - size), size)
        place += np.arange(len(place))
        state = both(self.state[tokens].astype(W) * STATE_STATED, W(0))
        state += self.stated[place]
        state >>= RICH
        before = both(self.before[tokens].astype(W) * PREVIOUS, W(0))
        before ^= self.followed[place]
        before *= FOLLOWED
        before >>= RICH
        text = self.doc[tokens] * GATES
        kind = self.kind[place]
        text = both(text, text)
        text += kind >> 1
        return kind, place, state.astype(np.intp), before.astype(np.intp), text

    def states(self, token_symbol: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Per token: 1 + the commonest frequent word before it in its text, 0 at first."""
        is_common = token_symbol < STATES
        common = np.flatnonzero(is_common)
        counts = np.zeros((len(common) + 1, STATES), np.int32)
        counts[np.arange(1, len(common) + 1), token_symbol[common]] = 1
        np.cumsum(counts, 0, out=counts)
        passed = np.cumsum(is_common) - is_common  # common words before each token
        starts = np.flatnonzero(inside == 0)
        base = np.repeat(passed[starts], np.diff(np.append(starts, len(inside))))
        after = (counts[1:] - counts[base[common]]).argmax(1) + 1
        return np.where(passed > base, np.append(after, 0)[passed - 1], 0)


def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(value, n): counts of equal values added up."""
    value, n = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
    order = np.argsort(value)
    value, n = value[order], n[order]
    at = np.flatnonzero(np.append(True, value[1:] != value[:-1])[: len(value)])
    return (value[at], np.add.reduceat(n, at)) if len(value) else (value, n)


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, n): how often each word occurs. Tasks send each word about once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def rows() -> pa.RecordBatch:
            h, n = merged(held)
            return pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(n)], ["h", "n"])

        for batch in batches:
            for _, data, off in slices(batch):
                held.append(np.unique(Words(data, off).hash, return_counts=True))
                if sum(len(x[0]) for x in held) > HELD_WORDS:
                    held = [merged(held)]
                    if len(held[0][0]) > HELD_WORDS // 2:
                        yield rows()
                        held = []
        if held:
            yield rows()

    return texts.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def context_sizes(code: Code) -> list[int]:
    return [code.inner + (1 << NEAR_BITS), 1 << RICH_BITS, 1 << RICH_BITS]


def context_counts(texts: DataFrame, code) -> list[np.ndarray]:
    """Per context 2 * cells: zeros and ones seen, over all training texts. Tasks send tables of fixed size."""
    ends = np.cumsum([0, *(2 * n for n in context_sizes(code.value))])
    whole = -(-int(ends[-1]) // PIECE) * PIECE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(whole, np.uint32)

        def add_bits(c: int, cell: np.ndarray, bit: np.ndarray, n: np.ndarray) -> None:
            np.add.at(total, ends[c] + 2 * cell.astype(np.intp) + bit, n.astype(np.uint32))

        def add_words(c: int, held: list[tuple[np.ndarray, np.ndarray]]) -> None:
            keys, n = merged(held)
            for at in range(0, len(keys), KEYS_AT_ONCE):
                symbol, context = np.divmod(keys[at : at + KEYS_AT_ONCE].astype(np.int64), KEYS)
                owner, place = spread(code.value.first[symbol], code.value.length[symbol])
                node, bit, times = code.value.nodes[place], code.value.bits[place], n[at : at + KEYS_AT_ONCE][owner]
                context = context.astype(W)
                if c == 1:
                    add_bits(0, node, bit, times)
                    add_bits(1, (node.astype(W) * NODE_STATED + (context * STATE_STATED)[owner]) >> RICH, bit, times)
                else:
                    add_bits(2, ((node.astype(W) * NODE ^ (context * PREVIOUS)[owner]) * FOLLOWED) >> RICH, bit, times)

        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {1: [], 2: []}
        for batch in batches:
            for _, data, off in slices(batch):
                events = Events(Words(data, off), code.value)
                for c, context in ((1, events.state), (2, events.before)):
                    held[c].append(np.unique((events.token_symbol * KEYS + context).astype(np.int32), return_counts=True))
                    if sum(len(x[0]) for x in held[c]) > HELD_WORDS:
                        held[c] = [merged(held[c])]
                        if len(held[c][0][0]) > HELD_WORDS // 2:
                            add_words(c, held[c])
                            held[c] = []
                if len(events.rare):
                    at = events.spelled
                    times = np.repeat(np.bincount(events.number, minlength=len(events.size))[events.rare], events.size[events.rare, 1])
                    bit = events.kind[at:] & 1
                    add_bits(0, events.node[at:], bit, times)
                    add_bits(1, events.stated[at:] >> RICH, bit, times)
                    add_bits(2, (events.followed[at:] * FOLLOWED) >> RICH, bit, times)
        for c in held:
            if held[c]:
                add_words(c, held[c])
        parts = total.reshape(-1, PIECE)
        some = np.flatnonzero(parts.any(1))
        for at in range(0, len(some), 256):
            yield pa.RecordBatch.from_arrays([pa.array(some[at : at + 256].astype(np.int32)), pa.array([parts[i].tobytes() for i in some[at : at + 256]], pa.binary())], ["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(PIECE, np.int64)
        for blob in table.column("counts").to_pylist():
            total += np.frombuffer(blob, np.uint32)
        return pa.table({"part": table.column("part").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(whole, np.int64)
    summed = texts.mapInArrow(count, "part int, counts binary").groupBy("part").applyInArrow(add, "part int, counts binary")
    for r in summed.collect():  # counts of all cells: a table of fixed size
        out[r["part"] * PIECE : (r["part"] + 1) * PIECE] = np.frombuffer(r["counts"], np.int64)
    if whole and out.max() < 1 << 32:
        out = out.astype(np.uint32)
    return [out[a:b] for a, b in zip(ends[:-1], ends[1:])]


def log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + 0.4) / (zeros + 0.4)).astype(np.float32)


def map_cell(gate: np.ndarray, dot: np.ndarray) -> np.ndarray:
    """The cell of the probability map."""
    dot = np.maximum(dot, dot.dtype.type(-8))
    np.minimum(dot, dot.dtype.type(8), out=dot)
    dot += dot.dtype.type(8)
    dot *= np.float32((APM_CELLS - 1) / 16)
    dot += np.float32(0.5)
    cell = dot.astype(np.intp)
    cell += gate * APM_CELLS
    return cell


def blocks(ends: np.ndarray, bits: int = BLOCK_BITS) -> Iterator[tuple[int, int]]:
    """Ranges of things of about ``bits`` bits, one thing at least, given where the bits of each end (0 first)."""
    lo, last = 0, len(ends) - 1
    while lo < last:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + bits, "right")) - 1)
        yield lo, hi
        lo = hi


#: What learning begins with, and what stays where no training text has a bit of a gate.
FIRST_WEIGHTS = np.array([[0.3, 0.45, 0.25]] * DEPTHS + [[0.2, 0.35, 0.5]] * DEPTHS, np.float32)
FIRST_MAP = np.tile(1 / (1 + np.exp(-np.linspace(-8, 8, APM_CELLS))), GATES).astype(np.float32)


def learn_start(texts: DataFrame, code, shared) -> tuple[np.ndarray, np.ndarray]:
    """(weights of each gate, share of ones of each map cell), learned online over all training texts.

    ``code`` and ``shared`` are broadcast: the code, and what ``context_counts`` returns. The counts of a slice are taken out before its bits are predicted. Tasks go over their own texts;
    their weights are averaged by the bits they saw, their maps are added up.
    """

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = FIRST_WEIGHTS.astype(np.float64)
        squares = np.full(weights.shape, 1e-3)
        outcomes = np.zeros(2 * GATES * APM_CELLS, np.int64)  # zeros and ones of each map cell
        own = [np.zeros(len(x), np.uint32) for x in shared.value]
        for batch in batches:
            for _, data, off in slices(batch, size=SLICE):
                events = Events(Words(data, off), code.value)
                ends = np.append(0, np.cumsum(events.lengths()))
                kinds = np.empty(ends[-1], np.uint8)
                cells = [np.empty(ends[-1], np.int32) for _ in own]
                for lo, hi in blocks(ends):
                    kind, place, *rich, _ = events.expand(slice(lo, hi))
                    part = slice(ends[lo], ends[hi])
                    kinds[part] = kind
                    kind &= 1
                    for seen_here, into, cell in zip(own, cells, (events.node[place].astype(np.intp), *rich)):
                        into[part] = cell
                        np.add.at(seen_here, 2 * cell + kind, np.uint32(1))
                odds = []
                for table, seen_here, cell in zip(shared.value, own, cells):
                    used = np.flatnonzero(seen_here.view(np.uint64))
                    zeros, ones = (table[2 * used + k] - seen_here[2 * used + k] for k in (0, 1))
                    rest = np.zeros(len(table) // 2, np.float32)
                    rest[used] = np.clip(log_odds(zeros, ones), -9, 9)
                    odds.append(rest.take(cell))
                    seen_here[:] = 0
                for at in range(0, len(kinds), LEARN_BITS):
                    x, kind = [o[at : at + LEARN_BITS] for o in odds], kinds[at : at + LEARN_BITS]
                    y, g = kind & 1, (kind >> 1).astype(np.intp)
                    dot = weights[:, 0].take(g) * x[0]
                    dot += weights[:, 1].take(g) * x[1] + weights[:, 2].take(g) * x[2]
                    np.minimum(np.maximum(dot, -12, out=dot), 12, out=dot)
                    error = y - 1 / (1 + np.exp(-dot))
                    slope = np.stack([np.bincount(g, error * one, GATES) for one in x], 1)
                    squares += slope**2
                    weights += LEARN_RATE * slope / np.sqrt(squares)
                    outcomes += np.bincount(2 * map_cell(g, dot) + y, minlength=len(outcomes))
        hits, seen = outcomes[1::2], outcomes[::2] + outcomes[1::2]
        bits = seen.reshape(GATES, APM_CELLS).sum(1)
        if bits.any():
            sums = np.concatenate([(weights * bits[:, None]).ravel(), bits, hits, seen])
            yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64()))], ["sums"])

    found = texts.mapInArrow(learn, "sums array<double>")
    total = np.zeros(GATES * (4 + 2 * APM_CELLS))
    for r in found.select(F.posexplode("sums").alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x")).collect():  # the same few rows at any size
        total[r["place"]] = r["x"]
    weights, bits, hits, seen = np.split(total, np.cumsum([3 * GATES, GATES, GATES * APM_CELLS]))
    weights = np.where(bits[:, None] > 0, weights.reshape(GATES, 3) / np.maximum(bits[:, None], 1), FIRST_WEIGHTS)
    share = (hits + APM_TRUST * FIRST_MAP) / (seen + APM_TRUST)
    return weights.astype(np.float32), share.astype(np.float32)


class Mixer:
    """The predictors that come from the corpus, and the scoring of a slice of texts."""

    def __init__(self, code: Code, odds: list[np.ndarray], start: tuple[np.ndarray, np.ndarray] = (FIRST_WEIGHTS, FIRST_MAP)):
        self.code, self.odds = code, [np.clip(x, -9, 9) for x in odds]
        self.odds[0][: code.inner] = np.clip(code.odds, -12, 12)
        self.start, self.map = start

    @classmethod
    def of(cls, code: Code, counts: list[np.ndarray], start: tuple[np.ndarray, np.ndarray]) -> Mixer:
        return cls(code, [log_odds(x[::2], x[1::2]) for x in counts], start)

    def score(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability of each text, symbol of each word)."""
        docs = len(words.bound) - 1
        events = Events(words, self.code)
        step = events.step
        order = np.argsort(step.astype(np.uint16) if len(step) and step.max() < 1 << 16 else step, kind="stable")
        tokens = np.searchsorted(step[order], np.arange(int(step.max()) + 2)) if len(step) else np.zeros(2, np.int64)
        cuts = np.append(0, np.cumsum(events.lengths()[order]))[tokens]
        place_odds = self.odds[0][events.node]
        # two float32 side by side: numpy looks up and adds pairs as fast as single numbers, and is fast for flat arrays alone
        pair, third = np.tile(self.start[:, :2].copy().view(np.complex64)[:, 0], docs), np.tile(self.start[:, 2], docs)
        seen = np.full((docs, GATES * APM_CELLS, 2), APM_TRUST, np.float32)
        seen[:, :, 0] = self.map * np.float32(APM_TRUST)
        seen = seen.reshape(-1).view(np.complex64)  # (ones, bits) of each map cell
        out = np.zeros(docs)
        for begin, end in blocks(cuts):
            kind, place, stated, followed, state = events.expand(order[tokens[begin] : tokens[end]])
            n = len(kind)
            odds = np.empty((n, 2), np.float32)
            odds[:, 0], odds[:, 1] = place_odds[place], self.odds[1].take(stated, mode="clip")
            last = self.odds[2].take(followed, mode="clip")
            bit = np.ones((n, 2), np.float32)
            bit[:, 0] = kind & 1
            both, bit = bit.view(np.complex64)[:, 0], bit[:, 0].copy()
            final = np.empty(n, np.float32)
            cut = (cuts[begin : end + 1] - cuts[begin]).tolist()
            for lo, hi in zip(cut[:-1], cut[1:]):
                at, two, one = state[lo:hi], odds[lo:hi], last[lo:hi]
                dots = pair[at].view(np.float32).reshape(-1, 2) * two
                dot = dots[:, 0] + dots[:, 1]
                dot += third[at] * one
                np.maximum(dot, np.float32(-12), out=dot)
                np.minimum(dot, np.float32(12), out=dot)
                p = 1 / (1 + np.exp(-dot))
                cell = map_cell(at, dot)
                known = seen[cell]
                final[lo:hi] = 0.65 * p + 0.35 * known.real / known.imag
                # from here on: what later words may know
                error = (bit[lo:hi] - p) * np.float32(RATE)
                np.add.at(pair, at, (error[:, None] * two).view(np.complex64)[:, 0])
                np.add.at(third, at, error * one)
                np.add.at(seen, cell, both[lo:hi])
            np.clip(final, 1e-6, 1 - 1e-6, out=final)
            # numpy vectorises the natural logarithm of float32, not the decimal one
            out += np.bincount(state, np.log(np.abs(1 - bit - final)), docs * GATES).reshape(docs, GATES).sum(1) / np.log(10)
        out += np.bincount(words.doc(), self.code.tail[events.symbol], docs) + self.code.tail[self.code.end]
        return out, events.symbol


class Trained:
    """What scoring needs: the distributed word counts, the totals, and the broadcast parts of the mixer, code and counts."""

    def __init__(self, vocabulary: DataFrame, mixer: Mixer, tokens: int, types: int, ends: int, parts: tuple):
        self.vocabulary, self.mixer, self.tokens, self.types, self.ends, self.parts = vocabulary, mixer, tokens, types, ends, parts


def train(texts: DataFrame, work: Work, text: str = "text") -> Trained:
    spark = texts.sparkSession
    texts = texts.select(F.col(text).alias("text"))
    vocabulary = work.keep(word_counts(texts), "vocabulary")
    ends = texts.count()
    words, types = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = vocabulary.where(F.col("n") >= LEAST).orderBy(F.desc("n"), "h").limit(FREQUENT).collect()  # FREQUENT rows at most
    hashes = np.array([r["h"] for r in top], np.int64).astype(U)
    counts = np.array([r["n"] for r in top], np.int64)
    code = Code(hashes, counts, ends, words - int(counts.sum()))
    shared = spark.sparkContext.broadcast(code)
    seen = context_counts(texts, shared)
    parts = shared, spark.sparkContext.broadcast(seen)
    return Trained(vocabulary, Mixer.of(code, seen, learn_start(texts, *parts)), words + ends, types + (ends > 0), ends, parts)


def score(docs: DataFrame, model: Trained, work: Work, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, n_known, base_score, score, bits_per_byte of every row; null texts count as empty.

    ``base_score`` is the add-one word model, exact for every word: counts of frequent words are
    at hand, other words of a text are looked up in the distributed counts by a join.
    """
    parts, start, ends = model.parts, (model.mixer.start, model.mixer.map), model.ends
    wide = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = wide.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, counts = (p.value for p in parts)
        mixer = Mixer.of(code, counts, start)
        log = np.log10(np.append(code.counts, [0, 0]) + 1.0)
        for batch in batches:
            # texts of like length share a slice, so that few of them end while others go on
            batch = batch.take(pc.sort_indices(pc.fill_null(pc.binary_length(batch.column("text")), 0)))
            for rows, data, off in slices(batch, size=SCORED):
                words = Words(data, off)
                points, symbol = mixer.score(words)
                doc, n = words.doc(), rows.num_rows
                frequent = symbol < code.words
                base = np.bincount(doc, log[symbol], n) + np.log10(ends + 1.0)
                known = np.bincount(doc[frequent], minlength=n) + (ends > 0)
                # the other words of each text, each once, and how often it has them
                owner, hashes = doc[~frequent], words.hash[~frequent].astype(np.int64)
                order = np.lexsort((hashes, owner))
                owner, hashes = owner[order], hashes[order]
                once = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1]))[: len(owner)])
                bound = pa.array(np.searchsorted(owner[once], np.arange(n + 1)).astype(np.int32))
                times = np.diff(np.append(once, len(owner)))
                whole = [np.diff(words.bound) + 1, known, np.diff(off)]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("id"), *(pa.array(p.astype(np.int64)) for p in whole), pa.array(base), pa.array(points),
                        *(pa.ListArray.from_arrays(bound, pa.array(x)) for x in (hashes[once], times)),
                    ],
                    ["id", "n_tokens", "known", "n_bytes", "base", "score", "others", "times"],
                )

    scored = wide.mapInArrow(run, f"id {id_type}, n_tokens long, known long, n_bytes long, base double, score double, others array<long>, times array<long>")
    scored = work.keep(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.inline(F.arrays_zip(F.col("others").alias("h"), F.col("times").alias("times"))))
    looked = rare.join(model.vocabulary, "h").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("gain"))
    bottom = float(np.log10(model.tokens + model.types + 1))
    out = scored.drop("others", "times").join(looked, "row", "left")
    return out.select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("gain", F.lit(0.0)) - F.col("n_tokens") * bottom).alias("base_score"),
        "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")).alias("bits_per_byte"),
    )
