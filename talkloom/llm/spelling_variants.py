"""Groups of words that differ by one edit, by composition of finite-state machines.

V is the minimised acceptor of the vocabulary and T the transducer that makes exactly one
insertion, deletion or replacement; V o T o V accepts the pairs of near words. A pair of words of
lengths s and s or s + 1 agrees in its first or its last s // 2 code points, since one edit
cannot touch both. So the composition falls into partitions by initial state: the state V (or, read
backwards, its reversal) is in after those code points. Each partition composes what follows
them: both sides walk the same transitions up to the edit, then only where both accept the
same rest. A partition of more words than one step may hold is cut again by the same law
applied to the rest of its words, until it fits.

Counts are combined before the shuffle; a word is sent to four partitions at most (twice that per
cut) and no pair leaves its task: a partition sends one row per word, its number of near words
and the best of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from talkloom.llm.work import Work, small

LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of one partition, and of all partitions that share an acceptor.
PARTITION_WORDS = 1 << 13
ACCEPTOR_WORDS = 1 << 14
ROWS_PER_TASK = 1 << 18
PARTITION = ["size", "way", "head", "tail"]


class Acceptor:
    """Minimised acceptors that share their states; state 0 accepts the empty word only."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.final = [True]
        self._known: dict[tuple, int] = {(True,): 0}
        self._both: dict[tuple[int, int], tuple[str, ...]] = {}
        self._all: dict[int, tuple[str, ...]] = {}

    def add(self, words: list[str], at: int = 0, low: int = 0, high: int | None = None) -> int:
        """The state whose right language is the rests, from place ``at``, of sorted distinct words."""
        high = len(words) if high is None else high
        final = len(words[low]) == at
        steps = []
        i = low + final
        while i < high:
            c = words[i][at]
            j = i + 1
            while j < high and words[j][at] == c:
                j += 1
            steps.append((c, self._chain(words[i], at + 1) if j == i + 1 else self.add(words, at + 1, i, j)))
            i = j
        return self._state(final, steps)

    def _chain(self, word: str, at: int) -> int:
        state = 0
        for c in reversed(word[at:]):
            state = self._state(False, [(c, state)])
        return state

    def _state(self, final: bool, steps: list[tuple[str, int]]) -> int:
        signature = (final, *steps)
        found = self._known.get(signature)
        if found is None:
            found = self._known[signature] = len(self.next)
            self.next.append(dict(steps))
            self.final.append(final)
        return found

    def rests(self, p: int) -> tuple[str, ...]:
        """The right language of a state."""
        found = self._all.get(p)
        if found is None:
            found = self._all[p] = (("",) if self.final[p] else ()) + tuple(c + t for c, q in self.next[p].items() for t in self.rests(q))
        return found

    def shared(self, p: int, q: int) -> tuple[str, ...]:
        """What two states both accept."""
        if p == q:
            return self.rests(p)
        pair = (p, q) if p < q else (q, p)
        found = self._both.get(pair)
        if found is None:
            a, b = self.next[p], self.next[q]
            found = (("",) if self.final[p] and self.final[q] else ()) + tuple(c + t for c in a if c in b for t in self.shared(a[c], b[c]))
            self._both[pair] = found
        return found

    def one_edit(self, a: int, b: int | None) -> Iterator[tuple[str, str]]:
        """Pairs one edit apart, once each: replaced within the language of ``a``, inserted from ``a`` to ``b``."""
        walk: list[tuple[str, int, int | None]] = [("", a, b)]
        while walk:
            x, p, q = walk.pop()
            own = self.next[p]
            steps = list(own.items())
            for i, (c, r) in enumerate(steps):
                for d, s in steps[i + 1 :]:
                    for t in self.shared(r, s):
                        yield x + c + t, x + d + t
            longer = {} if q is None else self.next[q]
            for c, r in longer.items():
                for t in self.shared(p, r):
                    if not t.startswith(c):  # within a run of one letter, its last place stands for all
                        yield x + t, x + c + t
            for c, r in steps:
                walk.append((x + c, r, longer.get(c)))


def vocabulary(docs: DataFrame, least_length: int, least_count: int, id_col: str, text: str) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, every 31st by crc32 of ``<id>:<run>`` less one code point."""
    # a run loses one code point at most, so shorter runs cannot give a word
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.expr(f"regexp_extract_all({_quoted(text)}, '({LETTERS}{{{least_length},}})', 1)")).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    place = F.pmod(h, F.char_length("run")).cast("int")
    less = F.concat(F.expr("substring(run, 1, place)"), F.expr("substring(run, place + 2)"))
    words = runs.withColumn("h", h).withColumn("place", place).select(F.when(F.col("h") % 31 == 0, less).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def partitions(words: DataFrame, least_length: int) -> DataFrame:
    """(size, way, head, tail, word, n): each word in the partitions of the pairs it can be part of.

    ``size`` is the length of the shorter word of a pair; ``head`` and ``tail`` are the code
    points in front and behind that both words have, one of them empty here; ``way`` says
    which half each cut took, f or b.
    """
    both = words.withColumn("length", F.char_length("word")).withColumn("size", F.explode(F.array(F.col("length"), F.col("length") - 1)))
    both = both.where(F.col("size") >= least_length).withColumns({"way": F.lit(""), "head": F.lit(""), "tail": F.lit("")})
    return _halved(both).select(*PARTITION, "word", "n")


def _halved(rows: DataFrame) -> DataFrame:
    """Cut every partition in two ways: by the first and by the last half of what is free in the shorter word."""
    rows = rows.withColumn("h", F.char_length("head")).withColumn("t", F.char_length("tail"))
    rows = rows.withColumn("k", F.expr("(size - h - t) div 2")).withColumn("side", F.explode(F.array(F.lit("f"), F.lit("b"))))
    front = F.expr("concat(head, substring(word, h + 1, k))")
    back = F.expr("concat(substring(word, char_length(word) - t - k + 1, k), tail)")
    heads, tails = F.when(F.col("side") == "f", front).otherwise(F.col("head")), F.when(F.col("side") == "b", back).otherwise(F.col("tail"))
    return rows.withColumns({"way": F.concat("way", "side"), "head": heads, "tail": tails})


def bounded_partitions(words: DataFrame, least_length: int, work: Work, limit: int = PARTITION_WORDS) -> DataFrame:
    """``partitions``, those of more than ``limit`` words cut until none is larger or nothing is left to cut.

    Partitions are counted before the shuffle of their words. Where one code point of the shorter word is free
    there is nothing to cut: the alphabet bounds the words, one per letter and one per pair of letters.
    """
    open_ = partitions(words, least_length)
    done: DataFrame | None = None
    while True:
        crowded = open_.groupBy(*PARTITION).count().where(F.col("count") > limit).where("size - char_length(head) - char_length(tail) > 1").select(*PARTITION)
        crowded = work.keep(crowded, "crowded")
        if crowded.isEmpty():
            return open_ if done is None else done.unionByName(open_)
        crowded = small(crowded, 128)  # one row per ``limit`` rows
        fits = open_.join(crowded, PARTITION, "left_anti")
        done = fits if done is None else done.unionByName(fits)
        cut = _halved(open_.join(crowded, PARTITION, "left_semi")).select(*PARTITION, "word", "n")
        open_ = work.keep(cut, "cut")


def near_words(parts: DataFrame, tasks: int) -> DataFrame:
    """(word, n_near, best_n, best): per word and task that found any, its near words there.

    A pair that agrees in front and behind is in several partitions; it counts in the one whose cuts take the
    front half wherever the pair agrees there.
    """

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str, str, str], tuple[list[str], list[str]]] = {}
        count: dict[str, int] = {}
        last: tuple[int, str, str, str] | None = None
        for batch in batches:
            for *group, word, n in zip(*(batch.column(c).to_pylist() for c in (*PARTITION, "word", "n"))):
                group = tuple(group)
                if group != last:
                    if len(count) >= ACCEPTOR_WORDS:
                        yield _found(held, count)
                        held, count = {}, {}
                    last = group
                    pair = held[group] = ([], [])
                pair[len(word) - group[0]].append(word)
                count[word] = n
        yield _found(held, count)

    keyed = parts.repartition(tasks, *PARTITION).sortWithinPartitions(*PARTITION, "word")
    return keyed.select(*PARTITION, "word", "n").mapInArrow(compose, "word string, n_near long, best_n long, best string")


def _first_way(size: int, way: str, u: str, v: str) -> bool:
    """Whether ``way`` takes the front half wherever a pair agrees there, as one way of every pair does."""
    h = t = 0
    for side in way:
        k = (size - h - t) // 2
        front = u[h : h + k] == v[h : h + k]
        if front != (side == "f"):
            return False
        h, t = (h + k, t) if front else (h, t + k)
    return True


def _found(held: dict, count: dict[str, int]) -> pa.RecordBatch:
    near: dict[str, list] = {}
    acceptor = Acceptor()
    for (size, way, head, tail), (short, long) in held.items():
        if not short or len(short) + len(long) < 2:
            continue
        h, t = len(head), len(tail)
        a = acceptor.add([w[h : len(w) - t] for w in short])
        b = acceptor.add([w[h : len(w) - t] for w in long]) if long else None
        for x, y in acceptor.one_edit(a, b):
            u, v = head + x + tail, head + y + tail
            if _first_way(size, way, u, v):
                for one, other in ((u, v), (v, u)):
                    best = near.get(one)
                    n = count[other]
                    if best is None:
                        near[one] = [1, n, other]
                    else:
                        best[0] += 1
                        if n > best[1] or n == best[1] and other < best[2]:
                            best[1:] = n, other
    columns = [list(near), *([r[i] for r in near.values()] for i in range(3))]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "n_near", "best_n", "best"])


def roots(forms: DataFrame, work: Work, ratio: int) -> DataFrame:
    """(word, root): where following (word, form) ends. A form is ``ratio`` times as frequent, so doubling ends soon."""
    now = forms.select("word", F.col("form").alias("root"))
    steps = 1
    while ratio**steps < 1 << 63:  # no chain is longer than counts can grow by the ratio
        ahead = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        now = work.keep(now.join(ahead, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root")), "roots")
        steps *= 2
    return now


def group_variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least_length: int = 7, least_count: int = 2, ratio: int = 10, limit: int = PARTITION_WORDS) -> DataFrame:
    """One row per word of the corpus: word, form, root, n, n_near, form_n.

    Words are what ``vocabulary`` finds at least ``least_count`` times; the form of a word is its most frequent
    near word (the smallest in code-point order of equals) if that is at least ``ratio`` (above 1) times
    as frequent, the root what following forms leads to. Null texts have no words, a null id counts
    as an empty one, repeated rows count each, an empty table gives no rows.
    """
    if ratio < 2 or least_length < 2:
        raise ValueError("ratio and least_length must be 2 or more")
    work = Work(docs.sparkSession)
    words = work.keep(vocabulary(docs, least_length, least_count, id_col, text), "words")
    parts = bounded_partitions(words, least_length, work, limit)
    tasks = max(1, -(-4 * words.count() // ROWS_PER_TASK), docs.sparkSession.sparkContext.defaultParallelism)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    near = near_words(parts, tasks).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    found = words.join(near, "word", "left")
    has = -F.col("best.n") >= ratio * F.col("n")
    rows = work.keep(
        found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best.word")).alias("form"), F.when(has, -F.col("best.n")).alias("form_n")), "near"
    )
    ends = roots(rows.where("form is not null").select("word", "form"), work, ratio)
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
