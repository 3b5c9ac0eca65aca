"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Terms are words and four-byte word beginnings (A-Z lower-cased, outer punctuation
dropped), which catch families of words. From a bounded sample of labelled texts those terms are
selected whose presence makes label 1 likelier (chi-square); their document
frequencies are counted over all texts. Examples with a selected term are indexed in
blocks of similar ones; per term and block the largest weight is kept. For a text, the blocks'
upper bounds are computed from those maxima, blocks are opened best first, and search ends when
no unopened block can beat the k-th neighbour: the result is exact. Neighbours vote with their
cosine; the share of toxic votes is calibrated by the leave-one-out votes of the examples
themselves, without their exact copies (monotone regression). A text without a selected term resembles the examples
without one and gets their share.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from talkloom.llm.textbytes import Words, slices
from talkloom.llm.work import Work

#: Bound of the labelled sample, of the selected terms, and the chi-square a term needs.
EXAMPLES = 20_000
TERMS = 4_096
MIN_EXAMPLES = 4
CHI_SQUARE = 30.0
#: The odds of label 1 must be this many times as high among examples with a term as among all: a lift of 3 where label 1 has 11 %,
#: and within reach at any share of it.
ODDS = 4.0
NEIGHBOURS = 15
BLOCK = 64
EVIDENCE = 3
STEM_BYTES = 4
_EDGE = np.zeros(256, bool)
_EDGE[list(b".,;:!?\"'()[]{}<>|*_-")] = True
U = np.uint64


def trimmed(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words without outer punctuation; a word of punctuation alone becomes empty."""
    start, end = words.start.copy(), words.end.copy()
    some = np.flatnonzero(_EDGE[words.data[start]]) if len(start) else np.zeros(0, np.int64)
    while len(some):
        start[some] += 1
        some = some[start[some] < end[some]]
        some = some[_EDGE[words.data[start[some]]]]
    some = np.flatnonzero(start < end)
    some = some[_EDGE[words.data[end[some] - 1]]]
    while len(some):
        end[some] -= 1
        some = some[_EDGE[words.data[end[some] - 1]]]
    return start, end


def terms_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) of every word without outer punctuation and of every beginning of a longer word; terms are hashes."""
    start, end = trimmed(words)
    full = start < end
    doc, start, end = words.doc()[full], start[full], end[full]
    long = end - start > STEM_BYTES
    whole = words.span_hash(start, end)
    stem = words.span_hash(start[long], start[long] + STEM_BYTES) ^ U(0x5DEECE66D)
    return np.concatenate([doc, doc[long]]), np.concatenate([whole, stem])


class Terms:
    """The selected terms; a table of hash cells answers most look-ups."""

    def __init__(self, hashes: list[int]):
        self.sorted = np.sort(np.array(hashes, np.int64).astype(U))
        self.cells = np.zeros(1 << 20, bool)
        self.cells[(self.sorted >> U(44)).astype(np.int64)] = True

    def counts(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, number of the term, times), by text, of the selected terms."""
        doc, term = terms_of(words)
        maybe = self.cells[(term >> U(44)).astype(np.int64)]
        doc, term = doc[maybe], term[maybe]
        if not len(term):
            return (np.zeros(0, np.int64),) * 3
        place = np.minimum(np.searchsorted(self.sorted, term), len(self.sorted) - 1)
        real = self.sorted[place] == term
        key, times = np.unique(doc[real] * len(self.sorted) + place[real], return_counts=True)
        return key // len(self.sorted), key % len(self.sorted), times


def sample_of(labelled: DataFrame, limit: int) -> DataFrame:
    """About ``limit`` labelled rows at most, chosen by a hash of the id; all of them where they are fewer."""
    n = labelled.count()
    if n <= limit:
        return labelled
    return labelled.where(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 20)) < int((1 << 20) * limit / n))


def select_terms(sample: DataFrame, limit: int = TERMS) -> list[int]:
    """The terms whose presence speaks most for label 1. The driver gets ``limit`` terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in slices(batch):
                doc, term = terms_of(Words(data, off))
                order = np.lexsort((doc, term))
                doc, term = doc[order], term[order]
                fresh = np.ones(len(term), bool)
                fresh[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
                toxic = rows.column("label").to_numpy()[doc[fresh]]
                found, at, n = np.unique(term[fresh], return_index=True, return_counts=True)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(n), pa.array(np.add.reduceat(toxic.astype(np.int64), at))], ["term", "n", "t"])

    total, positive = sample.agg(F.count("*"), F.sum("label")).first()
    if not total or not positive or positive == total:
        return []
    c = sample.select("text", "label").mapInArrow(count, "term long, n long, t long").groupBy("term").agg(F.sum("n").cast("double").alias("n"), F.sum("t").cast("double").alias("t"))
    n, t = F.col("n"), F.col("t")
    rest, p, m = F.lit(float(total)) - n, float(positive), float(total)
    chi = m * F.pow(t * (m - p - n + t) - (n - t) * (p - t), 2) / F.greatest(n * rest * p * (m - p), F.lit(1e-9))
    chosen = c.where(n >= MIN_EXAMPLES).withColumn("chi", chi).where((F.col("chi") >= CHI_SQUARE) & (t * (m - p) >= ODDS * p * (n - t)))
    return [r["term"] for r in chosen.orderBy(F.desc("chi"), "term").limit(limit).collect()]


def document_frequencies(docs: DataFrame, terms: Terms) -> tuple[int, np.ndarray]:
    """(number of texts, texts with each selected term), over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(len(terms.sorted) + 1, np.int64), 0
        for batch in batches:
            for rows, data, off in slices(batch):
                n += rows.num_rows
                seen += np.bincount(terms.counts(Words(data, off))[1], minlength=len(seen))
        seen[-1] = n  # the last place counts texts
        where = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(seen[where])], ["term", "n"])

    out = np.zeros(len(terms.sorted) + 1, np.int64)
    for r in docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]  # TERMS + 1 rows at most
    return int(out[-1]), out[:-1]


class BlockMaxIndex:
    """Unit TF-IDF vectors of the examples, in blocks of ``BLOCK``, with the largest weight per term and block."""

    def __init__(self, terms: Terms, idf: np.ndarray):
        self.terms = terms
        self.idf = idf
        self.base = 0.0
        self.curve = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def vector(self, where: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unit vector of a text from its selected terms and their counts."""
        weight = (1 + np.log(times)) * self.idf[where]
        return where, weight / np.sqrt(max((weight**2).sum(), 1e-30))

    def vectors(self, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The vector of each text."""
        doc, where, times = self.terms.counts(words)
        at = np.searchsorted(doc, np.arange(len(words.bound))).tolist()
        for a, b in zip(at[:-1], at[1:]):
            yield self.vector(where[a:b], times[a:b])

    def build(self, ids: list, labels: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], texts: list | None = None) -> None:
        """``texts``: a fingerprint of each example's text; without it, an id stands for its text."""
        full = [i for i, v in enumerate(vectors) if len(v[0])]
        empty = [labels[i] for i in range(len(vectors)) if not len(vectors[i][0])]
        self.base = (sum(empty) + 0.5) / (len(empty) + 1.0) if empty else 0.5
        # examples with the same strongest terms stand together, so that few blocks have high maxima
        full.sort(key=lambda i: (tuple(vectors[i][0][np.argsort(-vectors[i][1], kind="stable")][:3].tolist()), str(ids[i])))
        self.ids = [ids[i] for i in full]
        number: dict = {}
        texts = ids if texts is None else texts
        self.text = np.array([number.setdefault(texts[i], len(number)) for i in full], np.int64)
        self.text_number = number
        self.labels = np.array([labels[i] for i in full], np.int64)
        blocks = -(-len(full) // BLOCK)
        self.maxima = np.zeros((len(self.idf), blocks), np.float32)
        postings: list[list[tuple[int, int, float]]] = [[] for _ in range(blocks)]
        for at, i in enumerate(full):
            b = at // BLOCK
            for t, w in zip(*vectors[i]):
                postings[b].append((int(t), at % BLOCK, float(w)))
                self.maxima[t, b] = max(self.maxima[t, b], np.nextafter(np.float32(w), np.float32(2)))
        self.blocks = []
        for own in postings:
            own.sort()
            term = np.array([p[0] for p in own])
            self.blocks.append((term, np.array([p[1] for p in own]), np.array([p[2] for p in own])))

    def nearest(self, where: np.ndarray, weight: np.ndarray, k: int, without=None) -> list[tuple[float, int]]:
        """The k examples of greatest cosine above 0, exactly; ties by position. Examples of the text ``without`` are passed over."""
        if not len(where) or not self.blocks:
            return []
        bound = weight @ self.maxima[where]
        dense = np.zeros(len(self.idf))
        dense[where] = weight
        cosines, places = np.zeros(0), np.zeros(0, np.int64)
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or (len(cosines) == k and bound[b] < cosines[-1] - 1e-6):
                break
            term, at, w = self.blocks[b]
            found = np.bincount(at, dense[term] * w, BLOCK)
            some = np.flatnonzero(found > 0)
            if without is not None:
                some = some[self.text[b * BLOCK + some] != self.text_number.get(without, -1)]
            cosines, places = np.concatenate([cosines, found[some].round(9)]), np.concatenate([places, b * BLOCK + some])
            order = np.lexsort((places, -cosines))[:k]
            cosines, places = cosines[order], places[order]
        return list(zip(cosines.tolist(), places.tolist()))

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Share of toxic votes, each weighted by its closeness."""
        weight = np.array([c for c, _ in near])
        return float((weight * self.labels[[i for _, i in near]]).sum() / weight.sum())

    def calibrate(self, votes: np.ndarray, labels: np.ndarray) -> None:
        """Monotone regression of labels on leave-one-out votes."""
        if not len(votes):
            return
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []  # sum, count, lowest vote, highest vote
        for v, y in zip(votes[order], labels[order]):
            if pools and pools[-1][3] == v:
                pools[-1][0] += y
                pools[-1][1] += 1
            else:
                pools.append([float(y), 1.0, v, v])
            while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
                s, n, _, high = pools.pop()
                pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, pools[-1][2], high]
        x = np.array([(p[2] + p[3]) / 2 for p in pools])
        y = np.array([(p[0] + 0.05) / (p[1] + 0.1) for p in pools])
        self.curve = (x, np.maximum.accumulate(y))

    def score(self, where: np.ndarray, weight: np.ndarray) -> tuple[float, list[tuple[float, int]]]:
        near = self.nearest(where, weight, NEIGHBOURS)
        if not near:
            return self.base, near
        return float(np.interp(self.vote(near), *self.curve)), near


def fit(docs: DataFrame, labelled: DataFrame, examples: int = EXAMPLES) -> BlockMaxIndex:
    """An index from (id, text, label) rows; frequencies from all of ``docs`` (text).

    ``examples`` bounds the labelled rows that are used; they and the selected terms fit one process.
    """
    known = labelled.where(F.col("label").isNotNull()).select("id", F.coalesce("text", F.lit("")).alias("text"), (F.col("label") != 0).cast("int").alias("label"))
    sample = Work(docs.sparkSession).keep(sample_of(known, examples), "sample")
    terms = Terms(select_terms(sample))
    n, df = document_frequencies(docs, terms)
    index = BlockMaxIndex(terms, np.log((n + 1) / (df + 1)) + 1e-3)

    def slim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Examples reach the driver as their selected terms only."""
        for batch in batches:
            for rows, data, off in slices(batch):
                doc, where, times = terms.counts(Words(data, off))
                at = np.searchsorted(doc, np.arange(rows.num_rows + 1)).tolist()
                parts = [pa.array([x[a:b].tolist() for a, b in zip(at[:-1], at[1:])], pa.list_(pa.int64())) for x in (where, times)]
                raw = memoryview(data.tobytes())
                marks = pa.array([blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(off[:-1].tolist(), off[1:].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("label"), *parts, marks], ["id", "label", "place", "times", "mark"])

    kind = sample.schema["id"].dataType.simpleString()
    rows = sample.mapInArrow(slim, f"id {kind}, label int, place array<long>, times array<long>, mark binary").collect()
    rows.sort(key=lambda r: (str(r["id"]), r["place"], r["times"], r["label"]))
    keep = [index.vector(np.array(r["place"], np.int64), np.array(r["times"], np.int64)) for r in rows]
    marks = [bytes(r["mark"]) for r in rows]
    index.build([r["id"] for r in rows], [r["label"] for r in rows], keep, marks)
    votes, labels = [], []
    for r, t, mark in zip(rows, keep, marks):
        near = index.nearest(*t, NEIGHBOURS, mark)  # copies under other ids are left out too
        if near:
            votes.append(index.vote(near))
            labels.append(r["label"])
    index.calibrate(np.array(votes), np.array(labels))
    return index


def score(docs: DataFrame, index: BlockMaxIndex, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, score (0 to 1), evidence: the nearest examples with their cosine and label. Null texts count as empty."""
    wide = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = wide.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        item = pa.list_(pa.struct([("example", pa.string()), ("cosine", pa.float64()), ("label", pa.int64())]))
        for batch in batches:
            for rows, data, off in slices(batch):
                scores, shown = [], []
                for vector in index.vectors(Words(data, off)):
                    s, near = index.score(*vector)
                    scores.append(s)
                    shown.append([{"example": str(index.ids[i]), "cosine": c, "label": int(index.labels[i])} for c, i in near[:EVIDENCE]])
                yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(scores, pa.float64()), pa.array(shown, item)], ["id", "score", "evidence"])

    out = wide.mapInArrow(run, f"id {id_type}, score double, evidence array<struct<example:string,cosine:double,label:long>>")
    return out.withColumnRenamed("id", id_col)
