"""Language by error-correcting output codes over byte n-grams.

Every language gets a codeword; each bit of the code is one binary classifier that tells
the languages whose bit is 1 from those whose bit is 0 by smoothed n-gram log odds. All
bits derive from one table of n-gram counts per language, gathered over every training
text in its own task and summed once. Decoding adds up, for each codeword, the logistic
losses of the bits weighted by how well each bit did in training; the smallest loss wins,
and a small lead over the runner-up flags the text as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from talkloom.llm.textbytes import _LOWER, slices

#: Cells of the hashed n-gram space; n-grams of 1 to 3 bytes.
CELLS = 1 << 14
GRAMS = (1, 2, 3)
CODE_BITS = 15
UNKNOWN = "und"
#: A lead of the winner over the runner-up below this share of all loss is ambiguous.
AMBIGUOUS = 0.6
LETTER = "__talkloom_letter"


def gram_cells(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams, one row of ``CELLS`` per text; n-grams stay inside a text."""
    texts = len(off) - 1
    low = _LOWER[data].astype(np.uint32)
    doc = np.repeat(np.arange(texts, dtype=np.int64), np.diff(off))
    out = np.zeros(texts * CELLS, np.float32)
    for n in GRAMS:
        if len(low) < n:
            break
        code = low[: len(low) - n + 1].copy()
        for i in range(1, n):
            code |= low[i : len(low) - n + 1 + i] << np.uint32(8 * i)
        cell = ((code + np.uint32(n * 0x3C6EF372)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)
        inside = doc[: len(code)] == doc[n - 1 :]
        place = doc[: len(code)] * CELLS + cell
        out += np.bincount(place[inside], minlength=len(out)).astype(np.float32)
    return out.reshape(texts, CELLS)


def codewords(languages: int, bits: int = CODE_BITS) -> np.ndarray:
    """(languages, bits) of -1 and 1: rows far apart, every column splitting the languages.

    Rows grow one by one: of seeded candidates the one farthest from its nearest chosen
    row is taken, then constant columns are mended.
    """
    bits = max(bits, 4 * int(np.ceil(np.log2(max(2, languages)))))
    rng = np.random.default_rng(7)
    rows = [np.where(rng.random(bits) < 0.5, -1, 1)]
    while len(rows) < languages:
        tries = np.where(rng.random((256, bits)) < 0.5, -1, 1)
        near = np.min([(tries != r).sum(1) for r in rows], axis=0)
        rows.append(tries[int(near.argmax())])
    code = np.array(rows, np.float32)
    for c in range(bits) if languages > 1 else ():
        if abs(code[:, c].sum()) == languages:
            code[c % languages, c] *= -1
    return code


class Model:
    """Languages, their codewords, the bit classifiers and the weights of the bits."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages))
        share = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)  # every language alike, whatever its size
        odds = [np.log(share[b > 0].mean(0) / share[b < 0].mean(0)) if (b > 0).any() and (b < 0).any() else np.zeros(CELLS) for b in self.code.T]
        self.odds = np.array(odds, np.float32).T
        # a bit counts by how far it sets its own languages apart
        margins = (share @ self.odds) * self.code
        self.weight = np.maximum(margins.min(0), 0) + 1e-6 if len(languages) > 1 else np.ones(len(self.code.T))
        self.weight = (self.weight / self.weight.sum()).astype(np.float32)
        self.scale = 8.0 / max(float(np.abs(margins).mean()), 1e-6)

    def decode(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(winner, score 0 to 1, ambiguous, bit string as int) per row of n-gram counts."""
        total = np.maximum(cells.sum(1, keepdims=True), 1)
        margin = np.clip(cells @ self.odds / total * self.scale, -30, 30)
        loss = np.log1p(np.exp(-margin[:, None, :] * self.code[None])) @ self.weight
        order = np.argsort(loss, axis=1, kind="stable")
        likely = np.exp(-(loss - loss.min(1, keepdims=True)) * 2)
        score = 1 / likely.sum(1)
        bits = ((margin > 0) * (1 << np.arange(margin.shape[1], dtype=np.int64))).sum(1)
        return order[:, 0], score, score < AMBIGUOUS, bits


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """A model from every row with a language; None where there is none.

    One row of counts per language and task reaches the shuffle, one per language the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for rows, data, off in slices(batch, "text", 1 << 20):
                names = rows.column("lang").to_pylist()
                for at in range(0, len(names), 128):
                    part = off[at : at + 129]
                    cells = gram_cells(data[part[0] : part[-1]], part - part[0])
                    for name in set(names[at : at + 128]):
                        chosen = [i for i, x in enumerate(names[at : at + 128]) if x == name]
                        sums[name] = sums.get(name, 0) + cells[chosen].sum(0, dtype=np.float64)
        for name, total in sums.items():
            where = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(where), pa.string()), pa.array(where.astype(np.int32)), pa.array(total[where])], ["lang", "cell", "n"])

    known = labelled.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    parts = known.mapInArrow(count, "lang string, cell int, n double")
    rows = parts.groupBy("lang", "cell").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.collect_list("cell").alias("cell"), F.collect_list("n").alias("n")).orderBy("lang").collect()
    if not rows:
        return None
    counts = np.zeros((len(rows), CELLS))
    for i, r in enumerate(rows):
        counts[i, r["cell"]] = r["n"]
    return Model([r["lang"] for r in rows], counts)


ADDED = ("lang_pred", "score", "ambiguous", "codeword_bits")


def predict(docs: DataFrame, model: Model | None, text: str = "text", names: tuple[str, ...] = ADDED) -> DataFrame:
    """``docs`` with the language, its score (0 to 1), whether it is ambiguous, and the decoded bits.

    Texts that are null, empty or without a letter are ``und`` with score 0 (so is every
    text without a model). ``names`` of the added columns must be free in ``docs``.
    """
    columns = docs.columns
    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows, data, off in slices(batch, text, 1 << 20):
                n = rows.num_rows
                best, score, ambiguous, bits = np.zeros(n, int), np.zeros(n), np.ones(n, bool), np.zeros(n, np.int64)
                for at in range(0, n if model else 0, 64):
                    part, to = off[at : at + 65], min(at + 64, n)
                    best[at:to], score[at:to], ambiguous[at:to], bits[at:to] = model.decode(gram_cells(data[part[0] : part[-1]], part - part[0]))
                has = np.array(rows.column(LETTER).to_pylist(), bool) & (model is not None)
                found = [model.languages[b] if h else UNKNOWN for b, h in zip(best, has)]
                kept = [rows.column(c) for c in columns]
                more = [pa.array(found, pa.string()), pa.array(np.where(has, score, 0.0)), pa.array(ambiguous | ~has), pa.array(np.where(has, bits, 0))]
                yield pa.RecordBatch.from_arrays(kept + more, names=[*columns, *names])

    schema = StructType(list(docs.schema.fields))
    for name, kind in zip(names, ("string", "double", "boolean", "long")):
        schema = schema.add(name, kind)
    return docs.withColumn(LETTER, letter).mapInArrow(decide, schema)
