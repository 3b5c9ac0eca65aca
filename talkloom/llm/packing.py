"""Packing by the cutting-stock problem, solved by column generation on the length histogram.

Documents become token ids and are cut every ``length`` tokens; the pieces fall into
length classes of ``STEP`` tokens. A linear program over patterns (how many pieces of each
class share a sequence) is solved by column generation: an unbounded knapsack, solved by
dynamic programming, prices new patterns until none helps or a bound shows that little can
be gained. Patterns are used the rounded-down number of times; the pieces left over, at
most some per pattern, are placed by first fit decreasing on counts. Pieces are ranked in
their class and a rank names sequence and place: the driver sees only the histogram, whose
size is fixed by the sequence length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from talkloom.llm.numbering import ranked
from talkloom.llm.textbytes import slices
from talkloom.llm.token_ids import encoder_of
from talkloom.llm.work import Work

STEP = 8
#: Stop pricing when the bound leaves less than this share to gain.
GAP = 0.001
#: Weight of the steady prices.
SMOOTH = 0.8
MAX_COLUMNS = 4000
END_ID = 1
ROW, CLASS, RANK, PLACE = "__talkloom_row", "__talkloom_class", "__talkloom_rank", "__talkloom_place"

Pattern = dict[int, int]


def pieces(docs: DataFrame, tokenizer: str, length: int, end_id: int = END_ID, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens of every piece. Null text counts as empty: its end id alone."""
    wide = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = wide.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        for batch in batches:
            for rows, data, off in slices(batch):
                ids, bound = encoder.encode(data, off)
                which, start, size, crc, total = [], [], [], [], []
                end = np.full(1, end_id, "<u4").tobytes()
                for k, (a, b) in enumerate(zip(bound[:-1].tolist(), bound[1:].tolist())):
                    raw = ids[a:b].astype("<u4").tobytes() + end
                    n = b - a + 1
                    for s in range(0, n, length):
                        which.append(k)
                        start.append(s)
                        size.append(min(length, n - s))
                        crc.append(zlib.crc32(raw[4 * s : 4 * (s + length)]))
                        total.append(n)
                out = [rows.column("id").take(pa.array(which, pa.int64()))] + [pa.array(x, pa.int64()) for x in (start, size, crc, total)]
                yield pa.RecordBatch.from_arrays(out, ["id", "start", "length", "ids_crc32", "doc_tokens"])

    return wide.mapInArrow(cut, f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long")


def best_pattern(worth: np.ndarray, classes: np.ndarray, width: int) -> tuple[float, Pattern]:
    """The pattern of greatest worth: unbounded knapsack by dynamic programming over the width."""
    value = np.zeros(width + 1)
    choice = np.full(width + 1, -1)
    fits = np.searchsorted(classes, np.arange(width + 1), "right").tolist()
    for w in range(int(classes[0]), width + 1):
        tries = value[w - classes[: fits[w]]] + worth[: fits[w]]
        k = int(tries.argmax())
        if tries[k] > value[w - 1] + 1e-12:
            value[w], choice[w] = tries[k], k
        else:
            value[w] = value[w - 1]
    found: Pattern = {}
    w = width
    while w > 0:
        k = int(choice[w])
        if k < 0:
            w -= 1
        else:
            found[k] = found.get(k, 0) + 1
            w -= int(classes[k])
    return float(value[width]), found


def column_generation(classes: np.ndarray, demand: np.ndarray, width: int) -> list[tuple[Pattern, float]]:
    """Patterns (class index -> copies) and how often each is used in the linear program.

    Prices are smoothed towards those of the best bound so far, which keeps them from
    swinging; where a smoothed pattern does not help, the true prices decide.
    """
    m = len(classes)
    copies = width // classes
    basis: list[Pattern] = [{i: int(copies[i])} for i in range(m)]
    inverse = np.diag(1.0 / copies)
    used = demand / copies
    steady, bound = classes / width, 0.0
    for _ in range(MAX_COLUMNS):
        dual = inverse.sum(0)
        pattern: Pattern = {}
        for prices in (SMOOTH * steady + (1 - SMOOTH) * dual, dual):
            value, pattern = best_pattern(prices, classes, width)
            if (below := float(prices @ demand) / max(value, 1.0)) > bound:
                bound, steady = below, prices / max(value, 1.0)
            if sum(dual[i] * n for i, n in pattern.items()) > 1 + 1e-9:
                break
        else:
            break
        if used.sum() - bound <= max(GAP * bound, 0.5):
            break
        column = np.zeros(m)
        column[list(pattern)] = list(pattern.values())
        step = inverse @ column
        positive = step > 1e-9
        ratio = np.where(positive, used / np.where(positive, step, 1), np.inf)
        out = int(ratio.argmin())
        amount = max(ratio[out], 0.0)
        used = np.maximum(used - amount * step, 0)
        used[out] = amount
        inverse[out] /= step[out]
        step[out] = 0
        inverse -= np.outer(step, inverse[out])
        basis[out] = pattern
    return [(p, float(x)) for p, x in zip(basis, used) if x > 0]


def first_fit(left: dict[int, int], width: int) -> list[Pattern]:
    """Sequences (class -> copies) for the pieces left over, longest classes first."""
    bins: list[list] = []  # [room, pattern]
    for c in sorted(left, reverse=True):
        for _ in range(left[c]):
            spot = next((b for b in bins if b[0] >= c), None)
            if spot is None:
                bins.append(spot := [width, {}])
            spot[0] -= c
            spot[1][c] = spot[1].get(c, 0) + 1
    return [b[1] for b in bins]


def plan_sequences(counts: dict[int, int], width: int) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, end rank, first sequence, copies a sequence) from counts per class."""
    if not counts:
        return []
    classes = np.array(sorted(counts))
    demand = np.array([counts[int(c)] for c in classes], float)
    patterns = [({int(classes[i]): n for i, n in p.items()}, int(x + 1e-7)) for p, x in column_generation(classes, demand, width)]
    left = dict(counts)
    out, at, sequence = [], dict.fromkeys(counts, 0), 0

    def place(pattern: Pattern, times: int) -> None:
        nonlocal sequence
        for c, n in pattern.items():
            out.append((c, at[c], at[c] + n * times, sequence, n))
            at[c] += n * times
            left[c] -= n * times
        sequence += times

    for pattern, times in patterns:
        times = min([times, *(left[c] // n for c, n in pattern.items())])
        if times:
            place(pattern, times)
    for pattern in first_fit({c: n for c, n in left.items() if n}, width):
        place(pattern, 1)
    return out


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = END_ID, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document, its end id included, lies in exactly one piece. Repeated
    rows are packed each, null ids like others; an empty table gives no rows.
    """
    spark = docs.sparkSession
    work = Work(spark)
    cut = pieces(docs, tokenizer, length, end_id, id_col, text)
    rows = cut.withColumn(CLASS, F.ceil(F.col("length") / STEP).cast("int")).withColumn(ROW, F.monotonically_increasing_id())
    numbered, counts = ranked(work.keep(rows, "pieces"), CLASS, ROW, [], RANK)
    plan = plan_sequences({r[CLASS]: r["n"] for r in counts.collect()}, length // STEP)  # length / STEP rows
    table = spark.createDataFrame(plan, f"{CLASS} int, lo long, hi long, base long, copies long")
    placed = numbered.join(F.broadcast(table), CLASS).where((F.col(RANK) >= F.col("lo")) & (F.col(RANK) < F.col("hi")))
    placed = placed.withColumn("sequence_id", F.col("base") + F.expr(f"({RANK} - lo) div copies"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc(CLASS), RANK).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return placed.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
