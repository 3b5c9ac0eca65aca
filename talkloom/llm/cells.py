"""Cells of sets that meet in one place, a group or a block pair of one, and exact comparison of their members."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Columns of the bitmaps of one comparison.
COLUMNS = 1 << 14
U = np.uint64


class Overlap:
    """Exact sizes of the intersections of sets, by bitmaps over the tokens that two of them or more have."""

    def __init__(self, own: list[np.ndarray]):
        self.n = np.array([len(s) for s in own], np.int64)
        owner = np.repeat(np.arange(len(own)), self.n)
        _, place, times = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        column = np.cumsum(times > 1) - 1
        shared = times[place] > 1
        owner, column = owner[shared], column[place[shared]]
        self.slabs = []
        for low in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
            inside = (column >= low) & (column < low + COLUMNS)
            at = column[inside] - low
            rows, where = np.unique(owner[inside], return_inverse=True)
            maps = np.zeros((len(rows) + 1, COLUMNS // 64), U)  # the last row is empty
            np.bitwise_or.at(maps, (where, at >> 6), U(1) << (at & 63).astype(U))
            row = np.full(len(own), len(rows))
            row[rows] = np.arange(len(rows))
            self.slabs.append((row, maps))

    def of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x), np.int64)
        for row, maps in self.slabs:
            p, q = row[x], row[y]
            some = np.flatnonzero((p < len(maps) - 1) & (q < len(maps) - 1))
            total[some] += np.bitwise_count(maps[p[some]] & maps[q[some]]).sum(1, dtype=np.int64)
        return total

    def similar(self, x: np.ndarray, y: np.ndarray, num: int, den: int) -> np.ndarray:
        both = self.of(x, y)
        return den * both >= num * (self.n[x] + self.n[y] - both)


CELL = ["key", "i", "j"]


def by_cell(rows: DataFrame, pieces: int, columns: list[str], act, schema: str) -> DataFrame:
    """``act(cell, columns as lists)`` for every cell of two sets or more; yields record batches. A set comes once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        cell = None
        for batch in batches:
            for key, i, j, *row in zip(*(batch.column(c).to_pylist() for c in (*CELL, *columns))):
                if (key, i, j) != cell:
                    if len(held) > 1:
                        yield act(cell, list(zip(*held)))
                    held, cell = [], (key, i, j)
                if not held or held[-1][0] != row[0]:
                    held.append(tuple(row))
        if len(held) > 1:
            yield act(cell, list(zip(*held)))

    pieces = max(pieces, rows.sparkSession.sparkContext.defaultParallelism)
    dealt = rows.select(*CELL, *columns).repartition(pieces, *CELL).sortWithinPartitions(*CELL, "fp")
    return dealt.mapInArrow(run, schema)
