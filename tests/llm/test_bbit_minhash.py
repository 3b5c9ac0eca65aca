"""b-bit MinHash near duplicates against brute force over all pairs of whole sets."""

import random
import re

import numpy as np
import pytest

from talkloom.llm import bbit_minhash as m, cells
from talkloom.llm.textbytes import mix

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)}


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    out = []
    for i, (d, _) in enumerate(rows):
        component = least.get(root(i)) if sets[i] else d
        out.append((d, len(sets[i]), component, d == component))
    return sorted(out, key=str)


def found(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()], key=str)


def families(seed, groups, size, words=60, edits=3):
    """Texts that drift from one another, so that links form chains and many pairs lie at the threshold."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        text = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(size):
            text = list(text)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(words)] = f"w{rng.randrange(5000)}"
            rows.append((rng.randrange(10**9), " ".join(text)))
    return rows


EDGES = [
    (5, None), (4, ""), (3, " \t\n"), (2, "One two"), (1, "one TWO"), (None, "one two"), (None, "alone here"), (None, None),
    (7, "a b c d e"), (7, "a b c d e"), (7, "quite another text of words"), (8, "A\x0bB\x0cC\rD  E"), (9, "É é È à"), (10, "é é È à"),
    (11, "long " * 30_000 + "tail end of it"), (12, "long " * 30_000 + "tail end of it"), (13, " ".join(f"x{i}" for i in range(20_000))),
    (0, " ".join(f"x{i}" for i in range(20_050))),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_equals_brute_force(spark):
    rows = families(1, 12, 14) + EDGES
    assert found(m.near_duplicates(frame(spark, rows))) == brute(rows)


def test_other_thresholds(spark):
    rows = families(2, 6, 10, edits=2)
    assert found(m.near_duplicates(frame(spark, rows), percent=90)) == brute(rows, 90)


@pytest.mark.parametrize("pairs_per_set", [0, 1 << 20])
def test_completion_finds_what_chunks_miss(spark, monkeypatch, pairs_per_set):
    """Without links from chunks and with two sets a block, the completion alone is exact: all on the spot, or all by join."""
    rows = families(3, 4, 12)
    monkeypatch.setattr(m, "BLOCK_SETS", 2)
    monkeypatch.setattr(m, "PAIRS_PER_SET", pairs_per_set)
    monkeypatch.setattr(cells, "COLUMNS", 64)
    monkeypatch.setattr(m, "chunk_links", lambda sets, *_: sets.select(sets.fp.alias("a"), sets.fp.alias("b")).limit(0))
    assert found(m.near_duplicates(frame(spark, rows))) == brute(rows)


def test_overlap_is_exact(monkeypatch):
    monkeypatch.setattr(cells, "COLUMNS", 128)
    rng = np.random.default_rng(5)
    own = [np.unique(rng.integers(0, 900, rng.integers(1, 500)).astype(np.uint64)) for _ in range(40)]
    x, y = np.triu_indices(40)
    assert cells.Overlap(own).of(x, y).tolist() == [len(np.intersect1d(own[i], own[j])) if i != j else int(sum(sum(t in o for o in own) > 1 for t in own[i].tolist())) for i, j in zip(x, y)]


def test_hot_groups(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(base)) for i in range(1_500)]
    for i in range(1_500, 2_300):  # near copies, all different
        text = list(base)
        text[rng.randrange(40)] = f"new{i}"
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(f"own{i}-{j}" for j in range(30))) for i in range(2_300, 2_400)]
    got = m.near_duplicates(frame(spark, rows)).collect()
    sets = {r.doc_id: r.component_id for r in got}
    linked = {i: 0 if 100 * len(shingles(t) & shingles(rows[0][1])) >= 80 * len(shingles(t) | shingles(rows[0][1])) else None for i, t in rows}
    assert len(got) == 2_400 and all(sets[i] == 0 for i, c in linked.items() if c == 0)
    assert all(sets[i] == i for i in range(2_300, 2_400))


def test_empty_table_and_clashing_names(spark):
    schema = "doc_id string, text string, fp string, n int, sig string, keys int, kept int, a int, label int"
    docs = spark.createDataFrame([("x", "one two three four five", "f", 1, "s", 2, 3, 4, 5), ("b", "ONE two three four five", "f", 1, "s", 2, 3, 4, 5)], schema)
    assert found(m.near_duplicates(docs)) == [("b", 2, "b", True), ("x", 2, "b", False)]
    assert m.near_duplicates(docs.limit(0)).count() == 0
    assert found(m.near_duplicates(docs.withColumn("text", docs.text.substr(0, 0)))) == [("b", 0, "b", True), ("x", 0, "x", True)]


def pairs_at(similarity, shared, count, seed):
    rng = np.random.default_rng(seed)
    for _ in range(count):
        each = int(round((shared / similarity - shared) / 2))
        tokens = mix(rng.integers(1, 1 << 62, shared + 2 * each).astype(np.uint64))
        yield np.sort(np.append(tokens[:shared], tokens[shared : shared + each])), np.sort(np.append(tokens[:shared], tokens[shared + each :]))


@pytest.mark.parametrize("shared", [8, 40, 400])
def test_estimates_and_band_keys_at_the_threshold(shared):
    """Collision-corrected estimates are right on average, and pairs at the threshold are neither cut nor without a key."""
    estimates, keys, cut = [], 0, 0
    for a, b in pairs_at(0.8, shared, 300, shared):
        least = m.minima(np.concatenate([a, b]), np.array([0, len(a)]))
        x, y = m.signatures(least)
        agreed = int(m.matches(x, y))
        low = mix(least) & np.uint64(3)
        assert agreed == int((low[:, 0] == low[:, 1]).sum())
        estimates.append(m.estimate(agreed))
        cut += agreed < m.least_matches(80, 100)
        k = m.band_keys(least)
        keys += bool((k[0] == k[1]).any())
    assert abs(np.mean(estimates) - 0.8) < 0.01 and cut == 0 and keys == 300
    assert abs(np.mean([m.estimate(int(m.matches(*m.signatures(m.minima(np.concatenate([a, b]), np.array([0, len(a)])))))) for a, b in pairs_at(0.3, shared, 200, 7)]) - 0.3) < 0.03
