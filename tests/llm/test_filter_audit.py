"""The filter audit against a brute-force run of all orders, one document at a time."""

import re
from itertools import permutations
from math import factorial

import pytest

from talkloom.llm import filter_audit

WORDS = " ".join(f"w{i}" for i in range(120))


def brute(rows, labels):
    """rows: (doc_id, text, lang)."""
    said = {}
    for i, quality, toxic in labels:
        good, bad = said.get(i, (False, False))
        said[i] = (good or quality == 1, bad or toxic == 1)
    docs = []
    for i, text, lang in rows:
        t = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t):
            fails.add("C")
        if re.search("[#$%&*|]", t):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows):
            fails.add("E")
        docs.append((lang or "", fails, *(said.get(i, (False, False)) if i is not None else (False, False))))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        value = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                value[f] += len(gone)
                failing = sum(f in d[1] for d in own)
                out[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(value[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found(df):
    rows = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}
    assert len(rows) == df.count()
    return rows


def tables(spark, rows, labels, extra=False):
    schema = "doc_id long, text string, lang string" + (", mask int, part string, docs long, good int, removed long, again boolean" if extra else "")
    more = (1, "x", 2, 3, 4, True) if extra else ()
    return spark.createDataFrame([(*r, *more) for r in rows], schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


ROWS = [
    (1, WORDS, "en"), (2, WORDS, "en"), (3, WORDS, "de"), (4, None, "en"), (5, "", "de"), (6, None, None), (7, "  \t\n", ""),
    (8, WORDS + " #", "en"), (9, "AB " * 150, "en"), (10, "a\x0bb\x0cc\rd é € ABC", "fr"), (11, " ".join(["x"] * 200) + " & X", "de"),
    (None, WORDS, "en"), (None, WORDS, "en"), (2, WORDS, "en"), (1, WORDS, "en"), (12, WORDS.upper(), "fr"), (13, WORDS.upper(), "en"),
    (14, "word " * 60_000 + "#", "en"), (15, "ÀÉ " + "Q" * 3, "fr"), (0, "$", None),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, 1, 1), (8, None, 1), (9, 1, None), (None, 1, 1), (99, 1, 1), (14, 1, 1), (12, 0, 1)]


@pytest.mark.parametrize("extra", [False, True])
def test_equals_brute_force(spark, extra):
    docs, labels = tables(spark, ROWS, LABELS, extra)
    got = found(filter_audit.audit_text_filters(docs, labels))
    assert got == brute(ROWS, LABELS) and len(got) == 4 * 600


def test_hot_copies(spark):
    rows = [(i, "one text for all", "en") for i in range(3_000)] + [(i, f"text {i}", "en") for i in range(3_000, 3_100)]
    docs, labels = tables(spark, rows, LABELS)
    got = found(filter_audit.audit_text_filters(docs.repartition(8), labels))
    assert got["en", "EABCD", 1][:2] == (101, 2_999)


def test_empty_tables(spark):
    docs, labels = tables(spark, ROWS, LABELS)
    assert filter_audit.audit_text_filters(docs.limit(0), labels).count() == 0
    assert found(filter_audit.audit_text_filters(docs, labels.limit(0))) == brute(ROWS, [])


def test_path_counts_cover_all_orders():
    for k in range(1, 6):
        edges = filter_audit.lattice(k)
        assert len(edges) == k * 2 ** (k - 1)
        walked = dict.fromkeys(((s, f) for s, f, _ in edges), 0)
        for order in permutations(range(k)):
            state = 0
            for f in order:
                walked[state, f] += 1
                state |= 1 << f
        assert walked == {(s, f): n for s, f, n in edges}
        assert all(sum(n for _, g, n in edges if g == f) == factorial(k) for f in range(k))


def test_other_filters(spark):
    """Any failure columns and names: three filters over a plain table."""
    from pyspark.sql import functions as F

    from talkloom.llm.work import Work

    rows = spark.range(60).select("id", F.lit("all").alias("part"))
    none = F.lit(False)
    counts = filter_audit.failure_counts(rows, F.col("part"), [F.col("id") % 2 == 0, F.col("id") % 3 == 0, F.col("id") < 0], none, none)
    got = found(filter_audit.interaction_report(counts, "xyz", Work(spark)))
    assert len(got) == 6 * 3 and got["all", "xyz", 2][:4] == (20, 10, 10, 10) and got["all", "zyx", 2][-1] == 3 * 20 + 3 * 10
