"""Spelling variants against a brute-force version over the deletion neighbourhoods of all words."""

import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from talkloom.llm import spelling_variants
from talkloom.llm.queries import QUERIES
from talkloom.llm.work import Work

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least_length=7, least_count=2, ratio=10):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least_length and c >= least_count}
    holes = defaultdict(set)
    near = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[i, w[:i] + w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.add((w, f, root, n[w], len(near[w]), n[f] if f else None))
    return out


def found(df):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]


def vocabulary_text(seed, words, alphabet="abé", low=7, high=9):
    rng = random.Random(seed)
    out = []
    for _ in range(words):
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(low, high)))
        out += [w] * rng.choice((1, 2, 3, 25, 400))
    rng.shuffle(out)
    return " ".join(out)


@pytest.mark.parametrize("limit", [4, 1 << 13])
def test_equals_brute_force_at_any_size_of_a_partition(spark, limit):
    """A small limit cuts every partition again and again."""
    rows = [(k, vocabulary_text(k, 250)) for k in range(4)] + [(None, "Straße-ABBAABBA abbaabba"), (7, None), (8, ""), (9, "short aaaaaaa×aaaaaaa÷ AÀaaaaaa")]
    rows += rows[:1]
    got = found(spelling_variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string"), limit=limit))
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert sum(r[4] for r in got) > 200


def test_a_word_in_all_texts_and_long_texts(spark):
    rows = [(k, "harmonic " * 50 + "harmonik") for k in range(40)] + [(100, "mornings " * 30_000 + "morningz morningz")]
    got = found(spelling_variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert set(got) == brute(rows)


def test_chains_end_at_the_root(spark):
    text = " ".join(["aaaaaaa"] * 2 + ["aaaaaab"] * 20 + ["aaaaabb"] * 200 + ["aaaabbb"] * 2000)
    docs = spark.createDataFrame([(-1, text)], "doc_id long, text string")
    got = {r[0]: r[2] for r in found(spelling_variants.group_variants(docs))}
    want = {w: root for w, _, root, *_ in brute([(-1, text)])}
    assert got == want and len(set(want.values())) < len(want)


def test_empty_tables_extra_columns_and_other_names(spark):
    schema = "id string, body string, word string, n long, form string"
    docs = spark.createDataFrame([("x", "lettering letterin lettering letterin", "w", 1, "f")], schema)
    got = spelling_variants.group_variants(docs, id_col="id", text="body")
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and set(found(got)) == brute([("x", "lettering letterin lettering letterin")])
    assert spelling_variants.group_variants(docs.limit(0), id_col="id", text="body").count() == 0
    with pytest.raises(ValueError):
        spelling_variants.group_variants(docs, id_col="id", text="body", ratio=1)


def test_acceptor_is_minimal():
    acceptor = spelling_variants.Acceptor()
    acceptor.add(sorted(["tap", "taps", "top", "tops"]))
    assert len(acceptor.next) == 5  # end, s, p, vowel, start


def test_no_partition_stays_larger_than_the_limit(spark):
    words = spark.createDataFrame([(f"prefix{chr(97 + i // 26)}{chr(97 + i % 26)}", 2) for i in range(300)], "word string, n long")
    parts = spelling_variants.bounded_partitions(words, 7, Work(spark), 40)
    sizes = parts.where("size - char_length(head) - char_length(tail) > 1").groupBy(*spelling_variants.PARTITION).count()
    assert sizes.where("count > 40").count() == 0


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")
def test_query_equals_brute_force_on_a_whole_table(spark):
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    rows = list(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist()))
    got = found(QUERIES["op12_spelling_variants"](spark, SF))
    assert len(got) == len(set(got)) and set(got) == brute(rows)
