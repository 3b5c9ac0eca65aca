"""Small fixtures with nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

import pickle
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talkloom.llm import (
    context_mixing, decontaminate, ecoc_language, exact_dedup, jaccard_join, packing, ring_sharding, toxicity_knn, training_order, url_filter,
)
from talkloom.llm.queries import tokenizer
from talkloom.llm.signature_tree import link, similar
from talkloom.llm.textbytes import Words, text_buffer
from talkloom.llm.token_ids import ChunkEncoder, load
from talkloom.llm.work import Work

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n, pool=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


BASE = prose(1, 60)
TEXTS = [
    (1, None), (2, ""), (3, BASE), (4, BASE.replace(" ", " \n ")), (5, BASE.replace("w1 ", "x ", 1)), (6, "a b"), (7, "a b"), (8, "A  b"),
    (9, prose(2, 3000)), (9, prose(2, 3000)), (None, "no id at all here"), (None, BASE), (10, " \t "), (11, "été à ÇA 日本 \U0001f600"), (12, BASE + " " + prose(3, 5)),
]


def frame(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).repartition(3)


def key(row):
    return [(x is not None, x) for x in row]


def test_exact_dedup(spark):
    groups = {}
    for i, t in TEXTS:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    got = exact_dedup.mark_duplicates(frame(spark)).collect()
    assert len(got) == len(TEXTS)
    assert sorted((key((r.doc_id, r.keep_id, r.group_size)) for r in got)) == sorted(
        key((i, min((x for x in g if x is not None), default=None), len(g))) for g in groups.values() for i in g
    )
    assert sum(r.kept for r in got) == len(groups)
    stays = exact_dedup.drop_duplicates(frame(spark))
    assert stays.columns == ["doc_id", "text", "lang", "source", "n_chars"] and stays.count() == len(groups)
    assert exact_dedup.drop_duplicates(frame(spark, [])).count() == 0
    assert exact_dedup.mark_duplicates(frame(spark, [])).count() == 0


def components(rows):
    sets = []
    for i, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(len(rows)):
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    low = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return sorted(key((i, len(s), i if not s else low.get(r))) for (i, _), s, r in zip(rows, sets, root))


def near_rows():
    rng = random.Random(5)
    rows = list(TEXTS)
    for k in range(12):  # chains of near copies and texts that share a passage
        words = prose(50 + k % 4, 80).split()
        for _ in range(rng.randrange(1, 8)):
            words[rng.randrange(80)] = f"z{rng.randrange(1000)}"
        rows.append((100 + k, " ".join(words)))
        rows.append((200 + k, prose(7, 55) + " " + prose(300 + k, 20 + k)))
    return rows


def test_jaccard_join(spark):
    rows = near_rows()
    got = jaccard_join.similar_components(frame(spark, rows))
    assert sorted(key((r.doc_id, r.n_shingles, r.component_id)) for r in got.collect()) == components(rows)
    assert jaccard_join.similar_components(frame(spark, [])).count() == 0
    assert jaccard_join.similar_components(frame(spark, [(1, None)])).collect()[0].component_id == 1


def test_jaccard_join_completes_what_the_orders_miss(spark, monkeypatch):
    rows = near_rows()
    monkeypatch.setattr(jaccard_join, "chunk_links", lambda sets, order, chunks: sets.select(F.col("fp").alias("a"), F.col("fp").alias("b")))
    got = jaccard_join.similar_components(frame(spark, rows))
    assert sorted(key((r.doc_id, r.n_shingles, r.component_id)) for r in got.collect()) == components(rows)


def family():
    """Texts of one passage: close to it, in between and far, so that most pairs are open and few are links."""
    rng, base, rows = random.Random(11), prose(77, 120).split(), []
    for k in range(40):
        words, start = list(base), rng.randrange(110)
        for x in range(2 + k % 26):
            words[(start + x) % 120] = f"v{k}x{x}"
        rows.append((500 + k, " ".join(words)))
    return rows


@pytest.mark.parametrize("pairs, hot", [(0, 1 << 11), (2, 1 << 11), (1000, 1 << 11), (2, 8)])
def test_jaccard_join_of_tokens_with_many_sets(spark, monkeypatch, pairs, hot):
    """Pairs sent on, whole sets compared where they meet, and a grid of blocks give the same components."""
    rows = near_rows() + family()
    monkeypatch.setattr(jaccard_join, "chunk_links", lambda sets, order, chunks: sets.select(F.col("fp").alias("a"), F.col("fp").alias("b")))
    monkeypatch.setattr(jaccard_join, "PAIRS_PER_SET", pairs)
    monkeypatch.setattr(jaccard_join, "HOT_SETS", hot)
    got = jaccard_join.similar_components(frame(spark, rows))
    assert sorted(key((r.doc_id, r.n_shingles, r.component_id)) for r in got.collect()) == components(rows)


def test_signature_tree_links_like_brute_force():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 63, 60).astype(np.uint64)
        for _ in range(rng.integers(1, 5)):
            sets.append(np.unique(np.concatenate([base[: rng.integers(45, 61)], rng.integers(0, 1 << 63, rng.integers(0, 12)).astype(np.uint64)])))
    rng.shuffle(sets)
    roots = link(sets)
    want = list(range(len(sets)))
    for _ in sets:
        for a in range(len(sets)):
            for b in range(a):
                if similar(sets[a], sets[b]):
                    want[a] = want[b] = min(want[a], want[b])
    assert [int(r) for r in roots] == want


def test_decontamination(spark):
    items = [(0, prose(11, 30)), (1, prose(12, 17)), (2, None), (3, ""), (4, "one two three")]
    passage, edited = items[0][1], items[1][1].split()
    edited[4:5] = ["new", "words"]
    rows = [(1, prose(20, 50) + " " + passage.upper() + " " + prose(21, 50)), (2, prose(22, 40) + " " + " ".join(edited)), (3, prose(23, 5000)), (4, None), (5, ""), (None, passage), (6, "x one two three y")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.first_word, r.n_words, r.edits) for r in decontaminate.find_passages(frame(spark, rows), benchmark).collect()}
    assert got == {(1, 0): (50, 30, 0), (2, 1): (40, 18, 2), (None, 0): (0, 30, 0), (6, 4): (1, 3, 0)}
    assert decontaminate.find_passages(frame(spark, []), benchmark).count() == 0
    assert decontaminate.find_passages(frame(spark, rows), benchmark.where("false")).count() == 0


def test_decontamination_recall():
    rng = random.Random(9)
    items = [prose(500 + k, 24 + k % 20, 5000) for k in range(60)]
    index = decontaminate.Index(list(range(60)), items)
    texts = []
    for item in items:
        words = item.split()
        for _ in range(len(words) // 8):  # half of the edits that are allowed
            words[rng.randrange(len(words))] = "edited"
        texts.append(prose(rng.random(), 80, 5000) + " " + " ".join(words) + " " + prose(rng.random(), 80, 5000))
    data, off = text_buffer(pa.array(texts))
    found = {(t, i) for t, i, *_ in index.matches(Words(data, off))}
    assert sum((k, k) in found for k in range(60)) >= 54
    assert all(t == i for t, i in found)


def nearest_stretch(item, words):
    """Least word edits from ``item`` to any stretch of ``words``, by the plain recurrence."""
    row = [0] * (len(words) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, v in enumerate(words):
            new.append(min(row[j] + (w != v), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("kind", ["substitute", "insert", "delete", "mixed"])
def test_decontamination_finds_all_at_the_limit_of_edits(kind):
    rng = random.Random(kind)
    lengths = [1, 2, 3, 4, 5, 7, 8, 12, 20, 31, 40, 60, 61, 120] * 3
    items = [prose(3000 + k, n, 5000) for k, n in enumerate(lengths)]
    index = decontaminate.Index(list(range(len(items))), items)
    texts = []
    for item in items:
        words = item.split()
        spots = rng.sample(range(len(words)), int(decontaminate.EDITS * len(words)))
        for at in sorted(spots, reverse=True):
            how = rng.choice(["substitute", "insert", "delete"]) if kind == "mixed" else kind
            words[at : at + (how != "insert")] = [] if how == "delete" else ["edited"]
        texts.append(prose(rng.random(), 40, 5000) + " " + " ".join(words) + " " + prose(rng.random(), 40, 5000))
    data, off = text_buffer(pa.array(texts))
    got = {(t, i): edits for t, i, _, _, edits in index.matches(Words(data, off))}
    want = {}
    for t, text in enumerate(texts):
        words = text.split()
        for i, item in enumerate(items):
            allowed = int(decontaminate.EDITS * lengths[i])
            if len(set(item.split()) & set(words)) + allowed >= len(set(item.split())):  # each edit takes one word at most
                edits = nearest_stretch(item.split(), words)
                if edits <= allowed:
                    want[t, i] = edits
    assert got == want
    assert all((k, k) in got for k in range(len(items)))


def test_ring_sharding(spark):
    rows = [(k // 2 if k % 3 else None, "x") for k in range(503)]
    got = ring_sharding.shard_rows(frame(spark, rows), 24).collect()
    sizes = {}
    for r in got:
        sizes.setdefault(r.shard, []).append(r.slot)
    assert len(got) == 503 and max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in sizes.values())
    assert ring_sharding.shard_rows(frame(spark, []), 24).count() == 0


def test_overflow_is_the_sequential_rule_on_counts():
    places = ring_sharding.ring(5, 8)
    owners = [s for _, s in places]
    counts = [random.Random(k).randrange(20) for k in range(40)]
    parcels = ring_sharding.overflow(counts, owners, ring_sharding.capacities(sum(counts), 5, 0.1))
    placed = [0] * 5
    for arc in range(40):
        own = sorted(p for p in parcels if p[0] == arc)
        assert [x for p in own for x in (p[1], p[2])] == sorted(x for p in own for x in (p[1], p[2]))
        assert sum(p[2] - p[1] for p in own) == counts[arc]
    for _, lo, hi, shard, _ in parcels:
        placed[shard] += hi - lo
    assert max(placed) <= ring_sharding.capacities(sum(counts), 5, 0.1)[0]


def test_few_rows_move_when_a_shard_is_added():
    ids = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 20000)

    def place(shards):
        ring = ring_sharding.ring(shards, 64)
        ends = [p for p, _ in ring]
        arc = np.searchsorted(ends, np.sort(ids)) % len(ends)
        counts = np.bincount(arc, minlength=len(ends)).tolist()
        first = np.concatenate([[0], np.cumsum(counts)])
        out = np.zeros(len(ids), int)
        rank = np.arange(len(ids)) - first[arc]
        for a, lo, hi, s, _ in ring_sharding.overflow(counts, [s for _, s in ring], ring_sharding.capacities(len(ids), shards, 0.25)):
            out[(arc == a) & (rank >= lo) & (rank < hi)] = s
        return out

    assert (place(24) != place(25)).mean() < 0.15


def test_url_filter(spark):
    urls = [None, "", "nothing", "http://A.Example.com/en/x?y#z", "https://www.example.com/en/", "http://example.net", "ftp://x.net/es/1", "a://net/fr/", "x://notexample.com/en/", "y://example.com/e", "z://" + "a." * 300 + "net/fr/q"]
    pages = spark.createDataFrame([(k % 9, u, "rule") for k, u in enumerate(urls)], "page_id long, url string, verdict string")
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"), (None, "/", "block")]
    want = []
    for k, u in enumerate(urls):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [(len(h + p), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, None, "allow"))
        want.append((k % 9, host, path, best[1], best[2]))
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = [tuple(r) for r in url_filter.judge_urls(pages, listed).collect()]
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert url_filter.judge_urls(pages, listed.where("false")).count() == len(urls)
    assert url_filter.judge_urls(pages.where("false"), listed).count() == 0


def test_language_id(spark):
    words = {"aa": "the of and with", "bb": "der die und nicht", "cc": "que los para una"}
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice(words[lang].split()) for _ in range(30)), lang) for k in range(60) for lang in words]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = ecoc_language.fit(docs)
    extra = [(0, None, "aa"), (1, "", None), (2, "123 ...", None), (3, "the and of with the", "cc")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in ecoc_language.predict(spark.createDataFrame(extra, docs.schema), model).collect()}
    assert [got[k][0] for k in range(4)] == ["und", "und", "und", "aa"] and all(0 <= s <= 1 for _, s in got.values())
    judged = ecoc_language.predict(docs, model)
    assert judged.where("lang_pred = lang").count() == len(rows)
    assert ecoc_language.fit(docs.where("false")) is None
    assert ecoc_language.predict(docs, None).where("lang_pred = 'und'").count() == len(rows)


def test_toxicity(spark):
    rng = random.Random(6)
    rows = []
    for k in range(300):
        words = prose(k, 40, 3000).split()
        if k % 5 == 0:
            words[rng.randrange(40)] = rng.choice(["Vile,", "awful!", "nasty"])
        rows.append((k, " ".join(words), int(k % 5 == 0)))
    labelled = spark.createDataFrame(rows, "id long, text string, label int")
    index = toxicity_knn.fit(labelled.select("text"), labelled)
    tests = [(0, "some nasty words here"), (1, "quite another text"), (2, None), (3, ""), (4, "VILE " + prose(9, 4000))]
    got = {r.doc_id: (r.score, r.evidence) for r in toxicity_knn.score(frame(spark, tests), index).collect()}
    assert got[0][0] >= 0.7 and got[4][0] >= 0.7 and max(got[k][0] for k in (1, 2, 3)) < 0.3 and got[0][1][0].label == 1
    nothing = toxicity_knn.fit(labelled.select("text"), labelled.where("label = 0"))
    assert toxicity_knn.score(frame(spark, tests), nothing).count() == 5


@pytest.mark.parametrize("toxic_of_six", [1, 2, 3, 4])
def test_toxicity_at_any_share_of_toxic_labels(spark, toxic_of_six):
    rng = random.Random(12)
    rows = []
    for k in range(600):
        words = prose(k, 40, 3000).split()
        if k % 6 < toxic_of_six:
            words[rng.randrange(40)] = rng.choice(["Vile,", "awful!", "nasty"])
        rows.append((k, " ".join(words), int(k % 6 < toxic_of_six)))
    labelled = spark.createDataFrame(rows, "id long, text string, label int")
    index = toxicity_knn.fit(labelled.select("text"), labelled)
    tests = [(k, prose(9000 + k, 40) + (" nasty" if k % 2 else "")) for k in range(20)]
    got = {r.doc_id: r.score for r in toxicity_knn.score(frame(spark, tests), index).collect()}
    assert all((got[k] >= 0.7) == (k % 2 == 1) for k in got)


def test_block_max_search_is_exact():
    rng = np.random.default_rng(2)
    index = toxicity_knn.BlockMaxIndex(None, np.ones(50))
    vectors = []
    for _ in range(700):
        where = np.sort(rng.choice(50, rng.integers(1, 8), replace=False))
        weight = rng.random(len(where)) + 0.1
        vectors.append((where, weight / np.linalg.norm(weight)))
    index.build(list(range(700)), [0] * 700, vectors)
    for where, weight in vectors[:40]:
        dense = np.zeros(50)
        dense[where] = weight
        every = sorted((round(float((dense[w] * x).sum()), 9) for w, x in vectors), reverse=True)[:15]
        assert [c for c, _ in index.nearest(where, weight, 15)] == pytest.approx(every)


def test_lm_scoring(spark):
    train = [(k, prose(k, 30, 40)) for k in range(30)] + [(99, None)]
    tests = [(1, None), (2, ""), (3, "w1 W2 unseen"), (3, "w1 W2 unseen"), (None, prose(77, 2000, 40)), (4, "x" * 5000)]
    work = Work(spark)
    model = context_mixing.train(frame(spark, train), work)
    got = context_mixing.score(frame(spark, tests), model, work).collect()
    counts = {}
    for _, t in train:
        for w in [*WORD.findall((t or "").lower()), None]:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    assert (model.tokens, model.types) == (n, v)
    want = []
    for i, t in tests:
        tokens = [*WORD.findall((t or "").lower()), None]
        want.append((i, len(tokens), sum(w in counts for w in tokens), round(sum(np.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in tokens), 6)))
    assert sorted(key((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6))) for r in got) == sorted(map(key, want))
    assert all(r.score < 0 for r in got)


def test_lm_start_is_learned_and_short_texts_adapt(spark):
    rng = random.Random(8)
    chain = {w: [f"w{rng.randrange(60)}" for _ in range(2)] for w in (f"w{k}" for k in range(60))}

    def text(n):
        out = ["w0"]
        while len(out) < n:
            out.append(rng.choice(chain[out[-1]]))
        return " ".join(out)

    model = context_mixing.train(frame(spark, [(k, text(50)) for k in range(300)]), Work(spark))
    mixer = model.mixer
    assert not np.allclose(mixer.start, context_mixing.FIRST_WEIGHTS) and not np.allclose(mixer.map, context_mixing.FIRST_MAP)
    data, off = text_buffer(pa.array([text(50) for _ in range(40)]))
    words = Words(data, off)
    by_hand = context_mixing.Mixer(mixer.code, mixer.odds)
    assert mixer.score(words)[0].sum() > by_hand.score(words)[0].sum()
    data, off = text_buffer(pa.array(["w1 w1 w1 w2"]))
    events = context_mixing.Events(Words(data, off), mixer.code)
    assert events.states(np.array([3, 3, 3, 40, mixer.code.end]), np.arange(5)).tolist() == [0, 4, 4, 4, 4]
    assert events.step.tolist() == [0, 1, 2, 3, 4]


def test_code_bits_are_a_proper_distribution():
    counts = np.array([50, 20, 9, 7, 4], np.int64)
    code = context_mixing.Code(np.arange(5, dtype=np.uint64), counts, 10, 3)
    total = 0.0
    for s in range(7):
        nodes, bits = (x[code.first[s] : code.first[s] + code.length[s]] for x in (code.nodes, code.bits))
        p = 1 / (1 + np.exp(-code.odds[nodes].astype(float)))
        total += np.prod(np.where(bits == 1, p, 1 - p)) * 10 ** code.tail[s]
    assert total == pytest.approx(1, abs=1e-6)


def test_lm_sends_the_code_as_its_tree_and_the_tables_once(spark, monkeypatch):
    sent, plain = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: sent.append(len(pickle.dumps(value, 5))) or plain(value))
    docs, work = frame(spark, [(k, prose(k, 60, 40)) for k in range(30)]), Work(spark)
    model = context_mixing.train(docs, work)
    assert context_mixing.score(docs, model, work).count() == 30
    code = model.mixer.code
    cells = code.inner + (1 << context_mixing.NEAR_BITS) + (2 << context_mixing.RICH_BITS)
    assert sum(sent) < 9 * cells  # two counts of four bytes a cell, and little more
    many = context_mixing.Code(np.arange(5000, dtype=np.uint64), np.arange(5000, 0, -1), 10, 3)
    blob = pickle.dumps(many, 5)
    assert len(blob) < 50 * 5000
    again = pickle.loads(blob)
    for name in ("nodes", "bits", "depth", "first", "length", "tail", "odds"):
        assert np.array_equal(getattr(again, name), getattr(many, name))


def test_lm_score_and_counts_equal_a_plain_walk_over_the_bits(spark):
    """Blocks of few bits, texts of unlike length, coded and spelled words."""
    texts = [prose(k, n, 40) + " Once\u00e9 rare%d" % k for k, n in enumerate([1, 3, 700, 40, 5, 60])] + ["", None]
    model = context_mixing.train(frame(spark, list(enumerate(texts))), Work(spark))
    mixer, code = model.mixer, model.mixer.code
    data, off = text_buffer(pa.array(texts))
    words = Words(data, off)
    events = context_mixing.Events(words, code)
    cells = [np.zeros((len(t), 2), np.int64) for t in mixer.odds]
    want = []
    for d in range(len(texts)):
        weights, hits = mixer.start.astype(float).copy(), mixer.map.astype(float) * context_mixing.APM_TRUST
        seen, points = np.full(len(hits), context_mixing.APM_TRUST), 0.0
        for token in np.flatnonzero(events.doc == d):
            kind, place, stated, followed, _ = events.expand(slice(token, token + 1))
            moves = []
            for k, at in zip(kind.tolist(), zip(events.node[place], stated, followed)):
                g, y = divmod(k, 2)
                for table, c in zip(cells, at):
                    table[c, y] += 1
                x = np.array([odds[c] for odds, c in zip(mixer.odds, at)], float)
                dot = min(max(float(weights[g] @ x), -12), 12)
                p = 1 / (1 + np.exp(-dot))
                c = g * context_mixing.APM_CELLS + int((min(max(dot, -8), 8) + 8) * (context_mixing.APM_CELLS - 1) / 16 + 0.5)
                q = 0.65 * p + 0.35 * hits[c] / seen[c]
                points += np.log10(q if y else 1 - q)
                moves.append((g, (y - p) * context_mixing.RATE * x, c, y))
            for g, move, c, y in moves:
                weights[g] += move
                hits[c] += y
                seen[c] += 1
            points += code.tail[events.token_symbol[token]]
        want.append(points)
    assert mixer.score(words)[0] == pytest.approx(want, rel=1e-5)
    rows = events.lengths()
    assert rows.sum() == cells[0].sum() and len(list(context_mixing.blocks(np.append(0, np.cumsum(rows)), 50))) > 20
    counts = model.parts[1].value
    for table, got in zip(cells, counts):
        assert np.array_equal(table.ravel(), got)


def test_token_ids_by_chunks_equal_whole_texts():
    texts = ["héllo's x y <|endoftext|> don't 12a3 \x1c q́ ﬁ é Å", "", "a\x0bb\x85c İx", BASE]
    data, off = text_buffer(pa.array(texts))
    ids, bound = ChunkEncoder(tokenizer()).encode(data, off)
    whole = load(tokenizer())
    for k, t in enumerate(texts):
        assert ids[bound[k] : bound[k + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids


def all_ids(rows):
    whole = load(tokenizer())
    return [(i, whole.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows]


def test_token_ids_of_cut_and_lower_cased_chunks_equal_whole_texts():
    """Chunks end at ASCII punctuation and are known lower-cased; apostrophes, odd letters and combining marks are no places to cut."""
    some = random.Random(5)
    alphabet = "aAbZ s't'RE ll üßΣσİıſ Ⅷ\u0338\u0301<>=.,' 12٣\t\n\u00a0中文😀\u200d-_`^$|<|endoftext|>"
    texts = ["", "Word WORD word. (word) word's", *("".join(some.choice(alphabet) for _ in range(some.randrange(30))) for _ in range(3000))]
    data, off = text_buffer(pa.array(texts))
    encoder, whole = ChunkEncoder(tokenizer()), load(tokenizer())
    assert encoder.cuts and encoder.lower and encoder.whole
    for _ in range(2):  # the second time from the cache
        ids, bound = encoder.encode(data, off)
        for k, text in enumerate(texts):
            assert ids[bound[k] : bound[k + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_packing(spark):
    got = packing.pack(frame(spark), tokenizer(), 256).collect()
    lengths = {}
    for r in got:
        lengths.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in lengths.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 256
    want = []
    for i, ids in all_ids(TEXTS):
        want += [(i, s, zlib.crc32(np.array(ids[s : s + 256], "<u4").tobytes()), len(ids)) for s in range(0, len(ids), 256)]
    assert sorted(key((r.doc_id, r.start, r.ids_crc32, r.doc_tokens)) for r in got) == sorted(map(key, want))
    assert packing.pack(frame(spark, []), tokenizer()).count() == 0


def test_column_generation_is_near_the_bound():
    rng = np.random.default_rng(1)
    counts = {int(k): int(v) for k, v in zip(*np.unique(rng.integers(1, 65, 5000), return_counts=True))}
    plan = packing.plan_sequences(counts, 64)
    assert sum(hi - lo for _, lo, hi, _, _ in plan) == 5000
    used = max(first - (lo - hi) // n for _, lo, hi, first, n in plan)
    assert used <= 1.02 * sum(k * v for k, v in counts.items()) / 64 + 2


def test_training_order_round_trip(spark):
    where, manifest, folder = training_order.materialise(frame(spark), tokenizer(), key=5, length=64, slots=16)
    pieces = where.collect()
    total = manifest.agg(F.sum("n_sequences")).first()[0]
    assert sorted({r.slot for r in pieces}) == list(range(total))
    rows = list(training_order.read_slots(folder, 0, total, 64, 16))
    back = sorted(key((r.doc_id, r.start, *rows[r.slot][r.offset : r.offset + r.length].tolist())) for r in pieces)
    wanted = {}
    for i, ids in all_ids(TEXTS):
        wanted.setdefault(i, []).append(ids)
    for r in pieces:
        assert any(rows[r.slot][r.offset : r.offset + r.length].tolist() == ids[r.start : r.start + r.length] for ids in wanted[r.doc_id])
    assert len(back) == len(pieces) and sum(r.length for r in pieces) == sum(len(ids) for own in wanted.values() for ids in own)
    assert training_order.materialise(frame(spark, []), tokenizer())[0].count() == 0


@pytest.mark.parametrize("total", [1, 2, 3, 100, 1025])
def test_slots_are_a_permutation(total):
    numbers = np.arange(total)
    slots = training_order.slot_of(numbers, total, 42)
    assert sorted(slots.tolist()) == list(range(total))
    assert training_order.slot_of(slots, total, 42, undo=True).tolist() == numbers.tolist()
