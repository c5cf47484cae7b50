"""Rows that repeat an id, long texts and items, calibration: against brute force."""

import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import decontamination as DC
from candlewick.llm import embedding_dedup as ED
from candlewick.llm import language_id as LI
from candlewick.llm import minhash_dedup as MH
from candlewick.llm.common import prepare
from candlewick.llm.components import components
from tests.llm.test_small import prose, shingles, table
from tests.llm.test_pipeline import without_leaks


@pytest.fixture(scope="module")
def ready(spark):
    prepare(spark)
    return spark


def groups(keys, near):
    """The smallest root of each key under links."""
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in near:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {k: find(k) for k in keys}


def similar(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def test_minhash_rows_that_repeat_an_id(ready):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (5, a), (5, c), (5, c), (9, c + " x"), (7, None), (7, ""), (None, a), (4, prose(4, 3)), (4, prose(4, 3).upper())]
    r = random.Random(3)
    rows += [(r.randint(20, 30), prose(10 + r.randint(0, 9), 40) + r.choice(["", " tail", " other tail"])) for _ in range(60)]
    docs = table(ready, [t for _, t in rows], [i for i, _ in rows])
    sets = [shingles(t) for _, t in rows]
    able = [k for k, (i, _) in enumerate(rows) if i is not None and sets[k]]
    # vertices are rows; rows of one set are one class
    root = groups(able, [(x, y) for x in able for y in able if x < y and similar(sets[x], sets[y])])
    lowest = defaultdict(lambda: 1 << 60)
    for k in able:
        lowest[root[k]] = min(lowest[root[k]], rows[k][0])
    want = Counter((i, len(sets[k]), lowest[root[k]] if k in root else i) for k, (i, _) in enumerate(rows))
    got = Counter((x.doc_id, x.n_shingles, x.component_id) for x in MH.near_duplicates(docs).collect())
    assert got == want
    kept = Counter((x.doc_id, x.text) for x in MH.minhash_dedup(docs).collect())
    assert kept == Counter((i, t) for k, (i, t) in enumerate(rows) if k not in root or lowest[root[k]] == i)
    assert (5, c) in kept and (1, a) in kept and (5, a) not in kept


def test_embeddings_that_repeat_an_id(ready):
    r = np.random.default_rng(4)
    base = r.normal(size=(6, 16))
    rows = [(k, base[k % 6] + 0.02 * r.normal(size=16)) for k in range(30)]
    rows += [(1, base[4]), (1, base[1]), (2, base[0]), (2, base[0]), (7, base[0]), (40, r.normal(size=16))]
    frame = ready.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    x = np.array([v / np.linalg.norm(v) for _, v in rows])
    near = x @ x.T >= 0.95
    root = groups(range(len(rows)), [(a, b) for a in range(len(rows)) for b in range(a) if near[a, b]])
    lowest = defaultdict(lambda: 1 << 60)
    for k, (i, _) in enumerate(rows):
        lowest[root[k]] = min(lowest[root[k]], i)
    want = Counter((i, int(near[k].sum()) - 1, lowest[root[k]]) for k, (i, _) in enumerate(rows))
    assert Counter((v.vec_id, v.n_links, v.component_id) for v in ED.near_embeddings(frame).collect()) == want


def test_components_of_random_links(ready):
    r = random.Random(9)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(330)] + [(1000 + k, 1001 + k) for k in range(50)]
    frame = ready.createDataFrame(links, "a long, b long").repartition(7)
    got = {x.vertex: x.root for x in components(frame).collect()}
    want = groups({v for link in links for v in link}, links)
    assert got == {v: t for v, t in want.items() if v != t}


# ------------------------------------------------------------------ decontamination


def plain_words(text):
    import re

    return [w for w in re.split(r"[^A-Za-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def plain_leaks(texts, items):
    """The best window of each document and item, the first of equally good ones."""
    found = set()
    for i, t in texts:
        w = plain_words(t)
        for j, item in items:
            own = plain_words(item)
            k = min(5, len(own))
            if not own or len(w) < k:
                continue
            runs = [tuple(w[x : x + k]) for x in range(len(w) - k + 1)]
            wanted = Counter(tuple(own[x : x + k]) for x in range(len(own) - k + 1))
            m, best = sum(wanted.values()), (0, 0, 0)
            for start in range(len(runs)):
                window = runs[start : start + m]
                shared = sum((Counter(window) & wanted).values())
                s = shared / (m + len(window) - shared)
                if s > best[2]:
                    best = (start, len(window) + k - 1, s)
            if best[2] >= 0.75:
                found.add((i, j, best[0], best[1], round(best[2], 9)))
    return found


def test_leaks_equal_brute_force(ready):
    r = random.Random(12)
    items = [(k, prose(200 + k, n)) for k, n in enumerate([7, 12, 15, 15, 40, 40, 90])] + [(20, "a b a b a b a b a b c"), (21, "one two"), (22, None), (21, "one two"), (None, prose(204, 40))]
    texts = []
    for k in range(120):
        words = prose(300 + k, r.randint(0, 60)).split()
        for _ in range(r.randint(0, 3)):
            part = (r.choice(items)[1] or "").split()
            for _ in range(r.randint(0, 3)):
                if part:
                    part[r.randrange(len(part))] = r.choice(["x", "y", part[0]])
            at = r.randint(0, len(words))
            words[at:at] = part[: r.randint(len(part) // 2, len(part))] if r.random() < 0.3 else part
        texts.append((k, r.choice([" ", ", "]).join(words)))
    texts += [(160, "a b " * 40 + "c"), (160, items[3][1]), (None, items[4][1] * 2), (161, None), (162, "")]
    docs = table(ready, [t for _, t in texts], [i for i, _ in texts])
    bench = ready.createDataFrame(items, "item_id long, text string")
    want = plain_leaks(texts, items)
    assert len(want) > 40
    for max_bytes in (DC.MAX_BYTES, 300):
        got = {(x.doc_id, x.item_id, x.start_word, x.n_words, round(x.similarity, 9)) for x in DC.leaks(docs, bench, max_bytes).collect()}
        assert got == want, (got - want, want - got)
    kept = {x.text for x in DC.decontaminate(docs, bench).collect()}
    clean = {k: t for k, (_, t) in enumerate(texts) if (texts[k][0]) not in {w[0] for w in want} or not plain_leaks([texts[k]], items)}
    assert kept == set(clean.values())
    assert without_leaks({k: t or "" for k, (_, t) in enumerate(texts)}, [t for _, t in items if t and len(plain_words(t)) >= 5]).keys() >= set()


def test_a_long_repeated_item_takes_bounded_time_and_memory():
    import tracemalloc

    item = prose(77, 2_000)
    items = DC.prepare_items([(1, item)])
    text = [(" ".join([item] * 20)).encode()]
    tracemalloc.start()
    began = time.process_time()
    found = list(DC.find_leaks(text, items))
    took, peak = time.process_time() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(i, s) for _, i, _, _, s in found] == [(1, 1.0)]
    assert took < 10 and peak < 120_000_000  # seconds of a slow machine, with tracing


@pytest.mark.parametrize("words", [7, 11, 15, 25, 60, 400])
def test_radius_keeps_similar_windows_of_all_lengths(words):
    """Pairs of equally long windows at similarity 0.75 or a little above: none is outside the radius."""
    r = np.random.default_rng(words)
    m = words - 4
    most = int(np.floor(m * 0.25 / 1.75 + 1e-9))  # shingles that may differ
    own = r.integers(0, 2**63, (2_000, m), np.uint64)
    other = own.copy()
    for row in other:
        row[r.choice(m, most, replace=False)] = r.integers(0, 2**63, most, np.uint64)
    ends = np.arange(1, 2_001) * m
    a, b = (DC.fingerprints(x.ravel(), ends - m, ends) for x in (own, other))
    assert (np.bitwise_count(a ^ b) > DC.RADIUS).sum() == 0


# ------------------------------------------------------------------ language identification


def test_long_texts_are_scored_whole(ready):
    docs = table(ready, [prose(k, 200) for k in range(60)]).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd"))
    model = LI.fit(docs).prepared()
    text = prose(99, 90_000)
    stream, start, end = LI.symbols([text])
    at = np.arange(start[0], end[0])
    whole = -model.log_probabilities(stream, at).astype(np.float64).sum(axis=0) / len(at)
    entropy, count = model.cross_entropies([text, "short one", text])
    assert count.tolist() == [len(at), len("short one") + 2, len(at)]
    assert np.allclose(entropy[0], whole, rtol=1e-9) and np.allclose(entropy[2], entropy[0], rtol=1e-12)


def test_rejection_is_not_widened_by_one_noisy_label(ready):
    r = random.Random(5)
    noise = "".join(r.choice("qxzjwv kyh") for _ in range(600))
    texts = [prose(k, 120) for k in range(400)]
    docs = lambda more: table(ready, texts + more).withColumn("lang", F.lit("en"))
    clean, noisy = (LI.fit(docs(more)).prepared() for more in ([], [noise]))
    assert abs(clean.band[0] - noisy.band[0]) < 0.2
    junk = ["".join(r.choice("qxzjwv kyh") for _ in range(500)), "Все счастливые семьи похожи друг на друга " * 6]
    for model in (clean, noisy):
        assert [x[3] for x in model.predict(junk)] == [True, True]
        assert sum(x[3] for x in model.predict([prose(1000 + k, 80) for k in range(100)])) == 0
