"""Spelling variants, importance resampling and language-model scoring against plain Python."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import hmm_scoring as HM
from candlewick.llm import importance_resampling as IR
from candlewick.llm import spelling_variants as SV
from candlewick.llm.common import prepare
from candlewick.llm.running_crc import RunningCrc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "id word n form root rank score weight bucket cell side at part learn block class held_out"


@pytest.fixture(scope="module")
def ready(spark):
    prepare(spark)
    return spark


def table(spark, texts, ids=None, more=""):
    rows = [(i, t, "en", "src", len(t or "")) for i, t in zip(range(len(texts)) if ids is None else ids, texts, strict=True)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in more.split():
        frame = frame.withColumn(name, F.lit("x"))
    return frame.repartition(3)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ------------------------------------------------------------------ importance resampling


def test_crc_of_substrings():
    r = random.Random(1)
    for size in (0, 1, 5, 1023, 1024, 1025, 5000, 70_000):
        data = bytes(r.randrange(256) for _ in range(size))
        crc = RunningCrc(np.frombuffer(data, np.uint8))
        a = np.array([r.randint(0, size) for _ in range(200)] + [0, size])
        b = np.array([r.randint(x, size) for x in a])
        got = crc.between(crc.at(a), crc.at(b), b - a)
        assert got.tolist() == [zlib.crc32(data[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)]


def plain_features(text):
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text)) if x]
    return len(w), Counter(zlib.crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1))


def plain_resampling(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s += plain_features(text)[1]
    for text in target:
        t += plain_features(text)[1]
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10_000) / ((s[b] + 1) * (n_t + 10_000))))
    out = []
    for i, text in rows:
        words, features = plain_features(text)
        weight = sum(n * gain(b) for b, n in features.items())
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, words, sum(features.values()), weight, score])
    able = sorted((-r[4], r[0]) for r in out if r[1] >= 20 and r[0] is not None)
    rank = {x: k + 1 for k, x in enumerate(able[: 5 * len(able) // 100])}
    return [(r[0], r[2], r[3], r[4], rank.get((-r[4], r[0])) if r[4] is not None and r[1] >= 20 else None) for r in out]


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))


def test_resampling_equals_plain_python(ready):
    r = random.Random(2)
    words = ["alpha", "Beta", "é", "12x", "日本", "gamma-delta", "z" * 1500, "\x00", "I"]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(180)] + [None, "", " .,", "x" * 200_000, " ".join(["one"] * 20_000)]
    ids = list(range(len(texts)))
    ids[3] = None
    target = ["alpha beta 日本", None, "alpha é é alpha"]
    docs = table(ready, texts, ids, CLASHING)
    frame = IR.resample(docs, ready.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string"))
    got = [tuple(x) for x in frame.select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert order(got) == order(plain_resampling(list(zip(ids, texts, strict=True)), target))
    drawn = IR.importance_resampling(docs, ready.createDataFrame([(t,) for t in target], "text string"))
    assert drawn.columns == docs.columns
    assert {x.doc_id for x in drawn.collect()} == {x[0] for x in got if x[4] is not None}


def test_resampling_repeats_and_empty_tables(ready):
    texts = [" ".join(f"w{i % 7}" for i in range(25))] * 60 + ["other words " * 15] * 20
    ids = [k // 2 for k in range(60)] + [k for k in range(20)]  # rows that repeat an id, with equal and with other texts
    docs, target = table(ready, texts, ids), ready.createDataFrame([("w1 w2",)], "text string")
    got = [tuple(x) for x in IR.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert len(got) == 80 and sorted(x[4] for x in got if x[4]) == [1, 2, 3, 4]
    ranks = sorted((x[4], -x[3], x[0]) for x in got if x[4])
    assert ranks == sorted(ranks, key=lambda x: x[1:])
    assert max(x[3] for x in got if x[4] is None) <= -ranks[-1][1]
    assert IR.resample(docs.limit(0), target).count() == 0
    assert IR.resample(docs, target.limit(0)).count() == 80


# ------------------------------------------------------------------ spelling variants


def plain_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower(text)):
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 97 == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts):
    near = {w: [x for x in counts if abs(len(x) - len(w)) <= 1 and one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


@pytest.mark.parametrize("cell", [16_384, 10])
def test_variants_equal_plain_python(ready, cell):
    r = random.Random(4)
    base = ["".join(r.choice("abcdeé") for _ in range(r.randint(5, 8))) for _ in range(120)] + ["aaaaa", "aaaaaa", "aaaaaaa", "ÀÉéàß", "zzzzzzz"]
    texts = []
    for _ in range(300):
        words = []
        for _ in range(40):
            w = r.choice(base[: r.randint(1, len(base))])
            if r.random() < 0.3:
                k = r.randrange(len(w))
                w = r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice("abcdeéz") + w[k:], w[:k] + r.choice("abcdeéz") + w[k + 1 :]])
            words.append(w.upper() if r.random() < 0.1 else w)
        texts.append(r.choice([" ", "-", "7 "]).join(words))
    long = "q" * 3000
    texts += [None, "", "12 34", f"{long} {long} {long} {long}x {long}x {long}x"] + ["ties tieso tiesa " * 3, "ties tieso tiesa"]
    ids = list(range(len(texts)))
    ids[5], ids[7] = None, ids[6]  # a null id, a repeated id
    counts = plain_words(list(zip(ids, texts, strict=True)))
    assert len(counts) > 300
    got = SV.spelling_variants(table(ready, texts, ids, CLASHING), cell=cell)
    rows = [tuple(x) for x in got.collect()]
    assert len(rows) == len(counts) and set(rows) == plain_variants(counts)
    if cell == 10:
        trees = SV.upper_trees(SV.word_counts(table(ready, texts, ids)), cell)
        assert max(len(nodes) for _, nodes in trees.values()) > 8  # several levels of cells


def test_variants_hot_letters_and_chains(ready):
    # one point for all anagrams, and a chain of forms
    anagrams = ["".join(p) for p in itertools.permutations("abcdef")][:500]
    text = " ".join(a + " " + a + " " + a for a in anagrams)
    chain = " ".join(w for k in range(7) for w in ["b" * (12 - k)] * (3 * 2**k))
    rows = [(None, text), (None, chain)]
    got = {tuple(x) for x in SV.spelling_variants(table(ready, [text, chain], [None, None]), cell=100).collect()}
    assert got == plain_variants(plain_words(rows))
    assert ("bbbbbbbbbbbb", "bbbbbbbbbbb", "bbbbbb", 3, 1, 6) in got


def test_variants_empty(ready):
    empty = table(ready, ["x"]).limit(0)
    assert SV.spelling_variants(empty).collect() == []
    assert SV.spelling_variants(table(ready, [None, "", "one two"])).collect() == []


# ------------------------------------------------------------------ language-model scores


def small_model(seed=5, classes=6, states=3):
    r = np.random.default_rng(seed)
    start, move, emit = r.random(states), r.random((states, states)), r.random((classes, states))
    return HM.Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def paths(model, sequence):
    """(probability with the sequence, path) of each path of states."""
    for path in itertools.product(range(len(model.start)), repeat=len(sequence)):
        p = model.start[path[0]] * model.emit[sequence[0], path[0]]
        for a, b, c in zip(path, path[1:], sequence[1:], strict=False):
            p *= model.move[a, b] * model.emit[c, b]
        yield p, path


def test_forward_recursion_sums_all_paths():
    model, r = small_model(), random.Random(6)
    texts = [[r.randrange(6) for _ in range(n)] for n in (1, 2, 3, 4, 5, 6, 7, 8)]
    tokens, sizes = np.array(sum(texts, []), np.int32), np.array([len(t) for t in texts], np.int64)
    want = [math.log10(sum(p for p, _ in paths(model, t))) for t in texts]
    for span in (1, 2, 3, 64):
        for at_once in (1, 2_000):
            got = model.log10(tokens, sizes, np.arange(6), span, at_once)
            assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_long_sequences_do_not_underflow():
    model = small_model()
    tokens = np.random.default_rng(1).integers(0, 6, 50_000).astype(np.int32)
    sizes = np.array([49_999, 1], np.int64)
    alpha, want = model.start, 0.0
    for t, c in enumerate(tokens[:-1].tolist()):
        alpha = (alpha if t == 0 else alpha @ model.move) * model.emit[c]
        want += math.log10(alpha.sum())
        alpha = alpha / alpha.sum()
    assert abs(model.log10(tokens, sizes, np.arange(6))[0] - want) < 1e-6


def test_expected_counts_are_those_of_all_paths():
    model = small_model()
    texts = [[0, 3, 3, 1], [2], [5, 4, 0]]
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))
    for t in texts:
        total = sum(p for p, _ in paths(model, t))
        for p, path in paths(model, t):
            start[path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                move[a, b] += p / total
            for c, s in zip(t, path, strict=True):
                emit[c, s] += p / total
    numbers, _, _ = HM.spans_of(np.array(sum(texts, []), np.int32), np.array([4, 1, 3]), 4)
    got = model.expected(numbers)
    for have, want in zip(got, (start, move, emit), strict=True):
        assert np.allclose(have, want, rtol=0, atol=1e-12)


def plain_base(rows):
    words = {k: [w for w in re.split(r"[\x20\x09-\x0D]+", lower(t)) if w] + [None] for k, (_, t) in enumerate(rows)}
    learned = [k for k, (i, _) in enumerate(rows) if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for k in learned for w in words[k])
    n, v = sum(c.values()), len(c)
    out = []
    for k, (i, _) in enumerate(rows):
        held = None if i is None else k not in set(learned)
        out.append((i, held, len(words[k]), sum(c[w] > 0 for w in words[k]), n, round(sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in words[k]), 6)))
    return out


def learn():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2


def mixture(seed, n):
    """Texts in two 'languages' of 60 words each."""
    r = random.Random(seed)
    tongues = [[f"{p}{r.randrange(10**4):04d}".translate(str.maketrans("0123456789", "aeioulmnst")) for _ in range(60)] for p in "kz"]
    return [" ".join(r.choice(tongues[k % 2]) for _ in range(r.randint(1, 150))) for k in range(n)]


@pytest.mark.parametrize("block", [HM.BLOCK, 2_000])
def test_scores_base_and_gain_on_held_out_texts(ready, block):
    texts = mixture(7, 200) + [None, "", " \t\x0b", "Never-Seen 0x1 Été", "x" * 100_000, " ".join(["repeat"] * 3_000)]
    ids = list(range(len(texts)))
    ids[8], ids[10] = None, ids[9]
    rows = list(zip(ids, texts, strict=True))
    found = HM.hmm_scores(table(ready, texts, ids, CLASHING), learn(), states=4, own=64, signatures=16, iterations=8, block=block).collect()
    got = [(r.doc_id, None if r.learned is None else not r.learned, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found]
    assert order(got) == order(plain_base(rows))
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    held = [r for r in found if r.learned is False and r.doc_id < 200]
    # two languages: at least half a bit per token better than the counts alone
    assert sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held) > 0.5 * math.log10(2)


def test_classes_and_shares_sum_to_one(ready):
    docs = table(ready, mixture(3, 60) + ["rare1 rare2 odd-one x9"])
    blocks = HM.tokenised(docs, F.lit(True))
    words = HM.word_table(blocks, own=20, signatures=8)
    n, v = HM.class_sums(words, 28)
    shares = Counter()
    for r in words.collect():
        shares[r["class"]] += 1.0 if r["class"] < 20 else (r.n + 1) / (n[r["class"]] + v[r["class"]] + 1)
    for c, share in shares.items():
        assert abs(share - (1 if c < 20 else 1 - 1 / (n[c] + v[c] + 1))) < 1e-9
    model = HM.iterate(HM.with_counts(blocks, words), HM.first_model((n + 1) / (n + 1).sum(), 3), 8)
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1) and abs(model.start.sum() - 1) < 1e-9


def test_likelihood_grows_with_each_iteration(ready):
    blocks = HM.tokenised(table(ready, mixture(9, 80)), F.lit(True))
    words = HM.word_table(blocks, own=200, signatures=8)
    counted = HM.with_counts(blocks, words)
    n, v = HM.class_sums(words, 208)
    model, totals = HM.first_model((n + HM.LIGHT) / (n + HM.LIGHT).sum(), 3), []
    for _ in range(4):
        # spans longer than any text: sequences are whole texts, as in scoring
        totals.append(sum(r.score for r in HM.score_texts(counted, model, n, v, 200, 256).collect()))
        model = HM.iterate(counted, model, 256)
    assert totals == sorted(totals)


def test_scores_empty_and_nothing_to_learn_from(ready):
    docs = table(ready, ["a b", None, "c"])
    assert HM.hmm_scores(docs.limit(0), learn(), own=8, signatures=4, iterations=1).collect() == []
    rows = HM.hmm_scores(docs, F.lit(False), own=8, signatures=4, iterations=1).collect()
    assert [r.n_known for r in rows] == [0, 0, 0] and {r.train_tokens for r in rows} == {0} and all(math.isfinite(r.score) for r in rows)
