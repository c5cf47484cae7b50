"""The corpus pipeline against a plain Python version of its five stages."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
from tests.conftest import SF_SMALL
from .test_small import shingles

from candlewick.llm import language_id as LI
from candlewick.llm.common import prepare, table
from candlewick.llm.queries import tokenizer
from candlewick.llm.tokens import PieceEncoder


def without_repeated_lines(texts):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in texts.items():
        for line in t.split("\n"):
            holders[key(line)].add(i)
    gone = {k: max(d) for k, d in holders.items() if len(k) >= 40 and len(d) >= 5}
    return {i: "\n".join(x for x in t.split("\n") if gone.get(key(x), i) == i) for i, t in texts.items()}


def one_of_each_group(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: t for i, t in texts.items() if find(i) == i}


def without_leaks(texts, items):
    def words(text):
        return [w for w in re.split(r"[^A-Za-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]

    def counts(w):
        return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))

    wanted = [words(t) for t in items if t]

    def leaks(text):
        w = words(text)
        every = set(counts(w))
        for item in wanted:
            own = counts(item)
            if len(every & set(own)) < 0.75 * len(own):
                continue
            for start in range(max(1, len(w) - 4)):
                window = counts(w[start : start + len(item)])
                if sum((own & window).values()) >= 0.75 * sum((own | window).values()):
                    return True
        return False

    return {i: t for i, t in texts.items() if not leaks(t)}


def test_pipeline_equals_plain_python(spark):
    prepare(spark)
    docs = table(spark, SF_SMALL, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = LI.fit(docs).prepared()
    found = model.predict([t or "" for t in rows.values()])
    texts = {i: t for (i, t), f in zip(rows.items(), found, strict=True) if not f[3]}
    assert len(texts) >= 0.98 * len(rows)
    texts = one_of_each_group(without_repeated_lines(texts))
    texts = without_leaks(texts, [r.text for r in table(spark, SF_SMALL, "benchmark").collect()])
    encoder = PieceEncoder(tokenizer("word_bpe_49k.json"))
    want = {i: encoder.library(t) + (2).to_bytes(4, "little") for i, t in texts.items()}

    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, SF_SMALL).collect():
        got[r.doc_id].append(r)
    assert set(got) == set(want)
    for i, pieces in got.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(want[i]) // 4
            assert p.ids_crc32 == zlib.crc32(want[i][4 * at : 4 * (at + p.length)])
            at += p.length
        assert at == len(want[i]) // 4
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    first = corpus_pipeline.STAGES[0][1](spark, docs, SF_SMALL)
    assert first.columns == docs.columns
