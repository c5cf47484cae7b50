"""Each operator on small tables: results against brute force, and nulls, empty and long texts, repeats, clashing columns, empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import decontamination as DC
from candlewick.llm import embedding_dedup as ED
from candlewick.llm import language_id as LI
from candlewick.llm import line_dedup as LD
from candlewick.llm import minhash_dedup as MH
from candlewick.llm import packing as PK
from candlewick.llm import pii as PI
from candlewick.llm import substring_dedup as SD
from candlewick.llm import token_files as TF
from candlewick.llm import warc as WA
from candlewick.llm.common import prepare
from candlewick.llm.components import components
from candlewick.llm.queries import tokenizer
from candlewick.llm.shared_files import open_input
from candlewick.llm.tokens import PieceEncoder

BYTES, WORDS49 = "byte_bpe_50k.json", "word_bpe_49k.json"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
random.seed(5)
VOCABULARY = ["".join(random.choice("abcdefghijklmnoprstuvw") for _ in range(random.randint(2, 9))) for _ in range(3000)]


@pytest.fixture(scope="module")
def ready(spark):
    prepare(spark)
    return spark


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(words))


def table(spark, texts, ids=None, more=""):
    """A documents table; ``more`` adds columns whose names the operators use themselves."""
    rows = [(i, t, "en", "src", len(t or "")) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in more.split():
        frame = frame.withColumn(name, F.lit("x"))
    return frame.repartition(3)


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def shingles(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


ODD = [None, "", " \n\t ", "one two three", "ONE two\x0bthree", "x" * 30_000, prose(1, 9000)]

# ----------------------------------------------------------------- tokens, files, packing

TRICKY = [
    "", " ", "  a", "it's 'tis o'clock ''s", "a  b   c\n\n\nd\n e", "\n", "foo.Bar,baz 12abc34 x", "naïve café Ωmega İstanbul ﬁ", "<|endoftext|> a", "tab\tx  y",
    "é combining", "日本語 text", "a'b c' d", "don't DON'T we'll", "…“quoted”— dash", "x" * 500, "1 2 3 4", "\r\n mixed \x0b",
]


@pytest.mark.parametrize("file", [BYTES, WORDS49])
def test_pieces_give_the_library_ids(file):
    own = PieceEncoder(tokenizer(file), cache_words=50, cache_pieces=50)
    texts = TRICKY + [prose(s, 60) for s in range(20)] + ["".join(random.choice(" \n'aB.é,1\t") for _ in range(40)) for _ in range(400)]
    for text in texts:
        assert own.encode(text) == own.library(text), repr(text)


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31, 32])
def test_bit_packing_round_trip(bits):
    for count in (0, 1, 63, 64, 65, 1000):
        ids = np.random.default_rng(count).integers(0, 1 << bits, count, np.uint64).astype(np.uint32)
        packed = TF.pack(ids, bits)
        assert len(packed) == -(-count // 64) * bits
        assert (TF.unpack(packed, bits, count) == ids).all()


def test_token_files(ready):
    texts = [*ODD, *TRICKY, "dup", "dup"]
    ids = [*range(len(texts) - 2), 3, 3]
    docs = table(ready, texts, ids, "start path part").unionByName(table(ready, ["null id"], [None], "start path part"))
    manifest = TF.write_ids(docs, tokenizer(BYTES), block_ids=64)
    got = sorted(TF.read_ids(manifest, with_ids=True).collect(), key=lambda r: r.start)
    own = PieceEncoder(tokenizer(BYTES))
    assert [r.doc_id for r in got] == sorted([*ids, None], key=lambda i: -1 if i is None else i)
    want = defaultdict(list)
    for i, t in [*zip(ids, texts, strict=True), (None, "null id")]:
        want[i].append(list(np.frombuffer(own.library(t or ""), "<u4")) + [0])
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids) and list(r.ids) in want[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    first = TF.IdFile(open_input(manifest.orderBy("part").first().path))
    assert (first.read(70, 200) == np.concatenate([r.ids for r in got])[70:200]).all() if first.ids >= 200 else True
    assert TF.read_ids(TF.write_ids(docs.limit(0), tokenizer(BYTES))).count() == 0


def test_packing_covers_all_tokens_without_padding(ready):
    texts = [*ODD, *TRICKY, *[prose(s, 40 * s) for s in range(40)]]
    docs = table(ready, texts, None, "start length sequence_id")
    got = PK.pack_documents(docs, tokenizer(WORDS49), with_ids=True, pool=PK.Pool(items=8, tokens=5000)).toPandas()
    own = PieceEncoder(tokenizer(WORDS49))
    for i, part in got.sort_values(["doc_id", "start"]).groupby("doc_id"):
        ids = own.library(texts[i] or "") + (2).to_bytes(4, "little")
        assert b"".join(part.ids) == ids and (part.doc_tokens == len(ids) // 4).all()
        assert part.start.tolist() == [0, *part.length.cumsum().tolist()[:-1]]
    for _, part in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        total = part.length.sum()
        assert part.offset.tolist() == [0, *part.length.cumsum().tolist()[:-1]]
        assert total <= 4096 and total & (total - 1) == 0 and len(part) <= 64
    assert PK.pack_documents(docs.limit(0), tokenizer(WORDS49)).count() == 0


def test_packer_keeps_all_three_limits():
    r = random.Random(3)
    for limits in (PK.Limits(64, 3, 20), PK.Limits(100, 64, 100), PK.Limits(32, 1, 5)):
        packer = PK.Packer(limits)
        items = {k: (n := r.randint(1, 150), r.randint(0, n)) for k in range(60)}
        packer.add([(k, n, p) for k, (n, p) in items.items()])
        seen = defaultdict(list)
        while packer.waiting:
            sequence = packer.pop()
            total = sum(n for _, _, n in sequence)
            loss = sum(max(0, s + n - max(s, items[k][1])) for k, s, n in sequence)
            assert 0 < total <= limits.tokens and len(sequence) <= limits.segments and loss <= limits.loss
            assert total == limits.tokens or total & (total - 1) == 0
            for k, s, n in sequence:
                seen[k].append((s, n))
        for k, (n, _) in items.items():
            at = 0
            for s, m in sorted(seen[k]):
                assert s == at
                at += m
            assert at == n


# ----------------------------------------------------------------- language


def test_language_id(ready):
    alphabets = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "qrstuvwx"}
    make = lambda a, s: " ".join("".join(random.Random(s * 99 + k).choice(alphabets[a]) for _ in range(5)) for k in range(80))
    rows = [(i, make(a, i), a, "s", 1) for i, a in enumerate(list(alphabets) * 40)]
    rows += [(1000, None, "aa", "s", 0), (1001, "12 ++", "bb", "s", 0), (1002, "", None, "s", 0), (None, make("bb", 7), None, "s", 0), (1003, "zz yy " * 400, None, "s", 0), (5, make("cc", 5), "cc", "s", 0)]
    docs = ready.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("rank", F.lit(1))
    model = LI.fit(docs)
    got = LI.identify(docs, model).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id not in (5,)}
    for i, t, a, *_ in rows[:120]:
        if i != 5:
            assert by_id[i].lang_pred == a and 0.5 < by_id[i].score <= 1 and not by_id[i].rejected
            assert by_id[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    for i in (1000, 1001, 1002):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[None].lang_pred == "bb" and by_id[None].held_out
    assert by_id[1003].rejected and by_id[1003].lang_pred in alphabets
    kept = LI.language_stage(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {1000, 1001, 1002, 1003}
    assert LI.identify(docs.limit(0), LI.fit(docs.limit(0))).count() == 0
    assert {r.lang_pred for r in LI.identify(docs, None).collect()} == {"und"}


def test_kneser_ney_sums_to_one_and_parts_score_like_the_whole():
    model = LI.kneser_ney([prose(s, 200) for s in range(10)])
    links = LI.gram_links([prose(s, 200) for s in range(10)], model)
    context = links[1][0]
    for c in np.unique(context)[:20]:
        seen = np.exp(model[1]["p"][context == c]).sum()
        back = np.exp(model[1]["back_off"][np.searchsorted(model[1]["contexts"], c)])
        rest = 1 - np.exp(model[0]["p"][np.searchsorted(model[0]["grams"], links[1][1][context == c])]).sum()
        assert seen + back * rest == pytest.approx(1.0, abs=1e-6)
    whole = LI.merge(["x"], [model])
    LI.fill(whole, links)
    whole.prepared()
    short, long = whole.cross_entropies([prose(99, 400)])[0], whole.cross_entropies([prose(99, 400) + "\n" + prose(98, 200_000)])[0]
    assert abs(short - long) < 0.1


# ----------------------------------------------------------------- de-duplication


def test_line_dedup(ready):
    long = "The very same line that many documents of this corpus share."
    texts = [f"{long}\nown {i}\n\t{long.upper()} " for i in range(6)] + [*ODD, long, "short\nshort", f"x\r\n{long}\r\n"]
    ids = [*range(6), *range(6, 6 + len(ODD)), 50, 51, 50]
    docs = table(ready, texts, ids, "n_lines kept_text words doc pos").unionByName(table(ready, [long], [None], "n_lines kept_text words doc pos"))
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    rows = [*zip(ids, texts, strict=True), (None, long)]
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(-1 if i is None else i)
    want = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [len(k := key(x)) >= 40 and len(holders[k]) >= 5 and (-1 if i is None else i) != max(holders[k]) for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        want[i, len(lines), sum(gone), kept] += 1
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in LD.kept_lines(docs).collect())
    assert got == want
    out = LD.line_dedup(docs)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text or "") for r in out.collect()) == Counter({(i, t): n for (i, _, _, t), n in want.items()})
    assert all(r.n_chars == len(r.text or "") for r in out.collect()) and LD.line_dedup(docs.limit(0)).count() == 0


def test_line_bitmap_of_many_lines(ready):
    line = "a line of more than forty characters that repeats itself"
    text = "\n".join(line if k % 3 == 0 else f"{k}" for k in range(500))
    got = {r.doc_id: r for r in LD.kept_lines(table(ready, [text] * 6)).collect()}
    assert got[0].n_dropped == 167 and got[5].n_dropped == 0
    assert got[0].kept_text == "\n".join(str(k) for k in range(500) if k % 3)


def near_copies():
    base = prose(7, 200).split()
    texts = []
    for s in range(60):  # a chain of edits, so that links reach further than single comparisons
        copy = list(base)
        for k in random.Random(s).sample(range(200), s % 7):
            copy[k] = f"edit{s}x{k}"
        texts.append(" ".join(copy))
    return texts + [prose(100 + s, 120) for s in range(20)] + [texts[3]] * 15 + [texts[0].upper()]


def test_minhash_against_brute_force(ready):
    texts = [*near_copies(), *ODD, "a b c", "A  b\tc"]
    docs = table(ready, texts, None, "component_id key id root bands top size").unionByName(table(ready, [texts[0]], [None], "component_id key id root bands top size"))
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    for block in (512, 4):
        got = {r.doc_id: r for r in MH.near_duplicates(docs, block=block).collect()}
        for i in range(len(texts)):
            assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), find(i), find(i) == i)
        assert got[None].component_id is None and got[None].kept
    kept = MH.minhash_dedup(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(len(texts)) if find(i) == i} | {None}
    assert MH.near_duplicates(docs.limit(0)).count() == 0


def test_sketch_coordinates_estimate_similarity():
    r = np.random.default_rng(1)
    a = r.integers(0, 2**63, 800, np.uint64)
    sets = [np.sort(a[:500]), np.sort(a[100:600]), np.sort(a[:1])]
    sketch = MH.sketches(sets, 4096)
    assert abs((sketch[0] == sketch[1]).mean() - 400 / 600) < 0.04
    assert len(np.unique(sketch[2])) > 1 and (sketch > 0).all()  # one element fills every coordinate


def test_components(ready):
    r = random.Random(2)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(2000, 2100)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {q.vertex: q.root for q in components(ready.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(v) for v in list(parent) if find(v) != v}
    assert components(ready.createDataFrame([], "a long, b long")).count() == 0


def test_substring_dedup(ready):
    passage, other = prose(50, 70), prose(51, 90)
    edited = passage.split()
    edited[35] = "changed"
    texts = [f"{prose(10 + k, 80)} {passage} {prose(30 + k, 60)}" for k in range(5)]
    texts += [f"{other} {prose(60, 40)}", f"{prose(61, 300)}\n{other}", f"{prose(62, 55)} {' '.join(edited)}"]
    clean = [prose(70 + k, 200) + " " + " ".join(passage.split()[:20]) for k in range(4)]
    texts += clean + [*ODD, "the " * 80, "so the " + "the " * 90, passage]
    got = SD.repeated_passages(table(ready, texts, None, "class_id key doc span a b root")).collect()
    holds = {*range(8), len(texts) - 1, len(texts) - 2, len(texts) - 3}
    assert {r.doc_id for r in got} == holds
    classes = {r.doc_id: r.class_id for r in got}
    assert {classes[i] for i in (0, 1, 2, 3, 4, 7, len(texts) - 1)} == {0} and classes[5] == classes[6] == 5
    for r in got:
        a, b = words_of(texts[r.doc_id])[r.start_word :][: r.n_words], words_of(texts[r.match_doc_id])[r.match_start :][: r.match_words]
        x, y = shingles(" ".join(a)), shingles(" ".join(b))
        assert min(len(a), len(b)) >= 50 and r.similarity == pytest.approx(len(x & y) / len(x | y)) and r.similarity >= 0.75
    empty = SD.repeated_passages(table(ready, [None, "a b"], [1, None]))
    assert empty.count() == 0


def test_compact_windows_partition_all_subsequences():
    h = np.random.default_rng(4).permutation(60).astype(np.uint64)
    width = 7
    for i in range(60):
        for j in range(i + width - 1, 60):
            hits = [(a, c, b) for a, c, b in SD.compact_windows(h, width) if a <= i <= c <= j <= b]
            assert len(hits) == 1 and h[hits[0][1]] == h[i : j + 1].min()


def test_decontamination(ready):
    items = [(0, prose(80, 40)), (1, prose(81, 15)), (2, None), (3, ""), (4, "tiny item"), (5, prose(82, 40)), (6, prose(80, 40))]
    cut = prose(82, 40).split()
    noisy = [w + "%%" if k % 3 else w.upper() for k, w in enumerate(cut)]
    texts = [f"{prose(90, 50)} {items[0][1]} {prose(91, 30)}", f"{items[1][1]}", " ".join(noisy), f"{prose(92, 100)} {' '.join(cut[:20])}", *ODD, f"so a tiny item here {prose(93, 20)}", prose(94, 500)]
    docs = table(ready, texts, None, "item_id similarity key")
    bench = ready.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = {(0, 0), (0, 6), (1, 1), (2, 5), (len(texts) - 2, 4)}
    for max_bytes in (DC.MAX_BYTES, 200):
        got = DC.leaks(docs, bench, max_bytes).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want and all(r.similarity >= 0.75 for r in got)
    assert {r.doc_id: r.start_word for r in got}[0] == 50
    kept = DC.decontaminate(docs, bench, 200)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {i for i, _ in want}
    assert DC.leaks(docs, bench.limit(0)).count() == 0 and DC.leaks(docs.limit(0), bench).count() == 0


def test_multi_index_finds_all_within_the_radius():
    r = np.random.default_rng(8)
    prints = r.integers(0, 2**63, 200, np.uint64)
    wanted = np.array([p ^ np.uint64(sum(1 << int(b) for b in r.choice(63, k, replace=False))) for k, p in enumerate(prints[:40])], np.uint64)
    rows, found = DC.MultiIndex(prints).search(wanted)
    exact = {(i, j) for i in range(40) for j in range(200) if int(wanted[i] ^ prints[j]).bit_count() <= DC.RADIUS}
    assert set(zip(rows.tolist(), found.tolist(), strict=True)) == exact


def test_embedding_dedup(ready):
    r = np.random.default_rng(6)
    base = r.normal(size=(30, 24))
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    for k in range(90):
        rows.append((100 + k, (base[k % 5] + r.normal(size=24) * 0.12).tolist()))
    rows += [(300 + k, base[7].tolist()) for k in range(12)] + [(400, (base[8] * 1e-30).tolist()), (401, (base[8] * 1e30).tolist())]
    rows += [(500, None), (501, []), (502, [0.0] * 24), (503, [float("nan")] * 24), (504, [None] * 24), (505, [float("inf")] + [0.0] * 23), (506, base[0][:5].tolist()), (None, base[0].tolist())]
    vectors = ready.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("keys", F.lit(2)).repartition(3)
    good = [(i, np.array(v)) for i, v in rows if i is not None and i < 500]
    x = np.stack([v / np.abs(v).max() for _, v in good])
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.array([min(label[j] for j in [i, *np.flatnonzero(linked[i])]) for i in range(len(x))])
    for block in (1024, 16):
        got = {q.vec_id: q for q in ED.near_embeddings(vectors, block=block).collect()}
        assert len(got) == len(rows)
        for k, (i, _) in enumerate(good):
            assert (got[i].n_links, got[i].component_id) == (linked[k].sum(), good[label[k]][0]), i
            assert got[i].kept == (got[i].component_id == i)
        for i in [*range(500, 507), None]:
            assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert ED.near_embeddings(vectors.limit(0)).count() == 0


# ----------------------------------------------------------------- personal data, archives

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    return sum((v := int(c) * (1 + k % 2)) - 9 * (v > 9) for k, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    def holds(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]

    found = [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for k, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if holds(kind, m[0])]
    return [name for _, _, name in sorted(found)]


def test_personal_data(ready):
    r = random.Random(11)
    texts = [
        "mail a.b@c.de or x@y.z_w@v.u, +1 (555) 010-7799 and 4111 1111 1111 1111.", "é日 10.0.0.1 and 999.1.1.1.5.6.7.8 0001.2.3.004", "card 4111-1111-1111-1112 (bad)",
        "1" * 40_000 + " a." * 10_000 + "b@" + "c." * 5000 + "d", " 41111111 ab@cd.e f@g.h", "phone (555) 010-7799, write to joe (at) site (dot) com",
        'token = "908038b7daaf91e730d2f64001c5242a9c3de121"', "plain words only", *ODD,
    ]
    texts += ["".join(r.choice("0123456789.@-+ ()ab%_,é") for _ in range(r.randint(1, 120))) for _ in range(400)]
    texts += ["1 2" * 3000, "a@b" + ".c" * 3000, "+1" + "-2" * 3000 + "+1 234 567 8901 "]
    docs = table(ready, texts, None, "kind match begin p soft").unionByName(table(ready, [texts[0], texts[0]], [0, None], "kind match begin p soft"))
    rows = PI.pii_report(docs).collect()
    assert len(rows) == len(texts) + 2
    for q in rows:
        text = texts[q.doc_id or 0]
        want = base_spans(text)
        assert q.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (text, want, q.spans)
        assert {"email": q.n_email, "ip": q.n_ip, "card": q.n_card, "phone": q.n_phone} == {k: sum(w.startswith(k + ":") for w in want) for k in BASE}
        every = q.spans.split(",") if q.spans else []
        assert set(want) <= set(every)
        assert [w for w in every if w in set(want)] == want
    assert {q.doc_id: q.spans for q in rows}[7] == ""
    assert PI.pii_report(docs.limit(0)).count() == 0


def test_label_model_learns_reliabilities():
    r = random.Random(1)
    patterns = Counter()
    truth = Counter()
    for _ in range(4000):
        y = r.random() < 0.3
        votes = tuple(int(y == (r.random() < a)) if r.random() < 0.9 else -1 for a in (0.95, 0.9, 0.85, 0.7, 0.6))
        patterns[votes] += 1
        truth[votes] += y
    chance = PI.reliabilities([("ip", v, n) for v, n in patterns.items()])
    wrong = sum(min(truth[v], n - truth[v]) if (chance["ip", v] > 0.5) == (2 * truth[v] > n) else max(truth[v], n - truth[v]) for v, n in patterns.items())
    assert wrong < 0.06 * 4000


def test_warc(ready):
    big = "<p>" + "z" * 200_000
    pages = [(1, "http://a.example.com/x?y=1#f", "<b>é</b>"), (2, "https://A.example.com:443/x", big), (3, None, big), (4, "not a url\r\nWARC-Type: evil", ""), (5, "http://[bad", None), (6, "http://b.org", "tiny"), (7, "http://b.org/", "tiny"), (None, "http://b.org/\t", "tiny"), (9, "http://ü.de/ä", "q")]
    frame = ready.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("key", F.lit(2)).repartition(3)
    for min_bytes, block in ((0, 2), (5, 3000)):
        archive = WA.write_archive(frame, min_bytes, block)
        got = {r.page_id: r for r in WA.read_records(WA.find_captures(archive, frame), with_payload=True).collect()}
        assert len(got) == len(pages)
        for i, _, html in pages:
            body = (html or "").encode()
            same = [j for j, _, h in pages if (h or "").encode() == body and j is not None]
            first = max(same) if len(body) >= min_bytes else i
            q = got[i]
            assert (q.payload_bytes, q.payload_digest) == (len(body), WA.sha1_base32(body))
            assert (q.record_type, q.refers_to) == (("response", None) if i == first else ("revisit", first))
            assert bytes(q.payload) == (body if i == first else b"")
    one = WA.lookup(ready, archive, ["http://a.example.com/x?y=1", "http://nowhere/"]).collect()
    assert [r.page_id for r in one] == [1] and bytes(one[0].payload) == "<b>é</b>".encode()
    none = WA.write_archive(frame.limit(0))
    assert WA.read_records(WA.find_captures(none, frame)).count() == 0


def test_url_keys():
    assert WA.url_key("http://www.Example.com:80/a/b?c#d") == "com,example,www)/a/b?c"
    assert WA.url_key("https://x.org:8443") == "org,x:8443)/" and WA.url_key(None) == "" and WA.url_key("plain") == "plain"
