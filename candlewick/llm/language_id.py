"""Language identification by character language models (operator 1).

One interpolated Kneser-Ney model per language over lower-cased letters (each
run of other characters is one space).  The languages share the n-gram tables:
for each order a sorted array of 64-bit n-gram hashes, a matrix with every
language's log probability, and the same for the back-off weights of contexts.
A text's language is the one with the lowest cross-entropy per character.

Rejection is calibrated for each language on documents kept out of the counts: a
text is rejected if its cross-entropy exceeds the language's mean by more than the
``QUANTILE`` of those documents' excess and ``MARGIN`` nats; a single odd document
doesn't widen the band.  Short texts get a wider one, as their cross-entropy varies more.

Bounds: the models are fitted on at most ``max_docs`` labelled documents of each
language, chosen by a hash of ``doc_id``; every document is then scored whole.
The model's size is bounded by that sample, and ``MAX_MODEL_BYTES`` is checked
before it goes to the tasks.

Edge cases: a text that is null or has no letter gets ``und``, score 0, and is
rejected.  Without any labelled row every text gets ``und``.  Rows with a null
``lang`` are never learned from.  A null ``doc_id`` counts as held out.
Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.shingles import HashArray
from candlewick.llm.tokens import rows_of

ORDER = 4
MAX_DOCS = 600
CALIBRATE_EVERY = 5  # one document in so many is kept from the counts, for the calibration
QUANTILE, MARGIN = 0.98, 1.0
SHORT = 200  # characters under which the rejection band widens
MAX_MODEL_BYTES = 1 << 30
UND = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean"

_LETTERS = None


def _letters():
    """For each code point, whether it is a letter (built once per worker)."""
    global _LETTERS
    if _LETTERS is None:
        import numpy as np

        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def symbols(texts: list[str]):
    """The texts as one array of symbols, and the bounds of each.

    Before each text stand ORDER - 1 zeros.  A text is a space, its letters with
    one space for each run of other characters, and a closing space.  Texts
    without a letter have only the zeros.
    """
    import numpy as np

    joined = "\n".join(t.lower() for t in texts) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
    letter = _letters()[np.minimum(code, 0x10FFFF)]
    sizes = np.array([len(t.lower()) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes)
    has = np.add.reduceat(letter, ends - sizes, dtype=np.int64) > 0
    before = np.empty_like(letter)
    before[0], before[1:] = False, letter[:-1]
    keep = letter | before  # a non-letter only right after a letter
    doc = np.repeat(np.arange(len(texts)), sizes)[keep]
    kept = np.where(letter, code, 32)[keep]
    count = np.bincount(doc, minlength=len(texts)) + has  # and the space at its start
    width = count + (ORDER - 1)
    start = np.cumsum(width) - width + (ORDER - 1)
    out = np.zeros(int(width.sum()), np.uint64)
    first = np.cumsum(count) - count
    out[start[has]] = 32
    within = np.arange(len(doc)) - (first - np.cumsum(has) + has)[doc]
    out[start[doc] + 1 + within] = kept
    return out, start, start + count


def hashes(stream, order: int):
    """A 64-bit hash of the n-gram that ends at each position (the first few mix in zeros)."""
    import numpy as np

    h = np.full(len(stream), order, np.uint64)
    for back in range(order - 1, -1, -1):
        part = stream if back == 0 else np.concatenate((np.zeros(back, np.uint64), stream[:-back]))
        h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _counts(keys):
    import numpy as np

    return np.unique(keys, return_counts=True)


def kneser_ney(texts: list[str]) -> list[dict]:
    """For each order 1..ORDER: n-gram hashes with log probabilities, context hashes with log back-off weights."""
    import numpy as np

    stream, start, end = symbols(texts)
    at = np.concatenate([np.arange(a, b) for a, b in zip(start, end, strict=True)]) if len(start) else np.zeros(0, np.int64)
    grams = {n: hashes(stream, n) for n in range(1, ORDER + 1)}
    shifted = {n: np.concatenate((np.zeros(1, np.uint64), grams[n][:-1])) for n in grams}  # the context: the n-gram before
    model = []
    lower = None
    for n in range(1, ORDER + 1):
        key, context, rest = grams[n][at], (shifted[n - 1][at] if n > 1 else np.zeros(len(at), np.uint64)), (grams[n - 1][at] if n > 1 else None)
        if n < ORDER:  # continuation counts: distinct n-grams one longer
            _, one = np.unique(grams[n + 1][at], return_index=True)
            key, context, rest = key[one], context[one], rest[one] if n > 1 else None
        seen, index, counts = np.unique(key, return_index=True, return_counts=True)
        context = context[index]
        n1, n2 = (counts == 1).sum(), (counts == 2).sum()
        discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        contexts, of = np.unique(context, return_inverse=True)
        total, kinds = np.bincount(of, counts), np.bincount(of)
        back_off = discount * kinds / total
        if n == 1:
            below = np.full(len(seen), 1.0 / (len(seen) + 1))
        else:
            below = np.exp(lower["p"][np.searchsorted(lower["grams"], rest[index])])
        p = np.log((counts - discount) / total[of] + back_off[of] * below)
        lower = {"grams": seen, "p": p, "contexts": contexts, "back_off": np.log(back_off)}
        model.append(lower)
    return model


@dataclass
class Model:
    languages: list[str]
    grams: list  # by order: sorted hashes
    p: list  # by order: log probabilities, a row for each n-gram and a column for each language
    contexts: list
    back_off: list
    unknown: object  # log probability of an unseen character
    mean: object  # cross-entropy of calibration documents by language
    band: float = 0.0

    @property
    def size(self) -> int:
        return sum(a.nbytes for part in (self.grams, self.p, self.contexts, self.back_off) for a in part)

    def prepared(self) -> Model:
        self.find_gram = [HashArray(g) for g in self.grams]
        self.find_context = [HashArray(c) for c in self.contexts]
        return self

    def log_probabilities(self, stream, at):
        """For each position of ``at`` the log probability of its symbol by language."""
        import numpy as np

        out = np.zeros((len(at), len(self.languages)), np.float32)
        left = np.arange(len(at))
        for n in range(ORDER, 0, -1):
            index = self.find_gram[n - 1].find(hashes_at(stream, at[left], n))
            hit = index >= 0
            if hit.all() and len(left) == len(at):
                return out + self.p[n - 1][index]
            out[left[hit]] += self.p[n - 1][index[hit]]
            left = left[~hit]
            if not len(left):
                return out
            context = self.find_context[n - 1].find(hashes_at(stream, at[left] - 1, n - 1) if n > 1 else np.zeros(len(left), np.uint64))
            known = context >= 0
            out[left[known]] += self.back_off[n - 1][context[known]]
        out[left] += self.unknown
        return out

    def cross_entropies(self, texts: list[str]):
        """(texts x languages) cross-entropies per character, and the characters counted.

        Texts are taken together up to ``size`` characters, and so many positions are
        looked up at once; a longer text is one array of symbols and never cut.
        """
        import numpy as np

        size = min(400_000, max(20_000, 2_000_000 // len(self.languages)))
        sums, count = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        first, held = 0, 0
        for k, text in enumerate(texts):
            held += len(text)
            if held >= size or k + 1 == len(texts):
                self._add(texts[first : k + 1], size, sums[first : k + 1], count[first : k + 1])
                first, held = k + 1, 0
        return -sums / np.maximum(count, 1)[:, None], count

    def _add(self, texts: list[str], at_once: int, sums, count) -> None:
        import numpy as np

        stream, start, end = symbols(texts)
        size = end - start
        rows = np.repeat(np.arange(len(texts)), size)
        at = np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
        for k in range(0, len(rows), at_once):
            here = rows[k : k + at_once]
            head = np.flatnonzero(np.diff(here, prepend=-1))
            sums[here[head]] += np.add.reduceat(self.log_probabilities(stream, at[k : k + at_once]), head, axis=0, dtype=np.float64)
        count += size

    def predict(self, texts: list[str]) -> list[tuple]:
        """(language, score, cross-entropy, rejected) of each text."""
        import numpy as np

        entropy, count = self.cross_entropies(texts)
        best = entropy.argmin(axis=1)
        rows = np.arange(len(texts))
        lowest = entropy[rows, best]
        score = 1 / np.exp(np.clip(-(entropy - lowest[:, None]) * np.minimum(count, SHORT)[:, None], -700, 0)).sum(axis=1)
        reject = self.excess(lowest, best, count) > self.band[best]
        return [(self.languages[best[i]], float(score[i]), float(lowest[i]), bool(reject[i])) if count[i] else (UND, 0.0, None, True) for i in rows]

    def excess(self, lowest, best, count):
        import numpy as np

        return (lowest - self.mean[best]) * np.minimum(1.0, np.sqrt(count / SHORT))


def merge(languages: list[str], models: list[list[dict]]) -> Model:
    """Put the languages' models over common n-gram arrays; a language's unseen n-grams get their back-off value."""
    import numpy as np

    grams, p, contexts, back_off = [], [], [], []
    for n in range(ORDER):
        for part, values, out in (("grams", "p", (grams, p)), ("contexts", "back_off", (contexts, back_off))):
            keys = np.unique(np.concatenate([m[n][part] for m in models]))
            table = np.full((len(keys), len(models)), np.nan if part == "grams" else 0.0, np.float32)
            for k, m in enumerate(models):
                table[np.searchsorted(keys, m[n][part]), k] = m[n][values]
            out[0].append(keys)
            out[1].append(table)
    unknown = np.array([m[0]["back_off"][0] - np.log(len(m[0]["grams"]) + 1) for m in models], np.float32)
    return Model(languages, grams, p, contexts, back_off, unknown, np.zeros(len(models)))


def fill(model: Model, links: list) -> None:
    """Back-off values for n-grams that only other languages have seen; links[n] has the (context, shorter n-gram) hashes."""
    import numpy as np

    for n in range(ORDER):
        context, rest = links[n]
        c = np.searchsorted(model.contexts[n], context)
        below = model.p[n - 1][np.searchsorted(model.grams[n - 1], rest)] if n else np.tile(-np.log([len(model.grams[0]) + 1]), (len(context), len(model.languages)))
        table, value = model.p[n], model.back_off[n][c] + below
        gap = np.isnan(table)
        table[gap] = value[gap]


def hashes_at(stream, at, order: int):
    import numpy as np

    h = np.full(len(at), order, np.uint64)
    for back in range(order - 1, -1, -1):
        h = (h ^ stream[at - back]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


# ----------------------------------------------------------------- Spark


def held_out(doc_id):
    """crc32 of the id as text, modulo 4, is 2; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def training_sample(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(lang, text) of at most ``max_docs`` labelled documents of each language, the lowest in a hash order."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.select("lang", "text", F.xxhash64(F.lit(17), F.col("doc_id").cast("string")).alias("h"))
    counts = rows.groupBy("lang").count().collect()  # one row for each language
    # A first cut by share where the rows are read, so that a bounded number of each language's rows is shuffled.
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], min(1.0, 2.0 * max_docs / r["count"])).otherwise(share)
    near = rows.where(F.pmod(F.col("h"), F.lit(1_000_000)) < share * 1_000_000)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    return near.withColumn("rank", rank).where(F.col("rank") <= max_docs).select("lang", "text", "rank")


def fit(docs: DataFrame, max_docs: int = MAX_DOCS) -> Model | None:
    """Fit on a bounded sample of the labelled rows; None if there is none."""
    import numpy as np

    def train(key, frame):
        import pickle

        import pandas as pd

        learn = frame["rank"] % CALIBRATE_EVERY != 0
        texts = frame.loc[learn, "text"].tolist()
        model = kneser_ney(texts)
        links = gram_links(texts, model)
        body = pickle.dumps((model, links, frame.loc[~learn, "text"].tolist()))
        return pd.DataFrame({"lang": [key[0]], "body": [body]})

    sample = training_sample(docs, max_docs)
    rows = sorted(sample.groupBy("lang").applyInPandas(train, "lang string, body binary").collect())  # a row for each language
    import pickle

    parts = [(r.lang, *pickle.loads(r.body)) for r in rows]
    parts = [x for x in parts if len(x[1][0]["grams"])]
    if not parts:
        return None
    model = merge([x[0] for x in parts], [x[1] for x in parts])
    links = []
    for n in range(ORDER):
        first = {}
        keys = np.concatenate([x[1][n]["grams"] for x in parts])
        _, one = np.unique(keys, return_index=True)
        links.append(tuple(np.concatenate([x[2][n][j] for x in parts])[one] for j in (0, 1)))
    fill(model, links)
    if model.size > MAX_MODEL_BYTES:
        raise ValueError(f"the model takes {model.size} bytes; lower max_docs")
    calibrate(model.prepared(), [(k, t) for k, x in enumerate(parts) for t in x[3]])
    del model.find_gram, model.find_context
    return model


def gram_links(texts: list[str], model: list[dict]) -> list:
    """For each order, the hashes of each n-gram's context and of the n-gram without its first symbol."""
    import numpy as np

    stream, start, end = symbols(texts)
    at = np.concatenate([np.arange(a, b) for a, b in zip(start, end, strict=True)]) if len(start) else np.zeros(0, np.int64)
    links = []
    for n in range(1, ORDER + 1):
        keys, one = np.unique(hashes_at(stream, at, n), return_index=True)
        one = one[np.searchsorted(keys, model[n - 1]["grams"])]
        none = np.zeros(len(one), np.uint64)
        links.append((hashes_at(stream, at[one] - 1, n - 1) if n > 1 else none, hashes_at(stream, at[one], n - 1) if n > 1 else none))
    return links


def calibrate(model: Model, documents: list[tuple[int, str]]) -> None:
    """Means by language, and how far above them a text may be."""
    import numpy as np

    of = np.array([k for k, _ in documents], np.int64)
    entropy, count = model.cross_entropies([t for _, t in documents]) if documents else (np.zeros((0, len(model.languages))), np.zeros(0))
    own = entropy[np.arange(len(of)), of]
    good = (count > 0) & (entropy.argmin(axis=1) == of) if len(of) else np.zeros(0, bool)
    all_mean = np.average(own[good], weights=count[good]) if good.any() else np.log(30.0)
    model.band = np.full(len(model.languages), MARGIN)
    for k in range(len(model.languages)):
        mine = good & (of == k)
        model.mean[k] = np.median(own[mine]) if mine.any() else all_mean
        if mine.any():
            excess = model.excess(own[mine], of[mine], count[mine])
            model.band[k] = MARGIN + max(0.0, float(np.quantile(excess, QUANTILE, method="lower")))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document (``SCHEMA``); only the text takes part in the prediction."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(predictor(model, ("doc_id", "held_out")), SCHEMA)


def predictor(model: Model | None, carried: tuple[str, ...]):
    """A task that yields the carried columns, lang_pred, score, cross_entropy and rejected for each row."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        ready = model.prepared() if model else None

        def flush(rows):
            found = ready.predict([r[-1] or "" for r in rows]) if ready else [(UND, 0.0, None, True)] * len(rows)
            columns = [*zip(*(r[:-1] for r in rows), strict=True), *zip(*found, strict=True)]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        names, types = [*carried, "lang_pred", "score", "cross_entropy", "rejected"], None
        held, size = [], 0

        def watched():
            nonlocal types
            for b in batches:
                types = types or [b.schema.field(c).type for c in carried] + [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
                yield b

        for row in rows_of(watched(), *carried, "text"):
            held.append(row)
            size += len(row[-1] or "")
            if size > 1_000_000 or len(held) >= 5000:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return run


def language_stage(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """The documents whose language is found, with their columns unchanged."""
    model = fit(docs, max_docs)

    def keep(batches) -> Iterator:
        import pyarrow as pa

        ready = model.prepared() if model else None
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = part.column(part.schema.get_field_index("text")).to_pylist()
                found = ready.predict([t or "" for t in texts]) if ready else [(UND, 0.0, None, True)] * len(texts)
                yield part.filter(pa.array([not f[3] for f in found]))

    return docs.mapInArrow(keep, docs.schema)
