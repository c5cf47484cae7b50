"""Language-model scores of texts by a hidden Markov model (operator 13).

Model: ``STATES`` latent states with start, transition and emission probabilities.
A state emits a word class, the class emits the word: the ``OWN_CLASSES`` most
frequent words are classes of their own, all others fall into classes by signature
(last letters, kind of characters), where a word's share is its count plus one; each
signature class keeps one such share for unseen words.  The counts of all words of the
training documents make these shares, so what is gathered grows with the corpus; the
table of emissions is bounded.

Training: Baum-Welch over all training texts, cut into sequences of ``SPAN`` tokens;
each task sums the expected counts of its sequences, the sums are aggregated by class,
and only (classes x states) numbers go through the driver in each iteration.

Scoring: the scaled forward recursion over each whole text.  A long text's spans are
products of (states x states) matrices, computed side by side and then chained, which
gives the exact likelihood of the whole sequence.

Scale: texts are tokenised once into blocks of about ``BLOCK`` bytes, each with its own
vocabulary and its tokens as numbers in it.  Only vocabularies are shuffled: they are
summed to corpus counts and joined back, one row per block and distinct word.

Edge cases: a null or empty text has the one token "end".  A null ``doc_id`` has no hash:
its row is scored, but neither held out nor learned from (held_out is null).  Rows that repeat a
``doc_id`` are judged each by its own text.  Without any training document all words are
unseen and all classes equal.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import stored
from candlewick.llm.shingles import text_batches

STATES, OWN_CLASSES, SIGNATURES = 8, 16_384, 4_096
ITERATIONS, SPAN, BLOCK = 6, 64, 16_000_000
# Added to each expected count of a class, and of a transition.
LIGHT = 0.01
END = ""  # no word is empty, so the end of a text takes the empty string in the vocabulary
BLOCKS = "block long, ids array<long>, learn array<boolean>, sizes array<int>, tokens binary, words array<string>, counts array<long>"


def packed(tokens) -> bytes:
    """int32 numbers with all first bytes in front, then all second bytes, ...: the high bytes compress to almost nothing."""
    import numpy as np

    return tokens.astype(np.int32).view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data):
    import numpy as np

    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.int32).ravel()


def tokenised(docs: DataFrame, learn: Column, block: int = BLOCK) -> DataFrame:
    """Blocks of texts: ids, which of them are learned from, token numbers (int32), vocabulary with its training counts."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        vocabulary: dict[bytes, int] = {b"": 0}
        ids, flags, sizes, tokens, held = [], [], [], [], 0

        def out():
            every = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
            learned = np.repeat(np.array([bool(f) for f in flags], bool), sizes)
            counts = np.bincount(every[learned], minlength=len(vocabulary))
            row = {"block": uuid.uuid4().int >> 65, "ids": ids, "learn": flags, "sizes": sizes, "tokens": packed(every), "words": [w.decode() for w in vocabulary], "counts": counts.tolist()}
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], names=list(row))

        for texts, their_ids, their_flags in text_batches(batches, "text", "doc_id", "learn"):
            for text, i, flag in zip(texts, their_ids, their_flags, strict=True):
                words = text.lower().split()  # bytes: A-Z, and white space \x20 \x09-\x0D
                numbers = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
                numbers.append(0)
                tokens.append(np.array(numbers, np.int32))
                ids.append(i)
                flags.append(flag)
                sizes.append(len(numbers))
                held += len(text)
                if held >= block:
                    yield out()
                    vocabulary, ids, flags, sizes, tokens, held = {b"": 0}, [], [], [], [], 0
        if ids:
            yield out()

    rows = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), learn.alias("learn"))
    return stored(rows.mapInArrow(run, BLOCKS), "lm_blocks")


# ------------------------------------------------------------------ classes and counts


def signature(word: Column, signatures: int = SIGNATURES) -> Column:
    """The signature class of a word: its last three characters, whether it has digits and other signs, its length up to 12."""
    kinds = F.concat_ws("|", F.substring(F.reverse(word), 1, 3), word.rlike("[0-9]").cast("string"), word.rlike(r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]").cast("string"), F.least(F.length(word), F.lit(12)).cast("string"))
    return F.pmod(F.crc32(kinds.cast("binary")), F.lit(signatures)).cast("int")


def word_table(blocks: DataFrame, own: int = OWN_CLASSES, signatures: int = SIGNATURES) -> DataFrame:
    """(word, n, class): all words with their training counts; classes from 0 are the own ones, those from ``own`` on the signatures."""
    vocabulary = blocks.select(F.explode(F.arrays_zip("words", "counts")).alias("e"))
    counted = stored(vocabulary.groupBy(F.col("e.words").alias("word")).agg(F.sum("e.counts").alias("n")), "lm_words")
    top = counted.where(F.col("n") > 0).orderBy(F.col("n").desc(), "word").limit(own).collect()  # at most own rows
    spark = blocks.sparkSession
    frame = spark.createDataFrame([(r["word"], k) for k, r in enumerate(top)], "word string, own int")
    signed = (signature(F.col("word"), signatures) + own).cast("int")
    return counted.join(F.broadcast(frame), "word", "left").select("word", "n", F.coalesce("own", signed).alias("class"))


def with_counts(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """The blocks with the corpus count and the class of each word of their vocabulary, in place of the words."""
    entries = blocks.select("block", F.posexplode("words").alias("at", "word"))
    # merged, never broadcast: the words grow with the corpus; a block's entries come in any order, with their places
    found = entries.join(words.hint("merge"), "word").groupBy("block").agg(F.collect_list(F.struct("at", "n", "class")).alias("v"))
    found = found.select(F.col("block").alias("__block"), "v.at", "v.n", "v.class")
    kept = blocks.select("block", "ids", "learn", "sizes", "tokens")
    return stored(kept.join(found.hint("merge"), F.col("block") == F.col("__block")).drop("__block"), "lm_counted")


# ------------------------------------------------------------------ the model


def spans_of(tokens, sizes, span: int):
    """(span x n) token numbers, -1 where a span has ended; for each span its text and its place in it."""
    import numpy as np

    parts = -(-sizes // span)
    text = np.repeat(np.arange(len(sizes)), parts)
    part = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(np.cumsum(sizes) - sizes, parts) + part * span
    size = np.minimum(span, np.repeat(sizes, parts) - part * span)
    place = start[None, :] + np.arange(span)[:, None]
    inside = np.arange(span)[:, None] < size[None, :]
    return np.where(inside, tokens[np.minimum(place, len(tokens) - 1)], -1), text, part


class Hmm:
    """Start (K), transitions (K x K) and emissions (classes x K) of a model."""

    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = start, move, emit

    def rows(self, classes):
        """Emission rows of classes; 1 where a span has ended (-1), so that it adds nothing to a likelihood."""
        import numpy as np

        b = self.emit[np.maximum(classes, 0)]
        b[classes < 0] = 1.0
        return b

    def expected(self, classes):
        """Baum-Welch counts of sequences (span x n of classes): start (K), transitions (K x K), emissions (classes x K)."""
        import numpy as np

        span, n = classes.shape
        k = len(self.start)
        forward, scale = np.empty((span, n, k)), np.empty((span, n, 1))
        b = self.rows(classes)
        alpha = self.start * b[0]
        for t in range(span):
            if t:
                alpha = (alpha @ self.move) * b[t]
            scale[t] = alpha.sum(axis=1, keepdims=True)
            alpha = alpha / scale[t]
            forward[t] = alpha
        emit, moved = np.zeros_like(self.emit), np.zeros((k, k))
        back = np.ones((n, k))
        for t in range(span - 1, -1, -1):
            forward[t] *= back  # now the posterior of the states at t
            if t == 0:
                break
            ahead = b[t] * back / scale[t]
            back = ahead @ self.move.T
            inside = classes[t] >= 0
            before = forward[t - 1]
            moved += before[inside].T @ ahead[inside] * self.move
        flat, used = classes.ravel(), classes.ravel() >= 0
        posterior = forward.reshape(-1, k)[used]
        for state in range(k):
            emit[:, state] = np.bincount(flat[used], weights=posterior[:, state], minlength=len(emit))
        return forward[0].sum(axis=0), moved, emit

    def log10(self, tokens, sizes, classes_of, span: int = SPAN, at_once: int = 2_000):
        """log10 probability of the class sequence of each text: scaled forward recursion over whole texts."""
        import numpy as np

        result = np.zeros(len(sizes))
        k = len(self.start)
        numbers, text, part = spans_of(tokens, sizes, span)
        classes = np.where(numbers >= 0, classes_of[np.maximum(numbers, 0)], -1)
        head = part == 0
        state = np.empty((len(sizes), k))
        firsts = np.flatnonzero(head)
        for a in range(0, len(firsts), at_once * k):
            here = firsts[a : a + at_once * k]
            b = self.rows(classes[:, here])
            alpha = self.start * b[0]
            logs = np.zeros(len(here))
            for t in range(span):
                alpha = (alpha @ self.move) * b[t] if t else alpha
                s = alpha.sum(axis=1)
                alpha /= s[:, None]
                logs += np.log10(s)
            state[text[here]], result[text[here]] = alpha, logs
        # later spans as matrices: row i is the unnormalised state after the span from state i before it
        later = np.flatnonzero(~head)
        matrix, logs = np.empty((len(later), k, k)), np.empty(len(later))
        for a in range(0, len(later), at_once):
            here = later[a : a + at_once]
            b = self.rows(classes[:, here])
            m, total = np.broadcast_to(np.eye(k), (len(here), k, k)), np.zeros(len(here))
            for t in range(span):
                m = (m.reshape(-1, k) @ self.move).reshape(-1, k, k) * b[t][:, None, :]
                s = m.sum(axis=(1, 2))
                m = m / s[:, None, None]
                total += np.log10(s)
            matrix[a : a + len(here)], logs[a : a + len(here)] = m, total
        order = np.argsort(part[later], kind="stable")  # the second spans of all texts, then the third ones, ...
        edges = np.searchsorted(part[later][order], np.arange(1, int(part.max(initial=0)) + 2))
        for first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            here = order[first:last]
            t = text[later[here]]
            v = np.einsum("ni,nij->nj", state[t], matrix[here])
            s = v.sum(axis=1)
            state[t] = v / s[:, None]
            result[t] += logs[here] + np.log10(s)
        return result


def first_model(shares, states: int):
    """A model to start from: the classes' shares with a fixed random factor for each state, states that mostly stay."""
    import numpy as np

    random = np.random.Generator(np.random.PCG64(13))
    emit = shares[:, None] * (0.5 + random.random((len(shares), states)))
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Hmm(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def arrays(batches, *columns: str) -> Iterator[tuple]:
    """Rows of the counted blocks as numpy arrays, counts and classes in the order of the vocabulary; ids and flags, which may be null, as Arrow arrays."""
    import numpy as np

    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(batch.schema.get_field_index(c))[i] for c in batch.schema.names}
            at = row["at"].values.to_numpy()
            found = []
            for c in columns:
                if c == "tokens":
                    found.append(unpacked(row[c].as_buffer()))
                elif c in ("ids", "learn"):
                    found.append(row[c].values)
                else:
                    value = row[c].values.to_numpy()
                    if c in ("n", "class"):
                        ordered = np.empty_like(value)
                        ordered[at] = value
                        value = ordered
                    found.append(value)
            yield tuple(found)


def iterate(blocks: DataFrame, model: Hmm, span: int) -> Hmm:
    """One Baum-Welch iteration over the training texts of all blocks."""
    import numpy as np

    classes_n, k = model.emit.shape

    def run(batches) -> Iterator:
        import pyarrow as pa

        # rows of the sums: the emissions by class, then the transitions, then the start
        total = np.zeros((classes_n + k + 1, k))
        for learn, sizes, tokens, classes in arrays(batches, "learn", "sizes", "tokens", "class"):
            learned = learn.fill_null(False).to_numpy(zero_copy_only=False)
            own = tokens[np.repeat(learned, sizes)]
            if not len(own):
                continue
            numbers, _, _ = spans_of(own, sizes[learned].astype(np.int64), span)
            for first in range(0, numbers.shape[1], 2_000):
                part = numbers[:, first : first + 2_000]
                start, moved, emit = model.expected(np.where(part >= 0, classes[np.maximum(part, 0)], -1))
                total[:classes_n] += emit
                total[classes_n:-1] += moved
                total[-1] += start
        used = np.flatnonzero(total.any(axis=1))
        columns = [pa.array(used.astype(np.int32)), *(pa.array(total[used, s]) for s in range(k))]
        yield pa.RecordBatch.from_arrays(columns, names=["row", *(f"z{s}" for s in range(k))])

    schema = ", ".join(["row int", *(f"z{s} double" for s in range(k))])
    sums = blocks.select("learn", "sizes", "tokens", "at", "class").mapInArrow(run, schema)
    sums = sums.groupBy("row").agg(*(F.sum(f"z{s}").alias(f"z{s}") for s in range(k))).collect()  # a row for each class
    total = np.zeros((classes_n + k + 1, k))
    for r in sums:
        total[r[0]] = r[1:]
    emit, move, start = total[:classes_n] + LIGHT, total[classes_n:-1] + LIGHT, total[-1] + LIGHT
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def class_sums(words: DataFrame, classes: int) -> tuple:
    """(tokens, distinct words) of each class in the training texts."""
    import numpy as np

    n, v = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    for r in words.where(F.col("n") > 0).groupBy("class").agg(F.sum("n"), F.count("*")).collect():  # a row for each class
        n[r[0]], v[r[0]] = r[1], r[2]
    return n, v


def score_texts(blocks: DataFrame, model: Hmm, n_class, v_class, own: int, span: int) -> DataFrame:
    """(doc_id, learned, n_tokens, n_known, train_tokens, base_score, score) of every text of the blocks."""
    import numpy as np

    total, distinct = int(n_class.sum()), int(v_class.sum())

    def run(batches) -> Iterator:
        import pyarrow as pa

        for ids, learn, sizes, tokens, n, classes in arrays(batches, "ids", "learn", "sizes", "tokens", "n", "class"):
            sizes = sizes.astype(np.int64)
            base = np.log10((n + 1) / (total + 1 * (distinct + 1)))
            # a word's share of its class: all of it for own classes, else its count plus one
            share = np.where(classes < own, 0.0, np.log10((n + 1) / (n_class[classes] + v_class[classes] + 1)))
            first = np.cumsum(sizes) - sizes
            sums = [np.add.reduceat(x[tokens], first) for x in (base, share, (n > 0).astype(np.int64))]
            score = model.log10(tokens, sizes, classes, span) + sums[1]
            columns = [ids, learn, pa.array(sizes), pa.array(sums[2]), pa.array(np.full(len(sizes), total)), pa.array(sums[0]), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return blocks.mapInArrow(run, "doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def hmm_scores(docs: DataFrame, learn: Column, states: int = STATES, own: int = OWN_CLASSES, signatures: int = SIGNATURES, iterations: int = ITERATIONS, span: int = SPAN, block: int = BLOCK) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text) by a model of the texts where ``learn`` holds."""
    import numpy as np

    blocks = tokenised(docs, learn, block)
    words = stored(word_table(blocks, own, signatures), "lm_table")
    counted = with_counts(blocks, words)
    n_class, v_class = class_sums(words, own + signatures)
    model = first_model((n_class + LIGHT) / (n_class + LIGHT).sum(), states)
    for _ in range(iterations):
        model = iterate(counted, model, span)
    return score_texts(counted, model, n_class.astype(np.int64), v_class, own, span)
