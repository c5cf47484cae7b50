"""Hashes of words and of word shingles for many texts at once (numpy).

Words are runs of bytes other than ASCII white space, with A-Z in lower case.
With ``plain`` set, ASCII punctuation separates words as well.  A word's hash is a polynomial in 2^64 over random values of its bytes, mixed
with its length.  A shingle's hash mixes the hashes of its words in order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

WORDS = 5
_STATE: dict = {}


def _tables(size: int):
    import numpy as np

    if not _STATE:
        random = np.random.Generator(np.random.PCG64(20240601)).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        upper = np.arange(65, 91)
        random[upper] = random[upper + 32]
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        plain = space.copy()
        plain[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
        _STATE.update(random=random, space=space, plain=plain, base=pow(0x9E3779B97F4A7C15, 1, 1 << 64), powers=np.ones(1, np.uint64), inverse=np.ones(1, np.uint64))
    if len(_STATE["powers"]) < size:
        size = max(size, 1 << 20)
        base = _STATE["base"]
        for name, step in (("powers", base), ("inverse", pow(base, -1, 1 << 64))):
            row = np.full(size, step, np.uint64)
            row[0] = 1
            _STATE[name] = np.cumprod(row, dtype=np.uint64)
    return _STATE["random"], _STATE["powers"], _STATE["inverse"]


def mix(h):
    """A bijection of 64-bit numbers that spreads their bits (splitmix64's last steps)."""
    import numpy as np

    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[bytes], plain: bool = False):
    """(hashes of all words, first[i], first[i + 1]: where text i's words are, byte start and end of each word in its text)."""
    import numpy as np

    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    random, powers, inverse = _tables(len(joined) + 1)
    blank = _STATE["plain" if plain else "space"][joined]
    edge = np.diff(np.concatenate((np.ones(1, bool), blank)).view(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    prefix = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(random[joined] * powers[: len(joined)], out=prefix[1:])
    h = mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))
    offset = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offset[1:])
    first = np.searchsorted(start, offset)
    base = np.repeat(offset[:-1], np.diff(first))
    return h, first, start - base, end - base


def ngram_hashes(words, k: int):
    """The hash of each run of ``k`` words."""
    import numpy as np

    count = max(0, len(words) - k + 1)
    h = np.full(count, k, np.uint64)
    for j in range(k):
        h = mix((h ^ words[j : j + count]) * np.uint64(0x9E3779B97F4A7C15))
    return h


def shingle_lists(texts: list[bytes], k: int = WORDS) -> Iterator:
    """For each text its shingle hashes in order: all runs of k words, or the whole sequence if it is shorter."""
    words, first, _, _ = word_hashes(texts)
    runs = ngram_hashes(words, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield runs[a : b - k + 1] if b - a >= k else ngram_hashes(words[a:b], b - a) if b > a else runs[:0]


def shingle_sets(texts: list[bytes], k: int = WORDS) -> Iterator:
    """For each text its sorted distinct shingle hashes."""
    import numpy as np

    for h in shingle_lists(texts, k):
        h = np.sort(h)
        yield h[np.concatenate((np.ones(1, bool), h[1:] != h[:-1]))] if len(h) else h


def text_batches(batches: Iterable, *columns: str, size: int = 2_000_000) -> Iterator[tuple]:
    """Arrow batches as (tuple of column lists); the first column is the text, as bytes (null: empty); about ``size`` bytes at once."""
    import pyarrow as pa

    for batch in batches:
        text = batch.column(batch.schema.get_field_index(columns[0])).cast(pa.binary())
        others = [batch.column(batch.schema.get_field_index(c)) for c in columns[1:]]
        start = 0
        while start < batch.num_rows:
            stop, held = start, 0
            while stop < batch.num_rows and (held < size or stop == start):
                held += len(text[stop].as_buffer()) if text[stop].is_valid else 0
                stop += 1
            yield ([t or b"" for t in text.slice(start, stop - start).to_pylist()], *(c.slice(start, stop - start).to_pylist() for c in others))
            start = stop


class HashArray:
    """Positions of hashes in a sorted array, by the bucket of their leading bits."""

    def __init__(self, keys):
        import numpy as np

        self.keys = np.append(keys, np.uint64(2**64 - 1))
        bits = max(1, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.longest = int(np.diff(np.append(self.first, len(keys))).max())
        self.size = len(keys)

    def find(self, wanted):
        """Index of each hash, -1 where it is absent."""
        import numpy as np

        at = self.first[(wanted >> self.shift).astype(np.int64)]
        found = np.where((self.keys[at] == wanted) & (at < self.size), at, np.int32(-1))
        left = np.flatnonzero(found < 0)
        for _ in range(1, self.longest):
            left = left[self.keys[at[left]] < wanted[left]]
            if not len(left):
                break
            at[left] += 1
            hit = left[(self.keys[at[left]] == wanted[left]) & (at[left] < self.size)]
            found[hit] = at[hit]
        return found
