"""Packing documents into training sequences (operator 8).

Vector bin packing under three limits for each sequence: tokens, segments
(pieces) and loss-bearing tokens.  Sequences are filled one at a time.  Among
the waiting items that fit, the next is the one whose demand vector has the
largest dot product with the sequence's remaining capacity, both as shares of
the limits.  When none fits whole, the one with the largest product is cut so
that it fills the sequence, and its rest waits on.  A sequence that a limit
stops short is cut back to a power of two.  So each sequence has the full
length or a power of two, and there is no padding.

Each task packs the documents of its own input split in their order, with a
bounded pool of waiting items: no shuffle, and a repeated task gives the same
pieces.  Sequence ids carry the split's number, so they are unique.

Edge cases: a null text is empty and gives the end id alone; an empty table
gives no piece; repeated ``doc_id`` rows are packed each; a null ``doc_id``
stays null.  ``prompt_tokens`` (optional column; absent or null: 0) is the
number of leading tokens of a document that bear no loss.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.tokens import encoder, rows_of

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 64
    loss: int = 4096


@dataclass(frozen=True)
class Pool:
    """How much waits at once: packing starts at ``items`` or ``tokens`` and stops at a quarter of both."""

    items: int = 1024
    tokens: int = 4_000_000


class Packer:
    """Items are (key, tokens, prompt); ``pop`` gives sequences as lists of (key, start, length)."""

    def __init__(self, limits: Limits = Limits()):
        import numpy as np

        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("each limit must be at least 1")
        self.limits, self.keys = limits, []
        self.start, self.stop, self.prompt = (np.zeros(0, np.int64) for _ in range(3))
        self.waiting = 0

    def add(self, items: list[tuple]) -> None:
        import numpy as np

        live = np.flatnonzero(self.stop > self.start)
        self.keys = [self.keys[i] for i in live] + [i[0] for i in items]
        more = np.array([[0, i[1], i[2]] for i in items], np.int64).reshape(-1, 3).T
        self.start, self.stop, self.prompt = (np.concatenate((a[live], b)) for a, b in zip((self.start, self.stop, self.prompt), more, strict=True))
        self.waiting = int((self.stop - self.start).sum())

    @property
    def items(self) -> int:
        return int((self.stop > self.start).sum())

    def pop(self) -> list[tuple]:
        """The next sequence."""
        import numpy as np

        limits = self.limits
        room, segments, loss_room = limits.tokens, limits.segments, limits.loss
        tokens = self.stop - self.start
        loss = self.stop - np.maximum(self.start, self.prompt)
        np.maximum(loss, 0, out=loss)
        taken: list[list[int]] = []
        while room and segments and tokens.any():
            product = tokens * (room / limits.tokens**2) + loss * (loss_room / limits.loss**2)  # a segment counts alike for all
            fits = (tokens > 0) & (tokens <= room) & (loss <= loss_room)
            if segments > 1 and fits.any():
                k = int(np.argmax(np.where(fits, product, -1.0)))
                length = int(tokens[k])
            else:
                # The last segment, or nothing fits: the item that can fill most of the room.
                free = np.maximum(self.prompt - self.start, 0) + loss_room
                most = np.minimum(np.minimum(tokens, room), free)
                k = int(np.argmax(most * (limits.tokens + 1.0) + np.minimum(product, limits.tokens)))
                length = int(most[k])
                if length == 0:
                    break
            taken.append([k, int(self.start[k]), length])
            bears = length - max(0, min(length, int(self.prompt[k] - self.start[k])))
            self.start[k] += length
            tokens[k] -= length
            loss[k] -= bears
            room, segments, loss_room = room - length, segments - 1, loss_room - bears
        size = limits.tokens - room
        excess = 0 if room == 0 else size - (1 << (size.bit_length() - 1))
        while excess:
            k, _, length = last = taken[-1]
            cut = min(excess, length)
            self.start[k] -= cut
            excess -= cut
            last[2] -= cut
            if last[2] == 0:
                taken.pop()
        self.waiting -= sum(x[2] for x in taken)
        return [(self.keys[k], start, length) for k, start, length in taken]


def pack_documents(docs: DataFrame, tokenizer_file: str, end_id: int = 2, limits: Limits = Limits(), pool: Pool = Pool(), with_ids: bool = False) -> DataFrame:
    """One row per piece (``SCHEMA``; with_ids adds the piece's ids as little-endian bytes)."""
    prompt = F.coalesce(F.col("prompt_tokens").cast("long"), F.lit(0)) if "prompt_tokens" in docs.columns else F.lit(0)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), prompt.cast("long").alias("prompt"))

    def run(batches) -> Iterator:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 36
        tokens, end = encoder(tokenizer_file), end_id.to_bytes(4, "little")
        packer, texts, out, made = Packer(limits), {}, [], 0
        new, new_tokens = [], 0

        def drain(items: int, waiting: int):
            nonlocal made
            while packer.waiting and (packer.waiting > waiting or packer.items > items):
                offset = 0
                for key, start, length in packer.pop():
                    doc_id, ids = texts[key][:2]
                    part = ids[4 * start : 4 * (start + length)]
                    out.append((doc_id, start, length, zlib.crc32(part), len(ids) // 4, first + made, offset) + ((part,) if with_ids else ()))
                    offset += length
                    texts[key][2] -= length
                    if not texts[key][2]:
                        del texts[key]
                made += 1

        for number, (doc_id, text, skip) in enumerate(rows_of(batches, "doc_id", "text", "prompt")):
            ids = tokens.encode(text) + end
            texts[number] = [doc_id, ids, len(ids) // 4]
            new.append((number, len(ids) // 4, skip))
            new_tokens += len(ids) // 4
            if len(new) + packer.items >= pool.items or new_tokens + packer.waiting >= pool.tokens:
                packer.add(new)
                new, new_tokens = [], 0
                drain(pool.items // 4, pool.tokens // 4)
                yield _batch(out, with_ids)
                out.clear()
        packer.add(new)
        drain(0, 0)
        yield _batch(out, with_ids)

    return rows.mapInArrow(run, SCHEMA + (", ids binary" if with_ids else ""))


def _batch(rows: list[tuple], with_ids: bool):
    import pyarrow as pa

    names = [c.split()[0] for c in SCHEMA.split(", ")] + (["ids"] if with_ids else [])
    types = [pa.int64()] * 7 + ([pa.binary()] if with_ids else [])
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
