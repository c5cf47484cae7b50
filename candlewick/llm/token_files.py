"""Token-ID files with fixed-width bit packing (operator 6).

File layout (little-endian):

    magic "CWIDS1\\0\\0" | u32 bits | u32 ids in a block
    blocks                 each 64-bit words that hold the block's ids, ``bits`` bits each
    i64 document ids | u8 null flags | i64 starts (ids before each document, in this file)
    u64 offset of each block
    u64 blocks | u64 documents | u64 ids | u64 position of the document table | magic

An id takes the fewest bits that the vocabulary needs.  A block holds a
multiple of 64 ids, so the packing has a period of whole words, and numpy packs
or unpacks a block column by column.  The block offsets allow random access to
the ids of any document.

The corpus is range-partitioned by ``doc_id`` and sorted; each task streams its
share into one file of the shared folder and returns a manifest row.  Only the
manifest that Spark commits names files, so the file of a lost or repeated task
is never read.  The driver sees one manifest row for each file.

Edge cases: a null text is the empty text (only the end id); a null ``doc_id``
sorts first and comes back null; repeated ids stay, ordered by their text's
hash; an empty table writes no file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import folder, shuffle_partitions, stored
from candlewick.llm.shared_files import make_folder, open_input, open_output
from candlewick.llm.tokens import encoder, rows_of

MAGIC = b"CWIDS1\0\0"
BLOCK_IDS = 1 << 16
HEAD = struct.Struct("<8sII")
TAIL = struct.Struct("<QQQQ8s")


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids, bits: int):
    """A numpy uint32 array as uint64 words; 64 ids fill ``bits`` words."""
    import numpy as np

    rows = -(-len(ids) // 64)
    padded = np.zeros(rows * 64, np.uint64)
    padded[: len(ids)] = ids
    columns, words = padded.reshape(rows, 64), np.zeros((rows, bits), np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        words[:, word] |= columns[:, k] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= columns[:, k] >> np.uint64(64 - shift)
    return words.ravel()


def unpack(words, bits: int, count: int):
    """The first ``count`` ids of packed words, as uint32."""
    import numpy as np

    rows = -(-count // 64)
    words, ids, mask = words[: rows * bits].reshape(rows, bits), np.empty((rows, 64), np.uint32), np.uint64((1 << bits) - 1)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        ids[:, k] = value & mask
    return ids.ravel()[:count]


class IdFileWriter:
    """Streams documents into one file; holds one block and the document table."""

    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS):
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.held, self.held_bytes = [], 0
        self.docs, self.starts, self.offsets = [], [], []
        self.ids = 0
        self.at = out.write(HEAD.pack(MAGIC, bits, block_ids))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.starts.append(self.ids)
        self.ids += len(ids) // 4
        self.held.append(ids)
        self.held_bytes += len(ids)
        if self.held_bytes >= 4 * self.block_ids:
            whole = b"".join(self.held)
            step = 4 * self.block_ids
            end = len(whole) - len(whole) % step
            for start in range(0, end, step):
                self._block(whole[start : start + step])
            self.held, self.held_bytes = [whole[end:]], len(whole) - end

    def _block(self, ids: bytes) -> None:
        import numpy as np

        self.offsets.append(self.at)
        self.at += self.out.write(pack(np.frombuffer(ids, "<u4"), self.bits).tobytes())

    def close(self) -> None:
        import numpy as np

        if self.held_bytes:
            self._block(b"".join(self.held))
        table = self.at
        self.out.write(np.array([d or 0 for d in self.docs], "<i8").tobytes())
        self.out.write(np.array([d is None for d in self.docs], "u1").tobytes())
        self.out.write(np.array(self.starts, "<i8").tobytes())
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(TAIL.pack(len(self.offsets), len(self.docs), self.ids, table, MAGIC))
        self.out.close()


class IdFile:
    """Random access to a file by document position or by id range."""

    def __init__(self, source):
        import numpy as np

        self.source = source
        size = source.size()
        magic, self.bits, self.block_ids = HEAD.unpack(self._read(0, HEAD.size))
        blocks, docs, self.ids, table, end = TAIL.unpack(self._read(size - TAIL.size, TAIL.size))
        if magic != MAGIC or end != MAGIC:
            raise ValueError("not a token-ID file, or a cut one")
        body = self._read(table, 17 * docs + 8 * blocks)
        self.doc_ids = np.frombuffer(body, "<i8", docs)
        self.is_null = np.frombuffer(body, "u1", docs, 8 * docs)
        self.starts = np.append(np.frombuffer(body, "<i8", docs, 9 * docs), self.ids)
        self.offsets = np.frombuffer(body, "<u8", blocks, 17 * docs)
        self.last = (-1, None)

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def _block(self, k: int):
        import numpy as np

        if self.last[0] != k:
            count = min(self.block_ids, self.ids - k * self.block_ids)
            size = -(-count // 64) * self.bits * 8
            words = np.frombuffer(self._read(int(self.offsets[k]), size), "<u8")
            self.last = (k, unpack(words, self.bits, count))
        return self.last[1]

    def read(self, start: int, stop: int):
        import numpy as np

        parts, at = [], start
        while at < stop:
            k, within = divmod(at, self.block_ids)
            part = self._block(k)[within : within + stop - at]
            parts.append(part)
            at += len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def document(self, k: int):
        return self.read(int(self.starts[k]), int(self.starts[k + 1]))


def write_ids(docs: DataFrame, tokenizer_file: str, end_id: int = 0, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files; returns the manifest (part, path, n_docs, n_ids)."""
    spark = docs.sparkSession
    to = folder(spark, "token_ids")
    n = shuffle_partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")

    def write(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task, writer = TaskContext.get(), None
        tokens = encoder(tokenizer_file)
        end = struct.pack("<I", end_id)
        path = f"{to}/part-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            if writer is None:
                make_folder(to)
                writer = IdFileWriter(open_output(path), bits_for(tokens.vocabulary), block_ids)
            writer.add(doc_id, tokens.encode(text) + end)
        if writer is not None:
            writer.close()
            row = {"part": [task.partitionId()], "path": [path], "n_docs": [len(writer.docs)], "n_ids": [writer.ids]}
            yield pa.RecordBatch.from_pydict(row)

    schema = "part long, path string, n_docs long, n_ids long"
    return stored(rows.select("doc_id", "text").mapInArrow(write, schema), "token_manifest")


def read_ids(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, the ids."""
    spark = manifest.sparkSession
    files, base = [], 0
    for row in manifest.orderBy("part").collect():  # one row for each file
        files.append((row.path, base))
        base += row.n_ids
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def read(batches) -> Iterator:
        import pyarrow as pa

        for (k,) in rows_of(batches, "id"):
            path, before = files[k]
            source = open_input(path)
            file = IdFile(source)
            for first in range(0, len(file.doc_ids), 2000):
                out = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []} | ({"ids": []} if with_ids else {})
                for d in range(first, min(first + 2000, len(file.doc_ids))):
                    ids = file.document(d)
                    out["doc_id"].append(None if file.is_null[d] else int(file.doc_ids[d]))
                    out["start"].append(before + int(file.starts[d]))
                    out["n_tokens"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                    if with_ids:
                        out["ids"].append(ids.astype("i4"))
                types = [pa.int64()] * 4 + ([pa.list_(pa.int32())] if with_ids else [])
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))
            source.close()

    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(read, schema)
