"""Blocks of texts, and sorted key arrays as binary columns: what blocks ask the key's partition, and what
it answers.

A block asks once for each distinct key, so what moves for one key is one entry for each block that has
it, and a hot key is no larger than the number of blocks. Answers are aligned with the asked keys and
need not repeat them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.session import materialise

#: Text of a block, and keys that one task compares, about, while a block has at least CELL keys for a part.
BLOCK_BYTES, KEYS_EACH, CELL = 4 << 20, 2_000_000, 512
#: What a block and a part may grow to, as multiples of these: 256 MB of text and 128 million keys, at 50 TB or more
#: of text. A task then takes some 6 GB.
BLOCK_GROWTH, PART_GROWTH = 64, 64


def plan_sizes(text_bytes: float, block_bytes: int = BLOCK_BYTES, keys_a_word: float = 1.0) -> tuple[int, int]:
    """`(block_bytes, parts)`: parts are a power of two. Both sizes grow as the square root of the corpus, so
    that what a block sends to a part stays some hundred keys, until they reach their limits."""
    words = max(text_bytes / 6, 1.0)
    growth = sqrt(max(1.0, CELL * words / (max(block_bytes, BLOCK_BYTES) / 6 * KEYS_EACH)))
    parts = words * keys_a_word / (KEYS_EACH * min(growth, PART_GROWTH))
    return int(block_bytes * min(growth, BLOCK_GROWTH)), 1 << max(6, int(np.ceil(np.log2(max(parts, 1)))))


def text_blocks(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[tuple[int, pa.Table]]:
    """Rows in order, in blocks of about `limit` bytes of text (a longer text is a block of its own), with a
    number that no other block of the table has. Blocks follow the order of reading, so rows that are alike
    share none for it, and what is numbered must be written once and read from there."""
    task, nth, held, size = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        low = 0
        while low < len(lengths):
            upto = np.cumsum(lengths[low:]) + size
            high = low + int(np.searchsorted(upto, limit, side="right"))
            if high == len(lengths):
                held.append(batch.slice(low))
                size = int(upto[-1])
                break
            high = high + (high == low and not held)
            if high > low:
                held.append(batch.slice(low, high - low))
            yield task << 33 | nth, pa.Table.from_batches(held)
            nth, held, size, low = nth + 1, [], 0, high
    if held:
        yield task << 33 | nth, pa.Table.from_batches(held)


def text_bytes(docs: DataFrame) -> int:
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def in_blocks(docs: DataFrame, block_bytes: int, name: str) -> DataFrame:
    """`docs` with a long column `block` in front, written to the shared folder."""
    columns = docs.columns

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in text_blocks(batches, columns.index("text"), block_bytes):
            rows = rows.combine_chunks()
            for batch in rows.to_batches():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(batch), block)), *batch.columns], ["block", *columns])

    return materialise(docs.mapInArrow(tagged, docs.select(F.lit(0).cast("long").alias("block"), "*").schema), name)


def pack(a: np.ndarray) -> bytes:
    """Byte planes, compressed."""
    planes = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = pa.decompress(data, decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys by their differences, whose high bytes vanish."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n, np.uint64), dtype=np.uint64)


def ranges(keys: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """`(part, low, high)` of each part that has some of the sorted `keys`: parts, a power of two, are equal
    ranges of the 64-bit space, known by the key's high bits."""
    if not len(keys):
        return []
    part = (keys >> np.uint64(65 - parts.bit_length())).astype(np.int64) if parts > 1 else np.zeros(len(keys), np.int64)
    at = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(keys)]])
    return list(zip(part[at[:-1]].tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (a finaliser of two multiplications)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(vocab: pa.Array, seed: int = 0) -> np.ndarray:
    """XXH64 of each distinct word's bytes."""
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(x, seed) for x in pc.cast(vocab, pa.large_binary()).to_pylist()), np.uint64, len(vocab))
