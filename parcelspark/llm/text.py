"""Words of whole texts, as column expressions and as Arrow arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of `text` as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo `modulus`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def unsliced(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """`column` with null as empty, its offsets counted from 0: Arrow's kernels for ASCII text misread the
    bytes of a slice."""
    column = pc.fill_null(as_array(column).cast(pa.large_string()), "")
    if not len(column):
        return pa.array([], pa.large_string())
    _, offsets, data = column.buffers()
    begin = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = pa.py_buffer(b"") if data is None else data.slice(begin[0], begin[-1] - begin[0])
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(begin - begin[0]), data)


def slices(column: pa.Array, limit: int = 4 << 20) -> Iterator[pa.Array]:
    """`column` in order, in slices of about `limit` bytes of text; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(column)]
    return (column.slice(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


class Words:
    """Words of a batch of texts: `vocab` (distinct words), `codes` (one for each word, in order),
    `starts` (len(texts) + 1 offsets into codes). A null text has no words."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, lower: bool = False):
        texts = unsliced(texts)
        if lower:
            texts = pc.ascii_lower(texts) if len(texts) else texts
        pieces = pc.ascii_split_whitespace(texts)
        values, offsets = pieces.values, pieces.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        values = values.slice(offsets[0], offsets[-1] - offsets[0]) if len(offsets) else values
        full = pc.binary_length(values).to_numpy(zero_copy_only=False) > 0
        counted = np.concatenate([[0], np.cumsum(full)])
        self.starts = counted[offsets - offsets[0]]
        words = values.filter(pa.array(full)) if not full.all() else values
        coded = words.dictionary_encode()
        self.words = words
        self.vocab: pa.Array = coded.dictionary
        self.codes: np.ndarray = coded.indices.to_numpy(zero_copy_only=False)

    def __len__(self) -> int:
        return len(self.codes)

    def spaced(self, keep: np.ndarray | None = None) -> tuple[memoryview, np.ndarray, np.ndarray]:
        """Bytes of all (kept) words, each followed by one space; where each word begins in them (and
        the end); each text's first word, and the end. Words a to b of a text, joined by one space, are
        the bytes from begin[a] to begin[b + 1] - 1."""
        words, starts = self.words, self.starts
        if keep is not None:
            starts = np.concatenate([[0], np.cumsum(keep)])[starts]
            words = words.filter(pa.array(keep))
        text = pc.binary_join_element_wise(words, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
        _, offsets, data = text.buffers()
        begin = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
        return memoryview(data or b""), begin, starts
