"""Bounded samples of labelled documents, and statistics of whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.text import Words, fold, unsliced

#: Labelled rows that a classifier is fitted on, at most: those whose ids hash lowest.
SAMPLE = 20_000
FOLDS, HELD_OUT = 4, 2


def lowest(rows: DataFrame, limit: int, *columns: str) -> DataFrame:
    """At most `limit` of `rows`: those whose `columns` hash lowest. A share that holds about that many is
    cut by the hash alone, so no task sorts more than its part of it."""
    n = rows.count()
    key = F.xxhash64(*columns)
    if n > 4 * limit:
        rows = rows.where(F.pmod(key, F.lit(1 << 30)) < int((1 << 30) * (limit + 5 * limit**0.5 + 10) / n))
    return rows.orderBy(F.pmod(key, F.lit(1 << 30)), key, *columns).limit(limit)


def document_sample(docs: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """`(doc_id, text)` of at most `limit` documents outside the held-out fold, labelled or not. Rows without
    an id or text are left out; the chosen keys are broadcast and no text is shuffled."""
    keyed = docs.where("doc_id is not null and text is not null").where(fold(F.col("doc_id"), FOLDS) != HELD_OUT).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_key"))
    chosen = lowest(keyed.select("_key"), limit, "_key").distinct()
    return keyed.join(F.broadcast(chosen), "_key").select("doc_id", "text").limit(limit)


def training_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int = SAMPLE) -> DataFrame:
    """`(doc_id, text, y)` of at most `limit` labelled ids outside the held-out fold.

    A null label or id is no label; of labels that differ for one id the largest holds. The chosen ids
    are at most `limit` rows, so they are broadcast and no text is shuffled. Ids without a document give
    no row; a repeated document gives one for each.
    """
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y is not null")
    known = known.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT).groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = lowest(known, limit, "doc_id")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


_SYMBOLS, _CLOSERS = b"#*$%&|<>{}[]\\^~=_@/", b".,;:?"
_CLASSES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": bytes(range(48, 58)), "space": b" \t\r\v\f", "line": b"\n",
    "symbol": _SYMBOLS, "bar": b"|", "shout": b"!", "closer": _CLOSERS, "other": bytes(range(194, 245)),
}
STATISTICS = [
    "log_bytes", *(f"{k}_share" for k in _CLASSES), "byte_entropy", "log_words", "word_bytes", "word_bytes_sd", "longest_word", "distinct_share", "top_share", "repeated_pair_share",
    "upper_word_share", "symbol_word_share", "digit_word_share", "short_word_share", "log_lines", "repeated_line_share", "words_a_line",
]


def _by_doc(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of values between starts; an empty text has 0."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[starts[1:]] - sums[starts[:-1]]


def _runs(doc: np.ndarray, code: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct (doc, code)'s doc and count."""
    key, count = np.unique(doc * width + code, return_counts=True)
    return key // width, count


def statistics(texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A row of STATISTICS for each text, from its whole bytes, words and lines. Null is like empty; an
    empty text's shares are 0."""
    column = unsliced(texts)
    n = len(column)
    out = np.zeros((n, len(STATISTICS)), np.float32)
    if not n:
        return out
    at = {k: i for i, k in enumerate(STATISTICS)}
    _, offsets, data = column.buffers()
    begin = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    text = memoryview(raw)
    hist, lines, again = np.empty((n, 256), np.float64), np.empty(n), np.empty(n)
    for i, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)):
        hist[i] = np.bincount(raw[a:b], minlength=256)
        parts = bytes(text[a:b]).split(b"\n")
        full = [x for x in parts if x and not x.isspace()]
        lines[i], again[i] = len(parts), (len(full) - len(set(full))) / max(len(full), 1)
    size = hist.sum(1)
    some = np.maximum(size, 1)
    out[:, at["log_bytes"]] = np.log1p(size)
    for k, members in _CLASSES.items():
        out[:, at[f"{k}_share"]] = hist[:, list(members)].sum(1) / some
    share = hist / some[:, None]
    out[:, at["byte_entropy"]] = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)
    words = Words(column)
    starts, count = words.starts, np.diff(words.starts)
    few = np.maximum(count, 1)
    out[:, at["log_words"]] = np.log1p(count)
    out[:, at["log_lines"]], out[:, at["repeated_line_share"]], out[:, at["words_a_line"]] = np.log1p(lines), again, np.log1p(count / lines)
    if not len(words):
        return out
    vocab, codes = words.vocab, words.codes
    length = pc.binary_length(vocab).to_numpy(zero_copy_only=False).astype(np.float64)
    each = np.minimum(length, 1000)[codes]
    mean = _by_doc(each, starts) / few
    out[:, at["word_bytes"]] = mean
    out[:, at["word_bytes_sd"]] = np.sqrt(np.maximum(_by_doc(each**2, starts) / few - mean**2, 0))
    full = np.flatnonzero(count)
    out[full, at["longest_word"]] = np.log1p(np.maximum.reduceat(length[codes], starts[:-1][full]))
    kinds = {
        "upper_word_share": np.logical_and(pc.ascii_is_upper(vocab).to_numpy(zero_copy_only=False), length > 1),
        "symbol_word_share": pc.match_substring_regex(vocab, r"[#*$%&|<>{}\[\]\\^~=_@/]").to_numpy(zero_copy_only=False),
        "digit_word_share": pc.match_substring_regex(vocab, r"[0-9]").to_numpy(zero_copy_only=False), "short_word_share": length <= 2,
    }
    for k, flag in kinds.items():
        out[:, at[k]] = _by_doc(flag[codes], starts) / few
    doc = np.repeat(np.arange(n), count)
    owner, times = _runs(doc, codes.astype(np.int64), len(vocab))
    out[:, at["distinct_share"]] = np.bincount(owner, minlength=n) / few
    top = np.zeros(n)
    np.maximum.at(top, owner, times)
    out[:, at["top_share"]] = top / few
    inside = doc[1:] == doc[:-1]
    pair = (codes[:-1].astype(np.int64) * len(vocab) + codes[1:])[inside]
    _, pair = np.unique(pair, return_inverse=True) if len(pair) else (None, pair)
    owner, times = _runs(doc[1:][inside], pair, len(pair) + 1)
    out[:, at["repeated_pair_share"]] = np.bincount(owner, weights=times - 1.0, minlength=n) / few
    return out
