"""Substring dedup by relative Lempel-Ziv parsing of texts against an index of all blocks, kept by anchors."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm.chunks import BLOCK_BYTES, in_blocks, mixed, pack, pack_sorted, plan_sizes, ranges, text_bytes, unpack, unpack_sorted, word_hashes
from parcelspark.llm.text import Words, as_array
from parcelspark.session import materialise

WINDOW, GRAM = 35, 8
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_ASK = "part int, block long, n int, a binary, b binary, c binary, place binary"
_ANSWER = "block long, kind int, part int, n int, answer binary, n_refs int, ref_block binary, ref_place binary"
_FACTORS = "array<struct<start: int, length: int, block: bigint, place: bigint>>"
#: What a block learns about one of its runs of windows.
UNIQUE, COPY, CHECK = 0, 1, 2


class Rolling:
    """Hashes of any run of a number sequence: sums of x[i] * base ** i modulo 2 ** 64, shifted back."""

    def __init__(self, x: np.ndarray, base: int):
        inverse = pow(base, -1, 1 << 64)
        one = np.ones(1, np.uint64)
        powers = np.cumprod(np.concatenate([one, np.full(max(len(x) - 1, 0), base, np.uint64)]))
        self.back = np.cumprod(np.concatenate([one, np.full(len(x), inverse, np.uint64)]))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * powers[: len(x)])])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * self.back[start])


def leftmost_least(values: np.ndarray, span: int) -> np.ndarray:
    """Index of the least of each `span` consecutive values, the leftmost if they tie."""
    at, width = np.arange(len(values)), 1
    while width < span:
        step = min(width, span - width)
        a, b = at[:-step], at[step:]
        at = np.where(values[a] <= values[b], a, b)
        width += step
    return at


class Runs:
    """Windows of a block's texts, gathered into runs.

    A window's anchor is its GRAM-word run of least hash, so equal windows have equal anchors, wherever
    they are. A run is consecutive windows of one text with one anchor; `anchor` and `content` are its
    hashes, windows `first` to `last` belong to it. `at` is the place of each window: the number of its
    first word in the block.
    """

    def __init__(self, words: Words, window: int, gram: int):
        self.window = window
        n = np.diff(words.starts)
        windows = np.maximum(n - window + 1, 0)
        total = int(windows.sum())
        empty = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.first = self.last = self.at
        self.anchor = self.content = empty
        self.rolling = None
        if not total:
            return
        x = word_hashes(words.vocab)[words.codes]
        grams = Rolling(x, _BASES[0])
        self.rolling = Rolling(x, _BASES[1])
        values = grams.of(np.arange(len(x) - gram + 1), gram)
        self.at = np.arange(total) + np.repeat(words.starts[:-1] - (np.cumsum(windows) - windows), windows)
        least = leftmost_least(values, window - gram + 1)[self.at]
        new = np.concatenate([[True], (least[1:] != least[:-1]) | (self.at[1:] != self.at[:-1] + 1)])
        self.first = np.flatnonzero(new)
        self.last = np.concatenate([self.first[1:], [total]]) - 1
        start, stop = self.at[self.first], self.at[self.last]
        lead, length = (least[self.first] - start).astype(np.uint64), (stop - start).astype(np.uint64)
        # a least hash is small: mixed again, anchors fill the range that parts are cut from
        self.anchor = mixed(values[least[self.first]] + np.uint64(_BASES[1]))
        self.content = mixed(self.rolling.of(start, stop - start + window) + lead * np.uint64(_BASES[0]) + length * np.uint64(_BASES[1]))

    def windows_of(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows of the chosen runs: their indices in `at`, anchors and hashes."""
        first, count = self.first[chosen], (self.last - self.first + 1)[chosen]
        index = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
        if not len(index):
            return index, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return index, np.repeat(self.anchor[chosen], count), self.rolling.of(self.at[index], self.window)


class Distinct:
    """The distinct pairs of two hashes, in sorted order; `place` is where each of the given ones is, ascending."""

    def __init__(self, a: np.ndarray, b: np.ndarray, place: np.ndarray):
        self.order = np.lexsort((b, a))  # stable: equal pairs stay in the order of their places
        x, y = a[self.order], b[self.order]
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]) if len(a) else np.zeros(0, bool)
        self.head = np.flatnonzero(new)
        self.pair = np.cumsum(new) - 1
        self.a, self.b = x[self.head], y[self.head]
        self.count = np.diff(np.append(self.head, len(a)))
        self.place = place[self.order]

    def asks(self, block: int, parts: int) -> pa.Table:
        cells, c = ranges(self.a, parts), np.minimum(self.count, 2).astype(np.uint8)
        first = self.place[self.head].astype(np.uint32)
        columns = [pa.array([p for p, _, _ in cells], pa.int32()), pa.array([block] * len(cells), pa.int64()), pa.array([j - i for _, i, j in cells], pa.int32())]
        columns += [pa.array([pack_sorted(self.a[i:j]) for _, i, j in cells], pa.binary()), *(pa.array([pack(x[i:j]) for _, i, j in cells], pa.binary()) for x in (self.b, c, first))]
        return pa.table(columns, names=["part", "block", "n", "a", "b", "c", "place"])

    def resolved(self, block: int, answers: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each given pair, what was answered, and the least place elsewhere, as block and place (-1:
        none): the least of this block's other places and the one that was answered."""
        rows = answers.filter(pa.array(answers["kind"].to_numpy() == kind)).sort_by("part")
        known = np.concatenate([np.zeros(0, np.uint8), *(unpack(x.as_buffer(), n, np.uint8) for x, n in zip(rows["answer"], rows["n"].to_pylist(), strict=True))])
        refs = [np.concatenate([np.zeros(0, np.int64), *(unpack(x.as_buffer(), n, t).astype(np.int64) for x, n in zip(rows[c], rows["n_refs"].to_pylist(), strict=True))]) for c, t in (("ref_block", np.int64), ("ref_place", np.uint32))]
        far = np.full((2, len(known)), -1)
        far[:, (known & COPY) > 0] = refs
        far = far[:, self.pair]
        nth = np.arange(len(self.pair)) - self.head[self.pair]
        second = self.place[np.minimum(self.head + 1, len(self.place) - 1)]
        near = np.where(nth > 0, self.place[self.head[self.pair]], np.where(self.count[self.pair] > 1, second[self.pair], -1)) if len(nth) else nth
        own = (near >= 0) & ((far[0] < 0) | (block <= far[0]))
        out = np.empty((3, len(self.order)), np.int64)
        out[:, self.order] = known[self.pair], np.where(own, block, far[0]), np.where(own, near, far[1])
        return out[0], out[1], out[2]


def _answering(kind: int):
    """For each asked pair: whether it occurs twice or more, and then its least place in another block (-1:
    none); for runs also whether their anchor has other contents, in which case windows are compared one
    by one."""

    def answer(asked: pa.Table) -> pa.Table:
        sizes = asked["n"].to_pylist()
        a = np.concatenate([unpack_sorted(x.as_buffer(), n) for x, n in zip(asked["a"], sizes, strict=True)])
        b, c, place = (np.concatenate([unpack(x.as_buffer(), n, t) for x, n in zip(asked[name], sizes, strict=True)]) for name, t in (("b", np.uint64), ("c", np.uint8), ("place", np.uint32)))
        block = np.repeat(asked["block"].to_numpy(), sizes)
        order = np.lexsort((block, b, a))
        x, y = a[order], b[order]
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        head, pair = np.flatnonzero(new), np.cumsum(new) - 1
        size = np.diff(np.append(head, len(a)))
        twice = np.add.reduceat(c[order].astype(np.int64), head) >= 2
        found = np.where(twice, COPY, UNIQUE).astype(np.uint8)
        if kind == 0:
            same = x[head][1:] == x[head][:-1]
            found += np.where(np.concatenate([[False], same]) | np.concatenate([same, [False]]), CHECK, 0).astype(np.uint8)
        first = np.zeros(len(a), bool)
        first[head] = True
        other = np.where(first, np.where(size[pair] > 1, head[pair] + 1, -1), head[pair])
        status, ref = np.empty(len(a), np.uint8), np.empty((2, len(a)), np.int64)
        status[order] = found[pair]
        ref[:, order] = np.where(other < 0, -1, block[order][other]), np.where(other < 0, 0, place[order][other])
        ends = np.cumsum(sizes)
        cells = [slice(e - n, e) for e, n in zip(ends.tolist(), sizes, strict=True)]
        copies = [status[s] & COPY > 0 for s in cells]
        columns = [pa.array([pack(status[s]) for s in cells], pa.binary()), pa.array([int(m.sum()) for m in copies], pa.int32())]
        columns += [pa.array([pack(ref[k][s][m].astype(t)) for s, m in zip(cells, copies, strict=True)], pa.binary()) for k, t in ((0, np.int64), (1, np.uint32))]
        return pa.table([asked["block"], pa.array([kind] * len(cells), pa.int32()), asked["part"], asked["n"], *columns], names=["block", "kind", "part", "n", "answer", "n_refs", "ref_block", "ref_place"])

    return answer


def _cut(text: str, keep: np.ndarray) -> str:
    """`text` without the words that are not kept and the white space after each."""
    raw = text.encode()
    begin = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    begin.append(len(raw))
    runs = np.flatnonzero(np.diff(np.concatenate([[0], keep.astype(np.int8), [0]])))
    return b"".join(raw[begin[a] : begin[b]] for a, b in zip(runs[::2].tolist(), runs[1::2].tolist(), strict=True)).decode()


def substring_duplicates(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES, texts: bool = True) -> DataFrame:
    """`(row, text, n_words, n_removed, kept_sha256, block, place, factors)`, one row for each row of `docs`.

    A word is removed if a window of `window` words that covers it also starts anywhere else, in the same
    text or another; windows are those of the input. `row` is a struct of all columns of `docs` but text
    (so no name can clash); `text` has removed words and the white space after each cut out, and is null
    with texts=False; kept_sha256 is of the kept words joined by one space. A null text has no words and
    stays null. Repeated rows and copies are duplicates of each other. An empty table gives no rows.

    Texts are parsed left to right, relative to the blocks of the corpus. `block` and `place` say where a text
    is: the number of its first word in its block. A factor (start and length in words of the text, block
    and place of its reference) begins at the first window that also starts elsewhere, at the least such
    place by (block, place), and goes on while that reference goes on to be the least of the next windows;
    there the next factor begins, one word after the last window's start, so that a window across the end
    is checked like any other. Its words are those of its reference, it is at least `window` long, and factors
    cover just the removed words. The reference is the least, not the longest: the factor that goes on for
    longest would need the text of all blocks at once.

    The index of all blocks is kept by anchors (see Runs). A block asks only the partition of the
    anchor, which has the places of each distinct run of windows; where an anchor has several contents,
    windows are asked one by one. Texts are moved to their block, never to an anchor; a block and an
    anchor's partition have bounded sizes, and a passage that every document has costs one entry for each block.
    """
    other = [c for c in docs.columns if c != "text"]
    block_bytes, parts = plan_sizes(text_bytes(docs), block_bytes, 1 / 14)
    text = in_blocks(docs.select(F.struct(*(F.col(f"`{c}`") for c in other)).alias("row"), "text"), block_bytes, "substring-blocks")

    def ask_runs(group: pa.Table) -> pa.Table:
        runs = Runs(Words(group["text"]), window, gram)
        return Distinct(runs.anchor, runs.content, runs.at[runs.first]).asks(group["block"][0].as_py(), parts)

    def known_runs(words: Words, block: int, answers: pa.Table) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray]:
        runs = Runs(words, window, gram)
        return runs, *Distinct(runs.anchor, runs.content, runs.at[runs.first]).resolved(block, answers, 0)

    def ask_windows(group: pa.Table, answers: pa.Table) -> pa.Table:
        block = group["block"][0].as_py() if len(group) else -1
        runs, known, _, _ = known_runs(Words(group["text"]), block, answers)
        index, anchor, content = runs.windows_of(np.flatnonzero(known >= CHECK))
        return Distinct(anchor, content, runs.at[index]).asks(block, parts)

    def parse(group: pa.Table, answers: pa.Table) -> pa.Table:
        words, block = Words(group["text"]), group["block"][0].as_py() if len(group) else -1
        runs, known, ref_block, ref_place = known_runs(words, block, answers)
        ref = np.full((2, len(runs.at)), -1)
        whole = np.flatnonzero(known == COPY)
        index, _, _ = runs.windows_of(whole)
        count = (runs.last - runs.first + 1)[whole]
        ref[0, index] = np.repeat(ref_block[whole], count)
        ref[1, index] = np.repeat(ref_place[whole] - runs.at[runs.first[whole]], count) + runs.at[index]
        index, anchor, content = runs.windows_of(np.flatnonzero(known >= CHECK))
        found, ref_block, ref_place = Distinct(anchor, content, runs.at[index]).resolved(block, answers, 1)
        ref[:, index] = np.where(found == COPY, ref_block, -1), np.where(found == COPY, ref_place, -1)
        copied = ref[0] >= 0
        at, ref = runs.at[copied], ref[:, copied]
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + window, -1)
        keep = np.cumsum(edge[:-1]) == 0
        n = np.diff(words.starts)
        owner = np.searchsorted(words.starts, at, side="right") - 1
        new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(ref[1]) != 1) | (np.diff(ref[0]) != 0) | (np.diff(owner) != 0)]) if len(at) else np.zeros(0, bool)
        head = np.flatnonzero(new)
        length = np.diff(np.append(head, len(at))) + window - 1
        spans = pa.StructArray.from_arrays([pa.array((at[head] - words.starts[owner[head]]).astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(ref[0, head]), pa.array(ref[1, head])], ["start", "length", "block", "place"])
        factors = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[head], np.arange(len(n) + 1)).astype(np.int32)), spans)
        raw, begin, starts = words.spaced(keep)
        shas = [hashlib.sha256(raw[begin[a] : begin[b] - 1] if b > a else b"").hexdigest() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        left = np.diff(starts)
        column = as_array(group["text"])
        if texts and (n != left).any():
            out = column.to_pylist()
            for i in np.flatnonzero(n != left).tolist():
                out[i] = _cut(out[i], keep[words.starts[i] : words.starts[i + 1]])
            column = pa.array(out, pa.string())
        elif not texts:
            column = pa.nulls(len(group), pa.string())
        return pa.table(
            [as_array(group["row"]), column.cast(pa.string()), pa.array(n, pa.int64()), pa.array(n - left, pa.int64()), pa.array(shas, pa.string()), as_array(group["block"]), pa.array(words.starts[:-1], pa.int64()), factors],
            names=["row", "text", "n_words", "n_removed", "kept_sha256", "block", "place", "factors"],
        )

    by_block = text.groupBy("block")
    asked = text.select("block", "text").groupBy("block").applyInArrow(ask_runs, _ASK)
    first = materialise(asked.groupBy("part").applyInArrow(_answering(0), _ANSWER), "substring-runs")
    asked = text.select("block", "text").groupBy("block").cogroup(first.groupBy("block")).applyInArrow(ask_windows, _ASK)
    second = materialise(asked.groupBy("part").applyInArrow(_answering(1), _ANSWER), "substring-windows")
    schema = f"row {text.schema['row'].dataType.simpleString()}, text string, n_words long, n_removed long, kept_sha256 string, block long, place long, factors {_FACTORS}"
    return by_block.cogroup(first.unionByName(second).groupBy("block")).applyInArrow(parse, schema)


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return substring_duplicates(docs, texts=False).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


_LAST = WINDOW - 1
ORACLE_SQL = {
    "op3_substrings": f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
windows AS (SELECT rid, i, md5(array_to_string(ws[i:i+{_LAST}], ' ')) AS h FROM (SELECT rid, ws, unnest(range(1, len(ws) - {_LAST} + 1)) AS i FROM w)),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + {WINDOW})) AS p FROM windows SEMI JOIN twice USING (h)),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM (SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w) x ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, cast(len(ws) AS bigint) AS n_words, cast(len(ws) - coalesce(k.n, 0) AS bigint) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256 FROM w LEFT JOIN kept k USING (rid)"""
}
