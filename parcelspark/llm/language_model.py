"""LM scoring: a weighted backoff automaton over smoothed n-grams, one traversal for each text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm.chunks import BLOCK_BYTES, mixed, pack, pack_sorted, plan_sizes, ranges, text_blocks, text_bytes, unpack, unpack_sorted, word_hashes
from parcelspark.llm.text import Words, as_array, fold
from parcelspark.session import materialise

#: Weight of the shorter history's distribution in a state of one and of two words, as if so many words had been seen there.
PRIORS = (1000.0, 50.0)
#: No word is empty, so neither number is a word's.
_START, _END = 0x6C62272E07BB0142, 0xEF46DB3751D8E999
_PAIR, _TRIPLE = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)
WORDS, PAIRS, TRIPLES = 0, 1, 2
_ASK = "part int, block long, kind int, n int, grams binary, counts binary"
_ANSWER = "block long, kind int, part int, n int, counts binary, types long, tokens long"


class Sequence:
    """The tokens of a block's texts: each text's words, A-Z lowered, and one end.

    Words are known by their 64-bit hashes. `word` and `pair` index the sorted distinct words and
    (last word, word) pairs, `triple` the distinct (last pair, word) triples; a text begins after a start
    token, and its first token has no triple (-1).
    """

    def __init__(self, words: np.ndarray, word: np.ndarray, starts: np.ndarray):
        self.words, self.word, self.starts = words, word, starts
        self.start = int(np.searchsorted(words, np.uint64(_START)))
        self.end = int(np.searchsorted(words, np.uint64(_END)))
        first = starts[:-1]
        self.last = np.full(len(word), self.start)
        self.last[1:] = word[:-1]
        self.last[first] = self.start
        self.pairs, self.pair = np.unique(mixed(words[self.last] * _PAIR + words[word]), return_inverse=True)
        self.before = np.full(len(word), -1)
        self.before[1:] = self.pair[:-1]
        self.before[first] = -1

    @classmethod
    def of(cls, texts: pa.Array | pa.ChunkedArray) -> Sequence:
        found = Words(texts, lower=True)
        docs = len(found.starts) - 1
        hashes = np.concatenate([word_hashes(found.vocab), np.array([_END, _START], np.uint64)])
        words, rank = np.unique(hashes, return_inverse=True)
        where = np.arange(len(found)) + np.repeat(np.arange(docs), np.diff(found.starts))
        word = np.full(len(found) + docs, rank[-2])
        word[where] = rank[found.codes]
        return cls(words, word, found.starts + np.arange(docs + 1))

    def counts(self, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the words and of the pairs, in the texts of `training`."""
        self.used = np.repeat(training, np.diff(self.starts)).astype(bool)
        return np.bincount(self.word[self.used], minlength=len(self.words)), np.bincount(self.pair[self.used], minlength=len(self.pairs))

    def triples(self, shared: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct triples, their counts in training (see counts), the tokens that end one (without
        those whose two pairs are not both `shared`), and the triple of each."""
        at = np.flatnonzero(self.before >= 0)
        if shared is not None:
            at = at[shared[self.before[at]] & shared[self.pair[at]]]
        grams, triple = np.unique(mixed(self.pairs[self.before[at]] * _TRIPLE + self.words[self.word[at]]), return_inverse=True)
        return grams, np.bincount(triple[self.used[at]], minlength=len(grams)), at, triple


class Automaton:
    """The part of the model that a block's texts meet.

    States are the root, every word and every pair of words seen in training (and the start, alone or
    before a word). An arc for each n-gram seen carries log10 (count + prior * p) / (state's count + prior),
    p being the word's probability after the shorter history, and leads to the longest state that ends the
    history and the word. A failure arc, log10 prior / (state's count + prior), leads to the state without
    its first word; the root has arcs log10 p for all words, with one share for all unseen ones. The words
    that follow any state thus sum to one.
    """

    def __init__(self, sequence: Sequence, words: np.ndarray, pairs: np.ndarray, triple_counts: np.ndarray, tokens: int, types: int, priors: tuple[float, float]):
        """`triple_counts` is of each token's triple, 0 where it has none."""
        s = sequence
        seen = words.astype(np.float64)
        seen[s.start] = words[s.end]  # a text that starts also ends
        p1 = ((words + 1.0) / (tokens + types + 1.0))[s.word]
        n1, n2 = seen[s.last], np.where(s.before >= 0, pairs[s.before], 0)
        p2 = (pairs[s.pair] + priors[0] * p1) / (n1 + priors[0])
        p3 = (triple_counts + priors[1] * p2) / (n2 + priors[1])
        #: states of two, one and no words that a history can be in: whether they exist, how they fail, whether a token has an arc there, its weight
        self.state = [n2 > 0, n1 > 0, np.ones(len(p1), bool)]
        self.fail = [np.log10(priors[1] / (n2 + priors[1])), np.log10(priors[0] / (n1 + priors[0])), np.zeros(len(p1))]
        self.has = [triple_counts > 0, pairs[s.pair] > 0, np.ones(len(p1), bool)]
        self.arc = [np.log10(p3), np.log10(p2), np.log10(p1)]

    def traverse(self) -> np.ndarray:
        """Log-probability of each token, left to right. Whatever arc a token took, it led to the longest state
        that ends in that token, so the state a token is read in is known from the two tokens before it,
        and all texts of a block take their steps at once; each follows its own chain of failure arcs."""
        depth = np.where(self.state[0], 0, np.where(self.state[1], 1, 2))
        out, reading = np.zeros(len(depth)), np.arange(len(depth))
        for d in range(3):
            here = reading[depth[reading] <= d]
            done = self.has[d][here]
            out[here] += np.where(done, self.arc[d][here], self.fail[d][here])
            reading = np.setdiff1d(reading, here[done], assume_unique=True)
        return out


def _asks(block: int, kind: int, grams: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    cells = ranges(grams, parts)
    counts = counts.astype(np.uint64)
    n = [b - a for _, a, b in cells]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([p for p, _, _ in cells], pa.int32()), pa.array([block] * len(cells), pa.int64()), pa.array([kind] * len(cells), pa.int32()), pa.array(n, pa.int32()),
            pa.array([pack_sorted(grams[a:b]) for _, a, b in cells], pa.binary()), pa.array([pack(counts[a:b]) for _, a, b in cells], pa.binary()),
        ],
        names=["part", "block", "kind", "n", "grams", "counts"],
    )


def answer_counts(asked: pa.Table) -> pa.Table:
    """To each asked n-gram of one part, twice its count over all blocks, and one more if several blocks have
    it. Distinct words and their total are told once for a part."""
    out = []
    for kind in (WORDS, PAIRS, TRIPLES):
        rows = asked.filter(pa.array(asked["kind"].to_numpy() == kind))
        if not len(rows):
            continue
        sizes = rows["n"].to_pylist()
        gram = np.concatenate([unpack_sorted(x.as_buffer(), n) for x, n in zip(rows["grams"], sizes, strict=True)])
        count = np.concatenate([unpack(x.as_buffer(), n, np.uint64) for x, n in zip(rows["counts"], sizes, strict=True)])
        distinct, inverse = np.unique(gram, return_inverse=True)
        del gram
        total = np.zeros(len(distinct), np.uint64)
        np.add.at(total, inverse, count)
        several = (np.bincount(inverse, minlength=len(distinct)) > 1).astype(np.uint64)
        each, ends = (total * np.uint64(2) + several)[inverse], np.cumsum(sizes)
        once = np.zeros((2, len(rows)), np.int64)
        if kind == WORDS:
            once[:, 0] = int((total > 0).sum()), int(total.sum())
        cells = [pack(each[e - n : e]) for e, n in zip(ends.tolist(), sizes, strict=True)]
        out.append(pa.table([rows["block"], rows["kind"], rows["part"], rows["n"], pa.array(cells, pa.binary()), pa.array(once[0]), pa.array(once[1])], names=["block", "kind", "part", "n", "counts", "types", "tokens"]))
    return pa.concat_tables(out)


def _answered(answers: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the block's n-grams of this kind, as they are sorted, and whether other blocks have them."""
    rows = answers.filter(pa.array(answers["kind"].to_numpy() == kind)).sort_by("part")
    found = [unpack(x.as_buffer(), n, np.uint64) for x, n in zip(rows["counts"], rows["n"].to_pylist(), strict=True)]
    both = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return (both >> np.uint64(1)).astype(np.int64), (both & np.uint64(1)) > 0


def language_model_scores(docs: DataFrame, training, priors: tuple[float, float] = PRIORS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`(doc_id, training, n_tokens, n_known, train_tokens, base_score, score)` for each row of `docs`.

    `training` is a boolean column: the rows whose counts make the model; all rows are scored. Null and
    empty texts are their end alone. base_score sums log10((c + 1) / (N + V + 1)) with c the token's
    count, N all and V distinct training tokens; `score` is the automaton's log10 probability. Repeated
    rows count and are scored each; null ids are like others; an empty table gives no rows. Without
    training rows every token is unknown.

    No part of the model is broadcast, since it grows with the corpus. A block of texts, kept as numbers
    in one row, asks for the counts of its own distinct n-grams; the partition of an n-gram sums what
    blocks saw of it and answers each. Words and pairs are asked first. A triple can be in another block
    only if both of its pairs are; only such triples are asked, the counts of the others are the block's own.
    Counts are 64-bit.
    """
    block_bytes, parts = plan_sizes(text_bytes(docs), block_bytes, 0.8)
    given = docs.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("training"))
    kind = given.schema["doc_id"].dataType.simpleString()
    spec = f"block long, doc_id array<{kind}>, training array<boolean>, starts array<int>, n int, words binary, word binary"

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in text_blocks(batches, 1, block_bytes):
            s = Sequence.of(rows["text"])
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (as_array(rows["doc_id"]), as_array(rows["training"]), pa.array(s.starts.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays([pa.array([block]), *lists, pa.array([len(s.words)], pa.int32()), pa.array([pack_sorted(s.words)], pa.binary()), pa.array([pack(s.word.astype(np.uint32))], pa.binary())], ["block", "doc_id", "training", "starts", "n", "words", "word"])

    blocks = materialise(given.mapInArrow(numbered, spec), "lm-blocks")

    def read(row: dict) -> tuple[Sequence, np.ndarray, np.ndarray]:
        """The block's tokens and its own counts of words and pairs."""
        starts = np.array(row["starts"], np.int64)
        s = Sequence(unpack_sorted(row["words"], row["n"]), unpack(row["word"], int(starts[-1]), np.uint32).astype(np.int64), starts)
        return s, *s.counts(np.array(row["training"], bool))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                s, words, pairs = read(row)
                yield _asks(row["block"], WORDS, s.words, words, parts)
                yield _asks(row["block"], PAIRS, s.pairs, pairs, parts)

    def ask_triples(group: pa.Table, answers: pa.Table) -> pa.Table:
        row = group.to_pylist()[0]
        s = read(row)[0]
        grams, counts, _, _ = s.triples(_answered(answers, PAIRS)[1])
        return pa.Table.from_batches([_asks(row["block"], TRIPLES, grams, counts, parts)])

    def score(group: pa.Table, answers: pa.Table) -> pa.Table:
        row = group.to_pylist()[0]
        s = read(row)[0]
        (words, _), (pairs, shared) = _answered(answers, WORDS), _answered(answers, PAIRS)
        counts = np.zeros(len(s.word), np.int64)
        _, own, at, triple = s.triples()
        counts[at] = own[triple]
        _, _, at, triple = s.triples(shared)
        counts[at] = _answered(answers, TRIPLES)[0][triple]
        steps = Automaton(s, words, pairs, counts, tokens, types, priors).traverse()
        base = np.log10((words + 1.0) / (tokens + types + 1.0))[s.word]
        first = s.starts[:-1]
        known = np.add.reduceat((words > 0).astype(np.int64)[s.word], first)
        return pa.table(
            [as_array(group["doc_id"]).flatten(), as_array(group["training"]).flatten(), pa.array(np.diff(s.starts)), pa.array(known), pa.array(np.full(len(first), tokens)), pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(steps, first))],
            names=["doc_id", "training", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def answered(asks: DataFrame, name: str) -> DataFrame:
        return materialise(asks.groupBy("part").applyInArrow(answer_counts, _ANSWER), name)

    first = answered(blocks.mapInArrow(ask, _ASK), "lm-words")
    totals = first.agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens")).first()
    types, tokens = totals["types"] or 0, totals["tokens"] or 0
    by_block = blocks.groupBy("block")
    second = answered(by_block.cogroup(first.where(F.col("kind") == PAIRS).groupBy("block")).applyInArrow(ask_triples, _ASK), "lm-triples")
    schema = f"doc_id {kind}, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return by_block.cogroup(first.unionByName(second).groupBy("block")).applyInArrow(score, schema)


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scores = language_model_scores(docs, fold(F.col("doc_id"), 7) != 2)
    return scores.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
