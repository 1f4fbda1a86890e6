"""The parse of texts into factors, the automaton, and what they ask each other in chunks."""

from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelspark.llm import chunks, language_model, substrings
from parcelspark.llm.text import fold


def test_sorted_keys_round_trip_and_parts_cover_them():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 64, 5000, dtype=np.uint64))
    assert (chunks.unpack_sorted(chunks.pack_sorted(keys), len(keys)) == keys).all()
    for parts in (1, 2, 64, 1 << 14):
        cells = chunks.ranges(keys, parts)
        assert [c[1] for c in cells] == [0, *(c[2] for c in cells[:-1])] and cells[-1][2] == len(keys)
        assert all((int(k) * parts) >> 64 == p for p, a, b in cells[:50] for k in keys[a:b])
    assert chunks.ranges(keys[:0], 64) == []


def test_sizes_grow_with_the_corpus():
    assert chunks.plan_sizes(0) == (4 << 20, 64) and chunks.plan_sizes(5e8)[0] == 4 << 20
    last = 0
    for size in (1e9, 3e10, 1e12, 1e14):
        block, parts = chunks.plan_sizes(size)
        assert last <= block <= 256 << 20 and parts & (parts - 1) == 0
        # what a block sends to a part
        assert block / 6 / parts > 150
        last = block


def test_counts_above_32_bits():
    key, many = np.array([7, 9], np.uint64), np.array([2**32 - 1, 3], np.uint64)
    asked = pa.Table.from_batches([language_model._asks(b, language_model.WORDS, key, many, 1) for b in range(4)])
    out = language_model.answer_counts(asked)
    assert language_model._answered(out.slice(2, 1), 0)[0].tolist() == [4 * (2**32 - 1), 12] and sum(out["tokens"].to_pylist()) == 4 * (2**32 - 1) + 12 and sum(out["types"].to_pylist()) == 2


def _factors(placed, window):
    """Factors of [(block, place, words)] by comparing all windows: each goes on while the least place elsewhere does."""
    at = defaultdict(list)
    for block, place, w in placed:
        for i in range(len(w) - window + 1):
            at[tuple(w[i : i + window])].append((block, place + i))
    out = {}
    for block, place, w in placed:
        found, last = [], None
        for i in range(len(w) - window + 1):
            ref = min((x for x in at[tuple(w[i : i + window])] if x != (block, place + i)), default=None)
            if ref and last == (ref[0], ref[1] - 1):
                found[-1][1] += 1
            elif ref:
                found.append([i, window, *ref])
            last = ref
        out[block, place, len(w)] = [tuple(x) for x in found]
    return out


@pytest.mark.parametrize("block_bytes", [1 << 22, 9000])
def test_factors_equal_a_plain_parse(docs, rows, block_bytes):
    got = substrings.substring_duplicates(docs, block_bytes=block_bytes, texts=False).select("row.doc_id", "block", "place", "factors", "n_removed", "n_words").collect()
    split = {r[0]: brute.words(r[1]) for r in rows}
    want = _factors([(r.block, r.place, split[r.doc_id]) for r in got], substrings.WINDOW)
    assert sum(len(v) for v in want.values()) > 20 and len({r.block for r in got}) > (1 if block_bytes < 1 << 20 else 0)
    words = {(r.block, r.place + i): w for r in got for i, w in enumerate(split[r.doc_id])}
    for r in got:
        found = [tuple(f) for f in r.factors]
        if r.n_words:
            assert found == want[r.block, r.place, r.n_words]
        covered = set()
        for start, length, block, place in found:
            assert length >= substrings.WINDOW and split[r.doc_id][start : start + length] == [words[block, place + i] for i in range(length)]
            covered.update(range(start, start + length))
        assert len(covered) == r.n_removed


def test_short_factors(spark):
    texts = ["a b c d e f", "x b c d y", "b c", "e f e f e f", None, "a b c d e f"]
    got = substrings.substring_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), window=3, gram=2).collect()
    want = _factors([(r.block, r.place, brute.words(texts[r.row.doc_id])) for r in got], 3)
    assert all([tuple(f) for f in r.factors] == want[r.block, r.place, r.n_words] for r in got if r.n_words)


@pytest.mark.parametrize("block_bytes", [1 << 22, 9000, 700])
def test_language_model(docs, rows, block_bytes):
    priors = (30.0, 4.0)
    got = {r.doc_id: (not r.training, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in language_model.language_model_scores(docs, fold(F.col("doc_id"), 7) != 2, priors=priors, block_bytes=block_bytes).collect()}
    want = brute.language_model([(r[0], r[1]) for r in rows], priors)
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k][:4] == w[:4] and got[k][4] == pytest.approx(w[4], rel=1e-9) and got[k][5] == pytest.approx(w[5], rel=1e-9)


def test_words_that_follow_a_state_sum_to_one():
    texts = ["a b a c", "b b", "c", "a b a b"]
    vocab, priors, n = ["a", "b", "c", None], (5.0, 2.0), len(texts)

    def steps(history):
        out = []
        for w in [*vocab, "new"]:
            s = language_model.Sequence.of(pa.chunked_array([[*texts, " ".join([*history, *([w] if w else [])])]]))
            words, pairs = s.counts(np.array([1] * n + [0]))
            _, own, at, triple = s.triples()
            counts = np.zeros(len(s.word), np.int64)
            counts[at] = own[triple]
            model = language_model.Automaton(s, words, pairs, counts, int(words.sum()), int((words > 0).sum()), priors)
            out.append(10 ** model.traverse()[s.starts[n] + len(history)])
        return out

    for history in ([], ["a"], ["b"], ["a", "b"], ["b", "a"], ["c", "c"], ["zz", "a"], ["zz"]):
        # what is left over is the share of all unseen words together
        assert sum(steps(history)) == pytest.approx(1.0), history


def test_triples_of_other_blocks_are_found(spark):
    texts = [(i, f"x{i} p q r y{i}") for i in range(40)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.score for r in language_model.language_model_scores(df, F.col("doc_id") < 30, block_bytes=1).collect()}
    whole = {r.doc_id: r.score for r in language_model.language_model_scores(df, F.col("doc_id") < 30).collect()}
    assert got == pytest.approx(whole, rel=1e-12) and got.keys() == dict(texts).keys()
