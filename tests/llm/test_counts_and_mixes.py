"""Token counts, packing, mixing and the pipeline."""

import itertools
import math
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelspark.llm import mixing, packing, token_counts


def test_length_histogram(docs, rows, none, monkeypatch):
    encode = token_counts.encoding(token_counts.TOKENIZER).encode_ordinary
    lengths = [len(encode(r[1])) if r[1] else 0 for r in rows]
    monkeypatch.setattr(token_counts, "SPAN", 64)
    hist = token_counts.histogram(token_counts.encoded_lengths(docs))
    got = {r.n_tokens: tuple(r)[1:] for r in token_counts.suffix_sums(hist).collect()}
    want = {n: (lengths.count(n), sum(x >= n for x in lengths), sum(x for x in lengths if x >= n), sum(x <= n for x in lengths), sum(min(x, n) for x in lengths)) for n in set(lengths)}
    assert got == want
    assert {r.context_limit: r.tokens for r in token_counts.cut_totals(hist, [1, 77, 10**6]).collect()} == {n: sum(min(x, n) for x in lengths) for n in (1, 77, 10**6)}
    quantile = {r.share: r.n_tokens for r in token_counts.quantiles(token_counts.suffix_sums(hist), [0.5, 0.99, 1.0]).collect()}
    assert quantile == {q: sorted(lengths)[math.ceil(q * len(lengths)) - 1] for q in (0.5, 0.99, 1.0)}
    empty = token_counts.histogram(token_counts.encoded_lengths(none))
    assert token_counts.suffix_sums(empty).count() == 0 and token_counts.cut_totals(empty, [5]).first().tokens == 0


def test_bounds_are_optimal():
    rng = np.random.default_rng(0)
    for _ in range(40):
        n, k = rng.integers(1, 9), int(rng.integers(1, 5))
        lengths, counts = np.sort(rng.choice(60, n, replace=False) + 1), rng.integers(1, 50, n)
        cost = lambda bounds: sum(int(c) * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths.tolist(), counts.tolist()))
        best = min(cost((*b, int(lengths[-1]))) for r in range(k) for b in itertools.combinations(lengths[:-1].tolist(), r))
        found = packing.optimal_bounds(lengths, counts, k)
        assert len(found) <= k and cost(found) == best


def test_bounds_of_many_long_lengths():
    rng = np.random.default_rng(1)
    lengths, counts = np.unique(np.concatenate([rng.integers(1, 300, 150), rng.integers(30_000, 10**7, 50)])), None
    counts = rng.integers(1, 1000, len(lengths))
    n = len(lengths)
    c = [0, *np.cumsum(counts).tolist()]
    plain = [[math.inf] * (n + 1) for _ in range(5)]
    plain[0][0] = 0
    for k in range(1, 5):
        for j in range(1, n + 1):
            plain[k][j] = min(plain[k - 1][i] + int(lengths[j - 1]) * (c[j] - c[i]) for i in range(j))
    for scale in (1, 2**36):  # the second is beyond 64 bits
        found = packing.optimal_bounds(lengths * scale, counts, 4)
        total = sum(int(k) * min(b for b in found if b >= x) for x, k in zip((lengths * scale).tolist(), counts.tolist()))
        assert total == min(p[n] for p in plain) * scale and set(found) <= set((lengths * scale).tolist())


def test_documents_longer_than_a_batch_and_rows_without_ids(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 4)
    rows = [(None, "w " * 9)] * 60 + [(i, "w " * n) for i, n in enumerate((40_000, 70_001, 5, 0))]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), n_buckets=4, batch_tokens=100).collect()
    assert Counter(r.n_tokens for r in out) == Counter({10: 60, 40_001: 1, 70_002: 1, 6: 1, 1: 1})
    assert {r.padded_to for r in out} == {1, 10, 40_001, 70_002} and all(r.slot == 0 for r in out if r.n_tokens > 100)
    places = [(r.batch, r.slot) for r in out if r.doc_id is None]
    assert len(set(places)) == 60 and max(places) <= (6, 0)


def test_packing(docs, rows, odd, none, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 5)
    out = packing.pack(docs, n_buckets=4, batch_tokens=500).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    length = {r[0]: len(brute.words(r[1])) + 1 for r in rows}
    batches = defaultdict(list)
    for r in out:
        assert r.n_tokens == length[r.doc_id] <= r.padded_to
        batches[r.bucket, r.batch].append(r)
    for (bucket, batch), members in batches.items():
        assert len(members) <= max(1, 500 // members[0].padded_to) and sorted(m.slot for m in members) == list(range(len(members)))
    for bucket in {b for b, _ in batches}:
        sizes = {k: len(v) for (b, k), v in batches.items() if b == bucket}
        fits = max(1, 500 // next(m.padded_to for (b, _), v in batches.items() if b == bucket for m in v))
        assert sorted(sizes) == list(range(len(sizes))) and sum(n < fits for n in sizes.values()) <= 1
    assert packing.pack(odd).count() == len(rows) + 3 and packing.pack(none).count() == 0


def test_mixing_reaches_its_weights(spark):
    rows = [(i, " ".join(["w"] * 50), "big" if i < 1600 else "mid" if i < 1900 else "small", 1) for i in range(2000)] + [(5000, "", "empty", 1), (5001, None, None, 1), (5002, "one two", None, 1), (None, "one two three", "mid", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, row int")
    out = mixing.mix(df, repetition_limit=4.0, block_tokens=200).cache()
    t = {"big": 80_000, "mid": 15_003, "small": 5_000, None: 2}
    times = {r.source: r.n for r in out.groupBy("source").agg(F.sum("mix.n_tokens").alias("n")).collect()}
    weight = {r.source: r.w for r in out.groupBy("source").agg(F.first("mix.weight").alias("w")).collect()}
    assert times["big"] == t["big"] and sum(weight.values()) == pytest.approx(1)
    epochs = {r.source: r.e for r in out.groupBy("source").agg(F.first("mix.epochs").alias("e")).collect()}
    assert max(epochs.values()) == pytest.approx(4.0) and min(e for s, e in epochs.items()) == pytest.approx(1.0)
    for s in ("big", "mid", "small"):
        assert abs(times[s] - epochs[s] * t[s]) <= 400
        assert weight[s] / weight["big"] == pytest.approx((t[s] / t["big"]) ** (math.log(weight["mid"] / weight["big"]) / math.log(t["mid"] / t["big"])), rel=1e-6)
    assert out.select("doc_id", "text").distinct().count() == len(rows) and "row" in out.columns
    out = mixing.mix(df.where("source is not null"), repetition_limit=4.0, block_tokens=200).cache()  # small is read four times
    orders = [[r.mix.block for r in out.where(f"source = 'small' and mix.epoch = {e}").orderBy("mix.block_key", "mix.doc_key").collect()] for e in (0, 1)]
    assert sorted(set(orders[0])) == sorted(set(orders[1])) and orders[0] != orders[1]


def test_mixing_of_small_sources_at_the_default_block(spark):
    rows = [(i, " ".join(["w"] * (20 + i % 90)), "abcc"[i % 4] if i % 20 else "d") for i in range(4000)] + [(None, "w " * 40, "d")] * 3
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), repetition_limit=1.7).collect()
    natural, read, target = Counter(), Counter(), {r.source: (r.mix.epochs, r.mix.weight) for r in out}
    for _, text, source in rows:
        natural[source] += len(text.split())
    for r in out:
        read[r.source] += r.mix.n_tokens
    for source, (epochs, weight) in target.items():
        assert abs(read[source] - epochs * natural[source]) <= 60  # half of the longest document, or of the three rows in one
        assert read[source] / sum(read.values()) == pytest.approx(weight, abs=1e-3)
    assert max(e for e, _ in target.values()) == pytest.approx(1.7) and sum(e > 1.1 for e, _ in target.values()) == 3


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_realises_its_weights(spark, sf):
    n = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").count()
    out = mixing.op1_mixing(spark, f"/root/testdata/{sf}").groupBy("source").agg(F.sum("n_tokens").alias("read"), F.first("weight").alias("weight"), F.first("epochs").alias("epochs"), F.count("*").alias("rows")).collect()
    total = sum(r.read for r in out)
    assert all(abs(r.read / total - r.weight) <= (0.003 if sf == "sf0.01" else 0.0005) for r in out), [(r.read / total, r.weight) for r in out]
    assert sum(r.rows for r in out) > 1.05 * n


def test_mixing_never_exceeds_a_budget(spark):
    rows = [(i, " ".join(["w"] * (20 + i % 90)), "abcc"[i % 4]) for i in range(2000)]
    total = sum(len(t.split()) for _, t, _ in rows)
    n = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), budget_tokens=total // 3).agg(F.sum("mix.n_tokens")).first()[0]
    assert total // 3 - 3 * 109 <= n <= total // 3


def test_exponent_meets_an_entropy(spark):
    p = np.array([0.7, 0.2, 0.06, 0.04])
    shares = spark.createDataFrame([(float(x),) for x in p], "p double")
    for target in (0.9, 1.1, 1.3):
        t = mixing.exponent(shares, None, target)
        w = p**t / (p**t).sum()
        assert -(w * np.log(w)).sum() == pytest.approx(target, abs=1e-6)
    with pytest.raises(ValueError, match="entropy"):
        mixing.exponent(shares, None, 1.5)
    with pytest.raises(ValueError, match="more than 2.0 times"):
        mixing.exponent(shares, 2.0, None, budget_share=5.0)
    assert mixing.exponent(shares, None, None) == 1.0 and mixing.exponent(shares, 1.0, None) == pytest.approx(1.0)


def test_mixing_odd_tables_and_budgets(odd, none, rows):
    assert mixing.mix(odd).select("doc_id", "text").distinct().count() == odd.select("doc_id", "text").distinct().count()
    assert mixing.mix(none).count() == 0
    total = sum(len(brute.words(r[1])) for r in rows) * 1.0
    small = mixing.mix(odd, repetition_limit=None, budget_tokens=int(total / 3), block_tokens=500).agg(F.sum("mix.n_tokens")).first()[0]
    assert 0 < small <= total / 3 + 1


def test_mixing_stays_in_the_jvm(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_near_duplicate_stage_with_an_id_of_several_texts(spark):
    import corpus_pipeline as c

    a, b, x, y = (" ".join(f"{p}{i}" for i in range(300)) for p in "abxy")
    near = a.upper()  # fingerprints ignore case
    rows = [(1, a), (2, near), (2, b), (3, b), (4, x), (4, y), (5, x.upper()), (6, a), (7, "k " * 9), (7, "K " * 9), (7, "k " * 9), (None, b), (None, b)]
    got = Counter(tuple(r) for r in c.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect())
    seven = [k for k in got if k[0] == 7]
    assert len(seven) == 1 and got == Counter([(1, a), (2, b), (4, x), (4, y), (None, b), *seven])


def test_pipeline_by_stages(spark, tmp_path, rows):
    import corpus_pipeline as c

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clean = [(r[0], r[1], r[2], r[3], r[4]) for r in rows]
    junk = [(1000 + i, " ".join(["THE!!"] * (30 + i)), "en", "s0", 5) for i in range(20)]
    spark.createDataFrame([*clean, *junk, clean[5], (None, clean[7][1], "en", "s1", 3)], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] < 1000), 0) for r in [*clean, *junk]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept, seen = docs, []
    for i, (name, stage) in enumerate(c.STAGES):
        before, kept = kept, c.materialise(stage(spark, kept, str(tmp_path)), "test")
        seen.append(kept.collect())
        if i < 4:
            assert kept.columns == docs.columns
    quality, near, cut, mixed, packed = seen
    ids = {r.doc_id for r in quality}
    assert not ids & set(range(1000, 1020)) and len(ids & {r[0] for r in clean}) > 100
    prints = {r.doc_id: brute.fingerprint(r.text) for r in quality if r.doc_id is not None}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert sorted(r.doc_id for r in near if r.doc_id is not None) == sorted({*brute.components(prints, links).values()})
    want = brute.substrings([(i, r.text) for i, r in enumerate(near)])
    left = {i for i, w in want.items() if w[0] == 0 or w[1] < w[0]}
    assert Counter((r.doc_id, len(brute.words(r.text))) for r in cut) == Counter((near[i].doc_id, want[i][0] - want[i][1]) for i in left)
    assert {r.doc_id for r in mixed} == {r.doc_id for r in cut} and Counter(r.doc_id for r in packed) == Counter(r.doc_id for r in mixed)
    assert c.run(spark, str(tmp_path)).count() == len(packed)


def test_pipeline_of_an_empty_table(spark, tmp_path, none):
    import corpus_pipeline as c

    none.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert c.run(spark, str(tmp_path)).count() == 0
