"""Near and substring dedup against brute force."""

import math

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelspark.llm import embeddings, simhash, substrings
from parcelspark.llm.text import Words, slices


def test_words_of_slices_and_odd_spaces():
    texts = ["a b\xa0c", None, "", " x\x0by\x1cz ", "p q", "Ünï ÄB"]
    array = pa.array(texts)
    for lower in (False, True):
        for part, want in ((array, texts), (array.slice(3, 3), texts[3:])):
            w = Words(part, lower)
            got = [[w.vocab[int(c)].as_py() for c in w.codes[a:b]] for a, b in zip(w.starts[:-1], w.starts[1:])]
            assert got == [brute.words((t or "").translate(brute.LOW) if lower else t) for t in want]
    assert [x.to_pylist() for x in slices(pa.array(["aa", "b" * 9, None, "c", "dd"]), 5)] == [["aa"], ["b" * 9, None, "c", "dd"]] or sum(len(x) for x in slices(array, 5)) == 6


def test_fingerprints(rows):
    texts = [r[1] for r in rows]
    want = [brute.fingerprint(t) for t in texts]
    assert simhash.simhash(pa.array(texts)).tolist() == want
    assert np.concatenate([simhash.simhash(x) for x in slices(pa.array(texts), 300)]).tolist() == want


def test_bk_forest_finds_all_links():
    rng = np.random.default_rng(0)
    p = np.repeat(rng.integers(0, 1 << 63, 30, dtype=np.uint64), 40)
    for _ in range(4):
        p = p ^ np.where(rng.random(len(p)) < 0.6, np.uint64(1) << rng.integers(0, 64, len(p)).astype(np.uint64), np.uint64(0))
    p, g = np.unique(p), None
    g = np.sort(rng.integers(0, 4, len(p)))
    got = {(a, b) for x, y in simhash.BKForest(p, g).links(3) for a, b in zip(x.tolist(), y.tolist())}
    near = np.bitwise_count(p[:, None] ^ p[None]) <= 3
    assert got == {(i, j) for i in range(len(p)) for j in range(i) if near[i, j] and g[i] == g[j]}


def _near(rows):
    prints = {r[0]: brute.fingerprint(r[1]) for r in rows}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    return {k: (format(prints[k], "016x"), c) for k, c in brute.components(ids, links).items()}


def test_near_duplicates(docs, rows, odd, none):
    want = _near(rows)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()} == want
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(rows) + 3 and {(r.fingerprint, r.component_id) for r in got if r.doc_id is None} == {want[7], want[12]}
    assert simhash.near_duplicates(none).count() == 0


def test_split_shards_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    p = np.repeat(centre, 60)
    for _ in range(5):
        p = p ^ (np.uint64(1) << rng.integers(0, 64, len(p)).astype(np.uint64))
    p = np.unique(p)
    df = spark.createDataFrame([(int(x), int(x)) for x in p.view(np.int64)], "fp long, rep long")
    want = brute.components(range(len(p)), [(i, j) for i in range(len(p)) for j in range(i) if int(np.bitwise_count(p[i] ^ p[j])) <= 3])
    at = {int(x): i for i, x in enumerate(p.view(np.int64))}
    for shard, tile in ((10_000, 10_000), (4, 10_000), (4, 3)):
        monkeypatch.setattr(simhash, "SHARD", shard)
        monkeypatch.setattr(simhash, "TILE", tile)
        edges = simhash.shard_keys(df).repartition("key").sortWithinPartitions("key").mapInArrow(simhash._shard_links(3), "src long, dst long").collect()
        assert brute.components(range(len(p)), [(at[r.src], at[r.dst]) for r in edges]) == want


@pytest.mark.parametrize("block_bytes", [1 << 22, 9000])
def test_substrings(docs, rows, block_bytes):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.substring_duplicates(docs, block_bytes=block_bytes).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect()}
    want = brute.substrings([(r[0], r[1]) for r in rows])
    assert got == want and sum(w[1] > 0 for w in want.values()) > 10


def test_substrings_of_odd_tables(odd, rows, none):
    got = substrings.substring_duplicates(odd, block_bytes=20_000).collect()
    want = brute.substrings([*((r[0], r[1]) for r in rows), ("again", rows[5][1]), ("null", rows[7][1])])
    assert len(got) == len(rows) + 3
    assert all((r.n_words, r.n_removed) == want[5][:2] for r in got if r.row.doc_id == 5)
    for r in got:
        if r.n_removed == 0:
            assert r.text == next(x[1] for x in rows if x[0] == (r.row.doc_id if r.row.doc_id is not None else -1)) if r.row.doc_id is not None else True
        else:
            assert len(brute.words(r.text)) == r.n_words - r.n_removed
        assert r.row.n_words == 1 and r.row.key == "k"
    assert substrings.substring_duplicates(none).count() == 0


def test_short_windows(spark):
    texts = ["a b c d e f", "x b c d y", "b c", "e f e f e f", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.substring_duplicates(df, window=3, gram=2).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect()}
    assert got == brute.substrings(list(enumerate(texts)), 3)


def _vectors():
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 12))
    rows = [(i, (base[i % 40] + (i // 40) * 0.12 * rng.standard_normal(12)).astype(np.float32).tolist(), i % 2 if i % 40 < 20 else 2) for i in range(160)]
    rows += [(200 + i, rows[3][1], rows[3][2]) for i in range(25)] + [(230, rows[3][1], 1 - rows[3][2]), (231, (2 * np.float32(rows[3][1])).tolist(), rows[3][2])]
    rows += [(240, None, 1), (241, [0.0] * 12, 1), (242, [float("nan")] * 12, 1), (243, [float("inf")] + [1.0] * 11, 1), (244, [None] + [1.0] * 11, 1), (245, rows[3][1], None), (246, [], 1), (247, [1.0, 2.0], 1), (248, [1.0, 2.1], 1), (None, rows[3][1], rows[3][2])]
    return rows


@pytest.mark.parametrize("cell", [4096, 8])
def test_vectors(spark, cell):
    rows = _vectors()
    df = spark.createDataFrame([(i, v, l, "x") for i, v, l in rows] + [(*rows[0], "x")], "vec_id long, embedding array<float>, label int, block string")
    ok = {i: (np.array(v, np.float64), l) for i, v, l in rows if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a in ok for b in ok if a < b and ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0]) and ok[a][0] @ ok[b][0] / math.sqrt(ok[a][0] @ ok[a][0]) / math.sqrt(ok[b][0] @ ok[b][0]) >= 0.93]
    comp = brute.components([r[0] for r in rows if r[0] is not None], links)
    degree = {i: sum(i in x for x in links) for i in comp}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicate_vectors(df, cell=cell).collect()}
    assert got == {i: (degree[i], comp[i], comp[i] == i) for i in comp} | {None: (0, None, False)}
    assert max(degree.values()) >= 25 and embeddings.near_duplicate_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("cell", [16_384, 64])
def test_vectors_around_the_threshold_in_64_dimensions(spark, cell):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    side = rng.standard_normal((300, 64))
    side -= (side * base).sum(1)[:, None] * base
    side /= np.linalg.norm(side, axis=1)[:, None]
    cosine = rng.uniform(0.925, 0.935, 300)
    near = cosine[:, None] * base + np.sqrt(1 - cosine**2)[:, None] * side
    rows = [(i, v.tolist(), "a" if i % 300 % 3 else "b") for i, v in enumerate(np.concatenate([base, near]) * rng.uniform(0.1, 9, 600)[:, None])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"), cell=cell).collect()}
    linked = {i for i in range(300) if cosine[i] >= 0.93}
    assert 100 < len(linked) < 200 and got == {i: (1, i % 300) if i % 300 in linked else (0, i) for i in range(600)}


def test_vectors_of_any_size_and_labels_of_any_type(spark):
    v = [1.0, 2.0, 3.0]
    for kind, a, b in (("string", "x", "y"), ("bigint", 2**40, 2**40 + 1), ("date", __import__("datetime").date(2020, 1, 1), __import__("datetime").date(2020, 1, 2)), ("boolean", True, False)):
        rows = [(1, v, a), (2, [x * 1e200 for x in v], a), (3, [x * 1e-200 for x in v], a), (4, v, b), (5, [5e-324, 0.0, 0.0], a), (6, [1.0, 0.0, 0.0], a)]
        got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicate_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).collect()}
        assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (1, 5), 6: (1, 5)}, kind
