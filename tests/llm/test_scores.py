"""Language model, rules, classifiers."""

import itertools
import math
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelspark.llm import labelled, language_model, quality_classifier, quality_rules, toxicity
from parcelspark.llm.text import fold

DATA = "/root/testdata/sf0.01"


def test_language_model_odd_tables(odd, none, rows, docs):
    assert language_model.language_model_scores(odd, fold(F.col("doc_id"), 7) != 2).count() == len(rows) + 3
    assert language_model.language_model_scores(none, F.lit(True)).count() == 0
    r = language_model.language_model_scores(docs, F.lit(None).cast("boolean")).where("doc_id = 33").first()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0)


def test_quality_rules(docs, rows, odd, none):
    want = brute.rules([(r[0], r[3], r[1]) for r in rows], 3)
    got = {r.doc_id: tuple(r)[1:] for r in quality_rules.quality_rules(docs, line_texts=3).collect()}
    assert got == want and any(w[-1] for w in want.values()) and any(w[5] for w in want.values())
    again = quality_rules.quality_rules(odd, line_texts=3).collect()
    assert len(again) == len(rows) + 3 and {tuple(r)[1:] for r in again if r.doc_id == 5} == {want[5]}
    assert quality_rules.quality_rules(none).count() == 0


def test_rules_stay_in_the_jvm(docs):
    plan = quality_rules.quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def _judged(spark, query, label, threshold):
    df = query(spark, DATA)
    assert [c for c, _ in df.dtypes][:4] == ["doc_id", "held_out", "score", "predicted"]
    got = df.collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    y = {r.doc_id: r[label] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    return [(r.predicted, y[r.doc_id]) for r in got if r.held_out and r.doc_id in y]


def test_quality_classifier_on_held_out_labels(spark):
    pairs = _judged(spark, quality_classifier.op9_quality_classifier, "quality", 0.7)
    assert np.mean([p == y for p, y in pairs]) > 0.95


def test_toxicity_on_held_out_labels(spark):
    pairs = _judged(spark, toxicity.op8_toxicity, "toxic", 0.3)
    assert np.mean([p == y for p, y in pairs]) > 0.9 and np.mean([y for p, y in pairs if p]) > 0.8


def test_classifiers_on_odd_tables(spark, odd, none, rows):
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(100)] + [(5, None, None), (None, 1, True), (999, 1, True)], "doc_id long, quality int, toxic boolean").withColumn("toxic", F.col("toxic").cast("int"))
    nothing = labels.limit(0)
    for train, score, column in ((quality_classifier.train, quality_classifier.score_quality, "quality_score"), (toxicity.train, toxicity.score_toxicity, "toxicity_score")):
        for known in (labels, nothing):
            out = score(odd.withColumn(column, F.lit("x")), train(odd, known))
            assert out.count() == len(rows) + 3 and out.where(f"{column} is null or {column} < 0 or {column} > 1").count() == 0
            assert set(out.columns) == {*odd.columns, column}
        assert score(none, train(none, nothing)).count() == 0
    one = labels.where("quality = 1")
    assert quality_classifier.score_quality(odd, quality_classifier.train(odd, one)).select("quality_score").distinct().count() == 1


def test_sample_is_bounded_and_leaves_the_fold_out(spark, docs):
    labels = spark.createDataFrame([(i, 1) for i in range(120)], "doc_id long, quality int")
    ids = [r.doc_id for r in labelled.training_sample(docs, labels, "quality", 30).collect()]
    assert len(ids) == 30 and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)


def test_trees_walk_like_their_nodes():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] > 0)).astype(float)
    trees = quality_classifier.fit(x, y, rounds=20, depth=3)
    inner, leaves = 7, 8
    for row, margin in zip(x[:50], trees.margins(x[:50])):
        total = trees.bias
        for t in range(len(trees.value) // leaves):
            node = 0
            while node < inner:
                node = 2 * node + 1 + (row[trees.feature[t * inner + node]] > trees.threshold[t * inner + node])
            total += trees.value[t * leaves + node - inner]
        assert margin == pytest.approx(total)
    assert ((trees.scores(x) > 0.5) == y).mean() > 0.95


def _posterior(tables, prior, correlations, pattern):
    """Of one pattern, vote by vote."""
    cast = [i for i, v in enumerate(pattern) if v]
    logit = math.log(prior / (1 - prior))
    for i in cast:
        shared = sum(max(correlations[i][j], 0) for j in cast)
        logit += (tables[1][i][pattern[i] + 1] - tables[0][i][pattern[i] + 1]) / max(shared, 1)
    return 1 / (1 + math.exp(-logit))


def test_a_step_of_the_label_model():
    rng = np.random.default_rng(3)
    patterns = np.unique(rng.integers(-1, 2, (60, 4)), axis=0).astype(np.int8)
    counts, q = rng.integers(1, 30, len(patterns)).astype(float), rng.random(len(patterns))
    halves = [toxicity.moments(patterns[a], counts[a], q[a]) for a in (slice(0, 20), slice(20, None))]
    model = toxicity.maximised(halves[0] + halves[1], 4, 0.2)
    left = np.zeros((4, 4))
    for c in (0, 1):
        w = [n * (x if c else 1 - x) for n, x in zip(counts, q)]
        for i in range(4):
            for v in (-1, 0, 1):
                assert model.tables[c, i, v + 1] == pytest.approx(math.log((sum(a for a, p in zip(w, patterns) if p[i] == v) + 0.5) / (sum(w) + 1.5)))
        mean = [sum(a * p[i] for a, p in zip(w, patterns)) / sum(w) for i in range(4)]
        for a, p in zip(w, patterns):
            for i in range(4):
                for j in range(4):
                    left[i, j] += a * (p[i] - mean[i]) * (p[j] - mean[j])
    want = [[left[i, j] / math.sqrt(left[i, i] * left[j, j]) for j in range(4)] for i in range(4)]
    assert model.correlations == pytest.approx(np.array(want))
    assert model.posterior(patterns).tolist() == pytest.approx([_posterior(model.tables, 0.2, want, p.tolist()) for p in patterns])


def test_label_model_weighs_copies_of_a_voter_once():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.2
    say = lambda right: np.where(rng.random(4000) < right, np.where(y, 1, -1), np.where(y, -1, 1))
    weak, a, b = say(0.7), say(0.9), say(0.9)
    cast = np.stack([weak, weak, weak, weak, a, b], 1).astype(np.int8)
    patterns, counts = np.unique(cast, axis=0, return_counts=True)
    start = np.where(patterns[:, 4] > 0, 0.9, 0.1)
    model = toxicity.label_model(lambda m: toxicity.moments(patterns, counts.astype(float), start if m is None else m.posterior(patterns)), 6, 0.2)
    assert model.correlations[0, 1] > 0.9 and abs(model.correlations[0, 4]) < 0.3
    assert ((model.posterior(cast) > 0.5) == y).mean() > 0.9


def _evidence(text, lexicons):
    words = brute.words(text)
    bare = [w.strip(toxicity._EDGES).lower() for w in words]
    out = []
    for form in toxicity._FORMS:
        entries, weights = lexicons.entries[form]
        forms = [b if form == "word" else b[: int(form[4:])] for b in bare]
        hits = [entries.index(f) for f in forms if f in entries]
        out += [len(hits), len(set(hits)), sum(weights[i] for i in set(hits))]
    out += [sum(b in v.split() for b in bare) for v in toxicity.LISTS.values()]
    insults = {w for v in toxicity.INSULTS.values() for w in v.split()}
    out += [len({b for b in bare if b in insults}), sum(any(c * 3 in b for c in "aehimnoruy") for b in bare)]
    return [*out, len(words), sum("!" in w for w in words), sum(w.isupper() and len(w.encode()) > 1 for w in words), sum(re.search(r"[A-Za-z][*@$#0]+[A-Za-z]", w) is not None for w in words)]


def test_evidence_equals_a_plain_count(rows):
    texts = [*(r[1] for r in rows), "You IDIOT! you f**l, idiot clowns; sooo 'pathetic' (Trottel) trottel. KILL", "¡idiota! É imbécile x0y a*b"]
    lexicons = toxicity.Lexicons({"word": (["kata", "idiot", "nuve"], np.array([1.5, 3.0, 2.0])), "stem4": (["kata", "idio"], np.array([0.5, 1.0])), "stem5": ([], np.zeros(0)), "stem6": (["trotte"], np.array([2.5]))})
    got = toxicity.Lexicons(lexicons.entries).evidence(pa.array(texts))
    assert got == pytest.approx(np.array([_evidence(t, lexicons) for t in texts]))
    assert len(toxicity.EVIDENCE) == got.shape[1] and toxicity.votes(got).shape[1] == toxicity.VOTERS and got[-2, toxicity._AT["list_kinds"]] == 4


def test_unlabelled_documents_reach_the_classifier(spark, docs):
    ids = {r.doc_id for r in labelled.document_sample(docs, 10).collect()}
    assert len(ids) == 10 and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)
    assert labelled.document_sample(docs, 1000).count() == docs.where("text is not null").where(fold(F.col("doc_id"), 4) != 2).count()
    many = spark.range(5000).select(F.col("id").alias("doc_id"))
    assert labelled.lowest(many, 100, "doc_id").count() == 100 and labelled.lowest(many.limit(0), 100, "doc_id").count() == 0


def _statistics(text):
    raw = (text or "").encode()
    size = max(len(raw), 1)
    out = {"log_bytes": math.log1p(len(raw))}
    for k, members in labelled._CLASSES.items():
        out[f"{k}_share"] = sum(b in members for b in raw) / size
    out["byte_entropy"] = -sum(n / size * math.log2(n / size) for n in Counter(raw).values())
    w = [x.encode() for x in brute.words(text)]
    n = max(len(w), 1)
    length = [min(len(x), 1000) for x in w]
    mean = sum(length) / n
    pairs = Counter(itertools.pairwise(w))
    lines = (text or "").split("\n")
    full = [x for x in lines if brute.words(x)]
    out |= {
        "log_words": math.log1p(len(w)), "word_bytes": mean, "word_bytes_sd": math.sqrt(max(sum(x * x for x in length) / n - mean**2, 0)), "longest_word": math.log1p(max(map(len, w), default=0)),
        "distinct_share": len(set(w)) / n, "top_share": max(Counter(w).values(), default=0) / n, "repeated_pair_share": sum(c - 1 for c in pairs.values()) / n,
        "upper_word_share": sum(x.isupper() and len(x) > 1 for x in w) / n, "symbol_word_share": sum(any(b in labelled._SYMBOLS for b in x) for x in w) / n,
        "digit_word_share": sum(any(48 <= b < 58 for b in x) for x in w) / n, "short_word_share": sum(len(x) <= 2 for x in w) / n,
        "log_lines": math.log1p(len(lines)), "repeated_line_share": (len(full) - len(set(full))) / max(len(full), 1), "words_a_line": math.log1p(len(w) / len(lines)),
    }
    return [out[k] for k in labelled.STATISTICS]


def test_statistics_equal_a_plain_count(rows):
    texts = [*(r[1] for r in rows if r[1] is None or len(r[1]) < 5000), "A B\nA B\n\nx #1 {y} UP", "12 34 12 34 ab!"]
    got = labelled.statistics(pa.array(texts))
    assert got == pytest.approx(np.array([_statistics(t) for t in texts]), rel=1e-4, abs=1e-5)


def test_a_round_of_boosting():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 12, (300, 3)).astype(np.float32)
    y = ((x[:, 1] > 6) | (rng.random(300) < 0.1)).astype(float)
    trees = quality_classifier.fit(x, y, rounds=1, depth=1, rate=0.5)
    bias = math.log((y.sum() + 0.5) / (300 - y.sum() + 0.5))
    p = 1 / (1 + math.exp(-bias))
    best = (0.0, None, None)
    for j in range(3):
        for t in sorted(set(x[:, j].tolist())):
            side = x[:, j] <= t
            g, h = (p - y[side]).sum(), side.sum() * p * (1 - p)
            all_g, all_h = (p - y).sum(), 300 * p * (1 - p)
            if min(h, all_h - h) >= 4:
                gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
                best = max(best, (gain, j, t), key=lambda b: b[0])
    side = x[:, best[1]] <= best[2]
    leaf = [-0.5 * (p - y[s]).sum() / (s.sum() * p * (1 - p) + 1) for s in (side, ~side)]
    assert (trees.feature[0], trees.threshold[0]) == best[1:] and trees.value.tolist() == pytest.approx(leaf) and trees.bias == pytest.approx(bias)
