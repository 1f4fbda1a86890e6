"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posteriors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm.labelled import FOLDS, HELD_OUT, SAMPLE, document_sample, training_sample
from parcelspark.llm.text import Words, fold, slices
from parcelspark.session import materialise

THRESHOLD = 0.3
#: Entries of each lexicon at most, and the documents that must hold an entry.
ENTRIES, SUPPORT = 512, 3
#: Characters of the stem lexicons.
STEMS = (4, 5, 6)
#: Rounds of expectation maximisation at most.
ROUNDS = 10
_EDGES = "".join(chr(i) for i in range(33, 127) if not chr(i).isalpha())
_FORMS = ["word", *(f"stem{n}" for n in STEMS)]
#: Words that no label is needed for, by language; words of threat and of address, in all of them.
INSULTS = {
    "en": "idiot idiots moron morons stupid dumb loser losers fool fools scum trash garbage pathetic clown clowns worthless disgusting imbecile coward liar freak",
    "de": "idiot idioten dumm dummkopf trottel versager abschaum müll erbärmlich widerlich wertlos feigling lügner depp spinner blödmann",
    "fr": "idiot idiots idiote imbécile imbéciles crétin crétins stupide minable ordure ordures déchet pathétique lâche menteur abruti débile",
    "es": "idiota idiotas imbécil imbéciles estúpido estúpida tonto tontos basura patético patética cobarde mentiroso inútil escoria payaso",
}
THREATS = "kill kills murder destroy hurt beat töten schlagen vernichten tuer frapper détruire matar golpear destruir"
ADDRESS = "you your you're du dich dein ihr tu toi vous tes eres usted ustedes tus"
LISTS = {**INSULTS, "threat": THREATS, "address": ADDRESS}
EVIDENCE = [*(f"{f}_{k}" for f in _FORMS for k in ("hits", "kinds", "weight")), *(f"list_{k}" for k in LISTS), "list_kinds", "stretched", "words", "shouts", "uppers", "masked"]
_AT = {k: i for i, k in enumerate(EVIDENCE)}


def _forms(vocab: pa.Array) -> tuple[pa.Array, dict[str, pa.Array]]:
    """Each distinct word without what is no letter at its ends, in lower case, and its stems."""
    bare = pc.utf8_lower(pc.ascii_trim(vocab, _EDGES))
    return bare, {"word": bare, **{f"stem{n}": pc.utf8_slice_codeunits(bare, 0, n) for n in STEMS}}


@dataclass
class Lexicons:
    """For each form: entries and the log-odds that training labels gave them."""

    entries: dict[str, tuple[list[str], np.ndarray]]

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """A row of EVIDENCE for each text; an empty or null text's is zero."""
        words = Words(texts)
        n, count = len(words.starts) - 1, np.diff(words.starts)
        out = np.zeros((n, len(EVIDENCE)))
        if not len(words):
            return out
        doc = np.repeat(np.arange(n), count)
        bare, forms = _forms(words.vocab)
        for i, form in enumerate(_FORMS):
            entries, weights = self.entries[form]
            if not entries:
                continue
            found = pc.fill_null(pc.index_in(forms[form], pa.array(entries, pa.large_string())), -1).to_numpy(zero_copy_only=False)[words.codes]
            hit = np.flatnonzero(found >= 0)
            out[:, 3 * i] = np.bincount(doc[hit], minlength=n)
            pairs = np.unique(doc[hit] * len(entries) + found[hit])
            out[:, 3 * i + 1] = np.bincount(pairs // len(entries), minlength=n)
            out[:, 3 * i + 2] = np.bincount(pairs // len(entries), weights=weights[pairs % len(entries)], minlength=n)
        kinds = {}
        for name, entries in LISTS.items():
            found = pc.fill_null(pc.index_in(bare, pa.array(entries.split(), pa.large_string())), -1).to_numpy(zero_copy_only=False)
            out[:, _AT[f"list_{name}"]] = np.bincount(doc[found[words.codes] >= 0], minlength=n)
            if name in INSULTS:
                kinds |= dict.fromkeys(np.flatnonzero(found >= 0).tolist())
        _, known = np.unique(pc.dictionary_encode(bare).indices.to_numpy(zero_copy_only=False), return_inverse=True)
        insult = np.zeros(len(bare), bool)
        insult[list(kinds)] = True
        hit = np.flatnonzero(insult[words.codes])
        out[:, _AT["list_kinds"]] = np.bincount(np.unique(doc[hit] * len(bare) + known[words.codes[hit]]) // len(bare), minlength=n)
        stretched = pc.match_substring_regex(bare, "|".join(f"{c}{{3}}" for c in "aehimnoruy")).to_numpy(zero_copy_only=False)
        out[:, _AT["stretched"]] = np.bincount(doc, weights=stretched[words.codes], minlength=n)
        flags = (pc.match_substring(words.vocab, "!"), pc.and_(pc.utf8_is_upper(words.vocab), pc.greater(pc.binary_length(words.vocab), 1)), pc.match_substring_regex(words.vocab, r"[A-Za-z][*@$#0]+[A-Za-z]"))
        out[:, -4] = count
        for k, flag in enumerate(flags):
            out[:, k - 3] = np.bincount(doc, weights=flag.to_numpy(zero_copy_only=False)[words.codes], minlength=n)
        return out


def learn_lexicons(sample: DataFrame) -> Lexicons:
    """Entries that labelled texts marked 1 hold far oftener than others, from whole texts of the
    (bounded) sample; what reaches the driver is at most ENTRIES rows for each form."""

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, at = batch.column(1).to_numpy(), 0
            for texts in slices(batch.column(0)):
                marked, at = y[at : at + len(texts)], at + len(texts)
                words = Words(texts)
                if not len(words):
                    continue
                doc = np.repeat(np.arange(len(marked)), np.diff(words.starts))
                for name, values in _forms(words.vocab)[1].items():
                    coded = values.dictionary_encode()
                    size = len(coded.dictionary)
                    pairs = np.unique(doc * size + coded.indices.to_numpy(zero_copy_only=False)[words.codes])
                    entry, toxic = pairs % size, marked[pairs // size] > 0
                    a, b = (np.bincount(entry[m], minlength=size) for m in (toxic, ~toxic))
                    yield pa.RecordBatch.from_arrays([pa.array([name] * size), coded.dictionary.cast(pa.string()), pa.array(a), pa.array(b)], ["form", "entry", "a", "b"])

    totals = sample.agg(F.count_if(F.col("y") > 0).alias("a"), F.count_if(F.col("y") <= 0).alias("b")).first()
    n_a, n_b = totals["a"], totals["b"]
    least = max(SUPPORT, (n_a + n_b) // 2000)
    sums = sample.select("text", "y").mapInArrow(presence, "form string, entry string, a long, b long").groupBy("form", "entry").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n_a + 1.0)) - F.log((F.col("b") + 2.0) / (n_b + 1.0))  # rare words need support
    told = materialise(sums.where(F.col("a") >= least).withColumn("odds", odds).where(F.col("odds") >= np.log(16.0)).where("length(entry) > 2"), "toxicity-lexicons")
    entries = {}
    for form in _FORMS:
        rows = told.where(F.col("form") == form).orderBy(F.desc(F.col("odds") * F.sqrt("a")), "entry").limit(ENTRIES).collect()
        entries[form] = [r["entry"] for r in rows], np.array([r["odds"] for r in rows])
    return Lexicons(entries)


def votes(evidence: np.ndarray) -> np.ndarray:
    """One column for each voter: 1 toxic, -1 clean, 0 abstains."""
    out = []

    def voter(yes: np.ndarray, no: np.ndarray) -> None:
        out.append(np.where(yes, 1, np.where(no, -1, 0)))

    words = np.maximum(evidence[:, -4], 1)
    for i in range(len(_FORMS)):
        hits, kinds, weight = evidence[:, 3 * i], evidence[:, 3 * i + 1], evidence[:, 3 * i + 2]
        whole = i == 0  # a language whose words share no stems is not clean for want of stems
        voter(kinds >= 2, (hits == 0) & whole)
        voter(hits / words >= 0.01, (hits / words < 0.002) & whole)
        voter(weight >= 8, (weight < 2) & whole)
    voter(evidence[:, -1] >= 2, np.zeros(len(words), bool))
    voter((evidence[:, -3] / words >= 0.2) & (evidence[:, 0] > 0), np.zeros(len(words), bool))
    voter((evidence[:, -2] / words >= 0.2) & (evidence[:, 0] > 0), np.zeros(len(words), bool))
    # the voters below know nothing of labels
    never = np.zeros(len(words), bool)
    named = evidence[:, [_AT[f"list_{k}"] for k in INSULTS]]
    hits = named.sum(1)
    for k in range(len(INSULTS)):
        voter((named[:, k] >= 2) | (named[:, k] / words >= 0.02), never)
    voter(hits / words >= 0.005, hits == 0)
    voter(evidence[:, _AT["list_kinds"]] >= 2, never)
    voter((hits >= 1) & (evidence[:, _AT["list_threat"]] >= 1), never)
    voter((hits >= 1) & (evidence[:, _AT["list_address"]] >= 2), never)
    voter((hits >= 1) & (evidence[:, _AT["stretched"]] >= 1), never)
    return np.stack(out, 1).astype(np.int8)


VOTERS = 3 * len(_FORMS) + 3 + len(INSULTS) + 5


@dataclass
class LabelModel:
    """log P(vote | class) of each voter, the share of class 1, and voters' correlations given the class."""

    tables: np.ndarray
    prior: float
    correlations: np.ndarray

    def posterior(self, cast: np.ndarray) -> np.ndarray:
        """P(class 1 | votes). An abstention says nothing. A vote counts for one over the sum of its
        correlations with the votes cast, so that voters which repeat each other count once together."""
        steps, voted = np.arange(cast.shape[1]), cast != 0
        each = (self.tables[1, steps, cast + 1] - self.tables[0, steps, cast + 1]) * voted
        logit = (each / np.maximum(voted @ np.maximum(self.correlations, 0), 1)).sum(1) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def moments(patterns: np.ndarray, counts: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What a step needs of some vote patterns, `counts` documents each, that are class 1 with probability
    `q`: for both classes the weight, the votes of each kind, and their first and second moments. Additive."""
    out = []
    for share in (1 - q, q):
        w = counts * share
        cast = patterns.astype(np.float64)
        kinds = [(cast == v - 1).T @ w for v in range(3)]
        out += [np.array([w.sum()]), *kinds, cast.T @ w, (cast.T @ (cast * w[:, None])).ravel()]
    return np.concatenate(out)


def maximised(sums: np.ndarray, voters: int, prior: float) -> LabelModel:
    """The model that `moments` of all documents give: a voter's accuracy is its table of votes given the
    class, its correlations with others are those of the votes left over once the class is known."""
    tables, left = np.empty((2, voters, 3)), np.zeros((voters, voters))
    for c, part in enumerate(sums.reshape(2, -1)):
        weight, kinds, first = part[0], part[1 : 1 + 3 * voters].reshape(3, voters), part[1 + 3 * voters : 1 + 4 * voters]
        tables[c] = (kinds.T + 0.5) / (weight + 1.5)
        left += part[1 + 4 * voters :].reshape(voters, voters) - np.outer(first, first) / max(weight, 1e-9)
    scale = np.sqrt(np.maximum(np.diag(left), 1e-9))
    correlations = left / scale[:, None] / scale[None, :]
    np.fill_diagonal(correlations, 1.0)
    return LabelModel(np.log(tables), prior, correlations)


def label_model(summed, voters: int, prior: float, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation. `summed(model)` gives the moments of all documents under the model's
    posteriors (the first time under None: a start); `prior`, the share of class 1, is held."""
    model = None
    for _ in range(rounds):
        last, model = model, maximised(summed(model), voters, prior)
        if last is not None and np.abs(np.exp(last.tables) - np.exp(model.tables)).max() < 1e-6:
            break
    return model


def features(evidence: np.ndarray) -> np.ndarray:
    """Inputs of the linear classifier."""
    words = np.maximum(evidence[:, -4:-3], 1)
    n, lists = 3 * len(_FORMS), evidence[:, 3 * len(_FORMS) : -4]
    return np.concatenate([np.log1p(evidence[:, :n]), np.minimum(evidence[:, :n:3] / words, 0.2) * 10, np.log1p(lists), np.minimum(evidence[:, -3:] / words, 1)], 1)


def fit_linear(x: np.ndarray, q: np.ndarray, w: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted logistic regression on posterior labels `q`, by Newton's method: mean, scale, coefficients."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], 1)
    beta, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (w * (q - p)) - penalty * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, beta


@dataclass
class ToxicityModel:
    lexicons: Lexicons
    labels: LabelModel
    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        z = (features(self.lexicons.evidence(texts)) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(z @ self.beta[:-1] + self.beta[-1], -30, 30)))


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, label: str = "toxic") -> ToxicityModel:
    """Lexicons from at most `limit` labelled rows; the label model from the vote patterns of all documents;
    the classifier from the evidence of those rows and of at most `limit` documents outside the held-out
    fold, labelled or not, under the model's posteriors. Without labelled rows of both kinds every score is the prior.

    Patterns are counted once and stay on the executors: a round of the label model is one pass over them that
    returns a sum for each task. The first posterior of a pattern is its share of labelled rows that are
    toxic, with one vote more for a pattern in which any voter says so."""
    sample = training_sample(docs, labels, label, limit)
    lexicons = learn_lexicons(sample)

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in slices(batch.column(0)):
                patterns, n = np.unique(votes(lexicons.evidence(x)), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in patterns], pa.binary()), pa.array(n)], ["pattern", "n"])

    def proof(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            found = np.concatenate([lexicons.evidence(x) for x in slices(batch.column(2))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.tolist(), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    def evidence_of(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        found = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "y", "text").mapInArrow(proof, "doc_id string, y int, x array<double>").toArrow().sort_by("doc_id")
        x = found["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(EVIDENCE)) if len(found) else np.zeros((0, len(EVIDENCE)))
        return x, found["y"].to_numpy() > 0

    x, y = evidence_of(sample)
    prior = float((y.sum() + 1) / (len(y) + 10))
    marked = {}
    for key, toxic in zip((v.tobytes() for v in votes(x)), y.tolist(), strict=True):
        a, n = marked.get(key, (0, 0))
        marked[key] = (a + toxic, n + 1)
    seen = materialise(docs.select("text").mapInArrow(cast, "pattern binary, n long").groupBy("pattern").agg(F.sum("n").alias("n")), "toxicity-patterns")

    def summed(model: LabelModel | None) -> np.ndarray:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (b for b in batches if b.num_rows):
                keys = batch.column(0).to_pylist()
                patterns = np.frombuffer(b"".join(keys), np.int8).reshape(-1, VOTERS)
                if model is None:
                    q = np.array([(a + (p > 0).any()) / (n + 2) for p, (a, n) in zip(patterns, (marked.get(k, (0, 0)) for k in keys), strict=True)])
                else:
                    q = model.posterior(patterns)
                q = np.clip(q, 1e-3, 1 - 1e-3) if model is None else np.clip(q, 1e-6, 1 - 1e-6)
                yield pa.RecordBatch.from_arrays([pa.array([moments(patterns, batch.column(1).to_numpy().astype(np.float64), q).tolist()])], ["sums"])

        rows = [r["sums"] for r in seen.mapInArrow(sums, "sums array<double>").collect()]
        return np.sum([np.zeros(2 * (1 + 4 * VOTERS + VOTERS**2)), *(np.array(r) for r in rows)], axis=0)

    model = label_model(summed, VOTERS, prior)
    if not len(x) or y.all() or not y.any():
        width = features(np.zeros((1, len(EVIDENCE)))).shape[1]
        return ToxicityModel(lexicons, model, np.zeros(width), np.ones(width), np.append(np.zeros(width), np.log(model.prior / (1 - model.prior))))
    more, _ = evidence_of(document_sample(docs, limit).select("doc_id", F.lit(0).alias("y"), "text"))
    x = np.concatenate([x, more])
    q = model.posterior(votes(x))
    return ToxicityModel(lexicons, model, *fit_linear(features(x), q, np.ones(len(q))))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """`docs` and a double column `toxicity_score` (a column of that name is replaced): 0 to 1, from the
    whole text alone; null and empty texts are scored as a text without evidence. Repeated rows and ties
    score alike; an empty table gives no rows."""
    columns = [c for c in docs.columns if c != "toxicity_score"]
    place = columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            score = pa.array(np.concatenate([model.scores(x) for x in slices(batch.column(place))]))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, "toxicity_score"])

    kept = docs.select(*(F.col(f"`{c}`") for c in columns))
    return kept.mapInArrow(scored, kept.select("*", F.lit(0.0).alias("toxicity_score")).schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = score_toxicity(docs, model).select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), F.col("toxicity_score").alias("score"))
    return scores.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
