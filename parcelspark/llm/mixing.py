"""Temperature mixing of sources, realised as budgeted block permutations. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelspark.llm.text import word_count
from parcelspark.session import materialise

#: Exponents tried in one pass; PASSES passes leave a bracket of ARMS ** -PASSES.
ARMS, PASSES = 32, 8
#: A source table of at most this many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 100_000


def _key(*parts: Column | str | int) -> Column:
    """A 60-bit number from the md5 of the parts' texts."""
    texts = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *texts).cast("binary")), 1, 15), 16, 10).cast("long")


def _search(good, low: float, high: float) -> float:
    """The least exponent in [low, high] that is good, where all above it are. `good` judges ARMS at once."""
    for _ in range(PASSES):
        tried = [low + (high - low) * (i + 1) / ARMS for i in range(ARMS)]
        first = next((i for i, ok in enumerate(good(tried)) if ok), ARMS - 1)
        low, high = (tried[first - 1] if first else low), tried[first]
    return high


def exponent(shares: DataFrame, repetition_limit: float | None, target_entropy: float | None, budget_share: float | None = None) -> float:
    """The exponent t in [0, 1] of weights p ** t / sum(p ** t) over `shares` (`p`, positive).

    Entropy falls from log(sources) at t = 0 to that of the shares at t = 1. Under `target_entropy`
    (in nats) t is the largest whose entropy reaches it; under `repetition_limit` the least at which no
    source is read more often than that. With both, the limit wins. What no exponent meets is an error: an
    entropy above log(sources), a limit below the budget over all tokens. Each pass of the bisection sums over
    the table once for ARMS exponents; no source leaves the executors.
    """
    if repetition_limit is None and target_entropy is None:
        return 1.0

    def sums(tried: list[float]):
        row = shares.agg(F.min("p").alias("least"), F.max("p").alias("most"), *(F.sum(F.pow("p", F.lit(t))).alias(f"z{i}") for i, t in enumerate(tried)), *(F.sum(F.pow("p", F.lit(t)) * F.log("p")).alias(f"l{i}") for i, t in enumerate(tried))).first()
        return row["least"], row["most"], [(row[f"z{i}"], row[f"l{i}"]) for i in range(len(tried))]

    def within(tried: list[float]) -> list[bool]:
        least, most, zs = sums(tried)
        if least is None:
            return [True] * len(tried)
        budget = [most / (most**t / z) if budget_share is None else budget_share for t, (z, _) in zip(tried, zs, strict=True)]
        return [least**t / z * b / least <= repetition_limit * (1 + 1e-12) for t, (z, _), b in zip(tried, zs, budget, strict=True)]

    def below(tried: list[float]) -> list[bool]:
        least, _, zs = sums(tried)
        return [least is None or math.log(z) - t * part / z < target_entropy for t, (z, part) in zip(tried, zs, strict=True)]

    found = 0.0
    if target_entropy is not None:
        _, _, [(z, _)] = sums([0.0])
        if z is not None and target_entropy > math.log(z) + 1e-9:
            raise ValueError(f"{z:.0f} sources reach an entropy of {math.log(z)}, not {target_entropy}")
        found = _search(below, 0.0, 1.0)
    if repetition_limit is not None and not within([found])[0]:
        if not within([1.0])[0]:
            raise ValueError(f"at any weights some source is read more than {repetition_limit} times under this budget")
        found = _search(within, found, 1.0)
    return found


def mix(docs: DataFrame, repetition_limit: float | None = 4.0, target_entropy: float | None = None, budget_tokens: int | None = None, block_tokens: int = 65_536, seed: int = 7) -> DataFrame:
    """All columns of `docs`, one row for each time a document is read, and a struct column `mix`:
    `(n_tokens, weight, epochs, epoch, block, block_key, doc_key)`.

    A source's share is its words over all; its weight the share to the exponent (see `exponent`),
    normalised. It is read weight * budget / tokens times. Without `budget_tokens` the budget is the
    least at which every source is read once in full, so no document is lost; small sources repeat. Each
    epoch is another permutation of the source's blocks (sort by epoch, block_key, doc_key); the last,
    partial one takes documents in that order until the source's budget is spent: to the nearest document,
    or, under `budget_tokens`, to the last that fits. Rows with one identity are taken together.

    A null source is a source. Null and empty texts have no tokens; a source without tokens is read once.
    Null ids are dealt by their text; repeated rows each count. An empty table gives no rows. A column
    of `docs` named mix is replaced.

    Texts are never shuffled: totals are pre-aggregated, the partial epoch is one threshold on block_key
    for each source (two levels of prefix sums over blocks, so that a source with most blocks is summed
    by many tasks) and one on doc_key in the block at which it ends, and what a document needs to know is
    one row for its source.
    """
    tokens = word_count(F.col("text"))
    identity = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    lengths = materialise(docs.select("source", identity.alias("identity"), tokens.alias("n")), "mix-lengths")
    found = materialise(lengths.groupBy("source").agg(F.sum("n").alias("tokens")), "mix-sources")
    n_sources, total = found.agg(F.count("*"), F.sum("tokens")).first()
    shares = found.where("tokens > 0").select("source", "tokens", (F.col("tokens") / F.lit(float(total or 1))).alias("p"))
    t = exponent(shares, repetition_limit, target_entropy, None if budget_tokens is None else budget_tokens / float(total or 1))
    z, most = shares.agg(F.sum(F.pow("p", F.lit(t))), F.max("p")).first()
    budget = float(budget_tokens) if budget_tokens is not None else (most or 0.0) / ((most or 1.0) ** t / (z or 1.0)) * float(total or 0)
    plan = found.select(
        "source", "tokens", F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(t)) / F.lit(z or 1.0)).otherwise(0.0).alias("weight"),
        F.ceil(F.greatest(F.col("tokens"), F.lit(1)) / F.lit(float(block_tokens))).alias("n_blocks"),
    )
    plan = plan.withColumn("epochs", F.when(F.col("tokens") > 0, F.col("weight") * F.lit(budget) / F.col("tokens")).otherwise(1.0))
    plan = plan.withColumn("full", F.floor(F.col("epochs") + 1e-9)).withColumn("left", F.greatest(F.col("epochs") - F.col("full"), F.lit(0.0)) * F.col("tokens"))
    plan = F.broadcast(plan) if n_sources <= BROADCAST_ROWS else plan

    block = F.pmod(_key(seed, F.col("d.identity")), F.col("p.n_blocks"))

    def dealt(rows: DataFrame, table: DataFrame) -> DataFrame:
        named = F.coalesce(F.concat(F.lit("s"), F.col("p.source")), F.lit("null"))
        joined = rows.alias("d").join(table.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
        return joined.withColumn("_block", block).withColumn("_key", _key(seed, named, F.col("_block"), F.col("p.full")))

    blocks = dealt(lengths, plan).groupBy("p.source", "_block", "_key", "left").agg(F.sum("n").alias("n"))
    blocks = materialise(blocks.withColumn("over", F.shiftright("_key", 50)), "mix-blocks")
    supers = blocks.groupBy("source", "over").agg(F.sum("n").alias("n"))
    ahead = Window.partitionBy("source").orderBy("over").rowsBetween(Window.unboundedPreceding, -1)
    supers = supers.select(F.col("source").alias("s"), F.col("over").alias("o"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "over").orderBy("_key", "_block")
    summed = blocks.withColumn("inner", F.sum("n").over(within)).join(supers, F.col("source").eqNullSafe(F.col("s")) & (F.col("over") == F.col("o")))
    summed = summed.withColumn("upto", F.col("base") + F.col("inner"))
    last = summed.where(F.col("upto") <= F.col("left") + 1e-6).groupBy("source").agg(F.max("_key").alias("last"))
    last = materialise(last, "mix-last").alias("l")
    few = F.broadcast if n_sources <= BROADCAST_ROWS else lambda x: x
    table = plan.alias("q").join(few(last), F.col("q.source").eqNullSafe(F.col("l.source")), "left").select("q.*", "l.last")
    # a block holds about block_tokens words, so the documents of the one that is cut are few, however large the source
    room = F.col("left") - (F.col("upto") - F.col("n"))
    cut = summed.where((F.col("left") >= 0.5) & (room > -1e-6) & (F.col("upto") > F.col("left") + 1e-6))
    cut = materialise(cut.groupBy("source").agg(F.min_by(F.struct(F.col("_block").alias("cut_block"), room.alias("room")), "upto").alias("cut")).select("source", "cut.*"), "mix-cuts").alias("c")
    inside = dealt(lengths.where("n > 0"), plan).join(few(cut), F.col("p.source").eqNullSafe(F.col("c.source")) & (F.col("_block") == F.col("c.cut_block")))
    inside = inside.groupBy("p.source", "c.cut_block", "room", _key(seed, F.col("d.identity"), F.col("p.full")).alias("doc_key")).agg(F.sum("d.n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("doc_key").rowsBetween(Window.unboundedPreceding, 0))
    spare = F.col("n") / 2 if budget_tokens is None else F.lit(0.0)
    ends = inside.withColumn("upto", upto).where(F.col("upto") - spare <= F.col("room") + 1e-6).groupBy("source", "cut_block").agg(F.max("doc_key").alias("cut_key"))
    ends = materialise(ends, "mix-ends").alias("e")
    table = table.alias("t").join(few(ends), F.col("t.source").eqNullSafe(F.col("e.source")), "left").select("t.*", "e.cut_block", "e.cut_key")
    table = few(table)

    columns = [c for c in docs.columns if c != "mix"]
    # what was in docs travels in one struct, so that no column of it can clash
    rows = dealt(docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), "source", identity.alias("identity"), tokens.alias("n")), table)
    more = F.col("_key") <= F.col("p.last")
    more = F.coalesce(more, F.lit(False)) | ((F.col("_block") == F.col("p.cut_block")) & (_key(seed, F.col("d.identity"), F.col("p.full")) <= F.col("p.cut_key")))
    copies = F.col("p.full") + F.when(more, 1).otherwise(0)
    rows = rows.where(copies > 0).withColumn("_epoch", F.explode(F.sequence(F.lit(0).cast("long"), copies.cast("long") - 1)))
    named = F.coalesce(F.concat(F.lit("s"), F.col("p.source")), F.lit("null"))
    details = F.struct(
        F.col("n").alias("n_tokens"), F.col("p.weight").alias("weight"), F.col("p.epochs").alias("epochs"), F.col("_epoch").alias("epoch"), F.col("_block").alias("block"),
        _key(seed, named, F.col("_block"), F.col("_epoch")).alias("block_key"), _key(seed, F.col("d.identity"), F.col("_epoch")).alias("doc_key"),
    )
    return rows.select("row", details.alias("mix")).select(*(F.col("row").getField(c).alias(c) for c in columns), "mix")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "source", F.round("mix.weight", 9).alias("weight"), F.round("mix.epochs", 6).alias("epochs"), "mix.n_tokens", "mix.epoch", "mix.block", "mix.block_key", "mix.doc_key")


def _sql_key(*parts: str) -> str:
    return f"cast('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 15) AS bigint)"


#: At these defaults the exponent has a closed form: the rarest source is read (most / least) ** (1 - t) times.
ORACLE_SQL = {
    "op1_mixing": f"""
WITH d AS (SELECT doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS bigint) AS n, coalesce(cast(doc_id AS varchar), md5(coalesce(text, ''))) AS ident FROM documents),
s AS (SELECT source, cast(sum(n) AS double) AS tokens FROM d GROUP BY source),
e AS (SELECT *, CASE WHEN most / least <= 4 THEN 0 ELSE 1 - ln(4) / ln(most / least) END AS t FROM (SELECT sum(tokens) AS total, min(tokens) / sum(tokens) AS least, max(tokens) / sum(tokens) AS most FROM s WHERE tokens > 0)),
z AS (SELECT sum(pow(tokens / total, t)) AS z FROM s, e WHERE tokens > 0),
p AS (SELECT *, floor(epochs + 1e-9) AS whole, greatest(epochs - floor(epochs + 1e-9), 0) * tokens AS rest FROM (SELECT source, tokens, coalesce('s' || source, 'null') AS named, ceil(greatest(tokens, 1) / 65536.0) AS n_blocks,
 CASE WHEN tokens > 0 THEN pow(tokens / total, t) / z ELSE 0 END AS weight, CASE WHEN tokens > 0 THEN pow(tokens / total, t) / z * (most / (pow(most, t) / z) * total) / tokens ELSE 1 END AS epochs FROM s, e, z)),
b AS (SELECT d.*, p.* EXCLUDE (source), {_sql_key("7", "ident")} % cast(n_blocks AS bigint) AS block FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
k AS (SELECT *, {_sql_key("7", "named", "block", "cast(whole AS bigint)")} AS own FROM b),
c AS (SELECT *, sum(n) OVER (PARTITION BY named ORDER BY own, block) AS upto FROM (SELECT named, block, own, max(rest) AS rest, sum(n) AS n FROM k GROUP BY named, block, own)),
l AS (SELECT named, max(own) AS last FROM c WHERE upto <= rest + 1e-6 GROUP BY named),
x AS (SELECT named, min_by(block, upto) AS cut_block, min_by(rest - (upto - n), upto) AS room FROM c WHERE rest >= 0.5 AND upto > rest + 1e-6 AND rest - (upto - n) > -1e-6 GROUP BY named),
y AS (SELECT named, room, {_sql_key("7", "ident", "cast(whole AS bigint)")} AS doc_key, sum(n) AS n FROM k JOIN x USING (named) WHERE block = cut_block AND n > 0 GROUP BY ALL),
e2 AS (SELECT named, max(doc_key) AS cut_key FROM (SELECT *, sum(n) OVER (PARTITION BY named ORDER BY doc_key) AS upto FROM y) WHERE upto - n / 2 <= room + 1e-6 GROUP BY named),
m AS (SELECT k.*, cast(whole AS bigint) + CASE WHEN own <= last OR (block = cut_block AND {_sql_key("7", "ident", "cast(whole AS bigint)")} <= cut_key) THEN 1 ELSE 0 END AS copies
 FROM k LEFT JOIN l USING (named) LEFT JOIN x USING (named) LEFT JOIN e2 USING (named)),
r AS (SELECT *, unnest(range(copies)) AS epoch FROM m WHERE copies > 0)
SELECT doc_id, source, round(weight, 9) AS weight, round(epochs, 6) AS epochs, n AS n_tokens, epoch, block, {_sql_key("7", "named", "block", "epoch")} AS block_key, {_sql_key("7", "ident", "epoch")} AS doc_key FROM r"""
}
