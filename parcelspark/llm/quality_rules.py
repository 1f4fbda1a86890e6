"""Quality rules with cross-document line frequency. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm.text import WORD, word_count
from parcelspark.session import materialise

_SPACE = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
RUN = 5
#: Distinct texts of a host that may share a line; words left, and their share, below which a document is depleted.
LINE_TEXTS, LEAST_WORDS, LEAST_SHARE = 30, 10, 0.5


def _row_key() -> Column:
    """Equal for repeated rows alone."""
    return F.concat_ws(":", F.hex(F.xxhash64("doc_id", "source", "text")), F.hex(F.xxhash64(F.lit(1), "text", "source", "doc_id")))


def statistics(docs: DataFrame) -> DataFrame:
    """`row_key`, `doc_id` and the base counts of each row, from the whole text; null is like empty.

    Runs of RUN words are told apart by a 64-bit hash. Most texts repeat none, which a distinct count of
    hashes shows; only the others sort their (hash, place) pairs, so a long repetitive text costs n log n.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(_row_key().alias("row_key"), "doc_id", text.alias("text"), F.array_remove(F.split(text, _SPACE), "").alias("words"), F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    runs = F.transform(F.slice("words", F.lit(1), F.greatest(F.size("words") - (RUN - 1), F.lit(0))), lambda w, i: F.xxhash64(w, *(F.get(F.col("words"), i + k) for k in range(1, RUN))))
    rows = rows.select(
        "row_key", "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", _SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), runs.alias("runs"),
    )
    rows = rows.withColumn("again", F.size(F.array_distinct("runs")) < F.size("runs"))
    rows = rows.withColumn("placed", F.when(F.col("again"), F.sort_array(F.transform("runs", lambda x, i: F.struct(x.alias("h"), i.alias("p")))))).drop("runs", "again")
    twice = F.transform("placed", lambda x, i: F.when((x["h"] == F.get(F.col("placed"), i - 1)["h"]) | (x["h"] == F.get(F.col("placed"), i + 1)["h"]), x["p"]))
    rows = rows.withColumn("places", F.sort_array(F.filter(twice, lambda p: p.isNotNull()))).drop("placed")
    covered = F.aggregate("places", F.struct(F.lit(-RUN).alias("last"), F.lit(0).alias("n")), lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(RUN), p - a["last"])).alias("n")))
    return rows.withColumn("n_repeat_words", F.coalesce(covered["n"], F.lit(0)).cast("long")).drop("places")


def frequent_words(docs: DataFrame, line_texts: int = LINE_TEXTS) -> DataFrame:
    """`(row_key, n_line_words)`: words on lines that more than `line_texts` distinct texts of the row's host have.

    A line is normalised (lower case, one space between words) and hashed; a host is a source, null being
    one. Copies of a text count once, repeated rows once. A line that most rows have is aggregated in each
    task before it moves, and the join on it can be split.
    """
    host = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null"))
    norm = lambda x: F.lower(F.btrim(F.regexp_replace(x, _SPACE, " ")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    each = docs.where("text is not null").select(_row_key().alias("row_key"), F.xxhash64("text").alias("of"), host.alias("host"), F.posexplode(F.transform(lines, lambda x: F.struct(norm(x).alias("line"), word_count(x).cast("int").alias("n")))).alias("place", "l"))
    each = materialise(each.select("row_key", "of", "place", F.xxhash64("host", "l.line").alias("line"), "l.n"), "rules-lines")
    texts = each.groupBy("line", "of").agg(F.lit(1).alias("one")).groupBy("line").agg(F.count("*").alias("n_texts"))
    frequent = materialise(texts.where(F.col("n_texts") > line_texts).select("line"), "rules-frequent")
    found = each.join(frequent, "line").groupBy("row_key", "place").agg(F.max("n").alias("n"))
    return found.groupBy("row_key").agg(F.sum("n").cast("long").alias("n_line_words"))


def quality_rules(docs: DataFrame, line_texts: int = LINE_TEXTS) -> DataFrame:
    """One row for each row of `docs` (doc_id, source, text): the base counts, `base_failed`,
    `n_line_words` (words that the line rule removes) and `kept`.

    base_failed: under 10 words, or over a fifth of them in repeated runs. kept: not base_failed, and
    without frequent lines at least LEAST_WORDS words and LEAST_SHARE of the text's words are left. Null
    and empty texts have no words and fail; null ids and sources are values like others; repeated rows are
    judged alike; an empty table gives no rows; other columns are not read.
    """
    rows = statistics(docs).join(frequent_words(docs, line_texts), "row_key", "left").withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0).cast("long")))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_line_words")
    rows = rows.withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (left >= LEAST_WORDS) & (left >= F.col("n_words") * F.lit(LEAST_SHARE))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "n_line_words")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_W = r"'[^\x20\x09-\x0D]+'"
ORACLE_SQL = {
    "op7_quality_rules": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, {_W}) AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_W})) AS ls FROM d),
runs AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i:i+4]) AS n FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
again AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM runs WHERE n > 1) GROUP BY rid),
lines AS (SELECT rid, source, text, lower(array_to_string(regexp_extract_all(l, {_W}), ' ')) AS line, len(regexp_extract_all(l, {_W})) AS n FROM (SELECT rid, source, text, unnest(ls) AS l FROM w)),
often AS (SELECT source, line FROM lines GROUP BY source, line HAVING count(DISTINCT text) > {LINE_TEXTS}),
gone AS (SELECT rid, sum(n) AS n FROM lines l JOIN often o ON l.source IS NOT DISTINCT FROM o.source AND l.line = o.line GROUP BY rid),
b AS (SELECT doc_id, cast(len(ws) AS bigint) AS n_words, cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS bigint) AS word_chars,
 cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols, cast(len(ls) - len(list_distinct(ls)) AS bigint) AS n_dup_lines,
 cast(coalesce(again.n, 0) AS bigint) AS n_repeat_words, cast(coalesce(gone.n, 0) AS bigint) AS n_line_words FROM w LEFT JOIN again USING (rid) LEFT JOIN gone USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
 NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - n_line_words >= {LEAST_WORDS} AND n_words - n_line_words >= n_words * {LEAST_SHARE} AS kept, n_line_words FROM b"""
}
