"""Paged searches as a Spark data source, and the errors that tell absence from failure."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

#: A transport: (method, url, body) to the decoded answer.
Transport = Callable[[str, str, dict | None], dict]


class Absent(Exception):
    """The store says that there is no such object."""


def checked_status(status: int, absent: frozenset[int] = frozenset({404, 410})) -> None:
    """Raise Absent for the statuses that mean absence, an error for any other failure."""
    if status in absent:
        raise Absent(status)
    if status >= 400:
        raise ConnectionError(f"status {status}")


def following(link: dict, url: str, body: dict | None) -> tuple[str, str, dict | None]:
    """The request that a `next` link stands for: its body replaces the last one or, if it says so, is merged."""
    method, href = (link.get("method") or "GET").upper(), link.get("href") or url
    if method == "GET":
        return method, href, None
    if link.get("body") is None:
        return method, href, body
    return method, href, {**(body or {}), **link["body"]} if link.get("merge") else dict(link["body"])


def pages(transport: Transport, url: str, body: dict) -> Iterator[dict]:
    """Features of all pages. A cursor that comes again, or another count than the server reports, is an
    error: a short result must not pass for a whole one."""
    request: tuple[str, str, dict | None] = ("POST", url, body)
    seen, found, expected = {json.dumps(request, sort_keys=True)}, 0, None
    while True:
        answer = transport(*request)
        if expected is None:
            expected = answer.get("numberMatched", (answer.get("context") or {}).get("matched"))
        for feature in answer.get("features", []):
            found += 1
            yield feature
        link = next((x for x in answer.get("links", []) if x.get("rel") == "next"), None)
        if link is None:
            break
        request = following(link, request[1], request[2])
        mark = json.dumps(request, sort_keys=True)
        if mark in seen:
            raise RuntimeError(f"paging does not advance after {found} features")
        seen.add(mark)
    if expected is not None and found != int(expected):
        raise RuntimeError(f"{found} features of the {expected} that the server reports")


def search(spark: SparkSession, transport: Transport, url: str, bodies: list[dict]) -> DataFrame:
    """`(part, feature)`: features (as JSON texts) of several searches, one task for each search."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for part, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [json.dumps(f) for f in pages(transport, url, json.loads(body))]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.int32()), pa.array(rows, pa.string())], ["part", "feature"])

    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], "part int, body string")
    return df.repartition(max(1, len(bodies)), "part").mapInArrow(run, "part int, feature string")


def retried(transport: Transport, attempts: int = 6, pause: Callable[[int], None] = lambda _: None) -> Transport:
    """A transport that tries again after connection errors; what is absent stays absent at once."""

    def call(method: str, url: str, body: dict | None) -> dict:
        for i in range(attempts):
            try:
                return transport(method, url, body)
            except ConnectionError:
                if i + 1 == attempts:
                    raise
                pause(i)
        raise AssertionError("unreachable")

    return call


def probe(urls: DataFrame, head: Callable[[str], tuple[int, int]], absent: frozenset[int] = frozenset({403, 404})) -> DataFrame:
    """`(url, size)` of a column of urls: size is null where the store says there is none; any other failure
    of `head` (url to status and size) is an error."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            sizes = []
            for url in batch.column(0).to_pylist():
                status, size = head(url)
                try:
                    checked_status(status, absent)
                    sizes.append(size)
                except Absent:
                    sizes.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["url", "size"])

    return urls.select("url").mapInArrow(run, "url string, size long")


def fetched(urls: DataFrame, get: Callable[[str], tuple[int, bytes]], attempts: int = 6, absent: frozenset[int] = frozenset({404, 410})) -> DataFrame:
    """`(url, content, tries)`: whole objects by `get` (url to status and bytes), tried again after connection errors and
    server failures; content is null where the store says there is none."""
    import pyarrow as pa

    def one(url: str) -> tuple[bytes | None, int]:
        for n in range(1, attempts + 1):
            try:
                status, data = get(url)
                checked_status(status, absent)
                return data, n
            except Absent:
                return None, n
            except ConnectionError:
                if n == attempts:
                    raise
        raise AssertionError("unreachable")

    def run(batches):
        for batch in batches:
            rows = [one(u) for u in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32())], ["url", "content", "tries"])

    return urls.select("url").mapInArrow(run, "url string, content binary, tries int")


def manifests(spark: SparkSession, get: Callable[[str], tuple[int, bytes]], base: str, years: list[int]) -> DataFrame:
    """`(year, line)`: the lines of each year's manifest, `base`/year.csv; a year without one is an error."""
    from pyspark.sql import functions as F

    urls = spark.createDataFrame([(f"{base}/{y}.csv", y) for y in years], "url string, year int")
    found = fetched(urls.repartition(max(1, len(years)), "url"), get).join(F.broadcast(urls), "url")
    text = F.when(F.col("content").isNull(), F.raise_error(F.concat(F.lit("no manifest at "), F.col("url")))).otherwise(F.decode("content", "utf-8"))
    return found.select("year", F.explode(F.split(F.rtrim(text), "\n")).alias("line")).where("line <> ''")
