"""Sources behind HTTP: a dataset catalog page by page, downloads with retries and checksums, change marks, host probes.

Requests are made by the tasks, so each address is asked once by one worker; the catalog is a Python data source with a task a query.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.error import HTTPError, URLError
from urllib.parse import quote, urlencode, urlsplit
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from millrace.functions import text as T
from millrace.session import ship

#: Seconds a request may take, how often it is made, and the longest wait between.
TIMEOUT, TRIES, LONGEST_WAIT = 60, 4, 60
CATALOG_SCHEMA = "query string, at long, id string, name string, title string, resources array<struct<id:string,url:string,format:string,name:string,hash:string,last_modified:string,size:long>>"


def wait_before(attempt: int, after: str | None) -> float:
    """Seconds before the next try: the server's wish, else doubling, within 0 and LONGEST_WAIT."""
    try:
        wish = float(after) if after else 2.0**attempt
    except ValueError:
        wish = 2.0**attempt
    return min(float(LONGEST_WAIT), max(0.0, wish))


def get(url: str, method: str = "GET", tries: int = TRIES, sleep=time.sleep) -> tuple[bytes, dict[str, str]]:  # noqa: ANN001
    """Body and headers (lower case) of an http(s) address; busy servers and broken connections are asked again, refusals are not."""
    if urlsplit(url).scheme not in ("http", "https"):
        raise ValueError(f"not an http address: {url}")
    for attempt in range(tries):
        try:
            with urlopen(Request(url, method=method, headers={"User-Agent": "millrace"}), timeout=TIMEOUT) as answer:  # noqa: S310
                return answer.read(), {k.lower(): v for k, v in answer.headers.items()}
        except HTTPError as error:
            if attempt + 1 == tries or not (error.code == 429 or error.code >= 500):
                raise
            sleep(wait_before(attempt, error.headers.get("Retry-After")))
        except (URLError, TimeoutError, ConnectionError):
            if attempt + 1 == tries:
                raise
            sleep(wait_before(attempt, None))
    raise AssertionError


def change_tag(url: str) -> str | None:
    """What tells one version of a file from another: its ETag, else its time of change, else nothing."""
    _, headers = get(url, "HEAD")
    return headers.get("etag") or headers.get("last-modified")


@dataclass
class Query(InputPartition):
    query: str


class CatalogReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.url, self.queries = options["url"], [q.strip() for q in options.get("queries", "").split("|")]
        self.rows, self.most = int(options.get("rows", "100")), int(options.get("limit", "0"))

    def partitions(self) -> list[Query]:
        return [Query(q) for q in dict.fromkeys(self.queries)]

    def read(self, part: Query | None) -> Iterator[tuple]:
        """Pages until the count is reached or a page is short; a limit of 0 or less takes all."""
        start = 0
        while part is not None:
            answer = json.loads(get(f"{self.url}?{urlencode({'q': part.query, 'rows': self.rows, 'start': start}, quote_via=quote)}")[0])
            if not answer.get("success"):
                raise ValueError(f"the catalog refused the query {part.query!r}")
            result = answer["result"]
            for k, item in enumerate(result["results"]):
                if 0 < self.most <= start + k:
                    return
                kept = ("id", "url", "format", "name", "hash", "last_modified")
                resources = [tuple(None if r.get(f) is None else str(r[f]) for f in kept) + (int(r["size"]) if str(r.get("size") or "").isdigit() else None,) for r in item.get("resources") or []]
                yield part.query, start + k, item.get("id"), item.get("name"), item.get("title"), resources
            start += len(result["results"])
            if start >= result["count"] or len(result["results"]) < self.rows:
                return


class Catalog(DataSource):
    """Options: ``url`` of a package_search action, ``queries`` parted by |, ``rows`` a page, ``limit`` a query (0: all)."""

    @classmethod
    def name(cls) -> str:
        return "catalog"

    def schema(self) -> str:
        return CATALOG_SCHEMA

    def reader(self, schema) -> CatalogReader:  # noqa: ANN001
        return CatalogReader(dict(self.options))


def catalog(spark: SparkSession, url: str, queries: list[str], rows: int = 100, limit: int = 0) -> DataFrame:
    """(id, name, title, resources) of all datasets that a query finds, each once as its last query gives it, by lower-case name and id."""
    ship(spark)
    spark.dataSource.register(Catalog)
    found = spark.read.format("catalog").options(url=url, queries="|".join(queries), rows=str(rows), limit=str(limit)).load()
    order = spark.createDataFrame(list(enumerate(dict.fromkeys(queries))), "place int, query string")
    last = found.join(F.broadcast(order), "query").groupBy("id").agg(F.max_by(F.struct("name", "title", "resources"), F.struct("place", "at")).alias("d"))
    return last.select("id", "d.*").orderBy(F.lower("name"), "id")


def download_url(datasets: DataFrame, title: str, name: str) -> DataFrame:
    """(id, url): of datasets whose title holds one text, the first resource whose name holds another; at most one row."""
    rows = datasets.where(F.contains(F.lower("title"), F.lit(title.lower()))).select("id", F.posexplode("resources").alias("at", "r"))
    return rows.where(F.contains(F.lower("r.name"), F.lit(name.lower())) & F.col("r.url").rlike("^https?://")).orderBy("id", "at").limit(1).select("id", "r.url")


def fetched(resources: DataFrame, url: str = "url", tries: int = TRIES) -> DataFrame:
    """(url, content, sha256, tag, error, status) of each distinct address; failures are rows, see ``text.failure_kind``."""
    ship(resources.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for address in batch[url]:
                content = sha = tag = error = status = None
                try:
                    content, headers = get(address, tries=tries)
                    sha, tag = hashlib.sha256(content).hexdigest(), headers.get("etag") or headers.get("last-modified")
                except HTTPError as failure:
                    error, status = "http", failure.code
                except TimeoutError:
                    error = "timeout"
                except (URLError, ConnectionError) as failure:
                    error = "timeout" if isinstance(getattr(failure, "reason", None), TimeoutError) else "connection"
                except ValueError:
                    error = "address"
                yield pd.DataFrame([(address, content, sha, tag, error, status)], columns=["url", "content", "sha256", "tag", "error", "status"])

    return resources.select(url).where(F.col(url).isNotNull()).distinct().mapInPandas(run, "url string, content binary, sha256 string, tag string, error string, status int")


def probed(resources: DataFrame, url: str = "url") -> DataFrame:
    """(host, reachable, status) of each distinct host, asked once through one of its addresses; any answer shows that it is there."""
    ship(resources.sparkSession)
    hosts = resources.select(T.host(F.col(url)).alias("host"), F.col(url).alias("url")).where("host != ''").groupBy("host").agg(F.min("url").alias("url"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for host, address in zip(batch["host"], batch["url"], strict=True):
                reachable, status = True, 200
                try:
                    get(address, "HEAD", tries=1)
                except HTTPError as failure:
                    status = failure.code
                except (URLError, TimeoutError, ConnectionError, ValueError):
                    reachable, status = False, None
                yield pd.DataFrame({"host": [host], "reachable": [reachable], "status": pd.array([status], "Int32")})

    return hosts.mapInPandas(run, "host string, reachable boolean, status int")
