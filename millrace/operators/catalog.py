"""Catalogs of open datasets: search, change detection and sync decisions per resource."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators.skew import select_ranks

#: Queries that one search of titles may have.
MOST_QUERIES = 1_000


def words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0))


def rank_titles(datasets: DataFrame, terms: DataFrame) -> DataFrame:
    """(query, id, score): per query the best dataset of its last term; overlap 10 a word, 20 if contained, up to 5 for resources.

    ``datasets``: id, title, n_resources; ``terms``: query, ordinal, term. A search is a short list of terms from one caller, so it
    becomes one array in the plan (MOST_QUERIES at most) and every title is read once.
    """
    last = terms.groupBy("query").agg(F.max(F.struct("ordinal", "term"))["term"].alias("term")).limit(MOST_QUERIES + 1).collect()
    if len(last) > MOST_QUERIES:
        raise ValueError(f"more than {MOST_QUERIES} queries at once")
    score = lambda term: 10 * F.size(F.array_intersect(words(F.col("title")), words(F.lit(term)))) + F.when(F.contains(F.lower("title"), F.lower(F.lit(term))), 20).otherwise(0) + F.least(F.col("n_resources"), F.lit(5))
    best = [F.max_by(F.struct("id", score(r["term"]).alias("score")), F.struct(score(r["term"]), -F.col("id"))).alias(f"q{k}") for k, r in enumerate(last)]
    if not best:
        return datasets.limit(0).select(F.lit("").alias("query"), "id", F.lit(0).alias("score"))
    top = datasets.agg(*best)
    rows = F.array(*[F.struct(F.lit(r["query"]).alias("query"), F.col(f"q{k}.id").alias("id"), F.col(f"q{k}.score").alias("score")) for k, r in enumerate(last)])
    return top.select(F.explode(rows).alias("r")).select("r.*").where("id is not null")


def page(datasets: DataFrame, offset: int, limit: int) -> DataFrame:
    """A slice of the catalog sorted by lower-case name and id; a limit of 0 or less takes all."""
    sliced = datasets.orderBy(F.lower("name"), "id").offset(offset)
    return sliced.limit(limit) if limit > 0 else sliced


def structured(resources: Column, most: int = 0) -> Column:
    """Of an array of resources those with an address and a record format, in order, at most ``most`` if positive."""
    kept = F.filter(resources, lambda r: (F.coalesce(r["url"], F.lit("")) != "") & F.upper(r["format"]).isin(*T.STRUCTURED_FORMATS))
    return F.slice(kept, 1, most) if most > 0 else kept


def unchanged(old: dict[str, Column], new: dict[str, Column]) -> Column:
    """Same address; then the hash decides if there is one, else change time and size if there is either, else it changed."""
    by_marks = old["last_modified"].eqNullSafe(new["last_modified"]) & old["size"].eqNullSafe(new["size"])
    same = F.when(F.coalesce(new["hash"], F.lit("")) != "", old["hash"].eqNullSafe(new["hash"])).when(new["last_modified"].isNotNull() | new["size"].isNotNull(), by_marks).otherwise(False)
    return (old["url"] == new["url"]) & same


def sync_decisions(resources: DataFrame, prior: DataFrame, hosts: DataFrame, halt_after: int = 0) -> DataFrame:
    """``resources`` (ordinal, url, hash, last_modified, size, throttled) with host and decision.

    blocked_unreachable: the host (host, reachable) does not answer; blocked_throttled: at least ``halt_after`` earlier resources
    of this host were throttled (0: never); skip: unchanged since ``prior``; else download. ``prior`` has one row a url.
    """
    marks = ("hash", "last_modified", "size")
    old = prior.select(F.col("url").alias("__url"), *[F.col(c).alias(f"__{c}") for c in marks])
    rows = resources.withColumn("host", T.host(F.col("url"))).join(old, F.col("url") == F.col("__url"), "left").join(hosts.select("host", "reachable"), "host", "left")
    same = unchanged({"url": F.col("__url"), **{c: F.col(f"__{c}") for c in marks}}, {"url": F.col("url"), **{c: F.col(c) for c in marks}})
    # a host is blocked from its halt_after-th throttled resource on; that one's place is an exact order statistic of the few throttled rows
    if halt_after > 0:
        hit = rows.where(F.col("throttled") & (F.col("host") != "")).select("host", F.col("ordinal").cast("long").alias("ordinal"))
        blocked = select_ranks(hit, ["host"], "ordinal", F.array(F.lit(halt_after).cast("long"))).select("host", F.col("value").alias("__from"))
    else:
        blocked = hosts.limit(0).select("host", F.lit(0).cast("long").alias("__from"))
    rows = rows.join(blocked, "host", "left")
    decision = F.when((F.col("host") != "") & (F.col("reachable") == F.lit(False)), "blocked_unreachable").when(F.col("ordinal") > F.col("__from"), "blocked_throttled").when(F.col("__url").isNotNull() & same, "skip").otherwise("download")
    return rows.withColumn("decision", decision).drop("__url", "__hash", "__last_modified", "__size", "__from", "reachable")


def pending(documents: DataFrame, done: DataFrame, key: str, url: str, extensions: Sequence[str], order: str) -> DataFrame:
    """Documents not fetched yet: an address with a readable extension, each key once by the first row in ``order``."""
    fit = documents.where(F.col(key).isNotNull() & T.has_extension(F.col(url), extensions)).join(done.select(key).distinct(), key, "left_anti")
    first = fit.groupBy(key).agg(F.min_by(url, order).alias(url))
    return first


def last_kept(rows: DataFrame, keys: Sequence[str], order: str, most: int) -> DataFrame:
    """Of each key the last ``most`` rows by ``order``."""
    back = Window.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("__k", F.row_number().over(back)).where(F.col("__k") <= most).drop("__k")


def progress(done: Column, count: Column, fingerprint: Column, old_count: Column, old_fingerprint: Column) -> Column:
    """Sorted distinct finished numbers, emptied if the catalog or its number of batches changed or was not known, or a number lies outside."""
    clean = F.sort_array(F.array_distinct(F.coalesce(done, F.array().cast("array<int>"))))
    bad = F.exists(clean, lambda i: i.isNull() | (i < 0) | (i >= count)) | ~old_count.eqNullSafe(count) | ~old_fingerprint.eqNullSafe(fingerprint)
    return F.when(bad, F.array().cast("array<int>")).otherwise(clean)


def fingerprint(datasets: DataFrame, order: str = "ordinal") -> str:
    """SHA-256 of the catalog's identities in order: of each dataset the id, else the name, else ''. A catalog is a driver's list."""
    ids = [r[0] for r in datasets.orderBy(order).select(F.coalesce(F.nullif("id", F.lit("")), F.nullif("name", F.lit("")), F.lit(""))).collect()]
    return hashlib.sha256(json.dumps(ids, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def curated(datasets: DataFrame, only: str | None = None) -> DataFrame:
    """The enabled datasets, ``only`` one id if asked, each with its http(s) addresses; by priority (99 if none) and id.

    ``datasets``: id, enabled, priority, urls. The decisions themselves (id edrsr) have their own pipeline and are left out.
    """
    rows = datasets.where(F.coalesce("enabled", F.lit(True)) & (F.col("id") != "edrsr"))
    rows = rows.where(F.col("id") == only) if only else rows
    urls = F.filter(F.coalesce("urls", F.array().cast("array<string>")), lambda u: u.rlike("^https?://"))
    return rows.withColumn("urls", urls).orderBy(F.coalesce("priority", F.lit(99)), "id")


def batch_summary(decisions: DataFrame, health: DataFrame) -> DataFrame:
    """One row: datasets, downloaded, resource_failures, blocked_resources, unreachable_hosts, throttled_hosts (sorted).

    ``decisions``: files, failed and blocked arrays a dataset; ``health``: host, reachable, throttled.
    """
    size = lambda c: F.greatest(F.size(c), F.lit(0)).cast("long").alias(c)
    none = F.lit(None)
    rows = decisions.select(F.lit(1).alias("one"), size("files"), size("failed"), size("blocked"), none.cast("string").alias("host"), none.cast("boolean").alias("reachable"), none.cast("boolean").alias("throttled"))
    rows = rows.unionByName(health.select("host", "reachable", "throttled"), allowMissingColumns=True)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    hosts = lambda cond: F.sort_array(F.collect_set(F.when(F.col("host").isNotNull() & cond, F.col("host"))))
    return rows.agg(total("one").alias("datasets"), total("files").alias("downloaded"), total("failed").alias("resource_failures"), total("blocked").alias("blocked_resources"), hosts(~F.coalesce("reachable", F.lit(False))).alias("unreachable_hosts"), hosts(F.coalesce("throttled", F.lit(False))).alias("throttled_hosts"))


def or_earlier(found: DataFrame, earlier: DataFrame) -> tuple[DataFrame, bool]:
    """A fresh catalog, or the earlier one where the search found nothing; and whether it is the earlier one."""
    return (earlier, True) if found.isEmpty() else (found, False)


def unchanged_since(tag: str | None, earlier: str | None) -> bool:
    """Whether a download can be skipped: the source names a version tag and it is the one taken before."""
    return bool(tag) and tag == earlier
