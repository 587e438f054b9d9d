"""References to records that do not exist, or exist only later than the reference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import HEAVY_SHARE, heavy_keys
from millrace.session import stored

#: Keys and days of orphans up to which their rows are found by a broadcast.
BROADCAST_ROWS = 200_000


def plain_key(key: Column) -> Column:
    """A text key without outer blanks (any Unicode blank) and letter case."""
    return F.lower(F.regexp_replace(key, r"(?U)^\s+|\s+$", ""))


def _verdicts(refs: DataFrame, targets: DataFrame, since: bool, share: float) -> tuple[DataFrame, list]:
    """(key, day, n, reason) of references, counted per key and day, that are orphans, stored; and the heavy keys.

    Keys with ``share`` of all references or more (at most 1/share) are checked against a broadcast of their targets, all
    others by a shuffle anti-join with the targets' keys; what exists may still be too late.
    """
    counts = stored(refs.groupBy("key", "day").agg(F.count("*").alias("n")))
    heavy = [r[0] for r in heavy_keys(counts, "key", share=share).collect()]
    there = targets.where("key is not null").groupBy("key").agg((F.min("since") if since else F.lit(None).cast("date")).alias("since"))
    hot = F.col("key").isin(heavy)
    found = []
    for some, known in [(counts.where(hot), F.broadcast(there.where(hot))), (counts.where(~hot), there)] if heavy else [(counts, there)]:
        found.append(some.join(known.select("key"), "key", "left_anti").withColumn("reason", F.lit("missing")))
        if since:
            found.append(some.join(known, "key").where(F.col("since") > F.col("day")).select("key", "day", "n", F.lit("late").alias("reason")))
    return stored(reduce(DataFrame.unionByName, found), rows=F.count("*")), heavy


def orphan_rows(refs: DataFrame, targets: DataFrame, since: bool = False, share: float = HEAVY_SHARE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(row_id, period, reason) of each orphan reference, once.

    ``refs``: row_id, key, day (date); ``targets``: key, since (date). A null or empty key is no reference; repeated rows
    of the same finding count once; a null day has the period ``unknown`` and is never late; a key all of whose ``since``
    are null is never late. Only the keys and days found are joined with the rows: by broadcast up to ``broadcast_rows``
    of them, beyond by a shuffle that leaves the heavy keys' rows where they are.
    """
    rows = refs.select("row_id", "key", "day").where("key is not null and key != ''")
    found, heavy = _verdicts(rows, targets, since, share)
    at = lambda df: df.withColumn("__day", F.coalesce(F.unix_date("day"), F.lit(-(2**31))))
    rows, found_at = at(rows), at(found).select("key", "__day", "reason")
    if found.seen["rows"] <= broadcast_rows:
        joined = rows.join(F.broadcast(found_at), ["key", "__day"])
    else:
        hot = F.col("key").isin(heavy)
        joined = rows.where(hot).join(F.broadcast(found_at.where(hot)), ["key", "__day"]).unionByName(rows.where(~hot).join(found_at.where(~hot), ["key", "__day"]))
    return joined.select("row_id", F.coalesce(F.date_format("day", "yyyy-MM"), F.lit("unknown")).alias("period"), "reason").distinct()


def orphan_counts(refs: DataFrame, targets: DataFrame, since: bool = False, share: float = HEAVY_SHARE) -> DataFrame:
    """(period, reason, refs, keys): references and distinct keys per month, counted before any join, repeats included."""
    found, _ = _verdicts(refs.select("key", "day").where("key is not null and key != ''"), targets, since, share)
    found = found.withColumn("period", F.coalesce(F.date_format("day", "yyyy-MM"), F.lit("unknown")))
    per_key = found.groupBy("period", "reason", "key").agg(F.sum("n").alias("n"))
    return per_key.groupBy("period", "reason").agg(F.sum("n").alias("refs"), F.count("*").alias("keys"))
