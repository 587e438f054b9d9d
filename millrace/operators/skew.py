"""Per-key work when a few keys hold most rows.

Nothing here sends the rows of one key to one task. Counts and extremes are mergeable, so Spark combines them
before the shuffle; exact quantiles come from value histograms that are refined digit by digit; joins treat the
few keys that can be heavy (a key with a share s of all rows is one of at most 1/s) by broadcast and shuffle the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from millrace.session import cut, stored

#: A key with this share of all rows counts as heavy; so at most HEAVY_SHARE ** -1 keys do.
HEAVY_SHARE = 0.005
#: Rank targets sent to all executors at most; beyond that they are joined by a shuffle.
BROADCAST_TARGETS = 50_000
#: Distinct values of one key that one task may hold.
LIGHT_ROWS = 10_000


def heavy_keys(counts: DataFrame, key: str, n: str = "n", share: float = HEAVY_SHARE) -> DataFrame:
    """Of pre-aggregated ``counts`` (key, n), the keys with at least ``share`` of all rows: at most 1/share, as a local table."""
    seen = Observation()
    summed = counts.groupBy(key).agg(F.sum(n).alias("__n")).observe(seen, F.sum("__n").alias("total"))
    most = summed.where(F.col(key).isNotNull()).orderBy(F.desc("__n")).limit(int(1 / share)).collect()
    rows = [(r[0],) for r in most if r["__n"] >= share * seen.get["total"]]
    return counts.sparkSession.createDataFrame(rows, f"`{key}` {counts.schema[key].dataType.simpleString()}")


def join_unique(left: DataFrame, right: DataFrame, key: str, heavy: DataFrame, how: str = "left") -> DataFrame:
    """``left`` joined with ``right`` (one row a key), the ``heavy`` keys of ``left`` without a shuffle of their rows.

    ``heavy`` must be bounded (see ``heavy_keys``); null keys of ``left`` are kept by ``how='left'`` and match nothing.
    """
    few = F.broadcast(right.join(F.broadcast(heavy), key, "left_semi"))
    return left.join(F.broadcast(heavy), key, "left_semi").join(few, key, how).unionByName(left.join(F.broadcast(heavy), key, "left_anti").join(right, key, how))


def heavy_values(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> list:
    """Keys that hold ``share`` of the rows or more, at most 1/share of them; counted before the shuffle."""
    seen = Observation()
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")).observe(seen, F.sum("__n").alias("total"))
    most = counts.orderBy(F.desc("__n")).limit(int(1 / share)).collect()
    return [r[0] for r in most if r["__n"] >= share * seen.get["total"] and r["__n"] > 1]


def join_split(left: DataFrame, right: DataFrame, key: str, by: str, parts: int = 32, share: float = HEAVY_SHARE) -> DataFrame:
    """Inner join of two sides that both repeat keys: rows of ``left`` under a heavy key are dealt out to ``parts`` tasks by a
    hash of ``by``, and the few keys' rows of ``right`` go to each of them. Null keys match nothing."""
    heavy = heavy_values(left, key, share)
    if not heavy:
        return left.join(right, key)
    hot = F.col(key).isin(heavy)
    dealt = left.withColumn("__part", F.when(hot, F.pmod(F.xxhash64(by), F.lit(parts))).otherwise(0).cast("int"))
    copied = right.withColumn("__part", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(copied, [key, "__part"]).drop("__part")


def select_ranks(df: DataFrame, keys: Sequence[str], value: str, ranks: Column, bits: int = 10) -> DataFrame:
    """Exact order statistics per key: (*keys, rank, value) for each wanted rank (1 is the smallest value).

    ``value`` is a long column; ``ranks`` an array expression over ``n``, the key's row count. Rows whose key or value is
    null do not count; ranks outside 1..n give no row; ties count once a row. The rows are read once, into counts per key
    and value. Each round these are added up in at most 2**bits bins of each open interval, the sums are merged, and every
    rank steps into its bin, until bins are single values. So a round moves counts, never rows, however hot a key is.
    """
    keys = list(keys)
    rows = df.select(*[F.col(k) for k in keys], F.col(value).cast("long").alias("__v")).dropna()
    rows = stored(rows.groupBy(*keys, "__v").agg(F.count("*").alias("__c")), least=F.min("__v"), most=F.max("__v"))
    least, most = rows.seen["least"], rows.seen["most"]
    schema_only = rows.groupBy(*keys).agg(F.sum("__c").alias("n")).select(*keys, F.explode(ranks.cast("array<long>")).alias("rank"), F.col("n").alias("__n"))
    targets = schema_only.where(F.col("rank").between(1, F.col("__n"))).distinct().select(*keys, "rank", F.lit(0).cast("long").alias("__bin"), F.lit(0).cast("long").alias("__below"))
    if least is None:
        return targets.select(*keys, "rank", F.col("__bin").alias("value"))
    span = max(1, (most - least).bit_length())
    targets = cut(targets)
    small = targets.limit(BROADCAST_TARGETS + 1).count() <= BROADCAST_TARGETS
    rows = rows.withColumn("__v", F.col("__v") - F.lit(least))
    shift = span
    while shift > 0:
        step = min(bits, shift)
        part, open_ = rows.withColumn("__bin", F.shiftright("__v", shift) if shift < 63 else F.lit(0).cast("long")), targets.select(*keys, "__bin").distinct()
        part = part.join(F.broadcast(open_), [*keys, "__bin"], "left_semi") if small else part
        counts = part.groupBy(*keys, "__bin", F.shiftright("__v", shift - step).alias("__next")).agg(F.sum("__c").alias("__c"))
        counts = counts if small else counts.join(open_, [*keys, "__bin"], "left_semi")  # many targets: bins are joined, not values
        running = Window.partitionBy(*keys, "__bin").orderBy("__next")
        counts = counts.withColumn("__upto", F.sum("__c").over(running))
        into = counts.join(F.broadcast(targets) if small else targets, [*keys, "__bin"]).where((F.col("rank") - F.col("__below") <= F.col("__upto")) & (F.col("rank") - F.col("__below") > F.col("__upto") - F.col("__c")))
        targets = cut(into.select(*keys, "rank", F.col("__next").alias("__bin"), (F.col("__below") + F.col("__upto") - F.col("__c")).alias("__below")))
        shift -= step
    return targets.select(*keys, "rank", (F.col("__bin") + F.lit(least)).alias("value"))


def hot_values(df: DataFrame, field: str, value: str, share: float) -> DataFrame:
    """(field, value, n, total) of each value that holds at least ``share`` of its field's rows, repeats and nulls counted.

    A run of at least share * n equal values in sorted order covers a multiple of floor(share * n), so the order
    statistics at those ranks are the only candidates; their exact counts decide.
    """
    step = F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(share)))
    ranks = F.sequence(step, F.col("n"), step)  # at most 2 / share
    found = select_ranks(df, [field], value, ranks).select(field, F.col("value").alias(value)).distinct()
    counts = stored(df.groupBy(field, value).agg(F.count("*").alias("n")))
    totals = counts.groupBy(field).agg(F.sum("n").alias("total"))
    exact = counts.join(F.broadcast(found), [field, value], "left_semi")
    return exact.join(F.broadcast(totals), field).where(F.col("n") >= F.col("total") * F.lit(share))


def profile(df: DataFrame, key: str, dataset: str, number: str, light_rows: int = LIGHT_ROWS) -> DataFrame:
    """(key, n_rows, n_datasets, top, median) per non-null key: rows, distinct datasets, largest and exact median ``number``.

    Keys of up to ``light_rows`` rows take the median in one aggregate; larger keys take it by ``select_ranks``.
    ``number`` is a long column; null numbers count as rows but not for ``top`` and ``median``, which are null without numbers.
    """
    rows = df.select(F.col(key).alias("key"), F.col(dataset).alias("__d"), F.col(number).cast("long").alias("__v")).where("key is not null")
    by_set = rows.groupBy("key", "__d").agg(F.count("*").alias("n"), F.max("__v").alias("top"))
    sums = by_set.groupBy("key").agg(F.sum("n").alias("n_rows"), F.count("__d").alias("n_datasets"), F.max("top").alias("top"))
    by_value = rows.where("__v is not null").groupBy("key", "__v").agg(F.count("*").alias("c"))
    big = cut(sums.where(F.col("n_rows") > light_rows).select("key"))
    is_few = big.limit(BROADCAST_TARGETS + 1).count() <= BROADCAST_TARGETS
    named = F.broadcast(big) if is_few else big
    light = by_value.join(named, "key", "left_anti").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("__v", "c"))).alias("__all"), F.sum("c").alias("__n"))
    upto = F.aggregate("__all", F.struct(F.lit(0).cast("long").alias("s"), F.lit(None).cast("long").alias("m")), lambda a, x: F.struct((a["s"] + x["c"]).alias("s"), F.when(a["m"].isNull() & ((a["s"] + x["c"]) * 2 >= F.col("__n")), x["__v"]).otherwise(a["m"]).alias("m")))
    light = light.select("key", upto["m"].alias("median"))
    heavy = select_ranks(rows.join(named, "key", "left_semi"), ["key"], "__v", F.array(F.ceil(F.col("n") / 2))).select("key", F.col("value").alias("median"))
    return sums.join(light.unionByName(heavy), "key", "left").select("key", "n_rows", "n_datasets", "top", "median")
