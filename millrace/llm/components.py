"""Connected components of match pairs by alternating large-star and small-star edge rewrites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import HEAVY_SHARE
from millrace.session import cut, cut_observed, release


def _with_least(pairs: DataFrame, share: float, total: int) -> DataFrame:
    """``pairs`` (u, v) with ``m``, the least of u and all its v; hubs of u get theirs by broadcast, their rows unmoved.

    A hub has ``share`` of ``total`` pairs or more, so there are at most 1/share of them.
    """
    grouped = pairs.groupBy("u").agg(F.count("*").alias("n"), F.least(F.min("v"), F.first("u")).alias("m"))
    stats, seen = cut_observed(grouped, most=F.max("n"))
    least, bound = stats.select("u", "m"), max(2, total * share)
    if (seen["most"] or 0) < bound:
        return pairs.join(least, "u")
    few = F.broadcast(cut(stats.where(F.col("n") >= bound).select("u", "m")))
    return pairs.join(few, "u").unionByName(pairs.join(few, "u", "left_anti").join(least, "u"))


def _large_star(edges: DataFrame, share: float, total: int) -> DataFrame:
    """Each node links its larger neighbours to its least neighbour (or itself)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both, share, 2 * total).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame, share: float, total: int) -> DataFrame:
    """Each node links its smaller neighbours and itself to the least of them; ``edges`` are distinct with u > v, as a large star leaves them."""
    starred = _with_least(edges, share, total)
    return starred.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _marked(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges checkpointed, with their number and the sum of their hashes."""
    done, seen = cut_observed(edges, n=F.count("*"), h=F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")))
    return done, (seen["n"], int(seen["h"] or 0))


def connected_components(pairs: DataFrame, a: str, b: str, share: float = HEAVY_SHARE, most_rounds: int = 60) -> DataFrame:
    """(id, group_id) for every id in a pair of two different ids; group_id is the least id of the component.

    Direction, repeats and self pairs do not matter, rows with a null end are ignored, other columns are not read; no
    pairs give no rows. Every round is one large-star and one small-star rewrite, cut by a checkpoint; it ends when the
    edge set no longer changes (checked by row count and a sum of hashes), which is a forest of stars at the minima.
    """
    edges = pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    edges, seen = _marked(edges)
    for _ in range(most_rounds):
        edges, now = _marked(_small_star(cut(_large_star(edges, share, seen[0])), share, seen[0]))
        if now == seen:
            break
        seen = now
        release(pairs.sparkSession)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("group_id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("group_id")).unionByName(roots)
