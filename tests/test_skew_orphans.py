import random

import pandas as pd
from pyspark.sql import functions as F

from millrace.operators import orphans, skew


def hot_rows(n=4000, seed=5):
    pick = random.Random(seed)
    rows = [(7 if k % 3 == 0 else pick.randrange(-50, 400), f"d{pick.randrange(4)}", pick.randrange(-(10**12), 10**12) if k % 5 else pick.randrange(3)) for k in range(n)]
    return rows + [(None, "x", 1), (3, None, None), (3, "d1", None)] + rows[:50]


def test_profile_against_pandas(spark):
    rows = hot_rows()
    frame = pd.DataFrame(rows, columns=["key", "dataset", "v"]).astype({"key": "Int64", "v": "Int64"})
    got = skew.profile(spark.createDataFrame(rows, "key long, dataset string, v long"), "key", "dataset", "v", light_rows=40).toPandas().set_index("key")
    for key, part in frame.dropna(subset=["key"]).groupby("key"):
        values = sorted(part["v"].dropna())
        row = got.loc[key]
        assert row["n_rows"] == len(part) and row["n_datasets"] == part["dataset"].nunique()
        assert row["median"] == values[-(-len(values) // 2) - 1] and row["top"] == values[-1]
    assert len(got) == frame["key"].nunique()


def test_select_ranks_ties_nulls_and_empty(spark):
    rows = spark.createDataFrame([("a", 5), ("a", 5), ("a", -9), ("a", None), (None, 1), ("b", 2**62)], "k string, v long")
    got = skew.select_ranks(rows, ["k"], "v", F.sequence(F.lit(1), F.col("n")), bits=3).collect()
    assert sorted((r.k, r.rank, r.value) for r in got) == [("a", 1, -9), ("a", 2, 5), ("a", 3, 5), ("b", 1, 2**62)]
    kept, skew.BROADCAST_TARGETS = skew.BROADCAST_TARGETS, 0  # the same beyond the bound
    try:
        again = skew.select_ranks(rows, ["k"], "v", F.sequence(F.lit(1), F.col("n")), bits=3).collect()
    finally:
        skew.BROADCAST_TARGETS = kept
    assert sorted(again) == sorted(got)
    assert skew.select_ranks(rows.limit(0), ["k"], "v", F.array(F.lit(1))).count() == 0


def test_hot_values(spark):
    rows = [("f", 1)] * 30 + [("f", k) for k in range(2, 72)] + [("g", 9)] * 2 + [("f", None)] * 3
    got = skew.hot_values(spark.createDataFrame(rows, "field string, key long"), "field", "key", 0.1)
    assert sorted((r.field, r.key, r.n) for r in got.collect()) == [("f", 1, 30), ("g", 9, 2)]


def test_hot_values_of_small_tables(spark):
    for n, many in ((79, 2), (519, 13), (1, 1)):
        df = spark.createDataFrame([("f", k) for k in range(n - many)] + [("f", 9999)] * many, "field string, v long")
        got = {r.v: r.n for r in skew.hot_values(df, "field", "v", 0.025).collect()}
        assert got == {9999: many}


def test_join_unique_keeps_rows(spark):
    left = spark.createDataFrame([(1, "x")] * 50 + [(2, "y"), (None, "z")], "k int, v string")
    right = spark.createDataFrame([(1, "one"), (3, "three")], "k int, w string")
    heavy = skew.heavy_keys(left.groupBy("k").agg(F.count("*").alias("n")), "k", share=0.5)
    got = skew.join_unique(left, right, "k", heavy).groupBy("k", "w").count().collect()
    assert {(r.k, r.w): r["count"] for r in got} == {(1, "one"): 50, (2, None): 1, (None, None): 1}


def test_orphans(spark):
    refs = spark.createDataFrame([("1", "a", "2020-01-05"), ("2", "a", "2019-12-31"), ("3", "zz", None), ("4", "", "2020-01-01"), ("5", None, "2020-01-01"), ("3", "zz", None), ("6", "b", None), ("7", "c", "2000-01-01")], "row_id string, key string, day string").withColumn("day", F.to_date("day")).withColumn("since", F.lit(1))
    targets = spark.createDataFrame([("a", "2020-06-01"), ("a", "2020-01-01"), ("b", "2021-01-01"), ("c", None), (None, None)], "key string, since string").withColumn("since", F.to_date("since"))
    for share in (0.005, 0.3):
        got = sorted((r.row_id, r.period, r.reason) for r in orphans.orphan_rows(refs, targets, True, share).collect())
        assert got == [("2", "2019-12", "late"), ("3", "unknown", "missing")]
        assert got == sorted((r.row_id, r.period, r.reason) for r in orphans.orphan_rows(refs, targets, True, share, broadcast_rows=0).collect())
        counts = sorted((r.period, r.reason, r.refs, r["keys"]) for r in orphans.orphan_counts(refs, targets, True, share).collect())
        assert counts == [("2019-12", "late", 1, 1), ("unknown", "missing", 2, 1)]
    assert orphans.orphan_rows(refs.limit(0), targets, True).count() == 0
    assert orphans.orphan_rows(refs, targets.limit(0), True).count() == 5


def test_plain_key(spark):
    got = spark.createDataFrame([("  Case-1  ",), ("",), (None,)], "k string").select(orphans.plain_key(F.col("k")).alias("k")).collect()
    assert [r.k for r in got] == ["case-1", "", None]


def test_join_split_of_a_hot_key(spark):
    left = spark.range(300).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("l")).union(spark.createDataFrame([(None, 5)], "k long, l long"))
    right = spark.createDataFrame([(7, "a"), (7, "b"), (10, "c"), (None, "d")], "k long, r string")
    assert skew.heavy_values(left, "k") == [7] and skew.heavy_values(left.limit(0), "k") == []
    plan = skew.join_split(left, right, "k", "l")
    assert sorted(plan.collect()) == sorted(left.join(right, "k").collect()) and plan.count() == 203


def test_stored_table(spark):
    from millrace.session import discard, stored

    done = stored(spark.range(10).withColumn("s", F.lit(None).cast("string")), n=F.count("*"), top=F.max("id"))
    assert done.seen == {"n": 10, "top": 9} and done.count() == 10 and stored(done.limit(0)).count() == 0
    discard(done)
    assert not __import__("os").path.exists(done.stored_at.removeprefix("file:"))
