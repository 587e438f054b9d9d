"""Conservative links between names and identities, each in a revocable dataset of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators.graph import memberships
from millrace.session import stored

# The least score of a link, the least lead over the runner-up, the largest group that is paired.
MIN_SCORE, MIN_LEAD, MAX_GROUP = 0.95, 0.2, 40


def shown(entities: DataFrame) -> DataFrame:
    """Entities with ``shown``, the title or else the value, and its ``tokens``."""
    named = entities.withColumn("shown", F.coalesce(F.nullif("title", F.lit("")), "value"))
    return named.withColumn("tokens", T.name_tokens(F.col("shown")))


def link_names(entities: DataFrame, edges: DataFrame, min_score: float = MIN_SCORE, min_lead: float = MIN_LEAD) -> DataFrame:
    """(name_id, ipn_id, score): names linked to the one tax-number holder that fits clearly best.

    A score depends on surname, given name and patronymic alone, and exists only where each is equal or the initial of the other.
    So holders are counted under each form they may be asked by, a fixed number, and each distinct name looks these up; no name meets
    the holders of its surname one by one. Of each name the best and the second best score are kept. Ends of earlier name_resolve
    edges are left out.
    """
    done = edges.where("kind = 'identity' and dataset = 'name_resolve'")
    done = done.select(F.col("a").alias("id")).union(done.select(F.col("b").alias("id"))).distinct()
    rows = shown(entities)
    words = [F.get("tokens", F.lit(k)).alias(c) for k, c in enumerate(("surname", "given"))] + [F.coalesce(F.get("tokens", F.lit(2)), F.lit("")).alias("patronymic")]
    person = T.is_person_name(F.col("shown"))
    people = rows.where((F.col("type") == "name") & person).select(F.col("entity_id").alias("name_id"), *words)
    people = people.join(done, people.name_id == done.id, "left_anti")
    holders = rows.where((F.col("type") == "ipn") & person).select(F.col("entity_id").alias("ipn_id"), *words)
    ranked = people.join(_best_holders(people.select("surname", "given", "patronymic").distinct(), holders), ["surname", "given", "patronymic"])
    best = Window.partitionBy("name_id").orderBy(F.desc("score"), "ipn_id")  # a name given in several rows
    ranked = ranked.select("name_id", "ipn_id", "score", F.row_number().over(best).alias("k"), F.greatest("second", F.lead("score", 1, 0.0).over(best)).alias("second"))
    return ranked.where((F.col("k") == 1) & (F.col("score") >= min_score) & (F.col("score") - F.col("second") >= min_lead)).select("name_id", "ipn_id", "score")


def _best_holders(names: DataFrame, holders: DataFrame) -> DataFrame:
    """(surname, given, patronymic, ipn_id, score, second) of distinct ``names``: the least of the holders that fit best, their score and the next holder's, 0.0 without one."""
    has = F.col("patronymic") != ""
    filed, looked = zip(T.agreeing(F.col("given")), T.agreeing(F.col("patronymic")), strict=True)
    # a patronymic agrees as words do, or is missing ("") on one side or both: all that have one are also filed under "any"
    kept = holders.groupBy("surname", "given", "patronymic").agg(F.count("*").alias("n"), F.min("ipn_id").alias("ipn_id"))
    kept = kept.withColumn("g", F.explode(filed[0])).withColumn("p", F.explode(F.when(has, F.array_append(filed[1], "any")).otherwise(F.array(F.lit("")))))
    kept = kept.groupBy("surname", "g", "p").agg(F.sum("n").alias("n"), F.min("ipn_id").alias("ipn_id"))
    entry = lambda key: F.struct(F.lit(key).alias("key"), F.lit(None).cast("double").alias("agreement"))
    asked = names.withColumn("x", F.explode(looked[0])).withColumn("y", F.explode(F.when(has, F.array_append(looked[1], entry(""))).otherwise(F.array(entry("any"), entry("")))))
    score = F.least(T.weighed(F.col("x.agreement"), F.col("y.agreement"), has, F.col("y.key") != ""), F.lit(1.0))
    asked = asked.select("surname", "given", "patronymic", F.col("x.key").alias("g"), F.col("y.key").alias("p"), score.alias("score"))
    best = Window.partitionBy("surname", "given", "patronymic").orderBy(F.desc("score"), "ipn_id")
    next_ = F.when(F.col("n") > 1, F.col("score")).otherwise(F.lead("score", 1, 0.0).over(best)).alias("second")
    return asked.join(kept, ["surname", "g", "p"]).select("surname", "given", "patronymic", "ipn_id", "score", next_, F.row_number().over(best).alias("k")).where("k = 1").drop("k")


def link_context(entities: DataFrame, edges: DataFrame, mentions: DataFrame, min_score: float = MIN_SCORE, max_group: int = MAX_GROUP) -> DataFrame:
    """(a, b, score, companies): names that agree inside a shared company, across registers, without a rival there.

    One of the two must be a full name, both need mentions, and not all from the same single register. A rival is another
    member of the company with at least this score for either; as scores are symmetric, each member's two best scores tell.
    """
    rows = shown(entities).where("type = 'name'")
    people = rows.where(T.is_name_candidate(F.col("shown")) | T.is_person_name(F.col("shown"))).select(F.col("entity_id").alias("person"), "tokens", T.is_person_name(F.col("shown")).alias("full"))
    members = memberships(edges, entities).join(people, "person")
    small = members.groupBy("company").agg(F.count("*").alias("n")).where(F.col("n").between(2, max_group)).select("company")
    seen = mentions.groupBy(F.col("entity_id").alias("person")).agg(F.min("dataset").alias("lo"), F.max("dataset").alias("hi"))
    kept = members.join(small, "company", "left_semi").join(seen, "person", "left").withColumn("surname", F.get("tokens", F.lit(0)))
    a = kept.select("company", "surname", *[F.col(c).alias(f"{c}_a") for c in ("person", "tokens", "full", "lo", "hi")])
    b = kept.select("company", "surname", *[F.col(c).alias(f"{c}_b") for c in ("person", "tokens", "full", "lo", "hi")])
    scored = stored(a.join(b, ["company", "surname"]).where("person_a != person_b").withColumn("score", T.name_score(F.col("tokens_a"), F.col("tokens_b"))).where("score is not null").drop("tokens_a", "tokens_b"))
    # the two best scores of a member, by the two best partners
    best = Window.partitionBy("company", "person_a").orderBy(F.desc("score"), "person_b")
    top = scored.select("company", F.col("person_a").alias("person"), "score", F.row_number().over(best).alias("k")).where("k = 2").select("company", "person", F.col("score").alias("second"))
    pairs = scored.where((F.col("person_a") < F.col("person_b")) & (F.col("score") >= min_score) & (F.col("full_a") | F.col("full_b")))
    pairs = pairs.where(F.col("lo_a").isNotNull() & F.col("lo_b").isNotNull() & ~((F.col("lo_a") == F.col("hi_a")) & (F.col("lo_b") == F.col("hi_b")) & (F.col("lo_a") == F.col("lo_b"))))
    for side in ("a", "b"):
        pairs = pairs.join(top.select("company", F.col("person").alias(f"person_{side}"), F.col("second").alias(f"second_{side}")), ["company", f"person_{side}"], "left")
    clear = pairs.where((F.coalesce("second_a", F.lit(-1.0)) < F.col("score")) & (F.coalesce("second_b", F.lit(-1.0)) < F.col("score")))
    return clear.groupBy(F.col("person_a").alias("a"), F.col("person_b").alias("b")).agg(F.max("score").alias("score"), F.count("*").alias("companies"))
