"""The entity graph: event frames folded into entities, mentions and edges, and the operators over them.

Entities carry natural keys (type, value); an edge is an unordered pair with a < b. Inferred edges live in their own
``dataset`` so they can be revoked by a filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.session import cut

# Kinds of edges between a person and an organisation, and those that closing a triangle uses.
PERSON_ORG_KINDS = ("founder", "signer", "works_at", "linked", "beneficial_owner", "listed_in")
ROLE_KINDS = ("founder", "signer", "beneficial_owner", "linked", "works_at")


def entity_id(kind: Column, value: Column) -> Column:
    return F.xxhash64(kind, value)


def fold_entities(events: DataFrame) -> DataFrame:
    """(type, value, title): one row a natural key with its first non-empty title by ``seq``; null or '' values are dropped."""
    rows = events.where(F.col("value").isNotNull() & (F.col("value") != ""))
    title = F.min(F.when(F.col("title").isNotNull() & (F.col("title") != ""), F.struct("seq", "title")))
    return rows.groupBy("type", "value").agg(title["title"].alias("title"))


def fold_edges(events: DataFrame, weight: str | None = None) -> DataFrame:
    """(a, b, kind, dataset, weight): ends in order, self edges dropped, repeats counted (or ``weight`` summed)."""
    ends = events.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    ends = ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "kind", "dataset", *([weight] if weight else []))
    return ends.groupBy("a", "b", "kind", "dataset").agg((F.sum(F.coalesce(F.col(weight), F.lit(1))) if weight else F.count("*")).cast("long").alias("weight"))


def both_ways(edges: DataFrame) -> DataFrame:
    """Every edge once from each end: (src, dst, kind, dataset, weight), repeats merged."""
    keep = ["kind", "dataset", "weight"]
    return edges.select(F.col("a").alias("src"), F.col("b").alias("dst"), *keep).union(edges.select(F.col("b").alias("src"), F.col("a").alias("dst"), *keep)).distinct()


def memberships(edges: DataFrame, entities: DataFrame, kinds: Sequence[str] = ROLE_KINDS) -> DataFrame:
    """(company, person): the distinct role edges whose one end is a company; the first end wins if both are."""
    companies = entities.where("type = 'edrpou'").select(F.col("entity_id").alias("company"))
    roles = edges.where(F.col("kind").isin(*kinds) & (F.col("a") != F.col("b"))).select("a", "b")
    first = roles.join(companies, roles.a == companies.company, "left_semi").select(F.col("a").alias("company"), F.col("b").alias("person"))
    rest = roles.join(companies, roles.a == companies.company, "left_anti")
    second = rest.join(companies, rest.b == companies.company, "left_semi").select(F.col("b").alias("company"), F.col("a").alias("person"))
    return first.unionByName(second).distinct()


def co_members(members: DataFrame, group: str, member: str, max_group: int = 40) -> DataFrame:
    """(a, b, weight): members that share groups of 2 to ``max_group``; the guard comes before any pair is made.

    ``max_group`` is the operator's own rule against shell registrations, so a pair join meets at most that many rows a key.
    """
    pairs = members.select(group, member).dropna().distinct()
    small = pairs.groupBy(group).agg(F.count("*").alias("n")).where(F.col("n").between(2, max_group)).select(group)
    kept = pairs.join(small, group, "left_semi")
    left, right = kept.withColumnRenamed(member, "a"), kept.withColumnRenamed(member, "b")
    return left.join(right, group).where("a < b").groupBy("a", "b").agg(F.count("*").alias("weight"))


def co_org(edges: DataFrame, entities: DataFrame, max_group: int = 40) -> DataFrame:
    """(a, b, weight): people (type name) who share companies, weighted by the number of shared companies."""
    people = entities.where("type = 'name'").select(F.col("entity_id").alias("person"))
    return co_members(memberships(edges, entities).join(people, "person", "left_semi"), "company", "person", max_group)


def co_mentions(docs: DataFrame, key: str, items: str) -> DataFrame:
    """(a, b, weight): items of one row's array taken in pairs (each distinct pair once a row), counted over rows.

    Each item is a row of its own that carries what stands behind it in the array, and makes its pairs there; so a row with many
    items is spread over as many steps and never held as the square of its length.
    """
    arr = F.array_sort(F.array_distinct(items))
    rows = docs.where(F.size(items) > 1).select(arr.alias("__i")).select(F.posexplode("__i").alias("__k", "a"), "__i")
    pairs = rows.select("a", F.explode(F.slice("__i", F.col("__k") + 2, F.size("__i"))).alias("b"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("weight"))


def sits_in(records: DataFrame, person: str = "judge", place: str = "court") -> DataFrame:
    """(judge, court, weight): judge and court edges from decisions that name both, by normalised names."""
    rows = records.select(T.normalize_name(F.col(person)).alias("judge"), T.normalize_name(F.col(place)).alias("court")).where("judge != '' and court != ''")
    return rows.groupBy("judge", "court").agg(F.count("*").alias("weight"))


def mention_counts(mentions: DataFrame) -> DataFrame:
    """(dataset, n, first_name): rows per dataset and the least non-null name."""
    return mentions.groupBy("dataset").agg(F.count("*").alias("n"), F.min("name").alias("first_name"))


def stats(entities: DataFrame, mentions: DataFrame, edges: DataFrame) -> DataFrame:
    one = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
    return one(entities, "entities").unionByName(one(mentions, "mentions")).unionByName(one(edges, "edges"))


def revoke(edges: DataFrame, dataset: str) -> DataFrame:
    """The graph without one inferred dataset."""
    return edges.where(F.col("dataset").isNull() | (F.col("dataset") != dataset))


def resolve_entity(entities: DataFrame, code: str | None = None, name: str | None = None) -> DataFrame:
    """At most one entity for a code or a name, by ranked rules; ties go to the least id; nothing asked gives nothing.

    Codes: 8 digits a company, 10 digits a tax number, longer ones by their first 8 and then 10 digits, at last any value that
    contains the digits. Names: the shortest normalised value that contains the asked one.
    """
    if code:
        wanted = "".join(c for c in code if c.isdigit())
        if not wanted:
            return entities.limit(0)
        rank = F.when((F.lit(len(wanted)) == 8) & (F.col("type") == "edrpou") & (F.col("value") == wanted), 1)
        rank = rank.when((F.lit(len(wanted)) == 10) & (F.col("type") == "ipn") & (F.col("value") == wanted), 1)
        if len(wanted) >= 12:
            rank = rank.when(F.col("value") == wanted[:8], 2).when(F.col("value") == wanted[:10], 3)
        rank = rank.when(F.contains("value", F.lit(wanted)), 4)
        ranked = entities.withColumn("__rank", rank).where("__rank is not null")
        return ranked.orderBy("__rank", "entity_id").limit(1).drop("__rank")
    if name and name.strip():
        asked = T.normalize_name(F.lit(name))
        return entities.where((F.col("type") == "name") & F.contains("value", asked)).orderBy(F.length("value"), "entity_id").limit(1)
    return entities.limit(0)


def neighbours(edges: DataFrame, entities: DataFrame, start: DataFrame, most: int = 30) -> DataFrame:
    """(start_id, neighbour, type, value, kind, dataset, weight): of each start (entity_id), its ``most`` heaviest edges."""
    near = both_ways(edges).join(start.select(F.col("entity_id").alias("src")), "src", "left_semi")
    order = Window.partitionBy("src").orderBy(F.desc_nulls_last("weight"), "dst", "kind", "dataset")
    top = near.withColumn("__k", F.row_number().over(order)).where(F.col("__k") <= most).drop("__k")
    return top.join(entities.select(F.col("entity_id").alias("dst"), "type", "value"), "dst").select(F.col("src").alias("start_id"), F.col("dst").alias("neighbour"), "type", "value", "kind", "dataset", "weight")


def reach(edges: DataFrame, start: DataFrame, depth: int) -> DataFrame:
    """(node, level, via, kind, dataset, weight): every node within ``depth`` steps once, by its first level and least edge.

    ``start`` has entity_id. Each level joins the frontier with the edges and drops nodes seen before; levels are checkpointed.
    """
    steps = both_ways(edges)
    seen = start.select(F.col("entity_id").alias("node")).distinct()
    frontier, out = seen, None
    for level in range(1, depth + 1):
        into = steps.join(frontier.withColumnRenamed("node", "src"), "src").join(seen.withColumnRenamed("node", "dst"), "dst", "left_anti")
        best = into.groupBy(F.col("dst").alias("node")).agg(F.min(F.struct(F.col("src").alias("via"), "kind", "dataset", "weight")).alias("e"))
        found = cut(best.select("node", F.lit(level).alias("level"), "e.via", "e.kind", "e.dataset", "e.weight"))
        out = found if out is None else out.unionByName(found)
        frontier = found.select("node")
        seen = seen.unionByName(frontier)
    return out


def card(entities: DataFrame, mentions: DataFrame, edges: DataFrame, start: DataFrame, depth: int = 1, most: int = 30) -> DataFrame:
    """(section, entity_id, type, value, title, kind, dataset, n): what is known about one entity (``start``: entity_id).

    Sections: ``alias``, the other ends of its identity edges; ``mention``, per dataset the number of mentions and the least name
    (as title); ``neighbour``, of the entities within ``depth`` edges, each by its first edge, the ``most`` of the greatest weight.
    """
    one = start.select(F.col("entity_id").alias("src"))
    who = entities.select("entity_id", "type", "value", F.coalesce(F.nullif("title", F.lit("")), "value").alias("title"))
    empty = lambda kind="string": F.lit(None).cast(kind)
    near = both_ways(edges.where("kind = 'identity'")).join(F.broadcast(one), "src", "left_semi")
    alias = near.select(F.col("dst").alias("entity_id"), "kind", "dataset", F.col("weight").alias("n")).join(who, "entity_id")
    said = mentions.join(F.broadcast(one.withColumnRenamed("src", "entity_id")), "entity_id", "left_semi").groupBy("entity_id", "dataset").agg(F.count("*").alias("n"), F.min("name").alias("title"))
    top = reach(edges, start, depth).orderBy(F.desc_nulls_last("weight"), "node").limit(most)
    around = top.select(F.col("node").alias("entity_id"), "kind", "dataset", F.col("weight").alias("n")).join(who, "entity_id", "left")
    columns = ["section", "entity_id", "type", "value", "title", "kind", "dataset", "n"]
    parts = [alias.withColumn("section", F.lit("alias")), said.withColumns({"section": F.lit("mention"), "type": empty(), "value": empty(), "kind": empty()}), around.withColumn("section", F.lit("neighbour"))]
    return parts[0].select(columns).unionByName(parts[1].select(columns)).unionByName(parts[2].select(columns))


def co_org_counters(edges: DataFrame, entities: DataFrame, max_group: int = 40) -> DataFrame:
    """One row: companies, people (in companies of two or more, before the guard), skipped (companies beyond it), pairs."""
    people = entities.where("type = 'name'").select(F.col("entity_id").alias("person"))
    groups = memberships(edges, entities).join(people, "person", "left_semi").groupBy("company").agg(F.count("*").alias("n"))
    kept = F.col("n").between(2, max_group)
    return groups.agg(F.count("*").alias("companies"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("people"), F.count_if(F.col("n") > max_group).alias("skipped"), F.coalesce(F.sum(F.when(kept, F.col("n") * (F.col("n") - 1) / 2)), F.lit(0)).cast("long").alias("pairs"))
