import threading

import pytest
from pyspark.sql import functions as F

from millrace.operators import graph, records, registers, resolve

ENTITIES = "entity_id long, type string, value string, title string"
EDGES = "a long, b long, kind string, dataset string, weight long"
MENTIONS = "entity_id long, dataset string"


def people(spark, rows):
    return spark.createDataFrame(rows, ENTITIES)


@pytest.fixture
def small_graph(spark):
    entities = people(spark, [(1, "edrpou", "35197641", "А"), (2, "edrpou", "44556677", "Б"), (11, "name", "ІВАНЕНКО ПЕТРО ОЛЕКСІЙОВИЧ", None), (12, "name", "КОВАЛЬ ОЛЬГА ІВАНІВНА", ""), (13, "name", "ШЕВЧУК ОЛЕГ", None), (14, "ipn", "1234567890", None)])
    edges = spark.createDataFrame([(1, 11, "founder", "edr", 1), (1, 12, "signer", "edr", 1), (1, 13, "founder", "edr", 1), (2, 11, "founder", "edr", 1), (1, 14, "founder", "edr", 1), (1, 11, "signer", "edr", 1), (11, 11, "founder", "edr", 1), (2, 12, "mentions", "x", 1)], EDGES)
    return entities, edges


def test_co_org(small_graph):
    entities, edges = small_graph
    got = sorted((r.a, r.b, r.weight) for r in graph.co_org(edges, entities).collect())
    assert got == [(11, 12, 1), (11, 13, 1), (12, 13, 1)]
    assert graph.co_org(edges, entities, max_group=2).count() == 0
    assert graph.co_org(edges.limit(0), entities).count() == 0


def test_fold(spark):
    events = spark.createDataFrame([("name", "А", None, 1), ("name", "А", "", 2), ("name", "А", "перша", 3), ("name", "А", "друга", 4), ("name", "", "x", 5), ("name", None, "x", 6), ("ipn", "А", None, 7)], "type string, value string, title string, seq long")
    assert sorted((r.type, r.value, r.title) for r in graph.fold_entities(events).collect()) == [("ipn", "А", None), ("name", "А", "перша")]
    edges = spark.createDataFrame([(2, 1, "k", "d", 5), (1, 2, "k", "d", None), (1, 1, "k", "d", 1), (None, 1, "k", "d", 1)], EDGES)
    assert [(r.a, r.b, r.weight) for r in graph.fold_edges(edges).collect()] == [(1, 2, 2)]
    assert [r.weight for r in graph.fold_edges(edges, "weight").collect()] == [6]


def context(spark, names, mentions, extra=()):
    entities = people(spark, [(1, "edrpou", "35197641", None), *[(k, "name", n, None) for k, n in names]])
    edges = spark.createDataFrame([(1, k, "founder", "edr", 1) for k, _ in names] + list(extra), EDGES)
    return [(r.a, r.b) for r in resolve.link_context(entities, edges, spark.createDataFrame(mentions, MENTIONS)).collect()]


def test_link_context(spark):
    full, short = (11, "ІВАНЕНКО ПЕТРО ОЛЕКСІЙОВИЧ"), (12, "ІВАНЕНКО П. О.")
    two = [(11, "edr"), (12, "experts")]
    assert context(spark, [full, short], two) == [(11, 12)]
    assert context(spark, [full, short], [(11, "edr"), (12, "edr")]) == []
    assert context(spark, [full, short], [(11, "edr")]) == []
    assert context(spark, [short, (13, "ІВАНЕНКО П. О")], [(12, "a"), (13, "b")]) == []
    assert context(spark, [full, (12, "ПЕТРЕНКО П. О.")], two) == []
    assert context(spark, [full, short, (13, "ІВАНЕНКО П О")], [*two, (13, "x")]) == []
    assert context(spark, [full, short, *[(20 + k, f"ІНШИЙ{chr(0x410 + k)} ОЛЕГ") for k in range(40)]], two) == []


def test_link_names(spark):
    rows = [(1, "name", "ІВАНЕНКО ПЕТРО ОЛЕКСІЙОВИЧ", None), (2, "ipn", "1234567890", "Іваненко Петро Олексійович"), (3, "ipn", "1234567891", "Іваненко Петро"), (4, "name", "ТОВ ІВАНЕНКО", None), (5, "name", "КОВАЛЬ ОЛЬГА", None), (6, "ipn", "1", "Коваль Ольга"), (7, "ipn", "2", "Коваль Ольга")]
    none = spark.createDataFrame([], EDGES)
    assert resolve.link_names(people(spark, rows), none).count() == 0  # the runner-up is too near
    assert [(r.name_id, r.ipn_id) for r in resolve.link_names(people(spark, rows), none, min_lead=0.05).collect()] == [(1, 2)]
    done = spark.createDataFrame([(1, 2, "identity", "name_resolve", 1)], EDGES)
    assert resolve.link_names(people(spark, rows), done, min_lead=0.05).count() == 0


def test_link_names_against_all_pairs(spark):
    given, fathers = ("ІВАН", "І", "ІГОР", "ПЕТРО", "П"), ("ІВАНОВИЧ", "ІГОРОВИЧ", "ПЕТРОВИЧ", "")
    shapes = [f"{s} {g} {f}".strip() for s in ("ТКАЧ", "МОРОЗ") for g in given for f in fathers] + ["ТКАЧ ІВАН І ПЕТРО", "ТКАЧ І І ПЕТРО", "ТКАЧ ПЕТРО І ІВАН"]
    agree = lambda a, b: 1.0 if a == b else 0.9 if (len(a) == 1) != (len(b) == 1) and a[0] == b[0] else None

    def score(x, y):
        x, y = x.split(), y.split()
        known = agree(x[1], y[1]) if x[0] == y[0] else None
        father = agree(x[2], y[2]) if len(x) > 2 and len(y) > 2 else 1 / 3 if len(x) > 2 or len(y) > 2 else 0.0
        return None if known is None or father is None else 0.5 + 0.35 * known + 0.15 * father

    for step in (3, 5, 7, 11):
        names = [(k, "name", shape, None) for k, shape in enumerate(shapes)]
        holders = [(100 + k, "ipn", str(k), shape) for k, shape in enumerate(shapes[step % 3 :: step])] + [(200 - step, "ipn", "x", shapes[step])]
        expected = set()
        for k, _, x, _ in names:
            fits = sorted((-v, i) for i, _, _, y in holders if (v := score(x, y)) is not None) + [(0.0, 0)]
            if len(fits) > 1 and fits[1][0] - fits[0][0] >= 0.02:
                expected.add((k, fits[0][1], round(-fits[0][0], 6)))
        got = resolve.link_names(people(spark, names + holders), spark.createDataFrame([], EDGES), min_score=0.5, min_lead=0.02).collect()
        assert expected and {(r.name_id, r.ipn_id, round(r.score, 6)) for r in got} == expected


def test_link_names_of_one_surname(spark):
    spelt = F.concat(F.lit("ТКАЧ Я"), F.translate(F.col("id").cast("string"), "0123456789", "АБВГДЕЖЗИК"), F.lit(" ІВАНОВИЧ"))
    names = spark.range(200_000).select(F.col("id").alias("entity_id"), F.lit("name").alias("type"), spelt.alias("value"), F.lit(None).cast("string").alias("title"))
    holders = spark.range(50_000).select((F.col("id") + 1_000_000).alias("entity_id"), F.lit("ipn").alias("type"), F.col("id").cast("string").alias("value"), spelt.alias("title"))
    stop = threading.Timer(90, spark.sparkContext.cancelAllJobs)  # all pairs, ten billion, take much longer
    stop.start()
    try:
        linked = resolve.link_names(names.unionByName(holders), spark.createDataFrame([], EDGES))
        assert linked.agg(F.count("*"), F.sum((F.col("ipn_id") == F.col("name_id") + 1_000_000).cast("int"))).first()[:] == (50_000, 50_000)
    finally:
        stop.cancel()


def test_search(spark, small_graph):
    entities, edges = small_graph
    ask = lambda **how: [r.entity_id for r in graph.resolve_entity(entities, **how).collect()]
    assert ask(code="351976412345") == [1] and ask(code="44556677") == [2] and ask(code="1234567890") == [14]
    assert ask(code="9976") == [] and ask(code="197641") == [1] and ask(code="abc") == [] and ask() == []
    assert ask(name=" шевчук  ") == [13]
    got = graph.reach(edges.where("a != b"), spark.createDataFrame([(2,)], "entity_id long"), 2).collect()
    assert sorted((r.node, r.level) for r in got) == [(1, 2), (11, 1), (12, 1)]
    card = graph.neighbours(edges.where("a != b"), entities, spark.createDataFrame([(2,)], "entity_id long"), most=1).collect()
    assert [(r.neighbour, r.kind) for r in card] == [(11, "founder")]
    assert graph.revoke(edges, "x").count() == 7


def test_co_mentions_and_judges(spark):
    docs = spark.createDataFrame([("1", ["b", "a", "a"]), ("2", ["a", "b", "c"]), ("3", ["a"]), ("4", None), ("5", [])], "k string, items array<string>")
    assert sorted((r.a, r.b, r.weight) for r in graph.co_mentions(docs, "k", "items").collect()) == [("a", "b", 2), ("a", "c", 1), ("b", "c", 1)]
    rows = spark.createDataFrame([("Суддя А.", "Суд"), ("СУДДЯ  А.", " суд "), (None, "Суд"), ("Б", "")], "judge string, court string")
    assert [tuple(r) for r in graph.sits_in(rows).collect()] == [("СУДДЯ А.", "СУД", 2)]


def test_registers(spark):
    debtors = spark.createDataFrame([(1, "Іваненко Петро", "1234567890"), (2, "ТОВ Ромашка", "35197641"), (3, "Дата", "16102003"), (4, "", ""), (5, "ФІЗИЧНА ОСОБА", "")], "seq long, `Debtor-Name` string, CODE string")
    register = registers.Register("debtors", {"name": ["DEBTOR_NAME"], "id": ["code"]}, subject="mixed", extra_fields=("CODE",))
    got = registers.counters(debtors, register).first()
    assert tuple(got) == (5, 2, 1, 0, 1)
    events = registers.person_events(debtors, register)
    assert {(r.type, r.value) for r in events.mentions.collect()} == {("name", "ІВАНЕНКО ПЕТРО"), ("ipn", "1234567890"), ("name", "ДАТА"), ("edrpou", "35197641")}
    assert [(r.a_type, r.b_type, r.kind) for r in events.edges.collect()] == [("name", "ipn", "identity")]
    parts = spark.createDataFrame([(1, "Іваненко", None, "Олексійович", "35197641", "x")], "seq long, L string, F string, M string, EDRPOU string, other string")
    named = registers.person_events(parts, registers.Register("wanted", {"person_parts": [["L"], ["F"], ["M"]], "edrpou": ["EDRPOU"]}, org_edge="friend"))
    assert [(r.a_value, r.b_value, r.kind) for r in named.edges.collect()] == [("ІВАНЕНКО ОЛЕКСІЙОВИЧ", "35197641", "linked")]


def test_match_codes(spark):
    payers = spark.createDataFrame([("351976412345",), ("1234567890",), ("999999991234",), ("12345678",), ("1234",), (None,)], "code string")
    companies = spark.createDataFrame([("35197641",), ("35197641",)], "edrpou string")
    got = {r.code: (r.type, r.value) for r in registers.match_codes(payers, companies).collect()}
    assert got == {"351976412345": ("edrpou", "35197641"), "1234567890": ("ipn", "1234567890"), "999999991234": ("ipn", "9999999912"), "12345678": ("edrpou", "12345678"), "1234": (None, None), None: (None, None)}


def test_records(spark):
    raw = spark.createDataFrame([("1/2", "  ", "x", None, [1])], "`Cause-Num` string, court_name string, Court string, text string, tail array<int>")
    row = records.normalize_decisions(raw, "d", "h", "f").first()
    assert (row.case_number, row.court, row.text, row.source_dataset) == ("1/2", None, None, "https://data.gov.ua/dataset/d")
    assert '"text":null' in row.extra and len(row) == len(records.DECISION_SCHEMA)
    codes = spark.createDataFrame([(1, "7", "old"), (2, " 7", "new"), (3, "8", "x")], "seq long, code string, name string")
    rows = spark.createDataFrame([("7 ",), ("9",), (None,)], "c string")
    assert [r.out for r in records.enrich(rows, "c", codes, "out").orderBy(F.col("c").desc_nulls_last()).collect()] == [None, "new", None]
    checked = spark.createDataFrame([("x" * 30,), ("short",), (None,)], "text string")
    wrong = records.errors({"text": F.col("text")}, ["text", "case_number"])
    assert [r.e for r in checked.select(wrong.alias("e")).collect()] == [["missing decision_date"], ["missing decision_date", "text too short"], ["missing decision_date"]]
    good, bad = records.quarantine(checked, records.errors({"text": F.col("text")}, records.REQUIRED_KEYS))
    assert (good.count(), bad.count()) == (2, 1)
    assert records.gate(checked.limit(0), wrong).first().passed is True
    generic = records.normalize_generic(spark.createDataFrame([("t", "a", "z")], "body string, id string, other string"), {"text": ["text", "body"], "key": ["id"]}).first()
    assert generic.extra == {"other": "z"} and generic.key == "a" and len(generic.text_sha256) == 64
