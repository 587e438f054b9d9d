"""The graph's build, guessing of unknown registers, release contracts: golden values."""

from pyspark.sql import functions as F

from millrace.operators import build, control, graph, guess, registers, release

SUBJECT = "seq long, edrpou string, name string, stan string, founders array<string>, signers array<string>"


def triples(events):
    value = {r.entity_id: (r.type, r.value) for r in events.entities.collect()}
    return {(*sorted((value[r.a], value[r.b])), r.kind, r.dataset, r.weight) for r in events.edges.collect()}


def test_build_of_companies_and_people(spark):
    subjects = spark.createDataFrame(
        [
            (1, "12345678", "ТОВ «Альфа»", "зареєстровано", ["Іваненко  Іван Іванович - засновник; частка 5", "87654321", "фізична особа", ""], ["Петренко Петро Петрович"]),
            (2, "00000000", "Нулі", None, ["Хтось Хто Хтович"], []),
            (3, "12a", "Не код", None, ["Хтось Хто Хтович"], []),
            (4, "12345678", "Інша назва", None, ["ІВАНЕНКО ІВАН ІВАНОВИЧ"], None),
        ],
        SUBJECT,
    )
    payers = spark.createDataFrame([(1, "123456789012", "Альфа", None, None), (2, "1111111111", "ФОП Бета", "2020", None), (3, "22222222", "Гамма", None, None), (4, "77", "Коротко", None, None)], "seq long, code string, name string, dat_reestr string, dat_term string")
    made = build.build(subjects, payers)
    entities = {(r.type, r.value): r.title for r in made.entities.collect()}
    assert entities == {("edrpou", "12345678"): "ТОВ «Альфа»", ("name", "ІВАНЕНКО ІВАН ІВАНОВИЧ"): "Іваненко  Іван Іванович", ("name", "ПЕТРЕНКО ПЕТРО ПЕТРОВИЧ"): "Петренко Петро Петрович", ("ipn", "1111111111"): "ФОП Бета", ("edrpou", "22222222"): "Гамма"}
    assert triples(made) == {(("edrpou", "12345678"), ("name", "ІВАНЕНКО ІВАН ІВАНОВИЧ"), "founder", "edr", 2), (("edrpou", "12345678"), ("name", "ПЕТРЕНКО ПЕТРО ПЕТРОВИЧ"), "signer", "edr", 1)}
    assert sorted(map(str, ((r.dataset, r.record_ref, r.extra) for r in made.mentions.collect()))) == sorted(map(str, [("edr", "12345678", None), ("edr", "12345678", '{"stan":"зареєстровано"}'), ("vat_payers", "1111111111", '{"dat_reestr":"2020"}'), ("vat_payers", "123456789012", None), ("vat_payers", "22222222", None)]))


def test_build_of_registers_and_decisions(spark):
    subjects = spark.createDataFrame([(1, "12345678", "А", None, [], []), (2, "22222222", "Б", None, [], [])], SUBJECT)
    xml = spark.createDataFrame([(1, "Іваненко Іван", "Нотаріальна контора", "77"), (2, "ФІЗИЧНА ОСОБА", "Контора", None), (3, "", "Контора", None)], "seq long, FIO string, NAME_OBJ string, LICENSE string")
    json_rows = spark.createDataFrame([(1, "Петренко Петро", "12345678", "1111111111", "5"), (2, "Сидоренко Сидір", "99999999", "", None)], "seq long, FIO string, edrpou string, ipn string, regNum string")
    csv_rows = spark.createDataFrame([(1, "Фірма", "Київ")], "seq long, ORGANIZATION string, CITY string")
    people = spark.createDataFrame([(1, "Бондар Іван", "2222222222", "22222222")], "seq long, PIB string, IPN string, EDRPOU string")
    mapped = registers.Register("experts", {"person": ["PIB"], "ipn": ["IPN"], "edrpou": ["EDRPOU"]}, org_edge="works_at")
    generic = lambda name: registers.Register(name, subject="org")
    off = registers.Register("off", {"person": ["PIB"]}, enabled=False)
    decisions = spark.createDataFrame([(1, "1/1", None, "Суддя А.", "Суд", "ТОВ 12345678 і 22222222, 12345678, дата 01012020"), (2, "", "", "Суддя А.", "Суд", None), (3, "3/3", None, None, "Суд", "22222222")], "seq long, case_number string, document_id string, judge string, court string, text string")
    made = build.build(subjects, None, [(xml, generic("notaries"), "xml"), (json_rows, generic("audit"), "json"), (csv_rows, generic("firms"), "csv"), (people, mapped, "csv"), (people, off, "xlsx"), (people, generic("sheet"), "xlsx")], decisions)
    assert triples(made) == {
        (("name", "ІВАНЕНКО ІВАН"), ("name", "НОТАРІАЛЬНА КОНТОРА"), "works_at", "notaries", 1),
        (("edrpou", "12345678"), ("name", "ПЕТРЕНКО ПЕТРО"), "linked", "audit", 1),
        (("ipn", "1111111111"), ("name", "ПЕТРЕНКО ПЕТРО"), "linked", "audit", 1),
        (("ipn", "2222222222"), ("name", "БОНДАР ІВАН"), "identity", "experts", 1),
        (("edrpou", "22222222"), ("ipn", "2222222222"), "works_at", "experts", 1),
        (("name", "СУД"), ("name", "СУДДЯ А."), "judges_in", "edrsr", 2),
        (("edrpou", "12345678"), ("edrpou", "22222222"), "co_litigant", "edrsr", 1),
    }
    mentions = {(r.dataset, r.record_ref, r.name) for r in made.mentions.collect()}
    assert {("notaries", "77", "Іваненко Іван"), ("audit", "5", "Петренко Петро"), ("audit", None, "Сидоренко Сидір"), ("firms", None, None), ("edrsr", "1/1", "Суддя А."), ("edrsr", "3/3", None)} <= mentions
    assert next(r.extra for r in made.mentions.collect() if r.dataset == "firms") == '{"CITY":"Київ"}'
    assert not any(d in ("off", "sheet") for d, _, _ in mentions)


def test_add_people_isolates_registers(spark):
    rows = spark.createDataFrame([(1, "Бондар Іван", "2222222222"), (2, "", "")], "seq long, PIB string, IPN string")
    fields = {"person": ["PIB"], "ipn": ["IPN"]}
    mapping = {"good": registers.Register("good", fields), "off": registers.Register("off", fields, enabled=False), "bad": registers.Register("bad", fields)}

    def broken():
        raise OSError("no such file")

    made, total, failures = build.add_people({"bad": broken, "good": lambda: rows, "off": lambda: rows, "unknown": lambda: rows}, mapping)
    assert total == {"rows": 2, "people": 1, "identities": 1, "org_edges": 0, "failed": 1, "skipped": 2} and failures == [("bad", "OSError: no such file")]
    assert made.entities.count() == 2 and build.add_people({}, mapping)[0] is None


def test_guessed_fields(spark):
    row = lambda **m: (m,)
    data = [
        row(**{"П.І.Б.": "Іваненко Іван", "РНОКПП": "1234567890", "Назва": "ТОВ А", "LICENSE": "5"}),
        row(**{"Прізвище": "Петренко", "a": "12.03.2020", "b": "1234567890", "c": "12345678", "NAME_OBJ": "x"}),
        row(**{"a": "123456780001", "b": "999999990001"}),
        row(**{"FIO": " ", "PERSON": "Хтось", "назва суб'єкта": "y"}),
        row(),
    ]
    rows = spark.createDataFrame(data, "row map<string,string>")
    known = spark.createDataFrame([("12345678",)], "edrpou string")
    got = [tuple(r) for r in guess.canonical_fields(rows, known).select("found.*").collect()]
    assert got == [("Іваненко Іван", "1234567890", "", "ТОВ А", "5"), ("Петренко", "1234567890", "12345678", "", ""), ("", "", "12345678", "", ""), ("Хтось", "", "", "y", ""), ("", "", "", "", "")]
    assert [r.found.edrpou for r in guess.canonical_fields(rows).collect()][2] == "" and guess.inspect(rows, 2).count() == 2
    assert guess.as_maps(spark.createDataFrame([("x", 1)], "a string, b int")).first().row == {"a": "x", "b": "1"}


def test_card(spark):
    entities = spark.createDataFrame([(1, "name", "А", None), (2, "ipn", "22", "Бе"), (3, "name", "В", "Ве"), (4, "name", "Г", None)], "entity_id long, type string, value string, title string")
    edges = spark.createDataFrame([(1, 2, "identity", "d", 1), (1, 3, "linked", "d", 5), (3, 4, "linked", "d", 9), (4, 5, "linked", "d", 99)], "a long, b long, kind string, dataset string, weight long")
    mentions = spark.createDataFrame([(1, "x", "b"), (1, "x", "a"), (1, "y", None), (2, "x", "c")], "entity_id long, dataset string, name string")
    start = spark.createDataFrame([(1,)], "entity_id long")
    got = {(r.section, r.entity_id, r.title, r.dataset, r.n) for r in graph.card(entities, mentions, edges, start, depth=2).collect()}
    assert got == {("alias", 2, "Бе", "d", 1), ("mention", 1, "a", "x", 2), ("mention", 1, None, "y", 1), ("neighbour", 2, "Бе", "d", 1), ("neighbour", 3, "Ве", "d", 5), ("neighbour", 4, "Г", "d", 9)}
    assert graph.card(entities, mentions, edges, start.limit(0)).count() == 0


def test_release_contracts(spark):
    entries = spark.createDataFrame([(0, "a", "0" * 64, 1), (1, "a", "0" * 64, 1), (2, None, "x", -1), (3, "release-manifest.json", "0" * 64, None)], "at int, path string, sha256 string, bytes long")
    assert {r.issue for r in release.manifest_issues(entries).collect()} == {f"manifest file entry {k} {w}" for k, w in ((1, "has a duplicate path"), (2, "has a missing path"), (2, "has an invalid SHA-256"), (2, "has an invalid byte size"), (3, "contains an excluded path"), (3, "has an invalid byte size"))}
    files = spark.createDataFrame([("a", "1", 5), ("b", "2", 6)], "path string, sha256 string, bytes long")
    stated = spark.createDataFrame([("a", "1", 5), ("b", "9", 7), ("c", "3", 1), ("", "3", 1)], "path string, sha256 string, bytes long")
    got = {r.issue for r in release.chain_issues(spark.createDataFrame([("a",), ("z",)], "path string"), files, stated.select("path", "sha256"), stated.where("path != ''")).collect()}
    assert got == {"missing artifact: z", "manifest checksum mismatch: b", "manifest file missing: c", "release manifest contains invalid file entry", "bound artifact checksum mismatch: b", "bound artifact byte-size mismatch: b", "bound artifact missing: c"}
    pair = "pair string, first_git_commit string, second_git_commit string, first_generated_at_utc string, second_generated_at_utc string, first_files string, second_files string"
    pairs = spark.createDataFrame([("x", "1", "1", "t", "t", "f", "g"), ("y", "1", "2", "t", "u", "f", "f"), ("z", "1", "1", "t", "u", "f", "f")], pair)
    assert {(r.pair, r.issue) for r in release.manifest_drift(pairs, ["files"]).collect()} == {("x", "reproducibility drift in files"), ("x", "reproducibility comparison requires distinct generated_at_utc values"), ("y", "reproducibility comparison requires identical git_commit values")}
    document = spark.createDataFrame([(1, "c", {k: "green" for k in release.CONTRACTS if k != "ROLL-01"})], "schema_version int, source_commit string, contracts map<string,string>")
    assert [r.issue for r in release.evidence_issues(document, "c").collect()] == ["hardening contract not green: ROLL-01"]
    assert {r.contract: r.state for r in release.evidence(spark).collect()} == {c: "quarantined" if c == "QUAR-01" else "green" for c in release.CONTRACTS}


def test_authorization(spark):
    fields = "schema_version int, target string, source_commit string, model_id string, artifact_sha256 string, evaluation_evidence_sha256 string, approval_identity string, release_sequence int, approved_at string"
    rows = spark.createDataFrame([(1, "production", "c", "m", "0" * 64, "1" * 64, "me", 1, "2024-01-01T00:00:00Z"), (2, "dev", "d", "", "0", None, None, 0, None)], fields)
    named = rows.withColumn("authorization_id", release.authorization_id(rows, rows.columns))
    assert [len(r.issues) for r in release.authorization_issues(named, "c").collect()] == [0, 9]
    other = named.withColumn("authorization_id", F.lit("f" * 64))
    assert release.authorization_issues(other, "c").first().issues == ["promotion authorization identity checksum mismatch"]


def test_signals(spark):
    row = lambda name, **m: (f"{name}.json", m.get("valid", True), 1, m.get("signal", name), m.get("commit", "c"), m.get("state", "green"), "ok", m.get("at", "2024-06-30T00:00:00Z"))
    rows = [row("ingestion"), row("quality", at="yesterday"), row("graph", at="2024-07-02T00:00:00Z"), row("training", at=None), row("publication", signal="x"), row("security", state=None)]
    signals = spark.createDataFrame(rows, "file string, valid boolean, schema_version long, signal string, source_commit string, state string, detail string, generated_at string")
    states = release.signal_states(signals, "c", F.lit("2024-07-01 00:00:00").cast("timestamp"))
    got = {r.signal: (r.state, r.detail, r.age_hours) for r in states.collect()}
    assert got["ingestion"] == ("green", "ok", 24.0) and got["ci"][0] == "green"
    assert [got[s][1] for s in ("quality", "graph", "training", "publication", "security")] == ["signal has invalid generation timestamp", "signal generation timestamp is in the future", "signal has no generation timestamp", "signal artifact schema is invalid", "signal artifact has an invalid state"]
    assert release.status_index(states).first().overall_state == "red"
    assert {r.name: r.overall for r in release.readiness(spark.createDataFrame([("a", "green"), ("a", None), ("b", "yellow"), ("b", "green"), ("c", "green")], "name string, state string"), ["name"]).collect()} == {"a": "red", "b": "yellow", "c": "green"}
    assert control.PRECEDENCE["unknown"] < control.PRECEDENCE["green"]
