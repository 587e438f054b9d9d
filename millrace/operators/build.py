"""The entity graph built from its sources: companies, payers, registers and decisions as events, folded once.

Every source gives entity, mention and edge events by natural key; nothing depends on the order sources are read in, but titles:
the first non-empty one by source and row. Ids are attached when the events are folded.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import registers
from millrace.operators.graph import entity_id
from millrace.operators.registers import Events, Register

#: Room for the rows of one source in the order of events.
SEQ_STEP = 1 << 48
# Columns that hold a person's or an organisation's name in registers without a mapping.
PERSON_COLUMNS = ("FIO", "PIB", "NAME_PERSON", "FULLNAME", "SECONDNAME", "AK_NAME")
ORG_COLUMNS = ("NAME_OBJ", "ORGANIZATION", "NAME", "SUBJECT_NAME", "AUDITOR_FIRM")


def register_fields(columns: Sequence[str]) -> tuple[str | None, str | None]:
    """The first columns that hold a person's and an organisation's name, by their upper-case names."""
    find = lambda names: next((c for c in columns if c.upper() in names), None)
    return find(PERSON_COLUMNS), find(ORG_COLUMNS)


def _text(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def _entities(rows: DataFrame, kind: str | Column, value: Column, title: Column) -> DataFrame:
    return rows.select((F.lit(kind) if isinstance(kind, str) else kind).alias("type"), value.alias("value"), F.nullif(title, F.lit("")).alias("title"), "seq").where("value is not null and value != ''")


def _mentions(rows: DataFrame, kind: str | Column, value: Column, dataset: str, ref: Column, name: Column, extra: Column | None = None) -> DataFrame:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    extra = F.lit(None).cast("string") if extra is None else extra
    return rows.select(kind.alias("type"), value.alias("value"), F.lit(dataset).alias("dataset"), F.nullif(ref.cast("string"), F.lit("")).alias("record_ref"), F.nullif(name, F.lit("")).alias("name"), extra.alias("extra"))


def _edges(rows: DataFrame, a: tuple[str | Column, Column], b: tuple[str | Column, Column], kind: str | Column, dataset: str) -> DataFrame:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return rows.select(as_column(a[0]).alias("a_type"), a[1].alias("a_value"), as_column(b[0]).alias("b_type"), b[1].alias("b_value"), as_column(kind).alias("kind"), F.lit(dataset).alias("dataset"))


def _json(columns: Mapping[str, Column]) -> Column:
    """Filled values as a JSON object, null if there are none."""
    values = F.map_filter(F.create_map(*[x for k, v in columns.items() for x in (F.lit(k), v.cast("string"))]), lambda _, v: v.isNotNull() & (v != ""))
    return F.when(F.size(values) > 0, F.to_json(values))


def spine(subjects: DataFrame) -> DataFrame:
    """Subjects whose company code is all digits and not all zeros; its length does not matter."""
    return subjects.where(F.col("edrpou").rlike("^[0-9]+$") & ~F.col("edrpou").rlike("^0+$"))


def company_events(subjects: DataFrame, dataset: str = "edr") -> Events:
    """Companies with a mention each, and edges from founders and signers, who get no mention.

    ``subjects``: seq, edrpou, name, stan, founders, signers (arrays of 'name - role; share' lines). Names that are empty, bare
    company codes or sentinels are left out.
    """
    rows = spine(subjects)
    companies = _entities(rows, "edrpou", F.col("edrpou"), F.coalesce("name", F.lit("")))
    mentions = _mentions(rows, "edrpou", F.col("edrpou"), dataset, F.col("edrpou"), F.coalesce("name", F.lit("")), _json({"stan": F.col("stan")}))
    people = []
    for kind, column in (("founder", "founders"), ("signer", "signers")):
        lines = rows.select("seq", "edrpou", F.explode(column).alias("line")).select("seq", "edrpou", T.role_name(F.col("line")).alias("who"), F.lit(kind).alias("kind"))
        people.append(lines.where((F.col("who") != "") & ~F.col("who").rlike(r"^\d{8}$") & ~T.normalize_name(F.col("who")).isin(*T.SENTINEL_NAMES)))
    people = people[0].unionByName(people[1])
    name = T.normalize_name(F.col("who"))
    return Events(companies.unionByName(_entities(people, "name", name, F.col("who"))), mentions, _edges(people, ("name", name), ("edrpou", F.col("edrpou")), F.col("kind"), dataset))


def payer_events(payers: DataFrame, companies: DataFrame, dataset: str = "vat_payers") -> Events:
    """Payers (seq, code, name, dat_reestr, dat_term) as companies or tax numbers, each with a mention; see ``registers.match_codes``.

    ``companies`` has edrpou. A company that is known keeps its title.
    """
    rows = registers.match_codes(payers, companies).where("value is not null")
    known = rows.join(companies.select(F.col("edrpou").alias("value")).distinct(), "value", "left_anti").where("type = 'edrpou'").unionByName(rows.where("type = 'ipn'").select("value", *[c for c in rows.columns if c != "value"]))
    name = F.coalesce("name", F.lit(""))
    return Events(_entities(known, F.col("type"), F.col("value"), name), _mentions(rows, F.col("type"), F.col("value"), dataset, T.digits(F.col("code")), name, _json({"dat_reestr": F.col("dat_reestr"), "dat_term": F.col("dat_term")})), _no_edges(rows))


def _no_edges(rows: DataFrame) -> DataFrame:
    none = F.lit("")
    return _edges(rows.limit(0), (none, none), (none, none), none, "")


def generic_events(rows: DataFrame, dataset: str, companies: DataFrame | None = None, form: str = "xml") -> Events:
    """Events of a register without a mapping, whose name columns are found by ``register_fields``; ``rows`` needs seq.

    xml: persons with a mention (REG_NUM or LICENSE as reference; sentinels left out), organisations by name, works_at edges.
    csv: the person, or the organisation of a register without persons, with a mention that keeps the other columns.
    json: persons with a mention (regNum), linked to the known companies and tax numbers under edrpou, ipn and id.
    """
    columns = [c for c in rows.columns if c != "seq"]
    person, org = register_fields(columns)
    none = F.lit("")
    who = F.trim(_text(person)) if person else none
    firm = F.trim(_text(org)) if org else none
    name, firm_name = T.normalize_name(who), T.normalize_name(firm)
    if form == "xml":
        people = rows.where((who != "") & ~name.isin(*T.SENTINEL_NAMES))
        refs = [_text(c) for c in ("REG_NUM", "LICENSE") if c in columns]
        ref = T.first_filled(*refs) if refs else none
        entities = _entities(people, "name", name, who).unionByName(_entities(rows.where(firm != ""), "name", firm_name, firm))
        return Events(entities, _mentions(people, "name", name, dataset, ref, who), _edges(people.where(firm != ""), ("name", name), ("name", firm_name), "works_at", dataset))
    if form == "csv":
        named = rows.withColumn("__who", F.when(who != "", who).otherwise(firm)).where("__who != ''")
        value = T.normalize_name(F.col("__who"))
        rest = {c: F.col(f"`{c}`") for c in columns if c not in (person, org)}
        return Events(_entities(named, "name", value, F.col("__who")), _mentions(named, "name", value, dataset, none, none, _json(rest) if rest else None), _no_edges(rows))
    people = rows.where(who != "")
    keys = [c for c in ("edrpou", "ipn", "id") if c in columns]
    entities = _entities(people, "name", name, who)
    kept = {c: F.col(c) for c in ("edrpou", "ipn", "regNum", "id") if c in columns}
    mentions = _mentions(people, "name", name, dataset, _text("regNum") if "regNum" in columns else none, who, _json(kept) if kept else None)
    if not keys or companies is None:
        return Events(entities, mentions, _no_edges(rows))
    codes = people.select("seq", name.alias("name"), F.explode(F.array(*[T.digits(_text(k)) for k in keys])).alias("code"))
    firms = codes.where(F.length("code") == 8).join(companies.select(F.col("edrpou").alias("code")).distinct(), "code", "left_semi")
    numbers = codes.where(F.length("code") == 10)
    edges = _edges(firms, ("name", F.col("name")), ("edrpou", F.col("code")), "linked", dataset).unionByName(_edges(numbers, ("name", F.col("name")), ("ipn", F.col("code")), "linked", dataset))
    return Events(entities.unionByName(_entities(numbers, "ipn", F.col("code"), none)), mentions, edges)


def decision_events(decisions: DataFrame, companies: DataFrame, dataset: str = "edrsr") -> Events:
    """Events of decisions (seq, case_number, document_id, judge, court, text): judges_in edges and company co-mentions.

    A judge has a mention where the decision has a number; a court has none. Known company codes in the text are mentioned, and each
    two of one decision are co_litigant.
    """
    ref = F.coalesce(F.nullif("case_number", F.lit("")), F.nullif("document_id", F.lit("")), F.lit(""))
    rows = decisions.withColumns({"__ref": ref, "__judge": F.coalesce(T.blank_to_null(F.col("judge")), F.lit("")), "__court": F.coalesce(T.blank_to_null(F.col("court")), F.lit(""))})
    both = rows.where("__judge != '' and __court != ''")
    judge, court = T.normalize_name(F.col("__judge")), T.normalize_name(F.col("__court"))
    entities = _entities(both, "name", judge, F.col("__judge")).unionByName(_entities(both, "name", court, F.col("__court")))
    mentions = _mentions(both.where("__ref != ''"), "name", judge, dataset, F.col("__ref"), F.col("__judge"), F.to_json(F.struct(F.col("__court").alias("court"))))
    edges = _edges(both, ("name", judge), ("name", court), "judges_in", dataset)
    known = companies.select(F.col("edrpou").alias("code")).distinct()
    named = rows.select("seq", "__ref", F.explode(T.company_codes(F.col("text"))).alias("code")).join(known, "code", "left_semi")
    pairs = named.select("seq", F.col("code").alias("a")).join(named.select("seq", F.col("code").alias("b")), "seq").where("a < b")
    return Events(entities, mentions.unionByName(_mentions(named, "edrpou", F.col("code"), dataset, F.col("__ref"), F.lit(""))), edges.unionByName(_edges(pairs, ("edrpou", F.col("a")), ("edrpou", F.col("b")), "co_litigant", dataset)))


def fold(parts: Sequence[Events]) -> Events:
    """(entity_id, type, value, title), (entity_id, dataset, record_ref, name, extra) and (a, b, kind, dataset, weight) of all events.

    Titles come by the order of ``parts``, then of rows. Ends of edges are in order of their ids, self edges are dropped, repeats counted.
    """
    join = lambda frames: reduce(DataFrame.unionByName, frames)
    seen = join([p.entities.withColumn("seq", F.col("seq") + F.lit(k * SEQ_STEP)) for k, p in enumerate(parts)])
    title = F.min(F.when(F.col("title").isNotNull(), F.struct("seq", "title")))["title"]
    entities = seen.groupBy("type", "value").agg(title.alias("title")).select(entity_id(F.col("type"), F.col("value")).alias("entity_id"), "type", "value", "title")
    mentions = join([p.mentions for p in parts]).select(entity_id(F.col("type"), F.col("value")).alias("entity_id"), "dataset", "record_ref", "name", "extra")
    ends = join([p.edges for p in parts]).select(entity_id(F.col("a_type"), F.col("a_value")).alias("x"), entity_id(F.col("b_type"), F.col("b_value")).alias("y"), "kind", "dataset").where("x != y")
    edges = ends.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "kind", "dataset").agg(F.count("*").alias("weight"))
    return Events(entities, mentions, edges)


def register_events(rows: DataFrame, register: Register, companies: DataFrame, form: str = "xml") -> Events:
    """A declared register of persons by its mapping, any other generically."""
    return registers.person_events(rows, register) if register.subject in ("person", "mixed") else generic_events(rows, register.name, companies, form)


def build(subjects: DataFrame | None = None, payers: DataFrame | None = None, people: Sequence[tuple[DataFrame, Register, str]] = (), decisions: DataFrame | None = None, companies: DataFrame | None = None) -> Events:
    """The graph of all sources given: companies, payers, registers as (rows, register, form), decisions.

    Spreadsheets and archives (form xlsx or zipcsv) count only with a declared register of persons that is enabled. ``companies``
    (edrpou) stands in for the codes of ``subjects`` where there are none, as in an extension of an earlier graph.
    """
    known = spine(subjects).select("edrpou").distinct() if subjects is not None else companies
    parts = [company_events(subjects)] if subjects is not None else []
    if payers is not None:
        parts.append(payer_events(payers, known))
    for rows, register, form in people:
        if form in ("xlsx", "zipcsv") and not (register.enabled and register.subject in ("person", "mixed")):
            continue
        parts.append(register_events(rows, register, known, form))
    if decisions is not None:
        parts.append(decision_events(decisions, known))
    return fold(parts)


def add_people(sources: Mapping[str, Callable[[], DataFrame]], mapping: Mapping[str, Register]) -> tuple[Events | None, dict[str, int], list[tuple[str, str]]]:
    """Events of all registers that can be read, their totals, and (register, error) of those that can't.

    ``sources`` opens each register's rows (with seq). A register without a mapping of persons or not enabled is skipped; one that
    fails, when it is opened or read, fails alone. Counting reads a register once, which is also what finds broken files early.
    """
    total = {"rows": 0, "people": 0, "identities": 0, "org_edges": 0, "failed": 0, "skipped": 0}
    parts, failures = [], []
    for name, open_ in sources.items():
        register = mapping.get(name)
        if register is None or register.subject not in ("person", "mixed") or not register.enabled:
            total["skipped"] += 1
            continue
        try:
            rows = open_()
            counts = registers.counters(rows, register).first()
            parts.append(registers.person_events(rows, register))
        except Exception as error:  # noqa: BLE001 - whatever is wrong with one source must not stop the others
            total["failed"] += 1
            failures.append((name, f"{type(error).__name__}: {error}".splitlines()[0]))
            continue
        for ours, theirs in (("rows", "n_rows"), ("people", "people"), ("identities", "identities"), ("org_edges", "org_edges")):
            total[ours] += counts[theirs]
    return (fold(parts) if parts else None), total, failures
