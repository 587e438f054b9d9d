"""Registers of people folded into graph events by a declared mapping of columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators.graph import PERSON_ORG_KINDS
from millrace.operators.records import filled


@dataclass(frozen=True)
class Register:
    """How to read one register: aliases per slot, the kind of its person and organisation edge, extra columns to keep."""

    name: str
    fields: Mapping[str, list] = field(default_factory=dict)
    org_edge: str = "linked"
    extra_fields: tuple[str, ...] = ()
    subject: str = "person"
    enabled: bool = True


@dataclass
class Events:
    """Natural-key events: entities (type, value, title, seq), mentions, and edges between (type, value) pairs."""

    entities: DataFrame
    mentions: DataFrame
    edges: DataFrame


def read_rows(rows: DataFrame, register: Register) -> DataFrame:
    """(seq, person, ipn, edrpou, org, regnum, extra) per row; identifiers only from declared columns.

    Ten digits make a tax number, eight that are no date a company code; sentinel names are blanked. With declared ``id`` and
    ``name`` columns the length of the id tells a person (10) from an organisation (8); other rows are persons by name only.
    ``rows`` needs ``seq`` (order of arrival).
    """
    columns, get = rows.columns, register.fields.get
    slot = lambda name: filled(columns, get(name) or [])
    person = F.concat_ws(" ", *[F.nullif(filled(columns, group), F.lit("")) for group in get("person_parts")]) if get("person_parts") else slot("person")
    ipn, edrpou, org = T.digits(slot("ipn")), T.digits(slot("edrpou")), slot("org")
    if get("id") and get("name"):
        code, cell = T.digits(slot("id")), slot("name")
        is_person, is_org = F.length(code) == 10, (F.length(code) == 8) & ~T.looks_like_date(code)
        person, ipn = F.when(is_org, "").otherwise(cell), F.when(is_person, code).otherwise("")
        edrpou, org = F.when(is_org, code).otherwise(""), F.when(is_org, cell).otherwise("")
    keep = [c for c in register.extra_fields if c in columns]
    extra = F.map_filter(F.create_map(*[x for c in keep for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]), lambda _, v: v.isNotNull() & (v != "")) if keep else F.lit(None).cast("map<string,string>")
    out = rows.select("seq", person.alias("person"), ipn.alias("ipn"), edrpou.alias("edrpou"), org.alias("org"), F.nullif(slot("regnum"), F.lit("")).alias("regnum"), F.when(F.size(extra) > 0, F.to_json(extra)).alias("extra"))
    return out.select(
        "seq",
        F.when(T.normalize_name(F.col("person")).isin(*T.SENTINEL_NAMES), "").otherwise(F.col("person")).alias("person"),
        F.when(F.length("ipn") == 10, F.col("ipn")).otherwise("").alias("ipn"),
        F.when((F.length("edrpou") == 8) & ~T.looks_like_date(F.col("edrpou")), F.col("edrpou")).otherwise("").alias("edrpou"),
        "org", "regnum", "extra",
    )


def _target(row: DataFrame) -> tuple[Column, Column]:
    """Type and value of the organisation a row names, null for none: its code, else its name if that is not the person's own."""
    name = T.normalize_name(F.col("org"))
    named = (F.col("org") != "") & ~name.isin(*T.SENTINEL_NAMES) & (name != T.normalize_name(F.col("person")))
    kind = F.when(F.col("edrpou") != "", "edrpou").when(named, "name")
    return kind, F.when(F.col("edrpou") != "", F.col("edrpou")).when(named, name)


def person_events(rows: DataFrame, register: Register) -> Events:
    """Graph events of one register: names, tax numbers, identity edges, edges to organisations, and mentions of all.

    Rows without a person count only in mixed registers, as mentions of their organisation.
    """
    read = read_rows(rows, register)
    kind, value = _target(read)
    read = read.withColumn("has", (F.col("person") != "") | (F.col("ipn") != "")).withColumn("org_type", kind).withColumn("org_value", value)
    people = read.where("has").withColumn("name", T.normalize_name(F.col("person")))
    entity = lambda df, t, v, title: df.select(t.alias("type"), v.alias("value"), title.alias("title"), "seq")
    mention = lambda df, t, v, name: df.select(t.alias("type"), v.alias("value"), F.lit(register.name).alias("dataset"), F.col("regnum").alias("record_ref"), F.nullif(name, F.lit("")).alias("name"), "extra")
    named, holders = people.where("name != ''"), people.where("ipn != ''")
    entities = entity(named, F.lit("name"), F.col("name"), F.col("person")).unionByName(entity(holders, F.lit("ipn"), F.col("ipn"), F.col("person")))
    mentions = mention(named, F.lit("name"), F.col("name"), F.col("person")).unionByName(mention(holders, F.lit("ipn"), F.col("ipn"), F.col("person")))
    edge = lambda df, at, av, bt, bv, k: df.select(at.alias("a_type"), av.alias("a_value"), bt.alias("b_type"), bv.alias("b_value"), F.lit(k).alias("kind"), F.lit(register.name).alias("dataset"))
    identity = edge(holders.where("name != ''"), F.lit("name"), F.col("name"), F.lit("ipn"), F.col("ipn"), "identity")
    linked = people.where("org_type is not null")
    subject = F.when(F.col("ipn") != "", "ipn").otherwise("name"), F.when(F.col("ipn") != "", F.col("ipn")).otherwise(F.col("name"))
    role = register.org_edge if register.org_edge in PERSON_ORG_KINDS else "linked"
    edges = identity.unionByName(edge(linked, *subject, F.col("org_type"), F.col("org_value"), role))
    entities = entities.unionByName(entity(linked, F.col("org_type"), F.col("org_value"), F.nullif("org", F.lit(""))))
    if register.subject == "mixed":
        orgs = read.where("not has and org_type is not null")
        entities = entities.unionByName(entity(orgs, F.col("org_type"), F.col("org_value"), F.nullif("org", F.lit(""))))
        mentions = mentions.unionByName(mention(orgs, F.col("org_type"), F.col("org_value"), F.col("org")))
    return Events(entities, mentions, edges)


def counters(rows: DataFrame, register: Register) -> DataFrame:
    """One row: rows, people, identities, org_edges, org_subjects of a register."""
    read = read_rows(rows, register)
    kind, _ = _target(read)
    has = (F.col("person") != "") | (F.col("ipn") != "")
    mixed = F.lit(register.subject == "mixed")
    return read.agg(F.count("*").alias("n_rows"), F.count_if(F.col("person") != "").alias("people"), F.count_if(F.col("ipn") != "").alias("identities"), F.count_if(has & kind.isNotNull()).alias("org_edges"), F.count_if(~has & mixed & kind.isNotNull()).alias("org_subjects"))


def match_codes(payers: DataFrame, companies: DataFrame, code: str = "code") -> DataFrame:
    """``payers`` with (type, value): the company whose code starts the number, else a tax number, else a new company code.

    ``companies`` has edrpou. Of a number with 10 digits or more whose first 8 are unknown the first 10 are a tax number; 8 or 9
    digits are a company code; shorter numbers give nulls.
    """
    known = companies.select(F.col("edrpou").alias("__edrpou")).distinct()
    rows = payers.withColumn("__digits", T.digits(F.col(code)))
    joined = rows.join(known, F.substring("__digits", 1, 8) == F.col("__edrpou"), "left")
    length = F.length("__digits")
    kind = F.when(F.col("__edrpou").isNotNull(), "edrpou").when(length >= 10, "ipn").when(length >= 8, "edrpou")
    value = F.when(F.col("__edrpou").isNotNull(), F.col("__edrpou")).when(length >= 10, F.substring("__digits", 1, 10)).when(length >= 8, F.substring("__digits", 1, 8))
    return joined.withColumns({"type": kind, "value": value}).drop("__digits", "__edrpou")
