"""Queries of the problems tagged llm, and the SQL for those it can express."""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import components, confusables, garbled, leakage, names, packing, pii, surrogates
from millrace.session import table


def _secret(spark: SparkSession) -> bytes:
    """The key of the surrogates, spark.millrace.secret; without one a new key a session, so that surrogates can't be undone."""
    if not (secret := spark.conf.get("spark.millrace.secret", "")):
        spark.conf.set("spark.millrace.secret", secret := secrets.token_hex(32))
    return secret.encode()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct passages of personal data in each record's text, of all that surrogates replace."""
    records = table(spark, sf_dir, "edrsr_records").select("rec_id", "text")
    edits = surrogates.replacements(records, "rec_id", _secret(spark))
    return edits.where("surrogate != pii_text").select("rec_id", "pii_type", "pii_text").distinct()


def p2_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's text with typed placeholders instead of personal data."""
    return pii.placeholders(table(spark, sf_dir, "edrsr_records").select("rec_id", "text"))


def p2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's text with keyed surrogates instead of personal data."""
    return surrogates.surrogates(table(spark, sf_dir, "edrsr_records").select("rec_id", "text"), "rec_id", _secret(spark))


def p4_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every garbled text or name with its original, null where it is lost."""
    texts = table(spark, sf_dir, "edrsr_records").select(F.lit("edrsr_records.text").alias("field"), F.col("rec_id").alias("row_id"), "text")
    names = table(spark, sf_dir, "mentions").select(F.lit("mentions.name").alias("field"), F.col("mention_id").alias("row_id"), F.col("name").alias("text"))
    return garbled.restored(texts.unionByName(names))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled values with the MD5 of their original."""
    return p4_restored(spark, sf_dir).select("field", "row_id", F.coalesce(F.md5(F.encode("restored", "UTF-8")), F.lit("")).alias("restored_md5"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group id of every entity that an identity edge joins to a different one."""
    identity = table(spark, sf_dir, "edges").where(F.lower(F.regexp_replace("kind", r"(?U)^\s+|\s+$", "")) == "identity")
    return components.connected_components(identity.select("a", "b"), "a", "b").select(F.col("id").alias("entity_id"), "group_id")


def p7_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every named entity with the group of entities that are the same by their written names."""
    entities = table(spark, sf_dir, "entities")
    written = entities.where("type = 'name'").select("entity_id", F.col("value").alias("name")).unionByName(entities.select("entity_id", F.col("title").alias("name")))
    mentioned = table(spark, sf_dir, "mentions").select("entity_id", "name").where("name is not null").distinct().join(entities.select("entity_id"), "entity_id", "left_semi")
    return names.link(written.unionByName(mentioned))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of entities that are the same person or organisation by their written names."""
    return names.pairs(p7_groups(spark, sf_dir))


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a container of 2,048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are."""
    return packing.fill(p8_packed(spark, sf_dir))


def p9_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character spans of documents that hold an evaluation item, wholly or partly."""
    return leakage.leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which evaluation items leaked into which documents."""
    return p9_spans(spark, sf_dir).select("doc_id", "item_id").distinct()


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents stored differently that look the same throughout."""
    return confusables.same_text(table(spark, sf_dir, "documents"))


def p10_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the representative, the size and the number of texts of those that look like it."""
    return confusables.same_groups(table(spark, sf_dir, "documents"))


def p10_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text in its one form."""
    return confusables.canonical(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p2_found, p2_placeholders, p2_surrogates, p4_found, p4_restored, p5_found, p7_found, p7_groups, p8_packed, p8_fill, p9_found, p9_spans, p10_found, p10_groups, p10_normalized)}


# The look-alike classes as plain SQL, written down apart from the operator's tables so that each checks the other.
# Letters of Cyrillic and Greek, and the Latin ones they look like.
_LIKE = ("асеіјорѕхуһԛԁԝАВСЕНІЈКМОРЅТХҮԚԜοΑΒΕΗΙΚΜΝΟΡΤΥΧΖїёЇЁѐЀ", "aceijopsxyhqdwABCEHIJKMOPSTXYQWoABEHIKMNOPTYXZïëÏËèÈ")
# Invisible characters and blanks, as classes of a pattern; variants of apostrophe and hyphen.
_INVISIBLE = r"[\x{ad}\x{34f}\x{61c}\x{180b}-\x{180e}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{2064}\x{fe00}-\x{fe0f}\x{feff}]"
_BLANK = r"[\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
_WIDE = "array_to_string(list_transform(range(65281, 65375), lambda c: chr(c::INT)), '')"
_PLAIN = "array_to_string(list_transform(range(33, 127), lambda c: chr(c::INT)), '')"
_BARE = f"translate(text, {_WIDE}, {_PLAIN})"
for _class, _sign in ((_INVISIBLE, "''"), (_BLANK, "' '"), ("[‘’‛ʼʹʻʽˈ՚′´`＇ꞌ]", "chr(39)"), ("[‐‑‒−﹣－˗]", "'-'")):
    _BARE = f"regexp_replace({_BARE}, '{_class}', {_sign}, 'g')"
_FORM = f"nfc_normalize(translate(nfc_normalize(translate({_BARE}, '{_LIKE[0]}', '{_LIKE[1]}')), '{_LIKE[0]}', '{_LIKE[1]}'))"

SQL = {
    "p10_found": f"""
WITH f AS (SELECT doc_id, text, {_FORM} AS form FROM documents WHERE text IS NOT NULL)
SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM f a JOIN f b ON a.form = b.form AND a.text <> b.text AND a.doc_id < b.doc_id""",
    "p10_groups": f"""
WITH f AS (SELECT doc_id, text, {_FORM} AS form FROM documents WHERE text IS NOT NULL),
g AS (SELECT form, min(doc_id) AS representative, count(*) AS size, count(DISTINCT text) AS texts FROM f GROUP BY 1)
SELECT doc_id, representative, size, texts FROM f JOIN g USING (form)""",
    "p5_found": """
WITH RECURSIVE e AS (
  SELECT a AS u, b AS v FROM edges WHERE lower(trim(kind)) = 'identity' AND a <> b
  UNION SELECT b, a FROM edges WHERE lower(trim(kind)) = 'identity' AND a <> b),
r(u, v) AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT u AS entity_id, least(u, min(v)) AS group_id FROM r GROUP BY u""",
}
