"""Scalar functions on names, codes, texts and identifiers, as column expressions that stay inside code generation."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that registers print for people who are not identified.
SENTINEL_NAMES = ("НЕВИЗНАЧЕНА ФІЗИЧНА ОСОБА", "НЕВИЗНАЧЕНА ОСОБА", "ФІЗИЧНІ ОСОБИ", "ФІЗИЧНА ОСОБА", "ІНШІ ФІЗИЧНІ ОСОБИ")
# Words that mark a name as that of an organisation.
ORG_KEYWORDS = (
    "ТОВ", "ТОВАРИСТВО", "ПАТ", "ПУБЛІЧНЕ", "ПРИВАТНЕ", "ПП", "АКЦІОНЕРНЕ", "КОМАНДИТНЕ", "ДОДАТКОВА", "КОМПАНІЯ", "КОНЦЕРН", "ХОЛДИНГ",
    "КОРПОРАЦІЯ", "ФІРМА", "БАНК", "УНІВЕРСИТЕТ", "ІНСТИТУТ", "АКАДЕМІЯ", "КОЛЕДЖ", "ШКОЛА", "УПРАВЛІННЯ", "ДЕПАРТАМЕНТ", "МІНІСТЕРСТВО",
    "СЛУЖБА", "РАДА", "СУД", "ПРОКУРАТУРА", "ПОЛІЦІЯ", "КЛІНІЧНЕ", "БЮРО", "ЦЕНТР", "ФОНД", "ЗАВОД", "ФАБРИКА", "КОМБІНАТ", "АСОЦІАЦІЯ",
    "СПІЛКА", "ГРОМАДСЬКЕ", "ОБ'ЄДНАННЯ", "ФІЛІЯ", "ПРЕДСТАВНИЦТВО", "АГЕНТСТВО", "КООПЕРАТИВ", "НАЦІОНАЛЬНИЙ", "ДЕРЖАВНИЙ", "ДЕРЖАВНА",
    "МІСЬКИЙ", "РАЙОННИЙ", "ОБЛАСНИЙ", "УКРАЇНИ", "КИЇВСЬКИЙ", "КИЇВСЬКА", "НОТАРІАЛЬНА", "КОНТОРА", "АПЕЛЯЦІЙНИЙ", "АДМІНІСТРАТИВНИЙ",
    "ГОСПОДАРСЬКИЙ", "ВИЩИЙ", "ОКРУЖНИЙ", "КАСАЦІЙНИЙ", "ВЕРХОВНИЙ", "КРИМІНАЛЬНИЙ", "ЦИВІЛЬНИЙ", "ЕКСПЕРТНЕ", "УСТАНОВА", "ЗАКЛАД",
    "ОРГАНІЗАЦІЯ", "ГРОМАДСЬКА",
)
# Fixed value: endings of a patronymic.
PATRONYMIC = r"(ОВИЧ|ЄВИЧ|ІВНА|ЇВНА|ІВИЧ|ОВНА|ИЧ|ВИЧ|ВНА)$"
# Formats of resources that hold records.
STRUCTURED_FORMATS = ("CSV", "TSV", "JSON", "JSONL", "NDJSON", "XML", "XLS", "XLSX", "ODS", "PARQUET", "ZIP", "7Z", "GZ", "GZIP")


def collapse(text: Column) -> Column:
    """Runs of any Unicode blanks as one space, none outside."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first value that is not blank, else the empty string."""
    return F.coalesce(*[blank_to_null(c) for c in columns], F.lit(""))


def normalize_name(name: Column) -> Column:
    """Upper case, one kind of apostrophe, single blanks; null as ''."""
    return F.upper(collapse(F.translate(F.coalesce(name, F.lit("")), "ʼ’", "''")))


def digits(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"\D", "")


def looks_like_date(code: Column) -> Column:
    """Whether eight digits read as DDMMYYYY; anything else is false."""
    part = lambda at, n: F.substring(code, at, n).try_cast("int")
    return F.coalesce((F.length(code) == 8) & part(1, 2).between(1, 31) & part(3, 2).between(1, 12) & part(5, 4).between(1900, 2035), F.lit(False))


def company_codes(text: Column) -> Column:
    """Distinct runs of exactly eight digits that are no date, in order of appearance."""
    return F.array_distinct(F.filter(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?<!\d)(\d{8})(?!\d)"), 1), lambda c: ~looks_like_date(c)))


def role_name(text: Column) -> Column:
    """The name of 'name - role; share'."""
    return F.btrim(F.substring_index(F.split(text, "[;|]")[0], " - ", 1), F.lit(" ,;:"))


def role_of(text: Column) -> Column:
    """The role of 'name - role', '' if there is none or it starts with a digit."""
    tail = F.trim(F.when(F.instr(text, " - ") > 0, F.substring(text, F.instr(text, " - ") + 3, F.length(text))))
    return F.when(F.coalesce(tail, F.lit("")).rlike(r"^\d"), "").otherwise(F.coalesce(tail, F.lit("")))


def header(name: Column) -> Column:
    """A column heading without blanks and punctuation, upper case."""
    return F.regexp_replace(F.upper(F.coalesce(name, F.lit(""))), "[\\s_\\-'/ʼ’().,\"]", "")


def name_tokens(name: Column) -> Column:
    return F.regexp_extract_all(F.upper(F.translate(F.coalesce(name, F.lit("")), "'ʼ’`", "")), F.lit("[A-ZА-ЯЄІЇҐ]+"), 0)


def is_name_candidate(name: Column) -> Column:
    """The shape of a person's name: two to four words, none of an organisation, no digit, no sentinel."""
    tokens = name_tokens(name)
    plain = F.upper(F.translate(F.coalesce(name, F.lit("")), "'ʼ’`", ""))
    words = F.array(*[F.lit(w) for w in ORG_KEYWORDS])
    return F.size(tokens).between(2, 4) & ~F.arrays_overlap(tokens, words) & ~plain.rlike(r"\d") & ~plain.isin(*SENTINEL_NAMES)


def is_person_name(name: Column) -> Column:
    """As a candidate, and three words must end in a patronymic; sentinels are not looked at."""
    tokens = name_tokens(name)
    plain = F.upper(F.translate(F.coalesce(name, F.lit("")), "'ʼ’`", ""))
    words = F.array(*[F.lit(w) for w in ORG_KEYWORDS])
    return F.size(tokens).between(2, 4) & ~F.arrays_overlap(tokens, words) & ~plain.rlike(r"\d") & ((F.size(tokens) != 3) | F.element_at(tokens, -1).rlike(PATRONYMIC))


def _agreement(a: Column, b: Column) -> Column:
    """1.0 for equal words, 0.9 for a word and its initial, else null."""
    one = lambda x: F.length(x) == 1
    return F.when(a == b, 1.0).when(one(a) & ~one(b) & (a == F.substring(b, 1, 1)), 0.9).when(one(b) & ~one(a) & (b == F.substring(a, 1, 1)), 0.9)


def name_score(x: Column, y: Column) -> Column:
    """How well two token arrays (surname first) agree, at most 1.0; null where they can't be one person."""
    given = _agreement(F.get(x, F.lit(1)), F.get(y, F.lit(1)))
    patronymic = _agreement(F.get(x, F.lit(2)), F.get(y, F.lit(2)))
    score = weighed(given, patronymic, F.size(x) > 2, F.size(y) > 2)
    return F.when((F.size(x) >= 2) & (F.size(y) >= 2) & (F.get(x, F.lit(0)) == F.get(y, F.lit(0))) & score.isNotNull(), F.least(score, F.lit(1.0)))


def weighed(given: Column, patronymic: Column, x: Column, y: Column) -> Column:
    """The score of names with equal surnames, by how their given names and patronymics agree; ``x``, ``y``: whether each has a patronymic."""
    base = F.lit(0.5) + F.lit(0.35) * given
    return F.when(x & y, base + F.lit(0.15) * patronymic).when(x | y, base + F.lit(0.05)).otherwise(base)


def agreeing(word: Column) -> tuple[Column, Column]:
    """(filed, looked up) for a word: it agrees with another where what one is filed under, the other looks up, and that once.

    Both are arrays; ``filed`` of what a word is filed under, ``looked up`` of structs of it and how well the words agree then.
    A word meets its equals; an initial, filed as it stands, also meets all longer words, filed with a point under their first letter.
    """
    first, short = F.substring(word, 1, 1), F.length(word) == 1
    filed = F.when(short, F.array(word)).otherwise(F.array(word, F.concat(first, F.lit("."))))
    entry = lambda key, agreement: F.struct(key.alias("key"), F.lit(agreement).alias("agreement"))
    return filed, F.array(entry(word, 1.0), F.when(short, entry(F.concat(word, F.lit(".")), 0.9)).otherwise(entry(first, 0.9)))


def html_to_text(page: Column) -> Column:
    """Text of a page: scripts and styles away, tags as blanks, blanks collapsed, then the common entities."""
    bare = F.regexp_replace(page, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    text = collapse(F.regexp_replace(bare, r"(?s)<[^>]+>", " "))
    # Character entities; the ampersand comes last.
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&laquo;", "«"), ("&raquo;", "»"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def html_escape(text: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    return text


def clean_line(text: Column, least: int = 20, most: int = 600) -> Column:
    """The collapsed line if its length is within bounds, else ''."""
    line = collapse(text)
    return F.when(F.length(line).between(least, most), line).otherwise("")


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))


def has_extension(url: Column, extensions: Sequence[str]) -> Column:
    """Whether an address ends in one of the extensions, without its query."""
    return F.coalesce(F.lower(F.substring_index(url, "?", 1)).rlike(r"(?:" + "|".join(map(re.escape, extensions)) + r")$"), F.lit(False))


def slug(name: Column, most: int = 80) -> Column:
    made = F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.coalesce(F.nullif(F.substring(made, 1, most), F.lit("")), F.lit("unnamed"))


def safe_file_name(name: Column, most_bytes: int = 180) -> Column:
    """A base name of Latin and Ukrainian letters, digits and ._-, other runs as one underscore, ``resource`` for none.

    Beyond ``most_bytes`` UTF-8 bytes the stem is cut to the most characters that fit, marked by the whole name's hash, and keeps its extension.
    """
    plain = F.coalesce(F.nullif(F.btrim(F.regexp_replace(F.coalesce(name, F.lit("")), r"[^0-9A-Za-zА-Яа-яІіЇїЄєҐґ._-]+", "_"), F.lit("._")), F.lit("")), F.lit("resource"))
    suffix = F.regexp_extract(plain, r"(?<=.)(\.[^.]+)$", 1)
    stem = F.substring(plain, F.lit(1), F.length(plain) - F.length(suffix))
    room = F.greatest(F.lit(16), F.lit(most_bytes - 13) - F.octet_length(suffix))
    longest = F.array_max(F.filter(F.sequence(F.lit(0), F.lit(most_bytes)), lambda n: F.octet_length(F.substring(stem, F.lit(1), n)) <= room))
    return F.when(F.octet_length(plain) <= most_bytes, plain).otherwise(F.concat(F.substring(stem, F.lit(1), longest), F.lit("_"), F.substring(F.sha2(plain, 256), 1, 12), suffix))


def checkpoint_id(*parts: Column) -> Column:
    """SHA-256 of the parts joined by NUL."""
    return F.sha2(F.concat_ws("\x00", *parts), 256)


def is_sha256(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9a-fA-F]{64}$"), F.lit(False))


def is_commit(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9a-f]{40}$"), F.lit(False))


def is_utc_timestamp(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]00:?00)$") & text.try_cast("timestamp").isNotNull(), F.lit(False))


def failure_kind(error: Column, status: Column) -> Column:
    """Whether a failed fetch is the source's fault or the resource's."""
    return F.when(error.isin("connection", "timeout"), "source_unavailable").when((status == 429) | status.between(500, 599), "source_throttled").otherwise("resource_error")


def retry_wait(after: Column, attempt: Column, most: int = 60) -> Column:
    """Seconds to wait: the server's wish or doubling, within 0 and ``most``."""
    wish = F.coalesce(after.cast("double"), F.pow(F.lit(2.0), attempt))
    return F.least(F.lit(float(most)), F.greatest(F.lit(0.0), wish))


def perplexity(loss: Column) -> Column:
    return F.exp(F.least(loss, F.lit(20.0)))


def learning_rate(step: Column, top: float, warmup: int, total: int, floor: float = 0.1) -> Column:
    """Linear warm-up, then a half cosine down to ``floor`` of the top."""
    done = F.least(F.lit(1.0), (step - F.lit(warmup)) / F.lit(float(max(1, total - warmup))))
    return F.when(step < warmup, F.lit(top) * (step + 1) / F.lit(float(warmup))).otherwise(F.lit(top) * (F.lit(floor) + F.lit(1 - floor) * F.lit(0.5) * (F.lit(1.0) + F.cos(done * F.pi()))))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
