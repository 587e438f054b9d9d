"""Personal data in free text, found and replaced by typed placeholders; ``surrogates`` replaces it by keyed surrogates.

Addresses, mail addresses, phone and identity numbers are anchored patterns. Names are capitalised words next to a patronymic,
to initials, or to a given name; the given names are counted in the corpus itself (words written between a surname and a
patronymic). One pass over the texts writes down what may be personal data, whatever the given names; another over these
candidates, not the texts, decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import ship, stored

#: A given name stands before a patronymic in this share of all such places at least, and twice; so at most 1 / share are kept.
GIVEN_SHARE = 2e-5
_UP, _LOW = "А-ЯЄІЇҐ", "а-яєіїґ"
_CAP = rf"[{_UP}](?:['’ʼ][{_LOW}]+|[{_LOW}]+(?:['’ʼ][{_LOW}]+)?)(?:-[{_UP}][{_LOW}'’ʼ]+)?"
_ALL = rf"[{_UP}][{_UP}'’ʼ-]+"
_LAT = r"[A-Z][a-z]+(?:['’-][A-Za-z]+)?|[A-Z][A-Z'’-]+"
_WORD = rf"(?:{_CAP}|{_ALL}|{_LAT})"
_GAP = "[  ]+"
EMAIL = re.compile(r"[A-Za-z0-9][\w.+-]*(?:@|\s?[\[({](?:at|AT|At|собака|СОБАКА|ат|АТ)[\])}]\s?)[A-Za-z0-9][A-Za-z0-9-]*(?:(?:\.|\s?[\[({](?:dot|DOT)[\])}]\s?)[A-Za-z0-9-]*[A-Za-z0-9])+", re.ASCII)
PHONE = re.compile(r"(?=[+038(])(?<![\d№/.,-])(?<!№ )(?:\+?38[ .-]?\(?0\d{2}\)?|\+?380[ .-]?\(?\d{2}\)?|(?:8[ .-])?\(?0\d{2}\)?)[ .-]?\d{3}[ .-]?\d{2}[ .-]?\d{2}(?![\d/])(?!-\d)")
IDNUM = [
    re.compile(r"(?i:(?:ідентифікаційн|податков)\w+ (?:номер|код)\w*|РНОКПП|ІПН|код\w* платника(?: податк\w+)?)[:\s№]*(\d{10}|\d{3} \d{3} \d{4})(?!\d| \d)"),
    re.compile(rf"(?i:паспорт\w*)(?: (?i:громадян\w+ України))?(?:,? (?i:серії|серія))?[:\s]*([{_UP}]{{2}} ?№? ?\d{{6}})(?!\d)"),
    re.compile(r"(?i:паспорт\w*-картк\w+|ID-картк\w+|паспорт\w*)[:\s]*№? ?(\d{9})(?!\d)"),
    re.compile(r"(?<!\d)(\d{8}-\d{5})(?!\d)"),
]
_PLACE = rf"[{_UP}][{_LOW}'’ʼ-]+(?:{_GAP}[{_UP}][{_LOW}'’ʼ-]+)*"
_STREET = rf"(?:вул\.|вулиц[яіюею]+|просп\.|пр-т|проспект\w*|бульв\.|бульвар\w*|пров\.|провул\w+|пл\.|площ[аіуею]+|шосе|наб\.|набережн\w+|майдан\w*|проїзд\w*|туп\.|тупик\w*|узв\.|узв[оі]з\w*|але[яїюєю]+)\s*(?:\d+{_GAP})?{_PLACE}"
_FLAT = r"(?:кв\.?|квартир\w+|оф\.?|офіс\w*)\s*\d+"
ADDRESS = re.compile(rf"(?:(?<!\d)\d{{5}},\s*)?(?:(?<![{_LOW}{_UP}])(?:м\.|місто|с\.|село|смт\.?|селище|с-ще)\s*{_PLACE},\s*)?{_STREET},?\s*(?:(?:буд\.|будин\w+|б\.)\s*)?\d+(?:/\d+|-?[{_UP}{_LOW}](?![{_LOW}{_UP}])|{_GAP}[{_UP}{_LOW}](?=,\s*{_FLAT}))?(?:,?\s*(?:корп\.|корпус\w*)\s*\d+)?(?:,\s*{_FLAT})?")
STREET = re.compile(_STREET)
_PATRONYMIC = rf"(?:[{_UP}][{_LOW}'’ʼ]+(?:ович|евич|лліч|ьич)(?:а|у|ем|еві|ові|і)?|[{_UP}][{_LOW}'’ʼ]+(?:івн|ївн|овн|евн|ичн)(?:а|и|і|у|ою)|[{_UP}'’ʼ]+(?:ОВИЧ|ЕВИЧ|ЛЛІЧ)(?:А|У|ЕМ|ЕВІ|ОВІ|І)?|[{_UP}'’ʼ]+(?:ІВН|ЇВН|ОВН|ИЧН)(?:А|И|І|У|ОЮ)|[A-Z][a-z]+(?:ovych|iovych|evych|ivna|yivna|iivna)|[A-Z]+(?:OVYCH|EVYCH|IVNA))(?![{_LOW}{_UP}a-z])"
PATRONYMIC = re.compile(_PATRONYMIC)
_START = rf"(?<![{_UP}{_LOW}A-Za-z'’ʼ_-])"
FULL = re.compile(rf"{_START}(?:({_WORD}){_GAP})?({_WORD}){_GAP}({_PATRONYMIC})(?:{_GAP}({_WORD})(?![{_LOW}]))?")
INITIALS = re.compile(rf"{_START}(?:({_WORD}){_GAP}(?:[{_UP}A-Z]\.\s?[{_UP}A-Z]\.)|(?:[{_UP}A-Z]\.\s?[{_UP}A-Z]\.)\s?({_WORD}))")
ONE = re.compile(rf"{_START}({_WORD}){_GAP}[{_UP}A-Z]\.(?![{_UP}{_LOW}A-Za-z]|\s?[{_UP}A-Z]\.)")
PAIR = re.compile(rf"(?={_START}({_WORD}){_GAP}({_WORD})(?![{_LOW}a-z'’ʼ-]))")
TYPES = ("EMAIL", "PHONE", "IDNUM", "ADDRESS", "NAME")
# Words of role or title that start a sentence before a name.
ROLES = frozenset("заявник заявниця позивач позивачка відповідач відповідачка боржник боржниця боржником стягувач скаржник апелянт суддя свідок свідками представник громадянин громадянка гр експерт директор секретар прокурор адвокат нотаріус обвинувачений потерпілий третя особа пан пані".split())
# Given names of Polish and English texts.
FOREIGN_GIVEN = frozenset("jan anna piotr maria krzysztof andrzej tomasz stanisław stanislaw marek michał michal grzegorz józef jozef jerzy tadeusz adam łukasz lukasz zbigniew ryszard kazimierz katarzyna małgorzata malgorzata agnieszka krystyna barbara ewa elżbieta elzbieta zofia teresa magdalena joanna janina monika danuta jadwiga aleksandra john james robert william mary patricia jennifer elizabeth".split())
# Cyrillic letters in Latin by the national table.
LATIN_OF = dict(zip("абвгґдеєжзиіїйклмнопрстуфхцчшщьюя'’ʼ", ["a", "b", "v", "h", "g", "d", "e", "ie", "zh", "z", "y", "i", "i", "i", "k", "l", "m", "n", "o", "p", "r", "s", "t", "u", "f", "kh", "ts", "ch", "sh", "shch", "", "iu", "ia", "", "", ""], strict=True))


def latin(word: str) -> str:
    return "".join(LATIN_OF.get(c, c) for c in word.lower())


def candidates(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of everything that may be personal data or shields what may not, in order of precedence.

    Kinds are the sure types, "" for what is none (streets without a number, quotations), and FULL, INITIALS, PAIR and ONE for
    names that the given names of the corpus, or other names of the text, decide on.
    """
    low, found = text.lower(), []
    if "@" in text or _AT.search(low):
        found += [("EMAIL", *m.span()) for m in EMAIL.finditer(text)]
    if streets := [("", *m.span()) for m in STREET.finditer(text)]:  # an address holds a street
        found += [("ADDRESS", *m.span()) for m in ADDRESS.finditer(text)] + streets
    if _NUMERALS.search(text):
        for pattern, words in zip(IDNUM, _ID_WORDS, strict=True):
            if any(w in low for w in words):
                found += [("IDNUM", *m.span(1)) for m in pattern.finditer(text)]
        found += [("PHONE", *m.span()) for m in PHONE.finditer(text)]
    found += [("", *m.span()) for m in _QUOTED.finditer(text)]
    found += [("FULL", *m.span()) for m in FULL.finditer(text)]
    initials = _DOTTED.search(text)
    if initials:
        found += [("INITIALS", *m.span()) for m in INITIALS.finditer(text)]
    found += [("PAIR", m.start(1), m.end(2)) for m in PAIR.finditer(text)]
    return found + [("ONE", *m.span()) for m in ONE.finditer(text)] if initials else found


# what a pattern can't match without, looked for first
_AT = re.compile(r"[\[({](?:at|собака|ат)[\])}]")
_NUMERALS = re.compile(r"\d{2}|\d \d|\d[-.)]")
_ID_WORDS = (("ідентифікаційн", "податков", "рнокпп", "іпн", "платника"), ("паспорт",), ("паспорт", "id-картк"), ("-",))
_DOTTED = re.compile(rf"(?<![{_UP}{_LOW}A-Za-z'’ʼ])[{_UP}A-Z]\.")
_QUOTED = re.compile(r"«[^»\n]*»|\"[^\"\n]*\"")
_SPLIT = re.compile(rf"({_WORD}){_GAP}({_WORD})")
_CASE = re.compile(r"(?:ого|ому|ою|ею|ові|еві|ем|ом|им|ими|ій|ий|а|у|ю|і|ї|и|я|о|й|ь|е)?$")


class Finder:
    """Finds passages of personal data; ``given``: lower-case given names in any case form, of any script."""

    def __init__(self, given: set[str]):
        self.given = given | {latin(g) for g in given} | FOREIGN_GIVEN

    def __call__(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, type) of passages that do not overlap, in order."""
        return self.decide([(kind, a, z, text[a:z]) for kind, a, z in candidates(text)])

    def decide(self, found: list[tuple[str, int, int, str]]) -> list[tuple[int, int, str]]:
        """(start, end, type) by candidates (kind, start, end, passage); an earlier one keeps out those that overlap it."""
        out: list[tuple[int, int, str]] = []
        taken = bytearray(max((z for _, _, z, _ in found), default=0))
        surnames: set[str] = set()

        def take(start: int, end: int, kind: str) -> None:
            if end > start and not any(taken[start:end]):
                taken[start:end] = b"\x01" * (end - start)
                if kind:
                    out.append((start, end, kind))

        for kind, a, z, passage in found:
            if kind not in ("FULL", "INITIALS", "PAIR", "ONE"):
                take(a, z, kind)
            elif kind == "FULL":
                m = FULL.fullmatch(passage)
                before, _, _, after = m.groups()
                surnames |= {self._stem(w) for w in (before, after) if w}
                if after and (not before or before.lower() in ROLES or self._known(before) or not self._known(m[2])):
                    take(a + m.start(2), a + m.end(4), "NAME")
                elif before and before.lower() not in ROLES:
                    take(a + m.start(1), a + m.end(3), "NAME")
                else:
                    take(a + m.start(2), a + (m.end(4) if after else m.end(3)), "NAME")
            elif kind == "INITIALS":
                m = INITIALS.fullmatch(passage)
                word = m[1] or m[2]
                if word.lower() not in ROLES:
                    surnames.add(self._stem(word))
                    take(a, z, "NAME")
            elif kind == "PAIR":
                first, second = _SPLIT.fullmatch(passage).groups()
                if self._known(first) and second.lower() not in ROLES and not self._known(second) or self._known(second) and first.lower() not in ROLES and not self._known(first):
                    surnames.add(self._stem(second if self._known(first) else first))
                    take(a, z, "NAME")
            elif self._stem(passage.split()[0]) in surnames:  # one initial, beside a surname that the text has elsewhere
                take(a, z, "NAME")
        return sorted(out)

    def _known(self, word: str) -> bool:
        return word.lower() in self.given

    @staticmethod
    def _stem(word: str) -> str:
        return word[: _CASE.search(word.lower()).start()].lower()


def written_down(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, kind, start, end, passage) with a row for each text that has candidates, stored; the only pass over the texts."""
    kind = docs.schema[key].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = candidates(x) if x else []
                if found:
                    rows.append((k, *map(list, zip(*((kind, a, z, x[a:z]) for kind, a, z in found), strict=True))))
            columns = list(zip(*rows, strict=True)) or [[], [], [], [], []]
            kinds = (batch.schema.field(0).type, pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [key, "kind", "start", "end", "passage"])

    return stored(docs.select(key, text).mapInArrow(read, f"`{key}` {kind}, kind array<string>, start array<int>, end array<int>, passage array<string>"))


def given_names(found: DataFrame, share: float = GIVEN_SHARE) -> set[str]:
    """Given names as written in the corpus, at most 1 / ``share``: words before a patronymic, counted over all ``written_down``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [FULL.fullmatch(x)[2].lower() for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["word"])

    full = found.select(F.explode(F.arrays_zip("kind", "passage")).alias("x")).where("x.kind = 'FULL'").select("x.passage")
    counts = stored(full.mapInArrow(read, "word string").groupBy("word").agg(F.count("*").alias("n")), total=F.sum("n"))
    return {r["word"] for r in counts.where(F.col("n") >= max(2, (counts.seen["total"] or 0) * share)).collect()}


def passages(docs: DataFrame, key: str, text: str = "text", given: set[str] | None = None) -> DataFrame:
    """(key, start, end, pii_type, pii_text) of every passage, places counted in code points.

    Null and empty texts give none; texts are read whole; repeated rows repeat their passages; other columns are not read.
    """
    ship(docs.sparkSession)
    found = written_down(docs, key, text)
    return decided(found, key, given_names(found) if given is None else given)


def decided(found: DataFrame, key: str, given: set[str]) -> DataFrame:
    """The passages, as in ``passages``, of what is ``written_down``."""
    kind = found.schema[key].dataType.simpleString()
    sent = found.sparkSession.sparkContext.broadcast(given)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder(sent.value)
        for batch in batches:
            rows = []
            for k, *lists in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = list(zip(*lists, strict=True))
                spans = {}
                for _, a, _, x in parts:  # the longest candidate from each start holds what is decided there
                    if len(x) > len(spans.get(a, "")):
                        spans[a] = x
                for a, z, t in find.decide(parts):
                    at = a if a in spans and len(spans[a]) >= z - a else max(s for s, x in spans.items() if s <= a and s + len(x) >= z)
                    rows.append((k, a, z, t, spans[at][a - at : z - at]))
            columns = list(zip(*rows, strict=True)) or [[], [], [], [], []]
            kinds = (batch.schema.field(0).type, pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [key, "start", "end", "pii_type", "pii_text"])

    return found.select(key, "kind", "start", "end", "passage").mapInArrow(read, f"`{key}` {kind}, start int, end int, pii_type string, pii_text string")


def placeholders(docs: DataFrame, text: str = "text", given: set[str] | None = None) -> DataFrame:
    """``docs`` with each passage of ``text`` replaced by [TYPE] and nothing else changed; null stays null."""
    ship(docs.sparkSession)
    names = given_names(written_down(docs.select(F.lit(0).alias("k"), text), "k", text)) if given is None else given

    @F.pandas_udf("string")
    def replace(values):  # noqa: ANN001, ANN202
        find = Finder(names)

        def one(x: str | None) -> str | None:
            if not x:
                return x
            out, at = [], 0
            for a, z, t in find(x):
                out += [x[at:a], f"[{t}]"]
                at = z
            return "".join(out) + x[at:]

        return values.map(one)

    return docs.withColumn(text, replace(F.col(text)))
