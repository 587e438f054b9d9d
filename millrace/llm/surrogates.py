"""Personal data replaced by keyed surrogates that keep type, gender, case, script and format.

Numbers go through keyed one-to-one maps of all numbers of their length that leave none in place, so they need no state.
Given names and patronymics that the pools hold change places within their pool (one gender and declension each), so the
written ending fits. All other words are known by their stem in one alphabet; a stem draws a core of syllables by a keyed
hash, and stems that draw the same core are told apart by further syllables, which is the only thing that needs all distinct stems
together. Initials and mail addresses follow the names they belong to.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from datetime import date, timedelta
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import pii
from millrace.llm.names import letters, merged
from millrace.session import ship, stored

# Stems of given names by gender and declension, with the nominative ending of each class.
POOLS = {
    "m": ("", "іван роман богдан степан тарас максим артем антон віктор олександр володимир ярослав мирослав владислав святослав станіслав ростислав остап назар захар макар едуард руслан вадим устим борис леонід давид денис костянтин валентин мартин герман альберт"),
    "mo": ("о", "петр павл дмитр михайл данил кирил гаврил марк"),
    "mj": ("й", "андрі сергі юрі олексі анатолі валері віталі геннаді григорі тимофі матві георгі аркаді"),
    "f": ("а", "оксан ірин тетян людмил галин катерин світлан марин валентин ган олен алл ларис христин зорян роксолан діан інн полін дарин богдан мирослав ярослав владислав станіслав антонін жанн"),
    "fj": ("я", "марі наталі юлі вікторі анастасі софі євгені ліді емілі соломі валері"),
}
# Letters of the syllables that surrogates are made of, and capital letters an initial may become.
CONSONANTS, VOWELS, INITIALS = "бвгдклмнпрст", "аеиоу", "абвгдезіклмнопрстуфхя"
_WORD = re.compile(r"[^\W\d_]+(?:['’ʼ][^\W\d_]+)*")
_NUMBER = re.compile(r"\d+")
_ENDING = re.compile(r"(?:ого|ому|ої|ою|ею|єю|ові|еві|єві|ем|єм|ом|им|ими|ій|ий|а|у|ю|і|ї|и|я|о|й|ь|е|є|yi|yj|oi|ii|oho|omu|oiu|iu|ia|ie|a|u|i|y|o|e)?$")
_SUFFIX = re.compile(r"(?:енк|єнк|чук|щук|юк|ук|ськ|цьк|зьк|івськ|ець|ишин|як|enk|iuk|chuk|shchuk|uk|sk|tsk|ets|yshyn|iak)?$")
_FATHER = re.compile(r"(.+?)(йович|ович|евич|лліч|ьич|ївн|івн|овн|евн|ичн|iovych|yovych|ovych|evych|yivn|iivn|ivn)([а-яіїє]*|[a-z]*)$")


class Keyed:
    """Keyed maps of whole numbers."""

    def __init__(self, secret: bytes):
        self.secret = hashlib.sha256(secret).digest()

    def draw(self, *what: object) -> int:
        return int.from_bytes(hashlib.blake2b("\x00".join(map(str, what)).encode(), key=self.secret, digest_size=8).digest(), "big")

    def turned(self, tweak: str, size: int, turn: int, half: int) -> int:
        return int.from_bytes(hashlib.blake2b(b"%d|%d|%d|%s" % (size, turn, half, tweak.encode()), key=self.secret, digest_size=8).digest(), "big")

    def moved(self, number: int, size: int, tweak: str) -> int:
        """A one-to-one map of 0..size-1 without a number that stays, for sizes from 2 on: the next one in a keyed order.

        The keyed order is a Feistel network of four turns over the least even number of bits that holds ``size``, walked until inside.
        """
        half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1

        def walk(x: int, turns: range) -> int:
            while True:
                left, right = x >> half, x & mask
                for turn in turns:
                    if turns.step > 0:
                        left, right = right, left ^ (self.turned(tweak, size, turn, right) & mask)
                    else:
                        left, right = right ^ (self.turned(tweak, size, turn, left) & mask), left
                x = left << half | right
                if x < size:
                    return x

        return walk((walk(number, range(4)) + 1) % size, range(3, -1, -1))

    def digits(self, text: str, tweak: str, plain: bool = False) -> str:
        """Digits as other digits of the same number; ``plain`` ones do not begin with 0."""
        if plain and text[0] != "0":
            least = 10 ** (len(text) - 1)
            return str(least + self.moved(int(text) - least, 9 * least, tweak))
        return str(self.moved(int(text), 10 ** len(text), tweak)).zfill(len(text))

    @lru_cache(maxsize=16)  # noqa: B019
    def pool(self, name: str) -> dict[str, str]:
        """Each stem of a pool with the one that takes its place: the next in a keyed order in which initials change where they can."""
        rest = sorted(POOLS[name][1].split(), key=lambda stem: self.draw("pool", name, stem))
        ring = [rest.pop()]
        while rest:
            at = next((k for k in range(len(rest) - 1, -1, -1) if rest[k][0] != ring[-1][0]), len(rest) - 1)
            ring.append(rest.pop(at))
        return dict(zip(ring, ring[1:] + ring[:1], strict=True))

    def initial(self, letter: str) -> str:
        if letter in INITIALS:
            return INITIALS[self.moved(INITIALS.index(letter), len(INITIALS), "initial")]
        return INITIALS[self.draw("initial", letter) % len(INITIALS)]


def stem_of(word: str) -> str:
    """What a word is known by: its stem, whatever case ending, script and letter case it is written in."""
    low = word.lower()
    return merged(letters(low[: _ENDING.search(low).start()] or low))


def _tail(word: str) -> str:
    """The name suffix and the case ending of a word, which a surrogate keeps."""
    low = word.lower()
    stem = low[: _ENDING.search(low).start()] or low
    root = stem[: _SUFFIX.search(stem).start()]
    return low[len(root) if len(root) > 1 else len(stem) :]


def _spelt(letters_: str, model: str) -> str:
    """Cyrillic letters in the script and letter case of a model."""
    if model.isascii():
        letters_ = pii.latin(letters_)
    return letters_.upper() if model.isupper() and len(model) > 1 else letters_.capitalize() if model[0].isupper() else letters_


_CLASS_OF = {}
for _name, (_, _stems) in POOLS.items():
    for _stem in _stems.split():
        _CLASS_OF.setdefault(letters(_stem), []).append((_name, _stem))


def given_class(word: str, gender: str) -> tuple[str, str] | None:
    """(pool, stem) of a given name in any case and script; ``gender`` m, f or "" where the name itself must tell."""
    low = word.lower() if not word.isascii() else letters(word)
    for size in range(len(low), max(2, len(low) - 4), -1):
        options = _CLASS_OF.get(letters(low[:size]), [])
        ending = low[size:]
        fits = [x for x in options if gender in ("", x[0][0]) and (ending[:1] in ("я", "ї", "ю", "є", "й", "а", "і") if x[0] in ("mj", "fj") else ending[:1] not in ("я", "ї", "й", "є"))]
        fits = [x for x in fits if not (x[0] == "fj" and ending[:1] == "й") and not (x[0] == "f" and not ending) and not (x[0] == "m" and ending[:1] == "о" and ending not in ("ом", "ові"))]
        if len(fits) > 1 and not gender:  # a name of both genders: the nominative tells
            fits = [x for x in fits if (x[0][0] == "f") == (ending in ("а", "я", "и", "ї", "ою", "єю"))] or fits
        if fits:
            return fits[0]
    return None


def units(pii_type: str, text: str, given: set[str]) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, unit) of the parts of a passage that are replaced.

    Kinds: ``core`` draws a core by its unit, ``given`` and ``father`` stand in a pool (unit: pool and stem), ``initial`` follows
    the name (unit: surname stem and initials), ``letters`` and ``digits`` (unit: what they are) are mapped alone.
    """
    out: list[tuple[int, int, str, str]] = []
    if pii_type in ("PHONE", "IDNUM"):
        spots = [k for k, c in enumerate(text) if c.isdigit()]
        if pii_type == "PHONE":
            spots = spots[-9:]
        out = [(m.start(), m.end(), "letters", "series") for m in _WORD.finditer(text)]
        return out + [(spots[0], spots[-1] + 1, "digits", pii_type)] if spots else out
    if pii_type == "NAME":
        words = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(text)]
        initials = [x for x in words if len(x[2]) == 1]
        fathers = [x for x in words if len(x[2]) > 1 and pii.PATRONYMIC.fullmatch(x[2])]
        rest = [x for x in words if x not in initials and x not in fathers]
        gender = ""
        if fathers:
            gender = "f" if re.search(r"вн|ичн|vn", fathers[0][2].lower()) else "m"
        first = None
        if fathers and not initials:
            before = [x for x in rest if x[1] <= fathers[0][0]]
            first = before[-1] if before else None
        elif not initials and len(rest) > 1:
            first = next((x for x in rest if x[2].lower() in given or given_class(x[2], "")), rest[0])
        surnames = [x for x in rest if x is not first]
        out += [(a, z, "core", f"S:{stem_of(w)}") for a, z, w in surnames]
        if first:
            known = given_class(first[2], gender)
            out.append((first[0], first[1], "given", ":".join(known)) if known else (first[0], first[1], "core", f"G:{stem_of(first[2])}"))
        for a, z, w in fathers:
            m = _FATHER.match(w.lower())
            root = m[1] if not w.isascii() else letters(m[1])
            known = [x for x in _CLASS_OF.get(letters(root), []) + _CLASS_OF.get(letters(root + "і"), []) if x[0][0] == "m"]
            out.append((a, a + len(m[1]), "father", ":".join(known[0])) if known else (a, a + len(m[1]), "core", f"F:{stem_of(root)}"))
        of = stem_of(surnames[0][2]) if surnames else ""
        all_ = "".join(letters(w)[:1] or w.lower() for _, _, w in initials)
        out += [(a, z, "initial", f"{of}:{all_}:{k}") for k, (a, z, w) in enumerate(initials)]
        return sorted(out)
    if pii_type == "EMAIL":
        host = re.search(r"@|\s?[\[({](?:at|собака|ат)[\])}]\s?", text, re.IGNORECASE)
        dots = [m.span() for m in re.finditer(r"\.|\s?[\[({]dot[\])}]\s?", text, re.IGNORECASE) if m.start() >= host.end()]
        words = [m for m in re.finditer(r"[^\W\d_]+", text) if not (host.start() <= m.start() < host.end()) and not any(a <= m.start() < z for a, z in dots)]
        names = [m.group() for m in words if m.end() <= host.start() and len(m.group()) > 2]
        for m in words:
            w = m.group()
            if m.start() >= dots[-1][1]:
                continue  # the top-level domain
            if m.start() >= host.end():
                out.append((*m.span(), "core", f"D:{stem_of(w)}"))
            elif len(w) > 2:
                out.append((*m.span(), "core", f"S:{stem_of(w)}"))
            else:
                out += [(m.start() + k, m.start() + k + 1, "initial", f"{stem_of(names[-1]) if names else ''}:{letters(c) or c}:0") for k, c in enumerate(w)]
        return out + [(*m.span(), "digits", "N") for m in _NUMBER.finditer(text) if m.start() < dots[-1][1]]
    for m in _WORD.finditer(text):
        if len(m.group()) == 1 and m.start() and (text[m.start() - 1].isdigit() or text[m.start() - 1] in "- "):
            out.append((*m.span(), "letters", "house")) if not text[m.end() : m.end() + 1] == "." else None
        elif m.group().lower() not in KEPT:
            out.append((*m.span(), "core", f"A:{stem_of(m.group())}"))
    return out + [(*m.span(), "digits", "N") for m in _NUMBER.finditer(text)]


# Words of an address that are not personal and stay.
KEPT = frozenset("вул вулиця вулиці вулицю вулицею просп проспект пр т бульв бульвар пров провулок пл площа площі площу шосе наб набережна майдан проїзд туп тупик узв узвіз алея буд будинок б кв квартира оф офіс корп корпус м місто с село смт селище ще".split())


class Renderer:
    """Writes surrogates; ``cores``: core of each unit a passage has, ``people``: initials of surname and initials."""

    def __init__(self, secret: bytes, given: set[str]):
        self.keyed, self.given = Keyed(secret), given

    def base(self, unit: str) -> str:
        """Two syllables that another stem may draw as well, of another first letter than the stem's."""
        n = self.keyed.draw("core", unit)
        out = []
        for _ in range(2):
            for alphabet in (CONSONANTS, VOWELS, CONSONANTS):
                out.append(alphabet[n % len(alphabet)])
                n //= len(alphabet)
        own = unit.partition(":")[2][:1]
        if out[0] == own:
            out[0] = CONSONANTS[(CONSONANTS.index(own) + 1) % len(CONSONANTS)]
        return "".join(out)

    @staticmethod
    def further(rank: int) -> str:
        """Syllables that tell apart the stems with one base: none for the first."""
        out = []
        while rank:
            rank -= 1
            n, rank = rank % 720, rank // 720
            out.append(CONSONANTS[n % 12] + VOWELS[n // 12 % 5] + CONSONANTS[n // 60])
        return "".join(out)

    def first_letter(self, kind: str, unit: str, cores: dict[str, str]) -> str:
        if kind == "core":
            return cores[unit][0]
        pool, stem = unit.split(":")
        return self.keyed.pool(pool)[stem][0]

    def __call__(self, pii_type: str, text: str, cores: dict[str, str], people: dict[str, str]) -> str:
        out, at = [], 0
        for a, z, kind, unit in sorted(units(pii_type, text, self.given)):
            out.append(text[at:a])
            out.append(self.part(text[a:z], kind, unit, cores, people))
            at = z
        return "".join(out) + text[at:]

    def part(self, word: str, kind: str, unit: str, cores: dict[str, str], people: dict[str, str]) -> str:
        keyed = self.keyed
        if kind == "digits":
            plain = re.sub(r"\D", "", word)
            if unit == "IDNUM" and re.fullmatch(r"\d{8}-\d{5}", word):
                new = self._born(plain[:8]) + keyed.digits(plain[8:], "IDNUM")
            else:
                new = keyed.digits(plain, unit, plain=unit == "N")
            new = iter(new)
            return "".join(next(new) if c.isdigit() else c for c in word)
        if kind == "letters":
            alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if word.isascii() else "АБВГҐДЕЄЖЗИІЇЙКЛМНОПРСТУФХЦЧШЩЮЯ"
            number = 0
            for c in word.upper():
                number = number * len(alphabet) + max(0, alphabet.find(c))
            number = keyed.moved(number, len(alphabet) ** len(word), unit)
            new = ""
            for _ in word:
                number, k = divmod(number, len(alphabet))
                new = alphabet[k] + new
            return new if word.isupper() else new.lower()
        if kind == "initial":
            of, own, k = unit.split(":")
            drawn = people.get(f"{of}:{own}", "")
            new = drawn[int(k)] if int(k) < len(drawn) else ""
            if not new or new == own[int(k)]:
                new = keyed.initial(own[int(k)])
            return _spelt(new, word)[0] if word.isascii() else new.upper() if word.isupper() else new
        if kind in ("given", "father"):
            pool, stem = unit.split(":")
            new = keyed.pool(pool)[stem]
            if kind == "father":
                return _spelt(new[:-1] if pool == "mj" and word.lower()[-1:] not in ("і", "i") else new, word)
            low = word.lower() if not word.isascii() else letters(word)
            size = next(n for n in range(len(low), 0, -1) if letters(low[:n]) == letters(stem))
            return _spelt(new + low[size:], word)
        core = cores[unit]
        tail = "" if unit[0] == "F" else _tail(word)
        new = _spelt(core, word if len(word) > 1 else word.lower())
        return new + (tail.upper() if word.isupper() and len(word) > 1 else tail)

    def _born(self, day: str) -> str:
        """Another date of 1900 to 2049 for a date, other digits for what is none."""
        start, days = date(1900, 1, 1), 54_787
        try:
            n = (date(int(day[:4]), int(day[4:6]), int(day[6:])) - start).days
        except ValueError:
            n = -1
        if not 0 <= n < days:
            return self.keyed.digits(day, "IDNUM")
        return (start + timedelta(self.keyed.moved(n, days, "born"))).strftime("%Y%m%d")


def _arrow(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def replacements(docs: DataFrame, key: str, secret: bytes, text: str = "text", given: set[str] | None = None) -> DataFrame:
    """(key, start, end, pii_type, pii_text, surrogate) of every passage of personal data.

    Null and empty texts have none; repeated rows repeat theirs; other columns are not read. Over the whole corpus one thing has
    one surrogate, however it is written, different things have different ones, and no replaced part stays as it was.
    """
    spark = docs.sparkSession
    ship(spark)
    written = pii.written_down(docs, key, text)
    names = pii.given_names(written) if given is None else given
    sent = spark.sparkContext.broadcast((secret, pii.Finder(names).given))
    found = stored(pii.decided(written, key, names))
    distinct = found.select("pii_type", "pii_text").distinct()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = units(t, x, sent.value[1])
                cores = sorted({u for _, _, kind, u in parts if kind == "core"})
                asked = sorted({u.rpartition(":")[0] for _, _, kind, u in parts if kind == "initial"})
                told = []
                if t == "NAME" and not asked:  # who the initials beside a surname may stand for
                    of = next((u[2:] for _, _, kind, u in parts if kind == "core" and u[0] == "S"), None)
                    first = next(((k, u) for _, _, k, u in parts if k == "given" or u[:2] == "G:"), None)
                    father = next(((k, u) for _, _, k, u in parts if k == "father" or u[:2] == "F:"), None)
                    if of and first:
                        g, p = letters(first[1].split(":")[1])[:1], letters(father[1].split(":")[1])[:1] if father else ""
                        whole = [("given" if first[0] == "given" else "core", first[1])] + ([("father" if father[0] == "father" else "core", father[1])] if father else [])
                        told = [(f"{of}:{g}", whole[:1])] + ([(f"{of}:{g}{p}", whole), (f"{of}:{p}{g}", whole[::-1])] if father else [])
                rows.append((t, x, cores, asked, [k for k, _ in told], ["|".join(f"{kind};{u}" for kind, u in w) for _, w in told]))
            text_list = pa.list_(pa.string())
            yield _arrow(rows, [("pii_type", pa.string()), ("pii_text", pa.string()), ("cores", text_list), ("asked", text_list), ("told", text_list), ("whole", text_list)])

    passages = stored(distinct.mapInArrow(split, "pii_type string, pii_text string, cores array<string>, asked array<string>, told array<string>, whole array<string>"))

    @F.pandas_udf("string")
    def base(values):  # noqa: ANN001, ANN202
        renderer = Renderer(*sent.value)
        return values.map(renderer.base)

    @F.pandas_udf("string")
    def further(values):  # noqa: ANN001, ANN202
        return values.map(Renderer.further)

    all_units = passages.select(F.explode("cores").alias("unit")).distinct().withColumn("base", base("unit"))
    # stems that drew the same syllables get further ones: a few of them share a base, which is one of half a million
    same = Window.partitionBy(F.substring("unit", 1, 1), "base").orderBy("unit")
    cores = stored(all_units.withColumn("rank", F.row_number().over(same) - 1).select("unit", F.when(F.col("rank") == 0, F.col("base")).otherwise(F.concat("base", further("rank"))).alias("core")))
    # initials follow the least full name that they fit
    asked = passages.select(F.explode("asked").alias("name")).distinct()
    told = passages.select(F.explode(F.arrays_zip("told", "whole")).alias("x")).groupBy(F.col("x.told").alias("name")).agg(F.min("x.whole").alias("whole")).join(asked, "name", "left_semi")
    needed = told.select("name", F.posexplode(F.split("whole", "[|]")).alias("k", "part")).select("name", "k", F.substring_index("part", ";", 1).alias("kind"), F.substring_index("part", ";", -1).alias("unit"))

    @F.pandas_udf("string")
    def letter(kinds, unit, core):  # noqa: ANN001, ANN202
        renderer = Renderer(*sent.value)
        return kinds.to_frame("k").assign(u=unit, c=core).apply(lambda r: renderer.first_letter(r.k, r.u, {r.u: r.c}), axis=1).astype(object)

    drawn = needed.join(cores, "unit", "left").select("name", "k", letter("kind", "unit", F.coalesce("core", F.lit("?"))).alias("letter"))
    people = drawn.groupBy("name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "letter"))), lambda x: x["letter"]), "").alias("drawn"))

    with_cores = passages.select("pii_type", "pii_text", F.explode("cores").alias("unit")).join(cores, "unit").groupBy("pii_type", "pii_text").agg(F.map_from_entries(F.collect_list(F.struct("unit", "core"))).alias("cores"))
    with_people = passages.select("pii_type", "pii_text", F.explode("asked").alias("name")).join(people, "name").groupBy("pii_type", "pii_text").agg(F.map_from_entries(F.collect_list(F.struct("name", "drawn"))).alias("people"))
    rows = passages.select("pii_type", "pii_text").join(with_cores, ["pii_type", "pii_text"], "left").join(with_people, ["pii_type", "pii_text"], "left")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        renderer = Renderer(*sent.value)
        for batch in batches:
            out = [(t, x, renderer(t, x, dict(c or ()), dict(p or ()))) for t, x, c, p in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield _arrow(out, [("pii_type", pa.string()), ("pii_text", pa.string()), ("surrogate", pa.string())])

    rendered = rows.mapInArrow(render, "pii_type string, pii_text string, surrogate string")
    return found.join(rendered, ["pii_type", "pii_text"]).select(key, "start", "end", "pii_type", "pii_text", "surrogate")


def surrogates(docs: DataFrame, key: str, secret: bytes, text: str = "text", given: set[str] | None = None) -> DataFrame:
    """(key, text) of every row with each passage replaced by its surrogate; null and empty texts stay, other columns go.

    ``key`` must be unique; see ``replacements``.
    """
    if not secret:
        raise ValueError("surrogates need a secret")
    edits = replacements(docs, key, secret, text, given).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("start", "end", "surrogate"))).alias("__edits"))
    # pieces between the passages are cut out and joined again in place
    start = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.element_at("__edits", F.when(k == 0, F.lit(1)).otherwise(k))["end"])
    kept = F.transform("__edits", lambda e, k: F.concat(F.substring(F.col(text), start(k) + 1, e["start"] - start(k)), e["surrogate"]))
    last = F.element_at("__edits", -1)["end"]
    whole = F.concat(F.array_join(kept, ""), F.substring(F.col(text), last + 1, F.length(text)))
    return docs.select(key, text).join(edits, key, "left").select(key, F.when(F.col("__edits").isNull(), F.col(text)).otherwise(whole).alias(text))
