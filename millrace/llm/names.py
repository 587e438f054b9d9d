"""Spellings of one person's or organisation's name, linked.

A written name is parsed to parts in one alphabet: persons to surname, given name and patronymic, organisations to the words
of the core name without the legal form. The surnames and core words form a dictionary, which meets itself in a
pigeonhole join: a word is cut into segments, of EDITS + 2 of which EDITS typing errors leave two whole; an inverted index of
segments is probed with substrings at shifted positions, and banded edit distance verifies. Each word of a
near pair takes the more frequent one as its anchor. Names meet where they share an anchor and a part that must agree, and
a last check compares all their parts. So names move as 64-bit keys; names under one key differ in writing, which is why
even the commonest surname has short groups; keys that are hot all the same are dealt out to many tasks.
Short forms (initials, no patronymic) attach only where a single full name fits them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import connected_components
from millrace.operators.skew import join_split
from millrace.session import discard, release, ship, stored

#: Typing errors allowed in a part: one insertion, deletion, replacement or swap of neighbours.
EDITS = 1
#: A word of a lexicon has this share of all names at least, so a lexicon has at most 1 / share words.
LEXICON_SHARE = 2e-5
#: Words a worker remembers before it starts anew.
REMEMBER = 200_000
#: A spelling is a typing error of another only if it is less common than this, relative to the other.
RIVAL = 0.2
#: Words of fewer letters have no typing errors.
LEAST_WORD = 5

# Transliteration of names, Latin by the national table back to Cyrillic; longer ones first.
LATIN = {"zgh": "зг", "shch": "щ", "kh": "х", "zh": "ж", "ts": "ц", "ch": "ч", "sh": "ш", "iu": "ю", "ia": "я", "ie": "є", "yu": "ю", "ya": "я", "ye": "є", "a": "а", "b": "б", "v": "в", "h": "г", "g": "г", "d": "д", "e": "е", "z": "з", "y": "и", "i": "і", "j": "і", "k": "к", "l": "л", "m": "м", "n": "н", "o": "о", "p": "п", "r": "р", "s": "с", "t": "т", "u": "у", "f": "ф", "c": "к", "q": "к", "w": "в", "x": "кс"}
# Letters that spellings mix up or leave out.
MIXED = str.maketrans({"ї": "і", "й": "і", "ґ": "г", "ы": "и", "э": "е", "ё": "о", "ь": None, "ъ": None, "'": None, "’": None, "ʼ": None, "`": None})
# Everyday and Russian forms of given names.
SHORT = """
олександр: саша сашко сашка шура олесь лесь александр
олександра: саша леся шура александра
олексій: льоша олекса алексей
андрій: андрійко андрюша андрей
анатолій: толя толік анатолий
антон: антоша тоша
антоніна: тоня антонина
анна: аня ганна ганя нюра
богдан: бодя богданко даня
богдана: даня дана
борис: боря
вадим: вадік
валентин: валя валік
валентина: валя
валерій: валера валерий
василь: вася василько василёк василий
вероніка: ніка вероника
віктор: вітя виктор
вікторія: віка вікуся виктория
віталій: віталік виталий
владислав: владик влад
володимир: вова володя вовка володька владимир
в'ячеслав: слава славко вячеслав
галина: галя галка галинка
геннадій: гена геннадий
григорій: гриша гриць грицько григорий
дарина: дарія даша дарья дарка
дмитро: діма дмитрик дмитрій дімка дмитрий
данило: даня данилко даниил данила
діана: діанка диана
едуард: едик эдуард
євген: женя жека евгений
євгенія: женя евгения
єлизавета: ліза єлизаветка лізавета елизавета
захар: захарко захарчик
зінаїда: зіна зинаида
зіновій: зінько зиновий
зоряна: зоря зорянка
іван: ваня івась іванко иван
ігор: ігорьок гоша игорь
інна: інка инна
інесса: інна інеса инесса
ірина: іра іринка ірка ирина
йосип: йосько осип йося иосиф
катерина: катя катруся катря екатерина
кирило: кирилко кирил кирилл
костянтин: костя константин
лариса: лара лариска
левко: льова лев левчик
леонід: льоня леонид
любов: люба любка любовь
людмила: люда мила люся
макар: макарко
максим: макс
марія: маша маруся марічка мария
марина: маринка
микита: нікіта никита
микола: коля миколка миколай николай
михайло: міша мишко михайлик михаил
мирослава: мирося слава
надія: надя надежда
назар: назарко назарий
наталія: наталка наташа ната наталя наталья
оксана: ксеня ксюша
ольга: оля олька
остап: остапко
павло: паша павлик павлусь павел
петро: петя петрик петрусь петр
раїса: рая раиса
роман: рома ромко
руслан: русик
світлана: свєта світланка светлана
святослав: святик слава
сергій: серьожа сергійко сергей
соломія: соля солька соломия
софія: соня софійка софия
степан: стьопа степанко
таміла: тома тамила
тарас: тарасик тарасько
тетяна: таня тетянка татьяна
тимофій: тимко тимоша тимофей
устим: устимко
федір: федя федько федор
фаїна: фая фаина
христина: христя кристина
христофор: христик
юлія: юля юлька юлия
юрій: юра юрко юрий
яків: яша яков
ярослав: славко ярко ярик
"""
# Legal forms, short and in full.
FORMS = {"тов": "товариство з обмеженою відповідальністю", "пп": "приватне підприємство", "прат": "приватне акціонерне товариство", "пат": "публічне акціонерне товариство", "ат": "акціонерне товариство", "фг": "фермерське господарство", "кп": "комунальне підприємство", "дп": "державне підприємство", "го": "громадська організація", "бф": "благодійний фонд", "тдв": "товариство з додатковою відповідальністю", "сфг": "селянське фермерське господарство"}
FORMS_LATIN = ("llc", "ltd", "co", "inc", "jsc", "corp", "pe")
# Letter pairs that Latin spellings can't tell from one letter.
MERGED = [("зг", "ж"), ("кг", "х"), ("тс", "ц"), ("сг", "ш"), ("шч", "щ"), ("іа", "я"), ("іе", "є"), ("іу", "ю")]
# Words that follow a patronymic of Turkic form.
PARTICLES = ("огли", "оглу", "кизи", "гизи", "кізі", "углі")
# Capital letters of the two alphabets that look alike.
_LOOKS = dict(zip("ABCEHIKMOPTXY", "АВСЕНІКМОРТХУ", strict=True))
_PATRONYMIC = re.compile(r"(ович|евич|івна|овна|евна|ївна|ична|лліч)$")
_NEAR_PATRONYMIC = re.compile(r"(ов.?и.?ч|о.ич|ов.ч|овии?ч|овчи|воич|ови|вич|івн|і.на|ів.?н.?а|вна|іна|ївн.?)$")


def letters(word: str) -> str:
    """A word in one alphabet, lower case, with letters that spellings mix up made equal."""
    word = word.lower()
    if re.search("[a-z]", word) and not re.search("[а-яіїєґ]", word):
        out, k = [], 0
        while k < len(word):
            for n in (4, 3, 2, 1):
                if (part := word[k : k + n]) in LATIN and len(part) == n:
                    out.append(LATIN[part])
                    k += n
                    break
            else:
                out.append(word[k])
                k += 1
        word = "".join(out)
    return word.translate(MIXED)


def merged(word: str) -> str:
    """The word as it would be read back from a Latin spelling."""
    for pair, one in MERGED:
        word = word.replace(pair, one)
    return word


def _short_forms() -> dict[str, frozenset[str]]:
    out: dict[str, set[str]] = {}
    for line in SHORT.strip().splitlines():
        full, _, forms = line.partition(": ")
        for form in (full, *forms.split()):
            for spelt in {letters(form), merged(letters(form))}:
                out.setdefault(spelt, set()).add(letters(full))
    return {k: frozenset(v) for k, v in out.items()}


GIVEN_OF = _short_forms()
_LEGAL_WORDS = {letters(w) for f in FORMS.values() for w in f.split()}
_LEGAL_SHORT = {letters(w) for w in FORMS} | {letters(w) for w in FORMS_LATIN}


def near(a: str, b: str, most: int = EDITS) -> bool:
    """Whether at most ``most`` edits (insert, delete, replace, swap neighbours) part two words; banded."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > most:
        return False
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + [most + 1] * len(b)
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], before[j - 2] + 1)
        if min(row) > most:
            return False
        before, last = last, row
    return last[-1] <= most


def one_alphabet(name: str) -> str:
    """A capital name without look-alike letters of another alphabet inside a word, or alone in a name of the other alphabet."""
    if not (re.search("[A-Z]", name) and re.search("[А-ЯІЇЄҐ]", name)):
        return name
    to_latin = {v: k for k, v in _LOOKS.items()}

    def fold(m: re.Match) -> str:
        word = m.group()
        latin, other = [c for c in word if c.isascii()], [c for c in word if not c.isascii()]
        if latin and (other or len(word) == 1) and all(c in _LOOKS for c in latin):
            return "".join(_LOOKS.get(c, c) for c in word)
        if latin and other and all(c in to_latin for c in other):
            return "".join(to_latin.get(c, c) for c in word)
        return word

    return re.sub(r"[^\W\d_]+", fold, name)


def tidy(name: Column) -> Column:
    """A written name without additions in brackets or after a slash, runs of blanks and case."""
    return F.upper(F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(name, r"\s*\([^)]*\)|\s+/\s.*$|\s+\?+\s*$", " "), r"[`’ʼ′＇]", "'"), r"(?U)\s+", " ")))


_WORD = re.compile(r"[^\W\d_]+(?:['-][^\W\d_]+)*\.?|,|[«»\"]|\d+")


class Parser:
    """Parses names by the corpus' lexicons of given names and of words that describe firms."""

    def __init__(self, given: dict[str, int], patronymic: dict[str, int], firm: set[str]):
        self.given, self.patronymic, self.firm = given, patronymic, firm
        self.close: dict[str, bool] = {}
        self.right: dict[tuple[str, bool], str] = {}
        self.segments: dict[bool, dict[str, list[str]]] = {}

    def _near(self, word: str, patronymic: bool) -> set[str]:
        """Words of a lexicon within EDITS of a word, through the same segments as the names themselves."""
        if patronymic not in self.segments:
            index: dict[str, list[str]] = {}
            for known in self.patronymic if patronymic else self.given:
                for at in index_keys(known):
                    index.setdefault(at, []).append(known)
            self.segments[patronymic] = index
        index = self.segments[patronymic]
        return {w for at in probe_keys(word) for w in index.get(at, ()) if near(w, word)}

    def _is_given(self, word: str) -> bool:
        if word in self.given or word in GIVEN_OF:
            return True
        if len(word) < 4:
            return False
        if word not in self.close:
            if len(self.close) > REMEMBER:
                self.close.clear()
            self.close[word] = bool(self._near(word, False))
        return self.close[word]

    def parse(self, name: str) -> tuple[str, ...] | None:
        """("p", surname, given, patronymic[, particle]) or ("o", *core words); abbreviations keep a point; None for no name.

        Every word of a name is in one of the parts; further surnames are joined by hyphens.
        """
        alphabets = {_alphabet(c) for c in name if c.isalpha()}
        if "?" in alphabets or re.search(r"[^\w\s.,'«»\"()&№/-]", name):
            return None
        pieces = _WORD.findall(one_alphabet(name) if len(alphabets) > 1 else name)
        words = [(letters(w.rstrip(".")), w.endswith(".") or len(w) == 1) for w in pieces if w[0].isalpha()]
        words = [(w, short) for w, short in words if w]
        if not words:
            return None
        plain = [w for w, _ in words]
        quoted = any(q in pieces for q in '«»"')
        legal = any(w in _LEGAL_SHORT for w in plain) or sum(w in _LEGAL_WORDS for w in plain) > 1
        people = [w for w, short in words if not short and (self._is_given(w) or _PATRONYMIC.search(w))]
        initials = sum(short and len(w) <= 4 for w, short in words)
        long = len(words) > 4 and not any(self._fits(a, b) >= 3 for a, b in zip(plain, plain[1:], strict=False))
        if quoted or legal or not (people or initials) or long or (any(w in self.firm for w in plain) and not people):
            core = []
            for w, short in words:
                if w in _LEGAL_SHORT or w in _LEGAL_WORDS or w == letters("з") or (short and len(w) >= 3 and any(x.startswith(w) for x in _LEGAL_WORDS) and not core and (quoted or legal)):
                    continue
                core.append(w + "." if short else w)
            return ("o", *(core or plain))
        particles = [w for w in plain[1:] if w in PARTICLES]
        if particles:
            words = [words[0], *(x for x in words[1:] if x[0] not in PARTICLES)]
        parsed = self._people(pieces, words)
        return (*parsed, *particles) if parsed else None

    def _people(self, pieces: list[str], words: list[tuple[str, bool]]) -> tuple[str, ...] | None:
        plain = [w for w, _ in words]
        if "," in pieces and pieces.index(",") == 1 and len(words) >= 2:
            return self._person(words[:1], words[1:])
        full = [k for k, (_, short) in enumerate(words) if not short]
        if not full:
            return None
        if len(words) == 1:
            return ("p", words[0][0], "", "")
        if len(full) == 1:
            k = full[0]
            return self._person(words[k : k + 1], words[:k] + words[k + 1 :])
        if len(words) == 2:
            first = self._is_given(plain[0]) and not (self._is_given(plain[1]) and plain[0] not in self.given)
            return self._person(words[1:], words[:1]) if first else self._person(words[:1], words[1:])
        if len(words) == 3:  # the surname stands first or last
            ends = self._fits(plain[0], plain[1]) > self._fits(plain[1], plain[2])
            return self._person(words[2:], words[:2]) if ends and not words[2][1] else self._person(words[:1], words[1:])
        # the neighbours that fit best are given name and patronymic, or both initials; first or last of all rather than between
        fits = [(self._fits(plain[k], plain[k + 1]) + words[k][1] + words[k + 1][1], k in (0, len(words) - 2), k) for k in range(len(words) - 1)]
        k = max(fits)[2]
        return self._person(words[:k] + words[k + 2 :], words[k : k + 2])

    def _fits(self, given: str, patronymic: str) -> float:
        score = 2.0 if given in self.given or given in GIVEN_OF else 1.0 if self._is_given(given) else 0.0
        return score + (2.0 if patronymic in self.patronymic else 1.5 if _PATRONYMIC.search(patronymic) else 1.0 if _NEAR_PATRONYMIC.search(patronymic) else 0.0)

    def _person(self, surname: list[tuple[str, bool]], rest: list[tuple[str, bool]]) -> tuple[str, ...]:
        parts = [w + "." if short else self._corrected(w, bool(k)) for k, (w, short) in enumerate(rest[:2])] + ["", ""]
        return ("p", "-".join(w for w, _ in surname + rest[2:]), parts[0], parts[1])

    def _corrected(self, word: str, patronymic: bool) -> str:
        """A rare given name or patronymic as the common one it is a typing error of, if there is one."""
        known = self.patronymic if patronymic else self.given
        if len(word) < 4 or (not patronymic and word in GIVEN_OF):
            return word
        if (word, patronymic) not in self.right:
            if len(self.right) > REMEMBER:
                self.right.clear()
            often = known.get(word, 0)
            meant = [(known[w], w) for w in self._near(word, patronymic) if often < RIVAL * known[w]]
            self.right[word, patronymic] = max(meant)[1] if meant else word
        return self.right[word, patronymic]


def _alphabet(ch: str) -> str:
    return "c" if "Ѐ" <= ch <= "ӿ" and ch.upper() in "АБВГҐДЕЄЖЗИІЇЙКЛМНОПРСТУФХЦЧШЩЬЮЯЫЭЪЁ" else "l" if ch.isascii() else "?"


class Judge:
    """Decides whether two parsed names may be the same; counts tell a typing error from another name."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts

    def _typo(self, a: str, b: str) -> bool:
        if a == b:
            return True
        few, many = sorted((self.counts.get(a, 0), self.counts.get(b, 0)))
        return min(len(a), len(b)) >= 4 and few < RIVAL * max(1, many) and near(a, b) or (few == many == 0 and min(len(a), len(b)) >= 4 and near(a, b))

    def given(self, a: str, b: str) -> bool:
        if a.endswith(".") or b.endswith("."):
            x, y = a.rstrip("."), b.rstrip(".")
            return any(p.startswith(q) or q.startswith(p) for p in self.forms(x, a) for q in self.forms(y, b))
        return bool(self.forms(a, a) & self.forms(b, b)) or self._typo(a, b) or any(self._typo(p, q) for p in self.forms(a, a) for q in self.forms(b, b))

    @staticmethod
    def forms(word: str, written: str) -> frozenset[str]:
        return frozenset((word,)) if written.endswith(".") else GIVEN_OF.get(word, frozenset((word,))) | {word}

    def same(self, a: tuple[str, ...], b: tuple[str, ...]) -> bool:
        if a[0] != b[0]:
            return False
        if a[0] == "o":
            return self._core(a[1:], b[1:])
        if not self.surname(a[1], b[1]):
            return False
        if not a[2] or not b[2] or not self.given(a[2], b[2]) or (len(a) > 4 and len(b) > 4 and a[4] != b[4]):
            return False
        if not a[3] or not b[3]:
            return True
        x, y = a[3].rstrip("."), b[3].rstrip(".")
        if a[3].endswith(".") or b[3].endswith("."):
            return x.startswith(y) or y.startswith(x)
        return self._typo(x, y)

    def surname(self, a: str, b: str) -> bool:
        if a == b or merged(a) == merged(b) or (min(len(a), len(b)) >= LEAST_WORD and near(a, b)):
            return True
        x, y = a.split("-"), b.split("-")
        return (len(x) > 1) != (len(y) > 1) and any(merged(p) == merged(q) or (min(len(p), len(q)) >= LEAST_WORD and near(p, q)) for p in x for q in y)

    def _core(self, a: tuple[str, ...], b: tuple[str, ...]) -> bool:
        x, y = (re.sub("[-.]", "", "".join(words)) for words in (a, b))
        if x == y or (min(len(x), len(y)) >= 8 and not any(w.endswith(".") for w in a + b) and len(a) != len(b) and near(x, y)):
            return True  # the same words, joined or parted
        if len(a) != len(b):
            return False
        left, errors = list(b), 0
        for word in sorted(a, key=len, reverse=True):
            for k, other in enumerate(left):
                x, y = word.rstrip("."), other.rstrip(".")
                if word.endswith(".") or other.endswith("."):
                    fits = min(len(x), len(y)) >= 3 and (x.startswith(y) or y.startswith(x))
                else:
                    fits = merged(x) == merged(y) or (min(len(x), len(y)) >= LEAST_WORD and self._typo(x, y))
                    errors += x != y if fits else 0
                if fits:
                    del left[k]
                    break
            else:
                return False
        return errors <= 2


def _key(parsed: tuple[str, ...]) -> str:
    return "|".join(parsed)


def _is_full(parsed: tuple[str, ...]) -> bool:
    return not any(w.endswith(".") for w in parsed) if parsed[0] == "o" else bool(parsed[2] and parsed[3]) and not (parsed[2] + parsed[3]).count(".")


def _segments(word: str) -> list[tuple[int, int]]:
    """Start and length of EDITS + 1 even parts."""
    n, parts = len(word), EDITS + 1
    cuts = [k * n // parts for k in range(parts + 1)]
    return [(cuts[k], cuts[k + 1] - cuts[k]) for k in range(parts)]


def index_keys(word: str) -> list[str]:
    return [f"{len(word)}:{k}:{word[s : s + n]}" for k, (s, n) in enumerate(_segments(word))] + [f"={word}"]


def probe_keys(word: str) -> set[str]:
    """Every index key that a word within one edit may have.

    An error in one of two segments leaves the other whole, so the first is looked up where the word begins and the second
    where it ends, at the position that a word of each possible length has it; a swap across the cut is looked up whole.
    """
    out = {f"={word}"}
    for n in range(max(1, len(word) - EDITS), len(word) + EDITS + 1):
        (_, first), (_, second) = _segments("x" * n)
        if len(word) >= max(first, second):
            out |= {f"{n}:0:{word[:first]}", f"{n}:1:{word[len(word) - second :]}"}
    for start, _ in _segments(word)[1:]:
        if start:
            out.add(f"={word[: start - 1]}{word[start]}{word[start - 1]}{word[start + 1 :]}")
    return out


def near_words(words: DataFrame) -> DataFrame:
    """(a, b) of all pairs of words of LEAST_WORD letters that one edit parts, once; ``words``: word, distinct, joined.

    Words that are ``joined`` from several (all of a firm's words without blanks) meet words that are not, and not each other: many
    firms share their last words, and only against a firm written as one word do joined ones matter.

    A word is cut into EDITS + 2 segments, of which an error leaves two whole, before it where they were and behind it moved by the
    difference in length; so two segments together make a key, and words that only share a common half never meet. A swap across
    a cut is looked up whole. The shorter of two words, or the smaller of equal length, is in the index. Keys are 64-bit
    hashes, everything is an expression, and levenshtein, which decides, is banded.
    """
    word, size = F.col("word"), F.length("word")
    key = lambda n, k, *parts: F.xxhash64(n, F.lit(k), *parts)
    one, two = (lambda n: F.floor(n / 3).cast("int")), (lambda n: F.floor(2 * n / 3).cast("int"))
    first = lambda n: F.substring(word, F.lit(1), n)
    last = lambda n: F.substring(word, size - n + 1, n)
    keys = lambda n: [key(n, 0, first(two(n))), key(n, 1, first(one(n)), last(n - two(n))), key(n, 2, last(n - one(n)))]
    swapped = lambda at: F.concat(first(at - 1), F.substring(word, at + 1, F.lit(1)), F.substring(word, at, F.lit(1)), F.substring(word, at + 2, size))
    long = words.where(size >= LEAST_WORD)
    index = long.select("joined", F.col("word").alias("a"), F.explode(F.array(*keys(size), key(size, 3, word))).alias("at"))
    probes = long.select("joined", F.col("word").alias("b"), F.explode(F.array(*keys(size), *keys(size - 1), key(size, 3, swapped(one(size))), key(size, 3, swapped(two(size))))).alias("at"))
    sides = (index.where("not joined"), probes), (index.where("joined"), probes.where("not joined"))
    met = reduce(DataFrame.unionByName, [join_split(x.drop("joined"), y.drop("joined"), "at", "a") for x, y in sides]).where((F.length("a") < F.length("b")) | (F.col("a") < F.col("b")))
    crossed = F.exists(F.sequence(F.lit(1), F.length("a") - 1), lambda i: F.concat(F.substring("a", F.lit(1), i - 1), F.substring("a", i + 1, F.lit(1)), F.substring("a", i, F.lit(1)), F.substring("a", i + 2, F.length("a"))) == F.col("b"))
    gap = F.levenshtein("a", "b", 2)
    return met.where((gap == 1) | ((gap == 2) & (F.length("a") == F.length("b")) & crossed)).select("a", "b").distinct()


def _blocks(parsed: tuple[str, ...], given_known: dict[str, int], patronymic_known: dict[str, int], firm: set[str]) -> list[tuple[str, list[str], list[str]]]:
    """(word, parts a name is filed under, parts it looks up) for each word of a name that others may misspell.

    Of two names that share a part beginning with f, o or c, both are filed under it and look it up.
    """
    if parsed[0] == "o":
        words = parsed[1:]
        heads = [w for w in words if not w.endswith(".") and w not in firm] or list(words)
        out = [(re.sub("[-.]", "", "".join(words)), ["c"], ["c"])]
        for h in dict.fromkeys(heads):
            rest = [w for w in words if w != h]
            # an error leaves the first or the last two letters of every other word whole, an abbreviation the first
            parts = [f"o{len(words)}<{w[:2]}" for w in rest] + [f"o{len(words)}>{w[-2:]}" for w in rest if not w.endswith(".")] or [f"o{len(words)}"]
            out += [(x, parts, parts) for x in dict.fromkeys((h.rstrip("."), merged(h.rstrip("."))))]
        return out
    if not parsed[2]:
        return []
    given, patronymic = parsed[2].rstrip("."), parsed[3].rstrip(".")
    spelt = not parsed[2].endswith(".")
    forms = GIVEN_OF.get(given, frozenset((given,))) if spelt else frozenset()
    firsts = {g[:1] for g in forms} | {given[:1]}
    new_given = spelt and given not in given_known and given not in GIVEN_OF
    if not patronymic:
        if spelt:
            own, look = ["S" + g for g in forms] + ["t" + g for g in firsts] + ["s" + given[:1]] * new_given, ["S" + g for g in forms] + ["s" + g for g in firsts]
        else:
            own, look = ["s" + given[:1]], ["s" + given[:1], "t" + given[:1]]
    elif spelt and not parsed[3].endswith("."):
        back, new_patronymic = merged(patronymic), patronymic not in patronymic_known
        full, one, other, both = [f"f{merged(g)}|{back}" for g in forms], ["P" + back], ["G" + merged(g) for g in forms], [f"I{g}{patronymic[:1]}" for g in firsts]
        own = full + one * new_given + other * new_patronymic + both * (new_given and new_patronymic)
        look = full + one + other + both + ["S" + g for g in forms] + ["s" + g for g in firsts] + ["t" + g for g in firsts] * new_given
    else:
        both = [f"I{g}{patronymic[:1]}" for g in firsts]
        own, look = both, both + ["S" + g for g in forms] + ["s" + g for g in firsts] + ["t" + given[:1]] * (not spelt)
    spellings = dict.fromkeys(x for s in (parsed[1], *(parsed[1].split("-") if "-" in parsed[1] else ())) for x in (s, merged(s)) if x)
    return [(x, own, look) for x in spellings]


def link(names: DataFrame, key: str = "entity_id", name: str = "name", lexicon_share: float = LEXICON_SHARE) -> DataFrame:
    """(key, group) for every key with a readable name; keys of one group are the same by their written names.

    ``names`` has one row a key and written name, repeats allowed; null, empty and damaged names (other alphabets, substitutes)
    are left out. Lexicons are counted over all names and bounded by ``lexicon_share``: given names and patronymics
    below it are compared as they stand, without correction of their typing errors. No cap limits candidates or groups.
    """
    spark = names.sparkSession
    ship(spark)
    written = stored(names.select(F.col(key).alias("id"), tidy(F.col(name)).alias("name")).where("name is not null and name != ''").distinct())
    sent = spark.sparkContext.broadcast(_lexicons(written, lexicon_share))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, seen = Parser(*sent.value), {}
        for batch in batches:
            out = []
            for x in batch.column(1).to_pylist():
                if x not in seen:
                    if len(seen) > REMEMBER:
                        seen.clear()
                    got = parser.parse(x)
                    seen[x] = _key(got) if got else None
                out.append(seen[x])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["id", "node"])

    kind = names.schema[key].dataType.simpleString()
    read_names = written.mapInArrow(read, f"id {kind}, node string").where("node is not null").select("id", F.xxhash64("node").alias("h"), "node")
    nodes = stored(read_names.distinct())
    discard(written)
    # a node is known by its hash; that no two nodes share one is checked here
    distinct = stored(nodes.groupBy("h").agg(F.min("node").alias("node"), F.max("node").alias("other")), clashes=F.sum((F.col("node") != F.col("other")).cast("int")))
    if distinct.seen["clashes"]:
        raise RuntimeError("two names have the same 64-bit hash")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, patronymic, firm = sent.value
        for batch in batches:
            rows = [(h, *block) for h, node in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for block in _blocks(tuple(node.split("|")), given, patronymic, firm)]
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.list_(pa.string())), pa.array(columns[3], pa.list_(pa.string()))], ["h", "word", "own", "look"])

    release(spark)  # between its steps, of some hundred jobs, the driver gives back what the last one took
    entries = stored(distinct.select("h", "node").mapInArrow(blocks, "h long, word string, own array<string>, look array<string>"))
    words = stored(entries.groupBy("word").agg(F.count("*").alias("n"), F.bool_and(F.col("own")[0] == "c").alias("joined")))
    ends = near_words(words)
    rank = lambda side: F.struct(F.col(f"n_{side}"), F.col(side))
    ends = ends.join(words.select(F.col("word").alias("a"), F.col("n").alias("n_a")), "a").join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b")
    anchors = stored(ends.select(F.when(rank("a") < rank("b"), F.col("a")).otherwise(F.col("b")).alias("word"), F.when(rank("a") < rank("b"), F.col("b")).otherwise(F.col("a")).alias("anchor")))
    discard(words)
    release(spark)
    # names under the rarer word of a near pair also look under its anchor, and are filed there for those that only look
    moved = join_split(entries, anchors, "word", "h").select("h", F.col("anchor").alias("word"), F.filter("own", lambda part: ~part.rlike("^[foc]")).alias("own"), "look", F.lit(True).alias("moved"))
    placed = entries.select("h", "word", "own", "look", F.lit(False).alias("moved")).unionByName(moved)
    side = lambda parts, h: placed.select("h", "word", "moved", F.explode(parts).alias("part")).select(F.col("h").alias(h), F.xxhash64("word", "part").alias("at"), F.col("moved").alias(f"{h}_moved"))
    met = join_split(side("own", "a"), side("look", "b"), "at", "a").where("a != b and not (a_moved and b_moved)")
    met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    spelt = distinct.select(F.col("h").alias("a"), F.col("node").alias("a_node")), distinct.select(F.col("h").alias("b"), F.col("node").alias("b_node"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, patronymic, _ = sent.value
        judge = Judge(given | patronymic)
        for batch in batches:
            rows = []
            for a, b, a_node, b_node in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = tuple(a_node.split("|")), tuple(b_node.split("|"))
                if judge.same(x, y):
                    x_full, y_full = _is_full(x), _is_full(y)
                    full = x if x_full else y
                    backs = full[0] == "p" and x_full != y_full and len(full[1]) > LEAST_WORD
                    rows.append((a, b, x_full, y_full, full[1] if backs else None, full[3] if backs else None, sorted(judge.forms(full[2], full[2])) if backs else None))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["a", "b", "a_full", "b_full", "surname", "patronymic", "forms"])

    links = met.join(spelt[0], "a").join(spelt[1], "b").select("a", "b", "a_node", "b_node")
    links = stored(links.mapInArrow(verify, "a long, b long, a_full boolean, b_full boolean, surname string, patronymic string, forms array<string>"))
    for done in (entries, anchors, distinct):
        discard(done)
    release(spark)
    halves = links.where("a_full != b_full").select(F.when(F.col("a_full"), F.col("b")).otherwise(F.col("a")).alias("short"), F.when(F.col("a_full"), F.col("a")).otherwise(F.col("b")).alias("node"), "surname", "patronymic", "forms")
    # full names that one short form fits may differ by twice the errors in the surname, and nowhere else
    fit = halves.where("surname is not null").select("short", "patronymic", F.explode("forms").alias("form"), "node", "surname")
    fit = fit.select(F.xxhash64("short", "patronymic", "form").alias("at"), "node", "surname")
    met = join_split(fit.select("at", F.col("node").alias("a"), F.col("surname").alias("x")), fit.select("at", F.col("node").alias("b"), F.col("surname").alias("y")), "at", "a")
    twice = met.where("a < b and x != y").where(F.levenshtein("x", "y", 4 * EDITS) > 0).select("a", "b", "x", "y").distinct()

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [near(x, y, 2 * EDITS) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sure = links.where("a_full and b_full").select("a", "b").unionByName(twice.mapInArrow(back, "a long, b long"))
    group = connected_components(sure, "a", "b").select(F.col("id").alias("node"), F.col("group_id").alias("group"))
    fits = halves.select("short", "node").join(group, "node", "left").select("short", "node", F.coalesce("group", "node").alias("group"))
    release(spark)
    fits = stored(fits.groupBy("short").agg((F.min("group") == F.max("group")).alias("one"), F.min("group").alias("group"), F.min("node").alias("node")))
    doubtful = fits.where("not one").select(F.col("short").alias("h"))
    open_ = links.where("not a_full and not b_full").select("a", "b")
    for side in ("a", "b"):  # two short forms link only where no full name fits either
        open_ = open_.join(fits.select(F.col("short").alias(side)), side, "left_anti")
    own = nodes.select("id", "h").join(doubtful, "h", "left_anti")
    first = stored(own.groupBy("id").agg(F.min("h").alias("first")))
    joined = own.join(first, "id").where("h != first").select(F.col("first").alias("a"), F.col("h").alias("b"))
    stars = group.where("node != group").select(F.col("group").alias("a"), F.col("node").alias("b"))  # what is linked already
    edges = stars.unionByName(fits.where("one").select(F.col("short").alias("a"), F.col("group").alias("b"))).unionByName(open_).unionByName(joined)
    found = connected_components(edges, "a", "b").select(F.col("id").alias("first"), "group_id")
    grouped = first.join(found, "first", "left").select(F.col("id").alias(key), F.coalesce("group_id", "first").alias("group"))
    alone = nodes.select("id").distinct().join(first, "id", "left_anti")  # all its names fit several persons: a group of its own
    found = stored(grouped.unionByName(alone.select(F.col("id").alias(key), F.xxhash64(F.lit("?"), "id").alias("group"))))  # else what reads groups twice runs all this twice
    for done in (nodes, links, fits, first):
        discard(done)
    release(spark)
    return found


def _lexicons(written: DataFrame, share: float) -> tuple[dict[str, int], dict[str, int], set[str]]:
    """Given names and patronymics with counts, and words that describe firms; at most 1 / ``share`` each."""

    def roles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name in batch.column(0).to_pylist():
                words = [letters(w) for w in re.findall(r"[^\W\d_]+(?:['-][^\W\d_]+)*", name)]
                if len(words) == 3 and not re.search(r"[.«»\"]", name) and _PATRONYMIC.search(words[2]):
                    out += [("g", words[1]), ("p", words[2])]
                if got := re.search(r"«([^»]+)»", name):
                    out += [("f", letters(w)) for w in re.findall(r"[^\W\d_]+(?:['-][^\W\d_]+)*", got[1])[1:]]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.string()), pa.array([b for _, b in out], pa.string())], ["role", "word"])

    counts = stored(written.select("name").mapInArrow(roles, "role string, word string").groupBy("role", "word").agg(F.count("*").alias("n")))
    totals = {r["role"]: r["n"] for r in counts.groupBy("role").agg(F.sum("n").alias("n")).collect()}
    keep = F.lit(False)
    for role, total in totals.items():
        keep = keep | ((F.col("role") == role) & (F.col("n") >= max(2, total * share)))
    rows = counts.where(keep).collect()
    discard(counts)
    of = lambda role: {r["word"]: r["n"] for r in rows if r["role"] == role}
    common = Parser(of("g"), {}, set())
    given = {k: v for k, v in common.given.items() if v >= 3 and common._corrected(k, False) == k}  # without typing errors
    return given, of("p"), {k for k, v in of("f").items() if v >= 3 and len(k) > 2}


def pairs(groups: DataFrame, key: str = "entity_id") -> DataFrame:
    """(key_a, key_b), key_a < key_b: all pairs within a group; groups of one give none."""
    several = groups.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group")
    rows = stored(groups.join(several, "group", "left_semi"))  # read three times below
    a, b = rows.select("group", F.col(key).alias(f"{key}_a")), rows.select("group", F.col(key).alias(f"{key}_b"))
    return join_split(a, b, "group", f"{key}_a").where(F.col(f"{key}_a") < F.col(f"{key}_b")).select(f"{key}_a", f"{key}_b")
