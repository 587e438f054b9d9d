"""Text that looks the same brought to one form.

Compatibility forms that only differ in width or breaking are folded, ignorable characters deleted, accents composed and
every letter that has a look-alike reduced to its class. A word of classes is then a lattice: each position may be
the Latin, Cyrillic or Greek letter. Viterbi picks the reading with the fewest changes of script and, among those, the best
character bigram score counted over the whole corpus. The reading depends on the classes alone, so two
texts come out equal exactly when they look the same.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import join_split
from millrace.session import ship, stored

# Letters that look alike, as Latin, Cyrillic, Greek ("." where an alphabet has none).
ALIKE = """
aа. cс. eе. iі. jј. oоο pр. sѕ. xх. yу. hһ. qԛ. wԝ. dԁ.
AАΑ BВΒ CС. EЕΕ HНΗ IІΙ JЈ. KКΚ MМΜ N.Ν OОΟ PРΡ SЅ. TТΤ XХΧ YҮΥ Z.Ζ QԚ. WԜ.
"""
# Variants of the apostrophe and of the hyphen.
APOSTROPHES = "‘’‛ʼʹʻʽˈ՚′´`＇ꞌ"
HYPHENS = "‐‑‒−﹣－˗"
LATIN, CYRILLIC, GREEK = 0, 1, 2
#: Letters of the bigram model; others count as one class.
MODEL_LETTERS = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x180), *range(0x391, 0x3CA), *range(0x400, 0x460), 0x490, 0x491) if chr(c).isalpha()]
#: Distinct tokens a worker remembers before it starts anew.
REMEMBER = 200_000


def _script(ch: str) -> int:
    return CYRILLIC if "Ѐ" <= ch <= "ԯ" else GREEK if "Ͱ" <= ch <= "Ͽ" else LATIN


def _classes() -> tuple[dict[str, str], dict[str, tuple]]:
    """letter -> its class (the first letter of it), class -> (Latin, Cyrillic, Greek) letter."""
    to, of = {}, {}
    for group in ALIKE.split():
        first = next(c for c in group if c != ".")
        of[first] = tuple(None if c == "." else c for c in group)
        to |= {c: first for c in group if c != "."}
    for code in (*range(0xC0, 0x250), *range(0x386, 0x460), *range(0x1E00, 0x2000)):  # accented letters follow their base
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0] in to:
            base = unicodedata.normalize("NFC", to[parts[0]] + parts[1:])
            if len(base) == 1:
                options = [unicodedata.normalize("NFC", x + parts[1:]) if x else None for x in of[to[parts[0]]]]
                to[chr(code)] = base
                of[base] = tuple(x if x and len(x) == 1 else None for x in options)
    return to, of


TO_CLASS, OF_CLASS = _classes()


def _folding() -> dict[int, str | None]:
    """One translation: width and no-break forms to plain ones, blanks to a space, ignorable characters away, letters to classes."""
    table: dict[int, str | None] = {}
    for code in (*range(0x80, 0x10000), *range(0x1D400, 0x1D800), *range(0xE0000, 0xE01F0)):
        ch = chr(code)
        kind = unicodedata.category(ch)
        if 0xD800 <= code < 0xE000:
            continue
        if kind == "Cf" or code in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0xFE00 <= code < 0xFE10 or 0x180B <= code < 0x180E or 0xE0100 <= code:
            table[code] = None
        elif kind == "Zs":
            table[code] = " "
        elif unicodedata.decomposition(ch).split(" ")[0] in ("<wide>", "<narrow>", "<noBreak>", "<font>"):
            table[code] = unicodedata.normalize("NFKC", ch)
    table |= {ord(c): "'" for c in APOSTROPHES} | {ord(c): "-" for c in HYPHENS}
    for code, to in list(table.items()):
        if to and to in TO_CLASS:
            table[code] = TO_CLASS[to]
    return table | {ord(c): to for c, to in TO_CLASS.items() if c != to}


_FOLD = _folding()
_READ = [{ord(c): x[s] for c, x in OF_CLASS.items() if x[s]} for s in range(3)]
_LACKS = [{c for c, x in OF_CLASS.items() if not x[s]} for s in range(3)]
_MARKS = re.compile("[̀-ͯ]")


def skeleton(text: str) -> str:
    """The text as a sequence of look-alike classes; equal for two texts exactly when they look the same."""
    out = text.translate(_FOLD)
    if _MARKS.search(out):
        out = unicodedata.normalize("NFC", out).translate(_FOLD)
    return out


class Reader:
    """Reads class sequences as words of one script; ``model``: log scores of letter bigrams."""

    def __init__(self, model: dict[str, float], floor: float):
        self.model, self.floor, self.seen = model, floor, {}

    def viterbi(self, word: str, start: int | None = None) -> tuple[str, int]:
        """The best reading of a class sequence and the script it ends in: fewest script changes, then the best score."""
        states: dict[tuple[int, str], tuple[int, float, str]] = {(-1 if start is None else start, ""): (0, 0.0, "")}
        for ch in word:
            if not ch.isalpha():
                states = {k: (n, s, t + ch) for k, (n, s, t) in states.items()}
                continue
            options = [(i, c) for i, c in enumerate(OF_CLASS[ch]) if c] if ch in OF_CLASS else [(_script(ch), ch)]
            after: dict[tuple[int, str], tuple[int, float, str]] = {}
            for (script, before), (n, s, t) in states.items():
                for to, c in options:
                    got = (n + (script not in (-1, to)), s - self.model.get(before + c, self.floor), t + c)
                    if (to, c) not in after or got < after[to, c]:
                        after[to, c] = got
            states = after
        (script, _), best = min(states.items(), key=lambda x: x[1])
        return best[2], script

    def _token(self, token: str) -> tuple[str, str, str, int]:
        """Readings of a token after no, Latin and Cyrillic context, and the script it leaves (-1: as before)."""
        words, plain = skeleton(token), [[], [], []]
        sure = {_script(c) for c in words if c not in OF_CLASS and c.isalpha()}
        if len(sure) == 1 and not words.isspace() and len(words.split()) == 1:
            (script,) = sure
            if not _LACKS[script].intersection(words):  # the only reading without a change of script, so Viterbi's
                text = words.translate(_READ[script])
                return text, text, text, script
        left = [-1, LATIN, CYRILLIC]
        fixed = -1
        for piece in re.split(r"(\s+)", words):
            sure = {_script(c) for c in piece if c.isalpha() and c not in OF_CLASS}
            for k in range(3):
                text, script = self.viterbi(piece, None if sure or left[k] < 0 else left[k])
                plain[k].append(text)
                if sure and script >= 0:
                    left[k] = fixed = script
        return "".join(plain[0]), "".join(plain[1]), "".join(plain[2]), fixed

    def read(self, text: str) -> str:
        """The one form of a text; words that could be of either script follow the word before them."""
        out, last, seen = [], -1, self.seen
        for token in text.split(" "):
            if token.isascii() and token.lower() == token.upper():
                out.append(token)
                continue
            got = seen.get(token)
            if got is None:
                if len(seen) > REMEMBER:
                    seen.clear()
                got = seen[token] = self._token(token)
            out.append(got[last + 1 if last < GREEK else 0])
            if got[3] >= 0:
                last = got[3]
        return " ".join(out)


def bigram_model(docs: DataFrame, text: str = "text") -> tuple[dict[str, float], float]:
    """Log scores of letter bigrams within one script over all texts; the table is bounded by the letters squared."""
    size = len(MODEL_LETTERS) + 1
    number = np.zeros(0x10000, np.int32)
    for i, ch in enumerate(MODEL_LETTERS):
        number[ord(ch)] = i + 1
    kind = np.array([-1, *(_script(c) for c in MODEL_LETTERS)])
    same = (kind[:, None] == kind[None, :]) & (kind[:, None] >= 0) | (kind[:, None] < 0) & (kind[None, :] >= 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            whole = "\n".join(x for x in batch.column(0).to_pylist() if x)
            codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
            at = number[np.minimum(codes, 0xFFFF)]
            total += np.bincount(at[:-1] * size + at[1:], minlength=size * size) if len(at) > 1 else 0
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["pair", "n"])

    rows = docs.select(text).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = {r["pair"]: r["n"] for r in rows if same.flat[r["pair"]]}
    of_script = {s: sum(n for p, n in counts.items() if kind[p % size] == s) for s in (LATIN, CYRILLIC, GREEK)}
    letters = ["", *MODEL_LETTERS]
    model = {letters[p // size] + letters[p % size]: math.log(n / of_script[int(kind[p % size])]) for p, n in counts.items()}
    return model, -math.log(max([2, *of_script.values()])) - 1


def canonical(docs: DataFrame, key: str = "doc_id", text: str = "text", model: tuple[dict[str, float], float] | None = None, digests: bool = False) -> DataFrame:
    """(key, canonical) for every row, or with ``digests`` (key, raw, form): MD5 of the stored and of the one form.

    A null text stays null, an empty one empty; texts are read whole. Other columns are not read. The bigram model
    (bounded by the alphabet) is counted over all texts unless given.
    """
    ship(docs.sparkSession)
    scores, floor = model or bigram_model(docs, text)
    sent = docs.sparkSession.sparkContext.broadcast((scores, floor))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(*sent.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            forms = [None if x is None else reader.read(x) for x in texts]
            if digests:
                md5 = lambda xs: pa.array([None if x is None else hashlib.md5(x.encode("utf-8", "surrogatepass")).digest() for x in xs], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), md5(texts), md5(forms)], [key, "raw", "form"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(forms, pa.string())], [key, "canonical"])

    kind = docs.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, " + ("raw binary, form binary" if digests else "canonical string")
    return docs.select(key, text).mapInArrow(read, out)


def same_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, representative, size, texts) of every document with a text: the least key of those that look like it, how many they
    are, and how many different texts they hold as stored. One row a document however large the groups; null texts have none."""
    marks = stored(canonical(docs, key, text, digests=True).where("form is not null"))
    by_text = marks.groupBy("form", "raw").agg(F.min(key).alias("least"), F.count("*").alias("n"))
    groups = by_text.groupBy("form").agg(F.min("least").alias("representative"), F.sum("n").alias("size"), F.count("*").alias("texts"))
    return marks.join(groups, "form").select(key, "representative", "size", "texts")


def same_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key_a, key_b), key_a < key_b: documents stored differently that look the same; null texts pair with nothing.

    Only documents whose form has at least two stored texts reach the pair join, exact copies never meet in it, and the
    rows of a form that many documents have are dealt out to many tasks.
    """
    marks = stored(canonical(docs, key, text, digests=True).where("form is not null"))
    shared = marks.groupBy("form").agg((F.min("raw") != F.max("raw")).alias("several")).where("several").select("form")
    rows = marks.join(shared, "form", "left_semi")
    a = rows.select("form", F.col("raw").alias("raw_a"), F.col(key).alias(f"{key}_a"))
    b = rows.select("form", F.col("raw").alias("raw_b"), F.col(key).alias(f"{key}_b"))
    return join_split(a, b, "form", f"{key}_a").where((F.col("raw_a") != F.col("raw_b")) & (F.col(f"{key}_a") < F.col(f"{key}_b"))).select(f"{key}_a", f"{key}_b")
