"""Text decoded with a wrong character encoding, found and restored.

Every distinct clean word of the corpus is written in all garbled forms that known chains of wrong decodings give; the
corpus tokens are hash-joined with these forms. A match whose original is the more frequent word is verified: its row
takes the original in its place. Words that occur only garbled (names, for the most part) have no entry in that table;
between and beside verified ones a two-state Viterbi pass finds how far the garbled passage runs, and undoes the chain
there, strictly, byte by byte.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import ship, stored

# Chains of wrong decodings, as (encoding the bytes were in, encoding they were read in) per step.
CHAINS = {
    "utf8>cp1251": [("utf-8", "cp1251")],
    "utf8>cp1252": [("utf-8", "cp1252")],
    "utf8>latin1": [("utf-8", "latin-1")],
    "utf8>cp1251 twice": [("utf-8", "cp1251"), ("utf-8", "cp1251")],
    "utf8>cp1252 twice": [("utf-8", "cp1252"), ("utf-8", "cp1252")],
    "utf8>cp866": [("utf-8", "cp866")],
    "utf8>koi8u": [("utf-8", "koi8-u")],
    "cp1251>cp1252": [("cp1251", "cp1252")],
    "cp1251>cp866": [("cp1251", "cp866")],
    "cp1251>koi8u": [("cp1251", "koi8-u")],
    "koi8u>cp1251": [("koi8-u", "cp1251")],
    "koi8u>cp1252": [("koi8-u", "cp1252")],
    "cp866>cp1251": [("cp866", "cp1251")],
    "cp866>cp1252": [("cp866", "cp1252")],
}
_UPPER, _LOWER = "А-ЩЬЮЯЄІЇҐ", "а-щьюяєіїґ"
CLEAN = rf"^«?[{_UPPER}]?[{_LOWER}'’ʼ-]+»?$|^«?[{_UPPER}'’ʼ-]+»?$"
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Bytes up to which a stored side of a join is broadcast; beyond, it is joined by a shuffle.
BROADCAST_BYTES = 32_000_000
_BLANKS = str.maketrans("\n\r\t", "   ", _PUNCTUATION)
_DROP = {ord(c): None for c in _PUNCTUATION + "\n\r\t"}
#: Letters that prove a garbled word at least.
LEAST_LETTERS = 4
#: Cost (natural log) of entering or leaving a garbled passage.
SWITCH = 6.0


def _read(data: bytes, encoding: str) -> str:
    """Decode; bytes that the code page leaves undefined become the control character of the same number."""
    try:
        return data.decode(encoding)
    except UnicodeDecodeError:
        return "".join(bytes([b]).decode(encoding, "replace").replace("�", chr(b)) for b in data)


def _write(text: str, encoding: str) -> bytes | None:
    """Encode, control characters as their own byte; None where a character has none."""
    try:
        return text.encode(encoding)
    except UnicodeEncodeError:
        out = bytearray()
        for ch in text:
            try:
                out += ch.encode(encoding)
            except UnicodeEncodeError:
                if not 0x80 <= ord(ch) < 0xA0:
                    return None
                out.append(ord(ch))
        return bytes(out)


def garble(text: str, chain: str) -> str | None:
    """The text as the chain garbles it, or None where it can't be written in the first encoding."""
    for was, read in CHAINS[chain]:
        data = _write(text, was)
        if data is None:
            return None
        text = _read(data, read)
    return text


def restore(text: str, chain: str) -> str | None:
    """The only text that the chain garbles to ``text``, or None."""
    for was, read in reversed(CHAINS[chain]):
        data = _write(text, read)
        if data is None:
            return None
        try:
            text = data.decode(was)
        except UnicodeDecodeError:
            return None
    return text


def tokens(text: Column) -> Column:
    """Tokens between ASCII blanks that hold a character beyond ASCII; ASCII punctuation, which no chain changes, left out."""
    bare = F.translate(text, "\n\r\t" + _PUNCTUATION, "   ")
    return F.filter(F.split(bare, " "), lambda t: t.rlike(r"[^\x00-\x7f]"))


def _tables() -> list[tuple[str, dict[int, str], frozenset[str]]]:
    """Chain, garbled form of each character of clean words, and those characters that the chain can't write."""
    alphabet = "".join(chr(c) for c in range(0x410, 0x450)) + "ЄІЇҐєіїґ«»’ʼ'-"
    out = []
    for chain in CHAINS:
        forms = {ord(c): garble(c, chain) for c in alphabet}
        out.append((chain, {k: v for k, v in forms.items() if v is not None}, frozenset(chr(k) for k, v in forms.items() if v is None)))
    return out


def _forms(words: DataFrame) -> DataFrame:
    """(token, chain, letters, word_n) for every garbled form of every clean word; every chain garbles letter by letter."""
    chains, names = _tables(), list(CHAINS)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            raised = [(w.upper(), k) for w, k in zip(plain, n, strict=True) if w.upper() != w]
            words, counts = plain + [w for w, _ in raised], n + [k for _, k in raised]
            letters = [sum(c.isalpha() for c in w) for w in words]
            for chain, table, lacks in chains:
                at = [k for k, w in enumerate(words) if lacks.isdisjoint(w)] if lacks else range(len(words))
                forms = "\n".join([words[k] for k in at]).translate(table).split("\n") if len(at) else []
                if len(forms) != len(at):  # a form that holds a line break
                    forms = [words[k].translate(table) for k in at]
                yield pa.RecordBatch.from_arrays([pa.array(forms, pa.string()), pa.array([names.index(chain)] * len(at), pa.int8()), pa.array([letters[k] for k in at], pa.int32()), pa.array([counts[k] for k in at], pa.int64())], ["token", "chain", "letters", "word_n"])

    return words.select("token", "n").mapInArrow(write, "token string, chain byte, letters int, word_n long")


def _bigrams(words: DataFrame) -> dict[str, float]:
    """Log probabilities of character pairs in clean words; bounded by the square of the Ukrainian alphabet."""
    padded = F.concat(F.lit(" "), F.col("token"), F.lit(" "))
    pairs = F.transform(F.sequence(F.lit(1), F.length("token") + 1), lambda k: F.substring(padded, k, F.lit(2)))
    rows = words.select(F.explode(pairs).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    total: dict[str, int] = {}
    for r in rows:
        total[r["pair"][0]] = total.get(r["pair"][0], 0) + r["n"]
    return {r["pair"]: math.log(r["n"] / total[r["pair"][0]]) for r in rows}


class Restorer:
    """Undoes a chain inside a value, only where its words are garbled."""

    def __init__(self, model: dict[str, float]):
        self.model = model | {k: v for sign in "№–—" for k, v in ((f" {sign}", -3.0), (f"{sign} ", -0.5))}

    def _score(self, token: str) -> float:
        word = token.translate(_DROP)
        if word.isascii():
            return 0.0
        word = f" {word} "
        return sum(self.model.get(word[k : k + 2], -14.0) for k in range(len(word) - 1))

    def __call__(self, text: str, chain: str, verified: frozenset[str] = frozenset()) -> str:
        """The text with the chain undone; ``verified`` tokens are replaced by their originals, what else is is decided here."""
        parts = text.split(" ")
        states = [(0.0, None), (SWITCH, None)]  # cost and path: as it stands, garbled
        for part in parts:
            form = part if part.isascii() else restore(part, chain)
            stands = -self._score(part)
            garbled = math.inf if form is None else -self._score(form)
            if form is not None and form != part and not verified.isdisjoint(token for token in part.translate(_BLANKS).split(" ")):
                stands = math.inf
            a, b = states
            stay = min((a[0], 0, a), (b[0] + SWITCH, 1, b), key=lambda x: x[0])
            into = min((b[0], 1, b), (a[0] + SWITCH, 0, a), key=lambda x: x[0])
            states = [(stay[0] + stands, (stay[2][1], part)), (into[0] + garbled, (into[2][1], form))]
        path = min(states[0], (states[1][0], states[1][1]), key=lambda x: x[0])[1]
        out = []
        while path:
            out.append(path[1])
            path = path[0]
        return " ".join(reversed(out))


def lost(text: Column) -> Column:
    """Whether letters were replaced by a substitute character: U+FFFD, or question marks that stand for words."""
    return text.contains("�") | text.rlike(r"\?{4,}|(?:^|[\s«(\"])\?+[»)\",;:]*\s+(?:№?\s*[\d/.,]+\s+)?[«(\"]?\?+(?:[\s».,;:)\"-]|$)")


def _bounded(side: DataFrame, broadcast_bytes: int) -> DataFrame:
    """A stored side of a join, its bytes added up in ``bytes``, broadcast if it is small."""
    return F.broadcast(side) if (side.seen["bytes"] or 0) <= broadcast_bytes else side


def restored(values: DataFrame, least_letters: int = LEAST_LETTERS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(field, row_id, restored) of every garbled value; ``values``: field, row_id, text.

    ``restored`` is the whole original value, or null where substitutes replaced letters, which are lost. Clean, empty and
    null values give no row; repeated rows repeat their result. (field, row_id) should name one row. All statistics cover
    all values; the garbled forms are joined by a shuffle, as neither side has a bound; matches go back to their rows by
    broadcast up to ``broadcast_bytes``, by a shuffle beyond. A row whose verified words have fewer than ``least_letters`` letters
    together under a chain stays as it is.
    """
    ship(values.sparkSession)
    gone = lost(F.col("text"))
    exploded = values.where(F.col("text").rlike(r"[^\x00-\x7f]") & ~gone).select("field", "row_id", F.explode(tokens(F.col("text"))).alias("token"))
    counted = stored(exploded.groupBy("token").agg(F.count("*").alias("n")))
    clean = counted.where(F.col("token").rlike(CLEAN))
    # both sides go by a 64-bit hash; what a collision might let in is undone strictly later or not at all
    matched = _forms(clean).select(F.xxhash64("token").alias("h"), "chain", "letters", "word_n").join(counted.select(F.xxhash64("token").alias("h"), "n"), "h").where(F.col("word_n") > F.col("n"))
    # of several readings of a token under one chain the most frequent word proves it
    evidence = matched.groupBy("h", "chain").agg(F.max(F.struct("word_n", "letters")).alias("best")).select("h", "chain", F.col("best.letters").alias("letters"), F.col("best.word_n").alias("weight"))
    evidence = _bounded(stored(evidence, bytes=F.count("*") * 40), broadcast_bytes)
    model = _bigrams(clean.where("n > 1").withColumn("h", F.xxhash64("token")).join(evidence.select("h"), "h", "left_anti"))
    # a few letters that would do for an abbreviation are evidence, but not replaced without a look at what stands beside them
    sure = ~F.col("token").rlike(CLEAN) | (F.length("token") >= LEAST_LETTERS)
    rows = exploded.withColumn("h", F.xxhash64("token")).join(evidence, "h").groupBy("field", "row_id", "chain").agg(F.sum("letters").alias("letters"), F.sum("weight").alias("weight"), F.collect_set(F.when(sure, F.col("token"))).alias("tokens"))
    rows = rows.where(F.col("letters") >= least_letters).groupBy("field", "row_id").agg(F.sort_array(F.collect_list(F.struct("letters", "weight", "chain", "tokens")), asc=False).alias("found"))
    rows = rows.select("field", "row_id", F.col("found.chain").alias("chains"), F.col("found.tokens").alias("tokens"))
    pending = values.join(_bounded(stored(rows, bytes=F.sum(F.aggregate("tokens", F.lit(100).cast("long"), lambda n, part: n + 40 + F.aggregate(part, F.lit(0).cast("long"), lambda m, t: m + 40 + F.octet_length(t))))), broadcast_bytes), ["field", "row_id"]).select("field", "row_id", "text", "chains", "tokens")
    names = list(CHAINS)

    def undo(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fix = Restorer(model)
        for batch in batches:
            kept = []
            for field, row_id, text, chains, tokens_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                done = text
                for chain, own in zip(chains, tokens_, strict=True):
                    done = fix(done, names[chain], frozenset(own))
                if done != text:
                    kept.append((field, row_id, done))
            columns = list(zip(*kept, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["field", "row_id", "restored"])

    fixed = pending.mapInArrow(undo, "field string, row_id long, restored string")
    return fixed.unionByName(values.where(F.coalesce(gone, F.lit(False))).select("field", "row_id", F.lit(None).cast("string").alias("restored")))


def restored_md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()
