"""Held-out test passages inside a training corpus, found through an FM-index per shard of the corpus.

Words are compared without case, punctuation and look-alike characters. A shard holds the words of some documents as
numbers: a word of the test vocabulary has its own, any other is a separator that no phrase can cross. Its suffixes are
sorted, its Burrows-Wheeler transform is kept in a wavelet matrix, and a sample of suffix positions serves to locate rows.
All test phrases are searched backwards at once through wavelet ranks. Whole runs of ``run`` words are hits at
once; hits of single words propose windows that hold enough of an item's words in any order, which no passage can miss, and
an exact longest-common-subsequence count then accepts them or not.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.confusables import skeleton
from millrace.session import ship, stored

#: Words per shard; bounds a worker's index to about 100 bytes a word.
SHARD_WORDS = 400_000
#: Characters of test items that are sent to workers at once; more items take more passes, each written before the next.
BLOCK_CHARS = 32_000_000
#: Every SAMPLE-th suffix position is kept.
SAMPLE = 4
_NOT_WORD = re.compile(r"[^\w№]+|_")
# Small letters whose capitals look like another alphabet's, and that alphabet's small letter.
_CAPITALS_ALIKE = str.maketrans("внмткζν", "bhmtkzn")


def plain_word(token: str) -> str:
    """A word without case, punctuation, look-alike and invisible characters; '' for what is no word."""
    return _NOT_WORD.sub("", skeleton(token).lower()).translate(_CAPITALS_ALIKE)


def plain_words(text: str) -> list[str]:
    return [w for w in map(plain_word, text.split()) if w]


class Bits:
    """A packed bit sequence and how many ones lie before a place: 0.2 bytes a bit."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate((packed, np.zeros(16 - len(packed) % 8, np.uint8))).view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words[:-1]), dtype=np.int32)))
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


class WaveletMatrix:
    """A sequence of symbols as bit levels: ranks of symbols, that is how often c occurs before a place, and the symbols."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = ((symbols >> level) & 1).astype(bool)
            self.levels.append(Bits(bit))
            self.zeros.append(len(bit) - self.levels[-1].ones)
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def rank(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(at), at
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            one = ((c >> level) & 1).astype(bool)
            low_one, high_one = self.levels[k].rank(low), self.levels[k].rank(high)
            low, high = np.where(one, self.zeros[k] + low_one, low - low_one), np.where(one, self.zeros[k] + high_one, high - high_one)
        return high - low

    def step(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at places, and how often each occurs before its place."""
        c, low, high = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), at
        for bits, zeros in zip(self.levels, self.zeros, strict=True):
            one = bits.get(high)
            low_one, high_one = bits.rank(low), bits.rank(high)
            low, high = np.where(one, zeros + low_one, low - low_one), np.where(one, zeros + high_one, high - high_one)
            c = c << 1 | one
        return c, high - low


def suffix_order(words: np.ndarray, bits: int) -> np.ndarray:
    """Suffixes in order; 0 is a separator, smaller than all words, and two separators compare by position."""
    n, per = len(words), max(1, 60 // bits)
    key, open_, padded = np.zeros(n, np.int64), np.ones(n, bool), np.concatenate((words, np.zeros(per, words.dtype)))
    for k in range(per):
        part = padded[k : k + n]
        key = (key << bits) | np.where(open_, part, 0)
        open_ &= part > 0
    order = np.argsort(key, kind="stable")
    rank = np.empty(n + 1, np.int64)
    starts = np.ones(n, bool)
    starts[1:] = (key[order[1:]] != key[order[:-1]]) | ~open_[order[1:]]
    head = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    rank[order], rank[n] = head, -1
    step = per
    while True:
        tied = np.flatnonzero(~(starts & np.append(starts[1:], True)))  # rows in groups of more than one
        if not len(tied):
            return order
        rows = order[tied]
        then = rank[np.minimum(rows + step, n)]
        again = np.lexsort((then, head[tied]))
        order[tied], then = rows[again], then[again]
        fresh = np.ones(len(tied), bool)
        fresh[1:] = (head[tied][1:] != head[tied][:-1]) | (then[1:] != then[:-1])
        starts[tied] = fresh
        head = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
        rank[order] = head
        step *= 2


class FMIndex:
    """Backward search and location of phrases in a sequence of word numbers with 0 as separator."""

    def __init__(self, words: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols).bit_length())
        order = suffix_order(words, self.bits)
        before = words[order - 1]
        before[order == 0] = 0
        self.tree = WaveletMatrix(before, self.bits)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(words, minlength=symbols + 1))))
        kept = (order % SAMPLE == 0) | (before == 0)  # a walk back never has to cross a separator
        self.kept, self.position = Bits(kept), order[kept].astype(np.int32)
        self.n = len(words)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that start with each phrase (one a line, equal lengths)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[:, k]
            low, high = self.first[c] + self.tree.rank(c, low), self.first[c] + self.tree.rank(c, high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of rows: each walks back by one word until a row whose place is kept."""
        at, open_, walk, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), rows, 0
        while len(open_):
            done = self.kept.get(walk)
            at[open_[done]] = self.position[self.kept.rank(walk[done])] + steps
            open_, walk, steps = open_[~done], walk[~done], steps + 1
            c, before = self.tree.step(walk)
            walk = self.first[c] + before
        return at


class Items:
    """Test items as word numbers, with their distinct runs of ``run`` words and the places of each word."""

    def __init__(self, items: list[tuple[int, str]], run: int):
        self.ids, words = [i for i, _ in items], [plain_words(t) for _, t in items]
        self.number = {w: k + 1 for k, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.words = [np.array([self.number[w] for w in ws], np.int64) for ws in words]
        self.run, self.runs = run, self._grams(run)
        self.bits = []
        for ws in self.words:
            bits: dict[int, int] = {}
            for p, w in enumerate(ws.tolist()):
                bits[w] = bits.get(w, 0) | 1 << p
            self.bits.append(bits)

    def _grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct phrases; where each one's occurrences start in (item, place)."""
        at: dict[tuple, list[tuple[int, int]]] = {}
        for k, ws in enumerate(self.words):
            for p in range(len(ws) - n + 1):
                at.setdefault(tuple(ws[p : p + n].tolist()), []).append((k, p))
        phrases = np.array(list(at), np.int64).reshape(len(at), n)
        pairs = np.array([x for xs in at.values() for x in xs], np.int64).reshape(-1, 2)
        return phrases, np.concatenate(([0], np.cumsum([len(x) for x in at.values()], dtype=np.int64))), pairs[:, 0], pairs[:, 1]


def _common(bits: dict[int, int], m: int, passage: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    full = (1 << m) - 1
    v = full
    for w in passage:
        u = v & bits.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return m - v.bit_count()


def _shortest(bits: dict[int, int], m: int, passage: list[int], least: int) -> int:
    """How many first words of a passage have a common subsequence of ``least`` words with the item."""
    full = (1 << m) - 1
    v = full
    for k, w in enumerate(passage, 1):
        u = v & bits.get(w, 0)
        v = ((v + u) | (v - u)) & full
        if m - v.bit_count() >= least:
            return k
    return len(passage)


def _found(index: FMIndex, grams: tuple, doc_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All places of the phrases: document, item, place in the shard, place in the item."""
    phrases, starts, item, place = grams
    if not len(phrases):
        return (np.zeros(0, np.int64),) * 4
    low, high = index.search(phrases)
    many = high - low
    gram = np.repeat(np.arange(len(phrases)), many)
    at = index.locate(np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many))
    uses = (starts[1:] - starts[:-1])[gram]
    which = np.arange(uses.sum()) - np.repeat(np.cumsum(uses) - uses, uses) + np.repeat(starts[gram], uses)
    at = np.repeat(at, uses)
    return doc_of[at], item[which], at, place[which]


def _held(index: FMIndex, items: Items, words: np.ndarray, doc_of: np.ndarray, first: np.ndarray, end: np.ndarray, keep: float) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, first word, last word + 1) of passages that keep ``keep`` of an item's words in order.

    A passage has room for half as many words again as the item. Its start is tried wherever such a window holds enough of
    the item's words, each as often as the item at most; as a window that moves by a word gains one at most, a window that
    lacks k words moves by k.
    """
    low, high = index.search(np.arange(1, len(items.number) + 1).reshape(-1, 1))
    many = high - low
    starts = np.concatenate(([0], np.cumsum(many)))
    at = index.locate(np.arange(many.sum()) - np.repeat(starts[:-1], many) + np.repeat(low, many))
    at = at[np.lexsort((at, np.repeat(np.arange(len(many)), many)))]
    for i, own in enumerate(items.words):
        m = len(own)
        if not m:
            continue
        least, width, bits = max(1, math.ceil(keep * m - 1e-9)), m + m // 3 + m // 6 + 4, items.bits[i]
        places, before = [], []
        for w, often in zip(*np.unique(own, return_counts=True), strict=True):
            here = at[starts[w - 1] : starts[w]]
            places.append(here)
            before.append(np.concatenate((np.full(min(often, len(here)), -1), here[:-often])))
        place, used = np.concatenate(places), np.concatenate(before)
        if len(place) < least:
            continue
        since = np.maximum(np.maximum(used + 1, place - width + 1), first[doc_of[place]])  # windows that start here to there count this hit
        change = np.bincount(since, minlength=len(words) + 1) - np.bincount(place + 1, minlength=len(words) + 1)
        good = np.flatnonzero(np.cumsum(change) >= least).tolist()
        back = {w: int(f"{b:0{m}b}"[::-1], 2) for w, b in bits.items()}
        k = 0
        while k < len(good):
            a = good[k]
            d = int(doc_of[a])
            stop = int(end[d])
            passage = words[a : min(stop, a + width)].tolist()
            got = _common(bits, m, passage)
            if got < least:
                k = bisect_left(good, min(a + least - got, stop), k + 1)
                continue
            a += len(passage) - _shortest(back, m, passage[::-1], got)
            passage = words[a : min(stop, a + width)].tolist()
            z = a + _shortest(bits, m, passage, _common(bits, m, passage))
            yield d, i, a, z
            k = bisect_left(good, z, k + 1)


def search_shard(docs: list[list[int]], items: Items, keep: float) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, first word, last word + 1) of merged passages; documents are word-number lists."""
    lengths = np.array([len(d) + 1 for d in docs])
    words = np.array([x for d in docs for x in (*d, 0)], np.int64)
    doc_of, first = np.repeat(np.arange(len(docs)), lengths), np.cumsum(lengths) - lengths
    index = FMIndex(words, len(items.number))
    spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
    doc, item, at, _ = _found(index, items.runs, doc_of)
    for d, i, a in zip(doc.tolist(), item.tolist(), at.tolist(), strict=True):
        spans.setdefault((d, i), []).append((a - int(first[d]), a - int(first[d]) + items.run))
    for d, i, a, z in _held(index, items, words, doc_of, first, first + lengths - 1, keep):
        spans.setdefault((d, i), []).append((a - int(first[d]), z - int(first[d])))
    for (d, i), found in spans.items():
        found.sort()
        a, z = found[0]
        for x, y in found[1:]:
            if x > z:
                yield d, i, a, z
                a = x
            z = max(z, y)
        yield d, i, a, z


def leaked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", run: int = 14, keep: float = 2 / 3, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(key, item, start, end): merged character spans of each document that hold an item wholly or partly.

    A span holds ``run`` consecutive words of the item, or a passage that keeps ``keep`` of all its words in order. Null and
    empty texts hold and are nothing; repeated rows give repeated results. Items of up to BLOCK_CHARS characters are
    searched in one pass over the texts; more take a pass for each such block, whose result is stored before the next
    block is read, so neither workers nor driver hold more than a block.
    """
    spark = docs.sparkSession
    ship(spark)
    tests = items.where(F.col(item_text).isNotNull()).select(item, item_text)
    sizes = tests.agg(F.count("*").alias("n"), F.sum(F.length(item_text)).alias("chars")).first()
    search = lambda rows: _leaked_block(docs, Items(rows, run), key, text, item, items.schema[item].dataType.simpleString(), keep)
    if (sizes["chars"] or 0) <= block_chars:
        return search(sorted((tuple(r) for r in tests.collect()), key=lambda r: r[0]))
    parts, held, chars = [], [], 0
    for row in tests.orderBy(item).toLocalIterator():
        if held and chars + len(row[1]) > block_chars:
            parts.append(stored(search(held)))
            held, chars = [], 0
        held.append(tuple(row))
        chars += len(row[1])
    parts.append(stored(search(held)))
    return reduce(DataFrame.unionByName, parts)


def _leaked_block(docs: DataFrame, block: Items, key: str, text: str, item: str, item_type: str, keep: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests: Items = sent.value
        number: dict[str, int] = {}
        ids: list = []
        texts: list[str] = []
        lists: list[list[int]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            out = []
            for d, i, a, z in search_shard(lists, tests, keep):
                places = [m.span() for m in re.finditer(r"\S+", texts[d]) if number.get(m.group(), 0) >= 0]
                out.append((ids[d], tests.ids[i], places[a][0], places[z - 1][1]))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], key_type), pa.array(columns[1], pa.int64() if item_type == "bigint" else None), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())], [key, item, "start", "end"])

        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not t:
                    continue
                tokens = t.split()
                got = [number.get(w) for w in tokens]
                if None in got:
                    if len(number) > 300_000:
                        number.clear()
                    for j, x in enumerate(got):
                        if x is None:
                            word = plain_word(tokens[j])
                            got[j] = number[tokens[j]] = tests.number.get(word, 0) if word else -1
                if -1 in got:
                    got = [x for x in got if x >= 0]
                ids.append(k)
                texts.append(t)
                lists.append(got)
                held += len(got) + 1
                if held >= SHARD_WORDS:
                    yield flush()
                    ids, texts, lists, held = [], [], [], 0
        if lists:
            yield flush()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(search, f"`{key}` {kind}, `{item}` {item_type}, start int, end int")
