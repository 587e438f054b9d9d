"""Documents packed into windows of one token capacity, neighbours by content first.

Each task packs the rows it reads, shard by shard, without a shuffle. A shard has a BM25 inverted index over all words of its
documents. The longest unused document seeds a window; the index ranks all unused documents by their BM25 score for
the seed, and the window takes them in that order while they fit. What room is left goes to the largest unused documents that
still fit. Texts longer than the capacity are cut into whole windows, and only their rest is packed with others.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import ship

#: Tokens per shard; bounds a worker's memory and the cost of a query to its index.
SHARD_TOKENS = 1_000_000
CAPACITY = 2048
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that cuts a text before byte pairs are merged, as published for byte-level tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
K1, B = 1.2, 0.75


def load_tokenizer(path: str):  # noqa: ANN201
    """A tiktoken encoding from a file of ranks."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Index:
    """BM25 over the documents of a shard: for each term its postings with their part of the score."""

    def __init__(self, docs: list[list[int]], terms: int):
        lengths = np.array([len(d) for d in docs])
        flat = np.fromiter((t for d in docs for t in d), np.int64, int(lengths.sum()))
        pair, often = np.unique(np.repeat(np.arange(len(docs)), lengths) + flat * len(docs), return_counts=True)
        term, self.doc = pair // len(docs), pair % len(docs)
        df = np.bincount(term, minlength=terms)
        idf = np.log1p((len(docs) - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths / max(1.0, lengths.mean()))
        self.weight = (idf[term] * often * (K1 + 1) / (often + norm[self.doc])).astype(np.float32)
        self.start = np.concatenate(([0], np.cumsum(df)))
        self.n = len(docs)

    def scores(self, query: list[int]) -> np.ndarray:
        """BM25 scores of all documents for the distinct terms of a document."""
        terms = np.unique(np.asarray(query, np.int64))
        many = self.start[terms + 1] - self.start[terms]
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.start[terms], many)
        return np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


def pack(sizes: list[int], docs: list[list[int]], terms: int, capacity: int) -> list[list[int]]:
    """Windows as lists of item numbers, the seed first; ``sizes`` are 0 to ``capacity``, every item comes once."""
    index = Index(docs, terms) if docs else None
    size = np.array(sizes, np.int64)
    unused = np.ones(len(sizes), bool)
    order = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
    shelf = [(sizes[k], k) for k in order]  # unused items by size
    windows = []

    def use(k: int) -> None:
        unused[k] = False
        del shelf[bisect.bisect_left(shelf, (sizes[k], k))]

    while shelf:
        seed = shelf[-1][1]
        use(seed)
        window, room = [seed], capacity - sizes[seed]
        if shelf and shelf[0][0] <= room:
            scores = index.scores(docs[seed])
            near = np.flatnonzero(unused & (size <= room) & (scores > 0))
            for k in near[np.argsort(-scores[near], kind="stable")].tolist():
                if sizes[k] <= room:
                    use(k)
                    window.append(k)
                    room -= sizes[k]
                    if not shelf or shelf[0][0] > room:
                        break
        while shelf and shelf[0][0] <= room:
            k = shelf[bisect.bisect_right(shelf, (room, len(sizes))) - 1][1]
            use(k)
            window.append(k)
            room -= sizes[k]
        windows.append(window)
    return windows


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(container_id, place, key, part, first_token, n_tokens): every non-null text once, no container above ``capacity``.

    A text of up to ``capacity`` tokens is one row with part 0; a longer one has a row a part, in token ranges that
    follow each other. Empty texts take a place with 0 tokens; repeated rows are packed each; null texts give no row.
    Containers are numbered by task and order, so a task that runs again gives the same rows.
    """
    ship(docs.sparkSession)
    if capacity < 1:
        raise ValueError("capacity must be positive")
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load_tokenizer(tokenizer)
        base = TaskContext.get().partitionId() << 36
        made = 0
        items: list[tuple] = []  # key, part, first token, tokens
        words: list[list[int]] = []
        number: dict[str, int] = {}
        whole: list[tuple] = []
        held = 0
        key_type = None

        def flush() -> pa.RecordBatch:
            nonlocal made, held
            rows = []
            for item in whole:
                rows.append((base + made, 0, *item))
                made += 1
            for window in pack([i[3] for i in items], words, len(number), capacity):
                rows += [(base + made, place, *items[k]) for place, k in enumerate(window)]
                made += 1
            items.clear(), words.clear(), number.clear(), whole.clear()
            held = 0
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64(), pa.int32(), key_type, pa.int32(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["container_id", "place", key, "part", "first_token", "n_tokens"])

        for batch in batches:
            key_type = batch.schema.field(0).type
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if value is None:
                    continue
                n = len(coder.encode_ordinary(value))
                full = n // capacity if n > capacity else 0
                whole.extend((k, part, part * capacity, capacity) for part in range(full))
                if n > full * capacity or not full:
                    items.append((k, full, full * capacity, n - full * capacity))
                    words.append([number.setdefault(w, len(number)) for w in value.lower().split()])
                held += n + 1
                if held >= shard_tokens:
                    yield flush()
        if held:
            yield flush()

    return docs.select(key, text).mapInArrow(run, f"container_id long, place int, `{key}` {kind}, part int, first_token int, n_tokens int")


def fill(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, tokens, and the share of all room that is used."""
    per = rows.groupBy("container_id").agg(F.sum("n_tokens").alias("n"))
    return per.agg(F.count("*").alias("containers"), F.sum("n").alias("tokens"), (F.sum("n") / (F.count("*") * capacity)).alias("used"), F.max("n").alias("fullest"))
