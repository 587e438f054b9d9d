import random

import pytest

from millrace.llm import components, packing


def union_find(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def run(spark, pairs, **how):
    rows = spark.createDataFrame(pairs, "a long, b long")
    return {r.id: r.group_id for r in components.connected_components(rows, "a", "b", **how).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    pick = random.Random(seed)
    pairs = [(pick.randrange(150), pick.randrange(150)) for _ in range(110)] + [(1, 1), (None, 3), (5, None)]
    pairs += pairs[:20] + [(b, a) for a, b in pairs[:20]]
    assert run(spark, pairs) == union_find(pairs)


def test_chain_and_hub(spark):
    chain = [(k, k + 1) for k in range(1000, 1060)]
    hub = [(7, k) for k in range(100, 180)]
    assert run(spark, chain + hub, share=0.05) == union_find(chain + hub)


def test_empty_and_selves(spark):
    assert run(spark, []) == {} and run(spark, [(1, 1), (None, None)]) == {}


TEXTS = [(1, "Суд дослідив докази " * 30), (2, "Суд дослідив докази"), (3, ""), (4, None), (5, "x " * 3000), (6, "Суд дослідив докази"), (6, "інше речення про склад"), (7, "a" * 50_000)]


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packed_is_whole(spark, capacity):
    rows = spark.createDataFrame([(k, t, 9) for k, t in TEXTS], "doc_id long, text string, place int").coalesce(1)
    got = packing.packed(rows, capacity=capacity, shard_tokens=3000).collect()
    coder = packing.load_tokenizer(packing.TOKENIZER)
    wanted = sorted(len(coder.encode_ordinary(t)) for _, t in TEXTS if t is not None)
    by_doc, by_box = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append((r.part, r.first_token, r.n_tokens))
        by_box.setdefault(r.container_id, []).append(r.n_tokens)
    assert all(sum(x) <= capacity for x in by_box.values())
    assert sum(n for v in by_doc.values() for _, _, n in v) == sum(wanted)
    assert 4 not in by_doc and by_doc[3] == [(0, 0, 0)]
    for key, parts in by_doc.items():
        sizes = [len(coder.encode_ordinary(t)) for k, t in TEXTS if k == key and t is not None]
        if len(sizes) == 1 and sizes[0] > capacity:
            at = 0
            for part, first, n in sorted(parts):
                assert first == at == part * capacity and n <= capacity
                at += n
            assert at == sizes[0]
        else:
            assert sorted(n for _, _, n in parts) == sorted(sizes)
    assert len({(r.container_id, r.place) for r in got}) == len(got)
    assert packing.packed(rows.limit(0)).count() == 0


def test_neighbours_go_together():
    topics = ["суд позов докази рішення", "банк кредит рахунок відсоток"]
    docs = [[hash(w) % 5 + 10 * (k % 2) for w in topics[k % 2].split()] for k in range(40)]
    number: dict[int, int] = {}
    docs = [[number.setdefault(w, len(number)) for w in d] for d in docs]
    windows = packing.pack([25] * 40, docs, len(number), 100)
    assert sorted(k for w in windows for k in w) == list(range(40)) and all(len(w) == 4 for w in windows)
    assert all(len({k % 2 for k in w}) == 1 for w in windows)


def test_bm25_against_formula():
    import math

    docs = [[0, 1, 1], [1, 2], [2, 2, 2, 3]]
    got = packing.Index(docs, 4).scores([1, 2])
    mean = sum(map(len, docs)) / 3
    for d, doc in enumerate(docs):
        wanted = 0.0
        for t in (1, 2):
            df, tf = sum(t in x for x in docs), doc.count(t)
            wanted += math.log1p((3 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(doc) / mean)) if tf else 0.0
        assert got[d] == pytest.approx(wanted, rel=1e-5)


def test_fill_is_high(spark, small):
    from millrace.llm import queries

    row = queries.p8_fill(spark, small).first()
    assert row.used > 0.9 and row.fullest <= 2048
