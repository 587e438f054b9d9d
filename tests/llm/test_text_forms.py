import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as some

from millrace.llm import confusables, garbled, leakage


def test_skeleton_classes():
    assert confusables.skeleton("Cуд № ５ ф​орма") == confusables.skeleton("Суд № 5 форма")
    assert confusables.skeleton("ї й") == confusables.skeleton("ї й") != confusables.skeleton("i и")
    assert confusables.skeleton("Кам’яний‑Лан") == confusables.skeleton("Кам'яний-Лан")
    assert confusables.skeleton("fakturę") == confusables.skeleton("fakturę") == confusables.skeleton("fаkturе̨")
    assert confusables.skeleton("а\nб") != confusables.skeleton("а б") and confusables.skeleton("А") != confusables.skeleton("а")
    assert confusables.skeleton("№ 1") != confusables.skeleton("No 1")


def test_reader_reads_by_script():
    reader = confusables.Reader({}, 10.0)
    assert reader.read("Cудοвий зaсiд") == "Судовий засід"
    assert reader.read("Tһe сourt") == "The court"
    assert reader.read("суд i a рішення") == "суд і а рішення"
    assert reader.read("") == ""
    assert reader.viterbi("abв")[0] == "abв"


@settings(max_examples=150, deadline=None)
@given(some.text(alphabet="абвгсеіоруxyaceopiABCСН ї'’№1 ​-‑", max_size=40), some.randoms())
def test_same_look_same_form(text, pick):
    swap = {}
    for group in confusables.ALIKE.split():
        for c in group.replace(".", ""):
            swap[c] = [x for x in group if x != "."]
    other = "".join(pick.choice(swap.get(c, [c])) + ("​" if pick.random() < 0.1 else "") for c in text)
    reader = confusables.Reader({}, 10.0)
    one = reader.read(text)
    assert reader.read(other) == one and reader.read(one) == one


def test_same_text_groups(spark):
    rows = [(1, "суд і рада"), (2, "cуд і рада"), (3, "суд і рада"), (4, "інше"), (5, "інше"), (6, None), (7, ""), (8, "Суд і рада")] + [(100 + k, "суд" + "\u200b" * (k % 3) + " копія") for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in confusables.same_groups(docs).collect()}
    assert got[1] == got[2] == got[3] == (1, 3, 2) and got[4] == got[5] == (4, 2, 1) and got[8] == (8, 1, 1) and got[7] == (7, 1, 1) and 6 not in got
    assert all(got[100 + k] == (100, 90, 3) for k in range(90))
    pairs = {tuple(r) for r in confusables.same_text(docs).collect()}
    text = dict(rows)
    assert pairs == {(a, b) for a in got for b in got if a < b and got[a][0] == got[b][0] and text[a] != text[b]}


def test_same_text(spark):
    docs = spark.createDataFrame([(1, "Суд і час", 0), (2, "Cуд і час", 0), (3, "Суд і час", 0), (4, "Суд і час.", 0), (5, None, 0), (6, "", 0), (7, "​", 0), (8, "x" * 200_000, 0)], "doc_id long, text string, form int")
    got = sorted((r.doc_id_a, r.doc_id_b) for r in confusables.same_text(docs).collect())
    assert got == [(1, 2), (2, 3), (6, 7)]
    forms = {r.doc_id: r.canonical for r in confusables.canonical(docs).collect()}
    assert forms[2] == "Суд і час" and forms[5] is None and forms[6] == "" and len(forms[8]) == 200_000
    assert confusables.same_text(docs.limit(0)).count() == 0


WORDS = "Суд дослідив докази та заслухав пояснення сторін позивач оскаржує постанову відповідач вважає рішення законним Київський їжак Ґанок єдність".split()


@pytest.mark.parametrize("chain", list(garbled.CHAINS))
def test_chains_undo(chain):
    for word in WORDS:
        form = garbled.garble(word, chain)
        if form is None:  # a letter the first code page lacks
            assert chain.startswith("cp866") and set(word) & set("іІґҐ")
            continue
        assert form != word and garbled.restore(form, chain) == word
        letters = "".join(garbled.garble(c, chain) for c in word)
        assert letters == form


def corpus(n=240):
    pick = random.Random(3)
    return [" ".join(pick.choice(WORDS) for _ in range(12)) + f" № {k}." for k in range(n)]


def test_restored(spark):
    texts = corpus()
    rows, wanted = [], {}
    for k, text in enumerate(texts):
        kind = list(garbled.CHAINS)[k % len(garbled.CHAINS)] if k % 6 == 0 else None
        sent = "Унікальнеслово" + "абвгд"[k % 5] * 3 + " позивач подав клопотання."
        broken = garbled.garble(sent, kind) if kind else None
        kind, broken = (kind, broken) if broken else (None, sent)
        rows.append(("t", k, f"{text} {broken} {text}" if k % 12 else broken))
        if kind:
            wanted[k] = f"{text} {sent} {text}" if k % 12 else sent
    rows += [("t", 900, "??????? ????? № 5"), ("t", 901, "анкета: ??? не надано"), ("t", 902, "��� суд"), ("t", 903, None), ("t", 904, ""), ("t", 905, "Знак «Ørnäs Øl» та Café Ü суд")]
    values = spark.createDataFrame(rows, "field string, row_id long, text string")
    got = {r.row_id: r.restored for r in garbled.restored(values).collect()}
    assert got == {r.row_id: r.restored for r in garbled.restored(values, broadcast_bytes=0).collect()}  # the same by shuffles
    assert {k: v for k, v in got.items() if k >= 900} == {900: None, 902: None}
    found = {k for k in wanted if k in got}
    assert len(found) >= 0.95 * len(wanted) and {k for k in got if k < 900} <= set(wanted)
    assert sum(got[k] == wanted[k] for k in found) >= 0.95 * len(found)


def test_restored_empty(spark):
    assert garbled.restored(spark.createDataFrame([], "field string, row_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_fm_index(seed):
    pick = np.random.default_rng(seed)
    words = pick.integers(0, 5, 700)
    words = np.concatenate((words, words[:300], [0]))
    index = leakage.FMIndex(words.astype(np.int64), 5)
    order = leakage.suffix_order(words.astype(np.int64), 3)
    assert sorted(order.tolist()) == list(range(len(words)))
    for n in (1, 2, 3, 7):
        phrases = np.array([words[k : k + n] for k in range(0, 600, 13) if 0 not in words[k : k + n]] + [[5] * n])
        low, high = index.search(phrases)
        for phrase, a, z in zip(phrases, low, high, strict=True):
            found = sorted(index.locate(np.arange(a, z)).tolist())
            assert found == [k for k in range(len(words) - n + 1) if (words[k : k + n] == phrase).all()]


ITEM = [f"слово{k}" for k in range(60)]


def test_leaked(spark):
    pick = random.Random(4)
    noise = lambda n: [f"шум{pick.randrange(500)}" for _ in range(n)]
    replaced = [f"інше{k}" if k % 8 == 0 else w for k, w in enumerate(ITEM)]
    inserted = [x for k, w in enumerate(ITEM) for x in ([w, "додано"] if k % 7 == 0 else [w])]
    texts = {
        1: noise(30) + ITEM + noise(30),
        2: noise(30) + ITEM[10:24] + noise(30),
        3: noise(30) + ITEM[10:23] + noise(30),
        4: noise(5) + replaced + noise(9),
        5: inserted,
        6: [w for k, w in enumerate(ITEM) if k % 5],
        7: ITEM[:12] + noise(40) + ITEM[20:32] + noise(50) + ITEM[40:52],
        8: noise(200),
        9: [w.upper() + "," for w in ITEM[5:40]],
        10: ITEM * 3,
        11: [w.replace("о", "o") for w in ITEM],
    }
    rows = [(k, " ".join(t) if k % 2 else "\n".join(t), 1) for k, t in texts.items()] + [(12, None, 1), (13, "", 1), (1, " ".join(texts[1]), 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    items = spark.createDataFrame([(7, " ".join(ITEM)), (8, "коротко"), (9, None), (10, "")], "item_id long, text string")
    got = leakage.leaked(docs, items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(k, 7) for k in (1, 2, 4, 5, 6, 9, 10, 11)}
    assert sorted(leakage.leaked(docs, items, block_chars=5).collect()) == sorted(got.collect())  # a block for each item
    span = next(r for r in got.collect() if r.doc_id == 2)
    text = dict((k, t) for k, t, _ in rows)[2]
    assert text[span.start : span.end].split() == ITEM[10:24]
    assert leakage.leaked(docs.limit(0), items).count() == 0 and leakage.leaked(docs, items.limit(0)).count() == 0


def test_leaked_against_every_window(spark):
    """Passages without runs of words are found, and no pair is that no window holds."""
    pick = random.Random(5)
    noise = lambda n: [f"шум{pick.randrange(500)}" for _ in range(n)]
    texts = {1: noise(20) + [f"інше{k}" if k % 3 == 2 else w for k, w in enumerate(ITEM)] + noise(20), 2: noise(7) + [w for k, w in enumerate(ITEM) if k % 3] + noise(3)}
    for k in range(3, 60):  # a third or a little more is changed, among words of the item out of order
        kept = set(pick.sample(range(60), pick.randrange(36, 46)))
        stray = lambda: [pick.choice(ITEM)] if pick.random() < 0.1 else []
        texts[k] = noise(9) + [x for j, w in enumerate(ITEM) for x in ([w] if j in kept else noise(pick.randrange(2))) + stray()] + noise(9)
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in leakage.leaked(docs, spark.createDataFrame([(7, " ".join(ITEM))], "item_id long, text string")).collect()}
    bits = {w: 1 << p for p, w in enumerate(ITEM)}
    wanted = {k for k, t in texts.items() if any(leakage._common(bits, 60, t[a : a + 94]) >= 40 for a in range(len(t)))}
    runs = {k for k, t in texts.items() if any(t[a : a + 14] == ITEM[j : j + 14] for a in range(len(t)) for j in range(47))}
    assert {1, 2} <= wanted and len(wanted) < len(texts) and set(got) == wanted | runs
    assert " ".join(texts[1][20:79]) == " ".join(texts[1])[got[1].start : got[1].end]


def test_common_subsequence():
    pick = random.Random(1)
    for _ in range(60):
        a, b = ([pick.randrange(1, 6) for _ in range(pick.randrange(1, 25))] for _ in range(2))
        bits: dict[int, int] = {}
        for p, w in enumerate(a):
            bits[w] = bits.get(w, 0) | 1 << p
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                table[i][j] = table[i - 1][j - 1] + 1 if x == y else max(table[i - 1][j], table[i][j - 1])
        assert leakage._common(bits, len(a), b) == table[-1][-1]
