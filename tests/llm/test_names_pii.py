import random

import pytest

from millrace.llm import names, pii
from millrace.llm import surrogates as sur


def test_near_against_full_table():
    pick = random.Random(2)
    for _ in range(400):
        a, b = ("".join(pick.choice("абв") for _ in range(pick.randrange(0, 7))) for _ in range(2))
        d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        for most in (1, 2):
            assert names.near(a, b, most) == (d[-1][-1] <= most)


def test_one_error_always_meets_a_segment():
    pick = random.Random(3)
    letters = "абвгдеко"
    for _ in range(400):
        word = "".join(pick.choice(letters) for _ in range(pick.randrange(2, 14)))
        k = pick.randrange(len(word))
        wrong = pick.choice([word[:k] + word[k + 1 :], word[:k] + pick.choice(letters) + word[k:], word[:k] + pick.choice(letters) + word[k + 1 :], word[:k] + word[k + 1 : k + 2] + word[k] + word[k + 2 :]])
        assert set(names.index_keys(wrong)) & names.probe_keys(word), (word, wrong)


def test_letters():
    assert names.letters("MATVIIOVYCH") == names.letters("МАТВІЙОВИЧ") and names.letters("IURII") == names.letters("ЮРІЙ")
    assert names.merged(names.letters("VUZHUK")) == names.merged(names.letters("ВУЗГУК"))


FILL = [("КАТЕРИНА", "ЛЕОНІДІВНА"), ("БОГДАН", "ГЕННАДІЙОВИЧ"), ("МИКОЛА", "ТИМОФІЙОВИЧ"), ("ОЛЕКСАНДР", "ЕДУАРДОВИЧ"), ("БОГДАНА", "ГЕННАДІЇВНА")]
GROUPS = [
    ["КУНХІКЮРА ОЛЕКСАНДР ЕДУАРДОВИЧ", "ОЛЕКСАНДР ЕДУАРДОВИЧ КУНХІКЮРА", "KUNKHIKIURA OLEKSANDR EDUARDOVYCH", "КУНХІКЮРА ОДЕКСАНДР ЕДУАРДОВИЧ", "КУНХІКЮРА САШКО ЕДУАРДОВИЧ", "КУНХІКЮРА О.Е.", "КУНХІКЮРА ОЛЕ. Е.", "О. Е. КУНХІКЮРА", "КУНХІКЮРА, ОЛЕКСАНДР ЕДУАРДОВИЧ", "OLEKSANDR KUNKHIKIURA", "КУНХІКЮРА-МИЗСИНКО ОЛЕКСАНДР ЕДУАРДОВИЧ", "КУНХІКЮРУ ОЛЕКСАНДР ЕДУАРДОВИЧ", "Кунхікюра  Олександр Едуардович (José Peña)"],
    ["МЕВБОЙДА КАТЕРИНА ЛЕОНІДІВНА", "МЕВБОЙДА КАТЯ ЛЕОНІДІВНА"],
    ["МЕВБОЙДА КАТЕРИНА ТИМОФІЇВНА"],
    ["МЕВБОЙДА КАТЕРИНА"],
    ["ЗИВКАРОГУЗ БОГДАН ГЕННАДІЙОВИЧ"],
    ["ЗИВКАРОГУЗ БОГДАНА ГЕННАДІЇВНА"],
    ["ТОВ «ВУЗГУКОН ТЕКСТИЛЬ»", "ТОВАРИСТВО З ОБМЕЖЕНОЮ ВІДПОВІДАЛЬНІСТЮ ВУЗГУКОН ТЕКСТИЛЬ", "VUZHUKON TEKSTYL LLC", "ТОВАР. «ВУЗГУКОН ТЕКС.»", 'ТОВ "ТЕКСТИЛЬ ВУЗГУКОН"', "ТОВ ВУЗГУКОНТЕКСТИЛЬ", "ВУЗГУКОН ТЕКСТИЛЬ, ТОВ"],
    ["ТОВ «ВУЗГУКОН ХЛІБ»"],
]


def test_link(spark):
    rows = [(1000 + k, f"ЗАПРЕЗ{chr(0x410 + k % 26)}{chr(0x410 + k // 26)}КО {g} {p}") for k, (g, p) in enumerate(FILL * 10)]
    rows += [(2000 + k, f"ПП «ДОДПОП{chr(0x410 + k)} ТЕКСТИЛЬ»") for k in range(5)] + [(2100 + k, f"ПП «ЛУПХАЗ{chr(0x410 + k)} ХЛІБ»") for k in range(5)]
    wanted, key = {}, 0
    for n, group in enumerate(GROUPS):
        for written in group:
            key += 1
            rows.append((key, written))
            wanted[key] = n
    rows += [(1, None), (1, ""), (900, "РџРѕРї"), (901, "???????"), (2, rows[-1][1] if False else "ОЛЕКСАНДР ЕДУАРДОВИЧ КУНХІКЮРА")]
    got = {r.entity_id: r.group for r in names.link(spark.createDataFrame(rows, "entity_id long, name string")).collect()}
    assert 900 not in got and 901 not in got
    pairs = lambda of: {(a, b) for a in of for b in of if a < b and of[a] == of[b]}
    assert pairs({k: got[k] for k in wanted}) == pairs(wanted)
    assert sum(v == got[1] for v in got.values()) == len(GROUPS[0])


def test_link_rare_given_name(spark):
    # one given name has most persons; a rare one is still a given name
    rows = [(1000 + k, f"ЗАПРЕЗ{chr(0x410 + k % 26)}{chr(0x410 + k // 26)}КО ОЛЕКСАНДР ЕДУАРДОВИЧ") for k in range(120)]
    rows += [(2000 + k, f"ВУЗГУ{chr(0x410 + k)}АР БОРЕСЛАВ ЛЕОНІДОВИЧ") for k in range(4)]
    rows += [(1, "КУНХІКЮРА БОРЕСЛАВ ЕДУАРДОВИЧ"), (2, "КУНХІКЮРА БОРЕСЛАВ"), (3, "КУНХІКЮРА ОЛЕКСАНДР")]
    got = {r.entity_id: r.group for r in names.link(spark.createDataFrame(rows, "entity_id long, name string")).collect()}
    assert names.letters("БОРЕСЛАВ") not in names.GIVEN_OF
    assert got[1] == got[2] != got[3]


def test_near_words_against_all_pairs(spark):
    pick = random.Random(4)
    words = {"".join(pick.choice("абв") for _ in range(pick.randrange(3, 10))) for _ in range(500)}
    words |= {w[:k] + w[k + 1] + w[k] + w[k + 2 :] for w in list(words)[:80] for k in range(len(w) - 1)}
    got = {(r.a, r.b) for r in names.near_words(spark.createDataFrame([(w, w[-1] == "а") for w in words], "word string, joined boolean")).collect()}
    wanted = {tuple(sorted((a, b), key=lambda w: (len(w), w))) for a in words for b in words if a < b and min(len(a), len(b)) >= names.LEAST_WORD and names.near(a, b) and not a[-1] == b[-1] == "а"}
    assert got == wanted and len(wanted) > 100


def test_parser_keeps_every_part():
    parse = names.Parser({"олександр": 9, "іван": 9}, {"едуардович": 9, "семенович": 9}, set()).parse
    assert parse("ОЛЕКСАНДР ЕДУАРДОВИЧ ОГЛИ КУНХІК") == parse("КУНХІК ОЛЕКСАНДР ЕДУАРДОВИЧ ОГЛИ") == ("p", "кунхік", "олександр", "едуардович", "огли")
    assert parse("НЕЧУЙ ЛЕВИЦЬКИЙ ІВАН СЕМЕНОВИЧ") == ("p", "нечуі-левицкиі", "іван", "семенович") == parse("ІВАН СЕМЕНОВИЧ НЕЧУЙ ЛЕВИЦЬКИЙ")
    assert parse("НЕЧУЙ ЛЕВИЦЬКИЙ І. С.") == ("p", "нечуі-левицкиі", "і.", "с.")
    assert parse("ДЕ ЛА КУНХІК ІВАН СЕМЕНОВИЧ") == ("p", "де-ла-кунхік", "іван", "семенович")
    assert parse("KУНXIК IВАН СЕМЕНОВИЧ") == parse("КУНХІК ІВАН СЕМЕНОВИЧ")  # Latin look-alikes
    assert parse("КУНХІК I. C.") == ("p", "кунхік", "і.", "с.") and parse("ТОВ «AGRO ПЛЮС»") == ("o", "агро", "плюс")
    judge = names.Judge({})
    assert judge.same(parse("КУНХІК ІВАН СЕМЕНОВИЧ"), parse("КУНХІК ІВАН СЕМЕНОВИЧ ОГЛИ")) and not judge.same(parse("КУНХІК ІВАН СЕМЕНОВИЧ КИЗИ"), parse("КУНХІК ІВАН СЕМЕНОВИЧ ОГЛИ"))


def test_link_one_surname_with_a_tenth_of_the_names(spark):
    given, patronymic = [g for g, _ in FILL[:4]] + ["ІВАН", "ПЕТРО", "СТЕПАН", "РОМАН"], ["ЛЕОНІДОВИЧ", "ТИМОФІЙОВИЧ", "ЕДУАРДОВИЧ", "ІВАНОВИЧ", "ПЕТРОВИЧ"]
    rows = [(k, f"КУНХІКЮРА {g} {p}") for k, (g, p) in enumerate((g, p) for g in given for p in patronymic)]
    rows += [(100 + k, name.replace("КУНХІКЮРА", "КУНХІЮРА")) for k, name in rows]  # each also with an error in the surname
    rows += [(300 + k, f"КУНХІКЮРА {g[0]}. {p[0]}.") for k, (g, p) in enumerate([("ІВАН", "ЛЕОНІДОВИЧ"), ("БОГДАН", "ПЕТРОВИЧ")])]
    rows += [(1000 + k, f"ЗА{a}РЕЗ{b}КО {given[k % 8]} {patronymic[k % 5]}") for k, (a, b) in enumerate((chr(0x410 + i), chr(0x410 + j) * 2) for i in range(26) for j in range(26))]
    got = {r.entity_id: r.group for r in names.link(spark.createDataFrame(rows, "entity_id long, name string")).collect()}
    assert len(got) == len(rows) and all(got[k] == got[100 + k] for k in range(40))
    assert len({got[k] for k in range(40)}) == 40 and got[300] == got[20] and got[301] == got[9]


def test_link_empty_and_pairs(spark):
    assert names.link(spark.createDataFrame([], "entity_id long, name string")).count() == 0
    groups = spark.createDataFrame([(1, "a"), (3, "a"), (2, "a"), (4, "b")], "entity_id long, group string")
    assert sorted((r.entity_id_a, r.entity_id_b) for r in names.pairs(groups).collect()) == [(1, 2), (1, 3), (2, 3)]


def test_pairs_of_links_do_not_link_twice(spark):
    rows = [(1, "КУНХІК ІВАН СЕМЕНОВИЧ"), (2, "КУНХІК Іван Семенович"), (3, "ЗАВАЛЮК ПЕТРО ІВАНОВИЧ")]
    found = names.pairs(names.link(spark.createDataFrame(rows, "entity_id long, name string")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 4  # of what groups come from, nothing is planned again
    assert [tuple(r) for r in found.collect()] == [(1, 2)]


TEXT = (
    "Заявник В'ячеслав Максимович Валгогуха\nпаспорт НЮ641068\nадреса: місто Яснозір, пл. Полудневого Вітру 126, оф. 50\nтел: 082 429 34 92\n"
    "Пригода сталася на перехресті біля вул. Марії Зоретко, свідків не виявлено. Свідками були Т. Й. Запвалярний та ХИРГЕР МИРОСЛАВА ПАВЛІВНА. "
    "Пошта poprorulia+sud(собака)mail.sud.example, +380 (22) 815-92-54; РНОКПП 325 622 7656, ID-картка № 004139445, УНЗР 19680608-29544. "
    "Код ЄДРПОУ 42805909, накладна № 6277081269, умови № 28-840-40-28, справа 12024517147214213, ОСОБА_1, ТОВ «Максимович і партнери». Підпис: Levko Rihpopalko."
)
FOUND = {
    "NAME": {"В'ячеслав Максимович Валгогуха", "Т. Й. Запвалярний", "ХИРГЕР МИРОСЛАВА ПАВЛІВНА", "Levko Rihpopalko"},
    "IDNUM": {"НЮ641068", "325 622 7656", "004139445", "19680608-29544"},
    "ADDRESS": {"місто Яснозір, пл. Полудневого Вітру 126, оф. 50"},
    "PHONE": {"082 429 34 92", "+380 (22) 815-92-54"},
    "EMAIL": {"poprorulia+sud(собака)mail.sud.example"},
}


def test_finder():
    got: dict[str, set[str]] = {}
    for a, z, kind in pii.Finder({"левко", "мирослава", "в'ячеслав"})(TEXT):
        got.setdefault(kind, set()).add(TEXT[a:z])
    assert got == FOUND


@pytest.fixture
def records(spark):
    base = [(k, f"Представник — Запдодейко Левко Іванович, 08{k % 10}0383{k % 7}10; Левко Рухбак{chr(0x430 + k % 20)}вдій прибув.", 0) for k in range(30)]
    return spark.createDataFrame([*base, (100, TEXT, 0), (101, None, 0), (102, "", 0), (103, "слово " * 20_000, 0)], "rec_id long, text string, start int")


def test_placeholders_and_passages(spark, records):
    got = {r.rec_id: r.text for r in pii.placeholders(records).collect()}
    assert got[101] is None and got[102] == "" and got[103] == "слово " * 20_000
    assert "[NAME]\nпаспорт [IDNUM]\nадреса: [ADDRESS]\nтел: [PHONE]\n" in got[100] and "вул. Марії Зоретко" in got[100]
    assert got[0] == "Представник — [NAME], [PHONE]; [NAME] прибув."
    assert pii.passages(records.limit(0), "rec_id").count() == 0


def test_surrogates(spark, records):
    got = {r.rec_id: r.text for r in sur.surrogates(records, "rec_id", b"secret").collect()}
    again = {r.rec_id: r.text for r in sur.surrogates(records, "rec_id", b"secret").collect()}
    other = {r.rec_id: r.text for r in sur.surrogates(records, "rec_id", b"other").collect()}
    assert got == again != other and got[101] is None and got[102] == ""
    assert "Запдодейко" not in got[0] and got[0].split(", ")[0].endswith("ович")
    first = [got[k].split("— ")[1].split(" ")[0] for k in range(30)]
    assert len(set(first)) == 1  # the same person stays the same
    last = {got[k].split("; ")[1] for k in range(20)}
    assert len(last) == 20  # different persons stay different
    assert got[100].split("тел: ")[1][3] == " " and "вул. Марії Зоретко" in got[100]


def test_surrogates_of_used_up_kinds(spark):
    # every one- and two-digit number and every house letter is taken, so no free value is left
    houses = [*map(str, range(1, 100)), *(f"7-{c}" for c in "АБВГҐДЕЄЖЗИІЇЙКЛМНОПРСТУФХЦЧШЩЮЯ")]
    docs = spark.createDataFrame([(k, f"мешкає: м. Рівненське, вул. Садова, буд. {n}, прибув") for k, n in enumerate(houses)], "rec_id long, text string")
    got = {r.rec_id: r.text for r in sur.surrogates(docs, "rec_id", b"secret").collect()}
    new = [got[k].split("буд. ")[1].split(",")[0] for k in range(len(houses))]
    assert all(len(x) == len(n) and not set(x.split("-")) & set(n.split("-")) for x, n in zip(new, houses, strict=True))
    assert len(set(new)) == len(houses)  # still one to one
    assert len({got[k].split(", буд.")[0] for k in range(len(houses))}) == 1 and "Садова" not in got[0]


def test_keyed_maps_are_one_to_one_and_move_everything():
    keyed = sur.Keyed(b"secret")
    for size in (2, 3, 9, 10, 33, 90, 1000):
        got = [keyed.moved(k, size, "t") for k in range(size)]
        assert sorted(got) == list(range(size)) and all(k != x for k, x in enumerate(got))
    for name, (_, stems) in sur.POOLS.items():
        ring = keyed.pool(name)
        assert sorted(ring.values()) == sorted(stems.split()) and all(a != b for a, b in ring.items())


PERSON = ["Левко Іванович Рух", "РУХ ЛЕВКО ІВАНОВИЧ", "Руха Левка Івановича", "Рух Л. І.", "Л. І. Рух", "Рух Левко", "Rukh Levko", "a_rukh77@mail.sud.example", "Сергію Івановичу Руху"]


def test_surrogates_keep_one_identity(spark):
    lines = [*(f"свідок {x}, слухали." for x in PERSON), *("Левко Іванович Бойчак" for _ in range(3)), *(f"паспорт НЮ64106{k}, тел. 082 429 34 9{k}; +380 (82) 429-34-9{k}" for k in range(10)), "прибули Левко Іванович Рух; також Рух Л. був."]
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "rec_id long, text string")
    got = [r.text for r in sur.surrogates(docs, "rec_id", b"secret").orderBy("rec_id").collect()]
    first, father, last = got[0].split("свідок ")[1].split(",")[0].split(" ")
    assert father.endswith("ович") and not {first, father, last} & set(PERSON[0].split(" "))
    assert got[1] == f"свідок {last.upper()} {first.upper()} {father.upper()}, слухали."
    assert got[2] == f"свідок {last}а {first[:-1]}а {father}а, слухали."
    assert got[3] == f"свідок {last} {first[0]}. {father[0]}., слухали." and got[4] == f"свідок {first[0]}. {father[0]}. {last}, слухали."
    assert got[5] == f"свідок {last} {first}, слухали." and got[6].split(" ")[1:3] == [pii.latin(last).capitalize(), pii.latin(first).capitalize() + ","]
    assert got[7].split("_")[1].startswith(pii.latin(last)) and "77" not in got[7]
    assert got[8].endswith(f"{father}у {last}у, слухали.") and "Сергію" not in got[8]
    assert got[-1].endswith(f"також {last} {first[0]}. був.")  # one initial, told by the full name in the same text
    for k in range(10):
        series, a, b = got[12 + k].split("паспорт ")[1].split(",")[0], got[12 + k].split("тел. ")[1].split(";")[0], got[12 + k].split("; ")[1]
        assert series[:2] != "НЮ" and series[2:] != f"64106{k}" and b.startswith("+380 (")
        assert "".join(c for c in a if c.isdigit())[-9:] == "".join(c for c in b if c.isdigit())[-9:] != f"82429349{k}"


def test_replacements_leave_nothing(spark, records):
    rows = sur.replacements(records, "rec_id", b"secret").collect()
    assert rows and all(r.surrogate != r.pii_text for r in rows)
    of = {}
    for r in rows:
        assert of.setdefault((r.pii_type, r.pii_text), r.surrogate) == r.surrogate
    assert len(set(of.values())) == len(of)
    assert sur.replacements(records.limit(0), "rec_id", b"secret").count() == 0
    with pytest.raises(ValueError, match="secret"):
        sur.surrogates(records, "rec_id", b"")


def test_finder_of_rarer_forms():
    find = pii.Finder({"левко"})
    text = "Рух Левко Іванович і Рух Л. прибули; проїзд Лісовий 5; вул. Садова, будинок 5 а, кв 3; Jan Kowalski, Anna Nowak. Додаток Б. Київ."
    assert [text[a:z] for a, z, _ in find(text)] == ["Рух Левко Іванович", "Рух Л.", "проїзд Лісовий 5", "вул. Садова, будинок 5 а, кв 3", "Jan Kowalski", "Anna Nowak"]
