"""Surrogates: entities go, formats stay, equal stay equal and distinct stay distinct."""

import re

from backframe.llm.common import table
from backframe.llm.pii import Surrogates, assign, replace_entities
from tests.llm.cases import PROSE, clashing, documents

ENTITIES = [
    "ann.lee@mail5.example.com", "bob99@mail5.example.com", "+1 (743) 555-3824", "+1 743 555 3824", "193.195.198.107",
    "4539578763621486", "4539 5787 6362 1486", "078-05-1120", "DE89 3704 0044 0532 0130 00",
    "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "24BE64439E3E49CF46B2D7C90F3602A3D0B907FA",
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def test_every_kind_is_replaced_in_its_format(spark):
    texts = [f"{PROSE} {e}, {PROSE}." for e in ENTITIES]
    got = {r.doc_id: r for r in replace_entities(documents(spark, texts)).collect() if r.doc_id and r.doc_id > 0}
    out = []
    for i, e in enumerate(ENTITIES):
        r = got[3 + 2 * i]
        assert r.n_entities == 1, e
        head, tail = f"{PROSE} ", f", {PROSE}."
        assert r.text.startswith(head) and r.text.endswith(tail)
        new = r.text[len(head) : -len(tail)]
        shape = lambda s: re.sub("[0-9]", "9", re.sub("[a-z]", "a", s))
        if e[0] == "1" and e.count(".") == 3:
            assert re.fullmatch(r"\d+(\.\d+){3}", new)
        elif len(e) == 40:
            assert re.fullmatch("[a-f0-9]{40}" if e.islower() else "[A-F0-9]{40}", new)
        else:
            assert shape(new) == shape(e)
        assert new != e and e not in r.text
        out.append(new)
    assert out[0].split("@")[1] == out[1].split("@")[1]
    assert re.sub(r"\D", "", out[2]) == re.sub(r"\D", "", out[3])
    assert out[5] == out[6].replace(" ", "") and luhn(out[5]) and luhn(ENTITIES[5])
    assert len({re.sub(r"[^0-9a-z]", "", x.lower()) for x in out}) == len(out) - 2


def test_names_keep_gender_script_and_surname(spark):
    texts = ["we met Anna Schmidt and Frau Schmidt there.", "Then Иван Петров came with Paul Schmidt.", "Anna lives. May Day."]
    got = {r.doc_id: r.text for r in replace_entities(documents(spark, [*texts, "x", "y"])).collect()}
    from backframe.llm.pii import GIVEN

    a = re.fullmatch(r"we met (\w+) (\w+) and Frau (\w+) there\.", got[3])
    assert a[1] in GIVEN["female latin"] and a[1] != "Anna" and a[2] == a[3] != "Schmidt"
    b = re.fullmatch(r"Then (\w+) (\w+) came with (\w+) (\w+)\.", got[5])
    assert b[1] in GIVEN["male cyrillic"] and re.fullmatch("[А-Я][а-я]+", b[2]) and b[2] != "Петров"
    assert b[3] in GIVEN["male latin"] and b[4] == a[2]
    assert got[7] == texts[2]


def test_whole_entities_are_found(spark):
    whole = [
        "Mr. McDonald", "Dr. Smith-Jones", "Mr. O'Brien", "Mr. O’Brien", "John F. Kennedy", "Frau Mu\u0308ller", "+33 6 12 34 56 78",
        "020 7946 0958", "123 456 7890", "+44 (0)20 7946 0958", "01 23 45 67 89", "a1" * 100, "key='abcdef123456'",
    ]
    kept = ['title: "Introduction"', 'class="navbar-default"', "x = '------------'", "in 2019 1234 567 8901", "0.123 456", "Smith-Jones"]
    docs = documents(spark, [f"see {w}, please." for w in whole + kept])
    got = {r.doc_id: r for r in replace_entities(docs).collect()}
    shape = lambda s: re.sub("[0-9]", "9", re.sub("[^\\W0-9_]", "a", s))
    new = {w: got[3 + 2 * i].text[4:-9] for i, w in enumerate(whole + kept)}
    for w in whole:
        if w != "John F. Kennedy":
            head = w.split(" ")[0] if w[0] in "MDF" else ""
            assert shape(new[w]) == shape(w) and new[w].startswith(head) and new[w] != w, w
    assert re.fullmatch(r"\w+ F\. [A-Z]\w{6}", new["John F. Kennedy"]) and "Kennedy" not in new["John F. Kennedy"]
    assert re.fullmatch(r"Mr\. [A-Z]\w[A-Z]\w{5}", new["Mr. McDonald"]) and "onald" not in new["Mr. McDonald"]
    assert re.fullmatch(r"Dr\. [A-Z]\w{4}-[A-Z]\w{4}", new["Dr. Smith-Jones"]) and "Jones" not in new["Dr. Smith-Jones"]
    assert new["Mr. O'Brien"].replace("'", "’") == new["Mr. O’Brien"]
    for w in kept:
        assert new[w] == w and got[3 + 2 * (len(whole) + kept.index(w))].n_entities == 0, w


def test_clashes_are_resolved(spark):
    rows = [("surname", a + b) for a in "aeiou" for b in "bcdfg"] + [("ssn", f"{i:02d}") for i in range(15)]
    entities = spark.createDataFrame(rows, "kind string, own string")
    got = assign(entities, Surrogates(rounds=400)).collect()
    assert {(r.kind, r.own) for r in got} == set(rows)
    assert len({(r.kind, r.new) for r in got}) == len(rows)
    assert not {(r.kind, r.new) for r in got} & set(rows)


def test_letters_outside_the_alphabets_are_redrawn(spark):
    names = ["Đỗ", "Ավո", "Ђё", "Ŵŷ", "Ώϊ", "Þß"]
    docs = documents(spark, [f"so says Mr. {n} today." for n in names])
    got = {r.doc_id: r.text for r in replace_entities(docs).collect()}
    for i, n in enumerate(names):
        new = re.fullmatch(r"so says Mr\. (\w+) today\.", got[3 + 2 * i])[1]
        assert len(new) == len(n) and new[0].isupper() and new != n, n


def test_short_spaces_give_longer_surrogates(spark):
    rows = [("surname", a + b) for a in "aeiou" for b in "aeiou"] + [("email", "_@a.com"), ("secret", "-" * 12), ("surname", "אב")]
    got = assign(spark.createDataFrame(rows, "kind string, own string"), Surrogates()).collect()
    assert {(r.kind, r.own) for r in got} == set(rows)
    assert len({(r.kind, r.new) for r in got}) == len(rows)
    assert not {(r.kind, r.new) for r in got} & set(rows)


def test_few_rounds_end_too(spark):
    rows = [("surname", a) for a in "aeiou"]
    got = assign(spark.createDataFrame(rows, "kind string, own string"), Surrogates(rounds=1)).collect()
    assert len({r.new for r in got} - set("aeiou")) == 5


def test_clashing_surrogates_reach_the_texts(spark):
    names = [f"{a}{b}{c}" for a in "BCDFG" for b in "aeiou" for c in "bcdfghkl"]
    docs = documents(spark, [f"so says Dr {n} today." for n in names])
    got = [r.text for r in replace_entities(docs, Surrogates(rounds=400)).collect()]
    new = [re.fullmatch(r"so says Dr (\w+) today\.", t)[1] for t in got if t and t.startswith("so says")]
    assert len(new) == len(names) + 1 and len(set(new)) == len(names)
    assert not set(new) & set(names)


def test_awkward_rows(spark):
    docs = clashing(documents(spark))
    got = replace_entities(docs)
    assert set(got.columns) == {*docs.columns, "n_entities"} and got.count() == docs.count()
    clean = docs.exceptAll(got.where("n_entities = 0").select(docs.columns))
    assert clean.count() == got.where("n_entities > 0").count()
    assert replace_entities(docs.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    """No e-mail, phone, card or address of the input is left; equal texts are rewritten alike."""
    docs = table(spark, sf_dir.replace("0.001", "0.01"), "documents")
    plain = re.compile(r"[\w.]+@[\w.]+\.\w+|\+\d \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b[0-9a-f]{30,}\b")
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r for r in replace_entities(docs).collect()}
    assert before.keys() == after.keys()
    same = {}
    for k, text in before.items():
        own = set(plain.findall(text or ""))
        assert not any(e in after[k].text for e in own)
        assert (after[k].text == text) == (after[k].n_entities == 0)
        assert same.setdefault(text, after[k].text) == after[k].text
    assert sum(r.n_entities > 0 for r in after.values()) > 10


def iban_rest(text):
    turned = text.replace(" ", "")[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97


def test_check_digits_and_country_codes_stay(spark):
    ibans = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "FR1420041010050500013M02606"]
    phones = ["+33 6 12 34 56 78", "+1 (743) 555-3824", "+351 912 345 678", "+44 20 7946 0958"]
    texts = [f"see {e} there" for e in (*ibans, *phones)]
    got = {r.doc_id: r.text for r in replace_entities(documents(spark, texts)).collect()}
    for i, e in enumerate((*ibans, *phones)):
        new = re.fullmatch("see (.*) there", got[3 + 2 * i])[1]
        assert new != e and re.sub("[0-9A-Z]", "x", new) == re.sub("[0-9A-Z]", "x", e)
        if e in ibans:
            assert iban_rest(e) == iban_rest(new) == 1 and new[:2] == e[:2]
        else:
            assert new.split(" ")[0] == e.split(" ")[0]


def test_endless_repeats_of_every_unit(spark):
    """A page of one unit over and over neither breaks the run nor takes long."""
    units = [".b", "Aa-", "a.", "1 ", "12-", "A1 ", "9.", "'A", "= \"a1", "é", "A\u0301", "Anna ", "Mr. ", "+1 ", "(123) ", "AB12 CDEF "]
    heads = ["x@a", "Mr. ", "Anna ", "DE89", "key=\"", "+49 ", "1.2.3."]
    texts = [(h + u * (200_000 // len(u)) + e) for u in units for h, e in zip(heads, (".com", "Aa", "", "", "\"", "", "4"), strict=True)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(16)
    made = replace_entities(docs)
    assert made.selectExpr("count(text) AS n").first()["n"] == len(texts)
