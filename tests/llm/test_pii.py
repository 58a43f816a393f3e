import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from pagelattice.llm import pii

ROWS = [
    (1, 'Mail ann.lee@corp.example.com or ANN.LEE@CORP.EXAMPLE.COM, call +1 (743) 555-3824.'),
    (2, "ann.lee@corp.example.com paid with 4111 1111 1111 1111 and 4111111111111111 from 97.51.17.173"),
    (3, 'token = "f46b2d7c90f3602a3d0b907ff1111111f46b2d7c" then TOKEN = "F46B2D7C90F3602A3D0B907FF1111111F46B2D7C"'),
    (4, "Mrs. Alice Walker met Mr. Bob Stone and Mrs. Alice Walker; Госпожа Анна Петрова came"),
    (5, "nothing here, Version 2.0. and 12 apples"),
    (6, None),
    (7, ""),
    (8, "ssn 123-45-6789, iban DE89 3704 0044 0532 0130 00"),
]


def out(spark, rows, key="k"):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r for r in pii.pseudonymise(docs, key).collect()}


def test_kinds(spark):
    got = out(spark, ROWS)
    assert {i: r["n_pii"] for i, r in got.items()} == {1: 3, 2: 4, 3: 2, 4: 4, 5: 0, 6: 0, 7: 0, 8: 2}
    low, up = re.findall(r"\S+@[\w.]+\w", got[1]["text"])
    assert low.upper() == up and low == re.search(r"\S+@\S+", got[2]["text"])[0] and low != "ann.lee@corp.example.com"
    assert re.search(r"call \+1 \(\d{3}\) \d{3}-\d{4}\.$", got[1]["text"])
    spaced, plain = re.search(r"with (\d{4} \d{4} \d{4} \d{4}) and (\d{16}) from 10\.\d+\.\d+\.\d+$", got[2]["text"]).groups()
    assert spaced.replace(" ", "") == plain != "4111111111111111"
    a, b = re.findall(r'"([0-9a-fA-F]{40})"', got[3]["text"])
    assert a.upper() == b and a != "f46b2d7c90f3602a3d0b907ff1111111f46b2d7c"
    names = re.fullmatch(r"Mrs\. (\w+ \w+) met Mr\. (\w+ \w+) and Mrs\. (\w+ \w+); Госпожа ([А-я]+ [А-я]+) came", got[4]["text"]).groups()
    assert names[0] == names[2] and names[0].split()[0] in pii.GIVEN["latin", "f"] and names[1].split()[0] in pii.GIVEN["latin", "m"]
    assert names[3].split()[0] in pii.GIVEN["cyrillic", "f"]
    assert [got[i]["text"] for i in (5, 6, 7)] == [ROWS[4][1], None, ""]
    assert re.fullmatch(r"ssn \d{3}-\d{2}-\d{4}, iban DE\d\d( \w{4}){4} \w\w", got[8]["text"])
    assert got == out(spark, ROWS) and got[2]["text"] != out(spark, ROWS, "other")[2]["text"]


def test_distinct_under_collisions(spark, monkeypatch):
    """Few surrogates a round: later attempts still keep different entities apart, and off real ones."""
    real = pii.draw

    def narrow(kind, norm, gender, key, attempt):
        return F.concat(F.lit("user"), F.pmod(F.xxhash64(real(kind, norm, gender, key, attempt)), F.lit(40)), F.lit("@mail.example.org"))

    monkeypatch.setattr(pii, "draw", narrow)
    entities = spark.createDataFrame([("email", f"user{i}@mail.example.org", "n") for i in range(15)], "kind string, norm string, gender string")
    table = pii.surrogates(entities, "k").collect()
    made = {r["surrogate"] for r in table}
    assert len(table) == len(made) == 15 and not made & {r["norm"] for r in table}


def test_secrets_of_any_script_and_length(spark):
    """A secret is replaced whatever it is made of and however long it is."""
    token = "eyJhbGciOi" * 60 + ".x-Y_z"
    real = ["пароль-секрет", "密码密码密码", "كلمةالسر", "!?!?!?!?", "1+++///===", "κωδικός-μου", token]
    got = out(spark, [(i, f"password = '{x}'") for i, x in enumerate(real)])
    for i, x in enumerate(real):
        new = re.fullmatch(r"password = '([^'\s]+)'", got[i]["text"])[1]
        assert got[i]["n_pii"] == 1 and x not in new and len(new) == len(x) and new.lower() != x.lower()
    assert "+++" not in got[4]["text"] and "eyJhbGciOi" not in got[6]["text"]


def test_names_alone(spark):
    """The cheap first look lets every name through, beside an underscore and in other scripts."""
    got = out(spark, [(1, "_Mr. Bob Stone_"), (2, "Госпожа Анна Петрова"), (3, "aMr. Bob Stone")])
    assert [got[i]["n_pii"] for i in (1, 2, 3)] == [1, 1, 0] and "Bob" not in got[1]["text"]


def test_exhausted_space(spark):
    """Where a format has no free surrogate left, the surrogate is drawn longer and holds nothing of the entity."""
    real = [("account", str(i), "n") for i in range(10)] + [("secret", x, "n") for x in "абвгдежзийклмнопрстуфхцчшщъыьэюя"]
    table = pii.surrogates(spark.createDataFrame(real, "kind string, norm string, gender string"), "k", rounds=1).collect()
    assert len({(r["kind"], r["surrogate"]) for r in table}) == len(real)
    assert all(len(r["surrogate"]) == 17 and "-" not in r["surrogate"] for r in table)
    assert sum(r["surrogate"].startswith(r["norm"]) for r in table) < 10


def test_documents(documents, texts):
    got = {r["doc_id"]: r for r in pii.pseudonymise(documents, "k").collect()}
    assert set(got) == set(texts)
    seen = set()
    for i, t in texts.items():
        found = re.findall(r"[\w.]+@[\w.]+\w|(?<!\w)\d{16}(?!\d)|\b[0-9a-fA-F]{40}\b|\+\d \(\d{3}\) \d{3}-\d{4}|(?<![\d.])\d+\.\d+\.\d+\.\d+", t)
        seen.update(found)
        assert not any(x in got[i]["text"] for x in found)
        if not got[i]["n_pii"]:
            assert got[i]["text"] == t
    assert seen


def test_odd_rows(odd):
    rows = pii.pseudonymise(odd, "k").collect()
    want = {r["doc_id"]: r["text"] for r in odd.collect()}
    assert len(rows) == odd.count() and all(r["text"] == want[r["doc_id"]] for r in rows)
    assert pii.pseudonymise(odd.where(F.lit(False)), "k").count() == 0


def holds_card(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def holds_iban(x):
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def test_formats_hold(spark):
    cards = ["4111 1111 1111 1111", "5500-0000-0000-0004", "4111 1111 1111 1112"]
    ibans = ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "FR1420041010050500013M02606"]
    phones = ["+49 30 1234567", "+1 (743) 555-3824", "+380 44 123 4567", "+7 495 123 45 67"]
    got = out(spark, [(k, f"it is {x} here") for k, x in enumerate([*cards, *ibans, *phones])])
    new = [re.fullmatch(r"it is (.+) here", got[k]["text"])[1] for k in range(10)]
    for a, b in zip([*cards, *ibans, *phones], new, strict=True):
        assert a != b and re.sub(r"[0-9A-Z]", "x", a) == re.sub(r"[0-9A-Z]", "x", b)
    assert [holds_card(re.sub(r"\D", "", x)) for x in new[:2]] == [True, True]
    assert [holds_iban(x.replace(" ", "")) for x in new[3:6]] == [True] * 3 and [x[:2] for x in new[3:6]] == ["DE", "GB", "FR"]
    assert [x.split()[0] for x in new[6:]] == [x.split()[0] for x in phones]


def test_gender_of_occurrences(spark):
    """One name under titles of both genders is two people; a neutral title follows the name's only gender."""
    got = out(spark, [(1, "Mr Alex Smith, Mrs Alex Smith, Dr Alex Smith."), (2, "Mrs Ann Lee and Dr. Ann Lee"), (3, "Prof Toni Ray")])
    he, she, dr = re.fullmatch(r"Mr (\w+ \w+), Mrs (\w+ \w+), Dr (\w+ \w+)\.", got[1]["text"]).groups()
    assert [x.split()[0] in pii.GIVEN["latin", g].split() for x, g in ((he, "m"), (she, "f"), (dr, "n"))] == [True] * 3
    a, b = re.fullmatch(r"Mrs (\w+ \w+) and Dr\. (\w+ \w+)", got[2]["text"]).groups()
    assert a == b and a.split()[0] in pii.GIVEN["latin", "f"].split() and got[3]["text"].split()[1] in pii.GIVEN["latin", "n"].split()


def held_against_a_plain_version(rows, got):
    """Entities found one by one with another pattern engine: what lies between them is unchanged, equal entities have
    equal replacements and different ones different, and no replacement is an entity of the corpus."""
    kinds = {k: regex.compile(p) for k, p in pii.KINDS.items()}
    whole, titles = regex.compile(pii.PATTERN), regex.compile(rf"^(?:({pii.FEMALE})|({pii.MALE})|(?:{pii.NEUTRAL}))\.? ")
    names, pairs = {}, []
    for i, text in rows:
        new, at = got[i]["text"], 0
        found = [] if text is None else [m for m in whole.finditer(text)]
        assert got[i]["n_pii"] == len(found) and (text is None) == (new is None)
        between = [text[a:b] for a, b in zip([0, *(m.end() for m in found)], [*(m.start() for m in found), len(text)], strict=True)] if text else []
        for k, m in enumerate(found):
            kind = next(n for n, p in kinds.items() if p.fullmatch(m[0]))
            assert new.startswith(between[k], at)
            at += len(between[k])
            end = len(new) if k == len(found) - 1 and not between[-1] else new.index(between[k + 1], at + 1) if between[k + 1] else None
            assert end is not None
            pairs.append((kind, m[0], new[at:end]))
            at = end
            if kind == "name" and (t := titles.match(m[0])):
                names.setdefault(titles.sub("", m[0]).lower(), set()).add("f" if t[1] else "m" if t[2] else "n")
        assert not text or new[at:] == between[-1]
    one, other = {}, {}
    for kind, old, new in pairs:
        def norm(x):
            if kind in ("phone", "national_id", "account"):
                return "+" * x.startswith("+") + regex.sub(r"[^0-9]", "", x)
            if kind == "secret":
                return regex.search(r"""["']([^"'\s]+)["']""", x)[1].lower()
            return titles.sub("", x).lower() if kind == "name" else x.replace(" ", "") if kind == "iban" else x.lower()

        g = ""
        if kind == "name":
            t, known = titles.match(old), names[norm(old)] - {"n"}
            g = "f" if t[1] else "m" if t[2] else known.copy().pop() if len(known) == 1 else "n"
        key = kind, norm(old), g
        assert one.setdefault(key, norm(new)) == norm(new), (key, new)
        assert other.setdefault(norm(new), key) == key, (key, new)
    assert not {new for *_, new in pairs} & {old for _, old, _ in pairs}
    return len(one)


def test_documents_against_a_plain_version(documents, texts):
    got = {r["doc_id"]: r for r in pii.pseudonymise(documents, "k").collect()}
    assert held_against_a_plain_version(texts.items(), got) > 10


def test_generated_corpus_against_a_plain_version(spark):
    """All kinds, scripts and short formats, many of each, repeated in other dress."""
    r = random.Random(4)
    digits = lambda n: "".join(r.choices("0123456789", k=n))
    rows = []
    for i in range(150):
        own = [
            f"u{r.randrange(60)}.x@mail{r.randrange(3)}.org",
            f"password = '{''.join(r.choices('абвгдеж密码كلمAB12!?', k=6 + r.randrange(20)))}'",
            f"+{r.choice(['1', '49', '380'])} {digits(2)} {digits(3)}",
            f"({digits(3)}) {digits(3)}-{digits(4)}",
            f"10.{r.randrange(2)}.{r.randrange(3)}.{r.randrange(250)}",
            f"{digits(3)}-{digits(2)}-{digits(4)}",
            f"4{digits(3)} {digits(4)} {digits(4)} {digits(4)}",
            f"{r.choice(['Mr', 'Mrs', 'Dr.', 'Frau'])} {r.choice(['Ann', 'Bob', 'Zoë'])} {r.choice(['Lee', 'Ray', 'Öz'])}",
            f"Госпожа {r.choice(['Анна', 'Вера'])} {r.choice(['Петрова', 'Ким'])}",
        ]
        r.shuffle(own)
        rows.append((i, "see " + " ; ".join(own) + " end"))
    got = out(spark, rows)
    assert held_against_a_plain_version(rows, got) > 900


def test_a_key_is_needed(spark):
    with pytest.raises(ValueError):
        out(spark, ROWS, "")


def test_surrogates_as_real_names_of_the_next_run(spark):
    """What one run draws is a real person of the next: still all are distinct, and no surrogate is anybody's name."""
    people = ["Bob Stone", "Carl Weber", "Eric Moore"]
    first = out(spark, [(i, f"Mr {x}.") for i, x in enumerate(people)])
    drawn = [re.fullmatch(r"Mr (\w+ \w+)\.", first[i]["text"])[1] for i in range(3)]
    real = people + drawn
    second = out(spark, [(i, f"Mr {x}.") for i, x in enumerate(real)])
    made = [re.fullmatch(r"Mr (\w+ \w+)\.", second[i]["text"])[1].lower() for i in range(6)]
    assert len(set(made)) == 6 and not set(made) & {x.lower() for x in real}


def test_a_lost_surrogate_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(pii, "surrogates", lambda entities, key: entities.where("false").select("kind", "norm", "gender", F.lit("").alias("surrogate")))
    with pytest.raises(Exception, match="has no surrogate"):
        out(spark, [(1, "Mr Bob Stone")])


def test_entities_named_by_hand(spark):
    """Texts with what must go and what must stay, written down without the operator's patterns."""
    rows = [
        ("Bob Stone said so, and Bob Stoneman too", ["Bob Stone "], ["said so, and Bob Stoneman too"]),
        ("Yesterday Mr Bob Stone came.", ["Bob Stone"], ["Yesterday Mr ", " came."]),
        ("Dear Alice Walker, BOB STONE is here", ["Alice Walker", "BOB STONE"], ["Dear ", " is here"]),
        ("Mrs. Alice Walker", ["Alice Walker"], ["Mrs. "]),
        ("password=hunter22, then password: because it was short", ["hunter22"], ["password=", "password: because it was short"]),
        ("call 0171 2345678 or 030/1234 567 today", ["0171 2345678", "1234 567"], ["call 0", " or 0", " today"]),
        ("on 2020-01-02 at 08:30 with 0.5 of 10 000 000", [], ["on 2020-01-02 at 08:30 with 0.5 of 10 000 000"]),
        ("api_key: 'abcdef' and token = \"ABC-123-xyz\"", ["abcdef", "ABC-123-xyz"], ["api_key: '", "' and token = \""]),
    ]
    got = out(spark, [(i, t) for i, (t, *_) in enumerate(rows)])
    for i, (text, gone, kept) in enumerate(rows):
        new = got[i]["text"]
        assert all(x not in new for x in gone) and all(x in new for x in kept), (text, new)
        assert (new == text) == (not gone)
    name = re.fullmatch(r"(\w+ \w+) said so.*", got[0]["text"])[1]
    assert got[1]["text"] == f"Yesterday Mr {name} came." and got[0]["n_pii"] == 1
    assert re.fullmatch(rf"Dear (\w+ \w+), {name} is here", got[2]["text"])[1] == re.fullmatch(r"Mrs\. (\w+ \w+)", got[3]["text"])[1]
