"""PII surrogates, in DataFrame functions only.

Entities are found by one pattern.  Each distinct entity (kind, normal form and, for names,
gender) gets a surrogate derived from a keyed hash: digits for digits, hexadecimal for
hexadecimal, a name of the title's gender and the name's script for a name, an address under
a reserved domain for an address.  Phone numbers keep their country code, IBANs their country,
and check digits hold where they held.  A surrogate that equals another entity's surrogate, or
any entity found, is drawn again with the next attempt number until all are distinct; a format
that has none left gets a longer one.  Nothing of an entity is ever written back.  Every
occurrence of an entity gets the same surrogate, in the occurrence's own format and case.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, materialize, read_table

EMAIL = r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}"
SECRET_WORD = r"(?<!\p{L})(?i:token|secret|password|passwd|api[_\-]?key)\s{0,3}[=:]\s{0,3}"
#: In quotes anything, without quotes what holds a digit.
SECRET = rf"""{SECRET_WORD}(?:["'][^"'\s]{{6,}}+["']|(?=[^\s"',;]*\d)[^\s"',;]{{6,}}+)"""
SECRET_VALUE = rf"""^{SECRET_WORD}["']?([^"'\s]+)["']?$"""
PHONE = r"(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?!\d)"
LOCAL_PHONE = r"(?<![\w+])(?:\(\d{3}\) ?|\d{3}[\-.])\d{3}[\-.]\d{4}(?!\d)"
#: With the 0 of long-distance calls, eight digits or more.
TRUNK_PHONE = r"(?<![\w+.,/:\-])(?=(?:\d[ /\-]?){8})0\d{1,4}[ /\-]\d{3,8}(?:[ \-]\d{2,8}){0,3}(?![\d:])"
IPV4 = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
NATIONAL_ID = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
ACCOUNT = r"(?<![\d\w])\d(?:[ \-]?\d){12,18}(?!\d)"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа"
MALE = "Mr|Herr|Monsieur|Señor|Sr|Господин"
NEUTRAL = "Dr|Prof"
NAME = rf"(?<!\p{{L}})(?:{FEMALE}|{MALE}|{NEUTRAL})\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?"
#: Tried in this order at each place.
KINDS = {
    "email": EMAIL,
    "secret": SECRET,
    "iban": IBAN,
    "phone": f"{PHONE}|{LOCAL_PHONE}|{TRUNK_PHONE}",
    "ip": IPV4,
    "national_id": NATIONAL_ID,
    "account": ACCOUNT,
    "name": NAME,
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: Two words that may be a name without a title, at every place where one begins.
TWO_WORDS = r"(?<!\p{L})(?=(\p{Lu}\p{L}+ \p{Lu}\p{L}+)(?!\p{L}))"
#: A text without any of these has no entity: a cheap first look.
HINT = rf"[@\d=:]|(?<!\p{{L}})(?:{FEMALE}|{MALE}|{NEUTRAL})"

# Given names by script and gender: fixed values.
GIVEN = {
    ("latin", "f"): "Anna Clara Elena Julia Laura Maria Nina Sofia",
    ("latin", "m"): "Adam Daniel Felix Jonas Lukas Martin Paul Simon",
    ("latin", "n"): "Alex Andrea Chris Jordan Kim Robin Sam Toni",
    ("cyrillic", "f"): "Анна Вера Елена Ирина Мария Нина Ольга Софья",
    ("cyrillic", "m"): "Антон Борис Иван Лев Максим Олег Павел Роман",
    ("cyrillic", "n"): "Саша Женя Валя Слава Шура Тоня Паша Мика",
}
# Syllables of surrogate surnames by script: fixed values.
SYLLABLES = {
    "latin": "ba de fi ga ho ka le mi no pe ra so ti ve wa zu",
    "cyrillic": "ба де фи га хо ка ле ми но пе ра со ти ве ва зу",
}

# Letters and marks to draw from, for characters outside ASCII letters and digits: fixed values.
ALPHABETS = {
    r"\p{IsCyrillic}": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω",
    r"\p{IsHan}": "".join(chr(0x4E00 + k) for k in range(256)),
    r"[\p{L}\p{M}\p{N}]": "abcdefghijklmnopqrstuvwxyz",
}
# Telephone country codes of one and of two digits, all others have three: fixed values.
SHORT_CODES = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
MARKS = "!#$%&*+,-./:;?@^_~"


def kind_of(entity: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS.items()):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"[^0-9]", "")


def normal_form(kind: Column, entity: Column) -> Column:
    """What makes two occurrences the same entity: case, separators, quotes and titles do not count."""
    return (
        F.when(kind == "phone", F.concat(F.when(entity.startswith("+"), "+").otherwise(""), _digits(entity)))
        .when(kind.isin("national_id", "account"), _digits(entity))
        .when(kind == "secret", F.lower(F.regexp_extract(entity, SECRET_VALUE, 1)))
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind == "name", F.lower(F.regexp_replace(entity, rf"^(?:{FEMALE}|{MALE}|{NEUTRAL})\.? ", "")))
        .otherwise(F.lower(entity))
    )


def gender_of(entity: Column) -> Column:
    return (
        F.when(entity.rlike(rf"^(?:{FEMALE})(?!\p{{L}})"), "f").when(entity.rlike(rf"^(?:{MALE})(?!\p{{L}})"), "m").otherwise("n")
    )


def find(text: Column) -> Column:
    """Entities of a text, in order."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(none)


def _stream(seed: Column) -> Column:
    """256 hexadecimal digits keyed by the seed."""
    return F.concat(*(F.sha2(F.concat(seed, F.lit(f"|{k}")), 256) for k in range(4)))


def _nibble(stream: Column, at: Column) -> Column:
    return F.conv(F.substring(stream, at % 256 + 1, F.lit(1)), 16, 10).cast("int")


def _of(letters: str, at: Column) -> Column:
    return F.substring(F.lit(letters), at % len(letters) + 1, F.lit(1))


def _digit(stream: Column, i: Column) -> Column:
    return ((_nibble(stream, i) * 7 + _nibble(stream, i + 101)) % 10).cast("string")


def _redrawn(value: Column, stream: Column, fixed: Column | int = 0) -> Column:
    """Each character replaced by one of its class (digit, hexadecimal, letter by script), the first `fixed` kept.
    Other marks stay beside six or more letters and digits; with fewer, they are the value, and are replaced too."""
    hexadecimal = value.rlike("^[0-9a-f]+$")
    bare = F.char_length(F.regexp_replace(value, r"[^\p{L}\p{N}]", "")) < 6

    def one(c: Column, i: Column) -> Column:
        at = _nibble(stream, i) * 16 + _nibble(stream, i + 101)
        out = (
            F.when(i < fixed, c)
            .when(hexadecimal & value.rlike("[a-f]"), F.substring(stream, i % 256 + 1, F.lit(1)))
            .when(c.rlike("[0-9]"), _digit(stream, i))
            .when(c.rlike("[a-z]"), F.chr(97 + at % 26))
            .when(c.rlike("[A-Z]"), F.chr(65 + at % 26))
        )
        for script, letters in ALPHABETS.items():
            out = out.when(c.rlike(script), _of(letters, at))
        return out.when(bare, _of(MARKS, at)).otherwise(c)

    return F.array_join(F.transform(F.filter(F.split(value, ""), lambda c: c != ""), one), "")


def _pick(words: str, n: Column) -> Column:
    listed = words.split()
    return F.get(F.array(*map(F.lit, listed)), n % len(listed))


def _name(norm: Column, gender: Column, stream: Column, attempt: Column) -> Column:
    """A given name and a surname, or a surname alone, in the script of the name; later attempts are longer."""
    out = F.lit(None).cast("string")
    for script, letters in (("latin", None), ("cyrillic", r"\p{IsCyrillic}")):
        surname = F.initcap(
            F.array_join(
                F.transform(F.sequence(F.lit(0), 3 + F.least(attempt, F.lit(8))), lambda i: _pick(SYLLABLES[script], _nibble(stream, i + 8))), ""
            )
        )
        first = _pick(GIVEN[script, "n"], _nibble(stream, F.lit(0)))
        for g in "fm":
            first = F.when(gender == g, _pick(GIVEN[script, g], _nibble(stream, F.lit(0)))).otherwise(first)
        full = F.when(norm.contains(" "), F.concat_ws(" ", first, surname)).otherwise(surname)
        out = full if letters is None else F.when(norm.rlike(letters), full).otherwise(out)
    return out


def _mod(digits: Column, m: int) -> Column:
    """A string of digits, however long, modulo m."""
    return F.aggregate(F.filter(F.split(digits, ""), lambda c: c != ""), F.lit(0), lambda a, c: (a * 10 + c.cast("int")) % m)


def _iban_rest(iban: Column) -> Column:
    """97 times anything plus 1 for an IBAN with right check digits."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substring(iban, 1, 4))
    spelled = F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c))
    return _mod(F.array_join(spelled, ""), 97)


def _checked_iban(iban: Column) -> Column:
    zero = F.concat(F.substring(iban, 1, 2), F.lit("00"), F.substr(iban, F.lit(5)))
    return F.concat(F.substring(iban, 1, 2), F.lpad((98 - _iban_rest(zero)).cast("string"), 2, "0"), F.substr(iban, F.lit(5)))


def _card_sum(digits: Column) -> Column:
    """The sum that is 0 modulo 10 for a card number with a right check digit: every second digit from the right is doubled."""

    def add(a: Column, c: Column) -> Column:
        twice = 2 * c.cast("int")
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return F.struct((a["s"] + F.when(a["odd"], doubled).otherwise(c.cast("int"))).alias("s"), (~a["odd"]).alias("odd"))

    start = F.struct(F.lit(0).alias("s"), F.lit(False).alias("odd"))
    return F.aggregate(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), start, add, lambda a: a["s"])


def _checked_card(real: Column, drawn: Column) -> Column:
    """The drawn digits with a right check digit, if the real number has one."""
    body = F.concat(F.substr(drawn, F.lit(1), F.length(drawn) - 1), F.lit("0"))
    last = F.pmod(10 - F.pmod(_card_sum(body), F.lit(10)), F.lit(10))
    return F.when(F.pmod(_card_sum(real), F.lit(10)) == 0, F.concat(F.substr(body, F.lit(1), F.length(body) - 1), last.cast("string"))).otherwise(drawn)


def draw(kind: Column, norm: Column, gender: Column, key: str, attempt: Column) -> Column:
    """The surrogate's normal form for one attempt; null where the entity leaves nothing to draw."""
    seed = F.concat_ws("|", F.lit(key), kind, norm, attempt.cast("string"))
    s = _stream(seed)
    local = F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: _pick(SYLLABLES["latin"], _nibble(s, i))), ""
    )
    digits = F.regexp_replace(norm, r"^\+", "")
    code = F.when(digits.rlike(SHORT_CODES), F.when(digits.rlike("^[17]"), 1).otherwise(2)).otherwise(3)
    octet = [(_nibble(s, F.lit(2 * k)) * 16 + _nibble(s, F.lit(2 * k + 1))).cast("string") for k in range(4)]
    return (
        F.when(kind == "email", F.concat(local, F.lit("."), F.substring(_digits(s), 1, 3), F.lit("@mail.example.org")))
        .when(kind == "ip", F.concat(F.lit("10."), F.concat_ws(".", *octet[1:])))
        .when(kind == "name", _name(norm, gender, s, attempt))
        .when(kind == "phone", _redrawn(digits, s, F.when(norm.startswith("+"), code).otherwise(1)))
        .when(kind == "iban", _checked_iban(_redrawn(norm, s, 2)))
        .when(kind == "account", _checked_card(norm, _redrawn(norm, s)))
        .otherwise(_redrawn(norm, s))
    )


def draw_longer(kind: Column, norm: Column, gender: Column, key: str, attempt: Column) -> Column:
    """A surrogate longer than the entity's format, for one attempt; no character of the entity is kept."""
    s = _stream(F.concat_ws("|", F.lit(key), kind, norm, attempt.cast("string")))
    many = F.sequence(F.lit(0), F.lit(15))
    digits = F.array_join(F.transform(many, lambda i: _digit(s, i + 50)), "")
    latin, cyrillic = (
        F.array_join(F.transform(many, lambda i: _pick(SYLLABLES[script], _nibble(s, i + 20))), "") for script in ("latin", "cyrillic")
    )
    octets = F.array_join(F.transform(many, lambda i: (_nibble(s, 2 * i) * 16 + _nibble(s, 2 * i + 1)).cast("string")), ".")
    return (
        F.when(kind == "email", F.concat(latin, F.lit("."), digits, F.lit("@mail.example.org")))
        .when(kind == "ip", F.concat(F.lit("10."), octets))
        .when(kind == "name", F.initcap(F.when(norm.rlike(r"\p{IsCyrillic}"), cyrillic).otherwise(latin)))
        .otherwise(F.concat(_redrawn(F.regexp_replace(norm, r"^\+", ""), s), digits))
    )


def known_gender(entities: DataFrame) -> DataFrame:
    """(kind, norm, gender, as): the gender under which an occurrence is one entity.  A name under titles of both
    genders is two; under a neutral title it is the one of the name's only gender, where there is one."""
    of = entities.groupBy("kind", "norm").agg(F.max((F.col("gender") == "f").cast("int")).alias("f"), F.max((F.col("gender") == "m").cast("int")).alias("m"))
    only = F.when(F.col("f") > F.col("m"), "f").when(F.col("m") > F.col("f"), "m").otherwise("n")
    every = F.explode(F.array(*map(F.lit, "fmn"))).alias("gender")
    return of.select("kind", "norm", only.alias("only"), every).select("kind", "norm", "gender", F.when(F.col("gender") == "n", F.col("only")).otherwise(F.col("gender")).alias("as"))


def _clash(x: Column) -> Column:
    """What two values must not share: neither case nor the + of a phone number makes a difference."""
    return F.lower(F.regexp_replace(x, r"^\+", ""))


def surrogates(entities: DataFrame, key: str, rounds: int = 8, longer: int = 24) -> DataFrame:
    """(kind, norm, gender, surrogate) for the distinct entities (kind, norm, gender): surrogates are distinct from
    each other and from every entity, whatever their kinds and case.  After `rounds` attempts a format has none left
    and gets longer ones; entities still without one after `longer` more attempts are an error."""
    real = checkpoint(entities.where("kind is not null and norm is not null and norm <> ''").select("kind", "norm", "gender").distinct())
    names = ["kind", "norm", "gender"]
    # what must not be drawn: all entities, then all surrogates too, each written once
    taken, done, open_ = [real.select(_clash(F.col("norm")).alias("clash"))], [], real
    for attempt in range(rounds + longer):
        how = draw if attempt < rounds else draw_longer
        drawn = open_.withColumn("surrogate", how(F.col("kind"), F.col("norm"), F.col("gender"), key, F.lit(attempt)))
        drawn = checkpoint(drawn.withColumn("clash", _clash(F.col("surrogate"))))
        free = drawn.join(reduce(DataFrame.unionByName, taken), "clash", "left_anti")
        best = free.groupBy("clash").agg(F.min(F.struct(*names, "surrogate")).alias("b")).select("clash", "b.*")
        done.append(checkpoint(best.select(*names, "surrogate", "clash")))
        taken.append(done[-1].select("clash"))
        open_ = checkpoint(drawn.join(done[-1].select(*names), names, "left_anti").select(*names))
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, done).drop("clash")
    raise RuntimeError("no free surrogates are left for some entities")


def dressed(kind: Column, entity: Column, surrogate: Column) -> Column:
    """The surrogate in the occurrence's own format and case."""
    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("k"))
    spread = F.aggregate(
        F.filter(F.split(entity, ""), lambda c: c != ""),
        start,
        lambda a, c: F.when(
            c.rlike("[0-9A-Z]"), F.struct(F.concat(a["s"], F.substring(surrogate, a["k"] + 1, F.lit(1))).alias("s"), (a["k"] + 1).alias("k"))
        ).otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["k"].alias("k"))),
        lambda a: F.concat(a["s"], F.substring(surrogate, a["k"] + 1, F.lit(64))),
    )
    upper = (entity == F.upper(entity)) & (entity != F.lower(entity))
    cased = F.when(upper, F.upper(surrogate)).otherwise(surrogate)
    value = F.regexp_extract(entity, SECRET_VALUE, 1)
    secret = F.when((value == F.upper(value)) & (value != F.lower(value)), F.upper(surrogate)).otherwise(surrogate)
    around = F.regexp_extract_all(entity, F.lit(rf"""^{SECRET_WORD}["']?|["']$"""), F.lit(0))
    around = F.concat(F.get(around, F.lit(0)), secret, F.coalesce(F.get(around, F.lit(1)), F.lit("")))
    title = F.regexp_extract(entity, rf"^(?:{FEMALE}|{MALE}|{NEUTRAL})\.? ", 0)
    return (
        F.when(kind.isin("phone", "national_id", "account", "iban"), spread)
        .when(kind == "secret", around)
        .when(kind == "name", F.concat(title, surrogate))
        .otherwise(cased)
    )


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, n_pii): every row of docs with its entities replaced.

    Equal entities get equal surrogates across the corpus, different ones different
    surrogates; two words that are somewhere a name behind a title count as it without one, too.  A
    null text stays null with n_pii 0; a text without entities and without two capitalised words in a row
    comes back unchanged and is not shuffled.  Rows that repeat a doc_id and a text are treated alike.
    An empty table gives an empty result; other columns are not read.  The key is the
    caller's secret: with it, the surrogates of a corpus can be drawn again.
    """
    if not key:
        raise ValueError("a key is needed")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = base.withColumn("found", find(F.col("text")))
    rest = F.array_join(F.split(F.col("text"), PATTERN, -1), "\n")
    pairs = F.array_distinct(F.regexp_extract_all(F.when(F.size("found") > 0, rest).otherwise(F.col("text")), F.lit(TWO_WORDS), F.lit(1)))
    found = found.withColumn("pairs", F.coalesce(pairs, F.array().cast("array<string>")))
    # entities alone: small beside the texts, and read three times
    row = [F.coalesce(F.xxhash64("doc_id", "text"), F.lit(0)).alias("row"), F.coalesce("doc_id", F.lit(-1)).alias("doc_key")]
    listed = materialize(
        found.where(F.size("found") > 0)
        .select(*row, F.posexplode("found").alias("at", "entity"))
        .withColumn("kind", kind_of(F.col("entity")))
        .withColumn("norm", normal_form(F.col("kind"), F.col("entity")))
        .withColumn("gender", gender_of(F.col("entity"))),
        "pii-entities",
    )
    genders = known_gender(listed.where("kind = 'name'"))
    listed = listed.join(genders, ["kind", "norm", "gender"], "left").withColumn("gender", F.coalesce("as", "gender")).drop("as")
    table = materialize(surrogates(listed.select("kind", "norm", "gender"), key), "pii-surrogates")
    lost = F.raise_error(F.lit("an entity has no surrogate")).cast("string")
    named = listed.join(table, ["kind", "norm", "gender"], "left").select("row", "doc_key", "at", F.coalesce(dressed(F.col("kind"), F.col("entity"), F.col("surrogate")), lost).alias("new"))
    news = named.distinct().groupBy("row", "doc_key").agg(F.array_sort(F.collect_list(F.struct("at", "new"))).alias("news"))
    # the same people without a title: a name under titles of both genders takes the first one's surrogate
    people = table.where("kind = 'name' and norm like '% %'").groupBy("norm").agg(F.min(F.struct("gender", "surrogate"))["surrogate"].alias("surrogate"))
    again = found.where(F.size("pairs") > 0).select(*row, F.explode("pairs").alias("entity")).withColumn("norm", F.lower("entity"))
    again = again.join(people, "norm").select("row", "doc_key", "entity", dressed(F.lit("name"), F.col("entity"), F.col("surrogate")).alias("new"))
    repeats = again.distinct().groupBy("row", "doc_key").agg(F.array_sort(F.collect_list(F.struct("entity", "new"))).alias("repeats"))
    between = F.split(F.col("text"), PATTERN, -1)
    whole = lambda entity: F.concat(F.lit(r"(?<!\p{L})"), entity, F.lit(r"(?!\p{L})"))

    def renamed(part: Column) -> Column:
        return F.aggregate(F.coalesce("repeats", F.array()), part, lambda t, r: F.regexp_replace(t, whole(r["entity"]), r["new"]))

    any_name = F.concat(F.lit("(?:"), F.array_join(F.col("repeats.entity"), "|"), F.lit(")"))
    n_repeats = F.when(F.col("repeats").isNotNull(), F.regexp_count(rest, whole(any_name))).otherwise(0)
    touched = (
        found.where((F.size("found") > 0) | (F.size("pairs") > 0))
        .select("doc_id", "text", *row)
        .join(news, ["row", "doc_key"], "left")
        .join(repeats, ["row", "doc_key"], "left")
        .select(
            "doc_id",
            F.array_join(
                F.zip_with(F.transform(between, renamed), F.coalesce("news.new", F.array().cast("array<string>")), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))),
                "",
            ).alias("text"),
            (F.when(F.col("news").isNotNull(), F.size("news")).otherwise(0) + n_repeats).cast("long").alias("n_pii"),
        )
    )
    plain = found.where("coalesce(size(found), 0) <= 0 and coalesce(size(pairs), 0) <= 0").select("doc_id", "text", F.lit(0).cast("long").alias("n_pii"))
    return plain.unionByName(touched)


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text, n_pii of every document; the key is fixed, so that the query's reruns agree."""
    return pseudonymise(read_table(spark, sf_dir, "documents"), key="pagelattice")
