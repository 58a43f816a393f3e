"""Token functions: Column in, Column out, no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that fix results: fixed values.
CODE = r"^[A-Za-z0-9]{3,8}$"
NUMBER = r"\d{1,4}(?:[.,]\d{1,2})?"
SIZE = rf'(?iU)\b{NUMBER}\s*[x×]\s*{NUMBER}\s*(?:cm|mm)?(?=\b|")'
COMPOSITE = rf'(?iU)\b({NUMBER}\s*[x×]\s*{NUMBER})(?:\s*[x×]\s*{NUMBER})+\s*(?:cm|mm)?(?=\b|")'
BAND = r"^[A-Z]\d{1,2}$"
UNIT = r"^(?:CM|MM|M)[23]$"
THICKNESS = r"^\d{1,2}(?:[.,]\d)?MM$"
SIZE_LEAK = r"^\d{1,4}(?:[.,]\d{1,2})?(?:X\d{1,4}(?:[.,]\d{1,2})?)+(?:CM|MM|H)?$"
PACK_VALUE = r"^\d{1,4}(?:[.,]\d{1,3})?$"
PACK_HEADERS = (
    ("pcsBox", r"\b(?:PZ|PCS|PIECES|PZZ)\b"),
    ("m2Box", r"\b(?:MQ|M2|SQM)\b"),
    ("kgBox", r"\bKG\b"),
)
VERSION_YEAR = r"(20\d\d)(?:[.\-]?(\d\d))?"


def norm(text: Column) -> Column:
    """Upper case without enclosing punctuation."""
    return F.upper(F.btrim(text, F.lit("*,;:().")))


def is_code_shape(token: Column) -> Column:
    return token.rlike(CODE)


def is_alnum_code(token: Column) -> Column:
    """Code shape with a digit and a letter, and no size."""
    return token.rlike(CODE) & token.rlike("[0-9]") & token.rlike(r"\p{L}") & ~token.rlike(SIZE)


def is_alpha(token: Column, least: int = 3) -> Column:
    return token.rlike(rf"^\p{{L}}{{{least},}}$")


def is_lower(raw: Column) -> Column:
    return (raw == F.lower(raw)) & (raw != F.upper(raw))


def size_of(text: Column, version: int = 12) -> Column:
    """First size in a text, or null; from version 4 the head of a composite size."""
    plain = F.nullif(F.regexp_extract(text, SIZE, 0), F.lit(""))
    if version < 4:
        return plain
    return F.coalesce(F.nullif(F.regexp_extract(text, COMPOSITE, 1), F.lit("")), plain)


def size_hits(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SIZE))


def norm_size(size: Column) -> Column:
    return F.replace(F.replace(F.lower(size), F.lit("×"), F.lit("x")), F.lit(" "), F.lit(""))


def is_name_shape(raw: Column) -> Column:
    """A colour name before the vocabulary is asked: letters only, three or more, not all lower case."""
    return is_alpha(norm(raw)) & ~is_lower(raw)


def is_latin(text: Column) -> Column:
    return ~text.rlike(r"[\p{L}&&[^\u0000-ɏ]]")


def color_quality(name: Column) -> Column:
    words = F.size(F.filter(F.split(name, r"\s+"), lambda x: x != ""))
    review = (words >= 4) | (F.char_length(name) > 30) | ~is_latin(name)
    return F.when(name.isNull(), F.lit(None)).when(review, "needs_review").otherwise("clean")


def junk_kind(token: Column, family: Column, least: int = 3) -> Column:
    """band, unit, thickness or size, in this order; null for what stays a candidate.
    family is the number of band-shaped candidates of the document with the same letter."""
    return (
        F.when(token.rlike(BAND) & (family >= least), "band")
        .when(token.rlike(UNIT), "unit")
        .when(token.rlike(THICKNESS), "thickness")
        .when(token.rlike(SIZE_LEAK), "size")
    )


def pack_field(text: Column) -> Column:
    """The packing field a column header names, or null."""
    t = F.replace(F.upper(text), F.lit("²"), F.lit("2"))
    out = F.lit(None).cast("string")
    for field, pattern in reversed(PACK_HEADERS):
        out = F.when(t.rlike(pattern), field).otherwise(out)
    return out


def version_year(name: Column) -> Column:
    """Year, with month where one follows, from a file name."""
    return F.nullif(F.regexp_extract(name, VERSION_YEAR, 0), F.lit(""))
