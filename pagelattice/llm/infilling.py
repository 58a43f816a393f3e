"""Fill-in-middle transformation over run-length encoded character classes.

A text is a row of units: a run of ASCII letters is one unit, any other code point is one.
`ClassRuns` stores the maximal runs of either class with the units and code points before each;
the cut after any number of units is found by binary search in those counts and one division,
so neither a list of tokens nor a walk over the text is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Share in percent of the texts that are cut, and of those in suffix-prefix-middle form.
FIM_RATE, SPM_RATE = 90, 20
#: Bytes of text that a task holds in one batch of results.
BATCH_BYTES = 1 << 25


class ClassRuns:
    """Maximal runs of letters and of other code points in a UTF-8 text.

    at[i], units[i] and chars[i] are the bytes, units and code points before run i (one more
    entry holds the totals); letters says whether run 0 is one of letters, runs alternate.
    """

    def __init__(self, text: bytes):
        raw = np.frombuffer(text, np.uint8)
        letter = ((raw | 32) - np.uint8(97)) < 26
        turns = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        self.at = np.concatenate(([0], turns, [len(raw)] if len(raw) else [])).astype(np.int64)
        self.letters = bool(len(raw)) and bool(letter[0])
        self.starts = (raw & 0xC0) != 0x80
        chars = np.add.reduceat(self.starts, self.at[:-1], dtype=np.int64) if len(raw) else np.zeros(0, np.int64)
        units = chars.copy()
        units[0 if self.letters else 1 :: 2] = 1
        self.chars = np.concatenate(([0], np.cumsum(chars)))
        self.units = np.concatenate(([0], np.cumsum(units)))

    def __len__(self) -> int:
        """Units of the text."""
        return int(self.units[-1])

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) before the cut after k units."""
        run = int(np.searchsorted(self.units, k, "right")) - 1
        at, chars, over = int(self.at[run]), int(self.chars[run]), k - int(self.units[run])
        if not over:
            return at, chars
        # k lies inside a run of other code points: unit and code point counts run alike in it.
        width, n = int(self.at[run + 1]) - at, int(self.chars[run + 1]) - chars
        if width % n == 0 and (width == n or self._even(at, at + width, width // n)):
            return at + over * (width // n), chars + over
        return at + int(np.flatnonzero(self.starts[at : at + width])[over]), chars + over

    def _even(self, a: int, b: int, width: int) -> bool:
        """Whether every code point between two bytes takes `width` bytes."""
        return bool(self.starts[a:b:width].all())


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers that depend on the seed and the id alone (a null id counts as no digits)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))  # type: ignore[return-value]


def infill(text: bytes | None, doc_id: int | None, seed: int = 1, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE):
    """(output, n, form, prefix_chars, middle_chars) of one text; the counts are None where form is plain."""
    text = text or b""
    runs = ClassRuns(text)
    n, (h1, h2, h3, h4) = len(runs), draws(doc_id, seed)
    if not text or h3 % 100 >= fim_rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return text, n, "plain", None, None
    (a, a_chars), (b, b_chars) = (runs.cut(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_rate:
        form, parts = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    else:
        form, parts = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    return b"".join(parts), n, form, a_chars, b_chars - a_chars


def transform(docs: DataFrame, seed: int = 1, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE, into: str = "fim") -> DataFrame:
    """The documents with their texts in fill-in-middle form and a struct `into` (n, form, prefix_chars, middle_chars).

    A null text counts as empty and becomes one; empty texts and texts that hold a marker stay
    plain, so that `restored` always finds the text again.  Rows that share a doc_id get the same
    draws, equal rows equal results; rows without one draw as an id without digits.  Other columns
    are handed on, but one named like `into` is replaced.  An empty table gives none.
    """
    columns = [c for c in docs.columns if c.lower() != into.lower()]
    id_at, text_at = columns.index("doc_id"), columns.index("text")
    given = docs.select(*(F.col(f"`{c}`").cast("string").alias(c) if c == "text" else F.col(f"`{c}`") for c in columns))
    struct = "struct<n:long,form:string,prefix_chars:long,middle_chars:long>"
    kind = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())])

    def rows_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Pieces of some BATCH_BYTES of text, one row at least."""
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_at)), 0).to_numpy()
        group = (np.cumsum(sizes) // BATCH_BYTES).tolist()
        first = 0
        for i in range(1, len(group) + 1):
            if i == len(group) or group[i] != group[first]:
                yield batch.slice(first, i - first)
                first = i

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in rows_of(whole):
                texts, ids = b.column(text_at).cast(pa.binary()).to_pylist(), b.column(id_at).to_pylist()
                done = [infill(t, i, seed, fim_rate, spm_rate) for t, i in zip(texts, ids, strict=True)]
                out, *facts = zip(*done, strict=True) if done else [()] * 5
                struct_column = pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(facts, kind, strict=True)], fields=list(kind))
                text = pa.array(out, pa.binary()).cast(pa.string())
                kept = [text.cast(c.type) if i == text_at else c for i, c in enumerate(b.columns)]
                yield pa.RecordBatch.from_arrays([*kept, struct_column], [*b.schema.names, into])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields] + [f"`{into}` {struct}"])
    return given.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that a fill-in-middle output was made from."""
    last, width = MIDDLE.decode(), len(MIDDLE)

    def parts(second: str) -> tuple[Column, Column, Column]:
        """What follows the three markers of an output whose second one is `second`."""
        b = F.locate(second, output, width + 1)
        c = b + width - 1 + F.instr(F.substr(output, b + width), F.lit(last))
        return F.substr(output, F.lit(width + 1), b - width - 1), F.substr(output, b + width, c - b - width), F.substr(output, c + width)

    prefix, suffix, middle = parts(SUFFIX.decode())
    suffix_first, prefix_next, middle_last = parts(PREFIX.decode())
    psm, spm = F.concat(prefix, middle, suffix), F.concat(prefix_next, middle_last, suffix_first)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every document."""
    done = transform(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2("text", 256).alias("output_sha256"),
        F.sha2(restored(F.col("text"), F.col("fim.form")), 256).alias("restored_sha256"),
    )


OP13_SQL = """
with h as (select doc_id, coalesce(text, '') t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) x from documents),
u as (select *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') w, ('0x' || x[1:8])::bigint h1, ('0x' || x[9:16])::bigint h2,
  ('0x' || x[17:24])::bigint h3, ('0x' || x[25:32])::bigint h4 from h),
f as (select *, cast(len(w) as bigint) n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) b,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end form from u),
p as (select *, array_to_string(w[1 : a], '') p, array_to_string(w[a + 1 : b], '') m, array_to_string(w[b + 1 :], '') s from f)
select doc_id, n, form, case when form <> 'plain' then cast(length(p) as bigint) end prefix_chars, case when form <> 'plain' then cast(length(m) as bigint) end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256,
  sha256(t) restored_sha256
from p
"""
