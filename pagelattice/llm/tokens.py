"""Token-ID output: texts are encoded with a public tokenizer and stored as wavelet-matrix shards.

Documents are range-partitioned and sorted by doc_id (their texts move once), encoded in
the task that writes them, and leave it as shards of bounded size.  Each shard is one
compressed file, written through Spark's own committer: a lost executor or a speculative
task leaves no half-written shard, and any file system that Spark can write will do.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import delete, read_table, shared_path
from .wavelet import Shard

END_ID = 2
SHARD_TOKENS = 1 << 21
#: Before a space or line feed that stands alone between other characters, the byte-level pattern always splits.
_APART = re.compile(r"(?<!\s)(?=[ \n](?!\s))")
#: A mark before a piece that follows no space, and texts that hold it are encoded whole.
_HEAD = "\0"
_ODD = re.compile(r"\s\s")
_STOPS = ".,;:!?"
#: Letters up to here (Latin, Greek, Cyrillic) are letters in every version of Unicode.
_OLD_LETTERS = "\u0500"
#: What an encoder remembers: pieces, and characters in them.
_MEMORY = 1_200_000
_CHARACTERS = 32_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return "".join(chr(b if b in own else next(other)) for b in range(256))


class _Codes(dict):
    """Numbers of the pieces seen; new ones are noted down for encoding."""

    def __init__(self) -> None:
        super().__init__({None: 0})  # the end of a document
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        code = self[piece] = len(self)
        return code


class Encoder:
    """Encodes texts with the tokenizers library, remembering the ids of pieces.

    A byte-level tokenizer splits a text by a fixed pattern before any merge, and always
    splits before a lone space or line feed, so pieces between those can be encoded apart
    and their ids joined.  Tokenizers of another make encode each text whole, as do texts
    that hold a special token's string.  That string counts as the library reads it: as the
    token, or with special_as_text as ordinary text.
    """

    def __init__(self, path: str, end_id: int | None = END_ID, special_as_text: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        made = json.loads(self.tokenizer.to_str())
        splits = made["pre_tokenizer"] or {}
        self.apart = (
            splits.get("type") == "ByteLevel"
            and splits.get("use_regex", True)
            and not splits["add_prefix_space"]
            and made["model"].get("type", "BPE") == "BPE"
            and not any(made.get(k) for k in ("normalizer", "truncation", "padding"))
        )
        self.special = [t["content"] for t in made["added_tokens"]]
        self.letters = dict(enumerate(_byte_letters()))
        self.end = [] if end_id is None else [end_id]
        self.marks = {m: self.tokenizer.encode(m, add_special_tokens=False).ids[0] for m in _STOPS}
        self._forget()

    @classmethod
    def of(cls, path: str, end_id: int | None, special_as_text: bool, made: dict[tuple, Encoder] = {}) -> Encoder:  # noqa: B006
        """The process's encoder: what it remembers serves all tasks that the process runs."""
        key = path, end_id, special_as_text
        if key not in made:
            made[key] = cls(*key)
        return made[key]

    def _forget(self) -> None:
        self.codes, self.characters, self.used = _Codes(), 0, len(self.end)
        self.pool = np.zeros(1 << 16, np.uint32)  # ids of all pieces, one after the other
        self.pool[: self.used] = self.end
        self.begin, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.length[0] = self.used

    def _learn(self, pieces: list[str], length: np.ndarray, ids: np.ndarray) -> None:
        codes = np.fromiter(map(self.codes.__getitem__, pieces), np.int64, len(pieces))
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(len(self.pool) + len(ids), np.uint32)))
        if len(self.codes) > len(self.begin):
            more = np.zeros(len(self.codes), np.int64)
            self.begin, self.length = np.concatenate((self.begin, more)), np.concatenate((self.length, more))
        self.pool[self.used : self.used + len(ids)] = ids
        self.begin[codes], self.length[codes] = self.used + np.cumsum(length) - length, length
        self.used += len(ids)
        self.characters += sum(map(len, pieces))

    def _learn_lists(self, pieces: list[str], encoded: list[list[int]]) -> None:
        length = np.fromiter(map(len, encoded), np.int64, len(encoded))
        self._learn(pieces, length, np.fromiter(chain.from_iterable(encoded), np.uint32, int(length.sum())))

    def _places(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of the codes has, and where all of them stand in the pool."""
        length = self.length[codes]
        end = np.cumsum(length)
        return length, np.repeat(self.begin[codes] - end + length, length) + np.arange(end[-1] if len(end) else 0)

    def _whole(self, texts: list[str]) -> Iterator[list[int]]:
        for at in range(0, len(texts), 2000):
            for e in self.tokenizer.encode_batch_fast(texts[at : at + 2000], add_special_tokens=False):
                yield e.ids

    def _encode_new(self) -> None:
        """Ids of the pieces noted down.  A piece that begins with _HEAD stands first in its text or line; others follow a space."""
        single, spelled, mixed, ended = [], [], [], []
        lead, letters = self.letters[ord(" ")], self.letters
        while self.codes.new:
            pieces, self.codes.new = self.codes.new, []
            for piece in pieces:
                word = piece[1:] if piece[:1] == _HEAD else piece
                if not word.isalpha():
                    if word[-1:] in _STOPS and word[:-1].isalpha() and (word.isascii() or max(word) < _OLD_LETTERS):
                        self.codes[piece[:-1]]  # the pattern splits between a letter and a mark
                        ended.append(piece)
                    else:
                        mixed.append(piece)
                    continue
                if not word.isascii():
                    if max(word) >= _OLD_LETTERS:
                        mixed.append(piece)
                        continue
                    word = word.encode().decode("latin-1").translate(letters)
                single.append(piece)
                spelled.append(word if piece[0] == _HEAD else lead + word)
        self._learn_lists(single, [[t.id for t in x] for x in map(self.tokenizer.model.tokenize, spelled)])  # the pattern leaves them whole
        self._learn_lists(mixed, list(self._whole([x[1:] if x[:1] == _HEAD else x if x[:1] == "\n" else " " + x for x in mixed])))
        length, places = self._places(np.fromiter((self.codes[x[:-1]] for x in ended), np.int64, len(ended)))
        marks = np.fromiter((self.marks[x[-1]] for x in ended), np.uint32, len(ended))
        self._learn(ended, length + 1, np.insert(self.pool[places], np.cumsum(length), marks))

    def _split(self, text: str) -> list[str]:
        """The pieces of a text as _encode_new names them."""
        if _ODD.search(text):
            first, *rest = _APART.split(text)
            return [_HEAD + first, *(x[1:] if x[0] == " " else x for x in rest)]
        return (_HEAD + text.replace("\n", " \n " + _HEAD)).split(" ")

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text and the end id; null counts as empty."""
        if not self.apart:
            return [np.array([*ids, *self.end], np.uint32) for ids in self._whole([t or "" for t in texts])]
        if len(self.codes) > _MEMORY or self.characters > _CHARACTERS:
            self._forget()
        got: list[int] = []
        code, cuts, out = self.codes.__getitem__, [0], {}
        for k, text in enumerate(texts):
            text = text or ""
            if _HEAD in text or any(s in text for s in self.special):
                out[k] = text
                text = ""
            pieces = self._split(text)
            pieces.append(None)
            got.extend(map(code, pieces))
            cuts.append(len(got))
        self._encode_new()
        codes = np.array(got, np.int64)
        length, places = self._places(codes)
        ids = self.pool[places]
        ends = np.concatenate(([0], np.cumsum(length)))[cuts].tolist()
        found = [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        for k, one in zip(out, self._whole(list(out.values())), strict=True):
            found[k] = np.array([*one, *self.end], np.uint32)
        return found


def encode_shards(
    docs: DataFrame, tokenizer: str | None = None, end_id: int | None = END_ID, shard_tokens: int = SHARD_TOKENS, special_as_text: bool = False
) -> DataFrame:
    """(shard, n_docs, n_tokens, payload): shards in ascending doc_id order, each of about shard_tokens tokens
    (more only if a single text has more).  Null ids come first; rows that repeat a doc_id stand together, in
    the order of their texts' hashes, by which a crowded id is split over tasks too.  A text's special tokens
    count as the library reads them, unless special_as_text."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = Encoder.of(path, end_id, special_as_text), TaskContext.get().partitionId() << 24
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, tokens, held, shard
            out = [[shard], [len(ids)], [held], [Shard.build(ids, tokens).to_bytes()]]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            shard, ids, tokens, held = shard + 1, [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["shard", "n_docs", "n_tokens", "payload"]
            )

        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                for doc_id, found in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                    ids.append(doc_id)
                    tokens.append(found)
                    held += len(found)
                    if held >= shard_tokens:
                        yield flush()
        if ids:
            yield flush()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    ordered = narrow.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return ordered.mapInArrow(run, "shard long, n_docs long, n_tokens long, payload binary")


def write_tokens(docs: DataFrame, path: str, **parameters) -> None:
    """Write the documents' ids under `path`, one zstd-compressed file per shard."""
    encode_shards(docs, **parameters).write.option("compression", "zstd").option("maxRecordsPerFile", 1).parquet(path)


def shard_bases(spark: SparkSession, path: str) -> DataFrame:
    """(shard, base): the number of tokens in all shards before.  One narrow row a shard of some million tokens."""
    before = Window.partitionBy(F.lit(1)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = spark.read.schema("shard long, n_tokens long").parquet(path)
    return sizes.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))


def read_documents(spark: SparkSession, path: str, with_tokens: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every stored document, read from the shards."""
    more = ", ids array<long>" * with_tokens
    schema = f"shard long, doc_id long, start long, n_tokens long, ids_crc32 long{more}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, payload in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                shard = Shard.from_bytes(payload.as_py())
                ids = shard.matrix.decode().astype("<u4")
                cuts = shard.starts.tolist()
                parts = [ids[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]
                columns = [
                    pa.array([number] * len(parts), pa.int64()),
                    pa.array(shard.ids(), pa.int64()),
                    pa.array(shard.starts[:-1], pa.int64()),
                    pa.array(np.diff(shard.starts), pa.int64()),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                ]
                names = ["shard", "doc_id", "start", "n_tokens", "ids_crc32"]
                if with_tokens:
                    columns.append(pa.array([p.tolist() for p in parts], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    stored = spark.read.schema("shard long, payload binary").parquet(path).mapInArrow(run, schema)
    columns = ["n_tokens", "ids_crc32", *["ids"] * with_tokens]
    return stored.join(shard_bases(spark, path), "shard").select("doc_id", (F.col("start") + F.col("base")).alias("start"), *columns)


def count_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """(token, n): occurrences of each token, counted by rank on the stored planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for payload in b.column(0):
                matrix = Shard.from_bytes(payload.as_py()).matrix
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens, pa.int64()), pa.array([matrix.count(t) for t in tokens], pa.int64())], ["token", "n"]
                )

    found = spark.read.schema("payload binary").parquet(path).mapInArrow(run, "token long, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(doc_id, at): every occurrence of a token, as an offset within its document, by select on the stored planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for payload in b.column(0):
                shard = Shard.from_bytes(payload.as_py())
                doc, at = shard.documents_at(shard.matrix.occurrences(token))
                ids = shard.ids()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[d] for d in doc], pa.int64()), pa.array(at, pa.int64())], ["doc_id", "at"]
                )

    return spark.read.schema("payload binary").parquet(path).mapInArrow(run, "doc_id long, at long")


def token_table(docs: DataFrame, **parameters) -> DataFrame:
    """Write the documents into a fresh shared folder and return what the files hold."""
    import atexit

    spark = docs.sparkSession
    path = shared_path(spark, "tokens")
    atexit.register(delete, spark, path)
    write_tokens(docs, path, **parameters)
    return read_documents(spark, path)


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files written."""
    return token_table(read_table(spark, sf_dir, "documents"))
