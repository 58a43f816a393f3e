import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagelattice.llm import tokens
from pagelattice.llm.wavelet import Shard, WaveletMatrix


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def want(rows, plain):
    out, at = [], 0
    for doc_id, text in rows:
        ids = [*plain(text), tokens.END_ID]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_documents_against_the_library(documents, texts, plain):
    got = sorted(tuple(r) for r in tokens.token_table(documents, shard_tokens=5_000).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == want(sorted(texts.items()), plain)


def test_odd_rows(odd, plain):
    rows = sorted(odd.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0))
    got = [tuple(r) for r in tokens.token_table(odd).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()]
    assert got == want([tuple(r) for r in rows], plain)
    assert tokens.token_table(odd.where(F.lit(False))).count() == 0


def _encoders(made={}):
    """This module's encoder and the library's plain one, for both readings of special tokens."""
    if not made:
        path = public_tokenizers.path("byte_bpe_50k.json")
        for as_text in (False, True):
            t = Tokenizer.from_file(path)
            t.encode_special_tokens = as_text
            made[as_text] = tokens.Encoder(path, None, as_text), t
    return made


_TEXTS = st.lists(st.sampled_from([*"abAst'.,;:!?1| \n\t\r\0\x1c\u3000éЖ世ɐԱ\u0301²", "<|endoftext|>", " the", "\n- ", "don't"]), max_size=30).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(_TEXTS, max_size=5), st.booleans())
def test_pieces_apart_equal_whole(batch, as_text):
    encode, plain = _encoders()[as_text]
    assert encode.apart
    assert [x.tolist() for x in encode(batch)] == [plain.encode(t, add_special_tokens=False).ids for t in batch]


def test_forgetting_changes_nothing(texts, monkeypatch):
    monkeypatch.setattr(tokens, "_MEMORY", 500)
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, plain = tokens.Encoder(path, None), Tokenizer.from_file(path)
    some = list(texts.values())
    got = [x.tolist() for at in range(0, len(some), 20) for x in encode(some[at : at + 20])]
    assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in some] and len(encode.codes) < 20_000


def test_special_tokens_are_read_as_the_library_reads_them(spark):
    rows = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id long, text string")
    got = {s: tokens.token_table(rows, end_id=None, special_as_text=s).first()["n_tokens"] for s in (False, True)}
    assert got == {False: 3, True: 9}


def test_other_tokenizer(odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.token_table(odd, tokenizer=path, end_id=None).collect()}
    assert got[4] == len(t.encode("one", add_special_tokens=False).ids) and got[1] == 0


@pytest.mark.parametrize("n", [0, 1, 7, 511, 512, 513, 5000])
@pytest.mark.parametrize("top", [1, 2, 300, 50_000, 100_000])
def test_matrix(n, top):
    ids = np.random.default_rng(n + top).integers(0, top, n) ** 2 // max(1, top - 1)
    shard = Shard.from_bytes(Shard.build([3], [ids.astype(np.uint32)]).to_bytes())
    m = shard.matrix
    assert (m.decode() == ids).all() and (m.access(np.arange(n)) == ids).all()
    for token in {0, 1, top - 1, top * 4, *ids[:5].tolist()}:
        assert m.count(token) == (ids == token).sum()
        assert m.count(token, n // 3, n // 2) == (ids[n // 3 : n // 2] == token).sum()
        assert (m.occurrences(token) == np.flatnonzero(ids == token)).all()


def test_queries_on_files(spark, documents, texts, plain):
    path = tokens.shared_path(spark, "test-tokens")
    tokens.write_tokens(documents, path, shard_tokens=5_000)
    ids = {i: [*plain(t), tokens.END_ID] for i, t in texts.items()}
    some = [2, 262, 50_000, 49_999]
    got = {r["token"]: r["n"] for r in tokens.count_tokens(spark, path, some).collect()}
    assert got == {t: sum(x.count(t) for x in ids.values()) for t in some}
    places = sorted(tuple(r) for r in tokens.find_token(spark, path, 262).collect())
    assert places == sorted((i, k) for i, x in ids.items() for k, t in enumerate(x) if t == 262)
    back = {r["doc_id"]: r["ids"] for r in tokens.read_documents(spark, path, with_tokens=True).collect()}
    assert back == ids
    assert spark.read.format("binaryFile").load(path).count() == spark.read.parquet(path).count()


def test_bad_file():
    with pytest.raises(ValueError):
        Shard.from_bytes(b"x" * 64)
    assert WaveletMatrix.build(np.empty(0, np.uint32)).count(5) == 0
