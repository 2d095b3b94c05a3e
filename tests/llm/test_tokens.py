"""Wavelet matrix and token shards: exact round trips and brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from signalbox.llm import wavelet
from signalbox.llm.common import work_root

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected(tokenizer, rows):
    """(doc_id, start, n, crc) in ascending (doc_id, text) order, null ids first."""
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70000), max_size=1500), st.integers(0, 70000))
def test_matrix(ids, other):
    a = np.array(ids, np.uint32)
    m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.of(a).to_bytes())
    assert (m.ids() == a).all() and m.n == len(a)
    for token in {*ids[:3], other}:
        at = [i for i, x in enumerate(ids) if x == token]
        assert m.count(token) == len(at)
        assert [m.select(token, k) for k in range(len(at))] == at and m.select(token, len(at)) == -1
        assert m.rank(token, len(ids) // 2) == sum(i < len(ids) // 2 for i in at)
    for i in range(0, len(ids), 97):
        assert m.access(i) == ids[i]
    with pytest.raises(IndexError):
        m.access(len(ids))


TEXTS = ["", " ", "a  b", "\n a\n\nb \t c", " lead", "trail ", "it's we'll  don't", "é ñ 中文 🙂 x", "<|endoftext|> a <|endoftext|>", "a b",
         "a\x1cb \x1c c", "x" * 5000, "1 22 333 4444", "a\r\nb", "word " * 300, "… — “q”", " \x85a", "a.\n\nB, c.\nD", "x\n\n\ny", "end\n", "end\n\n", "\n", "\n\n", "\n\na", "a .\n, b", "é.\nÉ, ².", "a\n b", "it's.\n's"]


def test_encoder_equals_whole_text_encoding(tokenizer):
    got = wavelet.TextEncoder().encode(TEXTS * 2)
    for t, ids in zip(TEXTS * 2, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t[:40])


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abs1'., \n\n\té　\x85 ")) | st.characters(exclude_categories=["Cs"]), max_size=60))
def test_encoder_on_any_text(text):
    whole = test_encoder_on_any_text.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(test_encoder_on_any_text.encoder.encode([text])[0], "<u4").tolist() == whole


def test_a_piece_is_encoded_once(monkeypatch):
    encoder, text = wavelet.TextEncoder(), "of sixteenletterabc and sixteenletterabc x"
    want = encoder.encode([text, text])
    monkeypatch.setattr(encoder, "_together", None)  # nothing is new any more
    assert encoder.encode([text]) == want[:1] and want[0] == want[1] == encoder._whole([text])[0]
    monkeypatch.undo()
    assert encoder.encode(["", text, " x", "<|endoftext|>", text]) == encoder._whole(["", text, " x", "<|endoftext|>", text])


def test_added_tokens_are_ids_of_their_own():
    got = wavelet.TextEncoder().encode(["a <|endoftext|> b", "a<|endoftext|>", "a <|endoftext b"])
    assert np.frombuffer(got[0], "<u4").tolist() == [64, 220, 50256, 275]
    assert np.frombuffer(got[1], "<u4").tolist() == [64, 50256] and 50256 not in np.frombuffer(got[2], "<u4")


test_encoder_on_any_text.encoder = wavelet.TextEncoder()
test_encoder_on_any_text.tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()]


def test_token_report(spark, tokenizer):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert rows_of(wavelet.token_report(df, shard_tokens=5000)) == expected(tokenizer, rows)


def test_odd_rows_and_extra_columns(spark, tokenizer):
    rows = [(3, None), (3, "a b"), (3, "a b"), (None, "null id"), (1, ""), (2, "long " * 50000), (-7, "negative"), (4, "x <|endoftext|> y")]
    df = spark.createDataFrame(rows, DOC).withColumns({c: F.lit("x") for c in ("part", "seq", "matrix", "start", "n_tokens")})
    assert rows_of(wavelet.token_report(df)) == expected(tokenizer, rows)
    assert wavelet.token_report(df.where("false")).count() == 0


def test_occurrences_by_select(spark, tokenizer):
    rows = [(i, f"alpha beta {i} alpha") for i in range(50)]
    out = f"{work_root(spark)}/occurrences"
    wavelet.write_shards(spark.createDataFrame(rows, DOC), out, shard_tokens=64)
    shards = wavelet.read_shards(spark, out)
    assert shards.count() > 3 and len(shards.inputFiles()) == shards.count()
    token = tokenizer.encode(" alpha", add_special_tokens=False).ids[0]
    found = [r.doc_id for r in wavelet.occurrences(shards, token).collect()]
    assert sorted(found) == list(range(50))
