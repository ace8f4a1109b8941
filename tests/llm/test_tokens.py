import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weekloom.llm import token_counts, token_file
from weekloom.llm.common import new_path

from .helpers_llm import awkward, documents, empty, random_texts

ODD = ["", " ", "  a", "a  ", "a \nb", "a\n b", "x   y", " \n \t q", "don't  can't 's", "a <|endoftext|> b", "▁a b", "a b",
       "\x1c a \x1d", "ﬁ Å ½ ① a", "日本 語 🙂 x", "\x00 a", "<s> </s> <unk>", "ab,cd. e-f", "été, naïve!"]


@pytest.fixture(scope="module")
def piece_model():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def byte_model():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab é\n\t.,'! ▁1日"), max_size=30), max_size=5))
def test_word_counts_equal_the_library(texts):
    counter = token_counts.counter("piece_bpe_32k.model")
    assert counter.counts(texts) == [len(x) for x in counter.model.encode(texts)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abt é\n\t.,'s! 1日"), max_size=30), max_size=5))
def test_word_ids_equal_the_library(texts):
    encoder = token_file.encoder("byte_bpe_50k.json")
    assert encoder.by_word
    assert [x.tolist() for x in encoder.encode(texts)] == [encoder.model.encode(t, add_special_tokens=False).ids for t in texts]


def test_counts_and_cache(spark, piece_model):
    texts = ODD + random_texts(1, 40) + ["again and again"] * 5 + [None]
    cache = new_path(spark, "cache")
    got = token_counts.count_tokens(documents(spark, texts), cache, limit=20).collect()
    assert len(got) == len(texts)
    for row in got:
        text = texts[row.doc_id] or ""
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n := len(piece_model.encode(text)), n > 20)
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for t in texts})
    token_counts.count_tokens(documents(spark, [*texts, "one more text"]), cache).collect()
    assert spark.read.parquet(cache).count() == stored + 1


def test_counts_of_a_json_model(spark, byte_model):
    got = token_counts.count_tokens(documents(spark, ODD), new_path(spark, "cache"), "byte_bpe_50k.json").collect()
    assert all(r.n_tokens == len(byte_model.encode(ODD[r.doc_id], add_special_tokens=False).ids) for r in got)


def test_counts_of_awkward_and_empty_tables(spark):
    assert token_counts.count_tokens(awkward(spark), new_path(spark, "cache")).count() == 10
    assert token_counts.count_tokens(empty(spark), new_path(spark, "cache")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=2000), st.data())
def test_codes_give_any_id_and_slice(ids, data):
    ids = np.array(ids, np.uint32)
    codes = token_file.Codes(token_file.pack(ids))
    start = data.draw(st.integers(0, len(ids)))
    end = data.draw(st.integers(start, len(ids)))
    assert (codes.slice(start, end) == ids[start:end]).all()
    at = data.draw(st.integers(0, len(ids) - 1))
    assert codes[at] == ids[at] and len(codes) == len(ids)


def test_files_hold_all_documents_in_order(spark, byte_model, monkeypatch):
    texts = ODD + random_texts(2, 60) + [None]
    path = new_path(spark, "tokens")
    token_file.write_tokens(documents(spark, texts).repartition(5), path)
    got = sorted(token_file.document_digests(spark, path).collect(), key=lambda r: r.doc_id)
    start = 0
    for row, text in zip(got, texts, strict=True):
        ids = [*byte_model.encode(text or "", add_special_tokens=False).ids, 0]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_files_of_awkward_and_empty_tables(spark):
    path = new_path(spark, "tokens")
    token_file.write_tokens(awkward(spark), path)
    got = token_file.document_digests(spark, path).collect()
    assert len(got) == 10 and sorted(r.start for r in got)[0] == 0
    path = new_path(spark, "tokens")
    token_file.write_tokens(empty(spark), path)
    assert token_file.document_digests(spark, path).count() == 0
