import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierflow.llm.perfect_hash import KeyIndex, PerfectHash
from tierflow.llm.queries import LLM_QUERIES
from tierflow.llm.runtime import prepare
from tierflow.llm.tokens import Encoder, open_folder, write_tokens

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


TEXTS = ["", " ", "Hello  world's\n\nend\t.", "ΣΑΣ ΟΔΟΣ İstanbul", "é ́e a　b\x0bc\x1cd\x85e f", "<|endoftext|> x<|startoftext|>y",
         "don't 'S 12345 ½ ok", "日本語 テキスト 👩‍👩‍👧", "x" * 20000, "\r\n\r\n a \r b", "ß ẞ ǅ  z"]


@pytest.mark.parametrize("text", TEXTS)
def test_encoder(text):
    assert ids(Encoder.of(PATH).encode([text])[0]) == plain(text)


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=40))
def test_encoder_any_text(text):
    assert ids(Encoder.of(PATH).encode([text])[0]) == plain(text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="abZÉñßİ\u0301.,!'`_<|>19 \n", max_size=30))
def test_encoder_letters_and_punctuation(text):
    assert ids(Encoder.of(PATH).encode([text])[0]) == plain(text)


def test_encoder_every_simple_character():
    for c in map(chr, range(1, 0x250)):
        for text in (c, f"a{c}", f"{c}.", f"{c}b"):
            assert ids(Encoder.of(PATH).encode([text])[0]) == plain(text), text


def test_cache_starts_anew(monkeypatch):
    import tierflow.llm.tokens as t
    monkeypatch.setattr(t, "CACHE_WORDS", 5)
    e = Encoder(PATH)
    for text in ("a b c", "d e f", "g h i j k l m n", "a b"):
        assert ids(e.encode([text])[0]) == plain(text)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 1000, 50_000])
def test_perfect_hash(n):
    keys = [f"k{i}" for i in range(n)]
    index = KeyIndex.from_bytes(KeyIndex.build(keys, {"v": np.arange(n)}).to_bytes())
    there, found = index.find(keys)
    assert there.all() and found["v"].tolist() == list(range(n))
    if n:
        assert sorted(index.hash.slots(np.array([], np.uint64)).tolist()) == []
        there, _ = index.find([f"other{i}" for i in range(1000)])
        assert not there.any()


def test_repeated_keys_are_refused():
    with pytest.raises(ValueError):
        KeyIndex.build(["a", "a"], {})
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([3, 3], np.uint64))


def test_query_matches_plain_encoding(spark):
    docs = sorted((d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = sorted(LLM_QUERIES["op9_tokens"](spark, SF).collect())
    start = 0
    assert len(got) == len(docs)
    for x, (key, text) in zip(got, docs):
        want = [*plain(text), 2]
        assert (x.doc_id, x.start, x.n_tokens) == (key, start, len(want))
        assert x.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)


@pytest.mark.parametrize("vocabulary", [49_408, 70_000])
def test_odd_rows(spark, vocabulary):
    prepare(spark)
    rows = [(3, "c c"), (None, "n"), (1, None), (2, ""), (None, "m"), *[(2, f"same {i % 3}") for i in range(40)], (9, "z " * 40000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"key": F.lit("k"), "id": F.lit(7), "part": F.lit(1)})
    made = write_tokens(df.repartition(5), PATH, 2, vocabulary=vocabulary)
    got = sorted(made.read(made.locate(made.keys())).collect(), key=lambda x: x.start)
    assert len(got) == len(rows) and len({x.key for x in got}) == len(rows)
    assert [x.id for x in got] == [None, None, 1] + [2] * 41 + [3, 9]
    assert sorted((str(x.id), x.ids) for x in got) == sorted((str(k), [*plain(t), 2]) for k, t in rows)
    at = 0
    for x in got:
        assert x.start == at
        at += x.n_tokens
    # the payload files hold the ids and nothing else
    store, path = open_folder(made.folder)
    raw = [i for s in made.shards for i in np.frombuffer(store.open_input_file(f"{path}/{s['file']}").read(), f"<u{made.width}").tolist()]
    assert raw == [i for x in got for i in x.ids]
    assert made.locate(spark.createDataFrame([(5, "nobody", 0)], "id bigint, key string, part int")).count() == 0


def test_empty_table(spark):
    prepare(spark)
    made = write_tokens(spark.createDataFrame([], "doc_id bigint, text string"), PATH, 2)
    assert made.shards == [] and made.read(made.locate(made.keys())).count() == 0


def test_halves_of_words_outlive_the_words(monkeypatch):
    from tierflow.llm import tokens
    monkeypatch.setattr(tokens, "CACHE_WORDS", 10)
    enc, asked = Encoder(PATH), []
    model = enc.model

    class Counted:
        def tokenize(self, piece):
            asked.append(piece)
            return model.tokenize(piece)
    enc.model = Counted()
    for t in ("aa bb AA BB Aa Bb", "aA bB cc Cc CC"):   # the second has more words than fit
        assert ids(enc.encode([t])[0]) == plain(t)
    assert len(enc.known) == 5 and sorted(asked) == ["aa", "bb", "cc"]
