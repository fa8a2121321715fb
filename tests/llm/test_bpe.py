import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import tierflow.llm.bpe as bpe
from tierflow.llm.bpe import ByteBPE, build_lexicon, decode_ids, encode_texts, word_pattern
from tierflow.llm.queries import LLM_QUERIES
from tierflow.llm.runtime import prepare
from tierflow.llm.transducer import Builder, Transducer, compile_words

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
ENCODER = ByteBPE(PATH, word_pattern())


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def found(t, words):
    there, count, ids = t.find(words)
    ends = np.cumsum(count)
    return [ids[e - c:e].tolist() if ok else None for ok, c, e in zip(there, count, ends)]


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 3), max_size=4), max_size=40), st.lists(st.binary(max_size=6), max_size=20))
def test_transducer_is_the_dictionary(words, other):
    t = Transducer(compile_words(words.items()))
    asked = [*words, *other]
    assert found(t, asked) == [words.get(w) for w in asked]


def test_suffixes_are_shared():
    stems, ends = [b"walk", b"talk", b"jump"], [b"", b"s", b"ed", b"ing"]
    words = {s + e: [i, j] for i, s in enumerate(stems) for j, e in enumerate(ends)}
    b = Builder()
    for w in sorted(words):
        b.add(w, words[w])
    t = Transducer(b.done())
    assert len(b.states) < 15 < sum(map(len, words))  # "alk" and all endings once
    assert found(t, [*words, b"wal", b"walkings", b""]) == [*words.values(), None, None, None]


def test_words_must_ascend():
    b = Builder()
    b.add(b"b", [1])
    for w in (b"b", b"a", b""):
        with pytest.raises(ValueError):
            b.add(w, [1])


def test_file_is_mapped(tmp_path):
    compile_words([(b"ab", [7])]).tofile(tmp_path / "x")
    t = Transducer.open(str(tmp_path / "x"))
    assert isinstance(t.ids.base, np.memmap) and found(t, [b"ab", b"a"]) == [[7], None]
    with pytest.raises(ValueError):
        Transducer(np.zeros(9, np.int32))


TEXTS = ["", " ", "a  b\n\n c\t\r\n", "don't WE'LL 'S 12½Ⅷ", "x\x1cy\x85z　q​", "<|endoftext|> x<|endoftext|>", "日本語 👩‍👩‍👧 é ́", "x" * 30000, " " * 3000]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text(texts):
    ids, edge = ENCODER.encode(texts)
    for i, t in enumerate(texts):
        got = ids[edge[i]:edge[i + 1]].tolist()
        assert got == plain(t) and ENCODER.decode([np.array(got, int)]) == [t]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abZÉñßİ́.,!'`_<|>19 \n\t\x1c\x85　½Ⅷ", max_size=30))
def test_words_and_spaces(text):
    assert ENCODER.encode([text])[0].tolist() == plain(text)


def test_texts():
    for t in TEXTS:
        assert ENCODER.encode([t])[0].tolist() == plain(t), t
    text = ByteBPE(PATH, word_pattern(), None, False)
    PLAIN.encode_special_tokens = True
    try:
        assert text.encode([TEXTS[5]])[0].tolist() == plain(TEXTS[5])
    finally:
        PLAIN.encode_special_tokens = False


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 50_400), max_size=9))
def test_decode_any_ids(ids):
    assert ENCODER.decode([np.array(ids, int), np.array(ids[:1], int)]) == [PLAIN.decode(x, skip_special_tokens=False) for x in (ids, ids[:1])]


def test_query_is_the_library(spark):
    docs = {d.doc_id: d.text or "" for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = LLM_QUERIES["op11_bpe"](spark, SF).collect()
    assert len(got) == len(docs)
    for x in got:
        ids = plain(docs[x.doc_id])
        assert (x.n_tokens, x.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert x.decoded_sha256 == hashlib.sha256(PLAIN.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("words", [0, 3, 65_536])
def test_lexicon_changes_no_id(spark, monkeypatch, words):
    prepare(spark)
    monkeypatch.setattr(bpe, "COUNTED_WORDS", 2)
    rows = [(1, "the cat sat on the mat"), (1, "the cat sat on the mat"), (None, "le chat"), (4, None), (5, ""), (6, "z " * 50_000), (7, TEXTS[5])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"ids": F.lit("x"), "id": F.lit(1), "word": F.lit(2)})
    lexicon = build_lexicon(df, PATH, words=words)
    size = int((bpe.Transducer.open(bpe.SparkFiles.get(lexicon)).final >= 0).sum())
    assert size == 0 if not words else size > 0
    got = decode_ids(encode_texts(df, PATH, lexicon), PATH).collect()
    key = lambda r: (str(r[0]), r[2])
    assert sorted(((x.id, np.frombuffer(x.ids, "<u4").tolist(), x.text) for x in got), key=key) == sorted(((i, plain(t), t or "") for i, t in rows), key=key)


def test_empty_table(spark):
    prepare(spark)
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert decode_ids(encode_texts(df, PATH, build_lexicon(df, PATH)), PATH).count() == 0
