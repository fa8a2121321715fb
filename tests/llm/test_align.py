import bisect
import hashlib
from collections import Counter
from itertools import accumulate

import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import tierflow.llm.align as align
from tierflow.llm.align import Aligner, align_tokens, packed, unpacked
from tierflow.llm.bpe import word_pattern
from tierflow.llm.queries import LLM_QUERIES
from tierflow.llm.runtime import prepare

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LEFT, RIGHT = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
LEFT.encode_special_tokens = True
ALIGNER = Aligner(A, B, word_pattern())


def left_bytes(i):
    chars = LEFT.id_to_token(i)
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spelt = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    return bytes(spelt[c] for c in chars)


def right_bytes(i):
    p = RIGHT.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if RIGHT.is_byte(i) else p.replace("▁", " ").encode()


def plain(text):
    """(a ids, b ids, groups) by whole-text encoding and common ends; None: no tokens."""
    if not text:
        return None
    a, b = LEFT.encode(" " + text, add_special_tokens=False).ids, RIGHT.encode(text)
    of_a, of_b = [left_bytes(i) for i in a], [right_bytes(i) for i in b]
    if not b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
        return None
    end_a, end_b = list(accumulate(map(len, of_a))), list(accumulate(map(len, of_b)))
    cuts = sorted({*end_a} & {*end_b})
    groups = [([], []) for _ in cuts]
    for ids, ends, k in ((a, end_a, 0), (b, end_b, 1)):
        for i, e in zip(ids, ends):
            groups[bisect.bisect_left(cuts, e)][k].append(i)
    return a, b, groups


def expected(rows):
    """Result rows of whole documents, and the count of every pair."""
    held = [plain(t) for _, t in rows]
    links = [Counter((i, j) for x, y in p[2] for i in x for j in y) if p else Counter() for p in held]
    count = Counter(pair for c in links for pair in c)
    most = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for (key, _), p, c in zip(rows, held, links):
        if p is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in p[2])
        out.append((key, len(p[0]), len(p[1]), len(p[2]), sum(c.values()), sum(m for q, m in c.items() if count[q] == most[q[0]]),
                    sum(m * count[q] for q, m in c.items()), hashlib.sha256(text.encode()).hexdigest()))
    return out, count, most


def rows_of(df):
    return sorted(map(tuple, df.select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


def compare(texts):
    got = ALIGNER.align(texts)
    for k, t in enumerate(texts):
        p = plain(t)
        pairs = slice(got["edge"][k], got["edge"][k + 1])
        links = dict(zip(got["pair"][pairs].tolist(), got["links"][pairs].tolist()))
        if p is None:
            assert [got[c][k] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")] == [0, 0, 0, 0, ""] and not links
        else:
            assert links == Counter(i << 32 | j for x, y in p[2] for i in x for j in y)
            assert [got[c][k] for c in ("n_a", "n_b", "n_groups")] == [len(x) for x in p]


TEXTS = ["", "a", " ", "  a  b ", "a ", "<|endoftext|> <s> <0x41> <unk>", "x" * 3000, "日本語 テキスト" * 50, " \n \n", "a▁b", "\x00 \x85\x1c", "né́e ½²Ⅷ"]


@pytest.mark.parametrize("step", [1, 7, 1 << 22])
def test_texts(monkeypatch, step):
    monkeypatch.setattr(align, "STEP_LINKS", step)
    compare(TEXTS)
    compare([])


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(align, "REMEMBERED", 3)
    for texts in (["a b", "c d"], ["a b c d e"], ["e", "f"], TEXTS):
        compare(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_any_text(texts):
    compare(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abZÉñ.,'<0x_> \n▁日", max_size=30), max_size=3))
def test_spaces_and_marks(texts):
    compare(texts)


@given(st.lists(st.integers(0, (1 << 32) - 1), max_size=50))
def test_packed(values):
    assert unpacked(packed(align.np.array(values, align.np.int64))).tolist() == values


def test_query_is_brute_force(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = LLM_QUERIES["op13_align"](spark, SF)
    assert rows_of(got.withColumnRenamed("doc_id", "id")) == sorted(expected(docs)[0], key=str)


@pytest.mark.parametrize("docs_a_piece", [1, 3, 4096])
def test_odd_rows_in_any_pieces(spark, monkeypatch, docs_a_piece):
    prepare(spark)
    monkeypatch.setattr(align, "PIECE_DOCS", docs_a_piece)
    rows = [*enumerate(TEXTS), (None, "a b"), (None, None), (3, "a b"), *[(7, "same words here")] * 9, (8, "z " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"piece": F.lit("x"), "pair": F.lit(1), "id": F.lit(2)})
    counts, got = align_tokens(df.repartition(3), A, B)
    want, count, most = expected(rows)
    assert rows_of(got) == sorted(want, key=str)
    assert {(x.a_id, x.b_id): (x.n_docs, x.best) for x in counts.collect()} == {q: (n, n == most[q[0]]) for q, n in count.items()}


def test_nothing_to_align(spark):
    prepare(spark)
    for rows, n in (([], 0), ([(1, None), (2, "")], 2)):
        counts, got = align_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), A, B)
        assert counts.count() == 0 and [x[1:] for x in rows_of(got)] == [(0, 0, 0, 0, 0, 0, "")] * n
