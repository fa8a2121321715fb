import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tierflow.llm.runtime import pieces
from tierflow.llm.words import Piece, sequences


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    p = Piece(texts)
    got = [(d, "".join(map(chr, p.cp[a:a + n].tolist()))) for d, a, n in zip(p.doc.tolist(), p.start.tolist(), p.length.tolist())]
    assert got == [(i, w) for i, t in enumerate(texts) for w in re.findall(r"\w+", t.lower())]


def test_hash_depends_on_the_word_alone():
    p = Piece(["Ab c", "x ab", "", "c\0ab"])
    h = p.hashes()
    assert h[0] == h[3] == h[5] and h[1] == h[4] and len(set(h.tolist())) == 3
    at, pre = Piece(["abcd abce ab"]).prefixes(3)
    assert at.tolist() == [0, 1] and pre[0] == pre[1]
    assert (sequences(h[:4], 2)[1:] == sequences(h[1:4], 2)).all() and len(sequences(h, 9)) == 0


def test_pieces_cover_all_texts():
    texts = ["a" * n for n in (3, 0, 9, 50, 1, 1)]
    got = list(pieces(texts, 10))
    assert [i for a, z in got for i in range(a, z)] == list(range(6)) and (3, 4) in got
    assert list(pieces([])) == [] and np.array([]).size == 0
