"""A minimal acyclic transducer: words in, id sequences out.

Words with common suffixes share states; ids are emitted as early as the read
prefix determines them, so that what remains of a path has no output of its own
and can be shared. The finished automaton is one flat array of 32-bit integers,
which a file holds as it is and workers map into memory, and words are looked up
many at a time, one step for all of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

_MAGIC = 0x54465831


def _common(a: tuple, b: tuple) -> tuple:
    n = 0
    while n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    return a[:n]


class _State:
    __slots__ = ("arcs", "out")

    def __init__(self):
        self.arcs: dict[int, list] = {}  # byte -> [target, output]
        self.out: tuple | None = None  # what a word that ends here still emits


class Builder:
    """Built from words in ascending order: a state is finished, and replaced by
    an equal one if there is one, as soon as no later word can reach it."""

    def __init__(self):
        self.path, self.word = [_State()], b""
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []

    def _finish(self, depth: int) -> None:
        while len(self.path) - 1 > depth:
            state = self.path.pop()
            self.path[-1].arcs[self.word[len(self.path) - 1]][0] = self._frozen(state)

    def _frozen(self, state: _State) -> int:
        key = (state.out, tuple((b, t, o) for b, (t, o) in state.arcs.items()))
        at = self.known.get(key)
        if at is None:
            at = self.known[key] = len(self.states)
            self.states.append(key)
        return at

    def add(self, word: bytes, ids: Sequence[int]) -> None:
        if self.word and word <= self.word:
            raise ValueError("words must come in ascending order, each once")
        if not word:
            raise ValueError("no empty words")
        keep = 0
        while keep < len(self.word) and self.word[keep] == word[keep]:
            keep += 1
        self._finish(keep)
        out = tuple(ids)
        for depth in range(keep):  # an arc that both words take emits what they have in common
            arc = self.path[depth].arcs[word[depth]]
            own = _common(arc[1], out)
            rest, arc[1], out = arc[1][len(own):], own, out[len(own):]
            if rest:
                below = self.path[depth + 1]
                for other in below.arcs.values():
                    other[1] = rest + other[1]
                if below.out is not None:
                    below.out = rest + below.out
        for depth in range(keep, len(word)):
            self.path[depth].arcs[word[depth]] = [-1, out]
            self.path.append(_State())
            out = ()
        self.path[-1].out = out
        self.word = word

    def done(self) -> np.ndarray:
        """The automaton as one array: sizes, then per state its final output
        (-1: no word ends here), per arc state, byte, target and output, then
        the outputs. The start is the last state."""
        self._finish(0)
        self._frozen(self.path[0])
        outs: dict[tuple, int] = {(): 0}
        final, src, label, target, emit = [], [], [], [], []
        for at, (out, arcs) in enumerate(self.states):
            final.append(-1 if out is None else outs.setdefault(out, len(outs)))
            for b, t, o in sorted(arcs):
                src.append(at), label.append(b), target.append(t), emit.append(outs.setdefault(o, len(outs)))
        ends = np.cumsum([0, *map(len, outs)])
        ids = [i for o in outs for i in o]
        head = [_MAGIC, len(final), len(src), len(outs), len(ids)]
        return np.concatenate([np.asarray(x, np.int64) for x in (head, final, src, label, target, emit, ends, ids)]).astype(np.int32)


def compile_words(words: Iterable[tuple[bytes, Sequence[int]]]) -> np.ndarray:
    """The automaton of distinct non-empty words in any order."""
    b = Builder()
    for word, ids in sorted(words):
        b.add(word, ids)
    return b.done()


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[i], starts[i] + 1 ... (lengths[i] of them), one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


class Transducer:
    """Lookup in an automaton (an array, or a file mapped into memory)."""

    def __init__(self, flat: np.ndarray):
        if len(flat) < 5 or flat[0] != _MAGIC:
            raise ValueError("not an automaton")
        _, states, arcs, outs, ids = (int(x) for x in flat[:5])
        cuts = np.cumsum([5, states, arcs, arcs, arcs, arcs, outs + 1, ids])
        self.final, src, label, self.target, self.emit, self.ends, self.ids = (flat[a:z] for a, z in zip(cuts, cuts[1:]))
        self.arcs = src.astype(np.int64) << 8 | label
        self.start = states - 1

    @classmethod
    def open(cls, path: str) -> "Transducer":
        return cls(np.memmap(path, np.int32, "r"))

    def find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are there, and their ids: how many of each word (0 for
        unknown ones), and all of them one after another in word order."""
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        text = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(size) - size
        there, last = np.zeros(n, bool), len(self.arcs) - 1
        live = np.flatnonzero(size > 0) if last >= 0 else np.zeros(0, np.int64)
        state = np.full(len(live), self.start, np.int64)
        who, what, step = [], [], 0  # a word's outputs, in the order of its steps
        while len(live):
            key = state << 8 | text[begin[live] + step]
            arc = np.minimum(np.searchsorted(self.arcs, key), last)
            ok = self.arcs[arc] == key
            live, arc = live[ok], arc[ok]
            state, step = self.target[arc].astype(np.int64), step + 1
            who.append(live), what.append(self.emit[arc])
            ends = size[live] == step
            if ends.any():
                out = self.final[state[ends]]
                done = live[ends][out >= 0]
                there[done] = True
                who.append(done), what.append(out[out >= 0])
                live, state = live[~ends], state[~ends]
        if not who:
            return there, np.zeros(n, np.int64), np.zeros(0, np.int64)
        who, what = np.concatenate(who), np.concatenate(what)
        use = there[who] & (what > 0)
        who, what = who[use], what[use]
        order = np.argsort(who, kind="stable")
        who, what = who[order], what[order]
        lengths = (self.ends[what + 1] - self.ends[what]).astype(np.int64)
        ids = self.ids[spread(self.ends[what].astype(np.int64), lengths)].astype(np.int64)
        return there, np.bincount(who, weights=lengths, minlength=n).astype(np.int64), ids
