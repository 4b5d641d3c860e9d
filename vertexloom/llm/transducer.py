"""Minimal acyclic transducers: sorted terms to their lexicographic ordinals.

States are shared by all terms with the same endings (Daciuk et al.,
"Incremental Construction of Minimal Acyclic Finite-State Automata"). An
edge's output is the number of terms that sort before all that go on through
it, so the outputs along a term's path sum up to its ordinal. Edges lie in
one array with displaced rows: that of a state's byte is at the state's base
plus the byte, and says whose it is. So a step of very many words at once is
a few look-ups in arrays.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

#: Places looked at together for a state's row of edges; from under so many free ones in 100 they are passed over.
WINDOW, SPARSE = 1024, 5


def _states(terms: Iterable[bytes]) -> list[tuple[bool, tuple[tuple[int, int], ...]]]:
    """States (is a term's end, edges by byte), each after those that its edges lead to; the last is the root. Terms are sorted and distinct."""
    known: dict[tuple[bool, tuple[tuple[int, int], ...]], int] = {}
    path: list[list] = [[False, []]]
    before = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            ends, edges = path.pop()
            path[-1][1].append((before[len(path) - 1], known.setdefault((ends, tuple(edges)), len(known))))

    for term in terms:
        common = next((i for i, (a, b) in enumerate(zip(before, term, strict=False)) if a != b), min(len(before), len(term)))
        close(common)
        path.extend([False, []] for _ in range(len(term) - common))
        path[-1][0] = True
        before = term
    close(0)
    ends, edges = path[0]
    return [*known, (ends, tuple(edges))]


class Transducer:
    """``base`` and ``ends`` of each state; ``owner``, ``target`` and ``output`` of each place of the edges' array."""

    ARRAYS = ("base", "ends", "owner", "target", "output")

    def __init__(self, arrays: dict[str, np.ndarray]):
        for name in self.ARRAYS:
            setattr(self, name, arrays[name])

    @classmethod
    def of(cls, terms: Iterable[bytes]) -> Transducer:
        states = _states(terms)
        sizes: list[int] = []
        outputs: list[list[int]] = []
        for ends, edges in states:
            size, out = int(ends), []
            for _, to in edges:
                out.append(size)
                size += sizes[to]
            sizes.append(size)
            outputs.append(out)
        base = _displaced(states)
        long = int(base.max()) + 256
        owner, target, output = np.full(long, -1, np.int32), np.zeros(long, np.int32), np.zeros(long, np.int32)
        for state, ((_, edges), out) in enumerate(zip(states, outputs, strict=True)):
            for (byte, to), before in zip(edges, out, strict=True):
                at = base[state] + byte
                owner[at], target[at], output[at] = state, to, before
        return cls({"base": base, "ends": np.array([ends for ends, _ in states], bool), "owner": owner, "target": target, "output": output})

    def to_bytes(self) -> dict[str, bytes]:
        return {name: getattr(self, name).tobytes() for name in self.ARRAYS}

    @classmethod
    def from_bytes(cls, stored: dict[str, bytes]) -> Transducer:
        return cls({name: np.frombuffer(stored[name], bool if name == "ends" else np.int32) for name in cls.ARRAYS})

    def ordinals(self, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Ordinals of the words of ``text``, its bytes, all at once; -1 for those that aren't terms."""
        out = np.full(len(starts), -1, np.int64)
        live, at, left = np.arange(len(starts)), starts, lengths
        state, ordinal = np.full(len(starts), len(self.base) - 1, np.int32), np.zeros(len(starts), np.int64)
        while len(live):
            done = left == 0
            if done.any():
                found = done & self.ends[state]
                out[live[found]] = ordinal[found]
                live, at, left, state, ordinal = (x[~done] for x in (live, at, left, state, ordinal))
            place = self.base[state] + text[at]
            on = self.owner[place] == state
            if not on.all():
                live, at, left, ordinal, place = (x[on] for x in (live, at, left, ordinal, place))
            state, ordinal, at, left = self.target[place], ordinal + self.output[place], at + 1, left - 1
        return out


def _displaced(states: list[tuple[bool, tuple[tuple[int, int], ...]]]) -> np.ndarray:
    """Bases by which no two edges have one place: states of many edges first, each at the first free row, then those of one edge in what is left."""
    counts = np.array([len(edges) for _, edges in states])
    base = np.zeros(len(states), np.int32)
    free = np.ones(int(counts.sum()) * 2 + 4 * WINDOW, bool)
    low = 0
    for state in np.argsort(-counts, kind="stable")[: int((counts > 1).sum())]:
        row = np.array([byte for byte, _ in states[state][1]])
        at = low
        while True:
            if at + WINDOW + 256 > len(free):
                free = np.concatenate((free, np.ones(len(free), bool)))
            fits = np.logical_and.reduce([free[at + byte : at + byte + WINDOW] for byte in row])
            if fits.any():
                break
            if at == low and 100 * np.count_nonzero(free[at : at + WINDOW]) < SPARSE * WINDOW:
                low += WINDOW
            at += WINDOW
        base[state] = at + int(np.argmax(fits))
        free[base[state] + row] = False
    single = np.flatnonzero(counts == 1)
    bytes_of = np.array([states[s][1][0][0] for s in single], np.int32)
    places = np.flatnonzero(free[256:]) + 256
    if len(places) < len(single):
        places = np.concatenate((places, len(free) + np.arange(len(single) - len(places))))
    base[single] = places[: len(single)] - bytes_of
    return base
