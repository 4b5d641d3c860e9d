"""Source divergence and its transducers against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from vertexloom.llm import common, divergence
from vertexloom.llm.transducer import Transducer, _states

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, item string, rank int"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected(rows, min_docs, foremost):
    """(lang, source, part, item, value, rank) by loops."""
    docs = [(lang or "", source or "", TERM.findall(lowered(text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        frequency = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = sorted((t for t, n in frequency.items() if n >= min_docs), key=str.encode)
        counts = {s: Counter(t for d in docs if d[:2] == (lang, s) for t in d[2] if t in set(kept)) for s in {d[1] for d in docs if d[0] == lang}}

        def shares(n, kept=kept):
            return {t: 1 + 10**9 * (n[t] + 5) // (sum(n.values()) + 5 * len(kept)) for t in kept}

        p, q = {s: shares(n) for s, n in counts.items()}, shares(sum(counts.values(), Counter()))
        for s in counts:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in counts if o != s))
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[s][t] > 0 and p[s][t] > q[t])[:foremost]
            for part, ranked in (("pair", pairs), ("term", terms)):
                out.extend((lang, s, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(ranked))
    return sorted(out)


def made_rows(n):
    rng = random.Random(5)
    words = ["ab", "abc", "Abd", "b", "bc", "éa", "é", "日本", "zz", "z", "zebra", "ebra"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 12))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "S2", "é", None, "hot", "hot", "hot"])) for _ in range(n)]
    return [*rows, *rows[:5], (None, "en", "empty"), ("", None, None), ("1 2 3", "xx", "a"), ("4", "xx", "b"), ("one", "lone", "only"), ("q" * 70_000 + " ab " * 30_000, "en", "s1"), ("x@y.z_A[b`c{d", "en", "s2")]


@pytest.mark.parametrize("small", [False, True])
def test_against_loops(spark, monkeypatch, small):
    rows = made_rows(300)
    if small:  # many slices, lots, tiles, blocks and pieces, nothing broadcast
        for name, value in (("SENT_BYTES", 1), ("HELD", 4), ("PIECE", 16), ("TILE", 2), ("WIDTH", 3)):
            monkeypatch.setattr(divergence, name, value)
        monkeypatch.setattr(divergence.vocabulary, "__defaults__", (divergence.MIN_DOCS, 3))
        monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    docs = spark.createDataFrame([(i, t, lang, s, "old", 7) for i, (t, lang, s) in enumerate(rows)], SCHEMA)
    got = divergence.audit(docs, min_docs=4, foremost=3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == expected(rows, 4, 3)


def test_shares_of_large_counts(spark):
    pairs = [(5, 5), (1, 3), (9 * 10**14, 9 * 10**14 + 7), (123456789012345, 987654321098765)]
    want = [1 + 10**9 * a // b for a, b in pairs]
    assert divergence._share_of(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])).tolist() == want
    rows = spark.createDataFrame(pairs, "a long, b long")
    assert sorted(r[0] for r in rows.select(divergence._share(rows["a"], rows["b"])).collect()) == sorted(want)


def test_transducer():
    rng = random.Random(3)
    terms = sorted({bytes(rng.choices(b"abcxyz\xc3\xa9", k=rng.randint(1, 9))) for _ in range(3000)})
    others = [bytes(rng.choices(b"abcxyz\xc3\xa9q", k=rng.randint(1, 12))) for _ in range(2000)]
    words = [*terms, *others]
    text = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    lengths = np.array([len(w) for w in words])
    place = {t: i for i, t in enumerate(terms)}
    made = Transducer.from_bytes(Transducer.of(terms).to_bytes())
    assert made.ordinals(text, ends - lengths, lengths).tolist() == [place.get(w, -1) for w in words]
    states = _states(terms)
    assert len(set(states)) == len(states)  # no two states are alike: none could be left out
    assert len(_states([b"bed", b"led", b"red"])) == 4
