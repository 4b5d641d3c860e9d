"""The near-dedup stage's kept rows against brute force, with planted pairs just above and below 0.8."""

import random

import corpus_pipeline
import pytest
from test_corpus import AWKWARD, docs_of

from vertexloom.llm import near_dedup


def shingles(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def kept_ids(rows):
    sets, above = [shingles(t) for _, t in rows], list(range(len(rows)))
    root = lambda i: i if above[i] == i else root(above[i])
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 5 * len(a & b) >= 4 * len(a | b)]
    for i, j in links:
        a, b = root(i), root(j)
        above[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min([k for k in (least.get(root(i)), key) if k is not None], default=None)
    return sorted((str(k) for i, (k, _) in enumerate(rows) if k == least[root(i)])), links, sets


def planted():
    rnd = random.Random(7)
    word = lambda: f"w{rnd.randrange(3000)}"
    rows = [*AWKWARD, (50, "two words"), (51, "TWO  words"), (52, "two words more")]
    for changed in range(12):  # each changed word far from the others costs five shingles of 196
        for _ in range(3):
            base = [word() for _ in range(200)]
            other = list(base)
            for at in range(changed):
                other[10 + 15 * at] = word()
            rows += [(1000 - len(rows), " ".join(base)), (2000 + len(rows), " ".join(other))]
    for start in (400, 401):  # runs of words cut off: similarity 0.80 exactly, and just below
        base = [word() for _ in range(504)]
        rows += [(3000 + start, " ".join(base)), (3500 + start, " ".join(base[: 805 - start]))]
    group = [word() for _ in range(300)]
    line = " ".join(word() for _ in range(30))
    for i in range(60):  # a group of copies of copies, and texts that share only a long line
        group[rnd.randrange(300)] = word()
        rows += [(5000 + i, " ".join(group)), (6000 + i, f"{line} {' '.join(word() for _ in range(12 + i % 5))}")]
    passages = [[word() for _ in range(60)] for _ in range(3)]
    for i in range(90):  # texts that share most of their words: just above, at and below the similarity, and with a second passage
        own = [word() for _ in range(1 + i % 11)]
        second = passages[1 + i % 2][: 10 * (i % 4)]
        rows.append((7000 + i, " ".join([*own, *passages[0], *second])))
    rnd.shuffle(rows)
    return rows


def test_nodes_that_share_a_passage_are_not_all_paired(spark, monkeypatch):
    """Candidates of a passage grow with its texts, not with the square."""
    monkeypatch.setattr(near_dedup, "SAMPLED", 1)
    rnd = random.Random(3)
    passage = " ".join(f"p{rnd.randrange(9999)}" for _ in range(60))
    rows = [(i, f"{passage} {' '.join(f'w{rnd.randrange(99999)}' for _ in range(11))}") for i in range(300)]
    verified, own = [], near_dedup._verified
    monkeypatch.setattr(near_dedup, "_verified", lambda pairs, *more: verified.append(pairs.count()) or own(pairs, *more))
    assert near_dedup.drop_near(docs_of(spark, rows)).count() == 300 == len(kept_ids(rows)[0])
    assert sum(verified) < 4 * 300


def test_pairs_of_two_passages_grow_with_the_texts(spark, monkeypatch):
    """A passage beside one of three more frequent ones, so that texts share much but too little: at twice and four times as many texts, twice and four times as many pairs, and all links."""
    monkeypatch.setattr(near_dedup, "SAMPLED", 1)
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(99999)}"
    passage, others = [word() for _ in range(60)], [[word() for _ in range(25)] for _ in range(3)]
    met, verified = {}, {}
    for m in (100, 200, 400):
        rows = [(i, " ".join([*(word() for _ in range(3 + i % 9)), *passage, *others[i % 3]])) for i in range(m)]
        rows += [(m + i, " ".join([*(word() for _ in range(60)), *others[i % 3]])) for i in range(3 * m)]
        joined, counted, own_met, own = [], [], near_dedup._met, near_dedup._verified
        with monkeypatch.context() as patch:
            patch.setattr(near_dedup, "_met", lambda heads: joined.append(own_met(heads).count()) or own_met(heads))
            patch.setattr(near_dedup, "_verified", lambda pairs, *more: counted.append(near_dedup._promising(pairs, more[0]).count()) or own(pairs, *more))
            got = sorted(str(r.doc_id) for r in near_dedup.drop_near(docs_of(spark, rows)).collect())
        assert got == kept_ids(rows)[0]
        met[m], verified[m] = sum(joined), sum(counted)
    for found in (met, verified):
        assert found[200] <= 3 * found[100] + 100 and found[400] <= 3 * found[200] + 100, (met, verified)
    assert verified[400] < 8 * 400 and met[400] < 8 * 400


def test_signatures_never_exceed_the_difference():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (5, 300, 5000):
        a = np.unique(rng.integers(-(2**63), 2**63 - 1, n, np.int64))
        b = np.unique(np.concatenate((a[: n * 4 // 5], rng.integers(-(2**63), 2**63 - 1, n // 3, np.int64))))
        differ = len(np.setxor1d(a, b))
        for classes in (near_dedup.SIGNED, near_dedup.SIGNED_LARGE):
            x, y = (near_dedup.signature(s, classes) for s in (a, b))
            assert len(x) == classes // 64
            bits = int(np.unpackbits((x ^ y).view(np.uint8)).sum())
            assert bits <= differ and (bits - differ) % 2 == 0 and bits > 0.6 * min(differ, classes / 2)


@pytest.mark.parametrize("sampled,broadcast", [(16, True), (1, True), (1, False)])
def test_near_dedup_keeps_what_brute_force_keeps(spark, monkeypatch, sampled, broadcast):
    from vertexloom.llm import common

    monkeypatch.setattr(near_dedup, "SAMPLED", sampled)
    if not broadcast:
        monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(common, "HOT_KEYS", 5)
        monkeypatch.setattr(near_dedup, "TOGETHER", 4)
    rows = planted()
    expected, links, sets = kept_ids(rows)
    values = [len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i, j in links]
    assert sum(0.8 <= v < 0.9 for v in values) > 10 and 0.8 in values
    stage = dict(corpus_pipeline.STAGES)["near dedup"]
    assert sorted(str(r.doc_id) for r in stage(spark, docs_of(spark, rows), "").collect()) == expected
    assert stage(spark, docs_of(spark, []), "").count() == 0


def test_near_dedup_writes_no_texts_and_looks_for_pivots_in_parts(spark, monkeypatch):
    """No intermediate table has a copy of the texts; all links are found where nodes look for pivots in a part of their shingles."""
    from pyspark.sql.types import StringType

    monkeypatch.setattr(near_dedup, "LONG_PREFIX", 4)
    rows, kinds, own = planted(), {}, near_dedup.written
    monkeypatch.setattr(near_dedup, "written", lambda df, name, **more: kinds.update({name: [f.dataType for f in df.schema]}) or own(df, name, **more))
    assert sorted(str(r.doc_id) for r in near_dedup.drop_near(docs_of(spark, rows)).collect()) == kept_ids(rows)[0]
    assert "near-rows" in kinds and not [name for name, types in kinds.items() if StringType() in types]


@pytest.mark.parametrize("broadcast", [True, False])
def test_rows_without(spark, monkeypatch, broadcast):
    """Both columns decide, a null is equal to a null, repeated rows go or stay together."""
    from vertexloom.llm import common

    if not broadcast:
        monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    rows = [(1, 1), (1, 1), (1, None), (1, 2), (2, 1), (2, None), (2, None), (3, None)]
    docs = spark.createDataFrame(rows, "text long, id long")
    gone = common.written(spark.createDataFrame([(1, 1), (2, None), (3, 7)], "text long, id long"), "gone")
    kept = common.rows_without(docs, gone, "text", "id")
    assert kept.columns == ["text", "id"] and sorted(map(str, map(tuple, kept.collect()))) == ["(1, 2)", "(1, None)", "(2, 1)", "(3, None)"]
    assert {r.text for r in common.rows_among(docs, gone.select("text").filter("text < 3"), "text").collect()} >= {1, 2}
