"""Merkle manifests against brute force."""

import hashlib
import random
import zlib

import pytest
from oracle import spark_rows, sql_rows

from vertexloom.llm import common, merkle, registry

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, at int, root string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return h(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def climbed(digests):
    """The root, and each leaf's siblings (before, after) level by level."""
    paths, own = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [range(k, min(k + 8, len(digests))) for k in range(0, len(digests), 8)]
        for run in runs:
            for j in run:
                for i in own[j]:
                    paths[i].append(("".join(digests[k] for k in run if k < j), "".join(digests[k] for k in run if k > j)))
        own = [[i for j in run for i in own[j]] for run in runs]
        digests = [h(*[digests[j] for j in run]) for run in runs]
    return digests[0], paths


def expected(rows):
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees, out = {}, []
    for lang in langs:
        own = sorted(((r[0] is None, r[0] or 0, leaf(r[0], r[3], r[2], r[4], r[1]), r) for r in rows if r[2] == lang), key=lambda t: t[:3])
        trees[lang] = own, *climbed([o[2] for o in own])
    root, upper = climbed([trees[lang][1] for lang in langs])
    for k, lang in enumerate(langs):
        own, subroot, paths = trees[lang]
        for (_, _, digest, r), path in zip(own, paths, strict=True):
            whole, value = path + upper[k], digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                low = None if r[1] is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1])
                value = leaf(r[0], r[3], r[2], r[4], low)
            for before, after in whole:
                value = h(before, value, after)
            out.append((r[0], digest, subroot, root, h(*[b + a for b, a in whole]), value, value == root))
    return sorted(map(str, out))


def made_rows(n):
    rng = random.Random(11)
    rows = [(i, rng.choice(["Text A", "low", "é È", "", None]), rng.choice(["en", "en", "en", "de", None, "", "é", "=x"]), rng.choice(["s", None]), rng.choice([5, None])) for i in rng.sample(range(10 * n), n)]
    return [*rows, *rows[:4], (None, "A", "en", None, None), (None, None, "en", "s", 1), (7, "same id", "de", "s", 1), (7, "other text", "de", "s", 1), (8, "W" * 60_000, "lone", "s", 1), *[(20_000 + i, "T", "eight", "s", 0) for i in range(8)]]


@pytest.mark.parametrize(("n", "height"), [(700, 4), (700, 1), (300, 2)])
def test_against_loops(spark, monkeypatch, tmp_path, n, height):
    if height < 4:  # several tiers, nothing broadcast
        monkeypatch.setattr(merkle, "HEIGHT", height)
        monkeypatch.setattr(merkle, "SPAN", 8**height)
        monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    rows = made_rows(n)
    spark.createDataFrame([(*r, 3, "old") for r in rows], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.queries()["op13_merkle_manifest"](spark, str(tmp_path))
    assert sorted(str(tuple(r)) for r in got.collect()) == expected(rows)


def test_sql(spark, tmp_path):
    import pandas as pd

    rows = [r for r in made_rows(120) if r[0] is not None]
    spark.createDataFrame([(*r, 3, "old") for r in rows], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    frame = pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": pd.array([r[1] for r in rows], "string"), "lang": pd.array([r[2] for r in rows], "string"), "source": pd.array([r[3] for r in rows], "string"), "n_chars": pd.array([r[4] for r in rows], "Int64")})
    assert spark_rows(registry.queries()["op13_merkle_manifest"](spark, str(tmp_path))) == sql_rows(registry.oracle_sql()["op13_merkle_manifest"], documents=frame)


def test_lone_document(spark, tmp_path):
    spark.createDataFrame([(1, "A", "en", "s", 1, 0, "r")], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    row = registry.queries()["op13_merkle_manifest"](spark, str(tmp_path)).first()
    assert row.leaf == row.subroot == row.root == leaf(1, "s", "en", 1, "A")
    assert row.proof_sha256 == h("")


def test_layout():
    for levels in range(1, 6):
        places = [merkle.address(levels, level).tolist() for level in range(levels)]
        assert sorted(p for level in places for p in level) == list(range(merkle.size(levels)))
    # Cut at half height: two levels on top, then each tree of two levels as one stretch.
    assert merkle.address(4, 0).tolist() == [0] and merkle.address(4, 1).tolist() == list(range(1, 9))
    assert merkle.address(4, 2)[1] == 9 + 9 and merkle.address(4, 3)[8:16].tolist() == list(range(9 + 9 + 1, 9 + 9 + 9))
