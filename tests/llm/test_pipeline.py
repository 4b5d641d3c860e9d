"""The pipeline's stages: each on its own input, and all of them against brute force."""

import random

import corpus_pipeline
from oracle import SF_DIR
from test_classifiers import toxic_tables
from test_corpus import AWKWARD, contained, dedup_rows, docs_of
from test_near_dedup import kept_ids

from vertexloom.llm import byte_bpe, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR).cache()
        assert after.columns == COLUMNS, name
        assert after.exceptAll(before).count() == 0, name
        assert 0 < after.count() <= before.count(), name
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR)
    assert last.count() == before.count() and last.filter("not round_trip").count() == 0
    assert len({r.doc_id for r in last.collect()}) == last.count()


def test_stages_take_awkward_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "lost id", None, "s", 1), (3, "one two three four five six", "en", "s", 2), (3, "one two three four five six", "en", "s", 2)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF_DIR).count() <= docs.count(), name


def test_pipeline_of_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def planted():
    """Documents with toxic ones, exact and near copies, copies whose white space differs, and benchmark items."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("ba de ki lo mu ne".split()) for _ in range(rnd.randrange(1, 4)))
    docs, labels = toxic_tables(None)
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([16, 25, 40])] + [(9, None)]
    for i in range(40):
        base = [word() for _ in range(120)]
        docs += [(1000 + i, " ".join(base)), (2000 + i, "  ".join(base) if i % 2 else " ".join(base)), (3000 + i, " ".join([*base[: 40 + i], word(), *base[41 + i :]]))]
        if i % 4 == 0:
            docs.append((4000 + i, " ".join([*base[::-1], items[i % 3][1], *[word() for _ in range(60)]])))
    return [*docs, *[(7000 + n, t) for n, (_, t) in enumerate(AWKWARD)]], labels, items


def test_pipeline_against_brute_force(spark, tmp_path):
    import tiktoken

    docs, labels, items = planted()
    docs_of(spark, docs).select(*COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    network = toxicity.learn(spark.read.parquet(str(tmp_path / "documents.parquet")), spark.read.parquet(str(tmp_path / "labels.parquet")))
    clean = [row for row, score in zip(docs, network.scores(t for _, t in docs), strict=True) if score < toxicity.THRESHOLD]
    assert 60 < len(docs) - len(clean) < 140
    kept = {keep for _, keep, _ in dedup_rows(clean)}
    once = [(i, t) for i, t in clean if i in kept]
    assert len(clean) - len(once) >= 40
    near = set(kept_ids(once)[0])
    apart = [(i, t) for i, t in once if str(i) in near]
    assert len(once) - len(apart) >= 30
    leaks = {i for i, _ in contained(apart, items)}
    assert len(leaks) >= 8
    path, pattern = byte_bpe.vocabulary_file()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.ByteBpe(open(path, "rb").read(), pattern).ranks, special_tokens={})
    expected = sorted((i, library.encode_ordinary(t or "")) for i, t in apart if i not in leaks)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.token_ids) for r in got) == expected
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in got)
