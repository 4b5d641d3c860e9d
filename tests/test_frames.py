"""Frame operators: whole frames for a model."""

import os
import uuid

import pandas as pd
import pytest

from vertexloom.operators import frames


def planes_of(spark, keys):
    rows = [(i, c, z, t, 2, 1, [float(c), float(z)]) for i, t in keys for z in range(7) for c in (0,)]
    return spark.createDataFrame(rows[::-1], "image_id long, c int, z int, t int, width int, height int, data array<float>")


@pytest.fixture
def small_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.fixture
def load():
    """Nested, so that it is sent by value: workers don't import tests."""

    def load():
        mark = uuid.uuid4().hex

        def model(frame):
            assert frame["z"].tolist() == sorted(frame["z"])
            return pd.DataFrame({"image_id": frame["image_id"][:1], "t": frame["t"][:1], "n": [len(frame)], "mark": [f"{os.getpid()} {mark}"]})

        return model

    return load


def test_a_model_sees_whole_frames(spark, small_batches, load):
    keys = [(i if i else None, t) for i in range(6) for t in range(5)]
    rows = frames.run_on_frames(planes_of(spark, keys).coalesce(1), load, "image_id long, t int, n int, mark string").collect()
    assert sorted(((r.image_id, r.t) for r in rows), key=str) == sorted(keys, key=str)
    assert {r.n for r in rows} == {7}
    marks = {r.mark for r in rows}
    assert len(marks) == len({m.split()[0] for m in marks})  # one model for each worker


def test_empty(spark, small_batches, load):
    assert frames.run_on_frames(planes_of(spark, [(1, 1)]).filter("t > 1"), load, "image_id long, t int, n int, mark string").count() == 0


def test_groups_across_batches():
    batches = [pd.DataFrame({"image_id": ids, "t": [0] * len(ids)}) for ids in ([1.0, 1.0], [1.0], [], [2.0, None], [None, None, 3.0])]
    assert [len(g) for g in frames.whole_groups(iter(batches), frames.FRAME)] == [3, 1, 3, 1]


def test_concat_keeps_the_type(spark):
    frame = spark.createDataFrame([(0, 4, 3), (0, 9, 2)], "image_id int, t int, v int")
    assert sorted(map(tuple, frames.concat_frames([frame], as_float=False).select("t", "v").collect())) == [(1, 3), (2, 2)]
    assert dict(frames.concat_frames([frame]).dtypes)["v"] == "float"


def test_deep_frames_of_unequal_slices(spark, tmp_path):
    from oracle import spark_rows, sql_rows

    from vertexloom.plans import frames as _  # noqa: F401  registers the query
    from vertexloom.plans import registry

    # Images of 32 rows, of six, of 23 with two missing, and one with values that are null.
    rows = [(i, None if i == 150 else [None if i > 159 else float(i % 7 + k % 5 - 9) for k in range(64)]) for i in [*range(32), *range(50, 56), *range(100, 113), *range(115, 123), *range(150, 170)]]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    name = "u01_run_on_deep_frames"
    got = spark_rows(registry.queries()[name](spark, str(tmp_path)))
    assert got == sql_rows(registry.oracle_sql()[name].replace("FROM embeddings", f"FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')"), str(tmp_path))
    assert len(got[1]) == 4
