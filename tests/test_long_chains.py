"""Chains of all of a customer's orders and longer ones: every step counts, and none is gathered in one group."""

from vertexloom.operators import transform


def test_long_chains_are_folded_in_blocks(spark):
    rows = [(1, i, "euler", [0.01 * (i % 7), 1.0, 0.5, 3.0, 4.0]) if i % 2 else (1, i, "translation", [0.25, -0.5]) for i in range(1000)] + [(2, i, "translation", [1.0, 2.0]) for i in range(25)]
    steps = spark.createDataFrame(rows, "chain_id long, step int, kind string, params array<double>").repartition(4)
    import math

    x, y = 2.0, 5.0
    for _, _, kind, p in rows[:1000]:
        if kind == "translation":
            x, y = x + p[0], y + p[1]
        else:
            dx, dy = x - p[3], y - p[4]
            x, y = math.cos(p[0]) * dx - math.sin(p[0]) * dy + p[3] + p[1], math.sin(p[0]) * dx + math.cos(p[0]) * dy + p[4] + p[2]
    points = spark.createDataFrame([(1, 2.0, 5.0), (2, 0.0, 0.0)], "chain_id long, x double, y double")
    got = {r.chain_id: (r.x, r.y) for r in transform.transform_points(points, steps).collect()}
    assert math.dist(got[1], (x, y)) < 1e-6 and got[2] == (25.0, 50.0)
    assert {r.chain_id: r.step for r in transform.final_transform(steps).collect()} == {1: 999, 2: 24}
    plan = transform.compose_chain(steps)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") >= 2 and "block" in plan
