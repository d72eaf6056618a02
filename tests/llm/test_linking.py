import random

from pyspark.sql import functions as F

from marketpulse.llm.components import components
from marketpulse.llm.linking import linked_components


def roots(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_of_paths_stars_and_random_graphs(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)]
    edges += [(rnd.randrange(-500, -300), rnd.randrange(-500, -300)) for _ in range(150)]
    want = roots([e for e in edges if e[0] != e[1]])
    odd = [(1, 1), (None, 3), (5, None)] + edges[:5] + [(v, u) for u, v in edges[:9]]
    got = components(spark.createDataFrame(edges + odd, "u long, v long")).collect()
    assert len(got) == len(want) and {r.node: r.component for r in got} == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_no_step_of_components_nests_another(spark, monkeypatch):
    """Every plan that the driver makes is small, and as large in the last round as in the first."""
    from marketpulse.llm import components as module
    plans = []

    def noted(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, name)
    stored = module.stored
    monkeypatch.setattr(module, "stored", noted)
    components(spark.createDataFrame([(i, i + 1) for i in range(60)], "u long, v long")).collect()
    assert len(plans) > 6
    assert all(p.count("Relation [") <= 4 and p.count("Join ") <= 1 for p in plans[1:])


def test_no_link_across_components_is_lost(spark):
    """One bucket of points on a line; neighbours are linked, so most pairs aren't."""
    rnd = random.Random(4)
    points = {i: rnd.uniform(0, 120) for i in range(300)}
    details = spark.createDataFrame(list(points.items()), "node long, x double")
    members = details.select(F.lit(1).cast("long").alias("key"), "node").unionByName(details.where("node % 3 = 0").select((F.col("node") % 4).alias("key"), "node"))

    def near(a, b):
        return F.abs(F.col(f"{a}.x") - F.col(f"{b}.x"))

    def confirm(pairs):
        return pairs.where(near("a", "b") < 0.5).select(F.col("a.node").alias("u"), F.col("b.node").alias("v"))
    got = linked_components(members, details, lambda a, b: near(a, b) < 3, near, confirm).collect()
    want = roots([(i, j) for i in points for j in points if i < j and abs(points[i] - points[j]) < 0.5])
    assert {r.node: r.component for r in got} == want
