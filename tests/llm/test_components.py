import random

from stayline.llm.components import components


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    rng.shuffle(edges)
    got = {r.id: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30))
    assert all(got[i] == 200 for i in (200, 201, 202)) and 300 not in got


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
