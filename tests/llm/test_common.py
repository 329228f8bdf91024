import random

from parcela.llm.common import components


def test_components(spark):
    random.seed(2)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 500)] + [(600, 600 + i) for i in range(1, 80)] + [(7, 7), (None, 3)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            ra, rb = root(a), root(b)
            up[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in up}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
