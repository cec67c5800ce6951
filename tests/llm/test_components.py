import random

from folio.llm.components import components


def test_against_union(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(500, x) for x in range(501, 560)] + [(7000, 7000), (-5, 3)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for x in root}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(want) and {x.node: x.root for x in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
