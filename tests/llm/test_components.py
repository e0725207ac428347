import random

from pyspark.sql import Row

from helpers import Union
from riskflow.llm._components import components


def test_equal_to_union_find(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(5, 5), (7, 6), (6, 7)]
    u = Union({x for e in edges for x in e})
    for a, b in edges:
        u.join(a, b)
    want = {x: u.find(x) for x in u.p if any(x in e and e[0] != e[1] for e in edges)}
    df = spark.createDataFrame([Row(a=a, b=b) for a, b in edges + [(None, 3), (3, None)]], "a bigint, b bigint")
    assert {r["node"]: r["root"] for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0
