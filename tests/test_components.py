import random

import pytest

from stowage.operators.components import components
from stowage.sources.files import Scratch


@pytest.mark.parametrize("shape", ["random", "chain", "star"])
def test_components(spark, shape):
    rng = random.Random(6)
    if shape == "random":
        links = [(rng.randrange(120), rng.randrange(120)) for _ in range(80)]
    elif shape == "chain":
        nodes = rng.sample(range(1000), 60)
        links = list(zip(nodes, nodes[1:]))
    else:
        links = [(50, i) for i in range(90)] + [(200, 201)]
    names = {n: n for link in links for n in link}
    for _ in names:
        for a, b in links:
            names[a] = names[b] = min(names[a], names[b])
    scratch = Scratch(spark)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), scratch).collect()}
    scratch.remove()
    assert got == names
