import random

import pytest

from tapewright.llm import components as module


def brute(edges):
    root = {x: x for e in edges for x in e if None not in e and e[0] != e[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a in root and b in root:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.fixture
def rounds(monkeypatch):
    """Tables that a call stages: the edges, and one a round."""
    labels, stage = [], module.stage
    monkeypatch.setattr(module, "stage", lambda frame, label: labels.append(label) or stage(frame, label))
    return labels


def graph():
    rng = random.Random(3)
    name = rng.sample(range(-10 ** 12, 10 ** 12), 700)
    path = [(name[k], name[k + 1]) for k in range(400)]
    stars = [(name[401 + k % 9], name[420 + k]) for k in range(200)]
    ring = [(name[630 + k], name[630 + (k + 1) % 50]) for k in range(50)]
    edges = path + stars + ring + rng.sample(stars, 40) + [(name[690], name[690]), (None, name[691]), (name[692], None)]
    rng.shuffle(edges)
    return edges


@pytest.mark.parametrize("task_edges, most", [(65_536, 2), (60, 9)])
def test_long_paths_take_few_rounds(spark, monkeypatch, rounds, task_edges, most):
    monkeypatch.setattr(module, "TASK_EDGES", task_edges)
    edges = graph()
    frame = spark.createDataFrame(edges, "a long, b long").repartition(8)
    found = [tuple(r) for r in module.components(frame, "a", "b").select("node", "root").collect()]
    assert len(found) == len(set(found)) and dict(found) == brute(edges)
    assert len(rounds) <= most


def test_a_large_task_is_contracted_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(module, "TASK_EDGES", 2)
    edges = graph()
    monkeypatch.setattr(module.math, "ceil", lambda x: 2)
    frame = spark.createDataFrame(edges, "a long, b long").repartition(3)
    assert dict(map(tuple, module.components(frame, "a", "b").select("node", "root").collect())) == brute(edges)


def test_no_edges(spark):
    assert module.components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long"), "a", "b").count() == 0
