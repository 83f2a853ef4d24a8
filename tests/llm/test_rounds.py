"""How many steps the classes take."""

import pytest

from arenalake.llm import graph, ngram_join
from arenalake.llm.ngram_join import Similarity, jaccard_classes


@pytest.fixture
def steps(monkeypatch):
    """Labels of what is written."""
    seen, before = [], graph.written

    def watched(df, label):
        seen.append(label)
        return before(df, label)

    monkeypatch.setattr(graph, "written", watched)
    monkeypatch.setattr(ngram_join, "written", watched)
    return seen


def _components(edges):
    return {r.id: r.component for r in graph.components(edges).collect()}


def test_stars_need_no_round(spark, steps):
    stars = spark.createDataFrame([(5, 1), (6, 1), (9, 8), (1, 5), (9, 9)], "a long, b long")
    assert _components(stars) == {5: 1, 6: 1, 1: 1, 9: 8, 8: 8}
    assert steps == ["edges"]


def test_chain_becomes_one_star(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert _components(chain) == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_merged_classes(spark, steps):
    classes = spark.createDataFrame([(1, 1), (5, 1), (8, 8), (9, 8), (20, 20), (21, 20)], "id long, component long")
    links = lambda *rows: spark.createDataFrame(list(rows), "a long, b long")
    got = lambda found: {r.id: r.component for r in found.collect()}
    assert got(graph.merged(classes, links())) == {1: 1, 5: 1, 8: 8, 9: 8, 20: 20, 21: 20}
    assert not steps
    # 3 is in no class yet, and takes 8's under itself; 1 stays apart.
    assert got(graph.merged(classes, links((8, 3), (20, 8)))) == {1: 1, 5: 1, 3: 3, 8: 3, 9: 3, 20: 3, 21: 3}


def test_few_pairs_are_one_block(spark, prose, steps):
    docs = []
    for i in range(12):
        words = prose(900 + i // 2, 400).split()
        words[200] = f"own{i}"
        docs.append((i, " ".join(words)))
    found = jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string"), Similarity(k=3))
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: i - i % 2 for i in range(12)}
    # At most one block a round of checks, where each round took four.
    assert 1 <= steps.count("similar") <= 6
