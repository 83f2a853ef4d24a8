"""The counting of final builds: what it gives and that Spark compiles it."""

from itertools import combinations

import pytest

from arenalake.plans import gold
from arenalake.schemas import ITEM_SLOTS

_COLUMNS = "champion_name string, picks long, wins long, points int, lives int, " + ", ".join(f"{s} int" for s in ITEM_SLOTS)


@pytest.fixture
def states(spark):
    none = [None] * 6
    rows = [
        ("a", 2, 1, 7, 3, 5, 5, 9, 0, None, None, None), ("a", 1, 0, 4, 1, 9, *none), ("b", 3, 3, None, 2, None, *none),
        (None, 1, 1, 2, 2, 1, 2, 3, 4, 5, 6, 7), ("a", 1, 1, 1, 1, 2147483647, 0, *none[1:]),
    ]
    return spark.createDataFrame(rows, _COLUMNS)


def test_cells(states):
    want = {}
    for row in states.collect():
        items = [row[s] for s in ITEM_SLOTS if row[s] is not None]
        cells = [(None, None)] + [(x, None) for x in items] + [(min(p), max(p)) for p in combinations(items, 2) if p[0] != p[1]]
        for lo, hi in cells:
            key = (row.champion_name, lo, hi, row.lives if lo is not None and hi is None else None)
            picks, together = want.get(key, (0, 0))
            want[key] = (picks + row.picks, together + row.picks**2)
    got = {(r.champion_name, r.lo, r.hi, r.lives): (r.picks, r.together) for r in gold.champion_item_counts(states).collect()}
    assert got == want


def test_cells_are_compiled(spark, states):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = gold._cell_counts(states)._jdf.queryExecution().debug().codegenToSeq()
        sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) <= 8000
