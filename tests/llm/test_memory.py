"""How much a Python task holds at once."""

import pyarrow as pa

from arenalake.llm import suffix_dedup
from arenalake.llm.words import small_batches


def test_batches_of_long_texts_are_bounded(spark):
    small_batches(spark)
    long = spark.range(0, 40, 1, 1).selectExpr("id", "repeat('x', 1000000) AS text")
    sizes = long.mapInArrow(lambda batches: (b.select(["id"]).slice(0, 1) for b in batches), "id long").count()
    assert sizes >= 7  # 40 MB: ten batches of 4 MB, give or take the row that fills one


def test_anchor_step_holds_little(monkeypatch, prose):
    """Hash arrays are some dozen bytes a byte of text, so the texts hashed together are few."""
    loaded, before = [], suffix_dedup.Prefixes.load

    def watched(self, data):
        loaded.append(len(data))
        before(self, data)

    monkeypatch.setattr(suffix_dedup.Prefixes, "load", watched)
    texts = [prose(i, 3000) for i in range(100)]
    batch = pa.RecordBatch.from_pydict({"doc_id": [*range(100)], "k": [*range(100)], "h": [0] * 100, "text": texts})
    rows = [row for out in suffix_dedup._first_rows([batch]) for row in out.to_pylist()]
    assert len(rows) == 100 and all(row["anchors"] for row in rows)
    assert max(loaded) < 1 << 19 < sum(loaded)
