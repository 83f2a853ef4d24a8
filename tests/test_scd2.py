import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from arenalake.operators.joins import current
from arenalake.operators.scd2 import scd2
from arenalake.sources.versions import newest, read_part
from arenalake.streaming import history
from arenalake.streaming.history import add_changes, maintain_history
from arenalake.workspace import new_dir


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


SCHEMA = "k int, name string, seq timestamp"


def versions(df):
    return sorted(
        ((r["k"], r["name"], r["__START_AT"], r["__END_AT"]) for r in df.collect()), key=lambda r: (r[0], r[2])
    )


BASE = [(1, "A", day(1)), (1, "A", day(2)), (1, "B", day(3)), (1, "A", day(4)), (None, "Z", day(1))]


def test_unchanged_rows_open_no_version(spark):
    got = versions(scd2(spark.createDataFrame(BASE, SCHEMA), "k", "seq", ["name"]))
    assert got == [(1, "A", day(1), day(3)), (1, "B", day(3), day(4)), (1, "A", day(4), None)]


def test_late_change_and_tie(spark):
    rows = BASE + [(1, "C", day(2))]
    got = versions(scd2(spark.createDataFrame(rows, SCHEMA), "k", "seq", ["name"]))
    assert got == [(1, "A", day(1), day(2)), (1, "C", day(2), day(3)), (1, "B", day(3), day(4)), (1, "A", day(4), None)]


def plain(rows):
    """Row-by-row history for comparison."""
    best = {}
    for k, name, seq in rows:
        if k is not None and ((k, seq) not in best or (name is not None and (best[k, seq] is None or name > best[k, seq]))):
            best[k, seq] = name
    out = []
    for k in sorted({k for k, _ in best}):
        kept = []
        for seq in sorted(s for kk, s in best if kk == k):
            if not kept or kept[-1][1] != best[k, seq]:
                kept.append((seq, best[k, seq]))
        for i, (seq, name) in enumerate(kept):
            out.append((k, name, seq, kept[i + 1][0] if i + 1 < len(kept) else None))
    return out


def feed(n=1500, seed=5):
    rng = random.Random(seed)
    # One key holds a third of the changes and spans many slices.
    return [
        (0 if i % 3 == 0 else rng.randrange(1, 40), rng.choice(["A", "B", "C", None]), day(rng.randrange(900)))
        for i in range(n)
    ]


@pytest.mark.parametrize("unit", ["day", "month", "year"])
def test_random_feed_with_hot_key(spark, unit):
    rows = feed()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert versions(scd2(df, "k", "seq", ["name"], unit)) == plain(rows)


def test_one_open_version_and_no_gaps(spark):
    rows = scd2(spark.createDataFrame(feed(seed=8), SCHEMA), "k", "seq", ["name"])
    assert current(rows).groupBy("k").count().filter("count != 1").count() == 0
    assert rows.filter("__END_AT <= __START_AT").count() == 0
    ends = rows.filter("__END_AT IS NOT NULL").select("k", F.col("__END_AT").alias("t"))
    assert ends.exceptAll(rows.select("k", F.col("__START_AT").alias("t"))).count() == 0


def test_stream_equals_batch_for_shuffled_deliveries(spark):
    rows = feed(600, seed=11)
    source, base = new_dir(spark, "feed"), new_dir(spark, "hist")
    parts = [rows[i::3] for i in range(3)]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        maintain_history(stream, "k", "seq", ["name"], f"{base}/log", f"{base}/out", f"{base}/cp")
        seen = [r for p in parts[: i + 1] for r in p]
        assert versions(history.versions(spark, f"{base}/out", "k")) == plain(seen)


def test_small_batch_rewrites_its_keys_only(spark, monkeypatch):
    """Late, repeated and replayed batches; parts are merged; a reader that began before a batch finishes as it began."""
    base = new_dir(spark, "merge")
    rng = random.Random(3)
    rows = [(k, rng.choice("ABC"), day(rng.randrange(300))) for k in range(1000) for _ in range(4)]
    load = lambda part, n: add_changes(spark, spark.createDataFrame(part, SCHEMA), n, "k", "seq", ["name"], f"{base}/log", f"{base}/out")
    read = lambda: history.versions(spark, f"{base}/out", "k")
    load(rows, 0)
    total = read().count()
    before = read()
    batch = [(k, "D", day(rng.randrange(300))) for k in range(500, 510)]
    load(batch, 1)
    manifest = newest(spark, f"{base}/out")
    written = read_part(spark, f"{base}/out", manifest.parts[-1])
    assert len(manifest.parts) == 2 and written.select("k").distinct().count() == 10 and written.count() <= 0.02 * total
    assert versions(before) == plain(rows)
    rows += batch
    assert versions(read()) == plain(rows)
    load(batch, 1)
    assert newest(spark, f"{base}/out") == manifest
    # A batch that fails after its log is written, and merged, is finished by its replay.
    load(rows[:1], 2)
    batch = [(7, "E", day(10)), (2000, "E", day(11))]
    with monkeypatch.context() as patch:
        patch.setattr(history, "scd2", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(batch, 3)
    assert len(newest(spark, f"{base}/log").parts) == 1 and versions(read()) == plain(rows)
    load(batch, 3)
    rows += batch
    assert versions(read()) == plain(rows)
    for n in range(4, 8):
        batch = [(rng.randrange(1000), rng.choice("ABCD"), day(rng.randrange(-50, 400))) for _ in range(5)] + rows[:1]
        load(batch, n)
        rows += batch
    assert versions(read()) == plain(rows)
    assert len(newest(spark, f"{base}/out").parts) <= 4 and len(newest(spark, f"{base}/log").parts) <= 4
