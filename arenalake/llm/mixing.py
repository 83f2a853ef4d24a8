"""Mixing sources to target weights by Pareto order sampling.

Every source gets a number of words by its weight. No source gives more than `most` times its own words; what one
cannot give is shared among the others by weight, again and again until none is above. A document is expected in
`rate` copies (its source's target over its source's words, or in proportion to a measure, `most` at the highest):
the whole copies are certain, and for the broken rest p the document gets the rank u / (1 - u) : p / (1 - p), where
u is a hash that depends on the row alone. Documents are taken in the order of their ranks until the words that are
left are used up. At most three documents of a source are then turned over (taken or left out), each the one whose
size comes nearest to what is short or over, so a source misses its target by a part of one document.

Ranks are laid out in ordered slices. Only the sums of the slices are added up, and only the slice in which a
source's words run out is looked at row by row, so a source may hold any share of all rows. Equal rows are
counted before anything is shuffled and then numbered in blocks.

Defined cases: a NULL text has no word; a NULL source is a source of its own, the last one; rows without words get
their copies but add nothing; equal rows (doc_id, text, source) are sampled each for itself; a missing, NULL or
negative measure counts as 0 (a source whose measured documents cannot fill its target stays below it); an empty table mixes into nothing; other columns are ignored by `mix` and carried by
`mixed` (equal rows there share the columns of one of them). Reruns agree, however rows are dealt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arenalake.llm.common import written

WEIGHTS = (3, 1, 2)  # of the sources in code-point order, repeating
SHARE = 1.5  # words of the mix per word of the corpus
MOST = 2  # copies of a document, and words per word of a source
BLOCK = 4096  # equal rows numbered together
ROUNDS = 3  # documents per source that may be turned over to meet its target
_ROW = ("doc_id", "digest", "source")


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def measured(docs: DataFrame, measure: str | None = None) -> DataFrame:
    """Distinct rows: doc_id, digest, source, size, measure and how often each occurs (c). Texts stay where they are."""
    value = F.lit(1.0) if measure is None else F.greatest(F.coalesce(F.col(measure).cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.md5(_text().cast("binary")).alias("digest"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(_text(), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        value.alias("measure"),
    )
    return rows.groupBy(*_ROW, "size", "measure").agg(F.count(F.lit(1)).alias("c"))


def numbered(rows: DataFrame, *order: Column | str) -> DataFrame:
    """`rows` with `place`, their number from 0 in `order`, without one task that sees all of them."""
    laid = written(rows.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()), "laid")
    # One row per slice, a number that the session's partition count bounds.
    before = laid.groupBy("slice").count().select(
        F.col("slice").alias("s"), (F.sum("count").over(Window.orderBy("slice")) - F.col("count")).alias("before")
    )
    place = F.row_number().over(Window.partitionBy("slice").orderBy(*order)) - 1 + F.col("before")
    return laid.join(before, F.col("slice") == F.col("s")).select(*rows.columns, place.alias("place"))


def _reshared(rows: DataFrame, by: str, budget: str) -> DataFrame:
    """`rows` (weight, most, and `budget`, the same in a group `by`) with `got`.

    Shares go by weight and stop at `most`; what is over is shared by those below, until none is above. Rounds
    hold only a row per group; each settles at least one row's stop, and few are needed.
    """
    groups = rows.groupBy(by).agg(
        F.first(budget).alias("whole"), F.lit(0.0).alias("lam"), F.lit(-1).cast("long").alias("n_full")
    )
    groups = written(groups, "rounds")
    full = (F.col("lam") > 0) & (F.col("weight") * F.col("lam") > F.col("most"))
    while True:
        known = groups.select(F.col(by).alias("g"), "whole", "lam", "n_full")
        state = rows.join(known, F.col(by).eqNullSafe(F.col("g")))
        sums = state.groupBy(by).agg(
            F.first("whole").alias("whole"), F.first("n_full").alias("before"),
            F.sum(F.when(full, F.col("most")).otherwise(0.0)).alias("stopped"),
            F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("weight"))).alias("sharing"),
            F.sum(F.when(full, 1).otherwise(0)).alias("n_full"),
        )
        # Where no more rows stop, the last round's share stands.
        lam = F.when(F.col("sharing") > 0, F.greatest(F.col("whole") - F.col("stopped"), F.lit(0.0)) / F.col("sharing")).otherwise(F.lit(float("inf")))
        groups = written(sums.select(by, "whole", lam.alias("lam"), "n_full", (F.col("n_full") != F.col("before")).alias("moved")), "rounds")
        if not groups.filter("moved").limit(1).count():
            break
    known = groups.select(F.col(by).alias("g"), "lam")
    got = F.when(F.col("weight") <= 0, 0.0).when(F.col("weight") * F.col("lam") > F.col("most"), F.col("most")).otherwise(F.col("weight") * F.col("lam"))
    return rows.join(known, F.col(by).eqNullSafe(F.col("g"))).withColumn("got", got).drop("g", "lam")


def targets(items: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) per source."""
    sizes = items.groupBy("source").agg(F.sum(F.col("size") * F.col("c")).alias("source_size"))
    placed = written(numbered(sizes, F.col("source").isNull(), F.col("source")), "sources")
    total = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = placed.select(
        "source", "source_size", weight.alias("weight"), (F.lit(float(most)) * F.col("source_size")).alias("most"),
        F.lit(total * float(share)).alias("budget"), F.lit(0).alias("all"),
    )
    got = _reshared(written(rows, "weighed"), "all", "budget")
    return got.select("source", "source_size", F.when(F.col("source_size") > 0, F.col("got")).otherwise(0.0).alias("target"))


def _chance(seed: int) -> Column:
    """A number between 0 and 1 from the row and its number among equal rows."""
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest", F.col("j").cast("string"), F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def _one_by_one(items: DataFrame, block: int) -> DataFrame:
    """Every row with its number j among equal ones; the blocks of frequent rows are dealt out first."""
    few = items.filter(F.col("c") <= block).withColumn("b", F.lit(0).cast("long"))
    many = items.filter(F.col("c") > block).withColumn("b", F.explode(F.expr(f"sequence(0L, (c - 1) div {block})")))
    many = many.repartition(F.xxhash64(*_ROW, "b"))
    return few.union(many).withColumn("j", F.explode(F.expr(f"sequence(b * {block}, least(c, (b + 1) * {block}) - 1)"))).drop("b", "c")


def mix(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST,
    measure: str | None = None, seed: int = 0, block: int = BLOCK,
) -> DataFrame:
    """One row per row of `docs`: doc_id, digest, source, size, source_size, target, rate, copies, taken."""
    items = written(measured(docs, measure), "sizes")
    goal = written(targets(items, weights, share, most), "targets")
    of = goal.select(F.col("source").alias("of"), "source_size", "target")
    items = items.join(of, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    if measure is None:
        rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        rated = items.withColumn("rate", rate)
    else:
        words = F.col("size") * F.col("c")
        shared = items.withColumn("weight", F.col("measure") * words).withColumn("most", F.lit(float(most)) * words)
        rate = F.when(words > 0, F.col("got") / words).otherwise(0.0)
        rated = _reshared(written(shared, "shared"), "source", "target").withColumn("rate", rate).drop("weight", "most", "got")
    rated = rated.drop("measure").withColumn("whole", F.floor("rate")).withColumn("p", F.col("rate") - F.col("whole"))

    singles = _one_by_one(rated, block)
    u = _chance(seed)
    ranked = singles.withColumn("u", u).withColumn(
        "rank", F.when(F.col("p") > 0, (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p"))))
    ).drop("u")
    # Rows without a broken rest have no rank and come first; they use up no words here.
    order = [F.col("source"), F.col("rank"), F.col("doc_id"), F.col("digest"), F.col("j")]
    rows = written(ranked.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()), "ranked")

    drawn = F.when(F.col("rank").isNotNull(), F.col("size")).otherwise(0)
    sums = rows.groupBy("source", "slice").agg(
        F.first("target").alias("target"), F.sum(F.col("whole") * F.col("size")).alias("certain"), F.sum(drawn).alias("words")
    )
    all_slices = Window.partitionBy("source")
    upto = F.sum("words").over(all_slices.orderBy("slice"))
    slices = sums.select(
        F.col("source").alias("of"), F.col("slice").alias("at"), (upto - F.col("words")).alias("start"), upto.alias("end"),
        (F.col("target") - F.sum("certain").over(all_slices)).alias("rest"),
    )
    slices = written(slices, "slices")
    placed = rows.join(slices, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("at"))).drop("of", "at")
    inside = (F.col("start") <= F.col("rest")) & (F.col("end") > F.col("rest")) & F.col("rank").isNotNull()
    running = F.sum("size").over(Window.partitionBy("source", "slice").orderBy("rank", "doc_id", "digest", "j"))
    plain = placed.filter(~inside).withColumn("chosen", F.col("rank").isNotNull() & (F.col("end") <= F.col("rest")))
    edge = placed.filter(inside).withColumn("chosen", F.col("start") + running <= F.col("rest"))
    kept = [*rows.columns[:-1], "rest", "chosen"]
    settled = written(plain.select(*kept).union(edge.select(*kept)), "settled")

    flips = _closest(settled)
    same = F.col("source").eqNullSafe(F.col("of_source")) & F.col("rank").eqNullSafe(F.col("of_rank")) & F.col("doc_id").eqNullSafe(
        F.col("of_doc_id")) & (F.col("digest") == F.col("of_digest")) & (F.col("j") == F.col("of_j"))
    keys = flips.select(*[F.col(c).alias(f"of_{c}") for c in _KEY], F.lit(True).alias("flip"))
    chosen = F.col("chosen") != F.coalesce(F.col("flip"), F.lit(False))
    copies = (F.col("whole") + F.when(chosen, 1).otherwise(0)).cast("long")
    return settled.join(keys, same, "left").select(
        *_ROW, "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


_KEY = ("source", "rank", "doc_id", "digest", "j")


def _closest(settled: DataFrame) -> DataFrame:
    """Rows whose choice is turned over, a few per source, so that its words come as near to the target as they can.

    Each round looks at what a source is short of (or has too much) and turns over the one document whose size comes
    nearest to it, if that helps.
    """
    ranked = settled.filter("rank IS NOT NULL")
    gaps = written(ranked.groupBy("source").agg(
        (F.first("rest") - F.sum(F.when(F.col("chosen"), F.col("size")).otherwise(0))).alias("gap")
    ), "gaps")
    flips = None
    for _ in range(ROUNDS):
        of = gaps.select(F.col("source").alias("of"), "gap")
        near = ranked.join(of, F.col("source").eqNullSafe(F.col("of"))).filter(
            (F.col("chosen") == (F.col("gap") < 0)) & (F.abs(F.col("size") - F.abs("gap")) < F.abs("gap"))
        )
        if flips is not None:
            old = flips.select(*[F.col(c).alias(f"of_{c}") for c in _KEY])
            met = [near[c].eqNullSafe(old[f"of_{c}"]) for c in _KEY]
            near = near.join(old, met[0] & met[1] & met[2] & met[3] & met[4], "left_anti")
        best = F.min(F.struct(F.abs(F.col("size") - F.abs("gap")).alias("off"), "rank", "doc_id", "digest", "j", "size", "gap"))
        picks = written(near.groupBy("source").agg(best.alias("p")).select("source", "p.*"), "picks")
        flips = picks.select(*_KEY) if flips is None else flips.union(picks.select(*_KEY))
        gaps = picks.select("source", F.when(F.col("gap") > 0, F.col("gap") - F.col("size")).otherwise(F.col("gap") + F.col("size")).alias("gap"))
    return flips


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of `docs`, each as often as it is taken, with `copy` (from 0) beside their columns."""
    plan = mix(docs, **options).groupBy(*_ROW).agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__c"))
    plan = written(plan.filter("__copies > 0"), "copies").select(*[F.col(c).alias(f"__{c}") for c in _ROW], "__copies", "__c")
    keyed = docs.withColumn("__t", F.md5(_text().cast("binary")))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc_id")) & (F.col("__t") == F.col("__digest")) & F.col("source").eqNullSafe(F.col("__source"))
    once = keyed.join(plan.filter("__c = 1"), on)
    # Equal rows: one of them stands for all; its copies are made in blocks.
    many = keyed.join(plan.filter("__c > 1"), on).dropDuplicates(["__doc_id", "__digest", "__source"])
    blocks = F.expr(f"sequence(0L, (__copies - 1) div {BLOCK})")
    rows = once.withColumn("__b", F.lit(0).cast("long")).union(many.withColumn("__b", F.explode(blocks)).repartition("__digest", "__b"))
    copy = F.explode(F.expr(f"sequence(__b * {BLOCK}, least(__copies, (__b + 1) * {BLOCK}) - 1)"))
    return rows.withColumn("copy", copy).select(*docs.columns, "copy")
