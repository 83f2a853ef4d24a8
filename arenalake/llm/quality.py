"""Quality rules with thresholds learnt from mergeable quantile sketches per language and source.

A sketch is a table of counts over log-linear buckets (32 per power of two, so a quantile is off
by at most 1/32 of its value). Sketches merge by adding counts: leaf sketches (language, source)
are summed to language sketches and to one for everything, and a leaf with few rows takes the
next larger sketch. Counting is one map-side combined aggregate, so a hot source costs no more
than a small one; only counts are shuffled, never texts.

Defined cases: a NULL or empty text has no words and fails the base rule; NULL language or source
is a group of its own; repeated rows are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arenalake.llm.common import SPACE_RUN, SPACES, bind, row_keys, written

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """A metric in whole numbers and the least spread its fence allows for."""

    name: str
    metric: Column
    spread: int
    low: bool = False


def _rules() -> list[Rule]:
    per = lambda top, bottom, unit: F.expr(f"CAST({unit} * {top} AS BIGINT) DIV greatest({bottom}, 1)")
    return [
        Rule("symbols", per("n_symbols", "word_chars", 1000), 15),
        Rule("capitals", per("n_capitals", "word_chars", 1000), 60),
        Rule("marks", per("n_marks", "n_words", 1000), 60),
        Rule("dup_lines", per("n_dup_lines", "n_lines", 1000), 60),
        Rule("repeats", per("n_repeat_words", "n_words", 1000), 60),
        Rule("word_length", per("word_chars", "n_words", 100), 100, low=True),
    ]


MIN_ROWS = 100  # a sketch with fewer rows hands over to the next larger one
FENCE = 4  # spreads between the median and the fence


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in `words`.

    Windows are sorted by a 64-bit hash with their position; equal neighbours are repeats. The
    places are then sorted and overlapping windows counted once.
    """
    windows = lambda w: F.transform(
        F.slice(w, F.lit(3), F.size(w) - 2),
        lambda x, i: F.struct(F.xxhash64(w[i], w[i + 1], x).alias("h"), i.alias("i")),
    )
    neighbours = lambda s: F.array_compact(
        F.zip_with(
            F.slice(s, F.lit(1), F.size(s) - 1),
            F.slice(s, F.lit(2), F.size(s) - 1),
            lambda a, b: F.when(a["h"] == b["h"], F.struct(a["i"].alias("a"), b["i"].alias("b"))),
        )
    )
    repeated = lambda s: bind(neighbours(s), lambda p: F.array_union(p["a"], p["b"]))
    covered = lambda d: F.aggregate(
        F.transform(d, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(d, k + 1) - p, F.lit(3)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    count = bind(F.sort_array(windows(words)), lambda s: bind(F.sort_array(repeated(s)), covered))
    return F.when(F.size(words) >= 3, count).otherwise(F.lit(0)).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, row keys k and h, lang, source and the counts the rules are made of."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.btrim(F.col("t"), F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))
    lines = F.filter(F.split(F.col("t"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # One pass over the text keeps the few characters that are counted.
    signs = F.regexp_replace("t", "[^#*$%&|<>A-Z!?]+", "")
    without = lambda x, chars: (F.length(x) - F.length(F.regexp_replace(x, chars, ""))).cast("long")
    sign_counts = bind(
        signs,
        lambda x: F.struct(
            without(x, "[#*$%&|<>]").alias("n_symbols"),
            without(x, "[A-Z]").alias("n_capitals"),
            without(x, "[!?]").alias("n_marks"),
        ),
    )
    counted = bind(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    line_counts = bind(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return (
        docs.select("doc_id", *row_keys(), "lang", "source", text.alias("t"))
        .select(
            "doc_id", "k", "h", "lang", "source",
            counted.alias("w"),
            line_counts.alias("l"),
            sign_counts.alias("s"),
        )
        .select("doc_id", "k", "h", "lang", "source", "w.*", "l.*", "s.*")
    )


def bucket(value: Column) -> Column:
    """Lower end of the log-linear bucket of a whole number >= 0."""
    shift = lambda v: F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift(value)), shift(value))


def sketches(measured: DataFrame) -> DataFrame:
    """Leaf sketches: rows of (lang, source, rule, bucket, c). Summing c over any keys merges them."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(r.name).alias("rule"), bucket(r.metric).alias("bucket")) for r in _rules()])
    )
    return (
        measured.select("lang", "source", cells.alias("x"))
        .groupBy("lang", "source", "x.rule", "x.bucket")
        .agg(F.count(F.lit(1)).alias("c"))
    )


def _quartiles(counts: DataFrame, keys: list[str]) -> DataFrame:
    """n, q25, q50, q75 per `keys` and rule from merged bucket counts."""
    by = [*keys, "rule"]
    merged = counts.groupBy(*by, "bucket").agg(F.sum("c").alias("c"))
    order = Window.partitionBy(*by).orderBy("bucket")
    upto = merged.withColumn("upto", F.sum("c").over(order)).withColumn("n", F.sum("c").over(Window.partitionBy(*by)))
    at = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("n") * q, F.col("bucket")))
    return upto.groupBy(*by).agg(
        F.max("n").alias("n"), at(25).alias("q25"), at(50).alias("q50"), at(75).alias("q75")
    )


def _levels(*names: str) -> Column:
    """The sketches a leaf belongs to: its own, its language's, everything."""
    none = F.lit(None).cast("string")
    keys = [(0, F.col("lang"), F.col("source")), (1, F.col("lang"), none), (2, none, none)]
    rows = [F.struct(*[x.alias(n) for n, x in zip(names, (F.lit(level), a, b))]) for level, a, b in keys]
    return F.explode(F.array(*rows)).alias("g")


def thresholds(leaves: DataFrame) -> DataFrame:
    """Fences per (lang, source): one column `hi_<rule>` each, `lo_<rule>` where the rule has a lower end.

    The fence lies FENCE spreads from the median; a spread is the distance to the quartile, at
    least the rule's own minimum, so a source whose rows are all alike rejects none of them.
    """
    spread_out = leaves.select("rule", "bucket", "c", _levels("level", "k1", "k2")).select("rule", "bucket", "c", "g.*")
    merged = _quartiles(spread_out, ["level", "k1", "k2"])
    least = F.create_map(*[x for r in _rules() for x in (F.lit(r.name), F.lit(r.spread))])[F.col("rule")]
    hi = F.col("q50") + FENCE * F.greatest(F.col("q75") - F.col("q50"), least)
    lo = F.col("q50") - FENCE * F.greatest(F.col("q50") - F.col("q25"), least)
    fenced = merged.select("level", "k1", "k2", "rule", "n", hi.alias("hi"), lo.alias("lo"))
    own = leaves.select("lang", "source").distinct()
    # Each leaf sees the three sketches above it and takes the first with enough rows.
    keyed = own.select("lang", "source", _levels("at", "j1", "j2")).select("lang", "source", "g.*")
    met = keyed.join(
        fenced,
        (F.col("at") == F.col("level")) & F.col("j1").eqNullSafe(F.col("k1")) & F.col("j2").eqNullSafe(F.col("k2")),
    )
    rank = F.struct(F.when(F.col("n") >= MIN_ROWS, F.col("level")).otherwise(3 - F.col("level") / 10))
    best = met.groupBy("lang", "source", "rule").agg(F.min_by(F.struct("hi", "lo"), rank).alias("f"))
    pick = lambda r, side: F.max(F.when(F.col("rule") == r.name, F.col(f"f.{side}"))).alias(f"{side}_{r.name}")
    cells = [pick(r, "hi") for r in _rules()] + [pick(r, "lo") for r in _rules() if r.low]
    return best.groupBy("lang", "source").agg(*cells)


def quality_rules(docs: DataFrame) -> DataFrame:
    """What `judged` returns, without its keys."""
    return judged(docs).drop("k", "h", "lang", "source")


def judged(docs: DataFrame) -> DataFrame:
    """One row per document: row keys (k, h, lang, source), counts, base_failed, kept, and the names of the adaptive rules it broke.

    The measured counts are written once; sketches and the filter join both read them. The join
    has no hint: Spark broadcasts the fences while they are small, and AQE splits the hot source
    of a shuffled join otherwise.
    """
    measured = written(measures(docs), "quality")
    fences = thresholds(sketches(measured)).withColumnsRenamed({"lang": "f_lang", "source": "f_source"})
    on = measured["lang"].eqNullSafe(fences["f_lang"]) & measured["source"].eqNullSafe(fences["f_source"])
    broken = []
    for r in _rules():
        out = r.metric > F.col(f"hi_{r.name}")
        if r.low:
            out = out | (r.metric < F.col(f"lo_{r.name}"))
        broken.append(F.when(out, F.lit(r.name)))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        measured.join(fences, on, "left")
        .withColumn("base_failed", base_failed)
        .withColumn("broken", F.array_compact(F.array(*broken)))
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
        .select("doc_id", "k", "h", "lang", "source", *BASE, "base_failed", "kept", F.array_join("broken", ",").alias("broken_rules"))
    )
