"""Benchmark decontamination by spaced seeds, with Spark functions only.

A seed hashes the words a fixed mask selects from a span and ignores the others, so a substituted word
under a hole costs no hit. Seeds of benchmark items meet seeds of documents; a hit fixes how item and
document are aligned, and along that diagonal the best stretch (matches minus twice the substitutions)
is measured in the document itself. An item leaks if the stretch matches enough words.

The masks follow from that measure, so no stretch it accepts is without a hit. A stretch ends where its
value is not above zero, so one with substitutions begins with three matches or more: three are followed
by a substitution and two matches (a second substitution, or one after one match, would end it), four by a
substitution and a match, and five are a seed themselves. Items of five words need four, with no substitution.

Only the benchmark side is broadcast, and only when its counted seeds stay under SEEDS; a larger one is
joined by shuffle, which AQE splits where a seed is frequent.

Defined cases: words are runs of letters and digits, lower-cased, and single characters in scripts written
without blanks; NULL or empty texts and items with fewer than SHORT words never match; rows alike in doc_id
and text are one document, other rows that share a doc_id (or have none) are judged each for itself; rows that
share an item_id (NULL is one) are one item with several texts; an empty benchmark gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenalake.llm.common import bind, docs_of, row_anti, row_keys, written

# One of them lies in every stretch of five matched words or more that begins as described above.
MASKS = ("11111", "111101", "111011")
SHORT = 5
SHORTEST = "1111"  # for items of SHORT words
MATCHED = 13  # matched words that make a leak, or three quarters of a shorter item
SEEDS = 500_000  # most benchmark seeds that are broadcast (under 16 MB)
_BLANKLESS = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def _words(text: str) -> Column:
    low = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    low = F.when(low.rlike(_BLANKLESS), F.regexp_replace(low, f"({_BLANKLESS})", " $1 ")).otherwise(low)
    cut = F.split(low, r"[^\p{L}\p{N}]+")
    return F.filter(cut, lambda w: w != "")


def _seeds(words: Column, masks: tuple[str, ...]) -> Column:
    """Array of (seed, at) for every place of every mask."""
    plans = [(int(mask, 2), len(mask), [i for i, c in enumerate(mask) if c == "1"]) for mask in masks]

    def one(w: Column, tag: int, span: int, picks: list[int]) -> Column:
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (span - 1), F.lit(0)))
        hashed = lambda x, i: F.struct(
            F.xxhash64(F.lit(tag), x, *[w[i + o] for o in picks[1:]]).alias("seed"), i.alias("at")
        )
        return F.transform(starts, hashed)

    return bind(words, lambda w: F.concat(*[one(w, *plan) for plan in plans]))


def _stretch(doc: Column, item: Column, shift: Column) -> Column:
    """(matched, first word, last word) of the best stretch along a diagonal."""
    start = F.struct(*[F.lit(0).alias(n) for n in ("score", "hits", "from", "best", "matched", "first", "last")])

    def step(s: Column, j: Column) -> Column:
        hit = F.coalesce(F.get(doc, F.when(shift + j >= 0, shift + j)) == item[j], F.lit(False))
        fresh = s["score"] <= 0
        base = F.when(fresh, 0).otherwise(s["score"])
        score = base + F.when(hit, 1).otherwise(-2)
        hits = F.when(fresh, 0).otherwise(s["hits"]) + hit.cast("int")
        begin = F.when(fresh, j).otherwise(s["from"])
        better = score > s["best"]
        keep = lambda new, old: F.when(better, new).otherwise(s[old])
        return F.struct(
            score.cast("int").alias("score"), hits.cast("int").alias("hits"), begin.cast("int").alias("from"),
            keep(score, "best").cast("int").alias("best"), keep(hits, "matched").cast("int").alias("matched"),
            keep(begin, "first").cast("int").alias("first"), keep(j, "last").cast("int").alias("last"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.size(item) - 1), start, step)


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What `leaks` returns, with the row keys."""
    words = _words("text")
    items = (
        benchmark.select("item_id", words.alias("item"))
        .filter(F.size("item") >= SHORT)
        .dropDuplicates(["item_id", "item"])
        .select("item_id", "item", F.size("item").alias("n_item"), F.xxhash64(F.col("item_id").isNull(), "item_id", "item").alias("unit"))
    )
    least = F.col("n_item") == SHORT
    own = F.when(least, _seeds(F.col("item"), (SHORTEST,))).otherwise(_seeds(F.col("item"), MASKS))
    # Four words are looked up only if an item needs them.
    masks = (*MASKS, SHORTEST) if items.filter(least).limit(1).count() else MASKS
    seeds = written(items.select("unit", F.inline(own)).withColumnRenamed("at", "item_at"), "seeds")
    keys = seeds.select(F.col("seed").alias("wanted")).distinct()
    small = seeds.count() <= SEEDS
    keyed = docs_of(docs).select("doc_id", "text", *row_keys())
    placed = keyed.select("k", "h", F.inline(_seeds(words, masks)))
    near = lambda df: F.broadcast(df) if small else df
    hits = (
        placed.join(near(keys), F.col("seed") == F.col("wanted"), "left_semi")
        .join(near(seeds.withColumnRenamed("seed", "own")), F.col("seed") == F.col("own"))
        .groupBy("k", "h", "unit", (F.col("at") - F.col("item_at")).alias("shift")).count()
        .select(F.col("k").alias("hk"), F.col("h").alias("hh"), "unit", "shift")
    )
    hits = written(hits, "hits")
    found = hits.join(near(items), "unit")
    texts = keyed.join(found, (F.col("k") == F.col("hk")) & (F.col("h") == F.col("hh"))).select(
        "doc_id", "k", "h", "item_id", "n_item", "shift", bind(words, lambda w: _stretch(w, F.col("item"), F.col("shift"))).alias("s")
    )
    enough = F.col("s.matched") >= F.least(F.lit(MATCHED), F.ceil(F.col("n_item") * 0.75))
    place = lambda end: (F.col("shift") + F.col(f"s.{end}")).alias(f"{end}_word")
    best = F.max(F.struct("s.matched", place("first"), place("last"), "n_item"))
    return (
        texts.filter(enough).groupBy("doc_id", "k", "h", "item_id").agg(best.alias("b"))
        .select("k", "h", "doc_id", "item_id", "b.matched", "b.n_item", "b.first_word", "b.last_word")
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, n_item, first_word, last_word) per leaked item and document.

    Words are counted in the document from 0. Clean documents have no row.
    """
    return _found(docs, benchmark).drop("k", "h")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the rows an item leaked into."""
    return row_anti(docs, _found(docs, benchmark))
