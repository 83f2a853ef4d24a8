"""Size-aware Jaccard self-join on word shingles, and the classes its links form.

Light sets (few shingles) enumerate fixed-size subsets: two sets of sizes a and b link exactly when
they share c(a, b) shingles, so they link exactly when one enumerated c-subset is equal. Such lists
need no check, and tying every member to the list's first is enough.

Heavy sets scan inverted lists. Elements are dealt by hash into n parts; two linked sets differ in at
most d shingles, so at least n - d parts are equal, and lists are keyed by (part, content of part).
That keeps lists short where single shingles of shared passages would be in thousands of sets. Parts
that are empty on both sides must not be the only equal ones: n leaves room for that, and the few
sets with too many empty parts list those too, so no link is lost.

The boundary is chosen by cost from the histogram of set sizes. Equal sets are one set from the
start. A heavy list is never turned into all its pairs: members are first checked against one leader
each, then against the leaders of their other lists, and afterwards only pairs of the same list that are
still in different classes are met; parity sketches, which never overstate how far two sets differ,
decide which of them are worth an exact intersection: a short one of fixed size first, then one as long
as the set needs.

Defined cases: NULL, empty and blank texts have no shingle, link with nothing and are their own
class; fewer words than a shingle count as one shingle; repeated rows are one set; rows that share a
doc_id are one document; a NULL doc_id stays outside the classes of other texts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from arenalake.llm.common import docs_of, new_dir, release, written
from arenalake.llm.graph import components, merged
from arenalake.llm.words import WordHashes, column, lower_words, mix, shingles, signed, small_batches, texts
from arenalake.sources.tables import save_bucketed
from arenalake.workspace import dropping_shuffles

_SETS = "doc_id long, n_shingles long, f1 long, f2 long"
_KEYS = "shard int, keys array<long>, ids array<long>"
# Kinds of keys: fixed-size subsets seen from the smaller size and from the larger one, inverted lists. The kind takes
# the place of a key's last two bits.
SMALLER, LARGER, PART = 0, 1, 2
_KIND = 3
# Subsets are enumerated for sets up to the size where one set would need more than this many.
_MOST_SUBSETS = 64
_SKETCH = 8  # longs of the parity sketch


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least num / den over k-word shingles."""

    k: int = 3
    num: int = 90
    den: int = 100

    def overlap(self, a: int, b: int) -> int:
        """Least number of common elements of linked sets with a and b elements."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def differ(self, a: int, b: int) -> int:
        """Most elements in which linked sets with a and b elements differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def partners(self, size: int) -> range:
        return range(-(-size * self.num // self.den), size * self.den // self.num + 1)

    def subsets(self, size: int) -> int:
        return sum(comb(size, self.overlap(size, other)) for other in self.partners(size))

    @cached_property
    def light_limit(self) -> int:
        size = 1
        while self.subsets(size + 1) <= _MOST_SUBSETS:
            size += 1
        return size

    @cached_property
    def _starts(self) -> list[int]:
        """First size of each size class; classes are about a fifth wide, up to 2^40."""
        starts = [1]
        while starts[-1] < 1 << 40:
            starts.append(max(starts[-1] + 1, starts[-1] * 6 // 5))
        return starts

    def classes(self, size: int) -> list[tuple[int, int, int]]:
        """(class, parts, differing parts) a set takes part in: its own class, and the next if it reaches it."""
        i = int(np.searchsorted(self._starts, size, "right")) - 1
        found = []
        while self._starts[i] <= size * self.den // self.num:
            last = self._starts[i + 1] - 1
            d = self.differ(last, last)
            found.append((i, d + 3 + d // 16, d))
            i += 1
        return found

    def lists(self, size: int) -> int:
        return sum(parts for _, parts, _ in self.classes(size))


class Picks(dict):
    """(n, c) -> every choice of c among n; light sets are small, so there are few of them."""

    def __missing__(self, of: tuple[int, int]) -> np.ndarray:
        n, c = of
        picks = self[of] = np.array(list(combinations(range(n), c)), dtype=np.int64).reshape(-1, c)
        return picks


def _light_keys(s: np.ndarray, others: list[int], sim: Similarity, picks: Picks | None = None) -> np.ndarray:
    """Keys (both sizes, subset) of the fixed-size subsets shared with linked sets of the sizes `others`."""
    picks = Picks() if picks is None else picks
    keys, n = [np.empty(0, np.uint64)], len(s)
    for other in others:
        sums = mix(s)[picks[n, sim.overlap(n, other)]].sum(axis=1, dtype=np.uint64)
        keys.append(mix(sums ^ np.uint64((min(n, other) << 32) | max(n, other))))
    return np.concatenate(keys)


def _heavy_keys(s: np.ndarray, sim: Similarity) -> tuple[np.ndarray, int]:
    """Keys (class, part, content), and the least number of equal keys two linked sets have in a class."""
    keys, least = [], 1 << 30
    scrambled = mix(s)
    for index, parts, d in sim.classes(len(s)):
        part = ((s >> np.uint64(33)) * np.uint64(parts) >> np.uint64(31)).astype(np.int64)
        # Elements are sorted, hence parts are: content sums are differences of a running sum.
        total = np.concatenate(([np.uint64(0)], np.cumsum(scrambled, dtype=np.uint64)))
        edge = np.searchsorted(part, np.arange(parts + 1))
        sums, filled = total[edge[1:]] - total[edge[:-1]], edge[1:] > edge[:-1]
        tags = np.arange(parts, dtype=np.uint64) | np.uint64(index << 40)
        key = mix(sums + mix(tags))
        none = int(parts - filled.sum())
        if none < parts - d:
            key = key[filled]
            least = min(least, parts - d - none)
        else:
            least = 1
        keys.append(key)
    return np.concatenate(keys), least


def _set_rows(k: int):
    """Size and 128-bit fingerprint of every set."""

    def rows(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(hashes.of(lower_words(text)), k) for text in texts(batch)]
            with np.errstate(over="ignore"):
                prints = [np.array([mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64)], np.uint64) for s in sets]
            prints = np.array(prints, np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array([len(s) for s in sets], pa.int64())]
                + [pa.array(signed(np.ascontiguousarray(prints[:, i]))) for i in (0, 1)],
                names=["doc_id", "n_shingles", "f1", "f2"],
            )

    return rows


def _key_rows(sim: Similarity, limit: int, shards: int):
    """Subset keys of light sets; list keys of all that are or may link with heavy ones.

    A row holds the keys of one batch and key range side by side, so a key and its document take 16 bytes.
    """

    def rows(batches):
        hashes, picks = WordHashes(), Picks()
        for batch in batches:
            ids, keys = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
            for doc_id, text in zip(column(batch, "doc_id").to_pylist(), texts(batch)):
                s = shingles(hashes.of(lower_words(text)), sim.k)
                n = len(s)
                if not n:
                    continue
                found = []
                if n <= limit:
                    others = sim.partners(n)
                    found.append((SMALLER, _light_keys(s, [x for x in others if n <= x <= limit], sim, picks)))
                    found.append((LARGER, _light_keys(s, [x for x in others if x < n], sim, picks)))
                if n * sim.den > limit * sim.num:
                    found.append((PART, _heavy_keys(s, sim)[0]))
                for kind, key in found:
                    keys.append((key & ~np.uint64(_KIND)) | np.uint64(kind))
                    ids.append(np.full(len(key), doc_id, np.int64))
            key, doc = np.concatenate(keys), np.concatenate(ids)
            shard = ((key >> np.uint64(33)) * np.uint64(shards) >> np.uint64(31)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            key, doc, shard = signed(key)[order], doc[order], shard[order]
            start = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))) if len(shard) else np.empty(0, np.int64)
            edge = pa.array(np.concatenate((start, [len(shard)])), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[start], pa.int32()), pa.ListArray.from_arrays(edge, pa.array(key)), pa.ListArray.from_arrays(edge, pa.array(doc))],
                names=["shard", "keys", "ids"],
            )

    return rows


def _odd_sketch(s: np.ndarray) -> np.ndarray:
    """512 parity bits of the elements. Two sketches differ in at most as many bits as the sets in elements."""
    bits = np.bincount((mix(s) >> np.uint64(55)).astype(np.int64), minlength=512).astype(np.uint8) & 1
    return np.packbits(bits).view(np.int64)


def _wide_sketch(s: np.ndarray) -> np.ndarray:
    """A parity sketch with at least a bit per element: 2^n bits, which fold to 2^(n-1) by XOR of the halves."""
    n = 1 << max(6, int(len(s) - 1).bit_length())
    bits = np.bincount((mix(s) & np.uint64(n - 1)).astype(np.int64), minlength=n).astype(np.uint8) & 1
    return np.packbits(bits).view(np.int64)


_ELEMENTS = "doc_id long, size long, least int, items array<long>, wide array<long>, " + ", ".join(f"s{i} long" for i in range(_SKETCH))


def _element_rows(sim: Similarity):
    def rows(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(hashes.of(lower_words(text)), sim.k) for text in texts(batch)]
            sketches = np.array([_odd_sketch(s) for s in sets]).reshape(-1, _SKETCH)
            least = [_heavy_keys(s, sim)[1] if len(s) else 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(least, pa.int32()),
                 pa.array([signed(s) for s in sets], pa.list_(pa.int64())),
                 pa.array([_wide_sketch(s) for s in sets], pa.list_(pa.int64()))]
                + [pa.array(sketches[:, i]) for i in range(_SKETCH)],
                names=["doc_id", "size", "least", "items", "wide", *[f"s{i}" for i in range(_SKETCH)]],
            )

    return rows


def boundary(reps: DataFrame, sim: Similarity) -> int:
    """Largest light size: the least total of subset rows below it and list rows with their checks above.

    The histogram has one row per size up to the light limit, a constant.
    """
    count = dict(
        reps.filter(F.col("n_shingles") <= sim.light_limit * sim.den // sim.num).groupBy("n_shingles").count().collect()
    )
    heavy = lambda size: sim.lists(size) * 2 + size / 4  # rows written and read, and the check of a hit

    def cost(limit: int) -> float:
        light = sum(n * sim.subsets(size) for size, n in count.items() if size <= limit)
        return light + sum(n * heavy(size) for size, n in count.items() if size * sim.den > limit * sim.num)

    return min(range(1, sim.light_limit + 1), key=lambda limit: (cost(limit), -limit))


_ROUNDS = 4  # most blocks of pairs checked one after the other
_BLOCK = 64 << 20  # bytes of sets worth a block of their own


def _folded(sketch: str, n) -> Column:
    """`sketch` at `n` longs, a power of two not above its own size."""
    column = F.col(sketch)
    fold = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.aggregate(
        F.sequence(i, F.size(column) - 1, n), F.lit(0).cast("long"), lambda x, j: x.bitwiseXOR(F.get(column, j))
    ))
    return F.when(F.size(column) == n, column).otherwise(fold)


def _apart(a: str, b: str) -> Column:
    """Bits in which two wide sketches differ, at the size of the shorter one."""
    n = F.least(F.size(a), F.size(b))
    bits = F.zip_with(_folded(a, n), _folded(b, n), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, x: total + x)


def _verified(pairs: DataFrame, items: DataFrame, sim: Similarity) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough, by exact intersection.

    The set of `a` travels to that of `b`, so first a 64th of it does: the wide sketch rules out pairs of large
    sets, to which the short one is blind. The others are dealt into blocks by hash; a block's sets leave the
    disk before the next one travels.
    """
    side = lambda end, *columns: items.select(F.col("doc_id").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])
    common = F.size(F.array_intersect("items_a", "items_b"))
    total = F.size("items_a") + F.size("items_b")
    sketched = pairs.select("a", "b").join(side("a", "size", "wide"), "a").join(side("b", "size", "wide"), "b")
    possible = _apart("wide_a", "wide_b") * (sim.den + sim.num) <= (F.col("size_a") + F.col("size_b")) * (sim.den - sim.num)
    travels = Observation()
    asked = sketched.filter(possible).observe(travels, F.sum(8 * F.col("size_a")).alias("bytes")).select("a", "b")
    asked, similar = written(asked, "asked"), []
    rounds = min(_ROUNDS, 1 + (travels.get["bytes"] or 0) // _BLOCK)
    for n in range(rounds):
        block = asked.filter(F.pmod(F.xxhash64("a", "b"), F.lit(rounds)) == n)
        both = block.join(side("a", "items"), "a").join(side("b", "items"), "b")
        similar.append(written(both.filter((sim.num + sim.den) * common >= sim.num * total).select("a", "b"), "similar"))
    return reduce(DataFrame.union, similar)


def _fits(sim: Similarity, a: str, b: str):
    return F.least(a, b) * sim.den >= F.greatest(a, b) * sim.num


def jaccard_classes(docs: DataFrame, sim: Similarity = Similarity()) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of `docs`.

    Texts are read three times (fingerprints, keys, and the elements of listed sets), which costs less
    than keeping the arrays.
    """
    spark, docs = docs.sparkSession, docs_of(docs)
    small_batches(spark)
    sets = written(docs.mapInArrow(_set_rows(sim.k), _SETS), "sets")
    full = sets.filter("n_shingles > 0")
    groups = full.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("c")).filter("rep IS NOT NULL")
    limit = boundary(full, sim)

    # Equal sets are one set: ids that only repeat another's take no part any more.
    again = groups.filter("c > 1").select(F.col("f1").alias("g1"), F.col("f2").alias("g2"), "rep")
    copies = (
        full.join(again, (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")))
        .filter("doc_id != rep").select("doc_id")
        .join(groups.select(F.col("rep").alias("doc_id")), "doc_id", "left_anti")
    )
    copies = written(copies.distinct(), "copies")
    own = docs.filter("doc_id IS NOT NULL").join(copies, "doc_id", "left_anti")

    # Lists with two or more members. Light lists are led by a set of the smaller size, which links with
    # every member: the one of the smallest id, so that the lists of a group share their leaders and give few
    # ties. The leader of a heavy list is drawn per list, so no set leads them all.
    # Keys travel by range and are laid out where they arrive; the ranked window needs no other exchange.
    shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = own.select("doc_id", "text").mapInArrow(_key_rows(sim, limit, shards), _KEYS).repartition("shard")
    keys = packed.select("shard", F.inline(F.arrays_zip("keys", "ids"))).select(
        "shard", F.shiftright("keys", 2).alias("key"), F.col("keys").bitwiseAND(_KIND).cast("int").alias("kind"), F.col("ids").alias("doc_id")
    )
    lot = F.when(F.col("kind") == PART, F.xxhash64("key", "doc_id"))
    drawn = Window.partitionBy("shard", "key").orderBy("kind", lot, "doc_id")
    led = (
        keys.withColumn("leader", F.first(F.struct("doc_id", "kind")).over(drawn))
        .withColumn("next", F.lead("doc_id").over(drawn))
        .filter((F.col("leader.doc_id") != F.col("doc_id")) | F.col("next").isNotNull())
        .select("shard", "key", "kind", "doc_id", F.col("leader.doc_id").alias("leader"), F.col("leader.kind").alias("leader_kind"))
    )
    # With the range among its columns, distinct needs no exchange either.
    lists = written(led.distinct().drop("shard"), "lists")
    release(spark)
    # Members of the larger size alone are not linked by a subset.
    ties = lists.filter((F.col("leader_kind") == SMALLER) & (F.col("doc_id") != F.col("leader"))).select(
        F.col("doc_id").alias("a"), F.col("leader").alias("b")
    ).distinct()
    heavy = lists.filter(F.col("kind") == PART).select("key", "doc_id", "leader")

    # Texts of listed documents are dealt to buckets once; their elements are written where they arrive, and the checks
    # below join them where they lie.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = heavy.select(F.col("doc_id").alias("known")).distinct()
    listed = docs.repartition(buckets, "doc_id").join(known, F.col("doc_id") == F.col("known"), "left_semi")
    if full.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        listed = listed.dropDuplicates(["doc_id"])
    name = f"items_{uuid.uuid4().hex}"
    elements = listed.mapInArrow(_element_rows(sim), _ELEMENTS)
    with dropping_shuffles(spark):
        items = save_bucketed(elements, name, ["doc_id"], buckets, path=new_dir(spark, "items"), dealt=True)
    release(spark)
    sketch = [f"s{i}" for i in range(_SKETCH)]
    facts = lambda suffix: items.select(*[F.col(c).alias(f"{c}{suffix}") for c in ("doc_id", "size", "least", *sketch)])
    apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_b"))) for c in sketch), F.lit(0))
    # Sizes and sketches allow a link.
    near = _fits(sim, "size", "size_b") & (
        apart * (sim.den + sim.num) <= (F.col("size") + F.col("size_b")) * (sim.den - sim.num)
    )
    stars = written(
        heavy.filter("doc_id != leader").select("doc_id", F.col("leader").alias("doc_id_b")).distinct()
        .join(facts(""), "doc_id").join(facts("_b"), "doc_id_b").filter(near)
        .select(F.col("doc_id").alias("a"), F.col("doc_id_b").alias("b"), apart.alias("apart")),
        "stars",
    )
    release(spark)
    # First star round: each member and its nearest leader.
    nearest = stars.groupBy("a").agg(F.min_by("b", F.struct("apart", "b")).alias("b"))
    classes = written(components(_verified(nearest, items, sim).union(ties)), "classes")
    release(spark)

    def class_of(df: DataFrame, end: str, name: str) -> DataFrame:
        known = classes.select(F.col("id").alias("cid"), F.col("component").alias("cc"))
        return df.join(known, F.col(end) == F.col("cid"), "left").withColumn(name, F.coalesce("cc", end)).drop("cid", "cc")

    def joined_by(pairs: DataFrame) -> DataFrame:
        """The classes, joined up by the similar ones among `pairs` of members of different classes."""
        similar = written(_verified(pairs, items, sim), "similar")
        ends = class_of(class_of(similar, "a", "class_a"), "b", "class_b")
        return merged(classes, ends.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")))

    # Second star round: leaders whose class a member is not in yet.
    rest = class_of(class_of(stars, "a", "class_a"), "b", "class_b").filter("class_a != class_b")
    classes = joined_by(rest)
    release(spark)

    # What is left: pairs of a list in different classes, met and judged inside the join.
    placed = class_of(heavy, "doc_id", "class").drop("leader")
    mixed = placed.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo < hi")
    open_lists = written(placed.join(mixed.select("key"), "key", "left_semi").join(facts(""), "doc_id"), "open")
    release(spark)
    other = open_lists.select("key", *[F.col(c).alias(f"{c}_b") for c in ("doc_id", "size", "least", "class", *sketch)])
    mine = open_lists.withColumnRenamed("key", "own_key")
    second = (
        mine.join(other, (F.col("own_key") == F.col("key")) & (F.col("class") < F.col("class_b")) & near)
        .groupBy(F.col("doc_id").alias("a"), F.col("doc_id_b").alias("b"))
        .agg(F.count(F.lit(1)).alias("equal"), F.max("least").alias("la"), F.max("least_b").alias("lb"))
        # Linked sets share at least so many listed parts in a class.
        .filter(F.col("equal") >= F.greatest("la", "lb"))
    )
    classes = joined_by(second)
    spark.sql(f"DROP TABLE {name}")

    # Written, so that the join by fingerprint has two plain sides and a group of copies can be split.
    found = written(
        groups.join(classes, groups["rep"] == classes["id"], "left").select(
            F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.coalesce("component", "rep").alias("class")
        ),
        "found",
    )
    met = (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")) & (F.col("n_shingles") > 0)
    return sets.join(found, met, "left").select(
        "doc_id", "n_shingles", F.coalesce("class", "doc_id").alias("component_id")
    )
