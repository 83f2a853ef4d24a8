"""Grouping spelling variants: words one edit apart, and the frequent form each word leads to.

Reduced-alphabet generation: letters are hashed to a few symbols, which turns a word into a reduced word. Words one
edit apart have reduced words that are equal or one edit apart, so the full one-edit neighbourhood of every reduced
word (deletions, replacements, insertions) is generated and joined with the reduced words that exist; the words
behind two neighbours are then compared letter by letter. A small alphabet keeps neighbourhoods short; the larger the
vocabulary, the more words share a reduced word, so the alphabet is the smallest one whose reduced words are shared
by few words, counted over the whole vocabulary. Neighbours are 64-bit hashes of the reduced word, worked out from
the hashes of its parts; a collision only adds a comparison.

Neighbourhoods are symmetric, so a neighbour is kept on the side of the smaller hash only, which halves the shuffle.
Comparison happens inside the join: pairs that are not near are never emitted.

Defined cases: NULL and empty texts have no words; equal rows count each; ties of the most frequent near word go to the
smallest in code-point order; words without near words lead to themselves; an empty table has no words; other columns
are ignored. A NULL doc_id is written as nothing where the run's checksum names it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.llm.common import docs_of, written
from arenalake.llm.words import column, mix, signed, small_batches, texts

MIN_LENGTH = 5  # code points of a word
MIN_COUNT = 3  # occurrences of a word
FACTOR = 2  # a form occurs at least so many times as often
ALPHABETS = (4, 6, 8, 12, 16, 24)  # sizes of the reduced alphabet to choose from
SHARED = 4  # words that may share a reduced word, seen from a word, on average
_MOST_WORDS = 300_000  # words a task counts before it hands them on
_CELLS = 1 << 21  # neighbours worked out at once

# A text in Latin-1 (what it lacks becomes a blank): letters A-Z lower-cased, other letters kept, the rest blank.
_ASCII, _ACCENTED = bytes(range(97, 123)), bytes(range(0xC0, 0x100))
_RUNS = bytes(c + 32 if 65 <= c <= 90 else c if c in _ASCII or c in _ACCENTED else 32 for c in range(256))


def _runs(text: bytes) -> list[bytes]:
    """Maximal runs of letters, one byte per code point."""
    return text.decode("utf-8", "replace").encode("latin-1", "replace").translate(_RUNS).split()


def _word_rows(slips: int | None, least: int):
    """(word, n) of a task's texts; a word may come several times."""

    def flush(total: Counter) -> pa.RecordBatch:
        kept = [(w.decode("latin-1"), n) for w, n in total.items() if n > 0 and len(w) >= least]
        total.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"]
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(column(batch, "doc_id").to_pylist(), texts(batch)):
                if not text:
                    continue
                words = _runs(text)
                total.update(words)
                if slips:
                    own = list(set(words))
                    start = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                    names = own if text.isascii() else [w.decode("latin-1").encode() for w in own]
                    sums = np.fromiter(map(zlib.crc32, names, repeat(start)), np.int64, len(own))
                    hit = np.flatnonzero(sums % slips == 0)
                    if len(hit):
                        times = Counter(words)
                        for i in hit.tolist():
                            w, at = own[i], int(sums[i]) % len(own[i])
                            total[w] -= times[w]
                            total[w[:at] + w[at + 1:]] += times[w]
                if len(total) > _MOST_WORDS:
                    yield flush(total)
        yield flush(total)

    return rows


def vocabulary(docs: DataFrame, slips: int | None = None, least: int = MIN_LENGTH, count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least `least` code points and `count` occurrences.

    `slips`: a run loses one letter in those documents where the checksum of doc_id and run is divisible by it.
    """
    small_batches(docs.sparkSession)
    parts = docs_of(docs).mapInArrow(_word_rows(slips, least), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= count)


def reduction(k: int) -> tuple[str, str]:
    """Letters and their symbols: letters in hash order are dealt to the k symbols in turn."""
    letters, symbols = [], []
    for part in (_ASCII, _ACCENTED):
        drawn = sorted(part, key=lambda c: zlib.crc32(bytes([c])))
        letters += [chr(c) for c in drawn]
        symbols += [chr(97 + i % k) for i in range(len(drawn))]
    return "".join(letters), "".join(symbols)


def _reduced(k: int):
    return F.translate("word", *reduction(k))


def alphabet(words: DataFrame) -> int:
    """The smallest alphabet with reduced words shared by at most SHARED words, as the average word sees it."""
    each = F.array(*[F.struct(F.lit(k).alias("k"), _reduced(k).alias("r")) for k in ALPHABETS])
    sizes = words.select(F.explode(each).alias("x")).groupBy("x.k", "x.r").agg(F.count(F.lit(1)).cast("double").alias("c"))
    seen = dict(sizes.groupBy("k").agg(F.sum(F.col("c") * F.col("c")) / F.sum("c")).collect())
    return next((k for k in ALPHABETS if seen.get(k, 0) <= SHARED), ALPHABETS[-1])


class Neighbours:
    """Hashes of reduced words and of everything one edit away.

    A word's hash is the sum of symbol values times powers of an odd base, so an edit's hash follows from the sums
    before and behind its place.
    """

    def __init__(self, k: int):
        rng = np.random.default_rng(20)
        self.k = k
        self.values = rng.integers(1, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.back = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

    def _parts(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms, sums before every place (n x (length + 1)), and powers."""
        power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(codes.shape[1], self.base))), dtype=np.uint64)
        terms = self.values[codes] * power[:-1]
        before = np.concatenate((np.zeros((len(codes), 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)), axis=1)
        return terms, before, power

    def own(self, codes: np.ndarray) -> np.ndarray:
        return mix(self._parts(codes)[1][:, -1] + np.uint64(codes.shape[1]))

    def around(self, codes: np.ndarray) -> np.ndarray:
        """n x m hashes: the word itself, all deletions, replacements and insertions (some more than once)."""
        n, length = codes.shape
        terms, before, power = self._parts(codes)
        whole = before[:, -1:]
        behind = whole - before[:, 1:]
        gone = before[:, :-1] + behind * self.back
        other = (whole - terms)[:, :, None] + self.values * power[:-1][None, :, None]
        added = (before + (whole - before) * self.base)[:, :, None] + self.values * power[None, :, None]
        size = np.uint64(length)
        return mix(np.concatenate(
            [whole + size, gone + (size - np.uint64(1)), other.reshape(n, -1) + size, added.reshape(n, -1) + (size + np.uint64(1))], axis=1
        ))


def _by_length(words: list[str], k: int) -> Iterator[tuple[list[int], np.ndarray]]:
    """Row numbers and symbol codes of the words of one length, so many that a block of neighbours stays small."""
    found: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        found.setdefault(len(word), []).append(i)
    for length, rows in found.items():
        step = max(1, _CELLS // (2 * k * (length + 1)))
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            flat = "".join([words[i] for i in part]).encode()
            yield part, np.frombuffer(flat, np.uint8).reshape(len(part), length).astype(np.int64) - 97


def _key_rows(k: int):
    """Words with the hash of their reduced word."""

    def rows(batches):
        hashes = Neighbours(k)
        for batch in batches:
            reduced = column(batch, "r").to_pylist()
            keys = np.zeros(len(reduced), np.uint64)
            with np.errstate(over="ignore"):
                for part, codes in _by_length(reduced, k):
                    keys[part] = hashes.own(codes)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "word"), column(batch, "n"), column(batch, "r"), pa.array(signed(keys))], names=["word", "n", "r", "key"]
            )

    return rows


def _near_rows(k: int):
    """(own, other): every neighbour of a reduced word whose hash is not smaller than its own, once."""

    def rows(batches):
        hashes = Neighbours(k)
        for batch in batches:
            with np.errstate(over="ignore"):
                for _, codes in _by_length(column(batch, "r").to_pylist(), k):
                    own = signed(hashes.own(codes))
                    near = np.sort(signed(hashes.around(codes)), axis=1)
                    keep = near >= own[:, None]
                    keep[:, 1:] &= near[:, 1:] != near[:, :-1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(own, keep.sum(axis=1))), pa.array(near[keep])], names=["own", "other"]
                    )

    return rows


def near_pairs(words: DataFrame, k: int | None = None) -> DataFrame:
    """(a, n_a, b, n_b): every two words of `words` (word, n) that are exactly one edit apart, once."""
    k = k or alphabet(words)
    forms = words.select("word", "n", _reduced(k).alias("r")).mapInArrow(_key_rows(k), "word string, n long, r string, key long")
    forms = written(forms, "forms")
    around = forms.select("r").distinct().mapInArrow(_near_rows(k), "own long, other long")
    met = written(around.join(forms.select(F.col("key").alias("other")).distinct(), "other", "left_semi").select("own", "other"), "met")
    a = forms.select(F.col("key").alias("own"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = forms.select(F.col("key").alias("key_b"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    apart = (F.col("own") != F.col("other")) | (F.col("a") < F.col("b"))
    one = (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)
    return met.join(a, "own").join(b, (F.col("other") == F.col("key_b")) & apart & one).select("a", "n_a", "b", "n_b")


def _roots(led: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form. A form is at least twice as frequent, so chains are short; every
    round doubles the steps taken."""
    now = written(led.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        now = written(now.join(ahead, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        ), "roots")
        if not now.filter("moved").limit(1).count():
            return now.select("word", "root")
        now = now.drop("moved")


def variants(
    docs: DataFrame, slips: int | None = None, least: int = MIN_LENGTH, count: int = MIN_COUNT, factor: int = FACTOR,
    k: int | None = None,
) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = written(vocabulary(docs, slips, least, count), "words")
    pairs = written(near_pairs(words, k), "pairs")
    sides = pairs.select(F.col("a").alias("w"), F.col("b").alias("v"), F.col("n_b").alias("m")).union(pairs.select("b", "a", "n_a"))
    best = sides.groupBy("w").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "v")).alias("top")
    )
    led = F.col("top.m") * -1 >= F.col("n") * factor
    rows = written(words.join(best, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(led, F.col("top.v")).alias("form"), F.when(led, -F.col("top.m")).alias("form_n"),
    ), "variants")
    roots = _roots(rows.filter("form IS NOT NULL")).select(F.col("word").alias("of"), "root")
    return rows.join(roots, F.col("word") == F.col("of"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
