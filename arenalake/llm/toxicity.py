"""Toxicity by a support vector machine over a gap-weighted subsequence string kernel.

The kernel of two words sums lambda^(spans) over the character subsequences of length 3 and 4 they
share, gaps included, so `i-d-i-o-t`, `idxiot` and unseen forms of a known stem stay close to it. Spans
are limited to 7 characters. A Nystroem map over landmark words makes the machine linear; because the
kernel is an inner product of subsequence weights, landmarks and coefficients fold into one table of
48^4 + 48^3 numbers, and a word is scored by looking its own subsequences up. A word's edges are
characters too.

Labels are those of whole documents, so words are labelled in turns (multiple-instance training): words
RATIO times commoner in toxic than in clean documents start as positive, the machine is fitted, and those
it does not tell from clean words are taken out. Texts that show a word between the same two words count once,
so that a group of copies does not make insults of its words. A text's value is the sum of what its
words' values exceed FLOOR by (each at most FULL) in its worst window of WINDOW words, or its highest word's if
none does; runs of single letters (`i d i o t`) count as one more word. A logistic curve whose cut costs
least on the sampled training texts makes a score of it.

The fit uses bounded samples of the labelled rows: DOCS documents per class and WORDS words per class.

Defined cases: NULL, empty and letterless texts score like a text of clean words only; with one class or
no labels everything scores 0; conflicting labels of one doc_id count as toxic; repeated rows are scored
one by one; words are never cut however long.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.llm.common import docs_of, written
from arenalake.llm.words import column, small_batches, texts

LAMBDA = 0.75
SPAN = 7
DOCS = 6000
WORDS = 20_000
COMMON = 5000  # of the clean ones: the commonest
LANDMARKS = 256
FORMED = 1000  # words whose forms with an inserted letter are learnt too
_INSERTED = "xzqkwjvy"
SIGNS = 48  # codes of characters
_EDGE = 27  # code of a word's begin and end
TABLE = SIGNS**4 + SIGNS**3
# Offsets of a subsequence's later characters, with the base of its table.
_PATTERNS = [(p, 0 if len(p) == 3 else SIGNS**4) for n in (3, 2) for p in combinations(range(1, SPAN), n)]
STEEP = 0.5  # value that raises the odds e-fold
CAUTION = 5  # what a clean text marked weighs against a toxic one missed
FLOOR = 0.3  # word values up to here add nothing
FULL = 1.0  # most that one word adds
WINDOW = 64  # words whose evidence is added up
RATIO = 10  # how much commoner an insult is in toxic texts than in clean ones
# Signs that stand for letters inside a word.
_LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}
_MARKS = " .,;:!?\"'()[]{}<>*#$%&|/\\-_=+~^@`"


def letters_of(chunk: bytes) -> str:
    """Letters of a chunk without marks; look-alike signs count inside a word."""
    text = chunk.decode("utf-8", "replace").strip(_MARKS).lower()
    if text.isascii() and text.isalpha():
        return text
    text = unicodedata.normalize("NFC", text)
    return "".join([_LOOKALIKE.get(c, c) for c in text if c.isalpha() or c in _LOOKALIKE])


def _codes(text: str) -> np.ndarray:
    """1..26 for a-z, 27 for edges (\\x02), 28..47 for everything else by code point, 0 between words."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    latin = (points >= 97) & (points <= 122)
    other = np.where(points == 2, _EDGE, 28 + points % (SIGNS - 28))
    return np.where(latin, points - 96, np.where(points == 32, 0, other))


def _subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(word, table place, weight) of every subsequence, pattern by pattern."""
    # Edges are characters too, so that a stem at a word's begin differs from one inside; shorter words have none.
    words = [f"\x02{w}\x02 " if len(w) > 2 else f"{w} " for w in words]
    codes = _codes("".join(words))
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    for offsets, base in _PATTERNS:
        n = len(codes) - offsets[-1]
        if n <= 0:
            continue
        at = np.flatnonzero((owner[:n] == owner[offsets[-1]:]) & (codes[offsets[-1]:] > 0))
        place = codes[at]
        for o in offsets:
            place = place * SIGNS + codes[at + o]
        yield owner[at], place + base, LAMBDA ** (offsets[-1] + 1)


def _features(words: list[str]):
    """Rows of (word, place, weight), weights scaled so that a word has about unit length."""
    parts = list(_subsequences(words))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    word, place = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    weight = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
    size = np.sqrt(np.bincount(word, weight**2, len(words)))
    return word, place, weight / size[word]


def word_values(table: np.ndarray, words: list[str]) -> np.ndarray:
    """Inner product of each word's scaled subsequence weights with `table`."""
    value, size = np.zeros(len(words)), np.zeros(len(words))
    for word, place, weight in _subsequences(words):
        value += np.bincount(word, table[place], len(words)) * weight
        size += np.bincount(word, minlength=len(words)) * weight**2
    return value / np.sqrt(np.maximum(size, 1e-12))


@dataclass
class Machine:
    table: np.ndarray  # folded landmarks and coefficients
    bias: float
    slope: float = 1.0
    offset: float = 0.0


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last column of x is the constant."""
    u = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        margin = 1 - y * (x @ u)
        on = margin > 0
        xa, wa = x[on], weight[on]
        step = np.linalg.solve(ridge + (xa * wa[:, None]).T @ xa, (xa * (wa * y[on])[:, None]).sum(0))
        if np.abs(step - u).max() < 1e-6:
            break
        u = step
    return u


def train_words(positive: list[str], counts: list[int], negative: list[str], seen: list[int]) -> Machine:
    """Fit the machine on words of toxic texts and words of clean ones, each with its number of such texts."""
    order = sorted(range(len(positive)), key=lambda i: (-counts[i], positive[i]))
    half = LANDMARKS // 2
    # Landmarks: the words most toxic texts share, the words most clean texts share, and evenly drawn clean ones.
    common = sorted(range(len(negative)), key=lambda i: (-seen[i], negative[i]))[:half // 2]
    drawn = sorted(set(negative) - {negative[i] for i in common})
    marks = [positive[i] for i in order[:half]] + [negative[i] for i in common] + drawn[:: max(1, len(drawn) // (half // 2))][:half // 2]
    word, place, weight = _features(marks)
    known, at = np.unique(place, return_inverse=True)  # only these places of the table are ever used
    phi = np.zeros((len(marks), len(known)), np.float32)
    np.add.at(phi, (word, at), weight)
    gram = (phi @ phi.T).astype(float)
    values, vectors = np.linalg.eigh(gram)
    keep = values > 1e-4 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])  # marks x rank
    basis = (phi.T @ root).astype(np.float32)  # places x rank: the Nystroem map of one subsequence

    def mapped(words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), basis.shape[1] + 1), np.float32)
        for begin in range(0, len(words), 2000):
            some = words[begin:begin + 2000]
            w, places, v = _features(some)
            p = np.minimum(np.searchsorted(known, places), len(known) - 1)
            hit = known[p] == places
            w, p, v = w[hit], p[hit], v[hit]
            for c in range(basis.shape[1]):
                out[begin:begin + len(some), c] = np.bincount(w, v * basis[p, c], len(some))
        out[:, -1] = 1
        return out

    xp, xn = mapped(positive), mapped(negative)
    strength = np.array(counts, float)
    usual = 1 + np.log2(np.array(seen, float))
    usual /= usual.sum()
    live = np.ones(len(positive), bool)
    for _ in range(4):
        x = np.concatenate([xp[live], xn])
        y = np.concatenate([np.ones(live.sum()), -np.ones(len(xn))])
        weight = np.concatenate([strength[live] / strength[live].sum(), usual]) * len(x)
        u = _fit(x, y, weight, penalty=1.0)
        clean = np.quantile(xn @ u, 0.999)
        told = xp @ u > max(clean, -0.5)
        if not told.any() or (told == live).all():
            break
        live = told
    # Forms with one inserted letter join the words that were told apart, at a fifth of their weight each.
    forms, origin = [], []
    for i in np.flatnonzero(live)[np.argsort(-strength[live], kind="stable")][:FORMED]:
        word = positive[i]
        for n in range(1, len(word)):
            forms.append(word[:n] + _INSERTED[(n + len(word)) % len(_INSERTED)] + word[n:])
            origin.append(strength[i] / 5)
    if forms:
        x = np.concatenate([xp[live], mapped(forms), xn])
        y = np.concatenate([np.ones(live.sum() + len(forms)), -np.ones(len(xn))])
        weight = np.concatenate([strength[live], origin])
        weight = np.concatenate([weight / weight.sum(), usual]) * len(x)
        u = _fit(x, y, weight, penalty=1.0)
    table = np.zeros(TABLE, np.float32)
    table[known] = basis @ u[:-1]
    return Machine(table, float(u[-1]))


class Scorer:
    """Values per distinct chunk, kept while the cache is small enough."""

    def __init__(self, table: np.ndarray, bias: float, most: int = 200_000):
        self.table, self.bias, self.most = table, bias, most
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.values, self.sizes = np.empty(0), np.empty(0, np.int64)

    def _learn(self, chunks: set[bytes]) -> None:
        if len(self.index) > self.most:
            self._clear()
        new = [c for c in chunks if c not in self.index]
        words = [letters_of(c) for c in new]
        values = word_values(self.table, words) + self.bias if new else np.empty(0)
        base = len(self.values)
        self.index.update(zip(new, range(base, base + len(new))))
        self.values = np.concatenate([self.values, values])
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, words), np.int64, len(words))])

    def texts(self, todo: list[list[bytes]]) -> list[tuple[float, int]]:
        """(value, place of the highest word) of each text."""
        self._learn(set().union(*todo))
        out = []
        for words in todo:
            at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
            values = self.values[at]
            for first, joined in _spelled(words, self.sizes[at]):
                values[first] = max(values[first], float(word_values(self.table, [joined])[0] + self.bias))
            out.append((evidence(values, self.bias), int(values.argmax()) if len(at) else -1))
        return out


def evidence(values: np.ndarray, bias: float) -> float:
    """A text's value from its words': the sum of what lies over FLOOR in the worst window, else the highest."""
    over = values - FLOOR
    best = float(over.max(initial=bias - FLOOR))
    if best <= 0:
        return best
    total = np.concatenate([[0.0], np.cumsum(np.clip(over, 0, FULL))])
    return float((total[WINDOW:] - total[:-WINDOW]).max()) if len(values) > WINDOW else float(total[-1])


def _spelled(words: list[bytes], sizes: np.ndarray) -> Iterator[tuple[int, str]]:
    """Runs of three or more single letters as one word, with the place of the first."""
    single = np.concatenate([[False], sizes == 1, [False]])
    edges = np.flatnonzero(single[1:] != single[:-1])
    for a, b in zip(edges[::2], edges[1::2]):
        if b - a >= 3:
            yield int(a), "".join([letters_of(w) for w in words[a:b]])


def _value_rows(machine):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*machine.value)
        for batch in batches:
            found = scorer.texts([(t or b"").lower().split() for t in texts(batch)])
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array([v for v, _ in found], pa.float64()),
                 pa.array([w for _, w in found], pa.int32())],
                names=["doc_id", "value", "word"],
            )

    return rows


def _values(docs: DataFrame, machine: Machine) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((machine.table, machine.bias))  # fixed size
    return docs_of(docs).mapInArrow(_value_rows(shared), "doc_id long, value double, word int")


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word of a text once, with a hash of the words before and behind its first place."""
    for batch in batches:
        words, labels, places = [], [], []
        for label, text in zip(column(batch, "label").to_pylist(), texts(batch)):
            chunks = [b"", *(text or b"").lower().split(), b""]
            mine: dict[bytes, int] = {}
            for n in range(len(chunks) - 2, 0, -1):
                mine[chunks[n]] = n
            for chunk, n in mine.items():
                word = letters_of(chunk)
                if len(word) > 2:
                    words.append(word), labels.append(label)
                    places.append(zlib.crc32(chunks[n - 1] + b" " + chunks[n + 1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(labels, pa.int32()), pa.array(places, pa.int64())],
            names=["word", "label", "place"],
        )


def train(docs: DataFrame, labels: DataFrame) -> Machine | None:
    """Fit on the documents that have a label; None if a class is missing."""
    small_batches(docs.sparkSession)
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.col("toxic").cast("int")).alias("label")
    )
    sizes = known.groupBy(F.col("label").alias("of")).count()
    share = F.col("count") * (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1e6) < DOCS
    # About 2 x DOCS ids whatever the input, so they are broadcast; the sampled texts are written and read thrice.
    chosen = F.broadcast(written(known.join(sizes, F.col("label") == F.col("of")).filter(share).select("id", "label"), "chosen"))
    sample = written(
        docs_of(docs).join(chosen, F.col("doc_id") == F.col("id")).select("doc_id", "text", "label"), "sample"
    )
    counted = written(
        sample.mapInArrow(_word_rows, "word string, label int, place long").distinct().groupBy("word").agg(
            F.sum(F.col("label")).alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
        ),
        "words",
    )
    # A word's share of toxic texts against its share of clean ones, so that single wrong labels change little.
    classes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(classes) < 2:
        return None
    lopsided = F.col("toxic") * float(classes[0]) > RATIO * (F.col("clean") + 2) * float(classes[1])
    order = F.xxhash64("word")
    bad = counted.filter(lopsided).orderBy(F.desc(F.col("toxic") - F.col("clean")), order).limit(WORDS).select("word", "toxic").toArrow()
    # The commonest clean words, and others by hash.
    calm = counted.filter(~lopsided & (F.col("clean") > 0)).select("word", "clean")
    common = calm.orderBy(F.desc("clean"), order).limit(COMMON)
    others = calm.join(F.broadcast(common.select(F.col("word").alias("of"))), F.col("word") == F.col("of"), "left_anti")
    good = common.union(others.orderBy(order).limit(WORDS - COMMON)).toArrow()
    if not bad.num_rows or not good.num_rows:
        return None
    machine = train_words(bad["word"].to_pylist(), bad["toxic"].to_pylist(), good["word"].to_pylist(), good["clean"].to_pylist())
    drawn = _values(sample, machine).join(chosen, F.col("doc_id") == F.col("id")).select("value", "label").toArrow()
    machine.slope, machine.offset = _curve(drawn["value"].to_numpy(), drawn["label"].to_numpy())
    return machine


def _curve(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from values to scores.

    It passes 0.7 at the cut that costs least on the sample: the share of toxic texts below it, and CAUTION
    times the share of clean ones above it. Between two values of the sample the cut lies in the middle.
    """
    order = np.argsort(value, kind="stable")
    value, label = value[order], label[order]
    missed = np.cumsum(label == 1) / max(1, (label == 1).sum())  # with the cut above this value
    marked = 1 - np.cumsum(label == 0) / max(1, (label == 0).sum())
    ends = np.append(value[1:] > value[:-1], True)
    cost = np.where(ends, missed + CAUTION * marked, np.inf)
    at = int(cost.argmin())
    cut = value[at] + STEEP if at + 1 == len(value) else (value[at] + value[at + 1]) / 2
    slope = 1 / STEEP
    return float(slope), float(np.log(0.7 / 0.3) - slope * cut)


def score(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """doc_id, score, and the place of the word with the highest value (-1: none)."""
    small_batches(docs.sparkSession)
    if machine is None:
        return docs_of(docs).select("doc_id", F.lit(0.0).alias("score"), F.lit(-1).alias("word"))
    curve = 1 / (1 + F.exp(-(F.lit(machine.slope) * F.col("value") + F.lit(machine.offset))))
    return _values(docs, machine).select("doc_id", curve.alias("score"), "word")
