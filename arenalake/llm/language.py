"""Language spans and the language of a text.

Characters' script ranges narrow the candidates of a word, hashed character n-grams score it in every
learnt language, and a Viterbi path over the words, with a penalty for each switch, labels spans of
mixed-language text. The text's language is the one its labelled spans have most letters of.

The model is counted in Spark on labelled rows; `per_language` bounds the rows a language is learnt
from (documented sample: rows whose hash of doc_id falls under the share that gives about so many).
It holds languages x 2^16 numbers whatever the corpus size.

Defined cases: NULL texts and texts without a letter are `und` with score 0, as is everything when
nothing was learnt; empty words (digits, signs) take no part; equal scores go to the language first in
alphabetical order; NULL languages teach nothing; repeated rows are labelled one by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.llm.common import docs_of
from arenalake.llm.words import column, small_batches, texts

BUCKETS = 1 << 16
GRAMS = (1, 2, 3, 4)
PER_LANGUAGE = 4000
MOST_LANGUAGES = 500
SWITCH = 12.0  # log-likelihood a switch must gain
FOREIGN = -40.0  # score of a word in a language never seen in its script

# First and last code point of the script ranges, with the script's number.
_SCRIPTS = [
    (0x0041, 0x024F, 0), (0x0370, 0x03FF, 1), (0x0400, 0x052F, 2), (0x0530, 0x058F, 3), (0x0590, 0x05FF, 4),
    (0x0600, 0x077F, 5), (0x0900, 0x097F, 6), (0x0980, 0x09FF, 7), (0x0A00, 0x0A7F, 8), (0x0B80, 0x0BFF, 9),
    (0x0C00, 0x0C7F, 10), (0x0E00, 0x0E7F, 11), (0x0E80, 0x0EFF, 12), (0x10A0, 0x10FF, 13), (0x1100, 0x11FF, 14),
    (0x1200, 0x137F, 15), (0x1780, 0x17FF, 16), (0x1E00, 0x1EFF, 0), (0x1F00, 0x1FFF, 1), (0x3040, 0x30FF, 17),
    (0x3400, 0x9FFF, 18), (0xAC00, 0xD7AF, 14), (0x20000, 0x2FFFF, 18),
]
_OTHER = 19
N_SCRIPTS = 20


def scripts_of(codes: np.ndarray) -> np.ndarray:
    """Script number of each code point."""
    firsts = np.array([a for a, _, _ in _SCRIPTS])
    at = np.searchsorted(firsts, codes, "right") - 1
    lasts, numbers = np.array([b for _, b, _ in _SCRIPTS]), np.array([s for _, _, s in _SCRIPTS])
    return np.where((at >= 0) & (codes <= lasts[at]), numbers[at], _OTHER)


def letters_of(chunk: bytes) -> str:
    """The letters of a blank-separated chunk, lower-cased."""
    text = chunk.decode("utf-8", "replace").lower()
    return text if text.isalpha() else "".join(filter(str.isalpha, text))


@dataclass
class Grams:
    """Hashed n-grams of many words: buckets, the word each belongs to, and the words' scripts."""

    bucket: np.ndarray
    word: np.ndarray
    script: np.ndarray  # words x scripts, letters of each


def grams_of(words: list[str]) -> Grams:
    framed = "".join([f"\x02{w}\x03" for w in words])
    codes = np.frombuffer(framed.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    buckets, owners = [], []
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x100000001B3) + (codes[n - 1:].astype(np.uint64) + np.uint64(n << 40))
        mixed = h ^ (h >> np.uint64(29))
        mixed = (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)
        inside = owner[:m] == owner[n - 1:]
        buckets.append(mixed[inside].astype(np.int64))
        owners.append(owner[:m][inside])
    letters = (codes != 2) & (codes != 3)
    place = owner[letters] * N_SCRIPTS + scripts_of(codes[letters])
    script = np.bincount(place, minlength=len(words) * N_SCRIPTS).reshape(len(words), N_SCRIPTS)
    return Grams(np.concatenate(buckets), np.concatenate(owners), script)


_COUNTS = "lang string, bucket int, n double"


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and language: weighted n-gram buckets, then letters per script."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        seen: dict[str, Counter] = {}
        for lang, text in zip(column(batch, "lang").to_pylist(), texts(batch)):
            seen.setdefault(lang, Counter()).update((text or b"").split())
        for lang, chunks in seen.items():
            words: Counter = Counter()
            for chunk, n in chunks.items():
                words[letters_of(chunk)] += n
            words.pop("", None)
            if not words:
                continue
            grams, weight = grams_of(list(words)), np.fromiter(words.values(), np.float64, len(words))
            mine = total.setdefault(lang, np.zeros(BUCKETS + N_SCRIPTS))
            mine[:BUCKETS] += np.bincount(grams.bucket, weight[grams.word], BUCKETS)
            mine[BUCKETS:] += weight @ grams.script
    for lang, counts in total.items():
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(counts[found])],
            names=["lang", "bucket", "n"],
        )


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # buckets x languages, log probabilities
    known: np.ndarray  # languages x scripts, whether the language was seen in the script


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Count n-grams of rows (doc_id, text, lang) and turn them into log probabilities."""
    small_batches(labelled.sparkSession)
    rows = labelled.filter("lang IS NOT NULL").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    # Rows are drawn where they are read: no text is shuffled.
    size = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], r["count"])])[F.col("lang")] if sizes else F.lit(0)
    share = size * (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6) < per_language
    sample = rows.filter(share).select("lang", "text")
    counts = (
        sample.mapInArrow(_count_rows, _COUNTS).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    )
    langs = sorted(counts["lang"].unique())
    table = np.zeros((BUCKETS + N_SCRIPTS, len(langs)))
    table[counts["bucket"].to_numpy(int), np.searchsorted(langs, counts["lang"].to_numpy(str))] = counts["n"]
    grams, script = table[:BUCKETS], table[BUCKETS:]
    smooth = 0.5
    weights = np.log((grams + smooth) / (grams.sum(0) + smooth * BUCKETS)).astype(np.float32)
    return Model(langs, weights, (script > 0.001 * script.sum(0)).T)


class Scorer:
    """Scores per distinct chunk, kept while the cache is small enough."""

    def __init__(self, model: Model, most: int = 200_000):
        self.model, self.most = model, most
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.scores = np.empty((0, len(self.model.langs)), np.float32)
        self.letters = np.empty(0, np.int64)

    def learn(self, chunks: set[bytes]) -> None:
        """Score the chunks not seen before, all at once."""
        if len(self.index) > self.most:
            self._clear()
        new = [c for c in chunks if c not in self.index]
        if not new:
            return
        words = [letters_of(c) for c in new]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        scores = np.zeros((len(new), len(self.model.langs)), np.float32)
        full = np.flatnonzero(lengths)
        if len(full):
            grams = grams_of([words[i] for i in full])
            order = np.argsort(grams.word, kind="stable")
            starts = np.searchsorted(grams.word[order], np.arange(len(full)))
            own = np.add.reduceat(self.model.weights[grams.bucket[order]], starts, axis=0)
            # A word's candidates are the languages known in each of its scripts.
            foreign = (grams.script > 0).astype(np.int64) @ (~self.model.known).T.astype(np.int64)
            some = (foreign == 0).any(axis=1)
            scores[full] = np.where((foreign > 0) & some[:, None], own + FOREIGN, own)
        base = len(self.letters)
        self.index.update(zip(new, range(base, base + len(new))))
        self.scores = np.concatenate([self.scores, scores])
        self.letters = np.concatenate([self.letters, lengths])


def viterbi(scores: np.ndarray, first: np.ndarray, length: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word; text i owns the rows first[i] .. first[i] + length[i] of `scores`.

    All texts advance together, longest first, so one step is one operation on all that still run.
    """
    order = np.argsort(-length, kind="stable")
    starts, sizes = first[order], length[order]
    running = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    back = np.empty(scores.shape, np.int16)
    labels = np.empty(len(scores), np.int16)
    every = np.arange(scores.shape[1], dtype=np.int16)
    value = np.zeros((len(order), scores.shape[1]))
    for t, n in enumerate(running):
        at = starts[:n] + t
        now = value[:n]
        best = now.argmax(1)
        gain = now[np.arange(n), best] - switch
        stay = now >= gain[:, None]
        back[at] = np.where(stay, every, best[:, None])
        value[:n] = np.where(stay, now, gain[:, None]) + scores[at]
    state = value.argmax(1)
    for t in range(len(running) - 1, -1, -1):
        n = running[t]
        at = starts[:n] + t
        labels[at] = state[:n]
        state[:n] = back[at, state[:n]]
    return labels


_OUT = "doc_id long, lang_pred string, score double, spans array<struct<first:int,last:int,lang:string>>"
_SPAN = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())])


def _label_rows(model_of, switch: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*model_of.value)
        scorer = Scorer(model)
        for batch in batches:
            ids, todo = column(batch, "doc_id"), [(t or b"").split() for t in texts(batch)]
            begin = 0
            langs, scores, spans = [], [], []
            while begin < len(todo):
                # Texts are labelled together up to a bounded table of words x languages.
                end, cells = begin, 0
                while end < len(todo) and (end == begin or cells + len(todo[end]) * len(model.langs) <= 4_000_000):
                    cells += len(todo[end]) * len(model.langs)
                    end += 1
                for row in _labelled(scorer, todo[begin:end], switch):
                    langs.append(row[0]), scores.append(row[1]), spans.append(row[2])
                begin = end
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(_SPAN))],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    return rows


def _labelled(scorer: Scorer, todo: list[list[bytes]], switch: float) -> Iterator[tuple]:
    langs = scorer.model.langs
    if not langs:
        yield from (("und", 0.0, []) for _ in todo)
        return
    scorer.learn(set().union(*todo))
    length = np.fromiter(map(len, todo), np.int64, len(todo))
    first = np.cumsum(length) - length
    index = np.fromiter((scorer.index[c] for words in todo for c in words), np.int64, int(length.sum()))
    labels = viterbi(scorer.scores[index], first, length, switch)
    letters = scorer.letters[index]
    for at, n in zip(first, length):
        path, weight = labels[at:at + n], letters[at:at + n]
        total = np.bincount(path, weight, len(langs))
        if not total.sum():
            yield "und", 0.0, []
            continue
        best = int(total.argmax())
        edges = np.flatnonzero(np.diff(path)) + 1
        cuts = [0, *edges.tolist(), int(n)]
        yield langs[best], float(total[best] / total.sum()), [
            {"first": a, "last": b - 1, "lang": langs[path[a]]} for a, b in zip(cuts, cuts[1:])
        ]


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score (share of letters) and spans (first and last word, language) per row."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.weights, model.known))  # languages x 2^16
    return docs_of(docs).mapInArrow(_label_rows(shared, switch), _OUT)
