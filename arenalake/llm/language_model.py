"""Interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by the workers.

Counting: tasks turn texts into word hashes and combine equal bigrams before anything is shuffled; counts
travel as packed arrays by shard of the left word. A shard's merge task sorts its bigrams by hash and writes
them, with the statistics of its contexts, as one file of sorted arrays below the shared folder; what each
right word adds travels on to the shards of the word table, written the same way. Only file names and sums
come back to the driver.

Scoring: workers map the files (a file system that cannot be mapped is first copied to the task's own scratch
file, removed as soon as it is mapped) and look the bigrams of a batch up by binary search, shard by shard.
Every row of the corpus is counted and nothing is pruned; memory is one batch, one shard while merging.

The order is 2: trigram types grow almost as fast as the corpus (0.7 per token here, bigrams 0.45), and their
arrays and shuffle would not fit the disk limits the operator was built for.

Defined cases: NULL is empty; an empty text is its end token; words are lower-cased A-Z and split at white
space; nothing to learn from gives a model of one unknown word with probability 1; repeated rows count and are
scored each; files are named anew by every task attempt, so a rerun never reads half a file.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.llm.common import docs_of, new_dir, written
from arenalake.llm.words import WordHashes, column, lower_words, mix, small_batches, texts

BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b"\n<s>"))
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n</s>"))
FLUSH = 2_000_000  # bigrams combined before they are sent
SHARD_CHARS = 12_000_000  # characters of text per shard

_COUNTED = "shard int, left binary, runs binary, right binary, n binary"
_KINDS = [("shard", pa.int32()), ("left", pa.binary()), ("runs", pa.binary()), ("right", pa.binary()), ("n", pa.binary())]


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _combined(left: np.ndarray, right: np.ndarray, n: np.ndarray | None = None):
    """Distinct (left, right) in order with their summed counts."""
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(left))) if n is None else np.add.reduceat(n[order], at)
    return left[at], right[at], counts.astype(np.int64)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every run of equal neighbours, and its length."""
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return at, np.diff(np.append(at, len(values)))


def _sent(left: np.ndarray, right: np.ndarray, shards: int) -> pa.RecordBatch:
    left, right, n = _combined(left, right)
    out: list[list] = [[], [], [], [], []]
    shard = (left % np.uint64(shards)).astype(np.int64)
    for s in np.unique(shard):
        mine = shard == s
        own, count = left[mine], n[mine]
        at, runs = _runs(own)
        packed = (own[at], runs.astype(np.uint32), right[mine], count.astype(np.uint32))
        for values, value in zip(out, (int(s), *[x.tobytes() for x in packed])):
            values.append(value)
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(out, _KINDS)], names=[n for n, _ in _KINDS])


def _count_rows(shards: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        lefts, rights, size = [], [], 0
        for batch in batches:
            for text in texts(batch):
                tokens = np.append(hashes.of(lower_words(text)), END)
                lefts.append(np.concatenate(([BEGIN], tokens[:-1])))
                rights.append(tokens)
                size += len(tokens)
                if size >= FLUSH:
                    yield _sent(np.concatenate(lefts), np.concatenate(rights), shards)
                    lefts, rights, size = [], [], 0
        if size:
            yield _sent(np.concatenate(lefts), np.concatenate(rights), shards)

    return rows


# A file: a few array lengths, then the arrays one after the other.
def write_arrays(folder: str, name: str, arrays: list[np.ndarray]) -> str:
    system, path = pyarrow.fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    file = f"{name}-{uuid.uuid4().hex}.arrays"
    with system.open_output_stream(f"{path}/{file}") as out:
        out.write(np.array([len(a) for a in arrays], np.int64).tobytes())
        for a in arrays:
            out.write(a.tobytes())
    return f"{folder}/{file}"


def map_arrays(uri: str, kinds: list) -> list[np.ndarray]:
    system, path = pyarrow.fs.FileSystem.from_uri(uri)
    if isinstance(system, pyarrow.fs.LocalFileSystem):
        raw = np.memmap(path, np.uint8, "r")
    else:
        with system.open_input_stream(path) as source, tempfile.NamedTemporaryFile(delete=False) as copy:
            while block := source.read(1 << 22):
                copy.write(block)
        raw = np.memmap(copy.name, np.uint8, "r")
        os.unlink(copy.name)  # stays readable while it is mapped
    lengths = raw[:8 * len(kinds)].view(np.int64)
    out, at = [], 8 * len(kinds)
    for n, kind in zip(lengths, kinds):
        size = int(n) * np.dtype(kind).itemsize
        out.append(raw[at:at + size].view(kind))
        at += size
    return out


PAIRS = [np.uint64, np.uint64, np.int64, np.uint32, np.uint32, np.uint32, np.uint32]
WORDS = [np.uint64, np.int64, np.uint32]
_MERGED = "kind string, shard int, path string, sums array<long>, word binary, types binary, n binary"
_MERGED_SCHEMA = pa.schema(
    [("kind", pa.string()), ("shard", pa.int32()), ("path", pa.string()), ("sums", pa.list_(pa.int64())),
     ("word", pa.binary()), ("types", pa.binary()), ("n", pa.binary())]
)


def _counts_of(n: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3, 4."""
    return [int((n == k).sum()) for k in (1, 2, 3, 4)]


def _merge_pairs(folder: str, shards: int):
    def merge(key: tuple, group: pa.Table) -> pa.Table:
        get = lambda name, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group[name]])
        left = np.repeat(get("left", np.uint64), get("runs", np.uint32))
        left, right, n = _combined(left, get("right", np.uint64), get("n", np.uint32).astype(np.int64))
        at, runs = _runs(left)
        per = lambda x: np.add.reduceat(x.astype(np.int64), at)
        context = [left[at], per(n), per(n == 1), per(n == 2), per(n >= 3)]
        keys = pair_keys(left, right)
        order = np.argsort(keys)
        arrays = [keys[order], context[0], context[1], *context[2:], n[order]]
        path = write_arrays(folder, "pairs", [a.astype(k) for a, k in zip(arrays, PAIRS)])
        # What every right word gets: bigram types and tokens, for its own shard.
        order = np.argsort(right, kind="stable")
        word, n = right[order], n[order]
        at, types = _runs(word)
        word, n = word[at], np.add.reduceat(n, at)
        shard = (word % np.uint64(shards)).astype(np.int64)
        rows = {"kind": ["pairs"], "shard": [key[0].as_py()], "path": [path], "sums": [[len(right), *_counts_of(arrays[-1])]],
                "word": [None], "types": [None], "n": [None]}
        for s in np.unique(shard):
            mine = shard == s
            new = ("word", int(s), None, None, word[mine].tobytes(), types[mine].astype(np.uint32).tobytes(), n[mine].tobytes())
            for values, value in zip(rows.values(), new):
                values.append(value)
        return pa.table(rows, schema=_MERGED_SCHEMA)

    return merge


_FILES = "kind string, shard int, path string, sums array<long>"
_FILES_SCHEMA = pa.schema([_MERGED_SCHEMA.field(i) for i in range(4)])


def _merge_words(folder: str):
    def merge(key: tuple, group: pa.Table) -> pa.Table:
        get = lambda name, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group[name]])
        word, types, n = get("word", np.uint64), get("types", np.uint32).astype(np.int64), get("n", np.int64)
        order = np.argsort(word, kind="stable")
        word = word[order]
        at, _ = _runs(word)
        word, types, n = word[at], np.add.reduceat(types[order], at), np.add.reduceat(n[order], at)
        path = write_arrays(folder, "words", [word, n, types.astype(np.uint32)])
        sums = [int(n.sum()), len(word), int(types.sum()), *_counts_of(types), int((types >= 3).sum())]
        return pa.table({"kind": ["words"], "shard": [key[0].as_py()], "path": [path], "sums": [sums]}, schema=_FILES_SCHEMA)

    return merge


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 1, 2, 3 and more; plain halves where counts are missing."""
    if not (n1 and n2 and n3):
        return np.array([0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    found = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(found, [0.05, 0.1, 0.15], [0.95, 1.9, 2.85])


@dataclass
class Model:
    """File names by shard and the sums every probability needs."""

    pairs: dict[int, str]
    words: dict[int, str]
    shards: int
    tokens: int
    vocabulary: int
    types: int
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    rest: float  # share of the word level that goes to the uniform level


def train(docs: DataFrame) -> Model:
    """Count the texts of `docs` and write the model's files below the shared folder."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs_of(docs)
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = int(chars // SHARD_CHARS) + 4
    folder = new_dir(spark, "language-model")
    counted = rows.mapInArrow(_count_rows(shards), _COUNTED)
    merged = written(counted.groupBy("shard").applyInArrow(_merge_pairs(folder, shards), _MERGED), "pairs")
    words = merged.filter("kind = 'word'").groupBy("shard").applyInArrow(_merge_words(folder), _FILES)
    files = merged.filter("kind = 'pairs'").select("kind", "shard", "path", "sums").union(written(words, "words")).collect()
    pairs = {r.shard: r.path for r in files if r.kind == "pairs"}
    known = {r.shard: r.path for r in files if r.kind == "words"}
    total = lambda kind, size: np.array([r.sums for r in files if r.kind == kind] or [[0] * size], np.int64).sum(0).tolist()
    sums, pair_sums = total("words", 8), total("pairs", 5)
    tokens, vocabulary, types, w1, w2, w3, w4, more = sums
    d = discounts(w1, w2, w3, w4)
    rest = float(d @ [w1, w2, more] / types) if types else 1.0
    return Model(pairs, known, shards, tokens, vocabulary, types, discounts(*pair_sums[1:]), d, rest)


class Lookup:
    """A model's mapped files."""

    def __init__(self, model: Model):
        self.model = model
        self.open: dict[str, list[np.ndarray]] = {}

    def _arrays(self, uri: str, kinds: list) -> list[np.ndarray]:
        if uri not in self.open:
            self.open[uri] = map_arrays(uri, kinds)
        return self.open[uri]

    def _by_shard(self, of: np.ndarray, files: dict[int, str], kinds: list):
        shard = (of % np.uint64(self.model.shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        at, runs = _runs(shard[order]) if len(order) else (np.empty(0, int), np.empty(0, int))
        for a, n in zip(at, runs):
            mine = order[a:a + n]
            if int(shard[mine[0]]) in files:
                yield mine, self._arrays(files[int(shard[mine[0]])], kinds)

    @staticmethod
    def _found(array: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys)  # ascending searches walk the mapped pages in order
        at = np.empty(len(keys), np.int64)
        at[order] = np.searchsorted(array, keys[order])
        at = np.minimum(at, len(array) - 1)
        return at, array[at] == keys

    def words(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training count and word-level probability of each word."""
        m = self.model
        count, types = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        for mine, (keys, n, t) in self._by_shard(word, m.words, WORDS):
            at, hit = self._found(keys, word[mine])
            count[mine], types[mine] = np.where(hit, n[at], 0), np.where(hit, t[at], 0)
        cut = np.concatenate(([0.0], m.word_discounts))[np.minimum(types, 3)]
        return count, (types - cut) / max(m.types, 1) + m.rest / (m.vocabulary + 1)

    def pairs(self, left: np.ndarray, right: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Interpolated probability of `right` after `left`; `lower` is its word-level probability."""
        m = self.model
        out = lower.copy()
        for mine, (keys, context, total, n1, n2, n3, n) in self._by_shard(left, m.pairs, PAIRS):
            at, seen = self._found(context, left[mine])
            mine, at = mine[seen], at[seen]
            if not len(mine):
                continue
            back = (m.pair_discounts[0] * n1[at] + m.pair_discounts[1] * n2[at] + m.pair_discounts[2] * n3[at]) / total[at]
            where, hit = self._found(keys, pair_keys(left[mine], right[mine]))
            c = np.where(hit, n[where], 0).astype(np.int64)
            cut = np.concatenate(([0.0], m.pair_discounts))[np.minimum(c, 3)]
            out[mine] = (c - cut) / total[at] + back * lower[mine]
        return out


_OUT = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score_rows(model: Model):
    fields = tuple(vars(model).values())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, hashes = Lookup(Model(*fields)), WordHashes()
        for batch in batches:
            tokens = [np.append(hashes.of(lower_words(text)), END) for text in texts(batch)]
            sizes = np.array([len(t) for t in tokens])
            at = np.cumsum(sizes) - sizes
            flat = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
            word, inverse = np.unique(flat, return_inverse=True)
            count, lower = (x[inverse] for x in lookup.words(word))
            left = np.concatenate(([BEGIN], flat[:-1]))
            left[at] = BEGIN
            p = lookup.pairs(left, flat, lower)
            m = lookup.model
            base = np.log10((count + 1) / (m.tokens + m.vocabulary + 1))
            total = lambda x: np.add.reduceat(x, at) if len(at) else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(sizes, pa.int64()), pa.array(total((count > 0).astype(np.int64)), pa.int64()),
                 pa.array([m.tokens] * len(sizes), pa.int64()), pa.array(total(base), pa.float64()),
                 pa.array(total(np.log10(p)), pa.float64())],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return rows


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row."""
    small_batches(docs.sparkSession)
    rows = docs_of(docs).mapInArrow(_score_rows(model), _OUT)
    return rows.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
