"""Ranked lexical search: the best documents of every query under an integer BM25 score.

Per-term geometric blocking: rows of documents (the terms that queries ask for, and how often) are written once and
worked on in shards of a fixed number of documents. In a shard, the posting list of a term is clustered by document
similarity around some of its own documents, and every block keeps the coordinatewise maximum of its documents'
vectors. A query visits its lists from the largest possible contribution down. The product of a block's summary and
the query's weights is an upper bound of every score inside, so a block is skipped only if its bound lies below the
k-th best score known so far; the documents of the others are scored exactly, each once. Lists that are left are
skipped together once their largest contributions add up to less than that score, since a document in none of the
visited lists has nothing else to gain.

Two passes over the written rows: the first scores the most promising blocks of the first lists only, and the k-th
best of these real scores is where every shard of the second pass starts. Queries come in blocks of fixed number,
whose terms are all that tasks are given; tasks return k rows per query and the best of them are merged.

Defined cases: NULL, empty and term-less texts are no documents and, as queries, find nothing; equal scores go by
ascending doc_id (NULL last); equal rows are documents each for itself; every row of `queries` is a query of its own, also
if it repeats an item_id; an empty side finds nothing; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arenalake.llm.common import docs_of, written
from arenalake.llm.mixing import numbered
from arenalake.llm.words import column, small_batches, texts

K = 10
QUERIES = 256  # queries that share the passes
SHARD = 4096  # documents a task holds at once
CELLS = 1 << 24  # at most so many cells of a shard's matrix
MEMBERS = 32  # documents of a block, on average
FIRST_LISTS, FIRST_BLOCKS = 2, 2  # lists of a query, and blocks of each, that the first pass looks into

_KEEP = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEEP else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of digits, A-Z (lower-cased), a-z and everything beyond ASCII."""
    return (text or b"").translate(_TERMS).split()


def _row_rows(vocabulary: dict[bytes, int]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for doc_id, text in zip(column(batch, "doc_id").to_pylist(), texts(batch)):
                words = terms_of(text)
                if words:
                    times = Counter(words)
                    found = sorted([(vocabulary[t], times[t]) for t in known & times.keys()])
                    for values, value in zip(out, (doc_id, len(words), [t for t, _ in found], [c for _, c in found])):
                        values.append(value)
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=["doc_id", "n", "terms", "times"])

    return rows


@dataclass(frozen=True)
class Task:
    """What every task of a pass is told: corpus size, and per query its terms, their weights and the score to reach."""

    n_docs: int
    n_terms: int
    size: int  # of the vocabulary
    terms: list[np.ndarray]
    weights: list[np.ndarray]
    reach: list[int]
    k: int
    first: bool

    def impacts(self, n: np.ndarray, times: np.ndarray) -> np.ndarray:
        """The part of a term's score that depends on the document, for 64-bit whole numbers."""
        m = 10 + 90 * n * self.n_docs // self.n_terms
        return 1_000_000_000 * times // (1000 * times + 8 * m)


class Shard:
    """Some documents as a matrix (documents x terms) and their blocked posting lists, made when first asked for."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, counts: np.ndarray, terms: np.ndarray, times: np.ndarray, task: Task):
        self.ids = ids
        rows = np.repeat(np.arange(len(ids)), counts)
        # Impacts are below a million, so single precision holds them exactly.
        self.matrix = np.zeros((len(ids), task.size), np.float32)
        self.matrix[rows, terms] = task.impacts(n[rows], times)
        self.top = self.matrix.max(axis=0).astype(np.float64)
        order = np.argsort(terms, kind="stable")
        self.rows, self.edge = rows[order], np.searchsorted(terms[order], np.arange(task.size + 1))
        self.lists: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents of a term's list in block order, the blocks' edges, and the blocks' summaries."""
        if term not in self.lists:
            docs = self.rows[self.edge[term]:self.edge[term + 1]]
            many = -(-len(docs) // MEMBERS)
            if many > 1:
                vectors = self.matrix[docs]
                length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
                centre = np.linspace(0, len(docs) - 1, many).astype(np.int64)
                nearest = (vectors @ (vectors[centre] / length[centre, None]).T).argmax(axis=1)
                order = np.argsort(nearest, kind="stable")
                docs, vectors, nearest = docs[order], vectors[order], nearest[order]
                start = np.flatnonzero(np.concatenate(([True], nearest[1:] != nearest[:-1])))
                summary = np.maximum.reduceat(vectors, start, axis=0)
            else:
                start, summary = np.zeros(1, np.int64), self.matrix[docs].max(axis=0, keepdims=True)
            self.lists[term] = docs, np.concatenate((start, [len(docs)])), summary
        return self.lists[term]

    def best(self, terms: np.ndarray, weights: np.ndarray, reach: int, k: int, first: bool) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best documents of a query, as far as they score `reach` or more."""
        gain = weights * self.top[terms]
        order = np.argsort(-gain, kind="stable")
        terms, weights, gain = terms[order], weights[order], gain[order]
        left = np.cumsum(gain[::-1])[::-1]
        seen = np.zeros(len(self.ids), bool)
        rows, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        reach = max(reach, 1)
        for i in range(min(len(terms), FIRST_LISTS) if first else len(terms)):
            # Sums stay far below 2^53 for any query of less than 300,000 terms; the margin covers longer ones.
            if left[i] * (1 + 1e-9) < reach:
                break
            docs, edge, summary = self.blocks(int(terms[i]))
            bound = (summary[:, terms].astype(np.float64) @ weights) * (1 + 1e-9)
            visit = np.argsort(-bound, kind="stable")
            visit = visit[bound[visit] >= reach]
            if first:
                visit = visit[:FIRST_BLOCKS]
            # The best blocks first: their scores raise the bar for the others.
            at, step = 0, 2
            while at < len(visit) and bound[visit[at]] >= reach:
                chosen = visit[at:at + step]
                at, step = at + step, step * 2
                new = np.concatenate([docs[edge[b]:edge[b + 1]] for b in chosen[bound[chosen] >= reach]])
                new = new[~seen[new]]
                if not len(new):
                    continue
                seen[new] = True
                score = self.matrix[np.ix_(new, terms)].astype(np.int64) @ weights.astype(np.int64)
                fit = score >= reach
                rows, scores = np.concatenate((rows, new[fit])), np.concatenate((scores, score[fit]))
                if len(rows) > k:
                    keep = np.lexsort((self.ids[rows], -scores))[:k]
                    rows, scores = rows[keep], scores[keep]
                if len(rows) == k:
                    reach = max(reach, int(scores.min()))
        return rows, scores


_NONE = (1 << 63) - 1  # stands for a NULL doc_id, which is last among equal scores
_FOUND = "query long, doc_id long, score long"


def _found_rows(task: Task):
    size = max(1, min(SHARD, CELLS // max(task.size, 1)))

    def search(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        flat = lambda name: table.column(name).chunk(0) if table.num_rows else pa.array([])
        lists = flat("terms")
        shard = Shard(
            np.asarray(flat("doc_id").fill_null(_NONE)), np.asarray(flat("n")),
            np.diff(np.asarray(lists.offsets)), np.asarray(lists.flatten()), np.asarray(flat("times").flatten()), task,
        )
        query, ids, points = [], [], []
        for q, (terms, weights) in enumerate(zip(task.terms, task.weights)):
            rows, scores = shard.best(terms, weights, task.reach[q], task.k, task.first)
            query.append(np.full(len(rows), q))
            ids.append(shard.ids[rows])
            points.append(scores)
        flat_ids = np.concatenate(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(query), pa.int64()), pa.array(flat_ids, pa.int64(), mask=flat_ids == _NONE), pa.array(np.concatenate(points), pa.int64())],
            names=["query", "doc_id", "score"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - n)
                batch = batch.slice(part.num_rows)
                waiting.append(part)
                n += part.num_rows
                if n == size:
                    yield search(waiting)
                    waiting, n = [], 0
        if n:
            yield search(waiting)

    return rows


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every query; tasks hand on k rows each, since Spark limits a ranked window before its shuffle."""
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _block(docs: DataFrame, words: dict[int, list[bytes]], k: int) -> DataFrame:
    """(query, doc_id, score, rank) for one block of queries, given as number -> distinct terms."""
    vocabulary = {term: i for i, term in enumerate(sorted({t for terms in words.values() for t in terms}))}
    rows = written(docs.mapInArrow(_row_rows(vocabulary), "doc_id long, n long, terms array<int>, times array<long>"), "rows")
    n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One count per term of this block of queries.
    df = dict(rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    numbers = sorted(words)
    known = [np.array(sorted(i for i in (vocabulary[t] for t in words[q]) if i in df), np.int64) for q in numbers]
    weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
    weights = [np.array([weight(t) for t in terms.tolist()], np.float64) for terms in known]

    def found(reach: list[int], first: bool) -> DataFrame:
        task = Task(n_docs, n_terms, len(vocabulary), known, weights, reach, k, first)
        return _top(rows.mapInArrow(_found_rows(task), _FOUND), k)

    # k rows per query of the block.
    bar = {r.query: r.score for r in found([0] * len(numbers), True).filter(F.col("rank") == k).select("query", "score").collect()}
    named = F.element_at(F.array(*[F.lit(q) for q in numbers]), (F.col("query") + 1).cast("int"))
    return found([bar.get(q, 0) for q in range(len(numbers))], False).withColumn("query", named.cast("long"))


def search(docs: DataFrame, queries: DataFrame, k: int = K, block: int = QUERIES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents with a score above 0 of every row (item_id, text) of `queries`."""
    spark, docs = docs.sparkSession, docs_of(docs)
    small_batches(spark)
    asked = queries.select("item_id", F.col("text").cast("string").alias("text"))
    asked = written(numbered(asked, F.col("item_id"), F.col("text")), "queries")
    hits = None
    for low in range(0, asked.count(), block):
        mine = asked.filter((F.col("place") >= low) & (F.col("place") < low + block)).select("place", "text").collect()
        words = {r.place: sorted(set(terms_of((r.text or "").encode()))) for r in mine}
        words = {q: terms for q, terms in words.items() if terms}
        if words:
            part = written(_block(docs, words, k), "hits")
            hits = part if hits is None else hits.union(part)
    if hits is None:
        hits = spark.createDataFrame([], _FOUND + ", rank int")
    return hits.join(asked.select("place", "item_id"), F.col("query") == F.col("place")).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
    )
