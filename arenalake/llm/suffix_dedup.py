"""Exact repeated substrings of LENGTH bytes by bucketed suffix order and runs of equal prefixes.

Sorting every suffix of a corpus moves hundreds of bytes per byte. Here the suffix order is cut down to
what can matter and dealt into buckets that never split equal strings:

1. Every LENGTH-byte string has an anchor: its least GRAM-byte piece by hash, the leftmost of equals.
   Equal strings have equal anchors at equal offsets. Strings whose anchor piece is unique are unique.
2. Around the other anchors, starts are dealt into stretches of STRETCH positions aligned to the anchor.
   All strings of a stretch share its core, so equal strings lie in stretches with equal cores. Equal
   whole stretches are one: they stand for each other, however many there are, and need no sorting.
3. One member of each distinct stretch whose core has several goes to the bucket of its core. There the
   suffixes are ranked by prefix doubling. In suffix order, suffixes with a common prefix of LENGTH bytes
   form a run; a suffix has an earlier match (longest previous factor >= LENGTH) exactly if it is not the
   run's least position, so runs stand in for the factors, which are not computed.
4. A core with more than HOT distinct stretches (a passage in very many documents, each with its own
   surroundings) is never gathered. Its stretches are dealt again as fine ones of FINE positions, which
   share wider cores: most are equal as a whole or alone. Strings of the others are counted one by one,
   keeping the least and the greatest position per string, which map tasks combine.

`keep="none"` removes every occurrence, `keep="first"` only those with an earlier match; earlier is by
doc_id, then place.

With `words`, passages of more than that many words (between white space, letter case counts) are repeats too, however
few bytes they have. They are found the same way, with words in place of bytes: windows whose least piece of a third of
their words is unique are unique, the others are counted one by one. Both kinds are judged on the input and cut together.

Defined cases: NULL is empty; texts shorter than LENGTH keep everything; matches never cross documents;
rows alike in doc_id and text are copies of each other, and with keep="first" they count as one; a
document of any length is read in bounded segments; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenalake.llm.common import bind, release, written
from arenalake.llm.words import WordHashes, column, mix, small_batches, texts, window_hashes

LENGTH = 400
GRAM = 64
STRETCH = 64
SEGMENT = 1 << 17  # starts handled at once
BUCKET = 4000  # members ranked together
FINE = 8  # positions of a fine stretch
HOT = 1000  # distinct stretches of a core that are still ranked in one task
NO_ID = -(1 << 63)

_WINDOW = LENGTH - GRAM + 1


def _tables() -> tuple[np.ndarray, np.uint64, np.uint64]:
    """Random byte values, an odd base and its inverse modulo 2^64."""
    base = 0x9E3779B97F4A7C15 | 1
    return np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64), np.uint64(base), np.uint64(pow(base, -1, 1 << 64))


class Prefixes:
    """Hashes of any byte range of a buffer in O(1), equal for equal ranges wherever they lie."""

    def __init__(self):
        self.bytes, self.base, self.inverse = _tables()
        self.powers = self.inverses = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        if len(self.powers) <= len(data):
            n = 2 * len(data) + 1
            self.powers = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, self.base), dtype=np.uint64)))
            self.inverses = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, self.inverse), dtype=np.uint64)))
        self.total = np.concatenate(
            ([np.uint64(0)], np.cumsum(self.bytes[data] * self.powers[:len(data)], dtype=np.uint64))
        )

    def every(self, size: int) -> np.ndarray:
        n = len(self.total) - size
        return mix((self.total[size:] - self.total[:n]) * self.inverses[:n])

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.inverses[start])


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every `size` neighbours from prefix and suffix minima of blocks."""
    n = len(x) - size + 1
    padded = np.full(-(-len(x) // size) * size, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, size)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[size - 1:size - 1 + n])


def _anchors(prefixes: Prefixes, pieces: list[tuple[int, int, bytes]]):
    """(text, anchor, first start, last start, gram) of the strings in `pieces` (text, offset, bytes)."""
    data = np.frombuffer(b"".join([p[2] for p in pieces]), np.uint8)
    sizes = np.array([len(p[2]) for p in pieces])
    ends = np.cumsum(sizes)
    prefixes.load(data)
    grams = prefixes.every(GRAM)
    keys = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    owner = np.repeat(np.arange(len(pieces)), sizes)[:len(data) - LENGTH + 1]
    start = np.flatnonzero(np.arange(len(owner)) + LENGTH <= ends[owner])
    anchor = (_sliding_min(keys, _WINDOW)[start] & np.uint64(0xFFFFFF)).astype(np.int64)
    change = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(owner[start]) != 0)) + 1
    first = np.concatenate(([0], change))
    last = np.concatenate((change, [len(start)])) - 1
    own = owner[start[first]]
    shift = np.array([p[1] for p in pieces])[own] - (ends - sizes)[own]
    return (
        np.array([p[0] for p in pieces])[own], anchor[first] + shift, start[first] + shift, start[last] + shift,
        grams[anchor[first]].view(np.int64),
    )


_ANCHOR = pa.struct([("gram", pa.int64()), ("at", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])
_FIRST = "doc_id long, k long, h long, n_bytes long, sha string, anchors array<struct<gram:long,at:int,lo:int,hi:int>>"


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    prefixes = Prefixes()
    for batch in batches:
        data = [t or b"" for t in texts(batch)]
        found: list[list[tuple]] = [[] for _ in data]

        def flush(pieces):
            if pieces:
                for text, at, lo, hi, gram in zip(*[x.tolist() for x in _anchors(prefixes, pieces)]):
                    found[text].append({"gram": gram, "at": at, "lo": lo, "hi": hi})

        pieces, size = [], 0
        for i, text in enumerate(data):
            for offset in range(0, len(text) - LENGTH + 1, SEGMENT):
                piece = text[offset:offset + SEGMENT + LENGTH - 1]
                pieces.append((i, offset, piece))
                size += len(piece)
                if size >= SEGMENT:
                    flush(pieces)
                    pieces, size = [], 0
        flush(pieces)
        yield pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), column(batch, "k"), column(batch, "h"), pa.array([len(t) for t in data], pa.int64()),
             pa.array([hashlib.sha256(t).hexdigest() for t in data]), pa.array(found, pa.list_(_ANCHOR))],
            names=["doc_id", "k", "h", "n_bytes", "sha", "anchors"],
        )


_SPACES = re.compile(rb"[\x20\x09-\x0D]")
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_VOCABULARY = 100_000  # words whose hashes a task keeps


def _word_pieces(text: bytes, size: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(words, their starts, their ends) of bounded pieces; every window of `size` words lies in just one."""
    begin = end = 0
    while end < len(text):
        end = min(end + SEGMENT, len(text))
        space = _SPACES.search(text, end)
        end = space.start() if space else len(text)
        between = _SPACE[np.frombuffer(text[begin:end], np.uint8)]
        edges = np.flatnonzero(np.diff(between, prepend=True, append=True)) + begin
        starts, ends = edges[::2], edges[1::2]
        if len(starts) >= size:
            yield text[begin:end].split(), starts, ends
            begin = int(starts[len(starts) - size + 1]) if size > 1 else end


def _window_anchors(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the pieces of words, the piece each window of `size` words is anchored at)."""
    piece = max(1, size // 3)
    grams = window_hashes(h, piece)
    keys = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    return grams.view(np.int64), (_sliding_min(keys, size - piece + 1) & np.uint64(0xFFFFFF)).astype(np.int64)


_GRAMS = "k long, h long, grams array<long>"


def _gram_rows(size: int):
    """Anchor pieces of the windows of `size` words of each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(_VOCABULARY)
        for batch in batches:
            found = []
            for text in texts(batch):
                mine = [np.empty(0, np.int64)]
                for words, _, _ in _word_pieces(text or b"", size):
                    grams, anchor = _window_anchors(hashes.of(words), size)
                    mine.append(grams[anchor[np.concatenate(([True], np.diff(anchor) != 0))]])
                found.append(np.concatenate(mine))
            edge = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "k"), column(batch, "h"), pa.ListArray.from_arrays(pa.array(edge), pa.array(flat))],
                names=["k", "h", "grams"],
            )

    return rows


_WINDOWS = "window long, k long, h long, a int, b int"


def _window_rows(size: int):
    """The windows of `size` words of each text that are anchored at one of its `grams`, with their bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(_VOCABULARY)
        for batch in batches:
            lists = column(batch, "grams").to_pylist()
            for k, h, text, wanted in zip(column(batch, "k").to_pylist(), column(batch, "h").to_pylist(), texts(batch), lists):
                wanted = np.array(wanted, np.int64)
                for words, starts, ends in _word_pieces(text, size):
                    of = hashes.of(words)
                    grams, anchor = _window_anchors(of, size)
                    these = np.flatnonzero(np.isin(grams, wanted)[anchor])
                    if not len(these):
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(window_hashes(of, size).view(np.int64)[these]), pa.array(np.full(len(these), k, np.int64)),
                         pa.array(np.full(len(these), h, np.int64)), pa.array(starts[these].astype(np.int32)),
                         pa.array(ends[these + size - 1].astype(np.int32))],
                        names=["window", "k", "h", "a", "b"],
                    )

    return rows


_STRETCHES = "k long, h long, start int, core long, span long"


def _stretch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches around the repeated anchors of each text."""
    prefixes = Prefixes()
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        lists = column(batch, "anchors").to_pylist()
        for k, h, text, anchors in zip(column(batch, "k").to_pylist(), column(batch, "h").to_pylist(), texts(batch), lists):
            at, lo, hi = (np.array([a[name] for a in anchors], np.int64) for name in ("at", "lo", "hi"))
            first, last = (at - hi) // STRETCH, (at - lo) // STRETCH
            many = last - first + 1
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
            start = np.unique(np.repeat(at, many) - (nth + 1) * STRETCH + 1)
            core, span = _hashes(prefixes, text, start, STRETCH)
            for values, new in zip(out, ([k] * len(start), [h] * len(start), start, core, span)):
                values.append(np.asarray(new, np.int64))
        arrays = [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]
        yield pa.RecordBatch.from_arrays(
            [pa.array(arrays[0]), pa.array(arrays[1]), pa.array(arrays[2].astype(np.int32)), pa.array(arrays[3]), pa.array(arrays[4])],
            names=["k", "h", "start", "core", "span"],
        )


def _segments(start: np.ndarray) -> Iterator[tuple[slice, int]]:
    """Slices of the sorted `start` and where their bytes begin, so that memory does not grow with the text."""
    begin = 0
    while begin < len(start):
        base = max(0, int(start[begin]))
        end = int(np.searchsorted(start, base + SEGMENT))
        yield slice(begin, end), base
        begin = end


def _hashes(prefixes: Prefixes, text: bytes, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the cores and of the whole stretches that begin at `start` (possibly before the text)."""
    core, span = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
    reach = width - 1 + LENGTH
    for these, base in _segments(start):
        prefixes.load(np.frombuffer(text[base:base + SEGMENT + reach], np.uint8))
        mine = start[these]
        left, right = np.maximum(mine, 0), np.minimum(mine + reach, len(text))
        core[these] = prefixes.at(mine + width - 1 - base, mine + LENGTH - base).view(np.int64)
        clip = ((left - mine) << 32) | (mine + reach - right)
        whole = prefixes.at(left - base, right - base) + mix(clip.astype(np.uint64) + np.uint64(1))
        span[these] = mix(whole).view(np.int64)
    return core, span


def _strings(prefixes: Prefixes, text: bytes, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, lies inside the text) of the `width` strings of every stretch."""
    at = start[:, None] + np.arange(width)
    last = len(text) - LENGTH
    value = np.empty(at.shape, np.int64)
    for these, base in _segments(start):
        prefixes.load(np.frombuffer(text[base:base + SEGMENT + width - 1 + LENGTH], np.uint8))
        mine = np.clip(at[these], 0, last) - base
        value[these] = prefixes.at(mine, mine + LENGTH).view(np.int64)
    return value, (at >= 0) & (at <= last)


_FINE = "k long, h long, start int, core long, span long, strings array<long>"


def _fine_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fine stretches of the wanted stretches of each text, with the hashes of their strings (NULL: outside)."""
    prefixes = Prefixes()
    for batch in batches:
        out: list[list] = [[np.empty(0, np.int64)] for _ in range(5)]
        strings, inside = [np.empty((0, FINE), np.int64)], [np.empty((0, FINE), bool)]
        lists = column(batch, "wanted").to_pylist()
        for k, h, text, wanted in zip(column(batch, "k").to_pylist(), column(batch, "h").to_pylist(), texts(batch), lists):
            start = np.unique(np.array(wanted, np.int64)[:, None] + np.arange(0, STRETCH, FINE))
            start = start[(start + FINE > 0) & (start + LENGTH <= len(text))]
            core, span = _hashes(prefixes, text, start, FINE)
            for values, new in zip(out, (np.full(len(start), k), np.full(len(start), h), start, core, span)):
                values.append(np.asarray(new, np.int64))
            value, valid = _strings(prefixes, text, start, FINE)
            strings.append(value)
            inside.append(valid)
        k, h, start, core, span = (np.concatenate(x) for x in out)
        flat = pa.array(np.concatenate(strings).ravel(), mask=~np.concatenate(inside).ravel())
        edge = pa.array(np.arange(len(start) + 1, dtype=np.int32) * FINE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k), pa.array(h), pa.array(start.astype(np.int32)), pa.array(core), pa.array(span), pa.ListArray.from_arrays(edge, flat)],
            names=["k", "h", "start", "core", "span", "strings"],
        )


_MEMBERS = "bucket long, k long, h long, start int, bytes binary"


def _member_rows(buckets: int):
    """Bytes of the stretches that must be ranked; `start` is their first position inside the text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            lists = column(batch, "wanted").to_pylist()
            for k, h, text, wanted in zip(column(batch, "k").to_pylist(), column(batch, "h").to_pylist(), texts(batch), lists):
                for member in wanted:
                    left = max(member["start"], 0)
                    new = (member["core"] % buckets, k, h, left, text[left:member["start"] + STRETCH - 1 + LENGTH])
                    for values, value in zip(out, new):
                        values.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, kinds)], names=["bucket", "k", "h", "start", "bytes"]
            )

    return rows


def _ranks(data: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the suffixes at `start` by their first `length` (8 or more) bytes, by prefix doubling."""
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)]).astype(np.uint64)
    n = len(data)
    key = np.zeros(n + length, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i:i + n + length]
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
    size = 8
    while 2 * size <= length:
        rank = np.unique((rank[:len(rank) - size] << 32) | rank[size:], return_inverse=True)[1].astype(np.int64)
        size *= 2
    return np.unique((rank[start] << 32) | rank[start + length - size], return_inverse=True)[1]


def repeated_starts(members: list[bytes], places: list[int], length: int, previous: bool) -> list[np.ndarray]:
    """For each member the starts whose `length`-byte string occurs at another position.

    `places` are the members' positions in the whole input; members may overlap, a position counts once.
    With `previous`, only starts with an earlier occurrence: longest previous factor >= length.
    """
    sizes = np.array([len(m) for m in members])
    counts = np.maximum(sizes - length + 1, 0)
    offsets = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(members)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    position = np.array(places, np.int64)[owner] + inner
    rank = _ranks(np.frombuffer(b"".join(members), np.uint8), offsets[owner] + inner, length)
    order = np.lexsort((position, rank))  # suffix order; within a run of equal prefixes by position
    first = np.concatenate(([True], rank[order][1:] != rank[order][:-1]))
    run = np.cumsum(first) - 1
    begin = np.flatnonzero(first)
    end = np.concatenate((begin[1:], [len(order)])) - 1
    least, most = position[order[begin]][run], position[order[end]][run]
    flag = np.zeros(len(order), bool)
    flag[order] = position[order] > least if previous else least < most
    return np.split(inner[flag], np.cumsum(np.bincount(owner[flag], minlength=len(members)))[:-1])


def _bucket_spans(previous: bool):
    def spans(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("k", "ascending"), ("h", "ascending"), ("start", "ascending")])
        texts_at = list(zip(group["k"].to_pylist(), group["h"].to_pylist()))
        nth = {key: i for i, key in enumerate(dict.fromkeys(texts_at))}
        places = [(nth[key] << 32) + start for key, start in zip(texts_at, group["start"].to_pylist())]
        found = repeated_starts(group["bytes"].to_pylist(), places, LENGTH, previous)
        out: list[list] = [[], [], [], []]
        for k, h, start, inner in zip(group["k"].to_pylist(), group["h"].to_pylist(), group["start"].to_pylist(), found):
            if len(inner):
                cut = np.flatnonzero(np.diff(inner) > 1)
                firsts = inner[np.concatenate(([0], cut + 1))]
                lasts = inner[np.concatenate((cut, [len(inner) - 1]))]
                for a, b in zip(firsts.tolist(), lasts.tolist()):
                    for values, value in zip(out, (k, h, start + a, start + b + LENGTH)):
                        values.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.table([pa.array(v, t) for v, t in zip(out, kinds)], names=["k", "h", "a", "b"])

    return spans


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("k"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("h"),
        F.col("text").cast("string").alias("text"),
    )


_OWN = ("k", "h", "start")


def _distinct(stretches: DataFrame) -> DataFrame:
    """Every distinct stretch, how often it occurs and its first place."""
    return written(
        stretches.groupBy("core", "span").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct(*_OWN)).alias("first")), "distinct"
    )


def _twins(stretches: DataFrame, distinct: DataFrame, width: int, previous: bool) -> DataFrame:
    """Byte spans of stretches that are equal as a whole: all of their strings occur elsewhere."""
    copies = distinct.filter("c > 1").select(F.col("core").alias("c1"), F.col("span").alias("s1"), "first")
    twins = stretches.join(copies, (F.col("core") == F.col("c1")) & (F.col("span") == F.col("s1")))
    if previous:
        twins = twins.filter(F.struct(*_OWN) != F.col("first"))
    a, b = F.greatest("start", F.lit(0)), F.col("start") + F.lit(width - 1 + LENGTH)
    return twins.select("k", "h", a.cast("int").alias("a"), b.cast("int").alias("b"))


def _counted_spans(texts_of: DataFrame, hot: DataFrame, previous: bool) -> DataFrame:
    """Byte spans of repeated strings in the stretches `hot` of hot cores, without gathering a core.

    Equal strings lie in fine stretches with equal cores, as they do in stretches. A fine stretch alone with its
    core has no repeated string; of the others one of each kind gives its strings to the count.
    """
    wanted = hot.groupBy(F.col("k").alias("wk"), F.col("h").alias("wh")).agg(F.collect_set("start").alias("wanted"))
    met = texts_of.join(wanted, (F.col("k") == F.col("wk")) & (F.col("h") == F.col("wh")))
    fine = written(met.select("k", "h", "text", "wanted").mapInArrow(_fine_rows, _FINE), "fine")
    distinct = _distinct(fine)
    several = written(distinct.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core"), "several")
    firsts = distinct.join(several, "core", "left_semi").select(F.col("core").alias("c1"), F.col("first.*"))
    firsts = firsts.withColumnsRenamed({name: f"{name}1" for name in _OWN})
    same = (F.col("core") == F.col("c1")) & (F.col("k") == F.col("k1")) & (F.col("h") == F.col("h1")) & (F.col("start") == F.col("start1"))
    strings = (
        fine.join(firsts, same).select("core", "k", "h", "start", F.posexplode("strings").alias("nth", "string"))
        .filter("string IS NOT NULL")
        .select("core", "string", F.struct("k", "h", (F.col("start") + F.col("nth")).alias("start")).alias("at"))
    )
    strings = written(strings, "strings")
    again = written(
        strings.groupBy(F.col("core").alias("c1"), F.col("string").alias("s1"))
        .agg(F.min("at").alias("least"), F.max("at").alias("most")).filter("least < most").select("c1", "s1", "least"),
        "again",
    )
    repeated = strings.join(again, (F.col("core") == F.col("c1")) & (F.col("string") == F.col("s1")))
    if previous:
        repeated = repeated.filter("at > least")
    a = F.col("at.start")
    return _twins(fine, distinct, FINE, previous).union(
        repeated.select("at.k", "at.h", a.alias("a"), (a + LENGTH).cast("int").alias("b"))
    )


def _gram_lists(keyed: DataFrame, size: int) -> DataFrame:
    """The repeated anchor pieces of words of each text (gk, gh)."""
    grams = written(keyed.mapInArrow(_gram_rows(size), _GRAMS), "grams").select("k", "h", F.explode("grams").alias("gram"))
    again = written(
        grams.groupBy(F.col("gram").alias("g")).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("g"), "again"
    )
    lists = grams.join(again, F.col("gram") == F.col("g"), "left_semi").groupBy(F.col("k").alias("gk"), F.col("h").alias("gh"))
    return written(lists.agg(F.collect_set("gram").alias("grams")), "gram_lists")


def _window_spans(some: DataFrame, size: int, previous: bool) -> DataFrame:
    """Byte spans of repeated windows of `size` words."""
    windows = written(some.filter("grams IS NOT NULL").select("k", "h", "text", "grams").mapInArrow(_window_rows(size), _WINDOWS), "windows")
    at = F.struct("k", "h", "a")
    again = written(
        windows.groupBy(F.col("window").alias("w")).agg(F.min(at).alias("least"), F.max(at).alias("most"))
        .filter("least < most").select("w", "least"), "again",
    )
    repeated = windows.join(again, F.col("window") == F.col("w"))
    if previous:
        repeated = repeated.filter(at > F.col("least"))
    return repeated.select("k", "h", "a", "b")


def repeated_spans(docs: DataFrame, keep: str = "none", words: int = 0) -> tuple[DataFrame, DataFrame]:
    """(per row: doc_id, k, h, n_bytes, sha of the whole text), (k, h, spans array<struct<a,b>> in bytes)."""
    small_batches(docs.sparkSession)
    previous = keep == "first"
    keyed = _keyed(docs)
    first = written(keyed.mapInArrow(_first_rows, _FIRST), "anchors")
    anchors = first.select("k", "h", F.inline("anchors"))
    # Written, so that the join has two plain sides and a frequent piece can be split.
    repeated = written(
        anchors.groupBy(F.col("gram").alias("g")).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("g"), "repeated"
    )
    lists = (
        anchors.join(repeated, F.col("gram") == F.col("g"), "left_semi")
        .groupBy(F.col("k").alias("lk"), F.col("h").alias("lh")).agg(F.collect_set(F.struct("at", "lo", "hi")).alias("anchors"))
    )
    if words:
        same = (F.col("lk") == F.col("gk")) & (F.col("lh") == F.col("gh"))
        lists = lists.join(_gram_lists(keyed, words + 1), same, "full").select(
            F.coalesce("lk", "gk").alias("lk"), F.coalesce("lh", "gh").alias("lh"), "anchors", "grams"
        )
    met = keyed.join(lists, (F.col("k") == F.col("lk")) & (F.col("h") == F.col("lh")))
    some = written(met.select("k", "h", "text", *lists.columns[2:]), "candidates")
    release(docs.sparkSession)
    windows = [_window_spans(some, words + 1, previous)] if words else []
    anchored = some.filter("anchors IS NOT NULL").select("k", "h", "text", "anchors")
    stretches = written(anchored.mapInArrow(_stretch_rows, _STRETCHES), "stretches")

    distinct = _distinct(stretches)
    # Written, so that the join has two plain sides and a core with many stretches can be split.
    several = written(distinct.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "several")
    members = written(distinct.join(several, "core").select("core", "first.*", (F.col("n") > HOT).alias("hot")), "members")
    release(docs.sparkSession)
    texts_of = some.select("k", "h", "text").dropDuplicates(["k", "h"])
    hot, members = members.filter("hot"), members.filter("NOT hot")
    counted = [_counted_spans(texts_of, hot, previous)] if hot.limit(1).count() else []
    buckets = max(1, -(-members.count() // BUCKET))
    wanted = members.groupBy(F.col("k").alias("wk"), F.col("h").alias("wh")).agg(
        F.collect_list(F.struct("core", "start")).alias("wanted")
    )
    bytes_of = (
        texts_of.join(wanted, (F.col("k") == F.col("wk")) & (F.col("h") == F.col("wh")))
        .select("k", "h", "text", "wanted")
        .mapInArrow(_member_rows(buckets), _MEMBERS)
    )
    sorted_spans = bytes_of.groupBy("bucket").applyInArrow(_bucket_spans(previous), "k long, h long, a int, b int")

    spans = (
        reduce(DataFrame.union, [_twins(stretches, distinct, STRETCH, previous), sorted_spans, *counted, *windows])
        .groupBy("k", "h").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
        .select(F.col("k").alias("sk"), F.col("h").alias("sh"), "spans")
    )
    # Written, so that what moved to find the spans is dropped before texts move again.
    spans = written(spans, "spans")
    with_text = some.select("k", "h", "text").join(spans, (F.col("k") == F.col("sk")) & (F.col("h") == F.col("sh")))
    return first, with_text.select("k", "h", "text", "spans")


_REMOVED = "k long, h long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<a:int,b:int>>"
_SPAN = pa.struct([("a", pa.int32()), ("b", pa.int32())])


def _inner_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to whole characters."""
    out = []
    for a, b in spans:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if b > a:
            out.append((a, b))
    return out


def _removed_rows(characters: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans_of, shas, removed = [], [], [], []
            for text, spans in zip(texts(batch), column(batch, "spans").to_pylist()):
                text = text or b""
                merged = _merged([{"a": s["a"], "b": min(s["b"], len(text))} for s in spans])
                if characters:
                    merged = _inner_characters(text, merged)
                edges = [0, *[x for span in merged for x in span], len(text)]
                rest = b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])])
                counts.append(len(text) - len(rest))
                spans_of.append(len(merged))
                shas.append(hashlib.sha256(rest).hexdigest())
                removed.append([{"a": a, "b": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [column(batch, "k"), column(batch, "h"), pa.array(counts, pa.int64()), pa.array(spans_of, pa.int64()),
                 pa.array(shas, pa.string()), pa.array(removed, pa.list_(_SPAN))],
                names=["k", "h", "n_removed", "n_spans", "kept_sha256", "removed"],
            )

    return rows


def _on(left: DataFrame, k: str, h: str) -> Column:
    return (left["k"] == F.col(k)) & (left["h"] == F.col(h))


def remove_repeats(docs: DataFrame, keep: str = "none") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (byte spans) per row."""
    first, found = repeated_spans(docs, keep)
    done = found.mapInArrow(_removed_rows(False), _REMOVED).dropDuplicates(["k", "h"])
    done = written(done.withColumnsRenamed({"k": "rk", "h": "rh"}), "removed")
    return first.join(done, _on(first, "rk", "rh"), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "removed",
    )


def _rest(text: Column, removed: Column) -> Column:
    """`text` without its bytes in `removed`, which are sorted spans of whole characters."""
    none = F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))
    before, after = F.concat(none, removed), F.concat(F.transform(removed, lambda s: s["a"]), F.array(F.lit(None).cast("int")))

    def kept(data: Column) -> Column:
        piece = lambda s, end: F.substring(data, s["b"] + 1, F.coalesce(end, F.length(data)) - s["b"]).cast("string")
        return F.array_join(F.zip_with(before, after, piece), "")

    return bind(text.cast("binary"), kept)


def without_repeats(docs: DataFrame, words: int = 0) -> DataFrame:
    """`docs` with the later copies cut out of `text`, whole characters at a time; n_chars follows, other columns stay."""
    _, found = repeated_spans(docs, "first", words)
    cut = found.mapInArrow(_removed_rows(True), _REMOVED).filter("n_removed > 0").select(
        F.col("k").alias("__rk"), F.col("h").alias("__rh"), F.col("removed").alias("__removed")
    )
    # Only spans are written and joined; the texts of `docs` move once, and are cut where they lie.
    cut = written(cut.dropDuplicates(["__rk", "__rh"]), "cut")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    on = (F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col("__rk")) & (F.xxhash64(text) == F.col("__rh"))
    met = docs.join(cut, on, "left").withColumn("__rest", F.when(F.col("__removed").isNotNull(), _rest(text, F.col("__removed"))))
    new = {"text": F.coalesce("__rest", "text")}
    if "n_chars" in docs.columns:
        chars = F.length("__rest").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("__rest").isNotNull(), chars).otherwise(F.col("n_chars"))
    kept = [new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns]
    return met.select(*kept)
