"""Best-fit packing of tokenized documents into sequences of a fixed length.

Hierarchical residual packing: groups of pieces are best-fit packed on their own; sequences that are
nearly full are emitted at once, the others travel as items to the next level, where the leftovers of
several groups are best-fit packed again, until one small group is left. After best fit at most one
sequence of a group is half empty or more, and only such a one can join another, so a group hands on
its least filled sequences (a fixed number) and emits the rest: every level, also the last, works on
a bounded number of items however many documents there are, and every piece is placed exactly once.

Defined cases: NULL text is empty; an empty text is its end token alone; documents longer than a
sequence are cut into full pieces and a rest; repeated rows are packed each for itself; an empty table
packs into nothing. The outcome does not depend on row order.
"""

from __future__ import annotations

import heapq
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.llm.common import docs_of, written
from arenalake.llm.words import column, small_batches, texts

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_MEMBER = pa.struct(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids_crc32", pa.int64()), ("offset", pa.int64())]
)
_BINS = (
    "part long, filled long, closed boolean, sequence_id long, "
    "members array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>>"
)
_BIN_SCHEMA = pa.schema(
    [("part", pa.int64()), ("filled", pa.int64()), ("closed", pa.bool_()), ("sequence_id", pa.int64()),
     ("members", pa.list_(_MEMBER))]
)
GROUP = 10_000  # pieces a first-level task packs
BLOCK = 1_000  # equal pieces that are dealt together
FAN_IN = 16  # groups whose leftovers meet
CARRY = 64  # least filled sequences a group hands on

_TAIL = b".,!?;:#*$%&|<>()[]{}\"/\\-_=+~^@`"


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """Token ids of blank-separated chunks as little-endian bytes, cached.

    Neither normalizer nor pre-tokenizer of the vocabulary looks across white space, so a text's ids
    are those of its chunks one after the other. Two generations bound the cache: words in use survive.
    """

    def __init__(self, path: str, most: int = 150_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings are ordinary text
        self.model, self.letters, self.most = self.whole.model, _byte_letters(), most
        self.old: dict[bytes, bytes] = {}
        outer = self

        class Young(dict):
            def __missing__(self, word: bytes) -> bytes:
                ids = outer.old.get(word)
                if ids is None:
                    ids = outer.chunk(word)
                if len(self) >= outer.most:
                    outer.old = dict(self)
                    self.clear()
                self[word] = ids
                return ids

        self.young = Young()

    def chunk(self, word: bytes) -> bytes:
        core = word.rstrip(_TAIL)
        # Punctuation after an ASCII letter is a token of its own, whatever it follows.
        if core and core != word and core[-1:].isalpha():
            return self.young[core] + self.young[word[len(core):]]
        text = word.decode("utf-8", "replace")
        if text.isalpha() and max(text) < "ɐ":
            text = unicodedata.normalize("NFC", text).lower()
            if text.isalpha():
                spelled = "".join([self.letters[b] for b in text.encode()])
                return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelled)])
        return b"".join([i.to_bytes(4, "little") for i in self.whole.encode(text, add_special_tokens=False).ids])

    def of(self, text: bytes | None) -> bytes:
        # ASCII lower-casing first: the normalizer does the same and the cache holds fewer words.
        return b"".join(map(self.young.__getitem__, (text or b"").lower().split()))


def _piece_rows(path: str | None, limit: int, end: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        words = WordIds(path or public_tokenizers.path("word_bpe_49k.json"))
        last = end.to_bytes(4, "little")
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(column(batch, "doc_id").to_pylist(), texts(batch)):
                ids = memoryview(words.of(text) + last)
                for piece, start in enumerate(range(0, len(ids) // 4, limit)):
                    part = ids[4 * start:4 * (start + limit)]
                    for values, value in zip(out, (doc_id, piece, start, len(part) // 4, zlib.crc32(part))):
                        values.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return rows


def pieces(docs: DataFrame, limit: int = 4096, end: int = 1, path: str | None = None) -> DataFrame:
    """Token counts and checksums of every document's pieces; ids themselves never leave the task."""
    small_batches(docs.sparkSession)
    return docs_of(docs).mapInArrow(_piece_rows(path, limit, end), _PIECE)


def best_fit(lengths: list[int], limit: int) -> list[list[int]]:
    """Indexes of the items of each bin: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    rooms: list[int] = []  # distinct residuals in order
    waiting: dict[int, list[int]] = {}  # residual -> heap of bins
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(rooms, lengths[i])
        if at == len(rooms):
            target, room = len(bins), limit
            bins.append([])
        else:
            room = rooms[at]
            target = heapq.heappop(waiting[room])
            if not waiting[room]:
                del waiting[room], rooms[at]
        bins[target].append(i)
        left = room - lengths[i]
        if left:
            if left not in waiting:
                insort(rooms, left)
                waiting[left] = []
            heapq.heappush(waiting[left], target)
    return bins


def _packer(level: int, limit: int, last: bool):
    """One group's items (rows of `part, filled, members`) into sequences."""

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        part = key[0].as_py()
        items = sorted(
            zip(group.column("filled").to_pylist(), group.column("members").to_pylist()),
            key=lambda x: (-x[0], [(m["doc_id"] is None, m["doc_id"] or 0, m["piece"], m["ids_crc32"]) for m in x[1]]),
        )
        bins = best_fit([length for length, _ in items], limit)
        fills = [sum(items[i][0] for i in b) for b in bins]
        # Nearly full ones are done; of the others only the least filled may still join another.
        open_bins = [] if last else heapq.nsmallest(
            CARRY, (n for n in range(len(bins)) if fills[n] < limit - limit // 128), key=lambda n: (fills[n], n)
        )
        waiting = set(open_bins)
        out = {name: [] for name in _BIN_SCHEMA.names}
        for n, chosen in enumerate(bins):
            at, members = 0, []
            for i in chosen:
                for member in items[i][1]:
                    members.append({**member, "offset": at})
                    at += member["length"]
            out["part"].append(part // FAN_IN)
            out["filled"].append(fills[n])
            out["closed"].append(n not in waiting)
            out["sequence_id"].append((level << 58) | (part << 24) | n)
            out["members"].append(members)
        return pa.table(out, schema=_BIN_SCHEMA)

    return pack


def _dealt(cut: DataFrame, groups: int) -> DataFrame:
    """Items of the first level. Equal pieces are dealt in blocks, so that no group grows with their number."""
    numbered = cut.withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) DIV {BLOCK}"))))
    few, many = numbered.filter(f"n <= {BLOCK}"), numbered.filter(f"n > {BLOCK}")
    spread = few.union(many.repartition("doc_id", "piece", "ids_crc32", "block"))
    rows = spread.select("*", F.explode(F.sequence(F.lit(1), F.expr(f"least({BLOCK}, n - block * {BLOCK})"))))
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"))
    return rows.select(
        F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "block"), F.lit(groups)).alias("part"),
        F.col("length").alias("filled"),
        F.array(member).alias("members"),
    )


def pack(docs: DataFrame, limit: int = 4096, end: int = 1, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    found = pieces(docs, limit, end, path).groupBy("doc_id", "piece", "start", "length", "ids_crc32")
    cut = written(found.agg(F.count(F.lit(1)).alias("n")), "pieces")
    groups = max(1, -(-(cut.agg(F.sum("n")).first()[0] or 0) // GROUP))
    waiting = _dealt(cut, groups)
    level, done = 1, None
    while True:
        packed = written(waiting.groupBy("part").applyInArrow(_packer(level, limit, groups == 1), _BINS), "bins")
        closed = packed.filter("closed").select("sequence_id", F.inline("members"))
        done = closed if done is None else done.union(closed)
        if groups == 1:
            return done.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
        waiting = packed.filter("NOT closed").select("part", "filled", "members")
        level, groups = level + 1, -(-groups // FAN_IN)
