"""Spelling variants, lexical search and source mixing, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from arenalake.llm import lexical, mixing, spelling

SCHEMA = "doc_id long, text string"


# Spelling variants


def _words(rows, slips, least=5, count=3):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slips and h % slips == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= count}


def _one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def _variants(words):
    near = {w: [v for v in words if _one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, n, len(near[w]), form[w], form[w] and words[form[w]], root(w)) for w, n in words.items()}


def _got(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


@pytest.mark.parametrize("k", [None, 2, 24])
def test_variants(spark, k):
    rng = random.Random(4)
    letters = "abcdeéÿÀ÷"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(60)]
    words = []
    for w in base:
        words += [w] * rng.choice([3, 5, 12, 40])
        for _ in range(4):
            at = rng.randrange(len(w))
            v = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1:]])
            words += [v] * rng.choice([1, 3, 6, 24])
    rng.shuffle(words)
    rows = [(i, ", ".join(w.upper() if i % 3 else w for w in words[i::90])) for i in range(90)] + [(None, "abcde 1abcde2 ABCDE_abcdé")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert _got(spelling.variants(df, slips=7, k=k)) == _variants(_words(rows, 7))
    assert _got(spelling.variants(df, k=k)) == _variants(_words(rows, None))


def test_variants_of_one_reduced_word(spark):
    """All words share a reduced word, and one of them is a third of all occurrences."""
    letters, symbols = spelling.reduction(4)
    same = [c for c, s in zip(letters, symbols) if s == "a"][:6]
    rng = random.Random(3)
    words = {"".join(rng.choice(same) for _ in range(6)): 3 + i % 40 for i in range(150)}
    words[next(iter(words))] = 2000
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())]
    assert _got(spelling.variants(spark.createDataFrame(rows, SCHEMA), k=4)) == _variants(words)


def test_variants_edges(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert _got(spelling.variants(edge_docs, slips=97)) == _variants(_words(rows, 97))
    assert spelling.variants(no_docs).count() == 0
    long = "ab" * 20_000
    got = spelling.variants(spark.createDataFrame([(1, f"{long} {long} {long} {long}c {long}c {long}c")], SCHEMA))
    assert {(len(r.word), r.n_near, r.form) for r in got.collect()} == {(40_000, 1, None), (40_001, 1, None)}


def test_neighbour_hashes():
    k, rng = 4, np.random.default_rng(1)
    hashes = spelling.Neighbours(k)
    key = lambda s: int(hashes.own(np.array([s]))[0])
    with np.errstate(over="ignore"):
        for length in range(1, 7):
            w = rng.integers(0, k, length).tolist()
            want = {key(w)} | {key(w[:i] + w[i + 1:]) for i in range(length) if length > 1}
            want |= {key(w[:i] + [s] + w[i + 1:]) for i in range(length) for s in range(k)}
            want |= {key(w[:i] + [s] + w[i:]) for i in range(length + 1) for s in range(k)}
            got = set(hashes.around(np.array([w]))[0].tolist())
            assert want <= got and len(got - want) <= (length == 1)


# Lexical search


def _terms(text):
    return [t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def _search(rows, items, k=10):
    docs = [(i, Counter(t), len(t)) for i, t in ((i, _terms(text)) for i, text in rows) if t]
    if not docs:
        return []
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    found = []
    for item, text in items:
        scored = []
        for i, c, n in docs:
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(_terms(text)) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        found += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=str)


def _hits(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.mark.parametrize("shard, members", [(4096, 32), (50, 4), (1, 1)])
def test_search(spark, words, monkeypatch, shard, members):
    monkeypatch.setattr(lexical, "SHARD", shard)
    monkeypatch.setattr(lexical, "MEMBERS", members)
    rng = random.Random(9)
    common = words[:5]
    pick = lambda n: " ".join(rng.choice(common) if rng.random() < 0.4 else words[min(int(rng.expovariate(0.02)), 399)] for _ in range(n))
    items = [(i, pick(rng.randint(1, 30))) for i in range(20)] + [(3, pick(5)), (None, pick(4)), (50, "nowhere"), (51, None), (52, " ".join(common))]
    rows = [(i, pick(rng.randint(1, 120))) for i in range(400)]
    rows += [(1000 + i, pick(20) + " " + items[i % 20][1] + "!") for i in range(60)]
    rows += [(2000 + i, "same text of " + common[0]) for i in range(200)] + [(7, "same text")] * 30 + [(None, "same text"), (None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    asked = spark.createDataFrame([*items, (60, "Same TEXT")], "item_id long, text string")
    assert _hits(lexical.search(df, asked)) == _search(rows, [*items, (60, "Same TEXT")])
    assert _hits(lexical.search(df, asked, k=3, block=7)) == _search(rows, [*items, (60, "Same TEXT")], 3)


def test_search_edges(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    items = [(1, "two words ünï x"), (2, "日本語 one"), (3, "")]
    asked = spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, score string")
    assert _hits(lexical.search(edge_docs, asked)) == _search(rows, items)
    assert lexical.search(no_docs, asked).count() == 0 and lexical.search(edge_docs, asked.limit(0)).count() == 0


def test_blocks_are_skipped(spark, words):
    """Where a few documents match well, most documents are never scored."""
    rng = random.Random(2)
    wanted = " ".join(words[300:330])
    n = 3000
    texts = [" ".join(rng.choice(words[:300 + 5]) for _ in range(60)) for _ in range(n)]
    for i in range(12):
        texts[i * 7] += " " + wanted
    vocabulary = {t.encode(): i for i, t in enumerate(words)}
    counts = [Counter(vocabulary[w.encode()] for w in t.split()) for t in texts]
    flat = [(t, c) for x in counts for t, c in sorted(x.items())]
    q = np.arange(300, 330)
    task = lexical.Task(n, sum(len(t.split()) for t in texts), len(words), [q], [np.full(30, 5000.0)], [0], 10, False)
    shard = lexical.Shard(
        np.arange(n), np.array([len(t.split()) for t in texts]), np.array([len(c) for c in counts]),
        np.array([t for t, _ in flat]), np.array([c for _, c in flat]), task,
    )
    rows, _ = shard.best(q, np.full(30, 5000.0), 0, 10, False)
    assert set(rows.tolist()) <= {i * 7 for i in range(12)} and len(shard.lists) < 30


# Source mixing


def _mix(rows, weights=(3, 1, 2), share=1.5, most=2):
    """{source: (size, target)} by sharing again and again, and the rows' sizes."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = defaultdict(int)
    for _, text, source in rows:
        total[source] += size(text)
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, budget = {}, set(names), share * sum(total.values())
    while True:
        left = budget - sum(target.values())
        for_all = sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * left / for_all > most * total[s]}
        if not over:
            break
        target |= {s: most * total[s] for s in over}
        open_ -= over
    target |= {s: weight[s] * left / for_all for s in open_}
    return {s: (total[s], target[s]) for s in names}


def _held(got, rows, near):
    want = _mix(rows)
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert (r.source_size, r.target) == (want[r.source][0], pytest.approx(want[r.source][1]))
        assert r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) and r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
    for s, (_, target) in want.items():
        assert abs(taken[s] - target) <= near, (s, taken[s], target)


def test_mix(spark, prose):
    rng = random.Random(6)
    rows = [(i, prose(i, rng.choice([3, 40, 90, 200])), f"s{min(int(rng.expovariate(0.5)), 7)}" if i % 9 else None) for i in range(900)]
    rows += [(5, "one row again and again", "hot")] * 600 + [(6, None, "void"), (None, "", "void")]
    df = spark.createDataFrame(rows, SCHEMA + ", source string")
    got = mixing.mix(df, block=64).collect()
    _held(got, rows, 5)
    again = mixing.mix(df.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    other = mixing.mix(df, seed=1).collect()
    assert sorted(map(str, got)) != sorted(map(str, other))
    # Equal rows are sampled each for itself.
    hot = Counter(r.copies for r in got if r.source == "hot")
    assert len(hot) == 2 or _mix(rows)["hot"][1] % _mix(rows)["hot"][0] == 0
    mixed = mixing.mixed(df)
    assert mixed.columns == ["doc_id", "text", "source", "copy"]
    digest = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    want = Counter()
    for r in got:
        want[r.doc_id, r.digest, r.source] += r.copies
    assert Counter((r.doc_id, digest(r.text), r.source) for r in mixed.collect()) == +want


def test_mix_by_measure(spark, prose):
    """Documents are expected in proportion to their measure, up to two copies."""
    rows = [(i, prose(1, 20), "a", float(i % 4)) for i in range(400)] + [(1000 + i, prose(2, 20), "b", None if i % 4 == 0 else 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA + ", source string, weight double")
    counts = Counter()
    for seed in range(3):
        got = mixing.mix(df, measure="weight", seed=seed, weights=(1, 1), share=0.5).collect()
        for r in got:
            counts[(r.source, r.doc_id % 4)] += r.copies
            assert r.copies <= 2
        for s in "ab":
            part = [r for r in got if r.source == s]
            assert abs(sum(r.taken for r in part) - part[0].target) <= 20
    # 250 x 20 words: 125 copies for each source; a's go 0 : 1 : 2 : 3.
    assert counts["a", 0] == 0 and counts["b", 0] == 0
    for i in (1, 2, 3):
        assert abs(counts["a", i] / sum(counts["a", j] for j in range(4)) - i / 6) < 0.06


def test_mix_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text, r.source) for r in edge_docs.collect()]
    _held(mixing.mix(edge_docs).collect(), rows, 60_000)
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0
    assert set(edge_docs.columns) < set(mixing.mixed(edge_docs).columns)
