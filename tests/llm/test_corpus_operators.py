"""Operators that compare texts with each other, against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from arenalake.llm import decontaminate, graph, language_model, ngram_join, suffix_dedup
from arenalake.llm.ngram_join import Similarity
from arenalake.llm.words import lower_words


def _classes(rows, sim):
    """{doc_id: (shingles, smallest reachable doc_id)} by comparing all pairs."""
    sets = {}
    for i, text in rows:
        w = lower_words(text)
        k = sim.k
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and sim.den * both >= sim.num * (len(sets[a]) + len(sets[b]) - both):
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("sim", [Similarity(3, 90, 100), Similarity(5, 80, 100)])
def test_jaccard_classes(spark, prose, sim):
    rng = random.Random(11)
    rows = [(1, None), (2, ""), (3, "  "), (4, "one"), (5, "ONE"), (6, "two words")]
    # Every small size, and larger ones, each with copies that lose, gain or change a few words.
    for n in [*range(3, 45), 80, 150, 400]:
        base = prose(n, n).split()
        for edits in (0, 0, 1, 1, 2, 4):
            w = base.copy()
            for _ in range(edits):
                at = rng.randrange(len(w))
                w[at:at + 1] = rng.choice([[], ["new", w[at]], [f"x{rng.randrange(9)}"]])
            rows.append((len(rows) + 1, " ".join(w)))
    rng.shuffle(rows)
    got = ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), sim).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _classes(rows, sim)


def test_jaccard_large_group(spark, prose):
    """A chain of near copies: only neighbours link, all are one class."""
    base = prose(77, 200).split()
    rows = []
    for i in range(120):
        w = base.copy()
        for j in range(i):
            w[j] = f"y{j}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, prose(5, 90)) for i in range(150)]
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {i: c for i, (_, c) in _classes(rows[:120], Similarity()).items()}
    assert {i: got[i] for i in want} == want and {got[1000 + i] for i in range(150)} == {1000}


def test_jaccard_edges(edge_docs, no_docs):
    got = ngram_join.jaccard_classes(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by = {r.doc_id: r.component_id for r in got}
    assert by[1] == 1 and by[2] == 2 and by[3] == 3 and by[5] == 4 and by[6] == 6 and by[9] == by[10] == 8 and by[13] == 12
    assert ngram_join.jaccard_classes(no_docs).count() == 0


def test_light_subsets_are_exact():
    """Two small sets share a key exactly if they are similar enough."""
    sim, rng = Similarity(), random.Random(2)
    for _ in range(300):
        n = rng.randint(1, sim.light_limit)
        a = {rng.randrange(1 << 62) for _ in range(n)}
        b = set(rng.sample(sorted(a), max(1, n - rng.randint(0, 3)))) | {rng.randrange(1 << 62) for _ in range(rng.randint(0, 2))}
        if len(b) > sim.light_limit:
            continue
        keys = lambda s: set(ngram_join._light_keys(np.array(sorted(s), np.uint64), list(sim.partners(len(s))), sim).tolist())
        small, large = sorted((a, b), key=len)
        both = len(a & b)
        linked = sim.den * both >= sim.num * (len(a) + len(b) - both)
        pick = lambda s, other: set(ngram_join._light_keys(np.array(sorted(s), np.uint64), [other], sim).tolist())
        fits = len(large) in sim.partners(len(small)) and len(small) in sim.partners(len(large))
        assert linked == bool(fits and pick(small, len(large)) & pick(large, len(small)))
        assert keys(a)


def test_wide_sketches_rule_out_large_sets(spark):
    """Sketches of any two sizes never overstate a difference, and unlike large sets do not reach the exact check."""
    rng = np.random.default_rng(3)
    elements = rng.integers(1, 1 << 63, 6000, np.uint64)
    sim = ngram_join.Similarity(num=80)
    sets = [np.sort(x) for x in (elements[:2000], elements[100:2100], elements[:2500], elements[4000:6000], elements[:40], elements[:41])]
    cells = [(i, len(s), [int(x) for x in s.view(np.int64)], [int(x) for x in ngram_join._wide_sketch(s)]) for i, s in enumerate(sets)]
    items = spark.createDataFrame(cells, "doc_id long, size long, items array<long>, wide array<long>").cache()
    pairs = [(a, b) for a in range(6) for b in range(a) if sim.num * max(len(sets[a]), len(sets[b])) <= sim.den * min(len(sets[a]), len(sets[b]))]
    asked = spark.createDataFrame(pairs, "a long, b long")
    end = lambda e: items.select(F.col("doc_id").alias(e), F.col("wide").alias(f"wide_{e}"))
    found = asked.join(end("a"), "a").join(end("b"), "b").withColumn("apart", ngram_join._apart("wide_a", "wide_b"))
    apart = {(r.a, r.b): r.apart for r in found.collect()}
    for a, b in pairs:
        assert apart[a, b] <= len(np.setxor1d(sets[a], sets[b]))
    # The short sketch cannot tell these from linked sets.
    assert np.bitwise_count(ngram_join._odd_sketch(sets[3]) ^ ngram_join._odd_sketch(sets[0])).sum() * 180 <= 4000 * 20
    assert apart[3, 0] * 180 > 4000 * 20
    similar = {(r.a, r.b) for r in ngram_join._verified(asked, items, sim).collect()}
    assert similar == {(a, b) for a, b in pairs if len(np.intersect1d(sets[a], sets[b])) * 180 >= 80 * (len(sets[a]) + len(sets[b]))}
    assert (1, 0) in similar and (2, 0) in similar and (3, 0) not in similar


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7), (100, 101)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _repeats(texts, first):
    data = [(t or "").encode() for t in texts]
    n = suffix_dedup.LENGTH
    seen, where = Counter(), {}
    for i, b in enumerate(data):
        for p in range(len(b) - n + 1):
            seen[b[p:p + n]] += 1
            where.setdefault(b[p:p + n], (i, p))
    out = []
    for i, b in enumerate(data):
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            s = b[p:p + n]
            if where[s] != (i, p) if first else seen[s] > 1:
                gone[p:p + n] = b"\1" * n
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone)), hashlib.sha256(rest).hexdigest()))
    return out


@pytest.fixture(scope="module")
def passages(prose):
    """Passages of 398 to 402 bytes and longer ones in new surroundings, runs of one letter, umlauts, copies."""
    shared, umlauts = prose(900, 400), "äöü ßé " * 120
    texts = [None, "", "short", "z" * 1000, "y" * 399, "y" * 400, "y" * 401, umlauts, f"x{umlauts}", prose(901, 90), prose(901, 90)]
    for i, n in enumerate((398, 399, 400, 401, 402, 700, 1500, 463, 464, 465)):
        texts.append(f"{prose(910 + i, 30)}#{shared[100:100 + n]}#{prose(930 + i, 60)}")
        texts.append(f"{shared[100:100 + n]}#{prose(950 + i, 20)}")
    texts.append(shared[100:600] + prose(970, 20) + shared[300:900] + prose(971, 40) + shared[100:600])
    return texts


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
@pytest.mark.parametrize("keep", ["none", "first"])
def test_suffix_repeats(spark, monkeypatch, passages, keep, hot):
    """Ranked in buckets, and with every core settled by counts."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    df = spark.createDataFrame(list(enumerate(passages)), "doc_id long, text string")
    got = suffix_dedup.remove_repeats(df, keep).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == _repeats(passages, keep == "first")


@pytest.mark.parametrize("keep", ["none", "first"])
def test_suffix_hot_core(spark, monkeypatch, prose, keep):
    """A passage in a third of all rows, each time in other surroundings: no bucket takes more than a cold core."""
    monkeypatch.setattr(suffix_dedup, "HOT", 20)
    most, rank = [], suffix_dedup._bucket_spans

    def watched(previous):
        ranked = rank(previous)

        def spans(key, group):
            assert group.num_rows <= 40
            return ranked(key, group)

        most.append(previous)
        return spans

    monkeypatch.setattr(suffix_dedup, "_bucket_spans", watched)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 1)
    passage, few = prose(990, 120)[:431], prose(991, 120)[:450]
    texts = [f"{prose(1000 + i, 15)} {passage}{prose(1200 + i, 15)}" if i % 3 == 0 else prose(1400 + i, 60) for i in range(180)]
    texts += [f"{prose(1700 + i, 9)}-{few}-{prose(1710 + i, 9)}" for i in range(3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = suffix_dedup.remove_repeats(df, keep).orderBy("doc_id").collect()
    assert most == [keep == "first"]
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == _repeats(texts, keep == "first")


def test_suffix_cut_texts(spark, passages, edge_docs, no_docs):
    df = spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(passages)], "doc_id long, text string, n_chars int")
    rows = {r.doc_id: r for r in suffix_dedup.without_repeats(df).collect()}
    assert len(rows) == len(passages) and all("�" not in (r.text or "") for r in rows.values())
    assert rows[10].text == "" and rows[10].n_chars == 0 and rows[9].text == passages[9]
    out = suffix_dedup.without_repeats(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    assert suffix_dedup.remove_repeats(no_docs).count() == 0 and suffix_dedup.without_repeats(no_docs).count() == 0


def _without_later(texts, size):
    """Texts without what a 400-byte string or a window of `size` words found before covers, whole characters only."""
    data, n, strings, windows, out = [t.encode() for t in texts], suffix_dedup.LENGTH, set(), set(), []
    for b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if b[p:p + n] in strings:
                gone[p:p + n] = b"\1" * n
            strings.add(b[p:p + n])
        words = list(re.finditer(rb"[^\x20\x09-\x0D]+", b))
        for i in range(len(words) - size + 1):
            window, a, z = tuple(m[0] for m in words[i:i + size]), words[i].start(), words[i + size - 1].end()
            if window in windows:
                gone[a:z] = b"\1" * (z - a)
            windows.add(window)
        at, rest = 0, ""
        for c in b.decode():
            size_of = len(c.encode())
            rest += "" if all(gone[at:at + size_of]) else c
            at += size_of
        out.append(rest)
    return out


@pytest.mark.parametrize("segment", [suffix_dedup.SEGMENT, 700])
def test_suffix_passages_of_words(spark, monkeypatch, prose, segment):
    """Passages of over 50 words are cut although they have fewer than 400 bytes, in pieces of a text too."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeéö") for _ in range(rng.randint(1, 6)))
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 52, 60, 51)]
    assert all(len(" ".join(p).encode()) < 400 for p in passages)
    texts = []
    for i in range(12):
        own = [prose(2000 + 10 * i + j, 40 + 7 * i) for j in range(7)]
        texts.append("".join(f"{o} {(' ', '  ', chr(10))[i % 3].join(p)} " for o, p in zip(own, passages)) + own[6])
    texts += [prose(2200, 300), f"{prose(2200, 300)} more", "ö " * 120, "one two", "", texts[3] + " " + texts[3]]
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = [r.text for r in suffix_dedup.without_repeats(df, 50).orderBy("doc_id").collect()]
    assert got == _without_later(texts, 51)
    kept = " ".join(" ".join(got).split())
    assert [kept.count(" ".join(p)) for p in passages] == [12, 12, 1, 1, 1, 1]
    plain = " ".join(suffix_dedup.without_repeats(df).orderBy("doc_id").collect()[1].text.split())
    assert all(" ".join(p) in plain for p in passages)


def test_suffix_passage_in_a_third(spark, prose):
    """One passage of words in a third of all rows, and rows alike or without an id."""
    passage = "ab cd " * 20 + " ".join(f"w{i}" for i in range(20))
    texts = [f"{prose(3000 + i, 30)} {passage} {prose(3200 + i, 30)}" if i % 3 == 0 else prose(3400 + i, 60) for i in range(90)]
    df = spark.createDataFrame([*enumerate(texts), (0, texts[0]), (None, texts[3] + " end")], "doc_id long, text string")
    rows = suffix_dedup.without_repeats(df, 50).collect()
    holding = [r.doc_id for r in rows if passage in r.text]
    assert len(rows) == 92 and holding == [None]


def test_pipeline_cuts_passages_of_words(spark, prose, sf_dir):
    passage = " ".join(f"p{i}" for i in range(51))
    rows = [(i, f"{prose(4000 + i, 90)} {passage} {prose(4100 + i, 90)}", "en", "s") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, docs, sf_dir).collect()}
    assert out == {0: rows[0][1], **{i: t.replace(passage, "") for i, t, *_ in rows[1:]}}


def test_suffix_texts_move_once(spark, passages, capsys):
    """What is returned joins texts with spans that are already written: one exchange a side, no Python step."""
    df = spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(passages)], "doc_id long, text string, n_chars int")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(name, None) for name in names]
    try:
        for name in names:
            spark.conf.set(name, "-1")
        capsys.readouterr()
        suffix_dedup.without_repeats(df, 50).explain()
    finally:
        for name, value in zip(names, before):
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    plan = capsys.readouterr().out
    assert plan.count("Exchange ") == 2 and "InArrow" not in plan


def test_suffix_rest(spark):
    """Spans at the edges, between and around letters of several bytes, none and everything."""
    text = "äbcdé日本 z"
    spans = [[], [(0, 2)], [(13, 15)], [(2, 3), (4, 7)], [(0, 15)], [(0, 3), (7, 13)]]
    df = spark.createDataFrame([(i, text, s) for i, s in enumerate(spans)], "i int, text string, s array<struct<a:int,b:int>>")
    got = [r.rest for r in df.orderBy("i").select(suffix_dedup._rest(df["text"], df["s"]).alias("rest")).collect()]
    data, want = text.encode(), []
    for s in spans:
        edges = [0, *[x for span in s for x in span], len(data)]
        want.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])).decode())
    assert len(data) == 15 and got == want


def test_suffix_long_text(spark, prose):
    """Segments of a long text meet without a seam, and repeats lie across their borders."""
    body = prose(5, 220_000)
    cut = suffix_dedup.SEGMENT - 250
    rows = [(1, body), (2, prose(6, 50) + body[cut:cut + 500] + prose(7, 50))]
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_removed, got[2].n_removed) == (500, 500) and got[1].removed[0].a == cut


def test_leaks(spark, prose):
    items = [(i, prose(300 + i, n)) for i, n in enumerate((3, 6, 12, 13, 16, 40, 59))] + [(8, None), (9, "")]
    rng = random.Random(4)
    docs, want = [(0, None), (1, ""), (2, prose(1, 500))], set()
    for i, text in items[1:7]:
        docs.append((10 + i, f"{prose(60 + i, 40)} {text.upper()}. {prose(80 + i, 50)}"))
        want.add((10 + i, i))
        w = text.split()
        if len(w) >= 16:
            for at in range(6, len(w), 12):
                w[at] = f"sub{rng.randrange(99)}"
            docs.append((20 + i, f"{prose(70 + i, 40)} {' '.join(w)}"))
            want.add((20 + i, i))
    docs += [(50, " ".join(items[6][1].split()[20:50])), (51, " ".join(reversed(items[6][1].split())))]
    want.add((50, 6))
    schema = "doc_id long, text string"
    d, b = spark.createDataFrame(docs, schema), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(d, b).collect()}
    assert set(got) == want
    assert (got[(16, 6)].first_word, got[(16, 6)].last_word, got[(16, 6)].matched) == (40, 98, 59)
    kept = {r.doc_id for r in decontaminate.decontaminated(d, b).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want}


def test_leaks_edges(spark, edge_docs, no_docs, sf_dir):
    b = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert decontaminate.leaks(edge_docs, b).count() == 0
    assert decontaminate.decontaminated(edge_docs, b).count() == edge_docs.count()
    assert decontaminate.leaks(no_docs, b).count() == 0 == decontaminate.leaks(edge_docs, b.limit(0)).count()


def _leaked(hits):
    """Whether the best stretch (matches minus twice the substitutions) of these places matches enough."""
    score = count = best = matched = 0
    for hit in hits:
        if score <= 0:
            score = count = 0
        score, count = score + (1 if hit else -2), count + hit
        if score > best:
            best, matched = score, count
    return matched >= min(decontaminate.MATCHED, math.ceil(len(hits) * 0.75))


def _without(n, gone):
    return [i not in gone for i in range(n)]


def test_leak_seeds_cover_every_accepted_overlap():
    for n in range(5, 22):
        masks = (decontaminate.SHORTEST,) if n == decontaminate.SHORT else decontaminate.MASKS
        for hits in (_without(n, gone) for many in range(8 if n < 19 else 6) for gone in combinations(range(n), many)):
            if _leaked(hits):
                assert any(
                    all(hits[at + i] for i, c in enumerate(mask) if c == "1")
                    for mask in masks for at in range(n - len(mask) + 1)
                ), hits


def test_leaks_with_substitutions(spark, prose):
    """All overlaps with one to three substitutions against brute force."""
    items = [(n, " ".join(f"i{n}x{j}" for j in range(n))) for n in (5, 6, 8, 12, 13, 14, 16, 20)]
    docs, want = [], set()
    for n, text in items:
        patterns = [g for many in (1, 2, 3) for g in combinations(range(n), many)]
        for gone in random.Random(n).sample(patterns, min(len(patterns), 150)):
            w = [f"sub{j}" if j in gone else x for j, x in enumerate(text.split())]
            docs.append((len(docs), f"{prose(len(docs), 6)} {' '.join(w)} {prose(n, 5)}"))
            if _leaked(_without(n, gone)):
                want.add((len(docs) - 1, n))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b).collect()} == want


def test_leaks_null_items_and_blankless_scripts(spark, prose):
    other = prose(41, 20)
    items = [(None, prose(40, 20)), (None, other), (7, "昨日駅前の新しい図書館で古い地図を見つけた"), (8, prose(42, 20)), (8, prose(43, 20))]
    docs = [
        (1, f"{prose(1, 9)} {items[0][1]}"), (2, f"{other} {prose(2, 9)}"), (3, "では始めに昨日駅前の新しい博物館で古い地図を見つけたと言う"),
        (4, items[3][1]), (5, items[4][1]), (6, "昨日は雨だった"),
    ]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b).collect()} == {(1, None), (2, None), (3, 7), (4, 8), (5, 8)}


def test_leaks_judge_rows(spark, prose):
    """Rows that share an id, or have none, are judged each for itself."""
    item = prose(50, 30)
    docs = [(i, t) for i in (None, 1) for t in (f"{prose(1, 9)} {item}", prose(2, 60), prose(3, 60))]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.item_id) for r in decontaminate.leaks(d, b).collect()) == [(0, 1), (1, 1)]
    key = lambda rows: sorted((i or 0, t) for i, t in rows)
    assert key(map(tuple, decontaminate.decontaminated(d, b).collect())) == key(r for r in docs if item not in r[1])


def test_language_model(spark, edge_docs, no_docs, prose):
    train = [(i, prose(i, 40 + i)) for i in range(30)] + [(90, None), (91, ""), (92, "The THE the")]
    schema = "doc_id long, text string"
    model = language_model.train(spark.createDataFrame(train, schema))
    tokens = {i: [*lower_words(t), b"\n"] for i, t in train}
    c, pairs = Counter(), Counter()
    for t in tokens.values():
        c.update(t)
        pairs.update(zip([b"\n\n", *t[:-1]], t))
    types, context = Counter(w for _, w in pairs), defaultdict(lambda: [0, 0, 0, 0])
    for (v, _), n in pairs.items():
        context[v][0] += n
        context[v][min(n, 3)] += 1
    tally = lambda counts: [sum(n == k for n in counts.values()) for k in (1, 2, 3, 4)]
    d, e = language_model.discounts(*tally(pairs)), language_model.discounts(*tally(types))
    rest = sum(e[min(n, 3) - 1] for n in types.values()) / len(pairs)
    low = lambda w: (types[w] - (e[min(types[w], 3) - 1] if w in types else 0)) / len(pairs) + rest / (len(c) + 1)

    def p(v, w):
        if v not in context:
            return low(w)
        x, n = context[v], pairs[(v, w)]
        return (n - (d[min(n, 3) - 1] if n else 0)) / x[0] + (d @ x[1:]) / x[0] * low(w)

    assert np.isclose(sum(p(b"the", w) for w in c) + p(b"the", b"unseen"), 1)
    asked = train + [(200, prose(999, 50) + " unseen"), (201, "unseen unseen")]
    total = sum(c.values())
    for r in language_model.score(spark.createDataFrame(asked, schema), model).collect():
        t = [*lower_words(dict(asked)[r.doc_id]), b"\n"]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in c for w in t), total)
        assert np.isclose(r.base_score, sum(math.log10((c[w] + 1) / (total + len(c) + 1)) for w in t))
        assert np.isclose(r.score, sum(math.log10(p(v, w)) for v, w in zip([b"\n\n", *t[:-1]], t)))
    assert language_model.score(edge_docs, model).count() == edge_docs.count()
    empty = language_model.score(edge_docs, language_model.train(no_docs)).first()
    assert (empty.train_tokens, empty.base_score, empty.score) == (0, 0.0, 0.0)
