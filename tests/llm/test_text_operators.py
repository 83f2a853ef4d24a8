"""Operators that judge one text at a time, against plain Python."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from arenalake.llm import language, licenses, quality, toxicity
from arenalake.llm.common import crc_mod

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _base(text):
    w = _WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if _WORD.search(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = {}
    for g in windows:
        count[g] = count.get(g, 0) + 1
    covered = {i + d for i, g in enumerate(windows) if count[g] > 1 for d in range(3)}
    signs = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), signs, len(lines) - len(set(lines)), len(covered)


def test_quality_counts(edge_docs):
    rows = quality.quality_rules(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    texts = {}
    for r in edge_docs.select("doc_id", "text").collect():
        texts[r.doc_id] = r.text
    for r in rows:
        n, chars, signs, dup, rep = _base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, signs, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert not (r.base_failed and r.kept)


def test_quality_fences_follow_the_source(spark, prose):
    """A source whose texts all carry signs keeps them; the same text is an outlier elsewhere."""
    odd = lambda i: " ".join(f"{w}***" for w in prose(i, 80).split())
    rows = [(i, prose(i, 80), "en", "plain") for i in range(200)] + [(1000 + i, odd(i), "en", "signs") for i in range(150)]
    rows += [(5000, odd(9), "en", "plain")]
    kept = {r.doc_id: r.kept for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not kept[5000] and all(kept[i] for i in range(200)) and all(kept[1000 + i] for i in range(150))


def test_quality_sketch_merges(spark):
    """Summed leaf sketches give the quantiles of all rows, off by one bucket at most."""
    rng = random.Random(1)
    values = [rng.randint(0, 5000) for _ in range(3000)]
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)], "g int, v long")
    leaves = df.withColumn("bucket", quality.bucket(F.col("v"))).groupBy("g", "bucket").agg(F.count("*").alias("c")).withColumn("rule", F.lit("r"))
    got = quality._quartiles(leaves, []).first()
    want = np.quantile(values, [0.25, 0.5, 0.75], method="inverted_cdf")
    assert all(abs(a - b) <= b / 32 + 1 for a, b in zip((got.q25, got.q50, got.q75), want))


def test_empty_tables(no_docs):
    assert quality.quality_rules(no_docs).count() == 0
    assert licenses.scan_licenses(no_docs).count() == 0
    assert language.identify(no_docs, language.train(no_docs)).count() == 0
    assert toxicity.score(no_docs, None).count() == 0


def test_license_places(spark):
    text = "Under the MIT-License; under the mit license. Apache License, Version 2.0 CC-BY-NC cc by nc é cc by-nc-sa 4"
    rows = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "under the mit licenses"), (5, "x " * 50_000 + "cc by nc")], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(rows).collect()}
    one = got[1]
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    places = [i for p in licenses.BASE_PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    assert (one.n_words, one.n_base, one.first_word, one.last_word) == (len(words), len(places), min(places), max(places))
    assert one.base_labels == "apache-2,cc-by-nc,mit" and set(one.base_labels.split(",")) <= set(one.labels.split(","))
    assert got[2].n_words == got[3].n_words == 0 and got[2].first_word is None and got[3].labels == "" and got[3].score == 0
    assert got[4].n_base == 0
    assert (got[5].n_words, got[5].first_word) == (50_003, 50_000)


def test_license_containment():
    """The long notice stays, the shorter name inside it is suppressed, one outside it is not."""
    text = (
        "gnu general public license as published by the free software foundation either version 2 of the license or "
        "at your option any later version and the gnu general public license"
    )
    labels = [r.label for _, _, r in licenses.Scanner().detections(text)]
    assert labels == ["gpl-2-or-later", "gpl"]
    assert len(licenses.rules()) > 300


def _alternatives(parsed):
    """Texts of all branches, options and character sets of a parsed pattern; wildcards stand for one letter."""
    found = [""]
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            more = [chr(value)]
        elif name == "IN":
            more = [chr(v) for o, v in value if str(o) == "LITERAL"]
        elif name == "BRANCH":
            more = [t for branch in value[1] for t in _alternatives(branch)]
        elif name == "SUBPATTERN":
            more = _alternatives(value[3])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, _, what = value
            more = ([""] if low == 0 else []) + _alternatives(what)
        elif name == "ANY":
            more = ["x"]
        else:
            assert name == "ASSERT_NOT", name
            more = [""]
        found = [a + b for a in found for b in more]
    return found


def test_license_gate_drops_no_match():
    """Gated and ungated scans agree on every alternative of every rule."""
    from re import _parser

    scanner, every = licenses.Scanner(), licenses.Scanner()
    every.candidates = lambda text: range(len(every.rules))
    for i, rule in enumerate(scanner.rules):
        for text in _alternatives(_parser.parse(rule.pattern)):
            assert re.search(rule.pattern, text) and i in scanner.candidates(text), (rule, text)
    for text in ("same terms as ruby", "under the ruby license", "end user licence agreement", "end user license agreement"):
        assert scanner.detections(text) == every.detections(text) != []


def test_language_spans(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.train(docs.filter(crc_mod(4) != 2))
    by = {r.lang: r.text for r in docs.filter("length(text) > 800").collect()}
    mixed = " ".join(by["en"].split()[:60] + by["de"].split()[:60])
    rows = spark.createDataFrame([(1, mixed), (2, None), (3, "12 34 ..."), (4, by["fr"])], "doc_id long, text string")
    got = {r.doc_id: r for r in language.identify(rows, model).collect()}
    assert [s.lang for s in got[1].spans] == ["en", "de"] and abs(got[1].spans[0].last - 59) <= 3
    assert (got[2].lang_pred, got[2].score) == ("und", 0.0) == (got[3].lang_pred, got[3].score)
    assert got[4].lang_pred == "fr" and 0 <= got[4].score <= 1


def test_language_training_moves_no_text(spark, sf_dir, monkeypatch, no_docs):
    """Counts alone are shuffled: the sampled rows reach the counting tasks straight from the scan."""
    plans = []
    frame = type(no_docs)
    inner = frame.mapInArrow

    def seen(self, *args, **kwargs):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return inner(self, *args, **kwargs)

    monkeypatch.setattr(frame, "mapInArrow", seen)
    model = language.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert model.langs and plans and "Exchange" not in plans[0]
    assert language.train(no_docs).langs == []


def test_language_scripts_narrow():
    """A word in a script only one language was seen in goes to it, whatever the grams say."""
    known = np.zeros((2, language.N_SCRIPTS), bool)
    known[0, 0] = known[1, 2] = True
    scorer = language.Scorer(language.Model(["en", "ru"], np.zeros((language.BUCKETS, 2), np.float32), known))
    scorer.learn({"слово".encode(), b"word", b"123"})
    best = {c: int(scorer.scores[i].argmax()) for c, i in scorer.index.items() if scorer.letters[i]}
    assert best == {"слово".encode(): 1, b"word": 0}


def test_viterbi_is_best_path():
    rng = np.random.default_rng(3)
    length = np.array([5, 1, 0, 7])
    first = np.cumsum(length) - length
    scores = rng.normal(size=(13, 3)) * 3
    labels = language.viterbi(scores, first, length, 2.0)
    value = lambda path, s: s[range(len(path)), path].sum() - 2.0 * sum(a != b for a, b in zip(path, path[1:]))
    for a, n in zip(first, length):
        s = scores[a:a + n]
        best = max((value(np.array(np.unravel_index(i, (3,) * n)), s) for i in range(3**n)), default=0) if n else 0
        assert np.isclose(value(labels[a:a + n], s) if n else 0, best)


def _learnt(spark, d):
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    machine = toxicity.train(docs.filter(crc_mod(3) != 1), labels.filter(crc_mod(3) != 1))
    return docs, labels, machine


@pytest.fixture(scope="module")
def toxic(spark):
    return _learnt(spark, "/root/testdata/sf0.01")


@pytest.mark.parametrize("size, least", [("0.01", 0.75), ("0.1", 0.9)])  # 33 and 305 toxic texts to learn from
def test_toxicity_held_out(spark, size, least):
    docs, labels, machine = _learnt(spark, f"/root/testdata/sf{size}")
    rows = toxicity.score(docs.filter(crc_mod(3) == 1), machine).join(labels, "doc_id").collect()
    hit = [r.score >= 0.7 for r in rows if r.toxic]
    false = [r.score >= 0.7 for r in rows if not r.toxic]
    assert sum(hit) >= least * len(hit) and sum(false) <= 0.02 * len(false)


def test_toxicity_noise_copies_and_alphabets(spark, prose):
    """Wrong labels, a group of copies of a toxic text and an insult in other letters."""
    insults = ["blokwart", "zupfkrug", "\u0434\u0443\u0440\u0430\u043a"]

    def text(seed, bad):
        ws = prose(seed, 90).split()
        for n in range(3 if bad else 0):
            ws[7 + 25 * n] = insults[(seed + n) % 3]
        return " ".join(ws)

    rows = [(i, text(1000 + i, i % 5 == 0), int(i % 5 == 0)) for i in range(600)]
    rows += [(i, text(9000, True), 1) for i in range(600, 680)]  # 80 copies
    wrong = [(i, t, 1 - y if i % 60 == 7 else y) for i, t, y in rows]  # ten clean texts marked as toxic
    wrong[11] = (11, rows[11][1] + " blokwart", 0)  # a clean text that quotes one
    docs = spark.createDataFrame(wrong, "doc_id long, text string, toxic int")
    machine = toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    new = [(i, text(50_000 + i, i % 2 == 0)) for i in range(100)]
    # Clean words of the copied text, and a text of nothing but one alphabet's insults.
    new += [(100, " ".join(w for w in text(9000, True).split() if w not in insults)), (102, f"{insults[2]} " * 3)]
    got = {r.doc_id: r.score >= 0.7 for r in toxicity.score(spark.createDataFrame(new, "doc_id long, text string"), machine).collect()}
    assert all(got[i] for i in range(0, 100, 2)) and got[102]
    assert not any(got[i] for i in range(1, 100, 2)) and not got[100]


def test_toxicity_evidence():
    full = toxicity.FLOOR + toxicity.FULL
    near = np.full(toxicity.WINDOW, -1.0)
    near[[3, 9]] = full + 5
    assert toxicity.evidence(near, -1.0) == 2 * toxicity.FULL
    far = np.full(4 * toxicity.WINDOW, -1.0)
    far[[0, -1]] = full
    assert np.isclose(toxicity.evidence(far, -1.0), toxicity.FULL)
    assert toxicity.evidence(np.empty(0), -1.0) == -1.0 - toxicity.FLOOR == toxicity.evidence(np.array([-1.0]), -1.0)


def test_toxicity_forms(spark, toxic, edge_docs):
    machine = toxic[2]
    value = lambda w: float(toxicity.word_values(machine.table, [toxicity.letters_of(w.encode())])[0])
    assert value("i-d-i-o-t") == value("idiot") == value("1diot") > value("idxiot") > value("thereof")
    assert toxicity.Scorer(machine.table, machine.bias).texts([b"an i d i o t here".split()])[0][1] == 1
    assert toxicity.score(edge_docs, machine).count() == edge_docs.count()


def test_kernel_is_inner_product():
    """The folded table gives the kernel with a landmark that direct enumeration gives."""
    from itertools import combinations

    def phi(word):
        out, size = {}, 0.0
        word = f"|{word}|"  # edges are characters
        for n in (3, 4):
            for c in combinations(range(len(word)), n):
                if c[-1] - c[0] < toxicity.SPAN:
                    w = toxicity.LAMBDA ** (c[-1] - c[0] + 1)
                    key = tuple(word[i] for i in c)
                    out[key] = out.get(key, 0) + w
                    size += w * w
        return {k: v / size**0.5 for k, v in out.items()}

    a, b = phi("banana"), phi("bandana")
    word, place, weight = toxicity._features(["banana"])
    table = np.zeros(toxicity.TABLE)
    np.add.at(table, place, weight)
    assert np.isclose(toxicity.word_values(table, ["bandana"])[0], sum(v * b.get(k, 0) for k, v in a.items()))


def test_hash_split(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").withColumn("m", crc_mod(7)).collect()
    assert all(r.m == zlib.crc32(str(r.doc_id).encode()) % 7 for r in rows)
