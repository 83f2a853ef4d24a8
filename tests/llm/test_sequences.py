"""Chat windows, packing, and the pipeline."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from arenalake.llm import chat, packing
from arenalake.llm.quality import quality_rules
from test_corpus_operators import _classes


def _want(turns):
    text = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(8)
    parts = ["\\", "<|im_end|>", "<|", "</s>", "[INST]", "[/INST]", "\n", "<<SYS>>", "$1", "é", "\U0001f600", "<s>", "word ", "<|im_start|>user\n"]
    text = lambda: rng.choice([None, "", "".join(rng.choice(parts) for _ in range(rng.randint(1, 60))), "long " * rng.randint(1, 3000)])
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 25)):
            role = "system" if turn == 0 and rng.random() < 0.5 else rng.choice(["user", "assistant", "assistant", None, "a\nb\\", "system"])
            rows.append((conv, turn, role, text(), "x", "y"))
    rows += [(500, 0, "assistant", "tie", "x", "y")] * 3 + [(501, None, "assistant", "no turn", "x", "y"), (501, 2, "user", None, "x", "y")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string, n string"), rows


def test_chat_round_trip(talks):
    df, rows = talks
    got = {r.conv_id: r for r in chat.read_back(chat.windows(df)).collect()}
    by = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in sorted(rows, key=key):
        by.setdefault(r[0], []).append((r[2], r[3]))
    assert set(got) == set(by)
    for conv, turns in by.items():
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == _want(turns)


def test_chat_windows(spark):
    """Budget, system turn, limited history and masks of one long conversation."""
    size = 400
    rows = [(1, 0, "system", "s" * 100)] + [(1, t, "user" if t % 2 else "assistant", str(t % 10) * size) for t in range(1, 41)]
    w = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=2048, history=2).orderBy("window").collect()
    assert len(w) > 3
    for n, r in enumerate(w):
        assert len(r.text) / 4 <= 2048 * 1.1 and r.text.startswith("<|im_start|>system\nsss")
        assert r.n_repeated == (3 if n else 0)  # the system turn and two turns of history
        assert all(len(set(r.text[s.start:s.end])) == 1 and s.end - s.start == size for s in r.loss_spans)
    assert sum(len(r.loss_spans) for r in w) == 20


def test_chat_escapes_all_control(spark):
    texts = [(1, 0, "user", c + c[1:] + "\\" + c) for c in chat.CONTROL]
    for row in chat.windows(spark.createDataFrame(texts, "conv_id long, turn long, role string, text string")).collect():
        inner = row.text.replace(chat.START, "").replace(chat.END, "")
        assert not any(c in inner for c in chat.CONTROL)


def test_chat_empty(talks):
    assert chat.read_back(chat.windows(talks[0].limit(0))).count() == 0


def _ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_token_ids():
    import public_tokenizers

    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"), most=3)
    for x in ["it's o'clock I'LL don't 'tis", "ΟΔΥΣΣΕΥΣ. ΣΑΣ", "a b c", "é. é? İstanbul ǅ ß", "<|endoftext|> x!y", "日本語 テスト。", "1234 a1b2 ab.", "\x1c\x1f z \x85", "ﬁne Ⅷ a̸=", "", "THE the The. The!!"]:
        assert words.of(x.encode()) == _ids(x)[:-1].tobytes()


def test_packing(edge_docs, no_docs):
    rows = packing.pack(edge_docs).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = []
    for r in edge_docs.collect():
        ids = _ids(r.text)
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start:start + 4096]
            want.append((r.doc_id is None, r.doc_id or 0, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert got == sorted(want)
    _check_bins(rows)
    assert packing.pack(no_docs).count() == 0


def _check_bins(rows):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 4096
    return len(bins)


def test_packing_levels(spark, words, monkeypatch):
    """Several levels still place everything, close to the least number of sequences."""
    monkeypatch.setattr(packing, "GROUP", 40)
    monkeypatch.setattr(packing, "FAN_IN", 3)
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([20, 200, 900, 1500])))) for i in range(400)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows) and {r.doc_id for r in rows} == set(range(400))
    assert _check_bins(rows) <= -(-sum(r.length for r in rows) // 4096) * 1.1 + 1


def test_packing_repeated_rows(spark, monkeypatch):
    """A third of all rows alike are dealt over many groups and placed one by one."""
    monkeypatch.setattr(packing, "GROUP", 40)
    monkeypatch.setattr(packing, "BLOCK", 5)
    docs = [(7, "the same text"), *[(i, f"text {i}") for i in range(20, 22)]] * 200
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = packing.pack(frame).collect()
    _check_bins(rows)
    assert len(rows) == 600 and sum(r.doc_id == 7 for r in rows) == 200
    cut = packing.pieces(frame).groupBy("doc_id", "piece", "start", "length", "ids_crc32").agg(F.count("*").alias("n"))
    parts = [r["count"] for r in packing._dealt(cut, 15).groupBy("part").count().collect()]
    assert sum(parts) == 600 and max(parts) <= 100


def test_best_fit():
    bins = packing.best_fit([6, 5, 4, 3, 2], 10)
    assert sorted(map(sorted, bins)) == [[0, 2], [1, 3, 4]]
    assert packing.best_fit([], 10) == [] and packing.best_fit([10, 10], 10) == [[0], [1]]


def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    rejected = {r.doc_id for r in quality_rules(docs).filter("NOT kept").collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name == "quality_rules":
            assert seen[-1] == {r.doc_id for r in before.collect()} - rejected
        if name == "ngram_jaccard_join":
            classes = _classes([(r.doc_id, r.text) for r in before.collect()], corpus_pipeline.NEAR)
            assert seen[-1] == {c for _, c in classes.values()}
        if name == "suffix_array_dedup":
            assert seen[-1] == seen[-2]
        if name != "best_fit_packing":
            assert docs.columns == columns
    assert seen[4] == seen[3] < seen[1] < seen[0]
    assert docs.agg(F.countDistinct("doc_id", "piece")).first()[0] == docs.count()


def test_pipeline_edges(spark, edge_docs, no_docs, sf_dir):
    for docs in (edge_docs, no_docs):
        at = docs
        for name, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, sf_dir)
            if name == "ngram_jaccard_join":
                ids = [r.doc_id for r in at.select("doc_id").collect()]
                assert len(ids) == len(set(ids))
        at.collect()


def test_pipeline_judges_rows(spark, prose, sf_dir):
    """A failing row takes no other row of its doc_id, or without one, along."""
    texts = [prose(700 + i, 150) for i in range(4)]
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").filter("size(split(text, ' ')) > 14").first().text
    rows = [(i, t, "en", "s") for i in (None, 5) for t in (*texts, "short", "", f"{prose(800, 90)} {item} {prose(801, 90)}")]
    rows += [(6, texts[0], "en", "s"), (4, texts[1] + " more", "en", "s"), (5, texts[2], "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    read = lambda df: sorted((r.doc_id or 0, r.text) for r in df.collect())
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_rules"](spark, docs, sf_dir)
    assert read(good) == sorted((i or 0, t) for i, t, *_ in rows if len(t) > 5)
    apart = stages["ngram_jaccard_join"](spark, docs, sf_dir)
    # Without an id all stay; of near copies the smallest id; rows alike once.
    want = [(0, r[1]) for r in rows if r[0] is None] + [(5, r[1]) for r in rows[7:14] if r[1] != texts[1]] + [(4, texts[1] + " more")]
    assert read(apart) == sorted(want)
    clean = stages["benchmark_decontamination"](spark, docs, sf_dir)
    assert read(clean) == sorted((i or 0, t) for i, t, *_ in rows if item not in t)
