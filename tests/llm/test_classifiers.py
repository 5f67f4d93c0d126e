"""Quality, toxicity and the pipeline: held-out accuracy, awkward rows, and stages against plain versions."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from playstar.llm import quality, simhash, toxicity
from tests.llm.tables import TEXTS, documents, smallest_reachable


@pytest.fixture(scope="module")
def larger(sf_dir):
    return sf_dir.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def tables(spark, larger):
    return spark.read.parquet(f"{larger}/documents.parquet"), spark.read.parquet(f"{larger}/labels.parquet")


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    found = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    truth = {r.doc_id: r.toxic for r in labels.collect() if found[r.doc_id].held_out}
    scores = np.array([found[i].score for i in truth])
    toxic = np.array(list(truth.values())) == 1
    assert (scores[toxic][:, None] > scores[~toxic][None]).mean() > 0.95
    assert (scores[~toxic] >= 0.7).mean() < 0.03
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in found.values())


def test_offending_sentences_are_located():
    model = toxicity.Model(-8.0, {"scum": 12.0, "idio*": 11.0})
    text = "A fine day. You are SCUM, all of you! Nothing else\nIdiotic thing"
    score, found = toxicity.Scorer(model).document(text, 0.5)
    assert [text[a:b].strip() for a, b, _ in found] == ["You are SCUM, all of you", "Idiotic thing"]
    assert score == pytest.approx(1 - np.prod([1 - 1 / (1 + np.exp(8 - w)) for w in (0, 12, 0, 11)]))


def test_long_clean_texts_are_clean_and_one_bad_sentence_in_them_is_found(spark, tables):
    docs, labels = tables
    model = toxicity.train(docs, labels)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.text}
    scorer = toxicity.Scorer(model)
    worst = [s[0] for i, t in texts.items() if truth.get(i) == 1 for s in toxicity.SENTENCES.finditer(t) if scorer.document(s[0], 0.5)[0] > 0.9]
    plain = [s for i, t in texts.items() if truth.get(i) == 0 for s in toxicity.SENTENCES.findall(t) if scorer.document(s, 0.5)[0] < 0.1]
    sentences = (plain * (100_000 // len(plain) + 1))[:100_000]
    clean, bad = ". ".join(sentences), ". ".join([*sentences[:70_000], worst[0], *sentences[70_000:]])
    rows = spark.createDataFrame([(1, clean), (2, bad)], "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.score(rows, model).collect()}
    assert found[1].score < 0.3 and found[1].sentences == []
    assert found[2].predicted == 1 and [bad[s.start : s.stop].strip() for s in found[2].sentences] == [worst[0].strip()]


def test_long_labelled_documents_take_part_in_training(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PIECE_CHARS", 200)
    draw = np.random.default_rng(5)
    # Only long documents have labels; a clean one holds thousands of words.
    texts = [". ".join(" ".join(f"w{k}" for k in draw.integers(0, 60, 6)) for _ in range(300)) for _ in range(60)]
    rows = [(i, t if i % 2 else t[:900] + ". w1 vilething w2. " + t[900:]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in rows] + [(0, 0)], "doc_id long, toxic int")
    scorer = toxicity.Scorer(toxicity.train(docs, labels))
    assert scorer.document("w5 vilething w9", 0.5)[0] > 0.7 and scorer.document(texts[1], 0.5)[0] < 0.3


def test_equal_texts_with_different_labels_count_as_toxic():
    texts = ["good words here", "vile words here", "vile words here"] * 6
    model = toxicity.fit(texts + [f"plain {i}" for i in range(9)], [0, 1, 0] * 6 + [0] * 9)
    assert isinstance(model, toxicity.Model)
    assert toxicity.fit(["a b", "a b"], [1, 0]).bias == 0.0


def test_training_finds_the_sentence_behind_the_label():
    rng = np.random.default_rng(0)
    words = [f"w{i}x" for i in range(200)]
    texts, labels = [], []
    for i in range(400):
        sentences = [" ".join(rng.choice(words, 8)) for _ in range(6)]
        if i % 4 == 0:
            sentences[int(rng.integers(6))] += " vilething"
        texts.append(". ".join(sentences))
        labels.append(int(i % 4 == 0))
    model = toxicity.fit(texts, labels)
    score, found = toxicity.Scorer(model).document("w1x w2x w3x. w4x vilething w5x. w6x w7x", 0.5)
    assert score > 0.7 and len(found) == 1 and found[0][0] > 10
    assert toxicity.Scorer(model).document("w1x w2x w3x. w4x w5x. w6x w7x", 0.5)[0] < 0.3


def test_quality_on_rows_outside_the_sample(tables, monkeypatch):
    docs, labels = tables
    monkeypatch.setattr(quality, "SAMPLE_LABELLED", 200)
    found = {r.doc_id: r for r in quality.score(docs, quality.train(docs, labels), threshold=0.3).collect()}
    at_once = {r.doc_id: r for r in quality.train_and_score(docs, labels, threshold=0.3).collect()}
    assert at_once.keys() == found.keys() and all(abs(at_once[i].score - r.score) < 1e-9 for i, r in found.items())
    truth = {r.doc_id: r.quality for r in labels.collect()}
    good = [found[i].keep for i, q in truth.items() if q == 1]
    bad = [found[i].keep for i, q in truth.items() if q == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_views_teach_each_other():
    """The second view learns from pseudo-labels of the first one, whose labels hardly cover it."""
    rng = np.random.default_rng(4)
    n = 2000
    truth = rng.integers(0, 2, n)
    text = truth[:, None] * 4.0 + rng.standard_normal((n, 3))
    place = np.where(rng.random(n) < 0.9, truth * 10, (1 - truth) * 10) + rng.integers(0, 10, n)
    page = np.eye(20)[place]
    labels = np.where(np.arange(n) < 60, truth, -1)
    model = quality.cotrain(text, page, labels)
    combined, by_text, by_page = model.scores(text, page)
    alone = quality._view(page[:60], truth[:60].astype(float), np.ones(60))
    agree = lambda score: ((score >= 0.5) == truth)[60:].mean()
    assert agree(by_page) > agree(quality._odds(alone.raw(page)))
    assert agree(combined) > 0.97


def test_pseudo_labels_come_from_all_rows_outside_the_sample(spark, monkeypatch):
    """Labels cover every document; those beyond the sample, and rows without an id, count as unlabelled."""
    n = quality.SAMPLE_LABELLED + 1500
    bad = lambda i: i % 3 == 0
    text = lambda i: f"{i} BUY @@ NOW ## !! {i % 7} $$ BUY BUY" if bad(i) else f"A plain sentence about river number {i} and its {i % 11} banks."
    rows = [(i if i % 50 else None, text(i), "en", "spam" if bad(i) else f"s{i % 5}", len(text(i))) for i in range(1, n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    labels = spark.createDataFrame([(i, int(not bad(i))) for i in range(1, n) if i % 50], "doc_id long, quality int")
    fitted = []
    plain = quality._view
    monkeypatch.setattr(quality, "_view", lambda rows, *more: fitted.append(len(rows)) or plain(rows, *more))
    model = quality.train(docs, labels)
    assert len(fitted) > 2 and max(fitted) > quality.SAMPLE_LABELLED * 3 // 4
    # The same in memory, on all rows at once.
    order = labels.select("doc_id", quality.F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(quality.SAMPLE_LABELLED)
    sample = {r.doc_id for r in order.collect()}
    rows.sort(key=lambda r: (r[0] is not None, r[0]))
    pages = np.array([quality.page_features(list(r[2:])) for r in rows])
    texts = np.array([quality.text_features(r[1]) for r in rows])
    marks = np.array([int(not bad(r[0])) if r[0] in sample else -1 for r in rows])
    whole = quality.cotrain(texts, pages, marks)
    for found, want in zip(model.scores(texts, pages), whole.scores(texts, pages), strict=True):
        assert np.abs(found - want).max() < 0.01


@pytest.mark.parametrize("marks", [[], [(1, 1, 0)], [(1, None, None), (None, 1, 1), (2, 7, 7)]])
def test_without_labels_of_both_kinds_all_stay(spark, marks):
    docs = documents(spark)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    assert quality.score(docs, quality.train(docs, labels)).where("keep").count() == docs.count()
    assert toxicity.score(docs, toxicity.train(docs, labels)).where("predicted = 0").count() == docs.count()


def test_awkward_rows_and_empty_tables(spark, tables):
    docs, labels = tables
    models = quality.train(docs, labels), toxicity.train(docs, labels)
    for rows in (TEXTS, []):
        odd = documents(spark, rows)
        for module, model in zip((quality, toxicity), models, strict=True):
            scored = module.score(odd, model).collect()
            assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
            assert sorted(str(r.doc_id) for r in scored) == sorted(str(i) for i, _ in rows)
    empty = documents(spark, [])
    assert quality.score(empty, quality.train(empty, labels)).count() == 0
    assert quality.train_and_score(empty, labels).count() == 0
    assert toxicity.score(empty, toxicity.train(empty, labels)).count() == 0


def test_stages_one_by_one(spark, larger, tables):
    docs, _ = tables
    stages = dict(corpus_pipeline.STAGES)
    truth = {r.doc_id: r for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    good = stages["quality classifier"](spark, docs, larger)
    assert good.columns == docs.columns
    kept = {r.doc_id for r in good.select("doc_id").collect()}
    assert np.mean([i in kept for i, r in truth.items() if r.quality == 1]) > 0.99
    assert np.mean([i in kept for i, r in truth.items() if r.quality == 0]) < 0.1
    clean = stages["toxicity"](spark, docs, larger)
    left = {r.doc_id for r in clean.select("doc_id").collect()}
    assert np.mean([i in left for i, r in truth.items() if r.toxic == 0]) > 0.97
    assert np.mean([i in left for i, r in truth.items() if r.toxic == 1]) < 0.3
    single = {r.doc_id for r in stages["SimHash near-dedup"](spark, docs, larger).select("doc_id").collect()}
    prints = [(r.doc_id, simhash.fingerprint(r.text, 3)) for r in docs.collect()]
    linked = [(a, b) for a, p in prints for b, q in prints if a < b and (p ^ q).bit_count() <= 2]
    component = smallest_reachable([i for i, _ in prints], linked)
    assert single == {i for i, c in component.items() if i == c}


def test_dedup_stage_on_awkward_rows(spark, larger):
    out = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](spark, documents(spark), larger)
    assert out.columns == documents(spark).columns
    ids = [r.doc_id for r in out.collect()]
    # The row without id and text has the fingerprint of rows with ids.
    assert ids.count(None) == 1 and ids.count(7) == 1 and 2 not in ids and 1 in ids


def test_dedup_stage_on_repeated_ids_and_rows_without_one(spark, larger):
    a, b, c, d = (" ".join(f"{name}{i}" for i in range(40)) for name in "abcd")
    rows = [(1, a), (1, b), (1, b), (2, a), (None, a), (None, c), (None, c), (None, d), (3, d), (None, b + " more")]
    stage = dict(corpus_pipeline.STAGES)["SimHash near-dedup"]
    outs = [sorted(map(str, stage(spark, documents(spark, rows).repartition(n), larger).select("doc_id", "text").collect())) for n in (1, 5)]
    assert outs[0] == outs[1]
    kept = [(r.doc_id, r.text) for r in stage(spark, documents(spark, rows), larger).collect()]
    assert sum(i == 1 for i, _ in kept) == 1 and (2, a) not in kept and (3, d) in kept
    assert kept.count((None, c)) == 1 and (None, a) not in kept and (None, d) not in kept


@pytest.mark.parametrize("rows", [TEXTS, []])
def test_all_stages_on_awkward_rows(spark, larger, rows):
    docs = documents(spark, rows)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, larger)
    assert docs.count() >= 0


def test_run_is_its_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert out and {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out[0].asDict())
    spans = {}
    for r in out:
        spans.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    for parts in spans.values():
        assert sum(n for _, n, _ in parts) == parts[0][2]
