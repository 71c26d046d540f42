import pickle
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.llm import toxicity
from wattlake.llm.queries import document_toxicity

DOCS = "doc_id long, text string, lang string"


def test_held_out_rows_are_told_apart(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = document_toxicity(spark, folder).join(labels, "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    called = [r.predicted for r in held]
    true = [r.toxic for r in held]
    hits = sum(a and b for a, b in zip(called, true, strict=True))
    assert hits / sum(called) > 0.85 and hits / sum(true) > 0.8
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def _sample(n=240):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)]
    texts, labels = [], []
    for i in range(n):
        text = [str(w) for w in rng.choice(words, rng.integers(3, 30))]
        if i % 3 == 0:
            text.insert(int(rng.integers(len(text))), "badword" + str(rng.choice(words)))
        texts.append(" ".join(text))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_logits_equal_a_plain_loop():
    texts, labels = _sample()
    scorer = toxicity.fit(texts, labels, ["en"] * len(texts))
    net = scorer.net

    def plain(text):
        words = toxicity._WORD.findall(text.lower())
        pad = [np.zeros(toxicity.SIZE)] * (max(toxicity.WIDTHS) - 1)
        vectors = pad + [net.embedding[toxicity._features(w)].sum(axis=0) for w in words] + pad
        pooled = []
        for bank, shift in zip(net.banks, net.shifts, strict=True):
            k = len(bank)
            values = [sum(vectors[i + j] @ bank[j] for j in range(k)) + shift for i in range(len(vectors) - k + 1)]
            pooled.append(np.max(values, axis=0))
        return np.maximum(np.concatenate(pooled), 0) @ net.out + net.bias

    some = [*texts[:20], "", "badwordnew " * 3]
    assert np.allclose(scorer.logits(some), [plain(t) for t in some], atol=2e-4)


def test_long_texts_are_scored_whole(monkeypatch):
    texts, labels = _sample()
    scorer = pickle.loads(pickle.dumps(toxicity.fit(texts, labels, ["en"] * len(texts))))
    long = "w1 w2 w3 " * 5000 + "badwordw9 badwordw7 " + "w4 w5 " * 5000
    clean = long.replace("badwordw9 badwordw7 ", "")
    whole = scorer.logits([long, clean, texts[0]])
    assert scorer.scores([long])[0] > 0.5 > scorer.scores([clean])[0]
    monkeypatch.setattr("wattlake.llm.common.blocks_at_space.__defaults__", (100,))
    monkeypatch.setattr(toxicity, "_CACHE_WORDS", 3)
    assert np.allclose(scorer.logits([long, clean, texts[0]]), whole, atol=2e-4)


def test_thresholds_split_at_fewest_errors():
    x, y = np.array([0.0, 1, 2, 3, 4, 5]), np.array([0, 0, 1, 0, 1, 1])
    assert toxicity.best_threshold(x, y) in (1.5, 3.5)
    assert toxicity.best_threshold(np.zeros(4), np.array([0, 0, 0, 1])) == 1.0


def test_odd_rows_have_defined_results(spark):
    docs = spark.createDataFrame(
        [(i, t, "en", 0.5) for i, t in enumerate(_sample()[0])] + [(None, None, None, None), (900, "", "en", 1.0), (900, "", "en", 1.0)],
        DOCS + ", score double",
    )
    labels = spark.createDataFrame(
        [(i, v) for i, v in enumerate(_sample()[1])] + [(None, 1), (3, None), (900, 0)], "doc_id long, toxic int"
    )
    scorer = toxicity.learn(docs, labels)
    found = toxicity.score(docs, scorer).collect()
    assert len(found) == 243
    empty = {(r.score, r.predicted) for r in found if r.doc_id is None or r.doc_id == 900}
    assert len(empty) == 1 and empty.pop()[1] == 0
    kept = toxicity.keep_clean(docs, scorer)
    assert kept.columns == docs.columns
    assert kept.where("doc_id is null or doc_id = 900").count() == 3
    assert kept.where(F.col("text").contains("badword")).count() < 8


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, toxic int")
    scorer = toxicity.learn(docs, labels)
    assert toxicity.score(docs, scorer).collect() == []
    some = spark.createDataFrame([(1, "any text", "en"), (2, None, None)], DOCS)
    assert [r.predicted for r in toxicity.score(some, scorer).collect()] == [0, 0]
    assert toxicity.learn(some, spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).scores(["x"])[0] > 0.5


def test_all_labels_set_thresholds_in_their_true_mix(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FIT_POSITIVE", 60)
    monkeypatch.setattr(toxicity, "FIT_NEGATIVE", 100)
    rng = np.random.default_rng(12)
    spoken = {"en": "the of and to in that", "xx": "zu wir und nicht der das"}
    rows, labels = [], []
    for i in range(6000):
        lang = "xx" if i % 4 == 0 else "en"
        toxic = i % 10 == 0 if lang == "en" else i % 160 == 0  # few toxic labels in xx, but well over LEAST_ROWS
        words = [str(w) for w in rng.choice(spoken[lang].split(), 20)]
        # The word of most toxic rows is in a tenth of the clean ones, so errors cannot be avoided.
        if rng.random() < (0.8 if toxic else 0.1):
            words.insert(int(rng.integers(20)), f"bad{rng.integers(5)}")
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, DOCS)
    scorer = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert set(scorer.thresholds) == {"en", "xx"}
    y = np.array([v for _, v in labels])
    logits = scorer.logits([t for _, t, _ in rows])
    for lang in ("en", "xx"):
        own = np.array([r[2] == lang for r in rows])
        errors = ((logits[own] >= scorer.thresholds[lang]) != y[own]).sum()
        best = ((logits[own] >= toxicity.best_threshold(logits[own], y[own])) != y[own]).sum()
        assert errors <= best + 0.02 * own.sum()


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_no_text_is_shuffled_whatever_the_number_of_labels(spark, limit):
    """The same scores with labels broadcast and shuffled, and as from scoring with the learned scorer."""
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        scorer, logits = toxicity._learned(docs, labels, 7)
        assert "text" not in toxicity._label_counts(logits, labels, [])._jdf.queryExecution().optimizedPlan().toString()
        once = {r.doc_id: r.score for r in toxicity.classify(docs, labels).collect()}
        again = {r.doc_id: r.score for r in toxicity.score(docs, scorer).collect()}
        assert once.keys() == again.keys() and all(abs(once[i] - again[i]) < 1e-6 for i in once)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
