import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.llm import language
from wattlake.llm.common import blocks_at_space
from wattlake.llm.queries import document_language

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string"


def naive_ngrams(text):
    symbols = [0] + [int(language._symbol_of()[ord(c)]) for c in text.lower()] + [0]
    found = {}
    for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False):
        if b:
            found[(a << 12) | (b << 6) | c] = found.get((a << 12) | (b << 6) | c, 0) + 1
    return found


@pytest.mark.parametrize("text", ["", "a", "ab", " x ", "Äpfel und Öl, 3 mal!", "ÇA VA? où", "日本 語" * 3, "ab" * 50])
def test_ngrams_equal_those_of_a_plain_loop(text, monkeypatch):
    for piece in (1, 2, 7, 1 << 22):
        monkeypatch.setattr(language, "_PIECE", piece)
        grams, counts = language.ngrams(text)
        assert dict(zip(grams.tolist(), counts.tolist(), strict=True)) == naive_ngrams(text)


def test_binding_rotates_and_multiplies():
    binder = language.Binder(64, 3)
    gram = np.array([(5 << 12) | (9 << 6) | 2])
    one = [np.roll(binder.letters[5], 2)[i] * np.roll(binder.letters[9], 1)[i] * binder.letters[2][i] for i in range(64)]
    assert binder.bound(gram)[0].tolist() == one
    grams, counts = np.array([70, 5000, 70_000]), np.array([3, 1, 2])
    assert binder.text_vector(grams, counts).tolist() == binder.bundle(grams, counts).tolist()


def test_profiles_are_bundles_of_equally_weighted_texts(spark):
    rows = [(1, "der hund und die katze", "de"), (2, "the dog and the cat", "en"), (3, "und " * 40, "de"), (4, None, "de"), (5, "x", None)]
    profiles = language.learn_profiles(spark.createDataFrame(rows, DOCS).repartition(3))
    binder = profiles.binder()
    sums = {}
    for _, text, lang in rows:
        if lang and text:
            grams, weights = language.document_weights(text)
            sums[lang] = sums.get(lang, 0) + binder.bundle(grams, weights)
    assert profiles.languages == ["de", "en"]
    assert np.allclose(profiles.prototypes, language.unit_rows(np.array([sums["de"], sums["en"]])))


def test_held_out_accuracy_and_fold(spark):
    found = document_language(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_rows_have_defined_results(spark):
    docs = spark.createDataFrame(
        [(1, "the cat sat on the mat", "en", 7), (2, None, "en", 7), (3, "", "de", 7), (None, "123 !?", None, 7),
         (1, "the cat sat on the mat", "en", 7), (4, "und der hund ist da", "de", 7), (5, "the dog " * 30_000, None, 7)],
        DOCS + ", score int",
    )
    profiles = language.learn_profiles(docs)
    found = {(r.doc_id, r.lang_pred): r.score for r in language.identify(docs, profiles).collect()}
    assert set(found) == {(1, "en"), (2, "und"), (3, "und"), (None, "und"), (4, "de"), (5, "en")}
    assert found[(2, "und")] == 0
    kept = language.keep_identified(docs, profiles)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1, 4, 5]


def test_short_texts_are_accepted_and_long_ones_must_be_like_a_language(spark):
    learned = spark.read.parquet(f"{FOLDER}/documents.parquet")
    profiles = language.learn_profiles(learned)
    binder = profiles.binder()
    assert profiles.accepts("Para el que las de", binder) and profiles.accepts("the " * 500, binder)
    rng = np.random.default_rng(6)
    strange = " ".join("".join(chr(0x400 + i) for i in rng.integers(0, 80, 7)) for _ in range(200))
    assert not profiles.accepts(strange, binder)
    assert not profiles.accepts("12 34 !", binder) and not profiles.accepts(None, binder)
    assert language.keep_identified(learned, profiles).count() == learned.count()


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    profiles = language.learn_profiles(none)
    assert profiles.languages == []
    assert language.identify(none, profiles).collect() == []
    some = spark.createDataFrame([(1, "text", None)], DOCS)
    assert [tuple(r) for r in language.identify(some, profiles).collect()] == [(1, "und", 0.0)]
    assert language.keep_identified(some, profiles).withColumn("x", F.lit(1)).collect() == []


def test_blocks_cut_at_white_space_only():
    text = "ab  cde\tf" * 20 + "g" * 50
    for size in (1, 3, 10, 1000):
        blocks = list(blocks_at_space(text, size))
        assert "".join(blocks) == text
        assert [w for b in blocks for w in b.split()] == text.split()
