import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattlake.llm import pair_index
from wattlake.llm.audit_queries import pair_index_round_trip

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
ODD = [
    None, "", " ", "a", "a" * 999, "<|endoftext|>", " x<|endoftext|><|endoftext|>y ", "<|endoftext", "'s'll've 's",
    "  \n\n\t a  　b ", "日本語" * 99, "😀‍🔥", "\x00a\x00", "՘ ᲊꟜ9", "é" * 50 + " " * 70 + "z", "12 345,6 !!! ??",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_ids_equal_the_library(library):
    encoder = pair_index.Encoder(PATH, PATTERN)
    rng = np.random.default_rng(5)
    letters = list("aabbcde  .'1\n") + ["é", "ß", "字", "😀", "́"]
    texts = ODD + ["".join(rng.choice(letters, rng.integers(1, 400))) for _ in range(300)]
    for got, text in zip(encoder.encode(texts), texts, strict=True):
        assert _ids(got) == library.encode(text or "", add_special_tokens=False).ids
        assert pair_index.decoded(encoder.own, np.frombuffer(got, "<u4")) == (text or "")


def _naive(own, word):
    """Merges the leftmost pair of the lowest rank until none is left."""
    ids = [int(own.byte[b]) for b in word]
    while True:
        ranks = [own.rank.get(a * own.base + b, 1 << 40) for a, b in zip(ids, ids[1:], strict=False)]
        if not ranks or min(ranks) == 1 << 40:
            return ids
        i = ranks.index(min(ranks))
        ids[i:i + 2] = [own.whole[ranks[i]]]


@pytest.mark.parametrize("many", [1, 3, 10**9])
def test_all_positions_of_a_pair_give_the_merges_of_each_word(monkeypatch, many):
    monkeypatch.setattr(pair_index, "MANY", many)
    own = pair_index.vocabulary_of(PATH)
    rng = np.random.default_rng(many % 7)
    words = [bytes(rng.choice(list(b"aeinrst  hlo"), rng.integers(1, 30))) for _ in range(400)] + [b"a" * 77, b"z", b"\x00\x00", b"inin" * 9]
    ids, sizes = pair_index.segment(own, words)
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    assert [x.tolist() for x in parts] == [_naive(own, w) for w in words]


def test_memory_starts_anew_and_long_texts_are_cut_at_spaces(monkeypatch, library):
    texts = ["the cat sat  on the mat, " * 40 + str(i) for i in range(30)] + ["x" * 500 + "  y" * 200]
    expected = [library.encode(x, add_special_tokens=False).ids for x in texts]
    monkeypatch.setattr(pair_index, "MEMO_WORDS", 5)
    monkeypatch.setattr(pair_index, "GROUP_WORDS", 50)
    monkeypatch.setattr(pair_index, "BLOCK_CHARS", 60)
    monkeypatch.setattr(pair_index._blocks, "__defaults__", (60,))
    assert [_ids(x) for x in pair_index.Encoder(PATH, PATTERN).encode(texts)] == expected


def test_rows_nulls_repeats_and_clashing_names(spark, library):
    rows = [(i, t, "u", 1) for i, t in enumerate(ODD)] + [(None, "same text", "u", 1)] * 2 + [(7, "long " * 60_000, "u", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    back = pair_index.decode(pair_index.encode(docs, PATH, PATTERN), PATH).withColumn("list", pair_index.unpacked(F.col("ids")))
    got = sorted((str(r.doc_id), r.text, list(r.list)) for r in back.collect())
    assert got == sorted((str(i), t or "", library.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in rows)
    assert pair_index.encode(docs.limit(0), PATH, PATTERN).collect() == []


def test_query_over_the_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = pair_index_round_trip(spark, folder).collect()
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        ids = np.array(library.encode(texts[r.doc_id], add_special_tokens=False).ids, dtype="<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids.tolist(), skip_special_tokens=False).encode()).hexdigest()
