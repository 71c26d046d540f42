import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from wattlake.llm import piece_dropout
from wattlake.llm.queries import piece_dropout_round_trip

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string"
ODD = ["", " ", "  a  b\n\n\tc ", "x" * 200, "aaaa" * 50, "日本語テキスト ﬁ\x00😀", "the " * 30, "it###", " x  ", "ab" * 400 + " cd", "Straße\r\n"]


@pytest.fixture(scope="module")
def pieces():
    return piece_dropout.pieces_of(MODEL)


def _split(ids, counts):
    ends = np.cumsum(counts)
    return [ids[a:b].tolist() for a, b in zip(ends - counts, ends, strict=True)]


def _texts(spark, n=200):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(n).collect()
    return [r.text for r in rows] + ODD


def test_without_dropout_ids_are_those_of_the_library(spark, pieces):
    texts = _texts(spark)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = _split(*piece_dropout.Encoder(pieces, 0, 1).encode(texts))
    assert got == library.encode(texts, num_threads=1)


def test_vectors_heap_and_plain_loop_agree(spark, pieces):
    encoder = piece_dropout.Encoder(pieces, 0.3, 5)
    words = sorted({w for t in _texts(spark, 20) for w in pieces.split(" " + t) if len(w) > 1 and all(c in pieces.single for c in w)})[:400]
    assert len(words) == 400
    for n, word in enumerate(words):
        key = n % 8
        symbols = np.array([pieces.single[c] for c in word], dtype=np.int32)
        short = encoder.short(symbols[None], np.array([key]))[0]
        ids, starts = symbols.tolist(), list(range(len(word)))
        while True:
            options = []
            for i in range(len(ids) - 1):
                left, right, start = np.array([ids[i]]), np.array([ids[i + 1]]), np.array([starts[i]])
                rank, into = pieces.pair(left, right)
                if rank[0] != piece_dropout._NONE and not encoder.skipped(np.array([key]), left, right, start)[0]:
                    options.append((int(rank[0]), i, int(into[0])))
            if not options:
                break
            _, i, merged = min(options)
            ids[i:i + 2] = [merged]
            del starts[i + 1]
        assert short[short >= 0].tolist() == ids == encoder.long(symbols, key).tolist(), word


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_every_segmentation_decodes_to_the_text(spark, pieces, dropout):
    texts = [*_texts(spark, 50), "a▁b ▁", "tail▁"]
    ids, counts = piece_dropout.Encoder(pieces, dropout, 3).encode(texts)
    assert piece_dropout.decode_ids(pieces, ids, counts).to_pylist() == texts


def test_segmentations_vary_and_are_repeatable(spark, pieces):
    text = "segmentation of words " * 50
    one = piece_dropout.Encoder(pieces, 0.3, 1)
    ids, counts = one.encode([text, text])
    first, second = _split(ids, counts)
    assert first == second == _split(*piece_dropout.Encoder(pieces, 0.3, 1).encode([text]))[0]
    assert first != _split(*piece_dropout.Encoder(pieces, 0.3, 2).encode([text]))[0]
    plain = _split(*piece_dropout.Encoder(pieces, 0, 1).encode([text]))[0]
    assert len(first) > len(plain)
    words = {tuple(first[i:i + 3]) for i in range(len(first))}
    assert len(words) > 20
    skipped = one.skipped(np.zeros(20_000), np.arange(20_000), np.arange(20_000) % 7, np.zeros(20_000))
    assert 0.28 < skipped.mean() < 0.32


def test_every_occurrence_has_a_key_of_its_own(spark, pieces):
    """Occurrences that share a segmentation have that of their own keys, and variety grows with them."""
    encoder = piece_dropout.Encoder(pieces, 0.1, 1)
    words = [w for t in _texts(spark, 20) for w in pieces.split(" " + t)][:3000] + [" internationalization"] * 4000 + [" " + "ab" * 40] * 3
    draw = piece_dropout.mixed(7, np.arange(len(words)))
    shared = _split(*encoder._encode_words(words, draw))
    assert shared == [encoder._segment([w], draw[i:i + 1])[0].tolist() for i, w in enumerate(words)]
    kinds = [len({tuple(x) for x in shared[3000:3000 + n]}) for n in (40, 400, 4000)]
    assert kinds[0] < kinds[1] < kinds[2] and kinds[2] > 200
    texts = [f"{n} internationalization" for n in range(4000)]
    ids, counts = encoder.encode(texts)
    whole = _split(ids, counts)
    tails = set()
    for text, found in zip(texts, whole, strict=True):
        spelled = [piece_dropout.decode_ids(pieces, np.array(found[i:]), np.array([len(found) - i]))[0].as_py() for i in range(len(found))]
        tails.add(tuple(found[max(i for i, x in enumerate(spelled) if x.endswith("internationalization")):]))
    assert len(tails) > 200


def test_groups_of_documents_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(ODD)) + [(None, None), (3, ODD[3])], DOCS)
    whole = sorted((tuple(r) for r in piece_dropout.encode(docs, MODEL).collect()), key=repr)
    monkeypatch.setattr(piece_dropout, "LONG", 4)
    pieces = piece_dropout.pieces_of(MODEL)
    encoder = piece_dropout.Encoder(pieces, piece_dropout.DROPOUT, piece_dropout.SEED)
    single = [(i, _split(*encoder.encode([t]))[0]) for i, t in [*enumerate(ODD), (None, None), (3, ODD[3])]]
    assert whole == sorted(single, key=repr)


def test_odd_rows_have_defined_results(spark):
    docs = spark.createDataFrame([(1, None, "x"), (None, "", "x"), (2, "one two", "x"), (2, "one two", "x")], DOCS + ", ids string")
    encoded = piece_dropout.encode(docs, MODEL, extra={"n": F.col("ids")})
    assert encoded.columns == ["doc_id", "ids", "n"]
    got = sorted((tuple(r) for r in piece_dropout.decode(encoded, MODEL).drop("ids").collect()), key=repr)
    assert got == sorted([(1, "x", ""), (None, "x", ""), (2, "x", "one two"), (2, "x", "one two")], key=repr)
    none = spark.createDataFrame([], DOCS)
    assert piece_dropout.decode(piece_dropout.encode(none, MODEL), MODEL).collect() == []
    odd = spark.createDataFrame([(1, [5, 200, 255]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in piece_dropout.decode(odd, MODEL).collect()}[2] == ""


def test_query_decodes_every_document(spark):
    folder = "/root/testdata/sf0.001"
    found = piece_dropout_round_trip(spark, folder).collect()
    assert len(found) == spark.read.parquet(f"{folder}/documents.parquet").count() and all(r.lossless for r in found)
