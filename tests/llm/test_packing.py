import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from wattlake.llm import packing
from wattlake.llm.queries import byte_bpe, packed_sequences

DOCS = "doc_id long, text string"


def naive_best_fit(lengths, window):
    rooms, place, offset = [], {}, {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [w for w in range(len(rooms)) if rooms[w] >= lengths[i]]
        if fits:
            w = min(fits, key=lambda w: rooms[w])
        else:
            w = len(rooms)
            rooms.append(window)
        place[i], offset[i] = w, window - rooms[w]
        rooms[w] -= lengths[i]
    return place, offset, rooms


@pytest.mark.parametrize("seed", range(5))
def test_tree_finds_the_tightest_window(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 65, 200)
    place, offset = packing.best_fit_decreasing(lengths, 64)
    _, _, rooms = naive_best_fit(lengths.tolist(), 64)
    fill = np.bincount(place, weights=lengths)
    # Windows of equal room are alike, so the sets of fills are the same.
    assert sorted(fill) == sorted(64 - r for r in rooms)
    for w in range(len(fill)):
        own = np.flatnonzero(place == w)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == [0, *np.cumsum(lengths[own])[:-1].tolist()]


def _check(pieces, texts):
    """Every id of every document in one piece; sequences without gaps; ids as the tokenizer file gives them."""
    tokenizer = Tokenizer.from_file(byte_bpe()["vocabulary"])
    whole, used = {}, {}
    for r in pieces:
        whole.setdefault(r.doc_id, {})[r.start] = r
        used.setdefault(r.sequence_id, []).append((r.offset, len(r.ids)))
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        parts = whole[doc_id]
        assert [x for start in sorted(parts) for x in parts[start].ids] == ids
        assert all(start == sum(len(parts[s].ids) for s in parts if s < start) for start in parts)
        assert {p.doc_tokens for p in parts.values()} == {len(ids)}
    for spots in used.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 1024
    return used


def test_all_documents_are_packed_with_little_padding(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pieces = packing.pack(docs, **byte_bpe()).collect()
    used = _check(pieces, {r.doc_id: r.text for r in docs.collect()})
    filled = [sum(n for _, n in spots) for spots in used.values()]
    padding = sum(1024 - n for n in filled if n & (n - 1))
    assert padding < 0.01 * sum(filled)
    digests = {(r.doc_id, r.start): r for r in packed_sequences(spark, folder).collect()}
    assert len(digests) == len(pieces)
    for p in pieces:
        d = digests[(p.doc_id, p.start)]
        assert d.length == len(p.ids) and d.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())


def test_odd_rows_have_defined_results(spark):
    texts = {1: None, 2: "", 3: "a <|endoftext|> b", 4: "word " * 9000, 5: "one", 6: "é\u2581😀"}
    rows = [(i, t, "s") for i, t in texts.items()]
    docs = spark.createDataFrame(rows, DOCS + ", ids string")
    pieces = packing.pack(docs, **byte_bpe()).collect()
    _check(pieces, texts)
    more = spark.createDataFrame([*rows, (None, "one", "s"), (5, "one", "s")], DOCS + ", ids string")
    pieces = packing.pack(more, **byte_bpe(), shard=2).collect()
    assert sorted(len(p.ids) for p in pieces if p.doc_id in (None, 5)) == [2, 2, 2]
    assert len({(p.sequence_id, p.offset) for p in pieces}) == len(pieces)


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert packing.pack(none, **byte_bpe()).collect() == []


def test_rank_file_and_tokenizer_file_agree():
    fast = packing.Encoder(**byte_bpe())
    slow = packing.Encoder(byte_bpe()["vocabulary"], None, None)
    for text in ("", " x", "It's 12 o'clock\n\n\tnow!", "über\u00a0straße", "<|endoftext|>", "日本語", "a" * 5000):
        assert fast.ids(text).tolist() == slow.ids(text).tolist()
