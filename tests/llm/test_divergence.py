import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, slot int, term string, n int"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least=3, most=200):
    docs = [((r[2] or ""), (r[3] or ""), [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in TERM.findall(r[1] or "")]) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in seen.items() if n >= least)
        counts = {s: Counter() for s in {d[1] for d in own}}
        for _, s, terms in own:
            counts[s].update(t for t in terms if seen[t] >= least)
        whole = sum(counts.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        for s, c in counts.items():
            pairs = []
            for o, d in counts.items():
                if o != s:
                    pairs.append((o, sum((share(c, t) - share(d, t)) ** 2 // share(d, t) for t in kept)))
            terms = [(t, (share(c, t) - share(whole, t)) ** 2 // share(whole, t)) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, found, limit in (("pair", pairs, None), ("term", terms, most)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:limit])]
    return sorted(out)


def some_rows(n, seed=2):
    rng = np.random.default_rng(seed)
    words = ["The", "the", "cat", "Été", "été", "x", "naïve", "日本", "İ", "a1b", "zz--top", "q_r"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)]
    weights = np.arange(len(words), 0, -1) ** 2.0
    draw = lambda: " ".join(rng.choice(words, rng.integers(0, 40), p=weights / weights.sum()))
    langs, sources = ["en", "de", None, ""], ["web", "news", "Ä", None, "hot", "hot", "hot"]
    return [(i, draw(), langs[i % 4], sources[int(rng.integers(7))], 1, "t", 2) for i in range(n)]


def run(spark, rows, **options):
    got = divergence.divergence(spark.createDataFrame(rows, SCHEMA), **options)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, got.collect()))


def test_equals_brute_force(spark):
    rows = some_rows(300)
    rows += [(1, None, "en", "nothing", 1, "t", 2), (1, "", "xx", "a", 1, "t", 2), (1, "?!", "xx", "b", 1, "t", 2)] + [rows[0]] * 3
    rows += [(2, "Cat " * 50_000, "en", "long", 1, "t", 2)]
    assert run(spark, rows) == brute(rows)


def test_small_shards_blocks_and_several_turns(spark, monkeypatch):
    for name, value in {"SHARD": 7, "BUDGET": 300, "BLOCK": 5}.items():
        monkeypatch.setattr(divergence, name, value)
    rows = some_rows(120, 9)
    assert run(spark, rows, most=4) == brute(rows, most=4)


def test_no_rows_and_nothing_kept(spark):
    assert run(spark, []) == []
    rows = [(1, "one", "en", "a", 1, "t", 2), (2, "two", "en", "b", 1, "t", 2)]
    assert run(spark, rows) == brute(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_numbers_its_terms_and_no_others(n, monkeypatch):
    terms = [f"term{i}é".encode() for i in range(n)]
    for levels in (divergence.LEVELS, 2):  # with two levels the rest is looked up by name
        monkeypatch.setattr(divergence, "LEVELS", levels)
        own = divergence.PerfectHash.unpacked(divergence.PerfectHash(terms).packed())
        assert sorted(own.look_up(terms, divergence.term_hashes(terms)).tolist()) == list(range(n))
        others = [f"other{i}".encode() for i in range(999)] + [f"term{i}ê".encode() for i in range(99)]
        assert (own.look_up(others, divergence.term_hashes(others)) == -1).all()
        by_slot = own.by_slot()
        assert [by_slot[s] for s in own.look_up(terms, divergence.term_hashes(terms))] == terms


def test_counts_beyond_64_bits_are_exact():
    counts, totals = np.array([[10**12, 0]]), np.array([3 * 10**12])
    assert divergence.shares(counts, totals, 5).tolist() == [[1 + 10**9 * (10**12 + 1) // (3 * 10**12 + 5), 1]]


def test_terms_across_blocks(monkeypatch):
    text = "The cat, naïve été日本 x".encode() * 50
    whole = [x for block in divergence.term_blocks(text) for x in block]
    monkeypatch.setattr(divergence, "BLOCK_BYTES", 7)
    assert [x for block in divergence.term_blocks(text) for x in block] == whole
    assert [x.decode() for x in whole] == [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in TERM.findall(text.decode())]


def test_a_task_hands_on_blocks_and_they_are_added_up(spark):
    batch = divergence._blocks_batch("en", "a", np.array([0, 0, 2]), np.array([1, 7, 3]), np.array([5, 1, 2]))
    assert batch.column("block").to_pylist() == [0, 2] and batch.column("n").to_pylist() == [6, 2]
    rows = [tuple(r.values()) for r in batch.to_pylist()]
    parts = spark.createDataFrame(rows * 3 + [("en", "b", *r[2:]) for r in rows], divergence._BLOCKS)
    found = sorted((r.lang, r.source, r.block, r.n, np.frombuffer(r.slots, "<u4").tolist(), np.frombuffer(r.counts, "<i8").tolist()) for r in divergence._added(parts).collect())
    assert found == [
        ("en", "a", 0, 18, [1, 7], [15, 3]), ("en", "a", 2, 6, [3], [6]), ("en", "b", 0, 6, [1, 7], [5, 1]), ("en", "b", 2, 2, [3], [2]),
    ]


def test_rows_of_a_task_do_not_grow_with_the_batches_it_reads(spark, monkeypatch):
    """Many groups of a wide vocabulary: a task hands on a block of a group once, not once for each batch."""
    monkeypatch.setattr(divergence, "HELD_SLOTS", 2_000)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    terms = spark.createDataFrame([("en", w) for w in words], "lang string, term string").select(
        "lang", F.col("term").cast("binary"), F.xxhash64(F.col("term").cast("binary")).alias("hash")
    )
    sizes = divergence._sizes(terms)
    shards = divergence._shards(terms, sizes)
    docs = [(" ".join(words[(i + k) % 40 * 10] for k in range(12)), "en", f"s{i % 40}") for i in range(1_200)]
    rows = spark.createDataFrame(docs, "text string, lang string, source string").select(F.col("text").cast("binary"), "lang", "source")
    monkeypatch.setattr(divergence, "BLOCK", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 60)
    try:
        parts = divergence._recount(rows.coalesce(1), shards, divergence._rounds(shards)[0], {"en": 1}).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(r.n for r in parts) == 1_200 * 12
    assert len(parts) == len({(r.source, r.block) for r in parts})


def test_held_numbers_are_added_up_and_taken_by_group():
    rng = np.random.default_rng(4)
    held, want, got = divergence._Held(50), Counter(), Counter()
    groups = [("en", "a"), ("en", None), ("de", "a")]

    def take():
        for group, slots, n in held.taken():
            assert (np.diff(slots) > 0).all()
            got.update({(group, s): k for s, k in zip(slots.tolist(), n.tolist(), strict=True)})
        assert held.size == 0 and not list(held.taken())

    for i in range(200):
        slots = rng.choice(60, 9, replace=False)
        n = rng.integers(1, 1 << 40, 9)
        want.update({(groups[i % 3], s): k for s, k in zip(slots.tolist(), n.tolist(), strict=True)})
        if held.add(groups[i % 3], slots, n):
            take()
    take()
    assert got == want
