import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from wattlake.llm import simhash
from wattlake.llm.queries import simhash_groups

DOCS = "doc_id long, text string"


def naive_fingerprint(text, size):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_groups(prints, distance):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    values = np.array(prints, dtype=np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= distance):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO three", "a b c d", "É é x Y z\x0bq r", "a b " * 30])
def test_fingerprints_equal_those_of_a_plain_loop(text):
    for size in (1, 4, 5):
        assert simhash.fingerprint(text, size) == naive_fingerprint(text, size)


def test_long_texts_go_block_by_block(monkeypatch):
    text = " ".join(f"Word{i % 97}x{i}" for i in range(400))
    whole = simhash.fingerprint(text, 4), simhash.describe(text, 5)
    assert whole[0] == naive_fingerprint(text, 4)
    monkeypatch.setattr("wattlake.llm.common.blocks_at_space.__defaults__", (40,))
    assert (simhash.fingerprint(text, 4), simhash.describe(text, 5)) == whole


def test_xxhash_of_spark_is_the_shingle_hash(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("one two three four"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"one two three four", seed=42)


def test_golay_code_covers_and_every_close_pair_meets():
    patterns, first, counts = simhash._patterns()
    assert len(patterns) == 1 + 23 + 253 + 1771 + 8855
    assert all(np.bitwise_count(patterns[first].astype(np.uint32)) <= 3) and len(counts) == 2048
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    y = x.copy()
    for i in range(len(y)):
        for bit in rng.choice(64, i % 6, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(bit)
    homes, all_of = [set() for _ in x], [set() for _ in x]
    for row, key, home in zip(*simhash.anchors(x), strict=True):
        if home:
            homes[row].add(key)
    for row, key, _ in zip(*simhash.anchors(y), strict=True):
        all_of[row].add(key)
    assert all(a & b for a, b in zip(homes, all_of, strict=True))


@pytest.mark.parametrize("chunk", [20_000, 5])
def test_groups_equal_those_of_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = np.random.default_rng(2)
    values = set()
    for base in rng.integers(0, 1 << 62, 25):
        value = int(base)
        for _ in range(12):  # chains and balls
            values.add(value)
            for bit in rng.choice(64, rng.integers(1, 7), replace=False):
                value ^= 1 << int(bit)
    prints = sorted(values)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x, x) for x in signed], "node long, fingerprint long")
    links = simhash.connected_components(simhash.fingerprint_links(df, 4)).collect()
    component = {r.node: r.component for r in links}
    expected = naive_groups(prints, 4)
    groups = {}
    for i, x in enumerate(signed):
        groups.setdefault(component.get(x, x), set()).add(expected[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(expected))


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = sorted(docs)
    prints = [naive_fingerprint(docs[i], 4) for i in ids]
    groups = naive_groups(prints, 4)
    expected = {(i, f"{p:016x}", ids[g]) for i, p, g in zip(ids, prints, groups, strict=True)}
    assert {tuple(r) for r in simhash_groups(spark, folder).collect()} == expected


def test_odd_rows_have_defined_results(spark):
    rows = [(5, None, 1), (3, "", 1), (None, " \n", 1), (9, "one two three four five", 1), (9, "one two three four five", 1), (None, "lone text here", 1)]
    docs = spark.createDataFrame(rows, DOCS + ", fingerprint int")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(docs).collect())
    assert got == [(-1, -1), (-1, 3), (3, 3), (5, 3), (9, 9), (9, 9)]
    none = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(none).collect() == [] and simhash.keep_one(none).collect() == []


def test_one_row_of_each_group_stays(spark, tmp_path):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]
    rows, near, apart = [], {}, 1000
    for base in range(30):
        text = [str(x) for x in rng.choice(words, 400)]
        for copy in range(4):
            changed = list(text)
            for i in rng.choice(400, copy * 2, replace=False):
                changed[i] = str(rng.choice(words))
            near[len(rows)] = base
            rows.append((len(rows), " ".join(changed), "x"))
    rows += [(apart + i, " ".join(str(x) for x in rng.choice(words, 60)), "y") for i in range(50)]
    rows += [rows[0], (None, rows[0][1], "z"), (2000, None, "e"), (2001, "", "e")]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, DOCS + ", `place of the row` string").write.parquet(path)
    docs = spark.read.parquet(path)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == [4 * i for i in range(30)] + [apart + i for i in range(50)] + [2000]


def edited(rng, words, vocabulary, kind, similarity, size=5):
    """A copy of about the similarity in shingles, by one kind of edit."""
    n = len(words)
    if kind == "appended":
        return words + [str(x) for x in rng.choice(vocabulary, int(n / similarity) - n)]
    if kind == "cut":
        return words[: int(np.ceil(n * similarity)) + size - 1]
    changed = list(words)
    shared = int(2 * similarity / (1 + similarity) * (n - size + 1)) + 1
    for i in range((n - size + 1 - shared) // size):
        changed[(i * n // max(1, (n - size + 1 - shared) // size) + 7) % n] = f"new{rng.integers(1 << 40)}"
    return changed


def brute_force_kept(texts, similarity=0.8, size=5):
    sets = []
    for text in texts:
        words = text.lower().split()
        sets.append({tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))})
    root, linked = list(range(len(sets))), {}
    for i, x in enumerate(sets):
        for j in range(i):
            common = len(x & sets[j])
            linked[j, i] = common / len(x | sets[j])
            if linked[j, i] >= similarity:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return sorted(set(root)), linked


def test_copies_of_every_kind_go_as_brute_force_says(spark, tmp_path):
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(4000)]
    texts, copies = [], []
    for similarity in (0.6, 0.72, 0.78, 0.8, 0.82, 0.9):
        for kind in ("appended", "cut", "scattered"):
            for _ in range(5):
                words = [str(x) for x in rng.choice(vocabulary, int(rng.integers(80, 500)))]
                copies.append((len(texts), len(texts) + 1))
                texts += [" ".join(words), " ".join(edited(rng, words, vocabulary, kind, similarity))]
    expected, linked = brute_force_kept(texts)
    near = sum(linked[pair] >= 0.8 for pair in copies)
    assert 30 < near < len(copies) - 30
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(enumerate(texts)), DOCS.split(",")[0] + ", text string").write.parquet(path)
    assert sorted(r.doc_id for r in simhash.keep_one(spark.read.parquet(path)).collect()) == expected


def test_rows_stay_the_same_however_files_are_split_later(spark, tmp_path):
    rows = [(i, f"text {i // 2} " + " ".join(f"a{i // 2}x{k}" for k in range(30)), i % 16) for i in range(160)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, DOCS + ", part int").repartition(16, "part").write.parquet(path)
    settings = {"spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    kept = simhash.keep_one(spark.read.parquet(path))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 160, 2))
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_parities_never_rule_out_a_similar_pair():
    rng = np.random.default_rng(4)
    kept = ruled_out = 0
    for _ in range(600):
        n = int(rng.integers(1, 900))
        own = rng.integers(0, 2**63, n, dtype=np.uint64)
        other = np.concatenate([own[: int(n * rng.uniform(0.6, 1))], rng.integers(0, 2**63, int(n * rng.uniform(0, 0.4)), dtype=np.uint64)])
        a, b = np.unique(own), np.unique(other)
        if not len(b):
            continue
        near = len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
        may = simhash.may_be_similar([simhash.parity_bits(a), simhash.parity_bits(b)], np.array([len(a), len(b)]), np.array([0]), np.array([1]), 0.8)[0]
        assert may or not near
        kept, ruled_out = kept + bool(near), ruled_out + (not may)
    assert kept > 50 and ruled_out > 100
    own = rng.integers(0, 2**63, 500, dtype=np.uint64)
    wide = simhash.parity_bits(own)
    half = simhash._folded(wide, len(wide) // 2)
    odd = np.bincount((own & np.uint64(len(wide) * 4 - 1)).astype(int), minlength=len(wide) * 4) & 1
    assert (np.unpackbits(half.view(np.uint8), bitorder="little") == odd).all()


def stock(rng, n, paragraphs):
    """Documents of ten of forty stock paragraphs, none a near copy of another."""
    return [" ".join(paragraphs[i] for i in rng.permutation(40)[:10]) for _ in range(n)]


def test_shared_stock_text_and_hot_tokens_equal_brute_force_and_few_pairs_are_verified(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(3000)]
    paragraphs = [" ".join(str(x) for x in rng.choice(words, 40)) for _ in range(40)]
    verified = []
    real = simhash._verified

    def counted(texts_of, pairs, *rest):
        verified.append(pairs.count())
        return real(texts_of, pairs, *rest)

    monkeypatch.setattr(simhash, "_verified", counted)
    monkeypatch.setattr(simhash, "BLOCK", 32)  # tokens that many have are cut into chunks
    texts = stock(rng, 150, paragraphs)
    # A chain of copies, each near its neighbours only, and copies of stock documents.
    chain = [str(x) for x in rng.choice(words, 200)]
    for step in range(12):
        texts.append(" ".join(chain[: 200 - 0] if step == 0 else chain))
        chain = chain[8:] + [f"c{step}x{k}" for k in range(8)]
    texts += [t + " and one more word" for t in texts[:20]]
    expected, _ = brute_force_kept(texts)
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(path)
    assert sorted(r.doc_id for r in simhash.keep_one(spark.read.parquet(path)).collect()) == expected
    assert sum(verified) < 4 * len(texts)
    # Rows that are not read from files get places of their own.
    given = spark.createDataFrame(list(enumerate(texts[:40] + texts[:5])), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(given).collect()) == list(range(40))


def test_tokens_with_the_same_holders_are_one(spark):
    """Of tokens that exactly the same nodes hold, the first in the order of shingles stays, with its own places."""
    rows = [(7, 1, 0, 1), (8, 1, 1, 1), (9, 1, 2, 1), (7, 2, 3, 1), (8, 2, 4, 1), (9, 2, 6, 1)]  # 7, 8, 9: nodes 1 and 2
    rows += [(5, 2, 1, 2), (5, 3, 0, 2), (4, 2, 2, 2), (4, 3, 1, 2), (4, 4, 0, 2)]  # 5: nodes 2 and 3; 4: node 4 as well
    met = spark.createDataFrame(rows, "token long, node long, at int, least long").withColumn("size", F.lit(40))
    met = met.select("token", "node", "size", "at", "least")
    found = {(r.token, r.node, r.at) for r in simhash._one_of_alike(met).collect()}
    assert found == {(t, n, at) for t, n, at, _ in rows if t in (7, 5, 4)}
    assert simhash._one_of_alike(met.where("token = 0")).collect() == []


def near_sets(rng, n, shared):
    """Sets of which any two share the ``shared`` first of 100 members."""
    core = rng.integers(0, 2**63, shared, dtype=np.uint64)
    return [np.unique(np.concatenate([core, rng.integers(0, 2**63, 100 - shared, dtype=np.uint64)])) for _ in range(n)]


def test_a_block_hands_on_fewer_pairs_than_members():
    sets = near_sets(np.random.default_rng(5), 60, 87)  # all pairs are at 0.77, and parities rule out few of them
    n = len(sets)
    columns = [np.arange(n), np.full(n, 100), np.zeros(n, np.int64), np.arange(n), np.zeros(n, np.int32)]
    names = ["node", "size", "at", "component", "own", "bits"]
    members = pa.StructArray.from_arrays([*map(pa.array, columns), pa.array([simhash.parity_bits(x) for x in sets], pa.binary())], names)
    a, b = simhash._near_in_block(members, False, 0.75)
    assert len(a) == n - 1 and len(simhash.spanning_links(n, a, b)[0]) == n - 1


@pytest.mark.parametrize("chunks", [1, 3])
def test_links_of_a_cluster_join_what_brute_force_joins(chunks):
    rng = np.random.default_rng(6)
    sets = near_sets(rng, 25, 92) + near_sets(rng, 25, 87) + near_sets(rng, 20, 91)
    n = len(sets)
    component = np.where(np.arange(n) % 7 == 0, 1000 + np.arange(n) // 25, np.arange(n))
    chunk = np.arange(n) % chunks if chunks > 1 else None
    a, b = simhash._links_of_sets(sets, component, chunk, 0.8)
    near = [
        (i, j) for i in range(n) for j in range(i + 1, n)
        if (chunk is None or chunk[i] != chunk[j]) and len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))
    ]
    assert set(zip(a.tolist(), b.tolist(), strict=True)) <= set(near) and len(a) < n
    groups = [(i, j) for i in range(n) for j in range(i) if component[i] == component[j]]
    root = lambda links: (lambda x: [dict(zip(*map(np.ndarray.tolist, x), strict=True)).get(i, i) for i in range(n)])(
        simhash.spanning_links(n, np.array([x for x, _ in links]), np.array([y for _, y in links])))
    assert root(groups + near) == root(groups + list(zip(a.tolist(), b.tolist(), strict=True)))


def test_near_copies_are_found_by_their_fingerprints_at_the_anchors(spark, monkeypatch):
    """Without shared tokens of the completion, what is left are the links of SimHash."""
    met, real = [], simhash.fingerprint_links
    monkeypatch.setattr(simhash, "fingerprint_links", lambda prints, distance: met.append(distance) or real(prints, distance))
    rng = np.random.default_rng(9)
    base = [[str(x) for x in rng.integers(0, 5000, 900)] for _ in range(6)]
    texts = [" ".join(words[: 900 - cut]) for words in base for cut in (0, 5)]
    sets = [simhash.shingle_set(t, 5) for t in texts]
    close = {(i, i + 1) for i in range(0, 12, 2)
             if np.bitwise_count(np.uint64((simhash.fingerprint_of(sets[i]) ^ simhash.fingerprint_of(sets[i + 1])) & (2**64 - 1))) <= 4}
    rows = [(i, len(x), simhash.fingerprint_of(x), [], simhash.parity_bits(x)) for i, x in enumerate(sets)]
    nodes = spark.createDataFrame(rows, "node long, size long, fingerprint long, tokens array<long>, bits binary")
    given = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    links = simhash.similar_links(nodes, lambda needed: given.join(needed, "node"), 5, 0.8).collect()
    assert met == [4] and len(close) >= 3 and {(r.a, r.b) for r in links} == close
