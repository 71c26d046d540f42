from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, at int"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def _h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _leaf(values):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _climb(nodes):
    """All levels up to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_h(*below[i:i + 16]) for i in range(0, len(below), 16)])
    return levels


def _others(levels, at):
    out = []
    for below in levels[:-1]:
        start = at // 16 * 16
        out.append((at - start, [x for i, x in enumerate(below[start:start + 16]) if i != at - start]))
        at //= 16
    return out


def brute(rows):
    """What the manifest should give, row by row."""
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    sorted_ = {s: sorted(trees[s], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r[:5]))) for s in order}
    levels = {s: _climb([_leaf(r[:5]) for r in own]) for s, own in sorted_.items()}
    top = _climb([levels[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(sorted_[s]):
            path = _others(levels[s], i) + _others(top, k)
            text = r[4]
            if r[0] is not None and crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = _leaf([*r[:4], text])
            for own, others in path:
                node = _h(*others[:own], node, *others[own:])
            out.append((r[0], _leaf(r[:5]), levels[s][-1][0], top[-1][0], _h(*(x for _, o in path for x in o)), node, node == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got = manifest.manifest(docs, COLUMNS, {"text": lower}, F.crc32(F.col("doc_id").cast("string")) % 5 == 0, **options)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("depth", [1, 3])
def test_equals_brute_force(spark, depth):
    """One level at a time needs several rounds; sources of 1, 16, 17 and 600 rows, ids near, far, negative, null and repeated."""
    rng = np.random.default_rng(3)
    rows = [(int(i), "web", "en", 3, f"Text {i} É") for i in rng.permutation(600)]
    rows += [(int(i), "far", "de", None, "Ab" * (i % 9)) for i in rng.integers(-(2**63), 2**63 - 1, 17, dtype=np.int64).tolist()]
    rows += [(i, None, None, i, None) for i in range(-8, 8)] + [(5, "", "en", 1, "LONE " * 30_000)]
    rows += [(None, "odd", "en", i, "") for i in range(40)] + [(9, "odd", "en", i % 3, "Same") for i in range(50)] + [(10, "odd", "en", 1, "z")]
    assert run(spark, rows, depth=depth) == brute(rows)


def test_many_sources_and_one_row(spark):
    rows = [(i, f"s{i:03d}é", "en", 1, "A") for i in range(40)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:1]) == brute(rows[:1])


def test_no_rows(spark):
    assert run(spark, []) == []


def test_ranks_in_sparse_and_dense_containers():
    rng = np.random.default_rng(1)
    for n in (1, 200, 255, 256, 257, 4000, 4096):
        counts = np.zeros(manifest.IDS, dtype=np.int64)
        lows = rng.choice(manifest.IDS, n, replace=False)
        counts[lows] = rng.integers(1, 4, n)
        bits, again = manifest.compressed(counts)
        assert len(bits) <= 512 and (manifest.counts_of(bits, again) == counts).all()
        rank, tied = manifest.ranks(bits, again, lows)
        assert (rank == (np.cumsum(counts) - counts)[lows]).all() and (tied == (counts[lows] > 1)).all()


def test_altering_a_leaf_breaks_its_fold_only():
    nodes = [_h(str(i)) for i in range(300)]
    levels = manifest.reduced("".join(nodes).encode(), manifest.levels_of(300, 3))
    assert [levels[-1].decode()] == _climb(nodes)[-1]
    proof, spots = manifest.siblings(levels, 299)
    assert manifest.folded(nodes[299].encode(), proof, spots) == levels[-1]
    assert manifest.folded(nodes[298].encode(), proof, spots) != levels[-1]
