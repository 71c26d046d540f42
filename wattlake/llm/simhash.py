"""Near duplicates by SimHash, found at the anchors of a covering code.

Two fingerprints that differ in at most four of 64 bits differ in at most one bit of one of the three
segments of 22, 21 and 21 bits. A segment, padded to 23 bits, is a point of the space of the binary Golay
code, whose 4,096 words are the anchors: every point lies within three bits of exactly one of them, its
home. A fingerprint is replicated to every anchor within four bits, the covering radius and the threshold
left to the segment, which is 5.3 anchors on average. So two linked fingerprints meet at the home of either
one, and fingerprints are compared there: those at home with all others, over all 64 bits.

Equal fingerprints are one. Anchors with many fingerprints are cut into chunks, and each pair of chunks is
compared on its own. Where links are dense, an anchor hands on only what connects them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wattlake.llm.common import Scratch, blocks_at_space, in_small_batches, with_places, without_places
from wattlake.llm.components import connected_components, least_of_component, spanning_links
from wattlake.session import materialise

SEED = 42
MAX_DISTANCE = 4
#: Widths of the segments; a pair within MAX_DISTANCE differs in at most MAX_DISTANCE // 3 bits of one.
SEGMENTS = (22, 21, 21)
RADIUS = 3
#: Fixed value: generator polynomial of the binary Golay code of length 23, dimension 12.
GENERATOR = 0b1100_0111_0101
#: Fingerprints of one anchor compared in one go; more are cut into chunks of this size.
CHUNK = 20_000
#: For keep_one: documents of the sample that tells common shingles, how often one is in it at least, and how many count.
ORDER_DOCS, ORDER_LEAST, ORDER_SHINGLES = 4_000, 3, 50_000
#: Members of a token that are compared in one block.
BLOCK = 2048
#: Bytes of the sets of one chunk of a cluster.
CLUSTER_BYTES = 4 << 20
_PAIRS = 1 << 20
_NONE = np.zeros(0, dtype=np.uint64)


def votes(text: str | None, size: int) -> tuple[np.ndarray, int]:
    """How many of the text's shingles have each bit, lowest first, and the number of shingles."""
    total, n = np.zeros(64, dtype=np.int64), 0
    carried: list[bytes] = []
    seen = False
    for block in blocks_at_space(text or ""):
        words = carried + block.encode("utf-8", "surrogatepass").lower().split()
        if len(words) >= size:
            hashes = _shingle_hashes(words, size)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.sum(axis=0, dtype=np.int64)
            n, seen = n + len(hashes), True
        carried = words[-(size - 1):] if size > 1 else []
    if not seen and carried:
        value = np.array([xxhash.xxh64_intdigest(b" ".join(carried), seed=SEED)], dtype="<u8")
        return np.unpackbits(value.view(np.uint8), bitorder="little").astype(np.int64), 1
    return total, n


def _shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[a:b], seed=SEED) for a, b in zip(starts, ends[size - 1:].tolist(), strict=True)]
    return np.array(found, dtype="<u8")


def fingerprint(text: str | None, size: int) -> int:
    """A bit is one if over half of the shingles' hashes have it; zero without words."""
    total, n = votes(text, size)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0]) if n else 0


def with_fingerprints(docs: DataFrame, text: str = "text", size: int = 4, name: str = "fingerprint") -> DataFrame:
    """``docs`` with the long column ``name`` behind its own; only the text is looked at."""
    at = docs.columns.index(text)
    names = [*docs.columns, name]

    def add(batches):
        for rows in batches:
            found = np.array([fingerprint(value, size) for value in rows.column(at).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found.view(np.int64))], names)

    return in_small_batches(docs).mapInArrow(add, _extended(docs, name))


def _extended(docs: DataFrame, name: str) -> StructType:
    return StructType([*docs.schema.fields, StructField(name, LongType())])


@lru_cache(maxsize=1)
def _patterns() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: error patterns of weight up to RADIUS + 1 (the first is the only one up to RADIUS)."""
    by: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(RADIUS + 2):
        for bits in combinations(range(23), weight):
            pattern = sum(1 << i for i in bits)
            by[_syndrome(pattern)].append(pattern)
    counts = np.array([len(x) for x in by])
    return np.concatenate([np.array(x) for x in by]), np.cumsum(counts) - counts, counts


def _syndrome(word: int) -> int:
    """The remainder by the generator; words of the code have none. Bits above the 23rd are not looked at."""
    word &= (1 << 23) - 1
    for i in range(22, 10, -1):
        if word >> i & 1:
            word ^= GENERATOR << (i - 11)
    return word


@lru_cache(maxsize=1)
def _syndrome_tables() -> np.ndarray:
    """Syndromes of each value of each byte; the code is linear, so a word's is their exclusive or."""
    return np.array([[_syndrome(value << shift) for value in range(256)] for shift in (0, 8, 16)])


def _syndromes(words: np.ndarray) -> np.ndarray:
    low, middle, high = _syndrome_tables()
    return low[words & 255] ^ middle[words >> 8 & 255] ^ high[words >> 16]


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, anchor (segment and code word in one number) and whether it is the home, for each replica."""
    patterns, first, counts = _patterns()
    rows, keys, home = [], [], []
    shift = 0
    for segment, width in enumerate(SEGMENTS):
        points = (prints >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64)
        shift += width
        syndrome = _syndromes(points)
        n = counts[syndrome]
        row = np.repeat(np.arange(len(prints)), n)
        within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        word = points[row] ^ patterns[first[syndrome][row] + within]
        rows.append(row)
        keys.append((segment << 12) | (word >> 11))  # a word of the code is known by its upper 12 bits
        home.append(within == 0)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(home)


def close_links(home: np.ndarray, away: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (indices into home and then away) that join those within ``distance`` bits of one at home."""
    members = np.concatenate([home, away])
    n, block = len(members), max(1, _PAIRS // max(1, len(members)))
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    held = 0
    for start in range(0, len(home), block):
        far = np.bitwise_count(home[start:start + block, None] ^ members[None, start:])
        a, b = np.nonzero(far <= distance)
        a, b = (a + start)[a != b], (b + start)[a != b]
        for cut in range(0, len(a), 1 << 18):
            x, y = a[cut:cut + (1 << 18)], b[cut:cut + (1 << 18)]
            left.append(x)
            right.append(y)
            held += len(x)
            if held > n:  # keep a forest of what has been found
                y, x = spanning_links(n, np.concatenate(left), np.concatenate(right))
                left, right, held = [x], [y], 0
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return spanning_links(n, np.concatenate(left), np.concatenate(right))


def fingerprint_links(prints: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """``(a, b)``: links that connect the nodes of ``prints(node, fingerprint)`` within ``distance``.

    Not every link is returned, but the connected components are those of all links.
    """
    if distance // len(SEGMENTS) > 1:
        raise ValueError("the segments cover distances up to 5")
    names = ["node", "fingerprint"]

    def replicate(batches):
        for rows in batches:
            row, key, home = anchors(rows.column(1).to_numpy().view(np.uint64))
            taken = pa.array(row)
            arrays = [pa.array(key.astype(np.int32)), pa.array(home), *(column.take(taken) for column in rows.columns)]
            yield pa.RecordBatch.from_arrays(arrays, ["anchor", "home", *names])

    def compare(batches):
        for rows in batches:
            left, right = [], []
            for i in range(rows.num_rows):
                home, away = rows.column(0)[i].values, rows.column(1)[i].values
                if not len(home):
                    continue
                members = pa.concat_arrays([home, away])
                values = members.field(1).to_numpy().view(np.uint64)
                a, b = close_links(values[:len(home)], values[len(home):], distance)
                nodes = members.field(0).to_numpy()
                left.append(nodes[a])
                right.append(nodes[b])
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (left, right)], ["a", "b"])

    types = dict(prints.dtypes)
    schema = "anchor int, home boolean, " + ", ".join(f"{name} {types[name]}" for name in names)
    replicas = prints.select(*names).mapInArrow(replicate, schema)
    crowded = (  # at most a row for each anchor: 3 times 4,096
        replicas.groupBy("anchor").count().where(F.col("count") > CHUNK)
        .select("anchor", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    )
    cut = replicas.join(F.broadcast(crowded), "anchor", "left")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    cell = F.when(F.col("chunks").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("chunks") - 1),
            lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")),
        )
    )
    member = F.struct(*names)
    groups = (
        cut.select("anchor", F.explode(cell).alias("cell"), "home", *names)
        .groupBy("anchor", "cell")
        .agg(F.collect_list(F.when(F.col("home"), member)).alias("homes"), F.collect_list(F.when(~F.col("home"), member)).alias("others"))
        .select("homes", "others")
    )
    return in_small_batches(groups).mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 4, distance: int = MAX_DISTANCE
) -> DataFrame:
    """``doc_id, fingerprint`` (16 hexadecimal digits) and ``component_id`` for every row.

    The component's id is its smallest doc_id. Null, empty and wordless texts have fingerprint zero and are
    one group. Null ids are kept and never name a component that has another id. Repeated rows are kept.
    """
    rows = materialise(
        with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", size)
        .select("doc_id", "fingerprint")
    )
    distinct = materialise(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    nodes = distinct.select(F.col("fingerprint").alias("node"), "least")
    links = fingerprint_links(distinct.select(F.col("fingerprint").alias("node"), "fingerprint"), distance)
    named = least_of_component(nodes, connected_components(links)).withColumnRenamed("node", "fingerprint")
    return rows.join(named, "fingerprint").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct hashes of the text's shingles, in order; fewer words than ``size`` are one, none give none."""
    parts: list[np.ndarray] = []
    carried: list[bytes] = []
    for block in blocks_at_space(text or ""):
        words = carried + block.encode("utf-8", "surrogatepass").lower().split()
        if len(words) >= size:
            parts.append(np.unique(_shingle_hashes(words, size)))
        carried = words[-(size - 1):] if size > 1 else []
    if not parts and carried:
        return np.array([xxhash.xxh64_intdigest(b" ".join(carried), seed=SEED)], dtype="<u8")
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype="<u8")


def rarest(shingles: np.ndarray, n: int, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first ``n`` of the shingles: those not in ``common`` by hash, then the others by their rank."""
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        behind = np.where(common[at] == shingles, 1 + rank[at], 0)
        shingles = shingles[np.argsort(behind, kind="stable")]
    return shingles[:n]


def prefix_length(n: int, similarity: float) -> int:
    """Of two sets in one order with the similarity, each has a common member among so many first ones of its own."""
    return n - int(np.ceil(similarity * n - 1e-9)) + 1 if n else 0


def parity_bits(shingles: np.ndarray) -> bytes:
    """A bit for each value of the hashes' low bits: whether an odd number of shingles has it; about two bits a shingle.

    Every shingle that only one of two sets has turns one bit over, so the bits in which two sets differ are
    at most the shingles in which they differ. Halves of a longer one, turned into one by exclusive or, are
    what half as many bits would have been.
    """
    width = max(64, 1 << int(2 * len(shingles) - 1).bit_length()) if len(shingles) else 64
    odd = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def may_be_similar(bits: list[bytes], sizes: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs (i, j) can have the Jaccard similarity; never false for those that have it."""
    wide = np.array([len(x) for x in bits], dtype=np.int64)
    least = np.minimum(wide[i], wide[j])
    out = np.zeros(len(i), dtype=bool)
    for width in np.unique(least).tolist():
        some = np.flatnonzero(least == width)
        members, at = np.unique(np.concatenate([i[some], j[some]]), return_inverse=True)
        table = np.stack([_folded(bits[k], width) for k in members.tolist()])
        for start in range(0, len(some), _PAIRS >> 4):
            part = slice(start, start + (_PAIRS >> 4))
            x, y = at[:len(some)][part], at[len(some):][part]
            far = np.bitwise_count(table[x] ^ table[y]).sum(axis=1, dtype=np.int64)
            both = sizes[i[some][part]] + sizes[j[some][part]]
            out[some[part]] = far * (1 + similarity) <= (1 - similarity) * both + 1e-6
    return out


def _folded(bits: bytes, width: int) -> np.ndarray:
    words = np.frombuffer(bits, dtype="<u8")
    while len(words) * 8 > width:
        words = words[:len(words) // 2] ^ words[len(words) // 2:]
    return words


def fingerprint_of(shingles: np.ndarray) -> int:
    """The SimHash of a set of shingles as a signed number; zero without any."""
    total = np.zeros(64, dtype=np.int64)
    for start in range(0, len(shingles), _PAIRS >> 4):
        part = np.ascontiguousarray(shingles[start:start + (_PAIRS >> 4)])
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(shingles), bitorder="little").view("<i8")[0]) if len(shingles) else 0


def describe(
    text: str | None, size: int, similarity: float = 0.8, common: np.ndarray = _NONE, rank: np.ndarray = _NONE
) -> tuple[bytes, int, int, list[int], bytes]:
    """A 128-bit name of the text's set of shingles, their number and SimHash, the first of them in the order of ``rarest``, parities."""
    found = shingle_set(text, size)
    first = rarest(found, prefix_length(len(found), similarity), common, rank)
    return xxhash.xxh3_128_digest(found.tobytes()), len(found), fingerprint_of(found), first.view(np.int64).tolist(), parity_bits(found)


def _common_shingles(texts: DataFrame, size: int, seed: Column) -> tuple[np.ndarray, np.ndarray]:
    """Shingles common in a sample, in order, and their ranks, rare first. They only say what is compared first."""
    total = texts.count()
    sample = texts.where(F.pmod(F.xxhash64(seed), F.lit(max(1, total // ORDER_DOCS))) == 0).select("text")

    def cut(batches):
        for rows in batches:
            sets = [shingle_set(text, size) for text in rows.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["shingle"])

    found = (
        in_small_batches(sample).mapInArrow(cut, "shingle bigint").groupBy("shingle").count()
        .where(F.col("count") >= ORDER_LEAST).orderBy(F.desc("count"), "shingle").limit(ORDER_SHINGLES).collect()
    )
    hashes = np.array([row.shingle for row in reversed(found)], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], order


def similar_links(
    nodes: DataFrame, texts_of: Callable[[DataFrame], DataFrame], size: int, similarity: float, distance: int = MAX_DISTANCE
) -> DataFrame:
    """``(a, b)``: links that connect the nodes that ``similarity`` joins; every link is one by its shingles.

    ``nodes(node, size, fingerprint, tokens, bits)`` has the numbers of shingles, their SimHash, the first of them, of
    which two similar nodes share one, and their parities; ``texts_of`` gives ``(node, text)`` for some nodes. Fingerprints
    within ``distance`` bits, found at the anchors, are compared first, and every node with the least one that shares a
    token, so that most groups are joined by few pairs. Fingerprints do not tell all pairs of the similarity, so what
    holds a token and still is in different components is looked at block by block: parities, which rule out nearly
    all pairs below the similarity, say which nodes may belong together, and these clusters, whose nodes are sent
    once, are compared on the shingles. So the links are not all, but their components are those of all.
    """
    filed = Scratch(nodes.sparkSession)
    spread = nodes.select("node", "size", F.posexplode("tokens").alias("at", "token"))
    often = (  # combined before the shuffle, so a token that very many have is no burden
        spread.groupBy("token").agg(F.min("node").alias("least"), F.count("*").alias("n")).where("n > 1").select("token", "least")
    )
    met = filed(spread.join(often, "token").select("token", "node", F.col("size").cast("int").alias("size"), F.col("at").cast("int").alias("at"), "least"))
    met = filed(_one_of_alike(met))
    bits = nodes.select("node", "size", "bits")
    first = met.where("node <> least").groupBy(F.col("node").alias("b")).agg(F.min("least").alias("a")).select("a", "b")
    pairs = filed(_close_prints(nodes.where("size > 0"), distance, filed).union(first).distinct())
    links = materialise(_verified(texts_of, _plausible(pairs, bits, similarity), size, similarity, filed))
    components = materialise(connected_components(links))
    named = met.join(components, "node", "left").select("token", "node", "size", "at", F.coalesce("component", "node").alias("component"))
    apart = named.groupBy("token").agg(F.min("component").alias("c"), F.max("component").alias("d"), F.count("*").alias("n")).where("c <> d")
    open_ = filed(named.join(apart.select("token", "n"), "token"))
    clusters = connected_components(_blockwise(open_, bits, similarity)).withColumnRenamed("component", "cluster")
    clusters = filed(clusters.join(components, "node", "left").select("node", "cluster", F.coalesce("component", "node").alias("component")))
    links = materialise(links.union(_linked_in_clusters(clusters, _sets(texts_of, clusters.select("node"), size, filed), similarity, filed)))
    filed.remove()
    return links


def _close_prints(nodes: DataFrame, distance: int, filed: Scratch) -> DataFrame:
    """Pairs ``(a, b)``, the lesser first, that connect the nodes whose fingerprints are within ``distance`` bits."""
    prints = filed(nodes.groupBy("fingerprint").agg(F.min("node").alias("least")))
    same = nodes.select("node", "fingerprint").join(prints, "fingerprint").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    near = fingerprint_links(prints.select(F.col("least").alias("node"), "fingerprint"), distance)
    return same.union(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def _one_of_alike(met: DataFrame) -> DataFrame:
    """``met`` with one of the tokens that exactly the same nodes hold, the first in the order of all shingles.

    The tokens of a passage mostly have the same holders, and one of them says the same as all. Sets are told
    apart by 128 bits and their number. All holders have the tokens in one order, so the least node's places
    tell the first, and the places of that are right for each pair.
    """
    holders = met.groupBy("token").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("s"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("t"),
        F.min(F.struct("node", "at")).alias("lead"),
    )
    first = holders.groupBy("n", "s", "t").agg(F.min_by("token", "lead.at").alias("token"))
    return met.join(first.select("token"), "token", "left_semi")


def _plausible(pairs: DataFrame, bits: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` that parities don't rule out."""
    both = pairs
    for end, name in (("b", "y"), ("a", "x")):  # the many different ends first, the few centres last
        own = bits.select(F.col("node").alias(end), F.struct("size", "bits").alias(name))
        both = both.join(own, end)
    n, m = F.col("x.size"), F.col("y.size")
    near = both.where(F.least(n, m) >= similarity * F.greatest(n, m) - 1e-9).select(
        "a", "b", n.alias("n"), m.alias("m"), F.col("x.bits").alias("x"), F.col("y.bits").alias("y")
    )

    def test(batches):
        for rows in batches:
            count = rows.num_rows
            sizes = np.concatenate([rows.column(k).to_numpy() for k in (2, 3)])
            own = rows.column(4).to_pylist() + rows.column(5).to_pylist()
            keep = may_be_similar(own, sizes, np.arange(count), np.arange(count) + count, similarity)
            yield rows.select(["a", "b"]).filter(pa.array(keep))

    return in_small_batches(near).mapInArrow(test, "a bigint, b bigint")


def _cells(chunks: Column) -> Column:
    """The pairs of chunks that a node meets others in, as ``(i, j)``."""
    own = F.pmod(F.xxhash64("node"), chunks).cast("int")
    return F.transform(
        F.sequence(F.lit(0), chunks - 1), lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j"))
    )


def _blockwise(members: DataFrame, bits: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``(a, b)`` that connect a token's members of different components that sizes, places and parities don't rule out.

    Of a block's pairs only a forest is handed on, fewer than its members. A token with more than BLOCK members is
    cut into chunks, and each pair of chunks is a block of its own.
    """
    chunks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), chunks).cast("int")
    member = F.struct("node", F.col("size").cast("bigint").alias("size"), F.col("at").cast("bigint").alias("at"), "component", own.alias("own"), "bits")
    blocks = (
        members.join(bits.select("node", "bits"), "node").select("token", F.explode(_cells(chunks)).alias("cell"), member.alias("member"))
        .groupBy("token", "cell").agg(F.collect_list("member").alias("members")).select("cell.i", "cell.j", "members")
    )

    def compare(batches):
        for rows in batches:
            left, right = [], []
            for i, j, members in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), rows.column(2), strict=True):
                x, y = _near_in_block(members.values, i != j, similarity)
                left.append(x)
                right.append(y)
            if left:
                x, y = np.concatenate(left), np.concatenate(right)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    return in_small_batches(blocks).mapInArrow(compare, "a bigint, b bigint")


def _near_in_block(members: pa.StructArray, across: bool, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    node, size, at, component, own = (members.field(k).to_numpy() for k in range(5))
    raw = members.field(5).to_pylist()
    root = np.arange(len(node))  # the least member that one is connected with so far
    a = b = np.zeros(0, np.int64)
    step = max(1, _PAIRS // max(1, len(node)))
    for start in range(0, len(node), step):
        rows = np.arange(start, min(start + step, len(node)))
        n, m = size[rows, None], size[None]
        left = np.minimum(n - at[rows, None], m - at[None])  # no more can be common from here on
        near = (np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9) & (left >= similarity / (1 + similarity) * (n + m) - 1e-9)
        near &= (component[rows, None] != component[None]) & (rows[:, None] < np.arange(len(node))[None])
        near &= root[rows, None] != root[None]
        if across:
            near &= own[rows, None] != own[None]
        i, j = np.nonzero(near)
        i = rows[i]
        keep = may_be_similar(raw, size, i, j, similarity)
        a, b = spanning_links(len(node), np.concatenate([a, i[keep]]), np.concatenate([b, j[keep]]))
        root[a] = b
    return node[a], node[b]


def _linked_in_clusters(clusters: DataFrame, sets: DataFrame, similarity: float, filed: Scratch) -> DataFrame:
    """Links ``(a, b)`` that connect the components of a cluster that similar nodes join, by their shingles.

    A cluster of ``clusters(node, cluster, component)`` that is long or has many nodes is cut into chunks, and each
    pair of chunks is compared on its own.
    """
    whole = sets.join(clusters, "node")
    wide = clusters.join(sets.select("node", F.octet_length("shingles").alias("bytes")), "node")
    wide = wide.groupBy("cluster").agg(F.ceil(F.greatest(F.sum("bytes") / CLUSTER_BYTES, F.count("*") / BLOCK)).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    cells = (
        whole.join(filed(wide), "cluster")
        .select("cluster", F.explode(_cells(F.col("chunks"))).alias("cell"), F.struct("node", "component", own.alias("own"), "shingles").alias("member"))
        .groupBy("cluster", "cell").agg(F.collect_list("member").alias("members")).select("cell.i", "cell.j", "members")
    )

    def link(batches):
        for rows in batches:
            for i, j, members in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), rows.column(2), strict=True):
                node, component, chunk = (members.values.field(k).to_numpy() for k in range(3))
                found = [np.frombuffer(x.as_buffer(), "<u8") for x in members.values.field(3)]
                x, y = _links_of_sets(found, component, chunk if i != j else None, similarity)
                yield pa.RecordBatch.from_arrays([pa.array(node[x]), pa.array(node[y])], ["a", "b"])

    return in_small_batches(cells).mapInArrow(link, "a bigint, b bigint")


def _links_of_sets(sets: list[np.ndarray], component: np.ndarray, chunk: np.ndarray | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Similar pairs of sets, of different chunks if given, that join the components that all similar pairs join."""
    n = len(sets)
    root = np.unique(component, return_inverse=True)[1]
    size, bits = np.array([len(x) for x in sets], dtype=np.int64), [parity_bits(x) for x in sets]
    shingle = np.unique(np.concatenate(sets), return_inverse=True)[1]
    numbers = np.split(shingle, np.cumsum(size)[:-1])
    own = np.zeros(int(shingle.max(initial=0)) + 1, dtype=np.uint8)
    left, right = [], []
    step = max(1, _PAIRS // n)
    for start in range(0, n, step):
        rows = np.arange(start, min(start + step, n))
        x, y = size[rows, None], size[None]
        near = (np.minimum(x, y) >= similarity * np.maximum(x, y) - 1e-9) & (rows[:, None] < np.arange(n)[None])
        near &= root[rows, None] != root[None]
        if chunk is not None:
            near &= chunk[rows, None] != chunk[None]
        i, j = np.nonzero(near)
        keep = may_be_similar(bits, size, i + start, j, similarity)
        i, j = i[keep] + start, j[keep]
        for k in np.unique(i).tolist():
            others = j[slice(*np.searchsorted(i, (k, k + 1)))]
            others = others[root[others] != root[k]]
            if not len(others):
                continue
            own[numbers[k]] = 1
            ends = np.cumsum(size[others])
            common = np.add.reduceat(own[np.concatenate([numbers[o] for o in others])], ends - size[others], dtype=np.int64)
            own[numbers[k]] = 0
            for o in others[common >= similarity * (size[k] + size[others] - common) - 1e-9].tolist():
                if root[o] != root[k]:
                    left.append(k)
                    right.append(o)
                    root[root == root[o]] = root[k]
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def _sets(texts_of: Callable[[DataFrame], DataFrame], needed: DataFrame, size: int, filed: Scratch) -> DataFrame:
    """``(node, shingles)``: the sets of shingles of the nodes needed, in order."""
    def cut(batches):
        for rows in batches:
            sets = [shingle_set(text, size).tobytes() for text in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    return filed(in_small_batches(texts_of(needed)).mapInArrow(cut, "node bigint, shingles binary"))


def _verified(texts_of: Callable[[DataFrame], DataFrame], pairs: DataFrame, size: int, similarity: float, filed: Scratch) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose sets of shingles have the Jaccard similarity or more."""
    def test(batches):
        for rows in batches:
            keep = np.zeros(rows.num_rows, dtype=bool)
            for i in range(rows.num_rows):
                x, y = (np.frombuffer(rows.column(k)[i].as_buffer(), "<u8") for k in (2, 3))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = common >= similarity * (len(x) + len(y) - common) - 1e-9
            yield rows.select(["a", "b"]).filter(pa.array(keep))

    pairs = filed(pairs)
    sets = _sets(texts_of, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), size, filed)
    # The different ends travel with their sets; a centre's set is sent once.
    both = pairs.join(sets.withColumnsRenamed({"node": "b", "shingles": "y"}), "b").join(
        sets.withColumnsRenamed({"node": "a", "shingles": "x"}), "a"
    )
    return in_small_batches(both.select("a", "b", "x", "y")).mapInArrow(test, "a bigint, b bigint")


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, similarity: float = 0.8
) -> DataFrame:
    """One row of each group of near copies, with all its columns: that with the smallest id, nulls last.

    Near copies have the Jaccard similarity or more in their sets of shingles of ``size`` words, whatever the
    kind of edit. They are found by SimHash: fingerprints of the sets within MAX_DISTANCE bits meet at the anchors,
    as in ``near_duplicates``, and each link is verified on the shingles. Fingerprints do not tell all pairs of the
    similarity apart from others, so an exact completion follows: candidates that share one of the first shingles of
    each in an order of all shingles (prefix filter), which no similar pair fails, also verified. Groups are
    connected components. All texts without words are one group.

    Equal ids are told apart by the place of their rows, so of repeated rows one stays. Texts are shuffled
    only if a list of rows is too long to be broadcast, and not copied where the rows stand in Parquet files.
    """
    filed, copied = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    placed, (file, at) = with_places(docs, copied)
    source = placed.select(
        F.struct(F.col(doc_id).isNull().alias("null"), F.col(doc_id).alias("id"), F.col(file).alias("file"), F.col(at).alias("at")).alias("row"),
        F.col(text).alias("text"),
    )
    common = _common_shingles(source, size, F.struct("row.file", "row.at"))
    shared = docs.sparkSession.sparkContext.broadcast(common)  # at most ORDER_SHINGLES

    def look(batches):
        for rows in batches:
            found = [describe(value, size, similarity, *shared.value) for value in rows.column(1).to_pylist()]
            kinds = pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()
            arrays = [pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([rows.column(0), *arrays], ["row", "name", "size", "fingerprint", "tokens", "bits"])

    schema = f"row {dict(source.dtypes)['row']}, name binary, size bigint, fingerprint bigint, tokens array<bigint>, bits binary"
    # Numbered as they are written, once.
    rows = filed(in_small_batches(source).mapInArrow(look, schema).withColumn("node", F.monotonically_increasing_id()))
    # Texts with the same shingles are one node, named by its least row.
    distinct = materialise(rows.groupBy("name").agg(F.min(F.struct("row", "node")).alias("least")))
    nodes = distinct.select(F.col("least.node").alias("node"), F.col("least.row").alias("least"))
    again = rows.select("node").join(nodes.select("node"), "node", "left_anti")
    own = rows.select("node", "size", "fingerprint", "tokens", "bits").join(again, "node", "left_anti")
    numbers = rows.select("node", F.col("row.file").alias(file), F.col("row.at").alias(at))
    texts = placed.select(file, at, F.col(text).alias("text"))

    def texts_of(needed: DataFrame) -> DataFrame:
        return texts.join(numbers.join(needed, "node", "left_semi"), [file, at]).select("node", "text")

    links = similar_links(own, texts_of, size, similarity)
    least = least_of_component(nodes, connected_components(links))
    stays = least.select(F.col("least.file").alias(file), F.col("least.at").alias(at)).distinct()
    kept = without_places(placed, numbers.select(file, at).join(stays, [file, at], "left_anti"), [file, at], copied)
    filed.remove()
    return kept.select(*docs.columns)
