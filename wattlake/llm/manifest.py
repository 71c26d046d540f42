"""A Merkle manifest of a table, its leaves placed by ranks in bitmaps of ids.

Every row is a leaf, the SHA-256 of its columns. Per source, the leaves stand in the order of their ids; every
16 neighbours become their hash until one node is left, and the sources' nodes become the root likewise.

No leaf is sorted to find its place. Ids are cut into containers of 4,096; each task hands on a compressed
bitmap per source and container, and these are merged. The containers' counts form a popcount directory of
four levels of at most 8,193 entries a node, whose running sums say how many leaves of the source stand before
a container. A leaf's place is that sum and its rank in the container's bitmap. A place names a chunk of
4,096 leaves, 16 x 16 x 16, and a slot in it: each chunk is an array that leaves are put into by their slots,
and is reduced by three levels in one go. The chunks' nodes are the leaves of the next round.

Going down again, each chunk gets the siblings above it, so that proofs are made and folded chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import in_small_batches
from wattlake.session import materialise, scratch_path, small_table

#: Nodes that become one, and levels of a chunk.
FAN, DEPTH = 16, 3
#: Ids of a container, and bits of a directory's node.
IDS, STEP = 4096, 13
#: Container of rows without an id; every other one is larger.
_NO_ID = -(1 << 62)
#: Ids that a task gathers before it hands bitmaps on.
HELD = 1 << 20
_AGAIN = np.dtype([("low", "<u2"), ("more", "<u8")])
_RUN = "slots binary, ids binary, known binary, leaves binary, altered binary, touched binary"
_RUN_NAMES = ["slots", "ids", "known", "leaves", "altered", "touched"]


def _text_of(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: list[Column]) -> Column:
    """The SHA-256 of the columns, as bytes."""
    return F.unhex(F.sha2(F.concat(*map(_text_of, columns)).cast("binary"), 256))


# --- Bitmaps --------------------------------------------------------------------------------------------------


def compressed(counts: np.ndarray) -> tuple[bytes, bytes]:
    """A container's bitmap, and the ids that occur again with how often more.

    Below 256 ids the bitmap is the list of them, two bytes each, else 4,096 bits.
    """
    lows = np.flatnonzero(counts)
    bits = lows.astype("<u2").tobytes() if len(lows) < IDS // 16 else np.packbits(counts > 0, bitorder="little").tobytes()
    more = np.flatnonzero(counts > 1)
    again = np.zeros(len(more), dtype=_AGAIN)
    again["low"], again["more"] = more, counts[more] - 1
    return bits, again.tobytes()


def counts_of(bits: bytes, again: bytes) -> np.ndarray:
    counts = np.zeros(IDS, dtype=np.int64)
    if len(bits) == IDS // 8:
        counts[:] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), bitorder="little")
    else:
        counts[np.frombuffer(bits, dtype="<u2")] = 1
    more = np.frombuffer(again, dtype=_AGAIN)
    counts[more["low"]] += more["more"].astype(np.int64)
    return counts


def ranks(bits: bytes, again: bytes, lows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each id of the container: how many rows have a smaller one, and whether several rows have it."""
    if len(bits) == IDS // 8:
        words = np.frombuffer(bits, dtype="<u8")
        ones = np.bitwise_count(words).astype(np.int64)
        before = np.cumsum(ones) - ones
        word, bit = lows >> 6, (lows & 63).astype(np.uint64)
        below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        rank = before[word] + np.bitwise_count(below)
    else:
        rank = np.searchsorted(np.frombuffer(bits, dtype="<u2"), lows).astype(np.int64)
    more = np.frombuffer(again, dtype=_AGAIN)
    if not len(more):
        return rank, np.zeros(len(lows), dtype=bool)
    at = np.searchsorted(more["low"], lows)
    extra = np.concatenate([[0], np.cumsum(more["more"].astype(np.int64))])
    return rank + extra[at], more["low"][np.minimum(at, len(more) - 1)] == lows


def _pages(leaves: DataFrame) -> DataFrame:
    """The rows of each batch by source and container: ``key, container, lows, known, leaves, altered, touched``."""
    def cut(batches):
        for rows in batches:
            keys = rows.column(0).dictionary_encode()
            code = keys.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            known = rows.column(1).is_valid().to_numpy(zero_copy_only=False)
            ids = rows.column(1).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            home = np.where(known, ids >> 12, _NO_ID)
            low = np.where(known, ids & (IDS - 1), 0).astype("<u2")
            leaf = np.frombuffer(b"".join(rows.column(2).to_pylist()), dtype="S32")
            touched = rows.column(3).is_valid().to_numpy(zero_copy_only=False)
            other = np.frombuffer(b"".join(rows.column(3).fill_null(bytes(32)).to_pylist()), dtype="S32")
            order = np.lexsort((home, code))
            new = np.flatnonzero(np.r_[True, (np.diff(code[order]) != 0) | (np.diff(home[order]) != 0)]) if len(order) else []
            parts = np.split(order, new[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    keys.dictionary.take(pa.array(code[order[new]])), pa.array(home[order[new]]),
                    *(pa.array([x[p].tobytes() for p in parts], pa.binary()) for x in (low, known, leaf, other, touched)),
                ],
                ["key", "container", "lows", "known", "leaves", "altered", "touched"],
            )

    columns = "key string, container bigint, lows binary, known binary, leaves binary, altered binary, touched binary"
    return leaves.select("key", "doc_id", "leaf", "altered").mapInArrow(cut, columns)


def _containers(pages: DataFrame) -> DataFrame:
    """``key, container, bits, again, n``: the merged bitmaps and the number of rows of each."""
    def gather(batches):
        held: dict[tuple[str, int], list[bytes]] = {}
        size = 0
        for rows in batches:
            for key, container, lows in zip(*(x.to_pylist() for x in rows.columns), strict=True):
                held.setdefault((key, container), []).append(lows)
                size += len(lows) // 2
            if size > HELD:
                yield part(held)
                held, size = {}, 0
        if held:
            yield part(held)

    def part(held):
        found = [compressed(np.bincount(np.frombuffer(b"".join(lows), "<u2"), minlength=IDS)) for lows in held.values()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([key for key, _ in held], pa.string()), pa.array([c for _, c in held], pa.int64()),
                *(pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)),
            ],
            ["key", "container", "bits", "again"],
        )

    def merge(batches):
        for rows in batches:
            found, sizes = [], []
            for parts in rows.column(2).to_pylist():
                counts = sum(counts_of(x["bits"], x["again"]) for x in parts)
                found.append(compressed(counts))
                sizes.append(int(counts.sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0), rows.column(1), *(pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)),
                    pa.array(sizes, pa.int64()),
                ],
                ["key", "container", "bits", "again", "n"],
            )

    columns = "key string, container bigint, bits binary, again binary"
    parts = pages.select("key", "container", "lows").mapInArrow(gather, columns)
    # A part of a container is 512 bytes at most and one for each task and HELD ids.
    lists = parts.groupBy("key", "container").agg(F.collect_list(F.struct("bits", "again")).alias("parts"))
    return materialise(lists.mapInArrow(merge, f"{columns}, n bigint"))


def _with_base(containers: DataFrame) -> DataFrame:
    """``containers`` with ``size``, the rows of the source, and ``base``, those before the container."""
    def before(name: str, *node: str) -> Column:
        window = Window.partitionBy(*node).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    levels = [containers.select("key", F.col("container").alias("at"), "n")]
    for _ in range(3):
        levels.append(levels[-1].groupBy("key", F.shiftright("at", STEP).alias("at")).agg(F.sum("n").alias("n")))
    whole = Window.partitionBy("key")
    base = levels.pop().select("key", "at", before("at", "key").alias("base"), F.sum("n").over(whole).alias("size"))
    for level in reversed(levels):
        own = level.withColumn("up", F.shiftright("at", STEP))
        own = own.select("key", "at", "up", before("at", "key", "up").alias("own"))
        base = own.join(base.withColumnRenamed("at", "up"), ["key", "up"]).select(
            "key", "at", (F.col("base") + F.col("own")).alias("base"), "size"
        )
    return containers.join(base.withColumnRenamed("at", "container"), ["key", "container"])


def _numbered(df: DataFrame) -> DataFrame:
    """``df``, which is sorted, with ``ordinal`` from 0; only the partitions' sizes reach the driver."""
    place = F.monotonically_increasing_id()
    fixed = materialise(df)
    placed = fixed.select("*", F.shiftright(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("row"))
    sizes = dict(placed.groupBy("part").count().collect())
    starts, at = [], 0
    for part in sorted(sizes):
        starts.append({"part": part, "start": at})
        at += sizes[part]
    offsets = small_table(df.sparkSession, starts, "part bigint, start bigint")
    return placed.join(F.broadcast(offsets), "part").withColumn("ordinal", F.col("start") + F.col("row")).drop("part", "row", "start")


def _placed(pages: DataFrame, containers: DataFrame, chunk: int) -> DataFrame:
    """``key, size, chunk`` and runs of leaves with their slots. Rows with one id stand in the order of their hashes."""
    def rank(batches):
        for rows in batches:
            out = []
            for row in rows.to_pylist():
                lows = np.frombuffer(row["lows"], "<u2").astype(np.int64)
                at, tied = ranks(row["bits"], row["again"], lows)
                at = at + row["base"]
                known = np.frombuffer(row["known"], dtype=bool)
                ids = np.where(known, row["container"] * IDS + lows if row["container"] != _NO_ID else 0, 0).astype("<i8")
                columns = [(at % chunk).astype("<u2"), ids, known, *(np.frombuffer(row[x], "S32") for x in ("leaves", "altered")),
                           np.frombuffer(row["touched"], dtype=bool)]
                # A run for each chunk, and one for each row that shares its id with others.
                group = np.where(tied, -1 - np.arange(len(at)), at // chunk)
                for g in np.unique(group):
                    some = np.flatnonzero(group == g)
                    first = int(at[some[0]])
                    out.append((row["key"], row["size"], first // chunk, first if g < 0 else None, *(x[some].tobytes() for x in columns)))
            names = ["key", "size", "chunk", "tied", *_RUN_NAMES]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * len(_RUN_NAMES)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names)

    spark = pages.sparkSession
    joined = pages.join(containers, ["key", "container"]).select(
        "key", "container", "lows", "known", "leaves", "altered", "touched", "bits", "again", "base", "size"
    )
    path = scratch_path(spark, "manifest")
    in_small_batches(joined).mapInArrow(rank, f"key string, size bigint, chunk bigint, tied bigint, {_RUN}").write.parquet(path)
    runs = spark.read.parquet(path)
    single, tied = runs.where("tied is null").drop("tied"), runs.where("tied is not null")
    if tied.isEmpty():
        return single
    ordered = _numbered(tied.orderBy("key", "tied", "leaves"))
    first = ordered.groupBy("key", "tied").agg(F.min("ordinal").alias("first"))
    at = F.col("tied") + F.col("ordinal") - F.col("first")
    slot = F.hex(F.pmod(at, F.lit(chunk)))
    slot = F.lpad(slot, 4, "0")
    spread = ordered.join(first, ["key", "tied"]).withColumn("chunk", F.floor(at / chunk).cast("long")).withColumn(
        "slots", F.unhex(F.concat(F.substring(slot, 3, 2), F.substring(slot, 1, 2)))
    )
    return single.unionByName(spread.select(*single.columns))


# --- Trees ----------------------------------------------------------------------------------------------------


def levels_of(size: int, depth: int) -> int:
    """Levels from so many nodes to one, up to those of a chunk."""
    n = 0
    while size > 1 and n < depth:
        size, n = -(-size // FAN), n + 1
    return n


def reduced(nodes: bytes, levels: int) -> list[bytes]:
    """The nodes, 64 hexadecimal digits each, and those of each level above."""
    out, width = [nodes], 64 * FAN
    for _ in range(levels):
        below = out[-1]
        out.append("".join(sha256(below[i:i + width]).hexdigest() for i in range(0, len(below), width)).encode())
    return out


def siblings(levels: list[bytes], at: int) -> tuple[bytes, bytes]:
    """The others of each run on the way up from node ``at``, and for each level the place in the run and their number."""
    found, spots = [], bytearray()
    for below in levels[:-1]:
        run, own = at // FAN, at % FAN
        whole = below[64 * FAN * run:64 * FAN * (run + 1)]
        found.append(whole[:64 * own] + whole[64 * own + 64:])
        spots += bytes([own, len(whole) // 64 - 1])
        at = run
    return b"".join(found), bytes(spots)


def folded(node: bytes, proof: bytes, spots: bytes) -> bytes:
    """The root that the node and its siblings give."""
    at = 0
    for own, n in zip(spots[::2], spots[1::2], strict=True):
        run = proof[at:at + 64 * n]
        node = sha256(run[:64 * own] + node + run[64 * own:]).hexdigest().encode()
        at += 64 * n
    return node


def _slotted(parts: Iterator[tuple[bytes, bytes]], n: int) -> np.ndarray:
    """Values of 32 bytes in an array by their slots."""
    out = np.zeros(n, dtype="S32")
    raw = out.view(np.uint8).reshape(n, 32)
    for slots, values in parts:
        raw[np.frombuffer(slots, "<u2")] = np.frombuffer(values, np.uint8).reshape(-1, 32)
    return raw


def _grouped(nodes: DataFrame, chunk: int) -> DataFrame:
    """``key, size, chunk, nodes`` of the nodes ``(key, size, at, node)``; at most ``chunk`` of them in a row."""
    slot = F.pmod("at", F.lit(chunk)).cast("int")
    return nodes.groupBy("key", "size", F.floor(F.col("at") / chunk).cast("long").alias("chunk")).agg(
        F.collect_list(F.struct(slot.alias("slot"), "node")).alias("nodes")
    )


def _hexes(nodes: list[dict]) -> bytes:
    out: list[str] = [""] * len(nodes)
    for x in nodes:
        out[x["slot"]] = x["node"]
    return "".join(out).encode()


def _tops(chunks: DataFrame, depth: int) -> DataFrame:
    """The nodes above the chunks, as ``key, size, at, node``."""
    def climb(batches):
        for rows in batches:
            tops = [reduced(_hexes(x["nodes"]), levels_of(x["size"], depth))[-1].decode() for x in rows.select(["size", "nodes"]).to_pylist()]
            above = [-(-x // FAN**depth) for x in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(above, pa.int64()), rows.column(2), pa.array(tops, pa.string())], ["key", "size", "at", "node"]
            )

    return chunks.mapInArrow(climb, "key string, size bigint, at bigint, node string")


def _tails(chunks: DataFrame, above: DataFrame, depth: int) -> DataFrame:
    """``key, at, tail, spots``: for each node of the chunks its siblings and those above the chunk."""
    def descend(batches):
        for rows in batches:
            out = []
            for x in rows.to_pylist():
                levels = reduced(_hexes(x["nodes"]), levels_of(x["size"], depth))
                for i in range(len(x["nodes"])):
                    proof, spots = siblings(levels, i)
                    out.append((x["key"], x["chunk"] * FAN**depth + i, proof + x["tail"], spots + x["spots"]))
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], ["key", "at", "tail", "spots"])

    joined = chunks.join(above.withColumnRenamed("at", "chunk"), ["key", "chunk"])
    return joined.select("key", "size", "chunk", "nodes", "tail", "spots").mapInArrow(
        descend, "key string, at bigint, tail binary, spots binary"
    )


def _climbed(nodes: DataFrame, most: int, depth: int) -> tuple[DataFrame, list[DataFrame]]:
    """One node for each key, and the chunks of each round on the way; ``most`` nodes has a key at most."""
    rounds = []
    while most > 1:
        rounds.append(materialise(_grouped(nodes, FAN**depth)))
        nodes, most = _tops(rounds[-1], depth), -(-most // FAN**depth)
    return nodes, rounds


def _descended(start: DataFrame, rounds: list[DataFrame], depth: int) -> DataFrame:
    for chunks in reversed(rounds):
        start = _tails(chunks, start, depth)
    return start


# --- Manifest -------------------------------------------------------------------------------------------------

_SCHEMA = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(
    docs: DataFrame, columns: list[str], tampered: dict[str, Column], touched: Column, doc_id: str = "doc_id",
    source: str = "source", depth: int = DEPTH,
) -> DataFrame:
    """For every row its leaf, the roots, its proof's hash, and whether the row as ``tampered`` still gives the root.

    A leaf is the hash of ``columns`` in their order. Where ``touched`` holds (null counts as no), the columns of
    ``tampered`` take those values before the row is hashed again; ``folded_root`` is folded from that leaf and
    the original siblings. Rows of a null source are a source of their own, which comes first. A null doc_id
    comes before all others; rows with equal ids of a source are ordered by their hashes. An empty table gives
    no rows. Ids are whole numbers of 64 bits. ``depth`` levels are reduced at a time, at most four.
    """
    spark = docs.sparkSession
    one = leaf_hash([F.col(x) for x in columns])
    other = leaf_hash([tampered.get(x, F.col(x)) for x in columns])
    leaves = docs.select(
        # An order-preserving text that is never null.
        F.when(F.col(source).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source))).alias("key"),
        F.col(doc_id).cast("long").alias("doc_id"), one.alias("leaf"), F.when(touched, other).alias("altered"),
    )
    path = scratch_path(spark, "manifest")
    _pages(in_small_batches(leaves)).write.parquet(path)
    pages = spark.read.parquet(path)
    based = materialise(_with_base(_containers(pages)))
    most = based.agg(F.max("size")).first()[0]
    if most is None:
        return spark.createDataFrame([], _SCHEMA)
    path = scratch_path(spark, "manifest")
    (
        _placed(pages, based, FAN**depth).groupBy("key", "size", "chunk")
        .agg(F.collect_list(F.struct(*_RUN_NAMES)).alias("runs")).write.parquet(path)
    )
    chunks = spark.read.parquet(path)
    subroots, rounds = _climbed(materialise(_chunk_tops(chunks, depth)), -(-most // FAN**depth), depth)
    ordered = materialise(_numbered(subroots.select("key", F.col("node").alias("subroot")).orderBy("key")))
    number = ordered.count()
    sources = ordered.select(F.lit("").alias("key"), F.lit(number).cast("long").alias("size"), F.col("ordinal").alias("at"), F.col("subroot").alias("node"))
    top, over = _climbed(sources, number, depth)
    root = top.first().node
    none = F.lit(b"")
    start = spark.range(1).select(F.lit("").alias("key"), F.lit(0).cast("long").alias("at"), none.alias("tail"), none.alias("spots"))
    by_source = _descended(start, over, depth).select(F.col("at").alias("ordinal"), "tail", "spots")
    named = materialise(ordered.join(by_source, "ordinal").select("key", "subroot", "tail", "spots"))
    tails = _descended(named.select("key", F.lit(0).cast("long").alias("at"), "tail", "spots"), rounds, depth)
    return _proofs(chunks, tails, named.select("key", "subroot"), root, depth)


def _chunk_leaves(row: dict, depth: int) -> tuple[np.ndarray, bytes, list[bytes]]:
    """The leaves of a chunk by slot, the same in hexadecimal digits, and all its levels."""
    n = min(FAN**depth, row["size"] - row["chunk"] * FAN**depth)
    leaves = _slotted(((x["slots"], x["leaves"]) for x in row["runs"]), n)
    text = leaves.tobytes().hex().encode()
    return leaves, text, reduced(text, levels_of(row["size"], depth))


def _chunk_tops(chunks: DataFrame, depth: int) -> DataFrame:
    def climb(batches):
        for rows in batches:
            tops = [_chunk_leaves(x, depth)[2][-1].decode() for x in rows.to_pylist()]
            above = [-(-x // FAN**depth) for x in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(above, pa.int64()), rows.column(2), pa.array(tops, pa.string())], ["key", "size", "at", "node"]
            )

    runs = F.transform("runs", lambda x: F.struct(x["slots"].alias("slots"), x["leaves"].alias("leaves"))).alias("runs")
    return in_small_batches(chunks.select("key", "size", "chunk", runs)).mapInArrow(climb, "key string, size bigint, at bigint, node string")


def _proofs(chunks: DataFrame, tails: DataFrame, named: DataFrame, root: str, depth: int) -> DataFrame:
    def prove(batches):
        for rows in batches:
            for row in rows.to_pylist():
                yield one(row)

    def one(row):
        leaves, text, levels = _chunk_leaves(row, depth)
        n, tail, spots = len(leaves), row["tail"], row["spots"]
        others = _slotted(((x["slots"], x["altered"]) for x in row["runs"]), n).tobytes().hex().encode()
        ids, known, touched = np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n, bool)
        for x in row["runs"]:
            slots = np.frombuffer(x["slots"], "<u2")
            ids[slots], known[slots] = np.frombuffer(x["ids"], "<i8"), np.frombuffer(x["known"], bool)
            touched[slots] = np.frombuffer(x["touched"], bool)
        above: dict[bytes, str] = {}
        proofs, ends = [], []
        for i in range(n):
            proof, own = siblings(levels, i)
            proofs.append(sha256(proof + tail).hexdigest())
            node = folded((others if touched[i] else text)[64 * i:64 * i + 64], proof, own)
            if node not in above:
                above[node] = folded(node, tail, spots).decode()
            ends.append(above[node])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, mask=~known), pa.array([text[i:i + 64].decode() for i in range(0, len(text), 64)], pa.string()),
                pa.array([row["subroot"]] * n, pa.string()), pa.array([root] * n, pa.string()), pa.array(proofs, pa.string()),
                pa.array(ends, pa.string()), pa.array([x == root for x in ends], pa.bool_()),
            ],
            [x.split()[0] for x in _SCHEMA.split(", ")],
        )

    joined = chunks.join(tails.withColumnRenamed("at", "chunk"), ["key", "chunk"]).join(named, "key")
    return in_small_batches(joined.select("key", "size", "chunk", "runs", "tail", "spots", "subroot")).mapInArrow(prove, _SCHEMA)
