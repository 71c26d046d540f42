"""Packing token sequences by best-fit decreasing.

A document is tokenised whole and cut into full windows; what is left over, shorter than a window, is packed
with the left-overs of other documents: longest first, each into the open window with the least room that
still fits. A segment tree over the remaining room finds that window in logarithmic time. Left-overs are
dealt at random to shards of a fixed size, and a shard is packed in one task, so neither the driver nor a
task holds more than a shard.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattlake.llm.common import in_small_batches, lists
from wattlake.session import materialise

WINDOW = 1024
END = 0
#: Left-overs packed together. More of them leave less padding; this many take 16 MB at most,
#: or 32 MB where the vocabulary is larger than 65,536.
SHARD = 8192


OUTPUT = ["doc_id", "start", "ids", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class RoomTree:
    """A segment tree over room sizes 0..largest; a leaf counts the open windows with that room."""

    def __init__(self, largest: int) -> None:
        self.width = 1 << largest.bit_length()
        self.count = [0] * (2 * self.width)

    def add(self, room: int, change: int) -> None:
        node = room + self.width
        while node:
            self.count[node] += change
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest room of at least ``need`` that an open window has."""
        node = need + self.width
        if self.count[node]:
            return need
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.width:
                    node = 2 * node + (not self.count[2 * node])
                return node - self.width
            node >>= 1
        return None


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece; windows are numbered as they are opened, pieces of a length in order."""
    tree, open_ = RoomTree(window), [deque() for _ in range(window + 1)]
    place, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    opened = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        room = tree.tightest(need)
        if room is None:
            room, where = window, opened
            opened += 1
        else:
            where = open_[room].popleft()
            tree.add(room, -1)
        place[i], offset[i] = where, window - room
        if room > need:
            open_[room - need].append(where)
            tree.add(room - need, 1)
    return place, offset


class Encoder:
    """Ids as the tokenizer file gives them, without special tokens added.

    The rank file holds the same vocabulary and merges and is several times faster. Only a text that spells
    a special token, which the tokenizer file maps to that token's id, goes through the file itself.
    """

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None) -> None:
        self.vocabulary, self.slow = vocabulary, None
        with open(vocabulary, encoding="utf-8") as lines:
            self.special = [token["content"] for token in json.load(lines)["added_tokens"]]
        self.fast = None
        if ranks is not None:
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        text = text or ""
        if self.fast is None or any(token in text for token in self.special):
            if self.slow is None:
                self.slow = Tokenizer.from_file(self.vocabulary)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


@lru_cache(maxsize=2)
def _encoder(vocabulary: str, ranks: str | None, pattern: str | None) -> Encoder:
    return Encoder(vocabulary, ranks, pattern)


def pack(
    docs: DataFrame,
    vocabulary: str,
    ranks: str | None = None,
    pattern: str | None = None,
    window: int = WINDOW,
    end: int = END,
    doc_id: str = "doc_id",
    text: str = "text",
    shard: int = SHARD,
) -> DataFrame:
    """Pieces ``doc_id, start, ids, length, ids_crc32, doc_tokens, sequence_id, offset`` of sequences of at most
    ``window`` ids. ``ids_crc32`` is of the ids as little-endian unsigned 32-bit numbers.

    Every row of ``docs`` is a document of its own: its ids and then ``end``. A null text counts as empty, so
    such a document is the end id alone. Repeated rows and null ids are packed like others. A sequence
    starts at offset 0 and has no gaps. Documents of the same length are taken in the order of their ids.
    Windows that a document fills on its own are never shuffled.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(source.dtypes)["doc_id"]
    narrow = Tokenizer.from_file(vocabulary).get_vocab_size() <= 1 << 16
    code = np.dtype("<u2" if narrow else "<u4")  # of the ids on their way

    def cut(batches):
        encoder = _encoder(vocabulary, ranks, pattern)
        for rows in batches:
            own, starts, pieces, totals = [], [], [], []
            held = 0
            for i, value in enumerate(rows.column(1)):
                ids = np.append(encoder.ids(value.as_py()), end).astype(code)
                for start in range(0, len(ids), window):
                    own.append(i)
                    starts.append(start)
                    pieces.append(ids[start:start + window].tobytes())
                    totals.append(len(ids))
                held += len(ids)
                if held > 1 << 20:
                    yield batch(rows, own, starts, pieces, totals)
                    own, starts, pieces, totals = [], [], [], []
                    held = 0
            yield batch(rows, own, starts, pieces, totals)

    def batch(rows, own, starts, pieces, totals):
        return pa.RecordBatch.from_arrays(
            [
                rows.column(0).take(pa.array(own, pa.int32())), pa.array(starts, pa.int64()),
                pa.array(pieces, pa.binary()), pa.array(totals, pa.int64()),
            ],
            ["doc_id", "start", "ids", "doc_tokens"],
        )

    def fit(table):
        order = table.select(["doc_id", "start"]).append_column("n", pa.array(np.arange(table.num_rows)))
        table = table.take(order.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("n", "ascending")])["n"])
        lengths = pc.binary_length(table["ids"]).to_numpy() // code.itemsize
        place, offset = best_fit_decreasing(lengths, window)
        sequence = (table["shard"].to_numpy() * shard * 64 + place) * 2 + 1
        return table.drop_columns(["shard"]).append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offset)
        )

    def spread(batches):
        for rows in batches:
            doc, start, raw, totals, sequence, offset = rows.columns
            ids = [np.frombuffer(value, code) for value in raw.to_pylist()]
            sums = pa.array([zlib.crc32(x.astype("<u4")) for x in ids], pa.int64())
            sizes = pa.array([len(x) for x in ids], pa.int64())
            arrays = [doc, start, lists(ids, pa.int32()), sizes, sums, totals, sequence, offset]
            yield pa.RecordBatch.from_arrays(arrays, OUTPUT)

    columns = f"doc_id {kind}, start bigint, ids {{}}, doc_tokens bigint"
    places = ", sequence_id bigint, offset bigint"
    pieces = materialise(
        in_small_batches(source).mapInArrow(cut, columns.format("binary"))
        .withColumn("full", F.octet_length("ids") == window * code.itemsize)
        .withColumn("place", F.monotonically_increasing_id())
    )
    full = pieces.where("full").select(
        "doc_id", "start", "ids", "doc_tokens", (F.col("place") * 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    left = pieces.where("not full")
    shards = max(1, round(left.count() / shard))
    dealt = left.select("doc_id", "start", "ids", "doc_tokens", F.pmod(F.xxhash64("doc_id", "place"), F.lit(shards)).alias("shard"))
    packed = dealt.groupBy("shard").applyInArrow(fit, columns.format("binary") + places)
    schema = f"doc_id {kind}, start bigint, ids array<int>, length bigint, ids_crc32 bigint, doc_tokens bigint" + places
    return full.union(packed).mapInArrow(spread, schema)
