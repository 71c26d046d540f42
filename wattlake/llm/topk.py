"""Exact top-k by inner product: candidates in buckets of like length, pruned by local cosine thresholds.

Candidates are grouped by the logarithm of their length and cut into buckets of a fixed size; queries into
blocks. Each query first gets a bound, its k-th best product in one bucket of the longest vectors. A block
then meets only the buckets long enough for one of its queries. In a bucket a query's bound, divided by its
own and the bucket's greatest length, is the least cosine that can still reach the result. If that is high,
the bucket is pruned by the query's largest coordinate: only candidates whose direction lies within the
angle there are left. If it is low, the bucket is pruned by length. What is left is verified by the product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import in_small_batches
from wattlake.session import materialise

BUCKET, BLOCK = 4096, 512
#: Lengths in one class differ by at most this factor.
LENGTH_STEP = 1.1
#: From this local cosine on a bucket is pruned by coordinate.
COORDINATE_FROM = 0.5
_SLACK = 1e-9
#: Sums below this are exact in double precision.
_EXACT = 2.0**53


def scaled(vector: Column, scale: int = 64) -> Column:
    """``floor(scale * x)`` of each component; null for a vector that is null or holds null or non-finite ones."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors of one length as rows."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products; through double precision where that is exact."""
    if not queries.shape[1]:
        return np.zeros((len(queries), len(candidates)), np.int64)
    greatest = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * queries.shape[1]
    if greatest < _EXACT:
        return np.rint(queries.astype(np.float64) @ candidates.T.astype(np.float64)).astype(np.int64)
    return queries @ candidates.T


def lengths(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    return np.sqrt((wide * wide).sum(axis=1))


class Bucket:
    """Candidates of like length, longest first, with sorted coordinates made when first needed."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        length = lengths(vectors)
        order = np.argsort(-length, kind="stable")
        self.ids, self.vectors, self.lengths = ids[order], vectors[order], length[order]
        self.directions = self.vectors / np.where(self.lengths == 0, 1, self.lengths)[:, None]
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def left_by_length(self, bound: float, length: float) -> np.ndarray:
        """Places of candidates that are long enough for the bound."""
        if bound <= 0 or length == 0:
            return np.arange(len(self.ids))
        least = bound / length * (1 - _SLACK)
        return np.arange(np.searchsorted(-self.lengths, -least, side="right"))

    def left_by_coordinate(self, cosine: float, direction: np.ndarray) -> np.ndarray:
        """Places of candidates whose focus coordinate allows a cosine of at least ``cosine``."""
        focus = int(np.argmax(np.abs(direction)))
        if focus not in self.sorted:
            order = np.argsort(self.directions[:, focus], kind="stable")
            self.sorted[focus] = order, self.directions[order, focus]
        order, values = self.sorted[focus]
        angle, reach = np.arccos(np.clip(direction[focus], -1, 1)), np.arccos(min(1.0, cosine))
        low = np.cos(min(np.pi, angle + reach)) - _SLACK
        high = np.cos(max(0.0, angle - reach)) + _SLACK
        return order[np.searchsorted(values, low, "left"):np.searchsorted(values, high, "right")]

    def best(self, query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int):
        """Yields each query's place with the ids and products of its best k here that reach its bound.

        Ties go to the smaller id; of an id that occurs again, the best product counts.
        """
        own = lengths(queries)
        by_length: list[int] = []
        left: dict[int, np.ndarray] = {}
        for i, (length, bound) in enumerate(zip(own, bounds, strict=True)):
            longest = self.lengths[0] * length
            cosine = (bound / longest) * (1 - _SLACK) if bound > 0 and longest > 0 else -1.0
            if cosine > 1 or bound > 0 and longest == 0:
                continue
            if cosine >= COORDINATE_FROM:
                left[i] = self.left_by_coordinate(cosine, queries[i] / length)
            else:
                left[i] = self.left_by_length(bound, length)
                by_length.append(i)
        whole = {}
        if by_length:
            most = max(len(left[i]) for i in by_length)
            whole = dict(zip(by_length, products(queries[by_length], self.vectors[:most]), strict=True))
        for i, places in left.items():
            score = whole[i][places] if i in whole else products(queries[i:i + 1], self.vectors[places])[0]
            good = (score >= bounds[i]) & (self.ids[places] != query_ids[i])
            yield i, *_best(self.ids[places[good]], score[good], k)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        # Repeated ids could fill the first k places, so they are looked for only where there are some.
        some = scores >= least
        if len(np.unique(ids[some])) >= k:
            ids, scores = ids[some], scores[some]
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], scores[first]


def top_k(
    vectors: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64,
    bucket: int = BUCKET, block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best inner products of each query with all other rows.

    Ranks start at 1; ties go to the smaller id; fewer rows give fewer ranks. Rows with a null id, and vectors
    that are null or hold null or non-finite components, take no part. Rows of one id are one candidate, and
    one query, with the best of their products; a query's own id is no candidate. Only vectors of the same
    number of components are compared; vectors without components have product 0. Products are exact as long
    as they fit in a long.
    """
    rows = materialise(
        vectors.select(
            F.col(vec_id).cast("long").alias("id"), scaled(F.col(vector), scale).alias("v"), is_query.alias("query")
        )
        .where("id is not null and v is not null")
        .withColumns({"size": F.size("v"), "place": F.monotonically_increasing_id()})
        .withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x)))
        .withColumn("step", F.floor(F.log(F.greatest("length", F.lit(1.0))) / F.log(F.lit(LENGTH_STEP))).cast("int"))
    )
    classes = rows.groupBy("size", "step").agg(F.ceil(F.count("*") / bucket).alias("parts"))
    mixed = F.xxhash64("place")
    buckets = materialise(
        rows.join(classes, ["size", "step"])
        .groupBy("size", "step", F.pmod(mixed, F.col("parts")).alias("part"))
        .agg(F.max("length").alias("longest"), F.collect_list("id").alias("ids"), F.collect_list("v").alias("vs"))
    )
    queries = rows.where("query")
    blocks_of = queries.groupBy("size").agg(F.ceil(F.count("*") / block).alias("parts"))
    blocks = (
        queries.join(blocks_of, "size")
        .groupBy("size", F.pmod(mixed, F.col("parts")).alias("block"))
        .agg(F.collect_list("id").alias("query_ids"), F.collect_list("v").alias("qs"))
    )
    longest = buckets.groupBy("size").agg(F.max(F.struct("step", "part")).alias("b"))
    first = buckets.join(longest, "size").where("step = b.step and part = b.part").select("size", "ids", "vs")

    def bound(batches):
        for batch in batches:
            held = []
            for i in range(batch.num_rows):
                query_ids, queries, candidates = (batch.column(name)[i].values for name in ("query_ids", "qs", "vs"))
                query_ids, q = query_ids.to_numpy(), _matrix(queries)
                found = Bucket(batch.column("ids")[i].values.to_numpy(), _matrix(candidates))
                low = np.full(len(q), -np.inf)
                for j, ids, scores in found.best(query_ids, q, low.copy(), k):
                    if len(ids) == k:
                        low[j] = scores[-1]
                own = lengths(q)
                need = np.where((low > 0) & (own > 0), low / np.where(own == 0, 1, own), 0) * (1 - _SLACK)
                held.append((low, float(need.min())))
            kept = [batch.column(name) for name in ("size", "block", "query_ids", "qs")]
            low = pa.array([x[0].tolist() for x in held], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*kept, low, pa.array([x[1] for x in held], pa.float64())], ["size", "block", "query_ids", "qs", "low", "need"]
            )

    def search(batches):
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                query_ids = batch.column("query_ids")[i].values.to_numpy()
                low = batch.column("low")[i].values.to_numpy()
                own = Bucket(batch.column("ids")[i].values.to_numpy(), _matrix(batch.column("vs")[i].values))
                for j, ids, scores in own.best(query_ids, _matrix(batch.column("qs")[i].values), low, k):
                    found.append((np.full(len(ids), query_ids[j]), ids, scores))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found, strict=True)], ["query_id", "vec_id", "score"]
                )

    columns = "size int, block bigint, query_ids array<bigint>, qs array<array<bigint>>"
    bounded = materialise(
        blocks.join(first, "size").select("size", "block", "query_ids", "qs", "ids", "vs")
        .mapInArrow(bound, columns + ", low array<double>, need double")
    )
    # Every block with every bucket that its bounds leave: the stated queries against all rows, in blocks.
    pairs = bounded.join(buckets, "size").where("longest >= need").select("query_ids", "qs", "low", "ids", "vs")
    spread = pairs.repartition(F.col("query_ids")[0], F.col("ids")[0])
    found = in_small_batches(spread).mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
