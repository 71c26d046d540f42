"""Near-duplicate vectors, found with hierarchical navigable small-world graphs.

The vectors of a label are dealt into shards. A task builds the graph of one shard and searches it with a
chunk of the label's vectors; over all tasks every vector queries every shard of its label. Beams start
narrow. They are doubled for all queries until an audit, queries compared with the whole shard, finds every
link the beam should have, and for single queries until the beam reaches below the threshold. A query whose
neighbourhood is larger than the widest beam is compared with the whole shard. Found pairs are verified by
their cosine in double precision; equal vectors are one node.

Searches and insertions run for many vectors at a time in numpy: each step expands the best open candidates
of all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.components import connected_components, least_of_component, spanning_links
from wattlake.session import materialise

#: Vectors in a graph, and queries of one task.
SHARD, CHUNK = 32_768, 65_536
DEGREE = 12
BUILD_BEAM, UPPER_BEAM, FIRST_BEAM, WIDEST_BEAM = 48, 12, 32, 256
#: Queries of a task that are compared with the whole shard, and the share of their links that must be found.
AUDIT, RECALL = 256, 0.999
_EXPAND = 4
_CELLS = 1 << 23


class Graph:
    """A graph over unit vectors; ``near[level][i]`` are the neighbours of i there, -1 where there are fewer."""

    def __init__(self, vectors: np.ndarray, seed: int = 11) -> None:
        n = len(vectors)
        self.vectors = vectors.astype(np.float32)
        rng = np.random.default_rng(seed)
        self.level = np.minimum(-np.log(rng.random(n) + 1e-300) / np.log(DEGREE), 12).astype(np.int64)
        self.near = [np.full((n, DEGREE * (2 if h == 0 else 1)), -1, np.int32) for h in range(int(self.level.max(initial=0)) + 1)]
        order = rng.permutation(n)
        self.entry = -1
        done = 0
        while done < n:
            batch = order[done:done + min(1024, max(32, done // 2))]
            self._insert(batch)
            done += len(batch)
        if n:
            self._reach_all()

    def _reach_all(self) -> None:
        """Gives every vector that no path leads to a link from one of its neighbours, in columns of their own."""
        near = self.near[0]
        reached = np.zeros(len(near), dtype=bool)
        extra: dict[int, list[int]] = {}
        front = np.array([self.entry])
        while True:
            while len(front):
                reached[front] = True
                step = np.unique(near[front])
                front = step[(step >= 0) & ~reached[np.maximum(step, 0)]]
            lost = np.flatnonzero(~reached)
            if not len(lost):
                break
            open_ = (near[lost] >= 0) & reached[near[lost]]
            some = open_.any(axis=1)
            if not some.any():
                lost, some, open_ = lost[:1], np.array([False]), open_[:1]
            for node, has, places in zip(lost, some, open_, strict=True):
                if has or not some.any():
                    host = int(near[node][places.argmax()]) if has else self.entry
                    extra.setdefault(host, []).append(int(node))
            front = lost[some] if some.any() else lost
        if extra:
            wide = np.full((len(near), max(map(len, extra.values()))), -1, np.int32)
            for host, nodes in extra.items():
                wide[host, :len(nodes)] = nodes
            self.near[0] = np.concatenate([near, wide], axis=1)

    def _insert(self, batch: np.ndarray) -> None:
        """Links new vectors with what the graph finds for them, and with each other."""
        top = int(self.level[batch].max())
        queries = self.vectors[batch]
        found = np.full((len(batch), 1), self.entry, dtype=np.int64)
        highest = len(self.near) - 1 if self.entry < 0 else int(self.level[self.entry])
        among = queries @ queries.T
        for h in range(max(top, highest), -1, -1):
            if self.entry >= 0 and h <= highest:
                beam = BUILD_BEAM if (self.level[batch] >= h).any() else UPPER_BEAM
                found, _ = self._search_level(queries, found, beam, h)
            rows = np.flatnonzero(self.level[batch] >= h)
            if not len(rows):
                continue
            peers = batch[rows]
            k = min(len(rows), BUILD_BEAM)
            near = among[np.ix_(rows, rows)]
            close = np.argpartition(-near, k - 1, axis=1)[:, :k]
            options = peers[close]
            if self.entry >= 0 and h <= highest:
                options = np.concatenate([options, found[rows]], axis=1)
            width = DEGREE if h else 2 * DEGREE
            self.near[h][peers] = self._diverse(peers, options, width)
            self._link_back(peers, h)
        best = batch[np.argmax(self.level[batch])]
        if self.entry < 0 or self.level[best] > self.level[self.entry]:
            self.entry = int(best)

    def _diverse(self, nodes: np.ndarray, options: np.ndarray, width: int) -> np.ndarray:
        """Up to ``width`` of each node's options, nearest first; those nearer to one taken come last."""
        out = np.full((len(nodes), width), -1, np.int32)
        for start in range(0, len(nodes), step := max(1, _CELLS // (options.shape[1] * 64))):
            node, option = nodes[start:start + step], np.sort(options[start:start + step], axis=1)
            same = np.concatenate([np.zeros((len(node), 1), bool), option[:, 1:] == option[:, :-1]], axis=1)
            option = np.where(same | (option == node[:, None]), -1, option)
            near = np.einsum("nd,nkd->nk", self.vectors[node], self.vectors[option])
            near[option < 0] = -np.inf
            rank = np.argsort(-near, axis=1, kind="stable")[:, :4 * width]
            option, near = np.take_along_axis(option, rank, 1), np.take_along_axis(near, rank, 1)
            between = np.matmul(self.vectors[option], self.vectors[option].transpose(0, 2, 1))
            taken = np.zeros(option.shape, dtype=bool)
            for k in range(option.shape[1]):
                hidden = (taken & (between[:, k] > near[:, k, None])).any(axis=1)
                taken[:, k] = (option[:, k] >= 0) & ~hidden
            order = np.argsort(np.where(option < 0, 2, ~taken), axis=1, kind="stable")[:, :width]
            kept = np.take_along_axis(option, order, 1)
            out[start:start + step, :kept.shape[1]] = kept
        return out

    def _link_back(self, peers: np.ndarray, h: int) -> None:
        """Adds the new vectors to the lists of those that they link to; full lists are chosen anew."""
        width = self.near[h].shape[1]
        source, target = np.repeat(peers, width), self.near[h][peers].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for size in (width, 4 * width, len(source)):
            some = count <= size
            if some.any():
                within = np.arange(size if size < len(source) else int(count[some].max()))
                spots = np.minimum(first[some, None] + within, len(source) - 1)
                fresh = np.where(within < count[some, None], source[spots], -1)
                options = np.concatenate([self.near[h][nodes[some]], fresh], axis=1)
                self.near[h][nodes[some]] = self._diverse(nodes[some], options, width)
            nodes, first, count = nodes[~some], first[~some], count[~some]

    def _search_level(self, queries: np.ndarray, entry: np.ndarray, beam: int, h: int) -> tuple[np.ndarray, np.ndarray]:
        step = max(1, _CELLS // len(self.vectors))
        parts = [self._beam(queries[s:s + step], entry[s:s + step], beam, h) for s in range(0, len(queries), step)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _beam(self, queries: np.ndarray, entry: np.ndarray, beam: int, h: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` that each query reaches from its entries, with their cosines; -1 where fewer."""
        q, near = len(queries), self.near[h]
        seen = np.zeros((q, len(self.vectors)), dtype=bool)
        ids = np.full((q, beam), -1, dtype=np.int64)
        close = np.full((q, beam), -np.inf, dtype=np.float32)
        done = np.ones((q, beam), dtype=bool)
        live, fresh = np.arange(q), entry
        while len(live):
            fresh = np.sort(fresh, axis=1)
            valid = fresh >= 0
            valid[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
            valid &= ~seen[live[:, None], fresh]
            row, column = np.nonzero(valid)
            seen[live[row], fresh[row, column]] = True
            cosine = np.full(fresh.shape, -np.inf, dtype=np.float32)
            cosine[row, column] = np.einsum("nd,nd->n", queries[live[row]], self.vectors[fresh[row, column]])
            all_close = np.concatenate([close[live], cosine], axis=1)
            all_ids = np.concatenate([ids[live], np.where(valid, fresh, -1)], axis=1)
            all_done = np.concatenate([done[live], ~valid], axis=1)
            best = np.argpartition(-all_close, beam - 1, axis=1)[:, :beam] if all_close.shape[1] > beam else None
            if best is not None:
                all_close, all_ids, all_done = (np.take_along_axis(x, best, 1) for x in (all_close, all_ids, all_done))
            pad = beam - all_ids.shape[1]
            if pad > 0:
                all_close = np.pad(all_close, ((0, 0), (0, pad)), constant_values=-np.inf)
                all_ids = np.pad(all_ids, ((0, 0), (0, pad)), constant_values=-1)
                all_done = np.pad(all_done, ((0, 0), (0, pad)), constant_values=True)
            open_ = np.where(all_done, -np.inf, all_close)
            wide = min(_EXPAND, beam)
            pick = np.argpartition(-open_, wide - 1, axis=1)[:, :wide]
            chosen = np.isfinite(np.take_along_axis(open_, pick, 1))
            nodes = np.where(chosen, np.take_along_axis(all_ids, pick, 1), -1)
            np.put_along_axis(all_done, pick, True, 1)
            ids[live], close[live], done[live] = all_ids, all_close, all_done
            more = chosen.any(axis=1)
            live, nodes = live[more], nodes[more]
            fresh = np.where(nodes[:, :, None] >= 0, near[nodes], -1).reshape(len(live), wide * near.shape[1]).astype(np.int64)
        return ids, close

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the best ``beam`` that are found for each query."""
        queries = queries.astype(np.float32)
        found = np.full((len(queries), 1), self.entry, dtype=np.int64)
        for h in range(int(self.level[self.entry]), 0, -1):
            found, _ = self._search_level(queries, found, UPPER_BEAM, h)
        return self._search_level(queries, found, beam, 0)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _whole(queries: np.ndarray, members: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block of queries and all members with at least that cosine."""
    rows, columns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in range(0, len(queries), step := max(1, _CELLS // max(1, len(members)))):
        r, c = np.nonzero(queries[start:start + step] @ members.T >= least)
        rows.append(r + start)
        columns.append(c)
    return np.concatenate(rows), np.concatenate(columns)


def links_in_shard(members: np.ndarray, queries: np.ndarray, threshold: float):
    """Yields pairs (query, member) with at least that cosine, for unit vectors, without repeats.

    Pairs of one query come in one yield.
    """
    graph = Graph(members)
    rough = threshold - 1e-4  # the graph's cosines are of single precision
    audited = np.unique(np.linspace(0, len(queries) - 1, min(AUDIT, len(queries))).astype(np.int64))
    true = np.bincount(_whole(queries[audited], members, threshold)[0], minlength=len(audited))
    beam = FIRST_BEAM
    while beam <= WIDEST_BEAM:
        _, close = graph.search(queries[audited], beam)
        reached = np.minimum((close >= rough).sum(axis=1), np.minimum(true, beam)).sum()
        if reached >= RECALL * np.minimum(true, beam).sum():
            break
        beam *= 2
    open_ = np.arange(len(queries))
    while len(open_) and beam <= WIDEST_BEAM:
        after = []
        for start in range(0, len(open_), 4096):
            own = open_[start:start + 4096]
            ids, close = graph.search(queries[own], beam)
            full = (close >= rough).all(axis=1) & (beam < len(members))
            after.append(own[full])
            row, column = np.nonzero((close >= rough) & ~full[:, None])
            yield own[row], ids[row, column]
        open_ = np.concatenate(after)
        beam *= 2
    for start in range(0, len(open_), step := max(1, _CELLS // len(members))):
        row, column = _whole(queries[open_[start:start + step]], members, rough)
        yield open_[start:start + step][row], column


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(whole), -1)


def near_duplicate_vectors(
    vectors: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    shard: int = SHARD, chunk: int = CHUNK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Rows are linked if their labels are equal and not null, their vectors have as many components, and the
    cosine is at least ``threshold``. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing. ``n_links`` counts other rows; repeated rows are other rows with the same
    id. ``component_id`` is the smallest id reached; rows with a null id take part but name no component
    that has another id. ``kept`` says whether the row's id is its component's.
    """
    finite = F.coalesce(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    able = F.col("label").isNotNull() & finite & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    rows = materialise(
        vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("v"), F.col(label).alias("label"))
        .withColumn("able", able)
    )
    nodes = materialise(
        rows.where("able").groupBy("label", "v").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
        .withColumns({"node": F.monotonically_increasing_id(), "size": F.size("v")})
    )
    counts = nodes.groupBy("label", "size").agg(
        F.ceil(F.count("*") / shard).cast("int").alias("shards"), F.ceil(F.count("*") / chunk).cast("int").alias("chunks")
    )
    placed = nodes.join(counts, ["label", "size"])
    spot = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = placed.withColumn("shard", spot(1, "shards")).withColumn("chunk", every("chunks"))
    queries = placed.withColumn("chunk", spot(2, "chunks")).withColumn("shard", every("shards"))
    columns = ["label", "size", "shard", "chunk", "node", "copies", "v"]
    units = members.select(*columns, F.lit(True).alias("member")).union(queries.select(*columns, F.lit(False)))

    def link(table):
        is_member = table["member"].to_numpy()
        node, copies, v = table["node"].to_numpy(), table["copies"].to_numpy(), _vectors(table["v"])
        # In a fixed order, so that a repeated task builds the same graph.
        order = np.lexsort((node, ~is_member))
        node, copies, v, m = node[order], copies[order], v[order], int(is_member.sum())
        own, asked = unit(v[:m]), unit(v[m:])
        ids, at = np.unique(node, return_inverse=True)
        links = np.zeros(len(asked), dtype=np.int64)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for q, c in links_in_shard(own, asked, threshold) if m and len(asked) else ():
            for start in range(0, len(q), 1 << 18):
                a, b = q[start:start + (1 << 18)], c[start:start + (1 << 18)]
                good = (np.einsum("nd,nd->n", asked[a], own[b]) >= threshold) & (node[m + a] != node[b])
                a, b = a[good], b[good]
                np.add.at(links, a, copies[b])
                y, x = spanning_links(len(ids), np.concatenate([*left, at[m + a]]), np.concatenate([*right, at[b]]))
                left, right = [x], [y]
        found = np.flatnonzero(links)
        a, b = left[0], right[0]
        return pa.table({
            "node": pa.array(np.concatenate([node[m + found], ids[b]]), pa.int64()),
            "links": pa.array(np.concatenate([links[found], np.zeros(len(b), np.int64)]), pa.int64()),
            "other": pa.array(np.concatenate([node[m + found], ids[a]]), pa.int64()),
        })

    found = materialise(
        units.groupBy("label", "size", "shard", "chunk").applyInArrow(link, "node bigint, links bigint, other bigint")
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    pairs = found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b"))
    groups = least_of_component(nodes.select("node", "least"), connected_components(pairs))
    known = nodes.join(links, "node", "left").join(groups.withColumnRenamed("least", "component_id"), "node").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    linked = rows.where("able").join(known, ["label", "v"]).select("id", "n_links", "component_id")
    alone = rows.where("not able").select("id", F.lit(0).cast("long"), "id")
    return linked.union(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
