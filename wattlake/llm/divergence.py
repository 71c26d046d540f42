"""How the sources of a language differ in their terms, recounted into slots of minimal perfect hashes.

First pass: the documents of a language that have a term are counted exactly, and the terms in enough of them
are kept. Kept terms are dealt to shards of bounded size; a task builds a minimal perfect hash for each: levels
of bits, a term standing at the first level where no other falls on its bit, and a popcount directory that
numbers the bits. The terms are stored by their slots, so a term that was not kept is told apart.

Second pass: shards are broadcast, as many at a time as fit a fixed budget, and each task looks up the terms of
its texts and holds the number of each slot that a group has met, however many slots the language has. What leaves a
task are blocks of slots' numbers, added up block by block.

Then shares are compared block by block of slots, all sources of a language side by side, in whole numbers.
"""

from __future__ import annotations

from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import in_small_batches
from wattlake.session import ensure_checkpoint_dir, materialise, scratch_path, small_table

#: Terms of a shard, bytes of shards broadcast at a time, slots of a block of the comparison.
SHARD, BUDGET, BLOCK = 32_768, 64 << 20, 1024
#: Counted terms and slots of groups that a worker holds before it hands them on; bytes of a text looked at together.
HELD_TERMS, HELD_SLOTS, BLOCK_BYTES = 400_000, 2 << 20, 1 << 20
#: Bits for each term at a level, and levels; terms with one and the same 64-bit hash are left and looked up by name.
SPARSE, LEVELS = 2, 40
SCALE = 1_000_000_000
_BLOCKS = "lang string, source string, block bigint, n bigint, slots binary, counts binary"
_SEED = 42  # the seed of Spark's own xxhash64
#: ASCII letters in lower case and all bytes above ASCII stay; the rest parts terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_blocks(text: bytes):
    """The terms of a text, block by block."""
    start = 0
    while start < len(text):
        end = min(start + BLOCK_BYTES, len(text))
        block = text[start:end].translate(_FOLD)
        while end < len(text) and block[-1] != 32:  # the last term goes on
            more = text[end:end + 4096].translate(_FOLD)
            stop = more.find(b" ")
            block += more if stop < 0 else more[:stop + 1]
            end += len(more) if stop < 0 else stop + 1
        yield block.split()
        start = end


def _mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    h = hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def term_hashes(terms: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(x, seed=_SEED) for x in terms), np.uint64, len(terms))


class PerfectHash:
    """Terms numbered 0..n-1 without gaps, with the terms themselves to verify a look-up."""

    def __init__(self, terms: list[bytes]) -> None:
        hashes = term_hashes(terms)
        rest, words, bits = np.arange(len(terms)), [], []
        slots = np.zeros(len(terms), dtype=np.int64)
        base = 0
        for level in range(LEVELS):
            if not len(rest):
                break
            n = SPARSE * len(rest) + 64 & ~63
            spot = (_mixed(hashes[rest], level) % np.uint64(n)).astype(np.int64)
            alone = np.bincount(spot, minlength=n) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            bits.append(n)
            own = alone[spot]
            slots[rest[own]] = base + (np.cumsum(alone) - alone)[spot[own]]
            base += int(own.sum())
            rest = rest[~own]
        slots[rest] = base + np.arange(len(rest))
        self.bits = bits
        self.words = np.concatenate(words) if words else np.zeros(0, "<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.named = {terms[i]: int(slots[i]) for i in rest.tolist()}
        by_slot = [b""] * len(terms)
        for term, slot in zip(terms, slots.tolist(), strict=True):
            by_slot[slot] = term
        self.terms = np.frombuffer(b"".join(by_slot), dtype=np.uint8)
        self.width = np.fromiter(map(len, by_slot), np.int32, len(by_slot))
        self.first = np.cumsum(self.width, dtype=np.int64) - self.width

    def by_slot(self) -> list[bytes]:
        whole = self.terms.tobytes()
        return [whole[a:a + n] for a, n in zip(self.first.tolist(), self.width.tolist(), strict=True)]

    def look_up(self, terms: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """Slots of the terms, -1 for those that are none of the stored ones."""
        slots = np.full(len(terms), -1, dtype=np.int64)
        open_, start = np.arange(len(terms)), 0
        for level, n in enumerate(self.bits):
            if not len(open_):
                break
            spot = (_mixed(hashes[open_], level) % np.uint64(n)).astype(np.int64)
            word, bit = (start + spot) >> 6, (spot & 63).astype(np.uint64)
            hit = (self.words[word] >> bit & np.uint64(1)).astype(bool)
            word, bit = word[hit], bit[hit]
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            slots[open_[hit]] = self.before[word] + np.bitwise_count(below)
            open_, start = open_[~hit], start + n
        found = np.flatnonzero(slots >= 0)
        widths = np.fromiter((len(terms[i]) for i in found.tolist()), np.int64, len(found))
        fits = self.width[slots[found]] == widths
        slots[found[~fits]] = -1
        found, widths = found[fits], widths[fits]
        if len(found):  # byte by byte
            mine = np.frombuffer(b"".join(terms[i] for i in found.tolist()), dtype=np.uint8)
            ends = np.cumsum(widths)
            spots = np.arange(ends[-1]) + np.repeat(self.first[slots[found]] - (ends - widths), widths)
            wrong = np.add.reduceat(self.terms[spots] != mine, ends - widths) > 0
            slots[found[wrong]] = -1
        if self.named:
            for i in np.flatnonzero(slots < 0).tolist():
                slots[i] = self.named.get(terms[i], -1)
        return slots

    def packed(self) -> dict[str, bytes]:
        named = self.named
        return {
            "bits": np.array(self.bits, "<i8").tobytes(), "words": self.words.tobytes(), "terms": self.terms.tobytes(),
            "width": self.width.astype("<i4").tobytes(), "rest": np.array(sorted(named.values()), "<i8").tobytes(),
        }

    @classmethod
    def unpacked(cls, row) -> PerfectHash:
        own = cls.__new__(cls)
        own.bits = np.frombuffer(row["bits"], "<i8").tolist()
        own.words = np.frombuffer(row["words"], "<u8")
        ones = np.bitwise_count(own.words).astype(np.int64)
        own.before = np.cumsum(ones) - ones
        own.terms, own.width = np.frombuffer(row["terms"], np.uint8), np.frombuffer(row["width"], "<i4")
        own.first = np.cumsum(own.width, dtype=np.int64) - own.width
        cut = lambda slot: own.terms[own.first[slot]:own.first[slot] + own.width[slot]].tobytes()
        own.named = {cut(slot): slot for slot in np.frombuffer(row["rest"], "<i8").tolist()}
        return own


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """``lang, term, hash``: the terms in at least ``least`` documents of the language, counted exactly."""
    def count(batches):
        held: dict[str, Counter] = {}
        for rows in batches:
            for lang, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                held.setdefault(lang, Counter()).update(set().union(*term_blocks(text)))
            if sum(map(len, held.values())) > HELD_TERMS:
                yield from counted(held)
                held = {}
        yield from counted(held)

    def counted(held):
        for lang, own in held.items():
            if own:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), pa.array(own.keys(), pa.binary()), pa.array(own.values(), pa.int64())],
                    ["lang", "term", "n"],
                )

    parts = docs.select("lang", "text").mapInArrow(count, "lang string, term binary, n bigint")
    kept = parts.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return kept.select("lang", "term", F.xxhash64("term").alias("hash"))


def _sizes(kept: DataFrame) -> DataFrame:
    """``lang, v, shards``: the kept terms of each language and over how many shards they are dealt."""
    rows = kept.groupBy("lang").agg(F.count("*").alias("v")).collect()  # a number for each language
    found = [{"lang": r.lang, "v": r.v, "shards": max(1, -(-r.v * 11 // (10 * SHARD)))} for r in rows]
    return small_table(kept.sparkSession, found, "lang string, v bigint, shards bigint")


def _shards(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, shard, n`` and the parts of each shard's perfect hash."""
    shard = F.pmod(F.shiftrightunsigned("hash", 24), F.col("shards")).alias("shard")
    dealt = kept.join(F.broadcast(sizes), "lang").select("lang", shard, "term")

    def build(table):
        own = PerfectHash(table["term"].to_pylist())
        parts = own.packed()
        return pa.table({
            "lang": table["lang"].slice(0, 1), "shard": table["shard"].slice(0, 1), "n": pa.array([table.num_rows], pa.int64()),
            **{name: pa.array([value], pa.binary()) for name, value in parts.items()},
        })

    path = scratch_path(kept.sparkSession, "divergence")
    columns = "lang string, shard bigint, n bigint, bits binary, words binary, terms binary, width binary, rest binary"
    dealt.groupBy("lang", "shard").applyInArrow(build, columns).write.parquet(path)
    return kept.sparkSession.read.parquet(path)


def _rounds(shards: DataFrame) -> list[list[tuple[str, int, int]]]:
    """Shards with their first slots, in turns whose bytes fit the budget; a shard stands for some 32,768 terms."""
    sizes = F.octet_length("words") * 2 + F.octet_length("terms") + F.octet_length("width") * 3
    rows = shards.select("lang", "shard", "n", sizes.cast("long").alias("bytes")).orderBy("lang", "shard").collect()
    turns, held = [], BUDGET
    for lang, own in groupby(rows, key=lambda r: r.lang):
        base = 0
        for r in own:
            if held + r.bytes > BUDGET:
                turns.append([])
                held = 0
            turns[-1].append((lang, r.shard, base))
            held, base = held + r.bytes, base + r.n
    return turns


def _recount(docs: DataFrame, shards: DataFrame, turn: list[tuple[str, int, int]], number: dict[str, int]) -> DataFrame:
    """``lang, source, block, n, slots, counts`` of the terms in the turn's shards, summed by task.

    ``slots`` are the places in the block of BLOCK slots, ``counts`` their numbers and ``n`` the sum of these.
    """
    spark = docs.sparkSession
    wanted = small_table(spark, [{"lang": x, "shard": s} for x, s, _ in turn], "lang string, shard bigint")
    rows = {(r.lang, r.shard): r for r in shards.join(F.broadcast(wanted), ["lang", "shard"]).collect()}
    tables: dict[str, dict] = {}
    for lang, shard, base in turn:
        tables.setdefault(lang, {})[shard] = (base, rows[lang, shard].asDict())
    shared = spark.sparkContext.broadcast((tables, number))  # at most BUDGET, and a number for each language

    def count(batches):
        parts, number = shared.value
        hashes = {lang: {s: (base, PerfectHash.unpacked(row)) for s, (base, row) in own.items()} for lang, own in parts.items()}
        first = {lang: min(base for base, _ in own.values()) for lang, own in hashes.items()}
        held = _Held(HELD_SLOTS)
        memo: dict[str, dict[bytes, int]] = {lang: {} for lang in hashes}  # slots of terms seen before

        def learn(lang: str, terms: list[bytes]) -> None:
            hashed, found = term_hashes(terms), np.full(len(terms), -1, dtype=np.int64)
            shard = (hashed >> np.uint64(24)) % np.uint64(number[lang])
            for s, (base, perfect) in hashes[lang].items():
                some = np.flatnonzero(shard == s)
                slots = perfect.look_up([terms[i] for i in some.tolist()], hashed[some])
                found[some] = np.where(slots >= 0, slots + (base - first[lang]), -1)
            memo[lang].update(zip(terms, found.tolist(), strict=True))

        for rows in batches:
            groups: dict[tuple[str, str], list[bytes]] = {}
            for lang, source, text in zip(*(x.to_pylist() for x in rows.columns), strict=True):
                if lang in hashes:
                    groups.setdefault((lang, source), []).append(text)
            for group, texts in groups.items():
                lang = group[0]
                for terms in term_blocks(b" ".join(texts)):
                    often = Counter(terms)
                    new = often.keys() - memo[lang].keys() if len(memo[lang]) < len(often) else [x for x in often if x not in memo[lang]]
                    if new:
                        if len(memo[lang]) + len(new) > HELD_TERMS:
                            memo[lang].clear()
                            new = often
                        learn(lang, list(new))
                    slots = np.fromiter(map(memo[lang].__getitem__, often), np.int64, len(often))
                    n = np.fromiter(often.values(), np.int64, len(often))
                    if held.add(group, slots[slots >= 0], n[slots >= 0]):
                        yield from told(held, first)
        yield from told(held, first)

    def told(held, first):
        for (lang, source), found, n in held.taken():
            slots = found + first[lang]
            yield _blocks_batch(lang, source, slots // BLOCK, slots % BLOCK, n)

    return docs.select("lang", "source", "text").mapInArrow(count, _BLOCKS)


class _Held:
    """Numbers by group and slot, added up whenever ``most`` of them stand beside each other."""

    def __init__(self, most: int) -> None:
        self.most, self.groups = most, {}
        self._start([], [])

    def _start(self, keys: list[np.ndarray], numbers: list[np.ndarray]) -> None:
        self.keys, self.numbers, self.size = keys, numbers, sum(map(len, keys))

    def add(self, group: tuple[str, str], slots: np.ndarray, n: np.ndarray) -> bool:
        """Whether so many slots are held, each once, that they should be taken."""
        place = self.groups.setdefault(group, len(self.groups))
        self.keys.append(slots + (place << 40))
        self.numbers.append(n)
        self.size += len(slots)
        if self.size < self.most:
            return False
        self._add_up()
        return self.size > self.most // 2

    def _add_up(self) -> None:
        keys, n = np.concatenate(self.keys), np.concatenate(self.numbers)
        self._start([], [])
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        self._start([keys[starts]], [np.add.reduceat(n, starts)])

    def taken(self):
        """The groups with their slots, ascending, and the numbers of these; nothing is held any more."""
        if not self.size:
            return
        self._add_up()
        (keys,), (n,), groups = self.keys, self.numbers, list(self.groups)
        self.groups = {}
        self._start([], [])
        cuts = [*np.flatnonzero(np.diff(keys >> 40, prepend=-1)).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield groups[int(keys[a]) >> 40], keys[a:b] & ((1 << 40) - 1), n[a:b]


def _blocks_batch(lang: str, source: str, block: np.ndarray, slot: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row for each block; the blocks ascend."""
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    cuts = [*starts.tolist(), len(block)]
    places, counts = slot.astype("<u4").tobytes(), n.astype("<i8").tobytes()
    slices = list(zip(cuts[:-1], cuts[1:], strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(starts), pa.string()), pa.array([source] * len(starts), pa.string()), pa.array(block[starts]),
            pa.array(np.add.reduceat(n, starts)), pa.array([places[4 * a:4 * b] for a, b in slices], pa.binary()),
            pa.array([counts[8 * a:8 * b] for a, b in slices], pa.binary()),
        ],
        ["lang", "source", "block", "n", "slots", "counts"],
    )


def _added(parts: DataFrame) -> DataFrame:
    """``parts`` with one row for each block of a group; rows of a block stand together, and one block is held."""
    def add(batches):
        own, total, done = None, np.zeros(BLOCK, dtype=np.int64), []
        for rows in batches:
            for *key, _, slots, counts in zip(*(x.to_pylist() for x in rows.columns), strict=True):
                if key != own:
                    if own is not None:
                        done.append(summed(own, total))
                        total[:] = 0
                    own = key
                total[np.frombuffer(slots, "<u4")] += np.frombuffer(counts, "<i8")
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                done = []
        if own is not None:
            yield summed(own, total)

    def summed(key, total):
        lang, source, block = key
        found = np.flatnonzero(total)
        return _blocks_batch(lang, source, np.full(len(found), block), found, total[found])

    by = ["lang", "source", "block"]
    return in_small_batches(parts.repartition(*by).sortWithinPartitions(*by)).mapInArrow(add, _BLOCKS)


def shares(counts: np.ndarray, totals: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (total + kept)), for rows of groups."""
    exact = np.int64 if not counts.size or int(counts.max()) < (1 << 63) // SCALE - 1 else object
    found = 1 + (counts.astype(exact) + 1) * SCALE // (totals.astype(exact)[:, None] + kept)
    return found.astype(np.int64)


def _compared(blocks: DataFrame, most: int) -> DataFrame:
    """``lang, source, part, item, value`` of each block: sums for pairs of sources, and the best terms of a source."""
    names = ["lang", "source", "part", "item", "value"]

    def compare(table):
        lang = table["lang"][0].as_py()
        rows = table.select(["kind", "source", "slot", "n", "term", "kept", "slots", "counts"]).to_pydict()
        at = {kind: np.flatnonzero(np.array(rows["kind"]) == kind) for kind in range(3)}
        kept = rows["kept"][at[0][0]]
        sources = [rows["source"][i] for i in at[0].tolist()]
        totals = np.array([rows["n"][i] for i in at[0].tolist()], dtype=np.int64)
        place = {s: i for i, s in enumerate(sources)}
        terms = {rows["slot"][i]: rows["term"][i] for i in at[1].tolist()}
        slots = np.array(sorted(terms), dtype=np.int64)
        seen = [np.frombuffer(rows["slots"][i], "<u4").astype(np.int64) + rows["slot"][i] for i in at[2].tolist()]
        column = np.searchsorted(slots, np.concatenate(seen) if seen else np.zeros(0, np.int64))
        row = np.repeat(np.array([place[rows["source"][i]] for i in at[2].tolist()], dtype=np.int64), [len(x) for x in seen])
        n = np.frombuffer(b"".join(rows["counts"][i] for i in at[2].tolist()), "<i8")
        sums = np.zeros((len(sources), len(sources)), dtype=np.int64)
        best: list[list[tuple[int, bytes]]] = [[] for _ in sources]
        wide = max(16, (1 << 20) // max(1, len(sources)))
        for start in range(0, len(slots), wide):
            here = (column >= start) & (column < start + wide)
            counts = np.zeros((len(sources), min(wide, len(slots) - start)), dtype=np.int64)
            counts[row[here], column[here] - start] = n[here]
            p = shares(counts, totals, kept)
            q = shares(counts.sum(axis=0)[None], np.array([totals.sum()]), kept)[0]
            for i in range(len(sources)):
                sums[i] += ((p[i] - p) ** 2 // p).sum(axis=1)
                over = np.flatnonzero((counts[i] > 0) & (p[i] > q))
                value = (p[i][over] - q[over]) ** 2 // q[over]
                best[i] += [(-v, terms[s]) for v, s in zip(value.tolist(), slots[start + over].tolist(), strict=True)]
                best[i] = sorted(best[i])[:most]
        i, j = np.nonzero(~np.eye(len(sources), dtype=bool))
        pairs = [(sources[a], "pair", sources[b].encode(), int(sums[a, b])) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
        top = [(s, "term", term, -v) for s, own in zip(sources, best, strict=True) for v, term in own]
        found = pairs + top
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64()]
        arrays = [pa.array([x[k] for x in found], kind) for k, kind in enumerate(kinds)]
        return pa.Table.from_arrays([pa.array([lang] * len(found), pa.string()), *arrays], names)

    columns = "lang string, source string, part string, item binary, value bigint"
    return blocks.groupBy("lang", "block").applyInArrow(compare, columns)


def divergence(docs: DataFrame, least: int = 3, most: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group (lang, source) of ``docs(text, lang, source)``.

    Terms are runs of ASCII letters and characters above ASCII; only A-Z are lower-cased. A language keeps the V
    terms that at least ``least`` of its documents have. A group gives a term the share
    1 + floor(1e9 * (count + 1) / (N + V)), N being all its counts, and so does the language.
    Part ``pair`` has for each other source of the language the sum over the kept terms of
    floor((p - q)^2 / q), p the group's share and q the other's; 0 where nothing is kept. Part ``term`` has the
    ``most`` terms of the group whose share is above the language's, by floor((p - q)^2 / q) with the language's q.
    Ranks start at 1 by falling value, then by the item's UTF-8 bytes.

    Of each language the number of its terms and a line for each 32,768 of them reach the driver.
    Null text, lang and source count as empty text. Rows may repeat; each is a document. Groups without terms
    take part in pairs. Other columns are not looked at. The pairs of sources are the result, so its size and
    the work grow with the square of a language's sources; every other step grows with the texts.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    own = docs.select(*(F.coalesce(F.col(x), F.lit("")).alias(x) for x in ("lang", "source")), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    groups = materialise(own.select("lang", "source").distinct())
    kept = materialise(kept_terms(in_small_batches(own), least))
    sizes = _sizes(kept)
    shards = _shards(kept, sizes)
    number = {r.lang: r.shards for r in sizes.collect()}
    turns = _rounds(shards)
    parts = spark.createDataFrame([], _BLOCKS)
    for turn in turns:
        parts = parts.union(_recount(in_small_batches(own), shards, turn, number))
    counts = materialise(_added(parts))
    totals = materialise(
        groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
        .join(F.broadcast(sizes), "lang", "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("kept"))
    )
    kind = lambda k: F.lit(k).alias("kind")
    bytes_ = lambda name: F.lit(None).cast("binary").alias(name)
    block = F.floor(F.col("slot") / BLOCK).cast("long").alias("block")
    last = F.greatest(F.lit(0), F.floor((F.col("kept") - 1) / BLOCK)).cast("long")
    heads = totals.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"), kind(0), "source", F.lit(None).cast("long").alias("slot"), "n",
                          bytes_("term"), "kept", bytes_("slots"), bytes_("counts"))
    none = F.lit(None).cast("long")
    named = _named(shards, turns).select("lang", block, kind(1), F.lit(None).cast("string").alias("source"), "slot", none.alias("n"), "term", none.alias("kept"), bytes_("slots"), bytes_("counts"))
    seen = counts.select("lang", "block", kind(2), "source", (F.col("block") * BLOCK).alias("slot"), "n", bytes_("term"), none.alias("kept"), "slots", "counts")
    found = materialise(_compared(heads.union(named).union(seen), most))
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    by = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(by)
    # Of the terms, each task hands on the best of a group only.
    terms = found.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= most)
    return pairs.withColumn("rank", rank).union(terms).withColumn("item", F.col("item").cast("string"))


def _named(shards: DataFrame, turns: list) -> DataFrame:
    """``lang, slot, term`` of all kept terms."""
    spark = shards.sparkSession
    bases = small_table(spark, [{"lang": x, "shard": s, "base": b} for turn in turns for x, s, b in turn], "lang string, shard bigint, base bigint")

    def spell(batches):
        for rows in batches:
            for row in rows.to_pylist():
                terms = PerfectHash.unpacked(row).by_slot()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * len(terms), pa.string()), pa.array(np.arange(len(terms)) + row["base"]), pa.array(terms, pa.binary())],
                    ["lang", "slot", "term"],
                )

    joined = shards.join(F.broadcast(bases), ["lang", "shard"])  # a row for some 32,768 terms
    return in_small_batches(joined.select("lang", "base", "bits", "words", "terms", "width", "rest")).mapInArrow(spell, "lang string, slot bigint, term binary")
