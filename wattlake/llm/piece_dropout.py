"""SentencePiece encoding with seeded merge dropout, and lossless decoding.

A text is segmented by merges: of all neighbouring symbols that form a piece of the vocabulary, the pair with
the best score is merged first, the leftmost of equals. With dropout, a candidate that comes up on the agenda
is skipped if the hash of a key, the two symbols and their place says so. Every occurrence of a word has a key
of its own, drawn from the seed, the text and the ordinal of the word in it, so a word is segmented in varied
ways, the same in every run. Every segmentation spells the text, so decoding gives the text back.

Merges never cross from a word into the space before the next, so words are segmented on their own. A distinct
word is segmented once without dropout for a group of documents; an occurrence that skips none of the merges
made there has that segmentation, and the others are segmented by their own keys, many at a time in numpy.
Very long words go through a heap.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import in_small_batches

DROPOUT, SEED = 0.1, 1
#: Words of more characters go through a heap, so that time grows but little faster than length.
LONG = 48
#: Characters and words that are encoded together, and ids that are decoded together.
GROUP_CHARS, GROUP_WORDS, GROUP_IDS = 1 << 21, 400_000, 1 << 20
_SPACE = "▁"
_NONE = np.int32(np.iinfo(np.int32).max)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(*parts) -> np.ndarray:
    """A 64-bit hash of integers or arrays of integers, part by part."""
    h = np.zeros(1, dtype=np.uint64)
    for part in parts:
        h = (h ^ np.asarray(part).astype(np.uint64)) + _MIX[0]
        h = (h ^ (h >> np.uint64(30))) * _MIX[1]
        h = (h ^ (h >> np.uint64(27))) * _MIX[2]
        h = h ^ (h >> np.uint64(31))
    return h


class Pieces:
    """The vocabulary: pieces with their bytes, and which pairs merge into which piece in what order."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(self.size)]
        plain = [i for i in range(self.size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.byte = np.zeros(256, dtype=np.int32)
        raw: list[bytes] = [b""] * self.size
        for i in range(self.size):
            if model.is_byte(i):
                raw[i] = bytes([int(names[i][3:5], 16)])
                self.byte[raw[i][0]] = i
        for i in plain:
            raw[i] = names[i].replace(_SPACE, " ").encode()
        if not self.byte.any():
            raise ValueError("the vocabulary has no byte pieces, so it can't spell every text")
        self.bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.width = np.array([len(x) for x in raw], dtype=np.int64)
        self.first = np.cumsum(self.width) - self.width
        spelled = {names[i].replace(_SPACE, " "): i for i in plain}
        self.single = {name: i for name, i in spelled.items() if len(name) == 1}
        merging = {c for name in spelled if len(name) > 1 for c in name}
        if any(" " in name.lstrip(" ") for name in spelled) or merging - self.single.keys():
            raise ValueError("pieces that go over a space, or whose characters are no pieces, are not held")
        inside = "".join(map(re.escape, sorted(merging - {" "})))
        #: A word with the spaces before it, spaces, or one character that never merges.
        self.split = re.compile(f" *[{inside}]+| +|[^{inside} ]").findall
        by_score = sorted((i for i in plain if len(names[i]) > 1), key=lambda i: (-model.get_score(i), i))
        order, scores = {}, {}
        for i in by_score:
            order[i] = scores.setdefault(model.get_score(i), len(scores))
        keys, ranks, into = [], [], []
        for name, i in spelled.items():
            for cut in range(1, len(name)):
                left, right = spelled.get(name[:cut]), spelled.get(name[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    ranks.append(order[i])
                    into.append(i)
        self._tabulate(np.array(keys, dtype=np.int64), np.array(ranks, dtype=np.int32), np.array(into, dtype=np.int32))
        codes = np.array([ord(c) for c in self.single])
        self.of_char = np.full(int(codes.max()) + 1, -1, dtype=np.int32)
        self.of_char[codes] = list(self.single.values())

    def _tabulate(self, keys: np.ndarray, ranks: np.ndarray, into: np.ndarray) -> None:
        """A table of the pairs by hash; a pair stands at its place or one of the next few."""
        bits = int(len(keys) * 4).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.ranks, self.into = np.full(1 << bits, _NONE, dtype=np.int32), np.zeros(1 << bits, dtype=np.int32)
        at, left = self._place(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at] < 0
            _, one = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            take = one[free[one]]
            self.keys[at[take]], self.ranks[at[take]], self.into[at[take]] = keys[left[take]], ranks[left[take]], into[left[take]]
            rest = np.ones(len(left), dtype=bool)
            rest[take] = False
            left, at = left[rest], (at[rest] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX[0]) >> self.shift).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (lower first; ``_NONE`` for no piece) and merged piece of neighbouring symbols; -1 is no symbol."""
        keys = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.size + right, -2).ravel()
        at = self._place(keys)
        found = self.keys[at]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            found = self.keys[at[open_]]
            open_ = open_[(found != keys[open_]) & (found >= 0)]
        hit = self.keys[at] == keys
        shape = np.shape(left)
        return np.where(hit, self.ranks[at], _NONE).reshape(shape), self.into[at].reshape(shape)


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


class Encoder:
    def __init__(self, pieces: Pieces, dropout: float, seed: int) -> None:
        self.pieces, self.seed = pieces, seed
        self.limit = np.uint64(int(dropout * (1 << 53)))

    def skipped(self, key, left, right, start) -> np.ndarray:
        return self._says_skip(key, mixed(self.seed, left, right, start))

    def _says_skip(self, key, candidate) -> np.ndarray:
        return (mixed(key, candidate) >> np.uint64(11)) < self.limit

    def _candidates(self, key, left, right, start) -> tuple[np.ndarray, np.ndarray]:
        rank, into = self.pieces.pair(left, right)
        if self.limit and key is not None:
            some = np.nonzero(rank != _NONE)
            key = np.broadcast_to(key, rank.shape)
            drop = self.skipped(key[some], left[some], right[some], start[some])
            rank[tuple(x[drop] for x in some)] = _NONE
        return rank, into

    def short(self, symbols: np.ndarray, keys: np.ndarray | None, merges: list | None = None) -> np.ndarray:
        """Segmentations of words of one length, a row each; -1 fills up.

        Without keys nothing is skipped. ``merges`` receives the rows and the hashed candidates of each round.
        """
        out = symbols.copy()
        n, length = symbols.shape
        if length < 2:
            return out
        drops = keys is not None
        rows, ids, key = np.arange(n), symbols.copy(), keys if drops else np.zeros(n, np.uint64)
        start = np.broadcast_to(np.arange(length, dtype=np.int32), ids.shape).copy()
        rank, into = self._candidates(key[:, None] if drops else None, ids[:, :-1], ids[:, 1:], start[:, :-1])
        while len(rows):
            at = rank.argmin(axis=1)
            every = np.arange(len(rows))
            more = rank[every, at] != _NONE
            if not more.all():
                out[rows[~more]] = -1
                out[rows[~more], :ids.shape[1]] = ids[~more]
                rows, ids, key, start, rank, into, at = (x[more] for x in (rows, ids, key, start, rank, into, at))
                every = np.arange(len(rows))
                if not len(rows):
                    break
            if merges is not None:
                merges.append((rows, mixed(self.seed, ids[every, at], ids[every, at + 1], start[every, at])))
            ids[every, at] = into[every, at]
            spots = np.arange(ids.shape[1] - 1)
            spots = spots + (spots > at[:, None])
            ids, start = np.take_along_axis(ids, spots, 1), np.take_along_axis(start, spots, 1)
            if ids.shape[1] == 1:
                out[rows] = -1
                out[rows, 0] = ids[:, 0]
                break
            spots = np.arange(ids.shape[1] - 1)
            spots = spots + (spots >= at[:, None])
            rank, into = np.take_along_axis(rank, spots, 1), np.take_along_axis(into, spots, 1)
            for side in (-1, 0):  # the pair before the new symbol, and the pair after it
                p = at + side
                ok = np.flatnonzero((p >= 0) & (p < ids.shape[1] - 1))
                p = p[ok]
                rank[ok, p], into[ok, p] = self._candidates(key[ok] if drops else None, ids[ok, p], ids[ok, p + 1], start[ok, p])
        return out

    def long(self, symbols: np.ndarray, key: int | None) -> np.ndarray:
        """The segmentation of one word, from a heap of candidates."""
        n, key = len(symbols), None if key is None else np.uint64(key)
        ids, after, before = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        rank, into = self._candidates(key, symbols[:-1], symbols[1:], np.arange(n - 1))
        agenda = [(int(r), i, int(a), int(b), int(m)) for i, (r, a, b, m) in enumerate(zip(rank, symbols, symbols[1:], into, strict=False)) if r != _NONE]
        heapq.heapify(agenda)

        def push(i: int) -> None:
            if i >= 0 and after[i] < n:
                a, b = np.array([ids[i]]), np.array([ids[after[i]]])
                r, m = self._candidates(key, a, b, np.array([i]))
                if r[0] != _NONE:
                    heapq.heappush(agenda, (int(r[0]), i, int(a[0]), int(b[0]), int(m[0])))

        while agenda:
            _, i, a, b, m = heapq.heappop(agenda)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = m, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            push(before[i])
            push(i)
        return np.array([x for x in ids if x >= 0], dtype=np.int32)

    def _segment(self, words: list[str], keys: np.ndarray | None, merges: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and each word's number of ids; without keys nothing is skipped.

        ``merges`` receives the words and the hashed candidates that were merged.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        table = self.pieces.of_char
        symbols = np.where(flat < len(table), table[np.minimum(flat, len(table) - 1)], -1)
        begins = np.cumsum(lengths) - lengths
        parts: list[np.ndarray] = []
        place, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        held = 0

        def put(where, ids, n) -> None:
            nonlocal held
            place[where], sizes[where] = held + np.cumsum(n) - n, n
            parts.append(ids)
            held += len(ids)

        for length in np.unique(lengths).tolist():
            same = np.flatnonzero(lengths == length)
            if length > LONG:
                for i in same.tolist():
                    ids = self.long(symbols[begins[i]:begins[i] + length], None if keys is None else keys[i])
                    put(np.array([i]), ids, np.array([len(ids)]))
                continue
            for cut in range(0, len(same), 1 << 16):
                some = same[cut:cut + (1 << 16)]
                rows = symbols[begins[some, None] + np.arange(length)].astype(np.int32)
                if length == 1 and (rows < 0).any():  # characters that are no piece are spelled in bytes
                    for i in some[rows[:, 0] < 0].tolist():
                        ids = self.pieces.byte[np.frombuffer(words[i].encode("utf-8", "surrogatepass"), np.uint8)]
                        put(np.array([i]), ids, np.array([len(ids)]))
                    some, rows = some[rows[:, 0] >= 0], rows[rows[:, 0] >= 0]
                made: list | None = None if merges is None else []
                found = self.short(rows, None if keys is None else keys[some], made)
                if merges is not None:
                    merges += [(some[at], candidates) for at, candidates in made]
                put(some, found[found >= 0], (found >= 0).sum(axis=1))
        whole = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return _gather(whole, place, sizes), sizes

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and each text's number of ids."""
        words: list[str] = []
        blocks: list[tuple[int, int, int, int]] = []  # text, its hash, words of it before, words
        parts, counts = [np.zeros(0, np.int32)], np.zeros(len(texts), dtype=np.int64)

        def flush() -> None:
            owner, draw, before, n = (np.array(x, dtype=np.uint64) for x in zip(*blocks, strict=True))
            n = n.astype(np.int64)
            ordinal = np.arange(len(words)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(before, n).astype(np.int64)
            ids, sizes = self._encode_words(words, mixed(self.seed, np.repeat(draw, n), ordinal))
            parts.append(ids)
            np.add.at(counts, np.repeat(owner, n).astype(np.int64), sizes)
            words.clear()
            blocks.clear()

        for d, text in enumerate(texts):
            if not text:
                continue
            draw, before = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")), 0
            for block in _blocks(" " + text):
                found = self.pieces.split(block)
                words += found
                blocks.append((d, draw, before, len(found)))
                before += len(found)
                if len(words) > GROUP_WORDS:
                    flush()
        if words:
            flush()
        return np.concatenate(parts), counts

    def _encode_words(self, words: list[str], draw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and each word's number of ids, by the key of each in ``draw``."""
        codes, distinct = pd.factorize(np.array(words, dtype=object))
        if not self.limit:
            ids, sizes = self._segment(distinct.tolist(), None)
            return _gather(ids, (np.cumsum(sizes) - sizes)[codes], sizes[codes]), sizes[codes]
        long = np.fromiter(map(len, distinct), np.int64, len(distinct)) > LONG
        whole = np.where(long, "", distinct)  # hardly any occurrence of a long word skips nothing
        merges: list[tuple[np.ndarray, np.ndarray]] = []
        ids, sizes = self._segment(whole.tolist(), None, merges)
        own = long[codes] | self._skips(codes, draw, merges, len(distinct))
        varied, counts = self._segment(distinct[codes[own]].tolist(), draw[own])
        first, size = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
        first[own], size[own] = len(ids) + np.cumsum(counts) - counts, counts
        return _gather(np.concatenate([ids, varied]), first, size), size

    def _skips(self, codes: np.ndarray, draw: np.ndarray, merges: list, n: int) -> np.ndarray:
        """Which occurrences skip a candidate that is merged where nothing is skipped."""
        if not merges:
            return np.zeros(len(codes), dtype=bool)
        word, candidate = (np.concatenate(x) for x in zip(*merges, strict=True))
        order = np.argsort(word, kind="stable")
        made = np.bincount(word, minlength=n)
        times = made[codes]
        candidates = _gather(candidate[order], (np.cumsum(made) - made)[codes], times)
        found = np.zeros(len(codes), dtype=bool)
        found[np.repeat(np.arange(len(codes)), times)[self._says_skip(np.repeat(draw, times), candidates)]] = True
        return found


def _blocks(text: str):
    """Pieces of a long text, cut only before the first of the spaces between two words."""
    start = 0
    while len(text) - start > GROUP_CHARS:
        cut = start + GROUP_CHARS
        while cut < len(text) and (text[cut] != " " or text[cut - 1] == " "):
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


def _gather(values: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``values`` one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(first - (ends - sizes), sizes)]


def _stretches(sizes: np.ndarray, most: int):
    """Ranges of rows, each of at most about ``most`` in all; a larger row is alone or last."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        held += size
        if held >= most or i == len(sizes) - 1:
            yield start, i + 1
            start, held = i + 1, 0


def decode_ids(pieces: Pieces, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Texts of id sequences that stand one after another; without the space that encoding puts first."""
    widths = pieces.width[ids]
    parts = [
        _gather(pieces.bytes, pieces.first[ids[i:i + GROUP_IDS]], widths[i:i + GROUP_IDS]) for i in range(0, len(ids), GROUP_IDS)
    ]
    raw = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    edges = np.concatenate([[0], np.cumsum(widths)])[np.concatenate([[0], np.cumsum(counts)])]
    lead = (np.diff(edges) > 0) & (raw[np.minimum(edges[:-1], max(0, len(raw) - 1))] == 32) if len(raw) else np.zeros(len(counts), bool)
    keep = np.ones(len(raw), dtype=bool)
    keep[edges[:-1][lead]] = False
    raw = raw[keep]
    offsets = (edges - np.concatenate([[0], np.cumsum(lead)])).astype(np.int32)
    texts = pa.StringArray.from_buffers(len(counts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes()))
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:  # ids that no text encodes to
        data = raw.tobytes()
        texts = pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())
    return texts


def encode(
    docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = SEED, doc_id: str = "doc_id", text: str = "text",
    extra: dict | None = None,
) -> DataFrame:
    """``doc_id, ids`` for every row, and the columns of ``extra`` (name: column) behind them.

    Null and empty texts have no ids. Equal texts get equal ids; repeated rows are kept. With dropout 0 the
    ids are those of the library, except that a text's own U+2581 is spelled in bytes, so that it is not
    taken for a space. Texts are encoded whole.
    """
    extra = extra or {}
    source = docs.select(F.col(doc_id).alias("doc_id"), *[c.alias(n) for n, c in extra.items()], F.col(text).alias("text"))
    kept = source.columns[:-1]

    def run(batches):
        encoder = Encoder(pieces_of(model), dropout, seed)
        for rows in batches:
            sizes = np.array(pc.fill_null(pc.utf8_length(rows.column("text")), 0), dtype=np.int64)
            for start, end in _stretches(sizes, GROUP_CHARS):
                part = rows.slice(start, end - start)
                ids, counts = encoder.encode(part.column("text").to_pylist())
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in kept), lists], [*kept, "ids"])

    kinds = dict(source.dtypes)
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in kept) + ", ids array<int>"
    return in_small_batches(source).mapInArrow(run, schema).select("doc_id", "ids", *extra)


def decode(encoded: DataFrame, model: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """``encoded`` with the text of ``ids`` as last column; null ids count as none, and none is the empty text."""
    at = encoded.columns.index(ids)
    names = [*encoded.columns, name]

    def run(batches):
        pieces = pieces_of(model)
        for rows in batches:
            counts = np.array(pc.fill_null(pc.list_value_length(rows.column(at)), 0), dtype=np.int64)
            for start, end in _stretches(counts, GROUP_IDS):
                part = rows.slice(start, end - start)
                ids = part.column(at).flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*part.columns, decode_ids(pieces, ids, counts[start:end])], names)

    schema = ", ".join(f"`{n}` {kind}" for n, kind in encoded.dtypes) + f", `{name}` string"
    return in_small_batches(encoded).mapInArrow(run, schema)
