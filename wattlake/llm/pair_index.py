"""Byte-level BPE encoding with an index of pair occurrences, and decoding.

The words of a partition's texts that have not been seen yet are laid out as one row of symbols, a byte each.
An index maps every pair of neighbouring symbols that has a rank to all its positions. Active ranks are taken
in ascending order from a heap: all occurrences of the pair are merged, from left to right, and the lists of
the pairs that a merge makes with its neighbours are extended. Positions whose pair has changed since are
passed over. Words don't touch, so the merges of one word are those that the word would get alone.

A worker remembers the ids of words, up to a bounded number of them and of characters, for the batches that
follow. Ids are carried as binary, four bytes each, little-endian; ``unpacked`` turns them into an array.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattlake.llm.common import in_small_batches

#: Words and characters that a worker remembers; beyond either it starts anew.
MEMO_WORDS, MEMO_CHARS = 400_000, 6_000_000
#: Characters of a text that are split into words at a time, words whose ids are looked up together, ids decoded together.
BLOCK_CHARS, GROUP_WORDS, GROUP_IDS = 1 << 20, 1 << 19, 1 << 20
#: Positions that are merged by arrays; fewer are merged one by one.
MANY = 40
_DEAD, _GAP = -2, -1


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: its own where that is visible, else one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in visible)
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """The ids, ranks and bytes of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as lines:
            file = json.load(lines)
        model, before = file["model"], file["pre_tokenizer"]
        if model["type"] != "BPE" or file["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
            raise ValueError("not a plain byte-level BPE file")
        if any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            raise ValueError("only plain merges are held")
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in file["added_tokens"]):
            raise ValueError("added tokens that look at their surroundings are not held")
        ids, letters = model["vocab"], _byte_letters()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.byte = np.zeros(256, dtype=np.int64)
        for letter, byte in letters.items():
            self.byte[byte] = ids[letter]
        #: By rank: the two symbols and what they become. By pair, in one number: the rank.
        self.left = [ids[a] for a, _ in merges]
        self.right = [ids[b] for _, b in merges]
        self.whole = [ids[a + b] for a, b in merges]
        self.base = 2 + max(*ids.values(), *(x["id"] for x in file["added_tokens"]))
        self.rank = {a * self.base + b: r for r, (a, b) in enumerate(zip(self.left, self.right, strict=True))}
        self.pairs, self.ranks = (np.array(x, dtype=np.int64) for x in zip(*sorted(self.rank.items()), strict=True))
        made = dict(zip(reversed(self.whole), reversed(range(len(merges))), strict=True))
        if any(max(made.get(a, -1), made.get(b, -1)) >= r for r, (a, b) in enumerate(zip(self.left, self.right, strict=True))):
            raise ValueError("a pair ranks before the merges that make its symbols")
        self.special = {x["content"]: x["id"] for x in file["added_tokens"]}
        raw = {i: bytes(map(letters.__getitem__, token)) for token, i in ids.items()}
        raw |= {i: token.encode() for token, i in self.special.items()}
        spelled = [raw.get(i, b"") for i in range(max(raw) + 1)]
        self.bytes = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.width = np.array([len(x) for x in spelled], dtype=np.int64)
        self.first = np.cumsum(self.width) - self.width
        # Ranks of pairs of bytes, for the first index; none is the number of ranks.
        own = {int(i): b for b, i in enumerate(self.byte)}
        self.of_bytes = np.full((256, 256), len(merges), dtype=np.int64)
        for r, (a, b) in enumerate(zip(self.left, self.right, strict=True)):
            if a in own and b in own:
                self.of_bytes[own[a], own[b]] = r

    def ranks_of(self, pairs: np.ndarray) -> np.ndarray:
        """The ranks of many pairs; the number of ranks for none."""
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.ranks[at], len(self.left))


class Row:
    """Symbols of words in a row, with gaps between them, and the index of the pairs still to be merged."""

    def __init__(self, vocabulary: Vocabulary, words: list[bytes]) -> None:
        self.own = vocabulary
        flat = np.frombuffer(b"\0".join(words), dtype=np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(lengths + 1) - 1  # where the gap after each word stands
        n = len(flat)
        # The last symbol is a gap, and it also stands before the first by its index -1.
        self.sym, self.after, self.before = (array("q", bytes(8 * (n + 1))) for _ in range(3))
        self.seen = [np.frombuffer(x, dtype=np.int64) for x in (self.sym, self.after, self.before)]
        sym, after, before = self.seen
        sym[:n], after[:n], before[:n] = vocabulary.byte[flat], np.arange(1, n + 1), np.arange(-1, n - 1)
        sym[self.ends] = _GAP
        inside = np.ones(max(0, n - 1), dtype=bool)
        inside[self.ends[:-1]] = inside[self.ends[:-1] - 1] = False
        none = len(vocabulary.left)
        ranks = np.where(inside, vocabulary.of_bytes[flat[:-1], flat[1:]], none)
        self.index: dict[int, list[int]] = {}
        self.agenda: list[int] = []
        self._list(ranks, np.arange(len(ranks)))

    def _list(self, ranks: np.ndarray, places: np.ndarray) -> None:
        """Adds the places to the lists of their ranks."""
        some = ranks < len(self.own.left)
        ranks, places = ranks[some], places[some]
        order = np.argsort(ranks, kind="stable")
        kinds, starts = np.unique(ranks[order], return_index=True)
        places, bounds = places[order].tolist(), [*starts.tolist(), len(places)]
        for r, start, end in zip(kinds.tolist(), bounds, bounds[1:], strict=False):
            if r in self.index:
                self.index[r] += places[start:end]
            else:
                self.index[r] = places[start:end]
                heapq.heappush(self.agenda, r)

    def merge(self) -> None:
        """Takes the active ranks in ascending order; a merge only makes pairs of higher rank."""
        while self.agenda:
            r = heapq.heappop(self.agenda)
            at = self.index.pop(r)
            if len(at) >= MANY and self.own.left[r] != self.own.right[r]:
                self._merge_many(r, np.array(at))
            else:
                self._merge_some(r, at)

    def _merge_some(self, r: int, at: list[int]) -> None:
        sym, after, before, index = self.sym, self.after, self.before, self.index
        rank_of, base = self.own.rank.get, self.own.base
        a, b, made = self.own.left[r], self.own.right[r], self.own.whole[r]
        if a == b:  # only such pairs overlap, and the leftmost goes first
            at.sort()
        for i in at:
            j = after[i]
            if sym[i] != a or sym[j] != b:
                continue
            k, h = after[j], before[i]
            sym[i], sym[j], after[i], before[k] = made, _DEAD, k, i
            # A gap gives a number that no pair has.
            for key, where in ((sym[h] * base + made, h), (made * base + sym[k], i)):
                new = rank_of(key)
                if new is not None:
                    if new in index:
                        index[new].append(where)
                    else:
                        index[new] = [where]
                        heapq.heappush(self.agenda, new)

    def _merge_many(self, r: int, i: np.ndarray) -> None:
        sym, after, before = self.seen
        a, b, made = self.own.left[r], self.own.right[r], self.own.whole[r]
        j = after[i]
        good = (sym[i] == a) & (sym[j] == b)
        i, j = i[good], j[good]
        k, h = after[j], before[i]
        sym[i], sym[j], after[i], before[k] = made, _DEAD, k, i
        h = before[i]
        right = sym[k]
        right[right == made] = _GAP  # two merged neighbours: listed as the left pair of the second
        keys = np.concatenate([sym[h] * self.own.base + made, made * self.own.base + right])
        self._list(self.own.ranks_of(keys), np.concatenate([h, i]))

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another, and each word's number of ids."""
        live = self.seen[0][: self.ends[-1] + 1] if len(self.ends) else self.seen[0][:0]
        kept = live >= 0
        sizes = np.diff(np.cumsum(kept)[self.ends], prepend=0)
        return live[kept], sizes


def segment(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words one after another and each word's number of ids."""
    row = Row(vocabulary, words)
    row.merge()
    return row.words()


@lru_cache(maxsize=1)
def _unassigned() -> np.ndarray:
    """By code point: whether this Python's Unicode does not know it, so that pattern libraries may differ on its class."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])


def _known(text: str) -> bool:
    if text.isascii():
        return True
    return not _unassigned()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")].any()


class Encoder:
    """Ids as the tokenizers library gives them without special tokens added."""

    def __init__(self, vocabulary: str, pattern: str) -> None:
        self.own, self.file, self.library = vocabulary_of(vocabulary), vocabulary, None
        self.split = regex.compile(pattern).findall
        self.stops = re.compile("(" + "|".join(sorted(map(re.escape, self.own.special), key=len, reverse=True)) + ")") if self.own.special else None
        self._forget()

    def _forget(self) -> None:
        self.code: dict[str, int] = {}
        self.chars, self.held = 0, 0
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.sizes = np.zeros(0, dtype=np.int64)

    def words(self, text: str) -> Iterator[list[str | int]]:
        """The text's words, block by block; an added token is a block of its own, with its id."""
        for piece in self.stops.split(text) if self.stops else [text]:
            if self.stops and piece in self.own.special:
                yield [self.own.special[piece]]
                continue
            for block in _blocks(piece):
                if _known(block):
                    yield self.split(block)
                else:  # the library's own classes decide
                    if self.library is None:
                        self.library = Tokenizer.from_file(self.file).pre_tokenizer
                    yield [block[a:b] for _, (a, b) in self.library.pre_tokenize_str(block)]

    def _learn(self, words: set[str]) -> None:
        """Adds the ids of words that are not remembered."""
        new = list(words)
        flat, sizes = segment(self.own, [word.encode("utf-8", "surrogatepass") for word in new])
        self.code.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new)), strict=True))
        self.sizes = np.concatenate([self.sizes, sizes])
        self.chars += sum(map(len, new))
        if self.held + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.held], np.zeros(self.held + 2 * len(flat), dtype=np.uint32)])
        self.ids[self.held:self.held + len(flat)] = flat
        self.held += len(flat)

    def _look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and each word's number of ids."""
        if len(self.code) > MEMO_WORDS or self.chars > MEMO_CHARS:
            self._forget()
        new = set(words).difference(self.code)
        if new:
            self._learn(new)
        codes = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
        first = np.cumsum(self.sizes) - self.sizes
        return gathered(self.ids, first[codes], self.sizes[codes]), self.sizes[codes]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids, four bytes each."""
        out: list[list[bytes]] = [[] for _ in texts]
        words: list[str] = []
        owners: list[tuple[int, int]] = []  # text, words of it

        def flush() -> None:
            ids, sizes = self._look_up(words)
            ends = np.cumsum(sizes)[np.cumsum([n for _, n in owners]) - 1].tolist()
            start = 0
            for (d, _), end in zip(owners, ends, strict=True):
                out[d].append(ids[start:end].astype("<u4").tobytes())
                start = end
            words.clear()
            owners.clear()

        for d, text in enumerate(texts):
            for found in self.words(text or ""):
                if found and isinstance(found[0], int):
                    if words:
                        flush()
                    out[d].append(np.array(found, dtype="<u4").tobytes())
                elif found:
                    words += found
                    owners.append((d, len(found)))
                    if len(words) > GROUP_WORDS:
                        flush()
        if words:
            flush()
        return [b"".join(parts) for parts in out]


def _blocks(text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
    """Pieces of a long text, cut only before a space that follows no white space; no word goes over such a place."""
    start = 0
    while len(text) - start > size:
        cut = start + size
        while cut < len(text) and (text[cut] != " " or text[cut - 1].isspace()):
            cut += 1
        yield text[start:cut]
        start = cut
    if start < len(text):
        yield text[start:]


def gathered(values: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``values`` one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(first - (ends - sizes), sizes)]


def decoded(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text that the ids spell; bytes that are no UTF-8 become replacement characters, unknown ids nothing."""
    parts = []
    for start in range(0, len(ids), GROUP_IDS):
        some = ids[start:start + GROUP_IDS].astype(np.int64)
        some = some[some < len(vocabulary.width)]
        parts.append(gathered(vocabulary.bytes, vocabulary.first[some], vocabulary.width[some]).tobytes())
    return b"".join(parts).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=1)
def encoder_of(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode(docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` for every row of ``docs``: the ids of the whole text, four little-endian bytes each.

    Ids are those of the tokenizers library for the file ``vocabulary`` without special tokens added; a text
    that spells an added token gets that token's id. ``pattern`` splits texts into words. A null text counts
    as empty and has no ids. Repeated rows and null ids are kept, other columns are not looked at. A text is
    split in blocks, so long ones take little more memory than their size; a word is held whole.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def look(batches):
        encoder = encoder_of(vocabulary, pattern)
        for rows in batches:
            found = encoder.encode(rows.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, pa.binary())], ["doc_id", "ids"])

    return in_small_batches(source).mapInArrow(look, f"doc_id {dict(source.dtypes)['doc_id']}, ids binary")


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with the column ``text`` that its ``ids`` spell, special tokens included; null ids give null."""
    names = [x for x in encoded.columns if x != text]
    source = encoded.select(*names)
    at = names.index(ids)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in [*source.dtypes, (text, "string")])

    def spell(batches):
        own = vocabulary_of(vocabulary)
        for rows in batches:
            found = [None if x is None else decoded(own, np.frombuffer(x, "<u4")) for x in rows.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, pa.string())], [*names, text])

    return in_small_batches(source).mapInArrow(spell, schema)


def unpacked(ids: Column) -> Column:
    """The packed ids as an array of longs."""
    numbers = F.regexp_extract_all(F.hex(ids), F.lit("(.{8})"))
    return F.transform(
        numbers, lambda x: F.conv(F.concat(*[F.substring(x, k, 2) for k in (7, 5, 3, 1)]), 16, 10).cast("long")
    )
