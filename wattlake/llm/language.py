"""Language identification with hyperdimensional profiles.

Every letter gets a random vector of +1 and -1. Three neighbouring letters are bound into one vector: the
first letter's vector rotated twice, the second's rotated once and the third's as it is, multiplied
component by component. A text is the bundle (sum) of its n-gram vectors; a language is the bundle of its
texts, each of the same weight. A text gets the language whose prototype has the greatest cosine with it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import in_small_batches
from wattlake.session import materialise

DIMENSIONS = 1024
SEED = 20_240_607
UNKNOWN = "und"
#: What a text with so many distinct n-grams must reach to be accepted as one of the languages.
LEAST_COSINE, ENOUGH_GRAMS = 0.1, 100
#: Symbols of the alphabet: 0 is anything but a letter, then a to z, then 37 classes for all other letters.
SYMBOLS = 64
#: A document's n-gram frequencies are rounded to integers of this sum, so that sums don't depend on order.
_WEIGHT = 1 << 16
#: More languages than this mean that the column doesn't hold languages.
MAX_LANGUAGES = 2048
_CACHE_ROWS = 4096
_BOUND_ROWS = 512
_PIECE = 1 << 22


@lru_cache(maxsize=1)
def _symbol_of() -> np.ndarray:
    points = np.zeros(0x110000, dtype=np.uint8)
    letters = np.fromiter((i for i in range(0x110000) if chr(i).isalpha()), dtype=np.int64)
    points[letters] = 27 + letters % 37
    points[ord("a"):ord("z") + 1] = np.arange(1, 27)
    return points


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the whole text and their counts; both empty without a letter."""
    found: list[np.ndarray] = []
    tail = np.zeros(1, dtype=np.uint8)
    text = (text or "").lower()
    for start in range(0, len(text), _PIECE):
        raw = text[start:start + _PIECE].encode("utf-32-le", "surrogatepass")
        symbols = np.concatenate([tail, _symbol_of()[np.frombuffer(raw, dtype=np.uint32)]])
        found.append(_count(symbols))
        tail = symbols[-2:]
    found.append(_count(np.concatenate([tail, np.zeros(1, dtype=np.uint8)])))
    return np.unique(np.concatenate(found), return_counts=True)


def _count(symbols: np.ndarray) -> np.ndarray:
    """Codes of the n-grams around letters; the middle symbol is a letter."""
    if len(symbols) < 3:
        return np.zeros(0, dtype=np.int32)
    wide = symbols.astype(np.int32)
    middle = wide[1:-1] > 0
    return ((wide[:-2] << 12) | (wide[1:-1] << 6) | wide[2:])[middle]


@dataclass
class Binder:
    """n-gram vectors, made when first asked for; at most ``_CACHE_ROWS`` are kept."""

    dimensions: int = DIMENSIONS
    seed: int = SEED
    rows: np.ndarray = field(init=False, repr=False)
    slot: np.ndarray = field(init=False, repr=False)
    used: int = 0

    def __post_init__(self) -> None:
        letters = np.random.default_rng(self.seed).integers(0, 2, (SYMBOLS, self.dimensions)) * 2 - 1
        self.letters = letters.astype(np.float32)
        self.once, self.twice = np.roll(self.letters, 1, axis=1), np.roll(self.letters, 2, axis=1)
        self.rows = np.zeros((_CACHE_ROWS, self.dimensions), dtype=np.float32)
        self.slot = np.full(SYMBOLS**3, -1, dtype=np.int32)

    def bound(self, grams: np.ndarray) -> np.ndarray:
        out = np.empty((len(grams), self.dimensions), dtype=np.float32)
        for start in range(0, len(grams), _BOUND_ROWS):
            part = grams[start:start + _BOUND_ROWS]
            np.multiply(self.twice[part >> 12], self.once[(part >> 6) & 63], out=out[start:start + _BOUND_ROWS])
            out[start:start + _BOUND_ROWS] *= self.letters[part & 63]
        return out

    def bundle(self, grams: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The weighted sum of the n-grams' vectors, exact for integer weights up to 2**53 in all."""
        total = np.zeros(self.dimensions)
        for start in range(0, len(grams), _BOUND_ROWS):
            part = grams[start:start + _BOUND_ROWS]
            total += weights[start:start + _BOUND_ROWS].astype(np.float64) @ self.bound(part)
        return total

    def text_vector(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """``bundle`` in single precision, over kept vectors."""
        if len(grams) > _CACHE_ROWS:
            return self.bundle(grams, counts).astype(np.float32)
        fresh = grams[self.slot[grams] < 0]
        if self.used + len(fresh) > _CACHE_ROWS:
            self.slot[:], self.used, fresh = -1, 0, grams
        if len(fresh):
            self.rows[self.used:self.used + len(fresh)] = self.bound(fresh)
            self.slot[fresh] = np.arange(self.used, self.used + len(fresh))
            self.used += len(fresh)
        return counts.astype(np.float32) @ self.rows[self.slot[grams]]


@dataclass
class Profiles:
    """Unit prototypes of the languages, in the order of their names."""

    languages: list[str]
    prototypes: np.ndarray
    dimensions: int = DIMENSIONS
    seed: int = SEED

    def binder(self) -> Binder:
        return Binder(self.dimensions, self.seed)

    def identify(self, text: str | None, binder: Binder) -> tuple[str, float]:
        """The language and the cosine, cut to 0..1; ``und`` and 0 for a text without a letter."""
        return self._nearest(*ngrams(text), binder)

    def accepts(self, text: str | None, binder: Binder) -> bool:
        """Whether the text is like one of the languages: it has letters, and its cosine is above zero, or at
        least LEAST_COSINE if it has ENOUGH_GRAMS distinct n-grams. A short text's cosine is low in any case."""
        grams, counts = ngrams(text)
        name, score = self._nearest(grams, counts, binder)
        return name != UNKNOWN and score > 0 and (len(grams) < ENOUGH_GRAMS or score >= LEAST_COSINE)

    def _nearest(self, grams: np.ndarray, counts: np.ndarray, binder: Binder) -> tuple[str, float]:
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0
        vector = binder.text_vector(grams, counts)
        length = float(np.sqrt(vector @ vector))
        if length == 0:
            return UNKNOWN, 0.0
        cosines = self.prototypes @ vector / length
        best = int(np.argmax(cosines))
        return self.languages[best], float(min(1.0, max(0.0, cosines[best])))


def document_weights(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A document's n-grams with integer weights whose sum is about the same for every document."""
    grams, counts = ngrams(text)
    if not len(grams):
        return grams, counts
    return grams, np.rint(counts * (_WEIGHT / counts.sum())).astype(np.int64)


def unit_rows(sums: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
    return (sums / np.where(lengths == 0, 1, lengths)).astype(np.float32)


def learn_profiles(
    docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED
) -> Profiles:
    """Prototypes from every row of ``docs`` that has a language and a letter.

    Each task bundles what it reads into one integer vector a language, and these are summed in Spark, so
    the sums are the same for any partitioning. Only one vector a language reaches the driver. A language
    whose texts have no letter is not learned. No rows give no languages.
    """

    def bundles(batches):
        binder = Binder(dimensions, seed)
        weights: dict[str, np.ndarray] = {}

        def partial():
            for name, dense in weights.items():
                grams = np.flatnonzero(dense)
                if len(grams):
                    yield name, binder.bundle(grams, dense[grams]).astype(np.int64)

        def batch(rows):
            names = [name for name, _ in rows for _ in range(dimensions)]
            spots = np.tile(np.arange(dimensions, dtype=np.int32), len(rows))
            sums = np.concatenate([vector for _, vector in rows]) if rows else np.zeros(0, dtype=np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(spots, pa.int32()), pa.array(sums, pa.int64())],
                ["lang", "at", "s"],
            )

        for rows in batches:
            for name, value in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                grams, w = document_weights(value)
                if name not in weights and len(weights) == 32:
                    yield batch(list(partial()))
                    weights.clear()
                if name not in weights:
                    weights[name] = np.zeros(SYMBOLS**3, dtype=np.int64)
                weights[name][grams] += w
        yield batch(list(partial()))

    learned = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null")
    parts = in_small_batches(learned).mapInArrow(bundles, "lang string, at int, s bigint")
    sums = materialise(parts.groupBy("lang", "at").agg(F.sum("s").alias("s")))
    n = sums.where("at = 0").count()
    if n > MAX_LANGUAGES:
        raise ValueError(f"{n} languages; more than {MAX_LANGUAGES} are not held")
    rows = sums.toPandas()
    names = sorted(rows["lang"].unique())
    dense = np.zeros((len(names), dimensions))
    dense[np.searchsorted(names, rows["lang"]), rows["at"]] = rows["s"]
    return Profiles(names, unit_rows(dense), dimensions, seed)


def identify(
    docs: DataFrame, profiles: Profiles, doc_id: str = "doc_id", text: str = "text", extra: dict | None = None
) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, and the columns of ``extra`` (name: column) behind them.

    A null, empty or letterless text is ``und`` with score 0. Equal texts get equal results; repeated rows
    and null ids are kept. Texts are read whole, however long.
    """
    extra = extra or {}
    columns = [F.col(doc_id).alias("doc_id"), F.col(text).alias("text")]
    source = docs.select(*columns, *[column.alias(name) for name, column in extra.items()])
    kept = [name for name in source.columns if name != "text"]

    def predict(batches):
        binder = profiles.binder()
        for rows in batches:
            found = [profiles.identify(value, binder) for value in rows.column(1).to_pylist()]
            arrays = [rows.column(name) for name in kept]
            arrays += [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "lang_pred", "score"])

    types = dict(source.dtypes)
    schema = ", ".join(f"`{name}` {types[name]}" for name in kept) + ", lang_pred string, score double"
    return in_small_batches(source).mapInArrow(predict, schema).select("doc_id", *extra, "lang_pred", "score")


def keep_identified(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is like one of the languages (``Profiles.accepts``).

    All columns stay as they are, whatever their names. Null, empty and letterless texts go.
    """
    at = docs.columns.index(text)

    def keep(batches):
        binder = profiles.binder()
        for rows in batches:
            yield rows.filter(pa.array([profiles.accepts(x, binder) for x in rows.column(at).to_pylist()], pa.bool_()))

    return in_small_batches(docs).mapInArrow(keep, docs.schema)
