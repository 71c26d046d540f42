"""Toxicity scores from a convolutional text classifier, written in numpy.

A word's embedding is the sum of hashed vectors of the word and of its first three to seven letters, so that
unseen forms of a word are covered. Filters one, two and three words wide run over the whole text; each
filter keeps its greatest response (max pooling), and a logistic layer joins them. A language, recognised
from the text alone, has its own threshold, at which the score is one half.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import Scratch, blocks_at_space, in_small_batches, with_places, without_places
from wattlake.llm.language import Binder, Profiles, document_weights, ngrams, unit_rows
from wattlake.session import materialise, small_table

BUCKETS = 1 << 16
PREFIXES = (3, 4, 5, 6, 7)
SIZE = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
#: The fit takes at most so many labelled rows of either label, and only texts of at most so many characters.
FIT_POSITIVE, FIT_NEGATIVE, FIT_CHARS = 3000, 5000, 32_768
EPOCHS, BATCH_DOCS, RATE = 6, 32, 0.02
#: Every fifth row of the sample isn't learned from, so that small tables have such rows for thresholds as well.
CALIBRATION = 5
#: A language needs so many rows of either label for a threshold of its own.
LEAST_ROWS = 8
#: Thresholds are chosen on logits in steps of 1 / STEPS, cut off beyond FARTHEST.
STEPS, FARTHEST = 100, 50
_WORD = re.compile(r"\w+")
_CACHE_WORDS = 40_000


def _features(word: str) -> list[int]:
    """Buckets of the word and its prefixes; bucket 0 stays zero and pads."""
    raw = word.encode("utf-8", "surrogatepass")
    found = [1 + zlib.crc32(b"=" + raw) % (BUCKETS - 1)]
    for n in PREFIXES:
        found.append(1 + zlib.crc32(b"^" + word[:n].encode("utf-8", "surrogatepass")) % (BUCKETS - 1) if len(word) > n else 0)
    return found


def _feature_rows(words) -> np.ndarray:
    return np.array([_features(word) for word in words], dtype=np.int32).reshape(-1, 1 + len(PREFIXES))


@dataclass
class Network:
    """Weights: embeddings, a filter bank for each width, and the logistic layer."""

    embedding: np.ndarray
    banks: list[np.ndarray]
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float

    @classmethod
    def fresh(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        embedding = rng.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32)
        embedding[0] = 0
        banks = [rng.normal(0, 0.3, (k, SIZE, FILTERS)).astype(np.float32) for k in WIDTHS]
        out = np.abs(rng.normal(0, 0.3, len(WIDTHS) * FILTERS)).astype(np.float32)
        out[FILTERS // 2::FILTERS] *= -1
        return cls(embedding, banks, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], out, -1.0)

    def tables(self, words: np.ndarray) -> list[list[np.ndarray]]:
        """What each word adds to each filter at each of its offsets."""
        vectors = self.embedding[words].sum(axis=1)
        return [[vectors @ bank[j] for j in range(len(bank))] for bank in self.banks]

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        """Rounded, because the last digits of matrix products depend on what else is in a batch."""
        return np.round((np.maximum(pooled, 0) * self.out).sum(axis=1, dtype=np.float64) + self.bias, 4)


def _responses(tables: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
    """Responses of one bank at every position of a padded word sequence."""
    n = len(ids) - len(tables) + 1
    total = tables[0][ids[:n]]
    for j in range(1, len(tables)):
        total = total + tables[j][ids[j:j + n]]
    return total


class _Sample:
    """The fit's documents: word ids into one list of distinct words; id 0 is padding on both sides."""

    def __init__(self, texts: list[str]) -> None:
        ids: dict[str, int] = {}
        pad = [0] * (max(WIDTHS) - 1)
        self.documents = []
        for text in texts:
            words = [ids.setdefault(word, len(ids) + 1) for word in _WORD.findall(text.lower())]
            self.documents.append(np.array(pad + words + pad, dtype=np.int32))
        self.features = np.concatenate([np.zeros((1, 1 + len(PREFIXES)), np.int32), _feature_rows(ids)])


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Network:
    """A network fitted to the texts with Adam; both labels weigh the same in all. One label gives a constant."""
    net = Network.fresh(seed)
    labels = np.asarray(labels, dtype=np.float64)
    if not len(labels) or labels.min() == labels.max():
        net.out[:] = 0
        net.bias = -4.0 if not len(labels) or labels[0] == 0 else 4.0
        return net
    sample, rng = _Sample(texts), np.random.default_rng(seed)
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    dense = [*net.banks, *net.shifts, net.out]
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in dense]
    bias_moments, sparse = [0.0, 0.0], (np.zeros_like(net.embedding), np.zeros_like(net.embedding))
    step = 0
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH_DOCS)):
            step += 1
            documents = [sample.documents[i] for i in part]
            used, ids = np.unique(np.concatenate(documents), return_inverse=True)
            starts = np.cumsum([0, *map(len, documents)])
            buckets = sample.features[used]
            vectors = net.embedding[buckets].sum(axis=1)
            pooled, where = [], []
            for bank, shift in zip(net.banks, net.shifts, strict=True):
                tables = [vectors @ bank[j] for j in range(len(bank))]
                best, at = [], []
                for d in range(len(part)):
                    found = _responses(tables, ids[starts[d]:starts[d + 1]])
                    spot = found.argmax(axis=0)
                    at.append(spot + starts[d])
                    best.append(found[spot, np.arange(FILTERS)] + shift)
                pooled.append(np.array(best))
                where.append(np.array(at))
            wide = np.concatenate(pooled, axis=1)
            hidden = np.maximum(wide, 0)
            logit = hidden @ net.out + net.bias
            slope = ((1 / (1 + np.exp(-logit)) - labels[part]) * weight[part] / len(part)).astype(np.float32)
            grads_out = hidden.T @ slope + 1e-4 * net.out
            back = slope[:, None] * net.out * (wide > 0)
            grad_vectors = np.zeros_like(vectors)
            grads_bank, grads_shift = [], []
            for k, bank in enumerate(net.banks):
                g, spots = back[:, k * FILTERS:(k + 1) * FILTERS], where[k]
                grad_bank = np.zeros_like(bank)
                for j in range(len(bank)):
                    words = ids[spots + j]
                    grad_bank[j] = np.einsum("df,dfs->sf", g, vectors[words])
                    np.add.at(grad_vectors, words.ravel(), (g[:, :, None] * bank[j].T[None]).reshape(-1, SIZE))
                grads_bank.append(grad_bank + 1e-4 * bank)
                grads_shift.append(g.sum(axis=0))
            for x, grad, (m, v) in zip(dense, [*grads_bank, *grads_shift, grads_out], moments, strict=True):
                _adam(x, grad, m, v, step)
            value = float(slope.sum())
            bias_moments[0] = 0.9 * bias_moments[0] + 0.1 * value
            bias_moments[1] = 0.999 * bias_moments[1] + 0.001 * value * value
            net.bias -= RATE * (bias_moments[0] / (1 - 0.9**step)) / (np.sqrt(bias_moments[1] / (1 - 0.999**step)) + 1e-8)
            moved = np.flatnonzero(np.abs(grad_vectors).sum(axis=1))
            flat = buckets[moved].ravel()
            rows, inverse = np.unique(flat, return_inverse=True)
            grad = np.zeros((len(rows), SIZE), np.float32)
            np.add.at(grad, inverse, np.repeat(grad_vectors[moved], buckets.shape[1], axis=0))
            grad[rows == 0] = 0
            old, m, v = net.embedding[rows], sparse[0][rows], sparse[1][rows]
            _adam(old, grad, m, v, step)
            net.embedding[rows], sparse[0][rows], sparse[1][rows] = old, m, v
            net.embedding[0] = 0
    return net


def _adam(x: np.ndarray, grad: np.ndarray, m: np.ndarray, v: np.ndarray, step: int) -> None:
    m += 0.1 * (grad - m)
    v += 0.001 * (grad * grad - v)
    x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


@dataclass
class Scorer:
    """The network with its language profiles and thresholds; scores one text after another."""

    net: Network
    profiles: Profiles
    thresholds: dict[str, float]
    threshold: float
    known: dict[str, int] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self._forget()
        self.binder = Binder(self.profiles.dimensions, self.profiles.seed)
        self.closeness = np.full((1 << 18, len(self.profiles.languages)), np.nan, dtype=np.float32)

    def __getstate__(self) -> dict:
        return {"net": self.net, "profiles": self.profiles, "thresholds": self.thresholds, "threshold": self.threshold}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.known = {}
        self.__post_init__()

    def _forget(self) -> None:
        self.known, self.used = {}, 1
        zero = self.net.tables(np.zeros((1, 1 + len(PREFIXES)), np.int32))
        self.tables = [[np.zeros((1, FILTERS), np.float32) + t for t in bank] for bank in zero]

    def _ids(self, words: list[str]) -> np.ndarray:
        """Rows of the words in ``tables``; words not seen of late are added."""
        codes, distinct = pd.factorize(np.array(words, dtype=object))
        fresh = [word for word in distinct if word not in self.known]
        if self.used + len(fresh) > _CACHE_WORDS and self.known:
            self._forget()
            fresh = list(distinct)
        if fresh:
            new = self.net.tables(_feature_rows(fresh))
            self.tables = [[np.concatenate(x) for x in zip(a, b, strict=True)] for a, b in zip(self.tables, new, strict=True)]
            self.known.update(zip(fresh, range(self.used, self.used + len(fresh)), strict=True))
            self.used += len(fresh)
        return np.fromiter(map(self.known.__getitem__, distinct), np.int32, len(distinct))[codes]

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """The network's value for every whole text. A long text goes through block by block."""
        pooled = np.full((len(texts), len(WIDTHS) * FILTERS), -np.inf, dtype=np.float32)
        pad = np.zeros(max(WIDTHS) - 1, dtype=np.int32)
        group: list[tuple[int, list[str]]] = []
        waiting = 0

        def flush() -> None:
            words = [word for _, found in group for word in found]
            ids = self._ids(words) if words else np.zeros(0, np.int32)
            parts, starts, at, end = [], [], 0, 0
            for _, found in group:
                starts.append(end)
                parts += [pad, ids[at:at + len(found)], pad]
                at, end = at + len(found), end + len(found) + 2 * len(pad)
            flat = np.concatenate(parts)
            owners = np.array([d for d, _ in group])
            for k, (tables, shift) in enumerate(zip(self.tables, self.net.shifts, strict=True)):
                # A window over two documents' ends would be wrong; the padding between them is wide enough.
                best = np.maximum.reduceat(_responses(tables, flat), starts, axis=0) + shift
                np.maximum.at(pooled[:, k * FILTERS:(k + 1) * FILTERS], owners, best)
            group.clear()

        for d, text in enumerate(texts):
            carried: list[str] = []
            for block in blocks_at_space((text or "").lower()):
                words = carried + _WORD.findall(block)
                group.append((d, words))
                waiting += len(words)
                carried = words[-(max(WIDTHS) - 1):]
                if waiting > 200_000:
                    flush()
                    waiting = 0
        if group:
            flush()
        return self.net.logit(pooled)

    def language(self, text: str | None) -> str | None:
        """The language with the greatest cosine; None without a letter."""
        grams, counts = ngrams(text)
        if not len(grams) or not self.profiles.languages:
            return None
        fresh = grams[np.isnan(self.closeness[grams, 0])]
        for start in range(0, len(fresh), 512):
            part = fresh[start:start + 512]
            self.closeness[part] = self.binder.bound(part) @ self.profiles.prototypes.T
        return self.profiles.languages[int(np.argmax(counts.astype(np.float32) @ self.closeness[grams]))]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        limits = np.array([self.thresholds.get(self.language(text), self.threshold) for text in texts])
        return 1 / (1 + np.exp(-np.clip(self.logits(texts) - limits, -30, 30)))


def best_threshold(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> float:
    """Where fewest rows, or least weight, fall on the wrong side; of several such places amid the widest gap."""
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], labels[order]
    w = np.ones(len(x)) if weights is None else weights[order]
    # Cutting before row i calls rows i.. positive.
    missed = np.concatenate([[0], np.cumsum(w * (y == 1))])
    wrong = np.concatenate([np.cumsum((w * (y == 0))[::-1])[::-1], [0]])
    cost = np.round(missed + wrong, 6)
    edge = np.concatenate([[True], x[1:] > x[:-1], [True]])
    cost[~edge] = np.inf
    gap = np.concatenate([[0.0], x[1:] - x[:-1], [0.0]])
    gap[cost > cost.min()] = -1
    i = int(np.argmax(gap))
    if i == 0:
        return float(x[0] - 1)
    if i == len(x):
        return float(x[-1] + 1)
    return float((x[i - 1] + x[i]) / 2)


def _held(labels: np.ndarray) -> np.ndarray:
    """Which rows of the sample aren't learned from."""
    held = np.arange(len(labels)) % CALIBRATION == 0
    if len(labels) and (labels[held].sum() == 0 or labels[~held].sum() == 0):
        held[:] = False
    return held


def fit(texts: list[str], labels: list[int], languages: list[str | None], seed: int = 7) -> Scorer:
    """A scorer from labelled texts. A text's language serves to learn profiles and to group thresholds."""
    y, n = np.asarray(labels, dtype=np.int64), len(texts)
    held = _held(y)
    net = train([t for t, h in zip(texts, held, strict=True) if not h], y[~held], seed)
    names = sorted({x for x in languages if x is not None})
    binder = Binder()
    sums = np.zeros((len(names), binder.dimensions))
    for name, text in zip(languages, texts, strict=True):
        grams, weights = document_weights(text)
        if name is not None and len(grams):
            sums[names.index(name)] += binder.bundle(grams, weights)
    scorer = Scorer(net, Profiles(names, unit_rows(sums)), {}, 0.0)
    spoken = np.array([scorer.language(t) or "" for t in texts], dtype=object)
    set_thresholds(scorer, spoken, scorer.logits(texts) if n else np.zeros(0), y, ~held, np.ones(n))
    return scorer


def set_thresholds(
    scorer: Scorer, languages: np.ndarray, logits: np.ndarray, labels: np.ndarray, learned: np.ndarray, counts: np.ndarray
) -> None:
    """Sets the thresholds by counts of labelled rows, of each language with enough rows and of all.

    Rows learned from have logits that no other row would get. So the others stand for all rows of their label
    where they are LEAST_ROWS of either label, with the weight of all, so the mix of labels is the true one.
    Where they are fewer, all rows are taken.
    """
    def total(chosen: np.ndarray) -> list[float]:
        return [float(counts[chosen & (labels == label)].sum()) for label in (0, 1)]

    def choose(own: np.ndarray) -> float:
        every, others = total(own), total(own & ~learned)
        if min(others) < LEAST_ROWS:
            return best_threshold(logits[own], labels[own], counts[own])
        share = np.array([every[0] / others[0], every[1] / others[1]])
        own = own & ~learned
        return best_threshold(logits[own], labels[own], counts[own] * share[labels[own]])

    everyone = np.ones(len(labels), dtype=bool)
    scorer.thresholds, scorer.threshold = {}, 0.0
    if min(total(everyone)) > 0:
        scorer.threshold = choose(everyone)
    for name in scorer.profiles.languages:
        if min(total(languages == name)) >= LEAST_ROWS:
            scorer.thresholds[name] = choose(languages == name)


def learn(docs: DataFrame, labelled: DataFrame, seed: int = 7) -> Scorer:
    """A scorer fitted to documents ``(doc_id, text, lang)`` with labels ``(doc_id, toxic)``.

    The network takes a bounded sample: at most ``FIT_POSITIVE`` and ``FIT_NEGATIVE`` labelled ids, spread over
    all of them by a hash of the id, and their texts of at most ``FIT_CHARS`` characters. The thresholds are
    set on all labelled rows, scored whole, by counts in the true mix of labels. Rows with a null id, label or
    text are left out; an id labelled in both ways counts as toxic. Without labels every score is the same,
    below one half. Every document is scored once, and only ids, languages and logits meet the labels.
    """
    return _learned(docs, labelled, seed)[0]


def _learned(docs: DataFrame, labelled: DataFrame, seed: int, place: list[str] = ()) -> tuple[Scorer, DataFrame]:
    """The scorer and the logits of all documents."""
    one = labelled.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit(seed))
    sample = one.where("toxic = 1").orderBy(order).limit(FIT_POSITIVE).union(
        one.where("toxic = 0").orderBy(order).limit(FIT_NEGATIVE)
    )
    texts = docs.select("doc_id", "text", "lang").where(F.length("text") <= FIT_CHARS)
    rows = (
        texts.join(F.broadcast(sample), "doc_id")  # at most FIT_POSITIVE + FIT_NEGATIVE rows
        .orderBy(order, "text", "lang").limit(FIT_POSITIVE + FIT_NEGATIVE).collect()
    )
    scorer = fit([r.text for r in rows], [r.toxic for r in rows], [r.lang for r in rows], seed)
    held = _held(np.array([r.toxic for r in rows], dtype=np.int64))
    learned = sorted({r.doc_id for r, h in zip(rows, held, strict=True) if not h})
    logits = _logits(docs, scorer, list(place))
    found = _label_counts(logits, one, learned).collect()  # bounded by languages and steps
    if found:
        language, step, toxic, seen, n = (np.array(x, dtype=object) for x in zip(*found, strict=True))
        set_thresholds(
            scorer, language, step.astype(np.float64) / STEPS, toxic.astype(np.int64), seen.astype(bool), n.astype(np.float64)
        )
    return scorer, logits


def _logits(docs: DataFrame, scorer: Scorer, place: list[str]) -> DataFrame:
    """``doc_id, language, logit, given`` and the place of every document, computed once; no text is carried further."""
    source = docs.select("doc_id", "text", *place)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # of a fixed size

    def look(batches):
        own = shared.value
        for rows in batches:
            texts = rows.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([own.language(text) or "" for text in texts], pa.string()),
                 pa.array(own.logits(texts), pa.float64()), rows.column(1).is_valid(), *rows.columns[2:]],
                ["doc_id", "language", "logit", "given", *place],
            )

    kind = dict(source.dtypes)["doc_id"]
    places = "".join(f", `{x}` bigint" for x in place)
    return materialise(in_small_batches(source).mapInArrow(look, f"doc_id {kind}, language string, logit double, given boolean{places}"))


def _label_counts(logits: DataFrame, labels: DataFrame, learned: list) -> DataFrame:
    """``language, step, toxic, learned, n``: counts of labelled rows by recognised language and rounded logit."""
    kind = dict(logits.dtypes)["doc_id"]
    known = logits.sparkSession.createDataFrame([(x,) for x in learned], f"doc_id {kind}").withColumn("learned", F.lit(True))
    step = F.rint(F.least(F.greatest("logit", F.lit(-FARTHEST)), F.lit(FARTHEST)) * STEPS).cast("int").alias("step")
    rows = logits.where("given").join(labels, "doc_id").join(F.broadcast(known), "doc_id", "left")  # at most the sample
    seen = F.coalesce("learned", F.lit(False)).alias("learned")
    return rows.select("language", step, "toxic", seen).groupBy("language", "step", "toxic", "learned").agg(F.count("*").alias("n"))


def classify(docs: DataFrame, labelled: DataFrame, seed: int = 7) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs`` by what ``learn`` learns; each text is scored once."""
    found = _scores(*_learned(docs, labelled, seed)).select("doc_id", "score")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labelled: DataFrame, seed: int = 7) -> DataFrame:
    """The rows of ``docs(doc_id, text, lang, ..)`` that score below one half by what ``learn`` learns, with all columns.

    Each text is scored once. Rows are told apart by their places, so repeated rows share a fate and null ids are
    rows like others.
    """
    filed = Scratch(docs.sparkSession)
    placed, place = with_places(docs, filed)
    toxic = _scores(*_learned(placed, labelled, seed, place)).where("score >= 0.5").select(*place)
    return without_places(placed, toxic, place, filed).select(*docs.columns)


def _scores(scorer: Scorer, logits: DataFrame) -> DataFrame:
    """``logits`` with ``score`` by the thresholds of the recognised languages."""
    limits = small_table(
        logits.sparkSession, [{"language": x, "own": y} for x, y in scorer.thresholds.items()], "language string, own double"
    )
    far = F.col("logit") - F.coalesce("own", F.lit(float(scorer.threshold)))
    value = 1 / (1 + F.exp(-F.least(F.greatest(far, F.lit(-30.0)), F.lit(30.0))))
    return logits.join(F.broadcast(limits), "language", "left").withColumn("score", value)  # a row for each language


def score(docs: DataFrame, scorer: Scorer, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every row; null, empty and wordless texts get one and the same score."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # of a fixed size

    def predict(batches):
        own = shared.value
        for rows in batches:
            found = own.scores(rows.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32), pa.int32())],
                ["doc_id", "score", "predicted"],
            )

    return in_small_batches(source).mapInArrow(predict, f"doc_id {dict(source.dtypes)['doc_id']}, score double, predicted int")


def keep_clean(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below one half, with all their columns."""
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def keep(batches):
        for rows in batches:
            yield rows.filter(pa.array(shared.value.scores(rows.column(at).to_pylist()) < 0.5, pa.bool_()))

    return in_small_batches(docs).mapInArrow(keep, docs.schema)
