"""Toxicity by nearest labelled examples: exact cosine of label-weighted TF-IDF over a block-max inverted index,
similarity-weighted votes, and calibrated scores with their evidence."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SLICE_ROWS, TO_WORDS, byte_class, byte_texts, column_type, give_back, map_arrow, slices, word_bounds
from quarry.llm.labelled import Sample, held_out, labelled_sample
from quarry.llm.wordhash import byte_sums, mix, range_hashes, text_pieces

#: Bound of the fit: examples of each class. All their words and word starts are features.
EXAMPLES = 2048
#: How far beyond chance a feature's association with the label must be to be told as a term (standard errors).
LEAST_Z = 4.5
#: Lengths of word starts that are features beside the words themselves.
STEMS = (4, 5, 6)
NEIGHBOURS, BLOCK = 32, 256
#: Searches that a task remembers.
KNOWN = 2_000
#: Bytes of words once all others are spaces.
_IN_WORD = ~byte_class(b" ")
#: A feature is common from one in so many examples on.
COMMON = 12
#: How far single precision may be off on cosines (a sum of some hundred products of at most 1).
_ROUGH = 1e-4
#: Weight of the base rate among the votes.
PRIOR_VOTES = 0.5


def word_features(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, ends, hashes) of the features of a lower-cased text, piece by piece: its words, and
    per length their starts, which are other features than words of the same letters."""
    text = text.translate(TO_WORDS)
    for lo, raw in text_pieces(text, _IN_WORD):
        starts, ends = word_bounds(raw, _IN_WORD)
        sums = byte_sums(raw)
        yield starts + lo, ends + lo, range_hashes(*sums, starts, ends)
        long, size = starts, ends - starts
        for n in STEMS:  # ascending
            long, size = long[size >= n], size[size >= n]
            yield long + lo, long + lo + n, mix(range_hashes(*sums, long, long + n) + np.uint64(n))


def feature_hashes(text: bytes) -> np.ndarray:
    """The hashes of all features of a text, one for each place."""
    found = [h for _, _, h in word_features(text)]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _together(texts: list[bytes], size: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, bytes]]:
    """(starts, numbers, joined text) of runs of texts of about ``size`` bytes together."""
    lo = 0
    while lo < len(texts):
        hi, held = lo + 1, len(texts[lo])
        while hi < len(texts) and held + len(texts[hi]) <= size:
            held += len(texts[hi])
            hi += 1
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[lo:hi - 1])])
        yield begins, np.arange(lo, hi), b" ".join(texts[lo:hi])
        lo = hi


class Vocabulary:
    """All features of the examples by their hashes, in ascending order; a feature's number is its
    place among them. A hash is looked up by its first bits, of which few features share any."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = hashes
        bits = len(hashes).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(hashes >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, features) of the hashes that are features, in no order."""
        bucket = (hashes >> self.shift).astype(np.int64)
        feature, end = self.first[bucket], self.first[bucket + 1]
        at = np.flatnonzero(feature < end)
        feature, end, found = feature[at], end[at], []
        while len(at):
            hit = self.hashes[feature] == hashes[at]
            found.append((at[hit], feature[hit]))
            on = ~hit & (feature + 1 < end)
            at, feature, end = at[on], feature[on] + 1, end[on]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return np.concatenate([a for a, _ in found]), np.concatenate([f for _, f in found])

    def counts(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`counts_all` for one text."""
        return self.counts_all([text])[0]

    def counts_all(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(features in ascending order, how often each is there) of each text. Short texts are hashed
        together, long ones piece by piece."""
        size = max(len(self.hashes), 1)
        keys = [np.zeros(0, np.int64)]
        for begins, owners, joined in _together(texts):
            for starts, _, hashes in word_features(joined):
                known, features = self.places(hashes)
                own = np.repeat(owners, np.diff(np.searchsorted(starts, [*begins, len(joined)])))  # starts ascend
                keys.append(own[known] * size + features)
        found, n = np.unique(np.concatenate(keys), return_counts=True)
        cut = np.searchsorted(found, np.arange(len(texts) + 1) * size)
        return [((found[a:b] - i * size).astype(np.int32), n[a:b].astype(np.int32)) for i, (a, b) in enumerate(zip(cut, cut[1:]))]


def features_in(texts: list[bytes], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all features of the texts, and by how many standard errors the share of texts
    with a feature differs between the classes; without texts of both classes none."""
    n1, n0 = int(labels.sum()), int(len(labels) - labels.sum())
    if not n1 or not n0:
        return np.zeros(0, np.uint64), np.zeros(0)
    own = [np.unique(feature_hashes(t)) for t in texts]
    hashes = np.unique(np.concatenate(own))
    vocabulary = Vocabulary(hashes)
    a, b = np.zeros(len(hashes)), np.zeros(len(hashes))
    for found, label in zip(own, labels):
        (a if label else b)[vocabulary.places(found)[1]] += 1
    p = (a + b) / (n1 + n0)
    return hashes, np.abs(a / n1 - b / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))


def spelled(texts: list[bytes], wanted: np.ndarray) -> dict[int, bytes]:
    """hash -> text of the wanted features (sorted hashes), starts with a ``*``."""
    out: dict[int, bytes] = {}
    for text in texts:
        low = text.translate(TO_WORDS)
        for k, (starts, ends, hashes) in enumerate(word_features(text)):
            at = np.minimum(np.searchsorted(wanted, hashes), max(len(wanted) - 1, 0))
            for i in np.flatnonzero(wanted[at] == hashes) if len(wanted) else ():
                out.setdefault(int(hashes[i]), low[starts[i]:ends[i]] + b"*" * (k % (len(STEMS) + 1) > 0))
    return out


def arrays(vector: dict[int, float] | tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A vector as (features, weights)."""
    if isinstance(vector, tuple):
        return vector
    return np.array(list(vector), np.int64), np.array(list(vector.values()), float)


def _runs(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all places of some runs one after another, the runs' lengths); int32."""
    n = end - first
    at = np.repeat(first - (np.cumsum(n, dtype=np.int32) - n), n)
    at += np.arange(len(at), dtype=np.int32)
    return at, n


class BlockMaxIndex:
    """Unit vectors by feature: postings of the rarer features, and in blocks of examples the
    weights of the common ones with each one's largest weight in each block. A search adds up the
    postings, and then the common features in those blocks that by their bounds can hold one of the
    k best, so its result is exact. Blocks are kept in single precision; what may be among the best
    is added up in double, from each example's own list of common features."""

    def __init__(self, vectors: Iterable, n_features: int, block: int = BLOCK) -> None:
        parts = [arrays(v) for v in vectors]
        self.block, self.size = block, len(parts)
        feature = np.concatenate([np.zeros(0, np.int32), *(f for f, _ in parts)]).astype(np.int32)
        weight = np.concatenate([np.zeros(0), *(w for _, w in parts)])
        sizes = [len(f) for f, _ in parts]
        del parts
        example = np.repeat(np.arange(self.size, dtype=np.int32), sizes)
        common = np.bincount(feature, minlength=n_features) * COMMON >= max(1, self.size)
        self.column = np.where(common, np.cumsum(common) - 1, -1).astype(np.int32)
        often = common[feature]
        self.own_column, self.own_weight = self.column[feature[often]], weight[often]
        self.own_first = np.searchsorted(example[often], np.arange(self.size + 1)).astype(np.int32)
        self.rough = np.zeros((int(common.sum()), -(-self.size // block) * block), np.float32)
        self.rough[self.own_column, example[often]] = self.own_weight
        self.largest = self.rough.reshape(len(self.rough), -(-self.size // block), block).max(axis=2, initial=0)
        feature, weight, example = feature[~often], weight[~often], example[~often]
        order = np.argsort(feature, kind="stable")
        self.example, self.weight = example[order].astype(np.min_scalar_type(self.size)), weight[order]
        self.first = np.searchsorted(feature[order], np.arange(n_features + 1)).astype(np.int32)

    def posted(self, features: np.ndarray, q: np.ndarray) -> np.ndarray:
        """What the postings of some features add to each example."""
        at, n = _runs(self.first[features], self.first[features + 1])
        weight = self.weight.take(at)
        weight *= np.repeat(q, n)
        return np.bincount(self.example.take(at), weight, self.rough.shape[1])

    def shared(self, q: np.ndarray, some: np.ndarray) -> np.ndarray:
        """What the common features add to some examples; ``q`` has the query's weight of each."""
        at, n = _runs(self.own_first[some], self.own_first[some + 1])
        return np.bincount(np.repeat(np.arange(len(some)), n), self.own_weight.take(at) * q[self.own_column.take(at)], len(some))

    def search_all(self, queries: list, k: int, skip: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """For each query the ``k`` examples of the highest positive cosines (of those that tie at
        the last place the first ones); ``skip`` has an example for each that is left out."""
        if not self.size:
            return [[] for _ in queries]
        scores = np.zeros((len(queries), self.rough.shape[1]))
        common = np.zeros((len(queries), len(self.rough)))
        for i, query in enumerate(queries):
            features, q = arrays(query)
            column = self.column[features]
            common[i, column[column >= 0]] = q[column >= 0]
            scores[i] = self.posted(features[column < 0], q[column < 0])
            if skip is not None:
                scores[i, skip[i]] = -np.inf
        last = np.partition(scores, -k, axis=1)[:, -k] if k <= self.size else np.zeros(len(queries))
        rough, quick = scores.astype(np.float32), common.astype(np.float32)
        bounds = rough.reshape(len(queries), self.largest.shape[1], self.block).max(axis=2) + quick @ self.largest
        for b in range(self.largest.shape[1]):
            some = np.flatnonzero((bounds[:, b] > 0) & (bounds[:, b] >= last - _ROUGH))
            here = slice(b * self.block, (b + 1) * self.block)
            if len(some) == len(rough):
                rough[:, here] += quick @ self.rough[:, here]
            elif len(some):
                rough[some, here] += quick[some] @ self.rough[:, here]
        places = np.partition(rough, -k, axis=1)[:, -k] if k < rough.shape[1] else np.zeros(len(rough), np.float32)
        out = []
        for row, near, least, own in zip(scores, rough, places, common):
            some = np.flatnonzero(near[:self.size] >= max(float(least), 0.0) - _ROUGH)
            some = some[np.isfinite(row[some])]
            exact = row[some] + self.shared(own, some)
            some, exact = some[exact > 0], exact[exact > 0]
            best = np.lexsort((some, -exact))[:k]
            out.append(list(zip(exact[best].tolist(), some[best].tolist())))
        return out

    def search(self, query, k: int, skip: int | None = None) -> list[tuple[float, int]]:
        """:meth:`search_all` for one query."""
        return self.search_all([query], k, None if skip is None else [skip])[0]


class Model:
    """The index, the weights of features and the calibration."""

    def __init__(self, vocabulary: Vocabulary, terms: dict[int, bytes], idf: np.ndarray, z: np.ndarray, ids: list[int],
                 labels: np.ndarray, examples: list[tuple[np.ndarray, np.ndarray]], totals: tuple[int, int]) -> None:
        self.vocabulary, self.terms, self.value = vocabulary, terms, idf * z
        self.telling = z >= LEAST_Z
        # alike examples share blocks, so that a block's largest weights say more about it
        order = sorted(range(len(ids)), key=lambda i: (
            (f := examples[i][0])[self.value[f].argmax()] if len(examples[i][0]) else -1, len(examples[i][0]), i))
        self.ids, self.labels = [ids[i] for i in order], labels[order]
        labels, examples = self.labels, [examples[i] for i in order]
        n = [max(1, int((labels == c).sum())) for c in (0, 1)]
        #: An example stands for so many labelled rows of its class, relative to the base rate.
        share = np.array(totals, float) / max(1, sum(totals))
        self.rate = float(share[1]) if sum(totals) else 0.0
        self.votes = np.array([share[c] * 2 * len(labels) / (2 * n[c]) for c in (0, 1)])
        self.index = BlockMaxIndex((self.unit(c) for c in examples), len(idf))  # which keeps none of the vectors
        self.known: dict[bytes, list[tuple[float, int]]] = {}
        self.line = (0.0, 0.0)
        raw = np.array([self.raw(near) for lo in range(0, len(examples), SLICE_ROWS) for near in self.index.search_all(
            [self.unit(c) for c in examples[lo:lo + SLICE_ROWS]], NEIGHBOURS, list(range(lo, min(lo + SLICE_ROWS, len(examples)))))])
        self.line = fit_line(raw, labels, self.votes[labels] if len(labels) else np.zeros(0), self.rate)

    def unit(self, counts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The vector of a text: TF-IDF of all its features, each times its association with the label."""
        features, n = counts
        weights = (1 + np.log(n)) * self.value[features]
        norm = math.sqrt(float(weights @ weights))
        return (features, weights / norm) if norm else (features[:0], weights[:0])

    def raw(self, near: list[tuple[float, int]]) -> float:
        """Log odds of the votes: a neighbour at distance 1 - cosine counts cosine squared."""
        yes, no = PRIOR_VOTES * self.rate, PRIOR_VOTES * (1 - self.rate)
        for cosine, e in near:
            weight = cosine * cosine * self.votes[self.labels[e]]
            if self.labels[e]:
                yes += weight
            else:
                no += weight
        return math.log(max(yes, 1e-6) / max(no, 1e-6))

    def neighbours(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> list[list[tuple[float, int]]]:
        """The searches, remembered for texts of equal features (a bounded number of them)."""
        keys = [hashlib.sha256(f.tobytes() + n.tobytes()).digest() for f, n in counts]
        if len(self.known) >= KNOWN:
            self.known.clear()
        new = {key: c for key, c in zip(keys, counts) if key not in self.known}
        self.known.update(zip(new, self.index.search_all([self.unit(c) for c in new.values()], NEIGHBOURS)))
        return [self.known[key] for key in keys]

    def score_all(self, texts: list[bytes]) -> list[tuple[float, list[tuple[float, int]], list[bytes]]]:
        counts = self.vocabulary.counts_all(texts)
        a, b = self.line
        return [(1 / (1 + math.exp(-max(-30.0, min(30.0, a * self.raw(near) + b)))), near,
                 sorted(self.terms[i] for i in f[self.telling[f]].tolist())) for (f, _), near in zip(counts, self.neighbours(counts))]


def fit_line(raw: np.ndarray, labels: np.ndarray, weights: np.ndarray, rate: float) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (raw, label), lightly held to the identity."""
    a, b = 1.0, 0.0
    if len(set(labels.tolist())) < 2:
        return a, b
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        g = np.array([((p - labels) * weights * raw).sum() + (a - 1), ((p - labels) * weights).sum() + b])
        h = weights * p * (1 - p)
        hess = np.array([[(h * raw * raw).sum() + 1, (h * raw).sum()], [(h * raw).sum(), h.sum() + 1]])
        step = np.linalg.solve(hess, g)
        a, b = max(0.05, a - float(np.clip(step[0], -1, 1))), b - float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-9:
            break
    return a, b


def document_counts(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> tuple[int, np.ndarray]:
    """How many of all documents there are, and how many hold each feature."""
    n_features = len(vocabulary.hashes)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        totals, rows = np.zeros(n_features, np.int64), 0
        for batch in slices(batches):
            for found, _ in sent.value.counts_all(byte_texts(batch, text)):
                rows += 1
                totals[found] += 1
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(totals[some], rows))],
                                         names=["feature", "n"])

    counted = map_arrow(docs.select(text), count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    table = counted.toArrow()  # a row a feature of the bounded sample
    sent.destroy()
    feature, n = (table.column(c).to_numpy() for c in ("feature", "n"))
    out = np.zeros(n_features)
    out[feature[feature >= 0]] = n[feature >= 0]
    return int(n[feature < 0].sum()), out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = EXAMPLES, id_col: str = "doc_id",
        text: str = "text") -> Model:
    """Examples and all their features from a bounded labelled sample; idf from all documents."""
    sample: Sample = labelled_sample(docs, labels, label, per_class, id_col, text)
    texts, y = [t.encode() for t in sample.texts], np.array(sample.labels, dtype=int)
    ids, totals = sample.ids, sample.totals
    del sample
    hashes, z = features_in(texts, y)
    vocabulary = Vocabulary(hashes)
    rows, holding = document_counts(docs, vocabulary, text)
    idf = np.log((1 + rows) / (1 + holding)) + 1
    told = spelled(texts, hashes[z >= LEAST_Z])
    terms = {int(i): told[int(hashes[i])] for i in np.flatnonzero(z >= LEAST_Z)}
    counts = vocabulary.counts_all(texts)
    del texts, told
    give_back()
    model = Model(vocabulary, terms, idf, z, ids, y, counts, totals)
    del counts
    give_back()  # the driver goes on with other stages
    return model


def _scored(docs: DataFrame, model: Model, id_col: str, text: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = "score double, neighbours array<struct<id:long,label:int,cosine:double>>, terms array<string>"

    def run(batches):
        m = sent.value
        for batch in slices(batches):
            rows = m.score_all(byte_texts(batch, text))
            near = [[{"id": m.ids[e], "label": int(m.labels[e]), "cosine": c} for c, e in r[1][:5]] for r in rows]
            kind = pa.list_(pa.struct([("id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array([r[0] for r in rows], pa.float64()), pa.array(near, kind),
                 pa.array([[t.decode("utf-8", "replace") for t in r[2]] for r in rows], pa.list_(pa.string()))],
                names=[id_col, "score", "neighbours", "terms"])

    kind = column_type(docs, id_col)
    return map_arrow(docs.select(id_col, text), run, f"{id_col} {kind}, {schema}")


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                   model: Model | None = None) -> DataFrame:
    """(id, held_out, score, predicted, neighbours, terms) for every row of ``docs``.

    ``score`` is the calibrated share of toxic rows among texts with such neighbours; ``predicted``
    is 1 from 0.5 on; ``neighbours`` are the five nearest examples and ``terms`` those of
    the features found that tell the classes apart by ``LEAST_Z``; the search uses all. Texts are whole; null and empty texts have no neighbours and score at the rate of such
    texts. Null and repeated ids keep their rows; extra columns are unused. Without labels of both
    classes no text has neighbours.
    """
    model = model or fit(docs, labels, id_col=id_col, text=text)
    return _scored(docs, model, id_col, text).select(
        id_col, held_out(id_col).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours", "terms")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``least``, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col=id_col, text=text))
    give_back()

    def run(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array([r[0] < least for r in sent.value.score_all(byte_texts(batch, text))], pa.bool_()))

    return map_arrow(docs, run, docs.schema)
