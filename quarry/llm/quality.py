"""Document quality by attention-based multiple-instance learning: every passage of a text is
encoded, gated attention weighs the passages, and the weighted mean of their codes is scored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import NOT_SPACE, byte_texts, column_type, map_arrow, slices, word_bounds
from quarry.llm.labelled import held_out, labelled_sample

#: Bound of the fit: documents of each class. All their passages are learned from.
DOCUMENTS = 2048
#: A passage starts at each so-many-th byte; codes, attention units and passes of the fit.
PASSAGE_BYTES, HIDDEN, GATES, PASSES = 384, 24, 12, 60
#: Share of label 1 from which a document is predicted to be good.
LEAST = 0.3

_CLASSES = 16
#: Byte classes whose pairs make the features of a passage (fixed values).
_GROUPS = [b"aeiou", b"bcdfghjklmnpqrstvwxyz", b"AEIOU", b"BCDFGHJKLMNPQRSTVWXYZ", b"0123456789", b" ", b"\n\r",
           b".,;:", b"!", b"?", b"|", b"\"'()[]{}<>", b"#$%&*+=@^_~`/\\", bytes(range(0x80, 0xC0)),
           bytes(range(0xC0, 0x100))]


def _class_table() -> np.ndarray:
    table = np.full(256, _CLASSES - 1, np.uint8)
    for i, group in enumerate(_GROUPS):
        table[list(group)] = i
    return table


_CLASS = _class_table()
#: Pairs of classes, three shares of words, and how far a passage's features can be trusted.
N_FEATURES = _CLASSES * _CLASSES + 4
#: Pairs at which a passage's features count half.
_HALF = 24


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every text, and how many passages each text has (1 at least).

    A feature is the root share of a pair of neighbouring byte classes; then come the mean word
    length, the share of word bytes and the share of words that repeat the word before; the last
    is n / (n + 24) for a passage of n pairs. A text's last bytes that don't fill half a passage
    belong to the one before.
    """
    texts = [t + b"\n" for t in texts]  # so that no word runs on into the next text
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(1, (sizes + PASSAGE_BYTES // 2) // PASSAGE_BYTES)
    total = int(counts.sum())
    raw = np.frombuffer(b"".join(texts), np.uint8)
    if not len(raw):
        return np.zeros((total, N_FEATURES), np.float32), counts
    kinds = _CLASS[raw].astype(np.int32)
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    owner = np.repeat(np.arange(len(texts)), sizes)
    offset = np.arange(len(raw)) - begin[owner]
    place = first[owner] + np.minimum(offset // PASSAGE_BYTES, counts[owner] - 1)
    inner = owner[1:] == owner[:-1]
    pair = place[:-1][inner] * (_CLASSES * _CLASSES) + kinds[:-1][inner] * _CLASSES + kinds[1:][inner]
    hist = np.bincount(pair, minlength=total * _CLASSES * _CLASSES).reshape(total, -1).astype(np.float32)
    out = np.zeros((total, N_FEATURES), np.float32)
    pairs = hist.sum(axis=1)
    out[:, :-4] = np.sqrt(hist / np.maximum(pairs, 1)[:, None])
    out[:, -1] = pairs / (pairs + _HALF)
    letters = (kinds < 4) | (kinds >= 13)
    inside = np.bincount(place, weights=letters, minlength=total)
    length = np.maximum(np.bincount(place, minlength=total), 1)
    breaks = np.bincount(place, weights=kinds == 5, minlength=total)
    out[:, -4] = np.minimum(inside / (breaks + 1), 20) / 20
    out[:, -3] = inside / length
    starts, ends = word_bounds(raw, NOT_SPACE)
    if len(starts) > 1:  # words by length and sum of bytes
        sums = np.concatenate(([0], np.cumsum(raw, dtype=np.int64)))
        size, total_bytes = ends - starts, sums[ends] - sums[starts]
        same = (size[1:] == size[:-1]) & (total_bytes[1:] == total_bytes[:-1]) & (size[1:] > 1)
        at = place[starts[1:]]
        out[:, -2] = np.bincount(at, weights=same, minlength=total) / np.maximum(np.bincount(at, minlength=total), 1)
    return out, counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Attention:
    """Codes relu(xE + e); attention softmax(w . (tanh(hV) * sigmoid(hU))); score sigmoid(zc + d)."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"E": draw(N_FEATURES, HIDDEN), "e": np.zeros(HIDDEN, np.float32), "V": draw(HIDDEN, GATES),
                  "U": draw(HIDDEN, GATES), "w": draw(GATES), "c": draw(HIDDEN), "d": np.zeros(1, np.float32)}
        self.mean = np.zeros(N_FEATURES, np.float32)

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict:
        """All passages of some documents, one after the other; ``counts`` of each."""
        p = self.p
        bag = np.repeat(np.arange(len(counts)), counts)
        start = np.concatenate(([0], np.cumsum(counts)[:-1]))
        x = (x - self.mean) * x[:, -1:]
        h = np.maximum(x @ p["E"] + p["e"], 0)
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        logit = (t * s) @ p["w"]
        weight = np.exp(logit - np.maximum.reduceat(logit, start)[bag])
        weight /= np.add.reduceat(weight, start)[bag]
        z = np.add.reduceat(weight[:, None] * h, start, axis=0)
        return {"x": x, "h": h, "t": t, "s": s, "a": weight, "z": z, "bag": bag, "start": start,
                "p": _sigmoid(z @ p["c"] + p["d"])}

    def gradients(self, f: dict, y: np.ndarray, weight: np.ndarray) -> dict:
        p = self.p
        dout = ((f["p"] - y) * weight / weight.sum()).astype(np.float32)
        dz = dout[:, None] * p["c"]
        dh = f["a"][:, None] * dz[f["bag"]]
        da = (f["h"] * dz[f["bag"]]).sum(axis=1)
        dlogit = f["a"] * (da - np.add.reduceat(f["a"] * da, f["start"])[f["bag"]])
        gate = dlogit[:, None] * p["w"]
        dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
        dh = (dh + dt @ p["V"].T + ds @ p["U"].T) * (f["h"] > 0)
        return {"E": f["x"].T @ dh, "e": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds,
                "w": (f["t"] * f["s"]).T @ dlogit, "c": f["z"].T @ dout, "d": dout.sum(keepdims=True)}

    def fit(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray, weight: np.ndarray, passes: int = PASSES,
            batch: int = 128, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> None:
        """Adam on weighted log loss over shuffled batches of documents."""
        self.mean = x.mean(axis=0)
        self.mean[-1] = 0
        rng = np.random.default_rng(seed)
        start = np.concatenate(([0], np.cumsum(counts)))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(u) for k, u in self.p.items()}
        step = 0
        for i in range(passes):
            now = rate * 0.5 * (1 + np.cos(np.pi * i / passes))
            order = rng.permutation(len(counts))
            for lo in range(0, len(order), batch):
                docs = order[lo:lo + batch]
                rows = np.concatenate([np.arange(start[d], start[d + 1]) for d in docs])
                f = self.forward(x[rows], counts[docs])
                step += 1
                for k, g in self.gradients(f, y[docs], weight[docs]).items():
                    g = g + decay * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - now * (m[k] / (1 - 0.9 ** step))
                                 / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)

    def score(self, texts: list[bytes]) -> list[tuple[float, int, float]]:
        """(score, passage of the largest weight, that weight) of each whole text."""
        out = []
        group: list[bytes] = []
        for i, text in enumerate(texts):  # long texts go through in groups of about a MB
            group.append(text)
            if sum(map(len, group)) < 1 << 20 and i + 1 < len(texts):
                continue
            x, counts = passages(group)
            f = self.forward(x, counts)
            for d, lo in enumerate(f["start"]):
                a = f["a"][lo:lo + counts[d]]
                out.append((float(f["p"][d]), int(a.argmax()), float(a.max())))
            group = []
        return out


class Constant:
    """The score where labels of both classes are missing: their share."""

    def __init__(self, share: float) -> None:
        self.share = share

    def score(self, texts: list[bytes]) -> list[tuple[float, int, float]]:
        return [(self.share, 0, 1.0) for _ in texts]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = DOCUMENTS,
        id_col: str = "doc_id", text: str = "text") -> Attention | Constant:
    """Learns from at most ``per_class`` not-held-out documents of each label, weighted so that
    each class counts as in all labelled rows. All passages of them are held by the driver, at
    about three bytes for each byte of text."""
    sample = labelled_sample(docs, labels, label, per_class, id_col, text)
    y = np.array(sample.labels, dtype=np.float32)
    if len(set(sample.labels)) < 2:
        return Constant(float(y.mean()) if len(y) else 0.5)
    bags = [passages([text_.encode()])[0] for text_ in sample.texts]
    x, counts = np.concatenate(bags), np.array([len(b) for b in bags])
    share = np.array(sample.totals) / sum(sample.totals)
    weight = np.where(y == 1, share[1] / y.mean(), share[0] / (1 - y.mean())).astype(np.float32)
    model = Attention()
    model.fit(x, counts, y, weight)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                  least: float = LEAST, model: Attention | Constant | None = None) -> DataFrame:
    """(id, held_out, score, predicted, passage, attention) for every row of ``docs``.

    ``predicted`` is 1 from a score of ``least`` on; ``passage`` is the one of the largest
    attention weight (from 0) and ``attention`` that weight. Null and empty texts are one passage
    without features. Whole texts are read. Null and repeated ids keep their rows; extra columns
    are unused. Without labels of both classes every score is the labels' mean, or 0.5 without any.
    """
    model = model or fit(docs, labels, id_col=id_col, text=text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches):
            rows = sent.value.score(byte_texts(batch, text))
            cols = list(zip(*rows)) if rows else [(), (), ()]
            kinds = (pa.float64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *[pa.array(c, t) for c, t in zip(cols, kinds)]],
                                             names=[id_col, "score", "passage", "attention"])

    kind = column_type(docs, id_col)
    scored = map_arrow(docs.select(id_col, text), run, f"{id_col} {kind}, score double, passage long, attention double")
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score",
                         (F.col("score") >= least).cast("int").alias("predicted"), "passage", "attention")
