"""Quality classifier by attention over passages (multiple-instance learning).

Every passage of a text is encoded by a fixed encoder: frequencies of pairs of character classes
and the share of distinct four-byte strings. A gated attention layer weighs the passages of a
document, and a logistic layer scores their weighted mean. Only document labels are learned from.

The model is fitted on a bounded sample, about ``MAX_TRAIN`` labelled documents of at most
``MAX_TRAIN_BYTES`` bytes (chosen by a hash of the id); every passage of every document is scored.

Defined cases: a null text, or one without a word, scores 0; without labels of both kinds the score
is their mean (0.5 without any); a document labelled more than once counts with its mean label;
repeated rows and null ids are scored row by row; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.carry import packed, unpacked

PASSAGE = 512
HIDDEN = 24
MAX_TRAIN = 3000
MAX_TRAIN_BYTES = 1 << 15
THRESHOLD = 0.7
_BATCH = 1 << 21

#: Character classes of bytes.
_CLASSES = np.full(256, 12, np.int64)
for _k, _members in enumerate((b"aeiou", b"bcdfghjklmnpqrstvwxyz", b"AEIOU",
                               b"BCDFGHJKLMNPQRSTVWXYZ", b"0123456789", b" ", b"\n", b".,;:?'",
                               b"!", b"#*$%&", b"|<>", b"\"()[]{}@/\\_=+-~`^")):
    _CLASSES[list(_members)] = _k
_CLASSES[0x80:0xC0] = 13
_CLASSES[0xC0:] = 14
_N = 16
WIDTH = _N * _N + 1


def passage_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of all texts, one row each, and the number of each text's passages.

    Passages are near-equal runs of about ``PASSAGE`` bytes; an empty text has one empty passage.
    """
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    counts = np.maximum(1, np.rint(sizes / PASSAGE).astype(np.int64))
    data = np.frombuffer(b"".join(raw), np.uint8)
    total = int(counts.sum())
    if not len(data):
        return np.zeros((total, WIDTH), np.float32), counts
    doc = np.repeat(np.arange(len(raw)), counts)
    nth = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = (np.cumsum(sizes) - sizes)[doc] + nth * sizes[doc] // counts[doc]
    length = np.diff(begin, append=len(data))
    passage = np.repeat(np.arange(total), length)
    classes = _CLASSES[data]
    pair = passage * (_N * _N) + classes * _N
    pair[:-1] += np.where(passage[1:] == passage[:-1], classes[1:], _N - 1)
    pair[-1] += _N - 1
    out = np.empty((total, WIDTH), np.float32)
    out[:, :-1] = np.bincount(pair, minlength=total * _N * _N).reshape(total, -1)
    if len(data) >= 4:
        four = np.zeros(len(data) - 3, np.uint64)
        for k in range(4):
            four = four * np.uint64(256) + data[k:len(data) - 3 + k]
        keys = np.sort((passage[:-3].astype(np.uint64) << np.uint64(32)) | four)
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        out[:, -1] = np.bincount((keys[new] >> np.uint64(32)).astype(np.int64), minlength=total)
    else:
        out[:, -1] = 1
    share = np.maximum(length, 1)[:, None].astype(np.float32)
    return np.sqrt(out / share), counts


class AttentionModel:
    """Gated attention over passages: h = tanh(Vx) * sigmoid(Ux), a = softmax(wh), y = s(c.sum(ax))
    """

    def __init__(self, mean: np.ndarray, scale: np.ndarray, params: dict[str, np.ndarray],
                 constant: float | None = None):
        self.mean, self.scale, self.params, self.constant = mean, scale, params, constant

    def forward(self, x: np.ndarray, counts: np.ndarray) -> tuple:
        p = self.params
        first = np.cumsum(counts) - counts
        doc = np.repeat(np.arange(len(counts)), counts)
        t = np.tanh(x @ p["V"])
        s = 1 / (1 + np.exp(-(x @ p["U"])))
        logit = (t * s) @ p["w"]
        logit = np.exp(logit - np.maximum.reduceat(logit, first)[doc])
        a = logit / np.add.reduceat(logit, first)[doc]
        z = np.add.reduceat(x * a[:, None], first, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"][0], -30, 30)))
        return doc, first, t, s, a, z, y

    def scores(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(counts), self.constant)
        return self.forward((features - self.mean) / self.scale, counts)[-1].astype(np.float64)


def fit(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = 1200,
        rate: float = 0.003, batch: int = 64, seed: int = 7) -> AttentionModel:
    """Fit by Adam on the cross entropy of the documents' labels; the same input, the same model."""
    mean, scale = np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32)
    if not len(labels) or labels.min() == labels.max():
        value = float(labels.mean()) if len(labels) else 0.5
        return AttentionModel(mean, scale, {}, value)
    mean, scale = features.mean(0), features.std(0) + np.float32(0.02)
    x_all = (features - mean) / scale
    first = np.cumsum(counts) - counts
    random = np.random.default_rng(seed)
    params = {"V": random.normal(0, 0.05, (WIDTH, HIDDEN)), "U": random.normal(0, 0.05, (
        WIDTH, HIDDEN)), "w": random.normal(0, 0.1, HIDDEN), "c": np.zeros(WIDTH),
        "b": np.zeros(1)}
    params = {k: v.astype(np.float32) for k, v in params.items()}
    model = AttentionModel(mean, scale, params)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    step = 0
    for _ in range(-(-steps // -(-len(labels) // batch))):
        order = random.permutation(len(labels))
        for at in range(0, len(order), batch):
            docs = order[at:at + batch]
            rows = np.concatenate([np.arange(first[d], first[d] + counts[d]) for d in docs])
            x, n = x_all[rows], counts[docs]
            doc, _, t, s, a, z, y = model.forward(x, n)
            dy = (y - labels[docs]).astype(np.float32) / len(docs)
            grad = {"c": z.T @ dy + 1e-4 * params["c"], "b": np.array([dy.sum()])}
            da = (x * params["c"]).sum(1) * dy[doc]
            starts = np.cumsum(n) - n
            dlogit = a * (da - np.add.reduceat(a * da, starts)[doc])
            grad["w"] = (t * s).T @ dlogit
            dh = dlogit[:, None] * params["w"]
            grad["V"] = x.T @ (dh * s * (1 - t * t))
            grad["U"] = x.T @ (dh * t * s * (1 - s))
            step += 1
            for k, g in grad.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                params[k] -= (rate * (m / (1 - 0.9 ** step))
                              / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


def fold(doc_id: str = "doc_id", folds: int = 4) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def train(docs: DataFrame, labels: DataFrame, held_out: Column, max_docs: int = MAX_TRAIN,
          label: str = "quality") -> AttentionModel:
    """Fit on about ``max_docs`` labelled documents that are not held out."""
    known = (labels.filter(F.col(label).isNotNull() & ~held_out).groupBy("doc_id")
             .agg(F.avg(label).alias("_y")))
    count = known.count()
    if not count:
        return fit(np.zeros((0, WIDTH), np.float32), np.zeros(0, np.int64), np.zeros(0))
    part = min(1.0, max_docs / count)
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 20))
                          < int(part * (1 << 20)) + (part == 1.0))
    rows = (docs.select("doc_id", "text")
            .filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= MAX_TRAIN_BYTES)
            .join(F.broadcast(chosen), "doc_id"))  # at most a little over max_docs rows

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, y, text in zip(batch["doc_id"].to_pylist(), batch["_y"].to_pylist(),
                                       batch["text"].to_pylist()):
                features, _ = passage_features([text])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id]), pa.array([y]), pa.array([features.tobytes()])],
                    ["doc_id", "_y", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sample = sorted(rows.mapInArrow(encode, f"doc_id {kind}, _y double, x binary").collect(),
                    key=lambda r: (r[0], bytes(r[2])))
    bags = [np.frombuffer(r[2], np.float32).reshape(-1, WIDTH) for r in sample]
    if not bags:
        return fit(np.zeros((0, WIDTH), np.float32), np.zeros(0, np.int64), np.zeros(0))
    return fit(np.concatenate(bags), np.array([len(b) for b in bags]),
               np.array([r[1] for r in sample]))


def score_column(model: AttentionModel):
    """A function of a text column that gives its score."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out: list[np.ndarray] = []
        held: list[str | None] = []
        size = 0

        def flush() -> None:
            nonlocal held, size
            if held:
                y = model.scores(*passage_features(held))
                y[[not (t or "").strip(" \t\n\v\f\r") for t in held]] = 0.0
                out.append(np.clip(y, 0.0, 1.0))
            held, size = [], 0

        for text in texts:
            held.append(text.as_py())
            size += len(held[-1] or "")
            if size > _BATCH:
                flush()
        flush()
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                   max_docs: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, held_out, score, predicted``; fold 2 of 4 is held out of the training."""
    held = F.coalesce(fold() == 2, F.lit(False))
    model = train(docs, labels, held, max_docs)
    return (docs.select("doc_id", held.alias("held_out"),
                        score_column(model)(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def accepted_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                       max_docs: int = MAX_TRAIN) -> DataFrame:
    """The documents that score at least ``threshold``; columns as in ``docs``."""
    model = train(docs, labels, F.coalesce(fold() == 2, F.lit(False)), max_docs)
    scored = packed(docs).withColumn("_score", score_column(model)(F.col("text")))
    return unpacked(scored.filter(F.col("_score") >= threshold), docs.columns)
