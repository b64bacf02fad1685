"""Toxic spans and document scores by a linear-chain conditional random field (CRF).

Words carry hashed features: the word and its first 3, 4, 5, 6 and 8 bytes.  Document labels are
brought down to words first: in a toxic training document the words with a feature that toxic
training documents have much more often than clean ones, and more often than chance explains,
are labelled toxic, all other words clean.
On these labelled tokens a two-state CRF (clean, toxic) is trained by its exact gradient.

For a text, forward and backward recursions give each word's marginal probability of the
toxic state.  Runs of words over one half are the offending spans; the largest marginal and
the expected number of toxic words give the document's score through a logistic curve
fitted on the training documents.

The recursions of two states are fractional-linear maps of the states' odds, and such maps
compose: a slice of texts is cut into equal lanes, the lanes' maps are composed side by side,
a scan over the lanes gives the odds at each lane's begin, and the lanes run again from
there.  A text's first word resets the map, so all texts of a slice are one chain.

The model is fitted on a bounded sample: per label the first ``max_docs`` labelled rows in a
hash order, and of those the whole texts that make up the first ``max_bytes`` bytes.

At scale: labels are sampled before they meet texts (a broadcast of at most ``2 * max_docs``
ids), so no text is shuffled; scoring reads each text once where it lies, one slice at a time.

Defined results: null, empty and wordless texts get the score of no toxic word, and no spans;
if the labels hold no row of one of the two classes, every score is 0; null ids and null
labels are not learned; repeated rows are scored one by one; an empty table gives no rows;
extra columns are carried along by :func:`score_column` whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerprofile.llm import textbytes as tb
from ledgerprofile.llm.columns import bounded_sample, named, text_of
from ledgerprofile.session import ship

MAX_DOCS = 2000
MAX_BYTES = 4_000_000
FEATURE_BITS = 18
PREFIXES = (3, 4, 5, 6, 8)   # bytes
LEAST_RATIO = 8.0            # how much more often toxic documents have a telling feature
LEAST_SURPRISE = 4.0         # standard deviations over its expected number of toxic documents
STEPS = 40
THRESHOLD = 0.7
WORD_SEED = 431
LANE = 256


def tokens(data: np.ndarray, offsets: np.ndarray):
    """(word starts, word ends, first word of each text, hashed features [word, feature])."""
    starts, ends, first = tb.word_spans(data, offsets, tb.ALPHANUMERIC)
    values = tb.byte_values(WORD_SEED)
    columns = [tb.run_hashes(data, starts, ends, values)]
    for k in PREFIXES:
        h = tb.run_hashes(data, starts, np.minimum(ends, starts + k), values)
        columns.append(tb.mix64(h + np.uint64(k)))
    return starts, ends, first, np.stack([(c >> np.uint64(64 - FEATURE_BITS)).astype(np.int32) for c in columns], axis=1)


@dataclass
class Crf:
    """Weights of the chain and of the document score."""

    emission: np.ndarray                 # per feature, for the toxic state against the clean one
    start: float = -3.0                  # log odds of a toxic first word
    bias: float = -3.0
    links: np.ndarray = field(default_factory=lambda: np.array([[1.0, -1.0], [-1.0, 1.0]]))   # [from, to]
    curve: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0, 0.0]))

    def potentials(self, features: np.ndarray) -> np.ndarray:
        """Emission odds of the toxic state."""
        return np.exp(np.clip(self.emission[features].sum(axis=1) + self.bias, -25, 25))


def _lanes(x: np.ndarray, fill) -> np.ndarray:
    """[step, lane]: consecutive stretches of LANE words side by side."""
    n = -(-len(x) // LANE)
    out = np.full(n * LANE, fill, x.dtype)
    out[: len(x)] = x
    return np.ascontiguousarray(out.reshape(n, LANE).T)


def _chain(e: np.ndarray, reset: np.ndarray, at_reset: float, m: np.ndarray) -> np.ndarray:
    """x[t] = e[t] (m01 + m11 x[t-1]) / (m00 + m10 x[t-1]); e[t] at_reset where ``reset``."""
    if not len(e):
        return e
    e_l, r_l = _lanes(e, 1.0), _lanes(reset, True)
    n = e_l.shape[1]
    a, b, c, d = np.zeros(n), np.ones(n), np.ones(n), np.zeros(n)     # the identity
    for k in range(LANE):
        a2, b2 = e_l[k] * (m[0, 1] * c + m[1, 1] * a), e_l[k] * (m[0, 1] * d + m[1, 1] * b)
        c2, d2 = m[0, 0] * c + m[1, 0] * a, m[0, 0] * d + m[1, 0] * b
        new = r_l[k]
        a2[new], b2[new], c2[new], d2[new] = e_l[k][new] * at_reset, 0.0, 1.0, 0.0
        size = a2 + b2 + c2 + d2
        a, b, c, d = a2 / size, b2 / size, c2 / size, d2 / size
    begin, x = np.empty(n), 0.0
    for k in range(n):                                                 # scan over the lanes
        begin[k] = x
        x = (a[k] + b[k] * x) / (c[k] + d[k] * x)
    out, x = np.empty_like(e_l), begin
    for k in range(LANE):
        x = e_l[k] * np.where(r_l[k], at_reset, (m[0, 1] + m[1, 1] * x) / (m[0, 0] + m[1, 0] * x))
        out[k] = x
    return out.T.reshape(-1)[: len(e)]


def forward_backward(model: Crf, odds: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward odds and backward odds of each word; ``begins`` marks the first words of texts."""
    m = np.exp(model.links)
    forward = _chain(odds, begins, np.exp(model.start), m)
    # backward: y[t] = odds[t] q[t] with q[t] = (m10 + m11 y[t+1]) / (m00 + m01 y[t+1]), q = 1 at a text's end
    ends = np.append(begins[1:], True)
    y = _chain(odds[::-1], ends[::-1], 1.0, m.T)[::-1]
    return forward, y / odds


def _fit_chain(features: np.ndarray, begins: np.ndarray, labels: np.ndarray, steps: int) -> Crf:
    """Maximise the mean conditional log-likelihood of the token labels (Adam, full gradient)."""
    model = Crf(np.zeros(1 << FEATURE_BITS))
    size = model.emission.size
    theta = np.concatenate((model.emission, [model.start, model.bias], model.links.ravel()))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    inner = np.flatnonzero(~begins)
    scale = 1.0 / max(1.0, labels.sum())
    for step in range(1, steps + 1):
        model.emission, model.start, model.bias = theta[:size], theta[size], theta[size + 1]
        model.links = theta[size + 2:].reshape(2, 2)
        odds = model.potentials(features)
        f, q = forward_backward(model, odds, begins)
        p = f * q / (1 + f * q)
        gap = labels - p
        gradient = np.zeros_like(theta)
        for k in range(features.shape[1]):
            gradient[:size] += np.bincount(features[:, k], gap, size)
        gradient[size], gradient[size + 1] = gap[begins].sum(), gap.sum()
        m, before, here = np.exp(model.links), f[inner - 1], odds[inner] * q[inner]
        joint = np.stack([np.full(len(inner), m[0, 0]), m[0, 1] * here, m[1, 0] * before, m[1, 1] * before * here])
        joint /= joint.sum(axis=0)
        pair = (2 * labels[inner - 1] + labels[inner]).astype(np.int64)
        gradient[size + 2:] = np.bincount(pair, minlength=4) - joint.sum(axis=1)
        gradient = gradient * scale - 1e-4 * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient ** 2
        theta = theta + 0.3 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    model.emission, model.start, model.bias = theta[:size], float(theta[size]), float(theta[size + 1])
    model.links = theta[size + 2:].reshape(2, 2)
    return model


def marginals(model: Crf, features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probability of the toxic state of each word."""
    begins = np.zeros(len(features), bool)
    begins[first[:-1][first[:-1] < first[1:]]] = True
    f, q = forward_backward(model, model.potentials(features), begins)
    return f * q / (1 + f * q)


def _evidence(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """[text, 3]: 1, log odds of the largest marginal, log of the expected toxic words."""
    out = np.zeros((len(first) - 1, 2)) + 1e-6
    some = np.flatnonzero(first[:-1] < first[1:])
    if len(some):
        out[some, 0] = np.clip(np.maximum.reduceat(p, first[some]), 1e-6, 1 - 1e-6)
        out[some, 1] = np.maximum(np.add.reduceat(p, first[some]), 1e-6)
    return np.stack([np.ones(len(out)), np.log(out[:, 0] / (1 - out[:, 0])), np.log(out[:, 1])], axis=1)


def _fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps; slopes are not negative."""
    w = np.zeros(3)
    for _ in range(30):
        s = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (s * (1 - s))[:, None]).T @ x + np.diag([1e-3, 1.0, 1.0])
        w = w + np.linalg.solve(h, x.T @ (y - s) - np.array([1e-3, 1.0, 1.0]) * w)
    return np.array([w[0], max(w[1], 0.0), max(w[2], 0.0)])


def token_labels(features: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Word labels from document labels, by the features that tell toxic documents."""
    size = 1 << FEATURE_BITS
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n_toxic, n_clean = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for k in range(features.shape[1]):                                # documents per feature
        seen = np.unique(text * size + features[:, k])
        n_toxic += np.bincount(seen[toxic[seen // size] == 1] % size, minlength=size)
        n_clean += np.bincount(seen[toxic[seen // size] == 0] % size, minlength=size)
    share = toxic.sum() / len(toxic)
    expected = share * (n_toxic + n_clean)
    telling = (n_toxic * (1 - share) >= LEAST_RATIO * n_clean * share) & (
        n_toxic - expected >= LEAST_SURPRISE * np.sqrt(expected + 1))
    return (telling[features].any(axis=1) & (toxic[text] == 1)).astype(np.float64)


def fit(texts: list[str], toxic: np.ndarray, steps: int = STEPS) -> Crf | None:
    """The chain and the score curve from labelled texts; None if a class is missing."""
    if not (toxic == 1).any() or not (toxic == 0).any():
        return None
    data, offsets = tb.flat(pa.array(texts, pa.large_string()))
    parts, first = [], [0]
    for lo, hi in tb.slices(offsets):
        _, _, own, features = tokens(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
        parts.append(features)
        first.extend(first[-1] + own[1:])
    first, features = np.array(first), np.concatenate(parts)
    labels = token_labels(features, first, toxic)
    begins = np.zeros(len(features), bool)
    begins[first[:-1][first[:-1] < first[1:]]] = True
    model = _fit_chain(features, begins, labels, steps)
    model.curve = _fit_curve(_evidence(marginals(model, features, first), first), toxic.astype(float))
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(text, toxic): the bounded sample of labelled texts; of rows that repeat an id the least text."""
    rows = (labels.select(named(id_col).alias("doc_id"), named(label_col).cast("int").alias("toxic"))
            .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).distinct()
            .withColumn("shuffled", F.xxhash64(F.lit(3), "doc_id")))
    chosen = bounded_sample(rows, "toxic", ["shuffled", "doc_id"], max_docs)
    texts = docs.select(named(id_col).alias("doc_id"), text_of(docs, text_col).alias("text"))
    joined = (texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic", "shuffled")
              .agg(F.min("text").alias("text")))
    before = Window.partitionBy("toxic").orderBy("shuffled", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    return (joined.withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)))
            .where(F.col("before") < max_bytes).select("text", "toxic"))


def train(docs: DataFrame, labels: DataFrame, **options) -> Crf | None:
    """Fit on the bounded sample of ``labels`` (already restricted to rows that may be learned).

    One task fits the model, so neither the sample nor the work arrays of the fit take the driver's
    memory; the driver gets the weights.
    """
    ship(docs.sparkSession)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], [np.zeros(0, np.int32)]
        for batch in batches:
            texts += batch.column(0).to_pylist()
            toxic.append(batch.column(1).to_numpy())
        model = fit(texts, np.concatenate(toxic))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    sample = labelled_sample(docs, labels, **options).repartition(1)
    row = sample.mapInArrow(fitted, "model binary").first()
    return pickle.loads(row["model"]) if row else None


class Tagger:
    """Scores and spans of texts under a fitted model."""

    def __init__(self, model: Crf):
        self.model = model

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[dict]]]:
        starts, ends, first, features = tokens(data, offsets)
        p = marginals(self.model, features, first)
        x = _evidence(p, first) @ self.model.curve
        spans: list[list[dict]] = [[] for _ in range(len(first) - 1)]
        hot = np.flatnonzero(p >= 0.5)
        if len(hot):
            chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            text = np.searchsorted(first, hot, "right") - 1
            for w, t in zip(hot.tolist(), text.tolist()):
                lo = int(chars[starts[w]] - chars[offsets[t]])
                hi = int(chars[ends[w]] - chars[offsets[t]])
                if spans[t] and spans[t][-1]["last"] == w - 1:
                    spans[t][-1].update(end=hi, last=w, probability=max(spans[t][-1]["probability"], float(p[w])))
                else:
                    spans[t].append({"start": lo, "end": hi, "last": w, "probability": float(p[w])})
        return 1 / (1 + np.exp(-np.clip(x, -30, 30))), spans


SPANS = "array<struct<start: int, end: int, probability: double>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))


def score_column(docs: DataFrame, model: Crf | None, text_col: str = "text") -> Column:
    """struct(score, spans) of each text; spans are code point offsets."""
    spark = docs.sparkSession
    ship(spark)
    if model is None:
        return F.struct(F.lit(0.0).alias("score"), F.array().cast(SPANS).alias("spans"))
    shared = spark.sparkContext.broadcast(model)

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = Tagger(shared.value)
        for texts in columns:
            data, offsets = tb.flat(texts)
            scores, spans = [np.zeros(0)], []
            for lo, hi in tb.slices(offsets):
                s, own = tagger(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
                scores.append(s)
                spans += own
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate(scores), pa.float64()), pa.array(spans, _SPANS)], ["score", "spans"])

    return F.arrow_udf(score, f"struct<score: double, spans: {SPANS}>")(text_of(docs, text_col))
