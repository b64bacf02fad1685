"""Quality scores from weak labels.

Heuristic labellers look at every text and vote good (1), bad (0) or abstain.  They overlap
and err; a generative model with one hidden class and, per labeller and class, the
probability that a vote cast is good is fitted by expectation-maximisation (EM).  It needs only
how many documents show each vote pattern, and gives each labeller's accuracy and each
pattern's posterior probability of good.  The posteriors then train a linear scorer over
hashed byte trigrams and word-repetition features, which generalises beyond the heuristics.

At scale: the vote patterns are counted over all documents, pre-aggregated in the tasks; at
most ``3**labellers`` patterns reach the driver.  The scorer is fitted on a bounded sample:
of the documents with a posterior of one half or more and of the others the first
``max_docs`` in a hash order, and of those the whole texts that make up the first
``max_bytes`` bytes.  Texts are read where they lie and never shuffled but for the sample.

Defined results: null, empty and wordless texts are labelled like any text (the length labeller
votes bad, the others abstain); an empty table gives no rows; if all documents fall on one side of the
posterior, the score is the posterior; repeated rows count each; null ids are kept.  Only
the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerprofile.llm import textbytes as tb
from ledgerprofile.llm.columns import bounded_sample, hash_octave, named, text_of
from ledgerprofile.session import ship

GOOD, BAD, ABSTAIN = 1, 0, 2
MAX_DOCS = 2000
MAX_BYTES = 3_000_000
FEATURE_BITS = 16
STEPS = 60
KEEP = 0.5
EM_ROUNDS = 500
FALSE_ALARMS = 0.002
WORD_SEED = 977
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-()?"]] = True
_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in ".,;:?"]] = True

#: Labellers: statistic, votes bad beyond / good within (bad_below, good_from, good_to, bad_above).
#: None: no such bound.  Between good and bad a labeller abstains.
LABELLERS = {
    "length": ("words", 2, 40, None, None),
    "symbols": ("symbols_per_word", None, 0.0, 0.25, 0.8),
    "capitals": ("capital_share", None, 0.0, 0.15, 0.5),
    "distinct": ("distinct_share", 0.15, 0.3, None, None),
    "stutter": ("stutter_share", None, 0.0, 0.05, 0.3),
    "word_length": ("mean_word_bytes", 2.0, 3.0, 12.0, 20.0),
    "sentences": ("mark_share", 0.01, 0.04, 0.6, 0.9),
    "bare_symbols": ("bare_symbol_share", None, 0.0, 0.01, 0.1),
    "lines": ("repeated_line_share", None, 0.0, 0.2, 0.5),
}


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[k]:first[k + 1]]``."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
    return total[first[1:]] - total[first[:-1]]


def _distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of distinct hashes of each text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return np.bincount(t[new], minlength=len(first) - 1)


_NOT_NEWLINE = np.ones(256, bool)
_NOT_NEWLINE[10] = False


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The labellers' statistics of each text."""
    starts, ends, first = tb.word_spans(data, offsets, tb.SPACE_SEPARATED)
    words = tb.run_hashes(data, starts, ends, tb.byte_values(WORD_SEED))
    n = np.diff(first)
    some = np.maximum(n, 1)
    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    upper = ((data >= 65) & (data <= 90)) | latin
    letters = ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122)) | (data >= 0xC3)   # a lead byte each
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    same[first[:-1][n > 0]] = False
    l_starts, l_ends, l_first = tb.word_spans(data, offsets, _NOT_NEWLINE)
    lines = tb.run_hashes(data, l_starts, l_ends, tb.byte_values(WORD_SEED))
    n_lines = np.diff(l_first)
    return {
        "words": n.astype(float),
        "symbols_per_word": _sums(_SYMBOLS[data], offsets) / some,
        "capital_share": _sums(upper, offsets) / np.maximum(_sums(letters, offsets), 1),
        "distinct_share": np.where(n < 30, 1.0, _distinct(words, first) / some ** 0.9),
        "stutter_share": _sums(same, first) / some,
        "mean_word_bytes": _sums(ends - starts, first) / some,
        "mark_share": _sums(_MARKS[data[ends - 1]] if len(ends) else np.zeros(0), first) / some,
        "bare_symbol_share": _sums(_SYMBOLS[data[starts]] & (ends - starts == 1), first) / some,
        "repeated_line_share": 1 - _distinct(lines, l_first) / np.maximum(n_lines, 1) * (n_lines > 0) - (n_lines == 0),
    }


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """[text, labeller]: GOOD, BAD or ABSTAIN."""
    out = []
    for statistic, bad_below, good_from, good_to, bad_above in LABELLERS.values():
        x = stats[statistic]
        good = (x >= good_from) & (x <= (np.inf if good_to is None else good_to))
        bad = (x < (-np.inf if bad_below is None else bad_below)) | (x > (np.inf if bad_above is None else bad_above))
        # statistics of very short texts say little: only the length labeller speaks
        speaks = np.ones(len(x), bool) if statistic == "words" else stats["words"] >= 5
        out.append(np.where(speaks & bad, BAD, np.where(speaks & good, GOOD, ABSTAIN)))
    return np.stack(out, axis=1).astype(np.int8)


@dataclass
class LabelModel:
    """Prior of good and, [labeller, class], the probability that a vote cast is GOOD."""

    prior: float
    table: np.ndarray

    @property
    def accuracies(self) -> dict[str, float]:
        """Probability that a vote cast is right."""
        right = (1 - self.prior) * (1 - self.table[:, BAD]) + self.prior * self.table[:, GOOD]
        return dict(zip(LABELLERS, right.tolist()))

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good for each vote pattern; an abstention says nothing."""
        good, bad = (patterns == GOOD).astype(float), (patterns == BAD).astype(float)
        odds = np.log(self.prior / (1 - self.prior))
        odds = odds + good @ np.log(self.table[:, GOOD] / self.table[:, BAD])
        odds = odds + bad @ np.log((1 - self.table[:, GOOD]) / (1 - self.table[:, BAD]))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> LabelModel:
    """EM with pseudo-counts until the posterior settles; at first a text with a bad vote is bad.

    The labellers look for different defects, so a bad text gets few bad votes, and without a
    bound the classes would separate the commonest defect from all others.  The bound is that a
    labeller calls at most ``FALSE_ALARMS`` of the good texts bad; how many bad texts it finds,
    and how many there are, is estimated.
    """
    good, bad = (patterns == GOOD).astype(float), (patterns == BAD).astype(float)
    q = np.where(bad.any(axis=1), 0.1, 0.9)
    model = LabelModel(0.5, np.full((patterns.shape[1], 2), 0.5))
    for _ in range(rounds):
        model.prior = float(np.clip((counts @ q + 1) / (counts.sum() + 2), 0.01, 0.99))
        for y, w in ((BAD, counts * (1 - q)), (GOOD, counts * q)):
            model.table[:, y] = (w @ good + 1) / (w @ (good + bad) + 2)
        model.table[:, GOOD] = np.maximum(model.table[:, GOOD], 1 - FALSE_ALARMS)
        new = model.posterior(patterns)
        if np.abs(new - q).max() < 1e-9:
            break
        q = new
    return model


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed features one after another, first of each text): byte trigrams, then words by how
    their neighbours repeat them."""
    keys = np.zeros(len(data), np.uint64)
    inside = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for back in range(3):
        held = inside >= back
        keys[held] |= data[np.flatnonzero(held) - back].astype(np.uint64) << np.uint64(8 * back)
    hashed = (tb.mix64(keys + np.uint64(1)) >> np.uint64(64 - FEATURE_BITS)).astype(np.int32)
    return hashed, offsets


@dataclass
class Scorer:
    """Linear scorer over hashed trigram frequencies and the labellers' statistics."""

    weights: np.ndarray
    dense: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def score(self, data: np.ndarray, offsets: np.ndarray, stats: dict[str, np.ndarray]) -> np.ndarray:
        hashed, first = features(data, offsets)
        x = _sums(self.weights[hashed], first) / np.sqrt(np.maximum(np.diff(first), 1))
        return 1 / (1 + np.exp(-np.clip(x + _dense(stats, self.mean, self.spread) @ self.dense, -30, 30)))


def _raw(stats: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([np.log1p(np.minimum(stats[s], 1e6)) for s in dict.fromkeys(v[0] for v in LABELLERS.values())], axis=1)


def _dense(stats: dict[str, np.ndarray], mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    x = np.clip((_raw(stats) - mean) / spread, -5, 5)
    return np.concatenate([np.ones((len(x), 1)), x], axis=1)


def fit_scorer(texts: list[str], posterior: np.ndarray, steps: int = STEPS) -> Scorer:
    """Logistic regression on the posterior labels (Adam, full gradient)."""
    data, offsets = tb.flat(pa.array(texts, pa.large_string()))
    stats = statistics(data, offsets)
    hashed, first = features(data, offsets)
    raw = _raw(stats)
    mean, spread = raw.mean(axis=0), raw.std(axis=0) + 1e-6
    dense = _dense(stats, mean, spread)
    root = np.sqrt(np.maximum(np.diff(first), 1))
    size = 1 << FEATURE_BITS
    theta = np.zeros(size + dense.shape[1])
    one, two = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        x = _sums(theta[hashed], first) / root + dense @ theta[size:]
        gap = posterior - 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        g = np.concatenate([np.bincount(hashed, np.repeat(gap / root, np.diff(first)), size), gap @ dense])
        g = g / len(texts) - 1e-3 * theta
        one, two = 0.9 * one + 0.1 * g, 0.99 * two + 0.01 * g * g
        theta = theta + 0.05 * (one / (1 - 0.9 ** step)) / (np.sqrt(two / (1 - 0.99 ** step)) + 1e-8)
    return Scorer(theta[:size], theta[size:], mean, spread)


def _vote_keys(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Text -> its vote pattern as a string of digits."""
    for texts in columns:
        data, offsets = tb.flat(texts)
        out = []
        for lo, hi in tb.slices(offsets):
            table = votes(statistics(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]))
            out += ["".join(map(str, row)) for row in table.tolist()]
        yield pa.array(out, pa.string())


def quality_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES) -> tuple[DataFrame, LabelModel | None]:
    """(doc_id, votes, posterior, score) of each row of ``docs``, and the label model."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(named(id_col).alias("doc_id"), text_of(docs, text_col).alias("text"))
    rows = rows.withColumn("shuffled", F.xxhash64(F.lit(7), "doc_id", "text"))
    voted = rows.withColumn("votes", F.arrow_udf(_vote_keys, "string")("text"))
    by_octave = voted.groupBy("votes", hash_octave("shuffled").alias("octave")).agg(F.count(F.lit(1)).alias("n")).collect()
    total: dict[str, int] = {}
    for r in by_octave:
        total[r["votes"]] = total.get(r["votes"], 0) + r["n"]
    counted = [{"votes": v, "n": total[v]} for v in sorted(total)]
    if not counted:
        return rows.select("doc_id", F.lit("").alias("votes"), F.lit(0.0).alias("posterior"), F.lit(0.0).alias("score")), None
    patterns = np.array([[int(c) for c in r["votes"]] for r in counted], np.int8)
    labels = fit_labels(patterns, np.array([r["n"] for r in counted], float))
    posterior = dict(zip((r["votes"] for r in counted), labels.posterior(patterns).tolist()))
    known = spark.createDataFrame(list(posterior.items()), "votes string, posterior double")   # 3**labellers rows at most
    sample = voted.join(F.broadcast(known), "votes").withColumn("side", F.col("posterior") >= 0.5)
    n_sides: dict[tuple[bool, int], int] = {}
    for r in by_octave:
        key = posterior[r["votes"]] >= 0.5, r["octave"]
        n_sides[key] = n_sides.get(key, 0) + r["n"]
    sample = bounded_sample(sample, "side", ["shuffled"], max_docs, n_sides)
    before = Window.partitionBy("side").orderBy("shuffled").rowsBetween(Window.unboundedPreceding, -1)
    sample = (sample.withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)))
              .where(F.col("before") < max_bytes).select("text", "posterior", "side").toArrow())
    sides = set(sample.column("side").to_pylist())
    scorer = fit_scorer(sample.column("text").to_pylist(), sample.column("posterior").to_numpy()) if len(sides) == 2 else None
    shared = spark.sparkContext.broadcast((scorer, posterior))

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, by_votes = shared.value
        for texts in columns:
            data, offsets = tb.flat(texts)
            keys, scores = [], [np.zeros(0)]
            for lo, hi in tb.slices(offsets):
                part, off = data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
                stats = statistics(part, off)
                own = ["".join(map(str, row)) for row in votes(stats).tolist()]
                keys += own
                scores.append(model.score(part, off, stats) if model else np.array([by_votes[k] for k in own]))
            yield pa.StructArray.from_arrays(
                [pa.array(keys, pa.string()), pa.array([by_votes[k] for k in keys], pa.float64()),
                 pa.array(np.concatenate(scores), pa.float64())], ["votes", "posterior", "score"])

    udf = F.arrow_udf(score, "struct<votes: string, posterior: double, score: double>")
    return rows.withColumn("q", udf("text")).select("doc_id", "q.votes", "q.posterior", "q.score"), labels
