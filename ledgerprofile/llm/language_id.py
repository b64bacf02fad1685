"""Language identification by prediction by partial matching (PPM).

For each language a variable-order context tree over bytes counts which byte followed which
context of up to ``order`` bytes in the training texts.  A byte's code length is that of the
longest context that has seen it: ``-log2 n / (N + T)`` where the context saw ``N`` bytes,
``T`` distinct ones and this one ``n`` times (escape method C, without exclusions); each
longer context that the tree holds but that has not seen the byte adds its escape,
``-log2 T / (N + T)``; a byte no context has seen costs 8 bits after the last escape.  The
statistics are frozen, so a text's code length under a language is the exact sum over all its
bytes, and the shortest code wins (ties: the first language in byte order).  A-Z and the
Latin-1 capitals are folded to lower case, in training and in scoring.

For scoring the trees of up to ``GROUP`` languages are one table per order: a row for each
(context, byte) that any of them has seen, with the code length under each of them, escapes
included.  A byte costs one look-up a group where the longest context knows it, and the tables
grow with the number of languages, not with its square.

The model is fitted on a bounded sample: of each language the first ``max_docs`` training
texts in a hash order, and of those the whole texts that make up the first ``max_bytes``
bytes (one text at least).

At scale: only rows in the lowest part of the hash order are ranked for the sample, counts are
summed in the tasks and per (language, context), and the bounded table of counts is fetched and
broadcast.  Scoring reads each text once where it lies, without a shuffle.

Defined results: texts that are null or have no letter get ``und`` and score 0, and so does
every text if nothing could be learned; null languages are not learned; null ids count as
fold 0; repeated rows are scored one by one; an empty table gives no rows.  Only the named
columns are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerprofile.llm import textbytes as tb
from ledgerprofile.llm.columns import bounded_sample, named, text_of
from ledgerprofile.session import ship

ORDER = 4
MAX_DOCS = 400
MAX_BYTES = 400_000
GROUP = 8
UNDETERMINED = "und"


def folded(data: np.ndarray) -> np.ndarray:
    """A-Z and the capitals U+00C0..U+00DE lower-cased, byte by byte."""
    out = data.copy()
    upper = (data >= 65) & (data <= 90)
    if len(data) > 1:
        upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[upper] += 32
    return out


def byte_keys(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """Key of each byte with its ``order`` predecessors; a text begins after zero bytes."""
    sizes = np.diff(offsets)
    padded = np.zeros(len(data) + order * len(sizes), np.uint64)
    at = np.arange(len(data)) + order * np.repeat(np.arange(1, len(sizes) + 1), sizes)
    padded[at] = folded(data)
    keys = padded[at]
    for k in range(1, order + 1):
        keys |= padded[at - k] << np.uint64(8 * k)
    return keys


def _counted(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, key, n), summed per batch."""
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        data, offsets = tb.flat(batch.column("text"))
        keys = byte_keys(data, offsets, order)
        owner = np.repeat(np.arange(len(langs)), np.diff(offsets))
        for lang in sorted(set(langs)):
            own, n = np.unique(keys[(langs == lang)[owner]], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own), pa.string()), pa.array(own.view(np.int64), pa.int64()),
                 pa.array(n, pa.int64())], names=["lang", "key", "n"])


@dataclass
class Tables:
    """Frozen statistics of a group: per order (longest first) the keys and code lengths per language."""

    langs: list[str]
    keys: list[np.ndarray]        # of (context, byte)
    bits: list[np.ndarray]        # [key, language]: code length, escapes included
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]     # [context, language]: escape bits; 0 where the tree lacks the context


@dataclass
class Model:
    """The languages, in byte order, and their tables by group."""

    langs: list[str]
    order: int
    groups: list[Tables]


def fit(langs: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int, group: int = GROUP) -> Model:
    """The model of each language's (keys, counts) of the longest contexts."""
    return Model(langs, order, [_tables(langs[lo: lo + group], counts, order) for lo in range(0, len(langs), group)])


def _tables(langs: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int) -> Tables:
    model = Tables(langs, [], [], [], [])
    lower_keys, lower_bits = np.arange(256, dtype=np.uint64), np.full((256, len(langs)), 8.0)
    for k in range(order + 1):                         # shortest contexts first
        mask = np.uint64((1 << (8 * (k + 1))) - 1)
        seen = {}
        for lang in langs:
            keys, inverse = np.unique(counts[lang][0] & mask, return_inverse=True)
            seen[lang] = keys, np.bincount(inverse, counts[lang][1], len(keys))
        # what a longer context has seen, the shorter ones have seen too; order 0 holds every byte
        keys = np.unique(np.concatenate([seen[lang][0] for lang in langs])) if k else lower_keys
        contexts = np.unique(keys >> np.uint64(8))
        here = np.searchsorted(contexts, keys >> np.uint64(8))
        bits = lower_bits[np.searchsorted(lower_keys, keys & (mask >> np.uint64(8)) if k else keys)]
        escapes = np.zeros((len(contexts), len(langs)))
        for j, lang in enumerate(langs):
            own, n = seen[lang]
            where = np.searchsorted(contexts, own >> np.uint64(8))
            total = np.bincount(where, n, len(contexts))
            distinct = np.bincount(where, minlength=len(contexts))
            known = distinct > 0
            escapes[known, j] = np.log2((total + distinct)[known] / distinct[known])
            bits[:, j] += escapes[here, j]
            bits[np.searchsorted(keys, own), j] = np.log2((total + distinct)[where] / n)
        for tables, table in ((model.keys, keys), (model.bits, bits), (model.contexts, contexts), (model.escapes, escapes)):
            tables.insert(0, table)
        lower_keys, lower_bits = keys, bits
    return model


class Scorer:
    """Code lengths of texts under each language of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.symbols = [[tb.HashIndex(k) for k in g.keys] for g in model.groups]
        self.contexts = [[tb.HashIndex(c) for c in g.contexts] for g in model.groups]
        self.step = max(1 << 12, (1 << 21) // max([1, *(len(g.langs) for g in model.groups)]))   # bytes at a time

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """[text, language]: bits of each whole text."""
        out = np.zeros((len(offsets) - 1, len(self.model.langs)))
        keys = byte_keys(data, offsets, self.model.order)
        for lo in range(0, len(keys), self.step):
            part = keys[lo: lo + self.step]
            first = int(np.searchsorted(offsets, lo, "right")) - 1
            last = int(np.searchsorted(offsets, lo + len(part), "left"))
            texts = np.arange(first, last)
            texts = texts[np.diff(offsets)[texts] > 0]
            begins, column = np.maximum(offsets[texts] - lo, 0), 0
            for g, tables in enumerate(self.model.groups):
                columns = slice(column, column + len(tables.langs))
                out[texts, columns] += np.add.reduceat(self._bits(g, part), begins, axis=0)
                column = columns.stop
        return out

    def _bits(self, g: int, part: np.ndarray) -> np.ndarray:
        """[byte, language of group g]: code length of each byte, given as its longest key."""
        tables, order = self.model.groups[g], self.model.order
        bits = np.zeros((len(part), len(tables.langs)))
        left = np.arange(len(part))
        for k in range(order + 1):
            own = part[left] & np.uint64((1 << (8 * (order - k + 1))) - 1)
            rows = self.symbols[g][k].find(own)
            known = rows >= 0
            bits[left[known]] += tables.bits[k][rows[known]]
            left, own = left[~known], own[~known]
            if not len(left):
                break
            context = self.contexts[g][k].find(own >> np.uint64(8))
            held = context >= 0
            bits[left[held]] += tables.escapes[k][context[held]]
        return bits


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          order: int = ORDER, max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES) -> Model:
    """Fit on a bounded sample of the rows of ``docs`` with a language."""
    ship(docs.sparkSession)
    rows = docs.select(named(id_col).alias("id"), named(lang_col).cast("string").alias("lang"),
                       text_of(docs, text_col).alias("text"))
    rows = rows.where(F.col("lang").isNotNull()).withColumn("shuffled", F.xxhash64(F.lit(5), "id", "text"))
    sample = bounded_sample(rows, "lang", ["shuffled"], max_docs)
    before = Window.partitionBy("lang").orderBy("shuffled").rowsBetween(Window.unboundedPreceding, -1)
    sample = (sample.withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)))
              .where(F.col("before") < max_bytes).select("lang", "text"))
    table = (sample.mapInArrow(lambda batches: _counted(batches, order), "lang string, key long, n long")
             .groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow())
    coded = table.column("lang").combine_chunks().dictionary_encode()
    code, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    by_lang = np.argsort(code, kind="stable")
    edges = np.searchsorted(code[by_lang], np.arange(len(names) + 1))
    keys = table.column("key").to_numpy().view(np.uint64)[by_lang]
    n = table.column("n").to_numpy().astype(float)[by_lang]
    return fit(sorted(names), {x: (keys[edges[k]: edges[k + 1]], n[edges[k]: edges[k + 1]]) for k, x in enumerate(names)},
               order)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_byte) of each row of ``docs``.

    ``score`` is the posterior of the predicted language under equal priors.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        langs = np.array(shared.value.langs, object)
        for texts in columns:
            data, offsets = tb.flat(texts)
            bits = np.concatenate([np.zeros((0, len(langs)))] + [
                scorer.code_lengths(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
                for lo, hi in tb.slices(offsets)])
            best = bits.argmin(axis=1)
            least = bits[np.arange(len(bits)), best]
            share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
            yield pa.StructArray.from_arrays(
                [pa.array(langs[best], pa.string()), pa.array(share, pa.float64()),
                 pa.array(least / np.maximum(np.diff(offsets), 1), pa.float64())],
                ["lang_pred", "score", "bits_per_byte"])

    text = text_of(docs, text_col)
    rows = docs.select(named(id_col).alias("doc_id"), text.alias("text"), text.rlike("\\p{L}").alias("letters"))
    if model.langs:
        udf = F.arrow_udf(predict, "struct<lang_pred: string, score: double, bits_per_byte: double>")
        rows = rows.withColumn("p", udf("text"))
    else:
        rows = rows.withColumn("p", F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"),
                                             F.lit(0.0).alias("bits_per_byte")))
    return rows.select(
        "doc_id", F.when(F.col("letters"), F.col("p.lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(F.col("letters"), F.col("p.score")).otherwise(0.0).alias("score"), F.col("p.bits_per_byte"))
