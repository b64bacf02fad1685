"""Sum-of-squares online packing of tokenized documents into fixed-length windows.

Documents come in any order and are placed at once.  A document of more than ``window`` ids
fills whole windows first; its rest (or a shorter document) is a piece that goes into a
partly filled window.  The level array counts the open windows of each fill level, and a
piece of ``s`` ids goes to the level ``h`` (0: a new window) for which the sum of squared
counts grows least (by ``2 (N[h + s] - N[h]) + 2``, one less from a new window); full windows
leave the array.  At the end of a block of documents the windows that are still open are closed: the
fullest take ids of the emptiest, which are cut for it, so at most one window of a block has
padding.

At scale: a block is one task's partition of the documents, so texts are tokenized and packed
where they are read, without a shuffle; ``sequence_id`` is the block's number times 2**36 plus
the window's number in the block.  A task holds the level array and the pieces of its open
windows, at most one window for each level on average.  A task that runs again on the same
partition makes the same pieces; for an input whose partitions can change between runs (a
shuffle upstream), write it first.

Texts are cut at spaces and newlines, the distinct words are encoded by the library once
while they stay in a table of bounded bytes, and ids are concatenated; the vocabulary drops white
space and no rule of it looks across a space, so this equals encoding the whole text.  A word
of Latin letters and end marks is encoded as its lower-case letters, by the library's model
alone, and its marks, because that is where the library splits it.  Words longer than
``KEPT_CHARS`` (texts without spaces, encoded data) leave the table with their text.  A task holds
one Arrow batch of whole texts (``spark.sql.execution.arrow.maxRecordsPerBatch``), and of those
as Python strings about a megabyte at a time, one text at least.

Defined results: null text = empty text, which has the one id ``end_id``; null ids, repeated
ids and repeated rows are packed like any other row; an empty table gives no rows.  Only the
named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ledgerprofile.llm import textbytes as tb
from ledgerprofile.llm.columns import named, text_of
from ledgerprofile.session import ship

WINDOW = 4096
END_ID = 2
BLOCK_BITS = 36
TABLE_BYTES = 256 << 20   # of words kept with their ids in a process
WORD_BYTES = 110          # of a kept word beside its string and ids
KEPT_CHARS = 64           # longer words are not kept
EMIT_PIECES = 512


#: Letters that the vocabulary's normalisation only lower-cases, then marks that it splits off.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,!?;:%&*$#|]*)")


class WordEncoder:
    """Ids of texts by a word-level vocabulary file of the tokenizers library."""

    def __init__(self, vocabulary: str, table_bytes: int = TABLE_BYTES):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(vocabulary)
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_chars = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.table_bytes = table_bytes
        self.marks: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {"": 0}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 12, np.int64)    # of word k: ids[first[k]:first[k + 1]]
        self.n_ids = 0
        self.held = 0                               # bytes of the table

    def _stem(self, letters: str) -> list[int]:
        mapped = letters if letters.isascii() else letters.translate(self.byte_chars)
        return [t.id for t in self.tokenizer.model.tokenize(mapped)]

    def _whole(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _rows(self, words: list[str]) -> np.ndarray:
        """Row of each word in the table, -1 where it is not there."""
        return np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))

    def _marks(self, part: str) -> list[int]:
        ids = self.marks.get(part)
        if ids is None:
            ids = self._whole(part)
            if len(part) <= 2:                      # a bounded number of them
                self.marks[part] = ids
        return ids

    def _learn(self, words: list[str]) -> None:
        """Add words without spaces; letters and marks apart where that is how the library splits."""
        new: dict[str, list[int]] = {}
        known, first, ids, match = self.index.get, self.first, self.ids, _PLAIN.fullmatch
        for word in words:
            plain = match(word)
            if not plain:
                new[word] = self._whole(word)
                continue
            letters, marks = plain.groups()
            letters = letters.lower()
            stem = new.get(letters)
            if stem is None:
                row = known(letters)
                if row is None:
                    stem = new[letters] = self._stem(letters)
                else:
                    stem = ids[first[row]: first[row + 1]].tolist()
            new[word] = stem + self._marks(marks) if marks else stem
        sizes = [len(row) for row in new.values()]
        n, k = sum(sizes), len(self.index)
        while self.n_ids + n > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while k + len(new) + 1 > len(self.first):
            self.first = np.concatenate((self.first, np.zeros_like(self.first)))
        self.ids[self.n_ids: self.n_ids + n] = np.fromiter((x for row in new.values() for x in row), np.uint32, n)
        self.first[k + 1: k + 1 + len(new)] = self.n_ids + np.cumsum(sizes)
        self.n_ids += n
        self.held += sum(map(getsizeof, new)) + WORD_BYTES * len(new) + self.ids.itemsize * n
        self.index.update(zip(new, range(k, k + len(new))))

    def _drop_from(self, row: int, held: int) -> None:
        """Take the words from ``row`` on, which were added last, out of the table again."""
        while len(self.index) > row:
            self.index.popitem()
        self.n_ids, self.held = int(self.first[row]), held
        if len(self.ids) * self.ids.itemsize > self.table_bytes:
            self.ids = self.ids[: max(self.n_ids, 1)].copy()

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        for text in texts:
            words = text.replace("\n", " ").split(" ")
            rows, long = self._rows(words), []
            lacking = np.flatnonzero(rows < 0)
            if len(lacking):
                if self.held > self.table_bytes:
                    self._forget()
                    lacking = np.flatnonzero((rows := self._rows(words)) < 0)
                unknown = [words[k] for k in lacking.tolist()]
                new = list(dict.fromkeys(unknown))
                long = [w for w in new if len(w) > KEPT_CHARS]
                self._learn([w for w in new if len(w) <= KEPT_CHARS] if long else new)
                kept, held = len(self.index), self.held
                if long:
                    self._learn(long)
                rows[lacking] = [*map(self.index.__getitem__, unknown)]
            begins = self.first[rows]
            sizes = self.first[rows + 1] - begins
            ends = np.cumsum(sizes)
            ids = self.ids[np.arange(ends[-1]) + np.repeat(begins - ends + sizes, sizes)]
            if long:
                self._drop_from(kept, held)
            yield ids


class SumOfSquaresPacker:
    """Online packer of one block.  A piece is (document key, start, ids, document length)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.levels = np.zeros(window + 1, np.int64)      # open windows by fill level
        self.open: dict[int, list[list]] = {}             # fill level -> windows, each a list of pieces
        self.n_windows = 0

    def _close(self, pieces: list) -> Iterator[tuple]:
        sequence, offset = self.n_windows, 0
        self.n_windows += 1
        for key, start, ids, total in pieces:
            yield key, start, ids, total, sequence, offset
            offset += len(ids)

    def level_for(self, size: int) -> int:
        """The fill level whose window takes a piece of ``size`` ids; 0: a new window."""
        top = self.window - size                          # levels 0 .. top have room
        # (N[h + s] + 1)^2 - N[h + s]^2 + (N[h] - 1)^2 - N[h]^2
        grown = 2 * (self.levels[size: self.window + 1] - self.levels[: top + 1]) + 2
        grown[0] -= 1                                     # a new window leaves no level
        grown[top] = 1 - 2 * self.levels[top]             # a full window is not counted
        grown[1:][self.levels[1: top + 1] == 0] = np.iinfo(np.int64).max
        best = grown.min()
        return int(np.flatnonzero(grown == best)[-1])     # of equal ones the fullest

    def add(self, key, ids: np.ndarray) -> Iterator[tuple]:
        """Place a document; yields the pieces of the windows that became full."""
        total, start = len(ids), 0
        while total - start >= self.window:
            yield from self._close([(key, start, ids[start: start + self.window], total)])
            start += self.window
        if start == total:
            return
        piece = (key, start, ids[start:].copy(), total)   # not a view that keeps the whole document
        size = total - start
        level = self.level_for(size)
        if level:
            pieces = self.open[level].pop()
            self.levels[level] -= 1
            pieces.append(piece)
        else:
            pieces = [piece]
        if level + size == self.window:
            yield from self._close(pieces)
        else:
            self.open.setdefault(level + size, []).append(pieces)
            self.levels[level + size] += 1

    def finish(self) -> Iterator[tuple]:
        """Close the open windows: the fullest are filled up with cut pieces of the emptiest."""
        left = [w for level in sorted(self.open) for w in self.open[level]]
        spare: list[tuple] = []                           # pieces of dissolved windows, last first
        while left:
            pieces = left.pop()
            room = self.window - sum(len(p[2]) for p in pieces)
            while room:
                if not spare:
                    if not left:
                        break
                    spare = left.pop(0)[::-1]
                key, start, ids, total = spare.pop()
                if len(ids) > room:
                    spare.append((key, start + room, ids[room:], total))
                    ids = ids[:room]
                pieces.append((key, start, ids, total))
                room -= len(ids)
            yield from self._close(pieces)
        while spare:
            pieces, room = [], self.window
            while spare and room:
                key, start, ids, total = spare.pop()
                if len(ids) > room:
                    spare.append((key, start + room, ids[room:], total))
                    ids = ids[:room]
                pieces.append((key, start, ids, total))
                room -= len(ids)
            yield from self._close(pieces)
        self.open, self.levels = {}, np.zeros(self.window + 1, np.int64)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(vocabulary: str) -> WordEncoder:
    """The encoder of a vocabulary file, one per Python process."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = WordEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def _emitted(pieces: list[tuple], block: int) -> pa.RecordBatch:
    key, start, ids, total, sequence, offset = zip(*pieces)
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(start, pa.int64()),
         pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()), pa.array(total, pa.int64()),
         pa.array([(block << BLOCK_BITS) + s for s in sequence], pa.int64()), pa.array(offset, pa.int64())],
        names=["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"])


def _packed(batches: Iterable[pa.RecordBatch], vocabulary: str, window: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encode, packer = encoder(vocabulary), SumOfSquaresPacker(window)
    block, waiting = TaskContext.get().partitionId(), []
    end = np.array([end_id], np.uint32)
    for batch in batches:
        for lo, hi in tb.slices(tb.flat(batch.column("text"))[1]):
            part = batch.slice(lo, hi - lo)
            for key, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text").to_pylist())):
                waiting.extend(packer.add(key, np.concatenate((ids, end))))
                if len(waiting) >= EMIT_PIECES:
                    yield _emitted(waiting, block)
                    waiting = []
    waiting.extend(packer.finish())
    for lo in range(0, len(waiting), EMIT_PIECES):
        yield _emitted(waiting[lo: lo + EMIT_PIECES], block)


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (doc_id, start, ids, doc_tokens, sequence_id, offset) of all rows of ``docs``.

    ``ids`` holds the token ids as little-endian unsigned 32-bit numbers.
    """
    ship(docs.sparkSession)
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    return rows.mapInArrow(
        lambda batches: _packed(batches, vocabulary, window, end_id),
        "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long")
