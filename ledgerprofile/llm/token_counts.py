"""Token counts of whole texts by a compiled finite-state transducer.

The transducer gives the token counts of a byte-pair model with scored pieces (the
sentencepiece kind) without building any token.  It rests on three facts:

* a token sequence is the encoding of a text exactly if every piece encodes to itself and
  every two neighbours encode to themselves; so the last token of each prefix follows from
  the last tokens of earlier prefixes;
* only the prefixes at which a still open piece may begin matter: a state is those open
  beginnings, with the token before each and its count relative to the current one.  There
  are finitely many, and each transition is annotated with the change of the count;
* where no piece holds two neighbouring characters, a token ends between them whatever the
  state was: the boundary *synchronises* the transducer.

States and transitions are compiled when a text first needs them and are kept per Python
process in a hash table (at most ``MAX_STATES``; then the table starts anew, which costs time
and changes nothing).  A slice of texts is cut into chunks of ``CHUNK`` characters that run
side by side.  A chunk's state map (start state to end state and count) is constant from its first
synchronising boundary on, so those chunks run from that boundary at once.  Chunks
without any boundary get maps with several entries: equal chunks share one map, which is filled
for the initial state and for the states in which the maps before it end; the maps of a
stretch of such chunks are composed by a parallel prefix scan, doubling the distance in each step.  An entry
that the scan turns out to need is added and the scan repeated.  Last, the stretches
before the first boundaries run from the states that the scan gave them.

At scale: no shuffle and nothing collected; a task holds one slice of texts and the table.

Defined results: null text = empty text = no bytes, no tokens; null ids, repeated ids and
repeated rows each give a row; an empty table gives no rows.  Only the named columns are
read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerprofile.llm import textbytes as tb
from ledgerprofile.llm.columns import named, text_of
from ledgerprofile.session import ship

CHUNK = 256
MAX_STATES = 400_000
SPECULATED = 4               # rounds in which maps are filled for the states that may precede them
COMPOSED = 1 << 22           # map entries that are composed at a time
SPACE = "▁"
START = 0        # the state at the beginning of a text and after a synchronising boundary
_NO_TOKEN = ""   # what stands before the first token


class Transducer:
    """Count transducer of one model; compiled as texts need it."""

    def __init__(self, model_path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(sp.vocab_size())]
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i, s in enumerate(special) if not s}
        chars = sorted({c for piece in self.score for c in piece})
        if any(c not in self.score for c in chars) or sp.is_unused(sp.vocab_size() - 1):
            raise ValueError("a character of the pieces is no piece itself: not a model of this kind")
        self.n_classes = len(chars) + 1                      # class 0: characters without a piece
        self.class_of = np.zeros(0x110000, np.uint16)
        self.class_of[[ord(c) for c in chars]] = np.arange(1, self.n_classes)
        self.class_of[32] = self.class_of[ord(SPACE)]
        self.chars = ["", *chars]
        self.synchronises = np.ones((self.n_classes, self.n_classes), bool)
        self.prefixes: set[str] = set()                      # proper prefixes of pieces
        for piece in self.score:
            ids = [int(self.class_of[ord(c)]) for c in piece]
            self.synchronises[ids[:-1], ids[1:]] = False
            self.prefixes.update(piece[:k] for k in range(1, len(piece)))
        self._whole: dict[str, bool] = {}
        self._neighbours: dict[tuple[str, str], bool] = {}
        self.reset()

    # -- the model on short strings -------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """Byte-pair encoding of a short string: the best-scored neighbours are joined first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, before: str, piece: str) -> bool:
        """Whether ``piece`` is a token after the token ``before``."""
        if piece not in self._whole:
            self._whole[piece] = self.merged(piece) == [piece]
        if not self._whole[piece] or not before:
            return self._whole[piece]
        key = before, piece
        if key not in self._neighbours:
            self._neighbours[key] = self.merged(before + piece) == [before, piece]
        return self._neighbours[key]

    # -- compilation ----------------------------------------------------------------------

    def reset(self) -> None:
        """Forget all compiled states."""
        # a state: the open beginnings, longest first, as (text since then, token before, relative count)
        self.states: list[tuple] = [(("", _NO_TOKEN, 0),)]
        self.ids = {self.states[0]: START}
        self._table(1 << 16)

    def _table(self, size: int) -> None:
        self.keys = np.full(size, -1, np.int64)
        self.targets = np.zeros(size, np.int32)
        self.changes = np.zeros(size, np.int16)
        self.filled = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        shift = np.uint64(64 - (len(self.keys).bit_length() - 1))
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)

    def _insert(self, keys: np.ndarray, targets: np.ndarray, changes: np.ndarray) -> None:
        if 2 * (self.filled + len(keys)) > len(self.keys):
            used = self.keys >= 0
            keys = np.concatenate((self.keys[used], keys))
            targets = np.concatenate((self.targets[used], targets))
            changes = np.concatenate((self.changes[used], changes))
            size = len(self.keys)
            while 4 * len(keys) > size:
                size *= 2
            self._table(size)
        mask = len(self.keys) - 1
        for key, slot, target, change in zip(keys.tolist(), self._slots(keys).tolist(), targets.tolist(), changes.tolist()):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & mask
            self.keys[slot], self.targets[slot], self.changes[slot] = key, target, change
        self.filled += len(keys)

    def _compile(self, state: int, char_class: int) -> tuple[int, int]:
        """(next state, change of the count) of one transition."""
        if char_class == 0:
            return START, 0                       # counted by its bytes
        char = self.chars[char_class]
        for since, before, count in self.states[state]:
            piece = since + char
            if piece in self.score and self._fits(before, piece):
                break
        else:
            raise AssertionError("a prefix without a last token")
        change = count + 1
        opened = [(s + char, b, n - change) for s, b, n in self.states[state] if s + char in self.prefixes]
        opened.append(("", piece, 0))
        key = tuple(opened)
        target = self.ids.setdefault(key, len(self.states))
        if target == len(self.states):
            self.states.append(key)
        return target, change

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Table slots of the transitions ``keys``; -1 where not compiled yet."""
        mask = len(self.keys) - 1
        slots = self._slots(keys)
        found = self.keys[slots]
        open_ = np.flatnonzero(found != keys)
        while len(open_):
            empty = found[open_] < 0
            slots[open_[empty]] = -1
            open_ = open_[~empty]
            slots[open_] = (slots[open_] + 1) & mask
            found[open_] = self.keys[slots[open_]]
            open_ = open_[found[open_] != keys[open_]]
        return slots

    def step(self, states: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and count changes of all lanes."""
        keys = states * np.int64(self.n_classes) + classes
        slots = self._find(keys)
        missing = np.unique(keys[slots < 0])
        if len(missing):
            made = [self._compile(*divmod(k, self.n_classes)) for k in missing.tolist()]
            self._insert(missing, np.array([m[0] for m in made]), np.array([m[1] for m in made]))
            slots = self._find(keys)
        return self.targets[slots], self.changes[slots]

    def run(self, classes: np.ndarray, boundary: np.ndarray, begins: np.ndarray, ends: np.ndarray,
            states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Run the lanes ``begins[k]:ends[k]`` from ``states``; (end states, counts)."""
        order = np.argsort(begins - ends, kind="stable")
        at, left = begins[order], (ends - begins)[order]
        now, counts = states[order].astype(np.int64), np.zeros(len(order), np.int64)
        for k in range(int(left[0]) if len(left) else 0):
            n = int(np.searchsorted(-left, -k, "left"))       # lanes with more than k characters
            here = at[:n] + k
            nxt, change = self.step(np.where(boundary[here], START, now[:n]), classes[here])
            now[:n] = nxt
            counts[:n] += change
        out_states, out_counts = np.empty_like(now), np.empty_like(counts)
        out_states[order], out_counts[order] = now, counts
        return out_states, out_counts

    # -- maps of chunks without a boundary --------------------------------------------------

    def _composed(self, classes: np.ndarray, boundary: np.ndarray, begins: np.ndarray, ends: np.ndarray,
                  whole: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end state, count) of the chunks ``whole``; ``last`` has the end states of those before a run of them."""
        rows = np.full((len(whole), CHUNK), -1, np.int32)
        inside = np.arange(CHUNK) < (ends - begins)[whole][:, None]
        rows[inside] = classes[(begins[whole][:, None] + np.arange(CHUNK))[inside]]
        _, sample, content = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        content = content.ravel()
        opens = np.concatenate(([True], whole[1:] != whole[:-1] + 1))       # a text's first chunk has a boundary
        run = np.cumsum(opens) - 1
        entry = last[whole[opens] - 1]
        pairs = np.unique(np.stack([content[:-1], content[1:]], axis=1)[~opens[1:]], axis=0).tolist()
        maps: list[dict[int, tuple[int, int]]] = [{START: (-1, 0)} for _ in sample]
        wanted = {(c, START) for c in range(len(sample))} | set(zip(content[opens].tolist(), entry.tolist()))
        rounds = 0
        while True:
            lanes = np.array(sorted(wanted), np.int64)
            chunks = whole[sample[lanes[:, 0]]]
            got, n = self.run(classes, boundary, begins[chunks], ends[chunks], lanes[:, 1])
            for c, s, e, k in zip(*lanes.T.tolist(), got.tolist(), n.tolist()):
                maps[c][s] = e, k
            wanted = set()
            if rounds < SPECULATED:
                rounds += 1
                wanted = {(b, e) for a, b in pairs for e, _ in maps[a].values() if e not in maps[b]}
            if not wanted:
                states, counts, wanted = self._scan(maps, content, run, entry)
                if not wanted:
                    return states, counts

    @staticmethod
    def _scan(maps: list[dict[int, tuple[int, int]]], content: np.ndarray, run: np.ndarray,
              entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, set[tuple[int, int]]]:
        """(end states, counts, entries that are missing) of runs of chunks that begin in the states ``entry``."""
        names = np.unique([s for m in maps for x in m.items() for s in (x[0], x[1][0])] + entry.tolist())
        targets = np.full((len(maps), len(names)), -1, np.int32)
        changes = np.zeros((len(maps), len(names)), np.int64)
        for c, m in enumerate(maps):
            at = np.searchsorted(names, list(m))
            targets[c, at] = np.searchsorted(names, [e for e, _ in m.values()])
            changes[c, at] = [k for _, k in m.values()]
        now = np.searchsorted(names, entry)                   # state of each run, -1 where an entry is missing
        states, before = np.empty(len(content), np.int64), np.empty(len(content), np.int64)
        step = max(1, COMPOSED // len(names))
        for lo in range(0, len(content), step):
            own = run[lo: lo + step]
            opens = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1))
            place = np.arange(len(own)) - np.repeat(opens, np.diff(np.append(opens, len(own))))
            table = targets[content[lo: lo + step]]
            distance = 1
            while distance <= place.max():
                later = np.flatnonzero(place >= distance)
                first = table[later - distance]
                table[later] = np.where(first >= 0, np.take_along_axis(table[later], np.maximum(first, 0), axis=1), -1)
                distance *= 2
            start = now[own]
            states[lo: lo + step] = np.where(start >= 0, table[np.arange(len(own)), np.maximum(start, 0)], -1)
            before[lo: lo + step] = np.where(place > 0, np.roll(states[lo: lo + step], 1), start)
            now[own[-1]] = states[lo + len(own) - 1]
        missing = np.flatnonzero((states < 0) & (before >= 0))
        wanted = set(zip(content[missing].tolist(), names[before[missing]].tolist()))
        if wanted:
            return states, before, wanted
        return names[states], changes[content, before], wanted

    # -- texts ----------------------------------------------------------------------------

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Token counts of the UTF-8 texts ``data[offsets[k]:offsets[k + 1]]``."""
        if len(self.states) > MAX_STATES:
            self.reset()
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        leads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        lengths = np.diff(leads[offsets])
        texts = np.flatnonzero(lengths)                       # each gets a space in front
        out = np.zeros(len(offsets) - 1, np.int64)
        if not len(texts):
            return out
        lengths = lengths[texts]
        firsts = np.concatenate(([0], np.cumsum(lengths + 1)))
        classes = np.full(int(firsts[-1]), self.class_of[32], np.int64)
        classes[np.arange(len(points)) + np.repeat(np.arange(1, len(texts) + 1), lengths)] = self.class_of[points]
        # characters without a piece count their bytes
        own = self.class_of[points] == 0
        sizes = np.where(own, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), 0)
        out[texts] = np.add.reduceat(sizes, firsts[:-1] - np.arange(len(texts)))
        boundary = np.empty(len(classes), bool)
        boundary[1:] = self.synchronises[classes[:-1], classes[1:]]
        boundary[firsts[:-1]] = True
        # chunks of each text
        per_text = -(-(lengths + 1) // CHUNK)
        text_of_chunk = np.repeat(np.arange(len(texts)), per_text)
        nth = np.arange(len(text_of_chunk)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        begins = firsts[text_of_chunk] + nth * CHUNK
        ends = np.minimum(begins + CHUNK, firsts[text_of_chunk + 1])
        marks = np.append(np.flatnonzero(boundary), len(classes))
        bodies = np.minimum(marks[np.searchsorted(marks, begins)], ends)
        counts, last = np.zeros(len(begins), np.int64), np.full(len(begins), -1, np.int64)
        some = np.flatnonzero(bodies < ends)                  # their maps are constant from there on
        last[some], counts[some] = self.run(classes, boundary, bodies[some], ends[some], np.zeros(len(some), np.int64))
        whole = np.flatnonzero(bodies == ends)                # no boundary at all
        if len(whole):
            last[whole], counts[whole] = self._composed(classes, boundary, begins, ends, whole, last)
        head = np.flatnonzero((bodies > begins) & (bodies < ends))
        counts[head] += self.run(classes, boundary, begins[head], bodies[head], last[head - 1])[1]
        out[texts] += np.add.reduceat(counts, np.cumsum(per_text) - per_text)
        return out


_COMPILED: dict[str, Transducer] = {}


def transducer(model_path: str) -> Transducer:
    """The transducer of a model, one per Python process."""
    if model_path not in _COMPILED:
        _COMPILED[model_path] = Transducer(model_path)
    return _COMPILED[model_path]


def _counted(batches: Iterator[pa.RecordBatch], model_path: str) -> Iterator[pa.RecordBatch]:
    machine = transducer(model_path)
    for batch in batches:
        data, offsets = tb.flat(batch.column("text"))
        counts = [machine.counts(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
                  for lo, hi in tb.slices(offsets)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(offsets), pa.int64()),
             pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of each row of ``docs``, as the model's library counts them."""
    ship(docs.sparkSession)
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    return rows.mapInArrow(lambda batches: _counted(batches, model_path), "doc_id long, n_bytes long, n_tokens long")
