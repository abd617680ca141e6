"""Packing token sequences into windows, by non-negative least squares.

Documents longer than the window give full windows and a rest. The rests of a block are
counted by length, rounded up to UNIT tokens. All combinations of up to DEPTH lengths that
fill a window exactly are the columns of a matrix; non-negative least squares finds how
often each should be used to match the histogram, and the rounded-down counts are laid
out. What remains is packed greedily: it is poured, cut where needed, into the gaps that
rounding left and then into new windows. Only the last window of a block may stay
open.

A block is BLOCK_TOKENS tokens of one partition, or its last ones, so nothing is shuffled, memory is
bounded, and a lost task is simply run again. Small partitions are read together until they have
about PART_ROWS rows, so open windows are a small part of all, however the table is cut. Sequence ids are the partition's number
times 2**33 plus a count.

Cases: null and empty texts are a document of the end token alone; a very long text is cut
into windows; rows with equal ids are packed as documents of their own; empty partitions
give nothing.
"""

from __future__ import annotations

import zlib
from functools import cache
from itertools import chain, combinations_with_replacement, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from strandline.llm.common import Codes, blocks, gathered, strings, texts

WINDOW, UNIT, DEPTH = 2048, 16, 3
BLOCK_TOKENS = 8 << 20
LEAST_FILL = 16  #: gaps below this stay padding
CACHED_CHUNKS = 450_000
PART_ROWS = 1_000
MARK = "\x01"


@cache
def combinations(bins: int, depth: int) -> np.ndarray:
    """Every multiset of up to ``depth`` bin sizes that sums to ``bins``; a row each, counts by size."""
    rows = []
    for d in range(1, depth + 1):
        for sizes in combinations_with_replacement(range(1, bins + 1), d - 1):
            last = bins - sum(sizes)
            if last >= (sizes[-1] if sizes else 1):
                rows.append(np.bincount([*sizes, last], minlength=bins + 1)[1:])
    return np.array(rows)


@cache
def _gram(bins: int, depth: int) -> np.ndarray:
    a = combinations(bins, depth).astype(float)
    return a @ a.T


def nnls(bins: int, depth: int, histogram: np.ndarray) -> np.ndarray:
    """Weights x >= 0 of the combinations that minimise |A x - histogram|, by the fast active-set method."""
    a, gram = combinations(bins, depth).astype(float), _gram(bins, depth)
    target = a @ histogram
    n = len(a)
    x, passive = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-7 * max(1.0, float(np.abs(target).max()))
    for _ in range(3 * bins):
        gradient = target - gram @ x
        gradient[passive] = -np.inf
        k = int(gradient.argmax())
        if gradient[k] <= tolerance:
            break
        passive[k] = True
        while True:
            p = np.flatnonzero(passive)
            s = np.linalg.solve(gram[np.ix_(p, p)] + 1e-8 * np.eye(len(p)), target[p])
            if s.min() > 0:
                x[:] = 0
                x[p] = s
                break
            bad = s <= 0
            step = (x[p][bad] / (x[p][bad] - s[bad] + 1e-300)).min()
            x[p] += step * (s - x[p])
            passive[p[x[p] <= 1e-12]] = False
            x[~passive] = 0
            if not passive.any():
                break
    return x


def arrange(lengths: np.ndarray, window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH, least_fill: int = LEAST_FILL) -> tuple[np.ndarray, int, int]:
    """Pieces of documents in sequences, as rows of (document, start, length, sequence, offset); the number of sequences; and how full the last is if it is open, else 0."""
    pieces: list[tuple[int, int, int, int, int]] = []
    full = lengths // window
    sequence = int(full.sum())
    docs = np.repeat(np.arange(len(lengths)), full)
    ordinal = np.arange(sequence) - np.repeat(np.cumsum(full) - full, full)
    whole = np.stack([docs, ordinal * window, np.full(sequence, window), np.arange(sequence), np.zeros(sequence, np.int64)], axis=1)
    rest = lengths - full * window
    bins = window // unit
    by_bin: list[list[int]] = [[] for _ in range(bins + 1)]
    sizes = -(-rest // unit)
    for d in np.flatnonzero(rest).tolist():
        by_bin[sizes[d]].append(d)
    histogram = np.array([len(b) for b in by_bin[1:]])
    gaps: list[tuple[int, int, int]] = []
    if histogram.any():
        table = combinations(bins, depth)
        weights = np.floor(nnls(bins, depth, histogram.astype(float)) + 1e-6).astype(int)
        for c in np.flatnonzero(weights).tolist():
            used = np.flatnonzero(table[c])
            times = min(weights[c], *(len(by_bin[b + 1]) // table[c][b] for b in used))
            for _ in range(times):
                at = 0
                for b in used[::-1]:
                    for _ in range(table[c][b]):
                        d = by_bin[b + 1].pop()
                        pieces.append((d, int(full[d]) * window, int(rest[d]), sequence, at))
                        at += int(rest[d])
                if window - at >= least_fill:
                    gaps.append((sequence, at, window - at))
                sequence += 1
    gaps.sort(key=lambda g: g[2])
    left = [d for b in by_bin[:0:-1] for d in b]
    at, room, target = 0, 0, -1
    for d in left:
        start, size = int(full[d]) * window, int(rest[d])
        while size:
            if not room:
                if gaps:
                    target, at, room = gaps.pop()
                else:
                    target, at, room = sequence, 0, window
                    sequence += 1
            take = min(size, room)
            pieces.append((d, start, take, target, at))
            start, size, at, room = start + take, size - take, at + take, room - take
    rows = np.concatenate([whole, np.array(pieces, np.int64).reshape(-1, 5)])
    return rows, sequence, at if room else 0


_encoders: dict[str, tuple] = {}


class ChunkEncoder:
    """Ids by the tokenizers library, each distinct run between ASCII white space encoded once.

    The tokenizer lower-cases and never joins over white space, so a text's ids are its
    runs' ids, one after another. Texts with a special token's mark go to it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.mark,) = self._ids(MARK)
        self._forget()

    def _forget(self) -> None:
        self.codes = Codes()
        self.ids = np.empty(0, np.uint32)
        self.bounds = np.zeros(1, np.int64)

    def _learn(self) -> None:
        """Encodes the chunks that got a code since the last time, many as one text: a mark that is one token stands between them."""
        new = list(islice(self.codes, len(self.bounds) - 1, None))
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            ids = self._ids((" " + MARK + " ").join([c.decode() for c in part]))
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) == len(part) - 1:
                sizes = np.diff(cuts, prepend=-1, append=len(ids)) - 1
                ids = ids[ids != self.mark]
            else:  # a chunk holds the mark itself
                each = [self._ids(c.decode()) for c in part]
                sizes, ids = np.fromiter(map(len, each), np.int64, len(each)), np.concatenate(each)
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, ids])

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def encode(self, values: list[str]) -> list[np.ndarray]:
        if len(self.codes) > CACHED_CHUNKS:
            self._forget()
        code = self.codes.__getitem__
        which: list[np.ndarray | None] = []
        for v in values:
            data = v.encode()
            which.append(None if b"<|" in data else np.fromiter(map(code, data.lower().split()), np.int64))
        self._learn()
        out = []
        for v, w in zip(values, which, strict=True):
            if w is None:
                out.append(self._ids(v))
                continue
            begins = self.bounds[w]
            sizes = self.bounds[w + 1] - begins
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.ids[np.arange(total) + np.repeat(begins - (ends - sizes), sizes)])
        return out


def encoder_of(path: str) -> ChunkEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


PACKED_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(df: DataFrame, tokenizer_file: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and the crc32 of its ids."""

    def run(batches):
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 33
        encoder = encoder_of(tokenizer_file)
        held_ids: list = []
        held: list[np.ndarray] = []
        tokens = sequences = 0

        def flush():
            nonlocal tokens, sequences
            lengths = np.array([len(x) for x in held], np.int64)
            rows, used, _ = arrange(lengths, window)
            crc = [zlib.crc32(held[d][s : s + n].astype("<u4").tobytes()) for d, s, n in rows[:, :3].tolist()]
            ids = pa.array(held_ids, pa.int64()).take(pa.array(rows[:, 0]))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(rows[:, 1]), pa.array(rows[:, 2]), pa.array(crc, pa.int64()), pa.array(lengths[rows[:, 0]]), pa.array(rows[:, 3] + (base + sequences)), pa.array(rows[:, 4])],
                [c.split()[0] for c in PACKED_SCHEMA.split(", ")],
            )
            sequences += used
            held_ids.clear()
            held.clear()
            tokens = 0

        for block in blocks(batches):
            found = encoder.encode(strings(block))
            held_ids += block.column("doc_id").to_pylist()
            held += [np.append(x, np.uint32(end_id)) for x in found]
            tokens += sum(map(len, found)) + len(found)
            if tokens >= BLOCK_TOKENS:
                yield from flush()
        if held:
            yield from flush()

    return gathered(texts(df, id_col, text_col), PART_ROWS).mapInArrow(run, PACKED_SCHEMA)
