"""Byte-level BPE by corpus-level merge replay.

A block of texts is one corpus: its distinct pre-tokens lie one after another in one
array of token ids, linked to their neighbours. An inverted index takes each rank to the
positions whose pair has that rank. Ranks are taken in order; all positions of a rank are
merged at once, and only the pairs left and right of a merge get a new rank and a new
place in the index. Words whose replay would leave rank order (a merge that gives rise to
a lower rank) are done again one by one, so ids equal those of the usual encoder.

Cases: null counts as empty and gives no ids; repeated words cost nothing more; very
long texts are encoded whole; the result of a row doesn't depend on its block; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strandline.llm.common import Codes, blocks, strings, texts

NONE = np.int32(2**31 - 1)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Replay:
    """The merges of one rank file. ``encode`` takes distinct words and gives ids and bounds."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.token_bytes: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.token_bytes[rank] = token
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, values = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.pair_keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.array(values, np.int32)[order], NONE)
        self.forget()

    def forget(self) -> None:
        """Drops the words that ``encode_texts`` has kept."""
        self.codes = Codes()
        self.known_ids, self.known_bounds = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all words one after another, and where each word begins (one bound more than words)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        n = int(starts[-1])
        if not n:
            return np.empty(0, np.int64), starts
        tokens = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        following = np.arange(1, n + 1)
        following[starts[1:][sizes > 0] - 1] = n  # n: none
        previous = np.arange(-1, n - 1)
        previous[starts[:-1][sizes > 0]] = n
        tokens = np.append(tokens, 0)
        alive = np.ones(n + 1, bool)
        rank_at = np.full(n + 1, NONE, np.int32)
        inner = np.flatnonzero(following < n)
        rank_at[inner] = self._rank(tokens[inner], tokens[following[inner]])
        index: dict[int, list[np.ndarray]] = defaultdict(list)
        heap: list[int] = []
        disordered: list[np.ndarray] = []

        def enter(positions: np.ndarray) -> None:
            ranks = rank_at[positions]
            keep = ranks != NONE
            positions, ranks = positions[keep], ranks[keep]
            if not len(positions):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            begins = [0, *cuts.tolist(), len(ranks)]
            for k, a in enumerate(begins[:-1]):
                r = int(ranks[a])
                if r not in index:
                    heapq.heappush(heap, r)
                index[r].append(positions[a : begins[k + 1]])

        enter(inner)
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.sort(lists[0])
            at = at[(rank_at[at] == r) & alive[at]]
            if not len(at):
                continue
            if len(at) > 1:  # of overlapping pairs the first, third ... are merged
                chained = following[at[:-1]] == at[1:]
                if chained.any():
                    heads = np.concatenate([[True], ~chained])
                    run_start = np.maximum.accumulate(np.where(heads, np.arange(len(at)), 0))
                    at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            gone = following[at]
            after = following[gone]
            tokens[at] = r
            alive[gone] = False
            rank_at[gone] = NONE
            following[at] = after
            linked = after < n
            previous[after[linked]] = at[linked]
            rank_at[at] = NONE
            right = at[linked]
            rank_at[right] = self._rank(tokens[right], tokens[after[linked]])
            before = previous[at]
            left = before[before < n]
            rank_at[left] = self._rank(tokens[left], tokens[following[left]])
            touched = np.concatenate([right, left])
            low = touched[rank_at[touched] < r]
            if len(low):
                disordered.append(low)
            enter(np.unique(touched))
        ids = tokens[:-1][alive[:-1]]
        bounds = np.concatenate([[0], np.cumsum(alive[:-1])])[starts]
        if disordered:
            wrong = np.unique(np.searchsorted(starts, np.concatenate(disordered), side="right") - 1)
            pieces = {int(w): np.array(self.encode_one(words[w]), np.int64) for w in wrong}
            parts = [pieces.get(w, ids[bounds[w] : bounds[w + 1]]) for w in range(len(words))]
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            ids = np.concatenate(parts)
        return ids, bounds

    def encode_one(self, word: bytes) -> list[int]:
        """The lowest rank first, the leftmost of equals, one merge at a time; a heap holds the pairs."""
        parts = [self.ranks[word[i : i + 1]] for i in range(len(word))]
        n = len(parts)
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = lambda i: self.ranks.get(self.token_bytes[parts[i]] + self.token_bytes[parts[following[i]]])
        heap = [(r, i) for i in range(n - 1) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if parts[i] < 0 or following[i] >= n or pair(i) != r:
                continue  # one of the two has changed since
            gone = following[i]
            parts[i], parts[gone] = r, -1
            following[i] = after = following[gone]
            if after < n:
                previous[after] = i
            for k in (previous[i], i):
                if k >= 0 and following[k] < n and (rank := pair(k)) is not None:
                    heapq.heappush(heap, (rank, k))
        return [p for p in parts if p >= 0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


def gather(values: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The slices of ``values`` numbered by ``which``, one after another."""
    begins = bounds[which]
    sizes = bounds[which + 1] - begins
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(begins - (ends - sizes), sizes)]


_replays: dict[str, Replay] = {}


def replay_of(path: str) -> Replay:
    if path not in _replays:
        _replays[path] = Replay(load_ranks(path))
    return _replays[path]


#: Words whose ids a task keeps from block to block; beyond that it begins anew.
CACHED_WORDS = 300_000


def encode_texts(replay: Replay, pattern: regex.Pattern, values: list[str]) -> list[np.ndarray]:
    """Ids of each text of a block. Only the words that no block before had are replayed."""
    if len(replay.codes) > CACHED_WORDS:
        replay.forget()
    find, code = pattern.findall, replay.codes.__getitem__
    which = [np.fromiter(map(code, find(text)), np.int64) for text in values]
    known = len(replay.known_bounds) - 1
    ids, bounds = replay.encode([w.encode() for w in islice(replay.codes, known, None)])
    replay.known_ids = np.concatenate([replay.known_ids, ids.astype(np.int32)])
    replay.known_bounds = np.concatenate([replay.known_bounds, replay.known_bounds[-1] + bounds[1:]])
    return [gather(replay.known_ids, replay.known_bounds, w) for w in which]


ENCODED_SCHEMA = "doc_id long, ids array<int>"


def encode(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of each text."""

    def run(batches):
        replay, compiled = replay_of(rank_file), regex.compile(pattern)
        for block in blocks(batches):
            ids = encode_texts(replay, compiled, strings(block))
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = np.concatenate([*ids, np.empty(0, np.int64)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([block.column("doc_id").cast(pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))], ["doc_id", "ids"])

    return texts(df, id_col, text_col).mapInArrow(run, ENCODED_SCHEMA)


def decode(df: DataFrame, rank_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the bytes that the ids stand for; null ids give empty bytes."""

    def run(batches):
        replay = replay_of(rank_file)
        for batch in batches:
            out = [replay.decode(x or []) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    return texts(df, id_col, ids_col).mapInArrow(run, "doc_id long, bytes binary")


def round_trip(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes in one pass and keeps digests of both: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches):
        replay, compiled = replay_of(rank_file), regex.compile(pattern)
        for block in blocks(batches):
            counts, hashes, decoded = [], [], []
            for ids in encode_texts(replay, compiled, strings(block)):
                counts.append(len(ids))
                hashes.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(replay.decode(ids.tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
