"""Byte-level BPE in padded numpy matrices.

A text is cut by the pattern of its tokenizer; every distinct piece of a block is
encoded once. Pieces are grouped by length and padded into matrices of token ids.
Each round finds the leftmost pair of least rank in every row, looked up in a hash
table of pairs, merges it, and shifts the rest of the row; rows without a pair that
merges are done and leave the matrix. Pieces over ``LONGEST`` bytes are few and
merged one by one with a heap, by the same rule.

Cases: a missing or empty text has no ids; a byte sequence that the ranks lack as a
whole is split into what they hold; all single bytes must have a rank. The file of
ranks is read on the driver and sent to the workers; its size does not depend on
the data.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepline.llm.text import blocks, mix64, whole

LONGEST = 256
_BUCKETS = (2, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, LONGEST)
_NONE = np.int32(2**31 - 1)
_CELLS = 500_000  # of one matrix; each takes some sixty bytes while pairs are looked up
_KNOWN = 100_000  # pieces remembered between blocks
BLOCK = 1_000_000  # characters cut into pieces at once


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@dataclass
class PairTable:
    """Open-addressing table from a pair of ids to the id they merge into."""

    keys: np.ndarray
    values: np.ndarray
    bits: int
    longest: int

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> PairTable:
        found = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        pairs = np.array([p for p, _ in found], np.uint64)
        merged = np.array([r for _, r in found], np.int32)
        bits = max(4, int(np.ceil(np.log2(len(found) + 1))) + 2)
        keys, values = np.full(1 << bits, 2**64 - 1, np.uint64), np.full(1 << bits, _NONE, np.int32)
        left, step = np.arange(len(pairs)), 0
        home = (mix64(pairs) >> np.uint64(64 - bits)).astype(np.int64)
        while len(left):
            slot = (home[left] + step) % (1 << bits)
            free = keys[slot] == np.uint64(2**64 - 1)
            first = np.zeros(len(left), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            keys[slot[put]], values[slot[put]] = pairs[left[put]], merged[left[put]]
            left, step = left[~put], step + 1
        return cls(keys, values, bits, step)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merged id of each pair, ``_NONE`` where there is none."""
        pairs = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        slot = (mix64(pairs) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.where(self.keys[slot] == pairs, self.values[slot], _NONE)
        open_ = np.flatnonzero((out == _NONE) & (self.keys[slot] != np.uint64(2**64 - 1)))
        step = 1
        while len(open_) and step < self.longest:
            at = (slot[open_] + step) % (1 << self.bits)
            hit = self.keys[at] == pairs[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (self.keys[at] != np.uint64(2**64 - 1))]
            step += 1
        return out


@dataclass
class Encoder:
    """Ranks made ready for encoding and decoding; small enough to be sent to every worker."""

    ranks: dict[bytes, int]
    pattern: str
    table: PairTable = field(init=False)

    def __post_init__(self):
        self.table = PairTable.of(self.ranks)
        self.bytes_to_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.pieces = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.pieces[rank] = token
        self._known: dict[str, bytes] = {}

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern}

    def __setstate__(self, state):
        self.__init__(state["ranks"], state["pattern"])

    # encoding -------------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        found = [regex.findall(self.pattern, t) for t in texts]
        if len(self._known) > _KNOWN:
            self._known.clear()
        new = list({p for pieces in found for p in pieces if p not in self._known})
        self._known.update(zip(new, self.encode_pieces([p.encode() for p in new])))
        return [b"".join(map(self._known.__getitem__, pieces)) for pieces in found]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        bucket = np.searchsorted(_BUCKETS, lengths)
        for b in np.unique(bucket):
            rows = np.flatnonzero(bucket == b)
            if b == len(_BUCKETS):
                for i in rows:
                    out[i] = self.merge_long(pieces[i])
                continue
            step = max(1, _CELLS // _BUCKETS[b])
            for start in range(0, len(rows), step):
                part = rows[start : start + step]
                ids, counts = self.merge_rows([pieces[i] for i in part], lengths[part])
                raw, ends = ids.tobytes(), np.cumsum(counts) * 4
                for i, low, high in zip(part, np.concatenate([[0], ends[:-1]]), ends):
                    out[i] = raw[low:high]
        return out

    def merge_rows(self, pieces: list[bytes], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of similar length, one after another, and how many each has."""
        width = int(lengths.max())
        filled = np.arange(width) < lengths[:, None]
        ids = np.zeros((len(pieces), width), np.int32)
        ids[filled] = self.bytes_to_id[np.frombuffer(b"".join(pieces), np.uint8)]
        counts = lengths.astype(np.int64).copy()
        done = np.zeros((len(pieces), width), np.int32)
        rows = np.arange(len(pieces))
        merged = np.full((len(pieces), max(width - 1, 1)), _NONE, np.int32)
        both = filled[:, 1:]
        if width > 1:
            merged[both] = self.table.look_up(ids[:, :-1][both], ids[:, 1:][both])
        live = counts.copy()
        while len(rows):
            at = merged.argmin(axis=1)  # the first of equal minima is the leftmost
            every = np.arange(len(rows))
            least = merged[every, at]
            finished = least == _NONE
            if finished.any():
                done[rows[finished], : ids.shape[1]] = ids[finished]
                counts[rows[finished]] = live[finished]
                keep = ~finished
                rows, ids, merged, live, at, least = rows[keep], ids[keep], merged[keep], live[keep], at[keep], least[keep]
                if not len(rows):
                    break
                every = np.arange(len(rows))
            ids[every, at] = least
            # everything right of the merged pair moves one place to the left
            column = np.arange(ids.shape[1] - 1)
            moved = column > at[:, None]
            ids[:, :-1] = np.where(moved, ids[:, 1:], ids[:, :-1])
            live -= 1
            if merged.shape[1] > 1:
                pair = np.arange(merged.shape[1] - 1)
                merged[:, :-1] = np.where(pair > at[:, None], merged[:, 1:], merged[:, :-1])
            merged[every, live - 1] = _NONE
            before, after = at > 0, at < live - 1
            i = every[before]
            merged[i, at[before] - 1] = self.table.look_up(ids[i, at[before] - 1], ids[i, at[before]])
            i = every[after]
            merged[i, at[after]] = self.table.look_up(ids[i, at[after]], ids[i, at[after] + 1])
            width_now = int(live.max())
            if width_now < ids.shape[1]:
                ids, merged = ids[:, :width_now], merged[:, : max(width_now - 1, 1)]
        return done[np.arange(width) < counts[:, None]], counts

    def merge_long(self, piece: bytes) -> bytes:
        """The same merges for one long piece, with a heap of its pairs instead of a scan a round."""
        rank, n = self.ranks, len(piece)
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue
            alive[j], end[i], after[i] = False, stop, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := rank.get(piece[i : end[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[after[i]]))
            h = before[i]
            if h >= 0 and (r := rank.get(piece[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        return np.array([rank[piece[i : end[i]]] for i in range(n) if alive[i]], "<u4").tobytes()

    # decoding -------------------------------------------------------------------

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def load_encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, encoder: Encoder, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` as a list, for every row."""
    rows = docs.select(F.col(doc_id).alias("__id"), whole(text).alias("__text"))
    sent = docs.sparkSession.sparkContext.broadcast(encoder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__text", BLOCK):
            ids = sent.value.encode(block["__text"].tolist())
            yield pd.DataFrame({"__id": block["__id"], "ids": [np.frombuffer(i, "<u4").astype(np.int32) for i in ids]})

    out = rows.mapInPandas(run, f"__id {rows.schema['__id'].dataType.simpleString()}, ids array<int>")
    return out.withColumnRenamed("__id", doc_id)


def decode_documents(encoded: DataFrame, encoder: Encoder, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id``, ``bytes`` and ``text`` (null where the bytes are not UTF-8) of every row of ids."""
    rows = encoded.select(F.col(doc_id).alias("__id"), F.col(ids).alias("__ids"))
    sent = encoded.sparkSession.sparkContext.broadcast(encoder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [b"" if i is None else sent.value.decode(np.asarray(i).astype("<u4").tobytes()) for i in batch["__ids"]]
            yield pd.DataFrame({"__id": batch["__id"], "bytes": raw})

    out = rows.mapInPandas(run, f"__id {rows.schema['__id'].dataType.simpleString()}, bytes binary")
    return out.select(F.col("__id").alias(doc_id), "bytes", F.try_validate_utf8(F.col("bytes").cast("string")).alias("text"))


def round_trip_digests(docs: DataFrame, encoder: Encoder, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of ids, digest of the ids and digest of the bytes they decode to; ids stay in their block."""
    rows = docs.select(F.col(doc_id).alias("__id"), whole(text).alias("__text"))
    sent = docs.sparkSession.sparkContext.broadcast(encoder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__text", BLOCK):
            ids = sent.value.encode(block["__text"].tolist())
            yield pd.DataFrame({
                "__id": block["__id"], "n_tokens": [len(i) // 4 for i in ids],
                "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
                "decoded_sha256": [hashlib.sha256(sent.value.decode(i)).hexdigest() for i in ids],
            })

    schema = f"__id {rows.schema['__id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInPandas(run, schema).withColumnRenamed("__id", doc_id)
