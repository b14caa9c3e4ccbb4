"""Byte-level BPE by a monoid tree reduction.

The encoding of a text is built like a product in a monoid: halves are encoded
recursively and neighbours are joined. A join re-encodes a window around the
seam and grows it until what lies outside provably cannot change:

* pre-tokens: a match of the split pattern depends on what follows only if it
  is one of the last two matches before that point, so all but the last two
  matches of the left half stand; on the right, once a match starts where a
  match of the right half starts, the rest agrees, because matches depend only
  on the text after their start;
* tokens of one pre-token: a token sequence is the encoding of its bytes exactly
  if every two neighbours (u, v) are the encoding of u + v. Inside a half and
  inside the window this holds by construction, so only the two pairs at the
  window's rims are tested.

Decoding concatenates bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from itertools import accumulate, chain
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch_rows, map_texts

#: Characters of text, bytes of a pre-token and ids that a leaf of a tree holds.
LEAF_CHARS, LEAF_BYTES, LEAF_IDS = 4096, 64, 4096
#: Bytes of a window from which merging keeps its pairs in a heap.
HEAP_BYTES = 256
#: Pre-tokens whose codes a worker remembers, and the longest it remembers.
CACHED, CACHED_CHARS = 400_000, 64


class Encoded(NamedTuple):
    pieces: list  # the pattern's matches, in order
    codes: list  # a tuple of token ids for each


class Remembered(dict):
    """Pre-token -> what ``make`` gives for it, kept for short ones. When CACHED are
    kept, they become the older generation, from which those still in use return."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, piece: str):
        if (value := self.older.get(piece)) is None:
            value = self.make(piece)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.older = dict(self)
                self.clear()
            self[piece] = value
        return value


class Codec:
    """Encoder and decoder for one rank file and split pattern. ``codes`` and
    ``sizes`` map a pre-token to its ids and to their number."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.bytes_of = [b""] * self.size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.text_of = [str(i) for i in range(self.size)]
        self.split = regex.compile(pattern).findall
        self.pairs: dict[tuple[int, int], bool] = {}
        self.codes = Remembered(lambda piece: tuple(self.encode_bytes(piece.encode("utf-8"))))
        self.sizes = Remembered(lambda piece: len(self.encode_bytes(piece.encode("utf-8"))))

    @classmethod
    def load(cls, path: str, pattern: str) -> Codec:
        """The codec of a rank file, kept by a Python worker from task to task."""
        kept = sys.__dict__.setdefault("_llm_codecs", {})
        if (path, pattern) not in kept:
            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            kept[path, pattern] = cls(ranks, pattern)
        return kept[path, pattern]

    # -- one pre-token ----------------------------------------------------
    def merge(self, data: bytes) -> list[int]:
        """The ids of ``data`` by merging the pair of lowest rank, leftmost first."""
        ranks = self.ranks
        if data in ranks:
            return [ranks[data]]
        if len(data) > HEAP_BYTES:
            return self._merge_by_heap(data)
        parts = [data[i:i + 1] for i in range(len(data))]
        top = self.size
        pair = [ranks.get(a + b, top) for a, b in zip(parts, parts[1:])]
        while pair and (low := min(pair)) < top:
            i = pair.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i < len(pair):
                pair[i] = ranks.get(parts[i] + parts[i + 1], top)
            if i:
                pair[i - 1] = ranks.get(parts[i - 1] + parts[i], top)
        return [ranks[p] for p in parts]

    def _merge_by_heap(self, data: bytes) -> list[int]:
        n, ranks = len(data), self.ranks
        end = list(range(1, n + 1))  # of the part that starts here; 0: merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or not end[mid] or end[mid] != stop:
                continue
            end[i], end[mid] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if before[i] >= 0 and (r := ranks.get(data[before[i]:stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        return [ranks[data[i:e]] for i, e in enumerate(end) if e]

    def neighbours(self, u: int, v: int) -> bool:
        """Whether [u, v] is the encoding of its bytes."""
        if (u, v) not in self.pairs:
            if len(self.pairs) >= CACHED:
                self.pairs.clear()
            self.pairs[u, v] = self.merge(self.bytes_of[u] + self.bytes_of[v]) == [u, v]
        return self.pairs[u, v]

    def join_ids(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encodings' bytes laid end to end."""
        if not left or not right or self.neighbours(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.merge(b"".join(self.bytes_of[t] for t in left[len(left) - i:] + right[:j]))
            left_ok = i == len(left) or self.neighbours(left[len(left) - i - 1], window[0])
            right_ok = j == len(right) or self.neighbours(window[-1], right[j])
            if left_ok and right_ok:
                return left[:len(left) - i] + window + right[j:]
            if not left_ok:
                i = min(len(left), 2 * i)
            if not right_ok:
                j = min(len(right), 2 * j)

    def encode_bytes(self, data: bytes) -> list[int]:
        """The ids of one pre-token: short ones by merging, longer ones by halves."""
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        half = len(data) // 2
        return self.join_ids(self.encode_bytes(data[:half]), self.encode_bytes(data[half:]))

    # -- whole texts ------------------------------------------------------
    def join(self, left: Encoded, right: Encoded) -> Encoded:
        if not left.pieces or not right.pieces:
            return left if left.pieces else right
        i, j = min(2, len(left.pieces)), 4
        tail = left.pieces[len(left.pieces) - i:]
        seam = sum(map(len, tail))
        while True:
            head = right.pieces[:j]
            pieces = self.split("".join(tail) + "".join(head))
            if j >= len(right.pieces):
                kept = len(right.pieces)
                break
            stable = list(accumulate(map(len, pieces), initial=0))[:-2]
            old = {seam + at: k for k, at in enumerate(accumulate(map(len, head), initial=0))}
            met = next((k for k, at in enumerate(stable) if at in old), None)
            if met is not None:
                pieces, kept = pieces[:met], old[stable[met]]
                break
            j *= 2
        codes, across = [], left.pieces[-1] + right.pieces[0]
        for piece in pieces:
            if piece == across and len(piece) > CACHED_CHARS:  # both halves' work is used again
                codes.append(tuple(self.join_ids(list(left.codes[-1]), list(right.codes[0]))))
            else:
                codes.append(self.codes[piece])
        del left.pieces[len(left.pieces) - i:], left.codes[len(left.codes) - i:]
        left.pieces.extend(pieces)
        left.codes.extend(codes)
        left.pieces.extend(right.pieces[kept:])
        left.codes.extend(right.codes[kept:])
        return left

    def reduce(self, text: str) -> Encoded:
        if len(text) <= LEAF_CHARS:
            pieces = self.split(text)
            return Encoded(pieces, list(map(self.codes.__getitem__, pieces)))
        half = len(text) // 2
        return self.join(self.reduce(text[:half]), self.reduce(text[half:]))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.reduce(text).codes))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def _id_field(df: DataFrame) -> str:
    return f"doc_id {df.schema['doc_id'].dataType.simpleString()}"


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of each whole text, one row per input row.

    Null and empty texts give an empty list; null and repeated ids and repeated
    rows pass through; other columns are not read; empty in, empty out. The rank
    file is read on every worker, so ``ranks_path`` must exist there.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        codec = Codec.load(ranks_path, pattern)
        for part in batch_rows(batches):
            ids = [codec.encode(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))],
                                             ["doc_id", "ids"])

    return map_texts(rows, run, f"{_id_field(rows)}, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, data): the bytes the ids stand for."""
    rows = encoded.select("doc_id", "ids")

    def run(batches):
        codec = Codec.load(ranks_path, pattern)
        for part in batch_rows(batches):
            data = [codec.decode(ids or []) for ids in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(data, pa.binary())],
                                             ["doc_id", "data"])

    return map_texts(rows, run, f"{_id_field(rows)}, data binary")


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) in one pass: each text is
    encoded, its ids are decoded, and only digests of both leave the task. Edge
    cases as in ``encode_documents``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        codec = Codec.load(ranks_path, pattern)
        for part in batch_rows(batches):
            n, sent, back = [], [], []
            for text in part.column("text").to_pylist():
                ids = codec.encode(text or "")
                n.append(len(ids))
                sent.append(hashlib.sha256(",".join(map(codec.text_of.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(sent, pa.string()),
                 pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_texts(rows, run, f"{_id_field(rows)}, n_tokens long, ids_sha256 string, decoded_sha256 string")
