"""Edit-aware token counts.

Each document keeps a segment tree over its pre-tokens: a leaf covers a run of
about ``LEAF`` pre-tokens, and every node holds three sums of what lies below it
(characters, pre-tokens, tokens). An edit re-encodes only the leaves it touches
plus the boundary context that can change with it, replaces those leaves, and
updates the sums on their paths to the root. The count is the root's.

Context: matches of the split pattern depend on text after them only if they
are among the last two before that point, and a match that starts where an old
one started, beyond the edit, is followed by the old matches. So re-encoding
starts two pre-tokens before the edit and stops at the first old leaf start
that is a match start again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bpe import Codec
from .common import batch_rows, map_texts

#: Pre-tokens of a fresh leaf; one that grows beyond GROWN times that is split.
LEAF, GROWN = 32, 8

TREE = "struct<chars: array<int>, pieces: array<int>, tokens: array<int>>"
EDITS = "array<struct<start: int, removed: int, inserted: string>>"


def leaf_sums(codec: Codec, pieces: list[str]) -> np.ndarray:
    """(3, leaves): characters, pre-tokens and tokens of each run of LEAF."""
    if not pieces:
        return np.zeros((3, 1), dtype=np.int64)
    size = codec.sizes.__getitem__
    runs = [pieces[i:i + LEAF] for i in range(0, len(pieces), LEAF)]
    return np.array([[len("".join(r)) for r in runs], [len(r) for r in runs],
                     [sum(map(size, r)) for r in runs]], dtype=np.int64)


class Tree:
    """Sums in heap order: node 1 is the root, node i has children 2i, 2i + 1."""

    def __init__(self, leaves: np.ndarray):
        self.width = 1 << max(0, int(leaves.shape[1] - 1).bit_length())
        self.sums = np.zeros((3, 2 * self.width), dtype=np.int64)
        self.sums[:, self.width:self.width + leaves.shape[1]] = leaves
        at = self.width
        while at > 1:
            level = self.sums[:, at:2 * at]
            self.sums[:, at // 2:at] = level[:, ::2] + level[:, 1::2]
            at //= 2

    @classmethod
    def of(cls, sums: np.ndarray) -> Tree:
        tree = cls.__new__(cls)
        tree.sums, tree.width = sums, sums.shape[1] // 2
        return tree

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds character ``char`` (the last one with any, beyond
        the end) and the characters before it."""
        node, before = 1, 0
        char = min(char, int(self.sums[0, 1]) - 1)
        while node < self.width:
            left = int(self.sums[0, 2 * node])
            node *= 2
            if char - before >= left:
                before += left
                node += 1
        return node - self.width, before

    def put(self, first: int, leaves: np.ndarray) -> None:
        """Replace leaves from ``first`` on and update their paths to the root."""
        lo, hi = self.width + first, self.width + first + leaves.shape[1] - 1
        self.sums[:, lo:hi + 1] = leaves
        while lo > 1:
            lo, hi = lo // 2, hi // 2
            level = self.sums[:, 2 * lo:2 * hi + 2]
            self.sums[:, lo:hi + 1] = level[:, ::2] + level[:, 1::2]


def edit(codec: Codec, text: str, tree: Tree, start: int, removed: int, inserted: str) -> tuple[str, Tree, int]:
    """The text and tree after one edit, and how many pre-tokens were encoded."""
    start = max(0, min(start, len(text)))
    removed = max(0, min(removed, len(text) - start))
    after = text[:start] + inserted + text[start + removed:]
    grown = len(inserted) - removed
    w, leaves = tree.width, tree.sums[:, tree.width:]
    if text:
        first, begin = tree.leaf_at(max(0, start - 1))
        context = 0
        while first > 0 and context < 2:  # two whole pre-tokens before the edit
            first -= 1
            begin -= int(leaves[0, first])
            context += int(leaves[1, first])
        last, before_last = tree.leaf_at(min(start + removed, len(text) - 1))
        stop = before_last + int(leaves[0, last])  # old end of the leaves to replace
    else:
        first = begin = last = stop = 0
    while True:
        # look a little beyond, so that the last two matches are not the end's
        look = min(len(text), stop + 64)
        while True:
            pieces = codec.split(after[begin:look + grown])
            if look >= len(text):
                stop_at, kept = len(after), pieces
                break
            ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))) + begin
            if len(pieces) > 2 and ends[-3] >= stop + grown:
                k = int(np.searchsorted(ends, stop + grown))
                stop_at, kept = (stop + grown, pieces[:k + 1]) if ends[k] == stop + grown else (None, None)
                break
            look = min(len(text), look + 2 * (look - stop))
        if stop_at is not None:
            break
        last += 1  # this leaf's end is no match boundary any more: take the next in
        stop += int(leaves[0, last])
    if stop_at == len(after) and look >= len(text):
        last = w - 1
    new, room = leaf_sums(codec, kept), last - first + 1
    if new.shape[1] > room and len(kept) <= GROWN * LEAF * room:  # fold into the room there is
        starts = np.linspace(0, new.shape[1], room + 1).astype(np.int64)[:-1]
        new = np.add.reduceat(new, starts, axis=1)
    if new.shape[1] <= room:
        padded = np.zeros((3, room), dtype=np.int64)
        padded[:, :new.shape[1]] = new
        tree.put(first, padded)
    else:  # more leaves: the other leaves' sums are kept as they are
        tree = Tree(np.concatenate([leaves[:, :first], new, leaves[:, last + 1:]], axis=1))
    return after, tree, len(kept)


def build_trees(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a ``tree`` column (replacing one of that name):
    heap-ordered sums whose entry 1 is the whole document. Null and empty texts
    have a tree of one empty leaf. Ids may be null or repeat; empty in, empty out."""
    from pyspark.sql import types as T

    rows = docs.drop("tree")
    schema = T.StructType([*rows.schema.fields, T.StructField("tree", T._parse_datatype_string(TREE))])

    def run(batches):
        codec = Codec.load(ranks_path, pattern)
        for part in batch_rows(batches):
            sums = [Tree(leaf_sums(codec, codec.split(t or ""))).sums for t in part.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, tree_array(sums)], [*part.schema.names, "tree"])

    return map_texts(rows, run, schema)


def tree_array(sums: list[np.ndarray]) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum([s.shape[1] for s in sums])]), pa.int32())
    flat = np.concatenate(sums, axis=1).astype(np.int32)
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(x)) for x in flat],
                                      ["chars", "pieces", "tokens"])


def apply_edits(trees: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """(doc_id, text, tree, n_tokens, n_tokens_before, n_encoded): each document
    after its edits, an array of (start, removed, inserted) in characters of the
    text as the edits before it left it. Starts and lengths are cut to the text;
    null edits, null parts of an edit (0, 0, "") and null texts ("") change
    nothing by themselves. ``n_encoded``: pre-tokens that were encoded again."""
    rows = trees.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), "tree",
                        F.col(edits_col).alias("edits"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        codec = Codec.load(ranks_path, pattern)
        for part in batch_rows(batches):
            tree = part.column("tree")
            cols = [tree.field(k) for k in range(3)]
            texts, sums, n, before, work = [], [], [], [], []
            for i, (text, todo) in enumerate(zip(part.column("text").to_pylist(),
                                                 part.column("edits").to_pylist())):
                text = text or ""
                now = Tree.of(np.array([c[i].values.to_numpy(zero_copy_only=False) for c in cols], dtype=np.int64))
                before.append(int(now.sums[2, 1]))
                done = 0
                for e in todo or []:
                    if e is not None:
                        text, now, k = edit(codec, text, now, e["start"] or 0, e["removed"] or 0,
                                            e["inserted"] or "")
                        done += k
                texts.append(text)
                sums.append(now.sums)
                n.append(int(now.sums[2, 1]))
                work.append(done)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(texts, pa.string()), tree_array(sums), pa.array(n, pa.int64()),
                 pa.array(before, pa.int64()), pa.array(work, pa.int64())],
                ["doc_id", "text", "tree", "n_tokens", "n_tokens_before", "n_encoded"])

    return map_texts(rows, run, f"doc_id {kind}, text string, tree {TREE}, n_tokens long, "
                                "n_tokens_before long, n_encoded long")
