"""Edited token counts against counting the edited text from scratch."""

import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cartlens.llm import token_tree as tt
from cartlens.llm.bpe import Codec

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CODEC = Codec.load(PATH, public_tokenizers.PATTERN)
WORDS = st.sampled_from(["the ", "tion", " ", "\n", "   ", "'", "'s", "re", "l", "42 ", "!!", "é", "日本", "\t", "a b c "])
EDIT = st.tuples(st.integers(0, 900), st.integers(0, 40), st.lists(WORDS, max_size=8).map("".join))


def check(text, edits):
    tree = tt.Tree(tt.leaf_sums(CODEC, CODEC.split(text)))
    for start, removed, inserted in edits:
        start = min(start, len(text))
        want = text[:start] + inserted + text[start + removed:]
        text, tree, _ = tt.edit(CODEC, text, tree, start, removed, inserted)
        assert text == want
        pieces = CODEC.split(text)
        assert tree.sums[:, 1].tolist() == [len(text), len(pieces), len(CODEC.encode(text))]
        leaves = tree.sums[:, tree.width:]
        at = 0
        starts = {0}
        for p in pieces:
            at += len(p)
            starts.add(at)
        assert set(leaves[0].cumsum().tolist()) <= starts
        for i in range(1, tree.width):
            assert (tree.sums[:, i] == tree.sums[:, 2 * i] + tree.sums[:, 2 * i + 1]).all()


@settings(max_examples=300, deadline=None)
@given(st.lists(WORDS, max_size=300).map("".join), st.lists(EDIT, max_size=6))
def test_edits_equal_counting_anew(text, edits):
    leaf, tt.LEAF = tt.LEAF, 4
    try:
        check(text, edits)
    finally:
        tt.LEAF = leaf


def test_only_touched_regions_are_encoded():
    text = "the quick brown fox jumps over it. " * 4000
    tree = tt.Tree(tt.leaf_sums(CODEC, CODEC.split(text)))
    _, _, work = tt.edit(CODEC, text, tree, 70_000, 5, "some new words")
    assert 0 < work <= 6 * tt.LEAF


def test_documents_with_nulls_ties_and_clashing_names(spark):
    rows = [(1, "The cat's hat", 3, [(4, 3, "dog")]), (2, None, 3, [(0, 5, "new words")]), (3, "", 3, None),
            (None, "x " * 9000, 3, [(17, 2, "\n\n"), None, (10**6, 4, "end")]), (1, "The cat's hat", 3, []),
            (4, "abc", 3, [(None, None, None)])]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, tree int, edits {tt.EDITS}")
    got = tt.apply_edits(tt.build_trees(docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    texts = sorted((r.doc_id or 0, r.text, r.n_tokens) for r in got.collect())
    want = [(1, "The dog's hat"), (2, "new words"), (3, ""), (0, ("x " * 9000)[:17] + "\n\n" + ("x " * 9000)[19:] + "end"),
            (1, "The cat's hat"), (4, "abc")]
    assert texts == sorted((i, t, len(CODEC.encode(t))) for i, t in want)
    assert tt.apply_edits(tt.build_trees(docs.where(F.lit(False)), PATH, public_tokenizers.PATTERN),
                          PATH, public_tokenizers.PATTERN).count() == 0
