"""Masked pseudo-likelihood scores from a bidirectional window network.

Every token is predicted from the ``SIDE`` tokens before and after it: their
embeddings, laid side by side, go through one tanh layer to a two-level softmax
(class of the token, then token within the class). A document's score is the
sum of its tokens' conditional log-probabilities.

The vocabulary is every word of all documents, with its count, and grows with
them. The network predicts one of a fixed number of ids: the most frequent words
have their own, rarer words share some. The probability of a word among those of
its id comes from the counts, by a join.

Training reads every position of every document, dealt in pieces to trainers:
each runs Adagrad in numpy over its positions, one residue of their places per
round until all are covered, and the parameters are averaged, weighted by
positions, after every round. What is gathered grows with the corpus; parameters
alone reach the driver.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache
from itertools import groupby, pairwise, repeat
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch_rows, map_texts, staged

#: Token ids: CLASSES x MEMBERS, the last HASHED of them shared by rarer words.
CLASSES, MEMBERS, HASHED = 32, 64, 256
VOCAB = CLASSES * MEMBERS
#: Tokens on each side, numbers per embedding, hidden units.
SIDE, EMBED, HIDDEN = 2, 8, 16
#: Every STRIDE-th position trains in a round, another residue in the next; positions
#: per trainer and round (about), rounds of averaging (STRIDE at least), positions of
#: an Adagrad step and its rate.
STRIDE, TRAINER_POSITIONS, ROUNDS, STEP, RATE = 2, 1 << 21, 2, 2048, 0.1
#: Positions of a document that go to a trainer together.
PIECE = 512
#: Distinct words that a counting task holds before it passes its counts on.
HELD_WORDS = 200_000
#: Rarer words, the most frequent ones, that every task knows with their probabilities.
KNOWN = 1 << 16
#: Positions that are scored together.
SCORED = 4096

#: log p(word | id) is summed in steps of 1 / SHARE: the same sum in any order.
SHARE = 1 << 30

WORD, OTHER = r"\w+", r"[^\w\s]+"
TOKEN = re.compile(f"{WORD}|{OTHER}")


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


@lru_cache
def char_kinds() -> np.ndarray:
    """By code point: 1 in WORD, 2 in OTHER, 0 in neither."""
    every, kinds = "".join(map(chr, range(0x110000))), np.zeros(0x110000, np.uint8)
    for kind, pattern in ((1, WORD), (2, OTHER)):
        for run in re.finditer(pattern, every):
            kinds[run.start():run.end()] = kind
    return kinds


def cut(texts: list[str | None], kinds: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """The ``tokens`` of all texts, one behind the other, and how many each text has.
    A token is a run of characters of one kind: found by array, with no object per token."""
    lower = [(t or "").lower() for t in texts]
    joined = "\n".join(lower)  # of neither kind
    data = np.frombuffer(joined.encode(), np.uint8)
    if joined.isascii():
        ends, kind = np.cumsum([len(t) + 1 for t in lower], dtype=np.int64), kinds[data]
    else:
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        wide = 1 + (points >= 0x80).view(np.int8) + (points >= 0x800) + (points >= 0x10000)  # bytes of each
        ends, kind = np.cumsum([len(t.encode()) + 1 for t in lower], dtype=np.int64), np.repeat(kinds[points], wide)
    none = np.uint8(0)
    edge = np.flatnonzero(np.diff(kind, prepend=none, append=none))  # a run of one kind lies from edge to edge
    inside = kind[edge[:-1]] > 0
    begin, size = edge[:-1][inside], np.diff(edge)[inside]
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    found = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(data[kind > 0]))
    return found, np.diff(np.searchsorted(begin, ends), prepend=0)


class Words(dict):
    """Word -> id. Frequent words have their own (0 is the most frequent);
    others share HASHED ids by crc32."""

    def __missing__(self, word: str) -> int:
        return VOCAB - HASHED + zlib.crc32(word.encode("utf-8", "surrogatepass")) % HASHED


class Shares(NamedTuple):
    """Rarer words that have a place behind the ids, and by place their id and the
    ``share`` of ``with_shares``."""
    places: dict
    ids: np.ndarray
    shares: np.ndarray


def no_shares() -> Shares:
    return Shares({}, np.zeros(0, np.int64), np.zeros(0, np.int64))


def coded(found: pa.StringArray, words: dict, known: Shares) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By word of ``found``: its id by ``words``, the share of a known one (0 of others),
    and whether it shares its id without being known. ``words`` holds the places of
    ``known`` too."""
    spelled = found.to_numpy(zero_copy_only=False)
    ids = np.fromiter(map(words.get, spelled, repeat(-1)), np.int64, len(found))
    shared, at = ids < 0, ids >= VOCAB
    place, shares = ids[at] - VOCAB, np.zeros(len(found), np.int64)
    ids[at], shares[at] = known.ids[place], known.shares[place]
    hashes = np.fromiter(map(zlib.crc32, map(str.encode, spelled[shared])), np.int64, int(shared.sum()))
    ids[shared] = VOCAB - HASHED + hashes % HASHED
    return ids, shares, shared


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all documents."""

    sent = docs.sparkSession.sparkContext.broadcast(char_kinds())

    def merged(parts):
        return pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def run(batches):
        held, rows = [], 0
        for part in batch_rows(batches):
            found = cut(part.column("text").to_pylist(), sent.value)[0].value_counts()
            held.append(pa.Table.from_arrays([found.field("values"), found.field("counts")], ["word", "n"]))
            rows += len(found)
            if rows > 2 * HELD_WORDS:
                held = [merged(held)]
                if len(held[0]) > HELD_WORDS:
                    yield from held.pop().to_batches()
                rows = sum(map(len, held))
        if held:
            yield from merged(held).to_batches()

    return (map_texts(docs.select(F.col(text_col).cast("string").alias("text")), run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def id_totals(rare: DataFrame) -> DataFrame:
    """(id, total, kinds): tokens plus distinct words, and distinct words, of each
    shared id; at most HASHED rows."""
    return rare.groupBy("id").agg((F.sum("n") + F.count(F.lit(1))).alias("total"), F.count(F.lit(1)).alias("kinds"))


def rare_words(counts: DataFrame, words: Words) -> DataFrame:
    """(word, n, id): the counted words without an id of their own, every one."""
    own = counts.sparkSession.createDataFrame([(w,) for w in words], "word string")  # at most VOCAB words
    return counts.join(F.broadcast(own), "word", "left_anti").select("word", "n", shared_id().alias("id"))


def shared_id():
    return F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(HASHED))


def with_shares(rows: DataFrame, counts: DataFrame, words: Words) -> DataFrame:
    """``rows`` (word, ...) plus share: log p(word | id) in steps of 1 / SHARE. Of an
    id's n tokens and t distinct words, t / (n + t) is left to words that were never
    counted (Witten and Bell), which are spelled in bytes of equal probability."""
    rare = rare_words(counts, words)
    total = F.broadcast(id_totals(rare))
    known = rare.join(total, "id").select("word", counted().alias("log"))
    spelled = -(F.octet_length("word") + 1) * F.lit(float(np.log(257)))
    left = F.coalesce(F.log(F.col("kinds") / F.col("total")), F.lit(0.0))
    # hashed, not sorted: a task holds its part of the rarer words, not the rows
    return (rows.join(known.hint("shuffle_hash"), "word", "left").withColumn("id", shared_id()).join(total, "id", "left")
            .withColumn("share", in_steps(F.coalesce("log", left + spelled)))
            .drop("id", "log", "total", "kinds"))


def counted():
    """log p(word | id) of a counted word."""
    return F.log(F.col("n") / F.col("total"))


def in_steps(log):
    return F.round(log * SHARE).cast("long")


def known_shares(counts: DataFrame, words: Words, most: int | None = None) -> Shares:
    """The shares, as ``with_shares`` has them, of the rarer words that occur most: at
    most ``most`` (KNOWN if not given), all down to one count. They and a short
    histogram of the counts reach the driver."""
    rare, most = rare_words(counts, words), KNOWN if most is None else most
    # sixteen steps of counts from one power of two to the next
    rare = rare.withColumn("level", F.floor(F.log2("n") * 16))
    least, upto = None, 0
    for r in rare.groupBy("level").agg(F.count(F.lit(1)).alias("kinds")).orderBy(F.desc("level")).collect():
        upto += r["kinds"]
        if upto > most:
            break
        least = r["level"]
    if least is None:
        return no_shares()
    rows = (rare.where(F.col("level") >= least).join(F.broadcast(id_totals(rare)), "id")
            .select("word", (VOCAB - HASHED + F.col("id")).cast("long").alias("id"), in_steps(counted()).alias("share")).toArrow())
    places = {w: VOCAB + i for i, w in enumerate(rows["word"].to_pylist())}
    return Shares(places, rows["id"].to_numpy(), rows["share"].to_numpy())


def contexts(ids: np.ndarray) -> np.ndarray:
    """(n, 2 SIDE): the ids around each position; VOCAB beyond the text's ends."""
    n = len(ids)
    wide, out = np.full(n + 2 * SIDE, VOCAB, np.int64), np.empty((n, 2 * SIDE), np.int64)
    wide[SIDE:SIDE + n] = ids
    for column, k in enumerate((*range(SIDE), *range(SIDE + 1, 2 * SIDE + 1))):
        out[:, column] = wide[k:k + n]
    return out


class Network:
    """Parameters as one flat float32 vector with named views."""

    SHAPES = {"embed": (VOCAB + 1, EMBED), "hidden": (2 * SIDE * EMBED, HIDDEN), "hidden_0": (HIDDEN,),
              "cls": (HIDDEN, CLASSES), "cls_0": (CLASSES,), "own": (CLASSES, HIDDEN, MEMBERS), "own_0": (CLASSES, MEMBERS)}

    def __init__(self, flat: np.ndarray | None = None):
        size = sum(int(np.prod(s)) for s in self.SHAPES.values())
        self.flat = np.zeros(size, dtype=np.float32) if flat is None else flat
        self.working, self.slope = {}, None
        at = 0
        for name, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            setattr(self, name, self.flat[at:at + n].reshape(shape))
            at += n

    @classmethod
    def fresh(cls, seed: int = 17) -> Network:
        net, rng = cls(), np.random.default_rng(seed)
        net.embed[:] = rng.normal(0, 0.5, net.embed.shape)
        net.hidden[:] = rng.normal(0, 1 / np.sqrt(2 * SIDE * EMBED), net.hidden.shape)
        return net

    def held(self, name: str, *shape: int) -> np.ndarray:
        """Working memory that is kept from step to step, with any content."""
        size = int(np.prod(shape))
        if name not in self.working or self.working[name].size < size:
            self.working[name] = np.empty(size, self.flat.dtype)
        return self.working[name][:size].reshape(shape)

    def forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x (n, 2 SIDE EMBED), and h with a row of ones beneath (HIDDEN + 1, n)."""
        n = len(context)
        x = self.held("x", context.size, EMBED)
        np.take(self.embed, context.ravel(), axis=0, out=x, mode="clip")
        x, h = x.reshape(n, -1), self.held("h", HIDDEN + 1, n)
        np.matmul(self.hidden.T, x.T, out=h[:HIDDEN])
        h[:HIDDEN] += self.hidden_0[:, None]
        np.tanh(h[:HIDDEN], out=h[:HIDDEN])
        h[HIDDEN] = 1
        return x, h

    def class_logits(self, h: np.ndarray) -> np.ndarray:
        z = np.matmul(self.cls.T, h[:HIDDEN], out=self.held("z_cls", CLASSES, h.shape[1]))
        z += self.cls_0[:, None]
        return z

    def member_logits(self, h: np.ndarray, cuts: list[int]) -> np.ndarray:
        """(MEMBERS, n): positions lie by class, from cut to cut."""
        own = self.held("own", CLASSES, HIDDEN + 1, MEMBERS)
        own[:, :HIDDEN], own[:, HIDDEN] = self.own, self.own_0
        z = self.held("z_own", MEMBERS, h.shape[1])
        for k, (a, b) in enumerate(pairwise(cuts)):
            if a < b:
                np.matmul(own[k].T, h[:, a:b], out=z[:, a:b])
        return z

    def log_probs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of each target given its context."""
        group, member = np.divmod(target, MEMBERS)
        order, cuts = by_class(group)
        _, h = self.forward(context[order])
        out = np.empty(len(target), self.flat.dtype)
        out[order] = (softmax(self.class_logits(h), group[order])[0]
                      + softmax(self.member_logits(h, cuts), member[order])[0])
        return out

    def gradient(self, context: np.ndarray, target: np.ndarray) -> tuple[float, Network]:
        """Mean loss (negative log-probability) and its gradient, which the next call overwrites."""
        n = len(target)
        group, member = np.divmod(target, MEMBERS)
        order, cuts = by_class(group)  # positions lie by class from here on
        context = np.take(context, order, axis=0)
        x, h = self.forward(context)
        if self.slope is None:
            self.slope = Network(np.zeros_like(self.flat))
        g = self.slope
        d, loss = softmax_step(self.class_logits(h), group[order], n)
        np.matmul(h[:HIDDEN], d.T, out=g.cls)
        d.sum(axis=1, out=g.cls_0)
        dh = np.matmul(self.cls, d, out=self.held("dh", HIDDEN, n))
        d, part = softmax_step(self.member_logits(h, cuts), member[order], n)
        own, back = self.held("own", CLASSES, HIDDEN + 1, MEMBERS), self.held("back", HIDDEN, n)
        for k, (a, b) in enumerate(pairwise(cuts)):
            if a < b:
                mine = d[:, a:b]
                np.matmul(h[:, a:b], mine.T, out=own[k])
                np.matmul(self.own[k], mine, out=back[:, a:b])
            else:
                own[k] = 0
        g.own[:], g.own_0[:] = own[:, :HIDDEN], own[:, HIDDEN]
        dh += back
        h = h[:HIDDEN]
        np.multiply(h, h, out=back)
        np.subtract(1, back, out=back)
        dh *= back
        np.matmul(x.T, dh.T, out=g.hidden)
        dh.sum(axis=1, out=g.hidden_0)
        dx = np.matmul(self.hidden, dh, out=self.held("dx", 2 * SIDE * EMBED, n)).reshape(2 * SIDE, EMBED, n)
        flat = context.T.ravel()
        for j in range(EMBED):
            g.embed[:, j] = np.bincount(flat, weights=dx[:, j].ravel(), minlength=VOCAB + 1)
        return loss + part, g


def softmax(z: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By column of ``z``: the log-probability of the target's row, and the sum of the
    exponentials (less the largest), by which ``z`` is overwritten."""
    z -= z.max(axis=0)
    hit = z.ravel()[places(z, target)]
    np.exp(z, out=z)
    total = z.sum(axis=0)
    return hit - np.log(total), total


def softmax_step(z: np.ndarray, target: np.ndarray, n: int) -> tuple[np.ndarray, float]:
    """The slope of the mean loss by ``z``, written over it, and the loss."""
    log, total = softmax(z, target)
    z *= 1 / (total * z.dtype.type(n))
    z.reshape(-1)[places(z, target)] -= z.dtype.type(1 / n)
    return z, -float(log.sum()) / n


def places(z: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Where each column's target lies in ``z`` read row by row."""
    n = z.shape[1]
    return target * n + np.arange(n)


def by_class(group: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The order of positions by class, and where each class begins and the last ends."""
    order = np.argsort(group.astype(np.uint8), kind="stable")
    return order, [0, *np.cumsum(np.bincount(group, minlength=CLASSES)).tolist()]


def train(net: Network, pieces) -> int:
    """Adagrad over (n, 2 SIDE + 1) arrays of contexts and targets, in order."""
    seen, squares, rest, width = 0, np.full_like(net.flat, 1e-6), [], 0
    move = np.empty_like(net.flat)

    def step(rows):
        _, g = net.gradient(rows[:, :-1], rows[:, -1])
        np.multiply(g.flat, g.flat, out=move)
        np.add(squares, move, out=squares)
        np.sqrt(squares, out=move)
        np.divide(g.flat, move, out=move)
        np.multiply(move, np.float32(RATE), out=move)
        np.subtract(net.flat, move, out=net.flat)
        return len(rows)

    for piece in pieces:
        rest.append(piece)
        width += len(piece)
        if width >= STEP:
            rows = np.concatenate(rest)
            for at in range(0, width - width % STEP, STEP):
                seen += step(rows[at:at + STEP])
            rest, width = [rows[width - width % STEP:]], width % STEP
    if width:
        seen += step(np.concatenate(rest))
    return seen


def encode(docs: DataFrame, words: Words, id_col: str = "doc_id", text_col: str = "text",
           known: Shares | None = None) -> DataFrame:
    """(doc_id, ids, rare, times, add), one row per input row: the tokens' ids in 16 bits,
    the words without an id of their own with how often they occur, and the shares of
    those that are ``known`` and not listed, in one sum."""
    known = no_shares() if known is None else known
    # at most VOCAB + KNOWN words
    sent = docs.sparkSession.sparkContext.broadcast((dict(words) | known.places, known._replace(places={}), char_kinds()))

    def run(batches):
        words, known, kinds = sent.value
        for part in batch_rows(batches):
            found, size = cut(part.column("text").to_pylist(), kinds)
            found = found.dictionary_encode()  # each word is looked up once
            at, spelled = found.indices.to_numpy(), found.dictionary
            ids, shares, shared = coded(spelled, words, known)
            ends = np.concatenate([[0], np.cumsum(size)])
            packed = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer((2 * ends).astype(np.int32)),
                                                                    pa.py_buffer(ids.astype("<u2")[at])])
            adds = np.diff(np.concatenate([[0], np.cumsum(shares[at])])[ends])
            listed = shared[at]
            text = np.repeat(np.arange(len(size)), size)[listed]
            pairs, times = np.unique(text * max(1, len(spelled)) + at[listed], return_counts=True)
            text, word = np.divmod(pairs, max(1, len(spelled)))
            cuts = pa.array(np.searchsorted(text, np.arange(len(size) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), packed, pa.ListArray.from_arrays(cuts, spelled.take(pa.array(word))),
                 pa.ListArray.from_arrays(cuts, pa.array(times, pa.int64())), pa.array(adds, pa.int64())],
                ["doc_id", "ids", "rare", "times", "add"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, run, f"doc_id {kind}, ids binary, rare array<string>, times array<long>, add long")


def staged_codes(docs: DataFrame, words: Words, id_col: str = "doc_id", text_col: str = "text",
                 counts: DataFrame | None = None) -> DataFrame:
    """``encode`` with a number for each row, written once for training and scoring.
    ``counts``: the word_counts by which the codes will be scored, so that the frequent
    of the rarer words are summed here and only the others are joined."""
    known = None if counts is None else known_shares(counts, words)
    return staged(encode(docs, words, id_col, text_col, known).withColumn("row", F.monotonically_increasing_id()), "lm_codes")


def positions(docs: DataFrame, words: Words, id_col: str = "doc_id", text_col: str = "text",
              codes: DataFrame | None = None) -> DataFrame:
    """(key, n, ids): every document in pieces of at most PIECE positions, packed as
    16-bit ids with the SIDE ids on either side. The key hashes id and piece, so
    that copies of one text do not meet in one trainer. ``codes``: the documents'
    encode, where it is at hand."""

    def run(batches):
        for part in batch_rows(batches):
            keys, sizes, packed = [], [], []
            for doc, ids in zip(part.column("doc").to_pylist(), part.column("ids").to_pylist()):
                found = np.frombuffer(ids, dtype="<u2")
                wide = np.full(len(found) + 2 * SIDE, VOCAB, dtype="<u2")
                wide[SIDE:SIDE + len(found)] = found
                for at in range(0, len(found), PIECE):
                    piece = wide[at:at + PIECE + 2 * SIDE].tobytes()
                    keys.append(doc ^ zlib.crc32(piece))
                    sizes.append(min(PIECE, len(found) - at))
                    packed.append(piece)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
                                              pa.array(packed, pa.binary())], ["key", "n", "ids"])

    codes = encode(docs, words, id_col, text_col) if codes is None else codes
    return map_texts(codes.select(F.xxhash64("doc_id").alias("doc"), "ids"), run, "key long, n long, ids binary")


def targets(piece: bytes, residue: int) -> np.ndarray:
    """(n, 2 SIDE + 1): contexts and target of the piece's positions that are
    ``residue`` modulo STRIDE."""
    wide = np.frombuffer(piece, dtype="<u2")
    n = len(wide) - 2 * SIDE
    out = np.empty((len(range(residue, n, STRIDE)), 2 * SIDE + 1), np.int64)
    for column, k in enumerate((*range(SIDE), *range(SIDE + 1, 2 * SIDE + 1), SIDE)):
        out[:, column] = wide[residue + k:n + k:STRIDE]
    return out


def _averaged(spark, parts: DataFrame) -> np.ndarray | None:
    """The mean of (weight, flat) rows, summed in two levels; None of no rows."""

    def add(batches):
        total, weight = None, 0
        for batch in batches:
            for w, f in zip(batch.column("weight").to_pylist(), batch.column("flat").to_pylist()):
                x = np.frombuffer(f, dtype=np.float64)
                total, weight = (x.copy() if total is None else total + x), weight + w
        if weight:
            yield pa.RecordBatch.from_arrays([pa.array([weight], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                                             ["weight", "flat"])

    # a fixed order of summing: the same parameters on every run
    part = parts.repartition(16, F.col("trainer") % 16).sortWithinPartitions("trainer")
    part = part.select("weight", "flat").mapInArrow(add, "weight long, flat binary")
    rows = sorted(part.collect(), key=lambda r: (r["weight"], r["flat"]))  # at most 16 rows
    if not rows:
        return None
    return sum(np.frombuffer(r["flat"], dtype=np.float64) for r in rows) / sum(r["weight"] for r in rows)


def own_words(counts: DataFrame) -> Words:
    """The most frequent words of ``word_counts``, which have ids of their own."""
    top = counts.orderBy(F.desc("n"), "word").limit(VOCAB - HASHED).collect()
    return Words({r["word"]: i for i, r in enumerate(top)})


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: DataFrame | None = None,
        codes: DataFrame | None = None) -> tuple[Words, Network]:
    """The words with their own id and trained network of a corpus; an empty corpus,
    or one without tokens, gives the untrained network. ``counts``: its word_counts,
    ``codes``: its staged_codes by their own_words, where they are at hand. The same corpus gives
    the same network on any layout: a trainer's pieces lie in one file, in a fixed order,
    and every trainer starts a round from the averaged network, whichever task reads it."""
    spark = docs.sparkSession
    counts = word_counts(docs, text_col) if counts is None else counts
    words = own_words(counts)
    n = counts.agg(F.sum("n").alias("n")).first()["n"] or 0  # every token is a position
    net = Network.fresh()
    trainers = max(1, -(-n // (STRIDE * TRAINER_POSITIONS)))
    # dealt once, a partition and so a file for each trainer, which every round reads back
    dealt = (positions(docs, words, id_col, text_col, codes)
             .select(F.pmod(F.xxhash64("key"), F.lit(trainers)).cast("int").alias("trainer"), "key", "ids")
             .repartitionById(trainers, "trainer").sortWithinPartitions("trainer", F.xxhash64("key"), "ids"))
    dealt = staged(dealt.select("trainer", "ids"), "lm_dealt") if n else None
    for k in range(max(ROUNDS, STRIDE) if n else 0):
        sent = spark.sparkContext.broadcast(net.flat.copy())

        def run(batches, sent=sent, residue=k % STRIDE):
            rows = ((t, r) for part in batches for t, r in zip(part.column("trainer").to_pylist(), part.column("ids").to_pylist()))
            for trainer, mine in groupby(rows, key=itemgetter(0)):  # each with a network of its own
                own = Network(sent.value.copy())
                seen = train(own, (targets(r, residue) for _, r in mine))
                if seen:
                    flat = (own.flat.astype(np.float64) * seen).tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([trainer], pa.int64()), pa.array([seen], pa.int64()), pa.array([flat], pa.binary())],
                        ["trainer", "weight", "flat"])

        mean = _averaged(spark, dealt.mapInArrow(run, "trainer long, weight long, flat binary"))
        net = net if mean is None else Network(mean.astype(np.float32))
    return words, net


def score(docs: DataFrame, words: Words, net: Network, id_col: str = "doc_id", text_col: str = "text",
          counts: DataFrame | None = None, codes: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_tokens, pll, mean_pll), one row per input row.

    ``pll``: the sum over all tokens of log p(token | both sides); ``mean_pll``:
    per token. ``counts``: the word_counts of the fitted corpus; without them a word
    that shares its id counts with the probability of the id. ``codes``: the documents'
    staged_codes by ``words``, where they are at hand. Null and empty texts have no token, pll 0
    and a null mean. Ids may be null or repeat; equal texts score alike; other columns
    are not read; empty in, empty out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net.flat)
    if codes is None:
        codes = (staged_codes(docs, words, id_col, text_col, counts) if counts is not None  # read again for the rarer words
                 else encode(docs, words, id_col, text_col).withColumn("row", F.lit(0).cast("long")))

    def run(batches):
        net = Network(sent.value)
        for part in batch_rows(batches, 64):
            ids = [np.frombuffer(x, dtype="<u2") for x in part.column("ids").to_pylist()]
            context = np.concatenate([contexts(x) for x in ids])
            target = np.concatenate(ids).astype(np.int64)
            logs = np.concatenate([np.zeros(0, np.float32)] + [
                net.log_probs(context[at:at + SCORED], target[at:at + SCORED]) for at in range(0, len(target), SCORED)])
            size = np.array([len(x) for x in ids])
            total = np.concatenate([[0.0], np.cumsum(logs, dtype=np.float64)])
            end = np.cumsum(size)
            pll = total[end] - total[end - size]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), pa.array(size, pa.int64()), pa.array(pll, pa.float64()),
                 part.column("add")], ["row", "doc_id", "n_tokens", "pll", "known"])

    found = map_texts(codes.select("row", "doc_id", "ids", "add"), run,
                      f"row long, doc_id {codes.schema['doc_id'].dataType.simpleString()}, n_tokens long, pll double, known long")
    if counts is not None:
        sharing = (codes.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
                   .select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times")))
        add = (with_shares(sharing, counts, words).groupBy("row")
               .agg(F.sum(F.col("times") * F.col("share")).alias("add")))
        found = (found.join(add, "row", "left")
                 .withColumn("pll", F.col("pll") + (F.col("known") + F.coalesce("add", F.lit(0))) / SHARE))
    mean = F.when(F.col("n_tokens") > 0, F.col("pll") / F.col("n_tokens"))
    return found.select("doc_id", "n_tokens", "pll", mean.alias("mean_pll"))
