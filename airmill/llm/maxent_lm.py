"""Language-model scores: a hashed maximum-entropy model with n-gram and skip features and a class-factored softmax.

log P(word | history) = log P(class | history) + log P(seen | class) + log P(slot | class, history) + log P(word | slot).

* Classes: the ``TOP`` commonest words are units of their own, all other words share units by a hash of their ending and length. Units
  with like neighbours are clustered into ``CLASSES`` classes; class 0 is the end of a text alone.
* The units of a class share its ``CLASSES`` slots: the ``OWN`` commonest have one each.
* The history is the three last tokens, as symbols (a common word, or a class) and as the words themselves (``NAMES`` hashed names, common
  or rare). Both have n-grams and skips as features: seven of symbols (all sets of the three), five of words (skips of one word each).
* The symbols come first: a maximum-entropy model of P(class | symbols), whose features are hashed into ``BUCKETS`` rows of weights, one per
  class. Training adds, in ``ROUNDS`` rounds, to every weight the scaled
  logarithm of observed over expected counts (generalised iterative scaling, as every history has the same number of features), less a
  pull to zero that is the stronger the rarer the feature. Tasks compute the expectations of their share of the histories, and their sums are added up; no training token is left out.
* The words come on top: each softmax over 32 classes, or over the 32 slots of a class, is five two-way softmaxes down a tree of its halves.
  Each choice is a maximum-entropy model whose reference is the symbols' (for slots: the counts') share of its halves, with hashed features
  of the words for every choice, ``WORD_BUCKETS`` rows of weights for each feature. ``WORD_ROUNDS`` rounds of the same scaling read every training token.
* P(word | slot) has word features only, whose maximum-entropy solution is the relative count; an absolute discount, estimated from the
  words seen once and twice, goes to the class's words that were never seen, taken as one event, which has no slot.

A first pass numbers the words of blocks of about ``BLOCK`` distinct words, ``TOKENS`` tokens at most, and writes texts as these numbers;
counts are summed by word, joined back to the blocks' words, and met with the texts of the block in one sorted stream. So a hot word costs a
row per block, and a task holds the words of one block. Texts are cut into segments of ``SEGMENT`` tokens, each with the three tokens before it. Weights, clusters and the
driver's tables have a fixed size; the distinct histories are at most ``SYMBOLS`` cubed, and a task hands on their counts every ``EVENTS`` tokens or so. Tasks write tables in
batches of ``ROWS`` rows at most, and units and names as plain bytes, which pass through Spark as they are.

The base score is the sum of log10((c + 1) / (N + V + 1)) with c a token's count, N all and V the distinct training tokens.

Cases: null and empty texts are the end token alone. Every row is a text of its own, also a repeated one; a null id is a training text in
``held_out`` by default. With no training text both scores are the base score. Equal counts are ranked by the word. Empty tables give an empty
result. Only the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airmill.llm import words
from airmill.session import discard, stored

TOP, GROUPS, CLASSES, BUCKETS = 63, 2048, 32, 1 << 13
UNITS, SYMBOLS, NEAR = 1 + TOP + GROUPS, 1 + TOP + CLASSES, 128
ROUNDS, PRIOR, SHRINK = 6, 10.0, 300.0
NAMES, WORD_BUCKETS, WORD_ROUNDS, DEPTH, OWN = 1 << 16, 1 << 12, 2, 5, 16
SHARE, PIECE = 1 << 23, 1 << 15  # training tokens of a task that adds up choices, tokens worked on at once
ROWS, EVENTS = 1 << 16, 1 << 21  # rows of a batch that a task gives out, at most; tokens whose events a task counts at once
BLOCK, TOKENS, SEGMENT, HISTORY = 1 << 19, 1 << 23, 1 << 17, 3
END = b"\n"
FEATURES, WORD_FEATURES = 7, 5


def unit(word: bytes) -> int:
    """Unit of a word that is not among the commonest."""
    return 0 if word == END else 1 + TOP + zlib.crc32(word[-3:] + (b"L" if len(word) > 6 else b"S")) % GROUPS


# ---- texts as numbers, counts, and both together


def _tokens(text: str | None) -> Iterator[list[bytes]]:
    yield from words.pieces((text or "").encode())
    yield [END]


def _segments(text: str | None, size: int) -> Iterator[list[bytes]]:
    """Segments of a text's tokens, each after the three tokens before it; a text begins after three ends."""
    held = [END] * HISTORY
    for part in _tokens(text):
        held += part
        while len(held) >= size + HISTORY:
            yield held[: size + HISTORY]
            held = held[size:]
    if len(held) > HISTORY:
        yield held


def packed(codes: np.ndarray) -> bytes:
    """Numbers by their lowest bytes, then their second ones and so on, compressed: about half of a list's size."""
    return zlib.compress(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, n).T).view("<u4").ravel().astype(np.int32)


NUMBERED = "block long, kind int, code int, word binary, unit int, n long, row long, id long, held boolean, codes binary"


def numbered(docs: DataFrame, block: int = BLOCK, segment: int = SEGMENT) -> DataFrame:
    """Of (id, held, text): rows of kind 0 (a block's words with their training counts) and of kind 1 (a segment as the block's numbers)."""

    def words_of(key: int, number: dict[bytes, int], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        left = iter(number)
        for lo in range(0, len(number), ROWS):
            found = list(islice(left, ROWS))
            columns = {"code": pa.array(np.arange(lo, lo + len(found), dtype=np.int32)), "word": pa.array(found, pa.binary()), "unit": pa.array([unit(w) for w in found], pa.int32())}
            yield _batch(len(found), key, 0, columns | {"n": pa.array(counts[lo : lo + len(found)], pa.int64())})

    def segments(key: int, rows: list[tuple]) -> pa.RecordBatch:
        row, ids, held, codes = zip(*rows, strict=True)
        columns = {"n": pa.array([len(x) for x in codes], pa.int64()), "row": pa.array(row, pa.int64()), "id": pa.array(ids, pa.int64()), "held": pa.array(held, pa.bool_())}
        return _batch(len(rows), key, 1, columns | {"codes": pa.array([packed(x) for x in codes], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = min(TOKENS, 16 * block)
        key = TaskContext.get().partitionId() << 33
        row, number, counts, size, ready, waiting = key - 1, {}, np.zeros(1 << 10, np.int64), 0, [], 0
        for b in batches:
            for i, held, text in zip(*[b.column(k) for k in range(3)], strict=True):
                row, i, held = row + 1, i.as_py(), held.as_py()
                for part in _segments(text.as_py(), segment):
                    codes = np.array([number.setdefault(w, len(number)) for w in part], np.int32)
                    if len(counts) < len(number):
                        counts = np.concatenate([counts, np.zeros(max(len(counts), len(number)), np.int64)])
                    if not held:
                        np.add.at(counts, codes[HISTORY:], 1)
                    ready.append((row, i, held, codes))
                    waiting, size = waiting + len(codes), size + len(codes)
                    full = len(number) >= block or size >= tokens
                    if waiting >= 1 << 16 or full:
                        yield segments(key, ready)
                        ready, waiting = [], 0
                    if full:
                        yield from words_of(key, number, counts)
                        key, number, counts, size = key + 1, {}, np.zeros(1 << 10, np.int64), 0
        if ready:
            yield segments(key, ready)
        if number:
            yield from words_of(key, number, counts)
        number.clear()
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks and would keep it

    return docs.select("id", "held", "text").mapInArrow(run, NUMBERED)


_TYPES = {"block": pa.int64(), "kind": pa.int32(), "code": pa.int32(), "word": pa.binary(), "unit": pa.int32(), "n": pa.int64(), "row": pa.int64(), "id": pa.int64(), "held": pa.bool_(), "codes": pa.binary()}


def _batch(rows: int, block: int, kind: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    columns = {"block": pa.array(np.full(rows, block)), "kind": pa.array(np.full(rows, kind, np.int32))} | columns
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(rows, t)) for c, t in _TYPES.items()], names=list(_TYPES))


def cuts(sizes: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``most`` tokens together."""
    total = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


def _pieces(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the codes in ``column`` hold a bounded number of tokens."""
    for b in batches:
        for lo, hi in cuts(pc.binary_length(b.column(column)).to_numpy() // 4):
            yield b.slice(lo, hi - lo)


def joined(units: np.ndarray, names: np.ndarray, offsets: np.ndarray) -> pa.BinaryArray:
    """Segments as bytes: unit and name of each token, two bytes each."""
    pairs = np.stack([units.astype("<u2"), names.astype("<u2")], 1)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(pairs)])


def split(codes: pa.Array) -> tuple[pa.ListArray, pa.ListArray]:
    """Units and names of ``joined`` segments."""
    raw = codes.cast(pa.binary())
    offsets = np.concatenate([[0], np.cumsum(pc.binary_length(raw).to_numpy())]) // 4
    start = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset]
    pairs = np.frombuffer(raw.buffers()[2], "<i2", 2 * offsets[-1], start).reshape(-1, 2)
    units, names = (pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.ascontiguousarray(x))) for x in pairs.T)
    return units, names


MET = "row long, id long, held boolean, n_tokens long, n_known long, base double, known double, codes binary"


def _met(total: int, distinct: int, discount: float):
    """Stream of a block's words (code, n, unit and name) and then its segments -> figures of the segments, their units (-1 - unit if never seen) and names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, table = None, [], None
        for b in batches:
            key, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
            turns = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (kind[1:] != kind[:-1])])) if len(key) else np.zeros(0, int)
            for lo, hi in zip(turns, [*turns[1:], len(key)], strict=True):
                if key[lo] != now:
                    now, parts, table = key[lo], [], None
                if kind[lo] == 0:
                    parts.append([b.column(k).slice(lo, hi - lo).to_numpy() for k in (2, 3, 4)])
                    continue
                if table is None:
                    code, n, at = (np.concatenate(x) for x in zip(*parts, strict=True))
                    table = np.zeros(len(code), np.int64), np.zeros(len(code), np.int16), np.zeros(len(code), np.uint16)
                    table[0][code], table[1][code], table[2][code] = n, at // NAMES, at % NAMES
                for first, last in cuts(b.column(3).slice(lo, hi - lo).to_numpy()):
                    yield figures(b.slice(lo + first, last - first), table)

    def figures(b: pa.RecordBatch, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        sizes, rows = b.column(3).to_pylist(), b.num_rows
        flat = np.concatenate([unpacked(x.as_py(), n) for x, n in zip(b.column(8), sizes, strict=True)])
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        seen, at = table[0][flat], table[1][flat]
        valid, segment = inside(offsets)
        c = seen[valid]
        base = np.bincount(segment, np.log10((c + 1) / (total + distinct + 1)), rows)
        known = np.bincount(segment, np.where(c > 0, np.log10(np.maximum(c, 1) - discount), 0.0), rows)
        counts = [np.bincount(segment, minlength=rows), np.bincount(segment, c > 0, rows).astype(np.int64)]
        codes = joined(np.where(seen > 0, at, -1 - at), table[2][flat], offsets)
        return pa.RecordBatch.from_arrays([*[b.column(k) for k in (5, 6, 7)], *[pa.array(x) for x in (*counts, base, known)], codes], names=["row", "id", "held", "n_tokens", "n_known", "base", "known", "codes"])

    return run


def inside(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions that are not a segment's history, and their segment."""
    valid = np.ones(offsets[-1], bool)
    for k in range(HISTORY):
        valid[offsets[:-1] + k] = False
    return np.flatnonzero(valid), np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) - HISTORY)


def _flat(units: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of all segments, whether never seen, and offsets."""
    raw = units.flatten().to_numpy().astype(np.int64)
    return np.where(raw < 0, -1 - raw, raw), raw < 0, np.concatenate([[0], np.cumsum(units.value_lengths().to_numpy())])


# ---- classes


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often a unit stands after and before each of ``NEAR`` symbols."""
    total = np.zeros(UNITS * 2 * NEAR, np.int64)
    for b in _pieces(batches, 0):
        at, _, offsets = _flat(split(b.column(0))[0])
        valid, _ = inside(offsets)
        near = np.where(at <= TOP, at, 1 + TOP + (at - TOP - 1) % (NEAR - TOP - 1))
        total += np.bincount(at[valid] * 2 * NEAR + near[valid - 1], minlength=len(total))
        total += np.bincount(at[valid - 1] * 2 * NEAR + NEAR + near[valid], minlength=len(total))
    cells = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])


def cluster(cells: np.ndarray, classes: int = CLASSES, passes: int = 10) -> np.ndarray:
    """Class of each unit, from the counts of its neighbours (units x symbols): spherical k-means from far-apart heavy units."""
    n = cells.sum(1)
    x = np.sqrt(cells / np.maximum(n, 1)[:, None])
    heavy = np.argsort(-n, kind="stable")[: 16 * classes]
    centres = x[heavy[:1]]
    far = 1 - x[heavy] @ centres[0]
    while len(centres) < classes - 1:
        centres = np.concatenate([centres, x[heavy[np.argmax(far * np.sqrt(n[heavy]))]][None]])
        far = np.minimum(far, 1 - x[heavy] @ centres[-1])
    for _ in range(passes):
        of = np.argmax(x @ centres.T, 1)
        for k in range(len(centres)):
            sums = cells[of == k].sum(0)
            if sums.sum():
                centres[k] = np.sqrt(sums / sums.sum())
    of = np.argmax(x @ centres.T, 1) + 1
    of[0] = 0
    return of


# ---- the class model


def features(context: np.ndarray) -> np.ndarray:
    """Buckets of the n-grams and skip pairs of histories, coded as ((last * SYMBOLS) + one before) * SYMBOLS + two before."""
    s1, s2, s3 = context // SYMBOLS // SYMBOLS, context // SYMBOLS % SYMBOLS, context % SYMBOLS
    found = [s1, s2, s3, s1 * SYMBOLS + s2, s1 * SYMBOLS + s3, s2 * SYMBOLS + s3, context]
    hashed = [(x.astype(np.uint64) * np.uint64(8) + np.uint64(j)) * np.uint64(0x9E3779B97F4A7C15) for j, x in enumerate(found)]
    return np.stack([(h >> np.uint64(64 - 13)).astype(np.int64) for h in hashed], 1)


def class_logs(context: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Natural logarithms of P(class | history), a row per history."""
    z = bias + sum(weights[f] for f in features(context).T)
    z -= z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def histories(at: np.ndarray, offsets: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """History of symbols, position and segment of every token."""
    valid, segment = inside(offsets)
    s = symbol[at]
    return (s[valid - 1] * SYMBOLS + s[valid - 2]) * SYMBOLS + s[valid - 3], valid, segment


def word_features(names: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Rows of the words before the tokens at ``valid``: three n-grams, two of one word further back; each has ``WORD_BUCKETS`` rows of its own."""
    x = names.view(np.uint16).astype(np.uint64)
    w1, w2, w3 = (x[valid - k] for k in (1, 2, 3))
    wide = np.uint64(NAMES)
    found = [w1, w1 * wide + w2, (w1 * wide + w2) * wide + w3, w2, w3]
    shift = np.uint64(65 - WORD_BUCKETS.bit_length())
    return np.stack([((h + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64) for h in found])


def _events(of: np.ndarray, symbol: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        young, size = [np.zeros(0, np.int32)], 0

        def counted() -> Iterator[pa.RecordBatch]:
            cell, n = np.unique(np.concatenate(young), return_counts=True)
            for lo in range(0, len(cell), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(cell[lo : lo + ROWS], pa.int64()), pa.array(n[lo : lo + ROWS])], names=["cell", "n"])

        for b in _pieces(batches, 0):
            at, _, offsets = _flat(split(b.column(0))[0])
            context, valid, _ = histories(at, offsets, symbol)
            young.append((context * CLASSES + of[at[valid]]).astype(np.int32))
            size += len(valid)
            if size >= EVENTS:
                yield from counted()
                young, size = young[:1], 0
        yield from counted()

    return run


def _summed(features_: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Adds the rows of ``values`` to the buckets of their features."""
    out = np.zeros((BUCKETS, values.shape[1]))
    for f in features_.T:
        order = np.argsort(f, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], f[order][1:] != f[order][:-1]]))
        out[f[order][first]] += np.add.reduceat(values[order], first, axis=0)
    return out


def _counts(weights: np.ndarray | None, bias: np.ndarray):
    """Sums, by bucket, of the classes' observed counts (no weights) or of the expected ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, CLASSES))
        for b in (x.slice(lo, 1 << 14) for x in batches for lo in range(0, x.num_rows, 1 << 14)):
            context = b.column(0).to_numpy()
            row = np.repeat(np.arange(len(context)), b.column(1).value_lengths().to_numpy())
            seen = np.zeros((len(context), CLASSES))
            seen[row, b.column(1).flatten().to_numpy()] = b.column(2).flatten().to_numpy()
            total += _summed(features(context), seen if weights is None else seen.sum(1, keepdims=True) * np.exp(class_logs(context, weights, bias)))
        bucket = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(bucket), *[pa.array(total[bucket, k]) for k in range(CLASSES)]], names=["bucket", *[f"c{k}" for k in range(CLASSES)]])

    return run


def _added(events: DataFrame, weights: np.ndarray | None, bias: np.ndarray) -> np.ndarray:
    names = [f"c{k}" for k in range(CLASSES)]
    sums = events.mapInArrow(_counts(weights, bias), "bucket long, " + ", ".join(f"{c} double" for c in names)).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names])
    out = np.zeros((BUCKETS, CLASSES))
    for r in sums.collect():  # BUCKETS rows at most
        out[r[0]] = r[1:]
    return out


def train(events: DataFrame, bias: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights from rows (context, classes, counts)."""
    weights, observed = np.zeros((BUCKETS, CLASSES)), _added(events, None, bias)
    events_of = np.maximum(observed.sum(1, keepdims=True), 1e-9)
    share, pull = PRIOR / events_of, SHRINK / events_of  # both keep the weights of rare features small
    for _ in range(rounds):
        expected = _added(events, weights, bias)
        weights += (_gain(observed, expected, share) - pull * weights) / (FEATURES * (1 + pull))
    return weights


def _gain(observed: np.ndarray, expected: np.ndarray, share: np.ndarray) -> np.ndarray:
    return np.log((observed + share * expected + 1e-12) / (expected + share * expected + 1e-12))


@dataclass
class Model:
    of: np.ndarray  # class of a unit
    symbol: np.ndarray  # symbol of a unit in a history
    weights: np.ndarray
    bias: np.ndarray
    tokens: np.ndarray  # training tokens of a class, at least 1
    words: np.ndarray  # distinct training words of a class, at least 1
    discount: float
    slot: np.ndarray | None = None  # slot of a unit in its class
    kept: np.ndarray | None = None  # discounted training tokens of the slots of all classes, flat
    halves: np.ndarray | None = None  # reference of the choices of slots, a row per class
    sums: list[np.ndarray] | None = None  # weights of the symbols' features, added up
    choice: np.ndarray | None = None  # weights of the choices by the words before: feature x cell


# ---- the words before


def slots(of: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Slot of each unit in its class, from the units' training tokens."""
    slot = np.zeros(len(of), np.int64)
    for k in range(CLASSES):
        mine = np.flatnonzero(of == k)
        mine = mine[np.argsort(-tokens[mine], kind="stable")]
        rank = np.arange(len(mine))
        slot[mine] = np.where(rank < OWN, rank, OWN + rank % (CLASSES - OWN))
    return slot


def halves(mass: np.ndarray) -> np.ndarray:
    """Logarithms of the odds of the second half at every choice (leaves x cases): row 1 halves all, rows 2 and 3 its halves, and so on."""
    out = np.zeros_like(mass)
    for d in reversed(range(DEPTH)):
        out[1 << d : 2 << d] = np.log(mass[1::2] / mass[::2])
        mass = mass[1::2] + mass[::2]
    return out


def passed(leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens at every choice, and those that take its second half, from the tokens of the leaves (cases x leaves)."""
    tokens, second = np.zeros(leaves.shape), np.zeros(leaves.shape)
    for d in reversed(range(DEPTH)):
        second[:, 1 << d : 2 << d] = leaves[:, 1::2]
        leaves = leaves[:, 1::2] + leaves[:, ::2]
        tokens[:, 1 << d : 2 << d] = leaves
    return tokens, second


def added_up(weights: np.ndarray, bias: np.ndarray) -> list[np.ndarray]:
    """The symbols' weights by (last, one before), (last, two before), (one before, two before), and of the whole history's buckets."""
    a, b = np.divmod(np.arange(SYMBOLS * SYMBOLS), SYMBOLS)
    f, g, h = features((a * SYMBOLS + b) * SYMBOLS), features(a * SYMBOLS * SYMBOLS + b), features(a * SYMBOLS + b)
    found = [bias + weights[f[:, 0]] + weights[f[:, 1]] + weights[f[:, 3]], weights[g[:, 2]] + weights[g[:, 4]], weights[h[:, 5]], weights]
    return [x.astype(np.float32) for x in found]


def by_symbols(model: Model, context: np.ndarray) -> np.ndarray:
    """Odds of the choices of classes that the symbols give (choices x histories)."""
    square = SYMBOLS * SYMBOLS
    spots = [context // SYMBOLS, context // square * SYMBOLS + context % SYMBOLS, context % square]
    last = (context.astype(np.uint64) * np.uint64(8) + np.uint64(6)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 13)
    z = sum(table.take(at, axis=0) for table, at in zip(model.sums, [*spots, last.astype(np.int64)], strict=True))
    return halves(np.ascontiguousarray(np.exp(np.clip(z, -60, 60)).T))


def reference(model: Model, context: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and log odds (choices x tokens) of the two-way choices to each token's class and slot, without the words before."""
    some, spot = np.unique(context, return_inverse=True)
    of, slot = model.of[unit], model.slot[unit]
    node = np.stack([(1 << d) + (leaf >> (DEPTH - d)) for leaf in (of, slot) for d in range(DEPTH)])
    odds = by_symbols(model, some)
    z = np.concatenate([odds.take(node[:DEPTH] * len(some) + spot), model.halves.take(node[DEPTH:] * CLASSES + of)])
    return node, z


def cells(rows: np.ndarray, of: np.ndarray, node: np.ndarray) -> Iterator[tuple[int, slice, np.ndarray]]:
    """Feature, choices and their cells (choices x tokens): the first half of ``node`` is about the class, the second about its slot."""
    salt, middle = (of + 1) * 2531 % WORD_BUCKETS, len(node) // 2
    for j, row in enumerate(rows):
        yield j, slice(middle), row * CLASSES + node[:middle]
        yield j, slice(middle, None), (row ^ salt) * CLASSES + node[middle:]


def choices(model: Model, context: np.ndarray, rows: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outcomes and log odds (choices x tokens) of the two-way choices to each token's class and slot."""
    node, z = reference(model, context, unit)
    for j, part, at in cells(rows, model.of[unit], node):
        z[part] += model.choice[j].take(at)
    return np.stack([(leaf >> (DEPTH - 1 - d)) & 1 for leaf in (model.of[unit], model.slot[unit]) for d in range(DEPTH)]), z


def _choice_counts(shared, start: bool):
    """Sums, by feature and cell, of the expected second outcomes; at the start also the tokens by feature, row and leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, size = shared.value, WORD_BUCKETS * CLASSES
        total = np.zeros((2 if start else 1, WORD_FEATURES, size))
        for b in _pieces(batches, 0):
            units, named = split(b.column(0))
            at, _, offsets = _flat(units)
            names = named.flatten().to_numpy()
            contexts, everywhere, _ = histories(at, offsets, model.symbol)
            for lo in range(0, len(everywhere), PIECE):
                context, valid = contexts[lo : lo + PIECE], everywhere[lo : lo + PIECE]
                unit, rows = at[valid], word_features(names, valid)
                node, z = reference(model, context, unit)
                of, slot = model.of[unit], model.slot[unit]
                if not start:
                    for j, part, spot in cells(rows, of, node):
                        z[part] += model.choice[j].take(spot)
                p = 1 / (1 + np.exp(-z.astype(np.float64)))
                for j, part, spot in cells(rows, of, node):
                    total[0, j] += np.bincount(spot.ravel(), p[part].ravel(), size)
                if start:
                    for j, part, spot in cells(rows, of, np.stack([of, slot])):
                        total[1, j] += np.bincount(spot.ravel(), minlength=size)
        table = total.reshape(-1, CLASSES).astype(np.float32)
        row = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(row), *[pa.array(table[row, k]) for k in range(CLASSES)]], names=["row", *[f"c{k}" for k in range(CLASSES)]])

    return run


def _choices_added(learnt: DataFrame, model: Model, start: bool) -> np.ndarray:
    names = [f"c{k}" for k in range(CLASSES)]
    shared = learnt.sparkSession.sparkContext.broadcast(model)
    sums = learnt.mapInArrow(_choice_counts(shared, start), "row long, " + ", ".join(f"{c} float" for c in names)).groupBy("row").agg(*[F.sum(c).cast("float").alias(c) for c in names])
    found = sums.toArrow()  # twice WORD_FEATURES times WORD_BUCKETS rows at most
    shared.unpersist()
    out = np.zeros((2 if start else 1, WORD_FEATURES, WORD_BUCKETS * CLASSES))
    out.reshape(-1, CLASSES)[found.column("row").to_numpy()] = np.stack([found.column(c).to_numpy() for c in names], 1)
    return out


def train_choices(learnt: DataFrame, model: Model, total: int, rounds: int = WORD_ROUNDS) -> np.ndarray:
    """Weights of the choices from rows of codes, in tasks of about ``SHARE`` tokens or as many as there are cores."""
    learnt = learnt.coalesce(max(learnt.sparkSession.sparkContext.defaultParallelism, total // SHARE))
    weights = np.zeros((WORD_FEATURES, WORD_BUCKETS * CLASSES))
    for k in range(rounds):
        found = _choices_added(learnt, replace(model, choice=weights.astype(np.float32)), k == 0)
        if k == 0:
            tokens, observed = (x.reshape(weights.shape) for x in passed(found[1].reshape(-1, CLASSES)))
            share, pull = PRIOR / np.maximum(tokens, 1e-9), SHRINK / np.maximum(tokens, 1e-9)
        gain = _gain(observed, found[0], share) - _gain(tokens - observed, np.maximum(tokens - found[0], 0), share)
        weights += np.where(tokens > 0, (gain - pull * weights) / (WORD_FEATURES * (1 + pull)), 0)
    return weights.astype(np.float32)


def scores(model: Model, units: pa.ListArray, known: np.ndarray, names: pa.ListArray | None = None) -> np.ndarray:
    """log10 probability of each segment; ``known`` are the sums of log10(c - discount) over its words seen in training.

    With the ``names`` of the tokens the words before count, else only the symbols.
    """
    at, never, offsets = _flat(units)
    context, valid, segment = histories(at, offsets, model.symbol)
    out, of, rows = known.copy(), model.of[at[valid]], len(offsets) - 1
    out += np.bincount(segment, np.where(never[valid], np.log10(model.discount * model.words[of]), 0.0) - np.log10(model.tokens[of]), rows)
    if names is not None:
        known_names = names.flatten().to_numpy()
        for lo in range(0, len(valid), PIECE):
            here = slice(lo, lo + PIECE)
            unit, seen = at[valid[here]], ~never[valid[here]]
            second, z = choices(model, context[here], word_features(known_names, valid[here]), unit)
            logs = -np.log1p(np.exp(np.where(second, -z, z)))
            # the share of a seen word in its class, c - discount of the class's tokens, is cut down to its share in the slot
            share = np.log(np.maximum(model.tokens - model.discount * model.words, 1e-9))[model.of[unit]] - np.log(model.kept)[model.of[unit] * CLASSES + model.slot[unit]]
            out += np.bincount(segment[here], (logs[:DEPTH].sum(0) + np.where(seen, logs[DEPTH:].sum(0) + share, 0)) / np.log(10), rows)
        return out
    some, spot = np.unique(context, return_inverse=True)
    for lo in range(0, len(some), 1 << 14):
        logs = class_logs(some[lo : lo + (1 << 14)], model.weights, model.bias) / np.log(10)
        here = np.flatnonzero((spot >= lo) & (spot < lo + (1 << 14)))
        out += np.bincount(segment[here], logs[spot[here] - lo, of[here]], rows)
    return out


def held_out(key: Column, modulo: int = 7, rest: int = 2) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulo == rest, F.lit(False))


def score(docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, block: int = BLOCK, segment: int = SEGMENT, word_rounds: int = WORD_ROUNDS) -> DataFrame:
    """``key``, held_out, n_tokens, n_known, train_tokens, base_score and score of every text; rows where ``held`` is true are not learnt from."""
    spark = docs.sparkSession
    # 1. texts as numbers of their block's words
    base = stored(numbered(docs.select(F.col(key).cast("long").alias("id"), held.alias("held"), F.col(text).alias("text")), block, segment))
    # 2. counts of words over all training texts
    counts = stored(base.where("kind = 0").groupBy("word").agg(F.sum("n").alias("c"), F.first("unit").alias("unit")))
    total, distinct, once, twice = counts.agg(F.sum("c"), *[F.count_if(F.expr(x)) for x in ("c > 0", "c = 1", "c = 2")]).first()
    total = total or 0
    discount = float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.9))
    common = [r[0] for r in counts.where((F.col("c") > 0) & (F.col("word") != F.lit(END))).orderBy(F.desc("c"), "word").limit(TOP).select("word").collect()]
    ranked = F.broadcast(spark.createDataFrame([(bytearray(w), k) for k, w in enumerate(common, 1)], "word binary, rank int"))  # TOP rows at most
    info = counts.join(ranked, "word", "left").select("word", "c", F.coalesce("rank", "unit").alias("unit"))
    # 3. words with their counts and units meet the texts of their block
    of_block = base.where("kind = 0").select("block", "kind", "code", "word").join(info, "word")
    nothing = lambda kind: F.lit(None).cast(kind)
    name = F.crc32("word") % NAMES
    some = of_block.select("block", "kind", "code", F.col("c").alias("n"), (F.col("unit") * NAMES + name).cast("int").alias("unit"), nothing("long").alias("row"), nothing("long").alias("id"), nothing("boolean").alias("held"), nothing("binary").alias("codes"))
    rows = base.where("kind = 1").select("block", "kind", "code", "n", "unit", "row", "id", "held", "codes")
    stream = some.unionByName(rows).repartition("block").sortWithinPartitions("block", "kind")
    met = stored(stream.mapInArrow(_met(total, distinct, discount), MET), "zstd")
    discard(base)
    if total:
        # 4. classes of units by their neighbours
        learnt = met.where("NOT held").select("codes")
        cells = np.zeros(UNITS * 2 * NEAR)
        for r in learnt.mapInArrow(_neighbours, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():  # UNITS * 2 * NEAR rows at most
            cells[r[0]] = r[1]
        of = cluster(cells.reshape(UNITS, -1))
        symbol = np.concatenate([np.arange(1 + TOP), 1 + TOP + of[1 + TOP :]])
        # 5. histories and the classes after them, over all training texts
        context, k = F.floor(F.col("cell") / CLASSES), (F.col("cell") % CLASSES).cast("int")
        seen = learnt.mapInArrow(_events(of, symbol), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
        rows = seen.groupBy(context.alias("context")).agg(F.collect_list(F.struct(k.alias("k"), "n")).alias("x"))  # CLASSES at most in a row
        events = stored(rows.select("context", F.col("x.k").alias("classes"), F.col("x.n").alias("counts")))
        tokens = np.zeros(CLASSES)
        for r in events.select(F.explode(F.arrays_zip("classes", "counts")).alias("x")).groupBy("x.classes").agg(F.sum("x.counts")).collect():  # CLASSES rows
            tokens[r[0]] = r[1]
        unit_tokens, unit_words = np.zeros(UNITS), np.zeros(UNITS)
        for r in info.where("c > 0").groupBy("unit").agg(F.sum("c"), F.count(F.lit(1))).collect():  # UNITS rows at most
            unit_tokens[r[0]], unit_words[r[0]] = r[1:]
        held_words = np.bincount(of, unit_words, CLASSES)
        bias = np.log((tokens + 1) / (total + CLASSES))
        slot = slots(of, unit_tokens)
        kept = np.maximum(np.bincount(of * CLASSES + slot, unit_tokens - discount * unit_words, CLASSES * CLASSES), 1e-9)
        share = kept.reshape(CLASSES, CLASSES) / kept.reshape(CLASSES, CLASSES).sum(1, keepdims=True)
        model = Model(of, symbol, train(events, bias, rounds), bias, np.maximum(tokens, 1), np.maximum(held_words, 1), discount, slot, kept, halves(share.T + 1e-12).astype(np.float32))
        model.sums = added_up(model.weights, bias)
        discard(events)
        # 6. the words before, over all training texts
        model.choice = train_choices(learnt, model, total, word_rounds)
    else:
        model = None
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches, 7):
            units, names = split(b.column(7))
            got = pa.array(scores(shared.value, units, b.column(6).to_numpy(), names)) if shared.value else b.column(5)
            yield pa.RecordBatch.from_arrays([*b.columns[:6], got], names=["row", "id", "held", "n_tokens", "n_known", "base", "score"])

    parts = met.mapInArrow(run, "row long, id long, held boolean, n_tokens long, n_known long, base double, score double")
    whole = parts.groupBy("row").agg(F.first("id").alias(key), F.first("held").alias("held_out"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")])
    out = stored(whole.select(key, "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score"))
    discard(met, counts)
    return out
