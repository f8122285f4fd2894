"""Ranked lexical search the other way round: the documents stream past an inverted index of the items.

The items are few and the documents many, so the index (term -> the items that hold it) is broadcast and each document's counts
of these terms go through it. A task keeps the best ``k`` documents of every item in bounded heaps; the heaps of all tasks are
merged in two steps. Documents are read once a block of items: the first pass writes, per document, its number of terms and its
counts of the block's terms; document frequencies and totals are counted on that table, and the second pass scores it.

Terms are the maximal runs of digits, letters and characters beyond ASCII, of which only A-Z are lower-cased. All arithmetic but
the weight of a term is in integers; sums run in doubles as long as they stay exact there (below 2**53, proven from the weights
before scoring) and in Python's integers otherwise.

Bounds: a block has at most ``ITEMS`` items and, beyond its first item, ``BYTES`` of text; there are as many blocks as the items
need. A task holds the block's index, its heaps and ``CELLS`` scores. Long texts are cut at delimiters into slices (``words.SLICE`` bytes).

Cases: null and empty texts have no terms, so such a document is counted nowhere and such an item finds nothing. Equal scores go by
ascending document id, null ids last. Every row is a document, or an item, of its own, also a repeated one. Empty tables give an
empty result. Only the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airmill.llm import words
from airmill.session import discard, stored

ITEMS, BYTES, CELLS = 16_384, 16_000_000, 2_000_000
SALTS = 64
EXACT = 1 << 53
#: Delimiters become spaces, A-Z lower case, the rest stays.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """Terms of a text, in lists from slices."""
    return words.pieces((text or "").encode(), FOLD)


class Index:
    """Inverted index of a block of items: term numbers, and for each term the items that hold it and how often."""

    def __init__(self, texts: list[str | None]):
        self.items, self.number = len(texts), {}
        pairs = []
        for k, text in enumerate(texts):
            counts: dict[int, int] = {}
            for part in terms(text):
                for w in part:
                    t = self.number.setdefault(w, len(self.number))
                    counts[t] = counts.get(t, 0) + 1
            pairs += [(t, k, n) for t, n in counts.items()]
        found = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        self.starts = np.searchsorted(found[:, 0], np.arange(len(self.number) + 1))
        self.item, self.times = found[:, 1].copy(), found[:, 2].copy()


def postings(docs: DataFrame, index: Index, key: str, text: str) -> DataFrame:
    """``id``, number of terms ``n``, and the index's ``terms`` in the document with their ``counts``; no row without a term."""
    shared = docs.sparkSession.sparkContext.broadcast(index.number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for b in batches:
            ids, sizes, found, counts = [], [], [], []
            for i, value in zip(b.column(0), b.column(1), strict=True):
                n, got = 0, []
                for part in terms(value.as_py()):
                    n += len(part)
                    got.append(np.unique(np.array([t for w in part if (t := number(w)) is not None], np.int32), return_counts=True))
                if n:
                    if len(got) == 1:
                        at, count = got[0]
                    else:
                        at, spots = np.unique(np.concatenate([x for x, _ in got]), return_inverse=True)
                        count = np.bincount(spots, np.concatenate([c for _, c in got]), len(at)).astype(np.int64)
                    ids.append(i)
                    sizes.append(n)
                    found.append(at)
                    counts.append(count)
            if ids:
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in found])]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x), kind)) for x, kind in ((found, pa.int32()), (counts, pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.array([x.as_py() for x in ids], pa.int64()), pa.array(sizes, pa.int64()), *lists], names=["id", "n", "terms", "counts"])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, "id long, n long, terms array<int>, counts array<long>")


def _frequencies(held: DataFrame) -> dict[int, int]:
    """Documents that hold each term; one row per term and task is shuffled, at most one per term of the block comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            some = np.bincount(b.column(0).flatten().to_numpy(), minlength=len(total))
            some[: len(total)] += total
            total = some
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    counted = held.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r["term"]: r["df"] for r in counted.collect()}


class Heaps:
    """The best ``k`` of every item: highest score, then lowest id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]  # item, score, id, null

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``scores`` has a row per document and a column per item; what is below an item's last place is not looked at."""
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        new = [item, scores[row, item], ids[row], null[row]]
        item, score, doc, gone = (np.concatenate(x) for x in zip(self.best, new, strict=True))
        order = np.lexsort((doc, gone, -score, item))
        item, score, doc, gone = item[order], score[order], doc[order], gone[order]
        first = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        self.best = [x[place < self.k] for x in (item, score, doc, gone)]
        last = place == self.k - 1
        self.least[item[last]] = score[last]


def _scores(held: DataFrame, index: Index, weights: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    """The heaps of all tasks: item number, id and score."""
    sums = np.bincount(index.item, index.times * np.repeat(weights, np.diff(index.starts)).astype(np.float64), index.items)
    exact = float(sums.max(initial=0)) * 1e6 < EXACT  # a term's factor is below 1e6
    shared = held.sparkSession.sparkContext.broadcast((index.starts, index.item, index.times, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, items, times, weight = shared.value
        width = np.diff(starts)
        heaps, step = Heaps(index.items, k), 64
        for b in batches:
            at = 0
            while at < b.num_rows:
                part = b.slice(at, step)
                at, step = at + step, max(1, CELLS // max(index.items, 1))
                size = np.array([100 - 25 + 25 * n * documents // length for n in part.column(1).to_pylist()], np.int64)
                term, tf = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), np.diff(part.column(2).offsets.to_numpy()))
                value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * size[row]))
                scores = np.zeros(part.num_rows * index.items, np.float64 if exact else object)
                cut = np.searchsorted(np.cumsum(width[term]), np.arange(CELLS, int(width[term].sum()) + CELLS, CELLS), "right")
                for lo, hi in zip([0, *cut[:-1]], cut, strict=True):  # so many cells of the index at a time
                    each = width[term[lo:hi]]
                    if not each.sum():
                        continue
                    cell = np.arange(each.sum()) + np.repeat(starts[term[lo:hi]] - np.concatenate([[0], np.cumsum(each)[:-1]]), each)
                    spot, gain = np.repeat(row[lo:hi] * index.items, each) + items[cell], np.repeat(value[lo:hi], each)
                    if exact:
                        scores += np.bincount(spot, gain * times[cell], len(scores))
                    else:
                        np.add.at(scores, spot, gain.astype(object) * times[cell])
                ids = part.column(0)
                heaps.add(scores.reshape(-1, index.items).astype(np.int64), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(False))
        item, score, doc, gone = heaps.best
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc, pa.int64(), mask=gone), pa.array(score)], names=["item", "id", "score"])

    return held.mapInArrow(run, "item long, id long, score long")


def _merged(heaps: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of every item over all heaps, first within each of ``SALTS`` groups of tasks, then over these."""
    order = [F.desc("score"), F.asc_nulls_last("id")]
    salted = heaps.withColumn("salt", F.spark_partition_id() % SALTS)
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("salt")


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    block, size = [], 0
    for r in items.toLocalIterator():
        new = len((r[1] or "").encode())
        if block and (len(block) == ITEMS or size + new > BYTES):
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += new
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id``, ``rank`` from 1, ``doc_id`` and ``score`` of each item's best ``k`` documents with a score above 0."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in _blocks(items.select(F.col(item).cast("long"), F.col(text))):
        index = Index([x for _, x in block])
        if not index.number:
            continue
        held = stored(postings(docs, index, key, text))
        documents, length = held.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not documents:
            discard(held)
            break
        weights = np.zeros(len(index.number), np.int64)
        for t, df in _frequencies(held).items():
            weights[t] = int(np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))))
        numbers = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], "item long, item_id long")
        best = stored(_merged(_scores(held, index, weights, documents, length, k), k))
        discard(held)
        named = best.join(F.broadcast(numbers), "item")  # at most ITEMS rows
        out = out.unionByName(named.select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score"))
    return out
