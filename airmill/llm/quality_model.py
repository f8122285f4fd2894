"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Words of a text give two sequences: the lower-cased words, and their shapes (case and punctuation). Features are the words,
the shapes, and pairs of neighbours of either, hashed to ``BUCKETS``; a value is the feature's share of the text. A score is a
sparse dot product with the weights.

Training runs in one task over at most about ``ROWS`` labelled rows (a documented bound: a hash sample is drawn beyond it), in
hash order, ``PASSES`` times. Weights are a table of at most ``BUCKETS`` rows, so what is shipped does not grow with the data.

Cases: null and empty texts have no features and get the score of the bias; labels that are null are not used; a document with
several labels counts once for each, one with several texts with the least of them; repeated rows are scored each; extra columns are ignored; without labels all scores are
the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airmill.llm import words

BUCKETS, ROWS, PASSES = 1 << 18, 12_000, 3
ALPHA, BETA, L1, L2, GAIN = 0.3, 1.0, 0.002, 0.0001, 8.0
BATCH = 256
_memo: list[words.Memo] = []


def _hashes(found: list[bytes]) -> list[bytes]:
    """Hash of the lower-cased word and hash of its shape."""
    out = []
    for w in found:
        letters = bytes(c for c in w if c >= 128 or chr(c).isalnum())
        marks = bytes(c for c in w if c < 128 and not chr(c).isalnum())
        case = b"U" if len(letters) > 1 and letters.isupper() else b"T" if letters[:1].isupper() else b"l" if letters else b"-"
        case = b"9" if letters.isdigit() else case
        out.append(np.array([zlib.crc32(w.lower()), zlib.crc32(case + marks)], np.uint32).tobytes())
    return out


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """Buckets of each text's features, with repeats."""
    if not _memo:
        _memo.append(words.Memo(_hashes))
    for k in range(0, len(texts), BATCH):
        offsets, codes, found = words.split(texts.slice(k, BATCH), lower=False)
        pairs = np.frombuffer(b"".join(_memo[0](found)), np.uint32).reshape(-1, 2).astype(np.uint64)[codes] if len(codes) else np.zeros((0, 2), np.uint64)
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            x = pairs[a:b]
            both = (x[:-1] * np.uint64(0x9E3779B1) + x[1:] * np.uint64(0x85EBCA77)) >> np.uint64(7)
            both[x[:-1] == x[1:]] = 1  # a repeated word or shape, whichever it is
            parts = [x[:, 0] * np.uint64(4), x[:, 1] * np.uint64(4) + np.uint64(1), both[:, 0] * np.uint64(4) + np.uint64(2), both[:, 1] * np.uint64(4) + np.uint64(3)]
            yield (np.concatenate(parts) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], passes: int = PASSES) -> np.ndarray:
    """Weights after follow-the-regularised-leader updates over (buckets, values, label); bucket 0 is the bias."""
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)

    def weights(at) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, w)

    for _ in range(passes):
        for at, value, label in rows:
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(slice(None)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = ROWS) -> np.ndarray:
    """Weights from the texts of labelled documents; a hash sample of about ``rows`` (key, label) pairs if there are more.

    The sample is drawn from the labels, so only a bounded table is broadcast to the documents and few texts are shuffled.
    """
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).distinct()
    share = min(1.0, rows / max(known.count(), 1))
    drawn = known.withColumn("spot", F.xxhash64("key", "label")).where(F.pmod("spot", F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    met = texts.join(F.broadcast(drawn), F.col("doc") == F.col("key"))  # about ``rows`` rows at most
    drawn = met.groupBy("key", "label", "spot").agg(F.min("text").alias("text"))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spots, values = [], []
            for x in features(b.column(0)):
                at, count = np.unique(x, return_counts=True)
                spots.append(np.append(at, 0))
                values.append(np.append(GAIN * 4 * count / max(len(x), 1), 1.0).astype(np.float32))
            arrays = [b.column(1), b.column(2), pa.array(spots, pa.list_(pa.int64())), pa.array(values, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "spot", "at", "value"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [
            (a.values.to_numpy().astype(np.int32), v.values.to_numpy(), y)
            for b in batches
            for a, v, y in zip(b.column(2), b.column(3), b.column(0).to_pylist(), strict=True)
        ]
        w = train(got)
        at = np.nonzero(w)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], names=["bucket", "weight"])

    ready = drawn.select("text", "label", "spot").mapInArrow(sparse, "label int, spot long, at array<long>, value array<float>")
    out = np.zeros(BUCKETS, np.float32)
    for r in ready.repartition(1).sortWithinPartitions("spot", "label").mapInArrow(learn, "bucket long, weight float").collect():
        out[r["bucket"]] = r["weight"]  # at most BUCKETS rows
    return out


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """All columns but the text, and the score between 0 and 1."""
    rest = [c for c in docs.columns if c not in (text, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = np.array([weights[0] + GAIN * 4 * (float(weights[x].mean(dtype=np.float64)) if len(x) else 0.0) for x in features(b.column(len(rest)))])
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], pa.array(1 / (1 + np.exp(-np.clip(sums, -35, 35))), pa.float64())], names=[*rest, out])

    return docs.select(*rest, F.col(text)).mapInArrow(run, docs.select(*rest, F.lit(0.0).alias(out)).schema)
