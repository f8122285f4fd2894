"""Words of whole Arrow batches as dictionary codes, bounded memos of what is computed per word, and memory given back after batches."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a worker remembers at most; older ones go when twice as many are held.
MEMO = 600_000

#: A-Z lower case, white space as spaces.
LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
SPACES = bytes(32 if 9 <= c <= 13 else c for c in range(256))
SLICE = 1 << 20


def pieces(raw: bytes, table: bytes = LOWER) -> Iterator[list[bytes]]:
    """Words of a text after ``table``, which makes every delimiter a space, in lists from slices of about ``SLICE`` bytes."""
    at = 0
    while at < len(raw):
        end = len(raw) if len(raw) <= at + SLICE else at + SLICE
        part = raw[at:end].translate(table)
        if end < len(raw):
            # up to the last delimiter, or on to the next one if the slice is one word
            cut = part.rfind(b" ") + 1
            while not cut:
                more = raw[end : end + SLICE].translate(table)
                spot = more.find(b" ")
                part += more if spot < 0 else more[:spot]
                end = end + len(more) if spot < 0 else end + spot
                cut = len(part) if spot >= 0 or end >= len(raw) else 0
            part, end = part[:cut], at + cut
        yield part.split()
        at = end


def release() -> None:
    """Gives back what Arrow's allocator holds but nothing uses; it would stay with the worker, through all later stages."""
    pa.default_memory_pool().release_unused()


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, with ``release`` after each batch that it gives and when its own variables are gone."""

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batches):
            yield out
            del out
            release()
        release()

    return released


class Memo:
    """Values per word, in two generations: when the young one is full it replaces the old one."""

    def __init__(self, compute: Callable[[list[bytes]], list], limit: int = MEMO):
        self.compute, self.limit, self.young, self.old = compute, limit // 2, {}, {}

    def __call__(self, words: list[bytes]) -> list:
        # nothing here makes cycles, and the collector would walk the whole memo each time
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._look(words)
        finally:
            if collects:
                gc.enable()

    def _look(self, words: list[bytes]) -> list:
        young, old = self.young, self.old
        out = list(map(young.get, words))
        missing = [i for i, x in enumerate(out) if x is None]
        if missing:
            for i in missing:
                out[i] = old.get(words[i])
            new = list(dict.fromkeys(words[i] for i in missing if out[i] is None))
            found = dict(zip(new, self.compute(new), strict=True))
            for i in missing:
                w = words[i]
                if out[i] is None:
                    out[i] = found[w]
                young[w] = out[i]
        if len(young) > self.limit:
            self.old, self.young = young, {}
        return out


def split(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Texts cut at ASCII white space: offsets of each text in ``codes``, the codes, and the distinct words.

    A null text has no words. A-Z are lower-cased on request; everything else stays as it is.
    """
    table = LOWER if lower else SPACES
    raw = pa.array([(x.as_py() or b"").translate(table) for x in texts.cast(pa.large_binary())], pa.large_binary())
    cut = pc.split_pattern(raw, b" ")
    # spaces in a row, and at the ends, leave empty items
    full = pc.not_equal(pc.binary_length(cut.values), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))]).astype(np.int64)
    found = pc.dictionary_encode(cut.values.filter(full))
    return before[cut.offsets.to_numpy()], found.indices.to_numpy(zero_copy_only=False), found.dictionary.to_numpy(zero_copy_only=False).tolist()


def gather(codes: np.ndarray, values: list[bytes], item: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Concatenates ``values[code]`` for all codes: the items, and the offset of each code's items."""
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // item.itemsize
    pool, starts = np.frombuffer(b"".join(values), item), np.concatenate([[0], np.cumsum(sizes)])[:-1]
    each = sizes[codes] if len(codes) else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(each)])
    spots = np.arange(offsets[-1]) + np.repeat(starts[codes] - offsets[:-1], each) if len(codes) else np.zeros(0, np.int64)
    return pool[spots], offsets
