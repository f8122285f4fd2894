"""Sum-of-squares packing of tokenised documents into windows.

Each task packs the documents of its partition in one pass. ``level[h]`` counts its open windows filled to level h; a document
of s ids goes where the sum of squared counts grows least: into an open level h (its window moves to h + s, or closes at the
window's size) or into a new window. Documents longer than a window first fill whole windows. The levels are one numpy array, so
a placement costs one vectorised sweep.

At most ``OPEN`` windows stay open: beyond that, the head of the next document closes the fullest one and only its tail is
placed. At the end of a partition the open windows are poured together into full ones, and the last one is cut at powers of
two, which need no padding. So padding is zero and the number of short sequences is at most log2(window) per partition.

Sequence ids are partition number * 2^40 + count, so they need no coordination, and a repeated task gives the same ids.

Cases: a null or empty text is the end id alone; texts of any length are cut; repeated rows are packed again each; a null id is
passed on; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airmill.llm import words

WINDOW, OPEN, END = 4096, 256, 2
ID = np.dtype("<u4")
#: Rows of one output batch, and of one batch that is tokenised at a time.
OUT, BATCH = 20_000, 512
#: Units that are tokenised as one text.
LINE = 512
#: Words whose units are certain without the tokenizer (ASCII and small Latin-1 letters), and, a fixed value, its pattern of units there.
PLAIN = re.compile("[!-~ß-öø-ÿ]+")
UNIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
_memos: dict[str, words.Memo] = {}


def word_ids(path: str) -> words.Memo:
    """Memo of a word's ids for a tokenizer file that splits at white space and lower-cases; one per worker.

    New words are cut into the tokenizer's own units, so that one with a comma or a number costs no more than its letters, and units
    have a memo of their own.
    """
    if path not in _memos:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        ends = np.array([t.endswith("</w>") for t, _ in sorted(tokenizer.get_vocab().items(), key=lambda x: x[1])])

        def alone(parts: list[str]) -> list[bytes]:
            return [np.array(e.ids, ID).tobytes() for e in tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

        # units of plain words need no normalisation and no splitting but at spaces; their characters become the model's own
        quick, own = Tokenizer.from_file(path), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        quick.normalizer, quick.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        signs = {ord(c): own.pre_tokenize_str(c)[0][0] for c in map(chr, range(33, 256)) if PLAIN.fullmatch(c)}

        def together(units: list[str]) -> list[bytes]:
            """Units as one text, cut where a unit ends; a unit's last id, and no other, ends a word."""
            out = []
            lines = [units[k : k + LINE] for k in range(0, len(units), LINE)]
            for line, e in zip(lines, quick.encode_batch_fast([" ".join(x).translate(signs) for x in lines], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, ID)
                at = np.nonzero(ends[ids])[0] + 1
                if len(at) != len(line):
                    out += alone(line)
                    continue
                raw, at = ids.tobytes(), (at * ID.itemsize).tolist()
                out += [raw[a:b] for a, b in zip([0, *at[:-1]], at, strict=True)]
            return out

        unit_memo = words.Memo(together, words.MEMO // 2)

        def compute(found: list[bytes]) -> list[bytes]:
            parts = [w.decode().lower() for w in found]
            cut = [() if not PLAIN.fullmatch(w) or "<|" in w else (w,) if w.isalpha() else UNIT.findall(w) for w in parts]
            hard = [i for i, x in enumerate(cut) if not x]
            distinct = list({u for x in cut for u in x})
            known = dict(zip(distinct, unit_memo(distinct), strict=True))
            out = [known[x[0]] if len(x) == 1 else b"".join(map(known.__getitem__, x)) for x in cut]
            for i, x in zip(hard, alone([found[i].decode() for i in hard]), strict=True):
                out[i] = x
            return out

        _memos[path] = words.Memo(compute)
    return _memos[path]


def encode(texts: pa.Array, path: str) -> Iterator[np.ndarray]:
    """Ids of each text, as the tokenizer gives them for the whole text."""
    memo = word_ids(path)
    for k in range(0, len(texts), BATCH):
        offsets, codes, found = words.split(texts.slice(k, BATCH))
        ids, starts = words.gather(codes, memo(found), ID)
        bounds = starts[offsets]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield ids[a:b]


class Packer:
    """Open windows by level; ``put`` and ``finish`` yield closed pieces."""

    def __init__(self, window: int = WINDOW, most_open: int = OPEN, first: int = 0):
        self.window, self.most_open, self.next = window, most_open, first
        self.level = np.zeros(window + 1, np.int64)
        self.at: list[list[list]] = [[] for _ in range(window + 1)]  # windows by level; a window is a list of pieces
        self.open = 0

    def _close(self, pieces: list) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids in pieces:
            yield doc, start, ids, self.next, offset
            offset += len(ids)
        self.next += 1

    def _choose(self, size: int) -> int:
        """Level that the sum of squares likes best; 0 opens a window. Ties go to the fullest."""
        if size == self.window:
            return 0
        room = self.window - size
        n = self.level
        cost = 2 * (n[size : self.window] - n[:room])  # from h to h + size, plus 2
        cost = np.append(cost + 2, 1 - 2 * n[room])  # exactly full: the count only falls
        cost[0] = 2 * n[size] + 1
        cost[1:][n[1 : room + 1] == 0] = np.iinfo(np.int64).max
        return len(cost) - 1 - int(np.argmin(cost[::-1]))

    def _add(self, pieces: list, level: int, piece: tuple) -> Iterator[tuple]:
        pieces.append(piece)
        level += len(piece[2])
        if level == self.window:
            yield from self._close(pieces)
        else:
            self.level[level] += 1
            self.at[level].append(pieces)
            self.open += 1

    def _take(self, level: int) -> list:
        self.level[level] -= 1
        self.open -= 1
        return self.at[level].pop()

    def put(self, doc: tuple, ids: np.ndarray) -> Iterator[tuple]:
        """``doc`` is passed on with each of its pieces."""
        start = 0
        while len(ids) - start >= self.window:
            yield from self._close([(doc, start, ids[start : start + self.window])])
            start += self.window
        if start == len(ids):
            return
        level = self._choose(len(ids) - start)
        if level == 0 and self.open >= self.most_open:
            fullest = int(np.nonzero(self.level)[0][-1])
            head = min(self.window - fullest, len(ids) - start)
            yield from self._add(self._take(fullest), fullest, (doc, start, ids[start : start + head].copy()))
            start += head
            if start == len(ids):
                return
            level = self._choose(len(ids) - start)
        yield from self._add(self._take(level) if level else [], level, (doc, start, ids[start:].copy()))

    def finish(self) -> Iterator[tuple]:
        """Pours all open windows together, fullest first, and cuts the rest at powers of two."""
        pieces = [p for level in range(self.window - 1, 0, -1) for w in self.at[level] for p in w]
        total = sum(len(p[2]) for p in pieces)
        self.__init__(self.window, self.most_open, self.next)
        sizes = [self.window] * (total // self.window) + [1 << k for k in range(self.window.bit_length() - 1, -1, -1) if (total % self.window) >> k & 1]
        queue = iter(pieces)
        doc, start, ids = None, 0, np.zeros(0, ID)
        for size in sizes:
            filled, now = 0, []
            while filled < size:
                if not len(ids):
                    doc, start, ids = next(queue)
                n = min(size - filled, len(ids))
                now.append((doc, start, ids[:n]))
                start, ids, filled = start + n, ids[n:], filled + n
            yield from self._close(now)


SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END, ids: bool = False,
    encoder: Callable[[pa.Array, str], Iterator[np.ndarray]] = encode,
) -> DataFrame:
    """Pieces of all documents: where each lies in its document and in its sequence; with ``ids`` also the ids."""
    rows = docs.select(F.col(key), F.col(text))
    columns = [key, *[c.split()[0] for c in SCHEMA.split(", ")], *(["ids"] if ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, OPEN, TaskContext.get().partitionId() << 40)
        kind, out = None, []

        def told(pieces: Iterator[tuple]) -> None:
            for (doc, tokens), start, part, sequence, offset in pieces:
                row = (doc, start, len(part), zlib.crc32(np.ascontiguousarray(part)), tokens, sequence, offset)
                out.append((*row, part) if ids else row)

        def batch() -> pa.RecordBatch:
            arrays = [pa.array(x, kind if i == 0 else pa.list_(pa.int64()) if i == 7 else pa.int64()) for i, x in enumerate(zip(*out, strict=True))]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=columns)

        for b in batches:
            kind = b.column(0).type
            for doc, found in zip(b.column(0).to_pylist(), encoder(b.column(1), path), strict=True):
                whole = np.append(found, ID.type(end))
                told(packer.put((doc, len(whole)), whole))
                if len(out) >= OUT:
                    yield batch()
        told(packer.finish())
        if out:
            yield batch()

    return rows.mapInArrow(words.lean(run), f"`{key}` {rows.schema[0].dataType.simpleString()}, {SCHEMA}" + (", ids array<long>" if ids else ""))
