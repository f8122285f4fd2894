"""Best segmentation into the pieces of a SentencePiece model by streaming Viterbi, and exact decoding.

The text is normalised as the model asks (a leading space on request, spaces as U+2581) and cut into the pieces whose scores
have the largest sum. The search keeps a window of the last ``longest piece`` boundaries. Whenever all backpointer paths that
survive in it meet at one boundary, everything before is final: its ids are committed and forgotten, so memory does not grow
with the text. Ties prefer the longer last piece. A character without a piece becomes its UTF-8 bytes' pieces, each at a score
below all others, or the unknown id if the model has none.

All paths meet between two neighbours that no piece holds side by side. In a model whose pieces have spaces only in front,
that is before every space that follows another character: the text falls into words with their leading spaces, and these into
parts at their own such boundaries. Words and parts are searched once per worker and remembered in bounded memos;
``encode_stream`` is the search itself.

Cases: null and empty texts have no ids and decode to the empty text; ``encode_stream`` keeps the same memory for texts of any length,
``encode`` holds the texts, words and ids of ``BATCH`` rows; a text that itself holds U+2581 comes back with spaces there, so it does
not make the round trip; repeated rows are encoded each; columns named like a result are replaced, other extra columns pass; an empty
table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airmill.llm import words

SPACE, ID = "▁", np.dtype("<i4")
CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
BATCH = 128


class Model:
    """Pieces with their ids and scores, and the fixed facts of a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        s = SentencePieceProcessor(model_file=path)
        n = s.get_piece_size()
        plain = [i for i in range(n) if not (s.is_control(i) or s.is_unknown(i) or s.is_unused(i) or s.is_byte(i))]
        self.pieces = {s.id_to_piece(i): (s.get_score(i), i) for i in plain}
        self.bytes = {int(s.id_to_piece(i)[3:5], 16): i for i in range(n) if s.is_byte(i)}
        self.texts = [self._text(s, i) for i in range(n)]
        self.unknown = s.unk_id()
        self.longest = max(map(len, self.pieces), default=1)
        # pieces by their characters from the last one: (longer pieces, own score, own ids) by character; and the neighbours some piece holds
        self.trie: dict = {}
        for p, (score, i) in sorted(self.pieces.items(), key=lambda x: len(x[0])):
            node = self.trie
            for c in p[:0:-1]:
                node = node.setdefault(c, ({}, None, ()))[0]
            node[p[0]] = node[p[0]][0] if p[0] in node else {}, score, (i,)
        self.pairs = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        # unusable scores (user pieces of a model carry none) do not count as the lowest
        self.low = min((x for x, _ in self.pieces.values() if x > -1e8), default=0.0) - 10.0
        self.front = s.encode("a", out_type=str)[:1] != ["a"]
        self.cut = not any(x[1] == SPACE and x[0] != SPACE for x in self.pairs)

    @staticmethod
    def _text(s, i: int) -> bytes:
        if s.is_byte(i):
            return bytes([int(s.id_to_piece(i)[3:5], 16)])
        return b"" if s.is_control(i) else s.id_to_piece(i).replace(SPACE, " ").encode()

    def fallback(self, char: str) -> tuple[int, ...]:
        """Ids of a character that is no piece."""
        return tuple(self.bytes[b] for b in char.encode()) if len(self.bytes) == 256 else (self.unknown,)


def encode_stream(text: Iterable[str], model: Model) -> Iterator[int]:
    """Ids of the best segmentation of a stream of characters, given out in runs as soon as they are certain."""
    trie, longest, low = model.trie, model.longest, model.low
    best, back = [0.0], [(0, ())]  # of the boundaries in the window: score, (where its last piece starts, its ids)
    base = end = 0  # the window's first boundary is the last committed one
    tail, look = "", longest
    for char in text:
        end += 1
        tail = tail[1 - longest :] + char if longest > 1 else char
        top, found, room = -np.inf, None, end - base
        node, n = trie, 0
        for c in reversed(tail if room >= longest else tail[-room:]):
            entry = node.get(c)
            if entry is None:
                break
            n += 1
            node, score, ids = entry
            if score is not None:
                score += best[room - n]
                if score >= top:
                    top, found = score, (end - n, ids)
        if char not in model.pieces:
            ids = model.fallback(char)
            score = best[room - 1] + low * len(ids)
            if score > top:
                top, found = score, (end - 1, ids)
        best.append(top)
        back.append(found)
        if room < look:
            continue
        # later pieces start at one of the last boundaries: only their paths survive
        alive = set(range(end - longest + 1, end + 1))
        while len(alive) > 1 and max(alive) > base:
            last = max(alive)
            alive.discard(last)
            alive.add(back[last - base][0])
        meet = max(alive)
        if meet > base:
            yield from _path(back, base, base, meet)
            del best[: meet - base], back[: meet - base]
            base = meet
        look = (end - base) + longest
    yield from _path(back, base, base, end)


def _path(back: list, base: int, start: int, end: int) -> list[int]:
    out = []
    while end > start:
        end, ids = back[end - base]
        out.append(ids)
    return [i for ids in reversed(out) for i in ids]


def normalise(text: str, model: Model) -> str:
    if not text:
        return ""
    return ((" " if model.front else "") + text).replace(" ", SPACE)


def parts(word: str, model: Model) -> list[str]:
    """The word cut between neighbours that no piece holds side by side."""
    out, start, pairs = [], 0, model.pairs
    for i in range(1, len(word)):
        if word[i - 1 : i + 1] not in pairs:
            out.append(word[start:i])
            start = i
    return [*out, word[start:]]


_held: dict[str, tuple[Model, Callable]] = {}


def _worker(path: str) -> tuple[Model, Callable]:
    """Model and memo of a worker."""
    if path not in _held:
        model = Model(path)
        part_memo = words.Memo(lambda found: [np.fromiter(encode_stream(w, model), ID).tobytes() for w in found])

        def compute(found: list[str]) -> list[bytes]:
            cut = [parts(w, model) for w in found]
            distinct = list({p for x in cut for p in x})
            known = dict(zip(distinct, part_memo(distinct), strict=True))
            return [b"".join(map(known.__getitem__, x)) for x in cut]

        _held[path] = model, words.Memo(compute)
    return _held[path]


def _plain(text: str | None, model: Model) -> bool:
    """Words with one space before each: the chunks of such a text are its items between spaces."""
    return bool(text) and model.cut and model.front and "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " "


def encode(texts: list[str | None], path: str) -> Iterator[np.ndarray]:
    """Ids of each text."""
    model, memo = _worker(path)
    for k in range(0, len(texts), BATCH):
        batch = texts[k : k + BATCH]
        plain = [_plain(t, model) for t in batch]
        items = pc.split_pattern(pa.array([t for t, p in zip(batch, plain, strict=True) if p], pa.large_string()), " ")
        found = pc.dictionary_encode(items.values)
        values = memo([SPACE + w for w in found.dictionary.to_numpy(zero_copy_only=False).tolist()])
        ids, starts = words.gather(found.indices.to_numpy(zero_copy_only=False), values, ID)
        spans = starts[items.offsets.to_numpy()].tolist()
        spans = iter(zip(spans[:-1], spans[1:], strict=True))
        for t, p in zip(batch, plain, strict=True):
            if p:
                start, end = next(spans)
                yield ids[start:end]
                continue
            line = normalise(t or "", model)
            if not model.cut:
                yield np.fromiter(encode_stream(line, model), ID)
                continue
            cut = CHUNK.findall(line)
            distinct = list(set(cut))
            known = dict(zip(distinct, memo(distinct), strict=True))
            yield np.frombuffer(b"".join(map(known.__getitem__, cut)), ID)


def decode(ids: np.ndarray, path: str) -> str:
    """The text of the ids, without the leading space that encoding put in front."""
    model = _worker(path)[0]
    raw = b"".join(map(model.texts.__getitem__, ids.tolist()))
    return (raw[1:] if model.front and raw[:1] == b" " else raw).decode("utf-8", "replace")


def with_ids(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """All columns but the text, and its ids."""
    rest = [c for c in docs.columns if c not in (text, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = pa.array(list(encode(b.column(len(rest)).to_pylist(), path)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], ids], names=[*rest, out])

    return docs.select(*rest, F.col(text)).mapInArrow(run, docs.select(*rest, F.array(F.lit(0)).alias(out)).schema)


def with_text(rows: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """All columns but the ids, and their text; null ids give an empty text."""
    rest = [c for c in rows.columns if c not in (ids, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([decode(np.array(x or [], ID), path) for x in b.column(len(rest)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], texts], names=[*rest, out])

    return rows.select(*rest, F.col(ids)).mapInArrow(run, rows.select(*rest, F.lit("").alias(out)).schema)


def digest(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``n_ids``, ``ids_crc32`` (little-endian 32-bit ids) and whether decoding gives the text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            told = [(len(x), zlib.crc32(x.tobytes()), decode(x, path) == (t or "")) for x, t in zip(encode(texts, path), texts, strict=True)]
            columns = list(zip(*told, strict=True)) if told else [[], [], []]
            arrays = [b.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "n_ids", "ids_crc32", "round_trip"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(key, F.col(text)).mapInArrow(run, f"`{key}` {kind}, n_ids long, ids_crc32 long, round_trip boolean")
