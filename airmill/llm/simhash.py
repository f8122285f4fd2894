"""Near duplicates by SimHash: exact links between fingerprints, compared in tiles with numpy.

A fingerprint pair within ``RADIUS`` = 3 differing bits agrees in at least one of four blocks of 16 bits, so every tile
holds the distinct fingerprints that share one block; nothing is lost by looking inside tiles only. Inside a tile the
fingerprints are ordered by population count, and sub-tiles whose counts differ by more than the radius are skipped. A tile
above ``TILE`` rows is cut by population count and hash into sub-tiles, and pairs of sub-tiles become tasks of their own.
Each tile returns a spanning forest of its links, not the links, so a group of a million copies costs a million rows.

Three bits of 64 only reach texts that are nearly the same: at five words and a shingle similarity of 0.8, two fingerprints differ
in about ten bits. ``WIDE`` therefore takes the same fingerprint four words long and links at 44 of 256 bits, where a similarity
of 0.8 gives 39 on average; some pairs between 0.6 and 0.8 are linked too, and few above are not. Its tiles hold fingerprints
that agree in one of ``KEYS`` fixed choices of ``KEY_BITS`` bits; a pair that differs in 39 bits agrees in none of them in about one of 300 cases, at 44 bits in one of 70.

Cases: a null or empty text has no words and fingerprint zero; rows with fingerprint zero are linked like any other; repeated
rows are linked to each other; a null doc_id never becomes a group's name unless the group has no other; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airmill.llm.graph import components
from airmill.llm.words import lean
from airmill.session import stored

RADIUS, BLOCKS, TILE, SEED = 3, 4, 4096, 42
KEYS, KEY_BITS, WIDE_TILE = 48, 13, 32_768
#: Rows held at once while bits are summed, and rows of one comparison block.
SLAB, BLOCK = 65_536, 1024


@dataclass(frozen=True)
class Near:
    """How long a fingerprint is, how many bits may differ, and by which bits tiles are made."""

    words: int
    radius: int
    tile: int
    spots: tuple[tuple[int, ...], ...]

    @property
    def columns(self) -> list[str]:
        """The fingerprint's words; one word is its own name."""
        return ["fp"] if self.words == 1 else [f"fp{k}" for k in range(self.words)]


EXACT = Near(1, RADIUS, TILE, tuple(tuple(range(64 // BLOCKS * k, 64 // BLOCKS * (k + 1))) for k in range(BLOCKS)))
_draw = np.random.default_rng(SEED)
WIDE = Near(4, 44, WIDE_TILE, tuple(tuple(sorted(_draw.choice(256, KEY_BITS, replace=False).tolist())) for _ in range(KEYS)))


def longer(hashes: np.ndarray, words: int) -> np.ndarray:
    """``words`` columns: the hashes, then mixed again with another odd step for each further word."""
    out = [hashes]
    for k in range(1, words):
        x = hashes + np.uint64(0x9E3779B97F4A7C15 * k % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append(x ^ (x >> np.uint64(31)))
    return np.stack(out, axis=1)


def fingerprint_of(text: bytes | None, width: int = 3) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes; A-Z are lower-cased, words end at ASCII space."""
    return int(fingerprint_words(text, width, 1)[0])


def fingerprint_words(text: bytes | None, width: int, words: int) -> np.ndarray:
    """The fingerprint as ``words`` unsigned longs, the first of which is ``fingerprint_of``."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(words, np.uint64)
    line, sizes = b" ".join(found), np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts, n = ends - sizes, max(1, len(found) - width + 1)
    last = ends[min(width, len(found)) - 1 :]
    ones = np.zeros(64 * words, np.int64)
    for k in range(0, n, SLAB):
        parts = map(line.__getitem__, map(slice, starts[k : min(n, k + SLAB)].tolist(), last[k : k + SLAB].tolist()))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, min(n - k, SLAB))
        ones += np.unpackbits(longer(hashes, words).view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * ones > n, bitorder="little").view(np.uint64)


def with_fingerprint(docs: DataFrame, text: str = "text", width: int = 3, near: Near = EXACT) -> DataFrame:
    """All columns but the text, and the fingerprint's words as signed longs; ``fp`` names the fingerprint."""
    rest = [c for c in docs.columns if c not in (text, "fp", *near.columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(len(rest)).cast(pa.large_binary())
            bits = np.array([fingerprint_words(x.as_py(), width, near.words) for x in texts], np.uint64).reshape(-1, near.words).view(np.int64)
            words = [pa.array(np.ascontiguousarray(x)) for x in bits.T]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], *words], names=[*rest, *near.columns])

    schema = docs.select(*rest, *[F.lit(0).cast("long").alias(c) for c in near.columns]).schema
    found = docs.select(*rest, F.col(text)).mapInArrow(lean(run), schema)
    return found if near.words == 1 else found.withColumn("fp", F.xxhash64(*near.columns))


def forest(n: int, left: np.ndarray, right: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest member of each of ``n`` nodes' components; ``label`` continues an earlier result."""
    label = np.arange(n) if label is None else label
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (label != label[label]).any():
            label = label[label]


def apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints whose words are the last axis."""
    return np.bitwise_count(left ^ right).sum(-1, dtype=np.int16)


def tile_links(bits: np.ndarray, other: np.ndarray | None = None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest within one tile (rows of words), or between two: positions in both tiles together."""
    both = bits if other is None else np.concatenate([bits, other])
    ones = np.bitwise_count(both).sum(1, dtype=np.int64)
    spots = [np.argsort(ones[: len(bits)], kind="stable")]
    spots.append(spots[0] if other is None else len(bits) + np.argsort(ones[len(bits) :], kind="stable"))
    label = np.arange(len(both))
    for i in range(0, len(spots[0]), BLOCK):
        rows = spots[0][i : i + BLOCK]
        for j in range(i if other is None else 0, len(spots[1]), BLOCK):
            cols = spots[1][j : j + BLOCK]
            if int(ones[cols[0]]) - int(ones[rows[-1]]) > radius or int(ones[rows[0]]) - int(ones[cols[-1]]) > radius:
                continue  # population counts too far apart
            # pairs within the component that most columns are in add nothing
            values, counts = np.unique(label[cols], return_counts=True)
            most = values[np.argmax(counts)]
            inside, known = label[rows] == most, label[cols] == most
            for left, right in ((rows[~inside], cols), (rows[inside], cols[~known])):
                if not len(left) or not len(right):
                    continue
                # word by word, so that a block's table stays in the cache
                far = np.zeros((len(left), len(right)), np.uint8 if bits.shape[1] == 1 else np.uint16)
                for k in range(bits.shape[1]):
                    far += np.bitwise_count(both[left, k][:, None] ^ both[right, k][None, :])
                a, b = np.nonzero(far <= radius)
                label = forest(len(both), left[a], right[b], label)
    moved = np.nonzero(label != np.arange(len(both)))[0]
    return moved, label[moved]


def small_links(tile: np.ndarray, bits: np.ndarray, most: int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links of many sorted tiles of at most ``most`` rows, as positions: each row against the next ones of its tile."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for d in range(1, most):
        at = np.nonzero(tile[d:] == tile[:-d])[0]
        at = at[apart(bits[at], bits[at + d]) <= radius]
        found.append((at, at + d))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _comparer(near: Near) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Compares rows that come sorted by tile; the last tile of a batch waits for the next batch."""
    columns = ("tile", "low", "high", "part", *dict.fromkeys(["fp", *near.columns]))

    def done(t: dict[str, np.ndarray]) -> pa.RecordBatch:
        starts = np.nonzero(np.concatenate([[True], (np.diff(t["tile"]) != 0) | (np.diff(t["low"]) != 0) | (np.diff(t["high"]) != 0)]))[0]
        sizes = np.diff(np.append(starts, len(t["tile"])))
        ids, bits = np.repeat(np.arange(len(starts)), sizes), np.stack([t[c].view(np.uint64) for c in near.columns], axis=1)
        single = (sizes <= 32) & (t["low"][starts] == t["high"][starts])
        small = np.nonzero(np.repeat(single, sizes))[0]
        found = [tuple(small[x] for x in small_links(ids[small], bits[small], 32, near.radius))]
        for k in np.nonzero(~single)[0]:
            at = np.arange(starts[k], starts[k] + sizes[k])
            first = t["part"][at] == t["low"][at]
            a, b = at[first], at[~first]
            inner = t["low"][at[0]] == t["high"][at[0]]
            order = a if inner else np.concatenate([a, b])
            found.append(tuple(order[x] for x in tile_links(bits[a], None if inner else bits[b], near.radius)))
        left, right = map(np.concatenate, zip(*found, strict=True))
        # one forest for the tiles of a batch, hung on the smallest names: tiles of one group mostly agree on these
        names, at = np.unique(np.concatenate([t["fp"][left], t["fp"][right]]), return_inverse=True)
        label = forest(len(names), at[: len(left)], at[len(left) :])
        moved = np.nonzero(label != np.arange(len(names)))[0]
        return pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[label[moved]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            now = {c: b.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(columns)}
            if held:
                now = {c: np.concatenate([held[c], now[c]]) for c in columns}
            if not len(now["tile"]):
                continue
            same = (now["tile"] == now["tile"][-1]) & (now["low"] == now["low"][-1]) & (now["high"] == now["high"][-1])
            cut = len(same) if same.all() else int(np.nonzero(~same)[0][-1]) + 1
            if cut == len(same):
                held = now
                continue
            held = {c: now[c][cut:] for c in columns}
            yield done({c: now[c][:cut] for c in columns})
        if held:
            yield done(held)

    return run


def tile_keys(bits: np.ndarray, near: Near) -> np.ndarray:
    """Rows of words to rows of keys, one for each choice of bits: these bits, and above them the number of the choice."""
    flat = np.unpackbits(np.ascontiguousarray(bits).view(np.uint8), axis=1, bitorder="little")
    return np.stack([(flat[:, list(s)] @ (1 << np.arange(len(s)))) + (k << len(s)) for k, s in enumerate(near.spots)], axis=1)


def with_tiles(prints: DataFrame, near: Near) -> DataFrame:
    """A row for each tile of each fingerprint, with its population count ``ones``."""
    names = list(dict.fromkeys(["fp", *near.columns]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [b.column(i).to_numpy(zero_copy_only=False) for i in range(len(names))]
            bits = np.stack([columns[names.index(c)].view(np.uint64) for c in near.columns], axis=1)
            keys, ones = tile_keys(bits, near), np.bitwise_count(bits).sum(1, dtype=np.int32)
            out = [np.repeat(x, len(near.spots)) for x in (*columns, ones)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*out, keys.ravel())], names=[*names, "ones", "tile"])

    return prints.select(*names).mapInArrow(run, ", ".join(f"{c} long" for c in names) + ", ones int, tile long")


def links(prints: DataFrame, near: Near = EXACT) -> DataFrame:
    """``u``, ``v``: links that connect the distinct fingerprints within the radius by their name ``fp``, a spanning forest per tile."""
    words = list(dict.fromkeys(["fp", *near.columns]))
    distinct = stored(prints.select(*words).distinct())
    tiles = with_tiles(distinct, near)
    sizes = tiles.groupBy("tile", "ones").agg(F.count("*").alias("n")).groupBy("tile").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    large = stored(sizes.where(F.col("n") > near.tile)).select(F.col("tile").alias("big"), F.ceil(F.col("most") / near.tile).cast("int").alias("cuts"))
    placed = tiles.join(large, F.col("tile") == F.col("big"), "left")
    part = F.coalesce(F.col("ones") * F.col("cuts") + F.pmod(F.xxhash64("fp"), F.col("cuts")), F.lit(0)).cast("int")
    reach = F.when(
        F.col("cuts").isNotNull(),
        F.sequence(
            F.greatest(F.lit(0), F.col("ones") - near.radius) * F.col("cuts"),
            (F.least(F.lit(64 * near.words), F.col("ones") + near.radius) + 1) * F.col("cuts") - 1,
        ),
    ).otherwise(F.array(F.lit(0)))
    met = placed.select("tile", *words, part.alias("part"), F.explode(reach).alias("other")).select(
        "tile", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", *words
    )
    count = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = met.repartition(count, "tile", "low", "high").sortWithinPartitions("tile", "low", "high")
    return dealt.mapInArrow(_comparer(near), "u long, v long")


def contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: a node and its other roots hang on its smallest root.

    A node has an edge for each of its tiles at most, so the window's groups are bounded; tiles share their roots, so most edges
    between roots are equal.
    """
    rooted = edges.distinct().withColumn("root", F.min("v").over(Window.partitionBy("u")))
    ends = rooted.select(F.inline(F.array(F.struct("u", F.col("root").alias("v")), F.struct(F.col("v").alias("u"), F.col("root").alias("v")))))
    return ends.where("u <> v").distinct()


def _grouped(docs: DataFrame, key: str, text: str, width: int, near: Near) -> DataFrame:
    """``key``, ``content`` (hash of the text), ``fp``, ``label`` (of the component) and ``component_id`` of every row."""
    content = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("content")
    rows = docs.select(F.col(key).alias("key"), content, F.col(text).alias("text"))
    prints = stored(with_fingerprint(rows, "text", width, near))
    labels = components(contracted(links(prints, near))).toDF("node", "label")
    named = prints.groupBy("fp").agg(F.min("key").alias("least")).join(labels, F.col("fp") == F.col("node"), "left")
    named = stored(named.select("fp", "least", F.coalesce("label", "fp").alias("label")))
    names = stored(named.groupBy("label").agg(F.min("least").alias("component_id")))
    known = stored(named.join(names, "label").select(F.col("fp").alias("known"), "label", "component_id"))
    return prints.drop(*[c for c in near.columns if c != "fp"]).join(known, F.col("fp") == F.col("known")).drop("known")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, near: Near = EXACT) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``fp`` and ``component_id``, the smallest key reachable over links."""
    return _grouped(docs, key, text, width, near).select(F.col("key").alias(key), "fp", "component_id")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, near: Near = EXACT) -> DataFrame:
    """One whole row of ``docs`` per group: the one with the smallest key (nulls last); one of several equal rows."""
    rows = _grouped(docs, key, text, width, near)
    order = F.struct(F.col("key").isNull().alias("n"), "key", "content")
    first = rows.groupBy("label").agg(F.min(order).alias("first"))
    first = first.select("label", F.col("first.key").alias("_key"), F.col("first.content").alias("_content"))
    # how many rows have the winner's key and text
    equal = rows.groupBy("label", "key", "content").agg(F.count("*").alias("_rows")).withColumnRenamed("label", "_label")
    same = (F.col("label") == F.col("_label")) & F.col("key").eqNullSafe(F.col("_key")) & (F.col("content") == F.col("_content"))
    kept = stored(first.join(equal, same).select("_key", "_content", "_rows"))
    whole = docs.withColumn("_text_hash", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    match = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_text_hash") == F.col("_content"))
    out = whole.join(kept.where("_rows = 1"), match, "left_semi").select(docs.columns)
    if kept.where("_rows > 1").isEmpty():
        return out
    again = whole.join(kept.where("_rows > 1"), match, "left_semi").dropDuplicates([key, "_text_hash"])
    return out.unionByName(again.select(docs.columns))
