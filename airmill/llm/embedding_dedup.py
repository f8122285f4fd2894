"""Near-duplicate vectors by product quantisation with coarse inverted lists.

Identical vectors are one class. A coarse quantiser (at most one cell per ``PER_CELL`` vectors) and codebooks for the residual's
subspaces are fitted on at most about ``SAMPLE`` vectors; all vectors are indexed: home cell, codes, and the length of what
the codes miss. A vector visits the cells whose border is nearest, of those whose border is within the radius (beyond it no partner can
live). How many is measured on the sample (``Index.sufficient``): enough for every link between ``ASKED`` of its vectors and all of it, and
for ``ENOUGH`` of made partners that lie at the limit in a random direction. A large ``probes`` visits all cells within the radius, which is
exact. In a cell, asymmetric distances from lookup tables leave out only what cannot be within the radius
given what the codes miss, and the rest is compared by exact cosine in double precision.

Lists are cut into parts of at most ``PART`` rows, each a task's job with all of its visitors; a visitor batch meets one part at
a time. A part returns link counts and a spanning forest, never the pairs. A pair that only one side's probes find (with a limit
on them) counts for both.

Cases: vectors that are null, zero, or hold null or non-finite components link with nothing; vectors of different length never
link; equal vectors are linked; a repeated row is another vector; vec_id may be null (such rows count as links, and their group
is named by its smallest id that is not null); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airmill.llm.graph import components
from airmill.llm.simhash import forest
from airmill.session import stored

LEAST, SAMPLE, PER_CELL, CELLS, PART, SPACES, CODES, ROUNDS = 0.9, 20_000, 256, 4096, 2048, 8, 256, 8
VISITORS = 1024
ASKED, ENOUGH = 2048, 0.99


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2 * x @ centres.T, 0)


def kmeans(x: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """At most ``k`` centres by Lloyd's rounds from a random start; empty ones stay where they were."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        near = np.concatenate([distances(x[i : i + 2048], centres).argmin(1) for i in range(0, len(x), 2048)])
        order = np.argsort(near, kind="stable")
        found, starts = np.unique(near[order], return_index=True)
        centres[found] = np.add.reduceat(x[order], starts, axis=0) / np.diff(np.append(starts, len(x)))[:, None]
    return centres


def spread(centres: np.ndarray, least: float) -> np.ndarray:
    """The centres without those closer than ``least`` to an earlier one that stays."""
    stays, open_ = [], np.ones(len(centres), bool)
    for i in range(len(centres)):
        if open_[i]:
            stays.append(i)
            open_ &= distances(centres[i : i + 1], centres)[0] >= least * least
    return centres[stays]


class Index:
    """Coarse centres, residual codebooks (spaces x codes x width) and the radius that stands for the least cosine."""

    def __init__(self, sample: np.ndarray, cells: int, least: float, spaces: int = SPACES):
        self.width = -(-sample.shape[1] // spaces)
        self.spaces, self.radius = spaces, float(np.sqrt(2 - 2 * least))
        self.centres = spread(kmeans(sample, cells), self.radius)
        rest = self.padded(sample - self.centres[distances(sample, self.centres).argmin(1)])
        self.books = [kmeans(rest[:, s], CODES, s) for s in range(spaces)]
        self.probes = self.sufficient(sample, least)

    def sufficient(self, sample: np.ndarray, least: float) -> int:
        """Cells to visit so that one side of a link meets the other; see the module."""
        draw = np.random.default_rng(2)
        x = sample[draw.permutation(len(sample))[:ASKED]]
        aside = draw.normal(size=x.shape)
        aside -= (aside * x).sum(1, keepdims=True) * x
        made = least * x + np.sqrt(1 - least * least) * aside / np.maximum(np.sqrt((aside * aside).sum(1, keepdims=True)), 1e-300)
        needed = [int(np.quantile(self.ranks(x, made), ENOUGH, method="higher"))] if len(x) else []
        for i in range(0, len(x), 64):
            part = x[i : i + 64]
            row, partner = np.nonzero(part @ sample.T >= least)
            for k in range(0, len(row), 4096):
                needed.append(int(self.ranks(part[row[k : k + 4096]], sample[partner[k : k + 4096]]).max()))
        return max(needed, default=0) + 1

    def ranks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For pairs of vectors, the place of one's home among the cells that the other visits, for the better side."""
        places = []
        for a, b in ((x, y), (y, x)):
            border, theirs = self.borders(a)[1], distances(b, self.centres).argmin(1)
            places.append((border < border[np.arange(len(a)), theirs][:, None]).sum(1))
        return np.minimum(*places)

    def borders(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Home cells, and the distances to the borders of all cells (-1 to the home)."""
        far = distances(x, self.centres)
        home = far.argmin(1)
        between = np.sqrt(distances(self.centres[home], self.centres))
        border = (far - far[np.arange(len(x)), home][:, None]) / np.maximum(2 * between, 1e-9)
        border[np.arange(len(x)), home] = -1
        return home, border

    def padded(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, self.width * self.spaces - x.shape[1]))).reshape(len(x), self.spaces, self.width)

    def place(self, x: np.ndarray, probes: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Home cells, codes, lengths of what the codes miss, and the cells to visit (home first)."""
        home, border = self.borders(x)
        rest = self.padded(x - self.centres[home])
        codes = np.stack([distances(rest[:, s], book).argmin(1) for s, book in enumerate(self.books)], 1)
        missed = np.sqrt(sum(((rest[:, s] - book[codes[:, s]]) ** 2).sum(1) for s, book in enumerate(self.books)))
        order = np.argsort(border, axis=1, kind="stable")[:, : probes or self.probes]
        return home, codes.astype(np.uint8), missed, [o[b <= self.radius + 1e-4] for o, b in zip(order, np.take_along_axis(border, order, 1), strict=True)]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles, with zeros up to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def match(index: Index, cell: int, mine: dict, guest: dict, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of the list part, row of the visitors) with the least cosine or more."""
    q = index.padded(guest["x"] - index.centres[cell])
    far = sum(distances(q[:, s], book)[:, mine["codes"][:, s]] for s, book in enumerate(index.books))
    b, a = np.nonzero(far <= (index.radius + mine["missed"][None, :]) ** 2 + 1e-6)
    keep = mine["id"][a] != guest["id"][b]
    a, b = a[keep], b[keep]
    good = [np.einsum("ij,ij->i", mine["x"][a[i : i + 65536]], guest["x"][b[i : i + 65536]]) >= least for i in range(0, len(a), 65536)]
    good = np.concatenate(good) if good else np.zeros(0, bool)
    return a[good], b[good]


def _compare(index: Index, width: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (size, cell, part), each part's own list before its visitors."""
        place, mine, parts = None, None, []

        def told(ids, links, u, v) -> pa.RecordBatch:
            # a link count has v null; a link has no count
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids, u]), pa.int64()), pa.array([None] * len(ids) + list(v), pa.int64()), pa.array(np.concatenate([links, np.zeros(len(u), np.int64)]), pa.int64())],
                names=["u", "v", "links"],
            )

        def close() -> Iterator[pa.RecordBatch]:
            if mine is not None and mine["links"].any():
                at = np.nonzero(mine["links"])[0]
                yield told(mine["id"][at], mine["links"][at], np.zeros(0, np.int64), [])

        for b in batches:
            size, cell, part, visit = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            cut = np.nonzero((np.diff(size) != 0) | (np.diff(cell) != 0) | (np.diff(part) != 0) | (np.diff(visit) != 0))[0] + 1
            for s, e in zip([0, *cut], [*cut, b.num_rows], strict=True):
                for k in range(s, e, VISITORS):
                    now = b.slice(k, min(VISITORS, e - k))
                    row = {
                        "id": now.column(4).to_numpy(), "home": now.column(5).to_numpy(), "copies": now.column(6).to_numpy(), "missed": now.column(8).to_numpy(),
                        "codes": np.frombuffer(b"".join(now.column(7).to_pylist()), np.uint8).reshape(-1, SPACES), "x": unit(_matrix(now.column(10), width)),
                        "probes": now.column(9),
                    }
                    here = (size[k], cell[k], part[k])
                    if here != place:
                        yield from close()
                        place, mine, parts = here, None, []
                    if visit[k] == 0:
                        parts.append(row)
                        continue
                    if parts:
                        mine = {c: np.concatenate([p[c] for p in parts]) for c in ("id", "copies", "missed", "codes", "x")}
                        mine["seen"] = [set(x) for p in parts for x in p["probes"].to_pylist()]
                        mine["links"], parts = np.zeros(len(mine["id"]), np.int64), []
                    if mine is None:
                        continue
                    a, g = match(index, int(cell[k]), mine, row, least)
                    if not len(a):
                        continue
                    links = np.bincount(g, mine["copies"][a], len(row["id"])).astype(np.int64)
                    # the other side does not come here by itself: count for it too
                    alone = np.array([row["home"][j] not in mine["seen"][i] for i, j in zip(a, g, strict=True)], bool)
                    np.add.at(mine["links"], a[alone], row["copies"][g[alone]])
                    both, n = np.concatenate([mine["id"], row["id"]]), len(mine["id"])
                    label = forest(len(both), a, n + g)
                    moved = np.nonzero(label != np.arange(len(both)))[0]
                    moved = moved[both[moved] != both[label[moved]]]
                    at = np.nonzero(links)[0]
                    yield told(row["id"][at], links[at], both[moved], both[label[moved]].tolist())
        yield from close()

    return run


def groups(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = LEAST, probes: int | None = None, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``rows``: ``key``, ``n_links``, ``component_id`` and ``kept``; ``probes`` sets the cells a vector visits at most."""
    spark = rows.sparkSession
    kind = "float" if dict(rows.dtypes)[vector] == "array<float>" else "double"  # floats travel as they are, arithmetic is in doubles
    values = F.transform(vector, lambda v: v.cast(kind))
    fine = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(values, lambda v: v != 0)
    valid = F.coalesce(fine, F.lit(False))
    members = stored(rows.select(F.col(key).alias("key"), F.when(valid, values).alias("vector")).withColumn("id", F.when(F.col("vector").isNotNull(), F.xxhash64("vector"))))
    classes = stored(members.where("id IS NOT NULL").groupBy("id").agg(F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("key").alias("least")))
    n, width = classes.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        return rows.select(F.col(key), F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"), F.lit(True).alias("kept"))
    some = classes.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) <= min(1.0, sample / n) * (1 << 20)).select("vector").toArrow()
    if not some.num_rows:
        some = classes.select("vector").limit(1).toArrow()
    index = Index(unit(_matrix(some.column(0), width)), int(min(CELLS, max(1, n // PER_CELL))), least)
    shared = spark.sparkContext.broadcast(index)  # bounded by CELLS and SAMPLE

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, VISITORS):
                now = b.slice(k, VISITORS)
                home, codes, missed, visits = shared.value.place(unit(_matrix(now.column(1), width)), probes)
                arrays = [*now.columns, pa.array(home, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(missed), pa.array([v.astype(np.int32) for v in visits], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "vector", "copies", "home", "codes", "missed", "probes"])

    placed = classes.select("id", "vector", "copies").mapInArrow(place, f"id long, vector array<{kind}>, copies long, home int, codes binary, missed double, probes array<int>")
    placed = stored(placed.withColumn("size", F.size("vector")))
    cuts = placed.groupBy("size", "home").agg(F.ceil(F.count("*") / PART).cast("int").alias("cuts"))
    cuts = stored(cuts).toDF("list_size", "cell", "cuts")
    visits = placed.withColumn("visited", F.explode("probes"))
    met = visits.join(cuts, (F.col("size") == F.col("list_size")) & (F.col("visited") == F.col("cell")))
    own = F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int")
    # a vector lies in one part of its home's list, and visits all parts of every list that it probes
    lies = F.when(F.col("home") == F.col("cell"), F.array(F.struct(own.alias("part"), F.lit(0).alias("visit")))).otherwise(F.array().cast("array<struct<part:int,visit:int>>"))
    goes = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda p: F.struct(p.alias("part"), F.lit(1).alias("visit")))
    dealt = met.withColumn("where", F.explode(F.concat(lies, goes))).select(
        "size", "cell", F.col("where.part").alias("part"), F.col("where.visit").alias("visit"), "id", "home", "copies", "codes", "missed", "probes", "vector"
    )
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = dealt.repartition(count, "size", "cell", "part").sortWithinPartitions("size", "cell", "part", "visit")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _compare(shared.value, width, least)(batches)

    found = stored(sorted_.mapInArrow(compare, "u long, v long, links long"))
    links = found.where("v IS NULL").groupBy(F.col("u").alias("at")).agg(F.sum("links").alias("links"))
    labels = components(found.where("v IS NOT NULL").select("u", "v")).toDF("node", "label")
    named = classes.select("id", "copies", "least").join(links, F.col("id") == F.col("at"), "left").join(labels, F.col("id") == F.col("node"), "left")
    total = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    named = stored(named.select("id", "least", total.cast("long").alias("n_links"), F.coalesce("label", "id").alias("label")))
    names = stored(named.groupBy("label").agg(F.min("least").alias("component_id")))
    known = stored(named.join(names, "label").select(F.col("id").alias("known"), "n_links", "component_id"))
    out = members.select("key", "id").join(known, F.col("id") == F.col("known"), "left")
    component = F.when(F.col("id").isNull(), F.col("key")).otherwise(F.col("component_id"))
    out = out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
