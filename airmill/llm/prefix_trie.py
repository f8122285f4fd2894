"""Prefix trie of conversations by the Euler-tour technique.

Turns of a conversation, in order, are a path from the textless root; conversations that start alike share nodes. What a subtree
holds (its leaves, the tokens that sharing saves) comes without recursion along the depth of the trie:

1. a node's identity is a running sum, over its path, of hashes of (place, role, text): 128 bits, kept as four sums of 32-bit parts.
   Running sums are distributed, so a conversation of any length is spread over many tasks;
2. every node has an enter and an exit arc. The tour goes from enter to the first child's enter, or to the own exit, and from exit
   to the next sibling's enter, or to the parent's exit. Children are numbered in (parent, conversation) order, so siblings follow
   each other by number and no group of children is held in one task;
3. the tour is list-ranked: blocks of arcs of neighbouring conversations are contracted to chains inside a task; while more than
   ``LIST`` chains are left, chains are merged into their predecessor by coin tosses (a quarter goes each round); the rest is ranked in
   one task of at most ``LIST`` rows, and the rounds are undone. Every round is a written table;
4. running sums of the leaves and the savings along the positions give, at a node's two arcs, the sums over its subtree.

The ids of the conversations that end in a node are hashed in order: they are range-partitioned by node and id, joined to pieces of
``PIECE`` ids, and the pieces stream through SHA-256. A digest is sequential by nature, so one task reads all pieces of a node, one
after the other and in little memory; all else about a hot node is spread.

Cases: rows without a ``conv_id`` belong to no conversation. Turns are ordered with nulls first, equal turns by role and then by text;
repeated rows are turns of their own. A null role or text is empty; an empty text has no tokens. Texts of any length are hashed whole.
An empty table has no nodes, not even a root. Only the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airmill.operators import ordered
from airmill.session import discard, stored

LIST, BLOCK, PIECE = 200_000, 100_000, 256
KEY = ["depth", "p1", "p2", "p3", "p4"]
END = -1


def in_order(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), ``role`` and ``text`` of every turn."""
    empty = F.lit("")
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"), F.lit(1).alias("place")
    )
    counted = ordered.running_totals(turns, ["turn", "role", "text"], ["place"], ["conv_id"])
    return counted.select("conv_id", F.col("place_run").alias("place"), "role", "text")


def _parts(*columns: Column) -> list[Column]:
    """Four 32-bit parts of two hashes."""
    both = [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]
    return [F.shiftrightunsigned(h, 32) for h in both] + [h.bitwiseAND(F.lit(0xFFFFFFFF)) for h in both]


def prefixes(turns: DataFrame) -> DataFrame:
    """Turns (``conv_id``, ``depth`` from 1, ``role``, ``text``) with the identity p1..p4 of their node, q1..q4 of its parent, and its tokens."""
    words = F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    parts = _parts(F.col("depth").cast("long"), F.col("role"), F.col("text"))
    hashed = turns.select("conv_id", F.col("depth").cast("long").alias("depth"), words.alias("tokens"), *[x.alias(f"h{i}") for i, x in enumerate(parts, 1)])
    summed = ordered.running_totals(hashed, ["depth"], ["h1", "h2", "h3", "h4"], ["conv_id"])
    p = [F.col(f"h{i}_run").alias(f"p{i}") for i in range(1, 5)]
    q = [(F.col(f"h{i}_run") - F.col(f"h{i}")).alias(f"q{i}") for i in range(1, 5)]
    return summed.select("conv_id", "depth", "tokens", *p, *q)


def _chain(ids: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First arc of each arc's chain inside the block, as a row number, and the distance to it."""
    order = np.argsort(ids)
    at = np.minimum(np.searchsorted(ids, follows, sorter=order), len(ids) - 1)
    target = order[at]
    inside = ids[target] == follows
    head, far = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    head[target[inside]] = np.flatnonzero(inside)
    far[target[inside]] = 1
    while True:
        onward = head[head]
        if np.array_equal(onward, head):
            return head, far
        far, head = far + far[head], onward


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arcs of one block (id, follows) -> their chain's first arc, the distance to it, and what follows the chain on its last arc."""
    got = list(batches)
    ids, follows = (np.concatenate([np.zeros(0, np.int64), *[b.column(k).to_numpy() for b in got]]) for k in (0, 1))
    if len(ids):
        head, far = _chain(ids, follows)
        last = ~np.isin(follows, ids)
        columns = [pa.array(ids), pa.array(ids[head]), pa.array(far), pa.array(follows, mask=~last)]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "head", "far", "next"])


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains (id, next, size) of the whole list -> the position of each one's first arc."""
    got = list(batches)
    ids, follows, size = (np.concatenate([np.zeros(0, np.int64), *[b.column(k).to_numpy() for b in got]]) for k in (0, 1, 2))
    if len(ids):
        order = np.argsort(ids)
        target = order[np.minimum(np.searchsorted(ids, follows, sorter=order), len(ids) - 1)]
        onward = np.where(follows == END, np.arange(len(ids)), target)
        after = np.where(follows == END, 0, size)  # arcs from this chain's start to the start of the last chain
        while not np.array_equal(onward, onward[onward]):
            after, onward = after + after[onward], onward[onward]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(after.max() - after)], names=["id", "start"])


def positions(arcs: DataFrame, near: list[str], limit: int = LIST, block: int = BLOCK) -> DataFrame:
    """``id`` and ``position`` from 0 of every arc (``id``, ``follows``; the last one's is END) of one list.

    Columns ``near`` tell which arcs probably follow each other; they decide speed only.
    """
    total = arcs.count()
    ranges = arcs.repartitionByRange(max(1, -(-total // block)), *near, "id")
    chains = stored(ranges.select("id", "follows").mapInArrow(_contract, "id long, head long, far long, next long"))
    rounds = []
    left = stored(chains.where("next IS NOT NULL").select(F.col("head").alias("id"), "next", (F.col("far") + 1).alias("size")))
    while left.count() > limit:
        heads = F.pmod(F.xxhash64("id", F.lit(len(rounds))), F.lit(2)) == 1
        kept = left.select("*", heads.alias("heads"))
        absorbed = kept.where("heads").select(F.col("id").alias("next"), F.col("next").alias("beyond"), F.col("size").alias("more"))
        met = kept.where("NOT heads").join(absorbed, "next", "left")
        joined = stored(kept.where("heads").select("id", "next", "size", F.lit(None).cast("long").alias("gone"), F.lit(None).cast("long").alias("far")).unionByName(
            met.select("id", F.coalesce("beyond", "next").alias("next"), (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"),
                       F.when(F.col("more").isNotNull(), F.col("next")).alias("gone"), F.when(F.col("more").isNotNull(), F.col("size")).alias("far"))))
        gone = stored(joined.where("gone IS NOT NULL").select(F.col("gone").alias("id"), F.col("id").alias("into"), "far"))
        rest = stored(joined.join(gone.select("id"), "id", "left_anti").select("id", "next", "size"))
        discard(left, joined)
        left = rest
        rounds.append(gone)
    starts = stored(left.repartition(1).mapInArrow(_ranked, "id long, start long"))  # at most ``limit`` rows
    discard(left)
    for gone in reversed(rounds):
        back = gone.join(starts.select(F.col("id").alias("into"), "start"), "into").select("id", (F.col("start") + F.col("far")).alias("start"))
        more = stored(starts.unionByName(back))
        discard(starts, gone)
        starts = more
    placed = stored(chains.join(starts.withColumnRenamed("id", "head"), "head").select("id", (F.col("start") + F.col("far")).alias("position")))
    discard(chains, starts)
    return placed


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of (node, chunk, piece) -> a digest per node."""
    now, state = None, None
    for b in batches:
        done = []
        for *key, text in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if key != now:
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=[*KEY, "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, state.hexdigest())], names=[*KEY, "ends_sha256"])


def _ends(ended: DataFrame) -> DataFrame:
    """The digest of the ids, in order, of the conversations that end in each node."""
    placed = ordered.ordered_chunks(ended.select(*KEY, "conv_id"), [*KEY, "conv_id"])
    piece = F.floor(F.col("pos") / PIECE)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = placed.groupBy(*KEY, "chunk", piece.alias("piece")).agg(ids.alias("ids"))  # PIECE ids at most
    streams = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "chunk", "piece").select(*KEY, "ids")
    return streams.mapInArrow(_digest, ", ".join(f"{c} long" for c in KEY) + ", ends_sha256 string")


def trie(convs: DataFrame, turns: DataFrame, limit: int = LIST, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, depth from 1 without gaps, role, text); ``convs`` (conv_id, n_turns) are all members.

    A node is named by its ``depth`` and its smallest member ``conv_id``; the rest is as the module says.
    """
    steps = stored(prefixes(turns))
    zero = [F.lit(0).cast("long").alias(c) for c in KEY]
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    nothing = F.lit(0).cast("long")
    root = top.select(*zero, *[nothing.alias(f"q{i}") for i in range(1, 5)], "conv_id", "n_convs", nothing.alias("tokens"))
    below = steps.groupBy(*KEY, "q1", "q2", "q3", "q4").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("tokens").alias("tokens"))
    nodes = stored(root.unionByName(below))

    parents = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(f"p{i}").alias(f"q{i}") for i in range(1, 5)], F.col("conv_id").alias("parent_conv_id"))
    named = nodes.join(parents, ["depth", "q1", "q2", "q3", "q4"], "left").select(*KEY, "conv_id", "parent_conv_id", "n_convs", "tokens")
    numbered = ordered.number_rows(named, ["depth", "parent_conv_id", "conv_id"]).withColumnRenamed("rn", "node")
    numbered = stored(numbered)
    children = numbered.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id")).agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n_children"))
    family = stored(numbered.join(children, ["depth", "conv_id"], "left").withColumn("n_children", F.coalesce("n_children", nothing)))
    above = family.select((F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.col("node").alias("parent"), (F.col("first") + F.col("n_children") - 1).alias("youngest"))
    linked = family.join(above, ["depth", "parent_conv_id"], "left")
    enter = F.struct((F.col("node") * 2).alias("id"), F.coalesce(F.col("first") * 2, F.col("node") * 2 + 1).alias("follows"))
    up = F.when(F.col("parent").isNull(), END).when(F.col("node") == F.col("youngest"), F.col("parent") * 2 + 1).otherwise(F.col("node") * 2 + 2)
    leave = F.struct((F.col("node") * 2 + 1).alias("id"), up.cast("long").alias("follows"))
    arcs = stored(linked.select("conv_id", "depth", F.explode(F.array(enter, leave)).alias("arc")).select("conv_id", "depth", "arc.*"))
    placed = positions(arcs, ["conv_id", "depth"], limit, block)

    gains = family.select((F.col("node") * 2).alias("id"), (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("tokens")).alias("saved"))
    tour = placed.join(gains, "id", "left").select("id", "position", F.coalesce("leaf", nothing).alias("leaf"), F.coalesce("saved", nothing).alias("saved"), F.floor(F.col("position") / block).alias("part"))
    tour = stored(tour)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per block of positions
    parts = tour.groupBy("part").agg(F.sum("leaf").alias("_leaf"), F.sum("saved").alias("_saved"))
    offsets = parts.select("part", *[F.coalesce(F.sum(f"_{c}").over(before), nothing).alias(f"{c}_before") for c in ("leaf", "saved")])
    inside = Window.partitionBy("part").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    sums = tour.join(offsets, "part").select("id", *[(F.sum(c).over(inside) + F.col(f"{c}_before")).alias(c) for c in ("leaf", "saved")], F.col("leaf").alias("own_leaf"), F.col("saved").alias("own_saved"))
    leaves = F.col("id") % 2 == 1
    signed = lambda c: F.sum(F.when(leaves, F.col(c)).otherwise(F.col(f"own_{c}") - F.col(c)))
    subtree = sums.groupBy(F.floor(F.col("id") / 2).alias("node")).agg(signed("leaf").alias("n_leaves"), signed("saved").alias("saved_tokens"))

    last = convs.select("conv_id", F.col("n_turns").cast("long").alias("depth"))
    ended = last.where("depth > 0").join(steps, ["conv_id", "depth"]).select(*KEY, "conv_id")
    ended = ended.unionByName(last.where("depth = 0").select(*zero, "conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    whole = family.join(subtree, "node").join(_ends(ended), KEY, "left")
    out = stored(whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")))
    discard(steps, nodes, numbered, family, arcs, placed, tour)
    return out


def rebuilt(conversations: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Members and turns after branching: the first h turns of conversation c - c % every, then c's own turns after its first h.

    h is the CRC-32 of c in decimal, modulo ``most``. So a common opening has at most ``every`` copies of at most ``most`` turns.
    """
    turns = stored(in_order(conversations))
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own"))
    heads = convs.select("*", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    bases = convs.select(F.col("conv_id").alias("base"), F.least("n_own", F.lit(most - 1)).alias("n_base"))
    plan = heads.join(bases, "base", "left").select("conv_id", "base", "h", "n_own", F.least("h", F.coalesce("n_base", F.lit(0))).alias("n_head"))
    plan = stored(plan.withColumn("n_turns", F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))))
    opening = turns.where((F.col("place") < most) & (F.col("conv_id") % every == 0)).select(F.col("conv_id").alias("base"), "place", "role", "text")
    shared = plan.join(opening, "base").where("place <= h").select("conv_id", F.col("place").alias("depth"), "role", "text")
    own = turns.join(plan, "conv_id").where("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("n_head")).alias("depth"), "role", "text")
    return plan.select("conv_id", "n_turns"), shared.unionByName(own)
