"""Scaler and isolation forest: fit, score, cut-off, permutation importance.

The algorithm is the published one (Liu, Ting, Zhou: Isolation Forest, ICDM 2008). A fit needs only a fixed number of
rows per tree: their positions in key order are known before any scan (``shuffles.places``), a bounded table of positions picks them, and
every tree is grown in its own task. All draws are integer arithmetic, so another engine grows the same trees. A fitted model is a table
with a bounded number of nodes; scoring sends it to the executors once and streams Arrow batches of the feature columns
through a vectorised walk, while all other columns stay in the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airmill import constants as K
from airmill.operators.ordered import number_rows, ordered_chunks
from airmill.operators.quality import drop_nulls, require_columns
from airmill.operators.quantiles import quantile
from airmill.operators.shuffles import PRIME, draw, place, places
from airmill.session import discard, stored

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, path double, sample_size int"
)
# Largest model that is sent to the executors.
MAX_NODES = 1_000_000
MAX_FEATURES = 10_000
# Rows walked together; rows x trees intermediate values stay in the processor cache.
_WALK_ROWS = 512
# Stream of random numbers of the permutation; trees use their own numbers.
PERMUTATION = 1_000_003


# --- scaler ------------------------------------------------------------------------------------------------------


def fit_scaler(df: DataFrame, features: Sequence[str] = K.SENSOR_COLUMNS) -> DataFrame:
    """(position, feature, mean, scale, rows): mean and population deviation; a deviation of 0 becomes 1."""
    one = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(f).alias(f"{f}_mean") for f in features],
        *[F.stddev_pop(f).alias(f"{f}_std") for f in features],
    )
    items = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f).alias("feature"),
            F.col(f"{f}_mean").alias("mean"),
            F.when(F.col(f"{f}_std") == 0, 1.0).otherwise(F.col(f"{f}_std")).alias("scale"),
            F.col("rows"),
        )
        for i, f in enumerate(features)
    ]
    return one.select(F.explode(F.array(*items)).alias("item")).select("item.*")


def scale_features(df: DataFrame, scaler: DataFrame, features: Sequence[str] = K.SENSOR_COLUMNS) -> DataFrame:
    """Add ``<feature>_scaled``. The scaler (one row per feature) enters as a scalar subquery."""
    require_columns(df, features)
    entry = F.struct("feature", F.struct("mean", "scale"))
    params = scaler.agg(F.map_from_entries(F.collect_list(entry)).alias("params")).scalar()
    ready = df.withColumn("_params", params)
    scaled = {
        f"{f}_scaled": (F.col(f) - F.col("_params")[f]["mean"]) / F.col("_params")[f]["scale"] for f in features
    }
    return ready.withColumns(scaled).drop("_params")


# --- model -------------------------------------------------------------------------------------------------------


@dataclass
class ForestModel:
    """A fitted forest on the driver: a few thousand nodes, the scaler and the cut-off."""

    features: list[str]
    mean: np.ndarray
    scale: np.ndarray
    feature: np.ndarray  # per node, all trees one after the other; 0 for leaves
    threshold: np.ndarray  # +inf for leaves, so that a walk stays there
    child: np.ndarray  # left child, the right child follows it; a leaf points to itself
    path: np.ndarray
    roots: np.ndarray
    subsample: int
    depth: int
    offset: float = -0.5

    def score_array(self, x: np.ndarray) -> np.ndarray:
        """-2^(-mean path / normaliser) per row of raw features; walks all trees level by level in small blocks."""
        normaliser = average_path_length(self.subsample)
        out = np.empty(len(x))
        for start in range(0, len(x), _WALK_ROWS):
            part = (x[start : start + _WALK_ROWS] - self.mean) / self.scale
            base = (np.arange(len(part), dtype=np.int32) * part.shape[1])[:, None]
            flat = np.ascontiguousarray(part).ravel()
            at = np.repeat(self.roots[None, :], len(part), axis=0)
            for _ in range(self.depth):
                value = flat.take(base + self.feature.take(at, mode="clip"), mode="clip")
                at = self.child.take(at, mode="clip") + (value > self.threshold.take(at, mode="clip"))
            out[start : start + _WALK_ROWS] = -np.exp2(-self.path.take(at).mean(axis=1) / normaliser)
        return out


def average_path_length(n: int) -> float:
    """Expected path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + K.EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _grow_tree(tree: int, x: np.ndarray, seed: int) -> pd.DataFrame:
    """Nodes of one tree over at most ``SUBSAMPLE`` rows: random non-constant feature, uniform threshold.

    A node draws by its number in a full binary tree (root 1, children 2h and 2h + 1), nodes are listed parents first and left first.
    """
    limit = math.ceil(math.log2(max(len(x), 2)))
    nodes: list[list] = []
    todo = [(np.arange(len(x)), 0, -1, 1)]
    while todo:
        rows, depth, parent, heap = todo.pop()
        number = len(nodes)
        if parent >= 0:
            nodes[parent][4 + heap % 2] = number
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(usable) == 0:
            nodes.append([tree, number, -1, 0.0, -1, -1, depth + average_path_length(len(rows)), len(x)])
            continue
        feature = int(usable[draw(seed, tree, heap, 0) * len(usable) // PRIME])
        share = (draw(seed, tree, heap, 1) + 0.5) / PRIME
        threshold = float(low[feature] + (high[feature] - low[feature]) * share)
        threshold = float(low[feature]) if threshold >= high[feature] else threshold
        nodes.append([tree, number, feature, threshold, -1, -1, 0.0, len(x)])
        goes_left = x[rows, feature] <= threshold
        todo.append((rows[~goes_left], depth + 1, number, 2 * heap + 1))
        todo.append((rows[goes_left], depth + 1, number, 2 * heap))
    columns = ["tree", "node", "feature", "threshold", "left", "right", "path", "sample_size"]
    return pd.DataFrame(nodes, columns=columns)


def tree_samples(
    df: DataFrame,
    key: str,
    rows: int,
    n_trees: int = K.N_TREES,
    subsample: int = K.SUBSAMPLE,
    seed: int = K.SEED,
) -> DataFrame:
    """(tree, rows of df): min(subsample, rows) different rows per tree, a stored table.

    A tree takes the first rows of its own permutation of all positions in ``key`` order. The (tree, position) table has
    ``n_trees * subsample`` rows whatever the data, so it is broadcast; rows are ordered once and not ranked per tree.
    """
    placed = ordered_chunks(df, [key])
    sizes = {r["chunk"]: r["n"] for r in placed.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per range
    chunks = sorted(sizes)
    ends = np.cumsum([sizes[c] for c in chunks])
    wanted = []
    for tree in range(n_trees if len(chunks) else 0):
        at = places(np.arange(min(subsample, rows), dtype=np.int64), rows, seed, tree)
        spot = np.searchsorted(ends, at, "right")
        wanted += [(tree, chunks[s], int(p - (ends[s] - sizes[chunks[s]]))) for s, p in zip(spot, at, strict=True)]
    picks = df.sparkSession.createDataFrame(wanted, "tree int, chunk int, pos long")
    out = stored(placed.join(F.broadcast(picks), ["chunk", "pos"]).drop("chunk", "pos"))
    discard(placed)
    return out


def fit_forest(
    df: DataFrame,
    scaler: DataFrame,
    key: str,
    features: Sequence[str] = K.SENSOR_COLUMNS,
    n_trees: int = K.N_TREES,
    subsample: int = K.SUBSAMPLE,
    seed: int = K.SEED,
) -> DataFrame:
    """Node table of a new forest over scaled features (``NODE_SCHEMA``). ``key`` must identify a row."""
    rows = scaler.select("rows").first()[0]
    sampled = tree_samples(df.select(key, *features), key, rows, n_trees, subsample, seed)
    names = [f"{f}_scaled" for f in features]

    def grow(group: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values(key)[names].to_numpy(dtype=float)
        return _grow_tree(int(group[0]), ordered, seed)

    return scale_features(sampled, scaler, features).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def load_model(nodes: DataFrame, scaler: DataFrame) -> ForestModel:
    """Collect a node table into arrays; refuses anything that is not model-sized. The offset comes with the scaler."""
    table = nodes.limit(MAX_NODES + 1).toPandas()
    if len(table) > MAX_NODES:
        raise ValueError("node table is too large for a model")
    params = scaler.orderBy("position").limit(MAX_FEATURES + 1).toPandas()
    if len(params) > MAX_FEATURES:
        raise ValueError("parameter table is too large for a model")
    table = table.sort_values(["tree", "node"], ignore_index=True)
    # nodes of a tree are numbered from 0, so a row number minus its node number is the row of the root
    root_row = table.index.to_numpy() - table["node"].to_numpy()
    split = (table["feature"] >= 0).to_numpy()
    left, right = root_row + table["left"].to_numpy(), root_row + table["right"].to_numpy()
    # siblings side by side: a walk then needs one pointer per node
    order, roots = [], []
    for row in np.unique(root_row):
        roots.append(len(order))
        order.append(row)
        open_rows = [row]
        while open_rows:
            row = open_rows.pop()
            if split[row]:
                order.extend((left[row], right[row]))
                open_rows.extend((left[row], right[row]))
    position = np.empty(len(table), dtype=np.int32)
    position[order] = np.arange(len(order), dtype=np.int32)
    placed, inner = table.iloc[order], split[order]
    child = np.where(inner, position[np.where(split, left, 0)][order], np.arange(len(order)))
    subsample = int(table["sample_size"].max())
    return ForestModel(
        features=params["feature"].tolist(),
        mean=params["mean"].to_numpy(dtype=float),
        scale=params["scale"].to_numpy(dtype=float),
        feature=np.where(inner, placed["feature"].to_numpy(), 0).astype(np.int32),
        threshold=np.where(inner, placed["threshold"].to_numpy(dtype=float), np.inf),
        child=child.astype(np.int32),
        path=placed["path"].to_numpy(dtype=float),
        roots=np.array(roots, dtype=np.int32),
        subsample=subsample,
        depth=math.ceil(math.log2(max(subsample, 2))),
        offset=float(params["offset"].iloc[0]) if "offset" in params else -0.5,
    )


def score_column(df: DataFrame, model: ForestModel) -> Column:
    """Score of the model's feature columns (lower = more anomalous)."""
    shared = df.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf(T.DoubleType())
    def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        local = ForestModel(**shared.value)
        for columns in parts:
            yield pd.Series(local.score_array(np.column_stack([c.to_numpy(dtype=float) for c in columns])))

    return score(*[F.col(f) for f in model.features])


def score(df: DataFrame, model: ForestModel) -> DataFrame:
    """Add anomaly_score; rows with a null feature are not scored (they are removed before)."""
    require_columns(df, model.features)
    ready = drop_nulls(df, model.features)
    return ready.withColumn("anomaly_score", score_column(ready, model))


def with_prediction(df: DataFrame, offset: Column | float) -> DataFrame:
    """decision_score = score - offset, prediction -1 below 0 else 1, is_anomaly, and the sign-flipped outlierness."""
    cut = offset if isinstance(offset, Column) else F.lit(float(offset))
    decision = F.col("anomaly_score") - cut
    out = df.withColumn("decision_score", decision)
    out = out.withColumn("prediction", F.when(F.col("decision_score") < 0, F.lit(-1)).otherwise(F.lit(1)))
    return out.withColumns(
        {"is_anomaly": (F.col("prediction") == -1).cast("int"), "outlierness": -F.col("anomaly_score")}
    )


def contamination(rate: Column) -> Column:
    """Training contamination from the observed label rate."""
    low, high = K.CONTAMINATION_RANGE
    return F.least(F.greatest(rate, F.lit(low)), F.lit(high))


def cutoff(scored: DataFrame, share: float) -> DataFrame:
    """One row ``q``: the score quantile at the contamination."""
    return quantile(scored, "anomaly_score", share)


def train_tables(
    df: DataFrame,
    key: str,
    label: str = "is_anomaly",
    features: Sequence[str] = K.SENSOR_COLUMNS,
    n_trees: int = K.N_TREES,
    subsample: int = K.SUBSAMPLE,
    seed: int = K.SEED,
    rate: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Node table and parameter table (scaler rows with contamination and offset) from a labelled training set.

    ``rate`` is the label rate of the whole labelled set, of which ``df`` may be a split; without it the rate of ``df``.

    Training rows, nodes and training scores are stored: all are read more than once.
    """
    usable = stored(drop_nulls(df.select(key, label, *features), features))
    scaler = stored(fit_scaler(usable, features))
    nodes = stored(fit_forest(usable, scaler, key, features, n_trees, subsample, seed))
    model = load_model(nodes, scaler)
    share = usable.select(contamination(F.avg(label) if rate is None else F.lit(float(rate))).alias("c")).first()[0]
    scores = stored(score(usable.select(*features), model).select("anomaly_score"))
    offset = cutoff(scores, share).first()[0]
    return nodes, scaler.withColumns({"contamination": F.lit(share), "offset": F.lit(offset)})


def train(df: DataFrame, key: str, **options) -> ForestModel:
    """``train_tables`` as a loaded model."""
    return load_model(*train_tables(df, key, **options))


def write_model(nodes: DataFrame, params: DataFrame, path: str) -> None:
    """Store a model; the parameters come last, so a folder with parameters is complete."""
    nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    params.coalesce(1).write.mode("overwrite").parquet(f"{path}/params")


def read_model(spark: SparkSession, path: str) -> ForestModel:
    return load_model(spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/params"))


# --- literal forests ------------------------------------------------------------------------------------------------


def box_score(boxes: Sequence[tuple], subsample: int = K.SUBSAMPLE) -> Column:
    """Score of a small literal forest as one native expression.

    ``boxes`` are (tree, leaf, t_lo, t_hi, g_lo, g_hi, path) rows; the leaves of a tree tile the plane. The model is
    compiled into CASE branches, so rows are neither joined nor shuffled.
    """
    t, g = F.col("temperature"), F.col("gas_resistance")
    trees = sorted({b[0] for b in boxes})
    total = F.lit(0.0)
    for tree in trees:
        path = F
        for _, _, t_lo, t_hi, g_lo, g_hi, length in (b for b in boxes if b[0] == tree):
            inside = (t > t_lo) & (t <= t_hi) & (g > g_lo) & (g <= g_hi)
            path = path.when(inside, F.lit(float(length)))
        total = total + path
    return -F.pow(F.lit(2.0), -(total / len(trees)) / average_path_length(subsample))


# --- permutation importance -----------------------------------------------------------------------------------------


def permuted_features(df: DataFrame, features: Sequence[str], key: str, seed: int = K.SEED) -> DataFrame:
    """Add ``<feature>_permuted``, the value of another random row.

    Rows are numbered in ``key`` order; row p takes the values of row sigma(p), sigma being one permutation of the whole table, by one
    join on the position, whose keys are all different.
    """
    numbered = stored(number_rows(df, [key]))
    rows = numbered.agg(F.max("rn")).first()[0]
    sent = numbered.withColumn("_from", place(F.col("rn"), 1 if rows is None else rows + 1, seed, PERMUTATION))
    other = numbered.select(F.col("rn").alias("_from"), *[F.col(f).alias(f"{f}_permuted") for f in features])
    return sent.join(other, "_from").drop("_from", "rn")


def permutation_importance(
    df: DataFrame, model: ForestModel, key: str, seed: int = K.SEED
) -> DataFrame:
    """(feature, importance): mean absolute score change when one feature is permuted, 4 decimals.

    All variants of a row are scored in the same batch.
    """
    features = model.features
    ready = drop_nulls(df, features).select(key, *features)
    mixed = permuted_features(ready, features, key, seed)
    shared = df.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def changes(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        local, n = ForestModel(**shared.value), len(features)
        for columns in parts:
            table = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            plain, other = table[:, :n], table[:, n:]
            base = local.score_array(plain)
            moved = np.empty((len(table), n))
            for i in range(n):
                variant = plain.copy()
                variant[:, i] = other[:, i]
                moved[:, i] = np.abs(local.score_array(variant) - base)
            yield pd.Series(list(moved))

    columns = [F.col(f) for f in features] + [F.col(f"{f}_permuted") for f in features]
    moved = mixed.select(changes(*columns).alias("moved"))
    one = moved.agg(*[F.avg(F.col("moved")[i]).alias(f) for i, f in enumerate(features)])
    return one.unpivot([], list(features), "feature", "importance").withColumn("importance", F.round("importance", 4))
