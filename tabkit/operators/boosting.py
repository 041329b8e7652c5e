"""Boosted trees with second-order statistics (M5, M9), many models in one pass (H3).

The logistic loss gives each row a gradient ``p - y`` and a hessian ``p (1 - p)``. A tree grows
level by level: one pass over the data sums both per (model, node, feature, bin), the sums meet in
one aggregate, and a window over the bins of a node's feature scores every cut by

    gain = GL^2 / (HL + l) + GR^2 / (HR + l) - G^2 / (H + l),    leaf = -rate * G / (H + l)

A cut needs a hessian sum of ``min_child_weight`` on both sides; rows with a missing value go to
the side of the larger gain. All models of a call share every pass: a grid of any number of points
costs as many passes as its deepest and longest one.

Results do not depend on how rows are dealt to tasks. Gradients are rounded to multiples of
1 / SCALE and summed as integers; a row takes part in a round by a hash of its key, the round and the
seed; bin edges come from the SAMPLE rows of the smallest hashes.

Rows lie in blocks of BLOCK_ROWS, as bytes of binned values, labels, hashes and one margin for each
model. Margins are written anew to the shared folder every ``rounds_per_write`` rounds, which
also cuts the lineage; passes between add the trees grown since. Only the best cut of each node
(at most models x 2^depth rows) reaches the driver, and trees go to the tasks as one broadcast,
whose size models, rounds_per_write and depth bound.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions.distributed import running_totals
from tabkit.functions.scalar import portable_hash
from tabkit.session import drop_path, scratch_path, ship_package

# The penalty on leaf weights and the least gain of a cut, as the usual boosting library has them.
LAMBDA = 1.0
LEAST_GAIN = 1e-6
LEAST_HESSIAN = 1e-16
#: Gradients count in steps of 1 / SCALE; sums are exact up to 8 * 10**12 rows.
SCALE = 1 << 20
#: Bins of a feature; one more holds missing values.
BINS, MISSING_BIN = 255, 255
#: Rows that bin edges are read from, at most (fewer where there are many features).
SAMPLE = 100_000
SAMPLE_VALUES = 20_000_000
BLOCK_ROWS = 8192
BLOCKS = "n int, bins binary, y binary, u binary, margins binary"
CELLS = "model int, node int, feature int, bin int, g long, h long"


@dataclass(frozen=True)
class Settings:
    """What a boosted model is trained with."""

    max_depth: int = 3
    learning_rate: float = 0.1
    n_estimators: int = 100
    min_child_weight: float = 1.0
    subsample: float = 1.0


class Tree:
    """A binary tree in heap order: node k has the children 2k+1 and 2k+2."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.feature = np.full(size, -1, np.int32)  # -1: a leaf
        self.cut = np.zeros(size, np.int32)  # bins up to the cut go left
        self.missing_left = np.zeros(size, bool)
        self.value = np.zeros(size)
        self.gain = np.zeros(size)

    def leaves(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node that each row has reached after ``levels`` cuts at most."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(levels):
            feature = self.feature[at]
            value = bins[rows, feature]  # a leaf reads some column and stays
            left = np.where(value == MISSING_BIN, self.missing_left[at], value <= self.cut[at])
            at = np.where(feature < 0, at, 2 * at + 2 - left)
        return at


@dataclass
class Booster:
    """A fitted model: settings, bin edges of each feature, trees."""

    settings: Settings
    edges: list
    trees: list = field(default_factory=list)

    def first(self, rounds: int) -> "Booster":
        return Booster(self.settings, self.edges, self.trees[:rounds])

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """M7: ``margin``, ``probability`` and ``prediction`` (class 1 above one half) of each row."""
        ship_package(df.sparkSession)
        trees, edges, depth = self.trees, self.edges, self.settings.max_depth

        @F.pandas_udf("double")
        def margin(values):
            import pandas as pd

            bins = binned(np.stack(values.to_numpy()) if len(values) else np.zeros((0, len(edges))), edges)
            total = np.zeros(len(bins))
            for tree in trees:
                total += tree.value[tree.leaves(bins, depth)]
            return pd.Series(total)

        out = df.withColumn("margin", margin(vector_to_array(F.col(features))))
        return out.withColumn("probability", 1 / (1 + F.exp(-F.col("margin")))).withColumn(
            "prediction", F.when(F.col("margin") > 0, 1.0).otherwise(0.0))


# ---------------------------------------------------------------- blocks of binned rows
def binned(values: np.ndarray, edges: list) -> np.ndarray:
    out = np.empty(values.shape, np.uint8)
    for k, e in enumerate(edges):
        out[:, k] = np.where(np.isnan(values[:, k]), MISSING_BIN, np.searchsorted(e, values[:, k], "left"))
    return out


def bin_edges(values: np.ndarray) -> list:
    """Per feature the cuts between neighbouring values, or between quantiles where there are more
    than BINS values."""
    out = []
    for column in values.T:
        seen = np.unique(column[np.isfinite(column)])
        if len(seen) > BINS:
            seen = np.unique(np.quantile(column[np.isfinite(column)], np.linspace(0, 1, BINS), method="inverted_cdf"))
        out.append(seen[:-1] + (seen[1:] - seen[:-1]) / 2)
    return out


def _keyed(df: DataFrame, features: str, label: str, key: str | None) -> DataFrame:
    """(u, y, x): a 32-bit hash of the row's key, its label and its features."""
    x = vector_to_array(F.col(features))
    u = F.pmod(F.xxhash64(x, F.col(label)), F.lit(1 << 32)) if key is None else F.coalesce(portable_hash(key), F.lit(0))
    return df.select(u.cast("long").alias("u"), F.col(label).cast("double").alias("y"), x.alias("x"))


def sampled_edges(df: DataFrame, n_features: int) -> list:
    bound = max(1, min(SAMPLE, SAMPLE_VALUES // max(n_features, 1)))
    rows = df.orderBy("u", "x").limit(bound).toArrow()  # at most SAMPLE_VALUES numbers
    return bin_edges(rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, n_features))


def to_blocks(df: DataFrame, edges: list, models: int) -> DataFrame:
    def run(batches):
        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False)
            if not np.isin(y, (0, 1)).all():
                raise ValueError("labels must be 0 or 1")
            values = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            bins, u = binned(values, edges), b.column(0).to_numpy().astype(np.uint32)
            cut = [slice(k, k + BLOCK_ROWS) for k in range(0, len(y), BLOCK_ROWS)]
            size = [len(y[c]) for c in cut]
            yield pa.RecordBatch.from_arrays(
                [pa.array(size, pa.int32()), *[pa.array([part.tobytes() for part in parts], pa.binary()) for parts in (
                    [bins[c] for c in cut], [y[c].astype(np.uint8) for c in cut], [u[c] for c in cut], [np.zeros((n, models)) for n in size])]],
                names=["n", "bins", "y", "u", "margins"])

    return df.mapInArrow(run, BLOCKS)


def read_blocks(batches):
    """(bins, y, u, margins) of each block."""
    for b in batches:
        n, bins, y, u, margins = (b.column(k).to_pylist() for k in range(5))
        for i in range(len(n)):
            yield (np.frombuffer(bins[i], np.uint8).reshape(n[i], -1), np.frombuffer(y[i], np.uint8).astype(np.float64),
                   np.frombuffer(u[i], np.uint32), np.frombuffer(margins[i], np.float64).reshape(n[i], -1))


def mixed(x: np.ndarray) -> np.ndarray:
    """The 32-bit finaliser of MurmurHash3."""
    x = x.astype(np.uint64)
    low = np.uint64(0xFFFFFFFF)
    x = ((x ^ (x >> np.uint64(16))) * np.uint64(0x85EBCA6B)) & low
    x = ((x ^ (x >> np.uint64(13))) * np.uint64(0xC2B2AE35)) & low
    return x ^ (x >> np.uint64(16))


def draws(u: np.ndarray, seed: int, round_: int) -> np.ndarray:
    """A number below 2**32 for each row, the same for equal keys: a row takes part in a round of a
    model if it is below subsample * 2**32."""
    return mixed(u.astype(np.uint64) ^ mixed(np.uint64([(seed * 65599 + round_) & 0xFFFFFFFF])))


# ---------------------------------------------------------------- one level
def level_cells(blocks: DataFrame, shared, seed: int, round_: int) -> DataFrame:
    """Gradient and hessian sums of one level, per task: rows of CELLS. ``shared`` broadcasts
    [(model, settings, trees since the margins were written, growing tree, level, open nodes)]."""
    def run(batches):
        sums: dict = {}
        work = shared.value
        for bins, y, u, margins in read_blocks(batches):
            n_features = bins.shape[1]
            spread = np.arange(n_features) * (BINS + 1)
            drawn = draws(u, seed, round_)
            for model, settings, trees, growing, level, nodes in work:
                keep = drawn < settings.subsample * 2.0 ** 32
                place = np.full(len(growing.feature), -1, np.int64)
                place[nodes] = np.arange(len(nodes))
                local = place[growing.leaves(bins, level)]
                rows = np.flatnonzero(keep & (local >= 0))
                if not len(rows):
                    continue
                part, m = bins[rows], margins[rows, model].copy()
                for tree in trees:
                    m += tree.value[tree.leaves(part, settings.max_depth)]
                p = 1 / (1 + np.exp(-m))
                g = np.rint((p - y[rows]) * SCALE)
                h = np.rint(np.maximum(p * (1 - p), LEAST_HESSIAN) * SCALE)
                cell = (local[rows, None] * (n_features * (BINS + 1)) + spread + part).ravel()
                size = len(nodes) * n_features * (BINS + 1)
                got = np.stack([np.bincount(cell, np.repeat(w, n_features), size) for w in (g, h)]).astype(np.int64)
                sums[model] = sums[model] + got if model in sums else got
        open_nodes = {w[0]: w[5] for w in work}
        for model, (g, h) in sums.items():
            at = np.flatnonzero((g != 0) | (h != 0))
            per = len(g) // len(open_nodes[model])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), model), pa.int32()), pa.array(np.asarray(open_nodes[model])[at // per], pa.int32()),
                 pa.array(at % per // (BINS + 1), pa.int32()), pa.array(at % (BINS + 1), pa.int32()), pa.array(g[at]), pa.array(h[at])],
                names=["model", "node", "feature", "bin", "g", "h"])

    return blocks.select("n", "bins", "y", "u", "margins").mapInArrow(run, CELLS)


def best_cuts(cells: DataFrame, weights: list) -> DataFrame:
    """(model, node, g, h, best): a node's totals and its best cut, a struct that is NULL where no
    cut is allowed. ``weights``: min_child_weight by model. Equal gains go to the first feature, then the
    lowest cut, then the right side for missing values."""
    least = ", ".join(f"{int(np.ceil(w * SCALE))}L" for w in weights)
    score = "cast({g} as double) / {s} * (cast({g} as double) / {s}) / (cast({h} as double) / {s} + {l})".format
    score_of = lambda g, h: score(g=g, h=h, s=f"{float(SCALE)}D", l=f"{LAMBDA}D")
    # one text: the plan of a level is small, and building it by calls would take longer than its job
    return cells.sparkSession.sql(f"""
        with bins as (  -- tasks have summed their own rows already: one shuffle brings a feature's bins together
            select model, node, feature, bin, sum(g) as g, sum(h) as h
            from (select /*+ repartition(model, node, feature) */ * from {{cells}}) group by model, node, feature, bin),
        scanned as (
            select model, node, feature, bin, sum(g) over whole as g, sum(h) over whole as h,
                   sum(if(bin = {MISSING_BIN}, g, 0L)) over whole as gm, sum(if(bin = {MISSING_BIN}, h, 0L)) over whole as hm,
                   sum(g) over upto as gl, sum(h) over upto as hl
            from bins window whole as (partition by model, node, feature),
                 upto as (partition by model, node, feature order by bin rows between unbounded preceding and current row)),
        sides as (
            select model, node, feature, bin, g, h, inline(array(
                struct(0 as missing_left, gl as gl, hl as hl, g - gl as gr, h - hl as hr),
                struct(1 as missing_left, gl + gm as gl, hl + hm as hl, g - gl - gm as gr, h - hl - hm as hr))) from scanned),
        cuts as (
            select *, {score_of("gl", "hl")} + {score_of("gr", "hr")} - ({score_of("g", "h")}) as gain,
                   bin <> {MISSING_BIN} and hl > 0 and hr > 0 and hl >= element_at(array({least}), model + 1)
                       and hr >= element_at(array({least}), model + 1) as allowed from sides)
        select model, node, max(g) as g, max(h) as h,
               max(if(allowed and gain > {LEAST_GAIN!r}D, struct(gain, -feature as feature, -bin as bin, -missing_left as missing_left, gl, hl), null)) as best
        from cuts group by model, node""", cells=cells)


def _leaf(g: float, h: float, settings: Settings) -> float:
    return -(g / SCALE) / (h / SCALE + LAMBDA) * settings.learning_rate


def grow_round(blocks: DataFrame, settings: list, active: list, since: list, seed: int, round_: int) -> dict:
    """One tree for each active model: {model: tree}. One job for each level."""
    spark = blocks.sparkSession
    trees = {m: Tree(settings[m].max_depth) for m in active}
    nodes = {m: [0] for m in active}
    for level in range(max(settings[m].max_depth for m in active)):
        work = [(m, settings[m], since[m], trees[m], level, nodes[m]) for m in active if nodes[m] and level < settings[m].max_depth]
        if not work:
            break
        shared = spark.sparkContext.broadcast(work)
        rows = best_cuts(level_cells(blocks, shared, seed, round_), [s.min_child_weight for s in settings]).collect()
        nodes = {m: [] for m in active}
        for r in rows:  # a row for each open node
            tree, s, k = trees[r.model], settings[r.model], r.node
            if level == 0:
                tree.value[0] = _leaf(r.g, r.h, s)
            if r.best is None:
                continue
            b = r.best
            tree.feature[k], tree.cut[k], tree.missing_left[k], tree.gain[k] = -b.feature, -b.bin, -b.missing_left == 1, b.gain
            tree.value[2 * k + 1], tree.value[2 * k + 2] = _leaf(b.gl, b.hl, s), _leaf(r.g - b.gl, r.h - b.hl, s)
            nodes[r.model] += [2 * k + 1, 2 * k + 2]
        shared.destroy()
    return trees


# ---------------------------------------------------------------- margins and scores
class _Margins:
    """Blocks with margins, in the shared folder; the last version is kept."""

    def __init__(self, blocks: DataFrame, name: str):
        self.spark, self.name, self.path, self.df = blocks.sparkSession, name, None, None
        self.put(blocks)

    def put(self, blocks: DataFrame):
        path = scratch_path(self.spark, self.name)
        blocks.write.parquet(path)
        old, old_df = self.path, self.df
        self.path = path
        self.df = self.spark.read.schema(BLOCKS).parquet(path).persist(StorageLevel.MEMORY_AND_DISK)
        if old:
            old_df.unpersist()
            drop_path(self.spark, old)

    def add(self, depths: list, since: list):
        """Write the margins with the trees grown since."""
        shared = self.spark.sparkContext.broadcast((depths, since))

        def run(batches):
            depths, since = shared.value
            for b in batches:
                out = []
                for bins, _, _, margins in read_blocks([b]):
                    margins = margins.copy()
                    for m, trees in enumerate(since):
                        for tree in trees:
                            margins[:, m] += tree.value[tree.leaves(bins, depths[m])]
                    out.append(margins.tobytes())
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(out, pa.binary())], names=["n", "bins", "y", "u", "margins"])

        self.put(self.df.mapInArrow(run, BLOCKS))
        shared.destroy()

    def close(self):
        self.df.unpersist()
        drop_path(self.spark, self.path)


def round_scores(val: DataFrame, depths: list, since: list, active: list, start: int, metric: str) -> list:
    """(model, round, value) of the rounds after ``start``, one for each tree in ``since``.

    "auc": margins are counted per task, class counts run in falling order over all tasks, and the
    area is a sum of integers, so equal rankings have equal areas. "loss": the mean log-loss, in
    steps of 1 / SCALE a row. A model whose rows have one class has no AUC."""
    shared = val.sparkSession.sparkContext.broadcast((depths, since, active))

    def run(batches):
        depths, since, active = shared.value
        for bins, y, _, margins in read_blocks(batches):
            for m in active:
                total = margins[:, m].copy()
                for k, tree in enumerate(since[m], 1):
                    total += tree.value[tree.leaves(bins, depths[m])]
                    if metric == "auc":
                        at, back = np.unique(total, return_inverse=True)
                        pos = np.bincount(back, y, len(at)).astype(np.int64)
                        rows = (at, pos, np.bincount(back, minlength=len(at)) - pos)
                    else:
                        loss = np.rint(np.logaddexp(0, np.where(y > 0, -total, total)) * SCALE)
                        rows = ([0.0], [int(loss.sum())], [len(y)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows[0]), m), pa.int32()), pa.array(np.full(len(rows[0]), start + k), pa.int32()),
                         *[pa.array(x, t) for x, t in zip(rows, (pa.float64(), pa.int64(), pa.int64()))]], names=["model", "round", "score", "p", "n"])

    counts = val.mapInArrow(run, "model int, round int, score double, p long, n long")
    if metric == "loss":
        rows = counts.groupBy("model", "round").agg((F.sum("p") / F.sum("n") / SCALE).alias("value"))
    else:
        wide = "decimal(38,0)"  # the product of class counts leaves 64 bits
        totals = running_totals(counts.groupBy("model", "round", "score").agg(F.sum("p").alias("p"), F.sum("n").alias("n")),
                                "score", ["p", "n"], descending=True, group_cols=["model", "round"])
        twice = (F.col("n").cast("decimal(19,0)") * (2 * F.col("cum_p") - F.col("p")).cast("decimal(19,0)")).cast(wide)
        both = F.first("tot_p").cast("double") * F.first("tot_n").cast("double")
        rows = totals.groupBy("model", "round").agg((F.sum(twice).cast("double") / 2 / F.nullif(both, F.lit(0.0))).alias("value"))
    got = [(r.model, r["round"], r.value) for r in rows.collect()]  # a row for each model and round
    shared.destroy()
    return got


# ---------------------------------------------------------------- training
def fit_many(train: DataFrame, settings: list, val: DataFrame | None = None, patience: int | None = None, metric: str = "auc",
             features: str = "features", label: str = "label", key: str | None = None, seed: int = 42, rounds_per_write: int = 8):
    """Train one model for each of ``settings``, all in the same passes: (boosters, scores, seconds).

    With ``val`` every round of every model is scored there, (model, round, value), and with
    ``patience`` a model stops growing once its best round is that many rounds ago. ``key`` names the
    column whose hash decides which rows a round takes; without it the hash is of the row's values.
    ``seconds``: when each model stopped growing, from the start of the call.
    """
    began, seconds = time.time(), [0.0] * len(settings)
    spark = train.sparkSession
    ship_package(spark)
    rows = _keyed(train, features, label, key).persist(StorageLevel.MEMORY_AND_DISK)
    scores, best, states = [], {}, []
    try:
        first = rows.first()
        if first is None:
            raise ValueError("no rows to train on")
        edges = sampled_edges(rows, len(first.x))
        state = _Margins(to_blocks(rows.select("u", "y", "x"), edges, len(settings)), "boost-train")
        states.append(state)
        rows.unpersist()
        held = None
        if val is not None:
            held = _Margins(to_blocks(_keyed(val, features, label, key), edges, len(settings)), "boost-val")
            states.append(held)
        boosters = [Booster(s, edges) for s in settings]
        depths, since = [s.max_depth for s in settings], [[] for _ in settings]
        done, active = 0, [m for m, s in enumerate(settings) if s.n_estimators > 0]
        while active:
            until = done + min(rounds_per_write, min(settings[m].n_estimators for m in active) - done)
            for round_ in range(done + 1, until + 1):
                for m, tree in grow_round(state.df, settings, active, since, seed, round_).items():
                    since[m].append(tree)
                    boosters[m].trees.append(tree)
            if held is not None:
                got = round_scores(held.df, depths, since, active, done, metric)
                scores += got
                for m, r, value in sorted(got, key=lambda x: x[1]):
                    worth = None if value is None else value if metric == "auc" else -value
                    if m not in best or (worth is not None and worth > best[m][0]):
                        best[m] = (worth if worth is not None else -np.inf, r)
            done = until
            going = [m for m in active if settings[m].n_estimators > done and not (
                patience and m in best and done - best[m][1] >= patience)]
            if going:
                state.add(depths, since)
                if held is not None:
                    held.add(depths, since)
            for m in set(active) - set(going):
                seconds[m] = time.time() - began
            since = [[] for _ in settings]
            active = going
        return boosters, scores, seconds
    finally:
        rows.unpersist()
        for s in states:
            s.close()


def fit(train: DataFrame, settings: Settings = Settings(), **kw) -> Booster:
    """M5: one boosted model."""
    return fit_many(train, [settings], **kw)[0][0]


def gain_importance(booster: Booster, names: list[str], n: int = 10) -> DataFrame:
    """M9: (feature, splits, total_gain, importance) of the ``n`` features of the largest mean gain a
    split; ``importance`` is that mean, scaled so that all features sum to 1."""
    total, splits = np.zeros(len(names)), np.zeros(len(names), np.int64)
    for tree in booster.trees:
        inner = tree.feature >= 0
        np.add.at(total, tree.feature[inner], tree.gain[inner])
        np.add.at(splits, tree.feature[inner], 1)
    mean = np.divide(total, splits, out=np.zeros(len(names)), where=splits > 0)
    share = mean / mean.sum() if mean.sum() > 0 else mean
    rows = [(name, int(s), float(t), float(i)) for name, s, t, i in zip(names, splits, total, share)]
    df = SparkSession.getActiveSession().createDataFrame(rows, "feature string, splits long, total_gain double, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(n)
