"""Random forests of many settings and folds grown in the same passes (H1).

The trees are those of MLlib's ``RandomForestClassifier``: gini impurity, bins from the same sampled
quantiles (``RandomForest.findSplits`` itself is called), the same bootstrap draws, the same feature subsets
and the same choice among equal gains. MLlib fits one forest after another, each with bagged points of its own
as Java objects, some 430 bytes a row, which are read again for each level. Here all
forests share compact rows: one 16-bit code per feature, from which a table gives each forest's bin, and
per live forest a byte of weight and a 16-bit node number for each tree.

* Weights. MLlib draws Poisson(1) numbers from a generator seeded with ``seed + partition + 1``, one a
  tree for each training row of the partition. ``sampleByKey`` seeds the same generator with ``seed +
  partition``, so one call gives every forest's draws: they are the first numbers of one stream.
* A pass moves each row below the nodes that were cut last and counts (node, feature, bin, class) for the
  next group of nodes of each forest; a shuffle brings a chunk of nodes together and numpy picks the cuts.
  Only the cuts reach the driver. Rows are written anew by each pass to the shared folder.
* Groups. MLlib takes nodes off a stack up to ``maxMemoryInMB`` of counts and draws each one's features as it
  does so. The stack is followed exactly, as the draws depend on its order.

What MLlib does beyond this (categorical features, weights, other impurities, deeper trees) is left to it:
see ``grows``.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.operators.splits import training_folds
from tabkit.session import drop_path, scratch_path, ship_package

# MLlib's maxMemoryInMB, the depth to which a 16-bit node number reaches, limits of the codes.
GROUP_BYTES = 256 << 20
MAX_DEPTH, MAX_BINS, MAX_CLASSES = 16, 1024, 1000
EPSILON = 2.0 ** -52
#: Rows of a block at most; counts of all forests of a pass in a task (4 bytes each) and of a chunk.
BLOCK_ROWS, BLOCK_CODES = 4096, 1_000_000
PASS_CELLS, CHUNK_CELLS = 40_000_000, 1 << 17
#: Bytes that a task of a pass reads, about, and bytes of a row group, which readers hold whole.
TASK_BYTES, GROUP_OF_ROWS = 256 << 20, 16 << 20
#: MLlib's least number of sampled rows that cuts are read from.
SAMPLE = 10_000
DRAWN = "part int, block int, draws binary"
BLOCKS = "part int, block int, n int, kept array<int>, codes binary, y binary, fold binary"
STATE = "n int, codes binary, y binary, fold binary, weights array<binary>, nodes array<binary>"
PASS = STATE + ", model int, chunk int, cell binary, count binary"
CUTS = "model int, chunk int, feature binary, cut binary, left binary, right binary"


def grows(df: DataFrame, settings: list[tuple], features: str, label: str, rf_kwargs: dict) -> bool:
    """Whether this module grows what MLlib would."""
    if set(rf_kwargs) - {"featureSubsetStrategy", "bootstrap", "cacheNodeIds"}:
        return False
    if rf_kwargs.get("featureSubsetStrategy", "auto") not in ("auto", "all", "sqrt"):
        return False
    if any(nt < 1 or not 0 <= md <= MAX_DEPTH or not 2 <= mb <= MAX_BINS for nt, md, mb in settings):
        return False
    schema, jvm = df._jdf.schema(), df.sparkSession._jvm
    meta = getattr(getattr(jvm.org.apache.spark.ml.util, "MetadataUtils$"), "MODULE$")
    return meta.getCategoricalFeatures(schema.apply(features)).isEmpty() and not df.schema[label].metadata.get("ml_attr")


# ---------------------------------------------------------------- the generators MLlib draws with
class JavaRandom:
    """``java.util.Random``: one ``nextLong`` a node."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def longs(self, n: int) -> tuple[np.ndarray, list]:
        """The next ``n`` longs (as unsigned) and the state after each; the own state stays."""
        out, states, s, low48 = [], [], self.state, (1 << 48) - 1
        for _ in range(n):
            s = (s * 0x5DEECE66D + 0xB) & low48
            high = s >> 16
            s = (s * 0x5DEECE66D + 0xB) & low48
            low = s >> 16
            out.append(((high << 32) + low - ((low >> 31) << 32)) & 0xFFFFFFFFFFFFFFFF)
            states.append(s)
        return np.array(out, np.uint64), states


def _murmur(words: list, seed) -> np.ndarray:
    def rotated(x, by):
        return (x << np.uint32(by)) | (x >> np.uint32(32 - by))

    h = seed
    for k in words:
        k = rotated(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = rotated(h ^ k, 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h = h ^ np.uint32(4 * len(words))
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def feature_subsets(seeds: np.ndarray, n_features: int, size: int) -> np.ndarray:
    """MLlib's reservoir sample of ``size`` features for each seed, in the reservoir's order."""
    words = [(seeds >> np.uint64(32)).astype(np.uint32).byteswap(), seeds.astype(np.uint32).byteswap()]
    low = _murmur(words, np.full(len(seeds), 0x3C074A61, np.uint32))
    state = (_murmur(words, low).astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)

    def following(bits):
        nonlocal state
        state = state ^ (state << np.uint64(21))
        state = state ^ (state >> np.uint64(35))
        state = state ^ (state << np.uint64(4))
        return state & np.uint64((1 << bits) - 1)

    out = np.tile(np.arange(size, dtype=np.int64), (len(seeds), 1))
    for f in range(size, n_features):
        high = following(26)
        at = (((high << np.uint64(27)) + following(27)).astype(np.float64) * 2.0 ** -53 * (f + 1)).astype(np.int64)
        hit = np.flatnonzero(at < size)
        out[hit, at[hit]] = f
    return out


# ---------------------------------------------------------------- a forest on the driver
@dataclass
class Group:
    """Nodes whose counts are taken together: tree, number, features and where each feature's counts begin."""

    tree: np.ndarray
    node: np.ndarray
    subset: np.ndarray
    offset: np.ndarray  # (nodes, features of a node)
    bounds: np.ndarray  # first node of each chunk, and the end
    starts: np.ndarray  # first cell of each chunk, and the end
    cells: int


@dataclass
class Forest:
    """One setting on one fold. ``feature``, ``cut`` and ``counts`` by (tree, heap number), the root is 1."""

    model: int
    fold: int
    trees: int
    depth: int
    thresholds: list
    classes: int
    n_classes: int  # of this fold's training rows
    per_node: int
    seed: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    counts: np.ndarray = field(init=False)

    def __post_init__(self):
        size = 2 << self.depth
        self.feature = np.full((self.trees, size), -1, np.int16)
        self.cut = np.zeros((self.trees, size), np.int16)
        self.counts = np.zeros((self.trees, size, self.classes), np.int64)
        self.bins = np.array([len(t) + 1 for t in self.thresholds])
        self.random = JavaRandom(self.seed)
        self.stack = [(t, 1) for t in range(self.trees)]  # its end is the top
        self.moves: tuple | None = None
        self.group: Group | None = None

    def select(self) -> Group | None:
        """The next group off the stack, as MLlib's ``selectNodesToSplit`` takes it."""
        if not self.stack:
            self.group = None
            return None
        sampled = self.per_node < len(self.bins)
        most = len(self.stack)
        if sampled:
            least = np.sort(self.bins)[: self.per_node].sum()
            most = min(most, GROUP_BYTES // int(8 * self.n_classes * least) + 2)
            seeds, states = self.random.longs(most)
            subset = feature_subsets(seeds, len(self.bins), self.per_node)
        else:
            subset = np.tile(np.arange(len(self.bins)), (most, 1))
        used = np.cumsum(8 * self.n_classes * self.bins[subset].sum(1))
        taken = max(1, int(np.searchsorted(used, GROUP_BYTES, "right")))
        if sampled:  # a node that found no room has drawn, and draws again
            self.random.state = states[min(taken + 1, len(states)) - 1]
        nodes = [self.stack.pop() for _ in range(taken)]
        subset = subset[:taken]
        size = self.bins[subset] * self.classes
        ends = np.cumsum(size.ravel())
        offset = (ends - size.ravel()).reshape(size.shape)
        bounds = [0]
        for i, start in enumerate(offset[:, 0].tolist()):
            if start - offset[bounds[-1], 0] >= CHUNK_CELLS:
                bounds.append(i)
        starts = np.append(offset[bounds, 0], ends[-1])
        self.group = Group(np.array([t for t, _ in nodes], np.int64), np.array([i for _, i in nodes], np.int64), subset,
                           offset, np.array([*bounds, taken]), starts, int(ends[-1]))
        return self.group

    def split(self, feature, cut, left, right, tree_order) -> None:
        """Record the group's cuts and push the children in MLlib's order."""
        g = self.group
        level = np.floor(np.log2(g.node)).astype(int)
        inner = (feature >= 0) & (level < self.depth)
        root = g.node == 1
        self.counts[g.tree[root], 1] = (left + right)[root]
        at = np.flatnonzero(inner)
        self.feature[g.tree[at], g.node[at]] = feature[at]
        self.cut[g.tree[at], g.node[at]] = cut[at]
        self.counts[g.tree[at], 2 * g.node[at]] = left[at]
        self.counts[g.tree[at], 2 * g.node[at] + 1] = right[at]
        grow_l, grow_r = ((level + 1 < self.depth) & (np.abs(gini(c)) >= EPSILON) & inner for c in (left, right))
        # where rows of each node go on: feature, cut, the children's numbers, 0 for a leaf
        self.moves = (g.tree, g.node, np.stack([np.maximum(feature, 0), cut, np.where(grow_l, 2 * g.node, 0), np.where(grow_r, 2 * g.node + 1, 0)], 1))
        by_tree: dict = {}
        for i, t in enumerate(g.tree.tolist()):
            by_tree.setdefault(t, []).append(i)
        node, grow_l, grow_r = g.node.tolist(), grow_l.tolist(), grow_r.tolist()
        for t in tree_order(by_tree):
            for i in by_tree[t]:
                if grow_l[i]:
                    self.stack.append((t, 2 * node[i]))
                if grow_r[i]:
                    self.stack.append((t, 2 * node[i] + 1))

    def pruned(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(feature, cut, votes) once leaves of one parent that predict the same class are one leaf."""
        feature, counts = self.feature.copy(), self.counts
        predicted = counts.argmax(2)
        for level in range(self.depth - 1, -1, -1):
            at = np.arange(1 << level, 2 << level)
            same = ((feature[:, at] >= 0) & (feature[:, 2 * at] < 0) & (feature[:, 2 * at + 1] < 0)
                    & (predicted[:, 2 * at] == predicted[:, 2 * at + 1]))
            feature[:, at] = np.where(same, -1, feature[:, at])
        total = counts.sum(2, keepdims=True)
        return feature, self.cut, counts / np.maximum(total, 1)


def gini(counts: np.ndarray) -> np.ndarray:
    """Impurity of each row of counts, added up in MLlib's order."""
    total = counts.sum(-1)
    out = np.ones(total.shape)
    for k in range(counts.shape[-1]):
        share = counts[..., k] / np.maximum(total, 1)
        out -= share * share
    return np.where(total == 0, 0.0, out)


def best_cuts(cells: np.ndarray, subset: np.ndarray, offset: np.ndarray, bins: np.ndarray, classes: int):
    """(feature, cut, left, right) of each node, feature -1 where no cut gains. The first of equal gains, by the
    order of the node's features, then of the bins."""
    nodes, per_node = subset.shape
    most = int(bins[subset].max())
    b = np.arange(most)
    inside = b < bins[subset][:, :, None]
    at = (offset[:, :, None] + np.where(inside, b, 0) * classes)[..., None] + np.arange(classes)
    counts = np.where(inside[..., None], cells[at], 0)
    left = counts.cumsum(2)
    whole = left[:, :1, -1:, :]  # a feature's bins hold all rows of its node
    right = whole - left
    n_left, n_right = left.sum(-1), right.sum(-1)
    total = np.maximum(n_left + n_right, 1)
    gain = gini(whole) - n_left / total * gini(left) - n_right / total * gini(right)
    allowed = (n_left >= 1) & (n_right >= 1) & (b < bins[subset][:, :, None] - 1) & (gain >= 0)
    gain = np.where(allowed, gain, -np.inf).reshape(nodes, -1)
    best, row = gain.argmax(1), np.arange(nodes)
    f, cut = best // most, best % most
    gains = gain[row, best] > 0
    return np.where(gains, subset[row, f], -1), cut, left[row, f, cut], right[row, f, cut]


# ---------------------------------------------------------------- what MLlib's own code gives
def _thresholds(train: DataFrame, n: int, classes: int, n_features: int, asked: list, seed: int, features: str, label: str) -> dict:
    """MLlib's cuts of each feature for each number of bins. It samples the rows that it reads them from, and
    the sample of one size is taken once."""
    jvm, gateway = train.sparkSession._jvm, train.sparkSession.sparkContext._gateway
    module = lambda path, name: getattr(getattr(path, f"{name}$"), "MODULE$")
    rf = RandomForestClassifier(featuresCol=features, labelCol=label, seed=seed)
    rf._transfer_params_to_java()
    instances = module(jvm.org.apache.spark.ml.util, "DatasetUtils").extractInstances(rf._java_obj, train._jdf, jvm.scala.Option.apply(classes))
    nothing = jvm.org.apache.spark.api.python.PythonUtils.toScalaMap({})
    impurity = module(jvm.org.apache.spark.mllib.tree.impurity, "Gini")
    sort = module(jvm.org.apache.spark.mllib.tree.configuration, "QuantileStrategy").Sort()
    out, samples = {}, {}
    try:
        for max_bins in asked:
            wanted = max(max_bins * max_bins, SAMPLE)
            if wanted not in samples:
                part = wanted / n if wanted < n else 1.0
                drawn = instances if part == 1.0 else instances.sample(
                    False, part, jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
                samples[wanted] = drawn.cache(), part * n
            drawn, weight = samples[wanted]
            bins = gateway.new_array(jvm.int, n_features)
            for f in range(n_features):
                bins[f] = min(max_bins, n)
            # as many examples as are drawn whole, so that findSplits draws none again
            meta = jvm.org.apache.spark.ml.tree.impl.DecisionTreeMetadata(
                n_features, min(wanted, n), float(weight), classes, max_bins, nothing, nothing.keySet(), bins, impurity, sort, 1, 1, 0.0, 0.0, 1,
                n_features)
            cuts = module(jvm.org.apache.spark.ml.tree.impl, "RandomForest").findSplits(drawn, meta, seed)
            out[max_bins] = [np.array([float(s.threshold()) for s in cuts[f]]) for f in range(n_features)]
    finally:
        for drawn, _ in samples.values():
            drawn.unpersist(False)
    return out


def _tree_order(jvm):
    """The order in which Scala's map of a group goes through its trees."""
    known: dict = {}

    def order(by_tree) -> list:
        trees = tuple(sorted(by_tree))
        if len(trees) <= 4:  # small maps keep the order of insertion, here by number
            return list(trees)
        if trees not in known:
            keys = jvm.org.apache.spark.api.python.PythonUtils.toScalaMap({t: t for t in trees}).keys().mkString(",")
            known[trees] = [int(t) for t in keys.split(",")]
        return known[trees]

    return order


def _draws(data: DataFrame, blocks: list, needed: list, seed: int) -> DataFrame:
    """(part, block, draws): the Poisson numbers of a block's training rows for each (trees, fold) of ``needed``."""
    spark = data.sparkSession
    jvm, most = spark._jvm, max(t for t, _ in needed)
    ones = data.select(F.explode(F.array_repeat(F.lit(1).cast("long"), most)).alias("one"))._jdf
    long = jvm.org.apache.spark.sql.Encoders.LONG()
    places = getattr(ones, "as")(long).toJavaRDD().zipWithUniqueId()  # number in the partition * partitions + partition
    parts = places.getNumPartitions()
    # emits an element as often as its draw says
    share = jvm.java.util.HashMap()
    share.put(jvm.java.lang.Long.valueOf(1), 1.0)
    drawn = places.sampleByKey(True, share, seed + 1)
    stream = DataFrame(spark._jsparkSession.createDataset(drawn.values().rdd(), long).toDF(), spark)
    rows: dict = {}
    for part, block, kept in blocks:
        rows.setdefault(part, []).append((block, kept))
    shared = spark.sparkContext.broadcast({p: sorted(v) for p, v in rows.items()})

    def run(batches):
        here = shared.value.get(TaskContext.get().partitionId(), [])
        length = most * max((sum(kept[f] for _, kept in here) for _, f in needed), default=0)
        counts = np.zeros(length, np.uint8)
        for b in batches:
            at = b.column(0).to_numpy() // parts
            first = int(at[0]) if len(at) else 0
            if len(at) and first < length:
                got = np.bincount(at - first)[: length - first]
                counts[first: first + len(got)] += got.astype(np.uint8)
        begun = dict.fromkeys(range(len(here[0][1]) if here else 0), 0)
        for block, kept in here:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([block], pa.int32()),
                 pa.array([b"".join(counts[begun[f] * t: (begun[f] + kept[f]) * t].tobytes() for t, f in needed)], pa.binary())],
                names=["part", "block", "draws"])
            for f in begun:
                begun[f] += kept[f]

    return stream.mapInArrow(run, DRAWN)


# ---------------------------------------------------------------- blocks
def _to_blocks(data: DataFrame, edges: list, k: int, size: int) -> DataFrame:
    def run(batches):
        part, block = TaskContext.get().partitionId(), 0
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            y = b.column(1).to_numpy(zero_copy_only=False)
            fold = b.column(2).to_numpy(zero_copy_only=False)
            for at in range(0, len(y), size):
                values, f = x[at: at + size], fold[at: at + size].astype(np.int32)
                codes = np.stack([np.searchsorted(e, values[:, i], "left") for i, e in enumerate(edges)]).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([len(f)], pa.int32()),
                     pa.array([[int((f != j).sum()) for j in range(k)]], pa.list_(pa.int32())), pa.array([codes.tobytes()], pa.binary()),
                     pa.array([y[at: at + size].astype(np.uint16).tobytes()], pa.binary()), pa.array([f.tobytes()], pa.binary())],
                    names=["part", "block", "n", "kept", "codes", "y", "fold"])
                block += 1

    x = data.select(vector_to_array(F.col(data.columns[0])), F.col(data.columns[1]).cast("double"), F.col(data.columns[2]).cast("int"))
    return x.mapInArrow(run, BLOCKS)


def _rows(batches):
    for b in batches:
        columns = [b.column(k) for k in range(b.num_columns)]
        for i in range(b.num_rows):
            yield [c[i].as_py() for c in columns]


def _first_state(joined: DataFrame, forests: list, needed: list) -> DataFrame:
    shape = [(m.fold, m.trees) for m in forests]

    def run(batches):
        for n, kept, codes, y, fold, draws in _rows(batches):
            f, begun, parts = np.frombuffer(fold, np.int32), 0, {}
            for t, j in needed:
                parts[t, j] = draws[begun: begun + kept[j] * t]
                begun += kept[j] * t
            weights = []
            for j, t in shape:
                w = np.zeros((t, n), np.uint8)
                w[:, f != j] = np.frombuffer(parts[t, j], np.uint8).reshape(-1, t).T if needed else 1
                weights.append(w)
            yield _state(n, codes, y, fold, [w.tobytes() for w in weights], [(w != 0).astype(np.uint16).tobytes() for w in weights])

    return joined.select("n", "kept", "codes", "y", "fold", "draws").mapInArrow(run, STATE)


def _state(n, codes, y, fold, weights, nodes, more: bool = False):
    columns = [pa.array([n], pa.int32()), *[pa.array([v], pa.binary()) for v in (codes, y, fold)],
               pa.array([weights], pa.list_(pa.binary())), pa.array([nodes], pa.list_(pa.binary()))]
    names = ["n", "codes", "y", "fold", "weights", "nodes"]
    if more:
        columns += [pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())]
        names += ["model", "chunk", "cell", "count"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _tables(thresholds: list, edges: list) -> np.ndarray:
    """The bin of each code of each feature: code c stands for values in (edges[c - 1], edges[c]]."""
    out = np.zeros((len(edges), max(len(e) for e in edges) + 1), np.int64)
    for f, (t, e) in enumerate(zip(thresholds, edges)):
        out[f, : len(e)] = np.searchsorted(t, e, "left")
        out[f, len(e):] = len(t)
    return out


def _pass(state: DataFrame, shared, live: list, kept: list, classes: int) -> DataFrame:
    """One pass. ``live``: forests whose weights and nodes the rows hold; ``kept``: those that they go on with.
    ``shared``: per forest of the pass (model, trees, depth, table, moves, group)."""
    def run(batches):
        work, spread = [], None
        for model, trees, depth, table, moves, g in shared.value:
            size = 1 << max(depth, 1)
            to, place = np.full(trees * size, -1, np.int32), np.full(trees * size, -1, np.int32)
            if moves is not None:
                to[moves[0] * size + moves[1]] = np.arange(len(moves[0]))
            place[g.tree * size + g.node] = np.arange(len(g.node))
            spread = np.arange(len(table))[:, None] * table.shape[1]
            work.append((live.index(model), trees, size, table * classes, moves, to, g, np.hstack([g.offset, g.subset]), place,
                         np.zeros(g.cells, np.int32)))
        for n, codes, y, fold, weights, nodes in _rows(batches):
            code, cls = np.frombuffer(codes, np.uint16).reshape(-1, n) + spread, np.frombuffer(y, np.uint16)
            for k, trees, size, table, moves, to, g, info, place, sums in work:
                bins = table.take(code)  # times classes
                by_class, bins = (bins + cls).ravel(), bins.ravel()
                at = np.frombuffer(nodes[k], np.uint16).copy()  # tree by tree
                p = np.flatnonzero(at != 0)
                share = np.diff(np.searchsorted(p, np.arange(trees + 1) * n))
                a, tree = at.take(p), np.repeat(np.arange(trees) * size, share)
                row = p - np.repeat(np.arange(trees) * n, share)
                if moves is not None:
                    i = to.take(tree + a)
                    whole = not len(i) or i.min() >= 0  # else some wait on the stack
                    q = slice(None) if whole else np.flatnonzero(i >= 0)
                    feature, cut, left, right = moves[2].take(i[q], axis=0).T
                    a[q] = np.where(bins.take(feature * n + row[q]) > cut * classes, right, left)
                    at[p] = a
                    nodes[k] = at.tobytes()
                i = place.take(tree + a)
                if len(i) and i.min() < 0:
                    q = np.flatnonzero(i >= 0)
                    i, row, p = i.take(q), row.take(q), p.take(q)
                w = np.frombuffer(weights[k], np.uint8).take(p).astype(np.int32)
                at_node, each = info.take(i, axis=0), g.subset.shape[1]
                cell = by_class.take(at_node[:, each:] * n + row[:, None])
                cell += at_node[:, :each]
                np.add.at(sums, cell.ravel(), np.repeat(w, each))
            stay = [live.index(m) for m in kept]
            yield _state(n, codes, y, fold, [weights[i] for i in stay], [nodes[i] for i in stay], True)
        for k, *_, g, _info, _place, sums in work:
            for chunk, (a, z) in enumerate(zip(g.starts[:-1], g.starts[1:])):
                cell = np.flatnonzero(sums[a:z])
                if len(cell):
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(1, pa.int32()), *[pa.nulls(1, pa.binary())] * 3, *[pa.nulls(1, pa.list_(pa.binary()))] * 2,
                         pa.array([live[k]], pa.int32()), pa.array([chunk], pa.int32()), pa.array([cell.astype(np.uint32).tobytes()], pa.binary()),
                         pa.array([sums[a:z][cell].tobytes()], pa.binary())],
                        names=["n", "codes", "y", "fold", "weights", "nodes", "model", "chunk", "cell", "count"])

    return state.mapInArrow(run, PASS)


def _cuts(cells: DataFrame, shared, bins: dict, classes: int) -> DataFrame:
    def run(key, rows):
        model, chunk = (v.as_py() for v in key)
        g = next(w[5] for w in shared.value if w[0] == model)
        a, z = g.bounds[chunk], g.bounds[chunk + 1]
        begin, end = g.starts[chunk], g.starts[chunk + 1]
        sums = np.zeros(int(end - begin), np.int64)
        for cell, count in zip(rows.column("cell").to_pylist(), rows.column("count").to_pylist()):
            sums[np.frombuffer(cell, np.uint32)] += np.frombuffer(count, np.int32)
        feature, cut, left, right = best_cuts(sums, g.subset[a:z], g.offset[a:z] - begin, bins[model], classes)
        return pa.Table.from_arrays(
            [pa.array([model], pa.int32()), pa.array([chunk], pa.int32()),
             *[pa.array([v.astype(t).tobytes()], pa.binary()) for v, t in ((feature, np.int16), (cut, np.int16), (left, np.int64), (right, np.int64))]],
            names=["model", "chunk", "feature", "cut", "left", "right"])

    return cells.groupBy("model", "chunk").applyInArrow(run, CUTS)


def _mistakes(state: DataFrame, shared) -> DataFrame:
    """(model, n, wrong) of each block's held-out rows."""
    def run(batches):
        for n, codes, y, fold in _rows(batches):
            code, cls, f = np.frombuffer(codes, np.uint16), np.frombuffer(y, np.uint16), np.frombuffer(fold, np.int32)
            out = []
            for model, held, depth, table, feature, cut, votes in shared.value:
                row = np.flatnonzero(f == held)
                total = np.zeros((len(row), votes.shape[2]))
                for t in range(len(feature)):
                    at = np.ones(len(row), np.int64)
                    for _ in range(depth):
                        by = feature[t, at].astype(np.int64)
                        over = table[by, code[np.maximum(by, 0) * n + row]] > cut[t, at]
                        at = np.where(by < 0, at, 2 * at + over)
                    total += votes[t, at]
                out.append((model, len(row), int((total.argmax(1) != cls[row]).sum())))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["model", "n", "wrong"])

    return state.select("n", "codes", "y", "fold").mapInArrow(run, "model long, n long, wrong long")


# ---------------------------------------------------------------- all forests
def held_out(data: DataFrame, settings: list[tuple], k: int, seed: int, parallelism: int = 4,
             featureSubsetStrategy: str = "auto", bootstrap: bool = True, **_) -> list[tuple]:
    """(rows, mistakes) on fold j of the forest of setting i grown on the other folds, for each (i, j) in order.
    ``data``: features, label and fold, persisted, as its partitions decide the draws. NULL folds take no part."""
    spark = data.sparkSession
    features, label, fold = data.columns
    ship_package(spark)
    whole = F.col(fold).cast("int")  # a fold that is no whole number is never held out
    data = data.where(F.col(fold).isNotNull()).withColumn(fold, F.when(F.col(fold) == whole, whole).otherwise(-1))
    sizes = data.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.max(label).alias("top")).collect()
    n_train = [sum(r["n"] for r in sizes if r[fold] != j) for j in range(k)]
    if not all(n_train):
        raise ValueError("a fold leaves no rows to train on")
    tops = [max((r["top"] for r in sizes if r[fold] != j and r["top"] is not None), default=0) for j in range(k)]
    n_classes = [int(t) + 1 for t in tops]
    classes = max(int(r["top"] or 0) + 1 for r in sizes)
    if classes > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    n_features = len(data.first()[0])
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        asked = sorted({mb for _, _, mb in settings})
        found = list(pool.map(lambda j: _thresholds(
            training_folds(data, j, fold), n_train[j], n_classes[j], n_features, asked, seed, features, label), range(k)))
    edges = [np.unique(np.concatenate([t[f] for by in found for t in by.values()])) for f in range(n_features)]
    sqrt = math.ceil(math.sqrt(n_features))
    strategy = {"auto": lambda nt: n_features if nt == 1 else sqrt, "all": lambda nt: n_features, "sqrt": lambda nt: sqrt}[featureSubsetStrategy]
    forests = [Forest(i * k + j, j, nt, md, found[j][mb], classes, n_classes[j], strategy(nt), seed)
               for i, (nt, md, mb) in enumerate(settings) for j in range(k)]
    tables = [_tables(m.thresholds, edges) for m in forests]
    needed = sorted({(m.trees, m.fold) for m in forests}) if bootstrap else []

    total, per_row = sum(r["n"] for r in sizes), 2 * n_features + 5 + 3 * sum(m.trees for m in forests)
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-total * per_row // TASK_BYTES))
    size = max(64, min(BLOCK_ROWS, BLOCK_CODES // n_features, total // (4 * tasks)))
    per_file = -(-total // size // (4 * tasks))  # more files than tasks, so that tasks get equal shares
    paths = [scratch_path(spark, "forest-blocks")]
    write = lambda df, path: df.write.option("compression", "lz4_raw").option("parquet.block.size", GROUP_OF_ROWS).option(
        "maxRecordsPerFile", per_file).parquet(path)
    try:
        write(_to_blocks(data, edges, k, size), paths[0])
        blocks = spark.read.parquet(paths[0])
        if needed:
            where = [(r["part"], r["block"], r["kept"]) for r in blocks.select("part", "block", "kept").collect()]
            draws = _draws(data, where, needed, seed).repartition(tasks, "part", "block")
            joined = blocks.repartition(tasks, "part", "block").join(draws, ["part", "block"])
        else:
            joined = blocks.repartition(tasks, "part", "block").withColumn("draws", F.lit(b""))
        paths.append(scratch_path(spark, "forest-rows"))
        write(_first_state(joined, forests, needed), paths[-1])
        order, live = _tree_order(spark._jvm), [m.model for m in forests]
        for m in forests:
            m.select()
        waiting = [m for m in forests if m.group]
        while waiting:
            now, cells = [], 0
            for m in waiting:
                if not now or cells + m.group.cells <= PASS_CELLS:
                    now.append(m)
                    cells += m.group.cells
            shared = spark.sparkContext.broadcast([(m.model, m.trees, m.depth, tables[m.model], m.moves, m.group) for m in now])
            state = spark.read.parquet(paths[-1]).where(F.col("n").isNotNull()).select("n", "codes", "y", "fold", "weights", "nodes")
            kept = [m.model for m in waiting]
            paths.append(scratch_path(spark, "forest-rows"))
            write(_pass(state.coalesce(tasks), shared, live, kept, classes), paths[-1])
            drop_path(spark, paths.pop(-2))
            live = kept
            done = _cuts(spark.read.parquet(paths[-1]).where(F.col("n").isNull()).select("model", "chunk", "cell", "count"),
                         shared, {m.model: m.bins for m in now}, classes).toArrow().to_pylist()
            shared.destroy()
            for m in now:
                mine = {r["chunk"]: r for r in done if r["model"] == m.model}
                whole = []
                for chunk, (a, z) in enumerate(zip(m.group.bounds[:-1], m.group.bounds[1:])):
                    r, n = mine.get(chunk), int(z - a)
                    whole.append((np.full(n, -1), np.zeros(n, int), *[np.zeros((n, classes), np.int64)] * 2) if r is None else (
                        *[np.frombuffer(r[c], np.int16).astype(np.int64) for c in ("feature", "cut")],
                        *[np.frombuffer(r[c], np.int64).reshape(n, classes) for c in ("left", "right")]))
                m.split(*(np.concatenate(part) for part in zip(*whole)), order)
                m.select()
            later = [m for m in waiting if m not in now]
            waiting = later + [m for m in now if m.group]
        shared = spark.sparkContext.broadcast([(m.model, m.fold, m.depth, tables[m.model], *m.pruned()) for m in forests])
        blocks = spark.read.parquet(paths[0])
        rows = {r["model"]: (r["n"], r["wrong"]) for r in _mistakes(blocks, shared).groupBy("model").agg(
            F.sum("n").alias("n"), F.sum("wrong").alias("wrong")).collect()}
        shared.destroy()
    finally:
        for path in paths:
            drop_path(spark, path)
    return [rows[m.model] for m in forests]
