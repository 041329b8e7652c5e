"""Trie of conversation prefixes, built as burst tries.

A conversation is the sequence of its turns; each distinct sequence of first turns is a node.
A turn is known by its id, 128 bits of a SHA-256 of (role, text), and its size in bytes.

1. Equal conversations are one *sequence* with a count, the smallest conv_id and the digest of
   its members, so a group of copies of any size is one row of the trie.
2. Sequences lie as suffixes in containers under trie heads. The root is burst at once. A
   container that weighs more than ``CONTAINER`` turns and holds more than one sequence is
   *burst*: its head becomes a trie node with the totals of an aggregate, and its suffixes move
   into one container for each next turn id. This repeats until no container is oversized.
3. The remaining containers are dealt to shards, sorted by suffix and swept: neighbours share
   their common prefix, so one pass over a container opens every node once. Sums over subtrees
   are closed inside it.
4. Containers and heads add their subtree sums to each head above them, in one aggregate.

The digest of a node's members needs their ids in ascending order. They are sorted by range
over all tasks and joined into pieces of ``PIECE`` ids there; only pieces meet per sequence.

Defined results: a NULL role or text is empty; turns are ordered by turn (NULL first), equal
turns by their digest; repeated rows are turns each; rows with a NULL conv_id belong to no
conversation; a conversation without turns is a member of the root; an empty table has no nodes;
texts of any length are hashed whole; only the named columns are read, so others may have any
name. One conversation is held as one row, about 50 bytes a turn.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabkit.llm.common import written

#: Turns (with one more for each sequence) that a container may hold before it is burst.
CONTAINER = 100_000
#: Ids joined into one piece before the pieces of a sequence meet.
PIECE = 4096
ROOT = ""
TURNS = "array<struct<id:string,size:bigint>>"
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def short_sha(*parts):
    """128 bits of a SHA-256, as hex text."""
    return F.left(F.sha2(F.concat(*parts), 256), F.lit(32))


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, seq): each conversation's turns in order, as (id, size)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    each = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"),
                 short_sha(F.char_length(role).cast("string"), F.lit(":"), role, text).alias("id"),
                 F.octet_length(text).cast("long").alias("size")).alias("t"))
    ordered = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size")))
    return each.groupBy("conv_id").agg(ordered.alias("seq"))


def pieces(batches):
    """(key, id) batches sorted by both: (key, first id, ids joined), at most PIECE ids each."""
    key, first, ids, out = None, None, [], []

    def close():
        if ids:
            out.append((key, first, ",".join(ids)))
            ids.clear()

    def batch():
        done = pa.RecordBatch.from_pydict({"key": pa.array([x[0] for x in out], pa.string()), "first": pa.array([x[1] for x in out], pa.int64()),
                                           "ids": pa.array([x[2] for x in out], pa.string())})
        out.clear()
        return done

    for b in batches:
        for k, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != key or len(ids) >= PIECE:
                close()
                key, first = k, i
            ids.append(str(i))
        if len(out) >= 1024:
            yield batch()
    close()
    yield batch()


def digests(batches):
    """Pieces sorted by (key, first): (key, SHA-256 of all ids of the key)."""
    key, state = None, None
    for b in batches:
        out = []
        for k, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            if k != key:
                if state:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield pa.RecordBatch.from_pydict({"key": pa.array([x[0] for x in out], pa.string()), "ends": pa.array([x[1] for x in out], pa.string())})
    if state:
        yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.string()), "ends": pa.array([state.hexdigest()], pa.string())})


def sequences(convs: DataFrame) -> DataFrame:
    """(seq, conv, n, ends): distinct sequences with their smallest member, number of members
    and the digest of these."""
    keyed = written(convs.select(short_sha(F.array_join("seq.id", "")).alias("key"), "conv_id", "seq"), "trie-keyed")
    grouped = keyed.groupBy("key").agg(F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("n"))
    parts = (keyed.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
             .mapInArrow(pieces, "key string, first long, ids string"))
    ends = parts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "key string, ends string")
    chosen = keyed.select("key", F.col("conv_id").alias("conv"), "seq")  # the smallest member brings the turns
    return chosen.join(grouped, ["key", "conv"]).join(ends, "key").select("seq", "conv", "n", "ends")


def sweep(batches):
    """Sorted suffixes of whole containers -> their nodes. Totals of the container's own top
    node stand beside ``heads``; they are NULL in the other rows."""
    names = ["conv", "depth", "parent", "n", "children", "leaves", "saved", "ends"]
    kind = pa.schema([(n, pa.string() if n == "ends" else pa.int64()) for n in names] + [("heads", pa.list_(pa.string()))])
    out: list = []
    current, nodes, path, above, heads, last = None, [], [], None, None, []

    def close():
        """The nodes of the container are whole: children stand behind their parents."""
        for node in reversed(nodes):
            if not node["children"]:
                node["leaves"] = 1
            node["saved"] += (node["n"] - 1) * node["size"]
            up = node["up"]
            if up is not None:
                up["n"] += node["n"]
                up["conv"] = node["conv"] if up["conv"] is None else min(up["conv"], node["conv"])
                up["children"] += 1
                up["leaves"] += node["leaves"]
                up["saved"] += node["saved"]
        for node in nodes:
            node["parent"] = above if node["up"] is None else node["up"]["conv"]
            out.append([node[n] for n in names] + [heads if node["up"] is None else None])
        nodes.clear()

    def node(up, depth, size):
        made = {"up": up, "depth": depth, "size": size, "conv": None, "n": 0, "children": 0, "leaves": 0, "saved": 0, "ends": None}
        nodes.append(made)
        return made

    def batch():
        columns = list(zip(*out)) if out else [[]] * len(kind)
        done = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kind)], schema=kind)
        out.clear()
        return done

    for b in batches:
        row = {n: b.column(b.schema.get_field_index(n)) for n in b.schema.names}
        flat, at = row["seq"].flatten(), row["seq"].offsets.to_pylist()
        ids, sizes = flat.field("id").to_pylist(), flat.field("size").to_pylist()
        base = at[0]
        keys, hs = row["key"].to_pylist(), row["heads"]
        depths, parents, tops = (row[n].to_pylist() for n in ("depth", "parent", "size"))
        convs, ns, ends = (row[n].to_pylist() for n in ("conv", "n", "ends"))
        for i, key in enumerate(keys):
            seq, size = ids[at[i] - base: at[i + 1] - base], sizes[at[i] - base: at[i + 1] - base]
            if key != current:
                close()
                current, above, heads, last = key, parents[i], hs[i].as_py(), []
                path = [node(None, depths[i], tops[i])]
            same = 0
            while same < len(last) and same < len(seq) and last[same] == seq[same]:
                same += 1
            del path[same + 1:]
            for k in range(same, len(seq)):
                path.append(node(path[-1], path[-1]["depth"] + 1, size[k]))
            end = path[-1]
            end["n"] += ns[i]
            end["conv"] = convs[i] if end["conv"] is None else min(end["conv"], convs[i])
            end["ends"] = ends[i]
            last = seq
        if len(out) >= 4096:
            yield batch()
    close()
    yield batch()


def burst(rows: DataFrame, over: DataFrame) -> DataFrame:
    """The suffixes of the containers in ``over`` (key, lead), each in the container of its next turn."""
    at = rows.join(over.select("key", "lead"), "key").filter(F.size("seq") > 0)
    return at.select(
        short_sha("key", F.col("seq")[0]["id"]).alias("key"), F.array_append("heads", F.col("key")).alias("heads"),
        (F.col("depth") + 1).alias("depth"), F.col("lead").alias("parent"), F.col("seq")[0]["size"].alias("size"),
        F.slice("seq", F.lit(2), F.size("seq")).alias("seq"), "conv", "n", "ends")


def head_totals(rows: DataFrame) -> DataFrame:
    """One row a container: its node's totals and its weight. Next turns are counted in two
    steps, so that a large container is summed where its rows lie."""
    nexts = rows.groupBy("key", F.when(F.size("seq") > 0, F.col("seq")[0]["id"]).alias("next")).agg(
        F.first("heads").alias("heads"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("size").alias("size"),
        F.min("conv").alias("lead"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"), F.sum(F.size("seq") + 1).alias("weight"),
        F.max(F.when(F.size("seq") == 0, F.col("ends"))).alias("ends"))
    return nexts.groupBy("key").agg(
        F.first("heads").alias("heads"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("size").alias("size"),
        F.min("lead").alias("lead"), F.sum("n").alias("n"), F.sum("rows").alias("rows"), F.sum("weight").alias("weight"),
        F.count("next").alias("children"), F.max("ends").alias("ends"))


def trie(convs: DataFrame, container: int = CONTAINER) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256):
    a row for each node of the trie of ``convs`` (conv_id, seq); conv_ids are distinct."""
    start = sequences(convs).select(
        F.lit(ROOT).alias("key"), F.array().cast("array<string>").alias("heads"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent"), F.lit(0).cast("long").alias("size"), F.col("seq").cast(TURNS).alias("seq"), "conv", "n", "ends")
    rows = written(start, "trie-rows")
    over = written(head_totals(rows), "trie-heads")  # the root is burst whatever it holds
    tops, held = [], []
    while not over.isEmpty():
        tops.append(over)
        rows = written(burst(rows, over), "trie-rows")
        sizes = written(head_totals(rows), "trie-heads")
        over = sizes.filter((F.col("weight") > container) & (F.col("rows") > 1))
        held.append(rows.join(over.select("key"), "key", "left_anti"))
        rows = rows.join(over.select("key"), "key", "left_semi")
    waiting = held[0] if held else rows
    for part in held[1:]:
        waiting = waiting.unionByName(part)
    swept = written(waiting.repartition("key").sortWithinPartitions("key", "seq").mapInArrow(
        sweep, "conv long, depth long, parent long, n long, children long, leaves long, saved long, ends string, heads array<string>"), "trie-nodes")
    if not tops:
        return named(swept)
    heads = tops[0]
    for part in tops[1:]:
        heads = heads.unionByName(part)
    own = (F.col("n") - 1) * F.col("size")
    sums = swept.filter(F.col("heads").isNotNull()).select(F.explode("heads").alias("key"), "leaves", "saved").unionByName(
        heads.select(F.explode(F.array_append("heads", F.col("key"))).alias("key"),
                     (F.col("children") == 0).cast("long").alias("leaves"), own.alias("saved")))
    sums = sums.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    above = heads.join(sums, "key").select(F.col("lead").alias("conv"), "depth", "parent", "n", "children", "leaves", "saved", "ends")
    return named(swept.drop("heads").unionByName(above))


def named(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_MEMBERS)).alias("ends_sha256"))
