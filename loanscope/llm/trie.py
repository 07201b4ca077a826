"""Prefix trie of conversations, rolled up by centroid decomposition.

A node of the trie is a distinct sequence of first turns. Its key is a digest chained over
the turns; members and smallest member come from one aggregation over the paths of all
conversations. The smallest member of a node owns it, so (owner, depth) names a node too.

Subtree sums come from a centroid decomposition of the forest of parent edges. The weight of
a node is the number of its members, because the weight of a whole subtree is then a plain
sum over paths and nothing needs rolling up to find a centroid: it is the deepest node whose
subtree has half of the component's weight. Cutting at the centroid leaves the part above it
and one component for each child. What the centroid's subtree holds of the component is
added along the path from the centroid to the component's top. Every part has at most half
of the weight, so levels grow with the logarithm of the rows, however deep or bushy a trie is.

Components beyond ``COMPONENT`` nodes are cut by joins of the nodes with the paths through
their centroid; smaller ones are decomposed further inside tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanscope.llm.workspace import Workspace

#: Nodes of a component that a task decomposes.
COMPONENT = 1 << 15
#: Turns of a conversation whose keys one task chains.
BLOCK = 1024
#: Ids in a fragment of a list of ends.
FRAGMENT = 4096
WORD = r"[^\x20\x09-\x0D]+"


def _stream(rows: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with one call for a batch's columns by name."""
    names = T.StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in function(batches):
            yield pa.RecordBatch.from_arrays([pa.array(made[n]) for n in names], names=names)

    return rows.mapInArrow(run, schema)


def positioned(work: Workspace, turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest and words of every turn in order.

    Ordered by turn (null first), then role, then text; null role or text is empty. Rows
    without conv_id belong to no conversation and are left out. Conversations are dealt out by
    range, so that a very long one is spread over tasks: each task numbers its own rows, and
    what earlier tasks hold of a conversation is added. At most one conversation of a task
    began in an earlier one, so the broadcast table of offsets has a row for each task at most.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    dealt = rows.repartitionByRange("conv_id", "turn", F.left("role", F.lit(32)), F.left("text", F.lit(64)))
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").select(
        "conv_id",
        F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )

    def numbered(batches):
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            new = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else ids
            if not len(ids):
                continue
            start = np.repeat(new, np.diff([*new, len(ids)]))
            place = np.arange(len(ids)) - start + 1
            if ids[0] == last:
                place[start == 0] += seen
            last, seen = ids[-1], int(place[-1])
            yield {
                "conv_id": ids, "digest": batch.column("digest"), "words": batch.column("words"),
                "part": np.full(len(ids), part), "place": place,
            }

    schema = "conv_id long, digest binary, words long, part long, place long"
    placed = work.table("placed", _stream(dealt, numbered, schema))
    held = placed.groupBy("conv_id", "part").agg(F.max("place").alias("n"))
    parts = F.collect_list(F.struct("part", "n"))
    several = held.groupBy("conv_id").agg(parts.alias("parts")).filter(F.size("parts") > 1)
    earlier = F.aggregate(
        F.filter("parts", lambda p: p["part"] < F.col("at.part")), F.lit(0).cast("long"), lambda n, p: n + p["n"]
    )
    offsets = several.select("conv_id", "parts", F.explode("parts").alias("at")).select(
        "conv_id", F.col("at.part").alias("part"), earlier.alias("offset")
    )
    offsets = F.broadcast(offsets.filter("offset > 0"))
    return placed.join(offsets, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("offset", F.lit(0))).alias("place"), "digest", "words"
    )


def with_shared_heads(work: Workspace, turns: DataFrame, family: int, heads: int) -> DataFrame:
    """Conversations that begin like the first of their family.

    Conversation c takes its first h turns, crc32 of its decimal id modulo ``heads``, from
    conversation c - c % ``family`` (fewer if that has fewer, none without it), and goes on
    with its own turns after its first h. One row per turn: conv_id, depth, total, digest,
    words; one row with depth 0 for a conversation that ends up without turns.
    """
    held = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string")) % heads
    convs = held.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    firsts = held.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    convs = convs.join(firsts, "base", "left")
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    total = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = convs.withColumn("taken", taken).select("conv_id", "base", "h", "taken", total.alias("total"))
    convs = work.table("conversations", convs)
    first = turns.filter((F.col("place") < heads) & (F.col("conv_id") % family == 0))
    first = first.select(F.col("conv_id").alias("base"), "place", "digest", "words")
    head = convs.join(first, "base").filter("place <= taken")
    own = turns.join(convs, "conv_id").filter("place > h")
    own = own.withColumn("place", F.col("place") - F.col("h") + F.col("taken"))
    columns = ["conv_id", F.col("place").cast("long").alias("depth"), F.col("total").cast("long").alias("total"), "digest", "words"]
    silent = convs.filter("total = 0").select(
        "conv_id", *(F.lit(0).cast("long").alias(c) for c in ("depth", "total")),
        F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"),
    )
    return head.select(*columns).unionByName(own.select(*columns)).unionByName(silent)


def as_paths(turns: DataFrame) -> DataFrame:
    """The rows that :func:`prefix_trie` takes, for conversations as they are."""
    total = turns.groupBy("conv_id").agg(F.max("place").alias("total"))
    return turns.join(total, "conv_id").select("conv_id", F.col("place").alias("depth"), "total", "digest", "words")


def _hashed(prefix: bytes, digest: bytes) -> bytes:
    return hashlib.sha256(prefix + digest).digest()[:16]


def _halves(keys: list[bytes], *names: str) -> dict[str, np.ndarray]:
    columns = np.frombuffer(b"".join(keys), "<i8").reshape(len(keys), len(names))
    return {name: columns[:, i].copy() for i, name in enumerate(names)}


def _bytes(batch: pa.RecordBatch, *names: str) -> list[bytes]:
    whole = np.column_stack([batch.column(n).to_numpy() for n in names]).astype("<i8").tobytes()
    step = 8 * len(names)
    return [whole[i : i + step] for i in range(0, len(whole), step)]


def _chained(rows: DataFrame) -> DataFrame:
    """k1, k2: digest of a block's turns so far; p1, p2: that before the row, 0 at first."""
    rows = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "depth")

    def chain(batches):
        last, key = None, bytes(16)
        for batch in batches:
            made = []
            ids, blocks, digests = (batch.column(c).to_pylist() for c in ("conv_id", "block", "digest"))
            for conv, block, digest in zip(ids, blocks, digests, strict=True):
                if (conv, block) != last:
                    last, key = (conv, block), bytes(16)
                before, key = key, _hashed(key, digest)
                made.append(before + key)
            kept = {c: batch.column(c) for c in ("conv_id", "depth", "total", "words", "block")}
            yield kept | _halves(made, "p1", "p2", "k1", "k2")

    return _stream(rows, chain, "conv_id long, depth long, total long, words long, block long, k1 long, k2 long, p1 long, p2 long")


def _chained_blocks(ends: DataFrame) -> DataFrame:
    """o1, o2: the key of the last turn before a block, for all blocks but the first."""
    ends = ends.repartition("conv_id").sortWithinPartitions("conv_id", "block")

    def chain(batches):
        last, key = None, b""
        for batch in batches:
            ids, made = batch.column("conv_id").to_numpy(), []
            for conv, digest in zip(ids.tolist(), _bytes(batch, "k1", "k2"), strict=True):
                last, key = conv, digest if conv != last else _hashed(key, digest)
                made.append(key)
            yield {"conv_id": ids, "block": batch.column("block").to_numpy() + 1} | _halves(made, "o1", "o2")

    return _stream(ends, chain, "conv_id long, block long, o1 long, o2 long")


def keyed(work: Workspace, rows: DataFrame) -> DataFrame:
    """conv_id, depth, total, words, key (k1, k2) and parent's key (p1, p2) of each turn.

    A key is 128 bits of a chain of SHA-256 over the turns' digests; the root's is 0. Keys of
    long conversations are chained by blocks of turns, and blocks by their last keys.
    """
    block = F.floor((F.col("depth") - 1) / BLOCK).cast("long").alias("block")
    rows = rows.filter("depth > 0").select("conv_id", "depth", "total", "words", "digest", block)
    inner = work.table("inner", _chained(rows))
    before = _chained_blocks(inner.filter(F.col("depth") % BLOCK == 0).select("conv_id", "block", "k1", "k2"))
    later = inner.filter("block > 0").join(before, ["conv_id", "block"])

    def carried(batches):
        for batch in batches:
            keys = []
            at = zip(batch.column("depth").to_pylist(), *(_bytes(batch, a, b) for a, b in (("o1", "o2"), ("p1", "p2"), ("k1", "k2"))), strict=True)
            for depth, outer, parent, key in at:
                keys.append((outer if depth % BLOCK == 1 else _hashed(outer, parent)) + _hashed(outer, key))
            kept = {c: batch.column(c) for c in ("conv_id", "depth", "total", "words")}
            yield kept | _halves(keys, "p1", "p2", "k1", "k2")

    columns = ["conv_id", "depth", "total", "words", "k1", "k2", "p1", "p2"]
    schema = ", ".join(f"{c} long" for c in columns)
    return work.table("paths", inner.filter("block = 0").select(*columns).unionByName(_stream(later, carried, schema)))


def _ends(work: Workspace, ends: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256: digest of the ids k1, k2, conv_id of conversations that end at a node.

    Ids are dealt out by range of node and id and put together to fragments of bounded length;
    a task then reads a node's fragments one after another into its digest.
    """
    order = ["k1", "k2", "conv_id"]
    rows = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def fragments(batches):
        for batch in batches:
            nodes, ids = _bytes(batch, "k1", "k2"), batch.column("conv_id").to_pylist()
            cuts = [i for i in range(len(ids)) if not i or nodes[i] != nodes[i - 1] or i % FRAGMENT == 0]
            if cuts:
                runs = list(zip(cuts, [*cuts[1:], len(ids)], strict=True))
                yield _halves([nodes[a] for a, _ in runs], "k1", "k2") | {
                    "first": [ids[a] for a, _ in runs],
                    "said": [",".join(map(str, ids[a:b])) for a, b in runs],
                }

    made = work.table("fragments", _stream(rows, fragments, "k1 long, k2 long, first long, said string"))
    made = made.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")

    def digested(batches):
        last, digest = None, None
        for batch in batches:
            done = []
            for node, said in zip(_bytes(batch, "k1", "k2"), batch.column("said").to_pylist(), strict=True):
                if node == last:
                    digest.update(b"," + said.encode())
                    continue
                if last is not None:
                    done.append((last, digest.hexdigest()))
                last, digest = node, hashlib.sha256(said.encode())
            if done:
                yield _halves([n for n, _ in done], "k1", "k2") | {"ends_sha256": [d for _, d in done]}
        if last is not None:
            yield _halves([last], "k1", "k2") | {"ends_sha256": [digest.hexdigest()]}

    return _stream(made, digested, "k1 long, k2 long, ends_sha256 string")


class Forest:
    """Components of a forest in a task: nodes by component and depth, sums by node.

    ``top`` is the place of each node's component top and ``parent`` that of its parent, -1 for
    a top; parents come before children. ``weight`` is that of the node's subtree inside its
    component. ``values`` are the columns to sum.
    """

    def __init__(self, top: np.ndarray, parent: np.ndarray, weight: np.ndarray, values: np.ndarray):
        self.top, self.parent, self.weight, self.values = top.copy(), parent, weight.copy(), values
        self.sums = np.zeros_like(values)
        n, above = len(top), parent.tolist()
        count = [1] * n
        for i in range(n - 1, -1, -1):
            if above[i] >= 0:
                count[above[i]] += count[i]
        first, free, used = [0] * n, [0] * n, 0
        for i in range(n):  # places in depth-first order: a subtree is a range of them
            if above[i] < 0:
                first[i], used = used, used + count[i]
            else:
                first[i] = free[above[i]]
                free[above[i]] += count[i]
            free[i] = first[i] + 1
        self.first = np.array(first, np.int64)
        self.end = self.first + np.array(count, np.int64)

    def decompose(self) -> np.ndarray:
        """Sums over the subtree of every node, by centroids of all components level by level."""
        n = len(self.top)
        active = np.arange(n)
        first, end, weight = self.first, self.end, self.weight
        while len(active):
            top = self.top[active]
            heavy = active[2 * weight[active] >= weight[top]]
            heavy = heavy[np.lexsort((weight[heavy], self.top[heavy]))]
            tops, lightest = np.unique(self.top[heavy], return_index=True)
            centroid = heavy[lightest][np.searchsorted(tops, top)]
            inside = (first[centroid] <= first[active]) & (first[active] < end[centroid])
            above = (first[active] < first[centroid]) & (first[centroid] < end[active])
            total = np.zeros_like(self.sums)
            np.add.at(total, centroid[inside], self.values[active[inside]])
            path = active[above]
            self.sums[path] += total[centroid[above]]
            self.sums[heavy[lightest]] += total[heavy[lightest]]
            weight[path] -= weight[centroid[above]]
            below = inside & (active != centroid)
            child = active[below & (self.parent[active] == centroid)]
            place = lambda v, x: x * n + first[v]  # noqa: E731, B023
            child = child[np.argsort(place(child, self.parent[child]))]
            at = np.searchsorted(place(child, self.parent[child]), place(active[below], centroid[below]), "right") - 1
            self.top[active[below]] = child[at]
            active = active[active != centroid]
        return self.sums


_NODE = ["k1", "k2", "p1", "p2", "conv_id", "depth", "n_convs", "n_children", "leaf", "saved", "weight"]
_SUMS = ["n_leaves", "saved_tokens"]


def _local(nodes: DataFrame, most: int) -> DataFrame:
    """Sums within components of bounded size; several components share a batch."""
    rows = nodes.repartition("c1", "c2").sortWithinPartitions("c1", "c2", "depth")
    names = [*_NODE, *_SUMS]

    def solved(held: list[pa.RecordBatch]) -> dict:
        table = pa.Table.from_batches(held)
        column = {n: table.column(n).to_numpy().copy() for n in table.column_names}
        place = {key: i for i, key in enumerate(zip(column["k1"].tolist(), column["k2"].tolist(), strict=True))}
        top = np.array([place[c] for c in zip(column["c1"].tolist(), column["c2"].tolist(), strict=True)], np.int64)
        parent = np.array([place.get(p, -1) for p in zip(column["p1"].tolist(), column["p2"].tolist(), strict=True)], np.int64)
        parent[top == np.arange(len(top))] = -1
        values = np.column_stack([column["leaf"], column["saved"]])
        sums = Forest(top, parent, column["weight"], values).decompose()
        for i, name in enumerate(_SUMS):
            column[name] = column[name] + sums[:, i]
        return {n: column[n] for n in names}

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < most:
                continue
            c1, c2 = (pa.chunked_array([b.column(c) for b in held]).to_numpy() for c in ("c1", "c2"))
            changes = np.flatnonzero((c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1]))
            if not len(changes):
                continue
            table = pa.Table.from_batches(held)
            whole = int(changes[-1]) + 1
            yield solved(table.slice(0, whole).to_batches())
            held = table.slice(whole).to_batches()
        if held:
            yield solved(held)

    return _stream(rows, run, ", ".join(f"{n} long" for n in names))


def _split(work: Workspace, nodes: DataFrame, paths: DataFrame, large: DataFrame, step: int) -> DataFrame:
    """One level for the components c1, c2 with more than ``COMPONENT`` nodes.

    ``large`` has their weights. Nodes that were centroids come back without a component.
    """
    heavy = nodes.join(large, ["c1", "c2"]).filter(2 * F.col("weight") >= F.col("most"))
    lightest = F.min(F.struct("weight", "k1", "k2", "depth", "conv_id")).alias("x")
    centroid = heavy.groupBy("c1", "c2").agg(lightest).select(
        "c1", "c2", F.col("x.k1").alias("x1"), F.col("x.k2").alias("x2"), F.col("x.depth").alias("at"),
        F.col("x.conv_id").alias("owner"), F.col("x.weight").alias("less"),
    )
    centroid = work.table(f"centroids-{step}", centroid)
    through = centroid.join(paths, (F.col("x1") == F.col("p1")) & (F.col("x2") == F.col("p2"))).select(
        "c1", "c2", "conv_id", F.col("k1").alias("n1"), F.col("k2").alias("n2")
    )
    marked = nodes.join(centroid.select("c1", "c2", "x1", "x2", "at"), ["c1", "c2"])
    marked = marked.join(through, ["c1", "c2", "conv_id"], "left")
    is_top = (F.col("k1") == F.col("x1")) & (F.col("k2") == F.col("x2"))
    below = F.col("n1").isNotNull() & (F.col("depth") > F.col("at"))
    marked = marked.select(
        *_NODE, *_SUMS, "c1", "c2", is_top.alias("centroid"), F.coalesce(below, F.lit(False)).alias("below"), "n1", "n2"
    )
    marked = work.table(f"marked-{step}", marked)
    total = marked.filter("centroid OR below").groupBy("c1", "c2").agg(
        *(F.sum(v).alias(f"more_{s}") for v, s in zip(("leaf", "saved"), _SUMS, strict=True))
    )
    total = work.table(f"totals-{step}", total.join(centroid, ["c1", "c2"]))
    root = total.filter("at > 0").select("c1", "c2", F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"))
    path = total.join(paths, (F.col("owner") == F.col("conv_id")) & (F.col("depth") < F.col("at")))
    path = path.select("c1", "c2", "k1", "k2").unionByName(root)
    path = path.unionByName(total.select("c1", "c2", F.col("x1").alias("k1"), F.col("x2").alias("k2")))
    added = path.join(total.select("c1", "c2", "less", *(f"more_{s}" for s in _SUMS)), ["c1", "c2"])
    made = marked.join(added, ["c1", "c2", "k1", "k2"], "left")
    zero = F.lit(0).cast("long")
    inner = lambda own, new: F.when(F.col("centroid"), None).when(F.col("below"), F.col(new)).otherwise(F.col(own))
    made = made.select(
        *(c for c in _NODE if c != "weight"),
        (F.col("weight") - F.coalesce("less", zero)).alias("weight"),
        *((F.col(s) + F.coalesce(f"more_{s}", zero)).alias(s) for s in _SUMS),
        inner("c1", "n1").alias("c1"), inner("c2", "n2").alias("c2"),
    )
    written = work.table(f"level-{step}", made)
    work.drop(f"marked-{step}", f"totals-{step}", f"centroids-{step}")
    return written


def rolled_up(work: Workspace, nodes: DataFrame, paths: DataFrame, component: int) -> DataFrame:
    """Nodes with n_leaves and saved_tokens, the sums of leaf and saved over their subtrees."""
    zero = F.lit(0).cast("long")
    left = nodes.select(*_NODE, *(zero.alias(s) for s in _SUMS), zero.alias("c1"), zero.alias("c2"))
    left, done, step = work.table("level-start", left), [], 0
    while True:
        sizes = left.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.max("weight").alias("most"))
        large = work.table(f"large-{step}", sizes.filter(F.col("n") > component).drop("n"))
        if large.isEmpty():
            break
        small = left.join(large.select("c1", "c2"), ["c1", "c2"], "left_anti")
        done.append(_local(small, component))
        rest = left.join(large.select("c1", "c2"), ["c1", "c2"], "left_semi")
        level = _split(work, rest, paths, large, step)
        done.append(level.filter("c1 IS NULL").select(*_NODE, *_SUMS))
        left, step = level.filter("c1 IS NOT NULL"), step + 1
    done.append(_local(left, component))
    made = done[0]
    for more in done[1:]:
        made = made.unionByName(more)
    return made


def prefix_trie(turns: DataFrame, component: int = COMPONENT) -> DataFrame:
    """One row per node of the trie of conversations given as rows of :func:`with_shared_heads`.

    conv_id (smallest member), depth, parent_conv_id (the parent's conv_id, null for the root),
    n_convs, n_children, n_leaves (childless nodes in the subtree, top included), saved_tokens
    (sum over the subtree of (members - 1) x words of a node's last text) and ends_sha256 (of
    the ids of conversations that end there, ascending and joined by commas).

    The root stands for no turns; without conversations there are no nodes. Two conversations
    share a node if all of role and text of their turns up to it are the same bytes.
    """
    with Workspace(turns.sparkSession, "trie") as work:
        rows = work.table("rows", turns.select("conv_id", "depth", "total", "words", "digest"))
        paths = keyed(work, rows)
        tail = F.col("total") - F.col("depth") + 1
        keys = paths.groupBy("k1", "k2").agg(
            F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
            F.sum(tail).alias("weight"),
        )
        zero = F.lit(0).cast("long")
        # Each conversation counts once: by its first turn, or by its row without turns.
        root = rows.filter("depth <= 1").agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("total") + 1).alias("weight")
        ).filter("n_convs > 0")
        root = root.select(
            zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"),
            "conv_id", zero.alias("depth"), "n_convs", zero.alias("words"), "weight",
        )
        keys = work.table("keys", keys.unionByName(root))
        children = keys.filter("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
        nodes = keys.join(children, ["k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", zero))
        nodes = nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn(
            "saved", (F.col("n_convs") - 1) * F.col("words")
        )
        sums = rolled_up(work, nodes.fillna(0, ["p1", "p2"]), paths, component)
        sums = work.table("sums", sums)
        parents = keys.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
        at_end = paths.filter("depth = total").unionByName(rows.filter("depth = 0").select(
            "conv_id", "depth", "total", "words", *(zero.alias(c) for c in ("k1", "k2", "p1", "p2"))))
        ends = _ends(work, at_end)
        made = sums.join(ends, ["k1", "k2"], "left").join(parents, ["p1", "p2"], "left")
        nothing = hashlib.sha256(b"").hexdigest()
        return work.keep("result", made.select(
            "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
            "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        ))
