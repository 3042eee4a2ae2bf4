"""The prefix trie of conversations, with subtree totals by parallel tree contraction.

Turns are numbered in their order by range partitioning (a conversation may be cut)
with offsets per partition. A prefix is named by its length and two sums of hashes
of (place, role, text); sums of prefixes are made in chunks of a conversation, so
neither a long nor a frequent conversation is one group. Nodes are the distinct
prefixes; their counts pre-aggregate in the map tasks.

Tree contraction: every node has a value; wanted is its sum over each subtree. Each
round works on the nodes that are left:

* rake: leaves are taken away, their totals are final, and go to their parents;
* compress: a node with one child that is no leaf is taken out of its chain if a
  hash of (node, round) tells heads and its child's tells tails or the child has
  several children; its value is kept on the edge from the child to its parent.

Chains shrink by a constant share per round and leaves at once, so rounds grow with
the logarithm of the nodes, also for one chain of any length. A node taken out has
the total of the child it had plus what it held; those references are followed by
pointer doubling, and all totals are recovered.

Hashes of the ids that end at a node: ids are folded in blocks of 4096 numbers,
whose strings then pass in order through one hash object; a node's list is never held.

Defined results: null roles and texts are empty; turns without a conversation id
belong to no conversation; null turns come first; turns of equal number are in
the order of role and text; repeated rows are turns of their own; an empty table
gives no rows, not even a root; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweir.llm.common import send_code, words
from clickweir.operators.joins import salted_join
from clickweir.workspace import materialise, settle

send_code(__name__)

CHUNK = 4096


def numbered_turns(
    rows: DataFrame, conv_id: str, turn: str, role: str, text: str
) -> DataFrame:
    """(conv_id, place, role_text, tokens): the turns of every conversation from 1."""
    said = rows.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.spark_partition_id().alias("task"),
    )
    order = ["conv_id", "turn", "role", "text"]
    # Equal turns may be parted by the task that read them.
    dealt = said.repartitionByRange(*order, "task").withColumn("part", F.spark_partition_id())
    hashed = [F.xxhash64(F.lit(k), F.col("role"), F.col("text")).alias(f"h{k}") for k in (0, 1)]
    stored = materialise(
        dealt.sortWithinPartitions(*order).select(
            "conv_id",
            "part",
            F.monotonically_increasing_id().alias("at"),
            *hashed,
            F.size(words(F.col("text"))).cast("long").alias("tokens"),
        )
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = stored.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    pieces = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n"))
    within = Window.partitionBy("part", "conv_id").orderBy("at")
    stored = stored.withColumn("at", F.row_number().over(within))
    # Only conversations that were cut need their offset.
    moved = materialise(pieces.where(F.col("n") > 0))
    return (
        stored.join(moved.hint("merge"), ["conv_id", "part"], "left")
        .select(
            "conv_id",
            (F.col("at") + F.coalesce("n", F.lit(0))).cast("long").alias("place"),
            "h0",
            "h1",
            "tokens",
        )
    )


def rebuilt(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths (conv_id, length) with the first ones taken from the group's first one.

    Conversation c starts with the first ``crc32(c) % most`` turns of ``c - c % group``
    and goes on with its own turns after its first so many.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    taken = F.crc32(F.col("conv_id").cast("string")) % most
    donor = F.col("conv_id") - F.col("conv_id") % group
    convs = sizes.withColumns({"taken": taken, "donor": donor})
    donors = sizes.select(F.col("conv_id").alias("donor"), F.col("own").alias("given"))
    # A donor serves at most ``group`` conversations.
    convs = materialise(
        convs.join(donors.hint("merge"), "donor", "left").select(
            "conv_id",
            "donor",
            "taken",
            F.least(F.col("taken"), F.coalesce("given", F.lit(0))).alias("given"),
            "own",
        )
    )
    heads = turns.where((F.col("conv_id") % group == 0) & (F.col("place") < most))
    heads = heads.withColumnRenamed("conv_id", "donor")
    first = heads.join(convs.select("conv_id", "donor", "given").hint("merge"), "donor").where(
        F.col("place") <= F.col("given")
    )
    small = convs.select("conv_id", "taken", "given")
    # A conversation may own very many turns.
    own = salted_join(turns, small, ["conv_id"], spread_by=["place"]).where(
        F.col("place") > F.col("taken")
    )
    own = own.withColumn("place", F.col("place") - F.col("taken") + F.col("given"))
    columns = ["conv_id", "place", "h0", "h1", "tokens"]
    length = F.col("given") + F.greatest(F.lit(0), F.col("own") - F.col("taken"))
    return (
        first.select(*columns).unionByName(own.select(*columns)),
        convs.select("conv_id", length.alias("length")),
    )


def _name(depth: Column, s0: Column, s1: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", depth, s0, s1)))


def _root() -> Column:
    return _name(F.lit(0), F.lit(0).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, tokens, last): every prefix of every conversation."""
    at = [
        F.xxhash64(F.col("place"), F.col(f"h{k}")).cast("decimal(38,0)").alias(f"a{k}") for k in (0, 1)
    ]
    chunk = F.floor((F.col("place") - 1) / CHUNK).alias("chunk")
    rows = materialise(turns.select("conv_id", "place", chunk, *at, "tokens"))
    up_to = Window.partitionBy("conv_id", "chunk").orderBy("place")
    within = rows.withColumns({f"s{k}": F.sum(f"a{k}").over(up_to) for k in (0, 1)})
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = (
        rows.groupBy("conv_id", "chunk")
        .agg(*[F.sum(f"a{k}").alias(f"t{k}") for k in (0, 1)])
        .select("conv_id", "chunk", *[F.sum(f"t{k}").over(earlier).alias(f"t{k}") for k in (0, 1)])
        .where(F.col("chunk") > 0)
    )
    summed = within.join(materialise(totals).hint("merge"), ["conv_id", "chunk"], "left")
    zero = F.lit(0).cast("decimal(38,0)")
    summed = summed.withColumns(
        {f"s{k}": F.col(f"s{k}") + F.coalesce(f"t{k}", zero) for k in (0, 1)}
    )
    node = _name(F.col("place"), F.col("s0"), F.col("s1"))
    parent = _name(
        F.col("place") - 1, *[(F.col(f"s{k}") - F.col(f"a{k}")).cast("decimal(38,0)") for k in (0, 1)]
    )
    ends = lengths.select("conv_id", F.col("length").alias("place"), F.lit(True).alias("last"))
    return summed.join(ends.hint("merge"), ["conv_id", "place"], "left").select(
        "conv_id",
        F.col("place").alias("depth"),
        node.alias("node"),
        parent.alias("parent"),
        "tokens",
        F.coalesce("last", F.lit(False)).alias("last"),
    )


def _coin(node: Column, round_no: int) -> Column:
    return F.xxhash64(F.lit(round_no), node) % 2 == 0


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(node, *values): each value summed over the subtree of each node, itself included.

    ``nodes`` has (node, parent, *values), each node once; a root's parent is null.
    Values are longs.
    """
    zero = F.lit(0).cast("long")
    held, edge = [f"held_{v}" for v in values], [f"edge_{v}" for v in values]
    active = materialise(
        nodes.select(
            "node",
            "parent",
            *[F.col(v).alias(h) for v, h in zip(values, held)],
            *[zero.alias(e) for e in edge],
        )
    )
    finals: DataFrame | None = None
    refs: DataFrame | None = None
    round_no = 0
    while not active.isEmpty():
        children = active.where(F.col("parent").isNotNull()).groupBy(
            F.col("parent").alias("node")
        ).agg(F.count("*").alias("n"), F.min("node").alias("child"))
        state = materialise(
            active.join(children.hint("merge"), "node", "left")
            .withColumn("n", F.coalesce("n", F.lit(0)))
            .withColumn(
                "heads",
                (F.col("n") == 1) & F.col("parent").isNotNull() & _coin(F.col("node"), round_no),
            )
        )
        leaves = state.where(F.col("n") == 0)
        done = leaves.select("node", *[F.col(h).alias(v) for v, h in zip(values, held)])
        finals = done if finals is None else finals.unionByName(done)
        raked = leaves.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
            *[F.sum(F.col(h) + F.col(e)).alias(h) for h, e in zip(held, edge)]
        )
        heads = state.where("heads").select(
            F.col("node").alias("out"),
            F.col("parent").alias("above"),
            F.col("child").alias("node"),
            *[F.col(h).alias(f"out_{h}") for h in held],
            *[F.col(e).alias(f"out_{e}") for e in edge],
        )
        tails = state.where((F.col("n") > 0) & ~F.col("heads")).select("node", *edge)
        out = materialise(heads.join(tails.hint("merge"), "node"))
        ref = out.select(
            F.col("out").alias("node"),
            F.col("node").alias("child"),
            *[(F.col(e) + F.col(f"out_{h}")).alias(v) for v, h, e in zip(values, held, edge)],
        )
        refs = ref if refs is None else refs.unionByName(ref)
        nothing = [zero.alias(c) for c in (*held, *edge)]
        moved = out.select(
            "node",
            F.col("above"),
            F.lit(False).alias("gone"),
            *[zero.alias(h) for h in held],
            *[(F.col(f"out_{h}") + F.col(f"out_{e}")).alias(e) for h, e in zip(held, edge)],
        )
        gone = out.select(
            F.col("out").alias("node"),
            F.lit(None).cast("binary").alias("above"),
            F.lit(True).alias("gone"),
            *nothing,
        )
        raked = raked.select(
            "node",
            F.lit(None).cast("binary").alias("above"),
            F.lit(False).alias("gone"),
            *held,
            *[zero.alias(e) for e in edge],
        )
        changes = (
            raked.unionByName(moved)
            .unionByName(gone)
            .groupBy("node")
            .agg(
                F.max("above").alias("above"),
                F.max("gone").alias("gone"),
                *[F.sum(c).alias(f"more_{c}") for c in (*held, *edge)],
            )
        )
        active = materialise(
            state.where(F.col("n") > 0)
            .join(changes.hint("merge"), "node", "left")
            .where(~F.coalesce("gone", F.lit(False)))
            .select(
                "node",
                F.coalesce("above", "parent").alias("parent"),
                *[
                    (F.col(c) + F.coalesce(f"more_{c}", zero)).alias(c)
                    for c in (*held, *edge)
                ],
            )
        )
        round_no += 1
    if finals is None:
        return nodes.select("node", *values)
    return _expanded(finals, refs, values)


def _expanded(finals: DataFrame, refs: DataFrame, values: list[str]) -> DataFrame:
    """Totals of raked nodes, and of those taken out: that of the node they refer to and more."""
    refs = materialise(refs)
    while not refs.isEmpty():
        nearer = refs.select(
            F.col("node").alias("child"),
            F.col("child").alias("next"),
            *[F.col(v).alias(f"more_{v}") for v in values],
        )
        joined = refs.join(nearer.hint("merge"), "child", "left")
        open_refs = joined.where(F.col("next").isNotNull())
        jumped = joined.select(
            "node",
            F.coalesce("next", "child").alias("child"),
            *[(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values],
        )
        if open_refs.isEmpty():
            break
        refs = materialise(jumped)
    known = finals.select(F.col("node").alias("child"), *[F.col(v).alias(f"known_{v}") for v in values])
    found = refs.join(known.hint("merge"), "child").select(
        "node", *[(F.col(v) + F.col(f"known_{v}")).alias(v) for v in values]
    )
    return finals.select("node", *values).unionByName(found)


_HASHED = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])


def hashed_ends(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from distinct (node, conv_id): of the ids in order, comma-joined."""
    blocks = (
        ends.groupBy("node", F.shiftright("conv_id", 12).alias("block"))
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))  # at most 4096 ids
        .select("node", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                if name != node:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = name, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_py().encode())
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in zip(*done)], schema=_HASHED
                )
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([node]), pa.array([state.hexdigest()])], schema=_HASHED
            )

    ordered = blocks.repartition("node").sortWithinPartitions("node", "block")
    return ordered.select("node", "ids").mapInArrow(run, "node binary, ends_sha256 string")


def prefix_trie(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    *,
    group: int | None = 20,
    most: int = 4,
) -> DataFrame:
    """One row per distinct prefix of the conversations, the empty one included.

    (node, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256), see ``queries.op12_trie``. With ``group=None``
    conversations are taken as they are, and not rebuilt.
    """
    names = (conv_id, turn, role, text)
    return settle(rows.sparkSession, lambda: _trie(rows, names, group, most))


def _trie(rows: DataFrame, names: tuple[str, str, str, str], group: int | None, most: int) -> DataFrame:
    turns = materialise(numbered_turns(rows, *names))
    if group:
        turns, lengths = rebuilt(turns, group, most)
    else:
        lengths = turns.groupBy("conv_id").agg(F.max("place").alias("length"))
    lengths = materialise(lengths)
    every = materialise(prefixes(turns, lengths))
    top = lengths.groupBy().agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    top = top.where(F.col("n_convs") > 0).select(
        _root().alias("node"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("tokens"),
        "conv_id",
        "n_convs",
    )
    # A node has one parent, depth and last text.
    nodes = every.groupBy("node", "parent", "depth", "tokens").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
    )
    nodes = materialise(nodes.unionByName(top))
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("n_children")
    )
    nodes = materialise(
        nodes.join(children.hint("merge"), "node", "left").withColumn(
            "n_children", F.coalesce("n_children", F.lit(0))
        )
    )
    valued = nodes.select(
        "node",
        "parent",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("tokens")).alias("saved_tokens"),
    )
    sums = materialise(subtree_sums(valued, ["n_leaves", "saved_tokens"]))
    ends = every.where("last").select("node", "conv_id")
    empty = lengths.where(F.col("length") == 0).select(_root().alias("node"), "conv_id")
    ends = materialise(hashed_ends(ends.unionByName(empty)))
    # The children of one node may be a third of all.
    parents = nodes.where(F.col("n_children") > 0).select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    below = nodes.where(F.col("parent").isNotNull())
    below = salted_join(below, materialise(parents), ["parent"], spread_by=["node"])
    above = nodes.where(F.col("parent").isNull()).withColumn(
        "parent_conv_id", F.lit(None).cast("long")
    )
    return (
        below.unionByName(above)
        .join(sums.hint("merge"), "node")
        .join(ends.hint("merge"), "node", "left")
        .select(
            "node",
            "depth",
            "conv_id",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
