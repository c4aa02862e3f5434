"""A trie over long sequences by van Emde Boas recursion: heights are halved, all subtrees of a height are worked on at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.llm.common import written
from rowmill.operators import running_total

#: Members of a node are put into text in runs of this many ids.
RUN_BITS = 12


def prefix_trie(paths: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per different prefix of the sequences: the nodes of their trie, each named by its smallest member.

    ``paths(member, depth, item, size)`` holds the sequences' items from depth 1 on without gaps; equal items (text)
    have equal sizes. ``members(member, length)`` holds every sequence once, empty ones too; ids are whole numbers. Gives
    ``member`` (the smallest), ``depth``, ``parent`` (the parent's smallest member, null for the root), ``n_members``,
    ``n_children``, ``n_leaves`` and ``saved`` (over the subtree: members less one, times the size of the last item);
    beside it ``(member, depth, first)``, the smallest member of each node on the path of each sequence.

    Every sequence is cut at half of the largest depth, both halves are cut again, and so on. A block of items gets its
    name from those of its halves; a cut prefix gets its own from the prefix before its block and the block's name, from
    the largest blocks to the smallest, so that every depth is named once and each level is one job over all subtrees of
    its height. Totals are then grafted upward, from the smallest height to the largest: what the lower forest of a
    subtree has gathered is added to the nodes above the cut, along the path of each cut prefix. With n items and
    depth d that takes log d rounds and shuffles at most n rows in each; no sequence and no node is gathered in a task.

    Names are SHA-256 digests. No members give no rows; members without items give the root alone.
    """
    paths = written(paths.select("member", F.col("depth").cast("long").alias("depth"), "item", F.col("size").cast("long").alias("size")), "paths")
    depth = paths.agg(F.max("depth")).first()[0] or 0
    levels = (depth - 1).bit_length() if depth else 0
    named = _named(paths, levels)
    counted = written(named.groupBy("depth", "name").agg(F.min("member").alias("first"), F.count("*").alias("n_members"), F.max("size").alias("size")), "nodes")
    of = counted.select(F.col("depth").alias("at"), F.col("name").alias("called"), "first", "n_members", "size")
    met = named.select("member", "depth", "name").join(of, (F.col("depth") == F.col("at")) & (F.col("name") == F.col("called")))
    # a node is where a path meets its own member; the others tell which nodes the path goes through
    met = written(met.select("member", "depth", "first", "n_members", "size"), "trie-paths")
    nodes = written(_with_parents(met), "trie-nodes")
    totals = _grafted(nodes, met.select("member", "depth", "first"), levels)
    below = nodes.select(*(F.col(name).alias(name) for name in ("member", "depth", "parent", "n_members", "n_children")))
    sums = totals.select(F.col("member").alias("of"), F.col("depth").alias("at"), "n_leaves", "saved")
    inner = below.join(sums, (F.col("member") == F.col("of")) & (F.col("depth") == F.col("at"))).drop("of", "at")
    root = members.agg(F.min("member").alias("member"), F.count("*").alias("n_members")).where("n_members > 0")
    top = totals.where("depth = 1").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"))
    top = root.join(F.broadcast(top)).select(  # one row each
        "member",
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent"),
        "n_members",
        "n_children",
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
        "saved",
    )
    smallest = root.select(F.col("member").alias("root"))
    inner = inner.join(F.broadcast(smallest)).withColumn("parent", F.when(F.col("depth") == 1, F.col("root")).otherwise(F.col("parent"))).drop("root")
    return inner.select(top.columns).union(top), met.select("member", "depth", "first")


def ended_at(members: DataFrame, met: DataFrame) -> DataFrame:
    """``(first, depth, ends)``: for each node where sequences end their ids in ascending order, joined by commas.

    A node's ids are put together in runs of 4,096 possible ids, so that no task sorts all of a frequent node's.
    """
    last = members.join(met.select(F.col("member").alias("of"), F.col("depth").alias("at"), "first"), (F.col("member") == F.col("of")) & (F.col("length") == F.col("at")))
    roots = members.where("length = 0").select("member", "length")
    smallest = members.agg(F.min("member").alias("first"))
    ends = last.select("member", "length", "first").union(roots.join(F.broadcast(smallest)).select("member", "length", "first"))
    joined = lambda values: F.array_join(F.transform(F.array_sort(values), lambda v: v.cast("string")), ",")
    runs = ends.groupBy("first", "length", F.shiftright("member", RUN_BITS).alias("run")).agg(joined(F.collect_list("member")).alias("ids"))
    whole = F.array_sort(F.collect_list(F.struct("run", "ids")))
    return runs.groupBy("first", F.col("length").alias("depth")).agg(F.array_join(F.transform(whole, lambda r: r["ids"]), ",").alias("ends"))


def _named(paths: DataFrame, levels: int) -> DataFrame:
    """``(member, depth, name, size)``: equal names at a depth for equal prefixes."""
    blocks = [paths.select("member", (F.col("depth") - 1).alias("block"), F.col("item").alias("name"), "size")]
    for _ in range(levels):
        half = F.struct("block", "name", "size")
        pairs = blocks[-1].groupBy("member", F.shiftright("block", 1).alias("block")).agg(
            F.min(half).alias("left"), F.max(half).alias("right"), F.count("*").alias("halves")
        )
        whole = pairs.where("halves = 2").select("member", "block", _digest("left.name", "right.name").alias("name"), F.col("right.size").alias("size"))
        blocks.append(written(whole, "blocks"))
    done: list[DataFrame] = []
    for level in range(levels, -1, -1):
        # of the prefixes that end in the middle of a pair of blocks, or behind the largest block
        ends = blocks[level].where("block % 2 = 0").select("member", F.expr(f"shiftleft(block, {level})").alias("start"), "name", "size")
        first = ends.where("start = 0").select("member", F.lit(1 << level).cast("long").alias("depth"), _digest(F.lit("root"), "name").alias("name"), "size")
        found = first
        if done:
            before = reduce(DataFrame.union, done).select(F.col("member").alias("of"), F.col("depth").alias("at"), F.col("name").alias("prefix"))
            rest = ends.where("start > 0").join(before, (F.col("member") == F.col("of")) & (F.col("start") == F.col("at")))
            found = found.union(rest.select("member", (F.col("start") + (1 << level)).alias("depth"), _digest("prefix", "name").alias("name"), "size"))
        done.append(written(found, "prefixes"))
    return reduce(DataFrame.union, done)


def _digest(left: str | Column, right: str | Column) -> Column:
    return F.sha2(F.concat_ws("/", left, right), 256)


def _with_parents(met: DataFrame) -> DataFrame:
    """The nodes with their parents (null at depth 1), children counted, own shares of the totals."""
    above = met.select(F.col("member").alias("of"), (F.col("depth") + 1).alias("under"), F.col("first").alias("parent"))
    nodes = met.where("member = first").join(above, (F.col("member") == F.col("of")) & (F.col("depth") == F.col("under")), "left")
    nodes = written(nodes.select("member", "depth", "parent", "n_members", "size"), "nodes")
    children = nodes.where("depth > 1").groupBy(F.col("parent").alias("of"), (F.col("depth") - 1).alias("at")).agg(F.count("*").alias("n_children"))
    joined = nodes.join(children, (F.col("member") == F.col("of")) & (F.col("depth") == F.col("at")), "left")
    return joined.select(
        "member",
        "depth",
        "parent",
        "n_members",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_members") - 1) * F.col("size")).alias("saved"),
    )


def _grafted(nodes: DataFrame, met: DataFrame, levels: int) -> DataFrame:
    """``(member, depth, parent, n_leaves, saved)`` with the sums over each node's subtree."""
    sums = nodes.select("member", "depth", "parent", "n_leaves", "saved")
    for level in range(levels):
        half = 1 << level
        lower = sums.where(f"(depth - 1) % {2 * half} = {half}")  # the roots of the lower forests
        cut = lower.groupBy(F.col("parent").alias("of"), F.expr(f"shiftright(depth - 2, {level + 1})").alias("tree")).agg(
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")
        )
        upper = met.where(f"(depth - 1) % {2 * half} < {half}").select("member", "depth", "first", F.expr(f"shiftright(depth - 1, {level + 1})").alias("of_tree"))
        grafts = cut.join(upper, (F.col("of") == F.col("member")) & (F.col("tree") == F.col("of_tree")))
        more = grafts.select(F.col("first").alias("member"), "depth", F.lit(None).cast("long").alias("parent"), "n_leaves", "saved")
        both = sums.union(more).groupBy("member", "depth")
        sums = written(both.agg(F.max("parent").alias("parent"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")), "grafts")
    return sums


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: ``(paths, members)`` for :func:`prefix_trie`.

    Conversation c has the first h turns of conversation c - c % 5, h being the CRC-32 of c modulo 9, and then its own
    turns behind its first h. Turns are taken by ``turn`` (null first), those of one turn by the digest of role and text.
    A null role or text is an empty one; rows without a ``conv_id`` belong to no conversation.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    item = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = rows.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv"), "turn", item.alias("item"), F.octet_length(text).cast("long").alias("size"))
    placed = written(running_total(turns, ["conv"], ["turn", "item"], F.lit(1).cast("long"), "place").drop("turn"), "turns")
    sizes = written(placed.groupBy("conv").agg(F.count("*").alias("n")), "sizes")
    head = F.crc32(F.col("conv").cast("string")) % 9
    plan = sizes.select("conv", "n", head.alias("head"), (F.col("conv") - F.col("conv") % 5).alias("base"))
    bases = sizes.select(F.col("conv").alias("of"), F.col("n").alias("n_base"))
    plan = plan.join(bases, F.col("base") == F.col("of"), "left").select("conv", "n", "head", "base", F.least("head", F.coalesce("n_base", F.lit(0))).alias("taken"))
    plan = written(plan, "plan")
    given = placed.where("place <= 8").select(F.col("conv").alias("of"), "place", "item", "size")
    heads = plan.join(given, (F.col("base") == F.col("of")) & (F.col("place") <= F.col("head"))).select(
        F.col("conv").alias("member"), F.col("place").alias("depth"), "item", "size"
    )
    own = plan.select(F.col("conv").alias("of"), "head", "taken")
    tails = placed.join(own, F.col("conv") == F.col("of")).where("place > head")
    tails = tails.select(F.col("conv").alias("member"), (F.col("taken") + F.col("place") - F.col("head")).alias("depth"), "item", "size")
    members = plan.select(F.col("conv").alias("member"), (F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("head"))).alias("length"))
    return heads.union(tails), written(members, "members")
