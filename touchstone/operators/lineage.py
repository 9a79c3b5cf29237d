"""Predecessor lineage: cycles, closed predecessors, successors, chains.

Cycles and chains follow pointers by doubling: after k rounds every pointer
spans 2^k steps, so a chain of n rows needs about log2(n) joins.  Each round is
checkpointed, which keeps the plan flat and survives lost executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchstone.functions import present
from touchstone.operators.keys import lookup, unreferenced
from touchstone.session import materialize


def cycle_members(edges: DataFrame, node: str, parent: str, order: str | None = None) -> DataFrame:
    """Nodes that lie on a cycle of the parent pointers (self-loops included).

    A node listed more than once keeps its last pointer by ``order``.  Each round
    keeps the nodes that something points to, and lets them point twice as far.
    They only get fewer, towards the cycles, and once a round loses none the
    pointers permute what is left, so it then consists of cycle nodes alone.
    """
    known = edges.where(present(F.col(node).cast("string")))
    picked = F.max_by(parent, order) if order else F.max(parent)
    steps = known.groupBy(F.col(node).alias("node")).agg(picked.alias("parent"))
    steps = materialize(steps.where(present(F.col("parent").cast("string"))))
    size, before = steps.count(), None
    while size and size != before:
        pointed_to = steps.select(F.col("parent").alias("node")).distinct()
        inside = steps.join(pointed_to, "node", "left_semi")
        ahead = steps.select(F.col("node").alias("parent"), F.col("parent").alias("beyond"))
        steps = materialize(inside.join(ahead, "parent").select("node", F.col("beyond").alias("parent")))
        size, before = steps.count(), size
    return steps.select("node")


def without_successor(rows: DataFrame, node: str, parent: str, status: str, value: str) -> DataFrame:
    """Rows of the given status that no row names as its predecessor."""
    return unreferenced(
        rows.where(F.col(status) == value), node, rows.where(present(F.col(parent))), parent
    )


def closed_predecessors(
    rows: DataFrame, node: str, parent: str, status: str, value: str
) -> DataFrame:
    """Rows touched by a closed predecessor, with the number of times each is.

    A closed row that is a predecessor counts once, and so does each of its
    successors; with several closed rows under one id a successor counts once
    per such row.  ``occurrences`` carries that number, no pair is built.
    """
    closed = F.col(status).eqNullSafe(value)
    linked = rows.where(present(F.col(parent)))
    tallies = (
        rows.where(closed & present(F.col(node)))
        .groupBy(F.col(node).alias("_closed_id"))
        .agg(F.count(F.lit(1)).alias("_closed_rows"))
    )
    out = lookup(rows, node, linked, parent, {}, found="_has_successor")
    out = lookup(
        out, parent, tallies, "_closed_id", {"_closed_rows": "_closed_rows"}, found="_after_closed"
    )
    as_predecessor = closed & F.col("_has_successor")
    as_successor = F.when(present(F.col(parent)), F.coalesce(F.col("_closed_rows"), F.lit(0))).otherwise(0)
    own = closed & present(F.col(parent)) & (F.col(parent) == F.col(node))
    times = (
        F.coalesce(as_predecessor, F.lit(False)).cast("long")
        + as_successor
        - F.coalesce(own, F.lit(False)).cast("long")
    )
    return (
        out.withColumn("occurrences", times).where("occurrences > 0").select(*rows.columns, "occurrences")
    )


def loop_places(steps: DataFrame) -> DataFrame:
    """Where each node of a loop stands: ``member``, ``leader``, ``ahead``.

    ``steps(from, node)`` must consist of closed loops; ``length``, where they have
    it, says how far a step leads (1 otherwise).  The leader of a loop is its
    smallest member; it lies ``ahead`` of the member.  Each round looks twice as
    far ahead, and once a round changes nothing every member has seen its whole loop.
    """
    length = F.col("length") if "length" in steps.columns else F.lit(1).cast("long")
    places = materialize(
        steps.select(
            F.col("from").alias("member"), F.col("node").alias("next"), length.alias("span"),
            F.col("from").alias("leader"), F.lit(0).cast("long").alias("ahead"),
        )
    )
    moved = True
    while moved:
        beyond = places.select(
            F.col("member").alias("next"), F.col("next").alias("_next"), F.col("span").alias("_span"),
            F.col("leader").alias("_leader"), F.col("ahead").alias("_ahead"),
        )
        closer = F.col("_leader") < F.col("leader")
        places = materialize(
            places.join(beyond, "next").select(
                "member",
                F.col("_next").alias("next"),
                (F.col("span") + F.col("_span")).alias("span"),
                F.least("leader", "_leader").alias("leader"),
                F.when(closer, F.col("span") + F.col("_ahead")).otherwise(F.col("ahead")).alias("ahead"),
                closer.alias("_moved"),
            )
        )
        moved = not places.where("_moved").isEmpty()
    return places.select("member", "leader", "ahead")


def _stretches(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(node, head, depth)`` of nodes inside stretches, and the ``(from, node)`` that lead to their heads.

    A node that one link leads to lies inside a stretch, ``depth`` steps behind its
    head: the first node above it that no link or several lead to.  Such a node
    has one pointer back, which a round lets reach twice as far, so rounds hold a
    row a node at most, and fewer as pointers reach their heads.  What never does
    are loops without a way in: once a round loses no pointer only they are left,
    and they belong to no chain.
    """
    ways = materialize(links.groupBy("node").agg(F.count(F.lit(1)).alias("ways"), F.min("from").alias("from")))
    moving = ways.where("ways = 1").select(
        "node", F.col("from").alias("head"), F.lit(1).cast("long").alias("depth"), F.lit(False).alias("settled")
    )
    rounds: list[DataFrame] = []
    left, before = 1, 0
    while left and left != before:
        every = reduce(DataFrame.unionByName, [*(r.where("settled") for r in rounds), moving])
        ahead = every.select(
            F.col("node").alias("head"), F.col("head").alias("_head"), F.col("depth").alias("_depth"), F.col("settled").alias("_settled")
        )
        # Without a pointer of its own the node pointed to is a head.
        reached = materialize(
            moving.join(ahead, "head", "left").select(
                "node", F.coalesce("_head", "head").alias("head"),
                (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), F.coalesce("_settled", F.lit(True)).alias("settled"),
            )
        )
        rounds.append(reached)
        moving = reached.where("NOT settled")
        left, before = moving.count(), left if len(rounds) > 1 else 0
    settled = reduce(DataFrame.unionByName, [r.where("settled") for r in rounds]).drop("settled")
    merging = ways.where("ways > 1").select("node")
    return settled, links.join(merging, "node", "left_semi").select("from", "node")


def _descents(links: DataFrame) -> DataFrame:
    """``(node, top, depth)``: the ends without a predecessor above every node of ``links(from, node, length)``.

    Links must not close into loops.  Pointers run back towards the top and are
    settled there; a round lets them reach over twice as many links.
    """
    inner = links.select(F.col("node").alias("top")).distinct().withColumn("_inner", F.lit(True))
    pointers = links.select("node", F.col("from").alias("top"), F.col("length").alias("depth"))
    pointers = materialize(
        pointers.join(inner, "top", "left").select(
            "node", "top", "depth", F.col("_inner").isNull().alias("settled")
        )
    )
    settled, moving = pointers.where("settled"), pointers.where("NOT settled")
    while not moving.isEmpty():
        ahead = settled.unionByName(moving).select(
            F.col("node").alias("top"),
            F.col("top").alias("next_top"),
            F.col("depth").alias("more"),
            F.col("settled").alias("next_settled"),
        )
        joined = materialize(
            moving.join(ahead, "top").select(
                "node",
                F.col("next_top").alias("top"),
                (F.col("depth") + F.col("more")).alias("depth"),
                F.col("next_settled").alias("settled"),
            )
        )
        settled = settled.unionByName(joined.where("settled"))
        moving = joined.where("NOT settled")
    return settled.select("node", "top", "depth")


def chains(rows: DataFrame, node: str, parent: str, status: str, value: str, order: str) -> DataFrame:
    """Members of every chain that starts at an un-succeeded-to row of the status.

    Returns ``root``, ``depth`` (0 at the root), ``node`` and ``in_loop``, one
    row per member, so a chain of any length stays spread out.  Of several rows
    naming one predecessor the last by ``order`` is its successor.

    The links form a map.  It is first cut into stretches, which begin at a root
    or where chains meet; all that follows runs on the heads of stretches, and
    the members of a stretch come back at the end.  A chain may run into a loop.
    Loops of heads are taken out: what is left are tails, which end at the head
    where they enter a loop, and a loop is only ever looked at as a list of
    places.  A chain that enters it goes round once, so each member that can be
    reached is returned once, at its distance from the root, with ``in_loop``
    true on the loop.
    """
    linked = rows.where(present(F.col(parent)))
    links = materialize(
        linked.groupBy(F.col(parent).alias("from")).agg(F.max_by(node, order).alias("node")).where("node IS NOT NULL")
    )
    roots = materialize(
        unreferenced(rows.where(F.col(status) == value), node, links, "node")
        .select(F.col(node).alias("root"))
        .distinct()
    )
    first = roots.select("root", F.lit(0).cast("long").alias("depth"), F.col("root").alias("node"), F.lit(False).alias("in_loop"))
    inside, meeting = _stretches(links)
    # A link to a head starts at a head or inside a stretch, which it leads out of.
    ends = inside.select(F.col("node").alias("from"), F.col("head").alias("_head"), F.col("depth").alias("_depth"))
    steps = materialize(
        meeting.join(ends, "from", "left").select(
            F.coalesce("_head", "from").alias("from"), "node", (F.coalesce("_depth", F.lit(0)) + 1).cast("long").alias("length")
        )
    )
    if steps.isEmpty():  # no chains meet, so none enters a loop
        members = inside.withColumnRenamed("head", "root").join(roots, "root", "left_semi")
        return members.select("root", "depth", "node", F.lit(False).alias("in_loop")).unionByName(first)

    loops = cycle_members(steps, "from", "node").select(F.col("node").alias("from"))
    round_steps = materialize(steps.join(loops, "from", "left_semi"))
    places = loop_places(round_steps)
    found = _descents(steps.join(loops, "from", "left_anti"))
    reached = found.withColumnRenamed("top", "root").join(roots, "root", "left_semi")
    standing = places.select(F.col("member").alias("node"), "leader", F.col("ahead").alias("_ahead"))
    reached = materialize(reached.join(standing, "node", "left"))
    # Once round from the entry: the rest of its loop follows, in steps from the entry.
    entered = reached.where("leader IS NOT NULL").select("root", F.col("node").alias("entry"), "depth", "leader", "_ahead")
    lengths = round_steps.join(places, F.col("from") == F.col("member")).groupBy("leader").agg(F.sum("length").alias("_length"))
    around = (
        entered.join(lengths, "leader").join(places, "leader").where("member <> entry")
        .select(
            "root", (F.col("depth") + F.pmod(F.col("_ahead") - F.col("ahead"), F.col("_length"))).alias("depth"),
            F.col("member").alias("node"), F.lit(True).alias("in_loop"),
        )
    )
    heads = reached.select("root", "depth", "node", F.col("leader").isNotNull().alias("in_loop")).unionByName(around).unionByName(first)
    # A link leads to one node, so the whole stretch behind a head on a loop lies on it.
    behind = inside.select(F.col("head").alias("node"), F.col("node").alias("_member"), F.col("depth").alias("_within"))
    members = heads.join(behind, "node").select("root", (F.col("depth") + F.col("_within")).alias("depth"), F.col("_member").alias("node"), "in_loop")
    return members.unionByName(heads)


def looping_roots(members: DataFrame) -> DataFrame:
    """Roots of ``chains`` that end in a loop, with its length and the depth of its entry."""
    return members.where("in_loop").groupBy("root").agg(F.count(F.lit(1)).alias("loop_length"), F.min("depth").alias("entry_depth"))


def chain_summary(members: DataFrame, moments: DataFrame, node: str, moment: str) -> DataFrame:
    """Per chain: links, members and distinct moments (equal when none was overwritten)."""
    side = moments.select(F.col(node).alias("node"), F.col(moment).alias("_moment"))
    return (
        members.join(side, "node")
        .groupBy("root", "_moment")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("root")
        .agg(
            (F.sum("n") - 1).alias("links"),
            F.sum("n").alias("members"),
            F.count("_moment").alias("distinct_moments"),
        )
    )
