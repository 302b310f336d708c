"""Graphs as edge tables ``(head, type, tail)``: an edge points from the narrower to the wider node."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyworks.operators.aggs import first_by
from tallyworks.operators.joins import lookup_or_self
from tallyworks.operators.scan import OrderedScan
from tallyworks.session import cut_lineage


def canonical_edges(triples: DataFrame, synonyms: DataFrame, order: list[str]) -> DataFrame:
    """Both ends linked to their entity, one edge per (head, tail) with the type seen first.

    ``synonyms(synonym, entity_id)`` in lower case; an unknown name is its own entity in lower case.
    Triples are reduced before they are linked, so frequent pairs do not travel.
    """
    low = triples.withColumns({"head": F.lower("head"), "tail": F.lower("tail")}).select(
        "head", "tail", "type", *[c for c in order if c not in ("head", "tail", "type")]
    )
    few = first_by(low, ["head", "tail"], order)
    linked = lookup_or_self(few, "head", synonyms, "synonym", "entity_id", ["entity_id"])
    linked = lookup_or_self(linked, "tail", synonyms, "synonym", "entity_id", ["entity_id"])
    return first_by(linked, ["head", "tail"], order).select("head", "type", "tail")


def nodes(edges: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """All ends of edges and the isolated entities of ``extra(node)``."""
    ends = edges.select(F.col("head").alias("node")).unionByName(edges.select(F.col("tail").alias("node")))
    return (ends.unionByName(extra.select("node")) if extra is not None else ends).distinct()


def adjacency(edges: DataFrame, node: str = "head", other: str = "tail") -> DataFrame:
    """Neighbours in order, one row each: ``(node, position, neighbour)``; ``node="tail"`` gives the inverse.

    No list is gathered, so a hub is as many rows as it has neighbours, over as many tasks as the scan has.
    """
    distinct = edges.select(F.col(node).alias("node"), F.col(other).alias("neighbour")).distinct()
    return OrderedScan(distinct, ["node"], ["neighbour"]).row_number("position").result().select("node", "position", "neighbour")


def degrees(node_rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Incoming and outgoing edges of every node, 0 where there are none."""
    ends = edges.select("head", "tail").distinct()
    sides = ends.select(F.col("head").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionByName(
        ends.select(F.col("tail").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o"))
    )
    none = node_rows.select("node", F.lit(0).alias("i"), F.lit(0).alias("o"))
    return none.unionByName(sides).groupBy("node").agg(F.sum("i").alias("incoming"), F.sum("o").alias("outgoing"))


def root_candidates(node_rows: DataFrame, edges: DataFrame, n: int) -> DataFrame:
    """The ``n`` nodes with most incoming and, among equals, fewest outgoing edges."""
    return degrees(node_rows, edges).orderBy(F.desc("incoming"), "outgoing", "node").limit(n)


def delete_edges(edges: DataFrame, gone: DataFrame) -> DataFrame:
    return edges.join(gone.select("head", "tail").distinct(), ["head", "tail"], "left_anti")


def root_at(edges: DataFrame, root: str) -> DataFrame:
    """Edges without those that leave the root."""
    return edges.where(~F.col("head").eqNullSafe(root))


def levels(edges: DataFrame, root: str, max_levels: int = 10_000) -> DataFrame:
    """Smallest distance from the root plus one of every node that leads to it.

    One join per level; each level is stored before the next one is made, so the plan does not grow
    and a lost executor costs one level at most.
    """
    links = edges.select("head", "tail").where("head <> tail").distinct()
    links = cut_lineage(root_at(links, root))
    first = links.sparkSession.createDataFrame([(root, 1)], "node string, level int")
    done, frontier = first, first
    for level in range(2, max_levels + 2):
        reached = links.join(frontier.select(F.col("node").alias("tail")), "tail", "left_semi")
        frontier = cut_lineage(
            reached.select(F.col("head").alias("node")).distinct()
            .join(done, "node", "left_anti")
            .withColumn("level", F.lit(level))
        )
        if frontier.isEmpty():
            return done
        done = _add_level(done, frontier, level)
    raise RuntimeError(f"more than {max_levels} levels")


def _add_level(done: DataFrame, frontier: DataFrame, level: int) -> DataFrame:
    """Placed nodes with one more level; stored as one table now and then to keep the plan short."""
    done = done.unionByName(frontier)
    return cut_lineage(done) if level % 20 == 0 else done


def _doubled(jumps: DataFrame) -> DataFrame:
    """Every jump ``(node, to, low)`` followed by the jump from where it ended, left out where there is none.

    ``low`` is the smallest node on the way, the end left out.
    """
    onward = jumps.select(F.col("node").alias("to"), F.col("to").alias("__to"), F.col("low").alias("__low"))
    return jumps.join(onward, "to").select("node", F.col("__to").alias("to"), F.least("low", "__low").alias("low"))


def _hang(singles: DataFrame) -> DataFrame:
    """Where the stored ``singles(node, up)``, nodes with one way only, end: ``(node, up, anchor, steps)``; nodes that lead into a ring are left out.

    Pointer doubling: as many rounds as the logarithm of the longest way. A node that has ended is not moved again, and who
    meets one has ended with it, so no round is spent on finding that out.
    """
    jumps, ended, before = singles.select("node", F.col("up").alias("to"), F.lit(1).alias("steps"), F.lit(False).alias("done")), None, None
    while True:
        up = F.col("to" if before is None else "up")
        known = jumps if ended is None else jumps.unionByName(ended)
        onward = known.select(F.col("node").alias("to"), F.col("to").alias("__to"), F.col("steps").alias("__steps"), F.col("done").alias("__done"))
        fresh = cut_lineage(
            jumps.drop("done").join(onward, "to", "left").select(
                "node", up.alias("up"), F.coalesce("__to", "to").alias("to"), (F.col("steps") + F.coalesce("__steps", F.lit(0))).alias("steps"),
                F.coalesce("__done", F.lit(True)).alias("done"),
            )
        )
        here, jumps = fresh.where("done"), fresh.where("NOT done")
        ended = here if ended is None else ended.unionByName(here)
        left = jumps.count()
        # ways of every length up to the longest occur, so a round in which none ends has met rings only
        if left in (0, before):
            return ended.select("node", "up", F.col("to").alias("anchor"), "steps")
        before = left


def _ring_members(singles: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Nodes of ``singles(node, up)`` that lead into a ring and the ring's members ``(node, label)`` under its smallest name."""
    jumps, before, length = singles.select("node", F.col("up").alias("to"), F.col("node").alias("low")), None, 1
    while True:
        jumps = cut_lineage(_doubled(jumps))
        left, length = jumps.count(), 2 * length
        if left == 0:
            return None
        if left == before and length >= left:
            return jumps, jumps.join(jumps.select(F.col("to").alias("node")).distinct(), "node").select("node", F.col("low").alias("label"))
        before = left


def _ring_keepers(edges: DataFrame) -> DataFrame:
    """The smallest member ``(node)`` of each ring of siblings that leads to no sibling outside it.

    ``edges(a, b)``: sibling a points to b. Every node follows one of its edges. Those that end need no keeper, as they
    lead to a staying sibling or out of their ring; rings become one node each, which takes over the edges that leave them,
    until no ring is left. A ring whose node has no edge is closed.
    """
    keepers = edges.select(F.col("a").alias("node")).where("false")
    while True:
        found = _ring_members(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")))
        if found is None:
            return keepers
        stuck, rings = found
        edges = edges.join(stuck.select(F.col("node").alias("a")), "a", "left_semi")
        for end in ("a", "b"):
            into = rings.select(F.col("node").alias(end), F.col("label").alias("__label"))
            edges = edges.join(into, end, "left").withColumn(end, F.coalesce("__label", end)).drop("__label")
        edges = cut_lineage(edges.where("a <> b").distinct())
        closed = rings.select(F.col("label").alias("node")).distinct().join(edges.select(F.col("a").alias("node")), "node", "left_anti")
        keepers = keepers.unionByName(closed)


def _fall(one_way: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Falling siblings by the edges ``one_way(a, b)`` left to them.

    Their names and numbers of edges ``(node, n)``, the edges ``(head, tail)`` of those with several, and where those with one
    hang (as ``_hang``).
    """
    ways = cut_lineage(one_way.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("up")))
    hung = _hang(ways.select("node", "up"))
    if hung.count() < ways.count():
        # who ends leads out of every ring, so only the others can be in a closed one
        stuck = ways.join(hung.select("node"), "node", "left_anti")
        inside = cut_lineage(one_way.join(stuck.select(F.col("node").alias("a")), "a", "left_semi"))
        ways = cut_lineage(ways.join(_ring_keepers(inside), "node", "left_anti"))
        hung = _hang(ways.where("n = 1").select("node", "up"))
    elif not ways.where("n > 1").isEmpty():
        hung = _hang(ways.where("n = 1").select("node", "up"))
    edges = one_way.join(ways.where("n > 1").select(F.col("node").alias("a")), "a", "left_semi")
    return ways.select("node", "n"), edges.select(F.col("a").alias("head"), F.col("b").alias("tail")), hung


def _one_way(several: DataFrame, group: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` between two nodes of ``group(node, parent)`` with one parent, of which only one points at the other."""
    own = group.select(F.col("node").alias("head"), "parent")
    other = group.select(F.col("node").alias("tail"), F.col("parent").alias("__parent"))
    siblings = several.join(own, "head").where("tail <> parent").join(other, "tail").where("parent = __parent")
    pairs = siblings.groupBy(F.least("head", "tail").alias("a"), F.greatest("head", "tail").alias("b"))
    ways = pairs.agg(F.sum(F.when(F.col("head") < F.col("tail"), 1).otherwise(2)).alias("way")).where("way < 3")
    return ways.select(F.when(F.col("way") == 1, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(F.col("way") == 1, F.col("b")).otherwise(F.col("a")).alias("b"))


def build_hierarchy(edges: DataFrame, root: str) -> DataFrame:
    """Placed nodes ``(node, parent, level)`` below a root, the root itself with level 1.

    Level by level, all sets of siblings (nodes that point to one parent) at once:

    * an edge to a node that is neither sibling nor parent is dropped, so a node that points to
      several nodes of the level above stays below the smallest name;
    * siblings that point at each other lose both edges;
    * a sibling that points at another one leaves the level and is met again below that sibling;
    * a ring of siblings would move down for ever: its smallest member stays.

    A node with one edge left always stays one level below the end of that edge. So such nodes are not visited: pointer
    doubling gives the node with several edges (or the root) that each hangs on and the steps between, and they are placed
    with it. Only levels in which a node with several edges is met cost a step, and a chain of n siblings about log n joins.

    Depth-first deletion in place, as an in-memory version does it, gives the same except where its
    result depends on the order of visits (several parents) or does not end (rings). Edges with a null end are dropped;
    nodes that do not lead to the root are not in the result.
    """
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the edges of a node side by side: its tasks count most of them before anything is exchanged, and a hub is cut by its tails
    links = root_at(edges.select("head", "tail").where("head <> tail"), root).repartitionByRange(parts, "head", "tail")
    links = cut_lineage(links.distinct())
    ways = links.groupBy(F.col("head").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min("tail").alias("up"))
    heads = Observation()
    singles = cut_lineage(ways.observe(heads, F.count(F.lit(1)).alias("n")).where("n = 1").select("node", "up"))
    placed = links.sparkSession.createDataFrame([(root, None, 1)], "node string, parent string, level int")
    placed, hanging = _place(placed, _hang(singles), placed)
    # nodes with several edges that are not placed; the first step takes all edges, as singles are placed with what they hang on
    left = heads.get["n"] - singles.count()
    several, gone, step = links, singles.select("node"), 0
    while left:
        reached = several.join(placed.select(F.col("node").alias("tail"), "level"), "tail")
        met = (
            reached.groupBy(F.col("head").alias("node")).agg(F.min(F.struct("level", "tail")).alias("first"))
            .select("node", F.col("first.tail").alias("parent"), (F.col("first.level") + 1).alias("level"))
        )
        met = cut_lineage(met if step else met.join(gone, "node", "left_anti"))
        level = met.agg(F.min("level")).first()[0]
        if level is None:
            return placed
        staying = met.where(F.col("level") == level)
        beside = placed.where(F.col("level") == level)
        one_way = cut_lineage(_one_way(several, beside.unionByName(staying).select("node", "parent")))
        left, gone = left - staying.count(), staying.select("node") if step else gone.unionByName(staying.select("node"))
        several = several.join(gone.withColumnRenamed("node", "head"), "head", "left_anti") if left else None
        if not one_way.isEmpty():
            falling, again, fresh = _fall(one_way)
            staying = staying.join(falling, "node", "left_anti")
            onward = fresh.select(F.col("node").alias("anchor"), F.col("anchor").alias("__anchor"), F.col("steps").alias("__steps"))
            if not hanging.isEmpty():
                hanging = hanging.join(onward, "anchor", "left").select(
                    "node", "up", F.coalesce("__anchor", "anchor").alias("anchor"), (F.col("steps") + F.coalesce("__steps", F.lit(0))).alias("steps")
                )
            more = falling.where("n > 1").count()
            if more:
                several, left = again if several is None else several.unionByName(again), left + more
                hanging = hanging.unionByName(fresh)
            else:
                # all that falls hangs on nodes of this level
                placed = placed.unionByName(fresh.select("node", F.col("up").alias("parent"), (F.col("steps") + level).alias("level")))
        if left or not hanging.isEmpty():
            staying = cut_lineage(staying)
        if not hanging.isEmpty():
            staying, hanging = _place(staying, hanging, beside.unionByName(staying))
        placed, step = placed.unionByName(staying), step + 1
        if left:
            several = cut_lineage(several)
            placed = cut_lineage(placed) if step % 8 == 0 else placed
    return placed


def _place(new: DataFrame, hanging: DataFrame, ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New nodes with all that hangs on ``ends(node, level)`` below them, and what goes on hanging."""
    known = ends.select(F.col("node").alias("anchor"), F.col("level").alias("__level"))
    # who is placed needs its anchor no more
    seen = cut_lineage(hanging.join(known, "anchor", "left").withColumn("anchor", F.when(F.col("__level").isNull(), F.col("anchor"))))
    below = seen.where("__level IS NOT NULL").select("node", F.col("up").alias("parent"), (F.col("__level") + F.col("steps")).alias("level"))
    return new.unionByName(below), seen.where("__level IS NULL").drop("__level")


def hierarchy_edges(placed: DataFrame) -> DataFrame:
    """Edges that are left in a hierarchy."""
    return placed.where("parent IS NOT NULL").select(F.col("node").alias("head"), F.col("parent").alias("tail"))


def extend(edges: DataFrame, more: DataFrame, synonyms: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Edge table with later triples added, and the hierarchy made anew below the same root.

    ``edges`` and ``more`` have ``head, type, tail, ord``; earlier rows keep their type.
    """
    together = edges.select("head", "type", "tail", F.lit(0).alias("__b"), "ord").unionByName(
        more.select("head", "type", "tail", F.lit(1).alias("__b"), "ord")
    )
    canonical = canonical_edges(together, synonyms, ["__b", "ord"])
    return canonical, build_hierarchy(canonical, root)
