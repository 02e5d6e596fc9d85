"""Classes of linked nodes: which pairs to test when rows share a key, and connected components.

Nodes are longs. Everything here is DataFrame operations; what several steps read is written to the
shared folder, so that a lost executor costs a re-read, and removed when the round that reads it is over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import removed, staged

HUB_ROUNDS = 2

Condition = Callable[[Column, Column], Column]
Verify = Callable[[DataFrame], DataFrame]


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` of every node of ``links`` (a, b): the smallest node it is connected to.

    Each round hooks every node to the smallest of its neighbours and itself, follows that hook
    once, and contracts the edges to the hooks reached. The smallest node of a component hooks to
    nothing else, so it is what the component shrinks to; edges disappear as nodes merge, and the
    number of rounds grows with the logarithm of the longest path. A hub of any degree is pre-aggregated
    before the shuffle, and the joins are between written tables, which Spark can split where skewed.
    """
    edges = staged(links.where("a <> b").select("a", "b").distinct(), f"{name}-edges")
    steps = []
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        hooks = both.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("p"))
        above = hooks.select(F.col("u").alias("p"), F.col("p").alias("r"))
        roots = staged(hooks.join(above, "p").select("u", "r"), f"{name}-roots")
        steps.append(roots)
        a = roots.select(F.col("u").alias("a"), F.col("r").alias("ra"))
        b = roots.select(F.col("u").alias("b"), F.col("r").alias("rb"))
        behind = edges
        edges = staged(
            edges.join(a, "a").join(b, "b").where("ra <> rb")
            .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(),
            f"{name}-edges",
        )
        removed(behind)
        if edges.isEmpty():
            break
    removed(edges)
    labels = steps[0].select(F.col("u").alias("node"), F.col("r").alias("component"))
    if len(steps) == 1:
        return labels
    for roots in steps[1:]:
        labels = _relabelled(labels, roots.select(F.col("u").alias("component"), "r"))
    labels = staged(labels, f"{name}-labels")
    removed(*steps)
    return labels


def _relabelled(labels: DataFrame, moved: DataFrame) -> DataFrame:
    """``labels`` (node, component) with the components of ``moved`` (component, r) named r."""
    return labels.join(moved, "component", "left").select("node", F.coalesce("r", "component").alias("component"))


def merged_components(found: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``found`` (node, component) after further ``links`` (a, b): only components are connected anew."""
    a = found.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = found.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    ends = [F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")]
    moved = components(links.join(a, "a", "left").join(b, "b", "left").select(*ends), name)
    old = _relabelled(found, moved.select(F.col("node").alias("component"), F.col("component").alias("r")))
    # A component is named by one of its nodes, so what moved and is no node yet was alone.
    new = moved.join(found.select("node"), "node", "left_anti")
    return staged(old.unionByName(new), f"{name}-merged")


def with_hubs(postings: DataFrame) -> DataFrame:
    """Postings (key, node, info) of keys with two nodes or more, with the first and last node of each
    key as ``low`` and ``high`` (structs of node and info), and in ``size`` its postings, repeated ones too."""
    # Before the structs are made, so that they are not shuffled.
    postings = postings.repartition("key")
    key = W.partitionBy("key")
    here = F.struct("node", "info")
    return (
        postings.withColumn("low", F.min(here).over(key))
        .withColumn("high", F.max(here).over(key))
        .withColumn("size", F.count(F.lit(1)).over(key))
        .where("low.node < high.node")
        .dropDuplicates(["key", "node"])
    )


def between(shared: DataFrame) -> DataFrame:
    """Postings of ``shared`` that may meet others than the ends of their key, if it has two such nodes."""
    return shared.where("size > 3 and node <> low.node and node <> high.node")


def _once(one: Column, other: Column) -> Column:
    """Whether ``key`` is the smallest one that both nodes have."""
    return F.array_min(F.array_intersect(one["keys"], other["keys"])) == F.col("key")


def linked_components(
    shared: DataFrame,
    verify: Verify,
    condition: Condition,
    name: str,
    marks: DataFrame | None = None,
    near: Condition | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """``node, component`` over all pairs of nodes that share a key, meet ``condition`` and pass
    ``verify``, without listing every pair of a large group.

    ``shared`` is the written result of :func:`with_hubs`; ``verify`` takes distinct pairs (a, b)
    and returns those that are linked. First every node is tested against the first and the last
    node of its keys, which is linear in the postings, and connected nodes are merged. What can still
    add a connection is a pair of one key in different components, neither of them an end of it. Nodes outside the largest component
    of a key are then tested against one member of it, drawn anew for every key and round: a node of a
    large group shares many keys with it, and so meets many of its members at a linear cost. In the end all
    pairs that are left are tested: the nodes still outside against the nodes of the key. Pairs within
    a component are left out, because they change nothing.

    ``marks`` (node, mark) is a small digest of every node of ``shared``, and ``near`` takes two structs of
    node, info and mark and may be false only for pairs that ``verify`` would refuse. It is part of the join
    that makes the pairs of the later steps, so most pairs of a large group that are not linked are never made.

    With ``keys`` (node, keys), all keys of every node of ``shared``, the last step makes a pair at the smallest key
    that its nodes share instead of at each. Where one of them is an end of that key, they have been tested.
    """

    def pairs(rows: DataFrame, one: str, other: str, closer: Condition | None = None) -> DataFrame:
        a, b = F.col(f"{one}.node"), F.col(f"{other}.node")
        passing = (a != b) & condition(F.col(f"{one}.info"), F.col(f"{other}.info"))
        if closer:
            passing = passing & closer(F.col(one), F.col(other))
        return rows.where(passing).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))

    members = shared.select(
        "key", F.struct("node", "info").alias("here"), F.col("low"), F.col("high")
    )
    stars = pairs(members, "here", "low").union(pairs(members, "here", "high")).distinct()
    stars = staged(stars, f"{name}-stars")
    links = staged(verify(stars), f"{name}-links")
    removed(stars)
    found = components(links, name)
    removed(links)

    # Every pair with an end of a key has been tested there: what is left are the nodes between the ends.
    members = between(shared).select("key", F.struct("node", "info").alias("here"))
    # Pairs tested against drawn members, which the last step meets again.
    drawn: list[DataFrame] = []
    for attempt in range(HUB_ROUNDS + 1):
        place = (
            members.withColumn("node", F.col("here.node"))
            .join(found, "node", "left")
            .select("key", "here", F.coalesce("component", "node").alias("c"))
        )
        sizes = place.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"))
        open_keys = (
            sizes.groupBy("key")
            .agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "c")).alias("top"))
            .where("parts > 1")
            .select("key", F.col("top.c").alias("top"))
        )
        opened = place.join(open_keys, "key")
        if marks is not None and not attempt:
            marked = F.struct("here.node", "here.info", "mark").alias("here")
            opened = opened.withColumn("node", F.col("here.node")).join(marks, "node").select("key", marked, "c", "top")
        if keys is not None and attempt == HUB_ROUNDS:
            known = F.col("here").withField("keys", F.col("keys")).alias("here")
            opened = opened.withColumn("node", F.col("here.node")).join(keys, "node").select("key", known, "c", "top")
        opened = staged(opened, f"{name}-open")
        minor = opened.where("c <> top").select("key", F.col("here").alias("one"), F.col("c").alias("c1"))
        others = opened
        if attempt < HUB_ROUNDS:
            # One member of the largest component of each key, another for every key and round.
            draw = F.struct(F.xxhash64("key", "here.node", F.lit(attempt)).alias("order"), "here", "c")
            hubs = opened.where("c = top").groupBy("key").agg(F.min(draw).alias("hub"))
            others = hubs.select("key", "hub.here", "hub.c")
        rest = minor.join(others, "key").where("c <> c1 and one.node <> here.node")
        # A pair comes once for every key it shares: they become one, and those tested before go, in one aggregation.
        closer = near
        if keys is not None and attempt == HUB_ROUNDS:
            closer = _once if near is None else lambda one, other: near(one, other) & _once(one, other)
        across = pairs(rest, "one", "here", closer).withColumn("again", F.lit(0))
        for before in drawn:
            across = across.union(before.withColumn("again", F.lit(1)))
        across = across.groupBy("a", "b").agg(F.max("again").alias("again")).where("again = 0").select("a", "b")
        across = staged(across, f"{name}-across")
        drawn.append(across)
        # A key whose nodes are all connected stays so, and is not looked at again.
        if attempt:
            removed(members)
        members = opened
        if not across.isEmpty():
            links = staged(verify(across), f"{name}-links")
            behind, found = found, merged_components(found, links, name)
            removed(links, behind)
    removed(members, *drawn)
    return found
