"""Connected groups of similar rows, found without writing out all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import forget, matching, materialize

Fits = Callable[[Column, Column], Column]
Verify = Callable[[DataFrame], DataFrame]


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until nothing changes. Both
    take a minimum per node, which combines before the shuffle, and join it back to the edges, so
    a node with any number of neighbours is split like any large join key. Every step is written,
    so a lost executor costs that step alone, and is deleted when the next one is there.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    stars = materialize(edges.select(a, b).where("a > b").distinct(), "edges")
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a AND b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        up = least.select("a", F.col("m").alias("b"))
        old, stars = stars, materialize(down.unionByName(up).where("a > b").distinct(), "stars")
        forget(old, large)
        state = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def connected_groups(
    buckets: DataFrame,
    fits: Fits,
    verify: Verify,
    hub_rounds: int = 3,
    details: DataFrame | None = None,
    near: Fits | None = None,
    pairs_up_to: int = 0,
    counted: bool = False,
) -> DataFrame:
    """(node, component) of the graph of verified pairs that share a bucket; linked nodes only.

    ``buckets`` has the columns signature, node and info (what ``fits`` needs to know of a node);
    ``verify`` gives those of the pairs (a, b) that are links. First, members of each bucket are
    held against one of them, the bucket's hub, which ties a dense group together with a link per
    member. A hub is the member that shares the largest buckets, in later rounds one of those. Members already connected need no further look. At last every pair of a bucket that is
    still in different groups, and not yet looked at, is verified: no link between groups is lost,
    whatever the hubs were. Of these pairs one member is outside the bucket's largest group, so
    their number follows what the hubs have left over. ``near`` may rule out pairs that cannot be
    links, by the column detail of ``details`` (node, detail), before they are written out.
    Buckets of at most ``pairs_up_to`` members skip all this: their pairs are written out at once,
    no more than half that number for each of their rows. With ``counted`` the buckets
    are a written table of shared ones alone, with their number of ``members``.
    """

    if not counted:
        buckets = materialize(buckets, "buckets")
        shared = buckets.groupBy("signature").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        every, buckets = buckets, matching(buckets, shared, "signature", "shared")
        forget(every)
    labels: DataFrame | None = None
    tried: DataFrame | None = None
    if pairs_up_to:
        few = buckets.where(F.col("members") <= pairs_up_to)
        together = few.groupBy("signature").agg(F.sort_array(F.collect_list(F.struct("node", "info"))).alias("all"))
        each = together.select("all", F.posexplode("all").alias("i", "one"))
        pairs = each.select("one", F.explode(F.slice("all", 1, F.col("i"))).alias("other"))
        pairs = pairs.where((F.col("other.node") < F.col("one.node")) & fits(F.col("other.info"), F.col("one.info")))
        pairs = pairs.select(F.col("other.node").alias("a"), F.col("one.node").alias("b"))
        tried = materialize(pairs.distinct(), "few-pairs")
        labels = connected(verify(tried))
        buckets = buckets.where(F.col("members") > pairs_up_to)
    # Who shares most with most is likely to be at the heart of its group.
    weights = buckets.groupBy("node").agg(F.sum("members").alias("weight"))
    given, buckets = buckets, materialize(buckets.drop("members").join(weights, "node"), "weighted")
    if not counted:
        forget(given)
    for turn in range(hub_rounds + 1):
        members = _labelled(buckets, labels)
        if turn < hub_rounds:
            heart = F.col("weight") if turn == 0 else F.floor(F.log2("weight"))
            place = F.struct(heart.alias("heart"), F.xxhash64("node", F.lit(turn)).alias("any"))
            hubs = members.groupBy("signature").agg(
                F.max(F.struct(place.alias("place"), "node", "info", "component")).alias("hub"),
                F.min("component").alias("low"),
                F.max("component").alias("high"),
            )
            open_hubs = hubs.where("low < high").select("signature", "hub")
            pairs = (
                members.join(open_hubs, "signature")
                .where((F.col("component") != F.col("hub.component")) & fits(F.col("info"), F.col("hub.info")))
                .select(F.col("node").alias("x"), F.col("hub.node").alias("y"))
            )
        else:
            parts = members.groupBy("signature", "component").agg(F.count(F.lit(1)).alias("size"))
            still_open = (
                parts.groupBy("signature")
                .agg(F.max(F.struct("size", "component")).alias("main"), F.count(F.lit(1)).alias("groups"))
                .where("groups > 1")
                .select("signature", F.col("main.component").alias("main"))
            )
            everyone = members.join(still_open, "signature")
            if details is not None:
                everyone = everyone.join(details, "node")
            everyone = materialize(everyone, "open")
            others = everyone.select(*(F.col(c).alias(f"{c}_2") for c in everyone.columns))
            possible = (
                (F.col("signature") == F.col("signature_2"))
                & (F.col("component") != F.col("component_2"))
                & ((F.col("component_2") == F.col("main")) | (F.col("node") < F.col("node_2")))
                & fits(F.col("info"), F.col("info_2"))
            )
            if near is not None:
                possible &= near(F.col("detail"), F.col("detail_2"))
            outside = everyone.where(F.col("component") != F.col("main"))
            pairs = outside.join(others, possible).select(F.col("node").alias("x"), F.col("node_2").alias("y"))
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        if turn == hub_rounds:
            forget(everyone)
        if labels is not None and pairs.isEmpty():
            forget(pairs)
            continue
        links = verify(pairs)
        if labels is not None:
            links = links.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        old, labels = labels, connected(links)
        if old is not None:
            forget(old)
        tried = pairs if tried is None else tried.unionByName(pairs)
    forget(buckets)
    if tried is not None:
        forget(tried)
    return labels


def _labelled(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return buckets.withColumn("component", F.col("node"))
    return buckets.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
