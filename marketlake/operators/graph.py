"""Weighted co-occurrence graphs, connected components and label propagation as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.session import discard, written_table

#: Groups of an item whose numbers share all but the last so many bits are compared at a time.
BLOCK_BITS = 12
#: Label propagation stops here at the latest; a cycle of states is noticed earlier.
MOST_ROUNDS = 50


def _both_ways(edges: DataFrame, *columns: str) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v"), *columns).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"), *columns))


def _state(labels: DataFrame) -> tuple:
    return tuple(labels.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "label").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over ``edges`` (a, b), for every node of an edge.

    Each round takes the smallest label around a node and then the label of that label, so
    long chains halve; a round is written before the next and the one before deleted.
    """
    spark = edges.sparkSession
    links, links_path = written_table(
        _both_ways(edges.filter("a is not null and b is not null")).distinct(), "links")
    labels, path = written_table(links.select(F.col("u").alias("node")).distinct().withColumn(
        "label", F.col("node")), "labels")
    state = _state(labels)
    while True:
        around = links.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy(
            F.col("u").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(around, "node").select("node", F.least("label", "near").alias("label"))
        low, low_path = written_table(lower, "labels")
        up = low.select(F.col("node").alias("label"), F.col("label").alias("top"))
        new, new_path = written_table(
            low.join(up, "label").select("node", F.col("top").alias("label")), "labels")
        new_state = _state(new)
        discard(spark, low_path)
        discard(spark, path)
        labels, path = new, new_path
        if new_state == state:
            discard(spark, links_path)
            return labels
        state = new_state


def cooccurrence(rows: DataFrame, group: str, item: str, least_share: float, least_weight: int = 1) -> DataFrame:
    """(a, b, weight, share): pairs of items, a < b, that meet in ``weight`` groups.

    ``share`` is weight over the groups that hold either; kept are pairs with at least
    ``least_share`` (above 0) and ``least_weight``.  Only pairs that meet in the prefixes of
    their groups are compared: an item's groups in order of their number of items, without
    the last ones, fewer than ``least_share`` of them, in which two items of that share can
    not meet for the first time.  So an item of all groups and a group of all items are
    compared where they are cheapest.  Null groups and items take no part.
    """
    spark = rows.sparkSession
    plain = rows.select(F.col(group).alias("group"), F.col(item).alias("item")).dropna().distinct()
    held, held_path = written_table(plain, "held")
    sizes = held.groupBy("group").agg(F.count(F.lit(1)).alias("wide"))
    # Groups get a number each, in the order that decides the prefixes: rarest items first.
    counts = held.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    ranked = held.join(sizes, "group").join(counts.filter(F.col("n") >= least_weight), "item")
    numbered = ranked.select("item", "n", "wide", F.xxhash64("group").alias("mark"), "group")
    postings, postings_path = written_table(numbered, "postings")
    # The first floor((1 - share) * n) + 1 groups of an item, found by counting per width, never by
    # sorting an item's groups: widths that fit whole, and of the width at the edge all groups.
    widths = postings.groupBy("item", "n", "wide").agg(F.count(F.lit(1)).alias("here"))
    before = Window.partitionBy("item").orderBy("wide").rowsBetween(Window.unboundedPreceding, -1)
    length = F.floor((1 - F.lit(least_share)) * F.col("n") + 1e-9) + 1
    inside = widths.withColumn("before", F.coalesce(F.sum("here").over(before), F.lit(0))).filter(
        F.col("before") < length)
    edge = inside.groupBy("item").agg(F.max("wide").alias("edge"))
    prefix = postings.join(edge, "item").filter(F.col("wide") <= F.col("edge")).select("group", "item", "n")
    other = prefix.select("group", F.col("item").alias("b"), F.col("n").alias("n_b"))
    met = prefix.select("group", F.col("item").alias("a"), F.col("n").alias("n_a")).join(other, "group").filter(
        (F.col("a") < F.col("b")) & (F.least("n_a", "n_b") >= F.lit(least_share) * F.greatest("n_a", "n_b") - 1e-9))
    pairs, pairs_path = written_table(met.select("a", "b", "n_a", "n_b").distinct(), "pairs")
    # Exact weights from blocks of groups, whose lists have a bound.
    blocks = postings.join(dense_numbers(held), "group").groupBy(
        "item", F.shiftright("number", BLOCK_BITS).alias("block")).agg(F.collect_list("number").alias("groups"))
    blocks, blocks_path = written_table(blocks, "blocks")
    left = pairs.join(blocks.select(F.col("item").alias("a"), "block", F.col("groups").alias("groups_a")), "a")
    shared = left.join(blocks.select(F.col("item").alias("b"), "block", "groups"), ["b", "block"]).groupBy(
        "a", "b", "n_a", "n_b").agg(F.sum(F.size(F.array_intersect("groups_a", "groups"))).cast("long").alias("weight"))
    share = F.col("weight") / (F.col("n_a") + F.col("n_b") - F.col("weight"))
    edges, _ = written_table(shared.withColumn("share", share).filter(
        (F.col("weight") >= least_weight) & (F.col("share") >= F.lit(least_share))).select(
        "a", "b", "weight", "share"), "edges")
    for path in (held_path, postings_path, pairs_path, blocks_path):
        discard(spark, path)
    return edges


def dense_numbers(held: DataFrame) -> DataFrame:
    """(group, number): groups counted from 0 by range partitions, so that a block has a bound."""
    groups, _ = written_table(held.select("group").distinct(), "groups")
    tasks = max(1, -(-groups.count() // 1_000_000))
    dealt, _ = written_table(groups.repartition(tasks, "group").select(
        "group", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), "numbers")
    sizes = dealt.groupBy("part").agg((F.max("at") + 1).alias("n"))
    shift = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("shift"))
    return dealt.join(shift, "part").select("group", (F.col("at") + F.col("shift")).alias("number"))


def propagate_labels(edges: DataFrame, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """(node, label): clusters of ``edges`` (a, b, weight) by label propagation.

    All nodes begin with their own label.  In a round every node takes the label with the
    largest sum of weights around it, the smallest of equals; its own label counts with the
    weight of its strongest edge, so two neighbours do not swap labels for ever.  Rounds end
    when no label changes, when a state comes back, or after ``most_rounds``.
    """
    spark = edges.sparkSession
    links, _ = written_table(_both_ways(edges, "weight"), "links")
    own = links.groupBy("u").agg(F.max("weight").alias("weight")).select(
        "u", F.col("u").alias("v"), "weight")
    votes, votes_path = written_table(links.unionByName(own), "votes")
    labels, path = written_table(links.select(F.col("u").alias("node")).distinct().withColumn(
        "label", F.col("node")), "labels")
    seen = {_state(labels)}
    for _ in range(most_rounds):
        sums = votes.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u", "label").agg(
            F.sum("weight").alias("weight"))
        best = sums.groupBy(F.col("u").alias("node")).agg(
            F.min(F.struct((-F.col("weight")).alias("order"), "label")).alias("best"))
        new, new_path = written_table(best.select("node", F.col("best.label").alias("label")), "labels")
        discard(spark, path)
        labels, path = new, new_path
        state = _state(labels)
        if state in seen:
            break
        seen.add(state)
    discard(spark, votes_path)
    return labels
