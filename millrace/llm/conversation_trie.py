"""The prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns. Sequences are compared by two 64-bit hashes, sums (exclusive
or) over turns of a hash of the turn's digest and place, so a prefix needs no text but its own turn.

The tour enters and leaves each node once: an enter arc goes to the first child's, or to the node's own exit
arc; an exit arc goes to the next sibling's enter arc, or to the parent's exit arc. ``list_ranking`` ranks
the tour; an arc's sums hold its position, the leaves entered and the tokens saved from there on. What lies
between a node's two arcs is its subtree, so a difference of two sums is the subtree's total.

No group is gathered: places of turns come from a range partition, prefixes from stretches of ``STRETCH``
turns, siblings from ``BUCKETS`` buckets per parent, the ids that end at a node are hashed in pieces, in
order, as a stream.

Cases: turns go by number (null first), equal ones by role, then text; null roles and texts are empty;
repeated rows are repeated turns; rows without a conv_id belong to no conversation; no conversations give
no nodes. Extra columns are ignored. Turns of any length travel once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import partitions_for, text_or_empty, written
from .list_ranking import FINAL, ranked

STRETCH = 4_096
BUCKETS = 4_096
IDS_PER_PIECE = 1_024
ARCS_PER_BLOCK = 200_000
SPAN, MOST = 20, 4
_PLACED = "conv_id long, place long, part int, digest binary, words long"


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Places of sorted turns within their conversation, counted from the start of the partition."""
    part, open_id, open_turns = TaskContext.get().partitionId(), None, 0
    for rows in batches:
        ids = rows["conv_id"].to_numpy()
        if not len(ids):
            continue
        new = np.append(True, ids[1:] != ids[:-1])
        starts = np.flatnonzero(new)
        place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
        if ids[0] == open_id:
            place[:starts[1] if len(starts) > 1 else None] += open_turns
        open_id, open_turns = ids[-1], place[-1] + 1
        yield pd.DataFrame({"conv_id": ids, "place": place, "part": part, "digest": rows["digest"], "words": rows["words"]})


def placed(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 0), digest and words of each turn.

    A range partition by conversation and turn sorts even one that holds most rows in many tasks.
    """
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", text_or_empty("role").alias("role"), text_or_empty().alias("text"))
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")
    keyed = rows.withColumns({"digest": digest, "words": words})
    ordered = keyed.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    local = written(ordered.select("conv_id", "digest", "words").mapInPandas(_numbered, _PLACED), "trie-turns")
    counts = local.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select("conv_id", "part", F.sum("n").over(before).alias("carried")).filter("carried > 0")
    # Broadcast: only the first conversation of a partition can have begun in another.
    return local.join(F.broadcast(carried), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("carried", F.lit(0))).alias("place"), "digest", "words")


def rebuilt(own: DataFrame, span: int = SPAN, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Turns and members (conv_id, turns) of conversations that begin like the first of their span.

    Conversation c takes the first h turns of c - c % span, h = crc32(c) % most, then its own after its first h.
    """
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    base = sizes.select(F.col("conv_id").alias("_base"), F.col("n").alias("_n"))
    convs = sizes.withColumn("h", taken).withColumn("base", F.col("conv_id") - F.col("conv_id") % span)
    convs = convs.join(base, F.col("base") == F.col("_base"), "left").withColumn("head", F.least("h", F.coalesce("_n", F.lit(0))))
    convs = written(convs.select("conv_id", "n", "h", "base", "head"), "trie-convs")
    # Few rows per key: most - 1 turns of a base, 2 * span conversations.
    heads = own.filter((F.col("place") < most - 1) & (F.col("conv_id") % span == 0)).withColumnRenamed("conv_id", "_base")
    begun = convs.join(heads, (F.col("base") == F.col("_base")) & (F.col("place") < F.col("h"))).select("conv_id", "place", "digest", "words")
    # A conversation of any length is joined by stretches.
    stretches = convs.select("conv_id", "h", "head", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {STRETCH}"))).alias("stretch"))
    rest = own.withColumn("stretch", F.expr(f"place div {STRETCH}")).join(stretches, ["conv_id", "stretch"]).filter("place >= h")
    rest = rest.select("conv_id", (F.col("place") - F.col("h") + F.col("head")).alias("place"), "digest", "words")
    members = convs.select("conv_id", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns"))
    return begun.unionByName(rest), members


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, the hashes a, b of its first ``depth`` turns, those of the parent, and the turn's words."""
    mixed = turns.select(
        "conv_id", "place", F.expr(f"place div {STRETCH}").alias("stretch"), "words",
        F.xxhash64("digest", "place").alias("ma"), F.xxhash64(F.lit(7), "digest", "place").alias("mb"))
    within = Window.partitionBy("conv_id", "stretch").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    local = mixed.withColumns({"a": F.bit_xor("ma").over(within), "b": F.bit_xor("mb").over(within)})
    totals = mixed.groupBy("conv_id", "stretch").agg(F.bit_xor("ma").alias("ta"), F.bit_xor("mb").alias("tb"))
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv_id", "stretch", F.bit_xor("ta").over(before).alias("ca"), F.bit_xor("tb").over(before).alias("cb")).filter("stretch > 0")
    joined = local.join(carried, ["conv_id", "stretch"], "left")
    whole = {x: F.col(x).bitwiseXOR(F.coalesce(f"c{x}", F.lit(0).cast("long"))) for x in "ab"}
    return joined.select(
        "conv_id", (F.col("place") + 1).alias("depth"), whole["a"].alias("a"), whole["b"].alias("b"),
        whole["a"].bitwiseXOR(F.col("ma")).alias("pa"), whole["b"].bitwiseXOR(F.col("mb")).alias("pb"), "words")


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of ids that end at one node, in order, as texts."""
    for rows in batches:
        key = rows[["depth", "a", "b"]].to_numpy()
        new = np.append(True, (key[1:] != key[:-1]).any(axis=1)) if len(key) else np.zeros(0, bool)
        run = np.flatnonzero(new)
        stops = np.append(run[1:], len(rows))
        cuts = [(i, min(i + IDS_PER_PIECE, stop)) for start, stop in zip(run, stops, strict=True) for i in range(start, stop, IDS_PER_PIECE)]
        ids = rows["conv_id"].astype(str).to_numpy()
        yield rows.iloc[[i for i, _ in cuts]].assign(piece=[",".join(ids[i:j]) for i, j in cuts])


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the joined pieces of each node; pieces come in order."""
    node, digest = None, None
    for rows in batches:
        out = []
        for key, piece in zip(rows[["depth", "a", "b"]].itertuples(index=False, name=None), rows["piece"], strict=True):
            if key == node:
                digest.update(b"," + piece.encode())
                continue
            if node is not None:
                out.append((*node, digest.hexdigest()))
            node, digest = key, hashlib.sha256(piece.encode())
        yield pd.DataFrame(out, columns=["depth", "a", "b", "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(*node, digest.hexdigest())], columns=["depth", "a", "b", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, a, b, ends_sha256: SHA-256 of the ids (ascending, joined by commas) of conversations that end at a node."""
    key = ["depth", "a", "b"]
    ordered = ends.select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    pieces = ordered.mapInPandas(_pieces, "depth long, a long, b long, conv_id long, piece string")
    return pieces.repartition(*key).sortWithinPartitions(*key, "conv_id").mapInPandas(_digests, "depth long, a long, b long, ends_sha256 string")


def families(nodes: DataFrame) -> DataFrame:
    """Nodes and their children in buckets: one row per node (bucket -1) and per bucket of children.

    Rows of buckets hold ``kids``, their ids and conv_ids in order; all rows the node's id as ``owner``, its
    conv_id as ``owner_conv``, its number of children, and the first child of the next bucket.
    """
    kid = F.struct("conv_id", "id")
    bucket = F.pmod(F.xxhash64("conv_id"), F.lit(BUCKETS)).cast("int")
    children = nodes.filter("depth > 0").withColumn("bucket", bucket).groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"), "bucket").agg(F.sort_array(F.collect_list(kid)).alias("kids"))
    parents = nodes.select("depth", "a", "b", F.lit(-1).alias("bucket"), "id", "conv_id", "n_convs", "saved")
    # A node has BUCKETS + 1 rows at most.
    whole = Window.partitionBy("depth", "a", "b")
    order = whole.orderBy("bucket")
    return parents.unionByName(children, allowMissingColumns=True).select(
        "*", F.first("id").over(order).alias("owner"), F.first("conv_id").over(order).alias("owner_conv"),
        F.sum(F.coalesce(F.size("kids"), F.lit(0))).over(whole).alias("n_children"),
        F.lead(F.col("kids")[0]["id"]).over(order).alias("next_kid"))


def tour(family: DataFrame, blocks: int) -> DataFrame:
    """The arcs: item (2 id to enter, 2 id + 1 to leave), next, block, steps, leaves, saved."""
    zero = F.lit(0).cast("long")
    entering = family.filter("bucket = -1")
    enter = entering.select(
        (2 * F.col("id")).alias("item"), F.coalesce(2 * F.col("next_kid"), 2 * F.col("id") + 1).alias("next"), "conv_id", "depth",
        (F.col("n_children") == 0).cast("long").alias("leaves"), "saved")
    last = entering.filter("depth = 0").select(
        (2 * F.col("id") + 1).alias("item"), F.lit(None).cast("long").alias("next"), "conv_id", "depth", zero.alias("leaves"), zero.alias("saved"))
    kids = family.filter("bucket >= 0").select("kids", "owner", "next_kid", (F.col("depth") + 1).alias("depth"), F.posexplode("kids").alias("i", "kid"))
    sibling = F.coalesce(F.get("kids", F.col("i") + 1)["id"], F.col("next_kid"))
    leave = kids.select(
        (2 * F.col("kid.id") + 1).alias("item"), F.coalesce(2 * sibling, 2 * F.col("owner") + 1).alias("next"), F.col("kid.conv_id").alias("conv_id"), "depth",
        zero.alias("leaves"), zero.alias("saved"))
    # A conversation's own part of the tour stays together, in stretches.
    block = F.pmod(F.xxhash64("conv_id", F.expr("depth div 1024")), F.lit(blocks)).cast("int")
    arcs = enter.unionByName(last).unionByName(leave)
    return arcs.select("item", "next", block.alias("block"), F.lit(1).cast("long").alias("steps"), "leaves", "saved")


def trie(turns: DataFrame, members: DataFrame, final: int = FINAL) -> DataFrame:
    """One row per node, see ``prefix_trie``, of members (conv_id, turns) and their turns."""
    rows = written(prefixes(turns), "trie-prefixes")
    here = [F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")]
    deep = rows.groupBy("depth", "a", "b").agg(*here, F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.first("words").alias("words"))
    nothing = F.lit(0).cast("long")
    root = members.agg(*here).filter("n_convs > 0").withColumns({x: nothing for x in ("depth", "a", "b", "pa", "pb", "words")})
    nodes = deep.unionByName(root).withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).withColumn("id", F.monotonically_increasing_id())
    # Written, so that the ids stay what they are.
    nodes = written(nodes, "trie-nodes")
    family = written(families(nodes), "trie-families")
    blocks = max(nodes.sparkSession.sparkContext.defaultParallelism, partitions_for(2 * nodes.count(), ARCS_PER_BLOCK))
    sums = ranked(tour(family, blocks), ["steps", "leaves", "saved"], final)

    # To the end of the tour from the enter arc, less the same from the exit arc.
    side = F.when(F.col("item") % 2 == 0, 1).otherwise(-1)
    subtree = sums.select(
        F.expr("item div 2").alias("id"), F.when(F.col("item") % 2 == 0, F.col("steps")).alias("left_over"),
        (side * F.col("leaves")).alias("n_leaves"), (side * F.col("saved")).alias("saved_tokens"))
    above = family.filter("bucket >= 0").select(F.explode("kids").alias("kid"), "owner_conv").select(F.col("kid.id").alias("id"), F.col("owner_conv").alias("parent_conv_id"))
    last_turn = members.filter("turns > 0").select("conv_id", F.col("turns").alias("depth"))
    ends = rows.join(last_turn, ["conv_id", "depth"], "left_semi").select("depth", "a", "b", "conv_id")
    ends = ends.unionByName(members.filter("turns = 0").select(*[nothing.alias(x) for x in ("depth", "a", "b")], "conv_id"))
    own = family.filter("bucket = -1").select("id", "conv_id", "depth", "a", "b", "n_convs", "n_children")
    own = own.join(end_digests(ends), ["depth", "a", "b"], "left").drop("a", "b")
    facts = own.unionByName(above, allowMissingColumns=True).unionByName(subtree, allowMissingColumns=True).groupBy("id").agg(
        *[F.max(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children")],
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("ends_sha256").alias("ends_sha256"),
        F.max("left_over").alias("left_over"))
    return facts.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "left_over")


def prefix_trie(turns: DataFrame, final: int = FINAL) -> DataFrame:
    """One row per distinct prefix of conversations, from the empty one.

    conv_id: its smallest member, with depth the name of the node; parent_conv_id; n_convs: members; n_children;
    n_leaves: childless nodes of the subtree; saved_tokens: (members - 1) * words of the last turn, over the subtree;
    ends_sha256: of the ids of the conversations that end here; left_over: arcs of the tour from its enter arc on.
    """
    own = placed(turns)
    return trie(own, own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns")), final)
