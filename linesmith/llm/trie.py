"""The trie of conversations that begin alike.

A node is a sequence of first turns; its members are the conversations that start
with it. Turns are never compared as texts: a turn has two 64-bit hashes of its
place, role and text, and a sequence has their exclusive or.

1. ``BLOCK`` turns make a block, with the digest of its turns and that of all
   turns before it. Conversations are grouped by successive block digests: a
   group is a block number and the digest before it.
2. Where all members of a group go on with the same block, every node inside has
   the same members, and one member's turns stand for them. Only blocks in which
   siblings diverge are refined to single turns.
3. A conversation is the least member from some depth on to its end. What a
   subtree holds follows from sums over members: a conversation saves the texts it
   shares with a lesser member, and a subtree has as many leaves as it has members
   that are the least in a childless node in which they end.
4. Members that end in a node are listed in ranges of ids, and a range is one
   row of the node's digest.

No step gathers a group: counts combine before the shuffle, running digests go in
stretches of ``STRETCH`` blocks, and a join partner of more than a 2,048th of the
rows, of which there are fewer than 2,048, is broadcast.

Turns come in order of turn (null first), then role, then text (after 64
characters by its hash). Null roles and texts are empty ones. Rows without a
conversation id belong to no conversation and are left out. Repeated rows are
turns of their own; rows equal in all of these may come in any order. An empty
table has no conversations and no nodes, not even a root. Only the four
columns named are read, so others cannot clash; a conversation or text of any
length is a sum over its turns or one hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..operators.ordered import number_within
from ..session import staged
from .batches import give_back
from .shipping import ship
from .texts import shuffle_width

ship(__name__)

BLOCK = 4
STRETCH = 1_024
#: A key with more than this part of all rows is joined by broadcast; there are fewer such keys.
HOT = 2_048
#: Ids in one row of a node's digest.
LISTED = 1_024
NOTHING = hashlib.sha256(b"").hexdigest()


def spread_join(rows: DataFrame, facts: DataFrame, on: list[str], weight: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``facts``, which has one row per key and in ``weight`` its number of rows.

    Both are read twice, so they should be stored.
    """
    total = facts.agg(F.sum(weight)).first()[0] or 0
    many = F.col(weight) * HOT > F.lit(total)
    hot, cold = (facts.where(c).drop(weight) for c in (many, ~many))
    return (rows.join(F.broadcast(hot), on)
            .unionByName(rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on, how)))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``at`` (from 0), two hashes of role and text, and ``chars``."""
    said = turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    narrow = said.select("conv_id", "turn", "role", F.substring("text", 1, 64).alias("head"), F.xxhash64("role", "text").alias("one"),
                         F.xxhash64(F.lit("second"), "text", "role").alias("two"), F.length("text").cast("long").alias("chars"))
    return staged(number_within(narrow, ["conv_id"], "turn", "at", ["role", "head", "one", "two"])
                  .select("conv_id", (F.col("at") - 1).alias("at"), "one", "two", "chars"), "trie-numbered")


def with_borrowed_heads(turns: DataFrame, base: Column, borrowed: Column, most: int) -> DataFrame:
    """Numbered turns of conversations whose first ``borrowed`` (up to ``most``) turns are those of conversation ``base``.

    A conversation's own turns follow from place ``borrowed`` on, behind as many as
    its base has. Conversations without any turn left are one row with a null
    place. ``base`` and ``borrowed`` are expressions over ``conv_id``.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumns({"base": base, "h": borrowed})
    heads = (turns.where(F.col("at") < most).join(sizes.select(F.col("base").alias("conv_id")).distinct(), "conv_id", "left_semi")
             .groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("at", "one", "two", "chars"))).alias("head")))
    taken = F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h"))
    plans = staged(sizes.join(heads, "base", "left").withColumn("head", taken), "heads")
    borrowed_rows = plans.select("conv_id", F.inline("head"))
    moved = F.size("head") - F.col("h")
    own = (spread_join(turns, plans.select("conv_id", "h", moved.alias("moved"), "n"), ["conv_id"], "n")
           .where(F.col("at") >= F.col("h")).select("conv_id", (F.col("at") + F.col("moved")).alias("at"), "one", "two", "chars"))
    none = F.lit(None).cast("long")
    empty = plans.where((F.size("head") == 0) & (F.col("n") <= F.col("h"))).select(
        "conv_id", none.alias("at"), none.alias("one"), none.alias("two"), F.lit(0).cast("long").alias("chars"))
    return borrowed_rows.unionByName(own).unionByName(empty)


def _blocks(turns: DataFrame, block: int, stretch: int) -> DataFrame:
    """One row per conversation and block, with the digest of its turns, and digest and characters before it."""
    marks = turns.where(F.col("at").isNotNull()).select(
        "conv_id", F.floor(F.col("at") / block).alias("block"), "at", F.xxhash64("one", "two", "at").alias("a"),
        F.xxhash64(F.lit("second"), "two", "at", "one").alias("b"), "chars")
    rows = (marks.groupBy("conv_id", "block")
            .agg(F.bit_xor("a").alias("da"), F.bit_xor("b").alias("db"), F.sum("chars").alias("size"),
                 F.sort_array(F.collect_list(F.struct("at", "a", "b", "chars"))).alias("turns"))
            .withColumn("part", F.floor(F.col("block") / stretch)))
    before = Window.partitionBy("conv_id", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumns({"pa": F.coalesce(F.bit_xor("da").over(before), F.lit(0).cast("long")),
                              "pb": F.coalesce(F.bit_xor("db").over(before), F.lit(0).cast("long")),
                              "past": F.coalesce(F.sum("size").over(before), F.lit(0).cast("long"))})
    local = staged(local, "trie-local")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (local.groupBy("conv_id", "part").agg(F.bit_xor("da").alias("ca"), F.bit_xor("db").alias("cb"), F.sum("size").alias("cs"))
               .withColumns({c: F.coalesce((F.sum(c) if c == "cs" else F.bit_xor(c)).over(earlier), F.lit(0).cast("long")) for c in ("ca", "cb", "cs")})
               .where("part > 0"))
    first = local.where("part = 0").drop("part")
    later = local.where("part > 0").join(carried, ["conv_id", "part"]).select(
        *[c for c in first.columns if c not in ("pa", "pb", "past")], F.col("pa").bitwiseXOR(F.col("ca")).alias("pa"),
        F.col("pb").bitwiseXOR(F.col("cb")).alias("pb"), (F.col("past") + F.col("cs")).alias("past"))
    return first.unionByName(later)


def _refined(rows: DataFrame, *more: str) -> DataFrame:
    """One row per turn of the blocks: depth, digests of the node and of its parent, characters before the turn."""
    def upto(field: str, i: Column) -> Column:
        return F.aggregate(F.slice("turns", F.lit(1), i), F.lit(0).cast("long"), lambda x, t: x.bitwiseXOR(t[field]) if field != "chars" else x + t[field])
    steps = F.transform("turns", lambda t, i: F.struct(
        (t["at"] + 1).alias("depth"), F.col("pa").bitwiseXOR(upto("a", i + 1)).alias("a"), F.col("pb").bitwiseXOR(upto("b", i + 1)).alias("b"),
        F.col("pa").bitwiseXOR(upto("a", i)).alias("above_a"), F.col("pb").bitwiseXOR(upto("b", i)).alias("above_b"),
        t["chars"].alias("chars"), (F.col("past") + upto("chars", i)).alias("past")))
    return rows.select(*more, F.inline(steps))


def _ends(convs: DataFrame, parts: int) -> DataFrame:
    """``ends_sha256`` of the ids that end in a node, ascending; only a node's lists of ids meet in one task."""
    node = ["depth", "a", "b"]
    names = [*node, "least", "ids"]

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def row() -> tuple:
            return (*key, ids[0], ",".join(map(str, ids)))
        for batch in batches:
            out = []
            for *now, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != key or len(ids) >= LISTED:
                    if ids:
                        out.append(row())
                    key, ids = now, []
                ids.append(conv)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*[row()], strict=True)], names=names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out = []
            for *now, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != key:
                    if key:
                        out.append((*key, digest.hexdigest()))
                    key, digest = now, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[*node, "ends_sha256"])
        if key:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*[(*key, digest.hexdigest())], strict=True)], names=[*node, "ends_sha256"])
        give_back()
    kinds = "depth long, a long, b long"
    listed = (convs.repartitionByRange(parts, *node, "conv_id").sortWithinPartitions(*node, "conv_id")
              .mapInArrow(lists, f"{kinds}, least long, ids string"))
    return (listed.repartition(parts, *node).sortWithinPartitions(*node, "least")
            .mapInArrow(digests, f"{kinds}, ends_sha256 string"))


def prefix_trie(turns: DataFrame, *, block: int = BLOCK, stretch: int = STRETCH) -> DataFrame:
    """One row per node of the trie of numbered turns (``conv_id``, ``at``, ``one``, ``two``, ``chars``).

    A null place stands for a conversation without turns. ``block`` and ``stretch``
    do not change the result.
    """
    spark, zero = turns.sparkSession, F.lit(0).cast("long")
    node = ["depth", "a", "b"]
    turns = staged(turns, "trie-turns")
    blocks = staged(_blocks(turns, block, stretch), "trie-blocks")
    digest = F.struct("da", "db")
    group = ["block", "pa", "pb"]
    groups = staged(blocks.groupBy(*group).agg(F.count(F.lit(1)).alias("members"), F.count(F.lit(1)).alias("rows"), F.min("conv_id").alias("lead"),
                                               (F.min(digest) != F.max(digest)).alias("diverges")), "trie-groups")
    told = spread_join(blocks, groups, group, "rows")
    marked = staged(told.withColumn("turns", F.when(F.col("diverges") | (F.col("conv_id") == F.col("lead")), F.col("turns"))), "trie-marked")

    weight = F.when(F.col("diverges"), 1).otherwise(F.col("members"))
    steps = _refined(marked.where(F.col("turns").isNotNull()).withColumn("weight", weight), "conv_id", "weight")
    nodes = staged(steps.groupBy(*node).agg(F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.any_value("chars").alias("chars"),
                                            F.any_value("past").alias("past"), F.any_value("above_a").alias("above_a"), F.any_value("above_b").alias("above_b")), "trie-nodes")
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("above_a").alias("a"), F.col("above_b").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    convs = staged(turns.groupBy("conv_id").agg(
        F.count("at").alias("depth"), F.coalesce(F.bit_xor(F.xxhash64("one", "two", "at")), zero).alias("a"),
        F.coalesce(F.bit_xor(F.xxhash64(F.lit("second"), "two", "at", "one")), zero).alias("b"), F.sum("chars").alias("size"))
        .withColumns({c: F.when(F.col("depth") == 0, zero).otherwise(F.col(c)) for c in ("a", "b")}), "trie-convs")
    root = (convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
            .select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "n_convs", "conv_id", zero.alias("chars"), zero.alias("past"),
                    F.lit(None).cast("long").alias("above_a"), F.lit(None).cast("long").alias("above_b")))
    nodes = staged(nodes.unionByName(root).join(children, node, "left").withColumn("n_children", F.coalesce("n_children", zero)), "trie-counted")

    owned = nodes.groupBy("conv_id").agg(F.min_by("past", "depth").alias("shared"), F.max(F.struct("depth", "n_children")).alias("last"))
    # the characters a conversation shares with a lesser one, and whether it is a leaf's least member
    facts = staged(convs.join(owned, "conv_id", "left").select(
        "conv_id", F.coalesce("shared", "size").alias("shared"),
        F.coalesce(((F.col("last.depth") == F.col("depth")) & (F.col("last.n_children") == 0)).cast("long"), zero).alias("leaf"),
        F.ceil(F.greatest(F.col("depth"), F.lit(1)) / block).alias("rows")), "trie-facts")
    known = spread_join(marked, facts, ["conv_id"], "rows")
    left = F.greatest(F.col("shared") - F.col("past"), zero)
    apart = (_refined(known.where("diverges"), "shared", "leaf").groupBy(*node)
             .agg(F.sum(left).alias("saved_tokens"), F.sum("leaf").alias("n_leaves")))
    others = F.when(F.col("conv_id") != F.col("lead"), F.col("shared"))
    sums = (known.where("not diverges").groupBy(*group)
            .agg(F.coalesce(F.sum(others), zero).alias("shared"), F.count(others).alias("others"), F.sum("leaf").alias("leaf"),
                 F.max("turns").alias("turns"), F.any_value("past").alias("past")))
    together = _refined(sums, "shared", "others", "leaf").select(
        *node, (F.col("shared") - F.col("others") * F.col("past")).alias("saved_tokens"), F.col("leaf").alias("n_leaves"))
    whole = facts.agg(F.sum("shared").alias("saved_tokens"), F.sum("leaf").alias("n_leaves")).where("n_leaves is not null").select(
        zero.alias("depth"), zero.alias("a"), zero.alias("b"), "saved_tokens", "n_leaves")
    parents = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("a").alias("above_a"), F.col("b").alias("above_b"),
                                                   F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("rows"))
    below = spread_join(nodes.where("depth > 0"), staged(parents, "trie-parents"), ["depth", "above_a", "above_b"], "rows")
    with_parent = below.unionByName(nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    ends = _ends(convs.select(*node, "conv_id"), shuffle_width(spark))
    return (with_parent.join(apart.unionByName(together).unionByName(whole), node).join(ends, node, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")))
