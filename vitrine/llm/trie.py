"""Prefix trie of conversations by whole-sequence collapse.

Identical conversations become one weighted sequence with a list of the
conversations that end there.  Sequences that are proper prefixes of others go
by an anti-join with the prefixes; what is left are the leaves.  The weighted
prefixes of the sequences, aggregated by prefix, are the nodes.

A prefix is named by its depth and four sums of 32 bits of SHA-256 over
(position, role, text): 128 bits in which order matters, and which a running sum
builds without ever gathering a conversation in one row.  Row numbers and
running sums go over ranges of (conversation, position), so one conversation
may hold any share of all turns.

A node's smallest member owns it.  The nodes that a sequence owns are the tail of
its path, so saved tokens of a subtree are sums, over the sequences through its
top, of what they own from there on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitrine.llm.common import parallelism, step
from vitrine.operators.ranking import range_parts, ranged_row_number, ranged_sum_before

KEY = ["depth", "k1", "k2", "k3", "k4"]
PARENT = ["parent_depth", "p1", "p2", "p3", "p4"]
#: Ids in one row of an end list.
CHUNK = 256


@dataclass
class Trie:
    """``nodes``: KEY, PARENT, conv_id (smallest member), n_convs, n_children,
    n_leaves, saved_tokens, parent_conv_id.  ``ends``: KEY, chunk, ids: the
    conversations that are a node's sequence, ascending over the chunks."""

    nodes: DataFrame
    ends: DataFrame


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``i`` (1, 2, ... in order of turn, NULL first, then by
    digest), ``digest`` of role and text, ``chars`` of the text.  NULL role and
    text are empty; a row without conv_id belongs to no conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("digest"), F.length(text).cast("long").alias("chars"))
    return ranged_row_number(turns, ["conv_id"], ["turn", "digest"], "i").drop("turn")


def rebuild(turns: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """Conversations that begin with shared turns: ``conv_id``, ``depth``,
    ``digest``, ``chars``; depth 0 is the textless beginning of each.

    The first h turns (all if fewer, none if absent) come from conversation
    ``conv_id - conv_id % every``, then the own ones after the first h; h is the
    unsigned crc32 of the decimal conv_id modulo ``heads``."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h)
    taken = (convs.join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
             .select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("m")))
    # at most heads - 1 turns of a base reach its conversations
    first = turns.where(F.col("i") < heads).select(F.col("conv_id").alias("base"), F.col("i").alias("depth"), "digest", "chars")
    shared = taken.join(first, "base").where("depth <= m").select("conv_id", "depth", "digest", "chars")
    own = (turns.join(taken.select("conv_id", "h", "m"), "conv_id").where("i > h")
           .select("conv_id", (F.col("m") + F.col("i") - F.col("h")).alias("depth"), "digest", "chars"))
    start = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("chars"))
    return shared.unionByName(own).unionByName(start)


def _prefix_sums(paths: DataFrame) -> DataFrame:
    """Add KEY's sums up to each turn and PARENT's up to the one before."""
    each = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")).cast("binary"), 256)
    paths = paths.withColumn("__h", each)
    for k in range(1, 5):
        bits = F.conv(F.substring("__h", 8 * k - 7, 8), 16, 10).cast("long")
        paths = paths.withColumn(f"f{k}", F.coalesce(bits, F.lit(0).cast("long")))
    work = range_parts(paths.drop("__h", "digest"), ["conv_id", "depth"])
    totals = work.groupBy("conv_id", "__b").agg(*(F.sum(f"f{k}").alias(f"s{k}") for k in range(1, 5)))
    before = W.partitionBy("conv_id").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("conv_id", "__b", *(F.coalesce(F.sum(f"s{k}").over(before), F.lit(0)).alias(f"o{k}") for k in range(1, 5)))
    within = W.partitionBy("conv_id", "__b").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    upto = [(F.sum(f"f{k}").over(within) + F.col(f"o{k}")).alias(f"k{k}") for k in range(1, 5)]
    out = work.join(offsets, ["conv_id", "__b"]).select("conv_id", "depth", "chars", *(f"f{k}" for k in range(1, 5)), *upto)
    return out.select("conv_id", "chars", *KEY, (F.col("depth") - 1).alias("parent_depth"), *((F.col(f"k{k}") - F.col(f"f{k}")).alias(f"p{k}") for k in range(1, 5)))


def _parent_of(child: str, parent: str) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f"{child}.{p}") == F.col(f"{parent}.{k}") for p, k in zip(PARENT, KEY, strict=True)))


def build(paths: DataFrame) -> Trie:
    """The trie of ``paths`` (conv_id, depth, digest, chars; a depth-0 row for
    every conversation, depths without gaps).  No path, no node."""
    prefixes = step(_prefix_sums(paths))
    whole = prefixes.groupBy("conv_id").agg(F.max_by(F.struct(*KEY), "depth").alias("s")).select("conv_id", "s.*")
    whole = step(whole)
    sequences = whole.groupBy(*KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"))
    # proper prefixes of any sequence
    inner = prefixes.where("depth > 0").select(*(F.col(p).alias(k) for p, k in zip(PARENT, KEY, strict=True))).distinct()
    leaves = sequences.join(inner, KEY, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    sequences = step(sequences.select("conv_id", "weight").join(leaves, "conv_id", "left").fillna(0, "leaf"))
    paths = step(prefixes.join(sequences, "conv_id"))

    nodes = paths.groupBy(*KEY).agg(*(F.max(p).alias(p) for p in PARENT), F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"),
                                    F.sum("leaf").alias("n_leaves"), F.max("chars").alias("chars"))
    nodes = step(nodes)
    owned = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    from_here = paths.select("conv_id", *KEY).join(owned, ["conv_id", "depth"], "left").fillna(0, "saved").withColumn("up", -F.col("depth"))
    from_here = ranged_sum_before(from_here, ["conv_id"], ["up"], "saved", "below")
    saved = from_here.groupBy(*KEY).agg(F.sum(F.col("saved") + F.col("below")).alias("saved_tokens"))
    children = nodes.where("depth > 0").groupBy(*(F.col(p).alias(k) for p, k in zip(PARENT, KEY, strict=True))).agg(F.count(F.lit(1)).alias("n_children"))
    full = nodes.drop("chars").join(saved, KEY).join(children, KEY, "left").fillna(0, "n_children")
    names = nodes.select(*KEY, F.col("conv_id").alias("parent_conv_id"))
    full = full.alias("c").join(names.alias("p"), _parent_of("c", "p"), "left").select("c.*", "parent_conv_id")
    return Trie(full, _end_lists(whole))


def _end_lists(whole: DataFrame) -> DataFrame:
    """KEY, chunk, ids: CHUNK ascending conversations of a sequence a row."""
    ranked = ranged_row_number(whole, KEY, ["conv_id"], "__n")
    chunk = F.call_function("div", F.col("__n") - 1, F.lit(CHUNK)).alias("chunk")
    return ranked.groupBy(*KEY, chunk).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(KEY, part) with a key's parts in order: SHA-256 of the parts, comma-joined."""
    key, state, done = None, None, []

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array([d[k] for d in done], pa.int64()) for k in range(len(KEY))] + [pa.array([d[-1] for d in done], pa.string())], names=[*KEY, "sha256"])

    for batch in batches:
        for *now, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now == key:
                state.update(b"," + part.encode())
                continue
            if key is not None:
                done.append([*key, state.hexdigest()])
            key, state = now, hashlib.sha256(part.encode())
        yield out()
        done = []
    if key is not None:
        done.append([*key, state.hexdigest()])
    yield out()


def ends_sha256(ends: DataFrame) -> DataFrame:
    """KEY and ``sha256`` (lowercase hex) of each end list's decimal ids,
    ascending, comma-joined: the lists stream past, a chunk at a time."""
    parts = ends.select(*KEY, "chunk", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("part"))
    dealt = parts.repartition(parallelism(ends.sparkSession), *KEY).sortWithinPartitions(*KEY, "chunk").drop("chunk")
    return dealt.mapInArrow(_hash_batches, ", ".join(f"{k} long" for k in KEY) + ", sha256 string")


def conversation_trie(conversations: DataFrame, every: int = 100, heads: int = 6) -> Trie:
    """The trie of all rebuilt conversations (conv_id, turn, role, text).

    * NULL role and text are empty; a NULL turn comes first; equal turns are
      ordered by their content's digest, so repeated rows are repeated turns.
    * Rows without conv_id belong to no conversation.  A conversation without
      rebuilt turns ends at the root.
    * Columns beside the four named ones are ignored; an empty table has no node.
    """
    turns = step(numbered_turns(conversations))
    return build(rebuild(turns, every, heads))
