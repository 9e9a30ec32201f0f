"""Trie of conversation prefixes, its subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns. Turns become fixed-size digests in one scan;
a node's name is the xor, over the turns of its sequence, of two 64-bit hashes of place and
digest, so names of all prefixes are running sums that parts of a conversation share out.
No conversation, node or group of copies is gathered in one task.

Subtree totals are not summed level by level, which would take as many rounds as the deepest
conversation has turns. Each round rakes all leaves (their totals go to their parents) and
compresses unary chains (a node between its parent and its only child is spliced out, its
own amounts move to the edge below it; no two neighbours in one round). Chains halve, so the
rounds grow with the logarithm of the depth. Spliced nodes are then re-expanded, last round
first: the total of one is that of the child it was spliced above, plus what it held.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiered.llm import shared

#: Words of a turn.
WORD = r"[^\x20\x09-\x0D]+"
#: Conversation numbers that are written as one piece before the pieces meet.
PIECE = 20_000
#: A parent with more than 1/HOT of all children is joined apart; there are fewer than HOT.
HOT = 1000


def _pair(left: Column, right: Column) -> Column:
    return F.struct(left.alias("a"), right.alias("b"))


def _root() -> Column:
    return _pair(F.lit(0).cast("long"), F.lit(0).cast("long"))


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, key, words, n): each turn's place in its conversation and its digest.

    Turns go by turn (null first); turns of one number by the digest of role and text, so
    repeated rows stay repeated turns. Null roles and texts are empty. Rows of a null conv_id
    belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    written = F.concat(F.octet_length(role), F.lit(":"), role, text).cast("binary")
    slim = rows.where("conv_id is not null").select(
        "conv_id", "turn", F.sha2(written, 256).alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    return shared.placed(slim, ["conv_id"], ["turn", "key"], "turns").drop("turn")


def rebuilt(rows: DataFrame, family: int, kept: Column, most: int) -> DataFrame:
    """Conversations that open with turns of the first of their family.

    Conversation c gets the first `kept` (at most `most`) turns of conversation c - c % family,
    all if it has fewer, none if it is absent, then its own turns after its first `kept`.
    Returns (conv_id, part, place, key, words, n), n the rebuilt length; a conversation
    without turns is one row whose place is null. No conversation is asked for by more than
    `family` others, and only for `most` turns.
    """
    own = shared.staged(turns(rows), "own")
    sizes = own.where("place = 0").select("conv_id", "n", kept.alias("cut"))
    base = F.col("conv_id") - F.col("conv_id") % family
    first = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    lent = F.least("cut", F.coalesce("base_n", F.lit(0)))
    plans = shared.staged(
        sizes.withColumn("base", base).join(first, "base", "left").select(
            "conv_id", "base", "cut", lent.alias("lent"),
            (lent + F.greatest(F.col("n") - F.col("cut"), F.lit(0))).alias("length"),
        ),
        "plans",
    )
    heads = own.where((F.col("place") < most) & (F.col("conv_id") % family == 0))
    opening = plans.where("lent > 0").join(
        heads.select(F.col("conv_id").alias("base"), "place", "key", "words"), "base"
    ).where("place < lent").select("conv_id", F.lit(-1).alias("part"), "place", "key", "words", "length")
    rest = own.select("conv_id", "part", "place", "key", "words").join(
        plans.select("conv_id", "cut", "lent", "length"), "conv_id"
    ).where("place >= cut").select(
        "conv_id", "part", (F.col("place") - F.col("cut") + F.col("lent")).alias("place"),
        "key", "words", "length",
    )
    none = plans.where("length = 0").select(
        "conv_id", F.lit(-1).alias("part"), F.lit(None).cast("long").alias("place"),
        F.lit(None).cast("string").alias("key"), F.lit(0).cast("long").alias("words"), "length",
    )
    return opening.unionByName(rest).unionByName(none).withColumnRenamed("length", "n")


def prefixes(sequences: DataFrame) -> DataFrame:
    """(node, parent, depth, conv_id, words, last) for each turn of each conversation."""
    a, b = (F.xxhash64(F.lit(seed), "place", "key") for seed in (1, 2))
    steps = shared.staged(
        sequences.where("place is not null").select("*", a.alias("a"), b.alias("b")), "steps"
    )
    parts = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("conv_id", "part").orderBy("place")

    def over(column: str, window: Window) -> Column:
        return F.coalesce(F.bit_xor(column).over(window), F.lit(0).cast("long"))

    before = (
        steps.groupBy("conv_id", "part").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
        .select("conv_id", "part", over("a", parts).alias("a0"), over("b", parts).alias("b0"))
    )
    run = {c: F.col(f"{c}0").bitwiseXOR(over(c, here)) for c in "ab"}
    return (
        steps.join(before, ["conv_id", "part"])
        .select(
            _pair(run["a"], run["b"]).alias("node"), (F.col("place") + 1).alias("depth"),
            "conv_id", "words", (F.col("place") + 1 == F.col("n")).alias("last"), "a", "b",
        )
        .withColumn(
            "parent", _pair(F.col("node.a").bitwiseXOR(F.col("a")), F.col("node.b").bitwiseXOR(F.col("b")))
        )
        .withColumn("parent", F.when(F.col("depth") == 1, _root()).otherwise(F.col("parent")))
        .drop("a", "b")
    )


def subtree_totals(tree: DataFrame, amounts: list[str]) -> DataFrame:
    """(node, amounts) summed over each node's subtree, the node included.

    `tree` has node, parent (null at a root), depth and the amounts. All joins are on nodes,
    which are unique; children meet in partial sums before any shuffle.
    """
    edge = [f"edge_{m}" for m in amounts]
    active = shared.staged(
        tree.select("node", "parent", "depth", *amounts, *[F.lit(0).cast("long").alias(e) for e in edge]),
        "active",
    )
    deepest = active.agg(F.max("depth")).first()[0]
    raked, spliced = [], []
    while deepest is not None:
        turn = len(raked)
        kids = active.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
            F.count("*").alias("kids"), F.min("node").alias("child")
        )
        state = active.join(kids, "node", "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
        # The bits of the depth halve fresh chains; then hashes, which halve any chain on average.
        bit = F.shiftright("depth", turn) if deepest >> turn else F.xxhash64("node", F.lit(turn))
        state = shared.staged(state.withColumn("odd", bit.bitwiseAND(F.lit(1)) == 1), "state")
        shared.dropped(active)
        leaves = state.where("kids = 0")
        raked.append(leaves.select("node", *amounts))
        if leaves.where("parent is not null").isEmpty():
            # Only roots are leaves now, so nothing stands above any node.
            break
        gains = leaves.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
            *[F.sum(F.col(m) + F.col(e)).alias(f"gain_{m}") for m, e in zip(amounts, edge)]
        )
        single = state.where("kids = 1")
        chosen = single.where("odd and parent is not null").select(
            F.col("node").alias("over"), F.col("child").alias("node"), F.col("parent").alias("above"),
            *[F.col(m).alias(f"held_{m}") for m in amounts], *[F.col(e).alias(f"held_{e}") for e in edge],
        )
        below = state.where("kids > 0 and not (kids = 1 and odd and parent is not null)").select("node", *edge)
        moved = shared.staged(
            chosen.join(below, "node").select(
                "node", "over", "above",
                *[(F.col(f"held_{m}") + F.col(e)).alias(m) for m, e in zip(amounts, edge)],
                *[
                    (F.col(e) + F.col(f"held_{m}") + F.col(f"held_{e}")).alias(f"new_{e}")
                    for m, e in zip(amounts, edge)
                ],
            ),
            "spliced",
        )
        spliced.append(moved.select("node", "over", *amounts))
        following = (
            state.where("kids > 0")
            .join(moved.select(F.col("over").alias("node")), "node", "left_anti")
            .join(gains, "node", "left")
            .join(moved.select("node", "above", *[f"new_{e}" for e in edge]), "node", "left")
        )
        active = shared.staged(
            following.select(
                "node", F.coalesce("above", "parent").alias("parent"), "depth",
                *[(F.col(m) + F.coalesce(f"gain_{m}", F.lit(0))).alias(m) for m in amounts],
                *[F.coalesce(f"new_{e}", e).alias(e) for e in edge],
            ),
            "active",
        )
    return _expanded(raked, spliced, amounts, tree)


def _expanded(
    raked: list[DataFrame], spliced: list[DataFrame], amounts: list[str], tree: DataFrame
) -> DataFrame:
    """Totals of all nodes: those of a round's spliced nodes follow from later rounds alone."""
    known = None
    for turn in reversed(range(len(raked))):
        found = raked[turn]
        if turn < len(spliced):
            below = known.select("node", *[F.col(m).alias(f"below_{m}") for m in amounts])
            opened = spliced[turn].join(below, "node").select(
                F.col("over").alias("node"),
                *[(F.col(m) + F.col(f"below_{m}")).alias(m) for m in amounts],
            )
            found = found.unionByName(shared.staged(opened, "opened"))
        known = found if known is None else known.unionByName(found)
    return known if known is not None else tree.select("node", *amounts)


def _digests(members: DataFrame) -> DataFrame:
    """(node, ends_sha256): digest of each node's numbers, ascending, comma-joined.

    Numbers are dealt by range of node and number, so those of one node may lie in many
    tasks; tasks write them as pieces of PIECE numbers, and the digest reads pieces in turn.
    """
    count = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = members.select("node.a", "node.b", "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("text", pa.string())]
        )
        node, held, done = None, [], []

        def close() -> None:
            if held:
                done.append({"a": node[0], "b": node[1], "first": held[0], "text": ",".join(map(str, held))})
                held.clear()

        for batch in batches:
            for a, b, number in zip(*(c.to_pylist() for c in batch.columns)):
                if node != (a, b) or len(held) >= PIECE:
                    close()
                    node = (a, b)
                held.append(number)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done.clear()
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])
        node, running = None, None
        for batch in batches:
            done = []
            for a, b, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if node != (a, b):
                    if node:
                        done.append({"a": node[0], "b": node[1], "ends_sha256": running.hexdigest()})
                    node, running = (a, b), sha256(text.encode())
                else:
                    running.update(b"," + text.encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if node:
            yield pa.RecordBatch.from_pylist(
                [{"a": node[0], "b": node[1], "ends_sha256": running.hexdigest()}], schema
            )

    dealt = rows.repartitionByRange(count, "a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    written = dealt.mapInArrow(pieces, "a long, b long, first long, text string")
    met = shared.spread(written, "a", "b").sortWithinPartitions("a", "b", "first")
    return met.mapInArrow(digests, "a long, b long, ends_sha256 string").select(
        _pair(F.col("a"), F.col("b")).alias("node"), "ends_sha256"
    )


def _parents(nodes: DataFrame) -> DataFrame:
    """`nodes` with parent_conv_id; parents of very many children are joined by broadcast."""
    few = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    total = nodes.count()
    large = F.col("n_children") > total // HOT
    # Children are counted once, so fewer than HOT + 1 parents have more than total / HOT.
    hot = few.where(large).drop("n_children")
    rest = few.where(~large).drop("n_children")
    met = nodes.join(F.broadcast(hot.withColumnRenamed("parent_conv_id", "hot_id")), "parent", "left")
    return (
        met.where("hot_id is not null").withColumnRenamed("hot_id", "parent_conv_id")
        .unionByName(met.where("hot_id is null").drop("hot_id").join(rest, "parent", "left"))
    )


def trie(sequences: DataFrame) -> DataFrame:
    """One row a node of the trie of `sequences` (see `rebuilt`), the root included.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves and saved_tokens of the subtree, ends_sha256 of the members that end there. Two
    different prefixes share a name with a chance below 2^-127 times the pairs of them. An
    empty table has no conversation and no node.
    """
    kept = shared.staged(sequences, "sequences")
    paths = shared.staged(prefixes(kept), "prefixes")
    named = paths.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.max("words").alias("words"),
    )
    starts = kept.where("place = 0 or place is null")
    root = starts.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where(
        "n_convs > 0"
    ).select(
        _root().alias("node"), F.lit(None).cast("struct<a: bigint, b: bigint>").alias("parent"),
        F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("words"),
    )
    named = named.unionByName(root)
    kids = named.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("n_children")
    )
    nodes = shared.staged(
        named.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))),
        "nodes",
    )
    totals = subtree_totals(
        nodes.select(
            "node", "parent", "depth", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        ),
        ["n_leaves", "saved_tokens"],
    )
    ends = paths.where("last").select("node", "conv_id").unionByName(
        kept.where("place is null").select(_root().alias("node"), "conv_id")
    )
    empty = sha256(b"").hexdigest()
    return (
        _parents(nodes).join(totals, "node").join(_digests(ends), "node", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        )
    )
