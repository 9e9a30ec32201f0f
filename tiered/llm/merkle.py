"""Merkle manifest of a table: a persistent tree whose versions copy only changed paths.

Rows are leaves; each group's leaves form a tree in which two consecutive nodes become their
parent, and the groups' subroots form a tree above them. Nodes lie in aligned blocks of
2^LEVELS consecutive ones. A block is reduced in one task, its top is a node of the next round,
so a round has one node for each block of the one before, and each round is distributed. Going
down, a block gets the path above its top, one short list, and finishes its own nodes.

A changed leaf creates a version: copies of the leaf's ancestors inside its block, then of
those above, up to a new root. All other nodes are shared with the original version, which
is never rewritten.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiered.llm import shared

#: Levels of a block.
LEVELS = 12
#: The fields of a document's leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODES = "group string, place long, digest string, n long"
_PATHS = "group string, place long, path array<string>, subroot string, root string"
_PROOF = (
    "group string, place long, leaf string, subroot string, root string, "
    "siblings array<string>, changed_leaf string, copied array<string>, folded_root string"
)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """Digest of fields, each `-` if null, else its UTF-8 byte count, a colon and its text."""
    written = []
    for field in fields:
        text = field.cast("string")
        written.append(
            F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text), F.lit(":"), text))
        )
    return F.sha2(F.concat(*written).cast("binary"), 256)


def levels(feet: list[str], steps: int | None) -> list[list[str]]:
    """All levels above `feet`: so many, or (None) until one node remains."""
    found = [feet]
    while len(found) <= steps if steps is not None else len(found[-1]) > 1:
        low = found[-1]
        found.append([digest("".join(low[k : k + 2])) for k in range(0, len(low), 2)])
    return found


def siblings(tree: list[list[str]], k: int) -> Iterator[str]:
    """Path of foot `k` to the top: `<` or `>` and the sibling on that side, `` if alone."""
    for level in tree[:-1]:
        other = k ^ 1
        yield ("<" if other < k else ">") + level[other] if other < len(level) else ""
        k >>= 1


def copied(start: str, path: list[str]) -> list[str]:
    """Copies of a leaf's ancestors, lowest first, when the leaf is `start`."""
    nodes = []
    for step in path:
        start = digest(step[1:] + start if step[:1] == "<" else start + step[1:])
        nodes.append(start)
    return nodes


def _tree(block: pa.Table, high: int) -> tuple[list[int], list[list[str]], int]:
    """Order of the rows by place, the block's levels, nodes of the group in the next round."""
    places = block.column("place").to_pylist()
    order = sorted(range(len(places)), key=places.__getitem__)
    feet = block.column("digest").to_pylist()
    n = block.column("n")[0].as_py()
    steps = high if n > 1 << high else None
    return order, levels([feet[k] for k in order], steps), -(-n >> high)


def _top(high: int, key: tuple, block: pa.Table) -> pa.Table:
    _, tree, n = _tree(block, high)
    return pa.table(
        {"group": [key[0].as_py()], "place": [key[1].as_py()], "digest": tree[-1], "n": [n]}
    )


def _below(high: int, nodes: pa.Table, above: pa.Table) -> pa.Table:
    order, tree, _ = _tree(nodes, high)
    rest = above.column("path")[0].as_py()
    paths = [None] * len(order)
    for k, row in enumerate(order):
        paths[row] = [*siblings(tree, k), *rest]
    repeated = {
        c: pa.array([above.column(c)[0].as_py()] * len(order), pa.string())
        for c in ("subroot", "root")
    }
    return pa.table(
        {
            "group": nodes.column("group"), "place": nodes.column("place"),
            "path": pa.array(paths, pa.list_(pa.string())), **repeated,
        }
    )


def _proofs(high: int, leaves: pa.Table, above: pa.Table) -> pa.Table:
    found = _below(high, leaves, above)
    paths = found.column("path").to_pylist()
    first, after = leaves.column("digest").to_pylist(), leaves.column("changed").to_pylist()
    versions, roots = [], []
    for path, old, new in zip(paths, first, after):
        nodes = copied(old if new is None else new, path)
        versions.append(None if new is None else nodes)
        roots.append(nodes[-1] if nodes else old if new is None else new)
    return pa.table(
        {
            "key": leaves.column("key"),
            "group": leaves.column("group"), "place": leaves.column("place"),
            "leaf": leaves.column("digest"),
            "subroot": found.column("subroot"), "root": found.column("root"),
            "siblings": pa.array(
                [[s[1:] for s in path if s] for path in paths], pa.list_(pa.string())
            ),
            "changed_leaf": leaves.column("changed"),
            "copied": pa.array(versions, pa.list_(pa.string())),
            "folded_root": pa.array(roots, pa.string()),
        }
    )


def _blocks(nodes: DataFrame, high: int):
    return nodes.groupBy("group", F.shiftright("place", high).alias("block"))


def _climb(nodes: DataFrame, high: int) -> list[DataFrame]:
    """The nodes at the foot of each round; the last one holds one node a group."""
    top: Callable[[tuple, pa.Table], pa.Table] = lambda key, block: _top(high, key, block)
    rounds = [nodes]
    while len(rounds) < 2 or not rounds[-1].where("n > 1").isEmpty():
        feet = rounds[-1].select("group", "place", "digest", "n")
        rounds.append(shared.staged(_blocks(feet, high).applyInArrow(top, _NODES), "tops"))
    return rounds


def _descend(rounds: list[DataFrame], paths: DataFrame, high: int) -> DataFrame:
    """Paths of the feet of the first of `rounds`, from those of the groups' tops."""
    for nodes in reversed(rounds):
        met = _blocks(nodes, high).cogroup(paths.groupBy("group", "place"))
        paths = shared.staged(met.applyInArrow(lambda a, b: _below(high, a, b), _PATHS), "paths")
    return paths


def prove(leaves: DataFrame, high: int = LEVELS) -> DataFrame:
    """One proof a row of `leaves` (group not null, key, digest, changed).

    Returns the key and the columns of _PROOF: place in the group by ascending key (null keys
    first; rows of one key by digest; equal rows are interchangeable), the leaf, its group's
    subroot, the root over the subroots in bytewise order of the groups, the siblings from
    the leaf up (a node alone in its run has none), and, where `changed` is not null, the
    copies that this version adds (lowest first, the last is its root) with `folded_root`.
    Without a change folded_root is recomputed from the leaf itself. A group of one leaf has
    that leaf as subroot. An empty table has no proofs. Blocks have `high` levels, which
    changes no result.
    """
    feet = shared.staged(shared.placed(leaves, ["group"], ["key", "digest"], "leaves"), "placed")
    rounds = _climb(feet, high)
    tops = rounds[-1].select(F.col("group").alias("name"), F.col("digest").alias("subroot"))
    ranked = shared.staged(
        shared.placed(tops.withColumn("group", F.lit("")), ["group"], ["name"], "subroots"), "ranked"
    )
    over = _climb(ranked.select("group", "place", F.col("subroot").alias("digest"), "n"), high)
    crown = over[-1].select(
        "group", "place", F.array().cast("array<string>").alias("path"),
        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
    )
    paths = _descend(over[:-1], crown, high).select("place", "path", "root")
    heads = ranked.join(paths, "place").select(
        F.col("name").alias("group"), F.lit(0).cast("long").alias("place"), "path", "subroot", "root"
    )
    paths = _descend(rounds[1:-1], heads, high)
    schema = StructType([feet.schema["key"], *StructType.fromDDL(_PROOF)])
    return (
        _blocks(feet.select("group", "place", "key", "digest", "n", "changed"), high)
        .cogroup(paths.groupBy("group", "place"))
        .applyInArrow(lambda a, b: _proofs(high, a, b), schema)
    )


def manifest(
    docs: DataFrame, changes: dict[str, Column] | None = None,
    fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id",
    high: int = LEVELS,
) -> DataFrame:
    """Proofs of the rows of `docs`, and of the versions that `changes` make of them.

    A leaf is the digest of `fields`; `changes` gives changed fields as expressions over
    `docs`, and a row whose leaf differs then has a version. Rows of a null group are a group
    of their own, before all others. Other columns of `docs` count for nothing, whatever
    their names; any of the fields may be null, empty or very long. See `prove`.
    """
    changes = changes or {}
    now = leaf([F.col(f) for f in fields])
    then = leaf([changes.get(f, F.col(f)) for f in fields])
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("group"),
        F.col(key).alias("key"), now.alias("digest"),
        (then if changes else F.lit(None).cast("string")).alias("changed"),
    )
    alike = F.col("changed") == F.col("digest")
    return prove(leaves.withColumn("changed", F.when(~alike, F.col("changed"))), high)


def nodes(proofs: DataFrame) -> DataFrame:
    """The nodes that versions add: version (place of the changed leaf), level and digest.

    Level 0 is the leaf, the highest the version's root. Any other node of a version is the
    original one, so a version takes as many nodes as the tree has levels.
    """
    kept = F.concat(F.array("changed_leaf"), "copied")
    rows = proofs.where("changed_leaf is not null")
    return rows.select("group", F.col("place").alias("version"), F.posexplode(kept).alias("level", "digest"))
