"""Merkle manifest over table rows: a tree of SHA-256 midstates.

A parent hashes the digests of up to FANOUT children as hex text. A hex digest is 64 bytes, just
one block of SHA-256, so the hash state before each child slot is eight words. A parent retains
a copy of it for each child; a changed child is folded upwards by resuming the state of its slot
with the replacement and the siblings to its right: those on the left are never read again.

Leaves are digests that Spark computes; from there on only digests move. Nodes are numbered
inside their tree and dealt in subtrees of LEVELS levels, at most FANOUT ** LEVELS nodes to a task's
group. The roots of the subtrees are the nodes of the next stage, until each tree is one node.
Going down again, each subtree gets the path above it: a state and the right siblings for each
level. A language that holds a third of all rows is so many subtrees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.positions import with_positions
from shelfmark.llm.storage import keep

FANOUT = 8
LEVELS = 4
SUBTREE = FANOUT**LEVELS


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _root_bits(value: int, power: int) -> int:
    """The first 32 bits behind the point of the square or cube root, exactly."""
    low, high = 0, value << 32
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**power <= value << (32 * power) else (low, mid - 1)
    return low & 0xFFFFFFFF


# The start state and round constants of SHA-256, by their definition.
START = np.array([_root_bits(p, 2) for p in _primes(8)], np.uint32)
ROUND = [np.uint32(_root_bits(p, 3)) for p in _primes(64)]
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> np.uint32(bits)) | (x << np.uint32(32 - bits))


def compress(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States (n x 8 words) after one more block (n x 16 words) each."""
    w = list(blocks.T.copy())
    a, b, c, d, e, f, g, h = (x.copy() for x in states.T)
    for i, k in enumerate(ROUND):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(w[i - 16] + w[i - 7] + (_turned(x, 7) ^ _turned(x, 18) ^ (x >> np.uint32(3))) + (_turned(y, 17) ^ _turned(y, 19) ^ (y >> np.uint32(10))))
        one = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + ((e & f) ^ (~e & g)) + k + w[i]
        two = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
        h, g, f, e, d, c, b, a = g, f, e, d + one, c, b, a, one + two
    return np.stack([a, b, c, d, e, f, g, h], axis=1) + states


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """Digests (n x 8 words) as the blocks (n x 16 words) that their hex text fills."""
    raw = np.ascontiguousarray(digests, ">u4").view(np.uint8).reshape(len(digests), 32)
    text = np.stack([HEX[raw >> 4], HEX[raw & 15]], axis=2).reshape(len(digests), 64)
    return np.ascontiguousarray(text).view(">u4").astype(np.uint32)


def closing(n_blocks: np.ndarray) -> np.ndarray:
    """The padding block behind so many whole blocks."""
    out = np.zeros((len(n_blocks), 16), np.uint32)
    out[:, 0], out[:, 15] = 1 << 31, n_blocks * 512
    return out


def words_of(digests) -> np.ndarray:
    """Digests as bytes, one value each or all in one, as n x 8 words."""
    joined = digests if isinstance(digests, (bytes, bytearray)) else b"".join(digests)
    return np.frombuffer(joined, ">u4").astype(np.uint32).reshape(-1, 8)


def bytes_of(words: np.ndarray) -> bytes:
    return np.ascontiguousarray(words, ">u4").tobytes()


def texts_of(words: np.ndarray) -> list[str]:
    joined = bytes_of(words).hex()
    return [joined[i : i + 64] for i in range(0, len(joined), 64)]


def parents(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the parents of consecutive nodes, and the state before each node's slot."""
    slot = np.arange(len(nodes)) % FANOUT
    run = np.arange(0, len(nodes), FANOUT)
    now = np.tile(START, (len(run), 1))
    before = np.empty((len(nodes), 8), np.uint32)
    blocks = hex_blocks(nodes)
    for j in range(FANOUT):
        here = np.flatnonzero(slot == j)
        if not len(here):
            break
        before[here] = now[: len(here)]
        now[: len(here)] = compress(now[: len(here)], blocks[here])
    return compress(now, closing(np.minimum(FANOUT, len(nodes) - run))), before


def folded(changed: np.ndarray, before: np.ndarray, slot: np.ndarray, siblings: np.ndarray, at: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Digests of parents after one child each is replaced.

    ``before``: the state in front of the child's slot; ``siblings``: blocks of all nodes of the
    level; ``at``: where in it the child stands; ``run``: children of its parent.
    """
    now = compress(before, hex_blocks(changed))
    for step in range(1, FANOUT):
        more = np.flatnonzero(slot + step < run)
        if len(more):
            now[more] = compress(now[more], siblings[at[more] + step])
    return compress(now, closing(run))


def levels_of(nodes: np.ndarray, total: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(nodes, states before them) of the levels of a subtree from below; ends at LEVELS levels or
    where the tree of ``total`` nodes has a single one."""
    out = []
    while total > 1 and len(out) < LEVELS:
        above, before = parents(nodes)
        out.append((nodes, before))
        nodes, total = above, -(-total // FANOUT)
    out.append((nodes, nodes[:0]))
    return out


@dataclass(frozen=True)
class Path:
    """What folding needs above a node: for each level from below, the slot, the run's length, the
    state before the slot, and the run's digests."""

    slots: bytes = b""
    runs: bytes = b""
    states: bytes = b""
    nodes: bytes = b""

    def steps(self):
        """(slot, run length, state, digests of the run) by level."""
        states, nodes, at = words_of(self.states), words_of(self.nodes), 0
        for slot, run, state in zip(self.slots, self.runs, states):
            yield slot, run, state, nodes[at : at + run]
            at += run


PATH = "slots binary, runs binary, states binary, nodes binary"


def built(nodes: DataFrame) -> DataFrame:
    """tree, sub, pos (of the subtree's root in the next stage), total (nodes of that stage),
    digest (of the root), leaves (the subtree's nodes in one value), size (nodes of the tree).

    ``nodes``: tree (binary, no nulls), pos (0, 1, ... in the tree), total (nodes of the tree),
    digest (binary); where they have key (text) and changed (binary), the subtree gets keys and
    changed as well, in the order of its nodes.
    """
    carry = "changed" in nodes.columns

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        own, total, sub = words_of(list(pdf.digest)), int(pdf.total.iloc[0]), int(pdf.pos.iloc[0]) // SUBTREE
        left = total
        for _ in range(LEVELS):
            left = -(-left // FANOUT)
        out = {"tree": pdf.tree.iloc[0], "sub": sub, "pos": sub, "total": left, "digest": bytes_of(levels_of(own, total)[-1][0]), "leaves": bytes_of(own), "size": total}
        if carry:
            out |= {"keys": list(pdf.key), "changed": b"".join(pdf.changed)}
        return pd.DataFrame([out])

    schema = "tree binary, sub long, pos long, total long, digest binary, leaves binary, size long" + ", keys array<string>, changed binary" * carry
    return nodes.groupBy("tree", F.expr(f"pos div {SUBTREE}").alias("_sub")).applyInPandas(build, schema)


def stages(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The subtrees of each stage from below, and (tree, digest) of the roots."""
    out = []
    while True:
        out.append(keep(built(nodes), "subtrees"))
        nodes = out[-1].select("tree", "pos", "total", "digest")
        if nodes.where("total > 1").isEmpty():
            return out, nodes.select("tree", "digest")


def _extended(levels, index: int, above: Path) -> Path:
    """The path above a subtree's node ``index``: its own levels, then what is above the root."""
    slots, runs, states, nodes = bytearray(), bytearray(), [], []
    for level, before in levels[:-1]:
        slot = index % FANOUT
        run = level[index - slot : index - slot + FANOUT]
        slots.append(slot)
        runs.append(len(run))
        states.append(bytes_of(before[index]))
        nodes.append(bytes_of(run))
        index //= FANOUT
    return Path(bytes(slots) + above.slots, bytes(runs) + above.runs, b"".join(states) + above.states, b"".join(nodes) + above.nodes)


def paths_below(stage: DataFrame, paths: DataFrame) -> DataFrame:
    """tree, pos, and the path above each node of a stage; ``paths``: tree, pos of the subtrees."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                own = words_of(r.leaves)
                levels, above = levels_of(own, r.size), Path(r.slots, r.runs, r.states, r.nodes)
                found = [_extended(levels, i, above) for i in range(len(own))]
                yield pd.DataFrame({"tree": r.tree, "pos": r.sub * SUBTREE + np.arange(len(own)), "slots": [p.slots for p in found], "runs": [p.runs for p in found], "states": [p.states for p in found], "nodes": [p.nodes for p in found]})

    rows = stage.select("tree", "sub", "leaves", "size").join(paths.withColumnRenamed("pos", "sub"), ["tree", "sub"])
    return rows.select("tree", "sub", "leaves", "size", "slots", "runs", "states", "nodes").mapInPandas(walk, f"tree binary, pos long, {PATH}")


def top_down(stages_: list[DataFrame], roots: DataFrame) -> DataFrame:
    """tree, pos and path of the subtrees of the lowest stage; ``roots``: tree and path of the trees."""
    paths = roots.withColumn("pos", F.lit(0).cast("long"))
    for stage in reversed(stages_[1:]):
        paths = keep(paths_below(stage, paths), "paths")
    return paths


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 (hex) of the values: ``-`` for null, else UTF-8 bytes, ``:`` and the value."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]).cast("binary"), 256)


def tampered_text(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def tree_key(column: Column) -> Column:
    """The group as bytes whose order is that of the values, null first."""
    return F.coalesce(F.concat(F.lit(b"\x01"), column.cast("string").cast("binary")), F.lit(b"\x00"))


def manifest(rows: DataFrame, key: str, group: str, leaf: Column, changed: Column) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root (hex), verified: one row for each row.

    Per value of ``group`` (null is one), leaves ascend by ``key``, nulls first; rows of equal keys
    ascend by leaf, then in the order of their folded leaf, and equal rows are leaves of their own.
    Every FANOUT consecutive nodes become the hash of their hex digests, until one is left: the
    subroot. The subroots, by the bytes of their group, null first, likewise give the root.
    ``leaf`` and ``changed``: hex digests of the row as it is and as it is to be folded (null: as it
    is). ``proof_sha256`` hashes the siblings of the way up, level by level and left to right.
    An empty table gives an empty result.
    """
    leaves = rows.select(F.col(key).cast("string").alias("key"), F.col(key).alias("order"), tree_key(F.col(group)).alias("tree"), F.unhex(leaf).alias("digest"), F.unhex(F.coalesce(changed, leaf)).alias("changed"))
    at = keep(with_positions(leaves, "tree", [F.col("order").asc_nulls_first(), F.col("digest"), F.col("changed")], "pos", "total"), "leaves")
    lower, subroots = stages(at.drop("order"))

    groups = with_positions(subroots.withColumn("top", F.lit(0)), "top", [F.col("tree")], "pos").withColumnRenamed("tree", "of")
    groups = keep(groups.select("of", "pos", "digest"), "groups")
    count = groups.count()
    forest = groups.select(F.lit(b"").alias("tree"), "pos", F.lit(count).cast("long").alias("total"), "digest")
    upper, root = stages(forest)
    empty = F.lit(b"")
    start = root.select("tree", *[empty.alias(c) for c in ("slots", "runs", "states", "nodes")])
    above = paths_below(upper[0], top_down(upper, start)).drop("tree")
    tops = groups.join(above, "pos").select(F.col("of").alias("tree"), "slots", "runs", "states", "nodes")
    paths = top_down(lower, tops)
    subs = lower[0].join(paths.withColumnRenamed("pos", "sub"), ["tree", "sub"]).join(subroots.withColumnRenamed("digest", "subroot"), "tree")
    out = _proved(subs.withColumn("root", root.select("digest").scalar()))
    return out.select(F.col("key").cast(rows.schema[key].dataType).alias(key), *out.columns[1:])


def proofs(leaves: np.ndarray, levels, above: Path) -> list[str]:
    """proof_sha256 of each leaf of a subtree."""
    own = [np.ascontiguousarray(hex_blocks(nodes), ">u4").tobytes() for nodes, _ in levels[:-1]]
    upper = b""
    for slot, _, _, nodes in above.steps():
        text = np.ascontiguousarray(hex_blocks(nodes), ">u4").tobytes()
        upper += text[: 64 * slot] + text[64 * slot + 64 :]
    out = []
    for i in range(len(leaves)):
        parts, index = [], i
        for text in own:
            start = 64 * (index - index % FANOUT)
            parts += [text[start : 64 * index], text[64 * index + 64 : start + 64 * FANOUT]]
            index //= FANOUT
        out.append(hashlib.sha256(b"".join([*parts, upper])).hexdigest())
    return out


def refolded(changed: np.ndarray, levels, above: Path) -> np.ndarray:
    """The tree's root for each leaf of a subtree, as if that leaf alone were replaced."""
    at = np.arange(len(changed))
    for nodes, before in levels[:-1]:
        slot = at % FANOUT
        run = np.minimum(FANOUT, len(nodes) - (at - slot))
        changed = folded(changed, before[at], slot, hex_blocks(nodes), at, run)
        at = at // FANOUT
    same = np.ones(len(changed), np.int64)
    for slot, run, state, nodes in above.steps():
        changed = folded(changed, np.tile(state, (len(changed), 1)), slot * same, hex_blocks(nodes), slot * same, run * same)
    return changed


def _proved(subs: DataFrame) -> DataFrame:
    """The rows of the subtrees, with their proofs and folded roots; keys as text."""

    def prove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                own, root = words_of(r.leaves), r.root.hex()
                levels, above = levels_of(own, r.size), Path(r.slots, r.runs, r.states, r.nodes)
                back = texts_of(refolded(words_of(r.changed), levels, above))
                yield pd.DataFrame({"key": list(r.keys), "leaf": texts_of(own), "subroot": r.subroot.hex(), "root": root, "proof_sha256": proofs(own, levels, above), "folded_root": back, "verified": [f == root for f in back]})

    schema = "key string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    columns = ("leaves", "size", "changed", "keys", "slots", "runs", "states", "nodes", "subroot", "root")
    return subs.select(*columns).mapInPandas(prove, schema)
