"""Merkle manifest of a dataset by time-forward processing.

Nodes are labelled (tree, level, index). Digests travel forward in time, from
each node to its parent, through a priority queue ordered by label; then the
sweep is reversed and the queue delivers proof suffixes from parents to
children, down to the leaves. The queue is external: a round works on blocks of
4,096 consecutive nodes, inside of which a heap holds the messages, and the
messages that leave a block are rows which Spark shuffles to the next block by
(tree, label). N leaves take log2(N) / 12 rounds in each direction, and no task
holds more than a block."""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.llm.files import written
from cantora.llm.ranks import number_within

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_BITS = 12
TAMPER = 7
LEFT, RIGHT, LONE = "L", "R", "N"


def _hash(*hexes: str) -> str:
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


# ------------------------------------------------------------ within a block
def forward(digests: list[str], levels: int | None) -> list[list[str]]:
    """All levels of the tree over a block's nodes, bottom first: ``levels`` of them
    above the nodes, or until one node remains. A node of a single child is its hash, too."""
    queue = [((0, i), i, d) for i, d in enumerate(digests)]   # (label, child, digest), a heap as it stands
    out: list[list[str]] = []
    while queue:
        label, _, d = heapq.heappop(queue)
        got = [d]
        while queue and queue[0][0] == label:
            got.append(heapq.heappop(queue)[2])
        level, i = label
        d = _hash(*got) if level else d
        if level == len(out):
            out.append([])
        out[level].append(d)
        width = -(-len(digests) >> level)
        if level < levels if levels is not None else width > 1:
            heapq.heappush(queue, ((level + 1, i >> 1), i, d))
    return out


def backward(tree: list[list[str]], suffix: tuple) -> list[tuple]:
    """The proof of every node of the block's bottom level: siblings with their side,
    bottom first, ending in ``suffix``, the proof of the block's top node."""
    queue = [(-(len(tree) - 1), 0, suffix)]
    out: list[tuple] = [()] * len(tree[0])
    while queue:
        level, i, own = heapq.heappop(queue)
        if not level:
            out[i] = own
            continue
        below = tree[-level - 1]
        for child in range(2 * i, min(2 * i + 2, len(below))):
            other = child ^ 1
            step = ((LONE, ""),) if other >= len(below) else ((LEFT if other < child else RIGHT, below[other]),)
            heapq.heappush(queue, (level + 1, child, step + own))
    return out


def fold(leaf: str, proof: tuple) -> str:
    """The root that a leaf and its siblings give."""
    for side, d in proof:
        leaf = _hash(d, leaf) if side == LEFT else _hash(leaf, d)
    return leaf


def _pack(proof: tuple) -> str:
    return ",".join(side + d for side, d in proof)


def _unpack(text: str) -> tuple:
    return tuple((x[:1], x[1:]) for x in text.split(",")) if text else ()


# ------------------------------------------------------------------- rounds
def _levels(table: pa.Table, bits: int) -> int | None:
    """A block after the first has others beside it; a first block that is full ends
    at the same level whether it has or not."""
    return bits if table.column("block")[0].as_py() else None


def _up(bits: int, table: pa.Table) -> pa.Table:
    table = table.sort_by("pos")
    top = forward(table.column("digest").to_pylist(), _levels(table, bits))[-1][0]
    return pa.table({"tree": table.column("tree").slice(0, 1).cast(pa.string()), "pos": pa.array([table.column("block")[0].as_py()], pa.int64()),
                     "digest": pa.array([top], pa.string())})


def _blocks(nodes: DataFrame, bits: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", bits))


def rise(nodes: DataFrame, bits: int = BLOCK_BITS) -> list[DataFrame]:
    """``nodes`` (tree, pos from 0 without gaps, digest) and the
    tops of their blocks round by round, until every tree is one node; each is a written table."""
    out = [nodes]
    while (out[-1].agg(F.max("pos")).first()[0] or 0) > 0:
        tops = _blocks(out[-1], bits).groupBy("tree", "block").applyInArrow(lambda t: _up(bits, t), "tree string, pos long, digest string")
        out.append(written(tops, "merkle-nodes"))
    return out


def _proofs(bits: int, left: pa.Table, right: pa.Table) -> tuple[pa.Table, list[tuple]]:
    """The block's rows by pos, and their proofs."""
    left = left.sort_by("pos")
    tree = forward(left.column("digest").to_pylist(), _levels(left, bits))
    return left, backward(tree, _unpack(right.column("suffix")[0].as_py()))


def _down(bits: int, left: pa.Table, right: pa.Table) -> pa.Table:
    left, proofs = _proofs(bits, left, right)
    return pa.table({"tree": left.column("tree").cast(pa.string()), "pos": left.column("pos"), "suffix": pa.array([_pack(p) for p in proofs], pa.string())})


def sink(rounds: list[DataFrame], suffixes: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """Proof suffixes (tree, pos, suffix) of the nodes of the first of ``rounds``'s blocks,
    from ``suffixes`` of the trees' tops: the reversed sweep over all rounds but the last."""
    for nodes in reversed(rounds[1:-1]):
        up = suffixes.select("tree", F.col("pos").alias("block"), "suffix")
        suffixes = _blocks(nodes, bits).groupBy("tree", "block").cogroup(up.groupBy("tree", "block")).applyInArrow(lambda a, b: _down(bits, a, b), "tree string, pos long, suffix string")
    return suffixes


# ----------------------------------------------------------------- manifest
def leaf_digest(fields: dict[str, Column]) -> Column:
    """Hash of the fields: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    parts = []
    for c in fields.values():
        s = c.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _leaf_rows(bits: int, left: pa.Table, right: pa.Table) -> pa.Table:
    left, proofs = _proofs(bits, left, right)
    origin, root = right.column("subroot")[0].as_py(), right.column("root")[0].as_py()
    cols: dict[str, list] = {"proof": [], "folded": []}
    for leaf, changed, proof in zip(left.column("digest").to_pylist(), left.column("changed").to_pylist(), proofs, strict=True):
        cols["proof"].append(_hash(*[d for _, d in proof]))
        cols["folded"].append(fold(changed or leaf, proof))
    n = len(left)
    return pa.table({"doc_id": left.column("doc_id"), "leaf": left.column("digest"), "subroot": pa.array([origin] * n, pa.string()),
                     "root": pa.array([root] * n, pa.string()), "proof_sha256": pa.array(cols["proof"], pa.string()),
                     "folded_root": pa.array(cols["folded"], pa.string()), "verified": pa.array([f == root for f in cols["folded"]], pa.bool_())})


def _numbered(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``df`` with ``pos`` within ``key``; a key stays spread over tasks."""
    # monotonically_increasing_id parts rows that are equal in all of ``order``
    spread = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(key, *order, "_tie")
    return number_within(spread, key, [*order, "_tie"], "pos").drop("_tie")


def manifest(docs: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    Leaves of one lang ascend by doc_id (null first, ties by digest) in a binary tree; the
    langs' subroots, null first and then by UTF-8 bytes, are the leaves of the tree of the
    root. Where 7 divides the crc32 of the decimal doc_id, the folded root starts from a
    leaf whose n_chars is one more (not where doc_id or n_chars is null). Defined results: null
    fields count as ``-``, rows that repeat are leaves of their own, other columns
    are not read, texts are hashed whole where they are read; an empty table has no rows."""
    have = {c: F.col(c).cast("long" if c in ("doc_id", "n_chars") else "string") for c in FIELDS}
    # one more, exactly: the largest long has no successor of its own type
    more = have | {"n_chars": have["n_chars"].cast("decimal(20,0)") + 1}
    hit = F.pmod(F.crc32(have["doc_id"].cast("string").cast("binary")), F.lit(TAMPER)) == 0
    leaves = docs.select(F.coalesce(F.concat(F.lit("="), have["lang"]), F.lit("")).alias("tree"), have["doc_id"].alias("doc_id"),
                         leaf_digest(have).alias("digest"), F.when(hit, leaf_digest(more)).alias("changed"))
    leaves = written(leaves, "merkle-hashed")     # texts are read once; what follows has digests only
    leaves = written(_numbered(leaves, "tree", ["doc_id", "digest"]), "merkle-leaves")

    rounds = rise(leaves.select("tree", "pos", "digest"), bits)
    # a tree of one leaf has its top in every round; those of the last one are all
    subroots = rounds[-1].select(F.col("tree").alias("lang"), F.col("digest"))
    langs = written(_numbered(subroots.select(F.lit("").alias("tree"), "lang", "digest"), "tree", ["lang"]), "merkle-langs")
    above = rise(langs.select("tree", "pos", "digest"), bits)
    root = above[-1].first()
    suffixes = sink(above, above[-1].select("tree", "pos", F.lit("").alias("suffix")), bits)
    suffixes = _lowest(langs, suffixes, len(above) > 1, bits)
    tops = suffixes.select(F.col("lang").alias("tree"), F.lit(0).cast("long").alias("pos"), "suffix")
    below = sink(rounds, tops, bits) if len(rounds) > 1 else tops
    facts = langs.select(F.col("lang").alias("tree"), F.col("digest").alias("subroot"), F.lit(root.digest if root else None).alias("root"))
    blocks = below.select("tree", F.col("pos").alias("block"), "suffix").join(facts, "tree")
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _blocks(leaves, bits).groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(lambda a, b: _leaf_rows(bits, a, b), schema)


def _lang_rows(bits: int, left: pa.Table, right: pa.Table) -> pa.Table:
    left, proofs = _proofs(bits, left, right)
    return pa.table({"lang": left.column("lang"), "suffix": pa.array([_pack(p) for p in proofs], pa.string())})


def _lowest(langs: DataFrame, suffixes: DataFrame, deep: bool, bits: int) -> DataFrame:
    """lang, suffix of every lang's subroot."""
    if not deep:
        return langs.select("lang", F.lit("").alias("suffix"))
    up = suffixes.select("tree", F.col("pos").alias("block"), "suffix")
    return _blocks(langs, bits).groupBy("tree", "block").cogroup(up.groupBy("tree", "block")).applyInArrow(lambda a, b: _lang_rows(bits, a, b), "lang string, suffix string")
