"""Merkle manifest of a dataset, with a witness for every row.

Each row is a leaf; the leaves of a group (a language) form a tree of pairs, and the
roots of the groups form one more. Leaves are appended one by one to a frontier of
open subtrees. A leaf's witness starts empty and grows while the trees grow: when two
subtrees of one height are complete, the root of the right one is added to the partial
witnesses on the left and the other way round. So no tree is kept or walked again.

Over a cluster, places come from a range sort with counts per partition. ``BLOCK``
consecutive leaves form an aligned block, which one task streams through such a
frontier; the roots of the blocks are appended in the same way as leaves of the level
above, until each group has one root, and the roots of the groups once more. A row's
witness is then the concatenation of the partial witnesses of its block, of the blocks
above and of its group. A task holds one block, whatever share of the rows a group has.

A step of a witness is a byte and, where there is a sibling, its digest: ``L`` and ``R``
name the sibling's side, ``A`` is a node that is hashed alone at the end of a level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.shared import stored

#: Leaves of an aligned block; a power of two.
BLOCK = 1024
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def joined(*digests: bytes) -> bytes:
    """SHA-256 of digests as concatenated hex text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


class Frontier:
    """Open subtrees of an append-only tree, with the partial witnesses of their leaves."""

    def __init__(self) -> None:
        self.witnesses: list[list[bytes]] = []
        #: Height, root, and the range of leaves of each open subtree, largest first.
        self.open: list[tuple[int, bytes, int, int]] = []

    def append(self, leaf: bytes) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self.open.append((0, leaf, at, at + 1))
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._merge()

    def _merge(self) -> None:
        (height, left, a, b), (_, right, _, c) = self.open[-2:]
        self._extend(a, b, b"R" + right)
        self._extend(b, c, b"L" + left)
        self.open[-2:] = [(height + 1, joined(left, right), a, c)]

    def _extend(self, a: int, b: int, step: bytes) -> None:
        for w in self.witnesses[a:b]:
            w.append(step)

    def close(self, height: int | None = None) -> bytes:
        """The root once no leaf follows. ``height`` is that of an aligned block which
        others follow or precede; without it, the tree ends where one node is left."""
        while len(self.open) > 1 or height is not None and self.open[0][0] < height:
            if len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
                self._merge()
                continue
            h, root, a, b = self.open[-1]
            self._extend(a, b, b"A")
            self.open[-1] = (h + 1, joined(root), a, b)
        return self.open[0][1]


def steps(witness: bytes) -> Iterator[tuple[str, bytes]]:
    at = 0
    while at < len(witness):
        side = witness[at : at + 1].decode()
        size = 0 if side == "A" else 32
        yield side, witness[at + 1 : at + 1 + size]
        at += 1 + size


def folded(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and a witness give."""
    for side, sibling in steps(witness):
        leaf = joined(leaf) if side == "A" else joined(sibling, leaf) if side == "L" else joined(leaf, sibling)
    return leaf


def proof(witness: bytes) -> str:
    return hashlib.sha256("".join(s.hex() for _, s in steps(witness)).encode()).hexdigest()


def encoded(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]).cast("binary"), 256))


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``, the place of a row in its ``grp`` by ``order`` (which
    tells all rows apart), and ``size``, the rows of the group.

    Rows are sorted by ranges; what a range holds of each group is counted, and only
    these counts are summed in order.
    """
    keys = ["grp", *order]
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_range = nodes.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    lain = stored(by_range.withColumns({"_at": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}))
    counts = stored(lain.groupBy("grp", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")))
    before = Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("grp", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(Window.partitionBy("grp")).alias("size"))
    return lain.join(starts, ["grp", "_part"]).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_start")).drop("_at", "_part", "_first", "_start")


def blocks(leaves: DataFrame, block: int) -> DataFrame:
    """Each leaf of ``leaves(grp, pos, size, node, carry)`` with its aligned ``block``, the
    number of ``blocks`` in its group and its partial ``witness`` up to the block's root,
    which stands in ``root`` of the block's first row and is NULL elsewhere."""
    height = block.bit_length() - 1
    rows = leaves.select("grp", F.floor(F.col("pos") / block).alias("block"), F.ceil(F.col("size") / block).alias("blocks"), "pos", "node", "carry")
    rows = rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, frontier, carried = None, Frontier(), []

        def closed() -> pa.RecordBatch:
            n, root = len(carried), frontier.close(height if now[2] > 1 else None)
            columns = [*([x] * n for x in now), [root] + [None] * (n - 1), carried, [b"".join(w) for w in frontier.witnesses]]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), carry, pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["grp", "block", "blocks", "root", "carry", "witness"])

        for batch in batches:
            carry = batch.schema.field("carry").type
            for grp, number, many, _, node, what in zip(*(c.to_pylist() for c in batch.columns)):
                if (grp, number, many) != now:
                    if carried:
                        yield closed()
                    now, frontier, carried = (grp, number, many), Frontier(), []
                carried.append(what)
                frontier.append(node)
        if carried:
            yield closed()

    kind = leaves.schema["carry"].dataType.simpleString()
    return rows.mapInArrow(run, f"grp string, block bigint, blocks bigint, root binary, carry {kind}, witness binary")


def levels(leaves: DataFrame, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``blocks``, ``(grp, block, rest)`` with the witness of each block up to
    the root of its group, and ``(grp, root)``.

    The roots of blocks become leaves of the level above, until each group has one; every
    level is smaller by the size of a block.
    """
    level = stored(blocks(leaves, block))
    roots = stored(level.where(F.col("root").isNotNull()).select("grp", "block", "blocks", "root"))
    alone = roots.where("blocks = 1")
    rest = alone.select("grp", "block", F.lit(b"").alias("rest"))
    many = roots.where("blocks > 1")
    if many.isEmpty():
        return level, rest, alone.select("grp", "root")
    above = many.select("grp", F.col("block").alias("pos"), F.col("blocks").alias("size"), F.col("root").alias("node"), F.col("block").alias("carry"))
    higher, higher_rest, higher_roots = levels(above, block)
    over = higher.join(higher_rest, ["grp", "block"]).select("grp", F.col("carry").alias("block"), F.concat("witness", "rest").alias("rest"))
    return level, stored(rest.unionByName(over)), alone.select("grp", "root").unionByName(higher_roots)


def manifest(df: DataFrame, tampered: Column | None = None, block: int = BLOCK, key: str = "doc_id", group: str = "lang") -> DataFrame:
    """Per row: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``,
    ``folded_root`` and ``verified``.

    A leaf is the digest of ``doc_id, source, lang, n_chars, text``, NULL told from any
    value. In each group leaves ascend by key, NULL keys first, equal keys by their leaf;
    repeated rows are leaves of their own. While nodes remain, each two become the digest
    of both, a last single one that of itself. Groups are in UTF-8 byte order, NULL
    first. A group of one row has its leaf as root, and a table of one group has that
    group's root. An empty table gives an empty result.

    ``folded_root`` is what the witness makes of the row as it is claimed to be: with
    one more in ``n_chars`` where ``tampered`` (of the columns of ``df``) holds, else
    as it is.
    """
    values = {c: F.col(c) for c in FIELDS}
    claimed = values | {"n_chars": F.col("n_chars") + 1}
    changed = F.col("n_chars").isNotNull() & (F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False)))
    rows = stored(
        df.select(
            F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("grp"), F.col(key).alias("doc_id"), digest(*values.values()).alias("node"),
            F.when(changed, digest(*claimed.values())).alias("claimed"), F.monotonically_increasing_id().alias("row"),
        )
    )
    leaves = placed(rows, ["doc_id", "node", "row"]).select("grp", "pos", "size", "node", F.struct("doc_id", "node", "claimed").alias("carry"))
    level, rest, subroots = levels(leaves, block)
    tops = placed(stored(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("node"))), ["name"])
    last, last_rest, root = levels(tops.select("grp", "pos", "size", "node", F.struct(F.col("name").alias("of"), F.col("node").alias("subroot")).alias("carry")), block)
    named = last.join(last_rest, ["grp", "block"]).select(F.col("carry.of").alias("grp"), "carry.subroot", F.concat("witness", "rest").alias("top"))
    # Groups are joined to blocks, of which there are few, and blocks to rows by a key of at most BLOCK rows.
    paths = stored(rest.join(named, "grp").select("grp", "block", "subroot", F.concat("rest", "top").alias("path")))
    whole = level.join(paths, ["grp", "block"]).select("carry.*", "subroot", F.concat("witness", "path").alias("witness"))
    top = root.first()
    return _folded(whole, bytes(top["root"]) if top else b"")


def _folded(rows: DataFrame, root: bytes) -> DataFrame:
    """Fold each claimed leaf with its witness; ``rows``: (doc_id, node, claimed, subroot, witness)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, claimed, subroot, witness = (batch.column(i).to_pylist() for i in range(1, 5))
            found = [folded(n if c is None else c, w) for n, c, w in zip(node, claimed, witness)]
            texts = [[d.hex() for d in node], [d.hex() for d in subroot], [root.hex()] * len(batch), [proof(w) for w in witness], [d.hex() for d in found]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(t, pa.string()) for t in texts), pa.array([d == root for d in found], pa.bool_())],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
