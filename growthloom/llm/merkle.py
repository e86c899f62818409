"""A Merkle manifest of a dataset, with a witness for every row.

A row's leaf is the sha256 of its columns, each ``-`` if null, else its
UTF-8 byte count, a colon and the value. Leaves of one tree (a value of the
tree column) are in the order of their ids; every ARITY consecutive nodes
become the sha256 of their hexadecimal digests, the last run however short,
until one is left. The trees' roots, in the order of the trees' names, are the
nodes of one more tree with the dataset's root.

Nodes are appended in order to an ``Appender``: each open subtree carries a
witness that starts with the siblings before it and is extended by every
sibling that is completed later; a full run closes and its digest is appended
one level up. A block of ARITY^LEVELS consecutive nodes, aligned, is appended
in one task, and the blocks' roots are the nodes of the next round, so no task
holds more than a block and the driver holds nothing of the data. The leaves'
own blocks are stored as one row each (ids and digests); their witnesses are
made anew once the witness of the block's root is known, and go no further than
the task that checks them: kept for each leaf, they would outweigh the texts.

Trees may be of any size and number: positions come from a range sort and
counts by range, and a hot tree is many blocks.

Nulls: a null column is ``-`` in the leaf; the null tree comes first, null ids
come first. Rows alike in id go by their leaf; rows alike in all columns are
as many leaves and interchangeable. Empty and long texts are hashed whole. An
empty table gives an empty manifest. Other columns don't matter.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthloom.llm.common import picked, scratch_table

ARITY = 8
LEVELS = 4
BLOCK = ARITY**LEVELS
DIGEST = 32
#: Tables of at most so many rows (about 100 bytes each, witnesses up to 2 KB) are broadcast; larger ones are shuffled.
SMALL_ROWS = 10_000
#: One document in so many is checked with a tampered leaf.
TAMPER = 3

_sha256 = hashlib.sha256


def joined(digests: Sequence[bytes]) -> bytes:
    """sha256 of the digests' hexadecimal texts, one after the other."""
    return _sha256(b"".join(digests).hex().encode()).digest()


class Subtree:
    """A completed node: its digest, the witness its level gives it, and its
    parent once that is completed too."""

    __slots__ = ("digest", "before", "after", "parent")

    def __init__(self, digest: bytes, before: list[bytes]):
        self.digest = digest
        self.before = before
        self.after: list[bytes] = []
        self.parent: Subtree | None = None


class Appender:
    """Appends nodes in order and keeps every node's witness up to date.

    ``levels`` is the number of levels to go up; one node is left at the top
    of a full block, or of the last one after ``close``.
    """

    def __init__(self, levels: int, arity: int = ARITY):
        self.arity = arity
        self.open: list[list[Subtree]] = [[] for _ in range(levels + 1)]

    def append(self, digest: bytes, level: int = 0) -> Subtree:
        run = self.open[level]
        node = Subtree(digest, [s.digest for s in run])
        for sibling in run:
            sibling.after.append(digest)
        run.append(node)
        if len(run) == self.arity and level + 1 < len(self.open):
            self._complete(level)
        return node

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        parent = self.append(joined([s.digest for s in run]), level + 1)
        for node in run:
            node.parent = parent

    def close(self) -> bytes:
        """Complete the short runs; the top node's digest."""
        for level in range(len(self.open) - 1):
            if self.open[level]:
                self._complete(level)
        return self.open[-1][0].digest


def witness(node: Subtree) -> bytes:
    """Level by level up to the top: the number of siblings before and after, and their digests."""
    out = []
    while node.parent is not None:
        out.append(bytes((len(node.before), len(node.after))))
        out += node.before
        out += node.after
        node = node.parent
    return b"".join(out)


def folded(digest: bytes, path: bytes) -> bytes:
    """The root that a node's digest and witness lead to."""
    at = 0
    while at < len(path):
        before = at + 2 + path[at] * DIGEST
        after = before + path[at + 1] * DIGEST
        digest = _sha256((path[at + 2 : before].hex() + digest.hex() + path[before:after].hex()).encode()).digest()
        at = after
    return digest


def siblings(path: bytes) -> bytes:
    """The hexadecimal digests of a witness, in order."""
    out, at = [], 0
    while at < len(path):
        end = at + 2 + (path[at] + path[at + 1]) * DIGEST
        out.append(path[at + 2 : end])
        at = end
    return b"".join(out).hex().encode()


def levels_of(total: int) -> int:
    """Levels from ``total`` nodes to one, or to the roots of full blocks."""
    levels, size = 0, 1
    while size < total and levels < LEVELS:
        levels, size = levels + 1, size * ARITY
    return levels


def _field(value: bytes | None) -> bytes:
    return b"-" if value is None else b"%d:%s" % (len(value), value)


def leaf_rows(docs: DataFrame, columns: Sequence[str], id_col: str, tree_col: str, text_col: str) -> DataFrame:
    """(tree, id, leaf, tampered): digests of whole rows; ``tampered`` is the
    leaf of the row with its text's A-Z in lower case, for one id in TAMPER by
    crc32 (a null id: of the empty text), else null."""
    wanted = list(dict.fromkeys([tree_col, id_col, *columns]))
    rows = picked(docs, **{f"in{i}": c for i, c in enumerate(wanted)})
    place = [wanted.index(c) for c in columns]
    text_at = columns.index(text_col)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    as_text = rows.select("in0", "in1", *[F.col(f"in{p}").cast("string").cast("binary").alias(f"t{n}") for n, p in enumerate(place)], F.col("in1").cast("string").cast("binary").alias("name"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, tampered = [], []
            for r in range(batch.num_rows):
                value = [batch.column(2 + n)[r].as_py() for n in range(len(place))]
                fields = [_field(v) for v in value]
                leaves.append(_sha256(b"".join(fields)).digest())
                name = batch.column(2 + len(place))[r].as_py() or b""
                if zlib.crc32(name) % TAMPER:
                    tampered.append(None)
                    continue
                if value[text_at] is not None:
                    fields[text_at] = _field(value[text_at].lower())  # of bytes: A-Z alone
                tampered.append(_sha256(b"".join(fields)).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaves, pa.binary()), pa.array(tampered, pa.binary())], names=["tree", "id", "leaf", "tampered"])

    return as_text.mapInArrow(run, f"tree {types['in0']}, id {types['in1']}, leaf binary, tampered binary")


def _joined_small(left: DataFrame, small: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """A join that broadcasts ``small`` only if it has SMALL_ROWS rows at most."""
    few = small.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
    return left.join(F.broadcast(small) if few else small, on, how)


def positioned(rows: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """``rows`` with ``pos``, the place within ``tree`` by ``order``, and
    ``total``, the tree's rows.

    One range sort over everything, equal rows parted by a number; then each
    range's rows of a tree are counted and places follow from the ranges before.
    """
    keyed = rows.withColumn("tie", F.monotonically_increasing_id())
    by = [F.col("tree").asc_nulls_first(), *order, F.col("tie")]
    # The running number has the range in its upper 31 bits.
    numbered = keyed.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie").withColumn("at", F.monotonically_increasing_id())
    numbered = scratch_table(numbered.withColumn("part", F.shiftright("at", 33)), label)
    counts = numbered.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    # As many rows as ranges, within a tree.
    ranges, every = W.partitionBy("tree").orderBy("part"), W.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(ranges.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = scratch_table(counts.select(F.col("tree").alias("o_tree"), F.col("part").alias("o_part"), (before - F.col("first")).alias("shift"), F.sum("n").over(every).alias("total")), label)
    match = numbered["tree"].eqNullSafe(offsets["o_tree"]) & (numbered["part"] == offsets["o_part"])
    return _joined_small(numbered, offsets, match).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "o_tree", "o_part", "shift")


def blocks_of(nodes: DataFrame, label: str, payload: Sequence[str] = ()) -> DataFrame:
    """Nodes (tree, pos, total, digest) as one row for each aligned block:
    (tree, block, total, digests, root), ``payload`` columns as arrays.

    A block is appended in one task, in order; ``total`` is the tree's nodes.
    """
    types = {f.name: f.dataType.simpleString() for f in nodes.schema}
    names = ["tree", "block", "pos", "total", "digest", *payload]
    dealt = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK)).select(*names)
    dealt = dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def flush() -> pa.RecordBatch:
            table = pa.concat_tables(held).combine_chunks()
            total = table["total"][0].as_py()
            digests = table["digest"].to_pylist()
            appender = Appender(levels_of(total))
            for digest in digests:
                appender.append(digest)
            arrays = [table["tree"].combine_chunks().slice(0, 1), table["block"].combine_chunks().slice(0, 1), pa.array([total], pa.int64()), pa.array([b"".join(digests)], pa.binary()), pa.array([appender.close()], pa.binary())]
            for c in payload:
                values = table[c].combine_chunks()
                arrays.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            return pa.RecordBatch.from_arrays(arrays, names=["tree", "block", "total", "digests", "root", *payload])

        last = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            begin = 0
            keys = list(zip(table["tree"].to_pylist(), table["block"].to_pylist()))
            for r, key in enumerate(keys):
                if key != last and (held or r > begin):
                    if r > begin:
                        held.append(table.slice(begin, r - begin))
                    yield flush()
                    held, begin = [], r
                last = key
            if len(keys) > begin:
                held.append(table.slice(begin))
        if held:
            yield flush()

    schema = f"tree {types['tree']}, block long, total long, digests binary, root binary" + "".join(f", {c} array<{types[c]}>" for c in payload)
    return scratch_table(dealt.mapInArrow(run, schema), label)


def _appended(digests: bytes, total: int) -> list[Subtree]:
    """The nodes of a block with their witnesses up to the block's root."""
    appender = Appender(levels_of(total))
    nodes = [appender.append(digests[at : at + DIGEST]) for at in range(0, len(digests), DIGEST)]
    appender.close()
    return nodes


def _rounds(blocks: DataFrame, label: str) -> list[DataFrame]:
    """``blocks`` and the rounds above it, until every tree is one block."""
    rounds = [blocks]
    while rounds[-1].where(F.col("total") > BLOCK).limit(1).count():
        roots = rounds[-1].select("tree", F.col("block").alias("pos"), F.ceil(F.col("total") / BLOCK).alias("total"), F.col("root").alias("digest"))
        rounds.append(blocks_of(roots, label))
    return rounds


def _witnesses(blocks: DataFrame, upper: DataFrame | None, label: str) -> DataFrame:
    """(tree, pos, path) of a round's nodes, up to the tree's root; ``upper`` has the blocks' own."""
    tree_type = blocks.schema["tree"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                outer = batch.column(4)[r].as_py() or b""
                nodes = _appended(batch.column(3)[r].as_py(), batch.column(2)[r].as_py())
                first = batch.column(1)[r].as_py() * BLOCK
                tree = batch.column(0).take(pa.array([r] * len(nodes)))
                yield pa.RecordBatch.from_arrays([tree, pa.array(range(first, first + len(nodes)), pa.int64()), pa.array([witness(n) + outer for n in nodes], pa.binary())], names=["tree", "pos", "path"])

    rows = with_paths(blocks, upper).select("tree", "block", "total", "digests", "path")
    return scratch_table(rows.mapInArrow(run, f"tree {tree_type}, pos long, path binary"), label)


def with_paths(blocks: DataFrame, upper: DataFrame | None) -> DataFrame:
    """``blocks`` with the witness of each block's root within its tree (empty at the top)."""
    if upper is None:
        return blocks.withColumn("path", F.lit(bytearray()))
    paths = upper.select(F.col("tree").alias("p_tree"), F.col("pos").alias("p_pos"), "path")
    return _joined_small(blocks, paths, blocks["tree"].eqNullSafe(F.col("p_tree")) & (F.col("block") == F.col("p_pos"))).drop("p_tree", "p_pos")


def _path_to_top(rounds: list[DataFrame], label: str) -> DataFrame | None:
    """Witnesses of the first round's blocks, from the top down."""
    upper = None
    for blocks in reversed(rounds[1:]):
        upper = _witnesses(blocks, upper, label)
    return upper


def _checked(blocks: DataFrame, id_col: str) -> DataFrame:
    """A row for each leaf: its block is appended anew, and every witness
    extended by the block's (``path``), the tree's by ``top``."""
    id_type = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                total, digests, path, top, subroot, root = (batch.column(c)[r].as_py() for c in range(6))
                nodes = _appended(digests, total)
                outer = path + top
                after = siblings(outer)
                tampered = batch.column(7)[r].as_py()
                leaves, proofs, found = [], [], []
                for node, other in zip(nodes, tampered):
                    own = witness(node)
                    leaves.append(node.digest.hex())
                    proofs.append(_sha256(siblings(own) + after).hexdigest())
                    found.append(folded(node.digest if other is None else other, own + outer))
                ids = batch.column(6).slice(r, 1).flatten()
                n = len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(leaves), pa.array([subroot.hex()] * n), pa.array([root.hex()] * n), pa.array(proofs), pa.array([f.hex() for f in found]), pa.array(np.array([f == root for f in found], bool))],
                    names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    rows = blocks.select("total", "digests", "path", "top", "subroot", "dataset", "ids", "tampered")
    out = rows.mapInArrow(run, f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return out.withColumnRenamed("id", id_col)


def manifest(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id", tree_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    leaves = scratch_table(leaf_rows(docs, columns, id_col, tree_col, text_col), "leaves")
    placed = positioned(leaves, [F.col("id").asc_nulls_first(), F.col("leaf")], "ordered")
    nodes = placed.select("tree", "pos", "total", F.col("leaf").alias("digest"), F.col("id").alias("ids"), "tampered")
    rounds = _rounds(blocks_of(nodes, "blocks", ("ids", "tampered")), "rounds")
    # The trees' roots are the nodes of the dataset's tree.
    subroots = rounds[-1].select(F.col("tree").alias("name"), "root")
    named = subroots.select(F.lit(0).alias("tree"), "name", "root")
    trees = scratch_table(positioned(named, [F.col("name").asc_nulls_first()], "trees"), "trees")
    top_rounds = _rounds(blocks_of(trees.select("tree", "pos", "total", F.col("root").alias("digest")), "tops"), "tops")
    top_paths = _witnesses(top_rounds[0], _path_to_top(top_rounds, "tops"), "tops")
    dataset = top_rounds[-1].select("root").first()  # one digest
    named_paths = trees.select("name", F.col("root").alias("subroot"), F.col("pos").alias("t_pos")).join(top_paths.select("pos", F.col("path").alias("top")), F.col("t_pos") == F.col("pos")).drop("pos", "t_pos")
    whole = with_paths(rounds[0], _path_to_top(rounds, "rounds")).withColumn("dataset", F.lit(bytearray(dataset.root if dataset else b"")))
    return _checked(_joined_small(whole, named_paths, whole["tree"].eqNullSafe(F.col("name"))), id_col)
