"""Sharding by extendible hashing, with DataFrame operations alone.

A document's 60-bit hash comes from its id and text. The directory starts at
depth 0; a bucket over the byte limit splits on the next bit of the hash, and
only such a bucket does. Bits are taken several at a time: one aggregate gives
the bytes by a long prefix, its roll-up the bytes by every shorter one, and a
bucket is the shortest prefix that fits. Prefixes that don't fit at the last
bit counted so far go on to the next round.

A document over the limit is a shard of its own, at the depth where it stands
alone. Rows alike in id and text have one hash and no bit can part them: they
fill overflow shards of the bucket (``+1``, ``+2``...), as many rows to each as
the limit holds.

Nulls: a null text has no bytes; null ids hash like the word null. Repeated
rows: see above. Empty tables give empty results; other columns don't matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthloom.llm.common import positional, scratch_table

BITS = 60
LIMIT_BYTES = 32 << 20
#: Bits a round adds after the first.
ROUND = 10
#: Numbers into which rows of one hash are dealt before they are counted.
SALTS = 256


def hash_bits(id_col: Column, text_col: Column) -> Column:
    """The first 60 bits of the MD5 of id and text, as a long."""
    text = F.md5(F.coalesce(text_col, F.lit("")).cast("binary"))
    key = F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(":"), text).cast("binary"))
    return F.conv(F.substring(key, 1, BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, depth: Column | int) -> Column:
    return F.shiftright(h, BITS - depth) if isinstance(depth, int) else F.expr(f"shiftright(h, {BITS} - depth)")


def directory_rounds(rows: DataFrame, limit: int) -> list[DataFrame]:
    """(h, mid, bytes) -> per round: rows with depth, shard_bytes and shard_docs; depth null: at no bit."""
    total = rows.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    depth = min(BITS, max(0, -(-total // limit)).bit_length() + 4)
    begun, open_rows, out = 0, rows, []
    while True:
        fine = open_rows.groupBy(_prefix(F.col("h"), depth).alias("p")).agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"))
        fine = scratch_table(fine, "prefixes")
        levels = fine.withColumn("depth", F.explode(F.sequence(F.lit(begun), F.lit(depth)))).withColumn("q", F.expr(f"shiftright(p, {depth} - depth)"))
        fits = levels.groupBy("depth", "q").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs")).where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1))
        first = levels.join(fits, ["depth", "q"]).groupBy("p").agg(F.min(F.struct("depth", "shard_bytes", "shard_docs")).alias("leaf"))
        leaves = scratch_table(fine.select("p").join(first, "p", "left").select("p", "leaf.*"), "leaves")
        placed = open_rows.withColumn("p", _prefix(F.col("h"), depth)).join(leaves, "p").drop("p")
        if depth == BITS or leaves.where("depth is null").isEmpty():
            return [*out, placed]
        placed = scratch_table(placed, "placed")
        out.append(placed.where("depth is not null"))
        open_rows = placed.where("depth is null").drop("depth", "shard_bytes", "shard_docs")
        begun, depth = depth + 1, min(BITS, depth + ROUND)


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_BYTES, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, (``keep``,) shard, depth, shard_bytes, shard_docs.

    ``shard`` is the bucket's bits, with ``+k`` for its k-th overflow shard.
    """
    frame = positional(docs)
    ident, text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    rows = scratch_table(
        frame.select(ident.alias("__id"), *[F.col(f"c{docs.columns.index(c)}").alias(f"__k{n}") for n, c in enumerate(keep)], hash_bits(ident, text).alias("h"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("mid")),
        "shard-rows",
    )
    placed = reduce(DataFrame.unionByName, directory_rounds(rows, limit))
    fit = placed.where("depth is not null").withColumn("shard", F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr(f"lpad(bin(shiftright(h, {BITS} - depth)), depth, '0')")))
    # Rows alike: numbered by a salt of their row number first, so that no task holds them all.
    alike = placed.where("depth is null").drop("depth", "shard_bytes", "shard_docs").withColumn("salt", F.pmod(F.xxhash64("mid"), F.lit(SALTS)))
    before = (
        alike.groupBy("h", "salt")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy("h").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("all", F.sum("n").over(W.partitionBy("h")))
        .drop("n")
    )
    number = F.col("before") + F.row_number().over(W.partitionBy("h", "salt").orderBy("mid")) - 1
    room = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("bytes"))).cast("long")
    over = (
        alike.join(before, ["h", "salt"])
        .withColumn("number", number)
        .withColumn("chunk", F.floor(F.col("number") / room).cast("long"))
        .withColumn("shard_docs", F.least(room, F.col("all") - F.col("chunk") * room))
        .withColumn("shard_bytes", F.col("shard_docs") * F.col("bytes"))
        .withColumn("depth", F.lit(BITS))
        .withColumn("shard", F.concat(F.lpad(F.bin("h"), BITS, "0"), F.lit("+"), (F.col("chunk") + 1).cast("string")))
    )
    columns = [F.col("__id").alias(id_col), *[F.col(f"__k{n}").alias(c) for n, c in enumerate(keep)], "shard", F.col("depth").cast("int").alias("depth"), "shard_bytes", "shard_docs"]
    return fit.select(*columns).unionByName(over.select(*columns))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard (``shard=<bits>``); rows of a shard come together in one task."""
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)
