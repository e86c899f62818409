"""Mixing sources to target weights by subset-sum budget fitting.

Sources, ordered by code point with null last, weigh WEIGHTS in turn and share
``share`` times all words. A target stops at ``cap`` times its source's words;
what is over goes to the others by weight, until none is above (water
filling). Per source, whole passes are taken first; the rest of the budget is
fitted on the counts of documents by exact length:

1. each length gives documents in proportion, rounded down;
2. lengths with the largest remainders give one more each, while the budget
   that is left exceeds ``DP_LIMIT`` words (then longest first, if need be);
3. a bounded-knapsack dynamic program over the documents that are left finds
   the largest sum within the last ``DP_LIMIT`` words.

Of each length, seeded hashes choose which documents are meant. A length that
very many documents have is cut into hash ranges of about ``RANGE_ROWS``
documents, whose counts tell where the choice ends; only that range is ranked.

Nulls: a null text has no words; null sources are one source; null ids pass
through. Documents without words are taken as often as their source's whole
passes and count for nothing. Ties in the hash are rows alike in id and text,
so reruns return the same rows. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthloom.llm.common import picked, positional, restored, scratch_table, word_count

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2
DP_LIMIT = 1 << 16
RANGE_ROWS = 10_000


def subset_sum(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many items of each size give the largest sum up to ``budget``.

    Counts are split into powers of two; ``by`` holds for each sum the item
    that reached it first, so every item is used once on the way back.
    """
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    by = np.full(budget + 1, -1, np.int64)
    items: list[tuple[int, int]] = []
    for n, (size, count) in enumerate(zip(sizes, counts)):
        many = 1
        while count > 0 and size * min(many, count) <= budget and not reached[budget]:
            used = min(many, count)
            weight = size * used
            new = np.zeros(budget + 1, bool)
            new[weight:] = reached[: budget + 1 - weight]
            new &= ~reached
            by[new] = len(items)
            reached |= new
            items.append((n, used))
            count -= used
            many *= 2
        if reached[budget]:
            break
    at = int(np.flatnonzero(reached)[-1])
    out = [0] * len(sizes)
    while at > 0:
        n, used = items[by[at]]
        out[n] += used
        at -= sizes[n] * used
    return out


def fitted(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """Documents to take of each size (over 0) so that their words come nearest to ``budget`` from below."""
    total = sum(s * c for s, c in zip(sizes, counts))
    if budget <= 0 or total == 0:
        return [0] * len(sizes)
    if budget >= total:
        return list(counts)
    take = [c * budget // total for c in counts]
    left = budget - sum(s * t for s, t in zip(sizes, take))
    for n in sorted(range(len(sizes)), key=lambda n: (-(counts[n] * budget % total), sizes[n])):
        if left <= DP_LIMIT:
            break
        if sizes[n] <= left and take[n] < counts[n]:
            take[n] += 1
            left -= sizes[n]
    for n in sorted(range(len(sizes)), key=lambda n: -sizes[n]) if left > DP_LIMIT else ():
        if left <= DP_LIMIT:
            break
        more = min(counts[n] - take[n], left // sizes[n])
        take[n] += more
        left -= more * sizes[n]
    if left > 0:
        usable = [n for n in range(len(sizes)) if sizes[n] <= left and take[n] < counts[n]]
        for n, more in zip(usable, subset_sum([sizes[n] for n in usable], [counts[n] - take[n] for n in usable], min(left, max(DP_LIMIT, 1)))):
            take[n] += more
    return take


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` (a row a source) with ``__n``, from 0, by code point with null last.

    Sorted ranges are numbered in a task each; what lies before a range is added."""
    order = F.col("source").asc_nulls_last()
    ranged = scratch_table(sources.repartitionByRange(order).withColumn("__p", F.spark_partition_id()), "sources")
    before, offsets = 0, []
    # As many rows as the shuffle has partitions.
    for r in sorted(ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["__p"]):
        offsets.append((r["__p"], before))
        before += r["n"]
    starts = sources.sparkSession.createDataFrame(offsets, "__p int, __before long")
    number = F.row_number().over(W.partitionBy("__p").orderBy(order)) - 1
    return ranged.withColumn("__i", number).join(F.broadcast(starts), "__p").withColumn("__n", F.col("__i") + F.col("__before")).drop("__p", "__i", "__before")


def water_level(weighed: DataFrame, share: float, cap: float) -> float | None:
    """The level at which ``share`` times all words are given (null: every source gets its limit).

    What is given is concave in the level, so steps along its slope rise to the level
    and end there. Each one is an aggregate of one row; the open sources become fewer with each.
    """
    limit, weight = cap * F.col("source_size"), F.col("weight")
    level = 0.0
    while True:
        full = limit < F.lit(level) * weight
        r = weighed.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(full, limit)).alias("given"),
            F.sum(F.when(~full, weight)).alias("open"),
        ).first()
        if not r.open or share >= cap:
            return None
        higher = (share * r.words - (r.given or 0)) / r.open
        if higher <= level:
            return level
        level = higher


def source_targets(sources: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sources`` (source, source_size: a row a source) and each one's ``target``."""
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    weighed = scratch_table(numbered(sources).withColumn("weight", F.element_at(weights, (F.col("__n") % len(WEIGHTS) + 1).cast("int"))).drop("__n"), "weighed")
    limit, level = (cap * F.col("source_size")).cast("double"), water_level(weighed, share, cap)
    return weighed.withColumn("target", limit if level is None else F.least(limit, F.lit(level) * F.col("weight"))).drop("weight")


def mixed(rows: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``rows`` (source, size, __h: a seeded hash) with source_size, target and ``copies``."""
    source_key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("__s")
    sizes = scratch_table(rows.withColumn("__s", source_key), "sizes")
    lengths = scratch_table(sizes.groupBy("source", "__s", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    targets = scratch_table(source_targets(lengths.groupBy("source", "__s").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), share, cap).drop("source"), "targets")

    def fit(key, table):
        total = int(table["source_size"].iloc[0])
        target = float(table["target"].iloc[0])
        passes = int(target // total) if total else 0
        table = table.sort_values("size")
        some = (table["size"] > 0).tolist()
        sized, counts = table["size"].tolist(), table["n"].tolist()
        take = iter(fitted([s for s, x in zip(sized, some) if x], [c for c, x in zip(counts, some) if x], round(target - passes * total)))
        table["passes"] = passes
        table["extra"] = [next(take) if x else 0 for x in some]
        return table[["__s", "size", "n", "source_size", "target", "passes", "extra"]]

    # A group is one source's counts by length: the root of twice its words in rows at most.
    plan = scratch_table(
        lengths.drop("source").join(targets, "__s").groupBy("__s").applyInPandas(fit, "__s string, size long, n long, source_size long, target double, passes long, extra long"),
        "plan",
    )
    planned = sizes.join(plan, ["__s", "size"])
    ranges = F.ceil(F.col("n") / RANGE_ROWS)
    partly = F.col("extra").between(1, F.col("n") - 1)
    ranged = planned.withColumn("__r", F.when(partly, F.floor(F.pmod(F.col("__h"), F.lit(1 << 30)) / float(1 << 30) * ranges)))
    by_range = W.partitionBy("__s", "size").orderBy("__r").rowsBetween(W.unboundedPreceding, -1)
    ends = (
        ranged.where(partly)
        .groupBy("__s", "size", "__r")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(by_range), F.lit(0)))
    )
    split = ranged.where(partly).join(ends, ["__s", "size", "__r"])
    cut = F.col("__before").between(F.col("extra") - F.col("__n") + 1, F.col("extra") - 1)
    rank = F.row_number().over(W.partitionBy("__s", "size", "__r").orderBy(F.pmod(F.col("__h"), F.lit(1 << 30)), "__h"))
    ranked = split.where(cut).withColumn("__more", (F.col("__before") + rank <= F.col("extra")).cast("long"))
    whole = split.where(~cut).withColumn("__more", (F.col("__before") < F.col("extra")).cast("long"))
    plain = ranged.where(~partly).withColumn("__more", (F.col("extra") > 0).cast("long"))
    columns = [*rows.columns, "source_size", "target", (F.col("passes") + F.col("__more")).alias("copies")]
    return plain.select(*columns).unionByName(whole.select(*columns)).unionByName(ranked.select(*columns))


def _hash(columns: list[Column], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def row_key(columns: list[Column]) -> Column:
    """What tells rows apart: 128 bits over all columns, each with its length, nulls marked."""
    texts = [c.cast("string") for c in columns]
    marked = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.md5(F.concat(*marked).cast("binary")))


def source_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17) -> DataFrame:
    """One row per document: id, size, source_size, target, taken, source."""
    frame = picked(docs, id=id_col, source=source_col, text=text_col)
    rows = frame.select("id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), _hash([F.col("id"), F.col("text")], seed).alias("__h"))
    return mixed(rows).select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), F.col("source").alias(source_col))


def mixed_documents(docs: DataFrame, text_col: str = "text", source_col: str = "source", seed: int = 17) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns.

    Rows alike in all columns are one row here, taken as often as they are together.
    """
    frame = positional(docs)
    keyed = frame.withColumn("__k", row_key([F.col(c) for c in frame.columns]))
    text, source = (F.col(f"c{docs.columns.index(c)}") for c in (text_col, source_col))
    rows = keyed.select(source.cast("string").alias("source"), word_count(text).alias("size"), _hash([F.col("__k")], seed).alias("__h"), "__k")
    copies = mixed(rows).groupBy("__k").agg(F.sum("copies").alias("__copies")).where("__copies > 0")
    taken = keyed.dropDuplicates(["__k"]).join(copies, "__k")
    return restored(taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))), docs)
