"""Labelled rows for fitting: bounded, and never from the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthloom.llm.common import picked, scratch_table

FOLDS = 5


def fold_of(id_col: Column) -> Column:
    """crc32 of the id as text, mod FOLDS (null id: of the empty text); fold 0 is held out."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, columns: tuple[str, ...], rows: int, id_col: str = "doc_id") -> DataFrame:
    """(id, label, *columns) of at most ``rows`` labelled documents outside fold 0, drawn by hash.

    An id that is null, or labelled or found more than once, counts once: its
    least label, and the row that is least in ``columns``, nulls first. The drawn ids are few enough
    to be broadcast, so texts aren't shuffled to find them.
    """
    drawn = (
        picked(labels, __id=id_col, label=label_col)
        .where(F.col("__id").isNotNull() & F.col("label").isNotNull() & (fold_of(F.col("__id")) != 0))
        .groupBy("__id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("__id", F.lit(5)), "__id")
        .limit(rows)
    )
    drawn = scratch_table(drawn, "drawn")
    found = picked(docs, **{id_col: id_col}, **{c: c for c in columns}).join(F.broadcast(drawn), F.col(id_col) == F.col("__id"))  # ``rows`` ids at most
    least = found.groupBy(F.col("__id").alias("id"), "label").agg(F.min(F.struct(*columns)).alias("row"))
    return scratch_table(least.select("id", "label", "row.*"), "labelled")
