"""Secret scans with an incremental blob ledger, in DataFrame operations alone.

Every version of every document is addressed by the SHA-256 of its text. The
ledger remembers which (blob, rule, rule version) pairs have been scanned and
what was found; a scan reads only blobs with unseen pairs, each blob once
however many paths hold it, and findings are joined back to all paths.

Positions come from a rule's matches and the pieces between them: a match
starts where the pieces up to it and the matches before it end.

Nulls: a null text is the empty blob; null ids pass through. Repeated rows
keep a row each. Empty tables give empty results, and an empty ledger means
that all is unseen. Other columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthloom.llm.common import picked, scratch_table


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters; other matches are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


# No pattern repeats a group: the regular expressions would recurse once a
# repetition, and a hostile text would overflow the stack.
#: The base kinds, in their order, and the method's own kinds after them.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", version=2),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,1000}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", version=2),
)
RULES = BASE + MORE


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _lengths(strings: Column) -> Column:
    return F.transform(strings, F.length)


def _quick(rule: Rule) -> str:
    """A pattern that finds something wherever the rule can: for runs, only runs of enough characters."""
    return rule.pattern[:-1] + "{%d,}" % (rule.least - (4 if rule.kind == "access" else 0)) if rule.group == 0 and rule.pattern.endswith("]+") else rule.pattern


def _matches(rule: Rule, text: Column, due: Column) -> Column:
    """Struct of a rule's matches in a text: lengths of the pieces before, of the matches, and of the group.

    A run pattern matches whole runs, so asking for long runs at once drops
    the short ones; they then count as part of the piece between.
    """
    pattern = _quick(rule)
    found = F.struct(
        F.lit(rule.kind).alias("kind"),
        F.lit(rule.version).alias("version"),
        _lengths(F.split(text, pattern, -1)).alias("between"),
        _lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("found"),
        _lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group))).alias("grouped"),
    )
    return F.when(due & text.rlike(pattern), found)


def scan(blobs: DataFrame, rules=RULES) -> DataFrame:
    """(blob, text, due: array of kinds) -> findings (blob, kind, version, start, end), in code points."""
    text = F.col("text")
    per_rule = F.array(*[_matches(r, text, F.array_contains("due", r.kind)) for r in rules])
    least = reduce(lambda a, r: F.when(F.col("m.kind") == r.kind, F.lit(r.least)).otherwise(a), rules, F.lit(1))
    rows = (
        blobs.select("blob", F.explode(F.filter(per_rule, lambda m: m.isNotNull())).alias("m"))
        .select("blob", "m.kind", "m.version", least.alias("least"), F.posexplode(F.arrays_zip(F.slice(F.col("m.between"), F.lit(1), F.size("m.found")).alias("between"), F.col("m.found").alias("found"), F.col("m.grouped").alias("grouped"))).alias("n", "x"))
        .select("blob", "kind", "version", "least", "n", "x.*")
        .distinct()
    )
    # A window is one rule's matches in one blob.
    upto = W.partitionBy("blob", "kind").orderBy("n")
    end = F.sum(F.col("between") + F.col("found")).over(upto)
    return (
        rows.withColumn("end", end.cast("long"))
        .where("grouped >= least")
        .select("blob", "kind", "version", (F.col("end") - F.col("found")).cast("long").alias("start"), "end")
    )


def update_ledger(versions: DataFrame, scanned: DataFrame | None = None, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(paths, newly scanned pairs, all findings).

    ``versions`` has a row for each version of each document. ``scanned``
    (blob, kind, version) and ``findings`` (blob, kind, version, start, end)
    are the ledger so far; append the new pairs and replace the findings.
    """
    versions = picked(versions, id=id_col, text=text_col)
    ident, text = F.col("id"), F.col("text")
    paths = scratch_table(versions.select(ident.alias("id"), blob_of(text).alias("blob")), "paths")
    # One row of each blob will be read: that of its least id.
    blobs = paths.groupBy("blob").agg(F.min("id").alias("id"))
    asked = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    pairs = blobs.select("blob", "id", F.explode(asked).alias("r")).select("blob", "id", "r.*")
    if scanned is not None:
        pairs = pairs.join(scanned.select("blob", "kind", "version").distinct(), ["blob", "kind", "version"], "left_anti")
        due = scratch_table(pairs.groupBy("blob", "id").agg(F.collect_set("kind").alias("due")), "due")
    else:
        due = scratch_table(blobs.select("blob", "id", F.array(*[F.lit(r.kind) for r in rules]).alias("due")), "due")
    texts = versions.select(ident.alias("__id"), blob_of(text).alias("__blob"), F.coalesce(text, F.lit("")).alias("text"))
    # By id and blob, so that the copies of one blob don't meet; narrow rows are hashed, texts stream by.
    unseen = texts.join(due.hint("shuffle_hash"), (F.col("__blob") == F.col("blob")) & F.col("__id").eqNullSafe(F.col("id")))
    new = scan(unseen.select("blob", "text", "due"), rules)
    if findings is not None:
        current = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
        old = findings.where(F.array_contains(current, F.struct("kind", "version")))
        new = new.unionByName(old.select("blob", "kind", "version", "start", "end"))
    newly = due.select("blob", F.explode("due").alias("kind")).join(F.broadcast(_versions(due, rules)), "kind")  # a row a rule
    return paths, newly, scratch_table(new, "findings")


def _versions(df: DataFrame, rules) -> DataFrame:
    return df.sparkSession.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int")


def findings_by_path(paths: DataFrame, findings: DataFrame, rules=RULES, id_col: str = "doc_id") -> DataFrame:
    """One row per path: counts of the base kinds, the digest of their spans, and all spans."""
    order = reduce(lambda a, x: F.when(F.col("kind") == x[1].kind, F.lit(x[0])).otherwise(a), enumerate(rules), F.lit(len(rules)))
    base = [r.kind for r in BASE]
    per_blob = findings.groupBy("blob").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in base],
        F.sort_array(F.collect_list(F.struct("start", order.alias("o"), "end", "kind"))).alias("s"),
    )

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    per_blob = per_blob.select("blob", *[f"n_{k}" for k in base], joined(F.filter("s", lambda x: x["kind"].isin(*base))).alias("base"), joined(F.col("s")).alias("spans"))
    return paths.join(per_blob, "blob", "left").select(
        F.col("id").alias(id_col),
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """A first scan: one row per document, with an empty ledger before it."""
    paths, _, findings = update_ledger(docs, id_col=id_col, text_col=text_col, rules=rules)
    return findings_by_path(paths, findings, rules, id_col)
