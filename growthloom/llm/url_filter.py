"""URL filters: list rules, then a character language-model ratio, in DataFrame operations alone.

A rule (verdict, host/path) fits its host and all subdomains where the URL's
path starts with the rule's; the longest wins. URLs that no rule decides are
judged by two smoothed variable-order Markov models over the characters of
host and path, one of the URLs that rules allow, one of those they block:
contexts of up to CONTEXT characters, interpolated by the number of kinds of
characters seen after a context (Witten and Bell); where a context was never
seen, the next shorter one speaks. The score is the difference of the log
likelihoods over the number of characters. One URL in FOLDS, by hash, is kept
out of the counts and calibrates the bound: between both classes' mean scores,
nearer to the one that spreads less.

Work is done once for each distinct host and path, and model probabilities
once for each distinct run of characters, so repeated URLs and common runs are
combined before any shuffle.

Nulls and URLs without ``://`` have empty host and path, which no rule fits.
If a class has no URL to learn or to calibrate from, what no rule decides is
allowed. Repeated rows keep a row each, null ids pass through, an empty table
gives an empty result.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthloom.llm.common import picked, scratch_table

#: The rules of the production list.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
CONTEXT = 4
FOLDS = 5
#: Probability of a character before any is seen.
UNSEEN = 1 / 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        site, _, start = text.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _fold(s: Column) -> Column:
    return F.conv(F.substring(F.md5(s), 1, 4), 16, 10).cast("int") % FOLDS


def _runs(s: str = "s") -> Column:
    """All runs of CONTEXT + 1 characters of a string, padded at both ends."""
    padded = F.concat(F.lit("\x02" * CONTEXT), F.col(s), F.lit("\x03"))
    return F.transform(F.sequence(F.lit(1), F.length(s) + 1), lambda i: F.substring(padded, i, F.lit(CONTEXT + 1)))


def run_probabilities(runs: DataFrame) -> DataFrame:
    """(run, allow, block) counts -> (run, d): difference of the logs of both models' probabilities."""
    below = None
    for k in range(CONTEXT + 1):
        seen = runs.groupBy(F.substring("run", CONTEXT + 1 - k, k + 1).alias("g")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        seen = seen.withColumn("context", F.substring("g", 1, k))
        contexts = seen.groupBy("context").agg(
            *[F.sum(c).alias(f"n_{c}") for c in ("allow", "block")], *[F.sum((F.col(c) > 0).cast("long")).alias(f"t_{c}") for c in ("allow", "block")]
        )
        table = seen.join(contexts, "context")
        if below is None:
            table = table.withColumns({f"p_{c}": F.lit(UNSEEN) for c in ("allow", "block")})
        else:
            table = table.withColumn("tail", F.substring("g", 2, k)).join(below.withColumnRenamed("g", "tail"), "tail")
        below = table.select(
            "g",
            *[
                F.when(F.col(f"n_{c}") > 0, (F.col(c) + F.col(f"t_{c}") * F.col(f"p_{c}")) / (F.col(f"n_{c}") + F.col(f"t_{c}"))).otherwise(F.col(f"p_{c}")).alias(f"p_{c}")
                for c in ("allow", "block")
            ],
        )
        below = scratch_table(below, "url-model")
    return below.select(F.col("g").alias("run"), (F.log("p_allow") - F.log("p_block")).alias("d"))


def url_verdicts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score (null where a rule decides)."""
    url = F.col("url")
    parts = picked(pages, id=id_col, url=url_col).select(F.col("id").alias(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parts = parts.select("*", rule.alias("rule"), verdict.alias("said"))
    distinct = scratch_table(parts.groupBy("host", "path", "said").agg(F.count(F.lit(1)).alias("n")).withColumn("s", F.concat("host", "path")), "urls")
    learnt = _fold(F.col("s")) != 0
    runs = distinct.select("host", "path", "said", F.explode(_runs()).alias("run"), *[F.when(learnt & (F.col("said") == c), F.col("n")).otherwise(0).alias(c) for c in ("allow", "block")])
    model = run_probabilities(scratch_table(runs.groupBy("run").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")), "url-runs"))
    # Only what needs a score: URLs without a rule, and those that calibrate.
    needed = distinct.where(F.col("said").isNull() | ~learnt).select("host", "path", "said", "n", F.length("s").alias("length"), F.explode(_runs()).alias("run"))
    scores = scratch_table(
        needed.groupBy("host", "path", "said", "n", "length", "run").agg(F.count(F.lit(1)).alias("times"))
        .join(model, "run")
        .groupBy("host", "path", "said", "n", "length")
        .agg((F.sum(F.col("times") * F.col("d")) / (F.col("length") + 1)).alias("score")),
        "url-scores",
    )
    held = scores.where("said is not null")
    side = {c: F.col("said") == c for c in ("allow", "block")}
    weight = {c: F.sum(F.when(on, F.col("n"))) for c, on in side.items()}
    mean = {c: F.sum(F.when(on, F.col("n") * F.col("score"))) / weight[c] for c, on in side.items()}
    square = {c: F.sum(F.when(on, F.col("n") * F.col("score") * F.col("score"))) / weight[c] for c, on in side.items()}
    spread = {c: F.sqrt(F.greatest(square[c] - mean[c] * mean[c], F.lit(0.0))) + 1e-9 for c in side}
    between = (mean["allow"] * spread["block"] + mean["block"] * spread["allow"]) / (spread["allow"] + spread["block"])
    taught = distinct.where(learnt).agg(*[F.count(F.when(on, 1)).alias(f"taught_{c}") for c, on in side.items()])
    # Without a bound, as where a class had nothing to learn from, nothing is blocked.
    bound = held.agg(between.alias("between")).withColumn("one", F.lit(1)).join(F.broadcast(taught.withColumn("one", F.lit(1))), "one")  # one row each
    bound = bound.select("one", F.when((F.col("taught_allow") > 0) & (F.col("taught_block") > 0), F.col("between")).alias("bound"))
    judged = (
        scores.where("said is null").withColumn("one", F.lit(1)).join(F.broadcast(bound), "one")  # one row
        .select("host", "path", "score", F.when(F.coalesce(F.col("score") >= F.col("bound"), F.lit(True)), "allow").otherwise("block").alias("scored"))
    )
    return parts.join(judged, ["host", "path"], "left").select(id_col, "host", "path", "rule", F.coalesce("said", "scored").alias("verdict"), "score")
