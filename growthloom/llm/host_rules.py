"""Host-level quality rules: shrunken failure rates per source.

Every document is measured once (words, symbols, repeated lines and word
windows) and graded by each rule: near the limit, over it, or far over it.
What is near or over is counted per source with partial aggregates, the spread
of the sources' rates gives an empirical beta prior for each rule (method of
moments), and each source's rate is shrunk towards it. The verdicts go back to
the documents by a join.

A document is rejected when

* it fails the base rule (too short, or mostly repeated word windows);
* a further rule grades it over the limit. Here its host decides on what is
  close: a host whose shrunken rate is at least ``STRICT`` times the corpus's
  loses documents near the limit too, one with at most ``TRUST`` times keeps
  those that aren't far over it; or
* its host is bad: the shrunken rate of some rule is at least ``bad``.

A host with few documents is close to the corpus's rate whatever it shows, so
that only evidence makes it strict or trusted.

Nulls: a null text has no words and fails the base rule; a null source is a
source of its own; other columns pass through unread. Repeated rows are
measured row by row. An empty table gives an empty result. One source's
spread can't be told: the prior then weighs one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthloom.llm.common import Vocabulary, picked, positional, restored, scratch_table, text_bytes

SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
BLANKS = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)
#: Times the corpus's rate at which a host is strict, or trusted.
STRICT, TRUST = 2.0, 0.5
#: Hosts up to this number are broadcast; of more, those with a hundredth of the documents (a hundred at most) are.
FEW_HOSTS = 10_000

#: Shorter texts have fewer than 2^21 words.
LONG_BYTES = 4_000_000
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(numbers: np.ndarray, width: int = 3) -> int:
    """Words that lie in a window of three words found at least twice."""
    n = len(numbers) - width + 1
    if n < 2:
        return 0
    windows = (numbers[:n] << 42) | (numbers[1 : n + 1] << 21) | numbers[2 : n + 2]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    found = np.zeros(n, bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    covered = np.zeros(len(numbers), bool)
    for j in range(width):
        covered[j : n + j] |= found
    return int(covered.sum())


def _plain(text: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = len(text) - int(count[0x80:0xC0].sum()) - int(count[BLANKS].sum())
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(words), chars, int(count[SYMBOLS].sum()), len(lines) - len(set(lines))


def _measure(text: bytes, vocabulary: Vocabulary) -> tuple[int, int, int, int, int]:
    words = text.split()
    if not words:
        return 0, 0, 0, 0, 0
    return *_plain(text, words), _repeat_words(vocabulary.numbers(words))


def measured(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the five measures of each whole text."""
    keep = tuple(keep)
    frame = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1]] + [f"{m} long" for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary()
        for batch in batches:
            rows = []
            for text in text_bytes(batch.column(batch.num_columns - 1)):
                # A number must fit 21 bits for the packed windows to be exact.
                if len(text) >= LONG_BYTES:
                    rows.append(_measure_long(text))
                    continue
                if len(vocabulary) + len(text) // 2 >= vocabulary.limit:
                    vocabulary = Vocabulary()
                rows.append(_measure(text, vocabulary))
            table = np.array(rows, np.int64).reshape(len(rows), len(MEASURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + [pa.array(table[:, j]) for j in range(len(MEASURES))],
                names=[*keep, *MEASURES],
            )

    return frame.mapInArrow(run, schema)


def _measure_long(text: bytes) -> tuple[int, int, int, int, int]:
    """As ``_measure`` for texts whose words may not fit 21-bit numbers."""
    words = text.split()
    if not words:
        return 0, 0, 0, 0, 0
    # Pairs of words are numbered first, then pairs of such a pair and a word.
    numbers = Vocabulary().numbers(words)
    _, pairs = np.unique((numbers[:-1] << 32) | numbers[1:], return_inverse=True)
    _, triples = np.unique((pairs[:-1].astype(np.int64) << 32) | numbers[2:], return_inverse=True)
    many = np.bincount(triples, minlength=1)[triples] > 1
    covered = np.zeros(len(numbers), bool)
    for j in range(3):
        covered[j : len(many) + j] |= many
    return *_plain(text, words), int(covered.sum())


def rule_grades() -> dict[str, Column]:
    """The rules: name -> 1 near the limit, 2 over it, 3 far over it, else 0. The first two are the base rule."""
    n, chars = F.col("n_words"), F.col("word_chars")

    def grade(near: Column, over: Column, far: Column) -> Column:
        return F.when(far, 3).when(over, 2).when(near, 1).otherwise(0)

    def share(count: str, near: int, over: int, far: int) -> Column:
        of = 100 * F.col(count)
        return grade(of > near * n, of > over * n, of > far * n)

    return {
        "short": F.when(n < 50, 2).otherwise(0),
        "repetitive": F.when(100 * F.col("n_repeat_words") > 50 * n, 2).otherwise(0),
        "symbols": share("n_symbols", 30, 60, 120),
        "word_length": grade((chars < 3 * n) | (chars > 12 * n), (chars < 2 * n) | (chars > 15 * n), (2 * chars < 3 * n) | (chars > 25 * n)),
        "dup_lines": share("n_dup_lines", 3, 5, 10),
    }


def host_key(host_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(host_col)), F.lit("-"))


def host_rates(measures: DataFrame, host_col: str = "source") -> DataFrame:
    """Per host: documents and, per rule, the shrunken rate ``p_<rule>`` of what is near
    or over the limit, and the corpus's rate ``m_<rule>``.

    One row per host; the prior needs only sums over the hosts, so the second
    aggregate combines per task and moves a few numbers.
    """
    rules = rule_grades()
    hosts = measures.groupBy(host_key(host_col).alias("__host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum((grade > 0).cast("long")).alias(f"f_{r}") for r, grade in rules.items()],
    )
    moments = hosts.agg(
        F.count(F.lit(1)).alias("n_hosts"),
        F.sum("n_docs").alias("docs"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("squares"),
        *[F.sum(f"f_{r}").alias(f"s_{r}") for r in rules],
        *[F.sum(F.col(f"f_{r}").cast("double") * F.col(f"f_{r}") / F.col("n_docs")).alias(f"q_{r}") for r in rules],
    ).withColumn("__one", F.lit(1))
    both = hosts.withColumn("__one", F.lit(1)).join(F.broadcast(moments), "__one")  # one row
    rates = []
    for r in rules:
        mean = F.col(f"s_{r}") / F.col("docs")
        # Spread of the hosts' rates, weighted by documents, less what binomial noise alone gives.
        spread = F.col(f"q_{r}") - F.col(f"s_{r}") * mean
        noise = (F.col("n_hosts") - 1) * mean * (1 - mean)
        between = (spread - noise) / (F.col("docs") - F.col("squares") / F.col("docs"))
        strength = (
            F.when((F.col("n_hosts") < 2) | (mean <= 0) | (mean >= 1), F.lit(1.0))
            .when(between <= mean * (1 - mean) / 1e6, F.lit(1e6))
            .otherwise(F.greatest(F.lit(1.0), mean * (1 - mean) / between - 1))
        )
        rates += [((F.col(f"f_{r}") + strength * mean) / (F.col("n_docs") + strength)).alias(f"p_{r}"), mean.alias(f"m_{r}")]
    return both.select("__host", "n_docs", F.col("docs").alias("all_docs"), *rates)


def host_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", bad: float = 0.9) -> DataFrame:
    """One row per document: measures, ``base_failed``, the host's rates and ``kept``."""
    rows = picked(docs, c0=id_col, c1=host_col, c2=text_col)
    measures = scratch_table(measured(rows, "c2", ("c0", "c1")), "measures")
    return judged(measures, "c1", bad).withColumnsRenamed({"c0": id_col, "c1": host_col})


def kept_documents(docs: DataFrame, text_col: str = "text", host_col: str = "source", bad: float = 0.9) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. Texts are
    measured once and written beside their measures."""
    frame = positional(docs)
    text, host = (f"c{docs.columns.index(c)}" for c in (text_col, host_col))
    measures = scratch_table(measured(frame, text, tuple(frame.columns)), "measures")
    return restored(judged(measures, host, bad).where("kept"), docs)


def _with_rates(measures: DataFrame, rates: DataFrame, host_col: str) -> DataFrame:
    """``measures`` with their hosts' rates. A host with a large share of all
    rows never meets in one task: few hosts are broadcast, and of many the large
    ones are; only the others' rows are shuffled."""
    keyed = measures.withColumn("__host", host_key(host_col))
    if rates.limit(FEW_HOSTS + 1).count() <= FEW_HOSTS:
        return keyed.join(F.broadcast(rates), "__host")
    large = F.broadcast(rates.where("100 * n_docs >= all_docs"))  # a hundred hosts at most
    rest = keyed.join(large.select("__host"), "__host", "left_anti").join(rates, "__host")
    return keyed.join(large, "__host").unionByName(rest)


def judged(measures: DataFrame, host_col: str = "source", bad: float = 0.9) -> DataFrame:
    """Verdicts for measured documents (see the module's text for the rules)."""
    rules = rule_grades()
    joined = _with_rates(measures, scratch_table(host_rates(measures, host_col), "host-rates"), host_col)
    base = (rules["short"] > 0) | (rules["repetitive"] > 0)
    host_bad = F.greatest(*[F.col(f"p_{r}") for r in rules]) >= bad
    own = F.lit(False)
    for r, grade in list(rules.items())[2:]:
        rate, mean = F.col(f"p_{r}"), F.col(f"m_{r}")
        own = own | (grade >= F.when(rate >= STRICT * mean, 1).when(rate <= TRUST * mean, 3).otherwise(2))
    return (
        joined.withColumn("base_failed", base)
        .withColumn("host_bad", host_bad)
        .withColumn("kept", ~base & ~host_bad & ~own)
        .drop("__host", "n_docs", "all_docs", *[f"m_{r}" for r in rules])
    )
