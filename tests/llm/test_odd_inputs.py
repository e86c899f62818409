"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from growthloom.llm import (
    boosted_toxicity,
    factor_quality,
    host_rules,
    latent_search,
    mixing,
    prob_minhash,
    secret_ledger,
    sharding,
    token_file,
    url_filter,
)
from tests.llm import brute
from tests.llm.conftest import odd_rows

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(0, " ".join(f"word{i % 97} and{i % 13}" for i in range(40, 70)), 1), (1, None, 2), (2, "", 3), (None, "zz", 4)], "item_id long, text string, k int")


def run(name, docs, items, labels):
    return {
        "mix": lambda: mixing.source_mix(docs),
        "mixed_documents": lambda: mixing.mixed_documents(docs),
        "leaks": lambda: latent_search.contaminated(docs, items),
        "clean": lambda: latent_search.clean_documents(docs, items),
        "urls": lambda: url_filter.url_verdicts(docs, "doc_id", "text"),
        "secrets": lambda: secret_ledger.secrets(docs),
        "quality": lambda: factor_quality.quality_scores(docs, labels),
        "shards": lambda: sharding.shards(docs, limit=2000),
        "classes": lambda: prob_minhash.near_duplicates(docs),
        "one_of_each": lambda: prob_minhash.one_of_each(docs),
        "rules": lambda: host_rules.host_rules(docs),
        "kept": lambda: host_rules.kept_documents(docs),
        "tokens": lambda: token_file.round_trip(docs, TOKENIZER),
        "toxicity": lambda: boosted_toxicity.toxicity_scores(docs, labels),
    }[name]()


ROWWISE = ("mix", "urls", "secrets", "quality", "shards", "classes", "rules", "tokens", "toxicity")
FILTERS = ("mixed_documents", "clean", "one_of_each", "kept")


@pytest.mark.parametrize("name", [*ROWWISE, *FILTERS, "leaks"])
def test_empty_table(name, nothing, items, labels):
    out = run(name, nothing, items, labels)
    assert out.count() == 0
    if name in FILTERS:
        assert out.columns == nothing.columns


def test_empty_benchmark(odd, items):
    assert latent_search.contaminated(odd, items.limit(0)).count() == 0
    assert latent_search.clean_documents(odd, items.limit(0)).count() == len(odd_rows())


@pytest.mark.parametrize("name", ROWWISE)
def test_one_row_per_document(name, odd, items, labels):
    rows = run(name, odd, items, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows())


def test_mix(odd):
    rows = [r.asDict() for r in mixing.source_mix(odd).collect()]
    sizes = {r[0]: len((r[1] or "").split()) for r in odd_rows() if r[0] is not None}
    assert all(r["size"] == sizes[r["doc_id"]] for r in rows if r["doc_id"] is not None)
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    # Null is last: a, b, c, then by code point.
    assert {r["source"] for r in rows} == {"a", "b", "c", "\u00e9", "\U0001f600", None}
    assert Counter(tuple(sorted((k, str(v)) for k, v in r.items())) for r in rows) == Counter(tuple(sorted((k, str(v)) for k, v in r.asDict().items())) for r in mixing.source_mix(odd.repartition(3)).collect())


def test_mixed_documents_keep_their_columns(odd):
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    known = {(r[0], r[1]) for r in odd_rows()}
    assert {(r[0], r[1]) for r in out.collect()} <= known


def test_leaks(odd, items):
    found = {(r.doc_id, r.item_id) for r in latent_search.contaminated(odd, items).collect()}
    assert found == {(1, 0), (2, 0), (3, 0), (None, 0)}
    kept = latent_search.clean_documents(odd, items)
    assert kept.columns == odd.columns
    assert Counter(r[0] for r in kept.collect()) == Counter([4, 5, None, 6, 7, 8, 9, -1])


def test_secrets(odd):
    want = Counter((r[0], *brute.secret_row(r[1])) for r in odd_rows())
    assert Counter(tuple(r) for r in secret_ledger.secrets(odd).collect()) == want


def test_classes(odd):
    rows = odd_rows()
    texts = sorted({r[1] for r in rows if r[1]})
    of = dict(zip(texts, brute.duplicate_classes(texts)))
    ids = {}
    for r in rows:
        if r[1] and r[1].split() and r[0] is not None:
            ids[of[r[1]]] = min(ids.get(of[r[1]], r[0]), r[0])
    want = Counter((r[0], ids[of[r[1]]] if r[1] and r[1].split() else r[0]) for r in rows)
    assert Counter((r.doc_id, r.class_id) for r in prob_minhash.near_duplicates(odd).collect()) == want
    one = prob_minhash.one_of_each(odd)
    assert one.columns == odd.columns
    assert Counter(r[0] for r in one.collect()) == Counter([1, 4, 5, None, 6, 7, 8, -1])


def test_shards(odd):
    rows = sharding.shards(odd, limit=2000, keep=("text", "k")).collect()
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
    for held in by_shard.values():
        size = sum(len((r.text or "").encode()) for r in held)
        assert {(r.shard_bytes, r.shard_docs) for r in held} == {(size, len(held))}
        assert size <= 2000 or len(held) == 1


def test_rows_alike_fill_overflow_shards(spark):
    docs = spark.range(500).selectExpr("1 as doc_id", "'abcdefgh' as text")
    rows = sharding.shards(docs, limit=80).collect()
    assert Counter(Counter(r.shard for r in rows).values()) == Counter({10: 50})
    assert all("+" in r.shard for r in rows)


def test_rules(odd):
    by_id = {r.doc_id: r for r in host_rules.host_rules(odd).collect()}
    assert by_id[5].n_words == by_id[4].n_words == 0 and by_id[5].base_failed and not by_id[4].kept
    assert by_id[7].n_words == 60_000
    out = host_rules.kept_documents(odd)
    assert out.columns == odd.columns
    assert {r[0] for r in out.collect()} <= {1, 2, 3, None, 7}


def test_tokens(odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    start, want = 0, Counter()
    rows = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    found = sorted(token_file.round_trip(odd, TOKENIZER).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [r[0] for r in rows]
    for r in found:
        assert r.start == start
        start += r.n_tokens
    for r in rows:
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4")
        want[r[0], len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == want


@pytest.mark.parametrize("name", ("quality", "toxicity"))
def test_scores(name, odd, items, labels, spark):
    for known in (labels, labels.limit(0)):
        rows = run(name, odd, items, known).collect()
        assert all(0 <= r.score <= 1 for r in rows)
        assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) for r in rows)
