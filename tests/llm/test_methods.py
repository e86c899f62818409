"""The methods' parts, and the registered queries, against brute force or held-out labels."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from growthloom.llm import catalog, host_rules, latent_search, mixing, oracle, prob_minhash, secret_ledger, sharding, token_file, url_filter
from growthloom.llm.common import read_table
from tests.compare import compare, duck
from tests.conftest import SF_SMALL
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_subset_sum_against_all_subsets():
    rng = random.Random(1)
    for _ in range(60):
        sizes = sorted(rng.sample(range(1, 30), rng.randint(1, 4)))
        counts = [rng.randint(1, 4) for _ in sizes]
        budget = rng.randint(1, 90)
        sums = {0}
        for s, c in zip(sizes, counts):
            sums = {x + s * n for x in sums for n in range(c + 1)}
        take = mixing.subset_sum(sizes, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts))
        assert sum(t * s for t, s in zip(take, sizes)) == max(x for x in sums if x <= budget)


def test_fitting_beyond_the_program_s_limit(monkeypatch):
    monkeypatch.setattr(mixing, "DP_LIMIT", 50)
    sizes, counts = list(range(3, 400, 7)), [5] * 57
    for budget in (1, 49, 10_000, 31_111):
        take = mixing.fitted(sizes, counts, budget)
        assert 0 <= budget - sum(t * s for t, s in zip(take, sizes)) <= 3
        assert all(0 <= t <= c for t, c in zip(take, counts))


def test_mix_reaches_its_targets(spark):
    rows = catalog.op1_subset_sum_mix(spark, SF).collect()
    taken, target, size = defaultdict(int), {}, {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
        assert r.taken in (0, r["size"], 2 * r["size"])
    assert all(abs(taken[s] - target[s]) <= 3 for s in target)
    # Water filling, by hand.
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(size))}
    left, open_sources = 1.5 * sum(size.values()), set(size)
    while True:
        level = left / sum(weights[s] for s in open_sources)
        full = {s for s in open_sources if level * weights[s] > 2 * size[s]}
        if not full:
            break
        left -= sum(2 * size[s] for s in full)
        open_sources -= full
    for s in size:
        assert target[s] == pytest.approx(level * weights[s] if s in open_sources else 2 * size[s])


def test_targets_of_many_sources_without_a_window_over_all(spark):
    rng = random.Random(16)
    rows = [(f"s{n}" if n else None, int(rng.paretovariate(0.5)) % 100_000) for n in range(3000)]
    sources = spark.createDataFrame(rows, "source string, source_size long").repartition(7)
    for share, cap in ((1.5, 2), (1.9999, 2), (0.001, 2), (2, 2), (3, 2)):
        frame = mixing.source_targets(sources, share, cap)
        plan = frame._jdf.queryExecution().toString() + mixing.numbered(sources)._jdf.queryExecution().toString()
        assert "SinglePartition" not in plan
        got = {r.source: r.target for r in frame.collect()}
        order = sorted((s for s, _ in rows if s is not None)) + [None]
        weights, size = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}, dict(rows)
        left, level = share * sum(size.values()), 0.0
        open_weight = sum(weights.values())
        for s in sorted(size, key=lambda s: size[s] / weights[s]):
            level = max(level, left / open_weight)
            left, open_weight = left - cap * size[s], open_weight - weights[s]
        assert set(got) == set(size)
        assert all(got[s] == pytest.approx(min(cap * size[s], level * weights[s])) for s in size)
    assert mixing.source_targets(sources.limit(0)).count() == 0


def test_mix_ranges_of_a_crowded_length(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    docs = spark.range(400).selectExpr("id as doc_id", "concat('w', id, ' x y') as text", "if(id < 100, 'a', 'b') as source")
    rows = mixing.source_mix(docs).collect()
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
    assert all(abs(taken[r.source] - r.target) < 3 for r in rows)


def test_lcs():
    rng = random.Random(2)
    for _ in range(100):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert latent_search.lcs_length(latent_search._masks(a), len(a), b) == table[-1][-1]


def test_word_codes_do_not_depend_on_where_words_stand(monkeypatch):
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choices("abcdeXYZ\u00e9\u00fc19", k=rng.randint(1, 9))) for _ in range(rng.randint(0, 30))) for _ in range(50)]
    one = latent_search.WordCoder()
    each = [one.codes([t.encode()])[0].tolist() for t in texts]
    assert [c.tolist() for c in latent_search.WordCoder().codes([t.encode() for t in texts])] == each
    words = {}
    for t, c in zip(texts, each):
        for w, code in zip("".join(x.lower() if x < "\x80" else x for x in t).split(), c):
            assert words.setdefault(w, code) == code
    assert len(set(words.values())) == len(words)
    assert one.codes([b"It, is: (that) THE-end."])[0].tolist() == one.codes([b"it is that the end"])[0].tolist()
    monkeypatch.setattr(latent_search, "PIECE", 40)
    assert [c.tolist() for c in latent_search.WordCoder().codes([t.encode() for t in texts])] == each


def test_word_codes_without_case_and_marks_of_any_script():
    def codes(text):
        return latent_search.WordCoder().codes([text.encode()])[0].tolist()

    assert codes("\u00cates-vous L\u00c0 \u00c9t\u00c9") == codes("\u00eates vous l\u00e0 \u00e9t\u00e9")
    assert codes("\u201eGr\u00fc\u00dfe\u201c \u2013 \u00abSo\u00bb\u2026 \u00bfQu\u00e9?\u00a0ja\u2019s") == codes("gr\u00fc\u00dfe so qu\u00e9 ja s")
    assert codes("\u041c\u0418\u0420\u3002\u4e16\u754c\uff0c") == codes("\u043c\u0438\u0440 \u4e16\u754c")
    assert len(set(codes("\u00aa \u00b2 \u00bd \u00b5 x"))) == 5


def test_passages_cover_every_word():
    lengths = np.array([0, 1, 12, 13, 24, 25, 100])
    sums, whose, at = latent_search.passage_sums(np.ones((int(lengths.sum()), 1)), lengths)
    begin = np.cumsum(lengths) - lengths
    for t, n in enumerate(lengths):
        covered = np.zeros(n, bool)
        for s, a in zip(sums[whose == t, 0], at[whose == t] - begin[t]):
            assert s == min(latent_search.WINDOW, n - a)
            covered[a : a + latent_search.WINDOW] = True
        assert covered.all()


def test_latent_search_recall(spark):
    """Every document window is compared with every item window by brute force; then the search's own check."""
    docs = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    items = {r.item_id: r.text for r in read_table(spark, SF, "benchmark").collect()}

    def codes(text):
        return latent_search.WordCoder().codes([text.encode()])[0].tolist()

    coded = {i: codes(t) for i, t in items.items()}
    pairs = defaultdict(list)
    for i, words in coded.items():
        for j in range(len(words) - 2):
            pairs[tuple(words[j : j + 3])].append((i, j))
    want = set()
    for d, text in docs.items():
        words = np.array(codes(text), np.uint32)
        for j in range(len(words) - 2):
            for i, o in pairs.get(tuple(words[j : j + 3].tolist()), ()):
                if (d, i) not in want and latent_search.verdict(words, j, coded[i], o, max(0, len(coded[i]) - 5))[1]:
                    want.add((d, i))
    got = {(r.doc_id, r.item_id) for r in catalog.op2_latent_search(spark, SF).collect()}
    assert len(want) > 10
    assert len(got & want) >= 0.9 * len(want)
    # What the search has beside is still checked by subsequence; nothing clean is near the bounds.
    assert len(got - want) <= 0.02 * len(want)


def test_paraphrase_needs_its_answer(spark):
    rng = random.Random(4)
    vocabulary = [f"term{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=120)) for _ in range(60)]
    item = rng.sample(vocabulary, 30)
    kept = [w if n % 5 not in (1, 3) else "said" for n, w in enumerate(item)]
    with_answer = kept[:25] + item[25:]
    without = kept[:25] + ["never", "mind", "what", "it", "was"]
    texts += [" ".join(rng.choices(vocabulary, k=36) + body + rng.choices(vocabulary, k=20)) for body in (with_answer, without)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert latent_search.verdict(np.arange(40, dtype=np.uint32), 0, list(range(30)), 0, 25)[1]
    words = latent_search.WordCoder().codes([" ".join(item).encode()])[0].tolist()
    for body, leak in ((with_answer, True), (without, False)):
        found = latent_search.WordCoder().codes([" ".join(body).encode()])[0]
        share, verdict = latent_search.verdict(found, 0, words, 0, 25)
        assert (share < latent_search.LCS or verdict) and verdict == (leak or share >= latent_search.LCS)
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    assert {r.doc_id for r in latent_search.contaminated(docs, bench).collect()} <= {60, 61}


def _planted(rng: random.Random, words: list[str], answer: int, kept: list[int], others: list[str]) -> str:
    """An item inside a text, of whose words only ``kept`` (places) are as they were."""
    body = [w if j in set(kept) else rng.choice(others) for j, w in enumerate(words)]
    return " ".join([*rng.choices(others, k=rng.randint(30, 80)), *body, *rng.choices(others, k=rng.randint(30, 80))])


def _coded(text: str) -> np.ndarray:
    return latent_search.WordCoder().codes([text.encode()])[0]


def _benchmark(spark, path=SF) -> tuple[list[str], list[list[str]], list[int], list[str]]:
    """Texts of the items, their words, where their answers start; words of documents."""
    texts = [r.text for r in read_table(spark, path, "benchmark").collect()]
    words = [t.replace(",", " ").replace(".", " ").lower().split() for t in texts]
    others = " ".join(r.text or "" for r in read_table(spark, SF_SMALL, "documents").collect()).replace(",", " ").replace(".", " ").lower().split()
    return texts, words, [latent_search._answer_start(t, len(_coded(t))) for t in texts], others


def _accepted(text: str, item: str, answer: int) -> bool:
    """The verdict at any alignment."""
    words, wanted = _coded(text), _coded(item).tolist()
    offsets = range(max(1, len(wanted) - latent_search.WINDOW + 1))
    return any(latent_search.verdict(words, at, wanted, o, answer)[1] for at in range(len(words)) for o in offsets)


@pytest.mark.parametrize("kind", ["0.6 kept", "0.45 and the answer"])
def test_items_at_the_verdict_s_limits_are_found(spark, kind):
    rng = random.Random(11)
    texts, items, answers, others = _benchmark(spark)
    docs, want = [], set()
    for n in range(160):
        i = n % len(items)
        size = len(items[i])
        if kind == "0.6 kept":
            kept = rng.sample(range(size), -(-6 * size // 10))
        else:
            kept = [*range(answers[i], size), *rng.sample(range(answers[i]), max(0, -(-45 * size // 100) - (size - answers[i])))]
        docs.append((n, _planted(rng, items[i], answers[i], kept, others)))
        if _accepted(docs[-1][1], texts[i], answers[i]):
            want.add((n, i))
    found = latent_search.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(texts)), "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert len(want) > 100
    assert len(got & want) >= 0.9 * len(want)


def test_short_items_at_every_alignment(spark):
    rng = random.Random(12)
    _, items, _, others = _benchmark(spark)
    wanted = [rng.choices([w for x in items for w in x], k=n) for n in range(8, 31)]
    docs, want = [], set()
    for i, words in enumerate(wanted):
        for shift in range(12):
            docs.append((len(docs), " ".join([*rng.choices(others, k=36 + shift), *words, *rng.choices(others, k=50)])))
            want.add((len(docs) - 1, i))
    bench = [(i, " ".join(words)) for i, words in enumerate(wanted)]
    found = latent_search.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert len(got & want) >= 0.99 * len(want)


def test_bound_by_common_words_loses_nothing_that_the_verdict_accepts():
    """Paraphrases without their rarest words; the checks of many candidates at once against one by one."""
    rng = random.Random(13)
    vocabulary = [f"w{int(rng.paretovariate(0.4)) % 5000}" for _ in range(4000)]
    count = Counter(vocabulary)
    items, rows = [], []
    for n in [*range(8, 70, 3), 90]:
        words = rng.choices(vocabulary, k=n)
        answer = max(0, n - max(5, n // 4))
        items.append((_coded(" ".join(words)).tolist(), answer))
        common = sorted(range(answer), key=lambda j: -count[words[j]])
        for kept in ([*range(answer, n), *common[: max(0, -(-45 * n // 100) - (n - answer))]], sorted(range(n), key=lambda j: -count[words[j]])[: -(-6 * n // 10)], range(n), ()):
            rows.append(_coded(_planted(rng, words, answer, list(kept), vocabulary)))
    vocabulary, groups = latent_search.group_tables(items)
    texts = latent_search.Texts(rows, vocabulary)
    texts.group(*groups[0])
    cases = []
    for t, row in enumerate(rows):
        i = t // 4
        n = len(items[i][0])
        offsets = sorted({0, max(0, n - latent_search.WINDOW), max(0, n - latent_search.WINDOW) // 2})
        cases += [(t, i, at, o) for at in range(0, len(row), latent_search.GRID) for o in offsets]
    text, item, at, offset = np.array(cases).T
    n, answer = np.array([len(w) for w, _ in items])[item], np.array([a for _, a in items])[item]
    one = [latent_search.verdict(rows[t], a, items[i][0], o, items[i][1]) for t, i, a, o in cases]
    able = latent_search.possible(texts, n, answer, text, item, at, offset)
    share, leak = latent_search.verdicts(texts, items, n, answer, text, item, at, offset)
    assert share.tolist() == [s for s, _ in one] and leak.tolist() == [x for _, x in one]
    assert len({t for (t, *_), (_, x) in zip(cases, one) if x}) >= 0.7 * len(rows)
    assert able[leak].all() and not able.all()


def test_windows_that_are_not_asked_hold_nothing_that_the_verdict_accepts():
    """Every window and query that the verdict accepts is among those asked; most others aren't."""
    rng = random.Random(17)
    vocabulary = [f"w{int(rng.paretovariate(0.15)) % 3000}" for _ in range(4000)]
    items, rows = [], []
    for n in [*range(8, 66, 4), 90]:
        words = rng.choices(vocabulary, k=n)
        answer = max(0, n - max(5, n // 4))
        items.append((_coded(" ".join(words)), answer))
        for kept in (range(n), rng.sample(range(n), -(-6 * n // 10)), [*range(answer, n), *rng.sample(range(answer), max(0, -(-45 * n // 100) - (n - answer)))], ()):
            rows.append(_coded(_planted(rng, words, answer, list(kept), vocabulary)))
    rows += [np.concatenate([*rows[:8], rows[8][:37]]), rows[-2][3:], rows[0][:5]]
    space = np.random.default_rng(1).standard_normal((latent_search.FEATURES, 4), np.float32)
    wanted, order, known, groups, queries = latent_search.ItemBlock(items).ready(space)
    assert sorted(order) == list(range(len(items))) and len(groups) == 1
    texts = latent_search.Texts(rows, known)
    texts.group(*groups[0])
    n, answer = np.array([len(w) for w, _ in wanted]), np.array([a for _, a in wanted])
    owned = np.ones(len(texts.whose), bool)
    asked = set()
    for block, item, query in latent_search._asked(texts, latent_search._begins(texts, n, answer), queries[0], n, owned):
        asked |= set(zip(texts.whose[block].tolist(), texts.place[block].tolist(), item.tolist(), queries[0].offsets[query].tolist()))
    accepted, tried = set(), 0
    for t, row in enumerate(rows):
        for i, (words, start) in enumerate(wanted):
            offsets = queries[0].offsets[queries[0].first[i] : queries[0].first[i] + queries[0].many[i]].tolist()
            for at in range(0, len(row), latent_search.GRID):
                tried += len(offsets)
                accepted |= {(t, at, i, o) for o in offsets if latent_search.verdict(row, at, words, o, start)[1]}
    assert len({(t, i) for t, _, i, _ in accepted}) >= len(items)
    assert accepted <= asked and len(asked) < 0.5 * tried


def test_windows_that_can_hold_no_item_are_not_projected(monkeypatch):
    class Shared:
        def __init__(self, value):
            self.value = value

    rng = random.Random(18)
    item = _coded(" ".join(f"item{j}" for j in range(30)))
    clean = [_coded(" ".join(rng.choices([f"other{j}" for j in range(500)], k=400))) for _ in range(40)]
    leaking = np.concatenate([clean[0], item, clean[1]])
    batch = pa.RecordBatch.from_arrays([pa.array(range(41)), pa.array([b"k"] * 41), pa.array([c.tobytes() for c in [*clean, leaking]], pa.binary())], names=["id", "k", "words"])
    space = np.random.default_rng(1).standard_normal((latent_search.FEATURES, latent_search.RANK), np.float32)
    projected = []
    windows = latent_search.grid_windows
    monkeypatch.setattr(latent_search, "grid_windows", lambda blocks, whose: projected.append(len(blocks)) or windows(blocks, whose))
    found = [r for b in latent_search._searched(Shared(space), Shared(latent_search.ItemBlock([(item, 25)])))(iter([batch])) for r in b.to_pylist()]
    assert [(r["id"], r["item"], r["position"], r["lcs"]) for r in found] == [(40, 0, 400, 1.0)]
    assert sum(projected) < 100


class _Shared:
    def __init__(self, value):
        self.value = value


def _search(space, items, rows):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array([b"k"] * len(rows)), pa.array([c.tobytes() for c in rows], pa.binary())], names=["id", "k", "words"])
    return [tuple(r.values()) for b in latent_search._searched(_Shared(space), _Shared(latent_search.ItemBlock(items)))(iter([batch])) for r in b.to_pylist()]


def test_every_window_is_projected_and_compared_with_every_query(monkeypatch):
    """Whether or not the words around could hold an item. (That only candidates are projected a second time,
    for their own cosine, is what test_windows_that_can_hold_no_item_are_not_projected holds.)"""
    rng = random.Random(19)
    items = [(_coded(" ".join(f"item{i}x{j}" for j in range(n))), n - 5) for i, n in enumerate((14, 19, 30, 43, 90))]
    rows = [_coded(" ".join(rng.choices([f"other{j}" for j in range(500)], k=n))) for n in (1, 3, 25, 400, 1201)] + [items[2][0]]
    space = np.random.default_rng(1).standard_normal((latent_search.FEATURES, latent_search.RANK), np.float32)
    compared = []
    near = latent_search.Queries.near

    def spy(queries, unit, first, end):
        found = near(queries, unit, first, end)
        windows = {k: len(u) for k, u in unit.items()}
        assert len(set(windows.values())) == 1 and found.shape == (windows[6], end - first)
        compared.append(found.size)
        return found

    monkeypatch.setattr(latent_search.Queries, "near", spy)
    whole = _search(space, items, rows)
    assert [(r[0], r[2]) for r in whole] == [(5, 2)]
    windows, queries = sum(-(-len(r) // latent_search.GRID) for r in rows), sum(len(latent_search.item_windows(w)[1]) for w, _ in items)
    assert sum(compared) == windows * queries
    compared.clear()
    monkeypatch.setattr(latent_search, "COMPARED", windows * 3)
    assert _search(space, items, rows) == whole
    assert sum(compared) == windows * queries and len(compared) == -(-queries // 3)


def test_windows_near_queries_against_one_by_one(monkeypatch):
    rng = random.Random(20)
    vocabulary = [f"w{int(rng.paretovariate(0.4)) % 900}" for _ in range(2000)]
    items = [_coded(" ".join(rng.choices(vocabulary, k=n))) for n in (2, 6, 10, 14, 19, 24, 27, 44, 70)]
    rows = [_coded(" ".join(rng.choices(vocabulary, k=n))) for n in (1, 4, 5, 23, 24, 25, 150)]
    space = np.random.default_rng(2).standard_normal((latent_search.FEATURES, 6), np.float32)
    queries, texts = latent_search.Queries(items, space), latent_search.Texts(rows, np.unique(np.concatenate(items)))
    unit = texts.projected(space, set(queries.blocks.tolist()))
    monkeypatch.setattr(latent_search, "TILE", (7, 3))
    found = queries.near(unit, 0, len(queries.item))
    for b, (t, at) in enumerate(zip(texts.whose, texts.place)):
        for q, i in enumerate(queries.item):
            window = rows[t][at : at + queries.blocks[i] * latent_search.GRID]
            v = space[window & np.uint32(latent_search.FEATURES - 1)].sum(axis=0)
            cosine = float(v @ queries.vectors[q]) / float(np.sqrt(v @ v))
            bound = float(latent_search.bound_of(queries.blocks[i]))
            assert found[b, q] or cosine < bound
            assert not found[b, q] or cosine > bound - 2 * latent_search.ROUNDED
    assert 0 < found.sum() < found.size


def test_a_paraphrase_with_its_answer_is_found(spark):
    """The rows of test_paraphrase_needs_its_answer, by what must be found."""
    rng = random.Random(4)
    vocabulary = [f"term{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=120)) for _ in range(60)]
    item = rng.sample(vocabulary, 30)
    kept = [w if n % 5 not in (1, 3) else "said" for n, w in enumerate(item)]
    bodies = (kept[:25] + item[25:], [w if n % 3 == 0 else "said" for n, w in enumerate(item[:25])] + ["never", "mind", "what", "it", "was"])
    texts += [" ".join(rng.choices(vocabulary, k=36) + body + rng.choices(vocabulary, k=20)) for body in bodies]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    assert {r.doc_id for r in latent_search.contaminated(docs, bench).collect()} == {60}


def test_recall_of_verbatim_edited_and_paraphrased_items(spark):
    """Against the verdict at every alignment, over all planted documents and their items."""
    rng = random.Random(14)
    texts, items, answers, others = _benchmark(spark)
    docs, want = [], defaultdict(set)
    for n in range(200):
        i, kind = n % len(items), ("verbatim", "0.8", "0.7", "0.6", "paraphrase")[n % 5 if n < 100 else n // 7 % 5]
        size, answer = len(items[i]), answers[i]
        share = {"verbatim": 1.0, "paraphrase": 0.5}.get(kind) or float(kind)
        tail = list(range(answer, size)) if kind == "paraphrase" else []
        left = [j for j in range(size) if j not in set(tail)]
        kept = tail + rng.sample(left, min(len(left), max(0, int(np.ceil(share * size)) - len(tail))))
        docs.append((n, _planted(rng, items[i], answer, kept, others)))
        if _accepted(docs[-1][1], texts[i], answer):
            want[kind].add((n, i))
    found = latent_search.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(texts)), "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    for kind, pairs in want.items():
        assert len(pairs) > 10 and len(got & pairs) >= 0.9 * len(pairs), kind


def test_url_verdicts_against_brute_force(spark):
    urls = [r.url for r in read_table(spark, SF_SMALL, "pages").collect()] + [None, "", "http://", "nothing", "HTTP://WWW.Example.COM", "x://a.example.com/en/1?x#y", "x://com/", "x://example.com", "x://badcom/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.url_verdicts(pages).collect()}
    assert got == dict(enumerate(brute.url_verdicts(urls, url_filter.RULES)))


def test_secret_rules_against_brute_force(spark):
    rng = random.Random(3)
    pieces = ["token", "=", " ", ":", '"', "AKIA", "ABCDEFGHIJKLMNOP", "deadbeef", "0123456789abcdef", "secret", "api_key", "APIKEY", "\u00e9", "\U0001f600", "\n", "x1", "abc"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 60))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in secret_ledger.secrets(docs).collect()}
    assert got == {i: brute.secret_row(t) for i, t in enumerate(texts)}


def test_ledger_scans_only_what_is_new(spark):
    first = spark.createDataFrame([(1, "token = abcdef99"), (2, "token = abcdef99"), (3, "plain")], "doc_id long, text string")
    paths, scanned, findings = secret_ledger.update_ledger(first)
    assert scanned.select("blob").distinct().count() == 2
    second = first.unionByName(spark.createDataFrame([(4, "AKIA" + "A" * 16), (5, "plain")], "doc_id long, text string"))
    paths, more, findings = secret_ledger.update_ledger(second, scanned, findings)
    assert more.select("blob").distinct().count() == 1
    rows = {r.doc_id: r for r in secret_ledger.findings_by_path(paths, findings).collect()}
    assert [rows[i].n_assign for i in range(1, 6)] == [1, 1, 0, 0, 0] and rows[4].n_access == 1
    # A new version of one rule is due for every blob, and its old findings go.
    newer = tuple(secret_ledger.Rule("hex", r"[0-9a-f]+", 0, 6, version=2) if r.kind == "hex" else r for r in secret_ledger.RULES)
    paths, third, findings = secret_ledger.update_ledger(second, scanned.unionByName(more), findings, rules=newer)
    assert {(r.kind, r.version) for r in third.select("kind", "version").distinct().collect()} == {("hex", 2)}
    assert {r.doc_id: r.n_hex for r in secret_ledger.findings_by_path(paths, findings, newer).collect()}[1] == 1


@pytest.mark.parametrize("limit", [1_000, 20_000, 200_000])
def test_shards_against_sql(spark, limit):
    con = duck(SF_SMALL)
    docs = read_table(spark, SF_SMALL, "documents")
    got = Counter(tuple(r) for r in sharding.shards(docs, limit=limit).select("doc_id", "shard", "depth", "shard_bytes", "shard_docs").collect())
    assert got == Counter(con.sql(oracle.op6(limit)).fetchall())


def test_sketches_estimate_probability_jaccard():
    rng = np.random.default_rng(5)
    universe = rng.integers(1, 1 << 63, 400).astype(np.uint64)
    a, b = np.sort(universe[:300]), np.sort(universe[60:])
    wa, wb = rng.uniform(0.5, 3, 300), rng.uniform(0.5, 3, 340)
    estimates = []
    for salt in range(40):
        x, y = a ^ np.uint64(salt * 7919), b ^ np.uint64(salt * 7919)
        both = prob_minhash.sketches(np.concatenate([x, y]), np.concatenate([wa, wb]), np.repeat([0, 1], [300, 340]), 2)
        estimates.append((both[0] == both[1]).mean())
    va, vb = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
    every = set(va) | set(vb)
    exact = sum(1 / sum(max(va.get(e, 0) / va[d], vb.get(e, 0) / vb[d]) for e in every) for d in set(va) & set(vb))
    assert abs(np.mean(estimates) - exact) < 0.02


def test_classes_of_near_copies(spark):
    """A crowd of near copies beside a crowd that only shares a passage."""
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(4000)]
    base = rng.choices(vocabulary, k=200)
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for _ in range(80):
        words = list(base)
        for _ in range(rng.randint(0, 8)):
            words[rng.randrange(200)] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    for _ in range(120):
        texts.append(" ".join(rng.choices(vocabulary, k=rng.randint(6, 40)) + passage + rng.choices(vocabulary, k=rng.randint(0, 5))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.class_id for r in prob_minhash.near_duplicates(docs).orderBy("doc_id").collect()]
    assert got == brute.duplicate_classes(texts)


def test_blocks_of_a_bucket_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(prob_minhash, "BLOCK", 3)
    rng = random.Random(10)
    vocabulary = [f"v{i}" for i in range(3000)]
    base = rng.choices(vocabulary, k=160)
    texts = []
    for _ in range(70):  # near and below the bound, so that no text is similar to all
        words = list(base)
        for _ in range(rng.randint(0, 14)):
            words[rng.randrange(160)] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.class_id for r in prob_minhash.near_duplicates(docs).orderBy("doc_id").collect()]
    assert got == brute.duplicate_classes(texts)


def test_texts_of_unequal_repetition(spark, monkeypatch):
    """One of each pair repeats a passage: the classes are by distinct shingles, however often they occur."""
    monkeypatch.setattr(prob_minhash, "BLOCK", 7)
    rng = random.Random(15)
    vocabulary = [f"v{i}" for i in range(5000)]
    texts = []
    for n in range(60):
        base = rng.choices(vocabulary, k=400)
        size, times, edits = ((200, 20, 0), (200, 50, 0), (133, 5, 6), (200, 10, 6))[n % 4]
        other = base[:size] * times + base[size:]
        for _ in range(edits):
            other[rng.randrange(size * times, len(other))] = rng.choice(vocabulary)
        texts += [" ".join(base), " ".join(other), " ".join(other[:-1])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.class_id for r in prob_minhash.near_duplicates(docs).orderBy("doc_id").collect()]
    want = brute.duplicate_classes(texts)
    assert len(set(want)) < 70
    assert got == want


def test_random_access_without_decoding():
    rng = np.random.default_rng(7)
    ids = np.concatenate([rng.integers(0, 300, 3000), rng.integers(0, 1 << 32, 500), [0, 255, 256, 65535, 65536, (1 << 32) - 1]]).astype(np.uint32)
    rng.shuffle(ids)
    segment = token_file.Segment(token_file.encode_segment(np.array([5, 6]), np.array([10, len(ids) - 10]), ids))
    assert [segment.token(i) for i in range(len(ids))] == ids.tolist()
    for _ in range(50):
        a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
        assert segment.tokens(a, b).tolist() == ids[a:b].tolist()
    empty = token_file.Segment(token_file.encode_segment(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)))
    assert empty.tokens(0, 0).tolist() == []


def _auc(scores, labels):
    order = np.argsort(np.argsort(scores))
    good = np.array(labels) == 1
    return (order[good].sum() - good.sum() * (good.sum() - 1) / 2) / (good.sum() * (~good).sum())


@pytest.mark.parametrize("name,label,least", [("op5_factor_quality", "quality", 0.97), ("op10_boosted_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    known = {r.doc_id: r[label] for r in read_table(spark, SF, "labels").collect()}
    rows = [r for r in catalog.queries()[name](spark, SF).collect() if r.held_out and r.doc_id in known]
    assert _auc([r.score for r in rows], [known[r.doc_id] for r in rows]) >= least


def test_scores_by_the_sum_of_squares_identity():
    from growthloom.llm.factor_quality import FactorisationMachine

    fm, rng = FactorisationMachine(), np.random.default_rng(8)
    index, value = np.array([3, 17, 40, 99]), rng.normal(size=4)
    fm.w[index] = rng.normal(size=4)
    direct = fm.w0 + (fm.w[index] * value).sum() + sum(fm.v[index[i]] @ fm.v[index[j]] * value[i] * value[j] for i in range(4) for j in range(i))
    assert fm.sums(index, value, np.zeros(1, np.int64))[0][0] == pytest.approx(direct, rel=1e-4)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SF_SMALL), name, catalog.queries()[name], oracle.oracle_sql()[name], SF_SMALL)
    assert r["cols_equal"] and r["types_equal"] and r["exact"], r


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF_SMALL)
    rows = out.collect()
    con = duckdb.connect()
    docs = {r[0]: r[1] for r in con.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall()}
    assert {r.doc_id for r in rows} <= set(docs) and all(docs[r.doc_id] == r.text for r in rows)
    assert max(Counter(r.doc_id for r in rows).values()) <= 2
    kept = sorted({r.doc_id for r in rows})
    assert len(set(brute.duplicate_classes([docs[i] for i in kept]))) == len(kept)
    assert all(len(docs[i].split()) >= 50 for i in kept)
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5


def _lines(repeated: int) -> str:
    """A text of about 300 words whose line ``x`` occurs ``repeated`` times after the first."""
    fresh = [" ".join(f"w{repeated}x{i}y{j}" for j in range(6)) for i in range(50)]
    return "\n".join(line + ("\nx" if i <= repeated else "") for i, line in enumerate(fresh))


@pytest.mark.parametrize("few", (10_000, 0))
def test_hosts_decide_on_documents_close_to_a_limit(spark, monkeypatch, few):
    """One text near the limit and one over it, under a strict host, a trusted one and a plain one."""
    monkeypatch.setattr(host_rules, "FEW_HOSTS", few)
    clean, near, over, far = (_lines(r) for r in (0, 12, 20, 40))
    rows = []
    for host, failing in (("strict", 300), ("trusted", 2), ("plain", 60), (None, 60)):
        rows += [(host, over)] * failing + [(host, clean)] * (600 - failing)
    rows += [(f"small{i % 30}", clean) for i in range(600)]
    probes = {(h, k): len(rows) + n for n, (h, k) in enumerate((h, k) for h in ("strict", "trusted", "plain", None, "small1") for k in ("clean", "near", "over", "far"))}
    rows += [(h, {"clean": clean, "near": near, "over": over, "far": far}[k]) for h, k in probes]
    docs = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in host_rules.host_rules(docs).collect()}
    got = {p: kept[i] for p, i in probes.items()}
    for h in ("strict", "trusted", "plain", None, "small1"):
        assert got[h, "clean"] and not got[h, "far"]
    assert [got[h, "near"] for h in ("strict", "trusted", "plain", None, "small1")] == [False, True, True, True, True]
    assert [got[h, "over"] for h in ("strict", "trusted", "plain", None, "small1")] == [False, True, False, False, False]
    assert Counter(r.doc_id for r in host_rules.kept_documents(docs).collect()) == Counter(i for i, k in kept.items() if k)


def test_null_and_odd_hosts_stay_apart(spark):
    docs = spark.createDataFrame([(i, "a", h) for i, h in enumerate([None, "-", "", "=", "\x00\x01"])], "doc_id long, text string, source string")
    assert host_rules.host_rules(docs).count() == 5
    measures = host_rules.measured(docs, "text", ("doc_id", "source"))
    assert host_rules.host_rates(measures).count() == 5


def test_secret_patterns_stand_hostile_texts(spark):
    texts = ["-----BEGIN " + "A " * 20_000, "-----BEGIN " + "AB" * 20_000, "eyJ" * 20_000, "password" + " " * 30_000, "xoxb-" + "a" * 30_000, "-----BEGIN RSA PRIVATE KEY-----"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = Counter((i, *brute.secret_row(t)) for i, t in enumerate(texts))
    assert Counter(tuple(r) for r in secret_ledger.secrets(docs).collect()) == want


def test_mixing_tells_rows_apart_by_all_columns(spark):
    """Values that differ only in where the null is are rows of their own."""
    rows = [(1, "a b c", None, "en"), (1, "a b c", "en", None), (2, "d e f", "en", "en"), (2, "d e f", "ene", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    taken = Counter(tuple(r) for r in mixing.mixed_documents(docs).collect())
    assert set(taken) <= set(rows) and max(taken.values()) <= 2
    sources = Counter(r[2] for r in taken.elements())
    mixed = {r.source: r.taken for r in mixing.source_mix(docs).groupBy("source").agg({"taken": "sum"}).withColumnRenamed("sum(taken)", "taken").collect()}
    assert {s: 3 * n for s, n in sources.items()} == {s: t for s, t in mixed.items() if t}


def test_a_letter_composed_in_one_case_only():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["J̌", "H̱x", "T̈ The", "W̊", "Y̊Z", "THE J̌E H̱ cafÉ Café CAFÉ, (Y̊)."]
    got = token_file.CachedTokenizer(path).encode([t.encode() for t in texts])
    library = Tokenizer.from_file(path)
    assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_least_text_of_an_id_is_learnt_from(spark):
    from growthloom.llm.labels import training_rows

    docs = spark.createDataFrame([(1, t, 0) for t in ("zzz", "aaa", "mmm", "aaa")] + [(2, None, 1), (2, "x", 1)], "doc_id long, text string, n long")
    known = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    rows = training_rows(docs.repartition(5), known, "quality", ("text",), 10).collect()
    assert {(r.id, r.label, r.text) for r in rows} == {(1, 1, "aaa"), (2, 0, None)} & {(r.id, r.label, r.text) for r in rows} and len(rows) >= 1


def test_urls_without_a_class_to_learn_from_are_allowed(spark):
    """Blocked URLs in the held-out fifth alone: nothing to learn from."""
    held, learnt = [], []
    for i in range(200):
        s = f"a{i}.net/es/x"
        (held if int(__import__("hashlib").md5(s.encode()).hexdigest()[:4], 16) % 5 == 0 else learnt).append(s)
    urls = [f"http://{s}" for s in held] + [f"http://b{i}.com/y" for i in range(40)] + [f"http://c{i}.org/z" for i in range(20)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_filter.url_verdicts(pages).collect()
    assert {r.verdict for r in rows if r.rule is None} == {"allow"}
    assert Counter((r.host, r.path, r.rule, r.verdict) for r in rows) == Counter(brute.url_verdicts(urls, url_filter.RULES))


def test_long_texts_in_parts_give_the_same_leaks(spark, monkeypatch):
    rng = random.Random(21)
    texts, items, answers, others = _benchmark(spark)
    body = rng.choices(others, k=30_000)
    for n, at in enumerate(range(400, 29_000, 700)):
        i = n % len(items)
        body[at : at + len(items[i])] = [w if rng.random() < 0.8 else rng.choice(others) for w in items[i]]
    docs = spark.createDataFrame([(0, " ".join(body)), (1, " ".join(body[:500])), (2, "")], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    whole = {tuple(r) for r in latent_search.contaminated(docs, bench).collect()}
    monkeypatch.setattr(latent_search, "TOGETHER", 1200)
    parts = {tuple(r) for r in latent_search.contaminated(docs, bench).collect()}
    assert len(whole) > 10
    assert {(d, i, round(lcs, 9), at) for d, i, _, lcs, at in parts} == {(d, i, round(lcs, 9), at) for d, i, _, lcs, at in whole}


def test_passages_of_parts_are_those_of_whole_texts(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    for length in (0, 5, 12, 13, 120, 121, 125, 132, 133, 240, 245, 600, 607):
        words = rng.integers(1, 1 << 31, length).astype(np.uint32)
        batch = pa.RecordBatch.from_arrays([pa.array([words.tobytes()], pa.binary())], names=["words"])
        monkeypatch.setattr(latent_search, "TOGETHER", 60)
        found = []
        for texts in latent_search._passage_parts([batch]):
            for t in texts:
                _, _, at = latent_search.passage_sums(np.zeros((len(t), 1)), np.array([len(t)])) if len(t) else ([], [], [])
                found += [tuple(t[a : a + latent_search.WINDOW]) for a in at]
        _, _, at = latent_search.passage_sums(np.zeros((length, 1)), np.array([length])) if length else ([], [], [])
        assert Counter(found) == Counter(tuple(words[a : a + latent_search.WINDOW]) for a in at)


def test_orthonormal_bases():
    rng = np.random.default_rng(6)
    tall = (rng.standard_normal((5000, 20)) * np.logspace(0, 4, 20)).astype(np.float32)
    basis = latent_search.orthonormal(tall).astype(np.float64)
    assert np.abs(basis.T @ basis - np.eye(20)).max() < 1e-4
    assert np.abs(tall - basis @ (basis.T @ tall)).max() < 1e-2 * np.abs(tall).max()
    assert not latent_search.orthonormal(np.zeros((100, 4), np.float32)).any()


def test_sketching_many_words_stays_small():
    texts = [" ".join(f"w{n:x}" for n in range(begin, begin + 1000)) for begin in range(0, 350_000, 1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([t.encode() for t in texts], pa.binary()), pa.array(texts)], names=["id", "k", "text"])
    tracemalloc.start()
    try:
        before, _ = tracemalloc.get_traced_memory()
        held = [tracemalloc.get_traced_memory()[0] - before for _ in prob_minhash._sketched(iter([batch]))]
    finally:
        tracemalloc.stop()
    assert max(held) < 40e6
