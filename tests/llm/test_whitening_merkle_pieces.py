"""Whitening, Merkle manifest and SentencePiece table against brute force."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from growthloom.llm import catalog, merkle, piece_table, whitening
from growthloom.llm.common import read_table
from tests.llm.conftest import odd_rows

SF = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


# --- whitening ------------------------------------------------------------------


def test_bit_planes_give_exact_products():
    rng = np.random.default_rng(1)
    for low, high, rows in ((-300, 500, 5000), (0, 1, 100), (-(2**63), 2**63 - 1, 300)):
        x = rng.integers(low, high, (rows, 5), endpoint=True)
        x[:, 3] = 5  # constant: no planes
        slices = whitening.BitSlices(x.min(axis=0).tolist(), x.max(axis=0).tolist())
        for at in range(0, rows, slices.rows):
            slices.add(x[at : at + slices.rows])
        y = x.astype(object) - x.min(axis=0).astype(object)
        want = y.T @ y
        assert all(want[i, j] == v for i, j, v in slices.pairs())


def _plain(rows: list[tuple]) -> dict:
    """(id, component) -> values, by numpy over everything."""
    valid = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(256 * np.array([v for _, v in valid], float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh((n * (fit.T @ fit) - np.outer(sums, sums)) / n**2)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(4, len(values))
    white = (x - sums / n) @ vectors[:, :k] / np.sqrt(values[:k])
    return {(i, c + 1): (n, int(((n * y - sums) ** 2).sum()), w[c], values[c] / values.sum()) for (i, _), y, w in zip(valid, x, white) for c in range(k)}


def test_whitening_of_a_table(spark):
    want = _plain([(r.vec_id, r.embedding) for r in read_table(spark, SF, "embeddings").collect()])
    rows = catalog.op11_bit_sliced_whitening(spark, SF).collect()
    assert Counter((r.vec_id, r.component) for r in rows) == Counter(want.keys())
    sign = {}
    for r in rows:
        n, deviation, white, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained, rel=1e-9)
        sign.setdefault(r.component, np.sign(white * r.whitened))
        assert r.whitened == pytest.approx(sign[r.component] * white, abs=1e-9)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_whitening_of_odd_vectors(spark):
    rng = random.Random(2)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(3)], 1) for i in range(40)]
    bad = [(50, None, 1), (51, [1.0, None, 2.0], 1), (52, [1.0, float("nan"), 2.0], 1), (53, [float("inf"), 0.0, 0.0], 1), (54, [], 1), (55, [1.0, 2.0], 1)]
    rows = vectors + bad + [(None, [0.5, -0.5, 0.0], 1), (3, vectors[3][1], 1), (60, [-0.0, 0.0, -1e-9], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")
    kept = [(i, v) for i, v, _ in rows if (i, v) not in [(b[0], b[1]) for b in bad] and i != 52]
    want = _plain(kept)
    out = whitening.whitened(frame).collect()
    assert Counter((r.vec_id, r.component) for r in out) == Counter((i, c) for i, _ in kept for c in (1, 2, 3))
    for r in out:
        n, deviation, white, _ = want[r.vec_id, r.component]
        assert (r.n, int(r.deviation)) == (n, deviation) and abs(r.whitened) == pytest.approx(abs(white), abs=1e-9)


def test_whitening_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    out = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert {(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in out} == {(1, 0, None, None, None)} and len(out) == 4
    # Two vectors: one component has variance.
    out = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0])], schema)).collect()
    assert {(r.component, None if r.whitened is None else round(abs(r.whitened), 9)) for r in out} == {(1, 1.0), (2, None)}


def test_whitening_beyond_64_bits(spark):
    rows = [(i, [1e30 if i % 2 else -1e30, float(i)]) for i in range(8)]
    out = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    top = [2**63 - 1 if i % 2 else -(2**63) for i in range(8)]
    want = {i: (8 * top[i] - sum(top)) ** 2 + (8 * 256 * i - 256 * 28) ** 2 for i in range(8)}
    assert all((None if r.deviation is None else int(r.deviation)) == (want[r.vec_id] if want[r.vec_id] < 10**36 else None) for r in out)
    assert all(r.identity_error < 1e-4 for r in out)


# --- Merkle manifest ------------------------------------------------------------


def _hex(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(nodes: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    paths = [[] for _ in nodes]
    level = [(h, [i]) for i, h in enumerate(nodes)]
    while len(level) > 1:
        above = []
        for at in range(0, len(level), 8):
            run = level[at : at + 8]
            for k, (_, members) in enumerate(run):
                for i in members:
                    paths[i].append(([h for h, _ in run[:k]], [h for h, _ in run[k + 1 :]]))
            above.append((_hex(*[h for h, _ in run]), [i for _, m in run for i in m]))
        level = above
    return level[0][0], paths


def _manifest(rows: list[tuple]) -> list[tuple]:
    """Rows (doc_id, source, lang, n_chars, text), all in memory."""

    def leaf(*values) -> str:
        return _hex(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    trees: dict = {}
    for doc_id, source, lang, n_chars, text in rows:
        plain = leaf(doc_id, source, lang, n_chars, text)
        other = plain
        if zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 3 == 0 and text is not None:
            other = leaf(doc_id, source, lang, n_chars, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        trees.setdefault(lang, []).append((doc_id is not None, doc_id or 0, plain, other, doc_id))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {n: _tree([x[2] for x in sorted(trees[n], key=lambda x: x[:3])]) for n in names}
    root, tops = _tree([built[n][0] for n in names])
    out = []
    for name, top in zip(names, tops):
        for x, own in zip(sorted(trees[name], key=lambda x: x[:3]), built[name][1]):
            found = x[3]
            for before, after in own + top:
                found = _hex(*before, found, *after)
            out.append((x[4], x[2], built[name][0], root, _hex(*[h for b, a in own + top for h in b + a]), found, found == root))
    return out


def _rows(frame):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in frame.collect()]


def test_manifest_of_a_table(spark):
    got = catalog.op12_merkle_witnesses(spark, SF).collect()
    assert Counter(map(tuple, got)) == Counter(_manifest(_rows(read_table(spark, SF, "documents"))))
    assert 0 < sum(not r.verified for r in got) < len(got)


def test_manifest_of_odd_rows_and_small_blocks(odd, monkeypatch):
    want = Counter(_manifest([(r[0], r[3], r[2], r[4], r[1]) for r in odd_rows()]))
    assert Counter(map(tuple, merkle.manifest(odd).collect())) == want


@pytest.mark.parametrize("small", (0, 10_000))
def test_manifest_of_many_blocks_and_trees(spark, monkeypatch, small):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    monkeypatch.setattr(merkle, "SMALL_ROWS", small)
    rows = [(i, "s", None if i % 7 == 0 else "hot" if i % 3 else f"t{i % 80}", i, f"Text {i}") for i in range(700)] + [(5, "s", "hot", 5, "Text 5")] * 40
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert Counter(map(tuple, merkle.manifest(frame).collect())) == Counter(_manifest(rows))


def test_empty_manifest(nothing):
    assert merkle.manifest(nothing).count() == 0


def test_witnesses_grow_with_later_siblings():
    leaves = [bytes([i]) * 32 for i in range(70)]
    appender = merkle.Appender(3)
    nodes = [appender.append(leaf) for leaf in leaves]
    assert nodes[0].after == leaves[1:8] and nodes[7].before == leaves[:7] and nodes[69].after == []
    root = appender.close()
    for leaf, node in zip(leaves, nodes):
        path = merkle.witness(node)
        assert merkle.folded(leaf, path) == root and merkle.folded(leaves[0] + b"x", path) != root


# --- SentencePiece --------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=MODEL)


def test_chunks_give_the_library_s_ids(library):
    rng = random.Random(3)
    letters = " \n\t▁ab.,é中\U0001f389\0AZ̊1_ -​　ß\r"
    texts = ["", "\n", " \n", "\n ", "a\n\nb", " a  b \n\n c", "▁▁x", "a ▁b", "x " * 30, "<s> <unk> <0x0A>"] + ["".join(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(3000)]
    table = piece_table.PieceTable(MODEL)
    assert table.by_chunk
    ids, n = table.encode(texts)
    ends = np.cumsum(n)
    assert [ids[a:b].tolist() for a, b in zip(ends - n, ends)] == library.encode(texts)


def test_a_full_table_starts_afresh(library, monkeypatch):
    monkeypatch.setattr(piece_table, "LIMIT", 5)
    table = piece_table.PieceTable(MODEL)
    for text in ("one two three", "four five six seven", "one eight", "nine"):
        ids, n = table.encode([text, ""])
        assert ids.tolist() == library.encode(text) and n.tolist() == [len(ids), 0]


def test_a_table_of_many_chunks_stays_small(library):
    tracemalloc.start()
    try:
        table = piece_table.PieceTable(MODEL)
        for begin in range(0, 600_000, 20_000):
            table.encode([" ".join(f"w{n:x}" for n in range(begin, begin + 20_000))])
        held, _ = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert held < 40e6
    ids, _ = table.encode(["w0 w927bf w0"])
    assert ids.tolist() == library.encode("w0 w927bf w0")


def _digests(library, text: str | None) -> tuple:
    ids = library.encode(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_of_a_table(spark, library):
    want = Counter((r.doc_id, *_digests(library, r.text)) for r in read_table(spark, SF, "documents").collect())
    assert Counter(map(tuple, catalog.op13_piece_table(spark, SF).collect())) == want


def test_pieces_of_odd_rows(odd, nothing, library):
    want = Counter((r[0], *_digests(library, r[1])) for r in odd_rows())
    assert Counter(map(tuple, piece_table.round_trip(odd, MODEL).collect())) == want
    assert piece_table.round_trip(nothing, MODEL).count() == 0
