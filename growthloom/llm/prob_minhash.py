"""Near-duplicate documents by ProbMinHash sketches, banding and verification.

Shingles are runs of five words (a shorter text is one shingle), weighted
1 + ln(count). A sketch estimates the probability Jaccard similarity of two
weighted sets: each shingle is a Poisson process whose rate is its weight, its
arrivals visit the sketch's components in an order of its own, and each
component keeps the first shingle to arrive. An arrival later than the latest
of all components can change nothing, so a shingle's process ends there. Two
documents agree in a component with probability J_p. Where one text repeats a
passage more often than another, J_p lies far below the Jaccard similarity J
that decides; so each text also has a sketch with all weights 1 (the same
processes, the same sketch if no shingle repeats), whose components agree with
probability J.

``BANDS`` bands of ``ROWS`` components of either sketch make buckets. At J = 0.8
the sketches without weights share no bucket with probability
(1 - 0.8^5)^25 = 5e-5, whatever is repeated; the weighted ones add buckets. Then

1. every distinct text of a bucket is paired with the bucket's most central
   text (whose buckets hold most texts), the sketches without weights discard pairs whose
   estimate of J is below ``FLOOR`` (over four standard deviations under 0.8), and
   the Jaccard similarity of the whole shingle sets decides;
2. linked texts form components; what a bucket still holds apart, of lengths
   that allow the similarity, is then compared the same way, block by block
   inside tasks that return only links which join components. So every pair
   that shares a bucket is decided, without rows for all pairs of a group.

Copies are folded first (texts by MD5), so a group of copies is one node.

Nulls and empty texts have no shingles: each such document is its own class.
A null id passes through; a class is named by its least id that isn't null
(null if there is none). Repeated rows are copies and keep a row each. Other
columns don't matter. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthloom.llm.common import Vocabulary, mixed, picked, positional, restored, scratch_table, shingle_hashes, text_bytes
from growthloom.llm.components import connected_components

WIDTH, BANDS, ROWS = 5, 25, 5
#: Components: a prime, so that i -> a * i + b visits each of them once; the last two are unused.
SIZE = 127
FLOOR = 0.65
#: More than any bucket.
LAST = np.iinfo(np.int64).max
#: Rows of a bucket that a task compares with as many others.
BLOCK = 1_000
#: Shingles that are sketched together, to bound a task's memory.
TOGETHER = 400_000
#: Words whose hashes a task keeps.
WORDS = 100_000


def weighted_shingles(hashes: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of a text and their counts."""
    found = np.sort(shingle_hashes(hashes, width))
    if len(found) == 0:
        return found, np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    return found[starts], np.diff(np.append(starts, len(found)))


def sketches(shingles: np.ndarray, weights: np.ndarray, owner: np.ndarray, n_owners: int) -> np.ndarray:
    """ProbMinHash of ``n_owners`` weighted sets at once: (n_owners, SIZE) of shingle hashes (0: empty set).

    ``owner`` says whose each shingle is. Time and component of a shingle's
    i-th arrival depend on its hash alone, so sets can be compared.
    """
    first = np.full(n_owners * SIZE, np.inf)
    kept = np.zeros(n_owners * SIZE, np.uint64)
    with np.errstate(over="ignore"):
        seed = mixed(shingles)
        step = (seed % np.uint64(SIZE - 1)).astype(np.int64) + 1
        place = ((seed >> np.uint64(32)) % np.uint64(SIZE)).astype(np.int64)
        time = np.zeros(len(shingles))
        for i in range(SIZE):
            u = ((mixed(seed + np.uint64(i + 1) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            # The next component not visited yet is due at the rate of those left.
            time = time - np.log(u) * (SIZE / (SIZE - i)) / weights
            cell = owner * SIZE + place
            early = time < first[cell]
            if early.any():
                cells, times = cell[early], time[early]
                np.minimum.at(first, cells, times)
                won = times == first[cells]
                kept[cells[won]] = shingles[early][won]
            last = first.reshape(n_owners, SIZE).max(axis=1)
            alive = time < last[owner]
            if not alive.any():
                break
            shingles, weights, owner, seed, step, place, time = (x[alive] for x in (shingles, weights, owner, seed, step, place, time))
            place = (place + step) % SIZE
    return kept.reshape(n_owners, SIZE)


def both_sketches(shingles: np.ndarray, counts: np.ndarray, owner: np.ndarray, n_owners: int) -> tuple[np.ndarray, np.ndarray]:
    """The sketches without weights and with weights 1 + ln(count); alike for sets in which nothing repeats."""
    plain = sketches(shingles, np.ones(len(shingles)), owner, n_owners)
    repeats = np.zeros(n_owners, bool)
    repeats[owner[counts > 1]] = True
    weighted = plain.copy()
    if repeats.any():
        mine = repeats[owner]
        weighted[repeats] = sketches(shingles[mine], 1.0 + np.log(counts[mine]), (np.cumsum(repeats) - 1)[owner[mine]], int(repeats.sum()))
    return plain, weighted


def band_keys(kept: np.ndarray) -> np.ndarray:
    """(n, BANDS): the bucket of each band of sketches."""
    with np.errstate(over="ignore"):
        rows = kept[:, : BANDS * ROWS].reshape(len(kept), BANDS, ROWS)
        bands = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(kept), BANDS)).copy()
        for j in range(ROWS):
            bands = mixed(bands * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, j])
    return bands.view(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, k, text) -> (id, k, n shingles, sketch without weights of one byte a component, bucket
    keys of the sketch without weights, then of the weighted one)."""
    vocabulary = Vocabulary(limit=WORDS)
    for batch in batches:
        ids, keys = batch.column(0), batch.column(1)
        begin, sets, total = 0, [], 0

        def flush(end: int) -> pa.RecordBatch:
            counts = np.array([len(s) for s, _ in sets], np.int64)
            owner = np.repeat(np.arange(len(sets)), counts)
            flat = np.concatenate([s for s, _ in sets]) if sets else np.zeros(0, np.uint64)
            many = np.concatenate([c for _, c in sets]) if sets else np.zeros(0, np.int64)
            plain, weighted = both_sketches(flat, many, owner, len(sets))
            bands = np.concatenate([band_keys(plain), band_keys(weighted)], axis=1)
            short = (mixed(plain) & np.uint64(255)).astype(np.uint8)
            offsets = np.arange(0, (len(sets) + 1) * 2 * BANDS, 2 * BANDS, dtype=np.int32)
            return pa.RecordBatch.from_arrays(
                [
                    ids.slice(begin, end - begin),
                    keys.slice(begin, end - begin),
                    pa.array(counts),
                    pa.array([x.tobytes() for x in short], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.reshape(-1))),
                ],
                names=["id", "k", "n", "sketch", "bands"],
            )

        for row, text in enumerate(text_bytes(batch.column(2))):
            vocabulary.trim()
            sets.append(weighted_shingles(vocabulary.hashed(text.split())))
            total += len(sets[-1][0])
            if total >= TOGETHER:
                yield flush(row + 1)
                begin, sets, total = row + 1, [], 0
        yield flush(batch.num_rows)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches agree in FLOOR of the components."""
    # Bytes of different shingles are equal by chance once in 256.
    least = (FLOOR + (1 - FLOOR) / 256) * SIZE
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SIZE) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array((a == b).sum(axis=1) >= least))


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary = Vocabulary(limit=WORDS)
    for batch in batches:
        keys, out, size, begin = batch.column(0), [], 0, 0
        for row, text in enumerate(text_bytes(batch.column(1))):
            vocabulary.trim()
            out.append(weighted_shingles(vocabulary.hashed(text.split()))[0].tobytes())
            size += len(out[-1])
            if size > 8_000_000:
                yield pa.RecordBatch.from_arrays([keys.slice(begin, row + 1 - begin), pa.array(out, pa.binary())], names=["k", "shingles"])
                begin, out, size = row + 1, [], 0
        yield pa.RecordBatch.from_arrays([keys.slice(begin, batch.num_rows - begin), pa.array(out, pa.binary())], names=["k", "shingles"])


def _similar(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                verdicts.append(common >= threshold * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(verdicts, pa.bool_()))

    return run


def _shingles_of(needed: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(k, shingles): the sorted distinct shingles of the texts ``needed`` (k), in the shared folder."""
    # One row of each text is enough: the one that stands for its copies.
    whose = nodes.select("k", "id").join(needed, "k")
    chosen = texts.join(whose, (texts["k"] == whose["k"]) & texts["id"].eqNullSafe(whose["id"]), "left_semi")
    return scratch_table(chosen.select("k", "text").mapInArrow(_shingle_sets, "k binary, shingles binary").dropDuplicates(["k"]), "shingles")


def _verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs`` (a, b) that are linked, written to the shared folder."""
    k = "binary"
    sk = nodes.select("k", "sketch")
    likely = scratch_table(
        pairs.join(sk.select(F.col("k").alias("a"), F.col("sketch").alias("sa")), "a")
        .join(sk.select(F.col("k").alias("b"), F.col("sketch").alias("sb")), "b")
        .select("a", "b", "sa", "sb")
        .mapInArrow(_likely, f"a {k}, b {k}"),
        "likely",
    )
    sets = _shingles_of(likely.select(F.col("a").alias("k")).unionByName(likely.select(F.col("b").alias("k"))).distinct(), texts, nodes)
    return scratch_table(
        likely.join(sets.select(F.col("k").alias("b"), F.col("shingles").alias("tb")), "b")
        .join(sets.select(F.col("k").alias("a"), F.col("shingles").alias("ta")), "a")
        .select("a", "b", "ta", "tb")
        .mapInArrow(_similar(threshold), f"a {k}, b {k}"),
        "verified",
    )


def _differing(placed: DataFrame) -> DataFrame:
    """Rows (key, k, n, label) of keys that hold several labels, with ``main`` (the
    label of the key's largest component), ``blocks`` (into which the key is cut)
    and ``out_blocks`` (into which its rows outside the main component are)."""
    several = (
        placed.groupBy("key")
        .agg(F.max(F.struct("size", "label")).alias("main"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("rows"))
        .where("lo != hi")
        .select("key", F.col("main.label").alias("main"), F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    )
    rows = scratch_table(placed.join(several, "key").select("key", "k", "n", "label", "main", "blocks"), "differing")
    outside = rows.where("label != main").groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("out_blocks"))
    return rows.join(outside, "key")


def _cross_links(rows: DataFrame, nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that join what is still apart inside the keys of ``rows``.

    A key's rows are cut into blocks of about BLOCK by hash, those outside its
    main component also into blocks of their own, and a task holds one block of
    either: what is dealt out grows with the rows outside times the blocks, and
    a large component with a stray text is dealt once. The task compares the
    sketches of rows of different components, verifies those that may be similar,
    likeliest first, and stops once two components are joined: it returns the
    joining links alone, at most one less than there are components. A pair that
    meets in several buckets is looked at in the least of them.
    """
    rows = scratch_table(rows, "apart")
    sets = _shingles_of(rows.select("k").distinct(), texts, nodes)
    members = rows.join(nodes.select("k", "sketch", "bands"), "k").join(sets, "k")
    block, out_block = (F.pmod(F.xxhash64("k", F.lit(seed)), F.col(c)).cast("int") for seed, c in ((1, "blocks"), (2, "out_blocks")))

    def every(column: str):
        return F.explode(F.sequence(F.lit(0), F.col(column) - 1))

    seekers = members.where("label != main").withColumn("seeks", F.lit(True)).withColumn("i", out_block).withColumn("j", every("blocks"))
    sought = members.withColumn("seeks", F.lit(False)).withColumn("j", block).withColumn("i", every("out_blocks"))
    least = (FLOOR + (1 - FLOOR) / 256) * SIZE

    def link(table: pa.Table) -> pa.Table:
        key = table.column("key")[0].as_py()
        keys, labels, main = (table.column(c).to_pylist() for c in ("k", "label", "main"))
        n = table.column("n").to_numpy()
        seeks = table.column("seeks").to_numpy(zero_copy_only=False)
        order = np.array(keys, "S16")
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SIZE)
        bands = np.array(table.column("bands").to_pylist(), np.int64)
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")]
        number = {x: i for i, x in enumerate(dict.fromkeys(labels))}
        label = np.array([number[x] for x in labels])
        outside = np.array([x != m for x, m in zip(labels, main)])
        parent = list(range(len(number)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        for x in np.flatnonzero(seeks).tolist():
            able = ~seeks & (label != label[x]) & (np.minimum(n, n[x]) >= threshold * np.maximum(n, n[x]))
            # Two rows outside the main component seek each other: once is enough.
            able &= ~outside | (order > order[x])
            ys = np.flatnonzero(able)
            agree = (sketch[ys] == sketch[x]).sum(axis=1)
            ys, agree = ys[agree >= least], agree[agree >= least]
            if len(ys) == 0:
                continue
            # The least of the buckets that both are in, by either sketch of each.
            here = np.minimum(*(np.where(bands[ys] == mine_too, mine_too, LAST).min(axis=1) for mine_too in (bands[x], np.roll(bands[x], BANDS)))) == key
            ys, agree = ys[here], agree[here]
            for y in ys[np.argsort(-agree, kind="stable")].tolist():
                u, v = find(int(label[x])), find(int(label[y]))
                if u == v:
                    continue
                both = np.concatenate([sets[x], sets[y]])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                if common >= threshold * (len(both) - common):
                    out.append((keys[x], keys[y]))
                    parent[max(u, v)] = min(u, v)
        return pa.table({"a": pa.array([a for a, _ in out], pa.binary()), "b": pa.array([b for _, b in out], pa.binary())})

    columns = ["key", "i", "j", "seeks", "k", "n", "label", "main", "sketch", "bands", "shingles"]
    dealt = seekers.select(*columns).unionByName(sought.select(*columns))
    return scratch_table(dealt.groupBy("key", "i", "j").applyInArrow(link, "a binary, b binary"), "cross")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row per document: (id, class_id, n_copies); see the module's text.

    ``class_id`` is the least id of the documents linked to it, directly or by
    way of others; ``n_copies`` counts the documents of its class.
    """
    return _with_class(picked(docs, id=id_col, text=text_col), threshold)[0].withColumnRenamed("id", id_col)


def _with_class(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(one row per document, one row per distinct text: k, label, class_id, n_copies)."""
    texts = docs.select("id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("k"), "text")
    id_type = texts.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, k binary, n long, sketch binary, bands array<long>"
    rows = scratch_table(texts.mapInArrow(_sketched, schema), "sketches")
    nodes = scratch_table(
        rows.where("n > 0").groupBy("k").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")),
        "nodes",
    )
    texts = texts.where(F.col("k").isNotNull())
    buckets = nodes.select(F.explode(F.array_distinct("bands")).alias("bucket"), "k", "n")
    held = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    shared = scratch_table(buckets.join(held, "bucket"), "shared")
    # The text whose buckets hold most is the likeliest source of a group of near copies.
    central = shared.groupBy("k").agg(F.sum("held").alias("central"))
    leaders = shared.select("bucket", "k").join(central, "k").groupBy("bucket").agg(F.max(F.struct("central", "k")).alias("m")).select("bucket", F.col("m.k").alias("a"))
    shared = scratch_table(shared.select("bucket", "k", "n").join(leaders, "bucket"), "buckets")
    first = scratch_table(shared.where("a != k").select(F.least("a", "k").alias("a"), F.greatest("a", "k").alias("b")).distinct(), "pairs")
    linked = _verified(first, texts, nodes, threshold)
    labels = connected_components(linked)
    # What still differs inside a bucket is compared with the rest of it.
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    placed = scratch_table(
        shared.select("bucket", "k", "n")
        .join(labels.withColumnRenamed("node", "k"), "k", "left")
        .join(sizes, "label", "left")
        .select(F.col("bucket").alias("key"), "k", "n", F.coalesce("label", "k").alias("label"), F.coalesce("size", F.lit(1)).alias("size")),
        "placed",
    )
    more = _cross_links(_differing(placed), nodes, texts, threshold)
    if not more.isEmpty():
        labels = connected_components(linked.unionByName(more))
    by_text = nodes.select("k", "id", "copies").join(labels.withColumnRenamed("node", "k"), "k", "left").withColumn("label", F.coalesce("label", "k"))
    classes = by_text.groupBy("label").agg(F.min("id").alias("class_id"), F.sum("copies").alias("n_copies"))
    classes = scratch_table(by_text.join(classes, "label").select("k", "label", "class_id", "n_copies"), "classes")
    out = (
        rows.select("id", "k", "n")
        .join(classes, "k", "left")
        .select("id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id"), F.when(F.col("n") > 0, F.col("n_copies")).otherwise(F.lit(1)).cast("long").alias("n_copies"))
    )
    return out, classes


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without near-duplicates, with their columns.

    Of each class the document with the least id stays (a null id is greater
    than others; then the least text by MD5, then the least row by hash).
    Documents without shingles all stay.
    """
    frame = positional(docs)
    ident, text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    keyed = frame.withColumn("__k", F.unhex(F.md5(text.cast("binary")))).withColumn("__h", F.xxhash64(*frame.columns))
    _, classes = _with_class(frame.select(ident.alias("id"), text.alias("text")), threshold)
    narrow = keyed.select(ident.alias("__id"), "__k", "__h").join(classes.select(F.col("k").alias("__k"), "label"), "__k")
    first = narrow.groupBy("label").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__k", "__h")).alias("f")).select(F.col("f.__h").alias("__h"), F.col("f.__k").alias("__k"))
    # Rows alike in every column are one row, so that one of them stays.
    kept = keyed.join(first, ["__h", "__k"], "left_semi").dropDuplicates(["__h", "__k"])
    bare = keyed.join(classes.select(F.col("k").alias("__k")), "__k", "left_anti")
    return restored(kept.unionByName(bare.select(*kept.columns)), docs)
