"""Token-id files of directly addressable codes.

An id is cut into chunks of WIDTHS bits, lowest first. Level 0 holds the first
chunk of every id and a bitmap that tells whose id goes on; level 1 holds the
second chunk of those alone, and so on. A rank directory has the number of set
bits before every RANK_BITS-th place, so the place of an id in the next level
is one look-up and one short count away: any token is read without decoding
others, and a range of tokens is a slice of each level.

A segment is the file's unit: the ids of some consecutive documents, with
their ids and lengths. Segments are rows of a Parquet table, in ascending id
order within and across them (``part``, ``segment``); a very long document is
one segment. Documents are tokenized a chunk between blanks at a time, each
distinct chunk once a task, which gives the tokenizer's own ids because it
drops white space and never looks across it.

Nulls: a null text is empty (its end id alone); null ids come first. Ties in
the id go by the text's hash; rows alike are interchangeable. Repeated rows
are repeated in the file. An empty table gives an empty file. Other columns
don't matter.
"""

from __future__ import annotations

import json
import struct
import sys
import types
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthloom.llm.common import Vocabulary, picked, scratch_path

WIDTHS = (8, 8, 16)
RANK_BITS = 512
SEGMENT_TOKENS = 1 << 18
MAGIC = b"GLDAC001"
NO_ID = -(1 << 63)


def _byte_names() -> dict[int, str]:
    """How byte-level tokenizers write bytes: visible Latin-1 characters as
    themselves, the others as the characters from U+0100 on, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {b: chr(0x100 + n) for n, b in enumerate(others)}


BYTE_NAMES = _byte_names()
LINE_NAMES = {b: name for b, name in BYTE_NAMES.items() if b != 0x0A}


def _padded(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % 8)


def encode_segment(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """The image of a segment: header, document index, then each level's chunks, bitmap and rank directory."""
    out = [MAGIC, struct.pack("<QQ", len(doc_ids), len(ids)), doc_ids.astype("<i8").tobytes(), lengths.astype("<i8").tobytes()]
    left = ids.astype(np.uint64)
    for level, width in enumerate(WIDTHS):
        chunk = (left & np.uint64((1 << width) - 1)).astype("<u1" if width == 8 else "<u2")
        left = left >> np.uint64(width)
        goes_on = left > 0
        out += [struct.pack("<Q", len(chunk)), _padded(chunk.tobytes())]
        if level == len(WIDTHS) - 1:
            if goes_on.any():
                raise ValueError(f"an id needs more than {sum(WIDTHS)} bits")
            break
        places = np.zeros(-(-len(chunk) // RANK_BITS) * RANK_BITS, np.uint8)
        places[: len(chunk)] = goes_on
        set_before = np.cumsum(places.reshape(-1, RANK_BITS).sum(axis=1, dtype=np.int64))
        out += [np.packbits(places, bitorder="little").tobytes(), np.append(0, set_before).astype("<u8").tobytes()]
        left = left[goes_on]
    return b"".join(out)


class Segment:
    """Random access to a segment's image; nothing is decoded beforehand."""

    def __init__(self, image: bytes):
        if image[:8] != MAGIC:
            raise ValueError("not a token segment")
        n_docs, self.n_tokens = struct.unpack_from("<QQ", image, 8)
        self.doc_ids = np.frombuffer(image, "<i8", n_docs, 24)
        self.lengths = np.frombuffer(image, "<i8", n_docs, 24 + 8 * n_docs)
        at = 24 + 16 * n_docs
        self.levels = []
        for level, width in enumerate(WIDTHS):
            (n,) = struct.unpack_from("<Q", image, at)
            chunk = np.frombuffer(image, "<u1" if width == 8 else "<u2", n, at + 8)
            at += 8 + len(chunk.tobytes()) + (-chunk.nbytes % 8)
            if level == len(WIDTHS) - 1:
                self.levels.append((width, chunk, None, None))
                break
            blocks = -(-n // RANK_BITS)
            bits = np.frombuffer(image, np.uint8, blocks * RANK_BITS // 8, at)
            at += bits.nbytes
            ranks = np.frombuffer(image, "<u8", blocks + 1, at)
            at += ranks.nbytes
            self.levels.append((width, chunk, bits, ranks))

    def _rank(self, level: int, i: int) -> int:
        """Set bits of a level's bitmap before place ``i``."""
        _, _, bits, ranks = self.levels[level]
        block = i // RANK_BITS
        upto = np.unpackbits(bits[block * RANK_BITS // 8 : i // 8 + 1], bitorder="little")
        return int(ranks[block]) + int(upto[: i - block * RANK_BITS].sum())

    def token(self, i: int) -> int:
        """The i-th id of the segment."""
        value = shift = 0
        for level, (width, chunk, bits, _) in enumerate(self.levels):
            value |= int(chunk[i]) << shift
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                return value
            i, shift = self._rank(level, i), shift + width
        return value

    def tokens(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end``: one slice of each level."""
        out = np.zeros(end - begin, np.uint64)
        where, shift = np.arange(end - begin), 0
        for level, (width, chunk, bits, _) in enumerate(self.levels):
            out[where] |= chunk[begin:end].astype(np.uint64) << np.uint64(shift)
            if bits is None or begin == end:
                break
            on = np.unpackbits(bits[begin // 8 : -(-end // 8)], bitorder="little")[begin % 8 : begin % 8 + end - begin].astype(bool)
            first = self._rank(level, begin)
            where, shift = where[on], shift + width
            begin, end = first, first + len(where)
        return out.astype(np.uint32)


class CachedTokenizer:
    """ids of texts; a chunk between blanks is put together the first time it is seen.

    ASCII case is dropped beforehand where the tokenizer drops it and nothing
    else depends on it, unless a text may hold a special token. A chunk of letters before marks is two of the
    tokenizer's own pieces, so the letters are encoded once whatever follows
    them. The chunks of at most LIMIT are kept.
    """

    LIMIT = 800_000
    MARKS = ".,;:!?#&%$*|"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The model alone is asked where these steps before it are the whole of them.
        steps = json.loads(self.tokenizer.to_str())
        known = [x["type"] for x in (steps["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        known &= [x["type"] for x in (steps["pre_tokenizer"] or {}).get("pretokenizers", [])] == ["Split", "ByteLevel"]
        self.model = self.tokenizer.model if known else None
        self._start()

    @staticmethod
    def _pieces(words: list[str]) -> list[str | None]:
        """What the tokenizer's model gets for words of Latin letters beyond ASCII, each of
        which is one piece: composed, without case, bytes as characters. Null for other chunks.

        All words at once: they hold no line ends, which no step changes or joins."""
        plain = unicodedata.normalize("NFC", "\n".join(words)).lower().split("\n")  # below U+0250 a letter's case depends on no other
        named = "\n".join(plain).encode().decode("latin-1").translate(LINE_NAMES).split("\n")
        return [n if w.isalpha() and max(w) < "\u0250" else None for n, w in zip(named, plain)]

    def _start(self) -> None:
        self.chunks = Vocabulary(self.LIMIT, code=_no_code)
        self.parts: dict[str, list[int]] = {"": []}
        self.flat = np.zeros(1 << 20, np.uint32)
        self.begin = np.zeros(1 << 16, np.int64)
        self.known = 0

    def _learn(self) -> None:
        new = b"\n".join(self.chunks.words[self.known :]).decode("utf-8", "replace").split("\n")
        heads = [t.rstrip(self.MARKS) for t in new]
        # U+0130 ends in a mark once its case is dropped, and marks go together.
        cut = [(h, t[len(h) :]) if h.isalpha() and "\u0130" not in h else (t, "") for h, t in zip(heads, new)]
        missing = [p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in self.parts]
        whole = missing
        if self.model:
            tokenize = self.model.tokenize
            whole = [p for p in missing if not (p.isascii() and p.isalpha() and p.islower())]
            for p in missing:
                if p.isascii() and p.isalpha() and p.islower():
                    self.parts[p] = [x.id for x in tokenize(p)]
            for p, piece in zip(whole, self._pieces(whole)):
                if piece is not None:
                    self.parts[p] = [x.id for x in tokenize(piece)]
            whole = [p for p in whole if p not in self.parts]
        if whole:
            for p, found in zip(whole, self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)):
                self.parts[p] = found.ids
        found = [self.parts[x] + self.parts[y] if y else self.parts[x] for x, y in cut]
        ends = self.begin[self.known] + np.cumsum([len(f) for f in found])
        while ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        while self.known + len(new) >= len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros(len(self.begin), np.int64)])
        self.flat[self.begin[self.known] : ends[-1]] = list(chain.from_iterable(found))
        self.begin[self.known + 1 : self.known + 1 + len(new)] = ends
        self.known += len(new)

    def _chunks(self, texts: pa.Array) -> pa.Array:
        """The chunks of texts (binary), ASCII letters without case where that changes nothing.

        The tokenizer composes letters and marks before it drops case, and some
        letters are composed in one case only: in texts with marks that go with
        ASCII letters (U+0300 to U+037F, which begin with two certain bytes), and in
        those that may hold a special token, the case of chunks stays."""
        plain = pc.ascii_lower(texts.cast(pa.large_string(), safe=False)) if self.model else texts.cast(pa.large_string(), safe=False)
        if self.model:
            kept = pa.array([b"<|" in t or b"\xcc" in t or b"\xcd" in t for t in texts.to_pylist()], pa.bool_())
            if kept.true_count:
                plain = pc.if_else(kept, texts.cast(pa.large_string(), safe=False), plain)
        return pc.ascii_split_whitespace(plain)

    def encode(self, texts: pa.Array | list[bytes]) -> list[np.ndarray]:
        """The ids of each text (UTF-8; none of them null)."""
        if len(self.chunks.words) >= self.LIMIT or len(self.parts) >= self.LIMIT:
            self._start()
        chunks = self._chunks(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_binary()))
        # Distinct chunks are looked up; the others follow by their place.
        coded = chunks.values.dictionary_encode()
        numbers = self.chunks.numbers(coded.dictionary.cast(pa.large_binary()).to_pylist())
        if len(self.chunks.words) > self.known:
            self._learn()
        numbers = numbers[coded.indices.to_numpy()]
        begin = self.begin[numbers]
        size = self.begin[numbers + 1] - begin
        before = np.cumsum(size) - size
        ids = self.flat[np.repeat(begin - before, size) + np.arange(int(size.sum()))]
        upto = np.append(0, np.cumsum(size))[chunks.offsets.to_numpy()]
        return np.split(ids, upto[1:-1])


def _encoded(encoder: CachedTokenizer, texts: pa.Array, together: int = 1 << 22) -> Iterator[np.ndarray]:
    """ids of texts, encoded ``together`` bytes at a time."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    begin, size = 0, 0
    for row, length in enumerate(pc.binary_length(texts).to_pylist()):
        size += length
        if size >= together:
            yield from encoder.encode(texts.slice(begin, row + 1 - begin))
            begin, size = row + 1, 0
    if begin < len(texts):
        yield from encoder.encode(texts.slice(begin))


def _no_code(word: bytes) -> int:
    return 0


def _kept_tokenizer(path: str) -> CachedTokenizer:
    """The worker process's tokenizer: Spark reuses workers, and what one task
    has learnt helps the next. Its memory is bounded by CachedTokenizer.LIMIT."""
    kept = sys.modules.setdefault("growthloom_kept_tokenizers", types.ModuleType("growthloom_kept_tokenizers"))
    found = kept.__dict__.setdefault("by_path", {})
    if path not in found:
        found[path] = CachedTokenizer(path)
    return found[path]


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenize ``docs`` and write the segments table to ``path``; ids are longs."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = picked(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    # Equal ids and texts may fill several ranges: the row number parts them.
    keyed = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("id").asc_nulls_first(), "tie", "row"]
    ordered = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), F.coalesce("id", F.lit(NO_ID)).alias("id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _kept_tokenizer(tokenizer)
        end = np.array([end_id], np.uint32)
        ids, lengths, texts, size, segment, part = [], [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            image = encode_segment(np.array(ids, np.int64), np.array(lengths, np.int64), np.concatenate(texts))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([segment], pa.int64()), pa.array([size], pa.int64()), pa.array([image], pa.binary())], names=["part", "segment", "n_tokens", "image"])

        for batch in batches:
            part = batch.column(0)[0].as_py() if batch.num_rows else part
            for id_, encoded in zip(batch.column(1).to_pylist(), _encoded(encoder, batch.column(2))):
                texts += [encoded, end]
                ids.append(id_)
                lengths.append(len(encoded) + 1)
                size += lengths[-1]
                if size >= SEGMENT_TOKENS:
                    yield flush()
                    ids, lengths, texts, size, segment = [], [], [], 0, segment + 1
        if ids:
            yield flush()

    ordered.mapInArrow(run, "part int, segment long, n_tokens long, image binary").write.option("compression", "zstd").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document of a file, from its images."""
    table = spark.read.schema("part int, segment long, n_tokens long, image binary").parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                segment = Segment(batch.column(2)[row].as_py())
                ids = segment.tokens(0, segment.n_tokens)
                ends = np.cumsum(segment.lengths)
                begin = ends - segment.lengths
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(begin.tolist(), ends.tolist())]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[row].as_py()] * n, pa.int32()), pa.array([batch.column(1)[row].as_py()] * n, pa.int64())]
                    + [pa.array(x, pa.int64()) for x in (segment.doc_ids, begin, segment.lengths, crc)],
                    names=["part", "segment", "id", "at", "n_tokens", "ids_crc32"],
                )

    documents = table.select("part", "segment", "image").mapInArrow(run, "part int, segment long, id long, at long, n_tokens long, ids_crc32 long")
    # Parts are as many as the writing tasks; a part's segments are summed apart.
    parts = table.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    part_start = parts.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    within = F.coalesce(F.sum("n_tokens").over(W.partitionBy("part").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = table.select("part", "segment", within.alias("within")).join(part_start, "part").select("part", "segment", (F.col("part_start") + F.col("within")).alias("base"))
    return documents.join(starts, ["part", "segment"]).select(F.when(F.col("id") != NO_ID, F.col("id")).alias("id"), (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the file to the shared folder and list its documents from the file."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_token_file(docs, path, tokenizer, end_id, id_col, text_col)
    return read_documents(docs.sparkSession, path).withColumnRenamed("id", id_col)
