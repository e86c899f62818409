"""SentencePiece encoding by a table of distinct chunks, and decoding.

A text is cut before every run of white-space markers and at line ends; a
chunk is a marker, or several, and the characters up to the next one. Where no
piece of a model holds a marker after another character, nor a line end beside
one, no merge can reach across a cut: the pieces of a text are its chunks'
pieces, one chunk after the other. So each distinct chunk is segmented once by
the library, its ids are kept in a table, and a text's ids are gathered from the
table by the numbers of its chunks, in order.

The table belongs to a worker process: Spark reuses workers, so one task's
table helps the next. Texts aren't shuffled: joining ids to positions between
machines would move every word of the corpus, a table for each worker moves
none. Its size is bounded (LIMIT chunks, started afresh beyond). Models for
which the conditions don't hold are encoded text by text.

A null text is empty and has no ids. Null and repeated ids, empty and very
long texts stay as they are (a text's ids have to fit in a task's memory); a
marker character in a text counts as a space, as in the library. An empty table
gives an empty table. Other columns don't matter.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from growthloom.llm.common import picked

MARKER = "▁"
#: A run of spaces, or a line end, and what follows up to the next.
CHUNK = re.compile(r" +[^ \n]*|\n[^ \n]*")
#: Characters that normalisers change, spaces and line ends: a model that leaves them alone is taken to leave all alone.
PROBE = "a  ﬁ ＡÅÅ\n\n \t 　​ B "
#: Chunks of a table: a worker meets any number of them, half a million take 100 MB, and an executor has several workers.
LIMIT = 150_000
#: Bytes of text whose chunks are looked up together.
TOGETHER = 1 << 20


class _Numbers(dict):
    """chunk -> running number; ``fresh`` has the chunks that aren't segmented yet."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self)
        self.fresh.append(chunk)
        return n


class PieceTable:
    """ids of texts; each distinct chunk is segmented once.

    A chunk's key is its text without one marker (which the library puts in
    front), or starts with the line end that it begins with.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        crossing = any(p[i] != MARKER and p[i + 1] == MARKER for p in pieces for i in range(len(p) - 1))
        lines = any("\n" in p and len(p) > 1 for p in pieces)
        plain = self.model.normalize(PROBE) == MARKER + PROBE.replace(" ", MARKER)
        self.by_chunk = plain and not crossing and not lines
        self._start()

    def _start(self) -> None:
        self.numbers = _Numbers()
        self.known = 0
        self.flat = np.zeros(1 << 20, np.int32)
        self.begin = np.zeros(1 << 16, np.int64)

    @staticmethod
    def keys(text: str) -> list[str]:
        """The keys of a text's chunks, in order."""
        if not text:
            return []
        text = text.replace(MARKER, " ")
        marked = text.replace("\n", " \n")
        if "  " not in marked and marked[0] != " " and marked[-1] != " ":
            return marked.split(" ")
        return [c[1:] if c[0] == " " else c for c in CHUNK.findall(" " + text)]

    def _segmented(self, keys: list[str]) -> list[list[int]]:
        found = self.model.encode(keys, num_threads=1)
        for i, key in enumerate(keys):
            if key == "":
                found[i] = self.model.encode("\n")[:1]  # a marker alone
            elif key[0] == "\n":
                found[i] = found[i][1:]
        return found

    def _learn(self) -> None:
        new, self.numbers.fresh = self.numbers.fresh, []
        found = self._segmented(new)
        ends = self.begin[self.known] + np.cumsum([len(f) for f in found])
        while ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.int32)])
        while self.known + len(new) >= len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros(len(self.begin), np.int64)])
        self.flat[self.begin[self.known] : ends[-1]] = list(chain.from_iterable(found))
        self.begin[self.known + 1 : self.known + 1 + len(new)] = ends
        self.known += len(new)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one text after the other, number of ids of each text)."""
        if not self.by_chunk:
            found = self.model.encode(texts, num_threads=1)
            return np.fromiter(chain.from_iterable(found), np.int32), np.array([len(f) for f in found], np.int64)
        if len(self.numbers) >= LIMIT:
            self._start()
        keys = [self.keys(t) for t in texts]
        numbers = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(keys)), np.int64, sum(map(len, keys)))
        if self.numbers.fresh:
            self._learn()
        begin = self.begin[numbers]
        size = self.begin[numbers + 1] - begin
        upto = np.append(0, np.cumsum(size))
        ids = self.flat[np.repeat(begin - upto[:-1], size) + np.arange(int(upto[-1]))]
        return ids, np.diff(upto[np.append(0, np.cumsum([len(k) for k in keys]))])

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.model.decode(ids, num_threads=1)


def _kept(path: str) -> PieceTable:
    """The worker process's table; its memory is bounded by LIMIT."""
    held = sys.modules.setdefault("growthloom_kept_pieces", types.ModuleType("growthloom_kept_pieces"))
    found = held.__dict__.setdefault("by_path", {})
    if path not in found:
        found[path] = PieceTable(path)
    return found[path]


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Consecutive rows of about TOGETHER together."""
    begin, held = 0, 0
    for r, size in enumerate(sizes):
        held += size
        if held >= TOGETHER:
            yield begin, r + 1
            begin, held = r + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): every document's ids, without begin or end ids."""
    rows = picked(docs, id=id_col, text=text_col)
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _kept(model)
        for batch in batches:
            column = batch.column(1)
            sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
            for begin, end in _groups(sizes):
                ids, n = table.encode([t or "" for t in column.slice(begin, end - begin).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), lists], names=["id", "ids"])

    return rows.mapInArrow(run, f"id {id_type}, ids array<int>").withColumnRenamed("id", id_col)


def decoded(tokens: DataFrame, model: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``tokens`` (its columns' names must differ) with the text that the model's decoder gives for its ids (null: empty)."""
    columns = tokens.columns
    at = columns.index(ids_col)
    schema = StructType([*tokens.schema.fields, StructField(name, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _kept(model)
        for batch in batches:
            column = batch.column(at)
            sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_pylist()
            for begin, end in _groups([4 * s for s in sizes]):
                part = batch.slice(begin, end - begin)
                texts = table.decode([ids or [] for ids in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*columns, name])

    return tokens.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every document: its ids, joined by commas, and what they decode to."""
    both = decoded(encoded(docs, model, id_col, text_col), model)
    digits = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(id_col, F.size("ids").cast("long").alias("n_tokens"), F.sha2(digits, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
