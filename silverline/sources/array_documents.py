"""Splittable read of JSON documents that hold one long array.

A multi-line JSON reader gives a document to one task, whatever its size. Here a
file is read in splits of its bytes, cut after closing braces, and each split
finds the array's elements that begin in it. What a split starts with, inside a
string or not and how deep, depends on all before it; but its effect on that is
known without it: how often it changes between string and text, and what it adds
to the depth for either start. So a first pass writes down the effect of every
split, a prefix over the splits of a file gives their entry states, and a second
pass emits the elements. An element that runs over a border comes in fragments,
which are put together; only those are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path

PIECE_END = "}"                # text rows end here; every element but a scalar has one
SLAB_BYTES = 1 << 20           # bytes that are looked at together
NO_FIELD = "}"                 # where a field's name would stand after a container that is no wanted array
_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$')


def _structure(text: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(+1, -1 or 0 for brackets, True for commas, inside a string at the end) outside strings."""
    quotes = np.flatnonzero(text == ord('"'))
    slashes = text == ord("\\")
    if len(quotes) and slashes.any():
        last = np.maximum.accumulate(np.where(slashes, -1, np.arange(len(text))))
        before = np.where(quotes > 0, last[quotes - 1], -1)
        quotes = quotes[(quotes - 1 - before) % 2 == 0]       # an odd run of backslashes escapes the quote
    turns = np.zeros(len(text), np.int8)
    turns[quotes] = 1
    outside = (np.cumsum(turns, dtype=np.int64) + inside) % 2 == 0
    opens, closes = (text == ord("{")) | (text == ord("[")), (text == ord("}")) | (text == ord("]"))
    step = np.where(outside, opens.astype(np.int8) - closes.astype(np.int8), 0)
    return step, outside & (text == ord(",")), (inside + len(quotes)) % 2


def _slabs(batches):
    """(file, split, other columns of its rows, text) of runs of rows of one split, in order."""
    key, more, parts, size = None, (), [], 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for file, block, value, *rest in zip(*columns, strict=True):
            if (file, block) != key or size >= SLAB_BYTES:
                if parts:
                    yield *key, more, np.frombuffer(b"".join(parts), np.uint8)
                key, more, parts, size = (file, block), tuple(rest), [], 0
            data = value.encode() + PIECE_END.encode()
            parts.append(data)
            size += len(data)
    if parts:
        yield *key, more, np.frombuffer(b"".join(parts), np.uint8)


_EFFECT = "file string, block long, turns int, depth_0 long, depth_1 long"


def _effects(batches):
    """The effect of each split: string ends passed (mod 2) and depth added, entered outside or inside a string."""
    found: dict[tuple, list[int]] = {}
    for file, block, _, text in _slabs(batches):
        effect = found.setdefault((file, block), [0, 0, 0])
        turned = effect[0]
        for entry in (0, 1):
            step, _, after = _structure(text, (entry + turned) % 2)
            effect[1 + entry] += int(step.sum())
            if entry == 0:
                effect[0] = after
    rows = [(*key, *effect) for key, effect in found.items()]
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], [f.split()[0] for f in _EFFECT.split(", ")])


_PART = "file string, block long, seq long, kind string, field string, text string"


class _Reader:
    """Elements of the containers one level below ``level`` in one split.

    A container that was open at the split's start is unknown: what is found in
    it has no field yet, and its first piece is the rest of an element (``head``).
    """

    def __init__(self, file: str, block: int, inside: int, depth: int, level: int):
        self.file, self.block, self.inside, self.depth, self.level = file, block, inside, depth, level
        self.rows: list[tuple] = []
        self.seq = 0
        self.open = depth > level                # in a container whose elements are wanted, or unknown
        self.carried = self.open
        self.field: str | None = None            # of the open container; None while carried
        self.at_end: str | None = None
        self.first = self.open
        self.current: list[bytes] = []           # of the element, or between containers the text that names the next one

    def _emit(self, kind: str) -> None:
        text = b"".join(self.current).decode()
        if kind != "whole" or text.strip():
            self.rows.append((self.file, self.block, self.seq, kind, None if self.carried else self.field, text))
            self.seq += 1
        self.current, self.first = [], False

    def read(self, text: np.ndarray) -> None:
        step, commas, inside = _structure(text, self.inside)
        depth = self.depth + np.cumsum(step, dtype=np.int64)
        opens, closes = (step > 0) & (depth == self.level + 1), (step < 0) & (depth == self.level)
        data, at = text.tobytes(), 0
        for i in np.flatnonzero(opens | closes | (commas & (depth == self.level + 1))).tolist():
            if opens[i]:
                self.current.append(data[at:i])
                named = _KEY.search(b"".join(self.current))
                self.open, self.carried, self.current = data[i:i + 1] == b"[", False, []
                self.field = named.group(1).decode() if named else ""
            elif closes[i]:
                self.current.append(data[at:i])
                if self.open:
                    self._emit("head" if self.first else "whole")
                self.open, self.carried, self.field, self.current = False, False, None, []
                self.at_end = NO_FIELD
            elif self.open:
                self.current.append(data[at:i])
                self._emit("head" if self.first else "whole")
            else:
                continue                          # between members of an object
            at = i + 1
        if self.open or depth[-1] <= self.level:
            self.current.append(data[at:])
        else:
            self.current = []                     # within an object: nothing of it is wanted
        self.inside, self.depth = inside, int(depth[-1])

    def close(self) -> list[tuple]:
        if self.open:
            self._emit("through" if self.first else "tail")
            self.at_end = None if self.carried else self.field
        elif self.depth > self.level:
            self.at_end = NO_FIELD
        self.rows.append((self.file, self.block, self.seq, "end", self.at_end, None))
        return self.rows


def _elements(level: int, batches):
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
    names = [f.split()[0] for f in _PART.split(", ")]
    reader: _Reader | None = None

    def passed(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    for file, block, (inside, depth), text in _slabs(batches):
        if reader is None or (reader.file, reader.block) != (file, block):
            if reader is not None:
                yield passed(reader.close())
            reader = _Reader(file, block, inside, depth, level)
        reader.read(text)
        if reader.rows:
            yield passed(reader.rows)
            reader.rows = []
    if reader is not None:
        yield passed(reader.close())


@contextmanager
def _split_size(spark: SparkSession, size: int | None) -> Iterator[None]:
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    if size:
        spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _bytes(spark: SparkSession, size: str) -> int:
    """A size as Spark writes it, such as ``128MB``."""
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def _written(df: DataFrame, tag: str) -> DataFrame:
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_array_elements(spark: SparkSession, paths: str | list[str], field: str | None = "movie", split_bytes: int | None = None) -> DataFrame:
    """(source_file, value): the JSON text of each element of the array ``field`` of every document, one document a file.

    ``paths`` may hold glob patterns. Without ``field`` the document itself is the
    array. Splits have ``split_bytes`` (by default spark.sql.files.maxPartitionBytes);
    a task reads as many smaller ones as that setting holds.
    Elements come as they are written, in no order; documents without the field
    give none. Documents have to be valid UTF-8 JSON; the field's name holds no ``}``.
    The entry states, some numbers for each split, are broadcast.
    """
    level = 0 if field is None else 1
    wanted = F.lit("" if field is None else field)
    task_bytes = _bytes(spark, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    with _split_size(spark, split_bytes):
        pieces = spark.read.schema("value STRING").option("lineSep", PIECE_END).option("recursiveFileLookup", True) \
            .text(paths if isinstance(paths, list) else [paths]) \
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
        if split_bytes and split_bytes < task_bytes:          # a task reads small splits one after the other
            splits = pieces.rdd.getNumPartitions()
            pieces = pieces.coalesce(max(spark.sparkContext.defaultParallelism, -(-splits * split_bytes // task_bytes)))
        effects = _written(pieces.mapInArrow(_effects, _EFFECT), "array-effects")
        before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        entered = effects.withColumn("inside", F.coalesce(F.sum("turns").over(before) % 2, F.lit(0)).cast("int"))
        adds = F.when(F.col("inside") == 0, F.col("depth_0")).otherwise(F.col("depth_1"))
        states = entered.withColumn("adds", adds).withColumn("depth", F.coalesce(F.sum("adds").over(before), F.lit(0)).cast("long")) \
            .select("file", "block", "inside", "depth")
        found = _written(pieces.join(F.broadcast(states), ["file", "block"]).select("file", "block", "value", "inside", "depth")
                         .mapInArrow(partial(_elements, level), _PART), "array-elements")
    ends = found.filter("kind = 'end'").select("file", "block", "field")
    carried = ends.select("file", "block", F.last("field", ignorenulls=True).over(before).alias("_carried"))
    # fragments: a tail begins an element, heads and whole splits go on with the last one that began
    fragments = found.filter("kind IN ('head', 'tail', 'through')").join(carried, ["file", "block"]) \
        .withColumn("field", F.coalesce("field", "_carried"))
    so_far = Window.partitionBy("file").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = fragments.withColumn("_start", F.last(F.when(F.col("kind") == "tail", F.col("block")), ignorenulls=True).over(so_far)) \
        .groupBy("file", "_start").agg(F.first("field").alias("field"), F.array_sort(F.collect_list(F.struct("block", "seq", "text"))).alias("parts")) \
        .select("file", "field", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("value"))
    inner = found.filter("kind = 'whole'")
    known = inner.filter("field IS NOT NULL").select("file", "field", F.col("text").alias("value"))
    late = inner.filter("field IS NULL").join(F.broadcast(carried), ["file", "block"]).select("file", F.col("_carried").alias("field"), F.col("text").alias("value"))
    return known.unionByName(late).unionByName(joined).filter(F.col("field") == wanted) \
        .select(F.col("file").alias("source_file"), F.btrim("value", F.lit(" \n\r\t")).alias("value")).filter("value <> ''")
