"""Token counts of the documents in flat token files that have no index.

A flat file is a sequence of token ids of a fixed width in which an end-of-document id closes each
document. It is read in blocks that know nothing of each other: each block is searched for the id with
one vectorised comparison, and gives the lengths between its separators and what is open at both ends.
A prefix scan over the blocks then tells each one where its first document began and how many documents
came before, so documents that lie over many blocks are put together without reading a token twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from signalflow.llm import bpe
from signalflow.llm.common import map_batches
from signalflow.session import written

# Tokens in a block, and blocks that the first level of the prefix scan sees together.
BLOCK_TOKENS = 1 << 18
SEGMENT_BLOCKS = 1 << 10
WIDTH = "<u2"


def write_flat(docs: DataFrame, path: str, pattern: str, separator: int, id_col: str = "doc_id", text: str = "text", width: str = WIDTH) -> DataFrame:
    """Encode texts into flat files: ``(file, block, payload)`` and, apart from them, ``first`` and ``ids``.

    Each input partition becomes one file, cut into blocks of equal length regardless of documents.
    Rows with ``ids`` and no payload list which documents the file holds, from number ``first`` on; a
    scan doesn't read them. A NULL text is an empty document. A task that runs again makes its file anew.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bpe.vocabulary(path, pattern)
        file = TaskContext.get().partitionId()
        end = np.array([separator], width).tobytes()
        size = BLOCK_TOKENS * np.dtype(width).itemsize
        held, block, written_docs = bytearray(), 0, 0

        def rows(blocks: list[bytes], ids: list) -> pa.RecordBatch:
            n = len(blocks)
            columns = [
                pa.array([file] * (n + 1), pa.int64()),
                pa.array([*range(block, block + n), None], pa.int64()),
                pa.array([*blocks, None], pa.binary()),
                pa.array([None] * n + [written_docs], pa.int64()),
                pa.array([None] * n + [ids], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["file", "block", "payload", "first", "ids"])

        for batch in batches:
            ids, blocks = batch.column("id").to_pylist(), []
            for value in batch.column("text"):
                held += np.frombuffer(words.encode(value.as_py() or ""), "<u4").astype(width).tobytes() + end
                while len(held) >= size:
                    blocks.append(bytes(held[:size]))
                    del held[:size]
            yield rows(blocks, ids)
            block, written_docs = block + len(blocks), written_docs + len(ids)
        if held:
            yield rows([bytes(held)], [])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "file long, block long, payload binary, first long, ids array<long>")


def read_flat(spark: SparkSession, path: str, width: str = WIDTH) -> DataFrame:
    """Blocks ``(file, block, payload)`` of raw files below ``path``, each of at most 2 GB; ``file`` is the file's path."""
    size = BLOCK_TOKENS * np.dtype(width).itemsize
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                data = memoryview(content.as_buffer())
                for block, begin in enumerate(range(0, len(data), size)):
                    part = [pa.array([file]), pa.array([block], pa.int64()), pa.array([bytes(data[begin : begin + size])], pa.binary())]
                    yield pa.RecordBatch.from_arrays(part, names=["file", "block", "payload"])

    return files.mapInArrow(cut, "file string, block long, payload binary")


def summaries(blocks: DataFrame, separator: int, width: str = WIDTH) -> DataFrame:
    """Per block: its tokens ``n``, separators ``count``, the places of the first and last one, and the lengths between."""

    def compute(batch):
        out = {"n": [], "count": [], "head": [], "last": [], "inner": []}
        for payload in batch.column("payload"):
            ids = np.frombuffer(payload.as_buffer(), width) if payload.is_valid else np.zeros(0, width)
            at = np.flatnonzero(ids == separator)
            out["n"].append(len(ids))
            out["count"].append(len(at))
            out["head"].append(int(at[0]) if len(at) else None)
            out["last"].append(int(at[-1]) if len(at) else None)
            out["inner"].append((np.diff(at) - 1).tolist())
        return out

    new = [StructField(c, LongType()) for c in ("n", "count", "head", "last")] + [StructField("inner", ArrayType(LongType()))]
    return map_batches(blocks.select("file", "block", "payload"), compute, new).drop("payload")


def document_lengths(parts: DataFrame) -> DataFrame:
    """``(file, number, n_tokens, closed)`` of each document, from written :func:`summaries`.

    The prefix scan has two levels, so no task holds more than a segment of blocks or one row per
    segment of a file. What follows the last separator of a file is a document that isn't closed.
    """
    parts = parts.withColumn("segment", F.expr(f"block div {SEGMENT_BLOCKS}"))
    inside = Window.partitionBy("file", "segment").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    local = parts.withColumn("start", F.coalesce(F.sum("n").over(inside), zero)).withColumn("earlier", F.coalesce(F.sum("count").over(inside), zero))
    # where the document began that is open at the start of the block: behind the last separator before it
    local = local.withColumn("begin", F.max(F.col("start") + F.col("last") + 1).over(inside))
    ends = local.groupBy("file", "segment").agg(
        F.sum("n").alias("tokens"), F.sum("count").alias("docs"), F.max(F.col("start") + F.col("last") + 1).alias("behind"), F.max("block").alias("top")
    )
    before = Window.partitionBy("file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("offset", F.coalesce(F.sum("tokens").over(before), zero)).withColumn("docs_before", F.coalesce(F.sum("docs").over(before), zero))
    ends = ends.withColumn("open_from", F.coalesce(F.max(F.col("offset") + F.col("behind")).over(before), zero))
    whole = Window.partitionBy("file")
    ends = ends.withColumn("final", F.col("top") == F.max("top").over(whole))
    joined = local.join(ends.select("file", "segment", "offset", "docs_before", "open_from", "top", "final"), ["file", "segment"])
    began = F.coalesce(F.col("offset") + F.col("begin"), F.col("open_from"))
    head = F.col("offset") + F.col("start") + F.col("head") - began
    closed = F.when(F.col("count") > 0, F.concat(F.array(head), "inner")).otherwise(F.array().cast("array<bigint>"))
    # at the end of the file: what is behind its last separator
    behind = F.col("n") - F.coalesce(F.col("last") + 1, F.lit(0)) + F.when(F.col("count") > 0, 0).otherwise(F.col("offset") + F.col("start") - began)
    at_end = F.col("final") & (F.col("block") == F.col("top")) & (behind > 0)
    rows = F.concat(
        F.transform(closed, lambda v: F.struct(v.alias("n_tokens"), F.lit(True).alias("closed"))),
        F.when(at_end, F.array(F.struct(behind.alias("n_tokens"), F.lit(False).alias("closed")))).otherwise(
            F.array().cast("array<struct<n_tokens:bigint,closed:boolean>>")
        ),
    )
    each = joined.select("file", (F.col("docs_before") + F.col("earlier")).alias("from"), F.posexplode(rows).alias("at", "doc"))
    return each.select("file", (F.col("from") + F.col("at")).alias("number"), "doc.n_tokens", "doc.closed")


def count_tokens(blocks: DataFrame, separator: int, width: str = WIDTH) -> DataFrame:
    """Token count of each document of the flat files in ``blocks``; an empty block or file has none."""
    return document_lengths(written(summaries(blocks, separator, width), "scan-blocks"))


def token_counts(docs: DataFrame, path: str, pattern: str, separator: int) -> DataFrame:
    """Tokens of every document, counted in flat files that are first written from the texts."""
    flat = written(write_flat(docs, path, pattern, separator), "flat")
    counted = count_tokens(flat.filter("payload IS NOT NULL"), separator)
    held = flat.filter("ids IS NOT NULL").select("file", "first", F.posexplode("ids").alias("at", "doc_id"))
    held = held.select("file", (F.col("first") + F.col("at")).alias("number"), "doc_id")
    return held.join(counted, ["file", "number"]).select("doc_id", "file", "number", "n_tokens")
