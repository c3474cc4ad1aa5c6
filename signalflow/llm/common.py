"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from signalflow.session import written

# Rows of an Arrow batch that are worked on together: a batch of long texts is never held twice as a whole.
ROWS_AT_ONCE = 1000

# What separates words wherever an operator speaks of words: ASCII white space only.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(batches: Iterator[pa.RecordBatch], done: Callable[[], None] | None = None) -> Iterator[pa.RecordBatch]:
    """Short stretches of the batches of a partition; when they end, ``done`` frees what was kept for it."""
    try:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                yield batch.slice(start, ROWS_AT_ONCE)
    finally:
        if done is not None:
            done()
        pa.default_memory_pool().release_unused()


def whole_rows(df: DataFrame) -> Column:
    """All columns of ``df`` as one, so that an operator's own columns can't clash with them; ``select("row.*")`` is the way back."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def map_batches(
    df: DataFrame, compute: Callable[[pa.RecordBatch], dict], new: Sequence[StructField], done: Callable[[], None] | None = None
) -> DataFrame:
    """Append columns that ``compute`` makes from Arrow batches; they replace columns of the same name.

    ``compute`` gets all columns of a stretch of rows, also those it replaces, and returns a list for every new
    field. ``done`` is called at the end of a partition: a worker lives on, and must not keep what it no longer needs.
    """
    names = {f.name.lower() for f in new}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    schema = StructType([*kept, *new])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in new]
        for batch in slices(batches, done):
            made = compute(batch)
            arrays = [batch.column(f.name) for f in kept]
            arrays += [pa.array(made[f.name], type=t) for f, t in zip(new, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df.mapInArrow(apply, schema)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` of an undirected graph given as rows ``(a, b)``; the component is its smallest node.

    Alternates between hooking every node's root to the smallest root seen over an edge and
    shortening the chains of parents, so the number of rounds grows with the logarithm of the
    diameter. Every round is a few shuffled joins and sums with map-side combine, written to the
    shared folder; nothing but one count per round comes to the driver. NULL ends are ignored.
    """
    both = edges.select(F.col("a"), F.col("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    links = written(both.union(both.select("b", "a")).filter("a <> b").distinct(), f"{label}-links")
    parents = written(links.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), f"{label}-roots")
    while True:
        # edges between the roots of both ends, then the smallest root each root touches
        ends = links.join(parents.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
        ends = ends.join(parents.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").filter("ra > rb")
        hooks = written(ends.groupBy(F.col("ra").alias("root")).agg(F.min("rb").alias("lower")), f"{label}-hooks")
        if hooks.isEmpty():
            return parents.select("node", F.col("root").alias("component"))
        # follow the hooks from root to root to their end
        while True:
            above = hooks.select(F.col("root").alias("lower"), F.col("lower").alias("next"))
            jumped = hooks.join(above, "lower", "left")
            if jumped.filter("next IS NOT NULL").isEmpty():
                break
            hooks = written(jumped.select("root", F.coalesce("next", "lower").alias("lower")), f"{label}-hooks")
        parents = written(
            parents.join(hooks, "root", "left").select("node", F.coalesce("lower", "root").alias("root")), f"{label}-roots"
        )
