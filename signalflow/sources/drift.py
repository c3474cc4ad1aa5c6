"""JSON whose fields and types change from batch to batch.

A batch is stored as it came, as one ``VARIANT`` column beside its keys, and the fields found in it are noted
in a ledger. Reading makes a column of every field of every batch: a field that appears later is NULL in
earlier batches, and no stored file is rewritten for it. What comes to the driver is the schema, never rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalflow.session import literal_rows
from signalflow.sources.flatten import snake_case

# A batch's rows are stored under a text that partition discovery does not take for a number or a date.
PREFIX = "batch-"
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.FloatType, T.DoubleType)

Path = tuple[str, ...]


def parsed(df: DataFrame, raw: str, into: str = "doc") -> DataFrame:
    """Replace the JSON text ``raw`` by the variant ``into``; NULL where it is no JSON."""
    return df.withColumn(into, F.try_parse_json(raw)).drop(*{raw} - {into})


def schema_text(df: DataFrame, doc: str = "doc") -> str:
    """The merged schema of all objects in ``doc`` as one text; other values than objects have no fields."""
    objects = df.filter(F.schema_of_variant(doc).startswith("OBJECT<"))
    return objects.agg(F.schema_of_variant_agg(doc)).first()[0]


def _leaves(schema: T.StructType, above: Path = ()) -> Iterator[tuple[Path, T.DataType]]:
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            yield from _leaves(f.dataType, (*above, f.name))
        elif not isinstance(f.dataType, T.NullType):
            yield (*above, f.name), f.dataType


def fields(text: str) -> list[tuple[Path, T.DataType]]:
    """Path and type of every field with a value; a field of mixed types within the batch is a variant."""
    if not text.startswith("OBJECT<"):
        return []
    # quoted names are left as they are
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: m[0] if m[0][0] == "`" else "STRUCT<", text)
    return list(_leaves(T.DataType.fromDDL(ddl)))


def _stored(dtype: T.DataType) -> T.DataType:
    """The type a column of this field gets: what has no single type, or no value yet, is text."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_stored(dtype.elementType))
    if isinstance(dtype, T.StructType) and dtype.fields:
        return T.StructType([T.StructField(f.name, _stored(f.dataType)) for f in dtype.fields])
    return T.StringType() if isinstance(dtype, (T.VariantType, T.NullType, T.StructType)) else dtype


def common_type(types: Sequence[T.DataType]) -> T.DataType:
    """One type that holds the values of all: itself if they agree, a number if all are, else text."""
    kinds = [_stored(t) for t in types]
    if all(k == kinds[0] for k in kinds):
        return kinds[0]
    if not all(isinstance(k, _NUMBERS) for k in kinds):
        return T.StringType()
    if any(isinstance(k, (T.FloatType, T.DoubleType)) for k in kinds):
        return T.DoubleType()
    exact = [k if isinstance(k, T.DecimalType) else T.DecimalType(19, 0) for k in kinds]
    scale = max(d.scale for d in exact)
    digits = max(d.precision - d.scale for d in exact) + scale
    return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()


def _step(name: str) -> str:
    quote = '"' if "'" in name else "'"
    if quote in name:
        raise ValueError(f"a variant path cannot name the field {name!r}")
    return f"[{quote}{name}{quote}]"


def _value(doc: str, path: Path, dtype: T.DataType) -> Column:
    ddl = T.StructType([T.StructField("x", dtype)]).toDDL().split(" ", 1)[1]
    return F.try_variant_get(F.col(doc), "$" + "".join(_step(p) for p in path), ddl)


def columns(found: Sequence[tuple[Path, T.DataType]], doc: str = "doc") -> dict[str, Column]:
    """A column ``parent__child`` per field, in order of first appearance.

    Fields whose names differ only in their spelling share a column. A field that is an object in one batch and a
    value in another has columns of both kinds; values of mixed types are text, objects among them JSON.
    """
    by_name: dict[str, dict[Path, list[T.DataType]]] = {}
    for path, dtype in found:
        name = "__".join(snake_case(p) for p in path)
        by_name.setdefault(name, {}).setdefault(path, []).append(dtype)
    out = {}
    for name, paths in by_name.items():
        dtype = common_type([t for types in paths.values() for t in types])
        out[name] = F.coalesce(*[_value(doc, path, dtype) for path in paths])
    return out


def land_batch(df: DataFrame, path: str, batch: str, raw: str, key: Sequence[str] = ()) -> None:
    """Store a batch and then its fields; a batch that is landed again replaces itself.

    The ledger entry comes last, so a batch whose job was lost half way is not read.
    """
    place = f"batch={PREFIX}{batch}"
    rows = f"{path}/rows/{place}"
    parsed(df.select(*key, F.col(raw).alias("doc")), "doc").write.mode("overwrite").parquet(rows)
    spark = df.sparkSession
    text = schema_text(spark.read.parquet(rows))
    literal_rows(spark, ("fields",), [(text,)]).write.mode("overwrite").parquet(f"{path}/fields/{place}")


def read_drifting(spark: SparkSession, path: str, key: Sequence[str] = ()) -> DataFrame:
    """All landed batches as one table: the keys, then a column per field of any batch.

    Batches are read in order of their names. Rows that are no JSON object keep their keys and have NULLs. A field
    named like a key is ``doc__`` and its name.
    """
    ledger = spark.read.parquet(f"{path}/fields").orderBy("batch").collect()  # a row per batch: names and types only
    found = [leaf for row in ledger for leaf in fields(row.fields)]
    rows = spark.read.parquet(f"{path}/rows").filter(F.col("batch").isin([row.batch for row in ledger]))
    taken = {k.lower() for k in key}
    named = {f"doc__{n}" if n in taken else n: c for n, c in columns(found).items()}
    return rows.select(*[F.col(f"`{k}`") for k in key], *[c.alias(n) for n, c in named.items()])
