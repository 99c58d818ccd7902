"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The white space of every word split here: space, tab, LF, VT, FF and CR. Any other character is part of a word.
WORD_REGEX = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session: the folder that the driver and all executors see.

    In local mode everything runs on one machine, so an unset folder is
    chosen there; on a cluster an unset folder is an error.
    """
    from tideline.session import checkpoint_root
    return checkpoint_root(spark).rstrip("/")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, with the writer's ``options``, and read back: its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a table that may be sent to every executor.
BROADCAST_BYTES = 32 << 20


def _held(kind: T.DataType, value: Column) -> Column:
    """Bytes that a value takes, about: its own for texts and arrays, 16 for others."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return 16 + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType)):
            return 16 + F.coalesce(F.aggregate(value, F.lit(0), lambda n, x: n + _held(kind.elementType, x).cast("int")), F.lit(0))
        return 16 + 64 * F.greatest(F.size(value), F.lit(0))
    return F.lit(16)


def few(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its rows take at most ``BROADCAST_BYTES``, read and added up.

    Otherwise Spark shuffles both sides. For joins whose other side is long texts.
    """
    size = sum((_held(f.dataType, F.col(f"`{f.name}`")) for f in df.schema.fields), F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES else df


def remainder(key: str, of: int) -> Column:
    """crc32 of a key written as text, modulo ``of``: the fold of a row (a null key is fold 0)."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(of)), F.lit(0).cast("long"))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def without(df: DataFrame, names: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without the columns that outputs of these names replace, in any case, but for those in ``keep``."""
    gone = {n.lower() for n in names} - {k.lower() for k in keep}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def with_fields(schema: T.StructType, **fields: str) -> T.StructType:
    """``schema`` and further nullable fields, given as name=type."""
    out = T.StructType(list(schema.fields))
    for name, kind in fields.items():
        out.add(name, kind)
    return out


def arrow_map(df: DataFrame, kept: list[str], value: Column, function, **fields: str) -> DataFrame:
    """Columns ``kept`` of ``df`` and new ones, given as name=type, by ``mapInArrow``.

    ``function`` gets record batches whose last column is ``value`` and yields
    batches with the new columns in its place. Names may hold any character.
    """
    plain = [f"__c{i}" for i in range(len(kept))]
    rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, plain)], value.alias("__value"))
    added = T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in fields.items()))
    return rows.mapInArrow(function, T.StructType([*rows.drop("__value").schema.fields, *added.fields])).toDF(*kept, *fields)
