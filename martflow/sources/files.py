"""Delimited files and JSON payloads.

Files are read with a declared schema wherever the target table's DDL is
known; ``FAILFAST`` makes a malformed value raise as the database COPY does
(the default PERMISSIVE mode would silently turn it into NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, NumericType, StructType

from martflow.functions.scalars import DOC_TS_FORMAT, to_json_keep_nulls


def read_csv_plain(spark: SparkSession, path: str, schema: str | StructType, sep: str = ";") -> DataFrame:
    """Headerless delimited file with an explicit ordered column list."""
    return (spark.read.option("mode", "FAILFAST").option("timestampNTZFormat", DOC_TS_FORMAT)
            .csv(path, sep=sep, header=False, schema=schema))


def read_csv_header(spark: SparkSession, path: str, schema: str | StructType, sep: str = ",") -> DataFrame:
    """CSV with a header; ``enforceSchema=False`` checks the header names
    against the declared schema instead of trusting positions."""
    return (spark.read.option("mode", "FAILFAST").option("enforceSchema", "false")
            .option("timestampNTZFormat", DOC_TS_FORMAT)
            .csv(path, sep=sep, header=True, schema=schema))


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """S3: header + inferred types (one extra pass over the files)."""
    return (spark.read.option("inferSchema", "true").option("timestampNTZFormat", DOC_TS_FORMAT)
            .option("preferDate", "false").csv(path, sep=sep, header=True))


def drop_leading(df: DataFrame, n: int = 1) -> DataFrame:
    """Drop the first ``n`` columns by position."""
    return df.select(*df.columns[n:])


def conform(df: DataFrame, target: str | StructType) -> DataFrame:
    """Insert by column name into a typed table: select the target's columns
    from ``df`` by name and cast to the declared types."""
    schema = target if isinstance(target, StructType) else StructType.fromDDL(target)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    (df.write.mode("errorifexists").option("timestampNTZFormat", DOC_TS_FORMAT)
     .csv(path, sep=sep, header=header))


def read_json_records(spark: SparkSession, path: str, schema: str | StructType, multi_line: bool = False) -> DataFrame:
    """JSON lines (or one JSON document per file with ``multi_line``); a line
    holding a JSON array yields one row per element."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=multi_line)


def land_json(records: DataFrame, id_field: str, update_ts: str) -> DataFrame:
    """API records -> staging rows (object_id, object_value JSON, update_ts).

    The payload is re-serialised with ``to_json`` (no string-built SQL, B24);
    ``update_ts`` is the load's as-of time."""
    return records.select(
        F.col(id_field).cast("string").alias("object_id"),
        to_json_keep_nulls(F.struct(*[F.col(c) for c in records.columns])).alias("object_value"),
        F.lit(update_ts).cast("timestamp_ntz").alias("update_ts"),
    )


ID_FIELDS = frozenset({"_id", "id"})


def with_text_ids(value: Column, kind: DataType, id_fields=ID_FIELDS, name: str = "") -> Column:
    """A value with its ids as text at every depth of structs, arrays and
    maps: object ids (12 bytes, or a struct of ``$oid`` alone) as their hex
    digits, and numbers in fields named as in ``id_fields``.  The rewrite
    follows the schema, so a row costs one projection and parts without ids
    stay as they are."""
    if isinstance(kind, StructType):
        if kind.fieldNames() == ["$oid"]:
            return value.getField("$oid").cast("string")
        fields = [with_text_ids(value.getField(f.name), f.dataType, id_fields, f.name).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields)) if _holds_ids(kind, id_fields) else value
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: with_text_ids(x, kind.elementType, id_fields)) if _holds_ids(kind, id_fields) else value
    if isinstance(kind, MapType):
        return F.transform_values(value, lambda _, x: with_text_ids(x, kind.valueType, id_fields)) if _holds_ids(kind, id_fields) else value
    if isinstance(kind, BinaryType):
        return F.lower(F.hex(value))
    return value.cast("string") if isinstance(kind, NumericType) and name in id_fields else value


def _holds_ids(kind: DataType, id_fields, name: str = "") -> bool:
    if isinstance(kind, StructType):
        return kind.fieldNames() == ["$oid"] or any(_holds_ids(f.dataType, id_fields, f.name) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _holds_ids(kind.elementType, id_fields)
    if isinstance(kind, MapType):
        return _holds_ids(kind.valueType, id_fields)
    return isinstance(kind, BinaryType) or (isinstance(kind, NumericType) and name in id_fields)


def normalise_docs(docs: DataFrame, id_col: str, ts_col: str) -> DataFrame:
    """Documents -> (object_id, object_value, update_ts) with ids as text
    and timestamps as 'yyyy-MM-dd HH:mm:ss' at every depth, NULL fields kept."""
    walked = [with_text_ids(F.col(f"`{f.name}`"), f.dataType, name=f.name).alias(f.name) for f in docs.schema.fields]
    ident = docs.schema[id_col]
    return docs.select(
        with_text_ids(F.col(id_col), ident.dataType, name=ident.name).cast("string").alias("object_id"),
        to_json_keep_nulls(F.struct(*walked)).alias("object_value"),
        F.col(ts_col).alias("update_ts"),
    )
