"""Avro schemas.

* :func:`avro_schema` / :func:`avro_fields` - an Avro record schema for a
  DataFrame schema; every field is a nullable union ``[T, "null"]``. Types are
  matched on the Spark type class (the original helper looked them up by a type name
  that never matched, and swapped ``name`` and ``namespace``; both fixed).
* :func:`json_field_types` - the Avro type of every key of a column of JSON
  object texts, inferred over *all* rows with one grouped aggregate.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# --- fixed values: Spark type -> Avro primitive ----------------------------
# Timestamps become long (microseconds since the epoch, no logical type).
AVRO_PRIMITIVES = [
    (StringType, "string"),
    (LongType, "long"),
    (IntegerType, "int"),
    (BooleanType, "boolean"),
    (FloatType, "float"),
    (DoubleType, "double"),
    (TimestampType, "long"),
]
# ---------------------------------------------------------------------------
EXTRA_PRIMITIVES = [
    (TimestampNTZType, "long"),
    (ShortType, "int"),
    (ByteType, "int"),
    (DateType, "int"),
    (BinaryType, "bytes"),
]


def _avro_type(dt: DataType, name: str):
    """Avro type of a field; name is its path, which makes the names of nested records unique."""
    for cls, avro in AVRO_PRIMITIVES + EXTRA_PRIMITIVES:
        if isinstance(dt, cls):
            return avro
    if isinstance(dt, DecimalType):
        return {"type": "bytes", "logicalType": "decimal", "precision": dt.precision, "scale": dt.scale}
    if isinstance(dt, ArrayType):
        return {"type": "array", "items": [_avro_type(dt.elementType, name), "null"]}
    if isinstance(dt, MapType):
        if not isinstance(dt.keyType, StringType):
            raise TypeError(f"Avro maps need string keys: {name}")
        return {"type": "map", "values": [_avro_type(dt.valueType, name), "null"]}
    if isinstance(dt, StructType):
        return {"type": "record", "name": f"{name}_record", "fields": _fields(dt, f"{name}.")}
    raise TypeError(f"no Avro type for {dt.simpleString()} ({name})")


def _fields(schema: StructType, path: str = "") -> list[dict]:
    # a path's dots become underscores; underscores in names are doubled before, so no two paths meet
    prefix = path.replace(".", "_")
    return [{"name": f.name, "type": [_avro_type(f.dataType, prefix + f.name.replace("_", "__")), "null"]} for f in schema.fields]


def avro_schema(schema: StructType, name: str, namespace: str, schema_type: str = "record") -> str:
    """Avro schema JSON text for a Spark schema."""
    return json.dumps({"type": schema_type, "name": name, "namespace": namespace, "fields": _fields(schema)})


def avro_fields(df: DataFrame) -> DataFrame:
    """Field table of Y1 with the observed null count of every field.

    The Avro types come from the schema; the null counts (one aggregate pass
    over all columns) show which unions actually carry nulls.
    """
    fields = _fields(df.schema)
    counts = df.agg(*[F.count_if(F.col(f"`{f['name']}`").isNull()).alias(f"n{i}") for i, f in enumerate(fields)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(f["name"]).alias("name"),
                F.lit(json.dumps(f["type"])).alias("avro_type"),
                F.col(f"n{i}").cast("bigint").alias("n_null"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(F.inline(rows))


def _value_class(value: Column) -> Column:
    """Avro class of one JSON value, from its variant alone."""
    kind = F.schema_of_variant(value)
    # a JSON number is integral when it has neither fraction nor exponent
    integral = (kind == "BIGINT") | kind.rlike(r"^DECIMAL\(\d+,0\)$")
    as_long = F.try_variant_get(value, "$", "bigint")
    number = (
        F.when(integral & as_long.between(-(2**31), 2**31 - 1), "int")
        .when(integral & as_long.isNotNull(), "long")
        .otherwise("double")
    )
    return (
        F.when(value.isNull() | (kind == "VOID"), "null")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), number)
        .otherwise("string")
    )


def json_objects(df: DataFrame, json_col: str) -> Column:
    """The text as a map of variants, each text parsed once; null where it is no JSON object."""
    return F.from_json(F.col(json_col), "map<string,variant>")


def broken_payloads(df: DataFrame, json_col: str) -> DataFrame:
    """The rows whose payload is not null and no JSON object: what ``json_field_types`` cannot see."""
    return df.where(F.col(json_col).isNotNull() & json_objects(df, json_col).isNull())


def json_field_types(df: DataFrame, json_col: str) -> DataFrame:
    """Per key of the JSON objects in ``json_col``: Avro type (nullable union),
    non-null and null counts (Y2). Broken payloads have no keys; ``broken_payloads`` has them.

    Per value: null -> null, boolean -> boolean, integer -> int (long beyond
    32 bits), other number -> double, text -> string, object/array -> string.
    Per key over rows: one class -> it; int and long -> long; integers and
    doubles -> double; any other mix, or only nulls -> string.
    """
    exploded = df.select(F.explode(json_objects(df, json_col)).alias("key", "value"))
    classes = exploded.select("key", _value_class(F.col("value")).alias("cls"))
    kinds = ["int", "long", "double", "boolean", "string"]
    per_key = classes.groupBy("key").agg(
        F.count_if(F.col("cls") != "null").cast("bigint").alias("n_values"),
        F.count_if(F.col("cls") == "null").cast("bigint").alias("n_null"),
        *[F.max((F.col("cls") == k).cast("int")).alias(f"has_{k}") for k in kinds],
    )
    has = {k: F.col(f"has_{k}") == 1 for k in kinds}
    n_kinds = sum((F.col(f"has_{k}") for k in kinds[1:]), F.col("has_int"))
    single = F.lit(None).cast("string")
    for k in kinds:
        single = F.when(has[k], F.lit(k)).otherwise(single)
    merged = (
        F.when(n_kinds == 0, "string")
        .when(n_kinds == 1, single)
        .when(~has["double"] & ~has["boolean"] & ~has["string"], "long")
        .when(~has["boolean"] & ~has["string"], "double")
        .otherwise("string")
    )
    return per_key.select(
        F.col("key").alias("field"),
        F.concat(F.lit('["null", "'), merged, F.lit('"]')).alias("avro_type"),
        "n_values",
        "n_null",
    )


def json_record_schema(df: DataFrame, json_col: str, name: str, namespace: str) -> DataFrame:
    """The Avro record schema of the payloads (Y2): one row, ``schema`` as JSON text with
    the fields in order of their names, and ``n_broken`` payloads that are no JSON object."""
    field = F.struct(F.col("field").alias("name"), F.from_json("avro_type", "array<string>").alias("type"))
    fields = json_field_types(df, json_col).agg(F.array_sort(F.collect_list(field)).alias("fields"))
    record = F.struct(F.lit("record").alias("type"), F.lit(name).alias("name"), F.lit(namespace).alias("namespace"), "fields")
    n = broken_payloads(df, json_col).agg(F.count(F.lit(1)).alias("n")).scalar()
    return fields.select(F.to_json(record).alias("schema"), n.alias("n_broken"))
