"""Decoding and encoding of record values: struct columns, JSON text or Avro bytes."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewflow.spec import SpecError

# Fixed value: environment variable that overrides the encoding of written values.
VALUE_CODEC_ENV = "PRODUCER_VALUE_SERDE"
CODECS = ("struct", "json", "avro")

# Spark type -> Avro type name.
_AVRO_NAMES = {
    T.StringType: "string",
    T.BinaryType: "bytes",
    T.BooleanType: "boolean",
    T.IntegerType: "int",
    T.LongType: "long",
    T.FloatType: "float",
    T.DoubleType: "double",
}
# Spark type -> Avro type and the meaning it carries.
_AVRO_MEANINGS = {
    T.DateType: ("int", "date"),
    T.TimestampType: ("long", "timestamp-micros"),
    T.TimestampNTZType: ("long", "local-timestamp-micros"),
}


def avro_schema(schema: T.StructType, name: str = "record") -> str:
    """The Avro schema text of a view schema; a nullable field, element or value becomes a union with null."""

    def maybe(data_type: T.DataType, nullable: bool, path: str) -> object:
        avro_type = convert(data_type, path)
        return ["null", avro_type] if nullable else avro_type

    def convert(data_type: T.DataType, path: str) -> object:
        if isinstance(data_type, T.ArrayType):
            return {"type": "array", "items": maybe(data_type.elementType, data_type.containsNull, path)}
        if isinstance(data_type, T.MapType):
            return {"type": "map", "values": maybe(data_type.valueType, data_type.valueContainsNull, path)}
        if isinstance(data_type, T.StructType):
            # Each record has a name of its own: the path that leads to it.
            fields = [
                {"name": f.name, "type": maybe(f.dataType, f.nullable, f"{path}_{f.name}")} for f in data_type.fields
            ]
            return {"type": "record", "name": path, "fields": fields}
        if isinstance(data_type, T.DecimalType):
            meaning = {"logicalType": "decimal", "precision": data_type.precision, "scale": data_type.scale}
            return {"type": "bytes", **meaning}
        if type(data_type) in _AVRO_MEANINGS:
            stored, meaning = _AVRO_MEANINGS[type(data_type)]
            return {"type": stored, "logicalType": meaning}
        if type(data_type) not in _AVRO_NAMES:
            raise SpecError(f"no Avro type for {data_type.simpleString()}")
        return _AVRO_NAMES[type(data_type)]

    return json.dumps(convert(schema, name))


def _avro():
    # The functions import without the connector and fail only when Spark resolves them.
    from pyspark.sql.avro.functions import from_avro, to_avro

    return from_avro, to_avro


def _check(codec: str) -> str:
    if codec not in CODECS:
        raise SpecError(f"unknown codec {codec!r}; known are {', '.join(CODECS)}")
    return codec


def decode_value(
    records: DataFrame, schema: T.StructType | str, codec: str = "struct", on_error: str = "FAILFAST"
) -> DataFrame:
    """Turn the raw ``value`` into a struct. A value that does not fit the schema fails the job;
    with ``on_error="PERMISSIVE"`` it becomes nulls."""
    codec = _check(codec)
    if codec == "struct":
        return records
    if codec == "json":
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        decoded = F.from_json(F.col("value").cast("string"), schema, {"mode": on_error})
    else:
        from_avro, _ = _avro()
        text = schema if isinstance(schema, str) else avro_schema(schema)
        decoded = from_avro(F.col("value"), text, {"mode": on_error})
    return records.withColumn("value", decoded)


def encode_value(records: DataFrame, codec: str | None = None) -> DataFrame:
    """Encode the ``value`` struct for a sink. The environment variable, if set, decides."""
    codec = _check(os.environ.get(VALUE_CODEC_ENV) or codec or "struct")
    if codec == "struct":
        return records
    if codec == "json":
        return records.withColumn("value", F.to_json("value"))
    _, to_avro = _avro()
    return records.withColumn("value", to_avro(F.col("value"), avro_schema(records.schema["value"].dataType)))
