"""Dynamic JSON values as typed fields."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import by_value

# Variant type name -> field type.
FIELD_TYPES = {
    "OBJECT": "MAP", "ARRAY": "LIST", "STRING": "STRING", "BOOLEAN": "BOOLEAN", "BIGINT": "LONG",
    "DOUBLE": "DOUBLE", "FLOAT": "FLOAT", "DECIMAL": "DECIMAL", "BINARY": "BYTE_ARRAY",
    "DATE": "DATETIME", "TIMESTAMP": "DATETIME", "TIMESTAMP_NTZ": "DATETIME", "UUID": "STRING", "VOID": "STRING",
}


def is_number(payload: Column, path: str = "$.value") -> Column:
    """True when the JSON text holds a number at ``path``; text, booleans and null are none."""
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(payload), path, "variant"))
    return F.coalesce(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False))


def field_type(value: Column) -> Column:
    """Field type of a VARIANT; an unknown type raises."""
    head = F.regexp_extract(F.schema_of_variant(value), "^[A-Z_]+", 0)
    names = F.create_map(*[F.lit(x) for pair in FIELD_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, head),
                      F.raise_error(F.concat(F.lit("type not recognised: "), head)).cast("string"))


class _Number(str):
    """A number as the text has it."""


def _walk(payload: str):
    """(path, kind, text) of every node below a JSON text; a number stays as it is written."""
    decoder = json.JSONDecoder(parse_int=_Number, parse_float=_Number)
    root, _ = decoder.raw_decode(payload.lstrip())
    left = [("", root)]
    while left:
        path, node = left.pop()
        if isinstance(node, dict):
            yield path, "MAP", None
            left.extend((f"{path}/{key}", child) for key, child in node.items())
        elif isinstance(node, list):
            yield path, "LIST", None
            left.extend((f"{path}[{i}]", child) for i, child in enumerate(node))
        elif isinstance(node, _Number):
            yield path, "NUMBER", str(node)
        elif isinstance(node, bool):
            yield path, "BOOLEAN", "true" if node else "false"
        else:
            yield path, "STRING", node


def _utf8(text: str | None) -> str | None:
    # Half a surrogate pair, which an escape may name, is no character.
    return text if text is None or text.isascii() else text.encode("utf-8", "replace").decode()


def typed_fields(df: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """Every node below the JSON text as (keys, path, type, value); containers have a null value.

    A path has ``/name`` for a field and ``[i]`` for an element. Texts that are no JSON give no rows. One pass: each text
    is walked where it is read, to any depth; what a number is, its own text tells.
    """
    fields = df.select(*keys).schema

    def run(batches):
        for batch in batches:
            rows, paths, kinds, texts = [], [], [], []
            for i, text in enumerate(batch.column("__payload").to_pylist()):
                for path, kind, value in _walk(text):
                    rows.append(i)
                    paths.append(_utf8(path))
                    kinds.append(kind)
                    texts.append(_utf8(value))
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(at) for i in range(len(keys))), pa.array(paths, pa.string()),
                 pa.array(kinds, pa.string()), pa.array(texts, pa.string())], names=[*keys, "path", "__kind", "__text"])

    out = T.StructType([*fields, *(T.StructField(n, T.StringType()) for n in ("path", "__kind", "__text"))])
    valid = df.where(F.try_parse_json(payload).isNotNull()).select(*keys, F.col(payload).alias("__payload"))
    nodes = valid.mapInArrow(run, out)
    number = F.try_parse_json(F.when(F.col("__kind") == "NUMBER", F.col("__text")))
    return nodes.select(
        *keys, "path", F.when(number.isNull(), F.col("__kind")).otherwise(field_type(number)).alias("type"),
        F.when(number.isNull(), F.col("__text")).otherwise(F.try_variant_get(number, "$", "string")).alias("value"))


by_value(__name__)
