"""JSON documents as tables of nodes, and canonical JSON."""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

NODE = T.StructType(
    [
        T.StructField("path", T.StringType()),  # a.b.0.c
        T.StructField("index_path", T.StringType()),  # a.b[0].c
        T.StructField("wild", T.StringType()),  # a.b.[].c
        T.StructField("sort_path", T.StringType()),  # segments, array positions zero-padded
        T.StructField("kind", T.StringType()),
        T.StructField("text", T.StringType()),  # string value, or JSON text of another scalar
        T.StructField("number", T.DoubleType()),
        T.StructField("length", T.LongType()),  # characters of a string, items of an array
        T.StructField("keys", T.ArrayType(T.StringType())),  # keys of an object, in document order
        T.StructField("key", T.StringType()),  # the node's own key in its object
    ]
)


def _walk(value, path, index_path, wild, sort_path, key, out):
    kind, text, number, length, keys = "null", None, None, None, None
    children = ()
    if isinstance(value, str):
        kind, text, length = "string", value, len(value)
    elif isinstance(value, bool):
        kind, text = "boolean", "true" if value else "false"
    elif isinstance(value, (int, float)):
        kind, text, number = "number", json.dumps(value), float(value)
    elif isinstance(value, list):
        kind, length = "array", len(value)
        children = [(str(i), f"[{i}]", "[]", f"{i:09d}", None, item) for i, item in enumerate(value)]
    elif isinstance(value, dict):
        kind, keys = "object", list(value)
        children = [(k, f".{k}", k, k, k, item) for k, item in value.items()]
    out.append((path, index_path, wild, sort_path, kind, text, number, length, keys, key))
    for name, indexed, wildcard, sortable, own, item in children:
        _walk(
            item,
            f"{path}.{name}" if path else name,
            index_path + indexed,
            f"{wild}.{wildcard}" if wild else wildcard,
            f"{sort_path}\x01{sortable}" if sort_path else sortable,
            own,
            out,
        )


def walk(text: str) -> list[tuple]:
    """All nodes of a JSON text in document order; a single ``invalid`` node with the text when it is not JSON."""
    out: list[tuple] = []
    try:
        value = json.loads(text)
    except (TypeError, ValueError):
        return [("", "", "", "", "invalid", text if isinstance(text, str) else None, None, None, None, None)]
    _walk(value, "", "", "", "", None, out)
    return out


_NAMES = [f.name for f in NODE.fields]


#: Texts of an Arrow batch that are Python objects at a time.
SLICE = 64


def _each(kind: T.DataType, fn: Callable, *columns: pa.Array) -> pa.Array:
    """``fn`` of every row, a few rows at a time, so that a batch of long texts is never held as Python objects."""
    arrow = to_arrow_type(kind)
    parts = [pa.array([], arrow)]
    for at in range(0, len(columns[0]), SLICE):
        parts.append(pa.array([fn(*row) for row in zip(*[c.slice(at, SLICE).to_pylist() for c in columns])], arrow))
    return pa.concat_arrays(parts)


@F.arrow_udf(T.ArrayType(NODE))
def _nodes(texts: pa.Array) -> pa.Array:
    return _each(T.ArrayType(NODE), lambda t: [dict(zip(_NAMES, node)) for node in walk(t)], texts)


def json_nodes(df: DataFrame, json_col: str, *keep: str) -> DataFrame:
    """One row per JSON node: the kept columns, ``ord`` (document order) and the node fields."""
    return (
        df.select(*keep, F.posexplode(_nodes(F.col(json_col))).alias("ord", "node")).select(*keep, "ord", "node.*")
    )


@F.udtf(returnType=T.StructType([T.StructField("ord", T.IntegerType()), *NODE.fields]))
class JsonNodes:
    """Table function form: ``SELECT ... FROM docs, LATERAL json_nodes(docs.body)``."""

    def eval(self, text: str):
        for position, node in enumerate(walk(text)):
            yield (position, *node)


def register_json_nodes(spark, name: str = "json_nodes") -> None:
    spark.udtf.register(name, JsonNodes)


@F.arrow_udf(T.StringType())
def canonical_json(texts: pa.Array) -> pa.Array:
    """Key-sorted compact JSON with ASCII escapes; null for text that is not JSON."""

    def canon(t):
        try:
            return json.dumps(json.loads(t), sort_keys=True, separators=(",", ":"))
        except (TypeError, ValueError):
            return None

    return _each(T.StringType(), canon, texts)


def json_hash(col: Column) -> Column:
    """sha256 of the canonical JSON of a JSON text."""
    return F.sha2(canonical_json(col), 256)


@F.arrow_udf(T.StringType())
def sorted_json(texts: pa.Array) -> pa.Array:
    """Key-sorted JSON with default separators; ``{}`` for null."""
    return _each(T.StringType(), lambda t: json.dumps(json.loads(t), sort_keys=True) if t else "{}", texts)


@F.arrow_udf(T.StringType())
def merge_json(base: pa.Array, updates: pa.Array) -> pa.Array:
    """Top-level keys of ``updates`` replace those of ``base``."""

    def merged(b, u):
        return json.dumps({**json.loads(b or "{}"), **json.loads(u or "{}")}, ensure_ascii=False)

    return _each(T.StringType(), merged, base, updates)


@F.arrow_udf(T.StringType())
def drop_null_fields(texts: pa.Array) -> pa.Array:
    """Top-level null fields removed from a JSON object."""

    def dropped(t):
        if t is None:
            return "{}"
        return json.dumps({k: v for k, v in json.loads(t).items() if v is not None}, ensure_ascii=False)

    return _each(T.StringType(), dropped, texts)
