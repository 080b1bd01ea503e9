"""Arrow schemas for frames made in Python tasks."""

from __future__ import annotations

import pyarrow as pa


def arrow_schema(text: str) -> pa.Schema:
    """The Arrow schema of a DDL text with the few types used here."""
    kinds = {
        "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(),
        "string": pa.string(), "boolean": pa.bool_(),
        "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
        "array<string>": pa.list_(pa.string()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in text.split(", "))])
