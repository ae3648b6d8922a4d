"""JSON that is not quite JSON: fenced, with trailing commas, bare keys, Python literals, single backslashes, cut off, or several objects in a row."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_ESCAPE = re.compile(r'\\(?!["\\/bfnrtu])')
_TRAILING = re.compile(r",(\s*[}\]])")
_BARE_KEY = re.compile(r"([{,]\s*)([A-Za-z_]\w*)(\s*:)")
_LITERALS = (("True", "true"), ("False", "false"), ("None", "null"))


def objects(text: str | None) -> tuple[list[dict], bool]:
    """All objects of a text in order, and whether a tail was left that is none."""
    found: list[dict] = []
    text = text or ""
    decoder = json.JSONDecoder(strict=False)
    at, bad = text.find("{"), False
    while at >= 0:
        try:
            value, end = decoder.raw_decode(text, at)
            found.append(value)
            at = text.find("{", end)
        except ValueError:
            end = _balanced(text, at)
            value = _repaired(text[at:end]) if end else None
            if value is None:
                bad = True
                break
            found.append(value)
            at = text.find("{", end)
    return found, bad


def _balanced(text: str, at: int) -> int:
    """End of the object that begins at ``at``; 0 if it never closes.  Braces inside strings don't count."""
    depth, quoted, skip = 0, False, False
    for k in range(at, len(text)):
        sign = text[k]
        if skip:
            skip = False
        elif quoted:
            skip = sign == "\\"
            quoted = sign != '"'
        elif sign == '"':
            quoted = True
        elif sign == "{":
            depth += 1
        elif sign == "}":
            depth -= 1
            if not depth:
                return k + 1
    return 0


def _repaired(text: str) -> dict | None:
    steps = (
        lambda s: _ESCAPE.sub(r"\\\\", s),
        lambda s: _TRAILING.sub(r"\1", s),
        lambda s: s if '"' in s else s.replace("'", '"'),
        lambda s: _BARE_KEY.sub(r'\1"\2"\3', s),
        _literals,
    )
    for step in steps:
        text = step(text)
        try:
            value = json.loads(text, strict=False)
            return value if isinstance(value, dict) else None
        except ValueError:
            continue
    return None


def _literals(text: str) -> str:
    for python, plain in _LITERALS:
        text = re.sub(rf"(?<=[:\[,\s]){python}(?=[,\]}}\s])", plain, text)
    return text


def explode_objects(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, ordinal, object, bad_tail): a row for each object of ``column`` as compact JSON; a text without any has ordinal null."""
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("ordinal", T.IntegerType()), T.StructField("object", T.StringType()), T.StructField("bad_tail", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [])
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, bad = objects(text)
                for n, value in enumerate(found, 1) if found else [(None, None)]:
                    made = None if value is None else json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
                    for column_, x in zip(rows, (k, n, made, bad), strict=True):
                        column_.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], batch.column(0).type), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.string()), pa.array(rows[3], pa.bool_())], names=[key, "ordinal", "object", "bad_tail"]
            )

    return df.select(key, column).mapInArrow(run, schema)
