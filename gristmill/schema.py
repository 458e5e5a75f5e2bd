"""Schemas, declared once; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()  # noqa: E741


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


RAW = _struct(instruction=S, input=S, output=S, images=T.ArrayType(S))
ITEM = _struct(type=S, text=_struct(type=S, format=S, string=S), image=_struct(type=S, format=S, relative_path=S, width=I, height=I))
TURN = _struct(role=S, content=T.ArrayType(ITEM))
CANONICAL = _struct(meta_prompt=T.ArrayType(S), data=T.ArrayType(TURN))
META = _struct(id=S, domain=S, source=S, svg_len=L, gt_svg=S)
RECORD = T.StructType([T.StructField("instruction", S), T.StructField("_meta", META)])
EMBEDDED = _struct(id=S, embedding=T.ArrayType(T.FloatType()))
ENRICHED = _struct(id=S, instruction=S, status=S, response=S, error=S)
CALL_LOG = T.StructType([T.StructField("ts", T.TimestampType()), *_struct(url=S, model=S, status=S, prompt_tokens=I, completion_tokens=I, error=S).fields])
