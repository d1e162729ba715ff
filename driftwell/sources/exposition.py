"""Metrics in text exposition format: lines to samples, and samples to lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LINE = r"^([a-zA-Z_:][a-zA-Z0-9_:]*)(?:\{(.*)\})?\s+(\S+)(?:\s+(-?[0-9]+))?\s*$"
_LABEL = r'([a-zA-Z_][a-zA-Z0-9_]*)="((?:[^"\\]|\\.)*)"'


def _unescape(x: Column) -> Column:
    """Escaped backslashes, quotes and line breaks; a private character stands for a backslash meanwhile."""
    held = F.replace(x, F.lit("\\\\"), F.lit("\ue000"))
    return F.replace(F.replace(F.replace(held, F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n")), F.lit("\ue000"), F.lit("\\"))


def samples(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """name, labels (a map), value, ts (milliseconds, null if absent) of the sample lines; comments, blank and malformed lines give none."""
    x = F.col(line_col)
    number = F.regexp_extract(x, _LINE, 3)
    value = F.when(F.lower(number).isin("+inf", "inf"), float("inf")).when(F.lower(number) == "-inf", float("-inf")).when(F.lower(number) == "nan", float("nan")).otherwise(number.try_cast("double"))
    names, values = F.regexp_extract_all(F.regexp_extract(x, _LINE, 2), F.lit(_LABEL), F.lit(1)), F.regexp_extract_all(F.regexp_extract(x, _LINE, 2), F.lit(_LABEL), F.lit(2))
    stamp = F.regexp_extract(x, _LINE, 4).try_cast("bigint")
    rows = lines.where(x.rlike(_LINE) & ~x.startswith("#"))
    return rows.select(F.regexp_extract(x, _LINE, 1).alias("name"), F.map_from_arrays(names, F.transform(values, _unescape)).alias("labels"), value.alias("value"), stamp.alias("ts")).where("value IS NOT NULL")


def line(name: Column, labels: dict[str, Column], value: Column) -> Column:
    quoted = [F.concat(F.lit(k + '="'), F.replace(F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit('"')) for k, v in labels.items()]
    return F.concat(name, F.lit("{"), F.concat_ws(",", *quoted), F.lit("} "), value.cast("string"))
