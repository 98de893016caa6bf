"""Content digests: an order-free digest of a table as a multiset of rows, in a form that SQL can state.

A row is the text of its columns by name, joined by ``|``; its MD5 gives two numbers of 60 bits, and the digest is their
two sums with the row count. Unlike an XOR it tells ``A, A`` from ``B, B`` and from nothing, and it merges like any
partial aggregate, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Digits of a double after the first; 16 tell all doubles apart.
DIGITS = 16
#: With fewer digits a double is taken times this, so that engines that round ties differently meet none.
NUDGE = 1 + 2.0**-30


def column_text(name: str, kind: T.DataType, digits: int = DIGITS) -> Column:
    """One column as text: null is ``~``, doubles are in scientific notation, dates ISO, the rest as it casts."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        factor = 1.0 if digits >= DIGITS else NUDGE
        text = F.format_string(f"%.{digits}e", c.cast("double") * F.lit(factor) + F.lit(0.0))  # no negative zero
    elif isinstance(kind, T.ArrayType):
        text = F.to_json(c)
    else:
        text = c.cast("string")
    return F.when(c.isNull(), F.lit("~")).otherwise(text)


def row_text(df: DataFrame, digits: int = DIGITS) -> Column:
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    return F.concat_ws("|", *[column_text(f.name, f.dataType, digits) for f in fields])


def digest_columns(text: Column) -> list[Column]:
    """Aggregates ``digest_a`` and ``digest_b``: sums of the two 60-bit numbers of a row's MD5, as decimal text."""
    md5 = F.md5(text.cast("binary"))
    part = lambda at: F.conv(F.substring(md5, at, 15), 16, 10).cast("decimal(20,0)")
    return [F.sum(part(1)).cast("string").alias("digest_a"), F.sum(part(16)).cast("string").alias("digest_b")]


def table_digest(df: DataFrame, keys: list[str], digits: int = DIGITS) -> DataFrame:
    """keys, n_rows, digest_a, digest_b: a row per key, over all columns (the keys too)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("n_rows"), *digest_columns(row_text(df, digits)))


def digest_sql(columns: dict[str, str], digits: int) -> str:
    """DuckDB SQL of the two sums at fewer digits; ``columns`` are name -> kind (``double`` or another)."""
    texts = [f"""coalesce({f"printf('%.{digits}e', {c} * {NUDGE!r}::DOUBLE + 0.0)" if kind == "double" else f"CAST({c} AS VARCHAR)"}, '~')""" for c, kind in sorted(columns.items())]
    md5 = f"md5(concat_ws('|', {', '.join(texts)}))"
    sums = [f"CAST(sum(CAST(CAST('0x' || substr({md5}, {at}, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS {name}" for at, name in ((1, "digest_a"), (16, "digest_b"))]
    return ", ".join(sums)
