"""Vector helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_literal(vector: Column) -> Column:
    """Bracketed text with eight decimals per element."""
    items = F.transform(vector, lambda x: F.format_string("%.8f", x.cast("double")))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def cosine_similarity(a: Column, b: Column) -> Column:
    """One minus the cosine distance; null when either vector is zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms != 0, dot(a, b) / norms)


def hash_bucket(token: Column, dimensions: int) -> Column:
    """Bucket of a token: first four digest bytes as a big-endian number, modulo the size."""
    return F.conv(F.substring(F.sha2(token, 256), 1, 8), 16, 10).cast("bigint") % dimensions


def hash_sign(token: Column) -> Column:
    """+1 or -1 by the parity of the fifth digest byte."""
    odd = F.conv(F.substring(F.sha2(token, 256), 9, 2), 16, 10).cast("int") % 2
    return F.when(odd == 0, F.lit(1)).otherwise(F.lit(-1))
