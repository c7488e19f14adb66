"""A Bloom filter of bounded size, built by a distributed aggregate and probed inside generated code."""

from __future__ import annotations

import math

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

try:  # not part of the public API: without it nothing is proven, and exact joins verify every key
    from pyspark.sql.internal import InternalFunction
except ImportError:
    InternalFunction = None

#: A filter never takes more bits than this (8 MiB), whatever the number of keys: its broadcast is bounded.
#: Beyond about 6.7 million keys the share of false positives grows, which costs work but not correctness.
MAX_BITS = 1 << 26


def key_hash(*cols: str | Column) -> Column:
    return F.xxhash64(*cols)


def build(df: DataFrame, *cols: str | Column, expected: int | None = None, max_bits: int = MAX_BITS) -> DataFrame | None:
    """A one-row DataFrame with a Bloom filter over the keys of ``df``; None if there are none.

    The filter is merged from partial filters by Spark's own aggregate and stays on the cluster: it reaches the
    probing tasks as a scalar subquery.
    """
    if expected is None:
        expected = df.count()
    if expected == 0:
        return None
    if InternalFunction is None:
        return df.limit(1).select(F.lit(None).cast("binary").alias("bloom"))
    bits = max(1 << 10, min(max_bits, 1 << math.ceil(math.log2(10 * expected))))
    items = max(1, min(expected, bits // 8))
    bloom = InternalFunction._invoke_internal_function_over_columns(
        "bloom_filter_agg", key_hash(*cols), F.lit(items).cast("long"), F.lit(bits).cast("long")
    )
    return df.agg(bloom.alias("bloom"))


def might_contain(bloom: DataFrame | None, *cols: str | Column) -> Column:
    """False where a key is certainly absent from the filter; true for all keys where this Spark gives no access to the probe."""
    if bloom is None:
        return F.lit(False)
    if InternalFunction is None:
        return F.lit(True)
    try:
        jvm = bloom.sparkSession.sparkContext._jvm
        utils = jvm.org.apache.spark.sql.classic.ExpressionUtils
        probe = jvm.org.apache.spark.sql.catalyst.expressions.BloomFilterMightContain(
            utils.expression(bloom.scalar()._jc), utils.expression(key_hash(*cols)._jc)
        )
        return Column(utils.column(probe))
    except (AttributeError, TypeError, PySparkException):  # another release, or a remote session
        return F.lit(True)
