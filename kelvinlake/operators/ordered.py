"""The previous row of each row within a group, without one task per group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kelvinlake.session import shuffle_partitions, written


def with_previous(df: DataFrame, group: str, order: Sequence[str], carry: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Add ``prev_<c>`` for each column in ``carry``: its value in the row before, in ``order``, in the same ``group``.

    The first row of a group has nulls. A null group is a group like any other. ``order`` must be a total order within a group.
    Rows are range-partitioned by (group, order), so a group that holds a third of all rows is spread over many
    tasks; inside a partition the previous row is taken in one streaming pass. What remains is the first row of each
    partition, whose predecessor is the last row of the nearest partition before it: two rows a partition, bounded
    by the number of partitions, are joined for that.
    """
    spark = df.sparkSession
    n = partitions or shuffle_partitions(spark)
    prev_fields = [T.StructField(f"prev_{c}", df.schema[c].dataType) for c in carry]
    out_schema = T.StructType([*df.schema.fields, *prev_fields, T.StructField("__part", T.IntegerType()), T.StructField("__first", T.BooleanType()), T.StructField("__last", T.BooleanType())])
    arrow = to_arrow_schema(out_schema)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: tuple | None = None  # the batch before, so that the last row of the partition is known when it is sent
        tail: pa.RecordBatch | None = None  # the last row before that batch

        def shifted(column: pa.Array, name: str, before: pa.RecordBatch | None) -> pa.Array:
            first = before.column(names.index(name)) if before is not None else pa.nulls(1, column.type)
            return pa.concat_arrays([first, column.slice(0, len(column) - 1)])

        def send(batch: pa.RecordBatch, before: pa.RecordBatch | None, last: bool) -> pa.RecordBatch:
            size = batch.num_rows
            g = batch.column(names.index(group))
            h = shifted(g, group, before)
            same = pc.or_(pc.fill_null(pc.equal(g, h), False), pc.and_(pc.is_null(g), pc.is_null(h)))
            if before is None:
                same = pa.concat_arrays([pa.array([False]), same.slice(1)])
            prev = []
            for c in carry:
                value = shifted(batch.column(names.index(c)), c, before)
                prev.append(pc.if_else(same, value, pa.nulls(size, value.type)).cast(arrow.field(f"prev_{c}").type))
            at = pa.array(range(size), pa.int64())
            edge = [pc.equal(at, 0 if before is None else -1), pc.equal(at, size - 1 if last else -1)]
            own = [batch.column(i).cast(arrow.field(i).type) for i in range(len(names))]
            return pa.RecordBatch.from_arrays([*own, *prev, pa.array([part] * size, pa.int32()), *edge], schema=arrow)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            if held is not None:
                yield send(*held, False)
                tail = held[0].slice(held[0].num_rows - 1)
            held = (batch, tail)
        if held is not None:
            yield send(*held, True)

    ranged = df.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order)
    linked = written(ranged.mapInArrow(run, out_schema), "previous")
    edges = linked.filter("__first OR __last")
    across = Window.orderBy("__part")
    lasts = edges.filter("__last").select(F.col("__part"), F.struct(F.col(group).alias("g"), *(F.col(c) for c in carry)).alias("__tail"))
    firsts = edges.filter("__first").select("__part")
    heads = firsts.join(lasts, "__part", "full_outer").withColumn("__before", F.last("__tail", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)))
    fixed = linked.join(F.broadcast(heads.select("__part", "__before")), "__part", "left")
    take = F.col("__first") & F.col("__before").isNotNull() & F.col("__before.g").eqNullSafe(F.col(group))
    return fixed.select(
        *(F.col(c) for c in names),
        *(F.when(take, F.col(f"__before.{c}")).otherwise(F.col(f"prev_{c}")).alias(f"prev_{c}") for c in carry),
    )


def running_totals(df: DataFrame, group: Sequence[str], order: str, sums: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Add ``run_<c>`` for each column in ``sums``: its sum over rows of the group up to this one in ``order``.

    ``order`` must be unique within a group. Rows are range-partitioned by (group, order); what comes before a row is the
    total of earlier parts of its group plus the sum inside its own part, so neither one group nor the whole table is
    cumulated in one task. Nulls in ``sums`` count as 0.
    """
    n = partitions or shuffle_partitions(df.sparkSession)
    keys = list(group)
    ranged = written(df.repartitionByRange(n, *keys, order).withColumn("__part", F.spark_partition_id()), "running")
    parts = ranged.groupBy(*keys, "__part").agg(*(F.sum(c).alias(f"__t_{c}") for c in sums))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*keys, "__part", *(F.coalesce(F.sum(f"__t_{c}").over(earlier), F.lit(0)).alias(f"__o_{c}") for c in sums))
    offsets = offsets.withColumnsRenamed({k: f"__g_{k}" for k in keys}).withColumnRenamed("__part", "__p")
    same = F.col("__part") == F.col("__p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__g_{k}"))
    inside = Window.partitionBy(*keys, "__part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.select("*", *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"__i_{c}") for c in sums)).join(offsets, same)
    return out.select(*df.columns, *((F.col(f"__i_{c}") + F.col(f"__o_{c}")).alias(f"run_{c}") for c in sums))
