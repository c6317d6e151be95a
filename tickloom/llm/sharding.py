"""Sharding by a two-pass external shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import free_names
from tickloom.session import shared_folder, staged

#: Buckets that are added up together; keys of equal rows that may fill a bucket on their own.
RUN, HEAVY_KEYS = 4096, 10_000


def shuffle_into_shards(frame: DataFrame, shards: int = 24, seed: int = 17,
                        id_col: str = "doc_id", text_col: str = "text",
                        bucket_bytes: int = 32 << 20, folder: str | None = None) -> DataFrame:
    """All rows in a seeded random order, written as ``shards`` runs; read back with ``shard``
    and ``slot``.

    First pass: a seeded hash of each row deals it to one of so many buckets that each holds about
    ``bucket_bytes`` of text; groups of copies have different ids, so they spread too. Rows that
    are equal in id and text hash alike: where more of them than a bucket should hold meet, the
    hash takes in their place in the table as well. Second pass: each bucket is put into a fixed
    order by hash, permuted by Fisher-Yates with a seed of its own, and written. The buckets
    behind each other are the global order, of which each shard is a contiguous run, so the
    shards' row counts differ by one at most, slots have no gaps, and each bucket writes to one or
    a few shards. Of the buckets only row counts are added up, in runs of RUN.

    The result does not depend on the input's partitions, but for equal rows beyond a bucket's
    size. Files: ``<folder>/shard=<n>``.

    Defined cases: null texts have no bytes; a null id is a value like others, told apart by
    text; equal rows get slots of their own; an empty table has no shards. Columns named shard or
    slot are replaced; others may have any name.
    """
    spark = frame.sparkSession
    rows = frame.drop("shard", "slot")
    names = rows.columns
    key_col, bucket_col = free_names(names, "key", "bucket")
    size = (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long")
    total = rows.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-int(total) // bucket_bytes))
    key = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    heavy = (rows.select(key.alias("key"), size.alias("size")).groupBy("key")
             .agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
             .where((F.col("bytes") > bucket_bytes) & (F.col("n") > 1)).select("key"))
    crowded = [r["key"] for r in heavy.limit(HEAVY_KEYS).collect()] if buckets > 1 else []
    if crowded:  # each holds more than a bucket, so there are fewer of them than buckets
        place = F.xxhash64(key, F.monotonically_increasing_id())
        key = F.when(key.isin(crowded), place).otherwise(key)
    dealt = rows.withColumn(key_col, key).withColumn(bucket_col, F.pmod(F.col(key_col), F.lit(buckets)))
    counts = staged(dealt.groupBy(bucket_col).agg(F.count("*").alias("n"))
                    .select(F.col(bucket_col).alias("bucket"), "n",
                            F.expr(f"{bucket_col} div {RUN}").alias("run")), "buckets")
    runs = counts.groupBy("run").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                       F.sum("n").over(Window.partitionBy()).alias("whole"))
    before = counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))) \
        .join(runs, "run").select("bucket", (F.col("before") + F.col("inside")).alias("before"), "whole")
    schema = T.StructType([*rows.schema.fields, T.StructField("shard", T.IntegerType()),
                           T.StructField("slot", T.LongType())])

    def permute(table: pa.Table, start: pa.Table) -> pa.Table:
        n = table.num_rows
        first, whole, bucket = (start.column(c)[0].as_py() for c in ("before", "whole", "bucket"))
        keys = table.column(key_col).to_numpy()
        ids = table.column(id_col).to_numpy() if not table.column(id_col).null_count \
            else np.zeros(n)
        order = np.lexsort((ids, keys)) if ids.dtype.kind in "iuf" else np.argsort(keys, kind="stable")
        shuffled = order[np.random.default_rng([seed, bucket]).permutation(n)]  # Fisher-Yates
        rank = first + np.arange(n, dtype=np.int64)
        shard = rank * shards // whole
        begin = -(-shard * whole // shards)
        out = table.select(names).take(pa.array(shuffled))
        return out.append_column("shard", pa.array(shard.astype(np.int32))) \
                  .append_column("slot", pa.array(rank - begin))

    placed = dealt.groupBy(bucket_col).cogroup(before.groupBy("bucket")) \
        .applyInArrow(permute, schema)
    folder = folder or shared_folder(spark)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return spark.read.schema(schema).parquet(folder)
