"""Rendezvous sharding: each record goes to the shard whose weighted hash of its key is highest.

A record's shard depends on its key and on the shards' names and weights alone, so an added shard takes records only into
itself and a removed one gives up only its own. All of it is column expressions; no record leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SLOT_BUCKETS = 256


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The index of the winning shard. Shard s scores -weight / ln(u) with u uniform in (0, 1) from the hash of key and s.

    A null key hashes like any other value. Shards of weight 0 get nothing; ties go to the smaller index.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("at least one shard needs a positive weight")
    scores = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            unit = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / float(1 << 53)
            scores.append(F.struct((-F.lit(float(weight)) / F.ln(unit)).alias("score"), F.lit(-shard).alias("back")))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (-best["back"]).cast("int")


def shard_documents(
    docs: DataFrame, shards: int = 24, weights: Sequence[float] | None = None, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8
) -> DataFrame:
    """Assign every row a shard and a gapless slot within it.

    Returns doc_id, size (UTF-8 bytes plus `overhead`), text_crc32, law 'key', shard, slot, grown_shard (the shard once one more of
    weight 1, or of the mean weight, is added). Other columns of the input, whatever their names, are left behind.

    Edge cases: a null text has no bytes (size `overhead`, crc 0); a null id is a key of its own; repeated ids share a shard and
    take slots in order of crc and size; rows equal in all three are interchangeable and get consecutive slots; an empty table
    gives no rows. Slots: equal rows are counted before the shuffle, each shard is cut into hash buckets whose counts (shards x
    SLOT_BUCKETS rows, whatever the input) are summed up to offsets, and rows are numbered within a bucket, so that neither a large
    shard nor one id with a third of the rows meets in one task.
    """
    weights = list(weights) if weights is not None else [1.0] * shards
    if len(weights) != shards:
        raise ValueError("one weight per shard is needed")
    grown = [*weights, sum(weights) / shards]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text).cast("bigint") + overhead).alias("size"), F.crc32(text).alias("text_crc32"))
    equal = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    placed = equal.withColumns(
        {
            "shard": rendezvous(F.col("doc_id"), weights),
            "grown_shard": rendezvous(F.col("doc_id"), grown),
            "bucket": F.pmod(F.xxhash64("text_crc32", "size", "doc_id"), F.lit(SLOT_BUCKETS)).cast("int"),
        }
    )
    counts = placed.groupBy("shard", "bucket").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("before", F.coalesce(F.sum("copies").over(within), F.lit(0)))
    # The offsets are shards x SLOT_BUCKETS rows of three numbers at most. As a left join, both sides keep one and the same
    # plan below, so Spark reads the table and shuffles the counted rows once.
    return numbered.join(F.broadcast(offsets), ["shard", "bucket"], "left").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence(F.col("offset") + F.col("before"), F.col("offset") + F.col("before") + F.col("copies") - 1)).alias("slot"),
        "grown_shard",
    )
