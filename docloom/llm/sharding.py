"""Weighted rendezvous hashing of stable record keys over shards (DataFrame functions only).

Every shard draws a number u in (0, 1) from the MD5 of ``key:shard`` and offers
-ln(u) / weight; the least offer wins, ties to the lower shard. An added shard
only takes records to itself, a removed one only gives up its own, and expected
shares follow the weights. MD5 keeps the choice equal across engines and versions.

Slots number a shard's records from 0 without gaps. Records are dealt to
``BUCKETS`` buckets a shard by their key, counted from the key column alone, and
numbered within their bucket after the buckets before it, so that no task orders a
whole shard. The counts joined back are shards * 256 rows, whatever the input.

Defined results: a null text has size ``OVERHEAD`` and the checksum of no bytes;
a null key counts as the key "null"; repeated rows go to one shard and get
neighbouring slots. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS, OVERHEAD = 24, 8
BUCKETS = 256  # two hexadecimal digits


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


def _offer(key: Column, shard: int, weight: float) -> Column:
    drawn = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, 13), 16, 10).cast("double")
    return F.struct((-F.ln((drawn + F.lit(0.5)) / F.lit(float(2**52))) / F.lit(float(weight))).alias("offer"), F.lit(shard).alias("shard"))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of ``key`` among len(weights) shards of positive weight."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    return F.array_min(F.array(*(_offer(key, s, w) for s, w in enumerate(weights))))["shard"]


def shard(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, added: float = 1.0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (with one more shard of weight ``added``)."""
    key, n = _key("doc_id"), len(weights)
    best = F.array_min(F.array(*(_offer(key, s, w) for s, w in enumerate(weights))))
    bucket = F.substring(F.md5(key), 1, 2)
    text = F.coalesce(F.col("text"), F.lit(""))
    if not n or min(*weights, added) <= 0:
        raise ValueError("weights must be positive")
    dealt = docs.select("doc_id", best.alias("best"), bucket.alias("bucket")).select("doc_id", F.col("best.shard").alias("shard"), "bucket")
    ahead = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("shard", "bucket").count().select("shard", "bucket", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("before"))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        best.alias("best"),
        _offer(key, n, added).alias("new"),
        bucket.alias("bucket"),
    ).select("doc_id", "size", "text_crc32", F.col("best.shard").alias("shard"), F.least("best", "new")["shard"].alias("grown_shard"), "bucket")
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    return (
        rows.withColumn("at", F.row_number().over(within))
        .join(F.broadcast(before), ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("before") + F.col("at") - 1).cast("long").alias("slot"), "grown_shard")
    )


ORACLE = """
WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::UBIGINT, [0,0,0,0,0,0,0,0]::UBIGINT[]), lambda c, z: xor(c >> 1, (c & 1) * 3988292384))) AS crc),
d AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS k, octet_length(encode(coalesce(text, '')))::BIGINT + 8 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::UBIGINT) AS bytes
  FROM documents
),
c AS (SELECT doc_id, k, size, xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes), lambda a, b: xor(t.crc[(xor(a, b) & 255)::INT + 1], a >> 8)), 4294967295)::BIGINT AS text_crc32 FROM d, t),
o AS (
  SELECT c.*, s AS shard, -ln((('0x' || substr(md5(k || ':' || s::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) AS offer
  FROM c, range(25) r(s)
),
b AS (
  SELECT doc_id, k, size, text_crc32, arg_min(shard, struct_pack(offer := offer, s := shard)) FILTER (WHERE shard < 24) AS shard,
    arg_min(shard, struct_pack(offer := offer, s := shard)) AS grown_shard
  FROM o GROUP BY ALL
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY substr(md5(k), 1, 2), doc_id, size, text_crc32) - 1 AS slot, grown_shard::INT AS grown_shard
FROM b
"""
