"""Sharding by a Feistel permutation of global row numbers with cycle walking (native).

Row numbers come from a fixed order (bucket, doc_id, text checksum, size): the rows of each of a
fixed number of buckets are counted, the counts (at most BUCKETS of them) give every bucket's first
number, and a window inside the bucket numbers its rows. No step sees the table in one task.
A keyed Feistel network over Z_a x Z_b, a * b >= n, permutes the numbers; what falls outside
[0, n) walks on along its cycle. Number y goes to shard y mod k at slot y div k, so that shard and slot
can be computed for any row number without the data and shard sizes differ by one at most.

Nulls: a null text has 0 bytes and checksum 0; a null doc_id sorts first. Rows equal in all three
values are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import clear

#: Fixed number of numbering buckets; bounds the table of offsets that is broadcast.
BUCKETS = 4096
#: Mersenne prime 2^31 - 1, modulus of the bucket and round functions.
P = 2_147_483_647
ROUNDS = 8


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    """(add, multiply, offset) of each round, from a linear congruential generator."""
    out, x = [], (seed * 48271 + 11) % P
    for _ in range(ROUNDS):
        key = []
        for _ in range(3):
            x = (x * 48271 + 12345) % P
            key.append(max(x, 1))
        out.append(tuple(key))
    return out


def domain(n: int) -> tuple[int, int]:
    """Smallest near-square a * b >= n."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def walk_limit(n: int) -> int:
    """A walk meets each number outside [0, n) once at most; 64 steps outside have odds of sqrt(n) ** -64."""
    a, b = domain(n)
    return min(a * b - n + 1, 64)


def permute(x: int, n: int, seed: int) -> int:
    """The permutation in plain Python, for lookups of single rows."""
    a, b = domain(n)
    while True:
        left, right = divmod(x, b)
        for i, (k, m, c) in enumerate(round_keys(seed)):
            if i % 2 == 0:
                left = (left + (pow((right + k) % P, 2, P) * m + c) % P) % a
            else:
                right = (right + (pow((left + k) % P, 2, P) * m + c) % P) % b
        x = left * b + right
        if x < n:
            return x


def permuted(x: str, n: int, seed: int) -> Column:
    """permute() as a native expression over the column named x."""
    a, b = domain(n)
    keys = ", ".join(f"named_struct('side', {i % 2}, 'k', {k}L, 'm', {m}L, 'c', {c}L)" for i, (k, m, c) in enumerate(round_keys(seed)))
    turn = lambda v: f"((((({v} + q.k) % {P}L) * (({v} + q.k) % {P}L)) % {P}L) * q.m + q.c) % {P}L"
    once = (
        f"aggregate(array({keys}), named_struct('l', acc div {b}L, 'r', acc % {b}L), (s, q) -> named_struct("
        f"'l', if(q.side = 0, (s.l + {turn('s.r')}) % {a}L, s.l), 'r', if(q.side = 1, (s.r + {turn('s.l')}) % {b}L, s.r)), s -> s.l * {b}L + s.r)"
    )
    walked = f"aggregate(sequence(1, {walk_limit(n)}), cast({x} as bigint), (acc, i) -> if(i > 1 and acc < {n}L, acc, {once}))"
    return F.expr(f"if({walked} < {n}L, {walked}, raise_error('cycle walk too long'))") if walk_limit(n) == 64 else F.expr(walked)


def bucket(doc_id: Column) -> Column:
    return F.pmod(F.pmod(F.coalesce(doc_id.cast("long"), F.lit(0)), F.lit(P)) * F.lit(69_621) + F.lit(12_345), F.lit(P)) % F.lit(BUCKETS)


def shard_documents(documents: DataFrame, shards: int = 8, seed: int = 42) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard, slot of every row."""
    spark = documents.sparkSession
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = clear(documents, "bucket").select(
        "doc_id", bucket(F.col("doc_id")).alias("bucket"), (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    counts = sorted((r["bucket"], r["n"]) for r in documents.select(bucket(F.col("doc_id")).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).collect())
    n, firsts = 0, []
    for k, c in counts:
        firsts.append((k, n))
        n += c
    offsets = spark.createDataFrame(firsts, "bucket long, first_row long")
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    numbered = rows.join(F.broadcast(offsets), "bucket").select(
        "doc_id", "size", "text_crc32", (F.col("first_row") + F.row_number().over(order) - 1).alias("row_number")
    )
    return numbered.withColumn("_y", permuted("row_number", max(n, 1), seed)).select(
        "doc_id", "size", "text_crc32", "row_number", (F.col("_y") % shards).cast("int").alias("shard"), F.expr(f"_y div {shards}L").alias("slot")
    )


def op9_feistel_shards(spark, sf_dir):
    from .common import read_table

    out = shard_documents(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
