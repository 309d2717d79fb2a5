"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask that looks at some of the tokens under it; the others may differ. The masks follow from an item's
length, so that whatever tokens a stretch may differ in, some mask steps over all of them. The benchmark becomes a table of
seeds: the hash under a mask at a position, and the tokens around it that a stretch with the seed can reach. One pass over the
training texts hashes every position under the masks; what passes a filter of fixed size, set from the benchmark's hashes, goes
out with its own surroundings and is joined with the benchmark's seeds on mask and hash. Around each hit the two texts are
compared on the hit's diagonal: contaminated is a document in which some stretch of OVERLAP tokens (of the whole item,
if it is shorter) that holds a seed agrees in at least IDENTITY of its tokens.

A passage that very many documents share is one hash in the join: documents are dealt out by SALT numbers, and the benchmark's
seeds, the far smaller side, are repeated for each. Tokens are lower-cased runs of letters and digits.

Null and empty texts match nothing, items under MIN_ITEM tokens are not searched for, items without item_id are found as one
item without an id, rows are judged one by one (also those that share a doc_id or have none), repeated rows give repeated
results, and a document's hits are one row per item_id, with its best stretch (the first of equals).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rows, Scratch, bitmap, meet, passes

# Stretches of 13 tokens and more: for any two substituted tokens in 13 some mask steps over both.
MASKS = ("110110011", "111010110", "101101101", "111111000", "1111111")
# The same for any two in 10 to 12, and for any one in 8 or 9.
MIDDLE, SHORT = ("111011", "11010011", "11111"), ("111111", "11001111", "11110011")
ALL_MASKS = (*MASKS, *MIDDLE, *SHORT)
OVERLAP, IDENTITY, MIN_ITEM = 13, 0.8, 8
FILTER_BITS, SALT = 26, 8

_token = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> np.ndarray:
    """64-bit hashes of the tokens."""
    import xxhash

    found = _token.findall((text or "").lower())
    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in found), np.uint64, len(found))


def masks_of(length: int) -> range:
    """Places in ALL_MASKS of the masks for an item of so many tokens."""
    a, b = len(MASKS), len(MASKS) + len(MIDDLE)
    return range(a) if length >= OVERLAP else range(a, b) if length >= 10 else range(b, len(ALL_MASKS))


def seeds(t: np.ndarray, k: int) -> np.ndarray:
    """Hash under the k-th mask at every position."""
    mask = ALL_MASKS[k]
    n = len(t) - len(mask) + 1
    out = np.full(max(n, 0), k + 1, np.uint64)
    if n > 0:
        for j, c in enumerate(mask):
            if c == "1":
                out = (out ^ t[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
                out ^= out >> np.uint64(29)
        out ^= out >> np.uint64(32)
    return out


def around(t: np.ndarray, at: int, reach: int) -> tuple[int, bytes]:
    """Tokens before a position that belong to its surroundings, and the surroundings."""
    low = max(0, at - reach)
    return at - low, t[low : at + reach].tobytes()


def best_stretch(mask: int, length: int, left: int, mine: np.ndarray, its_left: int, its: np.ndarray) -> tuple[int, int] | None:
    """Of the stretches that hold a seed: (agreeing tokens, start relative to the seed), the first of the best."""
    low = max(-left, -its_left, len(ALL_MASKS[mask]) - length)
    high = min(len(mine) - left, len(its) - its_left)
    if high - low < length:
        return None
    same = np.concatenate([[0], np.cumsum(mine[left + low : left + high] == its[its_left + low : its_left + high])])
    agree = (same[length:] - same[:-length])[: 1 - low]
    return (int(agree.max()), low + int(agree.argmax())) if len(agree) else None


def benchmark_seeds(benchmark: DataFrame, overlap: int = OVERLAP, minimum: int = MIN_ITEM) -> DataFrame:
    """mask, h, item_id, length, its_left, its: the distinct seeds of the items."""
    schema = pa.schema([("mask", pa.int32()), ("h", pa.int64()), ("item_id", pa.int64()), ("length", pa.int32()), ("its_left", pa.int32()), ("its", pa.binary())])

    def run(batches):
        rows = Rows(schema)
        for b in batches:
            for item_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = tokens(text.as_py())
                for k in masks_of(len(t)) if len(t) >= minimum else ():
                    for at, h in enumerate(seeds(t, k).view(np.int64).tolist()):
                        rows.add(k, h, item_id, min(overlap, len(t)), *around(t, at, max(overlap, OVERLAP)))
                        if rows.full():
                            yield rows.batch()
        yield rows.batch()

    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(run, "mask int, h long, item_id long, length int, its_left int, its binary").distinct()


def found_texts(documents: DataFrame, benchmark: DataFrame, overlap: int = OVERLAP, identity: float = IDENTITY, filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, text_hash (the text's XXH64), item_id, first_token, n_tokens, share of every contaminated row and item."""
    import xxhash

    spark = documents.sparkSession
    scratch = Scratch(spark, "decontam")
    known = scratch.write(benchmark_seeds(benchmark, overlap), "seeds")
    used = sorted(r["mask"] for r in known.select("mask").distinct().collect())
    shared = spark.sparkContext.broadcast(bitmap(known, "h", filter_bits))
    schema = pa.schema([("mask", pa.int32()), ("h", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("at", pa.int32()), ("left", pa.int32()), ("mine", pa.binary())])

    def search(batches):
        rows = Rows(schema)
        for b in batches:
            for row, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                text = text.as_py() or ""
                t, text_hash = tokens(text), None
                for k in used:
                    s = seeds(t, k)
                    for at in np.flatnonzero(passes(s, shared.value)).tolist():
                        if text_hash is None:
                            # as F.xxhash64 gives it
                            text_hash = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
                            text_hash -= (1 << 64) if text_hash >> 63 else 0
                        rows.add(k, int(s[at].view(np.int64)), row, doc_id, text_hash, at, *around(t, at, max(overlap, OVERLAP)))
                        if rows.full():
                            yield rows.batch()
        yield rows.batch()

    docs = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    hits = docs.mapInArrow(search, "mask int, h long, row long, doc_id long, text_hash long, at int, left int, mine binary")
    dealt = hits.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALT)).cast("int"))
    repeated = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    met = dealt.join(repeated, ["mask", "h", "salt"]).select("row", "doc_id", "text_hash", "item_id", "at", "mask", "length", "left", "mine", "its_left", "its")
    out = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("first_token", pa.int32()), ("n_tokens", pa.int32()), ("share", pa.float64())])

    def verify(batches):
        rows = Rows(out)
        for b in batches:
            for row, doc_id, text_hash, item_id, at, mask, length, left, mine, its_left, its in zip(*(c.to_pylist() for c in b.columns), strict=True):
                best = best_stretch(mask, length, left, np.frombuffer(mine, np.uint64), its_left, np.frombuffer(its, np.uint64))
                if best and best[0] / length >= identity - 1e-9:
                    rows.add(row, doc_id, text_hash, item_id, at + best[1], length, best[0] / length)
                    if rows.full():
                        yield rows.batch()
        yield rows.batch()

    verified = met.mapInArrow(verify, "row long, doc_id long, text_hash long, item_id long, first_token int, n_tokens int, share double")
    best = F.max_by(F.struct("first_token", "n_tokens", "share"), F.struct("share", -F.col("first_token"))).alias("m")
    return verified.groupBy("row", "doc_id", "text_hash", "item_id").agg(best).select("doc_id", "text_hash", "item_id", "m.*")


def find_contamination(documents: DataFrame, benchmark: DataFrame, overlap: int = OVERLAP, identity: float = IDENTITY, filter_bits: int = FILTER_BITS) -> DataFrame:
    """A row per contaminated document and item: doc_id, item_id, first_token, n_tokens, share."""
    return found_texts(documents, benchmark, overlap, identity, filter_bits).drop("text_hash")


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without a verified overlap; rows are judged one by one."""
    scratch = Scratch(documents.sparkSession, "decontam-hit")
    hit = scratch.write(found_texts(documents, benchmark).select(F.col("doc_id").alias("id_"), F.col("text_hash").alias("hash_")).distinct(), "hit")
    return meet(documents, hit, "left_anti")[0]


def op3_spaced_seed_leaks(spark, sf_dir):
    from .common import read_table

    return find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
