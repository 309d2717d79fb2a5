"""Substring deduplication by seeds and extension.

A window is `length` consecutive words. Seeds are winnowed anchors: of the GRAM-word grams in a window the one with
the least hash, the leftmost of equals. The anchor depends on the window's words alone, so that equal windows
meet at equal anchors. Three passes over the texts:

1. anchors are counted (one row per distinct anchor and document); those seen twice or more are seeds. A filter of
   fixed size is set from them: an anchor that it rejects is no seed, one that it lets through needn't be one.
2. every place of a seed is extended both ways, by all ways to split the words that a window has beyond the anchor
   between its left and right, to the windows that own it as their anchor. Windows go out with 128 bits of
   hash; the first place of each in (doc_id, start) order is found by a partial aggregate, never by pairs.
3. documents meet the first places that lie in them. An extended window that is no first place repeats an
   earlier one; runs of such windows are the maximal repeats, and their words are removed.

Exact for any fill of the filter. Null text: no words. Null doc_id counts as the smallest. Rows that share a
doc_id stand at the same place: none is earlier than the other. Texts under `length` words keep all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bitmap, clear, passes

LENGTH, GRAM = 20, 12
#: Bits of the seed filter (2 ** FILTER_BITS); its size doesn't depend on the data.
FILTER_BITS = 26
_C = np.uint64(0x9E3779B97F4A7C15)
_D = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolled(h: np.ndarray, n: int, c: np.uint64) -> np.ndarray:
    """Polynomial hash of every n consecutive values, mixed."""
    out = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        out = out * c + h[j : len(h) - n + 1 + j]
    return _mixed(out)


class Windows:
    """The windows of one text: anchor and window hashes and the anchor's place."""

    def __init__(self, words: list[bytes], length: int, gram: int):
        import xxhash

        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        self.h, self.length = h, length
        grams = _rolled(h, gram, _C)
        reach = length - gram + 1
        starts = np.arange(len(h) - length + 1)
        self.place = starts + np.lib.stride_tricks.sliding_window_view(grams, reach).argmin(1)
        self.anchor = grams[self.place]

    def digest(self) -> np.ndarray:
        return _rolled(self.h, self.length, _D)


def split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def count_anchors(documents: DataFrame, length: int, gram: int) -> DataFrame:
    schema = pa.schema([("anchor", pa.int64()), ("n", pa.int32())])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for text in b.column(0):
                w = split(text.as_py())
                if len(w) < length:
                    continue
                win = Windows(w, length, gram)
                held.append(win.anchor[np.flatnonzero(np.diff(win.place, prepend=-1))])
                size += len(held[-1])
                if size > 200_000:
                    u, c = np.unique(np.concatenate(held), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(c.astype(np.int32))], schema=schema)
                    held, size = [], 0
        if held:
            u, c = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(c.astype(np.int32))], schema=schema)

    return documents.select("text").mapInArrow(run, "anchor long, n int").groupBy("anchor").agg(F.sum("n").alias("n"))


def _extended(win: Windows, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows that extend a seed, whether an equal one starts earlier in the text, and the hashes."""
    starts = np.flatnonzero(passes(win.anchor, table))
    if not len(starts):
        return starts, np.zeros(0, bool), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    a, w = win.anchor[starts], win.digest()[starts]
    # order by hash and start; equal neighbours are repeats inside the text
    order = np.lexsort((starts, a, w))
    again = np.zeros(len(starts), bool)
    again[order[1:]] = (w[order[1:]] == w[order[:-1]]) & (a[order[1:]] == a[order[:-1]])
    return starts, again, a, w


def remove_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, kept (the kept words joined by one space), n_words, n_removed, repeats (word spans removed)."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "substring")
    docs = clear(documents, "key").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"), "doc_id", "text")
    seeds = scratch.write(count_anchors(docs, length, gram).filter("n > 1").select("anchor"), "seeds")
    shared = spark.sparkContext.broadcast(bitmap(seeds, "anchor", filter_bits))
    scratch.drop("seeds")
    scratch.release()
    schema = pa.schema([("a", pa.int64()), ("w", pa.int64()), ("key", pa.int64()), ("start", pa.int32())])

    def extend(batches):
        held, size = [], 0

        def out():
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(cols[0].view(np.int64)), pa.array(cols[1].view(np.int64)), pa.array(cols[2]), pa.array(cols[3])], schema=schema)

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                words = split(text.as_py())
                if len(words) < length:
                    continue
                starts, again, a, w = _extended(Windows(words, length, gram), shared.value)
                if len(starts):
                    new = ~again
                    held.append((a[new], w[new], np.full(new.sum(), key, np.int64), starts[new].astype(np.int32)))
                    size += len(held[-1][0])
                    if size > 100_000:
                        yield out()
                        held, size = [], 0
        if held:
            yield out()

    places = docs.select("key", "text").mapInArrow(extend, "a long, w long, key long, start int")
    first = places.groupBy("a", "w").agg(F.min("key").alias("key_"), F.min_by("start", "key").alias("start"))
    first = scratch.write(first.groupBy("key_").agg(F.collect_list("start").alias("firsts")), "first")
    scratch.release()

    def finish(batches):
        for b in batches:
            out = [[], [], [], []]
            for text, firsts in zip(b.column(1), b.column(2), strict=True):
                words = split(text.as_py())
                gone = np.zeros(len(words) + 1, np.int64)
                if len(words) >= length:
                    starts, again, _, _ = _extended(Windows(words, length, gram), shared.value)
                    # later equals in the text repeat an earlier one even where that one is first of all
                    known = np.asarray(firsts.values.to_numpy(), np.int64) if firsts.is_valid else np.zeros(0, np.int64)
                    repeats = starts[again | ~np.isin(starts, known)]
                    np.add.at(gone, repeats, 1)
                    np.add.at(gone, repeats + length, -1)
                covered = np.cumsum(gone)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
                out[0].append(len(words))
                out[1].append(int(covered.sum()))
                out[2].append(b" ".join([w for w, c in zip(words, covered.tolist(), strict=True) if not c]) if covered.any() else b" ".join(words))
                out[3].append(edges.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.list_(pa.int32()))],
                names=["doc_id", "n_words", "n_removed", "kept", "repeats"],
            )

    met = docs.join(first.hint("shuffle_hash"), F.col("key") == F.col("key_"), "left")
    return met.select("doc_id", "text", "firsts").mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept binary, repeats array<int>")


def op4_substring_repeats(spark, sf_dir):
    from .common import read_table

    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
