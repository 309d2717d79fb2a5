"""SimHash near-duplicates through a positional byte index with count filtering.

Fingerprints are made in Arrow batches. Two 64-bit fingerprints at 3 or fewer differing bits share at
least 5 of their 8 byte positions, the guaranteed minimum. Lists of one positional byte hold 1/256 of
all fingerprints, too long to walk at scale; but any 5 of 8 positions hold all three positions of one of
the 8 triples drawn from {0,1,2,3} and {4,5,6,7}, so the index keys its lists by such triples with their bytes and
still meets every pair. Inside a list the shared positional bytes of each pair are tallied, pairs under the
minimum dropped, and the rest verified by their differing bits.

Equal fingerprints are one node. A list of more than BLOCK members is cut into blocks by hash, and each
pair of blocks is a task of its own; a task gives out a spanning forest of the links it has verified, not
the pairs, so that a large group of near copies costs a number of rows that is linear in its size.
Components come from alternating large-star and small-star rounds on the links, cut by tables in the shared folder.

Null or blank text: fingerprint zero, linked like any other. Rows sharing a doc_id keep a row each; a null doc_id
gets its group's smallest doc_id (null if there is none).

near_copies() and keep_one() link texts whose five-word shingles have a Jaccard similarity of 0.8 or more. No radius of
a 64-bit SimHash says that: at 0.8 a positional byte of two texts agrees in 27 of 100 cases only, so that keys which are
selective in a large corpus would need some 150 lists a text. There the fingerprint has 64 positional bytes, each the
SimHash byte of a min-wise sample of one shingle, which agrees as often as the similarity says. The rest is the
same index: lists keyed by five positional bytes, shared bytes tallied, pairs under the minimum dropped, a spanning
forest of the others given out with its best pairs first, and each of its pairs verified by the shingles themselves. That
joins nearly all, but a list or a tally can miss a link, and a forest's pair can fail where another would have held. So the groups found are
then held against each other without loss: two sets of this similarity share one of the first shingles of each, in any order
that is the same for all sets (here rare ones first), and every pair of different groups that shares one and whose sizes, places and
parities allow the similarity is verified too. The parities say of some bits whether an even or odd number of the set's shingles fall on
each: bits that differ are at most as many as the shingles that only one set holds, so that no link fails by them, and pairs
that share a passage by chance, whose number grows as the square of the corpus, never leave the list where they met. Texts are told apart by their hash, rows by doc_id
and text. Fewer than five words: the whole sequence is the shingle; null or blank texts are equal to each other alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rows, Scratch, bitmap, hash_of, meet, passes, quoted

BITS, MATCHES, SHINGLE, SEED = 3, 5, 3, 42
#: Members of one list that a task compares with each other; longer lists are cut into pairs of blocks.
BLOCK = 2048
#: Near copies: words of a shingle, least Jaccard similarity, positional bytes of the sampled fingerprint, of a key, and lists.
COPY_SHINGLE, SIMILARITY, POSITIONS, KEY_BYTES, LISTS = 5, 0.8, 64, 5, 12
#: Longs of the widest parities that go into lists; pairs of larger sets are held against each other by all their parities later.
PARITY_LONGS = 8
TRIPLES = [(0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3), (4, 5, 6), (4, 5, 7), (4, 6, 7), (5, 6, 7)]

_SALT, _ODD = np.random.default_rng(SEED).integers(0, 1 << 63, (2, POSITIONS), np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash; a bit is set if more than half of the shingles' hashes have it."""
    hashes = shingle_hashes(text, shingle, seed)
    if not len(hashes):
        return 0
    h = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(h[:, j], minlength=256) @ _BYTE_BITS for j in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def shingle_hashes(text: str | None, shingle: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each shingle, repeats included; the whole sequence where words are fewer."""
    import xxhash

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(w) <= shingle:
        grams = [b" ".join(w)] if w else []
    else:
        grams = [b" ".join(g) for g in zip(*(w[i:] for i in range(shingle)), strict=False)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(g, seed) for g in grams), np.uint64, len(grams))


def sampled_bytes(hashes: np.ndarray) -> bytes:
    """At each position the byte of the shingle that comes first in that position's order; no shingles: zeros."""
    if not len(hashes):
        return bytes(POSITIONS)
    first = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        x = (hashes[at : at + 1024, None] ^ _SALT) * _ODD
        x ^= x >> np.uint64(32)
        x *= _ODD
        x ^= x >> np.uint64(29)
        np.minimum(first, x.min(axis=0), out=first)
    return first.astype(np.uint8).tobytes()


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        rows = Rows(schema)
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                fp = fingerprint(text.as_py())
                rows.add(doc_id, fp - (1 << 64) if fp >> 63 else fp)
                if rows.full():
                    yield rows.batch()
        yield rows.batch()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _forest(left: np.ndarray, right: np.ndarray | None, bits: int, matches: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within one block, or between two blocks."""
    own = right is None
    right = left if own else right
    both = left if own else np.concatenate([left, right])
    parent = list(range(len(both)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out, shift = [], 0 if own else len(left)
    rows = max(1, 1_000_000 // max(1, len(right)))
    for at in range(0, len(left), rows):
        x = left[at : at + rows, None] ^ right[None, :]
        shared = np.zeros(x.shape, np.uint8)
        for j in range(8):
            shared += ((x >> np.uint64(8 * j)) & np.uint64(255)) == 0
        i, j = np.nonzero((shared >= matches) & (np.bitwise_count(x) <= bits))
        for a, b in zip((i + at).tolist(), (j + shift).tolist(), strict=True):
            if a != b and (ra := root(a)) != (rb := root(b)):
                parent[max(ra, rb)] = min(ra, rb)
                out.append((int(both[a]), int(both[b])))
    return out


def blocks(index: DataFrame, block: int) -> DataFrame:
    """same, a, b: the items of each key (item, key), long lists cut into pairs of blocks; same: one block, in a."""
    long = index.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > block).select("key", F.ceil(F.col("n") / block).cast("int").alias("cuts"))
    # nearly all lists are short; the long ones are found by their counts
    cut = index.join(long, "key", "left").select("key", "item", F.coalesce("cuts", F.lit(1)).alias("cuts"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("item", "key"), F.col("cuts")).cast("int"))
    dealt = cut.select("key", "item", "own", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other"))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("first"), "item")
    lists = dealt.groupBy("key", "i", "j").agg(F.collect_list(F.when(F.col("first"), F.col("item"))).alias("a"), F.collect_list(F.when(~F.col("first"), F.col("item"))).alias("b"))
    return lists.filter(F.size("a") + F.size("b") > 1).select((F.col("i") == F.col("j")).alias("same"), "a", "b")


def links(distinct: DataFrame, bits: int = BITS, matches: int = MATCHES, block: int = BLOCK) -> DataFrame:
    """u, v: links that connect what lies within the bits, from distinct fingerprints (column fp)."""
    byte = lambda j: F.shiftrightunsigned("fp", 8 * j).bitwiseAND(255)
    keys = F.array(*[(F.lit(t).cast("long") * (1 << 24)) + byte(a) * 65536 + byte(b) * 256 + byte(c) for t, (a, b, c) in enumerate(TRIPLES)])
    lists = blocks(distinct.select(F.col("fp").alias("item"), F.explode(keys).alias("key")), block)
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        rows = Rows(schema)
        for batch in batches:
            for same, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                left, right = (np.asarray(x.values.to_numpy(), np.int64).view(np.uint64) for x in (a, b))
                for u, v in _forest(left, None if same else right, bits, matches) if len(left) and (same or len(right)) else ():
                    rows.add(*sorted(x - (1 << 64) if x >> 63 else x for x in (u, v)))
                    if rows.full():
                        yield rows.batch()
        yield rows.batch()

    return lists.mapInArrow(run, "u long, v long").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root: the smallest node reachable, for all nodes of the edges (u, v).

    Large-star then small-star until the edges no longer change; each round is a table in the shared folder.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = both.join(least, "u")
        moved = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")) if large else moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        return moved.filter(F.col("u") != F.col("v")).distinct()

    mark = lambda e: e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    now = scratch.write(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "edges-0")
    before, k = mark(now), 0
    while before[0]:
        k += 1
        # both stars of a round in one plan: the table between rounds bounds its size
        new = scratch.write(star(star(now, True), False), f"edges-{k}")
        scratch.drop(f"edges-{k - 1}")
        after = mark(new)
        now = new
        if tuple(after) == tuple(before):
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def grouped(prints: DataFrame, node: str, distinct: DataFrame, edges: DataFrame, own: str, scratch: Scratch) -> DataFrame:
    """prints and component_id: the least value of own among the rows whose nodes the edges connect; distinct: node, least, n."""
    roots = components(edges, scratch)
    member = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    named = member.join(distinct, "node").select("node", "root", "least")
    name = named.groupBy(F.col("root").alias("root_")).agg(F.min("least").alias("component_id"))
    linked = named.join(name, F.col("root") == F.col("root_")).select("node", "component_id")
    alone = distinct.filter("n > 1").join(linked.select("node"), "node", "left_anti").select("node", F.col("least").alias("component_id"))
    groups = scratch.write(linked.union(alone), "groups").withColumnRenamed("node", "node_")
    scratch.release()
    # nodes of one row and no link are their own component and need no partner in the join
    return prints.join(groups, F.col(node) == F.col("node_"), "left").select(*prints.columns, F.coalesce("component_id", own).alias("component_id"))


def near_duplicates(documents: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id of the component) of every row."""
    scratch = scratch or Scratch(documents.sparkSession, "simhash")
    prints = scratch.write(fingerprints(documents), "prints")
    distinct = scratch.write(prints.groupBy(F.col("fp").alias("node")).agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct")
    edges = scratch.write(links(distinct.select(F.col("node").alias("fp"))), "links")
    scratch.release()
    return grouped(prints, "fp", distinct, edges, "doc_id", scratch)


def sampled_prints(documents: DataFrame, shingle: int = COPY_SHINGLE) -> DataFrame:
    """doc_id, text_hash, item (text_hash and the positional bytes) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item", pa.binary())])

    def run(batches):
        rows = Rows(schema)
        for b in batches:
            for doc_id, text, key in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                rows.add(doc_id, key, key.to_bytes(8, "little", signed=True) + sampled_bytes(shingle_hashes(text.as_py(), shingle)))
                if rows.full():
                    yield rows.batch()
        yield rows.batch()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", hash_of(F.col("text")).alias("text_hash")).mapInArrow(run, "doc_id long, text_hash long, item binary")


def _best_forest(items: np.ndarray, minimum: int, sure: int) -> list[tuple[int, int]]:
    """Spanning forest of the pairs that share the minimum of bytes; a pair under the sure tally is taken only where nothing better connects."""
    items = np.unique(items, axis=0)
    node, fp = items[:, :8].copy().view("<i8")[:, 0], items[:, 8:]
    out, wait = [], np.argsort(node)
    rows = fp[wait]
    while len(wait) > 1:
        reached, wait, rows = [wait[0]], wait[1:], rows[1:]
        best, near = np.zeros(len(wait), np.int64), np.zeros(len(wait), np.int64)
        while len(wait):
            if reached:
                x = reached.pop()
                tally = (rows == fp[x]).sum(axis=1)
                near[tally > best] = x
                np.maximum(best, tally, out=best)
                hit = best >= sure
            elif best.max() >= minimum:
                hit = np.arange(len(wait)) == best.argmax()
            else:
                break
            if hit.any():
                out.extend(zip(node[near[hit]].tolist(), node[wait[hit]].tolist(), strict=True))
                reached.extend(wait[hit])
                wait, rows, best, near = wait[~hit], rows[~hit], best[~hit], near[~hit]
    return out


def candidate_copies(distinct: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """u, v: text hashes to verify, from distinct items; three standard deviations under the expected tally is the minimum, two over it sure."""
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("item", 9 + KEY_BYTES * i, KEY_BYTES)) for i in range(LISTS)])
    spread = (POSITIONS * similarity * (1 - similarity)) ** 0.5
    minimum, sure = int(POSITIONS * similarity - 3 * spread), min(POSITIONS, int(POSITIONS * similarity + 2 * spread))
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        rows = Rows(schema)
        for batch in batches:
            for a, b in zip(batch.column(1), batch.column(2), strict=True):
                both = b"".join(a.as_py() + b.as_py())
                for pair in _best_forest(np.frombuffer(both, np.uint8).reshape(-1, 8 + POSITIONS), minimum, sure):
                    rows.add(*sorted(pair))
                    if rows.full():
                        yield rows.batch()
        yield rows.batch()

    return blocks(distinct.select("item", F.explode(keys).alias("key")), block).mapInArrow(run, "u long, v long").distinct()


def prefix_length(size: np.ndarray | int, similarity: float):
    """So many first shingles of a set, in one order for all sets, hold one of those that it shares with any set as similar."""
    return size - np.ceil(similarity * size - 1e-6).astype(np.int64) + 1


def frequent_grams(documents: DataFrame, shingle: int = COPY_SHINGLE, least: int = 3, held: int = 2_000_000) -> DataFrame:
    """h: hashes of shingles that several of some thousand neighbouring texts hold; they come last in the order of shingles, which any choice leaves right."""

    def often(grams: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate([*grams, np.zeros(0, np.uint64)]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h[n >= least].view(np.int64), pa.int64())], ["h"])

    def run(batches):
        grams, n, seen = [], 0, set()
        for b in batches:
            for text, node in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                if node in seen:
                    continue
                seen.add(node)
                grams.append(np.unique(shingle_hashes(text.as_py(), shingle)))
                n += len(grams[-1]) + 1
                if n > held:
                    yield often(grams)
                    grams, n, seen = [], 0, set()
        yield often(grams)

    return documents.select("text", hash_of(F.col("text")).alias("node")).mapInArrow(run, "h long")


def parities(grams: np.ndarray) -> bytes:
    """Whether the set has an odd number of hashes at each of 64, 128, 256... bits, as many as hashes at least."""
    width = 64
    while width < len(grams):
        width *= 2
    odd = np.bincount((grams & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sign: bytes, longs: int) -> np.ndarray:
    """The parities that the set has with so many longs at most."""
    x = np.frombuffer(sign, np.uint64)
    while len(x) > longs:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def parity_table(signs: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Longs of each row's parities, and the parities of all rows folded to 1, 2, 4 and 8 longs (right where a row has as many)."""
    wide = np.frombuffer(b"".join(x.ljust(8 * PARITY_LONGS, b"\0") for x in signs), np.uint64).reshape(-1, PARITY_LONGS)
    tables = [wide]
    while tables[-1].shape[1] > 1:
        half = tables[-1].shape[1] // 2
        tables.append(tables[-1][:, :half] ^ tables[-1][:, half:])
    return np.array([len(x) // 8 for x in signs]), tables[::-1]


def prefixes(documents: DataFrame, frequent: np.ndarray, shingle: int = COPY_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """node, size (of the text's shingle set), sign (its parities), keys (its prefix), one row a text. No shingles: one key of its own."""

    def run(batches):
        nodes, sizes, signs, sets, held = [], [], [], [], 0

        def batch():
            ends = np.cumsum([0, *map(len, sets)])
            keys = pa.LargeListArray.from_arrays(ends, np.concatenate([*sets, np.zeros(0, np.int64)])).cast(pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(signs, pa.binary()), keys], ["node", "size", "sign", "keys"])

        for b in batches:
            for text, node in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                grams = np.unique(shingle_hashes(text.as_py(), shingle))
                often = passes(grams, frequent)
                ordered = np.concatenate([grams[~often], grams[often]])[: prefix_length(len(grams), similarity)]
                nodes.append(node)
                sizes.append(len(grams))
                signs.append(parities(grams))
                sets.append(ordered.view(np.int64) if len(grams) else np.zeros(1, np.int64))
                held += len(sets[-1]) + 10
                if held > 200_000:
                    yield batch()
                    nodes, sizes, signs, sets, held = [], [], [], [], 0
        yield batch()

    found = documents.select("text", hash_of(F.col("text")).alias("node")).mapInArrow(run, "node long, size int, sign binary, keys array<long>")
    return found.groupBy("node").agg(F.first("size").alias("size"), F.first("sign").alias("sign"), F.first("keys").alias("keys"))


def _open_pairs(left: np.ndarray, right: np.ndarray | None, similarity: float, signs=None):
    """Pairs of nodes of different roots that may be as similar, if the list's key is the first shingle that both share. Columns: node, root, size, place.

    signs: gives the parities of the left rows and of the right ones, asked for only where pairs are left.
    """
    own = right is None
    right = left if own else right
    tables = None
    rows = max(1, 1_000_000 // max(1, len(right)))
    for at in range(0, len(left), rows):
        node, root, size, place = (c[:, None] for c in left[at : at + rows].T)
        n, m = size, right[:, 2]
        most = np.minimum(n - place, m - right[:, 3])
        ok = (root != right[:, 1]) & (np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-6) & (most >= similarity / (1 + similarity) * (n + m) - 1e-6)
        i, j = np.nonzero(ok)
        if own:
            i, j = i[i + at < j], j[i + at < j]
        if not len(i):
            continue
        if signs and not tables:
            tables = [parity_table(x) for x in signs()]
        for k in range(0, len(i), 50_000):
            a, b = i[k : k + 50_000], j[k : k + 50_000]
            if signs:
                near = _parities_allow(tables, a + at, b, size[a, 0] + m[b], similarity)
                a, b = a[near], b[near]
            yield node[a, 0], right[b, 0]


def _parities_allow(tables, i: np.ndarray, j: np.ndarray, both: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs of sets differ in no more bits than sets as similar differ in elements; both: the sum of their sizes."""
    (longs, left), (others, right) = tables
    width, bits = np.minimum(longs[i], others[j]), np.zeros(len(i), np.int64)
    for k, (x, y) in enumerate(zip(left, right, strict=True)):
        at = np.flatnonzero(width == 1 << k)
        bits[at] = np.bitwise_count(x[i[at]] ^ y[j[at]]).sum(axis=1)
    return bits <= (1 - similarity) / (1 + similarity) * both + 1e-6


def open_copies(texts: DataFrame, scratch: Scratch, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """u, v: all pairs of texts (node, root, size, sign, keys) of different roots that may be as similar: they share a shingle of their prefixes."""
    index = texts.select("root", F.explode("keys").alias("key"))
    ends = index.groupBy("key").agg(F.min("root").alias("first"), F.max("root").alias("last")).filter("first < last")
    keys = bitmap(scratch.write(ends.select("key"), "open"), "key", 26)
    scratch.release()

    def hits(batches):
        for b in batches:
            node, root, size = (b.column(i).to_numpy() for i in range(3))
            signs, lists = pa.array([folded(x, PARITY_LONGS).tobytes() for x in b.column(3).to_pylist()], pa.binary()), b.column(4)
            flat, ends = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(ends)), ends)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(ends) - ends, ends)
            hit = np.flatnonzero(passes(flat.view(np.uint64), keys))
            for at in range(0, len(hit), 20_000):
                h = hit[at : at + 20_000]
                r = row[h]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in ((flat[h], pa.int64()), (node[r], pa.int64()), (root[r], pa.int64()), (size[r], pa.int32()), (place[h], pa.int32()))] + [signs.take(pa.array(r))], ["key", "node", "root", "size", "place", "sign"])

    found = texts.select("node", "root", "size", "sign", "keys").mapInArrow(hits, "key long, node long, root long, size int, place int, sign binary")
    found = scratch.write(found, "hits").select("key", F.struct("node", "root", "size", "place", "sign").alias("item"))
    root = lambda c: F.transform(c, lambda x: x["root"])
    lists = blocks(found, block).filter(F.array_min(root("a")).isNotNull() & (F.size(F.array_distinct(F.concat(root("a"), root("b")))) > 1))
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    table = lambda x: np.stack([x.values.field(i).to_numpy().astype(np.int64) for i in range(4)], axis=1)

    def run(batches):
        for batch in batches:
            for same, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                signs = lambda a=a, b=a if same else b: [x.values.field(4).to_pylist() for x in (a, b)]
                for u, v in _open_pairs(table(a), None if same else table(b), similarity, signs) if same or len(b) else ():
                    for at in range(0, len(u), 20_000):
                        x, y = u[at : at + 20_000], v[at : at + 20_000]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], schema=schema)

    pairs = scratch.write(lists.mapInArrow(run, "u long, v long").distinct(), "met")

    def wide(batches):
        for batch in batches:
            u, v = (batch.column(i).to_pylist() for i in (3, 5))
            bits = np.array([int(np.bitwise_count(folded(x, len(y) // 8) ^ folded(y, len(x) // 8)).sum()) for x, y in zip(u, v, strict=True)], np.int64)
            both = batch.column(2).to_numpy() + batch.column(4).to_numpy()
            near = pa.array(bits <= (1 - similarity) / (1 + similarity) * both + 1e-6)
            yield batch.select([0, 1]).filter(near)

    sign = lambda n: texts.select(F.col("node").alias(n), F.col("size").alias(f"size_{n}"), F.col("sign").alias(f"sign_{n}"))
    met = pairs.join(sign("u"), "u").join(sign("v"), "v")
    return met.select("u", "v", "size_u", "sign_u", "size_v", "sign_v").mapInArrow(wide, "u long, v long")


def shingle_sets(documents: DataFrame, asked: np.ndarray, shingle: int = COPY_SHINGLE) -> DataFrame:
    """node (the text's hash), grams (the distinct hashes of its shingles), one row for each text that the filter of nodes lets through."""

    def run(batches):
        nodes, sets, held = [], [], 0

        def batch():
            ends = np.cumsum([0, *map(len, sets)])
            grams = pa.LargeListArray.from_arrays(ends, np.concatenate([*sets, np.zeros(0, np.int64)])).cast(pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), grams], ["node", "grams"])

        for b in batches:
            keys = b.column(1).to_numpy()
            for i in np.flatnonzero(passes(keys.view(np.uint64), asked)).tolist():
                nodes.append(keys[i])
                sets.append(np.unique(shingle_hashes(b.column(0)[i].as_py(), shingle)).view(np.int64))
                held += len(sets[-1]) + 10
                if held > 500_000:
                    yield batch()
                    nodes, sets, held = [], [], 0
        yield batch()

    found = documents.select("text", hash_of(F.col("text")).alias("node")).mapInArrow(run, "node long, grams array<long>")
    return found.groupBy("node").agg(F.first("grams").alias("grams"))


def verified(documents: DataFrame, pairs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """u, v: the pairs whose shingle sets are as similar."""
    asked = bitmap(pairs.select(F.explode(F.array("u", "v")).alias("node")), "node", 26)
    # the sets are dealt by node once, for both joins
    sets = shingle_sets(documents, asked, shingle)
    met = pairs.join(sets.select(F.col("node").alias("u"), F.col("grams").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("grams").alias("b")), "v")
    met = met.select("u", "v", F.size("a").alias("n_a"), F.size("b").alias("n_b"), F.size(F.array_intersect("a", "b")).alias("both"))
    return met.filter(F.col("both") >= similarity * (F.col("n_a") + F.col("n_b") - F.col("both")) - 1e-9).select("u", "v")


def near_copies(documents: DataFrame, scratch: Scratch | None = None, shingle: int = COPY_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, key, component_id of every row; a component's name is the least key (no doc_id, doc_id, text_hash) in it."""
    scratch = scratch or Scratch(documents.sparkSession, "copies")
    prints = sampled_prints(documents, shingle).withColumn("key", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    prints = scratch.write(prints, "prints")
    distinct = scratch.write(prints.groupBy(F.col("text_hash").alias("node")).agg(F.min("key").alias("least"), F.count("*").alias("n"), F.first("item").alias("item")), "distinct")
    tried = scratch.write(candidate_copies(distinct, similarity), "candidates")
    scratch.release()
    near = scratch.write(verified(documents, tried, shingle, similarity), "links")
    scratch.release()
    # what the lists and forests have left apart: every pair of different groups that may be a link
    inner = Scratch(documents.sparkSession, "copies-apart")
    roots = components(near, inner)
    frequent = bitmap(frequent_grams(documents, shingle), "h", 24)
    texts = prefixes(documents, frequent, shingle, similarity).join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "size", "sign", "keys")
    texts = inner.write(texts, "prefixes")
    apart = inner.write(open_copies(texts, inner, similarity).join(tried, ["u", "v"], "left_anti"), "pairs")
    for name in ("prefixes", "hits", "met"):
        inner.drop(name)
    inner.release()
    edges = near.union(inner.write(verified(documents, apart, shingle, similarity), "links"))
    inner.release()
    return grouped(prints.drop("item"), "text_hash", distinct.drop("item"), edges, "key", scratch)


def _row_hash(doc_id, text_hash):
    """Of the key of a row; a long, whatever type the doc_id has."""
    return F.xxhash64(F.col(doc_id).cast("long"), text_hash)


def keep_one(documents: DataFrame) -> DataFrame:
    """Documents, of each component of near copies only one row: that of the smallest doc_id (nulls last), of several the first by its text's hash."""
    scratch = Scratch(documents.sparkSession, "simhash-kept")
    found = near_copies(documents, scratch)
    keys = found.groupBy(F.col("doc_id").alias("id_"), F.col("text_hash").alias("hash_")).agg((~F.min("key").eqNullSafe(F.min("component_id"))).alias("gone"), F.count("*").alias("n"))
    changed = scratch.write(keys.filter("gone or n > 1"), "changed")
    # nearly all rows stay as they are: only those that a filter of the others lets through are dealt out with their texts
    asked = bitmap(changed.select(_row_hash("id_", "hash_").alias("row")), "row", 24)
    perhaps = F.pandas_udf(lambda x: pd.Series(passes(x.to_numpy().view(np.uint64), asked)), "boolean")(_row_hash("doc_id", hash_of(F.col("text"))))
    docs, of = meet(documents.filter(perhaps), changed)
    docs = docs.filter(of["gone"].isNull() | ~of["gone"])
    # rows that are equal in doc_id and text; the others need no comparison
    name = lambda c: of[c]._jc.toString()
    again = docs.filter(of["n"].isNotNull()).dropDuplicates([name("id_"), name("hash_")])
    met = docs.filter(of["n"].isNull()).unionByName(again).select(*quoted(documents))
    return documents.filter(~perhaps).select(*quoted(documents)).union(met)


def op2_simhash_groups(spark, sf_dir):
    from .common import read_table

    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
