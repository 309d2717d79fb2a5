"""Byte-level BPE by recursive DuckDB queries inside each partition.

A text is cut into pre-tokens by the public pattern. The distinct pre-tokens of a slice that the worker hasn't met become
rows (word, position, token), one per byte, in an in-memory DuckDB of the worker. A recursive query joins neighbouring
rows with the merge table and contracts pairs until no pair of a word is in the table. Every round contracts each
word's leftmost pair of least rank and, in the same round, every other pair that nothing can forestall:

* a pair of tokens t, u is forestalled only by a merge (X, t) where X ends with the token before t, or by a merge (u, Y)
  where Y begins with the token after u, because tokens are only ever joined. before_least and after_least, the least ranks
  of such merges, are columns of the pair table, so that one comparison with the neighbours decides.

Words over LONG bytes take a query that also cuts a word wherever no merge can ever span two neighbours, contracts the
leftmost least pair of every piece, and with it, in alternation along runs, all pairs of that rank, unless what the pair
makes could go on to merge at a lower rank. A word of n bytes so ends after some log n rounds in practice, each of them linear.

Decoding joins the ids of each text with the vocabulary and aggregates their bytes in the order of positions.

What a worker holds is bounded: a slice has at most SLICE_BYTES of text but for one text alone, a query CHUNK_BYTES of words
but for one word alone, and the cache of words and their ids CACHE_BYTES, half of it words that were last met before the other half. The queries may spill to the executor's own
temporary folder; nothing there outlives the worker.

Null text: empty, no ids. Repeated rows and extra columns don't matter; nothing is shared between rows but words.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

ROUNDS, LONG, CHUNK_BYTES, CACHE_BYTES, SLICE_BYTES = 12, 64, 600_000, 128_000_000, 3_000_000
#: Above every rank; and what a cached word weighs besides its bytes.
NEVER, WORD_WEIGHT = 1 << 30, 180

#: Rows of every round; the rows of a word without a pair in the table go out once more, as done.
SHORT_SQL = """
WITH RECURSIVE run(word, pos, tok, after, round, done) AS (
    SELECT word, pos, tok, after, CAST(0 AS UTINYINT), false FROM state
  UNION ALL
    SELECT word, pos, made, after, round, done
    FROM (
        SELECT word, pos, made, round, done, CASE WHEN pick THEN lead(made, 2) OVER w ELSE lead(made) OVER w END AS after, lag(pick) OVER w AS eaten
        FROM (
            SELECT word, pos, round, best IS NULL AS done, pick, CASE WHEN pick THEN rank ELSE tok END AS made
            FROM (
                SELECT word, pos, tok, round, rank, best,
                       coalesce(rank < before_least AND rank <= after_least OR (CAST(rank AS BIGINT) << 32) + pos = best, false) AS pick
                FROM (
                    SELECT r.word, r.pos, r.tok, CAST(r.round + 1 AS UTINYINT) AS round, m.rank, coalesce(lag(m.before_least) OVER w, {never}) AS before_least, coalesce(lead(m.after_least) OVER w, {never}) AS after_least,
                           min((CAST(m.rank AS BIGINT) << 32) + r.pos) OVER (PARTITION BY r.word ORDER BY r.pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS best
                    FROM run r LEFT JOIN pairs m ON m.a = r.tok AND m.b = r.after
                    WHERE r.round < {rounds} AND NOT r.done
                    WINDOW w AS (PARTITION BY r.word ORDER BY r.pos)
                )
            )
        ) WINDOW w AS (PARTITION BY word ORDER BY pos)
    ) WHERE eaten IS NOT TRUE
)
SELECT word, pos, tok, after, done FROM run WHERE done OR round = {rounds}
"""
#: The same for long words, with a number for every row, the piece that it stands in, and the runs of a piece's least pairs.
LONG_SQL = """
WITH RECURSIVE run(word, pos, tok, after, round) AS (
    SELECT word, pos, tok, after, 0 FROM state
  UNION ALL
    SELECT word, pos, made, after, round
    FROM (
        SELECT word, pos, made, round, CASE WHEN pick THEN lead(made, 2) OVER w ELSE lead(made) OVER w END AS after, lag(pick) OVER w AS eaten
        FROM (
            SELECT word, pos, round, pick, CASE WHEN pick THEN rank ELSE tok END AS made
            FROM (
                SELECT word, pos, tok, round, rank,
                       coalesce(CASE WHEN rank IS NULL THEN false
                                     WHEN rank > least THEN rank < before_least AND rank <= after_least
                                     WHEN halts THEN rank < before_least AND rank <= after_least OR pos = min(CASE WHEN rank = least THEN pos END) OVER (PARTITION BY word, piece)
                                     ELSE (row - coalesce(max(CASE WHEN rank IS DISTINCT FROM least THEN row END) OVER k, min(row) OVER k - 1)) % 2 = 1 END, false) AS pick
                FROM (
                    SELECT *, min(rank) OVER (PARTITION BY word, piece) AS least, min(rank) OVER (PARTITION BY word) AS least_of_word
                    FROM (
                        SELECT r.word, r.pos, r.tok, r.round + 1 AS round, r.row, m.rank, m.halts,
                               coalesce(lag(m.before_least) OVER w, {never}) AS before_least, coalesce(lead(m.after_least) OVER w, {never}) AS after_least,
                               max(CASE WHEN m.a IS NULL THEN r.pos END) OVER (PARTITION BY r.word ORDER BY r.pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS piece
                        FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY pos) AS row FROM run WHERE round < {rounds}) r
                        LEFT JOIN pairs m ON m.a = r.tok AND m.b = r.after
                        WINDOW w AS (PARTITION BY r.word ORDER BY r.pos)
                    )
                ) WHERE least_of_word IS NOT NULL
                WINDOW k AS (PARTITION BY word, piece ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            )
        ) WINDOW w AS (PARTITION BY word ORDER BY pos)
    ) WHERE eaten IS NOT TRUE
)
SELECT word, pos, tok, after, round < {rounds} AS done FROM run JOIN (SELECT word AS ended, max(round) AS last FROM run GROUP BY word) ON word = ended AND round = last
"""
#: Texts of ids: entries of the vocabulary, a character per byte, in the order of positions.
DECODE_SQL = "SELECT seq, array_to_string(list(entry ORDER BY pos), '') FROM ids JOIN vocab USING (id) GROUP BY seq"


def vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines())}


def pair_table(ranks: dict[bytes, int]) -> np.ndarray:
    """Columns a, b, rank, before_least, after_least, halts of all pairs that some merge spans (rank NEVER: they don't merge themselves).

    The rank of a merge is that of the token it makes. halts: the token can merge on with a neighbour at a lower rank.
    """
    pairs: dict[tuple[int, int], list[int]] = {}
    onward: set[int] = set()
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is None or right is None:
                continue
            onward.update(x for x in (left, right) if x > rank)
            ends = [(j, ranks[token[j:i]]) for j in range(i) if token[j:i] in ranks]
            begins = [(k, ranks[token[i:k]]) for k in range(i + 1, len(token) + 1) if token[i:k] in ranks]
            for j, a in ends:
                for k, b in begins:
                    known = pairs.setdefault((a, b), [NEVER, NEVER, NEVER])
                    whole_left, whole_right = j == 0, k == len(token)
                    if whole_left and whole_right:
                        known[0] = rank
                    if whole_right:
                        known[1] = min(known[1], rank)
                    if whole_left:
                        known[2] = min(known[2], rank)
    return np.array([(a, b, *v, v[0] in onward) for (a, b), v in pairs.items()], np.int32).T


def numbered(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in groups of these lengths: the group's number and the place in the group."""
    first = np.cumsum(lengths) - lengths
    return np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), (np.arange(lengths.sum()) - np.repeat(first, lengths)).astype(np.int32)


class Codec:
    """One worker's DuckDB with pair table and vocabulary, and the words it has encoded."""

    def __init__(self, ranks: dict[bytes, int], pairs: np.ndarray, pattern: str, memory_mb: int = 160):
        import tempfile

        import duckdb
        import regex

        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.words: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.weight = 0
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": f"{memory_mb}MB", "temp_directory": tempfile.gettempdir() + "/panelscope-duckdb"})
        names = ("a", "b", "rank", "before_least", "after_least", "halts")
        spanned = pa.table(dict(zip(names, pairs, strict=True)))  # noqa: F841
        self.db.execute(f"CREATE TABLE pairs AS SELECT a, b, nullif(rank, {NEVER}) AS rank, before_least, after_least, halts = 1 AS halts FROM spanned")
        entries = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "entry": pa.array([t.decode("latin-1") for t in ranks])})  # noqa: F841
        self.db.execute("CREATE TABLE vocab AS SELECT * FROM entries")

    def merged(self, words: list[bytes], query: str, rounds: int) -> list[bytes]:
        """Ids of every word (unsigned 32-bit, little endian) by the recursive query."""
        out = [b""] * len(words)
        lengths = np.array([len(w) for w in words])
        word, pos = numbered(lengths)
        tok = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        last = np.zeros(len(tok), bool)
        last[np.cumsum(lengths) - 1] = True
        rows = pa.table({"word": word, "pos": pos.astype(np.uint8) if query is SHORT_SQL else pos, "tok": tok, "after": pa.array(np.append(tok[1:], 0), pa.int32(), mask=last)})  # noqa: F841
        self.db.execute("CREATE OR REPLACE TEMP TABLE state AS SELECT * FROM rows")
        while True:
            self.db.execute(f"CREATE OR REPLACE TEMP TABLE found AS {query.format(rounds=rounds, never=NEVER)}")
            done = self.db.execute("SELECT word, tok FROM found WHERE done ORDER BY word, pos").fetchnumpy()
            tok = done["tok"].astype("<u4")
            edges = np.flatnonzero(np.diff(done["word"], prepend=-1, append=-1)).tolist() if len(tok) else []
            for start, stop in zip(edges, edges[1:], strict=False):
                out[done["word"][start]] = tok[start:stop].tobytes()
            self.db.execute("CREATE OR REPLACE TEMP TABLE state AS SELECT word, pos, tok, after FROM found WHERE NOT done")
            if not self.db.execute("SELECT count(*) FROM state").fetchone()[0]:
                self.db.execute("DROP TABLE found")
                return out

    def learn(self, words: Iterable[str]) -> None:
        """A pre-token that is a token has its id; the others are merged, a bounded number of bytes at a time."""
        todo: tuple[list, list] = ([], [])
        size = [0, 0]

        def flush(k):
            if todo[k]:
                ids = self.merged([raw for _, raw in todo[k]], (SHORT_SQL, LONG_SQL)[k], (ROUNDS, ROUNDS // 3)[k])
                self.words.update(zip([w for w, _ in todo[k]], ids, strict=True))
                self.weight += sum(map(len, ids)) + size[k]
                todo[k].clear()
                size[k] = 0

        for w in words:
            raw = w.encode("utf-8", "surrogatepass")
            self.weight += WORD_WEIGHT
            if raw in self.ranks:
                self.words[w] = self.ranks[raw].to_bytes(4, "little")
                continue
            k = int(len(raw) > LONG)
            if size[k] + len(raw) > CHUNK_BYTES:
                flush(k)
            todo[k].append((w, raw))
            size[k] += len(raw)
        flush(0)
        flush(1)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids (unsigned 32-bit, little endian)."""
        cut = [self.find(t) for t in texts]
        if self.weight > CACHE_BYTES // 2:
            # of the older half only what is met again stays
            self.words, self.before, self.weight = {}, self.words, 0
        new = set().union(*cut).difference(self.words)
        again = new.intersection(self.before)
        for w in again:
            self.words[w] = self.before[w]
            self.weight += WORD_WEIGHT + len(self.words[w]) + len(w)
        self.learn(new - again)
        get = self.words.__getitem__
        return [b"".join(map(get, c)) for c in cut]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of every text from its ids."""
        seq, pos = numbered(np.array([len(x) // 4 for x in ids], np.int64))
        rows = pa.table({"seq": seq, "pos": pos, "id": np.frombuffer(b"".join(ids), "<u4").astype(np.int32)})
        self.db.register("ids", rows)
        out = [b""] * len(ids)
        for k, text in self.db.execute(DECODE_SQL).fetchall():
            out[k] = text.encode("latin-1")
        self.db.unregister("ids")
        return out


_codecs: dict[str, Codec] = {}


def codec(key: str, ranks: dict[bytes, int], pairs: np.ndarray, pattern: str) -> Codec:
    """The worker's codec of a vocabulary; it lives as long as the worker."""
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks, pairs, pattern)
    return _codecs[key]


def sliced(batches, at: int, rows: int = 2048, size: int = SLICE_BYTES):
    """Slices of the batches with a bounded number of rows and, but for one row alone, of bytes of text."""
    import pyarrow.compute as pc

    for b in batches:
        lengths = pc.binary_length(b.column(at)).to_pylist()
        start, total = 0, 0
        for i, n in enumerate(lengths):
            if i > start and (i - start >= rows or total + (n or 0) > size):
                yield b.slice(start, i - start)
                start, total = i, 0
            total += n or 0
        if start < len(lengths):
            yield b.slice(start)


def encode_documents(documents: DataFrame, path: str, pattern: str, with_ids: bool = True, with_decoded: bool = False, with_text: bool = True) -> DataFrame:
    """The documents' columns, then n_tokens, ids_sha256, decoded_sha256 and, if wanted, ids and decoded (binary).

    path: a rank file of the driver; its entries (at most some ten thousand) and the pairs that they span are sent to the executors.
    Without its text, a row is written back to Spark with ids and digests alone.
    """
    spark = documents.sparkSession
    added = {"n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"}
    keep = [c for c in documents.columns if c.lower() not in added]
    small_batches(spark)
    ranks = vocabulary(path)
    shared, key = spark.sparkContext.broadcast((ranks, pair_table(ranks))), f"{hash(frozenset(ranks.items()))}:{pattern}"
    at = [c.lower() for c in keep].index("text")

    def run(batches):
        c = codec(key, *shared.value, pattern)
        for b in sliced(batches, at):
            ids = c.encode([t or "" for t in b.column(at).to_pylist()])
            decoded = c.decode(ids)
            cols, names = list(b.columns), list(b.schema.names)
            if not with_text:
                del cols[at], names[at]
            cols += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(x).hexdigest() for x in decoded])]
            names += ["n_tokens", "ids_sha256", "decoded_sha256"]
            for wanted, name, values in ((with_ids, "ids", ids), (with_decoded, "decoded", decoded)):
                if wanted:
                    cols.append(pa.array(values, pa.binary()))
                    names.append(name)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    fields = [documents.schema[documents.columns.index(c)] for i, c in enumerate(keep) if with_text or i != at]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    for wanted, name in ((with_ids, "ids"), (with_decoded, "decoded")):
        if wanted:
            schema = schema.add(name, "binary")
    return documents.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def op8_byte_bpe(spark, sf_dir):
    import public_tokenizers

    from .common import read_table

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False, with_text=False)
