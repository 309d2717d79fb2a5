"""Token counts by dynamic programming on a trie of distinct pre-tokens.

Pre-tokens are cut by the public pattern. A segmentation of a pre-token into vocabulary pieces scores the sum of its pieces'
unigram log-probabilities; the model gives a piece of rank r the probability of Zipf's law, 1 / (r + 1) over
the vocabulary's harmonic sum, as tokenizers are not trained here. The best segmentation of a prefix doesn't depend on what follows,
so a worker inserts the distinct pre-tokens into a trie whose nodes hold the forward score of their prefix: a prefix that
pre-tokens share is scored once, and each pre-token's count is stored at its terminal node. Equal scores take the fewer
pieces, then the shorter last piece.

Every byte is a piece, so that every text has a count. Pre-tokens of any length cost time linear in their bytes times
the longest piece. A worker's trie has at most NODES nodes before a text.

Null text: empty, no tokens. Repeated rows get equal counts each.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import vocabulary

#: Nodes of a worker's trie (some 150 bytes each); beyond, it starts anew before the next text.
NODES = 2_000_000


def scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    total = math.fsum(1 / (r + 1) for r in ranks.values())
    return {t: -math.log((r + 1) * total) for t, r in ranks.items()}


class Pieces:
    """The vocabulary turned round: a trie over reversed pieces finds all pieces that end at a place."""

    def __init__(self, score: dict[bytes, float]):
        self.root: dict = {}
        for piece, s in score.items():
            node = self.root
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[-1] = s


class Trie:
    """Distinct pre-tokens with a forward score per node: the best segmentation of the prefix that leads there, and its pieces.

    A node is reached by (parent, byte); terminal counts are kept by pre-token.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.best, self.count = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def add(self, word: str) -> int:
        """The pieces of a pre-token; prefixes that the trie has are not scored again."""
        w, child, best, count, root = word.encode("utf-8", "surrogatepass"), self.child, self.best, self.count, self.pieces.root
        path, node = [0], 0
        for end, byte in enumerate(w, 1):
            step = node << 8 | byte
            node = child.get(step)
            if node is None:
                at, back, top, least = end, root, -math.inf, 0
                while at:
                    at -= 1
                    back = back.get(w[at])
                    if back is None:
                        break
                    s = back.get(-1)
                    if s is not None:
                        s += best[path[at]]
                        n = count[path[at]] + 1
                        if s > top or s == top and n < least:
                            top, least = s, n
                node = child[step] = len(best)
                best.append(top)
                count.append(least)
            path.append(node)
        self.terminal[word] = count[node]
        return count[node]


_tries: dict[str, tuple] = {}


def count_documents(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every row. path: a rank file of the driver."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary(path))
    key = f"{path}:{pattern}"

    def run(batches):
        import regex

        if key not in _tries:
            _tries.clear()
            _tries[key] = (regex.compile(pattern).findall, Trie(Pieces(scores(shared.value))))
        find, trie = _tries[key]
        for big in batches:
            for i in range(0, big.num_rows, 1024):
                b = big.slice(i, 1024)
                n_pre, n_tok = [], []
                for text in b.column(1):
                    cut = find(text.as_py() or "")
                    if len(trie.best) > NODES:
                        trie.clear()
                    known = trie.terminal
                    for w in cut:
                        if w not in known:
                            trie.add(w)
                    n_pre.append(len(cut))
                    n_tok.append(sum(map(known.__getitem__, cut)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_pre, pa.int64()), pa.array(n_tok, pa.int64())], names=["doc_id", "n_pretokens", "n_tokens"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")


def op7_trie_token_counts(spark, sf_dir):
    import public_tokenizers

    from .common import read_table

    return count_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
