"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models, of toxic and of ordinary texts, in which a word follows from the letters before:

    word <- its first six letters <- its first four letters <- shared estimate

P_c(w) = max(n_c(w) - D, 0) / N_c + f_c P_c(six) S(w | six), and likewise for six and four letters, where f_c is the mass that
class c's discounts have freed at that level and S comes from the counts of both classes together. Each class
discounts its own counts and passes the freed mass down by shared counts alone, so that expressions too rare to count in
either class get nearly equal odds in both, and inflected forms meet at their stems. Each level sums to one.

All counts are continuation counts, the number of distinct words that come before, so that copies of a text and
repeated lines add nothing. They are taken over all labelled rows of the folds crc32(doc_id) mod 3 = 0 and 2, by distributed
aggregates, into tables keyed by 64-bit hashes of the words and prefixes, which grow with the corpus. A word that no class
keeps after the discount has the ratio of its longest kept prefix, so only kept ones are looked up. Of these the KNOWN most
frequent per level go to the executors, the others as filters of 2 ** FILTER_BITS bits: whatever passes one is joined with
the tables, so that the bound decides where a word is looked up and never what is found.

What is compared is the length-normalised log-likelihood of the text under both models: over the whole text and over its most
suspicious stretches of STRETCHES words. A logistic curve over these differences is fitted on all labelled rows of both
folds, each scored by the counts of the other fold. Rows with remainder 1 are held out.

Null and empty texts are scored as texts without words. Only text enters a score. Of repeated labels of one doc_id
the larger counts. Without labelled rows of both classes every score is 0.5.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rows, Scratch, bitmap, clear, passes

#: Words, and prefixes of each length, whose ratios are sent to the executors, at most; the others are joined.
KNOWN, FILTER_BITS = 1 << 20, 26
#: Passes over the labelled rows, each counting the words of one remainder of their hashes: bounds the shuffle files held at once.
PASSES = 2
#: Taken from every count of a class and given to what the classes share.
DISCOUNT = 2.0
STRETCHES = (1, 4, 16)
PREDICTED_FROM = 0.7
FEATURES = 1 + len(STRETCHES)

_word = re.compile(r"[^\W\d_]+")


#: Models by the folds they are counted from: remainder 0, remainder 2, both; a row of bits per model.
MODELS = (1, 2, 3)
BOTH = 2
COUNTS = [f"n{m}{c}" for m in range(len(MODELS)) for c in (0, 1)]


def split(text: str | None) -> list[bytes]:
    return [x.encode("utf-8", "surrogatepass") for x in _word.findall((text or "").lower())]


def hashed(parts, n: int) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, n)


def prefixes(w: list[bytes]) -> list[np.ndarray]:
    # letters beyond ASCII take two bytes or more; prefixes are of the encoded word
    return [hashed((x[:k] for x in w), len(w)) for k in (6, 4)]


def count_events(labelled: DataFrame, passes: int = 1, one: int = 0) -> DataFrame:
    """Per word its hash, those of its prefixes, and its continuation counts by model and class, from rows of text, toxic and fold (a bit).

    A continuation count is a number of distinct words before, over all rows of the model's folds. Of several passes
    each gives the words of one remainder of their hashes.
    """
    schema = pa.schema([("word", pa.int64()), ("other", pa.int64()), ("four", pa.int64()), ("fold", pa.int32())])

    # a row is a pair with the word before (other: 40 bits of its hash, then the class), or, with fold 0, the word's prefixes (other: six letters)
    def pairs(batches):
        held, size, new, told = [], 0, set(), set()

        def out():
            word, other, fold = (np.concatenate(x) for x in zip(*held, strict=True))
            _, first = np.unique((word * np.uint64(0x9E3779B97F4A7C15)) ^ other ^ (fold.astype(np.uint64) << np.uint64(60)), return_index=True)
            # a word's prefixes are told once, or again when the task has forgotten
            w = list(new)
            if len(told) > 300_000:
                told.clear()
            told.update(w)
            new.clear()
            six, four = prefixes(w)
            none = lambda n: np.zeros(n, np.int64)
            cols = [
                np.concatenate([word[first], hashed(w, len(w))]).view(np.int64),
                np.concatenate([other[first], six]).view(np.int64),
                np.concatenate([none(len(first)), four.view(np.int64)]),
                np.concatenate([fold[first], none(len(w))]).astype(np.int32),
            ]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], schema=schema)

        for b in batches:
            for text, toxic, fold in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                w = split(text.as_py())
                if w:
                    word = hashed(w, len(w))
                    before = np.concatenate([np.zeros(1, np.uint64), word[:-1]])
                    other = (before >> np.uint64(24) << np.uint64(1)) | np.uint64(int(toxic))
                    mine = np.flatnonzero(word % np.uint64(passes) == one)
                    held.append((word[mine], other[mine], np.full(len(mine), fold, np.int32)))
                    new.update(w[k] for k in mine if w[k] not in told)
                    size += len(mine)
                if size > 1_000_000:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    pair = labelled.mapInArrow(pairs, "word long, other long, four long, fold int")
    pair = pair.groupBy("word", "other").agg(F.bit_or("fold").alias("fold"), F.max("four").alias("four"), F.min("four").alias("four_"))
    n = [F.count(F.when((F.col("fold").bitwiseAND(bits) != 0) & (F.col("other").bitwiseAND(1) == c), 1)).alias(f"n{m}{c}") for m, bits in enumerate(MODELS) for c in (0, 1)]
    own = F.col("fold") == 0
    part = [F.max(F.when(own, F.col("other"))).alias("six"), F.max(F.when(own, F.when(F.col("four") != 0, F.col("four")).otherwise(F.col("four_")))).alias("four")]
    return pair.groupBy("word").agg(*part, *n)


def ratios(counts: DataFrame, scratch: Scratch) -> tuple[list[DataFrame], list[float]]:
    """Tables key, n, r (log P_toxic - log P_ordinary by model) of words, of words unseen by their six and by their four letters; r of all others.

    A word has half a count in the shared estimate besides what it was counted, a prefix what its words have.
    """
    sums = [F.sum(x).alias(x) for x in COUNTS]
    word = counts.withColumn("words", F.lit(1))
    six = scratch.write(word.groupBy("six").agg(F.max("four").alias("four"), F.count("*").alias("words"), *sums), "sixes")
    four = scratch.write(six.groupBy("four").agg(F.sum("words").alias("words"), *sums), "fours")
    levels = [
        df.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("words"), *[F.coalesce(F.sum(x), F.lit(0)).cast("double").alias(x) for x in COUNTS], *[F.coalesce(F.sum(F.least(F.col(x).cast("double"), F.lit(DISCOUNT))), F.lit(0.0)).alias(f"d{x}") for x in COUNTS]).first()
        for df in (four, six, word)
    ]
    total = {x: max(levels[0][x], 1.0) for x in COUNTS}
    freed = [{x: (level[f"d{x}"] / total[x]) or 1.0 for x in COUNTS} for level in levels]
    each = [(m, c, f"n{m}{c}") for m in range(len(MODELS)) for c in (0, 1)]
    pooled = lambda m: F.col(f"n{m}0") + F.col(f"n{m}1") + 0.5 * F.col("words")
    kept = lambda x: F.greatest(F.col(x) - DISCOUNT, F.lit(0.0)) / total[x]

    def log_ratio(p, factor):
        one = lambda m, c: F.log(F.greatest(p(m, c) * factor(f"n{m}{c}"), F.lit(1e-30)))
        return F.array(*[one(m, 1) - one(m, 0) for m in range(len(MODELS))]).alias("r")

    def level(df, key, above, i):
        """Probabilities p{m}{c} and pooled counts s{m} of a level from those of the one above it."""
        if above is None:
            everything = [levels[0][f"n{m}0"] + levels[0][f"n{m}1"] + 0.5 * levels[0]["words"] or 1.0 for m in range(len(MODELS))]
            share = lambda m, c: pooled(m) / everything[m]
        else:
            df = df.join(above, key)
            share = lambda m, c: F.col(f"above_p{m}{c}") * pooled(m) / F.col(f"above_s{m}")
        return df.select("*", *[(kept(x) + freed[i][x] * share(m, c)).alias(f"p{m}{c}") for m, c, x in each], *[pooled(m).alias(f"s{m}") for m in range(len(MODELS))])

    def handed(df, key):
        return df.select(key, *[F.col(f"p{m}{c}").alias(f"above_p{m}{c}") for m, c, _ in each], *[F.col(f"s{m}").alias(f"above_s{m}") for m in range(len(MODELS))])

    p = lambda m, c: F.col(f"p{m}{c}")
    n = (F.col("n20") + F.col("n21")).alias("n")
    held = F.greatest(*COUNTS) > DISCOUNT
    four = level(four, None, None, 0)
    six = level(six, "four", handed(four, "four"), 1)
    word = level(word.filter(held), "six", handed(six, "six"), 2)
    # an unseen word or prefix, or one that no class keeps, has the same share of what is passed down in both classes
    tables = [
        word.filter(held).select(F.col("word").alias("key"), n, log_ratio(p, lambda x: 1.0)),
        six.filter(held).select(F.col("six").alias("key"), n, log_ratio(p, lambda x: freed[2][x])),
        four.filter(held).select(F.col("four").alias("key"), n, log_ratio(p, lambda x: freed[2][x] * freed[1][x])),
    ]
    rest = [float(np.prod([f[f"n{m}1"] / f[f"n{m}0"] for f in freed])) for m in range(len(MODELS))]
    return [scratch.write(t, f"ratios-{k}") for k, t in enumerate(tables)], [float(np.log(x)) for x in rest]


def most_frequent(table: DataFrame, limit: int) -> tuple[pa.Table, np.ndarray | None]:
    """key, r of the highest counts, at most so many, and a filter of the other keys if there are any."""
    step = F.floor(8 * F.log2(F.col("n") + 1)).cast("int")
    sizes = {r["step"]: r["count"] for r in table.groupBy(step.alias("step")).count().collect()}
    least, held = 1 << 30, 0
    for k in sorted(sizes, reverse=True):
        held += sizes[k]
        if held > limit:
            break
        least = k
    return table.filter(step >= least).select("key", "r").toArrow(), bitmap(table.filter(step < least), "key", FILTER_BITS) if held > limit else None


class Level:
    """Ratios of the most frequent words, or prefixes of a length, sorted by their hashes, and a filter of the others."""

    def __init__(self, table: pa.Table, others: np.ndarray | None):
        key = table.column("key").to_numpy().view(np.uint64)
        r = table.column("r").combine_chunks().flatten().to_numpy().astype(np.float32).reshape(len(key), len(MODELS))
        order = np.argsort(key)
        self.key, self.r, self.others = key[order], r[order], others

    def look(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ratios by word and model, which words are known, and which may be in the table."""
        perhaps = np.zeros(len(key), bool) if self.others is None else passes(key, self.others)
        if not len(self.key):
            return np.zeros((len(key), len(MODELS)), np.float32), np.zeros(len(key), bool), perhaps
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        found = self.key[at] == key
        return self.r[at], found, perhaps & ~found


class Known:
    """What the executors hold of words, six letters and four letters; what a level neither holds nor lets pass is unseen there."""

    def __init__(self, levels: list[Level], rest: list[float]):
        self.levels, self.rest = levels, np.array(rest, np.float32)

    def look(self, w: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ratios by word and model, and the places of words that only the tables can tell."""
        r = np.repeat(self.rest[None, :], len(w), 0)
        todo, asked = np.arange(len(w)), [np.zeros(0, np.int64)]
        for level, letters in zip(self.levels, (None, 6, 4), strict=True):
            if not len(todo):
                break
            found_r, found, perhaps = level.look(hashed((w[k][:letters] for k in todo), len(todo)))
            r[todo[found]] = found_r[found]
            asked.append(todo[perhaps])
            todo = todo[~found & ~perhaps]
        return r, np.concatenate(asked)


def features(r: np.ndarray) -> np.ndarray:
    """Of the ratios of a text's words, in their order."""
    if not len(r):
        return np.zeros(FEATURES)
    r = r.astype(float)
    sums = np.concatenate([[0.0], np.cumsum(r)])
    # the highest mean over a stretch of so many words
    tops = [float((sums[k:] - sums[:-k]).max() / k) if len(r) > k else float(r.sum() / k) for k in STRETCHES]
    return np.array([float(r.mean()), *tops])


def used(fold: int) -> list[int]:
    """Models of a row: of both folds and, in these, of the other fold."""
    return [BOTH] if fold == 1 else [BOTH, 1 if fold == 0 else 0]


def both_features(r: np.ndarray) -> list[list[float] | None]:
    found = [features(r[:, m]).tolist() for m in range(r.shape[1])]
    return [found[0], found[1] if len(found) > 1 else None]


def features_of(documents: DataFrame, tables: list[DataFrame], rest: list[float], scratch: Scratch, known: int) -> DataFrame:
    """doc_id, fold, x, y of every row: features by the counts of both folds and by those of the other fold (null where held out)."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(Known([Level(*most_frequent(t, known)) for t in tables], rest))
    missing = pa.list_(pa.struct([("word", pa.int64()), ("six", pa.int64()), ("four", pa.int64())]))
    vector = pa.list_(pa.float64())
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("fold", pa.int32()), ("x", vector), ("y", vector), ("r", pa.binary()), ("at", pa.binary()), ("missing", missing)])

    def first(batches):
        rows = Rows(schema, 5_000)
        for b in batches:
            for row, doc_id, fold, text in zip(*(b.column(k).to_pylist() for k in range(3)), b.column(3), strict=True):
                w = split(text.as_py())
                r, places = shared.value.look(w)
                r = r[:, used(fold)]
                if not len(places):
                    rows.add(row, doc_id, fold, *both_features(r), None, None, None)
                else:
                    one = {}
                    at = np.full(len(w), -1, np.int32)
                    at[places] = [one.setdefault(w[k], len(one)) for k in places]
                    parts = [x.view(np.int64).tolist() for x in (hashed(one, len(one)), *prefixes(list(one)))]
                    named = [{"word": a, "six": b, "four": c} for a, b, c in zip(*parts, strict=True)]
                    rows.add(row, doc_id, fold, None, None, r.tobytes(), at.tobytes(), named)
                if rows.full():
                    yield rows.batch()
        yield rows.batch()

    docs = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), remainder(F.col("doc_id")).cast("int").alias("fold"), "text")
    found = scratch.write(docs.mapInArrow(first, "row long, doc_id long, fold int, x array<double>, y array<double>, r binary, at binary, missing array<struct<word:bigint,six:bigint,four:bigint>>"), "first")
    open_rows = found.filter("missing is not null")
    if open_rows.isEmpty():
        return found
    missed = open_rows.select("row", F.posexplode("missing").alias("j", "m")).select("row", "j", "m.*")
    asked = missed.select("word", "six", "four").distinct()
    for k, name in enumerate(("word", "six", "four")):
        asked = asked.join(tables[k].select(F.col("key").alias(name), F.col("r").alias(f"r{k}")), name, "left")
    asked = scratch.write(asked.select("word", F.coalesce("r0", "r1", "r2", F.array(*map(F.lit, rest))).alias("r")), "asked")
    answers = missed.join(asked, "word").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("j", "r"))).alias("answers"))

    def second(batches):
        rows = Rows(pa.schema([schema.field(k) for k in range(1, 5)]), 5_000)
        for b in batches:
            for doc_id, fold, r, at, answers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                at = np.frombuffer(at, np.int32)
                r = np.frombuffer(r, np.float32).reshape(len(at), -1).copy()
                r[at >= 0] = np.array([a["r"] for a in answers], np.float32)[at[at >= 0]][:, used(fold)]
                rows.add(doc_id, fold, *both_features(r))
                if rows.full():
                    yield rows.batch()
        yield rows.batch()

    closed = open_rows.join(answers, "row").select("doc_id", "fold", "r", "at", "answers").mapInArrow(second, "doc_id long, fold int, x array<double>, y array<double>")
    return scratch.write(found.filter("missing is null").select("doc_id", "fold", "x", "y").unionByName(closed), "features")


def added(rows: DataFrame, of) -> np.ndarray | None:
    """Sum over all rows (y, toxic) of what `of` makes of a batch."""

    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                x = np.array(b.column(0).to_pylist(), float).reshape(-1, FEATURES)
                part = of(x, np.array(b.column(1).to_pylist(), float))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["s"])

    parts = [r["s"] for r in rows.mapInArrow(run, "s array<double>").collect()]
    return np.sum(parts, axis=0) if parts else None


def calibrate(rows: DataFrame) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic curve by Newton's method with a light ridge, over all rows (y, toxic)."""
    none = np.zeros(FEATURES), 0.0
    s = added(rows, lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(0), (x * x).sum(0)]))
    if s is None or not 0 < s[1] < s[0]:
        return none
    centre = s[2 : 2 + FEATURES] / s[0]
    scale = np.maximum(np.sqrt(np.maximum(s[2 + FEATURES :] / s[0] - centre**2, 0)), 1e-6)
    size = FEATURES + 1
    w = np.zeros(size)
    for _ in range(60):

        def slope(x, y, w=w):
            z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
            p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
            return np.concatenate([z.T @ (p - y), ((z * (p * (1 - p))[:, None]).T @ z).ravel()])

        s = added(rows, slope)
        step = np.linalg.solve(s[size:].reshape(size, size) + 0.5 * np.eye(size), s[:size] + 0.5 * w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / scale, float(w[-1] - (w[:-1] * centre / scale).sum())


def remainder(doc_id) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3))


def score_documents(documents: DataFrame, labels: DataFrame, known: int = KNOWN) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    scratch = Scratch(documents.sparkSession, "toxicity")
    documents = clear(documents, "_id", "toxic", "fold", "of")
    label = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    label = scratch.write(label.withColumn("of", remainder(F.col("_id"))).filter("of != 1"), "labels")
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), remainder(F.col("doc_id")).alias("fold")).filter("fold != 1")
    learnt = docs.join(label, F.col("doc_id") == F.col("_id")).select("text", "toxic", F.when(F.col("fold") == 0, 1).otherwise(2).alias("fold"))
    counts = None
    for k in range(PASSES):
        part = scratch.write(count_events(learnt, PASSES, k), f"counts-{k}")
        counts = part if counts is None else counts.unionByName(part)
        scratch.release()
    found = features_of(documents, *ratios(counts, scratch), scratch, known)
    scratch.release()
    weights, offset = calibrate(scratch.write(found.filter("fold != 1").join(label, F.col("doc_id") == F.col("_id")).select("y", "toxic"), "calibration"))
    z = F.lit(offset)
    for k, a in enumerate(weights.tolist()):
        z = z + F.lit(a) * F.col("x")[k]
    scored = found.select("doc_id", (F.col("fold") == 1).alias("held_out"), (1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(40.0)), F.lit(-40.0))))).alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"))


def op1_kneser_ney_toxicity(spark, sf_dir):
    from .common import read_table

    return score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
