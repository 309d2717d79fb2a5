"""Quality rules: per-document counts and cross-document line frequency per host (native).

One pass over the texts makes a narrow row per document: counts, a hash of the text, and for each
distinct normalised line its hash and words. A line is common on its host (the `source` column) when its distinct texts
reach the host's limit: SHARE of the host's distinct texts, but never under MIN_DOCS nor over MAX_DOCS, so that
a line of the same use is judged alike on small hosts and on one that holds a third of all rows. Exact
copies count once; copies are left to deduplication. Common lines are removed; a document that keeps fewer than
`keep_share` of its words, or none, is depleted and rejected.

Null text: no words, so it fails the base rule. Null source: a host of its own. Lines are compared
by 64-bit hashes of their lower-cased words. A repeated row counts once per distinct text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Scratch, changed_text, meet, words

MIN_DOCS, MAX_DOCS, SHARE, KEEP_SHARE = 5, 100, 0.02, 0.6
WORD = r"[^\x20\x09-\x0D]"


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, SPACE, " "))))


def features(documents: DataFrame) -> DataFrame:
    """doc_id, host, text_hash, base counts, and lines: array of (hash, words) of distinct normalised lines, words summed."""
    d = documents.select("doc_id", F.col("source").alias("host"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    d = d.select("doc_id", "host", "text", words(F.col("text")).alias("w"), F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)).alias("l"))
    d = d.withColumn("n_words", F.size("w").cast("long"))
    five = F.when(F.col("n_words") >= 5, F.expr("transform(sequence(0, cast(n_words as int) - 5), i -> xxhash64(w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]))")).otherwise(F.array().cast("array<long>"))
    d = d.withColumn("g", five)
    # places of windows that occur twice or more: neighbours in the order of (hash, place)
    by_hash = "sort_array(transform(g, (x, i) -> named_struct('x', x, 'i', i)))"
    again = f"aggregate(array({by_hash}), cast(array() as array<int>), (acc, s) -> array_sort(transform(filter(s, (e, j) -> get(s, j - 1).x <=> e.x or get(s, j + 1).x <=> e.x), e -> e.i)))"
    d = d.withColumn("p", F.when(F.size(F.array_distinct("g")) < F.size("g"), F.expr(again)).otherwise(F.array().cast("array<int>")))
    covered = "aggregate(transform(p, (x, j) -> least(5, coalesce(get(p, j + 1) - x, 5))), 0L, (a, x) -> a + x)"
    return d.select(
        "doc_id",
        "host",
        F.xxhash64("text").alias("text_hash"),
        "n_words",
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.expr(covered).alias("n_repeat_words"),
        F.transform("l", lambda x: F.struct(line_hash(x).alias("h"), F.size(words(x)).alias("n"))).alias("lines"),
    )


def common_lines(rows: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, h) of lines that as many distinct texts hold as the host's limit says, or more."""
    lines = rows.select("host", "text_hash", F.explode(F.array_distinct(F.col("lines.h"))).alias("h")).distinct()
    held = lines.groupBy("host", "h").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs)
    texts = rows.select("host", "text_hash").distinct().groupBy(F.col("host").alias("host_")).agg(F.count("*").alias("texts"))
    limit = F.greatest(F.lit(float(min_docs)), F.least(F.lit(float(max_docs)), share * F.col("texts")))
    return held.join(texts, F.col("host").eqNullSafe(F.col("host_"))).filter(F.col("n") >= limit).select("host", "h")


def judge(documents: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, keep_share: float = KEEP_SHARE) -> DataFrame:
    """A row per document: counts, n_common_words, common (hashes of its common lines), base_failed, kept."""
    return judge_texts(documents, min_docs, share, keep_share).drop("host", "text_hash")


def judge_texts(documents: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, keep_share: float = KEEP_SHARE) -> DataFrame:
    """The same with host and text_hash, on which alone a verdict depends."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "quality")
    rows = scratch.write(features(documents).withColumn("row", F.monotonically_increasing_id()), "features")
    common = scratch.write(common_lines(rows, min_docs, share).select(F.col("host").alias("host_"), F.col("h").alias("h_")), "common")
    hits = rows.select("row", "host", F.explode("lines").alias("line")).join(common, F.col("host").eqNullSafe(F.col("host_")) & (F.col("line.h") == F.col("h_")))
    removed = scratch.write(hits.groupBy("row").agg(F.sum("line.n").alias("n_common_words"), F.collect_set("h_").alias("common")), "removed")
    scratch.release()
    out = rows.drop("lines").join(removed, "row", "left").withColumn("n_common_words", F.coalesce("n_common_words", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_common_words")
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (left > 0) & (left >= keep_share * F.col("n_words"))).drop("row")


def filter_documents(documents: DataFrame) -> DataFrame:
    """Documents that are kept, without their common lines; n_chars follows the text."""
    scratch = Scratch(documents.sparkSession, "quality-kept")
    verdict = judge_texts(documents)
    # a table keyed by doc_id, host and text of what changes: rejected documents and those with common lines
    changes = verdict.filter(~F.col("kept") | (F.col("n_common_words") > 0))
    changes = changes.groupBy(F.col("doc_id").alias("id_"), F.col("host").alias("host_"), F.col("text_hash").alias("hash_")).agg(F.max("kept").alias("stays"), F.first("common", True).alias("common"))
    # much of a corpus has common lines: the same join at every size
    d, of = meet(documents, scratch.write(changes, "changed"), also={"source": "host_"}, hint="merge")
    rest = F.array_join(F.filter(F.split("text", "\n", -1), lambda x: ~F.array_contains(of["common"], line_hash(x))), "\n")
    text = F.when(of["common"].isNull(), F.col("text")).otherwise(rest)
    return changed_text(d.filter(F.coalesce(of["stays"], F.lit(True))), documents, text, of["common"].isNotNull())


def op6_quality_rules(spark, sf_dir):
    from .common import read_table

    out = judge(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
