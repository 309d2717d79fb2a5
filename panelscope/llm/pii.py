"""PII: pattern spans, and terms that disclose protected entities by corpus co-occurrence (native).

Protected entities are the values that the patterns find, and secrets: runs of key characters that hold letters and
digits and whose characters carry SECRET_BITS of information each on average. The words within `WINDOW` characters on either
side of an entity are its context terms. Over the distinct texts of the corpus (exact copies count once) n(e), n(t) and
n(e, t) are counted: the texts with the entity, with the term anywhere, and with the term in a context of the
entity. With p(e) = n(e) / n and the smoothed p(e | t) = (n(e, t) + p(e)) / (n(t) + 1), which judges entities and terms of one
text like all others, a term discloses

    log2(p(e | t) / p(e)) / -log2 p(e)

of the information that the entity carries. Where that share reaches DISCLOSURE, the term is a span of kind `term` in every
text that holds the entity, at every place of the text. In a text without the entity the pair must have been seen in
another text than one: there n(e, t) counts one less, so that a single meeting tells of its own text alone. sanitise()
removes the terms and generalises the entities to their kinds.

Null text: empty. Offsets count code points. Terms and secrets never overlap base spans, nor terms secrets. What is found
depends on a row's text alone, so that rows which share a doc_id are judged one by one; a repeated row gives a repeated result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, changed_text, meet, sifted, words

WINDOW, DISCLOSURE, SECRET_BITS = 48, 0.8, 2.5
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
# The contract's patterns. A run of characters of the first class is entered only at its start or where
# the last match ended (\G), which changes no match and keeps long runs linear; possessive groups
# (++) iterate where plain ones recurse, and nothing after them could make them give back.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"[A-Za-z0-9+/_-]{16,}+",
}
WORD = r"[^\x20\x09-\x0D]+"
#: A text without this has no match of the kind.
NEEDS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "secret": r"[A-Za-z0-9+/_-]{16}"}


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(x: Column) -> Column:
    """Of a string of digits."""
    d = F.reverse(digits(x))
    each = F.transform(F.split(d, ""), lambda c, i: F.when(i % 2 == 0, F.try_to_number(c, F.lit("9")).cast("int")).otherwise(F.try_to_number(c, F.lit("9")).cast("int") * 2))
    return F.aggregate(each, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(F.coalesce(v, F.lit(0)))) % 10 == 0


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) < 3) | ((F.length(F.ltrim(p, F.lit("0"))) == 3) & (F.ltrim(p, F.lit("0")) <= "255")))
    if kind == "card":
        return F.length(digits(m)).between(13, 19) & luhn(m)
    if kind == "phone":
        return F.length(digits(m)).between(9, 15)
    if kind == "secret":
        return m.rlike("[0-9]") & m.rlike("[A-Za-z]") & (bits_per_character(m) >= SECRET_BITS)
    return F.lit(True)


def bits_per_character(x: Column) -> Column:
    """Entropy of the characters of a text that isn't empty."""
    n = F.length(x)
    counts = F.transform(F.array_distinct(F.split(x, "")), lambda c: (n - F.length(F.replace(x, c, F.lit("")))) / n)
    return F.aggregate(F.filter(counts, lambda q: q > 0), F.lit(0.0), lambda a, q: a - q * F.log2(q))


SPAN = "array<struct<kind:int,start:int,stop:int,value:string>>"


def spans_of(kind: str, text: Column) -> Column:
    """Spans of valid matches: lengths of what lies between matches and of the matches add up to offsets."""
    pattern = PATTERNS[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    pairs = F.transform(matches, lambda m, i: F.struct(F.get(between, i).alias("gap"), m.alias("m")))
    none = F.array().cast(SPAN)
    walked = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda a, p: F.struct(
            (a["at"] + p["gap"] + F.length(p["m"])).alias("at"),
            F.when(
                valid(kind, p["m"]),
                F.concat(a["out"], F.array(F.struct(F.lit(KINDS.index(kind)).alias("kind"), (a["at"] + p["gap"]).alias("start"), (a["at"] + p["gap"] + F.length(p["m"])).alias("stop"), p["m"].alias("value")))),
            ).otherwise(a["out"]).cast(SPAN).alias("out"),
        ),
        lambda a: a["out"],
    )
    return F.when(text.rlike(NEEDS[kind]), walked).otherwise(none)


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))


def find_base(documents: DataFrame) -> DataFrame:
    """row, doc_id, text_hash, spans (by kind, then start), contexts (distinct pairs of entity and term, as hashes), and the text of rows with spans."""
    text = F.coalesce("text", F.lit(""))
    d = documents.select("doc_id", text.alias("text"), F.monotonically_increasing_id().alias("row"))
    d = d.select("row", "doc_id", "text", F.concat(*[spans_of(k, F.col("text")) for k in BASE]).alias("base"), spans_of("secret", F.col("text")).alias("secrets"))
    d = d.select("row", "doc_id", "text", F.concat("base", apart(F.col("secrets"), F.col("base"))).alias("spans"))

    def terms(s: Column, left: bool) -> Column:
        low = F.greatest(s["start"] - WINDOW, F.lit(0)) if left else s["stop"]
        part = F.col("text").substr(low + 1, s["start"] - low) if left else F.col("text").substr(s["stop"] + 1, F.lit(WINDOW))
        # a word cut by the edge of the window is not a term
        gaps = F.split(part, WORD, -1)
        found = F.regexp_extract_all(part, F.lit(WORD), F.lit(0))
        placed = F.aggregate(
            F.transform(found, lambda w, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), w.alias("w"))),
            F.struct(low.alias("at"), F.array().cast("array<struct<w:string,start:int,stop:int>>").alias("out")),
            lambda a, p: F.struct(
                (a["at"] + p["gap"] + F.length(p["w"])).alias("at"),
                F.concat(a["out"], F.array(F.struct(p["w"].alias("w"), (a["at"] + p["gap"]).alias("start"), (a["at"] + p["gap"] + F.length(p["w"])).alias("stop")))).alias("out"),
            ),
            lambda a: a["out"],
        )
        edge = (lambda t: (t["start"] > low) | (low == 0)) if left else (lambda t: t["stop"] < s["stop"] + WINDOW)
        clean = apart(F.filter(placed, edge), F.col("spans"))
        return F.transform(clean, lambda t: F.struct(F.xxhash64(F.lower(s["value"])).alias("e"), F.xxhash64(F.lower(t["w"])).alias("t")))

    around = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.concat(terms(s, True), terms(s, False)))))
    return d.select("row", "doc_id", F.xxhash64("text").alias("text_hash"), "spans", F.when(F.size("spans") > 0, around).otherwise(F.array().cast("array<struct<e:bigint,t:bigint>>")).alias("contexts"), F.when(F.size("spans") > 0, F.col("text")).alias("text"))


def disclosing(base: DataFrame, documents: DataFrame, scratch: Scratch) -> DataFrame:
    """text_hash, t: the terms that disclose some entity, in every text that holds them."""
    pairs = base.select("text_hash", F.explode("contexts").alias("c")).select("text_hash", "c.*").distinct().groupBy("e", "t").agg(F.count("*").alias("n_et"))
    pairs = scratch.write(pairs, "pairs")
    held = documents.select(F.coalesce("text", F.lit("")).alias("text")).select(F.xxhash64("text").alias("text_hash"), F.explode(F.array_distinct(words(F.lower("text")))).alias("w")).select("text_hash", F.xxhash64("w").alias("t"))
    # of all words of the corpus only context terms are counted, and only those that tell something are met again
    counts = scratch.write(held.join(pairs.select("t").distinct(), "t", "left_semi").distinct().groupBy("t").agg(F.count("*").alias("n_t")), "counts")
    holds = base.select("text_hash", F.explode("spans.value").alias("v")).select("text_hash", F.xxhash64(F.lower("v")).alias("e")).distinct()
    texts = base.agg(F.count_distinct("text_hash").alias("n")).first()["n"]
    prior = F.col("n_e") / F.lit(max(texts, 1))
    tells = lambda n: F.log2((n + prior) / (F.col("n_t") + 1) / prior) >= DISCLOSURE * -F.log2(prior)
    judged = pairs.join(holds.groupBy("e").agg(F.count("*").alias("n_e")), "e").join(counts, "t").filter(F.col("n_e") < texts)
    judged = scratch.write(judged.select("e", "t", tells(F.col("n_et")).alias("here"), tells(F.col("n_et") - 1).alias("anywhere")).filter("here"), "judged")
    met = scratch.write(held.join(judged.select("t").distinct(), "t", "left_semi").distinct(), "met")
    anywhere = met.join(judged.filter("anywhere").select("t").distinct(), "t")
    here = met.join(judged.select("e", "t"), "t").join(holds, ["text_hash", "e"], "left_semi")
    return scratch.write(anywhere.select("text_hash", "t").union(here.select("text_hash", "t")).distinct(), "told")


def places(text: Column, terms: Column, spans: Column) -> Column:
    """(start, stop) of the words whose hashes are among the terms, apart from the spans."""
    found, gaps = F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.split(text, WORD, -1)
    length = lambda parts, n: F.length(F.array_join(F.slice(parts, 1, n), ""))
    marked = F.filter(F.transform(found, lambda w, i: F.when(F.array_contains(terms, F.xxhash64(F.lower(w))), i)), lambda i: i.isNotNull())
    starts = F.transform(marked, lambda i: F.struct((length(gaps, i + 1) + length(found, i)).alias("start"), F.length(F.get(found, i)).alias("n")))
    return apart(F.transform(starts, lambda s: F.struct(s["start"].alias("start"), (s["start"] + s["n"]).alias("stop"))), spans)


def find_spans(documents: DataFrame) -> DataFrame:
    """row, doc_id, text_hash, spans, terms: array of (start, stop) of disclosing terms, by start."""
    scratch = Scratch(documents.sparkSession, "pii")
    base = scratch.write(find_base(documents), "base")
    told = disclosing(base, documents, scratch)
    marked = scratch.write(told.groupBy(F.col("text_hash").alias("hash_")).agg(F.collect_list("t").alias("marks")), "marked")
    # nearly all texts with terms hold entities, whose rows have kept their text; of copies one is enough
    texts = base.filter(F.size("spans") > 0).select("text_hash", "text", "spans").join(marked, F.col("text_hash") == F.col("hash_"))
    own = texts.select("hash_", places(F.col("text"), F.col("marks"), F.col("spans")).alias("terms"))
    others = scratch.write(marked.join(base.filter(F.size("spans") > 0).select("text_hash"), F.col("text_hash") == F.col("hash_"), "left_anti"), "others")
    texts = documents.select("text").join(others, F.xxhash64("text") == F.col("hash_"))
    other = texts.select("hash_", places(F.col("text"), F.col("marks"), F.array().cast(SPAN)).alias("terms"))
    terms = own.union(other).groupBy("hash_").agg(F.first("terms").alias("terms"))
    terms = scratch.write(terms, "terms")
    scratch.release()
    none = F.array().cast("array<struct<start:int,stop:int>>")
    return base.join(terms, F.col("text_hash") == F.col("hash_"), "left").select("row", "doc_id", "text_hash", "spans", F.coalesce("terms", none).alias("terms"))


def joined(spans: Column, terms: Column | None = None) -> Column:
    named = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["stop"]))
    if terms is not None:
        named = F.concat(named, F.transform(terms, lambda s: F.concat_ws(":", F.lit("term"), s["start"], s["stop"])))
    return F.array_join(named, ",")


def sanitise(documents: DataFrame) -> DataFrame:
    """The documents, entities generalised to [KIND] and disclosing terms to [TERM]; n_chars follows the text."""
    found = find_spans(documents).filter((F.size("spans") > 0) | (F.size("terms") > 0))
    marks = F.concat(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)), F.lit("]")).alias("mark"))),
        F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.lit("[TERM]").alias("mark"))),
    )
    found = found.groupBy(F.col("doc_id").alias("id_"), F.col("text_hash").alias("hash_")).agg(F.first(F.array_sort(marks)).alias("marks"))
    found = Scratch(documents.sparkSession, "pii-marks").write(found, "marks")
    # only texts that may change are dealt out
    some, rest = sifted(documents, found)
    d, of = meet(some, found)
    # spans of different kinds can overlap: what an earlier span has covered is not written again
    text = F.aggregate(
        of["marks"],
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, m: F.struct(
            F.greatest(a["at"], m["stop"]).alias("at"),
            F.when(m["start"] >= a["at"], F.concat(a["out"], F.array(F.col("text").substr(a["at"] + 1, m["start"] - a["at"]), m["mark"]))).otherwise(a["out"]).alias("out"),
        ),
        lambda a: F.concat(F.array_join(a["out"], ""), F.col("text").substr(a["at"] + 1, F.length("text"))),
    )
    text = F.when(of["marks"].isNull() | F.col("text").isNull(), F.col("text")).otherwise(text)
    return changed_text(d, documents, text, of["marks"].isNotNull()).union(rest)


def op5_disclosure_spans(spark, sf_dir):
    from .common import read_table

    out = find_spans(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return out.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans"), F.col("terms")).alias("spans"),
        F.size("terms").cast("long").alias("n_terms"),
        F.size("spans").cast("long").alias("n_entities"),
    )
