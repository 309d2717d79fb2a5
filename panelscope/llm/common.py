"""Helpers shared by the corpus operators: scratch tables, word rules, Arrow output."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: space and \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]+"

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir); a temporary one only where that is unset."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="panelscope-")
        atexit.register(shutil.rmtree, _own["dir"], ignore_errors=True)
    return "file://" + _own["dir"]


class Scratch:
    """Parquet tables in the shared folder that cut lineage between the phases of one operator.

    They survive the loss of executors, and release() lets the shuffle files of finished phases go.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.at = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.at}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.at}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Spark removes shuffle files once the driver's JVM has collected the plans that made them."""
        gc.collect()
        self.spark._jvm.System.gc()


def clear(df: DataFrame, *names: str) -> DataFrame:
    """Without the columns (in any case of letters) that an operator is about to add."""
    mine = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in mine])


def hash_of(text: Column) -> Column:
    """XXH64 of a text, null as empty; with doc_id the key of a row, as doc_id may be null or repeated."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def quoted(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names hold."""
    return [F.col(f"`{c}`") for c in df.columns]


def meet(documents: DataFrame, table: DataFrame, how: str = "left", also: dict[str, str] | None = None, hint: str | None = None) -> tuple[DataFrame, dict[str, Column]]:
    """Documents joined with what was decided of rows by doc_id (id_), text (hash_) and also other columns, all null-safe.

    The table's columns get names that the documents haven't; the second result finds them.
    """
    taken = {c.lower() for c in documents.columns}
    names = {}
    for c in table.columns:
        name = c
        while name.lower() in taken:
            name += "_"
        names[c] = name
        taken.add(name.lower())
    table = table.select(*[F.col(c).alias(n) for c, n in names.items()])
    met = (hash_of(F.col("text")) == F.col(names["hash_"])) & F.col("doc_id").eqNullSafe(F.col(names["id_"]))
    for mine, its in (also or {}).items():
        met &= F.col(mine).eqNullSafe(F.col(names[its]))
    return documents.join(table.hint(hint) if hint else table, met, how), {c: F.col(n) for c, n in names.items()}


def changed_text(df: DataFrame, documents: DataFrame, text: Column, where: Column) -> DataFrame:
    """The documents' columns with a new text; n_chars, if there is one, follows it where the text has changed."""
    new = {"text": text}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.when(where, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return df.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in documents.columns])


def words(text: Column) -> Column:
    """Words between ASCII white space, by native functions; null: none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bitmap(df: DataFrame, key: str, bits: int) -> np.ndarray:
    """A filter of 2 ** bits bits, set at the low bits of the keys (longs); at most 2 ** (bits - 6) rows of 16 bytes reach the driver."""
    slot = F.col(key).bitwiseAND((1 << bits) - 1)
    rows = df.select(F.shiftright(slot, 6).alias("k"), F.expr(f"shiftleft(1L, cast({key} & 63 as int))").alias("b"))
    table = rows.groupBy("k").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[table.column("k").to_numpy()] = table.column("b").to_numpy().view(np.uint64)
    return out


def sifted(documents: DataFrame, table: DataFrame, bits: int = 24) -> tuple[DataFrame, DataFrame]:
    """Documents that may and that can't be among the rows of a written table (id_, hash_), without their texts being dealt out.

    By a filter of 2 ** bits bits that each executor gets: 2 ** (bits - 6) rows at most, however large the table (native).
    """
    slot = lambda doc_id, text: F.xxhash64(doc_id.cast("string"), text).bitwiseAND((1 << bits) - 1)
    one = table.select(slot(F.col("id_"), F.col("hash_")).alias("slot"))
    one = one.select(F.shiftright("slot", 6).alias("k"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("b"))
    k, b = (new_name(documents, n) for n in ("k", "b"))
    one = one.groupBy(F.col("k").alias(k)).agg(F.bit_or("b").alias(b))
    mine = slot(F.col("doc_id"), hash_of(F.col("text")))
    met = documents.join(F.broadcast(one), F.shiftright(mine, 6) == F.col(k), "left")
    hit = F.coalesce(F.getbit(F.col(b), mine.bitwiseAND(63).cast("int")) == 1, F.lit(False))
    return met.filter(hit).select(*quoted(documents)), met.filter(~hit).select(*quoted(documents))


def new_name(df: DataFrame, name: str) -> str:
    """The name, or a longer one if the table has it in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def passes(key: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which keys (unsigned) the filter lets through: all that it was made of, and some others."""
    slot = key & np.uint64(len(table) * 64 - 1)
    return (table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts are long rows: lowers the session's limit of rows in an Arrow batch, which executors hold several of."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


class Rows:
    """Collects output rows by column and hands out Arrow batches of bounded length."""

    def __init__(self, schema: pa.Schema, limit: int = 20_000):
        self.schema, self.limit, self.cols = schema, limit, [[] for _ in schema]

    def add(self, *values) -> None:
        for c, v in zip(self.cols, values, strict=True):
            c.append(v)

    def full(self) -> bool:
        return len(self.cols[0]) >= self.limit

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.cols, self.schema, strict=True)], schema=self.schema)
        self.cols = [[] for _ in self.schema]
        return out
