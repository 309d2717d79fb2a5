"""Sources and sinks: panel CSV files by period, store dimensions, and the benchmark tables as a panel."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.facts import first_rows

ITEM_REQUIRED = ("period_id", "store_id", "category", "sales_value", "sales_unit")
ITEM_OPTIONAL = {"prod_id": "long", "prod_desc_raw": "string", "nankey": "long", "brand": "string", "packsize": "string", "imdb_packsize": "string", "score": "double", "price_promo_factor": "double"}
STORE_COLUMNS = ("PERIODCODE", "STOREID", "PROVINCE", "SHOPTYPE", "PLATFORMNAME")
ITEM_FILE = r"itemcoding_output_(\d{8})_.*\.csv(\.gz)?$"
STORE_FILE = r"target_shop_qc_(\d{8})\.csv$"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, required: tuple[str, ...], encoding: str = "UTF-8") -> DataFrame:
    """All columns as text, with a check of the header. GB18030 needs spark.sql.legacy.javaCharsets=true."""
    df = spark.read.option("header", True).option("encoding", encoding).option("multiLine", True).csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return df


def read_items(spark: SparkSession, path: str, encoding: str = "UTF-8", missing_label: str | None = "nan") -> DataFrame:
    """Item rows with a fixed schema: text that is no number is null, absent optional columns are typed nulls.

    missing_label: what a missing store or category is called; None leaves it null. Keys that are no integers raise an error.
    """
    df = read_csv(spark, path, ITEM_REQUIRED, encoding)
    name = lambda c: F.coalesce(F.col(c), F.lit(missing_label)) if missing_label is not None else F.col(c)
    cols = [F.col("period_id").cast("int").alias("period_id"), name("store_id").alias("store_id"), name("category").alias("category")]
    cols += [F.col(c).try_cast("double").alias(c) for c in ("sales_value", "sales_unit")]
    for c, kind in ITEM_OPTIONAL.items():
        if c not in df.columns:
            cols.append(F.lit(None).cast(kind).alias(c))
        elif kind == "string":
            cols.append(F.coalesce(F.col(c), F.lit("")).alias(c))
        else:
            cols.append((F.col(c).cast(kind) if kind == "long" else F.col(c).try_cast(kind)).alias(c))
    return df.select(*cols)


def read_stores(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """One row per period and store; of several the first by their attributes."""
    df = read_csv(spark, path, STORE_COLUMNS, encoding)
    df = df.select(F.col("PERIODCODE").cast("int").alias("period_id"), F.coalesce("STOREID", F.lit("nan")).alias("store_id"), *[F.coalesce(c, F.lit("nan")).alias(c) for c in STORE_COLUMNS[2:]])
    return first_rows(df, ["period_id", "store_id"], list(STORE_COLUMNS[2:]))


def discover(names: list[str], pattern: str) -> dict[int, str]:
    """File of each period; a name with _fixed beats others, else the first by name."""
    out: dict[int, str] = {}
    for n in sorted(names, key=lambda n: ("_fixed" not in n, n)):
        m = re.search(pattern, n)
        if m:
            out.setdefault(int(m[1]), n)
    return dict(sorted(out.items()))


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(path)]


def read_periods(spark: SparkSession, folder: str, pattern: str, reader, periods: list[int] | None = None, encoding: str = "UTF-8") -> DataFrame:
    """One file per wanted period; rows of other periods in a file are left out."""
    found = discover(list_names(spark, folder), pattern)
    out = None
    for p, n in found.items():
        if periods is None or p in periods:
            one = reader(spark, f"{folder}/{n}", encoding).filter(F.col("period_id") == p)
            out = one if out is None else out.unionByName(one)
    if out is None:
        raise FileNotFoundError(f"{folder}: no file for the periods")
    return out


def write_sheets(sheets: dict[str, DataFrame], folder: str) -> None:
    """One Parquet folder per table; names are cut to 31 characters, as in workbooks."""
    for name, df in sheets.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name[:31]}")


def write_gzip_csv(df: DataFrame, folder: str) -> None:
    """UTF-8 without byte order mark, one file per partition."""
    df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(folder)


def factors_json(factors: DataFrame) -> DataFrame:
    """One JSON record per row; nulls are kept as null."""
    return factors.select(F.to_json(F.struct(*factors.columns), {"ignoreNullFields": "false"}).alias("json"))


# ------------------------------------------------------------------ benchmark tables as a panel
def panel_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as item rows of a retail panel: a period is a year of shipping, a store a customer."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    rows = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        F.year("l_shipdate").alias("period_id"),
        F.col("o_custkey").cast("string").alias("store_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("item"),
        F.col("l_partkey").alias("prod_id"),
        F.col("l_extendedprice").alias("sales_value"),
        F.col("l_quantity").alias("sales_unit"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("1X"), F.col("p_size").cast("string"), F.lit("G")).alias("packsize"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_returnflag",
    )


def panel_stores(spark: SparkSession, sf_dir: str, periods: tuple[int, ...] = tuple(range(1995, 2002))) -> DataFrame:
    """Customers as stores, in every period."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(
        F.explode(F.array(*map(F.lit, periods))).alias("period_id"), F.col("c_custkey").cast("string").alias("store_id"), F.col("n_name").alias("PROVINCE"), F.col("r_name").alias("SHOPTYPE"), F.col("c_mktsegment").alias("PLATFORMNAME")
    )


