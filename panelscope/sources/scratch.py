"""Hub tables written to the folder that the cluster shares: plans that read them stay short, and a lost executor loses nothing."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where it is unset."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="panelscope-")
        atexit.register(shutil.rmtree, _own["dir"], ignore_errors=True)
    return "file://" + _own["dir"]


class Hub:
    def __init__(self, spark: SparkSession):
        self.spark, self.at = spark, f"{shared_folder(spark)}/panel-{uuid.uuid4().hex[:12]}"
        self.tables: dict[str, DataFrame] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """The table as written. Planning with constraint propagation grows steeply with chained conditional columns, so it is off meanwhile."""
        if name not in self.tables:
            conf, key = self.spark.conf, "spark.sql.constraintPropagation.enabled"
            before = conf.get(key, "true")
            conf.set(key, "false")
            try:
                df.write.parquet(f"{self.at}/{name}")
            finally:
                conf.set(key, before)
            self.tables[name] = self.spark.read.schema(df.schema).parquet(f"{self.at}/{name}")
        return self.tables[name]

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.at)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.tables.clear()
