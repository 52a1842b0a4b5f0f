"""Where intermediate and result tables live, and how they are found again."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder
    of its own machine.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
        path = tempfile.mkdtemp(prefix="ride-analytics-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later jobs start from it, also after executor loss."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write and read back. Unlike a checkpoint this has true size statistics,
    so Spark can broadcast it by its own threshold, and columns can be pruned."""
    spark = df.sparkSession
    path = path or fresh_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def fingerprint(*inputs: DataFrame) -> str:
    """Digest that changes with the data behind ``inputs``.

    A table read from files stands for its plan and the names, sizes and times
    of its files; any other for the number of its rows and a sum of their hashes.
    """
    parts = []
    for df in inputs:
        files = sorted(df.inputFiles())
        if files:
            spark = df.sparkSession
            cut_after = spark.conf.get("spark.sql.debug.maxToStringFields")
            spark.conf.set("spark.sql.debug.maxToStringFields", str(2**31 - 1))  # else two plans with long lists look alike
            try:
                parts.append(df._jdf.queryExecution().optimizedPlan().canonicalized().toString())
            finally:
                spark.conf.set("spark.sql.debug.maxToStringFields", cut_after)
            folders = sorted({name.rsplit("/", 1)[0] for name in files})
            # sizes and times are read and hashed by the executors; contents are not
            status = spark.read.format("binaryFile").load(folders).select(F.xxhash64("path", "length", "modificationTime").alias("h"))
            parts.append("\n".join(files) if len(files) <= 1000 else hashlib.md5("\n".join(files).encode()).hexdigest())
            parts.append(str(status.agg(F.count("h"), F.sum(F.col("h").cast("decimal(38,0)"))).first()))
        else:
            row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
            parts.append(f"{df.schema.simpleString()}:{row[0]}:{row[1]}")
    return hashlib.md5("\n".join(parts).encode()).hexdigest()[:16]


def cached_table(spark: SparkSession, root: str, key: str, build: Callable[[], DataFrame], inputs: Sequence[DataFrame] = ()) -> DataFrame:
    """Table of an earlier run with the same key and the same ``inputs``, else built and written now."""
    path = f"{root}/{key}" + (f"-{fingerprint(*inputs)}" if inputs else "")
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_or_tune(spark: SparkSession, root: str, name: str, tune: Callable[[], tuple], key: object = None) -> tuple:
    """Fitted model and parameters from disk, else from ``tune()`` and saved.

    ``key`` is all that the model depends on: settings, grid, training data.
    """
    name = f"{name}_{hashlib.md5(repr(key).encode()).hexdigest()[:16]}"
    model_path, params_path = f"{root}/{name}_model", f"{root}/{name}_params"
    if exists(spark, f"{params_path}/_SUCCESS"):
        return load_model(model_path), load_params(spark, params_path)
    model, params = tune()
    save_model(model, model_path)
    save_params(spark, params, params_path)
    return model, params


def save_params(spark: SparkSession, params: dict, path: str) -> None:
    row = [(json.dumps(params, sort_keys=True),)]
    spark.createDataFrame(row, "params string").coalesce(1).write.mode("overwrite").json(path)


def load_params(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.schema("params string").json(path).first()["params"])


def append_metrics(metrics: DataFrame, root: str, run: str) -> None:
    """``metrics`` is long: model, metric, value. One partition folder per run, which a rerun replaces."""
    (metrics.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("run").parquet(root))


def load_metrics(spark: SparkSession, root: str, run: str | None = None) -> DataFrame:
    out = (spark.read.schema("model string, metric string, value double, run string").parquet(root))
    return out if run is None else out.where(F.col("run") == run)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_csv_tables(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """One CSV folder per named result table."""
    return {name: write_csv(table, f"{root}/{name}") for name, table in tables.items()}


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
