"""Delimited-file source, and sinks for tables, predictions, metrics and results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk.functions import ident

# Cell texts that a table reader takes as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark knows."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_delimited(
    spark: SparkSession,
    path: str,
    delimiter: str = ",",
    schema: T.StructType | None = None,
    missing: Sequence[str] = MISSING_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited text with a header row, every column as text.

    Types are not inferred: that would read the data twice and turn on one odd
    cell. Give ``schema`` to skip the look at the header line as well. Quoted cells may hold line breaks
    with ``multi_line``; then a file is read by one task, so large data should come in many files.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no file at {path}")
    reader = spark.read.option("header", True).option("sep", delimiter).option("escape", '"').option("multiLine", multi_line)
    df = reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", False).csv(path)
    listed = list(missing)
    return df.select(*[
        F.when(~ident(f.name).isin(listed), ident(f.name)).alias(f.name)
        if listed and isinstance(f.dataType, T.StringType) else ident(f.name)
        for f in df.schema.fields
    ])


def write_delimited(df: DataFrame, path: str, delimiter: str = ",", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("sep", delimiter).option("escape", '"').csv(path)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Columnar by default; ``fmt="csv"`` writes a header."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_split_table(df: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> None:
    """One table with a folder per part, so a reader of one part skips the other."""
    write_table(df, path, partition_by=[split], mode=mode)


def write_features(train: DataFrame, test: DataFrame | None, path: str, mode: str = "overwrite") -> None:
    """Encoded train and test rows under ``<path>/train`` and ``<path>/test``."""
    write_table(train, f"{path}/train", mode=mode)
    if test is not None:
        write_table(test, f"{path}/test", mode=mode)


def predictions_table(
    df: DataFrame, truth: str | None, prediction: str | None = "y_pred", probability: str | None = "y_proba"
) -> DataFrame:
    """``y_true, y_pred[, y_proba]``, or only what was predicted where no truth is known."""
    cols = []
    if truth is not None:
        cols.append(ident(truth).cast("int").alias("y_true"))
    if prediction is not None and prediction in df.columns:
        cols.append(ident(prediction).cast("int").alias("y_pred"))
    if probability is not None and probability in df.columns:
        cols.append(ident(probability).cast("double").alias("y_proba"))
    return df.select(*cols)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Metrics or result documents, one JSON object per row."""
    df.write.mode(mode).json(path)


def results_document(
    summary: DataFrame, model: str, display_name: str, config: Mapping
) -> DataFrame:
    """One nested row ``{model, model_display_name, metrics, config}`` from a fold summary."""
    fields = ("test_mean", "test_std", "train_mean", "train_std")
    metrics = F.map_from_entries(F.collect_list(F.struct("metric", F.struct(*fields))))
    sampler = config.get("smote_config") or {}
    return summary.agg(metrics.alias("metrics")).select(
        F.lit(model).alias("model"), F.lit(display_name).alias("model_display_name"), "metrics",
        F.struct(
            *[F.lit(v).alias(k) for k, v in config.items() if k != "smote_config"],
            F.struct(*[F.lit(v).alias(k) for k, v in sampler.items()]).alias("smote_config")
            if sampler else F.lit(None).cast("string").alias("smote_config"),
        ).alias("config"),
    )
