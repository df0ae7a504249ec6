"""Sinks, persistence, training sweeps and streams: written, read back and checked."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkrisk.catalog import cleaning, encoding, evaluation, sampling
from sparkrisk.catalog.encoding import SPEC as ENCODE_SPEC
from sparkrisk.catalog.modelling import _PROBA, SPEC, fixed_model
from sparkrisk.catalog.tables import LABELLED, MIXED, TIED, labelled, load, mixed, modelling, raw, rounded, tied_scores
from sparkrisk.operators import clean, metrics, sample
from sparkrisk.operators.encode import assemble
from sparkrisk.plans import score, train
from sparkrisk.plans.features import feature_names, feature_pipeline, load_preprocessor, prepare_features
from sparkrisk.session import scratch_path
from sparkrisk.sources import files
from sparkrisk.spec import METRICS_WITHOUT_AP
from sparkrisk.streaming import clean_stream, score_stream


_FIGURES = ("test_mean", "test_std", "train_mean", "train_std")


def write_clean_table(spark, folder):
    path = scratch_path(spark, "clean")
    files.write_table(clean.clean(raw(spark, folder)), path)
    return rounded(spark.read.parquet(path))


def write_split_table(spark, folder):
    path = scratch_path(spark, "split")
    files.write_split_table(sample.holdout_split(labelled(spark, folder), "event_id", "y"), path)
    return spark.read.parquet(path).select("event_id", "y", "split")


def write_features(spark, folder):
    path = scratch_path(spark, "features")
    lines = mixed(spark, folder)
    odd = F.col("l_orderkey") % 2 == 1
    train_rows, test_rows, _ = prepare_features(lines.where(odd), lines.where(~odd), ENCODE_SPEC)
    files.write_features(train_rows, test_rows, path)
    parts = [spark.read.parquet(f"{path}/{p}").withColumn("part", F.lit(p)) for p in ("train", "test")]
    return rounded(parts[0].unionByName(parts[1]))


def metrics_json(spark, folder):
    path = scratch_path(spark, "metrics")
    files.write_json(metrics.metrics_document(metrics.evaluate(tied_scores(spark, folder))), path)
    read = spark.read.json(path)
    return rounded(read.select(
        "accuracy", "precision", "recall", "f1", "geometric_mean", "roc_auc", "average_precision", "confusion_matrix.*"))


def results_document(spark, folder):
    path = scratch_path(spark, "results")
    train.save_results(evaluation.cv_summary(spark, folder), "logistic_regression", path)
    read = spark.read.json(path)
    return rounded(read.select(
        "model", "model_display_name", "config.cv_folds", "config.cv_repeats", "config.random_seed",
        "config.smote_config.method", "config.smote_config.random_state", "config.smote_config.k_neighbors", "config.smote_config.m_neighbors",
        *[F.col(f"metrics.{m}.{f}").alias(f"{m}_{f}") for m in evaluation._RATIOS for f in _FIGURES]))


def save_load_preprocessor(spark, folder):
    path = scratch_path(spark, "preprocessor")
    df = mixed(spark, folder)
    fitted = feature_pipeline(ENCODE_SPEC, include_illegal=False, include_outliers=False).fit(df)
    fitted.write().overwrite().save(path)
    return rounded(load_preprocessor(spark, path).transform(df))


def save_load_model(spark, folder):
    path = scratch_path(spark, "model")
    fixed_model().write().overwrite().save(path)
    return rounded(train.load_model(spark, path).transform(labelled(spark, folder)).select("event_id", "y_pred", "y_proba"))


def encoded_names(spark, folder):
    fitted = feature_pipeline(ENCODE_SPEC, False, False).fit(mixed(spark, folder))
    return spark.createDataFrame([(n,) for n in feature_names(fitted)], "name string")


def dense_matrix(spark, folder):
    """Every vector, cell by cell, beside the row it was made of."""
    df = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax")
    x = vector_to_array("features")
    cells = assemble(df, df.columns[2:]).select("l_orderkey", "l_linenumber", F.size(x).alias("width"), *[x[j].alias(f"x{j}") for j in range(3)])
    return rounded(cells)


def model_sweep(spark, folder):
    table = train.sweep(modelling(spark, folder), "event_id", ["logistic_regression", "decision_tree"], SPEC, [None], 3, 1)
    return metrics.leaderboard(table)


def score_job(spark, folder):
    path = scratch_path(spark, "scores")
    score.score_job(fixed_model(), labelled(spark, folder), path, truth="y")
    return rounded(spark.read.parquet(f"{path}/predictions"))


def score_without_truth(spark, folder):
    path = scratch_path(spark, "scores")
    score.score_job(fixed_model(), labelled(spark, folder).drop("y"), path, proba=True)
    return rounded(spark.read.parquet(f"{path}/predictions"))


def cv_without_average_precision(spark, folder):
    pipeline = train.TrainingPipeline(key="event_id", spec=SPEC, sampler=None)
    return train.cross_validate(modelling(spark, folder), pipeline, 5, 1, seed=5, metric_names=METRICS_WITHOUT_AP)


def stream_clean(spark, folder):
    source, sink, mark = (scratch_path(spark, n) for n in ("stream-in", "stream-out", "stream-mark"))
    batch = raw(spark, folder)
    batch.write.parquet(source)
    rows = clean_stream(spark.readStream.schema(batch.schema).parquet(source))
    query = rows.writeStream.format("parquet").option("checkpointLocation", mark).trigger(availableNow=True).start(sink)
    query.awaitTermination()
    return rounded(spark.read.parquet(sink))


def stream_encode(spark, folder):
    """A preprocessor fitted on the table, applied to the rows as they arrive."""
    source, sink, mark = (scratch_path(spark, n) for n in ("stream-in", "stream-out", "stream-mark"))
    df = mixed(spark, folder)
    fitted = feature_pipeline(ENCODE_SPEC, include_illegal=False, include_outliers=False).fit(df)
    df.write.parquet(source)
    rows = spark.readStream.schema(df.schema).parquet(source)
    score_stream(rows, fitted, sink, mark).awaitTermination()
    return rounded(spark.read.parquet(sink))


QUERIES = {
    "write_clean_table": write_clean_table,
    "write_split_table": write_split_table,
    "write_features": write_features,
    "metrics_json": metrics_json,
    "results_document": results_document,
    "save_load_preprocessor": save_load_preprocessor,
    "save_load_model": save_load_model,
    "feature_names": encoded_names,
    "dense_matrix": dense_matrix,
    "model_sweep": model_sweep,
    "score_job": score_job,
    "score_without_truth": score_without_truth,
    "cv_without_average_precision": cv_without_average_precision,
    "stream_clean": stream_clean,
    "stream_encode": stream_encode,
}

_SUMMARY = evaluation.SQL["cv_summary"]
SQL = {
    "write_clean_table": cleaning.SQL["clean_pipeline"],
    "write_split_table": sampling.SQL["stratified_split"],
    "write_features": encoding.SQL["fit_train_apply_test"],
    "metrics_json": f"""WITH {TIED}, {evaluation._STEPS}, c AS (SELECT {evaluation._CELLS} FROM scored),
      m AS (SELECT *, {evaluation._EXACT} FROM c), r AS (SELECT {evaluation._AUC}, {evaluation._AP} FROM steps)
      SELECT {evaluation._ROUNDED}, roc_auc, average_precision,
             true_negatives, false_positives, false_negatives, true_positives FROM m, r""",
    "results_document": f"""WITH s AS ({_SUMMARY}) SELECT 'logistic_regression' AS model,
      'Logistic Regression' AS model_display_name, CAST(5 AS BIGINT) AS cv_folds, CAST(3 AS BIGINT) AS cv_repeats,
      CAST(42 AS BIGINT) AS random_seed, 'BorderlineSMOTE' AS method, CAST(42 AS BIGINT) AS random_state,
      CAST(5 AS BIGINT) AS k_neighbors, CAST(10 AS BIGINT) AS m_neighbors, """ + ", ".join(
        f"(SELECT {f} FROM s WHERE metric = '{m}') AS {m}_{f}" for m in evaluation._RATIOS for f in _FIGURES),
    "save_load_model": f"""WITH {LABELLED} SELECT event_id, CASE WHEN {_PROBA} > 0.5 THEN 1 ELSE 0 END AS y_pred,
      ROUND({_PROBA}, 6) AS y_proba FROM labelled""",
    "score_job": f"""WITH {LABELLED} SELECT y AS y_true, CASE WHEN {_PROBA} > 0.5 THEN 1 ELSE 0 END AS y_pred,
      ROUND({_PROBA}, 6) AS y_proba FROM labelled""",
    "score_without_truth": f"WITH {LABELLED} SELECT ROUND({_PROBA}, 6) AS y_proba FROM labelled",
    "save_load_preprocessor": encoding.SQL["encode_all"],
    "feature_names": f"""WITH {MIXED}
      SELECT UNNEST(['quantity', 'price', 'line', 'tax']) AS name
      UNION ALL SELECT 'flag_' || flag FROM (SELECT DISTINCT flag FROM mixed WHERE flag IS NOT NULL)
        WHERE flag > (SELECT MIN(flag) FROM mixed)
      UNION ALL SELECT 'status_' || status FROM (SELECT DISTINCT status FROM mixed)
        WHERE status > (SELECT MIN(status) FROM mixed)""",
    "dense_matrix": """SELECT l_orderkey, l_linenumber, CAST(3 AS INTEGER) AS width, ROUND(l_quantity, 6) AS x0, ROUND(l_extendedprice, 6) AS x1,
      ROUND(l_tax, 6) AS x2 FROM lineitem""",
    "stream_clean": cleaning.SQL["clean_pipeline"],
    "stream_encode": encoding.SQL["encode_all"],
}
