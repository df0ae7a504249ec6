"""The fits of a cross-validation done together: statistics, encoded rows, resampling and scores of all fits by shared jobs.

A fit is numbered; ``masks`` say which rows it learns from. The statistics of a step are found for all fits by one pass over
a table that has each column once for each fit, empty where the fit does not learn from the row. Encoded rows of all
fits are written once, in a folder for each fit; the neighbour searches of the resampling treat the fits as groups.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrisk.functions import ident
from sparkrisk.operators.encode import TableEncoder, TableEncoderModel, dense_cells, widths
from sparkrisk.operators.impute import IllegalToMode, IllegalToModeModel
from sparkrisk.operators.models import FEATURES, LABEL, ScoreColumns, get_model
from sparkrisk.operators.oversample import GROUPED
from sparkrisk.operators.outliers import OutlierCapper, OutlierCapperModel
from sparkrisk.session import learning_rows, materialize

_ENCODER_LISTS = ("numeric", "nominal", "ordinal")
#: Columns that one pass holds statistics of; more take further passes.
_WIDTH = 150


def can_share(preprocessor: Estimator, sampler) -> bool:
    """Whether all steps are the library's own, the encoder last; anything else is fitted fold by fold."""
    if not isinstance(preprocessor, Pipeline) or sampler is not None and sampler not in GROUPED:
        return False
    kinds = [type(s) for s in preprocessor.getStages()]
    return bool(kinds) and kinds[-1] is TableEncoder and set(kinds[:-1]) <= {IllegalToMode, OutlierCapper}


def _columns(stage: Estimator) -> list[str]:
    if isinstance(stage, IllegalToMode):
        return list(stage.getOrDefault("rules"))
    if isinstance(stage, OutlierCapper):
        return list(stage.getOrDefault("columns"))
    return [c for name in _ENCODER_LISTS for c in stage.getOrDefault(name)]


def _own(fit: int, column: str) -> str:
    return f"{fit}|{column}"


def _repeated(stage: Estimator, fits: Sequence[int]) -> Estimator:
    """The stage for the columns of all fits."""
    def every(columns):
        return [_own(g, c) for g in fits for c in columns]

    if isinstance(stage, IllegalToMode):
        rules = stage.getOrDefault("rules")
        return IllegalToMode(rules={_own(g, c): v for g in fits for c, v in rules.items()}, modeOver=stage.getOrDefault("modeOver"))
    if isinstance(stage, OutlierCapper):
        return OutlierCapper(columns=every(_columns(stage)), method=stage.getOrDefault("method"), percentiles=stage.getOrDefault("percentiles"))
    return TableEncoder(**{name: every(stage.getOrDefault(name)) for name in _ENCODER_LISTS}, scaleRange=stage.getOrDefault("scaleRange"))


def _of_fit(stage: Estimator, fitted: Model, fit: int) -> Model:
    """What one fit learned, under the columns' own names."""
    learned = fitted.learned
    mark = _own(fit, "")

    def named(values: Mapping) -> dict:
        return {c.removeprefix(mark): v for c, v in values.items() if c.startswith(mark)}

    if isinstance(stage, IllegalToMode):
        return IllegalToModeModel({"rules": stage.getOrDefault("rules"), "modes": named(learned["modes"])})
    if isinstance(stage, OutlierCapper):
        return OutlierCapperModel({"limits": named(learned["limits"])})
    parts = {
        name: [{**p, "column": p["column"].removeprefix(mark)} for p in learned[name] if p["column"].startswith(mark)] for name in _ENCODER_LISTS}
    return TableEncoderModel({**parts, "listed": _columns(stage), "range": learned["range"]})


def fit_together(preprocessor: Pipeline, df: DataFrame, masks: Mapping[int, Column]) -> dict[int, PipelineModel]:
    """For each fit what ``preprocessor.fit`` learns from the rows of its mask, by jobs that fits share."""
    stages = preprocessor.getStages()
    columns = list(dict.fromkeys(c for s in stages for c in _columns(s)))
    present = [c for c in columns if c in df.columns]
    at_once = max(1, _WIDTH // max(1, len(present)))
    fits = list(masks)
    out: dict[int, PipelineModel] = {}
    for begin in range(0, len(fits), at_once):
        part = fits[begin:begin + at_once]
        wide = df.select(*[masks[g].alias(_own(g, "")) for g in part], *[
            F.when(masks[g], ident(c)).alias(_own(g, c)) for g in part for c in present])
        models: dict[int, list[Model]] = {g: [] for g in part}
        for k, stage in enumerate(stages):
            fitted = _repeated(stage, part).fit(wide)
            for g in part:
                models[g].append(_of_fit(stage, fitted, g))
            if k < len(stages) - 1:  # rows a fit does not learn from stay empty
                done = fitted.transform(wide)
                wide = done.select(*[ident(_own(g, "")) for g in part], *[
                    F.when(ident(_own(g, "")), ident(_own(g, c))).alias(_own(g, c)) for g in part for c in present])
        out.update({g: PipelineModel(models[g]) for g in part})
    return out


def encode_together(df: DataFrame, prepared: Mapping[int, PipelineModel], masks: Mapping[int, Column], key: str, target: str) -> tuple[DataFrame, dict[int, int]]:
    """``(grp, learns, key, label, y, vec)`` of every fit and row as a written table, and the length of each fit's vectors.

    Shorter vectors end in zeros, which change no distance.
    """
    names = {g: model.stages[-1].feature_names for g, model in prepared.items()}
    marks = {g: {"__learns": masks[g], "__key": ident(key), "__y": ident(target)} for g in prepared}
    encoded = {g: model.transform(df.withColumns(marks[g])) for g, model in prepared.items()}
    lengths = {g: sum(widths(encoded[g], names[g])) for g in prepared}
    longest = max(lengths.values())
    union = None
    for g in prepared:
        vec = F.concat(dense_cells(encoded[g], names[g]), F.array_repeat(F.lit(0.0), longest - lengths[g]))
        rows = encoded[g].select(
            F.lit(g).alias("grp"), F.col("__learns").alias("learns"), F.col("__key").alias("key"),
            F.col("__y").cast("string").alias("label"), F.col("__y").cast("double").alias("y"), vec.alias("vec"))
        union = rows if union is None else union.unionByName(rows)
    return materialize(union, "fold-rows", by=("grp",)), lengths


def scores_together(
    df: DataFrame, preprocessor: Pipeline, sampler: Callable | None, model: str, masks: Mapping[int, Column], key: str, target: str, parallelism: int,
) -> DataFrame:
    """``(grp, side, y_true, y_pred, y_score)`` of every fit and row as a written table.

    ``side`` is ``train`` for rows the fit learns from, else ``test``. Models are fitted ``parallelism`` at a time, each on the
    rows of its own folder and the synthetic ones.
    """
    prepared = fit_together(preprocessor, df, masks)
    rows, widths = encode_together(df, prepared, masks, key, target)
    added = None
    if sampler is not None:
        made = GROUPED[sampler](rows.where("learns").select("grp", "key", "label", "vec"), groups=max(masks) + 1)
        for label, synthetic in made:
            labelled = synthetic.select("grp", F.lit(label).cast("double").alias("y"), "vec")
            added = labelled if added is None else added.unionByName(labelled)
        added = added if added is None else materialize(added, "fold-synthetic", by=("grp",))

    def one(g: int) -> DataFrame:
        features = array_to_vector(F.slice("vec", 1, widths[g])).alias(FEATURES)
        own = rows.where(F.col("grp") == g)
        learned = own.where("learns").select("y", "vec")
        if added is not None:
            learned = learned.unionByName(added.where(F.col("grp") == g).select("y", "vec"))
        with learning_rows(learned.select(features, F.col("y").alias(LABEL)), min(parallelism, len(masks))) as (ready, n):
            fitted = get_model(model, n, widths[g]).fit(ready)
        held = own.select("grp", F.when(F.col("learns"), "train").otherwise("test").alias("side"), F.col("y").alias("y_true"), features)
        scored = ScoreColumns().transform(fitted.transform(held))
        return scored.select("grp", "side", "y_true", "y_pred", *(["y_score"] if "y_score" in scored.columns else []))

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        run = inheritable_thread_target(df.sparkSession)(one)
        tables = [job.result() for job in [pool.submit(run, g) for g in masks]]
    union = tables[0]
    for more in tables[1:]:
        union = union.unionByName(more)
    return materialize(union, "fold-scores")
