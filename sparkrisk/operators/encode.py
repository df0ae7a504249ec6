"""Feature encoding: scaled numbers, one-hot codes, ordinal ranks, in one projection.

Columns of very many categories keep these in a written dictionary, which is joined to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk.functions import column_type, ident, to_number
from sparkrisk.operators import stats, strata
from sparkrisk.operators.neighbours import vector
from sparkrisk.operators.stages import FitFirst, Learned, TypeConverters, keyword_only, make_param
from sparkrisk.session import materialize, scratch_path
from sparkrisk.spec import DEFAULT_SPEC, SCALE_RANGE, FeatureSpec

#: Categories of one column that stand in the plan; of more a dictionary is written.
LITERAL_CATEGORIES = 1000
_VALUES = {"whole": "bigint", "num": "double", "txt": "string"}
_DICTIONARY = "whole bigint, num double, txt string, rank bigint, at int"


def category_name(column: str, value) -> str:
    """``column_value``; dots are avoided because Spark reads them as field access."""
    if isinstance(value, float):
        text = str(int(value)) if value.is_integer() else repr(value)
    else:
        text = str(value)
    return f"{column}_{text.replace('.', '_')}"


class TableEncoder(FitFirst):
    """Learn medians, ranges, modes and sorted categories.

    Numeric columns are filled with the median and scaled to ``scaleRange``;
    nominal ones are filled with the mode and one-hot coded without their first
    category; ordinal ones are filled with the mode and replaced by their rank.

    A nominal column of more than ``literalCategories`` categories becomes one sparse vector column of the same
    codes under its own name, and the ranks of such an ordinal column are looked up in a table; neither the plan nor the driver
    holds its categories. Unseen values have no code and the rank -1.
    """

    numeric = make_param("numeric", "columns to scale", TypeConverters.toListString)
    nominal = make_param("nominal", "columns to one-hot code", TypeConverters.toListString)
    ordinal = make_param("ordinal", "columns to rank", TypeConverters.toListString)
    scaleRange = make_param("scaleRange", "low and high end", TypeConverters.toListFloat)
    literalCategories = make_param("literalCategories", "categories of a column that stand in the plan", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, numeric=None, nominal=None, ordinal=None, scaleRange=SCALE_RANGE, literalCategories=LITERAL_CATEGORIES):
        super().__init__()
        given = (numeric, nominal, ordinal)
        lists = (
            (DEFAULT_SPEC.numeric, DEFAULT_SPEC.nominal, DEFAULT_SPEC.ordinal)
            if all(g is None for g in given) else tuple(g or () for g in given)
        )
        low, high = (float(x) for x in scaleRange)
        if not low < high:
            raise ValueError("scaleRange must rise")
        self._set(numeric=list(lists[0]), nominal=list(lists[1]), ordinal=list(lists[2]),
                  scaleRange=[low, high], literalCategories=literalCategories)

    def _fit(self, df: DataFrame) -> TableEncoderModel:
        groups = {g: self.getOrDefault(g) for g in ("numeric", "nominal", "ordinal")}
        absent = [c for cols in groups.values() for c in cols if c not in df.columns]
        if absent:
            raise ValueError(f"columns not found: {absent}")
        numbers = stats.quantiles(df, groups["numeric"], [0.5])
        found = learn_categories(df, [*groups["nominal"], *groups["ordinal"]], self.getOrDefault("literalCategories"))
        return TableEncoderModel({
            "numeric": [
                {"column": c, "median": s["q"][0], "min": s["min"], "max": s["max"]}
                for c, s in numbers.items() if s["count"]
            ],
            "nominal": [{"column": c, **found[c]} for c in groups["nominal"] if c in found],
            "ordinal": [{"column": c, **found[c]} for c in groups["ordinal"] if c in found],
            "listed": [c for cols in groups.values() for c in cols],
            "range": self.getOrDefault("scaleRange"),
        })


def learn_categories(df: DataFrame, columns: Sequence[str], literal: int = LITERAL_CATEGORIES) -> dict[str, dict]:
    """For each column with a value its ``mode`` (smallest on ties) and its sorted ``categories``.

    A column of more than ``literal`` categories has in their place ``dictionary`` (a written table of values and their ranks), its
    number ``at`` in there, the ``kind`` of its values and their number ``size``. One group-by counts the values of all columns.
    """
    if not columns:
        return {}
    counts = materialize(stats.value_counts_long(df, columns), "category-counts")
    best = F.min(F.struct((-F.col("n")).alias("n"), *_VALUES)).alias("best")
    heads = {r["column"]: r for r in counts.groupBy("column").agg(F.count(F.lit(1)).alias("size"), best).collect()}
    found = {c: {"mode": stats.counted_value(r["best"])} for c, r in heads.items()}
    few = [c for c, r in heads.items() if r["size"] <= literal]
    for c in few:
        found[c]["categories"] = []
    for r in counts.where(F.col("column").isin(few)).collect():
        found[r["column"]]["categories"].append(stats.counted_value(r))
    for c in few:
        found[c]["categories"].sort()
    many = [c for c in columns if c in heads and c not in few]
    if many:
        path = write_dictionary(counts, {c: heads[c]["size"] for c in many})
        for at, c in enumerate(many):
            kind = next(k for k in _VALUES if heads[c]["best"][k] is not None)
            found[c] |= {"dictionary": path, "at": at, "kind": kind, "size": heads[c]["size"]}
    return found


def write_dictionary(counts: DataFrame, sizes: dict[str, int]) -> str:
    """Path of a table with the rank of each value among its column's, by columns numbered as in ``sizes``.

    Values are sorted in ranges of all columns together and numbered through; a column's ranks begin where those before it end.
    """
    at, start, before = F.lit(None).cast("int"), F.lit(None).cast("bigint"), 0
    for k, (c, size) in enumerate(sizes.items()):
        own = F.col("column") == c
        at, start = F.when(own, F.lit(k)).otherwise(at), F.when(own, F.lit(before)).otherwise(start)
        before += size
    rows = counts.where(F.col("column").isin(list(sizes))).select(at.alias("at"), start.alias("start"), *_VALUES)
    placed = strata.running(rows, [F.col("at"), *map(F.col, _VALUES)], F.lit(1), "place")
    path = scratch_path(counts.sparkSession, "categories")
    placed.select(*_VALUES, (F.col("place") - F.col("start")).alias("rank"), "at").write.partitionBy("at").parquet(path)
    return path


def unit_vector(rank: Column, size: int) -> Column:
    """Sparse vector of the codes of ranks 1 to ``size``; rank 0 and no rank give zeros."""
    held = rank >= 1
    entries = F.when(held, F.concat(F.lit('"indices":['), (rank - 1).cast("string"), F.lit('],"values":[1.0]'))).otherwise('"indices":[],"values":[]')
    text = F.concat(F.lit(f'{{"v":{{"type":0,"size":{size},'), entries, F.lit("}}"))
    return F.from_json(text, T.StructType([T.StructField("v", VectorUDT())]))["v"]


class _ModelWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        parts = self.instance.dictionary_parts
        for source in {p["dictionary"] for p in parts}:
            own = [p["at"] for p in parts if p["dictionary"] == source]
            table = SparkSession.active().read.schema(_DICTIONARY).parquet(source).where(F.col("at").isin(own))
            table.write.partitionBy("at").parquet(f"{path}/categories")


class _ModelReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        for p in model.dictionary_parts:
            p["dictionary"] = f"{path}/categories"
        return model


class TableEncoderModel(Learned):
    """Encoded columns first (numeric, one-hot, ordinal), then the columns not listed.

    Written dictionaries are saved with the model.
    """

    def write(self):
        return _ModelWriter(self)

    @classmethod
    def read(cls):
        return _ModelReader(cls)

    @property
    def dictionary_parts(self) -> list[dict]:
        return [p for p in [*self.learned["nominal"], *self.learned["ordinal"]] if "dictionary" in p]

    def _looked_up(self, df: DataFrame) -> DataFrame:
        """Adds the rank of each cell whose column has a dictionary."""
        spark, given = df.sparkSession, df
        for p in self.dictionary_parts:
            value = f"__value_{p['at']}"
            table = spark.read.schema(_DICTIONARY).parquet(p["dictionary"]).where(F.col("at") == p["at"]).select(
                F.col(p["kind"]).alias(value), F.col("rank").alias(_rank(p)))
            df = strata.attach(df, table, self._cell(df, p).cast(_VALUES[p["kind"]]), value, given)
        return df

    def _cell(self, df: DataFrame, part: dict) -> Column:
        c, dtype = part["column"], column_type(df, part["column"])
        if isinstance(dtype, T.StringType):
            value = ident(c)
        elif isinstance(dtype, T.IntegralType) and isinstance(part["mode"], int):
            value = ident(c).cast("bigint")
        else:
            value = to_number(ident(c), dtype)
        return F.coalesce(value, F.lit(part["mode"]))

    def _numeric(self, df: DataFrame) -> list[Column]:
        low, high = self.learned["range"]
        out = []
        for p in self.learned["numeric"]:
            v = F.coalesce(to_number(ident(p["column"]), column_type(df, p["column"])), F.lit(p["median"]))
            # A constant column has range one here, so it lands on the low end.
            span = (p["max"] - p["min"]) or 1.0
            scaled = (v - F.lit(p["min"])) / F.lit(span) * F.lit(high - low) + F.lit(low)
            out.append(scaled.alias(p["column"]))
        return out

    def _nominal(self, df: DataFrame) -> list[Column]:
        out = []
        for p in self.learned["nominal"]:
            if "dictionary" in p:
                size = p["size"] - 1
                out.append(unit_vector(F.col(_rank(p)), size).alias(p["column"], metadata=_width(size)))
                continue
            cell = self._cell(df, p)
            out += [F.when(cell == F.lit(v), 1.0).otherwise(0.0).alias(category_name(p["column"], v)) for v in p["categories"][1:]]
        return out

    def _ordinal(self, df: DataFrame) -> list[Column]:
        return [
            (F.coalesce(F.col(_rank(p)), F.lit(-1)) if "dictionary" in p else
             F.array_position(F.array(*[F.lit(v) for v in p["categories"]]), self._cell(df, p)) - 1)
            .cast("double").alias(p["column"])
            for p in self.learned["ordinal"]
        ]

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.feature_names
        listed = set(self.learned["listed"])
        rest = [c for c in df.columns if c not in listed]
        if len(set(names) | set(rest)) != len(names) + len(rest):
            raise ValueError("two encoded columns have the same name")
        df = self._looked_up(df)
        return df.select(*self._numeric(df), *self._nominal(df), *self._ordinal(df), *[ident(c) for c in rest])

    @property
    def feature_names(self) -> list[str]:
        """Names of the encoded columns in output order, passed-through columns left out."""
        s = self.learned
        return (
            [p["column"] for p in s["numeric"]]
            + [n for p in s["nominal"] for n in (
                [p["column"]] if "dictionary" in p else [category_name(p["column"], v) for v in p["categories"][1:]])]
            + [p["column"] for p in s["ordinal"]]
        )


def _rank(part: dict) -> str:
    return f"__rank_{part['at']}"


def _width(n: int) -> dict:
    """Column metadata by which a vector's length is known without reading a row."""
    return {"ml_attr": {"num_attrs": n}}


def widths(df: DataFrame, names: Sequence[str]) -> list[int]:
    """Cells that each encoded column takes in a feature vector."""
    return [df.schema[c].metadata["ml_attr"]["num_attrs"] if isinstance(column_type(df, c), VectorUDT) else 1 for c in names]


def dense_cells(df: DataFrame, names: Sequence[str]) -> Column:
    """All cells of the named columns as one array, vectors written out; a missing value is an error."""
    def is_vector(c: str) -> bool:
        return isinstance(column_type(df, c), VectorUDT)

    return F.concat(*[
        part for wide, run in groupby(names, is_vector) for part in (
            [vector_to_array(ident(c)) for c in run] if wide else [vector(list(run))])])


def as_columns(cells: Column, df: DataFrame, names: Sequence[str]) -> list[Column]:
    """The named columns again from an array that :func:`dense_cells` made."""
    out, at = [], 0
    for c, n in zip(names, widths(df, names)):
        if isinstance(column_type(df, c), VectorUDT):
            out.append(array_to_vector(F.slice(cells, at + 1, n)).alias(c, metadata=_width(n)))
        else:
            out.append(cells[at].alias(c))
        at += n
    return out


def encoder_for(spec: FeatureSpec) -> TableEncoder:
    return TableEncoder(numeric=list(spec.numeric), nominal=list(spec.nominal), ordinal=list(spec.ordinal))


def assemble(df: DataFrame, names: Sequence[str], output: str = "features") -> DataFrame:
    """Dense vector of the named columns; a missing value is an error."""
    return VectorAssembler(inputCols=list(names), outputCol=output, handleInvalid="error").transform(df)
