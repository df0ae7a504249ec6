"""Imputation: illegal cells to modes, missing cells to medians or modes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk.functions import column_type, ident, is_legal, present
from sparkrisk.operators import stats
from sparkrisk.operators.stages import FitFirst, Learned, TypeConverters, keyword_only, make_param
from sparkrisk.spec import RULES


def fill_value(df: DataFrame, column: str, value) -> Column:
    """Learned value as a literal; a whole number keeps the column's type."""
    dtype = column_type(df, column)
    if isinstance(value, int) or isinstance(value, float) and value.is_integer():
        return F.lit(value).cast(dtype)
    return F.lit(value)


def _missing_as_null(df: DataFrame, column: str) -> Column:
    dtype = column_type(df, column)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(ident(column), F.lit(None).cast(dtype))
    return ident(column)


class IllegalToMode(FitFirst):
    """Learn one mode per ruled column.

    ``modeOver="legal"`` looks at legal values only, so the fill value is always
    legal; ``"all"`` counts every present value, so it may itself be illegal.
    Columns the table lacks, and columns without a countable value, learn nothing.
    """

    rules = make_param("rules", "column -> legal values")
    modeOver = make_param("modeOver", "'legal' or 'all'", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, rules=None, modeOver="legal"):
        super().__init__()
        if modeOver not in ("legal", "all"):
            raise ValueError("modeOver must be 'legal' or 'all'")
        self._set(rules={c: list(v) for c, v in (rules or RULES).items()}, modeOver=modeOver)

    def _fit(self, df: DataFrame) -> IllegalToModeModel:
        rules = self.getOrDefault("rules")
        if self.getOrDefault("modeOver") == "legal":
            found = stats.legal_modes(df, rules)
        else:
            found = stats.modes(df, present(df, rules))
        return IllegalToModeModel({"rules": rules, "modes": found})


class IllegalToModeModel(Learned):
    """Replace illegal and missing cells by the learned mode."""

    @property
    def modes(self) -> dict:
        return self.learned["modes"]

    def _targets(self, df: DataFrame) -> list[str]:
        return present(df, self.modes)

    def _transform(self, df: DataFrame) -> DataFrame:
        rules = self.learned["rules"]
        return df.withColumns({
            c: F.when(is_legal(ident(c), rules[c]), ident(c)).otherwise(fill_value(df, c, self.modes[c]))
            for c in self._targets(df)
        })

    def report(self, df: DataFrame) -> DataFrame:
        """``(column, fill, imputed)`` that :meth:`transform` would replace."""
        rules = self.learned["rules"]
        return stats.stat_table(df, "column", {
            c: {"fill": F.lit(str(self.modes[c])), "imputed": F.count_if(~is_legal(ident(c), rules[c]))}
            for c in self._targets(df)
        })


class MissingFill(FitFirst):
    """Learn medians for ``median`` columns and modes for ``mode`` columns.

    Columns filled with their median become doubles, whatever the median is.
    """

    median = make_param("median", "columns filled with the median", TypeConverters.toListString)
    mode = make_param("mode", "columns filled with the mode", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, median: Sequence[str] = (), mode: Sequence[str] = ()):
        super().__init__()
        self._set(median=list(median), mode=list(mode))

    def _fit(self, df: DataFrame) -> MissingFillModel:
        medians = stats.quantiles(df, self.getOrDefault("median"), [0.5])
        fills: dict = {c: s["q"][0] for c, s in medians.items() if s["q"][0] is not None}
        medians = list(fills)
        fills.update(stats.modes(df, self.getOrDefault("mode")))
        return MissingFillModel({"fills": fills, "medians": [c for c in medians if c not in self.getOrDefault("mode")]})


class MissingFillModel(Learned):
    @property
    def fills(self) -> Mapping:
        return self.learned["fills"]

    def _transform(self, df: DataFrame) -> DataFrame:
        medians = set(self.learned.get("medians", ()))

        def filled(c: str) -> Column:
            if c in medians:
                return F.coalesce(_missing_as_null(df, c).cast("double"), F.lit(float(self.fills[c])))
            return F.coalesce(_missing_as_null(df, c), fill_value(df, c, self.fills[c]))

        return df.withColumns({c: filled(c) for c in present(df, self.fills)})
