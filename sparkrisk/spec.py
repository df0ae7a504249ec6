"""Table description and default settings shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column groups, legal codes and settings of the credit table.
NUMERIC = ("laufzeit", "hoehe", "alter")
ORDINAL = ("beszeit", "rate", "wohnzeit", "verm", "bishkred", "beruf")
NOMINAL = (
    "laufkont", "moral", "verw", "sparkont", "famges", "buerge",
    "weitkred", "wohn", "pers", "telef", "gastarb",
)
RULES = {
    "laufkont": [1, 2, 3, 4],
    "moral": [0, 1, 2, 3, 4],
    "verw": [0, 1, 2, 3, 4, 5, 6, 8, 9, 10],
    "sparkont": [1, 2, 3, 4, 5],
    "famges": [1, 2, 3, 4],
    "buerge": [1, 2, 3],
    "weitkred": [1, 2, 3],
    "wohn": [1, 2, 3],
    "beszeit": [1, 2, 3, 4, 5],
    "rate": [1, 2, 3, 4],
    "wohnzeit": [1, 2, 3, 4],
    "verm": [1, 2, 3, 4],
    "bishkred": [1, 2, 3, 4],
    "beruf": [1, 2, 3, 4],
    "pers": [1, 2],
    "telef": [1, 2],
    "gastarb": [1, 2],
    "kredit": [0, 1],
}
TARGET = "kredit"
MIXED = "mixed_type_col"
SEED = 42
TEST_SHARE = 0.3
OUTLIER_COLUMNS = ("laufzeit", "wohnzeit", "alter", "bishkred", "hoehe")
OUTLIER_METHOD = "IQR"
OUTLIER_PERCENTILES = (0.05, 0.95)
SCALE_RANGE = (1.0, 2.0)
CV_FOLDS = 5
CV_REPEATS = 3
SMOTE_NEIGHBOURS = 5
BORDERLINE_NEIGHBOURS = 10
CLASS_LABELS = ("Malo", "Bueno")
METRICS = (
    "accuracy", "precision", "recall", "f1",
    "roc_auc", "average_precision", "geometric_mean",
)
# The earlier evaluation runs left average precision out.
METRICS_WITHOUT_AP = tuple(m for m in METRICS if m != "average_precision")


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns are numeric, ordinal and nominal, and what is legal in them."""

    numeric: tuple[str, ...] = NUMERIC
    ordinal: tuple[str, ...] = ORDINAL
    nominal: tuple[str, ...] = NOMINAL
    target: str = TARGET
    rules: dict = field(default_factory=lambda: dict(RULES))
    outlier_columns: tuple[str, ...] = OUTLIER_COLUMNS

    def __post_init__(self):
        listed = [*self.numeric, *self.ordinal, *self.nominal]
        twice = sorted({c for c in listed if listed.count(c) > 1})
        if twice:
            raise ValueError(f"columns listed in more than one group: {twice}")
        if self.target in listed:
            raise ValueError(f"target {self.target!r} is also listed as a feature")

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.nominal, *self.ordinal]


DEFAULT_SPEC = FeatureSpec()
