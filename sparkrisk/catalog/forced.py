"""Queries again with the limits forced low, so that small tables take the path of large ones."""

from contextlib import contextmanager

from sparkrisk.catalog import describing, evaluation, outliers, validation
from sparkrisk.catalog.tables import distinct_scores, rounded, tied_scores
from sparkrisk.operators import metrics, stats

VALUES, BLOCK_BITS = 500, 6


@contextmanager
def low_limits():
    """Quantiles narrow columns of over VALUES values."""
    before = stats.DIRECT_LIMIT
    stats.DIRECT_LIMIT = VALUES
    try:
        yield
    finally:
        stats.DIRECT_LIMIT = before


def _forced(query):
    def run(spark, folder):
        with low_limits():  # quantiles and cuts are found while the query is built
            return query(spark, folder)
    return run


#: Curves over blocks of 64 scores.
_CURVES = {
    "roc_auc": lambda s, d: rounded(metrics.rank_metrics(distinct_scores(s, d), block_bits=BLOCK_BITS).select("roc_auc")),
    "average_precision": lambda s, d: rounded(metrics.rank_metrics(distinct_scores(s, d), block_bits=BLOCK_BITS).select("average_precision")),
    "rank_metrics_tied": lambda s, d: rounded(metrics.rank_metrics(tied_scores(s, d), block_bits=1)),
    "roc_points": lambda s, d: rounded(metrics.roc_points(distinct_scores(s, d), block_bits=BLOCK_BITS)),
    "pr_points": lambda s, d: rounded(metrics.precision_recall_points(distinct_scores(s, d), block_bits=BLOCK_BITS)),
}
_NAMES = {
    outliers: ["iqr_limits", "percentile_limits"], validation: ["median_impute"], describing: ["describe", "box_stats"],
}
QUERIES = {f"{n}_narrowed": _forced(family.QUERIES[n]) for family, names in _NAMES.items() for n in names}
QUERIES |= {f"{n}_narrowed": query for n, query in _CURVES.items()}
SQL = {f"{n}_narrowed": family.SQL[n] for family, names in _NAMES.items() for n in names}
SQL |= {f"{n}_narrowed": evaluation.SQL[n] for n in _CURVES}
