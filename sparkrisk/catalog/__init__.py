"""Registered queries over the test tables, with the SQL that checks them."""

from sparkrisk.catalog import (
    cleaning, describing, encoding, evaluation, explaining, forced, modelling, outliers, sampling, storing, validation,
)

_FAMILIES = (
    cleaning, validation, outliers, encoding, sampling, evaluation, describing, modelling, explaining, storing, forced,
)
QUERIES = {name: fn for family in _FAMILIES for name, fn in family.QUERIES.items()}
ORACLES = {name: sql for family in _FAMILIES for name, sql in family.SQL.items()}
