"""Load, clean, key, store and split a delimited file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrisk.functions import ident
from sparkrisk.operators.clean import clean
from sparkrisk.operators.prefixes import BLOCK_BITS, running_sums, written
from sparkrisk.operators.sample import holdout_split
from sparkrisk.sources.files import read_delimited, write_split_table, write_table
from sparkrisk.spec import MIXED, SEED, TARGET, TEST_SHARE

ROW_ID = "row_id"


def with_row_id(df: DataFrame, name: str = ROW_ID, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Adds a unique text key: the digest of the row and a running number among equal rows.

    It depends on the rows alone, not on files, partitions or the order of reading. Equal rows, however many, are
    numbered block by block of the written table.
    """
    cells = F.to_json(F.struct(*[ident(c).cast("string").alias(f"c{k}") for k, c in enumerate(df.columns)]))
    rows = written(df.withColumns({name: F.md5(cells.cast("binary")), "__one": F.lit(1)}), "keyless")
    numbered = running_sums(rows, [name], ["__one"], block_bits)
    key = F.concat_ws("-", ident(name), (F.col("__one_before") + 1).cast("string"))
    return numbered.select(*[ident(c) for c in df.columns], key.alias(name))


def load_and_prepare(
    spark: SparkSession,
    path: str,
    target: str = TARGET,
    mixed: str | None = MIXED,
    key: str | None = None,
    combined: bool = False,
    save_to: str | None = None,
    delimiter: str = ",",
    test_share: float = TEST_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Cleaned rows with a key, and with ``split`` unless ``combined``.

    ``key`` names a unique column of the file, kept as text; without one rows get the key of :func:`with_row_id`. With
    ``save_to`` the cleaned table goes to ``<save_to>/clean`` and the split table to
    ``<save_to>/split``, one folder per part.
    """
    try:
        raw = read_delimited(spark, path, delimiter)
    except FileNotFoundError as e:
        raise RuntimeError(f"no data could be loaded: {e}") from e
    cleaned = clean(raw, target, mixed, keep=[] if key is None else [key])
    if key is None:
        key = ROW_ID
        cleaned = with_row_id(cleaned)
    if save_to:
        write_table(cleaned, f"{save_to}/clean")
        cleaned = spark.read.parquet(f"{save_to}/clean")
    if combined:
        return cleaned
    split = holdout_split(cleaned, key, target, test_share, seed)
    if save_to:
        write_split_table(split, f"{save_to}/split")
        split = spark.read.parquet(f"{save_to}/split")
    return split
