"""Exact splits and folds of any number of strata: sizes, ranks and keys stay tables.

Keys at wanted ranks are found by distributed radix selection: rows are counted by stratum and leading digits of
their keys, the digits that hold a rank are opened further, and once few rows are left at each rank they are numbered.
What belongs to a stratum is joined to its rows at the end.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrisk.session import materialize

#: Rows that may be numbered for one rank.
FINISH = 5_000
#: Digits opened in a round, and all digits of a key.
_STEP, _DIGITS = 2, 32
#: A table is broadcast up to this size, which is measured first; beyond it both sides are shuffled.
BROADCAST_BYTES = 8 << 20
#: Keys of more rows than this are dealt to SALTS tasks; at most HOT_KEYS, the most frequent ones.
HOT_ROWS, HOT_KEYS = 100_000, 256
SALTS = 32
#: Above all keys, which are hexadecimal.
ABOVE = "g"


def running(df: DataFrame, order: list[Column], value: Column, output: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows before a row in the order, as a written table.

    Rows are sorted in ranges; only one sum for each range reaches the driver.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.monotonically_increasing_id()
    ranged = materialize(df.withColumn("__value", value).repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__id", number), "ranges")
    part = F.shiftright("__id", 33)
    totals = ranged.groupBy(part.alias("part")).agg(F.sum("__value").alias("total")).collect()
    before, starts = 0, []
    for r in sorted(totals, key=lambda r: r["part"]):
        starts.append((r["part"], before))
        before += r["total"]
    offsets = df.sparkSession.createDataFrame(starts, "__part long, __start long")
    upto = Window.partitionBy("__part").orderBy("__id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = F.sum("__value").over(upto) - F.col("__value")
    return ranged.withColumn("__part", part).join(F.broadcast(offsets), "__part").withColumn(
        output, (inside + F.col("__start")).cast("long")).drop("__part", "__start", "__id", "__value")


def attach(df: DataFrame, table: DataFrame, key: Column, name: str, counted: DataFrame | None = None) -> DataFrame:
    """Joins the one row of ``table`` whose ``name`` equals the key; any one key may hold a large share of the rows.

    ``counted`` are the rows from which frequent keys are found, where ``df`` is the same rows with more columns.
    """
    width = sum((F.octet_length(F.to_json(F.struct(F.col(c)))) for c in table.columns), F.lit(16))
    size = table.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        return df.join(F.broadcast(table), key == F.col(name), "left").drop(name)
    if df.isStreaming:  # the rows cannot be counted first
        hot = hot_here = F.lit(True)
    else:
        frequent = _frequent(df if counted is None else counted, key)
        hot, hot_here = (c.isin(frequent) if frequent else F.lit(False) for c in (key, F.col(name)))
    copied = table.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.when(hot_here, SALTS - 1).otherwise(0))))
    dealt = df.withColumn("__salt", F.when(key.isNull() | hot, (F.rand(5) * SALTS).cast("int")).otherwise(0))
    # Written tables look small to the planner, which would broadcast all copies.
    return dealt.join(copied.hint("merge"), (key == F.col(name)) & (F.col("__salt") == F.col("__copy")), "left").drop(name, "__salt", "__copy")


def _frequent(df: DataFrame, key: Column) -> list:
    """The keys that so many rows have that one task should not hold them all."""
    counted = df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    many = counted.where((F.col("n") > HOT_ROWS) & F.col("key").isNotNull())
    return [r["key"] for r in many.orderBy(F.desc("n"), "key").limit(HOT_KEYS).collect()]


def keys_at(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(stratum, rank, cut)``: the key at each 0-based rank of each stratum.

    ``df`` has ``stratum`` and ``key`` (32 hexadecimal digits, evenly spread), ``wanted`` has ``stratum, rank, n`` (rows of the
    stratum). A rank of ``n`` or more gives a key above all others. A key that repeats around a cut is an error.
    """
    beyond = wanted.where("rank >= n").select("stratum", "rank", F.lit(ABOVE).alias("cut"))
    open_ = materialize(wanted.where("rank < n").select("stratum", "rank", F.lit("").alias("prefix"), F.col("rank").alias("inside"), F.col("n").alias("size")), "ranks")
    depth = 0
    while (open_.agg(F.max("size")).first()[0] or 0) > FINISH:
        if depth >= _DIGITS:
            raise ValueError("the key is not unique")
        counted = _held(df, open_, depth).groupBy("stratum", "prefix", F.substring("key", 1, depth + _STEP).alias("longer")).agg(F.count(F.lit(1)).alias("many"))
        upto = Window.partitionBy("stratum", "prefix").orderBy("longer")
        counted = counted.withColumn("before", F.sum("many").over(upto) - F.col("many"))
        found = open_.join(counted, ["stratum", "prefix"]).where("inside >= before AND inside < before + many")
        open_ = materialize(found.select(
            "stratum", "rank", F.col("longer").alias("prefix"), (F.col("inside") - F.col("before")).alias("inside"), F.col("many").alias("size")), "ranks")
        depth += _STEP
    order = Window.partitionBy("stratum", "prefix").orderBy("key")
    placed = _held(df, open_, depth).withColumns({"place": F.row_number().over(order) - 1, "last": F.lag("key").over(order)})
    cut = F.when(F.col("last") == F.col("key"), F.raise_error(F.lit("the key is not unique")).cast("string")).otherwise(F.col("key"))
    found = open_.join(placed, ["stratum", "prefix"]).where("place = inside").select("stratum", "rank", cut.alias("cut"))
    return materialize(found.unionByName(beyond), "cuts")


def _held(df: DataFrame, open_: DataFrame, depth: int) -> DataFrame:
    """Rows of the strata and digits that hold a rank. Without digits yet no join is needed where strata are large."""
    prefixed = df.withColumn("prefix", F.substring("key", 1, depth))
    return prefixed.join(open_.select("stratum", "prefix").distinct(), ["stratum", "prefix"], "left_semi") if depth else prefixed


def sizes(df: DataFrame, stratum: Column) -> DataFrame:
    """``(stratum, n)`` as a written table; a missing stratum is an error."""
    table = materialize(df.groupBy(stratum.alias("stratum")).agg(F.count(F.lit(1)).alias("n")), "strata")
    if table.where("stratum IS NULL").limit(1).count():
        raise ValueError("rows with a missing stratum cannot be placed")
    return table


def test_sizes(table: DataFrame, test_share: float) -> DataFrame:
    """Adds ``test``: train rows by largest remainder, the rest is test."""
    total, strata, fewest = table.agg(F.sum("n"), F.count(F.lit(1)), F.min("n")).first()
    n_test = math.ceil(round(test_share * total, 9))
    n_train = total - n_test
    if not 0 < test_share < 1 or n_train <= 0:
        raise ValueError(f"test share {test_share} leaves one side of {total} rows empty")
    if fewest < 2 or n_test < strata:
        raise ValueError("every class needs two rows and each side room for every class")
    product = F.expr(f"CAST(n AS DECIMAL(19,0)) * CAST({n_train} AS DECIMAL(19,0))")
    parts = table.withColumn("train", F.expr(f"(CAST(n AS DECIMAL(19,0)) * CAST({n_train} AS DECIMAL(19,0))) div {total}L")).withColumn(
        "rest", (product % F.lit(total)).cast("long"))
    more = n_train - parts.agg(F.sum("train")).first()[0]
    placed = running(parts, [F.desc("rest"), F.asc("stratum")], F.lit(1), "place")
    return placed.select("stratum", "n", (F.col("n") - F.col("train") - (F.col("place") < more).cast("long")).alias("test"))


def holdout(df: DataFrame, stratum: Column, hashed: Column, test_share: float, output: str) -> DataFrame:
    """Adds ``train`` or ``test``, as ``sample.holdout_split`` does for few strata."""
    wanted = test_sizes(sizes(df, stratum), test_share).withColumnRenamed("test", "rank")
    cuts = keys_at(df.select(stratum.alias("stratum"), hashed.alias("key")), wanted)
    joined = attach(df, cuts.select(F.col("stratum").alias("__stratum"), F.col("cut").alias("__cut")), stratum, "__stratum")
    return joined.withColumn(output, F.when(hashed < F.col("__cut"), "test").otherwise("train")).drop("__cut")


def folds(df: DataFrame, stratum: Column, hashed: list[Column], n_folds: int, prefix: str) -> DataFrame:
    """Adds a fold for each of the hashed keys, as ``sample.repeated_folds`` does for few strata."""
    table = sizes(df, stratum)
    if table.agg(F.max("n")).first()[0] < n_folds:
        raise ValueError(f"no class has {n_folds} rows")
    started = running(table, [F.asc("stratum")], F.col("n"), "start")

    def dealt(f: int) -> Column:
        behind = F.pmod(F.lit(f) - F.col("start"), F.lit(n_folds))
        return F.greatest(F.lit(0), F.floor((F.col("n") - behind + (n_folds - 1)) / n_folds))

    ends, total = [], F.lit(0)
    for f in range(n_folds - 1):
        total = total + dealt(f)
        ends.append(F.struct(F.lit(f).alias("f"), total.cast("long").alias("rank")))
    each = started.select("stratum", "n", F.inline(F.array(*ends)))
    wanted, narrow = None, []
    for r, h in enumerate(hashed):
        mine = each.select(F.concat(F.lit(f"{r}:"), "stratum").alias("stratum"), "n", "f", "rank")
        wanted = mine if wanted is None else wanted.unionByName(mine)
        narrow.append(F.struct(F.concat(F.lit(f"{r}:"), stratum).alias("stratum"), h.alias("key")))
    wanted = materialize(wanted, "fold-ranks")
    cuts = keys_at(df.select(F.inline(F.array(*narrow))), wanted.select("stratum", "rank", "n").distinct())
    numbered = wanted.join(cuts, ["stratum", "rank"]).select(
        F.substring_index("stratum", ":", 1).alias("r"), F.expr("substring(stratum, instr(stratum, ':') + 1)").alias("__stratum"), "cut")
    lists = materialize(numbered.groupBy("__stratum").agg(*[
        F.collect_list(F.when(F.col("r") == str(r), F.col("cut"))).alias(f"__cuts_{r}") for r in range(len(hashed))]), "fold-cuts")
    joined = attach(df, lists, stratum, "__stratum")

    def passed(cuts: str, h: Column) -> Column:
        return F.size(F.filter(cuts, lambda c: h >= c)).cast("int")

    return joined.withColumns({f"{prefix}{r}": passed(f"__cuts_{r}", h) for r, h in enumerate(hashed)}).drop(*[f"__cuts_{r}" for r in range(len(hashed))])
