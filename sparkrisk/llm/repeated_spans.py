"""Removal of long word sequences that occur elsewhere, by compaction of a De Bruijn graph.

Some word k-mers of every text, chosen by their content so that each window holds one at least, are the edges
of a graph in which an edge leads to the one that follows it in a text. Edges that occur once are dropped. What
is left is compacted: a run of edges without branches becomes one path, found by joins that double the
known distance to the path's start. Paths give the source coordinates where a repeated window may lie; there,
and only there, whole windows are compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import grams, hashed_words, map_texts
from sparkrisk.session import materialize

WINDOW = 35
EDGE = 8


def _sliding(a: np.ndarray, width: int, op) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        a, have = op(a[:-have], a[have:]), have * 2
    return op(a[:have - width], a[width - have:]) if have < width else a


def edges(words: np.ndarray, window: int = WINDOW, edge: int = EDGE) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-mers that are the least of some window; equal windows share one, at the same place."""
    if len(words) < window:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    width = window - edge + 1
    hashes = grams(words, edge)
    least = _sliding(hashes, width, np.minimum)
    reach = _sliding(np.pad(least, width - 1), width, np.maximum)
    places = np.flatnonzero(hashes == reach)
    return places.astype(np.int32), hashes[places].view(np.int64)


def compact(arcs: DataFrame) -> DataFrame:
    """(edge, path): the start of the path without branches that the edge lies on.

    ``arcs`` are distinct (a, b), b following a somewhere. An arc has no branch if a has no other successor and b no other
    predecessor. Each round looks twice as far back; it ends when no edge comes nearer to its start, which only
    edges on a circle never reach: each of those is a path of its own.
    """
    arcs = materialize(arcs.where("a <> b"), "arcs")
    out = arcs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("a")
    into = arcs.groupBy("b").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("b")
    inner = arcs.join(out, "a", "left_semi").join(into, "b", "left_semi").select(F.col("b").alias("edge"), F.col("a").alias("back"))
    reach = materialize(inner, "paths")
    open_ = None
    while True:
        further = reach.select(F.col("edge").alias("back"), F.col("back").alias("further"))
        # An edge whose "back" is not in the table has come to the start of its path.
        reach = materialize(reach.join(further, "back", "left").select(
            "edge", F.coalesce("further", "back").alias("back"), F.col("further").isNotNull().alias("moved")), "paths")
        moved = reach.where("moved").count()
        if moved in (0, open_):
            break
        open_ = moved
        reach = reach.drop("moved")
    return reach.select("edge", F.when(F.col("moved"), F.col("edge")).otherwise(F.col("back")).alias("path"))


def spans(docs: DataFrame, window: int = WINDOW, edge: int = EDGE) -> DataFrame:
    """(text_hash, spans): for each text with repeated edges the places of the first and last edge of each stretch of a path.

    ``docs`` has columns text_hash and text.
    """
    def work(texts):
        for _, words in hashed_words(texts, block=50_000):
            places, hashes = edges(words, window, edge)
            if len(places) == 0:
                yield [], []
                continue
            own, at, n = np.unique(hashes, return_inverse=True, return_counts=True)
            by_edge = places[np.argsort(at, kind="stable")]
            yield own.tolist(), [x.tolist() for x in np.split(by_edge, np.cumsum(n)[:-1])]

    # An edge that fills a text, as a word said over and over does, is one row of it.
    found = map_texts(docs, "edges array<long>, places array<array<int>>", work, keep=("text_hash",))
    each = found.select("text_hash", F.inline(F.arrays_zip(F.col("edges").alias("edge"), F.col("places").alias("places"))))
    repeated = each.groupBy("edge").agg(F.sum(F.size("places")).alias("n")).where("n > 1").select("edge")
    placed = F.transform("edges", lambda e: F.transform(e["places"], lambda p: F.struct(p.alias("place"), e["edge"].alias("edge"))))
    kept = each.join(repeated, "edge").groupBy("text_hash").agg(F.collect_set(F.struct("edge", "places")).alias("edges")).select(
        "text_hash", F.array_sort(F.flatten(placed)).alias("run"))
    kept = materialize(kept, "edges")
    width = window - edge + 1

    pairs = F.zip_with(F.slice("run", F.lit(1), F.size("run") - 1), F.slice("run", F.lit(2), F.size("run")), lambda a, b: F.when(
        b["place"] - a["place"] <= width, F.struct(a["edge"].alias("a"), b["edge"].alias("b"))))
    arcs = kept.where(F.size("run") > 1).select(F.explode(pairs).alias("p")).where("p IS NOT NULL").select("p.*").distinct()
    paths = materialize(compact(arcs), "paths")
    on_path = kept.select("text_hash", F.inline("run")).join(paths, "edge", "left").select(
        "text_hash", F.struct("place", F.coalesce("path", "edge").alias("path")).alias("at"))
    runs = on_path.groupBy("text_hash").agg(F.array_sort(F.collect_list("at")).alias("run"))

    # Neighbours on one path, not further apart than a window reaches, are one stretch.
    def grow(acc, x):
        last = F.get(acc, F.size(acc) - 1)
        joins = (F.size(acc) > 0) & (last["path"] == x["path"]) & (x["place"] - last["last"] <= width)
        longer = F.struct(last["first"].alias("first"), x["place"].alias("last"), x["path"].alias("path"))
        fresh = F.struct(x["place"].alias("first"), x["place"].alias("last"), x["path"].alias("path"))
        return F.when(joins, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(longer))).otherwise(F.concat(acc, F.array(fresh)))

    stretches = F.aggregate("run", F.array().cast("array<struct<first:int,last:int,path:bigint>>"), grow)
    return runs.select("text_hash", F.transform(stretches, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"))).alias("spans"))


def _windows(rows: DataFrame, window: int, edge: int) -> DataFrame:
    """(text_hash, copies, windows, places): hashes and places of the windows that hold an edge of a span."""
    import pyarrow as pa
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("text_hash long, copies long, windows array<long>, places array<int>")
    before = window - edge

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                part = whole.slice(at, 200)
                hashes, places = [], []
                ranges = part.column(3).to_pylist()
                for k, words in hashed_words(part.column(2).to_pylist(), block=50_000):
                    all_ = grams(words, window)
                    marks = np.zeros(len(all_) + 1, np.int32)
                    for s in ranges[k]:
                        marks[max(0, min(s["first"] - before, len(all_)))] += 1
                        marks[min(s["last"] + 1, len(all_))] -= 1
                    chosen = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
                    hashes.append(all_[chosen].view(np.int64))
                    places.append(chosen.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(hashes, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))],
                    names=["text_hash", "copies", "windows", "places"])

    return rows.select("text_hash", "copies", "text", "spans").mapInArrow(run, schema)


def remove_repeated(docs: DataFrame, window: int = WINDOW, edge: int = EDGE, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row, and with ``texts`` the kept words joined by one space, ``kept``.

    Words are runs of characters other than ASCII white space. A word goes if a window of ``window`` words of its text covers it
    whose word sequence also starts at another place of any row. Rows with equal texts are handled once. Missing
    and empty texts have no words; repeated rows are copies of each other; an empty table gives none.
    """
    import pyarrow as pa
    from pyspark.sql.types import StructType

    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    marked = materialize(spans(keyed, window, edge), "spans")
    # One row for each text; copies are joined before they are sent.
    unique = keyed.groupBy("text_hash").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    seen = _windows(unique.join(marked, "text_hash"), window, edge).select(
        "text_hash", "copies", F.inline(F.arrays_zip(F.col("windows").alias("w"), F.col("places").alias("place"))))
    twice = seen.groupBy("w").agg(F.sum("copies").alias("n")).where("n > 1").select("w")
    again = seen.select("w", "text_hash", "place").join(twice, "w").groupBy("text_hash").agg(F.collect_list("place").alias("places"))

    schema = StructType.fromDDL("text_hash long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts)

    def cut(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                part = whole.slice(at, 200)
                out = []
                for text, copies, places in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3)):
                    words = text.encode("utf-8", "surrogatepass").split()
                    n = len(words)
                    if copies > 1 and n >= window:
                        keep = []
                    elif places.is_valid:
                        marks = np.zeros(n + 1, np.int32)
                        starts = places.values.to_numpy()
                        np.add.at(marks, starts, 1)
                        np.add.at(marks, starts + window, -1)
                        keep = [words[k] for k in np.flatnonzero(np.cumsum(marks[:-1]) == 0)]
                    else:
                        keep = words
                    kept = b" ".join(keep)
                    out.append((n, n - len(keep), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass")))
                columns = [part.column(0), *[pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string())[: 3 + texts])]]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    done = unique.join(again, "text_hash", "left").select("text_hash", "text", "copies", "places").mapInArrow(cut, schema)
    return keyed.select("doc_id", "text_hash").join(done, "text_hash").drop("text_hash")
