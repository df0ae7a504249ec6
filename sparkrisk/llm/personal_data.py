"""Personal data: exact base detectors, and candidate spans that boosted trees accept or refuse.

Strict patterns with checks give the base spans. Generators of high recall propose tighter or looser spans, also
inside what a strict pattern has swallowed and dropped, or written out in words. Boosted trees learn from the
candidates that the base can judge what format and context say about them; a kind's threshold parts the scores
that are precise enough, hundredth by hundredth, on candidates that they have not learned from, from those that
are not. Accepted are only candidates that the base cannot judge and that overlap no base span.

Positions are running sums in blocks of about the root of the number of matches, and overlaps are looked up in
masks with a byte for each character. A look-up may copy its mask, so single texts of megabytes still take more than linear time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import let, text_of
from sparkrisk.operators.explain import leaf_paths
from sparkrisk.session import materialize

KINDS = ("email", "ip", "card", "phone")
# Each pattern finds what its plain form (right) finds; the look-behind and the possessive repeats keep the time linear.
STRICT = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9-]++"
              r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++"),
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{16}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])",
    "phone": r"(?<![0-9+])\+?(?:[0-9]{1,3}[\x20.-]?)?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
_GATE = {"email": "@|[\\[(]at[\\])]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_HINTS = {"email": "mail|contact|write", "ip": "ip|host|server|addr", "card": "card|visa|credit|pay", "phone": "phone|tel|call|fax"}
#: Candidates that the trees learn from at most, those with the smallest digest.
TRAINING_CANDIDATES = 20_000
PRECISION = 0.98
#: E-mail addresses with words for their signs, which the base neither finds nor refuses.
_WRITTEN_OUT = r"[\[(](?:at|dot)[\])]"
_SPAN = "array<struct<start:int,end:int,from:int,to:int,s:string,before:string,after:string>>"
_ADDED = "array<struct<kind:string,start:int,end:int,from:int,to:int>>"


def _scan(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each of the numbers what those before it combine to, 0 for the first."""
    zero, none = F.lit(0), F.array().cast("array<int>")

    def before(part: Column) -> Column:
        def step(acc, x):
            return F.struct(combine(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(part, F.struct(zero.alias("at"), none.alias("out")), step)["out"]

    def of(v: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(v))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / size).cast("int")), lambda k: F.slice(v, k * size + 1, size))
        return let(blocks, lambda parts: let(before(F.transform(parts, lambda part: F.aggregate(part, zero, combine))), lambda starts: F.flatten(
            F.transform(parts, lambda part, k: F.transform(before(part), lambda x: combine(F.get(starts, k), x))))))

    return let(values, lambda v: F.when(F.size(v) == 0, none).otherwise(of(v)))


def _located(text: Column, pattern: str, gate: str) -> Column:
    """Matches with their offsets in code points and (from, to) in bytes, the 24 characters before and the one after."""

    def place(found: Column, between: Column) -> Column:
        def starts(measure: Callable[[Column], Column]) -> Column:
            return _scan(F.transform(found, lambda s, i: measure(F.get(between, i)) + measure(s)), lambda a, b: a + b)

        def span(points: Column, octets: Column) -> Column:
            def one(s, i):
                start, first = F.get(points, i) + F.length(F.get(between, i)), F.get(octets, i) + F.octet_length(F.get(between, i))
                return F.struct(
                    start.alias("start"), (start + F.length(s)).alias("end"), first.alias("from"), (first + F.octet_length(s)).alias("to"),
                    s.alias("s"), F.right(F.get(between, i), F.lit(24)).alias("before"), F.left(F.get(between, i + 1), F.lit(1)).alias("after"))
            return F.transform(found, one)

        return let(starts(F.length), lambda points: let(starts(F.octet_length), lambda octets: span(points, octets)))

    none = F.array().cast(_SPAN)
    some = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) == 0, none).otherwise(
        let(F.split(text, pattern, -1), lambda between: place(found, between)).cast(_SPAN)))
    return F.when(F.regexp_like(text, F.lit(gate)), some).otherwise(none)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    def check(digits: Column) -> Column:
        n = F.length(digits)

        def add(acc, i):
            d = F.substring(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
            return acc + F.when(d > 9, d - 9).otherwise(d)

        return (n > 0) & (F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add) % 10 == 0)

    return let(_digits(s), check)


def _valid(kind: str, s: Column) -> Column:
    n = F.length(_digits(s))
    if kind == "email":
        return F.regexp_like(s, F.lit(r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$"))
    if kind == "ip":
        return F.regexp_like(s, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))
    if kind == "card":
        return n.between(16, 19) & _luhn(s)
    return n.between(8, 15)


def _span(kind: Column, x: Column) -> Column:
    return F.struct(kind.alias("kind"), *[x[c].alias(c) for c in ("start", "end", "from", "to")])


def _base(located: dict[str, Column]) -> Column:
    """Base spans as array of (kind, start, end, from, to), by kind in the order of ``KINDS``, then start."""

    def of(kind: str) -> Column:
        valid = F.filter(located[kind], lambda x: _valid(kind, x["s"]))
        return F.transform(valid, lambda x: _span(F.lit(kind), x))

    return F.concat(*[of(kind) for kind in KINDS])


def _masks(spans: Column) -> Column:
    """For each kind a byte for each character up to its last span: S where a span starts, 1 inside, 0 elsewhere."""

    def mask(own: Column) -> Column:
        def piece(s, i):
            gap = s["start"] - F.coalesce(F.get(own, i - 1)["end"], F.lit(0))
            return F.concat(F.repeat(F.lit("0"), gap), F.lit("S"), F.repeat(F.lit("1"), s["end"] - s["start"] - 1))
        return F.array_join(F.transform(own, piece), "").cast("binary")

    return F.array(*[let(_of_kind(spans, kind), mask) for kind in KINDS])


def _under(mask: Column, x: Column) -> Column:
    return F.substring(mask, x["start"] + 1, x["end"] - x["start"]).cast("string")


def _overlaps(masks: Column, x: Column) -> Column:
    return F.exists(masks, lambda mask: F.regexp_like(_under(mask, x), F.lit("[S1]")))


def _candidates(located: dict[str, Column], masks: Column) -> Column:
    """Proposed spans as array of (kind, start, end, from, to, y, f): y is 1 if the base has the span, 0 if its checks fail,
    missing if the base cannot judge it; f holds features of format and context."""

    def features(kind: str, x: Column) -> Column:
        s = x["s"]
        flags = [
            *[F.lit(kind == k) for k in KINDS], _luhn(s),
            F.regexp_like(x["before"], F.lit("[0-9A-Za-z]$")), F.regexp_like(x["after"], F.lit("[0-9A-Za-z]")),
            F.regexp_like(s, F.lit("[ ]")), F.regexp_like(s, F.lit("[(]")),
            *[F.regexp_like(F.lower(x["before"]), F.lit(_HINTS[k])) for k in KINDS],
        ]
        sizes = [F.length(s), F.length(_digits(s)), F.regexp_count(s, F.lit("[0-9]+")), F.regexp_count(s, F.lit("[. -]"))]
        return F.array(*[c.cast("double") for c in (*flags, *sizes)])

    def proposed(kind: str) -> Column:
        def judged(x):
            under = _under(F.get(masks, F.lit(KINDS.index(kind))), x)
            known = (F.length(under) == x["end"] - x["start"]) & F.regexp_like(under, F.lit("^[S1]1*$"))
            wrong = ~_valid(kind, x["s"])
            if kind == "email":
                wrong = wrong & ~F.regexp_like(x["s"], F.lit(_WRITTEN_OUT))
            return F.struct(
                *[c.alias(n) for n, c in {"kind": F.lit(kind), **{c: x[c] for c in ("start", "end", "from", "to")}}.items()],
                F.when(known, 1).when(wrong, 0).alias("y"), features(kind, x).alias("f"))

        return F.transform(located[kind], judged)

    return F.concat(*[proposed(kind) for kind in KINDS])


def searched(df: DataFrame, text: Column, output: str) -> DataFrame:
    """Adds ``output``, a struct of the base spans and the proposed ones. Steps are columns, as very deep expressions resolve slowly."""
    steps = [f"{output}_{k}" for k in ("strict", "loose", "base", "masks")]
    strict, loose, base, masks = steps
    found = df.withColumns({name: F.struct(*[_located(text, patterns[k], _GATE[k]).alias(k) for k in KINDS])
                            for name, patterns in ((strict, STRICT), (loose, LOOSE))})
    found = found.withColumn(base, _base({k: F.col(strict)[k] for k in KINDS}))
    found = found.withColumn(masks, _masks(F.col(base)))
    both = F.struct(F.col(base).alias("base"), _candidates({k: F.col(loose)[k] for k in KINDS}, F.col(masks)).alias("proposed"))
    return found.withColumn(output, both).drop(*steps)


@dataclass(frozen=True)
class Model:
    """Leaves of the trees and the threshold of each kind; without leaves nothing is added."""

    leaves: tuple
    thresholds: dict[str, float]

    def score(self, f: Column) -> Column:
        margin = F.lit(0.0)
        for leaf in self.leaves:
            on = F.lit(True)
            for feature, limit, left, _ in leaf["path"]:
                on = on & ((f[feature] <= limit) if left else (f[feature] > limit))
            margin = margin + F.when(on, F.lit(leaf["value"])).otherwise(0.0)
        return 1 / (1 + F.exp(-2 * margin))


def fit(found: DataFrame, most: int = TRAINING_CANDIDATES, precision: float = PRECISION) -> Model:
    """Learns from a table with a column ``proposed`` as ``candidates`` makes it; equal candidates teach once."""
    each = found.select(F.explode("proposed").alias("c")).select("c.kind", "c.y", "c.f", F.xxhash64("c.f", "c.start", "c.end").alias("turn")).where("y IS NOT NULL")
    learned = each.where(F.col("turn") % 2 == 0).distinct().orderBy("turn", "y").limit(most)
    data = materialize(learned.select(F.col("y").cast("double").alias("label"), array_to_vector("f").alias("features")), "learned")
    if data.agg(F.countDistinct("label")).first()[0] < 2:
        return Model((), {})
    trees = GBTClassifier(maxDepth=3, maxIter=8, stepSize=0.3, seed=11, cacheNodeIds=False).fit(data.repartition(1))
    model = Model(tuple(leaf_paths(trees)), {})
    others = each.where(F.col("turn") % 2 != 0).groupBy("kind", F.floor(model.score(F.col("f")) * 100).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("right"))
    return Model(model.leaves, calibrated({(r["kind"], r["bin"]): (r["n"], r["right"]) for r in others.collect()}, precision))  # at most 101 for each kind


def calibrated(bins: dict[tuple[str, int], tuple[int, int]], precision: float) -> dict[str, float]:
    """Thresholds from (candidates, right ones) of each kind and hundredth of the score.

    A kind's precise bins are those above its highest imprecise one; without any it has no threshold. Scores between
    the lowest precise and the highest imprecise bin are split in the middle; without an imprecise one, 0 takes its place.
    """
    thresholds = {}
    for kind in KINDS:
        own = {b: right >= precision * n for (k, b), (n, right) in bins.items() if k == kind}
        bad = max((b for b, precise in own.items() if not precise), default=-1)
        good = [b for b in own if b > bad]
        if good:
            thresholds[kind] = (min(good) + bad + 1) / 200
    return thresholds


def _accepted(base_masks: Column, proposed: Column, model: Model) -> Column:
    """Candidates that the base cannot judge, above their kind's threshold and clear of all base spans; of two that
    overlap the one whose kind comes first."""
    if not model.leaves or not model.thresholds:
        return F.array().cast(_ADDED)

    def good(c: Column, masks: Column) -> Column:
        limit = F.lit(2.0)
        for kind, least in model.thresholds.items():
            limit = F.when(c["kind"] == kind, F.lit(least)).otherwise(limit)
        return c["y"].isNull() & ~_overlaps(masks, c) & (model.score(c["f"]) >= limit)

    def kept(chosen: Column) -> Column:
        order = F.array(*[F.lit(kind) for kind in KINDS])
        return let(_masks(chosen), lambda masks: F.filter(chosen, lambda c: ~_overlaps(
            F.slice(masks, F.lit(1), F.array_position(order, c["kind"]).cast("int") - 1), c)))

    open_ = let(base_masks, lambda masks: F.filter(proposed, lambda c: good(c, masks)))
    return let(F.transform(open_, lambda c: _span(c["kind"], c)).cast(_ADDED), kept)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _in_order(spans: Column) -> Column:
    return F.concat(*[F.array_sort(_of_kind(spans, kind)) for kind in KINDS])


def _free(df: DataFrame, name: str) -> str:
    """The name, longer if a column begins with it."""
    while any(c.lower().startswith(name) for c in df.columns):
        name += "_"
    return name


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row.

    The counts and the digest are those of the base. Missing texts are empty ones without spans; repeated rows are
    searched each; without candidates of both classes nothing is added; an empty table gives none.
    """
    found = materialize(searched(docs.select("doc_id", "text"), text_of(), "x").select("doc_id", "x.*"), "spans")
    model = fit(found)
    found = found.withColumn("masks", _masks(F.col("base")))
    spans = F.concat("base", _accepted(F.col("masks"), F.col("proposed"), model))
    counts = [F.size(_of_kind(F.col("base"), kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(_in_order(spans)).alias("spans"))


def redact(docs: DataFrame, column: str = "text") -> DataFrame:
    """The rows with every span of the text replaced by its kind in brackets; missing texts stay missing.

    Other columns are unchanged, but for ``n_chars``, which follows the text where there is one. Each text is searched
    once: rows and spans are written together. Repeated rows stay repeated; an empty table gives none.
    """
    name = _free(docs, "__found")
    here = F.col(f"`{column}`")
    found = searched(docs, F.coalesce(here, F.lit("")), name)
    found = materialize(found, "spans")
    model = fit(found.select(F.col(name)["proposed"].alias("proposed")))

    def cut(text: Column, spans: Column) -> Column:
        def pieces(octets: Column, ordered: Column, reached: Column) -> Column:
            def one(s, i):
                at = F.get(reached, i)
                between = F.substring(octets, at + 1, s["from"] - at).cast("string")
                return F.when(s["from"] >= at, F.concat(between, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(F.lit(""))
            rest = F.substring(octets, F.array_max(F.transform(ordered, lambda s: s["to"])) + 1, F.length(octets)).cast("string")
            return F.concat(F.array_join(F.transform(ordered, one), ""), rest)

        by_start = F.array_sort(F.transform(spans, lambda s: F.struct(*[s[c].alias(c) for c in ("from", "to", "kind")])))
        return let(by_start, lambda ordered: let(_scan(F.transform(ordered, lambda s: s["to"]), lambda a, b: F.greatest(a, b)), lambda reached: let(
            text.cast("binary"), lambda octets: pieces(octets, ordered, reached))))

    masks, spans = f"{name}_masks", f"{name}_spans"
    changed = found.withColumn(masks, _masks(F.col(name)["base"]))
    changed = changed.withColumn(spans, F.concat(F.col(name)["base"], _accepted(F.col(masks), F.col(name)["proposed"], model)))
    changed = changed.withColumn(column, F.when(F.size(spans) == 0, here).otherwise(cut(here, F.col(spans)))).drop(name, masks, spans)
    return changed.withColumn("n_chars", F.length(here).cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else changed
