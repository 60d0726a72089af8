"""Mixing sources to target weights over a time-varying curriculum (native: DataFrame functions only).

Each source has a weight schedule w(t), piecewise linear over training time t in [0, 1]. The schedule's
integral is the source's weight; a token budget is shared by weight, no source getting more than
`cap` times its own size, and what it can't take goes to the others (water filling). A source's documents
stand in a fixed random order; the tokens demanded of it up to time t are target * W(t) / W(1), and the
inverse of that curve at a document's place in the order is the document's training position. Documents are
range-sorted by position.

No text moves for the digest columns and no source is gathered: a source is cut into cells by the leading
bits of a hash of the document's id, cells are summed map-side, and running sums are taken within cells and
over the (bounded) cells of a source.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import null_key, saved, small

#: Weight schedules, (time, weight) knots. Their integrals are 3, 1 and 2.
SCHEDULES = (((0.0, 4.0), (1.0, 2.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.0), (1.0, 3.0)))
SHARE = 1.5
CAP = 2.0
#: Documents of a hash cell, about; cells are a matter of balance and change no result.
CELL_ROWS = 2_000
#: Words of a partition of training rows, about.
PART_WORDS = 2_000_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _areas(knots) -> list[float]:
    """The schedule's integral up to each knot."""
    out = [0.0]
    for (a, x), (b, y) in zip(knots, knots[1:]):
        out.append(out[-1] + (b - a) * (x + y) / 2)
    return out


def check_schedule(knots) -> None:
    times = [t for t, _ in knots]
    if len(knots) < 2 or times != sorted(set(times)) or times[0] != 0 or times[-1] != 1:
        raise ValueError("a schedule needs knots at rising times from 0 to 1")
    if any(w < 0 or not math.isfinite(w) for _, w in knots) or _areas(knots)[-1] <= 0:
        raise ValueError("weights must be finite, at least 0, and not all 0")


def inverse_demand(share: Column, knots) -> Column:
    """The time at which the schedule's integral reaches `share` of its whole: the root of a quadratic in each segment."""
    areas = _areas(knots)
    area, out = share * F.lit(areas[-1]), F.lit(1.0)
    for k in range(len(knots) - 2, -1, -1):
        (a, x), (b, y) = knots[k], knots[k + 1]
        rest, slope = area - F.lit(areas[k]), (y - x) / (b - a)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(x * x) + F.lit(2 * slope) * rest))
        at = F.lit(a) + F.when(rest <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * rest / (F.lit(x) + root))
        out = F.when(area <= F.lit(areas[k + 1]), F.least(at, F.lit(b))).otherwise(out)
    return out


def targets(sources: DataFrame, weights: Sequence[float], share: float = SHARE, cap: float = CAP) -> DataFrame:
    """sources: (source, source_size long), a row each. Adds class (0-based, cycling by code point order, null last),
    weight and target double. The targets' sum is share * all sizes, or cap * all sizes if that is less."""
    order, every = W.orderBy(F.col("source").isNull(), "source"), W.orderBy("_ratio", F.col("source").isNull(), "source")
    before, whole = every.rowsBetween(W.unboundedPreceding, -1), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    k = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    df = sources.withColumn("class", k.cast("int")).withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.col("class") + 1))
    limit = F.lit(float(cap)) * F.col("source_size")
    df = df.withColumn("_ratio", limit / F.col("weight"))
    level = (F.lit(float(min(share, cap))) * F.sum("source_size").over(whole) - F.lit(float(cap)) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    df = df.withColumn("_level", level).withColumn("_full", F.col("_ratio") <= F.col("_level"))
    df = df.withColumn("_water", F.max(F.when(~F.col("_full"), F.col("_level"))).over(whole))
    return df.withColumn("target", F.when(F.col("_full"), limit).otherwise(F.least(limit, F.col("_water") * F.col("weight")))).drop("_ratio", "_level", "_full", "_water")


def mix(
    docs: DataFrame,
    schedules=SCHEDULES,
    share: float = SHARE,
    cap: float = CAP,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    keep: Sequence[str] = ("*",),
) -> DataFrame:
    """One row per row of docs: doc (the row, or its columns named in keep, as a struct), size, source_size, target, taken and passes, an array of
    (pass, words, position): how many words of the document each pass over its source takes, and when.

    Sources take the schedules in turn, by code point, null last. Whole passes take every document in full; the
    last, partial pass takes documents in hash order and cuts the one that it ends in. Null text: size 0. Documents
    without words and sources of size 0 are taken 0 times. Equal ids are allowed; rows that agree in id and size are
    interchangeable. An empty table gives an empty table. Extra columns stay inside doc and can't clash."""
    for s in schedules:
        check_schedule(s)
    sized = docs.select(F.struct(*keep).alias("doc"), *_sized(id_col, source_col, text_col))
    if "*" not in keep:  # narrow rows are written, so words are counted once
        sized = saved(sized, "mix-sized")
    df = _placed(*_in_cells(sized, schedules, share, cap), schedules, ("_hash", "_id", "size"))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda s, x: s + x["words"])
    return df.select("doc", "size", "source_size", "target", taken.alias("taken"), "passes")


def _sized(id_col: str, source_col: str, text_col: str) -> list[Column]:
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return [F.col(source_col).alias("source"), null_key(F.col(source_col)).alias("source_key"), F.col(id_col).alias("_id"), key.alias("_hash"), word_count(F.col(text_col)).alias("size")]


def _cell(bits: int) -> Column:
    return F.shiftright(F.conv(F.substring("_hash", 1, 4), 16, 10).cast("int"), 16 - bits)


def _in_cells(sized: DataFrame, schedules, share: float, cap: float) -> tuple[DataFrame, DataFrame]:
    """sized with each row's cell; and the cells with their source's class, size and target, and the words before them."""
    weights = [_areas(s)[-1] for s in schedules]
    bits = min(16, max(4, math.ceil(math.log2(max(1, sized.select("_hash").count() / CELL_ROWS)))))
    sized = sized.withColumn("cell", _cell(bits))
    cells = saved(sized.groupBy("source_key", "cell").agg(F.first("source").alias("source"), F.sum("size").alias("cell_size")), "mix-cells")
    shares = targets(cells.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("cell_size").alias("source_size")), weights, share, cap)
    running = W.partitionBy("source_key").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.drop("source").join(shares.drop("source"), "source_key").withColumn("cell_before", F.coalesce(F.sum("cell_size").over(running), F.lit(0)))
    return sized, saved(cells.drop("cell_size").withColumn("bits", F.lit(bits)), "mix-shares")


def _placed(sized: DataFrame, cells: DataFrame, schedules, order: Sequence[str]) -> DataFrame:
    """sized with the words before each row (_before), and passes as in mix()."""
    inside = W.partitionBy("source_key", "cell").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    df = sized.join(small(cells), ["source_key", "cell"]).withColumn("_before", F.col("cell_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    passes = F.transform(F.sequence(F.lit(0).cast("long"), _whole_passes()), lambda p: _pass(p, schedules))
    return df.withColumn("passes", F.filter(passes, lambda x: (x["words"] > 0) & (F.col("size") > 0)))


def _whole_passes() -> Column:
    return F.when(F.col("source_size") > 0, F.floor(F.try_divide(F.col("target"), F.col("source_size")))).otherwise(0).cast("long")


def _pass(p: Column, schedules) -> Column:
    """(pass, words, position) of a row in pass p over its source."""
    rest = F.floor(F.col("target") - _whole_passes() * F.col("source_size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before"))).cast("long")
    words = F.when(p < _whole_passes(), F.col("size")).otherwise(part)
    middle = F.least(F.lit(1.0), F.try_divide(p * F.col("source_size") + F.col("_before") + words / 2, F.col("target")))
    at = F.coalesce(*(F.when(F.col("class") == i, inverse_demand(middle, s)) for i, s in enumerate(schedules)))
    return F.struct(p.cast("int").alias("pass"), words.alias("words"), at.alias("position"))


def in_training_order(mixed: DataFrame) -> DataFrame:
    """mix()'s rows range-sorted by their first position; documents that aren't taken stand last, by a hash, so that they
    are dealt out too."""
    first = F.coalesce(F.get("passes", F.lit(0))["position"], F.lit(2.0))
    return mixed.withColumns({"_at": first, "_tie": F.xxhash64("doc", "size")}).orderBy("_at", "_tie").drop("_at", "_tie")


def _demand(t: float, wanted: dict[int, float], schedules) -> float:
    """The words demanded up to time t; wanted: of all sources of a schedule."""
    out = 0.0
    for k, total in wanted.items():
        areas = _areas(schedules[k])
        for (a, x), (b, y), area in zip(schedules[k], schedules[k][1:], areas):
            if t <= b:
                break
        out += total * (area + (t - a) * (x + (x + (y - x) * (t - a) / (b - a))) / 2) / areas[-1]
    return out


def _borders(wanted: dict[int, float], schedules) -> list[float]:
    """Rising times that part the demand into equal parts of some PART_WORDS, by bisection."""
    total, out = sum(wanted.values()), []
    parts = max(1, math.ceil(total / PART_WORDS))
    for i in range(1, parts):
        low, high = out[-1] if out else 0.0, 1.0
        for _ in range(50):
            mid = (low + high) / 2
            low, high = (mid, high) if _demand(mid, wanted, schedules) < total * i / parts else (low, mid)
        out.append(high)
    return out


def trained(docs: DataFrame, schedules=SCHEDULES, share: float = SHARE, cap: float = CAP, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """training_rows(mix(docs)), but a text moves only once, to the place of each of its passes.

    Narrow rows are placed first, and times that part the demand evenly bound the result's partitions. In a cell, a pass reaches
    a partition at some row and leaves it at another: those rows' keys (id's hash, id, size, text's hash) tell where a
    document goes before it is moved. There the words before it are summed up again from the first row on, which gives its
    exact place. Rows equal in id and text stay in one partition."""
    for s in schedules:
        check_schedule(s)
    key = F.struct("_hash", "_id", "size", "_tie")
    rows = docs.select(F.struct("*").alias("doc"), *_sized(id_col, source_col, text_col), F.xxhash64(F.col(text_col)).alias("_tie"))
    sized, cells = _in_cells(saved(rows.drop("doc"), "mix-sized"), schedules, share, cap)
    places = _placed(sized, cells, schedules, ("_hash", "_id", "size", "_tie")).select("source_key", "cell", key.alias("key"), "_before", F.explode("passes").alias("p"))
    sources = cells.groupBy("source_key").agg(F.first("class").alias("class"), F.first("target").alias("target"))
    wanted = {r["class"]: r["target"] for r in sources.groupBy("class").agg(F.sum("target").alias("target")).where("target > 0").collect()}  # a row per schedule
    borders = _borders(wanted, schedules)
    part = F.size(F.filter(F.array(*map(F.lit, borders)), lambda x: x <= F.col("p.position"))) if borders else F.lit(0)
    alike = W.partitionBy("source_key", "cell", "p.pass", "key")
    steps = places.withColumn("part", F.min(part).over(alike)).groupBy("source_key", "cell", F.col("p.pass").alias("pass"), "part").agg(F.min(F.struct("key", "_before")).alias("first"), F.max("key").alias("last"))
    passes = steps.groupBy("source_key", "cell", "pass").agg(F.sort_array(F.collect_list(F.struct("first", "part"))).alias("steps"), F.max("last").alias("last"))
    passes = passes.groupBy("source_key", "cell").agg(F.collect_list(F.struct("pass", "steps", "last")).alias("in_pass"))
    plan = saved(passes.join(cells.drop("cell_before", "weight"), ["source_key", "cell"]), "mix-plan")
    bits = plan.select("bits").first()
    if bits is None:  # nothing is taken
        return docs.limit(0)
    each = rows.where("size > 0").withColumn("cell", _cell(bits[0])).join(small(plan.drop("bits")), ["source_key", "cell"]).withColumn("key", key)
    each = each.withColumn("p", F.explode(F.filter("in_pass", lambda x: x["last"] >= F.col("key"))))
    step = F.element_at(F.filter(F.col("p.steps"), lambda x: x["first"]["key"] <= F.col("key")), -1)
    each = each.select("doc", "source_key", "cell", "key", "size", "source_size", "target", "class", F.col("p.pass").alias("pass"), step.alias("step"))
    each = each.withColumn("part", F.col("step.part")).repartitionById(len(borders) + 1, "part")
    inside = W.partitionBy("part", "source_key", "cell", "pass").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    each = each.withColumn("_before", F.col("step.first._before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    each = each.withColumn("p", _pass(F.col("pass").cast("long"), schedules)).where("p.words > 0")
    return _as_trained(each.sortWithinPartitions("p.position"), text_col, chars_col)


def training_rows(mixed: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents as they are trained on, range-sorted by position: a row per pass with the columns of the
    documents; a document that a pass cuts has the first so many of its words, parted by single spaces."""
    return _as_trained(mixed.select("doc", "size", F.explode("passes").alias("p")).orderBy("p.position"), text_col, chars_col)


def _as_trained(each: DataFrame, text_col: str, chars_col: str) -> DataFrame:
    names = each.schema["doc"].dataType.names
    first = F.array_join(F.slice(F.regexp_extract_all(F.col("doc")[text_col], F.lit(WORD), F.lit(0)), 1, F.col("p.words").cast("int")), " ")
    cut = F.when(F.col("p.words") < F.col("size"), first).otherwise(F.col("doc")[text_col])
    columns = {n: F.col("doc")[n] for n in names} | {text_col: cut}
    if chars_col in names:
        columns[chars_col] = F.when(F.col("p.words") < F.col("size"), F.length(cut).cast(each.schema["doc"].dataType[chars_col].dataType)).otherwise(F.col("doc")[chars_col])
    return each.select(*(c.alias(n) for n, c in columns.items()))
