"""Provider x year x specialty x place statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger import schemas as S
from peerledger.operators.clean import comparable_detail, typed_detail
from peerledger.operators.joins import BROADCAST_ROWS
from peerledger.operators.ranking import BUCKET, GROUP, with_offsets
from peerledger.session import stage, stage_counted, staging

# Claim lines of one provider-year that a single task may hold.
CROWDED_ROWS = 5_000_000
# Different values of one group that a window may sort.
SORTED_VALUES = 100_000
SPLITTERS = 64
SKETCH_ACCURACY = 10_000
EXACT, SKETCH = "exact", "sketch"
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _statistics(source: str, target: str, kind: T.DataType, median: str | None, accuracy: int) -> list[Column]:
    x = F.col(source)
    # A list sorted at the end: the state of a percentile is a map of counted values, which costs more to build and to hand on.
    listed = F.get(F.sort_array(F.collect_list(x)), (F.ceil(F.count(x) / 2) - 1).cast("int"))
    middle = F.percentile_approx(x, 0.5, accuracy) if median == SKETCH else listed
    columns = {
        "min": F.min(x),
        "max": F.max(x),
        "mean": F.avg(x),
        "median": middle.cast(kind),
        "sum": F.sum(x),
        "std": F.coalesce(F.stddev_samp(x), F.lit(0.0)),
    }
    if isinstance(kind, FRACTIONAL):  # decimals are summed exactly before they become doubles
        columns = {s: c.cast("double") for s, c in columns.items()}
    return [columns[s].alias(f"{target}_{s}") for s in S.STATISTICS if median or s != "median"]


def provider_stats(
    detail: DataFrame,
    keys: Sequence[str] = S.GROUP_KEYS,
    measures: Mapping[str, str] = S.MEASURES,
    crowded: bool = False,
    median: str = EXACT,
    accuracy: int = SKETCH_ACCURACY,
    sorted_values: int = SORTED_VALUES,
) -> DataFrame:
    """Six statistics per measure; the median is the lower middle value.

    In one grouped pass, the state of an exact median holds the values of its group. With `crowded` groups of any size are
    fine: those of more than `sorted_values` rows are taken apart, their other statistics have small mergeable states, and their medians
    are found by `medians`; the rest is grouped in one pass. `detail` is then read several times. With median="sketch" all states are
    small and one pass does it: the median is a value whose rank is off by at most rows / accuracy, so exact in groups of up to
    `accuracy` values.
    """
    if median not in (EXACT, SKETCH):
        raise ValueError(f"unknown median {median!r}")
    kinds = {f.name: f.dataType for f in detail.schema.fields}

    def grouped(part: DataFrame, median: str | None) -> DataFrame:
        columns = [c for src, dst in measures.items() for c in _statistics(src, dst, kinds[src], median, accuracy)]
        return part.groupBy(*keys).agg(*columns)

    if not crowded or median == SKETCH:
        return grouped(detail, median)
    large, found = crowded_keys(detail, keys, sorted_values)
    if found == 0:
        return grouped(detail.repartition(*keys), EXACT)
    busy, quiet = _parted(detail, keys, large, found)
    apart = grouped(busy, None).withColumn(GROUP, F.struct(*keys)).join(medians(busy, keys, measures, sorted_values), GROUP)
    apart = apart.select(*keys, *[f"{dst}_{s}" for dst in measures.values() for s in S.STATISTICS])
    return apart.unionByName(grouped(quiet.repartition(*keys), EXACT))


def medians(detail: DataFrame, keys: Sequence[str], measures: Mapping[str, str], sorted_values: int = SORTED_VALUES) -> DataFrame:
    """(group, <measure>_median...): the exact lower middle value of each measure in its own type, whatever a group holds."""
    types = {f.name: f.dataType for f in detail.schema.fields}
    groups = detail.select(F.struct(*keys).alias(GROUP)).distinct()  # groups without any value have no median
    for kind in dict.fromkeys(types[src] for src in measures):
        own = {src: dst for src, dst in measures.items() if types[src] == kind}
        values = F.array(*[F.struct(F.lit(dst).alias("measure"), F.col(src).alias("value")) for src, dst in own.items()])
        tall = detail.select(F.struct(*keys).alias("at"), F.explode(values).alias("v")).select("at", "v.*").filter("value is not null")
        counted = tall.groupBy("at", "measure", "value").agg(F.count("*").alias("n"))
        middle = middle_values(counted.select(F.struct("at", "measure").alias(GROUP), "value", "n"), sorted_values)
        shown = "double" if isinstance(kind, FRACTIONAL) else kind
        columns = [F.max(F.when(F.col(f"{GROUP}.measure") == dst, F.col("value"))).cast(shown).alias(f"{dst}_median") for dst in own.values()]
        groups = groups.join(middle.groupBy(F.col(f"{GROUP}.at").alias(GROUP)).agg(*columns), GROUP, "left")
    return groups.select(GROUP, *[f"{dst}_median" for dst in measures.values()])


def middle_values(counted: DataFrame, sorted_values: int = SORTED_VALUES) -> DataFrame:
    """(group, value): the lower middle of each group's values, from different values and their counts (group, value, n).

    A group of more than `sorted_values` is narrowed first. Splitters, values of the group itself chosen by hash, cut it into buckets
    of about equally many values, however they are distributed; running counts over the buckets tell which one has the middle, and
    only its values stay for the next round. Rounds divide a group by about SPLITTERS; the last one sorts what is left.
    """
    done = []
    with staging(counted.sparkSession) as scope:
        left = stage(counted, "value-counts")
        sizes = left.groupBy(GROUP).agg(F.count("*").alias("values"), F.ceil(F.sum("n") / 2).alias("rank"))
        ranks, turn = stage(sizes, "middle-ranks"), 0
        while True:
            scope.keep(left, ranks)  # the results of a round read them
            large = ranks.filter(F.col("values") > sorted_values)
            small = left.join(ranks.filter(F.col("values") <= sorted_values), GROUP)
            inside = Window.partitionBy(GROUP).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            upto = small.withColumn("upto", F.sum("n").over(inside))
            done.append(upto.filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))).select(GROUP, "value"))
            if large.isEmpty():
                return reduce(DataFrame.union, done)
            placed = _bucketed(left.join(large, GROUP), turn)
            offsets = with_offsets(placed, {"before": F.sum("n")})
            firsts = [F.first(c).alias(c) for c in ("before", "rank")]
            total = offsets.groupBy(GROUP, BUCKET).agg(*firsts, F.sum("n").alias("own"), F.count("*").alias("values"))
            holds = total.filter((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("own")))
            chosen = stage(holds.select(GROUP, BUCKET, (F.col("rank") - F.col("before")).alias("rank"), "values"), "middle-buckets")
            stays = placed.select(GROUP, BUCKET, "value", "n").join(chosen.select(GROUP, BUCKET), [GROUP, BUCKET])
            left = stage(stays.select(GROUP, "value", "n"), "value-counts")
            ranks, turn = stage(chosen.select(GROUP, "values", "rank"), "middle-ranks"), turn + 1


def _bucketed(values: DataFrame, turn: int) -> DataFrame:
    """(group, value, n, values, rank, bucket), staged. Buckets are monotone in the value. About two SPLITTERS of each group are collected."""
    odds = F.ceil(F.col("values") / (2 * SPLITTERS))
    drawn = values.filter(F.pmod(F.xxhash64("value", F.lit(turn)), odds) == 0)
    splitters = drawn.groupBy(GROUP).agg(F.array_sort(F.collect_list("value")).alias("splitters"))
    every = F.greatest(F.lit(1), F.floor(F.size("splitters") / SPLITTERS)).cast("int")
    spaced = F.filter("splitters", lambda _, i: i % every == 0)
    cuts = stage(splitters.select(GROUP, spaced.alias("splitters")), "value-splitters")
    below = F.size(F.filter("splitters", lambda cut: cut <= F.col("value")))
    joined = values.join(cuts, GROUP, "left").withColumn(BUCKET, F.coalesce(below, F.lit(0)))
    return stage(joined.select(GROUP, "value", "n", "values", "rank", BUCKET), "bucketed-values")


def crowded_keys(df: DataFrame, keys: Sequence[str], limit: int) -> tuple[DataFrame, int]:
    """Key values with more than `limit` rows, and how many there are (at most rows / limit)."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    return stage_counted(counts.filter(F.col("_rows") > limit).select(*keys), "crowded-keys")


def _parted(df: DataFrame, keys: Sequence[str], chosen: DataFrame, found: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is one of the `found` chosen ones, the other rows). NULL keys equal each other."""
    names = [f"_c{i}" for i in range(len(keys))]
    chosen = chosen.toDF(*names)
    if found <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    same = reduce(Column.__and__, [df[k].eqNullSafe(chosen[n]) for k, n in zip(keys, names)])
    return df.join(chosen, same, "left_semi"), df.join(chosen, same, "left_anti")


def claim_statistics(
    detail: DataFrame,
    money_type: str = "float",
    distinct: bool = True,
    layout: str = "auto",
    crowded_rows: int = CROWDED_ROWS,
    median: str = EXACT,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Raw claim lines to provider statistics, with the cheapest layout that skew allows. The layout changes no value but the last
    digits of means and deviations.

    layout="colocate" moves each line once, to its provider-year; removing copies and all thirty
    statistics then need no further exchange. layout="spread" lets Spark combine map-side before
    each exchange: safe whatever one provider or one line holds, but it stages the distinct lines
    and reads them again for the large groups. layout="auto" counts lines per provider-year first, reading two
    columns, and takes "spread" only for the provider-years above `crowded_rows`, if there are any. With median="sketch" the spread
    lines get sketches, and "auto" spreads the provider-years of more than `accuracy` lines: a state of sketches is dearer to move than
    the few lines of a smaller one, whose median is then exact.
    """
    lines = comparable_detail(detail, money_type)
    keys = ["_npi", "_year"]

    def typed(part: DataFrame) -> DataFrame:
        return typed_detail(part.dropDuplicates() if distinct else part)

    def spread(part: DataFrame) -> DataFrame:
        if median == SKETCH:
            return provider_stats(typed(part), median=SKETCH, accuracy=accuracy)
        return provider_stats(stage(typed(part), "typed-lines"), crowded=True)

    def colocate(part: DataFrame) -> DataFrame:
        return provider_stats(typed(part.repartition(*keys)))

    if median not in (EXACT, SKETCH):
        raise ValueError(f"unknown median {median!r}")
    if median == SKETCH:  # smaller provider-years are too few lines to sketch
        crowded_rows = min(crowded_rows, accuracy)
    if layout == "spread":
        return spread(lines)
    if layout == "colocate":
        return colocate(lines)
    if layout != "auto":
        raise ValueError(f"unknown layout {layout!r}")
    crowded, found = crowded_keys(lines, keys, crowded_rows)
    if found == 0:
        return colocate(lines)
    if found > BROADCAST_ROWS:
        return spread(lines)
    busy, quiet = _parted(lines, keys, crowded, found)
    return colocate(quiet).unionByName(spread(busy))
