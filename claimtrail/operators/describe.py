"""Descriptive statistics by group, as long tables: varname, group, varlvl, stat, value.

Every variable is handled in one pass over the unpivoted table. A variable is named by its column label if it has one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from claimtrail.operators.reshape import outer_union, with_pseudo_group
from claimtrail.sources.scratch import settle
from claimtrail.sources.tables import classify_variables

OVERALL = "Overall"
PER_OCTAVE = 2_048  # cells per doubling of the magnitude, first step of the quantile search
FINE_CELLS = 65_535  # equal cells one of those is cut into, second step
MAX_LEVEL_BYTES = 8 << 20  # of a crosstab's levels, that every task may hold
LEVEL_OVERHEAD = 32
LEVELS_PER_TILE = 10_000
LONG = ("varname", "group", "varlvl", "stat", "value")


def label_of(df: DataFrame, column: str) -> str:
    return df.schema[column].metadata.get("label", column)


def _value(df: DataFrame, column: str) -> Column:
    """The column as statistics read it: a date as days from 1970-01-01, a boolean as 1 or 0."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    return F.col(column).cast("int") if isinstance(kind, T.BooleanType) else F.col(column)


def _unpivoted(df: DataFrame, columns: Sequence[str], group_col: str, kind: str) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(label_of(df, c)).alias("varname"), _value(df, c).cast(kind).alias("v")) for c in columns])
    return df.select(F.col(group_col).alias("group"), F.inline(rows))


def _stats_long(df: DataFrame, varlvl: Column, stats: dict[str, Column]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(n).alias("stat"), v.cast("double").alias("value")) for n, v in stats.items()])
    return df.select("varname", "group", varlvl.alias("varlvl"), F.inline(rows))


def _cell_of(value: Column) -> Column:
    """Order-preserving cell of a number: its sign and its magnitude to about one part in 3,000."""
    size = F.floor((F.log2(F.abs(value)) + 1100) * PER_OCTAVE)
    return F.when(value == 0, F.lit(0).cast("long")).otherwise((F.signum(value) * size).cast("long"))


def _holding(wanted: Column, upto: Column, held: Column) -> Column:
    """The wanted ranks that fall in a cell of ``held`` values ending at rank ``upto``, counted from the cell's start."""
    before = upto - held
    inside = F.filter(wanted, lambda w: (w["rank"] > before) & (w["rank"] <= upto))
    return F.transform(inside, lambda w: F.struct(w["stat"].alias("stat"), (w["rank"] - before).alias("rank")))


def quantiles(long: DataFrame, fractions: dict[str, float], keys: Sequence[str] = ("group", "varname")) -> DataFrame:
    """Exact quantiles of ``v`` per key by averaging at a step: with n·p = j + g, the mean of the j-th and next value
    when g is 0, else the next value. One column per fraction.

    Values are counted first; a histogram of magnitudes then finds the cells that hold the wanted ranks, and only their
    values are cut finer and ordered. No task orders a whole group: each holds the cells of a group or the distinct
    values of one fine cell.
    """
    keys = list(keys)
    present = long.where(F.col("v").isNotNull() & ~F.isnan("v"))
    counts = present.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n")).withColumn("_c1", _cell_of(F.col("v")))

    group = Window.partitionBy(*keys)
    coarse = (
        counts.groupBy(*keys, "_c1")
        .agg(F.sum("n").alias("_in"), F.min("v").alias("_lo"), F.max("v").alias("_hi"))
        .withColumn("_size", F.sum("_in").over(group))
        .withColumn("_upto", F.sum("_in").over(group.orderBy("_c1").rowsBetween(Window.unboundedPreceding, 0)))
    )
    ranks = []
    for name, p in fractions.items():
        place = F.col("_size") * p
        for rank in (F.ceil(place), F.floor(place) + 1):
            ranks.append(F.struct(F.lit(name).alias("stat"), rank.alias("rank")))
    cells = coarse.select(
        *keys, "_c1", "_lo", "_hi", _holding(F.array(*ranks), F.col("_upto"), F.col("_in")).alias("wanted")
    ).where(F.size("wanted") > 0)

    share = F.try_divide(F.col("v") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    kept = counts.join(cells, [*keys, "_c1"]).withColumn(
        "_c2", F.coalesce(F.floor(share * FINE_CELLS), F.lit(0)).cast("long")
    )
    within = Window.partitionBy(*keys, "_c1").orderBy("_c2").rowsBetween(Window.unboundedPreceding, 0)
    fine = (
        kept.groupBy(*keys, "_c1", "_c2")
        .agg(F.sum("n").alias("_in"), F.first("wanted").alias("wanted"))
        .withColumn("_upto", F.sum("_in").over(within))
        .select(*keys, "_c1", "_c2", _holding(F.col("wanted"), F.col("_upto"), F.col("_in")).alias("wanted"))
        .where(F.size("wanted") > 0)
    )
    finest = [*keys, "_c1", "_c2"]
    in_cell = Window.partitionBy(*finest).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        kept.drop("wanted").join(fine, finest)
        .withColumn("_upto", F.sum("n").over(in_cell))
        .select(*keys, "v", F.explode(_holding(F.col("wanted"), F.col("_upto"), F.col("n"))).alias("hit"))
    )
    per_stat = [F.avg(F.when(F.col("hit.stat") == name, F.col("v"))).alias(name) for name in fractions]
    return placed.groupBy(*keys).agg(*per_stat)


def desc_stat_n(df: DataFrame, columns: Sequence[str], group_col: str = "group") -> DataFrame:
    """Mean, median, standard deviation and quartiles of continuous variables by group.

    Rows without a group are left out; NaN counts as missing.
    """
    long = _unpivoted(df.where(F.col(group_col).isNotNull()), columns, group_col, "double")
    long = long.withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    moments = long.groupBy("group", "varname").agg(F.avg("v").alias("Mean"), F.stddev_samp("v").alias("Std"))
    points = quantiles(long, {"Q1": 0.25, "Median": 0.5, "Q3": 0.75})
    joined = moments.join(points, ["group", "varname"], "left")
    stats = {name: F.col(name) for name in ("Mean", "Median", "Std", "Q1", "Q3")}
    return _stats_long(joined, F.lit(OVERALL), stats).select(*LONG)


def desc_stat_c(df: DataFrame, columns: Sequence[str], group_col: str = "group", pseudo_group: str | None = None) -> DataFrame:
    """Count and row percent of each level of categorical variables by group, and counts overall.

    Every group has every level of a variable, if with count 0. Blank levels and rows without a group are left out, also of the
    percent's base. Overall rows have no percent and leave out the rows of ``pseudo_group``, which repeat the others.
    """
    grouped = df.where(F.col(group_col).isNotNull())
    long = _unpivoted(grouped, columns, group_col, "string").where(F.trim("v") != "")
    cells = long.groupBy("varname", "group", "v").agg(F.count(F.lit(1)).alias("N"))
    bases = cells.groupBy("varname", "group").agg(F.sum("N").alias("_base"))
    grid = bases.join(cells.select("varname", "v").distinct(), "varname")  # groups by levels of one variable
    by_group = grid.join(cells, ["varname", "group", "v"], "left").withColumn("N", F.coalesce("N", F.lit(0)))
    by_group = by_group.select("varname", "group", "v", "N", (F.col("N") * 100 / F.col("_base")).alias("Perc"))
    own = cells if pseudo_group is None else cells.where(F.col("group") != pseudo_group)
    overall = own.groupBy("varname", "v").agg(F.sum("N").alias("N")).select(
        "varname", F.lit(OVERALL).alias("group"), "v", "N", F.lit(None).cast("double").alias("Perc")
    )
    return _stats_long(
        by_group.unionByName(overall), F.col("v"), {"N": F.col("N"), "Perc": F.col("Perc")}
    ).select(*LONG)


def desc_stat_d(df: DataFrame, columns: Sequence[str], group_col: str = "group", pseudo_group: str | None = None) -> DataFrame:
    """Count of ``'1'`` and its share of all rows (a fraction) for dichotomous variables, overall and by group.

    Rows without a group count overall only. Overall leaves out the rows of ``pseudo_group``, which repeat the others.
    """
    long = _unpivoted(df, columns, group_col, "string")
    by_group = long.groupBy("varname", "group").agg(
        F.count_if(F.col("v") == "1").alias("N"), F.count(F.lit(1)).alias("_rows")
    )
    own = by_group if pseudo_group is None else by_group.where(~F.col("group").eqNullSafe(F.lit(pseudo_group)))
    overall = own.groupBy("varname").agg(F.sum("N").alias("N"), F.sum("_rows").alias("_rows"))
    both = by_group.where(F.col("group").isNotNull()).unionByName(overall.withColumn("group", F.lit(OVERALL)))
    return _stats_long(both, F.lit(OVERALL), {"N": F.col("N"), "Perc": F.col("N") / F.col("_rows")}).select(*LONG)


def summary_rollup(df: DataFrame, column: str, group_col: str = "group") -> DataFrame:
    """N, MIN, MAX, MEAN and STD per group and over all grouped rows, in long form."""
    rows = df.where(F.col(group_col).isNotNull()).select(F.col(group_col).alias("group"), F.col(column).alias("v"))
    grouped = rows.rollup("group").agg(
        F.count("v").alias("N"), F.min("v").alias("MIN"), F.max("v").alias("MAX"),
        F.avg("v").alias("MEAN"), F.stddev_samp("v").alias("STD"), F.grouping("group").alias("_all"),
    )
    named = grouped.withColumn("group", F.when(F.col("_all") == 1, OVERALL).otherwise(F.col("group")))
    stats = {name: F.col(name) for name in ("N", "MIN", "MAX", "MEAN", "STD")}
    labelled = named.withColumn("varname", F.lit(label_of(df, column)))
    return _stats_long(labelled, F.lit(OVERALL), stats).select(*LONG)


def freq_sparse(df: DataFrame, group_col: str, level_col: str, max_bytes: int = MAX_LEVEL_BYTES, per_tile: int = LEVELS_PER_TILE) -> DataFrame:
    """Crosstab counts in long form, including the combinations that do not occur. Blank levels are left out.

    Rows are counted once. Levels of up to ``max_bytes`` are one array, which every task of groups unfolds; more of them are dealt over
    tiles by their hash and each group goes to every tile. The counts are then looked up by group and level. A missing group is a group.
    """
    kind = df.schema[level_col].dataType
    counts = df.select(F.col(group_col).alias("_g"), F.col(level_col).alias("_l")).groupBy("_g", "_l").agg(F.count(F.lit(1)).alias("_n"))
    counts = settle(counts, "crosstab")
    levels = settle(counts.where(F.trim(F.col("_l").cast("string")) != "").select("_l").distinct(), "levels")
    groups = counts.select("_g").distinct()
    size = F.sum(F.octet_length(F.col("_l").cast("string")) + LEVEL_OVERHEAD)
    n_levels, taken = levels.agg(F.count("_l"), F.coalesce(size, F.lit(0))).first()
    if taken <= max_bytes:
        grid = groups.select("_g", F.explode(levels.agg(F.collect_list("_l").alias("_ls")).scalar()).alias("_l"))
    else:
        tiles = -(-n_levels // per_tile) + 1
        dealt = levels.withColumn("_tile", F.pmod(F.xxhash64("_l"), F.lit(tiles)))
        spread = groups.withColumn("_tile", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tiles - 1).cast("bigint"))))
        grid = spread.join(dealt, "_tile").drop("_tile")
    held = counts.select(F.col("_g").alias("_g2"), F.col("_l").alias("_l2"), "_n")
    found = grid.join(held, F.col("_g").eqNullSafe(F.col("_g2")) & (F.col("_l") == F.col("_l2")), "left")
    return found.select(F.col("_g").alias(group_col), F.col("_l").cast(kind).alias(level_col), F.coalesce("_n", F.lit(0)).cast("long").alias("count"))


def descriptive_stats(
    variables: DataFrame,
    categorical: Sequence[str],
    exclude: Sequence[str],
    group_col: str = "group",
    pseudo_group: str | None = None,
) -> DataFrame:
    """Statistics of all variables by group, each by its kind; ``pseudo_group`` adds a group of all rows.

    "Overall" is taken from the rows in their own groups only.
    """
    table = with_pseudo_group(variables, group_col, pseudo_group) if pseudo_group else variables
    kinds = classify_variables(table, categorical, [*exclude, group_col])
    parts = []
    if kinds["continuous"]:
        parts.append(desc_stat_n(table, kinds["continuous"], group_col))
    if kinds["categorical"]:
        parts.append(desc_stat_c(table, kinds["categorical"], group_col, pseudo_group))
    if kinds["dichotomous"]:
        parts.append(desc_stat_d(table, kinds["dichotomous"], group_col, pseudo_group))
    if not parts:
        raise ValueError("no variables to describe")
    return reduce(outer_union, parts)
