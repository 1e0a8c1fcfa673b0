"""Data quality checks, distributions and correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropweave.functions import guarded_corr, sequence_means
from cropweave.operators.grain import numeric_columns
from cropweave.operators.moments import cross_products

# Order statistics are found by counting: cells of a sixteenth of an octave first, then
# so many equal cells of the one cell that holds the rank, twice, then single values.
CELLS_PER_OCTAVE = 16
CELLS = 1 << 16
# Above any cell number: log2 of a double lies between -1,074 and 1,024.
OCTAVE_SHIFT, INFINITE_CELL = CELLS_PER_OCTAVE * 1_075, CELLS_PER_OCTAVE * 2_200


def _turn(row: DataFrame, names: Sequence[str], label: str, fields: Sequence[str]) -> DataFrame:
    """One aggregate row with columns ``<field>:<name>`` to one row per name."""
    entries = [
        F.struct(
            F.lit(name).alias(label),
            *[F.col(f"`{field}:{name}`").alias(field) for field in fields],
        )
        for name in names
    ]
    return row.select(F.explode(F.array(*entries)).alias("_entry")).select("_entry.*")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, in one pass."""
    names = list(columns) if columns is not None else df.columns
    counts = df.agg(
        *[F.count_if(F.col(name).isNull()).alias(f"nulls:{name}") for name in names]
    )
    return _turn(counts, names, "column", ["nulls"])


def columns_with_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return null_profile(df, columns).filter(F.col("nulls") > 0)


def schema_profile(df: DataFrame) -> DataFrame:
    """Type and number of present values per column."""
    counts = df.agg(
        *[F.count(F.col(name)).alias(f"present:{name}") for name in df.columns],
        *[F.lit(kind).alias(f"type:{name}") for name, kind in df.dtypes],
    )
    return _turn(counts, df.columns, "column", ["type", "present"])


def shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")
    )


def describe_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum."""
    names = list(columns) if columns is not None else numeric_columns(df)
    basics = df.agg(
        *[F.count(name).alias(f"count:{name}") for name in names],
        *[F.avg(name).alias(f"mean:{name}") for name in names],
        *[F.stddev_samp(name).alias(f"std:{name}") for name in names],
        *[F.min(name).cast("double").alias(f"min:{name}") for name in names],
        *[F.max(name).cast("double").alias(f"max:{name}") for name in names],
    )
    table = _turn(basics, names, "column", ["count", "mean", "std", "min", "max"])
    quartiles = quantiles(df, names, (0.25, 0.5, 0.75))
    wide = quartiles.groupBy("column").agg(
        *[
            F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(name)
            for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
        ]
    )
    return table.join(wide, "column", "left")


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """Exact quantiles with linear interpolation, as (column, q, quantile).

    A distributed selection: values are counted in cells, and the one cell that holds a
    rank is counted anew in finer cells. Every step is one pass that combines before its
    shuffle and leaves at most 65,537 rows per column and rank, however many rows there
    are and however many of them are equal. After the three steps a cell is narrower
    than 2^-35 of its values, so that at most 2^18 doubles are left to tell apart.
    """
    long = df.select(*[F.col(name).cast("double").alias(name) for name in columns])
    long = long.unpivot([], list(columns), "column", "value").dropna()
    value = F.col("value")
    octave = F.floor(F.log2(F.abs(value)) * CELLS_PER_OCTAVE) + OCTAVE_SHIFT
    octave = F.when(F.abs(value) == float("inf"), INFINITE_CELL).otherwise(octave)
    cell = F.when(value == 0, 0).otherwise(F.signum(value) * octave)
    counted = long.groupBy("column", cell.alias("_cell")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high")
    )
    whole = W.partitionBy("column")
    counted = counted.withColumn("rows", F.sum("_n").over(whole))
    ranks = [
        end((F.col("rows") - 1) * F.lit(float(q))).cast("bigint")
        for q in probabilities
        for end in (F.floor, F.ceil)
    ]
    found = _cells_with_ranks(
        counted.withColumns({"_ranks": F.array_distinct(F.array(*ranks)), "_before": F.lit(0)}),
        ["column"],
    )
    width = F.col("_high") - F.col("_low")
    fine = F.least(F.floor((value - F.col("_low")) / width * CELLS), F.lit(CELLS - 1))
    for step in (F.when(width > 0, fine).otherwise(0), F.when(width > 0, fine).otherwise(0), value):
        found = _refined(long, found, step)
    reached = F.map_from_entries(F.collect_set(F.struct("_rank", "_low")))
    by_column = found.withColumn("_rank", F.explode("_ranks")).groupBy("column", "rows").agg(
        reached.alias("_at")
    )
    asked = by_column.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in probabilities])))
    position = (F.col("rows") - 1) * F.col("q")
    lower = F.col("_at")[F.floor(position).cast("bigint")]
    upper = F.col("_at")[F.ceil(position).cast("bigint")]
    # Equal neighbours are the quantile itself, also where they are infinite.
    between = F.when(lower == upper, lower).otherwise(
        lower + (upper - lower) * (position - F.floor(position))
    )
    return asked.select("column", "q", between.alias("quantile"))


def _cells_with_ranks(counted: DataFrame, of: Sequence[str]) -> DataFrame:
    """The counted cells that hold one of the ranks, with the rows before them.

    ``counted`` has a row per cell: ``_n``, ``_low``, ``_high``, and of its group ``rows``,
    ``_ranks`` and ``_before``, the rows that come before the group.
    """
    order = W.partitionBy(*of).orderBy("_cell").rowsBetween(W.unboundedPreceding, 0)
    before = F.col("_before") + F.sum("_n").over(order) - F.col("_n")
    placed = counted.withColumn("_before", before)
    inside = F.filter(
        "_ranks",
        lambda rank: (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_n")),
    )
    return (
        placed.withColumn("_ranks", inside)
        .filter(F.size("_ranks") > 0)
        .select("column", "rows", "_before", "_ranks", "_low", "_high")
    )


def _refined(long: DataFrame, found: DataFrame, cell: Column) -> DataFrame:
    """Count the values of every found cell in smaller cells and find the ranks again."""
    # At most one row per column and rank.
    cells = F.broadcast(found.withColumnRenamed("column", "_column"))
    inside = long.join(
        cells,
        (F.col("column") == F.col("_column")) & F.col("value").between(F.col("_low"), F.col("_high")),
    )
    group = ["column", "rows", "_before", "_ranks"]
    counted = inside.groupBy(*group, cell.alias("_cell")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("value").alias("_low"),
        F.max("value").alias("_high"),
    )
    return _cells_with_ranks(counted, group)


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Pearson correlation of all pairs over complete pairs, as (x, y, corr).

    Made of the sums of ``cross_products``; nothing runs before the plan does. A constant
    side gives NULL.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    sums = cross_products(df, names)
    n = F.col("n")
    spread_x = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), n)
    spread_y = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), n)
    shared = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)
    # A constant column leaves only rounding residue relative to its own scale.
    flat = (spread_x <= F.col("sxx") * 1e-13) | (spread_y <= F.col("syy") * 1e-13)
    corr = F.when(~flat, F.try_divide(shared, F.sqrt(spread_x) * F.sqrt(spread_y)))
    labels = F.array(*[F.lit(name) for name in names])
    half = sums.select("i", "j", corr.alias("corr"))
    sides = F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    return (
        half.select(F.explode(F.array_distinct(sides)).alias("_p"), "corr")
        .select(
            labels[F.col("_p.i")].alias("x"), labels[F.col("_p.j")].alias("y"), "corr"
        )
    )


def target_correlations(
    df: DataFrame, target: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Correlation of every numeric column with the target, as (feature, corr).

    The columns are unpivoted in memory and combined before the shuffle, so only one
    row per feature and task is sent, however many features there are.
    """
    names = list(columns) if columns is not None else numeric_columns(df, [target])
    wide = df.select(
        F.col(target).cast("double").alias("_target"),
        *[F.col(name).cast("double").alias(name) for name in names],
    )
    return (
        wide.unpivot(["_target"], names, "feature", "_value")
        .groupBy("feature")
        .agg(guarded_corr(F.col("_value"), F.col("_target")).alias("corr"))
    )


def sequence_correlations(
    samples: DataFrame,
    names: Sequence[str],
    sequence: str = "features",
    target: str = "target",
) -> DataFrame:
    """Correlation of each feature's mean over the sequence with the target."""
    means = samples.select(target, sequence_means(sequence, len(names)).alias("_means"))
    wide = means.select(
        target, *[F.col("_means")[i].alias(name) for i, name in enumerate(names)]
    )
    return target_correlations(wide, target, names)


def histogram(
    values: DataFrame, value: str = "value", group: str = "split", bins: int = 60
) -> DataFrame:
    """Counts in equal bins between each group's own minimum and maximum.

    Empty bins are listed with 0. The last bin includes the maximum. ``group`` is a
    split label, so there are few groups and many rows in each: the ranges of all groups
    are one map, a scalar subquery, and rows are counted where they lie.
    """
    present = values.select(group, value).dropna()
    low, high = F.min(value).cast("double"), F.max(value).cast("double")
    single = low == high
    ranges = present.groupBy(group).agg(
        F.struct(
            F.when(single, low - 0.5).otherwise(low).alias("low"),
            F.when(single, high + 0.5).otherwise(high).alias("high"),
        ).alias("_range")
    )
    entries = F.collect_list(F.struct(group, "_range"))
    # The map becomes a column, so that the subquery is one, however often it is read.
    located = present.withColumn("_ranges", ranges.agg(F.map_from_entries(entries)).scalar())
    own = F.col("_ranges")[F.col(group)]
    place = F.floor((F.col(value) - own["low"]) / (own["high"] - own["low"]) * bins).cast("int")
    counts = located.groupBy(group, F.least(place, F.lit(bins - 1)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    width = F.col("_range.high") - F.col("_range.low")
    frame = ranges.select(
        group,
        F.col("_range.low").alias("_low"),
        width.alias("_width"),
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
    )
    return frame.join(counts, [group, "bin"], "left").select(
        group,
        "bin",
        (F.col("_low") + F.col("_width") * F.col("bin") / bins).alias("lower"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def quality_report(
    df: DataFrame, label: str, date: str = "Date", year: str = "Year"
) -> DataFrame:
    """Schema, missing values, date range, missing years and label gaps as one table.

    One aggregate over the rows delivers all of it; the years seen, at most a few thousand,
    are one array of it.
    """
    names = df.columns
    facts = df.agg(
        F.struct(
            *[F.count_if(F.col(f"`{name}`").isNull()).alias(f"n{k}") for k, name in enumerate(names)]
        ).alias("nulls"),
        F.min(date).cast("string").alias("first"),
        F.max(date).cast("string").alias("last"),
        F.collect_set(F.col(year).cast("int")).alias("years"),
    )
    entry = "array<struct<check:string,subject:string,result:string>>"

    def row(check: str, subject: str, result: Column) -> Column:
        return F.struct(F.lit(check), F.lit(subject), result.cast("string"))

    kinds = dict(df.dtypes)
    missing = F.array_except(
        F.sequence(F.array_min("years"), F.array_max("years")), F.col("years")
    )
    gaps = F.when(
        F.size("years") > 0,
        F.transform(missing, lambda y: F.struct(F.lit("missing_year"), F.lit(year), y.cast("string"))),
    ).otherwise(F.array())
    nulls = [F.col(f"nulls.n{k}") for k in range(len(names))]
    fixed = F.array(
        *[row("type", name, F.lit(kinds[name])) for name in names],
        *[row("nulls", name, n) for name, n in zip(names, nulls, strict=True)],
        row("first_date", date, F.col("first")),
        row("last_date", date, F.col("last")),
        row("missing_label", label, nulls[names.index(label)]),
    )
    table = F.concat(fixed.cast(entry), gaps.cast(entry))
    return facts.select(F.inline(table))
