"""Permutation and rotation tests with the replicate axis as rows.

A cell (site, month, variable) is a small matrix of labels x positions, bounded by the
calendar.  Replicates are generated next to each cell, spread over the cluster, and
counted; the random order of labels is a hash of (seed, replicate, block, label), so a
result does not depend on partitioning or on tasks being run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fieldgauge.functions.distributions import norm_ppf
from fieldgauge.functions.replicates import null_statistics
from fieldgauge.operators.ranks import avg_rank, join_on, small_group_rank

# fixed values: replicates, block length, tolerances
REPLICATES = 4999
SCORE_REPLICATES = 9999
BLOCK = 7
CHUNK = 256


def _spread_replicates(
    cells: DataFrame, total: Column | int, name: str = "replicate", chunk: int = CHUNK
) -> DataFrame:
    """Copy each cell for replicates 0 .. total-1, distributed chunk by chunk."""
    spark = cells.sparkSession
    total = F.lit(total) if isinstance(total, int) else total
    total = total.cast("bigint")
    chunks = cells.withColumn("_total", total).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_total") - 1) / chunk)))
    )
    # an explicit number: the rows are few but each stands for much work
    parts = max(2 * spark.sparkContext.defaultParallelism, 1)
    spread = chunks.repartition(parts, F.xxhash64("_chunk", *cells.columns[:1]), "_chunk")
    last = F.least(F.col("_total") - 1, F.col("_chunk") * chunk + (chunk - 1))
    return spread.withColumn(name, F.explode(F.sequence(F.col("_chunk") * chunk, last))).drop(
        "_total", "_chunk"
    )


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v)


def _middle(sorted_array: Column) -> Column:
    n = F.size(sorted_array)
    low = F.get(sorted_array, F.floor((n - 1) / 2).cast("int"))
    return (low + F.get(sorted_array, F.floor(n / 2).cast("int"))) / 2


def deviations(df: DataFrame, matrix: str, output: str, absolute: bool) -> DataFrame:
    """Each row of the matrix minus its median, signed or absolute."""
    mark = F.abs if absolute else (lambda c: c)
    return (
        df.withColumn("_sorted", F.transform(matrix, lambda r: F.array_sort(r)))
        .withColumn(
            output,
            F.zip_with(matrix, "_sorted", lambda r, s: F.transform(r, lambda v: mark(v - _middle(s)))),
        )
        .drop("_sorted")
    )


def with_f(df: DataFrame, matrix: str, output: str) -> DataFrame:
    """One-way F of the matrix rows (0 when the rows are constant)."""
    rows, width = F.size(matrix), F.size(F.col(matrix)[0])
    out = df.withColumn("_means", F.transform(matrix, lambda r: _sum(r) / F.size(r))).withColumn(
        "_grand", _sum(F.col("_means")) / rows
    )
    grand = F.col("_grand")
    out = out.withColumns(
        {
            "_between": width * _sum(F.transform("_means", lambda m: (m - grand) * (m - grand))),
            "_within": _sum(
                F.zip_with(
                    matrix, "_means", lambda r, m: _sum(F.transform(r, lambda v: (v - m) * (v - m)))
                )
            ),
        }
    )
    f = (F.col("_between") / (rows - 1)) / (F.col("_within") / (rows * (width - 1)))
    return out.withColumn(output, F.when(F.col("_within") > 0, f).otherwise(0.0)).drop(
        "_means", "_grand", "_between", "_within"
    )


def _block_orders(labels: Column, blocks: Column, seed: int, replicate: str = "replicate") -> Column:
    """Per block, the labels in hash order: a random permutation."""
    return F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda b: F.transform(
            F.array_sort(
                F.transform(
                    F.sequence(F.lit(0), labels - 1),
                    lambda label: F.struct(
                        F.xxhash64(F.lit(seed), F.col(replicate), b, label).alias("h"), label.alias("label")
                    ),
                )
            ),
            lambda s: s["label"],
        ),
    )


def _reassembled(matrix: str, orders: str, block: int) -> Column:
    """Matrix whose rows take each block from the row the order names."""
    m, order = F.col(matrix), F.col(orders)
    return F.transform(
        F.sequence(F.lit(0), F.size(m) - 1),
        lambda label: F.flatten(
            F.transform(
                order, lambda o, b: F.slice(F.get(m, F.get(o, label)), b * block + 1, F.lit(block))
            )
        ),
    )


def block_permutation(
    cells: DataFrame, by: Sequence[str], replicates: int = REPLICATES, block: int = BLOCK,
    matrix: str = "matrix", seed: int = 1,
) -> DataFrame:
    """Level F and median-centred spread F of each cell, with block-permutation p-values.

    ``matrix`` holds one row of values per year.  Year labels are shuffled inside blocks
    of consecutive positions; p = (1 + hits) / (1 + replicates).
    """
    by = list(by)
    base = with_f(cells.select(*by, matrix), matrix, "level_f")
    base = deviations(base, matrix, "_centred", absolute=False)
    base = with_f(deviations(base, matrix, "_dev", absolute=True), "_dev", "spread_f").drop("_dev")
    blocks = F.ceil(F.size(F.col(matrix)[0]) / block).cast("int")
    drawn = _spread_replicates(base, replicates).withColumn(
        "_orders", _block_orders(F.size(matrix), blocks, seed)
    )
    drawn = drawn.withColumns(
        {
            "_level": _reassembled(matrix, "_orders", block),
            "_spread": _reassembled("_centred", "_orders", block),
        }
    ).drop(matrix, "_centred", "_orders")
    drawn = with_f(drawn, "_level", "_level_null").drop("_level")
    drawn = deviations(drawn, "_spread", "_dev", absolute=True).drop("_spread")
    drawn = with_f(drawn, "_dev", "_spread_null").drop("_dev")
    hit = lambda null, seen: F.count_if(F.col(null) >= F.col(seen) - 1e-12)
    return drawn.groupBy(*by).agg(
        F.first("level_f").alias("level_f"),
        ((1 + hit("_level_null", "level_f")) / (replicates + 1)).alias("level_p"),
        F.first("spread_f").alias("spread_f"),
        ((1 + hit("_spread_null", "spread_f")) / (replicates + 1)).alias("spread_p"),
    )


def exact_exchange(
    cells: DataFrame, by: Sequence[str], block: int = BLOCK, matrix: str = "matrix"
) -> DataFrame:
    """Two-year cells: every assignment of blocks to the two years, for level and spread.

    2^k assignments for k blocks; p is the share with a statistic as large as observed.
    """
    by = list(by)
    base = with_f(cells.select(*by, matrix), matrix, "level_f")
    base = deviations(base, matrix, "_centred", absolute=False)
    base = with_f(deviations(base, matrix, "_dev", absolute=True), "_dev", "spread_f").drop("_dev")
    blocks = F.ceil(F.size(F.col(matrix)[0]) / block).cast("int")
    drawn = _spread_replicates(
        base.withColumn("_assignments", F.pow(F.lit(2.0), blocks).cast("bigint")),
        F.col("_assignments"),
    )
    bit = lambda b: F.getbit(F.col("replicate"), b)
    drawn = drawn.withColumn(
        "_orders",
        F.transform(
            F.sequence(F.lit(0), blocks - 1),
            lambda b: F.array(bit(b).cast("int"), (1 - bit(b)).cast("int")),
        ),
    )
    drawn = drawn.withColumns(
        {
            "_level": _reassembled(matrix, "_orders", block),
            "_spread": _reassembled("_centred", "_orders", block),
        }
    ).drop(matrix, "_centred", "_orders")
    drawn = with_f(drawn, "_level", "_level_null").drop("_level")
    drawn = with_f(
        deviations(drawn, "_spread", "_dev", absolute=True).drop("_spread"), "_dev", "_spread_null"
    ).drop("_dev")
    share = lambda null, seen: F.avg((F.col(null) >= F.col(seen) - 1e-12).cast("double"))
    return drawn.groupBy(*by).agg(
        F.count(F.lit(1)).alias("assignments"),
        F.first("level_f").alias("level_f"), share("_level_null", "level_f").alias("level_p"),
        F.first("spread_f").alias("spread_f"), share("_spread_null", "spread_f").alias("spread_p"),
    )


def block_scores(
    daily: DataFrame, by: Sequence[str], year: str, position: str, value: str, block: int = BLOCK
) -> DataFrame:
    """Per cell and kind of score (level ranks, spread normal scores): block sums per year.

    Level scores are mid-ranks of the values in the cell.  Spread scores are normal
    scores of the ranks of absolute deviations from the year's median.
    """
    by = list(by)
    medians = daily.groupBy(*by, year).agg(F.median(value).alias("_m"))  # at most 31 values
    rows = daily.select(*by, year, position, value).join(medians, [*by, year]).withColumn(
        "_dev", F.abs(F.col(value) - F.col("_m"))
    )
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    ranked = rows.withColumns(
        {"_level": small_group_rank(value, by), "_rank": small_group_rank("_dev", by)}
    ).join(sizes, by)
    scored = ranked.withColumn("_spread", norm_ppf(0.5 + F.col("_rank") / (2 * (F.col("_n") + 1))))
    kinds = F.array(
        F.struct(F.lit("level").alias("kind"), F.col("_level").alias("score")),
        F.struct(F.lit("spread").alias("kind"), F.col("_spread").alias("score")),
    )
    long = scored.select(
        *by, year, F.floor((F.col(position) - 1) / block).cast("int").alias("_block"), F.inline(kinds)
    )
    sums = long.groupBy(*by, "kind", year, "_block").agg(F.sum("score").alias("_s"))
    table = sums.groupBy(*by, "kind", year).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_block", "_s"))), lambda x: x["_s"]
        ).alias("_line")
    ).groupBy(*by, "kind").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col(year), F.col("_line")))), lambda x: x["_line"]
        ).alias("sums")
    )
    moments = long.groupBy(*by, "kind").agg(
        F.count("score").alias("n"), F.avg("score").alias("mean"), F.var_samp("score").alias("variance")
    )
    return table.join(moments, [*by, "kind"])


def block_score_test(
    scores: DataFrame, by: Sequence[str], replicates: int = SCORE_REPLICATES, seed: int = 1
) -> DataFrame:
    """Score statistic of each cell with its block-permutation p-value.

    Only block sums are permuted, a few dozen numbers per cell whatever the replicates.
    """
    by = [*by, "kind"]
    labels = F.size("sums")
    width = F.col("n") / labels

    def statistic(totals: str) -> Column:
        mean = F.col("mean")
        between = width * _sum(F.transform(totals, lambda t: F.pow(t / width - mean, 2)))
        return F.try_divide(between, F.col("variance"))

    seen = scores.withColumn("_totals", F.transform("sums", _sum)).withColumn(
        "statistic", statistic("_totals")
    ).drop("_totals")
    drawn = _spread_replicates(seen, replicates).withColumn(
        "_orders", _block_orders(labels, F.size(F.col("sums")[0]), seed)
    )
    m, orders = F.col("sums"), F.col("_orders")
    drawn = drawn.withColumn(
        "_totals",
        F.transform(
            F.sequence(F.lit(0), labels - 1),
            lambda label: _sum(F.transform(orders, lambda o, b: F.get(F.get(m, F.get(o, label)), b))),
        ),
    ).withColumn("_null", statistic("_totals"))
    return drawn.groupBy(*by).agg(
        F.first("statistic").alias("statistic"),
        ((1 + F.count_if(F.col("_null") >= F.col("statistic") - 1e-10)) / (replicates + 1)).alias("p"),
    )


def rotation_test(
    ranks: DataFrame, by: Sequence[str], matrix: str = "ranks", width: int = 12
) -> DataFrame:
    """Exact circular-rotation test of a recurring yearly cycle.

    ``ranks`` holds the within-year ranks, one row of ``width`` per year.  Every
    combination of phase shifts of the later years is tried with the first year fixed:
    width^(years-1) of them.  The years are split in two halves; the rotated sums of each
    half are formed once and every pair is then one short generated expression.
    """
    by = list(by)
    m, years = F.col(matrix), F.size(matrix)
    n_first = F.floor((years - 1) / 2).cast("int")
    n_second = years - 1 - n_first
    places = F.sequence(F.lit(0), F.lit(width - 1))

    def rotated_sum(number: Column, start: Column, count: Column) -> Column:
        """Sum of ``count`` years; digits of ``number`` in base ``width`` are the shifts."""
        lines = F.slice(m, start, count)

        def at(c: Column) -> Column:
            shift = lambda y: F.floor(number / F.pow(F.lit(float(width)), y)).cast("bigint")
            return _sum(
                F.transform(lines, lambda r, y: F.get(r, ((c + shift(y)) % width).cast("int")))
            )

        return F.transform(places, at)

    def combinations(count: Column) -> Column:
        return F.pow(F.lit(float(width)), count).cast("bigint")

    def squares(values: list[Column]) -> Column:
        total = F.lit(0.0)
        for v in values:
            total = total + (v - F.col("_mid")) * (v - F.col("_mid"))
        return total

    observed = F.transform(places, lambda c: _sum(F.transform(m, lambda r: F.get(r, c))))
    cells = ranks.select(*by, matrix).withColumns(
        {"_mid": (years * (width + 1) / 2).cast("double"), "_observed": observed}
    )
    cells = cells.withColumn("statistic", squares([F.col("_observed")[i] for i in range(width)])).drop("_observed")
    cells = cells.withColumn(
        "_bs",
        F.transform(
            F.sequence(F.lit(0).cast("bigint"), combinations(n_second) - 1),
            lambda k: rotated_sum(k, n_first + 2, n_second),
        ),
    )
    first = _spread_replicates(cells, combinations(n_first), "_first", chunk=width)
    sums = first.withColumn(
        "_a", F.zip_with(m[0], rotated_sum(F.col("_first"), F.lit(2), n_first), lambda x, y: x + y)
    )
    pairs = sums.select(*by, "statistic", "_mid", "_a", F.explode_outer("_bs").alias("_b"))
    null = squares([F.col("_a")[i] + F.col("_b")[i] for i in range(width)])
    return pairs.groupBy(*by).agg(
        F.first("statistic").alias("statistic"),
        F.count(F.lit(1)).alias("rotations"),
        F.avg((null >= F.col("statistic") - 1e-9).cast("double")).alias("rotation_p"),
    )


def stratified_permutation(
    df: DataFrame, value: str, label: str, stratum: str, site: str = "location_id",
    by: Sequence[str] = (), replicates: int = SCORE_REPLICATES, seed: int = 1, chunk: int | None = None,
) -> DataFrame:
    """Kruskal-Wallis H of labels, with labels moved only inside a stratum.

    One row per site and cell.  For each replicate the sites of a stratum are put in hash
    order and take the labels of the stratum in turn; one labelling serves all cells.

    H is the sum over labels of (sum of z)^2 / n, z being the standardised rank, so a site
    brings one vector of z and a stratum its labels with their running counts.  Both go to each
    chunk of replicates, whose task holds one stratum at a time and draws, adds and compares there
    (``functions.replicates``).  No row is made for a replicate: what is shuffled is sites x cells
    for each chunk, of which there are two per core unless ``chunk`` says how many replicates one has.
    """
    if not by:
        one = stratified_permutation(
            df.withColumn("_all", F.lit(0)), value, label, stratum, site, ["_all"], replicates, seed, chunk
        )
        return one.drop("_all")
    by = list(by)
    ranked = avg_rank(df.filter(F.col(value).isNotNull()), value, by, "_rank").select(
        *by, site, label, "_rank"
    )
    cell = ranked.groupBy(*by).agg(F.avg("_rank").alias("_mean"), F.stddev_samp("_rank").alias("_spread"))
    scores = join_on(ranked, cell, by).select(
        *by, site, label, F.try_divide(F.col("_rank") - F.col("_mean"), F.col("_spread")).alias("_z")
    )

    def h_of(rows: DataFrame, keys: list[str]) -> DataFrame:
        groups = rows.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_g"), F.sum("_z").alias("_s"))
        return groups.groupBy(*keys).agg(F.sum(F.col("_s") * F.col("_s") / F.col("_g")).alias("_h"))

    sites = df.select(site, stratum, label).distinct()
    counts = sites.groupBy(stratum, label).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(stratum).orderBy(label))
    steps = counts.select(stratum, F.struct(upto.alias("upto"), F.col(label).alias("label")).alias("_step")).groupBy(
        stratum
    ).agg(F.array_sort(F.collect_list("_step")).alias("_steps"))
    vectors = scores.groupBy(site).agg(F.collect_list(F.struct(*by, "_z")).alias("_cells"))
    carried = join_on(join_on(sites.drop(label), steps, [stratum]), vectors, [site], "left")
    parts = max(2 * df.sparkSession.sparkContext.defaultParallelism, 1)
    chunk = chunk or -(-replicates // parts)
    drawn = (
        carried.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // chunk))))
        .select("_chunk", stratum, site, "_steps", "_cells")
        .repartitionById(parts, F.pmod("_chunk", F.lit(parts)))
        .sortWithinPartitions("_chunk", stratum, site)
    )
    cells = scores.select(*by).schema
    null = drawn.mapInArrow(
        null_statistics(to_arrow_schema(cells), seed, chunk, replicates),
        T.StructType([*cells.fields, T.StructField("_h", T.ArrayType(T.DoubleType()))]),
    )
    observed = h_of(scores, by).withColumnRenamed("_h", "statistic")
    hits = F.size(F.filter("_h", lambda h: h >= F.col("statistic") - 1e-10))
    return join_on(null, observed, by).withColumn("_hits", hits).groupBy(*by).agg(
        F.first("statistic").alias("statistic"), ((1 + F.sum("_hits")) / (replicates + 1)).alias("p")
    )
