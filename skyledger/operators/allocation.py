"""Allocation of shared compute and transfer cost to workloads, and of untagged cost to tag owners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.cost import COSTS
from skyledger.operators.keyed import DEFAULT_SALTS, HeavyKeys, blank_strings, heavy_counts, heavy_keys, join_totals
from skyledger.session import cut_lineage

INSTANCE = ["year", "month", "usage_account", "date", "region", "instance"]
#: The instance of a line of stored cost, and what such cost is placed by.
PLACED = "_instance"
PLACED_BY = [*INSTANCE[:-1], PLACED]
WORKLOAD = ["resource_id", "eks_cluster_name", "eks_namespace", "eks_app"]
COST_DIMENSIONS = [
    "year", "month", "date", "charge_type", "payer_account", "usage_account", "billing_entity", "service",
    "product", "region", "location", "instance_type", "instance_family", "database_engine", "volume_type",
    "usage_type", "description", "resource_id", "emr_job_flow_id", "project", "name",
]
SCALED = ["usage_amount", *COSTS]
CAPACITY = ["vcpus", "gpus", "memory_gb"]
CPU_WEIGHT = 9.0  # fixed value: one vCPU-hour is priced like nine GiB-hours
PART_WORKLOADS = 20_000
NO_PARTNERS = 1 << 20  # keys over which lines that cannot be allocated spread
LARGE_INSTANCES = 1024  # instances with more workloads than that whose list may be broadcast

COMPUTE, TRANSFER, OTHER = 1, 2, 0
#: What workload metrics report.
USED = ["actual_cpu", "actual_mem", "reserved_cpu", "reserved_mem", "network_in", "network_out"]


def workload_usage(metrics: DataFrame, use_reserved: bool = False, placed: bool = False) -> DataFrame:
    """Daily usage per workload: CPU and memory as the greater of actual and reserved, network as in + out.

    ``placed`` moves the metrics by ``INSTANCE`` before they are summed, for steps that go on by instance: they need no
    other exchange. It suits metrics in which no instance is heavy; see ``measured_usage``.
    """
    if placed:
        return _summed_usage(_metric_rows(metrics).repartition(*INSTANCE), metrics, use_reserved, "_nulls")
    return blank_strings(_summed_usage(metrics.withColumn("date", F.to_date("date")), metrics, use_reserved))


def _nulls(df: DataFrame, names: Sequence[str]) -> Column:
    """A number that tells which strings of a row are NULL, for rows that go on with '' in their place."""
    dims = [c for c in names if dict(df.dtypes)[c] == "string"]
    return sum((F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(dims)), F.lit(0))


def _metric_rows(metrics: DataFrame) -> DataFrame:
    """Metrics with blank strings for NULL; ``_nulls`` keeps them apart from those that were blank."""
    dated = metrics.withColumn("date", F.to_date("date"))
    numbers = [c for c in USED if c in dated.columns]
    return blank_strings(dated.select(*INSTANCE, *WORKLOAD, *numbers, _nulls(dated, [*INSTANCE, *WORKLOAD]).alias("_nulls")))


def _summed_usage(rows: DataFrame, metrics: DataFrame, use_reserved: bool, *apart: str, also: Sequence[Column] = ()) -> DataFrame:
    """Usage per workload of ``rows``, the metrics as they are or placed, with what ``also`` sums of them."""

    def total(column: str, wanted: bool = True) -> Column:
        return F.sum(column) if wanted and column in metrics.columns else F.sum(F.lit(0.0))

    daily = rows.groupBy(*INSTANCE, *WORKLOAD, *apart).agg(
        total("actual_cpu").alias("_cpu"),
        total("actual_mem").alias("_mem"),
        total("reserved_cpu", use_reserved).alias("_cpu_reserved"),
        total("reserved_mem", use_reserved).alias("_mem_reserved"),
        total("network_in").alias("_in"),
        total("network_out").alias("_out"),
        *also,
    )
    return daily.select(
        *INSTANCE,
        *WORKLOAD,
        F.greatest("_cpu", "_cpu_reserved").alias("cpu_usage"),
        (F.greatest("_mem", "_mem_reserved") / F.lit(1024.0**3)).alias("mem_usage"),
        (F.col("_in") + F.col("_out")).alias("network_usage"),
        *[c for c in daily.columns if c in ("_vcpus", "_memory", "_idle")],
    )


def measured_usage(metrics: DataFrame, use_reserved: bool = False) -> tuple[DataFrame, HeavyKeys]:
    """Usage per workload and the salts of its heavy instances, for shares.

    Where no instance is heavy, usage is placed by instance and stays so: its sum, totals and shares need one exchange.
    Else it is summed by workload and stored, and the shares salt the heavy instances.
    """
    if not heavy_keys(_metric_rows(metrics), INSTANCE):
        return workload_usage(metrics, use_reserved, placed=True), HeavyKeys()
    usage = cut_lineage(workload_usage(metrics, use_reserved))
    return usage, heavy_keys(usage, INSTANCE)


def cost_lines(cost: DataFrame) -> DataFrame:
    """Cost without the cluster dimension, one row per remaining combination."""
    return blank_strings(cost.groupBy(*COST_DIMENSIONS).agg(*[F.sum(m).alias(m) for m in (*CAPACITY, *SCALED)]))


def _instance_of(lines: DataFrame, transfer: bool = True) -> Column:
    """The instance of a line, whether its blank strings are NULL or not.

    Lines that cannot be allocated, those without a resource id among them, get an ``instance`` that none has, derived
    from the row, so that the large rest of the bill spreads over all partitions instead of meeting under one key.
    """
    klass, types = line_class(), dict(lines.dtypes)
    allocatable = (klass != OTHER if transfer else klass == COMPUTE) & (F.col("resource_id") != "")
    row = F.xxhash64(*[F.coalesce(F.col(c), F.lit("")) if types[c] == "string" else F.col(c) for c in COST_DIMENSIONS])
    no_partner = F.concat(F.lit("\u0000"), F.pmod(row, F.lit(NO_PARTNERS)).cast("string"))
    return F.when(allocatable, F.col("resource_id")).otherwise(no_partner)


def placed_lines(lines: DataFrame, tasks: int) -> DataFrame:
    """Lines of a bill with their instance as ``PLACED``, placed by ``PLACED_BY`` in ``tasks`` partitions.

    Their sum, and, once that is stored in buckets by ``PLACED_BY``, the allocation need no other exchange of them.
    """
    return lines.withColumn(PLACED, _instance_of(lines)).repartition(tasks, *PLACED_BY)


def _keyed_lines(cost: DataFrame, transfer: bool = True) -> DataFrame:
    """``cost_lines`` with ``instance``, placed by ``INSTANCE`` before they are summed: the sum and the join need one exchange.

    Cost that is stored in buckets by ``PLACED_BY`` has been placed, and needs none.
    """
    sums = [F.sum(m).alias(m) for m in (*CAPACITY, *SCALED)]
    if PLACED in cost.columns:
        return cost.groupBy(*COST_DIMENSIONS, F.col(PLACED).alias("instance")).agg(*sums)
    # NULL and '' stay lines of their own, as they are in the sum of ``cost_lines``
    rows = blank_strings(cost.select(*COST_DIMENSIONS, *CAPACITY, *SCALED, _nulls(cost, COST_DIMENSIONS).alias("_nulls")))
    placed = rows.withColumn("instance", _instance_of(rows, transfer)).repartition(*INSTANCE)
    return placed.groupBy(*COST_DIMENSIONS, "instance", "_nulls").agg(*sums).drop("_nulls")


def line_class() -> Column:
    """1 instance hours, 2 data transfer, 0 anything else, from the charge and usage types alone."""
    usage = F.col("charge_type").endswith("Usage")
    box = F.col("usage_type").contains("BoxUsage") | F.col("usage_type").contains("SpotUsage")
    return (
        F.when(usage & box, F.lit(COMPUTE))
        .when(usage & F.col("usage_type").contains("DataTransfer"), F.lit(TRANSFER))
        .otherwise(F.lit(OTHER))
    )


def flag_lines(lines: DataFrame, usage: DataFrame, transfer: bool = True) -> DataFrame:
    """Lines with ``eks_flag``: the class where the instance has workload metrics that day, else 0."""
    keys = usage.where(F.col("instance") != "").select(*INSTANCE).distinct().withColumnRenamed("instance", "resource_id").withColumn("_hit", F.lit(1))
    wanted = [COMPUTE, TRANSFER] if transfer else [COMPUTE]
    return _flagged(join_totals(lines, keys, [*INSTANCE[:-1], "resource_id"]), wanted)


def flagged_cost(cost: DataFrame, usage: DataFrame, transfer: bool = True) -> DataFrame:
    """``flag_lines`` of ``cost_lines``, summed and joined behind one exchange."""
    keys = usage.where(F.col("instance") != "").select(*INSTANCE).distinct().withColumn("_hit", F.lit(1))
    lines = _keyed_lines(cost, transfer)
    flagged = _flagged(lines.join(keys, INSTANCE, "left"), [COMPUTE, TRANSFER] if transfer else [COMPUTE])
    return flagged.select(*COST_DIMENSIONS, *CAPACITY, *SCALED, "eks_flag")


def _flagged(joined: DataFrame, wanted: list[int]) -> DataFrame:
    return joined.withColumn(
        "eks_flag", F.when((F.col("_hit") == 1) & line_class().isin(*wanted), line_class()).otherwise(F.lit(OTHER))
    ).drop("_hit")


def cpu_weight(weight: float = CPU_WEIGHT) -> Column:
    """Part of a line's cost carried by CPU; an even split where the line has no capacity at all."""
    cpu = F.col("vcpus") * F.lit(weight)
    return F.coalesce(F.try_divide(cpu, cpu + F.col("memory_gb")), F.lit(0.5))


def _even(usage: str, total: str) -> Column:
    # An instance whose workloads all report zero is shared evenly, so that no cost is lost.
    return F.coalesce(F.try_divide(F.col(usage), F.col(total)), F.lit(1.0) / F.col("_n"))


def _with_totals(rows: DataFrame, salts: int | HeavyKeys, **totals: Column) -> DataFrame:
    """``rows`` with ``totals`` of their instance; a NULL date has none.

    Where measuring found no heavy instance, they are taken over each instance where its rows are, behind one exchange at
    most; else they are summed and joined.
    """
    if isinstance(salts, HeavyKeys) and not salts:
        whole = Window.partitionBy(*INSTANCE)
        return rows.withColumns({name: F.when(F.col("date").isNotNull(), c.over(whole)) for name, c in totals.items()})
    return join_totals(rows, rows.groupBy(*INSTANCE).agg(*[c.alias(name) for name, c in totals.items()]), INSTANCE, salts=salts)


def relative_shares(usage: DataFrame, salts: int | HeavyKeys = DEFAULT_SALTS) -> DataFrame:
    """Each workload's share of its instance's CPU, memory and network use that day."""
    totals = {f"_{kind}_total": F.sum(f"{name}_usage") for kind, name in (("cpu", "cpu"), ("mem", "mem"), ("net", "network"))}
    return _with_totals(usage, salts, **totals, _n=F.count(F.lit(1))).select(
        *INSTANCE,
        *WORKLOAD,
        "_n",
        _even("cpu_usage", "_cpu_total").alias("cpu_share"),
        _even("mem_usage", "_mem_total").alias("mem_share"),
        _even("network_usage", "_net_total").alias("net_share"),
    )


def billed_capacity(cost: DataFrame) -> DataFrame:
    """vCPU- and GiB-hours billed per instance and day, over its compute lines of all charge types."""
    placed = PLACED in cost.columns
    rows = cost if placed else blank_strings(cost)
    return (
        rows.where((line_class() == COMPUTE) & (F.col("resource_id") != ""))
        .groupBy(*INSTANCE[:-1], F.col(PLACED if placed else "resource_id").alias("instance"))
        .agg(F.sum("vcpus").alias("_vcpus"), F.sum("memory_gb").alias("_memory"))
    )


def capacity_shares(usage: DataFrame, cost: DataFrame, salts: int | HeavyKeys = DEFAULT_SALTS) -> DataFrame:
    """Shares of billed capacity, plus one idle row per instance for the capacity no workload used.

    The idle row keeps the instance's own id and cluster, with blank namespace and application; compute shares of an
    instance sum to 1.
    """
    return _capacity_shares(_with_billed(usage, cost), salts)


def _billed_rows(cost: DataFrame) -> DataFrame:
    """Billed capacity as one more workload of its instance."""
    return billed_capacity(cost).select(
        *INSTANCE,
        F.col("instance").alias("resource_id"),
        F.lit("").alias("eks_cluster_name"),
        F.lit("").alias("eks_namespace"),
        F.lit("").alias("eks_app"),
        "_vcpus",
        "_memory",
        F.lit(True).alias("_idle"),
    )


def _with_billed(usage: DataFrame, cost: DataFrame) -> DataFrame:
    """Usage, and the billed capacity as one more row per instance, so that both meet in one sum and one join."""
    return usage.withColumn("_idle", F.lit(False)).unionByName(_billed_rows(cost), allowMissingColumns=True)


def _placed_with_billed(metrics: DataFrame, cost: DataFrame, use_reserved: bool) -> DataFrame:
    """The same from the metrics, which meet the billed capacity before they are placed by instance and summed."""
    both = _metric_rows(metrics).withColumn("_idle", F.lit(False)).unionByName(_billed_rows(cost), allowMissingColumns=True)
    also = [F.sum(c).alias(c) for c in ("_vcpus", "_memory")]
    return _summed_usage(both.repartition(*INSTANCE), metrics, use_reserved, "_nulls", "_idle", also=also)


def _capacity_shares(rows: DataFrame, salts: int | HeavyKeys = DEFAULT_SALTS) -> DataFrame:
    busy = ~F.col("_idle")

    def share(used: str, total_used: str, billed_total: str) -> Column:
        part = F.coalesce(F.try_divide(F.when(F.col("_idle"), F.col(total_used)).otherwise(F.col(used)), F.col(billed_total)), F.lit(0.0))
        return F.when(F.col("_idle"), F.lit(1.0) - part).otherwise(part)

    joined = _with_totals(
        rows,
        salts,
        _cpu_total=F.sum(F.when(busy, F.col("cpu_usage"))),
        _mem_total=F.sum(F.when(busy, F.col("mem_usage"))),
        _net_total=F.sum(F.when(busy, F.col("network_usage"))),
        _n=F.count(F.when(busy, 1)),
        _cluster=F.max("eks_cluster_name"),
        _vcpus_total=F.sum("_vcpus"),
        _memory_total=F.sum("_memory"),
    )
    # Instances without any workload are not the clusters' and stay out.
    return joined.where(F.col("_n") > 0).select(
        *INSTANCE,
        "resource_id",
        "_n",
        F.when(F.col("_idle"), F.col("_cluster")).otherwise(F.col("eks_cluster_name")).alias("eks_cluster_name"),
        "eks_namespace",
        "eks_app",
        share("cpu_usage", "_cpu_total", "_vcpus_total").alias("cpu_share"),
        share("mem_usage", "_mem_total", "_memory_total").alias("mem_share"),
        F.when(busy, _even("network_usage", "_net_total")).alias("net_share"),
    )


def _spread(lines: DataFrame, shares: DataFrame, transfer: bool, weight: float) -> DataFrame:
    """One left join does the whole allocation: lines without a partner pass through unchanged.

    ``lines`` as ``_keyed_lines`` gives them; where no instance is cut, they are joined where they were summed. Those of
    no wanted class meet no workload, whatever their instance. An instance with very many workloads is cut into parts of ``PART_WORKLOADS``, and its lines are copied to each.
    """
    keyed = lines.withColumn("_class", line_class()).withColumn("_weight", cpu_weight(weight))
    parts = F.ceil(F.col("_n") / PART_WORKLOADS).cast("int")
    right = (
        shares.where(F.col("instance") != "")
        .withColumnRenamed("resource_id", "_workload")
        .withColumn("_hit", F.lit(1))
        .withColumn("_part", F.pmod(F.xxhash64("_workload", *WORKLOAD[1:]), parts).cast("int"))
        .drop("_n")
    )
    wanted = F.col("_class").isin([COMPUTE, TRANSFER] if transfer else [COMPUTE])
    cut = _in_parts(keyed, wanted, shares.where((parts > 1) & (F.col("instance") != "")).select(*INSTANCE, parts.alias("_parts")).distinct())
    if cut is None:
        joined = _join_wanted(keyed, right.drop("_part"), INSTANCE, wanted)
    else:
        joined = _join_wanted(cut, right, [*INSTANCE, "_part"], wanted)
        # A copy that met no workload in its part is not an unmatched line.
        joined = joined.where((F.col("_parts") == 1) | F.col("_hit").isNotNull()).drop("_part", "_parts")
    # The idle row takes no part in transfer cost.
    joined = joined.where((F.col("_class") != TRANSFER) | F.col("_hit").isNull() | F.col("net_share").isNotNull())
    hit = F.col("_hit") == 1
    compute = hit & (F.col("_class") == COMPUTE)
    moved = hit & (F.col("_class") == TRANSFER)
    blend = F.col("_weight") * F.col("cpu_share") + (F.lit(1.0) - F.col("_weight")) * F.col("mem_share")

    def scaled(column: str) -> Column:
        value = F.col(column)
        return (
            F.when(compute, value * blend).when(moved, value * F.col("net_share")).otherwise(value).alias(column)
        )

    def capacity(column: str, share: str) -> Column:
        value = F.col(column)
        return F.when(compute, value * F.col(share)).when(moved, F.lit(0.0)).otherwise(value).alias(column)

    names = [c for c in COST_DIMENSIONS if c != "resource_id"]
    return joined.select(
        *names,
        F.when(hit, F.col("_workload")).otherwise(F.col("resource_id")).alias("resource_id"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in WORKLOAD[1:]],
        capacity("vcpus", "cpu_share"),
        capacity("gpus", "cpu_share"),
        capacity("memory_gb", "mem_share"),
        *[scaled(c) for c in SCALED],
    )


def _join_wanted(lines: DataFrame, right: DataFrame, keys: Sequence[str], wanted: Column) -> DataFrame:
    """The lines, joined with ``right`` where they are ``wanted``; a left join that keeps the keys of the lines."""
    named = {k: f"_right_{k}" for k in keys}
    on = wanted
    for k, n in named.items():
        on = on & (F.col(k) == F.col(n))
    return lines.join(right.withColumnsRenamed(named), on, "left").drop(*named.values())


def _in_parts(lines: DataFrame, wanted: Column, large: DataFrame) -> DataFrame | None:
    """The lines, those of a large instance that are wanted once for each of its parts. Few instances are large; None where none is."""
    few = large.limit(LARGE_INSTANCES + 1).collect()
    if not few:
        return None
    if len(few) <= LARGE_INSTANCES:
        listed = lines.sparkSession.createDataFrame(few, large.schema)
        copied = lines.join(F.broadcast(listed), INSTANCE, "left")
    else:
        copied = join_totals(lines, large, INSTANCE, salts=heavy_keys(lines, INSTANCE), grows=True)
    copied = copied.withColumn("_parts", F.when(wanted, F.coalesce("_parts", F.lit(1))).otherwise(F.lit(1)))
    return copied.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))


def usage_shares(metrics: DataFrame, use_reserved: bool = False) -> DataFrame:
    """``relative_shares`` of the workloads that the metrics report."""
    return relative_shares(*measured_usage(metrics, use_reserved))


def billed_shares(metrics: DataFrame, cost: DataFrame, use_reserved: bool = False) -> DataFrame:
    """``capacity_shares`` of the workloads that the metrics report: behind one exchange where no instance is heavy."""
    if not heavy_keys(_metric_rows(metrics), INSTANCE):
        return _capacity_shares(_placed_with_billed(metrics, cost, use_reserved), HeavyKeys())
    rows = cut_lineage(_with_billed(workload_usage(metrics, use_reserved), cost))
    return _capacity_shares(rows, heavy_keys(rows, INSTANCE))


def _stored_shares(metrics: DataFrame, cost: DataFrame, use_reserved: bool, residual: bool) -> DataFrame:
    """Shares in the shared folder: usage is summed once, and the salts follow from what the metrics hold."""
    return cut_lineage(billed_shares(metrics, cost, use_reserved) if residual else usage_shares(metrics, use_reserved))


def allocate_compute(
    metrics: DataFrame, cost: DataFrame, weight: float = CPU_WEIGHT, use_reserved: bool = False
) -> DataFrame:
    """Level 0: instance cost by each workload's share of CPU and memory use; everything else unchanged."""
    return _spread(_keyed_lines(cost, False), _stored_shares(metrics, cost, use_reserved, False), False, weight)


def allocate_compute_and_transfer(
    metrics: DataFrame, cost: DataFrame, weight: float = CPU_WEIGHT, use_reserved: bool = False
) -> DataFrame:
    """Level 1: level 0, and data transfer of these instances by share of network use."""
    return _spread(_keyed_lines(cost), _stored_shares(metrics, cost, use_reserved, False), True, weight)


def allocate_with_residual(
    metrics: DataFrame, cost: DataFrame, weight: float = CPU_WEIGHT, use_reserved: bool = False
) -> DataFrame:
    """Level 2: workloads pay for what they used of the billed capacity; the idle rest stays with the cluster."""
    return _spread(_keyed_lines(cost), _stored_shares(metrics, cost, use_reserved, True), True, weight)


def allocation_stages(metrics: DataFrame, cost: DataFrame, use_reserved: bool = False) -> dict[str, DataFrame]:
    """Named intermediate steps for inspection; the caller decides what to write."""
    usage = cut_lineage(workload_usage(metrics, use_reserved))
    shares = cut_lineage(capacity_shares(usage, cost, heavy_keys(usage, INSTANCE)))
    flagged = flagged_cost(cost, usage)
    billed = (
        flagged.where((F.col("eks_flag") == COMPUTE) & (F.col("resource_id") != ""))
        .withColumnRenamed("resource_id", "instance")
        .select(*INSTANCE)
        .distinct()
    )
    return {
        "usage": usage,
        "flagged_cost": flagged,
        "relative_shares": relative_shares(usage),
        "capacity_shares": shares,
        "unmatched_usage": usage.join(billed, INSTANCE, "left_anti"),
        "allocated": _spread(_keyed_lines(cost), shares, True, CPU_WEIGHT),
    }


def tag_subsets(tags: Sequence[str]) -> list[list[str]]:
    """Every subset of the tag fields except the full set, in counting order (first tag is the lowest bit)."""
    return [[t for i, t in enumerate(tags) if mask >> i & 1] for mask in range((1 << len(tags)) - 1)]


def untag_factors(
    cost: DataFrame, tags: Sequence[str], measures: Sequence[str] = COSTS, store: bool = True
) -> DataFrame:
    """Scale factor per (date, tag values) and measure, and the number of rows.

    All rows with the same date and tag values are scaled alike in every pass, so the passes run on one row per
    such cell and the large table is touched once before and once after. With ``store`` the cells are written to the
    shared folder before the first pass and after every pass but the last (a pass uses its input twice, so an uncut
    plan would double each time); without it everything stays lazy, which suits one tag.
    """
    zero, one = F.lit(0.0), F.lit(1.0)
    cells = cost.groupBy("date", *tags).agg(*[F.coalesce(F.sum(m), zero).alias(m) for m in measures], F.count(F.lit(1)).alias("_rows"))
    cells = cells.select("*", *[one.alias(f"f_{m}") for m in measures])
    cells = cut_lineage(cells) if store else cells
    subsets = tag_subsets(tags)
    for number, fixed in enumerate(subsets, start=1):
        tagged = F.lit(False)
        for t in tags:
            if t not in fixed:
                tagged = tagged | (F.length(t) > 0)
        keys = ["date", *fixed]
        sums = []
        for m in measures:
            sums.append(F.sum(F.when(tagged, F.col(m)).otherwise(zero)).alias(f"_with_{m}"))
            sums.append(F.sum(F.when(tagged, zero).otherwise(F.col(m))).alias(f"_without_{m}"))
        joined = join_totals(cells, cells.groupBy(*keys).agg(*sums), keys)
        steps = {}
        for m in measures:
            owners = F.col(f"_with_{m}")
            grow = one + F.try_divide(F.col(f"_without_{m}"), owners)
            # Without tagged cost to carry it, the untagged cost stays where it is.
            steps[m] = F.when(owners == 0, one).when(tagged, grow).otherwise(zero)
        cells = joined.select(
            "date",
            *tags,
            "_rows",
            *[(F.col(m) * steps[m]).alias(m) for m in measures],
            *[(F.col(f"f_{m}") * steps[m]).alias(f"f_{m}") for m in measures],
        )
        if store and number < len(subsets):
            cells = cut_lineage(cells)
    return cells.select("date", *tags, *[f"f_{m}" for m in measures], "_rows")


def allocate_untagged(
    cost: DataFrame, tags: Sequence[str], measures: Sequence[str] = COSTS, store: bool = True
) -> DataFrame:
    """Move cost of blank tags to the tagged rows of the same date (and the same other tags), subset by subset.

    A row disappears only when its cost went to others and nothing is left on it. All measures are replaced and
    every daily total is conserved, credits included.
    """
    filled = blank_strings(cost)
    factors = untag_factors(filled, tags, measures, store)
    keys, salts = ["date", *tags], DEFAULT_SALTS
    if store:
        factors = cut_lineage(factors)
        salts = heavy_counts(factors, keys, "_rows")
    joined = join_totals(filled, factors.drop("_rows"), keys, salts=salts, grows=True)
    absorbed = F.lit(False)
    empty = F.lit(True)
    for m in measures:
        absorbed = absorbed | (F.col(f"f_{m}") == 0)
        empty = empty & (F.coalesce(F.col(m), F.lit(0.0)) == 0)
    scaled = {m: (F.col(m) * F.col(f"f_{m}")).alias(m) for m in measures}
    kept = joined.select(*[scaled.get(c, F.col(c)) for c in cost.columns], (~absorbed).alias("_kept"))
    return kept.where(F.col("_kept") | ~empty).select(*cost.columns)


def keep_positive(cost: DataFrame, measures: Sequence[str] = ("ondemand_cost", "amortized_cost", "billing_cost")) -> DataFrame:
    """Rows with any positive cost."""
    test = F.lit(False)
    for m in measures:
        test = test | (F.col(m) > 0)
    return cost.where(test)
