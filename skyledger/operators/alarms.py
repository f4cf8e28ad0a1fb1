"""Alarm rules: definitions, desired alarms, reconciliation and evaluation over metric samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.capacity import (
    alarms_disabled,
    capacity_limits,
    has_own_storage,
    resolve_threshold,
    tag_thresholds,
)
from skyledger.functions.timefns import floor_epoch
from skyledger.operators.keyed import join_totals

RESOURCE_SCHEMA = (
    "service string, resource_id string, sub_id string, tags array<struct<key:string,value:string>>, state string, "
    "resource_type string, instance_type string, engine string, monitoring string, volume_type string, "
    "size_gib double, iops double, throughput double, cidr string, data_nodes int, master_nodes int, warm_nodes int, "
    "vcpus int, memory_mib bigint, baseline_iops double, max_iops double, baseline_mbps double, max_mbps double, "
    "baseline_gbps double, peak_gbps double"
)


def as_resources(df: DataFrame) -> DataFrame:
    """``df`` with every resource column present (absent ones NULL) in the common types."""
    columns = []
    for part in _split_schema(RESOURCE_SCHEMA):
        name, kind = part.split(" ", 1)
        columns.append((F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name))
    return df.select(*columns)


def _split_schema(ddl: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(ddl):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(ddl[start:i].strip())
            start = i + 1
    return [*parts, ddl[start:].strip()]


DEFINITION_SCHEMA = (
    "service string, filter_no int, filter_key string, filter_values array<string>, metric string, enabled boolean, "
    "threshold double, severity int, category string, plan string"
)


def resolve_definition(resources: DataFrame, definitions: DataFrame, key: str = "resource_id") -> DataFrame:
    """Definition per (resource, metric): the first filter in order that matches and has the metric, else the default.

    Definitions are a configuration table (one row per filter and metric; the default has no ``filter_key``).
    A filter names an attribute column or ``tag:<key>``; a disabled winner removes the metric. The table is broadcast,
    and resources never are, whatever the planner takes their size to be.
    """
    defs = definitions.withColumn("filter_no", F.coalesce("filter_no", F.lit(2147483647)))
    attributes = [c for c, t in resources.dtypes if t == "string"]
    own = F.array(*[F.struct(F.lit(c).alias("filter_key"), F.col(c).alias("filter_value")) for c in attributes])
    by_tag = F.transform(
        F.coalesce("tags", F.array().cast("array<struct<key:string,value:string>>")),
        lambda t: F.struct(F.concat(F.lit("tag:"), t["key"]).alias("filter_key"), t["value"].alias("filter_value")),
    )
    side = resources.select("service", F.col(key).alias("_key"), F.concat(own, by_tag).alias("_attributes"))
    # A filter meets only the resources that have its value; the default meets all of its service. A value that a resource
    # has twice gives its filter twice, which does not change the first one.
    filters = defs.where(F.col("filter_key").isNotNull()).withColumn("filter_value", F.explode("filter_values")).drop("filter_values")
    entries = side.select("service", "_key", F.explode("_attributes").alias("_a")).select("service", "_key", "_a.*")
    found = entries.join(F.broadcast(filters), ["service", "filter_key", "filter_value"]).drop("filter_key", "filter_value")
    defaults = side.drop("_attributes").join(
        F.broadcast(defs.where(F.col("filter_key").isNull()).drop("filter_key", "filter_values")), ["service"]
    )
    joined = found.unionByName(defaults)
    fields = F.struct("enabled", "threshold", "severity", "category", "plan")
    best = joined.groupBy("service", "_key", "metric").agg(F.min_by(fields, F.col("filter_no")).alias("_d"))
    return (
        best.select("service", F.col("_key").alias(key), "metric", "_d.*").where(F.col("enabled")).drop("enabled")
    )


def _applies() -> Column:
    """Whether the rule's own filter lets the resource through."""
    burst = F.regexp_replace(F.coalesce("instance_type", F.lit("")), r"^(db|cache)\.", "").startswith("t")
    return (
        F.when(F.col("applies") == "", F.lit(True))
        .when(F.col("applies") == "burstable", burst)
        .when(F.col("applies") == "own_storage", has_own_storage(F.coalesce("engine", F.lit(""))))
        .when(F.col("applies") == "in_use", F.coalesce(F.col("state") == "in-use", F.lit(False)))
        .when(F.col("applies") == "subnet", F.coalesce(F.col("resource_type") == "subnet", F.lit(False)))
        .when(
            F.col("applies") == "per_broker",
            F.coalesce(
                F.col("monitoring").isin("PER_BROKER", "PER_TOPIC_PER_BROKER", "PER_TOPIC_PER_PARTITION"), F.lit(False)
            ),
        )
        .otherwise(F.lit(False))
    )


def expand_rules(resources: DataFrame, rules: DataFrame, definitions: DataFrame | None = None) -> DataFrame:
    """Desired alarms: every rule of the resource's service that applies and has a threshold.

    The rule table is broadcast. Each row keeps the one limit and the one tag threshold its rule asks for; the maps of a
    resource do not go along.
    """
    known = capacity_limits(F.col("_tagged"), F.col("_off"))
    limits = F.create_map(*[x for n, c in known.items() for x in (F.lit(n), c.cast("double"))])
    read = as_resources(resources).select("*", tag_thresholds().alias("_tagged"), alarms_disabled().alias("_off"))
    prepared = read.withColumn("_limits", limits)
    by_tag = resolve_threshold(F.col("threshold_key"), F.col("threshold_value"), F.col("_tagged"), F.col("_off"))
    own = F.when(F.col("threshold_kind") == "tag", by_tag * F.col("threshold_factor")).otherwise(
        F.try_element_at("_limits", F.col("threshold_key"))
    )
    rows = prepared.join(F.broadcast(rules), "service", "inner").where(_applies()).select(
        *[c for c in rules.columns if c not in ("applies", "note")], "resource_id", "sub_id", "vcpus", "_off", own.alias("_own")
    )
    if definitions is not None:
        resolved = resolve_definition(as_resources(resources), definitions).select(
            "service", "resource_id", F.col("metric").alias("threshold_key"), F.col("threshold").alias("_defined")
        )
        rows = rows.join(resolved.distinct().hint("merge"), ["service", "resource_id", "threshold_key"], "left")
    else:
        rows = rows.withColumn("_defined", F.lit(None).cast("double"))
    per_cpu = F.when(F.col("per_vcpu"), F.col("vcpus").cast("double")).otherwise(F.lit(1.0))
    threshold = (
        F.when(F.col("threshold_kind") == "fixed", F.col("threshold_value"))
        .when(F.col("threshold_kind") == "defined", F.col("_defined") * F.col("threshold_factor") * per_cpu)
        .otherwise(F.col("_own"))
    )
    # A tag that disables alarms reaches every threshold a tag could have set, capacity limits included.
    tagged_kind = F.col("threshold_kind").isin("tag", "limit") & ~F.col("threshold_key").isin(
        "subnet_use", "search_nodes", "plain_volume_iops", "plain_volume_throughput", "plain_database_iops",
        "plain_database_throughput",
    )
    zero_limit = (F.col("threshold_kind") == "limit") & (F.col("threshold") == 0)
    name = F.replace(
        F.replace(F.col("name"), F.lit("{id}"), F.col("resource_id")), F.lit("{sub}"), F.coalesce("sub_id", F.lit(""))
    )
    return (
        rows.withColumn("threshold", threshold)
        .where(F.col("threshold").isNotNull() & ~zero_limit & ~(F.col("_off") & tagged_kind))
        .select(
            name.alias("alarm_name"), "rule_id", "service", "resource_id", "sub_id", "metrics", "statistics",
            "expression", "period", "datapoints", "periods", "comparison", "threshold", "missing",
        )
    )


def reconcile(desired: DataFrame, existing: DataFrame, prefixes: Sequence[str] = ()) -> DataFrame:
    """Plan per alarm name: create, keep or delete. Only existing names under the given prefixes are managed."""
    have = existing.select("alarm_name").distinct()
    if prefixes:
        managed = F.lit(False)
        for p in prefixes:
            managed = managed | F.col("alarm_name").startswith(p)
        have = have.where(managed)
    want = desired.select("alarm_name").distinct().withColumn("_want", F.lit(True))
    both = want.join(have.withColumn("_have", F.lit(True)), "alarm_name", "full")
    action = F.when(F.col("_have").isNull(), F.lit("create")).when(F.col("_want").isNull(), F.lit("delete"))
    return both.select("alarm_name", action.otherwise(F.lit("keep")).alias("action"))


def plan_text(plan: DataFrame) -> DataFrame:
    """The plan as lines of text, one per alarm to create or delete."""
    return plan.where(F.col("action") != "keep").select(
        "alarm_name", "action", F.concat(F.initcap("action"), F.lit(" alarm "), F.col("alarm_name")).alias("line")
    )


def plan_summary(plan: DataFrame) -> DataFrame:
    """Number of alarms per action."""
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("alarms"))


def minute_statistics(samples: DataFrame) -> DataFrame:
    """Count, sum, least and greatest value per resource, metric and minute: the unit every period is built from."""
    return samples.groupBy("resource_id", "metric", floor_epoch("epoch", 60).alias("minute")).agg(
        F.count("value").alias("_n"), F.sum("value").alias("_sum"), F.min("value").alias("_min"), F.max("value").alias("_max")
    )


def alarm_points(samples: DataFrame, alarms: DataFrame) -> DataFrame:
    """Value of each alarm's expression per period.

    Samples are reduced to minutes before they meet the alarms, so a busy resource costs one row per minute.
    """
    return points_of(period_statistics(samples, alarms), alarms)


def period_statistics(samples: DataFrame, alarms: DataFrame) -> DataFrame:
    """Count, sum, least and greatest value per alarm, position of its metric, and period; those of one period add up."""
    wanted = alarms.select(
        "alarm_name", "resource_id", "period", F.posexplode(F.arrays_zip("metrics", "statistics")).alias("_position", "_m")
    ).select("alarm_name", "resource_id", "period", "_position", F.col("_m.metrics").alias("metric"), F.col("_m.statistics").alias("statistic"))
    parts = join_totals(minute_statistics(samples), wanted, ["resource_id", "metric"], "inner", grows=True)
    return merge_statistics(parts.withColumn("period_start", floor_epoch("minute", F.col("period"))))


STATISTICS = ["alarm_name", "resource_id", "period", "_position", "statistic", "period_start"]


def merge_statistics(parts: DataFrame) -> DataFrame:
    """Statistics of the same alarm, metric and period combined."""
    return parts.groupBy(*STATISTICS).agg(
        F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"), F.min("_min").alias("_min"), F.max("_max").alias("_max")
    )


def points_of(statistics: DataFrame, alarms: DataFrame) -> DataFrame:
    """Value of each alarm's expression per period, from the statistics of its metrics."""
    per_metric = statistics.withColumn(
        "value",
        F.when(F.col("statistic") == "Average", F.try_divide("_sum", F.col("_n").cast("double")))
        .when(F.col("statistic") == "Sum", F.col("_sum"))
        .when(F.col("statistic") == "Minimum", F.col("_min"))
        .when(F.col("statistic") == "Maximum", F.col("_max"))
        .otherwise(F.col("_n").cast("double")),
    )
    wide = per_metric.groupBy("alarm_name", "resource_id", "period", "period_start").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("_position") + 1, "value"))).alias("_m")
    )
    rules = alarms.select("alarm_name", "expression", F.size("metrics").alias("_metrics")).distinct()
    wide = join_totals(wide, rules, ["alarm_name"], "inner", grows=True)
    return wide.withColumn("value", _expression()).select("alarm_name", "resource_id", "period", "period_start", "value")


def _total(positions: Column) -> Column:
    """Sum of the metrics at these positions; NULL when one of them is absent."""
    return F.aggregate(positions, F.lit(0.0), lambda a, i: a + F.try_element_at(F.col("_m"), i))


def _expression() -> Column:
    """Value of ``expression`` over the period's metrics ``_m`` (position -> value).

    Any sum of metrics ``m1+m2+...`` is read, however many there are, alone or per second; an expression that is
    neither a sum nor in the table is an error, not a NULL.
    """
    m1, m2, m3 = (F.try_element_at(F.col("_m"), F.lit(i)) for i in (1, 2, 3))
    period = F.col("period").cast("double")
    hundred = F.lit(100.0)
    w = Window.partitionBy("alarm_name").orderBy("period_start")
    total = _total(F.sequence(F.lit(1), F.col("_metrics")))
    seconds = (F.col("period_start") - F.lag("period_start").over(w)).cast("double")
    text = F.col("expression")
    sum_text = F.regexp_extract(text, r"^\(?(m\d+(?:\+m\d+)*)\)?(?:/PERIOD)?$", 1)
    terms = F.transform(F.split(F.replace(sum_text, F.lit("m"), F.lit("")), r"\+"), lambda i: i.try_cast("int"))
    plain_sum = F.when(text.endswith("/PERIOD"), _total(terms) / period).otherwise(_total(terms))
    table = {
        "m1/m2*100": F.try_divide(m1, m2) * hundred,
        "(m1+m2)*8/PERIOD": (m1 + m2) * F.lit(8.0) / period,
        "MAX(m1,m2)": F.greatest(m1, m2),
        "MAX(m1,m2)/PERIOD": F.greatest(m1, m2) / period,
        "DIFF(m1)": m1 - F.lag(m1).over(w),
        "m1/(m2+m3)*100": F.try_divide(m1, F.coalesce(m2, F.lit(0.0)) + F.coalesce(m3, F.lit(0.0))) * hundred,
        "m1/(m1+m2)*100": F.try_divide(m1, m1 + m2) * hundred,
        "RATE(SUM)*300": F.try_divide(total - F.lag(total).over(w), seconds) * F.lit(300.0),
        "m1*(100-m2)/100*8/PERIOD": m1 * (hundred - m2) / hundred * F.lit(8.0) / period,
        "LAG1/LAG2-1": F.try_divide(F.lag(m1, 1).over(w), F.lag(m1, 2).over(w)) - F.lit(1.0),
    }
    chain = F.when(sum_text != "", plain_sum)
    for name, value in table.items():
        chain = chain.when(text == name, value)
    return chain.otherwise(F.raise_error(F.concat(F.lit("unknown alarm expression: "), text)).cast("double"))


def breaching(value: Column, comparison: Column, threshold: Column) -> Column:
    return (
        F.when(comparison == ">=", value >= threshold)
        .when(comparison == ">", value > threshold)
        .when(comparison == "<=", value <= threshold)
        .when(comparison == "<", value < threshold)
    )


def dense_grid(
    points: DataFrame, key: str = "alarm_name", keys: DataFrame | None = None, start: int | None = None, as_of: int | None = None
) -> DataFrame:
    """One row per key and period; absent periods have a NULL value.

    Without more, a key's grid runs from its first to its last point. ``start`` and ``as_of`` (epoch seconds) move
    either end for all keys; ``keys`` (key, period) adds keys that have no point, from ``start`` or else in the period
    of ``as_of`` alone. Without ``as_of`` nothing is known of such keys.
    """
    extent = points.groupBy(key).agg(
        F.min("period_start").alias("_from"), F.max("period_start").alias("_to"), F.max("period").cast("long").alias("period")
    )
    if keys is not None and as_of is not None:
        named = keys.select(key, F.col("period").cast("long").alias("_period")).distinct()
        extent = named.join(extent, key, "left").withColumn("period", F.coalesce("period", "_period"))
    floor = lambda at: (F.lit(at) - F.pmod(F.lit(at), F.col("period"))).cast("long")
    last = floor(as_of) if as_of is not None else F.col("_to")
    first = floor(start) if start is not None else F.coalesce("_from", last)
    grid = (
        extent.withColumn("_first", first).withColumn("_last", last).where(F.col("_first") <= F.col("_last"))
        .select(key, "period", F.explode(F.sequence("_first", "_last", "period")).alias("period_start"))
    )
    return grid.join(points.select(key, "period_start", "value"), [key, "period_start"], "left")


def evaluate_alarms(points: DataFrame, alarms: DataFrame, start: int | None = None, as_of: int | None = None) -> DataFrame:
    """State per alarm and period: M of the last N periods breaching, with the rule's missing-data policy.

    ``missing``: INSUFFICIENT_DATA when all N periods lack data. ``ignore``: the state stays as it was. With ``as_of``
    every alarm is judged up to that time, those without any sample and those whose metric stopped included. Rows per
    alarm are bounded by its periods, whatever the sample volume was; N may be any number, as the counts of the last N
    periods are differences of running sums.
    """
    rules = alarms.select("alarm_name", *RULE)
    return judge_periods(dense_grid(points, keys=alarms, start=start, as_of=as_of).join(rules, "alarm_name", "inner"))


RULE = ["comparison", "threshold", "datapoints", "periods", "missing"]


def judge_periods(rows: DataFrame, carried: bool = False) -> DataFrame:
    """States from a gapless grid of periods with the alarm's rule on every row.

    With ``carried`` the grid starts in the middle: rows marked ``context`` only lend their values to the counts of the rows
    behind them and are left out of the result; ``known_before`` and ``state_before`` are the last known state and the state
    at the last of them.
    """
    breach = breaching(F.col("value"), F.col("comparison"), F.col("threshold")).cast("int")
    w = Window.partitionBy("alarm_name").orderBy("period_start")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        rows.withColumn("_breach", breach)
        .withColumn("_breaches", F.coalesce(F.sum("_breach").over(so_far), F.lit(0)))
        .withColumn("_present", F.count("_breach").over(so_far))
    )
    earlier = rows.select(
        "alarm_name", (F.col("period_start") + F.col("periods") * F.col("period")).alias("period_start"),
        F.col("_breaches").alias("_old_breaches"), F.col("_present").alias("_old_present"),
    )
    rows = rows.join(earlier, ["alarm_name", "period_start"], "left")
    known = F.when(F.col("breaches") >= F.col("datapoints"), F.lit("ALARM")).when(F.col("present") > 0, F.lit("OK"))
    kept = F.last("_known", ignorenulls=True).over(so_far)
    before = F.lag("state").over(w)
    if carried:
        known = F.when(~F.col("context"), known)
        kept = F.coalesce(kept, F.col("known_before"))
        before = F.when(F.lag("context").over(w), F.col("state_before")).otherwise(before)
    none = F.lit("INSUFFICIENT_DATA")
    state = F.when(F.col("missing") == "ignore", F.coalesce(kept, none)).otherwise(F.coalesce("_known", none))
    judged = (
        rows.withColumn("breaches", (F.col("_breaches") - F.coalesce("_old_breaches", F.lit(0))).cast("int"))
        .withColumn("present", (F.col("_present") - F.coalesce("_old_present", F.lit(0))).cast("int"))
        .withColumn("_known", known)
        .withColumn("_last_known", kept)
        .withColumn("state", state)
        .withColumn("previous_state", before)
    )
    if carried:
        return judged.where(~F.col("context")).select(*JUDGED, F.col("_last_known").alias("last_known"))
    return judged.select(*JUDGED)


JUDGED = ["alarm_name", "period_start", "value", "breaches", "present", "state", "previous_state"]


def transitions(states: DataFrame) -> DataFrame:
    """Rows where the state differs from the period before."""
    return states.where(F.col("previous_state").isNotNull() & (F.col("state") != F.col("previous_state")))


def alarm_context(points: DataFrame) -> DataFrame:
    """Newest three request counts and the newest error rate, hit rate and bytes per resource; absent ones are 0.

    ``points``: resource_id, metric, period_start, value (one per resource, metric and period).
    """
    w = Window.partitionBy("resource_id", "metric").orderBy(F.col("period_start").desc())
    newest = points.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= 3)

    def at(metric: str, n: int, alias: str) -> Column:
        pick = F.max(F.when((F.col("metric") == metric) & (F.col("_n") == n), F.col("value")))
        return F.coalesce(pick.cast("long"), F.lit(0)).alias(alias)

    return newest.groupBy("resource_id").agg(
        at("Requests", 1, "requests"),
        at("Requests", 2, "last_requests"),
        at("Requests", 3, "before_last_requests"),
        at("5xxErrorRate", 1, "error_rate"),
        at("CacheHitRate", 1, "hit_rate"),
        at("BytesDownloaded", 1, "bytes_downloaded"),
    )
