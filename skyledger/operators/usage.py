"""Usage tables built from raw metric samples: pods, ingresses, containers, databases, daily extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import text
from skyledger.functions.timefns import usage_day
from skyledger.operators import metrics as m
from skyledger.operators.keyed import join_totals

# Label names of the samples and the two driver keys of the node label.
REGION, CLUSTER = "topology_kubernetes_io_region", "alpha_eksctl_io_cluster_name"
APP_LABELS = ("label_app", "label_app_kubernetes_io_name")
NODE_DRIVERS = ("ebs.csi.aws.com", "efs.csi.aws.com")
POD_LABELS = ["region", "cluster", "namespace", "pod", "nodeid"]
POD_METRICS = {
    "cpu": "container_cpu_usage_seconds_total",
    "memory": "container_memory_working_set_bytes",
    "network_in": "container_network_receive_bytes_total",
    "network_out": "container_network_transmit_bytes_total",
}


def _label(name: str) -> Column:
    return F.coalesce(F.try_element_at(F.col("labels"), F.lit(name)), F.lit(""))


def _series_id() -> Column:
    """Identity of a label set, whatever the order of its entries."""
    return F.xxhash64(F.array_sort(F.map_entries("labels")))


def _pod_rows(samples: DataFrame) -> DataFrame:
    """Samples of all pod metrics with their kind; CPU and memory only of containers, which have an image."""
    kind = None
    for name, metric in POD_METRICS.items():
        test = F.col("metric") == metric
        kind = F.when(test, F.lit(name)) if kind is None else kind.when(test, F.lit(name))
    kept = samples.where(F.col("metric").isin(*POD_METRICS.values())).withColumn("kind", kind)
    return kept.where(~F.col("kind").isin("cpu", "memory") | (_label("image") != "")).select(
        "kind",
        _label(REGION).alias("region"),
        _label(CLUSTER).alias("cluster"),
        _label("namespace").alias("namespace"),
        _label("pod").alias("pod"),
        _label("nodeid").alias("nodeid"),
        # Containers and interfaces of a pod are separate series; the remaining labels tell them apart.
        _series_id().alias("series"),
        "epoch",
        "value",
    )


def pod_apps(samples: DataFrame) -> DataFrame:
    """Application label per namespace, pod and day, weight 1 where the pod's label series exists."""
    rows = samples.where(F.col("metric") == "kube_pod_labels").select(
        _label("namespace").alias("namespace"),
        _label("pod").alias("pod"),
        text.first_label("labels", *APP_LABELS).alias("app"),
        F.col("value"),
        m.floor_epoch("epoch", 86400).alias("day_start"),
    )
    return rows.groupBy("namespace", "pod", "app", "day_start").agg(F.avg("value").alias("value"))


def pods_off_host_network(samples: DataFrame) -> DataFrame:
    rows = samples.where((F.col("metric") == "kube_pod_info") & (_label("host_network") == "false"))
    keys = [_label("namespace").alias("namespace"), _label("pod").alias("pod"), m.floor_epoch("epoch", 86400).alias("day_start")]
    return rows.groupBy(*keys).agg(F.avg("value").alias("value"))


def _daily_pod_metrics(samples: DataFrame, apps: DataFrame, off_host: DataFrame) -> DataFrame:
    """Daily value per pod, kind and application; the kind is part of the series, so all metrics go through together."""
    series = ["kind", *POD_LABELS, "series"]
    unique = m.drop_repeated_samples(_pod_rows(samples), series, "epoch")
    levels = m.average_over(unique.where(F.col("kind") == "memory"), series).withColumnRenamed("average", "hourly")
    grown = m.counter_increase(unique.where(F.col("kind") != "memory"), series)
    grown = grown.withColumn("hourly", F.when(F.col("kind") == "cpu", F.col("rate")).otherwise(F.col("increase")))
    hourly = levels.unionByName(grown.select(*levels.columns))
    day = m.floor_epoch("window_start", 86400).alias("day_start")
    by_pod = hourly.groupBy("kind", *POD_LABELS, day).agg(F.sum("hourly").alias("value"))
    # Network use counts only for pods that have an interface of their own.
    own = off_host.groupBy("pod", "day_start").agg(F.map_from_entries(F.collect_list(F.struct("namespace", "value"))).alias("_own"))
    weight = F.coalesce(F.try_element_at("_own", F.col("namespace")), F.try_element_at("_own", F.lit("")))
    network = F.col("kind").startswith("network")
    weighted = join_totals(by_pod, own, ["pod", "day_start"]).withColumn("_weight", F.when(network, weight).otherwise(F.lit(1.0)))
    counted = weighted.where(F.col("_weight").isNotNull()).withColumn("value", F.col("value") * F.col("_weight")).select(*by_pod.columns)
    return m.match_named(counted, apps, ["pod", "day_start"], "namespace", ["app"])


def pod_reservations(samples: DataFrame) -> DataFrame:
    """Requested CPU and memory per pod and day, in hours: minute averages summed and divided by 60."""
    rows = samples.where(F.col("metric") == "kube_pod_container_resource_requests").select(
        _label("namespace").alias("namespace"),
        _label("pod").alias("pod"),
        _label("resource").alias("resource"),
        _series_id().alias("series"),
        "epoch",
        "value",
    )
    series = ["namespace", "pod", "resource", "series"]
    minutes = m.average_over(m.drop_repeated_samples(rows, series, "epoch"), series, 60)
    daily = m.sum_by_day(minutes, series, "average", 1.0 / 60.0)

    def of(resource: str, column: str) -> Column:
        return F.sum(F.when(F.col("resource") == resource, F.col(column)))

    return daily.groupBy("namespace", "pod", "day_start").agg(
        F.coalesce(of("cpu", "value"), F.lit(0.0)).alias("reserved_cpu"),
        F.coalesce(of("memory", "value"), F.lit(0.0)).alias("reserved_mem"),
    )


def pod_daily_usage(samples: DataFrame, usage_account: str) -> DataFrame:
    """Pod x day: CPU core-hours, memory byte-hours, network bytes in and out, and reservations.

    ``samples``: metric, labels (map), epoch (seconds), value.
    """
    stacked = _daily_pod_metrics(samples, pod_apps(samples), pods_off_host_network(samples))

    def of(kind: str, alias: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("value"))), F.lit(0.0)).alias(alias)

    actual = stacked.groupBy(*POD_LABELS, "app", "day_start").agg(
        of("cpu", "actual_cpu"), of("memory", "actual_mem"), of("network_in", "network_in"), of("network_out", "network_out")
    )
    both = actual.join(pod_reservations(samples), ["namespace", "pod", "day_start"], "left")
    day = F.to_date(F.timestamp_seconds("day_start"))
    instance = text.node_id("nodeid", *NODE_DRIVERS)
    return both.select(
        F.year(day).cast("string").alias("year"),
        F.month(day).cast("string").alias("month"),
        day.alias("date"),
        F.lit(usage_account).alias("usage_account"),
        "region",
        instance.alias("instance"),
        F.col("cluster").alias("eks_cluster_name"),
        F.col("namespace").alias("eks_namespace"),
        F.col("app").alias("eks_app"),
        F.col("pod").alias("eks_pod"),
        text.workload_id(instance, "cluster", "namespace", "pod").alias("resource_id"),
        "actual_cpu",
        "actual_mem",
        "network_in",
        "network_out",
        "reserved_cpu",
        "reserved_mem",
    )


def daily_query_results(results: DataFrame, series: Sequence[str], year: int, month: int) -> DataFrame:
    """Daily query results shifted to their usage day: boundary repeats removed, summed, counted, one month kept.

    ``results``: series columns, ts (timestamp at the end of the usage day), value.
    """
    unique = m.drop_repeated_samples(results, series, "ts").withColumn("date", usage_day("ts"))
    kept = unique.where((F.year("date") == year) & (F.month("date") == month))
    return kept.groupBy(*series, "date").agg(F.sum("value").alias("value"), F.count("value").alias("samples"))


def ingress_daily_requests(samples: DataFrame, usage_account: str) -> DataFrame:
    """Ingress x day request totals with the application label of the ingress."""
    rows = samples.where(F.col("metric") == "nginx_ingress_controller_requests").select(
        _label("region").alias("region"),
        _label("cluster_name").alias("cluster"),
        _label("namespace").alias("namespace"),
        _label("ingress").alias("ingress"),
        _series_id().alias("series"),
        "epoch",
        "value",
    )
    keys = ["region", "cluster", "namespace", "ingress"]
    series = [*keys, "series"]
    hourly = m.counter_increase(m.drop_repeated_samples(rows, series, "epoch"), series)
    daily = m.sum_by_day(hourly, series, "increase")
    totals = daily.groupBy(*keys, "day_start").agg(F.sum("value").alias("value"), F.count("value").alias("requests_sample"))
    labels = (
        samples.where(F.col("metric") == "kube_ingress_labels")
        .select(
            _label("namespace").alias("namespace"),
            _label("ingress").alias("ingress"),
            text.first_label("labels", *APP_LABELS).alias("app"),
            "value",
            m.floor_epoch("epoch", 86400).alias("day_start"),
        )
        .groupBy("namespace", "ingress", "app", "day_start")
        .agg(F.avg("value").alias("value"))
    )
    matched = m.match_named(totals, labels, ["ingress", "day_start"], "namespace", ["app"])
    day = F.to_date(F.timestamp_seconds("day_start"))
    return matched.select(
        F.year(day).cast("string").alias("year"),
        F.month(day).cast("string").alias("month"),
        day.alias("date"),
        F.lit(usage_account).alias("usage_account"),
        "region",
        F.col("cluster").alias("eks_cluster_name"),
        F.col("namespace").alias("eks_namespace"),
        F.col("app").alias("eks_app"),
        text.ingress_id("cluster", "namespace", "ingress").alias("resource_id"),
        F.col("value").alias("requests"),
        "requests_sample",
    )


_CONTAINER = {
    "actual_cpu": "pod_cpu_usage_total",
    "reserved_cpu": "pod_cpu_request",
    "actual_mem": "pod_memory_working_set",
    "reserved_mem": "pod_memory_request",
}


def container_hourly_usage(logs: DataFrame) -> DataFrame:
    """Container-log records per hour and workload: first and last time, counts and sums of four measures."""
    keyed = logs.where(F.coalesce(F.length("pod_name") > 0, F.lit(False))).select(
        F.date_trunc("hour", F.col("ts")).alias("date"),
        text.workload_id("instance", "eks_cluster_name", "eks_namespace", "pod_name").alias("resource_id"),
        "project",
        "eks_cluster_name",
        "eks_namespace",
        "eks_app",
        "instance",
        "ts",
        *_CONTAINER.values(),
    )
    keys = ["date", "resource_id", "project", "eks_cluster_name", "eks_namespace", "eks_app", "instance"]
    measures = []
    for name, column in _CONTAINER.items():
        measures += [F.count(column).alias(f"{name}_cnt"), F.sum(column).alias(name)]
    return keyed.groupBy(*keys).agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time"), *measures)


def db_io_hourly(samples: DataFrame) -> DataFrame:
    """Database x hour: read and write rates side by side and the operation count they amount to."""
    hour = F.date_trunc("hour", F.col("ts"))

    def of(metric: str) -> Column:
        return F.sum(F.when(F.col("metric") == metric, F.col("value")))

    return (
        samples.where(F.col("metric").isin("ReadIOPS", "WriteIOPS"))
        .groupBy(hour.alias("usage_date"), "region", "usage_account", F.col("db_id"))
        .agg(of("ReadIOPS").alias("read_iops"), of("WriteIOPS").alias("write_iops"))
        .withColumn("io_cnt", (F.col("read_iops") + F.col("write_iops")) * F.lit(3600.0))
    )


# Fixed values of the daily extract: metric, namespaces, statistic and period.
EXTRACT_METRIC, EXTRACT_STATISTICS, EXTRACT_PERIOD = "CPUUtilization", ("Average",), 300
EXTRACT_NAMESPACES = ("AWS/EC2", "AWS/RDS", "AWS/ElastiCache")


def metric_daily_extract(samples: DataFrame, day_start: int, inclusive_end: bool = False) -> DataFrame:
    """One day of CPU samples, half-open so that midnight belongs to one day only."""
    return m.filter_samples(
        samples, EXTRACT_NAMESPACES, EXTRACT_STATISTICS, EXTRACT_PERIOD, day_start, day_start + 86400, EXTRACT_METRIC,
        inclusive_end,
    ).select("namespace", "metric_name", "dimensions", "period", "timestamp", "value", "statistic")


def named_metrics(samples: DataFrame, cur: DataFrame, namespace: str = "AWS/EC2", dimension: str = "InstanceId") -> DataFrame:
    """Samples with the resource name known from billing.

    Billing resources without samples would only add rows the dimension test removes again, so this is an inner join.
    """
    names = cur.groupBy(F.col("line_item_resource_id").alias("resource_id")).agg(F.max("resource_tags_user_name").alias("resource_name"))
    points = (
        samples.where(F.col("namespace") == namespace)
        .select("region", "namespace", "metric_name", "timestamp", "value", F.explode("dimensions").alias("d"))
        .where(F.col("d.dim_name") == dimension)
        .withColumn("resource_id", F.col("d.dim_value"))
    )
    return join_totals(points, names, ["resource_id"], "inner").select(
        "region",
        "resource_name",
        "resource_id",
        "namespace",
        "metric_name",
        F.timestamp_seconds("timestamp").alias("time"),
        F.col("value").alias("metric_value"),
    )
