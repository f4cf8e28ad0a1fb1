"""Standardised cost, classification, dashboards, control totals and unit cost."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import billing
from skyledger.functions.numbers import ratio
from skyledger.operators.keyed import blank_strings

DIMENSIONS = [
    "year", "month", "date", "charge_type", "payer_account", "usage_account", "billing_entity", "service",
    "product", "region", "location", "instance_type", "instance_family", "database_engine", "volume_type",
    "usage_type", "description", "resource_id", "emr_job_flow_id", "eks_cluster_name", "project", "name",
]
MEASURES = [
    "usage_amount", "vcpus", "gpus", "memory_gb", "ondemand_cost", "amortized_cost", "net_amortized_cost",
    "billing_cost",
]
COSTS = ["ondemand_cost", "amortized_cost", "net_amortized_cost", "billing_cost"]

# Output name -> billing column, for dimensions that are taken over unchanged.
_RENAMED = {
    "charge_type": "line_item_line_item_type",
    "payer_account": "bill_payer_account_id",
    "usage_account": "line_item_usage_account_id",
    "region": "product_region",
    "location": "product_location",
    "instance_type": "product_instance_type",
    "database_engine": "product_database_engine",
    "volume_type": "product_volume_type",
    "usage_type": "line_item_usage_type",
    "description": "line_item_line_item_description",
    "resource_id": "line_item_resource_id",
}
_MONTHLY_TAGS = {
    "emr_job_flow_id": "resource_tags_aws_elasticmapreduce_job_flow_id",
    "eks_cluster_name": "resource_tags_aws_eks_cluster_name",
    "project": "resource_tags_user_project",
    "name": "resource_tags_user_name",
}
_SPLIT_TAGS = {
    "eks_cluster_name": "resource_tags_aws_eks_cluster_name",
    "eks_namespace": "resource_tags_aws_eks_namespace",
    "eks_deployment": "resource_tags_aws_eks_deployment",
    "eks_node": "resource_tags_aws_eks_node",
    "emr_job_flow_id": "resource_tags_aws_elasticmapreduce_job_flow_id",
    "project": "resource_tags_user_project",
}
# Dimensions the plain dashboard carries as a constant marker.
_MARKED = {
    "dashboard": [
        "eks_cluster_name", "eks_namespace", "eks_workload_name", "eks_workload_type", "emr_job_flow_id", "project",
    ],
    "dashboard_first": ["project"],
}


def _line_items(cur: DataFrame, profile: billing.Profile, exact: bool) -> DataFrame:
    columns: dict[str, Column] = {
        "year": F.col("year"),
        "month": F.col("month"),
        "date": F.to_date("line_item_usage_start_date"),
        "billing_entity": billing.billing_entity(),
        "service": billing.service_name(profile),
        "product": billing.product_name(profile),
        "instance_family": billing.instance_family(pattern=profile.family),
    }
    columns.update({name: F.col(source) for name, source in _RENAMED.items()})
    if profile.name == "monthly":
        columns.update({name: F.col(source) for name, source in _MONTHLY_TAGS.items()})
    elif profile.split_lines:
        columns.update({name: F.col(source) for name, source in _SPLIT_TAGS.items()})
    else:
        columns.update({name: F.lit("na") for name in _MARKED[profile.name]})
    klass = F.col("_class")
    measures = {
        "usage_amount": billing.usage_amount(profile),
        "vcpus": billing.vcpu_hours(profile, exact),
        "memory_gb": billing.memory_hours(profile, exact),
        "ondemand_cost": billing.ondemand_cost(klass, profile),
        "amortized_cost": billing.amortized_cost(klass, profile),
        "net_amortized_cost": billing.net_amortized_cost(klass, profile),
        "billing_cost": F.col("line_item_unblended_cost"),
    }
    if profile.with_gpu:
        measures["gpus"] = billing.gpu_hours(profile, exact)
    classed = cur.withColumn("_class", billing.charge_class(profile))
    return classed.select(
        *[c.alias(n) for n, c in columns.items()], *[c.cast("double").alias(n) for n, c in measures.items()]
    )


def _totals(lines: DataFrame) -> DataFrame:
    dims = [c for c in lines.columns if c not in MEASURES]
    sums = [F.sum(m).alias(m) for m in MEASURES if m in lines.columns]
    return blank_strings(lines.groupBy(*dims).agg(*sums))


def standardize(cur: DataFrame, year: str | int, month: str | int, exact: bool = True) -> DataFrame:
    """One month of billing lines as 22 dimensions and 8 measures.

    ``year`` and ``month`` are string partition columns with an un-padded month, so both predicates prune.
    """
    one_month = cur.where((F.col("year") == str(int(year))) & (F.col("month") == str(int(month))))
    return _totals(_line_items(one_month, billing.MONTHLY, exact)).select(*DIMENSIONS, *MEASURES)


def standardize_all(cur: DataFrame, exact: bool = True, place: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Every partition at once (year and month stay dimensions).

    ``place`` moves the lines by some dimensions, or by columns it adds that follow from them; their sum then needs no other
    exchange, and such columns stay.
    """
    lines = _line_items(cur, billing.MONTHLY, exact)
    if place is None:
        return _totals(lines).select(*DIMENSIONS, *MEASURES)
    placed = place(lines)
    return _totals(placed).select(*DIMENSIONS, *MEASURES, *[c for c in placed.columns if c not in lines.columns])


def trailing_months(df: DataFrame, ts: str, months: int, as_of: date) -> DataFrame:
    """Rows from the first day of the month ``months`` before ``as_of``; prunes year/month partitions if present."""
    index = as_of.year * 12 + as_of.month - 1 - months
    start = date(index // 12, index % 12 + 1, 1)
    kept = F.col(ts) >= F.lit(start.isoformat()).cast("date")
    if {"year", "month"} <= set(df.columns):
        spans = F.col("year") > str(start.year)
        first = (F.col("year") == str(start.year)) & F.col("month").isin(*[str(m) for m in range(start.month, 13)])
        kept = kept & (spans | first)
    return df.where(kept)


def standardize_dashboard(
    cur: DataFrame, as_of: date, profile: str = "dashboard", months: int = 24, exact: bool = True
) -> DataFrame:
    """Trailing-months cost for dashboards; ``profile`` is dashboard, dashboard_split or dashboard_first."""
    recent = trailing_months(cur, "line_item_usage_start_date", months, as_of)
    return _totals(_line_items(recent, billing.PROFILES[profile], exact))


def look_back(df: DataFrame, day: str, as_of: date, days: int = 35) -> DataFrame:
    """Rows an incremental refresh recomputes: the last ``days`` days up to ``as_of``."""
    return df.where(F.col(day) >= F.date_sub(F.lit(as_of.isoformat()).cast("date"), days))


# Usage categories. Each entry is (service or None, needles that must all occur, label); within a
# block the first match wins, charge-type rules come first, then traffic rules, then the service's own block.
CHARGE_RULES = [
    ("SavingsPlanCovered", "SP/RI"),
    ("Discounted", "SP/RI"),
    ("RIFee", "未用RI"),
    ("SavingsPlanRecurring", "未用SP"),
]
TRAFFIC_RULES = [
    ("DataTransfer-Regional", "AWS区域内部流量"),
    ("AWS-Out", "AWS区域之间流量"),
    ("AWS-In", "AWS区域之间流量"),
    ("DataXfer-In", "专线->AWS流量"),
    ("DataXfer-Out", "AWS->专线流量"),
    ("DataTransfer-Out-Bytes", "AWS->互联网流量"),
    ("DataTransfer-In", "互联网->AWS流量"),
]
SERVICE_RULES = {
    "Amazon CloudFront": (
        [
            ("Requests-Tier", "客户端请求"),
            ("Requests-HTTP", "回源请求"),
            ("DataTransfer-Out-Bytes", "客户端流量"),
            ("DataTransfer-Out-OBytes", "回源流量"),
            ("CloudFrontFunctions", "边缘函数"),
            ("Lambda-Edge-Request", "L@E请求次数"),
            ("Lambda-Edge-GB-Second", "L@E资源"),
            ("SSL-Cert-Custom", "证书"),
            ("OriginShield", "源护盾"),
            ("Invalidations", "缓存失效API"),
        ],
        "其他CloudFront费用",
    ),
    "Elastic Load Balancing": ([("LCUUsage", "ELB处理能力"), ("LoadBalancerUsage", "ELB资源")], "其他ELB费用"),
    "Amazon Elastic Compute Cloud": (
        [
            ("BoxUsage", "按需实例"),
            ("SpotUsage", "Spot"),
            ("Snapshot", "EBS快照"),
            ("EBS&IO", "EBS卷IO"),
            ("EBS&Throughput", "EBS卷吞吐量"),
            ("EBSOptimized", "EBS卷专用带宽"),
            ("EBS", "EBS卷存储"),
            ("NatGateway", "NAT网关"),
        ],
        "其他EC2费用",
    ),
    "Amazon ElastiCache": ([("NodeUsage", "按需实例"), ("Backup", "备份")], "其他ElastiCache费用"),
    "Amazon Relational Database Service": (
        [
            ("StorageIO", "数据库存储IO"),
            ("Throughput", "数据库存储吞吐量"),
            ("IOPS", "数据库存储IO"),
            ("Storage", "数据库存储空间"),
            ("InstanceUsage", "按需实例"),
            ("Multi-AZUsage", "按需实例"),
            ("Mirror", "按需实例"),
            ("ProxyUsage", "数据库代理"),
            ("Backup", "备份"),
            ("ServerlessUsage", "Serverless数据库"),
        ],
        "其他RDS费用",
    ),
    "Amazon DynamoDB": (
        [
            ("TimedStorage", "存储空间"),
            ("RequestUnit", "按需请求"),
            ("CapacityUnit", "预置容量"),
            ("HeavyUsage", "预留容量"),
            ("Backup", "备份"),
            ("Restore", "恢复"),
        ],
        "其他DynamoDB费用",
    ),
    "Amazon Managed Streaming for Apache Kafka": (
        [("Kafka.Storage", "MSK存储"), ("Kafka", "按需实例")],
        "其他MSK费用",
    ),
    "Amazon OpenSearch Service": (
        [("Storage", "存储空间"), ("PIOPS", "存储IO"), ("ESInstance", "按需实例")],
        "其他ES/AOS费用",
    ),
    "Amazon Redshift": (
        [
            ("Node", "按需实例"),
            ("RMS", "存储空间"),
            ("DataScan", "Spectrum数据扫描"),
            ("CS", "并发扩容"),
            ("Snapshot", "备份"),
        ],
        "其他Redshift费用",
    ),
    "Amazon Simple Storage Service": (
        [("TimedStorage", "存储空间"), ("Requests-", "请求次数"), ("Retrieval-", "数据取回")],
        "其他S3费用",
    ),
    "Amazon Virtual Private Cloud": (
        [
            ("TransitGateway", "TGW"),
            ("VPN", "VPN"),
            ("PublicIPv4", "IPv4公网地址"),
            ("VpcEndpoint", "VPC Endpoint"),
        ],
        "其他VPC费用",
    ),
    "AWS Direct Connect": ([("PortUsage", "专线端口")], "其他DirectConnect费用"),
    "AmazonDMS": (
        [("Multi-AZUsg", "复制实例"), ("InstanceUsg", "复制实例"), ("Storage", "存储")],
        "其他DMS费用",
    ),
    "AmazonCloudWatch": (
        [
            ("MetricMonitorUsage", "指标存储"),
            ("-Metrics", "指标API请求"),
            ("Requests", "指标API请求"),
            ("AlarmMonitorUsage", "告警规则"),
            ("DashboardsUsageHour", "监控面板"),
            ("TimedStorage-ByteHrs", "日志存储"),
            ("DataProcessing-Bytes", "日志处理"),
            ("VendedLog", "AWS服务日志处理"),
            ("DataScan", "日志查询扫描"),
            ("S3-Egress", "日志导出到S3"),
        ],
        "其他CloudWatch费用",
    ),
    "Amazon GuardDuty": (
        [
            ("EKS", "EKS运行时系统监控"),
            ("KubernetesAuditLogs", "EKS审计日志分析"),
            ("Lambda", "Lambda网络日志分析"),
            ("PaidEventsAnalyzed-Bytes", "VPC流日志和DNS日志分析"),
            ("PaidEventsAnalyzed", "CloudTrail管理事件分析"),
            ("PaidS3DataEventsAnalyzed", "S3数据事件分析"),
        ],
        "其他Guardduty费用",
    ),
}
NO_CATEGORY = "其他"


def _first_match(column: str, rules: Sequence[tuple[str, str]], default: Column) -> Column:
    chain = None
    for needles, label in rules:
        hit = F.lit(True)
        for needle in needles.split("&"):
            hit = hit & F.col(column).contains(needle)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return chain.otherwise(default)


def usage_category() -> Column:
    """First matching category by charge type, then traffic, then the service's block."""
    by_service = None
    for service, (rules, other) in SERVICE_RULES.items():
        value = _first_match("usage_type", rules, F.lit(other))
        test = F.col("service") == service
        by_service = F.when(test, value) if by_service is None else by_service.when(test, value)
    by_service = by_service.otherwise(F.lit(NO_CATEGORY))
    return _first_match("charge_type", CHARGE_RULES, _first_match("usage_type", TRAFFIC_RULES, by_service))


def classify_usage(cost: DataFrame) -> DataFrame:
    """Adds ``usage_category`` and ``charge_category``; wide chains stay inside the projection (no join)."""
    return cost.withColumn("usage_category", usage_category()).withColumn(
        "charge_category", billing.charge_category()
    )


def pivot_dimension(cost: DataFrame, dimension: str, measure: str) -> DataFrame:
    """Total of one chosen measure by one chosen dimension."""
    return cost.groupBy(F.col(dimension).cast("string").alias("dimension_value")).agg(F.sum(measure).alias("total"))


def pivot_dimensions(cost: DataFrame, dimensions: Sequence[str], measure: str) -> DataFrame:
    """The same for several dimensions in one pass over the data: one aggregate with one grouping set each."""
    sets = [[F.col(d)] for d in dimensions]
    wide = cost.groupingSets(sets, *dimensions).agg(
        F.sum(measure).alias("total"), F.grouping_id(*dimensions).alias("_gid")
    )
    full = (1 << len(dimensions)) - 1
    name = value = None
    for i, d in enumerate(dimensions):
        hit = F.col("_gid") == (full ^ (1 << (len(dimensions) - 1 - i)))
        text = F.col(d).cast("string")
        name = F.when(hit, F.lit(d)) if name is None else name.when(hit, F.lit(d))
        value = F.when(hit, text) if value is None else value.when(hit, text)
    return wide.select(name.alias("dimension"), value.alias("dimension_value"), "total")


def control_totals(cost: DataFrame, flag: str | None = None) -> DataFrame:
    """Row count and measure sums, per flag class when given."""
    aggregates = [F.count(F.lit(1)).alias("rows")]
    aggregates += [F.sum(m).alias(m) for m in ("vcpus", "memory_gb", *COSTS) if m in cost.columns]
    return cost.groupBy(*([flag] if flag else [])).agg(*aggregates)


def conservation(before: DataFrame, after: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sum of every cost before and after a step, and the difference, per key: one aggregate over both sides."""

    def side(df: DataFrame, label: str) -> DataFrame:
        picked = [F.when(F.lit(label == s), F.col(c)).alias(f"{c}_{s}") for c in COSTS for s in ("before", "after")]
        return df.select(*keys, *picked)

    both = side(before, "before").unionByName(side(after, "after"))
    sums = [F.coalesce(F.sum(f"{c}_{s}"), F.lit(0.0)).alias(f"{c}_{s}") for c in COSTS for s in ("before", "after")]
    joined = both.groupBy(*keys).agg(*sums)
    for c in COSTS:
        joined = joined.withColumn(f"{c}_diff", F.col(f"{c}_after") - F.col(f"{c}_before"))
    return joined


def profile_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min and max per column, one row per column, in a single job."""
    aggregates = []
    for c in columns:
        x = F.col(c).cast("double")
        aggregates.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("count"),
                F.mean(x).alias("mean"),
                F.stddev(x).alias("stddev"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            ).alias(c)
        )
    one = df.agg(*aggregates)
    return one.select(F.inline(F.array(*[F.col(c) for c in columns])))


UNIT_KEYS = ["year", "month", "usage_account", "date", "region", "eks_app", "eks_cluster_name", "eks_namespace"]


def unit_cost(app_metrics: DataFrame, cost: DataFrame) -> DataFrame:
    """Requests per application and day with its cost, and cost per request (NULL without requests)."""
    apps = blank_strings(
        app_metrics.withColumn("date", F.to_date("date")).groupBy(*UNIT_KEYS).agg(F.sum("requests").alias("requests"))
    )
    costs = blank_strings(cost.groupBy(*UNIT_KEYS).agg(*[F.sum(c).alias(c) for c in COSTS]))
    joined = apps.join(costs, UNIT_KEYS, "left")
    for c in COSTS:
        joined = joined.withColumn(f"{c}_per_request", ratio(c, "requests"))
    return joined
