"""Notification feed: routing, quiet hours, volume suppression, message text, receivers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.timefns import in_quiet_window
from skyledger.operators.keyed import join_totals


def alarm_route(daytime_only: Sequence[str] = ()) -> Column:
    """Formatter for an alarm: listed alarms only in the day window, then by object type, else none."""
    name, kind = F.col("alarm_name"), F.col("object_type")
    routes = F.when(kind == "CloudFront", F.lit("cdn"))
    if daytime_only:
        listed = name.isin(*daytime_only)
        routes = F.when(listed & in_quiet_window("time"), F.lit("cdn")).when(listed, F.lit("none")).when(
            kind == "CloudFront", F.lit("cdn")
        )
    return (
        routes.when(name.startswith("ElasticSearch-"), F.lit("search"))
        .when(name.startswith("RDS-"), F.lit("database"))
        .when(kind == "EC2", F.lit("instance"))
        .otherwise(F.lit("none"))
    )


def health_route() -> Column:
    return F.when(F.col("service") == "EC2", F.lit("maintenance")).otherwise(F.lit("general"))


@dataclass(frozen=True)
class Template:
    """One message: which alarms it is for and its varying parts (``{reason}``, ``{value}`` are filled in)."""

    route: str
    fragment: str
    event: str
    detail: str = ""
    alarm_only: bool = True


# Resource label, subject and wording per route. A later match of a route replaces an earlier one.
RESOURCE_LABEL = {"database": "RDS实例", "instance": "EC2实例", "search": "ElasticSearch集群"}
SUBJECT = {
    "database": "【AWS通知】RDS 告警",
    "instance": "【AWS通知】EC2告警",
    "search": "【AWS通知】ElasticSearch告警",
    "cdn": "【AWS通知】CloudFront告警",
    "maintenance": "【AWS通知】健康事件通知",
    "compliance": "【AWS通知】IAM合规性事件通知",
}
TEMPLATES = [
    Template("database", "High-CPUUtilization-Alarm", "CPU利用率过高", "{reason}", False),
    Template("database", "High-SwapUsage-Alarm", "交换分区使用量上涨，表示内存可能不足", "{reason}", False),
    Template("database", "Low-EBSIOBalance-Alarm", "EBS IO 积分不足", "{reason}", False),
    Template(
        "database",
        "High-IOPS-Alarm",
        "IOPS超出阈值，对于gp2存储，请考虑增加其容量，对于io1存储，请考虑增大预置IOPS",
        "{reason}",
        False,
    ),
    Template("database", "High-Throughput-Alarm", "IO吞吐量超出阈值，请考虑使用吞吐量更大的存储", "{reason}", False),
    Template("instance", "High-CPUUtilization-Alarm", "CPU使用率过高", "{reason}"),
    Template(
        "instance",
        "Failed-SystemStatusCheck-Alarm",
        "系统健康检查失败（底层硬件故障）",
        "将启动自动恢复流程，实例将被停止并在健康的宿主机上重启。如果该实例上的应用在系统启动时不会自动启动，则你需要登录到系统中手动完成。",
    ),
    Template("instance", "Failed-InstanceStatusCheck-Alarm", "实例健康检查失败（操作系统故障）"),
    Template("search", "ClusterStatus.red-Alarm", "状态变为红色", "存在一到多个主分片其及副本无法分配给节点。"),
    Template("search", "ClusterStatus.yellow-Alarm", "状态变为黄色", "存在一到多个副本无法分配给节点。"),
    Template("search", "Low-FreeStorageSpace-Alarm", "可用存储空间不足", "{reason}"),
    Template("search", "ClusterIndexWritesBlocked-Alarm", "无法写入请求"),
    Template("search", "Low-Nodes-Alarm", "健康节点数不足", "当前仅有{value}个节点"),
    Template("search", "AutomatedSnapshotFailure-Alarm", "自动快照失败"),
    Template("search", "CPUUtilization-Alarm", "CPU使用率过高", "{reason}"),
    Template("search", "JVMMemoryPressure-Alarm", "JVM内存利用率过高", "{reason}"),
    Template("search", "KMSKeyError-Alarm", "KMS加密密钥已禁用", "重新启用它可恢复正常操作。"),
    Template(
        "search",
        "KMSKeyInaccessible",
        "KMS加密密钥已被删除或已撤销其对Amazon ES的授权",
        "您无法恢复处于此状态的域，但如果您有一个手动快照，则可以用它来迁移至新的域。",
    ),
]
# Earlier request counts at or below this stay silent.
QUIET_REQUESTS = 20000


def _fill(pattern: str) -> Column:
    """Text with {placeholders} as a concatenation of literals and columns."""
    pieces, rest = [], pattern
    while "{" in rest:
        before, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        if before:
            pieces.append(F.lit(before))
        pieces.append(F.coalesce(F.col(name).cast("string"), F.lit("")))
    if rest:
        pieces.append(F.lit(rest))
    return F.concat(*pieces) if pieces else F.lit("")


def _body(label: str, event: str, detail: str) -> Column:
    lines = ["时间: {timestamp}", "AWS帐号：{account}", "AWS区域：{region}", f"资源类型：{label}", "资源名称：{resource_name}"]
    lines.append(f"事件：{event}")
    if detail:
        lines.append(f"详情：{detail.replace('{value}', '{alarm_value}')}")
    return _fill("\n".join(lines) + "\n")


def alarm_message() -> Column:
    """Text for database, instance and search alarms; NULL means no notice."""
    chain = None
    for t in reversed(TEMPLATES):
        test = (F.col("route") == t.route) & F.col("alarm_name").contains(t.fragment)
        if t.alarm_only:
            test = test & (F.col("current_state") == "ALARM")
        text = _body(RESOURCE_LABEL[t.route], t.event, t.detail)
        chain = F.when(test, text) if chain is None else chain.when(test, text)
    return chain


def cdn_message(customer: str = "") -> Column:
    """Text for delivery alarms, with the earlier-period request counts; needs the alarm context columns."""
    head = f"【AWS】 {{resource_name}} 【AWS-CDN+】[{customer}-客户告警]域名：[{{resource_name}}]，"
    name = F.col("alarm_name")
    mbps = (
        F.col("bytes_downloaded") * (F.lit(100.0) - F.col("hit_rate")) * 8 / 300 / 100 / 1000 / 1000
    ).cast("long").cast("string")
    percent = F.try_divide(F.col("last_requests") * 100.0, F.col("before_last_requests")).cast("long").cast("string")
    now = F.concat(_fill(head), F.lit("发生了"))
    at = _fill("。最近一次告警时间：{timestamp}")
    back = _fill("。告警恢复时间：{timestamp}")
    raised = (
        F.when(
            name.contains("OriginBandwidth-Alarm"),
            F.concat(now, _fill("回源带宽告警 当前值：域名全网请求数（次）={last_requests}，域名全网回源带宽（Mbps）="), mbps, at),
        )
        .when(name.contains("Requests-Alarm"), F.concat(now, _fill("请求数告警 当前值：域名全网请求数（次）={last_requests}"), at))
        .when(
            name.contains("ErrorRate-Alarm") & (F.col("last_requests") > QUIET_REQUESTS),
            F.concat(
                now, _fill("5xx状态码告警 当前值：域名全网请求数（次）={last_requests},域名全网5xx占比（百分比）={error_rate}%"), at
            ),
        )
        .when(
            name.contains("Low-RequestsChangeRate-Alarm") & (F.col("before_last_requests") > QUIET_REQUESTS),
            F.concat(
                now, _fill("请求次数突降告警 当前值：域名全网请求数（次）={last_requests}, 为上一周期域名全网请求数的"), percent, F.lit("%"), at
            ),
        )
    )
    recovered = (
        F.when(
            name.contains("OriginBandwidth-Alarm"),
            F.concat(
                _fill(head), _fill("回源带宽告警恢复 当前值：域名全网请求数（次）={last_requests}，域名全网回源带宽（Mbps）="), mbps, back
            ),
        )
        .when(
            name.contains("Requests-Alarm"),
            F.concat(_fill(head), _fill("请求数告警恢复 当前值：域名全网请求数（次）={last_requests}"), back),
        )
        .when(
            name.contains("ErrorRate-Alarm"),
            F.concat(
                _fill(head),
                _fill("5xx状态码告警恢复 当前值：域名全网请求数（次）={last_requests},域名全网5xx占比（百分比）={error_rate}%"),
                back,
            ),
        )
    )
    on = F.col("current_state") == "ALARM"
    off = (F.col("current_state") == "OK") & (F.col("previous_state") == "ALARM")
    return F.when(on, raised).when(off, recovered)


# Maintenance wording per event type.
MAINTENANCE = {
    "AWS_EC2_INSTANCE_REBOOT_FLEXIBLE_MAINTENANCE_SCHEDULED": (
        "EC2维护重启",
        "EC2实例在维护期间将会不可用并自动重启。如果该实例不带实例存储，你可以在{timestamp}之前手动进行Stop/Start操作，该操作将会使得实例被迁移到健康主机上。"
        "如果该实例带实例存储，Stop/Start操作将使得实例存储中的数据丢失，请谨慎操作。",
    ),
    "AWS_EC2_PERSISTENT_INSTANCE_RETIREMENT_SCHEDULED": (
        "EC2主机退服",
        "退服后EC2实例将进入Stop状态。如果该实例不带实例存储，你可以在{timestamp}之前手动进行Stop/Start操作，该操作将会使得实例被迁移到健康主机上。"
        "如果该实例带实例存储，退役后或Stop/Start操作均将使得实例存储中的数据丢失，请及时备份。",
    ),
}
EVENT_LINK = "通过以下链接可查看事件列表和修改维护窗口 https://{region}.console.aws.amazon.com/ec2/v2/home?region={region}#Events: "


def health_message() -> Column:
    """Maintenance text by event type; any other event is sent whole, as JSON."""
    chain = None
    for code, (event, detail) in MAINTENANCE.items():
        test = (F.col("route") == "maintenance") & F.col("event_type_code").contains(code)
        text = _body("EC2实例", event, detail + EVENT_LINK)
        chain = F.when(test, text) if chain is None else chain.when(test, text)
    whole = F.to_json(F.struct("account", "region", "service", "event_type_code", "event_type_category", "timestamp", "description"))
    return chain.otherwise(whole)


def compliance_message(rule: str = "IamUserConfigRule") -> Column:
    link = "https://console.aws.amazon.com/config/home?region={region}#/rules/details?configRuleName={rule_name}"
    lines = [
        "时间: {timestamp}", "AWS帐号：{account}", "AWS区域：{region}", "资源类型：IAM用户", "事件：{annotation}",
        "详情：{annotation} 点击以下链接查看不合规资源：" + link,
    ]
    return F.when(F.col("rule_name").contains(rule), _fill("\n".join(lines) + "\n"))


def fill_template(pattern: str, paths: dict[str, Column]) -> Column:
    """``<name>`` placeholders replaced by the mapped columns (missing ones by nothing)."""
    pieces, rest = [], pattern
    while "<" in rest and ">" in rest[rest.index("<") :]:
        before, _, tail = rest.partition("<")
        name, _, after = tail.partition(">")
        pieces.append(F.lit(before))
        pieces.append(F.coalesce(paths[name].cast("string"), F.lit("")) if name in paths else F.lit(f"<{name}>"))
        rest = after
    pieces.append(F.lit(rest))
    return F.concat(*pieces)


def addressed(df: DataFrame, default_receiver: str = "all") -> DataFrame:
    """Rows with a message, their subject by route and a default receiver."""
    subject = F.lit("")
    for route, s in SUBJECT.items():
        subject = F.when(F.col("route") == route, F.lit(s)).otherwise(subject)
    receiver = F.coalesce("receiver", F.lit(default_receiver)) if "receiver" in df.columns else F.lit(default_receiver)
    return df.where(F.col("message").isNotNull()).withColumn("subject", subject).withColumn("receiver", receiver)


def notification_feed(
    alarms: DataFrame,
    inventory: DataFrame,
    context: DataFrame,
    daytime_only: Sequence[str] = (),
    customer: str = "",
    receiver: str = "all",
) -> DataFrame:
    """Route, quiet hours, names, context, text; rows without text are dropped.

    ``alarms``: flattened alarm events plus resource_id; ``inventory``: resource_id, name, private_ip; ``context``:
    resource_id with requests, last_requests, before_last_requests, error_rate, hit_rate, bytes_downloaded.
    """
    routed = alarms.withColumn("route", alarm_route(daytime_only)).where(F.col("route") != "none")
    named = join_totals(routed, inventory.select("resource_id", "name", "private_ip"), ["resource_id"])
    label = F.when(
        F.col("route") == "instance",
        F.concat(
            F.coalesce("name", F.lit("-")), F.lit(" ("), F.col("resource_id"), F.lit(", "),
            F.coalesce("private_ip", F.lit("None")), F.lit(")"),
        ),
    ).when(F.col("route") == "cdn", F.coalesce("name", "resource_id")).otherwise(F.col("resource_id"))
    full = join_totals(named.withColumn("resource_name", label), context, ["resource_id"])
    for c in ("last_requests", "before_last_requests", "error_rate", "hit_rate", "bytes_downloaded"):
        full = full.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    text = F.when(F.col("route") == "cdn", cdn_message(customer)).otherwise(alarm_message())
    return addressed(full.withColumn("message", text), receiver)


def quota_message(customer: str = "") -> Column:
    """Text per region over quota."""
    return _fill(
        f"【AWS】 lambda-threshold 【AWS-CDN+】[{customer}-客户告警]，Lambda@Edge调用次数超出阈值。详情如下: "
        "区域: {region}, 配额: {quota}/s, 过去3个小时最大峰值: {estimated_rps}/s; "
    )
