"""The alarm catalogue as data: one rule per alarm kind.

Thresholds are written as small specs:
``fixed(v)``; ``tag(key, default, factor)`` reads the resource's threshold tag; ``limit(name)`` is a capacity limit
computed per resource; ``defined(key, factor)`` comes from the definition table.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Threshold:
    kind: str
    key: str = ""
    value: float | None = None
    factor: float = 1.0


def fixed(value: float) -> Threshold:
    return Threshold("fixed", value=float(value))


def tag(key: str, default: float, factor: float = 1.0) -> Threshold:
    return Threshold("tag", key, float(default), float(factor))


def limit(name: str) -> Threshold:
    return Threshold("limit", name)


def defined(key: str, factor: float = 1.0) -> Threshold:
    return Threshold("defined", key, None, float(factor))


@dataclass(frozen=True)
class Rule:
    rule_id: str
    service: str
    name: str
    metrics: tuple[str, ...]
    expression: str
    statistic: str
    period: int
    datapoints: int
    periods: int
    comparison: str
    threshold: Threshold
    missing: str
    applies: str = ""
    note: str = ""
    per_vcpu: bool = False


MIB, GIB = 1024.0**2, 1024.0**3
ONE, PAIR_RATE, SUM2, SUM4 = "m1", "(m1+m2)/PERIOD", "m1+m2", "m1+m2+m3+m4"
GREATER, GREATER_RATE, STEP = "MAX(m1,m2)", "MAX(m1,m2)/PERIOD", "DIFF(m1)"

# The rules.
RULES: list[Rule] = [
    Rule("AC01", "ALB", "AWS/ALB-UnHealthyHostCount-{id}-{sub}", ("UnHealthyHostCount",), ONE, "Average", 60, 3, 3, ">=", tag("UnHealthyHostCount", 1), "missing"),
    Rule("AC02", "ALB", "AWS/ALB-TargetResponseTime-{id}-{sub}", ("TargetResponseTime",), ONE, "Average", 300, 1, 1, ">=", tag("TargetResponseTime", 0.1), "ignore"),
    Rule("AC03", "ALB", "AWS/ALB-HTTPCode_Target_5XX_Rate-{id}", ("HTTPCode_Target_5XX_Count", "RequestCount"), "m1/m2*100", "Sum", 60, 3, 3, ">=", tag("Target5XXRate", 1), "missing"),
    Rule("AC04", "EBS", "AWS/EBS-VolumeStalledIOCheck-{id}-{sub}", ("VolumeStalledIOCheck",), ONE, "Sum", 300, 3, 3, ">", fixed(0), "missing", "in_use"),
    Rule("AC05", "EBS", "AWS/EBS-IOPS-{id}", ("VolumeWriteOps", "VolumeReadOps"), PAIR_RATE, "Sum", 300, 3, 3, ">=", limit("volume_iops"), "ignore", "in_use"),
    Rule("AC06", "EBS", "AWS/EBS-Throughput-{id}", ("VolumeWriteBytes", "VolumeReadBytes"), PAIR_RATE, "Sum", 300, 3, 3, ">=", limit("volume_throughput"), "ignore", "in_use"),
    Rule("AC07", "EC2", "AWS/EC2-CPUUtilization-{id}", ("CPUUtilization",), ONE, "Average", 300, 3, 3, ">", tag("CPUUtilization", 80), "ignore"),
    Rule("AC08", "EC2", "AWS/EC2-StatusCheckFailed_System-{id}", ("StatusCheckFailed_System",), ONE, "Average", 60, 2, 2, ">", fixed(0), "missing"),
    Rule("AC09", "EC2", "AWS/EC2-StatusCheckFailed_Instance-{id}", ("StatusCheckFailed_Instance",), ONE, "Average", 60, 3, 3, ">", fixed(0), "missing"),
    Rule("AC10", "EC2", "AWS/EC2-StatusCheckFailed_AttachedEBS-{id}", ("StatusCheckFailed_AttachedEBS",), ONE, "Average", 60, 3, 3, ">", fixed(0), "missing"),
    Rule("AC11", "EC2", "AWS/EC2-CPUCreditBalance-{id}", ("CPUCreditBalance",), ONE, "Average", 300, 1, 1, "<", limit("cpu_credit_30"), "ignore", "burstable"),
    Rule("AC12", "EC2", "AWS/EC2-EBSIOPS-{id}", ("EBSReadOps", "EBSWriteOps"), PAIR_RATE, "Sum", 300, 1, 1, ">=", limit("instance_iops"), "ignore"),
    Rule("AC13", "EC2", "AWS/EC2-EBSThroughput-{id}", ("EBSReadBytes", "EBSWriteBytes"), PAIR_RATE, "Sum", 300, 1, 1, ">=", limit("instance_throughput"), "ignore"),
    Rule("AC14", "EC2", "AWS/EC2-NetworkBandwidth-{id}", ("NetworkIn", "NetworkOut"), GREATER_RATE, "Sum", 300, 1, 1, ">=", limit("instance_network"), "ignore"),
    Rule("AC15", "ES", "AWS/ES-ClusterStatus.red-{id}", ("ClusterStatus.red",), ONE, "Average", 60, 1, 1, ">", fixed(0), "missing"),
    Rule("AC16", "ES", "AWS/ES-ClusterStatus.yellow-{id}", ("ClusterStatus.yellow",), ONE, "Average", 60, 5, 5, ">", fixed(0), "ignore"),
    Rule("AC17", "ES", "AWS/ES-ClusterIndexWritesBlocked-{id}", ("ClusterIndexWritesBlocked",), ONE, "Average", 300, 1, 1, ">", fixed(0), "ignore"),
    Rule("AC18", "ES", "AWS/ES-FreeStorageSpace-{id}", ("FreeStorageSpace",), ONE, "Minimum", 60, 1, 1, "<=", tag("FreeStorageSpace", 20, 1024), "ignore"),
    Rule("AC19", "ES", "AWS/ES-Nodes-{id}", ("Nodes",), ONE, "Minimum", 86400, 1, 1, "<", limit("search_nodes"), "ignore"),
    Rule("AC20", "ES", "AWS/ES-AutomatedSnapshotFailure-{id}", ("AutomatedSnapshotFailure",), ONE, "Minimum", 60, 1, 1, ">", fixed(0), "ignore"),
    Rule("AC21", "ES", "AWS/ES-CPUUtilization-{id}", ("CPUUtilization",), ONE, "Maximum", 300, 3, 3, ">=", tag("CPUUtilization", 80), "ignore"),
    Rule("AC22", "ES", "AWS/ES-CPUCreditBalance-{id}", ("CPUCreditBalance",), ONE, "Minimum", 300, 1, 1, "<", limit("cpu_credit_30"), "ignore", "burstable"),
    Rule("AC23", "ES", "AWS/ES-JVMMemoryPressure-{id}", ("JVMMemoryPressure",), ONE, "Maximum", 60, 3, 3, ">=", tag("JVMMemoryPressure", 95), "ignore", note="documented default is 20"),
    Rule("AC24", "ES", "AWS/ES-KMSKeyError-{id}", ("KMSKeyError",), ONE, "Average", 60, 1, 1, ">", fixed(0), "ignore"),
    Rule("AC25", "ES", "AWS/ES-KMSKeyInaccessible-{id}", ("KMSKeyInaccessible",), ONE, "Average", 60, 1, 1, ">", fixed(0), "ignore"),
    Rule("AC26", "ES", "AWS/ES-IOPS-{id}", ("ReadIOPS", "WriteIOPS"), SUM2, "Maximum", 300, 3, 3, ">=", limit("search_iops"), "ignore"),
    Rule("AC27", "ES", "AWS/ES-Throughput-{id}", ("ReadThroughput", "WriteThroughput"), SUM2, "Maximum", 300, 3, 3, ">=", limit("search_throughput"), "ignore"),
    Rule("AC28", "ES", "AWS/ES-ActiveShards-{id}", ("Shards.active",), ONE, "Maximum", 60, 1, 1, ">=", tag("ActiveShards", 30000), "ignore"),
    Rule("AC29", "ES", "AWS/ES-MasterReachableFromNode-{id}", ("MasterReachableFromNode",), ONE, "Maximum", 86400, 1, 1, "<", fixed(1), "missing"),
    Rule("AC30", "ES", "AWS/ES-ThreadpoolWriteQueue-{id}", ("ThreadpoolWriteQueue",), ONE, "Average", 60, 1, 1, ">=", tag("ThreadpoolWriteQueue", 100), "ignore"),
    Rule("AC31", "ES", "AWS/ES-AvgThreadpoolSearchQueue-{id}", ("ThreadpoolSearchQueue",), ONE, "Average", 60, 1, 1, ">=", tag("AvgThreadpoolSearchQueue", 500), "ignore"),
    Rule("AC32", "ES", "AWS/ES-MaxThreadpoolSearchQueue-{id}", ("ThreadpoolSearchQueue",), ONE, "Maximum", 60, 1, 1, ">=", tag("MaxThreadpoolSearchQueue", 5000), "ignore"),
    Rule("AC33", "ES", "AWS/ES-ThreadpoolSearchRejected-{id}", ("ThreadpoolSearchRejected",), STEP, "Sum", 300, 3, 3, ">=", fixed(1), "ignore"),
    Rule("AC34", "ES", "AWS/ES-ThreadpoolWriteRejected-{id}", ("ThreadpoolWriteRejected",), STEP, "Sum", 300, 3, 3, ">=", fixed(1), "ignore"),
    Rule("AC35", "ES", "AWS/ES-5xxRate-{id}", ("5xx", "OpenSearchRequests", "ElasticsearchRequests"), "m1/(m2+m3)*100", "Sum", 60, 3, 3, ">=", tag("5xxRate", 10), "missing"),
    Rule("AC36", "IPAM", "AWS/IPAM-SubnetIPUsage-{sub}-{id}", ("SubnetIPUsage",), ONE, "Average", 86400, 1, 1, ">=", limit("subnet_use"), "missing", "subnet"),
    Rule("AC37", "Kafka", "AWS/Kafka-CPUUtilization-{id}-{sub}", ("CpuSystem", "CpuUser"), SUM2, "Average", 300, 3, 3, ">=", tag("CPUUtilization", 60), "missing"),
    Rule("AC38", "Kafka", "AWS/Kafka-CPUCreditBalance-{id}-{sub}", ("CPUCreditBalance",), ONE, "Average", 300, 1, 1, "<", limit("cpu_credit_30"), "ignore", "burstable"),
    Rule("AC39", "Kafka", "AWS/Kafka-KafkaDataLogsDiskUsed-{id}-{sub}", ("KafkaDataLogsDiskUsed",), ONE, "Average", 300, 1, 1, ">=", tag("KafkaDataLogsDiskUsed", 85), "ignore"),
    Rule("AC40", "Kafka", "AWS/Kafka-HeapMemoryAfterGC-{id}-{sub}", ("HeapMemoryAfterGC",), ONE, "Average", 300, 1, 1, ">=", tag("HeapMemoryAfterGC", 60), "ignore"),
    Rule("AC41", "Kafka", "AWS/Kafka-IOPS-{id}-{sub}", ("VolumeWriteOps", "VolumeReadOps"), PAIR_RATE, "Sum", 300, 3, 3, ">=", limit("broker_iops"), "ignore", "per_broker"),
    Rule("AC42", "Kafka", "AWS/Kafka-Thrughput-{id}-{sub}", ("VolumeWriteBytes", "VolumeReadBytes"), PAIR_RATE, "Sum", 300, 3, 3, ">=", limit("broker_throughput"), "ignore", "per_broker", "name spelt as deployed"),
    Rule("AC43", "Kafka", "AWS/Kafka-NetworkAllowanceExceeded-{id}-{sub}", ("BwInAllowanceExceeded", "BwOutAllowanceExceeded", "ConnTrackAllowanceExceeded", "PpsAllowanceExceeded"), SUM4, "Sum", 300, 1, 1, ">", fixed(0), "ignore", "per_broker"),
    Rule("AC44", "NLB", "AWS/NLB-UnHealthyHostCount-{id}-{sub}", ("UnHealthyHostCount",), ONE, "Average", 60, 3, 3, ">=", tag("UnHealthyHostCount", 1), "missing"),
    Rule("AC45", "NLB", "AWS/NLB-TCP_Target_Reset_Rate-{id}", ("TCP_Target_Reset_Count", "NewFlowCount"), "m1/(m1+m2)*100", "Sum", 60, 3, 3, ">=", tag("Target5XXRate", 1), "missing", note="documented tag key is TargetResetRate"),
    Rule("AC46", "RDS", "AWS/RDS-CPUUtilization-{id}", ("CPUUtilization",), ONE, "Average", 300, 3, 3, ">=", tag("CPUUtilization", 80), "missing"),
    Rule("AC47", "RDS", "AWS/RDS-CPUCreditBalance-{id}", ("CPUCreditBalance",), ONE, "Average", 300, 3, 3, "<=", limit("cpu_credit_80"), "ignore", "burstable", "documented default is 30 minutes"),
    Rule("AC48", "RDS", "AWS/RDS-SwapUsage-{id}", ("SwapUsage",), ONE, "Average", 300, 3, 3, ">=", tag("SwapUsageMB", 50, MIB), "ignore"),
    Rule("AC49", "RDS", "AWS/RDS-FreeStorageSpace-{id}", ("FreeStorageSpace",), ONE, "Average", 60, 5, 5, "<=", tag("FreeStorageSpaceGB", 50, GIB), "ignore", "own_storage"),
    Rule("AC50", "RDS", "AWS/RDS-IOPS-{id}", ("ReadIOPS", "WriteIOPS"), SUM2, "Average", 300, 3, 3, ">=", limit("database_iops"), "ignore"),
    Rule("AC51", "RDS", "AWS/RDS-Throughput-{id}", ("ReadThroughput", "WriteThroughput"), SUM2, "Average", 300, 3, 3, ">=", limit("database_throughput"), "ignore"),
    Rule("AC52", "RDS", "AWS/RDS-NetworkBandwidth-{id}", ("NetworkReceiveThroughput", "NetworkTransmitThroughput"), GREATER, "Average", 300, 1, 1, ">=", limit("database_network"), "ignore"),
    Rule("AC53", "RDS", "AWS/RDS-DatabaseConnections-{id}", ("DatabaseConnections",), ONE, "Average", 300, 3, 3, ">=", limit("database_connections"), "ignore"),
    Rule("AC54", "ElastiCache", "AWS/ElastiCache-CPUUtilization-{id}", ("CPUUtilization",), ONE, "Average", 300, 3, 3, ">=", defined("CPUUtilization"), "missing"),
    Rule("AC55", "ElastiCache", "AWS/ElastiCache-EngineCPUUtilization-{id}", ("EngineCPUUtilization",), ONE, "Average", 300, 3, 3, ">=", defined("EngineCPUUtilization"), "ignore"),
    Rule("AC56", "ElastiCache", "AWS/ElastiCache-CPUCreditBalance-{id}", ("CPUCreditBalance",), ONE, "Average", 300, 3, 3, "<=", defined("CPUCreditBalance"), "ignore", "burstable", "threshold times vCPUs", per_vcpu=True),
    Rule("AC57", "ElastiCache", "AWS/ElastiCache-DatabaseMemoryUsagePercentage-{id}", ("DatabaseMemoryUsagePercentage",), ONE, "Average", 300, 3, 3, ">=", defined("DatabaseMemoryUsagePercentage"), "ignore"),
    Rule("AC58", "ElastiCache", "AWS/ElastiCache-SwapUsage-{id}", ("SwapUsage",), ONE, "Average", 300, 3, 3, ">=", defined("SwapUsage", MIB), "ignore"),
    Rule("AC59", "ElastiCache", "AWS/ElastiCache-NetworkBandwidth-{id}", ("NetworkBytesIn", "NetworkBytesOut"), GREATER_RATE, "Sum", 300, 1, 1, ">=", limit("instance_network"), "ignore"),
    Rule("AC60", "ElastiCache", "AWS/ElastiCache-NetworkAllowanceExceeded-{id}", ("NetworkBandwidthInAllowanceExceeded", "NetworkBandwidthOutAllowanceExceeded", "NetworkConntrackAllowanceExceeded", "NetworkPacketsPerSecondAllowanceExceeded"), SUM4, "Sum", 300, 1, 1, ">", fixed(0), "ignore"),
    Rule("AC61", "ElastiCache", "AWS/ElastiCache-CurrConnections-{id}", ("CurrConnections",), ONE, "Average", 300, 3, 3, ">=", tag("CurrConnections", 60000), "ignore"),
    Rule("AC62", "S3", "AWS/S3-5xxRate-{id}-{sub}", ("5xxErrors", "AllRequests"), "m1/m2*100", "Sum", 60, 3, 3, ">=", defined("5xxRate"), "missing"),
    Rule("AC63", "S3", "AWS/S3-OperationsFailedReplication-{id}-{sub}", ("5xxErrors",), ONE, "Sum", 60, 3, 3, ">", defined("OperationsFailedReplication"), "missing", note="watches 5xxErrors as deployed; sub holds destination and rule"),
    Rule("AC64", "VPN", "AWS/VPN-TunnelState-{id}", ("TunnelState",), ONE, "Average", 300, 3, 3, "<", defined("TunnelState"), "missing"),
    Rule("AC65", "EC2-plain", "EC2-{id}-High-CPUUtilization-Alarm", ("CPUUtilization",), ONE, "Average", 300, 3, 3, ">=", fixed(80), "missing"),
    Rule("AC66", "EC2-plain", "EC2-{id}-High-Memory-Alarm", ("mem_used_percent",), ONE, "Average", 300, 3, 3, ">=", fixed(80), "missing"),
    Rule("AC67", "EC2-plain", "EC2-{id}-Failed-SystemStatusCheck-Alarm", ("StatusCheckFailed_System",), ONE, "Average", 60, 2, 2, ">", fixed(0), "missing"),
    Rule("AC68", "EC2-plain", "EC2-{id}-Failed-InstanceStatusCheck-Alarm", ("StatusCheckFailed_Instance",), ONE, "Average", 60, 3, 3, ">", fixed(0), "missing"),
    Rule("AC69", "EC2-disk", "EC2-{id}-{sub}-High-SpaceUsage-Alarm", ("disk_used_percent",), ONE, "Average", 60, 1, 1, ">=", fixed(80), "missing"),
    Rule("AC70", "EC2-windows-disk", "EC2-{id}-{sub}-Low-FreeSpace-Alarm", ("LogicalDisk % Free Space",), ONE, "Average", 60, 1, 1, "<=", fixed(20), "missing"),
    Rule("AC71", "EC2-plain", "EC2-{id}-High-ExceededPackets-Alarm", ("ethtool_bw_out_allowance_exceeded", "ethtool_conntrack_allowance_exceeded", "ethtool_linklocal_allowance_exceeded", "ethtool_bw_in_allowance_exceeded", "ethtool_pps_allowance_exceeded"), "RATE(SUM)*300", "Maximum", 300, 1, 1, ">=", fixed(80), "missing"),
    Rule("AC72", "EBS-plain", "EBS-{id}-High-IOPS-Alarm", ("VolumeReadOps", "VolumeWriteOps"), PAIR_RATE, "Sum", 60, 5, 5, ">=", limit("plain_volume_iops"), "missing"),
    Rule("AC73", "EBS-plain", "EBS-{id}-High-Throughput-Alarm", ("VolumeReadBytes", "VolumeWriteBytes"), "(m1+m2)*8/PERIOD", "Sum", 60, 1, 1, ">=", limit("plain_volume_throughput"), "missing"),
    Rule("AC74", "RDS-plain", "RDS-{id}-High-IOPS-Alarm", ("ReadIOPS", "WriteIOPS"), SUM2, "Sum", 60, 3, 3, ">=", limit("plain_database_iops"), "missing", note="second metric has a 300 s period as deployed"),
    Rule("AC75", "RDS-plain", "RDS-{id}-High-Throughput-Alarm", ("ReadThroughput", "WriteThroughput"), SUM2, "Maximum", 60, 3, 3, ">=", limit("plain_database_throughput"), "missing", note="second metric has a 300 s period as deployed"),
    Rule("AC76", "RDS-plain", "RDS-{id}-High-CPUUtilization-Alarm", ("CPUUtilization",), ONE, "Average", 300, 3, 3, ">=", fixed(75), "missing"),
    Rule("AC77", "RDS-plain", "RDS-{id}-High-SwapUsage-Alarm", ("SwapUsage",), ONE, "Average", 300, 1, 1, ">=", fixed(100 * MIB), "missing"),
    Rule("AC78", "RDS-plain", "RDS-{id}-Low-FreeStorageSpace-Alarm", ("FreeStorageSpace",), ONE, "Average", 60, 5, 5, "<=", fixed(50 * GIB), "missing"),
    Rule("AC79", "RDS-plain", "RDS-{id}-High-InsertCount-Alarm", ("InsertCount",), ONE, "Sum", 60, 1, 1, ">=", fixed(20), "missing"),
    Rule("AC80", "ES-plain", "ElasticSearch-{id}-ClusterStatus.red-Alarm", ("ClusterStatus.red",), ONE, "Average", 60, 1, 1, ">=", fixed(1), "missing"),
    Rule("AC81", "ES-plain", "ElasticSearch-{id}-ClusterStatus.yellow-Alarm", ("ClusterStatus.yellow",), ONE, "Average", 60, 1, 1, ">=", fixed(1), "missing"),
    Rule("AC82", "ES-plain", "ElasticSearch-{id}-Low-FreeStorageSpace-Alarm", ("FreeStorageSpace",), ONE, "Average", 60, 1, 1, "<=", fixed(20480), "missing"),
    Rule("AC83", "ES-plain", "ElasticSearch-{id}-ClusterIndexWritesBlocked-Alarm", ("ClusterIndexWritesBlocked",), ONE, "Average", 60, 1, 1, ">=", fixed(1), "missing"),
    Rule("AC84", "ES-plain", "ElasticSearch-{id}-Low-Nodes-Alarm", ("Nodes",), ONE, "Average", 86400, 1, 1, "<=", fixed(1), "missing"),
    Rule("AC85", "ES-plain", "ElasticSearch-{id}-AutomatedSnapshotFailure-Alarm", ("AutomatedSnapshotFailure",), ONE, "Average", 60, 1, 1, ">=", fixed(1), "missing"),
    Rule("AC86", "ES-plain", "ElasticSearch-{id}-High-CPUUtilization-Alarm", ("CPUUtilization",), ONE, "Average", 300, 3, 3, ">=", fixed(80), "missing"),
    Rule("AC87", "ES-plain", "ElasticSearch-{id}-High-WarmCPUUtilization-Alarm", ("WarmCPUUtilization",), ONE, "Average", 300, 3, 3, ">=", fixed(80), "missing"),
    Rule("AC88", "ES-plain", "ElasticSearch-{id}-High-JVMMemoryPressure-Alarm", ("JVMMemoryPressure",), ONE, "Average", 300, 3, 3, ">=", fixed(80), "missing"),
    Rule("AC89", "ES-plain", "ElasticSearch-{id}-High-WarmJVMMemoryPressure-Alarm", ("WarmJVMMemoryPressure",), ONE, "Average", 300, 3, 3, ">=", fixed(80), "missing"),
    Rule("AC90", "ES-plain", "ElasticSearch-{id}-High-MasterCPUUtilization-Alarm", ("MasterCPUUtilization",), ONE, "Average", 300, 3, 3, ">=", fixed(50), "missing"),
    Rule("AC91", "ES-plain", "ElasticSearch-{id}-High-MasterJVMMemoryPressure-Alarm", ("MasterJVMMemoryPressure",), ONE, "Average", 300, 1, 1, ">=", fixed(50), "missing"),
    Rule("AC92", "ES-plain", "ElasticSearch-{id}-KMSKeyError-Alarm", ("KMSKeyError",), ONE, "Average", 60, 1, 1, ">=", fixed(1), "missing"),
    Rule("AC93", "ES-plain", "ElasticSearch-{id}-KMSKeyInaccessible-Alarm", ("KMSKeyInaccessible",), ONE, "Average", 60, 1, 1, ">=", fixed(1), "missing"),
    Rule("AC94", "CloudFront", "CloudFront-{id}-High-5xxErrorRate-Alarm", ("5xxErrorRate",), ONE, "Average", 300, 2, 2, ">=", fixed(5), "missing"),
    Rule("AC95", "CloudFront", "CloudFront-{id}-High-OriginBandwidth-Alarm", ("BytesDownloaded", "CacheHitRate"), "m1*(100-m2)/100*8/PERIOD", "Sum,Average", 300, 1, 1, ">=", fixed(1500000000), "missing"),
    Rule("AC96", "CloudFront", "CloudFront-{id}-High-Requests-Alarm", ("Requests",), ONE, "Sum", 300, 1, 1, ">=", fixed(1800000000), "missing"),
    Rule("AC97", "CloudFront", "CloudFront-{id}-Low-RequestsChangeRate-Alarm", ("Requests",), "LAG1/LAG2-1", "Sum", 300, 1, 1, "<", fixed(-0.8), "missing"),
]

RULE_SCHEMA = (
    "rule_id string, service string, name string, metrics array<string>, expression string, statistics array<string>, "
    "period int, datapoints int, periods int, comparison string, threshold_kind string, threshold_key string, "
    "threshold_value double, threshold_factor double, missing string, applies string, note string, per_vcpu boolean"
)


def rule_table(spark: SparkSession, rules: list[Rule] | None = None) -> DataFrame:
    """The catalogue as a small table; one statistic per metric position."""
    rows = []
    for rule in rules or RULES:
        r = asdict(rule)
        stats = rule.statistic.split(",")
        t = rule.threshold
        rows.append(
            (
                r["rule_id"], r["service"], r["name"], list(rule.metrics), r["expression"],
                stats if len(stats) > 1 else stats * len(rule.metrics), r["period"], r["datapoints"], r["periods"],
                r["comparison"], t.kind, t.key, t.value, t.factor, r["missing"], r["applies"], r["note"], r["per_vcpu"],
            )
        )
    return spark.createDataFrame(rows, RULE_SCHEMA)
