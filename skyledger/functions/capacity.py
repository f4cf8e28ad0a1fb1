"""Capacity limits of volumes, instances, databases and clusters, and thresholds read from tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.network import subnet_use_limit
from skyledger.functions.text import struct_tag

THRESHOLD_TAG = "AlarmThreshold"  # fixed value: tag whose JSON holds per-metric thresholds
DISABLED = "disable"
MIB = 1024.0 * 1024.0
# Stand-ins for "storage sets no limit".
NO_IOPS_LIMIT = 1e13
NO_THROUGHPUT_LIMIT = 100000 * MIB


def tag_thresholds(tags: str = "tags") -> Column:
    """Thresholds named in the tag as a map; empty for a missing or broken tag."""
    parsed = F.from_json(struct_tag(tags, THRESHOLD_TAG), "map<string,string>")
    return F.coalesce(parsed, F.create_map().cast("map<string,string>"))


def alarms_disabled(tags: str = "tags") -> Column:
    return F.coalesce(struct_tag(tags, THRESHOLD_TAG) == DISABLED, F.lit(False))


def resolve_threshold(
    metric: Column | str,
    default: Column | float,
    thresholds: Column | None = None,
    disabled: Column | None = None,
    tags: str = "tags",
) -> Column:
    """Tag value of the metric, else the default; NULL when the tag disables alarms (so no alarm row follows).

    Callers with many thresholds pass the parsed tag and the disabled flag as columns, so that each is read once.
    """
    table = tag_thresholds(tags) if thresholds is None else thresholds
    off = alarms_disabled(tags) if disabled is None else disabled
    key = F.lit(metric) if isinstance(metric, str) else metric
    fallback = default if isinstance(default, Column) else F.lit(float(default))
    value = F.coalesce(F.try_element_at(table, key).try_cast("double"), fallback.cast("double"))
    return F.when(~off, value)


def general_iops(size: Column) -> Column:
    """3 operations per GiB between 100 and 16000."""
    return F.greatest(F.least(size * F.lit(3.0), F.lit(16000.0)), F.lit(100.0))


def volume_iops(kind: Column, size: Column, iops: Column) -> Column:
    return (
        F.when(kind == "gp2", general_iops(size))
        .when(kind == "io1", iops)
        .when(kind == "gp3", F.greatest(iops, F.lit(3000.0)))
    )


def volume_throughput(kind: Column, size: Column, iops: Column, throughput: Column) -> Column:
    return (
        F.when(kind == "gp2", F.when(size >= 334, F.lit(250 * MIB)).otherwise(F.lit(128 * MIB)))
        .when(kind == "io1", F.greatest(iops * F.lit(16 * 1024.0), F.lit(1000 * MIB)))
        .when(kind == "gp3", F.greatest(throughput * F.lit(MIB), F.lit(125 * MIB)))
    )


def burst_volume_peak(size: Column) -> Column:
    return F.when(size >= 170, F.lit(250 * MIB)).otherwise(F.lit(128 * MIB))


def burst_volume_base(size: Column) -> Column:
    """Full rate from 334 GiB on, a fifth of the peak below."""
    return F.when(size >= 334, F.lit(250 * MIB)).otherwise(burst_volume_peak(size) * F.lit(0.2))


def has_own_storage(engine: Column) -> Column:
    return ~(engine.contains("aurora") | engine.contains("docdb"))


def capacity_limits(thresholds: Column | None = None, disabled: Column | None = None) -> dict[str, Column]:
    """Limit name -> threshold. Input columns: see ``operators.alarms.RESOURCE_SCHEMA`` (NULL where unknown)."""
    tag_map = tag_thresholds() if thresholds is None else thresholds
    off = alarms_disabled() if disabled is None else disabled

    def from_tag(metric: str, default: Column | float) -> Column:
        return resolve_threshold(metric, default, tag_map, off)

    def peak_or_base(peak: Column, base: Column, name: str, peak_default: float = 0.8) -> Column:
        """Share of the peak where it equals the base (no bursting), else share of the base."""
        return F.when(peak == base, from_tag(f"Max{name}", peak_default) * peak).otherwise(from_tag(f"Base{name}", 1.0) * base)

    kind, size = F.col("volume_type"), F.col("size_gib").cast("double")
    iops = F.coalesce(F.col("iops").cast("double"), F.lit(0.0))
    throughput = F.coalesce(F.col("throughput").cast("double"), F.lit(0.0))
    base_iops, max_iops = F.col("baseline_iops").cast("double"), F.col("max_iops").cast("double")
    base_bytes, max_bytes = F.col("baseline_mbps") * F.lit(1e6 / 8), F.col("max_mbps") * F.lit(1e6 / 8)
    base_net, peak_net = F.col("baseline_gbps") * F.lit(1e9 / 8), F.col("peak_gbps") * F.lit(1e9 / 8)
    vcpus = F.col("vcpus").cast("double")
    instance_iops = peak_or_base(max_iops, base_iops, "IOPS")
    instance_bytes = peak_or_base(max_bytes, base_bytes, "Throughput")

    # Storage of search clusters and brokers: bursting general-purpose disks reach 3000 operations.
    gp2_ops, gp2_peak = general_iops(size), F.greatest(F.lit(3000.0), general_iops(size))
    cluster_ops_base = F.when(kind == "gp2", gp2_ops).when(kind == "io1", iops).when(kind == "gp3", F.greatest(iops, F.lit(3000.0)))
    cluster_ops_peak = F.when(kind == "gp2", gp2_peak).otherwise(cluster_ops_base)
    disk_base = F.when(kind == "gp2", burst_volume_base(size)).otherwise(volume_throughput(kind, size, iops, throughput))
    disk_peak = F.when(kind == "gp2", burst_volume_peak(size)).otherwise(volume_throughput(kind, size, iops, throughput))

    # Databases: provisioned floors rise from 400 GiB on; shared-storage engines have no storage limit.
    large = size >= 400
    floor_ops = F.when(large, F.lit(12000.0)).otherwise(F.lit(3000.0))
    floor_bytes = F.when(large, F.lit(500 * MIB)).otherwise(F.lit(125 * MIB))
    own = has_own_storage(F.coalesce("engine", F.lit("")))
    db_ops_base = F.when(kind == "gp2", gp2_ops).when(kind == "io1", iops).when(kind == "gp3", F.greatest(iops, floor_ops))
    db_ops_peak = F.when(kind == "gp2", F.greatest(floor_ops, gp2_ops)).otherwise(db_ops_base)
    db_gp3 = F.greatest(throughput * F.lit(MIB), floor_bytes)
    db_bytes_base = F.when(kind == "gp3", db_gp3).otherwise(disk_base)
    db_bytes_peak = F.when(kind == "gp3", db_gp3).otherwise(disk_peak)

    def storage(peak: Column, base: Column, name: str, none: float, limited: Column) -> Column:
        # Unlimited storage still honours a disabling tag through the instance side.
        return F.when(limited, F.coalesce(peak_or_base(peak, base, name), F.lit(none))).otherwise(F.lit(none))

    always = F.lit(True)
    memory = F.col("memory_mib").cast("double")
    connections = from_tag(
        "DatabaseConnections", F.lit(0.9) * (memory - F.lit(500.0)) * F.lit(MIB) / F.lit(12582880.0)
    )
    plain_iops = F.when(kind == "gp2", general_iops(size)).when(kind.isin("gp3", "io1", "io2"), iops)
    plain_bytes = F.when(kind == "gp2", F.when(size >= 334, F.lit(250 * MIB)).otherwise(F.lit(128 * MIB))).when(
        kind == "io1", F.when(iops > 32000, F.lit(1000 * MIB)).otherwise(F.lit(500 * MIB))
    )
    plain_db_iops = F.when(kind == "gp2", general_iops(size)).when(kind == "io1", iops)
    plain_db_bytes = F.when(kind == "gp2", F.when(size >= 334, F.lit(250 * MIB)).otherwise(F.lit(128 * MIB))).when(
        kind == "io1", F.lit(1000 * MIB)
    )
    return {
        "volume_iops": from_tag("IOPS", 0.8) * volume_iops(kind, size, iops),
        "volume_throughput": from_tag("Throughput", 0.8) * volume_throughput(kind, size, iops, throughput),
        "instance_iops": instance_iops,
        "instance_throughput": instance_bytes,
        "instance_network": peak_or_base(peak_net, base_net, "NetworkBandwidth"),
        "cpu_credit_30": vcpus * from_tag("CreditSupportMinute", 30),
        "cpu_credit_80": vcpus * from_tag("CreditSupportMinute", 80),
        "search_nodes": (
            F.col("data_nodes") + F.coalesce("master_nodes", F.lit(0)) + F.coalesce("warm_nodes", F.lit(0))
        ).cast("double"),
        "search_iops": F.least(
            F.coalesce(instance_iops, F.lit(0.0)), storage(cluster_ops_peak, cluster_ops_base, "IOPS", NO_IOPS_LIMIT, always)
        ),
        "search_throughput": F.least(
            F.coalesce(instance_bytes, F.lit(0.0)), storage(disk_peak, disk_base, "Throughput", NO_THROUGHPUT_LIMIT, always)
        ),
        "broker_iops": F.least(F.coalesce(instance_iops, F.lit(0.0)), storage(gp2_peak, gp2_ops, "IOPS", NO_IOPS_LIMIT, always)),
        "broker_throughput": F.least(
            F.coalesce(instance_bytes, F.lit(0.0)),
            storage(burst_volume_peak(size), burst_volume_base(size), "Throughput", NO_THROUGHPUT_LIMIT, always),
        ),
        "database_iops": F.least(
            F.coalesce(instance_iops, F.lit(0.0)), storage(db_ops_peak, db_ops_base, "IOPS", NO_IOPS_LIMIT, own)
        ),
        "database_throughput": F.least(
            F.coalesce(instance_bytes, F.lit(0.0)), storage(db_bytes_peak, db_bytes_base, "Throughput", NO_THROUGHPUT_LIMIT, own)
        ),
        "database_network": peak_or_base(peak_net, base_net, "NetworkBandwidth", 1.0),
        "database_connections": connections.cast("long").cast("double"),
        "subnet_use": subnet_use_limit("cidr"),
        "plain_volume_iops": F.lit(0.8) * plain_iops,
        "plain_volume_throughput": F.lit(0.8) * plain_bytes,
        "plain_database_iops": F.lit(0.8) * plain_db_iops,
        "plain_database_throughput": F.lit(0.8) * plain_db_bytes,
    }


def alarm_actions(
    topic: str | None, account: Column, region: Column, plan: Column, severity: Column, category: Column
) -> Column:
    """Targets of an alarm: the topic, and an incident plan or else an ops item of the given severity."""
    incident = F.concat(F.lit("arn:aws:ssm-incidents::"), account, F.lit(":response-plan/"), plan)
    suffix = F.when(F.length(category) > 0, F.concat(F.lit("#CATEGORY="), category)).otherwise(F.lit(""))
    item = F.concat(F.lit("arn:aws:ssm:"), region, F.lit(":"), account, F.lit(":opsitem:"), severity.cast("string"), suffix)
    extra = F.when(F.length(plan) > 0, incident).when(severity.isNotNull(), item)
    return F.array_compact(F.array(F.lit(topic) if topic else F.lit(None).cast("string"), extra))
