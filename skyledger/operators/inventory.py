"""Daily resource inventories, snapshot lineage, volume growth and disk look-ups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import text
from skyledger.operators.keyed import carried_lag, join_totals


def explode_tags(df: DataFrame, keys: Sequence[str], tags: str = "tags") -> DataFrame:
    """One row per ``{key, value}`` tag."""
    return df.select(*keys, F.inline(tags))


def text_tag_rows(df: DataFrame, keys: Sequence[str], tag: str, out: str, tags: str = "tags") -> DataFrame:
    """One row per ``"tag:value"`` entry; an item with two such entries gives two rows."""
    rows = df.select(*keys, F.explode(tags).alias("_tag")).where(F.col("_tag").startswith(f"{tag}:"))
    return rows.select(*keys, F.substring("_tag", len(tag) + 2, 2147483647).alias(out))


def inventory_instances(instances: DataFrame, vpcs: DataFrame, subnets: DataFrame, tag: str = "Project") -> DataFrame:
    """Instances with project tag, network names and interface count."""
    v = vpcs.select(F.col("id").alias("vpc_id"), text.text_tag("tags", "Name").alias("vpc_name"))
    s = subnets.select(
        F.col("id").alias("subnet_id"),
        text.text_tag("tags", "Name").alias("subnet_name"),
        # Only named subnets report their zone and range.
        F.when(text.text_tag("tags", "Name").isNotNull(), F.col("availability_zone")).alias("availability_zone"),
        F.when(text.text_tag("tags", "Name").isNotNull(), F.col("cidr_block")).alias("cidr_block"),
    )
    base = instances.withColumn("project", text.struct_tag("tags", tag)).withColumn(
        "eni_count", text.array_length("network_interfaces")
    )
    return join_totals(join_totals(base, v, ["vpc_id"]), s, ["subnet_id"]).select(
        "instance_id", "project", "image_id", "instance_type", "platform", "vpc_id", "vpc_name", "subnet_id",
        "subnet_name", "availability_zone", "cidr_block", "private_ip_address", "public_ip_address",
        "security_groups", "security_group_names", "key_name", "eni_count",
    )


def inventory_databases(databases: DataFrame, vpcs: DataFrame, tag: str = "Project") -> DataFrame:
    v = vpcs.select(F.col("id").alias("vpc"), text.text_tag("tags", "Name").alias("vpc_name"))
    base = databases.select(
        "instance_id",
        text.struct_tag("tags", tag).alias("project"),
        "instance_class",
        "engine",
        "engine_version",
        "is_multi_az",
        "primary_az",
        "secondary_az",
        "read_replica_source_id",
        F.col("endpoint.address").alias("address"),
        F.col("endpoint.port").alias("port"),
        F.col("subnet_group.name").alias("subnet_group_name"),
        F.col("subnet_group.vpc").alias("vpc"),
        "create_time",
    )
    return join_totals(base, v, ["vpc"]).select(
        *[c for c in base.columns if c != "create_time"], "vpc_name", "create_time"
    )


def route_associations(tables: DataFrame) -> DataFrame:
    """Distinct (table, associated subnet, vpc); the main table's subnet is the text 'null'."""
    rows = tables.select("route_table_id", F.col("vpc").alias("vpc"), F.explode("associations").alias("_a"))
    return rows.select("route_table_id", text.association_target("_a").alias("subnet_id"), "vpc").distinct()


def inventory_subnets(subnets: DataFrame, tables: DataFrame) -> DataFrame:
    """Subnets with their route table: an explicit association first, else the vpc's main table, else none.

    The either-or condition is two equi-joins: explicit tables by subnet, main tables by vpc for the subnets without
    one. Several tables of the same rank all stay.
    """
    found = route_associations(tables)
    explicit = found.where(F.col("subnet_id") != "null").select(
        F.col("subnet_id").alias("id"), F.col("route_table_id").alias("_explicit")
    )
    main = found.where(F.col("subnet_id") == "null").select("vpc", F.col("route_table_id").alias("_main"))
    # Main tables only meet subnets that have no explicit one: the others get a key no vpc has.
    direct = join_totals(subnets, explicit, ["id"]).withColumn(
        "_vpc", F.when(F.col("_explicit").isNull(), F.col("vpc")).otherwise(F.concat(F.lit("\u0000"), F.col("id")))
    )
    routed = join_totals(direct, main.withColumnRenamed("vpc", "_vpc"), ["_vpc"]).withColumn(
        "route_table_id", F.coalesce("_explicit", "_main")
    )
    names = text_tag_rows(tables, ["route_table_id", "vpc"], "Name", "route_table_name").distinct()
    return join_totals(routed, names, ["route_table_id", "vpc"]).select(
        "id",
        text.text_tag("tags", "Name").alias("subnet_name"),
        "availability_zone",
        "available_ip_count",
        "cidr_block",
        "map_public_ip",
        "vpc",
        "route_table_id",
        "route_table_name",
    )


ROUTE_COLUMNS = [
    "route_table_id", "vpc", "state", "dst_cidr", "dst_cidr_v6", "dst_prefix_list", "egress_igw", "gateway",
    "instance_id", "nat_gateway", "interface", "transit_gateway", "vpc_peering_con",
]


def inventory_routes(tables: DataFrame) -> DataFrame:
    kept = [c for c in ROUTE_COLUMNS if c in tables.columns]
    return tables.select(text.text_tag("tags", "Name").alias("name"), *kept)


FIRST_SNAPSHOT = "snap-00000000000000000"  # fixed value: "no predecessor" marker
BLOCK_BYTES = 524288  # fixed value: size of one changed block


def snapshot_lineage(snapshots: DataFrame) -> DataFrame:
    """Each snapshot with its predecessor of the same volume, found month by month."""
    month = F.trunc(F.col("start_time").cast("date"), "month")
    chained = carried_lag(
        snapshots, ["owner_id", "volume_id"], ["start_time", "snapshot_id"], "snapshot_id", "previous_snapshot_id", month
    )
    return chained.withColumn("previous_snapshot_id", F.coalesce("previous_snapshot_id", F.lit(FIRST_SNAPSHOT)))


def snapshot_increment(snapshots: DataFrame, changed_blocks: DataFrame) -> DataFrame:
    """Bytes each snapshot adds: the whole volume for the first one, changed blocks for the others."""
    counts = changed_blocks.groupBy(
        F.col("first_snapshot_id").alias("previous_snapshot_id"), F.col("second_snapshot_id").alias("snapshot_id")
    ).agg(F.count(F.lit(1)).alias("_blocks"))
    chained = snapshot_lineage(snapshots).join(counts, ["previous_snapshot_id", "snapshot_id"], "left")
    first = F.col("previous_snapshot_id") == FIRST_SNAPSHOT
    whole = F.col("volume_size").cast("long") * F.lit(1024**3)
    return chained.select(
        "owner_id",
        "volume_id",
        "start_time",
        "previous_snapshot_id",
        "snapshot_id",
        F.when(first, whole)
        .otherwise(F.coalesce("_blocks", F.lit(0)).cast("long") * F.lit(BLOCK_BYTES))
        .alias("increment_bytes"),
    )


SNAPSHOT_ORDER = ["start_time", "snapshot_id"]


def clustered_lineage(snapshots: DataFrame) -> DataFrame:
    """``snapshot_lineage`` of a table clustered by volume_id and ``SNAPSHOT_ORDER``: nothing is moved or sorted.

    A volume belongs to one owner here. Within ``sources.clustered.clustered_plans``.
    """
    before = F.lag("snapshot_id").over(Window.partitionBy("volume_id").orderBy(*SNAPSHOT_ORDER))
    return snapshots.withColumn("previous_snapshot_id", F.coalesce(before, F.lit(FIRST_SNAPSHOT)))


def clustered_increment(snapshots: DataFrame, changed_blocks: DataFrame) -> DataFrame:
    """``snapshot_increment`` of a clustered table; ``changed_blocks`` (volume_id, snapshot_id) has a row per block.

    Only the counts of changed blocks move, to the buckets of their volumes.
    """
    counts = changed_blocks.groupBy("volume_id", "snapshot_id").agg(F.count(F.lit(1)).alias("_blocks"))
    chained = clustered_lineage(snapshots).join(counts.hint("shuffle_hash"), ["volume_id", "snapshot_id"], "left")
    whole = F.col("volume_size").cast("long") * F.lit(1024**3)
    changed = F.coalesce("_blocks", F.lit(0)).cast("long") * F.lit(BLOCK_BYTES)
    return chained.select(
        "owner_id",
        "volume_id",
        "start_time",
        "previous_snapshot_id",
        "snapshot_id",
        F.when(F.col("previous_snapshot_id") == FIRST_SNAPSHOT, whole).otherwise(changed).alias("increment_bytes"),
    )


def volume_growth_plan(
    volumes: DataFrame, modifications: DataFrame, as_of: datetime, step_gib: int = 10, wait_hours: int = 24
) -> DataFrame:
    """Planned new size per volume; blocked while the last change is younger than ``wait_hours``."""
    last = modifications.groupBy("volume_id").agg(F.max("start_time").alias("last_change"))
    now = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    ready = F.col("last_change").isNull() | (
        now >= F.col("last_change").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(wait_hours))
    )
    return join_totals(volumes, last, ["volume_id"]).select(
        "volume_id",
        "size",
        (F.col("size") + F.lit(step_gib)).alias("new_size"),
        ready.alias("can_modify"),
    )


def disk_alarm_fields(alarms: DataFrame) -> DataFrame:
    """Device, partition, mount point and drive letter of disk-space alarms in ALARM state."""
    d = F.col("dimensions")

    def dim(name: str) -> Column:
        return F.try_element_at(d, F.lit(name))

    return alarms.where(F.col("alarm_name").startswith("DiskSpace") & (F.col("state") == "ALARM")).select(
        "alarm_name",
        dim("InstanceId").alias("instance_id"),
        dim("path").alias("path"),
        dim("device").alias("device"),
        dim("fstype").alias("fstype"),
        text.base_device(dim("device")).alias("device_name"),
        text.partition_number(dim("device")).alias("partition_num"),
        dim("path").alias("mount_point"),
        text.drive_letter(dim("instance")).alias("drive_letter"),
    )


def volume_of_device(alarms: DataFrame, mappings: DataFrame) -> DataFrame:
    """Volume behind an alarmed device: equal instance and equal device letter."""
    disks = mappings.where(F.col("device_name").startswith("/dev/")).select(
        "instance_id", text.device_letter("device_name").alias("_letter"), "volume_id"
    )
    return alarms.withColumn("_letter", text.device_letter("device")).join(
        disks, ["instance_id", "_letter"], "inner"
    ).drop("_letter")


def resources_of_type(
    resources: DataFrame, types: DataFrame, type_column: str, prefix: str = "", suffix: str = ""
) -> DataFrame:
    """Resources with the capacity of their instance type (prefix and suffix of the class removed first).

    ``types`` may be as long as it likes: its copies for the salts are not broadcast by the size of the file they come from.
    """
    name = F.col(type_column)
    if prefix:
        name = F.when(name.startswith(prefix), F.substring(name, len(prefix) + 1, 2147483647)).otherwise(name)
    if suffix:
        keep = F.length(name) - F.lit(len(suffix))
        name = F.when(name.endswith(suffix), F.substring(name, F.lit(1), keep)).otherwise(name)
    return join_totals(resources.withColumn("_type", name), types.withColumnRenamed("instance_type", "_type"), ["_type"], grows=True).drop("_type")


# Instance states that count as existing.
EXISTING_STATES = ["pending", "running", "shutting-down", "stopping", "stopped"]


def running_deficit(wanted: DataFrame, instances: DataFrame) -> DataFrame:
    """How many instances are missing per group (``wanted``: group_name, needed)."""
    existing = (
        instances.where(F.col("state").isin(*EXISTING_STATES))
        .groupBy("group_name")
        .agg(F.count(F.lit(1)).alias("existing"))
    )
    have = F.coalesce("existing", F.lit(0))
    return wanted.join(existing, "group_name", "left").select(
        "group_name",
        F.col("needed").cast("long").alias("needed"),
        have.cast("long").alias("existing"),
        F.greatest(F.col("needed") - have, F.lit(0)).cast("long").alias("deficit"),
    )


def named_entities(events: DataFrame, inventory: DataFrame, ids: str = "resource_ids", key: str = "event_id") -> DataFrame:
    """Text list ``name (id, private ip)`` of the resources an event lists, in id order; '-' for a missing name."""
    exploded = events.select(key, F.explode(ids).alias("resource_id")).distinct()
    known = inventory.select("resource_id", "name", "private_ip")
    described = join_totals(exploded, known, ["resource_id"]).select(
        key,
        F.struct(
            "resource_id",
            F.concat(
                F.coalesce("name", F.lit("-")), F.lit(" ("), F.concat_ws(", ", "resource_id", "private_ip"), F.lit(")")
            ).alias("label"),
        ).alias("_e"),
    )
    listed = described.groupBy(key).agg(F.array_sort(F.collect_list("_e")).alias("_list"))
    return events.join(listed, key, "left").withColumn(
        "resource_names", F.coalesce(F.array_join(F.transform("_list", lambda e: e["label"]), ","), F.lit(""))
    ).drop("_list")


def certificate_resources(certificates: DataFrame, distributions: DataFrame) -> DataFrame:
    """Resources behind each certificate; content-delivery ones with their alias list.

    ``certificates``: cert_arn, days_to_expiry, in_use_by (array); a repeated certificate counts once.
    """
    uses = certificates.select("cert_arn", "days_to_expiry", F.explode("in_use_by").alias("resource_arn")).distinct()
    cdn = F.col("resource_arn").contains("cloudfront")
    uses = uses.withColumn("distribution_id", F.when(cdn, F.element_at(F.split("resource_arn", "/"), -1)))
    aliases = distributions.select("distribution_id", F.array_join("aliases", ",").alias("cnames"))
    return join_totals(uses, aliases, ["distribution_id"])


def certificate_notice(certificates: DataFrame, distributions: DataFrame) -> DataFrame:
    """One text per certificate listing its linked resources."""
    rows = certificate_resources(certificates, distributions).withColumn(
        "_line",
        F.concat(
            F.lit("\t"),
            F.col("resource_arn"),
            F.when(F.col("cnames").isNotNull(), F.concat(F.lit("\t域名: "), F.col("cnames"))).otherwise(F.lit("")),
            F.lit("\n"),
        ),
    )
    lines = rows.groupBy("cert_arn").agg(F.array_join(F.array_sort(F.collect_list("_line")), "").alias("_lines"))
    return (
        certificates.select("cert_arn", "days_to_expiry")
        .distinct()
        .join(lines, "cert_arn", "left")
        .select(
            "cert_arn",
            "days_to_expiry",
            F.concat(
                F.lit("证书ARN: "),
                F.col("cert_arn"),
                F.lit(" 将于"),
                F.col("days_to_expiry").cast("int").cast("string"),
                F.lit("天后过期。\n关联资源:\n"),
                F.coalesce("_lines", F.lit("")),
            ).alias("message"),
        )
    )
