"""Inventory, snapshot, compliance and tagging queries on nations, suppliers, customers, parts and orders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import compliance, inventory
from skyledger.plans import bindings as b
from skyledger.plans.registry import REGISTRY, query
from skyledger.session import cut_lineage, scratch_path
from skyledger.sources import clustered


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return b.table(spark, sf_dir, name)


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def vpcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as vpcs; one of them has no name."""
    label = F.when(F.col("r_regionkey") == 3, F.lit("Zone:x")).otherwise(F.concat(F.lit("Name:"), F.col("r_name")))
    return t(spark, sf_dir, "region").select(
        F.concat(F.lit("vpc-"), _text("r_regionkey")).alias("id"), F.array(F.lit("Env:t"), label).alias("tags")
    )


def subnets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as subnets; every fifth has no name."""
    key = F.col("n_nationkey")
    label = F.when(key % 5 == 4, F.lit("Zone:x")).otherwise(F.concat(F.lit("Name:"), F.col("n_name")))
    return t(spark, sf_dir, "nation").select(
        F.concat(F.lit("subnet-"), _text("n_nationkey")).alias("id"),
        F.concat(F.lit("vpc-"), _text("n_regionkey")).alias("vpc"),
        F.concat(F.lit("az-"), (key % 3).cast("string")).alias("availability_zone"),
        F.concat(F.lit("10.0."), key.cast("string"), F.lit(".0/24")).alias("cidr_block"),
        F.lit("available").alias("state"),
        (key * 10).cast("int").alias("available_ip_count"),
        (key % 2 == 0).alias("map_public_ip"),
        F.array(label).alias("tags"),
    )


SUBNET_SQL = """vpc AS (SELECT 'vpc-' || r_regionkey AS id, CASE WHEN r_regionkey <> 3 THEN r_name END AS vpc_name FROM region),
  sub AS (SELECT 'subnet-' || n_nationkey AS id, 'vpc-' || n_regionkey AS vpc, 'az-' || (n_nationkey % 3) AS az, '10.0.' || n_nationkey || '.0/24' AS cidr,
    cast(n_nationkey * 10 AS INTEGER) AS ips, n_nationkey % 2 = 0 AS public, CASE WHEN n_nationkey % 5 <> 4 THEN n_name END AS name, n_nationkey, n_regionkey FROM nation)"""


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as instances in their nation's subnet."""
    s = t(spark, sf_dir, "supplier").join(t(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    owner = F.when(F.col("s_suppkey") % 3 != 0, F.lit("Project")).otherwise(F.lit("Other"))
    sid = _text("s_suppkey")
    enis = F.when(F.col("s_suppkey") % 7 != 0, F.sequence(F.lit(1), (F.col("s_suppkey") % 4 + 1).cast("int")))
    return s.select(
        F.concat(F.lit("i-"), sid).alias("instance_id"),
        F.lit("img").alias("image_id"),
        F.lit("m5.large").alias("instance_type"),
        F.lit(None).cast("string").alias("platform"),
        F.concat(F.lit("vpc-"), _text("n_regionkey")).alias("vpc_id"),
        F.concat(F.lit("subnet-"), _text("s_nationkey")).alias("subnet_id"),
        F.concat(F.lit("10.0.0."), sid).alias("private_ip_address"),
        F.lit("").alias("public_ip_address"),
        F.lit("key").alias("key_name"),
        F.array(F.lit("sg-1")).alias("security_groups"),
        F.array(F.lit("web")).alias("security_group_names"),
        F.transform(enis, lambda e: F.concat(F.lit("eni-"), e.cast("string"))).alias("network_interfaces"),
        F.array(
            F.struct(F.lit("Owner").alias("key"), F.lit("x").alias("value")),
            F.struct(owner.alias("key"), F.concat(F.lit("p"), (F.col("s_suppkey") % 10).cast("string")).alias("value")),
        ).alias("tags"),
    )


@query(
    "i01_inventory_instances",
    f"""WITH {SUBNET_SQL} SELECT 'i-' || s_suppkey AS instance_id, CASE WHEN s_suppkey % 3 <> 0 THEN 'p' || (s_suppkey % 10) END AS project, v.id AS vpc_id, v.vpc_name, u.id AS subnet_id, u.name AS subnet_name,
      CASE WHEN u.name IS NOT NULL THEN az END AS availability_zone, CASE WHEN u.name IS NOT NULL THEN cidr END AS cidr_block, 'sg-1' AS security_groups,
      cast(CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey % 4 + 1 END AS INTEGER) AS eni_count
      FROM supplier JOIN sub u ON u.n_nationkey = s_nationkey JOIN vpc v ON v.id = u.vpc""",
)
def i01(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = inventory.inventory_instances(instances(spark, sf_dir), vpcs(spark, sf_dir), subnets(spark, sf_dir))
    return out.select(
        "instance_id", "project", "vpc_id", "vpc_name", "subnet_id", "subnet_name", "availability_zone", "cidr_block",
        F.array_join("security_groups", ",").alias("security_groups"), "eni_count",
    )


@query(
    "i02_inventory_databases",
    f"""WITH {SUBNET_SQL} SELECT 'db-' || p_partkey AS instance_id, CASE WHEN p_size > 10 THEN p_brand END AS project, 'db.' || lower(p_type) AS instance_class, p_type = 'PROMO' AS is_multi_az,
      'host-' || p_partkey AS address, cast(3000 + p_size AS INTEGER) AS port, 'grp-' || (p_partkey % 5) AS subnet_group_name, 'vpc-' || (p_partkey % 5) AS vpc, vpc_name
      FROM part LEFT JOIN vpc v ON v.id = 'vpc-' || (p_partkey % 5)""",
)
def i02(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = _text("p_partkey")
    five = (F.col("p_partkey") % 5).cast("string")
    none = F.lit(None).cast("string")
    databases = t(spark, sf_dir, "part").select(
        F.concat(F.lit("db-"), key).alias("instance_id"),
        F.concat(F.lit("db."), F.lower("p_type")).alias("instance_class"),
        F.lit("mysql").alias("engine"),
        F.lit("8").alias("engine_version"),
        (F.col("p_type") == "PROMO").alias("is_multi_az"),
        none.alias("primary_az"),
        none.alias("secondary_az"),
        none.alias("read_replica_source_id"),
        F.struct(F.concat(F.lit("host-"), key).alias("address"), (F.lit(3000) + F.col("p_size")).cast("int").alias("port")).alias("endpoint"),
        F.struct(F.concat(F.lit("grp-"), five).alias("name"), F.concat(F.lit("vpc-"), five).alias("vpc")).alias("subnet_group"),
        F.when(F.col("p_size") > 10, b.tag_array(("Project", F.col("p_brand")))).otherwise(b.tag_array(("Other", F.lit("x")))).alias("tags"),
        F.lit(None).cast("timestamp").alias("create_time"),
    )
    out = inventory.inventory_databases(databases, vpcs(spark, sf_dir))
    return out.select("instance_id", "project", "instance_class", "is_multi_az", "address", "port", "subnet_group_name", "vpc", "vpc_name")


def route_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as route tables: those divisible by three serve one subnet, the first two of a region are main tables."""
    key = F.col("n_nationkey")
    nations = t(spark, sf_dir, "nation").withColumn("one", key % 3 == 0).withColumn("main", key < 7)
    explicit = F.when(F.col("one"), F.array(F.concat(F.lit("subnet-"), key.cast("string"), F.lit(":a"))))
    main = F.when(F.col("main"), F.array(F.lit("null:m"), F.lit("null:m2")))
    empty = F.array().cast("array<string>")
    return nations.select(
        F.concat(F.lit("rtb-"), key.cast("string")).alias("route_table_id"),
        F.concat(F.lit("vpc-"), _text("n_regionkey")).alias("vpc"),
        F.lit("active").alias("state"),
        F.concat(F.lit("10."), key.cast("string"), F.lit(".0.0/16")).alias("dst_cidr"),
        F.concat(F.coalesce(explicit, empty), F.coalesce(main, empty)).alias("associations"),
        F.when(key % 2 == 0, F.array(F.concat(F.lit("Name:table "), key.cast("string")))).otherwise(F.array(F.lit("Env:x"))).alias("tags"),
    )


@query(
    "i03_inventory_subnets",
    f"""WITH {SUBNET_SQL}, a AS (SELECT 'rtb-' || n_nationkey AS rt, 'vpc-' || n_regionkey AS vpc, 'subnet-' || n_nationkey AS sn FROM nation WHERE n_nationkey % 3 = 0
        UNION SELECT 'rtb-' || n_nationkey, 'vpc-' || n_regionkey, 'null' FROM nation WHERE n_nationkey < 7),
      j AS (SELECT s.*, a.rt, rank() OVER (PARTITION BY s.id ORDER BY a.sn DESC) AS r FROM sub s LEFT JOIN a ON s.id = a.sn OR (s.vpc = a.vpc AND a.sn = 'null'))
      SELECT id, name AS subnet_name, az AS availability_zone, ips AS available_ip_count, cidr AS cidr_block, public AS map_public_ip, vpc, rt AS route_table_id,
        CASE WHEN cast(replace(rt, 'rtb-', '') AS INTEGER) % 2 = 0 THEN 'table ' || replace(rt, 'rtb-', '') END AS route_table_name FROM j WHERE r = 1""",
)
def i03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.inventory_subnets(subnets(spark, sf_dir), route_tables(spark, sf_dir))


@query(
    "i04_inventory_routes",
    "SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'table ' || n_nationkey END AS name, 'rtb-' || n_nationkey AS route_table_id, 'vpc-' || n_regionkey AS vpc, 'active' AS state, '10.' || n_nationkey || '.0.0/16' AS dst_cidr FROM nation",
)
def i04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.inventory_routes(route_tables(spark, sf_dir))


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "orders").select(
        F.lit("self").alias("owner_id"),
        F.concat(F.lit("vol-"), _text("o_custkey")).alias("volume_id"),
        F.concat(F.lit("snap-"), _text("o_orderkey")).alias("snapshot_id"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_custkey") % 100 + 1).cast("int").alias("volume_size"),
    )


@query(
    "i06_snapshot_increment",
    """WITH s AS (SELECT *, lag('snap-' || o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, 'snap-' || o_orderkey) AS prev FROM orders),
      blocks AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
      SELECT 'vol-' || o_custkey AS volume_id, coalesce(prev, 'snap-00000000000000000') AS previous_snapshot_id, 'snap-' || o_orderkey AS snapshot_id,
        cast(CASE WHEN prev IS NULL THEN (o_custkey % 100 + 1) * 1073741824 ELSE coalesce(n, 0) * 524288 END AS BIGINT) AS increment_bytes
      FROM s LEFT JOIN blocks ON l_orderkey = o_orderkey""",
)
def i06(spark: SparkSession, sf_dir: str) -> DataFrame:
    snaps = _snapshots(spark, sf_dir)
    chain = inventory.snapshot_lineage(snaps).select(
        F.col("previous_snapshot_id").alias("first_snapshot_id"), F.col("snapshot_id").alias("second_snapshot_id")
    )
    lines = t(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("snap-"), _text("l_orderkey")).alias("second_snapshot_id"), F.col("l_linenumber").alias("block_index")
    )
    changed = lines.join(chain, "second_snapshot_id")
    out = inventory.snapshot_increment(snaps, changed)
    return out.select("volume_id", "previous_snapshot_id", "snapshot_id", "increment_bytes")


def _clustered_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "snapshots")
    rows = _snapshots(spark, sf_dir)
    return clustered.write_clustered(rows, "skyledger_snapshots_" + path.rsplit("-", 1)[1], path, ["volume_id"], inventory.SNAPSHOT_ORDER)


@query("o01_i06_clustered_increment", REGISTRY["i06_snapshot_increment"].sql)
def i06_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a table clustered once; the counts of changed blocks go to its buckets."""
    snaps = _clustered_snapshots(spark, sf_dir)
    owners = t(spark, sf_dir, "orders").select(F.concat(F.lit("vol-"), _text("o_custkey")).alias("volume_id"), F.col("o_orderkey").alias("l_orderkey"))
    changed = t(spark, sf_dir, "lineitem").select("l_orderkey").join(owners, "l_orderkey")
    changed = changed.select("volume_id", F.concat(F.lit("snap-"), _text("l_orderkey")).alias("snapshot_id"))
    with clustered.clustered_plans(spark):
        out = cut_lineage(inventory.clustered_increment(snaps, changed))
    return out.select("volume_id", "previous_snapshot_id", "snapshot_id", "increment_bytes")


@query("o01_sorted_files", "SELECT count(*) AS snapshots, 0::BIGINT AS out_of_order FROM orders")
def o01_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustered table's files hold their rows in order."""
    snaps = _clustered_snapshots(spark, sf_dir)
    odd = clustered.out_of_order(snaps, ["volume_id", *inventory.SNAPSHOT_ORDER]).agg(F.count(F.lit(1)).alias("out_of_order"), F.lit(1).alias("one"))
    return snaps.agg(F.count(F.lit(1)).alias("snapshots"), F.lit(1).alias("one")).join(odd, "one").select("snapshots", "out_of_order")


@query(
    "w08_snapshot_lineage",
    "SELECT 'snap-' || o_orderkey AS snapshot_id, coalesce(lag('snap-' || o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, 'snap-' || o_orderkey), 'snap-00000000000000000') AS previous_snapshot_id FROM orders",
)
def w08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.snapshot_lineage(_snapshots(spark, sf_dir)).select("snapshot_id", "previous_snapshot_id")


@query(
    "i07_volume_growth_plan",
    """WITH m AS (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY 1)
      SELECT 'vol-' || c_custkey AS volume_id, cast(c_nationkey + 20 AS INTEGER) AS size, cast(c_nationkey + 30 AS INTEGER) AS new_size,
        last IS NULL OR TIMESTAMP '2001-08-01 12:00:00' >= last + INTERVAL 24 HOUR AS can_modify FROM customer LEFT JOIN m ON c_custkey = o_custkey""",
)
def i07(spark: SparkSession, sf_dir: str) -> DataFrame:
    volumes = t(spark, sf_dir, "customer").select(
        F.concat(F.lit("vol-"), _text("c_custkey")).alias("volume_id"), (F.col("c_nationkey") + 20).cast("int").alias("size")
    )
    changes = t(spark, sf_dir, "orders").select(
        F.concat(F.lit("vol-"), _text("o_custkey")).alias("volume_id"), F.col("o_orderdate").alias("start_time")
    )
    return inventory.volume_growth_plan(volumes, changes, datetime(2001, 8, 1, 12))


@query(
    "j15_capacity_by_type",
    """SELECT 'r-' || l_suppkey AS resource_id, l_linenumber, count(*) AS lines, max(cast(p_size AS INTEGER)) AS vcpus FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2""",
)
def j15(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = t(spark, sf_dir, "part").select(
        F.concat(F.lit("t"), _text("p_partkey"), F.lit(".large")).alias("instance_type"), F.col("p_size").alias("vcpus")
    )
    nodes = t(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("r-"), _text("l_suppkey")).alias("resource_id"), "l_linenumber",
        F.concat(F.lit("db.t"), _text("l_partkey"), F.lit(".large.elasticsearch")).alias("instance_class"),
    )
    out = inventory.resources_of_type(nodes, types, "instance_class", "db.", ".elasticsearch")
    return out.groupBy("resource_id", "l_linenumber").agg(F.count(F.lit(1)).alias("lines"), F.max("vcpus").alias("vcpus"))


@query(
    "j16_named_entities",
    """WITH e AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
      SELECT o_orderkey AS event_id, coalesce(string_agg(CASE WHEN l_suppkey % 9 = 0 THEN '-' ELSE s_name END || ' (' || 'i-' || l_suppkey || CASE WHEN l_suppkey % 9 = 0 THEN '' ELSE ', 10.0.0.' || l_suppkey END || ')', ',' ORDER BY 'i-' || l_suppkey), '') AS resource_names
      FROM orders LEFT JOIN e ON l_orderkey = o_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""",
)
def j16(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.collect_list(F.concat(F.lit("i-"), _text("l_suppkey"))).alias("resource_ids")
    )
    events = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id")).join(
        lists.withColumnRenamed("l_orderkey", "event_id"), "event_id", "left"
    )
    s = t(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 9 != 0)
    known = s.select(
        F.concat(F.lit("i-"), _text("s_suppkey")).alias("resource_id"), F.col("s_name").alias("name"),
        F.concat(F.lit("10.0.0."), _text("s_suppkey")).alias("private_ip"),
    )
    return inventory.named_entities(events, known).select("event_id", "resource_names")


@query(
    "j17_certificate_resources",
    """WITH u AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
      SELECT 'cert-' || l_orderkey AS cert_arn, CASE WHEN l_suppkey % 2 = 0 THEN 'arn:cloudfront/d' || l_suppkey ELSE 'arn:elb/' || l_suppkey END AS resource_arn,
        CASE WHEN l_suppkey % 2 = 0 THEN s_name || ',' || 'alias' || s_nationkey END AS cnames FROM u JOIN supplier ON s_suppkey = l_suppkey""",
)
def j17(spark: SparkSession, sf_dir: str) -> DataFrame:
    cdn = F.concat(F.lit("arn:cloudfront/d"), _text("l_suppkey"))
    arn = F.when(F.col("l_suppkey") % 2 == 0, cdn).otherwise(F.concat(F.lit("arn:elb/"), _text("l_suppkey")))
    certificates = t(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("cert-"), _text("l_orderkey")).alias("cert_arn")).agg(
        F.collect_list(arn).alias("in_use_by")
    ).withColumn("days_to_expiry", F.lit(30))
    distributions = t(spark, sf_dir, "supplier").select(
        F.concat(F.lit("d"), _text("s_suppkey")).alias("distribution_id"),
        F.array(F.col("s_name"), F.concat(F.lit("alias"), _text("s_nationkey"))).alias("aliases"),
    )
    return inventory.certificate_resources(certificates, distributions).select("cert_arn", "resource_arn", "cnames")


@query(
    "e09_certificate_notice",
    """WITH u AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem), r AS (SELECT l_orderkey, chr(9) || CASE WHEN l_suppkey % 2 = 0 THEN 'arn:cloudfront/d' || l_suppkey || chr(9) || '域名: ' || s_name ELSE 'arn:elb/' || l_suppkey END || chr(10) AS line FROM u JOIN supplier ON s_suppkey = l_suppkey)
      SELECT 'cert-' || l_orderkey AS cert_arn, '证书ARN: cert-' || l_orderkey || ' 将于' || (l_orderkey % 60) || '天后过期。' || chr(10) || '关联资源:' || chr(10) || string_agg(line, '' ORDER BY line) AS message FROM r GROUP BY l_orderkey""",
)
def e09(spark: SparkSession, sf_dir: str) -> DataFrame:
    arn = F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit("arn:cloudfront/d"), _text("l_suppkey"))).otherwise(
        F.concat(F.lit("arn:elb/"), _text("l_suppkey"))
    )
    certificates = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(arn).alias("in_use_by")).select(
        F.concat(F.lit("cert-"), _text("l_orderkey")).alias("cert_arn"), (F.col("l_orderkey") % 60).alias("days_to_expiry"), "in_use_by"
    )
    distributions = t(spark, sf_dir, "supplier").select(
        F.concat(F.lit("d"), _text("s_suppkey")).alias("distribution_id"), F.array("s_name").alias("aliases")
    )
    return inventory.certificate_notice(certificates, distributions).select("cert_arn", "message")


@query(
    "j19_volume_of_device",
    """SELECT 'a' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS alarm_name, 'vol-' || l_suppkey || '-' || (l_partkey % 3) AS volume_id, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def j19(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    letter = F.get(letters, (F.col("l_partkey") % 3).cast("int"))
    alarms = t(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("a"), _text("l_orderkey"), F.lit("-"), _text("l_linenumber"), F.lit("-"), _text("l_partkey")).alias("alarm_name"),
        _text("l_suppkey").alias("instance_id"),
        F.concat(F.lit("xvd"), letter, F.lit("1")).alias("device"),
    )
    mappings = t(spark, sf_dir, "supplier").select(
        _text("s_suppkey").alias("instance_id"), F.posexplode(letters).alias("n", "l")
    ).select(
        "instance_id", F.concat(F.lit("/dev/sd"), F.col("l")).alias("device_name"),
        F.concat(F.lit("vol-"), F.col("instance_id"), F.lit("-"), F.col("n").cast("string")).alias("volume_id"),
    )
    return inventory.volume_of_device(alarms, mappings).groupBy("alarm_name", "volume_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p35_disk_alarm_fields",
    """SELECT 'DiskSpace-' || event_id AS alarm_name, 'i-' || user_id AS instance_id, 'xvd' || event_type || (user_id % 4 + 1) AS device, '/dev/xvd' || event_type AS device_name,
      cast(user_id % 4 + 1 AS VARCHAR) AS partition_num, 'C' AS drive_letter FROM events WHERE event_type = 'error'""",
)
def p35(spark: SparkSession, sf_dir: str) -> DataFrame:
    device = F.concat(F.lit("xvd"), F.col("event_type"), (F.col("user_id") % 4 + 1).cast("string"))
    alarms = t(spark, sf_dir, "events").select(
        F.concat(F.lit("DiskSpace-"), _text("event_id")).alias("alarm_name"),
        F.when(F.col("event_type") == "error", F.lit("ALARM")).otherwise(F.lit("OK")).alias("state"),
        F.create_map(
            F.lit("InstanceId"), F.concat(F.lit("i-"), _text("user_id")), F.lit("device"), device, F.lit("path"), F.lit("/"),
            F.lit("fstype"), F.lit("xfs"), F.lit("instance"), F.lit("C:"),
        ).alias("dimensions"),
    )
    return inventory.disk_alarm_fields(alarms).select("alarm_name", "instance_id", "device", "device_name", "partition_num", "drive_letter")


@query(
    "a22_running_deficit",
    """WITH e AS (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') GROUP BY 1)
      SELECT 'g' || n_nationkey AS group_name, cast(n_nationkey * 10 AS BIGINT) AS needed, coalesce(n, 0) AS existing, cast(greatest(n_nationkey * 10 - coalesce(n, 0), 0) AS BIGINT) AS deficit FROM nation LEFT JOIN e ON c_nationkey = n_nationkey""",
)
def a22(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    state = F.when(segment == "BUILDING", "running").when(segment == "MACHINERY", "pending").when(segment == "HOUSEHOLD", "stopped")
    machines = t(spark, sf_dir, "customer").select(
        F.concat(F.lit("g"), _text("c_nationkey")).alias("group_name"), state.otherwise("terminated").alias("state")
    )
    wanted = t(spark, sf_dir, "nation").select(
        F.concat(F.lit("g"), _text("n_nationkey")).alias("group_name"), (F.col("n_nationkey") * 10).alias("needed")
    )
    return inventory.running_deficit(wanted, machines)


# ---- compliance -----------------------------------------------------------------------------------------------------


def tagged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer")
    segment = F.when(F.col("c_nationkey") % 3 == 0, F.lit("")).otherwise(F.col("c_mktsegment"))
    second = F.when(F.col("c_custkey") % 4 == 0, F.lit("Other")).otherwise(F.lit("Owner"))
    return c.select(
        F.concat(F.lit("region-"), _text("c_nationkey")).alias("region"),
        F.concat(F.lit("r-"), _text("c_custkey")).alias("resource_id"),
        F.lit("volume").alias("resource_type"),
        b.tag_array(("Project", segment)).alias("_one"),
        F.array(F.struct(second.alias("key"), F.col("c_name").alias("value"))).alias("_two"),
        F.col("c_custkey"),
    ).select("region", "resource_id", "resource_type", F.concat("_one", "_two").alias("tags"), "c_custkey")


_MISSING = "concat_ws(',', CASE WHEN c_nationkey % 3 = 0 THEN 'Project' END, CASE WHEN c_custkey % 4 = 0 THEN 'Owner' END)"


@query(
    "c01_required_tags",
    f"""WITH m AS (SELECT *, {_MISSING} AS missing FROM customer) SELECT 'r-' || c_custkey AS resource_id, CASE WHEN missing <> '' AND c_custkey NOT IN (0, 4) THEN 'NON_COMPLIANT' ELSE 'COMPLIANT' END AS compliance,
      CASE WHEN missing <> '' AND c_custkey NOT IN (0, 4) THEN 'r-' || c_custkey || '的以下标签不合规: ' || missing || '。' END AS annotation FROM m""",
)
def c01(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = compliance.required_tags(tagged_customers(spark, sf_dir), "Project, Owner,", "r-0,r-4")
    return out.select("resource_id", "compliance", "annotation")


@query(
    "c02_required_groups",
    """WITH m AS (SELECT *, concat_ws(',', CASE WHEN c_mktsegment <> 'BUILDING' THEN 'BUILDING' END, CASE WHEN c_nationkey % 2 <> 0 THEN 'even' END) AS missing FROM customer WHERE c_nationkey <> 5 AND c_mktsegment <> 'FURNITURE')
      SELECT c_name AS user_name, CASE WHEN missing <> '' THEN 'NON_COMPLIANT' ELSE 'COMPLIANT' END AS compliance, CASE WHEN missing <> '' THEN c_name || '不在' || missing || '组。' END AS annotation FROM m""",
)
def c02(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("c_nationkey") == 5, F.lit("Scheduled")).otherwise(F.lit("ConfigurationItemChangeNotification"))
    parity = F.when(F.col("c_nationkey") % 2 == 0, F.lit("even")).otherwise(F.lit("odd"))
    users = t(spark, sf_dir, "customer").select(
        F.col("c_name").alias("user_name"), kind.alias("message_type"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.array("c_mktsegment", parity)).alias("group_list"),
    )
    return compliance.required_groups(users, ["BUILDING", "even"]).select("user_name", "compliance", "annotation")


@query(
    "c03_tag_check_report",
    f"""WITH m AS (SELECT *, {_MISSING} AS missing FROM customer), l AS (SELECT 'region-' || c_nationkey AS region, c_custkey // 500 AS block, 'r-' || c_custkey AS rid, '区域 region-' || c_nationkey || ', 实例 r-' || c_custkey || ' 的 ' || missing || ' 标签不合规' || chr(10) AS line FROM m WHERE missing <> '')
      SELECT region, block, count(*) AS resources, string_agg(line, '' ORDER BY rid) AS message FROM l GROUP BY 1, 2""",
)
def c03(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = tagged_customers(spark, sf_dir).withColumn("block", F.floor(F.col("c_custkey") / 500).cast("long"))
    return compliance.tag_check_report(blocks, "Project,Owner", ["region", "block"])


@query(
    "a19_missing_tag_rows",
    f"WITH m AS (SELECT *, {_MISSING} AS missing FROM customer) SELECT 'region-' || c_nationkey AS region, 'r-' || c_custkey AS resource_id, missing AS missing_tags FROM m WHERE missing <> ''",
)
def a19(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compliance.missing_tags(tagged_customers(spark, sf_dir), "Project,Owner").select("region", "resource_id", "missing_tags")


def _families(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.concat(F.lit("v-"), _text("o_orderkey"))).alias("children"))
    parents = t(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey")).select(
        _text("c_custkey").alias("parent_id"),
        b.tag_array(("Project", F.col("c_mktsegment")), ("Env", F.lit("prod")), ("Name", F.col("c_name"))).alias("tags"),
        "children",
    )
    children = t(spark, sf_dir, "orders").select(
        F.concat(F.lit("v-"), _text("o_orderkey")).alias("resource_id"),
        F.when(F.col("o_orderstatus") == "F", b.tag_array(("Project", F.lit("own")))).otherwise(b.tag_array(("Other", F.lit("x")))).alias("tags"),
    )
    return parents, children


@query(
    "c04_propagate_tags",
    """SELECT 'v-' || o_orderkey AS resource_id, 'Project' AS key, c_mktsegment AS value FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'F'
      UNION ALL SELECT 'v-' || o_orderkey, 'Env', 'prod' FROM orders JOIN customer ON c_custkey = o_custkey""",
)
def c04(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents, children = _families(spark, sf_dir)
    return compliance.propagate_tags(parents, children, "Project, Env")


@query(
    "j18_copy_all_tags",
    "SELECT key, count(*) AS copies FROM (SELECT unnest(['Project', 'Env', 'Name']) AS key FROM orders JOIN customer ON c_custkey = o_custkey) GROUP BY 1",
)
def j18(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents, _ = _families(spark, sf_dir)
    return compliance.copy_all_tags(parents).groupBy("key").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "c05_fill_owner_tags",
    """SELECT 'd-' || c_custkey AS resource_id, 'Owner' AS key, 'creator-' || c_nationkey AS value FROM customer WHERE c_custkey % 2 = 0
      UNION ALL SELECT 'd-' || c_custkey, 'Project', c_mktsegment FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT 'd-' || c_custkey, 'Team', 't' FROM customer""",
)
def c05(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.col("c_custkey") % 2 != 0
    own = F.struct(F.when(odd, F.lit("Owner")).otherwise(F.lit("X")).alias("key"), F.lit("me").alias("value"))
    project = F.struct(F.lit("Project").alias("key"), F.when(F.col("c_custkey") % 3 == 0, F.lit("p")).otherwise(F.lit(" ")).alias("value"))
    resources = t(spark, sf_dir, "customer").select(
        F.concat(F.lit("d-"), _text("c_custkey")).alias("resource_id"),
        F.array(own, project).alias("tags"),
        F.concat(F.lit("creator-"), _text("c_nationkey")).alias("identity_name"),
        b.tag_array(("Project", F.col("c_mktsegment")), ("Team", F.lit("t"))).alias("identity_tags"),
    )
    return compliance.fill_owner_tags(resources, "Project,Team")


@query(
    "c06_group_catalogue",
    """SELECT 'Brand' AS key, p_brand AS value, 'Brand-' || p_brand AS group_name FROM part WHERE p_brand <> 'Brand#3' GROUP BY 2 UNION ALL SELECT 'Type', p_type, 'Type-' || p_type FROM part GROUP BY 2""",
)
def c06(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.when(F.col("p_brand") == "Brand#3", F.lit("")).otherwise(F.col("p_brand"))
    parts = t(spark, sf_dir, "part").select(
        b.tag_array(("Brand", brand), ("Type", F.col("p_type")), ("Size", F.col("p_size"))).alias("tags")
    )
    return compliance.group_catalogue(parts, "Brand, Type")


@query(
    "p26_exploded_tags",
    "SELECT key, count(*) AS n, count(DISTINCT value) AS distinct_values FROM (SELECT unnest(['Project', CASE WHEN c_custkey % 4 = 0 THEN 'Other' ELSE 'Owner' END]) AS key, unnest([CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE c_mktsegment END, c_name]) AS value FROM customer) GROUP BY 1",
)
def p26(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inventory.explode_tags(tagged_customers(spark, sf_dir), ["resource_id"])
    pairs = rows.select("key", "value").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("distinct_values"))
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(pairs, "key")
