"""Alarm queries: thresholds, definitions, capacity limits, desired alarms, reconciliation, evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import capacity
from skyledger.functions.numbers import tidy
from skyledger.operators import alarms as al
from skyledger.operators import metrics as m
from skyledger.plans import bindings as b
from skyledger.plans.bindings_sql import SAMPLES
from skyledger.plans.catalogue import RULES, rule_table
from skyledger.plans.registry import query


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return b.table(spark, sf_dir, name)


def _s(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def threshold_tags(key: str) -> Column:
    """Tags whose threshold entry is valid JSON, disabled, broken or absent, by key."""
    k = F.col(key)
    valid = F.concat(F.lit('{"CPUUtilization": '), (k % 50 + 40).cast("string"), F.lit(', "IOPS": 0.5}'))
    value = F.when(k % 4 == 0, valid).when(k % 4 == 1, "disable").when(k % 4 == 2, "{broken")
    return F.when(k % 4 == 3, b.tag_array(("Name", _s(key)))).otherwise(b.tag_array(("Name", _s(key)), ("AlarmThreshold", value)))


@query(
    "r01_resolve_threshold",
    "SELECT p_partkey, cast(CASE p_partkey % 4 WHEN 0 THEN p_partkey % 50 + 40 WHEN 1 THEN NULL ELSE 80 END AS DOUBLE) AS threshold FROM part",
)
def r01(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "part").withColumn("tags", threshold_tags("p_partkey"))
    return rows.select("p_partkey", tidy(capacity.resolve_threshold("CPUUtilization", 80)).alias("threshold"))


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definition table from regions: region 0..2 filter by segment tag, region 3 disables, the last is the default."""
    r = t(spark, sf_dir, "region")
    key = F.col("r_regionkey")
    segments = F.array(F.lit("BUILDING"), F.lit("MACHINERY"), F.lit("HOUSEHOLD"), F.lit("FURNITURE"))
    return r.select(
        F.lit("S3").alias("service"),
        F.when(key < 4, key.cast("int")).alias("filter_no"),
        F.when(key == 0, "resource_id").when(key < 4, "tag:Segment").alias("filter_key"),
        F.when(key == 0, F.array(F.lit("r-1"), F.lit("r-2"))).when(key < 4, F.array(F.get(segments, key.cast("int")))).alias("filter_values"),
        F.lit("5xxRate").alias("metric"),
        (key != 3).alias("enabled"),
        (key * 10).cast("double").alias("threshold"),
        F.lit(3).alias("severity"),
        F.lit("").alias("category"),
        F.lit("").alias("plan"),
    )


@query(
    "r02_o04_resolve_definition",
    """SELECT 'r-' || c_custkey AS resource_id, '5xxRate' AS metric, cast(CASE WHEN c_custkey IN (1, 2) THEN 0 WHEN c_mktsegment = 'MACHINERY' THEN 10 WHEN c_mktsegment = 'HOUSEHOLD' THEN 20 ELSE 40 END AS DOUBLE) AS threshold
      FROM customer WHERE c_custkey IN (1, 2) OR c_mktsegment <> 'FURNITURE'""",
)
def r02(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = t(spark, sf_dir, "customer").select(
        F.lit("S3").alias("service"), F.concat(F.lit("r-"), _s("c_custkey")).alias("resource_id"),
        b.tag_array(("Segment", F.col("c_mktsegment"))).alias("tags"),
    )
    out = al.resolve_definition(buckets, definitions(spark, sf_dir))
    return out.select("resource_id", "metric", "threshold")


@query(
    "r03_alarm_actions",
    """SELECT p_partkey, concat_ws(' ', 'topic', CASE WHEN p_size % 3 = 0 THEN 'arn:aws:ssm-incidents::acct:response-plan/plan-' || p_size WHEN p_size % 3 = 1 THEN 'arn:aws:ssm:r1:acct:opsitem:3' || CASE WHEN p_size % 2 = 0 THEN '#CATEGORY=Cost' ELSE '' END END) AS actions FROM part""",
)
def r03(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size") % 3
    plan = F.when(n == 0, F.concat(F.lit("plan-"), _s("p_size")))
    severity = F.when(n != 2, F.lit(3))
    category = F.when(F.col("p_size") % 2 == 0, F.lit("Cost")).otherwise(F.lit(""))
    actions = capacity.alarm_actions("topic", F.lit("acct"), F.lit("r1"), plan, severity, category)
    return t(spark, sf_dir, "part").select("p_partkey", F.array_join(actions, " ").alias("actions"))


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as resources of every service, with capacity fields from their size and price."""
    services = sorted({r.service for r in RULES})
    key, size = F.col("p_partkey"), F.col("p_size").cast("double")
    kinds = F.array(*[F.lit(k) for k in ("gp2", "io1", "gp3")])
    names = F.array(*[F.lit(s) for s in services])
    same = F.col("p_size") % 2 == 0
    rows = t(spark, sf_dir, "part").select(
        F.get(names, (key % len(services)).cast("int")).alias("service"),
        F.concat(F.lit("r"), _s("p_partkey")).alias("resource_id"),
        F.concat(F.lit("s"), _s(key % 9)).alias("sub_id"),
        threshold_tags("p_size").alias("tags"),
        F.when(key % 2 == 0, "in-use").otherwise("available").alias("state"),
        F.lit("subnet").alias("resource_type"),
        F.when(key % 3 == 0, "db.t3.large").otherwise("m5.large").alias("instance_type"),
        F.when(key % 5 == 0, "aurora-mysql").otherwise("mysql").alias("engine"),
        F.lit("PER_BROKER").alias("monitoring"),
        F.get(kinds, (F.col("p_size") % 3).cast("int")).alias("volume_type"),
        (size * 17).alias("size_gib"),
        (size * 500).alias("iops"),
        (size * 10).alias("throughput"),
        F.concat(F.lit("10.0.0.0/"), _s(16 + F.col("p_size") % 12)).alias("cidr"),
        (F.col("p_size") % 5).alias("data_nodes"),
        F.lit(3).alias("master_nodes"),
        F.lit(None).cast("int").alias("warm_nodes"),
        (F.col("p_size") % 8 + 1).alias("vcpus"),
        (F.col("p_size").cast("long") * 1024).alias("memory_mib"),
        (size * 400).alias("baseline_iops"),
        F.when(same, size * 400).otherwise(size * 800).alias("max_iops"),
        (size * 100).alias("baseline_mbps"),
        F.when(same, size * 100).otherwise(size * 200).alias("max_mbps"),
        F.when(F.col("p_size") % 10 != 0, size * 0.5).alias("baseline_gbps"),
        F.when(same, size * 0.5).otherwise(size).alias("peak_gbps"),
    )
    return rows


RESOURCES = """res AS (SELECT p_partkey, p_size, p_size * 17.0 AS gib, p_size * 500.0 AS iops, p_size * 10.0 AS tp, CASE p_size % 3 WHEN 0 THEN 'gp2' WHEN 1 THEN 'io1' ELSE 'gp3' END AS vt,
  p_size % 4 = 1 AS off, p_size % 4 = 0 AS tagged, p_size % 2 = 0 AS same, p_size * 400.0 AS b_iops, p_size * 100.0 * 125000 AS b_tp, p_partkey % 5 = 0 AS aurora FROM part)"""
_MIB = 1048576.0


@query(
    "r04_volume_limits",
    f"""SELECT p_partkey, cast(volume_iops AS DOUBLE) + 0 AS volume_iops, cast(volume_throughput AS DOUBLE) + 0 AS volume_throughput, cast(instance_network AS DOUBLE) + 0 AS instance_network, cast(cpu_credit AS DOUBLE) + 0 AS cpu_credit, cast(search_nodes AS DOUBLE) + 0 AS search_nodes, cast(subnet_use AS DOUBLE) + 0 AS subnet_use FROM (WITH {RESOURCES} SELECT p_partkey, round(CASE WHEN NOT off THEN CASE WHEN tagged THEN 0.5 ELSE 0.8 END * CASE vt WHEN 'gp2' THEN greatest(100, least(16000, gib * 3)) WHEN 'io1' THEN iops ELSE greatest(iops, 3000) END END, 4) + 0 AS volume_iops,
      round(CASE WHEN NOT off THEN 0.8 * CASE vt WHEN 'gp2' THEN CASE WHEN gib >= 334 THEN 250 ELSE 128 END * {_MIB} WHEN 'io1' THEN greatest(iops * 16384, 1000 * {_MIB}) ELSE greatest(tp, 125) * {_MIB} END END, 4) + 0 AS volume_throughput,
      round(CASE WHEN p_size % 10 <> 0 THEN CASE WHEN NOT off THEN CASE WHEN same THEN 0.8 ELSE 1 END END * p_size * 62500000.0 END, 2) + 0 AS instance_network,
      round(CASE WHEN NOT off THEN 30 END * (p_size % 8 + 1), 4) + 0 AS cpu_credit, cast(p_size % 5 + 3 AS DOUBLE) AS search_nodes,
      round(least(99, (pow(2, 16 - p_size % 12) - 20) * 100 / pow(2, 16 - p_size % 12)), 6) + 0 AS subnet_use FROM res)""",
)
def r04(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = capacity.capacity_limits()
    rows = al.as_resources(resources(spark, sf_dir)).withColumn("p_partkey", F.substring("resource_id", 2, 20).cast("bigint"))
    # A size divisible by ten has no network baseline; elsewhere the peak equals the base for even sizes.
    return rows.select(
        "p_partkey", tidy(limits["volume_iops"], 4).alias("volume_iops"), tidy(limits["volume_throughput"], 4).alias("volume_throughput"),
        tidy(limits["instance_network"], 2).alias("instance_network"), tidy(limits["cpu_credit_30"], 4).alias("cpu_credit"),
        limits["search_nodes"].alias("search_nodes"), tidy(limits["subnet_use"]).alias("subnet_use"),
    )


@query(
    "r04_database_limits",
    f"""SELECT p_partkey, cast(database_iops AS DOUBLE) + 0 AS database_iops, cast(database_throughput AS DOUBLE) + 0 AS database_throughput, cast(database_connections AS DOUBLE) + 0 AS database_connections FROM (WITH {RESOURCES}, d AS (SELECT *, CASE WHEN off THEN NULL WHEN same THEN 0.8 * b_iops ELSE b_iops END AS i_iops, CASE WHEN off THEN NULL WHEN same THEN 0.8 * b_tp ELSE b_tp END AS i_tp,
        greatest(100, least(16000, gib * 3)) AS g3, CASE WHEN gib >= 400 THEN 12000 ELSE 3000 END AS floor_iops, CASE WHEN gib >= 400 THEN 500 ELSE 125 END * {_MIB} AS floor_tp FROM res),
      e AS (SELECT *, CASE vt WHEN 'gp2' THEN g3 WHEN 'io1' THEN iops ELSE greatest(iops, floor_iops) END AS base, CASE vt WHEN 'gp2' THEN greatest(floor_iops, g3) WHEN 'io1' THEN iops ELSE greatest(iops, floor_iops) END AS peak,
        CASE vt WHEN 'gp2' THEN CASE WHEN gib >= 334 THEN 250 WHEN gib >= 170 THEN 50 ELSE 25.6 END * {_MIB} WHEN 'io1' THEN greatest(iops * 16384, 1000 * {_MIB}) ELSE greatest(tp * {_MIB}, floor_tp) END AS tbase,
        CASE vt WHEN 'gp2' THEN CASE WHEN gib >= 170 THEN 250 ELSE 128 END * {_MIB} WHEN 'io1' THEN greatest(iops * 16384, 1000 * {_MIB}) ELSE greatest(tp * {_MIB}, floor_tp) END AS tpeak FROM d)
      SELECT p_partkey, round(least(coalesce(i_iops, 0), CASE WHEN aurora THEN 1e13 ELSE coalesce(CASE WHEN off THEN NULL WHEN base = peak THEN 0.8 * peak ELSE base END, 1e13) END), 4) + 0 AS database_iops,
        round(least(coalesce(i_tp, 0), CASE WHEN aurora THEN 100000 * {_MIB} ELSE coalesce(CASE WHEN off THEN NULL WHEN tbase = tpeak THEN 0.8 * tpeak ELSE tbase END, 100000 * {_MIB}) END), 2) + 0 AS database_throughput,
        cast(CASE WHEN NOT off THEN trunc(0.9 * (p_size * 1024.0 - 500) * {_MIB} / 12582880) END AS DOUBLE) AS database_connections FROM e)""",
)
def r04_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = capacity.capacity_limits()
    rows = al.as_resources(resources(spark, sf_dir)).withColumn("p_partkey", F.substring("resource_id", 2, 20).cast("bigint"))
    return rows.select(
        "p_partkey", tidy(limits["database_iops"], 4).alias("database_iops"), tidy(limits["database_throughput"], 2).alias("database_throughput"),
        limits["database_connections"].alias("database_connections"),
    )


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    return repr(float(value)) if isinstance(value, float) else "'" + str(value).replace("'", "''") + "'"


SERVICES = sorted({r.service for r in RULES})
RULES_SQL = "rules(rule_id, service, name, kind, key, val, factor, applies) AS (VALUES " + ", ".join(
    "(" + ", ".join(_literal(v) for v in (r.rule_id, r.service, r.name, r.threshold.kind, r.threshold.key, r.threshold.value, r.threshold.factor, r.applies)) + ")"
    for r in RULES
) + ")"
_SERVICE_LIST = "list_value(" + ", ".join(f"'{s}'" for s in SERVICES) + ")"


@query(
    "r05_expand_rules",
    f"""SELECT alarm_name, rule_id, cast(threshold AS DOUBLE) + 0 AS threshold FROM (WITH {RULES_SQL}, r AS (SELECT *, ({_SERVICE_LIST})[p_partkey % {len(SERVICES)} + 1] AS service, p_size % 4 = 1 AS off, p_size % 4 = 0 AS tagged FROM part)
      SELECT replace(replace(name, '{{id}}', 'r' || p_partkey), '{{sub}}', 's' || (p_partkey % 9)) AS alarm_name, rule_id, round(CASE kind WHEN 'fixed' THEN val ELSE CASE WHEN tagged AND key = 'CPUUtilization' THEN p_size % 50 + 40 WHEN tagged AND key = 'IOPS' THEN 0.5 ELSE val END * factor END, 4) + 0 AS threshold
      FROM r JOIN rules USING (service) WHERE kind IN ('fixed', 'tag') AND NOT (kind = 'tag' AND off)
        AND CASE applies WHEN 'in_use' THEN p_partkey % 2 = 0 WHEN 'own_storage' THEN p_partkey % 5 <> 0 WHEN 'burstable' THEN p_partkey % 3 = 0 ELSE true END)""",
)
def r05(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = [r for r in RULES if r.threshold.kind in ("fixed", "tag")]
    out = al.expand_rules(resources(spark, sf_dir), rule_table(spark, plain))
    return out.select("alarm_name", "rule_id", tidy("threshold", 4).alias("threshold"))


@query(
    "r05_expand_all_rules",
    f"""WITH {RULES_SQL}, r AS (SELECT *, ({_SERVICE_LIST})[p_partkey % {len(SERVICES)} + 1] AS service, p_size % 4 = 1 AS off, p_size % 3 AS vt FROM part)
      SELECT rule_id, service, count(*) AS alarms FROM r JOIN rules USING (service)
      WHERE CASE applies WHEN 'in_use' THEN p_partkey % 2 = 0 WHEN 'own_storage' THEN p_partkey % 5 <> 0 WHEN 'burstable' THEN p_partkey % 3 = 0 ELSE true END
        AND CASE WHEN kind = 'fixed' THEN true WHEN kind = 'tag' THEN NOT off WHEN kind = 'defined' THEN true WHEN key IN ('search_nodes', 'subnet_use', 'plain_volume_iops') THEN true
          WHEN key LIKE 'plain_%' THEN vt IN (0, 1) WHEN key IN ('instance_network', 'database_network') THEN NOT off AND p_size % 10 <> 0 ELSE NOT off END GROUP BY 1, 2""",
)
def r05_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = al.expand_rules(resources(spark, sf_dir), rule_table(spark), rule_definitions(spark))
    return out.groupBy("rule_id", "service").agg(F.count(F.lit(1)).alias("alarms"))


def rule_definitions(spark: SparkSession) -> DataFrame:
    """Definitions of every metric that a rule of kind ``defined`` names: sub 3 has its own, the rest a default."""
    rows = []
    for r in RULES:
        if r.threshold.kind == "defined":
            rows.append((r.service, 0, "sub_id", ["s3"], r.threshold.key, True, 7.0, 3, "", ""))
            rows.append((r.service, None, None, None, r.threshold.key, True, 40.0, 3, "", ""))
    return spark.createDataFrame(rows, al.DEFINITION_SCHEMA)


@query(
    "r05_defined_rules",
    f"""WITH {RULES_SQL}, r AS (SELECT *, ({_SERVICE_LIST})[p_partkey % {len(SERVICES)} + 1] AS service FROM part)
      SELECT replace(replace(name, '{{id}}', 'r' || p_partkey), '{{sub}}', 's' || (p_partkey % 9)) AS alarm_name, rule_id,
        cast(round(CASE WHEN p_partkey % 9 = 3 THEN 7 ELSE 40 END * factor * CASE WHEN rule_id = 'AC56' THEN p_size % 8 + 1 ELSE 1 END, 4) AS DOUBLE) + 0 AS threshold
      FROM r JOIN rules USING (service) WHERE kind = 'defined' AND CASE applies WHEN 'burstable' THEN p_partkey % 3 = 0 ELSE true END""",
)
def r05_defined(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = [r for r in RULES if r.threshold.kind == "defined"]
    out = al.expand_rules(resources(spark, sf_dir), rule_table(spark, chosen), rule_definitions(spark))
    return out.select("alarm_name", "rule_id", tidy("threshold", 4).alias("threshold"))


@query(
    "a18_plan_text",
    """WITH w AS (SELECT DISTINCT 'AWS/X-' || p_brand || '-' || p_size AS n FROM part WHERE p_type <> 'PROMO'), h AS (SELECT DISTINCT 'AWS/X-' || p_brand || '-' || p_size AS n FROM part WHERE p_type <> 'SMALL'),
      a AS (SELECT coalesce(w.n, h.n) AS alarm_name, CASE WHEN h.n IS NULL THEN 'create' WHEN w.n IS NULL THEN 'delete' END AS action FROM w FULL JOIN h ON w.n = h.n)
      SELECT alarm_name, action, CASE action WHEN 'create' THEN 'Create' ELSE 'Delete' END || ' alarm ' || alarm_name AS line FROM a WHERE action IS NOT NULL""",
)
def a18_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.plan_text(reconciled(spark, sf_dir))


@query(
    "r06_j14_reconcile",
    """WITH w AS (SELECT DISTINCT 'AWS/X-' || p_brand || '-' || p_size AS n FROM part WHERE p_type <> 'PROMO'), h AS (SELECT DISTINCT 'AWS/X-' || p_brand || '-' || p_size AS n FROM part WHERE p_type <> 'SMALL')
      SELECT coalesce(w.n, h.n) AS alarm_name, CASE WHEN h.n IS NULL THEN 'create' WHEN w.n IS NULL THEN 'delete' ELSE 'keep' END AS action FROM w FULL JOIN h ON w.n = h.n""",
)
def r06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconciled(spark, sf_dir)


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = t(spark, sf_dir, "part")
    name = F.concat(F.lit("AWS/X-"), F.col("p_brand"), F.lit("-"), _s("p_size"))
    desired = parts.where(F.col("p_type") != "PROMO").select(name.alias("alarm_name"))
    existing = parts.where(F.col("p_type") != "SMALL").select(name.alias("alarm_name")).unionByName(
        parts.select(F.concat(F.lit("manual-"), F.col("p_brand")).alias("alarm_name"))
    )
    return al.reconcile(desired, existing, ["AWS/X-"])


@query(
    "a18_u07_plan_summary",
    """WITH w AS (SELECT DISTINCT p_brand || '-' || p_size AS n FROM part WHERE p_type <> 'PROMO'), h AS (SELECT DISTINCT p_brand || '-' || p_size AS n FROM part WHERE p_type <> 'SMALL')
      SELECT CASE WHEN h.n IS NULL THEN 'create' WHEN w.n IS NULL THEN 'delete' ELSE 'keep' END AS action, count(*) AS alarms FROM w FULL JOIN h ON w.n = h.n GROUP BY 1""",
)
def a18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.plan_summary(reconciled(spark, sf_dir))


def daily_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alarm per user: daily sum of click values over a threshold, two of three days, policy by user."""
    users = t(spark, sf_dir, "events").select("user_id").distinct()
    return users.select(
        F.concat(F.lit("a-"), _s("user_id")).alias("alarm_name"), F.concat(F.lit("r-"), _s("user_id")).alias("resource_id"),
        F.array(F.lit("click"), F.lit("view")).alias("metrics"), F.array(F.lit("Sum"), F.lit("Average")).alias("statistics"), F.lit("m1").alias("expression"),
        F.lit(86400).alias("period"), F.lit(2).alias("datapoints"), F.lit(3).alias("periods"),
        F.when(F.col("user_id") % 2 == 0, ">=").otherwise("<").alias("comparison"), (F.lit(20.0) + F.col("user_id") % 60).alias("threshold"),
        F.when(F.col("user_id") % 3 == 0, "ignore").otherwise("missing").alias("missing"),
    )


EVALUATED = f"""{SAMPLES}, p AS (SELECT user_id, epoch // 86400 * 86400 AS period_start, sum(value) FILTER (metric = 'click') AS value FROM samples WHERE metric IN ('click', 'view') GROUP BY 1, 2),
  x AS (SELECT user_id, min(period_start) AS lo, max(period_start) AS hi FROM p GROUP BY 1), g AS (SELECT user_id, unnest(generate_series(lo, hi, 86400)) AS period_start FROM x),
  b AS (SELECT g.user_id, g.period_start, value, cast(CASE WHEN g.user_id % 2 = 0 THEN value >= 20.0 + g.user_id % 60 ELSE value < 20.0 + g.user_id % 60 END AS INTEGER) AS br FROM g LEFT JOIN p ON p.user_id = g.user_id AND p.period_start = g.period_start),
  c AS (SELECT *, cast(coalesce(sum(br) OVER w3, 0) AS INTEGER) AS breaches, cast(count(br) OVER w3 AS INTEGER) AS present FROM b WINDOW w3 AS (PARTITION BY user_id ORDER BY period_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
  k AS (SELECT *, CASE WHEN breaches >= 2 THEN 'ALARM' WHEN present > 0 THEN 'OK' END AS known FROM c),
  s AS (SELECT *, coalesce(CASE WHEN user_id % 3 = 0 THEN last_value(known IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY period_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ELSE known END, 'INSUFFICIENT_DATA') AS state FROM k),
  f AS (SELECT 'a-' || user_id AS alarm_name, period_start, round(value, 6) + 0 AS value, breaches, present, state, lag(state) OVER (PARTITION BY user_id ORDER BY period_start) AS previous_state FROM s)"""


@query("r07_w06_t07_evaluate_alarms", f"WITH {EVALUATED} SELECT alarm_name, period_start, value, breaches, present, state, previous_state FROM f")
def r07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluated(spark, sf_dir).withColumn("value", tidy("value"))


def evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    alarms = daily_alarms(spark, sf_dir)
    points = al.alarm_points(b.event_samples(spark, sf_dir).select("resource_id", "metric", "epoch", "value"), alarms)
    return al.evaluate_alarms(points, alarms)


COMPLETE = f"""{SAMPLES}, p AS (SELECT user_id, epoch // 86400 * 86400 AS period_start, sum(value) AS value FROM samples WHERE metric = 'click' AND user_id % 3 <> 1 GROUP BY 1, 2),
  u AS (SELECT DISTINCT user_id FROM events), z AS (SELECT (max(epoch) + 259200) // 86400 * 86400 AS hi FROM samples),
  g AS (SELECT u.user_id, unnest(generate_series(coalesce((SELECT min(period_start) FROM p WHERE p.user_id = u.user_id), hi), hi, 86400)) AS period_start FROM u, z),
  b AS (SELECT g.user_id, g.period_start, p.value, cast(CASE WHEN g.user_id % 2 = 0 THEN p.value >= 20.0 + g.user_id % 60 ELSE p.value < 20.0 + g.user_id % 60 END AS INTEGER) AS br FROM g LEFT JOIN p ON p.user_id = g.user_id AND p.period_start = g.period_start),
  c AS (SELECT *, cast(coalesce(sum(br) OVER w, 0) AS INTEGER) AS breaches, cast(count(br) OVER w AS INTEGER) AS present FROM b WINDOW w AS (PARTITION BY user_id ORDER BY period_start ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)),
  k AS (SELECT *, CASE WHEN breaches >= 3 THEN 'ALARM' WHEN present > 0 THEN 'OK' END AS known FROM c)
  SELECT 'a-' || user_id AS alarm_name, period_start, breaches, present,
    coalesce(CASE WHEN user_id % 3 = 0 THEN last_value(known IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY period_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ELSE known END, 'INSUFFICIENT_DATA') AS state FROM k"""


@query("r07_alarms_without_samples", f"WITH {COMPLETE}")
def r07_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of eight days; a third of the alarms watch a resource without samples, and all metrics stop before the end."""
    alarms = daily_alarms(spark, sf_dir).withColumn("periods", F.lit(8)).withColumn("datapoints", F.lit(3))
    number = F.substring("resource_id", 3, 20).cast("int")
    alarms = alarms.withColumn("resource_id", F.when(number % 3 == 1, F.lit("silent")).otherwise(F.col("resource_id")))
    alarms = alarms.withColumn("metrics", F.array(F.lit("click"))).withColumn("statistics", F.array(F.lit("Sum")))
    samples = b.event_samples(spark, sf_dir).select("resource_id", "metric", "epoch", "value")
    as_of = samples.agg(F.max("epoch")).first()[0] + 3 * 86400
    out = al.evaluate_alarms(al.alarm_points(samples, alarms), alarms, as_of=as_of)
    return out.select("alarm_name", "period_start", "breaches", "present", "state")


@query(
    "r07_six_metric_sum",
    f"""WITH {SAMPLES}, p AS (SELECT user_id, epoch // 86400 * 86400 AS period_start, sum(value) FILTER (metric = 'click') AS a, avg(value) FILTER (metric = 'click') AS b, min(value) FILTER (metric = 'click') AS c, max(value) FILTER (metric = 'click') AS d,
        sum(value) FILTER (metric = 'view') AS e, cast(count(*) FILTER (metric = 'view') AS DOUBLE) AS f, count(*) FILTER (metric = 'view') AS n FROM samples WHERE metric IN ('click', 'view') GROUP BY 1, 2)
      SELECT 'a-' || user_id AS alarm_name, period_start, round(CASE WHEN n > 0 THEN a + b + c + d + e + f END / CASE WHEN user_id % 2 = 0 THEN 1 ELSE 86400 END, 6) + 0 AS value FROM p""",
)
def r07_six(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.substring("resource_id", 3, 20).cast("int") % 2 == 0
    names, kinds = ("click",) * 4 + ("view",) * 2, ("Sum", "Average", "Minimum", "Maximum", "Sum", "SampleCount")
    alarms = daily_alarms(spark, sf_dir).withColumns({
        "metrics": F.array(*map(F.lit, names)), "statistics": F.array(*map(F.lit, kinds)),
        "expression": F.when(even, "m1+m2+m3+m4+m5+m6").otherwise("(m1+m2+m3+m4+m5+m6)/PERIOD"),
    })
    points = al.alarm_points(b.event_samples(spark, sf_dir).select("resource_id", "metric", "epoch", "value"), alarms)
    return points.select("alarm_name", "period_start", tidy("value").alias("value"))


@query("w07_state_changes", f"WITH {EVALUATED} SELECT alarm_name, period_start, state, previous_state FROM f WHERE previous_state IS NOT NULL AND state <> previous_state")
def w07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.transitions(evaluated(spark, sf_dir)).select("alarm_name", "period_start", "state", "previous_state")


@query(
    "r07_metric_math_points",
    f"""WITH {SAMPLES}, p AS (SELECT user_id, epoch // 86400 * 86400 AS period_start, sum(value) FILTER (metric = 'click') AS m1, sum(value) FILTER (metric = 'view') AS m2 FROM samples WHERE metric IN ('click', 'view') GROUP BY 1, 2)
      SELECT 'a-' || user_id AS alarm_name, period_start, round(CASE user_id % 4 WHEN 0 THEN (m1 + m2) / 86400 WHEN 1 THEN m1 / nullif(m2, 0) * 100 WHEN 2 THEN greatest(m1, m2) ELSE m1 - lag(m1) OVER (PARTITION BY user_id ORDER BY period_start) END, 6) + 0 AS value FROM p""",
)
def r07_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.substring("resource_id", 3, 20).cast("int") % 4
    expression = F.when(n == 0, "(m1+m2)/PERIOD").when(n == 1, "m1/m2*100").when(n == 2, "MAX(m1,m2)").otherwise("DIFF(m1)")
    alarms = daily_alarms(spark, sf_dir).withColumn("statistics", F.array(F.lit("Sum"), F.lit("Sum"))).withColumn("expression", expression)
    points = al.alarm_points(b.event_samples(spark, sf_dir).select("resource_id", "metric", "epoch", "value"), alarms)
    return points.select("alarm_name", "period_start", tidy("value").alias("value"))


@query(
    "r07_dense_grid",
    f"""WITH {SAMPLES}, p AS (SELECT DISTINCT user_id, epoch // 3600 * 3600 AS w FROM samples), x AS (SELECT user_id, min(w) AS lo, max(w) AS hi FROM p GROUP BY 1)
      SELECT 'r-' || user_id AS resource_id, cast((hi - lo) // 3600 + 1 AS BIGINT) AS periods, (SELECT count(*) FROM p WHERE p.user_id = x.user_id) AS present FROM x""",
)
def r07_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = m.resample(b.event_samples(spark, sf_dir), ["resource_id"], 3600, "Sum").withColumn("period", F.lit(3600))
    grid = al.dense_grid(points, "resource_id")
    return grid.groupBy("resource_id").agg(F.count(F.lit(1)).alias("periods"), F.count("value").alias("present"))


@query(
    "f11_rule_filters",
    f"""WITH {RULES_SQL}, r AS (SELECT *, ({_SERVICE_LIST})[p_partkey % {len(SERVICES)} + 1] AS service FROM part)
      SELECT rule_id, count(*) AS resources FROM r JOIN rules USING (service) WHERE applies <> '' AND kind = 'fixed' AND CASE applies WHEN 'in_use' THEN p_partkey % 2 = 0 ELSE true END GROUP BY 1""",
)
def f11(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = [r for r in RULES if r.applies and r.threshold.kind == "fixed"]
    out = al.expand_rules(resources(spark, sf_dir), rule_table(spark, chosen))
    return out.groupBy("rule_id").agg(F.count(F.lit(1)).alias("resources"))
