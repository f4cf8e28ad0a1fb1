"""Event queries: events wrapped as JSON envelopes, flattened, routed and turned into notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.timefns import in_quiet_window
from skyledger.operators import alarms as al
from skyledger.operators import events as ev
from skyledger.operators import metrics as m
from skyledger.operators import notify, patterns
from skyledger.plans import bindings as b
from skyledger.plans.registry import REGISTRY, query


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return b.table(spark, sf_dir, name)


def _s(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def envelope(source: Column, kind: Column, detail: Column, resources: Column | None = None) -> Column:
    """Event text as the bus delivers it."""
    return F.to_json(
        F.struct(
            _s("event_id").alias("id"), source.alias("source"), kind.alias("detail-type"), F.concat(F.lit("a"), (F.col("user_id") % 3).cast("string")).alias("account"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"), F.concat(F.lit("r"), (F.col("user_id") % 5).cast("string")).alias("region"),
            (resources if resources is not None else F.array(F.concat(F.lit("i-"), _s("user_id")))).alias("resources"), detail.alias("detail"),
        )
    )


def enveloped(spark: SparkSession, sf_dir: str, source: Column, kind: Column, detail: Column) -> DataFrame:
    rows = t(spark, sf_dir, "events").select(envelope(source, kind, detail).alias("value"))
    return ev.read_envelopes(rows)


_NAMES = ["EC2-i-High-CPUUtilization-Alarm", "RDS-db-High-IOPS-Alarm", "ElasticSearch-es-Low-Nodes-Alarm", "CloudFront-E1-High-Requests-Alarm", "Other-thing"]


def _alarm_name() -> Column:
    names = F.array(*[F.lit(n) for n in _NAMES])
    return F.get(names, (F.col("user_id") % 5).cast("int"))


ALARM_NAME_SQL = "(list_value(" + ", ".join(f"'{n}'" for n in _NAMES) + "))[user_id % 5 + 1]"


def alarm_detail() -> Column:
    k = F.get_json_object("props", "$.k").cast("double")
    state = F.when(F.col("event_type") == "error", "ALARM").when(F.col("event_type") == "view", "INSUFFICIENT_DATA").otherwise("OK")
    data = F.when(F.col("event_type") != "signup", F.to_json(F.struct(F.lit("1.0").alias("version"), F.array(k, k + 1).alias("recentDatapoints"))))
    metric = F.struct(
        F.lit("AWS/X").alias("namespace"), F.lit("CPUUtilization").alias("name"),
        F.create_map(F.lit("InstanceId"), F.concat(F.lit("i-"), _s("user_id"))).alias("dimensions"),
    )
    stat = F.struct(metric.alias("metric"), F.lit(300).alias("period"), F.lit("Average").alias("stat"))
    return F.struct(
        _alarm_name().alias("alarmName"),
        F.struct(state.alias("value"), F.concat(F.lit("crossed "), F.col("event_type")).alias("reason"), data.alias("reasonData")).alias("state"),
        F.struct(F.when(F.col("user_id") % 2 == 0, "ALARM").otherwise("OK").alias("value")).alias("previousState"),
        F.struct(F.array(F.struct(F.lit("m1").alias("id"), stat.alias("metricStat"))).alias("metrics")).alias("configuration"),
    )


def alarm_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = envelope(F.lit("aws.cloudwatch"), F.lit("CloudWatch Alarm State Change"), alarm_detail())
    landed = b.landed_lines(spark, sf_dir, "alarm-events", t(spark, sf_dir, "events").select(body.alias("line")), packed=True)
    return ev.flatten_alarm_event(ev.read_envelopes(landed, "line"))


ALARM_SQL = f"""alarm AS (SELECT cast(event_id AS VARCHAR) AS id, 'a' || (user_id % 3) AS account, 'r' || (user_id % 5) AS region, {ALARM_NAME_SQL} AS alarm_name,
  strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+0800' AS timestamp, strftime(ts + INTERVAL 8 HOUR, '%H:%M:%S') AS time, split_part({ALARM_NAME_SQL}, '-', 1) AS object_type,
  CASE event_type WHEN 'error' THEN 'ALARM' WHEN 'view' THEN 'INSUFFICIENT_DATA' ELSE 'OK' END AS current_state, CASE WHEN user_id % 2 = 0 THEN 'ALARM' ELSE 'OK' END AS previous_state,
  'crossed ' || event_type AS reason, CASE WHEN event_type <> 'signup' THEN cast(json_extract(props, '$.k') AS DOUBLE) END AS alarm_value, 'i-' || user_id AS resource_id FROM events)"""


@query("e01_alarm_events", f"WITH {ALARM_SQL} SELECT id, account, region, alarm_name, timestamp, time, object_type, current_state, previous_state, reason, alarm_value, resource_id FROM alarm")
def e01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alarm_events(spark, sf_dir).select(
        "id", "account", "region", "alarm_name", "timestamp", "time", "object_type", "current_state", "previous_state", "reason", "alarm_value",
        F.col("dimensions")["InstanceId"].alias("resource_id"),
    )


@query(
    "e02_health_events",
    """SELECT cast(event_id AS VARCHAR) AS id, CASE WHEN user_id % 2 = 0 THEN 'EC2' ELSE 'RDS' END AS service, event_type AS event_type_code, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+0800' AS timestamp,
      'text ' || event_id AS description, 'i-' || user_id || ',i-' || (user_id + 1) AS entities FROM events""",
)
def e02(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = health_events(spark, sf_dir)
    return out.select("id", "service", "event_type_code", "timestamp", "description", F.array_join("entity_ids", ",").alias("entities"))


def health_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    def entity(n: Column) -> Column:
        return F.struct(F.concat(F.lit("i-"), _s(n)).alias("entityValue"))

    detail = F.struct(
        F.when(F.col("user_id") % 2 == 0, "EC2").otherwise("RDS").alias("service"), F.col("event_type").alias("eventTypeCode"),
        F.lit("scheduledChange").alias("eventTypeCategory"), F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")).alias("startTime"),
        F.array(F.struct(F.lit("en_US").alias("language"), F.concat(F.lit("text "), _s("event_id")).alias("latestDescription"))).alias("eventDescription"),
        F.array(entity(F.col("user_id")), entity(F.col("user_id") + 1)).alias("affectedEntities"),
    )
    return ev.flatten_health_event(enveloped(spark, sf_dir, F.lit("aws.health"), F.lit("AWS Health Event"), detail))


@query(
    "e03_compliance_events",
    """SELECT cast(event_id AS VARCHAR) AS id, 'type-' || event_type AS resource_type, 'res-' || user_id AS resource_id, 'rule-' || (user_id % 4) AS rule_name, CASE WHEN user_id % 2 = 0 THEN 'note ' || user_id END AS annotation,
      strftime(ts + INTERVAL 8 HOUR, '%H:%M:%S') AS time FROM events""",
)
def e03(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.struct(
        F.lit("NON_COMPLIANT").alias("complianceType"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("resultRecordedTime"),
        F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("note "), _s("user_id"))).alias("annotation"),
    )
    detail = F.struct(
        F.concat(F.lit("res-"), _s("user_id")).alias("resourceId"), F.concat(F.lit("type-"), F.col("event_type")).alias("resourceType"),
        F.concat(F.lit("rule-"), (F.col("user_id") % 4).cast("string")).alias("configRuleName"), result.alias("newEvaluationResult"),
    )
    out = ev.flatten_compliance_event(enveloped(spark, sf_dir, F.lit("aws.config"), F.lit("Config Rules Compliance Change"), detail))
    return out.select("id", "resource_type", "resource_id", "rule_name", "annotation", "time")


@query(
    "e04_security_findings",
    """SELECT cast(event_id AS VARCHAR) AS id, CASE WHEN event_type = 'error' THEN 'Backdoor:EC2/C&CActivity.B!DNS' ELSE 'Recon:' || event_type END AS finding_type, CASE WHEN user_id % 2 = 0 THEN 'Instance' ELSE 'AccessKey' END AS resource_type,
      CASE WHEN user_id % 2 = 0 THEN 'i-' || user_id END AS instance_id, CASE WHEN event_type = 'error' THEN 'd' || user_id || '.example' END AS domain FROM events""",
)
def e04(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", ev.DNS_FINDINGS[0]).otherwise(F.concat(F.lit("Recon:"), F.col("event_type")))
    detail = F.struct(
        kind.alias("type"), F.lit("text").alias("description"),
        F.struct(
            F.when(F.col("user_id") % 2 == 0, "Instance").otherwise("AccessKey").alias("resourceType"),
            F.struct(F.concat(F.lit("i-"), _s("user_id")).alias("instanceId")).alias("instanceDetails"),
        ).alias("resource"),
        F.struct(F.struct(F.struct(F.concat(F.lit("d"), _s("user_id"), F.lit(".example")).alias("domain")).alias("dnsRequestAction")).alias("action")).alias("service"),
    )
    out = ev.flatten_security_finding(enveloped(spark, sf_dir, F.lit("aws.guardduty"), F.lit("GuardDuty Finding"), detail))
    return out.select("id", "finding_type", "resource_type", "instance_id", "domain")


@query(
    "e05_cache_events",
    "SELECT event_id, CASE WHEN event_type <> 'view' THEN 'ElastiCache:' || event_type ELSE '' END AS detail_type, CASE WHEN event_type <> 'view' THEN 'node-' || user_id ELSE '' END AS resource FROM events",
)
def e05(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("event_type") == "view", F.lit("Note")).otherwise(F.concat(F.lit("ElastiCache:"), F.col("event_type")))
    message = F.to_json(F.map_from_arrays(F.array(F.lit("Zone"), key), F.array(F.lit("z"), F.concat(F.lit("node-"), _s("user_id")))))
    rows = t(spark, sf_dir, "events").select("event_id", message.alias("message"))
    return ev.flatten_cache_event(rows).select("event_id", "detail_type", "resource")


def internet_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.to_json(
        F.struct(
            F.concat(F.lit("e-"), _s("user_id")).alias("EventId"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("StartedAt"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("EndedAt"), F.lit("PERFORMANCE").alias("EventType"),
            F.when(F.col("event_type") == "click", "RESOLVED").otherwise("ACTIVE").alias("EventStatus"),
            F.struct(F.lit("AS").alias("ASName"), F.col("user_id").alias("ASNumber"), F.lit("JP").alias("Country"), F.col("event_type").alias("City"), F.col("value").alias("Latitude")).alias("ClientLocation"),
        )
    )
    rows = t(spark, sf_dir, "events").select(body.alias("value"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("refreshed"), "event_id")
    return ev.flatten_internet_event(rows, F.col("refreshed"))


@query(
    "e06_internet_events",
    "SELECT 'e-' || user_id AS \"EventId\", strftime(ts, '%Y-%m-%d %H:%M:%S') AS \"StartedAt\", user_id AS \"ASNumber\", event_type AS \"City\", value AS \"Latitude\", CASE WHEN event_type = 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS \"EndedAt\" FROM events",
)
def e06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return internet_snapshots(spark, sf_dir).select("EventId", "StartedAt", "ASNumber", "City", "Latitude", "EndedAt")


@query(
    "e10_latest_event_state",
    "SELECT 'e-' || user_id AS \"EventId\", arg_max(event_type, ts) AS \"City\", arg_max(CASE WHEN event_type = 'click' THEN 'RESOLVED' ELSE 'ACTIVE' END, ts) AS \"EventStatus\" FROM events GROUP BY user_id",
)
def e10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.latest_event_state(internet_snapshots(spark, sf_dir)).select("EventId", "City", "EventStatus")


@query(
    "e10_last_per_user",
    "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1",
)
def e10_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ev.last_per_key(t(spark, sf_dir, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return out.select("user_id", "event_id", "event_type")


def audit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    name = F.when(kind.isin("click", "view"), "ConsoleLogin").when(kind == "purchase", "CreateDBInstance").when(kind == "signup", "DeleteDBInstanceAutomatedBackup").otherwise("RunInstances")
    ip = F.when(F.col("user_id") % 10 == 0, F.lit("ec2.amazonaws.com")).otherwise(F.concat(F.lit("10.0."), (F.col("user_id") % 4).cast("string"), F.lit(".7")))
    return t(spark, sf_dir, "events").select(
        "event_id", name.alias("event_name"), F.when(kind == "click", "Root").otherwise("IAMUser").alias("user_type"),
        F.when(kind != "click", F.concat(F.lit("u"), _s("user_id"))).alias("user_name"), ip.alias("source_ip"),
    )


@query(
    "e07_u08_audit_findings",
    """WITH f AS (SELECT event_id, 'AWS Root account login' AS finding FROM events WHERE event_type = 'click'
      UNION ALL SELECT event_id, 'Login from untrusted IP' FROM events WHERE event_type IN ('click', 'view') AND (user_id % 10 = 0 OR user_id % 4 IN (2, 3))
      UNION ALL SELECT event_id, 'Unauthorized user create/delte RDS DB Instance' FROM events WHERE event_type IN ('purchase', 'signup') AND user_id NOT IN (1, 2)
      UNION ALL SELECT event_id, 'Unauthorized user start EC2 Instance' FROM events WHERE event_type = 'error' AND user_id NOT IN (3)) SELECT event_id, finding FROM f""",
)
def e07(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ev.audit_findings(audit_records(spark, sf_dir), ["10.0.0.0/23", " 10.0.9.9 "], ["u1", " u2 "], ["u3"])
    return out.select("event_id", "finding")


@query(
    "e08_workflow_failures",
    """SELECT cast(event_id AS VARCHAR) AS id, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'TIMED_OUT' END AS status, 'run-' || event_id AS execution, strftime(ts + INTERVAL 8 HOUR, '%H:%M:%S') AS time,
      'https://console.aws.amazon.com/states/home?region=r' || (user_id % 5) || '#/executions/details/run-' || event_id AS link FROM events WHERE event_type IN ('error', 'signup')""",
)
def e08(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "signup", "TIMED_OUT").otherwise("SUCCEEDED")
    detail = F.struct(status.alias("status"), F.concat(F.lit("run-"), _s("event_id")).alias("executionArn"), F.lit("sm").alias("stateMachineArn"))
    out = ev.workflow_failures(enveloped(spark, sf_dir, F.lit("aws.states"), F.lit("Step Functions Execution Status Change"), detail))
    return out.select("id", "status", "execution", "time", "link")


@query(
    "p39_p42_distribution_changes",
    """SELECT cast(event_id AS VARCHAR) AS id, CASE event_type WHEN 'click' THEN 'created' WHEN 'view' THEN 'updated' ELSE 'deleted' END AS operation, 'E' || user_id AS distribution_id,
      CASE WHEN event_type IN ('click', 'view') THEN 'a' || user_id || '/b.example' ELSE '' END AS domain_name, CASE WHEN user_id % 2 = 0 THEN 'u' || user_id WHEN user_id % 3 = 0 THEN 'role' || user_id END AS identity_name FROM events""",
)
def p42(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, user = F.col("event_type"), _s("user_id")
    name = F.when(kind == "click", "CreateDistributionWithTags").when(kind == "view", "UpdateDistribution").otherwise("DeleteDistribution")
    alive = kind.isin("click", "view")
    dist = F.struct(
        F.concat(F.lit("E"), user).alias("id"), F.lit("arn").alias("aRN"),
        F.struct(F.struct(F.array(F.lit("b.example"), F.concat(F.lit("a"), user)).alias("items")).alias("aliases")).alias("distributionConfig"),
    )
    who = F.when(F.col("user_id") % 2 == 0, "IAMUser").when(F.col("user_id") % 3 == 0, "IAMRole").otherwise("Root")
    identity = F.struct(
        who.alias("type"), F.concat(F.lit("u"), user).alias("userName"),
        F.struct(F.struct(F.concat(F.lit("role"), user).alias("userName")).alias("sessionIssuer")).alias("sessionContext"),
    )
    detail = F.struct(
        name.alias("eventName"), F.when(alive, F.struct(dist.alias("distribution"))).alias("responseElements"),
        F.when(~alive, F.struct(F.concat(F.lit("E"), user).alias("id"))).alias("requestParameters"), identity.alias("userIdentity"),
    )
    out = ev.distribution_changes(enveloped(spark, sf_dir, F.lit("aws.cloudfront"), F.lit("AWS API Call via CloudTrail"), detail))
    return out.select("id", "operation", "distribution_id", "domain_name", "identity_name")


@query(
    "p42_database_changes",
    "SELECT cast(event_id AS VARCHAR) AS id, CASE event_type WHEN 'click' THEN 'created' WHEN 'view' THEN 'restored' WHEN 'error' THEN 'deleted' ELSE 'storage_changed' END AS operation, 'db-' || user_id AS db_instance FROM events WHERE event_type <> 'signup'",
)
def p42_db(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    code = F.when(kind == "click", "RDS-EVENT-0005").when(kind == "view", "RDS-EVENT-0043").when(kind == "error", "RDS-EVENT-0003").when(kind == "purchase", "RDS-EVENT-0017").otherwise("RDS-EVENT-9999")
    detail = F.struct(code.alias("EventID"), F.concat(F.lit("arn:aws:rds:r:db:db-"), _s("user_id")).alias("SourceIdentifier"))
    return ev.database_changes(enveloped(spark, sf_dir, F.lit("aws.rds"), F.lit("RDS DB Instance Event"), detail))


@query(
    "f01_pattern_routing",
    """WITH r AS (SELECT event_id, 'workflow_status' AS route FROM events WHERE event_type = 'error' UNION ALL SELECT event_id, 'volume' FROM events WHERE event_type = 'click' AND user_id % 2 = 0
      UNION ALL SELECT event_id, 'compliance' FROM events WHERE event_type = 'view' UNION ALL SELECT event_id, 'custom' FROM events WHERE event_type IN ('error', 'signup')) SELECT cast(event_id AS VARCHAR) AS id, route FROM r""",
)
def f01(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = dict(ev.PATTERNS)
    rules["custom"] = {"source": [{"prefix": "ops."}, {"prefix": "aws.sta"}]}
    return ev.route_events(_routed_events(spark, sf_dir), rules).select("id", "route")


def _routed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    source = F.when(kind == "error", "aws.states").when(kind == "click", "aws.ec2").when(kind == "view", "aws.config").when(kind == "signup", "ops.signup").otherwise("aws.s3")
    label = F.when(kind == "error", "Step Functions Execution Status Change").when(kind == "click", "AWS API Call via CloudTrail").otherwise("Config Rules Compliance Change")
    detail = F.struct(
        F.lit("FAILED").alias("status"), F.lit("ec2.amazonaws.com").alias("eventSource"),
        F.when(F.col("user_id") % 2 == 0, "AttachVolume").otherwise("RunInstances").alias("eventName"),
        F.lit("ComplianceChangeNotification").alias("messageType"), F.struct(F.lit("NON_COMPLIANT").alias("complianceType")).alias("newEvaluationResult"),
    )
    return enveloped(spark, sf_dir, source, label, detail)


@query(
    "f01_pattern_table",
    """WITH e AS (SELECT event_id, user_id, event_type FROM events), c AS (SELECT DISTINCT user_id FROM events)
      SELECT cast(event_id AS VARCHAR) AS id, 'user-' || user_id AS route FROM e WHERE event_type IN ('click', 'view') AND user_id % 3 <> 0
      UNION ALL SELECT cast(e.event_id AS VARCHAR), 'begins-' || c.user_id FROM e JOIN c ON starts_with('u' || e.user_id, 'u' || c.user_id) AND c.user_id % 3 = 0 WHERE e.event_type = 'error'""",
)
def f01_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pattern for every user, all of one source: by the user's name, or, for every third, by its beginning."""
    users = b.table(spark, sf_dir, "events").select("user_id").distinct()
    named, third = F.concat(F.lit("u"), _s("user_id")), F.col("user_id") % 3 == 0
    route = F.concat(F.when(third, F.lit("begins-")).otherwise(F.lit("user-")), _s("user_id"))
    kinds = F.when(third, F.array(F.lit("error"))).otherwise(F.array(F.lit("click"), F.lit("view")))
    base = users.select(route.alias("route"), named.alias("name"), third.alias("third"), kinds.alias("kinds"))
    no = F.lit(False)
    table = base.select("route", F.lit("source").alias("path"), F.lit("ops.").alias("value"), F.lit(True).alias("prefix"))
    table = table.unionByName(base.select("route", F.lit("detail_type").alias("path"), F.explode("kinds").alias("value"), no.alias("prefix")))
    table = table.unionByName(base.select("route", F.lit("detail.who.name").alias("path"), F.col("name").alias("value"), F.col("third").alias("prefix")))
    detail = F.struct(F.struct(named.alias("name")).alias("who"), F.lit(1).alias("n"))
    return patterns.route_by_table(enveloped(spark, sf_dir, F.lit("ops.app"), F.col("event_type"), detail), table).select("id", "route")


@query(
    "f01_pattern_table_of_rules",
    REGISTRY["f01_pattern_routing"].sql,
)
def f01_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of ``f01_pattern_routing``, as a table."""
    rules = dict(ev.PATTERNS)
    rules["custom"] = {"source": [{"prefix": "ops."}, {"prefix": "aws.sta"}]}
    return patterns.route_by_table(_routed_events(spark, sf_dir), patterns.pattern_table(spark, rules)).select("id", "route")


@query(
    "f02_alarm_routes",
    f"WITH {ALARM_SQL} SELECT CASE WHEN object_type = 'CloudFront' THEN 'cdn' WHEN alarm_name LIKE 'ElasticSearch-%' THEN 'search' WHEN alarm_name LIKE 'RDS-%' THEN 'database' WHEN object_type = 'EC2' THEN 'instance' ELSE 'none' END AS route, count(*) AS events FROM alarm GROUP BY 1",
)
def f02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alarm_events(spark, sf_dir).groupBy(notify.alarm_route().alias("route")).agg(F.count(F.lit(1)).alias("events"))


@query(
    "f03_daytime_only_alarms",
    f"WITH {ALARM_SQL} SELECT CASE WHEN alarm_name = 'EC2-i-High-CPUUtilization-Alarm' THEN CASE WHEN time >= '08:00' AND time < '23:00' THEN 'cdn' ELSE 'none' END WHEN object_type = 'CloudFront' THEN 'cdn' WHEN alarm_name LIKE 'ElasticSearch-%' THEN 'search' WHEN alarm_name LIKE 'RDS-%' THEN 'database' ELSE 'none' END AS route, time >= '08:00' AND time < '23:00' AS day, count(*) AS events FROM alarm GROUP BY 1, 2",
)
def f03(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alarm_events(spark, sf_dir)
    return out.groupBy(notify.alarm_route([_NAMES[0]]).alias("route"), in_quiet_window("time").alias("day")).agg(F.count(F.lit(1)).alias("events"))


@query(
    "f04_state_transitions",
    """WITH s AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'error' THEN 'ALARM' ELSE 'OK' END AS state FROM events), l AS (SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM s)
      SELECT event_id, state, p AS previous_state, state = 'ALARM' OR coalesce(p = 'ALARM', false) AS notify FROM l""",
)
def f04(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = t(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") == "error", "ALARM").otherwise("OK").alias("state"))
    out = ev.state_transitions(states, "user_id", ["ts", "event_id"], F.to_date("ts"))
    return out.select("event_id", "state", "previous_state", "notify")


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-minute points of the context metrics per resource; values are scaled so that some pass the volume test."""
    kind = F.col("metric")
    name = F.when(kind == "click", "Requests").when(kind == "view", "5xxErrorRate").when(kind == "error", "CacheHitRate").when(kind == "purchase", "BytesDownloaded")
    rows = b.event_samples(spark, sf_dir).withColumn("value", F.col("value") * F.when(kind.isin("click", "purchase"), 1000.0).otherwise(0.1))
    points = m.resample(rows.where(kind != "signup").withColumn("metric", name), ["resource_id", "metric"], 300, "Sum")
    return al.alarm_context(points)


CONTEXT_SQL = """pts AS (SELECT 'r-' || user_id AS resource_id, event_type AS metric, epoch_us(ts) // 300000000 * 300 AS period_start, sum(value * CASE WHEN event_type IN ('click', 'purchase') THEN 1000.0 ELSE 0.1 END) AS value FROM events WHERE event_type <> 'signup' GROUP BY 1, 2, 3),
  rk AS (SELECT *, row_number() OVER (PARTITION BY resource_id, metric ORDER BY period_start DESC) AS n FROM pts),
  ctx AS (SELECT resource_id, cast(coalesce(max(CASE WHEN metric = 'click' AND n = 1 THEN trunc(value) END), 0) AS BIGINT) AS requests, cast(coalesce(max(CASE WHEN metric = 'click' AND n = 2 THEN trunc(value) END), 0) AS BIGINT) AS last_requests,
    cast(coalesce(max(CASE WHEN metric = 'click' AND n = 3 THEN trunc(value) END), 0) AS BIGINT) AS before_last_requests, cast(coalesce(max(CASE WHEN metric = 'view' AND n = 1 THEN trunc(value) END), 0) AS BIGINT) AS error_rate,
    cast(coalesce(max(CASE WHEN metric = 'error' AND n = 1 THEN trunc(value) END), 0) AS BIGINT) AS hit_rate, cast(coalesce(max(CASE WHEN metric = 'purchase' AND n = 1 THEN trunc(value) END), 0) AS BIGINT) AS bytes_downloaded FROM rk GROUP BY 1)"""


@query("r08_alarm_context", f"WITH {CONTEXT_SQL} SELECT * FROM ctx")
def r08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir)


@query("f05_volume_suppression", f"WITH {CONTEXT_SQL} SELECT resource_id, last_requests, before_last_requests FROM ctx WHERE before_last_requests > 20000")
def f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    loud = F.col("before_last_requests") > notify.QUIET_REQUESTS
    return context(spark, sf_dir).where(loud).select("resource_id", "last_requests", "before_last_requests")


@query(
    "e11_notification_feed",
    f"""WITH {ALARM_SQL}, {CONTEXT_SQL}, f AS (SELECT a.id, a.alarm_name, current_state, previous_state, account, region, timestamp, reason, alarm_value, 'r-' || substr(a.resource_id, 3) AS rid, c.last_requests, substr(a.resource_id, 3) AS u FROM alarm a LEFT JOIN ctx c ON c.resource_id = 'r-' || substr(a.resource_id, 3)),
      h AS (SELECT *, '时间: ' || timestamp || chr(10) || 'AWS帐号：' || account || chr(10) || 'AWS区域：' || region || chr(10) || '资源类型：' AS head FROM f)
      SELECT id, '【AWS通知】EC2告警' AS subject, 'all' AS receiver, head || 'EC2实例' || chr(10) || '资源名称：' || coalesce(c_name, '-') || ' (' || rid || ', ' || CASE WHEN c_name IS NOT NULL THEN '10.0.0.' || u ELSE 'None' END || ')' || chr(10) || '事件：CPU使用率过高' || chr(10) || '详情：' || reason || chr(10) AS message
        FROM h LEFT JOIN customer ON c_custkey = cast(u AS BIGINT) AND c_custkey % 3 <> 0 WHERE alarm_name LIKE 'EC2-%' AND current_state = 'ALARM'
      UNION ALL SELECT id, '【AWS通知】RDS 告警', 'all', head || 'RDS实例' || chr(10) || '资源名称：' || rid || chr(10) || '事件：IOPS超出阈值，对于gp2存储，请考虑增加其容量，对于io1存储，请考虑增大预置IOPS' || chr(10) || '详情：' || reason || chr(10) FROM h WHERE alarm_name LIKE 'RDS-%'
      UNION ALL SELECT id, '【AWS通知】ElasticSearch告警', 'all', head || 'ElasticSearch集群' || chr(10) || '资源名称：' || rid || chr(10) || '事件：健康节点数不足' || chr(10) || '详情：当前仅有' || alarm_value || '个节点' || chr(10) FROM h WHERE alarm_name LIKE 'Elastic%' AND current_state = 'ALARM'
      UNION ALL SELECT id, '【AWS通知】CloudFront告警', 'all', '【AWS】 ' || coalesce(c_name, rid) || ' 【AWS-CDN+】[acme-客户告警]域名：[' || coalesce(c_name, rid) || ']，' || CASE WHEN current_state = 'ALARM' THEN '发生了请求数告警' ELSE '请求数告警恢复' END || ' 当前值：域名全网请求数（次）=' || coalesce(last_requests, 0) || CASE WHEN current_state = 'ALARM' THEN '。最近一次告警时间：' ELSE '。告警恢复时间：' END || timestamp
        FROM h LEFT JOIN customer ON c_custkey = cast(u AS BIGINT) AND c_custkey % 3 <> 0 WHERE alarm_name LIKE 'CloudFront-%' AND (current_state = 'ALARM' OR (current_state = 'OK' AND previous_state = 'ALARM'))""",
)
def e11(spark: SparkSession, sf_dir: str) -> DataFrame:
    alarms = alarm_events(spark, sf_dir).withColumn(
        "resource_id", F.concat(F.lit("r-"), F.substring(F.col("dimensions")["InstanceId"], 3, 20))
    ).drop("dimensions")
    named = t(spark, sf_dir, "customer").where(F.col("c_custkey") % 3 != 0)
    inventory = named.select(
        F.concat(F.lit("r-"), _s("c_custkey")).alias("resource_id"), F.col("c_name").alias("name"), F.concat(F.lit("10.0.0."), _s("c_custkey")).alias("private_ip")
    )
    out = notify.notification_feed(alarms, inventory, context(spark, sf_dir), customer="acme")
    return out.select("id", "subject", "receiver", "message")


@query(
    "p33_health_notices",
    """SELECT cast(event_id AS VARCHAR) AS id, CASE WHEN user_id % 2 = 0 THEN 'maintenance' ELSE 'general' END AS route,
      '{"account":"a' || (user_id % 3) || '","region":"r' || (user_id % 5) || '","service":"' || CASE WHEN user_id % 2 = 0 THEN 'EC2' ELSE 'RDS' END || '","event_type_code":"' || event_type || '","event_type_category":"scheduledChange","timestamp":"' || strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+0800","description":"text ' || event_id || '"}' AS message FROM events""",
)
def p33(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = health_events(spark, sf_dir).withColumn("route", notify.health_route()).withColumn("resource_name", F.array_join("entity_ids", ","))
    return rows.select("id", "route", notify.health_message().alias("message"))


@query(
    "p33_path_template",
    "SELECT event_id, '【告警通知】' || event_type || chr(10) || '【区域】r' || (user_id % 5) || chr(10) AS message FROM events",
)
def p33_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = {"state": F.col("event_type"), "region": F.concat(F.lit("r"), (F.col("user_id") % 5).cast("string"))}
    message = notify.fill_template("【告警通知】<state>\n【区域】<region>\n", paths)
    return t(spark, sf_dir, "events").select("event_id", message.alias("message"))


@query(
    "p39_identity_name",
    "SELECT user_id, CASE WHEN user_id % 2 = 0 THEN 'u' || user_id ELSE 's' || user_id END AS name, count(*) AS events FROM events GROUP BY 1, 2",
)
def p39(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = _s("user_id")
    plain = F.to_json(F.struct(F.lit("IAMUser").alias("type"), F.concat(F.lit("u"), user).alias("userName")))
    issuer = F.struct(F.struct(F.concat(F.lit("s"), user).alias("userName")).alias("sessionIssuer"))
    role = F.to_json(F.struct(F.lit("IAMRole").alias("type"), issuer.alias("sessionContext")))
    rows = t(spark, sf_dir, "events").select("user_id", F.when(F.col("user_id") % 2 == 0, plain).otherwise(role).alias("user_identity"))
    return rows.groupBy("user_id", ev.identity_name().alias("name")).agg(F.count(F.lit(1)).alias("events"))


@query("f09_text_filter", "SELECT lang, count(*) AS documents FROM documents WHERE contains(text, 'the') GROUP BY 1")
def f09(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyledger.operators.logs import lines_with

    rows = t(spark, sf_dir, "documents").select("lang", F.col("text").alias("line"))
    return lines_with(rows, "the").groupBy("lang").agg(F.count(F.lit(1)).alias("documents"))

