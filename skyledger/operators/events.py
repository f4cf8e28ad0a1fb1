"""Operational events: envelopes, flatteners, rules and routing.

An envelope row has id, source, detail_type, account, time (ISO text, UTC), region, resources (array of text) and
detail (JSON text); each flattener reads ``detail`` with the one schema of its event type.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import text
from skyledger.functions.network import in_any_cidr
from skyledger.functions.timefns import local_clock, local_stamp, rfc1123
from skyledger.operators.keyed import carried_lag

ENVELOPE = (
    "id string, source string, `detail-type` string, account string, time string, region string, "
    "resources array<string>"
)


def read_envelopes(df: DataFrame, body: str = "value") -> DataFrame:
    """JSON event text to envelope columns; the payload stays JSON text."""
    e = F.from_json(body, ENVELOPE)
    return df.select(
        e["id"].alias("id"),
        e["source"].alias("source"),
        e["detail-type"].alias("detail_type"),
        e["account"].alias("account"),
        e["time"].alias("time"),
        e["region"].alias("region"),
        e["resources"].alias("resources"),
        F.get_json_object(body, "$.detail").alias("detail"),
    )


PARSED = "_detail"


def parse_detail(events: DataFrame, body: str = "detail") -> DataFrame:
    """Adds the payload as a variant, parsed once; text that is no JSON gives NULL. Paths are taken with ``at``."""
    return events.withColumn(PARSED, F.try_parse_json(body))


def at(path: str, kind: str = "string", parsed: Column | str = PARSED) -> Column:
    """Value at a path of the parsed payload; NULL where it is absent or cannot be read as ``kind``."""
    return F.try_variant_get(parsed, "$." + path, kind)


def taken(events: DataFrame, fields: dict[str, str], keep: Callable[[Column], Column]) -> DataFrame:
    """Rows whose payload passes ``keep``, with ``e``, the values at the paths that ``fields`` names.

    The test stands in a generator: as a plain filter it would be pushed below the parse and parse a second time.
    """
    values = F.struct(*[at(path).alias(name) for name, path in fields.items()])
    return parse_detail(events).withColumn("e", F.explode(F.filter(F.array(values), keep))).drop(PARSED)


def _utc(column: Column | str, length: int = 19) -> Column:
    return F.try_to_timestamp(F.substring(column, 1, length), F.lit("yyyy-MM-dd'T'HH:mm:ss"))


_METRIC = "struct<id:string,metricStat:struct<metric:struct<namespace:string,name:string,dimensions:map<string,string>>,period:int,stat:string>>"
ALARM = (
    "alarmName string, state struct<value:string,reason:string,reasonData:string>, "
    "previousState struct<value:string>, configuration struct<metrics:array<" + _METRIC + ">>"
)


def flatten_alarm_event(events: DataFrame) -> DataFrame:
    """Alarm state changes; the alarm value is the first recent datapoint of the nested reason data, if any."""
    d = F.from_json("detail", ALARM)
    rows = events.withColumn("_d", d)
    points = F.from_json(F.col("_d.state.reasonData"), "recentDatapoints array<double>")["recentDatapoints"]
    ts = _utc("time")
    first = F.get(F.col("_d.configuration.metrics"), F.lit(0))["metricStat"]["metric"]
    return rows.select(
        "id",
        "account",
        "region",
        F.col("_d.alarmName").alias("alarm_name"),
        local_stamp(ts).alias("timestamp"),
        local_clock(ts).alias("time"),
        F.get(F.split("_d.alarmName", "-"), F.lit(0)).alias("object_type"),
        F.col("_d.state.value").alias("current_state"),
        F.col("_d.previousState.value").alias("previous_state"),
        F.col("_d.state.reason").alias("reason"),
        F.get(points, F.lit(0)).alias("alarm_value"),
        first["name"].alias("metric_name"),
        first["dimensions"].alias("dimensions"),
    )


HEALTH = (
    "service string, eventTypeCode string, eventTypeCategory string, startTime string, "
    "eventDescription array<struct<language:string,latestDescription:string>>, "
    "affectedEntities array<struct<entityValue:string>>"
)


def flatten_health_event(events: DataFrame) -> DataFrame:
    rows = events.withColumn("_d", F.from_json("detail", HEALTH))
    ts = rfc1123("_d.startTime")
    return rows.select(
        "id",
        "account",
        "region",
        F.col("_d.service").alias("service"),
        F.col("_d.eventTypeCode").alias("event_type_code"),
        F.col("_d.eventTypeCategory").alias("event_type_category"),
        local_stamp(ts).alias("timestamp"),
        local_clock(ts).alias("time"),
        F.get(F.col("_d.eventDescription"), F.lit(0))["latestDescription"].alias("description"),
        F.transform("_d.affectedEntities", lambda e: e["entityValue"]).alias("entity_ids"),
    )


COMPLIANCE = (
    "resourceId string, resourceType string, configRuleName string, "
    "newEvaluationResult struct<complianceType:string,resultRecordedTime:string,annotation:string>"
)


def flatten_compliance_event(events: DataFrame) -> DataFrame:
    rows = events.withColumn("_d", F.from_json("detail", COMPLIANCE))
    ts = _utc("_d.newEvaluationResult.resultRecordedTime")
    return rows.select(
        "id",
        "account",
        "region",
        local_stamp(ts).alias("timestamp"),
        local_clock(ts).alias("time"),
        F.col("_d.resourceType").alias("resource_type"),
        F.col("_d.resourceId").alias("resource_id"),
        F.col("_d.configRuleName").alias("rule_name"),
        F.col("_d.newEvaluationResult.annotation").alias("annotation"),
    )


FINDING = (
    "type string, description string, "
    "resource struct<resourceType:string,tags:array<struct<key:string,value:string>>,instanceDetails:struct<instanceId:string,tags:array<struct<key:string,value:string>>>>, "
    "service struct<action:struct<dnsRequestAction:struct<domain:string>>>"
)
DNS_FINDINGS = ["Backdoor:EC2/C&CActivity.B!DNS"]  # fixed value: finding types that name a domain


def flatten_security_finding(events: DataFrame) -> DataFrame:
    """Findings; instance fields only for instances, the domain only for command-and-control DNS findings."""
    rows = events.withColumn("_d", F.from_json("detail", FINDING))
    instance = F.col("_d.resource.resourceType") == "Instance"
    dns = F.col("_d.type").isin(*DNS_FINDINGS)
    return rows.select(
        "id",
        "account",
        "region",
        "time",
        F.col("_d.type").alias("finding_type"),
        F.col("_d.resource.resourceType").alias("resource_type"),
        F.when(instance, F.col("_d.resource.instanceDetails.instanceId")).alias("instance_id"),
        F.when(instance, F.coalesce("_d.resource.tags", "_d.resource.instanceDetails.tags")).alias("tags"),
        F.when(dns, F.col("_d.service.action.dnsRequestAction.domain")).alias("domain"),
        F.when(dns, F.col("_d.description")).alias("description"),
    )


CACHE_PREFIX = "ElastiCache:"  # fixed value: the message key that names the event


def flatten_cache_event(messages: DataFrame, body: str = "message") -> DataFrame:
    """Messages whose informative part is a key: event name = the prefixed key, resource = its value."""
    entries = F.map_entries(F.from_json(body, "map<string,string>"))
    named = F.filter(entries, lambda e: e["key"].startswith(CACHE_PREFIX))
    last = F.get(named, F.size(named) - F.lit(1))
    kept = [c for c in messages.columns if c != body]
    return messages.select(
        *kept,
        F.coalesce(last["key"], F.lit("")).alias("detail_type"),
        F.coalesce(last["value"], F.lit("")).alias("resource"),
        F.to_json(F.map_from_entries(F.array_sort(entries))).alias("detail"),
    )


NETWORK_EVENT = (
    "EventId string, StartedAt string, EndedAt string, EventType string, EventStatus string, "
    "ClientLocation struct<ASName:string,ASNumber:bigint,Country:string,Subdivision:string,Metro:string,City:string,"
    "Latitude:double,Longitude:double>"
)


def flatten_internet_event(events: DataFrame, refresh_time: Column, body: str = "value") -> DataFrame:
    """Network-health events; the end is only kept once resolved."""
    rows = events.withColumn("_e", F.from_json(body, NETWORK_EVENT))
    where = F.col("_e.ClientLocation")
    return rows.select(
        refresh_time.alias("RefreshTime"),
        F.col("_e.EventId").alias("EventId"),
        F.col("_e.StartedAt").alias("StartedAt"),
        *[where[c].alias(c) for c in ("ASName", "ASNumber", "Country", "Subdivision", "Metro", "City", "Latitude", "Longitude")],
        F.col("_e.EventType").alias("EventType"),
        F.col("_e.EventStatus").alias("EventStatus"),
        F.when(F.col("_e.EventStatus") == "RESOLVED", F.col("_e.EndedAt")).alias("EndedAt"),
    )


def latest_event_state(snapshots: DataFrame, key: str = "EventId", order: Sequence[str] = ("RefreshTime",)) -> DataFrame:
    """Current row per event across refreshes; a partial maximum per task, so no group is gathered."""
    rest = [c for c in snapshots.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order]))
    return snapshots.groupBy(key).agg(newest.alias("_r")).select(key, "_r.*")


# Names of the audit findings.
ROOT_LOGIN = "AWS Root account login"
UNTRUSTED_LOGIN = "Login from untrusted IP"
DB_CHANGE = "Unauthorized user create/delte RDS DB Instance"
INSTANCE_START = "Unauthorized user start EC2 Instance"


def audit_findings(
    records: DataFrame, trusted: Sequence[str], dbas: Sequence[str], admins: Sequence[str]
) -> DataFrame:
    """One row per finding; a record can have several.

    ``records``: event_name, user_type, user_name, source_ip. The allow-lists are parameters, not tables.
    """

    def listed(names: Sequence[str]) -> Column:
        clean = [n.strip() for n in names]
        return F.coalesce(F.col("user_name").isin(*clean), F.lit(False)) if clean else F.lit(False)

    name = F.col("event_name")
    login = name == "ConsoleLogin"
    db = name.startswith("CreateDBInstance") | name.startswith("DeleteDBInstance")
    found = F.array_compact(
        F.array(
            F.when(login & (F.col("user_type") == "Root"), F.lit(ROOT_LOGIN)),
            F.when(login & ~in_any_cidr("source_ip", list(trusted)), F.lit(UNTRUSTED_LOGIN)),
            F.when(db & ~listed(dbas), F.lit(DB_CHANGE)),
            F.when((name == "RunInstances") & ~listed(admins), F.lit(INSTANCE_START)),
        )
    )
    return records.withColumn("finding", F.explode(found))


def workflow_failures(events: DataFrame) -> DataFrame:
    """Failed and timed-out runs with local time and a link."""
    ends = taken(events, {"status": "status", "run": "executionArn", "workflow": "stateMachineArn"}, lambda e: e["status"].isin("FAILED", "TIMED_OUT"))
    ts = _utc("time")
    link = F.concat(
        F.lit("https://console.aws.amazon.com/states/home?region="), F.col("region"), F.lit("#/executions/details/"), F.col("e.run")
    )
    return ends.select(
        "id",
        "account",
        "region",
        "e.status",
        local_stamp(ts).alias("timestamp"),
        local_clock(ts).alias("time"),
        F.col("e.run").alias("execution"),
        "e.workflow",
        link.alias("link"),
    )


def identity_name(identity: Column | str = "user_identity") -> Column:
    """User name of a user, session issuer's name of a role."""
    u = F.col(identity) if isinstance(identity, str) else identity
    kind = F.get_json_object(u, "$.type")
    return F.when(kind == "IAMUser", F.get_json_object(u, "$.userName")).when(
        kind == "IAMRole", F.get_json_object(u, "$.sessionContext.sessionIssuer.userName")
    )


def operation_of(event_name: Column | str) -> Column:
    n = F.col(event_name) if isinstance(event_name, str) else event_name
    return (
        F.when(n.startswith("Create"), F.lit("created"))
        .when(n.startswith("Update"), F.lit("updated"))
        .when(n.startswith("Delete"), F.lit("deleted"))
    )


def distribution_changes(events: DataFrame) -> DataFrame:
    """Create, update and delete calls; the id sits at a different path for deletions."""
    name = at("eventName")
    deleted = name.startswith("Delete")
    aliases = at("responseElements.distribution.distributionConfig.aliases.items", "array<string>")
    user = F.when(at("userIdentity.type") == "IAMUser", at("userIdentity.userName")).when(
        at("userIdentity.type") == "IAMRole", at("userIdentity.sessionContext.sessionIssuer.userName")
    )
    return parse_detail(events).select(
        "id",
        operation_of(name).alias("operation"),
        F.when(deleted, at("requestParameters.id")).otherwise(at("responseElements.distribution.id")).alias("distribution_id"),
        F.when(~deleted, at("responseElements.distribution.aRN")).alias("arn"),
        F.when(deleted, F.lit("")).otherwise(F.coalesce(text.joined_sorted(aliases), F.lit(""))).alias("domain_name"),
        at("userIdentity.type").alias("identity_type"),
        user.alias("identity_name"),
    )


# Database event ids and the operation they stand for.
DATABASE_EVENTS = {
    "RDS-EVENT-0005": "created",
    "RDS-EVENT-0043": "restored",
    "RDS-EVENT-0003": "deleted",
    "RDS-EVENT-0017": "storage_changed",
}


def database_changes(events: DataFrame) -> DataFrame:
    code = F.col("e.code")
    operation = None
    for event_id, name in DATABASE_EVENTS.items():
        operation = F.when(code == event_id, F.lit(name)) if operation is None else operation.when(code == event_id, F.lit(name))
    changes = taken(events, {"code": "EventID", "source": "SourceIdentifier"}, lambda e: e["code"].isin(*DATABASE_EVENTS))
    return changes.select(
        "id", operation.alias("operation"), F.element_at(F.split("e.source", ":"), -1).alias("db_instance")
    )


def volume_operation(event_name: Column | str, attachments: Column | str) -> Column:
    """attach or reattach, detach or detachlast, by whether more than one attachment is left."""
    n = F.col(event_name) if isinstance(event_name, str) else event_name
    many = (F.col(attachments) if isinstance(attachments, str) else attachments) > 1
    return (
        F.when(n.startswith("Attach") & many, F.lit("reattach"))
        .when(n.startswith("Attach"), F.lit("attach"))
        .when(n.startswith("Detach") & many, F.lit("detach"))
        .when(n.startswith("Detach"), F.lit("detachlast"))
    )


# Event patterns. A path maps to accepted values; {"prefix": …} accepts any value starting so.
PATTERNS: dict[str, dict[str, list]] = {
    "workflow_status": {
        "source": ["aws.states"],
        "detail_type": ["Step Functions Execution Status Change"],
        "detail.status": ["FAILED", "TIMED_OUT"],
    },
    "alarm": {
        "source": ["aws.cloudwatch"],
        "detail_type": ["CloudWatch Alarm State Change"],
        "detail.state.value": ["ALARM", "OK"],
    },
    "distribution": {
        "source": ["aws.cloudfront"],
        "detail_type": ["AWS API Call via CloudTrail"],
        "detail.eventName": [
            "CreateDistribution",
            "CreateDistributionWithTags",
            "UpdateDistribution",
            "DeleteDistribution",
        ],
    },
    "volume": {
        "source": ["aws.ec2"],
        "detail_type": ["AWS API Call via CloudTrail"],
        "detail.eventSource": ["ec2.amazonaws.com"],
        "detail.eventName": ["AttachVolume", "DetachVolume"],
    },
    "compliance": {
        "source": ["aws.config"],
        "detail_type": ["Config Rules Compliance Change"],
        "detail.messageType": ["ComplianceChangeNotification"],
        "detail.newEvaluationResult.complianceType": ["NON_COMPLIANT"],
    },
    "scaling_group": {
        "source": ["aws.autoscaling"],
        "detail_type": [
            "EC2 Instance Launch Successful",
            "EC2 Instance Terminate Successful",
            "EC2 Instance Launch Unsuccessful",
            "EC2 Instance Terminate Unsuccessful",
        ],
    },
    "database": {
        "source": ["aws.rds"],
        "detail_type": ["RDS DB Instance Event"],
        "detail.EventID": ["RDS-EVENT-0005", "RDS-EVENT-0043", "RDS-EVENT-0003", "RDS-EVENT-0017"],
    },
    "search_domain": {
        "source": ["aws.es"],
        "detail_type": ["AWS API Call via CloudTrail"],
        "detail.eventName": ["CreateElasticsearchDomain", "DeleteElasticsearchDomain"],
    },
}


def matches_pattern(pattern: dict[str, list]) -> Column:
    """All paths must match; within a path any listed value or prefix will do. Needs ``parse_detail``."""
    every = F.lit(True)
    for path, accepted in pattern.items():
        value = at(path[len("detail.") :]) if path.startswith("detail.") else F.col(path)
        exact = [a for a in accepted if isinstance(a, str)]
        hit = value.isin(*exact) if exact else F.lit(False)
        for a in accepted:
            if isinstance(a, dict):
                hit = hit | value.startswith(a["prefix"])
        every = every & F.coalesce(hit, F.lit(False))
    return every


def route_events(events: DataFrame, patterns: dict[str, dict[str, list]] | None = None) -> DataFrame:
    """One row per (event, matching rule)."""
    rules = patterns or PATTERNS
    hits = F.array_compact(F.array(*[F.when(matches_pattern(p), F.lit(name)) for name, p in rules.items()]))
    return parse_detail(events).withColumn("route", F.explode(hits)).drop(PARSED)


def state_transitions(
    states: DataFrame, key: str, order: Sequence[str], bucket: Column, state: str = "state"
) -> DataFrame:
    """Previous state, and whether the row needs notice: ALARM now, or OK after ALARM."""
    out = carried_lag(states, [key], order, state, "previous_state", bucket)
    alarm = F.col(state) == "ALARM"
    recovered = (F.col(state) == "OK") & (F.col("previous_state") == "ALARM")
    return out.withColumn("notify", F.coalesce(alarm | recovered, F.lit(False)))


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Newest row per key by explicit order; the row limit applies before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")
