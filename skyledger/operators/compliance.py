"""Required tags and groups, tag propagation plans, group catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.keyed import join_totals


def _listed(items: Sequence[str] | str) -> list[str]:
    parts = items.split(",") if isinstance(items, str) else list(items)
    return [p.strip() for p in parts if p.strip()]


def _text_array(items: Sequence[str]) -> Column:
    return F.array(*[F.lit(i) for i in items]) if items else F.array().cast("array<string>")


def filled_tag_keys(tags: str = "tags") -> Column:
    """Keys whose value is not blank."""
    kept = F.filter(F.coalesce(F.col(tags), F.array().cast("array<struct<key:string,value:string>>")),
                    lambda t: F.coalesce(F.length(t["value"]) > 0, F.lit(False)))
    return F.transform(kept, lambda t: t["key"])


def _verdict(df: DataFrame, key: str, missing: Column, exempt: Sequence[str], note: Column) -> DataFrame:
    failing = (F.size("missing") > 0) & ~F.coalesce(F.col(key).isin(*exempt), F.lit(False)) if exempt else F.size("missing") > 0
    out = df.withColumn("missing", missing)
    return out.select(
        *df.columns,
        F.when(failing, F.lit("NON_COMPLIANT")).otherwise(F.lit("COMPLIANT")).alias("compliance"),
        F.when(failing, note).alias("annotation"),
    )


def required_tags(
    resources: DataFrame, required: Sequence[str] | str, exempt: Sequence[str] | str = (), key: str = "resource_id"
) -> DataFrame:
    """Verdict and annotation per resource; a blank value counts as missing, blank list entries do not count."""
    wanted = _listed(required)
    missing = F.array_except(_text_array(wanted), filled_tag_keys())
    note = F.concat(F.col(key), F.lit("的以下标签不合规: "), F.array_join("missing", ","), F.lit("。"))
    return _verdict(resources, key, missing, _listed(exempt), note)


def required_groups(
    users: DataFrame, required: Sequence[str] | str, exempt: Sequence[str] | str = (), key: str = "user_name"
) -> DataFrame:
    """Group membership verdict; only configuration-change messages that carry a configuration are judged."""
    judged = users.where(
        (F.col("message_type") == "ConfigurationItemChangeNotification") & F.col("group_list").isNotNull()
    )
    missing = F.array_except(_text_array(_listed(required)), F.col("group_list"))
    note = F.concat(F.col(key), F.lit("不在"), F.array_join("missing", ","), F.lit("组。"))
    return _verdict(judged, key, missing, _listed(exempt), note)


def missing_tags(resources: DataFrame, required: Sequence[str] | str, by: Sequence[str] = ("region",)) -> DataFrame:
    """Resources with missing tags and a line describing them."""
    gaps = F.array_except(_text_array(_listed(required)), filled_tag_keys())
    out = resources.withColumn("missing", gaps).where(F.size("missing") > 0)
    return out.select(
        *by,
        "resource_id",
        F.array_join("missing", ",").alias("missing_tags"),
        F.concat(
            F.lit("区域 "), F.col("region"), F.lit(", 实例 "), F.col("resource_id"), F.lit(" 的 "),
            F.array_join("missing", ","), F.lit(" 标签不合规\n"),
        ).alias("line"),
    )


def tag_check_report(resources: DataFrame, required: Sequence[str] | str, by: Sequence[str]) -> DataFrame:
    """Message text per group. The caller names a ``by`` that bounds a group (say region and a block of ids), as a text
    is one value; ``missing_tags`` gives the same findings as rows.
    """
    lines = missing_tags(resources, required, by)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("resource_id", "line"))), lambda e: e["line"])
    return lines.groupBy(*by).agg(F.count(F.lit(1)).alias("resources"), F.array_join(parts, "").alias("message"))


def propagate_tags(parents: DataFrame, children: DataFrame, keys: Sequence[str] | str, member: str = "children") -> DataFrame:
    """Plan of tags to copy: (child, key, value) for tags of the parent that the child does not carry.

    ``parents``: parent_id, tags, an array of child ids; ``children``: resource_id, tags.
    """
    wanted = parents.select(F.explode(member).alias("resource_id"), F.col("tags")).select("resource_id", F.inline("tags"))
    wanted = wanted.where(F.col("key").isin(*_listed(keys)))
    present = children.select("resource_id", F.inline("tags")).select("resource_id", "key").distinct()
    return wanted.join(present, ["resource_id", "key"], "left_anti").select("resource_id", "key", "value").distinct()


def copy_all_tags(parents: DataFrame, member: str = "children") -> DataFrame:
    """Unconditional form: every tag of the parent for every child."""
    return parents.select(F.explode(member).alias("resource_id"), F.col("tags")).select("resource_id", F.inline("tags"))


def fill_owner_tags(resources: DataFrame, sync: Sequence[str] | str, owner: str = "Owner") -> DataFrame:
    """Tags to add: the creator as owner where none is set, and creator tags the resource lacks.

    ``resources``: resource_id, tags, identity_name, identity_tags.
    """
    synced = _listed(sync)
    present = F.transform(
        F.filter("tags", lambda t: t["key"].isin(*synced) & (F.length(F.trim(t["value"])) > 0)), lambda t: t["key"]
    )
    owned = F.exists(F.coalesce("tags", F.array().cast("array<struct<key:string,value:string>>")),
                     lambda t: (t["key"] == owner) & (F.length(t["value"]) > 0))
    kind = "array<struct<key:string,value:string>>"
    add_owner = F.when(
        ~owned, F.array(F.struct(F.lit(owner).alias("key"), F.col("identity_name").alias("value"))).cast(kind)
    ).otherwise(F.array().cast(kind))
    add_rest = F.filter("identity_tags", lambda t: ~F.array_contains(F.col("_present"), t["key"])).cast(kind)
    return (
        resources.withColumn("_present", F.coalesce(present, F.array().cast("array<string>")))
        .select("resource_id", F.inline(F.concat(add_owner, add_rest)))
    )


def group_catalogue(resources: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Group names ``key-value`` for every filled value of the listed tag keys."""
    rows = resources.select(F.inline("tags")).where(F.col("key").isin(*_listed(keys)) & (F.col("value") != ""))
    return rows.distinct().select("key", "value", F.concat_ws("-", "key", "value").alias("group_name"))
