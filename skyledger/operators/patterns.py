"""Event routing by a table of patterns, of any number.

A pattern names paths of the event and, for each, the values or beginnings of values it accepts; an event matches when every
path does. The table is turned into an index from a single condition (path, value or beginning) to the patterns that
hang on it: of a pattern's paths the one whose values the fewest patterns share. An event is looked up under its values at
those paths, and under their beginnings of the lengths that occur, by one equi-join; the pattern found must then count as
many paths met as it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.events import PARSED, at, parse_detail
from skyledger.operators.keyed import join_totals
from skyledger.session import cut_lineage

CONDITIONS = "route string, path string, value string, prefix boolean"
#: Bytes of the index that may be broadcast, and paths that are read from an event.
INDEX_BYTES, PATHS = 32 << 20, 4096


def pattern_table(spark: SparkSession, patterns: dict[str, dict[str, list]]) -> DataFrame:
    """Rows (route, path, value, prefix) of patterns in the form of ``events.PATTERNS``."""
    rows = []
    for route, paths in patterns.items():
        for path, accepted in paths.items():
            rows += [(route, path, a["prefix"], True) if isinstance(a, dict) else (route, path, a, False) for a in accepted]
    return spark.createDataFrame(rows, CONDITIONS)


def _reduced(table: DataFrame) -> DataFrame:
    """Conditions without those that a shorter beginning of the same pattern and path covers: one at most meets a value."""
    table = table.select("route", "path", "value", "prefix").where(F.col("value").isNotNull()).distinct()
    shorter = table.where("prefix").select("route", "path", F.col("value").alias("_begin"))
    covered = F.col("value").startswith(F.col("_begin")) & (~F.col("prefix") | (F.col("value") != F.col("_begin")))
    met = table.join(shorter, ["route", "path"]).where(covered).select("route", "path", "value", "prefix").distinct()
    return table.join(met, ["route", "path", "value", "prefix"], "left_anti")


def _index(table: DataFrame, paths: list[str]) -> DataFrame:
    """(at, value, prefix, route, needs): each pattern under the conditions of its most telling path."""
    number = F.array_position(F.array(*[F.lit(p) for p in paths]), F.col("path")).cast("int") - 1
    table = table.withColumn("at", number)
    shared = table.groupBy("at", "value", "prefix").agg(F.count(F.lit(1)).alias("_shared"))
    per_path = (
        table.join(shared, ["at", "value", "prefix"])
        .groupBy("route", "at")
        .agg(
            F.max("_shared").alias("_shared"),
            F.collect_list(F.when(~F.col("prefix"), F.col("value"))).alias("exact"),
            F.collect_list(F.when(F.col("prefix"), F.col("value"))).alias("begins"),
        )
    )
    conditions = F.sort_array(F.collect_list(F.struct("at", "exact", "begins"))).alias("needs")
    chosen = per_path.groupBy("route").agg(F.min_by("at", F.struct("_shared", "at")).alias("at"), conditions)
    return table.join(chosen, ["route", "at"]).select("at", "value", "prefix", "route", "needs")


def value_at(path: str) -> Column:
    """Text at a path of the event: a column, or a place in the parsed detail."""
    return at(path[len("detail.") :]) if path.startswith("detail.") else F.col(path).cast("string")


def route_by_table(events: DataFrame, table: DataFrame) -> DataFrame:
    """One row per (event, matching pattern), as ``events.route_events`` gives; ``table`` as ``pattern_table`` gives it.

    The detail is parsed once, whatever the number of paths; text that is no JSON meets no condition on it. A condition
    without a value is left out, a path that names none accepts nothing. Repeated conditions count once, events that repeat
    are routed each.
    """
    paths = [r[0] for r in table.select("path").distinct().orderBy("path").limit(PATHS + 1).collect()]
    if len(paths) > PATHS:
        raise ValueError(f"more than {PATHS} paths in the patterns")
    if not paths:
        return events.withColumn("route", F.lit("")).where(F.lit(False))
    wanted = table.groupBy("route").agg(F.countDistinct("path").alias("_paths"))
    index = cut_lineage(_index(_reduced(table), paths).join(wanted, "route").where(F.size("needs") == F.col("_paths")).drop("_paths"))
    lengths = index.where("prefix").groupBy("at").agg(F.collect_set(F.length("value")).alias("sizes")).collect()  # a row per path
    begins = {r["at"]: sorted(r["sizes"]) for r in lengths}
    anchors = sorted({r[0] for r in index.select("at").distinct().collect()})
    if not anchors:
        return events.withColumn("route", F.lit("")).where(F.lit(False))

    held = parse_detail(events).withColumn("_values", F.array(*[value_at(p) for p in paths])).drop(PARSED)
    terms = []
    for place in anchors:
        value = F.get("_values", F.lit(place))
        terms.append(F.struct(F.lit(place).alias("at"), value.alias("value"), F.lit(False).alias("prefix")))
        for size in begins.get(place, ()):
            begin = F.when(F.length(value) >= size, F.substring(value, 1, size))
            terms.append(F.struct(F.lit(place).alias("at"), begin.alias("value"), F.lit(True).alias("prefix")))
    looked = held.withColumn("_term", F.explode(F.filter(F.array(*terms), lambda x: x["value"].isNotNull())))
    looked = looked.select("*", F.col("_term.at").alias("_at"), F.col("_term.value").alias("_value"), F.col("_term.prefix").alias("_prefix")).drop("_term")
    found = index.select(F.col("at").alias("_at"), F.col("value").alias("_value"), F.col("prefix").alias("_prefix"), "route", F.col("needs").alias("_needs"))
    size = index.agg(F.sum(F.length(F.to_json("needs")) + F.octet_length("value") + F.lit(64))).first()[0] or 0
    keys = ["_at", "_value", "_prefix"]
    joined = looked.join(F.broadcast(found), keys) if size <= INDEX_BYTES else join_totals(looked, found, keys, "inner")
    met = F.filter("_needs", lambda need: _meets(need, F.get("_values", need["at"])))
    return joined.where(F.size(met) == F.size("_needs")).select(*events.columns, "route")


def _meets(need: Column, value: Column) -> Column:
    return F.coalesce(F.array_contains(need["exact"], value) | F.exists(need["begins"], lambda b: value.startswith(b)), F.lit(False))

