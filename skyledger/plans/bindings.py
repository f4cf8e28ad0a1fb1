"""The library's input tables derived from the test tables: billing lines, usage, tags, samples, logs, events.

Every function reads whole tables; each has a SQL twin in ``bindings_sql`` used by the oracles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import partition_for, prepare, scratch_path, shuffles_removed
from skyledger.sources.clustered import store_placed
from skyledger.sources.readers import read_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return partition_for(prepare(spark), path).read.parquet(path)


#: Line items a task widens at most; one becomes a row of some 750 bytes in the hash table of a sum.
TASK_LINES = 500_000


def dealt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in tasks of ``TASK_LINES``, whatever the splits of the file are.

    A split of compressed columns holds millions of line items. Widened to billing lines, these outgrow a task's memory
    and the sums over them spill several times their shuffle.
    """
    lines = table(spark, sf_dir, "lineitem")
    tasks = -(-lines.count() // TASK_LINES)  # a count of the file's footers
    return lines.repartition(tasks, "l_partkey", "l_orderkey", "l_linenumber") if tasks > 1 else lines


#: Parts and suppliers are broadcast up to so many rows, some 100 bytes each; the files' sizes say little of that.
BROADCAST_ROWS = 500_000
BROADCAST_PARTS = 50_000


def _beside_lines(side: DataFrame, most: int) -> DataFrame:
    """A side of a join with line items: broadcast if it has ``most`` rows or fewer, else both sides are moved by the key."""
    return F.broadcast(side) if side.count() <= most else side.hint("merge")  # a count of the file's footers


#: Events a task turns into samples at most; one becomes some five, each with its labels.
TASK_EVENTS = 100_000


def dealt_events(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    """``events``, rows made of the events, in tasks of ``TASK_EVENTS``, whatever the splits of the file are."""
    tasks = -(-table(spark, sf_dir, "events").count() // TASK_EVENTS)  # a count of the file's footers
    return events.repartition(tasks, "event_id") if tasks > 1 else events


def _charge_type() -> Column:
    flags = F.concat("l_returnflag", "l_linestatus")
    return (
        F.when(flags == "AF", F.lit("DiscountedUsage"))
        .when(flags == "AO", F.lit("SavingsPlanRecurringFee"))
        .when(flags == "RF", F.lit("RIFee"))
        .when(flags == "RO", F.lit("EdpDiscount"))
        .when(flags == "NO", F.lit("Usage"))
        .otherwise(F.lit("SavingsPlanCoveredUsage"))
    )


def usage_type() -> Column:
    return (
        F.when(F.col("p_type") == "SMALL", F.lit("BoxUsage"))
        .when(F.col("p_type") == "MEDIUM", F.lit("SpotUsage"))
        .when(F.col("p_type") == "LARGE", F.lit("DataTransfer-Out-Bytes"))
        .when(F.col("p_type") == "STANDARD", F.lit("EBS:VolumeUsage"))
        .when(F.col("p_type") == "PROMO", F.lit("EBSOptimized:BoxUsage"))
        .otherwise(F.lit("TimedStorage-ByteHrs"))
    )


def _instance_type() -> Column:
    n = F.col("p_size") % 5
    return (
        F.when(n == 0, F.lit("m5.large"))
        .when(n == 1, F.lit("c5n.large"))
        .when(n == 2, F.lit("r6gd.large"))
        .when(n == 3, F.lit("db.m5.large"))
        .otherwise(F.lit(""))
    )


def billing_lines(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    """Line items as a billing export; with ``by_month`` usage starts on the first of the month."""
    price = F.col("l_extendedprice")
    parts = table(spark, sf_dir, "part")
    # one exchange of the line items, that of a merge or that which deals them
    lines = dealt_lines(spark, sf_dir) if parts.count() <= BROADCAST_PARTS else table(spark, sf_dir, "lineitem")
    lines = (
        lines.join(_beside_lines(parts, BROADCAST_PARTS), F.col("l_partkey") == F.col("p_partkey"))
        .join(_beside_lines(table(spark, sf_dir, "supplier"), BROADCAST_ROWS), F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("_kind", _charge_type())
    )
    day = F.to_date("l_shipdate")
    unbilled = (F.col("_kind") == "SavingsPlanRecurringFee") & (F.col("l_tax") == 0)
    split = F.when(F.col("l_linenumber") == 6, F.lit("i-parent")).otherwise(F.lit(""))
    none = F.lit("")
    return lines.select(
        F.year(day).cast("string").alias("year"),
        F.month(day).cast("string").alias("month"),
        (F.trunc(day, "month") if by_month else day).alias("line_item_usage_start_date"),
        F.col("_kind").alias("line_item_line_item_type"),
        usage_type().alias("line_item_usage_type"),
        F.col("p_brand").alias("line_item_product_code"),
        F.concat(F.lit("charge "), F.col("l_linestatus")).alias("line_item_line_item_description"),
        F.concat(F.lit("i-"), F.col("l_suppkey")).alias("line_item_resource_id"),
        F.col("s_nationkey").cast("string").alias("line_item_usage_account_id"),
        F.lit("Reseller").alias("line_item_legal_entity"),
        F.col("l_quantity").alias("line_item_usage_amount"),
        F.when(unbilled, F.lit(0.0)).otherwise(price).alias("line_item_unblended_cost"),
        F.when(unbilled, F.lit(0.0)).otherwise(price * 0.5).alias("line_item_net_unblended_cost"),
        F.lit("payer").alias("bill_payer_account_id"),
        F.when(F.col("l_linenumber") == 7, F.lit("Marketplace")).otherwise(F.lit("AWS")).alias("bill_billing_entity"),
        split.alias("split_line_item_parent_resource_id"),
        (price * 0.5).alias("split_line_item_split_cost"),
        (price * 0.25).alias("split_line_item_unused_cost"),
        (price * 0.5).alias("split_line_item_net_split_cost"),
        (price * 0.25).alias("split_line_item_net_unused_cost"),
        (price * 0.5).alias("split_line_item_public_on_demand_split_cost"),
        (price * 0.5).alias("split_line_item_public_on_demand_unused_cost"),
        F.when(F.col("p_size") % 3 == 0, none).otherwise(F.concat(F.lit("Amazon"), F.col("p_type"))).alias("product_servicecode"),
        F.when(F.col("p_size") % 2 == 0, F.lit("Amazon Elastic Compute Cloud")).otherwise(none).alias("product_servicename"),
        F.col("p_name").alias("product_product_name"),
        F.concat(F.lit("region-"), F.col("s_nationkey") % 5).alias("product_region"),
        F.lit("Somewhere").alias("product_location"),
        _instance_type().alias("product_instance_type"),
        F.when(F.col("p_size") > 45, F.lit("MySQL")).alias("product_database_engine"),
        F.when(F.col("p_type") == "STANDARD", F.lit("gp2")).otherwise(none).alias("product_volume_type"),
        F.col("p_size").cast("string").alias("product_vcpu"),
        F.when(F.col("p_size") % 7 == 0, F.lit("N/A")).when(F.col("p_size") % 7 == 1, F.lit("1")).otherwise(none).alias("product_gpu"),
        F.when(F.col("p_size") % 4 == 0, none).otherwise(F.concat((F.col("p_size") * 0.5).cast("string"), F.lit(" GiB"))).alias("product_memory"),
        F.col("p_size").cast("string").alias("product_memory_gib"),
        (price * (F.lit(1.0) + F.col("l_tax"))).alias("pricing_public_on_demand_cost"),
        F.when(F.col("l_linenumber") == 1, F.lit("arn")).otherwise(none).alias("reservation_reservation_a_r_n"),
        (price * (F.lit(1.0) - F.col("l_discount"))).alias("reservation_effective_cost"),
        (price * 0.5).alias("reservation_net_effective_cost"),
        (price * 0.1).alias("reservation_unused_amortized_upfront_fee_for_billing_period"),
        (price * 0.2).alias("reservation_unused_recurring_fee"),
        (price * 0.05).alias("reservation_net_unused_amortized_upfront_fee_for_billing_period"),
        (price * 0.15).alias("reservation_net_unused_recurring_fee"),
        (price * 0.6).alias("savings_plan_savings_plan_effective_cost"),
        (price * 0.5).alias("savings_plan_net_savings_plan_effective_cost"),
        (price * 0.4).alias("savings_plan_amortized_upfront_commitment_for_billing_period"),
        (price * 0.4).alias("savings_plan_net_amortized_upfront_commitment_for_billing_period"),
        (price * 0.5).alias("savings_plan_recurring_commitment_for_billing_period"),
        (price * 0.4).alias("savings_plan_used_commitment"),
        F.lit(None).cast("string").alias("resource_tags_aws_elasticmapreduce_job_flow_id"),
        F.when(F.col("l_linenumber") == 5, F.lit("prod")).otherwise(none).alias("resource_tags_aws_eks_cluster_name"),
        F.lit("").alias("resource_tags_aws_eks_namespace"),
        F.lit("").alias("resource_tags_aws_eks_deployment"),
        F.lit("").alias("resource_tags_aws_eks_node"),
        F.when(F.col("l_partkey") % 3 == 0, none).otherwise(F.col("p_brand")).alias("resource_tags_user_project"),
        F.when(F.col("l_suppkey") % 4 != 0, F.concat(F.lit("srv-"), F.col("l_suppkey"))).alias("resource_tags_user_name"),
    )


def workload_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month x instance (supplier) x pod (part): CPU and memory hours and network bytes, as a stored table."""
    return landed_table(spark, sf_dir, "pod-metrics", lambda: _workload_metrics(spark, sf_dir))


def _workload_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.trunc(F.to_date("l_shipdate"), "month")
    suppliers = _beside_lines(table(spark, sf_dir, "supplier"), BROADCAST_ROWS)
    rows = table(spark, sf_dir, "lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    instance = F.concat(F.lit("i-"), F.col("l_suppkey"))
    return rows.select(
        F.year("l_shipdate").cast("string").alias("year"),
        F.month("l_shipdate").cast("string").alias("month"),
        day.alias("date"),
        F.col("s_nationkey").cast("string").alias("usage_account"),
        F.concat(F.lit("region-"), F.col("s_nationkey") % 5).alias("region"),
        instance.alias("instance"),
        F.lit("prod").alias("eks_cluster_name"),
        F.concat(F.lit("ns-"), F.col("l_partkey") % 10).alias("eks_namespace"),
        F.concat(F.lit("app-"), F.col("l_partkey") % 100).alias("eks_app"),
        F.concat(instance, F.lit(":pod/prod/"), F.col("l_partkey")).alias("resource_id"),
        F.col("l_quantity").alias("actual_cpu"),
        (F.col("l_extendedprice") * F.lit(1000000.0)).alias("actual_mem"),
        (F.col("l_quantity") * 2).alias("reserved_cpu"),
        (F.col("l_extendedprice") * F.lit(500000.0)).alias("reserved_mem"),
        F.col("l_quantity").alias("network_in"),
        F.col("l_extendedprice").alias("network_out"),
    )


def tagged_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly cost with two or three partly blank tags and some credits."""
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.trunc(F.to_date("l_shipdate"), "month").alias("date"),
            F.when(F.col("l_partkey") % 3 == 0, F.lit("")).otherwise(F.col("p_brand")).alias("t1"),
            F.when(F.col("l_suppkey") % 4 == 0, F.lit("")).otherwise(F.col("p_type")).alias("t2"),
            F.when(F.col("l_linenumber") % 2 == 0, F.lit("")).otherwise(F.col("l_linestatus")).alias("t3"),
            F.col("l_returnflag").alias("charge_type"),
            F.col("l_extendedprice").alias("ondemand_cost"),
            (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("amortized_cost"),
            (F.col("l_extendedprice") * 0.5).alias("net_amortized_cost"),
            F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 3), F.col("l_extendedprice") * -0.25).otherwise(F.col("l_extendedprice")).alias("billing_cost"),
        )
    )
    return rows.groupBy("date", "t1", "t2", "t3", "charge_type").agg(
        *[F.sum(c).alias(c) for c in ("ondemand_cost", "amortized_cost", "net_amortized_cost", "billing_cost")]
    )


def event_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metric samples: resource = user, metric = event type, epoch seconds."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("r-"), F.col("user_id")).alias("resource_id"),
        F.col("event_type").alias("metric"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch"),
        F.col("ts"),
        F.col("user_id"),
        F.col("value"),
        F.col("props"),
    )


def tag_array(*pairs: tuple[str, Column]) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in pairs])


_LANDED: dict[tuple[str, str, str], str] = {}
#: Bytes of a row group of a stored table, the least that a reader's task can take.
LANDED_BLOCK = 8 << 20
#: Rows of a bucket of a placed table, which one task sums.
PLACED_ROWS = 100_000
#: Lines of a packed text file, which cannot be split.
FILE_LINES = 100_000


def landed_lines(spark: SparkSession, sf_dir: str, label: str, lines: DataFrame, packed: bool = False) -> DataFrame:
    """``lines`` as text files in the shared folder, read back the way log files are; written once per session.

    ``packed`` writes gzip, as deliveries arrive; such a file is read by one task, so none holds more than ``FILE_LINES``.
    """
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _LANDED:
        path = scratch_path(spark, label)
        writer = lines.select("line").write
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES) if packed else writer
        writer.text(path)
        _LANDED[key] = path
    return read_lines(spark, _LANDED[key])


def landed_table(spark: SparkSession, sf_dir: str, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived table written once per session, as one job of the cost run hands its result to the next."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _LANDED:
        path, built = scratch_path(spark, label), build()
        with shuffles_removed(spark):
            built.write.option("parquet.block.size", LANDED_BLOCK).parquet(path)
        _LANDED[key] = path
    return partition_for(spark, _LANDED[key]).read.parquet(_LANDED[key])


def placed_table(spark: SparkSession, sf_dir: str, label: str, build: Callable[[int], DataFrame], by: Sequence[str], rows: int) -> DataFrame:
    """The same in buckets of some ``PLACED_ROWS`` of the ``rows`` expected, by ``by``; ``build`` places its rows in so many partitions."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _LANDED:
        path, buckets = scratch_path(spark, label), max(1, -(-rows // PLACED_ROWS))
        built = build(buckets)
        with shuffles_removed(spark):
            store_placed(built, path.rsplit("/", 1)[1].replace("-", "_"), path, by, buckets)
        _LANDED[key] = path
    return partition_for(spark, _LANDED[key]).table(f"`{_LANDED[key].rsplit('/', 1)[1].replace('-', '_')}`")
