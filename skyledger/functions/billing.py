"""Column expressions over raw billing line items.

Each line item is put into exactly one charge class first; every cost view is then a look-up by class. That
keeps the three views consistent and evaluates the pattern matches once per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.numbers import ratio, text_number

# Instance-family patterns (narrow: one letter before the generation digit; wide: up to three).
FAMILY_NARROW = r"([a-z][1-9].{0,1})\."
FAMILY_WIDE = r"([a-z]{1,3}[1-9].{0,2})\."
# Memory written as text in GiB: a whole number of any length, with thousands commas or a fraction.
MEMORY_TEXT = r"^\s*([0-9][0-9,]*(?:\.[0-9]+)?|\.[0-9]+) GiB"


@dataclass(frozen=True)
class Profile:
    """What differs between the monthly job and the dashboard variants."""

    name: str
    named_discounts: bool = False
    spot_at_public_price: bool = False
    usage_rows_only: bool = False
    split_lines: bool = False
    service_by_name: bool = False
    drop_ebs_optimized: bool = True
    with_gpu: bool = True
    family: str = FAMILY_NARROW


MONTHLY = Profile("monthly")
DASHBOARD = Profile("dashboard", named_discounts=True, spot_at_public_price=True, usage_rows_only=True)
DASHBOARD_SPLIT = Profile(
    "dashboard_split",
    named_discounts=True,
    spot_at_public_price=True,
    usage_rows_only=True,
    split_lines=True,
    family=FAMILY_WIDE,
)
DASHBOARD_FIRST = Profile(
    "dashboard_first",
    named_discounts=True,
    spot_at_public_price=True,
    usage_rows_only=True,
    service_by_name=True,
    drop_ebs_optimized=False,
    with_gpu=False,
)
PROFILES = {p.name: p for p in (MONTHLY, DASHBOARD, DASHBOARD_SPLIT, DASHBOARD_FIRST)}

_TYPE = "line_item_line_item_type"
_USAGE = "line_item_usage_type"


def _filled(name: str) -> Column:
    return F.coalesce(F.length(name) > 0, F.lit(False))


def _provider_billed() -> Column:
    return F.coalesce(F.col("bill_billing_entity") == "AWS", F.lit(False))


def billing_entity() -> Column:
    return F.when(_provider_billed(), F.lit("AWS")).otherwise(F.col("line_item_legal_entity"))


def service_name(profile: Profile = MONTHLY) -> Column:
    if profile.service_by_name:
        return F.when(_filled("product_servicename"), F.col("product_servicename")).otherwise(
            F.col("product_product_name")
        )
    rest = F.when(_filled("product_servicecode"), F.col("product_servicecode")).otherwise(_by_biller())
    if profile.name == "dashboard":
        return rest
    return F.when(_filled("split_line_item_parent_resource_id"), F.lit("AmazonEC2")).otherwise(rest)


def product_name(profile: Profile = MONTHLY) -> Column:
    if profile.service_by_name:
        return F.col("product_product_name")
    if profile.name == "dashboard":
        return _by_biller()
    return F.when(_filled("split_line_item_parent_resource_id"), F.lit("AmazonEC2")).otherwise(_by_biller())


def _by_biller() -> Column:
    return F.when(_provider_billed(), F.col("line_item_product_code")).otherwise(F.col("product_product_name"))


def instance_family(column: Column | str = "product_instance_type", pattern: str = FAMILY_NARROW) -> Column:
    return F.regexp_extract(column, pattern, 1)


def metered_usage(profile: Profile = MONTHLY) -> Column:
    """Rows whose capacity counts: usage charges, without the dedicated-bandwidth surcharge."""
    kept = F.col(_TYPE).endswith("Usage")
    if profile.drop_ebs_optimized:
        kept = kept & ~F.col(_USAGE).contains("EBSOptimized")
    return F.coalesce(kept, F.lit(False))


def usage_amount(profile: Profile = MONTHLY) -> Column:
    amount = F.col("line_item_usage_amount")
    if profile.usage_rows_only:
        return F.when(F.col(_TYPE).endswith("Usage"), amount).otherwise(F.lit(0.0))
    return amount


def _capacity(per_hour: Column, profile: Profile) -> Column:
    hours = per_hour.cast("double") * F.col("line_item_usage_amount")
    return F.when(metered_usage(profile), hours).otherwise(F.lit(0.0))


def vcpu_hours(profile: Profile = MONTHLY, exact: bool = True) -> Column:
    return _capacity(text_number(F.col("product_vcpu"), exact=exact), profile)


def gpu_hours(profile: Profile = MONTHLY, exact: bool = True) -> Column:
    return _capacity(text_number(F.col("product_gpu"), "N/A", exact=exact), profile)


def memory_hours(profile: Profile = MONTHLY, exact: bool = True) -> Column:
    digits = F.replace(F.regexp_extract("product_memory", MEMORY_TEXT, 1), F.lit(","), F.lit(""))
    from_text = text_number(digits, exact=exact)
    from_number = text_number(F.col("product_memory_gib"), exact=exact)
    return _capacity(F.coalesce(from_text, from_number), profile)


def charge_class(profile: Profile = MONTHLY) -> Column:
    """One class per line item; classes decide which source column carries each cost view."""
    kind = F.col(_TYPE)
    if profile.named_discounts:
        discount = kind.isin("PrivateRateDiscount", "EdpDiscount")
    else:
        discount = kind.endswith("Discount")
    settled_elsewhere = (
        discount
        | kind.isin("SavingsPlanNegation", "SavingsPlanUpfrontFee")
        | ((kind == "Fee") & _filled("reservation_reservation_a_r_n"))
    )
    classes = F.when(settled_elsewhere, F.lit("zero"))
    if profile.split_lines:
        on_node = F.col(_USAGE).contains("SpotUsage") | F.col(_USAGE).contains("BoxUsage")
        classes = (
            F.when(_filled("split_line_item_parent_resource_id"), F.lit("split"))
            .when(_filled("resource_tags_aws_eks_cluster_name") & on_node, F.lit("zero"))
            .when(settled_elsewhere, F.lit("zero"))
        )
    spot = F.col(_USAGE).contains("Spot") if profile.spot_at_public_price else F.lit(False)
    return (
        classes.when(kind == "DiscountedUsage", F.lit("reserved"))
        .when((kind == "Usage") & spot, F.lit("spot"))
        .when(kind == "SavingsPlanCoveredUsage", F.lit("planned"))
        .when(kind == "RIFee", F.lit("unused_reservation"))
        .when(kind == "SavingsPlanRecurringFee", F.lit("unused_plan"))
        .otherwise(F.lit("plain"))
    )


def _by_class(klass: Column, choices: dict[str, Column], plain: Column) -> Column:
    picked = None
    for name, value in choices.items():
        picked = F.when(klass == name, value) if picked is None else picked.when(klass == name, value)
    return picked.otherwise(plain)


def _unused_reservation(net: bool) -> Column:
    part = "net_" if net else ""
    return F.col(f"reservation_{part}unused_amortized_upfront_fee_for_billing_period") + F.col(
        f"reservation_{part}unused_recurring_fee"
    )


def _unused_plan() -> Column:
    committed = F.col("savings_plan_amortized_upfront_commitment_for_billing_period") + F.col(
        "savings_plan_recurring_commitment_for_billing_period"
    )
    return committed - F.col("savings_plan_used_commitment")


def net_ratio() -> Column:
    """Net over gross; where nothing was billed the upfront commitment carries the ratio instead."""
    return F.when(
        F.col("line_item_unblended_cost") == 0,
        ratio(
            "savings_plan_net_amortized_upfront_commitment_for_billing_period",
            "savings_plan_amortized_upfront_commitment_for_billing_period",
        ),
    ).otherwise(ratio("line_item_net_unblended_cost", "line_item_unblended_cost"))


def ondemand_cost(klass: Column, profile: Profile = MONTHLY) -> Column:
    public = F.col("pricing_public_on_demand_cost")
    choices = {
        "zero": F.lit(0.0),
        "reserved": public,
        "spot": public,
        "planned": public,
        "unused_reservation": _unused_reservation(net=False),
        "unused_plan": _unused_plan(),
    }
    if profile.split_lines:
        choices["split"] = F.col("split_line_item_public_on_demand_split_cost") + F.col(
            "split_line_item_public_on_demand_unused_cost"
        )
    return _by_class(klass, choices, F.col("line_item_unblended_cost"))


def amortized_cost(klass: Column, profile: Profile = MONTHLY) -> Column:
    choices = {
        "zero": F.lit(0.0),
        "reserved": F.col("reservation_effective_cost"),
        "planned": F.col("savings_plan_savings_plan_effective_cost"),
        "unused_reservation": _unused_reservation(net=False),
        "unused_plan": _unused_plan(),
    }
    if profile.split_lines:
        choices["split"] = F.col("split_line_item_split_cost") + F.col("split_line_item_unused_cost")
    return _by_class(klass, choices, F.col("line_item_unblended_cost"))


def net_amortized_cost(klass: Column, profile: Profile = MONTHLY) -> Column:
    choices = {
        "zero": F.lit(0.0),
        "reserved": F.col("reservation_net_effective_cost"),
        "planned": F.col("savings_plan_net_savings_plan_effective_cost"),
        "unused_reservation": _unused_reservation(net=True),
        "unused_plan": _unused_plan() * net_ratio(),
    }
    if profile.split_lines:
        choices["split"] = F.col("split_line_item_net_split_cost") + F.col("split_line_item_net_unused_cost")
    return _by_class(klass, choices, F.col("line_item_net_unblended_cost"))


def charge_category() -> Column:
    """Support, product usage or other (labels are fixed values)."""
    return (
        F.when(F.col("service").contains("Support"), F.lit("技术支持"))
        .when(F.col("charge_type").endswith("Usage"), F.lit("产品"))
        .otherwise(F.lit("其他"))
    )
