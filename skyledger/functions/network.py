"""IPv4 arithmetic on integers, and addresses of both families as text that sorts like the address."""

from __future__ import annotations

import ipaddress
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


# Four decimal parts of 0 to 255.
DOTTED = r"^(25[0-5]|2[0-4]\d|1?\d?\d)(\.(25[0-5]|2[0-4]\d|1?\d?\d)){3}$"


def ip_number(ip: Column | str) -> Column:
    """Dotted quad as a long; NULL for anything else."""
    text = _col(ip)
    number = F.substring_index(text, ".", 1).try_cast("long")
    for i in (2, 3, 4):
        octet = F.substring_index(F.substring_index(text, ".", i), ".", -1).try_cast("long")
        number = number * F.lit(256) + octet
    return F.when(text.rlike(DOTTED), number)


def ip_text(number: Column | str) -> Column:
    n = _col(number).cast("long")
    return F.concat_ws(".", *[F.pmod(F.shiftright(n, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])


def cidr_prefix(cidr: Column | str) -> Column:
    """Prefix length; a bare address is a /32."""
    return F.coalesce(F.get(F.split(_col(cidr), "/"), F.lit(1)).try_cast("int"), F.lit(32))


def cidr_size(cidr: Column | str) -> Column:
    return F.pow(F.lit(2.0), F.lit(32) - cidr_prefix(cidr)).cast("long")


def cidr_start(cidr: Column | str) -> Column:
    base = ip_number(F.get(F.split(_col(cidr), "/"), F.lit(0)))
    return base - F.pmod(base, cidr_size(cidr))


def cidr_end(cidr: Column | str) -> Column:
    return cidr_start(cidr) + cidr_size(cidr) - F.lit(1)


# An IPv4 address as the last 32 bits of an IPv6 one.
MAPPED = "0" * 20 + "ffff"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once; written out at every use, nested expressions would multiply."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _v6_key(text: Column) -> Column:
    """Key of IPv6 text without an IPv4 tail."""

    def of_halves(halves: Column) -> Column:
        groups = lambda k: F.filter(F.split(F.coalesce(F.get(halves, F.lit(k)), F.lit("")), ":", -1), lambda g: g != "")
        both = F.struct(groups(0).alias("left"), groups(1).alias("right"), (F.size(halves) == 2).alias("short"))

        def of_groups(part: Column) -> Column:
            gap = F.lit(8) - F.size(part["left"]) - F.size(part["right"])
            sound = F.when(part["short"], gap >= 1).otherwise(gap == 0)
            whole = F.concat(part["left"], F.array_repeat(F.lit("0"), F.greatest(gap, F.lit(0))), part["right"])
            return F.when(sound, F.array_join(F.transform(whole, lambda g: F.when(F.length(g) <= 4, F.lpad(g, 4, "0"))), ""))

        return F.when(F.size(halves) <= 2, _let(both, of_groups))

    key = _let(F.split(text, "::", -1), of_halves)
    # groups that are too long leave their place empty
    return F.when(text.rlike("^[0-9a-f:]+$") & ~text.rlike(":::|^:[^:]|[^:]:$") & (F.length(key) == 32), key)


def address_key(ip: Column | str) -> Column:
    """An address of either family as 32 hexadecimal digits that sort as the address; NULL for anything else.

    IPv4 and the IPv4-mapped form of IPv6 give the same key.
    """

    def of_text(text: Column) -> Column:
        mapped = _let(ip_number(text), lambda n: F.concat(F.lit(MAPPED), F.lpad(F.lower(F.hex(n)), 8, "0")))
        tail = F.regexp_extract(text, r":(\d+(?:\.\d+){3})$", 1)
        words = _let(ip_number(tail), lambda n: F.concat_ws(":", F.lower(F.hex(F.shiftright(n, 16))), F.lower(F.hex(n.bitwiseAND(F.lit(65535))))))
        whole = F.when(tail != "", F.when(tail.rlike(DOTTED), F.concat(F.regexp_replace(text, r"\d+(\.\d+){3}$", ""), words))).otherwise(text)
        return F.when(text.rlike(DOTTED), mapped).when(text.contains(":"), _let(whole, _v6_key))

    return _let(F.lower(F.trim(_col(ip))), of_text)


def cidr_keys(cidr: str) -> tuple[str, str] | None:
    """First and last key of a block of either family, NULL text for text that is no block."""
    try:
        block = ipaddress.ip_network(cidr.strip(), strict=False)
    except ValueError:
        return None
    prefix = MAPPED if block.version == 4 else ""
    return tuple(prefix + f"{int(a):0{8 if block.version == 4 else 32}x}" for a in (block[0], block[-1]))


def in_any_cidr(ip: Column | str, cidrs: list[str]) -> Column:
    """Membership in a fixed, parameter-sized CIDR list of either family; false for text that is not an address."""
    key = address_key(ip)
    hit = F.lit(False)
    for cidr in cidrs:
        if bounds := cidr_keys(cidr):
            hit = hit | key.between(*bounds)
    return F.coalesce(hit, F.lit(False))


def subnet_use_limit(cidr: Column | str, spare: int = 20, spare_percent: int = 1) -> Column:
    """Percentage of used addresses at which ``spare`` addresses or ``spare_percent`` percent remain."""
    n = cidr_size(cidr).cast("double")
    return F.least(F.lit(float(100 - spare_percent)), (n - F.lit(float(spare))) * F.lit(100.0) / n)
