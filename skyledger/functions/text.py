"""Text, tag and array columns used across inventories, logs and events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def struct_tag(tags: Column | str, key: str) -> Column:
    """Value of the first ``{key, value}`` tag with this key, NULL when absent."""
    return F.get(F.filter(_col(tags), lambda t: t["key"] == key), F.lit(0))["value"]


def text_tag(tags: Column | str, key: str) -> Column:
    """Value of the first ``"key:value"`` tag with this key, NULL when absent."""
    found = F.get(F.filter(_col(tags), lambda t: t.startswith(f"{key}:")), F.lit(0))
    return F.substring(found, len(key) + 2, 2147483647)


def array_length(array: Column | str) -> Column:
    """Element count, NULL for a NULL array in every mode."""
    return F.when(_col(array).isNotNull(), F.size(_col(array)))


def association_target(association: Column | str) -> Column:
    """Part before the first colon; empty when there is none."""
    a = _col(association)
    return F.when(F.instr(a, ":") > 0, F.substring_index(a, ":", 1)).otherwise(F.when(a.isNotNull(), F.lit("")))


def workload_id(instance: Column | str, *parts: Column | str) -> Column:
    """``instance:pod/cluster/namespace/pod``."""
    return F.concat(_col(instance), F.lit(":pod/"), F.concat_ws("/", *[_col(p) for p in parts]))


def ingress_id(*parts: Column | str) -> Column:
    return F.concat(F.lit("ingress/"), F.concat_ws("/", *[_col(p) for p in parts]))


def first_label(labels: Column | str, *names: str) -> Column:
    """First label that is present (an empty one counts as present), else ''."""
    return F.coalesce(*[F.try_element_at(_col(labels), F.lit(n)) for n in names], F.lit(""))


def node_id(text: Column | str, *drivers: str) -> Column:
    """First non-empty value among the driver keys of a JSON map label, else ''."""
    ids = F.from_json(_col(text), "map<string,string>")
    return F.coalesce(*[F.nullif(F.try_element_at(ids, F.lit(d)), F.lit("")) for d in drivers], F.lit(""))


def file_name_part(path: Column | str, number: int, separator: str = "_") -> Column:
    """``number``-th (from 0) part of the last path segment."""
    name = F.element_at(F.split(_col(path), "/"), -1)
    return F.trim(F.get(F.split(name, separator), F.lit(number)))


def decoded_key(path: Column | str) -> Column:
    return F.try_url_decode(_col(path))


def joined_sorted(array: Column | str, separator: str = "/") -> Column:
    return F.array_join(F.array_sort(_col(array)), separator)


def base_device(device: Column | str) -> Column:
    """``/dev/`` plus the device without its partition digits."""
    return F.concat(F.lit("/dev/"), F.regexp_replace(_col(device), "[0-9]+$", ""))


def partition_number(device: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(device), "([0-9]+)$", 1), F.lit(""))


def device_letter(device: Column | str) -> Column:
    """Last character before the partition digits: the key on which disks of both naming schemes agree."""
    return F.right(F.regexp_replace(_col(device), "[0-9]+$", ""), F.lit(1))


def drive_letter(instance: Column | str) -> Column:
    return F.nullif(F.substring(_col(instance), 1, 1), F.lit(""))


def cluster_from_stream(arn: Column | str) -> Column:
    """Fifth dash part of the stream name in an ARN."""
    stream = F.get(F.split(_col(arn), "/"), F.lit(1))
    return F.get(F.split(stream, "-"), F.lit(4))
