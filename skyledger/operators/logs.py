"""Log-line parsers: ``line`` (and ``path``) in, typed columns and ``parse_ok`` out.

Every parser takes any frame with a text column ``line``, batch or streaming, and keeps its other columns. Rows that
are not data lines are dropped; data lines that cannot be read keep ``parse_ok = false`` for the failed-record output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import text
from skyledger.functions.numbers import ratio
from skyledger.functions.timefns import epoch_millis, warehouse_time
from skyledger.operators.keyed import heavy_keys, join_totals
from skyledger.session import cut_lineage

LINE = "line"


def _part(parts: Column, i: int, trim: bool = True) -> Column:
    value = F.get(parts, F.lit(i))
    return F.trim(value) if trim else value


def _finish(df: DataFrame, ts: Column, columns: dict[str, Column], valid: Column | None = None) -> DataFrame:
    kept = [c for c in df.columns if c != LINE and c not in columns and not c.startswith("_")]
    out = df.withColumn("_ts", ts)
    ok = F.col("_ts").isNotNull() if valid is None else F.col("_ts").isNotNull() & valid
    return out.select(
        *kept,
        LINE,
        F.coalesce(ok, F.lit(False)).alias("parse_ok"),
        epoch_millis("_ts").alias("timestamp"),
        *[c.alias(n) for n, c in columns.items()],
    )


def dated_lines(df: DataFrame) -> DataFrame:
    """Data lines of database logs start with a digit."""
    return df.where(F.col(LINE).rlike("^[0-9]"))


def parse_mysql_general(df: DataFrame, database_id: str) -> DataFrame:
    """General query log: time, connection id, command, optional rest of the line."""
    rows = dated_lines(df).withColumn("_p", F.split(F.trim(F.col(LINE)), r"\s+", 4))
    p = F.col("_p")
    rest = F.nullif(F.trim(F.regexp_replace(_part(p, 3), r"\s+", " ")), F.lit(""))
    ts = F.try_to_timestamp(F.substring(_part(p, 0), 1, 23), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS"))
    return _finish(
        rows,
        ts,
        {
            "database_id": F.lit(database_id),
            "id": _part(p, 1),
            "command": _part(p, 2),
            "argument": rest,
        },
        F.size(p) >= 3,
    )


def parse_mysql_audit(df: DataFrame, database_id: str) -> DataFrame:
    """Audit log: ten comma-separated fields, the ninth (object) may be quoted and hold commas."""
    shape = (
        r"^([^,]*),([^,]*),([^,]*),([^,]*),([^,]*),([^,]*),([^,]*),([^,]*),"  # the eight plain fields
        r"(.*),([^,]*)$"  # object, return code
    )
    rows = dated_lines(df)

    def field(i: int) -> Column:
        return F.regexp_extract(LINE, shape, i)

    quoted = field(9).startswith("'") & field(9).endswith("'") & (F.length(field(9)) >= 2)
    plain = F.when(quoted, F.substring(field(9), F.lit(2), F.length(field(9)) - F.lit(2))).otherwise(field(9))
    names = ["serverhost", "username", "host", "connectionid", "queryid", "operation", "database"]
    columns = {"database_id": F.lit(database_id)}
    columns.update({n: field(i) for i, n in enumerate(names, start=2)})
    columns.update({"object": plain, "retcode": field(10)})
    return _finish(rows, F.try_to_timestamp(field(1), F.lit("yyyyMMdd HH:mm:ss")), columns, F.col(LINE).rlike(shape))


def _from_file_name(path: str = "path") -> dict[str, Column]:
    return {
        "account_id": text.file_name_part(path, 0),
        "region": text.file_name_part(path, 2),
        "cluster_id": text.file_name_part(path, 3),
    }


# Fixed value: shape of a warehouse activity record.
ACTIVITY = (
    r"(?s)^'?([^ ]*) UTC \[ db=([^ ]*) user=([^ ]*) pid=([^ ]*) userid=([^ ]*) xid=([^ ]*) \]' LOG: (.*)"
)


def parse_warehouse_activity(df: DataFrame) -> DataFrame:
    """User activity log; continuation lines of a statement do not match and are dropped."""
    rows = df.where(F.col(LINE).rlike(ACTIVITY))
    names = ["recordtime", "db", "user", "pid", "userid", "xid", "query"]
    columns = {n: F.regexp_extract(LINE, ACTIVITY, i) for i, n in enumerate(names, start=1)}
    ts = F.try_to_timestamp(columns["recordtime"], F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return _finish(rows, ts, {**columns, **_from_file_name()})


# Field order of the two pipe-separated warehouse logs.
USER_FIELDS = [
    "userid", "username", "oldusername", "action", "usecreatedb", "usesuper", "usecatupd", "valuntil", "pid", "xid",
    "recordtime",
]
CONNECTION_FIELDS = [
    "event", "recordtime", "remotehost", "remoteport", "pid", "dbname", "username", "authmethod", "duration",
    "sslversion", "sslcipher", "mtu", "sslcompression", "sslexpansion", "iamauthguid", "application_name",
    "driver_version", "os_version", "plugin_name",
]


def _parse_piped(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    rows = df.withColumn("_p", F.split(LINE, r"\|")).where(F.size("_p") >= len(fields))
    columns = {n: _part(F.col("_p"), i) for i, n in enumerate(fields)}
    return _finish(rows, warehouse_time(columns["recordtime"]), {**columns, **_from_file_name()})


def parse_warehouse_user(df: DataFrame) -> DataFrame:
    return _parse_piped(df, USER_FIELDS)


def parse_warehouse_connection(df: DataFrame) -> DataFrame:
    return _parse_piped(df, CONNECTION_FIELDS)


def log_kind(path: Column | str = "path") -> Column:
    """Parser by file name; the order of the tests matters."""
    p = F.col(path) if isinstance(path, str) else path
    return (
        F.when(p.contains("useractivitylog"), F.lit("activity"))
        .when(p.contains("connectionlog"), F.lit("connection"))
        .when(p.contains("userlog"), F.lit("user"))
    )


def cdn_lines(df: DataFrame) -> DataFrame:
    """Data lines of an access log: no header, not shorter than ten characters."""
    return df.where(~F.col(LINE).startswith("#") & (F.length(LINE) >= 10))


def cdn_header_ok(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Header lines whose field list differs from the expected one (empty when all files agree)."""
    expected = "#Fields: " + " ".join(fields)
    return df.where(F.col(LINE).startswith("#Fields:") & (F.trim(F.regexp_replace(LINE, r"\s+", " ")) != expected))


def parse_cdn(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Access log with a known field list; values are whitespace-separated and zipped by position."""
    rows = cdn_lines(df).withColumn("_p", F.split(F.trim(F.col(LINE)), r"\s+"))
    columns = {n: _part(F.col("_p"), i, trim=False) for i, n in enumerate(fields)}
    ts = F.try_to_timestamp(F.concat_ws(" ", columns["date"], columns["time"]), F.lit("yyyy-MM-dd HH:mm:ss"))
    return _finish(rows, ts, columns, F.size("_p") >= len(fields))


#: Distinct layouts that are written into the plan, and bytes of the file map that may be broadcast.
LAYOUTS, MAP_BYTES = 1024, 32 << 20


def parse_cdn_by_header(df: DataFrame, path: str = "path") -> DataFrame:
    """Batch form for mixed layouts: each file's own header names its values; fields come back as a map.

    A first scan takes the header lines alone: the few distinct layouts become a literal, and the files a map to the number of
    theirs. Where that map is measured to be small it is broadcast, and data lines are parsed where they are read; a larger
    one is joined by path. Lines of files without a header are left out; of several headers of a file the first in order
    counts.
    """
    header = df.where(F.col(LINE).startswith("#Fields:")).select(
        path, F.split(F.trim(F.regexp_replace(LINE, "^#Fields:", "")), r"\s+").alias("_names")
    )
    headers = cut_lineage(header.groupBy(path).agg(F.min("_names").alias("_names")))
    layouts = [r[0] for r in headers.select("_names").distinct().orderBy("_names").limit(LAYOUTS + 1).collect()]
    lines = cdn_lines(df)
    if not layouts:
        rows = lines.where(F.lit(False)).withColumn("_names", F.array().cast("array<string>"))
    elif len(layouts) <= LAYOUTS:
        known = F.array(*[F.array(*[F.lit(n) for n in names]) for names in layouts])
        files = headers.select(path, F.array_position(known, F.col("_names")).cast("int").alias("_layout"))
        size = files.agg(F.sum(F.octet_length(path) + F.lit(64))).first()[0] or 0
        if size <= MAP_BYTES:
            rows = lines.join(F.broadcast(files), path)
        else:
            rows = join_totals(lines, files, [path], "inner", salts=heavy_keys(lines, [path]), grows=True)
        rows = rows.withColumn("_names", F.element_at(known, F.col("_layout")))
    else:
        rows = join_totals(lines, headers, [path], "inner", salts=heavy_keys(lines, [path]), grows=True)
    rows = rows.withColumn("_values", F.split(F.trim(F.col(LINE)), r"\s+"))
    n = F.least(F.size("_names"), F.size("_values"))
    fields = F.map_from_arrays(F.slice("_names", F.lit(1), n), F.slice("_values", F.lit(1), n))
    return rows.select(path, fields.alias("fields"))


def download_speed(size: Column | str = "sc-bytes", seconds: Column | str = "time-taken") -> Column:
    """Bytes per second; NULL when no time was taken, so it takes no part in speed statistics."""
    s = F.col(f"`{size}`") if isinstance(size, str) else size
    t = F.col(f"`{seconds}`") if isinstance(seconds, str) else seconds
    return ratio(s.try_cast("double"), t.try_cast("double"))


ACTIVITY_EVENT = "struct<startTime:string,logTime:string,command:string,commandText:string,dbUserName:string,databaseName:string,rowCount:bigint,sessionId:string,type:string>"


def activity_stream(df: DataFrame, prefix: str = "aurora-das-", payload: str = "payload") -> DataFrame:
    """Decoded activity payloads to one row per event, with cluster, time and day-named target index.

    ``df``: payload (JSON text), stream_arn, region.
    """
    schema = f"struct<databaseActivityEventList:array<{ACTIVITY_EVENT}>>"
    rows = df.select(
        "region",
        text.cluster_from_stream("stream_arn").alias("clusterId"),
        F.explode(F.from_json(payload, schema)["databaseActivityEventList"]).alias("e"),
    )
    when = F.coalesce(F.nullif(F.col("e.startTime"), F.lit("")), F.col("e.logTime"))
    ts = F.try_to_timestamp(F.substring(when, 1, 23), F.lit("yyyy-MM-dd HH:mm:ss.SSS"))
    return rows.select(
        "region",
        "clusterId",
        "e.*",
        epoch_millis(ts).alias("timestamp"),
        F.concat(F.lit(prefix), F.substring(when, 1, 10)).alias("index"),
    )


def server_timing(df: DataFrame, header: str = "timing", pop: str = "pop") -> DataFrame:
    """Upstream durations and edge city from a timing header; city falls back to the probe's own location."""
    h = F.coalesce(F.col(header), F.lit(""))

    def duration(name: str) -> Column:
        return F.coalesce(F.regexp_extract(h, f"cdn-upstream-{name};dur=([0-9]+)", 1).try_cast("int"), F.lit(0))

    edge = F.regexp_extract(h, 'cdn-pop;desc="(.+?)"', 1)
    city = F.when(F.length(edge) > 0, F.substring(edge, 1, 3)).otherwise(F.substring(F.col(pop), 1, 3))
    return (
        df.withColumn("dns_ms", duration("dns"))
        .withColumn("connect_ms", duration("connect"))
        .withColumn("first_byte_ms", duration("fbl"))
        .withColumn("city", city)
    )


def disk_listing(df: DataFrame, output: str = "output") -> DataFrame:
    """Rows of a mounted-disk listing: device without its folder, mount path, file system."""
    lines = df.select(*[c for c in df.columns if c != output], F.explode(F.split(output, "\n")).alias("_line"))
    p = F.split("_line", r"\s+")
    return lines.where(F.col("_line").startswith("/dev/")).select(
        *[c for c in df.columns if c != output],
        F.regexp_replace(F.get(p, F.lit(0)), "^/dev/", "").alias("device"),
        F.get(p, F.lit(6)).alias("path"),
        F.get(p, F.lit(1)).alias("fstype"),
    )


def lines_with(df: DataFrame, needle: str) -> DataFrame:
    """Free-text filter on whole lines."""
    return df.where(F.col(LINE).contains(needle))


def new_log_files(
    files: DataFrame, prefix: str, written_after: int | None, min_size: int = 0
) -> DataFrame:
    """Files an incremental pick-up takes: name contains the prefix and ends in a digit, written at or after the mark.

    ``files``: name, last_written (epoch), size. Without a mark it is the first run and every size is taken.
    """
    kept = F.col("name").contains(prefix) & F.col("name").rlike("[0-9]$")
    if written_after is not None:
        kept = kept & (F.col("last_written") >= written_after) & (F.col("size") >= min_size)
    return files.where(kept)


def next_mark(files: DataFrame) -> DataFrame:
    """High-water mark to keep for the next run."""
    return files.agg((F.max("last_written") + F.lit(1)).alias("next_mark"))


def archive_name(started: Column | str, instance: Column | str, file: Column | str) -> Column:
    """``date/instance/backup_<start>/<file>.gz``."""
    s = F.col(started) if isinstance(started, str) else started
    i = F.col(instance) if isinstance(instance, str) else instance
    f = F.col(file) if isinstance(file, str) else file
    return F.concat_ws(
        "/",
        F.date_format(s, "yyyy-MM-dd"),
        i,
        F.concat(F.lit("backup_"), F.date_format(s, "yyyy-MM-dd'T'HH:mm:ss")),
        F.concat(f, F.lit(".gz")),
    )
