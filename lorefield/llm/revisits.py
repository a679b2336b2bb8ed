"""Not-modified revisits of web captures, resolved by an as-of join.

A revisit record stands for a full response that was captured before. For each
canonical URL it is joined to the latest strictly earlier full response, its
validators are checked against that response, and the headers that a
not-modified answer may change are merged into the stored ones.

A URL may hold any share of all captures. Time is therefore cut into as many
ranges as there are shuffle partitions: windows run within one URL and range,
and what a range inherits from earlier ones is one row per URL and range.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from lorefield.functions.strings import once
from lorefield.llm.common import stored

#: Header fields that a not-modified answer does not change.
FIXED_HEADERS = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
                 "proxy-authenticate", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")
URL = r"^\s*([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"
ALL = 1 << 30


def _decoded(part: Column) -> Column:
    """Percent-encoded letters, digits and ``-._~`` as themselves, other codes in upper case; a ``%`` without a code stays."""
    def piece(p: Column, i: Column) -> Column:
        code = F.upper(F.substring(p, 1, 2))
        char, rest = F.char(F.conv(code, 16, 10).cast("int")), F.substring(p, 3, ALL)
        return (F.when(i == 0, p).when(~p.rlike("^[0-9A-Fa-f]{2}"), F.concat(F.lit("%"), p))
                .when(char.rlike("^[A-Za-z0-9._~-]$"), F.concat(char, rest)).otherwise(F.concat(F.lit("%"), code, rest)))
    return F.when(part.contains("%"), F.array_join(F.transform(F.split(part, "%"), piece), "")).otherwise(part)


def _without_dots(path: Column) -> Column:
    """``.`` and ``..`` segments resolved; none goes above the root."""
    none = F.array().cast("array<string>")
    segments = F.slice(F.split(path, "/"), 2, ALL)
    kept = F.aggregate(segments, none, lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
                       .when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    kept = F.concat(kept, F.when(path.rlike(r"/\.\.?$"), F.array(F.lit(""))).otherwise(none))
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def canonical_url(url: Column) -> Column:
    """Host, path and sorted query: no scheme, user, fragment or default port of the scheme; null if not absolute.

    The host is in lower case, percent-encoding is made uniform and dot segments are resolved.
    """
    scheme = F.lower(F.regexp_extract(url, URL, 1))
    named = F.regexp_replace(F.lower(F.regexp_extract(url, URL, 2)), r"^.*@", "")
    port = F.when(scheme == "http", ":(80)?$").when(scheme == "https", ":(443)?$").otherwise(":$")
    host = F.regexp_replace(named, port, F.lit(""))
    path = once(once(once(F.regexp_extract(url, URL, 3), _decoded), _without_dots), lambda p: F.when(p == "", "/").otherwise(p))
    query = once(F.substring(F.regexp_extract(url, URL, 4), 2, ALL), _decoded)
    ordered = F.array_join(F.array_sort(F.array_remove(F.split(query, "&"), "")), "&")
    asked = once(ordered, lambda q: F.when(q == "", "").otherwise(F.concat(F.lit("?"), q)))
    return once(host, lambda h: F.when(h != "", F.concat(h, path, asked)))


def _sorted_headers(headers: Column) -> Column:
    """Entries with lower-case names, in order; of equal names the last value by order counts."""
    entries = F.array_sort(F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
                                       lambda e: F.struct(F.lower(e["key"]).alias("name"), e["value"].alias("value"))))
    return once(entries, lambda all_: F.filter(all_, lambda e, i: F.coalesce(F.get(all_, i + 1)["name"] != e["name"], F.lit(True))))


def _validator(name: str, value: Column) -> Column:
    """Entity tags compare weakly: without their ``W/``."""
    return F.regexp_replace(F.trim(value), "^W/", "") if name == "etag" else value


def merged_headers(stored_fields: Column, fresh_fields: Column) -> Column:
    """Stored fields, with those of the revisit in place of equal names where they may change; in order of names."""
    changing = F.filter(fresh_fields, lambda f: ~f["name"].isin(*FIXED_HEADERS))
    names = F.transform(changing, lambda f: f["name"])
    return F.array_sort(F.concat(F.filter(stored_fields, lambda f: ~F.array_contains(names, f["name"])), changing))


def resolve_revisits(captures: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every revisit with the response it stands for.

    ``captures(record_id, url, captured_at, is_revisit, etag, last_modified,
    digest, headers map<string,string>)`` -> ``record_id, canonical_url,
    captured_at, status, response_id, response_at, response_digest, headers``.

    ``status`` is ``resolved``; ``no_response`` without an earlier full response
    (or without a time or an absolute URL); ``mismatch`` when the first validator
    that both records carry, of etag (compared weakly), last_modified and digest,
    differs, or when they share none. Only resolved rows have merged ``headers`` (an array of
    name and value). Of responses at one time the greatest ``record_id`` counts.
    Repeated rows give repeated rows, other columns are ignored; an empty table
    gives an empty table.
    """
    spark = captures.sparkSession
    rows = captures.select("record_id", canonical_url(F.col("url")).alias("canonical_url"), "captured_at",
                           F.coalesce("is_revisit", F.lit(False)).alias("is_revisit"), "etag", "last_modified", "digest",
                           _sorted_headers(F.col("headers")).alias("fields"))
    # Written once: four steps below read it, and none makes the URLs and headers anew.
    rows = stored(rows.withColumn("at", F.unix_micros(F.col("captured_at").cast("timestamp"))), "captures")
    placed = rows.where("canonical_url is not null and at is not null")
    wanted = ranges or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    bounds = sorted(set(placed.approxQuantile("at", [i / wanted for i in range(1, wanted)], 0.2 / wanted))) if wanted > 1 else []
    cuts = F.array(*[F.lit(int(b)) for b in bounds]).cast("array<bigint>")
    placed = placed.withColumn("range", F.size(F.filter(cuts, lambda c: c <= F.col("at"))))
    full = F.when(~F.col("is_revisit"), F.struct("at", "record_id", "captured_at", "etag", "last_modified", "digest", "fields"))
    latest = placed.where("not is_revisit").groupBy("canonical_url", "range").agg(F.max(full).alias("latest"))
    # What each range with a revisit inherits: the latest response of the ranges before it.
    needing = placed.where("is_revisit").select("canonical_url", "range").distinct()
    both = needing.select("canonical_url", "range", F.lit(True).alias("asks"), F.lit(None).cast(latest.schema["latest"].dataType).alias("latest")).unionByName(
        latest.select("canonical_url", "range", F.lit(False).alias("asks"), "latest"))
    before = Window.partitionBy("canonical_url").orderBy("range").rangeBetween(Window.unboundedPreceding, -1)
    inherited = both.withColumn("inherited", F.max("latest").over(before)).where("asks").select("canonical_url", "range", "inherited")
    within = Window.partitionBy("canonical_url", "range").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    found = (placed.withColumn("near", F.max(full).over(within)).where("is_revisit")
             .join(inherited, ["canonical_url", "range"], "left")
             .withColumn("hit", F.coalesce("near", "inherited")).drop("range", "near", "inherited"))
    lost = rows.where("is_revisit and (canonical_url is null or at is null)")
    every = found.unionByName(lost.withColumn("hit", F.lit(None).cast(found.schema["hit"].dataType)))
    agree = F.lit(False)
    for name in ("digest", "last_modified", "etag"):
        a, b = _validator(name, F.col(name)), _validator(name, F.col(f"hit.{name}"))
        agree = F.when(a.isNotNull() & b.isNotNull(), a == b).otherwise(agree)
    status = F.when(F.col("hit").isNull(), "no_response").when(agree, "resolved").otherwise("mismatch")
    return every.withColumn("status", status).select(
        "record_id", "canonical_url", "captured_at", "status", F.col("hit.record_id").alias("response_id"),
        F.col("hit.captured_at").alias("response_at"), F.col("hit.digest").alias("response_digest"),
        F.when(F.col("status") == "resolved", merged_headers(F.col("hit.fields"), F.col("fields"))).alias("headers"))
