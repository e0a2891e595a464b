"""Not-modified revisits of a crawl, resolved to the full responses they refer to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickmart.session import materialize

#: Header fields that a not-modified response may send to update a stored one.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
DEFAULT_PORTS = {"http": "80", "https": "443"}
#: Records of one time slice, about, until there are MOST_SLICES of them.
SLICE_ROWS, MOST_SLICES = 5_000, 4_096

RECORD = "record_id bigint, type string, url string, at timestamp_ntz, headers map<string,string>, digest string"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case; without user, default port, fragment, a trailing dot of the
    host, and dot segments of the plainest kind; an empty path is '/'. Escapes are written in upper
    case. A text without '://' is only trimmed."""
    url = F.trim(url)
    part = lambda n: F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^?#]*)(\?[^#]*)?", n)
    scheme, host, port, path = F.lower(part(1)), F.regexp_replace(F.lower(part(2)), r"\.+$", ""), part(3), part(4)
    default = F.lit(False)
    for name, number in DEFAULT_PORTS.items():
        default = default | ((scheme == name) & (port == number))
    shown = F.when(default | (port == ""), F.lit("")).otherwise(F.concat(F.lit(":"), port))
    path = F.regexp_replace(F.when(path == "", F.lit("/")).otherwise(path), r"/\.(?=/|$)", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    whole = F.concat(scheme, F.lit("://"), host, shown, path, part(5))
    return F.when(scheme == "", url).otherwise(whole)


def named(headers: Column) -> Column:
    """Headers with names in lower case and trimmed; of names that then clash the last counts."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    pairs = F.transform(entries, lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), F.trim(e["value"]).alias("value")))
    empty = F.create_map().cast("map<string,string>")
    return F.aggregate(pairs, empty, lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["key"]), F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))))


def weak(tag: Column) -> Column:
    """An entity tag as weak comparison sees it."""
    return F.regexp_replace(tag, "^[Ww]/", "")


def latest_before(records: DataFrame, is_source: Column, value: Column, key: str, at: str, tie: str, rows: int) -> DataFrame:
    """Adds ``found``: ``value`` of the last row of ``key`` before this one, in the order (``at``,
    ``tie``), for which ``is_source`` holds. ``records`` must be cheap to read.

    A key of very many rows is cut at quantiles of time; each slice begins with the last value of the
    slices before it, of which there are few, so no key is sorted in one task. Rows of one moment
    stay together.
    """
    n = min(MOST_SLICES, max(1, -(-rows // SLICE_ROWS)))
    ticks = F.unix_micros(F.col(at).cast("timestamp"))
    cuts = records.agg(F.percentile_approx(ticks, [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else []
    cuts = sorted(set(cuts or []))
    sliced = records.withColumns({"_slice": slice_of(ticks, cuts), "_value": F.when(is_source, value)})
    order = F.struct(F.col(at).alias("at"), F.col(tie).alias("tie"))
    ends = sliced.where("_value is not null").groupBy(key, "_slice").agg(F.max_by("_value", order).alias("_last"))
    present = sliced.select(key, "_slice").distinct().join(ends, [key, "_slice"], "left")
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = present.select(key, "_slice", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    within = Window.partitionBy(key, "_slice").orderBy(at, tie).rowsBetween(Window.unboundedPreceding, -1)
    own = sliced.withColumn("_own", F.last("_value", ignorenulls=True).over(within))
    return own.join(carried, [key, "_slice"]).withColumn("found", F.coalesce("_own", "_carried")).drop("_slice", "_value", "_own", "_carried")


def slice_of(ticks: Column, cuts: list[int]) -> Column:
    """The number of cuts below, by halving."""
    def of(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(ticks > cuts[middle], of(middle + 1, high)).otherwise(of(low, middle))

    return of(0, len(cuts))


def resolve_revisits(records: DataFrame, permitted: tuple[str, ...] = PERMITTED) -> DataFrame:
    """One row per revisit record: record_id, canonical_url, resolved_id, outcome, headers.

    ``records`` has the columns of RECORD; ``type`` is 'response' (a full one) or 'revisit' (not
    modified), others are passed over. A revisit refers to the latest earlier response of its
    canonical URL, in the order (at, record_id). Its validators must agree: a payload digest where
    both have one, else the entity tag by weak comparison, else the last-modified date. ``outcome``:

    - 'resolved': resolved_id is the response; headers are its own, updated by the revisit's
      ``permitted`` ones;
    - 'mismatch': the response found has other validators; 'unproven': there is none to compare;
      resolved_id and headers are null in both cases;
    - 'unknown': there is no earlier response. Nor is there for a null url or time.

    Header names are compared in lower case; null headers are none. Repeated records are resolved
    one by one; a response repeated under one id is one. An empty table gives no rows; other columns
    are not read.
    """
    rows = records.select(
        "record_id", "type", canonical_url(F.col("url")).alias("canonical_url"), "at", named(F.col("headers")).alias("headers"), "digest"
    ).where(F.col("type").isin("response", "revisit"))
    rows = materialize(rows, "records")
    response = F.struct("record_id", "headers", "digest")
    known = (F.col("type") == "response") & F.col("canonical_url").isNotNull() & F.col("at").isNotNull()
    found = latest_before(rows, known, response, "canonical_url", "at", "record_id", rows.count())
    unplaced = rows.where("canonical_url is null").withColumn("found", F.lit(None).cast(found.schema["found"].dataType))
    found = found.unionByName(unplaced).where("type = 'revisit'")
    found = found.withColumn("found", F.when(F.col("at").isNotNull(), F.col("found")))

    def agrees(mine: Column, theirs: Column, otherwise: Column) -> Column:
        return F.when(mine.isNotNull() & theirs.isNotNull(), mine == theirs).otherwise(otherwise)

    tag = lambda h: weak(F.element_at(h, F.lit("etag")))
    date = lambda h: F.element_at(h, F.lit("last-modified"))
    theirs = F.col("found")["headers"]
    dates = agrees(date(F.col("headers")), date(theirs), F.lit(None).cast("boolean"))
    valid = agrees(F.col("digest"), F.col("found")["digest"], agrees(tag(F.col("headers")), tag(theirs), dates))
    outcome = F.when(F.col("found").isNull(), "unknown").when(valid.isNull(), "unproven").when(valid, "resolved").otherwise("mismatch")
    update = F.map_filter("headers", lambda name, _: name.isin(*permitted))
    merged = F.map_concat(F.map_filter(theirs, lambda name, _: ~F.array_contains(F.map_keys(update), name)), update)
    resolved = outcome == "resolved"
    return found.select(
        "record_id", "canonical_url", F.when(resolved, F.col("found")["record_id"]).alias("resolved_id"), outcome.alias("outcome"),
        F.when(resolved, merged).alias("headers"),
    )


#: What happens at an address, a second apart: record type and the version of the page it is about (0: the
#: second version, and the first where page ids are divisible by 3).
STEPS = (("revisit", 1), ("response", 1), ("revisit", 1), ("response", 2), ("revisit", 0), ("revisit", 2))


def capture_records(pages: DataFrame) -> DataFrame:
    """A crawl's records made from pages, as RECORD: each page's address is seen six times (STEPS), in two
    versions. Record ids fall with time inside an address, and revisits spell it otherwise.

    By page ids modulo 4 the responses carry an entity tag, a last-modified date, a payload digest or no
    validator. Revisits carry all three of the version they are about, but for the last one where page ids
    modulo 5 are 4, which has none. So a revisit follows no response, one, or several of other versions,
    directly or not, and each outcome occurs."""
    page = F.coalesce(F.col("page_id"), F.lit(-1)).cast("bigint")
    body, way = F.coalesce(F.col("html"), F.lit("")), F.pmod(page, F.lit(4))
    name, size = F.md5(body.cast("binary")), F.octet_length(body).cast("string")
    again = F.concat(F.regexp_replace("url", "^http", "HTTP"), F.lit("#part"))
    rows = pages.select("url", page.alias("page"), way.alias("way"), name.alias("name"), size.alias("size"), again.alias("again"))

    def record(number: int, kind: str, version: int) -> Column:
        page, way = F.col("page"), F.col("way")
        about = F.lit(version) if version else F.when(F.pmod(page, F.lit(3)) == 0, 1).otherwise(2)
        tag = F.concat(F.col("name"), F.lit("-"), about.cast("string"))
        modified, digest = F.concat(F.lit("version "), about.cast("string")), F.concat(F.lit("md5:"), tag)
        seconds = 6 * page + number
        at = (F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp")) + seconds)).cast("timestamp_ntz")
        day, text = F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit("text/html")
        if kind == "response":
            url = F.col("url")
            fields = {"ETag": F.when(way == 0, tag), "Last-Modified": F.when(way == 1, modified), "Content-Length": F.col("size"), "Content-Type": text, "Date": day}
            digest = F.when(way == 2, digest)
        else:
            url = F.col("again")
            named = (F.pmod(page, F.lit(5)) != 4) if number == 5 else F.lit(True)
            fields = {"etag": F.when(named, F.concat(F.lit("W/"), tag)), "last-modified": F.when(named, modified), "content-length": F.lit("0"), "date": day, "expires": F.lit("never")}
            digest = F.when(named, digest)
        pairs = F.create_map(*[x for field, value in fields.items() for x in (F.lit(field), value)])
        headers = F.map_filter(pairs, lambda _, value: value.isNotNull())
        return F.struct(
            (6 * page + 5 - number).alias("record_id"), F.lit(kind).alias("type"), url.alias("url"), at.alias("at"), headers.alias("headers"), digest.alias("digest")
        )

    seen = F.array(*[record(number, kind, version) for number, (kind, version) in enumerate(STEPS)])
    return rows.select(F.explode(seen).alias("record")).select("record.*")
