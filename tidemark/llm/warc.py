"""WARC archives: deduplicating writer, and a reader by boundary-chain verification.

Writing is a text write whose line separator is the end of a record.  A payload
met again is written as a revisit of the first record that has it.

Reading cuts the files at the record magic, which Spark's text reader does for
any split of a file.  A magic may also stand inside a payload, so each piece is
only a candidate: its header says where its successor must start.  Pointer
jumping from the start of every file (jumps of 1, 2, 4 ... records) marks the
candidates that a chain of successors reaches; all others are payload.  A record
whose payload holds a magic is put together again from its pieces.

Defined results: a null payload is an empty one; without a URL a record has no
target; of equal payloads the row with the least id (null last), then the least
URL, is the response, of fully equal rows one; a file cut short gives its records
up to the cut; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import new_path, stored, text_of

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"  # the tables hold no fetch time


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: eight digits from each ten hex digits."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in range(1, 41, 10)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(*parts: Column) -> Column:
    m = F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts)))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(m, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _typed(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``pages`` (id, url, payload, key) with ``first`` (the response's id and URL of a
    payload met more than once) and ``is_response``."""
    each = pages.where(F.octet_length("payload") >= min_bytes).groupBy("key", "id", "url").count()
    first = F.min(F.struct(F.col("id").isNull().alias("a"), "id", F.col("url").isNull().alias("b"), "url", "count")).alias("first")
    firsts = stored(each.groupBy("key").agg(first, F.sum("count").alias("all")).where("all > 1").select(F.col("key").alias("first_key"), "first"), "firsts")
    joined = pages.join(firsts, F.col("key") == F.col("first_key"), "left")
    is_first = F.col("first_key").isNotNull() & F.col("id").eqNullSafe(F.col("first.id")) & F.col("url").eqNullSafe(F.col("first.url"))
    out = joined.withColumn("is_response", F.col("first_key").isNull() | is_first)
    if not firsts.where("first.count > 1").isEmpty():  # fully equal rows: one response, the others revisit it
        equal = is_first & (F.col("first.count") > 1)
        copies = joined.where(equal).groupBy("key").agg(F.first(F.struct(*joined.columns)).alias("r")).select("r.*")
        copies = copies.withColumn("copy", F.explode(F.expr("sequence(0, cast(first.count as int) - 1)"))).withColumn("is_response", F.col("copy") == 0).drop("copy")
        out = out.where(~F.coalesce(equal, F.lit(False))).unionByName(copies)
    return out


def write_archives(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0) -> str:
    """Write a record for every row; returns the folder of the archive files."""
    path = path or new_path(pages.sparkSession, "warc")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url).cast("string").alias("url"), text_of(payload).alias("payload"))
    rows = _typed(rows.withColumn("key", F.sha2("payload", 256)), min_bytes)
    # Nothing refers to a revisit, so any serial number will do for it.
    rows = rows.withColumn("serial", F.when(F.col("is_response"), F.lit(-1)).otherwise(F.monotonically_increasing_id()))
    size = F.octet_length("payload").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END))
    block = F.when(F.col("is_response"), F.concat(http, F.col("payload"))).otherwise(http)
    field = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = ~F.col("is_response")
    head = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        field("WARC-Record-ID", _uuid(F.col("id"), F.col("url"), F.col("key"), F.col("serial"))), F.lit(f"WARC-Date: {DATE}\r\n"), field("WARC-Target-URI", target),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        field("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
        field("WARC-Refers-To", F.when(revisit, _uuid(F.col("first.id"), F.col("first.url"), F.col("key"), F.lit(-1)))),
        field("X-Page-Id", F.col("id").cast("string")), field("X-Refers-To-Page-Id", F.when(revisit, F.col("first.id").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"), field("Content-Length", F.octet_length("block").cast("string")), F.lit("\r\n"))
    rows.withColumn("block", block).select(F.concat(head, F.col("block"))).write.option("lineSep", END).text(path)
    return path


def _pieces(spark, path: str) -> DataFrame:
    """The text between magics, as raw bytes in a string, with its place."""
    read = spark.read.option("lineSep", MAGIC).text(path)
    return read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_size"),
                       F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("m"))


def _described(pieces: DataFrame, payload: bool) -> DataFrame:
    """Header fields of each candidate; payload size and digest where ``value`` is the whole record."""
    header = F.concat(F.lit("\r\n"), F.substring_index("value", END, 1), F.lit("\r\n"))
    field = lambda name: F.nullif(F.regexp_extract("header", f"(?i)\r\n{name}: *([^\r]*)\r\n", 1), F.lit(""))
    out = pieces.withColumn("header", header).withColumn("head_bytes", F.octet_length("header"))
    out = out.withColumns({"n": F.octet_length("value"), "type": field("WARC-Type"), "length": field("Content-Length").try_cast("bigint"), "target": field("WARC-Target-URI"),
                           "record_id": field("WARC-Record-ID"), "page_id": field("X-Page-Id").try_cast("bigint"), "refers_to": field("X-Refers-To-Page-Id").try_cast("bigint"),
                           "declared": F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "")})
    out = out.withColumn("whole", F.coalesce(F.col("type").isNotNull() & (F.col("head_bytes") + F.col("length") + 4 == F.col("n")), F.lit(False)))
    block = F.when(F.col("whole"), F.expr("substring(cast(value as binary), head_bytes + 1, cast(length as int))"))
    out = out.withColumn("block", block).withColumn("http", F.substring_index(F.col("block").cast("string"), END, 1))
    body = F.expr("substring(block, octet_length(http) + 5, octet_length(block))")
    declared = F.regexp_extract(F.concat(F.lit("\r\n"), "http", F.lit("\r\n")), "(?i)\r\nContent-Length: *([0-9]+)\r\n", 1).try_cast("bigint")
    out = out.withColumn("body", body).withColumns({
        "payload_bytes": F.when(F.col("type") == "revisit", declared).otherwise(F.octet_length("body").cast("bigint")),
        "payload_digest": F.when(F.col("type") == "revisit", F.col("declared")).otherwise(base32_sha1(F.col("body")))})
    out = out.withColumn("intact", F.col("payload_digest") == F.col("declared"))
    return out.drop("value", "header", "http", "block", *([] if payload else ["body"]))


def _offsets(pieces: DataFrame) -> DataFrame:
    """Add ``at``, the byte where the piece's magic stands (negative: none before it).
    The pieces of a file's parts, in order, with their magics are all of its bytes."""
    parts = pieces.groupBy("file", "part").agg(F.sum(F.col("n") + len(MAGIC)).alias("all"))
    before = F.sum("all").over(Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("file", "part", F.coalesce(before, F.lit(0)).alias("before"))
    inner = F.sum(F.col("n") + len(MAGIC)).over(Window.partitionBy("file", "part").orderBy("m").rowsBetween(Window.unboundedPreceding, -1))
    at = F.col("before") + F.coalesce("inner", F.lit(0)) - len(MAGIC)
    return pieces.withColumn("inner", inner).join(parts, ["file", "part"]).withColumn("at", at).drop("inner", "before")


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, at) of the candidates (file, at, next) that successors lead to from byte 0."""
    known = candidates.select("file", "at")
    jumps = stored(candidates.select("file", "at", "next").join(known.select("file", F.col("at").alias("next")), ["file", "next"]).select("file", "at", "next"), "jumps")
    found = stored(known.where("at = 0"), "reached")
    count = found.count()
    while count:
        step = found.join(jumps, ["file", "at"]).select("file", F.col("next").alias("at"))
        found = stored(found.unionByName(step), "reached")
        total = found.count()
        if total == count:
            break
        count = total
        further = jumps.select("file", F.col("at").alias("next"), F.col("next").alias("then"))
        jumps = stored(jumps.join(further, ["file", "next"]).select("file", "at", F.col("then").alias("next")), "jumps")
    return found


def read_archives(spark, path: str, payload: bool = False) -> DataFrame:
    """The records of all archive files of ``path``: ``page_id``, ``record_id``,
    ``target``, ``record_type``, ``payload_bytes``, ``payload_digest`` (of the bytes
    read; of a revisit the one declared), ``intact`` (as declared), ``refers_to``;
    with ``payload`` also the bytes."""
    columns = ["page_id", "record_id", "target", F.col("type").alias("record_type"), "payload_bytes", "payload_digest", "intact", "refers_to"] + [F.col("body").alias("payload")] * payload
    pieces = stored(_offsets(stored(_described(_pieces(spark, path), payload), "pieces")), "candidates")
    after = F.col("at") + len(MAGIC) + F.col("head_bytes") + F.col("length") + 4
    candidates = pieces.where("at >= 0 and type is not null and length is not null").withColumn("next", after).where("next <= file_size")
    reached = reachable(stored(candidates.select("file", "at", "next"), "chain"))
    records = candidates.join(reached, ["file", "at"])
    broken = stored(records.where("not whole").select("file", "at", "next"), "broken")
    out = records.where("whole").select(*columns)
    return out if broken.isEmpty() else out.unionByName(_mended(spark, path, broken, payload).select(*columns))


def _mended(spark, path: str, broken: DataFrame, payload: bool) -> DataFrame:
    """The records whose payload holds a magic, joined from their pieces."""
    pieces = _pieces(spark, path).join(broken.select("file").distinct(), "file", "left_semi").withColumn("n", F.octet_length("value"))
    pieces = _offsets(pieces).join(broken.select("file", "at", F.col("next").alias("ends"), F.lit(True).alias("starts")), ["file", "at"], "left")
    so_far = Window.partitionBy("file").orderBy("at")
    own = pieces.withColumn("record", F.last(F.when(F.col("starts"), F.struct("at", "ends")), ignorenulls=True).over(so_far))
    own = own.where(F.col("record").isNotNull() & (F.col("at") < F.col("record.ends")))
    joined = own.groupBy("file", F.col("record.at").alias("at")).agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"))
    return _described(joined.select("file", "at", F.array_join("parts.value", MAGIC).alias("value")), payload)


def op2(spark, sf_dir: str) -> DataFrame:
    path = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# DuckDB has no base32; Spark's digits come from hex, so do these.
OP2_SQL = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
q as (select *, min(page_id) over (partition by html) as first from p)
select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes,
       (select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 1 + cast((cast('0x' || substr(h, 1 + 10 * (i // 8), 10) as bigint) >> (35 - 5 * (i % 8))) & 31 as int), 1), '' order by i)
        from (select unnest(range(0, 32)) as i)) as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id = first then null else first end as refers_to
from q
"""
