"""WARC archives with revisit records, read back by boundary-chain verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, remove

MAGIC = "WARC/1.1\r\n"
CRLF2 = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:marshlight:page:"


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of binary data: five hex digits at a time become four base32 digits."""
    h = F.sha1(payload)
    part = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*part), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", min_bytes: int = 0, records_per_file: int = 2048, small: int = 400_000) -> None:
    """Write one record per row of ``page_id, url, html`` to uncompressed archives under ``path``.

    Among records whose payloads (html as UTF-8, null: empty) are equal and hold at least ``min_bytes`` bytes,
    the one with the largest page id is a response and the others are revisits that refer to it; smaller
    payloads are all responses. Pages meet one row per payload that repeats (a digest and an id, under a hundred
    bytes): broadcast up to ``small`` of them, else in a join whose hot payloads Spark can split. A record ends
    with a line feed, so Spark's text writer lays down the archive's very bytes. Line breaks and spaces in a url
    are percent-encoded.

    Rows without a page id are responses with an empty id; rows that repeat are records each, and responses both
    if their id is the largest; a payload may be as long as a string can be; an empty table writes no records;
    other columns are left out, whatever their names.
    """
    rows = pages.select(F.col("page_id").cast("string").alias("id"), F.col("page_id").alias("num"), F.col("url"), F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", payload_digest(F.col("payload").cast("binary")))
    size = F.octet_length("payload").cast("long")
    same = rows.filter(F.col("num").isNotNull() & (size >= min_bytes)).groupBy("digest").agg(F.max("num").alias("keeper"), F.count("*").alias("n")).filter("n > 1")
    same, same_path = materialize(same.select(F.col("digest").alias("shared"), "keeper"), "repeated")
    if same.count() <= small:
        same = F.broadcast(same)
    again = (F.col("digest") == F.col("shared")) & (F.col("num") != F.col("keeper")) & (size >= min_bytes)
    rows = rows.join(same, again, "left")
    size = F.octet_length("payload")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(CRLF2))
    block = F.when(F.col("keeper").isNull(), F.concat(http, F.col("payload"))).otherwise(http)
    url = F.replace(F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(" "), F.lit("%20"))
    lines = [
        F.concat(F.lit("WARC-Type: "), F.when(F.col("keeper").isNull(), "response").otherwise("revisit")),
        F.concat(F.lit(f"WARC-Record-ID: <{URN}"), F.coalesce("id", F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), size.cast("string")),
        F.when(F.col("keeper").isNotNull(), F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <{URN}"), F.col("keeper").cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.concat(F.lit(MAGIC), F.concat_ws("\r\n", *lines), F.lit(CRLF2), block, F.lit("\r\n\r"))
    rows.select(record.alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", records_per_file).text(path)
    remove(pages.sparkSession, same_path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """Every stretch of the archives between two magics, with its file, block and place in the block."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("seq"), F.col("_metadata.file_size").alias("size")
    )


def _header(name: str, head: Column) -> Column:
    got = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(got != "", got)


def _payload(block: Column) -> Column:
    """What follows the HTTP header in a response's block."""
    end = F.octet_length(F.substring_index(block, CRLF2, 1))
    raw = block.cast("binary")
    return F.substring(raw, end + 5, F.octet_length(block) - end - 4)


def candidates(chunks: DataFrame) -> DataFrame:
    """Each chunk as if its magic began a record: its own offset, its successor's, and its header fields.

    A block's rows are in file order, so offsets are running sums of byte lengths per file; only lengths and
    header fields are shuffled. ``digest`` is that of the payload where the chunk holds the whole record.
    """
    head = F.substring_index("value", CRLF2, 1)
    length = F.expr("try_cast(content_length AS bigint)")
    df = chunks.withColumn("bytes", F.octet_length("value").cast("long")).withColumn("head", F.when(F.instr("value", CRLF2) > 0, head))
    df = df.withColumn("content_length", _header("Content-Length", F.col("head"))).withColumn("content_length", length)
    body = F.octet_length("head") + 4
    df = df.withColumn("jump", body + F.col("content_length") + 4)
    rest = F.substring(F.col("value").cast("binary"), body + 1, F.col("content_length").cast("int")).cast("string")
    df = df.withColumn("whole", F.coalesce(F.col("jump") == F.col("bytes"), F.lit(False)))
    kind = _header("WARC-Type", F.col("head"))
    paid = _payload(rest).cast("binary")
    df = df.select(
        "file", "start", "seq", "size", "bytes", "jump", "whole", kind.alias("kind"),
        F.regexp_extract(F.coalesce(_header("WARC-Record-ID", F.col("head")), F.lit("")), rf"^<{URN}(.*)>$", 1).alias("id"),
        F.regexp_extract(F.coalesce(_header("WARC-Refers-To", F.col("head")), F.lit("")), rf"^<{URN}(.*)>$", 1).alias("refers"),
        F.regexp_extract(F.coalesce(_header("WARC-Payload-Digest", F.col("head")), F.lit("")), "^sha1:(.*)$", 1).alias("said_digest"),
        _header("X-Payload-Length", F.col("head")).alias("said_bytes"),
        F.when(F.col("whole") & (kind == "response"), payload_digest(paid)).alias("digest"),
        F.when(F.col("whole") & (kind == "response"), F.octet_length(paid).cast("long")).alias("paid_bytes"),
    )
    order = Window.partitionBy("file").orderBy("start", "seq").rowsBetween(Window.unboundedPreceding, -1)
    width = F.lit(len(MAGIC))
    # the chunk before the first magic is empty in a sound archive; a magic stands before every later one
    df = df.withColumn("offset", F.coalesce(F.sum(F.col("bytes") + width).over(order), F.lit(0)) - width)
    return df.withColumn("next", F.when(F.col("kind").isNotNull(), F.col("offset") + width + F.col("jump")))


def reachable(cands: DataFrame, rounds: int = 40) -> tuple[DataFrame, list[str]]:
    """Offsets that the chain from each file's start reaches, by pointer jumping: after round t the table of
    jumps spans 2^t records and the reached set doubles, so the rounds are the logarithm of a file's records."""
    real = cands.filter("offset >= 0 AND next IS NOT NULL").select("file", "offset", "next")
    jumps, path = materialize(real.join(real.select("file", F.col("offset").alias("next")), ["file", "next"], "left_semi").select("file", "offset", "next"), "jumps")
    reached, reached_path = materialize(real.filter("offset = 0").select("file", "offset"), "reached")
    for _ in range(rounds):
        if not jumps.limit(1).count():
            break
        further = jumps.join(reached, ["file", "offset"], "left_semi").select("file", F.col("next").alias("offset"))
        new, new_path = materialize(reached.union(further).distinct(), "reached")
        twice = jumps.alias("a").join(jumps.select("file", F.col("offset").alias("next"), F.col("next").alias("then")), ["file", "next"]).select("file", "offset", F.col("then").alias("next"))
        longer, longer_path = materialize(twice, "jumps")
        remove(jumps.sparkSession, path, reached_path)
        reached, reached_path, jumps, path = new, new_path, longer, longer_path
    remove(jumps.sparkSession, path)
    return reached, [reached_path]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id string, payload_bytes, payload_digest, record_type, refers_to string`` of every record on the
    boundary chains of the archives under ``path``.

    Tasks read byte ranges and emit a candidate for every magic; those inside payloads are not reached from the
    file's start and fall away. A response whose payload holds magics is put together again from its chunks,
    which only such records cost a second read. Digest and length of a response are those of the bytes read; a
    revisit has them in its header. A damaged record ends its file's chain.
    """
    cands, _ = materialize(candidates(_chunks(spark, path)), "candidates")
    reached, _ = reachable(cands)
    records = cands.join(reached, ["file", "offset"], "left_semi")
    # chunks that belong to a reached record which is longer than its own chunk
    long = records.filter("NOT whole AND kind = 'response'").select("file", F.col("offset").alias("first"), F.col("next").alias("stop"))
    parts = cands.select("file", "start", "seq", "offset").join(long, "file").filter("offset >= first AND offset < stop").select("file", "start", "seq", "first", "offset")
    parts, parts_path = materialize(parts, "parts")
    if parts.limit(1).count():
        bits = _chunks(spark, path).join(parts, ["file", "start", "seq"]).groupBy("file", "first").agg(F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("bits"))
        text = F.array_join(F.transform("bits", lambda b: b["value"]), MAGIC)
        bits = bits.withColumn("text", text).withColumn("head", F.substring_index("text", CRLF2, 1))
        size = _header("Content-Length", F.col("head")).cast("int")
        block = F.substring(F.col("text").cast("binary"), F.octet_length("head") + 5, size).cast("string")
        paid = _payload(block).cast("binary")
        mended = bits.select("file", F.col("first").alias("offset"), payload_digest(paid).alias("m_digest"), F.octet_length(paid).cast("long").alias("m_bytes"))
        records = records.join(mended, ["file", "offset"], "left")
    else:
        remove(spark, parts_path)
        records = records.withColumns({"m_digest": F.lit(None).cast("string"), "m_bytes": F.lit(None).cast("long")})
    return records.select(
        F.when(F.col("id") != "", F.col("id")).alias("page_id"),
        F.coalesce("m_bytes", "paid_bytes", F.expr("try_cast(said_bytes AS bigint)")).alias("payload_bytes"),
        F.coalesce("m_digest", "digest", "said_digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.when((F.col("kind") == "revisit") & (F.col("refers") != ""), F.col("refers")).alias("refers_to"),
    )
