"""WARC archives: write one record per page, read them back by verified record boundaries.

Archives are plain WARC/1.0 files that Spark's text writer puts into the shared folder, one file per task, so that writing is
committed by Spark and survives lost executors. Reading splits each file at every place where the record magic stands, in
parallel and also inside one file. Such a place is only a candidate: payloads may hold the magic too. Each candidate names
its successor (its offset plus the length that its header states). Chains are followed inside a block by one task, then from
block to block by pointer jumping from the start of the file; what is not reached is payload.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statpanel.llm.common import written

#: Fixed values of the WARC format.
MAGIC = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
HEAD_END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of binary data: 5 hex digits are 20 bits, and so 4 base32 digits."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32_DIGITS)


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def _records(pages: DataFrame, min_revisit_bytes: int, date: str) -> DataFrame:
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace("url", r"[\x00-\x20]", "%20").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("digest", base32_sha1(F.col("html").cast("binary")))
    sized = base.select("page_id", "digest", F.octet_length("html").alias("n"))
    copies = sized.filter(F.col("n") >= min_revisit_bytes).groupBy("digest")
    copies = copies.agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    copies = written(copies.select("digest", "first"), "warc-copies")
    # Spark broadcasts the copied digests if they are small, and else splits the partitions of a hot digest.
    joined = base.join(copies, "digest", "left")
    refers = F.when(F.col("page_id") > F.col("first"), F.col("first"))
    block = F.when(refers.isNull(), F.concat(F.lit(HTTP_HEAD), F.col("html"))).otherwise(F.lit(HTTP_HEAD))
    head = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(refers.isNull(), "response").otherwise("revisit")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), refers.cast("string"), F.lit(">"))),
        _line("WARC-Target-URI", F.col("url")),
        F.lit(f"WARC-Date: {date}\r\n"),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("X-Payload-Length", F.octet_length("html")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
    )
    return joined.select(F.concat(head, block).alias("value"))


def write_archives(
    pages: DataFrame, path: str, min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z"
) -> None:
    """Write one WARC record per row of pages (page_id, url, html; other columns are ignored).

    Of rows with equal payloads of at least `min_revisit_bytes` bytes the one with the smallest page_id becomes a response and the
    others revisits without payload; shorter payloads are all responses. Rows that repeat the smallest page_id
    are all responses. Null html is an empty payload, a null url or page_id is left out of the record, and a null page_id
    is always a response. White space and control characters in a url become %20. An empty table
    gives an archive without records.
    """
    records = _records(pages, min_revisit_bytes, date)
    records.write.option("lineSep", RECORD_END).text(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at every magic. Every row but a file's first begins behind a magic."""
    read = spark.read.option("lineSep", MAGIC).text(path)
    return read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        (F.octet_length("value") + len(MAGIC)).cast("long").alias("size"),
        F.col("value"),
    )


def _located(segments: DataFrame) -> DataFrame:
    """Adds `offset`, the place of the magic in its file: running sums inside a block, then over the file's blocks."""
    by_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    by_block = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    blocks = segments.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("bytes").over(by_file), F.lit(0)).alias("before"))
    inside = segments.withColumn("inside", F.coalesce(F.sum("size").over(by_block), F.lit(0)))
    placed = inside.join(blocks, ["file", "block"])
    placed = placed.withColumn("offset", F.col("before") + F.col("inside") - len(MAGIC))
    return placed.filter("offset >= 0").drop("before", "inside")


def _parsed(segments: DataFrame) -> DataFrame:
    """Header fields of each candidate; the payload's digest where the candidate ends just before the next magic."""
    head = F.substring_index("value", HEAD_END, 1)
    field = lambda name, what: F.regexp_extract(head, rf"(?i)(?:^|\n){name}: *{what}", 1)
    head_bytes = F.octet_length(head) + len(HEAD_END)
    length = F.try_to_number(F.nullif(field("Content-Length", r"(\d{1,15})"), F.lit("")), F.lit("9" * 15)).cast("long")
    out = segments.withColumns({"head_bytes": head_bytes, "length": length})
    whole = F.col("head_bytes") + F.col("length") + len(RECORD_END) + len(MAGIC) == F.col("size")
    return out.withColumns(
        {
            "kind": field("WARC-Type", r"(\w+)"),
            "page": field("WARC-Record-ID", r"<urn:page:(-?\d+)>"),
            "refers": field("WARC-Refers-To", r"<urn:page:(-?\d+)>"),
            "stated_digest": field("WARC-Payload-Digest", r"sha1:(\w+)"),
            "stated_bytes": field("X-Payload-Length", r"(\d+)"),
            "block_digest": F.when(whole, _payload_digest(F.col("value"), F.col("head_bytes"), F.col("length"))),
        }
    )


def _payload(value: Column, head_bytes: Column, length: Column) -> Column:
    data = value.cast("binary")
    return F.substring(data, head_bytes + 1 + len(HTTP_HEAD), length - len(HTTP_HEAD))


def _payload_digest(value: Column, head_bytes: Column, length: Column) -> Column:
    return base32_sha1(_payload(value, head_bytes, length))


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """Follow the chains of one block of a file as far as they stay in it: where each candidate's chain leaves."""
    pdf = pdf.sort_values("offset")
    leaves: dict[int, int] = {}
    for at, to in zip(pdf["offset"][::-1], pdf["successor"][::-1]):
        leaves[at] = leaves.get(to, to)
    return pdf.assign(leaves=[leaves[at] for at in pdf["offset"]])[["file", "block", "offset", "successor", "leaves"]]


def _walk(pdf: pd.DataFrame) -> pd.DataFrame:
    """The candidates of one block that are reached from where chains enter it."""
    step = dict(zip(pdf["offset"], pdf["successor"]))
    reached = set()
    for at in pdf["offset"][pdf["entered"]]:
        while at in step and at not in reached:
            reached.add(at)
            at = step[at]
    return pdf[pdf["offset"].isin(reached)][["file", "offset", "successor"]]


def _reachable(candidates: DataFrame) -> DataFrame:
    """The candidates (file, block, offset, successor) on the chain from the start of their file."""
    local = candidates.groupBy("file", "block")
    schema = "file string, block long, offset long, successor long, leaves long"
    local = written(local.applyInPandas(_exits, schema), "warc-chains")
    doors = local.select("file", F.col("leaves").alias("offset")).distinct()
    doors = doors.union(local.select("file", F.lit(0).cast("long"))).distinct()
    jump = written(local.select("file", "offset", "leaves").join(doors, ["file", "offset"]), "warc-jumps")
    reached = jump.filter("offset = 0").select("file", "offset")
    while not jump.isEmpty():
        step = reached.join(jump, ["file", "offset"]).select("file", F.col("leaves").alias("offset"))
        reached = written(reached.union(step).distinct(), "warc-reached")
        then = jump.select("file", F.col("offset").alias("leaves"), F.col("leaves").alias("further"))
        jump = jump.join(then, ["file", "leaves"]).select("file", "offset", F.col("further").alias("leaves"))
        jump = written(jump, "warc-jumps")
    entered = local.join(reached.withColumn("hit", F.lit(True)), ["file", "offset"], "left")
    entered = entered.select("file", "block", "offset", "successor", F.coalesce("hit", F.lit(False)).alias("entered"))
    schema = "file string, offset long, successor long"
    return entered.groupBy("file", "block").applyInPandas(_walk, schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives in `path`: file, offset, page_id, record_type, refers_to, payload_bytes, payload_digest.

    Digests and sizes of responses are those of the bytes read, those of revisits what the record states. Raises
    ValueError if the chain of a file does not end at the file's end, or a response's payload differs from its stated digest.
    """
    # Header fields, lengths and digests only; payloads stay in the files.
    found = written(_parsed(_segments(spark, path)).drop("value"), "warc-segments")
    ends = found.groupBy("file").agg((F.sum("size") - len(MAGIC)).alias("end"))
    located = _located(found)
    successor = F.col("offset") + len(MAGIC) + F.col("head_bytes") + F.col("length") + len(RECORD_END)
    located = written(located.withColumn("successor", successor), "warc-candidates")
    candidates = located.filter("successor is not null").select("file", "block", "offset", "successor")
    chain = written(_reachable(candidates), "warc-records")
    last = chain.groupBy("file").agg(F.max("successor").alias("reached"))
    broken = ends.join(last, "file", "left").filter("end > 0 and not (end <=> reached)").limit(1).collect()
    if broken:
        raise ValueError(f"broken archive: {broken[0]}")
    records = located.join(chain.select("file", "offset"), ["file", "offset"])
    torn = records.filter("block_digest is null").select("file", F.col("offset").alias("start"), "successor", "head_bytes", "length")
    torn = written(torn, "warc-torn")
    if not torn.isEmpty():
        records = records.join(_mended(spark, path, torn), ["file", "offset"], "left")
        records = records.withColumn("block_digest", F.coalesce("block_digest", "mended"))
    response = F.col("kind") == "response"
    digest = F.when(response, F.col("block_digest")).otherwise(F.col("stated_digest"))
    checked = F.when(~response | (digest == F.col("stated_digest")), digest).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest in "), F.col("file")))
    )
    number = lambda name: F.nullif(F.col(name), F.lit("")).cast("long")
    return records.select(
        "file",
        "offset",
        number("page").alias("page_id"),
        F.col("kind").alias("record_type"),
        number("refers").alias("refers_to"),
        F.when(response, F.col("length") - len(HTTP_HEAD)).otherwise(number("stated_bytes")).alias("payload_bytes"),
        checked.alias("payload_digest"),
    )


def _mended(spark: SparkSession, path: str, torn: DataFrame) -> DataFrame:
    """Payload digests of records whose payload holds the magic: their segments, joined again in order."""
    parts = _segments(spark, path).join(torn.select("file").distinct(), "file", "left_semi")
    parts = _located(parts).select("file", "offset", "value")
    within = [F.col("p.file") == F.col("t.file"), F.col("offset") >= F.col("start"), F.col("offset") < F.col("successor")]
    owned = parts.alias("p").join(torn.alias("t"), within).select("t.*", "offset", "value")
    whole = owned.groupBy("file", "start", "head_bytes", "length").agg(
        F.array_sort(F.collect_list(F.struct("offset", "value"))).alias("parts")
    )
    value = F.array_join(F.col("parts.value"), MAGIC)
    mended = _payload_digest(value, F.col("head_bytes"), F.col("length"))
    return whole.select("file", F.col("start").alias("offset"), mended.alias("mended"))
