"""WARC archives: written as text, read back by verified chains of record boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.sources.writers import scratch_path, stage

# Version line, line end and record end of the format.
MAGIC = "WARC/1.0\r\n"
LINE = "\r\n"
RECORD_END = "\r\n\r\n"

#: Payloads below this many bytes are never revisits.
MIN_REVISIT_BYTES = 100
RECORDS_PER_FILE = 1024


def _record(fields: dict[str, Column], block: Column) -> Column:
    """Header and block; the writer's line separator ends the record."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v.cast("string"), F.lit(LINE))).otherwise("") for k, v in fields.items()]
    return F.concat(F.lit(MAGIC), *lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(RECORD_END), block)


def write_warc(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write one WARC record per row of page_id, html; other columns are ignored.

    Of the rows whose payloads are equal and at least 100 bytes, that with the
    smallest page_id holds the payload (``response``); the others are ``revisit``
    records without one, which name it. A null html is an empty payload. Rows with
    a null page_id are responses of their own, and so is every repetition of the
    row that the others refer to.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", html.alias("html"))
    digests = rows.where((F.octet_length("html") >= MIN_REVISIT_BYTES) & F.col("page_id").isNotNull()).select(
        "page_id", F.sha2(F.col("html").cast("binary"), 256).alias("digest")
    )
    shared = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Slim rows; most pages have no copy. Stored, so that Spark knows the size before it chooses the join below.
    revisits = stage(shared.select("digest", "first"), "warc-shared")
    numbered = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).join(revisits, "digest", "left")
    again = F.col("first").isNotNull() & F.col("page_id").isNotNull() & (F.col("page_id") != F.col("first"))
    block = F.when(again, F.lit("")).otherwise(F.col("html"))
    record = _record(
        {
            "WARC-Type": F.when(again, F.lit("revisit")).otherwise("response"),
            "WARC-Date": F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "WARC-Record-ID": F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
            "WARC-Payload-Digest": F.concat(F.lit("sha256:"), F.col("digest")),
            "WARC-Payload-Length": F.octet_length("html"),
            "WARC-Refers-To": F.when(again, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))),
            "Content-Type": F.lit("text/html"),
        },
        block,
    )
    numbered.select(record.alias("value")).write.option("lineSep", RECORD_END).option("maxRecordsPerFile", records_per_file).text(path)


def _candidates(spark: SparkSession, path: str) -> DataFrame:
    """What follows each magic, wherever it stands: split by split, in order of the file.

    A split is read by one task; a candidate belongs to the split in which the magic
    before it ends. ``at`` numbers the rows of a task.
    """
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("at"),
            F.col("value").cast("binary").alias("bytes"),
        )
    )


def _header(name: str) -> Column:
    found = F.regexp_extract("head", rf"(?:^|\r\n){name}: *([^\r\n]*)", 1)
    return F.when(found != "", found)


def _parsed(candidates: DataFrame) -> DataFrame:
    """Slim rows: header fields, and the digest of the payload if the row holds all of it."""
    end = F.instr(F.col("bytes").cast("string"), RECORD_END)
    text = F.col("bytes").cast("string")
    head = F.when(end > 0, F.substring_index(text, RECORD_END, 1)).otherwise("")
    skip = F.octet_length("head") + len(RECORD_END)
    return (
        candidates.withColumn("head", head)
        .select(
            "file",
            "split",
            "at",
            F.octet_length("bytes").cast("long").alias("n_bytes"),
            skip.cast("long").alias("skip"),
            F.expr("try_cast(regexp_extract(head, '(?:^|\\r\\n)Content-Length: *([0-9]+)', 1) as bigint)").alias("length"),
            _header("WARC-Type").alias("record_type"),
            _header("WARC-Record-ID").alias("record"),
            _header("WARC-Payload-Digest").alias("stated_digest"),
            F.expr("try_cast(regexp_extract(head, '(?:^|\\r\\n)WARC-Payload-Length: *([0-9]+)', 1) as bigint)").alias("stated_bytes"),
            _header("WARC-Refers-To").alias("refers"),
            "bytes",
        )
        .withColumn("whole", F.col("skip") + F.col("length") + len(RECORD_END) == F.col("n_bytes"))
        .withColumn(
            "payload_digest",
            F.when(F.col("whole"), F.sha2(F.substring("bytes", F.col("skip").cast("int") + 1, F.col("length").cast("int")), 256)),
        )
        .drop("bytes")
    )


def _placed(rows: DataFrame) -> DataFrame:
    """Offset in the file of every candidate's magic, from the sizes of what one read gave.

    The first row of a file precedes its first magic and is no candidate.
    """
    size = F.col("n_bytes") + len(MAGIC)
    in_split = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        rows.groupBy("file", "split")
        .agg(F.sum(size).alias("bytes"))
        .select("file", "split", F.coalesce(F.sum("bytes").over(in_file), F.lit(0)).alias("split_start"))
    )
    return (
        rows.withColumn("local", F.coalesce(F.sum(size).over(in_split), F.lit(0)))
        .join(splits, ["file", "split"])
        .withColumn("offset", F.col("split_start") + F.col("local") - len(MAGIC))
        .where("offset >= 0")
    )


def _with_offsets(parsed: DataFrame) -> DataFrame:
    """Offsets of every candidate's magic and of the record after it; only those with a length have one."""
    return _placed(parsed).withColumn(
        "next", F.col("offset") + len(MAGIC) + F.col("skip") + F.col("length") + len(RECORD_END)
    )


def _runs(links: DataFrame) -> DataFrame:
    """Number the runs of each file: maximal stretches of candidates of which each is
    the successor of the one before, and into whose middle no other candidate leads."""
    by_file = Window.partitionBy("file").orderBy("offset")
    linked = links.withColumn("adjacent", F.coalesce(F.col("next") == F.lead("offset").over(by_file), F.lit(False)))
    targets = linked.where("NOT adjacent AND next IS NOT NULL").select("file", F.col("next").alias("offset"), F.lit(True).alias("target")).distinct()
    begins = F.col("target").isNotNull() | ~F.coalesce(F.lag("adjacent").over(by_file), F.lit(False))
    return (
        linked.join(targets, ["file", "offset"], "left")
        .withColumn("begins", begins.cast("long"))
        .withColumn("run", F.sum("begins").over(by_file.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("adjacent", "target", "begins")
    )


def _reached_heads(jumps: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Offsets that the jumps (file, offset, next) reach from offset 0, by pointer jumping.

    Each round adds where the known offsets jump to and doubles every jump, so the
    rounds grow with the logarithm of the longest chain of runs.
    """
    known = jumps.where("offset = 0").select("file", "offset")
    for _ in range(max_rounds):
        onward = known.join(jumps, ["file", "offset"]).where("next IS NOT NULL").select("file", F.col("next").alias("offset"))
        known = stage(known.unionByName(onward).distinct(), "warc-known")
        far = jumps.select("file", F.col("offset").alias("next"), F.col("next").alias("far"))
        jumps = stage(jumps.join(far, ["file", "next"]).where("far IS NOT NULL").select("file", "offset", F.col("far").alias("next")), "warc-jumps")
        if jumps.isEmpty():
            return known
    raise ValueError(f"a chain is longer than 2^{max_rounds} runs")


def reachable(links: DataFrame) -> DataFrame:
    """The rows of ``links`` (file, offset, next, ...) that the chain of successors
    from offset 0 of their file reaches. ``next`` is null for rows without one."""
    runs = stage(_runs(links), "warc-runs")
    jumps = stage(
        runs.groupBy("file", "run").agg(F.min("offset").alias("offset"), F.max_by("next", "offset").alias("next")).drop("run"),
        "warc-jumps",
    )
    heads = _reached_heads(jumps).join(runs.select("file", "offset", "run"), ["file", "offset"]).select("file", "run")
    return runs.join(heads, ["file", "run"], "left_semi").drop("run")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives in ``path``, told from look-alikes inside payloads.

    Tasks emit every place where the magic stands as a candidate, with the offset
    of its successor by its stated length. Only candidates on the chain from the
    start of their file are records. A payload that holds the magic is joined
    again from its pieces. A last record that the file cuts short is left out.

    Returns record, record_type, refers, payload_bytes, payload_digest (of the
    payload read back; of revisits, as stated in the record), intact.
    """
    rows = stage(_with_offsets(stage(_parsed(_candidates(spark, path)), "warc-candidates")), "warc-offsets")
    links = rows.select("file", "offset", F.when(F.col("record_type").isNotNull(), F.col("next")).alias("next"))
    fits = rows.groupBy("file").agg(F.max(F.col("offset") + len(MAGIC) + F.col("n_bytes")).alias("file_end"))
    records = stage(
        rows.join(reachable(links).select("file", "offset"), ["file", "offset"], "left_semi")
        .join(fits, "file")
        .where("record_type IS NOT NULL AND next <= file_end"),
        "warc-records",
    )
    plain = lambda df: df.select(
        "record",
        "record_type",
        "refers",
        F.coalesce(F.when(F.col("record_type") == "revisit", F.col("stated_bytes")), F.col("length")).alias("payload_bytes"),
        F.when(F.col("record_type") == "revisit", F.substring_index("stated_digest", ":", -1)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        ((F.col("record_type") == "revisit") | F.coalesce(F.col("stated_digest") == F.concat(F.lit("sha256:"), "payload_digest"), F.lit(False))).alias("intact"),
    )
    broken = records.where("NOT whole")
    if broken.isEmpty():
        return plain(records)
    return plain(records.where("whole").unionByName(_rejoined(spark, path, rows, broken)))


def _rejoined(spark: SparkSession, path: str, rows: DataFrame, broken: DataFrame) -> DataFrame:
    """``broken`` records with the digest of their payload, joined from all candidates
    between the record and its successor.

    A second read takes the files of such records alone and stores their candidates with
    their bytes. Splits may differ from those of the first read; offsets in the file do not.
    """
    spans = broken.select("file", "offset", F.struct("offset", "next", "skip", "length").alias("span"))
    files = stage(broken.select("file").distinct(), "warc-broken")
    so_far = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    parts = stage(
        rows.join(files, "file", "left_semi")
        .select("file", "offset")
        .join(spans, ["file", "offset"], "left")
        .withColumn("span", F.last("span", ignorenulls=True).over(so_far))
        .where(F.col("offset") < F.col("span.next"))
        .select("file", "offset", F.col("span.offset").alias("start"), F.col("span.skip").alias("from"), F.col("span.length").alias("size")),
        "warc-parts",
    )
    again = stage(
        _candidates(spark, path).join(files, "file", "left_semi").withColumn("n_bytes", F.octet_length("bytes").cast("long")),
        "warc-again",
    )
    slim = _placed(again.drop("bytes")).select("file", "split", "at", "offset")
    payload = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("offset", F.col("bytes").cast("string").alias("bytes")))), lambda p: p["bytes"]),
        MAGIC,
    ).cast("binary")
    digests = (
        again.select("file", "split", "at", "bytes")
        .join(slim.join(parts, ["file", "offset"]), ["file", "split", "at"])
        .groupBy("file", "start", "from", "size")
        .agg(payload.alias("payload"))
        .select(
            "file",
            F.col("start").alias("offset"),
            F.sha2(F.substring("payload", F.col("from").cast("int") + 1, F.col("size").cast("int")), 256).alias("payload_digest"),
        )
    )
    return broken.drop("payload_digest").join(digests, ["file", "offset"])


def archive_roundtrip(pages: DataFrame) -> DataFrame:
    """Write pages (page_id, html) to a new shared folder and read the records back.

    Pages of any length are one record. Empty tables give no rows. Returns page_id, payload_bytes, payload_digest,
    record_type, refers_to, intact.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path)
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(-?[0-9]+)>', 1) as bigint)")
    return read_warc(spark, path).select(
        number("record").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers").alias("refers_to"),
        "intact",
    )
