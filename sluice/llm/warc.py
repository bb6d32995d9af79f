"""WARC archives as a chunked record table.

A record's payload is rows of (record_id, chunk_no): ``chunked`` cuts it in pieces of at most ``CHUNK`` bytes at whole
characters, and each row carries the SHA-256 of the payload up to its own end. Nothing downstream holds a payload
whole. A row is written as one segment of the record, as WARC 1.1 has it: the first as ``response`` or ``revisit``,
the others as ``continuation`` with the origin's id and their number. Spark's text writer writes the archives, with
the blank line after a record as line end, so they are committed like any table and lie on any file system.

Reading splits archives where a record ends and the next begins; no segment's block can hold that, since payloads are
also cut inside each occurrence of the version line. Each row is a whole segment with its own header, whatever part of
an archive a task reads. ``records`` streams the chunks of a record in order through one running digest.

Of records with equal payloads of at least ``LEAST`` bytes, the one with the smallest id is the response, the others
refer to it and hold no payload.

Cases: a null payload is empty, a null url too; a null id is never the smallest, and its record a response; repeated
rows are records of their own, and those of the smallest id all responses; an empty table gives an empty one, with no
archive; line breaks in a url are percent-coded; other columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.operators.stage import Stage

LEAST = 100
CHUNK = 1 << 16
DATE = "2024-01-01T00:00:00Z"
ARCHIVE_ROWS = 20_000

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
BETWEEN = f"{END}{VERSION}\r\n"
REVISIT_PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def typed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST) -> DataFrame:
    """(record_id, id, url, payload, payload_bytes, payload_digest, record_type, refers_to): a row for each record."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)}
    )
    own = F.md5(F.concat_ws("|", F.col("id").cast("string"), "payload_digest", F.monotonically_increasing_id().cast("string")))
    rows = rows.withColumn("record_id", F.regexp_replace(own, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))
    # Counted before they meet: of payloads that occur once nothing is joined.
    shared = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    shared = shared.where("n > 1").drop("n")
    revisit = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return rows.join(shared, "payload_digest", "left").select(
        "record_id", "id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def cuts(payload: bytes | memoryview, chunk: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ends of the chunks: whole characters, and no version line within one."""
    size, start, version = len(payload), 0, VERSION.encode()
    while True:
        end = min(size, start + chunk)
        while start < end < size and payload[end] & 0xC0 == 0x80:
            end -= 1
        if end == start:  # a chunk smaller than a character
            end = min(size, start + 4)
            while end < size and payload[end] & 0xC0 == 0x80:
                end += 1
        if (at := bytes(payload[start:end]).find(version)) >= 0:
            end = start + at + 2
        yield start, end
        start = end
        if start >= size:
            return


def _chunks(chunk: int):
    names = ["record_id", "chunk_no", "last", "chunk", "running_digest"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out, size = [], [], 0
            for row in range(batch.num_rows):
                payload = memoryview(batch.column("payload")[row].as_buffer())
                if batch.column("record_type")[row].as_py() == "revisit":
                    payload = payload[:0]
                digest = hashlib.sha256()
                for number, (a, b) in enumerate(cuts(payload, chunk)):
                    digest.update(payload[a:b])
                    rows.append(row)
                    out.append((number, b == len(payload), bytes(payload[a:b]).decode(), digest.hexdigest()))
                    size += b - a
                    if size > 1 << 23:
                        yield made(batch, rows, out)
                        rows, out, size = [], [], 0
            if out:
                yield made(batch, rows, out)

    def made(batch, rows, out):
        take = pa.array(rows)
        kept = ["record_id", "id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        columns = [batch.column(c).take(take) for c in kept]
        columns += [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.bool_(), pa.string(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, names=[*kept, "chunk_no", "last", "chunk", "running_digest"])

    return work


def chunked(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(record_id, id, url, payload_bytes, payload_digest, record_type, refers_to, chunk_no, last, chunk,
    running_digest): a row for each chunk; an empty payload and a revisit have one, which is empty."""
    kind = records.schema["id"].dataType.simpleString()
    head = f"record_id string, id {kind}, url string, payload_bytes long, payload_digest string, record_type string, refers_to {kind}"
    return records.mapInArrow(_chunks(chunk), f"{head}, chunk_no long, last boolean, chunk string, running_digest string")


# Archives


def segment(date: str = DATE) -> Column:
    """A chunk row as the text of a WARC segment, without the blank line that ends it."""
    first, many = F.col("chunk_no") == 0, ~F.col("last")
    urn = lambda c: F.concat(F.lit("<urn:uuid:"), c, F.lit(">"))
    field = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value.cast("string"))
    only = lambda condition, text: F.when(condition, text).otherwise(F.lit(""))
    optional = lambda name, value: F.coalesce(field(name, value), F.lit(""))
    block = F.concat(F.when(first, F.lit(HTTP)).otherwise(F.lit("")), F.col("chunk"))
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    part = F.concat(F.lit("-"), F.col("chunk_no").cast("string"))
    return F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "),
        F.when(first, F.col("record_type")).otherwise(F.lit("continuation")),
        F.lit("\r\nWARC-Record-ID: "),
        urn(F.concat(F.col("record_id"), only(~first, part))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", url),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        only(first & (F.col("record_type") == "revisit"), field("WARC-Profile", F.lit(REVISIT_PROFILE))),
        optional("WARC-Refers-To-Page", F.col("refers_to")),
        optional("WARC-Page", F.col("id")),
        field("WARC-Payload-Length", F.col("payload_bytes")),
        field("WARC-Running-Digest", F.concat(F.lit("sha256:"), "running_digest")),
        only(~first | many, field("WARC-Segment-Number", F.col("chunk_no") + 1)),
        only(~first, field("WARC-Segment-Origin-ID", urn(F.col("record_id")))),
        only(~first & F.col("last"), field("WARC-Segment-Total-Length", F.col("payload_bytes") + len(HTTP))),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block)),
        F.lit(END),
        block,
    )


def write_archives(chunks: DataFrame, path: str, archive_rows: int = ARCHIVE_ROWS) -> None:
    rows = chunks.select(segment().alias("value"))
    rows.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", archive_rows).mode("overwrite").text(path)


def read_chunks(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """The chunk rows of the archives in a folder; a segment of the wrong length is an error."""
    rows = spark.read.option("lineSep", BETWEEN).text(path)
    cut = F.instr("value", END)
    rows = rows.select(F.substring("value", F.lit(1), cut + 1).alias("head"), F.substring("value", cut + len(END), F.length("value")).alias("block"))
    field = lambda name: F.nullif(F.regexp_extract("head", f"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))
    # The first segment of an archive has its version line, the others lost it to the split.
    rows = rows.withColumn("head", F.concat(F.lit("\r\n"), F.regexp_replace("head", f"^{VERSION}\r\n", "")))
    rows = rows.withColumns({"_size": field("Content-Length").cast("long"), "_type": field("WARC-Type")})
    # The last one of an archive still has the blank line that ends it.
    rows = rows.withColumn("block", F.when(F.octet_length("block") == F.col("_size") + len(END), F.expr(f"substring(block, 1, length(block) - {len(END)})")).otherwise(F.col("block")))
    whole = F.when(F.octet_length("block") == F.col("_size"), F.col("block")).otherwise(F.raise_error(F.concat(F.lit("broken segment: "), "head")))
    rows = rows.withColumn("block", whole)
    first = F.col("_type") != "continuation"
    number = F.coalesce(field("WARC-Segment-Number").cast("long") - 1, F.lit(0).cast("long"))
    uuid = lambda name: F.regexp_extract("head", f"\r\n{name}: <urn:uuid:([0-9a-f-]{{36}})", 1)
    bare = lambda name: F.regexp_extract("head", f"\r\n{name}: sha256:([0-9a-f]*)", 1)
    return rows.select(
        uuid("WARC-Record-ID").alias("record_id"),
        field("WARC-Page").cast(id_type).alias("id"),
        field("WARC-Target-URI").alias("url"),
        field("WARC-Payload-Length").cast("long").alias("payload_bytes"),
        bare("WARC-Payload-Digest").alias("payload_digest"),
        F.when(first, F.col("_type")).alias("record_type"),
        field("WARC-Refers-To-Page").cast(id_type).alias("refers_to"),
        number.alias("chunk_no"),
        (field("WARC-Segment-Number").isNull() | field("WARC-Segment-Total-Length").isNotNull()).alias("last"),
        F.when(first, F.expr(f"substring(block, {len(HTTP) + 1}, length(block))")).otherwise(F.col("block")).alias("chunk"),
        bare("WARC-Running-Digest").alias("running_digest"),
    )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of (record_id, chunk_no); what is kept of a record is a running digest and a length."""
    record, digest, size, number = None, None, 0, 0
    for batch in batches:
        out = []
        columns = [batch.column(c) for c in ("record_id", "chunk_no", "last", "chunk", "running_digest")]
        for row in range(batch.num_rows):
            own, place, last = (c[row].as_py() for c in columns[:3])
            if own != record:
                record, digest, size, number = own, hashlib.sha256(), 0, 0
            chunk = columns[3][row].as_buffer()
            digest.update(chunk)
            size += chunk.size
            if place != number or digest.hexdigest() != columns[4][row].as_py():
                raise ValueError(f"record {own}: segment {number + 1} is missing or damaged")
            number += 1
            if last:
                out.append((own, size, digest.hexdigest()))
        if out:
            kinds = (pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["r", "read_bytes", "read_digest"])


def records(chunks: DataFrame) -> DataFrame:
    """(id, url, payload_bytes, payload_digest, record_type, refers_to) of every record, measured on its chunks.

    A record of one chunk is measured in place. The chunks of longer ones meet by record and stream through. Figures
    that differ from the header's are an error. A revisit has those of the payload that it refers to.
    """
    single = (F.col("chunk_no") == 0) & F.col("last")
    head = ["record_id", "id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    empty = F.col("record_type") == "revisit"
    one = chunks.where(single).select(
        *head,
        F.when(empty, F.col("payload_bytes")).otherwise(F.octet_length("chunk").cast("long")).alias("read_bytes"),
        F.when(empty, F.col("payload_digest")).otherwise(F.sha2("chunk", 256)).alias("read_digest"),
    )
    many = chunks.where(~single)
    narrow = many.select("record_id", "chunk_no", "last", "chunk", "running_digest")
    in_order = narrow.repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    streamed = in_order.mapInArrow(_streamed, "r string, read_bytes long, read_digest string")
    long_ones = many.where("chunk_no = 0").select(*head).join(streamed, F.col("record_id") == F.col("r")).drop("r")
    rows = one.unionByName(long_ones)
    same = (F.col("read_bytes") == F.col("payload_bytes")) & (F.col("read_digest") == F.col("payload_digest"))
    checked = F.when(same, F.col("read_digest")).otherwise(F.raise_error(F.concat(F.lit("damaged record "), "record_id")))
    return rows.select("id", "url", F.col("read_bytes").alias("payload_bytes"), checked.alias("payload_digest"), "record_type", "refers_to")


def round_trip(pages: DataFrame, stage: Stage, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", chunk: int = CHUNK, archive_rows: int = ARCHIVE_ROWS) -> DataFrame:
    """Write archives into the stage folder and read them back: (id, payload_bytes, payload_digest, record_type,
    refers_to)."""
    kind, path = pages.schema[id_col].dataType.simpleString(), f"{stage.path}/archives"
    write_archives(chunked(typed(pages, id_col, url_col, payload_col), chunk), path, archive_rows)
    out = records(read_chunks(pages.sparkSession, path, kind)).drop("url")
    return out.withColumnRenamed("id", id_col)
