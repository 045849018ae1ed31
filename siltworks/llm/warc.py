"""WARC archives as chunked record tables.

A payload is a run of rows (record id, chunk number, bytes) of at most
``CHUNK`` bytes, so past the writer's input no task holds a large record as a
whole.  Each row is one WARC/1.1 record on disk: a payload of one chunk is an
ordinary record, a longer one is a segmented record, whose first segment names
the kind and whose others are ``continuation`` records.  Spark's text writer
lays the records down and its reader finds them again by the bytes between two
records, so archives live in whatever store Spark reads; without compression a
file splits over tasks.  Chunks are cut so that no payload holds those bytes.
Archives of others, WARC/1.0 and WARC/1.1, are read by the same bytes; a record
whose block holds them raises an error, since it is shorter than its length.

Digests are incremental: a reader hashes each chunk as it comes, and only
records of several segments are brought together, ordered by segment.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import Workspace, ship

CHUNK = 64 * 1024
#: Equal payloads of so many bytes are written once and revisited.
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
VERSION = "WARC/1.1\r\n"
#: Between two records, whatever the minor version; a reader cuts here and no chunk contains it.
BETWEEN = "\r\n\r\nWARC/1."
_HOLD = len(BETWEEN) - 1
_LINE = re.compile(rb"(?:WARC/1\.)?[0-9]\r\n")
#: Copies of one digest are dealt to so many keys of the join.
SALT = 32


def payload_table(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """(record_id, url, payload binary): null payloads are empty, null URLs too, line ends in a URL are escaped.

    Only these three columns are read, whatever the names of the others; rows
    without a key or with a repeated one stay as they are.
    """
    clean = F.regexp_replace(F.coalesce(F.col(url), F.lit("")), "[\\x00-\\x20\\x7f]", "%20")
    return pages.select(F.col(key).cast("bigint").alias("record_id"), clean.alias("url"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))


def revisits(records: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """records with refers_to: the largest id that has an equal payload, where the record's own is smaller, else null.

    Equal means equal SHA-1, length and 64-bit hash.  Groups are reduced to
    their largest id before the shuffle, and their rows are dealt to ``SALT``
    keys, so a payload that many records share is no hot key.  Short payloads
    and records without an id take no part.  Rows that repeat an id are told
    apart by their payload; all rows of the largest id are responses.
    """
    own = {"sha1": F.sha1("payload"), "n": F.length("payload"), "h": F.xxhash64("payload")}
    may = F.coalesce((F.length("payload") >= least) & F.col("record_id").isNotNull(), F.lit(False))
    top = records.where(may).select("record_id", *(c.alias(k) for k, c in own.items())).groupBy(*own).agg(F.max("record_id").alias("top"), F.count("*").alias("copies")).where("copies > 1")
    top = top.select(*(F.col(k).alias(f"of_{k}") for k in own), "top", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("of_salt"))
    long = records.where(may).withColumns(own).withColumn("salt", F.pmod(F.xxhash64("record_id", "url"), F.lit(SALT)).cast("int"))
    on = [F.col(k) == F.col(f"of_{k}") for k in (*own, "salt")]
    found = long.join(top, on, "left").withColumn("refers_to", F.when(F.col("record_id") < F.col("top"), F.col("top")))
    return found.select(*records.columns, "refers_to").unionByName(records.where(~may).withColumn("refers_to", F.lit(None).cast("bigint")))


def _crlf(*lines: Column) -> Column:
    return F.concat(*(x for line in lines for x in (line, F.lit("\r\n"))))


def _urn(x: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(x.cast("string"), F.lit("null")), F.lit(">"))


def _own(*more: Column) -> Column:
    """A record's own name: its id and the row it comes from, since ids may repeat."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col("record_id").cast("string"), F.lit("null")), F.lit("/"), F.col("row").cast("string"), *more, F.lit(">"))


def _id(urn: str) -> int | None:
    m = re.fullmatch(r"<?urn:page:(-?\d+)(?:/.*)?>?", urn)
    return int(m[1]) if m else None


def chunk_table(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(record_id, row, url, refers_to, total, digest, number, chunks, offset, data): the chunked record table.

    Chunks are cut every `chunk` bytes, and inside a chunk behind the first
    bytes of each separator the payload holds.
    """
    if chunk <= _HOLD:
        raise ValueError(f"a chunk must be longer than {_HOLD} bytes")
    size = F.length("payload")
    regular = F.when(size == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), size - 1, F.lit(chunk)))
    holds = F.contains(F.col("payload"), F.lit(BETWEEN.encode()))

    def inside(off: Column) -> Column:
        """Places behind the first byte of separators that begin in the chunk at off; one chunk in hexadecimal at a time."""
        digits = F.split(F.hex(F.substring(F.col("payload"), off + 1, F.lit(chunk + _HOLD))), F.hex(F.lit(BETWEEN)), -1)
        gaps = F.transform(F.slice(digits, 1, F.size(digits) - 1), lambda x: F.length(x).cast("int"))
        seen = F.struct(off.cast("int").alias("p"), F.array().cast("array<int>").alias("cuts"))
        return F.aggregate(gaps, seen, lambda a, n: F.struct((a.p + n / 2 + len(BETWEEN)).cast("int").alias("p"), F.concat(a.cuts, F.array((a.p + n / 2 + 1).cast("int"))).alias("cuts"))).cuts

    inner = F.flatten(F.transform(regular, inside))
    cuts = F.when(holds, F.array_sort(F.array_union(regular, inner))).otherwise(regular)
    r = records.withColumn("total", size).withColumn("digest", F.sha1("payload")).withColumn("cuts", cuts).withColumn("chunks", F.size("cuts"))
    r = r.select("*", F.posexplode("cuts").alias("number", "offset"))
    end = F.coalesce(F.try_element_at("cuts", F.col("number") + 2), F.col("total"))
    return r.select("record_id", "row", "url", "refers_to", "total", "digest", (F.col("number") + 1).alias("number"), "chunks", "offset", F.substring("payload", F.col("offset") + 1, end - F.col("offset")).alias("data"))


def record_lines(chunks: DataFrame) -> DataFrame:
    """(value): each chunk as a WARC record without its last line feed, which the text writer adds."""
    c = F.col
    first = c("number") == 1
    revisit = c("refers_to").isNotNull()
    kind = F.when(~first, "continuation").when(revisit, "revisit").otherwise("response")
    none = F.lit("")
    several = F.col("chunks") > 1
    head = F.concat(
        F.lit(VERSION),
        _crlf(F.concat(F.lit("WARC-Type: "), kind)),
        F.concat(F.lit("WARC-Record-ID: "), F.when(first, _own()).otherwise(_own(F.lit("/"), c("number").cast("string"))), F.lit("\r\n")),
        _crlf(F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Target-URI: "), c("url"))),
        F.when(first, _crlf(F.concat(F.lit("WARC-Payload-Digest: sha1:"), c("digest")), F.concat(F.lit("X-Payload-Length: "), c("total").cast("string")))).otherwise(none),
        _crlf(F.concat(F.lit("WARC-Block-Digest: sha1:"), F.sha1("data"))),
        F.when(revisit, _crlf(F.concat(F.lit("WARC-Refers-To: "), _urn(c("refers_to"))), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(none),
        F.when(several, _crlf(F.concat(F.lit("WARC-Segment-Number: "), c("number").cast("string")))).otherwise(none),
        F.when(several & ~first, _crlf(F.concat(F.lit("WARC-Segment-Origin-ID: "), _own()))).otherwise(none),
        F.when(several & (c("number") == c("chunks")), _crlf(F.concat(F.lit("WARC-Segment-Total-Length: "), c("total").cast("string")))).otherwise(none),
        _crlf(F.lit("Content-Type: text/html"), F.concat(F.lit("Content-Length: "), F.length("data").cast("string")), none),
    )
    return chunks.select(F.concat(head.cast("binary"), c("data"), F.lit(b"\r\n\r")).cast("string").alias("value"))


def write(records: DataFrame, path: str, chunk: int = CHUNK, least: int = REVISIT_BYTES, codec: str = "none") -> None:
    """Write (record_id, url, payload) as WARC files under path; repeated rows are written each."""
    marked = revisits(records.select("record_id", "url", "payload"), least).withColumn("row", F.monotonically_increasing_id())
    # a revisit keeps the digest and length of its payload and carries no bytes
    full = chunk_table(marked.where("refers_to IS NULL"), chunk)
    refs = marked.where("refers_to IS NOT NULL").select(
        "record_id", "row", "url", "refers_to", F.length("payload").alias("total"), F.sha1("payload").alias("digest"), F.lit(1).alias("number"), F.lit(1).alias("chunks"), F.lit(0).alias("offset"), F.lit(b"").alias("data")
    )
    record_lines(full.unionByName(refs)).write.mode("overwrite").option("lineSep", "\n").option("compression", codec).text(path)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record, with or without its version line."""
    if line := _LINE.match(raw):
        raw = raw[line.end() :]
    head, found, block = raw.partition(b"\r\n\r\n")
    if not found:
        raise ValueError(f"a WARC record without the end of its header: {raw[:80]!r}")
    headers = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    n = int(headers["content-length"])
    if len(block) < n or block[n:].strip(b"\r\n"):
        raise ValueError(f"{headers.get('warc-record-id')}: the block has {len(block)} bytes, not {n}")
    return headers, block[:n]


def digest_matches(label: str, data: bytes) -> bool:
    """Compare a labelled digest, hexadecimal or base 32, with the data's."""
    method, _, value = label.partition(":")
    d = hashlib.new(method.lower(), data).digest()
    return value.lower() == d.hex() or value.upper() == base64.b32encode(d).decode()


def _hex(label: str) -> str:
    """The value of a labelled SHA-1 in hexadecimal digits, which base 32 is turned into."""
    value = label.rpartition(":")[2]
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def read(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table of archives: own, record_id, type, url, refers_to, number, several, digest, total, data.

    Every block digest is checked; a damaged record raises an error.  record_id
    is the number in this package's own names, and null for other names, which
    `own` has in full; a record without a target has a null url.  Archives
    without a record give no row.
    """
    ship(spark)
    raw = spark.read.option("lineSep", BETWEEN).text(path).select(F.col("value").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                rows = []
                for x in b.column(0).slice(at, 64).to_pylist():
                    if not x.strip(b"\r\n"):
                        continue
                    h, block = parse(x)
                    if (d := h.get("warc-block-digest")) and not digest_matches(d, block):
                        raise ValueError(f"{h['warc-record-id']}: the block's digest differs")
                    number = int(h.get("warc-segment-number", 1))
                    own = h["warc-segment-origin-id"] if number > 1 else h["warc-record-id"]
                    ref = h.get("warc-refers-to")
                    rows.append((
                        own, _id(own), h["warc-type"], h.get("warc-target-uri"), _id(ref) if ref else None, number, "warc-segment-number" in h, _hex(h.get("warc-payload-digest", "")), int(h["x-payload-length"]) if "x-payload-length" in h else None, block,
                    ))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), _KINDS)], _READ)

    return raw.mapInArrow(run, "own string, record_id bigint, type string, url string, refers_to bigint, number int, several boolean, digest string, total bigint, data binary")


_READ = ["own", "record_id", "type", "url", "refers_to", "number", "several", "digest", "total", "data"]
_KINDS = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int64(), pa.string()
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], ["record_id", "payload_bytes", "payload_digest"])


def assemble(chunks: DataFrame) -> DataFrame:
    """(record_id, payload_bytes, payload_digest, record_type, refers_to), one row a record.

    A revisit has the digest and length of the payload it refers to, whatever
    the size; records with one id are told apart by `own`, and an empty table
    gives none.  Records of one chunk are done where they lie.  Segments are sorted by
    record and number, and hashed one after another as they stream by.
    """
    single = chunks.where("NOT several").select(
        "record_id", F.when(F.col("type") == "revisit", F.col("total")).otherwise(F.length("data")).cast("bigint").alias("payload_bytes"),
        F.when(F.col("type") == "revisit", F.col("digest")).otherwise(F.sha1("data")).alias("payload_digest"), F.col("type").alias("record_type"), "refers_to",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rid, number, size, sha, label = None, None, 0, 0, hashlib.sha1(), ""

        def close() -> tuple:
            if label and sha.hexdigest() != label:
                raise ValueError(f"record {own}: its segments differ from the payload digest")
            return rid, size, sha.hexdigest()

        for b in batches:
            done = []
            cols = [b.column(k) for k in range(b.num_columns)]
            for k in range(b.num_rows):
                o, r, n, d, block = (c[k].as_py() for c in cols)
                if o != own:
                    if own is not None:
                        done.append(close())
                    own, rid, number, size, sha, label = o, r, 0, 0, hashlib.sha1(), d
                if n != number + 1:
                    raise ValueError(f"record {own}: segment {n} follows segment {number}")
                number = n
                size += len(block)
                sha.update(block)
            if done:
                yield _batch(done)
        if own is not None:
            yield _batch([close()])

    parts = chunks.where("several").select("own", "record_id", "number", "digest", "data")
    parts = parts.repartition(F.col("own")).sortWithinPartitions("own", "number")
    joined = parts.mapInArrow(run, "record_id bigint, payload_bytes bigint, payload_digest string")
    return single.unionByName(joined.select("*", F.lit("response").alias("record_type"), F.lit(None).cast("bigint").alias("refers_to")))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "warc")
    # gzip is the usual form of archives; each file is what one task wrote
    write(payload_table(spark.read.parquet(f"{sf_dir}/pages.parquet")), ws.path("archives"), codec="gzip")
    return assemble(read(spark, ws.path("archives"))).withColumnRenamed("record_id", "page_id")


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to FROM m
"""

QUERIES = {"op4_warc_chunks": op4_warc}
ORACLES = {"op4_warc_chunks": SQL}
