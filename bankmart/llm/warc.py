"""WARC archives: writing, and reading by boundary-chain verification.

``write_warc`` writes one record per page with Spark's text writer, whose
line separator is the two line breaks that end a record, so the commit
protocol and any Hadoop file system work.  Of equal payloads of at least
``MIN_REVISIT`` bytes the one with the largest page id is a response and the
others are revisits of it.  Only digests are grouped; a Bloom filter of the
repeated ones (``FILTER_BLOCKS`` blocks of 4 KB at most, whatever the table)
lets all other pages pass by the join with their payloads.

``read_warc`` gives each archive file to a task, which emits for every place
that looks like the start of a record the place where its header says that
the next one starts, and the file's end.  Pointer jumping (doubling the length
of all jumps each round) then marks the places that the chain from the file's
start reaches; anything else that looks like a record lies inside a payload
and goes.  A chain that does not reach its file's end fails the read.

Files hold at most ``RECORDS_PER_FILE`` records and about ``FILE_BYTES``, which
bounds a task.  Spark fails on files over ``spark.sql.sources.binaryFile.maxLength``
rather than skip them.

Defined results: null html is an empty payload; a null url leaves out the
target header; a null page id is written without a number and read back as
null, counts as smaller than any other, and is no target of a revisit unless
no copy has an id.  Repeated rows with the largest id of their payload are
all responses; pages that share an id are told apart by their digests.  A very
long payload has a file of its own.  An empty table gives an archive without
records.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.functions import bloom
from bankmart.llm.common import shared_path, ship, written

MIN_REVISIT = 1000
RECORDS_PER_FILE = 1000
FILE_BYTES = 1 << 29
FILTER_BLOCKS = 1024
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The tables have no capture times.
DATE = "1970-01-01T00:00:00Z"


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    page = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"))
    page = page.withColumns({"bytes": F.octet_length("payload"), "digest": F.sha1(F.col("payload").cast("binary"))})
    repeated = (page.where(F.col("bytes") >= MIN_REVISIT).select("digest", "page_id")
                .groupBy("digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
                .where((F.col("n") > 1) & F.col("kept").isNotNull()).select("digest", "kept"))
    repeated = written(repeated, "warc-repeated")
    filters = written(bloom.build(repeated, F.col("digest"), FILTER_BLOCKS), "warc-filter")
    page = page.withColumn("block", bloom.block_of(F.col("digest"), FILTER_BLOCKS)).join(F.broadcast(filters), "block", "left")
    maybe = bloom.may_hold(F.col("bits"), F.col("digest"))
    narrow = ["page_id", "url", "payload", "bytes", "digest"]
    single = page.where(~maybe).select(*narrow, F.lit(None).cast("long").alias("kept"))
    page = page.where(maybe).select(*narrow).join(repeated, "digest", "left").select(*narrow, "kept").unionByName(single)
    largest = pages.agg(F.max(F.octet_length(F.col(html_col).cast("string")))).first()[0] or 0
    per_file = max(1, min(RECORDS_PER_FILE, FILE_BYTES // (largest + 1000)))
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))

    def urn(c: str) -> F.Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))

    def line(name: str, value: F.Column) -> F.Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    one_line_url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", F.lit(DATE)),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", one_line_url)).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn("kept")), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
        F.lit("\r\n"), F.when(revisit, "").otherwise(F.col("payload")))
    page.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


END_OF_FILE = "end of file"
_START = re.compile(rb"WARC/1\.[01]\r\n")
_ID = re.compile(rb"<urn:page:(-?\d*)>")
CANDIDATES = "file string, at long, next long, page_id long, type string, url string, refers_to long, bytes long, digest string"
_SCHEMA = pa.schema([("file", pa.string()), ("at", pa.int64()), ("next", pa.int64()), ("page_id", pa.int64()), ("type", pa.string()),
                     ("url", pa.string()), ("refers_to", pa.int64()), ("bytes", pa.int64()), ("digest", pa.string())])


def _number(urn: bytes | None) -> int | None:
    m = _ID.fullmatch(urn or b"")
    return int(m[1]) if m and m[1] else None


def candidates_of(file: str, raw: bytes) -> Iterator[tuple]:
    """Every place of ``raw`` with a whole record, as its header tells, and its end."""
    for m in _START.finditer(raw):
        head_end = raw.find(b"\r\n\r\n", m.end() - 2)
        if head_end < 0:
            continue
        fields = {}
        for line in raw[m.end():head_end].split(b"\r\n"):
            name, colon, value = line.partition(b":")
            if colon:
                fields[name.strip().lower()] = value.strip()
        length = fields.get(b"content-length", b"")
        body, size = head_end + 4, int(length) if length.isdigit() and len(length) < 19 else -1
        if size < 0 or raw[body + size:body + size + 4] != b"\r\n\r\n":
            continue
        url, kind = fields.get(b"warc-target-uri"), fields.get(b"warc-type", b"").decode("utf-8", "replace")
        digest = hashlib.sha1(memoryview(raw)[body:body + size]).hexdigest()
        if kind == "revisit":  # of the payload that it stands for
            digest = fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha1:")
        yield (file, m.start(), body + size + 4, _number(fields.get(b"warc-record-id")),
               kind, None if url is None else url.decode("utf-8", "replace"), _number(fields.get(b"warc-refers-to")), size, digest)
    yield (file, len(raw), len(raw), None, END_OF_FILE, None, None, 0, "")


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for got in batches:
        for file, raw in zip(got.column(0), got.column(1), strict=True):
            rows = list(candidates_of(file.as_py(), raw.as_py()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives at ``path``: file, at, page_id, type, url, refers_to,
    bytes, and the SHA-1 digest of what the record holds (of revisits: stands for)."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    found = written(files.mapInArrow(_emit, CANDIDATES), "warc-candidates")
    # ``jump`` leads 2^round records on; ``reached`` holds for the records of
    # the chain's first 2^round steps
    chain = found.select(F.xxhash64("file").alias("f"), "at", F.col("next").alias("jump"), (F.col("at") == 0).alias("reached"))
    marked = -1
    while True:
        chain = written(chain, "warc-chain")
        now = chain.where("reached").count()
        if now == marked:
            break
        marked = now
        hit = chain.where("reached").select("f", F.col("jump").alias("at")).distinct().withColumn("hit", F.lit(True))
        onward = chain.select("f", F.col("at").alias("jump"), F.col("jump").alias("far"))
        chain = (chain.join(hit, ["f", "at"], "left").join(onward, ["f", "jump"], "left")
                 .select("f", "at", F.coalesce("far", "jump").alias("jump"),
                         (F.col("reached") | F.coalesce("hit", F.lit(False))).alias("reached")))
    known = found.withColumn("f", F.xxhash64("file"))
    reached = chain.where("reached").select("f", "at")
    broken = known.where(F.col("type") == END_OF_FILE).join(reached, ["f", "at"], "left_anti").select("file").limit(5).collect()
    if broken:
        raise ValueError(f"the records do not lead to the end of {', '.join(r.file for r in broken)}")
    return known.where(F.col("type") != END_OF_FILE).join(reached, ["f", "at"], "left_semi").drop("f")


def resolved(records: DataFrame) -> DataFrame:
    """Records with the size and digest of the payload that they stand for: a revisit's is
    that of the response with the id and the digest that it names."""
    whole = (records.where("type = 'response' and page_id is not null")
             .groupBy(F.col("page_id").alias("refers_to"), "digest").agg(F.max("bytes").alias("payload_bytes")))
    revisits = records.where("type = 'revisit'").join(whole, ["refers_to", "digest"], "left").select(
        "page_id", "url", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")
    return records.where("type <> 'revisit'").select(
        "page_id", "url", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).unionByName(revisits)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to archives in the shared folder and read back."""
    path = shared_path(pages.sparkSession, "warc")
    write_warc(pages, path)
    return resolved(read_warc(pages.sparkSession, path))
