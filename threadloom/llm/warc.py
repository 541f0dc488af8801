"""WARC archives: write, normalise, read back.

Pages become WARC records and are written as plain gzip files, one stream a file.
The normaliser inflates each file once from its start, cuts the stream into records
while it runs, and writes every record as a gzip member of its own, so that a record
can be read alone. Beside each archive a table of offsets is written.

All files lie in the shared folder and are reached through Spark's or Arrow's file
systems. An archive is written under a name of its attempt and then moved, so that a
repeated task leaves one whole file.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.fs as pafs
import pyarrow.parquet as parquet
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.session import materialize, scratch_path

#: Payloads of fewer bytes are always written whole.
LEAST_REVISIT = 1000
#: Payload bytes that a file is meant to hold.
FILE_BYTES = 16 << 20
CHUNK = 1 << 18
#: Offsets are read in groups of this many records.
READ_GROUP = 2000
#: Payloads of more than one repeated row in so many have their response broadcast.
SHARE = 1000
#: What the offset table beside an archive is called, after the archive's own name.
INDEX_SUFFIX = ".index.parquet"

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URI = "urn:page:"


def revisit_plan(pages: DataFrame, files: int, least: int = LEAST_REVISIT) -> DataFrame:
    """Adds payload_bytes, payload_digest and refers_to (null for a response), in ``files`` parts.

    Of equal payloads the row with the largest page_id is the response; rows that
    repeat this page_id are responses too. Only digests are grouped, combined before
    the shuffle, and every payload is shuffled once: to its digest's group, or, for
    payloads of more than one row in ``SHARE`` (so there are fewer than ``SHARE`` of
    them, and their groups are broadcast), to any part.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    sized = pages.withColumn("payload_bytes", F.octet_length(payload).cast("long")).withColumn("payload_digest", F.sha1(payload))
    key = ["payload_digest", "payload_bytes"]
    copies = sized.where(F.col("payload_bytes") >= least).groupBy(*key).agg(F.max("page_id").alias("latest"), F.count("*").alias("n"))
    copies = materialize(copies.where(F.col("n") > 1), "copies")
    often = F.col("n") > (copies.agg(F.sum("n").alias("n")).first()["n"] or 0) / SHARE
    hot = F.broadcast(copies.where(often).select(*key, F.col("latest").alias("hot_latest"), F.lit(True).alias("hot")))
    marked = sized.join(hot, key, "left")
    spread = marked.where("hot").withColumnRenamed("hot_latest", "latest").drop("hot").repartition(files, F.xxhash64("page_id", "url"))
    rest = marked.where(F.col("hot").isNull()).drop("hot", "hot_latest").repartition(files, *key)
    joined = rest.join(copies.where(~often).drop("n").repartition(files, *key).hint("shuffle_hash"), key, "left")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("latest")), None).otherwise(F.col("latest"))
    return joined.unionByName(spread).withColumn("refers_to", refers).drop("latest")


def header_safe(text: Column) -> Column:
    """A value for one header line: white space and controls percent-encoded."""
    for code in (*range(0x21), 0x7F):
        text = F.replace(text, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return text


def record_text(stamp: str = "1970-01-01T00:00:00Z") -> Column:
    """A record up to, but without, its last line break."""
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, "").otherwise(F.coalesce(F.col("html"), F.lit("")))
    url = F.coalesce(header_safe(F.when(F.col("url") != "", F.col("url"))), F.concat(F.lit(PAGE_URI), page))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit(f"WARC-Record-ID: <{PAGE_URI}"), page, F.lit(">")),
        F.lit(f"WARC-Date: {stamp}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(revisit, F.concat(F.lit(f"WARC-Refers-To: <{PAGE_URI}"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("payload_bytes")).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), body, F.lit("\r\n"))


def write_monolithic(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> None:
    """Write pages (page_id, url, html) as gzip files of many records, one stream each.

    The text sink ends every record with its last line break. The number of files
    follows the payload bytes.
    """
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    plan = revisit_plan(pages, max(1, -(-int(total) // file_bytes)))
    plan.select(record_text().alias("value")).write.option("compression", "gzip").option("lineSep", "\r\n").text(folder)


class RecordCutter:
    """Cuts a growing stream of bytes into whole records by their stated lengths."""

    def __init__(self):
        self.held = bytearray()

    def feed(self, data: bytes):
        self.held += data
        at = 0
        while True:
            end = self.held.find(b"\r\n\r\n", at)
            if end < 0:
                break
            whole = end + 4 + content_length(bytes(self.held[at : end + 2])) + 4
            if whole > len(self.held):
                break
            yield bytes(self.held[at:whole])
            at = whole
        del self.held[:at]


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record starts here: {lines[0][:40]!r}")
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:] if line)}


def content_length(head: bytes) -> int:
    return int(headers_of(head)["content-length"])


def member(record: bytes) -> bytes:
    """A record as a gzip member; no time of writing, so equal records are equal members."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def records_of(source) -> Iterator[bytes]:
    """Records of a gzip stream, inflated once and a chunk at a time; members may follow each other."""
    cutter, inflate = RecordCutter(), zlib.decompressobj(31)
    while chunk := source.read(CHUNK):
        while chunk:
            yield from cutter.feed(inflate.decompress(chunk))
            chunk = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            else:
                break
    if cutter.held:
        raise ValueError("the stream ends inside a record")


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


INDEX = "archive string, offset long, length long, record_no long"


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every file of ``source`` record by record into ``target``; gives the index.

    Index columns: archive, offset, length, record_no; one table of them lies beside each
    archive, named like it, and the returned frame reads these. A task inflates one file as a stream;
    it holds a chunk, a record and the offsets. A source file is removed once its archive
    and index have their names; a repeated task that finds none has nothing left to do.
    """
    files = sorted(f.getPath().toString() for f in hadoop_files(spark, source) if f.getPath().getName().endswith(".gz"))

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, place = opened(path)
                out_fs, folder = opened(target)
                out_fs.create_dir(folder, recursive=True)
                name = place.rsplit("/", 1)[-1].removesuffix(".gz").removesuffix(".txt") + ".warc.gz"
                done = out_fs.get_file_info(f"{folder}/{name}{INDEX_SUFFIX}").type == pafs.FileType.File
                if done and fs.get_file_info(place).type == pafs.FileType.NotFound:
                    continue
                attempt = f"{folder}/.{name}.{uuid.uuid4().hex}"
                lengths = []
                with fs.open_input_stream(place, compression=None) as stream, out_fs.open_output_stream(attempt, compression=None) as out:
                    for record in records_of(stream):
                        packed = member(record)
                        out.write(packed)
                        lengths.append(len(packed))
                with out_fs.open_output_stream(f"{attempt}.index", compression=None) as out:
                    parquet.write_table(offset_table(f"{target.rstrip('/')}/{name}", lengths), out)
                out_fs.move(attempt, f"{folder}/{name}")
                out_fs.move(f"{attempt}.index", f"{folder}/{name}{INDEX_SUFFIX}")
                fs.delete_file(place)
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["path"])

    listed = spark.createDataFrame([(f,) for f in files], "path string").repartition(max(1, len(files)))
    listed.mapInArrow(run, "path string").write.format("noop").mode("overwrite").save()
    if not files:
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).option("pathGlobFilter", f"*{INDEX_SUFFIX}").parquet(target)


def offset_table(archive: str, lengths: list[int]) -> pa.Table:
    sizes = pa.array(lengths, pa.int64())
    offsets = pa.compute.subtract(pa.compute.cumulative_sum(sizes), sizes)
    numbers = pa.array(range(len(lengths)), pa.int64())
    return pa.table({"archive": pa.array([archive] * len(lengths), pa.string()), "offset": offsets, "length": sizes, "record_no": numbers})


def hadoop_files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)


def page_of(value: str | None) -> int | None:
    text = (value or "").strip("<>").removeprefix(PAGE_URI)
    return int(text) if text not in ("", "null") else None


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, html string"


def read_records(index: DataFrame) -> DataFrame:
    """Records of normalised archives, each from its own offset: page_id, payload_bytes,
    payload_digest, record_type, refers_to, url and html (empty for a revisit)."""
    def run(batches):
        for batch in batches:
            rows = []
            archives, offsets, lengths = (batch.column(i).to_pylist() for i in range(3))
            handles: dict[str, object] = {}
            for archive, offset, length in zip(archives, offsets, lengths):
                if archive not in handles:
                    for handle in handles.values():
                        handle.close()
                    fs, place = opened(archive)
                    handles = {archive: fs.open_input_file(place)}
                record = zlib.decompress(handles[archive].read_at(length, offset), 31)
                head, _, rest = record.partition(b"\r\n\r\n")
                fields = headers_of(head)
                body = rest[: int(fields["content-length"])]
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                if fields["warc-type"] == "response" and hashlib.sha1(body).hexdigest() != digest:
                    raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
                rows.append((
                    page_of(fields["warc-record-id"]), int(fields["warc-payload-length"]), digest, fields["warc-type"],
                    page_of(fields.get("warc-refers-to")), fields["warc-target-uri"], body,
                ))
            for handle in handles.values():
                handle.close()
            if rows:
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                columns[-1] = columns[-1].cast(pa.string())
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "html"])

    group = F.floor(F.col("record_no") / READ_GROUP)
    parts = max(1, -(-index.count() // READ_GROUP))
    dealt = index.repartition(parts, "archive", group).sortWithinPartitions("archive", "offset")
    return dealt.select("archive", "offset", "length").mapInArrow(run, READ)


def archive_pages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write pages to WARC archives, normalise these, and read the records back.

    One record per row. A null html is an empty payload; a null or empty URL becomes
    a name made of the id; line breaks and controls in URLs are percent-encoded. Rows
    that repeat the largest page_id of a payload are all responses. A null page_id
    stays null, and is a response unless another row has the same payload. An empty
    table gives no rows. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    picked = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    write_monolithic(picked, f"{folder}/monolithic", file_bytes)
    return read_records(normalise(spark, f"{folder}/monolithic", f"{folder}/normalised"))
