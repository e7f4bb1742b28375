"""WARC archives with an index that is enough to read any record by its bytes.

Writing: the smallest id of each payload digest is found first. Tasks then write
records to archives in the shared folder and yield one index row per record, with
archive, offset, length, URL and digest; the index is committed as a table. An archive
has a name of its own for each attempt of a task, and only the attempt that succeeds has
its rows in the index, so a lost executor leaves at most a file that nothing names.

Reading: any selection of index rows is dealt by archive and stretch of bytes, sorted by
offset, and near ranges are read together. Each record is a gzip member of its own.

Equal payloads may be a third of all rows: ids are combined before the shuffle, and the
join that carries them back is a plain one, which Spark splits. Rows with the smallest
id of their payload, repeated ones too, are responses; null ids come last, and rows
whose payload has no id at all are responses. Null html is an empty payload; a null
URL is an empty one.
"""

import base64
import gzip
import hashlib
import uuid
import zlib
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_folder

DATE = "2024-01-01T00:00:00Z"
ARCHIVE_BYTES, STRETCH_BYTES, GAP_BYTES, READ_BYTES = 256 << 20, 16 << 20, 64 << 10, 8 << 20

#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = ("page_id long, url string, record_type string, refers_to long, payload_digest string, archive string, "
         "offset long, length long")
RECORD = ("page_id long, url string, record_type string, refers_to_record string, record_id string, header_digest string, "
          "payload_digest string, payload_bytes long, payload binary")


class Archives(NamedTuple):
    folder: str
    index: str


def payload_digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, digest):
    """The same for the same page and payload, in every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def _line(value):
    return "".join(char if char >= " " else f"%{ord(char):02X}" for char in value)


def record(page_id, url, payload, first, date=DATE):
    """The bytes of one record: a revisit of page ``first`` if there is one."""
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    headers = [
        ("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date), ("WARC-Target-URI", _line(url or "")), ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if first is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(first, digest))]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "\r\n".join([VERSION, *(f"{name}: {value}" for name, value in headers)])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data):
    """Headers and payload of a record's bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def _written(folder, archive_bytes, date):
    def written(batches):
        import pyarrow as pa
        from pyarrow.fs import FileSystem

        system, base = FileSystem.from_uri(folder)
        out, path, offset = None, None, 0
        for batch in batches:
            rows = []
            for row in zip(*(batch.column(name) for name in ("page_id", "url", "payload", "first"))):
                page_id, url, payload, first = (value.as_py() for value in row)
                data = gzip.compress(record(page_id, url, payload, first, date), 6, mtime=0)
                if out is None or offset >= archive_bytes:
                    if out is not None:
                        out.close()
                    path, offset = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(path, compression=None)
                out.write(data)
                kind = "response" if first is None else "revisit"
                rows.append((page_id, url, kind, first, payload_digest(payload), path.rpartition("/")[2], offset, len(data)))
                offset += len(data)
            columns = zip(*rows) if rows else [()] * 8
            names = [field.split(" ")[0] for field in INDEX.split(", ")]
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_pydict(
                {name: pa.array(values, kind) for name, values, kind in zip(names, columns, types)})
        if out is not None:
            out.close()

    return written


def write(pages: DataFrame, min_bytes=0, archive_bytes=ARCHIVE_BYTES, date=DATE, page_id="page_id", url="url",
          html="html") -> Archives:
    """Archives of all rows in a new shared folder, and their index as a table beside them.

    Payloads of fewer than ``min_bytes`` are always written whole.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.when(F.octet_length("payload") >= min_bytes, F.sha1("payload")))
    smallest = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("page_id").alias("smallest"))
    rows = rows.join(smallest, "digest", "left")
    first = F.when(~F.col("page_id").eqNullSafe(F.col("smallest")), F.col("smallest"))
    folder = work_folder(spark, "warc")
    rows = rows.select("page_id", "url", "payload", first.alias("first"))
    rows.mapInArrow(_written(f"{folder}/archives", archive_bytes, date), INDEX).write.parquet(f"{folder}/index")
    return Archives(f"{folder}/archives", f"{folder}/index")


def index_of(spark, archives: Archives) -> DataFrame:
    return spark.read.schema(INDEX).parquet(archives.index)


def near_ranges(ranges, gap=GAP_BYTES, most=READ_BYTES):
    """Sorted (offset, length) ranges as reads: (begin, end, places of the ranges)."""
    reads = []
    for place, (offset, length) in enumerate(ranges):
        end = offset + length
        if reads and offset - reads[-1][1] <= gap and max(end, reads[-1][1]) - reads[-1][0] <= most:
            reads[-1][1] = max(reads[-1][1], end)
            reads[-1][2].append(place)
        else:
            reads.append([offset, end, [place]])
    return reads


def _read(folder, with_payload, gap, most):
    def read(batches):
        import pyarrow as pa
        from pyarrow.fs import FileSystem

        system, base = FileSystem.from_uri(folder)
        types = [pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]
        names = [field.split(" ")[0] for field in RECORD.split(", ")]
        for batch in batches:
            rows, names_of = [], batch.column("archive").to_pylist()
            ids, offsets, lengths = (batch.column(name).to_pylist() for name in ("page_id", "offset", "length"))
            edges = [0, *(place for place in range(1, len(ids)) if names_of[place] != names_of[place - 1]), len(ids)]
            for begin, end in zip(edges, edges[1:]):
                if begin == end:
                    continue
                with system.open_input_file(f"{base}/{names_of[begin]}") as file:
                    ranges = list(zip(offsets[begin:end], lengths[begin:end]))
                    for start, stop, places in near_ranges(ranges, gap, most):
                        data = file.read_at(stop - start, start)
                        for place in places:
                            offset, length = ranges[place]
                            whole = zlib.decompress(data[offset - start : offset - start + length], 31)
                            headers, payload = parsed(whole)
                            own = headers["WARC-Type"] == "response"
                            rows.append((
                                ids[begin + place], headers["WARC-Target-URI"], headers["WARC-Type"], headers.get("WARC-Refers-To"),
                                headers["WARC-Record-ID"], headers["WARC-Payload-Digest"].removeprefix("sha1:"),
                                payload_digest(payload) if own else None, len(payload) if own else None,
                                payload if own and with_payload else None))
            columns = zip(*rows) if rows else [()] * 9
            yield pa.RecordBatch.from_pydict(
                {name: pa.array(values, kind) for name, values, kind in zip(names, columns, types)})

    return read


def read(archives: Archives, selected: DataFrame, with_payload=True, gap=GAP_BYTES, most=READ_BYTES) -> DataFrame:
    """The records of the selected index rows. Payloads are those of responses only."""
    spark = selected.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = selected.select("page_id", "archive", "offset", "length", F.floor(F.col("offset") / STRETCH_BYTES).alias("stretch"))
    rows = rows.repartition(partitions, "archive", "stretch").sortWithinPartitions("archive", "offset").drop("stretch")
    return rows.mapInArrow(_read(archives.folder, with_payload, gap, most), RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """Records with length and digest of the full payload; a revisit's from its response.

    ``intact`` says whether the payload that was read has the digest of the header.
    """
    of = F.coalesce("refers_to_record", "record_id")
    whole = records.where("record_type = 'response'").groupBy("record_id").agg(
        F.first("payload_digest").alias("full_digest"), F.first("payload_bytes").alias("full_bytes"),
        F.first("page_id").alias("full_page"))
    rows = records.drop("payload_digest", "payload_bytes").withColumn("of", of)
    rows = rows.join(whole.withColumnRenamed("record_id", "of"), "of", "left")
    return rows.select(
        "page_id", "url", F.col("full_bytes").alias("payload_bytes"), F.col("full_digest").alias("payload_digest"), "record_type",
        F.when(F.col("record_type") == "revisit", F.col("full_page")).alias("refers_to"),
        F.col("full_digest").eqNullSafe(F.col("header_digest")).alias("intact"))
