"""WARC archives: writer and splittable reader.

Archives hold one gzip member per record.  A reader task owns a byte range: it
looks for gzip magic, takes a candidate as a member only when its first bytes
inflate to a WARC header, and reads every record that starts inside the range,
also when it ends beyond it.  Members are inflated in steps of ``STEP`` bytes.

Null html counts as empty and is a record too.  Repeated page ids with equal payloads are all the response when the id is the
smallest; null ids are never the smallest unless a group has no other.  Clashing
extra columns are ignored.  Writers rename a finished file into place, so a
retried task replaces its own file only.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

MAGIC = b"\x1f\x8b\x08"
STEP = 1 << 16
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def _urn(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (b"" if revisit else payload)
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)),
            ("WARC-Target-URI", " ".join((url or "").split())), ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload))),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if revisit:
        head += [("WARC-Refers-To", _urn(first)), ("X-Refers-To-Page", str(first)),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    said = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{said}\r\n".encode() + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """One archive per partition; repeats of a payload of ``min_bytes`` or more are revisits."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html.cast("binary"), 256).alias("d"))
    first = rows.groupBy("d").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    marked = rows.join(first, "d", "left").withColumn(
        "revisit", F.coalesce((F.octet_length("html") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False)) & F.col("first").isNotNull())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():06d}.warc.gz"
        draft = f"{root}/.{name}.{ctx.taskAttemptId()}"
        n = 0
        with store.open_output_stream(draft, compression=None) as out:
            for b in batches:
                for page, url, text, at, again in zip(b["page_id"], b["url"], b["html"], b["first"], b["revisit"], strict=True):
                    page, at = (None if pd.isna(x) else int(x) for x in (page, at))
                    c = zlib.compressobj(6, zlib.DEFLATED, 31)
                    out.write(c.compress(record_bytes(page, url, text.encode("utf-8", "surrogatepass"), at, bool(again))) + c.flush())
                    n += 1
        store.move(draft, f"{root}/{name}")
        yield pd.DataFrame({"n": [n]})

    marked.select("page_id", "url", "html", "first", "revisit").mapInPandas(run, "n long").agg(F.sum("n")).collect()


class _Bytes:
    """Buffered forward reading of one file from a place on."""

    def __init__(self, f, at: int):
        self.f, self.at, self.buf = f, at, b""
        f.seek(at)

    def more(self) -> bool:
        got = self.f.read(STEP)
        self.buf += got
        return bool(got)

    def skip(self, n: int) -> None:
        self.buf, self.at = self.buf[n:], self.at + n


def _is_member(data: bytes) -> bool:
    try:
        return zlib.decompressobj(31).decompress(data, 64).startswith(b"WARC/")
    except zlib.error:
        return False


def members(f, start: int, end: int) -> Iterator[bytes]:
    """The inflated records of members that start in [start, end)."""
    src = _Bytes(f, start)
    while True:
        while len(src.buf) < 1024 and src.more():
            pass
        k = src.buf.find(MAGIC)
        if k < 0:
            src.skip(max(0, len(src.buf) - 2))
            if src.at >= end or not src.more():
                return
            continue
        src.skip(k)
        if src.at >= end:
            return
        while len(src.buf) < 1024 and src.more():
            pass
        if not _is_member(src.buf):
            src.skip(1)
            continue
        d, out = zlib.decompressobj(31), io.BytesIO()
        while True:
            n = len(src.buf)
            out.write(d.decompress(src.buf))
            if d.eof:
                src.skip(n - len(d.unused_data))
                break
            src.skip(n)
            if not src.more():
                raise EOFError("archive ends inside a member")
        yield out.getvalue()


def parse(record: bytes) -> tuple:
    head, _, block = record.partition(b"\r\n\r\n")
    h = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = block[:int(h["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    revisit = h["WARC-Type"] == "revisit"
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {h['WARC-Record-ID']} does not match its digest")
    num = lambda k: int(h[k]) if k in h else None
    return num("X-Page-Id"), int(h["X-Payload-Length"]) if revisit else len(payload), digest, h["WARC-Type"], num("X-Refers-To-Page"), h["WARC-Target-URI"], None if revisit else payload


def read_warc(spark: SparkSession, folder: str, split_bytes: int = 8 << 20) -> DataFrame:
    """One row per record: RECORD, url, payload (null for revisits)."""
    store, root = _open(folder)
    files = [x for x in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if x.path.endswith(".warc.gz")]
    ranges = [(x.path, a, min(a + split_bytes, x.size)) for x in files for a in range(0, x.size, split_bytes)]
    splits = spark.createDataFrame(ranges, "path string, a long, b long").repartition(max(1, len(ranges)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = _open(folder)
        cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
        for b in batches:
            for path, lo, hi in zip(b["path"], b["a"], b["b"], strict=True):
                with store.open_input_file(path) as f:
                    rows = []
                    for m in members(f, lo, hi):
                        rows.append(parse(m))
                        if len(rows) == 256:
                            yield pd.DataFrame(rows, columns=cols).astype({"page_id": "Int64", "refers_to": "Int64"})
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=cols).astype({"page_id": "Int64", "refers_to": "Int64"})

    return splits.mapInPandas(run, RECORD + ", url string, payload binary")


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives in the shared folder and read their records back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_warc(pages, folder)
    return read_warc(spark, folder).drop("url", "payload")
