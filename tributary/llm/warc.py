"""WARC archives: writing records and reassembling segmented ones.

A capture is stored as an HTTP message whose body is framed in chunks. Blocks longer than ``SEGMENT`` bytes are cut:
the first record carries WARC-Segment-Number 1, continuation records name its id in WARC-Segment-Origin-ID,
and the last one gives WARC-Segment-Total-Length. Captures whose payload digest another one stands for become revisit
records. Files are written by Spark's text writer with the blank lines between records as its separator, so that
its committer places them in the shared folder. Records go to it in rows of about ``ROW_BYTES`` and files end after ``ROWS`` rows, so that
a file's size is bounded however long captures are.

Reading parses each file by its records' lengths, groups continuation records by origin id, orders them by segment number,
verifies the total length, decodes the chunked framing and compares the payload with the recorded digest.

A record is named by its id and payload digest; where several rows have both in common, also by the number of the writing task and
of the row in it. WARC-Refers-To gives the id and digest of the response (where that row is repeated, its records' names begin so).

Cases: null payloads count as empty; an empty payload has a zero-length chunk only; a null id is written as an empty one and read
back as null; repeated rows are records of their own; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import join_by_key
from tributary.session import materialise, ship

#: Bytes of a block in one record; longer blocks continue in further records.
SEGMENT = 32 * 1024
#: Bytes of a chunk of the transfer framing.
CHUNK_BYTES = 8 * 1024
#: A row of the text writer holds records of about so many bytes, a file so many rows.
ROW_BYTES = 1 << 20
ROWS = 64
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    """Base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    parts = []
    for a in range(0, len(payload), size):
        part = payload[a : a + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload in chunked framing; chunk extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if len(body) < at + size + 2:
            raise ValueError("a chunk is cut short")
        out.append(body[at : at + size])
        at += size + 2


def _record(kind: str, name: str, block: bytes, **fields: object) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:x-capture:{name}>", "WARC-Date": DATE} | {
        k.replace("_", "-"): v for k, v in fields.items() if v is not None
    }
    kind_of = "application/http; msgtype=response" if kind != "warcinfo" else "application/warc-fields"
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in head.items()), f"Content-Type: {kind_of}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def records(name: str, url: str | None, payload: bytes, refers_to: str | None, segment: int = SEGMENT) -> list[bytes]:
    """The records of one capture: a revisit, one response, or a response with its continuations."""
    common = {"WARC_Target_URI": re.sub(r"[\r\n]", "", url) if url else None, "WARC_Payload_Digest": f"sha1:{payload_digest(payload)}"}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers_to is not None:
        return [
            _record(
                "revisit", name, head, **common, X_Payload_Length=len(payload),
                WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                WARC_Refers_To=f"<urn:x-capture:{refers_to}>",
            )
        ]
    block = head + chunked(payload)
    if len(block) <= segment:
        return [_record("response", name, block, **common)]
    parts = [block[a : a + segment] for a in range(0, len(block), segment)]
    out = [_record("response", name, parts[0], **common, WARC_Segment_Number=1)]
    for i, part in enumerate(parts[1:], 2):
        last = len(block) if i == len(parts) else None
        out.append(
            _record(
                "continuation", f"{name}-{i}", part, WARC_Segment_Number=i,
                WARC_Segment_Origin_ID=f"<urn:x-capture:{name}>", WARC_Segment_Total_Length=last,
            )
        )
    return out


def write(captures: DataFrame, path: str, min_revisit_bytes: int = 0) -> None:
    """captures: id long, url string, payload string (UTF-8). Writes their records under path.

    Of equal payloads of at least min_revisit_bytes, the one with the largest id is the response.
    """
    ship(captures.sparkSession)
    rows = captures.select("id", "url", F.coalesce("payload", F.lit("")).alias("payload"))
    rows = rows.withColumn("sum", F.sha1(F.encode("payload", "utf-8"))).withColumn("bytes", F.octet_length("payload"))
    # Digests alone are grouped: the payload only moves once, with its row. A digest that very many captures share (empty
    # payloads) is broadcast with its response, its captures stay where they are.
    same = materialise(rows.groupBy("id", "sum", "bytes").agg(F.count(F.lit(1)).alias("n")), "captures")
    stands = same.groupBy("sum", "bytes").agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("ids"), F.max("n").alias("most"))
    several = (F.col("ids") > 1) & (F.col("bytes") >= min_revisit_bytes)
    stands = stands.withColumn("keeper", F.when(several, F.col("keeper"))).where("keeper is not null or most > 1").drop("most")
    other = F.col("id").isNull() | (F.col("id") != F.col("keeper"))
    marks = (
        join_by_key(same, materialise(stands, "responses"), ["sum", "bytes"], "ids")
        .select(
            F.col("id").alias("m_id"), F.col("sum").alias("m_sum"), F.col("bytes").alias("m_bytes"),
            F.when(other, F.col("keeper")).alias("keeper"), (F.col("n") > 1).alias("repeated"),
        )
        .where("keeper is not null or repeated")
    )

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number = TaskContext.get().partitionId(), 0
        for frame in frames:
            out: list[str] = []
            held: list[bytes] = []
            size = 0
            columns = (frame[c] for c in ("id", "url", "payload", "keeper", "repeated"))
            for name, url, payload, keeper, repeated in zip(*columns):
                data = payload.encode("utf-8", "surrogatepass")
                digest = payload_digest(data)
                name = f"{'' if pd.isna(name) else int(name)}.{digest}"
                if repeated is not None and not pd.isna(repeated) and repeated:
                    name, number = f"{name}.{part}-{number}", number + 1
                # the writer puts END after each value, which ends the last record
                for record in records(name, url, data, None if pd.isna(keeper) else f"{int(keeper)}.{digest}"):
                    held.append(record)
                    size += len(record)
                    if size >= ROW_BYTES:
                        out.append(END.encode().join(held))
                        held, size = [], 0
                if len(out) >= 4:
                    yield pd.DataFrame({"value": out})
                    out = []
            yield pd.DataFrame({"value": [*out, END.encode().join(held)] if held else out})

    equal = F.col("id").eqNullSafe(F.col("m_id")) & (F.col("sum") == F.col("m_sum")) & (F.col("bytes") == F.col("m_bytes"))
    (
        rows.join(marks, equal, "left")
        .select(F.col("id").cast("string").alias("id"), "url", "payload", F.col("keeper").cast("string").alias("keeper"), "repeated")
        .mapInPandas(work, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", END)
        .option("maxRecordsPerFile", ROWS)
        .option("compression", "gzip")
        .text(path)
    )


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record in a file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        a, b = end + 4, end + 4 + int(head["content-length"])
        if data[b : b + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has another length")
        yield head, data[a:b]
        at = b + 4


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per capture: id, url, record_type, refers_to, payload_bytes, payload_digest, payload (null for revisits)."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)

    def name_of(value: str | None) -> str | None:
        return value[len("<urn:x-capture:") : -1] if value else None

    def id_of(name: str | None) -> int | None:
        return int(name.split(".")[0]) if name and name.split(".")[0] else None

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["origin", "segment", "total", "kind", "url", "refers_to", "digest", "length", "block"]
        for frame in frames:
            for content in frame["content"]:
                rows, size = [], 0
                for head, block in parse(gzip.decompress(content)):
                    number = int(head.get("warc-segment-number", 0))
                    origin = name_of(head.get("warc-segment-origin-id")) if number > 1 else name_of(head["warc-record-id"])
                    rows.append(
                        (
                            origin, number, int(head.get("warc-segment-total-length", -1)), head["warc-type"], head.get("warc-target-uri"),
                            name_of(head.get("warc-refers-to")), head.get("warc-payload-digest"), int(head.get("x-payload-length", -1)), block,
                        )
                    )
                    size += len(block)
                    if size > 1 << 22:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, size = [], 0
                yield pd.DataFrame(rows, columns=columns)

    found = files.select("content").mapInPandas(
        split,
        "origin string, segment int, total long, kind string, url string, refers_to string, digest string, length long, block binary",
    )
    # Whole records need no other; segments meet under their origin.
    kind = F.when(F.col("kind") != "continuation", F.col("kind"))
    whole = found.where("segment = 0").select(
        "origin", F.array(F.struct("segment", "block")).alias("parts"), "total", "url", "refers_to", "digest", "length", "kind"
    )
    joined = (
        found.where("segment > 0")
        .groupBy("origin")
        .agg(
            F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
            F.max("total").alias("total"),
            F.max("url").alias("url"),
            F.max("refers_to").alias("refers_to"),
            F.max("digest").alias("digest"),
            F.max("length").alias("length"),
            F.max(kind).alias("kind"),
        )
        .unionByName(whole)
    )

    def restore(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                numbers = [int(p["segment"]) for p in r.parts]
                block = b"".join(bytes(p["block"]) for p in r.parts)
                if numbers != [0] and (numbers != list(range(1, len(numbers) + 1)) or len(block) != r.total):
                    raise ValueError(f"capture {r.origin}: segments {numbers} hold {len(block)} of {r.total} bytes")
                name = id_of(r.origin)
                digest = (r.digest or "").removeprefix("sha1:")
                if r.kind == "revisit":
                    rows.append((name, r.url, r.kind, id_of(r.refers_to), r.length, digest, None))
                    continue
                head, _, body = block.partition(b"\r\n\r\n")
                payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                if payload_digest(payload) != digest:
                    raise ValueError(f"capture {r.origin}: the payload has another digest")
                rows.append((name, r.url, r.kind, None, len(payload), digest, payload))
            out = pd.DataFrame(rows, columns=["id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])
            # from the rows, not from columns of floats: ids of more than 53 bits stay exact
            yield out.assign(id=pd.array([r[0] for r in rows], "Int64"), refers_to=pd.array([r[3] for r in rows], "Int64"))

    return joined.mapInPandas(
        restore,
        "id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary",
    )
