"""WARC archives, and reading them back with boundary-chain verification (operator 9).

Writing: one record a page. Of pages with equal payloads of at least ``REVISIT_BYTES`` the one with
the largest page_id is a response record, the others are revisit records that refer to it and hold
only the HTTP header. Archives are text files whose line separator is the end of a record, one for
each task, so Spark writes them to any store.

Reading: archives are read in splits, cut at each occurrence of the magic ``WARC/1.``. Every piece
with a readable header is a candidate record; its Content-Length gives the offset of its successor.
A task only knows offsets from the start of its split, so the splits' sizes are summed into absolute
offsets afterwards. Inside a split the tasks follow successors themselves: each candidate gets its
exit (the first successor beyond the split) and its place in the tree of successors. From the start
of the file, pointer jumping over the exits then finds the one true entry of each split, and a
candidate is a record if the entry lies in its subtree. Magic inside a payload is never reached.

Payloads are hashed piece by piece as they are read, so candidates inside one another cost no memory
but their hash states. A record that also crosses the end of its split is put together in a second, narrow pass.

Defined cases: a null html is an empty payload; a null url writes no target; a null page_id is
written without an id and read back as null. Rows that share the largest page_id are all responses.
Repeated rows give repeated records. An empty table gives no records. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import shared_folder, written

#: Fixed values of the format.
MAGIC, END_OF_RECORD, BREAK = "WARC/1.", "\r\n\r\n", "\r\n"
#: Bytes of a revisit record's block in which the length of its payload is looked for.
HTTP_HEAD = 1 << 16
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"

_PAGE = re.compile(rb"<urn:page:(-?\d+)>")


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def write_archives(pages: DataFrame, folder: str) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html) as archives in ``folder``."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html"), F.octet_length(payload).alias("size"), F.sha1(payload.cast("binary")).alias("digest"))
    groups = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size").agg(F.max("page_id").alias("owner"), F.count("*").alias("n"))
    copies = written(groups.where("n > 1").select("digest", "size", "owner"), "warc-copies")
    rows = rows.join(copies, ["digest", "size"], "left")
    revisit = F.col("owner").isNotNull() & ~F.col("owner").eqNullSafe(F.col("page_id"))

    http = F.concat_ws(BREAK, F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), F.col("size")), F.lit(BREAK))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    target = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat_ws(
        BREAK,
        F.lit(MAGIC + "1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.lit("WARC-Date: " + DATE),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.lit("WARC-Profile: " + REVISIT_PROFILE)),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("owner")))),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block")),
        F.lit(BREAK),
    )
    records = rows.withColumn("block", block).select(F.concat(header, F.col("block")).alias("value"))
    records.write.option("lineSep", END_OF_RECORD).text(folder)


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    read = spark.read.option("lineSep", MAGIC).text(folder)
    return read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("file_size"), F.col("value").cast("binary").alias("piece"))


def _header(piece: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """Names (lower case) and values of the record that begins with this piece, and where its block begins."""
    end = piece.find(b"\r\n\r\n")
    if end < 0 or piece[:3] not in (b"0\r\n", b"1\r\n"):
        return None
    found = {}
    for line in piece[3:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            found[name.strip().lower()] = value.strip()
    if not found.get(b"content-length", b"").isdigit() or b"warc-type" not in found or b"warc-record-id" not in found:
        return None
    return found, end + 4


def _page(value: bytes | None) -> int | None:
    match = _PAGE.fullmatch(value or b"")
    return int(match[1]) if match else None


def _content(kind: str, block: bytes) -> tuple[int, str | None]:
    """Bytes and SHA-1 of a response's payload; for a revisit the bytes that its HTTP header states."""
    head, _, payload = block.partition(b"\r\n\r\n")
    if kind == "revisit":
        stated = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)
        return (int(stated[1]) if stated else 0), None
    return len(payload), hashlib.sha1(payload).hexdigest()


_FIELDS = [("path", "string"), ("block", "long"), ("file_size", "long"), ("at", "long"), ("successor", "long"), ("exit", "long"), ("tree_in", "long"), ("tree_out", "long")]
_FIELDS += [("type", "string"), ("page_id", "long"), ("refers_to", "long"), ("payload_bytes", "long"), ("payload_digest", "string"), ("complete", "boolean"), ("split_bytes", "long")]
_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in _FIELDS)


class _Open:
    """A record's block as it is read: its bytes are hashed and counted, not kept, however many records overlap."""

    __slots__ = ("record", "missing", "tail", "head", "size", "sha1")

    def __init__(self, record: dict, size: int):
        self.record, self.missing, self.tail, self.head, self.size, self.sha1 = record, size, b"", b"", 0, None

    def feed(self, data: bytes) -> bool:
        """Take what belongs to the block; True once it is complete."""
        if len(data) > self.missing:
            data = data[: self.missing]
        self.missing -= len(data)
        if self.sha1 is None:
            if self.record["type"] == "revisit" and len(self.head) < HTTP_HEAD:
                self.head += data[: HTTP_HEAD - len(self.head)]
            data = self.tail + data
            end = data.find(b"\r\n\r\n")
            if end < 0:
                self.tail = data[-3:]
                data = b""
            else:
                data, self.sha1 = data[end + 4 :], hashlib.sha1()
        if self.sha1 is not None:
            self.sha1.update(data)
            self.size += len(data)
        if self.missing > 0:
            return False
        size, digest = self.size, (self.sha1 or hashlib.sha1()).hexdigest()
        if self.record["type"] == "revisit":
            size, digest = _content("revisit", self.head)
        self.record |= {"payload_bytes": size, "payload_digest": digest or self.record["payload_digest"], "complete": True}
        return True


class _Split:
    """Candidates of one split; offsets count from its first piece."""

    def __init__(self, path: str, block: int, file_size: int):
        self.path, self.block, self.file_size = path, block, file_size
        self.read, self.first, self.found, self.open = 0, block == 0, [], []

    def add(self, piece: bytes) -> None:
        if self.open:
            data = MAGIC.encode() + piece
            self.open = [o for o in self.open if not o.feed(data)]
        at = self.read - len(MAGIC)
        self.read += len(piece) + len(MAGIC)
        first, self.first = self.first, False
        if first or (parsed := _header(piece)) is None:
            return
        header, begin = parsed
        size = int(header[b"content-length"])
        kind = header[b"warc-type"].decode("latin-1")
        digest = header.get(b"warc-payload-digest", b"").decode("latin-1").removeprefix("sha1:") or None
        record = {"at": at, "successor": at + len(MAGIC) + begin + size + len(END_OF_RECORD), "type": kind, "page_id": _page(header[b"warc-record-id"]), "refers_to": _page(header.get(b"warc-refers-to"))}
        record |= {"payload_digest": digest, "payload_bytes": None, "complete": False}
        self.found.append(record)
        opened = _Open(record, size)
        if not opened.feed(piece[begin:]):
            self.open.append(opened)

    def rows(self) -> Iterator[dict]:
        """The candidates with exits and subtree bounds, and one row with the size of the split."""
        found = self.found
        place = {r["at"]: i for i, r in enumerate(found)}
        parent = [place.get(r["successor"], -1) for r in found]  # always later
        weight = [1] * len(found)
        for i, p in enumerate(parent):
            if p >= 0:
                weight[p] += weight[i]
        free = [0] * (len(found) + 1)  # next number inside each subtree; the last is for roots
        for i in reversed(range(len(found))):
            r, p = found[i], parent[i]
            r["exit"] = found[p]["exit"] if p >= 0 else r["successor"]
            r["tree_in"] = free[p]
            r["tree_out"] = free[p] + weight[i]
            free[p] += weight[i]
            free[i] = r["tree_in"] + 1
        common = {"path": self.path, "block": self.block, "file_size": self.file_size}
        for r in found:
            yield common | r
        yield common | {"split_bytes": self.read}


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}

    def packed(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds[k]) for n, k in _FIELDS], names=[n for n, _ in _FIELDS])

    split = None
    for batch in batches:
        for path, block, size, piece in zip(*(batch[c].to_pylist() for c in ("path", "block", "file_size")), batch["piece"]):
            if split is None or (split.path, split.block) != (path, block):
                if split is not None:
                    yield packed(list(split.rows()))
                split = _Split(path, block, size)
            split.add(piece.as_py())
    if split is not None:
        yield packed(list(split.rows()))


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """type, page_id, refers_to, payload_bytes and payload_digest of every record of the archives in ``folder``."""
    found = written(_pieces(spark, folder).mapInArrow(_candidates, _SCHEMA), "warc-candidates")
    sizes = found.where("split_bytes IS NOT NULL").groupBy("path", "block").agg(F.max("split_bytes").alias("split_bytes"), F.max("file_size").alias("file_size"))
    of_file = Window.partitionBy("path")  # the splits of one file
    bases = sizes.select("path", "block", (F.sum("split_bytes").over(of_file.orderBy("block")) - F.col("split_bytes")).alias("base"), F.sum("split_bytes").over(of_file).alias("read"), "file_size")
    whole = F.col("read") == F.col("file_size") + len(MAGIC)
    bases = written(bases.select("path", "block", F.when(whole, F.col("base")).otherwise(F.raise_error(F.lit("the splits of an archive don't add up to its size"))).alias("base")), "warc-bases")

    candidates = found.where("split_bytes IS NULL").join(bases, ["path", "block"])
    candidates = candidates.withColumns({c: F.col(c) + F.col("base") for c in ("at", "successor", "exit")})
    # a split's first piece lies at its base, behind the magic that the split before has counted
    starts = candidates.where("at = 0").select("path", "at")
    entries = starts
    splits = bases.groupBy("path").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if splits > 1:
        met = candidates.select("path", F.col("exit").alias("at")).distinct().union(starts)
        jumps = written(candidates.join(met, ["path", "at"], "left_semi").select("path", "at", F.col("exit").alias("to")), "warc-jumps")
        for _ in range(math.ceil(math.log2(splits))):
            ahead = entries.join(jumps, ["path", "at"]).select("path", F.col("to").alias("at"))
            entries = written(entries.union(ahead).distinct(), "warc-entries")
            further = jumps.select("path", F.col("at").alias("to"), F.col("to").alias("on"))
            jumps = written(jumps.join(further, ["path", "to"]).select("path", "at", F.col("on").alias("to")), "warc-jumps")
    entered = candidates.join(entries, ["path", "at"]).select("path", "block", F.col("tree_in").alias("entry"))
    records = candidates.join(entered, ["path", "block"]).where((F.col("entry") >= F.col("tree_in")) & (F.col("entry") < F.col("tree_out"))).drop("entry")
    if splits > 1:
        records = written(records, "warc-records")
        cut = records.where("NOT complete")
        if not cut.isEmpty():
            records = records.where("complete").unionByName(_completed(_pieces(spark, folder), bases, cut), allowMissingColumns=True)
    return records.select("type", "page_id", "refers_to", "payload_bytes", "payload_digest")


def _completed(pieces: DataFrame, bases: DataFrame, cut: DataFrame) -> DataFrame:
    """The records that go on in the next split, put together from all pieces; each split has one at most."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, read = None, 0
        for batch in batches:
            at = np.zeros(batch.num_rows, np.int64)
            for i, (path, block, piece) in enumerate(zip(batch["path"].to_pylist(), batch["block"].to_pylist(), batch["piece"])):
                if of != (path, block):
                    of, read = (path, block), 0
                at[i] = read
                read += len(piece.as_buffer()) + len(MAGIC)
            yield pa.RecordBatch.from_arrays([batch["path"], batch["block"], pa.array(at), batch["piece"]], names=["path", "block", "at", "piece"])

    source = pieces.select("path", "block", "piece").mapInArrow(placed, "path string, block long, at long, piece binary")
    source = source.join(bases, ["path", "block"]).select("path", "block", (F.col("at") + F.col("base")).alias("piece_at"), "piece")
    wanted = cut.select("path", "at", "successor", "type", "page_id", "refers_to", "payload_digest")
    # the splits that a record reaches into: its own and those that begin before its end
    reach = wanted.join(bases.select("path", "block", "base"), "path").where(F.col("base") < F.col("successor"))
    next_base = F.lead("base").over(Window.partitionBy("path").orderBy("block"))  # the splits of one file
    ends = bases.select("path", "block", F.coalesce(next_base, F.lit((1 << 63) - 1)).alias("end"))
    wanted = reach.join(ends, ["path", "block"]).where(F.col("end") > F.col("at")).drop("base", "end")
    parts = wanted.join(source, ["path", "block"]).where((F.col("piece_at") > F.col("at")) & (F.col("piece_at") < F.col("successor")))
    record = parts.groupBy("path", "at").agg(
        F.first("type").alias("type"), F.first("page_id").alias("page_id"), F.first("refers_to").alias("refers_to"), F.first("payload_digest").alias("stated"), F.sort_array(F.collect_list(F.struct("piece_at", "piece"))).alias("parts")
    )

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [], []
            for kind, stated, pieces in zip(batch["type"].to_pylist(), batch["stated"].to_pylist(), batch["parts"].to_pylist()):
                text = MAGIC.encode().join(p["piece"] for p in pieces)
                header, begin = _header(text)
                size, digest = _content(kind, text[begin : begin + int(header[b"content-length"])])
                sizes.append(size)
                digests.append(digest or stated)
            yield pa.RecordBatch.from_arrays([batch["type"], batch["page_id"], batch["refers_to"], pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], names=["type", "page_id", "refers_to", "payload_bytes", "payload_digest"])

    return record.select("type", "page_id", "refers_to", "stated", "parts").mapInArrow(closed, "type string, page_id long, refers_to long, payload_bytes long, payload_digest string")


def round_trip(pages: DataFrame) -> DataFrame:
    """Archives of ``pages`` written to a new shared folder and read back."""
    folder = shared_folder(pages.sparkSession, "warc")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder)
