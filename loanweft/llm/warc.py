"""WARC archives written and read by Spark, and their capture index merged from sorted runs.

Writing: one gzip member per record, as WARC/1.1 asks for, through Spark's text
writer and so its commit protocol: a lost task leaves nothing behind, and the
folder may be in any store Spark knows. The writer puts a separator after every
value. The last byte of a gzip member is the top byte of its length, zero below
16 MB, so a value is the member without it and the separator is that byte; a
longer record is followed by an empty member, which ends in zero too.

Of equal payloads the record with the largest page_id is the response, the
others are revisits that name it. Who revisits whom is found on ids and digests
alone. Repeated rows of one page_id are told apart when written: the first is
the response.

Index: reading an archive gives its entries sorted by URL key, time and id, a
run, written to the shared folder. Keys taken evenly by hash from all runs cut
the key space into ranges of bounded size (the cuts are whole keys down to
the id, so one URL's captures may be cut as well). Each run is sliced at the
cuts, slices meet by range, and a loser tree merges a range's k sorted slices.
Entries by (range, seq) are the globally ordered capture histories.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweft.llm.common import materialize, pick, shared_path, slices

RECORDS_PER_FILE = 5_000  # an archive is read as one value
ENTRIES_PER_RANGE = 100_000
KEYS_PER_RANGE = 20
MOST_KEYS = 1_000_000  # that the driver sorts to find the cuts; beyond it ranges get fewer sampled keys each
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = zlib.compressobj(1, zlib.DEFLATED, 31).flush()
ENTRY = ("urlkey string, captured string, page_id bigint, archive string, at bigint, length bigint, payload_bytes bigint, "
         "payload_digest string, record_type string, refers_to bigint")
FIELDS = [part.split(" ")[0] for part in ENTRY.split(", ")]
ENTRY_TYPE = pa.schema([(name, pa.string() if kind == "string" else pa.int64()) for name, kind in (p.split(" ") for p in ENTRY.split(", "))])


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def captured_at(page_id: int | None) -> str:
    """A capture time that follows from the id: the pages carry none."""
    return (EPOCH + timedelta(seconds=(page_id or 0) % 3_000_000_000)).strftime("%Y-%m-%dT%H:%M:%SZ")


def url_key(url: str) -> str:
    """Sort-friendly key: host labels reversed, lower case, no scheme, "www.", default port or fragment; query parts sorted."""
    found = re.match(r"(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?([^?#]*)(\?[^#]*)?", url.strip(), re.I)
    host, port, path, query = (part or "" for part in found.groups())
    host = re.sub(r"^www\d*\.", "", host.lower())
    key = ",".join(reversed(host.split("."))) + ("" if port in ("", ":80", ":443") else port) + ")" + (path.lower().rstrip("/") or "/")
    return key + ("?" + "&".join(sorted(query[1:].lower().split("&"))) if query[1:] else "")


def record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, revisit: bool, refers_to: int | None) -> bytes:
    """One WARC record, uncompressed. A page without a URL gets its id as target; control characters and blanks are escaped."""
    name = "null" if page_id is None else str(page_id)
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{name}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>",
            f"WARC-Date: {captured_at(page_id)}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{base32(sha1)}",
            "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{'null' if refers_to is None else refers_to}>"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def member(content: bytes) -> bytes:
    """``content`` as a gzip member that ends in a zero byte."""
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    made = packer.compress(content) + packer.flush()
    return made if made[-1] == 0 else made + EMPTY_MEMBER


def write(df: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write (page_id, url, html) as archives below ``path``; payloads shorter than ``least_bytes`` never revisit.

    A null html is an empty payload, a null or empty URL becomes urn:page:id.
    Null ids count as smallest. An empty table writes an archive without records.
    """
    pages = pick(df, page_id="bigint", url="string", html="string")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    narrow = pages.filter(F.octet_length("payload") >= least_bytes).select("page_id", "digest", "url")
    first = narrow.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1")
    revisits = narrow.join(first, "digest").groupBy("page_id", "digest", "refers_to").agg(
        F.count("*").alias("rows"), F.min(F.struct("url")).alias("least")).withColumnsRenamed({"page_id": "id", "digest": "d"})
    revisits = materialize(revisits, "revisits")  # its size is known then, so payloads are not moved if it is small
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("d"))
    # of several rows with the response's page_id one is the response: the first copy of the least url
    often = pages.join(revisits.filter("rows > 1"), same).groupBy("page_id", "url", "payload", "digest", "refers_to", "rows", "least").agg(F.count("*").alias("n"))
    copies = often.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")))).drop("n")
    once = pages.join(revisits.filter("rows > 1").select("id", "d"), same, "left_anti").join(revisits.filter("rows = 1"), same, "left").withColumn("copy", F.lit(0))
    every = once.select(*copies.columns).unionByName(copies)
    response = F.col("page_id").eqNullSafe(F.col("refers_to")) & (F.col("copy") == 0) & ((F.col("rows") == 1) | F.col("url").eqNullSafe(F.col("least.url")))
    ready = every.select("page_id", "url", "payload", "digest", "refers_to", (F.col("rows").isNotNull() & ~response).alias("again"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, ["payload"], 2 << 20):
                made = [member(record(page_id, url, content, bytes.fromhex(digest), again, refers_to))[:-1]
                        for page_id, url, content, digest, refers_to, again in zip(*(column.to_pylist() for column in piece.columns))]
                yield pa.RecordBatch.from_pydict({"value": pa.array(made, pa.binary())})

    rows = ready.sortWithinPartitions("page_id", "digest").mapInArrow(run, "value binary")
    rows.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields, block) of every record of an archive; empty members are passed over."""
    at, whole = 0, memoryview(content)
    while at < len(content):
        reader = zlib.decompressobj(31)
        parts, pos = [], at
        while not reader.eof:
            if pos >= len(content):
                raise ValueError("the archive is cut off")
            parts.append(reader.decompress(whole[pos:pos + 65536]))
            pos += 65536
        end = min(pos, len(content)) - len(reader.unused_data)
        data = b"".join(parts)
        if data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            size = int(fields["Content-Length"])
            if not lines[0].startswith("WARC/") or rest[size:] != b"\r\n\r\n":
                raise ValueError("not a WARC record")
            yield at, end - at, fields, rest[:size]
        at = end


def number(uri: str) -> int | None:
    text = uri.strip("<>").rpartition(":")[2]
    return None if text == "null" else int(text)


def entries(archive: str, content: bytes) -> list[tuple]:
    """An archive's index entries (``ENTRY``), sorted; every response payload is held against its digest."""
    made = []
    for at, length, fields, block in records(content):
        http, _, payload = block.partition(b"\r\n\r\n")
        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
        size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
        if kind == "response" and (len(payload) != size or base32(hashlib.sha1(payload).digest()) != digest):
            raise ValueError(f"a payload of {archive} doesn't match its digest")
        made.append((url_key(fields["WARC-Target-URI"]), re.sub(r"\D", "", fields["WARC-Date"]), number(fields["WARC-Record-ID"]), archive, at,
                     length, size, digest, kind, number(fields["WARC-Refers-To"]) if kind == "revisit" else None))
    return sorted(made, key=order)


def order(entry: tuple) -> tuple:
    """URL key, time, id (none first), and where the record is."""
    return entry[0], entry[1], -1 if entry[2] is None else entry[2], entry[3], entry[4]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The entries of all archives below ``path``, each archive's own sorted: the runs, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = entries(name.rpartition("/")[2], content.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * len(FIELDS), ENTRY_TYPE.types)],
                                                 schema=ENTRY_TYPE)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return materialize(files.mapInArrow(run, ENTRY), "capture-runs")


class LoserTree:
    """Merge of k sorted lists: each inner node keeps the loser of its match, so a next value costs one path to the top."""

    def __init__(self, runs: list[list[tuple]], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.heads = [self.head(i) for i in range(self.k)]
        self.losers = [-1] * max(1, self.k)
        winners = [-1] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self.before(a, b) else (b, a)
        self.losers[0] = winners[1] if self.k > 1 else 0

    def head(self, i: int):
        return self.key(self.runs[i][self.at[i]]) if self.at[i] < len(self.runs[i]) else None

    def before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) < (y, b))

    def __iter__(self) -> Iterator[tuple]:
        if not self.k:
            return
        while self.heads[winner := self.losers[0]] is not None:
            yield self.runs[winner][self.at[winner]]
            self.at[winner] += 1
            self.heads[winner] = self.head(winner)
            node = (winner + self.k) // 2
            while node:
                if self.before(self.losers[node], winner):
                    winner, self.losers[node] = self.losers[node], winner
                node //= 2
            self.losers[0] = winner


def cuts_of(runs: DataFrame, per_range: int) -> list[tuple]:
    """Keys that cut all entries into ranges of about ``per_range``: quantiles of the keys with the smallest hashes."""
    ranges = -(-runs.count() // per_range)
    if ranges < 2:
        return []
    keys = runs.select("urlkey", "captured", "page_id", "archive", "at")
    sampled = keys.orderBy(F.xxhash64(*keys.columns)).limit(min(MOST_KEYS, ranges * KEYS_PER_RANGE)).collect()
    ordered = sorted(order(tuple(row)) for row in sampled)
    return [ordered[len(ordered) * i // ranges] for i in range(1, ranges)]


def merge_index(runs: DataFrame, per_range: int = ENTRIES_PER_RANGE) -> DataFrame:
    """Entries of sorted runs as one ordered index: ``range`` and ``seq`` within it give the order, the other columns are ``ENTRY``."""
    cuts = cuts_of(runs, per_range)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come in the order in which the run was written; a place where the order falls starts another run
        for batch in batches:
            if not batch.num_rows:
                continue
            found = list(zip(*(column.to_pylist() for column in batch.columns)))
            keys = list(map(order, found))
            falls = [i for i in range(1, len(keys)) if keys[i] < keys[i - 1]]
            for low, high in zip([0, *falls], [*falls, len(keys)]):
                edges = sorted({low, high, *(bisect_left(keys, c, low, high) for c in cuts)})
                ranges = [place(cuts, keys[a]) for a in edges[:-1]]
                yield pa.RecordBatch.from_pydict({"range": pa.array(ranges, pa.int32()), "slice": pa.array(
                    [ipc(batch.slice(a, b - a)) for a, b in zip(edges, edges[1:])], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            for which, piece in zip(batch.column(0).to_pylist(), batch.column(1)):
                if which != current and held:
                    yield merged(current, held)
                    held = []
                current = which
                held.append(piece.as_py())
        if held:
            yield merged(current, held)

    def merged(which: int, pieces: list[bytes]) -> pa.RecordBatch:
        sources = [list(zip(*(column.to_pylist() for column in pa.ipc.open_stream(piece).read_all().columns))) for piece in pieces]
        rows = list(zip(*LoserTree(sources, order)))
        columns = [pa.array(c, t) for c, t in zip(rows, ENTRY_TYPE.types)]
        n = len(columns[0])
        return pa.RecordBatch.from_arrays([pa.array([which] * n, pa.int32()), pa.array(range(n), pa.int64()), *columns], names=["range", "seq", *FIELDS])

    sliced = runs.select(*FIELDS).mapInArrow(cut, "range int, slice binary")
    return sliced.repartition("range").sortWithinPartitions("range").mapInArrow(merge, f"range int, seq bigint, {ENTRY}")


def place(cuts: list[tuple], key: tuple) -> int:
    """Number of cuts at or below ``key``: a range starts with its cut."""
    low = bisect_left(cuts, key)
    return low + (low < len(cuts) and cuts[low] == key)


def ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def round_trip(df: DataFrame) -> DataFrame:
    """Write ``df`` (page_id, url, html) as archives in the shared folder, read them back and merge their index."""
    path = shared_path(df.sparkSession, "warc")
    write(df, path)
    return merge_index(read_runs(df.sparkSession, path))
