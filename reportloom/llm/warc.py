"""WARC archives with an external index merge.

Writing: tasks write archives of separately compressed records to the shared folder and give
their captures as a locally sorted run, cut into sorted blocks of rows. Merging: key ranges
are drawn from the blocks' first keys; the blocks of all runs that reach into a range are
merged there by a loser tree, by URL key and timestamp. Ranges in order make one globally
ordered capture history. Reading: captures are grouped by archive and position, and only the
records asked for are read.

Payloads that repeat an earlier one are stored once: the others become revisit records that
name the record they repeat and keep the digest and length of the payload.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

LEAST_REVISIT = 100  # smaller payloads are always stored
ARCHIVE_BYTES = 64 << 20  # an archive is closed beyond this size
BLOCK_ROWS = 512  # captures of a run in one block
RANGE_ROWS = 8_192  # captures of a merged range, about
SAMPLE_BLOCKS = 20_000  # first keys that ranges are drawn from, at most
READ_RECORDS = 256
EPOCH = 1_704_067_200  # pages carry no time of capture: page_id seconds after 2024-01-01
CAPTURE = "urlkey string, captured string, page_id long, archive string, offset long, length long, kind string"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """Sort key of an address: host labels from the end, then the path, lower case, without scheme and ``www``."""
    plain = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:www\.)?", "")
    plain = F.regexp_replace(plain, r"#.*$", "")
    host = F.regexp_extract(plain, r"^([^/?]*)", 1)
    rest = F.substring(plain, F.char_length(host) + 1, F.lit(1 << 30))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def planned(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``page_id, url, payload, digest, refers_to, refers_url`` per row: what each record will be.

    Of equal payloads of at least ``least`` bytes the smallest page_id is stored; a null one is not
    smaller, and payloads under null ids only are all stored. Digests, not
    payloads, are brought together.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload")})
    first = rows.filter(F.col("size") >= least).groupBy("digest").agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"), F.count("*").alias("n"))
    # only payloads that repeat; Spark splits a digest that many rows share (skewed join)
    joined = rows.join(first.filter("n > 1"), "digest", "left")
    other = ~F.col("first.page_id").eqNullSafe(F.col("page_id")) & F.col("first").isNotNull()
    return joined.select(
        "page_id", "url", url_key(F.col("url")).alias("urlkey"), F.when(~other | F.col("first").isNull(), F.col("payload")).alias("payload"),
        "digest", F.col("size").cast("long").alias("size"), other.alias("revisit"),
        F.when(other, F.col("first.page_id")).alias("refers_to"), F.when(other, F.col("first.url")).alias("refers_url"),
    )


def stamp(page_id: int | None) -> str:
    """Time of capture as an ISO date."""
    at = np.datetime64(EPOCH + ((page_id or 0) % (1 << 32)), "s")
    return f"{at}Z"


def header_safe(value: str | None) -> str:
    """A header value on one line; control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value or "")


def record_bytes(row: dict) -> bytes:
    """One WARC/1.1 record with an HTTP response head; a revisit has the head only."""
    body = b"" if row["revisit"] else row["payload"]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "revisit" if row["revisit"] else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Target-URI", header_safe(row["url"])),
        ("WARC-Date", stamp(row["page_id"])),
        ("WARC-Payload-Digest", f"sha256:{row['digest']}"),
        ("X-Page-Id", "" if row["page_id"] is None else str(row["page_id"])),
    ]
    if row["revisit"]:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To-Target-URI", header_safe(row["refers_url"])),
            ("WARC-Refers-To-Date", stamp(row["refers_to"])),
            ("X-Refers-To-Page-Id", "" if row["refers_to"] is None else str(row["refers_to"])),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(head) + len(body)))]
    named = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass")
    return b"WARC/1.1\r\n" + named + b"\r\n" + head + body + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """Fields and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["HTTP-Content-Length"] = http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0].decode()
    return fields | {"payload": payload}


def place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write records to archives; gives the captures in sorted blocks: ``run, block, first, rows``.

    ``rows`` holds a block's captures. A task's captures form one run. Names are unique, so a
    task that is run again leaves files that no run names.
    """
    row = CAPTURE.replace(" ", ":").replace(",:", ", ")
    schema = f"run string, block int, first string, rows array<struct<{row}>>"
    kind = pa.struct([("urlkey", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("kind", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, captures = uuid.uuid4().hex, []
        system, base = place(folder)
        system.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            for row in (r for part in range(0, batch.num_rows, 64) for r in batch.slice(part, 64).to_pylist()):
                if out is None or at > ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{base}/{run}-{len(captures):09d}.warc.gz", 0
                    out = system.open_output_stream(name, compression=None)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = packer.compress(record_bytes(row)) + packer.flush()
                out.write(data)
                kind_ = "revisit" if row["revisit"] else "response"
                captures.append((row["urlkey"], stamp(row["page_id"]), row["page_id"], name, at, len(data), kind_))
                at += len(data)
        if out is not None:
            out.close()
        captures.sort(key=order)
        for number, begin in enumerate(range(0, len(captures), BLOCK_ROWS)):
            rows = [dict(zip(kind.names, c, strict=True)) for c in captures[begin : begin + BLOCK_ROWS]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([run]), pa.array([number], pa.int32()), pa.array([sort_text(captures[begin])]), pa.array([rows], pa.list_(kind))],
                ["run", "block", "first", "rows"],
            )

    return materialize(records.mapInArrow(write, schema), "runs")


def order(capture: tuple) -> tuple:
    """Sort key of a capture: URL key, timestamp, page (null first), place in the archives."""
    urlkey, captured, page_id, archive, offset = capture[:5]
    return urlkey.encode(), captured, page_id is not None, page_id or 0, archive, offset


def sort_text(capture: tuple) -> str:
    """The leading part of the order as one string that sorts alike; ranges are cut by it."""
    return f"{capture[0]}\x00{capture[1]}"


class LoserTree:
    """Merge of sorted iterators: inner nodes keep the losers, so each step plays one path of log k matches."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.size = max(1, len(runs))
        self.heads = [self.pull(i) for i in range(len(runs))] or [None]
        self.nodes = [-1] * self.size
        self.winner = self.build(1)

    def pull(self, run: int):
        """The next ``(key, item)`` of a run, None at its end."""
        return next(self.runs[run], None)

    def beats(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None
        return self.heads[a][0] <= self.heads[b][0]

    def build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self.build(2 * node), self.build(2 * node + 1)
        win, lose = (a, b) if self.beats(a, b) else (b, a)
        self.nodes[node] = lose
        return win

    def __iter__(self) -> Iterator[tuple]:
        while (head := self.heads[self.winner]) is not None:
            yield head[1]
            win = self.winner
            self.heads[win] = self.pull(win)
            node = (win + self.size) // 2
            while node >= 1:
                if self.beats(self.nodes[node], win):
                    self.nodes[node], win = win, self.nodes[node]
                node //= 2
            self.winner = win


def ranges(runs: DataFrame) -> list[str]:
    """Keys at which ranges of about ``RANGE_ROWS`` captures begin, from a bounded sample of the blocks' first keys."""
    blocks = runs.count()
    wanted = min(blocks * BLOCK_ROWS // RANGE_ROWS, SAMPLE_BLOCKS // 4)
    if wanted < 1:
        return []
    # the sample only sets where ranges begin; every capture is merged
    keys = [r["first"] for r in runs.select("first").orderBy(F.xxhash64("run", "block")).limit(SAMPLE_BLOCKS).collect()]
    keys = sorted(keys, key=str.encode)
    return sorted({keys[len(keys) * i // (wanted + 1)] for i in range(1, wanted + 1)}, key=str.encode)


def merged_index(runs: DataFrame) -> DataFrame:
    """All captures with ``part, place``: merged ranges in global order and the place within each."""
    cuts = ranges(runs)
    begins = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<string>")
    last = F.element_at("rows", -1)
    final = F.concat(last["urlkey"], F.lit("\x00"), last["captured"])
    reach = lambda key: F.size(F.filter(begins, lambda c: c <= key))
    dealt = runs.withColumn("part", F.explode(F.sequence(reach(F.col("first")), reach(final))))
    names = [c.split()[0] for c in CAPTURE.split(", ")]

    def merge(group: pa.Table) -> pa.Table:
        part = group["part"][0].as_py()
        low = cuts[part - 1] if part else None
        high = cuts[part] if part < len(cuts) else None
        inside = lambda c: (low is None or sort_text(c).encode() >= low.encode()) and (high is None or sort_text(c).encode() < high.encode())
        by_run: dict[str, list[tuple[int, int]]] = {}
        for at, (run, block) in enumerate(zip(group["run"].to_pylist(), group["block"].to_pylist(), strict=True)):
            by_run.setdefault(run, []).append((block, at))

        def captures(blocks: list[tuple[int, int]]) -> Iterator[tuple]:
            for _, at in sorted(blocks):
                for row in group["rows"][at].as_py():
                    capture = tuple(row[n] for n in names)
                    if inside(capture):
                        yield order(capture), capture

        merged = list(LoserTree([captures(b) for _, b in sorted(by_run.items())]))
        columns = list(zip(*merged, strict=True)) or [[] for _ in names]
        types = [pa.int64() if c.endswith("long") else pa.string() for c in CAPTURE.split(", ")]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.Table.from_arrays(
            [pa.array([part] * len(merged), pa.int32()), pa.array(range(len(merged)), pa.int32()), *arrays], ["part", "place", *names]
        )

    return dealt.groupBy("part").applyInArrow(merge, f"part int, place int, {CAPTURE}")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` names, read from the archives: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to, url, payload``.

    Captures near to one another in an archive are read by one task. The digest and length of
    a stored payload are computed from it and must match its headers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = place(folder)
        file, name = None, ""
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64).to_pylist()
                out = []
                for row in part:
                    if row["archive"] != name:
                        file, name = system.open_input_file(row["archive"]), row["archive"]
                    record = parsed(zlib.decompress(file.read_at(row["length"], row["offset"]), 31))
                    digest, size = record["WARC-Payload-Digest"].partition(":")[2], int(record["HTTP-Content-Length"])
                    if record["WARC-Type"] == "response":
                        found = hashlib.sha256(record["payload"]).hexdigest(), len(record["payload"])
                        if found != (digest, size):
                            raise ValueError(f"record at {row['offset']} of {name} does not match its headers")
                    number = lambda key: int(record[key]) if record.get(key) else None  # noqa: B023, E731
                    out.append((number("X-Page-Id"), size, digest, record["WARC-Type"], number("X-Refers-To-Page-Id"), record["WARC-Target-URI"], record["payload"]))
                columns = zip(*out, strict=True)
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"],
                )

    spread = index.withColumn("stretch", F.expr(f"offset DIV {1 << 20}")).repartition("archive", "stretch")
    return spread.sortWithinPartitions("archive", "offset").mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
    )


def archive(pages: DataFrame, folder: str | None = None, least: int = LEAST_REVISIT) -> tuple[DataFrame, str]:
    """Write ``page_id, url, html`` as archives; gives the merged index and the folder.

    A null html is an empty payload, a null url an empty address. Rows that repeat a page_id
    are records of their own; equal payloads under the same smallest page_id are all stored.
    An empty table gives an empty index. Other columns do not matter.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    runs = write_archives(planned(pages, least), folder)
    return materialize(merged_index(runs), "captures"), folder


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` and read every record back."""
    index, folder = archive(pages)
    return read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
