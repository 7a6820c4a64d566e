"""WARC archives with a two-level capture index.

Archives: one gzip member per record, written by each task to files of its own in the shared folder; what counts
is the staged manifest of a finished write, so files of lost attempts are never read.

Index: captures sorted by reversed-host URL key, page id, payload digest, kind and row, over the whole table by range. Each task packs its
lines into compressed blocks and ends its file with the sparse directory of its blocks' first lines. A look-up
binary-searches the files' first lines, then the file's directory, then the block, and range-reads the record. Tasks
hold one directory and one block at a time.

Defined cases: a NULL html is an empty payload, a NULL url an empty one. Equal payloads of at least
``MIN_REVISIT`` bytes are stored once, in the record of the largest page id (a NULL id only if there is no
other); of repeated rows one is the response. Repeated rows are records each, and the look-ups of a manifest find
each by its row, so that a row repeated over a third of the table is spread over all tasks. An empty table gives an
archive without records.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import functions as F

from gaugewright.llm.common import BATCH_ROWS, map_batches, stage
from gaugewright.llm.exact_dedup import group_rows
from gaugewright.session import work_path

MIN_REVISIT = 1000
FILE_BYTES = 256 << 20
BLOCK_LINES = 500
LEVEL = 6
REMEMBERED = 4096
DATE = "2000-01-01T00:00:00Z"  # the tables hold no capture time
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def open_folder(uri):
    """(file system, path) of a folder by its URI, in any store that Arrow reaches."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def url_key(url):
    """The sort key of a URL: host labels reversed, then port, path and query; lower-case host, no scheme.

    That of the URL as records have it: urlsplit would drop tabs and line ends that it escapes.
    """
    url = _safe(url)
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url
    labels = ",".join(reversed(host.split("."))) if host else ""
    place = f":{port}" if port and port not in (80, 443) else ""
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return _safe(f"{labels}{place}){tail}")


def line_key(key, page_id, *more):
    """The index's order: URL key, then page id as text of fixed width, NULL first; then digest, kind and row.

    A space, which sorts before all else in them, ends each part but the last.
    """
    return " ".join((key, "-" if page_id is None else f"{page_id + (1 << 63):020d}", *more))


def record(kind, url, page_id, payload, digest, refers_to=None, refers_url=None, row=None):
    """The bytes of a WARC record with an HTTP response for its block; a revisit has headers only.

    Its id is that of the ``row``, so repeated rows have records of different ids.
    """
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if kind == "revisit" else http + payload
    identity = uuid.uuid5(uuid.NAMESPACE_URL, f"{row} {page_id} {url}")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{identity}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To-Target-URI: {refers_url}",
                  f"WARC-Refers-To-Date: {DATE}",
                  f"WARC-Refers-To-Page-ID: {'' if refers_to is None else refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data):
    """(headers, payload) of a record's bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[:int(headers["Content-Length"])]
    if len(rest) != len(block) + 4:
        raise ValueError("a WARC record of the wrong length")
    return headers, block.partition(b"\r\n\r\n")[2]


def _safe(url):
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url or "")


def decided(pages, min_bytes=MIN_REVISIT):
    """``pages`` (row, page_id, url, html), staged, with kind, refers_to and refers_url of each record.

    Heavy payloads are settled without a shuffle, as in exact dedup.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = stage(pages.select(
        "row", "page_id", "url", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size")), "digests")
    order = F.struct(F.col("page_id").isNull().alias("none"), F.bitwise_not("page_id").alias("last"), "row", "url")
    groups = group_rows(rows.where(F.col("size") >= min_bytes), "digest", order)
    revisits = groups.where("group_first.row <> row").select(
        "row", F.bitwise_not("group_first.last").alias("refers_to"), F.col("group_first.url").alias("refers_url"),
        F.lit("revisit").alias("kind"))
    return pages.join(stage(revisits, "revisits"), "row", "left")


def _writer(folder, file_bytes):
    def write(batches):
        filesystem, base = open_folder(folder)
        out, name, at = None, None, 0
        for batch in batches:
            columns = [[] for _ in range(8)]
            names = ("row", "page_id", "url", "html", "kind", "refers_to", "refers_url")
            for row, page_id, url, html, kind, refers_to, refers_url in zip(
                    *(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names)):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = filesystem.open_output_stream(f"{base}/{name}", compression=None)
                payload, kind = (html or "").encode(), kind or "response"
                digest = hashlib.sha1(payload)
                data = gzip.compress(
                    record(kind, _safe(url), page_id, payload, digest.digest(), refers_to, _safe(refers_url), row),
                    LEVEL, mtime=0)
                out.write(data)
                for column, value in zip(
                        columns, (url_key(url), page_id, row, name, at, len(data), kind, digest.hexdigest())):
                    column.append(value)
                at += len(data)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["key", "page_id", "row", "file", "offset", "length", "kind", "digest"])
        if out is not None:
            out.close()

    return write


def write_archive(pages, folder=None, page_id="page_id", url="url", html="html", file_bytes=FILE_BYTES):
    """Write a record per row; returns (folder, staged manifest: key, page_id, row, file, offset, length, kind, digest)."""
    folder = folder or work_path(pages.sparkSession, "warc")
    filesystem, base = open_folder(folder)
    filesystem.create_dir(base, recursive=True)
    slim = stage(pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"), F.col(html).alias("html")), "pages")
    manifest = map_batches(
        decided(slim), _writer(folder, file_bytes),
        "key string, page_id long, row long, file string, offset long, length long, kind string, digest string")
    return folder, stage(manifest, "manifest")


def _index_writer(folder, block_lines):
    """Sorted lines -> one index file per task; gives a row per file: first line, name, place of its directory."""

    def write(batches):
        filesystem, base = open_folder(folder)
        out, name, at, lines, directory = None, f"index-{uuid.uuid4().hex}.idx", 0, [], []

        def pack():
            nonlocal at
            block = zlib.compress("\n".join(lines).encode())
            out.write(block)
            directory.append((lines[0].split("\t", 1)[0], at, len(block)))
            at += len(block)
            lines.clear()

        for batch in batches:
            for key, page_id, digest, kind, row, file, offset, length in zip(*(
                    batch.column(batch.schema.get_field_index(c)).to_pylist()
                    for c in ("key", "page_id", "digest", "kind", "row", "file", "offset", "length"))):
                out = out or filesystem.open_output_stream(f"{base}/{name}", compression=None)
                lines.append("\t".join((line_key(key, page_id, digest, kind, f"{row:020d} "), file, str(offset), str(length), kind)))
                if len(lines) == block_lines:
                    pack()
        if out is None:
            return
        if lines:
            pack()
        tail = zlib.compress(json.dumps(directory).encode())
        out.write(tail)
        out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([directory[0][0]]), pa.array([name]), pa.array([at]), pa.array([len(tail)])],
            ["first", "file", "offset", "length"])

    return write


def build_index(folder, manifest, block_lines=BLOCK_LINES):
    """Write the index beside the archive; returns its root, (first, file, offset, length) for each index file.

    The root grows with the number of tasks, one per shuffle partition, not with the captures.
    """
    order = ("key", F.col("page_id").asc_nulls_first(), "digest", "kind", "row")
    lines = manifest.repartitionByRange(*order).sortWithinPartitions(*order)
    root = stage(map_batches(
        lines, _index_writer(folder, block_lines), "first string, file string, offset long, length long"), "index")
    return sorted(tuple(r) for r in root.collect())


class Captures:
    """Look-ups in an index, for one task."""

    def __init__(self, folder, root):
        self.filesystem, self.base = open_folder(folder)
        self.root, self.firsts = root, [r[0] for r in root]
        self.directory = (None, [], [])  # file, first lines, entries
        self.block = (None, [], [])      # place, keys, lines
        self.open_file = (None, None)
        self.payloads = {}

    def read(self, file, offset, length):
        if self.open_file[0] != file:
            if self.open_file[1] is not None:
                self.open_file[1].close()
            self.open_file = (file, self.filesystem.open_input_file(f"{self.base}/{file}"))
        return self.open_file[1].read_at(length, offset)

    def _directory(self, number):
        _, file, offset, length = self.root[number]
        if self.directory[0] != file:
            entries = json.loads(zlib.decompress(self.read(file, offset, length)))
            self.directory = (file, [e[0] for e in entries], entries)
        return self.directory

    def _block(self, file, entry):
        place = (file, entry[1])
        if self.block[0] != place:
            lines = zlib.decompress(self.read(file, entry[1], entry[2])).decode().split("\n")
            self.block = (place, [line.split("\t", 1)[0] for line in lines], lines)
        return self.block

    def find(self, key, page_id, *more):
        """The index lines of a URL key and page id, or of a digest, a kind and a row under them: (archive file, offset,
        length, kind). The responses of a digest come before its revisits.
        """
        wanted = line_key(key, page_id, *more) + " "
        beyond = wanted[:-1] + "!"                    # the character after the space
        # Lines that start with it may begin in the block, or the file, before the first one that does.
        number = max(0, bisect.bisect_left(self.firsts, wanted) - 1)
        while number < len(self.root) and self.firsts[number] < beyond:
            file, firsts, entries = self._directory(number)
            at = max(0, bisect.bisect_left(firsts, wanted) - 1)
            while at < len(entries) and firsts[at] < beyond:
                _, keys, lines = self._block(file, entries[at])
                i = bisect.bisect_left(keys, wanted)
                while i < len(keys) and keys[i] < beyond:
                    _, archive, offset, length, kind = lines[i].split("\t")
                    yield archive, int(offset), int(length), kind
                    i += 1
                if i < len(keys):
                    return
                at += 1
            number += 1

    def load(self, capture):
        """(headers, payload) of a capture, from a range read of its archive."""
        archive, offset, length, _ = capture
        return parse_record(gzip.decompress(self.read(archive, offset, length)))

    def measured(self, key, page_id, digest):
        """Bytes and SHA-1 of the payload of the response with a digest under a key; the last few are remembered.

        A page id may be NULL or repeated, so its key may have responses of other payloads.
        """
        known = self.payloads.get((key, page_id, digest))
        if known is None:
            capture = next(self.find(key, page_id, digest), None)
            if capture is None or capture[3] != "response":
                raise KeyError(f"no response for {key} {page_id} {digest}")
            payload = self.load(capture)[1]
            known = (len(payload), hashlib.sha1(payload).hexdigest())
            if len(self.payloads) >= REMEMBERED:
                self.payloads.clear()
            self.payloads[key, page_id, digest] = known
        return known


def _captures(folder, root):
    """Keys -> captures: page_id, url, kind, payload bytes and digest, and what a revisit refers to."""

    def look_up(batches):
        captures = Captures(folder, root)
        for batch in batches:
            wanted = zip(*(column.to_pylist() for column in batch.columns))
            found = (capture for key, page_id, *more in wanted for capture in captures.find(
                key, page_id, *(f"{m:020d}" if isinstance(m, int) else m for m in more)))
            while places := list(islice(found, BATCH_ROWS)):
                yield read_back(captures, places)

    def read_back(captures, places):
        out = [[] for _ in range(6)]
        for capture in sorted(places):  # archives are read forward
            headers, payload = captures.load(capture)
            page_id, refers_to = headers["WARC-Page-ID"], None
            stated = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            if headers["WARC-Type"] == "revisit":
                of = headers["WARC-Refers-To-Page-ID"]
                refers_to = int(of) if of else None
                measured = captures.measured(url_key(headers["WARC-Refers-To-Target-URI"]), refers_to, stated)
            else:
                measured = (len(payload), hashlib.sha1(payload).hexdigest())
            if stated != measured[1]:
                raise ValueError(f"payload digest of page {page_id} does not hold")
            row = (int(page_id) if page_id else None, headers["WARC-Target-URI"], *measured,
                   headers["WARC-Type"], refers_to)
            for column, value in zip(out, row):
                column.append(value)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds)],
            ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return look_up


def look_up(keys, folder, root):
    """All captures of the rows (key, page_id) of ``keys``, or, if ``keys`` are rows of a manifest, the capture of each,
    read back and verified. Sorted keys share blocks."""
    more = ["digest", "kind", "row"] if {"digest", "kind", "row"} <= set(keys.columns) else []
    order = ["key", F.col("page_id").asc_nulls_first(), *more]
    sorted_keys = (
        keys.select("key", "page_id", *more).distinct().repartitionByRange(*order).sortWithinPartitions(*order))
    return map_batches(
        sorted_keys, _captures(folder, root),
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_and_read_back(pages, folder=None, page_id="page_id", url="url", html="html"):
    """Archive ``pages``, index the archive, and read every capture back through the index."""
    folder, manifest = write_archive(pages, folder, page_id, url, html)
    return look_up(manifest, folder, build_index(folder, manifest))
