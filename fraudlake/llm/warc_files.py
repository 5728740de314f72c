"""WARC records and compressed index blocks as bytes, and their files in a shared folder."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left

from pyarrow import fs

LINES = 3000  # of an index block
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder (any that pyarrow opens) and the folder's path in it."""
    return fs.FileSystem.from_uri(uri) if re.match(r"[a-z][a-z0-9+.-]*:/", uri) else (fs.LocalFileSystem(), uri)


def member(data: bytes) -> bytes:
    """A gzip member of its own, equal for equal data."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record_id(page_id: int | None, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest.hex()}')}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A compressed record: a response with the payload, or a revisit of the one of ``refers_to``."""
    digest = hashlib.sha1(payload).digest()
    revisit = refers_to is not None
    block = HTTP % len(payload) + (b"" if revisit else payload)
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": "1970-01-01T00:00:00Z",  # pages have no date; equal input makes equal archives
        "WARC-Target-URI": None if url is None else re.sub(r"[\x00-\x20\x7f\x85  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(digest).decode(),
        "WARC-Profile": PROFILE if revisit else None,
        "WARC-Refers-To": record_id(refers_to, digest) if revisit else None,
        "X-Page-ID": page_id,
        "X-Refers-To-Page-ID": refers_to,
        "X-Payload-Length": len(payload),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return member(head.encode() + b"\r\n" + block + b"\r\n\r\n")


def read_record(data: bytes) -> dict:
    """The fields of one compressed record, checked against its payload."""
    raw = gzip.decompress(data)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not the start of a record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    revisit = fields["WARC-Type"] == "revisit"
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    if not revisit and hashlib.sha1(payload).digest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": number("X-Payload-Length") if revisit else len(payload),
        "payload_digest": digest.hex(),
        "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-ID"),
        "payload": None if revisit else payload,
    }


def index_key(surt: str, page_id: int | None) -> tuple:
    """Sorts as Spark sorts the two columns: by the bytes of the text, null ids first."""
    return surt.encode(), page_id is not None, page_id or 0


class IndexWriter:
    """One part of the index: compressed blocks of sorted lines, and a directory with a line per block."""

    def __init__(self, folder: str, name: str):
        self.store, self.path = open_folder(folder)
        self.name = name
        self.file = self.store.open_output_stream(f"{self.path}/{name}.cdx.gz", compression=None)
        self.lines: list[list] = []
        self.directory: list[list] = []
        self.at = 0

    def add(self, surt: str, page_id: int | None, file: str, offset: int, length: int) -> None:
        self.lines.append([surt, page_id, file, offset, length])
        if len(self.lines) == LINES:
            self.flush()

    def flush(self) -> None:
        if self.lines:
            data = member("\n".join(map(json.dumps, self.lines)).encode())
            self.file.write(data)
            self.directory.append([*self.lines[0][:2], self.at, len(data)])
            self.at += len(data)
            self.lines = []

    def close(self) -> None:
        self.flush()
        self.file.close()
        with self.store.open_output_stream(f"{self.path}/{self.name}.dir.gz", compression=None) as out:
            out.write(member("\n".join(map(json.dumps, self.directory)).encode()))


class IndexReader:
    """Looks keys up: part by its first key, block by the part's directory, line in the block.

    Holds one directory and one block, so keys in order read each of them once.
    """

    def __init__(self, folder: str, parts: list[tuple[tuple, str]]):
        self.store, self.path = open_folder(folder)
        self.starts = [key for key, _ in parts]
        self.names = [name for _, name in parts]
        self.part = self.block = None

    def load_part(self, name: str) -> None:
        if self.part == name:
            return
        with self.store.open_input_file(f"{self.path}/{name}.dir.gz") as file:
            rows = [json.loads(line) for line in gzip.decompress(file.read()).decode().split("\n")]
        self.part, self.block = name, None
        self.keys = [index_key(*r[:2]) for r in rows]
        self.ranges = [r[2:] for r in rows]
        self.file = self.store.open_input_file(f"{self.path}/{name}.cdx.gz")

    def load_block(self, number: int) -> None:
        if self.block != number:
            offset, length = self.ranges[number]
            raw = gzip.decompress(self.file.read_at(length, offset)).decode()
            self.lines = [json.loads(line) for line in raw.split("\n")]
            self.line_keys = [index_key(*line[:2]) for line in self.lines]
            self.block = number

    def find(self, surt: str, page_id: int | None) -> list[list]:
        """All lines of a key: equal keys are in one part, perhaps in several of its blocks."""
        key = index_key(surt, page_id)
        part = bisect_left(self.starts, key)
        if part == len(self.starts) or self.starts[part] != key:
            part -= 1
        if part < 0:
            return []
        self.load_part(self.names[part])
        found: list[list] = []
        number = max(0, bisect_left(self.keys, key) - 1)
        while number < len(self.keys) and self.keys[number] <= key:
            self.load_block(number)
            at = bisect_left(self.line_keys, key)
            while at < len(self.lines) and self.line_keys[at] == key:
                found.append(self.lines[at])
                at += 1
            number += 1
        return found
