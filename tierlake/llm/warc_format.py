"""WARC/1.1 records as bytes: framing, segments and chunked bodies."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

END = b"\r\n\r\n"
SEGMENT_BYTES = 32_768
CHUNK_BYTES = 8_192
DATE = "2000-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


class Damaged(ValueError):
    """Bytes that don't follow the format, or contradict their own lengths or digests."""


def sha1(data: bytes) -> str:
    """Bare lower-case hex digest."""
    return hashlib.sha1(data, usedforsecurity=False).hexdigest()


def record_id(page_id: int | None, digest: str) -> str:
    """Identifier of a page's first record: equal for repeated rows, which are equal records."""
    return "<urn:uuid:{}>".format(uuid.uuid5(uuid.NAMESPACE_URL, "{}|{}".format(page_id, digest)))


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A body in HTTP's chunked transfer coding."""
    parts = []
    for at in range(0, len(body), size):
        part = body[at : at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(data: bytes) -> bytes:
    """The body of a chunked transfer coding; chunk extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        if end < 0:
            raise Damaged("A chunk has no size")
        try:
            size = int(data[at:end].split(b";")[0], 16)
        except ValueError as error:
            raise Damaged("A chunk's size can't be read") from error
        at = end + 2
        if not size:
            return b"".join(parts)
        if data[at + size : at + size + 2] != b"\r\n":
            raise Damaged("A chunk is shorter or longer than its size")
        parts.append(data[at : at + size])
        at += size + 2


def _record(block: bytes, **fields: object) -> bytes:
    lines = ["WARC/1.1"]
    fields |= {"WARC-Block-Digest": "sha1:" + sha1(block), "Content-Length": len(block)}
    lines += ["{}: {}".format(k, str(v).replace("\r", " ").replace("\n", " ")) for k, v in fields.items() if v is not None]
    return "\r\n".join(lines).encode("utf-8") + END + block


def page_records(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, limit: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """A page's records without the blank lines behind them: one, or one and its continuations if the block is over ``limit``.

    A page that repeats another's payload becomes a revisit, whose HTTP head tells the length of the body it leaves out.
    """
    digest = sha1(payload)
    first = record_id(page_id, digest)
    common = {
        "WARC-Record-ID": first,
        "WARC-Date": DATE,
        "WARC-Target-URI": url or "about:blank",
        "X-Page-ID": page_id,
        "WARC-Payload-Digest": "sha1:" + digest,
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        head = _HTTP + b"Content-Length: %d\r\n\r\n" % len(payload)
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        more = {"WARC-Profile": profile, "WARC-Refers-To": record_id(refers_to, digest), "X-Refers-To-Page-ID": refers_to}
        yield _record(head, **{"WARC-Type": "revisit"}, **common, **more)
        return
    block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= limit:
        yield _record(block, **{"WARC-Type": "response"}, **common)
        return
    yield _record(block[:limit], **{"WARC-Type": "response"}, **common, **{"WARC-Segment-Number": 1})
    for number, at in enumerate(range(limit, len(block), limit), 2):
        fields = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": "<urn:uuid:{}>".format(uuid.uuid5(uuid.NAMESPACE_URL, "{}|{}".format(first, number))),
            "WARC-Date": DATE,
            "WARC-Segment-Origin-ID": first,
            "WARC-Segment-Number": number,
            "WARC-Segment-Total-Length": len(block) if at + limit >= len(block) else None,
        }
        yield _record(block[at : at + limit], **fields)


def read_records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of an archive."""
    at = 0
    while at < len(archive):
        end = archive.find(END, at)
        if end < 0 or not archive.startswith(b"WARC/", at):
            raise Damaged("No record begins at byte {}".format(at))
        lines = archive[at:end].decode("utf-8").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start = end + len(END)
        stop = start + int(headers.get("content-length", -1))
        block = archive[start:stop]
        if stop < start or archive[stop : stop + len(END)] != END:
            raise Damaged("A record's length is wrong")
        if headers.get("warc-block-digest", "").removeprefix("sha1:") not in ("", sha1(block)):
            raise Damaged("A block doesn't have its digest")
        yield headers, block
        at = stop + len(END)


def payload_of(block: bytes) -> tuple[bytes, int | None]:
    """Body of an HTTP message and the length its head states, if it does."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise Damaged("No HTTP head")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
    if b"chunked" in fields.get(b"transfer-encoding", b"").lower():
        return dechunked(body), None
    return body, int(fields[b"content-length"]) if b"content-length" in fields else None
