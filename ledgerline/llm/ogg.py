"""Ogg columns: texts stored as 8-bit samples in Ogg pages, and the reader that gets them back.

The writer interleaves two logical streams page by page: samples, and a head stream that begins with a packet of
metadata and has a packet with a checksum of the samples for each of their pages. The reader verifies each page's
checksum, reassembles packets from the lacing values across pages, separates the streams by serial number and
derives every packet's time: a page's granule position is where its last whole packet ends, and the samples of
that packet and of those before it lead back from there.

Defined cases: a null text is stored as an empty one (64 zero samples); equal texts give equal values;
repeated rows each give a row; the length of a text is not limited; an empty table gives an empty
result; other columns are ignored. read_ogg raises ValueError at a page whose checksum or sequence is wrong;
read_media gives such a row, as one without media, a null payload and the reason as `error`.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, utf8

RATE, PACKET, BLOCK = 8000, 4000, 64
CONTINUED, FIRST, LAST = 1, 2, 4
HEAD = struct.Struct("<4sBBqIIIB")
MIRROR = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def page_checksum(page: bytes) -> int:
    """CRC-32 of polynomial 0x04c11db7 from zero, highest bit first.

    zlib has the same polynomial lowest bit first: mirrored bytes go in, a mirrored register comes out.
    """
    register = zlib.crc32(page.translate(MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(register.to_bytes(4, "little").translate(MIRROR), "big")


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % BLOCK or (0 if data else BLOCK))


def page(serial: int, sequence: int, flags: int, granule: int, lacing: bytes, body: bytes) -> bytes:
    head = HEAD.pack(b"OggS", 0, flags, granule, serial, sequence, 0, len(lacing)) + lacing
    check = page_checksum(head + body)
    return head[:22] + struct.pack("<I", check) + head[26:] + body


def stream_pages(serial: int, packets: list[tuple[bytes, int]]) -> list[bytes]:
    """Pages of one logical stream from (packet, granule at its end); a page holds 255 segments at most."""
    lacing, bodies, ends, granules = bytearray(), [], {}, {}
    for packet, granule in packets:
        lacing += b"\xff" * (len(packet) // 255) + bytes([len(packet) % 255])
        bodies.append(packet)
        ends[len(lacing)] = granule
    body = b"".join(bodies)
    pages, offset = [], 0
    marks = sorted(ends)
    for k, start in enumerate(range(0, len(lacing), 255)):
        part = bytes(lacing[start : start + 255])
        while marks and marks[0] <= start + len(part):
            granules[k] = ends[marks.pop(0)]
        flags = (CONTINUED if start and lacing[start - 1] == 255 else 0) | (FIRST if k == 0 else 0) | (LAST if start + 255 >= len(lacing) else 0)
        pages.append(page(serial, k, flags, granules.get(k, -1), part, body[offset : offset + sum(part)]))
        offset += sum(part)
    return pages


def page_end(one: bytes) -> int:
    return HEAD.unpack_from(one)[3]


def write_ogg(payload: bytes) -> bytes:
    serial = zlib.crc32(payload) & 0x7FFFFFFE
    samples = [(payload[i : i + PACKET], min(i + PACKET, len(payload))) for i in range(0, len(payload), PACKET)]
    data = stream_pages(serial, samples)
    head = b"pcm8head" + struct.pack("<IQI", RATE, len(payload), PACKET)
    # a mark goes up to where the last whole packet of its page of samples ends; pages without one have no mark
    out, first, marks, done = [], data[0], [], 0
    ends = [page_end(p) for p in data]
    for end in ends:
        if end >= 0:
            marks.append((b"pcm8mark" + struct.pack("<QI", end, zlib.crc32(payload[done:end])), end))
            done = end
    # one page for each packet of the head stream, numbered and flagged as a stream
    heads = [page(serial + 1, k, (FIRST if k == 0 else 0) | (LAST if k == len(marks) else 0), end, bytes([len(packet)]), packet) for k, (packet, end) in enumerate([(head, 0), *marks])]
    out, number = [heads[0], first], 1  # each stream's first page comes before any other page
    for k, one in enumerate(data):
        if k:
            out.append(one)
        if ends[k] >= 0:
            out.append(heads[number])
            number += 1
    return b"".join(out)


@dataclass
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    times: list[float | None] = field(default_factory=list)
    pages: int = 0
    part: bytes | None = None
    ended: bool = False


def read_ogg(data: bytes) -> dict[int, Stream]:
    """Logical streams by serial number, with the seconds at which each packet ends; null where no page says so."""
    streams: dict[int, Stream] = {}
    at = 0
    while at < len(data):
        if len(data) < at + HEAD.size:
            raise ValueError("a page is cut off")
        mark, version, flags, granule, serial, sequence, check, n = HEAD.unpack_from(data, at)
        body_at = at + HEAD.size + n
        lacing = data[at + HEAD.size : body_at]
        end = body_at + sum(lacing)
        if mark != b"OggS" or version or len(data) < end or page_checksum(data[at : at + 22] + bytes(4) + data[at + 26 : end]) != check:
            raise ValueError(f"the page at byte {at} is damaged")
        if flags & FIRST:
            if serial in streams:
                raise ValueError(f"stream {serial} begins twice")
            streams[serial] = Stream(serial)
        stream = streams.get(serial)
        if stream is None or stream.ended or stream.pages != sequence or bool(flags & CONTINUED) != (stream.part is not None):
            raise ValueError(f"page {sequence} of stream {serial} is out of order")
        packet, at, before = stream.part, body_at, len(stream.packets)
        for size in lacing:
            packet = (packet or b"") + data[at : at + size]
            at += size
            if size < 255:
                stream.packets.append(packet)
                stream.times.append(None)
                packet = None
        if len(stream.packets) > before and granule >= 0:
            end, sound = granule, not stream.packets[0].startswith(b"pcm8head")
            for k in range(len(stream.packets) - 1, before - 1, -1):
                stream.times[k] = end / RATE
                end -= len(stream.packets[k]) if sound else 0
        stream.part, stream.pages, stream.ended = packet, stream.pages + 1, bool(flags & LAST)
    return streams


def features(streams: dict[int, Stream], payload: bytes) -> str:
    samples = np.frombuffer(payload, np.uint8)
    centred = samples.astype(np.int16) - 128
    sound = next(s for s in streams.values() if not s.packets[0].startswith(b"pcm8head"))
    crossings = int(np.count_nonzero(np.diff(np.signbit(centred))))
    return (
        f"streams={len(streams)};pages={sum(s.pages for s in streams.values())};packets={len(sound.packets)};seconds={sound.times[-1]:.4f};"
        f"mean={samples.mean():.3f};rms={float(np.sqrt(np.square(centred, dtype=np.int32).mean())):.3f};peak={int(samples.max())};crossings={crossings}"
    )


def stored_payload(streams: dict[int, Stream]) -> bytes:
    """The samples of the stream that has no metadata head."""
    heads = [s for s in streams.values() if s.packets and s.packets[0].startswith(b"pcm8head")]
    sounds = [s for s in streams.values() if s not in heads]
    if len(heads) != 1 or len(sounds) != 1:
        raise ValueError("one head and one sample stream are expected")
    payload, (head, *marks) = b"".join(sounds[0].packets), heads[0].packets
    if struct.unpack_from("<IQ", head, 8) != (RATE, len(payload)):
        raise ValueError("the head does not fit the samples")
    done = 0
    for mark in marks:
        end, check = struct.unpack_from("<QI", mark, 8)
        if zlib.crc32(payload[done:end]) != check:
            raise ValueError(f"the samples up to {end} do not fit their mark")
        done = end
    if done != len(payload) or not all(s.ended and s.part is None for s in streams.values()):
        raise ValueError("a stream is cut off")
    return payload


def write_media(docs: DataFrame) -> DataFrame:
    """doc_id and media binary: each text as an Ogg file."""

    def batch(columns: dict[str, list]) -> dict[str, object]:
        return {"doc_id": pa.array(columns["doc_id"], pa.int64()), "media": pa.array([write_ogg(padded(utf8(t))) for t in columns["text"]], pa.binary())}

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), batch, "doc_id long, media binary")


def read_media(stored: DataFrame) -> DataFrame:
    """doc_id, payload, packets, seconds and error of each row's `media`."""

    def one(media: bytes | None) -> tuple:
        if media is None:
            return None, None, None, "no media"
        try:
            streams = read_ogg(media)
            payload = stored_payload(streams)
        except (ValueError, struct.error, IndexError) as e:
            return None, None, None, str(e)
        sound = next(s for s in streams.values() if not s.packets[0].startswith(b"pcm8head"))
        return payload, len(sound.packets), sound.times[-1], None

    def batch(columns: dict[str, list]) -> dict[str, object]:
        payload, packets, seconds, error = zip(*map(one, columns["media"]), strict=True)
        return {"doc_id": pa.array(columns["doc_id"], pa.int64()), "payload": pa.array(payload, pa.binary()), "packets": pa.array(packets, pa.int64()), "seconds": pa.array(seconds, pa.float64()), "error": pa.array(error, pa.string())}

    return map_batches(stored.selectExpr("cast(doc_id as long) doc_id", "media"), batch, "doc_id long, payload binary, packets long, seconds double, error string")


def media_digests(docs: DataFrame) -> DataFrame:
    """Store each text, read the stored bytes back, and describe both forms."""

    def one(text: str | None) -> tuple:
        data = utf8(text)
        media = write_ogg(padded(data))
        streams = read_ogg(media)
        payload = stored_payload(streams)
        return len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(media), hashlib.sha256(media).hexdigest(), features(streams, payload)

    def batch(columns: dict[str, list]) -> dict[str, object]:
        names = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
        values = zip(*map(one, columns["text"]), strict=True)
        return {"doc_id": pa.array(columns["doc_id"], pa.int64())} | {n: list(v) for n, v in zip(names, values, strict=True)}

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), batch, schema)
