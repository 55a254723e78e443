"""Media columns in Ogg: a writer and a reader of multiplexed pages.

The writer stores a payload as 8-bit samples of two channels in turn. Each channel is a logical stream whose first packet
describes the samples; the pages of both take turns, and a packet that does not fit in a page goes on in the next one. The
reader verifies every page's checksum, reassembles packets from lacing values, separates the logical streams by serial
number, derives times from granule positions and joins the channels that cover the same time.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

FRAME, RATE, CHANNELS = 576, 8000, 2
#: Lacing values in a page; about 4 kB, as is usual.
PAGE_LACINGS = 17
#: Fixed values of the container: capture pattern, header flags, largest number of lacing values in a page.
CAPTURE, CONTINUED, FIRST, LAST, LACINGS = b"OggS", 1, 2, 4, 255
MAGIC = b"PCM8\x02\x00"
_MIRROR = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def checksum(data: bytes) -> int:
    """CRC-32 with polynomial 0x04c11db7, most significant bit first, start and end value 0.

    zlib's CRC is the mirror image of it: mirrored bytes go in, a mirrored value comes out.
    """
    x = zlib.crc32(data.translate(_MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(x.to_bytes(4, "little").translate(_MIRROR), "big")


def page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = struct.pack("<4sBBqIIIB", CAPTURE, 0, flags, granule, serial, number, 0, len(lacing)) + lacing
    return head[:22] + struct.pack("<I", checksum(head + body)) + head[26:] + body


def write_stream(payload: bytes, rate: int = RATE, frame: int = FRAME, serial: int | None = None, channel: int = 0, channels: int = 1, lacings: int = PAGE_LACINGS) -> list[bytes]:
    """The pages of one logical stream of 8-bit samples; the serial number follows from the payload unless given."""
    serial = zlib.crc32(payload) if serial is None else serial
    first = MAGIC + struct.pack("<IIQBB", rate, frame, len(payload), channel, channels)
    pages = [page(FIRST, 0, serial, 0, bytes([len(first)]), first)]
    whole, rest = divmod(len(payload), frame)
    every = bytes([255] * (frame // 255) + [frame % 255]) * whole + (bytes([255] * (rest // 255) + [rest % 255]) if rest else b"")
    at = done = 0
    for k in range(0, len(every), lacings):
        lacing, flags = every[k : k + lacings], CONTINUED * (k > 0 and every[k - 1] == 255)
        closed = len(lacing) - lacing.count(255)  # packets that end in this page
        done += closed
        size = sum(lacing)
        flags |= LAST * (k + lacings >= len(every))
        pages.append(page(flags, min(done * frame, len(payload)) if closed else -1, serial, len(pages), lacing, payload[at : at + size]))
        at += size
    if len(pages) == 1:
        pages.append(page(LAST, 0, serial, 1, b"", b""))
    return pages


def write_channels(payload: bytes, channels: int = CHANNELS, frame: int = FRAME) -> bytes:
    """A file of one logical stream for each channel; sample k belongs to channel k modulo their number."""
    serial = zlib.crc32(payload)
    return multiplex(*(write_stream(payload[c::channels], frame=frame // channels, serial=(serial + c) & 0xFFFFFFFF, channel=c, channels=channels) for c in range(channels)))


def multiplex(*streams: list[bytes]) -> bytes:
    """Interleave the pages of logical streams: all first pages, then the others in turn."""
    out = [s[0] for s in streams if s]
    for k in range(1, max(map(len, streams), default=0)):
        out += [s[k] for s in streams if k < len(s)]
    return b"".join(out)


def read_pages(data: bytes) -> Iterator[tuple[int, int, int, int, bytes, bytes]]:
    """(flags, granule, serial, number, lacing, body) of each page; raises ValueError on anything damaged."""
    at = 0
    while at < len(data):
        if len(data) - at < 27 or data[at : at + 4] != CAPTURE or data[at + 4] != 0:
            raise ValueError(f"no page at byte {at}")
        flags, granule, serial, number, said, n = struct.unpack_from("<BqIIIB", data, at + 5)
        lacing = data[at + 27 : at + 27 + n]
        start = at + 27 + n
        end = start + sum(lacing)
        if end > len(data) or len(lacing) < n:
            raise ValueError(f"page at byte {at} is cut short")
        if checksum(data[at : at + 22] + bytes(4) + data[at + 26 : end]) != said:
            raise ValueError(f"page at byte {at} has a wrong checksum")
        yield flags, granule, serial, number, lacing, data[start:end]
        at = end


def demultiplex(data: bytes) -> dict[int, dict]:
    """By serial number: packets, the granule position known at each packet (or None), and the number of pages."""
    streams: dict[int, dict] = {}
    for flags, granule, serial, number, lacing, body in read_pages(data):
        if flags & FIRST:
            if serial in streams:
                raise ValueError(f"stream {serial} starts twice")
            streams[serial] = {"packets": [], "granules": [], "pages": 0, "part": None, "ended": False}
        s = streams.get(serial)
        if s is None or s["ended"] or number != s["pages"]:
            raise ValueError(f"page {number} of stream {serial} is out of order")
        if bool(flags & CONTINUED) != (s["part"] is not None):
            raise ValueError(f"page {number} of stream {serial} continues no packet")
        at, size, part, before = 0, 0, s["part"] or b"", len(s["packets"])
        for k, x in enumerate(lacing):
            size += x
            if x < 255:
                s["packets"].append(part + body[at : at + size])
                s["granules"].append(None)
                part, at, size = b"", at + size, 0
        open_ = bool(lacing) and lacing[-1] == 255 or not lacing and s["part"] is not None
        s["part"] = part + body[at:] if open_ else None
        if granule >= 0 and len(s["packets"]) > before:
            s["granules"][-1] = granule
        s["pages"] += 1
        s["ended"] = bool(flags & LAST)
    for serial, s in streams.items():
        if not s["ended"] or s["part"] is not None:
            raise ValueError(f"stream {serial} does not end")
    return streams


def packet_ends(sizes: np.ndarray, granules: list[int | None]) -> np.ndarray:
    """The sample position at each packet's end: backwards from the granule position of its page, onwards where none follows."""
    ends = np.zeros(len(sizes), np.int64)
    known = [k for k, g in enumerate(granules) if g is not None]
    for k in range(len(sizes) - 1, -1, -1):
        if granules[k] is not None:
            ends[k] = granules[k]
        elif k + 1 < len(sizes):
            ends[k] = ends[k + 1] - sizes[k + 1]
    rest = known[-1] + 1 if known else 0
    ends[rest:] = (ends[rest - 1] if rest else 0) + np.cumsum(sizes[rest:])
    return ends


def read_samples(data: bytes) -> list[dict]:
    """Each sample stream of a file: payload, rate, sizes of packets, start time in seconds of each from its page's granule position, pages.

    A stream may begin at any position and leave out time between packets; packets that overlap are damage.
    """
    out = []
    for serial, s in sorted(demultiplex(data).items()):
        first = s["packets"][0]
        if not first.startswith(MAGIC):
            continue
        rate, frame, total, channel, channels = struct.unpack_from("<IIQBB", first, len(MAGIC))
        packets = s["packets"][1:]
        sizes = np.array([len(p) for p in packets], np.int64)
        ends = packet_ends(sizes, s["granules"][1:])
        begin = ends - sizes
        if (begin < np.concatenate([[0], ends[:-1]])[: len(begin)]).any():
            raise ValueError(f"stream {serial} has more samples than its granule positions have room for")
        payload = b"".join(packets)
        if len(payload) != total:
            raise ValueError(f"stream {serial} has {len(payload)} of {total} samples")
        out.append({"serial": serial, "rate": rate, "frame": frame, "payload": payload, "sizes": sizes, "begin": begin, "starts": begin / rate, "pages": s["pages"], "channel": channel, "channels": channels})
    return out


def join_channels(streams: list[dict]) -> dict:
    """The streams of one file as one: payload with the channels' samples in turn, their common times, pages of all."""
    if not streams:
        raise ValueError("no sample stream")
    first, *others = streams = sorted(streams, key=lambda s: s["channel"])
    if [s["channel"] for s in streams] != list(range(first["channels"])):
        raise ValueError(f"channels {[s['channel'] for s in streams]} of {first['channels']}")
    for s in others:
        if s["rate"] != first["rate"] or not np.array_equal(s["begin"], first["begin"]) or not np.array_equal(s["sizes"], first["sizes"]):
            raise ValueError(f"channel {s['channel']} covers other times than channel 0")
    payload = np.stack([np.frombuffer(s["payload"], np.uint8) for s in streams], axis=1).tobytes()
    return first | {"payload": payload, "pages": sum(s["pages"] for s in streams)}


def describe(payload: bytes, rate: int, pages: int, sizes: np.ndarray, begin: np.ndarray, frame: int = FRAME, channels: int = 1) -> str:
    """Duration, pages, mean level, loudest frame and sign changes of 8-bit samples; times follow the packets' positions.

    sizes, begin and frame are those of one channel's packets; of equally loud frames the first counts.
    """
    if not payload:
        return f"dur=0.000;pages={pages};mean=0.0000;peak=0@0.000;zc=0"
    x = np.frombuffer(payload, np.uint8)
    sums = np.add.reduceat(x.astype(np.uint32), np.arange(0, len(x), frame * channels))
    loud = int(sums.argmax())
    over = x >= 128
    offsets = np.cumsum(sizes) - sizes
    k = int(np.searchsorted(offsets, loud * frame, "right")) - 1
    peak = int(begin[k]) + loud * frame - int(offsets[k])
    samples = int(begin[-1] + sizes[-1] - begin[0])
    return f"dur={samples / rate:.3f};pages={pages};mean={x.mean(dtype=np.float64):.4f};peak={int(sums[loud])}@{peak / rate:.3f};zc={int(np.count_nonzero(over[1:] != over[:-1]))}"


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: the text's bytes as an Ogg file of two channels, filled with bytes 255 to a multiple of 576.

    A null text counts as empty (one frame of bytes 255); a null id is carried; repeated rows give equal files; an empty
    table gives no rows; other columns are ignored; very long texts have as many pages as they need.
    """
    common.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows // 32)
            for at in range(0, batch.num_rows, step):
                ids, sizes, media = batch.column(0)[at : at + step], [], []
                for text in batch.column(1)[at : at + step]:
                    raw = (text.as_py() or "").encode()
                    sizes.append(len(raw))
                    raw += b"\xff" * (max(FRAME, -(-len(raw) // FRAME) * FRAME) - len(raw))
                    media.append(write_channels(raw))
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def decode_media(files: DataFrame, media_col: str = "media") -> DataFrame:
    """The input's columns, then payload (all channels of each file), feature and error.

    A null or damaged file gives a null payload and the reason in error, so one bad file does not stop a job. Repeated
    rows are read alike, an empty table gives no rows, a file is read whole, however long; columns of the added names are
    refused.
    """
    common.ship(files.sparkSession)
    names, schema = files.columns, files.schema
    at = names.index(media_col)
    if clash := {"payload", "feature", "error"} & set(names):
        raise ValueError(f"columns {sorted(clash)} exist already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads, features, errors = [], [], []
            for x in batch.column(at):
                try:
                    if not x.is_valid:
                        raise ValueError("no file")
                    s = join_channels(read_samples(x.as_py()))
                    payloads.append(s["payload"])
                    features.append(describe(s["payload"], s["rate"], s["pages"], s["sizes"], s["begin"], s["frame"], s["channels"]))
                    errors.append(None)
                except (ValueError, struct.error, IndexError) as e:
                    payloads.append(None)
                    features.append(None)
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(payloads, pa.binary()), pa.array(features, pa.string()), pa.array(errors, pa.string())], [*names, "payload", "feature", "error"])

    return files.mapInArrow(run, T.StructType([*schema.fields, *(T.StructField(c, t) for c, t in (("payload", T.BinaryType()), ("feature", T.StringType()), ("error", T.StringType())))]))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = decode_media(encode_media(common.table(spark, sf_dir, "documents")))
    return read.select(
        "doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -32, 32)")).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature",
    )
