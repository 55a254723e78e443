import hashlib
import struct
import zlib

import pytest

from attestra.llm import media


def slow_crc(data):
    crc = 0
    for b in data:
        crc ^= b << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc >> 31 else crc << 1) & 0xFFFFFFFF
    return crc


def test_checksum_equals_bitwise_form(rng):
    for n in (0, 1, 2, 27, 300):
        data = rng.randbytes(n)
        assert media.checksum(data) == slow_crc(data)


def test_streams_round_trip_and_interleave(rng):
    for n in (0, 1, 255, 575, 576, 577, 576 * 86 + 5):
        a, b = rng.randbytes(n), rng.randbytes(n // 2 + 3)
        data = media.multiplex(media.write_stream(a, serial=1), media.write_stream(b, rate=16000, serial=2))
        first, second = media.read_samples(data)
        assert first["payload"] == a and second["payload"] == b
        assert first["starts"].tolist() == [k * 576 / 8000 for k in range(-(-n // 576))]


def test_packets_across_pages_and_damage():
    big = bytes(range(256)) * 300
    one, rest = big[: 255 * 255], big[255 * 255 :]
    tail = bytes([255] * (len(rest) // 255) + [len(rest) % 255])
    pages = [media.page(media.FIRST, 0, 9, 0, bytes([4]), b"head"), media.page(0, -1, 9, 1, bytes([255] * 255), one), media.page(media.CONTINUED | media.LAST, 5, 9, 2, tail, rest)]
    s = media.demultiplex(b"".join(pages))[9]
    assert s["packets"] == [b"head", big] and s["granules"] == [0, 5]
    good = media.multiplex(media.write_stream(b"x" * 2000))
    for bad in (good[:-1], good[1:], good[:100] + bytes([good[100] ^ 1]) + good[101:], b"".join(pages[:2]), b"".join([pages[0], pages[2]])):
        with pytest.raises(ValueError):
            media.demultiplex(bad)


def test_times_follow_granule_positions(spark):
    loud = bytes([1]) * 1152 + bytes([255]) * 576

    def stream(*ends):
        head = media.MAGIC + media.struct.pack("<IIQBB", 8000, 576, 1728, 0, 1)
        packet = bytes([255, 255, 66])
        bodies = [(packet * 2, loud[:1152]), (packet, loud[1152:])]
        pages = [media.page(media.FIRST, 0, 5, 0, bytes([len(head)]), head)]
        return b"".join(pages + [media.page(media.LAST * k, end, 5, k + 1, *x) for k, (end, x) in enumerate(zip(ends, bodies, strict=True))])

    for first, second, starts, dur, peak in ((1152, 1728, [0, 576, 1152], "0.216", "0.144"), (9152, 9728, [8000, 8576, 9152], "0.216", "1.144"), (9152, 17728, [8000, 8576, 17152], "1.216", "2.144")):
        data = stream(first, second)
        assert media.read_samples(data)[0]["starts"].tolist() == [x / 8000 for x in starts]
        row = media.decode_media(spark.createDataFrame([(1, data)], "doc_id long, media binary")).first()
        assert row.error is None and bytes(row.payload) == loud and f"dur={dur};" in row.feature and f"@{peak};" in row.feature
    for bad in (stream(1000, 1728), stream(1152, 1700)):
        with pytest.raises(ValueError):
            media.read_samples(bad)


def test_edges(spark, edge_docs, no_docs):
    read = media.decode_media(media.encode_media(edge_docs)).collect()
    want = {}
    for r in edge_docs.collect():
        raw = (r.text or "").encode()
        want.setdefault(r.doc_id, set()).add(raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw)))
    assert len(read) == edge_docs.count() and all(r.error is None and bytes(r.payload) in want[r.doc_id] for r in read)
    assert media.decode_media(media.encode_media(no_docs)).count() == 0
    bad = media.decode_media(spark.createDataFrame([(1, None), (2, b"junk"), (3, b"")], "doc_id long, media binary")).collect()
    assert all(r.payload is None and r.error for r in bad)
    with pytest.raises(ValueError):
        media.decode_media(spark.createDataFrame([(1, b"", "x")], "doc_id long, media binary, error string"))


def slow_file(payload):
    """The stored form byte by byte: two channels, lacing values one at a time, bitwise checksums."""
    serial, streams = zlib.crc32(payload), []
    for c in (0, 1):
        samples = bytes(b for k, b in enumerate(payload) if k % 2 == c)
        cells = []  # (lacing value, bytes, whether a packet ends here)
        for at in range(0, len(samples), 288):
            packet = samples[at : at + 288]
            while len(packet) >= 255:
                cells.append((255, packet[:255], None))
                packet = packet[255:]
            cells.append((len(packet), packet, min(at + 288, len(samples))))
        head = b"PCM8\x02\x00" + struct.pack("<IIQBB", 8000, 288, len(samples), c, 2)
        pages = [(2, 0, [len(head)], head)]
        for k in range(0, len(cells), 17):
            part = cells[k : k + 17]
            ends = [e for *_, e in part if e is not None]
            pages.append(((1 if k and cells[k - 1][0] == 255 else 0) | (4 if k + 17 >= len(cells) else 0), ends[-1] if ends else -1, [n for n, *_ in part], b"".join(b for _, b, _ in part)))
        out = []
        for number, (flags, granule, lacing, body) in enumerate(pages):
            raw = b"OggS" + struct.pack("<BBqIIIB", 0, flags, granule, (serial + c) % 2**32, number, 0, len(lacing)) + bytes(lacing) + body
            out.append(raw[:22] + struct.pack("<I", slow_crc(raw)) + raw[26:])
        streams.append(out)
    return b"".join(x for pair in zip(*streams, strict=True) for x in pair), sum(map(len, streams))


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in media.op3_media(spark, sf).collect()}
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert set(rows) == set(texts)
    several = 0
    for i, raw in texts.items():
        r = rows[i]
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        if len(payload) > 12_000:  # the slow form takes its time
            continue
        data, pages = slow_file(payload)
        several += pages > 4
        assert (r.media_bytes, r.media_sha256) == (len(data), hashlib.sha256(data).hexdigest())
        frames = [sum(payload[k : k + 576]) for k in range(0, len(payload), 576)]
        loud = frames.index(max(frames))
        changes = sum((a < 128) != (b < 128) for a, b in zip(payload, payload[1:], strict=False))
        assert r.feature == f"dur={len(payload) / 2 / 8000:.3f};pages={pages};mean={sum(payload) / len(payload):.4f};peak={frames[loud]}@{loud * 288 / 8000:.3f};zc={changes}"
    assert several > 5


def test_channels_must_agree(rng):
    payload = rng.randbytes(576 * 30)
    joined = media.join_channels(media.read_samples(media.write_channels(payload)))
    assert joined["payload"] == payload and joined["channels"] == 2
    left, right = (media.write_stream(payload[c::2], frame=288, serial=c, channel=c, channels=2) for c in (0, 1))
    short = media.write_stream(payload[1::2][:288], frame=288, serial=1, channel=1, channels=2)
    assert media.join_channels(media.read_samples(media.multiplex(right, left)))["payload"] == payload
    for bad in ([left], [left, short], [left, media.write_stream(payload[1::2], frame=288, serial=3, channel=0, channels=2)]):
        with pytest.raises(ValueError):
            media.join_channels(media.read_samples(media.multiplex(*bad)))
