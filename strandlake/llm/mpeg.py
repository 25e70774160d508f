"""MPEG audio columns: bytes stored losslessly in Layer III frames, and a reader of any MPEG audio stream.

The writer puts 576 bytes into each frame of an MPEG-2 Layer III stream (16 kHz, mono, 144 kbit/s; a frame has 648
bytes and lasts 576 samples) as ancillary data behind an empty granule, so that a decoder plays silence. An ID3v2
tag goes ahead, then a frame with a Xing table (frames, bytes, 100 seek points), and an ID3v1 tag comes last.

The reader works on any stream: it parses ID3v2, ID3v1 and APE tags, finds the next frame header whose successor is a
header of the same kind, reads on from frame to frame, resynchronises when a header is broken, parses Xing, Info and
VBRI tables with their seek points, which it holds against the frames that are there, verifies the checksum of each
protected frame of all three layers, and returns exact durations and the byte offset of each frame.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the standard: kbit/s by (MPEG-1?, layer), Hz by version, samples of a frame.
KBITS = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
HERTZ = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
#: Bits that tell the allocation of each subband of Layer II, by table.
ALLOCATION = {
    "a": (4,) * 11 + (3,) * 12 + (2,) * 4,
    "b": (4,) * 11 + (3,) * 12 + (2,) * 7,
    "c": (4,) * 2 + (3,) * 6,
    "d": (4,) * 2 + (3,) * 10,
    "low": (4,) * 4 + (3,) * 7 + (2,) * 19,
}
#: Fields of an ID3v1 tag: name, place, bytes.
ID3V1 = (("title", 3, 30), ("artist", 33, 30), ("album", 63, 30), ("year", 93, 4), ("comment", 97, 30))
#: Bytes of payload in a frame, and of the whole frame.
UNIT, FRAME = 576, 648
#: MPEG-2, Layer III, protected; 144 kbit/s, 16 kHz; mono.
HEADER = b"\xff\xf2\xd8\xc0"
SIDE = 9  # bytes of side information of such a frame


def _crc_table() -> list[int]:
    table = []
    for i in range(256):
        c = i << 8
        for _ in range(8):
            c = (c << 1 ^ 0x8005 if c & 0x8000 else c << 1) & 0xFFFF
        table.append(c)
    return table


_CRC = _crc_table()


@lru_cache(maxsize=4096)
def crc16(data: bytes) -> int:
    """The checksum of frames: polynomial 8005, from FFFF, over what a frame protects."""
    c = 0xFFFF
    for b in data:
        c = (c << 8 & 0xFF00) ^ _CRC[c >> 8 ^ b]
    return c


def crc16_bits(data: bytes, at: int, bits: int) -> int:
    """The checksum over a frame's header from its third byte on and so many bits from a place on."""
    c = crc16(data[:2])
    whole, rest = divmod(bits, 8)
    for b in data[at : at + whole]:
        c = (c << 8 & 0xFF00) ^ _CRC[c >> 8 ^ b]
    for k in range(rest):
        top = c >> 15 ^ data[at + whole] >> 7 - k & 1
        c = (c << 1 & 0xFFFF) ^ (0x8005 if top else 0)
    return c


def protected_bits(data: bytes, at: int, h: dict) -> int:
    """How many bits from this place on the checksum of a frame protects, besides its header."""
    version, layer, _ = h["kind"]
    channels = 1 if h["mono"] else 2
    if layer == 3:
        return 8 * h["side"]
    if layer == 1:
        return 4 * (32 * channels if h["bound"] is None else 32 + h["bound"])
    each = h["kbits"] // channels
    name = "low" if version != 3 else ("d" if h["hz"] == 32000 else "c") if each <= 48 else "a" if h["hz"] == 48000 or each <= 80 else "b"
    widths = ALLOCATION[name]
    bound = len(widths) if h["bound"] is None else min(h["bound"], len(widths))
    bits = int.from_bytes(data[at : at + 64], "big")
    read, scales = 0, 0
    for band, width in enumerate(widths):
        for _ in range(channels if band < bound else 1):
            if bits >> 512 - read - width & (1 << width) - 1:
                scales += 1 if band < bound else channels
            read += width
    return read + 2 * scales


def header(data: bytes, at: int) -> dict | None:
    """The frame header at this place, or None where none can be."""
    if at + 4 > len(data) or data[at] != 0xFF or data[at + 1] & 0xE0 != 0xE0:
        return None
    return _header(data[at : at + 4])


@lru_cache(maxsize=4096)
def _header(four: bytes) -> dict | None:
    version, layer = four[1] >> 3 & 3, 4 - (four[1] >> 1 & 3)
    rate, hertz = four[2] >> 4, four[2] >> 2 & 3
    if version == 1 or layer == 4 or rate in (0, 15) or hertz == 3:
        return None
    one = version == 3
    kbits, hz, padding = KBITS[one, layer][rate], HERTZ[version][hertz], four[2] >> 1 & 1
    samples = 384 if layer == 1 else 1152 if layer == 2 or one else 576
    size = (12_000 * kbits // hz + padding) * 4 if layer == 1 else samples * 125 * kbits // hz + padding
    mono = four[3] >> 6 == 3
    return {
        "kind": (version, layer, hertz), "kbits": kbits, "hz": hz, "samples": samples, "size": size, "mono": mono,
        "protected": not four[1] & 1, "side": (17 if mono else 32) if one else (9 if mono else 17), "bound": 4 + 4 * (four[3] >> 4 & 3) if four[3] >> 6 == 1 else None,
    }


def store(payload: bytes, title: str = "") -> bytes:
    """A stream with this payload, whose length is a multiple of 576."""
    count = len(payload) // UNIT
    frames = np.zeros((count + 1, FRAME), np.uint8)
    start = HEADER + struct.pack(">H", crc16(HEADER[2:] + bytes(SIDE)))
    frames[:, : len(start)] = np.frombuffer(start, np.uint8)
    body = len(start) + SIDE
    frames[1:, body : body + UNIT] = np.frombuffer(payload, np.uint8).reshape(count, UNIT)
    points = bytes(min(255, 256 * (i * (count + 1) // 100) // (count + 1)) for i in range(100))
    xing = b"Xing" + struct.pack(">III", 7, count, FRAME * (count + 1)) + points
    frames[0, body : body + len(xing)] = np.frombuffer(xing, np.uint8)
    named = b"\x03" + title.encode()
    tag = b"TIT2" + _synchsafe(len(named)) + b"\0\0" + named
    return b"ID3\x04\0\0" + _synchsafe(len(tag)) + tag + frames.tobytes() + b"TAG" + title.encode()[:30].ljust(124, b"\0") + b"\xff"


def _synchsafe(n: int) -> bytes:
    return bytes(n >> s & 127 for s in (21, 14, 7, 0))


def _plain(n: bytes) -> int:
    return int.from_bytes(n, "big")


def _unsynchsafe(n: bytes) -> int:
    return sum(b << s for b, s in zip(n, (21, 14, 7, 0), strict=True))


def _string(raw: bytes) -> str:
    """The text of a frame: a byte for its encoding, then its characters up to a null."""
    code = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(raw[0] if raw else 0, "latin-1")
    return raw[1:].decode(code, "replace").split("\0")[0]


def id3v2(data: bytes, at: int) -> tuple[int, dict[str, str]]:
    """Where the tag ends, and the text of its frames by their names."""
    version, flags = data[at + 3], data[at + 5]
    size = _unsynchsafe(data[at + 6 : at + 10])
    end = at + 10 + size + 10 * (flags >> 4 & 1)
    body = data[at + 10 : at + 10 + size]
    if flags & 0x80 and version < 4:
        body = body.replace(b"\xff\x00", b"\xff")
    place = 0
    if flags & 0x40 and version > 2 and len(body) >= 4:
        place = _unsynchsafe(body[:4]) if version == 4 else _plain(body[:4]) + 4
    name, head = (3, 6) if version == 2 else (4, 10)
    found: dict[str, str] = {}
    while place + head <= len(body) and body[place]:
        key = body[place : place + name].decode("latin-1")
        n = _plain(body[place + 3 : place + 6]) if version == 2 else (_unsynchsafe if version == 4 else _plain)(body[place + 4 : place + 8])
        if place + head + n > len(body):
            break
        raw = body[place + head : place + head + n]
        if version == 4 and body[place + 9] & 2:
            raw = raw.replace(b"\xff\x00", b"\xff")
        if key.startswith("T"):
            found.setdefault(key, _string(raw))
        place += head + n
    return end, found


def ape(data: bytes, end: int) -> tuple[int, dict[str, str]]:
    """Where a tag that ends here begins, and its text items."""
    size, count, flags = struct.unpack("<III", data[end - 20 : end - 8])
    place, found = max(0, end - size), {}
    start = max(0, place - 32 * (flags >> 31))
    for _ in range(count):
        n, kind = struct.unpack("<II", data[place : place + 8]) if place + 8 <= end - 32 else (0, 0)
        stop = data.find(b"\0", place + 8, end - 32)
        if stop < 0 or stop + 1 + n > end - 32:
            break
        if kind >> 1 & 3 == 0:
            found[data[place + 8 : stop].decode("latin-1")] = data[stop + 1 : stop + 1 + n].decode("utf-8", "replace")
        place = stop + 1 + n
    return start, found


def read(data: bytes) -> dict:
    """What a stream holds: frames (offset, size), samples, tags and their fields, table, checksums, junk bytes, payload of our frames."""
    at, end, tags, fields, table = 0, len(data), [], {}, None
    while data[at : at + 3] == b"ID3" and at + 10 <= end:
        at, found = id3v2(data, at)
        tags.append("id3v2")
        fields = {**found, **fields}
    if end - at >= 128 and data[end - 128 : end - 125] == b"TAG":
        tags.append("id3v1")
        end -= 128
        fields |= {f"v1:{k}": x for k, p, n in ID3V1 if (x := data[end + p : end + p + n].split(b"\0")[0].decode("latin-1").rstrip())}
    if end - at >= 32 and data[end - 32 : end - 24] == b"APETAGEX":
        tags.append("ape")
        end, found = ape(data, end)
        fields |= {f"ape:{k}": x for k, x in found.items()}
    offsets, sizes, samples, good, bad, junk, kind, hz, payload = [], [], 0, 0, 0, 0, None, 0, []
    while at + 4 <= end:
        h = header(data, at)
        fits = h and at + h["size"] <= end and (kind in (None, h["kind"]))
        if fits and kind is None and at + h["size"] < end:  # the first one must have a successor of its kind
            after = header(data, at + h["size"])
            fits = after is not None and after["kind"] == h["kind"]
        if not fits:
            found = data.find(b"\xff", at + 1, end)
            junk, at = junk + (found if found >= 0 else end) - at, found if found >= 0 else end
            continue
        kind, hz = h["kind"], h["hz"]
        head = at + 4 + 2 * h["protected"]
        body = head + h["side"]
        if h["protected"]:
            if kind[1] == 3:
                own = crc16(data[at + 2 : at + 4] + data[head:body])
            else:
                frame = data[at : at + h["size"]] + bytes(64)
                own = crc16_bits(frame[2:4] + frame[6:], 2, protected_bits(frame, 6, h))
            right = own == data[at + 4] << 8 | data[at + 5]
            good, bad = good + right, bad + (not right)
        if not offsets and table is None:
            table = seek_table(data[at : at + h["size"]], body - at)
            if table:
                table["at"] = at
                at += h["size"]
                continue
            table = {}
        offsets.append(at)
        sizes.append(h["size"])
        samples += h["samples"]
        payload.append(data[body : body + UNIT])
        at += h["size"]
    if table:
        table["right"] = _table_fits(table, offsets, sizes)
    return {
        "offsets": offsets, "sizes": sizes, "samples": samples, "hz": hz, "tags": tags, "fields": fields, "table": table or {},
        "crc_good": good, "crc_bad": bad, "junk": junk + max(0, end - at), "payload": b"".join(payload),
    }


def seek_table(frame: bytes, body: int) -> dict:
    """The table of variable bit rates that a first frame holds, or nothing: name, frames, bytes, points.

    The points are shares of the stream's bytes in 256ths, for each hundredth of its time (Xing, Info), or the bytes
    of each stretch of `stride` frames (VBRI).
    """
    if (name := frame[body : body + 4]) in (b"Xing", b"Info"):
        flags, at = _plain(frame[body + 4 : body + 8]), body + 8
        out: dict = {"name": name.decode(), "frames": None, "bytes": None, "points": []}
        for bit, key in ((1, "frames"), (2, "bytes")):
            if flags & bit:
                out[key], at = _plain(frame[at : at + 4]), at + 4
        if flags & 4:
            out["points"] = list(frame[at : at + 100])
        return out
    if frame[36:40] == b"VBRI":
        size, frames = _plain(frame[46:50]), _plain(frame[50:54])
        count, scale, width, stride = (_plain(frame[k : k + 2]) for k in (54, 56, 58, 60))
        points = [scale * _plain(frame[62 + k * width : 62 + (k + 1) * width]) for k in range(count) if 62 + (k + 1) * width <= len(frame)]
        return {"name": "VBRI", "frames": frames, "bytes": size, "points": points, "stride": stride}
    return {}


def _table_fits(table: dict, offsets: list[int], sizes: list[int]) -> bool:
    """Whether a table's numbers are those of the frames that follow, and its points lie within one frame and a 256th of theirs."""
    start, n = table["at"], len(offsets)
    end = offsets[-1] + sizes[-1] if n else start
    if table["frames"] not in (None, n) or table["bytes"] not in (None, end - start):
        return False
    if table["name"] == "VBRI":
        places = np.cumsum(table["points"]) + start
        wanted = [offsets[k] if k < n else end for k in range(table.get("stride", 1), table.get("stride", 1) * len(places) + 1, max(1, table.get("stride", 1)))]
        return all(abs(int(p) - w) <= max(sizes) + table["bytes"] // 256 for p, w in zip(places, wanted, strict=False))
    if not n or not table["points"]:
        return not table["points"] or n == 0
    reach = (end - start) // 256 + max(sizes) + 1
    return all(abs(start + p * (end - start) // 256 - offsets[k * n // 100]) <= reach + sizes[0] for k, p in enumerate(table["points"]))


def runs(offsets: list[int], sizes: list[int]) -> str:
    """All offsets, as stretches of frames of one size that follow each other: `offset+sizexcount`, joined by commas."""
    out: list[list[int]] = []
    for at, size in zip(offsets, sizes, strict=True):
        if out and out[-1][1] == size and out[-1][0] + size * out[-1][2] == at:
            out[-1][2] += 1
        else:
            out.append([at, size, 1])
    return ",".join(f"{a}+{s}x{n}" for a, s, n in out)


def payload_of(text: str | None) -> bytes:
    """The text's UTF-8 bytes (null: none), with bytes 255 up to a positive multiple of 576."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\xff" * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw))


def _store(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([store(payload_of(x)) for x in batch], dtype=object)


_FEATURES = "media_bytes long, media_sha256 string, payload_bytes long, payload_sha256 string, tail_crc32 long, n_frames long, n_samples long, hz int, duration_us long, seek_offsets array<long>, tags map<string,string>, table_frames long, table_bytes long, table_right boolean, crc_good long, crc_bad long, junk_bytes long, feature string"


def _features(media: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in _FEATURES.split(", ")]
    for batch in media:
        rows = []
        for data in batch:
            r = read(bytes(data))
            p, n, t = r["payload"], len(r["offsets"]), r["table"]
            us = r["samples"] * 1_000_000 // r["hz"] if r["hz"] else 0
            said = f"{t['name']}:{t['frames']}:{t['bytes']}:{len(t['points'])}:{'right' if t['right'] else 'wrong'}" if t else "-"
            feature = f"{'+'.join(r['tags']) or '-'};{said};frames={n};us={us};crc={r['crc_good']}/{r['crc_bad']};junk={r['junk']};seek={runs(r['offsets'], r['sizes'])}"
            rows.append((len(data), hashlib.sha256(data).hexdigest(), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), n, r["samples"], r["hz"], us, r["offsets"], r["fields"], t.get("frames"), t.get("bytes"), t.get("right"), r["crc_good"], r["crc_bad"], r["junk"], feature))
        yield pd.DataFrame(rows, columns=names).astype({"table_frames": "Int64", "table_bytes": "Int64"})


def stored(text: Column) -> Column:
    """The stream that holds a text."""
    return F.pandas_udf(_store, "binary")(text)


def features(media: Column) -> Column:
    """Durations, tags, frame offsets, checksums and digests of a stream; of any other bytes: no frame, all of it junk."""
    return F.pandas_udf(_features, _FEATURES)(media)


def media_columns(docs: DataFrame, text: str = "text", out: str = "media") -> DataFrame:
    """Rows with their texts' streams and what the reader finds in them; a column of that name is replaced."""
    return docs.withColumn(out, stored(F.col(text))).withColumn(f"{out}_features", features(F.col(out)))


def digests(docs: DataFrame) -> DataFrame:
    """One row for each row: sizes and digests of its text, payload and stream.

    A null text counts as an empty one, whose payload is one unit of bytes 255; equal texts have equal values in all
    columns but doc_id; repeated rows stay; further columns play no part; an empty table gives none. The feature has
    tags, table, frames, duration, checksums and the offsets of all frames. The stream and its reading happen in one
    Python task, so that neither stream nor payload returns to the JVM.
    """
    read_back = docs.select("doc_id", F.coalesce(F.octet_length("text").cast("long"), F.lit(0)).alias("n_bytes"), features(stored(F.col("text"))).alias("f"))
    kept = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_frames", "duration_us", "crc_good", "crc_bad")
    return read_back.select("doc_id", "n_bytes", *(f"f.{x}" for x in kept))


def oracle() -> str:
    """The same in DuckDB: payload and stream put together as hexadecimal digits."""
    start = (HEADER + struct.pack(">H", crc16(HEADER[2:] + bytes(SIDE))) + bytes(SIDE)).hex()
    tag = b"TIT2" + _synchsafe(1) + b"\0\0\x03"
    front = (b"ID3\x04\0\0" + _synchsafe(len(tag)) + tag).hex()
    back = (b"TAG" + bytes(124) + b"\xff").hex()
    rest = "00" * (FRAME - len(start) // 2 - UNIT)
    free = 2 * (FRAME - len(start) // 2 - 116)
    first = len(front) // 2 + FRAME
    return f"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes, greatest(1, (strlen(coalesce(text, '')) + {UNIT - 1}) // {UNIT}) AS n, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
p AS (SELECT doc_id, n_bytes, n, h || repeat('ff', n * {UNIT} - n_bytes) AS p FROM d),
m AS (SELECT *, '{front}' || '{start}' || lower(hex(encode('Xing'))) || '00000007' || printf('%08x', n) || printf('%08x', {FRAME} * (n + 1))
  || array_to_string(list_transform(range(0, 100), lambda i: printf('%02x', least(255, 256 * (i * (n + 1) // 100) // (n + 1)))), '') || repeat('0', {free})
  || array_to_string(list_transform(range(0, n), lambda i: '{start}' || substr(p, i * {2 * UNIT} + 1, {2 * UNIT}) || '{rest}'), '') || '{back}' AS m FROM p),
crc AS (SELECT i, list_reduce([i::BIGINT, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) t(i)),
tab AS (SELECT list(c ORDER BY i) AS t FROM crc)
SELECT doc_id, n_bytes, n * {UNIT} AS payload_bytes, sha256(unhex(p)) AS payload_sha256,
  xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, 32), lambda i: ('0x' || substr(p, length(p) - 63 + 2 * i, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS tail_crc32,
  length(m) // 2 AS media_bytes, sha256(unhex(m)) AS media_sha256,
  'id3v2+id3v1;Xing:' || n || ':' || ({FRAME} * (n + 1)) || ':100:right;frames=' || n || ';us=' || (n * {UNIT} * 1000000 // 16000) || ';crc=' || (n + 1) || '/0;junk=0;seek={first}+{FRAME}x' || n AS feature,
  n AS n_frames, n * {UNIT} * 1000000 // 16000 AS duration_us, n + 1 AS crc_good, 0::BIGINT AS crc_bad
FROM m, tab"""
