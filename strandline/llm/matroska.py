"""Media columns: Matroska bytes as packet tables.

``parse`` reads variable-length EBML elements: tracks, clusters (of unknown size too),
simple blocks and block groups with every kind of lacing, and cues. ``mux`` writes one
audio track of 8-bit samples with fixed-size lacing and cues. Both are plain Python over
one value of a binary column; the table functions run them per Arrow batch: ``packet_table``
has the packets with the clusters they lie in, ``cue_table`` the cues with the clusters they point at.

Cases: null or empty bytes give no packet; damaged bytes give the packets before the
damage, and a frame that is cut off or lacing that doesn't fit its block is damage; null
texts count as empty; ids may repeat, each row is handled by itself; an empty table gives no row;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandline.llm.common import blocks, strings, texts

# Ids of EBML and Matroska elements.
EBML, DOC_TYPE, DOC_TYPE_VERSION = 0x1A45DFA3, 0x4282, 0x4287
SEGMENT, INFO, TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
DEFAULT_DURATION = 0x23E383
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
TOP_LEVEL = {0x114D9B74, INFO, TRACKS, CLUSTER, CUES, 0x1941A469, 0x1043A770, 0x1254C367}
MASTERS = {SEGMENT, INFO, TRACKS, TRACK_ENTRY, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE_POINT, CUE_TRACK_POSITIONS}
# End of fixed values.

FRAME = 576
RATE = 8000
FRAME_NS = FRAME * 1_000_000_000 // RATE
FRAMES_PER_BLOCK, BLOCKS_PER_CLUSTER = 8, 32


class Packet(NamedTuple):
    track: int
    timestamp_ns: int
    keyframe: bool
    offset: int
    length: int
    cluster: int  #: number of its cluster


class Media(NamedTuple):
    tracks: list[dict]
    packets: list[Packet]
    cues: list[tuple[int, int, int]]  #: nanoseconds, track, offset of the cluster in the file
    clusters: list[int]  #: offset of each cluster in the file


def _size(n: int) -> bytes:
    width = 1
    while n >= (1 << 7 * width) - 1:
        width += 1
    return (n | 1 << 7 * width).to_bytes(width, "big")


def _element(kind: int, data: bytes) -> bytes:
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + _size(len(data)) + data


def _uint(kind: int, n: int) -> bytes:
    return _element(kind, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def _head(duration_ms: float) -> bytes:
    info = _uint(TIMESTAMP_SCALE, 1_000_000) + _element(DURATION, struct.pack(">d", duration_ms)) + _element(MUXING_APP, b"strandline") + _element(WRITING_APP, b"strandline")
    audio = _element(SAMPLING_FREQUENCY, struct.pack(">d", RATE)) + _uint(CHANNELS, 1) + _uint(BIT_DEPTH, 8)
    track = _uint(TRACK_NUMBER, 1) + _uint(TRACK_UID, 1) + _uint(TRACK_TYPE, 2) + _element(CODEC_ID, b"A_PCM/INT/LIT") + _uint(DEFAULT_DURATION, FRAME_NS) + _element(AUDIO, audio)
    return _element(INFO, info) + _element(TRACKS, _element(TRACK_ENTRY, track))


def mux(payload: bytes) -> bytes:
    """Matroska bytes with the payload as 8-bit samples, 576 a frame. Its length must be a positive multiple of 576."""
    if not payload or len(payload) % FRAME:
        raise ValueError("the payload's length must be a positive multiple of 576")
    frames = len(payload) // FRAME
    head = _head(frames * FRAME_NS / 1e6)
    body, cues, at = [head], [], len(head)
    per_cluster = FRAMES_PER_BLOCK * BLOCKS_PER_CLUSTER
    for first in range(0, frames, per_cluster):
        base = first * FRAME_NS // 1_000_000
        parts = [_uint(TIMESTAMP, base)]
        last = min(frames, first + per_cluster)
        for f in range(first, last, FRAMES_PER_BLOCK):
            n = min(FRAMES_PER_BLOCK, last - f)
            flags = 0x80 | (0x04 if n > 1 else 0)  # key frames; fixed-size lacing
            header = b"\x81" + struct.pack(">hB", f * FRAME_NS // 1_000_000 - base, flags) + (bytes([n - 1]) if n > 1 else b"")
            parts.append(_element(SIMPLE_BLOCK, header + payload[f * FRAME : (f + n) * FRAME]))
        cluster = _element(CLUSTER, b"".join(parts))
        cues.append(_element(CUE_POINT, _uint(CUE_TIME, base) + _element(CUE_TRACK_POSITIONS, _uint(CUE_TRACK, 1) + _uint(CUE_CLUSTER_POSITION, at))))
        body.append(cluster)
        at += len(cluster)
    body.append(_element(CUES, b"".join(cues)))
    header = _element(EBML, _element(DOC_TYPE, b"matroska") + _uint(DOC_TYPE_VERSION, 4))
    return header + _element(SEGMENT, b"".join(body))


def _vint(data: bytes, at: int, keep_marker: bool) -> tuple[int, int]:
    """Value and the place after it; the value is -1 for an unknown size."""
    first = data[at]
    if not first:
        raise ValueError("no EBML number here")
    width = 9 - first.bit_length()
    if at + width > len(data):
        raise ValueError("an EBML number is cut off")
    n = int.from_bytes(data[at : at + width], "big")
    if keep_marker:
        return n, at + width
    n &= (1 << 7 * width) - 1
    return (-1 if n == (1 << 7 * width) - 1 else n), at + width


def elements(data: bytes, start: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(id, start of the content, end of the content) of each element in turn."""
    for kind, body, stop, _ in placed(data, start, end):
        yield kind, body, stop


def placed(data: bytes, start: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """(id, start of the content, end of the content, start of the element) of each element in turn. One of unknown size ends before the next
    top-level element, or at ``end``. Of a cut element with elements inside, what is there is given; any other is damage."""
    at = start
    while at < end:
        kind, body = _vint(data, at, True)
        size, body = _vint(data, body, False)
        if size < 0:
            stop = body
            if kind == SEGMENT:
                stop = end
            while stop < end:
                k, b = _vint(data, stop, True)
                n, b = _vint(data, b, False)
                if k in TOP_LEVEL or n < 0:
                    break
                stop = b + n
        else:
            stop = body + size
        if stop > end and kind not in MASTERS:
            raise ValueError("an element is cut off")
        yield kind, body, min(stop, end), at
        at = stop


def laced(data: bytes, at: int, end: int, lacing: int) -> list[tuple[int, int]]:
    """(offset, length) of the frames of a block whose lacing header starts at ``at``. lacing: 0 none, 1 Xiph, 2 fixed size, 3 EBML."""
    if not lacing:
        return [(at, end - at)]
    count = data[at] + 1
    at += 1
    sizes: list[int] = []
    if lacing == 2:
        if (end - at) % count:
            raise ValueError("fixed-size lacing that doesn't divide the block")
        sizes = [(end - at) // count] * count
    elif lacing == 1:
        for _ in range(count - 1):
            n = 0
            while data[at] == 255:
                n, at = n + 255, at + 1
            sizes.append(n + data[at])
            at += 1
        sizes.append(end - at - sum(sizes))
    else:
        for i in range(count - 1):
            before = at
            n, at = _vint(data, at, False)
            if i:  # a signed difference to the size before
                width = at - before
                n = sizes[-1] + n - ((1 << 7 * width - 1) - 1)
            sizes.append(n)
        sizes.append(end - at - sum(sizes))
    if min(sizes) < 0 or at + sum(sizes) > end:
        raise ValueError("lacing beyond the block")
    out = []
    for n in sizes:
        out.append((at, n))
        at += n
    return out


def _number(data: bytes, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def parse(data: bytes) -> Media:
    """Tracks, packets, cues and cluster offsets. Stops at the first damage and keeps what came before it."""
    media = Media([], [], [], [])
    try:
        for kind, a, b in elements(data, 0, len(data)):
            if kind == SEGMENT:
                _segment(data, a, b, media)
    except (ValueError, IndexError, struct.error):
        pass
    return media


def _segment(data: bytes, start: int, end: int, media: Media) -> None:
    scale, durations = 1_000_000, {}
    for kind, a, b, place in placed(data, start, end):
        if kind == INFO:
            for k, c, d in elements(data, a, b):
                if k == TIMESTAMP_SCALE:
                    scale = _number(data, c, d)
        elif kind == TRACKS:
            for k, c, d in elements(data, a, b):
                if k == TRACK_ENTRY:
                    track: dict = {}
                    for m, e, f in elements(data, c, d):
                        if m in (TRACK_NUMBER, TRACK_TYPE, DEFAULT_DURATION):
                            track[m] = _number(data, e, f)
                        elif m == CODEC_ID:
                            track[m] = data[e:f].rstrip(b"\0").decode("ascii", "replace")
                    durations[track.get(TRACK_NUMBER, 0)] = track.get(DEFAULT_DURATION, 0)
                    media.tracks.append({"number": track.get(TRACK_NUMBER, 0), "type": track.get(TRACK_TYPE, 0), "codec": track.get(CODEC_ID, "")})
        elif kind == CLUSTER:
            media.clusters.append(place)
            base = 0
            for k, c, d in elements(data, a, b):
                if k == TIMESTAMP:
                    base = _number(data, c, d)
                elif k == SIMPLE_BLOCK:
                    _block(data, c, d, base, scale, durations, media, None)
                elif k == BLOCK_GROUP:
                    inner = list(elements(data, c, d))
                    refers = any(m == 0xFB for m, _, _ in inner)
                    for m, e, f in inner:
                        if m == BLOCK:
                            _block(data, e, f, base, scale, durations, media, not refers)
        elif kind == CUES:
            for k, c, d in elements(data, a, b):
                if k != CUE_POINT:
                    continue
                time = 0
                for m, e, f in elements(data, c, d):
                    if m == CUE_TIME:
                        time = _number(data, e, f) * scale
                    elif m == CUE_TRACK_POSITIONS:
                        found = {x: _number(data, y, z) for x, y, z in elements(data, e, f)}
                        media.cues.append((time, found.get(CUE_TRACK, 0), start + found.get(CUE_CLUSTER_POSITION, 0)))


def _block(data: bytes, a: int, b: int, base: int, scale: int, durations: dict, media: Media, key: bool | None) -> None:
    track, at = _vint(data, a, False)
    relative, flags = struct.unpack_from(">hB", data, at)
    first, each = (base + relative) * scale, durations.get(track, 0)
    key = bool(flags & 0x80) if key is None else key
    for i, (offset, length) in enumerate(laced(data, at + 3, b, flags >> 1 & 3)):
        media.packets.append(Packet(track, first + i * each, key, offset, length, len(media.clusters) - 1))


PACKET_SCHEMA = (
    "media_id long, packet long, track long, codec string, timestamp_ns long, keyframe boolean, offset long, length long, cluster long, cluster_offset long, cued boolean"
)
CUE_SCHEMA = "media_id long, cue long, timestamp_ns long, track long, cluster_offset long, cluster long"
_KINDS = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def _rows_of(df: DataFrame, id_col: str, bytes_col: str, schema: str, rows_of) -> DataFrame:
    fields = [c.split() for c in schema.split(", ")]

    def run(batches):
        for block in blocks(batches):
            rows = [(i, *row) for i, data in zip(block.column("doc_id").to_pylist(), block.column("text").to_pylist(), strict=True) for row in rows_of(parse(data or b""))]
            columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])

    return texts(df, id_col, bytes_col).mapInArrow(run, schema)


def packet_table(df: DataFrame, id_col: str, bytes_col: str) -> DataFrame:
    """One row per packet of each value of a binary column; ``cued``: whether a cue of its track points at its cluster."""

    def rows_of(media: Media) -> Iterator[tuple]:
        codecs = {t["number"]: t["codec"] for t in media.tracks}
        cued = {(track, at) for _, track, at in media.cues}
        for n, p in enumerate(media.packets):
            at = media.clusters[p.cluster]
            yield n, p.track, codecs.get(p.track), p.timestamp_ns, p.keyframe, p.offset, p.length, p.cluster, at, (p.track, at) in cued

    return _rows_of(df, id_col, bytes_col, PACKET_SCHEMA, rows_of)


def cue_table(df: DataFrame, id_col: str, bytes_col: str) -> DataFrame:
    """One row per cue of each value of a binary column; ``cluster``: the number of the cluster at its offset, null if there is none."""

    def rows_of(media: Media) -> Iterator[tuple]:
        number = {at: n for n, at in enumerate(media.clusters)}
        for n, (time, track, at) in enumerate(media.cues):
            yield n, time, track, at, number.get(at)

    return _rows_of(df, id_col, bytes_col, CUE_SCHEMA, rows_of)


def payload_of(text: str) -> tuple[bytes, int]:
    """UTF-8 bytes, filled with 255 up to a positive multiple of 576; and their number before that."""
    data = text.encode()
    n = len(data)
    return data + b"\xff" * ((-n) % FRAME if n else FRAME), n


def feature_of(media: Media, payload: bytes) -> str:
    samples = np.frombuffer(payload, np.uint8)
    signs = samples >= 128
    span = (media.packets[-1].timestamp_ns - media.packets[0].timestamp_ns + FRAME_NS) // 1_000_000 if media.packets else 0
    return (
        f"packets={len(media.packets)};clusters={len(media.clusters)};cues={len(media.cues)};ms={span};"
        f"sum={int(samples.sum(dtype=np.int64))};peak={int(samples.max(initial=0))};crossings={int(np.count_nonzero(signs[1:] != signs[:-1]))}"
    )


STORED_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def stored_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text stored as Matroska, and what reading the stored bytes back gives."""

    def run(batches):
        for block in blocks(batches):
            out: list[tuple] = []
            for text in strings(block):
                payload, n = payload_of(text)
                stored = mux(payload)
                media = parse(stored)
                back = b"".join([stored[p.offset : p.offset + p.length] for p in media.packets])
                out.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature_of(media, back)))
            cols = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([block.column("doc_id").cast(pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], [c.split()[0] for c in STORED_SCHEMA.split(", ")])

    return texts(df, id_col, text_col).mapInArrow(run, STORED_SCHEMA)
