"""GIF media columns: frames decoded from LZW code streams with palettes, disposal and transparency applied.

`encode_gif` stores 8-bit samples as a grey animation; `gif_frames` reads any GIF column into timed frames. Code widths
depend only on a code's place since the last clear code, so codes are unpacked for whole segments at once, and strings are
resolved by following each output sample to the earlier sample that it copies.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mossgrid.llm.common import pieces, prepare

MOST_CODES = 4096
#: A canvas or image with more pixels, or frames with more bytes in all, is an error: headers can claim any size.
MOST_PIXELS = 1 << 24
MOST_BYTES = 1 << 29
BINS = 16
FRAME = "struct<index:int,start_ms:bigint,delay_ms:int,left:int,top:int,width:int,height:int,disposal:int,transparent:int,mode:string,pixels:binary,histogram:array<bigint>>"
FRAME_ARROW = pa.struct([("index", pa.int32()), ("start_ms", pa.int64()), *((n, pa.int32()) for n in ("delay_ms", "left", "top", "width", "height", "disposal", "transparent")), ("mode", pa.string()), ("pixels", pa.binary()), ("histogram", pa.list_(pa.int64()))])
_WIDTHS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def widths(root: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each code after a clear code, and the bits before it."""
    if root not in _WIDTHS:
        entries = (1 << root) + 2 + np.maximum(np.arange(2 * MOST_CODES) - 1, 0)
        w = np.minimum(12, np.floor(np.log2(entries)).astype(np.int64) + 1)
        _WIDTHS[root] = w, np.concatenate(([0], np.cumsum(w)))
    return _WIDTHS[root]


def lzw_encode(samples: bytes, root: int = 8) -> bytes:
    """The code stream of samples below 2**root, with a clear code first and whenever the table is full."""
    clear = 1 << root
    first, full = (clear + 2) << 8, MOST_CODES << 8
    segments, table, free, at = [], {}, first, 1
    put = table.setdefault
    w = samples[0] << 8 if samples else 0  # codes are kept shifted by 8, so that code + sample is a key
    while at < len(samples):
        run = samples[at : at + ((full - free) >> 8)]  # each sample adds one string at most
        for b in run:
            c = put(w + b, free)
            if c != free:
                w = c
            else:  # the new key tells the code that ends here
                w = b << 8
                free += 256
        at += len(run)
        if free == full:
            segments.append([k >> 8 for k in table])
            table.clear()
            free = first
    segments.append([*(k >> 8 for k in table), w >> 8][: None if samples else 0])
    bits, _ = widths(root)
    all_codes, all_bits = [np.array([clear])], [bits[:1]]
    for k, seg in enumerate(segments):
        all_codes.append(np.array([*seg, clear if k < len(segments) - 1 else clear + 1], np.int64))
        all_bits.append(bits[: len(seg) + 1])
    code, width = np.concatenate(all_codes), np.concatenate(all_bits)
    ends = np.cumsum(width)
    at = ends - width
    wide, byte, n = code << (at & 7), at >> 3, int(ends[-1] + 7) // 8
    out = sum(np.bincount(byte + k, (wide >> (8 * k)) & 255, n + 3) for k in range(3))
    return out[:n].astype(np.uint8).tobytes()


def lzw_decode(stream: bytes, root: int, want: int) -> np.ndarray:
    """The first `want` samples of a code stream; ValueError where it is damaged. A stream that ends early gives fewer."""
    clear, end = 1 << root, (1 << root) + 1
    bits, before = widths(root)
    data = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.int64)
    total, at, done, parts, got = 8 * len(stream), 0, False, [], 0
    while not done and got < want and at + root + 1 <= total:
        codes, k = [], 0
        while True:
            if k < len(bits):
                most = k + (total - at) // (root + 1) + 2
                w, b = bits[k:most], before[k : most + 1] - before[k]
            else:
                w = np.full(MOST_CODES, 12)
                b = 12 * np.arange(MOST_CODES + 1)
            n = int(np.searchsorted(b[1 : len(w) + 1], total - at, "right"))
            p = at + b[:n]
            byte = p >> 3
            c = ((data[byte] | data[byte + 1] << 8 | data[byte + 2] << 16) >> (p & 7)) & ((1 << w[:n]) - 1)
            stop = np.flatnonzero((c == clear) | (c == end))
            if len(stop):
                m = int(stop[0])
                codes.append(c[:m])
                at += int(b[m + 1])
                done = bool(c[m] == end)
                break
            codes.append(c)
            at += int(b[n])
            k += n
            if n < len(w):
                done = True
                break
        c = np.concatenate(codes)
        if len(c):
            parts.append(strings(c, clear, want - got))
            got += len(parts[-1])
    return np.concatenate(parts)[:want] if parts else np.zeros(0, np.uint8)


def strings(codes: np.ndarray, clear: int, want: int) -> np.ndarray:
    """The samples of one segment's codes, those of further codes left out when there are as many as wanted. Entry i of its table is code i's string and the sample after it, so each code but a plain sample copies from where an earlier one stands."""
    n = len(codes)
    own = np.arange(n)
    plain = codes < clear
    if plain.all():
        return codes.astype(np.uint8)
    entry = np.where(plain, own, codes - clear - 2)
    if (entry > own).any() or (~plain & (entry >= own)).any() or (entry < 0).any():
        raise ValueError("a code that its table lacks")
    length, up = (~plain).astype(np.int64), entry
    while True:
        further = up[up]
        length = length + np.where(up != own, length[up], 0)
        if (further == up).all():
            break
        up = further
    length += 1
    ends = np.cumsum(length)
    if ends[-1] > want + MOST_CODES:
        n = int(np.searchsorted(ends, want)) + 1
        codes, entry, plain, length, ends = codes[:n], entry[:n], plain[:n], length[:n], ends[:n]
    starts = ends - length
    source = (np.arange(int(length.sum())) + np.repeat(starts[entry] - starts, length)).astype(np.int32)
    while True:
        further = source[source]
        if (further == source).all():
            break
        source = further
    values = np.zeros(len(source), np.uint8)
    values[starts[plain]] = codes[plain]
    return values[source]


def blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while data[at]:
        parts.append(data[at + 1 : at + 1 + data[at]])
        at += 1 + data[at]
    return b"".join(parts), at + 1


def encode_gif(samples: bytes, width: int = 64, rows: int = 1024, delay_cs: int = 10) -> bytes:
    """Samples in frames of at most rows lines, one after the other, over a grey palette; len(samples) is a multiple of width."""
    lines = len(samples) // width
    grey = bytes(x for v in range(256) for x in (v, v, v))
    out = [b"GIF89a", struct.pack("<HHBBB", width, min(lines, rows), 0xF7, 0, 0), grey]
    for top in range(0, lines, rows):
        part = samples[top * width : (top + rows) * width]
        stream = lzw_encode(part)
        out += [b"\x21\xf9\x04\x08", struct.pack("<HBB", delay_cs, 0, 0), b"\x2c", struct.pack("<HHHHB", 0, 0, width, len(part) // width, 0), b"\x08"]
        out += [bytes([len(x)]) + x for x in (stream[i : i + 255] for i in range(0, len(stream), 255))] + [b"\0"]
    return b"".join([*out, b"\x3b"])


def decode_gif(data: bytes, whole: bool = True, most_pixels: int | None = MOST_PIXELS, most_bytes: int | None = MOST_BYTES) -> Iterator[dict]:
    """Frames as they show: the canvas after each image is drawn (whole), or that image's rectangle of it.

    mode L holds one sample a pixel, where everything shown is grey and opaque; else RGBA. Disposal 2 clears the rectangle
    before the next image, 3 restores what was there. Damaged data and data beyond the bounds raise ValueError, IndexError
    or struct.error, after the frames before the damage. A bound of None is none.
    """
    most_pixels, most_bytes = (math.inf if x is None else x for x in (most_pixels, most_bytes))
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("no GIF header")
    width, height, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    at = 13
    palette = None
    if flags & 0x80:
        n = 2 << (flags & 7)
        palette = np.frombuffer(data, np.uint8, 3 * n, at).reshape(-1, 3)
        at += 3 * n
    canvas = None
    number, size, clock, disposal, delay, see_through = 0, 0, 0, 0, 0, -1
    while data[at : at + 1] != b"\x3b":
        if data[at] == 0x21:
            label = data[at + 1]
            body, at = blocks(data, at + 2)
            if label == 0xF9:
                disposal, delay = body[0] >> 2 & 7, body[1] | body[2] << 8
                see_through = body[3] if body[0] & 1 else -1
            continue
        if data[at] != 0x2C:
            raise ValueError("an unknown block")
        left, top, w, h, own = struct.unpack_from("<HHHHB", data, at + 1)
        at += 10
        colours = palette
        if own & 0x80:
            n = 2 << (own & 7)
            colours = np.frombuffer(data, np.uint8, 3 * n, at).reshape(-1, 3)
            at += 3 * n
        if colours is None or not 1 <= data[at] <= 8:
            raise ValueError("no palette, or a code size out of range")
        if w * h > most_pixels:
            raise ValueError(f"an image of more than {most_pixels} pixels")
        root = data[at]
        stream, at = blocks(data, at + 1)
        index = lzw_decode(stream, root, w * h)
        covers = not whole or (left, top, w, h) == (0, 0, width, height)
        if covers and len(index) == w * h and see_through < 0 and not own & 0x40 and left + w <= width and top + h <= height and data[at : at + 1] == b"\x3b" and is_grey(colours) and index.max(initial=0) < len(colours):
            value = colours[:, 0][index]  # the last image, opaque and grey: nothing beneath it shows
            bins = np.bincount(value >> 4, minlength=BINS).tolist()
            if size + len(value) > most_bytes:
                raise ValueError(f"frames of more than {most_bytes} bytes")
            yield {"index": number, "start_ms": clock, "delay_ms": delay * 10, "left": left, "top": top, "width": w, "height": h, "disposal": disposal, "transparent": -1, "mode": "L", "pixels": value.tobytes(), "histogram": bins * 3}
            return
        if canvas is None:
            if width * height > most_pixels:
                raise ValueError(f"a canvas of more than {most_pixels} pixels")
            canvas = np.zeros((height, width, 4), np.uint8)
        shown = np.zeros(w * h, bool)
        shown[: len(index)] = index != see_through
        index = np.concatenate((index, np.zeros(w * h - len(index), np.uint8)))
        if index.max(initial=0) >= len(colours):
            raise ValueError("a sample beyond its palette")
        if own & 0x40:
            order = np.concatenate([np.arange(a, h, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
            lines, seen = np.empty((h, w), np.uint8), np.empty((h, w), bool)
            lines[order], seen[order] = index.reshape(h, w), shown.reshape(h, w)
            index, shown = lines.ravel(), seen.ravel()
        before = canvas.copy() if disposal == 3 else None
        area = canvas[top : top + h, left : left + w]
        fits = np.s_[: area.shape[0], : area.shape[1]]
        drawn, visible = colours[index].reshape(h, w, 3)[fits], shown.reshape(h, w)[fits]
        area[..., :3][visible] = drawn[visible]
        area[..., 3][visible] = 255
        view = canvas if whole else area
        grey = bool((view[..., 3] == 255).all() and (view[..., 0] == view[..., 1]).all() and (view[..., 1] == view[..., 2]).all())
        solid = view[view[..., 3] == 255]
        pixels = (view[..., 0] if grey else view).tobytes()
        size += len(pixels)
        if size > most_bytes:
            raise ValueError(f"frames of more than {most_bytes} bytes")
        histogram = np.concatenate([np.bincount(solid[:, k] >> 4, minlength=BINS) for k in range(3)]).tolist()
        yield {"index": number, "start_ms": clock, "delay_ms": delay * 10, "left": left, "top": top, "width": view.shape[1], "height": view.shape[0], "disposal": disposal, "transparent": see_through, "mode": "L" if grey else "RGBA", "pixels": pixels, "histogram": histogram}
        number += 1
        clock += delay * 10
        if disposal == 2:
            area[...] = 0
        elif disposal == 3:
            canvas = before
        disposal, delay, see_through = 0, 0, -1


def is_grey(colours: np.ndarray) -> bool:
    return bool((colours == colours[:, :1]).all())


def gif_frames(df: DataFrame, media: str = "media", whole: bool = True, most_pixels: int | None = MOST_PIXELS, most_bytes: int | None = MOST_BYTES) -> DataFrame:
    """Adds frames (array of timed frames with their pixels and a histogram of 3 x 16 colour bins) and gif_error.

    Null media give null frames and no error; damaged media, and media beyond the bounds, the error's text and the frames
    before the damage, null where there are none. The bounds are for foreign files, whose headers can claim any size; files
    of one's own take None. A file without images has no frames. Repeated rows have equal results.
    Tables may be empty. Other columns are kept, but for earlier ones named frames and gif_error, which are replaced.
    """
    prepare(df.sparkSession)
    df = df.drop("frames", "gif_error")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, media):
            frames, errors = [], []
            for data in batch.column(media).to_pylist():
                shown, error = [], None
                try:
                    for frame in decode_gif(data, whole, most_pixels, most_bytes) if data is not None else ():
                        shown.append(frame)
                except (ValueError, IndexError, struct.error) as e:
                    error = f"damaged: {e}"
                frames.append(shown if shown or data is not None and error is None else None)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(frames, pa.list_(FRAME_ARROW)), pa.array(errors, pa.string())], [*batch.schema.names, "frames", "gif_error"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(decode, f"{fields}, frames array<{FRAME}>, gif_error string")


def store_texts(df: DataFrame, text: str = "text", width: int = 64) -> DataFrame:
    """Adds n_bytes (of the UTF-8 text; null is empty), payload_bytes (padded with bytes 0 to a positive multiple of width) and media, the payload as a GIF. Replaces columns so named."""
    prepare(df.sparkSession)
    df = df.drop("n_bytes", "payload_bytes", "media")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            texts = [(x or "").encode() for x in batch.column(text).to_pylist()]
            padded = [x + b"\0" * (-len(x) % width or (0 if x else width)) for x in texts]
            kept = [c for c in batch.schema.names if c != text]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(map(len, texts), pa.int64()), pa.array(map(len, padded), pa.int64()), pa.array([encode_gif(x, width) for x in padded], pa.binary())], [*kept, "n_bytes", "payload_bytes", "media"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema if f.name != text)
    return df.mapInArrow(encode, f"{fields}n_bytes long, payload_bytes long, media binary")
