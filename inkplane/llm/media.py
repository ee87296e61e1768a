"""Media columns: AVI files of lossless motion-JPEG frames, and shots found in them.

A payload's bytes are the 8-bit grey samples of intra frames, 64 to a row. Frames are lossless
JPEG (ITU-T T.81, SOF3) with the left-neighbour predictor. The Huffman table gives difference
category s a code of 9 - s bits; with its s extra bits every sample takes nine bits (the lengths
satisfy Kraft's sum: 511/512, which leaves the all-ones code free, as the standard wants). So both
directions are array operations. The standard's byte stuffing (FF -> FF 00) applies.

Frames of other writers are read too: baseline frames (SOF0, SOF1), of which the first component, luma, is
decoded, and lossless ones with other tables or predictors, both with the Huffman tables that stand in the frame,
or the standard's where a frame has none, as AVI's MJPG frames may. That goes symbol by symbol, so it is slower.

Defined cases: a null text is an empty one; an empty text is stored as 64 zero bytes; rows that repeat, or have
no id, are stored each; equal texts give equal files; an empty table gives none; other columns are ignored. Reading
a null or broken file, or one that isn't an AVI file of such frames, gives a row with error, and the
others go on.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import arrow_batches, text_or_empty

WIDTH = 64
ROWS = 64  # of a full frame
FPS = 25
CATEGORIES = 9  # differences of 8-bit samples: 0 to 8 bits


def _difference_codes() -> tuple[np.ndarray, np.ndarray]:
    """The nine-bit field of each difference -255..255, and the difference of each field."""
    lengths = [(CATEGORIES - s, s) for s in range(CATEGORIES)]
    code, prefix, last = 0, {}, 0
    for length, s in sorted(lengths):  # canonical codes: by length
        code = (code << (length - last)) if last else 0
        prefix[s], last = code, length
        code += 1
    field_of = np.zeros(511, np.uint16)
    diff_of = np.zeros(512, np.int16)
    for d in range(-255, 256):
        s = abs(d).bit_length()
        extra = d if d >= 0 else d + (1 << s) - 1
        field = (prefix[s] << s) | extra
        field_of[d + 255], diff_of[field] = field, d
    return field_of, diff_of


FIELD_OF, DIFF_OF = _difference_codes()
#: DHT: number of codes of each length 1..16, then the categories by code length.
_DHT = bytes([1] * 9 + [0] * 7) + bytes(range(8, -1, -1))


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


_HEAD = b"\xff\xd8" + _segment(0xC4, b"\x00" + _DHT)
_SCAN = _segment(0xDA, b"\x01\x01\x00\x01\x00\x00")


def encode_frames(samples: np.ndarray) -> list[bytes]:
    """JPEG files of frames, an array (frames, rows, WIDTH) of uint8."""
    n, rows, width = samples.shape
    x = samples.astype(np.int16)
    diff = np.empty_like(x)
    diff[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
    diff[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
    diff[:, 0, 0] = x[:, 0, 0] - 128
    fields = FIELD_OF[diff.reshape(n, -1) + 255].reshape(n, -1, 8).astype(np.uint16)
    packed = np.zeros((n, fields.shape[1], 9), np.uint8)  # eight fields fill nine bytes
    for k in range(8):
        packed[:, :, k] |= (fields[:, :, k] >> (k + 1)).astype(np.uint8)
        packed[:, :, k + 1] |= (fields[:, :, k] << (7 - k)).astype(np.uint8)
    head = _HEAD + _segment(0xC3, struct.pack(">BHHB3B", 8, rows, width, 1, 1, 0x11, 0)) + _SCAN
    return [head + row.tobytes().replace(b"\xff", b"\xff\x00") + b"\xff\xd9" for row in packed]


#: The standard's Huffman tables for luma and chroma (T.81, K.3 to K.6), which MJPG frames may
#: leave out, as numbers of codes by length, and the symbols of the DC tables.
STANDARD_DC = ([0, 1, 5, 1, 1, 1, 1, 1, 1], [0, 3, 1, 1, 1, 1, 1, 1, 1, 1, 1])
STANDARD_AC = ([0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125], [0, 2, 1, 2, 4, 4, 3, 4, 7, 5, 4, 4, 0, 1, 2, 119])
#: The symbols of the AC tables, in hexadecimal.
STANDARD_AC_SYMBOLS = (
    "01020300041105122131410613516107227114328191a1082342b1c11552d1f02433627282090a161718191a25262728292a3435363738393a43444546474849"
    "4a535455565758595a636465666768696a737475767778797a838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6b7b8b9bac2c3c4c5"
    "c6c7c8c9cad2d3d4d5d6d7d8d9dae1e2e3e4e5e6e7e8e9eaf1f2f3f4f5f6f7f8f9fa",
    "000102031104052131061241510761711322328108144291a1b1c109233352f0156272d10a162434e125f11718191a262728292a35363738393a434445464748"
    "494a535455565758595a636465666768696a737475767778797a82838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6b7b8b9bac2c3"
    "c4c5c6c7c8c9cad2d3d4d5d6d7d8d9dae2e3e4e5e6e7e8e9eaf2f3f4f5f6f7f8f9fa",
)


def _codes(counts: list[int] | bytes, symbols: list[int] | bytes) -> dict[tuple[int, int], int]:
    """Symbols by (length, code) of a canonical Huffman table."""
    out, code, k = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out[length, code] = symbols[k]
            code, k = code + 1, k + 1
        code <<= 1
    return out


def standard_tables() -> dict[tuple[int, int], dict]:
    """By (class, number): DC and AC for luma and chroma."""
    return {(c, n): _codes(STANDARD_AC[n], bytes.fromhex(STANDARD_AC_SYMBOLS[n])) if c else _codes(STANDARD_DC[n], range(12)) for c in (0, 1) for n in (0, 1)}


class _Bits:
    """The entropy-coded bits of one restart interval."""

    def __init__(self, data: bytes):
        self.data, self.at, self.value, self.n = data, 0, 0, 0

    def take(self, n: int) -> int:
        while self.n < n:
            if self.at > len(self.data) + 8:
                raise ValueError("a frame that ends early")
            byte = self.data[self.at] if self.at < len(self.data) else 255
            self.at, self.value, self.n = self.at + 1, (self.value << 8 | byte) & (1 << 40) - 1, self.n + 8
        self.n -= n
        return self.value >> self.n & (1 << n) - 1

    def symbol(self, table: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.take(1)
            if (found := table.get((length, code))) is not None:
                return found
        raise ValueError("a code that the table lacks")

    def signed(self, size: int) -> int:
        x = self.take(size) if size else 0
        return x if not size or x >> size - 1 else x - (1 << size) + 1


def _zigzag() -> np.ndarray:
    """The place in an 8 x 8 block of each coefficient in its order in the file."""
    return np.array(sorted(range(64), key=lambda p: (p // 8 + p % 8, (p // 8 if (p // 8 + p % 8) % 2 else p % 8))))


def _cosines() -> np.ndarray:
    x = np.arange(8)
    c = np.cos((2 * x[None, :] + 1) * x[:, None] * np.pi / 16) / 2
    c[0] /= np.sqrt(2)
    return c


ZIGZAG, COSINES = _zigzag(), _cosines()


def decode_frame(jpeg: bytes) -> np.ndarray:
    """The samples (rows, columns) of an intra frame: its only component, or the first one, luma."""
    if jpeg[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG frame")
    at, kind_of, frame, own, found, quant, restart = 2, None, None, False, {}, {}, 0
    while True:
        mark, kind, size = struct.unpack_from(">BBH", jpeg, at)
        if mark != 0xFF:
            raise ValueError("broken JPEG segment")
        body = jpeg[at + 4 : at + 2 + size]
        if kind in (0xC0, 0xC1, 0xC3):
            bits, rows, width, n = struct.unpack_from(">BHHB", body)
            if bits != 8:
                raise ValueError("samples of 8 bits only")
            kind_of, frame = kind, (rows, width, [(body[k], body[k + 1] >> 4, body[k + 1] & 15, body[k + 2]) for k in range(6, 6 + 3 * n, 3)])
        elif kind == 0xC4:
            own = body[1:] == _DHT
            k = 0
            while k < len(body):
                counts = body[k + 1 : k + 17]
                found[body[k] >> 4, body[k] & 15] = _codes(counts, body[k + 17 : k + 17 + sum(counts)])
                k += 17 + sum(counts)
        elif kind == 0xDB:
            k = 0
            while k < len(body):
                wide = body[k] >> 4
                quant[body[k] & 15] = np.frombuffer(body[k + 1 : k + 65 + 64 * wide], ">u2" if wide else "u1").astype(np.int64)
                k += 65 + 64 * wide
        elif kind == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif 0xC0 <= kind <= 0xCF and kind != 0xC8:
            raise ValueError("neither a baseline nor a lossless frame")
        at += 2 + size
        if kind == 0xDA:
            break
    if frame is None:
        raise ValueError("no frame header")
    end = jpeg.rfind(b"\xff\xd9")
    data = jpeg[at : end if end >= at else len(jpeg)]
    scan = {body[1 + 2 * k]: (body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])}
    predictor = body[1 + 2 * body[0]]
    rows, width, components = frame
    if kind_of == 0xC3 and own and predictor == 1 and len(components) == 1 and not restart and rows * width % 8 == 0:
        return _own_samples(data, rows, width)
    tables = standard_tables() | found
    parts = [_Bits(x.replace(b"\xff\x00", b"\xff")) for x in _intervals(data)]
    if kind_of == 0xC3:
        return _lossless(parts, restart, rows, width, components, scan, tables, predictor)
    return _baseline(parts, restart, rows, width, components, scan, tables, quant)


def _intervals(data: bytes) -> list[bytes]:
    """The data between restart markers."""
    out, begin, at = [], 0, data.find(b"\xff")
    while at >= 0:
        if at + 1 < len(data) and 0xD0 <= data[at + 1] <= 0xD7:
            out.append(data[begin:at])
            begin = at + 2
        at = data.find(b"\xff", at + 2)
    return [*out, data[begin:]]


def _baseline(parts: list[_Bits], restart: int, rows: int, width: int, components: list, scan: dict, tables: dict, quant: dict) -> np.ndarray:
    one = len(components) == 1
    across, down = max(c[1] for c in components), max(c[2] for c in components)
    wide, high = (-(-width // 8), -(-rows // 8)) if one else (-(-width // (8 * across)), -(-rows // (8 * down)))
    _, first_h, first_v, first_q = components[0]
    h, v = (1, 1) if one else (first_h, first_v)
    blocks, bits = np.zeros((high * v, wide * h, 64), np.int64), parts[0]
    before = [0] * len(components)
    for unit in range(wide * high):
        if restart and unit and unit % restart == 0:
            bits, before = parts[min(unit // restart, len(parts) - 1)], [0] * len(components)
        for n, (name, ch, cv, _) in enumerate(components):
            dc, ac = (tables[c, scan[name][c]] for c in (0, 1))
            for k in range(1 if one else ch * cv):
                before[n] += bits.signed(bits.symbol(dc))
                block, at = [0] * 64, 1
                block[0] = before[n]
                while at < 64:
                    symbol = bits.symbol(ac)
                    run, size = symbol >> 4, symbol & 15
                    if not size and run < 15:
                        break
                    at += run
                    if at > 63:
                        raise ValueError("a block of more than 64 coefficients")
                    block[at] = bits.signed(size)
                    at += 1
                if n == 0:
                    blocks[unit // wide * v + k // h, unit % wide * h + k % h] = block
    square = np.zeros_like(blocks)
    square[:, :, ZIGZAG] = blocks * quant[first_q]
    square = square.reshape(*square.shape[:2], 8, 8)
    samples = np.einsum("ux,abuv,vy->axby", COSINES, square, COSINES) + 128
    samples = np.clip(np.rint(samples), 0, 255).astype(np.uint8).reshape(high * v * 8, wide * h * 8)
    if (h, v) != (across, down) and not one:
        samples = samples.repeat(down // v, 0).repeat(across // h, 1)
    return samples[:rows, :width]


def _lossless(parts: list[_Bits], restart: int, rows: int, width: int, components: list, scan: dict, tables: dict, predictor: int) -> np.ndarray:
    if any(c[1:3] != components[0][1:3] for c in components) or not 1 <= predictor <= 7:
        raise ValueError("a lossless frame of another kind")
    out, bits = np.zeros((len(components), rows, width), np.int64), parts[0]
    for y in range(rows):
        fresh = y == 0 or restart and y * width % restart == 0
        if restart and y and fresh:
            bits = parts[min(y * width // restart, len(parts) - 1)]
        for x in range(width):
            for n, (name, *_) in enumerate(components):
                a, b, c = out[n, y, x - 1] if x else 0, out[n, y - 1, x] if y else 0, out[n, y - 1, x - 1] if x and y else 0
                if fresh:
                    guess = a if x else 128
                elif not x:
                    guess = b
                else:
                    guess = (a, b, c, a + b - c, a + (b - c >> 1), b + (a - c >> 1), a + b >> 1)[predictor - 1]
                size = bits.symbol(tables[0, scan[name][0]])
                out[n, y, x] = guess + (32768 if size == 16 else bits.signed(size)) & 0xFFFF
    return out[0].astype(np.uint8)


def _own_samples(data: bytes, rows: int, width: int) -> np.ndarray:
    """The samples of frames as encode_frames writes them: nine bits each."""
    packed = np.frombuffer(data.replace(b"\xff\x00", b"\xff"), np.uint8)
    packed = packed.reshape(-1, 9).astype(np.uint16)
    fields = np.empty((len(packed), 8), np.uint16)
    for k in range(8):
        fields[:, k] = ((packed[:, k] << (k + 1)) | (packed[:, k + 1] >> (7 - k))) & 511
    diff = DIFF_OF[fields].reshape(rows, width).astype(np.int32)
    diff[0, 0] += 128
    diff[:, 0] = np.cumsum(diff[:, 0])
    return np.cumsum(diff, axis=1).astype(np.uint8)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def _list(name: bytes, body: bytes) -> bytes:
    return _chunk(b"LIST", name + body)


def write_avi(payload: bytes, n_bytes: int) -> bytes:
    """An AVI file (RIFF: hdrl, movi, idx1) that holds the payload; its stream data (strd) has the lengths."""
    rows = len(payload) // WIDTH
    height = min(ROWS, rows)
    n = -(-rows // height)
    samples = np.frombuffer(payload.ljust(n * height * WIDTH, b"\0"), np.uint8).reshape(n, height, WIDTH)
    frames = encode_frames(samples)
    largest = max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // FPS, largest * FPS, 0, 0x10, n, 0, 1, largest, WIDTH, height, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIIIHHHH", b"vids", b"MJPG", 0, 0, 0, 0, 1, FPS, 0, n, largest, 0, 0, 0, 0, WIDTH, height)
    strf = struct.pack("<IiiHH4sIiiII", 40, WIDTH, height, 1, 8, b"MJPG", WIDTH * height, 0, 0, 0, 0)
    strd = struct.pack("<QQ", len(payload), n_bytes)
    hdrl = _list(b"hdrl", _chunk(b"avih", avih) + _list(b"strl", _chunk(b"strh", strh) + _chunk(b"strf", strf) + _chunk(b"strd", strd)))
    movi, index, at = [], [], 4
    for frame in frames:
        movi.append(c := _chunk(b"00dc", frame))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(frame)))
        at += len(c)
    body = b"AVI " + hdrl + _list(b"movi", b"".join(movi)) + _chunk(b"idx1", b"".join(index))
    return b"RIFF" + struct.pack("<I", len(body)) + body


def _chunks(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    while at + 8 <= end:
        name, size = struct.unpack_from("<4sI", data, at)
        yield name, at + 8, size
        at += 8 + size + size % 2


def read_avi(data: bytes) -> tuple[np.ndarray, bytes, int, int]:
    """Frames (frames, rows, columns), the payload, its unpadded length and the frames a second; frames by the
    index. Files of other writers, which don't tell a payload's length, have an empty one."""
    if data is None or data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    movi, index, lengths, fps = 0, [], (0, 0), FPS
    todo = [(12, len(data))]
    while todo:
        for name, at, size in _chunks(data, *todo.pop()):
            if name == b"LIST" and data[at : at + 4] == b"movi":
                movi = at
            elif name == b"LIST":
                todo.append((at + 4, at + size))
            elif name == b"idx1":
                index = [struct.unpack_from("<4sIII", data, p) for p in range(at, at + size, 16)]
            elif name == b"strd":
                lengths = struct.unpack_from("<QQ", data, at)
            elif name == b"strh":
                scale, rate = struct.unpack_from("<II", data, at + 20)
                fps = rate // max(1, scale)
    if not movi or not index:
        raise ValueError("no frames or no index")
    index = [x for x in index if x[0][2:] in (b"dc", b"db") and x[3]]
    base = movi if index and data[movi + index[0][2] : movi + index[0][2] + 4] == index[0][0] else 0  # places count from movi, or from the file's start
    frames = np.stack([decode_frame(data[base + off + 8 : base + off + 8 + size]) for _, _, off, size in index])
    return frames, frames.tobytes()[: lengths[0]], lengths[1], fps


def histograms(frames: np.ndarray, bins: int = 16) -> np.ndarray:
    """The grey histogram of each frame, as counts."""
    n = len(frames)
    slot = frames.reshape(n, -1) // (256 // bins) + (np.arange(n) * bins)[:, None]
    return np.bincount(slot.ravel(), minlength=n * bins).reshape(n, bins)


def shots(hist: np.ndarray, window: int = 8, factor: float = 2.5, floor: float = 0.05) -> list[int]:
    """First frames of shots. A cut is where the histogram difference exceeds the mean of the
    differences around it (window frames to each side, itself not) plus factor deviations and floor."""
    cuts = [0]
    if len(hist) < 2:
        return cuts
    diff = np.abs(np.diff(hist, axis=0)).sum(1) / (2.0 * hist[0].sum())
    for k in range(len(diff)):
        near = np.concatenate([diff[max(0, k - window) : k], diff[k + 1 : k + 1 + window]])
        mean, dev = (near.mean(), near.std()) if len(near) else (0.0, 0.0)
        if diff[k] > mean + factor * dev + floor:
            cuts.append(k + 1)
    return cuts


def clips(frames: np.ndarray, fps: int) -> list[tuple[int, float, float, int, int]]:
    """Timed clips: number, start and end in seconds, first frame, frames."""
    cuts = shots(histograms(frames))
    ends = [*cuts[1:], len(frames)]
    return [(k, a / fps, b / fps, a, b - a) for k, (a, b) in enumerate(zip(cuts, ends, strict=True))]


STORED = "doc_id long, n_bytes long, media binary"
CLIPS = "doc_id long, clip int, start_s double, end_s double, first_frame int, n_frames int, mean_level double, error string"
#: What reading a broken file may raise.
BROKEN = (ValueError, KeyError, IndexError, struct.error)


def read_or_error(data: bytes | None) -> tuple[tuple | None, str | None]:
    try:
        return read_avi(data), None
    except BROKEN as e:
        return None, f"{type(e).__name__}: {e}"


def store_texts(docs: DataFrame) -> DataFrame:
    """Each text as an AVI file: doc_id, n_bytes, media."""
    arrow_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            raw = [t.encode() for t in b.column(1).to_pylist()]
            media = [write_avi(x.ljust(max(1, -(-len(x) // 64)) * 64, b"\0"), len(x)) for x in raw]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, STORED)


def clip_rows(stored: DataFrame) -> DataFrame:
    """One row for each clip of each file, with its times and mean grey level; one with error for a file that
    can't be read."""

    def run(batches):
        for b in batches:
            rows = []
            for i, media in zip(b.column("doc_id").to_pylist(), b.column("media").to_pylist(), strict=True):
                read, error = read_or_error(media)
                if read is None:
                    rows.append((i, *[None] * 6, error))
                    continue
                frames, _, _, fps = read
                rows += [(i, *c, float(frames[c[3] : c[3] + c[4]].mean()), None) for c in clips(frames, fps)]
            names = ["doc_id", "clip", "start_s", "end_s", "first_frame", "n_frames", "mean_level", "error"]
            kinds = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return stored.mapInArrow(run, CLIPS)


def media_digest(stored: DataFrame) -> DataFrame:
    """What the stored files hold, read back: lengths, digests, and a feature string
    (frames, clips' lengths, and the whole file's grey histogram in per mille)."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_clips int, error string"

    def run(batches):
        for b in batches:
            rows = []
            for i, media in zip(b.column("doc_id").to_pylist(), b.column("media").to_pylist(), strict=True):
                read, error = read_or_error(media)
                if read is None:
                    rows.append((i, *[None] * 4, None if media is None else len(media), None if media is None else hashlib.sha256(media).hexdigest(), None, None, error))
                    continue
                frames, payload, n_bytes, fps = read
                found = clips(frames, fps)
                total = histograms(frames).sum(0)
                feature = f"frames={len(frames)};clips={','.join(str(c[4]) for c in found)};hist={','.join(str(int(1000 * x // total.sum())) for x in total)}"
                rows.append((i, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature, len(found), None))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string()]
            names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_clips", "error"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return stored.mapInArrow(run, schema)
