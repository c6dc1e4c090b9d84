"""Media columns: progressive JPEG in and out of binary columns.

``decode`` reads a progressive JPEG: it accumulates the spectral-selection and successive-approximation scans
into coefficient arrays, dequantises, inverse-transforms all blocks at once in numpy, upsamples chroma
and gives the full-resolution RGB tensor. ``encode`` stores bytes as quantised coefficients, one byte a
coefficient, so that the scans carry them without loss.

The encoder's files have halved chroma, as most photographs, so that rendering upsamples it. Its scans use Huffman
tables of one code (every coefficient has the same magnitude class), which makes the entropy-coded data a
fixed layout; scans of that kind are accumulated as arrays, any other scan bit by bit, with the same
coefficients (held by a test). The inverse transform works on integers held in doubles, so results do not depend on how blocks
are batched.

One pass over the rows; nothing is shuffled.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text

UNIT = 192
#: Minimum coded units (16 x 16 pixels: four blocks of luma, one of each chroma) in a row, unless a file needs more; rows that a file can have.
MAX_COLUMNS, MAX_ROWS = 1024, 4095
#: Bytes of text that go into one batch of results at most, unless one row has more.
PART_BYTES = 8 << 20
#: Zigzag order: the natural (row-major) place of each coefficient.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))
SCALE = 13


def _basis() -> np.ndarray:
    """Integers of the 8x8 inverse transform: row (v, u) coefficient to column (y, x) sample."""
    k = np.arange(8)
    b = np.cos((2 * k[None, :] + 1) * k[:, None] * np.pi / 16) / 2
    b[0] /= np.sqrt(2)
    return np.rint(np.einsum("vy,ux->vuyx", b, b).reshape(64, 64) * (1 << SCALE))


BASIS = _basis()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _one_code(table: int, symbol: int) -> bytes:
    """A Huffman table with the one code 0 of one bit."""
    return bytes([table, 1, *[0] * 15, symbol])


def _scan(components: list[tuple[int, int]], first: int, last: int, high: int, low: int) -> bytes:
    body = bytes([len(components)]) + b"".join(bytes(c) for c in components) + bytes([first, last, high << 4 | low])
    return _segment(0xDA, body)


def encode(payload: bytes) -> bytes:
    """A progressive JPEG with halved chroma (4:2:0) that holds ``payload`` (a multiple of 64 bytes) as its coefficients.

    Byte b becomes the coefficient b for b of 128 and more, else b - 255: magnitudes 128 to 255, whose
    additional bits are the byte itself. The payload fills the blocks of luma, then of both chromas, each in
    raster order and each block in zigzag order. Scans of each component: its DC values with a restart after
    each block; its AC values in two spectral bands without their lowest bit; then that bit for all of them.
    """
    blocks = len(payload) // 64
    units = -(-blocks // 6)
    columns = max(min(units, MAX_COLUMNS), -(-units // MAX_ROWS))
    rows = -(-units // columns)
    units = rows * columns
    data = np.zeros((units * 6, 64), np.uint8)
    data[:blocks] = np.frombuffer(payload, np.uint8).reshape(blocks, 64)
    parts = [
        b"\xff\xd8",
        _segment(0xFE, b"payload %d" % len(payload)),
        _segment(0xDB, b"\x00" + b"\x01" * 64),
        _segment(0xC2, struct.pack(">BHHB", 8, rows * 16, columns * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])),
        _segment(0xC4, _one_code(0x00, 8) + _one_code(0x10, 7) + _one_code(0x11, 0)),
    ]
    half = data >> 1
    lowest = np.where(data >= 128, data & 1, ~data & 1)
    lowest[:, 0] = 0
    refined = np.packbits(lowest, axis=1)
    bounds = [0, 4 * units, 5 * units, 6 * units]
    for c in range(3):
        own = slice(bounds[c], bounds[c + 1])
        parts += [_segment(0xDD, b"\x00\x01"), _scan([(c + 1, 0)], 0, 0, 0, 0), _dc_values(data[own, 0]), _segment(0xDD, b"\x00\x00")]
        parts += [_scan([(c + 1, 0x00)], 1, 5, 0, 1), half[own, 1:6].tobytes(), _scan([(c + 1, 0x00)], 6, 63, 0, 1), half[own, 6:].tobytes()]
        parts += [_scan([(c + 1, 0x01)], 1, 63, 1, 0), refined[own].tobytes().replace(b"\xff", b"\xff\x00")]
    return b"".join([*parts, b"\xff\xd9"])


def _dc_values(dc: np.ndarray) -> bytes:
    """Each value after the code 0, padded with ones to two bytes, with stuffed zeros and restart markers between."""
    words = (dc.astype(np.uint16) << 7 | 127).astype(">u2")
    flat = np.empty((len(words), 4), np.uint8)
    flat[:, :2] = words.view(np.uint8).reshape(-1, 2)
    flat[:, 2], flat[:, 3] = 0xFF, 0xD0 + np.arange(len(words)) % 8
    stuffed = flat == 0xFF
    stuffed[:, 2] = False
    stuffed = stuffed.ravel()[:-2]
    out = np.repeat(flat.ravel()[:-2], 1 + stuffed)
    out[(np.cumsum(1 + stuffed) - 1)[stuffed]] = 0
    return out.tobytes()


@dataclass
class Component:
    """One colour component: sampling factors, its quantisation table, blocks and coefficients (zigzag)."""

    ident: int
    h: int
    v: int
    table: int
    across: int = 0
    down: int = 0
    stride: int = 0
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros((0, 64), np.int32))


class Image:
    """A decoded file: coefficients by component, and what is needed to render them."""

    def __init__(self, data: bytes):
        self.quantisation: dict[int, np.ndarray] = {}
        self.huffman: dict[int, dict[tuple[int, int], int]] = {}
        self.components: list[Component] = []
        self.restart = self.width = self.height = 0
        self.comment = b""
        self._read(data)

    def _read(self, data: bytes) -> None:
        if data[:2] != b"\xff\xd8":
            raise ValueError("no JPEG file")
        at = 2
        while at < len(data):
            if data[at] != 0xFF:
                raise ValueError("a marker was expected")
            marker = data[at + 1]
            if marker == 0xD9:
                return
            if marker == 0xFF:
                at += 1
                continue
            size = struct.unpack_from(">H", data, at + 2)[0]
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xDB:
                self._tables(body)
            elif marker == 0xC4:
                self._codes(body)
            elif marker == 0xDD:
                self.restart = struct.unpack(">H", body)[0]
            elif marker == 0xFE:
                self.comment = body
            elif marker == 0xC2:
                self._frame(body)
            elif marker in (0xC0, 0xC1) or 0xC3 <= marker <= 0xCF:
                raise ValueError("only progressive Huffman files are read")
            elif marker == 0xDA:
                end = _SCAN_END.search(data, at)
                stop = end.start() if end else len(data)
                self._scan(body, data[at:stop])
                at = stop

    def _tables(self, body: bytes) -> None:
        while body:
            wide, ident = body[0] >> 4, body[0] & 15
            n = 129 if wide else 65
            self.quantisation[ident] = np.frombuffer(body[1:n], ">u2" if wide else np.uint8).astype(np.int64)
            body = body[n:]

    def _codes(self, body: bytes) -> None:
        while body:
            counts, code, at, codes = body[1:17], 0, 17, {}
            for length, n in enumerate(counts, 1):
                for symbol in body[at : at + n]:
                    codes[length, code] = symbol
                    code += 1
                at += n
                code <<= 1
            self.huffman[body[0]] = codes
            body = body[at:]

    def _frame(self, body: bytes) -> None:
        _, self.height, self.width, n = struct.unpack_from(">BHHB", body)
        self.components = [Component(body[i], body[i + 1] >> 4, body[i + 1] & 15, body[i + 2]) for i in range(6, 6 + 3 * n, 3)]
        self.h, self.v = max(c.h for c in self.components), max(c.v for c in self.components)
        self.units_across, self.units_down = -(-self.width // (8 * self.h)), -(-self.height // (8 * self.v))
        for c in self.components:
            c.across, c.down = -(-self.width * c.h // (8 * self.h)), -(-self.height * c.v // (8 * self.v))
            c.stride = self.units_across * c.h
            c.coefficients = np.zeros((c.stride * self.units_down * c.v, 64), np.int32)

    def _scan(self, head: bytes, data: bytes) -> None:
        n = head[0]
        parts = [(next(c for c in self.components if c.ident == head[1 + 2 * i]), head[2 + 2 * i]) for i in range(n)]
        first, last, high, low = head[1 + 2 * n], head[2 + 2 * n], head[3 + 2 * n] >> 4, head[3 + 2 * n] & 15
        if not self._fixed(parts, data, first, last, high, low):
            self._bit_by_bit(parts, data, first, last, high, low)

    def _fixed(self, parts: list, data: bytes, first: int, last: int, high: int, low: int) -> bool:
        """Decodes a scan of one component whose one-code tables fix its layout; False if it is of another kind."""
        c, table = parts[0]
        if len(parts) != 1 or c.across != c.stride or c.across * c.down != len(c.coefficients):
            return False
        n = len(c.coefficients)
        if first == 0:
            codes = self.huffman.get(table >> 4, {})
            if high or self.restart != 1 or len(codes) != 1:
                return False
            (length, _), width = next(iter(codes.items()))
            size = -(-(length + width) // 8)
            plain = _RESTART.sub(b"", data).replace(b"\xff\x00", b"\xff")
            if len(plain) != n * size or not width:
                return False
            bits = np.unpackbits(np.frombuffer(plain, np.uint8).reshape(n, size), axis=1).astype(np.int32)
            if bits[:, :length].any():
                return False
            c.coefficients[:, 0] = _extended(bits[:, length : length + width] @ (1 << np.arange(width - 1, -1, -1)), width) << low
            return True
        codes = self.huffman.get(0x10 | table & 15, {})
        if self.restart or len(codes) != 1:
            return False
        (length, _), symbol = next(iter(codes.items()))
        band = last - first + 1
        raw = np.frombuffer(data.replace(b"\xff\x00", b"\xff"), np.uint8)
        if not high and 0 < symbol < 16 and length + symbol == 8 and len(raw) == n * band:
            c.coefficients[:, first : last + 1] = _extended(raw.reshape(n, band).astype(np.int32) & ((1 << symbol) - 1), symbol) * (1 << low)
            return bool((raw >> symbol == 0).all())
        if high and symbol == 0 and (length + band) % 8 == 0 and len(raw) * 8 == n * (length + band):
            own = c.coefficients[:, first : last + 1]
            if not own.all():
                return False
            bits = np.unpackbits(raw.reshape(n, -1), axis=1)[:, length:].astype(np.int32)
            own += np.where(own > 0, bits, -bits) << low
            return True
        return False

    def _bit_by_bit(self, parts: list, data: bytes, first: int, last: int, high: int, low: int) -> None:
        """Decodes any progressive scan."""
        pieces = _RESTART.split(data)
        readers = iter(pieces)
        bits = _Bits(next(readers))
        previous, run, count = [0] * len(parts), 0, 0
        for unit in self._units(parts):
            if self.restart and count and count % self.restart == 0:
                bits, previous, run = _Bits(next(readers, b"")), [0] * len(parts), 0
            count += 1
            for i, block in unit:
                c, table = parts[i]
                own = c.coefficients[block]
                if first == 0:
                    if high:
                        own[0] |= bits.take(1) << low
                    else:
                        size = bits.symbol(self.huffman[table >> 4])
                        previous[i] += _extend(bits.take(size), size)
                        own[0] = previous[i] * (1 << low)
                elif high:
                    run = _refine(bits, self.huffman[0x10 | table & 15], own, first, last, low, run)
                elif run:
                    run -= 1
                else:
                    run = _first_pass(bits, self.huffman[0x10 | table & 15], own, first, last, low)

    def _units(self, parts: list):  # noqa: ANN202
        """The blocks of each minimum coded unit as (component of the scan, block)."""
        if len(parts) == 1:
            c = parts[0][0]
            for y in range(c.down):
                for x in range(c.across):
                    yield [(0, y * c.stride + x)]
            return
        for y in range(self.units_down):
            for x in range(self.units_across):
                yield [(i, (y * c.v + b) * c.stride + x * c.h + a) for i, (c, _) in enumerate(parts) for b in range(c.v) for a in range(c.h)]

    def rgb(self) -> np.ndarray:
        """The full-resolution tensor, height x width x 3, of 8 bits."""
        planes = []
        for c in self.components:
            natural = np.zeros((len(c.coefficients), 64))
            natural[:, ZIGZAG] = c.coefficients * self.quantisation[c.table]
            samples = np.floor((natural @ BASIS + (1 << (SCALE - 1))) / (1 << SCALE)) + 128
            plane = np.clip(samples, 0, 255).astype(np.int32).reshape(-1, c.stride, 8, 8).transpose(0, 2, 1, 3).reshape(-1, c.stride * 8)
            if (c.h, c.v) != (self.h, self.v):
                plane = np.repeat(np.repeat(plane, self.v // c.v, axis=0), self.h // c.h, axis=1)
            planes.append(plane[: self.height, : self.width])
        if len(planes) == 1:
            return np.repeat(planes[0][:, :, None], 3, axis=2).astype(np.uint8)
        y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
        half = 1 << 15
        r = y + ((91881 * cr + half) >> 16)
        g = y - ((22554 * cb + 46802 * cr + half) >> 16)
        b = y + ((116130 * cb + half) >> 16)
        return np.clip(np.stack([r, g, b], axis=2), 0, 255).astype(np.uint8)

    def payload(self) -> bytes:
        """The bytes that ``encode`` stored."""
        n = int(self.comment.removeprefix(b"payload "))
        values = np.concatenate([c.coefficients for c in self.components])
        return np.where(values > 0, values, values + 255).astype(np.uint8).tobytes()[:n]


_SCAN_END = re.compile(rb"\xff[^\x00\xd0-\xd7]", re.DOTALL)
_RESTART = re.compile(rb"\xff[\xd0-\xd7]")


def _extended(extra: np.ndarray, size: int) -> np.ndarray:
    return np.where(extra >= 1 << (size - 1), extra, extra - (1 << size) + 1)


def _extend(extra: int, size: int) -> int:
    return extra if not size or extra >= 1 << (size - 1) else extra - (1 << size) + 1


class _Bits:
    """Bits of one entropy-coded segment; past its end come ones."""

    def __init__(self, data: bytes):
        self.bits = np.unpackbits(np.frombuffer(data.replace(b"\xff\x00", b"\xff"), np.uint8)).tolist()
        self.at = 0

    def take(self, n: int) -> int:
        out = 0
        for b in self.bits[self.at : self.at + n]:
            out = out << 1 | b
        self.at += n
        return out

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.take(1)
            if (found := codes.get((length, code))) is not None:
                return found
        raise ValueError("no such code")


def _first_pass(bits: _Bits, codes: dict, own: np.ndarray, first: int, last: int, low: int) -> int:
    """One block of a first AC scan; returns the blocks that the end-of-band run still covers."""
    k = first
    while k <= last:
        run, size = divmod(bits.symbol(codes), 16)
        if size:
            k += run
            own[k] = _extend(bits.take(size), size) * (1 << low)
            k += 1
        elif run == 15:
            k += 16
        else:
            return (1 << run) + bits.take(run) - 1
    return 0


def _refine(bits: _Bits, codes: dict, own: np.ndarray, first: int, last: int, low: int, run: int) -> int:
    """One block of a refining AC scan."""
    step, k = 1 << low, first

    def correct(k: int) -> None:
        if bits.take(1):
            own[k] += step if own[k] > 0 else -step

    if not run:
        while k <= last:
            zeros, size = divmod(bits.symbol(codes), 16)
            value = 0
            if size:
                value = step if bits.take(1) else -step
            elif zeros < 15:
                run = (1 << zeros) + bits.take(zeros)
                break
            while k <= last:
                if own[k]:
                    correct(k)
                elif zeros == 0:
                    if value:
                        own[k] = value
                    k += 1
                    break
                else:
                    zeros -= 1
                k += 1
        if not run:
            return 0
    while k <= last:
        if own[k]:
            correct(k)
        k += 1
    return run - 1


def decode(data: bytes) -> Image:
    """Reads a progressive JPEG file."""
    return Image(data)


def padded(text: str) -> bytes:
    """The text's UTF-8 with spaces up to a positive multiple of 192 bytes."""
    raw = text.encode("utf-8", "replace")
    return raw + b" " * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def feature(image: Image, rgb: np.ndarray) -> str:
    """Features of a picture, as integers: size; each channel's mean and variance and its histogram of eight bins; luma energy by spectral band."""
    flat = rgb.reshape(-1, 3)
    n = len(flat)
    total, square = flat.sum(axis=0, dtype=np.int64), (flat.astype(np.int64) ** 2).sum(axis=0)
    told = [image.height, image.width, *(total // n).tolist(), *(square // n - (total // n) ** 2).tolist()]
    for c in range(3):
        told += np.bincount(flat[:, c] >> 5, minlength=8).tolist()
    energy = (image.components[0].coefficients.astype(np.int64) ** 2).sum(axis=0)
    told += [int(energy[a:b].sum()) // n for a, b in ((0, 1), (1, 6), (6, 28), (28, 64))]
    return ",".join(map(str, told))


def media_columns(docs: DataFrame, key: str = "doc_id", text: str = "text", tensors: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_bytes, media (the file), payload (read back), height, width, feature and, with ``tensors``, rgb.

    Each whole text is stored in a progressive JPEG's coefficients, the file is read again, chroma is
    upsampled, and the tensor is rendered from what was read. Null texts count as empty (one unit of spaces); equal
    texts give equal values; repeated rows repeat; an empty table gives no rows; very long texts are stored
    whole (a file holds over 6 GB, more than a string can); other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text"))
    columns = ["doc_id", "n_bytes", "media", "payload", "height", "width", "feature", *(["rgb"] if tensors else [])]
    kinds = dict(zip(columns, [rows.schema["doc_id"].dataType.simpleString(), "long", "binary", "binary", "int", "int", "string", "binary"]))

    def store(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            done, size = [], 0
            for own, t in zip(batch["doc_id"], batch["text"]):
                payload = padded(t)
                media = encode(payload)
                image = decode(media)
                rgb = image.rgb()
                row = (own, len(t.encode("utf-8", "replace")), media, image.payload(), image.height, image.width, feature(image, rgb))
                done.append((*row, rgb.tobytes()) if tensors else row)
                size += len(payload)
                if size >= PART_BYTES:
                    yield _typed(done, columns, batch)
                    done, size = [], 0
            if done:
                yield _typed(done, columns, batch)

    return rows.mapInPandas(store, ", ".join(f"{c} {k}" for c, k in kinds.items()))


def _typed(rows: list[tuple], columns: list[str], batch: pd.DataFrame) -> pd.DataFrame:
    """The rows, with keys of the batch's own kind."""
    out = pd.DataFrame(rows, columns=columns)
    if batch["doc_id"].dtype.kind == "f":  # integers with nulls among them
        out["doc_id"] = out["doc_id"].astype("Int64")
    return out


def decode_column(files: DataFrame, key: str, media: str = "media") -> DataFrame:
    """One row per file: key, height, width, rgb, error (null where the file could be read)."""

    def read(batch: pd.Series) -> pd.DataFrame:
        rows = []
        for data in batch:
            try:
                image = decode(data or b"")
                rows.append((image.height, image.width, image.rgb().tobytes(), None))
            except (ValueError, KeyError, IndexError, struct.error, StopIteration) as e:
                rows.append((None, None, None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame({n: pd.Series(c, dtype="Int32" if n in ("height", "width") else object) for n, c in zip(["height", "width", "rgb", "error"], zip(*rows))}) if rows else pd.DataFrame({"height": [], "width": [], "rgb": [], "error": []})

    return files.select(F.col(key), F.pandas_udf(read, "height int, width int, rgb binary, error string")(media).alias("m")).select(key, "m.*")
