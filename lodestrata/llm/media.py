"""Media columns: progressive JPEG.

``encode`` stores bytes losslessly as the quantised coefficients of a 4:2:0 progressive JPEG (all
quantisers 1): byte v is AC coefficient 256 + v, 63 to a block, blocks of Y, Cb and Cr in turn. The
file has a DC scan, for each component two spectral bands without their lowest bit, and one successive
approximation scan that adds it. Every coefficient of these files has the same size category, so scans
of them have a fixed layout.

``decode`` accumulates the scans of any baseline-free progressive JPEG (8 bits, Huffman) into
coefficient arrays. Scans in the fixed layout are read as bit matrices, after a check of every code;
all others bit by bit. ``to_rgb`` inverse-transforms with numpy, doubles chroma and converts to RGB.

Null text is empty text; it and all others get zero bytes up to a positive multiple of 64, so there is
always a picture. Equal texts have equal files, tensors and features; repeated rows are rows of their
own; an empty table gives no rows. Other columns are ignored. A text's bytes are cut into frames of FRAME,
a picture each, whose files stand one after the other; so the arrays of one picture, some 30 times its
bytes, are all that a text needs beside its bytes, its file and, where they are asked for, its tensors.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import arrow_rows

#: Order in which a block's 64 coefficients are stored: along anti-diagonals of the 8 x 8 square, turning at its edges.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))
AC, BIAS, MOST_RUN = 63, 256, 32767
#: Bytes to a picture, a multiple of 64.
FRAME = 1 << 20
BLOCKS_MCU = 6
#: Code lengths -> symbols. One bit for "next coefficient, 8 bits"; five for end-of-band runs.
DC_TABLE = {1: [0], 4: list(range(1, 8))}
AC_TABLE = {1: [0x08], 5: [r << 4 for r in range(15)]}
_BASIS = np.array([[(np.sqrt(0.125) if u == 0 else 0.5) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)], np.float32)


def codes(table: dict[int, list[int]]) -> dict[int, tuple[int, int]]:
    """symbol -> (code, length) of a canonical Huffman table."""
    out, code, before = {}, 0, 0
    for length in sorted(table):
        code <<= length - before
        for symbol in table[length]:
            out[symbol] = (code, length)
            code += 1
        before = length
    return out


def shape(n_blocks: int) -> tuple[int, int]:
    """Columns and rows of 16 x 16 units that hold so many blocks: nearly square."""
    units = max(1, -(-n_blocks // BLOCKS_MCU))
    wide = min(4095, max(1, int(np.ceil(np.sqrt(units)))))
    return wide, -(-units // wide)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _huffman(kind: int, table: dict[int, list[int]]) -> bytes:
    return bytes([kind]) + bytes(len(table.get(i, ())) for i in range(1, 17)) + bytes(x for i in sorted(table) for x in table[i])


def _scan_header(parts: list[int], first: int, last: int, high: int, low: int) -> bytes:
    return _segment(0xDA, bytes([len(parts), *(x for c in parts for x in (c, 0)), first, last, high << 4 | low]))


_HEAD = b"\xff\xd8" + _segment(0xDB, bytes([0]) + b"\x01" * 64) + _segment(0xC4, _huffman(0x00, DC_TABLE) + _huffman(0x10, AC_TABLE))
_BANDS = ((1, 5), (6, 63))


def _frame(wide: int, high: int) -> bytes:
    return _segment(0xC2, struct.pack(">BHHB", 8, high * 16, wide * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))


def _parts(units: int) -> list[tuple[int, int]]:
    """First block and number of blocks of Y, Cb and Cr."""
    return [(0, 4 * units), (4 * units, units), (5 * units, units)]


def _runs(n: int) -> list[int]:
    return [MOST_RUN] * (n // MOST_RUN) + ([n % MOST_RUN] if n % MOST_RUN else [])


def _bits(value: int, width: int) -> list[int]:
    return [value >> (width - 1 - i) & 1 for i in range(width)]


def _run_prefix(n: int) -> list[int]:
    """Bits that say that a band's next n blocks add no coefficient."""
    r = n.bit_length() - 1
    code, length = codes(AC_TABLE)[r << 4]
    return _bits(code, length) + _bits(n - (1 << r), r)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as bytes, the last one filled with ones."""
    short = -bits.shape[1] % 8
    return np.packbits(np.concatenate([bits, np.ones((len(bits), short), np.uint8)], axis=1) if short else bits, axis=1)


def encode(payloads: list[bytes]) -> list[bytes]:
    """A JPEG file for each payload; payloads of one picture shape are coded together."""
    out: list[bytes] = [b""] * len(payloads)
    shapes = defaultdict(list)
    for i, p in enumerate(payloads):
        shapes[shape(-(-len(p) // AC))].append(i)
    for (wide, high), members in shapes.items():
        units = wide * high
        room = units * BLOCKS_MCU * AC
        for at in range(0, len(members), max(1, (1 << 20) // room)):
            group = members[at : at + max(1, (1 << 20) // room)]
            flat = np.frombuffer(b"".join(payloads[i].ljust(room, b"\0") for i in group), np.uint8)
            block = flat.reshape(len(group), units * BLOCKS_MCU, AC)
            scans: list[tuple[bytes, np.ndarray]] = [(_scan_header([1, 2, 3], 0, 0, 0, 0), _packed(np.zeros((len(group), units * BLOCKS_MCU), np.uint8)))]
            for c, (first, n) in enumerate(_parts(units)):
                mine = block[:, first : first + n]
                for lo, hi in _BANDS:
                    band = (mine[:, :, lo - 1 : hi] >> 1) | 0x80
                    bits = np.concatenate([np.zeros((*band.shape, 1), np.uint8), np.unpackbits(band[..., None], axis=3)], axis=3)
                    scans.append((_scan_header([c + 1], lo, hi, 0, 1), _packed(bits.reshape(len(group), -1))))
                low, part, done = mine & 1, [], 0
                for run in _runs(n):
                    part += [np.tile(np.array(_run_prefix(run), np.uint8), (len(group), 1)), low[:, done : done + run].reshape(len(group), -1)]
                    done += run
                scans.append((_scan_header([c + 1], 1, 63, 1, 0), _packed(np.concatenate(part, axis=1))))
            head = _HEAD + _frame(wide, high)
            for k, i in enumerate(group):
                out[i] = b"".join([head, *(x for h, data in scans for x in (h, data[k].tobytes().replace(b"\xff", b"\xff\0"))), b"\xff\xd9"])
    return out


_MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")


def _parsed(data: bytes, at: int = 0) -> dict:
    """Frame, tables and scans (with the tables then in force) of the file that begins at ``at``, and where it ends."""
    if data[at : at + 2] != b"\xff\xd8":
        raise ValueError("no JPEG file")
    at, out, tables, quant = at + 2, {"scans": []}, {}, {}
    while at < len(data):
        marker = data[at + 1]
        if marker == 0xD9:
            at += 2
            break
        size = struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xC2:
            depth, high, wide, n = struct.unpack_from(">BHHB", body)
            if depth != 8:
                raise ValueError("8 bits only")
            out |= {"high": high, "wide": wide, "parts": [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]}
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("progressive Huffman files only")
        elif marker == 0xC4:
            while body:
                counts, table, k = body[1:17], {}, 17
                for i, n in enumerate(counts):
                    if n:
                        table[i + 1] = list(body[k : k + n])
                        k += n
                tables[body[0]] = table
                body = body[k:]
        elif marker == 0xDB:
            while body:
                wide16 = body[0] >> 4
                n = 128 if wide16 else 64
                quant[body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if wide16 else np.uint8).astype(np.int32)
                body = body[1 + n :]
        elif marker == 0xDD and body != b"\0\0":
            raise ValueError("restart intervals are not supported")
        elif marker == 0xDA:
            n = body[0]
            found = _MARKER.search(data, at)
            end = found.start() if found else len(data)
            which = [(body[1 + 2 * i], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(n)]
            out["scans"].append((which, body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15, data[at:end].replace(b"\xff\0", b"\xff"), dict(tables)))
            at = end
    return out | {"quant": quant, "end": at}


class _Reader:
    """Bit by bit reading of one scan."""

    def __init__(self, data: bytes):
        self.bits, self.at = np.unpackbits(np.frombuffer(data, np.uint8)).tolist(), 0

    def take(self, n: int) -> int:
        value = 0
        for bit in self.bits[self.at : self.at + n]:
            value = value << 1 | bit
        self.at += n
        return value

    def symbol(self, known: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.bits[self.at]
            self.at += 1
            if (code, length) in known:
                return known[code, length]
        raise ValueError("bad code")

    def signed(self, size: int) -> int:
        value = self.take(size)
        return value if not size or value >> (size - 1) else value - (1 << size) + 1


def _slow_scan(coef: dict[int, np.ndarray], scan: tuple, grid: dict[int, tuple], mcu: tuple[int, int]) -> None:
    """Adds one scan to the coefficients, by the format's general procedure."""
    which, first, last, high, low, data, tables = scan
    read = _Reader(data)
    known = {(kind, t): {v: k for k, v in codes(table).items()} for x, table in tables.items() for kind, t in [(x >> 4, x & 15)]}
    if first == 0:
        order = []
        if len(which) == 1:  # a component alone is read by rows of its own blocks
            _, across, stride, down, _, _ = grid[which[0][0]]
            order = [(0, r * stride + c) for r in range(down) for c in range(across)]
        else:
            for my in range(mcu[1]):
                for mx in range(mcu[0]):
                    for i, (c, _, _) in enumerate(which):
                        h, v, stride = grid[c][4], grid[c][5], grid[c][2]
                        order += [(i, (my * v + y) * stride + mx * h + x) for y in range(v) for x in range(h)]
        before = [0] * len(which)
        for i, b in order:
            c, dc, _ = which[i]
            if high == 0:
                before[i] += read.signed(read.symbol(known[0, dc]))
                coef[c][b, 0] = before[i] << low
            elif read.take(1):
                coef[c][b, 0] |= 1 << low
        return
    (c, _, ac), run, one = which[0], 0, 1 << low
    table = known[1, ac]
    _, across, stride, down, _, _ = grid[c]
    for b in (r * stride + x for r in range(down) for x in range(across)):
        block, k = coef[c][b], first

        def refine(j: int, block=block) -> None:
            if read.take(1) and not int(block[j]) & one:
                block[j] += one if block[j] > 0 else -one

        if run == 0:
            while k <= last:
                symbol = read.symbol(table)
                zeros, size = symbol >> 4, symbol & 15
                if size == 0 and zeros < 15:
                    run = (1 << zeros) + read.take(zeros)
                    break
                if high == 0:
                    k += zeros
                    if size:
                        block[k] = read.signed(size) * one
                    k += 1
                    continue
                value = (one if read.take(1) else -one) if size else 0
                while k <= last:
                    if block[k]:
                        refine(k)
                    elif zeros == 0:
                        break
                    else:
                        zeros -= 1
                    k += 1
                if value and k <= last:
                    block[k] = value
                k += 1
        if run:
            if high:
                for j in range(k, last + 1):
                    if block[j]:
                        refine(j)
            run -= 1


def _fixed_scan(coef: dict[int, np.ndarray], scan: tuple) -> bool:
    """Adds one scan if all its codes are where the fixed layout has them; else leaves all as it is."""
    which, first, last, high, low, data, tables = scan
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    if first == 0:
        n = sum(len(coef[c]) for c, _, _ in which)
        if high or any(tables.get(t) != DC_TABLE for _, t, _ in which) or len(bits) != n + -n % 8 or bits[:n].any():
            return False
        return True
    c, _, ac = which[0]
    block, span = coef[c], last - first + 1
    if tables.get(0x10 | ac) != AC_TABLE:
        return False
    if high == 0:
        n = len(block) * span * 9
        if low > 6 or len(bits) != n + -n % 8:
            return False
        cells = bits[:n].reshape(-1, 9)
        if cells[:, 0].any() or not cells[:, 1].all():
            return False
        block[:, first : last + 1] = np.packbits(cells[:, 1:], axis=1).reshape(-1, span).astype(np.int16) << low
        return True
    old = block[:, first : last + 1]
    if (old <= 0).any() or high != low + 1:
        return False
    at, done, parts = 0, 0, []
    for run in _runs(len(block)):
        prefix = _run_prefix(run)
        if bits[at : at + len(prefix)].tolist() != prefix or at + len(prefix) + run * span > len(bits):
            return False
        at += len(prefix)
        parts.append(bits[at : at + run * span].reshape(run, span))
        at, done = at + run * span, done + run
    old |= np.concatenate(parts).astype(np.int16) << low
    return True


def decode(data: bytes, fast: bool = True, at: int = 0) -> dict:
    """Coefficients (zigzag order) by component of the file that begins at ``at``, and what to_rgb needs besides."""
    f = _parsed(data, at)
    most_h, most_v = max(p[1] for p in f["parts"]), max(p[2] for p in f["parts"])
    mcu = -(-f["wide"] // (8 * most_h)), -(-f["high"] // (8 * most_v))
    grid, coef = {}, {}
    for c, h, v, _ in f["parts"]:
        across, down = -(-(-(-f["wide"] * h // most_h)) // 8), -(-(-(-f["high"] * v // most_v)) // 8)
        grid[c] = (c, across, mcu[0] * h, down, h, v)
        coef[c] = np.zeros((mcu[0] * h * mcu[1] * v, 64), np.int16)
    for scan in f["scans"]:
        if not (fast and _fixed_scan(coef, scan)):
            _slow_scan(coef, scan, grid, mcu)
    return f | {"coef": coef, "grid": grid, "mcu": mcu}


def payload(picture: dict) -> bytes:
    """The bytes that encode() stored."""
    return b"".join((x[:, 1:] - BIAS).astype(np.uint8).tobytes() for x in picture["coef"].values())


def to_rgb(picture: dict) -> np.ndarray:
    """Full-resolution height x width x 3 tensor."""
    planes, (most_h, most_v) = [], (max(g[4] for g in picture["grid"].values()), max(g[5] for g in picture["grid"].values()))
    natural = np.empty(64, np.int64)
    natural[ZIGZAG] = np.arange(64)
    for c, _, _, q in picture["parts"]:
        _, _, stride, _, h, v = picture["grid"][c]
        x = (picture["coef"][c] * picture["quant"][q]).astype(np.float32)[:, natural].reshape(-1, 8)
        x = (x @ _BASIS).reshape(-1, 8, 8).transpose(0, 2, 1).reshape(-1, 8) @ _BASIS
        x = x.reshape(-1, stride, 8, 8).transpose(0, 3, 1, 2).reshape(-1, stride * 8) + 128
        planes.append(x.repeat(most_v // v, axis=0).repeat(most_h // h, axis=1) if (h, v) != (most_h, most_v) else x)
    y = planes[0]
    if len(planes) == 1:
        rgb = np.stack([y] * 3, axis=2)
    else:
        cb, cr = planes[1] - 128, planes[2] - 128
        rgb = np.stack([y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb], axis=2)
    return np.clip(np.rint(rgb), 0, 255).astype(np.uint8)[: picture["high"], : picture["wide"]]


def pictures(data: bytes) -> Iterator[dict]:
    """The decoded pictures of files that stand one after the other."""
    at = 0
    while at < len(data):
        picture = decode(data, at=at)
        yield picture
        at = picture["end"]


def tally(rgb: np.ndarray) -> np.ndarray:
    """Sums of the channels, numbers of pixels at 4 brightness levels: these add up over pictures."""
    return np.r_[rgb.reshape(-1, 3).sum(0, dtype=np.int64), np.bincount(rgb[..., 1].ravel() >> 6, minlength=4)]


def feature(total: np.ndarray) -> str:
    """Means of the channels, and shares of 4 brightness levels, in thousandths, from a tally."""
    n = total[3:].sum()
    return ",".join(str(int(x)) for x in (*(total[:3] * 1000 // (255 * n)), *(total[3:] * 1000 // n)))


def media_columns(docs: DataFrame, tensors: bool = True) -> DataFrame:
    """One row per document: the file, the payload as read back, the feature of its pixels and, if asked for, the pictures' tensors."""
    arrow_rows(docs.sparkSession)
    picture = pa.struct([("height", pa.int32()), ("width", pa.int32()), ("rgb", pa.binary())])
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media", pa.binary())]
        + [("media_sha256", pa.string()), ("feature", pa.string()), ("pictures", pa.list_(picture))]
    )

    def read(doc_id: int | None, n_bytes: int, n_payload: int, media: bytes) -> tuple:
        digest, tail, left, total, shown = hashlib.sha256(), b"", n_payload, np.zeros(7, np.int64), []
        for one in pictures(media):
            back = payload(one)[: min(left, FRAME)]
            left -= len(back)
            digest.update(back)
            tail = (tail + back)[-64:]
            rgb = to_rgb(one)
            total += tally(rgb)
            if tensors:
                shown.append({"height": rgb.shape[0], "width": rgb.shape[1], "rgb": rgb.tobytes()})
        return doc_id, n_bytes, n_payload - left, digest.hexdigest(), zlib.crc32(tail), media, hashlib.sha256(media).hexdigest(), feature(total), shown

    def rows(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        wanted = [t + b"\0" * (-len(t) % 64 if t else 64) for t in texts]
        files = iter(encode([w[a : a + FRAME] for w in wanted for a in range(0, len(w), FRAME)]))
        media = [b"".join(next(files) for _ in range(0, len(w), FRAME)) for w in wanted]
        cells = [read(i, len(t), len(w), m) for i, t, w, m in zip(ids, texts, wanted, media, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*cells, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held, size = [], [], 0
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                held.append(t.encode())
                size += len(held[-1])
                if size > 4 << 20:
                    yield rows(ids, held)
                    ids, held, size = [], [], 0
            if ids:
                yield rows(ids, held)

    spec = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media binary, media_sha256 string, feature string, pictures array<struct<height:int,width:int,rgb:binary>>"
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, spec)


def media_digest(docs: DataFrame) -> DataFrame:
    m = media_columns(docs, tensors=False)
    return m.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.octet_length("media").cast("long").alias("media_bytes"), "media_sha256", "feature")
