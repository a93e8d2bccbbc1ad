"""Encoded images: kind, size, and scaling down of PNG and GIF images."""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np

# Kinds that are handled, with the bytes they begin with; the most pixels that are decoded; bytes of downloads.
KINDS = ("image/png", "image/jpeg", "image/gif", "image/webp")
MAX_PIXELS = 40_000_000
CEILING = 25 << 20


def image_kind(content_type: str | None, body: bytes) -> str:
    """The image's media type: as declared if that is handled, else by its first bytes, else ''."""
    declared = (content_type or "").split(";", 1)[0].strip().lower()
    if declared in KINDS:
        return declared
    if body.startswith(b"\x89PNG\r\n\x1a\n"):
        return "image/png"
    if body.startswith(b"\xff\xd8\xff"):
        return "image/jpeg"
    if body.startswith((b"GIF87a", b"GIF89a")):
        return "image/gif"
    return "image/webp" if body[:4] == b"RIFF" and body[8:14] == b"WEBPVP" else ""


def _jpeg_size(b: bytes) -> tuple[int, int] | None:
    at = 2
    while at + 9 <= len(b):
        if b[at] != 0xFF:
            return None
        mark = b[at + 1]
        if mark == 0xFF or 0xD0 <= mark <= 0xD9 or mark == 1:
            at += 1 if mark == 0xFF else 2
            continue
        if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
            h, w = struct.unpack(">HH", b[at + 5 : at + 9])
            return w, h
        at += 2 + struct.unpack(">H", b[at + 2 : at + 4])[0]
    return None


def _webp_size(b: bytes) -> tuple[int, int] | None:
    kind = b[12:16]
    if kind == b"VP8X" and len(b) >= 30:
        return 1 + int.from_bytes(b[24:27], "little"), 1 + int.from_bytes(b[27:30], "little")
    if kind == b"VP8 " and len(b) >= 30:
        return int.from_bytes(b[26:28], "little") & 0x3FFF, int.from_bytes(b[28:30], "little") & 0x3FFF
    if kind == b"VP8L" and len(b) >= 25:
        bits = int.from_bytes(b[21:25], "little")
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
    return None


def image_size(body: bytes) -> tuple[int, int] | None:
    """(width, height) from the header alone, whatever type was declared; None if it can't be read."""
    kind = image_kind(None, body)
    if kind == "image/png":
        return struct.unpack(">II", body[16:24]) if body[12:16] == b"IHDR" and len(body) >= 24 else None
    if kind == "image/gif":
        return struct.unpack("<HH", body[6:10]) if len(body) >= 10 else None
    return _jpeg_size(body) if kind == "image/jpeg" else _webp_size(body) if kind == "image/webp" else None


def size_error(w: int, h: int) -> str:
    if w <= 0 or h <= 0:
        return f"invalid image dimensions {w}x{h}"
    return f"image dimensions {w}x{h} exceed the safe decode limit of {MAX_PIXELS} pixels" if w * h > MAX_PIXELS else ""


def scaled_size(w: int, h: int, edge: int) -> tuple[int, int]:
    """The size whose longest edge is ``edge``, never larger and never without extent."""
    longest = max(w, h)
    if longest <= edge or longest == 0:
        return w, h
    return max(1, math.floor(w * (edge / longest) + 0.5)), max(1, math.floor(h * (edge / longest) + 0.5))


#: Channels of PNG's colour types.
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def read_png(body: bytes) -> np.ndarray:
    """The pixels as (height, width, 4) of red, green, blue, alpha, 0 to 255; ValueError for what isn't a plain PNG."""
    at, data, palette, alpha, head = 8, [], None, None, None
    while at + 8 <= len(body):
        n, kind = struct.unpack(">I4s", body[at : at + 8])
        chunk = body[at + 8 : at + 8 + n]
        at += 12 + n
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif kind == b"tRNS":
            alpha = chunk
        elif kind == b"IDAT":
            data.append(chunk)
        elif kind == b"IEND":
            break
    if head is None or head[6] != 0 or head[3] not in _CHANNELS or size_error(head[0], head[1]):
        raise ValueError("no PNG that can be read")
    w, h, depth, colour = head[:4]
    channels = _CHANNELS[colour]
    stride, step = (w * channels * depth + 7) // 8, max(1, channels * depth // 8)
    inflate = zlib.decompressobj()
    raw = inflate.decompress(b"".join(data), h * (stride + 1))
    if len(raw) < h * (stride + 1):
        raise ValueError("PNG is cut off")
    lines = np.frombuffer(raw, np.uint8).reshape(h, stride + 1)
    out = np.zeros((h, stride), np.uint8)
    above = np.zeros(stride, np.uint8)
    for y in range(h):
        out[y] = above = _unfilter(lines[y, 0], lines[y, 1:], above, step)
    if depth == 16:
        values = out.reshape(h, w, channels, 2)[..., 0]
    elif depth == 8:
        values = out.reshape(h, w, channels)
    else:
        bits = np.unpackbits(out, axis=1)[:, : w * depth].reshape(h, w, depth)
        values = (bits * (1 << np.arange(depth - 1, -1, -1))).sum(axis=2, dtype=np.uint8)[..., None]
        if colour == 0:
            values = (values.astype(np.uint16) * 255 // ((1 << depth) - 1)).astype(np.uint8)
    rgba = np.full((h, w, 4), 255, np.uint8)
    if colour == 3:
        if palette is None or int(values.max(initial=0)) >= len(palette):
            raise ValueError("PNG without its palette")
        rgba[..., :3] = palette[values[..., 0]]
        if alpha:
            table = np.full(256, 255, np.uint8)
            table[: len(alpha)] = np.frombuffer(alpha, np.uint8)
            rgba[..., 3] = table[values[..., 0]]
    else:
        rgba[..., :3] = values[..., :3] if channels >= 3 else values[..., :1]
        if channels in (2, 4):
            rgba[..., 3] = values[..., -1]
    return rgba


def _unfilter(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 2:
        return line + above
    if kind == 1:
        out = line.copy()
        for c in range(step):
            out[c::step] = np.cumsum(line[c::step], dtype=np.uint64).astype(np.uint8)
        return out
    if kind not in (3, 4):
        raise ValueError("unknown filter of PNG")
    out, up = line.tolist(), above.tolist()
    for x in range(len(out)):
        a = out[x - step] if x >= step else 0
        if kind == 3:
            out[x] = out[x] + (a + up[x]) // 2 & 255
        else:
            b, c = up[x], up[x - step] if x >= step else 0
            pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            out[x] = out[x] + (a if pa <= pb and pa <= pc else b if pb <= pc else c) & 255
    return np.array(out, np.uint8)


def write_png(rgba: np.ndarray) -> bytes:
    h, w = rgba.shape[:2]
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = np.zeros((h, 1 + 4 * w), np.uint8)
    lines[:, 1:] = rgba.reshape(h, 4 * w)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def _lzw_decoded(data: bytes, least: int, wanted: int) -> bytes:
    """Up to ``wanted`` colour indices of a GIF's compressed data, whose codes begin with ``least`` bits."""
    clear, end = 1 << least, (1 << least) + 1
    table: list[bytes] = []
    width, out, size = least + 1, [], 0
    last: bytes | None = None
    held = bits = 0
    for byte in data:
        held |= byte << bits
        bits += 8
        while bits >= width:
            code, held, bits = held & (1 << width) - 1, held >> width, bits - width
            if code == clear:
                table, width, last = [bytes([k]) for k in range(clear)] + [b"", b""], least + 1, None
                continue
            if code == end or size >= wanted:
                return b"".join(out)[:wanted]
            if last is None or code < len(table):
                if code >= len(table):
                    raise ValueError("GIF data is broken")
                entry = table[code]
            elif code == len(table):
                entry = last + last[:1]
            else:
                raise ValueError("GIF data is broken")
            out.append(entry)
            size += len(entry)
            if last is not None and len(table) < 4096:
                table.append(last + entry[:1])
                if len(table) == 1 << width and width < 12:
                    width += 1
            last = entry
    return b"".join(out)[:wanted]


def _lzw_encoded(indices: bytes, least: int) -> bytes:
    clear, end = 1 << least, (1 << least) + 1
    out, held, bits, width = bytearray(), 0, 0, least + 1

    def put(code: int) -> None:
        nonlocal held, bits
        held |= code << bits
        bits += width
        while bits >= 8:
            out.append(held & 255)
            held >>= 8
            bits -= 8

    table: dict[tuple[int, int], int] = {}
    put(clear)
    run = indices[0]
    for k in indices[1:]:
        code = table.get((run, k))
        if code is not None:
            run = code
            continue
        put(run)
        if len(table) + end + 1 < 4096:
            table[run, k] = len(table) + end + 1
            if len(table) + end == 1 << width and width < 12:
                width += 1
        else:
            put(clear)
            table, width = {}, least + 1
        run = k
    put(run)
    put(end)
    if bits:
        out.append(held & 255)
    return bytes(out)


def _blocks(body: bytes, at: int) -> tuple[bytes, int]:
    """The data of length-prefixed blocks from a place on, and the place after them."""
    parts = []
    while at < len(body) and body[at]:
        parts.append(body[at + 1 : at + 1 + body[at]])
        at += 1 + body[at]
    return b"".join(parts), at + 1


def read_gif(body: bytes) -> np.ndarray:
    """The first picture on its canvas, as ``read_png`` gives it; ValueError for what isn't a GIF."""
    if body[:6] not in (b"GIF87a", b"GIF89a") or len(body) < 13:
        raise ValueError("no GIF that can be read")
    w, h, flags = struct.unpack("<HHB", body[6:11])
    if size_error(w, h):
        raise ValueError(size_error(w, h))
    at, colours, clear = 13, None, None
    if flags & 0x80:
        n = 3 << (flags & 7) + 1
        colours, at = np.frombuffer(body[at : at + n], np.uint8), at + n
    while at + 1 < len(body):
        if body[at] == 0x21:
            if body[at + 1] == 0xF9 and len(body) > at + 6 and body[at + 3] & 1:
                clear = body[at + 6]
            _, at = _blocks(body, at + 2)
        elif body[at] == 0x2C and len(body) > at + 10:
            x, y, pw, ph, own = struct.unpack("<HHHHB", body[at + 1 : at + 10])
            at += 10
            if own & 0x80:
                n = 3 << (own & 7) + 1
                colours, at = np.frombuffer(body[at : at + n], np.uint8), at + n
            if colours is None or x + pw > w or y + ph > h or at >= len(body) or not 2 <= body[at] <= 8:
                raise ValueError("GIF is broken")
            data, _ = _blocks(body, at + 1)
            flat = np.frombuffer(_lzw_decoded(data, body[at], pw * ph), np.uint8)
            if len(flat) < pw * ph:
                raise ValueError("GIF is cut off")
            part = flat.reshape(ph, pw)
            if own & 0x40:
                order = [*range(0, ph, 8), *range(4, ph, 8), *range(2, ph, 4), *range(1, ph, 2)]
                part = part[np.argsort(order)]
            palette = np.zeros((256, 4), np.uint8)
            palette[: len(colours) // 3, :3] = colours[: len(colours) // 3 * 3].reshape(-1, 3)
            palette[:, 3] = 255
            if clear is not None:
                palette[clear] = 0
            out = np.zeros((h, w, 4), np.uint8)
            out[y : y + ph, x : x + pw] = palette[part]
            return out
        else:
            break
    raise ValueError("GIF without a picture")


#: Levels of red, green and blue in the palette of written GIFs; the last entry is clear.
_LEVELS = (6, 7, 6)


def write_gif(rgba: np.ndarray) -> bytes:
    """One picture in a fixed palette of evenly spread colours; what is less than half opaque is clear."""
    h, w = rgba.shape[:2]
    step = [np.rint(np.arange(n) * 255 / (n - 1)).astype(np.uint8) for n in _LEVELS]
    palette = np.zeros((256, 3), np.uint8)
    grid = np.stack(np.meshgrid(*step, indexing="ij"), axis=-1).reshape(-1, 3)
    palette[: len(grid)] = grid
    r, g, b = (np.rint(rgba[..., c] * ((n - 1) / 255)).astype(np.int64) for c, n in enumerate(_LEVELS))
    index = np.where(rgba[..., 3] < 128, 255, (r * _LEVELS[1] + g) * _LEVELS[2] + b).astype(np.uint8)
    data = _lzw_encoded(index.tobytes(), 8)
    blocks = b"".join(bytes([len(x)]) + x for x in (data[k : k + 255] for k in range(0, len(data), 255)))
    head = b"GIF89a" + struct.pack("<HHBBB", w, h, 0xF7, 0, 0) + palette.tobytes() + b"\x21\xf9\x04\x01\0\0\xff\0"
    return head + b"\x2c" + struct.pack("<HHHHB", 0, 0, w, h, 0) + b"\x08" + blocks + b"\0;"


def _weights(old: int, new: int) -> np.ndarray:
    """How much each old line adds to each new one, by the cubic kernel of Catmull and Rom stretched to the scale."""
    scale = max(1.0, old / new)
    centre = (np.arange(new) + 0.5) * old / new - 0.5
    x = np.abs(np.arange(old)[None, :] - centre[:, None]) / scale
    k = np.where(x < 1, 1.5 * x**3 - 2.5 * x**2 + 1, np.where(x < 2, -0.5 * x**3 + 2.5 * x**2 - 4 * x + 2, 0.0))
    return k / k.sum(axis=1, keepdims=True)


def resample(rgba: np.ndarray, w: int, h: int) -> np.ndarray:
    """The picture at another size; colours are weighted by their alpha."""
    a = rgba.astype(np.float64)
    a[..., :3] *= a[..., 3:] / 255
    a = np.tensordot(_weights(a.shape[0], h), a, axes=(1, 0))
    a = np.tensordot(_weights(a.shape[1], w), a, axes=(1, 1)).transpose(1, 0, 2)
    alpha = np.clip(a[..., 3:], 0, 255)
    rgb = np.where(alpha > 0, a[..., :3] * 255 / np.maximum(alpha, 1e-9), 0)
    return np.rint(np.clip(np.concatenate((rgb, alpha), axis=2), 0, 255)).astype(np.uint8)


def fetched_image(content_type: str | None, body: bytes, edge: int = 0, most: int = 5 << 20) -> dict:
    """An image ready for use, or why it isn't: data, mime, width, height, resized, orig_w, orig_h, error.

    PNG and GIF images are scaled down to ``edge`` and keep their kind (of a GIF, the first
    picture); for the other kinds the decoders are missing here, which the error says. What is larger than ``most`` bytes is an error that
    suggests an edge.
    """
    out = dict.fromkeys(("data", "mime", "width", "height", "resized", "orig_w", "orig_h", "error"))
    kind = image_kind(content_type, body)
    if not kind:
        shown = (content_type or "").split(";", 1)[0].strip() or "binary"
        return out | {"error": f"unsupported or non-image content ({shown}); web_fetch_image handles PNG, JPEG, GIF, and WebP"}
    size = image_size(body)
    if size is None:
        return out | {"error": "could not decode image: unknown format"}
    if error := size_error(*size):
        return out | {"error": error}
    data, (w, h), resized = body, size, False
    if 0 < edge < max(size):
        try:
            own = image_kind(None, body)
            if own not in ("image/png", "image/gif"):
                raise ValueError(f"no decoder for {kind}")
            w, h = scaled_size(*size, edge)
            read, write = (read_gif, write_gif) if own == "image/gif" else (read_png, write_png)
            data, kind, resized = write(resample(read(body), w, h)), own, True
        except (ValueError, zlib.error, struct.error) as e:
            return out | {"error": f"resize failed: {e}"}
    if len(data) > most:
        return out | {"error": too_large(len(data), w, h, most)}
    return {"data": data, "mime": kind, "width": w, "height": h, "resized": resized, "orig_w": size[0], "orig_h": size[1], "error": ""}


def human_bytes(n: int) -> str:
    if n < 1024:
        return f"{n} B"
    power = min(4, (n.bit_length() - 1) // 10)
    return f"{n / 1024**power:.1f} {' KMGT'[power]}iB"


def suggested_edge(w: int, h: int, size: int, most: int) -> int:
    longest = max(w, h)
    if longest == 0 or size == 0:
        return longest
    d = int(longest * math.sqrt(most / size) * 0.9)
    return max(64, longest * 3 // 4 if d >= longest else d)


def too_large(size: int, w: int, h: int, most: int) -> str:
    return f"image is {human_bytes(size)} ({w}x{h}), over the {human_bytes(most)} cap for model injection; resubmit web_fetch_image with max_dimension={suggested_edge(w, h, size, most)} to downsample it"


def download_ceiling(most: int) -> int:
    return max(CEILING, 4 * most)
