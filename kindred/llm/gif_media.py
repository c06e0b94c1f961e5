"""GIF columns: an LZW codec, timed frames by palette, disposal and transparency, colour histograms.

``decode`` reads any GIF87a or GIF89a stream into composed RGBA frames with their delays;
``gif_frames`` applies it to a column of stored GIFs. ``encode`` writes indexed frames with a
growing code table. ``media_columns`` stores texts as GIFs and reads them back through the same
``decode``: payload, histograms and times are all taken from the composed frames.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kindred.llm import arrowtext
from kindred.llm.shared import BATCH_BYTES, by_batches

#: The payload contract: frames of 24 x 24 samples; the last one is filled up with 255.
SIDE = 24
UNIT = SIDE * SIDE
FILL = 255
GREY = np.repeat(np.arange(256, dtype=np.uint8), 3)


@dataclass
class Frame:
    """An image of the stream as stored: place, indices, palette, and its control values."""

    left: int
    top: int
    indices: np.ndarray
    palette: np.ndarray
    delay_ms: int
    disposal: int
    transparent: int | None


MOST_CODES = 4096


def lzw_codes(samples: bytes, least: int) -> list[int]:
    """Codes times 256 of samples of ``least`` bits, with a clear code wherever the table is full; the first clear and the stop are left out."""
    if not samples:
        return []
    full, clear = MOST_CODES << 8, 256 << least
    table: dict[int, int] = {}
    entry, size = table.setdefault, clear + 512
    out: list[int] = []
    add = out.append
    samples = iter(samples)
    now = next(samples) << 8
    for sample in samples:
        known = entry(now | sample, size)
        if known != size:
            now = known
            continue
        add(now)
        now = sample << 8
        size += 256
        if size > full:  # the entry just made is one too many
            add(clear)
            table.clear()
            size = clear + 512
    add(now)
    return out


def lzw_encode_all(rows: list[bytes], least: int = 8) -> list[bytes]:
    """Code streams of several rows of samples of ``least`` bits, their tables growing from ``least`` + 1 to 12 bits.

    Codes are found one by one; as their widths follow from their places, they are packed together.
    """
    out = []
    for a in range(0, len(rows), TOGETHER):
        codes = [lzw_codes(x, least) for x in rows[a : a + TOGETHER]]
        n = np.array([len(c) + 2 for c in codes])
        begin = np.cumsum(n) - n
        value = np.empty(int(n.sum()), np.int64)
        value[begin], value[begin + n - 1] = 1 << least, (1 << least) + 1
        inner = np.ones(len(value), bool)
        inner[begin] = inner[begin + n - 1] = False
        value[inner] = np.fromiter(chain.from_iterable(codes), np.int64, int(n.sum()) - 2 * len(codes)) >> 8
        # places since the last clear give the widths
        here = np.arange(len(value))
        clears = value == 1 << least
        since = here - np.maximum.accumulate(np.where(clears, here, 0))
        width = widths(least)[1][np.clip(since - 1, 0, None)]
        width[begin] = least + 1
        again = clears.copy()
        again[begin] = False
        width[again] = 12
        offset = np.cumsum(width) - width
        size = np.add.reduceat(width, begin)
        offset -= np.repeat(offset[begin], n)
        nbytes = size + 7 >> 3
        first = np.cumsum(nbytes) - nbytes
        bits = value << (offset & 7)
        at = np.repeat(first, n) + (offset >> 3)
        total = int(nbytes.sum())
        packed = sum(np.bincount(at + k, (bits >> 8 * k) & 255, total + 3) for k in range(3))[:total].astype(np.uint8).tobytes()
        out += [packed[x : x + y] for x, y in zip(first.tolist(), nbytes.tolist())]
    return out


def lzw_encode(samples: bytes, least: int = 8) -> bytes:
    """The code stream of samples of ``least`` bits."""
    return lzw_encode_all([samples], least)[0]


#: Streams whose codes are packed or expanded together.
TOGETHER = 512


@lru_cache(12)
def widths(least: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit offset and width of each code after the first clear, until the table is full."""
    size = (1 << least) + 2
    width = np.array([min(12, (size + max(0, k - 1)).bit_length()) for k in range(MOST_CODES - size + 4)], np.int64)
    return least + 1 + np.cumsum(width) - width, width


def lzw_decode_all(streams: list[bytes], least: int, sizes: list[int]) -> list[np.ndarray]:
    """``lzw_decode`` of several streams.

    A code's entry is the output of an earlier code and the sample right after it. So while a table
    only grows, each output sample is a literal or equals one at an earlier place of its stream:
    code lengths, places and samples follow for all streams at once by pointer doubling. Streams
    that clear their table again, fill it, or do not end with a stop are read code by code.
    """
    out: list[np.ndarray | None] = [None] * len(streams)
    for a in range(0, len(streams), TOGETHER):
        for k, samples in grown(streams[a : a + TOGETHER], least, sizes[a : a + TOGETHER]):
            out[a + k] = samples
    return [lzw_decode(x, least, n) if o is None else o for x, n, o in zip(streams, sizes, out)]


def furthest(to: np.ndarray) -> np.ndarray:
    """Where each chain of pointers ends; an end points to itself."""
    while True:
        next_ = to[to]
        if np.array_equal(next_, to):
            return to
        to = next_


def grown(streams: list[bytes], least: int, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(number, samples) of the streams with one table that only grows."""
    clear, stop = 1 << least, (1 << least) + 1
    offset, width = widths(least)
    bits = np.array([len(x) * 8 for x in streams])
    most = int(np.searchsorted(offset + width, bits.max(initial=0), "right"))
    if not most:
        return
    begins = np.concatenate([[0], np.cumsum([len(x) + 3 for x in streams])])[:-1]
    data = np.frombuffer(b"\0\0\0".join([*streams, b""]), np.uint8).astype(np.uint32)
    at = begins[:, None] + (offset[:most] >> 3)
    at = np.minimum(at, len(data) - 3)
    codes = ((data[at] | data[at + 1] << 8 | data[at + 2] << 16) >> (offset[:most] & 7).astype(np.uint32)) & ((1 << width[:most]) - 1).astype(np.uint32)
    first = data[np.minimum(begins, len(data) - 2)] | data[np.minimum(begins + 1, len(data) - 1)] << 8
    inside = offset[:most] + width[:most] <= bits[:, None]
    ends = (codes == stop) & inside
    n = np.where(ends.any(axis=1), ends.argmax(axis=1), 0)
    used = np.arange(most) < n[:, None]
    step = np.arange(most)
    parent = codes.astype(np.int64) - (clear + 2)
    wrong = used & ((codes == clear) | (parent >= step))
    good = np.flatnonzero((n > 0) & ((first & (2 * clear - 1)) == clear) & ~wrong.any(axis=1))
    if not len(good):
        return
    rows, cols = np.nonzero(used[good])
    code, up = codes[good][rows, cols], parent[good][rows, cols]
    begin = np.concatenate([[0], np.cumsum(n[good])])
    here = np.arange(len(code))
    literal = code < clear
    above = np.where(literal, here, begin[rows] + np.maximum(up, 0))
    # lengths: one more than the code above
    length, to = np.where(literal, 1, 0), above
    depth = (~literal).astype(np.int64)
    while True:
        deeper = depth + depth[to]
        next_ = to[to]
        if np.array_equal(next_, to):
            break
        depth, to = deeper, next_
    length = 1 + depth
    place = np.cumsum(length) - length
    total = int(length.sum())
    owner = np.repeat(here, length)
    source = place[above[owner]] + (np.arange(total) - place[owner])
    samples = np.zeros(total, np.uint8)
    samples[place[literal]] = code[literal]
    samples = samples[furthest(source)]
    last = np.append(place, total)
    for k, a, b in zip(good.tolist(), last[begin[:-1]].tolist(), last[begin[1:]].tolist()):
        held = samples[a:b][: sizes[k]]
        yield k, held if len(held) == sizes[k] else np.concatenate([held, np.zeros(sizes[k] - len(held), np.uint8)])


def lzw_decode(stream: bytes, least: int, n: int) -> np.ndarray:
    """``n`` samples of an LZW code stream with ``least`` bits a sample; missing ones are 0."""
    clear, stop = 1 << least, (1 << least) + 1
    first = [bytes((k,)) for k in range(clear)] + [b"", b""]
    table = first[:]
    add, width, top = table.append, least + 1, 1 << least + 1
    held = have = made = 0
    parts: list[bytes] = []
    before = None
    for at in range(0, len(stream), 64):
        chunk = stream[at : at + 64]
        held |= int.from_bytes(chunk, "little") << have
        have += 8 * len(chunk)
        while have >= width:
            code = held & top - 1
            held >>= width
            have -= width
            if code == clear:
                table = first[:]
                add, width, top, before = table.append, least + 1, 2 << least, None
                continue
            if code == stop or made >= n:
                return samples_of(b"".join(parts), n)
            if code < len(table):
                entry = table[code]
            elif before is not None:
                entry = before + before[:1]
            else:
                raise ValueError("code before its entry")
            parts.append(entry)
            made += len(entry)
            if before is not None and len(table) < MOST_CODES:
                add(before + entry[:1])
                if len(table) == top and width < 12:
                    width += 1
                    top += top
            before = entry
    return samples_of(b"".join(parts), n)


def samples_of(out: bytes, n: int) -> np.ndarray:
    return np.frombuffer(out[:n].ljust(n, b"\0"), np.uint8)


def encode(samples: np.ndarray, width: int = SIDE, height: int = SIDE, delay_ms: int = 100, palette: np.ndarray = GREY) -> bytes:
    """A GIF89a stream of frames (rows of ``samples``) with one global palette of 256 colours; frames stay until the next covers them."""
    head = b"\x21\xf9\x04\x04" + struct.pack("<H", delay_ms // 10) + b"\0\0" + b"\x2c" + struct.pack("<4HB", 0, 0, width, height, 0) + b"\x08"
    out = [b"GIF89a", struct.pack("<2H3B", width, height, 0xF7, 0, 0), palette.tobytes()]
    for coded in lzw_encode_all([row.tobytes() for row in samples]):
        out.append(head)
        for k in range(0, len(coded), 255):
            part = coded[k : k + 255]
            out += (bytes((len(part),)), part)
        out.append(b"\0")
    return b"".join([*out, b"\x3b"])


def blocks(data: bytes, at: int) -> tuple[bytes, int]:
    out = []
    while size := data[at]:
        out.append(data[at + 1 : at + 1 + size])
        at += size + 1
    return b"".join(out), at + 1


def rows_in_order(cells: np.ndarray, interlaced: bool) -> np.ndarray:
    """The rows of an image from top to bottom; interlaced ones come in four passes."""
    if not interlaced:
        return cells
    rows = np.concatenate([np.arange(s, len(cells), d) for s, d in ((0, 8), (4, 8), (2, 4), (1, 2))])
    whole = np.empty_like(cells)
    whole[rows] = cells
    return whole


def frames(data: bytes) -> tuple[int, int, list[Frame]]:
    """Width, height and the stored frames. ValueError for what is not a whole GIF."""
    try:
        if data[:6] not in (b"GIF87a", b"GIF89a"):
            raise ValueError("no GIF signature")
        width, height, flags, _, _ = struct.unpack_from("<2H3B", data, 6)
        at, colours, out = 13, np.zeros((256, 3), np.uint8), []
        if flags & 0x80:
            n = 2 << (flags & 7)
            colours = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
            at += 3 * n
        delay = disposal = 0
        clear = None
        coded: list[tuple[int, bytes, bool]] = []
        while data[at] != 0x3B:
            if data[at] == 0x21:
                kind = data[at + 1]
                body, at = blocks(data, at + 2)
                if kind == 0xF9:
                    delay, disposal = 10 * (body[1] | body[2] << 8), body[0] >> 2 & 7
                    clear = body[3] if body[0] & 1 else None
                continue
            if data[at] != 0x2C:
                raise ValueError("unknown block")
            left, top, w, h, own = struct.unpack_from("<4HB", data, at + 1)
            at, palette = at + 10, colours
            if own & 0x80:
                n = 2 << (own & 7)
                palette = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
                at += 3 * n
            stream, after = blocks(data, at + 1)
            coded.append((data[at], stream, own & 0x40 > 0))
            at = after
            out.append(Frame(left, top, np.zeros((h, w), np.uint8), palette, delay, disposal, clear))
            delay, disposal, clear = 0, 0, None
        for least in {c[0] for c in coded}:
            if not 1 <= least <= 8:
                raise ValueError("samples of an unknown size")
            some = [k for k, c in enumerate(coded) if c[0] == least]
            for k, cells in zip(some, lzw_decode_all([coded[k][1] for k in some], least, [out[k].indices.size for k in some])):
                out[k].indices = rows_in_order(cells.reshape(out[k].indices.shape), coded[k][2])
        return width, height, out
    except (IndexError, struct.error) as e:
        raise ValueError("cut off") from e


def shown(data: bytes) -> Iterator[tuple[int, int, np.ndarray]]:
    """(delay in ms, disposal, height x width x RGBA) of each frame as a viewer shows it, one at a time; the array is used again."""
    width, height, stored = frames(data)
    canvas = np.zeros((height, width, 4), np.uint8)
    for f in stored:
        before = canvas.copy() if f.disposal == 3 else None
        h, w = f.indices.shape
        place = canvas[f.top : f.top + h, f.left : f.left + w]
        cells = f.indices[: place.shape[0], : place.shape[1]]
        colours = np.zeros((256, 4), np.uint8)
        colours[: len(f.palette), :3] = f.palette
        colours[len(f.palette) :, :3] = f.palette[-1:]
        colours[:, 3] = 255
        if f.transparent is None:
            place[...] = colours[cells]
        else:
            np.copyto(place, colours[cells], where=(cells != f.transparent)[..., None])
        yield f.delay_ms, f.disposal, canvas
        if f.disposal == 2:
            place[...] = 0
        elif before is not None:
            canvas = before


def decode(data: bytes) -> list[tuple[int, np.ndarray]]:
    """Timed frames as a viewer shows them: (delay in ms, height x width x RGBA)."""
    return [(delay, canvas.copy()) for delay, _, canvas in shown(data)]


def histogram(rgba: np.ndarray) -> np.ndarray:
    """Opaque pixels in 4 x 4 x 4 colour bins."""
    packed = np.ascontiguousarray(rgba).reshape(-1, 4)
    bins = (packed[:, 0] >> 6) * 16 + (packed[:, 1] >> 6) * 4 + (packed[:, 2] >> 6)
    return np.bincount(bins[packed[:, 3] > 0], minlength=64)


FRAME = T.StructType([T.StructField("frame", T.IntegerType()), T.StructField("delay_ms", T.IntegerType()), T.StructField("starts_ms", T.LongType()), T.StructField("disposal", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("histogram", T.ArrayType(T.LongType())), T.StructField("rgba", T.BinaryType())])


def gif_frames(media: DataFrame, column: str = "gif") -> DataFrame:
    """One row for each frame of each GIF of ``column`` (left out): its place, delay, start, disposal, size, histogram and pixels.

    Pixels are the composed picture, four bytes each, row by row. A null, or what is no whole GIF,
    makes one row with a null frame and the reason in ``fault``; a GIF without an image makes one
    whose fault is 'no frame'. Other columns go with every frame; of clashing names ours stay.
    """
    made = [*FRAME.names, "fault"]
    kept = [c for c in media.columns if c != column and c not in made]
    schema = T.StructType([*(media.schema[c] for c in kept), *FRAME.fields, T.StructField("fault", T.StringType())])

    def rows_of(data: bytes | None):
        if data is None:
            yield (*[None] * len(FRAME.names), "null")
            return
        number = starts = 0
        try:
            for delay, disposal, rgba in shown(data):
                yield number, delay, starts, disposal, rgba.shape[1], rgba.shape[0], histogram(rgba).tolist(), rgba.tobytes(), None
                number, starts = number + 1, starts + delay
        except ValueError as e:
            yield (*[None] * len(FRAME.names), str(e))
            return
        if not number:
            yield (*[None] * len(FRAME.names), "no frame")

    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.string()]

    def work(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            owners, rows, size = [], [], 0

            def flush():
                part = batch.select(kept).take(pa.array(owners, pa.int64()))
                return pa.RecordBatch.from_arrays([*part.columns, *(pa.array(x, k) for x, k in zip(zip(*rows), kinds))], names=kept + made)

            for k, data in enumerate(batch.column(column).to_pylist()):
                for row in rows_of(data):
                    owners.append(k)
                    rows.append(row)
                    size += len(row[7] or b"") + 700
                    if size > BATCH_BYTES:
                        yield flush()
                        owners, rows, size = [], [], 0
            if rows:
                yield flush()

    return by_batches(media, work, schema)


def stored_text(data: bytes) -> bytes:
    """A text's payload as a GIF of 24 x 24 grey frames."""
    size = max(UNIT, -(-len(data) // UNIT) * UNIT)
    return encode(np.frombuffer(data.ljust(size, bytes([FILL])), np.uint8).reshape(-1, UNIT))


def read_back(media: bytes) -> tuple[bytes, np.ndarray, list[int]]:
    """Payload, colour histogram of each frame, and delays of a stored text, all from its composed frames."""
    payload, bins, delays = [], [], []
    for delay, _, rgba in shown(media):
        payload.append(rgba[..., 0].tobytes())
        bins.append(histogram(rgba))
        delays.append(delay)
    return b"".join(payload), np.array(bins), delays


MADE = T.StructType([T.StructField(n, k) for n, k in (("n_bytes", T.LongType()), ("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType()), ("n_frames", T.LongType()), ("duration_ms", T.LongType()), ("histogram", T.ArrayType(T.LongType())))])


def media_columns(docs: DataFrame, text: str = "text", media: bool = False) -> DataFrame:
    """``docs`` (text left out) with the payload's and the stored form's digests, sizes and features.

    ``media=True`` adds the GIF itself as ``gif``, whose frames ``gif_frames`` lists. A null text is
    stored as an empty one: one frame of filling. ``histogram`` counts the pixels of all frames in
    64 colour bins; the feature is its grey bins as shares of all pixels, and the largest change
    between the grey bins of two frames in a row. Rows are independent; one text at a time is held
    in expanded form, and its frames one by one.
    """
    kept = [c for c in docs.columns if c != text and c not in MADE.names and c != "gif"]
    fields = [docs.schema[c] for c in kept] + MADE.fields + ([T.StructField("gif", T.BinaryType())] if media else [])
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())] + [pa.binary()] * media

    def described(data: bytes) -> tuple:
        gif = stored_text(data)
        payload, bins, delays = read_back(gif)
        total = bins.sum(axis=0)
        grey = bins[:, [0, 21, 42, 63]]
        change = np.abs(np.diff(grey, axis=0)).max(initial=0) / UNIT
        feature = " ".join(f"{x:.6f}" for x in [*(grey.sum(axis=0) / len(payload)), change])
        return len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(gif), hashlib.sha256(gif).hexdigest(), feature, len(delays), sum(delays), total.tolist(), gif

    def work(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for part, data, offsets in arrowtext.pieces(batch, text):
                raw = data.tobytes()
                rows = list(zip(*(described(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))))
                cols = [part.column(c) for c in kept] + [pa.array(x, k) for x, k in zip(rows, kinds)]
                yield pa.RecordBatch.from_arrays(cols, names=kept + MADE.names + ["gif"] * media)

    return by_batches(docs, work, T.StructType(fields))
