"""Secret scans through nested encodings."""

from __future__ import annotations

import base64
import bz2
import hashlib
import itertools
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The kinds, in their order, and what is searched for each.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones need not be matched first

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}"
)  # possessive, from the start of a run only: a long run without a line end is passed once
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
SEPARATOR = re.compile(r"[/_-]")
#: Where a compressed stream may start inside other bytes.
STREAM = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY|\xfd7zXZ\x00")
#: What a decoded text must have to hold a secret or a further layer.
WORTH = re.compile(
    r"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{24}|%[0-9A-Fa-f]{2}|\\[uUx]|&#|[A-Za-z0-9+/_-]{16}|BZh|\x1f|\xfd"
)

SPAN = "struct<start:int,kind:string,end:int>"
RESULT = f"struct<base:array<{SPAN}>,spans:array<{SPAN}>,oversize:int>"

Span = tuple[int, int, int]  # start, kind, end


def spans_of(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind that are long enough."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


class Layer:
    """A text and, for each of its characters, the place in the document it comes from.

    ``starts`` and ``ends`` are arrays, or numbers if all characters come from one place. A
    ``window`` is a part of a layer too large to hold.
    """

    def __init__(self, text: str, starts: np.ndarray | int, ends: np.ndarray | int, window: bool = False):
        self.text, self.starts, self.ends, self.window = text, starts, ends, window

    def key(self) -> tuple:
        """Equal for a layer that was seen before: the same text from the same place."""
        digest = hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        return digest, *self.origin(0, len(self.text))

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if isinstance(self.starts, int):
            return self.starts, self.ends  # type: ignore[return-value]
        return int(self.starts[start]), int(self.ends[end - 1])  # type: ignore[index]


def lenient(data: bytes) -> str:
    """The bytes as UTF-8; each byte that is none becomes one lone surrogate."""
    return data.decode("utf-8", "surrogateescape")


def byte_ends(text: str) -> np.ndarray:
    """Where each character of ``lenient`` text ends in its bytes."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    width[(codes >= 0xDC80) & (codes <= 0xDCFF)] = 1
    return np.cumsum(width)


class Oversize(Exception):
    """A compressed layer beyond the bound, with its compressed bytes."""


def opener_of(data: bytes):
    """(decompressor, its error) for bytes that start like a gzip, zlib, bzip2 or xz stream."""
    if data[:2] == b"\x1f\x8b" or (len(data) > 2 and data[0] & 15 == 8 and (data[0] * 256 + data[1]) % 31 == 0):
        return zlib.decompressobj(47), zlib.error
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor(), OSError
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(), lzma.LZMAError
    return None


def inflate(data: bytes, most: int) -> bytes | None:
    """The content of a gzip, zlib, bzip2 or xz stream; None if it is none."""
    if (found := opener_of(data)) is None:
        return None
    opener, kind = found
    try:
        out = opener.decompress(data, most + 1)
    except (kind, EOFError):
        return None
    if len(out) > most:
        raise Oversize(data)
    return out if opener.eof else None


def streamed(chunks: Iterator[bytes], depth: int = 0, step: int = 1 << 20) -> Iterator[bytes]:
    """The content of a compressed stream, and of what is compressed in it, chunk by chunk."""
    head = next(chunks, b"")
    while len(head) < 6 and (more := next(chunks, b"")):
        head += more
    if depth > 64 or (found := opener_of(head)) is None:
        yield head
        yield from chunks
        return

    def content_of() -> Iterator[bytes]:
        opener, kind = found
        try:
            for data in itertools.chain([head], chunks):
                while True:
                    out = opener.decompress(data, step)
                    yield out
                    data = getattr(opener, "unconsumed_tail", b"")
                    if opener.eof:
                        return
                    if len(out) < step and not data and getattr(opener, "needs_input", True):
                        break
        except (kind, EOFError):
            return

    yield from streamed(filter(None, content_of()), depth + 1, step)


def windows(data: bytes, most: int) -> Iterator[str]:
    """The text of a compressed layer in overlapping windows, so that it is never held whole."""
    size = max(most // 8, 1 << 12)
    held = b""
    for chunk in streamed(iter([data])):
        held += chunk
        while len(held) >= size:
            yield lenient(held[:size])
            held = held[size - size // 8 :]
    if held:
        yield lenient(held)


def content(data: bytes, most: int) -> bytes | None:
    """What is inside a compressed stream, through all its layers; None if it is none."""
    inside, seen = None, set()
    while (deeper := inflate(data, most)) is not None:
        if (mark := hashlib.blake2b(data).digest()) in seen:
            return None
        seen.add(mark)
        inside = data = deeper
    return inside


def replaced(layer: Layer, pattern: re.Pattern, decoded) -> Layer | None:
    """The layer with each match replaced by ``decoded(match)``, a list of (text, start, end)."""
    text, places, at = [], [], 0  # places: (piece of the layer from, to) or (first, last, length)
    for m in pattern.finditer(layer.text):
        if (parts := decoded(m)) is None:
            continue
        text.append(layer.text[at : m.start()])
        places.append((at, m.start()))
        for piece, start, end in parts:
            text.append(piece)
            places.append((*layer.origin(start, end), len(piece)))
        at = m.end()
    if not places:
        return None
    whole = "".join(text) + layer.text[at:]
    if isinstance(layer.starts, int):
        return Layer(whole, layer.starts, layer.ends)
    places.append((at, len(layer.text)))
    starts = [layer.starts[p[0] : p[1]] if len(p) == 2 else np.full(p[2], p[0]) for p in places]
    ends = [layer.ends[p[0] : p[1]] if len(p) == 2 else np.full(p[2], p[1]) for p in places]  # type: ignore[index]
    return Layer(whole, np.concatenate(starts), np.concatenate(ends))


def percent_run(m: re.Match) -> list:
    raw = bytes.fromhex(m[0].replace("%", ""))
    text = lenient(raw)
    ends = [m.start(), *(m.start() + 3 * byte_ends(text)).tolist()]
    return list(zip(text, ends, ends[1:], strict=False))


def escape_run(m: re.Match) -> list | None:
    run = m[0]
    if run.startswith("\\u") and run[2] != "{":
        units = [int(run[at + 2 : at + 6], 16) for at in range(0, len(run), 6)]
        parts, at = [], 0
        while at < len(units):
            pair = at + 1 < len(units) and 0xD800 <= units[at] < 0xDC00 <= units[at + 1] < 0xE000
            code = 0x10000 + ((units[at] - 0xD800) << 10) + units[at + 1] - 0xDC00 if pair else units[at]
            parts.append((chr(code), m.start() + 6 * at, m.start() + 6 * (at + 1 + pair)))
            at += 1 + pair
        return parts
    digits = run.strip("\\uUx{}&#X;")
    code = int(digits, 10 if run.startswith("&#") and run[2] not in "xX" else 16)
    return [(chr(code), m.start(), m.end())] if code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def unwrapped(layer: Layer, most: int) -> Iterator[Layer | None]:
    """The layers one step further in; None for one that is too large to hold, before its windows."""
    if "%" in layer.text:
        yield from filter(None, [replaced(layer, PERCENT, percent_run)])
        for m in PERCENT.finditer(layer.text):
            raw = bytes.fromhex(m[0].replace("%", ""))
            yield from inflated(layer, m.start(), m.end(), raw, most, set())
    if "\\" in layer.text or "&#" in layer.text:
        yield from filter(None, [replaced(layer, ESCAPE, escape_run)])
    opened: set[int] = set()
    for m in WRAPPED.finditer(layer.text):
        parts = list(LINE.finditer(layer.text, m.start(), m.end()))
        places = np.concatenate([np.arange(p.start(), p.end()) for p in parts])
        yield from base64_run(layer, "".join(p[0] for p in parts), places, [p.start() for p in parts], most, opened)
    for m in BASE64.finditer(layer.text):
        token = m[0].rstrip("=")
        places = np.arange(m.start(), m.start() + len(token))
        yield from base64_run(layer, token, places, [m.start()], most, opened)


STANDARD = str.maketrans("-_", "+/")


def base64_run(
    layer: Layer, token: str, places: np.ndarray, lines: list[int], most: int, opened: set[int]
) -> Iterator[Layer | None]:
    """The layers inside a run of base64 characters, ``places`` being theirs in the layer.

    Where in the run the encoded part begins is not known (``reset/dG9r…``, ``key_dG9r…``), so
    the run is decoded from each of its first four characters; what is no part of it becomes
    noise around the text. Compressed streams are looked for at the start of each of ``lines``,
    behind each separator, and where their mark is found.
    """
    plain = token.translate(STANDARD)
    raws = []
    for offset in range(4):
        part = plain[offset : len(plain) - ((len(plain) - offset) % 4 == 1)]
        raws.append(base64.b64decode(part + "=" * (-len(part) % 4)))
    begins = {0, *np.searchsorted(places, lines).tolist(), *(m.end() for m in SEPARATOR.finditer(token))}
    for offset, raw in enumerate(raws):
        begins |= {offset + m.start() * 4 // 3 for m in STREAM.finditer(raw) if m.start() % 3 == 0}
    for at in sorted(begins):
        raw, byte = raws[at % 4], at // 4 * 3
        if at < len(token) and opener_of(raw[byte : byte + 8]):
            yield from inflated(layer, int(places[at]), int(places[-1]) + 1, raw[byte:], most, opened)
    for offset, raw in enumerate(raws):
        text = lenient(raw)
        if not WORTH.search(text):
            continue
        if isinstance(layer.starts, int):
            yield Layer(text, layer.starts, layer.ends)
            continue
        ends = byte_ends(text)
        starts = np.append(0, ends[:-1])
        last = np.minimum(offset - (-ends * 4 // 3), len(token)) - 1
        yield Layer(text, layer.starts[places[offset + starts * 4 // 3]], layer.ends[places[last]])  # type: ignore[index]


def inflated(layer: Layer, start: int, end: int, raw: bytes, most: int, opened: set[int]) -> Iterator[Layer | None]:
    """The text of a compressed stream found in the layer, all of it from one place."""
    if start in opened:
        return
    try:
        if (data := content(raw, most)) is not None:
            opened.add(start)
            yield Layer(lenient(data), *layer.origin(start, end))
    except Oversize as large:
        opened.add(start)
        yield None
        for text in windows(large.args[0], most):
            yield Layer(text, *layer.origin(start, end), window=True)


def scan(text: str, most: int) -> tuple[list[Span], list[Span], int]:
    """(base spans, all spans, layers too large to hold), spans by start, kind and end."""
    base = sorted(spans_of(text))
    found, seen, oversize = set(base), set(), 0

    def visit(layer: Layer) -> None:
        nonlocal oversize
        work = [layer]
        while work:
            layer = work.pop()
            for deeper in unwrapped(layer, most):
                if deeper is None:
                    oversize += 1
                elif deeper.text and (key := deeper.key()) not in seen:
                    seen.add(key)
                    for start, kind, end in spans_of(deeper.text):
                        first, last = deeper.origin(start, end)
                        found.add((first, kind, last))
                    if deeper.window:  # opened to its end before the next one is read
                        visit(deeper)
                    else:
                        work.append(deeper)

    if text:
        visit(Layer(text, np.arange(len(text)), np.arange(1, len(text) + 1)))
    return base, sorted(found), oversize


def secrets_in(text: Column, *, max_layer_bytes: int = 64 << 20) -> Column:
    """Struct (``base``, ``spans``, ``oversize``) of each text; spans are (start, kind, end).

    ``base`` are the matches in the text as it stands, ``spans`` those and the ones found in
    its decoded layers, mapped to the run of the text they come from. Places count code points,
    the end is exclusive; lists are ordered by start, then kind as in ``KINDS``, then end.

    A worklist starts with the text. Percent codes and Unicode escapes are replaced over the
    whole layer, base64 runs, also over line ends, and what is compressed inside them become
    layers of their own; each is scanned and unwrapped again until nothing new comes out. Bytes
    that are no UTF-8 hide nothing but themselves. A layer with the same text from the same
    place is not opened twice, so data that unpacks to itself ends. A compressed layer above
    ``max_layer_bytes`` is scanned in overlapping windows; ``oversize`` counts those.

    Null and empty texts have no spans. Repeated rows are scanned alike.
    """

    @F.arrow_udf(RESULT)
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        span = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])
        kind = pa.struct([("base", pa.list_(span)), ("spans", pa.list_(span)), ("oversize", pa.int32())])
        named = lambda spans: [{"start": s, "kind": KINDS[k], "end": e} for s, k, e in spans]
        for batch in batches:
            rows = []
            for value in batch:
                base, spans, oversize = scan(value.as_py() or "", max_layer_bytes)
                rows.append({"base": named(base), "spans": named(spans), "oversize": oversize})
            yield pa.array(rows, kind)

    return scanned(text)


def digest_form(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    """The text with the spans replaced; spans that overlap or touch become one."""
    out, at, end = [], 0, -1
    for start, stop in sorted(spans):
        if start > end:
            out += [text[at:start], mask]
        at = end = max(end, stop)
    return "".join(out) + text[at:]


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``mask``; a null text stays null."""

    @F.arrow_udf("string")
    def hidden(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array(
            [
                masked(t, [(s["start"], s["end"]) for s in f], mask) if t and f else t
                for t, f in zip(texts.to_pylist(), found.to_pylist(), strict=True)
            ],
            pa.string(),
        )

    return hidden(text, spans)
