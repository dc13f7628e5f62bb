"""Secret scan with a recursive decoding worklist.

Each text is scanned by the base patterns.  It is then a layer on a worklist:
every decoder (URL escapes, Unicode escapes and entities, UTF-16 and UTF-32 by
their NULs, base64) that changes a layer puts the decoded text back on the list.
A base64 run is decoded from each of its first four characters, so that what
stands before a payload doesn't hide it, and runs that only line breaks separate
also as one; bytes that aren't UTF-8 are read as
Latin-1, in which the patterns (all ASCII) match as well.  What base64 hides may
itself be compressed (gzip, zlib, raw deflate, bzip2, xz, lzma) any number of times.  A layer whose digest
has been seen is not scanned again, so cycles end and the list reaches its
fixpoint.  Each character of a layer carries the span of the original text it
comes from; findings in a layer are mapped back to code points of the original.

Defined results: null and empty texts have no findings; the findings of the
base patterns are always kept; the same kind and span found in several layers
counts once; repeated rows get equal results; other columns are ignored by
``scan`` and carried by ``redact``; an empty table gives an empty table.

Compressed payloads are inflated as a stream to its end.  What exceeds a window is
scanned in windows that end where no finding, run or nested payload is open, so
nothing is cut and memory does not depend on what a payload holds.  Only one run
or nested payload that is itself longer than ``INFLATED`` bytes is cut (windows
then overlap); ``scan`` reports such a text in ``fully_scanned``, and ``redact``
takes the whole payload out.  A damaged payload is scanned as far as it can be
read.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import html
import itertools
import lzma
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, text_bytes

#: Bytes of an inflated payload that are held while a run or nested payload stays open.
INFLATED = 1 << 25
#: Bytes of an inflated payload that are scanned at once, and bytes that windows share.
WINDOW, OVERLAP = 4 << 20, 64 << 10
#: First bytes of a payload, by which its compression is known: more than the largest block of any format.
_HEAD = 1 << 20
# Kinds and patterns of the findings, in the order they are listed.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_WORDS = ("passw", "secret", "token", "api")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|\\[ux]\{[0-9A-Fa-f]{1,8}\}|\\x[0-9A-Fa-f]{2}|\\[0-3][0-7]{2}"
                     r"|&(?:#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6})|[A-Za-z][A-Za-z0-9]{1,30});")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# The same escapes, byte by byte, with those that writers put beside them.
_PERCENT_BYTE = re.compile(r"%[0-9A-Fa-f]{2}")
_PERCENT_PLUS = re.compile(r"%[0-9A-Fa-f]{2}|\+")
_ESCAPE_BYTE = re.compile(r"""\\(?:u[0-9A-Fa-f]{4}|U0000[0-9A-Fa-f]{4}|x[0-9A-Fa-f]{2}|[abfnrtv0"'/\\])""")
_ENTITY_BYTE = re.compile(r"&(?:#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6})|amp|lt|gt|quot|apos);")
_SHORT = dict(zip("abfnrtv0\"'/\\", "\a\b\f\n\r\t\v\0\"'/\\"))
#: Lines of base64: breaks as they are or written as \\n, with blanks at the beginning of a line.
_BREAK = r"[ \t]*+(?:\r\n?|\n|\\r\\n|\\n)[ \t]*+"
_LINES = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:{_BREAK}[A-Za-z0-9+/_-]++)++={{0,2}}")
_LINE = re.compile(r"(\\r\\n|\\n)|([A-Za-z0-9+/_-]+)=*")
#: Backwards: what parts two runs or findings (the first byte is the later one's).
_APART = re.compile(rb"""(?<=[!-9;<>-~])[^!-~\0\r\n]+(?=[!#-&(-9;<>-~])|\0{8,}|\n\r?[ \t]*\n|(?<=[!-~])[\x80-\xff]+(?=[!-~ ])""")
_NULS = re.compile(r"(?:[\x01-\x7f]\0(?:\0\0)?){4,}|(?:\0(?:\0\0)?[\x01-\x7f]){4,}")
_WIDE = re.compile("[^\x00-\xff]")
_MAGIC = re.compile("\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\0|x[\x01\x5e\x9c\xda]")
#: Bytes without a match have no finding, and no decoder changes them.
_WORTH = re.compile(rb"(?i:passw|secret|token|api)|AKIA|[0-9a-f]{32}|%[0-9A-Fa-f]{2}|\\[uUx0-3]|&[#A-Za-z]|[A-Za-z0-9+/_-]{16}"
                    rb"|[\x01-\x7f]\0(?:\0\0)?[\x01-\x7f]\0|\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\0|\x5d\0\0|x[\x01\x5e\x9c\xda]")

Finding = tuple[str, int, int]


def base_findings(text: str) -> list[Finding]:
    """kind, start, end (code points, end exclusive) by start, then kind."""
    found: list[tuple[int, int, int]] = []
    lower = text.lower()
    if any(w in lower for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


class _Layer:
    """A text and, for each of its characters, the span of the original it comes from."""

    __slots__ = ("text", "starts", "ends")

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray):
        self.text, self.starts, self.ends = text, starts, ends

    def replaced(self, parts: list[tuple[int, int, str, np.ndarray, np.ndarray]]) -> _Layer:
        """Parts (start, end, new text, start and end here of each new character) put in place."""
        texts, starts, ends, at = [], [], [], 0
        for a, b, new, new_starts, new_ends in parts:
            texts += (self.text[at:a], new)
            starts += (self.starts[at:a], self.starts[new_starts])
            ends += (self.ends[at:a], self.ends[new_ends - 1])
            at = b
        texts.append(self.text[at:])
        return _Layer("".join(texts), np.concatenate([*starts, self.starts[at:]]), np.concatenate([*ends, self.ends[at:]]))


class _Work(list):
    """Iterators of layers; ``report`` has the span of each payload in which something was cut."""

    def __init__(self, report: list):
        self.report = report


def _characters(data: bytes) -> tuple[str, np.ndarray]:
    """Text of ``data`` and how many bytes each character took (Latin-1 where it isn't UTF-8)."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1"), np.ones(len(data), np.int64)
    return text, np.fromiter((len(c.encode()) for c in text), np.int64, len(text))


def _url(layer: _Layer) -> list:
    parts = []
    for m in _PERCENT.finditer(layer.text):
        text, sizes = _characters(bytes.fromhex(m.group().replace("%", "")))
        ends = m.start() + 3 * np.cumsum(sizes)
        parts.append((m.start(), m.end(), text, ends - 3 * sizes, ends))
    return parts


def _form(layer: _Layer) -> list:
    """URL escapes where ``+`` stands for a space."""
    if "+" not in layer.text or not _PERCENT.search(layer.text):
        return []
    blanks = [(m.start(), m.end(), " ", np.array([m.start()]), np.array([m.end()])) for m in re.finditer(r"\+", layer.text)]
    return sorted(_url(layer) + blanks, key=lambda part: part[0])


def _unicode(layer: _Layer) -> list:
    parts = []
    for m in _ESCAPE.finditer(layer.text):
        s = m.group()
        if s.startswith("\\u") and s[2] != "{":
            units = bytes.fromhex(s.replace("\\u", ""))
            text = units.decode("utf-16-be", "replace")
            sizes = np.fromiter((2 if ord(c) > 0xFFFF else 1 for c in text), np.int64, len(text))
            if sizes.sum() * 2 != len(units):
                text, sizes = "�" * (len(units) // 2), np.ones(len(units) // 2, np.int64)
            ends = m.start() + 6 * np.cumsum(sizes)
            parts.append((m.start(), m.end(), text, ends - 6 * sizes, ends))
            continue
        if s[0] == "&" and s[1] != "#":
            if len(text := html.unescape(s)) == 1:
                parts.append((m.start(), m.end(), text, np.array([m.start()]), np.array([m.end()])))
            continue
        code = (int(s[2:].strip("{}"), 16) if s[:2] in ("\\U", "\\x", "\\u") else int(s[1:], 8) if s[0] == "\\"
                else int(s[3:-1], 16) if s[2] in "xX" else int(s[2:-1]))
        if code < 0x110000 and not 0xD800 <= code < 0xE000:
            parts.append((m.start(), m.end(), chr(code), np.array([m.start()]), np.array([m.end()])))
    return parts


def _literal(layer: _Layer, units: re.Pattern, value: Callable[[str], str]) -> _Layer | None:
    """``layer`` with one character for each match of ``units``, if that shows the beginning of compressed bytes."""
    spans, texts, at = [], [], 0
    for m in units.finditer(layer.text):
        spans.append(m.span())
        texts += (layer.text[at:m.start()], value(m.group()))
        at = m.end()
    text = "".join([*texts, layer.text[at:]])
    if not spans or not _MAGIC.search(text):
        return None
    first, last = np.array(spans).T
    kept = np.ones(len(layer.text), bool)  # all but what a unit has after its first character
    kept[:] = np.cumsum(np.bincount(first + 1, minlength=len(kept) + 1) - np.bincount(last, minlength=len(kept) + 1))[:-1] == 0
    ends = layer.ends.copy()
    ends[first] = layer.ends[last - 1]
    return _Layer(text, layer.starts[kept], ends[kept])


def _bytes_of(layer: _Layer) -> Iterator[_Layer]:
    """Readings of a layer's escapes in which each byte is a character, for compressed bytes in them."""
    percent = lambda s: " " if s == "+" else chr(int(s[1:], 16))
    escape = lambda s: _SHORT.get(s[1]) or chr(int(s[2:], 16)) if s[0] == "\\" else html.unescape(s) if s[1] != "#" else (
        chr(min(0xFFFF, int(s[3:-1], 16) if s[2] in "xX" else int(s[2:-1]))))
    readings = []
    if "%" in layer.text:
        readings.append((_PERCENT_BYTE, percent))
        if "+" in layer.text:
            readings.append((_PERCENT_PLUS, percent))
    if "\\" in layer.text:
        readings.append((_ESCAPE_BYTE, escape))
    if "&" in layer.text:
        readings.append((_ENTITY_BYTE, escape))
    for units, value in readings:
        if (found := _literal(layer, units, value)) is not None:
            yield found


def _nuls(layer: _Layer) -> list:
    """ASCII characters of UTF-16 and UTF-32 texts, whatever the bytes around them."""
    parts = []
    for m in _NULS.finditer(layer.text) if "\0" in layer.text else ():
        at = m.start() + np.flatnonzero(np.frombuffer(m.group().encode(), np.uint8))
        parts.append((m.start(), m.end(), m.group().replace("\0", ""), at, at + 1))
    return parts


def _opener(head: bytes) -> Callable | None:
    """What takes off the compression that ``head`` begins with."""
    if head[:2] == b"\x1f\x8b" or head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0:
        return lambda: zlib.decompressobj(wbits=47)  # gzip or zlib
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor
    if head[:6] == b"\xfd7zXZ\x00":
        return lambda: lzma.LZMADecompressor(memlimit=1 << 28)
    if head[:3] == b"\x5d\0\0" and len(head) > 13:
        return lambda: lzma.LZMADecompressor(lzma.FORMAT_ALONE, memlimit=1 << 28)
    return None


def _deflated(data: bytes) -> Iterator[bytes] | None:
    """Pieces of a raw deflate stream that takes all of ``data``; None if it is none."""
    member, rest = zlib.decompressobj(-15), data
    try:
        while not member.eof:
            out = member.decompress(rest, _HEAD)
            rest = member.unconsumed_tail
            if not out and not rest and not member.eof:
                return None
    except zlib.error:
        return None
    return _opened(iter((data,)), lambda: zlib.decompressobj(-15)) if not member.unused_data else None


def _opened(source: Iterator[bytes], opener: Callable) -> Iterator[bytes]:
    """Inflated pieces of ``source``, member after member, up to its end or to damaged data."""
    member = opener()
    for data in source:
        while True:
            try:
                out = member.decompress(data, _HEAD)
            except (zlib.error, OSError, EOFError, lzma.LZMAError):
                return
            if out:
                yield out
            if member.eof:
                data, member = member.unused_data, opener()
                if not data:
                    break
            else:
                data = getattr(member, "unconsumed_tail", b"")
                if not data and len(out) < _HEAD:
                    break


def _inflate(data: bytes) -> Iterator[bytes] | None:
    """Pieces of ``data`` with every layer of compression taken off; None if there is none."""
    pieces, seen = iter((data,)), set()
    while True:
        held, size = [], 0
        while size < _HEAD and (piece := next(pieces, None)) is not None:
            held.append(piece)
            size += len(piece)
        head, pieces = b"".join(held), itertools.chain(held, pieces)
        opener, digest = _opener(head), hashlib.sha256(head).digest()
        if opener is None or digest in seen or next(_opened(iter((head,)), opener), None) is None:
            return pieces if seen else None
        seen.add(digest)
        pieces = _opened(pieces, opener)


def _open_stream(text: str) -> int | None:
    """Where compressed bytes begin that go on at the end of ``text`` (0 if they are written as escapes)."""
    places = np.broadcast_to(np.int64(0), len(text))
    for n, layer in enumerate((_Layer(text, places, places), *_bytes_of(_Layer(text, places, places)))):
        for m in _MAGIC.finditer(layer.text):
            wide = _WIDE.search(layer.text, m.start())
            if wide or (opener := _opener(layer.text[m.start():m.start() + 16].encode("latin-1"))) is None:
                continue
            if _opens(layer.text[m.start():m.start() + 4096].encode("latin-1"), opener) and _goes_on(
                    layer.text[m.start():].encode("latin-1"), opener):
                return m.start() if n == 0 else 0
    return None


def _goes_on(data: bytes, opener: Callable) -> bool:
    member = opener()
    try:
        while not member.eof:
            out = member.decompress(data, _HEAD)
            data = getattr(member, "unconsumed_tail", b"")
            if not out and not data and not member.eof:
                return True
    except (zlib.error, OSError, EOFError, lzma.LZMAError):
        return False
    return False


def _border(held: bytes) -> int:
    """The last place in ``held`` at which no run, finding or compressed payload is open; 0 if there is none."""
    m = _APART.search(held[::-1])
    border = len(held) - m.start() if m else 0
    text = held.decode("latin-1")
    if border and (at := _open_stream(text)) is not None:
        border = min(border, at)
    if border and not held.isascii() and (as_utf8 := _utf8(held[:border])) and _open_stream(as_utf8) is not None:
        border = 0
    return border


def _windows(pieces: Iterator[bytes], report: list, span: tuple[int, int]) -> Iterator[str]:
    """Texts of about ``WINDOW`` bytes, each from the last bytes of the one before; ``report`` gets the payload's span
    in the original where a run or payload had to be cut."""
    held, limit, new = bytearray(), WINDOW, False
    for piece in pieces:
        held += piece
        new = True
        if len(held) < limit:
            continue
        border = _border(bytes(held))
        if border <= OVERLAP:
            if len(held) < INFLATED:
                limit = min(2 * len(held), INFLATED)
                continue
            report.append(span)
            border = len(held)
        yield from _views(bytes(held[:border]))
        del held[:max(0, border - OVERLAP)]
        limit, new = WINDOW + len(held), len(held) > OVERLAP
    if new:
        yield from _views(bytes(held))


def _views(data: bytes) -> Iterator[str]:
    yield data.decode("utf-8", "replace")
    if not data.isascii() and _MAGIC.search(text := data.decode("latin-1")):
        yield text


def _printable(data: bytes) -> str | None:
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if all(c.isprintable() or c in "\t\r\n" for c in text) else None


def _unpacked(run: str) -> Iterator[bytes]:
    """Bytes of a base64 run read from each of its first four characters."""
    run = run.translate({45: "+", 95: "/"})
    for at in range(4):
        n = len(run) - at
        yield base64.b64decode(run[at:at + n - (n % 4 == 1)] + "=" * (-n % 4 % 3))


def _base64(layer: _Layer, more: _Work) -> list:
    """As the other decoders, for whole runs that are UTF-8 or compressed.  The windows of a payload after its first and
    what a run holds in other ways are layers of their own, added to ``more``."""
    parts = []
    for m in _BASE64.finditer(layer.text):
        a, b = m.span()
        start, end = int(layer.starts[a:b].min()), int(layer.ends[a:b].max())
        for at, raw in enumerate(_unpacked(m.group().rstrip("="))):
            if at == 0:
                windows = iter(())
                if (text := _printable(raw)) is None:
                    pieces = _inflate(raw) or _deflated(raw)
                    windows = windows if pieces is None else _windows(pieces, more.report, (start, end))
                    if (text := next(windows, None)) is None:
                        text = _utf8(raw)
                if text is not None:
                    more.append(_placed(windows, start, end))
                    parts.append((a, b, text, np.full(len(text), a), np.full(len(text), b)))
                if raw.isascii() and text is not None:
                    continue
            if _WORTH.search(raw):
                more.append(_placed(iter((raw.decode("latin-1"),)), start, end))
    return parts


def _joined(layer: _Layer, more: _Work) -> None:
    """Adds what base64 runs over several lines hold; each character comes from the lines that its bits are in."""
    for m in _LINES.finditer(layer.text):
        lines = [(x.start(2), x.end(2), x.end()) for x in _LINE.finditer(layer.text, *m.span()) if x[2]]
        run = "".join([layer.text[a:b] for a, b, _ in lines])
        if len(run) < 16:
            continue
        sizes = [b - a for a, b, _ in lines]
        for at, raw in enumerate(_unpacked(run)):
            if not _WORTH.search(raw):
                continue
            line = np.repeat(np.arange(len(lines)), sizes)
            byte = np.arange(len(raw))
            starts = layer.starts[np.array([a for a, _, _ in lines])][line[at + byte * 4 // 3]]
            ends = layer.ends[np.array([c for _, _, c in lines]) - 1][line[at + (byte * 8 + 7) // 6]]
            more.append(iter((_Layer(raw.decode("latin-1"), starts, ends),)))


def _utf8(data: bytes) -> str | None:
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return None


def _compressed(layer: _Layer, more: _Work) -> None:
    """Adds what compressed bytes (as Latin-1 characters) in a layer inflate to, wherever they begin."""
    text, data, base = layer.text, b"", 0
    for m in _MAGIC.finditer(text):
        if m.start() >= base + len(data):
            wide = _WIDE.search(text, m.start())
            base, data = m.start(), text[m.start():wide.start() if wide else len(text)].encode("latin-1")
        at = m.start() - base
        opener = _opener(data[at:at + 16])
        if opener is None or not _opens(data[at:at + 4096], opener) or (pieces := _inflate(data[at:])) is None:
            continue
        stop = m.start() + _extent(data[at:], opener)
        start, end = int(layer.starts[m.start():stop].min()), int(layer.ends[m.start():stop].max())
        more.append(_placed(_windows(pieces, more.report, (start, end)), start, end))


def _opens(head: bytes, opener: Callable) -> bool:
    try:
        opener().decompress(head, 1 << 16)
    except (zlib.error, OSError, EOFError, lzma.LZMAError):
        return False
    return True


def _extent(data: bytes, opener: Callable) -> int:
    """Bytes of ``data`` that its compressed members take; all where one is damaged or cut."""
    at = 0
    while at < len(data) and _opener(data[at:at + 16]) is not None:
        member, rest = opener(), data[at:]
        try:
            while not member.eof:
                out = member.decompress(rest, _HEAD)
                rest = getattr(member, "unconsumed_tail", b"")
                if not out and not rest and not member.eof:
                    return len(data)
        except (zlib.error, OSError, EOFError, lzma.LZMAError):
            return at or len(data)
        at = len(data) - len(member.unused_data)
    return at


def _placed(windows: Iterator[str], start: int, end: int) -> Iterator[_Layer]:
    for text in windows:
        yield _Layer(text, np.broadcast_to(np.int64(start), len(text)), np.broadcast_to(np.int64(end), len(text)))


def findings(text: str) -> tuple[list[Finding], list[Finding]]:
    """Findings of the base patterns, and those with all decoded layers (spans of ``text``), both ordered."""
    return examined(text)[:2]


def examined(text: str) -> tuple[list[Finding], list[Finding], bool]:
    """As ``findings``; and whether nothing of the text was cut."""
    base, found, cut = unwrapped(text)
    return base, found, not cut


def unwrapped(text: str) -> tuple[list[Finding], list[Finding], list[tuple[int, int]]]:
    """As ``findings``; and the spans of payloads in which something had to be cut."""
    base = base_findings(text)
    found = set(base)
    if not ("%" in text or "\\" in text or ("&" in text and _ESCAPE.search(text)) or "\0" in text or _BASE64.search(text) or _LINES.search(text)):
        return base, base, []
    places = np.arange(len(text))
    work: list[Iterator[_Layer]] = [iter((_Layer(text, places, places + 1),))]
    seen, report = set(), []
    while work:
        if (layer := next(work[-1], None)) is None:
            work.pop()
            continue
        digest = hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest()
        if not layer.text or (key := (digest, int(layer.starts[0]), int(layer.ends[-1]))) in seen:
            continue
        if seen:  # the text itself has been scanned
            found.update((k, int(layer.starts[a:b].min()), int(layer.ends[a:b].max())) for k, a, b in base_findings(layer.text))
        seen.add(key)
        more = _Work(report)
        for reading in (layer, *_bytes_of(layer)):
            _compressed(reading, more)
        _joined(layer, more)
        for parts in (_url(layer), _form(layer), _unicode(layer), _nuls(layer), _base64(layer, more)):
            if parts:
                work.append(iter((layer.replaced(parts),)))
        work += more
    if len(found) == len(base):
        return base, base, report
    return base, sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2])), report


def written(spans: list[Finding]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        out = []
        for doc_id, body in zip(part.column("doc_id").to_pylist(), part.column("body").to_pylist()):
            base, spans, whole = examined(body.decode("utf-8", "replace"))
            out.append((doc_id, *(sum(f[0] == k for f in base) for k in KINDS), written(base), written(spans), whole))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                         ["doc_id", "n_assign", "n_access", "n_hex", "base", "spans", "fully_scanned"])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex (base findings), base and spans (kind:start:end, comma-joined),
    fully_scanned of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"))
    return rows.mapInArrow(_scan, "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string, fully_scanned boolean")


def _redacted(text: str, mark: str) -> str:
    _, found, cut = unwrapped(text)
    # a payload that could not be read as a whole may hide a secret: it goes too
    spans = sorted({(a, b) for _, a, b in found} | set(cut))
    out, at = [], 0
    for start, end in spans:
        if end > at:
            if start >= at:  # else it goes on in the span before
                out += (text[at:start], mark)
            at = end
    return "".join([*out, text[at:]]) if spans else text


def redact(docs: DataFrame, mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark``; ``n_chars`` follows where it is a column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = [None if t is None else _redacted(t, mark) for t in part.column("text").to_pylist()]
            column = pa.array(texts, part.schema.field("text").type)
            yield part.set_column(part.schema.get_field_index("text"), part.schema.field("text"), column)

    out = docs.mapInArrow(run, docs.schema)
    changed = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return out if changed is None else out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))
