"""Secret scans through nested encodings.

Every text is the first layer of a worklist.  A layer is scanned for the
three kinds of secrets; then each codec (URL escapes, Unicode escapes, base64
with or without compression inside) rewrites the whole layer with its encoded
parts unwrapped (what is damaged in them stays or becomes U+FFFD), which makes new layers.  Work ends when no codec changes any
layer.  A set of digests of layers met before breaks cycles.  Each layer
carries, for each of its characters, the span of the original text it came
from, so a finding deep inside maps back to code points of the document.

Results for special inputs: a null text is the empty text (no spans);
repeated rows give repeated results; an empty table gives an empty result;
other columns are ignored.  Compressed blobs may make a layer grow to
``max_layer`` characters; a blob that would exceed it is streamed, in segments
that are layers of their own.  Segments, and those of very long texts, end
after a character that belongs to no secret and no encoded part; where there
is none, segments overlap and ``unwrapped_all`` is false in that row.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, StructField, StructType

MAX_LAYER = 32 << 20
SEGMENT = 1 << 20       # characters of a segment
LOOK = 1 << 16          # characters in which a segment's end is looked for
DEPTH = 64              # compressions right inside each other
KINDS = ("assign", "access", "hex")

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")       # a whole run of 18 or more, as shorter ones are dropped
HEX = re.compile(r"[0-9a-f]{16,}")
HINTS = ("passw", "secret", "token", "api")     # one is in every assignment

ESCAPED_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPED_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
ONE_ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
HARD = re.compile(r"""[^A-Za-z0-9+/_.=\-"':%\\\s]""")       # in no secret and no encoded part
LAST_HARD = re.compile(rf"(?s:.*){HARD.pattern}")
CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
READABLE = re.compile(r"[^\x00-\x08\x0b\x0c\x0e-\x1f\x7f\ufffd]{12,}")     # tells damaged text from other bytes
LINE = re.compile(r"[\x20\t]*\r?\n[\x20\t]*([A-Za-z0-9+/_-]+)")         # one more line of a base64 blob
PADDING = re.compile("={0,2}")

#: First bytes of compressed formats.
MAGIC = ((b"\x1f\x8b", "gzip"), (b"\x78\x01", "zlib"), (b"\x78\x5e", "zlib"), (b"\x78\x9c", "zlib"),
         (b"\x78\xda", "zlib"), (b"BZh", "bz2"), (b"\xfd7zXZ\x00", "xz"), (b"\x28\xb5\x2f\xfd", "zstd"))


class TooLarge(Exception):
    """A blob holds more than a layer may."""


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of one layer's secrets, by start and kind."""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


# codecs: (start, end, [(text, start, end) of the parts it unwraps to]), or
# (start, end, bytes) of a blob that holds more than a layer may -------------

def _url(text: str, limit: int):
    for m in ESCAPED_URL.finditer(text) if "%" in text else ():
        at, parts, some = m.start(), [], False
        for c in bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "surrogateescape"):
            if "\udc80" <= c <= "\udcff":       # a byte of no character stays as it is
                parts += _kept(text, at, at + 3)
                at += 3
            else:
                n = 3 * len(c.encode())
                parts.append((c, at, at + n))
                at, some = at + n, True
        if some:
            yield m.start(), m.end(), parts


def _kept(text: str, a: int, b: int):
    return [(text[i], i, i + 1) for i in range(a, b)]


def _unicode(text: str, limit: int):
    for m in ESCAPED_UNICODE.finditer(text) if "\\" in text else ():
        parts: list[tuple[str, int, int]] = []
        for x in ONE_ESCAPE.finditer(text, m.start(), m.end()):
            code = int(x[1] or x[2] or x[3], 16)
            before = ord(parts[-1][0]) if parts and parts[-1][2] - parts[-1][1] > 1 else 0
            if 0xDC00 <= code < 0xE000 and 0xD800 <= before < 0xDC00:
                pair = chr(0x10000 + ((before - 0xD800) << 10) + code - 0xDC00)
                parts[-1] = pair, parts[-1][1], x.end()
            elif code < 0x110000:
                parts.append((chr(code), x.start(), x.end()))
            else:
                parts += _kept(text, x.start(), x.end())
        # what is no character stays as it is
        lone = [0xD800 <= ord(p[0]) < 0xE000 for p in parts]
        if any(not x and p[2] - p[1] > 1 for x, p in zip(lone, parts, strict=True)):
            yield m.start(), m.end(), [q for x, p in zip(lone, parts, strict=True) for q in (_kept(text, *p[1:]) if x else (p,))]


class _Zstd:
    """One zstd frame, with the interface of zlib's objects."""

    def __init__(self):
        import zstandard

        self.inner, self.eof, self.unconsumed_tail, self.unused_data = zstandard.ZstdDecompressor().decompressobj(), False, b"", b""

    def decompress(self, data: bytes, limit: int) -> bytes:
        out, rest = self.inner.decompress(data[:256]), data[256:]       # some MB at most
        self.eof = self.inner.eof
        self.unconsumed_tail, self.unused_data = (b"", self.inner.unused_data + rest) if self.eof else (rest, b"")
        return out


MAKE = {"gzip": lambda: zlib.decompressobj(wbits=31), "zlib": zlib.decompressobj, "bz2": bz2.BZ2Decompressor,
        "xz": lzma.LZMADecompressor, "zstd": _Zstd}


def _kind(head: bytes) -> str | None:
    return next((k for magic, k in MAGIC if head.startswith(magic)), None)


def _expanded(chunks):
    """Chunks of the text in compressed members, one after the other, and
    whatever follows them."""
    d, some = None, False
    for data in chunks:
        more = True
        while data or (more and d):
            if d is None:
                data = data.lstrip(b"\0")       # padding
                while 0 < len(data) < 6 and (chunk := next(chunks, None)) is not None:
                    data += chunk
                if not data:
                    break
                d, fresh = MAKE.get(_kind(data), lambda: None)(), True
                if d is None:
                    yield data
                    yield from chunks
                    return
            try:
                out = d.decompress(data, LOOK)
            except Exception:
                if not some:
                    raise
                if fresh:
                    yield data
                    yield from chunks
                return
            some, fresh = some or bool(out), fresh and not out
            yield out
            if d.eof:
                data, d = d.unused_data, None
            else:
                data, more = getattr(d, "unconsumed_tail", b""), len(out) == LOOK


def _opened(raw: bytes):
    """Chunks of some bytes, through any compression."""
    chunks = iter((raw,))
    for _ in range(DEPTH):
        head = b""
        while len(head) < 6 and (chunk := next(chunks, None)) is not None:
            head += chunk
        chunks = chain((head,), chunks)
        if _kind(head) is None:
            return chunks
        chunks = _expanded(chunks)
    raise TooLarge


def _readable(raw: bytes, limit: int) -> str | None:
    """Text in some bytes, through any compression; None for other bytes."""
    out = bytearray()
    try:
        for chunk in _opened(raw):
            out += chunk
            if len(out) > limit:
                raise TooLarge
    except TooLarge:
        raise
    except Exception:       # damaged data of any format is not compressed text
        return None
    text = out.decode("utf-8", "replace")
    if "\ufffd" not in text and not CONTROL.search(text):
        return text or None
    return text if READABLE.search(text) else None


def _decoded(blob: str) -> bytes | None:
    if len(blob) % 4 == 1:
        return None
    try:
        return base64.b64decode(blob.replace("-", "+").replace("_", "/") + "=" * (-len(blob) % 4), validate=True)
    except binascii.Error:
        return None


def _base64(text: str, limit: int):
    for m in BASE64.finditer(text):
        raw, size = _decoded(m[0].rstrip("=")), m.end() - m.start()
        if raw is None:
            continue
        try:
            made = _readable(raw, max(limit, size))
        except TooLarge:
            yield m.start(), m.end(), raw
            continue
        if made is not None:
            limit -= max(0, len(made) - size)
            yield m.start(), m.end(), [(made, m.start(), m.end())]


def _wrapped(text: str, limit: int):
    """Base64 over several lines, of equal length but for the first and the
    last.  The first or last may be other words beside the blob."""
    done = 0
    for m in BASE64.finditer(text):
        if m.start() < done or m[0].endswith("="):
            continue
        lines = [(m[0], m.start(), m.end())]
        while (x := LINE.match(text, lines[-1][2])) and (len(lines) < 3 or len(x[1]) <= len(lines[1][0])):
            lines.append((x[1], x.start(1), x.end()))
            if len(lines) > 2 and len(x[1]) < len(lines[1][0]):
                break
        if len(lines) < 2:
            continue
        done, best = lines[-1][1], None
        for a, b in ((0, len(lines)), (1, len(lines)), (0, len(lines) - 1), (1, len(lines) - 1)):
            raw = _decoded("".join(x[0] for x in lines[a:b])) if b - a > 1 else None
            if raw is None:
                continue
            start, end = lines[a][1], PADDING.match(text, lines[b - 1][2]).end()
            try:
                made = _readable(raw, max(limit, end - start))
            except TooLarge:
                best = start, end, raw
                break
            whole = made is not None and "\ufffd" not in made and not CONTROL.search(made)
            if whole or (made is not None and best is None):
                best = start, end, [(made, start, end)]
            if whole:
                break
        if best:
            if not isinstance(best[2], bytes):
                limit -= max(0, len(best[2][0][0]) - (best[1] - best[0]))
            done = best[1]
            yield best


def _compressed(text: str, limit: int):
    """A layer of characters below 256 that is a compressed stream itself."""
    head = text[:6].encode("latin-1", "replace")
    if any(head.startswith(magic) for magic, _ in MAGIC):
        try:
            raw = text.encode("latin-1")
            made = _readable(raw, max(limit, len(raw)))
        except UnicodeEncodeError:
            return
        except TooLarge:
            yield 0, len(text), raw
            return
        if made is not None:
            yield 0, len(text), [(made, 0, len(text))]


CODECS = (_url, _unicode, _base64, _wrapped, _compressed)


def _rewrite(text: str, spans, steps):
    """The layer with some parts unwrapped, and where its characters come from."""
    begin, end = spans
    out, begins, ends, at = [], [], [], 0

    def origin(i, j):
        return (i, j) if begin is None else (int(begin[i]), int(end[j - 1]))

    def copied(i, j):
        out.append(text[i:j])
        begins.append(np.arange(i, j) if begin is None else begin[i:j])
        ends.append(np.arange(i + 1, j + 1) if end is None else end[i:j])

    for i, j, parts in steps:
        copied(at, i)
        for made, a, b in parts:
            o = origin(a, b)
            out.append(made)
            begins.append(np.full(len(made), o[0]))
            ends.append(np.full(len(made), o[1]))
        at = j
    copied(at, len(text))
    return "".join(out), (np.concatenate(begins), np.concatenate(ends))


def _segments(layer: str, spans, i: int, j: int, raw: bytes, size: int):
    """A blob's text in layers of about ``size`` characters, with what stands
    right beside the blob: (text, spans, whether nothing can be cut)."""
    before, after = LAST_HARD.match(layer, max(0, i - LOOK), i), HARD.search(layer, j, j + LOOK)
    a, b = before.end() if before else max(0, i - LOOK), after.end() if after else min(len(layer), j + LOOK)
    exact = (before or a == 0) and (after or b == len(layer))
    origin = (i, j) if spans[0] is None else (int(spans[0][i]), int(spans[1][j - 1]))

    def beside(x, y):
        if spans[0] is None:
            return layer[x:y], np.arange(x, y), np.arange(x + 1, y + 1)
        return layer[x:y], spans[0][x:y], spans[1][x:y]

    def made(*parts):
        return "".join(p[0] for p in parts), tuple(np.concatenate([p[k] for p in parts]) for k in (1, 2))

    def inside(text):
        return text, np.full(len(text), origin[0]), np.full(len(text), origin[1])

    decoder, held, first = codecs.getincrementaldecoder("utf-8")("replace"), "", beside(a, i)
    try:
        for chunk in _opened(raw):
            held += decoder.decode(chunk)
            while len(held) >= size:
                cut = LAST_HARD.match(held)
                n = keep = cut.end() if cut else len(held)
                if not cut:
                    keep, exact = n - min(LOOK, size // 2), False
                yield *made(first, inside(held[:n])), exact
                held, first = held[keep:], inside("")
    except Exception:       # too deep, or damaged after some text
        exact = False
    yield *made(first, inside(held), beside(j, b)), exact


def _pieces(text: str, size: int):
    """A very long text in layers with their places, cut where nothing is."""
    at = 0
    while at < len(text):
        cut = len(text) - at > size and (LAST_HARD.match(text, at, at + size) or HARD.search(text, at + size))
        end = cut.end() if cut else len(text)
        yield text[at:end], (np.arange(at, end), np.arange(at + 1, end + 1))
        at = end


def find_secrets(text: str, max_layer: int = MAX_LAYER) -> tuple[list, list, int, bool]:
    """(base spans, all spans, layers, whether all was unwrapped); a span is
    (start, kind, end) in code points of ``text``."""
    base = scan(text)
    every, seen, complete, layers = set(base), set(), True, 1

    def explore(layer, spans):
        nonlocal complete
        work = [(layer, spans)]
        while work:
            layer, spans = work.pop()
            for codec in CODECS:
                steps, large = [], []
                for x in codec(layer, max(0, max_layer - len(layer))):
                    (large if isinstance(x[2], bytes) else steps).append(x)
                for i, j, raw in large:
                    for made, origin, exact in _segments(layer, spans, i, j, raw, min(SEGMENT, max_layer)):
                        complete &= bool(exact)
                        if new(made, origin):
                            explore(made, origin)
                if steps:
                    made, origin = _rewrite(layer, spans, steps)
                    if new(made, origin):
                        work.append((made, origin))

    def new(made, origin):
        """Whether a layer was not met before; then its secrets count.  Equal
        layers from other places are not the same."""
        nonlocal layers
        if not seen:
            seen.add(hashlib.sha256(text.encode()).digest())
        digest = hashlib.sha256(made.encode("utf-8", "surrogatepass"))
        if len(origin[0]) and (place := (int(origin[0][0]), int(origin[1][-1]))) != (0, len(text)):
            digest.update(repr(place).encode())
        if digest.digest() in seen:
            return False
        seen.add(digest.digest())
        layers += 1
        every.update((int(origin[0][a]), kind, int(origin[1][b - 1])) for a, kind, b in scan(made))
        return True

    if len(text) > min(max_layer, 4 * SEGMENT) and not any(text.startswith(m.decode("latin-1")) for m, _ in MAGIC):
        for part in _pieces(text, min(max_layer, 4 * SEGMENT)):
            explore(*part)
    else:
        explore(text, (None, None))
    return base, sorted(every), layers, complete


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_documents(docs: DataFrame, max_layer: int = MAX_LAYER) -> DataFrame:
    """Per document: counts and digest of the secrets in its own text, all
    spans with those found in nested layers, and the number of layers."""
    src = docs.select("doc_id", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = [find_secrets(t or "", max_layer) for t in batch.column(1).to_pylist()]
            count = [[sum(s[1] == k for s in r[0]) for r in rows] for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in count),
                 pa.array([hashlib.sha256(_joined(r[0]).encode()).hexdigest() for r in rows], pa.string()),
                 pa.array([_joined(r[1]) for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.bool_())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "unwrapped_all"])

    return src.mapInArrow(run, f"doc_id {id_type}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
                               "spans string, n_layers bigint, unwrapped_all boolean")


def redact_text(text: str, mark: str = "[secret]", max_layer: int = MAX_LAYER) -> str:
    """The text with every found span, overlapping ones joined, replaced."""
    return _redacted(text, mark, max_layer)[0]


def _redacted(text: str, mark: str, max_layer: int) -> tuple[str, bool]:
    _, spans, _, complete = find_secrets(text, max_layer)
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:], complete


def redact_documents(docs: DataFrame, mark: str = "[secret]", max_layer: int = MAX_LAYER, flag: str | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with secrets replaced in ``text``;
    null stays null.  ``flag`` names a column to add: whether all of the
    row's layers were unwrapped."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            made = [(None, True) if t is None else _redacted(t, mark, max_layer) for t in batch.column(at).to_pylist()]
            columns, names = list(batch.columns), list(batch.schema.names)
            columns[at] = pa.array([m[0] for m in made], batch.column(at).type)
            if flag:
                columns.append(pa.array([m[1] for m in made], pa.bool_()))
                names.append(flag)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, StructType([*docs.schema, StructField(flag, BooleanType())]) if flag else docs.schema)
