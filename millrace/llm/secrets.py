"""Secret scan with a worklist of decoded layers.

A text is scanned, then every region that looks URL-escaped, Unicode-escaped,
base64-coded or compressed is decoded into a layer that is scanned in turn,
until no layer yields a new one.  Each character of a layer carries the interval
of the original text that it came from, so that a find in any depth is reported
as a span of the original text.

* Escapes are undone once and, where more appear, to their fixpoint in one pass
  over a stack, so that ``%252525...`` takes time in proportion to its length.
* Base64 runs are read at all four alignments, for a run may begin in a path;
  line ends inside are passed over.  Runs below 16 characters (12 bytes) cannot
  hold a whole secret.
* Bytes that are not UTF-8 become replacement characters; bytes with a NUL are
  read without the NULs too, which shows the ASCII of 16- and 32-bit texts.
* Bytes of any layer are searched for gzip and zlib members, all of them.
  Members unpack in windows of ``WINDOW`` bytes that share ``SHARED`` bytes, each
  a layer of its own: no size is refused, and memory stays bounded.
* A layer whose content and place were seen before is not entered again.

Patterns run over whole texts.

Defined cases: a null text counts as empty and has no spans; repeated rows are
scanned each; other columns, whatever their names, are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import read

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{14,}"), re.compile(r"[0-9a-f]{16,}")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ESCAPE = r"%([0-9A-Fa-f]{2})|%u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
ESCAPE, CLOSED = re.compile(_ESCAPE), re.compile(f"(?:{_ESCAPE})$")
#: The last characters that an escape can have, and the most characters of one.
CLOSING, LONGEST = frozenset("0123456789abcdefABCDEF};"), 10
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]{16,}+)++(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+)?={0,2}")
PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
PACKED_TEXT = re.compile(r"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
#: Bytes without any of these hold neither a secret nor another layer.
WORTH = re.compile(rb"passw|secret|token|api_?key|akia|[0-9a-z+/_-]{16}|%[0-9a-fu]|\\[ux]|&#|\0|\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]", re.IGNORECASE)
ESCAPED_BYTES = str.maketrans({i: "\ufffd" for i in range(0xDC80, 0xDD00)})
WINDOW, SHARED = 8 << 20, 64 << 10


def find(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns, by start and kind."""
    out = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(s, KINDS[k], e) for s, k, e in sorted(out)]


class Layer:
    """A decoded text; character i came from [start[i], end[i]) of the original (None: the characters are the original's).

    Both arrays rise.  A ``plain`` layer has had its escapes undone already.
    """

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None, plain: bool = False):
        self.text, self.start, self.end, self.plain = text, start, end, plain

    def span(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.start is None else (int(self.start[a]), int(self.end[b - 1]))

    def spans(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (first, last) if self.start is None else (self.start[first], self.end[last - 1])


def _runs(text: str, found: re.Pattern) -> list[tuple[int, int]]:
    """Runs of non-space characters around the matches."""
    out: list[tuple[int, int]] = []
    for m in found.finditer(text):
        if out and m.start() < out[-1][1]:
            continue
        a, b = m.start(), m.end()
        while a and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        out.append((a, b))
    return out


def _character(m: re.Match) -> str:
    """What an escape stands for; a percent byte that is not ASCII as its surrogate escape."""
    if m[1]:
        code = int(m[1], 16)
        return chr(code if code < 0x80 else 0xDC00 + code)
    code = int(m[7]) if m[7] else int(m[2] or m[3] or m[4] or m[5] or m[6], 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd"


Coded = tuple[list[str], list[int], list[int]]


def _once(text: str, a: int, b: int) -> Coded:
    """(characters, first, last) of [a, b) with its escapes undone once."""
    out, first, last, at = [], [], [], a
    for m in [*ESCAPE.finditer(text, a, b), None]:
        stop = m.start() if m else b
        out += text[at:stop]
        first += range(at, stop)
        last += range(at + 1, stop + 1)
        if m:
            out.append(_character(m))
            first.append(m.start())
            last.append(m.end())
            at = m.end()
    return out, first, last


def _wholly(text: str, a: int, b: int) -> Coded:
    """The same with all escapes undone that undoing brings about: each closes on top of a stack."""
    out, first, last = [], [], []
    for i in range(a, b):
        out.append(text[i])
        first.append(i)
        last.append(i + 1)
        while out[-1] in CLOSING and (m := CLOSED.search("".join(out[-LONGEST:]))):
            n = len(m.group())
            begin, end = first[-n], last[-1]
            del out[-n:], first[-n:], last[-n:]
            out.append(_character(m))
            first.append(begin)
            last.append(end)
    return out, first, last


def _decoded(layer: Layer, data: bytes, first: np.ndarray, last: np.ndarray, plain: bool = False) -> Layer:
    """Layer of UTF-8 ``data`` whose byte i came from [first[i], last[i]) of ``layer``; other bytes become replacement characters."""
    if data.isascii():
        return Layer(data.decode("ascii"), *layer.spans(first, last), plain)
    text = data.decode("utf-8", "surrogateescape")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    width = 1 + (codes >= 0x80) + (codes >= 0x800).astype(np.int64) + (codes >= 0x10000)
    width[(codes >= 0xDC80) & (codes < 0xDD00)] = 1
    stop = np.cumsum(width)
    return Layer(text.translate(ESCAPED_BYTES), *layer.spans(first[stop - width], last[stop - 1]), plain)


def _windows(unpack, data: memoryview, at: int) -> Iterator[bytes]:
    """What a member at ``at`` unpacks to, in windows that overlap."""
    kept, source = b"", data[at:]
    while True:
        content = unpack.decompress(source, WINDOW - len(kept))
        source = unpack.unconsumed_tail
        if content:
            yield kept + content
            kept = content[-SHARED:]
        if unpack.eof or not content or not source:
            return


def _members(layer: Layer, data: bytes, first: np.ndarray, last: np.ndarray, seen: set) -> Iterator[Layer]:
    """Layers of the gzip and zlib members in ``data``, at any depth; all that a member holds has the member's span."""
    at, view = 0, memoryview(data)
    while m := PACKED.search(data, at):
        at = m.start() + 1
        unpack = zlib.decompressobj(31 if m.group()[0] == 0x1F else 15)
        try:
            for content in _windows(unpack, view, m.start()):
                stop = len(data) - len(unpack.unused_data) if unpack.eof else len(data)
                mark = hashlib.blake2b(content, digest_size=16).digest() + int(first[m.start()]).to_bytes(8, "little")
                if mark in seen:
                    continue
                seen.add(mark)
                whole = [np.broadcast_to(x, len(content)) for x in (first[m.start()], last[stop - 1])]
                yield from _byte_layers(layer, content, *whole, seen)
        except zlib.error:
            continue
        if unpack.eof:
            at = max(at, len(data) - len(unpack.unused_data))


def _byte_layers(layer: Layer, data: bytes, first: np.ndarray, last: np.ndarray, seen: set, plain: bool = False) -> Iterator[Layer]:
    """Layers of ``data`` as text and of all that is packed in it."""
    if not WORTH.search(data):
        return
    yield _decoded(layer, data, first, last, plain)
    if b"\0" in data:
        kept = np.frombuffer(data, np.uint8) != 0
        if kept.any():
            yield _decoded(layer, data.replace(b"\0", b""), first[kept], last[kept])
    yield from _members(layer, data, first, last, seen)


def _of_escapes(layer: Layer, coded: Coded, seen: set) -> Iterator[Layer]:
    chars, first, last = coded
    text, first, last = "".join(chars), np.array(first), np.array(last)
    data = text.encode("utf-8", "surrogateescape")
    if len(data) == len(text):
        yield from _byte_layers(layer, data, first, last, seen, True)
        return
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    single = (codes >= 0xDC80) & (codes < 0xDD00)
    width = 1 + (codes >= 0x80) + (codes >= 0x800).astype(np.int64) + (codes >= 0x10000)
    width[single] = 1
    yield from _byte_layers(layer, data, np.repeat(first, width), np.repeat(last, width), seen, True)
    # characters up to 255 as bytes, as such escapes write packed ones
    raw = np.where(single | (codes < 256), codes & 0xFF, 0x3F).astype(np.uint8).tobytes()
    if PACKED.search(raw):
        yield from _members(layer, raw, first, last, seen)


def _of_base64(layer: Layer, a: int, b: int, seen: set) -> Iterator[Layer]:
    """Layers of the base64 characters in [a, b) at every alignment, white space left out."""
    raw = np.frombuffer(layer.text[a:b].rstrip("=").encode("ascii"), np.uint8)
    at = np.flatnonzero(raw > 32)
    code, at = raw[at].tobytes().translate(bytes.maketrans(b"-_", b"+/")), (a + at).astype(np.int32)
    for shift in range(4):
        n = len(code) - shift
        n -= n % 4 == 1
        data = base64.b64decode(code[shift : shift + n] + b"=" * (-n % 4))
        if WORTH.search(data):
            quad = shift + np.arange(len(data)) // 3 * 4
            yield from _byte_layers(layer, data, at[quad], at[np.minimum(quad + 3, len(at) - 1)] + 1, seen)


def _children(layer: Layer, seen: set) -> Iterator[Layer]:
    """The layers right below ``layer``."""
    t = layer.text
    if not layer.plain and ("%" in t or "\\" in t or "&#" in t):
        for a, b in _runs(t, ESCAPE):
            once = _once(t, a, b)
            yield from _of_escapes(layer, once, seen)
            if ESCAPE.search("".join(once[0])):
                yield from _of_escapes(layer, _wholly(t, a, b), seen)
    if layer.start is not None and PACKED_TEXT.search(t):
        every = np.arange(len(t))
        yield from _members(layer, t.encode("latin-1", "replace"), every, every + 1, seen)
    for a, b in sorted({m.span() for found in (BASE64, WRAPPED) for m in found.finditer(t)}):
        yield from _of_base64(layer, a, b, seen)


def scan(text: str | None) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]], int]:
    """(base spans, all spans, layers entered) of one whole text."""
    text = text or ""
    base = find(text)
    spans, seen, entered = set(base), set(), 0
    work = [_children(Layer(text), seen)]  # the open worklists of each depth; layers are made when their turn comes
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if not layer.text:
            continue
        place = f"{layer.start[0]}:{layer.end[-1]}:{layer.plain}:"
        mark = hashlib.blake2b(place.encode() + layer.text.encode("utf-8", "replace"), digest_size=16).digest()
        if mark in seen:
            continue
        seen.add(mark)
        entered += 1
        for s, kind, e in find(layer.text):
            a, b = layer.span(s, e)
            spans.add((a, kind, b))
        work.append(_children(layer, seen))
    return base, sorted(spans, key=lambda x: (x[0], KINDS.index(x[1]), x[2])), entered


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def _scan_batches(batches):
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            base, spans, layers = scan(text)
            kinds = [k for _, k, _ in base]
            rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), layers))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
        yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every row of ``docs`` (doc_id, text): counts, digest of the base spans, all spans."""
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long"
    return docs.select("doc_id", "text").mapInArrow(_scan_batches, schema)


def op8_decoding_worklist(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(read(spark, sf_dir, "documents"))


def secret_base_spans(spark, sf_dir: str) -> DataFrame:
    """The base columns of the scan, which SQL can say."""
    return op8_decoding_worklist(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def _sql_spans(kind: str, order: int, pattern: str, least: int) -> str:
    """DuckDB SQL: list of {s, k, e} of a pattern's matches with at least ``least`` characters, by marks set around them."""
    pieces = f"string_split(regexp_replace(t, '{pattern}', chr(1) || '\\0' || chr(1), 'g'), chr(1))"
    sums = "list_transform(range(1, len(p) + 1), lambda i: coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0))"
    return f"""SELECT r, doc_id, list_filter(list_transform(list_filter(range(1, len(p) + 1), lambda i: i % 2 = 0), lambda i: {{'s': (n[i] - length(p[i]))::BIGINT, 'k': {order}, 'kind': '{kind}', 'e': n[i]::BIGINT, 'm': p[i]}}), lambda x: {least}) AS a
      FROM (SELECT *, {sums} AS n FROM (SELECT r, doc_id, {pieces} AS p FROM d))"""


_ASSIGN_SQL = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+"""
_VALUE_SQL = r"""length(regexp_extract(x.m, '^(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 12"""
BASE_ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, replace(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
f AS ({_sql_spans("assign", 0, _ASSIGN_SQL, _VALUE_SQL)} UNION ALL {_sql_spans("access", 1, "AKIA[A-Z0-9]{14,}", "true")} UNION ALL {_sql_spans("hex", 2, "[0-9a-f]{16,}", "true")}),
g AS (SELECT r, any_value(doc_id) AS doc_id, list_sort(flatten(list(a))) AS a FROM f GROUP BY r)
SELECT doc_id, len(list_filter(a, lambda x: x.k = 0))::BIGINT AS n_assign, len(list_filter(a, lambda x: x.k = 1))::BIGINT AS n_access, len(list_filter(a, lambda x: x.k = 2))::BIGINT AS n_hex,
       sha256(array_to_string(list_transform(a, lambda x: x.kind || ':' || x.s || ':' || x.e), ',')) AS base_sha256 FROM g
"""
