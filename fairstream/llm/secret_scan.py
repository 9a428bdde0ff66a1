"""Secret scans with structural confirmation.

Three base kinds come from patterns alone. Beyond them, base64 and hex
candidates are decoded and their inside is parsed before anything is reported:

- ``jwt``: header and payload are JSON objects and the header names an algorithm;
- ``der``: an ASN.1 sequence whose nested lengths fill it exactly and that is laid
  out as a PKCS#1, DSA, PKCS#8 or SEC1 private key;
- ``openssh``: the ``openssh-key-v1`` container with its length-prefixed fields.

Every possible start in a run of base64 or hex, and every header in a row of dotted
words, is tried. Lengths are read first, and only the bytes of a header are decoded,
so a start that fails costs a few reads however long its run is. Lines of base64 may
be wrapped, indented, or joined by a written-out backslash-n.

Map-only. Defined results: null and empty texts have no spans; very long texts are
scanned whole; repeated rows are scanned each on their own; an empty table gives no
rows; input columns with the name of a result are replaced. Offsets are code points,
end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import functools
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fairstream.llm.shared import add_arrow_columns

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "jwt", "der", "openssh")
Span = tuple[str, int, int]

_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                     re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
#: Three dotted words or more; a header is the base64 of "{" and what may follow it.
_DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+){2,}+")
_JSON_START = re.compile("(?=e[yw])")
#: A DER sequence of two length bytes or fewer starts so; wrapped lines are one run.
#: A further line holds no blank and is no PEM footer.
_B64 = re.compile(r"(?:M[A-P]|b3BlbnNza)[A-Za-z0-9+/_-]{30,}"
                  r"(?:(?:\r?\n|(?:\\r)?\\n)[\x20\t]*(?!-----)[A-Za-z0-9+/_-]++(?!\x20))*={0,2}")
_B64_START = re.compile(r"(?=M[A-P]|b3BlbnNza)")
_LINE_END = re.compile(r"(?:[\r\n=\x20\t]|\\[rn])+")
_HEX_DER = re.compile(r"30[0-9A-Fa-f]{62,}")
_HEX_START = re.compile(r"(?=30)")
_PADDING = re.compile("={0,2}")
#: A structure of fewer bytes is no candidate.
_LEAST = 24

FIELDS = [
    T.StructField("secret_spans", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType())]))),
    T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()),
    T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
]


def _unbase64(text: str) -> bytes | None:
    flat = re.sub(r"[\r\n=]", "", text).replace("-", "+").replace("_", "/")
    flat = flat[:len(flat) - (len(flat) % 4 == 1)]
    try:
        return base64.b64decode(flat + "=" * (-len(flat) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _header(data: bytes, at: int, size: int) -> tuple[int, int, int] | None:
    """Tag, start and end of a DER value; None if it is malformed or larger than ``size``."""
    tag, n, body = data[at], data[at + 1], at + 2
    if n >= 128:
        width = n & 127
        if not 1 <= width <= 4:
            return None
        n = int.from_bytes(data[body:body + width], "big")
        body += width
    return (tag, body, body + n) if body + n <= size else None


Reader = Callable[[int, int], bytes]


def _header_at(read: Reader, size: int, at: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the DER value at ``at``; None if it is malformed or
    does not end within ``size``."""
    head = read(at, 6)
    if len(head) < 2:
        return None
    h = _header(head + bytes(4), 0, 1 << 40)
    return (h[0], at + h[1], at + h[2]) if h and at + h[2] <= size and h[1] <= len(head) else None


def _values(read: Reader, start: int, end: int, most: int) -> list[tuple[int, int, int]] | None:
    """The values that fill ``start`` to ``end`` exactly, ``most`` at the most."""
    out, at = [], start
    while at < end:
        h = _header_at(read, end, at)
        if h is None or len(out) == most:
            return None
        out.append(h)
        at = h[2]
    return out


def _fills(read: Reader, start: int, end: int) -> bool:
    """Whether the nested values of a constructed one end exactly where it does."""
    todo = [(start, end)]
    while todo:
        at, stop = todo.pop()
        inside = _values(read, at, stop, stop - at)
        if inside is None:
            return False
        todo += [(a, b) for tag, a, b in inside if tag & 0x20]
    return True


def key_length(read: Reader, size: int) -> int | None:
    """Bytes of the DER private key that the data begins with, or None. Its layout is
    known by its outer values alone, so little is read of what is no key; what is
    nested in the algorithm and the attributes must fill it."""
    outer = _header_at(read, size, 0)
    if outer is None or outer[0] != 0x30:
        return None
    version = _header_at(read, outer[2], outer[1])
    if version is None or version[0] != 2 or version[2] - version[1] != 1 or read(version[1], 1)[0] > 1:
        return None
    rest = _values(read, version[2], outer[2], 9)
    if not rest:
        return None
    tags = [t for t, _, _ in rest]
    integers = tags.count(2)
    whole = (
        tags[:8] == [2] * 8 and tags[8:] in ([], [0x30])                    # PKCS#1
        or integers == len(tags) and integers >= 3                          # DSA and older layouts of integers
        or tags[:2] == [0x30, 4] and set(tags[2:]) <= {0xA0, 0xA1, 0x81}    # PKCS#8
        or tags[0] == 4 and set(tags[1:]) <= {0xA0, 0xA1})                  # SEC1
    return outer[2] if whole and all(_fills(read, a, b) for t, a, b in rest if t & 0x20) else None


def openssh_length(read: Reader, size: int) -> int | None:
    """Bytes of the ``openssh-key-v1`` container that the data begins with, or None:
    cipher, kdf, options, key count, the public keys, then the private part. ``size``
    if the data ends before the container does."""
    magic = b"openssh-key-v1\0"
    if read(0, len(magic)) != magic:
        return None

    def number(at: int) -> int:
        return int.from_bytes(read(at, 4), "big")

    at, cipher = len(magic), b""
    for k in range(3):
        n = number(at)
        if at + 8 + n > size:
            return None
        if k == 0:
            cipher = read(at + 4, min(n, 64))
        at += 4 + n
    keys, n = number(at), number(at + 4)
    if not cipher or not 1 <= keys <= 64 or at + 8 + n > size:
        return None
    at += 4
    for _ in range(keys + 1):
        if at + 4 > size:
            return size
        at += 4 + number(at)
    at += 16 * (b"gcm" in cipher or b"poly1305" in cipher)              # the tag follows
    return min(at, size)


def _json_object(data: bytes) -> dict | None:
    try:
        found = json.loads(data)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def _token_header(word: str) -> tuple[int, dict] | None:
    """Where in a dotted word the header of a signed token starts (the first place
    that will do), and the header: a JSON object up to the word's end that names an
    algorithm. The word is decoded once for each of the four ways to start."""
    decoded: dict[int, tuple[bytes, str] | None] = {}
    reader = json.JSONDecoder()
    for m in _JSON_START.finditer(word):
        way = m.start() % 4
        if way not in decoded:
            data = _unbase64(word[way:]) if len(word) > way else None
            ends = data is not None and data.rstrip(b" \t\r\n").endswith(b"}") and b'"alg"' in data
            decoded[way] = (data, data.decode("latin-1")) if ends else None
        if not decoded[way]:
            continue
        data, text = decoded[way]
        at = (m.start() - way) // 4 * 3
        try:
            _, end = reader.raw_decode(text, at)            # stops at the first fault
        except (ValueError, RecursionError):
            continue
        if not text[end:].strip(" \t\r\n"):
            header = _json_object(data[at:])
            if header is not None and isinstance(header.get("alg"), str):
                return m.start(), header
    return None


def token_spans(text: str) -> Iterator[Span]:
    """Compact signed tokens: a JSON header with an algorithm, a JSON payload and a
    signature (none for the algorithm "none"). Every word may be the header, so
    nothing in front of a token hides it; tokens may overlap."""
    for run in _DOTTED.finditer(text):
        words, starts = run[0].split("."), [run.start()]
        for w in words:
            starts.append(starts[-1] + len(w) + 1)
        for k in range(len(words) - 2):
            payload = _json_object(_unbase64(words[k + 1]) or b"") if words[k] and words[k + 1] else None
            found = _token_header(words[k]) if payload is not None else None
            if found and (words[k + 2] or found[1]["alg"] == "none"):
                yield "jwt", starts[k] + found[0], starts[k + 2] + len(words[k + 2])


def base_spans(text: str) -> Iterator[Span]:
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        yield from (("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12)
    if "AKIA" in text:
        yield from (("access", *m.span()) for m in _ACCESS.finditer(text))
    yield from (("hex", *m.span()) for m in _HEX.finditer(text))


def _structures(starts: Iterator[int], n_units: int, read: Callable[[int, int, int], bytes], size: Callable[[int], int],
                units: Callable[[int], int]) -> Iterator[tuple[str, int, int]]:
    """Kind, start and end of the structures of one run of ``n_units`` characters.

    ``read(start, at, n)`` decodes ``n`` bytes from byte ``at`` on of what starts at a
    character, ``size(n)`` gives the bytes of ``n`` characters and ``units(n)`` the
    characters of ``n`` bytes. The search goes on behind a structure that is whole,
    else at the next start."""
    after = 0
    for start in starts:
        if start < after:
            continue
        data, held = functools.partial(read, start), size(n_units - start)
        if length := openssh_length(data, held):
            end = min(n_units, start + units(length))
            yield "openssh", start, end
            if length < held:
                after = end
        elif (length := key_length(data, held)) and length >= _LEAST:
            after = start + units(length)
            yield "der", start, after


def _base64_spans(text: str) -> Iterator[Span]:
    for run in _B64.finditer(text):
        lines, flat, total = [], [], 0      # where each line starts in the text and in the flat run
        last = run.start()
        for m in (*_LINE_END.finditer(text, run.start(), run.end()), None):
            end = m.start() if m else run.end()
            if end > last:
                lines.append((total, last))
                flat.append(text[last:end])
                total += end - last
            last = m.end() if m else end
        whole = "".join(flat).replace("-", "+").replace("_", "/")

        def read(start: int, at: int, n: int) -> bytes:
            lo = start + at // 3 * 4
            part = whole[lo:start + -(-(at + n) // 3) * 4]
            part = part[:len(part) - (len(part) % 4 == 1)]
            return base64.b64decode(part + "=" * (-len(part) % 4))[at % 3:at % 3 + n]

        def place(at: int) -> int:
            k = bisect.bisect_right(lines, (at, 1 << 60)) - 1
            return lines[k][1] + at - lines[k][0]

        starts = (m.start() for m in _B64_START.finditer(whole))
        for kind, a, b in _structures(starts, total, read, lambda n: n * 3 // 4, lambda n: -(-n * 4 // 3)):
            end = place(b - 1) + 1
            yield kind, place(a), _PADDING.match(text, end, run.end()).end()


def _hex_spans(text: str) -> Iterator[Span]:
    for run in _HEX_DER.finditer(text):
        whole = run[0]

        def read(start: int, at: int, n: int) -> bytes:
            part = whole[start + 2 * at:start + 2 * (at + n)]
            return bytes.fromhex(part[:len(part) & ~1])

        starts = (m.start() for m in _HEX_START.finditer(whole))
        for kind, a, b in _structures(starts, len(whole), read, lambda n: n // 2, lambda n: 2 * n):
            if kind == "der":
                yield kind, run.start() + a, run.start() + b


def structural_spans(text: str) -> Iterator[Span]:
    """Candidates that decode and parse."""
    if "." in text:
        yield from token_spans(text)
    yield from _base64_spans(text)
    yield from _hex_spans(text)


def find(text: str) -> list[Span]:
    """All spans by start, then kind as listed."""
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted({*base_spans(text), *structural_spans(text)}, key=lambda s: (s[1], order[s[0]], s[2]))


def join_spans(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``FIELDS``."""
    def make() -> Callable[[pa.RecordBatch], list]:
        def work(batch: pa.RecordBatch) -> list:
            out: list[list] = [[] for _ in FIELDS]
            for text in batch.column(text_col).to_pylist():
                spans = find(text) if text else []
                base = [s for s in spans if s[0] in BASE]
                counts = [sum(s[0] == k for s in base) for k in BASE]
                row = ([{"kind": k, "start": a, "end": b} for k, a, b in spans], *counts,
                       hashlib.sha256(join_spans(base).encode()).hexdigest(), join_spans(spans))
                for x, v in zip(out, row, strict=True):
                    x.append(v)
            return out
        return work
    return add_arrow_columns(docs, FIELDS, make)


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with every span (overlapping ones as one) replaced by a mark that
    names the kind that starts first."""
    out, last, end = [], 0, -1
    for kind, a, b in spans:
        if a >= end:
            out += [text[last:max(a, last)], f"[{kind} removed]"]
        end = last = max(end, b)
    return "".join(out) + text[last:]


def redact(docs: DataFrame, text_col: str = "text", count_col: str = "n_masked") -> DataFrame:
    """``docs`` with the secrets in the texts masked and the number of spans in
    ``count_col``; no row is dropped."""
    def make() -> Callable[[pa.RecordBatch], list]:
        def work(batch: pa.RecordBatch) -> list:
            texts = batch.column(text_col).to_pylist()
            spans = [find(t) if t else [] for t in texts]
            return [[mask(t, s) if s else t for t, s in zip(texts, spans, strict=True)], list(map(len, spans))]
        return work
    fields = [T.StructField(text_col, T.StringType()), T.StructField(count_col, T.LongType())]
    masked = add_arrow_columns(docs, fields, make)
    return masked.select(*[c for c in docs.columns if c.lower() != count_col.lower()], count_col)
