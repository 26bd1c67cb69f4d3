"""Secret scans with structural confirmation.

Base kinds are patterns: assignments, access keys and long hex runs. Further kinds are reported only when what they hold
parses: base64 or hex that decodes to a private key in DER with nested lengths that fit exactly, the framed fields of an
OpenSSH key, or a signed token whose header and body are JSON objects and whose header names an algorithm. Base64 is read
in both alphabets and over line ends, real or escaped, and pieces of quoted strings; the key's own lengths say where it ends.
Every candidate is rejected from a few bytes of it (the headers of its outer elements) unless they fit together, so long
texts full of candidates take time in proportion to their length.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from mossgrid.llm.common import pieces, prepare

#: In this order where spans start together. The base kinds' patterns.
KINDS = ("assign", "access", "hex", "pem", "key", "jwt")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
EDGE = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
PEM_BODY = re.compile(r"[A-Za-z0-9+/=\s:,.\-_\\\"'&]*+")
#: What stands between base64 characters: white space, escaped line ends, the escape of a slash, a string that ends and goes on.
BREAK = r"\s|\\+(?:[nrt]|u000[9aAdD]|(?=[/\s]))|[\"'](?:\\+[nr])*+\s*+(?:[+.,&\\]\s*+)?[\"']"
RUN = re.compile(rf"([A-Za-z0-9+/_-]+)|\\+u002([bBfF])|(?:{BREAK})")
BREAKS = re.compile(BREAK)
PAD = rf"(?:{BREAK})*+(?:=|\\+u003[dD])"
#: The first byte is 0x30, or the OpenSSH mark; not within a word, but an escaped line end may stand before.
START = re.compile(r"M[A-P](?:(?<![A-Za-z0-9]..)|(?<=\\[nrt]..)|(?<=\\u000[9aAdD]..))")
OPENSSH = re.compile(r"b3BlbnNzaC1rZXkt")
HEAD = 18
LEAST_SYMBOLS = 40
ONE_ALPHABET = str.maketrans("-_", "+/")
HEX_BLOB = re.compile(r"[0-9A-Fa-f]{40,}")
#: A JSON object's first two characters in base64, `{` and a quote or white space; not within a word, but an escaped line end may stand before.
TOKEN = re.compile(r"(?:(?<![A-Za-z0-9])|(?<=\\[nrt]))(?:ey[A-DI-L]|ew[k-r0-3])[A-Za-z0-9_-]*")
URL_RUN = re.compile(r"[A-Za-z0-9_-]*")
TOKEN_PREFIX = 64
#: DER nested deeper is no key (encrypted ones need 7 levels), nor are more outer elements than an RSA key's.
DEEPEST = 16
MOST_PARTS = 12
#: How the object identifiers of password-based encryption begin (PKCS #5 and #12).
ENCRYPTIONS = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def der(data: bytes, at: int = 0, end: int | None = None, depth: int = 0) -> list | None:
    """DER elements as (tag, value or children) that fill data[at:end] exactly, or None."""
    end, out = len(data) if end is None else end, []
    while at < end:
        if at + 2 > end or depth > DEEPEST:
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > end:
                return None
            n = int.from_bytes(data[at : at + k], "big")
            at += k
            if n < 128:
                return None
        if at + n > end:
            return None
        inner = der(data, at, at + n, depth + 1) if tag & 0x20 else data[at : at + n]
        if inner is None:
            return None
        out.append((tag, inner))
        at += n
    return out


def framed(data: bytes) -> list[bytes] | None:
    """Fields with 4-byte lengths that fill data exactly."""
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data) or len(data) - at < 4:
            return None
        out.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return out


def is_private_key(data: bytes) -> bool:
    """PKCS#1, PKCS#8 (plain or encrypted), SEC 1 or DSA in DER, or an OpenSSH key."""
    if data[:15] == b"openssh-key-v1\0":
        at = 15
        for _ in range(3):
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        n = int.from_bytes(data[at : at + 4], "big")
        rest = framed(data[at + 4 :]) if at + 4 <= len(data) else None
        return 1 <= n <= 64 and rest is not None and len(rest) == n + 1 and len(rest[-1]) >= 16
    if data[:1] != b"\x30":
        return False
    top = der(data)
    if not top or len(top) != 1:
        return False
    parts = top[0][1]
    tags = [t for t, _ in parts]
    number = lambda k: int.from_bytes(parts[k][1], "big") if tags[k] == 2 and 0 < len(parts[k][1]) <= 2 else -1
    named = lambda k: bool(parts[k][1]) and parts[k][1][0][0] == 6
    if len(tags) >= 6 and set(tags) == {2} and number(0) in (0, 1):
        return True
    if tags[:3] == [2, 0x30, 4] and number(0) in (0, 1) and named(1):
        return True
    if tags[:2] == [2, 4] and number(0) == 1 and len(parts[1][1]) >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:]):
        return True
    return tags == [0x30, 4] and named(0) and parts[0][1][0][1].startswith(ENCRYPTIONS)


def unpacked(blob: str) -> bytes | None:
    """What base64 (either alphabet) holds, padding left out or not."""
    body = blob.rstrip("=").translate(ONE_ALPHABET)
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_object(packed: str) -> dict | None:
    try:
        found = json.loads(unpacked(packed) or b"")
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def may_open(head: str) -> bool:
    """Whether a JSON object may begin here, by its first characters."""
    try:
        json.JSONDecoder().raw_decode((unpacked(head[:TOKEN_PREFIX]) or b"").decode("utf-8", "replace"))
    except json.JSONDecodeError as e:
        return len(head) > TOKEN_PREFIX and (e.msg.startswith("Unterminated") or e.pos > TOKEN_PREFIX * 3 // 4 - 12)
    except RecursionError:
        return False
    return True


def signed_tokens(text: str) -> list[tuple[int, int]]:
    """Spans of header.body.signature whose first two parts hold JSON objects, the header with an algorithm."""
    found, last = [], 0
    at = 0
    while m := TOKEN.search(text, at):
        at = m.start() + 1
        head = m[0]
        if text[m.end() : m.end() + 1] != "." or not may_open(head):
            continue
        header = is_object(head)
        if header is None or not isinstance(header.get("alg"), str) or not header["alg"]:
            continue
        body = URL_RUN.match(text, m.end() + 1)
        if body[0] and text[body.end() : body.end() + 1] == "." and is_object(body[0]) is not None and m.start() >= last:
            at = last = URL_RUN.match(text, body.end() + 1).end()
            found.append((m.start(), last))
    return found


def key_bytes(head: bytes) -> int | None:
    """Length of a DER private key as its first bytes give it, or None if it doesn't start like one."""
    long = head[1] & 0x7F if head[1] & 0x80 else 0
    if head[0] != 0x30 or long > 4 or head[1] == 0x80:
        return None
    inner = head[2 + long :]
    if inner[:2] not in (b"\x02\x01", b"\x02\x02") and not (inner[:1] == b"\x30" and (inner[2:3] == b"\x06" or inner[1] & 0x80)):
        return None
    return 2 + long + (int.from_bytes(head[2 : 2 + long], "big") if long else head[1])


class Region:
    """The base64 characters from a place on, up to what can't be base64, and where they stand."""

    def __init__(self, text: str, start: int) -> None:
        parts, self.at, self.from_, n, at = [], [], [], 0, start
        while m := RUN.match(text, at):
            at = m.end()
            if m[1] or m[2]:
                parts.append(m[1] or ("+" if m[2] in "bB" else "/"))
                self.at.append(n)
                self.from_.append(m.start())
                n += len(parts[-1])
        self.symbols, self.end = "".join(parts).translate(ONE_ALPHABET), at

    def index(self, place: int) -> int:
        k = bisect_right(self.from_, place) - 1
        return self.at[k] + place - self.from_[k]

    def after(self, index: int, text: str) -> int:
        """The place after a symbol."""
        k = bisect_right(self.at, index) - 1
        whole = (self.at[k + 1] if k + 1 < len(self.at) else len(self.symbols)) == index + 1
        return RUN.match(text, self.from_[k]).end() if whole else self.from_[k] + index - self.at[k] + 1

    def bytes_from(self, index: int) -> Callable[[int, int], bytes]:
        """Reads n decoded bytes at a place of what begins at a symbol; fewer where it ends."""

        def get(at: int, n: int) -> bytes:
            a = index + at // 3 * 4
            part = self.symbols[a : a + (at % 3 + n + 2) // 3 * 4]
            return binascii.a2b_base64(part[: len(part) // 4 * 4])[at % 3 : at % 3 + n]

        return get


def fits(get: Callable[[int, int], bytes], size: int) -> bool:
    """Whether the outer elements of a DER sequence of so many bytes follow each other up to its end."""
    head = get(0, 2)
    at = 2 + (head[1] & 0x7F if head[1] & 0x80 else 0)
    for _ in range(MOST_PARTS):
        part = get(at, 6)
        if len(part) < 2:
            return False
        long = part[1] & 0x7F if part[1] & 0x80 else 0
        if long > 4 or part[1] == 0x80:
            return False
        at += 2 + long + (int.from_bytes(part[2 : 2 + long], "big") if long else part[1])
        if at >= size:
            return at == size
    return False


def openssh_bytes(get: Callable[[int, int], bytes]) -> int | None:
    """Length of an OpenSSH key: its mark, three fields, the number of keys, a field of each and the private one."""
    at = 15
    number = lambda: int.from_bytes(get(at, 4), "big")
    for _ in range(3):
        at += 4 + number()
    fields = number() + 1
    at += 4
    if not 2 <= fields <= 65:
        return None
    for _ in range(fields):
        at += 4 + number()
    return at


def base64_keys(text: str) -> list[tuple[int, int]]:
    """Spans of private keys in base64 without regard to armour."""
    found, last, region = [], 0, None
    starts = [(m.start(), False) for m in START.finditer(text)]
    if "b3BlbnNzaC1rZXkt" in text:
        starts = sorted(starts + [(m.start(), True) for m in OPENSSH.finditer(text)])
    for start, openssh in starts:
        if start < last:
            continue
        if region is None or start >= region.end:
            region = Region(text, start)
        i = region.index(start)
        get = region.bytes_from(i)
        head = get(0, HEAD)
        size = openssh_bytes(get) if openssh else key_bytes(head) if len(head) == HEAD else None
        need = -(-size * 4 // 3) if size else 0
        if not LEAST_SYMBOLS <= need <= len(region.symbols) - i or not openssh and not fits(get, size):
            continue
        data, end = unpacked(region.symbols[i : i + need]), region.after(i + need - 1, text)
        if data is None or text[end : end + 1].isascii() and text[end : end + 1].isalnum() or not is_private_key(data):
            continue
        if need % 4:
            end = re.compile(rf"(?:{PAD}){{0,{4 - need % 4}}}").match(text, end).end()
        found.append((start, end))
        last = end
    return found


def pem_blocks(text: str) -> list[tuple[int, int]]:
    """Spans from a BEGIN line to the END line of the same label after it, no other BEGIN between, whose body holds a key."""
    found, begin = [], None
    for m in EDGE.finditer(text):
        if m[1] == "BEGIN":
            begin = m
        elif begin is not None and begin[2] == m[2]:
            body = text[begin.end() : m.start()]
            if PEM_BODY.fullmatch(body) and confirmed_pem(m[2], body):
                found.append((begin.start(), m.end()))
            begin = None
    return found


def confirmed_pem(label: str, body: str) -> bool:
    lines = [x for x in re.split(r"\r?\n|\\+[nr]", body) if ":" not in x]
    packed = re.sub(r"\\+u003[dD]", "=", BREAKS.sub("", "\n".join(lines)))
    data = unpacked(packed.replace("\\u002b", "+").replace("\\u002B", "+").replace("\\u002f", "/").replace("\\u002F", "/"))
    return data is not None and (is_private_key(data) or ("Proc-Type:" in body and len(data) >= 64 and len(data) % 8 == 0))


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by start and kind. A key's base64 inside a PEM block isn't reported again."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        found += [("pem", a, b) for a, b in pem_blocks(text)]
    begins, ends = ([x[k] for x in found if x[0] == "pem"] for k in (1, 2))
    found += [("key", a, b) for a, b in base64_keys(text) if not (k := bisect_right(begins, a)) or a >= ends[k - 1]]
    for m in HEX_BLOB.finditer(text):
        if m[0][:2] == "30" and len(m[0]) % 2 == 0 and is_private_key(bytes.fromhex(m[0])):
            found.append(("key", *m.span()))
    if "." in text:
        found += [("jwt", a, b) for a, b in signed_tokens(text)]
    return sorted(set(found), key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan_secrets(df: DataFrame, text: str = "text", redact: bool = False, mask: str = "[secret]") -> DataFrame:
    """Adds secrets, an array of (kind, start, end) of each whole text; with redact, also replaces their union in the text by mask.

    Null and empty texts have no secrets (null stays null). Repeated rows have equal results, rows aren't compared. Other
    columns are kept; an earlier column secrets is replaced. Keys in DER nested deeper than DEEPEST aren't confirmed.
    Tables may be empty.
    """
    prepare(df.sparkSession)
    df = df.drop("secrets")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def masked(value: str | None, spans: list) -> str | None:
        out, at, last = [], 0, -1
        for _, a, b in spans:
            if a >= last:
                out += [value[at:a] if at < a else "", mask]
            at = last = max(last, b, at)
        return value if not spans else "".join([*out, value[at:]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            values = batch.column(text).to_pylist()
            spans = [find_secrets(x or "") for x in values]
            columns = list(batch.columns)
            if redact:
                columns[batch.schema.names.index(text)] = pa.array([masked(v, s) for v, s in zip(values, spans, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans], kind)], [*batch.schema.names, "secrets"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(scan, f"{fields}, secrets array<struct<kind:string,start:bigint,end:bigint>>")
