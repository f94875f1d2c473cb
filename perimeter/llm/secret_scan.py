"""Secrets in texts: plain patterns, and encoded keys and tokens confirmed by their structure.

The base is what three patterns find. What the method adds are candidates in base64 or hex that
are decoded and parsed before they are reported: private keys by their nested type and length
fields (every field must end exactly where the one around it does), and signed tokens by the
JSON of their header and the length of their signature. Random text that only looks encoded
fails at the first length.
"""

from __future__ import annotations

import binascii
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("pem", "key", "jwt")
KINDS = BASE_KINDS + ADDED_KINDS

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
# A run that is too short at its leftmost start is so at every later one.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6

_MARKER = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{1,64})-----")
# Shortest encodings looked at: an Ed25519 key in DER has 48 bytes, in base64 64 characters.
_ENCODED = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_HEXED = re.compile(r"[0-9A-Fa-f]{80,}")
_TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]*(?:\.[A-Za-z0-9_-]*)+")

_WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_HEX_RUN = bytes(120 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_CODE_RUN = bytes(120 if c < 128 and (chr(c).isalnum() or chr(c) in "+/_-") else 32 for c in range(256))


class Span(NamedTuple):
    start: int
    end: int
    kind: str


# Key encodings


class _Field(NamedTuple):
    tag: int
    body: bytes


def _fields(data: bytes) -> list[_Field] | None:
    """The fields that fill ``data`` exactly, or None. Lengths must be in their shortest form."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length = data[at], data[at + 1]
        at += 2
        if length & 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or at + size > len(data) or not data[at]:
                return None
            length = int.from_bytes(data[at : at + size], "big")
            at += size
            if length < 0x80:
                return None
        if tag & 0x1F == 0x1F or at + length > len(data):
            return None
        found.append(_Field(tag, data[at : at + length]))
        at += length
    return found


_INTEGER, _BITS, _OCTETS, _NAME, _SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30
# Object identifiers in their encoded form: RSA, elliptic curves, Ed25519, Ed448, X25519, X448,
# DSA, Diffie-Hellman, password-based encryption (PBES2).
_RSA, _CURVE = bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a8648ce3d0201")
_EDWARDS = {bytes.fromhex(f"2b65{last}") for last in ("70", "71", "6e", "6f")}
_DSA, _DIFFIE = bytes.fromhex("2a8648ce380401"), bytes.fromhex("2a864886f70d010301")
_ENCRYPTED = bytes.fromhex("2a864886f70d01050d")


def _one(data: bytes, tag: int) -> bytes | None:
    """The body of the only field, if it has the tag."""
    fields = _fields(data)
    return fields[0].body if fields and len(fields) == 1 and fields[0].tag == tag else None


def _integers(fields: list[_Field]) -> list[int] | None:
    if any(f.tag != _INTEGER or not f.body for f in fields):
        return None
    return [int.from_bytes(f.body, "big", signed=True) for f in fields]


def _rsa(fields: list[_Field]) -> bool:
    numbers = _integers(fields[:9])
    if not numbers or len(numbers) != 9 or numbers[0] not in (0, 1) or len(fields) > 9 + numbers[0]:
        return False
    modulus, p, q = numbers[1], numbers[4], numbers[5]
    return min(numbers[1:9]) > 0 and p > 1 and q > 1 and (numbers[0] == 1 or p * q == modulus)


def _dsa(fields: list[_Field]) -> bool:
    numbers = _integers(fields)
    return bool(numbers) and len(numbers) == 6 and numbers[0] == 0 and 0 < numbers[5] < numbers[2] < numbers[1]


def _curve(fields: list[_Field]) -> bool:
    if not 2 <= len(fields) <= 4 or _integers(fields[:1]) != [1]:
        return False
    if fields[1].tag != _OCTETS or not 16 <= len(fields[1].body) <= 72:
        return False
    inner = {0xA0: _NAME, 0xA1: _BITS}
    return all(f.tag in inner and _one(f.body, inner[f.tag]) for f in fields[2:])


def _wrapped(fields: list[_Field]) -> bool:
    """A private key with the name of its algorithm."""
    if len(fields) < 3 or _integers(fields[:1]) not in ([0], [1]):
        return False
    if fields[1].tag != _SEQUENCE or fields[2].tag != _OCTETS or any(f.tag not in (0xA0, 0xA1, 0x81) for f in fields[3:]):
        return False
    algorithm, inner = _fields(fields[1].body), fields[2].body
    if not algorithm or algorithm[0].tag != _NAME:
        return False
    name = algorithm[0].body
    if name in (_RSA, _CURVE):
        body = _one(inner, _SEQUENCE)
        parts = _fields(body) if body is not None else None
        return bool(parts) and (_rsa(parts) if name == _RSA else _curve(parts))
    if name in _EDWARDS:
        return len(_one(inner, _OCTETS) or b"") in (32, 56, 57)
    if name in (_DSA, _DIFFIE):
        return bool(_one(inner, _INTEGER))
    return False


def _locked(fields: list[_Field]) -> bool:
    """An encrypted private key: the scheme, then one run of whole cipher blocks."""
    if [f.tag for f in fields] != [_SEQUENCE, _OCTETS] or not fields[1].body or len(fields[1].body) % 8:
        return False
    scheme = _fields(fields[0].body)
    return bool(scheme) and [f.tag for f in scheme] == [_NAME, _SEQUENCE] and scheme[0].body == _ENCRYPTED


_OPENSSH = b"openssh-key-v1\0"


def _strings(data: bytes, count: int) -> tuple[list[bytes], bytes] | None:
    """So many strings, each after its length in four bytes, and what follows."""
    found = []
    for _ in range(count):
        if len(data) < 4 or int.from_bytes(data[:4], "big") > len(data) - 4:
            return None
        size = int.from_bytes(data[:4], "big")
        found.append(data[4 : 4 + size])
        data = data[4 + size :]
    return found, data


def _openssh(data: bytes) -> bool:
    head = _strings(data[len(_OPENSSH) :], 3)
    if not head or len(head[1]) < 4:
        return False
    (cipher, kdf, _), rest = head
    count = int.from_bytes(rest[:4], "big")
    if not 1 <= count <= 64 or (cipher == b"none") != (kdf == b"none"):
        return False
    body = _strings(rest[4:], count + 1)
    if not body or body[1] or len(body[0][-1]) % 8 or not body[0][-1]:
        return False
    public = [_strings(p, 1) for p in body[0][:-1]]
    if not all(public):
        return False
    if cipher != b"none":
        return True
    private = body[0][-1]
    kind = _strings(private[8:], 1)
    return private[:4] == private[4:8] and bool(kind) and kind[0] == public[0][0]


def is_private_key(data: bytes) -> bool:
    """Whether the bytes are the whole encoding of a private key."""
    if data.startswith(_OPENSSH):
        return _openssh(data)
    body = _one(data, _SEQUENCE) if data[:1] == b"\x30" else None
    fields = _fields(body) if body is not None else None
    return bool(fields) and any(test(fields) for test in (_rsa, _wrapped, _curve, _dsa, _locked))


# Candidates


def decoded(text: str) -> bytes | None:
    """Base64 with either alphabet; padding may be missing."""
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return binascii.a2b_base64(plain + "=" * (-len(plain) % 4), strict_mode=True)
    except (binascii.Error, ValueError):
        return None


# Signature bytes by the algorithm named in a token's header; None for a length that isn't fixed.
_SIGNATURES = {
    "HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "ES256K": 64, "EdDSA": None,
    "RS256": None, "RS384": None, "RS512": None, "PS256": None, "PS384": None, "PS512": None,
}


def _object(part: str) -> dict | None:
    data = decoded(part)
    if data is None:
        return None
    try:
        value = json.loads(data)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(text: str) -> bool:
    """Header, claims and a signature as long as the header's algorithm makes it."""
    parts = text.split(".")
    header = _object(parts[0])
    if header is None or not isinstance(header.get("alg"), str):
        return False
    if len(parts) == 5:
        return isinstance(header.get("enc"), str) and all(decoded(p) is not None for p in parts[1:])
    if len(parts) != 3 or header["alg"] not in _SIGNATURES:
        return False
    signature = decoded(parts[2])
    if signature is None or len(signature) < 32 or _object(parts[1]) is None:
        return False
    return _SIGNATURES[header["alg"]] in (None, len(signature))


_LINES = re.compile(r"[\s]+")


def _armoured(text: str) -> Iterator[tuple[int, int]]:
    """Blocks between a BEGIN and the END of the same name right after it that hold a private key."""
    begun = None
    for marker in _MARKER.finditer(text):
        if marker[1] == "BEGIN":
            begun = marker
        elif begun is not None and begun[2] == marker[2]:
            body = text[begun.end() : marker.start()].replace("\r", "").replace("\\r", "").replace("\\n", "\n")
            legacy, _, rest = body.partition("\n\n")  # header lines of an encrypted block
            locked = "ENCRYPTED" in legacy and ":" in legacy
            data = decoded(_LINES.sub("", rest if locked else body))
            whole_blocks = locked and data is not None and len(data) >= 16 and len(data) % 8 == 0
            if data is not None and (is_private_key(data) or (whole_blocks and "PRIVATE KEY" in begun[2])):
                yield begun.start(), marker.end()
            begun = None


def _holds_key(data: bytes) -> bool:
    """A key, or the armoured text of one."""
    if is_private_key(data):
        return True
    return data.startswith(b"-----BEGIN ") and next(_armoured(data.decode("latin-1")), None) is not None


def base_spans(text: str, raw: bytes) -> list[Span]:
    """What the three patterns find; ``raw`` is the text in UTF-8."""
    found = []
    low = raw.lower()
    if any(word in low for word in _WORDS):
        matches = (m for m in _ASSIGN.finditer(text) if len(m[1]) >= LEAST_VALUE)
        found += [Span(*m.span(), "assign") for m in matches]
    if b"AKIA" in raw:
        found += [Span(*m.span(), "access") for m in _ACCESS.finditer(text)]
    if b"x" * 24 in raw.translate(_HEX_RUN):
        found += [Span(*m.span(), "hex") for m in _HEX.finditer(text)]
    return found


def confirmed_spans(text: str, raw: bytes) -> list[Span]:
    """Encoded keys and signed tokens whose structure holds."""
    found = []
    if b"-----BEGIN " in raw:
        found += [Span(*place, "pem") for place in _armoured(text)]
    if b"x" * 40 in raw.translate(_CODE_RUN):
        for m in _ENCODED.finditer(text):
            # Only what begins as a sequence, an OpenSSH key or an armoured block is decoded.
            if m[0].startswith(("M", "b3Blbn", "LS0tLS1")):
                data = decoded(m[0])
                if data is not None and _holds_key(data):
                    found.append(Span(*m.span(), "key"))
        for m in _HEXED.finditer(text):
            if len(m[0]) % 2 == 0 and m[0][:2] in ("30", "6f", "6F", "2d", "2D") and _holds_key(bytes.fromhex(m[0])):
                found.append(Span(*m.span(), "key"))
    if b"eyJ" in raw:
        for m in _TOKEN.finditer(text):
            end = m.end() - (m[0].endswith(".") and m[0].count(".") == 3)  # the full stop of a sentence
            if is_signed_token(text[m.start() : end]):
                found.append(Span(m.start(), end, "jwt"))
    return found


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    for batch in batches:
        base, added = [], []
        for value in batch["text"].cast(pa.binary()):
            raw = value.as_py() or b""
            text = raw.decode("utf-8", "replace")
            base.append([s._asdict() for s in base_spans(text, raw)])
            added.append([s._asdict() for s in confirmed_spans(text, raw)])
        columns = [batch["doc_id"], pa.array(base, kind), pa.array(added, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "added"])


def find(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base and added: arrays of struct<start,end,kind>, one row per row of ``documents``.

    Offsets count code points, the end is exclusive. Null and empty texts have no spans.
    Repeated and null ids stay rows of their own; extra columns are left out. Each text is scanned
    whole and on its own, in time linear in its length, without any shuffle.
    """
    spans = "array<struct<start:int,end:int,kind:string>>"
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_scanned, f"doc_id long, base {spans}, added {spans}")


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined, by start, then kind as listed."""
    order = F.array(*map(F.lit, KINDS))
    keyed = F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("p"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    return F.array_join(
        F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
