from __future__ import annotations

import base64
import hashlib
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from perimeter.llm import registry, secret_scan

# An independent reading of the base: plain patterns, failing matches dropped afterwards.
_KEYWORD = "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
PLAIN = {
    "assign": rf"(?:{_KEYWORD}|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def plain_base(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            enough = {"assign": lambda m: len(m[1]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
            if enough[kind](m):
                found.append((m.start(), list(PLAIN).index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return [s[2] for s in sorted(found)]


# Writers of the encodings that the operator reads.


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else (lambda b: bytes([128 + len(b)]) + b)(n.to_bytes((n.bit_length() + 7) // 8, "big"))
    return bytes([tag]) + size + body


def integer(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


def sequence(*fields):
    return der(0x30, b"".join(fields))


def rsa_key(bits=512, seed=1):
    rng = random.Random(seed)
    p, q = (rng.getrandbits(bits // 2) | 1 << (bits // 2 - 1) | 1 for _ in range(2))
    return sequence(*(integer(n) for n in (0, p * q, 65537, 12345, p, q, 11, 13, 17)))


def wrapped(name, body):
    return sequence(integer(0), sequence(der(6, bytes.fromhex(name)), b"\x05\x00"), der(4, body))


def curve_key():
    return sequence(integer(1), der(4, bytes(range(1, 33))), der(0xA0, der(6, bytes.fromhex("2a8648ce3d030107"))))


def string(b):
    return len(b).to_bytes(4, "big") + b


def openssh_key(check=b"abcd", again=b"abcd"):
    public = string(b"ssh-ed25519") + string(bytes(32))
    private = check + again + string(b"ssh-ed25519") + string(bytes(32)) + string(bytes(64)) + string(b"me")
    private += bytes(range(1, 1 + -len(private) % 8))
    return b"openssh-key-v1\0" + string(b"none") * 2 + string(b"") + (1).to_bytes(4, "big") + string(public) + string(private)


def part(value):
    data = value if isinstance(value, bytes) else json.dumps(value).encode()
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def token(alg="HS256", size=32, claims=None):
    return ".".join(part(p) for p in ({"alg": alg, "typ": "JWT"}, claims or {"sub": "1"}, bytes(range(size))))


def armoured(data, name="RSA PRIVATE KEY", newline="\n"):
    body = base64.encodebytes(data).decode().strip().replace("\n", newline)
    return f"-----BEGIN {name}-----{newline}{body}{newline}-----END {name}-----"


KEYS = {
    "rsa": rsa_key(),
    "wrapped rsa": wrapped("2a864886f70d010101", rsa_key()),
    "curve": curve_key(),
    "wrapped curve": wrapped("2a8648ce3d0201", curve_key()),
    "ed25519": wrapped("2b6570", der(4, bytes(32))),
    "openssh": openssh_key(),
    "dsa": sequence(*(integer(n) for n in (0, 2**511 + 1, 2**159 + 1, 5, 6, 7))),
    "encrypted": sequence(sequence(der(6, bytes.fromhex("2a864886f70d01050d")), sequence()), der(4, bytes(64))),
}


@pytest.mark.parametrize("name", KEYS)
def test_keys_are_confirmed_only_whole(name):
    data = KEYS[name]
    assert secret_scan.is_private_key(data)
    assert not secret_scan.is_private_key(data[:-1])
    assert not secret_scan.is_private_key(data + b"\0")
    assert not secret_scan.is_private_key(data[:1] + b"\x05" + data[2:])


def test_what_only_looks_like_a_key():
    p, q, n = 2**255 + 95, 2**254 + 79, 2**511 + 111
    assert not secret_scan.is_private_key(sequence(*(integer(x) for x in (0, n, 3, 5, p, q, 7, 7, 7))))
    certificate = sequence(sequence(integer(2), sequence(der(6, bytes.fromhex("2a864886f70d01010b")))), der(3, bytes(65)))
    public = sequence(sequence(der(6, bytes.fromhex("2a864886f70d010101")), b"\x05\x00"), der(3, bytes(65)))
    for data in (b"", b"\x30", b"\x30\x80\x00\x00", certificate, public, openssh_key(again=b"abce")):
        assert not secret_scan.is_private_key(data)
    assert secret_scan._fields(b"\x02\x81\x05\x00\x00\x00\x00\x00") is None  # length not in its shortest form
    rng = random.Random(3)
    assert not any(secret_scan.is_private_key(b"\x30" + rng.randbytes(rng.randint(1, 200))) for _ in range(2000))


def test_tokens():
    good = [token(), token("RS256", 256), token("ES256", 64), f"{part({'alg': 'dir', 'enc': 'A128GCM'})}..{part(bytes(12))}.{part(b'x')}.{part(bytes(16))}"]
    assert all(map(secret_scan.is_signed_token, good))
    bad = [token(size=31), token("none"), "eyJhbGciOiJIUzI1NiJ9.x", token().rsplit(".", 1)[0] + ".", f"{part(b'[1]')}.{part({})}.{part(bytes(32))}"]
    assert not any(map(secret_scan.is_signed_token, bad))


def spans_of(text):
    return [(s.kind, text[s.start : s.end]) for s in secret_scan.confirmed_spans(text, text.encode())]


def test_spans_in_texts():
    rsa, jwt = base64.b64encode(KEYS["wrapped rsa"]).decode(), token()
    assert spans_of(f"é key={rsa}, {jwt}. end") == [("key", rsa), ("jwt", jwt)]
    block = armoured(KEYS["rsa"])
    assert spans_of(f"x {block} y") == [("pem", block)]
    escaped = armoured(KEYS["rsa"], newline="\\n")
    assert spans_of(f'{{"private_key":"{escaped}"}}') == [("pem", escaped)]
    windows = armoured(KEYS["openssh"], "OPENSSH PRIVATE KEY", "\r\n")
    assert spans_of(windows) == [("pem", windows)]
    twice = base64.b64encode(block.encode()).decode()
    assert spans_of(f"secret: {twice}") == [("key", twice)]
    in_hex = KEYS["curve"].hex()
    assert spans_of(f"[{in_hex.upper()}]") == [("key", in_hex.upper())]
    legacy = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00\n\n" + base64.b64encode(bytes(range(64))).decode() + "\n-----END RSA PRIVATE KEY-----"
    assert spans_of(legacy) == [("pem", legacy)]
    for text in (
        armoured(rsa_key()[:-1]),
        armoured(KEYS["rsa"]).replace("END RSA", "END EC"),
        f"{rsa[:-4]}",
        "M" + "A" * 200,
        "30" * 60,
        "eyJ" + "a" * 60 + "." + "b" * 60 + "." + "c" * 43,
        base64.b64encode(b"MIIB" + bytes(60)).decode(),
    ):
        assert spans_of(text) == [], text


def random_texts():
    rng = random.Random(11)
    pieces = [
        "password", "PassWd", "secret", "Token", "api_key", "APIKEY", "apikey", "\"", "'", " ", "  ", ":", "=", "==", "abc", "abcdef", "x" * 7, ".", "\n",
        "AKIA", "AKIAAKIA", "ABCDEFGH01234567", "A" * 16, "f", "deadbeef", "0123456789abcdef01234567", "é", "日", "ſecret", "toKen", "aKIA", "-", "_", "/",
    ]
    return ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(1500)] + ["token=token:abcdefg", "token = 'token=abcdef", "passwd:=abcdef", ""]


def test_base_against_plain_patterns(spark, documents):
    rows = list(enumerate(random_texts())) + [(9000, None), (None, "token=abcdefgh"), (9001, "token=abcdefgh"), (9001, "token=abcdefgh")]
    found = secret_scan.find(documents(rows)).select("doc_id", secret_scan.span_list(F.col("base")).alias("base"))
    assert sorted((str(r["doc_id"]), r["base"]) for r in found.collect()) == sorted((str(i), ",".join(plain_base(t or ""))) for i, t in rows)


def test_registered_query_holds_the_planted(spark, documents, monkeypatch, clashing):
    jwt, block = token(), armoured(KEYS["rsa"])
    texts = {1: f"😀 {jwt}", 2: f'token = "{jwt}"', 3: f"{block}\npassword: hunter22", 4: "clean text", 5: None}
    monkeypatch.setattr(registry, "read_table", lambda *_: clashing(documents(list(texts.items()))))
    rows = {r["doc_id"]: r for r in registry.op12_secrets(spark, "").collect()}
    assert rows[1]["spans"] == f"jwt:2:{2 + len(jwt)}" and rows[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert rows[2]["spans"] == f"assign:0:{9 + len(jwt)},jwt:9:{9 + len(jwt)}"
    start = len(block) + 1
    assert rows[3]["spans"] == f"pem:0:{len(block)},assign:{start}:{start + 18}"
    base = ",".join(plain_base(texts[3]))
    assert rows[3]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert [rows[n]["n_assign"] for n in (1, 2, 3, 4, 5)] == [0, 1, 1, 0, 0]
    assert rows[4]["spans"] == rows[5]["spans"] == "" and [rows[n]["n_added"] for n in (1, 2, 3, 4, 5)] == [1, 1, 1, 0, 0]


def test_empty_table(spark, documents):
    assert secret_scan.find(documents([])).count() == 0


def test_long_texts_take_linear_time():
    texts = ["-----BEGIN A-----" * 60_000, "token" + " " * 10**6, "eyJ." * 250_000, "M" + "A" * 10**6, "deadbeef " * 10**5, "password=" * 10**5, "30" * 500_000]
    for text in texts:
        began = time.perf_counter()
        secret_scan.base_spans(text, text.encode())
        secret_scan.confirmed_spans(text, text.encode())
        assert time.perf_counter() - began < 5
