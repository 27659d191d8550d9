"""Secrets in texts: pattern spans, and spans whose structure confirms them.

Base kinds (fixed patterns; leftmost, non-overlapping for each kind): ``assign``, ``access``, ``hex``. Confirmed kinds:

* ``pem``: an armoured private key whose base64 body decodes to a whole key encoding (an encrypted one to whole cipher blocks);
* ``jwt``: three base64url parts, the first two JSON objects, the first with a text ``alg``; a signature of the length that alg has;
* ``key``: a base64 or hex run outside of those that decodes to a whole private key: DER whose nested lengths all fit (PKCS 1,
  PKCS 8, EC) or the OpenSSH container.

Every candidate of every text is decoded and parsed. Spans count code points, ends exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the base patterns, least lengths and order of kinds
ASSIGN = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
BASE = ("assign", "access", "hex")

KINDS = (*BASE, "pem", "jwt", "key")
SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}
HINTS = ("passw", "secret", "token", "apikey", "api_key")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), m.end(), "assign") for m in re.finditer(ASSIGN, text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in re.finditer(ACCESS, text) if m.end() - m.start() >= LEAST["access"]]
    # a run of hex digits is matched as a whole, so only long ones need be looked for
    out += [(m.start(), m.end(), "hex") for m in re.finditer(r"(?<![0-9a-f])[0-9a-f]{24,}", text)]
    return out


def der(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the values in data[at:end]; None unless their lengths fill it exactly."""
    out = []
    while at < end:
        if end - at < 2:
            return None
        tag, n, at = data[at], data[at + 1], at + 2
        if tag & 0x1F == 0x1F or n == 0x80 or n > 0x84:
            return None
        if n > 0x80:
            k = n - 0x80
            n = int.from_bytes(data[at : at + k], "big")
            if n < 0x80 or at + k > end or data[at] == 0:  # lengths are written in the fewest bytes
                return None
            at += k
        if at + n > end:
            return None
        out.append((tag, at, at + n))
        at += n
    return out


def der_key(data: bytes) -> bool:
    """A whole DER private key: PKCS 1 (RSA, DSA), PKCS 8 or EC."""
    top = der(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    inner = der(data, *top[0][1:])
    if not inner or inner[0][0] != 0x02 or inner[0][2] - inner[0][1] != 1:
        return False
    tags, version = [x[0] for x in inner], data[inner[0][1]]
    if len(tags) in (6, 9) and set(tags) == {0x02} and version in (0, 1):
        return all(b > a for _, a, b in inner) and len(data) >= 32
    if tags[:3] == [0x02, 0x30, 0x04] and version in (0, 1):
        name = der(data, *inner[1][1:])
        return bool(name) and name[0][0] == 0x06 and inner[2][2] - inner[2][1] >= 16
    return tags[:2] == [0x02, 0x04] and version == 1 and inner[1][2] - inner[1][1] in (20, 24, 28, 32, 48, 66) and all(t in (0xA0, 0xA1) for t in tags[2:]) and len(tags) > 2


def openssh_key(data: bytes) -> bool:
    """A whole OpenSSH private key container."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False

    def field(at: int) -> tuple[bytes, int]:
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            raise ValueError
        return data[at + 4 : at + 4 + n], at + 4 + n

    try:
        at = len(magic)
        for _ in range(3):
            _, at = field(at)
        keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        if not 1 <= keys <= 1000:
            return False
        for _ in range(keys + 1):
            last, at = field(at)
        return at == len(data) and len(last) > 0 and len(last) % 8 == 0
    except ValueError:
        return False


def private_key(data: bytes) -> bool:
    return der_key(data) or openssh_key(data)


def unbase64(text: str) -> bytes | None:
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def pem(head: str, body: str) -> bool:
    lines = [x.strip() for x in body.strip().splitlines()]
    encrypted = head.startswith("ENCRYPTED") or any(x.startswith("Proc-Type:") and "ENCRYPTED" in x for x in lines)
    data = unbase64("".join(x for x in lines if ":" not in x))
    if not data:
        return False
    if head.startswith("ENCRYPTED"):
        return bool(der(data, 0, len(data))) and data[0] == 0x30
    return len(data) % 8 == 0 if encrypted else private_key(data)


def jwt(text: str) -> bool:
    head, claims, sign = text.split(".")
    try:
        h, c = (json.loads(unbase64(x) or b"") for x in (head, claims))
    except (ValueError, RecursionError):
        return False
    if not isinstance(h, dict) or not isinstance(c, dict) or not isinstance(h.get("alg"), str):
        return False
    if h["alg"].lower() == "none":
        return sign == ""
    got = unbase64(sign) if sign else None
    return bool(got) and len(got) == SIGNATURES.get(h["alg"], len(got)) and (h["alg"][:2] not in ("RS", "PS") or len(got) >= 128)


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    if "PRIVATE KEY-----" in text:
        for m in re.finditer(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----((?:(?!-----).)*)-----END \1-----", text, re.S):
            if pem(m[1], m[2].replace("\\n", "\n")):
                out.append((m.start(), m.end(), "pem"))
    if "ey" in text:
        for m in re.finditer(r"(?<![A-Za-z0-9_-])ey[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*", text):
            if jwt(m[0]):
                out.append((m.start(), m.end(), "jwt"))
    taken = sorted((a, b) for a, b, _ in out)
    for m in re.finditer(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}", text):
        if any(a < m.end() and m.start() < b for a, b in taken):
            continue
        word = m[0]
        data = bytes.fromhex(word) if len(word) % 2 == 0 and re.fullmatch(r"[0-9a-fA-F]+", word) else None
        if data and private_key(data) or (data := unbase64(word)) and private_key(data):
            out.append((m.start(), m.end(), "key"))
    return out


def ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, spans, base_sha256, joined): the spans of every row's whole text, as an array of (kind, start, end, value).

    Null and empty texts have none. Rows that repeat are scanned each. An empty table gives no rows.
    """
    kind = dict(docs.dtypes)[key]
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, sums, words = [], [], []
            for text in batch["__text"].to_pylist():
                text = text or ""
                base = ordered(base_spans(text))
                every = ordered(base + confirmed_spans(text))
                spans.append([{"kind": k, "start": a, "end": b, "value": text[a:b]} for a, b, k in every])
                sums.append(hashlib.sha256(joined(base).encode()).hexdigest())
                words.append(joined(every))
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(spans, pa.list_(span)), pa.array(sums), pa.array(words, pa.string())], names=[key, "spans", "base_sha256", "joined"])

    return docs.select(key, F.col("text").alias("__text")).mapInArrow(run, f"`{key}` {kind}, spans array<struct<kind:string,start:int,end:int,value:string>>, base_sha256 string, joined string")
