"""Secret scanning: pattern hits, and candidates confirmed by decoding their structure."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .common import map_batches

#: Base patterns and least lengths.
ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS = 8, 16
#: Kinds in the order that ties on a start follow: base kinds, then confirmed structures.
KINDS = ("assign", "access", "hex", "pem", "token", "key")

PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
#: A token: two JSON objects, whose base64 begins with these letters, and a signature.
SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(e[yw][A-Za-z0-9_-]{8,})\.(e[yw][A-Za-z0-9_-]*)\.([A-Za-z0-9_-]*)")
BLOB = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
#: Base64 broken into lines of equal length, as mail and configuration files have it.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/=])(?:[A-Za-z0-9+/]{40,100}\r?\n[\x20\t]*){1,}[A-Za-z0-9+/]{1,100}={0,2}(?![A-Za-z0-9+/=])")
#: How often a candidate is decoded again: base64 of a PEM, hex of that, and so on.
LAYERS = 3
MIXED_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}(?![0-9A-Fa-f])")


def from_base64(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64 with or without padding, or None."""
    text = text.rstrip("=").translate(str.maketrans("-_", "+/"))
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_element(data: bytes, at: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the DER element at ``at``, if its length fits."""
    if at + 2 > len(data):
        return None
    tag, first, at = data[at], data[at + 1], at + 2
    if first < 0x80:
        size = first
    else:
        width = first & 0x7F
        if not 1 <= width <= 4 or at + width > len(data) or data[at] == 0:
            return None
        size = int.from_bytes(data[at : at + width], "big")
        at += width
        if size < 0x80:
            return None
    return (tag, at, at + size) if at + size <= len(data) else None


def der_children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """Elements that fill ``data[start:end]`` exactly, or None."""
    out = []
    while start < end:
        item = der_element(data, start)
        if item is None or item[2] > end:
            return None
        out.append(item)
        start = item[2]
    return out


def is_der_key(data: bytes) -> bool:
    """A DER private key: one SEQUENCE over all bytes whose parts nest as a key's parts do.

    PKCS#1: version and eight more integers whose lengths fit each other: a modulus of 512 bits or more, two primes that together are as long, three
    numbers no longer than these. SEC 1: version 1 and an octet string. PKCS#8: version, an algorithm sequence that starts with an object
    identifier, and an octet string that holds a key of one of these kinds, or one octet string or integer of 16 bytes or more.
    """
    outer = der_element(data, 0)
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    parts = der_children(data, outer[1], outer[2])
    if not parts or parts[0][0] != 0x02 or parts[0][2] - parts[0][1] != 1:
        return False
    tags, version = [p[0] for p in parts], data[parts[0][1]]
    if len(tags) >= 9 and all(t == 0x02 for t in tags[:9]):
        modulus, public, private, p, q, *rest = (end - start - (data[start] == 0) for _, start, end in parts[1:9])
        primes = abs(p + q - modulus) <= 1 and min(p, q) >= modulus // 4
        return modulus >= 64 and primes and 1 <= public <= modulus and modulus // 2 <= private <= modulus and all(1 <= n <= max(p, q) for n in rest)
    if version == 1 and len(tags) >= 2 and tags[1] == 0x04 and 16 <= parts[1][2] - parts[1][1] <= 66:
        return True
    if len(tags) >= 3 and tags[1] == 0x30 and tags[2] == 0x04:
        inner = data[parts[2][1] : parts[2][2]]
        element = der_element(inner, 0)
        whole = element is not None and element[2] == len(inner) and element[0] in (0x02, 0x04) and element[2] - element[1] >= 16
        return is_algorithm(data, parts[1]) and (whole or is_der_key(inner))
    return False


def is_algorithm(data: bytes, part: tuple[int, int, int]) -> bool:
    """An algorithm identifier: a SEQUENCE that starts with an object identifier."""
    inside = der_children(data, part[1], part[2]) if part[0] == 0x30 else None
    return bool(inside) and inside[0][0] == 0x06 and inside[0][2] > inside[0][1]


def is_encrypted_der_key(data: bytes | None) -> bool:
    """An encrypted PKCS#8 envelope: an algorithm with its parameters, and an octet string of the ciphertext."""
    outer = der_element(data, 0) if data else None
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    parts = der_children(data, outer[1], outer[2])
    return bool(parts) and len(parts) == 2 and is_algorithm(data, parts[0]) and parts[1][0] == 0x04 and parts[1][2] - parts[1][1] >= 16


def is_encrypted_pem(body: str) -> bool:
    """A traditional encrypted body: its headers, a blank line, and base64 of whole cipher blocks."""
    headers, _, rest = body.replace("\r", "").partition("\n\n")
    cipher = re.search(r"(?m)^DEK-Info: *[A-Z0-9-]+,[0-9A-Fa-f]{16,}$", headers)
    data = from_base64("".join(rest.split())) if cipher and "Proc-Type: 4,ENCRYPTED" in headers else None
    return bool(data) and len(data) >= 32 and len(data) % 8 == 0


def is_length_prefixed_key(data: bytes) -> bool:
    """An OpenSSH key blob: its magic, cipher, key derivation and options, the number of keys, a public key of a known kind for each, and the private part."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)
    for _ in range(3):  # cipher, key derivation, its options
        at = prefixed_end(data, at)
        if at is None:
            return False
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys):
        end = prefixed_end(data, at)
        kind = prefixed_end(data[:end], at + 4) if end is not None else None
        if kind is None or not data[at + 8 : kind].startswith((b"ssh-", b"ecdsa-", b"sk-")):
            return False
        at = end
    return prefixed_end(data, at) == len(data)


def prefixed_end(data: bytes, at: int) -> int | None:
    """End of the string at ``at`` that four bytes of length precede, if it fits."""
    if at + 4 > len(data):
        return None
    end = at + 4 + int.from_bytes(data[at : at + 4], "big")
    return end if end <= len(data) else None


def is_key(data: bytes | None) -> bool:
    return bool(data) and (is_der_key(data) or is_length_prefixed_key(data))


def holds_secret(data: bytes | None, layers: int = LAYERS) -> bool:
    """Whether decoded bytes are a key, or text that holds a PEM or a signed token or is one more encoding of such."""
    if not data:
        return False
    if is_key(data) or is_encrypted_der_key(data):
        return True
    if not layers or not data.isascii() or b"\0" in data:
        return False
    text = data.decode().strip()
    return bool(pem_spans(text) or token_spans(text)) or any(holds_secret(d, layers - 1) for d in decodings(text))


def decodings(text: str) -> Iterator[bytes]:
    """What a text that is one run of hex or base64, on one line or many, stands for."""
    run = "".join(text.split())
    if len(run) >= 40 and len(run) % 2 == 0 and re.fullmatch(r"[0-9A-Fa-f]+", run):
        yield bytes.fromhex(run)
    if len(run) >= 40 and re.fullmatch(r"[A-Za-z0-9+/_-]+={0,2}", run) and (data := from_base64(run)):
        yield data


def json_object(part: str) -> dict | None:
    """The object whose JSON is in base64, or None."""
    try:
        found = json.loads(from_base64(part) or b"")
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    """A token: its header names an algorithm, its payload is an object, and unless the algorithm is none, a signature decodes."""
    head = json_object(header)
    if head is None or not isinstance(head.get("alg"), str) or json_object(payload) is None:
        return False
    return head["alg"].lower() == "none" or len(from_base64(signature) or b"") >= 16


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Base hits ``(start, end, kind)``, leftmost and non-overlapping per kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def pem_spans(text: str) -> list[tuple[int, int, str]]:
    """PEM blocks whose body, white space and escaped line ends aside, decodes to a key or to the envelope of an encrypted one."""
    out = []
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            mark = f"-----END {m[1]}-----"
            end = text.find(mark, m.end())
            if end >= 0:
                body = text[m.end() : end].replace("\\r", "").replace("\\n", "\n")
                data = from_base64("".join(body.split()))
                if is_key(data) or is_encrypted_der_key(data) or is_encrypted_pem(body):
                    out.append((m.start(), end + len(mark), "pem"))
    return out


def token_spans(text: str) -> list[tuple[int, int, str]]:
    """Tokens with a JSON header that names an algorithm, a payload and a signature."""
    if ".ey" not in text and ".ew" not in text:
        return []
    return [(m.start(), m.end(), "token") for m in SIGNED.finditer(text) if is_signed_token(*m.groups())]


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Candidates whose decoded bytes have the structure of a key or a signed token.

    PEM blocks and signed tokens are found as such. Hex and base64 runs, on one line or broken into many, decode to DER or OpenSSH keys, or to text that
    holds a PEM or a token, or is encoded again, up to ``LAYERS`` times. A run that decodes to anything else is no finding.
    """
    out = pem_spans(text) + token_spans(text)
    taken = [(s, e) for s, e, _ in out]
    free = lambda s, e: not any(a <= s and e <= b for a, b in taken)
    for m in WRAPPED.finditer(text):
        if free(m.start(), m.end()) and holds_secret(from_base64("".join(m[0].split()))):
            out.append((m.start(), m.end(), "key"))
            taken.append(m.span())
    for m in BLOB.finditer(text):
        if free(m.start(), m.end()) and holds_secret(from_base64(m[0])):
            out.append((m.start(), m.end(), "key"))
            taken.append(m.span())
    for m in MIXED_HEX.finditer(text):
        if len(m[0]) % 2 == 0 and free(m.start(), m.end()) and holds_secret(bytes.fromhex(m[0])):
            out.append((m.start(), m.end(), "key"))
    return out


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every whole text of ``docs(doc_id, text, ...)``.

    Returns ``doc_id``, counts ``n_assign, n_access, n_hex``, ``base_sha256`` and ``spans``
    (``kind:start:end`` by start, code points, end exclusive), one row per input row. A null text
    counts as empty and has no spans; ids pass unchanged, null too; other columns are ignored.
    Work is row by row: copies, ties and very long texts need no shuffle.
    """

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        for i, text in zip(ids, texts, strict=True):
            base = base_spans(text or "")
            kinds = [k for _, _, k in base]
            yield (
                i,
                kinds.count("assign"),
                kinds.count("access"),
                kinds.count("hex"),
                hashlib.sha256(_joined(base).encode()).hexdigest(),
                _joined(base + confirmed_spans(text or "")),
            )

    return map_batches(
        docs, rows, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )


def redact_secrets(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``doc_id, text`` with every found span masked; overlapping spans are masked once."""

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        for i, text in zip(ids, texts, strict=True):
            if text is None:
                yield i, None
                continue
            out, at = [], 0
            for start, end, _ in sorted(base_spans(text) + confirmed_spans(text)):
                if start >= at:
                    out += [text[at:start], mask]
                at = max(at, end)
            yield i, "".join(out) + text[at:]

    return map_batches(docs, rows, "doc_id bigint, text string")
