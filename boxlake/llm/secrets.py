"""Secret scan with structural confirmation.

Patterns give the base spans (kinds assign, access, hex). Beyond them, base64 and hex candidates are decoded and
reported only if what they hold has the structure of a key: nested DER lengths that fill their parents exactly in the
shape of a private key or of a PKCS#12 store, the length-prefixed fields of an OpenSSH private key, a signed token whose header is a JSON object
with an algorithm and whose signature has that algorithm's length, or a JSON web key with its private part. Base64 is read in both alphabets, hex with colons and
prefixes, both over line breaks, written out or escaped as in JSON and source
literals, and from each place in a run of its characters that can begin a key, as after the slashes of a path; a key's own lengths say where it
ends, whatever its size. Base64 of a text with BEGIN lines is decoded and scanned once more, NESTED times at most. Cheap substring tests come before each pattern; they never hide a match. A
token without a signature, or whose algorithm is none, is no signed token. An RSA key's modulus must be as long as its primes together.

A null or empty text has no spans. Spans are in code points, end exclusive; a text of any length is scanned once for each pattern, and of unclosed BEGIN lines
none is read twice. Repeated rows are scanned each for itself. An empty table gives an empty table. `scan` reads only the id and text columns; `redact` lets
extra columns pass, whatever their names.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


#: Kinds in the order in which spans that start together are listed.
KINDS = ["assign", "access", "hex", "pem", "der", "openssh", "jwt", "jwk", "pkcs12"]
MARK = "[redacted]"
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_HEX_ANY = re.compile(r"[0-9A-Fa-f]{64,}")
_BASE64 = re.compile(r"[A-Za-z0-9+/]{40,}={0,2}")
#: Three parts of a token, from each part on; a part is taken whole, so a long run without dots is read once.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{12,}+)\.([A-Za-z0-9_-]{2,}+)\.([A-Za-z0-9_-]++))")
_DOTTED = re.compile(r"\.[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]")
#: Bytes of a signature by algorithm; RSA's are as long as the modulus.
_SIGNED = {"HS256": {32}, "HS384": {48}, "HS512": {64}, "ES256": {64}, "ES256K": {64}, "ES384": {96}, "ES512": {132}, "EdDSA": {64, 114}, "Ed25519": {64}, "Ed448": {114}}
_MIN_SIGNED = {"RS": 64, "PS": 64}
_OBJECT = re.compile(r"\{[^{}]*+\}")
_PEM = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]++)-----")
_ESCAPE = re.compile(r"\\+[nr]")
#: Where base64 of DER or of an OpenSSH key can start (not after a letter or digit), its characters, and what can stand between two lines of it.
_DER_START, _SSH_START = re.compile("M[A-P]"), re.compile("b3BlbnNzaC1rZXktdjE")
_HEX_DER, _HEX_SSH = re.compile("30"), re.compile(r"6[Ff](?:\\x|0x|[\s:,-]){0,4}70")
_HEX_RUN = re.compile(r"(?:(?!0x)[0-9A-Fa-f])+")
_HEX_BETWEEN = re.compile(r"""(?:\\x|0x|[\s:,;"'+\\-])+""")
_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
_BETWEEN = re.compile(r"""(?:["']\s*\+\s*["']|[\s"',.&>#*;|\\])+""")
_URL_SAFE = str.maketrans("-_", "+/")
#: Object identifiers of password-based encryption: PKCS#5, PKCS#12.
_PBE = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
_SSH_MAGIC = b"openssh-key-v1\0"
_PKCS7 = bytes.fromhex("2a864886f70d0107")
#: No private key has more fields in one sequence.
_MAX_FIELDS = 16
#: How often base64 within base64 is decoded.
NESTED = 2


def _encoded_begin() -> dict[str, int]:
    """What base64 of a BEGIN line holds at each of the three alignments, without the characters that depend on what stands around; and how many characters before it its bytes begin."""
    out = {}
    for k in range(3):
        whole = base64.b64encode(b"\0" * k + b"-----BEGIN ").decode().rstrip("=")
        cut = -(-k * 4 // 3)
        last = len(whole) if (k + 11) % 3 == 0 else len(whole) - 1
        out[whole[cut:last]] = cut
    return out


_ENCODED_BEGIN = _encoded_begin()
#: Fields of web keys by type, in base64 but for the curve; the last is the secret.
_WEB_KEYS = {"RSA": ("n", "e", "d"), "EC": ("x", "y", "d"), "OKP": ("x", "d"), "oct": ("k",)}
_TAIL = re.compile(r"[A-Za-z0-9+/_-]{0,8}={1,2}|[A-Za-z0-9+/_-]{1,8}(?![A-Za-z0-9+/_-])")
_ENCODED = re.compile("|".join(re.escape(x) for x in _ENCODED_BEGIN))


class _Run:
    """Digits of an encoding from `at` in a text on, over what may stand between two lines of them, with the place of each in the text."""

    def __init__(self, text: str, at: int, run: re.Pattern, between: re.Pattern):
        pieces, self._firsts, self._places, n = [], [], [], 0
        while m := run.match(text, at):
            pieces.append(m[0])
            self._firsts.append(n)
            self._places.append(m.start())
            n, self.end = n + len(m[0]), m.end()
            gap = between.match(text, m.end())
            at = gap.end() if gap else m.end()
            if not gap:
                break
        self.digits = "".join(pieces)

    def place(self, k: int) -> int:
        """Where digit k stands in the text."""
        i = bisect_right(self._firsts, k) - 1
        return self._places[i] + k - self._firsts[i]

    def index(self, place: int) -> int:
        i = bisect_right(self._places, place) - 1
        return self._firsts[i] + place - self._places[i]


class _Base64:
    """The bytes of digits from `first` on; only what is asked for is decoded."""

    group, size = 4, 3

    def __init__(self, digits: str, first: int):
        self.digits, self.first = digits, first

    def __len__(self) -> int:
        return (len(self.digits) - self.first) * self.size // self.group

    def _decode(self, digits: str) -> bytes:
        return _decoded(digits)

    def __getitem__(self, key: int | slice) -> int | bytes:
        a, b, _ = key.indices(len(self)) if isinstance(key, slice) else (key, key + 1, 1)
        if b <= a:
            return b""
        low, high = a // self.size, -(-b // self.size)
        got = self._decode(self.digits[self.first + low * self.group : self.first + high * self.group])[a - low * self.size : b - low * self.size]
        return got if isinstance(key, slice) else got[0]

    def digits_of(self, n: int) -> int:
        """How many digits hold the first n bytes."""
        return -(-n * self.group // self.size)


class _Hex(_Base64):
    group, size = 2, 1

    def _decode(self, digits: str) -> bytes:
        return bytes.fromhex(digits)


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag and the ends of the value of the DER element at `at`, or None if its length doesn't fit."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n >= 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end:
            return None
        n, at = int.from_bytes(data[at : at + k], "big"), at + k
        if n < 0x80:
            return None
    return (tag, at, at + n) if at + n <= end else None


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    out = []
    while at < end:
        x = _tlv(data, at, end)
        if x is None or len(out) == _MAX_FIELDS:
            return None
        out.append(x)
        at = x[2]
    return out


def _octets(data: bytes, part: tuple[int, int, int]) -> int:
    """Bytes of an integer without its leading zero."""
    return part[2] - part[1] - (data[part[1] : part[1] + 1] == b"\0")


def _is_password_based(data: bytes, part: tuple[int, int, int]) -> bool:
    algorithm = _tlv(data, part[1], part[2])
    return algorithm is not None and algorithm[0] == 0x06 and data[algorithm[1] : min(algorithm[2], algorithm[1] + 16)].startswith(_PBE)


def is_private_key_der(data: bytes) -> bool:
    """PKCS#1, DSA, SEC 1 or PKCS#8, encrypted or not, in DER: nested lengths that fill their parents, with a key's fields."""
    return _der_kind(data, len(data)) == "der"


def _der_kind(data: bytes, size: int) -> str | None:
    """der or pkcs12 if the first `size` bytes are a private key or a store of keys."""
    top = _tlv(data, 0, size)
    if top is None or top[0] != 0x30 or top[2] != size:
        return None
    parts = _children(data, top[1], top[2])
    if parts is None or len(parts) < 2:
        return None
    tags = [t for t, _, _ in parts]
    if tags == [0x30, 0x04]:  # encrypted PKCS#8: a password-based algorithm, then the octets
        return "der" if _children(data, *parts[0][1:]) and _is_password_based(data, parts[0]) and parts[1][2] > parts[1][1] else None
    version = data[parts[0][1] : min(parts[0][2], parts[0][1] + 2)] if tags[0] == 0x02 else None
    if version == b"\3" and tags in ([0x02, 0x30], [0x02, 0x30, 0x30]):  # PKCS#12: version, content, check sum
        content = _children(data, *parts[1][1:])
        fits = bool(content) and [t for t, _, _ in content] == [0x06, 0xA0] and data[content[0][1] : min(content[0][2], content[0][1] + 9)].startswith(_PKCS7)
        return "pkcs12" if fits else None
    return "der" if version in (b"\0", b"\1") and _is_plain_key(data, parts, tags, version[0]) else None


def _is_plain_key(data: bytes, parts: list[tuple[int, int, int]], tags: list[int], version: int) -> bool:
    if tags[:9] == [0x02] * 9:  # PKCS#1: modulus, exponents, primes; a tenth field has more primes
        n, p, q = (_octets(data, parts[k]) for k in (1, 4, 5))
        return n >= 64 and (p + q - 1 <= n <= p + q if len(tags) == 9 else tags[9:] == [0x30] and p + q <= n)
    if tags == [0x02] * 6:  # DSA: two primes, generator, public and private number
        p, q = (_octets(data, parts[k]) for k in (1, 2))
        return p >= 64 and 16 <= q <= 64
    length = parts[1][2] - parts[1][1]
    if tags[1] == 0x04:  # SEC 1, with or without parameters and point
        return 16 <= length <= 72 and (0xA0 in tags[2:] or version == 1 and tags[2:] in ([], [0xA1]))
    if len(tags) > 2 and tags[1] == 0x30 and tags[2] == 0x04:  # PKCS#8: algorithm, then the key in an octet string
        algorithm = _children(data, *parts[1][1:])
        inner = _tlv(data, *parts[2][1:])
        return bool(algorithm) and algorithm[0][0] == 0x06 and inner is not None and inner[2] == parts[2][2]
    return False


def is_openssh_key(data: bytes) -> bool:
    return _openssh_end(data) > 0


def _openssh_end(data: bytes) -> int:
    """The end of an OpenSSH key, 0 if data doesn't start with one.

    Magic, then cipher, derivation, its options, the number of keys, public keys and the private part.
    """
    at = len(_SSH_MAGIC)
    if data[:at] != _SSH_MAGIC:
        return 0

    def field() -> int | None:
        nonlocal at
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or at + 4 + n > len(data):
            return None
        at += 4 + n
        return n

    if not field() or not field() or field() is None or at + 4 > len(data):
        return 0
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    return at if keys and all(field() for _ in range(keys)) and field() else 0


def _decoded(text: str) -> bytes:
    text = text.rstrip("=").translate(_URL_SAFE)
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4)) if len(text) % 4 != 1 else b""
    except (binascii.Error, ValueError):
        return b""


def _claimed(head: Callable[[int], bytes]) -> int:
    """The size of a DER key by its own length; 0 if its head (so many bytes) begins none that _der_kind() takes."""
    data = head(9)
    if len(data) < 9 or data[0] != 0x30 or data[1] == 0x80:
        return 0
    k = data[1] & 0x7F if data[1] > 0x80 else 0
    if k > 4:
        return 0
    size = 2 + k + (int.from_bytes(data[2 : 2 + k], "big") if k else data[1])
    if data[2 + k : 5 + k] in (b"\x02\x01\0", b"\x02\x01\1", b"\x02\x01\3"):
        return size
    if data[2 + k] != 0x30:
        return 0
    first = head(36)[2 + k :]  # a password-based algorithm's identifier
    k = first[1] & 0x7F if first[1] >= 0x80 else 0
    return size if first[2 + k : 3 + k] == b"\x06" and first[4 + k :].startswith(_PBE) else 0


def _key_kind(data: bytes) -> str | None:
    if data[:1] == b"\x30" and (kind := _der_kind(data, len(data))):
        return kind
    return "openssh" if is_openssh_key(data) else None


def _read(text: str, at: int, size: int, run: re.Pattern, between: re.Pattern) -> str:
    """Up to `size` digits from `at` on, over line breaks."""
    out, n = [], 0
    while n < size and (m := run.match(text, at, at + size - n)):
        out.append(m[0])
        n += len(m[0])
        gap = between.match(text, m.end())
        at = gap.end() if gap else m.end()
    return "".join(out)


def _keys_at(text: str, starts: list[int], run: re.Pattern, between: re.Pattern, view: type[_Base64]) -> Iterator[tuple[str, int, int]]:
    """Keys whose first digit is one of starts (ascending): kind, beginning and end.

    Only what begins like a key, up to its version or its algorithm's identifier, is looked at further; a run of digits is put together once for all that begin in it, and
    of a candidate only the lengths of its fields are decoded. So a key may have any size, and false beginnings cost little each.
    """
    held, stop = None, 0
    for at in starts:
        if at < stop:
            continue
        few = lambda n, at=at: view(_read(text, at, view.digits_of(view, n), run, between), 0)[:n]
        size = _claimed(few) if few(1) == b"0" else -1
        if size == 0 or size < 0 and few(len(_SSH_MAGIC)) != _SSH_MAGIC:
            continue
        if held is None or at >= held.end:
            held = _Run(text, at, run, between)
        data = view(held.digits, held.index(at))
        kind = "openssh"
        if size < 0:
            size = _openssh_end(data)
        elif size <= len(data):
            kind = _der_kind(data, size)
        else:
            continue
        if size and kind:
            n = data.digits_of(size)
            stop = held.place(data.first + n - 1) + 1
            for _ in range(-n % data.group):
                stop += text[stop : stop + 1] == "="
            yield kind, at, stop


def wrapped_spans(text: str) -> list[tuple[str, int, int]]:
    """Keys in base64 or hex over any number of lines, with or without BEGIN and END, as far as their own lengths reach."""

    def free(m: re.Match) -> bool:
        before = text[m.start() - 1 : m.start()]
        return not (before.isascii() and before.isalnum())

    starts = sorted(m.start() for p in (_DER_START, _SSH_START) for m in p.finditer(text) if free(m))
    hexes = sorted(m.start() for p in (_HEX_DER, _HEX_SSH) for m in p.finditer(text))
    return [*_keys_at(text, starts, _RUN, _BETWEEN, _Base64), *_keys_at(text, hexes, _HEX_RUN, _HEX_BETWEEN, _Hex)]


def encoded_spans(text: str, nested: int) -> list[tuple[str, int, int]]:
    """Secrets in base64 of a text with BEGIN lines, from the first digit that holds some of one to the last, with the rest of the last group.

    A run of digits is decoded from each of its four places at most once.
    """
    out, held, done = [], None, set()
    for m in _ENCODED.finditer(text):
        before = _ENCODED_BEGIN[m[0]]
        if held is None or m.start() >= held.end:
            first = _RUN.fullmatch(text, m.start() - before, m.start()) if 0 < before <= m.start() else None
            held, done = _Run(text, first.start() if first else m.start(), _RUN, _BETWEEN), set()
        phase = (held.index(m.start()) - before) % 4
        if phase in done:
            continue
        done.add(phase)
        body = held.digits[phase : len(held.digits) - ((len(held.digits) - phase) % 4 == 1)]
        inner = _decoded(body).decode("latin-1")
        last = -1
        for kind, a, b in sorted(confirmed_spans(inner, nested - 1), key=lambda s: (s[1], -s[2])):
            if b <= last:
                continue
            last = b
            end = held.place(phase - (-b * 4 // 3) - 1) + 1
            tail = _TAIL.match(text, end)
            out.append((kind, held.place(phase + a * 4 // 3), tail.end() if tail else end))
    return out


def _is_jwt(head: str, body: str, signature: str) -> bool:
    parts = []
    for part in (head, body):
        try:
            parts.append(json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))))
        except (ValueError, RecursionError):
            return False
    if not all(isinstance(x, dict) for x in parts) or not isinstance(alg := parts[0].get("alg"), str) or alg.lower() == "none":
        return False
    size = len(_decoded(signature))
    return size in _SIGNED[alg] if alg in _SIGNED else size >= _MIN_SIGNED.get(alg[:2], 16)


def token_spans(text: str) -> list[tuple[str, int, int]]:
    """Signed tokens. A header begins with its part, or at the part's first brace and quote, as after a prefix."""
    out = []
    for m in _JWT.finditer(text):
        inside = m[1].find("eyJ")
        for k in {0, inside} - {-1}:
            if _is_jwt(m[1][k:], m[2], m[3]):
                out.append(("jwt", m.start() + k, m.end(3)))
    return out


def web_key_spans(text: str) -> list[tuple[str, int, int]]:
    """JSON objects without others inside that are a key with its private part."""
    out = []
    for m in _OBJECT.finditer(text):
        if "kty" not in m[0]:
            continue
        try:
            x = json.loads(m[0].replace('\\"', '"') if '\\"kty\\"' in m[0] else m[0], strict=False)
        except (ValueError, RecursionError):
            continue
        needs = _WEB_KEYS.get(x.get("kty")) if isinstance(x.get("kty"), str) else None
        if needs and all(isinstance(x.get(k), str) and _decoded(x[k]) for k in needs) and len(_decoded(x[needs[-1]])) >= 16:
            out.append(("jwk", *m.span()))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def confirmed_spans(text: str, nested: int = NESTED) -> list[tuple[str, int, int]]:
    out = _confirmed(text, nested)
    if "\\" in text:  # escaped line breaks become white space of the same length, so spans stay
        plain = _ESCAPE.sub(lambda m: " " * (len(m[0]) - 1) + "\n", text)
        if plain != text:
            out += _confirmed(plain, nested)
    return sorted(set(out), key=lambda s: (s[1], s[2], s[0]))


def _confirmed(text: str, nested: int) -> list[tuple[str, int, int]]:
    out = []
    if _DOTTED.search(text):
        out += token_spans(text)
    if "kty" in text:
        out += web_key_spans(text)
    if nested:
        out += encoded_spans(text, nested)
    pem = []
    if "-----BEGIN " in text:
        begun = None  # a body holds no other BEGIN or END line, so each is read once
        for m in _PEM.finditer(text):
            if m[1] == "BEGIN":
                begun = m
            elif begun is not None:
                if begun[2] == m[2]:
                    inside = text[begun.end() : m.start()]
                    body = re.sub(r"""(?m)^[\s"'>#*]*[A-Za-z-]+:.*$""", "", inside)
                    data = _decoded("".join(_BETWEEN.sub("", body).split()))
                    sealed = m[2].endswith("PRIVATE KEY") and "4,ENCRYPTED" in inside and len(data) >= 16
                    if sealed or _key_kind(data):
                        pem.append(("pem", begun.start(), m.end()))
                begun = None
    out += pem + wrapped_spans(text)
    for m in _BASE64.finditer(text):
        if kind := _key_kind(_decoded(m[0])):
            out.append((kind, *m.span()))
    for m in _HEX_ANY.finditer(text):
        if len(m[0]) % 2 == 0 and (kind := _key_kind(bytes.fromhex(m[0]))):
            out.append((kind, *m.span()))
    return out


def _listed(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, digests, all_ = {k: [] for k in KINDS[:3]}, [], []
            for t in b.column(1).to_pylist():
                base = base_spans(t or "")
                for k, x in counts.items():
                    x.append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                all_.append(_listed(base + confirmed_spans(t or "")))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in counts.values()), pa.array(digests), pa.array(all_)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text")
    return rows.mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def redacted(text: str) -> str:
    """The text with each secret (spans that overlap are one) replaced by MARK."""
    spans = sorted((a, b) for _, a, b in base_spans(text) + confirmed_spans(text))
    out, last = [], 0
    for a, b in spans:
        if a >= last:
            out += [text[last:a], MARK]
        last = max(last, b)
    return "".join([*out, text[last:]]) if spans else text


def redact(docs: DataFrame, length: str | None = "n_chars") -> DataFrame:
    """docs with redacted texts; the column `length`, where there is one, becomes the new number of characters."""
    text = docs.columns.index("text")
    n = docs.columns.index(length) if length in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old = b.column(text).to_pylist()
            new = [t if t is None else redacted(t) for t in old]
            columns = list(b.columns)
            columns[text] = pa.array(new, b.column(text).type)
            if n is not None:
                sizes = [len(t) if t is not None and t != o else k for t, o, k in zip(new, old, b.column(n).to_pylist(), strict=True)]
                columns[n] = pa.array(sizes, b.column(n).type)
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return docs.mapInArrow(run, docs.schema)
