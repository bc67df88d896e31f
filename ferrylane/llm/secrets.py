"""Secret scan: keyword automaton, anchored expressions at its hits, then checks embedded in the secrets.

One Aho-Corasick pass over a text finds where a secret could start; only there is an expression tried,
anchored. Kinds that carry a check of their own (GitHub and npm tokens: CRC-32 in base 62; JSON web
tokens: a header that decodes; private keys: the length that their DER header gives, the lengths of all fields and the
two equal check numbers of an OpenSSH key, whole cipher blocks under the header lines of an encrypted one) count only if it holds.
Hex runs start with no keyword; one linear expression finds them.

Nulls and empty texts have no spans. Texts are scanned whole, in time that grows with their length whatever they hold: an
expression that fails is not tried again within the characters that made it fail. Repeated rows are scanned each.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrylane.llm.common import batch_map, free_name, prepare, text_of

BASE_KINDS = ("assign", "access", "hex")
CHECKED_KINDS = ("github", "npm", "jwt", "private_key")
KINDS = BASE_KINDS + CHECKED_KINDS
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 8, 16, 32

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(rf"[0-9a-f]{{{MIN_HEX},}}")
GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
NPM = re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++")
PRIVATE_KEY = re.compile(
    r"-----BEGIN ([A-Z]+ )?PRIVATE KEY-----\s*((?:[A-Za-z][A-Za-z-]*+:[^\n]*+\n)*+)([A-Za-z0-9+/=\s]++)-----END ([A-Z]+ )?PRIVATE KEY-----", re.ASCII)
#: A try that failed fails as well if it starts later within these characters.
_RUNS = {"jwt": re.compile(r"[A-Za-z0-9_-]+")}
_DEK = re.compile(r"DEK-Info:\s*[A-Za-z0-9-]+,\s*((?:[0-9A-Fa-f]{2})+)\s*$", re.MULTILINE)

_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


class Span(NamedTuple):
    start: int
    kind: str
    end: int


def base62(value: int, width: int) -> str:
    out = ""
    while value:
        value, digit = divmod(value, 62)
        out = _DIGITS[digit] + out
    return out.rjust(width, "0")


def has_crc62(token: str) -> bool:
    """Whether the last six characters are the CRC-32, in base 62, of those between the prefix and them."""
    body = token.partition("_")[2]
    return base62(zlib.crc32(body[:-6].encode()), 6) == body[-6:]


def has_jwt_header(token: str) -> bool:
    header = token.partition(".")[0]
    try:
        decoded = json.loads(base64.urlsafe_b64decode(header + "=" * (-len(header) % 4)))
    except (ValueError, RecursionError):
        return False
    return isinstance(decoded, dict) and "alg" in decoded


def is_private_key(block: re.Match) -> bool:
    """Whether the lengths embedded in the decoded key hold."""
    try:
        key = base64.b64decode("".join(block[3].split()), validate=True)
    except (binascii.Error, ValueError):
        return False
    if key.startswith(_OPENSSH):
        return has_openssh_fields(key)
    if "ENCRYPTED" in block[2]:
        # What the header lines encrypt has no length of its own but whole blocks, of the size of the start vector.
        vector = _DEK.search(block[2])
        return bool(vector and key) and len(key) % (len(vector[1]) // 2) == 0
    return has_der_length(key)


_OPENSSH = b"openssh-key-v1\0"


def has_openssh_fields(key: bytes) -> bool:
    """Whether the key is just its fields: cipher, function, options, a count, as many public keys, and the private part.
    That starts with one number twice, unless it is encrypted."""
    fields, at = [], len(_OPENSSH)

    def field() -> bytes | None:
        nonlocal at
        size = int.from_bytes(key[at:at + 4], "big")
        value, at = key[at + 4:at + 4 + size], at + 4 + size
        return value if at <= len(key) else None

    for _ in range(3):
        fields.append(field())
    count, at = int.from_bytes(key[at:at + 4], "big"), at + 4
    while count and fields[-1] is not None:
        fields.append(field())
        count -= 1
    private = field() if fields[-1] is not None else None
    if private is None or at != len(key) or len(fields) < 4:
        return False
    return fields[0] != b"none" or len(private) >= 8 and private[:4] == private[4:8]


def has_der_length(der: bytes) -> bool:
    """Whether the key is one DER sequence of exactly the length that its header states."""
    if len(der) < 2 or der[0] != 0x30:
        return False
    if der[1] < 0x80:
        return len(der) == 2 + der[1]
    width = der[1] & 0x7F
    return len(der) == 2 + width + int.from_bytes(der[2:2 + width], "big")


#: kind, expression, what a match must pass
_ANCHORED = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= MIN_ASSIGNED),
    "access": (ACCESS, lambda m: len(m[0]) >= MIN_ACCESS),
    "github": (GITHUB, lambda m: has_crc62(m[0])),
    "npm": (NPM, lambda m: has_crc62(m[0])),
    "jwt": (JWT, lambda m: has_jwt_header(m[0])),
    "private_key": (PRIVATE_KEY, is_private_key),
}
_KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "jwt": ("eyj",),
    "private_key": ("-----begin ",),
}


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, words in _KEYWORDS.items():
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def spans_of(text: str) -> list[Span]:
    """All spans, by start and then kind; per kind leftmost and not overlapping."""
    found = [Span(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    # The one letter that lower() makes longer would shift all places behind it.
    folded = text.replace("İ", "i").lower()
    free = dict.fromkeys(_ANCHORED, 0)
    for last, (kind, length) in _automaton().iter(folded):
        start = last - length + 1
        if start < free[kind]:
            continue
        expression, passes = _ANCHORED[kind]
        match = expression.match(text, start)
        if match and passes(match):
            found.append(Span(start, kind, match.end()))
            free[kind] = match.end()
        elif kind in _RUNS:
            free[kind] = _RUNS[kind].match(text, start).end()
        elif match:
            free[kind] = match.end()
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


SPAN_TYPE = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
]))


def find_secrets(docs: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """``docs`` with an array of (kind, start, end) per row; places are code points, the end exclusive.

    Other columns pass through, whatever their names; the result column takes a free name near ``into``.
    """
    prepare(docs.sparkSession)
    into = free_name(docs, into)
    schema = T.StructType([*docs.schema.fields, T.StructField(into, SPAN_TYPE)])
    at = docs.columns.index(text)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[{"kind": s.kind, "start": s.start, "end": s.end} for s in spans_of(t or "")] for t in batch.column(at).to_pylist()]
        columns = [*batch.columns, pa.array(spans, span)]
        return pa.RecordBatch.from_arrays(columns, schema=pa.schema([*batch.schema, pa.field(into, span)]))

    return docs.mapInArrow(batch_map(scan), schema)


def joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s["end"])), ",")


def secret_digests(docs: DataFrame) -> DataFrame:
    """Per document the counts of the base kinds, a digest of the base spans, and all spans as text."""
    found = find_secrets(docs.select("doc_id", text_of().alias("text"))).drop("text")
    of = lambda kinds: F.filter("secrets", lambda s: s.kind.isin(*kinds))
    return found.select(
        "doc_id",
        *[F.size(of([kind])).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined(of(BASE_KINDS)), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
