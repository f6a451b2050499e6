"""Secrets in texts, with structural confirmation of encoded ones.

Three plain kinds are patterns. Further kinds are reported only after their
content is decoded and its structure holds: base64 or hex that decodes to a
private or public key (DER with nested lengths that add up, or an OpenSSH key
with its length-prefixed fields), armoured key blocks, and signed tokens whose
header is a JSON object that names an algorithm.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.textbytes import text_slices

#: In the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "token", "key", "armour")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]+")
# One class for both alphabets of base64, so that no run is cut at the first character of the other one.
_ENCODED = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_ALPHABETS = (re.compile(r"[A-Za-z0-9+/]{40,}={0,2}"), re.compile(r"[A-Za-z0-9_-]{40,}={0,2}"))
_ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*)KEY-----([A-Za-z0-9+/=\s]+?)-----END \1KEY-----")

# What a text must hold for its kind to be looked for; whole texts are tested, in one pass each.
_HINTS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    "access": "AKIA",
    "hex": "[0-9a-f]{24}",
    "token": r"[A-Za-z0-9_-]{8}\.[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]",
    "key": "[A-Za-z0-9+/_-]{40}",
    "armour": "-----BEGIN [A-Z0-9 ]*KEY-----",
}


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of a run of DER items that fills the bytes, or None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length > 0x80:
            size = length - 0x80
            if size > 4 or at + size > len(data):
                return None
            length, at = int.from_bytes(data[at : at + size], "big"), at + size
            if length < 0x80:
                return None
        elif length == 0x80:
            return None
        if at + length > len(data):
            return None
        items.append((tag, data[at : at + length]))
        at += length
    return items


_INTEGER, _BITS, _OCTETS, _OBJECT, _SEQUENCE = 2, 3, 4, 6, 0x30


def is_der_key(data: bytes) -> bool:
    """Whether the bytes are one sequence laid out as a private or public key."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE:
        return False
    parts = der_items(outer[0][1])
    if not parts:
        return False
    tags = [tag for tag, _ in parts]
    if tags[:2] == [_SEQUENCE, _BITS]:
        named = der_items(parts[0][1])
        return bool(named) and named[0][0] == _OBJECT
    if tags[:3] == [_INTEGER, _SEQUENCE, _OCTETS]:
        named = der_items(parts[1][1])
        return bool(named) and named[0][0] == _OBJECT
    if tags[:2] == [_INTEGER, _OCTETS] and parts[0][1] == b"\x01":
        return len(parts[1][1]) >= 16
    return len(tags) >= 2 and set(tags) == {_INTEGER} and max(len(value) for _, value in parts) >= 32


def is_openssh_key(data: bytes) -> bool:
    """Whether the bytes are an OpenSSH private key: its mark, then cipher, key derivation, options, count, keys."""
    mark = b"openssh-key-v1\x00"
    if not data.startswith(mark):
        return False
    at, fields = len(mark), []
    for _ in range(3):
        length = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + length > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + length])
        at += 4 + length
    return bool(fields[0]) and 1 <= int.from_bytes(data[at : at + 4], "big") <= 16


def is_key(data: bytes) -> bool:
    return is_der_key(data) or is_openssh_key(data)


def _from_base64(text: str) -> bytes | None:
    bare = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(bare + "=" * (-len(bare) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def decodes_to_key(text: str) -> bool:
    """Whether base64, or hex of even length, hides a key."""
    if len(text) % 2 == 0 and re.fullmatch("[0-9a-f]+|[0-9A-F]+", text) and is_key(bytes.fromhex(text)):
        return True
    data = _from_base64(text)
    return data is not None and is_key(data)


def is_signed_token(text: str) -> bool:
    """Whether the first two of three parts decode to JSON objects and the first names its algorithm."""
    parts = []
    for part in text.split(".")[:2]:
        data = _from_base64(part)
        try:
            parts.append(json.loads(data) if data else None)
        except (ValueError, RecursionError):
            return False
    return all(isinstance(p, dict) for p in parts) and isinstance(parts[0].get("alg"), str)


def _key_spans(text: str) -> list[tuple[int, int]]:
    """Encoded keys: a run as a whole, else those of its stretches in one alphabet."""
    found = []
    for run in _ENCODED.finditer(text):
        if decodes_to_key(run[0]):
            found.append(run.span())
            continue
        parts = {m.span() for alphabet in _ALPHABETS for m in alphabet.finditer(text, *run.span())} - {run.span()}
        found += sorted((begin, end) for begin, end in parts if decodes_to_key(text[begin:end]))
    return found


def _spans(kind: str, text: str) -> list[tuple[int, int]]:
    if kind == "assign":
        return [m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if kind == "access":
        return [m.span() for m in _ACCESS.finditer(text)]
    if kind == "hex":
        return [m.span() for m in _HEX.finditer(text)]
    if kind == "token":
        return [m.span() for m in _TOKEN.finditer(text) if is_signed_token(m[0])]
    if kind == "key":
        return _key_spans(text)
    return [m.span() for m in _ARMOUR.finditer(text) if is_key(_from_base64("".join(m[2].split())) or b"")]


def find_spans(texts: pa.Array) -> dict[int, list[tuple[int, int, str]]]:
    """Begin, end (code points) and kind of every secret, by the number of its text; ordered by begin, then kind."""
    found: dict[int, list[tuple[int, int, str]]] = {}
    for kind in KINDS:
        hinted = pc.fill_null(pc.match_substring_regex(texts, _HINTS[kind]), False)
        for i in pc.indices_nonzero(hinted).to_pylist():
            for begin, end in _spans(kind, texts[i].as_py()):
                found.setdefault(i, []).append((begin, end, kind))
    for spans in found.values():
        spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return found


def _chosen(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for begin, end, kind in spans)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = sha256(b"").hexdigest()
    for batch in batches:
        for part in text_slices(batch, "text"):
            n = part.num_rows
            counts = {kind: [0] * n for kind in KINDS}
            digests, listed = [nothing] * n, [""] * n
            for i, spans in find_spans(part.column("text")).items():
                for _, _, kind in spans:
                    counts[kind][i] += 1
                base = [s for s in spans if s[2] in BASE_KINDS]
                digests[i], listed[i] = sha256(_listed(base).encode()).hexdigest(), _listed(spans)
            columns = [part.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(digests), pa.array(listed)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def secret_report(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: how many secrets of each kind, and where.

    A null or empty text holds none. Ids may be null or repeat; each row is
    reported by itself. An empty table gives no rows. Columns besides the two
    named are not read.
    """
    chosen = _chosen(documents, id_column, text_column)
    kind = chosen.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return chosen.mapInArrow(_report, f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    """The text with each stretch of overlapping spans replaced by one mark."""
    out, at = [], 0
    for begin, end, _ in spans:
        if begin >= at:
            out += [text[at:begin], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(documents: DataFrame, text_column: str = "text", mark: str = "[secret]") -> DataFrame:
    """The same rows and columns with every secret of the text replaced; a null text stays null."""
    names = documents.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text_column):
                texts = part.column(text_column)
                found = find_spans(texts)
                if found:
                    new = texts.to_pylist()
                    for i, spans in found.items():
                        new[i] = masked(new[i], spans, mark)
                    texts = pa.array(new, texts.type)
                columns = [texts if name == text_column else part.column(name) for name in names]
                yield pa.RecordBatch.from_arrays(columns, names)

    return documents.mapInArrow(task, documents.schema)
