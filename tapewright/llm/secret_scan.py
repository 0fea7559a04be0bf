"""Secrets by patterns and by dictionary-primed zstandard novelty (operator 10)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tapewright.llm import textbytes as tb

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # a run of the class is matched whole, so this is a run of 32 or more
_NAMED = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Candidates of the method: long mixed strings with a sensitive word shortly before them.
SENSITIVE = ("key", "secret", "token", "passw", "pwd", "auth", "credential", "bearer", "private", "signature", "session")
_SENSITIVE = re.compile("|".join(SENSITIVE), re.IGNORECASE | re.ASCII)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
CONTEXT_BEFORE = 48
# A lower-case letter between others: letters of a key without digits, hardly ever of words in any capitals.
_SCATTERED = re.compile(r"(?<![a-z])[a-z](?![a-z])")
# Between two lines of one string: the break, with blanks, quotes and what continues a line around it.
_NEXT_LINE = re.compile(r"""["'\x20\t+,\\]*(?:\r\n|\n|\r|\\r\\n|\\n)["'\x20\t+]*""")
# The last line of an armoured key, shorter than a candidate.
_LAST_LINE = re.compile(_NEXT_LINE.pattern + r"([A-Za-z0-9+/=]{1,15})(?=" + _NEXT_LINE.pattern + r"-----END)")
SURROUNDING = 1024
# Bytes that a candidate adds to its surroundings when compressed, by its length.
NOVELTY = 0.8
# Identifiers that code uses everywhere; they prime the compressor together with the surroundings.
IDENTIFIERS = ("access_token api_key apikey application authentication authorization bearer client_id client_secret "
               "config configuration connection_string credentials database default description environment example "
               "identifier password placeholder private_key public_key refresh_token request response secret_key "
               "session_id signature test_token username value xxxxxxxxxxxxxxxx 0123456789abcdef "
               "00000000000000000000000000000000 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ").encode()


def novelty(candidate: str, surrounding: str) -> float:
    """Marginal compressed bytes a byte, with identifiers and the surrounding text as dictionary."""
    primer = zstandard.ZstdCompressionDict(IDENTIFIERS + surrounding.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    press = zstandard.ZstdCompressor(level=9, dict_data=primer, write_checksum=False, write_content_size=False)
    data = candidate.encode()
    return (len(press.compress(data)) - len(press.compress(b""))) / len(data)


def _blanked(text: str, start: int, end: int) -> str:
    """The surroundings of a candidate, other copies of it (or of a side of its equals sign) blanked out."""
    candidate = text[start:end]
    parts = {candidate, *(p for p in candidate.split("=") if len(p) >= 16)}
    reach = SURROUNDING + end - start  # copies that the border of the surroundings cuts are seen whole
    before, after = text[max(0, start - reach):start], text[end:end + reach]
    for part in sorted(parts, key=lambda p: (-len(p), p)):
        before, after = (t.replace(part, " " * len(part)) for t in (before, after))
    return before[-SURROUNDING:] + after[:SURROUNDING]


def _mixed(candidate: str) -> bool:
    if not any(c.isalpha() for c in candidate):
        return False
    return any(c.isdigit() for c in candidate) or bool(
        any(c.isupper() for c in candidate) and _SCATTERED.search(candidate))


def spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) in code points, ordered."""
    found = []
    lower = text.lower()
    if any(name in lower for name in _NAMED):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if any(word in lower for word in SENSITIVE):
        taken = sorted((start, end) for start, _, end in found)
        last = None  # end of the latest candidate in context
        for m in _CANDIDATE.finditer(text):
            start, end = m.span()
            if not (_SENSITIVE.search(text, max(0, start - CONTEXT_BEFORE), start)
                    or last is not None and _NEXT_LINE.fullmatch(text, last, start)):
                continue
            last = end
            if not _mixed(m[0]) or any(a < end and start < b for a, b in taken):
                continue
            if novelty(m[0], _blanked(text, start, end)) >= NOVELTY:
                found.append((start, 3, end))
                tail = _LAST_LINE.match(text, end)
                if tail:
                    found.append((tail.start(1), 3, tail.end(1)))
    return sorted(found)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end) of every document, by start and then kind.

    Kinds are ``assign``, ``access`` and ``hex`` by pattern, and ``novel``: a mixed string behind a
    sensitive word, or on the lines that follow one, that its surroundings (other copies of it left
    out) and common identifiers do not help to compress. Mixed are letters with digits, and capitals
    with lower-case letters that stand alone. Novel spans overlap no other. Null and empty texts have none. Repeated rows each give a row, an
    empty table none. Extra columns are not read. Nothing is shuffled.
    """
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for first, past, _, _ in tb.chunks(batch, "text"):
                part = batch.slice(first, past - first)
                found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(t)] if t else []
                         for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(kind))], ["doc_id", "spans"])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return narrow.mapInArrow(batches, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")
