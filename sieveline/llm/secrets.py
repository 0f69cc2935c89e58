"""Secrets by fixed patterns, and random strings by their cost in tokens."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from sieveline.llm.common import pieces
from sieveline.llm.tokens import encoding as token_encoding

# The base patterns, in the order of kinds.
PATTERNS = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
}
KINDS = (*PATTERNS, "random")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Runs that the token test looks at; shorter ones cost too few tokens to tell.
LEAST = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Parts of a run between separators.
PART = re.compile(r"[A-Za-z0-9]+")
#: Hex lengths of common digests (MD5, SHA-1, SHA-2), and UUIDs: known, not secret.
DIGEST = re.compile(r"(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{56}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{96}|[0-9A-Fa-f]{128})")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: Parts of an identifier or path: words of one case, or a number.
IDENTIFIER_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

_HEX = bytes(104 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
_RUN = bytes(99 if re.match(r"[A-Za-z0-9+/_=-]", chr(i)) and i < 128 else 32 for i in range(256))

SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string, "
    "starts array<int>, ends array<int>"
)


def is_identifier(run: str) -> bool:
    """Names made of words, numbers and separators, with at least four letters a word on average."""
    parts = [p for x in re.split(r"[_/+=-]+", run) for p in IDENTIFIER_PART.findall(x)]
    words = [p for p in parts if not p.isdigit()]
    return not words or sum(map(len, words)) >= 4 * len(words) and len(parts) - len(words) <= len(words)


def random_parts(run: str, encoding: tiktoken.Encoding, max_ratio: float) -> list[tuple[int, int]]:
    """Stretches of a run that are random: the whole, or what lies between words and numbers."""

    def costly(part: str) -> bool:
        return len(part) <= max_ratio * len(encoding.encode_ordinary(part))

    def plain(part: str) -> bool:
        return part.isdigit() and len(part) < LEAST or is_identifier(part) and not costly(part)

    if not is_identifier(run) and costly(run):
        return [(0, len(run))]
    stretches: list[list[int]] = []
    joined = False
    for m in PART.finditer(run):
        if plain(m[0]):
            joined = False
        elif joined:
            stretches[-1][1] = m.end()
        else:
            stretches.append([m.start(), m.end()])
            joined = True
    return [
        (s, e)
        for s, e in stretches
        if e - s >= LEAST and not DIGEST.fullmatch(run[s:e]) and not UUID.fullmatch(run[s:e]) and costly(run[s:e])
    ]


def find_spans(text: str, encoding: tiktoken.Encoding, max_ratio: float) -> list[tuple[int, int, str]]:
    """(start, end, kind), sorted by start, then kind as listed."""
    raw, found = text.encode(), []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in PATTERNS["assign"].finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in PATTERNS["access"].finditer(text) if len(m[0]) >= 20]
    if b"h" * 24 in raw.translate(_HEX):
        found += [(m.start(), m.end(), "hex") for m in PATTERNS["hex"].finditer(text)]
    if b"c" * 20 in raw.translate(_RUN):
        base = sorted(found)
        for m in CANDIDATE.finditer(text):
            if DIGEST.fullmatch(m[0]) or UUID.fullmatch(m[0]):
                continue
            at = m.start()
            for s, e, _ in [*base, (m.end(), m.end(), "")]:
                if e >= at and s <= m.end():
                    if s - at >= LEAST:
                        found += [(at + i, at + k, "random") for i, k in random_parts(text[at:s], encoding, max_ratio)]
                    at = max(at, e)
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def scan_secrets(docs: DataFrame, ranks_path: str, pattern: str, max_ratio: float = 2.0) -> DataFrame:
    """Find secrets in whole texts.

    Kinds ``assign``, ``access`` and ``hex`` follow fixed patterns. The token test
    adds kind ``random``: runs of 20 or more base64 characters outside the former, or
    stretches of a run's parts between words and numbers, that have at most ``max_ratio`` characters per token of the given
    byte-pair vocabulary (``ranks_path`` must be a file on every worker, and
    ``pattern`` its splitting pattern). Digests of known lengths and UUIDs are left
    out; so are parts that look like words and have more characters a token.

    ``docs`` needs doc_id and text; other columns are ignored. A null text counts as
    empty; texts of any length are searched whole; null and repeated doc_ids are rows as any other; empty tables give no
    rows. Each row depends on its own text only: no shuffle.

    Returns doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans
    (``kind:start:end`` in code points, end exclusive), starts, ends.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        encoding = token_encoding(ranks_path, pattern)
        for batch in pieces(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                spans = find_spans(text or "", encoding, max_ratio)
                names = [f"{kind}:{s}:{e}" for s, e, kind in spans]
                base = ",".join(n for n, x in zip(names, spans, strict=True) if x[2] in PATTERNS)
                counts = [sum(x[2] == kind for x in spans) for kind in KINDS]
                rows.append((*counts, sha256(base.encode()).hexdigest(), ",".join(names), [x[0] for x in spans], [x[1] for x in spans]))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.list_(pa.int32())] * 2
            names = ["n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans", "starts", "ends"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", *names],
            )

    return docs.select("doc_id", "text").mapInArrow(scan, SCHEMA)


def redact(text: str, starts: list[int], ends: list[int], mark: str) -> str:
    """The text with every stretch covered by spans replaced by one mark."""
    out, at = [], 0
    for s, e in zip(starts, ends, strict=True):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, ranks_path: str, pattern: str, max_ratio: float = 2.0, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``.

    Takes any columns and returns them in order; ``n_chars``, if there, follows the
    new text. Null texts stay null.
    """
    schema = docs.schema

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = token_encoding(ranks_path, pattern)
        for batch in pieces(batches):
            texts = batch.column("text").to_pylist()
            for i, text in enumerate(texts):
                spans = find_spans(text or "", encoding, max_ratio)
                if spans:
                    texts[i] = redact(text, [x[0] for x in spans], [x[1] for x in spans], mark)
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            if (k := batch.schema.get_field_index("n_chars")) >= 0:
                lengths = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(k).type)
                batch = batch.set_column(k, batch.schema.field(k), lengths)
            yield batch

    return docs.mapInArrow(mask, schema)
