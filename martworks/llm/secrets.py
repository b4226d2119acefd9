"""Secrets in texts: a keyword automaton, expressions anchored at its hits, and checksums.

One Aho-Corasick pass over a text finds all keywords at once. An expression is tried only where its keyword was found,
so most texts cost that pass alone. Runs of hexadecimal digits have no keyword; they are found as runs of bytes of a
whole block. Tokens that carry a checksum count only if it holds. Offsets are code points, ends are exclusive.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.scratch import only
from martworks.llm.words import Texts

# Kinds in their order, and the expressions that define them. Byte patterns fold the case of ASCII only.
KINDS = ("assign", "access", "hex", "github", "npm")
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
GITHUB = rb"gh[opsur]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"
NPM = rb"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("gho_", "ghp_", "ghs_", "ghu_", "ghr_"),
    "npm": ("npm_",),
}
BASE_62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True

MARK = "[secret]"


def checksum(body: bytes) -> str:
    """Six base-62 digits of the CRC-32 of a token's body."""
    value, out = zlib.crc32(body), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = BASE_62[digit] + out
    return out


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _rules():
    valid = lambda m: checksum(m[1]) == m[2].decode()
    return {
        "assign": (re.compile(ASSIGN, re.IGNORECASE), lambda m: len(m[2]) >= LEAST_VALUE),
        "access": (re.compile(ACCESS), lambda m: len(m[0]) >= LEAST_ACCESS),
        "github": (re.compile(GITHUB), valid),
        "npm": (re.compile(NPM), valid),
    }


def _hex_runs(texts: Texts) -> list[list[tuple[int, int]]]:
    """Maximal runs of enough hexadecimal digits in each text, as byte bounds within it."""
    digit = np.concatenate([_HEX[texts.data], [False]])
    border = np.zeros(len(digit) + 1, bool)
    border[texts.at] = True
    starts, ends = digit.copy(), digit.copy()
    starts[1:] &= ~digit[:-1] | border[1: len(digit)]
    ends[:-1] &= ~digit[1:] | border[1: len(digit)]
    lo, hi = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    long = hi - lo >= LEAST_HEX
    lo, hi = lo[long], hi[long]
    text = np.searchsorted(texts.at, lo, side="right") - 1
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
    for t, a, b in zip(text.tolist(), (lo - texts.at[text]).tolist(), (hi - texts.at[text]).tolist(), strict=True):
        out[t].append((a, b))
    return out


def _keyword_spans(raw: bytes, automaton, rules) -> list[tuple[str, int, int]]:
    hits = sorted((end + 1 - n, kind) for end, (kind, n) in automaton.iter(raw.lower().decode("latin-1")))
    done, out = dict.fromkeys(KINDS, 0), []
    for start, kind in hits:
        if start >= done[kind]:
            pattern, good = rules[kind]
            match = pattern.match(raw, start)
            if match:
                done[kind] = match.end()
                if good(match):
                    out.append((kind, start, match.end()))
    return out


def _in_characters(raw: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    if raw.isascii():
        return spans
    at, seen, place = 0, 0, {}
    for byte in sorted({b for _, *bounds in spans for b in bounds}):
        seen += len(raw[at:byte].decode())
        at, place[byte] = byte, seen
    return [(kind, place[a], place[b]) for kind, a, b in spans]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for each row: secrets as ``kind, start, end``, by start and then by kind as listed.

    Matches of one kind do not overlap; those of different kinds may. A null text has no secrets. Rows are scanned each by
    itself, repeated ones and those without an id too; other columns are ignored. Empty input gives no rows.
    """
    order = {kind: k for k, kind in enumerate(KINDS)}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, rules = _automaton(), _rules()
        for batch in batches:
            texts = Texts.of(batch.column("text"))
            found = []
            for k, runs in enumerate(_hex_runs(texts)):
                raw = texts.data[texts.at[k]: texts.at[k + 1]].tobytes()
                spans = [*_keyword_spans(raw, automaton, rules), *(("hex", a, b) for a, b in runs)]
                spans = sorted(_in_characters(raw, spans), key=lambda s: (s[1], order[s[0]])) if spans else spans
                found.append([{"kind": kind, "start": a, "end": b} for kind, a, b in spans])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    return only(docs, doc_id=id_col, text=text_col).mapInArrow(
        scan, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def digest(found: DataFrame) -> DataFrame:
    """Counts and span lists of :func:`find_secrets` as plain columns."""
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def _masked(text: str, spans: list[dict]) -> str:
    out, at = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if span["start"] >= at:
            out += [text[at: span["start"]], MARK]
        at = max(at, span["end"])
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``, each secret in the text replaced by ``[secret]``.

    Overlapping secrets become one mark. ``length_col``, where the table has it, holds the new length of changed texts.
    Null texts stay null.
    """
    fields = {f.name: f.dataType for f in docs.schema.fields}

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, rules = _automaton(), _rules()
        for batch in batches:
            texts = Texts.of(batch.column(text_col))
            now, lengths = batch.column(text_col).to_pylist(), None
            if length_col in fields:
                lengths = batch.column(length_col).to_pylist()
            for k, runs in enumerate(_hex_runs(texts)):
                raw = texts.data[texts.at[k]: texts.at[k + 1]].tobytes()
                spans = [*_keyword_spans(raw, automaton, rules), *(("hex", a, b) for a, b in runs)]
                if spans:
                    now[k] = _masked(now[k], [{"start": a, "end": b} for _, a, b in _in_characters(raw, spans)])
                    if lengths is not None:
                        lengths[k] = len(now[k])
            new = {text_col: now} | ({length_col: lengths} if lengths is not None else {})
            yield pa.record_batch([pa.array(new[n], batch.schema.field(n).type) if n in new else batch.column(n)
                                   for n in batch.schema.names], batch.schema.names)

    return docs.mapInArrow(mask, docs.schema)
