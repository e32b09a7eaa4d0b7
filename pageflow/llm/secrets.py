"""Secret scan over whole texts (operator 6).

Three fixed patterns find assigned credentials, access keys and long hex runs.
On top, every long run of key characters is a candidate: a window slides over
it, its character counts change by one in and one out, and from them the
Shannon entropy of the window is kept up to date. The run's character class
(hex, letters and digits, or base64) sets the threshold; the span from the
first to the last window that reaches it is reported as ``entropy``, unless the
allow list accepts the run (UUIDs, dates, words, names with numbers). Letters count as words by
the length of the parts between changes of case and, all in capitals, by their vowels.
Runs shorter than the window have a shorter one with thresholds of its own. Placeholder words are cut out of a run, and each piece left is a run
of its own, so they hide no key beside them.
Spans are in code points, end exclusive.

Edge cases: null and empty texts have no spans; a run shorter than the short window
is never a candidate; spans of different kinds may overlap, and base spans
always stay; ties at one start are ordered by kind as listed in ``KINDS``.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from pageflow.llm.scan import free_name, with_columns

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_CHARS)  # a run is taken whole, so short runs need not be tried

WINDOW = 20
#: Bits per character that a window of random characters passes and words or numbers do not, by class of the run.
THRESHOLDS = {"hex": 3.0, "alnum": 3.5, "base64": 3.7}
#: Shorter runs are one window of this length or a little more; they have to mix letters and digits or cases.
SHORT_WINDOW = 16
SHORT_THRESHOLDS = {"hex": 2.8, "alnum": 3.3, "base64": 3.5}
_MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])|(?=.*[a-z])(?=.*[A-Z])")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % SHORT_WINDOW)
_CLASSES = (("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+")), ("alnum", re.compile(r"[A-Za-z0-9]+")))
#: A group of small letters that can be a word: it has a vowel and no five consonants in a row.
_WORD = r"(?=[a-z]*[aeiouy])(?![a-z]*[bcdfghjklmnpqrstvwxz]{5})"
#: Runs that look random by their counts but are no secrets.
ALLOWED = (
    re.compile(r"[0-9+/_=-]+"),                                                 # numbers, dates, phone numbers
    re.compile(r"(?i:[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})"),            # UUIDs
    re.compile(rf"(?:{_WORD}[a-z]{{6,}}[0-9]{{1,4}}){{1,4}}"),                       # names with numbers
    re.compile(rf"(?:{_WORD}[a-z]{{4,}}[0-9]{{1,4}}[-_/=+])+(?:{_WORD}[a-z]{{4,}}[0-9]{{0,4}})?"),
    re.compile(r"(?:[A-Za-z]+[-_/][0-9]{1,4}[-_/]?)+"),
)
_LETTERS = re.compile(r"[A-Za-z]+(?:[-_/=+][A-Za-z]+)*[-_/=+]*")
_GROUP, _PART = re.compile(r"[A-Za-z]{8,}"), re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_VOWEL, _CLUSTER = re.compile(r"[AEIOUY]"), re.compile(r"[BCDFGHJKLMNPQRSTVWXZ]{4}")
_PLACEHOLDER = re.compile(r"(?i:example|placeholder|changeme|your[-_]?key|x{4,}|0123456789|abcdefgh)")


def wordlike(run: str) -> bool:
    """Whether a run is words, slugs or paths: letters only, parts between changes of case as long as words are, capitals that can be said."""
    if not _LETTERS.fullmatch(run):
        return False
    for group in _GROUP.findall(run):
        parts, vowels = len(_PART.findall(group)), len(_VOWEL.findall(group.upper()))
        if len(group) < 4 * parts and (len(group) < 3 * parts or 3 * vowels < len(group)):
            return False
        if group.isupper() and (100 * vowels < 36 * len(group) or _CLUSTER.search(group)):
            return False
    return True


def _allowed(run: str) -> bool:
    return wordlike(run) or any(p.fullmatch(run) for p in ALLOWED)


def entropy_span(run: str, window: int = WINDOW) -> tuple[int, int] | None:
    """(start, end) in ``run`` covered by windows at or over the threshold of its class; None if there is none."""
    kind = next((k for k, p in _CLASSES if p.fullmatch(run)), "base64")
    # entropy = log2(w) - sum(c log2 c) / w, so the threshold bounds the sum from above
    least = (THRESHOLDS if window >= WINDOW else SHORT_THRESHOLDS)[kind]
    most = window * (math.log2(window) - least) + 1e-9
    cost = [c * math.log2(c) if c else 0.0 for c in range(window + 1)]
    counts: dict[str, int] = {}
    total, first, last = 0.0, -1, -1
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += cost[n + 1] - cost[n]
        if i >= window:
            out = run[i - window]
            n = counts[out]
            counts[out] = n - 1
            total += cost[n - 1] - cost[n]
        if i >= window - 1 and total <= most:
            first = i - window + 1 if first < 0 else first
            last = i + 1
    return (first, last) if first >= 0 else None


def _pieces(run: str) -> list[tuple[int, str]]:
    """(start, piece) of what is left of a run beside placeholder words, if the short window fits in."""
    cuts = [m.span() for m in _PLACEHOLDER.finditer(run)]
    bounds = zip([0, *(end for _, end in cuts)], [*(start for start, _ in cuts), len(run)])
    return [(a, run[a:b]) for a, b in bounds if b - a >= SHORT_WINDOW]


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """All (kind, start, end) of a text, ordered by start, then kind as in ``KINDS``."""
    if not text:
        return []
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    for m in _CANDIDATE.finditer(text):
        if _allowed(m.group()):
            continue
        for start, run in _pieces(m.group()):
            long = len(run) >= WINDOW
            if _allowed(run) or not (long or _MIXED.match(run)):
                continue
            if span := entropy_span(run, WINDOW if long else SHORT_WINDOW):
                found.append((m.start() + start + span[0], 3, m.start() + start + span[1]))
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def redact(text: str, spans: list[tuple[str, int, int]], mask: str = "[SECRET]") -> str:
    """``text`` with the union of the spans replaced, one mask for each covered stretch."""
    out, at = [], 0
    for _, start, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mask]
        at = end
    return "".join(out) + text[at:]


_SPAN = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id and ``spans``, an array of (kind, start, end)."""

    def spans(texts):
        found = [[dict(zip(("kind", "start", "end"), x)) for x in find_secrets(t)] for t in texts]
        return [pa.array(found, _ARROW_SPANS)]

    named = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return with_columns(named, ["doc_id"], "text", [StructField("spans", _SPAN)], spans)


def redacted(docs: DataFrame, text_col: str = "text", name: str = "n_secrets") -> DataFrame:
    """``docs`` with every secret in ``text_col`` masked, and ``name``, the number of spans; null stays null."""

    def masked(texts):
        found = [find_secrets(t) for t in texts]
        return [pa.array([redact(t, s) if s else t for t, s in zip(texts, found)], pa.string()),
                pa.array([len(s) for s in found], pa.int64())]

    rest = [c for c in docs.columns if c != text_col]
    new_text = free_name(docs, "masked_text")
    fields = [StructField(new_text, StringType()), StructField(name, LongType())]
    made = with_columns(docs, rest, text_col, fields, masked)
    return made.select(*[F.col(new_text).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns], name)


def joined(spans: Column) -> Column:
    """The spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
