"""BPE encoding and decoding with a public tokenizer file (operator 3).

Encoding is exact BPE in time linear in the word: an Aho-Corasick automaton
gives the longest token starting at every position, and a walk takes them from
left to right, stepping down to shorter tokens, or back over the last one,
whenever two neighbours could not stand side by side in a BPE result. Two
tokens are compatible if undoing their merges, latest first, never shows a
pair across the border that BPE would have merged earlier. Decoding gathers
token bytes from one blob by an offset table.

Edge cases: null and empty texts give no ids and the empty text; a null id
list decodes to the empty text; repeated rows and clashing extra columns pass
through untouched, since only the id and text columns are read. Words longer
than ``CACHED_CHARS`` are encoded without the cache; none is cut.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.scan import list_column, map_texts, release

CACHED_CHARS = 48
CACHE_WORDS = 100_000
CACHE_PAIRS = 100_000

_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # the tokenizer file's own split pattern
_PLAIN = re.compile("[^\\x00-\\x1b\\x20-\\u024f]")  # beyond these: look at the code points one by one


def _byte_chars() -> dict[int, str]:
    """Byte -> printable character, the byte-level alphabet of the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Recent:
    """Cache of at most twice ``size`` entries: a full half becomes the old one, and is dropped when the next is full."""

    def __init__(self, size: int):
        self.size = size
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str) -> bytes | None:
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key: str, value: bytes) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value


class BpeEncoder:
    """Encoder for a word-level BPE file whose words end in a suffix token.

    ``spec`` is the JSON text of the tokenizer file. Token ids below the number
    of base symbols are symbols; merge r makes token ``n_symbols + r``.
    """

    def __init__(self, spec: str):
        import ahocorasick
        import regex

        raw = json.loads(spec)
        model, suffix = raw["model"], raw["model"]["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.spec, self.library = spec, None
        self.find = regex.compile(_PIECES).findall
        chars = _byte_chars()
        self.inner = bytes(vocab[chars[b]] for b in range(256))  # the 256 plain symbols have ids below 256
        self.last = [chr(vocab[chars[b] + suffix]) for b in range(256)]
        spelled = {t: chr(t) for t in self.inner}
        spelled |= {vocab[chars[b] + suffix]: self.last[b] for b in range(256)}
        self.parts = {t: (t, t) for t in spelled}
        self.merged: dict[tuple[int, int], int] = {}
        for pair in model["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            new = vocab[a + b]
            left, right = vocab[a], vocab[b]
            self.merged[left, right] = new
            self.parts[new] = (left, right)
            spelled[new] = spelled[left] + spelled[right]
        by_spelling = {s: t for t, s in spelled.items()}
        self.length = {t: len(s) for t, s in spelled.items()}
        self.shorter = {t: next((by_spelling[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in by_spelling), -1)
                        for t, s in spelled.items()}
        self.automaton = ahocorasick.Automaton()
        for s, t in by_spelling.items():
            self.automaton.add_word(s, t)
        self.automaton.make_automaton()
        self.special = {x["content"]: x["id"] for x in raw["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words, self.pieces = Recent(CACHE_WORDS), Recent(CACHE_WORDS)
        self.pairs: dict[tuple[int, int], bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE can leave ``a`` directly before ``b``."""
        limit = 1 << 62  # a merge across the border below this id would have come first
        while True:
            if self.merged.get((a, b), limit) < limit:
                return False
            a_left, a_right = self.parts[a]
            b_left, _ = self.parts[b]
            whole_a, whole_b = a_left == a and a_right == a, b_left == b
            if whole_a and whole_b:
                return True
            if whole_b or (not whole_a and a > b):
                limit, a = a, a_right
            else:
                limit, b = b + 1, b_left

    def piece(self, word: str) -> list[int]:
        """Token ids of one pre-token."""
        data = word.encode()
        symbols = data[:-1].translate(self.inner).decode("latin-1") + self.last[data[-1]]
        n, length, pairs = len(symbols), self.length, self.pairs
        longest = [-1] * n
        for end, token in self.automaton.iter(symbols):
            longest[end - length[token] + 1] = token
        shut: set[int] = set()  # positions from which the rest can't be encoded
        out: list[int] = []
        at, token, before = 0, longest[0], -1
        while at < n:
            while token >= 0:
                end = at + length[token]
                if end not in shut:
                    if before < 0:
                        break
                    fits = pairs.get((before, token))
                    if fits is None:
                        if len(pairs) >= CACHE_PAIRS:
                            pairs.clear()
                        fits = pairs[before, token] = self.compatible(before, token)
                    if fits:
                        break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at, before = end, token
                token = longest[at] if at < n else -1
            else:
                shut.add(at)
                back = out.pop()
                at -= length[back]
                before = out[-1] if out else -1
                token = self.shorter[back]
        return out

    def _chunk(self, chunk: str) -> bytes:
        text = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        found = []
        for p in self.find(text):
            known = self.pieces.get(p)
            if known is None:
                known = array("i", self.piece(p)).tobytes()
                if len(p) <= CACHED_CHARS:
                    self.pieces.put(p, known)
            found.append(known)
        return found[0] if len(found) == 1 else b"".join(found)

    def _unusual(self, text: str) -> bool:
        """Characters that Python's tables don't know, or that str.split() would drop: left to the file's own normaliser."""
        return _PLAIN.search(text) is not None and any(
            "\x1c" <= c <= "\x1f" or unicodedata.category(c) in ("Cn", "Cs") for c in set(text))

    def _plain(self, text: str, parts: list[bytes]) -> None:
        if self._unusual(text):
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_str(self.spec)
            split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            back = {c: b for b, c in _byte_chars().items()}
            for mapped, _ in split:
                word = bytes(back[c] for c in mapped).decode("utf-8")
                parts.append(np.array(self.piece(word), np.int32).tobytes())
            return
        words, get, put = self.words, self.words.get, self.words.put
        for chunk in text.split():
            known = words.new.get(chunk) or get(chunk)
            if known is None:
                known = self._chunk(chunk)
                if len(chunk) <= CACHED_CHARS:
                    put(chunk, known)
            parts.append(known)

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids of a whole text."""
        parts: list[bytes] = []
        if text and self.cut is not None and "<" in text:
            for k, piece in enumerate(self.cut.split(text)):
                if k % 2:
                    parts.append(np.array([self.special[piece]], np.int32).tobytes())
                else:
                    self._plain(piece, parts)
        elif text:
            self._plain(text, parts)
        return np.frombuffer(b"".join(parts), np.int32)


class BpeDecoder:
    """Token bytes in one blob, each followed by a space, with the table of their offsets."""

    def __init__(self, spec: str):
        raw = json.loads(spec)
        names = {t: s for s, t in raw["model"]["vocab"].items()} | {x["id"]: x["content"] for x in raw["added_tokens"]}
        tokens = [(names.get(t, "") + " ").encode() for t in range(max(names) + 1)]
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in tokens])]).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens, one space between them."""
        if not len(ids):
            return b""
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)
        return self.blob[at].tobytes()[:-1]


_made: dict[tuple[type, str], object] = {}


def _coder(kind, spec):
    """One coder of a kind per task; tasks drop it when they end, so that idle workers hold none."""
    key = (kind, spec.id)
    if key not in _made:
        _made.clear()
        _made[key] = kind(spec.value)
    return _made[key]


class _Spec:
    """The tokenizer file's text as a broadcast (its size is that of the file, a few MB)."""

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            self.sent = spark.sparkContext.broadcast(f.read())
        self.id = f"{path}#{self.sent._jbroadcast.id()}"

    def __getstate__(self):
        return {"sent": self.sent, "id": self.id}

    @property
    def value(self) -> str:
        return self.sent.value


def _decoded(codec: BpeDecoder, lists: pa.ListArray) -> pa.Array:
    return pa.array([codec.decode(x.values.to_numpy() if x.is_valid else np.zeros(0, np.int32)) for x in lists], pa.binary()).cast(pa.string())


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``ids`` and ``decoded``, in one pass: what :func:`decode` makes of :func:`encode`."""
    spec = _Spec(docs.sparkSession, path)

    def run(batches):
        encoder, decoder = BpeEncoder(spec.value), BpeDecoder(spec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                found = [encoder.encode(t) for t in b.column("text").to_pylist()]
                ids = list_column(np.concatenate(found), np.cumsum([len(x) for x in found]), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids, _decoded(decoder, ids)], ["doc_id", "ids", "decoded"])

    return map_texts(docs, {"doc_id": F.col(f"`{id_col}`").cast("long"), "text": text_col},
                     "doc_id long, ids array<int>, decoded string", run)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id and ``ids`` (array of token ids of the whole text)."""
    spec = _Spec(docs.sparkSession, path)

    def run(batches):
        codec = _coder(BpeEncoder, spec)
        for b in batches:
            found = [codec.encode(t) for t in b.column("text").to_pylist()]
            values = np.concatenate(found) if found else np.zeros(0, np.int32)
            ids = list_column(values, np.cumsum([len(x) for x in found]), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids], ["doc_id", "ids"])
        _made.clear()

    return map_texts(docs, {"doc_id": F.col(f"`{id_col}`").cast("long"), "text": text_col},
                     "doc_id long, ids array<int>", run)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``, to the rows of ``encode``."""
    spec = _Spec(encoded.sparkSession, path)

    def run(batches):
        codec = _coder(BpeDecoder, spec)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                lists = b.column("ids")
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), lists, _decoded(codec, lists)], ["doc_id", "ids", "decoded"])
        _made.clear()
        release()

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
