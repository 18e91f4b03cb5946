"""SentencePiece encoding that keeps the byte spans of the source, and decoding.

The normaliser walks the model's compiled character map (a double-array trie of byte
prefixes) and takes the longest match; what has no match is copied. Every normalised
character remembers where in the source it came from, so each piece can be projected
back onto a byte span of the original text.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from array import array
from dataclasses import dataclass
from itertools import chain

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import field, kept_in_worker, named, with_columns

#: Fixed values of the model format: field numbers, kinds of pieces, the space symbol.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
SPACE = "▁"
_KEEP_CHUNKS = 300_000
_SHORT, _REMEMBERED, _NONE = 40, 64, float("inf")


def _fields(data: bytes):
    """(number, value) of a protobuf message's fields: ints, or bytes."""

    def varint(at):
        out = shift = 0
        while True:
            b = data[at]
            out |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return out, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        elif key & 7 == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            width = {1: 8, 5: 4}[key & 7]
            value, at = data[at : at + width], at + width
        yield key >> 3, value


class CharacterMap:
    """Longest-prefix lookups in a compiled character map."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, dtype="<u4", offset=4, count=size // 4).tolist() if compiled else []
        self.texts = compiled[4 + size :] if compiled else b""
        first = {b for b in range(256) if self._child(0, b)} if self.units else set()
        self.first = frozenset(first)

    def _child(self, node: int, byte: int) -> int:
        unit = self.units[node]
        nxt = node ^ ((unit >> 10) << ((unit & 512) >> 6)) ^ byte
        return nxt if nxt < len(self.units) and self.units[nxt] & 0x800000FF == byte else 0

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest mapped prefix of ``source[at:]``."""
        if source[at] not in self.first:
            return None
        node, best, k = 0, None, at
        while k < len(source):
            node = self._child(node, source[k])
            if not node:
                break
            k += 1
            unit = self.units[node]
            if unit & 256:
                leaf = node ^ ((unit >> 10) << ((unit & 512) >> 6))
                best = (k - at, self.units[leaf] & 0x7FFFFFFF)
        if best is None:
            return None
        length, start = best
        return length, self.texts[start : self.texts.index(b"\0", start)]


@dataclass
class Normalised:
    """``text`` and, for each of its characters and its end, the source byte it begins at."""

    text: str
    starts: np.ndarray


class Model:
    """Pieces and normaliser of a BPE model, read from its serialised form."""

    def __init__(self, serialised: bytes):
        self.ids, self.scores, self.kinds = {}, [], []
        compiled, self.dummy, self.trim, self.escape, kind, self.fallback, suffix = b"", True, True, True, 1, False, False
        for number, value in _fields(serialised):
            if number == PIECES:
                piece = dict(_fields(value))
                self.kinds.append(piece.get(3, NORMAL))
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.ids[piece.get(1, b"").decode()] = len(self.kinds) - 1
            elif number == TRAINER:
                spec = dict(_fields(value))
                kind, self.fallback, suffix = spec.get(3, 1), bool(spec.get(35, 0)), bool(spec.get(24, 0))
            elif number == NORMALIZER:
                spec = dict(_fields(value))
                compiled = spec.get(2, b"")
                self.dummy, self.trim, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        if kind != BPE or suffix or {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError("only BPE models without user-defined or unused pieces and with leading space symbols")
        self.map = CharacterMap(compiled)
        self.unknown = self.kinds.index(UNKNOWN)
        self.merges = {p: i for p, i in self.ids.items() if self.kinds[i] == NORMAL}
        self.ranks = {p: -self.scores[i] for p, i in self.merges.items()}
        self.bytes = [self.ids.get(f"<0x{b:02X}>", self.unknown) for b in range(256)]
        # Without pieces that hold a space symbol after another character, merges stay within chunks.
        inner = any(SPACE in p.lstrip(SPACE) for p in self.merges)
        self.chunks = re.compile("(?s).+" if inner or not self.escape else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.pairs = {p[k : k + 2] for p in self.merges for k in range(len(p) - 1)}
        self.names = [str(i) for i in range(len(self.kinds))]
        self.known: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    # --- normalising -----------------------------------------------------------------

    def _mapped(self, source: bytes) -> Normalised:
        """Longest-prefix replacement, with the alignment of every character."""
        if not self.map.first:
            try:
                return Normalised(source.decode(), _char_starts(source))
            except UnicodeDecodeError:
                pass
        out, starts, at, plain = [], [], 0, re.compile(b"[^" + b"".join(re.escape(bytes([b])) for b in sorted(self.map.first | set(range(128, 256)))) + b"]+")
        while at < len(source):
            same = plain.match(source, at)
            if same:
                out.append(same.group().decode())
                starts.append(np.arange(at, same.end()))
                at = same.end()
                continue
            found = self.map.longest(source, at)
            if found:
                length, text = found[0], found[1].decode()
            else:
                length, text = _char_at(source, at)
            out.append(text)
            starts.append(np.full(len(text), at))
            at += length
        return Normalised("".join(out), np.concatenate([*starts, [len(source)]]).astype(np.int64))

    def normalise(self, source: bytes) -> Normalised:
        """The text that is cut into pieces, with its alignment to the source."""
        got = self._mapped(source)
        text, starts = got.text, got.starts
        if self.trim:
            keep = [m.span() for m in re.finditer("[^ ]+ ?", text)]
            if keep and text[keep[-1][1] - 1] == " ":
                keep[-1] = (keep[-1][0], keep[-1][1] - 1)
            starts = np.concatenate([*[starts[a:b] for a, b in keep], [starts[keep[-1][1]] if keep else starts[-1]]])
            text = "".join(text[a:b] for a, b in keep)
        if self.dummy and text:
            text, starts = " " + text, np.concatenate([starts[:1], starts])
        return Normalised(text.replace(" ", SPACE) if self.escape else text, starts)

    # --- merging -----------------------------------------------------------------------

    def _merge_short(self, chunk: str) -> list[str]:
        """As ``_merge``, with a plain list of the ranks of neighbours."""
        parts, get = list(chunk), self.ranks.get
        ranks = [get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at], _NONE)
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1], _NONE)
        return parts

    def _merge(self, chunk: str) -> list[str]:
        """Best pair first, the left one of equals, until nothing merges."""
        if len(chunk) <= _SHORT:
            return self._merge_short(chunk)
        parts: list[str | None] = list(chunk)
        n, ranks = len(parts), self.ranks
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        queue: list[tuple] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (rank := ranks.get(parts[a] + parts[b])) is not None:
                heapq.heappush(queue, (rank, a, b, len(parts[a]) + len(parts[b])))

        for a in range(n - 1):
            offer(a, a + 1)
        while queue:
            _, a, b, size = heapq.heappop(queue)
            if parts[a] is None or parts[b] is None or right[a] != b or len(parts[a]) + len(parts[b]) != size:
                continue
            parts[a], parts[b] = parts[a] + parts[b], None
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [p for p in parts if p is not None]

    def _cut(self, text: str) -> tuple[tuple[int, ...], bytes]:
        """Ids of a chunk that nothing splits, and the characters that each of them covers."""
        ids, widths = [], []
        for part in self._merge(text):
            got = self.merges.get(part)
            if got is not None:
                ids.append(got)
                widths.append(len(part))
            elif self.fallback:
                # Byte pieces of a character: all but the last one cover nothing.
                own = [self.bytes[b] for b in part.encode()]
                ids += own
                widths += [0] * (len(own) - 1) + [len(part)]
            elif ids and ids[-1] == self.unknown:
                widths[-1] += len(part)  # neighbouring unknown characters are one piece
            else:
                ids.append(self.unknown)
                widths.append(len(part))
        return tuple(ids), array("i", widths).tobytes()

    def chunk(self, text: str) -> tuple[tuple[int, ...], bytes]:
        """``_cut``, remembered; what no piece can join is looked up apart."""
        got = self.older.get(text)
        if got is None:
            pairs = self.pairs
            cuts = [k for k in range(1, len(text)) if text[k - 1 : k + 1] not in pairs] if self.fallback else []
            if cuts:
                known, chunk = self.known, self.chunk
                parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
                found = [known.get(t) or chunk(t) for t in parts]
                got = tuple(chain.from_iterable([f[0] for f in found])), b"".join([f[1] for f in found])
            else:
                got = self._cut(text)
        if len(text) <= _REMEMBERED:
            if len(self.known) >= _KEEP_CHUNKS:
                # What was used since the last turn stays at hand, what wasn't goes.
                self.older = dict(self.known)
                self.known.clear()
            self.known[text] = got
        return got

    def encode(self, source: bytes) -> tuple[list[int], np.ndarray, np.ndarray]:
        """ids, first source bytes and ends in source bytes."""
        normal = self.normalise(source)
        known, chunk = self.known, self.chunk
        found = [known.get(t) or chunk(t) for t in self.chunks.findall(normal.text)]
        ids = list(chain.from_iterable([f[0] for f in found]))
        widths = np.frombuffer(b"".join([f[1] for f in found]), dtype=np.int32)
        ends = np.cumsum(widths, dtype=np.int64)
        return ids, normal.starts[ends - widths], normal.starts[ends]

    def joined(self, ids: list[int]) -> str:
        return ",".join(map(self.names.__getitem__, ids))


def _char_starts(source: bytes) -> np.ndarray:
    raw = np.frombuffer(source, dtype=np.uint8)
    return np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(source))


def _char_at(source: bytes, at: int) -> tuple[int, str]:
    """Bytes and text of the character at a place; a byte that begins none is a replacement character of its own."""
    lead = source[at]
    length = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
    try:
        return length, source[at : at + length].decode()
    except UnicodeDecodeError:
        return 1, "\ufffd"


# --- Spark -----------------------------------------------------------------------------


def _loaded(spark, path: str):
    """The model file, read by the driver and sent along; a few MB at most, whatever the corpus."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, model_path: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (doc_id) with ids, begins and ends: one entry a piece, spans in source bytes.

    A null text is encoded as an empty one, which has no pieces. Bytes of a character that
    falls back are empty spans but for the last, which covers the character.
    """
    shared = _loaded(docs.sparkSession, model_path)

    def make():
        model = kept_in_worker("pieces", shared.value, Model)

        def rows(texts):
            out = [model.encode(t or b"") for t in texts]
            return [[np.array(o[0], dtype=np.int32) for o in out], [o[1] for o in out], [o[2] for o in out]]

        return rows

    made = [field("ids", "array<int>"), field("begins", "array<long>"), field("ends", "array<long>")]
    return with_columns(docs, [named("text")], made, make, ["doc_id"] if keep is None else keep)


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text that the ids stand for; a null list stands for the empty text."""
    shared = _loaded(encoded.sparkSession, model_path)

    def make():
        library = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        return lambda every: [[library.decode(i or []) for i in every]]

    return with_columns(encoded, [named(ids)], [field(name, "string")], make)


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, covered_bytes: encoding and decoding in one pass.

    ``covered_bytes`` counts the source bytes inside the spans of pieces.
    """
    shared = _loaded(docs.sparkSession, model_path)

    def make():
        model, library = kept_in_worker("pieces", shared.value, Model), sentencepiece.SentencePieceProcessor(model_proto=shared.value)

        def rows(texts):
            counts, ids_sha, text_sha, covered = [], [], [], []
            for text in texts:
                ids, begins, ends = model.encode(text or b"")
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(model.joined(ids).encode()).hexdigest())
                text_sha.append(hashlib.sha256(library.decode(ids).encode()).hexdigest())
                covered.append(int((ends - begins).sum()))
            return [counts, ids_sha, text_sha, covered]

        return rows

    made = [field("n_tokens", "long"), field("ids_sha256", "string"), field("decoded_sha256", "string"), field("covered_bytes", "long")]
    return with_columns(docs, [named("text")], made, make, ["doc_id"])
