"""Counts of greedy word pieces by a linear longest-match automaton.

The vocabulary is a trie. Where the next byte has no branch, a failure link says which
node holds what is left after the longest pieces are cut off, and how many pieces that
cut off is stored with it. So a word is read once, byte by byte, and no piece is built.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable

import numpy as np
import regex
from pyspark.sql import DataFrame

from shelfwise.llm.batches import field, kept_in_worker, named, with_columns

#: Fixed values of the vocabulary: what a word is, and the mark of its last piece.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
#: The end of a word as a symbol beside the 256 bytes.
END = 256
_KEEP_WORDS = 1 << 18


def _byte_of() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


def load_vocabulary(data: bytes) -> list[tuple[int, ...]]:
    """The vocabulary's pieces as symbols: bytes, and END in those that close a word."""
    byte_of, out = _byte_of(), []
    for piece in json.loads(data)["model"]["vocab"]:
        body = piece.removesuffix(WORD_END)
        if all(c in byte_of for c in body):
            out.append((*(byte_of[c] for c in body), *((END,) if body != piece else ())))
    return out


class Automaton:
    """Trie with failure links and the number of pieces each link pops."""

    def __init__(self, pieces: Iterable[tuple[int, ...]]):
        self.next: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for symbol in piece:
                if symbol not in self.next[node]:
                    self.next[node][symbol] = len(self.next)
                    self.next.append({})
                    whole.append(False)
                node = self.next[node][symbol]
            whole[node] = node > 0
        n = len(self.next)
        self.fail, self.pops = [-1] * n, [0] * n
        level = [0]
        while level:
            deeper = []
            for parent in level:
                for symbol, node in self.next[parent].items():
                    deeper.append(node)
                    if whole[node]:
                        self.fail[node], self.pops[node] = 0, 1
                        continue
                    at, pops = self.fail[parent], self.pops[parent]
                    while at >= 0 and symbol not in self.next[at]:
                        pops += self.pops[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[node], self.pops[node] = self.next[at][symbol], pops
            level = deeper

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1 (the unknown piece) if greedy cutting gets stuck."""
        nxt, fail, pops = self.next, self.fail, self.pops
        node = total = 0
        for symbol in (*word, END):
            while symbol not in nxt[node]:
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = nxt[node][symbol]
        while node:
            total += pops[node]
            node = fail[node]
            if node < 0:
                return 1
        return total


class Counts(dict):
    """Piece counts of words, remembered for as many words as stay in bounds."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(word.encode("utf-8"))
        if len(word) < 64:
            if len(self) >= _KEEP_WORDS:
                self.clear()
            self[word] = n
        return n


def words_of(text: bytes | None, pattern=regex.compile(WORD)) -> list[str]:
    """Words of a text in composed form and lower case."""
    return pattern.findall(unicodedata.normalize("NFC", (text or b"").decode("utf-8", "replace")).lower())


def token_counts(docs: DataFrame, vocabulary_path: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (doc_id), n_words, n_tokens: greedy longest-match pieces of every whole text.

    Null and empty texts have none. Bytes that aren't UTF-8 count as replacement characters.
    Repeated rows are counted each, and an empty table gives no rows.
    """
    with open(vocabulary_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # a file of a few MB, not of the corpus

    def make():
        counts = kept_in_worker("words", shared.value, lambda data: Counts(Automaton(load_vocabulary(data))))

        def rows(texts):
            n_words, n_tokens = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
            for k, text in enumerate(texts):
                words = words_of(text)
                n_words[k], n_tokens[k] = len(words), sum(map(counts.__getitem__, words))
            return [n_words, n_tokens]

        return rows

    return with_columns(docs, [named("text")], [field("n_words", "long"), field("n_tokens", "long")], make, ["doc_id"] if keep is None else keep)
