"""A byte-level BPE vocabulary: plain merges, a backtracking encoder, a decoder."""

from __future__ import annotations

import heapq
import json
from functools import cache, cached_property

import ahocorasick
import numpy as np
from tokenizers import Tokenizer

from changeflow.llm.pretokens import unknown_points

#: Longest word that a per-process table remembers, and how many words it holds.
REMEMBERED_CHARS = 48
REMEMBERED = 300_000


@cache
def _bytes_of_signs() -> dict[str, int]:
    """The printable sign that stands for each byte: itself if it is printable Latin-1,
    else the next code point from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBPE:
    """Tables of one vocabulary file; one object for each file and process."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        signs = _bytes_of_signs()
        vocab = {bytes(signs[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        self.id_of = vocab
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.token = [b""] * size
        for t, i in vocab.items():
            self.token[i] = t
        for t, i in self.specials.items():
            self.token[i] = t.encode()
        self.byte_id = [vocab[bytes([b])] for b in range(256)]
        #: (left, right) -> (rank, merged id); the parts and rank of each merged token.
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (bytes(signs[c] for c in s) for s in (pair.split(" ") if isinstance(pair, str) else pair))
            made = vocab[a + b]
            self.merges[vocab[a], vocab[b]] = rank, made
            self.parts.setdefault(made, (rank, vocab[a], vocab[b]))
        self._compatible: dict[tuple[int, int], bool] = {}
        self._shorter: dict[int, int] = {}
        self._spines: dict[tuple[int, bool], list[tuple[int, float]]] = {}

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    # -- plain merges ---------------------------------------------------------

    def merged(self, word: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        ids = [self.byte_id[b] for b in word]
        if len(ids) > 100:
            return self._merged_long(ids)
        merges = self.merges
        while len(ids) > 1:
            best = None
            for k in range(len(ids) - 1):
                found = merges.get((ids[k], ids[k + 1]))
                if found and (best is None or found < best[0]):
                    best = found, k
            if best is None:
                break
            k = best[1]
            ids[k : k + 2] = [best[0][1]]
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and links, for words of any length."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] < n:
                found = self.merges.get((ids[k], ids[after[k]]))
                if found:
                    heapq.heappush(heap, (found[0], k, ids[k], ids[after[k]], found[1]))

        for k in range(n - 1):
            offer(k)
        while heap:
            _, k, left, right, made = heapq.heappop(heap)
            j = after[k]
            if ids[k] != left or j >= n or ids[j] != right:
                continue
            ids[k], ids[j] = made, -1
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return [i for i in ids if i >= 0]

    @cached_property
    def whole(self) -> dict[str, int]:
        """Vocabulary strings that encode, alone, as their one token: proved by merging each."""
        out = {}
        for t, i in self.id_of.items():
            if self.merged(t) == [i]:
                try:
                    out[t.decode()] = i
                except UnicodeDecodeError:
                    pass
        return out

    # -- backtracking encoder ----------------------------------------------------

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for t, i in self.id_of.items():
            found.add_word(t.decode("latin-1"), (len(t), i))
        found.make_automaton()
        return found

    def _spine(self, token: int, right: bool) -> list[tuple[int, float]]:
        """The tokens along the right (left) edge while ``token`` is being merged, with
        the rank of the merge that ends each."""
        key = token, right
        if key not in self._spines:
            out, ends = [], float("inf")
            while True:
                out.append((token, ends))
                if token not in self.parts:
                    break
                ends, left, other = self.parts[token]
                token = other if right else left
            self._spines[key] = out
        return self._spines[key]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of the two tokens encode as just these two.

        They do not if two pieces that meet at the seam would merge before either is
        used up on its own side (in a tie the left merge comes first)."""
        key = a, b
        if key not in self._compatible:
            if len(self._compatible) > REMEMBERED:
                self._compatible.clear()
            self._compatible[key] = not any(
                (found := self.merges.get((r, l))) and found[0] < r_ends and found[0] <= l_ends
                for r, r_ends in self._spine(a, True)
                for l, l_ends in self._spine(b, False)
            )
        return self._compatible[key]

    def _next_shorter(self, token: int) -> int:
        """The longest token that is a proper prefix, or -1."""
        if token not in self._shorter:
            t = self.token[token]
            self._shorter[token] = next(
                (self.id_of[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.id_of), -1
            )
        return self._shorter[token]

    def encode_word(self, word: bytes) -> list[int]:
        """Longest matches from the automaton, each checked against the token before it;
        where none fits, one step back.  A place that leads nowhere is never tried again."""
        n = len(word)
        longest = [(0, -1)] * n
        for end, (width, token) in self.automaton.iter(word.decode("latin-1")):
            at = end - width + 1
            if width > longest[at][0]:
                longest[at] = width, token
        out: list[int] = []
        at, open_ = 0, bytearray(b"\1") * (n + 1)
        token = longest[0][1] if n else -1
        while at < n:
            end = at + len(self.token[token])
            if open_[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at][1] if at < n else -1
                continue
            token = self._next_shorter(token)
            if token < 0:
                open_[at] = 0
                token = out.pop()
                at -= len(self.token[token])
        return out

    # -- whole texts ------------------------------------------------------------------

    def is_odd(self, text: str) -> bool:
        """Holds a special string or characters newer than this Python's tables."""
        return any(s in text for s in self.specials) or unknown_points(text)

    def odd_words(self, text: str) -> list[bytes | int]:
        """Pre-tokens of such a text by the library's own cutter; special ids as they are."""
        signs = _bytes_of_signs()
        out: list[bytes | int] = []

        def cut(part: str, specials: list[str]) -> None:
            if not part:
                return
            if not specials:
                out.extend(bytes(signs[c] for c in w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(part))
                return
            for k, piece in enumerate(part.split(specials[0])):
                if k:
                    out.append(self.specials[specials[0]])
                cut(piece, specials[1:])

        cut(text, list(self.specials))
        return out

    # -- decoder -------------------------------------------------------------------------

    @cached_property
    def offsets(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all tokens in a row, and the start and length of each."""
        lengths = np.array([len(t) for t in self.token], dtype=np.int64)
        return np.frombuffer(b"".join(self.token), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths


@cache
def byte_bpe(path: str) -> ByteBPE:
    return ByteBPE(path)


class Remembered(dict):
    """What has been worked out for short words, up to a fixed number of them."""

    def of(self, words: list, work) -> list:
        out = []
        for w in words:
            found = self.get(w)
            if found is None:
                found = work(w)
                if len(w) <= REMEMBERED_CHARS:
                    if len(self) >= REMEMBERED:
                        self.clear()
                    self[w] = found
            out.append(found)
        return out


@cache
def remembered(purpose: str, path: str) -> Remembered:
    return Remembered()
