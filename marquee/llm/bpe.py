"""Byte-pair merges as a last-token recurrence, shared by the encoder (op 1) and the prefix counter (op 7).

A token sequence is the merge result of its text exactly if every two neighbours are *stable*: merging the text
of both alone never crosses their border. So each prefix of a word has one possible last token: the vocabulary
token ending there that is stable after the last token of the prefix before it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np

_NEVER = 1 << 60
_MEMO_LIMIT = 400_000


class Merges:
    """Vocabulary of one merge table. Symbols are byte strings or character strings.

    ``ids``: symbol text to token id. ``split``: token id to the two ids it is made of (none for base symbols).
    ``rank``: token id to merge priority, smaller first; equal ranks merge from left to right.
    """

    def __init__(self, ids: dict, split: dict[int, tuple[int, int]], rank: dict[int, int]):
        self.ids, self.split, self.rank = ids, split, rank
        self._begins = {s[:k] for s in ids for k in range(1, len(s) + 1)}
        self.steps: dict = {}
        self.joined = {pair: t for t, pair in split.items()}
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._left: dict[int, list[tuple[int, int]]] = {}
        self.known: dict[tuple[int, int], bool] = {}

    def _spine(self, token: int, side: int, memo: dict[int, list[tuple[int, int]]]) -> list[tuple[int, int]]:
        """The border symbols of a token while it is built, last first, with the rank of the merge that made each."""
        if token not in memo:
            chain, t = [], token
            while t in self.split:
                chain.append((t, self.rank[t]))
                t = self.split[t][side]
            memo[token] = [*chain, (t, -1)]
        return memo[token]

    def stable(self, a: int, b: int) -> bool:
        """Whether the border between two neighbouring tokens outlives all merges on either side.

        Walks back in time over the symbols that met at the border: a joining merge counts if it would run before
        the next merge on either side (on equal ranks the left place goes first).
        """
        known = self.known.get((a, b))
        if known is None:
            if len(self.known) >= _MEMO_LIMIT:
                self.known.clear()
            known = self.known[a, b] = self._border_holds(a, b)
        return known

    def _border_holds(self, a: int, b: int) -> bool:
        left, right = self._spine(a, 1, self._right), self._spine(b, 0, self._left)
        i = j = 0
        left_next = right_next = _NEVER
        while True:
            (x, x_made), (y, y_made) = left[i], right[j]
            z = self.joined.get((x, y))
            if z is not None and self.rank[z] < left_next and self.rank[z] <= right_next:
                return False
            if x_made < 0 and y_made < 0:
                return True
            if x_made > y_made:
                left_next, i = x_made, i + 1
            else:
                right_next, j = y_made, j + 1

    def step(self, state, symbol):
        """The longest suffix of ``state + symbol`` that begins some token, and the tokens that end there.

        ``state`` is such a suffix (empty at the start of a word). Returns (next state, ((token, length), ...)),
        longest token first; the pairs are memoised, so a walk pays one look-up per symbol.
        """
        key = state + symbol
        known = self.steps.get(key)
        if known is None:
            if len(self.steps) >= _MEMO_LIMIT:
                self.steps.clear()
            longest = key
            while longest and longest not in self._begins:
                longest = longest[1:]
            ends = tuple((self.ids[longest[k:]], len(longest) - k) for k in range(len(longest)) if longest[k:] in self.ids)
            known = self.steps[key] = longest, ends
        return known

    def walk(self, order: list) -> Iterator[tuple]:
        """Last tokens and token counts of all prefixes of many words: yields (word, last, counts) for each.

        ``order`` holds distinct non-empty words, sorted: the depth-first order of their trie. The lists belong to the
        current path (entry d for the prefix of d symbols). At each word the walk goes back to the prefix it shares
        with the word before and works out only what lies below, so a shared prefix is computed once. A symbol in
        no token has the last token -1, counts as its UTF-8 bytes and merges with nothing.
        """
        steps, stable, step, hold = self.steps, self.known, self.step, self.stable
        last, counts, states = [-1], [0], [order[0][:0] if order else ""]
        for word, shared in zip(order, shared_prefixes(order)):
            del last[shared + 1 :], counts[shared + 1 :], states[shared + 1 :]
            state = states[shared]
            for depth in range(shared + 1, len(word) + 1):
                symbol = word[depth - 1 : depth]
                found = steps.get(state + symbol)
                state, ends = found if found is not None else step(state, symbol)
                states.append(state)
                for token, size in ends:
                    before = last[depth - size]
                    if before == -1:
                        break
                    ok = stable.get((before, token))
                    if ok or ok is None and hold(before, token):
                        break
                if not ends:
                    token, size = -1, 1
                last.append(token)
                counts.append(counts[depth - size] + (1 if token >= 0 else _utf8_size(symbol)))
            yield word, last, counts


def _utf8_size(symbol) -> int:
    return len(symbol.encode("utf-8", "surrogatepass")) if isinstance(symbol, str) else 1


def shared_prefixes(order: list) -> list[int]:
    """Length of the prefix that each of the sorted words shares with the one before (0 for the first)."""
    if not order:
        return []
    sizes = np.fromiter(map(len, order), np.int64, len(order))
    rows = np.array(order).view(np.uint32 if isinstance(order[0], str) else np.uint8).reshape(len(order), -1)
    differ = rows[1:] != rows[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return [0, *np.minimum(first, np.minimum(sizes[1:], sizes[:-1])).tolist()]


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies: printable Latin-1 stands for itself,
    the other bytes, in order, for the code points from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def load_byte_level(path: str) -> tuple[Merges, dict[int, bytes], dict[str, int]]:
    """Merges over bytes, the bytes of every token id, and the added tokens of a tokenizer JSON file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte_of = byte_alphabet()
    to_bytes = lambda s: bytes(byte_of[c] for c in s)
    vocab, added = spec["model"]["vocab"], {a["content"]: a["id"] for a in spec["added_tokens"]}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    split = {vocab[a + b]: (vocab[a], vocab[b]) for a, b in pairs}
    rank = {vocab[a + b]: k for k, (a, b) in enumerate(pairs)}
    text_of = {i: to_bytes(s) for s, i in vocab.items() if s not in added}
    ids = {raw: i for i, raw in text_of.items() if len(raw) == 1 or i in split}
    return Merges(ids, split, rank), text_of | {i: s.encode() for s, i in added.items()}, added
