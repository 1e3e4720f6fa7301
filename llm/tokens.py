"""Pre-tokens of byte-level BPE files, and the ids of each."""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from llm.common import Powers, mix

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

_POWERS = Powers(0xD1342543DE82EF95)
_LETTER, _NUMBER, _OTHER, _SPACE = 1, 2, 3, 4


class PreTokens:
    """Splits texts as the file's own pre-tokenizer does, special strings first.

    The published pattern is evaluated over arrays of characters. Whether a character is a letter,
    a number, a space or something else is asked of the library, once for each character seen.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kind = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space"):
            raise ValueError("only byte-level files without a normalizer or prefix are supported")
        self.special_ids = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = sorted(self.special_ids, key=len, reverse=True)
        self.merges = self._merges(spec["model"])
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.kinds = np.zeros(0x110000, np.uint8)
        self.values = np.zeros(0x110000, np.uint64)

    def _kind(self, char: str) -> int:
        alone = lambda x: len(self.tokenizer.pre_tokenizer.pre_tokenize_str(x + char)) == 1
        return _LETTER if alone("a") else _NUMBER if alone("1") else _OTHER if alone("!") else _SPACE

    def _segments(self, texts: list[str]) -> tuple[list[int], list[int], list[int]]:
        """Length and text of each part between special strings, and which parts are such."""
        sizes, owner, special = [], [], []
        for k, text in enumerate(texts):
            if any(s in text for s in self.special):
                for j, part in enumerate(self.cut.split(text)):
                    if part:
                        if j % 2:
                            special.append(len(sizes))
                        sizes.append(len(part))
                        owner.append(k)
            elif text:
                sizes.append(len(text))
                owner.append(k)
        return sizes, owner, special

    def spans(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All texts as one, and of each pre-token the text's number, start, end and hash."""
        body = "".join(texts)
        n = len(body)
        if n == 0:
            none = np.zeros(0, np.int64)
            return body, none, none, none, none.astype(np.uint64)
        chars = np.frombuffer(body.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.kinds[chars]
        if not kind.all():
            for c in np.unique(chars[kind == 0]).tolist():
                self.kinds[c] = self._kind(chr(c))
                self.values[c] = mix(np.array([c + 1], np.uint64))[0] | np.uint64(1)
            kind = self.kinds[chars]
        sizes, owner, special = self._segments(texts)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        first = np.zeros(n + 1, bool)
        first[edges] = True
        blank = chars == 32
        run = first[:-1].copy()
        run[1:] |= kind[1:] != kind[:-1]
        space = kind == _SPACE
        # The last space before something else goes with it if blank, and is alone if not.
        tail = np.zeros(n, bool)
        tail[:-1] = space[:-1] & ~space[1:] & ~first[1:-1]
        after_blank = np.zeros(n, bool)
        after_blank[1:] = blank[:-1] & ~first[1:-1]
        start = np.where(space, run | tail, run & ~after_blank)
        # 's 't 'm 'd and 're 've 'll are tokens where an apostrophe begins one.
        quote = np.flatnonzero((chars == 39) & start)
        if len(quote):
            padded = np.concatenate([chars, [0, 0, 0]])
            inner = np.concatenate([first, [True, True, True]])
            a, b = padded[quote + 1], padded[quote + 2]
            two = np.isin(a, [ord(c) for c in "stmd"]) & ~inner[quote + 1]
            three = ((b == 101) & ((a == 114) | (a == 118)) | (a == 108) & (b == 108)) & ~(
                inner[quote + 1] | inner[quote + 2]
            )
            for hit, size in ((two, 2), (three, 3)):
                at = quote[hit]
                start[at + 1] = False
                ends = at + size
                ends = ends[ends < n]
                start[ends] = True
        for k in special:
            start[edges[k] : edges[k + 1]] = False
            start[edges[k]] = True
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], n)
        up, down = _POWERS.upto(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[chars] * up[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        text = np.array(owner)[np.searchsorted(edges, starts, "right") - 1]
        return body, text, starts, ends, hashes

    def _merges(self, model: dict) -> tiktoken.Encoding | None:
        """The same merges for a faster encoder of single pre-tokens, where the file's ids are in
        the order of its merges; None where they are not."""
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocab[a + b] for a, b in pairs]
        if made != list(range(256, 256 + len(made))):
            return None
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        chars = {chr(b): b for b in plain}
        rest = (b for b in range(256) if b not in set(plain))
        chars |= {chr(256 + k): b for k, b in enumerate(rest)}
        ranks = {
            bytes(map(chars.__getitem__, t)): i
            for t, i in vocab.items() if t not in self.special_ids
        }
        return tiktoken.Encoding(
            "pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each pre-token, as the tokenizers library gives them."""
        if self.merges is None:
            found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
            return [e.ids for e in found]
        special, encode = self.special_ids, self.merges.encode_ordinary
        return [[special[p]] if p in special else encode(p) for p in pieces]


@functools.lru_cache(2)
def pre_tokens(path: str = BYTE_BPE) -> PreTokens:
    """One for each worker and file. ``path`` must name a file that every executor has."""
    return PreTokens(path)
