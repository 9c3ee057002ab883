"""Byte-level BPE over many texts at once, equal to encoding every whole text on its own.

The splitting rule of these vocabularies never looks behind and joins nothing across a white-space run
that is followed by a word, so a text may be cut before each such run, and
between letters and a full stop, comma or the like. The pieces repeat, and each
distinct one is encoded once per worker, by the vocabulary's ranks where its ids are those; a text with white space beyond ASCII, or
with the string of an added token where these count, is encoded as a whole.
Runs inside tasks. The vocabulary file is a parameter and must be readable on every machine.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence
from functools import cached_property
from itertools import chain

import numpy as np

KNOWN_PIECES = 700_000  # pieces, and
KNOWN_TOKENS = 8_000_000  # their tokens, that a worker remembers before it starts afresh
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_PIECE = re.compile(rf"[ \t-\r]*[{_LETTERS}]+(?=[ \t-\r.,;:!?]|\Z)|[ \t-\r]*[^ \t-\r]+|[ \t-\r]+\Z")
_OTHER_SPACE = re.compile("[\x85\xa0  -     　]")  # fixed values: white space beyond ASCII
_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, added_tokens: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file; with ``added_tokens`` their strings in a text are those tokens."""
    if (path, added_tokens) not in _encoders:
        _encoders[path, added_tokens] = Encoder(path, added_tokens)
    return _encoders[path, added_tokens]


class Encoder:
    def __init__(self, path: str, added_tokens: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens  # else their strings in a text are ordinary text
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self.whole = re.compile("|".join([_OTHER_SPACE.pattern, *map(re.escape, added)]))  # texts that are not cut
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        plain = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        ranks = _by_ranks(path, self.table()) or plain
        self.encode = (lambda t: plain(t) if self.added.search(t) else ranks(t)) if added else ranks
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers()
        self.tokens = np.zeros(1 << 16, np.uint32)
        self.bounds = np.zeros(1 << 16, np.int64)  # tokens of piece i are tokens[bounds[i]:bounds[i + 1]]

    def _learn(self) -> None:
        """Encode the pieces that were numbered since the last time."""
        new, self.known.new = self.known.new, []
        if not new:
            return
        found = [self.encode(p) for p in new]
        n, start = len(self.known) - len(new), self.bounds[len(self.known) - len(new)]
        ends = start + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        self.tokens = _room(self.tokens, int(ends[-1]))
        self.bounds = _room(self.bounds, n + len(new) + 1)
        self.tokens[start : ends[-1]] = np.fromiter(chain.from_iterable(found), np.uint32, int(ends[-1] - start))
        self.bounds[n + 1 : n + len(new) + 1] = ends

    def table(self) -> list[bytes]:
        """The bytes of every token."""
        return self._table

    def ids(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, without special tokens, and the bounds of each text's ids."""
        parts = [[t] if self.whole.search(t) else _PIECE.findall(t) for t in texts]
        if len(self.known) > KNOWN_PIECES or self.bounds[len(self.known)] > KNOWN_TOKENS:
            self._forget()
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum()))
        self._learn()
        starts = self.bounds[at]
        lengths = self.bounds[at + 1] - starts
        before = np.concatenate([[0], np.cumsum(lengths)])
        flat = self.tokens[np.repeat(starts - before[:-1], lengths) + np.arange(before[-1])]
        return flat, before[np.concatenate([[0], np.cumsum(counts)])]

    @cached_property
    def _table(self) -> list[bytes]:
        size = self.tokenizer.get_vocab_size()
        back = {c: b for b, c in _byte_letters().items()}
        return [bytes(back.get(c, 0x3F) for c in self.tokenizer.id_to_token(i) or "") for i in range(size)]


class _Numbers(dict):
    """Numbers pieces in the order they first come, and notes those that are new."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


def _by_ranks(path: str, table: list[bytes]):
    """The same encoding several times faster, if the ids are the order of the merges; else None."""
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    model, extra = given["model"], {t["id"] for t in given["added_tokens"]}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    plain = given["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    ordered = all(model["vocab"][a + b] == 256 + i for i, (a, b) in enumerate(merges))
    if not plain or not ordered or given["normalizer"] or len(table) - len(extra) != 256 + len(merges):
        return None
    ranks = {t: i for i, t in enumerate(table) if i not in extra}
    return tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _room(values: np.ndarray, size: int) -> np.ndarray:
    return values if size <= len(values) else np.concatenate([values, np.zeros(max(size, len(values)), values.dtype)])


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the
    others in turn for the letters from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    others = (b for b in range(256) if b not in letters)
    return letters | {b: chr(0x100 + i) for i, b in enumerate(others)}
