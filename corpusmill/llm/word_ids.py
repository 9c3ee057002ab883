"""Ids of whole texts under a vocabulary of words with end marks, equal to one plain encoding of the text.

Such a vocabulary drops white space, so a text's ids are those of its words one after the other, and
words repeat. A worker keeps the ids of the words it has met. A new plain word is split by the vocabulary's
own rule and each part encoded by ranks: every byte that may end a part has an end-marked form, and
merging by the lowest rank first gives the part's ids. Words beyond Latin letters and ASCII, texts with
other white space, texts with the string of an added token where these count, and vocabularies of
another make go through the ``tokenizers`` library. Runs inside tasks.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from corpusmill.llm.tokens import _byte_letters

KNOWN_WORDS = 600_000  # words a worker remembers before it starts afresh
_OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")  # fixed values
_PLAIN = re.compile(r"[!-~\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f]+")  # letters whose lower case is one letter
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: The rule under which words are encoded on their own.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_END, _MARK = "</w>", b"\xff"  # no UTF-8 text holds the byte that stands for the end mark
_encoders: dict[tuple[str, bool], WordIds] = {}


def word_ids(path: str, added_tokens: bool = False) -> WordIds:
    """The worker's encoder for a vocabulary file; with ``added_tokens`` their strings in a text are those tokens."""
    if (path, added_tokens) not in _encoders:
        _encoders[path, added_tokens] = WordIds(path, added_tokens)
    return _encoders[path, added_tokens]


class WordIds:
    def __init__(self, path: str, added_tokens: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        with open(path, encoding="utf-8") as f:
            self.part = _by_ranks(json.load(f))
        self.words = _Known(self._word)
        self.parts = _Known(self.part)

    def of_text(self, text: str) -> bytes:
        """The text's ids, four bytes each, the lowest first."""
        if self.part is None or _OTHER_SPACE.search(text) or self.added.search(text):
            return self._plainly(text)
        if len(self.words) > KNOWN_WORDS:
            self.words.clear()
            self.parts.clear()
        return b"".join(map(self.words.__getitem__, text.split()))

    def _word(self, word: str) -> bytes:
        if not _PLAIN.fullmatch(word):
            return self._plainly(word)
        return b"".join(map(self.parts.__getitem__, _PARTS.findall(word.lower())))

    def _plainly(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class _Known(dict):
    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


def _by_ranks(given: dict):
    """Encoding of one part of a word, or None for a vocabulary of another make."""
    model, normal, split = given["model"], given["normalizer"] or {}, given["pre_tokenizer"] or {}
    steps = split.get("pretokenizers", [{}])
    if (
        model.get("end_of_word_suffix") != _END or model.get("continuing_subword_prefix") or model.get("byte_fallback")
        or model.get("ignore_merges") or normal.get("normalizers") != _NORMALIZERS
        or [s.get("type") for s in steps] != ["Split", "ByteLevel"] or steps[0].get("pattern") != {"Regex": _SPLIT}
        or steps[1].get("add_prefix_space") or steps[1].get("use_regex")
    ):
        return None
    import tiktoken

    letters = {c: b for b, c in _byte_letters().items()}

    def raw(token: str) -> bytes:
        ends = token.endswith(_END)
        return bytes(letters[c] for c in (token[: -len(_END)] if ends else token)) + _MARK * ends

    numbers = {raw(t): i for t, i in model["vocab"].items()}
    ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + _MARK: 256 + b for b in range(255)}
    for i, merge in enumerate(model["merges"]):
        ranks[raw("".join(merge.split(" ") if isinstance(merge, str) else merge))] = 511 + i
    if len(numbers) != len(model["vocab"]) or len(ranks) != 511 + len(model["merges"]):
        return None
    number = np.full(len(ranks), -1, np.int64)
    for token, rank in ranks.items():
        number[rank] = numbers.get(token, -1)
    merges = tiktoken.Encoding("given", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})

    def part(text: str) -> bytes:
        return number[merges._core_bpe.encode_single_piece(text.encode() + _MARK)].astype("<u4").tobytes()

    return part
