"""Token ids of whole texts, word by word with a memory of words."""
from __future__ import annotations

import json
import os
from array import array
from collections import defaultdict
from itertools import chain, count, islice
from operator import attrgetter

import numpy as np

# Words remembered by one worker; beyond that the first half of them is kept, as
# frequent words come early.
REMEMBERED = 500_000
# Punctuation that the tokenizer splits from letters before it.
PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Fixed value: the pieces that words are split into.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Latin letters up to here have one lower-case letter each, but for U+0130.
LATIN_END, DOTTED = "\u0180", "\u0130"
# The first byte in UTF-8 of the last of them.
LATIN_LEAD = 0xC5
_ID = attrgetter("id")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it can be seen, else the
    next free one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(
        b for b in range(256) if b not in set(seen))}


def _numbers(words: list[bytes] = []) -> defaultdict:
    """Numbers words in the order they are first asked for, after ``words``."""
    return defaultdict(count(len(words)).__next__, zip(words, count()))


def _last(numbers: dict, n: int) -> list:
    """What was numbered from ``n`` on."""
    return list(islice(reversed(numbers), len(numbers) - n))[::-1]


class _Ids:
    """The ids of numbered words, one after the other."""

    def __init__(self):
        self.ids: np.ndarray = np.zeros(1 << 16, np.uint16)
        self.first = np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.first) - 1

    def add(self, flat: np.ndarray, length: np.ndarray) -> None:
        if len(flat) and flat.max() >= 1 << 16:
            self.ids = self.ids.astype(np.uint32)
        used = int(self.first[-1])
        if used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(used + len(flat), self.ids.dtype)))
        self.ids[used:used + len(flat)] = flat
        self.first = np.concatenate((self.first, used + np.cumsum(length)))

    def of(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words ``n``, and where those of each end."""
        start = self.first[n]
        length = self.first[n + 1] - start
        stop = np.cumsum(length)
        total = int(stop[-1]) if len(stop) else 0
        return self.ids[np.arange(total) + np.repeat(start - stop + length, length)], stop


def by_words(file: dict) -> bool:
    """Whether a tokenizer file is of the kind that WordTokens takes apart: NFC,
    white space as one blank, lower case; pieces of letters, single digits or
    other signs, none with white space in it; and special tokens without it."""
    kinds = lambda part, key: [x["type"] for x in (file.get(part) or {}).get(key, [])]
    split = (file.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    return (kinds("normalizer", "normalizers") == ["NFC", "Replace", "Lowercase"]
            and kinds("pre_tokenizer", "pretokenizers") == ["Split", "ByteLevel"]
            and split.get("behavior") == "Removed" and split.get("invert") is True
            and split.get("pattern", {}).get("Regex") == SPLIT
            and file["model"].get("type") == "BPE" and not file["model"].get("continuing_subword_prefix")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or t["content"].split() != [t["content"]]
                        for t in file.get("added_tokens", [])))


class WordTokens:
    """The ids of texts by a tokenizer file, special tokens spelled in a text
    included, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    Where its pieces never cross ASCII white space and that is dropped (see
    ``by_words``), a text's ids are the ids of its words one after the other. Each
    distinct word is then encoded once, and the ids of a text are gathered. Most
    words are Latin letters with punctuation behind. Their two parts are put to
    the vocabulary's merges straight away, the letters once for all spellings and
    all punctuation behind them; any other word goes through the whole tokenizer.
    With any other file whole texts are encoded."""

    _kept: dict[str, "WordTokens"] = {}

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        file = json.loads(self.tokenizer.to_str())
        self.by_words = by_words(file)
        self.special = [t["content"].lower().encode() for t in file.get("added_tokens", [])]
        self.merges = self.tokenizer.model
        self.letters = _byte_letters()
        self.number, self.words = _numbers(), _Ids()
        self.part, self.parts = _numbers(), _Ids()

    @classmethod
    def of(cls, vocabulary: str) -> "WordTokens":
        if vocabulary not in cls._kept:
            cls._kept[vocabulary] = cls(vocabulary)
        return cls._kept[vocabulary]

    def _forget(self) -> None:
        self.number = _numbers(list(islice(self.number, REMEMBERED // 2)))
        self.words.first = self.words.first[:len(self.number) + 1]

    def _two_parts(self, word: bytes) -> tuple[bytes | str, bytes]:
        """A word's letters in lower case and the punctuation behind, or the word
        as text if it is no such word."""
        head = word.rstrip(PUNCTUATION)
        if not head or head.isalpha():
            return head.lower(), word[len(head):]
        if not head.isascii():
            text = head.decode("utf-8", "replace")
            if text.isalpha() and max(text) < LATIN_END and DOTTED not in text:
                return text.lower().encode(), word[len(head):]
        return word.decode("utf-8", "replace"), b""

    def _learn_parts(self) -> None:
        found, length = array("I"), array("q")
        for part in _last(self.part, len(self.parts)):
            before = len(found)
            if isinstance(part, str):
                found.extend(self.tokenizer.encode(part, add_special_tokens=False).ids)
            elif part:
                letters = part.decode("ascii") if part.isascii() else "".join(map(self.letters.__getitem__, part))
                found.extend(map(_ID, self.merges.tokenize(letters)))
            length.append(len(found) - before)
        self.parts.add(np.frombuffer(found, np.uint32), np.frombuffer(length, np.int64))

    def _learn(self) -> None:
        """Adds the ids of the words numbered since the last time."""
        if len(self.part) > REMEMBERED:
            self.part, self.parts = _numbers(), _Ids()
        # numbers alone are kept: many small lists would be looked through by the garbage collector
        n = array("q")
        for word in _last(self.number, len(self.words)):
            head, tail = self._two_parts(word)
            n.append(self.part[head])
            n.append(self.part[tail])
        self._learn_parts()
        flat, stop = self.parts.of(np.frombuffer(n, np.int64))
        self.words.add(flat, np.diff(stop[1::2], prepend=0))

    def _lower(self, texts: list[bytes]) -> list[bytes]:
        """The texts with a-z for A-Z, as spellings of a word are then one word.
        Ids stay the same without combining marks (which NFC may join to a-z but
        not to A-Z) and without special tokens, which differ by case."""
        plain = np.frombuffer(b"\0" + b"\0".join(texts), np.uint8)
        first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        plain = np.maximum.reduceat(plain, first) <= LATIN_LEAD if texts else []
        low = [t.lower() if p else t for t, p in zip(texts, plain)]
        return [t if any(x in y for x in self.special) else y for t, y in zip(texts, low)]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and ids per text."""
        if not self.by_words:
            each = [e.ids for e in self.tokenizer.encode_batch([t.decode("utf-8", "replace") for t in texts],
                                                               add_special_tokens=False)]
            n = np.fromiter(map(len, each), np.int64, len(each))
            ids = np.fromiter(chain.from_iterable(each), np.uint32, int(n.sum()))
            return (ids if len(ids) and ids.max() >= 1 << 16 else ids.astype(np.uint16)), n
        if len(self.number) > REMEMBERED:
            self._forget()
        words: list[bytes] = []
        many = np.zeros(len(texts), np.int64)
        for i, t in enumerate(self._lower(texts)):
            w = t.split()
            words += w
            many[i] = len(w)
        n = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        if len(self.number) > len(self.words):
            self._learn()
        ids, stop = self.words.of(n)
        upto = np.concatenate(([0], stop))
        return ids, np.diff(upto[np.concatenate(([0], np.cumsum(many)))])
