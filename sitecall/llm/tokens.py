"""Token ids of whole documents by a public tokenizer file, encoding each distinct word once per worker.

The tokenizer splits at white space before anything else, so a document's ids are those of its words one
after the other. Words are cut at the six ASCII white space bytes; each task maps its words to a table
that its Python worker keeps between tasks (at most ``MAX_WORDS`` words, then it starts afresh).
"""

from __future__ import annotations

import collections
import functools
import os

import numpy as np
import regex

from sitecall.llm.common import LOWER_AZ, SEPARATOR, word_spans

MAX_WORDS = 400_000
_JOIN = 500


def tokenizer_path(file: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(file)


#: How this tokenizer file cuts a normalised text into the units that it merges.
_UNIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_WORD_END = "</w>"


class WordIds:
    """Word -> ids, filled as words come."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(_WORD_END)]] = True
        self.clear()

    def clear(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 16, np.int64)  # where the ids of row i begin; row i + 1 begins where they end
        self.used = 0

    def _append(self, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, m = len(self.rows), len(words)
        while len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.at) < n + m + 1:
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.at[n + 1 : n + m + 1] = self.used + np.cumsum(lengths)
        self.used += len(ids)
        for i, w in enumerate(words, n):
            self.rows[w] = i

    def _encode(self, words: list[bytes]) -> None:
        """Encode new words, several in one string; an odd count of units falls back to word by word."""
        for a in range(0, len(words), _JOIN * 64):
            part = words[a : a + _JOIN * 64]
            texts = [w.decode("utf-8", "replace") for w in part]
            units = [1 if t.isascii() and t.isalpha() else self._units(t) for t in texts]
            blocks = [slice(b, b + _JOIN) for b in range(0, len(part), _JOIN)]
            encoded = self.tokenizer.encode_batch_fast([" ".join(texts[s]) for s in blocks], add_special_tokens=False)
            for s, e in zip(blocks, encoded):
                ids = np.array(e.ids, np.uint32)
                count = np.array(units[s], np.int64)
                ends = np.flatnonzero(self.ends[ids]) + 1
                if count.min() > 0 and len(ends) == count.sum():
                    lengths = np.diff(np.concatenate([[0], ends[np.cumsum(count) - 1]]))
                else:
                    singles = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts[s], add_special_tokens=False)]
                    ids = np.concatenate(singles) if singles else ids
                    lengths = np.array([len(x) for x in singles], np.int64)
                self._append(part[s], ids, lengths)

    @staticmethod
    def _units(text: str) -> int:
        if "<|" in text:
            return 0  # may hold a special token: encoded on its own
        import unicodedata

        return len(_UNIT.findall(unicodedata.normalize("NFC", text).lower()))

    @staticmethod
    def _cut(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same units in fewer distinct words: ASCII lower case, a last full stop or comma after a letter on its own, rows parted."""
        if b"<|" not in data.tobytes():  # special tokens are told by case
            data = LOWER_AZ[data]
        n = len(data)
        blank = np.concatenate([SEPARATOR[data], [True]])
        blank_after = blank[1:].copy()
        blank_after[off[1:][off[1:] > off[:-1]] - 1] = True
        letter = (data >= 97) & (data <= 122) | (data >= 65) & (data <= 90)
        mark = ((data == 46) | (data == 44)) & blank_after
        mark[1:] &= letter[:-1]
        mark[off[:-1][off[:-1] < n]] = False
        at = np.flatnonzero(mark)
        out = np.insert(data, np.concatenate([off[1:], at]), 32)
        return out, off + np.arange(len(off)) + np.searchsorted(at, off)

    def encode_rows(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, offsets per row) without special tokens."""
        data, off = self._cut(data, off)
        _, _, woff = word_spans(data, off)
        words = data.tobytes().split()
        local: dict = collections.defaultdict()
        local.default_factory = local.__len__
        index = np.fromiter(map(local.__getitem__, words), np.int64, len(words))
        distinct = list(local)
        if len(self.rows) + len(distinct) > MAX_WORDS:
            self.clear()
        have = self.rows
        new = [w for w in distinct if w not in have]
        if new:
            self._encode(new)
        row = np.fromiter(map(have.__getitem__, distinct), np.int64, len(distinct))[index] if words else index
        begin, size = self.at[row], self.at[row + 1] - self.at[row]
        total = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(total[-1]) - np.repeat(total[:-1] - begin, size)
        return self.flat[place], total[woff]


@functools.cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
