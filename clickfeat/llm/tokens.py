"""Token ids of whole texts, many texts at a time.

The vocabulary's rules lower-case a text, cut it into pieces (letters, single digits, punctuation)
and encode each piece alone, so a text's ids are those of its pieces in order. Texts of common
characters are cut here; each distinct piece is encoded once, in bulk, and looked up by number after
that. Words with other characters go through the whole tokenizer, once each.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

#: Distinct pieces after which a task starts its table anew, so that memory is bounded.
TABLE_PIECES = 700_000
#: Pieces given to the model at once.
BULK = 10_000
#: Before a word for the whole tokenizer; no piece begins with it.
_WHOLE = "\0"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Numbers(dict):
    """Numbers keys from 0 as they are first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number


class WordEncoder:
    """Ids of texts under a vocabulary file that treats words apart."""

    #: White space, ASCII, and letters that lower-case to one letter and are stable under NFC.
    _plain = re.compile(r"[\x20-\x7E\t\n\r\x0b\x0cÀ-ÖØ-öø-ÿ]*")
    #: The vocabulary's own cutting rule on those characters in lower case.
    _pieces = re.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\x20\t\n\r\x0b\x0c]+"
    )
    #: White space to Python only; the vocabulary's rules keep it.
    _separators = re.compile("[\x1c-\x1f]")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.model = Tokenizer(self.whole.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        # Ids that end a piece tell where the next one starts.
        size = self.whole.get_vocab_size()
        self.ends = np.zeros(size, bool)
        for token, number in self.whole.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _pieces_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in order, and how many each has."""
        found = []
        for at in range(0, len(pieces), BULK):
            text = " ".join(pieces[at : at + BULK])
            found.append(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        ids = np.fromiter(chain.from_iterable(found), np.uint32)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(pieces):  # a piece without an end mark: encode them one by one
            return _joined(self.model.encode_batch_fast(pieces, add_special_tokens=False))
        return ids, np.diff(last, prepend=-1)

    def _learn(self, keys: list[str]) -> None:
        """Append the ids of new keys, in the order of their numbers, to the table."""
        whole = np.fromiter((k[0] == _WHOLE for k in keys), bool, len(keys))
        ids, lengths = self._pieces_ids([k for k in keys if k[0] != _WHOLE])
        words = [k[1:] for k in keys if k[0] == _WHOLE]
        more, more_lengths = _joined(self.whole.encode_batch_fast(words, add_special_tokens=False))
        # Pieces first, then words; numbers say which is where.
        both = np.concatenate([lengths, more_lengths]).astype(np.int64)
        place = np.argsort(whole, kind="stable")
        new_lengths, new_starts = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        new_lengths[place] = both
        new_starts[place] = len(self.flat) + np.cumsum(both) - both
        self.lengths = np.concatenate([self.lengths, new_lengths])
        self.starts = np.concatenate([self.starts, new_starts])
        self.flat = np.concatenate([self.flat, ids, more])

    def _keys(self, text: str) -> list[str]:
        if self._plain.fullmatch(text):
            return self._pieces.findall(text.lower())
        keys: list[str] = []
        for word in text.split():
            if self._plain.fullmatch(word):
                keys += self._pieces.findall(word.lower())
            else:
                keys.append(_WHOLE + word)
        return keys

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and the number of ids of each. Null text has none."""
        if len(self.numbers) > TABLE_PIECES:
            self._clear()
        texts = [t or "" for t in texts]
        # The tokenizer looks for its special tokens before it splits: such texts go there whole.
        special = {
            i: t
            for i, t in enumerate(texts)
            if any(map(t.__contains__, self.added)) or self._separators.search(t)
        }
        if special:
            each = {i: self.whole.encode(t, add_special_tokens=False).ids for i, t in special.items()}
            plain_ids, plain_lengths = self.encode(["" if i in each else t for i, t in enumerate(texts)])
            parts = np.split(plain_ids, np.cumsum(plain_lengths)[:-1])
            parts = [np.array(each.get(i, p), np.uint32) for i, p in enumerate(parts)]
            return np.concatenate(parts), np.array([*map(len, parts)], np.int64)
        keys = [self._keys(t) for t in texts]
        per_text = np.fromiter(map(len, keys), np.int64, len(keys))
        at = np.fromiter(
            map(self.numbers.__getitem__, chain.from_iterable(keys)), np.int64, int(per_text.sum())
        )
        if self.numbers.new:
            self._learn(self.numbers.new)
            self.numbers.new = []
        lengths = self.lengths[at]
        totals = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(per_text)
        return self.flat[_ranges(self.starts[at], lengths)], totals[ends] - totals[ends - per_text]


def _joined(encodings: list) -> tuple[np.ndarray, np.ndarray]:
    each = [e.ids for e in encodings]
    lengths = np.fromiter(map(len, each), np.int64, len(each))
    return np.fromiter(chain.from_iterable(each), np.uint32), lengths


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def in_chunks(texts: list[str | None], characters: int = 4_000_000):
    """Index ranges of consecutive texts of about so many characters, at least one text each."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= characters:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
