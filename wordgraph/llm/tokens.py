"""Token ids of texts from their distinct words.

The tokenizer here drops white space and never joins characters across it, so
a text's ids are the ids of its words, one after another. Words are cut at
ASCII white space only; what else the tokenizer takes for white space stays
inside a word and is left to it.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np

from wordgraph.llm.common import ragged


def public_tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    """The tokenizer of a file, without truncation and padding, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encode_words(tokenizer, words: list[bytes]) -> list[list[int]]:
    texts = [w.decode("utf-8") for w in words]
    return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_LETTER = rb"(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])"
#: Letters of Latin-1 and, in ASCII, marks that end a run of letters for the tokenizer in any case.
_LETTERS_THEN_MARKS = re.compile(rb"(" + _LETTER + rb"+)([.,;:!?#*$%&()][\x00-\x7F]*)?")
_LINE_MARKS = re.compile(rb"(?m)^([a-z]+)([^a-z\n])")
_LETTERS = re.compile(_LETTER + rb"+")


def word_parts(word: bytes) -> list[bytes]:
    """A word as what the tokenizer cuts it into anyway: letters, then marks; in lower case.

    Fewer distinct words are left this way. Words with a special token, which
    the tokenizer looks for in the text as it is, are left alone, and so are
    words with characters beyond Latin-1's letters, where bytes do not tell a
    letter from a symbol or mark, or what composes with the one before.
    """
    if b"<|" in word:
        return [word]
    found = _LETTERS_THEN_MARKS.fullmatch(word)
    if found:
        return [x for x in (_lower(found[1]), found[2] and found[2].lower()) if x]
    return [word.lower() if word.isascii() else word]


def many_parts(words: list[bytes]) -> tuple[list[bytes], list[bytes], np.ndarray]:
    """``word_parts`` of many words: the words in another order, their parts one after another, and each word's number
    of parts."""
    letters = [w for w in words if w.isalpha()]
    others = [w for w in words if not w.isalpha()]
    found = list(map(_LETTERS_THEN_MARKS.fullmatch, others))
    plain = [w for w, m in zip(others, found) if m and m[2] and w.isascii() and b"<|" not in w]
    rest = [w for w, m in zip(others, found) if not (m and m[2] and w.isascii() and b"<|" not in w)]
    flat = b"\n".join(letters).lower().split(b"\n") if letters else []
    # Words hold no line feed: one pass over all of them cuts each at its first mark.
    flat += _LINE_MARKS.sub(rb"\1\n\2", b"\n".join(plain).lower()).split(b"\n") if plain else []
    split = [word_parts(w) if w else [] for w in rest]
    flat += [x for parts in split for x in parts]
    per = np.concatenate([np.ones(len(letters), np.int64), np.full(len(plain), 2), np.fromiter(map(len, split), np.int64, len(split))])
    return letters + plain + rest, flat, per


def _lower(letters: bytes) -> bytes:
    return letters.lower() if letters.isascii() else letters.decode("utf-8").lower().encode("utf-8")


class PartIds:
    """Ids of what ``word_parts`` gives.

    Letters alone need no normalizing and no cutting, only the tokenizer's
    model, so many of them are encoded as one text. Which ids are whose tell
    the pieces that end a word.
    """

    TEXT_PARTS = 500

    def __init__(self, path: str):
        from tokenizers import normalizers, pre_tokenizers

        self.tokenizer, self.model = load(path), load(path)
        self.model.normalizer = normalizers.Sequence([])
        self.model.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True

    def __call__(self, parts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The parts in another order, the number of ids of each, and the ids."""
        letters = [x for x in parts if _LETTERS.fullmatch(x)]
        others = [x for x in parts if not _LETTERS.fullmatch(x)]
        texts = [b" ".join(letters[i:i + self.TEXT_PARTS]) for i in range(0, len(letters), self.TEXT_PARTS)]
        flat = np.concatenate([np.zeros(0, np.uint32), *(np.array(x, np.uint32) for x in encode_words(self.model, texts))])
        lengths = np.diff(np.flatnonzero(self.last[flat]) + 1, prepend=0)
        if len(lengths) != len(letters):  # a tokenizer whose pieces do not tell
            letters, others, lengths, flat = [], parts, lengths[:0], flat[:0]
        ids = encode_words(self.tokenizer, others)
        return (letters + others, np.concatenate([lengths, np.array([len(x) for x in ids], np.int64)]),
                np.concatenate([flat, *(np.array(x, np.uint32) for x in ids)]))


class _Lists:
    """Lists of ids by number, in one array."""

    def __init__(self):
        self.lengths, self.flat = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]

    def add(self, lengths: np.ndarray, flat: np.ndarray) -> None:
        self.lengths.append(lengths)
        self.flat.append(flat)
        self.starts = None

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths of the lists with the numbers ``at``, and their ids one after another."""
        if len(self.lengths) > 1:
            self.lengths, self.flat = [np.concatenate(self.lengths)], [np.concatenate(self.flat)]
            self.starts = np.cumsum(self.lengths[0]) - self.lengths[0]
        lengths = self.lengths[0][at]
        return lengths, self.flat[0][ragged(self.starts[at], lengths)] if len(at) else self.flat[0][:0]


class WordIds:
    """Ids of texts, encoding a word once while it is held; about ``limit`` words are held."""

    def __init__(self, path: str, limit: int = 1_000_000):
        self.encode, self.limit = PartIds(path), limit
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.parts: dict[bytes, int] = {}
        self.word_lists, self.part_lists = _Lists(), _Lists()

    def texts(self, column):
        """The ids of each text of an Arrow string column, one after another; none where null."""
        import pyarrow.compute as pc

        # Split at ASCII white space; before and after it at a text's ends are empty words, which have no ids.
        split = pc.ascii_split_whitespace(column.fill_null(""))
        words = split.flatten().dictionary_encode()
        at = self._places(words.dictionary.cast("binary").to_pylist())[words.indices.to_numpy()]
        ends = np.cumsum(split.value_lengths().to_numpy())
        for first, last in zip([0, *ends[:-1].tolist()], ends.tolist()):
            yield self.word_lists.take(at[first:last])[1]

    def _places(self, words: list[bytes]) -> np.ndarray:
        """The numbers of distinct words, which are held from here on."""
        fresh = [w for w in words if w not in self.index]
        if len(self.index) + len(fresh) > self.limit and self.index:
            self._clear()
            fresh = words
        if fresh:
            self._learn(fresh)
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def _learn(self, fresh: list[bytes]) -> None:
        fresh, flat, per = many_parts(fresh)
        unknown, lengths, ids = self.encode(list(set(flat).difference(self.parts)))
        self.part_lists.add(lengths, ids)
        self.parts.update(zip(unknown, range(len(self.parts), len(self.parts) + len(unknown))))
        lengths, ids = self.part_lists.take(np.fromiter(map(self.parts.__getitem__, flat), np.int64, len(flat)))
        # Sums over each word's parts; an empty word has none.
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(per)])]
        self.word_lists.add(np.diff(ends), ids)
        self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh))))


@functools.lru_cache(maxsize=1)
def held_word_ids(path: str) -> WordIds:
    """One ``WordIds`` for all tasks that a Python worker runs, one after another: later tasks find words held."""
    return WordIds(path)
