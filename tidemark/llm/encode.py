"""Token ids of whole texts, by the ``tokenizers`` library, each distinct word of a slice once.

Both kinds of vocabulary cut a text before a space that follows a non-space, around a lone line
break, and between letters and other signs, so a word can be encoded alone and its ids put wherever
it stands. Texts and pieces for which that need not hold go through the tokenizer whole.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

BATCH = 1024
GATHER = 1 << 20
PART = 1 << 14
#: Pieces between marks: letters below U+0100 with a leading space, if any, then ASCII punctuation; or else.
PIECE = re.compile("(?:( ?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+)([!-/:-@\\[-`{-~]*)|([^\\0]*))(?:\\0|\\Z)")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet, as the library itself maps single characters."""
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    found = {b: level.pre_tokenize_str(chr(b))[0][0] for b in range(1, 128)}
    for b in range(128, 192):  # as second byte of a letter U+0080..U+00BF
        found[b] = level.pre_tokenize_str(chr(b))[0][0][1]
    for b in range(0xC2, 0xE0):  # as first byte
        found[b] = level.pre_tokenize_str(bytes([b, 0x80]).decode())[0][0][0]
    return found


class Encoder:
    """``lead``: byte-level vocabularies, where the space before a word belongs to it and case matters;
    otherwise white space is dropped and letters are lowered, as in the word vocabularies.
    Special strings in a text are ordinary text.
    """

    def __init__(self, path: str, lead: bool):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.lead = lead
        self.model = self.tokenizer.model
        self.letters = _byte_letters()

    def whole(self, texts: list[str]) -> list[list[int]]:
        found: list[list[int]] = []
        for i in range(0, len(texts), BATCH):
            found += [e.ids for e in self.tokenizer.encode_batch_fast(texts[i : i + BATCH], add_special_tokens=False)]
        return found

    def _alone(self, piece: str) -> bool:
        """Whether a piece that isn't a plain word has the same ids alone as in its text."""
        if not self.lead or piece == "\n":
            return True
        word = piece.removeprefix(" ")
        return bool(word) and not word[0].isspace() and not word[-1].isspace()

    def _units(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words, ends and other pieces; how many each has; which two make up each piece; pieces that can't stand alone.

        Pieces go through Python objects in parts, so that few of these live at once.
        """
        words: dict[str, int] = {}
        others: dict[str, int] = {"": 0}
        first, second = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        bad = np.zeros(len(pieces), bool)
        for a in range(0, len(pieces), PART):
            own = pieces.slice(a, PART)
            b = a + len(own)
            joined = pc.binary_join(pa.ListArray.from_arrays([0, len(own)], own), "\0")[0].as_py()
            found = PIECE.findall(joined)[: len(own)]
            if self.lead:
                first[a:b] = [words.setdefault(w, len(words)) if w else -1 for w, _, _ in found]
            else:
                first[a:b] = [words.setdefault(w.lower(), len(words)) if w else -1 for w, _, _ in found]
            second[a:b] = [others.setdefault(end or rest, len(others)) for _, end, rest in found]
            plain = np.flatnonzero(first[a:b] < 0)
            bad[a + plain] = [not self._alone(found[i][2]) for i in plain]
        stores, sizes = [], []

        def add(units: list[list[int]]) -> None:
            sizes.append(np.array([*map(len, units)], np.int64))
            stores.append(np.fromiter(chain.from_iterable(units), "<u4"))

        tokenize = self.model.tokenize
        names = list(words)
        for a in range(0, len(names), PART):
            signs = "\0".join(names[a : a + PART]).encode().decode("latin-1").translate(self.letters).split("\0")
            add([[t.id for t in tokenize(sign)] for sign in signs])
        add([[]])
        names = list(others)[1:]
        for a in range(0, len(names), PART):
            add(self.whole(names[a : a + PART]))
        pair = np.stack([first, second + len(words)], axis=1)
        pair[pair[:, 0] < 0, 0] = len(words)
        return np.concatenate(stores), np.concatenate(sizes), pair.reshape(-1), bad

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids start and end. Null: empty."""
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        if self.lead:
            marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
        else:
            marked = pc.replace_substring(pc.replace_substring(texts, "\n", " "), " ", "\0")
        split = pc.split_pattern(marked, "\0")
        words = split.flatten().dictionary_encode()
        index = words.indices.to_numpy()
        store, sizes, pair, bad = self._units(words.dictionary)
        store, sizes = _gather(store, sizes, pair)
        del marked, words
        flat, sizes = _gather(store, sizes.reshape(-1, 2).sum(axis=1), index)
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(), dtype=np.int64)])
        ends = np.concatenate([[0], np.cumsum(sizes)])[starts]
        whole = pc.match_substring(texts, "\0").to_numpy(zero_copy_only=False)
        whole = whole | (np.add.reduceat(bad[index], starts[:-1], dtype=np.int64) > 0)
        if not whole.any():
            return flat, ends
        redone = iter(self.whole(texts.filter(pa.array(whole)).to_pylist()))
        parts = [np.array(next(redone), "<u4") if w else flat[a:b] for w, a, b in zip(whole, ends, ends[1:])]
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])


def _gather(store: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of units ``index`` one after the other, and how many each has."""
    sizes = size[index]
    begin = np.cumsum(size) - size
    out = np.empty(int(sizes.sum()), "<u4")
    done = 0
    for i in range(0, len(index), GATHER):
        part = sizes[i : i + GATHER]
        ends = np.cumsum(part)
        n = int(ends[-1])
        out[done : done + n] = store[np.repeat(begin[index[i : i + GATHER]] - (ends - part), part) + np.arange(n)]
        done += n
    return out, sizes


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, lead: bool) -> Encoder:
    """One encoder for each worker process, kept from task to task."""
    if (path, lead) not in _encoders:
        _encoders[path, lead] = Encoder(path, lead)
    return _encoders[path, lead]
