"""Token ids of whole texts, with every distinct stretch between white space encoded once.

The public tokenizers split at white space before their merges, so a text's
ids are those of its stretches in order. A stretch is a run of other
characters with one space before it, or white space as the byte-level
pattern splits it. Texts in which that could differ are encoded whole: those
with a special token's text or with the separators \\x1c-\\x1f, on which the
libraries' ideas of white space differ.
"""

from __future__ import annotations

import os
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Stretches that one worker remembers, the first it meets; later ones are encoded once a batch.
CACHE = 1_000_000
_STRETCH = re.compile(r" ?\S+|\s+(?!\S)|\s+")
_UNSURE = re.compile("[\x1c-\x1f]")
#: Between the stretches of a text that is sure, which does not hold it.
_CUT = "\x1f"
_TWO_SPACES = re.compile(r"\s\s")


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # a byte-level vocabulary keeps white space; one with word ends drops it
        self.spaces = bool(self.tokenizer.encode(" a b", add_special_tokens=False).ids
                           != self.tokenizer.encode("a b", add_special_tokens=False).ids)
        self.size = self.tokenizer.get_vocab_size()
        # number of every remembered stretch, and the ids of all of them with their starts
        self.known: dict[str, int] = {}
        self.ids, self.starts = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _marked(self, text: str) -> str:
        """A sure text with _CUT between its stretches, or between some of them."""
        if not self.spaces:
            # a stretch that still holds other white space is split by the tokenizer
            return text.replace(" ", _CUT).replace("\n", _CUT)
        if _TWO_SPACES.search(text):
            return _CUT.join(_STRETCH.findall(text))
        # single white space: a space goes with what follows, a line break stands alone
        return text.replace(" ", f"{_CUT} ").replace("\n", f"{_CUT}\n{_CUT}")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        whole = [False] * len(texts)
        if _UNSURE.search("".join(texts)) or any(s in t for s in self.special for t in texts):
            whole = [bool(_UNSURE.search(t)) or any(s in t for s in self.special) for t in texts]
        marked = pa.array(["" if w else self._marked(t) for t, w in zip(texts, whole, strict=True)], pa.large_string())
        parts = pc.split_pattern(marked, _CUT)
        flat = parts.flatten().dictionary_encode()
        # all ids of the batch: those of its distinct stretches, taken stretch by stretch
        ids, size = self._of(flat.dictionary.to_pylist())
        begin = np.cumsum(size) - size
        which = flat.indices.to_numpy()
        length = size[which]
        all_ids = ids[_places(begin[which], length)]
        stretches = np.append(0, np.cumsum(pc.list_value_length(parts).to_numpy()))
        cut = np.append(0, np.cumsum(length))[stretches].tolist()
        return [self._whole(t) if w else all_ids[a:b] for t, w, a, b in zip(texts, whole, cut, cut[1:], strict=False)]

    def _of(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct stretches, one after the other, and how many each has."""
        number = np.fromiter(map(self.known.get, stretches, repeat(-1)), np.int64, len(stretches))
        is_new = number < 0
        new = [stretches[i] for i in np.flatnonzero(is_new).tolist()]
        found = [e.ids for at in range(0, len(new), 4096)
                 for e in self.tokenizer.encode_batch_fast(new[at:at + 4096], add_special_tokens=False)]
        new_size = np.fromiter(map(len, found), np.int64, len(found))
        new_ids = np.fromiter(chain.from_iterable(found), np.uint32, int(new_size.sum()))
        old = number[~is_new]
        size = np.empty(len(stretches), np.int64)
        size[is_new], size[~is_new] = new_size, self.starts[old + 1] - self.starts[old]
        ids = np.empty(int(size.sum()), np.uint32)
        begin = np.cumsum(size) - size
        ids[_places(begin[is_new], new_size)] = new_ids
        ids[_places(begin[~is_new], size[~is_new])] = self.ids[_places(self.starts[old], size[~is_new])]
        self._remember(new, new_ids, new_size)
        return ids, size

    def _remember(self, new: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        n = len(self.known)
        new = new[:max(0, CACHE - n)]
        ends = self.starts[n] + np.cumsum(size[:len(new)])
        last = int(ends[-1]) if len(new) else int(self.starts[n])
        self.starts, self.ids = _room(self.starts, n + len(new) + 1), _room(self.ids, last)
        self.ids[self.starts[n]:last] = ids[:last - int(self.starts[n])]
        self.starts[n + 1:n + 1 + len(new)] = ends
        self.known.update(zip(new, range(n, n + len(new)), strict=True))


def _places(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of ranges, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _room(held: np.ndarray, n: int) -> np.ndarray:
    """The array with room for n values, and as many again where it grows."""
    return held if n <= len(held) else np.append(held, np.zeros(2 * n - len(held), held.dtype))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
