"""Texts as numbers of their distinct parts, a batch at a time.

Words repeat a lot. Arrow cuts a batch of texts into parts and numbers the distinct ones, so that
Python sees each part of a batch once, and what a part stands for is gathered by whole arrays.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words that composing, folding and cutting leave as they are, in any edition of the character tables.
PLAIN_WORD = re.compile("[a-zß-öø-ÿ]+").fullmatch

BATCH_BYTES = 4 << 20  # of text whose parts are numbered together
REMEMBERED = 400_000  # parts a task's table keeps


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is printable, else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


BYTE_CHARACTERS = _byte_characters()
_SPELLING = dict(enumerate(BYTE_CHARACTERS))


def spelled(word: str) -> str:
    """A word as vocabularies of bytes spell it, a character a byte."""
    return word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(_SPELLING)


def slices(texts: pa.Array):
    """(first row, rows of about ``BATCH_BYTES``) of a column; nulls are empty, a longer text is a slice of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + BATCH_BYTES, "right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def numbered(flat: pa.Array, bounds: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct parts, the number of each part in them, bounds of each text's parts)."""
    coded = flat.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), bounds - bounds[0]


def folded_parts(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``numbered`` parts between runs of blank, tab and line ends; some may be empty.

    For vocabularies that drop white space, fold case and keep letters and marks apart: parts also end
    between an ASCII letter and a mark, and those of ASCII alone are in lower case, which leaves fewer
    different ones. Others are left as they are, as letters with marks are composed before they are
    folded, and so is what may hold a special token, as these are found before all else.
    """
    lists = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, "([A-Za-z])([.,;:!?])", r"\1 \2"))
    flat = lists.flatten()
    plain = pc.and_(pc.string_is_ascii(flat), pc.invert(pc.match_substring(flat, "<|")))
    return numbered(pc.if_else(plain, pc.ascii_lower(flat), flat), lists.offsets.to_numpy())


class PartTable:
    """What distinct parts stand for: some numbers each, all in one pool.

    ``learn`` gives the numbers of new parts and how many each has. When the table would pass ``limit``
    parts, those that the fewest batches had are forgotten, at least half of them, so that its memory is
    bounded by the limit or by the parts of one batch.
    """

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], dtype, limit: int = REMEMBERED):
        self.learn, self.limit = learn, limit
        self.places: dict[str, int] = {}
        self.names: list[str] = []
        self.sizes, self.hits, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, dtype)
        self.starts = self.sizes

    def _set(self, sizes: np.ndarray, pool: np.ndarray) -> None:
        self.sizes, self.starts, self.pool = sizes, np.cumsum(sizes) - sizes, pool.astype(self.pool.dtype, copy=False)

    def _forget(self) -> None:
        most = np.sort(self.hits)[::-1][min(len(self.hits), self.limit) // 2 : ][:1]
        kept = np.flatnonzero(self.hits > (most[0] if len(most) else 0))
        pool, _ = self._numbers(kept)
        self._set(self.sizes[kept], pool)
        self.names = [self.names[i] for i in kept.tolist()]
        self.places = dict(zip(self.names, range(len(kept))))
        self.hits = self.hits[kept] // 2

    def _look_up(self, parts: list[str]) -> np.ndarray:
        known = self.places.get
        return np.fromiter((known(p, -1) for p in parts), np.int64, len(parts))

    def _places(self, parts: list[str]) -> np.ndarray:
        found = self._look_up(parts)
        if len(self.names) + np.count_nonzero(found < 0) > self.limit:
            self._forget()
            found = self._look_up(parts)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [parts[i] for i in missing.tolist()]
            found[missing] = len(self.names) + np.arange(len(new))
            self.places.update(zip(new, found[missing].tolist()))
            self.names += new
            pool, sizes = self.learn(new)
            self._set(np.concatenate([self.sizes, sizes]), np.concatenate([self.pool, pool]))
            self.hits = np.concatenate([self.hits, np.zeros(len(new), np.int64)])
        self.hits[found] += 1
        return found

    def _numbers(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[places]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.pool[np.repeat(self.starts[places] - ends + sizes, sizes) + np.arange(total)], ends

    def gather(self, parts: list[str], index: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all parts in order, and the bounds of each text's."""
        out, ends = self._numbers(self._places(parts)[index])
        return out, np.concatenate([np.zeros(1, np.int64), ends])[bounds]
