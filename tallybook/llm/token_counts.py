"""Token counts of texts by merging byte pairs, without making the tokens.

A word starts as one symbol a byte, in a doubly linked list. A heap holds the adjacent pairs that
the vocabulary merges; the pair of the lowest rank, the leftmost of equals, is popped, its two
symbols become one, and the pairs this one makes with its neighbours are pushed. Entries whose pair
is gone by then are skipped. A word's count is its bytes minus its merges; no ids are emitted.

Counts add up over white space, so each distinct part between white space is counted once a batch,
and a bounded table remembers counts from batch to batch.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tallybook.llm.blocks import documents
from tallybook.llm.parts import BYTE_CHARACTERS, PLAIN_WORD, REMEMBERED, PartTable, folded_parts, slices, spelled

LIMIT = 2048  # tokens above which a document is marked


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _kinds(step: dict | None, key: str) -> list[dict]:
    """The steps of a sequence, or the one step."""
    if step is None:
        return []
    return step[key] if step["type"] == "Sequence" else [step]


class MergeCounter:
    """Counts by one vocabulary file; files with other steps than these are refused."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        shapes = [s["type"] for s in _kinds(spec["normalizer"], "normalizers")]
        cuts = _kinds(spec["pre_tokenizer"], "pretokenizers")
        if (
            model["type"] != "BPE" or shapes != ["NFC", "Replace", "Lowercase"]
            or [c["type"] for c in cuts] != ["Split", "ByteLevel"] or cuts[0]["behavior"] != "Removed" or not cuts[0]["invert"]
            or cuts[1]["use_regex"] or cuts[1]["add_prefix_space"]
            or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges")
            or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        ):
            raise ValueError(f"{path}: not a vocabulary of words merged from bytes")
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.inside = {c: vocabulary[c] for c in BYTE_CHARACTERS}
        self.last = {c: vocabulary[c + suffix] for c in BYTE_CHARACTERS}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.width = max(vocabulary.values()) + 1
        self.ranks = {vocabulary[a] * self.width + vocabulary[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocabulary[a + b] for a, b in pairs]
        self.words = regex.compile(cuts[0]["pattern"]["Regex"])
        # The library's own steps up to the merges, as its tables of characters are of another edition than Python's.
        library = Tokenizer.from_file(path)
        self.normalised, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known = PartTable(self._learn, np.int64)
        self.new_words: dict[str, int] = {}
        self.old_words: dict[str, int] = {}

    def merges(self, symbols: list[int]) -> int:
        """How many merges a word's symbols go through; the list is used up."""
        rank_of, merged, width, size = self.ranks.get, self.merged, self.width, len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        found = [rank_of(a * width + b, -1) for a, b in zip(symbols, symbols[1:])]
        heap = [rank * size + i for i, rank in enumerate(found) if rank >= 0]
        heapify(heap)
        done = 0
        while heap:
            rank, i = divmod(heappop(heap), size)
            j = after[i]
            # A merged-away symbol is negative, so that its pairs have no rank.
            if j == size or rank_of(symbols[i] * width + symbols[j]) != rank:
                continue
            new, done = merged[rank], done + 1
            symbols[i], symbols[j] = new, -1
            after[i] = k = after[j]
            if k < size:
                before[k] = i
                rank = rank_of(new * width + symbols[k])
                if rank is not None:
                    heappush(heap, rank * size + i)
            h = before[i]
            if h >= 0:
                rank = rank_of(symbols[h] * width + new)
                if rank is not None:
                    heappush(heap, rank * size + h)
        return done

    def word(self, word: str) -> int:
        """Tokens of a word, given as a character a byte; a printable ASCII character stands for itself."""
        found = self.new_words.get(word)
        if found is not None:
            return found
        found = self.old_words.get(word)
        if found is None:
            symbols = list(map(self.inside.__getitem__, word))
            symbols[-1] = self.last[word[-1]]
            found = len(word) - self.merges(symbols)
        if len(word) <= 64:
            if len(self.new_words) >= REMEMBERED:
                # Words not met since the last time are forgotten.
                self.old_words, self.new_words = self.new_words, {}
            self.new_words[word] = found
        return found

    def _plain(self, part: str) -> int:
        """Tokens of a part without special strings: normalised, then cut into words."""
        if PLAIN_WORD(part):
            return self.word(spelled(part))
        if part.isascii() and part.isprintable():
            return sum(map(self.word, self.words.findall(part.lower())))
        return sum(self.word(word) for word, _ in self.cut(self.normalised(part)))

    def part(self, part: str) -> int:
        """Tokens of a text; strings of special tokens are one each, as the library's default has it."""
        if self.special is None or "<" not in part:
            return self._plain(part)
        pieces = self.special.split(part)
        return len(pieces) - 1 + sum(map(self._plain, pieces))

    def _learn(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return np.fromiter(map(self.part, parts), np.int64, len(parts)), np.ones(len(parts), np.int64)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text of a slice."""
        each, bounds = self.known.gather(*folded_parts(texts))
        return np.diff(np.append(0, np.cumsum(each))[bounds])


_counters: dict[str, MergeCounter] = {}


def counter_for(path: str) -> MergeCounter:
    """The counter of a task process, with what it remembers from earlier tasks."""
    if path not in _counters:
        _counters[path] = MergeCounter(path)
    return _counters[path]


def token_counts(
    docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens) for every row.

    Null, empty and blank texts have no tokens. Rows that repeat an id, or have none, come out each.
    Other columns are ignored; an empty table gives no rows. Texts of any length are counted whole in
    the task that reads them; a run of letters without a break takes memory in proportion to it.
    """

    def run(batches):
        counter = counter_for(vocabulary or default_vocabulary())
        for batch in batches:
            for start, texts in slices(batch.column("text")):
                tokens = counter.counts(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, len(texts)), pc.binary_length(texts).cast(pa.int64()),
                        pa.array(tokens), pa.array(tokens > limit),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    kinds = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return documents(docs, id_column, text_column).mapInArrow(run, kinds)
