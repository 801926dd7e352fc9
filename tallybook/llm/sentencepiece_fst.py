"""SentencePiece encoding and decoding with a weighted transducer.

A model file is compiled into one machine: its normaliser (replaced characters, a blank before the
text, blanks squeezed and turned into the mark U+2581, each as the file says), a trie of the pieces,
and byte fallback for characters that no piece has. Composing it with an input gives a lattice of
pieces over the input's places; the encoding is its shortest path in the tropical semiring (weights
add along a path, the least path wins). Files of other kinds or settings are refused.

A vocabulary of merges, best pair first, is one that no weight per piece can state. It is stated by
the arcs instead: a path goes from one piece to the next only if the two stay apart when their own
texts are merged, and has infinite weight otherwise. One path of finite weight is left for every
input, and for every beginning of it, so that the search keeps one state a place. A model whose
scores are weights of pieces (unigram) has no such condition: there all paths compete, and weights
add up over the whole text in 32-bit numbers, as in the library, which decides between near ties.

Where pieces of merges hold the mark only in front, an input falls apart before every run of marks;
parts repeat a lot, and a bounded table remembers their encodings.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallybook.llm.blocks import documents, release
from tallybook.llm.parts import PartTable, numbered, slices

MARK = "▁"
_REMEMBERED, _PAIRS_REMEMBERED = 500_000, 1_200_000
_UNKNOWN_PENALTY = 10.0  # of a character that no piece has, above the weight of the rarest piece
_SIGNS, _CUT = ".,;:!?\"')", "\x1f"  # signs that often end a word; a character to cut at, which texts seldom have
_PARTS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _replacements(charsmap: bytes) -> dict[str, str]:
    """The replaced texts of a normaliser: a double-array trie over their bytes, then what replaces them."""
    if not charsmap:
        return {}
    size = int.from_bytes(charsmap[:4], "little")
    units = np.frombuffer(charsmap[4 : 4 + size], "<u4")
    values, labels, out = charsmap[4 + size :], np.arange(256, dtype=np.uint32), {}

    def children(place: int) -> int:
        unit = int(units[place])
        return place ^ (unit >> 10 << ((unit & 0x200) >> 6))

    found = [(b"", children(0))]
    while found:
        key, base = found.pop()
        places = base ^ labels
        inside = places < len(units)
        fits = units[np.where(inside, places, 0)] & 0x800000FF == labels
        for label in np.flatnonzero(inside & fits).tolist():
            if not label:
                continue
            below, text = children(base ^ label), key + bytes([label])
            if int(units[base ^ label]) >> 8 & 1:
                start = int(units[below]) & 0x7FFFFFFF
                out[text.decode()] = values[start : values.index(b"\0", start)].decode()
            found.append((text, below))
    return out


class Normaliser:
    """A model's way from a text to the text that pieces are found in."""

    def __init__(self, spec):
        self.blank = MARK if spec.escape_whitespaces else " "
        self.prefix = self.blank if spec.add_dummy_prefix else ""
        self.squeeze = spec.remove_extra_whitespaces
        self.replaced = _replacements(spec.precompiled_charsmap)
        self.starts = {text[:n] for text in self.replaced for n in range(1, len(text) + 1)}

    def _characters(self, text: str):
        """The text in steps: the longest that is replaced, or a character."""
        place = 0
        while place < len(text):
            found, after, end = text[place], place + 1, place + 1
            while end <= len(text) and text[place:end] in self.starts:
                if text[place:end] in self.replaced:
                    found, after = self.replaced[text[place:end]], end
                end += 1
            yield found
            place = after

    def __call__(self, text: str) -> str:
        if not text:
            return ""
        if not self.squeeze:
            changed = "".join(self._characters(text)) if self.replaced else text
            return self.prefix + changed.replace(" ", self.blank)
        out, behind_blank = [], True
        for found in self._characters(text):
            found = found.lstrip(" ") if behind_blank else found
            if found:
                out.append(found)
                behind_blank = found.endswith(" ")
        if not out:
            return ""
        return (self.prefix + "".join(out).replace(" ", self.blank)).rstrip(self.blank)


class Transducer:
    """The machine for one model file; ``merges`` stands for what the file says."""

    def __init__(self, path: str, merges: bool | None = None):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as file:
            spec = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        kinds = {p.type for p in spec.pieces}
        trained = spec.trainer_spec
        if trained.model_type not in (trained.UNIGRAM, trained.BPE):
            raise ValueError(f"{path}: neither a unigram model nor one of merges")
        if merges is None:
            merges = trained.model_type == trained.BPE
        if spec.SentencePiece.USER_DEFINED in kinds or merges and spec.SentencePiece.UNUSED in kinds:
            raise ValueError(f"{path}: user-defined pieces, or unused ones among merges, are not supported")
        if trained.treat_whitespace_as_suffix or spec.denormalizer_spec.precompiled_charsmap:
            raise ValueError(f"{path}: blanks behind words and denormalisers are not supported")
        self.normalised = Normaliser(spec.normalizer_spec)
        self.unknown_text = trained.unk_surface
        names = [model.id_to_piece(i) for i in range(len(model))]
        plain = [i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.unknown = model.unk_id()
        self.pieces = {names[i]: i for i in plain}
        self.weights = {i: -model.get_score(i) for i in plain}
        self.unknown_weight = float(np.float32(max(self.weights.values(), default=0.0)) + np.float32(_UNKNOWN_PENALTY))
        self.bytes = {int(names[i][3:5], 16): i for i in range(len(model)) if model.is_byte(i)}
        self.names = {i: names[i] for i in plain}
        self.merges = merges
        self.longest = max(map(len, self.pieces), default=1)
        # A trie, as the set of its paths: where a text is not in it, no longer piece starts so.
        self.starts = {name[:n] for name in self.pieces for n in range(1, len(name) + 1)}
        self.known: dict[str, tuple[int, ...]] = {}
        self.apart: dict[int, bool] = {}
        # Pieces that merging their own text gives; no others are ever on a path of merges.
        self.reached = {n: i for n, i in self.pieces.items() if not merges or self._merged(n) == (n,)}
        self.whole = merges and not any(MARK in name.lstrip(MARK) for name in self.pieces)

    # Whether two neighbouring pieces stay apart

    def _rank(self, text: str):
        found = self.pieces.get(text)
        return None if found is None else self.weights[found]

    def _merged(self, text: str) -> tuple[str, ...]:
        """A short text merged pair by pair, best first, from the left on ties."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self._rank(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(parts)

    def _stay_apart(self, left: int, right: int) -> bool:
        key = left << 32 | right
        found = self.apart.get(key)
        if found is None:
            if len(self.apart) > _PAIRS_REMEMBERED:
                self.apart.clear()
            a, b = self.names[left], self.names[right]
            found = self.apart[key] = self._merged(a + b) == (a, b)
        return found

    # The lattice of one part of an input, and its shortest path

    def _fallback(self, char: str) -> tuple[int, ...]:
        if not self.bytes:
            return (self.unknown,)
        return tuple(self.bytes[b] for b in char.encode("utf-8", "surrogatepass"))

    def _shortest(self, text: str) -> tuple[int, ...]:
        """Least sum of weights over the lattice of a normalised text.

        Places are settled from left to right. Between merges an arc weighs nothing or is closed, so a
        place reached at no more than the arc's start needs no look at it.
        """
        if not hasattr(self, "arcs"):
            # What a text in the trie is: a piece, or -1 for the beginning of one.
            pieces = self.reached if self.merges else self.pieces
            starts = {name[:n] for name in pieces for n in range(1, len(name) + 1)} if self.merges else self.starts
            self.arcs = {name: pieces.get(name, -1) for name in starts}
        merges, arcs, weights, apart = self.merges, self.arcs, self.weights, self.apart
        infinite, size = float("inf"), len(text)
        least = [0.0 if merges else np.float32(0)] + [infinite] * size
        last = [-1] * (size + 1)  # piece that ends here; -1 for the start and for what no piece has
        back = [0] * (size + 1)
        for place in range(size):
            cost, before, single = least[place], last[place], False
            for end in range(place + 1, min(size, place + self.longest) + 1):
                piece = arcs.get(text[place:end])
                if piece is None:
                    break
                if piece < 0:
                    continue
                if merges:
                    if least[end] <= cost:
                        continue
                    if before >= 0:
                        stay = apart.get(before << 32 | piece)
                        if not (self._stay_apart(before, piece) if stay is None else stay):
                            continue
                    least[end], last[end], back[end] = cost, piece, place
                else:
                    single |= end == place + 1
                    found = cost + weights[piece]
                    if found < least[end]:
                        least[end], last[end], back[end] = found, piece, place
            if least[place + 1] == infinite if merges else not single:
                found = cost + self.unknown_weight
                if found < least[place + 1]:
                    least[place + 1], last[place + 1], back[place + 1] = found, -1, place
        out: list[int] = []
        place = size
        while place:
            piece = last[place]
            out += [piece] if piece >= 0 else reversed(self._fallback(text[place - 1]))
            place = back[place]
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        """Ids of a text; none for an empty one."""
        marked = self.normalised(text)
        out: list[int] = []
        for part in _PARTS.findall(marked) if self.whole else [marked]:
            ids = self.known.get(part)
            if ids is None:
                if len(self.known) > _REMEMBERED:
                    self.known.clear()
                ids = self._shortest(part)
                if len(part) <= 64:
                    self.known[part] = ids
            out += ids
        if not self.bytes:  # unknown characters in a row are one
            out = [i for i, before in zip(out, [None, *out]) if not i == before == self.unknown]
        return out

    def decode(self, ids: list[int]) -> str:
        """The inverse machine: pieces to texts, runs of bytes to characters, marks to blanks."""
        if not hasattr(self, "spelled"):
            self.spelled = {i: name.encode() for i, name in self.names.items()}
            self.spelled |= {i: bytes([b]) for b, i in self.bytes.items()}
            self.spelled[self.unknown] = self.unknown_text.encode()
        mark, squeeze = MARK.encode(), self.normalised.squeeze
        parts = [self.spelled.get(i, b"") for i in ids]
        if self.normalised.prefix or squeeze:
            for n, part in enumerate(parts):
                parts[n] = part.removeprefix(mark)
                if parts[n] or part and not squeeze:
                    break
        return b"".join(parts).decode("utf-8", "replace").replace(MARK, " ")


class PartMachine:
    """A machine that takes a batch of texts at a time, each distinct part of them once.

    Where pieces of merges hold the mark only in front, and the normaliser replaces nothing, squeezes no blanks
    and puts one in front, a text's parts are what stands between its blanks, and the transducer's answers
    for them are kept in a table. Texts with blanks in a row, or other models, go through the transducer whole.
    """

    def __init__(self, machine: Transducer):
        plain = machine.normalised
        self.machine = machine
        self.by_parts = machine.whole and not plain.replaced and not plain.squeeze and plain.prefix == MARK and bool(machine.bytes)
        self.table = PartTable(self._learn, np.int32)
        behind = {b for name in machine.pieces for a, b in zip(name, name[1:]) if a.isascii() and a.isalpha()}
        self.signs = "".join(c for c in _SIGNS if c not in behind)
        names = machine.names
        size = max([*names, *machine.bytes.values(), machine.unknown]) + 1
        spelled = [names[i].replace(MARK, " ").encode() if i in names else b"" for i in range(size)]
        for byte, i in machine.bytes.items():
            spelled[i] = bytes([byte])
        spelled[machine.unknown] = machine.unknown_text.encode()
        self.sizes = np.fromiter(map(len, spelled), np.int64, size)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(spelled), np.uint8)

    def _learn(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.machine._shortest(part) for part in parts]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a slice of texts, and the bounds of each text's."""
        simple = pc.invert(pc.or_(pc.match_substring_regex(texts, f"^ |  | $|{MARK}|{_CUT}"), pc.equal(texts, "")))
        if self.by_parts and pc.all(simple).as_py():
            mark, nothing = pa.scalar(MARK, texts.type), pa.scalar("", texts.type)
            marked = pc.binary_join_element_wise(mark, pc.replace_substring(texts, " ", _CUT + MARK), nothing)
            if self.signs:
                marked = pc.replace_substring_regex(marked, f"([A-Za-z])([{re.escape(self.signs)}])", rf"\1{_CUT}\2")
            lists = pc.split_pattern(marked, _CUT)
            return self.table.gather(*numbered(lists.flatten(), lists.offsets.to_numpy()))
        if self.by_parts and pc.any(simple).as_py():
            ids, bounds = self.encode(texts.filter(simple))
            known = iter(np.split(ids, bounds[1:-1]))
            found = [next(known) if s else self.machine.encode(t) for s, t in zip(simple.to_pylist(), texts.to_pylist())]
        else:
            found = [self.machine.encode(t) for t in texts.to_pylist()]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.concatenate([np.asarray(f, np.int32) for f in found]), np.append(0, np.cumsum(sizes))

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of a slice of ids."""
        if not self.by_parts:
            return [self.machine.decode(ids[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        letters = self.letters[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(total)].tobytes()
        places = np.append(0, ends)[bounds].tolist()
        out = []
        for a, b, low, high in zip(bounds, bounds[1:], places, places[1:]):
            raw = letters[low:high]
            first = ids[a:b][:1].tolist()
            # The blank of the first piece is the one the normaliser put there.
            if first and self.machine.names.get(first[0], "").startswith(MARK):
                raw = raw[1:]
            text = raw.decode("utf-8", "replace")
            # Bytes may spell the mark, which shows as a blank too.
            out.append(text.replace(MARK, " "))
        return out


_machines: dict[str, Transducer] = {}
_part_machines: dict[str, PartMachine] = {}


def part_machine_for(path: str | None) -> PartMachine:
    path = path or default_model()
    if path not in _part_machines:
        _part_machines[path] = PartMachine(machine_for(path))
    return _part_machines[path]


def machine_for(path: str | None) -> Transducer:
    """The machine of a task process, with what it remembers from earlier tasks."""
    path = path or default_model()
    if path not in _machines:
        _machines[path] = Transducer(path)
    return _machines[path]


def encode(docs: DataFrame, model: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of int) for every row.

    Null and empty texts have no ids. Rows that repeat an id, or have none, come out each. Other
    columns are ignored; an empty table gives no rows.
    """

    def run(batches):
        machine = part_machine_for(model)
        for batch in batches:
            for start, texts in slices(batch.column("text")):
                ids, bounds = machine.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, len(texts)), lists], names=["doc_id", "ids"])
        release()

    return documents(docs, id_column, text_column).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """``doc_id``, ``text`` for rows of ids; a null list is an empty text."""

    def run(batches):
        machine = part_machine_for(model)
        for batch in batches:
            lists = batch.column(ids_column)
            if lists.null_count:
                lists = pa.array([i or [] for i in lists.to_pylist()], pa.list_(pa.int32()))
            bounds = lists.offsets.to_numpy()
            texts = machine.decode(lists.flatten().to_numpy(zero_copy_only=False), bounds - bounds[0])
            yield pa.RecordBatch.from_arrays([batch.column(id_column), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(id_column, ids_column).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_chars``, ``n_ids``, ``ids_crc32`` (little-endian unsigned 32-bit ids),
    ``decoded_sha256`` (lower-case hexadecimal, of the decoded text's UTF-8) for every row."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_ids", pa.int64()), ("ids_crc32", pa.int64()), ("decoded_sha256", pa.string()),
    ])

    def run(batches):
        machine = part_machine_for(model)
        for batch in batches:
            for start, texts in slices(batch.column("text")):
                ids, bounds = machine.encode(texts)
                raw = memoryview(ids.astype("<u4")).cast("B")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, len(texts)), pc.utf8_length(texts).cast(pa.int64()),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds, bounds[1:])], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in machine.decode(ids, bounds)]),
                    ],
                    schema=schema,
                )
        release()

    kinds = "doc_id long, n_chars long, n_ids long, ids_crc32 long, decoded_sha256 string"
    return documents(docs, id_column, text_column).mapInArrow(run, kinds)
