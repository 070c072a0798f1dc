"""Encoding and decoding with a byte-pair model of SentencePiece, exactly as its library does.

A text is normalised as the model's file says (white space as U+2581, with one in front) and cut where no piece reaches
across: before a space sign that follows another character, and around characters that are in no longer piece.  What is
between is called a word here.  Each task keeps the ids of words it has met; new ones are encoded together, as flat numpy
arrays of symbols (``Merger``):

* each symbol has the rank of the piece that it makes with the one after it, and each word the smallest of these;
* in one round every word merges all its pairs of that rank, from the left and without overlap, where doing so is the
  same as one at a time: if a new pair would be of no greater rank than the merged one, what is to the right of it waits;
* arrays are compacted, words without a pair leave.

So a round handles all words of a batch, and their number is that of the merges of the word that needs most.  Characters
that the model doesn't know become the bytes of their UTF-8.  Runs of one character whose pieces all have the same rank
merge from the left one by one; long ones are cut into the longest piece first, if the model was found to do that
(``Model.run_blocks``).

Null texts count as empty: the end id alone, decoded as an empty text.  Texts are encoded whole, however long they are.
Repeated rows each get a row; other columns aren't read.  An empty table gives no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words whose ids a Python worker keeps, and the bytes that they may have; when there are more, it starts anew.
MEMO_WORDS, MEMO_BYTES = 400_000, 64 << 20

#: Characters of new words that are merged at once; a longer word is merged alone.
BATCH_CHARS = 1 << 20

SPACE = "▁"

_NONE = np.iinfo(np.int32).max

#: Stands for a space that was taken away; no character of UTF-8.
_SEEN = "\ud800"

codecs.register_error("each-byte", lambda e: ("�", e.start + 1))


# The model's file.


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of the fields of a protobuf message."""

    def number(i: int) -> tuple[int, int]:
        n = shift = 0
        while True:
            n |= (data[i] & 127) << shift
            i, shift = i + 1, shift + 7
            if data[i - 1] < 128:
                return n, i

    i = 0
    while i < len(data):
        key, i = number(i)
        if key & 7 == 0:
            value, i = number(i)
        else:
            length, i = ({1: 8, 5: 4}[key & 7], i) if key & 7 != 2 else number(i)
            value, i = data[i : i + length], i + length
        yield key >> 3, value


@dataclass
class Model:
    """A model's pieces.  Symbols are piece ids, then the characters that are known only as parts of longer pieces."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]  # 1 normal, 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte
    dummy_prefix: bool = True
    symbols: dict[str, int] = field(default_factory=dict)

    @classmethod
    def read(cls, path: str) -> Model:
        """Raises where the file asks for what isn't built: other algorithms, normalisations or kinds of pieces."""
        pieces, scores, kinds, flags, trainer = [], [], [], {}, {}
        with open(path, "rb") as f:
            message = f.read()
        for number, value in _fields(message):
            if number == 1:
                parts = dict(_fields(value))
                pieces.append(parts.get(1, b"").decode())
                scores.append(float(np.frombuffer(parts[2], "<f4")[0]) if 2 in parts else 0.0)
                kinds.append(parts.get(3, 1))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                flags = dict(_fields(value))
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
            raise ValueError("only byte-pair models with byte fallback and spaces before words are read")
        if flags.get(2) or flags.get(4, 1) or not flags.get(5, 1):
            raise ValueError("only models that keep white space and characters as they are are read")
        if {4, 5} & set(kinds):
            raise ValueError("models with user-defined or unused pieces aren't read")
        return cls(pieces, scores, kinds, bool(flags.get(3, 1)))

    def __post_init__(self) -> None:
        normal = [i for i, k in enumerate(self.kinds) if k == 1]
        self.symbols = {self.pieces[i]: i for i in normal}
        self.byte_ids = [0] * 256
        for i, k in enumerate(self.kinds):
            if k == 6:
                self.byte_ids[int(self.pieces[i][1:-1], 16)] = i
        self.unknown_id, self.end_id = self.kinds.index(2), self.pieces.index("</s>")
        long = [self.pieces[i] for i in normal if len(self.pieces[i]) > 1]
        for c in sorted(set("".join(long)) - set(self.symbols)):
            self.symbols[c] = len(self.pieces) + len(self.symbols) - len(normal)
        self.characters = {s: c for c, s in self.symbols.items() if len(c) == 1}
        self._pairs(long)
        self.joined = {a + b for p in long for a, b in zip(p, p[1:], strict=False)}  # characters that stand side by side in pieces
        inner = {b for a, b in self.joined}
        self.cut_before_space = all(a == SPACE for a, b in self.joined if b == SPACE)
        #: A line end ends a word if no longer piece has one.
        self.line_ends = "" if "\n" in inner or any(a == "\n" for a, _ in self.joined) else "\n"
        known = sorted(set("".join(self.joined)))
        self.known = np.array([ord(c) for c in known], dtype=np.uint32)
        self.beside = np.zeros((len(known) + 1, len(known) + 1), dtype=bool)
        place = {c: k for k, c in enumerate(known)}
        for a, b in self.joined:
            self.beside[place[a], place[b]] = True
        single = sorted((ord(c), s) for c, s in self.symbols.items() if len(c) == 1)
        self.char_codes = np.array([c for c, _ in single], dtype=np.uint32)
        self.char_symbols = np.array([s for _, s in single], dtype=np.int32)
        #: Bytes that a piece stands for.
        self.raw = [bytes([int(p[1:-1], 16)]) if k == 6 else b"" if k == 3 else " ⁇ ".encode() if k == 2 else p.encode() for p, k in zip(self.pieces, self.kinds, strict=True)]
        self.names = [str(i) for i in range(len(self.pieces))]
        self.run_blocks: dict[str, int] = {}
        last = int(self.rank.max())
        for c in {p[0] for p in long if self.rank[self.symbols[p]] == last}:
            self._find_run_block(c, [p for p in long if p == c * len(p)], last)

    def _pairs(self, long: list[str]) -> None:
        """Sorted keys of pairs of symbols, with the rank and symbol of the piece that they make.  Ranks are those of scores:
        pieces of one score have one rank."""
        ranks = {s: k for k, s in enumerate(sorted({-self.scores[self.symbols[p]] for p in long}))}
        self.width = len(self.pieces) + len(self.symbols)
        rank = np.full(self.width, -1, dtype=np.int32)  # of the piece that a symbol is, -1 for single characters
        keys, values = [], []
        for p in long:
            s = self.symbols[p]
            rank[s] = ranks[-self.scores[s]]
            for k in range(1, len(p)):
                a, b = self.symbols.get(p[:k]), self.symbols.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a * self.width + b)
                    values.append(s)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys, self.made = np.array(keys, dtype=np.int64)[order], np.array(values, dtype=np.int32)[order]
        self.rank = rank
        # Symbols that make, with a neighbour, a piece of no greater rank than their own.
        self.early = np.zeros(self.width, dtype=bool)
        for part in (self.keys // self.width, self.keys % self.width):
            self.early[part[rank[self.made] <= rank[part]]] = True
        self.slots = 1 << (2 * len(keys)).bit_length()
        self._hash()

    def _hash(self) -> None:
        """A table of the pairs by a hash, three places to look at."""
        while True:
            table = np.full(self.slots + 16, -1, dtype=np.int32)
            at = self._slot(self.keys)
            left = np.arange(len(self.keys), dtype=np.int32)
            probes = 0
            while len(left) and probes < 16:
                free = left[table[at[left] + probes] < 0]
                table[at[free] + probes] = free  # of several the last stays
                left = left[table[at[left] + probes] != left]
                probes += 1
            if not len(left) and probes <= 8:
                self.table, self.probes = table, probes
                return
            self.slots *= 2

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.slots.bit_length() + 1)).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pieces that symbols make, -1 where there is none.  A symbol of -1 makes none."""
        keys = left.astype(np.int64) * self.width + right
        out = np.full(len(keys), -1, dtype=np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        at = self._slot(keys[todo])
        for probe in range(self.probes):
            k = self.table[at + probe]
            hit = (k >= 0) & (self.keys[k] == keys[todo])
            out[todo[hit]] = self.made[k[hit]]
            more = ~hit & (k >= 0)
            todo, at = todo[more], at[more]
            if not len(todo):
                break
        return out

    def symbols_of(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of characters; -1 - code of those that the model doesn't know."""
        k = np.minimum(np.searchsorted(self.char_codes, codes), len(self.char_codes) - 1)
        return np.where(self.char_codes[k] == codes, self.char_symbols[k], -1 - codes.astype(np.int64)).astype(np.int32)

    def _find_run_block(self, c: str, runs: list[str], last: int) -> None:
        """Notes that runs of a character are merged to the longest such piece first, from the left, if they are: all pieces
        of the character are of the last rank and runs of up to five blocks begin so."""
        if not runs or any(self.rank[self.symbols[p]] != last for p in runs):
            return
        block = max(map(len, runs))
        merger, whole = Merger(self), self.symbols[c * block]
        words = [c * n for n in range(block, 5 * block + 1)]
        flat, bounds = merger(words)
        if all((flat[a : a + len(w) // block] == whole).all() for w, a in zip(words, bounds, strict=False)):
            self.run_blocks[c] = block


# Merging.


class Merger:
    def __init__(self, model: Model):
        self.model = model

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The final symbols of all words one after the other, and where each word begins (with an end)."""
        m = self.model
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths)
        sym = m.symbols_of(codes)
        # Segments: words, cut between characters that no piece has side by side.
        place = np.minimum(np.searchsorted(m.known, codes), len(m.known) - 1)
        place = np.where(m.known[place] == codes, place, len(m.known))
        starts = np.zeros(len(codes) + 1, dtype=bool)
        starts[ends - lengths] = True
        starts[1:-1] |= ~m.beside[place[:-1], place[1:]]
        at = np.arange(len(codes))
        sym, at = self._merged(sym, at, np.flatnonzero(starts[:-1]))
        # Symbols are in order of their first character again.
        return sym, np.searchsorted(at, np.concatenate([[0], ends]))

    def _merged(self, sym: np.ndarray, at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rounds over segments that begin at ``starts``; returns symbols and their places, in order of the places."""
        m, done = self.model, []
        made = self._made(sym, starts)
        while len(sym):
            rank = np.where(made >= 0, m.rank[made], _NONE)
            least = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(sym)))
            alive = least < _NONE
            if not alive.all():  # segments without a pair leave
                stay = np.repeat(alive, lengths)
                done.append((sym[~stay], at[~stay]))
                sym, at, made, rank = sym[stay], at[stay], made[stay], rank[stay]
                least, lengths = least[alive], lengths[alive]
                starts = np.cumsum(lengths) - lengths
                if not len(sym):
                    break
            segment = np.repeat(np.arange(len(starts)), lengths)
            pos = np.flatnonzero(rank == least[segment])
            # Every other one of a run of overlapping pairs.
            first = np.append(True, np.diff(pos) != 1)
            run = np.maximum.accumulate(np.where(first, np.arange(len(pos)), 0))
            pos = pos[(np.arange(len(pos)) - run) % 2 == 0]
            pos = pos[self._in_turn(sym, made, segment, pos, rank[pos])]
            sym[pos] = made[pos]
            gone = pos + 1
            keep = np.ones(len(sym), dtype=bool)
            keep[gone] = False
            new = np.cumsum(keep) - 1  # places after compaction
            lengths = lengths - np.bincount(segment[gone], minlength=len(starts))
            starts = np.cumsum(lengths) - lengths
            sym, at, made = sym[keep], at[keep], made[keep]
            touched = new[pos]
            ends = np.zeros(len(sym), dtype=bool)
            ends[starts + lengths - 1] = True
            begins = np.zeros(len(sym), dtype=bool)
            begins[starts] = True
            touched = np.unique(np.concatenate([touched, touched[~begins[touched]] - 1]))
            made[touched] = -1
            touched = touched[~ends[touched]]
            made[touched] = m.pair(sym[touched], sym[touched + 1])
        if not done:
            return sym, at
        sym, at = np.concatenate([s for s, _ in done]), np.concatenate([a for _, a in done])
        order = np.argsort(at, kind="stable")
        return sym[order], at[order]

    def _made(self, sym: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Piece of each symbol with the one after it in its segment."""
        made = np.full(len(sym), -1, dtype=np.int32)
        if len(sym) > 1:
            made[:-1] = self.model.pair(sym[:-1], sym[1:])
            made[starts[1:] - 1] = -1
        return made

    def _in_turn(self, sym: np.ndarray, made: np.ndarray, segment: np.ndarray, pos: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Which of the pairs at ``pos`` may merge at once: in each segment those up to the first whose merging makes a pair of
        no greater rank with its neighbours, as that one would be next."""
        m, n = self.model, len(pos)
        ask = np.flatnonzero(m.early[made[pos]])
        if not len(ask):
            return np.ones(n, dtype=bool)
        p = pos[ask]
        # What is left of it may be the outcome of the merge before.
        before = np.where(p > 0, sym[np.maximum(p - 1, 0)], -1)
        follows = (ask > 0) & (pos[np.maximum(ask - 1, 0)] == p - 2)
        before = np.where(follows, made[pos[np.maximum(ask - 1, 0)]], before)
        before = np.where((p > 0) & (segment[np.maximum(p - 1, 0)] == segment[p]), before, -1)
        beyond = np.minimum(p + 2, len(sym) - 1)
        after = np.where((p + 2 < len(sym)) & (segment[beyond] == segment[p]), sym[beyond], -1)
        bad = np.zeros(len(ask), dtype=bool)
        for left, right in ((before, made[p]), (made[p], after)):
            piece = m.pair(left, right)
            bad |= (piece >= 0) & (m.rank[piece] <= rank[ask])
        if not bad.any():
            return np.ones(n, dtype=bool)
        limit = np.full(segment[-1] + 1, n, dtype=np.int64)
        np.minimum.at(limit, segment[p[bad]], ask[bad])
        return np.arange(n) <= limit[segment[pos]]


class Codec:
    """Ids of texts and texts of ids, with a memory of words."""

    def __init__(self, path: str):
        self.model = Model.read(path)
        self.merge = Merger(self.model)
        line = self.model.line_ends
        if self.model.cut_before_space:
            self.split = re.compile(f"{line}+|{SPACE}+[^{SPACE}{line}]*|[^{SPACE}{line}]+" if line else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
        else:
            self.split = lambda text: [text]
        self.known: dict[str, tuple[str, int, bytes]] = {}
        self.held = 0

    def ids_of(self, words: list[str]) -> tuple[list[int], list[int]]:
        """Ids of all words one after the other, and where each word begins (with an end)."""
        m = self.model
        sym, bounds = self.merge(words)
        other = np.flatnonzero((sym < 0) | (sym >= len(m.pieces)))
        if len(other):  # characters that are no pieces: their bytes
            spelt = [[m.byte_ids[b] for b in c.encode()] for c in (chr(-1 - s) if s < 0 else m.characters[s] for s in sym[other].tolist())]
            width = np.ones(len(sym), dtype=np.int64)
            width[other] = list(map(len, spelt))
            begin = np.append(0, np.cumsum(width))
            out = np.empty(begin[-1], dtype=np.int32)
            out[begin[:-1]] = sym
            for at, ids in zip(begin[other].tolist(), spelt, strict=True):
                out[at : at + len(ids)] = ids
            sym, bounds = out, begin[bounds]
        return sym.tolist(), bounds.tolist()

    def text_of(self, raw: bytes) -> str:
        """Text of the bytes of an encoded text's pieces: the space that was put in front is taken away."""
        text = raw.decode("utf-8", "each-byte")
        if self.model.dummy_prefix and text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        """The text of any ids.  Bytes that follow each other are read together; of what isn't UTF-8 each byte becomes U+FFFD.
        A space in front of the first piece that gives text is taken away."""
        m, out = self.model, []
        for is_byte, run in itertools.groupby(ids, lambda i: m.kinds[i] == 6):
            if is_byte:
                out.append(b"".join(map(m.raw.__getitem__, run)).decode("utf-8", "each-byte"))
                continue
            for i in run:
                piece = m.raw[i].decode()
                if m.dummy_prefix and not any(out) and piece.startswith(SPACE):
                    piece = piece[1:] or None  # the space of a text that begins with one was seen, although nothing is left
                out.append(piece.replace(SPACE, " ") if piece is not None else _SEEN)
        return "".join(out).replace(_SEEN, "")

    def _words(self, text: str) -> list[str]:
        if not text:
            return []
        text = (SPACE if self.model.dummy_prefix else "") + text.replace(" ", SPACE)
        words = self.split(text)
        for c, block in self.model.run_blocks.items():
            if c * (2 * block) in text:
                words = [part for w in words for part in self._cut_run(w, c, block)]
        return words

    @staticmethod
    def _cut_run(word: str, c: str, block: int) -> list[str]:
        """A word that begins with a long run: whole blocks of it, as long as more than one of the run is left."""
        run = len(word) - len(word.lstrip(c))
        n = max(run - 2, 0) // block
        return [c * block] * n + [word[n * block :]]

    def texts(self, texts: list[str]) -> Iterator[tuple[str, int, str]]:
        """(ids as decimals joined by one space, how many, decoded text) of each text, with the end id."""
        if len(self.known) > MEMO_WORDS or self.held > MEMO_BYTES:
            self.known, self.held = {}, 0
        split = [self._words(t) for t in texts]
        m, known = self.model, self.known
        new = list({w for words in split for w in words if w not in known})
        while new:
            chars, part = 0, []
            while new and (not part or chars + len(new[-1]) <= BATCH_CHARS):
                chars += len(new[-1])
                part.append(new.pop())
            ids, at = self.ids_of(part)
            names, raw = list(map(m.names.__getitem__, ids)), list(map(m.raw.__getitem__, ids))
            for w, a, b in zip(part, at, at[1:], strict=False):
                known[w] = (" ".join(names[a:b]), b - a, b"".join(raw[a:b]))
            self.held += 12 * chars
        end = str(self.model.end_id)
        for words in split:
            parts = list(map(known.__getitem__, words))
            yield " ".join([p[0] for p in parts] + [end]), sum([p[1] for p in parts]) + 1, self.text_of(b"".join([p[2] for p in parts]))

    def encode(self, text: str) -> list[int]:
        """Ids with the end id."""
        return [int(x) for x in next(iter(self.texts([text])))[0].split(" ")]


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per file and Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


#: Bytes of texts that are split at once; a longer text is split alone.
_PART = 4 << 20


def _parts(column: pa.Array) -> Iterator[list[str]]:
    part, held = [], 0
    for x in column:
        text = x.as_py() or ""
        if part and held + len(text) > _PART:
            yield part
            part, held = [], 0
        part.append(text)
        held += len(text)
    if part:
        yield part


def piece_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``id_col``, n_tokens, ids_sha256 (decimal ids joined by one space, with the end id) and
    decoded_sha256 (of the text that the ids decode to)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            n, ids, decoded = [], [], []
            for part in _parts(batch.column(1)):
                for joined, count, text in c.texts(part):
                    n.append(count)
                    ids.append(hashlib.sha256(joined.encode()).hexdigest())
                    decoded.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col), F.col(text_col))
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """The rows with ``ids`` (an array, with the end id) and ``decoded``, and without ``text_col``."""
    names = [c for c in docs.columns if c != text_col]
    out = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            ids, decoded = [], []
            for part in _parts(batch.column(batch.num_columns - 1)):
                for joined, _, text in c.texts(part):
                    ids.append(np.array(joined.split(" "), dtype=np.int32))
                    decoded.append(text)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())], names=[*names, "ids", "decoded"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out[:-1]] + ["ids array<int>", "decoded string"])
    return docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`")).mapInArrow(run, schema)
