"""Similarity join of documents' shingle sets: Jaccard similarity of at least 4/5, with a prefix tree of ordered sets.

1. Every document becomes the set of its distinct shingles' 64-bit hashes.  Tasks deal the lower half of the hash values
   out by range, packed in blocks; a shingle that two documents of a task share is sent once.  Each range tells for every
   document how many of its shingles occur in another document.  A document of n shingles with more than n / 5 that occur
   nowhere else can't be similar to any other, and half of the values are enough to tell that of most documents.  (Here 33
   bits and the range's are compared; a chance agreement only keeps a document for longer.)
2. Of what is left, equal sets (by a 128-bit digest of the set) are represented by one document.  Their shingles get one
   global order, rarest first, ties by hash.  Shingles that are frequent within tasks are counted by partial aggregates and
   told to all tasks (there are at most HOT_SHINGLES of them); the others are counted in ranges of hash values, so that no
   range holds the documents of a passage that a third of all documents share.  Frequencies over 65,535 count as that,
   which changes the order of shingles and nothing else.
3. Two similar sets have a shingle in common among the first n - ceil(0.8 n) + 1 of each.  Sets that these connect form
   coarse groups, so that each set is sent once.  A coarse group goes into a prefix tree of its ordered sets.  For a set,
   lists of the first shingles name the sets that share COMMON of them (sets that are connected to it already are left
   out), and these are looked up by walking down the tree: the overlap with a path is counted once for all sets that share
   it, and a subtree is left when what remains of the set and of the longest set below can't reach the overlap needed or
   no set below has a fitting size.
   A group over ``tile_bytes`` is first dealt out by hash into single trees, ``SPREADS`` times over, which is work in
   proportion to the group and already connects most copies of a text.  Of its shingles then only those count that sets
   of different components share; the groups that these form are smaller or none.  What still is over ``tile_bytes`` is
   dealt by these shingles: a set goes to the parts of its own.  A part over ``tile_bytes`` is cut by set size and hash
   into tiles, and every pair of tiles with fitting sizes is joined.
4. Links, one for each set that a walk connects, give the components.

Null texts and texts without words have empty sets, which are linked with nothing.  Fewer than five words are one shingle.
Texts of any length are read whole.  Repeated rows each get their row; rows with the same id and different texts are
documents of their own.  Rows without an id take part; a component without any id has a null component_id.  Of ids that
aren't whole numbers the least is the first in their type's order.  An empty table gives no rows.  Where ids are repeated,
null or not whole numbers, rows are told apart by a 64-bit hash of id and text.  Other columns, also those named like the
ones made here, are not looked at; ``one_of_each`` returns them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import attached, stored, tasks_for
from .words import byte_classes, chunks, mix, window_hashes, words_of

WORDS = 5
#: Text bytes per hash range of step 1.
RANGE_TEXT_BYTES = 16 << 20
#: Shingles per hash range of step 2.
RANGE_SHINGLES = 1 << 21
#: Shingles that are counted by partial aggregates, at most; each is in more than 32,768 documents.
HOT_SHINGLES, HOT_DOCUMENTS, HOT_IN_CHUNK = 500_000, 32_768, 8
#: First shingles of which two sets must share this many (or all that they need) to be looked up.  The next number counts
#: where the one before leaves more than FEW sets.
COMMON, FEW = (4, 16, 64), 16
#: Bytes of ordered sets and nodes in one tree.
TILE_BYTES = 16 << 20
#: Bytes of a set's nodes.
NODE_BYTES = 1024
#: Times that a group over TILE_BYTES is dealt out by hash before pairs of tiles are joined.
SPREADS = 2

_U = np.uint64
_SET = ("rid", "n", "keys", "often")
_SPACE = byte_classes("space")


def shingle_sets(texts: list[bytes], size: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = words_of(texts, _SPACE)
    counts = np.diff(words.first)
    hashes, at = window_hashes(words, size)
    bounds = np.searchsorted(words.doc[at], np.arange(len(texts) + 1))
    out = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            hashes, at = window_hashes(words, n)
            begin = {int(i): k for k, i in enumerate(at.tolist())}
            for k in short.tolist():
                out[k] = hashes[[begin[int(words.first[k])]]]
    return out


def _by_range(tokens: np.ndarray, bits: int) -> np.ndarray:
    return (tokens >> _U(64 - bits)).astype(np.uint16) if bits else np.zeros(len(tokens), dtype=np.uint16)


def _packed(ids: np.ndarray, owner: np.ndarray, tokens: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Range, ids, tokens per id, tokens; within a range in the order of the documents."""
    r = _by_range(tokens, bits)
    order = np.argsort(r, kind="stable")
    r, owner, tokens = r[order], owner[order], tokens[order]
    edges = np.searchsorted(r, np.arange((1 << bits) + 1))
    for k in range(1 << bits):
        a, b = edges[k], edges[k + 1]
        if b > a:
            begins = np.flatnonzero(np.concatenate([[True], owner[a + 1 : b] != owner[a : b - 1]]))
            yield k, ids[owner[a:b][begins]], np.diff(np.append(begins, b - a)).astype(np.uint32), tokens[a:b]


def _suffix(tokens: np.ndarray, bits: int) -> np.ndarray:
    """What the range doesn't say."""
    return ((tokens << _U(bits)) >> _U(32)).astype(np.uint32)


_BLOCK = pa.schema([("r", pa.int32()), ("kind", pa.int32()), ("ids", pa.binary()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary())])
_BLOCK_SQL = "r int, kind int, ids binary, a binary, b binary, c binary, d binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _BLOCK, strict=True)], schema=_BLOCK)


def _deal(bits: int, size: int):
    """Step 1, in the tasks that read texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            texts = [x or b"" for x in batch.column(1).to_pylist()]
            for low, high in chunks(texts, 2 << 20):
                sets = shingle_sets(texts[low:high], size)
                own, n = ids[low:high], np.array([len(s) for s in sets])
                tokens = np.concatenate(sets)
                with np.errstate(over="ignore"):
                    sums = [np.concatenate([np.zeros(1, _U), np.cumsum(mix(tokens ^ _U(k)))]) for k in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)]
                    ends = np.cumsum(n)
                    digests = [(s[ends] - s[ends - n]).view(np.int64) for s in sums]
                lower = tokens < _U(1 << 63)
                owner = np.repeat(np.arange(len(sets)), n)[lower]
                tokens = tokens[lower] << _U(1)
                ordered = np.sort(tokens)
                twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
                shared = np.zeros(len(tokens), dtype=bool)
                if len(twice):
                    shared = twice[np.minimum(np.searchsorted(twice, tokens), len(twice) - 1)] == tokens
                here = np.bincount(owner[~shared], minlength=len(sets))
                rows = [(int(own[0]) % (1 << bits), 1, own.tobytes(), *(x.astype(np.int64).tobytes() for x in (here, n, *digests)))]
                rows += [(r, 0, i.tobytes(), c.tobytes(), _suffix(t, bits).tobytes(), None, None) for r, i, c, t in _packed(own, owner[~shared], tokens[~shared], bits)]
                r = _by_range(twice, bits)
                rows += [(int(k), 2, None, None, _suffix(twice[r == k], bits).tobytes(), None, None) for k in np.unique(r)]
                yield _rows(rows)

    return run


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    parts = [np.frombuffer(x, dtype=kind) for x in table.column(name).to_pylist() if x]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=kind)


def _count_shared(bits: int):
    """Step 1, for a range: how many shingles of documents are found elsewhere, packed by ranges of mixed ids."""

    def run(table: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        part = {k: table.filter(pc.equal(table.column("kind"), k)) for k in (0, 1, 2)}
        tokens, twice = _joined(part[0], "b", np.uint32), _joined(part[2], "b", np.uint32)
        ids, counts = _joined(part[0], "ids", np.int64), _joined(part[0], "a", np.uint32)
        ordered = np.sort(np.concatenate([tokens, twice]))
        known = np.union1d(ordered[1:][ordered[1:] == ordered[:-1]], twice)
        found = np.zeros(len(ids), dtype=np.int64)
        if len(known) and len(tokens):
            hit = known[np.minimum(np.searchsorted(known, tokens), len(known) - 1)] == tokens
            found = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(counts[:-1])]).astype(np.int64))
        rows = []
        for name, own, values in (
            (0, ids[found > 0], [found[found > 0].astype(np.uint32)]),
            (1, _joined(part[1], "ids", np.int64), [_joined(part[1], c, np.int64) for c in ("a", "b", "c", "d")]),
        ):
            where = _by_range(mix(own.view(_U)), bits)
            order = np.argsort(where, kind="stable")
            edges = np.searchsorted(where[order], np.arange((1 << bits) + 1))
            for k in np.flatnonzero(np.diff(edges)).tolist():
                at = order[edges[k] : edges[k + 1]]
                rows.append((k, name, own[at].tobytes(), *[v[at].tobytes() for v in values], *[None] * (4 - len(values))))
        return pa.Table.from_batches([_rows(rows)] if rows else [], schema=_BLOCK)

    return run


_STATS = "rid bigint, alone bigint, n bigint, d1 bigint, d2 bigint"


def _sum_up(table: pa.Table) -> pa.Table:
    """Step 1, for a range of ids: shingles (of the lower half) that no other document has, set size and digest."""
    import pyarrow.compute as pc

    found, docs = (table.filter(pc.equal(table.column("kind"), k)) for k in (0, 1))
    ids, alone, n, d1, d2 = (_joined(docs, c, np.int64) for c in ("ids", "a", "b", "c", "d"))
    ids, first, inverse = np.unique(ids, return_index=True, return_inverse=True)
    alone = np.bincount(inverse, weights=alone, minlength=len(ids))
    if len(ids):
        at = np.searchsorted(ids, _joined(found, "ids", np.int64))
        alone -= np.bincount(at, weights=_joined(found, "a", np.uint32), minlength=len(ids))
    return pa.table([ids, alone.astype(np.int64), n[first], d1[first], d2[first]], names=["rid", "alone", "n", "d1", "d2"])


def _frequent(size: int):
    """Step 2: shingles that several documents of a chunk have, with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(1).to_pylist()]
            for low, high in chunks(texts, 2 << 20):
                tokens, n = np.unique(np.concatenate(shingle_sets(texts[low:high], size)), return_counts=True)
                often = n >= HOT_IN_CHUNK
                if often.any():
                    yield pa.RecordBatch.from_arrays([pa.array(tokens[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["token", "n"])

    return run


def _deal_again(bits: int, size: int, hot):
    """Step 2: all shingles of the documents that are left; frequent ones with their numbers, past the ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, numbers = hot.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            texts = [x or b"" for x in batch.column(1).to_pylist()]
            for low, high in chunks(texts, 2 << 20):
                sets = shingle_sets(texts[low:high], size)
                own, tokens = ids[low:high], np.concatenate(sets)
                owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                rows = []
                if len(frequent) and len(tokens):
                    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
                    known = frequent[at] == tokens
                    begins = np.flatnonzero(np.diff(owner[known], prepend=-1))
                    if len(begins):
                        held = np.diff(np.append(begins, int(known.sum()))).astype(np.uint32)
                        part = (1 << bits) + int(own[0]) % (1 << bits)
                        rows.append((part, 1, own[owner[known][begins]].tobytes(), held.tobytes(), tokens[known].tobytes(), numbers[at[known]].tobytes(), None))
                    owner, tokens = owner[~known], tokens[~known]
                rows += [(r, 0, i.tobytes(), c.tobytes(), t.tobytes(), None, None) for r, i, c, t in _packed(own, owner, tokens, bits)]
                if rows:
                    yield _rows(rows)

    return run


def _ranked(table: pa.Table) -> pa.Table:
    """Step 2, for a range: each document's shingles that another has too, with the numbers of documents that have them."""
    import pyarrow.compute as pc

    out = {"rid": [], "keys": [], "often": []}
    for kind in (0, 1):
        part = table.filter(pc.equal(table.column("kind"), kind))
        ids, counts, tokens = _joined(part, "ids", np.int64), _joined(part, "a", np.uint32), _joined(part, "b", np.uint64)
        if kind == 0:
            order = np.argsort(tokens)
            ordered = tokens[order]
            begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, dtype=np.int64)
            lengths = np.diff(np.append(begins, len(ordered)))
            often = np.empty(len(tokens), dtype=np.uint16)
            often[order] = np.repeat(np.minimum(lengths, 65535), lengths).astype(np.uint16)
        else:
            often = _joined(part, "c", np.uint16)
        ends = np.cumsum(counts)
        for rid, a, b in zip(ids.tolist(), (ends - counts).tolist(), ends.tolist(), strict=True):
            keep = often[a:b] > 1
            if keep.any():
                out["rid"].append(rid)
                out["keys"].append(tokens[a:b][keep].tobytes())
                out["often"].append(often[a:b][keep].tobytes())
    return pa.table([pa.array(out["rid"], pa.int64()), pa.array(out["keys"], pa.binary()), pa.array(out["often"], pa.binary())], names=["rid", "keys", "often"])


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: whole ordered sets, of documents that still can have a partner."""
    for batch in batches:
        rows = []
        for rid, n, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            keys = np.frombuffer(b"".join(p["keys"] for p in parts), dtype=np.uint64)
            often = np.frombuffer(b"".join(p["often"] for p in parts), dtype=np.uint16)
            if 5 * len(keys) >= 4 * n:
                order = np.lexsort((keys, often))
                rows.append((rid, n, keys[order].tobytes(), often[order].tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["rid", "n", "keys", "often"])


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = [], []
        for rid, n, data in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            own = np.frombuffer(data, dtype=np.int64)
            own = own[: max(0, prefix_length(n) - (n - len(own)))]  # shingles of no other document come first
            ids.append(np.full(len(own), rid))
            keys.append(own)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(keys))], names=["rid", "key"])


class PrefixTree:
    """A tree of ordered sets, paths without branches merged.  Leaves are the sets in lexicographic order."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        order = sorted(range(len(sets)), key=lambda k: sets[k].byteswap().tobytes())
        self.order, self.sets, self.sizes = np.array(order, dtype=np.int64), [sets[k] for k in order], sizes[order]
        self.lengths = np.array([len(s) for s in self.sets], dtype=np.int64)
        self.nodes: list[tuple[int, int, int, int, list[int]]] = []  # first and last depth, first and last leaf, children
        self.begins: list[np.ndarray] = []  # first leaves of the children
        self.least, self.most, self.longest = [], [], []
        common = [0] * (len(sets) + 1)
        for k in range(1, len(sets)):
            a, b = self.sets[k - 1], self.sets[k]
            m = min(len(a), len(b))
            other = np.flatnonzero(a[:m] != b[:m])
            common[k] = int(other[0]) if len(other) else m
        common[0] = common[len(sets)] = -1
        self.root = self._build(common)

    def _build(self, common: list[int]) -> int:
        """Intervals of leaves with a common path, found with a stack; each closes when a shorter common path comes."""
        stack: list[list] = [[0, 0, []]]  # depth, first leaf, children
        for leaf in range(len(self.sets)):
            depth = len(self.sets[leaf])
            if depth > stack[-1][0]:
                stack.append([depth, leaf, []])
            shared = max(0, common[leaf + 1])
            last = None
            while len(stack) > 1 and stack[-1][0] > shared:
                top_depth, first, children = stack.pop()
                parent_depth = max(shared, stack[-1][0])
                last = self._node(parent_depth, top_depth, first, leaf, children)
                if stack[-1][0] >= shared:
                    stack[-1][2].append(last)
                else:
                    stack.append([shared, first, [last]])
        depth, first, children = stack[0]
        return self._node(0, 0, 0, len(self.sets) - 1, children)

    def _node(self, low: int, high: int, first: int, last: int, children: list[int]) -> int:
        self.nodes.append((low, high, first, last, children))
        self.begins.append(np.array([self.nodes[c][2] for c in children], dtype=np.int64))
        own = self.sizes[first : last + 1]
        self.least.append(int(own.min()))
        self.most.append(int(own.max()))
        self.longest.append(int(self.lengths[first : last + 1].max()))
        return len(self.nodes) - 1

    def partners(self, keys: np.ndarray, n: int, wanted: np.ndarray) -> list[int]:
        """Leaves among the wanted ones (in order, or a flag per leaf) that are similar to a set of n shingles with these
        keys.  Only paths to wanted leaves are walked."""
        leaves = np.flatnonzero(wanted) if wanted.dtype == bool else wanted
        out: list[int] = []
        todo = [(self.root, 0, leaves)] if len(leaves) else []
        while todo:
            k, overlap, asked = todo.pop()
            low, high, first, last, children = self.nodes[k]
            if 5 * self.most[k] < 4 * n or 4 * self.least[k] > 5 * n:
                continue
            rest = len(keys)
            if high > low:
                edge = self.sets[first][low:high]
                at = np.searchsorted(keys, edge)
                overlap += int(np.count_nonzero(keys[np.minimum(at, len(keys) - 1)] == edge))
                rest = len(keys) - int(at[-1])
            if 9 * (overlap + min(rest, self.longest[k] - high)) < 4 * (n + self.least[k]):
                continue
            end = int(self.begins[k][0]) if children else last + 1  # sets that end here come before the children's
            split = int(np.searchsorted(asked, end))
            out += [leaf for leaf in asked[:split].tolist() if 9 * overlap >= 4 * (n + int(self.sizes[leaf]))]
            asked = asked[split:]
            if len(asked):
                child = np.searchsorted(self.begins[k], asked, side="right") - 1
                edges = np.flatnonzero(np.diff(child, prepend=-1)).tolist()
                todo += [(children[child[a]], overlap, asked[a:b]) for a, b in zip(edges, [*edges[1:], len(asked)], strict=True)]
        return out


class FirstShingles:
    """Lists of the sets that have a shingle among their first ones, so many that two similar sets share ``common`` of them
    (or as many as they need to have in common, if that is less)."""

    def __init__(self, tree: PrefixTree, common: int):
        self.sizes, self.need, self.common = tree.sizes, -(-4 * tree.sizes // 5), common
        ends = np.clip(tree.lengths - self.need + common, 0, None)  # shingles of no other set come first and aren't there
        self.first = [s[:e] for s, e in zip(tree.sets, ends.tolist(), strict=True)]
        self.owner = np.repeat(np.arange(len(self.first)), [len(s) for s in self.first])
        self.tokens = np.concatenate(self.first)

    def list_up(self, new: np.ndarray, label: np.ndarray) -> None:
        """Lists of the new sets, without shingles of sets of one label only."""
        left = new[self.owner]
        self.tokens, self.owner = self.tokens[left], self.owner[left]
        order = np.argsort(self.tokens, kind="stable")
        tokens, owner = self.tokens[order], self.owner[order]
        begins = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, dtype=np.int64)
        several = np.zeros(0, dtype=bool)
        if len(begins):
            several = np.minimum.reduceat(label[owner], begins) != np.maximum.reduceat(label[owner], begins)
        keep = np.repeat(several, np.diff(np.append(begins, len(tokens))))
        self.tokens, self.owner = tokens[keep], owner[keep]
        self.begins = np.flatnonzero(np.concatenate([[True], self.tokens[1:] != self.tokens[:-1]])) if len(self.tokens) else np.zeros(0, dtype=np.int64)
        self.known, self.ends = self.tokens[self.begins], np.append(self.begins[1:], len(self.tokens))

    def candidates(self, leaf: int) -> np.ndarray:
        """Leaves of fitting size that share enough of the first shingles."""
        if not len(self.known):
            return np.zeros(0, dtype=np.int64)
        own = self.first[leaf]
        at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        at = at[self.known[at] == own]
        if not len(at):
            return np.zeros(0, dtype=np.int64)
        counts = np.bincount(np.concatenate([self.owner[a:b] for a, b in zip(self.begins[at].tolist(), self.ends[at].tolist(), strict=True)]))
        found = np.flatnonzero(counts)
        n, size, need = counts[found], self.sizes[leaf], np.maximum(self.need[found], self.need[leaf])
        fits = (n >= np.minimum(self.common, need)) & (5 * self.sizes[found] >= 4 * size) & (4 * self.sizes[found] <= 5 * size)
        return found[fits]


def tree_links(ids: list[int], sets: list[np.ndarray], sizes: list[int], sides: list[int] | None = None, labels: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that connect what is similar: enough of them for the components.  With ``sides``, sets of one side aren't
    compared with each other; with ``labels``, sets of one label count as connected."""
    label = np.unique(ids if labels is None else labels, return_inverse=True)[1]
    if len(ids) < 2 or not label.any():
        return []
    tree = PrefixTree(sets, np.array(sizes, dtype=np.int64))
    label = label[tree.order]  # by leaf
    side = np.array(sides)[tree.order] if sides is not None else None
    new = np.ones(len(ids), dtype=bool)
    names = np.array(ids)[tree.order]
    lists, links, due = [FirstShingles(tree, COMMON[0])], [], 0
    for done, leaf in enumerate(np.argsort(names, kind="stable").tolist()):
        if done == due:  # what is connected by now needn't be listed any more
            for level in lists:
                level.list_up(new, label)
            due = max(1, min(2 * due, due + max(64, len(ids) // 16)))
            if not len(lists[0].known):
                break
        new[leaf] = False
        for k, common in enumerate(COMMON):
            if k == len(lists):
                lists.append(FirstShingles(tree, common))
                lists[k].list_up(new | (np.arange(len(new)) == leaf), label)
            asked = lists[k].candidates(leaf)
            asked = asked[new[asked] & (label[asked] != label[leaf])]
            if side is not None:
                asked = asked[side[asked] != side[leaf]]
            if len(asked) <= FEW:
                break
        found = tree.partners(tree.sets[leaf], int(tree.sizes[leaf]), asked)
        if found:
            links += [(int(names[leaf]), int(names[f])) for f in found]
            label[np.isin(label, label[found])] = label[leaf]
    return links


def ordered_numbers(sets: list[np.ndarray], often: list[np.ndarray]) -> list[np.ndarray]:
    """The sets with each shingle as its place in the order, by frequency and hash, of all shingles that are here."""
    tokens, numbers = np.concatenate(sets), np.concatenate(often)
    order = np.lexsort((tokens, numbers))
    rank = np.empty(len(tokens), dtype=np.uint32)
    rank[order] = np.cumsum(np.concatenate([[False], tokens[order][1:] != tokens[order][:-1]]))
    return np.split(rank, np.cumsum([len(s) for s in sets])[:-1])


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3: rows come block by block."""
    block, held = None, []

    def flush() -> Iterator[pa.RecordBatch]:
        if len(held) > 1:
            ids, sizes, keys, often, sides, labels = map(list, zip(*held, strict=True))
            links = tree_links(ids, ordered_numbers(keys, often), sizes, sides if len(set(sides)) > 1 else None, labels)
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        for own, rid, n, keys, often, side, label in zip(*(batch.column(c).to_pylist() for c in ("block", *_SET, "side", "label")), strict=True):
            if own != block:
                yield from flush()
                block, held = own, []
            held.append((rid, n, np.frombuffer(keys, dtype=np.uint64), np.frombuffer(often, dtype=np.uint16), side, label))
    yield from flush()


def _weight() -> Column:
    return F.sum(F.octet_length("keys") + F.octet_length("often") + NODE_BYTES)


def _by_weight(sets: DataFrame, tile_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(sets of groups that fit one tree, the other groups with what they weigh)"""
    held = sets.groupBy("coarse").agg(_weight().alias("held"))
    return sets.join(held.where(F.col("held") <= tile_bytes).select("coarse"), "coarse"), held.where(F.col("held") > tile_bytes)


def _between(prefixes: DataFrame) -> DataFrame:
    """(key, low): the keys that sets of several labels share, with the least of all sets that have it."""
    return prefixes.groupBy("key").agg(F.min("rid").alias("low"), F.min("label").alias("first"), F.max("label").alias("last")).where("first < last").select("key", "low")


def _coarse(prefixes: DataFrame) -> DataFrame:
    """(rid, coarse) for ``prefixes`` with rid, key and label: groups connected by keys that several labels share."""
    stars = components(prefixes.join(_between(prefixes), "key").select(F.col("rid").alias("a"), F.col("low").alias("b")))
    return stars.select(F.col("a").alias("rid"), F.col("b").alias("coarse")).unionByName(stars.select(F.col("b").alias("rid"), F.col("b").alias("coarse")).distinct())


def _linked(blocks: DataFrame) -> DataFrame:
    blocks = stored(blocks, "blocks", "zstd")
    total = blocks.agg(F.sum(F.octet_length("keys") + NODE_BYTES)).first()[0] or 0
    return blocks.repartition(tasks_for(blocks.sparkSession, total), "block").sortWithinPartitions("block").mapInArrow(_trees, "a bigint, b bigint")


def _as_block(name: Column) -> list[Column]:
    return [name.alias("block"), *[F.col(c) for c in _SET], F.lit(0).alias("side"), F.col("label")]


def set_links(sets: DataFrame, prefixes: DataFrame, tile_bytes: int) -> DataFrame:
    """Links (a, b) that give the components of ``sets`` (rid, n, keys, often), whose ``prefixes`` have rid and key."""
    alone = F.col("rid").alias("label")
    grouped = sets.select("*", alone).join(_coarse(prefixes.select("*", alone)), "rid")
    small, over = _by_weight(grouped, tile_bytes)
    fitting = small.select(*_as_block(F.col("coarse").cast("string")))
    if over.isEmpty():
        return _linked(fitting)
    large = stored(grouped.join(over, "coarse"), "large-groups")
    links = []
    for seed in range(SPREADS):
        tile = F.pmod(F.xxhash64(F.lit(seed), F.col("rid")), F.ceil(F.col("held") / tile_bytes))
        links.append(_linked(large.select(*_as_block(F.concat_ws("/", F.col("coarse").cast("string"), tile.cast("string"))))))
    known = components(reduce(DataFrame.unionByName, links))
    labels = large.select("rid").join(known.select(F.col("a").alias("rid"), F.col("b").alias("centre")), "rid", "left").select("rid", F.coalesce("centre", "rid").alias("label"))
    labels = stored(labels, "known-labels")
    marked = prefixes.join(labels, "rid")
    rest = large.drop("coarse", "held", "label").join(labels, "rid").join(_coarse(marked), "rid")
    small, over = _by_weight(rest, tile_bytes)
    blocks = small.select(*_as_block(F.concat(F.lit("again/"), F.col("coarse").cast("string"))))
    if not over.isEmpty():
        blocks = blocks.unionByName(_blocks(_by_key(rest.join(over, "coarse"), marked, tile_bytes), tile_bytes))
    return known.select("a", "b").unionByName(_linked(fitting.unionByName(blocks)))


def _by_key(large: DataFrame, prefixes: DataFrame, tile_bytes: int) -> DataFrame:
    """Groups that are still too large, dealt by the keys that sets of different labels share: a set goes to the parts of
    its own keys, so sets that share one meet."""
    parts = F.ceil(2 * F.col("held") / tile_bytes)
    sizes = large.select("rid", "coarse", parts.alias("parts"))
    own = prefixes.join(_between(prefixes).select("key"), "key").select("rid", "key").join(sizes, "rid")
    part = F.pmod(F.xxhash64("key"), F.col("parts")).cast("string")
    own = own.select("rid", F.concat_ws("/", F.lit("key"), F.col("coarse").cast("string"), part).alias("coarse")).distinct()
    return stored(own.join(large.select(*_SET, "label"), "rid"), "key-parts", "zstd")


def _blocks(sets: DataFrame, tile_bytes: int) -> DataFrame:
    """``sets`` has rid, n, keys, often, label and the coarse group; the result has a block and a side for each tree a set
    goes to."""
    sets = sets.withColumn("band", F.floor(F.log(1.25, F.col("n").cast("double")) + 1e-9))
    small, over = _by_weight(sets, tile_bytes)
    small = small.select(*_as_block(F.col("coarse").cast("string")))
    if over.isEmpty():
        return small
    large = sets.join(over.select("coarse"), "coarse")
    tiles = stored(large.groupBy("coarse", "band").agg(F.ceil(_weight() / (tile_bytes / 2)).cast("int").alias("k")), "tiles")
    near = tiles.select("coarse", (F.col("band") + 1).alias("band"), F.col("k").alias("k_below"))
    far = tiles.select("coarse", (F.col("band") - 1).alias("band"), F.col("k").alias("k_above"))
    plan = tiles.join(near, ["coarse", "band"], "left").join(far, ["coarse", "band"], "left").na.fill(0, ["k_below", "k_above"])
    dealt = large.join(plan, ["coarse", "band"]).withColumn("tile", F.pmod(F.xxhash64("rid"), F.col("k")).cast("int"))
    # Blocks within a band are named by two tiles, blocks of two bands by the lower band's tile and the upper band's.
    name = lambda low, i, high, j: F.concat_ws("/", F.col("coarse").cast("string"), low.cast("string"), i.cast("string"), high.cast("string"), j.cast("string"))
    band, tile = F.col("band"), F.col("tile")
    upto = lambda c: F.when(F.col(c) > 0, F.sequence(F.lit(0), F.col(c) - 1)).otherwise(F.array().cast("array<int>"))
    within = F.transform(upto("k"), lambda j: F.struct(name(band, F.least(tile, j), band, F.greatest(tile, j)).alias("block"), (tile > j).cast("int").alias("side")))
    above = F.transform(upto("k_above"), lambda j: F.struct(name(band, tile, band + 1, j).alias("block"), F.lit(0).alias("side")))
    below = F.transform(upto("k_below"), lambda j: F.struct(name(band - 1, j, band, tile).alias("block"), F.lit(1).alias("side")))
    spread = dealt.withColumn("to", F.explode(F.concat(within, above, below))).select("to.block", *_SET, "to.side", "label")
    return small.unionByName(spread)


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """One row per document row: ``id_col``, n_shingles, component_id (the least id that links lead to)."""
    rid, out, repeated = _labelled(docs, id_col, text_col, size, tile_bytes)
    if not repeated:
        return out.select(F.col("rid").cast(dict(docs.dtypes)[id_col]).alias(id_col), "n_shingles", F.col("label").cast(dict(docs.dtypes)[id_col]).alias("component_id"))
    out = docs.select(F.col(id_col), rid.alias("rid")).join(stored(out, "labels"), "rid")
    least = out.groupBy("label").agg(F.min(id_col).alias("component_id"))
    return out.join(least, "label").select(id_col, "n_shingles", "component_id")


def _labelled(docs: DataFrame, id_col: str, text_col: str, size: int, tile_bytes: int) -> tuple[Column, DataFrame, bool]:
    """The key of rows, a row of rid, n_shingles and label for each key, and whether keys are hashes of id and text because
    ids are repeated, null or no whole numbers; else a key is the id, and a label the least id."""
    whole = docs.schema[id_col].dataType.typeName() in ("long", "integer", "short", "byte")
    repeated = not whole or not docs.groupBy(id_col).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col(id_col).isNull()).isEmpty()
    rid = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("none")), F.col(text_col)) if repeated else F.col(id_col).cast("long")
    rows = docs.select(rid.alias("rid"), F.col(text_col).cast("binary").alias("text"))

    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bits = min(16, max(0, int(total // RANGE_TEXT_BYTES)).bit_length())
    counted = rows.mapInArrow(_deal(bits, size), _BLOCK_SQL).groupBy("r").applyInArrow(_count_shared(min(bits, 12)), _BLOCK_SQL)
    stats = stored(counted.groupBy("r").applyInArrow(_sum_up, _STATS), "shingle-counts")

    left = stats.where("n > 0 and 5 * alone <= n")
    groups = stored(left.groupBy("n", "d1", "d2").agg(F.min("rid").alias("rep")), "equal-sets")
    shingles = groups.agg(F.sum("n")).first()[0] or 0
    bits = min(16, max(0, int(shingles // RANGE_SHINGLES)).bit_length())
    texts = attached(rows, groups.select(F.col("rep").alias("rid")), "rid", "left_semi")
    texts = stored(texts.dropDuplicates(["rid"]) if repeated else texts, "similar-texts", "zstd")
    least = max(HOT_DOCUMENTS, shingles // HOT_SHINGLES)
    hot = texts.mapInArrow(_frequent(size), "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > least).toArrow()
    order = np.argsort(hot.column("token").to_numpy().view(_U))
    sent = docs.sparkSession.sparkContext.broadcast((hot.column("token").to_numpy().view(_U)[order], np.minimum(hot.column("n").to_numpy(), 65535).astype(np.uint16)[order]))
    ranked = texts.mapInArrow(_deal_again(bits, size, sent), _BLOCK_SQL).groupBy("r").applyInArrow(_ranked, "rid bigint, keys binary, often binary")
    lists = ranked.groupBy("rid").agg(F.collect_list(F.struct("keys", "often")).alias("parts")).join(groups.select(F.col("rep").alias("rid"), "n"), "rid")
    sets = stored(lists.select("rid", "n", "parts").mapInArrow(_ordered, "rid bigint, n bigint, keys binary, often binary"), "ordered-sets")

    prefixes = stored(sets.mapInArrow(_prefixes, "rid bigint, key bigint"), "prefixes")
    linked = components(set_links(sets, prefixes, tile_bytes))

    labels = groups.join(linked.select(F.col("a").alias("rep"), F.col("b").alias("label")), "rep", "left").select("n", "d1", "d2", F.coalesce("label", "rep").alias("label"))
    out = stats.join(labels, ["n", "d1", "d2"], "left").select("rid", F.col("n").alias("n_shingles"), F.coalesce("label", "rid").alias("label"))
    return rid, out, repeated


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with its columns: the one with the least id (null is the last), then the least hash of id
    and text; of rows with equal id and text, any one."""
    rid, out, repeated = _labelled(docs, id_col, text_col, WORDS, TILE_BYTES)
    key = "_key_of_row"
    if not repeated:
        keep = out.where("rid = label").select(F.col("rid").alias(key))
        return docs.join(keep, rid == keep[key], "left_semi")
    rows = docs.withColumn(key, rid).dropDuplicates([key])
    found = rows.select(F.col(id_col).alias("id"), F.col(key).alias("rid")).join(stored(out, "labels"), "rid")
    keep = found.groupBy("label").agg(F.min(F.struct(F.col("id").isNull(), "id", "rid")).alias("least")).select(F.col("least.rid").alias(key))
    return rows.join(keep, key, "left_semi").select(*[rows[c] for c in docs.columns])
