r"""SentencePiece encoding and decoding: N-best segmentations over the piece lattice.

A text becomes its lattice string as the model file's normaliser has it: a
dummy space in front, spaces as U+2581, nothing else changed.  Arcs are the
model's pieces with their scores; a character that is no piece is one arc of
its byte pieces, scored UNKNOWN below the lowest piece for each byte.

Forward Viterbi gives each position the best score of the text before it.  A
backward A* search from the end then uses these scores as its heuristic; they
are exact, so complete segmentations are popped in order of their score.

Where two neighbouring characters stand side by side in no piece, no arc
crosses: that place is a cut node.  (So it is before each run of spaces and at
line breaks.)  The units between cut nodes are searched once and kept; the best
segmentations of a whole text combine those of its units: only the N-1
occurrences whose second-best loses least can differ from the best in any of
the N best, so these are merged exactly, and their other segmentations are
spliced into the best one: the piece ids of all N are returned.

Decoding joins the pieces, bytes for byte pieces, and takes off the dummy
space.  ``round_trip`` decodes the ids of each of a document's N segmentations
and compares the bytes with the whole text; a text that holds U+2581 itself
comes back with spaces in its place.

Scale: map-only over whole texts; units are hashed on whole blocks, a block's
distinct units are looked up once and the cache is bounded.

Defined cases: null and empty texts have no pieces, score 0 and one (empty)
segmentation; rows are independent, so repeated rows, null doc_ids and empty
tables are no special case; only the text column is read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from . import _text as X
from ._stage import free_name

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
N = 3
#: a byte piece counts this much less than the lowest scored piece
UNKNOWN = 10.0
#: scores at or below are marks of pieces the model never wants; they are kept as they are
NEVER = -1e8
#: units that a worker keeps
CACHE = 100_000
#: bytes of texts that are searched at once (a longer text alone)
TEXT_BYTES = 1 << 19


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Known:
    """Units found so far, as arrays in order of their hashes: some fifty bytes a unit, a seventh of what Python objects take.

    A worker process keeps them beside what its later tasks need, so they are
    held small.  Beyond ``2 * size`` units the ``size`` last used stay.
    """

    def __init__(self, size: int = CACHE):
        self.size, self.round = size, 0
        self.keys = np.zeros(0, np.uint64)
        self.values = np.zeros((2, 0))  # best score, what the second-best loses
        self.pieces, self.used = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.start, self.ids = np.zeros(0, np.int64), bytearray()

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``keys`` are known, their places)."""
        at = np.searchsorted(self.keys, keys)
        hit = np.zeros(len(keys), bool)
        inner = at < len(self.keys)
        hit[inner] = self.keys[at[inner]] == keys[inner]
        self.round += 1
        self.used[at[hit]] = self.round
        return hit, at[hit]

    def spelled(self, at: np.ndarray) -> list[bytearray]:
        start = self.start[at]
        ids = self.ids
        return [ids[a:b] for a, b in zip(start.tolist(), (start + 4 * self.pieces[at]).tolist(), strict=True)]

    def add(self, units: dict[int, tuple]) -> None:
        """Takes over ``units`` (key -> as ``Lattice.unit``), none of them known."""
        if not units:
            return
        keys = np.array(list(units), np.uint64)
        order = np.argsort(keys)
        best, loss, pieces, ids = (list(x) for x in zip(*units.values(), strict=True))
        pieces = np.array(pieces, np.int32)
        start = len(self.ids) + 4 * (np.cumsum(pieces, dtype=np.int64) - pieces)
        self.ids += b"".join(ids)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.values = np.insert(self.values, at, np.array([best, loss])[:, order], axis=1)
        self.pieces, self.start = np.insert(self.pieces, at, pieces[order]), np.insert(self.start, at, start[order])
        self.used = np.insert(self.used, at, self.round)

    def trim(self) -> None:
        if len(self.keys) > 2 * self.size:
            keep = np.sort(np.argpartition(-self.used, self.size)[: self.size])
            ids = self.spelled(keep)
            self.keys, self.values, self.pieces, self.used = self.keys[keep], self.values[:, keep], self.pieces[keep], self.used[keep]
            self.start, self.ids = 4 * (np.cumsum(self.pieces, dtype=np.int64) - self.pieces), bytearray().join(ids)


class Lattice:
    """Pieces and scores of the model at ``path``."""

    def __init__(self, path: str, best: int = N):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.best = best
        self.piece = [model.id_to_piece(i) for i in range(size)]
        self.byte_of = {i: int(self.piece[i][1:-1], 16) for i in range(size) if model.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.silent = {i for i in range(size) if model.is_control(i)}
        for i in range(size):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.score[self.piece[i]], self.id[self.piece[i]] = model.get_score(i), i
        self.unknown = min(s for s in self.score.values() if s > NEVER) - UNKNOWN
        self.longest = max(map(len, self.score))
        self.trie = {p[:k]: None for p in self.score for k in range(1, len(p) + 1)}
        self.trie.update({p: (s, (self.id[p],)) for p, s in self.score.items()})
        self.steps = self._steps()
        self.joined = self._joined()
        self.spelling = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.silent else self.piece[i].replace(SPACE, " ").encode() for i in range(size)]
        self.units: dict[int, tuple] = {}
        self.known = Known()

    def _steps(self) -> dict[str, tuple]:
        """The pieces character by character: character -> (score, ids, the characters after it); ids are None in the midst of a piece."""
        after: dict[str, dict] = {"": {}}
        for p in sorted(self.trie, key=len, reverse=True):  # longer ones first, so that a node's followers are complete
            hit = self.trie[p]
            after.setdefault(p[:-1], {})[p[-1]] = (*(hit or (0.0, None)), after.get(p))
        return after[""]

    def _joined(self) -> np.ndarray:
        """Whether an arc may cross between two bytes; never less than true, exact for ASCII (a space stands for U+2581)."""
        table = np.zeros((256, 256), bool)
        table[128:, 128:] = True
        code = lambda c: 32 if c == SPACE else ord(c) if ord(c) < 128 else 128
        for p in self.score:
            for x, y in zip(p, p[1:]):
                table[slice(128, 256) if code(x) == 128 else code(x), slice(128, 256) if code(y) == 128 else code(y)] = True
        # U+2581 itself may stand in a text, so a byte beyond ASCII may be one
        table[128:] |= table[32]
        table[:, 128:] |= table[:, 32:33]
        return table

    def arcs(self, text: str) -> tuple[list[float], list[tuple[int, int, float, tuple[int, ...]]]]:
        """Viterbi: best score of each prefix, all arcs (start, end, score, ids) by start."""
        n = len(text)
        trie, longest = self.trie, self.longest
        best = [float("-inf")] * (n + 1)
        best[0] = 0.0
        arcs: list = []
        for i in range(n):
            here, single = best[i], False
            for j in range(i + 1, min(n, i + longest) + 1):
                try:
                    hit = trie[text[i:j]]
                except KeyError:
                    break
                if hit is not None:
                    if j == i + 1:
                        single = True
                    v, ids = hit
                    arcs.append((i, j, v, ids))
                    best[j] = max(best[j], here + v)
            if not single:
                data = text[i].encode("utf-8", "replace")
                arc = (i, i + 1, self.unknown * len(data), tuple([self.byte_id[b] for b in data]))
                arcs.append(arc)
                best[i + 1] = max(best[i + 1], here + arc[2])
        return best, arcs

    def search(self, text: str, best: int | None = None) -> list[tuple[float, tuple[int, ...]]]:
        """The ``best`` segmentations of a lattice string, best first; equal scores in order of their ids."""
        bound, arcs = self.arcs(text)
        into: list[list] = [[] for _ in bound]
        for start, end, v, ids in arcs:
            into[end].append((start, v, ids))
        heap = [(-bound[len(text)], 0, len(text), 0.0, None)]
        out = []
        want = best or self.best
        seen = [0] * len(bound)
        pushed = itertools.count(1)
        while heap and len(out) < want:
            cost, _, at, behind, path = heapq.heappop(heap)
            if at == 0:
                ids: list[int] = []
                while path:
                    ids += path[0]
                    path = path[1]
                out.append((-cost, tuple(ids)))
                continue
            if seen[at] == want:  # as many ways on from here, none of them worse, are known
                continue
            seen[at] += 1
            for start, v, ids in into[at]:
                gone = behind + v
                heapq.heappush(heap, (-(gone + bound[start]), next(pushed), start, gone, (ids, path)))
        return out

    def lattice_string(self, text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def decode(self, ids) -> str:
        """Text of a list of piece ids."""
        return self.spell(ids).decode("utf-8", "replace")

    def spell(self, ids) -> bytes:
        """Bytes of a list of piece ids, without the dummy space."""
        spelling = self.spelling
        return b"".join([spelling[i] for i in ids]).removeprefix(b" ")

    def unit(self, key: int, text: str) -> tuple[float, float, int, bytes]:
        """(best score, what the second-best loses, pieces, ids of the best); ``units`` holds it until ``Known.add`` takes it over.

        Viterbi with the two best scores of each prefix.
        """
        n = len(text)
        roots = self.steps
        low = float("-inf")
        first, second = [low] * (n + 1), [low] * (n + 1)
        origin, spelled = [0] * (n + 1), [()] * (n + 1)
        first[0] = 0.0
        for i, c in enumerate(text):
            here, other = first[i], second[i]
            node = roots.get(c)
            if node is None or node[1] is None:  # no piece of one character
                data = c.encode("utf-8", "replace")
                node = (self.unknown * len(data), tuple([self.byte_id[x] for x in data]), None if node is None else node[2])
            j = i
            while node is not None:
                v, ids, after = node
                j += 1
                if ids is not None:
                    top = here + v
                    was = first[j]
                    if top > was:
                        first[j], origin[j], spelled[j] = top, i, ids
                        next_best = other + v
                        second[j] = was if was > next_best else next_best
                    elif top > second[j]:
                        second[j] = top
                if after is None or j == n:
                    break
                node = after.get(text[j])
        at, path = n, []
        while at:
            path.append(spelled[at])
            at = origin[at]
        ids = [x for part in reversed(path) for x in part]
        found = (first[n], first[n] - second[n], len(ids), array("i", ids).tobytes())
        self.units[key] = found
        return found


def units(raw: np.ndarray, offsets: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of the units of a block, in order."""
    cut = np.ones(len(raw), bool)
    cut[1:] = ~joined[raw[:-1], raw[1:]]
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], len(raw)), np.searchsorted(offsets, starts, "right") - 1


def with_dummy(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block with a space in front of each text that is not empty."""
    filled = np.flatnonzero(offsets[:-1] < offsets[1:])
    shift = np.zeros(len(offsets), np.int64)
    shift[filled + 1] = 1
    return np.insert(raw, offsets[:-1][filled], 32), offsets + np.cumsum(shift)


def merge(best: float, options: list[list[tuple[float, bytes]]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best (total, choice of each unit) when each of a few units may take any of its (change of score, ids) instead of its best, which is its first."""
    ways = itertools.product(*[range(len(o)) for o in options])
    totals = sorted((-(best + sum(o[k][0] for o, k in zip(options, way, strict=True))), way) for way in ways)
    return [(-total, way) for total, way in totals[:n]]


@lru_cache(maxsize=1)
def searcher(path: str, n: int = N):
    """Function of a text block giving ids, n_pieces, scores (best first), whether decoding gives the text back, and the ids of all n segmentations.

    A worker process keeps it, and with it the units searched so far, for its next tasks.
    """
    lattice = Lattice(path, n)

    def encode(raw: np.ndarray, offsets: np.ndarray) -> list:
        docs = len(offsets) - 1
        whole, ends = raw.tobytes(), offsets.tolist()
        raw, offsets = with_dummy(raw, offsets)
        a, b, doc = units(raw, offsets, lattice.joined)
        bounds = np.searchsorted(doc, np.arange(docs + 1))
        if not len(doc):
            none = np.zeros(0, np.int32)
            return [[none] * docs, [0] * docs, [[0.0]] * docs, [True] * docs, [[none]] * docs]
        distinct, first, back = np.unique(X.span_hash(X.prefix_hash(raw), a, b), return_index=True, return_inverse=True)
        data, make = raw.tobytes(), lattice.unit
        text = lambda k: data[a[first[k]] : b[first[k]]].decode("utf-8", "replace").replace(" ", SPACE)
        known = lattice.known
        hit, _ = known.find(distinct)
        for k in np.flatnonzero(~hit).tolist():
            make(int(distinct[k]), text(k))
        known.add(lattice.units)
        lattice.units = {}
        at = np.searchsorted(known.keys, distinct)
        (top, second), count, spelled = known.values[:, at], known.pieces[at].astype(np.int64), known.spelled(at)
        known.trim()
        ranked: dict[int, list[tuple[float, bytes]]] = {}

        def choices(k: int) -> list[tuple[float, bytes]]:
            """(change of score, ids) of the n best segmentations of a unit; the one in ``spelled`` is the first, also among equals."""
            if k not in ranked:
                ways = [(s, array("i", ids).tobytes()) for s, ids in lattice.search(text(k), n)]
                ranked[k] = [(0.0, spelled[k]), *((min(s - ways[0][0], 0.0), ids) for s, ids in ways if ids != spelled[k])][:n]
            return ranked[k]

        out_ids, out_n, out_scores, out_ok, out_all = [], [], [], [], []
        for d, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            mine = back[lo:hi]
            loss = second[mine]
            near = np.argsort(loss, kind="stable")[: n - 1] if len(loss) <= 4 * n else np.argpartition(loss, n - 1)[: n - 1]
            near = np.sort(near[np.isfinite(loss[near])])
            options = [choices(int(k)) for k in mine[near].tolist()]
            merged = merge(float(top[mine].sum()), options, n)
            best = b"".join([spelled[i] for i in mine.tolist()])
            until = 4 * np.cumsum(count[mine])
            places = [(int(until[i]) - len(o[0][1]), int(until[i])) for i, o in zip(near.tolist(), options, strict=True)]
            every = []
            for _, way in merged:
                parts, at = [], 0
                for (start, end), o, k in zip(places, options, way, strict=True):
                    if k:
                        parts += [best[at:start], o[k][1]]
                        at = end
                every.append(np.frombuffer(b"".join([*parts, best[at:]]), np.int32))
            mine_text = whole[ends[d] : ends[d + 1]]
            out_ids.append(every[0])
            out_n.append(len(every[0]))
            out_scores.append([total for total, _ in merged])
            out_ok.append(all([lattice.spell(ids.tolist()) == mine_text for ids in every]))
            out_all.append(every)
        return [out_ids, out_n, out_scores, out_ok, out_all]

    return encode


def encoder(path: str, n: int = N):
    """As ``searcher``, without the ids of all n segmentations."""
    search = searcher(path, n)
    return lambda raw, offsets: search(raw, offsets)[:4]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(i) for i in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int32)))


def _with(docs: DataFrame, path: str | None, n: int, keep: list[str], name: str, digest: bool, text: str = "text") -> DataFrame:
    path = path or model_path()
    fields = T.StructType([T.StructField("ids_sha256", T.StringType()) if digest else T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_pieces", T.LongType()), T.StructField("scores", T.ArrayType(T.DoubleType())), T.StructField("round_trip", T.BooleanType()),
                           T.StructField("nbest_sha256", T.ArrayType(T.StringType())) if digest else T.StructField("nbest", T.ArrayType(T.ArrayType(T.IntegerType())))])

    def make():
        search = searcher(path, n)

        def run(raw, offsets):
            ids, *rest, every = search(raw, offsets)
            if digest:
                every = [[hashlib.sha256(i.tobytes()).hexdigest() for i in one] for one in every]
                return [[one[0] for one in every], *rest, every]
            ends = np.concatenate([[0], np.cumsum([len(one) for one in every])]).astype(np.int32)
            return [_lists(ids), *rest, pa.ListArray.from_arrays(pa.array(ends), _lists([i for one in every for i in one]))]

        return run

    return X.map_text(docs, text, keep, fields, name, make, TEXT_BYTES)


def encode(docs: DataFrame, path: str | None = None, n: int = N) -> DataFrame:
    """doc_id, ids of the best segmentation, its number of pieces, the n best scores, round_trip, ids of the n best segmentations."""
    return _with(docs, path, n, ["doc_id"], "enc", False).select("doc_id", "enc.*")


def encode_digest(docs: DataFrame, path: str | None = None, n: int = N) -> DataFrame:
    """As ``encode``, with SHA-256s of the ids (little-endian 32-bit) in place of the ids."""
    return _with(docs, path, n, ["doc_id"], "enc", True).select("doc_id", "enc.*")


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """Rows of ``encoded``, all columns, with the text of the piece ids in a new column ``text`` (null ids: null)."""
    path = path or model_path()
    name = free_name(encoded, "text")
    schema = T.StructType([*encoded.schema.fields, T.StructField(name, T.StringType())])

    def run(batches):
        lattice = Lattice(path, 1)
        for batch in batches:
            texts = [None if x is None else lattice.decode(x) for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name])

    return encoded.mapInArrow(run, schema)
