r"""Token counts by a finite-state tokenizer compiled from a public BPE vocabulary file.

White space ends every pretoken of this vocabulary and nothing reaches across
it, so ASCII white space synchronises the transducer: its state behind a space
is always the start state.  Between two spaces it is the word read so far.
Transitions inside a word emit nothing, because a later byte can still change
the merges; the transition that leaves a word emits the word's token count,
which is computed on first use (normalise, split, merge by rank) and kept.

A chunk of text, cut anywhere, maps a state to a state: the part before its
first white space finishes the word that was open (``head``), the closed words
inside have a known count, the part after its last white space stays open
(``tail``).  Such maps compose associatively, so the chunks of a long text
are mapped independently and combined by a parallel prefix scan.  Texts up to
CHUNK bytes are one chunk.

Scale: map-only.  Words are hashed on whole blocks; the transducer runs once a
distinct word of a block and its cache is bounded.

Defined cases: null and empty texts have no bytes and no tokens; special
strings inside a text count as the one token that the vocabulary's library
makes of them; rows are independent, so repeated rows, null doc_ids and empty
tables are no special case; only doc_id and text are read.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from . import _text as X

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
CHUNK = 1 << 16
CACHE = 400_000
END = "</w>"
_GAP = b" \t\n\x0b\x0c\r"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTransducer:
    """Counts the tokens of white-space-free text; compiled from the file at ``path``, extended word by word."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"])
        self.rank = {p: i for i, p in enumerate(pairs)}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split).findall
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.hints = special
        self.letter = self._byte_letters()
        self.space = regex.compile(r"[\s\x85]+")
        self.pretoken: dict[str, int] = {}
        self.word: dict[bytes, int] = {}

    @staticmethod
    def _byte_letters() -> list[str]:
        """Printable stand-ins of the 256 bytes, the usual byte-level alphabet."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        out, extra = [""] * 256, 256
        for b in range(256):
            if b in plain:
                out[b] = chr(b)
            else:
                out[b] = chr(extra)
                extra += 1
        return out

    def merged(self, piece: str) -> int:
        """Number of symbols left of ``piece`` when no merge applies; lowest rank first, leftmost first."""
        symbols = [self.letter[b] for b in piece.encode("utf-8")]
        symbols[-1] += END
        rank = self.rank
        n = len(symbols)
        if n > 48:
            return self._merged_long(symbols)
        while n > 1:
            best, at = None, -1
            for i in range(n - 1):
                r = rank.get((symbols[i], symbols[i + 1]))
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            n -= 1
        return n

    def _merged_long(self, symbols: list[str]) -> int:
        n = len(symbols)
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := rank.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i] if symbols[i] is not None else n
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = a + b, None
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
            left -= 1
            for k in (prev[i], i):
                if k >= 0 and nxt[k] < n and (r := rank.get((symbols[k], symbols[nxt[k]]))) is not None:
                    heapq.heappush(heap, (r, k, symbols[k], symbols[nxt[k]]))
        return left

    def _plain(self, text: str) -> int:
        if not text.isascii():
            text = "".join(c.lower() for c in self.space.sub(" ", unicodedata.normalize("NFC", text)))
        else:
            text = text.lower()
        total, known = 0, self.pretoken
        for piece in self.pieces(text):
            n = known.get(piece)
            if n is None:
                if len(known) >= CACHE:
                    known.clear()
                n = known[piece] = self.merged(piece)
            total += n
        return total

    def emit(self, word: bytes) -> int:
        """Tokens emitted by the transition that ends ``word``."""
        n = self.word.get(word)
        if n is None:
            text = word.decode("utf-8", "replace")
            if self.special is not None and any(h in text for h in self.hints):
                n, at = 0, 0
                for m in self.special.finditer(text):
                    n += 1 + self._plain(text[at : m.start()])
                    at = m.end()
                n += self._plain(text[at:])
            else:
                n = self._plain(text)
            if len(self.word) >= CACHE:
                self.word.clear()
            self.word[word] = n
        return n


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to the transducer's state; ``closed``: it holds white space."""

    head: bytes
    count: int
    tail: bytes
    closed: bool

    def then(self, after: ChunkMap, emit) -> ChunkMap:
        """Map of this chunk followed by ``after`` (associative)."""
        if not self.closed and not after.closed:
            return ChunkMap(self.head + after.head, 0, b"", False)
        if not self.closed:
            return ChunkMap(self.head + after.head, after.count, after.tail, True)
        if not after.closed:
            return ChunkMap(self.head, self.count, self.tail + after.head, True)
        word = self.tail + after.head
        return ChunkMap(self.head, self.count + (emit(word) if word else 0) + after.count, after.tail, True)

    def finish(self, emit) -> int:
        """Tokens from the start state, with the word still open closed."""
        return self.count + sum(emit(w) for w in (self.head, self.tail) if w)


def chunk_map(chunk: bytes, total) -> ChunkMap:
    """Map of one chunk; ``total`` counts the tokens of closed text."""
    gaps = [i for g in _GAP if (i := chunk.find(g)) >= 0]
    if not gaps:
        return ChunkMap(chunk, 0, b"", False)
    first, last = min(gaps), max(chunk.rfind(g) for g in _GAP)
    return ChunkMap(chunk[:first], total(chunk[first:last]), chunk[last + 1 :], True)


def scan(maps: list[ChunkMap], emit) -> ChunkMap:
    """Composition of all maps by pairwise rounds, as a parallel scan combines them."""
    while len(maps) > 1:
        pairs = [maps[i].then(maps[i + 1], emit) for i in range(0, len(maps) - 1, 2)]
        maps = pairs + maps[len(maps) & ~1 :]
    return maps[0] if maps else ChunkMap(b"", 0, b"", False)


def counter(path: str, chunk: int = CHUNK):
    """Function of a text block giving n_bytes and n_tokens of each document."""
    machine = WordTransducer(path)

    def closed(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        docs = len(offsets) - 1
        starts, ends, doc = X.span_words(raw, offsets, X.SPACED)
        if not len(starts):
            return np.zeros(docs, np.int64)
        _, first, back = np.unique(X.span_hash(X.prefix_hash(raw), starts, ends), return_index=True, return_inverse=True)
        data, emit = raw.tobytes(), machine.emit
        emitted = np.array([emit(data[a:b]) for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], np.int64)
        total = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(emitted[back], out=total[1:])
        bounds = np.searchsorted(doc, np.arange(docs + 1))
        return total[bounds[1:]] - total[bounds[:-1]]

    def span(data: bytes) -> int:
        return int(closed(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0])

    def count(raw: np.ndarray, offsets: np.ndarray) -> list:
        sizes = np.diff(offsets)
        if len(sizes) == 1 and sizes[0] > chunk:
            data = raw.tobytes()
            maps = [chunk_map(data[i : i + chunk], span) for i in range(0, len(data), chunk)]
            return [sizes, [scan(maps, machine.emit).finish(machine.emit)]]
        return [sizes, closed(raw, offsets)]

    return count


FIELDS = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """Bytes and tokens of every row of ``docs``."""
    path = path or vocabulary_path()

    def make():
        run = counter(path, chunk)

        def parts(raw, offsets):  # a long document is a block of its own, so that its chunks are scanned
            sizes = np.diff(offsets)
            if len(sizes) == 1 or not (sizes > chunk).any():
                return run(raw, offsets)
            cuts = np.unique(np.concatenate([np.flatnonzero(sizes > chunk), np.flatnonzero(sizes > chunk) + 1, [0, len(sizes)]]))
            done = [run(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            return [np.concatenate([d[i] for d in done]) for i in range(2)]

        return parts

    return X.map_text(docs, "text", ["doc_id"], FIELDS, "c", make).select("doc_id", "c.*", (F.col("c.n_tokens") > limit).alias("over_limit"))
