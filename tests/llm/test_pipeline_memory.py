"""Workers are reused by the pipeline's later steps: what the SentencePiece step keeps in them is small, and loses no unit."""

import random

import numpy as np

from tidemark.llm import sentencepiece_nbest as S


def _block(rng, n):
    texts = [" ".join("".join(rng.choice("aeinrstlé") for _ in range(rng.randrange(2, 9))) for _ in range(60)) for _ in range(n)]
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def _size(x, seen):
    import sys
    if id(x) in seen:
        return 0
    seen.add(id(x))
    own = sys.getsizeof(x)
    if isinstance(x, dict):
        own += sum(_size(k, seen) + _size(v, seen) for k, v in x.items())
    elif isinstance(x, (tuple, list)):
        own += sum(_size(v, seen) for v in x)
    return own


def test_units_are_kept_in_few_bytes_and_forgotten_ones_come_out_alike(monkeypatch):
    rng = random.Random(1)
    blocks = [_block(rng, 40) for _ in range(6)]
    kept = []
    monkeypatch.setattr(S, "Lattice", lambda *a, make=S.Lattice, **k: kept.append(make(*a, **k)) or kept[-1])
    S.searcher.cache_clear()
    want = [S.searcher(S.model_path())(*b) for b in blocks]
    lattice = kept[-1]
    known = lattice.known
    assert not lattice.units and len(known.keys) > 5000 and (np.diff(known.keys.astype(object)) > 0).all()
    held = sum(a.nbytes for a in (known.keys, known.values, known.pieces, known.used, known.start)) + len(known.ids) + _size(lattice.units, set())
    assert held < 80 * len(known.keys)
    known.size = 500  # far fewer than a block has: units are found anew, within one block none is lost
    for (raw, offsets), w in zip(blocks + blocks, want + want):
        got = S.searcher(S.model_path())(raw, offsets)
        assert len(known.keys) <= 1000 and got[1:4] == w[1:4]
        assert all((a == b).all() for a, b in zip(got[0], w[0])) and all((a == b).all() for x, y in zip(got[4], w[4]) for a, b in zip(x, y))
    S.searcher.cache_clear()
