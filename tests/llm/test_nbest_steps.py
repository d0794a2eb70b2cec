"""op9: the search walks the pieces character by character; units come out as from the A* search."""

import random

import numpy as np

from tidemark.llm import sentencepiece_nbest as S


def test_steps_hold_every_piece_and_units_equal_the_search():
    lattice = S.Lattice(S.model_path())
    for p, v in lattice.score.items():
        node, after = None, lattice.steps
        for c in p:
            node = after[c]
            after = node[2]
        assert node[:2] == (v, (lattice.id[p],))
    rng = random.Random(4)
    for k in range(300):
        text = "".join(rng.choice("▁aeinrst,.Zñö漢😀\u0007￿") for _ in range(rng.randrange(1, 14)))
        best, loss, pieces, ids = lattice.unit(-k - 1, text)
        ways = lattice.search(text, 2)
        assert abs(best - ways[0][0]) < 1e-6 * max(1, abs(best)) and pieces == len(ids) // 4
        assert np.frombuffer(ids, np.int32).tolist() in [list(i) for s, i in ways if s == ways[0][0]]
        if len(ways) > 1:
            assert abs(loss - (ways[0][0] - ways[1][0])) < 1e-6 * max(1, abs(best))
        else:
            assert loss == float("inf")
