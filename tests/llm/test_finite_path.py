"""The path of finite weight is found without walking from every position."""

import random

import public_tokenizers
import pytest

from terrapix.llm import op4_sentencepiece as op4


class Counted(dict):
    asked = 0

    def get(self, *args):
        Counted.asked += 1
        return dict.get(self, *args)


@pytest.mark.parametrize("model", ["piece_bpe_32k.model"])
def test_depth_first_finds_the_same_path_with_fewer_arcs(model):
    fst = op4.Transducer(public_tokenizers.path(model))
    assert fst.kind == op4.BPE and fst.spelled
    fst.arcs = Counted(fst.arcs)
    rng = random.Random(3)
    pieces = sorted(p for p in fst.ids if len(p) > 1)
    words = ["", "▁", "a", "\U0001f9ff", "▁x\U0001f9ffy", "a" * 300, "▁" * 40, "ab" * 100,
             *["".join(rng.choice("etaoinshrdlu0.,é中▁") for _ in range(rng.randrange(1, 30))) for _ in range(1500)],
             *["▁" + "".join(rng.sample(pieces, 3)).replace("▁", "") for _ in range(1500)]]

    def all_paths():
        fst.pairs.clear()
        Counted.asked = 0
        return [fst.path(w) for w in words], Counted.asked
    paths, asked = all_paths()
    fst.spelled = False  # every position, from left to right
    by_position, more = all_paths()
    assert paths == by_position
    assert all("".join(p) == w for p, w in zip(paths, words))
    assert asked < 0.7 * more, (asked, more)
