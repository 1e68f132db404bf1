"""Runs of spaces against the best path of the whole text."""

import pytest

from ledgerline.llm import pieces


@pytest.fixture(scope="module")
def coder():
    return pieces.Encoder(pieces.read_model())


@pytest.mark.parametrize("n", [1, 2, *range(3, 21), 40, 100])
def test_runs_of_marks_take_the_best_path(coder, n):
    gap = " " * n
    decoder = pieces.Decoder(coder.model)
    for text in (f"a{gap}b", f"end{gap}", f"{gap}start", f"x{gap}\ny", f"def f():\n{gap}return x", f"({gap}) |{gap}| 日{gap}本", gap):
        assert coder.ids(text) == coder.model.best_path("▁" + text.replace(" ", "▁"))
        assert decoder.decode(coder.ids(text)) == text


def test_pieces_of_marks_alone_are_chosen(coder):
    model = coder.model
    spans = {p for i, p in enumerate(model.pieces) if len(p) > 1 and not p.strip("▁") and i not in model.reserved}
    assert spans
    for p in spans:
        assert len(coder.ids("a" + " " * len(p) + "\n")) < len(p) + 2
