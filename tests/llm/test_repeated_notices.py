"""Notices that stand in a text more than once."""

import pytest

from ledgerline.llm import licenses
from ledgerline.llm.license_texts import NOTICES


@pytest.mark.parametrize("name, must, notice", NOTICES)
@pytest.mark.parametrize("between", ["\n", "\n\nint main() { return the_first + 2; }\n", "\n" + "some other code of this file, " * 12])
@pytest.mark.parametrize("times", [2, 3, 5])
@pytest.mark.parametrize("around", ["", "words of its own "])
def test_each_copy_is_found(name, must, notice, between, times, around):
    text = around + between.join([notice] * times) + " " + around
    found = licenses.found_in(text, licenses.templates(), licenses.COVERAGE)
    assert [f[0] for f in found] == [name] * times and all(f[1] >= 0.95 for f in found)
    assert all(b[2] >= a[3] for a, b in zip(found, found[1:], strict=False))


def test_edited_copies_are_found():
    for name, _, notice in (n for n in NOTICES if len(n[2].split()) > 60):
        words = notice.split()
        one = " ".join(words[:9] + ["or", "so"] + words[11:])
        two = " ".join(words[: len(words) - 6])
        three = " ".join(w for i, w in enumerate(words) for w in ([w, "rem"] if i % 9 == 8 else [w]))
        found = licenses.found_in(f"{one} {two} {three} {one}", licenses.templates(), licenses.COVERAGE)
        assert [f[0] for f in found] == [name] * 4, name


def test_a_long_gap_without_unique_words_is_aligned():
    a = [w for w in "abcdefghijklmnopqrstuvwxyz" for _ in range(2)]
    pairs = licenses.aligned(["x", "x", *a], [*a, "y", "y"])
    assert len(pairs) == len(a)


def test_a_bsd_text_of_three_clauses_is_no_bsd_2():
    three = next(n for _, m, n in NOTICES if "endorse" in m)
    tail = " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""
    (found,) = licenses.found_in(f"Copyright (c) 2020 Someone\n{three}{tail}", licenses.templates(), licenses.COVERAGE)
    assert found[0] == "BSD-3-Clause" and found[1] == 1
