"""Vectors of several widths, and pages with very many opening tags."""

import re
import time

import numpy as np
import pytest

from ledgerline.llm import nearest, warc


def test_each_width_is_searched_by_itself(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(w).tolist()) for i, w in enumerate([2] * 41 + [3] * 66 + [5])]
    rows += [(200, [0.0, 0.0, 0.0]), (220, None), (240, [1.0, None]), (260, [float("inf"), 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    made = {}
    for r in nearest.every_twentieth(frame).orderBy("query_id", "rank").collect():
        made.setdefault(r.query_id, []).append((r.vec_id, r.score))
    usable = {i: np.array(v) for i, v in rows if i < 200}
    for query in (i for i in usable if i % 20 == 0):
        others = [(i, float((v * usable[query]).sum())) for i, v in usable.items() if i != query and len(v) == len(usable[query])]
        best = sorted(others, key=lambda x: (-x[1], x[0]))[:20]
        assert [i for i, _ in made[query]] == [i for i, _ in best]
        assert [s for _, s in made[query]] == pytest.approx([s for _, s in best], rel=1e-12)
    assert set(made) == {0, 20, 40, 60, 80, 100}


@pytest.mark.parametrize("page", ["", "<title>a</title>", "<TITLE x=1>a<b>\n</title >", "<title>a<title>b</title>c</title>", "<title>a", "</title><title>b</title>", "<titles>a</title>"])
def test_title_is_what_the_whole_pattern_finds(page):
    whole = re.search(r"<title\b[^<>]*>(.*?)</title\s*>", page, re.S | re.I)
    assert warc.title_of(page) == (whole[1] if whole else "")


def test_a_megabyte_of_open_titles_takes_no_time():
    start = time.perf_counter()
    assert warc.title_of("<title>" * 150_000) == ""
    assert time.perf_counter() - start < 1
