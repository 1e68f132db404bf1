"""License scan by patience alignment.

A document that shares runs of words with a template is cut into occurrences by chains of
those runs, and aligned with the template around each chain. Between the runs,
words that occur once in both are anchors, the longest increasing subsequence of
their places keeps those in one order, and the gaps between them are aligned the
same way. The share of the template's words that are aligned is the coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_texts, texts
from ledgerline.llm.contamination import numbered, runs
from ledgerline.llm.license_texts import NOTICES

RUN = 3
COVERAGE = 0.8
WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Template:
    license: str
    must: frozenset[str]
    words: tuple[str, ...]

    @cached_property
    def runs(self) -> frozenset[tuple[str, ...]]:
        n = min(RUN, len(self.words))
        return frozenset(self.words[i : i + n] for i in range(len(self.words) - n + 1))


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def templates(notices=NOTICES) -> list[Template]:
    return [Template(name, frozenset(must.split()), tuple(words_of(text))) for name, must, text in notices]


def increasing(places: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence: each value goes on the leftmost pile whose top is not smaller."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, v in enumerate(places):
        at = bisect_left(tops, v)
        back.append(piles[at - 1] if at else -1)
        tops[at : at + 1] = [v]
        piles[at : at + 1] = [i]
    out = []
    i = piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def _common(a: list, b: list) -> list[tuple[int, int]]:
    """Longest common subsequence of a gap without unique words."""
    n, m = len(a), len(b)
    number = {w: k for k, w in enumerate(dict.fromkeys(b))}
    of_b = np.array([number[w] for w in b])
    best = np.zeros((n + 1, m + 1), np.int32)
    for i in range(n - 1, -1, -1):
        row = np.maximum(best[i + 1, :-1], best[i + 1, 1:] + (of_b == number.get(a[i], -1)))
        best[i, :-1] = np.maximum.accumulate(row[::-1])[::-1]
    out, i, j = [], 0, 0
    while i < n and j < m:
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1, j] >= best[i, j + 1]:
            i += 1
        else:
            j += 1
    return out


def aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of aligned equal words of ``a`` and ``b``, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 >= i1 or j0 >= j1:
            continue
        once_a, once_b = Counter(a[i0:i1]), Counter(b[j0:j1])
        place = {w: j for j, w in enumerate(b[j0:j1], j0) if once_b[w] == 1}
        unique = [(i, place[w]) for i, w in enumerate(a[i0:i1], i0) if once_a[w] == 1 and w in place]
        anchors = [unique[k] for k in increasing([j for _, j in unique])]
        if not anchors:
            # Both sides keep only words that can match.
            left = [i for i in range(i0, i1) if a[i] in once_b]
            right = [j for j in range(j0, j1) if b[j] in once_a]
            out += [(left[i], right[j]) for i, j in _common([a[i] for i in left], [b[j] for j in right])]
            continue
        out += anchors
        edges = [(i0 - 1, j0 - 1), *anchors, (i1, j1)]
        todo += [(i + 1, x, j + 1, y) for (i, j), (x, y) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def segments(words: list[str], starts: dict[tuple[str, ...], list[int]], template: Template) -> list[tuple[int, int, int]]:
    """(place in text, place in template, length) of the longest stretches of common runs, in order."""
    pairs = {(i, o) for o in range(len(template.words) - RUN + 1) for i in starts.get(template.words[o : o + RUN], ())}
    out = []
    for i, o in pairs:
        if (i - 1, o - 1) not in pairs:
            k = 1
            while (i + k, o + k) in pairs:
                k += 1
            out.append((i, o, k + RUN - 1))
    return sorted(out)


def occurrences(found: list[tuple[int, int, int]], n: int) -> list[list[tuple[int, int, int]]]:
    """Chains of segments, each of one notice: they rise in text and template and overlap nowhere in the text.

    A chain scores the words that it holds, less half a word for each word that it leaves out in one
    side only; the best chain to each segment is known, and of those the ones with the largest sum are taken.
    """
    score: list[float] = []
    before: list[int] = []
    first: list[int] = []
    for p, (i, o, k) in enumerate(found):
        best, back = float(k), -1
        for q in range(p - 1, -1, -1):
            a, b, m = found[q]
            if a + 2 * n < i:
                break  # a segment has n words at most, and a gap too
            fresh = k - max(0, a + m - i, b + m - o)
            if a < i and b < o and fresh > 0 and i - a - m <= n:
                whole = score[q] + fresh - abs((i - o) - (a - b)) / 2
                if whole > best:
                    best, back = whole, q
        score.append(best)
        before.append(back)
        first.append(p if back < 0 else first[back])
    # Chains by their end; the best sum over chains that end up to each.
    order = sorted(range(len(found)), key=lambda p: (found[p][0] + found[p][2], p))
    ends = [found[p][0] + found[p][2] for p in order]
    sums, taken = [0.0], []
    for p in order:
        own = sums[bisect_right(ends, found[first[p]][0], 0, len(taken))] + score[p]
        taken.append(own > sums[-1])
        sums.append(max(own, sums[-1]))
    chains, at = [], len(order)
    while at:
        if taken[at - 1]:
            p = order[at - 1]
            at = bisect_right(ends, found[first[p]][0], 0, at - 1)
            chain = []
            while p >= 0:
                chain.append(found[p])
                p = before[p]
            chains.append(chain[::-1])
        else:
            at -= 1
    return chains[::-1]


def notice(words: list[str], template: Template, chains: list[list[tuple[int, int, int]]], at: int) -> list[tuple[int, int]]:
    """Aligned places of the notice around one chain, up to the next chain on each side that begins the template anew."""
    n, chain = len(template.words), chains[at]
    (i0, o0, _), (i1, o1, k1) = chain[0], chain[-1]
    lo, hi = max(0, i0 - n), min(len(words), i1 + k1 + n)
    for other in reversed(chains[:at]):
        i, o, k = other[-1]
        if i + k <= lo:
            break
        if o + k > o0:
            lo = i + k
            break
    for other in chains[at + 1 :]:
        i, o, _ = other[0]
        if i >= hi:
            break
        if o < o1 + k1:
            hi = i
            break
    counts = Counter(words[lo:hi])
    if not template.must <= counts.keys():
        return []
    pairs: list[tuple[int, int]] = []
    i, o = lo, 0
    for a, b, k in [*chain, (hi, n, 0)]:
        # The words of a segment that the one before it has not taken, and the gap between both.
        cut = max(0, i - a, o - b)
        a, b, k = a + cut, b + cut, k - cut
        pairs += [(i + x, o + y) for x, y in aligned(words[i:a], list(template.words[o:b]))]
        pairs += [(a + x, b + x) for x in range(k)]
        i, o = a + k, b + k
    return pairs


def found_in(text: str, among: list[Template], coverage: float) -> list[tuple[str, float, int, int]]:
    """(license, coverage, start, end) of the notices in one text; where two overlap the one with more words aligned, or the shorter."""
    spots = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]
    words = [w for w, _, _ in spots]
    found = []
    starts: dict[tuple[str, ...], list[int]] = {}
    for i in range(len(words) - RUN + 1):
        starts.setdefault(tuple(words[i : i + RUN]), []).append(i)
    for template in among:
        n = len(template.words)
        chains = occurrences(segments(words, starts, template), n)
        for at in range(len(chains)):
            pairs = notice(words, template, chains, at)
            share = len(pairs) / n
            if pairs and share >= coverage and template.must <= {template.words[j] for _, j in pairs}:
                found.append((share, n, spots[pairs[0][0]][1], spots[pairs[-1][0]][2], template.license))
    chosen: list[tuple[str, float, int, int]] = []
    for share, _, a, z, name in sorted(found, key=lambda f: (-f[0] * f[1], -f[0], f[3] - f[2], f[2], f[4])):
        if all(z <= b or a >= e for _, _, b, e in chosen):
            chosen.append((name, share, a, z))
    return sorted(chosen, key=lambda c: (c[2], c[0]))


def find_licenses(docs: DataFrame, among: list[Template] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, license, coverage, start, end``: a row for each notice in each row of ``docs``.

    Whole texts; offsets in code points, end exclusive. A template is reported where ``coverage`` of
    its words are aligned, with all that tell it from its like. A text without a run
    of three template words, or an empty or null one, has no rows. Repeated rows report each
    time; null ids are kept.
    """
    among = among if among is not None else templates()
    flat = [" ".join(run) for t in among for run in t.runs]
    wanted = np.unique(np.concatenate([runs(h, RUN) for h in numbered(flat)])) if flat else np.zeros(0, np.uint64)

    def scan(batch: list[str]) -> dict:
        out = []
        for text, h in zip(batch, numbered(batch), strict=True):
            own = runs(h, RUN)
            at = np.minimum(np.searchsorted(wanted, own), max(len(wanted) - 1, 0))
            hit = len(own) > 0 and len(wanted) > 0 and bool((wanted[at] == own).any())
            out.append(found_in(text, among, coverage) if hit else [])
        rows = [[{"license": n, "coverage": c, "start": a, "end": z} for n, c, a, z in r] for r in out]
        return {"found": rows, None: [bool(r) for r in rows]}

    schema = "found array<struct<license:string, coverage:double, start:long, end:long>>"
    return map_texts(texts(docs), scan, schema).select("doc_id", F.inline("found"))
