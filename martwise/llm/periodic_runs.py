"""Periodic runs in texts, by a suffix automaton whose links are accessed as in a link-cut tree.

A run is a stretch of consecutive words with a smallest period that no
neighbouring word extends, of at least six words and four periods.

The automaton of a stretch of words grows by a word at a time.  Its suffix
links make a tree, cut into path segments: the states of a segment ended last
at the same place.  Appending the word at r accesses the new state: all
segments on its way to the root are joined to one that ends at r, and what
hangs below keeps the old place.  A segment that is passed at a state of
length L and ended before at e says that the last L words of r and of e agree
and no more do.  With d = r - e and d <= L, the last 2d words are a square of
period d, and the run of that period begins at r - L - d + 1.  The square of
a run's smallest period is passed at every r of the run from its second
period on, and a square of a longer period never is, since the shorter one
ends later.  So the last r at which a (start, period) is passed ends its run.

A segment is a list of its states by length; joining and parting renumber the
smaller side.  A stretch takes memory in proportion to its words.

Every word of a run occurs four times or more in it.  Texts are therefore cut
at words that occur less often, and the pieces again, before the automaton
reads what is left.  The cuts never touch a run or the words beside it.

Rows are independent: there is no shuffle, and the longest text is the most
that a task holds at a time besides its batch.  Defined cases: null and empty
texts have no words and no runs.  Equal rows give equal results.  A null id
rewrites nothing.  An empty table gives an empty result.  Other columns are
left out.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwise.llm.common import WORD

LEAST_WORDS = 6
LEAST_PERIODS = 4

_WORD = re.compile(WORD)


def squares(ids: list[int]) -> dict[tuple[int, int], int]:
    """(start, period) to the last word, of every maximal repetition of two periods or more."""
    nxt: list[dict[int, int]] = [{}]
    link, length, seg = [-1], [0], [-1]
    states: list[list[int]] = []  # of a segment, the shortest first; the root is in none
    ended: list[int] = []
    found: dict[tuple[int, int], int] = {}
    size, last = length.__getitem__, 0
    for r, c in enumerate(ids):
        cur = len(nxt)
        nxt.append({})
        length.append(r + 1)
        link.append(0)
        seg.append(-1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:  # the shorter suffixes of q get a state of their own, in q's segment
                clone = len(nxt)
                nxt.append(nxt[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                seg.append(seg[q])
                own = states[seg[q]]
                own.insert(bisect_right(own, length[p] + 1, key=size), clone)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
        # access: from the new state to the root, a segment at a time
        parts: list[list[int]] = []
        base, base_at = -1, -1
        u = link[cur]
        while u > 0:
            s = seg[u]
            own = states[s]
            d = r - ended[s]
            if d <= length[u]:
                found[r - length[u] - d + 1, d] = r
            if own[-1] != u:
                k = bisect_right(own, length[u], key=size)
                if 2 * k <= len(own):  # the longer rest keeps the number
                    states[s] = own[k:]
                    own = own[:k]
                    s = -1
                else:
                    rest = own[k:]
                    del own[k:]
                    for x in rest:
                        seg[x] = len(states)
                    states.append(rest)
                    ended.append(ended[s])
            if s >= 0 and (base < 0 or len(own) > len(parts[base_at])):
                base, base_at = s, len(parts)
            parts.append(own)
            u = link[own[0]]
        if base < 0:
            base = len(states)
            states.append([])
            ended.append(r)
            path = []
            above = parts
            below = []
        else:
            path = parts[base_at]
            above, below = parts[base_at + 1:], parts[:base_at]
        for own in reversed(below):
            for x in own:
                seg[x] = base
            path.extend(own)
        if above:
            top = []
            for own in reversed(above):
                for x in own:
                    seg[x] = base
                top.extend(own)
            path[0:0] = top
        path.append(cur)
        seg[cur] = base
        states[base] = path
        ended[base] = r
    return found


def candidate_stretches(ids: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS):
    """(first, past the last) of the stretches in which every word occurs ``periods`` times or more."""
    todo = [(0, len(ids))]
    while todo:
        a, b = todo.pop()
        if b - a < least:
            continue
        part = ids[a:b]
        if b - a < len(ids):
            part = np.unique(part, return_inverse=True)[1]
        often = np.bincount(part)[part] >= periods
        if often.all():
            yield a, b
            continue
        edge = np.diff(np.concatenate(([0], often.view(np.int8), [0])))
        first, past = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = past - first >= least
        todo += zip((first[long] + a).tolist(), (past[long] + a).tolist())


def runs(words: list[str], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    place: dict[str, int] = {}
    ids = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, len(words))
    out = []
    for a, b in candidate_stretches(ids, least, periods):
        for (start, period), end in squares(ids[a:b].tolist()).items():
            n = end - start + 1
            if n >= max(least, periods * period):
                out.append((a + start, n, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], found: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that a run holds after its first period."""
    if not found:
        return words
    keep = np.ones(len(words), bool)
    for start, n, period in found:
        keep[start + period:start + n] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def looped(doc_id: int | None, words: list[str]) -> list[str]:
    """The words of a document; one in ten is made to repeat a part from some word on."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


RUNS = "array<struct<start:long,length:long,period:long>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame, rewrite: Callable[[int | None, list[str]], list[str]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per document; ``rewrite`` changes its words first.

    ``runs`` are ordered by start, then period; ``collapsed`` is the text
    without the repeated periods, its words joined by one space.
    """
    def find(batches):
        for batch in batches:
            counts, found, texts = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _WORD.findall(text) if text else []
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                got = runs(words)
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in got])
                texts.append(" ".join(collapsed(words, got)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, _RUNS), pa.array(texts, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        find, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def strongest(found: Column) -> Column:
    """The run of the greatest exact length / period; ties: the smallest start, then period."""
    def before(x: Column, y: Column) -> Column:
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(a != b, F.when(a > b, -1).otherwise(1))
                .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
                .otherwise(F.when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)))
    return F.get(F.array_sort(found, before), 0)


__all__ = ["squares", "candidate_stretches", "runs", "collapsed", "looped", "find_runs", "strongest"]
