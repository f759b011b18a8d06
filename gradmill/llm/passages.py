"""Passages that repeat, exactly or nearly, across documents, found by compact windows.

Words are runs without ASCII blanks, A-Z lower-cased; tokens are shingles of
``SHINGLE`` = 5 words. A passage has ``WORDS`` = 50 words or more. Two are near-duplicates
if the Jaccard similarity of their token sets is ``SIMILARITY`` = 0.8 or more.

**Compact windows** (Deng et al., 2023). For a hash function, the token with the
smallest hash in a stretch of text is the smallest in all sub-stretches that
hold it. A Cartesian tree over the hashes - split a stretch at its minimum, go on
left and right - thus groups all n²/2 sub-stretches of at least 46 tokens into about
2n/46 windows (l, c, r): every stretch from l..c to c..r has its minimum at c. Two
stretches with the same minimum meet in windows with the same hash.

**Joins.** Hashes that occur in one text only are dropped (they cannot meet). Where
windows of all functions are left over the same stretch, it is a candidate for an exact
passage; one function is enough for a near one. Both are joined without pairs of all members:

* *Exact.* A window of the first function gives the hash of each stretch of 50
  words that holds c and starts an even number of tokens before it, or ends with it.
  Of the two stretches of 50 words in any repeated 51, at least one is such, in every
  text that has them; so to share such a hash is to share 50 words, and no
  repeated passage of over 50 words is missed.
* *Near.* A window of any of ``FUNCTIONS`` = 8 functions is put to the others that agree
  on ``CONTEXT`` = 12 words beside the minimum, to the right or to the left. Two passages
  have the same minimum with probability Jaccard, so at 0.8 all functions fail with 0.2^8,
  0.0003 %. In 50 words there is room for one edit at 0.8; within 12 words of an end
  it leaves up to 7 of 51 tokens without equal context: (17/51)^8, 0.015 % at worst. The
  one in the smallest document is the group's hub; every other one is a candidate
  with the hub. A member that is in no passage found so far is open, and a candidate with every other
  member (``_open_members``) by the tokens around the minimum, in numpy, for blocks of members at a time: third documents
  that share only a phrase with it drop out there, and hide nothing. Of those that may be similar it is put to the one in
  the smallest document first, and to all others if it is in no passage then.
  All candidates of one pair of documents are joined into an interval
  of either; the words of both are fetched, and around every meeting point, along its
  own shift, the longest stretches that are similar enough are kept, after their Jaccard
  similarity was computed. Points around which no stretches can share enough (``_most``) are left at once.

Texts equal word by word are one class, found by a hash of all words. Only its
smallest document is searched, the others are its copies.

**Scale.** Only minima of windows (which are found again from the words of the documents that met
some) and hashes are shuffled, but for the words of the documents that have near candidates, and the tokens around the members of groups with open ones. Large groups
cost one row per member; the comparisons of open members grow with the square of their groups, on two
short arrays each, in rows of at most two blocks of ``BLOCK`` members; what they leave is a row per open member and block.

NULL and empty texts have no passages. Rows equal in ``doc_id`` are one document
if their words are equal, else the result covers both; NULL ids take no part.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradmill.llm import bitmap
from gradmill.llm.tables import kept, slices

SHINGLE = 5
WORDS = 50
SIMILARITY = 0.8
#: All of them have to have met around an exact candidate, any of them makes a near one.
FUNCTIONS = 8
CONTEXT = 12
#: Functions of ``split_keys``, and tokens on either side of the minimum that they see; the job splits no groups any more.
SPLITS = ((0,), (1,), (2,), (3,), (0, 1), (2, 3), (4, 5), (6, 7))
AROUND = 30
#: Tokens in the shortest passage.
LEAST = WORDS - SHINGLE + 1
#: Tokens on either side of the minimum that open members are compared by. A longer passage that differs so
#: much here that it fails there is as similar farther off, and meets by the minima of that part.
SIDE = 2 * LEAST
#: Members of a group that are compared in one row of a task; larger groups take a row for each two blocks.
BLOCK = 256
#: Weight of a token beyond the ends of a window.
_BEYOND = -30_000
#: Words whose windows are looked for together.
TOGETHER = 1 << 15
#: Bytes of texts whose words are looked for together.
TOGETHER_BYTES = 1 << 18
#: Pairs whose tokens are numbered together.
TOGETHER_PAIRS = 16
#: Starts of exact stretches lie this far apart; the guarantee holds for 2.
STEP = 2
#: Words of twice as many bytes or more are hashed one by one.
_LONG = 32
_LETTER = np.ones(256, bool)
_LETTER[list(b" \t\n\r\x0b\x0c")] = False
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_CRC_OF_ONE = np.array([zlib.crc32(bytes([n])) ^ 0xFFFFFFFF for n in range(256)], np.uint32)  # begun with 0xFFFFFFFF
_CRC_OF_ONE = (_CRC_OF_ONE ^ np.uint32(0x00FFFFFF))[np.arange(256) ^ 0xFF]
_CRC_OF_TWO = (lambda one: _CRC_OF_ONE[one & 0xFF] ^ (one >> 8))(_CRC_OF_ONE[np.arange(1 << 16) & 0xFF] ^ (np.arange(1 << 16, dtype=np.uint32) >> 8))
_GOLD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


# --- hashes and windows of one text ---------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(27))


def word_codes(text: bytes | None) -> np.ndarray:
    """A 32-bit code per word of a UTF-8 text."""
    words = text.lower().split() if text else []
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def codes_of_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ``word_codes`` of a column of texts, found together, one text's after another's, and where each text's end."""
    at = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
    codes, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for first, until in _together(np.diff(at), TOGETHER_BYTES):
        some = pc.fill_null(texts.slice(first, until - first).cast(pa.large_binary()), b"")
        data = np.frombuffer(some.buffers()[2] or b"", np.uint8)
        begin = int(np.frombuffer(some.buffers()[1], np.int64, some.offset + 1)[some.offset])
        found, ends = _codes(data[begin:begin + at[until] - at[first]], at[first:until + 1] - at[first])
        codes.append(found)
        sizes.append(np.diff(ends, prepend=0))
    return np.concatenate(codes), np.cumsum(np.concatenate(sizes))


def _codes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``codes_of_texts`` of texts between the places ``at`` of ``data``."""
    data = _LOWER[np.append(data, 32)]
    word = _LETTER[data]
    edge = word.copy()
    edge[1:] ^= word[:-1]  # where words begin and where they have ended; texts end them as well
    inner = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < at[-1])]
    cut = np.unique(inner[word[inner] & word[inner - 1]])
    edges = np.flatnonzero(edge)
    if len(cut):
        edges = np.sort(np.concatenate([edges, cut, cut]), kind="stable")
    begin, end = edges[::2], edges[1::2]
    return _word_hashes(data, begin, end - begin), np.searchsorted(begin, at[1:], "left")


def _word_hashes(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``zlib.crc32`` of many words of ``data``, two bytes of all that are as long at a time."""
    crc = np.full(len(begin), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-np.minimum(size, 2 * _LONG).astype(np.int8), kind="stable")  # the longest first
    size = size[order]
    at, pairs, falls = begin[order], data[:-1] | data[1:].astype(np.uint16) << 8, -np.minimum(size, 2 * _LONG)
    for n in range(_LONG):
        several = int(np.searchsorted(falls, -2 * (n + 1), "right"))
        if not several:
            break
        some = crc[:several]
        some[:] = _CRC_OF_TWO[(some ^ pairs[at[:several]]) & 0xFFFF] ^ (some >> 16)
        at[:several] += 2
    odd = np.flatnonzero((size & 1).astype(bool) & (size < 2 * _LONG))
    crc[odd] = _CRC_OF_ONE[(crc[odd] ^ data[at[odd]]) & 0xFF] ^ (crc[odd] >> 8)
    crc = ~crc
    for n in np.flatnonzero(size >= 2 * _LONG).tolist():
        crc[n] = zlib.crc32(data[begin[order[n]]:begin[order[n]] + size[n]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


def run_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every ``n`` codes that follow each other, by doubling."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    size, have = 1, _mixed(codes.astype(np.uint64) + _GOLD)
    done, total = 0, None
    m = len(codes) - n + 1
    rest = n
    while rest:
        if rest & 1:
            part = have[done:done + m]
            total = part.copy() if total is None else _mixed(total * _GOLD + part)
            done += size
        rest >>= 1
        if rest:
            have = _mixed(have[:-size] * _GOLD + have[size:])
            size *= 2
    return total


def compact_windows(hashes: np.ndarray, least: int = LEAST, distinct: bool = False, stretches=None) -> np.ndarray:
    """Rows ``(l, c, r)``, inclusive, of all windows with ``least`` tokens or more, by their ``c``; ties to the left.

    ``stretches`` are begins and ends of stretches of ``hashes``, in order, whose windows end where they do; else all
    is one. ``distinct`` promises that no hash repeats; the result is the same. A minimum of a wide window is one of
    some ``least`` tokens; such places are found by minima of runs of 1, 2, 4 ... tokens, and so are their windows' ends.
    """
    begin, end = (np.asarray(x, np.int64) for x in stretches or ([0], [len(hashes)]))
    least = max(least, 1)
    runs = _runs(hashes, least)
    c = _minima(runs, _covered(len(hashes), begin, end, least), least)
    own = np.searchsorted(begin, c, "right") - 1
    l, r = _reach(runs, c, begin[own], end[own])
    wide = r - l + 1 >= least  # of equal minima some are the first in none
    return np.stack([l[wide], c[wide], r[wide]], 1)


def _covered(n: int, begin: np.ndarray, end: np.ndarray, least: int = LEAST) -> np.ndarray:
    """For each place of ``n`` whether ``least`` that begin there lie in one of the stretches."""
    step, wide = np.zeros(n + 1, np.int32), end - begin >= least
    np.add.at(step, begin[wide], 1)
    np.add.at(step, end[wide] - least + 1, -1)
    return np.cumsum(step[:-1]) > 0


def _runs(hashes: np.ndarray, longest: int, runs: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """The minima of all runs of 1, 2, 4 ... hashes, up to ``longest``; after those that are there."""
    runs = runs or [hashes]
    while 2 << len(runs) - 1 <= min(longest, len(hashes)):
        size, last = 1 << len(runs) - 1, runs[-1]
        runs.append(np.minimum(last[:-size], last[size:]))
    return runs


def _minima(runs: list[np.ndarray], covered: np.ndarray, least: int = LEAST) -> np.ndarray:
    """The places of the minima of all ``least`` hashes that begin where ``covered``."""
    hashes, n, k = runs[0], len(runs[0]), least.bit_length() - 1
    if not covered.any():
        return np.zeros(0, np.int64)
    run, none = runs[k], np.zeros(least - 1, hashes.dtype)
    if least > 1 << k:
        run = np.minimum(run[:n - least + 1], run[least - (1 << k):])
    most = np.concatenate([none, run * covered[:n - least + 1], none])  # then the largest of those that hold a place
    for j in range(k):
        most = np.maximum(most[:-(1 << j)], most[1 << j:])
    if least > 1 << k:
        most = np.maximum(most[:n], most[least - (1 << k):])
    at = np.flatnonzero(most == hashes)
    if not hashes[at].all():  # 0 stands for no minimum, too
        held = np.append(0, np.cumsum(covered))
        at = at[held[at + 1] > held[np.maximum(at - least + 1, 0)]]
    return at


def _reach(runs: list[np.ndarray], c: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(l, r)``: how far, between ``begin`` and ``end``, no hash to the left is as small as at ``c`` and none to the right smaller."""
    h, l, r = runs[0][c], c.copy(), c.copy()
    runs = _runs(runs[0], int((end - begin).max(initial=0)), runs)

    def farther(k, x, some, left):
        run, size = runs[k], 1 << k
        if left:
            return ((x - size >= begin[some]) & (run.take(x - size, mode="clip") > h[some])) * size
        return ((x + size < end[some]) & (run.take(x + 1, mode="clip") >= h[some])) * size

    for x, sign in ((l, -1), (r, 1)):
        few, every = min(len(runs), 6), slice(None)
        if len(runs) > 6:  # not many reach so far
            some = np.flatnonzero(farther(6, x, every, sign < 0)) if len(runs) > 7 else np.arange(len(x))
            for k in range(len(runs) - 1, 5, -1):
                x[some] += sign * farther(k, x[some], some, sign < 0)
        for k in range(few - 1, -1, -1):
            x += sign * farther(k, x, every, sign < 0)
    return l, r


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def text_windows(codes: np.ndarray):
    """``(k, value, l, c, r)`` columns of a text's windows for all functions."""
    return windows_of_texts([codes])[1]


def windows_of_texts(texts: list[np.ndarray]):
    """The ``text_windows`` of all ``texts``, one text's after another's, and before them where each text's begin, and the last ends."""
    ends = np.cumsum([len(codes) for codes in texts])
    text, found = _windows_together(np.concatenate(texts), ends)
    order = np.argsort(text, kind="stable")
    text, found = text[order], found[:, order]
    found[2:] -= np.append(0, ends[:-1])[text]
    return np.append(0, np.cumsum(np.bincount(text, minlength=len(ends)))), found


def _minima_together(codes: np.ndarray, ends: np.ndarray, shared: np.ndarray | None = None):
    """``(k, runs, places)`` for each function, of texts that end at ``ends`` of ``codes``: ``_runs`` of its hashes, and the
    minima of windows, of those in order in ``shared`` if given."""
    tokens, begins = run_hashes(codes, SHINGLE), np.append(0, ends[:-1])
    covered = _covered(len(tokens), begins, np.maximum(ends - SHINGLE + 1, begins))
    for k in range(FUNCTIONS):
        own = _mixed(tokens + np.uint64(int(_GOLD) * (2 * k + 1) % (1 << 64)))
        runs = _runs(own, LEAST)
        at = _minima(runs, covered)
        if shared is not None:
            value = _signed(own)[at]
            at = at[shared[np.searchsorted(shared[:-1], value)] == value] if len(shared) else at[:0]
        yield k, runs, at


def _windows_together(codes: np.ndarray, ends: np.ndarray, shared: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(text, columns)`` of the windows of ``_minima_together``, function by function; places are those of ``codes``."""
    found, begins = [np.zeros((5, 0), np.int64)], np.append(0, ends[:-1])
    for k, runs, c in _minima_together(codes, ends, shared):
        text = np.searchsorted(ends, c, "right")
        l, r = _reach(runs, c, begins[text], ends[text] - SHINGLE + 1)
        found.append(np.stack([np.full(len(c), k), _signed(runs[0])[c], l, c, r])[:, r - l + 1 >= LEAST])
    found = np.concatenate(found, 1)
    return np.searchsorted(ends, found[2], "right"), found


def met_functions(tokens: int, k: np.ndarray, l: np.ndarray, c: np.ndarray, r: np.ndarray) -> np.ndarray:
    """For every start of ``LEAST`` tokens, the number of functions whose window of it is among those given."""
    first, last = np.maximum(l, c - LEAST + 1), np.minimum(c, r - LEAST + 1)
    step = np.zeros(tokens - LEAST + 2, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, last + 1, -1)
    return np.cumsum(step[:-1])


def exact_keys(codes: np.ndarray, functions: np.ndarray, l: np.ndarray, c: np.ndarray, r: np.ndarray):
    """``(hash, start)`` of stretches of ``WORDS`` words in windows of the first function.

    Only stretches whose minima have been met for all ``functions``: a repeated
    stretch has the same ones everywhere.
    """
    before = np.append(np.arange(0, LEAST, STEP), LEAST - 1)
    start = c[:, None] - before
    start = start[(start >= l[:, None]) & (start + LEAST - 1 <= r[:, None])]
    start = start[functions[start] == FUNCTIONS]
    return _signed(_mixed(run_hashes(codes, WORDS)[start] + np.uint64(1))), start


def near_keys(codes: np.ndarray, k: np.ndarray, value: np.ndarray, l, c, r, text: np.ndarray | None = None):
    """``(hash, row)``: each window with ``CONTEXT`` words to the right of its minimum, or to the left.

    Equal hashes of a text are one, of the windows that end last the first; ``text`` has each window's text.
    """
    runs = run_hashes(codes, CONTEXT)
    seed = value.view(np.uint64) * _GOLD + k.astype(np.uint64)
    right = np.flatnonzero(c + CONTEXT <= r + SHINGLE)
    left = np.flatnonzero(c + SHINGLE - CONTEXT >= l)
    keys = [_mixed(seed[i] + runs[at] * _MIX + np.uint64(side))
            for side, i, at in ((1, right, c[right]), (2, left, c[left] + SHINGLE - CONTEXT))]
    keys, row = np.concatenate(keys), np.concatenate([right, left])
    text = np.zeros(len(k), np.int64) if text is None else text
    order = np.argsort(keys, kind="stable")
    again = keys[order][1:] == keys[order][:-1]
    some = np.flatnonzero(np.append(again, False) | np.append(False, again))
    order[some] = (part := order[some])[np.lexsort((c[row[part]], -r[row[part]], text[row[part]], keys[part]))]
    keys, row = keys[order], row[order]
    one = np.append(True, (keys[1:] != keys[:-1]) | (text[row[1:]] != text[row[:-1]]))[:len(keys)]
    return _signed(keys[one]), row[one]


def split_keys(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each token of ``at`` and each of ``SPLITS`` 16 bits of a hash of the minima around it."""
    tokens = run_hashes(codes, SHINGLE)
    edges = np.stack([np.maximum(at - AROUND, 0), np.minimum(at + AROUND + 1, len(tokens))], 1).ravel()
    minima = []
    for k in range(1 + max(map(max, SPLITS))):
        own = _mixed(tokens + np.uint64(int(_GOLD) * (2 * (FUNCTIONS + k) + 1) % (1 << 64)))
        minima.append(np.minimum.reduceat(np.append(own, own[-1:]), edges)[::2])
    keys = np.zeros((len(at), len(SPLITS)), np.uint64)
    for n, split in enumerate(SPLITS):
        for k in split:
            keys[:, n] = _mixed(keys[:, n] * _GOLD + minima[k] + np.uint64(n))
    return keys.astype(np.uint16).view(np.int16)  # equal by chance is one candidate more, never one less


def surroundings(tokens: np.ndarray, at: int, begin: int, end: int) -> tuple[np.ndarray, int, int]:
    """``(held, need, slack)`` of the tokens of a window, up to ``SIDE`` of them on either side of ``at``.

    ``held`` are their hashes of 16 bits in order, ``slack`` is how many distinct tokens fell together
    there, ``need`` the fewest distinct tokens in a stretch of ``LEAST`` around ``at``. If stretches of two
    windows have a Jaccard similarity of 0.8, 9 common >= 4 (need + need), with the smaller slack added to
    the common hashes.
    """
    first = max(begin, at - SIDE)
    part = tokens[first:min(end - SHINGLE + 1, at + SIDE + 1)]
    held, distinct, need = part.astype(np.uint16), len(np.unique(part)), LEAST
    if distinct < len(part):
        starts = range(max(0, at - first - LEAST + 1), min(at - first, len(part) - LEAST) + 1)
        need = min(len(np.unique(part[n:n + LEAST])) for n in starts)
    return held.view(np.int16), need, distinct - len(np.unique(held))


def may_be_similar(a: np.ndarray, b: np.ndarray, i: int, j: int) -> bool:
    """Whether around token ``i`` of ``a`` and ``j`` of ``b``, numbers below 2^16, there are stretches that share enough.

    Both ways of ``similar_stretches`` need four common tokens for each other one on either side.
    """
    one = np.array([[len(a), len(b)], [i, j]], np.int64)
    return bool(which_may_be_similar(a, one[0, :1], one[1, :1], b, one[0, 1:], one[1, 1:])[0])


def which_may_be_similar(a: np.ndarray, size_a, i, b: np.ndarray, size_b, j) -> np.ndarray:
    """``may_be_similar`` of many pairs; ``a`` and ``b`` hold the tokens of all, ``size_a`` and ``size_b`` of each.

    As ``_around`` with four for one, of up to ``SIDE`` tokens on either side, in a row for each pair.
    """
    good = np.ones(len(i), bool)
    for x, size_x, at, y, size_y in ((a, size_a, i, b, size_b), (b, size_b, j, a, size_a)):
        begin, rows = np.cumsum(size_x) - size_x, np.arange(len(i))
        row_x, row_y = np.repeat(rows, size_x), np.repeat(rows, size_y)
        held = np.zeros(len(i) << 16, bool)
        held[(row_y << 16) + y] = True
        weight = np.full((len(i), 2 * SIDE + 1), -8 * SIDE, np.int32)  # nothing goes beyond the ends
        weight[row_x, SIDE + np.arange(len(x)) - (begin + at)[row_x]] = np.where(held[(row_x << 16) + x], 1, -4)
        left = np.cumsum(weight[:, SIDE::-1], 1)
        right = np.concatenate([np.zeros((len(i), 1), left.dtype), np.cumsum(weight[:, SIDE + 1:], 1)], 1)
        falls = -np.maximum.accumulate(right[:, ::-1], 1)[:, ::-1]
        apart = (rows * (32 * SIDE * SIDE))[:, None]  # rows one after another in one search
        end = np.searchsorted((falls + apart).ravel(), (left + apart).ravel(), "right").reshape(left.shape) - (SIDE + 1) * rows[:, None] - 1
        n = np.where(end < 0, 0, np.arange(SIDE + 1) + 1 + end)
        before = n.argmax(1)
        place = np.arange(2 * SIDE + 1)
        met = (weight > 0) & (place >= SIDE - before[:, None]) & (place <= SIDE + end[rows, before][:, None])
        long = met.any(1) & (2 * SIDE + 1 - met[:, ::-1].argmax(1) - met.argmax(1) >= LEAST)
        good &= (n[rows, before] >= LEAST) & long
    return good


def _before(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each token the place of the one before that is equal, -1 if there is none; of texts that end at ``ends``."""
    text = np.searchsorted(ends, np.arange(len(tokens)), "right")
    order = np.argsort(tokens, kind="stable")
    same = np.flatnonzero((tokens[order[1:]] == tokens[order[:-1]]) & (text[order[1:]] == text[order[:-1]]))
    before = np.full(len(tokens), -1)
    before[order[same + 1]] = order[same]
    return before


def surroundings_of_many(tokens: np.ndarray, ends: np.ndarray, at: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """``(held, sizes, need, slack)``: the ``surroundings`` of many windows in ``tokens`` of texts that end at ``ends``; ``held`` one after another."""
    first = np.maximum(begin, at - SIDE)
    last = np.minimum(end - SHINGLE + 1, at + SIDE + 1)
    sizes = last - first
    place = np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)
    short = tokens.astype(np.uint16)
    before, begins, firsts = _before(tokens, ends), np.cumsum(sizes) - sizes, np.repeat(first, sizes)
    distinct, kinds = (np.add.reduceat(x[place] < firsts, begins, dtype=np.int64) for x in (before, _before(short, ends)))
    # distinct tokens in every LEAST: one counts where it is the first of its kind
    step = np.zeros(len(tokens) + 1, np.int64)
    where = np.arange(len(tokens))
    np.add.at(step, np.maximum(before + 1, np.maximum(where - LEAST + 1, 0)), 1)
    step[1:] -= 1
    fewest = np.cumsum(step[:-1])
    need = np.full(len(at), LEAST)
    for n in np.flatnonzero(distinct < sizes).tolist():
        from_, to = max(first[n], at[n] - LEAST + 1), min(at[n], last[n] - LEAST)
        need[n] = fewest[from_:to + 1].min()
    return short[place].view(np.int16), sizes, need, distinct - kinds


class _Members:
    """Members of groups with their ``surroundings``, the minimum at token ``at`` of each."""

    def __init__(self, held: pa.ListArray, at: np.ndarray, need: np.ndarray, slack: np.ndarray):
        size = pc.list_value_length(held).to_numpy().astype(np.int64)
        flat = held.flatten().to_numpy().view(np.uint16).astype(np.int64)
        self.at, self.need, self.slack, self.size, self.flat = at.astype(np.int64), need, slack, size, flat
        self.begin = np.cumsum(size) - size
        row = np.repeat(np.arange(len(size)), size)
        place = row, SIDE + np.arange(len(flat)) - (self.begin + self.at)[row]
        own = (row << 16) + flat
        order = np.argsort(own)
        new = np.append(True, own[order[1:]] != own[order[:-1]])[:len(own)]
        first = np.flatnonzero(new)
        kinds, times = flat[order[first]], np.diff(np.append(first, len(own)))
        members = np.bincount(kinds, minlength=1 << 16)
        number = np.cumsum(members > 1) - 1
        number[members < 2] = none = (int(number[-1]) + 64) // 64 * 64  # what only one has is common to none
        self.has = np.zeros((len(size), none + 64), bool)
        self.has[row[order[first]], number[kinds]] = True
        self.has[:, none] = False
        self.bits = np.packbits(self.has, 1).view(np.uint64)
        self.numbers = np.full((len(size), 2 * SIDE + 1), none)
        self.numbers[place] = number[flat]
        weight = np.empty(len(flat), np.int32)
        weight[order] = np.where(times == 1, -8, 0)[np.cumsum(new) - 1]  # as in _most
        self.lost = np.full(self.numbers.shape, _BEYOND, np.int32)
        self.lost[place] = weight

    def _common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The number of distinct tokens that both have."""
        out, rows = np.zeros(len(x), np.int64), max(1, (1 << 17) // max(self.bits.shape[1], 1))
        for n in range(0, len(x), rows):
            out[n:n + rows] = np.bitwise_count(self.bits[x[n:n + rows]] & self.bits[y[n:n + rows]]).sum(1, np.int64)
        return out

    def alike(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which pairs may be similar: by all common tokens, by both sums, as in ``similar_stretches``, and by either side."""
        good = np.zeros(len(x), bool)
        enough = np.flatnonzero(9 * (self._common(x, y) + np.minimum(self.slack[x], self.slack[y])) >= 4 * (self.need[x] + self.need[y]))
        for n in range(0, len(enough), 1024):
            some = enough[n:n + 1024]
            good[some] = self._around(x[some], y[some])
        return good

    def _tokens(self, members: np.ndarray) -> np.ndarray:
        """The tokens of ``members``, one after another."""
        return np.concatenate([self.flat[self.begin[n]:self.begin[n] + self.size[n]] for n in members])

    def _most(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The largest sum of a stretch of ``x`` around the minimum, weighted as by ``_most``."""
        total = np.zeros((len(x), 2 * SIDE + 2), np.int32)
        np.cumsum(np.where(self.has[y[:, None], self.numbers[x]], 1, self.lost[x]), 1, out=total[:, 1:])
        best = np.maximum.accumulate(total[:, :SIDE:-1], 1)[:, ::-1]  # of those that end so far from the minimum, or farther
        end = np.maximum(np.arange(SIDE + 1) + LEAST - 1 - SIDE, 0)
        return (best[:, end] - total[:, :SIDE + 1]).max(1)

    def _around(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """As ``alike``, of the sums and the sides."""
        good, one = np.zeros(len(x), bool), self._most(x, y)
        left = np.flatnonzero(one > -2 * SIDE - 2)
        left = left[one[left] + self._most(y[left], x[left]) >= 0]
        for n in range(0, len(left), 64):
            some = left[n:n + 64]
            sides = ((self._tokens(side), self.size[side], self.at[side]) for side in (x[some], y[some]))
            (a, size_a, at_a), (b, size_b, at_b) = sides
            good[some] = which_may_be_similar(a, size_a, at_a, b, size_b, at_b)
        return good


# --- verification ---------------------------------------------------------------


#: What a token without a partner loses on either side. common >= 0.8 union allows one in four on
#: one side if there is none on the other, one in eight on both: 1/a + 1/b = 1/4; first the loosest.
LOSSES = ((4, 4), (8, 8), (6, 12), (12, 6), (5, 20), (20, 5), (4, 1 << 20), (1 << 20, 4), (64, 64))


def _around(weight: np.ndarray, at: int) -> tuple[int, int] | None:
    """The longest stretch around ``at`` whose sum is 0 or more, without its unmatched ends."""
    left = np.cumsum(weight[at::-1])
    right = np.concatenate([[0], np.cumsum(weight[at + 1:])])
    end = _furthest(right, -left)
    n = np.where(end < 0, 0, np.arange(len(left)) + 1 + end)
    i = int(n.argmax())
    met = np.flatnonzero(weight[at - i:at + int(end[i]) + 1] > 0) + at - i
    return (int(met[0]), int(met[-1]) + 1) if n[i] >= LEAST and len(met) and met[-1] + 1 - met[0] >= LEAST else None


def _around_matched(matched: np.ndarray, at: int, loss: int) -> tuple[int, int] | None:
    """``_around`` of 1 for what is ``matched``, and ``-loss`` for what is not."""
    many = np.count_nonzero(matched)
    if (1 + loss) * many < loss * LEAST:
        return None
    if many < loss * (len(matched) - many):
        return _around(np.where(matched, 1, -loss), at)
    first, end = int(matched.argmax()), len(matched) - int(matched[::-1].argmax())  # all of it is long enough
    return (first, end) if end - first >= LEAST else None


def _most(matched: np.ndarray, tokens: np.ndarray, kinds: int) -> np.ndarray:
    """For each token the largest sum of a stretch of ``LEAST`` or more with it: 1 if ``matched``, -8 if not.

    c common tokens of stretches of m and n distinct ones, c >= 0.8 (m + n - c), are 9c >= 4m + 4n, and as c is
    at most what is matched in either, the sums of both stretches together are 0 or more. A token that
    repeats may be counted once or not at all: it costs nothing.
    """
    once = np.bincount(tokens, minlength=kinds)[tokens] == 1
    total = np.append(0, np.cumsum(np.where(matched, 1, np.where(once, -8, 0))))
    after = np.maximum.accumulate(total[:0:-1])[::-1]  # of stretches up to here or farther
    most = np.full(len(matched) + LEAST - 2, -1 << 40)  # by their begins; those that do not reach beyond their least end
    most[LEAST - 2:1 - LEAST] = after[LEAST - 1:] - total[:-LEAST]
    size = 1
    while size < LEAST - 1:  # then the largest of as many
        step = min(size, LEAST - 1 - size)
        most, size = np.maximum(most[:-step], most[step:]), size + step
    most[LEAST - 1:] = np.maximum(most[LEAST - 1:], after[LEAST - 1:] - np.minimum.accumulate(total)[:-LEAST])
    return most


def _furthest(right: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each of ``least`` the last place of ``right`` with so much or more; -1 if there is none."""
    best = np.maximum.accumulate(right[::-1])[::-1]
    return len(best) - np.searchsorted(best[::-1], least, "left") - 1


def _held(tokens: np.ndarray, kinds: int) -> np.ndarray:
    """For each number below ``kinds`` whether it is among ``tokens``."""
    held = np.zeros(kinds, bool)
    held[tokens] = True
    return held


def _rising(q: np.ndarray) -> np.ndarray:
    """The places of a longest strictly rising part of ``q``."""
    if len(q) < 2 or (np.diff(q) > 0).all():
        return np.arange(len(q))
    # what is above all before and below all after is in every longest one, and parts them; runs of others are searched
    fixed = np.append(True, q[1:] > np.maximum.accumulate(q)[:-1]) & np.append(q[:-1] < np.minimum.accumulate(q[::-1])[::-1][1:], True)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], fixed, [True]]))).reshape(-1, 2)
    found = [np.flatnonzero(fixed)]
    for first, last in edges.tolist():
        found.append(first + _longest(q[first:last].tolist()))
    return np.sort(np.concatenate(found))


def _longest(q: list[int]) -> np.ndarray:
    tails, ends, before = [], [], []
    for n, x in enumerate(q):
        k = bisect_left(tails, x)
        before.append(ends[k - 1] if k else -1)
        tails[k:k + 1], ends[k:k + 1] = [x], [n]
    out, n = [], ends[-1]
    while n >= 0:
        out.append(n)
        n = before[n]
    return np.array(out[::-1], np.int64)


class _Shifts:
    """Where the tokens of ``ta`` occur in ``tb``, nearest to a shift."""

    def __init__(self, ta: np.ndarray, tb: np.ndarray, kinds: int):
        self.ta, self.tb, self.kinds = ta, tb, kinds  # tokens are numbers below kinds
        names, self.rank = np.unique(ta, return_inverse=True)
        at = np.minimum(np.searchsorted(names, tb), len(names) - 1)
        q = np.flatnonzero(names[at] == tb)
        self.size, self.occurs = len(tb) + 1, _held(tb, kinds)[ta]
        self.keys = np.sort(at[q] * self.size + q)

    def nearest(self, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens ``(p, q)`` that are equal, one for each ``p`` that occurs."""
        places, found = np.arange(len(self.ta)), np.full(len(self.ta), -1)
        first, last = max(0, -shift), max(0, -shift, min(len(self.ta), len(self.tb) - shift))
        on = first + np.flatnonzero(self.ta[first:last] == self.tb[first + shift:last + shift])
        found[on] = on + shift
        p = places[(found < 0) & self.occurs]
        want = np.clip(p + shift, 0, len(self.tb) - 1)
        row = self.rank[p] * self.size
        at = np.searchsorted(self.keys, row + want)
        best, far = np.full(len(p), -1), np.full(len(p), self.size)
        for n in (at - 1, at):
            q = self.keys[np.clip(n, 0, len(self.keys) - 1)] - row
            nearer = (n >= 0) & (n < len(self.keys)) & (q >= 0) & (q < self.size) & (abs(q - want) < far)
            best[nearer], far[nearer] = q[nearer], abs(q - want)[nearer]
        found[p] = best
        return places[found >= 0], found[found >= 0]

    def along(self, i: int, j: int):
        """``(x, y, points)``: the longest similar stretches around the equal tokens ``i`` and ``j``, in one order.

        Tokens of a chain of matches through the point, or of those not far off its shift. With
        c matches in stretches of m and n tokens, c >= 0.8 (m + n - c) is 9c - 4m - 4n >= 0:
        a sum over the steps of the chain that lets either side hold all the difference.
        """
        p, q = self.nearest(j - i)
        for band in (len(self.ta) + len(self.tb), 64, 8):
            near = abs(q - p - (j - i)) <= band
            p, q = p[near], q[near]
            left, right = np.flatnonzero((p < i) & (q < j)), np.flatnonzero((p > i) & (q > j))
            chain = left[_rising(q[left])], right[_rising(q[right])]
            found = self._on_chain(i, j, p, q, *chain)
            if found or len(left) + len(right) == sum(map(len, chain)):
                return found  # or a part of the same chain would be left
        return None

    def _on_chain(self, i: int, j: int, p: np.ndarray, q: np.ndarray, left: np.ndarray, right: np.ndarray):
        at = len(left)
        p, q = (np.concatenate([x[left], [n], x[right]]) for x, n in ((p, i), (q, j)))
        step = 9 - 4 * np.diff(p) - 4 * np.diff(q)
        first = at - np.arange(at + 1)
        for harder in (1, 2, 4, 8, 16, 1 << 20):  # it fails only where tokens repeat; then with fewer gaps
            weight = np.where(step < 0, step * harder, step)
            before = np.concatenate([[0], np.cumsum(weight[:at][::-1])])
            after = np.concatenate([[0], np.cumsum(weight[at:])])
            last = at + _furthest(after, -1 - before)
            m, n = p[last] - p[first] + 1, q[last] - q[first] + 1
            size = np.where((last >= at) & (np.minimum(m, n) >= LEAST), m + n, 0)
            k = int(size.argmax())
            if not size[k]:
                return None
            f, e = int(first[k]), int(last[k]) + 1
            x, y = (int(p[f]), int(p[e - 1]) + 1), (int(q[f]), int(q[e - 1]) + 1)
            if self.jaccard(x, y) >= SIMILARITY:
                return x, y, zip(p[f:e].tolist(), q[f:e].tolist())
        return None

    def in_any_order(self, i: int, j: int):
        """``(x, y)``: the same, of tokens that the other side's stretch has anywhere; ``LOSSES`` of one without."""
        a_side, b_side, judged = {}, {}, set()
        for loss_a, loss_b in LOSSES:
            y, old = (0, len(self.tb)), None
            while True:
                if (y, loss_a) not in a_side:
                    a_side[y, loss_a] = _around_matched(_held(self.tb[y[0]:y[1]], self.kinds)[self.ta], i, loss_a)
                x = a_side[y, loss_a]
                if x and (x, loss_b) not in b_side:
                    b_side[x, loss_b] = _around_matched(_held(self.ta[x[0]:x[1]], self.kinds)[self.tb], j, loss_b)
                y = x and b_side[x, loss_b]
                if not y and (loss_a, loss_b) == LOSSES[0]:
                    return None  # nor with any other: all weights are the same or less
                if not y or (x, y) == old:
                    break
                if (x, y) not in judged and self.jaccard(x, y) >= SIMILARITY:
                    return x, y
                judged.add((x, y))
                old = x, y  # what lies outside of the other's stretch counts no longer
        return None

    def jaccard(self, x: tuple[int, int], y: tuple[int, int]) -> float:
        a, b = _held(self.ta[x[0]:x[1]], self.kinds), _held(self.tb[y[0]:y[1]], self.kinds)
        return np.count_nonzero(a & b) / np.count_nonzero(a | b)


def similar_stretches(a: np.ndarray, b: np.ndarray, points) -> list[tuple[int, int, int, int]]:
    """Stretches of ``a`` and of ``b``, word codes of two intervals, that are near-duplicates.

    ``points``: tokens ``(of a, of b)`` around which to look, each by its own shift: first
    along all matches in one order, else along those near the shift, and by what occurs in
    the other stretch in any order. Returns ``(begin, end, begin, end)`` in words. Points on a
    chain that is found already share it, and so do points of the same five tokens on both sides.
    """
    return next(similar_stretches_of([a], [b], [points]))


def similar_stretches_of(a: list[np.ndarray], b: list[np.ndarray], points):
    """``similar_stretches`` of many pairs, whose tokens are numbered together, a few pairs at a time."""
    for n in range(0, len(a), TOGETHER_PAIRS):
        sides = a[n:n + TOGETHER_PAIRS], b[n:n + TOGETHER_PAIRS]
        words = [x for side in sides for x in side]
        ends = np.cumsum([len(x) for x in words]).tolist()
        names, numbers = np.unique(run_hashes(np.concatenate(words), SHINGLE), return_inverse=True)
        tokens = [numbers[end - len(x):max(end - SHINGLE + 1, end - len(x))] for x, end in zip(words, ends)]
        for ta, tb, some in zip(tokens[:len(sides[0])], tokens[len(sides[0]):], points[n:n + TOGETHER_PAIRS]):
            yield _similar(ta, tb, len(names), some)


def _similar(ta: np.ndarray, tb: np.ndarray, kinds: int, points) -> list[tuple[int, int, int, int]]:
    if len(ta) < LEAST or len(tb) < LEAST:
        return []
    in_b, in_a = _held(tb, kinds)[ta], _held(ta, kinds)[tb]
    if min(np.count_nonzero(in_b), np.count_nonzero(in_a)) < 0.8 * LEAST:
        return []
    if kinds > 4 * (len(ta) + len(tb)):
        names, numbers = np.unique(np.concatenate([ta, tb]), return_inverse=True)
        ta, tb, kinds = numbers[:len(ta)], numbers[len(ta):], len(names)
    most_a, most_b = _most(in_b, ta, kinds), _most(in_a, tb, kinds)
    i, j = np.array(points, np.int64).reshape(-1, 2).T
    inside = (i >= 0) & (i < len(ta)) & (j >= 0) & (j < len(tb))
    i, j = i[inside], j[inside]
    if len(i) > 1:
        order = np.argsort(i * len(tb) + j)
        i, j = i[order], j[order]
        places = ((i // SHINGLE) * len(tb) + j // SHINGLE) * (len(ta) + len(tb)) + j - i + len(ta)
        first = np.sort(np.unique(places, return_index=True)[1])
        i, j = i[first], j[first]
    equal = ta[i] == tb[j]
    rest = ~equal | (most_a[i] + most_b[j] >= 0)  # no stretches around the others share enough
    shifts, found, loose, done = None, set(), set(), set()
    for i, j, equal in zip(i[rest].tolist(), j[rest].tolist(), equal[rest].tolist()):
        along = equal and (i, j) not in done
        anyhow = not any(x[0] <= i < x[1] and y[0] <= j < y[1] for x, y in loose)
        if not along and not anyhow:
            continue
        shifts = shifts or _Shifts(ta, tb, kinds)
        if along:
            met = shifts.along(i, j)
            if met:
                found.add(met[:2])
                done.update(met[2])
        if anyhow:
            met = shifts.in_any_order(i, j)
            if met:
                loose.add(met)
    found |= loose
    return [(b1, e1 + SHINGLE - 1, b2, e2 + SHINGLE - 1) for (b1, e1), (b2, e2) in sorted(found)]


# --- the job --------------------------------------------------------------------


#: Of Spark 4.1; elsewhere it is passed over.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    """``kept``, and the shuffle files of ``df`` are removed as soon as it is written, not when the driver collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return kept(df, purpose)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def _emptied(table: DataFrame) -> None:
    """The files of a kept table that nothing reads any more make room for the next."""
    for folder in {unquote(file.rsplit("/", 1)[0]) for file in table.inputFiles()}:
        table.sparkSession.createDataFrame([], table.schema).write.mode("overwrite").parquet(folder)


def _together(sizes: np.ndarray, most: int = TOGETHER) -> list[tuple[int, int]]:
    """Ranges of rows that are worked on together, as far as they are short, so that what is held stays small."""
    cuts = np.unique(np.cumsum(sizes) // most, return_index=True)[1].tolist()
    return list(zip(cuts, [*cuts[1:], len(sizes)]))


def _class_of(codes: np.ndarray) -> int:
    """A hash of all words of a text."""
    return xxhash.xxh64_intdigest(codes.tobytes(), len(codes)) - (1 << 63)


def _windows(docs: DataFrame) -> DataFrame:
    """``(doc, text, n_words, value)``: class hash of all words, and the minima of the windows."""

    def run(batches):
        for b in slices(batches):
            codes, ends = codes_of_texts(b.column(1))
            begins = np.append(0, ends[:-1])
            texts = pa.array([_class_of(codes[x:y]) for x, y in zip(begins.tolist(), ends.tolist())], pa.int64())
            for at, until in _together(ends - begins):
                begin = begins[at]
                text, value = [], []
                for _, runs, c in _minima_together(codes[begin:ends[until - 1]], ends[at:until] - begin):
                    text.append(np.searchsorted(ends[at:until] - begin, c, "right"))
                    value.append(_signed(runs[0])[c])
                text, value = np.concatenate(text), np.concatenate(value)
                new = np.append(True, (text[1:] != text[:-1]) | (value[1:] != value[:-1]))[:len(text)]  # one of those that repeat at once
                text, value = text[new], value[new]
                order = np.argsort(text, kind="stable")
                offsets = np.append(0, np.cumsum(np.bincount(text, minlength=until - at)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, until - at), texts.slice(at, until - at), pa.array((ends - begins)[at:until], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(value[order]))], ["doc", "text", "n_words", "value"])

    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc long, text long, n_words int, value array<long>")


def _first_and_last(value: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``(value, text)`` in order, of each value those with the smallest and the largest text, if they are two."""
    order = np.lexsort((text, value))
    value, text = value[order], text[order]
    same = value[1:] == value[:-1]
    first, last = np.append(True, ~same)[:len(value)], np.append(~same, True)[:len(value)]
    one = first | last & (text != text[np.maximum.accumulate(np.where(first, np.arange(len(value)), 0))])
    return value[one], text[one]


def _shared(found: DataFrame) -> DataFrame:
    """The values that rows ``(text, value)``, with arrays of values, have in two texts or more.

    A batch sends a value with two texts at most, so common ones pile up nowhere, and the values of a range as one row.
    """
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.linspace(-(1 << 63), 1 << 63, 4 * parts + 1)[1:-1].astype(np.int64)  # hashes fill all ranges alike

    def spread(batches):
        for b in slices(batches, 1024):
            value = b.column(1).flatten().to_numpy()
            value, text = _first_and_last(value, np.repeat(b.column(0).to_numpy(), pc.list_value_length(b.column(1)).to_numpy()))
            cuts = [0, *np.searchsorted(value, bounds).tolist(), len(value)]
            ranges = [n for n in range(len(cuts) - 1) if cuts[n] < cuts[n + 1]]
            pairs = [np.stack([value[cuts[n]:cuts[n + 1]], text[cuts[n]:cuts[n + 1]]]).tobytes() for n in ranges]
            yield pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), pa.array(pairs, pa.binary())], ["range", "pairs"])

    def met(batches):
        pairs = [np.frombuffer(x.as_buffer(), np.int64).reshape(2, -1) for b in batches for x in b.column(1)]
        value, text = _first_and_last(*np.concatenate(pairs, 1)) if pairs else np.zeros((2, 0), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(value[1:][value[1:] == value[:-1]])], ["value"])

    return found.mapInArrow(spread, "range int, pairs binary").repartition(parts, "range").mapInArrow(met, "value long")


def _keys(found: DataFrame, firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """``(key, exact, doc, at, begin, end)`` of all windows that may meet others.

    ``at`` is the token both sides align by; ``begin`` and ``end`` are words. The windows are found again
    from the words: their minima alone are shuffled. ``found`` is empty afterwards.
    """
    shared = _kept(_shared(found.select("text", "value")), "shared-minima")
    bits = bitmap.of_hashes(shared, "value", bitmap.MANY_BITS)
    met = found.select("doc", "text", F.explode("value").alias("value"))
    met = met.where(bitmap.may_hold(bits, F.col("value"), bitmap.MANY_BITS)).join(shared, "value", "left_semi")
    some = met.groupBy("doc", "text").agg(F.collect_list("value").alias("value"))
    some = some.join(firsts, "text").where("doc = first").select("doc", F.col("text").alias("class"), "value")

    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), "text")
    needed = _kept(some, "met-minima")
    _emptied(found)
    texts = texts.where(bitmap.may_hold(bitmap.of_hashes(needed.select(F.xxhash64("doc").alias("h")), "h"), F.xxhash64("id")))

    def run(batches):
        for b in slices(batches):
            codes, ends = codes_of_texts(b.column(1))
            begins = np.append(0, ends[:-1])
            same = [_class_of(codes[x:y]) == own for x, y, own in zip(begins.tolist(), ends.tolist(), b.column(2).to_pylist())]
            docs, same = b.column(0).to_numpy(), np.array(same, bool)  # or another text under the same id
            for at, until in _together(ends - begins):
                begin = begins[at]
                words = codes[begin:ends[until - 1]]
                # a minimum that is shared has been met by all texts that have it
                text, w = _windows_together(words, ends[at:until] - begin, np.sort(b.column(3).slice(at, until - at).flatten().to_numpy()))
                met = same[at:until][text]
                if not met.any():
                    continue
                text, (k, value, l, c, r) = text[met], w[:, met]
                functions, one = met_functions(len(words) - SHINGLE + 1, k, l, c, r), k == 0
                key, start = exact_keys(words, functions, l[one], c[one], r[one])
                near, row = near_keys(words, k, value, l, c, r, text)
                own = np.concatenate([np.searchsorted(ends[at:until] - begin, start, "right"), text[row]])
                shift = (begins[at:until] - begin)[own]
                exact = np.repeat([True, False], [len(key), len(near)])
                places = [np.concatenate(x) - shift for x in ((start, c[row]), (start, l[row]), (start + WORDS, r[row] + SHINGLE))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([key, near])), pa.array(exact), pa.array(docs[at:until][own]),
                     *(pa.array(x.astype(np.int32)) for x in places)], ["key", "exact", "doc", "at", "begin", "end"])

    return texts.join(needed, F.col("id") == F.col("doc")).select("id", "text", "class", "value").mapInArrow(
        run, "key long, exact boolean, doc long, at int, begin int, end int")


def _near(candidates: DataFrame, docs: DataFrame) -> DataFrame:
    """``(doc, begin, end, other)`` of verified candidates, for both sides.

    Candidates ``(doc, begin, end, hub, hub_begin, hub_end, points)``: one row per
    pair of documents, into which the words of both intervals are fetched.
    """
    ids = candidates.select(F.xxhash64("doc").alias("h")).unionByName(candidates.select(F.xxhash64("hub").alias("h")))
    bits = bitmap.of_hashes(ids, "h")
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), "text")
    texts = texts.where(bitmap.may_hold(bits, F.xxhash64("id")))

    def cut(batches):
        for b in slices(batches):
            names = b.schema.names
            begin, end = (b.column(names.index(c)).to_numpy() for c in ("from", "to"))
            texts = b.column(names.index("text"))
            new = np.flatnonzero(np.append(True, pc.fill_null(pc.not_equal(texts.slice(1), texts.slice(0, len(texts) - 1)), True).to_numpy(zero_copy_only=False)))
            codes, ends = codes_of_texts(texts.take(pa.array(new)))
            of = np.searchsorted(new, np.arange(len(texts)), "right") - 1
            first, last = np.append(0, ends[:-1])[of], ends[of]
            parts = [codes[x:y].tobytes() for x, y in zip(np.minimum(first + begin, last).tolist(), np.minimum(first + end, last).tolist())]
            keep = [b.column(c) for c in range(len(names)) if names[c] not in ("text", "id", "from", "to")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(parts, pa.binary())], [*(c for c in names if c not in ("text", "id", "from", "to")), "words"])

    def with_words(rows: DataFrame, doc: str, begin: str, end: str, name: str) -> DataFrame:
        met = rows.withColumns({"from": F.col(begin), "to": F.col(end)}).join(texts, F.col(doc) == F.col("id"))
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", words binary"
        return met.mapInArrow(cut, kinds).withColumnRenamed("words", name)

    rows = with_words(candidates, "doc", "begin", "end", "a")
    rows = with_words(rows, "hub", "hub_begin", "hub_end", "b")

    def verify(batches):
        for b in slices(batches):
            out, points, size = [], b.column("points"), pc.list_value_length(b.column("points")).to_numpy()
            both, ends = points.flatten(), np.cumsum(size)
            doc, hub, begin, hub_begin = (b.column(c).to_numpy() for c in ("doc", "hub", "begin", "hub_begin"))
            both = np.stack([both.field("at").to_numpy() - np.repeat(begin, size), both.field("hub_at").to_numpy() - np.repeat(hub_begin, size)], 1)
            words = ([np.frombuffer(x.as_buffer(), np.uint32) for x in b.column(c)] for c in "ab")
            for n, found in enumerate(similar_stretches_of(*words, np.split(both, ends[:-1]))):
                for b1, e1, b2, e2 in found:
                    out.append((doc[n], begin[n] + b1, begin[n] + e1, hub[n]))
                    out.append((hub[n], hub_begin[n] + b2, hub_begin[n] + e2, doc[n]))
            columns = np.array(out, np.int64).reshape(len(out), 4).T.copy()
            kinds = pa.int64(), pa.int32(), pa.int32(), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(x).cast(t) for x, t in zip(columns, kinds)], ["doc", "begin", "end", "other"])

    return rows.mapInArrow(verify, "doc long, begin int, end int, other long")


def _hubs(rows: DataFrame) -> DataFrame:
    """``(key, hub)``: the row of the smallest document of every key that several documents have."""
    found = rows.groupBy("key").agg(F.min(F.struct("doc", "at", "begin", "end")).alias("hub"), F.max("doc").alias("last"))
    return found.where("hub.doc <> last").drop("last")


def _paired(met: DataFrame) -> DataFrame:
    """One row per pair of documents, of rows ``(doc, at, begin, end, hub)``."""
    pairs = met.where(F.col("doc") != F.col("hub.doc")).select(
        "doc", F.col("hub.doc").alias("hub"), "at", F.col("hub.at").alias("hub_at"), "begin", "end",
        F.col("hub.begin").alias("hub_begin"), F.col("hub.end").alias("hub_end"))
    return pairs.groupBy("doc", "hub").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), F.min("hub_begin").alias("hub_begin"),
        F.max("hub_end").alias("hub_end"), F.collect_set(F.struct("at", "hub_at")).alias("points"))


def _marked_open(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` with ``open``: the token lies in none of ``spans``, of which no two of a document overlap."""
    tiles = F.sequence(F.floor(F.col("begin") / WORDS), F.floor((F.col("end") - 1) / WORDS))
    covers = spans.select(F.col("doc").alias("in"), F.col("begin").alias("lo"), F.col("end").alias("hi"),
                          F.explode(tiles).alias("tile"))
    covered = ((F.col("doc") == F.col("in")) & (F.floor(F.col("at") / WORDS) == F.col("tile"))
               & (F.col("lo") <= F.col("at")) & (F.col("at") < F.col("hi")))
    return rows.join(covers, covered, "left").withColumn("open", F.col("lo").isNull()).drop("in", "lo", "hi", "tile")


def _with_surroundings(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` ``(key, doc, at, begin, end, open, blocks)`` with the ``surroundings`` of their windows."""
    own = rows.groupBy("doc").agg(F.collect_list(F.struct("key", "at", "begin", "end", "open", "blocks")).alias("w"))
    own = _kept(own, "open-groups")  # fewer ids than rows, for the filter of the texts
    bits = bitmap.of_hashes(own.select(F.xxhash64("doc").alias("h")), "h")
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), "text")
    texts = texts.where(bitmap.may_hold(bits, F.xxhash64("id")))

    def run(batches):
        for b in slices(batches, 16):
            codes, ends = codes_of_texts(b.column(1))
            begins, size = np.append(0, ends[:-1]), pc.list_value_length(b.column(2)).to_numpy()
            w, of = b.column(2).flatten(), np.repeat(np.arange(b.num_rows), size)
            fits = w.field("end").to_numpy() <= (ends - begins)[of]  # or another text under the same id
            w, of = w.filter(pa.array(fits)), of[fits]
            tokens = run_hashes(codes, SHINGLE)
            for x in range(0, len(w), 1024):
                own, part = of[x:x + 1024], w.slice(x, 1024)
                held, sizes, need, slack = surroundings_of_many(tokens, ends, *(part.field(c).to_numpy() + begins[own] for c in ("at", "begin", "end")))
                offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.field("key"), b.column(0).take(pa.array(own)), *(part.field(c) for c in ("at", "begin", "end", "open", "blocks")),
                     pa.ListArray.from_arrays(offsets, pa.array(held)), pa.array(need, pa.int32()), pa.array(slack, pa.int32())],
                    ["key", "doc", "at", "begin", "end", "open", "blocks", "held", "need", "slack"])

    return texts.join(own, F.col("id") == F.col("doc")).select("id", "text", "w").mapInArrow(
        run, "key long, doc long, at int, begin int, end int, open boolean, blocks int, held array<short>, need int, slack int")


def _open_members(like: DataFrame, hubs: DataFrame, spans: DataFrame, docs: DataFrame) -> DataFrame:
    """``(doc, at, begin, end, others)``: the open members of groups, each with all others that may be similar.

    Open members lie in none of ``spans``. With the hubs all members have been compared. ``others`` are in order
    of their documents, and there is a row per member and block of its group.
    """
    hub = hubs.select("key", F.col("hub.doc").alias("tried"))
    others = like.join(hub, "key").where("doc <> tried")
    # a group of two is its hub and one member: nothing is left to compare
    groups = _kept(_marked_open(others, spans).groupBy("key").agg(
        F.max("tried").alias("tried"), F.max("open").alias("open"), F.min("doc").alias("first"), F.max("doc").alias("last"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
    ).where("open and first <> last").select("key", "tried", "blocks"), "open-keys")
    rows = _marked_open(like.join(groups, "key").where("doc <> tried").drop("tried"), spans)
    rows = _with_surroundings(rows, docs).withColumn("block", F.pmod(F.xxhash64("doc"), "blocks").cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    member = F.struct("doc", "at", "begin", "end", "open", "block", "held", "need", "slack")
    two = rows.groupBy("key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    two = two.agg(F.max("open").alias("open"), F.collect_list(member).alias("w")).where("open").select("one", "two", "w")

    def run(batches):
        for b in slices(batches):
            w, within = b.column(2), pc.equal(b.column(0), b.column(1)).to_numpy(zero_copy_only=False)
            size = pc.list_value_length(w).to_numpy().astype(np.int64)
            cuts = np.unique((np.cumsum(size) - size) // (2 * BLOCK), return_index=True)[1].tolist()
            for at, until in zip(cuts, [*cuts[1:], len(size)]):
                rows = w.slice(at, until - at).flatten()
                doc, block, is_open = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("doc", "block", "open"))
                ends = np.cumsum(size[at:until])
                pairs = [_to_compare(doc, block, is_open, end - n, end, alone)
                         for end, n, alone in zip(ends.tolist(), size[at:until].tolist(), within[at:until])]
                x, y = np.concatenate(pairs, 1)
                before = np.minimum(rows.field("at").to_numpy() - rows.field("begin").to_numpy(), SIDE)
                good = _Members(rows.field("held"), before, rows.field("need").to_numpy(), rows.field("slack").to_numpy()).alike(x, y)
                x, y = x[good], y[good]
                back = is_open[y]  # both look for partners then
                x, y = np.concatenate([x, y[back]]), np.concatenate([y, x[back]])
                order = np.lexsort((doc[y], x))
                own, first = np.unique(x[order], return_index=True)
                found = rows.take(pa.array(y[order]))
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(x)), pa.int32()), pa.StructArray.from_arrays(
                    [found.field(c) for c in ("doc", "at", "begin", "end", "open")], ["doc", "at", "begin", "end", "open"]))
                mine = rows.take(pa.array(own))
                yield pa.RecordBatch.from_arrays([*(mine.field(c) for c in ("doc", "at", "begin", "end")), lists],
                                                 ["doc", "at", "begin", "end", "others"])

    return two.mapInArrow(run, "doc long, at int, begin int, end int, "
                               "others array<struct<doc:bigint,at:int,begin:int,end:int,open:boolean>>")


def _to_compare(doc: np.ndarray, block: np.ndarray, is_open: np.ndarray, begin: int, end: int, within: bool) -> np.ndarray:
    """Pairs ``(open, other)`` of members ``begin`` to ``end - 1``: of one block if ``within``, else of two; of two open ones once."""
    opened = begin + np.flatnonzero(is_open[begin:end])
    x, y = np.repeat(opened, end - begin), np.tile(np.arange(begin, end), len(opened))
    return np.stack([x, y])[:, (doc[x] != doc[y]) & (within | (block[x] != block[y])) & (~is_open[y] | (doc[x] > doc[y]))]


def _oriented(rows: DataFrame) -> DataFrame:
    """Rows ``(doc, at, begin, end, hub)`` so that pairs of open members come from the same side, whichever found the other."""
    turned = F.col("hub.open") & (F.col("hub.doc") > F.col("doc"))
    names = "doc", "at", "begin", "end"
    return rows.select(*(F.when(turned, F.col(f"hub.{c}")).otherwise(F.col(c)).alias(c) for c in names),
                       F.struct(*(F.when(turned, F.col(c)).otherwise(F.col(f"hub.{c}")).alias(c) for c in names)).alias("hub"))


def repeated(docs: DataFrame) -> DataFrame:
    """``(doc_id, begin, end, other_id)``: one row per stretch of words that repeats.

    Stretches of a document that overlap or touch are one. ``other_id`` is the smallest
    document found to have a near-duplicate of some of it; for a copy, of all of it.
    """
    found = _kept(_windows(docs), "compact-windows")
    # aggregates are written before they are joined: only plain sides of a join are split where keys are hot
    firsts = _kept(found.groupBy("text").agg(F.min("doc").alias("first"), F.max("doc").alias("last")), "first-copies")
    classes = _kept(found.select("text", "doc", "n_words").distinct(), "text-classes")
    keys = _kept(_keys(found, firsts, docs), "passage-keys")
    same = keys.where("exact").select("key", "doc", "begin")
    ends = same.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    ends = _kept(ends.where("first <> last"), "passage-ends")
    other = F.when(F.col("doc") == F.col("first"), F.col("last")).otherwise(F.col("first"))
    exact = same.join(ends, "key").select("doc", "begin", (F.col("begin") + WORDS).alias("end"), other.alias("other"))
    like = keys.where(~F.col("exact")).drop("exact")
    hubs = _kept(_hubs(like), "passage-hubs")
    near = _kept(_near(_kept(_paired(like.join(hubs, "key")), "near-candidates"), docs), "near-passages")
    found_so_far = _kept(_merged(exact.unionByName(near)), "passages-of-hubs")
    # open members are put to the first that may be similar; those that are open still, to all
    members = _kept(_open_members(like, hubs, found_so_far, docs), "open-members")
    member = F.col("doc"), F.col("at"), F.col("begin"), F.col("end")
    met = _oriented(members.select(*member, F.get("others", F.lit(0)).alias("hub")))
    near = _kept(_near(_kept(_paired(met), "first-candidates"), docs), "first-passages")
    found_so_far = _kept(_merged(found_so_far.unionByName(near)), "passages-of-firsts")
    rest = _marked_open(members.where(F.size("others") > 1), found_so_far).where("open")
    met = _oriented(rest.select(*member, F.explode(F.slice("others", F.lit(2), F.size("others"))).alias("hub")))
    near = _kept(_near(_kept(_paired(met), "open-candidates"), docs), "open-passages")
    spans = _kept(_merged(found_so_far.unionByName(near)), "passages")
    members = classes.join(firsts, "text").select("doc", "n_words", "first", "last")
    copies = members.where((F.col("first") != F.col("last")) & (F.col("n_words") >= WORDS)).select(
        "doc", F.lit(0).alias("begin"), F.col("n_words").alias("end"),
        F.when(F.col("doc") == F.col("first"), F.col("last")).otherwise(F.col("first")).alias("other"))
    single = members.where((F.col("first") == F.col("last")) | (F.col("n_words") < WORDS)).select("doc").distinct()
    own = spans.join(single, "doc")
    return copies.unionByName(own).select(
        F.col("doc").alias("doc_id"), "begin", "end", F.col("other").alias("other_id")).distinct()


def _merged(spans: DataFrame) -> DataFrame:
    """Stretches of one document that overlap or touch, as one; a document's rows are few."""
    # stretches that begin within half a passage overlap: fewer rows for the window, in the same partitions
    part = F.floor(F.col("begin") / (WORDS // 2)).alias("part")
    spans = spans.repartition("doc").groupBy("doc", part).agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), F.min("other").alias("other"))
    order = Window.partitionBy("doc").orderBy("begin", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach >= F.col("begin"), 0).otherwise(1)
    numbered = spans.drop("part").withColumn("new", new)
    numbered = numbered.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("doc", "part").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), F.min("other").alias("other")).drop("part")
