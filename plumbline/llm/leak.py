"""Held-out passages inside a corpus: q-gram lemma filter in overlapping diagonal bands, banded alignment, exact word check."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.plans.shipping import ship

Q = 16  # characters of a gram: a power of two, as hashes are doubled up, and less than the 23 that twelve words have at least
EDITS = 1  # edits that an aligned region may hold
SLAB = 2_000_000  # characters hashed at once; bounds memory, not texts
EDGE, GAP, PAD = 1, 2, 3  # codes between two documents, between two passages and around documents: no word has them
STEP = 32  # characters that an alignment compares at once
_MIX, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3 | 1)


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    """For each code point its lower-case code, or 0 where it is neither letter nor digit."""
    fold = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalnum():
            low = c.lower()
            fold[point] = ord(low[0])
    return fold


def codes(text: str) -> np.ndarray:
    """Folded code points: words divided by single zeros. ``\\x01`` stays and divides documents."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    folded = _folding()[raw]
    folded[raw == EDGE] = EDGE
    word = folded > EDGE
    keep = word | (folded == EDGE)
    keep[1:] |= word[:-1]
    return folded[keep]


def gram_hashes(z: np.ndarray) -> np.ndarray:
    """Hash of the ``Q`` codes from each position on."""
    h, base, width = (z.astype(np.uint64) + np.uint64(7)) * _MIX, _BASE, 1
    h ^= h >> np.uint64(29)
    while width < Q:
        if len(h) <= width:
            return h[:0]
        h = h[:-width] * base + h[width:]
        with np.errstate(over="ignore"):
            base = base * base
        width *= 2
    return h ^ (h >> np.uint64(31))


def _word_starts(z: np.ndarray) -> np.ndarray:
    """Whether a word begins at each position."""
    word = z > PAD
    start = word.copy()
    start[1:] &= ~word[:-1]
    return start


@dataclass
class Index:
    """Grams of a block of passages; its size is bounded by the block's characters."""

    ids: np.ndarray
    bitmap: np.ndarray
    hashes: np.ndarray  # sorted, distinct
    first: np.ndarray  # posting range of each hash
    items: np.ndarray  # postings
    places: np.ndarray
    span: np.ndarray  # characters of an item's shortest window of ``words`` words
    flat: np.ndarray  # all passages with gaps between and around them
    begin: np.ndarray  # where each passage begins in ``flat``


def build_index(rows: list[tuple[int, str]], words: int) -> Index | None:
    """Index of the passages that have at least ``words`` words; None without any."""
    ids, texts, spans = [], [], []
    for ident, passage in rows:
        z = codes(passage)
        while len(z) and z[-1] == 0:
            z = z[:-1]
        starts = np.flatnonzero(_word_starts(z))
        if len(starts) >= words:
            ends = np.append(starts[1:] - 1, len(z))
            ids.append(ident)
            texts.append(z)
            spans.append(int((ends[words - 1 :] - starts[: len(starts) - words + 1]).min()))
    if not ids:
        return None
    each = [gram_hashes(z) for z in texts]
    hashed = np.concatenate(each)
    items = np.repeat(np.arange(len(each)), [len(h) for h in each])
    places = np.concatenate([np.arange(len(h)) for h in each])
    order = np.argsort(hashed, kind="stable")
    hashes, first = np.unique(hashed[order], return_index=True)
    bitmap = np.zeros(1 << 22, bool)
    bitmap[(hashes >> np.uint64(42)).astype(np.int64)] = True
    gap = np.full(STEP + EDITS + 2, GAP, np.uint32)
    flat = np.concatenate([gap, *[part for z in texts for part in (z, gap)]])
    begin = len(gap) + np.cumsum([0, *[len(z) + len(gap) for z in texts[:-1]]])
    return Index(np.array(ids), bitmap, hashes, np.append(first, len(hashed)), items[order], places[order], np.array(spans), flat, begin)


def hits(z: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every shared gram as (position, item, place in the item)."""
    h = gram_hashes(z)
    at = np.flatnonzero(index.bitmap[(h >> np.uint64(42)).astype(np.int64)])
    slot = np.minimum(np.searchsorted(index.hashes, h[at]), len(index.hashes) - 1)
    same = index.hashes[slot] == h[at]
    at, slot = at[same], slot[same]
    n = index.first[slot + 1] - index.first[slot]
    post = np.repeat(index.first[slot] - np.cumsum(n) + n, n) + np.arange(n.sum())
    return np.repeat(at, n), index.items[post], index.places[post]


def lemma_bound(span: np.ndarray, edits: int) -> np.ndarray:
    """Grams that a window of ``span`` characters shares with a copy of up to ``edits`` edits; with fewer edits where none would be left."""
    bound = span + 1 - Q
    for k in range(1, edits + 1):
        bound = np.where(span + 1 - Q * (k + 1) >= 1, span + 1 - Q * (k + 1), bound)
    return np.maximum(bound, 1)


def retained(at: np.ndarray, item: np.ndarray, place: np.ndarray, doc: np.ndarray, index: Index, edits: int) -> np.ndarray:
    """Whether each hit lies in a region that meets the lemma's bound.

    A region is a (document, item, band of diagonals) and a stretch of the document as long as the item's shortest window plus ``edits``.
    Bands are ``4 * (edits + 1)`` diagonals wide and overlap by half, so a copy that drifts by up to ``edits`` lies wholly in one.
    """
    keep = np.zeros(len(at), bool)
    width, bound = 4 * (edits + 1), lemma_bound(index.span, edits)
    pair = doc * len(index.ids) + item
    _, pair, total = np.unique(pair, return_inverse=True, return_counts=True)
    enough = np.flatnonzero(total[pair] >= bound[item])  # a pair with too few grams in all has no such region
    at, item, place, doc, pair = at[enough], item[enough], place[enough], doc[enough], pair[enough]
    for shift in (0, width // 2):
        band = (at - place + len(index.flat) + shift) // width
        order = np.argsort(pair * (int(band.max(initial=0)) + 1) + band, kind="stable")  # hits come in order of position
        d, i, b, p = doc[order], item[order], band[order], at[order]
        n = bound[i]
        last = np.arange(len(order)) + n - 1
        fits = last < len(order)
        end = np.where(fits, last, 0)
        fits &= (d[end] == d) & (i[end] == i) & (b[end] == b) & (p[end] - p <= index.span[i] + edits)
        cover = np.zeros(len(order) + 1, np.int64)
        np.add.at(cover, np.flatnonzero(fits), 1)
        np.add.at(cover, last[fits] + 1, -1)
        keep[enough[order]] |= np.cumsum(cover)[:-1] > 0
    return keep


def _matches(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
    """How many codes from ``a[i]`` and ``b[j]`` on are equal, forwards or backwards (``way`` -1: from the code before)."""
    length, live = np.zeros(len(i), np.int64), np.arange(len(i))
    steps = np.arange(STEP) if way > 0 else -1 - np.arange(STEP)
    while len(live):
        at, to = i[live] + way * length[live], j[live] + way * length[live]
        differ = np.take(a, at[:, None] + steps, mode="clip") != np.take(b, to[:, None] + steps, mode="clip")
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), STEP)
        length[live] += first
        live = live[first == STEP]
    return length


def _reaches(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, way: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Farthest-reaching alignment within the band of ``edits`` diagonals: for each number of edits (row) and anchor, codes of ``a`` and of ``b`` covered."""
    far_a, far_b = np.zeros((edits + 1, len(i)), np.int64), np.zeros((edits + 1, len(i)), np.int64)
    reach = {0: _matches(a, b, i, j, way)}
    far_a[0] = far_b[0] = reach[0]
    for e in range(1, edits + 1):
        grown = {}
        for diagonal in range(-e, e + 1):
            tries = [reach[d] + up for d, up in ((diagonal, 1), (diagonal - 1, 0), (diagonal + 1, 1)) if d in reach]
            ahead = np.maximum(np.max(tries, axis=0), max(0, -diagonal))
            grown[diagonal] = ahead + _matches(a, b, i + way * ahead, j + way * (ahead + diagonal), way)
        reach = grown
        best = np.stack([2 * reach[d] + d for d in reach]).argmax(axis=0)
        order = list(reach)
        far_a[e] = np.choose(best, [reach[d] for d in order])
        far_b[e] = np.choose(best, [reach[d] + d for d in order])
    return far_a, far_b


def aligned_span(index: Index, z: np.ndarray, at: np.ndarray, begin: np.ndarray, length: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each anchor (equal codes from ``flat[begin]`` and ``z[at]`` on), the stretch of ``flat`` in the longest alignment with at most ``edits`` edits."""
    right, right_z = _reaches(index.flat, z, begin + length, at + length, 1, edits)
    left, left_z = _reaches(index.flat, z, begin, at, -1, edits)
    total = np.stack([left[e] + left_z[e] + right[edits - e] + right_z[edits - e] for e in range(edits + 1)])
    split, k = total.argmax(axis=0), np.arange(len(at))
    return begin - left[split, k], begin + length + right[edits - split, k]


def whole_words(index: Index, z: np.ndarray, at: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whole words that both texts have in an exact run: words cut at either end of the run in either text don't count."""
    started = np.append(0, np.cumsum(_word_starts(z)))
    n = started[at + length] - started[at]
    inside = z[at] > PAD
    n += inside & (z[at - 1] > PAD)  # the word that the run begins in
    cut_left = inside & ((z[at - 1] > PAD) | (index.flat[begin - 1] > PAD))
    end, end_flat = at + length, begin + length
    cut_right = (z[end - 1] > PAD) & ((z[end] > PAD) | (index.flat[end_flat] > PAD))
    return np.maximum(n - cut_left - cut_right, 0)


def leaks_in(z: np.ndarray, index: Index, words: int, edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document numbers, item numbers, most consecutive shared words, words of the longest aligned region, of a slab of documents."""
    pad = np.full(STEP + edits + 2, PAD, np.uint32)
    z = np.concatenate([pad, z, pad])
    at, item, place = hits(z, index)
    doc = np.cumsum(z == EDGE)[at]
    keep = retained(at, item, place, doc, index, edits)
    at, item, place, doc = at[keep], item[keep], place[keep], doc[keep]
    order = np.lexsort((at, at - place, item))
    at, item, place, doc = at[order], item[order], place[order], doc[order]
    new = np.ones(len(at), bool)
    new[1:] = (item[1:] != item[:-1]) | (at[1:] - place[1:] != at[:-1] - place[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    grams = np.diff(np.append(first, len(at)))
    least = -(-lemma_bound(index.span, edits) // (edits + 1))  # some exact run of a region has at least this share of its grams
    first, grams = first[grams >= least[item[first]]], grams[grams >= least[item[first]]]
    at, item, place, doc, length = at[first], item[first], place[first], doc[first], grams + Q - 1
    begin = index.begin[item] + place
    started = np.append(0, np.cumsum(_word_starts(index.flat)))
    low, high = aligned_span(index, z, at, begin, length, edits)
    aligned = started[high] - started[low]
    good = aligned >= words
    at, begin, item, doc, length, aligned = (x[good] for x in (at, begin, item, doc, length, aligned))
    exact = whole_words(index, z, at, begin, length)
    pairs, where = np.unique(np.stack([doc, item]), axis=1, return_inverse=True)
    most, longest = np.zeros(pairs.shape[1], np.int64), np.zeros(pairs.shape[1], np.int64)
    np.maximum.at(most, where.ravel(), exact)
    np.maximum.at(longest, where.ravel(), aligned)
    return pairs[0], pairs[1], most, longest


def _slabs(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > SLAB:
            yield begin, k
            begin, size = k, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def leaks(docs: DataFrame, items: DataFrame, ident: str, text: str, words: int = 12, edits: int = EDITS, block_chars: int = 8_000_000) -> DataFrame:
    """``ident, item_id, words, aligned``: documents that hold a part of a passage, with the most consecutive shared words and the words of
    the longest region that aligns within ``edits`` edits; only regions of at least ``words`` words are returned.

    The passages are indexed in blocks of at most ``block_chars`` characters (more passages mean more blocks, each one scan of the corpus);
    the corpus is scanned whole, in place, without any shuffle of texts. Null texts, null passages and passages of fewer than ``words`` words
    never match; repeated rows give one row for each pair; empty tables give no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    schema = f"{ident} long, item_id long, words int, aligned int"
    out = docs.sparkSession.createDataFrame([], schema)
    slim = docs.select(F.col(ident).cast("long").alias("ident"), F.col(text).alias("text")).where("ident IS NOT NULL AND text IS NOT NULL")
    block: list[tuple[int, str]] = []

    def scan(rows: list[tuple[int, str]]) -> DataFrame | None:
        index = build_index(rows, words)
        if index is None:
            return None
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, texts = batch.column("ident").to_numpy(zero_copy_only=False), batch.column("text").to_pylist()
                for begin, end in _slabs(texts):
                    z = codes("\x01".join(t.replace("\x01", " ") for t in texts[begin:end]))
                    d, i, exact, aligned = leaks_in(z, shared.value, words, edits)
                    if len(d):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[begin:end][d]), pa.array(shared.value.ids[i]), pa.array(exact.astype(np.int32)), pa.array(aligned.astype(np.int32))],
                            names=[ident, "item_id", "words", "aligned"],
                        )

        return slim.mapInArrow(run, schema)

    size, parts = 0, []
    for row in items.where("item_id IS NOT NULL AND passage IS NOT NULL").select("item_id", "passage").toLocalIterator():
        if size and size + len(row.passage) > block_chars:
            parts.append(scan(block))
            block, size = [], 0
        block.append((row.item_id, row.passage))
        size += len(row.passage)
    parts.append(scan(block))
    for part in parts:
        out = out.unionByName(part) if part is not None else out
    return out.groupBy(ident, "item_id").agg(F.max("words").alias("words"), F.max("aligned").alias("aligned"))
