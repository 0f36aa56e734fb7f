"""Benchmark passages in documents, found by counting shared q-grams and verified by alignment.

If a passage of m characters stands in a text with at most e edits, at least m - q + 1 - q*e of its
q-grams stand there too, on diagonals (place in the text less place in the passage) that lie within e
of one another. Diagonals are cut into bands twice as wide as the budget that overlap by half, so that
one band holds them all; bands with fewer shared q-grams are dropped, the others are aligned.

So are the passage's parts, 100 characters at each multiple of 25, under a budget of their own: a
stretch of at least 124 characters of a passage holds one, wherever it begins. Passages shorter than q
are looked up as they are.

Passages are handled in blocks of bounded size; each block is a table that every task holds while it
streams all texts once. Case and white space are levelled first, on both sides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import map_rows
from orderlens.session import materialize

Q = 8
EDIT_RATE = 0.10
"""Share of a whole passage's characters that may be edited."""

PART, PART_STEP, PART_EDITS = 100, 25, 5
"""Length of the parts of longer passages, how far apart they begin, and the edits allowed in one."""

BLOCK_BYTES = 3_500_000
"""Text of passages whose q-gram table is broadcast at a time; further passages take further rounds. A
table takes about 38 bytes a character, so one of a whole block 130 MB."""

_TABLE_BITS = 22
_STARTS = re.compile(r"\b\w|[^\w\s]")
_HITS = 1_000_000
"""Shared q-grams counted at a time."""

SCHEMA = "doc_id long, item_id long, start long, end long, edits long"


def level(text: str) -> str:
    """Lower case, each run of white space one space, none at the ends."""
    return " ".join(text.lower().split())


def budget(length: int) -> int:
    """Edits allowed in a passage of that length: a fixed rate, as far as the q-gram bound reaches."""
    return max(0, min(int(length * EDIT_RATE), (length - Q) // Q))


def _grams(text: str) -> np.ndarray:
    """A hash of the q characters at each place. Equal grams hash equally; the rest is verified."""
    n = len(text) - Q + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    try:
        codes = text.encode("latin-1")
    except UnicodeEncodeError:
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        codes = (points ^ (points >> 8) ^ (points >> 16)).astype(np.uint8).tobytes()
    codes += bytes(16)
    # The eight bytes at each place, read at each of eight offsets.
    eight = np.empty(len(codes) // 8 * 8 - 8, np.uint64)
    for offset in range(8):
        eight[offset::8] = np.frombuffer(codes, "<u8", len(eight) // 8, offset)
    mixed = eight[:n] * np.uint64(0x9E3779B97F4A7C15) ^ eight[Q - 8 : Q - 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed ^ (mixed >> np.uint64(29))


def align(passage: str, text: str, start: int, spread: int, limit: int) -> tuple[int, int, int] | None:
    """The best place of the passage in ``text`` on diagonals from ``start`` to ``start + spread``.

    Returns (edits, start, end) with the fewest edits, at most ``limit``, or None. Rows are the
    passage's characters; only cells of the band are computed.
    """
    first = text.find(passage, max(0, start), max(0, start) + len(passage) + spread + limit)
    if first >= 0:
        return 0, first, first + len(passage)
    if limit == 0:
        return None
    low, width = start - limit, spread + 2 * limit + 1
    if low + width + len(passage) <= 0 or low >= len(text):
        return None
    places = low + np.arange(width)
    far = limit + 1
    # cost[k]: edits of the passage's first i characters against text ending at places[k] + i.
    cost = np.where((places >= 0) & (places <= len(text)), 0, far).astype(np.int32)
    begin = places.copy()
    points = np.frombuffer(text[max(0, low) : max(0, low + width + len(passage))].encode("utf-32-le"), "<u4")
    padded = np.full(width + len(passage), 0xFFFFFFFF, np.uint32)
    offset = max(0, -low)
    padded[offset : offset + len(points)] = points[: len(padded) - offset]
    steps = np.arange(width)
    for i, letter in enumerate(np.frombuffer(passage.encode("utf-32-le"), "<u4")):
        window = padded[i : i + width]
        outside = (window == 0xFFFFFFFF).astype(np.int32) * far
        by_pair = cost + (window != letter) + outside
        new, came = by_pair, begin.copy()
        from_skip = np.flatnonzero(cost[1:] + 1 < by_pair[:-1])
        new[from_skip] = cost[from_skip + 1] + 1
        came[from_skip] = begin[from_skip + 1]
        # Characters of the text without a partner: a running minimum along the row.
        at = np.minimum.accumulate((new - steps) * np.int64(width + 1) + steps)
        source = at % (width + 1)
        cost = np.minimum(new[source] + (steps - source), far)
        begin = came[source]
        # No cell of a later row costs less than the least of this one.
        if i % 8 == 7 and cost.min() > limit:
            return None
    ends = places + len(passage)
    good = (cost <= limit) & (ends <= len(text)) & (ends >= 0) & (begin >= 0)
    if not good.any():
        return None
    best = min(np.flatnonzero(good).tolist(), key=lambda k: (cost[k], begin[k], ends[k]))
    return int(cost[best]), int(begin[best]), int(ends[best])


@dataclass
class Passages:
    """Q-gram table of a block of passages.

    Entries are the passages, and after them the parts of passages longer than a part, in order.
    """

    ids: list
    texts: list[str]
    budgets: np.ndarray
    """Edits allowed in each entry."""
    needed: np.ndarray
    """Shared q-grams that each entry needs."""
    owner: np.ndarray
    offset: np.ndarray
    """The passage of each entry, and where in it the entry begins."""
    parts: np.ndarray
    """How many parts each passage has."""
    grams: np.ndarray
    """Different hashes, sorted."""
    firsts: np.ndarray
    """Where each hash's occurrences begin in ``item`` and ``place``, and the end."""
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray
    short: dict[str, list]
    """Ids of the passages that have no q-gram, by their text."""

    def __post_init__(self):
        self.sizes = np.diff(self.firsts)
        n = len(self.texts)
        part_needs = PART - Q + 1 - Q * PART_EDITS
        self.first_part = n + np.cumsum(self.parts) - self.parts
        self.least = np.where(self.parts > 0, np.minimum(self.needed[:n], part_needs), self.needed[:n])
        self.short_sizes = sorted({len(text) for text in self.short})

    @classmethod
    def build(cls, rows: list[tuple]) -> Passages:
        rows = sorted({(item, level(text)) for item, text in rows}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        short: dict[str, list] = {}
        for item, text in rows:
            if 0 < len(text) < Q:
                short.setdefault(text, []).append(item)
        rows = [r for r in rows if len(r[1]) >= Q]
        texts = [text for _, text in rows]
        each = [_grams(text) for text in texts]
        grams = np.concatenate([*each, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(each)), [len(g) for g in each]) if each else np.zeros(0, np.int64)
        place = np.concatenate([*(np.arange(len(g)) for g in each), np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(grams, kind="stable")
        different, firsts = np.unique(grams[order], return_index=True)
        sizes = np.array([len(t) for t in texts], np.int64)
        parts = np.where(sizes > PART, (sizes - PART) // PART_STEP + 1, 0)
        of_part = np.repeat(np.arange(len(texts)), parts)
        starts = (np.arange(len(of_part)) - np.repeat(np.cumsum(parts) - parts, parts)) * PART_STEP
        owner = np.concatenate([np.arange(len(texts)), of_part])
        offset = np.concatenate([np.zeros(len(texts), np.int64), starts])
        budgets = [*(budget(len(t)) for t in texts), *[PART_EDITS] * len(of_part)]
        budgets = np.array(budgets, np.int64)
        needed = np.concatenate([sizes, np.full(len(of_part), PART)]) - Q + 1 - Q * budgets
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[different >> np.uint64(64 - _TABLE_BITS)] = True
        firsts = np.append(firsts, len(grams))
        return cls(
            [r[0] for r in rows], texts, budgets, needed, owner, offset, parts, different, firsts, item[order],
            place[order], table, short,
        )

    def find(self, text: str) -> Iterator[tuple]:
        """(item id, start, end, edits) of each passage in a levelled text.

        The best place of the whole passage, or, where it does not stand there as a whole, of its part
        with the fewest edits.
        """
        best: dict[int, tuple] = {}
        whole: set[int] = set()
        exact = -1
        # Entries come in order, so all whole passages before the parts.
        for entry, low in self._regions(text):
            if entry == exact:
                continue
            item, limit = int(self.owner[entry]), int(self.budgets[entry])
            is_part = entry >= len(self.texts)
            if is_part and item in whole:
                continue
            at = int(self.offset[entry])
            passage = self.texts[item][at : at + PART] if is_part else self.texts[item]
            first = text.find(passage)
            if first >= 0:
                got, exact = (0, first, first + len(passage)), entry
            else:
                got = align(passage, text, low, 2 * max(limit, 1), limit)
            if got and (item not in best or got < best[item]):
                best[item] = got
            if got and not is_part:
                whole.add(item)
        for item in sorted(best):
            edits, start, end = best[item]
            yield self.ids[item], start, end, edits
        yield from self._find_short(text)

    def _find_short(self, text: str) -> Iterator[tuple]:
        """Places of the passages that have no q-gram: exact, and not inside a word."""
        if not self.short:
            return
        found = set()
        for at in (m.start() for m in _STARTS.finditer(text)):
            for size in self.short_sizes:
                passage, after = text[at : at + size], text[at + size : at + size + 1]
                if passage in self.short and passage not in found:
                    if not (passage[-1].isalnum() and after.isalnum()):
                        found.add(passage)
                        for item in self.short[passage]:
                            yield item, at, at + size, 0

    def _hits(self, at: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Passage, place in it and place in the text of each shared q-gram."""
        size = self.sizes[known]
        hit = np.repeat(self.firsts[known] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return self.item[hit], self.place[hit], np.repeat(at, size)

    def _regions(self, text: str) -> list[tuple[int, int]]:
        """Entries and the lowest diagonal of the bands that hold enough shared q-grams."""
        if not len(self.grams):
            return []
        grams = _grams(text)
        at = np.flatnonzero(self.table.take(grams >> np.uint64(64 - _TABLE_BITS)))
        if not len(at):
            return []
        known = np.searchsorted(self.grams, grams[at])
        known[known == len(self.grams)] = 0
        same = self.grams[known] == grams[at]
        at, known = at[same], known[same]
        sizes = self.sizes[known]
        total = int(sizes.sum())
        if total < self.least.min():
            return []
        cuts = np.searchsorted(np.cumsum(sizes), np.arange(_HITS, total, _HITS)) + 1
        pieces = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]))
        # A passage with too few hits in all needs no bands.
        counts = np.zeros(len(self.texts), np.int64)
        for a, b in pieces:
            hits = self._hits(at[a:b], known[a:b])
            counts += np.bincount(hits[0], minlength=len(counts))
        enough = counts >= self.least
        if not enough.any():
            return []
        bands: dict[tuple[int, int], int] = {}
        for a, b in pieces:
            item, place, where = hits if len(pieces) == 1 else self._hits(at[a:b], known[a:b])
            kept = enough[item]
            item, place, where = item[kept], place[kept], where[kept]
            entries, diagonals, places = [item], [where - place], [place]
            for back in range(PART // PART_STEP):
                part = place // PART_STEP - back
                inside = (part >= 0) & (part < self.parts[item]) & (place - part * PART_STEP + Q <= PART)
                entries.append(self.first_part[item[inside]] + part[inside])
                diagonals.append((where - place + part * PART_STEP)[inside])
                places.append(place[inside])
            entry, diagonal = np.concatenate(entries), np.concatenate(diagonals)
            band = diagonal // np.maximum(self.budgets[entry], 1)
            # Each diagonal lies in the band that begins at its step and in the one before it.
            all_keys = np.concatenate([entry * (1 << 40) + band, entry * (1 << 40) + band - 1]) + (1 << 39)
            keys, shared = np.unique(all_keys, return_counts=True)
            if len(pieces) == 1:
                chosen = shared >= self.needed[keys >> 40]
                keys, shared = keys[chosen], shared[chosen]
                if not len(keys):
                    return []
                # A q-gram of the passage counts once, however often the band holds it.
                slot = np.minimum(np.searchsorted(keys, all_keys), len(keys) - 1)
                inside = keys[slot] == all_keys
                width = int(place.max()) + 1
                once = np.unique(slot[inside] * width + np.concatenate(places * 2)[inside])
                shared = np.bincount(once // width, minlength=len(keys))
            for key, count in zip(keys.tolist(), shared.tolist()):
                slot = (key >> 40, (key & ((1 << 40) - 1)) - (1 << 39))
                bands[slot] = bands.get(slot, 0) + count
        return sorted(
            (entry, band * max(int(self.budgets[entry]), 1))
            for (entry, band), count in bands.items()
            if count >= self.needed[entry]
        )


def _original(text: str) -> np.ndarray:
    """For each character of the levelled text, its place in the text; then the text's length."""
    places: list[int] = []
    gap = None
    for at, c in enumerate(text):
        if c.isspace():
            gap = at if gap is None else gap
            continue
        if gap is not None and places:
            places.append(gap)
        gap = None
        places += [at] * len(c.lower())
    return np.array([*places, (places[-1] + 1) if places else 0])


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    rows, size = [], 0
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        if rows and size + len(row["text"]) > block_bytes:
            yield rows
            rows, size = [], 0
        rows.append((row["item_id"], row["text"]))
        size += len(row["text"])
    yield rows


def contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document and benchmark passage that stands in it: doc_id, item_id, start, end and edits.

    A passage stands in a text where at most 10 % of its characters are edited (inserted, dropped or
    changed), case and runs of white space aside, as far as (length - 8) / 8 edits; or where one of its
    parts of 100 characters, one at each multiple of 25, stands with at most five edits, as in any
    stretch of 124 characters with no more. ``start`` and ``end`` are code points of the text, the place
    of the whole passage with the fewest edits, the first of several; where it does not stand as a whole,
    that of the part with the fewest. Passages of fewer than eight characters stand where they are equal
    and not inside a word; those without a character name nothing. Null texts, on either side, match nothing. Repeated documents and null
    ids give rows of their own; repeated passages give one row. Further columns are not read.
    """
    context = docs.sparkSession.sparkContext
    found = []
    for rows in _blocks(benchmark, block_bytes):
        shared = context.broadcast(Passages.build(rows))

        def each(doc_id: int | None, text: str, shared=shared) -> Iterator[tuple]:
            places = None
            for item, start, end, edits in shared.value.find(level(text)):
                places = _original(text) if places is None else places
                yield doc_id, item, int(places[start]), int(places[end - 1]) + 1, edits

        # Stored, so that no more than one block's table is held at a time.
        texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
        found.append(materialize(map_rows(texts, each, SCHEMA)))
        shared.destroy()
    return reduce(DataFrame.union, found)


def clean(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no passage stands; null texts stay.

    Decided row by row in one scan a block, so documents are never moved.
    """
    for rows in _blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(Passages.build(rows))

        def keep(batches, shared=shared):
            import pyarrow as pa

            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                clear = [t is None or not any(shared.value.find(level(t))) for t in texts]
                yield batch.filter(pa.array(clear, pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
