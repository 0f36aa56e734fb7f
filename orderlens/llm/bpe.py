"""Byte-level BPE encoding by merge replay over all words of a block of documents, and decoding.

Texts are split by the tokenizer's pattern. The different words of a block that the task has not met
yet are encoded together: an inverted index leads from a merge's rank to the places where its pair of
tokens stands, the merges are applied in rank order over all words at once, and each application
updates only the neighbours it touches. Documents are then read off the encoded words, and the ids
are decoded back to bytes through the id table.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from orderlens.llm.common import arrow_schema, to_batch

BLOCK_CHARS = 2_000_000
"""Characters of documents whose new words are replayed together."""

KNOWN_PIECES = 200_000
"""Encoded pieces a worker keeps; beyond that it starts afresh, at the cost of encoding them again."""

_CUT = re.compile(r" (?=\S)")
_UNEVEN = re.compile(r" (?:\s|\Z)")

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, of a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MergeReplay:
    """Encodes many words at once by the ranks of a byte-level vocabulary.

    Tokens of all words lie in one array of slots; ``left`` and ``right`` lead to the neighbouring slot
    of the same word, and ``pair`` holds the rank of a slot's token with the one to its right, -1 where
    those bytes are no token or there is none. ``index[rank]`` lists the slots that had such a pair.
    The lowest rank of the whole block is also the lowest of each word that has it, so one queue serves
    all words. A merge that makes a pair of a lower rank than its own would let that one go first
    within its word; such words, which common vocabularies hardly know, are encoded on their own.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.rank_of = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.rank_of[a << 32 | b] = rank
        self._pairs = np.array(sorted(self.rank_of), np.int64)
        self._ranks = np.array([self.rank_of[pair] for pair in self._pairs.tolist()], np.int32)

    def encode(self, words: Iterable[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        words = list(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word_of = np.repeat(np.arange(len(words)), lengths)
        n = len(word_of)
        tokens = self.single[np.frombuffer(b"".join(words), np.uint8)]
        left, right = np.arange(-1, n - 1), np.arange(1, n + 1)
        ends = np.cumsum(lengths)
        right[ends[lengths > 0] - 1] = -1
        left[(ends - lengths)[lengths > 0]] = -1
        odd = self._replay(tokens, left, right)
        kept = np.flatnonzero(tokens >= 0)
        bounds = np.cumsum(np.bincount(word_of[kept], minlength=len(words)))[:-1]
        ids = tokens[kept].astype("<u4").tobytes()
        bounds = (bounds * 4).tolist()
        out = [ids[a:b] for a, b in zip([0, *bounds], [*bounds, len(ids)])] if words else []
        for i in np.unique(word_of[odd]).tolist():
            out[i] = np.array(self.encode_word(words[i]), "<u4").tobytes()
        return out

    def encode_word(self, word: bytes) -> list[int]:
        """One word alone: always the leftmost pair of the lowest rank."""
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        while True:
            ranks = [self.rank_of.get(a << 32 | b, -1) for a, b in zip(ids, ids[1:])]
            lowest = min((r for r in ranks if r >= 0), default=-1)
            if lowest < 0:
                return ids
            at = ranks.index(lowest)
            ids[at : at + 2] = [lowest]

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pairs = (a.astype(np.int64) << 32) | b
        at = np.searchsorted(self._pairs, pairs)
        at[at == len(self._pairs)] = 0
        return np.where(self._pairs[at] == pairs, self._ranks[at], -1) if len(self._pairs) else at - 1

    def _replay(self, tokens: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merges in place; slots of the words to be encoded on their own."""
        pair = np.full(len(tokens), -1, np.int32)
        inner = np.flatnonzero(right >= 0)
        pair[inner] = self._rank(tokens[inner], tokens[right[inner]])
        index: dict[int, list[int]] = {}
        queue: list[int] = []
        listed = np.flatnonzero(pair >= 0)
        order = listed[np.argsort(pair[listed], kind="stable")]
        present, firsts = np.unique(pair[order], return_index=True)
        for rank, slots in zip(present.tolist(), np.split(order, firsts[1:])):
            index[rank] = slots.tolist()
            queue.append(rank)
        odd = []
        while queue:
            rank = heapq.heappop(queue)
            slots = np.sort(np.array(index.pop(rank), np.int64))
            slots = slots[np.concatenate([[True], slots[1:] != slots[:-1]])]
            slots = slots[pair[slots] == rank]
            if len(slots) > 1:
                slots = slots[_alternate(right[slots[:-1]] == slots[1:])]
            if not len(slots):
                continue
            gone = right[slots]
            beyond = right[gone]
            near = beyond >= 0
            # What stands to the right before its own merge: the pair that a word alone would see next.
            passing = self._rank(np.full(near.sum(), rank), tokens[beyond[near]])
            odd.append(slots[near][(passing >= 0) & (passing < rank)])
            tokens[slots] = rank
            tokens[gone] = pair[gone] = -1
            right[slots] = beyond
            left[beyond[near]] = slots[near]
            pair[slots] = -1
            before = left[slots]
            touched = np.concatenate([slots[near], before[before >= 0]])
            ranks = self._rank(tokens[touched], tokens[right[touched]])
            pair[touched] = ranks
            odd.append(touched[(ranks >= 0) & (ranks < rank)])
            new = ranks > rank
            for r, slot in zip(ranks[new].tolist(), touched[new].tolist()):
                if r in index:
                    index[r].append(slot)
                else:
                    index[r] = [slot]
                    heapq.heappush(queue, r)
        return np.concatenate(odd) if odd else np.zeros(0, np.int64)


def _alternate(overlaps: np.ndarray) -> np.ndarray:
    """Of sorted places, where ``overlaps[i]`` joins the i-th to the next: every other one of each chain."""
    starts = np.concatenate([[True], ~overlaps])
    at = np.arange(len(starts))
    return (at - np.maximum.accumulate(np.where(starts, at, 0))) % 2 == 0


class Encoder:
    """Texts to ids and back, with the words met so far.

    Texts are first cut before every space that a visible character follows. No match of a tokenizer's
    pattern crosses such a cut (a match holds a space in front or is white space alone, and leaves the
    last space before a visible character to what follows), so the pattern runs on new pieces only.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replay = MergeReplay(ranks)
        self.split = regex.compile(pattern).findall
        self.ids_of: dict[str, bytes] = {}
        self.ids_of_word: dict[str, bytes] = {}
        tokens = [self.replay.bytes_of.get(i, b"") for i in range(max(ranks.values(), default=-1) + 1)]
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        if len(self.ids_of) > KNOWN_PIECES:
            self.ids_of = {}
        known = self.ids_of.get
        found, missing, firsts = [], [], []
        new: dict[str, bytes] = {}
        for text in texts:
            pieces = _CUT.split(text) if _UNEVEN.search(text) else text.split(" ")
            # The first piece has no space in front; it is looked up under a key no other piece has.
            firsts.append(pieces[0])
            pieces[0] = " "
            ids = list(map(known, pieces))
            found.append(ids)
            lacking = [i for i, of_piece in enumerate(ids) if of_piece is None] if None in ids else []
            lacking = [(i, pieces[i]) for i in lacking if i]
            missing.append(lacking)
            new.update(dict.fromkeys([piece for _, piece in lacking]))
        words = [self.split(piece) for piece in firsts] + [self.split(" " + piece) for piece in new]
        if len(self.ids_of_word) > KNOWN_PIECES:
            self.ids_of_word = {}
        ids_of_word = self.ids_of_word
        different = list(set().union(*words).difference(ids_of_word))
        replayed = self.replay.encode([word.encode() for word in different])
        ids_of_word.update(zip(different, replayed))
        encoded = [b"".join([ids_of_word[word] for word in of_piece]) for of_piece in words]
        new = dict(zip(new, encoded[len(firsts) :]))
        self.ids_of.update(new)
        for ids, first, lacking in zip(found, encoded, missing):
            ids[0] = first
            for i, piece in lacking:
                ids[i] = new[piece]
        return [b"".join(ids) for ids in found]

    def decode(self, ids: bytes) -> bytes:
        tokens = np.frombuffer(ids, "<u4")
        lengths = self.lengths[tokens]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[tokens] - ends + lengths, lengths)
        return self.bytes[shift + np.arange(len(shift))].tobytes()


@lru_cache(maxsize=2)
def shared_encoder(ranks_path: str, pattern: str) -> Encoder:
    """One encoder for the tasks that a Python worker runs in turn."""
    return Encoder(load_ranks(ranks_path), pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, and the SHA-256 of the ids and of the decoded bytes.

    A null text is empty: no tokens. A text of any length is encoded whole, but words of a block share
    one replay. ``keep_ids`` adds the column ``ids`` (array of int). Nulls in doc_id pass through,
    repeated rows stay, an empty table gives an empty result, further columns of ``docs`` are not read.
    ``ranks_path`` must lead to the same vocabulary file on every executor.
    """
    schema = SCHEMA + (", ids array<int>" if keep_ids else "")
    fields = arrow_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(ranks_path, pattern)
        for batch in batches:
            doc_ids, texts = (column.to_pylist() for column in batch.columns)
            texts = [text or "" for text in texts]
            for a, b in _blocks(texts):
                rows = []
                for doc_id, ids in zip(doc_ids[a:b], encoder.encode(texts[a:b])):
                    decoded = hashlib.sha256(encoder.decode(ids)).hexdigest()
                    row = (doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded)
                    rows.append(row + (np.frombuffer(ids, "<i4"),) if keep_ids else row)
                yield to_batch(rows, fields)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BLOCK_CHARS`` characters; a longer text is a block of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BLOCK_CHARS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
