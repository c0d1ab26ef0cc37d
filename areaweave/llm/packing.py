"""Best-fit packing of tokenized documents into sequences of a fixed number of tokens.

Documents longer than a sequence are cut into whole sequences and a rest; nothing else is cut.
Packing only depends on how many pieces there are of each length, at most ``capacity`` numbers,
whatever the data: these counts are solved on the driver and the pieces are given their places
in parallel, by their rank among the pieces of their length.

The solver first applies Martello and Toth's reduction: starting with the largest length, a piece
and the companions that provably dominate every other choice for it are fixed for good and taken
out of the instance; the remainder is packed by best fit in decreasing order, equal lengths at
once.

Null text is empty: a document of one end token.  Repeated rows are documents of their own.  An
empty table gives no rows.
"""

from __future__ import annotations

import bisect
import os
import re
import string
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areaweave.llm.common import pick, stored

#: Words whose ids a worker remembers: up to twice as many lately seen, and as many from before.
REMEMBERED = 300_000
#: Words that pass the tokenizer at once.
AT_ONCE = 500
#: Information separators: Python's split takes them for white space, the tokenizer doesn't.
_SEPARATORS = re.compile("[\x1c-\x1f]")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordIds:
    """Ids of texts, as bytes, from remembered ids of their words.

    Where white space ends every token, which is tried out on the file at hand, a text's ids are those of its
    words in turn; texts pass any other tokenizer whole.  Where a full stop or comma after a letter is a token of
    its own and ASCII letters are lowered anyway, which is tried out too, forms that differ in these share an entry.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        one, ids = "Aword bz, 17", lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        ended = getattr(self.tokenizer.model, "end_of_word_suffix", None) == "</w>"
        spaces = [" ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u3000"]
        self.by_word = ended and all(ids(f"{s}{one}{s}{one}{s}") == 2 * ids(one) for s in spaces) and ids(one) == sum(
            (ids(w) for w in one.split()), [])
        self.lowers = all(ids(c) == ids(c.lower()) for c in string.ascii_uppercase)
        self.tails = all(ids(f"word{c}") == ids("word") + ids(c) for c in ",.")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # A word of one id of its own, to stand between words that pass together.
        marks = {c: ids(c) for c in "|~^\\`§¶"}
        self.mark = next((c for c, own in marks.items() if len(own) == 1 and self.by_word and ids(f"word {c} 1.5 {c} {c} a-b") == sum(
            (ids(w) for w in ("word", c, "1.5", c, c, "a-b")), [])), None)
        self.mark_id = marks[self.mark][0] if self.mark else None
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in done]

    def learn(self, bases: set[str]) -> None:
        """Words pass many at once: those of letters alone each end with a token that ends a word, others have a mark between them."""
        other = [b for b in bases if not b.isalpha()]
        letters = [b for b in bases if b.isalpha()]
        groups = [letters[i:i + AT_ONCE] for i in range(0, len(letters), AT_ONCE)]
        for at in range(0, len(groups), 20):
            some = groups[at:at + 20]
            encoded = self.tokenizer.encode_batch_fast([" ".join(g) for g in some], add_special_tokens=False)
            for group, e in zip(some, encoded, strict=True):
                ids = np.array(e.ids, "<u4")
                cuts = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
                if len(cuts) != len(group):
                    other += group
                    continue
                data = ids.tobytes()
                self.words.update((w, data[a:b]) for w, a, b in zip(group, [0, *cuts[:-1]], cuts, strict=True))
        rest = [b for b in other if self.mark is None or self.mark in b]
        other = [b for b in other if self.mark is not None and self.mark not in b]
        groups = [other[i:i + AT_ONCE] for i in range(0, len(other), AT_ONCE)]
        for at in range(0, len(groups), 20):
            some = groups[at:at + 20]
            encoded = self.tokenizer.encode_batch_fast([f" {self.mark} ".join(g) for g in some], add_special_tokens=False)
            for group, e in zip(some, encoded, strict=True):
                ids = np.array(e.ids, "<u4")
                cuts = (4 * np.flatnonzero(ids == self.mark_id)).tolist()
                if len(cuts) != len(group) - 1:
                    rest += group
                    continue
                data = ids.tobytes()
                self.words.update((w, data[a:b]) for w, a, b in zip(
                    group, [0, *[c + 4 for c in cuts]], [*cuts, len(data)], strict=True))
        for at in range(0, len(rest), 10_000):
            self.words.update(zip(rest[at:at + 10_000], self.encode(rest[at:at + 10_000]), strict=True))

    def add(self, words: set[str]) -> None:
        parts, need, older, tails, lowers = [], {",", "."}, self.older, self.tails, self.lowers
        for word in words:
            if older and (found := older.get(word)) is not None:
                self.words[word] = found
                continue
            tail = word[-1] if tails and word[-1] in ".," and len(word) > 1 and word[-2].isalpha() else ""
            base = word[:-1] if tail else word
            if lowers and base.isascii():
                base = base.lower()
            need.add(base)
            parts.append((word, base, tail))
        for base in list(need):
            if (found := self.older.get(base)) is not None:
                self.words[base] = found
        self.learn(need.difference(self.words))
        for word, base, tail in parts:
            self.words[word] = self.words[base] + (self.words[tail] if tail else b"")

    def of(self, texts: list[str]) -> list[bytes]:
        split = [None if not self.by_word or _SEPARATORS.search(text) else text.split() for text in texts]
        new = set().union(*[words for words in split if words]).difference(self.words)
        if len(self.words) + len(new) > 2 * REMEMBERED:
            self.words, self.older = {}, self.words
            new = set().union(*[words for words in split if words])
        self.add(new)
        ids = self.words
        return [self.encode([text])[0] if words is None else b"".join([ids[w] for w in words])
                for text, words in zip(texts, split, strict=True)]


def _groups(batch: pa.RecordBatch, chars: int = 4_000_000) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of a batch, by so many characters."""
    docs, texts, size = [], [], 0
    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        docs.append(doc)
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size > chars:
            yield docs, texts
            docs, texts, size = [], [], 0
    yield docs, texts


#: A worker process keeps what it has learnt from task to task.
_LEARNT: dict[str, WordIds] = {}


def _piece_batches(tokenizer_path: str, capacity: int, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if tokenizer_path not in _LEARNT:
            _LEARNT[tokenizer_path] = WordIds(tokenizer_path)
        ids_of, end, size = _LEARNT[tokenizer_path].of, end_id.to_bytes(4, "little"), 4 * capacity
        for batch in batches:
            rows = []
            for docs, texts in _groups(batch):
                for doc, ids in zip(docs, ids_of(texts), strict=True):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), size)):
                        part = ids[at:at + size]
                        rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
                     id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32."""
    rows = pick(docs, doc_id=id_column, text=text_column)
    return rows.mapInArrow(_piece_batches(tokenizer_path, capacity, end_id), PIECES)


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Sets fixed by dominance, with how often each, and the counts that are left."""
    left, fixed = {s: n for s, n in counts.items() if n > 0}, []
    sizes = sorted(left)

    def drop(size: int, n: int) -> None:
        left[size] -= n
        if not left[size]:
            del left[size]
            sizes.pop(bisect.bisect_left(sizes, size))

    def smallest(k: int) -> list[int]:
        out: list[int] = []
        for s in sizes:
            out += [s] * min(left[s], k - len(out))
            if len(out) == k:
                break
        return out

    def best_below(limit: int) -> int | None:
        i = bisect.bisect_right(sizes, limit) - 1
        return sizes[i] if i >= 0 else None

    for j in sorted(left, reverse=True):
        while left.get(j, 0):
            room = capacity - j
            left[j] -= 1  # the piece itself is no companion
            alone = not left[j]
            if alone:
                del left[j]
                sizes.pop(bisect.bisect_left(sizes, j))
            k = best_below(room)
            three = smallest(3)
            if k is None:
                chosen: tuple[int, ...] | None = ()
            elif k == room or sum(three[:2]) > room or len(three) < 2:
                chosen = (k,)
            elif len(three) < 3 or sum(three) > room:
                chosen = _two_companions(sizes, left, room, k)
            else:
                chosen = None
            if alone:
                bisect.insort(sizes, j)
            left[j] = left.get(j, 0) + 1
            if chosen is None:
                break
            members = (j, *chosen)
            need = {s: members.count(s) for s in members}
            times = min(left[s] // n for s, n in need.items())
            if len(chosen) == 2:
                # Whether it dominates depends on which lengths are left, and on whether there are two or three of one:
                # as long as four of each stay, the same set comes out again.
                times = max(1, min((left[s] - 4) // n for s, n in need.items()))
            fixed.append((members, times))
            for s, n in need.items():
                drop(s, n * times)
    return fixed, left


def _two_companions(sizes: list[int], left: dict[int, int], room: int, k: int) -> tuple[int, ...] | None:
    """Where at most two companions fit: the single or the pair that dominates all others, if any does."""
    largest_pair, lesser = 0, 0  # sum of the fullest pair; the most that the smaller of a pair can be
    low, high = 0, len(sizes) - 1
    while low <= high:
        a, b = sizes[low], sizes[high]
        if a + b > room or (low == high and left[a] < 2):
            high -= 1
            continue
        largest_pair, lesser = max(largest_pair, a + b), max(lesser, a)
        low += 1
    if k >= largest_pair:
        return (k,)
    i = bisect.bisect_right(sizes, room - k) - 1
    while i >= 0 and sizes[i] == k and left[k] < 2:
        i -= 1
    return (k, sizes[i]) if i >= 0 and sizes[i] >= lesser else None


def pack_counts(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs of (length, first rank, how many, first sequence, offset), and the number of sequences.

    Within a run, rank and sequence go up together.
    """
    ranks: dict[int, int] = {}
    runs: list[tuple[int, int, int, int, int]] = []
    used = 0

    def put(size: int, n: int, sequence: int, offset: int) -> None:
        first = ranks.get(size, 0)
        runs.append((size, first, n, sequence, offset))
        ranks[size] = first + n

    fixed, left = reduce_instance(counts, capacity)
    for members, times in fixed:
        offset = 0
        for size in members:
            put(size, times, used, offset)
            offset += size
        used += times
    rooms: dict[int, list[tuple[int, int]]] = {}  # room: ranges of (first sequence, how many)
    order: list[int] = []

    def give(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in rooms:
                rooms[room] = []
                bisect.insort(order, room)
            rooms[room].append((first, n))

    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            i = bisect.bisect_left(order, size)
            if i < len(order):
                room = order[i]
                first, bins = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    order.pop(i)
            else:
                room, first, bins = capacity, used, -(-n // (capacity // size))
                used += bins
            each = room // size  # best fit fills the tightest sequence for as long as it can
            full = min(bins, n // each)
            for x in range(each if full else 0):
                put(size, full, first, capacity - room + x * size)
            give(room - each * size, first, full)
            n -= full * each
            rest = 0
            if full < bins and n:
                rest = n
                for x in range(rest):
                    put(size, 1, first + full, capacity - room + x * size)
                give(room - rest * size, first + full, 1)
                n = 0
            untouched = bins - full - bool(rest)
            if untouched:
                give(room, first + full + bool(rest), untouched)
    return runs, used


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """Every piece with its sequence and its offset there.

    The pieces are written once.  Only the counts by length and the runs, both bounded by the
    capacity and not by the data, pass through the driver.
    """
    pieces = stored(tokenized_pieces(docs, tokenizer_path, capacity, end_id, id_column, text_column), "pieces")
    return place(pieces, capacity)


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Sequence and offset of pieces that are at hand."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs, _ = pack_counts(counts, capacity)
    table = np.array(sorted(runs) or np.empty((0, 5)), np.int64).reshape(-1, 5)
    # Ranks within a length, by slices so small that a length with most of the pieces spreads.
    slices = 64 + sum(counts.values()) // 100_000
    rows = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)))
    before = rows.groupBy("length", "slice").agg(F.count("*").alias("n")).select(
        "length", "slice", (F.sum("n").over(Window.partitionBy("length").orderBy("slice")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    rows = rows.withColumn("inside", F.row_number().over(inside) - 1).join(before, ["length", "slice"])
    rows = rows.select("doc_id", "piece", "start", "length", "ids_crc32",
                       (F.col("before") + F.col("inside")).alias("rank"))

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] * (1 << 48) + table[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            run = table[np.searchsorted(keys, length * (1 << 48) + rank, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")],
                 pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return rows.mapInArrow(assign, PIECES + ", sequence_id long, offset long")
