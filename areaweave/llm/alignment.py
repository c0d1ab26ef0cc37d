"""Alignment of two tokenizers' tokens over one text, and counts of the pairs that are aligned.

A text, with a space before it, is cut into tokens A by a byte-level BPE and into tokens B by a
sentence-piece model.  Both cuts are sorted lists of byte offsets, and they are merged by the
merge-path method: binary searches along diagonals of the merge matrix cut the merge of a whole
batch of texts into pieces of equally many steps, whatever the texts' lengths, which need nothing
of each other.  A piece emits its overlaps (an A token and a B token that share bytes, and whether
both end there); pieces are stitched by dropping what two neighbours both emit for an end that one
of them has as its last A and the other as its first B.  Overlaps up to one that closes are a group.

All A-B pairs in a group are linked.  Pairs of a document are counted once, summed in each task
before the shuffle, and added up over the corpus.  To give documents the counts of their pairs, the
most frequent pairs, ``SENT`` at most, are sent to all tasks, which settles most links where the
document is; links of all other pairs meet their counts in a join, in which no key has more rows
than the least frequent pair that was sent.  So results are the same wherever that line is drawn.

Null and empty texts, and texts that tokens of either kind do not give back byte for byte, have no
tokens: zeros and an empty ``groups``.  Repeated rows are documents of their own and each counts as
one.  A long text is one value in a task, but its pairs are worked out ``LINKS`` at a time.  An empty
table gives no rows.  Columns besides id and text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaweave.llm.common import pick, stored

#: Steps of the merge in one piece.
STEPS = 16_384
#: Links of a document that are held at once, and pairs that a task adds up before it sends them on.
LINKS = 2_000_000
#: Pairs whose counts are sent to all tasks at most: 16 MB.
SENT = 1_000_000
#: Characters of texts that are worked on at once.
CHARS = 2_000_000
#: Fixed value: the published split pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

TOKENS = ("doc_id long, a binary, b binary, a_cut binary, b_cut binary, n_a long, n_b long, n_groups long, "
          "n_links long, groups_sha256 string")
SUMS = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string, pair long, links long")
_ARROW = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _batch(schema: str, columns: dict) -> pa.RecordBatch:
    """A batch of the named columns; those not given are null."""
    n = len(next(iter(columns.values())))
    fields = [field.split() for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[name], _ARROW[kind]) if name in columns else pa.nulls(n, _ARROW[kind])
                                       for name, kind in fields], [name for name, _ in fields])


class ByteTokens:
    """Ids by a byte-level BPE file, and the bytes of every id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        # Printable Latin-1 characters stand for their own byte, the others for 256 and up, in order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [i for i in range(256) if i not in plain]
        shown = {chr(i): i for i in plain} | {chr(256 + n): i for n, i in enumerate(other)}
        vocabulary = {token: i for token, i in model["vocab"].items() if all(c in shown for c in token)}
        self.bytes = [b""] * (1 + max([*model["vocab"].values(), *[t["id"] for t in spec["added_tokens"]]]))
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(shown[c] for c in token)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # Where ids rise with the merges, the ids alone say which merge comes first.
        if (spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                and not split.get("add_prefix_space") and not model.get("dropout") and not model.get("ignore_merges")
                and all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges))):
            import tiktoken

            ranks = {self.bytes[i]: i for i in vocabulary.values()}
            self._encode = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks,
                                             special_tokens={}).encode_ordinary
        else:
            whole = Tokenizer.from_file(path)
            whole.encode_special_tokens = True
            self._encode = lambda text: whole.encode(text, add_special_tokens=False).ids

    def of(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text after a space."""
        return [self._encode(" " + text) for text in texts]


class PieceTokens:
    """Ids by a sentence-piece model, which puts the space before itself, and the bytes of every id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
                              else piece.replace("▁", " ").encode())

    def of(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


#: A worker process loads a vocabulary once.
_LOADED: dict[tuple[type, str], object] = {}


def _loaded(kind: type, path: str):
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]


def merge_pieces(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two sorted lists is cut so that each piece has ``steps`` steps; equal values take ``a`` first.

    One binary search for each diagonal, all diagonals at once.
    """
    diagonal = np.arange(0, len(a) + len(b) + steps, steps).clip(max=len(a) + len(b))
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        first = open_.copy()
        first[open_] = a[middle[open_]] <= b[diagonal[open_] - middle[open_] - 1]
        low = np.where(first, middle + 1, low)
        high = np.where(open_ & ~first, middle, high)
    return low, diagonal - low


def overlaps(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Overlaps of tokens that end at ``a`` and ``b``, piece by piece: indexes of both and whether both end there.

    Both lists rise strictly and end at the same offset.
    """
    rows, columns = merge_pieces(a, b, steps)
    for i, i_end, j, j_end in zip(rows[:-1], rows[1:], columns[:-1], columns[1:], strict=True):
        if i and j < j_end and b[j] == a[i - 1]:
            j += 1  # stitched: the piece before has emitted this end
        x, y = a[i:i_end], b[j:j_end]
        if not len(x) + len(y):
            continue
        ends = np.union1d(x, y)
        at, bt = i + np.searchsorted(x, ends), j + np.searchsorted(y, ends)
        yield at, bt, (a[at] == ends) & (b[bt] == ends)


def groups_of(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of either list end a group."""
    a_cut, b_cut = np.zeros(len(a), bool), np.zeros(len(b), bool)
    for at, bt, closes in overlaps(a, b, steps):
        a_cut[at[closes]] = b_cut[bt[closes]] = True
    return a_cut, b_cut


def _group_numbers(cut: np.ndarray) -> np.ndarray:
    return np.cumsum(cut) - cut


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of a batch, by so many characters."""
    docs, texts, size = [], [], 0
    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        docs.append(doc)
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size > CHARS:
            yield docs, texts
            docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def _shown(ids: np.ndarray, cut: np.ndarray, last: int, width: int) -> np.ndarray:
    """Entries of the table of texts of ids: followed by a comma, or by the mark that ends a group's list."""
    return np.where(cut, ids + last * width, ids)


def _sizes(table: list[bytes]) -> np.ndarray:
    return np.array([len(x) for x in table], np.int64)


def _tokenize(a_path: str, b_path: str):
    """Tokens and groups of each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _loaded(ByteTokens, a_path), _loaded(PieceTokens, b_path)
        sizes = [_sizes(kind.bytes) for kind in kinds]
        width = max(len(s) for s in sizes)
        marked = [f"{i}{mark}".encode() for mark in ",|;" for i in range(width)]
        for batch in batches:
            for docs, texts in _texts(batch):
                both = [kind.of(texts) for kind in kinds]
                whole = [(" " + text).encode() if text else b"" for text in texts]
                for k, text in enumerate(whole):
                    if not text or any(b"".join(map(kind.bytes.__getitem__, ids[k])) != text
                                       for kind, ids in zip(kinds, both, strict=True)):
                        both[0][k] = both[1][k] = []
                a, b = (np.fromiter((i for ids in one for i in ids), np.int64) for one in both)
                # One merge for all texts: every text's last tokens end together.
                a_cut, b_cut = groups_of(np.cumsum(sizes[0][a]), np.cumsum(sizes[1][b]))
                a_group, b_group = _group_numbers(a_cut), _group_numbers(b_cut)
                in_order = np.empty(len(a) + len(b), np.int64)
                n_groups = int(a_cut.sum())
                a_in, b_in = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
                in_order[np.arange(len(a)) + (np.cumsum(b_in) - b_in)[a_group]] = _shown(a, a_cut, 1, width)
                in_order[np.arange(len(b)) + np.cumsum(a_in)[b_group]] = _shown(b, b_cut, 2, width)
                links = np.concatenate([[0], np.cumsum(a_in * b_in)])
                a_at, b_at = (np.cumsum([0, *map(len, ids)]) for ids in both)
                group_at = np.concatenate([[0], np.cumsum(a_cut)])[a_at]
                out = {name.split()[0]: [] for name in TOKENS.split(", ")}
                for k, doc in enumerate(docs):
                    i, i_end, j, j_end = a_at[k], a_at[k + 1], b_at[k], b_at[k + 1]
                    g, g_end = group_at[k], group_at[k + 1]
                    groups = b"".join(map(marked.__getitem__, in_order[i + j:i_end + j_end].tolist()))[:-1]
                    values = (doc, a[i:i_end].astype("<u4").tobytes() if width > 65536 else a[i:i_end].astype("<u2").tobytes(),
                              b[j:j_end].astype("<u4").tobytes() if width > 65536 else b[j:j_end].astype("<u2").tobytes(),
                              np.packbits(a_cut[i:i_end]).tobytes(), np.packbits(b_cut[j:j_end]).tobytes(),
                              int(i_end - i), int(j_end - j), int(g_end - g), int(links[g_end] - links[g]),
                              hashlib.sha256(groups).hexdigest() if groups else "")
                    for column, value in zip(out.values(), values, strict=True):
                        column.append(value)
                yield _batch(TOKENS, out)

    return run


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Rows of a batch that have ``LINKS`` links at most together; a row with more stands alone."""
    first, held = 0, 0
    for k, n in enumerate(batch.column("n_links").to_pylist()):
        if held and held + n > LINKS:
            yield first, k
            first, held = k, 0
        held += n
    yield first, batch.num_rows


def _read_tokens(batch: pa.RecordBatch, first: int, end: int) -> tuple[np.ndarray, ...]:
    """Ids, group numbers and documents (from 0) of the tokens of some rows, for A and for B."""
    out = []
    for name in "ab":
        n = batch.column(f"n_{name}").to_numpy()[first:end]
        data = [batch.column(name)[k].as_py() for k in range(first, end)]
        size = next((len(d) // int(c) for d, c in zip(data, n, strict=True) if c), 2)
        ids = np.frombuffer(b"".join(data), f"<u{size}").astype(np.int64)
        cut = [np.unpackbits(np.frombuffer(batch.column(f"{name}_cut")[first + k].as_py(), np.uint8), count=int(c))
               for k, c in enumerate(n)]
        cut = np.concatenate(cut) if cut else np.empty(0, np.uint8)
        out += [ids, _group_numbers(cut.astype(np.int64)), np.repeat(np.arange(end - first), n)]
    return tuple(out)


def _distinct(keys: list[np.ndarray], weights: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Different combinations of non-negative numbers and how often each, or the sum of its weights."""
    one = keys[0]
    for key in keys[1:]:
        one = one * (1 << 32) + key
    order = np.argsort(one, kind="stable")
    ordered = one[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(one) else np.empty(0, np.int64)
    sums = (np.diff(np.append(starts, len(one))) if weights is None
            else np.add.reduceat(weights[order], starts) if len(one) else np.empty(0, np.int64))
    return [key[order][starts] for key in keys], sums


def _in_groups(group: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and number of each group's entries; groups are in order."""
    n = np.bincount(group, minlength=n_groups)
    return np.cumsum(n) - n, n


def doc_pairs(a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, doc_of_group: np.ndarray,
              most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents, pairs (the A id times 2**32 and the B id) and numbers of links, each pair of a document once.

    With more than ``most`` links, tokens are first counted within their group, and pairs come in classes of
    their A id, so that each class is small and a pair is in one class alone.
    """
    most = most or LINKS
    n_groups = len(doc_of_group)
    a_n, b_n = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
    total = int((np.bincount(a_group, minlength=n_groups) * np.bincount(b_group, minlength=n_groups)).sum())
    classes = 1
    if total > most:
        (a_group, a), a_n = _distinct([a_group, a])
        (b_group, b), b_n = _distinct([b_group, b])
        total = int((np.bincount(a_group, minlength=n_groups) * np.bincount(b_group, minlength=n_groups)).sum())
        classes = max(1, -(-total // most))
    b_first, b_in = _in_groups(b_group, n_groups)
    for c in range(classes):
        some = slice(None) if classes == 1 else a % classes == c
        group, ids, times = a_group[some], a[some], a_n[some]
        each = b_in[group]
        which = np.repeat(np.arange(len(ids)), each)
        other = np.arange(len(which)) - np.repeat(np.cumsum(each) - each, each) + b_first[group][which]
        doc, pair = doc_of_group[group][which], ids[which] * (1 << 32) + b[other]
        links = times[which] * b_n[other]
        order = np.lexsort((pair, doc)) if doc_of_group.size and doc_of_group[-1] > 0 else np.argsort(pair, kind="stable")
        doc, pair, links = doc[order], pair[order], links[order]
        if len(doc):
            new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])]))
            yield doc[new], pair[new], np.add.reduceat(links, new)


def _pairs_of(batch: pa.RecordBatch, first: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    a, a_group, a_doc, b, b_group, _ = _read_tokens(batch, first, end)
    if len(a):
        doc_of_group = np.empty(int(a_group[-1]) + 1, np.int64)
        doc_of_group[a_group] = a_doc
        yield from doc_pairs(a, a_group, b, b_group, doc_of_group)


def _add_up(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, n = (np.concatenate(x) for x in zip(*held, strict=True))
    (pairs,), n = _distinct([pairs], n)
    return pairs, n


def _count_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of its documents a task has each pair, given out whenever it holds too many."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, kept = 0, 0
    for batch in batches:
        for first, end in _blocks(batch):
            for _, pairs, _ in _pairs_of(batch, first, end):
                held.append((pairs, np.ones(len(pairs), np.int64)))
                size += len(pairs)
                if size > kept + LINKS:
                    held = [_add_up(held)]
                    size = kept = len(held[0][0])
                    if kept > LINKS:
                        yield _batch("pair long, n long", dict(zip(("pair", "n"), held[0], strict=True)))
                        held, size, kept = [], 0, 0
    if held:
        yield _batch("pair long, n long", dict(zip(("pair", "n"), _add_up(held), strict=True)))


def _sum_counts(sent):
    """Each row's sums over the pairs whose counts were sent, and its other pairs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = sent.value
        for batch in batches:
            for first, end in _blocks(batch):
                n_best, count_sum = np.zeros(end - first, np.int64), np.zeros(end - first, np.int64)
                rows = batch.column("row").to_numpy()[first:end]
                for doc, pair, links in _pairs_of(batch, first, end):
                    at = np.searchsorted(known, pair).clip(max=max(len(known) - 1, 0))
                    met = known[at] == pair if len(known) else np.zeros(len(pair), bool)
                    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                    if len(known):
                        n_best[doc[starts]] += np.add.reduceat(np.where(met & best[at], links, 0), starts)
                        count_sum[doc[starts]] += np.add.reduceat(np.where(met, links * counts[at], 0), starts)
                    if not met.all():
                        yield _batch(SUMS, {"row": rows[doc[~met]], "pair": pair[~met], "links": links[~met]})
                own = {name: batch.column(name).slice(first, end - first)
                       for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
                yield _batch(SUMS, {"row": rows, "n_best": n_best, "count_sum": count_sum, **own})

    return run


def tokenized(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids of both kinds as little-endian numbers, bits that mark tokens which end a group, figures and digest of every row."""
    return pick(docs, doc_id=id_column, text=text_column).mapInArrow(_tokenize(a_path, b_path), TOKENS)


def pair_counts(tokens: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked) and whether n is the highest of the pair's A id."""
    n = tokens.mapInArrow(_count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    n = stored(n, "pairs")
    # One row for each id of the vocabulary at most.
    highest = n.groupBy(F.expr("shiftright(pair, 32) as a")).agg(F.max("n").alias("highest"))
    found = n.withColumn("a", F.expr("shiftright(pair, 32)")).join(F.broadcast(highest), "a")
    return found.select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _line(counts: DataFrame, most: int) -> int:
    """The least count such that ``most`` pairs at most have as much: tried at powers of two."""
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count("*").alias("pairs")).collect()
    total, line = 0, None
    for power, pairs in sorted(((r["power"], r["pairs"]) for r in sizes), reverse=True):
        total += pairs
        if total > most:
            break
        line = 1 << power
    return line or (1 << 62)


def align(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text",
          sent: int | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``."""
    spark = docs.sparkSession
    tokens = tokenized(docs, a_path, b_path, id_column, text_column)
    tokens = stored(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens", compression="zstd")
    counts = stored(pair_counts(tokens), "counts")
    line = _line(counts, SENT if sent is None else sent)
    frequent = counts.where(F.col("n") >= line).toPandas().sort_values("pair")
    table = (frequent["pair"].to_numpy(np.int64), frequent["n"].to_numpy(np.int64), frequent["best"].to_numpy(bool))
    sums = stored(tokens.mapInArrow(_sum_counts(spark.sparkContext.broadcast(table)), SUMS), "sums", compression="zstd")
    rest = sums.where(F.col("pair").isNotNull()).select("row", "pair", "links").join(
        counts.where(F.col("n") < line), "pair")
    rest = rest.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
                                   F.sum(F.col("links") * F.col("n")).alias("more_sum"))
    none = F.lit(0).cast("long")
    return sums.where(F.col("pair").isNull()).join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", none)).alias("count_sum"), "groups_sha256")
