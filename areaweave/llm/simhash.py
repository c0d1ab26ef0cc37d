"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has a bit for each bit that more than half of the shingle hashes set.  Two
fingerprints that differ in at most ``radius`` bits are linked.  Tables are bit masks built from
vectors of ``radius + 1`` bits given to the positions: a mask keeps the positions whose vector has
an odd product with the mask's own vector.  The vectors of ``radius`` positions cannot span the
space, so for any two fingerprints within the radius some mask keeps none of the bits in which
they differ: they share that mask's bucket.  Nothing is left to chance.

Equal fingerprints are one node.  Buckets with more than ``BUCKET`` nodes are split by the same
construction over their free bits, again and again, so none is compared whole in one task.  A
bucket yields the edges of a spanning forest of its links, never all pairs.

Null and empty texts have the fingerprint zero, linked like any other.  Rows that repeat an id are
rows of the result; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaweave.llm.common import drop_stored, pick, stored
from areaweave.llm.components import components

SEED = 42
BUCKET = 8192
BITS = 64


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of the shingles of a text, repeats included: words between ASCII white space, A to Z in lower case."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(itertools.accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends[:-shingle]]
    return np.array([xxh64_intdigest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[shingle - 1:], strict=True)],
                    np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed number."""
    count = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at:at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, digest of the text and fingerprint (a signed 64-bit number) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(t.as_py(), shingle)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(found, pa.int64())],
                                             ["doc_id", "digest", "fingerprint"])

    rows = pick(docs, doc_id=id_column, text=text_column).withColumn("digest", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, digest long, fingerprint long")


def covering_masks(free: list[int], radius: int) -> list[int]:
    """Masks over the positions ``free``: those within ``radius`` in them agree under one of the masks."""
    space = (1 << (radius + 1)) - 1
    vectors = [1 + i % space for i in range(len(free))]
    return [sum(1 << p for p, m in zip(free, vectors, strict=True) if (m & v).bit_count() % 2)
            for v in range(1, space + 1)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _tables(radius: int):
    """Each row of (kept, bucket, node), in every table over the bits that its bucket leaves free."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            kept = batch.column("kept").to_numpy(zero_copy_only=False)
            bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
            node = batch.column("node").to_numpy(zero_copy_only=False)
            for have in np.unique(kept).tolist():
                if have not in known:
                    free = [i for i in range(BITS) if not (have >> i) & 1]
                    known[have] = np.array([_signed((have | m) & ((1 << BITS) - 1))
                                            for m in covering_masks(free, radius)], np.int64)
                own = kept == have
                for mask in known[have]:
                    # The bucket's number mixes the mask, the bits kept so far and those kept now.
                    key = (node[own] & mask).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + mask.view(np.uint64)
                    key = (key ^ bucket[own].view(np.uint64) ^ (key >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(own.sum(), mask)), pa.array(key.view(np.int64)), pa.array(node[own])],
                        ["kept", "bucket", "node"])

    return run


def _forest(nodes: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of the links among ``nodes``: every node is expanded once."""
    a, b, left = [], [], nodes
    while len(left):
        stack, left = [left[0]], left[1:]
        while stack and len(left):
            top = stack.pop()
            near = np.bitwise_count(left ^ top) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                stack.extend(found)
                a.extend([int(top)] * len(found))
                b.extend(found.tolist())
    return a, b


def _links(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("bucket").to_numpy(), b.column("node").to_numpy()) for b in batches if b.num_rows]
        if not parts:
            return
        bucket, node = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        del parts
        order = np.argsort(bucket, kind="stable")
        bucket, node = bucket[order], node[order]
        edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        length = np.diff(np.r_[edge, len(bucket)])
        out_a, out_b = [], []
        small = np.repeat((length >= 2) & (length <= 16), length)
        at = np.flatnonzero(small)
        for lag in range(1, 16):
            at = at[at + lag < len(bucket)]
            at = at[bucket[at] == bucket[at + lag]]
            if not len(at):
                break
            near = at[np.bitwise_count(node[at] ^ node[at + lag]) <= radius]
            out_a.append(node[near])
            out_b.append(node[near + lag])
        for first, n in zip(edge[length > 16], length[length > 16], strict=True):
            a, b = _forest(np.unique(node[first:first + n]), radius)
            out_a.append(np.array(a, np.int64))
            out_b.append(np.array(b, np.int64))
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (out_a, out_b)],
                                             ["a", "b"])

    return run


def links(nodes: DataFrame, radius: int, used: list[DataFrame] | None = None) -> DataFrame:
    """Edges (a, b) that connect whatever fingerprints in the column ``node`` reach each other.

    Tables that the edges are read from are added to ``used``, to be dropped once the edges are stored.
    """
    spark = nodes.sparkSession
    used = [] if used is None else used
    rows = nodes.select(F.lit(0).cast("bigint").alias("kept"), F.lit(0).cast("bigint").alias("bucket"), "node")
    edges = None
    while True:
        rows = stored(rows.mapInArrow(_tables(radius), "kept long, bucket long, node long"), "tables")
        full = rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET)
        full = stored(full, "full")
        used += [rows, full]
        small = rows.join(full, "bucket", "left_anti") if full.head(1) else rows
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // 2_000_000)
        found = small.repartition(parts, "bucket").mapInArrow(_links(radius), "a long, b long")
        edges = found if edges is None else edges.union(found)
        if small is rows:
            return edges
        # At most ``radius`` free bits: whatever shares the bucket is linked.
        rows = rows.join(full, "bucket", "left_semi")
        tight = F.bit_count("kept") >= BITS - radius
        star = rows.where(tight).groupBy("bucket").agg(F.min("node").alias("b"))
        edges = edges.union(rows.where(tight).join(star, "bucket").select(F.col("node").alias("a"), "b"))
        rows = rows.where(~tight)


def _rooted(own: DataFrame, radius: int) -> DataFrame:
    """fingerprint and root (the least fingerprint that it reaches by links) of all fingerprints in ``own``."""
    nodes, used = own.select(F.col("fingerprint").alias("node")).distinct(), []
    edges = stored(links(nodes, radius, used), "links")
    for frame in used:
        drop_stored(frame)
    roots = components(edges)
    drop_stored(edges)
    return nodes.join(roots, "node", "left").select(F.col("node").alias("fingerprint"), F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """doc_id, fingerprint and component_id (the least id reachable by links) of every row.

    A fingerprint that only rows without an id have belongs to a component without an id, unless
    it reaches another.
    """
    own = stored(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    nodes = own.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    rooted = nodes.join(_rooted(own, radius), "fingerprint")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    member = rooted.join(least, "root").select("fingerprint", "component_id")
    return own.join(member, "fingerprint").select("doc_id", "fingerprint", "component_id")


def first_of_each(docs: DataFrame, radius: int = 4, shingle: int = 4, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """The row with the least id of each component of ``near_duplicates``, with all its columns.

    Rows without an id come after all others; of different texts under the least id the one with the least digest stays,
    and of rows that repeat both, one.
    """
    own = stored(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    rows = own.groupBy("fingerprint", "doc_id", "digest").agg(F.count("*").alias("n"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "n")
    first = rows.groupBy("fingerprint").agg(F.min(place).alias("first"))
    kept = first.join(_rooted(own, radius), "fingerprint").groupBy("root").agg(F.min("first").alias("k")).select(
        F.col("k.doc_id").alias("_id"), F.col("k.digest").alias("_digest"), F.col("k.n").alias("_n"))
    # One id and text may be the first of one component only, since equal texts have equal fingerprints.
    kept = stored(kept, "kept")
    drop_stored(own)
    same = docs[f"`{id_column}`"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs[f"`{text_column}`"]) == F.col("_digest"))
    out = docs.join(kept, same)
    single = out.where("_n = 1").select(*docs.columns)
    return single.union(out.where("_n > 1").dropDuplicates(["_id", "_digest"]).select(*docs.columns))


#: Least values under random orders of the shingles: so many bands of so many.
BANDS, ROWS = 16, 5


def _signatures(shingle: int):
    """Fingerprint and band keys of every text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(11)
        a = rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        b = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
        mix = rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            prints, bands = [], []
            for text in batch.column("text"):
                hashes = shingle_hashes(text.as_py(), shingle)
                prints.append(fingerprint(hashes))
                if not len(hashes):
                    bands.append([])
                    continue
                least = np.full(BANDS * ROWS, np.uint64(0xFFFFFFFFFFFFFFFF))
                for at in range(0, len(hashes), 4096):
                    some = (hashes[at:at + 4096, None] * a + b)
                    np.minimum(least, (some ^ (some >> np.uint64(32))).min(axis=0), out=least)
                keys = ((least ^ (least >> np.uint64(29))).reshape(BANDS, ROWS) * mix).sum(axis=1, dtype=np.uint64)
                bands.append(keys.view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(prints, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                ["node", "fingerprint", "bands"])

    return run


def _neighbours(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbours in rows sorted by bucket."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        band, key, node = (batch.column(c).to_numpy() for c in ("band", "key", "node"))
        if last is not None:
            band, key, node = (np.r_[x, y] for x, y in zip(last, (band, key, node), strict=True))
        same = np.flatnonzero((band[1:] == band[:-1]) & (key[1:] == key[:-1]))
        last = band[-1:], key[-1:], node[-1:]
        yield pa.RecordBatch.from_arrays([pa.array(node[same + 1]), pa.array(node[same])], ["a", "b"])


def _similar(shingle: int, least: float):
    """Pairs whose sets of shingles share at least so much of their union."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("ta"), batch.column("tb"),
                       strict=True)
            keep = []
            for a, b, ta, tb in rows:
                if len(known) > 256:
                    known.clear()
                for node, text in ((a, ta), (b, tb)):
                    if node not in known:
                        known[node] = np.unique(shingle_hashes(text.as_py(), shingle))
                x, y = known[a], known[b]
                both = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - both
                keep.append(both >= least * union)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(keep, pa.bool_())), batch.column("b").filter(pa.array(keep, pa.bool_()))],
                ["a", "b"])

    return run


#: Slots of the counts that order shingles, bits of a text's parity signature, and rows of the two sides that meet in one go.
SLOTS, PARITY, FEW, MANY = 1 << 16, 2048, 512, 4096


def _slot_counts(shingle: int):
    """How many different shingles of texts fall into each slot."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                slots = (np.unique(shingle_hashes(text.as_py(), shingle)) % np.uint64(SLOTS)).astype(np.int64)
                np.add.at(count, slots, 1)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], ["slot", "n"])

    return run


def _prefixes(shingle: int, least: float, order: np.ndarray):
    """Of every text the shingles of which a similar text shares one, its number of shingles and their parity signature.

    Shingles are in one order for all texts, those of rare slots first.  A text that shares ``least`` of
    its shingles with another cannot miss it with all of its first ones, one more than it may lack.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, parities = [], [], []
            for text in batch.column("text"):
                hashes = np.unique(shingle_hashes(text.as_py(), shingle))
                n = len(hashes)
                first = hashes[np.lexsort((hashes, order[(hashes % np.uint64(SLOTS)).astype(np.int64)]))]
                first = first[:n - math.ceil(least * n - 1e-6) + 1] if n else np.zeros(1, np.uint64)
                keys.append(first.view(np.int64))
                sizes.append(n)
                odd = np.bincount(((hashes >> np.uint64(16)) % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) % 2
                parities.append(np.packbits(odd.astype(np.uint8)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("label"), pa.array(sizes, pa.int64()), pa.array(parities, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["node", "label", "size", "parity", "keys"])

    return run


def _possible(least: float):
    """Pairs of one group that may be similar: few with many, of different labels; rows come sorted by group.

    Texts differ in as many shingles at least as their parity signatures differ in bits, so no similar pair is lost.
    """
    share = (1 - least) / (1 + least)

    def meet(few: np.ndarray, node: np.ndarray, label: np.ndarray, size: np.ndarray, parity: np.ndarray):
        many = np.flatnonzero(~few)
        out_a, out_b = [], []
        for i in np.flatnonzero(few):
            other = many[label[many] != label[i]]
            low, high = np.minimum(size[other], size[i]), np.maximum(size[other], size[i])
            other = other[low >= least * high - 1e-6]
            apart = np.bitwise_count(parity[other] ^ parity[i]).sum(axis=1, dtype=np.int64)
            other = other[apart <= share * (size[other] + size[i]) + 1e-6]
            out_a.append(np.maximum(node[other], node[i]))
            out_b.append(np.minimum(node[other], node[i]))
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (out_a, out_b))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            group = np.stack([batch.column(c).to_numpy() for c in ("key", "c", "h")], axis=1)
            parts = [group, batch.column("few").to_numpy(zero_copy_only=False),
                     *(batch.column(c).to_numpy() for c in ("node", "label", "size")),
                     np.frombuffer(b"".join(batch.column("parity").to_pylist()), np.uint64).reshape(-1, PARITY // 64)]
            if rest is not None:
                parts = [np.concatenate(x) for x in zip(rest, parts, strict=True)]
            edge = np.r_[0, np.flatnonzero((parts[0][1:] != parts[0][:-1]).any(axis=1)) + 1]
            for first, end in itertools.pairwise(edge):
                yield meet(*(x[first:end] for x in parts[1:]))
            rest = [x[edge[-1]:] for x in parts]
        if rest is not None:
            yield meet(*rest[1:])

    return run


def _missed(texts: DataFrame, groups: DataFrame, shingle: int, least: float) -> DataFrame:
    """Pairs (a, b) of different groups, every pair that shares ``least`` of its shingles among them.

    Of each shared first shingle the group with most texts stands aside: the others, in parts of ``FEW``,
    meet all texts, in parts of ``MANY``.
    """
    spark = texts.sparkSession
    count = texts.mapInArrow(_slot_counts(shingle), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    order = np.zeros(SLOTS, np.int64)
    order[count["slot"].to_numpy()] = count["n"].to_numpy()
    labelled = texts.join(groups.withColumnRenamed("root", "label"), "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"), "text")
    signed = stored(labelled.mapInArrow(_prefixes(shingle, least, order),
                                        "node long, label long, size long, parity binary, keys array<bigint>"), "prefixes")
    members = signed.select("node", "label", F.explode("keys").alias("key"))
    open_ = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
    members = stored(members.join(open_.select("key"), "key"), "members")
    sizes = members.groupBy("key", "label").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("key").agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("n"))
    sizes = sizes.select("key", F.col("most.label").alias("aside"), F.ceil(F.col("n") / MANY).cast("int").alias("hs"),
                         F.ceil((F.col("n") - F.col("most.n")) / FEW).cast("int").alias("cs"))
    rows = members.join(sizes, "key")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    few = rows.where("label != aside").select(
        "key", "node", F.lit(True).alias("few"), F.pmod(F.hash("node"), "cs").alias("c"), upto("hs").alias("h"))
    many = rows.select("key", "node", F.lit(False).alias("few"), upto("cs").alias("c"), F.pmod(F.xxhash64("node"), "hs").cast("int").alias("h"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = few.union(many).join(signed.drop("keys"), "node").repartition(parts, "key", "c", "h").sortWithinPartitions("key", "c", "h")
    out = stored(met.mapInArrow(_possible(least), "a long, b long").distinct(), "missed")
    for frame in (signed, members):
        drop_stored(frame)
    return out


def one_of_each(docs: DataFrame, shingle: int = 5, similar: float = 0.8, radius: int = 4, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """The row with the least id of each group of near-duplicates, with all its columns.

    Two documents are near-duplicates where their sets of shingles share ``similar`` of their
    union; groups are what such pairs connect, and equal texts are one.  Pairs come from the
    fingerprints within ``radius``.  At a similarity of 0.8 fingerprints differ in about ten bits,
    which would take 2,047 tables, so pairs also come from bands of least values under random
    orders: each document meets the first of every bucket it is in and its neighbour there.  These
    link most copies cheaply.  Then texts that still are in different groups meet wherever they share
    one of their first shingles in a common order, which similar texts always do: no pair is left to
    chance.  All pairs are checked by their whole texts.  Texts without words are one group.
    """
    spark = docs.sparkSession
    key = F.xxhash64(F.coalesce(docs[f"`{text_column}`"], F.lit("")))
    rows = docs.withColumn("_node", key)
    firsts = stored(rows.groupBy("_node").agg(F.min(docs[f"`{id_column}`"]).alias("first"), F.count("*").alias("n"))
                    .withColumnRenamed("_node", "node"), "firsts")
    texts = stored(rows.select(F.col("_node").alias("node"), F.coalesce(docs[f"`{text_column}`"], F.lit("")).alias("text"),
                               docs[f"`{id_column}`"].alias("id"))
                   .join(firsts, "node").where(F.col("id").eqNullSafe(F.col("first"))).select("node", "text"), "texts")
    signed = stored(texts.mapInArrow(_signatures(shingle), "node long, fingerprint long, bands array<bigint>")
                    .dropDuplicates(["node"]), "signatures")
    prints = signed.groupBy("fingerprint").agg(F.min("node").alias("node"))
    used: list[DataFrame] = []
    near = links(prints.select(F.col("fingerprint").alias("node")), radius, used)
    by_print = prints.select("fingerprint", "node")
    pairs = near.join(by_print.toDF("a", "x"), "a").join(by_print.toDF("b", "y"), "b").select(
        F.col("x").alias("a"), F.col("y").alias("b"))
    pairs = pairs.union(signed.join(prints.withColumnRenamed("node", "b"), "fingerprint").select(F.col("node").alias("a"), "b"))
    banded = signed.select("node", F.posexplode("bands").alias("band", "key"))
    heads = banded.groupBy("band", "key").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = pairs.union(banded.join(heads, ["band", "key"]).select(F.col("node").alias("a"), "b"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.union(banded.repartitionByRange(parts, "band", "key", "node").sortWithinPartitions("band", "key", "node")
                        .select(F.col("band").cast("int").alias("band"), "key", "node").mapInArrow(_neighbours, "a long, b long"))
    pairs = stored(pairs.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "pairs")
    for frame in (*used, signed):
        drop_stored(frame)

    def checked(pairs: DataFrame) -> DataFrame:
        once = texts.join(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "node",
                          "left_semi")
        told = pairs.join(once.toDF("a", "ta"), "a").join(once.toDF("b", "tb"), "b")
        return told.mapInArrow(_similar(shingle, similar), "a long, b long")

    groups = components(checked(pairs))
    drop_stored(pairs)
    missed = _missed(texts, groups, shingle, similar)
    if missed.head(1):
        groups = components(checked(missed).union(groups))
    member = firsts.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # The least id of a group, and of the texts that have it the least digest.
    kept = member.groupBy("root").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "node", "n")).alias("k")).select(
        F.col("k.node").alias("_kept"), F.col("k.first").alias("_first"), F.col("k.n").alias("_n"))
    kept = stored(kept, "kept")
    out = rows.join(kept, (F.col("_node") == F.col("_kept")) & docs[f"`{id_column}`"].eqNullSafe(F.col("_first")))
    single = out.where("_n = 1").select(*docs.columns)
    # Of rows that repeat id and text one stays.
    many = out.where("_n > 1").dropDuplicates(["_node"]).select(*docs.columns)
    for frame in (firsts, texts, missed):
        drop_stored(frame)
    return single.union(many)
