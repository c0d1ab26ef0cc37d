"""Scores of whole documents under a gated recurrent language model trained on the corpus itself.

Counts.  Each task turns its documents into chunks: numbers of words and the chunk's own vocabulary.
The vocabularies, not the words, are shuffled, by a hash of the word, and every chunk gets back the
corpus counts of its words.  Nothing is broadcast that grows with the data but the table of classes, which is
bounded by the root of the corpus, and a frequent word is one entry per chunk.

Model.  The output softmax is factored.  Words belong to classes of about equal mass in the corpus, about as
many as the root of the number of different words, so the model grows with the vocabulary: a frequent word is
a class alone and has an embedding and a probability of its own; rarer words share one, by count and, where many
have one count, by hash.  Classes in turn lie in groups; the network gives probabilities
of a group and of a class in its group, the counts that of a word in its class.  Words never seen share the classes of the
rarest words, each of which has one place for them, so probabilities add up to one.

Each chunk trains a gated recurrent network by backpropagation through windows of ``STEPS``
tokens, all training documents once, from the same start, the classes' unigram; the chunks' weights
are averaged by their tokens, slice by slice.  Scoring carries the state from window to window, so a score is that
of the complete document.

Null and empty texts have one token, the end.  Rows that repeat an id are documents of their own.
Without training documents every class is equally likely.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaweave.llm.common import drop_stored, new_folder, partitions_for, pick, stored, wide

HIDDEN, STEPS = 16, 16
#: Documents side by side, in training and in scoring.
TRAINED, SCORED = 1024, 4096
#: Characters of text in a chunk, about; a longer document is a chunk alone.
CHUNK_CHARS = 16_000_000
#: Weights in a slice of the average.
SLICE = 4096
ENTRY = np.dtype([("hash", "<u8"), ("check", "<u4"), ("count", "<u4")])
#: What comes back of a word: its count in the corpus, and a number from its hash that parts words of one count.
COUNTED = np.dtype([("count", "<i8"), ("part", "<u2")])
CHUNK = ("chunk string, doc_ids array<bigint>, held array<boolean>, lengths array<int>, words binary, places binary, "
         "bucket int, entries binary")

CLASSIFIED = ("chunk string, doc_ids array<bigint>, held array<boolean>, lengths array<int>, classes binary, "
              "n_known array<bigint>, base_score array<double>, within array<double>")


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def held_out(doc_id: Column, parts: int = 7, part: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def _chunked(buckets: int):
    """Chunks of documents as word numbers, and their vocabularies by hash bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from xxhash import xxh3_128_digest

        task, nth = TaskContext.get().partitionId(), 0
        kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(),
                 pa.int32(), pa.binary()]
        names = ["chunk", "doc_ids", "held", "lengths", "words", "places", "bucket", "entries"]

        def row(*values) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds, strict=True)], names)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal nth
            chunk, nth = f"{task}-{nth}", nth + 1
            words = np.concatenate(parts) if parts else np.empty(0, np.int32)
            train = np.repeat(~np.array(held, bool), lengths)
            counts = np.bincount(words[train], minlength=len(numbers))
            digests = np.frombuffer(b"".join(map(xxh3_128_digest, numbers)), "<u8").reshape(-1, 2)
            entries = np.empty(len(numbers), ENTRY)
            entries["hash"], entries["check"], entries["count"] = digests[:, 0], digests[:, 1] & 0xFFFFFFFF, counts
            of = (entries["hash"] % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(of, kind="stable").astype(np.int32)
            cuts = np.searchsorted(of[order], np.arange(buckets + 1))
            yield row(chunk, docs, held, lengths, words.tobytes(), order.tobytes(), None, None)
            for b in np.flatnonzero(np.diff(cuts)).tolist():  # empty ones are not sent
                yield row(chunk, *[None] * 5, b, entries[order[cuts[b]:cuts[b + 1]]].tobytes())

        numbers, docs, held, lengths, parts, chars = _Numbers(), [], [], [], [], 0
        for doc, out, text in rows():
            text = text.as_py() or ""
            words = text.encode().lower().split()
            docs.append(doc)
            held.append(out)
            lengths.append(len(words))
            parts.append(np.array([numbers[w] for w in words], np.int32))
            chars += len(text)
            if chars >= CHUNK_CHARS:
                yield from flush()
                numbers, docs, held, lengths, parts, chars = _Numbers(), [], [], [], [], 0
        if docs:
            yield from flush()

    return run


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What comes back of every chunk's entries, and, without a chunk, the same of the bucket's different words."""
    rows = [(c, b, np.frombuffer(e.as_buffer(), ENTRY)) for batch in batches for c, b, e in zip(
        batch.column("chunk").to_pylist(), batch.column("bucket").to_pylist(), batch.column("entries"), strict=True)]
    if not rows:
        return
    every = np.concatenate([r[2] for r in rows])
    order = np.lexsort((every["check"], every["hash"]))
    hashes, checks = every["hash"][order], every["check"][order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1])][:len(every)]
    kind = np.cumsum(new) - 1
    words = np.empty(int(new.sum()), COUNTED)
    words["count"] = np.bincount(kind, weights=every["count"][order], minlength=len(words))
    words["part"] = hashes[new] >> np.uint64(48)
    back = np.empty(len(every), COUNTED)
    back[order] = words[kind]
    at, chunks, buckets, found = 0, [], [], []
    for chunk, bucket, own in rows:
        chunks.append(chunk)
        buckets.append(bucket)
        found.append(back[at:at + len(own)].tobytes())
        at += len(own)
    yield pa.RecordBatch.from_arrays(
        [pa.array([*chunks, None]), pa.array([*buckets, None], pa.int32()), pa.array([*found, words.tobytes()], pa.binary())],
        ["chunk", "bucket", "counts"])


def _kinds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many words of a task's buckets have each count; those that training never met have none."""
    for batch in batches:
        for data in batch.column("counts"):
            count, types = np.unique(np.frombuffer(data.as_buffer(), COUNTED)["count"], return_counts=True)
            seen = count > 0
            yield pa.RecordBatch.from_arrays([pa.array(count[seen]), pa.array(types[seen].astype(np.int64))], ["count", "types"])


def _class_sums(vocabulary: Vocabulary):
    """Words and tokens of each class in a task's buckets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("counts"):
                words = np.frombuffer(data.as_buffer(), COUNTED)
                words = words[words["count"] > 0]
                own = vocabulary.classes(words["count"], words["part"])
                types = np.bincount(own, minlength=vocabulary.size)
                mass = np.bincount(own, weights=words["count"], minlength=vocabulary.size)
                some = np.flatnonzero(types)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(types[some].astype(np.int64)),
                                                  pa.array(mass[some].astype(np.int64))], ["class", "types", "mass"])

    return run


class Vocabulary:
    """Which class a word belongs to by its count, and its probability in the class.

    ``counts`` are the different counts, rising, ``types`` how many words have each.  From the greatest count down, words
    fill classes of an equal share of all tokens; a count that needs several classes parts its words by hash, and the
    least count has classes of its own, which words never seen share.  The last class is the end of a document.
    """

    def __init__(self, counts: np.ndarray, types: np.ndarray, documents: int):
        self.counts, self.documents = np.asarray(counts, np.int64), documents
        self.tokens, self.distinct = int((counts * types).sum()) + documents, int(types.sum()) + (documents > 0)
        share = max(1.0, (self.tokens - documents) / max(1, round(self.distinct ** 0.5)))
        self.first, self.parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
        at, filled = 0, 0.0
        for i in range(len(counts) - 1, -1, -1):
            mass = float(counts[i] * types[i])
            if filled and (filled + mass > share or i == 0):
                at, filled = at + 1, 0.0
            self.first[i] = at
            if mass >= share or i == 0:
                self.parts[i] = min(types[i], 1 << 16, max(1, round(mass / share)))
                at, filled = at + int(self.parts[i]), 0.0
            else:
                filled += mass
        if not len(counts):  # nothing was seen: one class for all words
            self.counts, self.first, self.parts, at = np.ones(1, np.int64), np.zeros(1, np.int64), np.ones(1, np.int64), 1
        self.size = at + 1
        self.end = at
        self.types = self.mass = np.zeros(self.size, np.int64)

    def classes(self, count: np.ndarray, part: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.counts, np.maximum(count, self.counts[0]))
        return self.first[place] + part.astype(np.int64) % self.parts[place]

    def within(self, count: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Natural logarithm of a word's probability in its class."""
        rare = own >= self.first[0]
        return np.where(rare, -np.log(self.types[own] + 1.0), np.log(np.maximum(count, 1)) - np.log(np.maximum(self.mass[own], 1)))

    def unigram(self) -> np.ndarray:
        """Logarithms of the classes' shares, none of them 0."""
        n = self.mass.astype(float) + (np.arange(self.size) >= self.first[0])
        n[self.end] = self.documents + 1
        return np.log((n + 1e-3) / (n + 1e-3).sum())


def vocabulary(merged: DataFrame, documents: int) -> Vocabulary:
    """From counts of counts.  The driver sees the different counts, fewer than the root of twice the tokens, and the classes."""
    words = merged.where(F.col("chunk").isNull()).select("counts")
    kinds = words.mapInArrow(_kinds, "count long, types long").groupBy("count").agg(F.sum("types").alias("types"))
    kinds = kinds.orderBy("count").toArrow()
    found = Vocabulary(kinds["count"].to_numpy(), kinds["types"].to_numpy(), documents)
    sums = words.mapInArrow(_class_sums(found), "class long, types long, mass long").groupBy("class").agg(
        F.sum("types").alias("types"), F.sum("mass").alias("mass")).toArrow()
    found.types, found.mass = np.zeros(found.size, np.int64), np.zeros(found.size, np.int64)
    found.types[sums["class"].to_numpy()] = sums["types"].to_numpy()
    found.mass[sums["class"].to_numpy()] = sums["mass"].to_numpy()
    return found


def _classified(vocabulary: Vocabulary):
    """Chunks as classes of tokens, with what needs no network: known tokens, base score, score within classes."""
    names = ["chunk", "doc_ids", "held", "lengths", "classes", "n_known", "base_score", "within"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smallest = vocabulary.tokens + vocabulary.distinct + 1
        end_score = np.log10((vocabulary.documents + 1) / smallest)
        for batch in batches:
            for row in range(batch.num_rows):
                words = np.frombuffer(batch.column("words")[row].as_buffer(), np.int32)
                lengths = batch.column("lengths")[row].values.to_numpy()
                # Entries were sent by bucket; places are the words' numbers in that order.
                found = batch.column("found")[row]
                got = {x["bucket"].as_py(): np.frombuffer(x["counts"].as_buffer(), COUNTED) for x in found} if found.is_valid else {}
                places = np.frombuffer(batch.column("places")[row].as_buffer(), np.int32)
                entry = np.zeros(len(places), COUNTED)
                if got:
                    entry[places] = np.concatenate([got[b] for b in sorted(got)])
                count = entry["count"]
                own = vocabulary.classes(count, entry["part"])
                within = vocabulary.within(count, own)
                ends = np.cumsum(lengths)
                # A document's words, then its end.
                classes = np.insert(own.astype(np.int32)[words], ends, vocabulary.end) if len(lengths) else np.empty(0, np.int32)

                def by_doc(values: np.ndarray) -> np.ndarray:
                    sums = np.r_[0, np.cumsum(values[words])]
                    return sums[ends] - sums[ends - lengths]

                known = by_doc((count > 0).astype(np.int64)) + (vocabulary.documents > 0)
                base = by_doc(np.log10((count + 1) / smallest)) + end_score
                inner = by_doc(within)
                columns = [batch.column("chunk").slice(row, 1), batch.column("doc_ids").slice(row, 1),
                           batch.column("held").slice(row, 1), batch.column("lengths").slice(row, 1),
                           pa.array([classes.astype("<i4").tobytes()], pa.binary()), pa.array([known], pa.list_(pa.int64())),
                           pa.array([base], pa.list_(pa.float64())), pa.array([inner], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _short(numbers: np.ndarray, size: int) -> np.ndarray:
    """Numbers below ``size`` in two bytes where they fit, which are sorted faster."""
    return numbers.astype(np.uint16) if size <= 1 << 16 else numbers


class Network:
    """A gated recurrent network over classes: the class before is the input, the class of the token the output.

    Classes lie in groups of ``k``, which is about the root of their number: ``g`` and ``a`` give the group's probability,
    ``v`` and ``b`` that of a class in its group.
    """

    NAMES = "xugavb"

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @staticmethod
    def shapes(classes: int, hidden: int = HIDDEN) -> dict[str, tuple[int, ...]]:
        k = max(1, int(np.ceil(classes ** 0.5)))
        groups = -(-classes // k)
        return {"x": (classes, 3 * hidden), "u": (hidden, 3 * hidden), "g": (hidden, groups), "a": (groups,),
                "v": (groups, k, hidden), "b": (groups, k)}

    @staticmethod
    def start(unigram: np.ndarray, hidden: int = HIDDEN, seed: int = 7) -> Network:
        """Random weights; the biases give the classes' unigram."""
        rng, shapes = np.random.default_rng(seed), Network.shapes(len(unigram), hidden)
        groups, k = shapes["b"]
        own = np.full(groups * k, -1e9)  # places that no class has
        own[:len(unigram)] = unigram
        own = own.reshape(groups, k)
        whole = np.logaddexp.reduce(own, axis=1)
        draw = lambda name, scale: (rng.standard_normal(shapes[name]) * scale).astype(np.float32)
        return Network({"x": draw("x", 0.5), "u": draw("u", hidden ** -0.5), "g": draw("g", 0.05), "a": whole.astype(np.float32),
                        "v": draw("v", 0.05), "b": (own - whole[:, None]).astype(np.float32)})

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[k].ravel() for k in self.NAMES])

    @staticmethod
    def of(flat: np.ndarray, classes: int, hidden: int = HIDDEN) -> Network:
        out, at = {}, 0
        for name, shape in Network.shapes(classes, hidden).items():
            n = int(np.prod(shape))
            out[name], at = np.array(flat[at:at + n], np.float32).reshape(shape), at + n
        return Network(out)

    def _output(self, out: np.ndarray, goal: np.ndarray, scale: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None, dict]:
        """Log probabilities of the goals after states ``out``; with ``scale`` also what the loss pulls the states to, and gradients."""
        g, a, v, b = (self.w[k] for k in "gavb")
        k, columns = b.shape[1], np.arange(len(out))
        group, place = _short(goal // k, len(b)), goal % k
        # A column per token: sums and maxima over the classes run along whole rows.
        p = g.T @ out.T
        p += a[:, None]
        p -= p.max(axis=0)
        log_p = p[group, columns]
        np.exp(p, out=p)
        total = p.sum(axis=0)
        log_p -= np.log(total)
        grads, up = {}, None
        if scale is not None:
            p *= scale / total
            p[group, columns] -= scale
            grads = {"g": (p @ out).T, "a": p.sum(axis=1), "v": np.zeros_like(v), "b": np.zeros_like(b)}
            up = p.T @ g.T
        # Tokens by group, so that each group's classes are worked out for its own tokens alone.
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(len(b) + 1))
        out, place, inner, more = out.take(order, axis=0), place[order], np.empty_like(log_p), np.empty_like(out)
        weight = None if scale is None else scale[order]
        for n in np.flatnonzero(np.diff(cuts)):
            some = slice(cuts[n], cuts[n + 1])
            own, at = place[some], columns[:cuts[n + 1] - cuts[n]]
            q = v[n] @ out[some].T
            q += b[n][:, None]
            q -= q.max(axis=0)
            chosen = q[own, at]
            np.exp(q, out=q)
            total = q.sum(axis=0)
            inner[some] = chosen - np.log(total)
            if scale is not None:
                q *= weight[some] / total
                q[own, at] -= weight[some]
                grads["v"][n], grads["b"][n] = q @ out[some], q.sum(axis=1)
                np.matmul(q.T, v[n], out=more[some])
        log_p[order] += inner
        if scale is not None:
            up[order] += more
        return log_p, up, grads

    def window(self, state: np.ndarray, before: np.ndarray, target: np.ndarray, mask: np.ndarray,
               train: bool = False) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray] | None]:
        """One window of (steps, slots): log probabilities, the state after it, gradients of the mean loss."""
        x, u = self.w["x"], self.w["u"]
        steps, slots = before.shape
        h = u.shape[0]
        # The gates' weights apart, so that all that follows works on arrays without gaps.
        xs, us = (np.ascontiguousarray(a.reshape(-1, 3, h).swapaxes(0, 1)) for a in (x, u))
        states = np.empty((steps + 1, slots, h), np.float32)
        states[0] = state
        kept = []
        for t in range(steps):
            rec, zr, new = states[t] @ us, np.empty((2, slots, h), np.float32), xs[2].take(before[t], axis=0)
            for n in (0, 1):
                xs[n].take(before[t], axis=0, out=zr[n], mode="clip")
            zr += rec[:2]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.divide(1, zr, out=zr)
            new += zr[1] * rec[2]
            new *= -2  # the hyperbolic tangent, by the faster exponential
            np.exp(new, out=new)
            new += 1
            np.divide(2, new, out=new)
            new -= 1
            own = np.subtract(states[t], new, out=states[t + 1])
            own *= zr[0]
            own += new
            if train:
                kept.append((zr, rec[2], new))
        out = states[1:].reshape(-1, h)
        scale = mask.ravel().astype(np.float32) / max(1, int(mask.sum())) if train else None
        log_p, up, grads = self._output(out, target.ravel(), scale)
        log_p = log_p.reshape(steps, slots)
        if not train:
            return log_p, states[-1], None
        up = up.reshape(steps, slots, h)
        gates, inner = np.empty((steps, slots, 3 * h), np.float32), np.empty((steps, slots, h), np.float32)
        down = np.zeros((slots, h), np.float32)
        for t in range(steps - 1, -1, -1):
            (z, r), rec_new, new = kept[t]
            d = up[t] + down
            rest = 1 - z
            dz = states[t] - new
            dz *= d
            dz *= z
            dz *= rest
            rest *= d
            np.multiply(new, new, out=new)
            np.subtract(1, new, out=new)
            dn = np.multiply(rest, new, out=rest)
            dr = rec_new
            dr *= dn
            dr *= r
            np.subtract(1, r, out=new)
            dr *= new
            g = gates[t]
            g[:, :h], g[:, h:2 * h], g[:, 2 * h:] = dz, dr, dn
            d *= z
            d += g[:, :2 * h] @ u[:, :2 * h].T
            d += np.multiply(dn, r, out=inner[t]) @ u[:, 2 * h:].T
            down = d
        flat, index, old = gates.reshape(-1, 3 * h), before.ravel(), states[:-1].reshape(-1, h).T
        grads["u"] = np.concatenate([old @ flat[:, :2 * h], old @ inner.reshape(-1, h)], axis=1)
        order = np.argsort(_short(index, len(x)), kind="stable")
        firsts = np.flatnonzero(np.r_[True, index[order][1:] != index[order][:-1]])
        grads["x"] = np.zeros_like(x)
        grads["x"][index[order][firsts]] = np.add.reduceat(flat.take(order, axis=0), firsts, axis=0)
        return log_p, states[-1], grads


def _windows(classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, slots: int, end: int):
    """Windows over many documents side by side: (slots' documents, before, target, mask, which start anew).

    Long documents first; a slot whose document has ended takes the next one.  Before a document stands ``end``.
    """
    queue = np.argsort(-lengths, kind="stable")
    width = min(slots, len(queue))
    doc, at, taken = queue[:width].copy(), np.zeros(width, np.int64), width
    fresh = np.ones(width, bool)
    span = np.arange(STEPS)
    while width:
        left = lengths[doc] - at
        mask = span[:, None] < left
        place = np.where(mask, starts[doc] + at + span[:, None], 0)
        target = classes[place]
        before = classes[np.maximum(place - 1, 0)]
        before[0, at == 0] = end
        yield doc, before, target, mask, fresh
        at = at + STEPS
        over = np.flatnonzero(at >= lengths[doc])
        fresh = np.zeros(width, bool)
        more = queue[taken:taken + len(over)]
        taken += len(more)
        filled, empty = over[:len(more)], over[len(more):]
        doc[filled], at[filled], fresh[filled] = more, 0, True
        if len(empty):
            stay = np.ones(width, bool)
            stay[empty] = False
            doc, at, fresh, width = doc[stay], at[stay], fresh[stay], int(stay.sum())
            yield None, stay, None, None, None


def _chunk(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    classes = np.frombuffer(batch.column("classes")[row].as_buffer(), "<i4")
    lengths = batch.column("lengths")[row].values.to_numpy().astype(np.int64) + 1
    return classes, np.cumsum(lengths) - lengths, lengths, np.array(batch.column("held")[row].as_py(), bool)


def train_chunk(network: Network, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, rate: float = 0.02) -> Network:
    """One pass over a chunk's documents by Adam with clipped gradients.

    Steps shrink with the tokens in a window, so the last long document alone does not undo what
    all have taught, and with the share of the chunk that is done.
    """
    w = {k: a.copy() for k, a in network.w.items()}
    own = Network(w)
    first, second, step = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}, 0
    state, slots, seen, total = None, int(np.clip(len(lengths) // 8, 16, TRAINED)), 0, int(lengths.sum())
    for doc, before, target, mask, fresh in _windows(classes, starts, lengths, slots, len(w["x"]) - 1):
        if doc is None:
            state = state[before]
            continue
        state = np.zeros((len(doc), HIDDEN), np.float32) if state is None else np.where(fresh[:, None], 0, state)
        _, state, grads = own.window(state.astype(np.float32), before, target, mask, train=True)
        norm = float(np.sqrt(sum((g * g).sum() for g in grads.values())))
        step += 1
        now = rate * min(1.0, mask.sum() / (STEPS * slots)) * max(0.02, 1 - seen / total)
        seen += int(mask.sum())
        for k, g in grads.items():
            g = g * min(1.0, 1.0 / (norm + 1e-12))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            w[k] -= now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return own


def score_chunk(network: Network, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log probability of the classes of every document."""
    scores, state = np.zeros(len(lengths)), None
    for doc, before, target, mask, fresh in _windows(classes, starts, lengths, SCORED, len(network.w["x"]) - 1):
        if doc is None:
            state = state[before]
            continue
        state = np.zeros((len(doc), HIDDEN), np.float32) if state is None else np.where(fresh[:, None], 0, state)
        log_p, state, _ = network.window(state.astype(np.float32), before, target, mask)
        scores[doc] += np.where(mask, log_p, 0).sum(axis=0, dtype=np.float64)
    return scores


def _trained(start: np.ndarray, classes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own, starts, lengths, held = _chunk(batch, row)
                n = int(lengths[~held].sum())
                if n:
                    flat = train_chunk(Network.of(start, classes), own, starts[~held], lengths[~held]).flat().astype("<f4")
                    cuts = range(0, len(flat), SLICE)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(range(len(cuts))), pa.int32()), pa.array([n] * len(cuts), pa.int64()),
                         pa.array([flat[at:at + SLICE].tobytes() for at in cuts], pa.binary())], ["slice", "n", "weights"])

    return run


def _averaged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The average of each slice over all chunks, by their tokens."""
    sums: dict[int, list] = {}
    for batch in batches:
        for at, n, weights in zip(batch.column("slice").to_pylist(), batch.column("n").to_pylist(), batch.column("weights"), strict=True):
            own = n * np.frombuffer(weights.as_buffer(), "<f4").astype(np.float64)
            have = sums.setdefault(at, [0, 0.0])
            sums[at] = [have[0] + n, have[1] + own]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([(w / n).astype("<f4").tobytes() for n, w in sums.values()], pa.binary())],
        ["slice", "weights"])


def train(chunks: DataFrame, vocabulary: Vocabulary) -> Network:
    """The average of the chunks' networks; tasks average slices of the weights, the driver gets one network."""
    start = Network.start(vocabulary.unigram())
    each = chunks.mapInArrow(_trained(start.flat(), vocabulary.size), "slice int, n long, weights binary")
    slices = each.repartition(wide(chunks.sparkSession), "slice").mapInArrow(_averaged, "slice int, weights binary").collect()
    if not slices:
        return start
    slices.sort(key=lambda r: r["slice"])
    return Network.of(np.concatenate([np.frombuffer(r["weights"], "<f4") for r in slices]), vocabulary.size)


def _scored(weights: np.ndarray, classes: int, tokens: int):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.of(weights, classes)
        for batch in batches:
            for row in range(batch.num_rows):
                own, starts, lengths, held = _chunk(batch, row)
                scores = score_chunk(network, own, starts, lengths)
                within = batch.column("within")[row].values.to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[row].values, pa.array(held), pa.array(lengths),
                     batch.column("n_known")[row].values, pa.array(np.full(len(lengths), tokens, np.int64)),
                     batch.column("base_score")[row].values, pa.array((scores + within) / np.log(10))], names)

    return run


def score_documents(docs: DataFrame, held: Column | None = None, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``held``: which rows (by the column ``doc_id``) are not learnt from.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_column, text=text_column)
    rows = rows.select("doc_id", (held if held is not None else held_out(F.col("doc_id"))).alias("held"), "text")
    buckets = partitions_for(docs, text_column, 30, least=4)
    path = new_folder(spark, "chunks")
    (rows.mapInArrow(_chunked(buckets), CHUNK).withColumn("kind", F.when(F.col("bucket").isNull(), "docs").otherwise("words"))
     .write.partitionBy("kind").parquet(path))
    table = spark.read.schema(CHUNK + ", kind string").parquet(path)
    chunks, entries = table.where("kind = 'docs'"), table.where("kind = 'words'").select("chunk", "bucket", "entries")
    merged = stored(entries.repartition(buckets, "bucket").mapInArrow(
        _merged, "chunk string, bucket int, counts binary"), "merged")
    documents = chunks.select(F.size(F.filter("held", lambda x: ~x)).alias("n")).agg(F.sum("n")).first()[0] or 0
    known = vocabulary(merged, documents)
    found = merged.where(F.col("chunk").isNotNull()).groupBy("chunk").agg(
        F.collect_list(F.struct("bucket", "counts")).alias("found"))
    classified = stored(chunks.select("chunk", "doc_ids", "held", "lengths", "words", "places").join(
        found, "chunk", "left").mapInArrow(_classified(known), CLASSIFIED), "classes")
    drop_stored(merged)
    network = train(classified, known)
    return classified.mapInArrow(
        _scored(network.flat(), known.size, known.tokens), "doc_id long, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double")
