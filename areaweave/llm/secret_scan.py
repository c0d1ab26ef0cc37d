"""Secret scans: candidates by shape and context, false positives removed by a random forest.

A candidate is a value of any marks given to a credential name, a run of key characters that mixes
letters and digits, or a private key block.  Its features are length, character classes and
transitions between them, entropy, dictionary coverage, the path it comes from and the words beside
it.  The forest is fitted on the driver to a bounded sample of labelled findings (``LABELLED``, the
least by a hash); all candidates of all texts are judged.

Labels come from a table of findings.  Where none is given, ``planted`` makes one: secrets and
harmless look-alikes are written into copies of some of the texts, and a finding is labelled by which of the two
was written there.  So labels come from what was planted and not from rules over the features.

Null and empty texts have no candidates.  A run may have any length; whole texts are read once.
Findings carry their row's id and a digest of its text: rows that repeat an id keep their own
findings, rows that repeat both have the same ones.
"""

from __future__ import annotations

import base64
import math
import random
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaweave.llm.common import pick, stored

#: Labelled findings that the forest is fitted to, at most, and documents into whose copies findings are planted, at most.
LABELLED = 20_000
PLANTED = 1_000
#: Findings planted into each of these documents at least, and in all at least.
EACH, IN_ALL = 12, 8_000
TREES, DEPTH, LEAF = 24, 7, 3
THRESHOLD = 0.5
MASK = "[SECRET]"

TRIGGER = re.compile(r"[0-9=:]|-----BEGIN")
RUN = re.compile(r"[A-Za-z0-9+/_\-=.~]+")
KEY_BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----.*?(?:-----END [A-Z ]*PRIVATE KEY-----|\Z)", re.S)
#: Formats that providers publish (fixed values).
PROVIDERS = re.compile(
    r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{60,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|sk_live_[A-Za-z0-9]{16,}|rk_live_[A-Za-z0-9]{16,}|AIza[0-9A-Za-z_-]{35}|glpat-[A-Za-z0-9_-]{20}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+|SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}")
CREDENTIAL = re.compile(
    r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer)s?"
    r"[\"']?\s*(?:[=:]|is|\s)\s*[\"']?\s*$", re.I)
ASSIGNED = re.compile(r"(?:[=:]\s*[\"']?|[\"'])$")
PLACEHOLDER = re.compile(r"example|sample|dummy|placeholder|changeme|your[_-]|xxxx|\*\*\*|0000000|123456|test", re.I)
HARMLESS = re.compile(r"(?:sha\d*|md5|digest|checksum|commit|revision|uuid|guid|etag|hash|version|isbn|order|invoice|id)[\"'\s:=#-]*$", re.I)
HOST = re.compile(r"(?:[a-z0-9-]+\.)+(?:com|org|net|io|edu|gov|de|fr|es|uk|html?|php|js|css|png|jpg)\b", re.I)
TESTY = re.compile(r"test|example|sample|mock|fixture|doc|tutorial|readme", re.I)
DICTIONARY = re.compile("|".join(sorted((
    "access account admin amazon auth author base build cache cert change client cloud code color config content count "
    "create data date default demo device domain error event example field file filter first folder format frame git "
    "google group hash header home host html http https image import index input item java json key language last "
    "level library light line link list local log login mail main map master media message method model module month "
    "name network node null number object option order output package page param pass password path payload photo "
    "picture plain point port post prefix private product profile project public query random read record remote "
    "report request resource response result root sample script secret section select server service session setting "
    "site size source staging start state static status storage string style system table tag target template test "
    "text thread time title token type unique update upload url user uuid value version video view web window word "
    "www year zone").split(), key=len, reverse=True)), re.I)

NAMES = ("length", "digits", "upper", "lower", "marks", "transitions", "entropy", "hexadecimal", "vowels", "dictionary",
         "placeholder", "host", "path", "credential", "assigned", "harmless", "quoted", "equals", "longest_letters")


def _classes(value: str) -> str:
    return "".join("d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "m" for c in value)


def features(value: str, before: str, after: str, path: str) -> list[float]:
    n, kinds = len(value), _classes(value)
    counts, seen = Counter(kinds), Counter(value)
    m = max(1, len(kinds))
    entropy = -sum(c / m * math.log2(c / m) for c in seen.values())
    covered = sum(len(x.group()) for x in DICTIONARY.finditer(value))
    letters = max(map(len, re.findall(r"[A-Za-z]+", value)), default=0)
    return [n, counts["d"] / m, counts["u"] / m, counts["l"] / m, counts["m"] / m,
            sum(a != b for a, b in zip(kinds, kinds[1:])) / m, entropy,
            float(all(c in "0123456789abcdefABCDEF" for c in seen)),
            sum(seen[c] for c in "aeiouAEIOU") / m, covered / m, float(bool(PLACEHOLDER.search(value))),
            float(bool(HOST.fullmatch(value))), float(bool(TESTY.search(path))), float(bool(CREDENTIAL.search(before))),
            float(bool(ASSIGNED.search(before))), float(bool(HARMLESS.search(before))),
            float(before[-1:] in "\"'" and after[:1] in "\"'" and bool(before)), float(before.rstrip(" \"'")[-1:] in ("=", ":")),
            letters]


#: A credential name and what is given to it: in quotes as a whole, else up to white space.
GIVEN = re.compile(
    r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer)s?"
    r"[\"']?(?:\s*(?:[=:]|\bis\b)\s*|\s+)(?:([\"'])(?=\S)(.{8,}?)\1|([^\s\"'<>]{8,}))", re.I)
#: One of these is in every credential name.
NAMED = ("pass", "pwd", "secret", "token", "key", "auth", "credential", "bearer")


def _given(text: str) -> Iterator[tuple[int, int]]:
    """Places of values given to credential names, in order and apart; a word alone is none."""
    low = text.lower()
    if not any(name in low for name in NAMED):
        return
    position = 0
    while (hit := GIVEN.search(text, position)) is not None:
        group = 2 if hit[1] else 3
        start, end = hit.span(group)
        while group == 3 and end > start and text[end - 1] in ".,;:)]}!?":
            end -= 1
        value = text[start:end]
        # After a name without a sign or "is", a run must look like a key.
        assigned = text[hit.start():start].rstrip("\"' \t\r\n")[-1:] in ("=", ":") or re.search(r"\bis\s+[\"']?$", text[hit.start():start], re.I)
        if len(value) >= 8 and not value.isalpha() and not value.startswith("-----BEGIN") and (
                assigned or (any(c.isdigit() for c in value) and any(c.isalpha() for c in value))):
            yield start, end
            position = end
        else:
            position = hit.start() + 1 if start == end else start


def candidates(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, words before, words after) of every candidate, in order and apart from each other."""
    given, done = list(_given(text)), 0
    nth = 0
    for start, end in _runs(text):
        while nth < len(given) and given[nth][0] < end:
            a, b = given[nth]
            nth += 1
            if a >= done:
                yield a, b, text[max(0, a - 40):a], text[b:b + 20]
                done = b
        if start >= done:
            yield start, end, text[max(0, start - 40):start], text[end:end + 20]
            done = end
    for a, b in given[nth:]:
        if a >= done:
            yield a, b, text[max(0, a - 40):a], text[b:b + 20]
            done = b


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """Private key blocks, and runs of key characters that mix letters and digits."""
    done, position = 0, 0
    while (hit := TRIGGER.search(text, position)) is not None:
        at = hit.start()
        if text.startswith("-----BEGIN", at):
            block = KEY_BLOCK.match(text, at)
            if block:
                yield at, block.end()
                done = position = block.end()
                continue
            position = at + 10
            continue
        start = at
        while text[at] != ":" and start > done and (c := text[start - 1]).isascii() and (c.isalnum() or c in "+/_-=.~"):
            start -= 1
        run = RUN.match(text, start)
        if run is None:
            position = at + 1
            continue
        position = end = run.end()
        value = run.group()
        equals = value.find("=")
        if 0 < equals < len(value.rstrip("=")) and value[:equals].replace("_", "").replace("-", "").replace(".", "").isalnum():
            start += equals + 1
        while end > start and text[end - 1] in ".-_/~+":
            end -= 1
        value = text[start:end]
        if len(value) >= 12 and any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            yield start, end
            done = end


def _draw(rng: random.Random, alphabet: str, low: int, high: int) -> str:
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(low, high)))


_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
_MIXED = _LOWER + _LOWER.upper() + _DIGITS
_NAMES = ("password", "passwd", "pwd", "secret", "client_secret", "token", "auth_token", "api_key", "apikey", "API-KEY", "access_key",
          "private_key", "credential", "DB_PASSWORD", "passphrase")
_WORDS = ("account admin build cache client cloud code config content data default device domain error event file group header image "
          "index input item level library light line list local main master media message model name network node number object "
          "order output page payload photo point port profile project public query random record remote report request resource "
          "result sample script server service session setting source state static storage string style system table target "
          "template thread time title unique update upload user value version video view window word year zone").split()


def plant(rng: random.Random) -> tuple[str, str, str, int]:
    """Text before, value, text after, and whether the value is a secret."""
    quote = rng.choice(["", "", "\"", "'"])
    name, sign = rng.choice(_NAMES), rng.choice([" = ", "=", ": ", ":", " is "])
    key = rng.choice([lambda: _draw(rng, _MIXED, 16, 48), lambda: _draw(rng, "0123456789abcdef", 16, 64),
                      lambda: base64.b64encode(rng.randbytes(rng.randint(16, 40))).decode(),
                      lambda: _draw(rng, _MIXED + "-_", 20, 60)])
    kind = rng.randrange(12)
    if kind < 3:  # a password with marks
        value = _draw(rng, _MIXED + "!@#$%^&*?-_+.", 9, 24) + rng.choice(_DIGITS) + rng.choice("!@#$%^&*?x")
        return f"{name}{sign}{quote}", value, quote, 1
    if kind == 3:
        return f"{name}{sign}{quote}", key(), quote, 1
    if kind == 4:  # a provider's format, wherever it stands
        value = rng.choice([lambda: "AKIA" + _draw(rng, _LOWER.upper() + _DIGITS, 16, 16), lambda: "ghp_" + _draw(rng, _MIXED, 36, 36),
                            lambda: "sk_live_" + _draw(rng, _MIXED, 24, 24), lambda: "xoxb-" + _draw(rng, _DIGITS, 11, 11) + "-" + _draw(rng, _MIXED, 24, 24),
                            lambda: "AIza" + _draw(rng, _MIXED + "_-", 35, 35), lambda: "glpat-" + _draw(rng, _MIXED, 20, 20)])()
        return rng.choice(["", "key ", "use ", f"{name}{sign}", "\""]), value, rng.choice(["", " now", "\""]), 1
    if kind == 5:
        return rng.choice(["", "with ", "-H Authorization: Bearer ", "https://user:"]), key(), rng.choice(["", " "]), 1
    if kind == 6:
        return rng.choice(["commit ", "sha256:", "md5 = ", "checksum: ", "etag \"", "digest ", "revision "]), _draw(
            rng, "0123456789abcdef", 32, 64), rng.choice(["", "\""]), 0
    if kind == 7:
        return rng.choice(["id ", "uuid: ", "request ", "", "order "]), str(uuid.UUID(int=rng.getrandbits(128))), "", 0
    if kind == 8:  # words with numbers: names of files, hosts, styles, versions
        words = rng.sample(_WORDS, rng.randint(2, 4))
        value = rng.choice("-_./").join([*words, str(rng.randrange(10_000))]) + rng.choice(["", ".html", ".com", ".js", "v2"])
        return rng.choice(["see ", "", "src=", "in ", "file: "]), value, "", 0
    if kind == 9:  # what stands in for a secret
        value = rng.choice(["changeme", "your-", "example", "<", "xxxx", "placeholder", "sample"]).strip("<") + rng.choice(
            ["-key-here", "123456", "_token_1", "-password1", "xxxxxxxx", "****1234"])
        return f"{name}{sign}{quote}", value, quote, 0
    if kind == 10:  # a name for another value
        words = rng.sample(_WORDS, 2)
        value = rng.choice([f"{words[0]}_{words[1]}_{rng.randrange(9)}", f"get{words[0].title()}{words[1].title()}()", f"${{{words[0].upper()}_{words[1].upper()}}}",
                            f"config.{words[0]}.{words[1]}", f"os.environ[{words[0]}_{words[1]}]"])
        return f"{name}{sign}{quote}", value, quote, 0
    value = rng.choice([lambda: f"{rng.randrange(1990, 2030)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}T{rng.randrange(10, 24)}:00Z",
                        lambda: "ISBN" + _draw(rng, _DIGITS, 10, 13), lambda: _draw(rng, _DIGITS, 6, 9) + _draw(rng, "kmgeuro", 3, 6),
                        lambda: "a" * rng.randint(6, 12) + _draw(rng, _DIGITS, 6, 8), lambda: "INV" + _draw(rng, _DIGITS, 9, 12)])()
    return rng.choice(["invoice ", "at ", "", "number ", "no. "]), value, "", 0


def planted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path_column: str | None = "source",
            most: int = PLANTED, seed: int = 1) -> DataFrame:
    """Labelled findings, like those of ``find_candidates``: ``most`` texts, the least by a digest, with values planted.

    Values stand between words of the texts.  Findings that are none of them have no label and are left out.  A text that has
    no words yet is planted into all the same; where there are few texts, each gets more.
    """
    rows = _rows(docs, id_column, text_column, path_column)
    # Digests are ordered, not texts; what is chosen is no more than ``most`` rows.
    chosen = rows.select("digest", F.col("doc_id").alias("chosen_id")).distinct().orderBy("digest", "chosen_id").limit(most)
    rows = rows.join(F.broadcast(chosen), "digest").where(F.col("doc_id").eqNullSafe(F.col("chosen_id"))).drop("chosen_id")
    rows = stored(rows.dropDuplicates(["digest", "doc_id"]).select("doc_id", "path", "digest", "text"), "planted")
    each = max(EACH, -(-IN_ALL // max(1, rows.count())))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for doc, digest, path, text in zip(*[batch.column(c) for c in ("doc_id", "digest", "path", "text")], strict=True):
                rng = random.Random(f"{seed} {doc.as_py()} {digest.as_py()}")
                words = (text.as_py() or "").split(" ")[:2_000]
                labels, parts, size, at = {}, [], 0, sorted(rng.randrange(len(words) + 1) for _ in range(each))
                times = Counter(at)
                for i in range(len(words) + 1):
                    for _ in range(times[i]):
                        before, value, after, label = plant(rng)
                        labels[size + len(before), size + len(before) + len(value)] = label
                        parts.append(f"{before}{value}{after}{rng.choice(' ,;') if after == '' else ''} ")
                        size += len(parts[-1])
                    if i < len(words):
                        parts.append(words[i] + rng.choice([" ", " ", " ", "\n"]))
                        size += len(parts[-1])
                written, where = "".join(parts), path.as_py() or ""
                for nth, (start, end, before, after) in enumerate(candidates(written)):
                    if (label := labels.get((start, end))) is not None:
                        _append(out, doc.as_py(), digest.as_py(), nth, start, end, features(written[start:end], before, after, where), label)
            yield _finding_batch(out, batch.column("doc_id").type)

    return rows.mapInArrow(run, f"doc_id {kind}, {FINDING}")


def weak_label(value: str, before: str) -> int:
    """What rules alone say of a finding; nothing is fitted to it."""
    if value.startswith("-----BEGIN") or PROVIDERS.fullmatch(value):
        return 1
    return int(bool(CREDENTIAL.search(before)) and not PLACEHOLDER.search(value) and any(c.isdigit() for c in value)
               and not HOST.fullmatch(value))


class Forest:
    """Decision trees on bootstrap samples with random features, as arrays; the vote is the mean of the leaves."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]]):
        self.trees = trees

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, leaf: int = LEAF, seed: int = 0) -> Forest:
        rng, grown = np.random.default_rng(seed), []
        if not len(y):
            return Forest([(np.array([-1]), np.zeros(1), np.zeros(1, int), np.zeros(1, int), np.ones(1))])
        tried = max(1, round(math.sqrt(x.shape[1])) + 1)
        for _ in range(trees):
            pick_ = rng.integers(0, len(y), len(y))
            feature, cut, low, high, value = [], [], [], [], []

            def grow(rows: np.ndarray, level: int) -> int:
                node = len(feature)
                for column, start in ((feature, -1), (cut, 0.0), (low, 0), (high, 0), (value, float(y[rows].mean()))):
                    column.append(start)
                if level == depth or len(rows) < 2 * leaf or value[node] in (0.0, 1.0):
                    return node
                best = (0.0, -1, 0.0)
                total, ones = len(rows), y[rows].sum()
                parent = ones * (total - ones) / total
                for f in rng.permutation(x.shape[1])[:tried]:
                    order = rows[np.argsort(x[rows, f], kind="stable")]
                    v, cum = x[order, f], np.cumsum(y[order])
                    places = np.flatnonzero(v[1:] > v[:-1])
                    places = places[(places + 1 >= leaf) & (total - places - 1 >= leaf)]
                    if not len(places):
                        continue
                    n, k = places + 1, cum[places]
                    gain = parent - k * (n - k) / n - (ones - k) * (total - n - ones + k) / (total - n)
                    i = int(np.argmax(gain))
                    if gain[i] > best[0]:
                        best = (float(gain[i]), int(f), float((v[places[i]] + v[places[i] + 1]) / 2))
                if best[1] < 0:
                    return node
                feature[node], cut[node] = best[1], best[2]
                below = x[rows, best[1]] <= best[2]
                low[node] = grow(rows[below], level + 1)
                high[node] = grow(rows[~below], level + 1)
                return node

            grow(pick_, 0)
            grown.append((np.array(feature), np.array(cut), np.array(low), np.array(high), np.array(value)))
        return Forest(grown)

    def predict(self, x: np.ndarray) -> np.ndarray:
        votes, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, low, high, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(DEPTH + 1):
                inner = feature[node] >= 0
                below = x[rows, np.maximum(feature[node], 0)] <= cut[node]
                node = np.where(inner, np.where(below, low[node], high[node]), node)
            votes += value[node]
        return votes / len(self.trees)


FINDING = "digest long, nth long, start long, end long, features array<double>, label int"


def _append(out: list[list], *values) -> None:
    for column, value in zip(out, values, strict=True):
        column.append(value)


def _finding_batch(out: list[list], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                                      ["doc_id", "digest", "nth", "start", "end", "features", "label"])


def _found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], [], [], []]
        for doc, digest, path, text in zip(*[batch.column(c) for c in ("doc_id", "digest", "path", "text")], strict=True):
            text, where = text.as_py() or "", path.as_py() or ""
            for nth, (start, end, before, after) in enumerate(candidates(text)):
                value = text[start:end]
                _append(out, doc.as_py(), digest.as_py(), nth, start, end, features(value, before, after, where), weak_label(value, before))
        yield _finding_batch(out, batch.column("doc_id").type)


def _rows(docs: DataFrame, id_column: str, text_column: str, path_column: str | None) -> DataFrame:
    rows = pick(docs, doc_id=id_column, text=text_column, **({"path": path_column} if path_column else {}))
    if not path_column:
        rows = rows.withColumn("path", F.lit(""))
    return rows.withColumns({"path": F.col("path").cast("string"), "digest": F.xxhash64("text")})


def find_candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    path_column: str | None = "source") -> DataFrame:
    """doc_id, digest of the text, nth, start, end, features and label by rule of every candidate."""
    rows = _rows(docs, id_column, text_column, path_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_found, f"doc_id {kind}, {FINDING}")


def fit_forest(findings: DataFrame, most: int = LABELLED) -> Forest:
    """A forest from findings with ``features`` and ``label``: at most ``most``, the least by a hash, half of each label."""
    rows = []
    for label in (0, 1):
        own = findings.where(F.col("label") == label).select("features", "label", "doc_id", "start")
        rows += own.orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start").limit(most // 2).collect()
    x = np.array([r["features"] for r in rows], float).reshape(len(rows), len(NAMES))
    return Forest.fit(x, np.array([r["label"] for r in rows], float))


def judge(findings: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """Findings with the forest's ``score`` and whether they are secrets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
            score = forest.predict(flat.reshape(batch.num_rows, -1)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "digest", "nth", "start", "end")], pa.array(score), pa.array(score >= threshold)],
                ["doc_id", "digest", "nth", "start", "end", "score", "secret"])

    kind = findings.schema["doc_id"].dataType.simpleString()
    return findings.mapInArrow(run, f"doc_id {kind}, digest long, nth long, start long, end long, score double, secret boolean")


def redact(docs: DataFrame, forest: Forest, id_column: str = "doc_id", text_column: str = "text",
           path_column: str | None = "source", threshold: float = THRESHOLD, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mask``; all columns and rows stay."""
    names, schema = docs.columns, docs.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index(text_column)).to_pylist()
            paths = batch.column(names.index(path_column)).to_pylist() if path_column else [""] * len(texts)
            spans = [(i, *c) for i, t in enumerate(texts) if t for c in candidates(t)]
            if spans:
                x = np.array([features(texts[i][a:b], before, after, str(paths[i] or "")) for i, a, b, before, after in spans])
                for (i, a, b, _, _), s in reversed(list(zip(spans, forest.predict(x), strict=True))):
                    if s >= threshold:
                        texts[i] = texts[i][:a] + mask + texts[i][b:]
            columns = [pa.array(texts, pa.string()) if n == text_column else batch.column(k) for k, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text",
         path_column: str | None = "source") -> tuple[DataFrame, Forest]:
    """Judged findings of all of ``docs``, and the forest, fitted to ``labelled`` findings or to planted ones."""
    if labelled is None:
        labelled = stored(planted(docs, id_column, text_column, path_column), "planted")
    forest = fit_forest(labelled)
    return judge(find_candidates(docs, id_column, text_column, path_column), forest), forest
