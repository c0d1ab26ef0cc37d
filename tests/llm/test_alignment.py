"""Cross-tokenizer alignment against a plain version, and its merge against set operations."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from areaweave.llm import alignment
from areaweave.llm.queries import op13_alignment, vocabulary_paths

NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
TEXTS = [None, "", " ", "a", "Hello, world", "Hello, world", "ünï çødé 中文 🙂 done", "<s> <|endoftext|> </s> <0x41>",
         "a ▁ mark", "line\n\n  two\t end  ", "x" * 3_000, "=" * 5_000, "ab" * 700 + " " * 900 + "é" * 800, "\x00\x1f z",
         "é ﬁ ①", "the " * 2_000, "don't we'll 12345 3.14159"]


def plain(texts):
    """Each row's figures by loops over characters' ends, tokens and pairs."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = vocabulary_paths()
    a_model, b_model = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a_model.encode_special_tokens = True
    plain_bytes = [*range(33, 127), *range(161, 173), *range(174, 256)]
    decode = {chr(b): b for b in plain_bytes}
    decode.update({chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain_bytes)})

    def a_bytes(i):
        return bytes(decode[c] for c in a_model.id_to_token(i))

    def b_bytes(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()

    found = []
    for text in texts:
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            a, b = [], []
        groups, i, j, at_a, at_b, group = [], 0, 0, 0, 0, ([], [])
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                at_a += len(a_bytes(a[i]))
                group[0].append(a[i])
                i += 1
            else:
                at_b += len(b_bytes(b[j]))
                group[1].append(b[j])
                j += 1
            if at_a == at_b:
                groups.append(group)
                group = ([], [])
        found.append((a, b, groups))
    counts = Counter()
    for _, _, groups in found:
        counts.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    rows = []
    for a, b, groups in found:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links),
                     sum(counts[p] for p in links), hashlib.sha256(shown.encode()).hexdigest() if a else ""))
    return rows


@pytest.mark.parametrize("sent", [0, 40, None])
def test_alignment_as_plain(spark, sent):
    rng = random.Random(1)
    words = ["the", "naïve", "token", "izers", "12", "…", "  ", "\n", "—", "straße", "日本"]
    texts = TEXTS + ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randrange(1, 90))) for _ in range(40)]
    rows = [(i // 2 if i else None, t, "clash", "clash", "clash") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row string, pair string, n string")
    got = alignment.align(frame, *vocabulary_paths(), sent=sent).collect()
    expected = [(r[0], *figures) for r, figures in zip(rows, plain(texts), strict=True)]
    assert sorted(((r.doc_id, *[r[n] for n in NAMES]) for r in got), key=repr) == sorted(expected, key=repr)
    assert alignment.align(frame.limit(0), *vocabulary_paths(), sent=sent).count() == 0


def test_registered_query_as_plain(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = op13_alignment(spark, sf).collect()
    expected = [(r.doc_id, *figures) for r, figures in zip(table, plain([r.text for r in table]), strict=True)]
    assert sorted((r.doc_id, *[r[n] for n in NAMES]) for r in got) == sorted(expected)


@pytest.mark.parametrize("steps", [1, 2, 3, 7, 64, 10_000])
def test_pieces_are_even_and_groups_are_common_ends(steps):
    rng = random.Random(steps)
    for _ in range(60):
        last = rng.randrange(1, 300)
        a, b = (np.array(sorted({last, *rng.sample(range(1, last + 1), rng.randrange(last + 1))})) for _ in "ab")
        rows, columns = alignment.merge_pieces(a, b, steps)
        work = np.diff(rows) + np.diff(columns)
        assert (work[:-1] == steps).all() and work[-1] <= steps and work.sum() == len(a) + len(b)
        a_cut, b_cut = alignment.groups_of(a, b, steps)
        common = np.intersect1d(a, b)
        assert (a[a_cut] == common).all() and (b[b_cut] == common).all()
        pairs = [p for at, bt, _ in alignment.overlaps(a, b, steps) for p in zip(at.tolist(), bt.tolist(), strict=True)]
        starts = [np.concatenate([[0], x[:-1]]) for x in (a, b)]
        assert sorted(pairs) == [(i, j) for i in range(len(a)) for j in range(len(b))
                                 if max(starts[0][i], starts[1][j]) < min(a[i], b[j])]


@pytest.mark.parametrize("most", [1, 5, 50, 10_000])
def test_links_in_classes(most):
    rng = random.Random(most)
    groups = sorted(rng.randrange(6) for _ in range(80)), sorted(rng.randrange(6) for _ in range(60))
    groups = [np.array(sorted([*range(6), *g])) for g in groups]
    a, b = (np.array([rng.randrange(9) for _ in g]) for g in groups)
    got = Counter()
    for doc, pair, links in alignment.doc_pairs(a, groups[0], b, groups[1], np.zeros(6, np.int64), most):
        assert (doc == 0).all() and not set(pair.tolist()) & set(got)
        got.update(dict(zip(pair.tolist(), links.tolist(), strict=True)))
    expected = Counter((int(x) << 32) + int(y) for x, g in zip(a, groups[0], strict=True)
                       for y, h in zip(b, groups[1], strict=True) if g == h)
    assert got == expected


def test_fast_byte_tokens_are_those_of_the_file():
    from tokenizers import Tokenizer

    path = vocabulary_paths()[0]
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    texts = [t for t in TEXTS if t]
    assert alignment.ByteTokens(path).of(texts) == [slow.encode(" " + t, add_special_tokens=False).ids for t in texts]
