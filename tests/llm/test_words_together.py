"""Words with digits or marks pass the tokenizer many at once."""

from __future__ import annotations

from areaweave.llm import packing
from areaweave.llm.queries import tokenizer_path


class Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.passed = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.passed += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_words_with_digits_and_marks_pass_together():
    words = packing.WordIds(tokenizer_path())
    words.tokenizer = Counting(words.tokenizer)
    texts = [" ".join(f"a{i}-b{i}/{i}.5 x|{i % 3}" for i in range(n, n + 400)) + " | ~ don't ¶ §5" for n in (0, 400, 800)]
    got = words.of(texts)
    assert words.tokenizer.passed < 100  # 1,200 different words
    assert got == words.encode(texts)
