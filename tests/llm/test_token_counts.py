import random

import numpy as np
import pytest

from quire.llm.queries import tokenizer
from quire.llm.token_counts import CHUNK, TokenCounter, token_counts

PATH = tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_equals_library_on_odd_texts(library):
    rng = random.Random(0)
    parts = ["a", "'", "s", "'s", "re", "'re", "'ll", "l", "v", "e", " ", "  ", "\n", "\t", "1", "²", "é", "日本", "🙂", "\xa0", "\x1c", "\x85", "<|endoftext|>", "...", "aaaa", "=====", "\r\n", "the", "_", "٣"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)] + ["x" * 5000, " " * (CHUNK * 3), "'" * 200]
    with open(PATH, encoding="utf-8") as file:
        counter = TokenCounter(file.read())
    assert counter.counts(texts).tolist() == expected(library, texts)


def test_states_are_bounded_inside_a_long_word(library, monkeypatch):
    """A word of any length, with counts as if nothing had been forgotten."""
    from quire.llm import token_counts as M

    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=k)) for k in (3000, 20_000)]
    monkeypatch.setattr(M, "MAX_STATES", 40)
    with open(PATH, encoding="utf-8") as file:
        counter = TokenCounter(file.read())
    assert counter.counts(words).tolist() == expected(library, words)
    assert len(counter.merger.states) <= 42 and len(counter.merger.moves) <= 50


def test_rows_nulls_and_clashing_names(spark, library):
    rows = [(1, "it's a test", 9), (1, "it's a test", 9), (None, None, None), (2, "", 1), (2**60, "word " * 600, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, token_counts(df, PATH).collect()), key=str)
    texts = [r[1] or "" for r in rows]
    want = [(r[0], len(t.encode()), n, n > 512) for r, t, n in zip(rows, texts, expected(library, texts))]
    assert got == sorted(want, key=str)
    assert token_counts(df.limit(0), PATH).count() == 0


def test_other_settings_are_refused():
    import json

    import pytest

    from quire.llm.token_counts import TokenCounter

    content = json.load(open(tokenizer("byte_bpe_50k.json")))
    TokenCounter(json.dumps(content))
    added = dict(content["added_tokens"][0])
    changes = [
        {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": content["pre_tokenizer"] | {"add_prefix_space": True}},
        {"model": content["model"] | {"ignore_merges": True}}, {"added_tokens": [added | {"lstrip": True}]}, {"added_tokens": [added | {"special": False}]},
    ]
    for change in changes:
        with pytest.raises(ValueError, match="not supported"):
            TokenCounter(json.dumps(content | change))
