"""Runs of letters go to the tokenizer's model without the tokenizer around it."""

import numpy as np

from quirebind.llm import tokens


class Counted:
    """A tokenizer that counts how often all of it is used."""

    def __init__(self, inner):
        self.inner, self.calls = inner, 0

    def encode(self, *args, **named):
        self.calls += 1
        return self.inner.encode(*args, **named)

    def __getattr__(self, name):
        return getattr(self.inner, name)


def test_runs_of_letters_reach_the_model_alone():
    made = tokens.WordEncoder(tokens.default_tokenizer())
    made.tokenizer = Counted(made.tokenizer)
    rng = np.random.default_rng(5)
    runs = ["".join(rng.choice(tokens._LETTERS, n)) for n in rng.integers(1, 30, 3000)]
    got = made.texts(runs, 1)
    assert made.tokenizer.calls == 0  # was one call for every 200 runs at least
    for x, raw in zip(runs, got, strict=True):
        whole = made.tokenizer.inner.encode(x, add_special_tokens=False).ids
        assert np.frombuffer(raw, made.kind).tolist() == whole + [1]


def test_without_spelling_the_same_ids():
    made, plain = (tokens.WordEncoder(tokens.default_tokenizer()) for _ in range(2))
    assert made.spelled
    plain.spelled = None
    texts = ["ÀÉÿß Straße naïve ÇA señor Þorn a.b,c x1y", "don't mañana's 12 日本 ab", "", None]
    assert made.texts(texts, 1) == plain.texts(texts, 1)
