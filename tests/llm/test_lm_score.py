import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from wordloom.llm import ctw
from wordloom.llm.lm_score import ctw_scores


def kt(a, b):
    p, seen = 0.0, [0, 0]
    for bit in [0] * a + [1] * b:
        p += math.log((seen[bit] + 0.5) / (sum(seen) + 1))
        seen[bit] += 1
    return p


class Brute:
    """Context-tree weighting as the definition has it: recursion over contexts, one tree per decision."""

    def __init__(self, texts, depth):
        self.depth, self.seen = depth, Counter()
        for t in texts:
            padded = b"\n" * depth + t
            for i in range(depth, len(padded)):
                for bit in range(8):
                    node = (1 << bit) | (padded[i] >> (8 - bit))
                    for d in range(depth + 1):
                        self.seen[padded[i - d : i], node, padded[i] >> (7 - bit) & 1] += 1
        self.children = {}
        for context, node, _ in self.seen:
            if context:
                self.children.setdefault((context[1:], node), set()).add(context)

    def logs(self, context, node):
        own = kt(self.seen[context, node, 0], self.seen[context, node, 1])
        if len(context) == self.depth:
            return own, own, None
        below = sum(self.logs(c, node)[1] for c in self.children.get((context, node), ()))
        return own, np.logaddexp(own, below) - math.log(2), below

    def bit(self, context, node, one, d=0):
        suffix = context[len(context) - d :]
        a, b = self.seen[suffix, node, 0], self.seen[suffix, node, 1]
        p = ((b if one else a) + 0.5) / (a + b + 1)
        if d == self.depth:
            return p
        own, _, below = self.logs(suffix, node)
        beta = math.exp(own - below)
        return (beta * p + self.bit(context, node, one, d + 1)) / (beta + 1)

    def score(self, text):
        padded, total = b"\n" * self.depth + text, 0.0
        for i in range(self.depth, len(padded)):
            for bit in range(8):
                node = (1 << bit) | (padded[i] >> (8 - bit))
                total += math.log10(self.bit(padded[i - self.depth : i], node, padded[i] >> (7 - bit) & 1))
        return total


def normal(text):
    return b"".join(w + b" " for w in (text or "").encode().lower().split()) + b"\n"


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 7.25, 1000.5, 3e7])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-10)


@pytest.mark.parametrize("seed", [1, 2])
def test_scores_are_those_of_the_definition(spark, tmp_path, seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["ab", "aba", "Cab", "b"]) for _ in range(rng.randrange(7))) for _ in range(14)]
    rows = [(i, t or None) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r for r in ctw_scores(spark.read.parquet(str(tmp_path / "d")), depth=3).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    train = [normal(t) for i, t in rows if not held[i]]
    model = Brute(train, 3)
    counts = Counter(w for t in train for w in [*t.split(), b"\n"])
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        tokens = [*normal(t).split(), b"\n"]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        row = got[i]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[i], len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert row.base_score == pytest.approx(base, abs=1e-9)
        assert row.score == pytest.approx(model.score(normal(t)), rel=1e-9)


def test_odd_rows(odd_docs, no_docs):
    rows = ctw_scores(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].n_tokens == by_id[4].n_tokens == 1 and by_id[3].score == by_id[4].score
    assert by_id[None].held_out is False
    assert len({(r.score, r.base_score) for r in rows if r.doc_id == 1}) == 1
    assert all(r.score < 0 for r in rows)
    assert ctw_scores(no_docs).count() == 0


def test_probabilities_add_up_to_one():
    data = np.frombuffer(b"\n\n\nabracadabra abracadabra", np.uint8)
    codes, counts = np.unique(ctw.ngrams(data, 3), return_counts=True)
    trees = ctw.levels(codes, counts.astype(float), 3, 0)
    for context in (b"abr", b"zzz", b"\n\na"):
        base = sum(c << (8 * (k + 1)) for k, c in enumerate(context))
        assert np.exp(ctw.predict(base + np.arange(256), 3, trees)).sum() == pytest.approx(1)
