import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordloom.llm.quality_rules import BASE, CURRENT, POLICIES, RULES, ablations, apply_policies, ledger, mask_of, rule_verdicts

KINDS = "doc_id long, text string"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    times = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered))


def texts():
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "dé", "#x", "\U0001f600"]
    made = ["".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "\t", "\x0b", "  ", "\n\n"]) for _ in range(rng.randrange(60))) for _ in range(150)]
    return [None, "", " \n\t ", "a", "a b", "a b c", "a a a a", "a b c a b c", "   \x85", "x\ny\nx\n x\nx", "lorem ipsum dolor " * 4000, *made]


def test_measurements_are_those_counted_by_hand(spark):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in rule_verdicts(spark.createDataFrame(rows, KINDS)).collect()}
    for i, text in rows:
        r = got[i]
        want = brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) == want, text
        assert r.base_failed == (want[0] < 50 or 100 * want[5] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_bits_say_which_rules_fail(spark):
    noted = ledger(spark.createDataFrame(list(enumerate(texts())), KINDS))
    for r in noted.select("failed", *[F.expr(rule.fails).alias(rule.name) for rule in RULES]).collect():
        assert r.failed == sum(1 << rule.bit for rule in RULES if r[rule.name])


def test_policies_and_ablations_read_the_mask_alone(spark):
    noted = ledger(spark.createDataFrame(list(enumerate(texts())), KINDS)).cache()
    masks = [r.failed for r in noted.collect()]
    policies = POLICIES | {5: ("symbols",), 6: ()}
    for r in apply_policies(noted, policies).collect():
        assert r.passed == sum(1 << v for v, names in policies.items() if not r.failed & mask_of(names))
    rows = ablations(noted, policies).collect()
    assert {(r.version, r.rule) for r in rows} == {(v, n) for v, names in policies.items() for n in names}
    for r in rows:
        whole, bit = mask_of(policies[r.version]), mask_of([r.rule])
        union = 0
        for m in masks:
            union |= m if m & bit else 0
        assert (r.n_rows, r.n_kept, r.n_failed, r.n_only, r.n_kept_without, r.fails_with) == (
            len(masks), sum(not m & whole for m in masks), sum(bool(m & bit) for m in masks), sum(m & whole == bit for m in masks),
            sum(not m & (whole & ~bit) for m in masks), union,
        )
    with pytest.raises(KeyError):
        mask_of(["no such rule"])


def test_odd_rows(spark, odd_docs, no_docs):
    rows = rule_verdicts(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.base_failed is not None for r in rows)
    assert sum(r.doc_id is None for r in rows) == 1
    assert {(r.n_words, r.failed) for r in rows if r.doc_id in (3, 4)} == {(0, mask_of(["few_words"]))}
    assert rule_verdicts(no_docs).count() == 0 and ablations(ledger(no_docs)).count() == 0


def test_only_native_functions(spark, odd_docs):
    plan = rule_verdicts(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert set(BASE) <= set(POLICIES[CURRENT])
