import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from wordloom.llm.spelling import counted_words, near_words, one_inserted, roots, spelling_variants, upper_trees

KINDS = "doc_id long, text string"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words_by_hand(rows):
    n = Counter()
    for id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(n):
    beside = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n[w], form[w], n[form[w]] if form[w] else None, len(beside[w]), root))
    return sorted(out)


def vocabulary(seed, size=400):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abeé×") for _ in range(rng.randrange(5, 9))) for _ in range(size // 4)]
    out = set(base)
    while len(out) < size:
        w = rng.choice(base)
        at = rng.randrange(len(w))
        out.add(rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abcÿ") + w[at:], w[:at] + rng.choice("abcÿ") + w[at + 1 :], "".join(rng.sample(w, len(w)))]))
    return {w: rng.choice([3, 3, 4, 6, 12, 25, 50]) for w in sorted(out) if len(w) >= 5}


@pytest.mark.parametrize("seed,cell", [(1, 20_000), (2, 30), (3, 1)])
def test_all_pairs_one_edit_apart_are_found(spark, seed, cell):
    n = vocabulary(seed)
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    got = sorted((r.word, r.near, r.near_n) for r in near_words(words, cell).collect())
    assert got == sorted((a, b, n[b]) for a in n for b in n if near(a, b))


def test_cells_are_bounded_but_for_equal_vectors(spark):
    words = spark.createDataFrame([(w, 3) for w in vocabulary(4, 600)] + [("".join(p), 3) for p in {tuple(np.random.default_rng(i).permutation(list("abcdefg"))) for i in range(300)}], "word string, n long")
    words = words.dropDuplicates(["word"])
    trees = upper_trees(words, 25)
    from wordloom.llm.spelling import count_vectors, letter_matrix, own_cells

    held = {}
    for r in words.collect():
        vector = count_vectors(letter_matrix([r.word]))
        held.setdefault(int(own_cells(trees[len(r.word)], vector)[0]), []).append(tuple(vector[0]))
    assert all(len(v) <= 25 or len(set(v)) == 1 for v in held.values())


def test_one_inserted():
    pairs = [("abcde", "abcdex"), ("abcde", "xabcde"), ("aaaaa", "aaaaaa"), ("abcde", "abxcde"), ("abcde", "abxcdf"), ("abcde", "edcbax")]
    left = np.array([list(a.encode()) for a, _ in pairs], np.uint8)
    right = np.array([list(b.encode()) for _, b in pairs], np.uint8)
    assert one_inserted(left, right).tolist() == [True, True, True, True, False, False]


def test_words_and_forms_are_those_found_by_hand(spark):
    rng = random.Random(8)
    listed = list(vocabulary(6, 150))
    rows = [(rng.choice([None, i]), " ".join(rng.choice([w, w.upper(), w.capitalize()]) + rng.choice(["", ",", "1", "-x"]) for w in rng.choices(listed, range(1, len(listed) + 1), k=120))) for i in range(60)]
    rows += [(1, None), (2, ""), (3, "12 34"), (4, "Aßbcdé" * 500 + " Ünder ünder Ünder")]
    docs = spark.createDataFrame(rows, KINDS)
    n = words_by_hand(rows)
    assert {r.word: r.n for r in counted_words(docs).collect()} == n
    got = spelling_variants(docs, cell_words=20).select("word", "n", "form", "form_n", "n_near", "root").collect()
    assert sorted(map(tuple, got)) == brute(n) and any(r.form for r in got)


def test_roots_of_long_chains(spark):
    chain = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(40)] + [("x", "w20")]
    got = {r.word: r.root for r in roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {a: "w40" for a, _ in chain}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r[0], r[1]) for r in odd_docs.collect()]
    got = spelling_variants(odd_docs).select("word", "n", "form", "form_n", "n_near", "root").collect()
    assert sorted(map(tuple, got)) == brute(words_by_hand(rows)) and got
    assert spelling_variants(no_docs).count() == 0
