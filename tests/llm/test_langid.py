from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from wordloom.llm.langid import LETTER_BITS, Identifier, count_ngrams, keep_known, predict_languages, train_identifier

SF = "/root/testdata/sf0.001"


def brute_ngrams(text):
    counts = Counter()
    word = ""
    for c in text.lower() + " ":
        if c.isalpha() and ord(c) < 1 << LETTER_BITS:
            word += c
            continue
        if word:
            padded = " " + word + " "
            counts.update(word)
            counts.update(padded[i : i + 2] for i in range(len(padded) - 1))
            counts.update(padded[i : i + 3] for i in range(len(padded) - 2))
        word = ""
    return counts


def code_of(gram):
    code = len(gram)
    for c in ([" "] * (3 - len(gram))) + list(gram):
        code = (code << LETTER_BITS) | (0 if c == " " else ord(c))
    return code


def as_dict(texts):
    found = {}
    for group, code, n in zip(*(x.tolist() for x in count_ngrams(texts, np.arange(len(texts))))):
        found[group, code] = n
    return found


def test_ngram_counts():
    texts = ["The cat, the CAT!", "", "a", "1 2 3", "ÉTÉ été\n日本 x", "İz", "ab" * 50]
    want = {(i, code_of(g)): n for i, t in enumerate(texts) for g, n in brute_ngrams(t).items()}
    assert as_dict(texts) == want


def test_prediction_is_the_out_of_place_distance(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    identifier = train_identifier(docs)
    train = docs.filter((F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2) & F.col("lang").isNotNull()).collect()
    sums = {}
    for r in train:
        sums.setdefault(r.lang, Counter()).update(brute_ngrams(r.text or ""))
    places = {
        lang: {code_of(g): k for k, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], code_of(x[0])))[:300])} for lang, c in sums.items()
    }
    for r in docs.limit(40).collect():
        top = sorted(brute_ngrams(r.text).items(), key=lambda x: (-x[1], code_of(x[0])))[:300]
        apart = {lang: sum(abs(p[code_of(g)] - k) if code_of(g) in p else 300 for k, (g, _) in enumerate(top)) for lang, p in places.items()}
        best = min(sorted(apart), key=apart.get)
        lang, score = (x[0] for x in identifier.predict([r.text]))
        assert lang == best and abs(score - (1 - apart[best] / (300 * len(top)))) < 1e-12


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    told = predict_languages(docs, train_identifier(docs)).join(docs, "doc_id").filter("held_out")
    assert told.filter("lang_pred = lang").count() >= 0.97 * told.count() > 0


def test_odd_rows(odd_docs, no_docs):
    identifier = train_identifier(odd_docs)
    rows = predict_languages(odd_docs, identifier).collect()
    assert len(rows) == odd_docs.count()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {3, 4, 5}
    assert all(0 <= r.score <= 1 and (r.score == 0 or r.lang_pred != "und") for r in rows)
    kept = keep_known(odd_docs, identifier, 0.0)
    assert kept.columns == odd_docs.columns and kept.count() == 6
    assert predict_languages(no_docs, train_identifier(no_docs)).count() == 0
    assert Identifier([], 300).predict(["some text"]) == (["und"], [0.0])
