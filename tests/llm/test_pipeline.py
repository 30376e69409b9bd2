"""The pipeline against plain Python, stage by stage: each stage is judged on what the one before it kept."""

import math
import os
import zlib

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_jaccard_join import brute
from tokenizers import Tokenizer

from wordloom.session import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES:
        docs.append(stage(step(spark, docs[-1], SF), f"test_{name}"))
    return docs


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_columns_stay(steps):
    assert all(df.columns == steps[0].columns for df in steps[:-1])


def test_language_keeps_what_is_like_the_training_rows(steps):
    """By hand: the likeness of each text, cut at as far below the 1 % quantile as the median lies above it, per band of length."""
    from wordloom.llm.langid import likeness_cuts, train_identifier

    identifier = train_identifier(steps[0])
    cuts = likeness_cuts(steps[0], identifier)
    rows = steps[0].collect()
    train = [r.text for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None and r.text is not None]
    scores = sorted(int(1000 * s) for name, s in zip(*identifier.predict(train), strict=True) if name != "und")
    rank = lambda share: scores[max(0, math.ceil(share * len(scores)) - 1)]
    assert cuts == [max(0, 2 * rank(0.01) - rank(0.5)) / 1000] * len(cuts)  # too few rows for a cut of any band
    langs, likeness = identifier.predict([r.text or "" for r in rows])
    assert ids(steps[1]) == sorted(r.doc_id for r, name, s in zip(rows, langs, likeness, strict=True) if name != "und" and s >= cuts[0])


def test_quality_parts_the_labels(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = ids(steps[1]), set(ids(steps[2]))
    good = [i for i in before if labels.get(i) == 1]
    bad = [i for i in before if labels.get(i) == 0]
    assert all(i in after for i in good)
    assert sum(i in after for i in bad) <= 0.2 * len(bad)


def test_one_of_each_group_stays(steps):
    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    component, _ = brute(rows, 5, 4, 5)
    assert ids(steps[3]) == sorted({c for c in component.values()})


def test_all_tokens_are_packed(steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in steps[3].collect()}
    packed = steps[4].groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {r[0]: r[1] for r in packed} == lengths
    fill = steps[4].groupBy("bin_id").agg({"length": "sum", "capacity": "max"}).collect()
    assert all(r["sum(length)"] <= r["max(capacity)"] for r in fill)


def test_odd_rows_pass_every_stage(spark, steps):
    """Null ids and texts, repeated rows and clashing names beside real documents; and no document at all."""
    odd = steps[0].limit(150).unionByName(spark.createDataFrame(
        [(None, None, None, None, None), (None, "", "en", "a", 0), (7, None, "en", "a", None), (7, None, "en", "a", None)], steps[0].schema
    ))
    odd = odd.select("*", F.lit(1.0), F.lit("x")).toDF(*steps[0].columns, "score", "Text")
    for docs in (odd, odd.limit(0)):
        kept = docs
        for name, step in corpus_pipeline.STAGES:
            kept = step(spark, kept, SF)
            if name != "packing":
                assert kept.columns == odd.columns
            kept = kept.cache()
            kept.count()
        assert docs is odd or kept.count() == 0


def test_run_is_the_stages(spark, steps):
    out = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, out.select("doc_id", "piece", "length").collect())) == sorted(map(tuple, steps[4].select("doc_id", "piece", "length").collect()))


ITALIAN = (
    "La città si trova sulle rive del fiume e ha una lunga storia che comincia con i romani. Oggi molti abitanti lavorano nelle fabbriche "
    "della regione, mentre altri preferiscono la campagna, dove si producono vino e olio. Ogni anno migliaia di visitatori arrivano. "
)
TURKISH = (
    "Şehir nehrin kıyısında yer alır ve Romalılarla başlayan uzun bir tarihe sahiptir. Bugün birçok insan bölgedeki fabrikalarda çalışıyor, "
    "diğerleri ise şarap ve zeytinyağı üretilen kırsal bölgeyi tercih ediyor. Her yıl binlerce ziyaretçi eski kiliseleri görmek için geliyor. "
)


def test_language_rejects_junk_and_foreign_texts(spark):
    import random

    sf = "/root/testdata/sf0.1"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    rng = random.Random(3)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    real = [r.text for r in docs.filter("n_chars > 600").orderBy("doc_id").limit(60).collect()]
    letters = "abcdefghijklmnopqrstuvwxyz     "
    planted = {-1: ITALIAN, -2: TURKISH, -3: ITALIAN * 8, -4: TURKISH * 8}
    planted |= {-100 - i: "".join(rng.sample(t, len(t))) for i, t in enumerate(real)}
    planted |= {-200 - i: "".join(rng.choice("asdfghjkl ") for _ in range(300)) for i in range(60)}
    planted |= {-300 - i: "".join(rng.choice(letters) for _ in range(300)) for i in range(60)}
    rows = [(i, t, None, "planted", len(t)) for i, t in planted.items()]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    both = docs.select(*names).unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    kept = ids(corpus_pipeline.known_language(spark, both, sf))
    assert [i for i in kept if i < 0] == []
    assert len(kept) >= 0.999 * docs.count()
