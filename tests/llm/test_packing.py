import random

import numpy as np
import pytest

from wordloom.llm.packing import bin_cost, best_fit, downsize, pack_documents, pack_lengths

SIZES = (8, 16, 32)


def brute_best_fit(lengths, open_at):
    bins = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [(room - lengths[i], k) for k, (room, _) in enumerate(bins) if room >= lengths[i]]
        if fits:
            left, k = min(fits)
            bins[k] = (left, bins[k][1] + [i])
        else:
            size = min(c for c in SIZES if c >= max(open_at, lengths[i]))
            bins.append((size - lengths[i], [i]))
    return [b for _, b in bins]


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_against_a_plain_search(seed):
    rng = random.Random(seed)
    lengths = np.array([rng.randrange(1, 33) for _ in range(60)])
    for open_at in SIZES:
        assert best_fit(lengths, open_at, SIZES) == brute_best_fit(lengths.tolist(), open_at)
    costs = [sum(bin_cost(downsize(int(lengths[b].sum()), SIZES)) for b in best_fit(lengths, c, SIZES)) for c in SIZES]
    assert sum(bin_cost(c) for c, _ in pack_lengths(lengths, SIZES)) == min(costs)


def check(packed, lengths, sizes):
    """Every token of every row in one place, no overlap, each bin as small as its contents allow."""
    bins, seen = {}, {}
    for r in packed.collect():
        bins.setdefault(r.bin_id, []).append(r)
        seen.setdefault(r.doc_id, []).append(r.length)
    assert {k: sum(v) for k, v in seen.items()} == lengths
    for rows in bins.values():
        rows.sort(key=lambda r: r.offset)
        at = 0
        for r in rows:
            assert r.offset == at
            at += r.length
        assert {r.capacity for r in rows} == {min(c for c in sizes if c >= at)}


def test_documents(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.choice([0, 3, 7, 7, 20, 31, 32, 70])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(pack_documents(docs, SIZES, shard_rows=50), {i: len(t.split()) + 1 for i, t in rows}, SIZES)


def test_odd_rows(odd_docs, no_docs):
    packed = pack_documents(odd_docs, SIZES)
    assert packed.filter("doc_id = 1").count() == 2
    assert packed.filter("doc_id in (3, 4, 5)").filter("length = 1").count() == 2
    assert packed.filter("doc_id is null").count() == 1
    assert packed.filter("doc_id = 7").agg({"length": "sum"}).first()[0] == 27001
    assert pack_documents(no_docs, SIZES).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_every_bin_has_its_own_opening_size(seed):
    from wordloom.llm.packing import open_by_cost, pack_pieces

    rng = random.Random(seed)
    lengths = np.array([rng.randrange(1, 33) for _ in range(60)])
    for pack in (open_by_cost, pack_pieces):
        bins = pack(lengths, SIZES)
        assert sorted(p for _, b in bins for p in b) == list(range(60))
        assert all(c == downsize(int(lengths[b].sum()), SIZES) for c, b in bins)

    def cost(found):
        return sum(bin_cost(c) for c, _ in found)

    assert cost(pack_pieces(lengths, SIZES)) == min(cost(open_by_cost(lengths, SIZES)), cost(pack_lengths(lengths, SIZES)))


def test_the_query_packs_tokens(spark):
    import os

    import public_tokenizers

    from wordloom.llm.queries import op8_packing
    from wordloom.llm.token_count import token_counts

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    counts = token_counts(spark.read.parquet(f"{sf}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json")).collect()
    check(op8_packing(spark, sf), {r.doc_id: r.n_tokens + 1 for r in counts}, (512, 1024, 2048, 4096))


def test_a_text_without_spaces_is_cut_by_a_given_length(spark):
    docs = spark.createDataFrame([(1, "x" * 90, 70), (2, None, None), (3, "a b", 2)], "doc_id long, text string, tokens long")
    check(pack_documents(docs, SIZES, length="tokens"), {1: 71, 2: 1, 3: 3}, SIZES)
