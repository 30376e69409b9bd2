import os

from pyspark.sql import functions as F

from wordloom.plans import network
from wordloom.session import CLEANUP, discard, lasting, passing, shared_dir, stage


def staged_tables(spark):
    top = f"{shared_dir(spark)}/wordloom"
    return {x for x in os.listdir(top)} if os.path.isdir(top) else set()


def test_staged_tables_go_with_their_scope(spark):
    before = staged_tables(spark)
    with passing():
        stage(spark.range(3), "gone")
        kept = stage(spark.range(4), "kept", keep=True)
        with passing():
            inner = stage(spark.range(5), "inner", keep=True)
            with lasting():
                alone = stage(spark.range(6), "alone")
        assert inner.count() == 5
    names = sorted(x.rsplit("-", 1)[0] for x in staged_tables(spark) - before)
    assert names == ["alone", "kept"] and (kept.count(), alone.count()) == (4, 6)
    for df in (kept, alone, alone):
        discard(df)
    assert staged_tables(spark) == before


def test_shuffle_files_go_when_a_step_is_written(spark, monkeypatch):
    seen, write = [], type(spark.range(0).write).parquet

    def noted(self, path):
        seen.append(spark.conf.get(CLEANUP))
        write(self, path)

    monkeypatch.setattr(type(spark.range(0).write), "parquet", noted)
    assert stage(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "counted").count() == 7
    assert seen == ["true"] and spark.conf.get(CLEANUP) == "false"


def test_building_the_classes_leaves_only_what_it_returns(spark):
    texts = [(i, "automatable", " ".join(f"word{(i + k) % 9}" for k in range(5))) for i in range(30)]
    before = staged_tables(spark)
    ranked, columns = network.keyword_classes(spark.createDataFrame(texts, "doc_id bigint, category string, text string"))
    names = sorted(x.rsplit("-", 1)[0] for x in staged_tables(spark) - before)
    assert names == ["class-links", "class-sizes", "keywords", "members"]
    assert ranked.count() == columns.members.count() == 9
