"""The pipeline's stages against brute force, each on what its predecessor kept."""

import corpus_pipeline
from helpers import awkward, frame
from test_decontaminate import brute as leaks
from test_quality_rules import brute as counts
from test_sharding import brute as shards
from test_simhash import brute as components

from edgeloom.llm import mixing
from edgeloom.llm.tables import table, written


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = (docs, docs := written(stage(spark, docs, sf_dir), "test"))
        if name != "shards":
            assert docs.columns == columns
    before, after = kept["quality"]
    stays = {d for d, _ in texts(after)}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect()}
    for d, text in texts(before):
        if counts(text)[5]:
            assert d not in stays
        elif labels.get(d) == 1:
            assert d in stays
    before, after = kept["near_dedup"]
    assert {d for d, _ in texts(after)} == {c for *_, c in components(texts(before))}
    before, after = kept["decontamination"]
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    leaking = {d for d, *_ in leaks(texts(before), items)}
    assert leaking and {d for d, _ in texts(after)} == {d for d, _ in texts(before)} - leaking
    before, after = kept["mix"]
    drawn = {r["doc_id"] for r in mixing.mix_report(before, mixing.SLACK).where("mix_sampled").collect()}
    assert {d for d, _ in texts(after)} == drawn and len(drawn) > 0.3 * before.count()
    before, after = kept["shards"]
    dealt = {r["doc_id"]: (r["shard"], r["slot"]) for r in after.collect()}
    assert dealt == {d: (s, slot) for d, _, _, _, s, slot, _ in shards(texts(before), 8)}
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, after.collect()), key=repr)


def test_stages_take_awkward_and_no_documents(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    for rows in (awkward(), []):
        docs = frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, sf_dir), "test")
        assert docs.columns[-2:] == ["shard", "slot"]
