"""The pipeline's stages on their own inputs, against plain versions."""

import importlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from fieldgauge.llm import ranking, simhash
from tests.llm import plain

SF = "/root/testdata/sf0.001"
pipeline = importlib.import_module("corpus_pipeline")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "near_dedup", "decontamination", "source_mix"]
    read = lambda df: [(r.doc_id, r.text) for r in df.collect()]

    good = stages["quality"](spark, docs, SF).cache()
    scores = ranking.score(docs, ranking.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect()
    assert {i for i, _ in read(good)} == {r.doc_id for r in scores if r.predicted}

    deduped = stages["line_dedup"](spark, good, SF).cache()
    want = plain.lines(read(good))
    assert dict(read(deduped)) == {i: w[2] for i, w in want.items()}
    assert deduped.where(F.char_length("text") != F.col("n_chars")).count() == good.where(
        F.char_length("text") != F.col("n_chars")).count()

    single = stages["near_dedup"](spark, deduped, SF).cache()
    groups = plain.groups({i: plain.fingerprint(t) for i, t in read(deduped)})
    assert {i for i, _ in read(single)} == set(groups.values())

    clean = stages["decontamination"](spark, single, SF).cache()
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    verdict = plain.contamination(read(single), bench)
    assert {i for i, _ in read(clean)} == {i for i, v in verdict.items() if not v[3]}
    for df in (good, deduped, single, clean):
        assert df.columns == docs.columns

    mixed = stages["source_mix"](spark, clean, SF)
    assert {r.doc_id for r in mixed.collect()} <= {i for i, _ in read(clean)}
    assert mixed.columns == [*docs.columns, "copy"]


def test_quality_stage_learns_from_every_label(spark, tmp_path):
    """More than 10,000 good documents: the cut passes over the stated share of all of them."""
    deal = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(deal.choices(letters, k=deal.randint(1, 9)))
    good = [(i, " ".join(word() for _ in range(deal.randint(5, 30)))) for i in range(20_000)]
    rows = good + [(i, " ".join(["$$|"] * deal.randint(3, 20) + [word()])) for i in range(20_000, 20_300)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(i, int(i < 20_000), 0) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in dict(pipeline.STAGES)["quality"](spark, docs, str(tmp_path)).select("doc_id").collect()}
    learnt = [i for i, _ in good if zlib.crc32(str(i).encode()) % 5]
    assert len(learnt) > 15_000 and sum(i not in kept for i in learnt) == int(ranking.LOSS * len(learnt))
    assert not any(i >= 20_000 for i in kept)


def test_near_dedup_stage_steers_by_every_fingerprint(frame, spark, monkeypatch):
    """The parts and thresholds that are probed follow from all 3,000 fingerprints."""
    deal = random.Random(9)
    rows = [(i, " ".join(f"w{deal.randrange(500)}" for _ in range(deal.randint(4, 40))), "a") for i in range(3_000)]
    plans, allocate = [], simhash.allocate

    def told(*given):
        plans.append(allocate(*given))
        return plans[-1]

    monkeypatch.setattr(simhash, "allocate", told)
    kept = dict(pipeline.STAGES)["near_dedup"](spark, frame(rows), SF)
    prints = {i: plain.fingerprint(t) for i, t, _ in rows}
    every = np.array(sorted(set(prints.values())), np.uint64)
    assert len(every) > 2_900 and plans == [allocate(every, len(every))]
    assert {r.doc_id for r in kept.select("doc_id").collect()} == set(plain.groups(prints).values())


def test_run_is_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {n.split("_")[0] + "_" for n in names if n.startswith("op")}
    assert names["pipeline"] is pipeline.run and pipeline.run(spark, SF).count() > 0
