"""Which sides of the corpus operators' joins may be broadcast."""

import random

from creditloom.llm import simhash


def test_fingerprint_pairs_are_shuffled_however_small_spark_takes_them_for(spark, tmp_path):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) - 2 ** 63 for _ in range(400)]
    prints += [p ^ (1 << rng.randrange(63)) for p in prints[:50]]
    spark.createDataFrame([(p,) for p in set(prints)], "fp bigint").write.parquet(str(tmp_path / "prints"))
    made = simhash.links(spark.read.parquet(str(tmp_path / "prints")))
    assert len(made.collect()) >= 50
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_the_pipeline_stage_broadcasts_no_fingerprint_keys(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    plans, links = [], simhash.links

    def watched(*args, **options):
        made = links(*args, **options)
        plans.append(made._jdf.queryExecution().executedPlan().toString())
        return made

    monkeypatch.setattr(simhash, "links", watched)
    rows = [(i, f"word{i} " + " ".join(f"w{(i * k) % 97}" for k in range(1, 30))) for i in range(60)] + [(100, None), (101, None)]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id int, text string"), "")
    assert 2 <= kept.count() <= 61 and plans and "Broadcast" not in plans[0]
