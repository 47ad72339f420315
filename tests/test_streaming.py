import math

from pyspark.sql import functions as F

from errlens.functions import month_key
from errlens.operators import evaluate as E
from errlens.operators import prep as P
from errlens.operators import train as TR
from errlens.operators import score as S
from errlens.plans import fixtures as fx
from errlens.session import scratch_path
from errlens.streaming import accuracy_stream, read_stream, score_stream, start


def test_stream_scoring_matches_batch(spark, sf_small):
    train, test = P.hash_split(fx.labelled(spark, sf_small), [], bucket_col="bucket")
    cfg = TR.ModelConfig(TR.GBT, depth=3, iters=5, max_bins=64)
    model = TR.train_pipeline(train, fx.SPEC, cfg, layout_keys=fx.LAYOUT_KEYS)

    schema = fx.table(spark, sf_small, "lineitem").schema
    li = read_stream(spark, f"{sf_small}/lineitem*.parquet", schema)
    obs = fx.obs_from_lineitem(li).withColumn("label", F.when(F.col("stress") <= 3, 0).otherwise(1))  # the hold-out rule
    held = P.holdout(obs, [], bucket_col="bucket")
    scored = score_stream(held, {"GBT": model}, keep=["day", "label"]).withColumn("month", month_key("day"))
    q = start(accuracy_stream(scored, ["model", "month"]), "acc_month", scratch_path(spark, "stream"), output_mode="complete")
    q.awaitTermination(120)
    got = {(r.model, r.month): (r.accuracy, r.samples) for r in spark.table("acc_month").collect()}
    q.stop()

    batch = S.score_pipelines(test, {"GBT": model}, keep=["day", "label"]).withColumn("month", month_key("day"))
    want = {(r.model, r.month): (r.accuracy, r.samples)
            for r in E.accuracy_by(batch, ["model", "month"], order=None).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert math.isclose(got[k][0], want[k][0], rel_tol=1e-12) and got[k][1] == want[k][1]
