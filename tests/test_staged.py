"""Staged grids: prefixes equal separate fits, the choice reads the validation part only."""

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from errlens.operators import prep as P
from errlens.operators import staged as SG
from errlens.operators import train as TR
from errlens.operators.features import FeatureSpec
from errlens.plans import fixtures as fx
from errlens.plans.oracle import ORACLE
from errlens.plans.queries import QUERIES
from errlens.sources import models as MD

SPEC = FeatureSpec(numeric=("f1", "f2", "f3", "f4"), categorical=("race",))


@pytest.fixture(scope="module")
def parts(spark, sf_small):
    rows = fx.noisy(spark, sf_small, 0.2)
    train, validation, test = P.hash_split(rows, [], fx.THREE_PARTS, bucket_col="bucket")
    prepared = TR.prepare(train, SPEC, layout_keys=fx.LAYOUT_KEYS, layout_partitions=4)
    yield prepared, train, validation, test
    prepared.unpersist()


def test_prefixes_equal_separate_fits(spark, parts):
    prepared, train, validation, test = parts
    configs = [*TR.gbt_grid((2, 4), (3, 7, 12), max_bins=64), *TR.rf_grid((5,), (3,), max_bins=64)]
    found = SG.staged_grid(train, validation, test, SPEC, configs, prepared=prepared)
    assert found.fits == 3                                        # one per depth, and the forest
    separate = TR.run_grid(train, validation, SPEC, configs, prepared=prepared)
    got = {r["params"]: r for r in found.table.collect()}
    want = {r["params"]: r["accuracy"] for r in separate.collect()}
    assert {k: r["accuracy"] for k, r in got.items()} == want
    assert len({want[f"Depth:4, Iter:{i}"] for i in (3, 7, 12)}) > 1
    chosen = [r for r in got.values() if r["chosen"]]
    assert len(chosen) == 1 and chosen[0]["accuracy"] == max(want.values())
    at_test = TR.run_grid(train, test, SPEC, [found.config], prepared=prepared).first()["accuracy"]
    assert chosen[0]["test_accuracy"] == at_test
    assert all(r["test_accuracy"] is None for r in got.values() if not r["chosen"])


def test_prefix_scores_like_the_shorter_fit_and_can_be_saved(spark, parts, tmp_path):
    prepared, _, validation, _ = parts
    long = TR.fit_classifier(prepared, TR.ModelConfig(TR.GBT, depth=3, iters=9, max_bins=64))
    short = TR.fit_classifier(prepared, TR.ModelConfig(TR.GBT, depth=3, iters=4, max_bins=64))
    MD.save_pipeline(TR.full_pipeline(prepared, SG.prefix(long, 4)), str(tmp_path / "p"))
    model = MD.load_pipeline(str(tmp_path / "p"))

    def scores(m):
        return sorted(map(tuple, m.transform(validation).select("uid", "day", "f2", "prediction", vector_to_array("probability").cast("string")).collect()))

    assert scores(model) == scores(TR.full_pipeline(prepared, short)) != scores(TR.full_pipeline(prepared, long))
    rows, margins = SG.stage_margins(prepared.features(validation), long, [9, 4, 4], SPEC.scaled_col, "_m")
    signs = short.transform(rows).agg(F.count_if((margins[4] > 0) != (F.col("prediction") == 1)).alias("x")).first()["x"]
    assert signs == 0 and list(margins) == [4, 9]
    for bad in (0, 10):
        with pytest.raises(ValueError):
            SG.prefix(long, bad)
        with pytest.raises(ValueError):
            SG.stage_margins(rows, long, [bad], SPEC.scaled_col, "_m")


def test_ties_go_to_the_smaller_model(spark, parts):
    prepared, train, validation, test = parts
    same = fx.labelled(spark, "/root/testdata/sf0.001").withColumn("label", F.lit(1))
    a, b, c = P.hash_split(same, [], fx.THREE_PARTS, bucket_col="bucket")
    found = SG.staged_grid(a, b, c, SPEC, TR.gbt_grid((3, 2), (4, 2)), layout_keys=fx.LAYOUT_KEYS, layout_partitions=2)
    assert (found.config.depth, found.config.iters) == (2, 2) and found.fits == 2


def test_empty_parts_are_errors(parts):
    prepared, train, validation, test = parts
    grid = TR.gbt_grid((1,), (1,))
    for v, t in ((validation.limit(0), test), (validation, test.limit(0))):
        with pytest.raises(ValueError):
            SG.staged_grid(train, v, t, SPEC, grid, prepared=prepared)
    with pytest.raises(ValueError):
        SG.staged_grid(train, validation, test, SPEC, [], prepared=prepared)


def test_query_matches_sql_and_accuracies_differ(spark, sf_small):
    df = QUERIES["staged_grid"](spark, sf_small)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{sf_small}/lineitem.parquet')")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE['staged_grid']})").fetchall()
    got = list(map(tuple, df.collect()))
    assert sorted(got) == sorted(want)
    assert len({r[3] for r in got}) == 3
