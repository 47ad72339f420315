"""Command line: ``python -m errlens {train,inference,experiments,tune} ...``.

Input is the observation CSV (headed; columns are matched by name).  Paths
may be any Hadoop-supported URI (``hdfs://``, ``s3a://``, local).
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from errlens.plans import workflows as W
from errlens.session import get_session
from errlens.sources import readers as RD


def _read(spark, a):
    return RD.read_csv(spark, a.input, schema=None if a.infer_schema else RD.OBSERVATION_SCHEMA, infer=a.infer_schema, mode=a.mode)


def _show_all(df) -> None:
    """Every row of a small report table."""
    df.show(max(1, df.count()), truncate=False)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="errlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("train", "inference", "experiments", "tune"):
        p = sub.add_parser(name)
        p.add_argument("--input", required=True)
        p.add_argument("--infer-schema", action="store_true")
        p.add_argument("--seed", type=int, default=42)
        p.add_argument("--master", default=None, help="left to spark-submit unless given")
        p.add_argument("--mode", choices=("FAILFAST", "PERMISSIVE", "DROPMALFORMED"), default="FAILFAST",
                       help="what a cell that does not parse does: end the job, become null, drop its row")
        p.add_argument("--null-features", choices=("error", "skip", "keep"), default="error",
                       help="rows with a null numeric feature: end the job, leave the row out, or score it as NaN")
    for name in ("train", "experiments", "tune"):
        sub.choices[name].add_argument("--reliable-input", action="store_true",
                                       help="write the model input to spark.checkpoint.dir before fitting")
        sub.choices[name].add_argument("--layout-partitions", type=int, default=None,
                                       help="partitions of the training layout; part of what makes a fit reproducible")
        sub.choices[name].add_argument("--unique-rows", action="store_true",
                                       help="no user-day occurs twice: the layout needs one shuffle, not two")
    sub.choices["train"].add_argument("--models", required=True)
    sub.choices["inference"].add_argument("--models", required=True)
    sub.choices["inference"].add_argument("--out", required=True)
    sub.choices["inference"].add_argument("--no-split-check", action="store_true",
                                          help="do not compare the hold-out with the rows that were trained on")
    for name in ("inference", "experiments"):
        sub.choices[name].add_argument("--partitions", type=int, default=None,
                                       help="spread the scored rows over this many tasks before scoring")
    for name in ("experiments", "tune"):
        sub.choices[name].add_argument("--out", required=True)
        sub.choices[name].add_argument("--sample", type=float, default=None,
                                       help="share of rows taken first (default 0.3; with --large all rows)")
        sub.choices[name].add_argument("--large", action="store_true", help="the 3x3 grids on all rows")
    sub.choices["tune"].add_argument("--models", default=None, help="folder for the chosen pipeline")
    a = ap.parse_args(argv)

    spark = get_session(master=a.master)
    df = _read(spark, a)
    spec = replace(W.OBSERVATION_SPEC, assemble_invalid=a.null_features)
    if a.cmd == "train":
        res = W.train(df, a.models, spec=spec, seed=a.seed, reliable_input=a.reliable_input,
                      layout_partitions=a.layout_partitions, unique_rows=a.unique_rows)
        _show_all(res["accuracy"])
    elif a.cmd == "inference":
        saved = None if a.no_split_check else W.load_fingerprint(spark, a.models)
        tables = W.inference(df, W.load_models(a.models), a.out, spec=spec, seed=a.seed, partitions=a.partitions, fingerprint=saved)
        for name in ("accuracy", "by_month", "worst_users", "by_category"):
            _show_all(tables[name])
        W.release(tables)
    else:
        from errlens.operators import train as TR
        rf = TR.rf_grid(**TR.LARGE_RF) if a.large else TR.rf_grid()
        gbt = TR.gbt_grid(**TR.LARGE_GBT) if a.large else TR.gbt_grid()
        sample = a.sample if a.sample is not None else (1.0 if a.large else 0.3)
        if a.cmd == "tune":
            _show_all(W.tune(df, spec=spec, configs=[*rf, *gbt], sample_fraction=sample, seed=a.seed, model_dir=a.models, out_csv=a.out,
                             reliable_input=a.reliable_input, layout_partitions=a.layout_partitions, unique_rows=a.unique_rows).table)
            return
        _show_all(W.experiments(df, spec=spec, rf=rf, gbt=gbt, sample_fraction=sample, seed=a.seed, out_csv=a.out,
                                reliable_input=a.reliable_input, partitions=a.partitions,
                                layout_partitions=a.layout_partitions, unique_rows=a.unique_rows))


if __name__ == "__main__":
    main()
