"""Command line for the three jobs.

    python -m voxpop clean  <file.json|file.bz2> <out_dir>
    python -m voxpop train  --labels L.csv --comments C.json.bz2 --model DIR [--folds 5]
    python -m voxpop report --comments C.json.bz2 --submissions S.json.bz2 --model DIR --out DIR
                            [--sample 0.2] [--exclude-day 20181231] [--regions R.txt [--exclude-region NAME]
                            [--map-value NAME=0.3] [--approval-value NAME=0.31]]

On a cluster submit it with ``spark-submit -m voxpop ...`` or wrap it in a job;
the session comes from ``SparkSession.builder.getOrCreate()`` so cluster
settings (master, checkpoint folder, shuffle partitions) are taken as given.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from voxpop.session import CLUSTER_SQL_CONF, apply_cluster_conf


def _session() -> SparkSession:
    # No web UI: batch jobs report through logs / the event log instead.
    spark = SparkSession.builder.appName("voxpop").config("spark.ui.enabled", "false").getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        # What spark-submit sets itself is kept.
        given = dict(spark.sparkContext.getConf().getAll())
        apply_cluster_conf(spark, {k: given[k] for k in CLUSTER_SQL_CONF if k in given})
    return spark


def _named(given: str) -> tuple[str, float]:
    name, _, value = given.rpartition("=")
    return name, float(value)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="voxpop")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean", help="clean a JSON-lines file of comments")
    c.add_argument("file")
    c.add_argument("out")
    t = sub.add_parser("train", help="fit vocabulary + positive/negative models")
    t.add_argument("--labels", required=True)
    t.add_argument("--comments", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--folds", type=int, default=5)
    r = sub.add_parser("report", help="score comments and write the sentiment reports")
    r.add_argument("--comments", required=True)
    r.add_argument("--submissions", required=True)
    r.add_argument("--model", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--sample", type=float, default=None)
    r.add_argument("--exclude-day", type=int, action="append", help="a day (yyyyMMdd) left out of the dated series")
    r.add_argument("--regions", help="text file of region names, one a line, for the map tables")
    r.add_argument("--exclude-region", action="append", help="a region left off the maps")
    r.add_argument("--map-value", type=_named, action="append", default=[], help="NAME=SHARE set by hand on the positive map")
    r.add_argument("--approval-value", type=_named, action="append", default=[], help="NAME=SHARE set by hand in the approval ratio")
    args = ap.parse_args(argv)

    spark = _session()
    if args.cmd == "clean":
        from voxpop.sources import readers

        readers.clean_json_file(spark, args.file, quarantine=f"{args.out.rstrip('/')}_malformed").write.mode("overwrite").json(args.out)
    elif args.cmd == "train":
        from voxpop.plans import train

        train.run(spark, args.labels, args.comments, args.model, folds=args.folds)
    else:
        from voxpop.plans import report

        report.run(
            spark, args.comments, args.submissions, args.model, args.out, sample_fraction=args.sample,
            exclude_days=args.exclude_day, regions_path=args.regions, exclude_regions=args.exclude_region,
            map_overrides=dict(args.map_value), approval_overrides=dict(args.approval_value),
        )


if __name__ == "__main__":
    main()
