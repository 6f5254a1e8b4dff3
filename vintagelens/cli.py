"""Command line: one subcommand per pipeline.

    python -m vintagelens.cli label-store --feed data/lms_loan_daily.csv --start 2023-01-01 --end 2024-12-01
    python -m vintagelens.cli train --snapshotdate 2024-09-01
    python -m vintagelens.cli score --snapshotdate 2024-09-01 --modelname credit_model_2024_09_01
    python -m vintagelens.cli monitor --snapshotdate 2024-10-01 --modelname credit_model_2024_09_01

``--end`` turns a single snapshot into a backfill over the period. A failure raises, so the
exit status is not 0.
"""

from __future__ import annotations

import argparse

from vintagelens.operators.modelling import DRAWS
from vintagelens.plans import backfill, feature_store, history, label_store, monitoring, scoring, training
from vintagelens.plans.datamart import FEATURE_FEEDS, Datamart
from vintagelens.schemas import LABEL_DEFINITION
from vintagelens.session import build_session
from vintagelens.sources.feeds import read_feed


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="vintagelens")
    top.add_argument("--datamart", default="datamart", help="root folder of the tables")
    top.add_argument("--master", help="Spark master, if not given by spark-submit")
    commands = top.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("bronze-loans", help="ingest the loan feed only")
    labels = commands.add_parser("label-store", help="loan feed to label store")
    for command in (ingest, labels):
        command.add_argument("--feed", default="data/lms_loan_daily.csv")
        command.add_argument("--quarantine", action="store_true", help="rows that do not parse go to a side table")
        _period(command)
    labels.add_argument("--resume", action="store_true", help="only snapshots that are not done, or whose input has changed")
    labels.add_argument("--dpd", type=int, default=30)
    labels.add_argument("--mob", type=int, default=6)

    store = commands.add_parser("feature-store", help="raw feature feeds to feature store")
    for feed in FEATURE_FEEDS:
        store.add_argument(f"--{feed}", required=True)
    _period(store)

    fill = commands.add_parser("fill", help="model features of a period, filled forward from the state before it")
    _period(fill)

    train = commands.add_parser("train", help="search, report and register a model")
    train.add_argument("--snapshotdate", required=True)
    train.add_argument("--modelname")
    train.add_argument("--source", choices=["risk", "clickstream"], default="risk")
    train.add_argument("--draws", type=int, default=DRAWS)
    train.add_argument("--metric", choices=["auc", "auc_hard"], default="auc")
    train.add_argument("--fill", choices=["both", "forward"], default="both")
    train.add_argument("--firstsnapshot", help="first snapshot of the history; by default the first there is")
    train.add_argument("--parallelism", type=int, help="boosting runs that go at the same time; as many as fill the cluster by default")

    train.add_argument("--labeldef", default=LABEL_DEFINITION)

    for name, text in (("score", "score snapshots"), ("monitor", "report drift and quality")):
        command = commands.add_parser(name, help=text)
        command.add_argument("--snapshotdate", required=True)
        command.add_argument("--end")
        command.add_argument("--modelname", required=True)
        if name == "score":
            command.add_argument("--source", choices=["risk", "clickstream"], default="risk")
        else:
            command.add_argument("--labeldef", default=LABEL_DEFINITION)
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = build_session(master=a.master)
    mart = Datamart(a.datamart)
    if a.command == "bronze-loans":
        label_store.ingest_loans(spark, a.feed, mart, a.start, a.end or a.start, a.quarantine)
    elif a.command == "label-store" and a.resume:
        done = backfill.run(read_feed(spark, a.feed), mart, a.start, a.end or a.start, a.dpd, a.mob)
        print("\n".join(f"{stage}: {', '.join(map(str, days)) or 'nothing to do'}" for stage, days in done.items()))
    elif a.command == "label-store":
        label_store.run(spark, a.feed, mart, a.start, a.end or a.start, a.dpd, a.mob, a.quarantine).show()
    elif a.command == "feature-store":
        feeds = {feed: getattr(a, feed) for feed in FEATURE_FEEDS}
        feature_store.run(spark, feeds, mart, a.start, a.end or a.start).show(5)
    elif a.command == "fill":
        history.run(spark, mart, a.start, a.end).show(5)
    elif a.command == "train":
        trained = training.run(
            spark, mart, a.snapshotdate, a.modelname, a.source, draws=a.draws, metric=a.metric, direction=a.fill,
            first_snapshot=a.firstsnapshot, label_def=a.labeldef, parallelism=a.parallelism,
        )
        trained.report.show()
    elif a.command == "score":
        scoring.run(spark, mart, a.modelname, a.snapshotdate, a.end, a.source).show()
    else:
        monitoring.run(spark, mart, a.modelname, a.snapshotdate, a.end, a.labeldef).show()


def _period(command: argparse.ArgumentParser) -> None:
    command.add_argument("--start", required=True)
    command.add_argument("--end")


if __name__ == "__main__":
    main()
