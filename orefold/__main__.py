"""``spark-submit`` entry: build the tables from a landing folder and show row counts."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from .operators import audit
from .plans import batch
from .plans.incremental import Incremental
from .session import build_session


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="orefold")
    parser.add_argument("mode", choices=["batch", "incremental"])
    parser.add_argument("--landing", required=True, help="folder of the CSV files")
    parser.add_argument("--schema", required=True, help="schema that receives the tables")
    parser.add_argument("--checkpoints", help="folder for stream checkpoints (incremental)")
    parser.add_argument("--layout", choices=["files", "folders"], default="files")
    parser.add_argument("--check-rules", action="store_true", help="apply the rules (batch)")
    parser.add_argument("--cluster-by", help="lay enrollments out by this column (batch)")
    parser.add_argument("--shuffle-partitions", type=int)
    given = parser.parse_args(arguments)
    if given.mode == "incremental" and not given.checkpoints:
        parser.error("incremental needs --checkpoints")

    spark = build_session(shuffle_partitions=given.shuffle_partitions)
    if given.mode == "batch":
        layers = batch.run(
            spark, given.landing, given.schema, given.check_rules, given.cluster_by
        )
        counts = layers.row_counts()
        layers.rejections().show(truncate=False)
    else:
        flows = Incremental(
            spark, given.landing, given.schema, given.checkpoints, layout=given.layout
        )
        counts = audit.row_counts({"gold": flows.run()})
        spark.table(flows.table("rule_metrics")).show(truncate=False)
    counts.show(truncate=False)


if __name__ == "__main__":
    main()
