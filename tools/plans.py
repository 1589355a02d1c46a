"""Write PLANS.md: the physical shape of every registered query.

Plans are taken with broadcast joins and AQE off, i.e. the sort-merge plans
that a large cluster runs when no side is small; the counts show how many
shuffles each query pays.

    python tools/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from relayline.plans.catalog import QUERIES
    from relayline.plans.oracle import oracle_sql
    from relayline.session import build_session

    spark = build_session("local[4]", shuffle_partitions=8, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="relayline-plans-"))
    oracles = oracle_sql()
    print("# Physical plans (broadcast and AQE off: the large-cluster shape)\n")
    print("Generated by `tools/plans.py`. `exchanges` = shuffles; `scans` = Parquet scans; "
          "`smj` = sort-merge joins; `window` = window operators; `python` = Python evaluation nodes.\n")
    print("| query | exchanges | scans | smj | aggregates | window | python | oracle |")
    print("|---|---|---|---|---|---|---|---|")
    details = []
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        tree = text.split("\n\n")[0]
        py = tree.count("EvalPython") + tree.count("InPandas")
        print(f"| {name} | {tree.count('Exchange')} | {tree.count('Scan parquet')} | {tree.count('SortMergeJoin')} "
              f"| {tree.count('Aggregate (')} | {tree.count('Window (')} | {py} | {'yes' if name in oracles else 'rows only'} |")
        parts = [line for line in text.splitlines()
                 if line.startswith(("Arguments: hashpartitioning", "Arguments: rangepartitioning", "PushedFilters"))]
        details.append((name, tree, parts))
    print("\n## Plans\n")
    for name, tree, parts in details:
        print(f"### {name}\n\n```\n{tree.replace('== Physical Plan ==', '').strip()}\n")
        for p in parts:
            print(p[:220])
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
