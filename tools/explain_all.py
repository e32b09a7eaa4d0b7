"""Write the physical plan tree of every registered query to PLANS.md.

Usage: python tools/explain_all.py [sf_dir [key ...]]   (default /root/testdata/sf0.01, all keys)
With keys, only their sections are made anew; the others stay as they are.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pageflow.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    from pageflow.registry import QUERIES
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    only = sys.argv[2:]
    old = {}
    if only:
        with open(path) as f:
            old = {part.split("\n", 1)[0]: part.rstrip().split("\n") for part in f.read().split("\n## ")[1:]}
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/explain_all.py` at `{sf}` (local[8]); the tree part of `explain('formatted')`, "
           "plus scan pushdown lines. AQE re-plans at run time (final plans may coalesce or convert joins).", ""]
    for k, fn in QUERIES.items():
        if only and k not in only:
            if k in old:
                out += ["## " + old[k][0], *old[k][1:], ""]
            continue
        df = fn(spark, sf)
        txt = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        lines = txt.splitlines()
        tree, scans = [], []
        for ln in lines[1:]:
            if ln.startswith("("):
                break
            if ln.strip():
                tree.append(ln)
        for ln in lines:
            if ln.startswith(("PushedFilters", "ReadSchema", "PartitionFilters")) and len(ln) < 400:
                scans.append(ln)
        out += [f"## {k}", "", "```", *tree, *sorted(set(scans)), "```", ""]
    with open(path, "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
