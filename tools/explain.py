"""Write the formatted physical plans of the headline queries to
docs/plans/<name>.txt and print a one-line operator summary per query.

Usage: python tools/explain.py [sf_dir] [names...]
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, ".")
from bench import HEADLINE  # noqa: E402
from driftcast import fixtures  # noqa: E402
from driftcast.plans.registry import registry  # noqa: E402
from driftcast.session import get_spark, shared_path  # noqa: E402

OPS = ("ReusedExchange", "Exchange", "BroadcastExchange", "BroadcastHashJoin", "ShuffledHashJoin", "SortMergeJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "Generate", "HashAggregate", "ObjectHashAggregate",
       "SortAggregate", "Window", "Scan parquet", "PythonUDF", "BatchEvalPython", "ArrowEvalPython")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or list(HEADLINE)
    spark = get_spark("local[8]", 8)
    reg = registry()
    fixtures.materialize(spark, sf, shared_path(spark, "explain-inputs"))  # stored inputs, as in bench.py
    os.makedirs("docs/plans", exist_ok=True)
    for name in names:
        df = reg[name][0](spark, sf)
        df.write.format("noop").mode("overwrite").save()  # final adaptive plan, with reused exchanges
        qe = df._jdf.queryExecution()
        plan = df._sc._jvm.PythonSQLUtils.explainString(qe, "formatted")
        with open(f"docs/plans/{name}.txt", "w") as fh:
            fh.write(plan)
        head = plan.split("\n\n")[0]
        c = Counter()
        for op in OPS:
            c[op] = len(re.findall(rf"\b{re.escape(op)}\b \(", head))
        print(name, {k: v for k, v in c.items() if v})


if __name__ == "__main__":
    main()
