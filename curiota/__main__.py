"""``python -m curiota PLAN.yaml``: read the plan's input, run it, write its output."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession

from curiota.plans.plan import load
from curiota.sources.text import dtypes_json, read_auto, with_row_id, write_text


def main() -> None:
    parser = argparse.ArgumentParser(prog="curiota", description=__doc__)
    parser.add_argument("plan")
    parser.add_argument("--input")
    parser.add_argument("--output")
    args = parser.parse_args()
    plan, config = load(args.plan)
    spark = SparkSession.builder.appName("curiota").getOrCreate()
    began, statistics = time.time(), []
    source = with_row_id(read_auto(spark, args.input or config.get("inputfile") or config["inputfile_path"], config.get("sep", "\t")))
    out = plan.apply(source, statistics=statistics)
    write_text(out, args.output or config.get("outputfile") or f"{config.get('outputdir_path', '.')}/{config['outputfile_path']}", mode="overwrite")
    print(dtypes_json(out))
    steps = [{"column": c, "operator": o, "rows": seen.get["rows"]} for c, o, seen in statistics]
    print(json.dumps({"seconds": round(time.time() - began, 1), "steps": steps}))


if __name__ == "__main__":
    main()
