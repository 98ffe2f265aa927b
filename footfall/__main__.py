"""Command line: run the notebook or the AutoML flow on the original CSV files.

    python -m footfall notebook --data DIR --out DIR
    python -m footfall automl   --data DIR --out DIR --models DIR [--budget SECONDS]

On a cluster submit with ``spark-submit -m footfall``-style packaging and set
``spark.checkpoint.dir`` to shared storage.
"""

from __future__ import annotations

import argparse


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="footfall")
    ap.add_argument("flow", choices=["notebook", "automl"])
    ap.add_argument("--data", required=True, help="directory with the eight CSV files")
    ap.add_argument("--out", required=True, help="output directory for scored CSVs")
    ap.add_argument("--models", help="model directory (automl)")
    ap.add_argument("--budget", type=float, default=36000.0, help="search budget in seconds")
    ap.add_argument("--large-party", type=float, default=120.0)
    args = ap.parse_args(argv)

    from footfall.plans import flows
    from footfall.session import get_session
    from footfall.sources import read_csv_tables

    spark = get_session()
    tables = read_csv_tables(spark, args.data)
    if args.flow == "notebook":
        out = flows.notebook_flow(tables, args.out, large_party_threshold=args.large_party)
    else:
        if not args.models:
            ap.error("--models is required for automl")
        out = flows.automl_flow(tables, args.out, args.models,
                                large_party_threshold=args.large_party,
                                time_budget_s=args.budget)
    for k, v in out.items():
        if isinstance(v, str):
            print(f"{k}: {v}")


if __name__ == "__main__":
    main()
