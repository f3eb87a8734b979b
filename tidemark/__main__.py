"""One update from the command line: `spark-submit ... tidemark/__main__.py` or `python -m tidemark`."""

from __future__ import annotations

import argparse

from tidemark.medallion import Layout, run
from tidemark.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("--landing", required=True, help="folder of landed captures (dt=/hh=)")
    parser.add_argument("--root", required=True, help="folder of the tables; a new one is a full refresh")
    parser.add_argument("--source", required=True, help="text put on every raw row")
    parser.add_argument("--as-of", help="current time for the views (UTC); default: now")
    parser.add_argument("--slot-minutes", type=int, help="join captures of one slot of this width")
    parser.add_argument("--max-files", type=int, help="files per micro-batch during a back-fill")
    parser.add_argument("--state-partitions", type=int, help="dedup state partitions, fixed at first start")
    args = parser.parse_args()

    spark = build_session("tidemark")
    update = run(
        spark,
        args.landing,
        Layout(args.root.rstrip("/")),
        args.source,
        args.as_of,
        args.slot_minutes,
        args.max_files,
        state_partitions=args.state_partitions,
    )
    print(update)
    spark.stop()


if __name__ == "__main__":
    main()
