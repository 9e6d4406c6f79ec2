"""python -m epochal STAGE [--year Y]: with --pages, reads saved pages into tables and features, each stage going on from the
tables of the ones before; without, runs named queries over a folder of tables and writes their rows.

Exit code 0 if all stages were done, 1 if one failed; a failed stage is logged and the next one runs.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import functions as F

from epochal import ingest, session
from epochal.operators import audit
from epochal.plans import registry

#: Stages in their order, each with the queries that it runs.
STAGES = {
    "tournaments": ("archive_pages", "overview_pages", "merge_tournaments", "draw_templates"),
    "players": ("profile_pages", "merge_players"),
    "matches": ("result_pages", "merge_matches", "merge_points"),
    "stats": ("statistics_pages", "merge_stats"),
    "features": ("feature_table",),
}


def main(argv: list[str] | None = None) -> int:
    args = argparse.ArgumentParser(prog="epochal", description=__doc__)
    args.add_argument("stage", choices=[*STAGES, "all"])
    args.add_argument("--tables", default=os.environ.get("BENCH_SF_DIR", "."), help="folder of the tables")
    args.add_argument("--pages", help="folder of saved pages (kind, year, url, html)")
    args.add_argument("--out", required=True, help="folder of the results and of the log")
    args.add_argument("--year", type=int, help="only pages of this year, and what depends on them; of queries, rows whose tournament_id begins with it")
    given = args.parse_args(argv)
    spark = session.session()
    done = True
    run = ingest.Run(spark, given.pages, given.out) if given.pages else None
    for stage in STAGES if given.stage == "all" else [given.stage]:
        if run:
            done &= audit.logged(spark, given.out, stage, lambda stage=stage: ingest.STAGES[stage](run, given.year))
            continue
        for name in STAGES[stage]:

            def build(name=name):
                rows = registry.queries()[name](spark, given.tables)
                if given.year and "tournament_id" in rows.columns:
                    rows = rows.filter(F.col("tournament_id").startswith(str(given.year)))
                return rows if "action" in rows.columns else rows.withColumn("action", F.lit("insert"))

            done &= audit.run(spark, given.out, name, build)
    audit.log(spark, given.out).select("module", "status", "rows", "seconds", "error").orderBy("module").show(100, truncate=60)
    return 0 if done else 1


if __name__ == "__main__":
    sys.exit(main())
