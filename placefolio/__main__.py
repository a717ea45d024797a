"""One run from the command line: ``spark-submit`` or ``python -m placefolio``. Prints the summary as JSON."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from placefolio.params import DEFAULT_CURRENCY, DEFAULT_SITE_CAP, DEFAULT_TARGET, RunParams
from placefolio.plans.build import build_catalogue
from placefolio.session import SESSION_CONF


def main(argv: list[str] | None = None) -> str:
    parser = argparse.ArgumentParser(prog="placefolio", description=__doc__)
    parser.add_argument("--search-pages", required=True, help="Parquet with query_ord or search_query, page_no, first_pos, response, error")
    parser.add_argument("--fetch-log", required=True, help="Parquet with url, http_status, error, content_type, content, attempt_no if there are retries")
    parser.add_argument("--rules", required=True, help="Parquet with robots_url, group_ord, agent, rule_ord, path_prefix, allow")
    parser.add_argument("--namespace", required=True, help="schema the tables are written to")
    parser.add_argument("--location", help="folder of the tables, else the schema's own")
    parser.add_argument("--search-queries", default="", help="comma list; gives the order of pages recorded by search_query")
    parser.add_argument("--target-count", default=str(DEFAULT_TARGET))
    parser.add_argument("--max-sites", default=str(DEFAULT_SITE_CAP))
    parser.add_argument("--currency", default=DEFAULT_CURRENCY)
    parser.add_argument("--reset-tables", default="false", choices=["true", "false"])
    parser.add_argument("--upsert", action="store_true", help="replace the places this run finds and keep all others")
    parser.add_argument("--rule-answers", help="Parquet with robots_url, http_status of rules files that could not be read")
    parser.add_argument("--keep-objects", action="store_true")
    parser.add_argument("--objects", help="folder of stored documents, .../raw/<place_id>/<file>.pdf")
    parser.add_argument("--answers-of", default="", help="name of what gives the answers; with a name they are kept and reused")
    parser.add_argument("--keep-rejects", action="store_true", help="write down broken answers with the rule they break")
    args = parser.parse_args(argv)

    builder = SparkSession.builder.appName("placefolio")
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    params = RunParams.from_strings(args.search_queries, args.target_count, args.max_sites, args.currency, args.reset_tables,
                                    upsert=args.upsert, answers_of=args.answers_of, keep_rejects=args.keep_rejects)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {args.namespace}")
    summary = build_catalogue(
        spark, *[spark.read.parquet(path) for path in (args.search_pages, args.fetch_log, args.rules)],
        args.namespace, params, location=args.location, keep_objects=args.keep_objects, objects=args.objects,
        rule_answers=spark.read.parquet(args.rule_answers) if args.rule_answers else None)
    report = summary.first().asDict()
    report["status_breakdown"] = json.loads(report["status_breakdown"])
    result = json.dumps({"schema": args.namespace, **report})
    print(result)
    return result


if __name__ == "__main__":
    main()
