"""Command line: ``python -m subledger <job> …``."""

from __future__ import annotations

import argparse
from datetime import date, timedelta

from pyspark.sql import DataFrame

from subledger import fixed_values as fixed
from subledger.operators.normalise import of_types
from subledger.operators.users import map_phones, mapping_coverage
from subledger.plans import jobs, lookup, quality, reports, userbase
from subledger.plans.counters import counter_totals, unmapped_cpcs
from subledger.schemas import FACTS
from subledger.session import build_session
from subledger.sources.dims import load_codes, load_dim, load_excluded
from subledger.sources.snapshots import read_rollup, rejected_rows
from subledger.sources.tables import schema_diff, write_csv


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="subledger")
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--out", help="write the result as CSV instead of printing it")
    sub = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *arguments: tuple) -> None:
        p = sub.add_parser(name)
        for flags, options in arguments:
            p.add_argument(*flags.split(), **options)

    yesterday = str(date.today() - timedelta(days=1))
    source = ("--source", {"required": True, "help": "folder of the CSV extracts"})
    dim = ("--dim", {"required": True, "help": "product dimension CSV"})
    as_of = ("--as-of", {"default": str(date.today())})
    job("load-historical", source)
    job("append-daily", source, ("--day", {"default": yesterday}))
    job("backfill", source, ("--dry-run", {"action": "store_true"}))
    job("build-view", as_of, ("--days", {"nargs": "+", "help": "refresh only the subscriptions with rows on these days"}))
    job("build-counters", ("date", {"nargs": "?"}), ("--start-date", {}), ("--end-date", {}), ("--backfill", {"action": "store_true"}),
        ("--force", {"action": "store_true"}), ("--excluded", {"help": "exclusion list"}), ("--dim", {}))
    job("user-base", source, ("--encoding", {"default": "UTF-8"}), ("--force", {"action": "store_true"}))
    job("reconcile", dim, ("service", {"nargs": "?"}), ("--date", {}))
    job("refunds", dim, ("--months", {"nargs": "+"}))
    job("revenue", dim, ("--services", {"nargs": "+", "required": True}), ("--months", {"nargs": "+", "required": True}))
    job("lifetime", dim, ("service", {"nargs": "?"}), ("month", {"nargs": "?"}))
    job("category", ("--codes", {"required": True, "help": "file with one code per line"}))
    job("user", ("key", {"choices": lookup.KEYS}), ("value", {}))
    job("timeline", ("key", {"choices": lookup.KEYS[1:]}), ("value", {}))
    job("map-phones", ("--excluded", {"required": True}))
    job("check-transactions", as_of)
    job("check-view", as_of)
    return parser


def _results(spark, args) -> dict[str, DataFrame]:
    """Tables to show, by title; building jobs report what they did and show nothing else."""
    root = args.root
    if args.job in ("load-historical", "append-daily"):
        daily = args.job == "append-daily"
        load = jobs.append_daily(spark, args.source, root, args.day) if daily else jobs.load_historical(spark, args.source, root)
        for name, done in load.items():
            print(f"{name}: {done.rows_stored} rows, {done.duplicates} duplicates removed, unparsed dates {done.null_dates}")
            for path, rows in done.rejected.items():
                print(f"  rejected {path}: {rows} faulty rows")
    elif args.job == "backfill":
        runs = jobs.backfill(spark, args.source, root, dry_run=args.dry_run)
        return {"missing dates": runs} if runs is not None else {}
    elif args.job == "build-view":
        build = jobs.build_view(spark, root, args.as_of) if not args.days else jobs.refresh_view(spark, root, args.as_of, args.days)
        print(build, "subscriptions")
    elif args.job == "build-counters":
        phones, users = load_excluded(spark, args.excluded) if args.excluded else (None, None)
        start = args.start_date or args.date or (None if args.backfill else str(date.today() - timedelta(days=1)))
        print(jobs.build_counters(spark, root, start, args.end_date, args.force, phones, users), "dates")
        counters = jobs.tables.load_counters(spark, jobs.counters_path(root))
        shown = {"totals by date": counter_totals(counters)}
        if args.dim:
            dim = load_dim(spark, args.dim)
            print(jobs.publish_services(spark, root, dim))
            shown["unmapped codes"] = unmapped_cpcs(counters, dim)
        return shown
    elif args.job == "user-base":
        print(jobs.build_user_base(spark, args.source, root, encoding=args.encoding, force=args.force))
        return {"unusable rows": rejected_rows(spark, args.source, args.encoding)}
    elif args.job == "reconcile":
        by_service, by_cpc = (read_rollup(spark, f"{root}/user_base/by_{level}") for level in ("service", "cpc"))
        return {"differences": userbase.reconcile_user_base(by_service, by_cpc, load_dim(spark, args.dim), args.service, args.date)}
    elif args.job == "refunds":
        rfnd = of_types(jobs.tx_of(spark, root, args.months), "RFND")
        return {"refunds": reports.refund_analysis(rfnd, load_dim(spark, args.dim, fill=False))}
    elif args.job == "revenue":
        counters = jobs.tables.load_counters(spark, jobs.counters_path(root))
        rows = jobs.counters_service(counters, load_dim(spark, args.dim))
        return {"revenue": reports.revenue_pivot(rows, args.services, args.months)}
    elif args.job == "lifetime":
        return {"lifetime and value": reports.cohort_lt_ltv(
            jobs.load_view(spark, root), load_dim(spark, args.dim), args.service, args.month)}
    elif args.job == "category":
        codes = load_codes(spark, args.codes)
        extract = reports.category_extract(jobs.load_view(spark, root), codes)
        return {"subscriptions": extract, "overview": reports.category_overview(extract),
                "top codes": reports.top_list_codes(extract, codes)}
    elif args.job == "user":
        subs, key = jobs.load_view(spark, root), (args.key, args.value)
        return {"subscriptions": lookup.user_subscriptions(subs, *key), "summary": lookup.user_summary(subs, *key),
                "by code": lookup.user_cpc_breakdown(subs, *key), "by status": lookup.user_status_breakdown(subs, *key),
                "timeline": lookup.user_subscription_timeline(subs, *key)}
    elif args.job == "timeline":
        tx, key = jobs.tx_of(spark, root), (args.key, args.value)
        return {"ids": lookup.user_id_mapping(tx, *key), "transactions": lookup.user_timeline(tx, *key),
                "summary": lookup.timeline_summary(tx, *key), "purchases": lookup.user_ppd(tx, *key),
                "purchase total": lookup.user_ppd_total(tx, *key)}
    elif args.job == "map-phones":
        phones, _ = load_excluded(spark, args.excluded)
        mapped = map_phones(phones, jobs.tx_of(spark, root))
        return {"phones": mapped, "coverage": mapping_coverage(mapped)}
    elif args.job == "check-transactions":
        tx = jobs.tx_of(spark, root)
        for name, fact in FACTS.items():
            stored = jobs.tables.read_current(spark, jobs.tables.fact_path(jobs.transactions(root), fact))
            if stored is not None:
                print(name, "columns:", schema_diff(stored.drop("day"), fact.stored_columns))
        return {"missing days": quality.completeness_ranges(tx, args.as_of), "rows": quality.stored_row_counts(spark, jobs.transactions(root)),
                "date ranges": quality.stored_date_ranges(spark, jobs.transactions(root)), "partitions": quality.stored_inventory(spark, jobs.transactions(root)),
                "duplicates": quality.tx_duplicates(tx), "activations": quality.act_count_total(tx),
                "revenue by month": quality.act_revenue_by_month(tx), "latest renewals": quality.latest_renewals(tx),
                "cancellations by month": quality.cancellations_by_month(tx), "refunds": quality.refund_totals(tx)}
    elif args.job == "check-view":
        subs, as_of = jobs.load_view(spark, root), args.as_of
        print("columns:", schema_diff(jobs.tables.read_current(spark, jobs.view_path(root)), (*fixed.LIFECYCLE_COLUMNS, "as_of", "bucket")))
        timed = ("monthly_activations", "monthly_renewals", "monthly_deactivations", "monthly_cancellations",
                 "monthly_refunds", "recent_activations", "completeness_lifecycle")
        plain = ("lifecycle_date_ranges", "quality_checks", "revenue_statistics", "active_count", "top_cpcs",
                 "lifetime_by_status", "most_renewals")
        shares = ("status_distribution", "missing_act_distribution", "cpc_count_distribution", "upgrade_statistics",
                  "revenue_summary", "top_campaigns", "monthly_activation_stats", "sample_upgraded", "sample_missing_act")
        return {**{n: getattr(quality, n)(subs, as_of) for n in timed}, **{n: getattr(quality, n)(subs) for n in plain},
                **{n: getattr(reports, n)(subs) for n in shares}}
    return {}


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session()
    results = _results(spark, args)
    for title, rows in results.items():
        if args.out:
            name = title.replace(" ", "_")
            write_csv(rows, args.out if len(results) == 1 else f"{args.out}/{name}")
        else:
            print(f"\n{title}")
            print("\t".join(rows.columns))
            for row in rows.toLocalIterator():  # every row, a partition at a time
                print("\t".join("" if v is None else str(v) for v in row))


if __name__ == "__main__":
    main()
