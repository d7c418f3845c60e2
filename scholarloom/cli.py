"""Command line: version, process, process-list, rerender. Known errors go to standard error with exit code 1."""

from __future__ import annotations

import argparse
import sys
import uuid
from functools import partial

VERSION = "0.1.0"
#: The source that stands for papers without accessible text.
RESTRICTED = "springer_restricted_partial"


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="scholarloom")
    sub = out.add_subparsers(dest="command", required=True)
    sub.add_parser("version")
    for name, key in (("process", "doi"), ("process-list", "input")):
        p = sub.add_parser(name)
        p.add_argument(key)
        p.add_argument("--library-root", default="workspace/library")
        p.add_argument("--results")
        p.add_argument("--offline", action="store_true", help="use landed files only")
        if name == "process":
            p.add_argument("--pdf", help="a PDF that comes before any other source")
    sub.add_parser("rerender").add_argument("library_root")
    return out


def item_line(item, total: int) -> str:
    """How far the batch is, and what became of an entry."""
    head = f"[{item['index']}/{total}] {item['doi']}"
    if item["status"] == "failed":
        return f"{head} -> FAILED\n    {item['error']}"
    if item["source"] == RESTRICTED:
        return f"{head} -> warning (restricted access; partial XML/metadata)"
    return f"{head} -> {item['status']} ({item['source']})"


def paper_lines(item) -> str:
    """One processed paper."""
    out = [f"DOI = {item['doi']}", f"Route = {item['route']}", f"Source = {item['source']}", f"Status = {item['status']}", f"Fallback used = {'yes' if item['fallback_used'] == 'true' else 'no'}"]
    out += [f"LLM Markdown = {item['llm_markdown']}"] if item["llm_markdown"] else []
    out.append(f"QA = {item['qa']}")
    if item["source"] == RESTRICTED:
        folder = item["qa"].rpartition("/")[0]
        out += ["", "Access = restricted / public full text unavailable", "Partial XML/metadata Markdown was saved.", "", "If you legally obtain the main article PDF:", f"Place exactly ONE PDF file in:\n  {folder}", "The PDF filename can be anything.", "", f"Then rerun:\n  scholarloom process {item['doi']}"]
    return "\n".join(out)


def _options(args, spark):
    from .plans.papers import Options
    from .sources.http import fetch_rows
    from .sources.landed import external_parser
    from .sources.settings import load_settings

    settings = load_settings(spark)
    fetch = None if args.offline else partial(fetch_rows, keys=settings.keys(), timeout=settings.http_timeout)
    parse = external_parser(settings.parser_executable, settings.parser_tier) if settings.parser_executable else None
    return Options(root=args.library_root, fetch=fetch, parser=parse)


def _process(args, spark) -> int:
    from .plans.batch import artifacts_of, run_batch

    dois = spark.createDataFrame([(0, args.doi)], "pos int, doi_raw string")
    artifacts = artifacts_of(spark, args.library_root, dois, args.pdf)
    # A manifest of its own, so that a paper can be processed again.

    path = args.results or f"{args.library_root}/.process/{uuid.uuid4().hex}.csv"
    item = run_batch(spark, dois, _options(args, spark), path, artifacts=artifacts).first()
    if item["status"] == "failed":
        print(f"ERROR: {item['error']}", file=sys.stderr)
        return 1
    print(paper_lines(item))
    return 0


def _process_list(args, spark) -> int:
    from .operators.manifest import summary
    from .plans.batch import run_batch
    from .sources.landed import read_doi_list

    path = args.results or f"{args.library_root}/batch_results.csv"
    items = run_batch(spark, read_doi_list(spark, args.input), _options(args, spark), path, on_result=lambda item, total: print(item_line(item, total), flush=True))
    n = summary(items).first()
    print(f"total {n['total']} success {n['success_count']} warning {n['warning_count']} failed {n['failed_count']}\nresults = {path}")
    return 0 if not n["failed_count"] else 1


def _rerender(args, spark) -> int:
    from .plans.batch import rerender

    for r in rerender(spark, args.library_root).orderBy("paper_id").toLocalIterator():
        print(f"{r['paper_id']}: " + (f"ERROR {r['error']}" if r["error"] else f"tables {r['matched_table_count']}/{r['source_table_count']} numeric match {r['table_numeric_values_match']} references {r['has_references']}"))
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "version":
        print(VERSION)
        return 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("scholarloom").getOrCreate()
    try:
        return {"process": _process, "process-list": _process_list, "rerender": _rerender}[args.command](args, spark)
    except Exception as e:  # noqa: BLE001
        print(f"ERROR: {type(e).__name__}: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
