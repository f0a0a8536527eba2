"""Command line: fuse person records of several files into golden records.

Exit status: 0 done, 1 some profile is invalid, 2 no input.
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recfuse.operators import identity, mapping, validation
from recfuse.operators.projection import MINIMAL, Projection, project, to_output_json
from recfuse.plans.pipeline import PipelineConfig, run
from recfuse.schema import MERGE_STRATEGIES
from recfuse.session import ship
from recfuse.sources import files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="recfuse", description=__doc__.splitlines()[0])
    for kind in ("csv", "ats", "resume", "github"):
        p.add_argument(f"--{kind}", action="append", default=[], metavar="PATH")
    p.add_argument("--config", help="output specification (YAML or JSON)")
    p.add_argument("--merge-strategy", choices=MERGE_STRATEGIES, default="source_priority")
    p.add_argument("--match-threshold", type=float, default=identity.DEFAULT.match)
    p.add_argument("--output", help="file or folder for the profiles; standard output if left out")
    p.add_argument("--report", help="file for the validation report")
    p.add_argument("--format", choices=("json", "jsonl", "pretty"), default="json")
    p.add_argument("--records-key", help="member of a JSON object that holds the records")
    p.add_argument("--as-of", default="2026-01-01 00:00:00")
    p.add_argument("--minimal", action="store_true")
    p.add_argument("--no-fail-on-error", action="store_true")
    return p


def load(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """Canonical records of all sources; a source that cannot be read is reported and left out."""
    parts: list[DataFrame] = []
    offset = 0
    jobs = [("csv", p) for p in args.csv] + [("ats", p) for p in args.ats] + [("resume", p) for p in args.resume] + [("github", p) for p in args.github]
    for kind, path in jobs:
        try:
            if kind == "csv":
                t = files.read_delimited(spark, path).withColumn("_id", F.col("ord").cast("string"))
                part = mapping.map_columns(t, "csv", "_id", "ord", label=F.lit(path))
            elif kind == "ats":
                part = mapping.map_vendor_json(files.read_json(spark, path, lines=not path.endswith(".json"), records_key=args.records_key))
            elif kind == "github":
                part = mapping.map_github(files.read_json(spark, path, lines=not path.endswith(".json")), payload="raw_fields")
            else:
                docs = files.read_pdf(spark, path) if path.lower().endswith(".pdf") else files.read_documents(spark, path)
                part = mapping.map_resumes(docs)
            part.schema  # noqa: B018 - analysis fails here for a source that cannot be read
        except Exception as e:  # noqa: BLE001 - one damaged source must not end the run
            print(f"skipped {path}: {str(e).splitlines()[0]}", file=sys.stderr)
            continue
        # Every source gets its own range of positions, so that positions stay unique and ordered.
        parts.append(part.withColumn("ord", F.col("ord") + F.lit(offset << 48)))
        offset += 1
    return mapping.union_records(*parts) if parts else None


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if not (args.csv or args.ats or args.resume or args.github):
        print("no input", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("recfuse").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    records = load(spark, args)
    if records is None:
        print("no input could be read", file=sys.stderr)
        return 2
    spec = MINIMAL if args.minimal else Projection.load(args.config)
    rules = validation.Rules(fail_on_error=not args.no_fail_on_error)
    cfg = PipelineConfig(strategy=args.merge_strategy, match=identity.MatchSettings(match=args.match_threshold), projection=spec, rules=rules, as_of=args.as_of)
    result = run(records, cfg)
    documents = to_output_json(project(result.profiles, spec), spec)
    if args.output:
        files.write_json(documents, args.output, args.format)
    else:
        for r in documents.toLocalIterator():
            print(json.dumps(json.loads(r["json"]), ensure_ascii=False, indent=2 if args.format == "pretty" else None))
    stats = validation.statistics(result.validated).first().asDict()
    if args.report:
        top = [[r["rule"], r["n"]] for r in validation.top_violations(result.validated).collect()]
        Path(args.report).write_text(json.dumps({"statistics": {**stats, "top_violations": top}}, indent=2), encoding="utf-8")
    print(f"{stats['total']} profiles, {stats['invalid']} invalid", file=sys.stderr)
    return 1 if stats["invalid"] and not args.no_fail_on_error else 0


if __name__ == "__main__":
    sys.exit(main())
