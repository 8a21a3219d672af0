"""Command line: python -m reviewflow.cli STAGE ... Every stage that writes needs an explicit output."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict
from datetime import date, datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame

from reviewflow import keys, naming, pipeline, sinks
from reviewflow.conf import load
from reviewflow.operators import identity
from reviewflow.sources.paths import supported
from reviewflow.storage import written


def _session():  # noqa: ANN202
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("reviewflow").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="reviewflow", description=__doc__)
    sub = p.add_subparsers(dest="stage", required=True)

    def stage(name: str, many: bool = False, output: bool = True) -> argparse.ArgumentParser:
        s = sub.add_parser(name)
        s.add_argument("inputs", nargs="+" if many else 1, type=Path)
        if output:
            s.add_argument("--output", type=Path, required=True)
            s.add_argument("--overwrite", action="store_true")
            s.add_argument("--confirm-overwrite", type=Path, action="append", default=[])
        return s

    def configured(s: argparse.ArgumentParser) -> argparse.ArgumentParser:
        s.add_argument("--config", type=Path, help="a configuration file; it must say what the package does")
        return s

    stage("inventory", many=True, output=False)
    stage("merge", many=True).add_argument("--add-source-columns", action="store_true")
    configured(stage("preprocess", many=True)).add_argument("--platform")
    stage("strip-replies").add_argument("--target-header", default="content")
    s = configured(stage("standardize"))
    s.add_argument("--platform")
    s.add_argument("--project-name")
    s.add_argument("--project-id")
    s.add_argument("--registry", type=Path)
    s.add_argument("--product-name")
    s.add_argument("--reference-date", type=date.fromisoformat)
    s = stage("audit")
    s.add_argument("--source", type=Path)
    s.add_argument("--reference-date", type=date.fromisoformat)
    stage("filter").add_argument("--keyword", action="append", required=True)
    s = configured(stage("clean"))
    s.add_argument("--target-header", required=True)
    s.add_argument("--platform", required=True)
    s.add_argument("--clean-word", action="append", default=[])
    s = stage("compare")
    s.add_argument("--right", type=Path, required=True)
    s.add_argument("--comment-column", type=int, default=3)
    s.add_argument("--sheet")
    s.add_argument("--left-label", default="left")
    s.add_argument("--right-label", default="right")
    s.add_argument("--output-dir", type=Path, help="the whole bundle: summary, two difference CSVs, report workbook")
    s = stage("name", many=True, output=False)
    s.add_argument("--product-name")
    s.add_argument("--data-source")
    s.add_argument("--x-data-type")
    s = stage("cleanup", many=True, output=False)
    s.add_argument("--protect", type=Path, action="append", required=True)
    s.add_argument("--final", type=Path, action="append", required=True)
    s.add_argument("--summary", type=Path)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    show = lambda x: print(json.dumps(x, ensure_ascii=False, indent=2, default=str))
    if a.stage == "name":
        found = naming.plan(a.inputs, a.product_name, a.data_source, a.x_data_type)
        if "product_name" in found.missing and not found.products and all(map(supported, a.inputs)) and all(p.is_file() for p in a.inputs):
            # No name says a product: the product columns of the files do.
            tables = pipeline.product_tables(_session(), a.inputs)
            found = naming.plan(a.inputs, a.product_name, a.data_source, a.x_data_type, tables=tables)
        show(asdict(found))
        return 0
    if a.stage == "cleanup":
        show(sinks.clean_up(a.inputs, a.protect, a.final, a.summary))
        return 0
    if a.stage == "standardize" and bool(a.platform) != bool(a.project_name or a.project_id):
        raise SystemExit("platform and project go together")
    if a.stage == "clean" and (a.target_header != "评论内容" or not a.platform.strip()):
        raise SystemExit("cleaning needs --target-header 评论内容 and a platform")
    if getattr(a, "config", None):
        load.agreed({"preprocess": "platforms", "standardize": "headers", "clean": "cleaning"}[a.stage], a.config, a.config)
    spark = _session()
    if a.stage == "inventory":
        show(pipeline.inventory(spark, a.inputs))
        return 0
    outputs = [a.output, *([a.output.with_suffix(x) for x in (".csv", ".deletions.csv")] if a.stage == "clean" else []), a.output.with_suffix(".summary.json")]
    if a.stage in ("audit", "compare"):
        outputs = [a.output]
    if a.stage == "compare" and a.output_dir:
        outputs += [a.output_dir / n for n in ("comparison-summary.json", "only-in-left.csv", "only-in-right.csv", "comparison-report.xlsx")]
    sinks.guard(a.inputs, outputs, a.overwrite, a.confirm_overwrite)
    if a.stage == "audit":
        ref = a.reference_date or pipeline.audit_reference_date(a.inputs[0]) or datetime.now(sinks.BEIJING).date()
        found = pipeline.audit_files(spark, a.inputs[0], a.source, ref)
        sinks.write_json(found, a.output)
        return 0 if found["passed"] else 2
    if a.stage == "compare":
        found = pipeline.compare_files(spark, a.inputs[0], a.right, a.comment_column, a.sheet, (a.left_label, a.right_label), a.output_dir)
        sinks.write_json(found, a.output)
        return 0
    title, more, log = None, {}, None
    before: list = []
    if a.stage == "merge":
        out, title = [pipeline.merge(spark, a.inputs, a.add_source_columns)], "总表"
    elif a.stage == "preprocess":
        out, title = [pipeline.preprocess(spark, a.inputs, a.platform)], "总表"
    else:
        before = pipeline.read_sheets(spark, a.inputs[0])
        if a.stage == "strip-replies":
            out = [pipeline.strip_replies(t, a.target_header) for t in before]
        elif a.stage == "filter":
            out = [pipeline.keep_keywords(t, a.keyword) for t in before]
        elif a.stage == "standardize":
            ref = a.reference_date or datetime.now(sinks.BEIJING).date()
            project = keys.load(a.registry or Path("registry"), a.project_name, a.project_id) if a.platform else None
            out = [pipeline.standardize_sheets(before, ref, a.platform and identity.platform_of(a.platform), project, a.product_name)]
            more["reference_date"] = ref.isoformat()
        else:
            sinks.refuse_restoring(a.output)
            cleaned = [pipeline.clean(t, a.target_header, a.platform, a.clean_word) for t in before]
            out = [c for c, _ in cleaned]
            log = written(reduce(DataFrame.unionByName, (x for _, x in cleaned)), "event-log")
    # Computed once, whatever is written from it.
    out = [written(t, "stage-result") for t in out]
    pipeline.write_table(out, a.output, title)
    if log is not None:
        pipeline.write_table(out, a.output.with_suffix(".csv"))
        sinks.write_event_log(log, a.output.with_suffix(".deletions.csv"))
        more |= pipeline.event_counts(log)
    more["sheets"] = pipeline.sheet_summaries(out)
    if a.stage == "standardize":
        more |= pipeline.mapping_summary(before)
    n_out = sum(s["rows"] for s in more["sheets"])
    n_in = sum(t.count() for t in before) if before else n_out
    sinks.write_json(pipeline.summary(n_in, n_out, pipeline._own(out[0]), stage=a.stage, inputs=[str(p) for p in a.inputs], output=str(a.output), **more), a.output.with_suffix(".summary.json"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
