"""Command line: query verbs over JSON lines, in stages separated by ``--``, and jobs.

    python -m siltworks.plans.cli -f docs.json -o out where "length({text}) > 100" -- select text
    python -m siltworks.plans.cli mine --config test --manifest wet.paths --root data --train labelled.json
    python -m siltworks.plans.cli regroup --config test
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from siltworks.operators import describe, verbs
from siltworks.plans import jobs
from siltworks.plans.config import PRESETS, Config
from siltworks.session import build_session
from siltworks.sources import readers, sinks


def stages(argv: list[str]) -> list[list[str]]:
    out: list[list[str]] = [[]]
    for word in argv:
        if word == "--":
            out.append([])
        else:
            out[-1].append(word)
    return [s for s in out if s]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siltworks")
    p.add_argument("-f", "--file", action="append", help="an input of the first stage; may be given again")
    p.add_argument("-o", "--output", help="output folder of the last stage; rows are shown without it")
    sub = p.add_subparsers(dest="verb", required=True)
    s = sub.add_parser("select")
    s.add_argument("columns", nargs="+")
    s.add_argument("--skip-empty", action="store_true")
    s.add_argument("--separator", default="\t")
    w = sub.add_parser("where")
    w.add_argument("clauses", nargs="+")
    m = sub.add_parser("merge")
    m.add_argument("columns", nargs="+")
    m.add_argument("--separator", default="\t")
    d = sub.add_parser("describe")
    d.add_argument("columns", nargs="*")
    d.add_argument("--weights")
    d.add_argument("--bins", default="auto")
    d.add_argument("--cumulative", action="store_true")
    t = sub.add_parser("sort")
    t.add_argument("column")
    t.add_argument("-n", type=int, default=10)
    x = sub.add_parser("split")
    x.add_argument("pattern")
    h = sub.add_parser("shard")
    h.add_argument("count", type=int)
    for name in ("hashes", "mine", "regroup", "dl", "minify", "fetch", "paragraphs", "opening"):
        j = sub.add_parser(name)
        j.add_argument("--config", default="base", help="a preset, or a file of settings")
        j.add_argument("--manifest", help="names of WET files, a line each")
        j.add_argument("--root", default="", help="where those files lie")
        j.add_argument("--train", help="labelled documents (language, raw_content) for the models")
        j.add_argument("--order", type=int, default=1)
        j.add_argument("--pieces", help="model of pieces for the sp step")
        j.add_argument("--shard", type=int, default=0)
        j.add_argument("--metadata")
        j.add_argument("--snapshot", default="")
        j.add_argument("--latest", default="")
        j.add_argument("--n-docs", type=int)
    return p


def run_job(spark, a: argparse.Namespace) -> None:
    config = Config.from_json(a.config) if Path(a.config).is_file() else PRESETS[a.config]
    if a.verb == "regroup":
        jobs.regroup(spark, config)
    elif a.verb == "dl":
        jobs.export_shard(spark, config, a.manifest, a.shard, a.output, a.root)
    elif a.verb == "minify":
        jobs.minify(spark, a.file, a.output)
    elif a.verb == "opening":
        jobs.opening(spark, a.file, a.output, a.n_docs)
    else:
        docs = jobs.documents(spark, config, a.manifest, a.root)
        if a.verb == "hashes":
            jobs.hashes(spark, config, docs)
        elif a.verb == "fetch":
            jobs.fetch(spark, docs, a.metadata or config.metadata, a.output)
        elif a.verb == "paragraphs":
            jobs.paragraphs(spark, docs, a.metadata, a.output, a.snapshot, a.latest)
        else:
            models = {}
            if a.train:
                models = jobs.train(spark, config, readers.read_jsonl(spark, a.train, None), a.order, {"*": a.pieces} if a.pieces else None)
            print(json.dumps(jobs.mine(spark, config, docs, models)))


def show_description(df) -> None:
    """Statistics as text, with a bar for each label and bin; there are at most some hundred rows a field."""
    rows = df.collect()
    for field in dict.fromkeys(r["field"] for r in rows):
        own = [r for r in rows if r["field"] == field]
        print(field, *[f"{r['kind']} {r['n']:g}" for r in own if r["kind"] in ("present", "length") and r["n"] is not None])
        barred = sorted((r for r in own if r["kind"] in ("label", "bin")), key=lambda r: (r["low"] or 0, -r["n"]))
        bars = describe.bar_chart([r["n"] for r in barred], 60).split("\n")
        for r, bar in zip(barred, bars, strict=False):
            print(f"  {r['label'] if r['kind'] == 'label' else '%g to %g' % (r['low'], r['high'])}\t{r['n']:g}\t{bar}")


def main(argv: list[str] | None = None) -> None:
    parts = [parser().parse_args(a) for a in stages(argv if argv is not None else sys.argv[1:])]
    spark = build_session()
    first, last = parts[0], parts[-1]
    if first.verb in ("hashes", "mine", "regroup", "dl", "minify", "fetch", "paragraphs", "opening"):
        return run_job(spark, first)
    df = readers.read_lines(spark, first.file).select("value") if first.verb == "merge" else readers.read_jsonl(spark, first.file, None)
    for a in parts:
        if a.verb == "select":
            df = verbs.select(df, a.columns, a.skip_empty, a.separator)
        elif a.verb == "where":
            df = verbs.where(df, a.clauses)
        elif a.verb == "merge":
            df = verbs.merge(df, a.columns, a.separator, df.columns[0])
        elif a.verb == "describe":
            df = describe.describe(df, a.columns or None, a.weights, describe.parse_bins(a.bins), a.cumulative)
        elif a.verb == "sort":
            df = verbs.sorted_head(df, a.column, a.n)
        elif a.verb == "split":
            if not last.output:
                df = verbs.split_counts(df, a.pattern)
            else:
                return sinks.write_split(df, last.output, a.pattern)
        elif a.verb == "shard":
            df = df.repartition(a.count)
    if last.output:
        df.write.text(last.output) if df.columns == ["line"] else sinks.write_jsonl(df, last.output, "none")
    elif last.verb == "describe":
        show_description(df)
    else:
        df.show(truncate=False)


if __name__ == "__main__":
    main()
