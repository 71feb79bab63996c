"""Command line: extract WARC shards, deduplicate JSON lines, evaluate variants on gold records."""

from __future__ import annotations

import argparse
import textwrap
from itertools import zip_longest
from pathlib import Path

from pyspark.sql import functions as F

from .operators import dedup, minhash
from .operators.evaluate import discard_breakdown, word_diff
from .operators.filters import id_contains
from .plans import pipeline
from .session import build_session, materialize, ship
from .sources import files, warc


def extract(spark, a: argparse.Namespace) -> None:
    """Shards that the manifest lacks, through the production steps, to gzipped JSON lines."""
    shards = warc.list_files(spark, a.input)
    if a.manifest:  # finished shards are not opened; the list is fixed, as shards may arrive meanwhile
        shards = materialize(files.unfinished(shards, files.read_manifest(spark, a.manifest)), "shards")
    pages = warc.read_warc(spark, shards)
    kept = pipeline.survivors(pipeline.run(pages, pipeline.production()))
    files.write_jsonl(kept.select("text", "id", F.struct("url", "document_class").alias("metadata")), a.output)
    if a.manifest:
        files.mark_finished(shards, a.manifest)


def deduplicate(spark, a: argparse.Namespace) -> None:
    """Exact, then near duplicates; removed rows go beside the kept ones."""
    rows, _ = files.read_jsonl(spark, a.input)
    rows = files.settled(rows, a.settle_seconds).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "settled")  # all outputs have the same rows, whatever the clock says when they are written
    kept, same = dedup.exact_dedup(rows, "text", ["file"], "row")
    near_kept, near = minhash.near_dedup(kept, "row")
    files.write_lines(near_kept, f"{a.output}/kept")
    for name, df in (("exact_duplicates", same), ("near_duplicates", near)):
        files.write_jsonl(df.select("id", "text", "metadata", "file"), f"{a.output}/{name}")
    files.removal_log(files.every_nth(same.withColumn("url", F.col("metadata.url")))).show(20, truncate=100)


def diff_text(experiment: str, rows: list) -> str:
    """The diff report of one experiment as text."""
    out = [f"# {experiment}"]
    for r in rows:
        out += ["", f"document {r['key']}", f"missing: {', '.join(r['missing']) or '-'}", f"extra: {', '.join(r['extra']) or '-'}"]
    return "\n".join(out) + "\n"


def side_by_side(title: str, gold: str | None, got: str | None, width: int = 70) -> str:
    """The text by hand and the extracted one in two columns, line by line."""
    columns = [[x for line in (t or "").splitlines() for x in (textwrap.wrap(line, width) or [""])] for t in (gold, got)]
    rows = [f"{a:<{width}} | {b}" for a, b in zip_longest(["by hand", *columns[0]], ["extracted", *columns[1]], fillvalue="")]
    return "\n".join(["", title, *rows])


def evaluate(spark, a: argparse.Namespace) -> None:
    gold, _ = files.read_jsonl(spark, a.gold_dir, files.GOLD)
    if a.doc_id:
        gold = gold.filter(id_contains(F.col("id"), a.doc_id, normalize=True))
    results = pipeline.evaluate(gold, pipeline.presets()).persist()
    pipeline.experiment_table(results).show(truncate=False)
    discard_breakdown(results.filter(F.col(pipeline.REASON).isNotNull()), pipeline.REASON, by=["experiment"]).show(100, truncate=False)
    saved = results.filter(F.col(pipeline.REASON).isNull()).withColumn("key", F.concat_ws("#", "id", F.col("row").cast("string")))
    if a.doc_id:
        for r in saved.select("experiment", "id", "gold_text", "extracted").orderBy("id", "experiment").toLocalIterator():  # one labelled document
            print(side_by_side(f"{r['experiment']}: {r['id']}", r["gold_text"], r["extracted"]))
    if a.output_dir:
        files.write_jsonl(saved.select("experiment", "id", "url", F.col("extracted").alias("text")), a.output_dir, ["experiment"])
    if a.diff_dir:
        Path(a.diff_dir).mkdir(parents=True, exist_ok=True)
        for e in pipeline.presets():  # gold sets are made by hand and small
            rows = word_diff(saved.filter(F.col("experiment") == e.name), "key", "extracted", "gold_text").orderBy("key").toLocalIterator()
            Path(a.diff_dir, f"diff_{e.name}.txt").write_text(diff_text(e.name, rows), encoding="utf-8")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="skriftverk", description=__doc__)
    sub = p.add_subparsers(required=True)
    x = sub.add_parser("extract")
    x.add_argument("input")
    x.add_argument("output")
    x.add_argument("--manifest")
    x.set_defaults(run=extract)
    x = sub.add_parser("dedup")
    x.add_argument("input")
    x.add_argument("output")
    x.add_argument("--settle-seconds", type=int, default=300)
    x.set_defaults(run=deduplicate)
    x = sub.add_parser("evaluate")
    x.add_argument("--gold-dir", default="gold_dir")
    x.add_argument("--doc-id")
    x.add_argument("--output-dir")
    x.add_argument("--diff-dir", default="diffs")
    x.set_defaults(run=evaluate)
    a = p.parse_args(argv)
    spark = build_session()
    ship(spark)
    a.run(spark, a)


if __name__ == "__main__":
    main()
