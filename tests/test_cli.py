import argparse
import json

from skriftverk import __main__ as cli
from tests.test_sources import response


def test_extract_dedup_evaluate(spark, tmp_path):
    body = "Det är en lång och fin dag för oss alla i byn, och vi går till kvarnen som ligger vid sjön. "
    other = "Hon har en båt som ligger i hamnen när det är kväll, men den är inte till för att segla med. "
    for n, text in (("a", body), ("b", body), ("c", other)):
        page = f"<html><body><p>{text}</p><p>Sedan kom {n}laget med en ny plan för hur alla skulle kunna ta sig över ån utan att bli blöta.</p></body></html>".encode()
        (tmp_path / f"{n}.warc").write_bytes(response(f"https://x/nyheter/{n}", page))
    cli.extract(spark, argparse.Namespace(input=str(tmp_path), output=str(tmp_path / "out"), manifest=str(tmp_path / "done")))
    assert spark.read.json(str(tmp_path / "out")).count() == 3
    cli.extract(spark, argparse.Namespace(input=str(tmp_path), output=str(tmp_path / "again"), manifest=str(tmp_path / "done")))
    assert spark.read.schema("id string").json(str(tmp_path / "again")).count() == 0
    (tmp_path / "j").mkdir()
    rows = [{"id": "1", "text": body, "metadata": {"url": "u"}}, {"id": "2", "text": " " + body, "metadata": None}, {"id": "3", "text": other}]
    (tmp_path / "j" / "x.jsonl").write_text("\n".join(map(json.dumps, rows)))
    cli.deduplicate(spark, argparse.Namespace(input=str(tmp_path / "j"), output=str(tmp_path / "dd"), settle_seconds=-60))
    assert [spark.read.schema("id string").json(str(tmp_path / "dd" / k)).count() for k in ("kept", "exact_duplicates", "near_duplicates")] == [2, 1, 0]
    kept = spark.read.text(str(tmp_path / "dd" / "kept")).collect()
    assert {r["value"] for r in kept} == {json.dumps(rows[0]), json.dumps(rows[2])} and {r["file"] for r in kept} == {"x.jsonl"}


def test_side_by_side():
    assert cli.side_by_side("t", "a b c", "a", 3) == "\nt\nby hand | extracted\na b | a\nc   | "


def test_diff_text():
    assert cli.diff_text("a", [{"key": "1", "missing": ["x"], "extra": []}]) == "# a\n\ndocument 1\nmissing: x\nextra: -\n"
