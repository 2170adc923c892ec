import json

import helpers as h
import pytest
from pyspark.sql import functions as F

from corpusloom.__main__ import main
from corpusloom.config import DatasetPlan, Settings
from corpusloom.plans.pipeline import Runner, execute_plan
from corpusloom.sources import records

PAGE = "<html><title>T</title><nav>menu</nav><article><p>{}</p></article><footer>CC BY 4.0</footer></html>"


def lines(folder):
    return [json.loads(x) for f in sorted(folder.glob("part-*")) for x in f.read_text().splitlines()]


def test_raw_pages_to_a_dataset_and_into_a_base(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    rows = [{"source_url": "https://a.example/1", "html": PAGE.format(h.EN)}, {"source_url": "https://a.example/2", "html": PAGE.format(h.EN)}, {"source_url": "https://a.example/3", "html": PAGE.format(h.VI), "license": "unknown"}, {"html": PAGE.format(h.EN)}]
    (raw / "a.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n{broken\n")
    base, now = f"file://{tmp_path}", F.lit("2026-01-01").cast("timestamp")
    runner = execute_plan(spark, DatasetPlan("g", ["https://a.example"]), Settings(), base, now)
    by = {m["stage"]: m for m in runner.metrics}
    assert (by["extract"]["seen"], by["extract"]["kept"], by["extract"]["dropped:bad_json"], by["extract"]["dropped:no_source_url"]) == (5, 3, 1, 1)
    assert by["clean"]["kept"] == 2 and by["clean"]["dropped:exact_dup"] == 1
    assert by["build"]["kept"] == 1 and by["build"]["dropped:license_unknown"] == 1
    out = lines(tmp_path / "dataset")
    assert out[0]["messages"][0]["role"] == "assistant" and out[0]["meta"]["license"] == "cc-by" and out[0]["meta"]["lang"] == "en"
    assert {x["metric"] for x in lines(tmp_path / "profile")} >= {"lang", "license", "host", "length", "length_stats"}
    assert runner.report().endswith("PASS")
    # what is finished isn't made again; other settings are
    again = Runner(spark, runner.s, now)
    assert again.clean(f"{base}/extracted", f"{base}/clean")["kept"] == 2 and again.metrics == []
    runner.integrate(f"{base}/dataset", f"{base}/dataset", f"{base}/mixed")
    assert len(lines(tmp_path / "mixed")) == 1
    assert records.read_manifest(spark, f"{base}/mixed")["langs"]["en"]["docs"] == 1


def test_command_line_takes_missing_folders(spark, tmp_path):
    for stage in ("extract", "clean", "profile", "build"):
        assert main([stage, "--in", f"file://{tmp_path}/none", "--out", f"file://{tmp_path}/{stage}"]) == 0
        assert (tmp_path / stage / "_SUCCESS").exists()


def test_pages_as_files_and_malformed_lines_of_later_stages(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "page.html").write_text(PAGE.format(h.EN))
    (raw / "page.meta.json").write_text(json.dumps({"source_url": "https://a.example/9", "license": "cc-by"}))
    runner = Runner(spark, Settings(), F.lit("2026-01-01").cast("timestamp"))
    got = runner.extract(f"file://{raw}", f"file://{tmp_path}/extracted")
    assert (got["seen"], got["kept"]) == (1, 1)
    row = lines(tmp_path / "extracted")[0]
    assert row["source_url"] == "https://a.example/9" and row["license"] == "cc-by" and h.EN[:40] in row["text"]
    # another extractor can be given
    own = Runner(spark, Settings(), backend=lambda x: F.struct(F.lit("own words").alias("text"), F.lit(None).cast("string").alias("title")))
    own.extract(f"file://{raw}", f"file://{tmp_path}/own")
    assert lines(tmp_path / "own")[0]["text"] == "own words"
    broken = tmp_path / "clean"
    broken.mkdir()
    (broken / "a.jsonl").write_text('{"id": "1", "text": "x"}\n{broken\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        runner.build(f"file://{broken}", f"file://{tmp_path}/dataset")
    with pytest.raises(Exception, match="(?i)malformed"):
        runner.integrate(f"file://{broken}", f"file://{broken}", f"file://{tmp_path}/mixed")
