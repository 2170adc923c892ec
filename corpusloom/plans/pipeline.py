"""Stages over folders: each reads a tier, writes the next with a manifest, and is left out if a finished tier was made with the same settings."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import DatasetPlan, Settings, apply_plan
from corpusloom.functions.lineage import Scratch
from corpusloom.operators import profile, sft
from corpusloom.plans.clean import clean
from corpusloom.plans.extract import extract
from corpusloom.plans.integrate import integrate
from corpusloom.sources import records

RAW = "source_url string, html string, content string, license string, crawl_ts string, content_type string, pdf_path string, title string"
EXTRACTED = "id string, text string, source_url string, crawl_ts string, license string, extractor string, title string"
PROV = "struct<source_url:string,crawl_ts:timestamp,license:string,extractor:string,pipeline_version:string,seed:int,filters_passed:array<string>,synthetic:boolean,synth_model:string,is_publishable:boolean>"
CLEAN = f"id string, text string, lang string, quality double, pii_found array<string>, prov {PROV}, messages {sft.MESSAGES}"
DATASET = f"messages {sft.MESSAGES}, conversations array<struct<from:string,value:string>>, instruction string, output string, text string, lang string, meta struct<id:string,lang:string>"


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds seq, by the order in which Spark reads the files: the same for the same files and settings."""
    return rows.withColumn("seq", F.monotonically_increasing_id())


class Runner:
    """now: the time that stands for unreadable ones, so that a run can be repeated exactly. backend, pdf: extractors of extract(), scorer: that of clean().
    Raw and extracted tiers count and drop malformed lines; the later stages read what a stage wrote and fail on them."""

    def __init__(self, spark: SparkSession, settings: Settings | None = None, now: Column | None = None, scorer=None, backend=None, pdf=None):
        self.spark, self.s, self.now, self.scorer, self.backend, self.pdf = spark, settings or Settings(), now, scorer, backend, pdf
        self.metrics: list[dict] = []

    def _stage(self, name: str, source: str, target: str, work: Callable[[], tuple[DataFrame, DataFrame]]) -> dict:
        config = records.config_hash(self.s, name, source)
        if records.is_done(self.spark, target, config):
            return records.read_manifest(self.spark, target)
        began = time.time()
        out, status = work()
        records.write_jsonl(out, target)
        manifest = records.drop_counts(status) | {"stage": name, "config": config}
        records.write_manifest(self.spark, target, manifest)
        self.metrics.append({"stage": name, "seconds": round(time.time() - began, 3), "seen": manifest["seen"], "kept": manifest["kept"]} | {f"dropped:{k}": v for k, v in manifest["dropped"].items()})
        return manifest

    def extract(self, source: str, target: str) -> dict:
        def work():
            raw = records.read_jsonl(self.spark, source, RAW)
            if records.exists(self.spark, source):  # pages as files, of which sidecars are no records
                raw = raw.filter(~F.endswith(F.input_file_name(), F.lit(".meta.json")))
                raw = raw.unionByName(records.read_html(self.spark, source).withColumn("bad_json", F.lit(False)), allowMissingColumns=True)
            rows = Scratch(self.spark).cut(extract(raw, self.backend, pdf=self.pdf))
            reason = F.when(F.col("bad_json"), "bad_json").otherwise(F.col("drop_reason"))
            return rows.filter("NOT bad_json AND drop_reason IS NULL").select("id", "text", "source_url", "crawl_ts", "license", "extractor", "title"), rows.select(reason.alias("drop_reason"))

        return self._stage("extract", source, target, work)

    def clean(self, source: str, target: str, benchmark: DataFrame | None = None) -> dict:
        def work():
            raw = records.read_jsonl(self.spark, source, EXTRACTED)
            rows = Scratch(self.spark).cut(_numbered(raw))
            out, status = clean(rows.filter("NOT bad_json").drop("bad_json", "id", "title"), self.s, benchmark, self.scorer, self.now)
            bad = rows.filter("bad_json").select(F.lit("bad_json").alias("drop_reason"))
            return out.drop("seq"), status.select("drop_reason").unionByName(bad)

        return self._stage("clean", source, target, work)

    def build(self, source: str, target: str) -> dict:
        def work():
            gated = sft.gate(records.read_jsonl(self.spark, source, CLEAN, strict=True).drop("bad_json"))
            lines = sft.serialize(gated.filter("drop_reason IS NULL"), self.s.build.format)
            return lines.select(F.from_json("record", self._line_schema()).alias("r")).select("r.*"), gated.select("drop_reason")

        return self._stage("build", source, target, work)

    def _line_schema(self) -> str:
        body = {"chatml": f"messages {sft.MESSAGES}", "sharegpt": "conversations array<struct<from:string,value:string>>", "alpaca": "instruction string, input string, output string"}[self.s.build.format]
        return f"{body}, meta struct<id:string,lang:string,{PROV.removeprefix('struct<')}"

    def profile(self, source: str, target: str) -> None:
        rows = records.read_jsonl(self.spark, source, CLEAN, strict=True)
        f = Scratch(self.spark).cut(profile.facts(rows.select(F.xxhash64("id").alias("seq"), "text", "lang", "pii_found", F.col("prov.license").alias("license"), F.col("prov.source_url").alias("source_url"))))
        stats = profile.length_stats(f).select(F.lit("length_stats").alias("metric"), F.to_json(F.struct("*")).alias("key"), F.col("n_docs").alias("n"))
        told = profile.suggestions(f).select(F.concat(F.lit("suggestion:"), "kind").alias("metric"), "key", "n")
        pii = profile.pii_counts(f).select(F.lit("pii").alias("metric"), F.col("type").alias("key"), "n")
        records.write_jsonl(profile.distributions(f).unionByName(pii).unionByName(stats).unionByName(told), target)

    def integrate(self, base: str, new: str, target: str) -> None:
        both = records.label_sources(records.read_jsonl(self.spark, base, DATASET, strict=True), records.read_jsonl(self.spark, new, DATASET, strict=True), self.s.integrate.source_priority).drop("bad_json")
        rows = Scratch(self.spark).cut(_numbered(both))
        out, manifest = integrate(rows, self.s)
        records.write_jsonl(out.drop("seq", "_source"), target)
        records.write_manifest(self.spark, target, {"seed": self.s.seed, "langs": {r.lang: r.asDict() for r in manifest.collect()}})

    def report(self) -> str:
        """A Markdown table of the funnel, and whether anything came through."""
        lines = ["| stage | seen | kept | seconds |", "|-|-|-|-|", *[f"| {m['stage']} | {m['seen']} | {m['kept']} | {m['seconds']} |" for m in self.metrics]]
        return "\n".join([*lines, "", "PASS" if self.metrics and self.metrics[-1]["kept"] else "FAIL"])


def execute_plan(spark: SparkSession, plan: DatasetPlan, settings: Settings, base: str, now: Column | None = None) -> Runner:
    """Extract, clean, profile and build of raw pages that are there, with the settings the plan asks for."""
    runner = Runner(spark, apply_plan(settings, plan), now)
    runner.extract(f"{base}/raw", f"{base}/extracted")
    runner.clean(f"{base}/extracted", f"{base}/clean")
    runner.profile(f"{base}/clean", f"{base}/profile")
    runner.build(f"{base}/clean", f"{base}/dataset")
    return runner
