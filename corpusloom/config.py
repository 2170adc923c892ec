"""Settings with their defaults and checks."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, fields, is_dataclass, replace
from pathlib import Path
from typing import Any


def _require(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(what)


@dataclass(frozen=True)
class Crawl:
    render: str = "auto"
    render_min_text_len: int = 200
    max_depth: int = 3
    per_host_concurrency: int = 4
    respect_robots: bool = True
    politeness_delay: float = 1.0
    url_exclude: list = field(default_factory=list)
    max_pages: int = 10_000

    def __post_init__(self):
        _require(self.render in ("auto", "http", "browser"), "render: auto, http or browser")
        for x in self.url_exclude:
            re.compile(x)


@dataclass(frozen=True)
class Extract:
    primary: str = "trafilatura"
    fallback: str = "readability"


@dataclass(frozen=True)
class GopherQuality:
    min_words: int = 50
    max_words: int = 100_000
    mean_word_length_min: float = 3
    mean_word_length_max: float = 10
    symbol_to_word_ratio: float = 0.1
    bullet_line_ratio: float = 0.9
    ellipsis_line_ratio: float = 0.3
    alpha_word_ratio: float = 0.8
    min_stopwords: int = 2


@dataclass(frozen=True)
class ViOverrides:
    use_vi_stopwords: bool = True
    disable_word_len_rule: bool = True


@dataclass(frozen=True)
class MinHash:
    ngram: int = 5
    num_hashes: int = 112
    bands: int = 14
    rows: int = 8
    scope: str = "per_source"

    def __post_init__(self):
        _require(self.scope in ("per_source", "per_crawl"), "the scope of near-duplicates is never global here")
        _require(self.bands * self.rows <= self.num_hashes, "bands x rows is more than num_hashes")


@dataclass(frozen=True)
class Pii:
    backend: str = "presidio"
    vi_regex: bool = True
    presidio_langs: list = field(default_factory=lambda: ["en"])


@dataclass(frozen=True)
class Decontam:
    benchmarks: list = field(default_factory=lambda: ["mmlu", "aime", "math500", "mgsm"])
    ngram: int = 13


@dataclass(frozen=True)
class Quality:
    enabled: bool = False
    backend: str = "fasttext"
    model_path: str | None = None
    positive_label: str = "__label__hq"
    min_score: float = 0.5

    def __post_init__(self):
        _require(0 <= self.min_score <= 1, "min_score lies in [0, 1]")


@dataclass(frozen=True)
class Clean:
    lang_allow: list = field(default_factory=lambda: ["vi", "en"])
    lang_score_min: dict = field(default_factory=lambda: {"vi": 0.60, "en": 0.65})
    gopher_quality: GopherQuality = field(default_factory=GopherQuality)
    vi_overrides: ViOverrides = field(default_factory=ViOverrides)
    minhash: MinHash = field(default_factory=MinHash)
    pii: Pii = field(default_factory=Pii)
    decontam: Decontam = field(default_factory=Decontam)
    quality: Quality = field(default_factory=Quality)

    def __post_init__(self):
        _require(all(0 <= v <= 1 for v in self.lang_score_min.values()), "language scores lie in [0, 1]")


@dataclass(frozen=True)
class Cluster:
    enabled: bool = False
    max_docs: int = 2000
    min_cluster_size: int = 5


@dataclass(frozen=True)
class Synth:
    enabled: bool = False
    questions_per_doc: int = 2
    max_chars: int = 4000

    def __post_init__(self):
        _require(1 <= self.questions_per_doc <= 10, "questions_per_doc lies in 1..10")


@dataclass(frozen=True)
class Build:
    format: str = "chatml"
    synth: Synth = field(default_factory=Synth)

    def __post_init__(self):
        _require(self.format in ("chatml", "sharegpt", "alpaca"), "format: chatml, sharegpt or alpaca")


@dataclass(frozen=True)
class Integrate:
    cross_dedup: bool = True
    source_priority: list = field(default_factory=lambda: ["curated_v2", "crawl_new"])
    mix_ratios: dict = field(default_factory=lambda: {"vi": 0.5, "en": 0.5})

    def __post_init__(self):
        _require(abs(sum(self.mix_ratios.values()) - 1) <= 1e-3, "mix_ratios add up to 1")


@dataclass(frozen=True)
class Settings:
    seed: int = 42
    pipeline_version: str = "1.3.0"
    crawl: Crawl = field(default_factory=Crawl)
    extract: Extract = field(default_factory=Extract)
    clean: Clean = field(default_factory=Clean)
    cluster: Cluster = field(default_factory=Cluster)
    build: Build = field(default_factory=Build)
    integrate: Integrate = field(default_factory=Integrate)


def from_dict(cls, data: dict[str, Any]):
    """A settings object of nested dicts; unknown keys are left out."""
    values = {}
    for f in fields(cls):
        if f.name in data:
            default = f.default_factory() if callable(f.default_factory) else f.default
            values[f.name] = from_dict(type(default), data[f.name]) if is_dataclass(default) else data[f.name]
    return cls(**values)


def load(path: str | None = None) -> Settings:
    """From YAML: the path given, else the one in CORPUSLOOM_CONFIG, else the defaults."""
    path = path or os.environ.get("CORPUSLOOM_CONFIG")
    if not path:
        return Settings()
    import yaml

    data = yaml.safe_load(Path(path).read_text()) or {}
    return from_dict(Settings, data | data.get("global", {}))


@dataclass(frozen=True)
class DatasetPlan:
    goal: str
    seeds: list
    criteria: list = field(default_factory=list)
    max_depth: int = 2
    max_pages: int = 1000
    render: str = "auto"
    lang_allow: list = field(default_factory=list)
    build_format: str = "chatml"
    quality_min_score: float | None = None
    url_exclude: list = field(default_factory=list)
    notes: str = ""

    def __post_init__(self):
        _require(bool(self.seeds) and all(re.match(r"https?://", s) for s in self.seeds), "a plan has http(s) seeds")
        _require(0 <= self.max_depth <= 6 and 1 <= self.max_pages <= 20_000, "max_depth lies in 0..6, max_pages in 1..20000")
        for x in self.url_exclude:
            re.compile(x)


def apply_plan(s: Settings, plan: DatasetPlan) -> Settings:
    """Only what a plan may change: crawl depth, pages, rendering and exclusions, languages, format, and the quality threshold if the classifier is on."""
    exclude = list(dict.fromkeys([*s.crawl.url_exclude, *plan.url_exclude]))
    crawl = replace(s.crawl, max_depth=plan.max_depth, max_pages=plan.max_pages, render=plan.render, url_exclude=exclude)
    quality = s.clean.quality
    if quality.enabled and plan.quality_min_score is not None:
        quality = replace(quality, min_score=plan.quality_min_score)
    clean = replace(s.clean, lang_allow=list(plan.lang_allow) or s.clean.lang_allow, quality=quality)
    return replace(s, crawl=crawl, clean=clean, build=replace(s.build, format=plan.build_format))
