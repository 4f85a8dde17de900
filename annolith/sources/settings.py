"""Settings of model clients from KEY=VALUE text and the environment, and run configurations from command-line flags."""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from annolith.plans.planner import RunConfig

# Names of settings, by field, first found wins, with the default.
NAMES = {
    "api_key": (("OPENAI_API_KEY", "LLM_API_KEY"), None),
    "base_url": (("BASE_URL", "LLM_BASE_URL"), None),
    "api_version": (("API_VERSION",), "2024-08-01-preview"),
    "model": (("MODEL",), "azure/gpt-4o"),
    "generator_model": (("GENERATOR_MODEL",), None),
    "verifier_model": (("VERIFIER_MODEL",), None),
    "deployment_name": (("DEPLOYMENT_NAME",), "gpt-4o"),
    "api_style": (("OPENAI_API_STYLE",), "auto"),
    "temperature": (("TEMPERATURE",), "0.2"),
    "max_tokens": (("MAX_TOKENS",), "2500"),
    "timeout_seconds": (("LLM_TIMEOUT_SECONDS",), "120"),
    "retries": (("LLM_INFRASTRUCTURE_RETRIES",), "3"),
}
STYLES = ("auto", "azure", "openai")


@dataclass(frozen=True)
class Settings:
    api_key: str
    base_url: str
    api_version: str
    model: str
    generator_model: str
    verifier_model: str
    deployment_name: str
    api_style: str
    temperature: float
    max_tokens: int
    timeout_seconds: float
    retries: int


def parse_pairs(text: str) -> dict[str, str]:
    """KEY=VALUE lines; blank lines, comments and lines without = are passed over, quotes around a value go."""
    found = {}
    for line in text.splitlines():
        key, equals, value = line.strip().partition("=")
        if equals and key and not key.startswith("#"):
            found[key.strip()] = value.strip().strip("\"'")
    return found


def read_settings(text: str = "", environment: Mapping[str, str] | None = None) -> Settings:
    """Settings from the environment and, where it has none, from KEY=VALUE text; a role's model falls back to `model`."""
    have = {**parse_pairs(text), **(os.environ if environment is None else environment)}
    got = {field: next((have[n] for n in names if have.get(n)), default) for field, (names, default) in NAMES.items()}
    if not got["api_key"]:
        raise ValueError("OPENAI_API_KEY or LLM_API_KEY is needed")
    if not str(got["base_url"] or "").lower().startswith(("http://", "https://")):
        raise ValueError("BASE_URL is an http or https address")
    got["api_style"] = got["api_style"].strip().lower()
    if got["api_style"] not in STYLES:
        raise ValueError(f"OPENAI_API_STYLE is one of {', '.join(STYLES)}")
    got["base_url"] = got["base_url"].rstrip("/")
    for role in ("generator_model", "verifier_model"):
        got[role] = got[role] or got["model"]
    kinds = {"temperature": float, "max_tokens": int, "timeout_seconds": float, "retries": int}
    return Settings(**{k: kinds.get(k, str)(v) for k, v in got.items()})


def flags_config(args: list[str], taxonomy: str = "taxonomy") -> RunConfig:
    """A run configuration from --focus-labels A,B --samples N [--hard-negative]: one sample type only."""
    parser = argparse.ArgumentParser(prog="annolith", exit_on_error=False)
    parser.add_argument("--focus-labels", required=True)
    parser.add_argument("--samples", type=int, default=10)
    parser.add_argument("--hard-negative", action="store_true")
    got = parser.parse_args(args)
    chosen = "hard_negative" if got.hard_negative else "positive"
    labels = [x for x in got.focus_labels.split(",") if x.strip()]
    return RunConfig(run_name=f"json-{taxonomy}", num_samples=got.samples, focus_labels=labels, sample_type_distribution={k: float(k == chosen) for k in ("positive", "pure_negative", "hard_negative")})


REQUEST = "run_name string, num_samples int, labels string, hard_negative double, generator_model string, verifier_model string, base_url string, api_key string, max_tokens int, retries int, error string"


def run_requests(rows: DataFrame, key: str) -> DataFrame:
    """(key, run_name, ..., error) of rows (key, flags array<string>, settings KEY=VALUE text): many runs' requests, read in parallel.

    A request that can't be read has its reason as error and nulls elsewhere; null flags or settings are empty ones."""

    def one(flags, settings) -> tuple:
        try:
            c, s = flags_config([str(x) for x in (flags if flags is not None else ())]), read_settings(settings or "", {})
        except (ValueError, argparse.ArgumentError, SystemExit) as e:
            return (None,) * 10 + (str(e) or "the flags can't be read",)
        return (c.run_name, c.num_samples, ",".join(c.focus_labels), c.sample_type_distribution["hard_negative"], s.generator_model, s.verifier_model, s.base_url, s.api_key, s.max_tokens, s.retries, None)

    names = [x.split()[0] for x in REQUEST.split(", ")]

    def run(frames):
        for pdf in frames:
            made = pd.DataFrame([one(f, t) for f, t in zip(pdf["flags"], pdf["settings"], strict=True)], columns=names)
            yield pd.concat([pdf[["key"]].reset_index(drop=True), made.astype({"num_samples": "Int32", "max_tokens": "Int32", "retries": "Int32", "hard_negative": "Float64"})], axis=1)

    kind = dict(rows.dtypes)[key]
    found = rows.select(rows[key].alias("key"), "flags", "settings").mapInPandas(run, f"key {kind}, {REQUEST}")
    return found.withColumnRenamed("key", key)
