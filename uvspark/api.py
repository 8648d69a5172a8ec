"""Registries, configuration layers and a session facade over the operators."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from .plans import catalog

_OPERATIONS: dict[str, Callable[[SparkSession, str], DataFrame]] = dict(catalog.QUERIES)

DEFAULTS: dict[str, Any] = {
    "import": {"scan_gap_s": 15.0},
    "flag": {"outlier_sigma": 6.0, "window_s": 7200.0, "min_points": 4, "quack_max_s": 60.0},
    "calibrate": {"min_snr": 7.0, "dead_snr": 3.0, "weak_ratio": 5.0, "channel_fraction": 0.8},
    "phaseref": {"max_gap_s": 600.0, "bright_ratio": 3.0},
}


def merge_config(*layers: Mapping[str, Any] | None) -> dict[str, Any]:
    """Layers merged from left to right: later scalars win, mappings merge key by key."""
    out: dict[str, Any] = {}
    for layer in layers:
        for key, value in (layer or {}).items():
            out[key] = merge_config(out[key], value) if isinstance(value, Mapping) and isinstance(out.get(key), Mapping) else (merge_config(value) if isinstance(value, Mapping) else value)
    return out


def overrides(**flat: Any) -> dict[str, Any]:
    """section__key=value keywords as nested overrides; None is left out."""
    out: dict[str, Any] = {}
    for key, value in flat.items():
        if value is not None:
            section, _, name = key.partition("__")
            if name:
                out.setdefault(section, {})[name] = value
            else:
                out[section] = value
    return out


def register(name: str, query: Callable[[SparkSession, str], DataFrame], replace: bool = False) -> None:
    """Add an operation; names are unique unless replace is given."""
    if name in _OPERATIONS and not replace:
        raise ValueError(f"{name} is registered")
    _OPERATIONS[name] = query


def load_plugins(modules: list[str]) -> list[str]:
    """Import modules that offer QUERIES and register what they hold; the names added."""
    added = []
    for module in modules:
        for name, query in importlib.import_module(module).QUERIES.items():
            register(name, query)
            added.append(name)
    return added


def capabilities() -> list[str]:
    return sorted(_OPERATIONS)


class Session:
    """One data directory, its configuration, and the results asked for so far, by step."""

    def __init__(self, spark: SparkSession, directory: str, config: Mapping[str, Any] | None = None, **flat: Any):
        self.spark, self.directory = spark, directory
        self.config = merge_config(DEFAULTS, config, overrides(**flat))
        self.steps: dict[str, DataFrame] = {}

    def supports(self, name: str) -> bool:
        return name in _OPERATIONS

    def run(self, name: str, force: bool = False) -> DataFrame:
        """The lazy result of an operation; the same plan again unless forced."""
        if name not in _OPERATIONS:
            raise NotImplementedError(name)
        if force or name not in self.steps:
            self.steps[name] = _OPERATIONS[name](self.spark, self.directory)
        return self.steps[name]


def run_each(spark: SparkSession, directories: list[str], name: str) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """An operation over several data directories; a failure of one leaves the others: results and errors."""
    done, failed = {}, {}
    for directory in directories:
        try:
            done[directory] = Session(spark, directory).run(name)
        except Exception as e:  # reported, not hidden
            failed[directory] = f"{type(e).__name__}: {e}"
    return done, failed
