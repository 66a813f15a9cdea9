"""The modules that hold queries."""

from __future__ import annotations

from importlib import import_module

MODULES: tuple[str, ...] = ("loamline.plans.q_scans", "loamline.plans.q_shaping", "loamline.plans.q_joins", "loamline.plans.q_dedup", "loamline.plans.q_aggregates", "loamline.plans.q_windows", "loamline.plans.q_tokens", "loamline.plans.q_runs", "loamline.plans.q_more")


def registries() -> list:
    return [import_module(m).registry for m in MODULES]
