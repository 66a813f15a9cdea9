"""The modules of this subpackage that hold queries."""

from __future__ import annotations

from loamline.llm import blending, containers, languages, leaks, neardups, pairs, quality, spans


def registries() -> list:
    return [m.registry for m in (blending, containers, languages, leaks, neardups, pairs, quality, spans)]
