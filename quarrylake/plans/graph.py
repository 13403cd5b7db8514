"""Models that say what they read: built in the order that follows from it, each tested before others read it.

A model whose test fails, or that cannot be built, stops its descendants and nothing else.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame

from ..sources.lake import Lake
from . import quality

log = logging.getLogger(__name__)
Frames = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Model:
    """``make`` gets the frames named in ``reads``, ``checks`` the same with the model's own.

    A model that is ``stored`` becomes a table of the lake under its name; any other stays lazy, like a view.
    """

    name: str
    make: Callable[[Frames], DataFrame]
    reads: tuple[str, ...] = ()
    checks: Callable[[Frames], Iterable[quality.Check]] = lambda frames: ()
    stored: bool = False


@dataclass
class Outcome:
    """Frames of the models that were built, results of their tests, and each model's end: pass, warn, error or skipped."""

    frames: dict[str, DataFrame] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)
    models: dict[str, str] = field(default_factory=dict)

    @property
    def failed(self) -> list[str]:
        return sorted(name for name, end in self.models.items() if end == quality.ERROR)


def ordered(models: Iterable[Model], given: Iterable[str] = ()) -> list[Model]:
    """The models, each after all that it reads; a cycle, a name that nothing has or that two have is an error."""
    by_name: dict[str, Model] = {}
    for m in models:
        if m.name in by_name or m.name in given:
            raise ValueError(f"two models are named {m.name}")
        by_name[m.name] = m
    for m in by_name.values():
        if unknown := sorted(set(m.reads) - by_name.keys() - set(given)):
            raise ValueError(f"{m.name} reads {', '.join(unknown)}, which nothing makes")
    order = TopologicalSorter({m.name: [r for r in m.reads if r in by_name] for m in by_name.values()}).static_order()
    return [by_name[n] for n in order]


def descendants(models: Iterable[Model], name: str) -> set[str]:
    """All models that read the named one, at any distance."""
    found = {name}
    for m in ordered(models, given=[r for x in models for r in x.reads if r not in {y.name for y in models}]):
        if found & set(m.reads):
            found.add(m.name)
    return found - {name}


def run_models(lake: Lake, models: Iterable[Model], given: Frames = {}) -> Outcome:
    """Build and test all models that can be built.  ``given`` are frames that no model makes."""
    out = Outcome()
    frames = dict(given)
    for m in ordered(models, given):
        blocked = [r for r in m.reads if out.models.get(r) in (quality.ERROR, "skipped")]
        if blocked:
            out.models[m.name] = "skipped"
            log.warning("model %s is skipped, since it reads %s", m.name, ", ".join(blocked))
            continue
        mine = {r: frames[r] for r in m.reads}
        try:
            made = m.make(mine)
            made = lake.write(m.name, made) if m.stored else made
            results = quality.run_checks(m.checks(mine | {m.name: made}))
        except Exception:
            log.exception("model %s failed", m.name)
            out.models[m.name] = quality.ERROR
            continue
        out.checks |= results
        out.models[m.name] = quality.ERROR if quality.ERROR in results.values() else quality.WARN if quality.WARN in results.values() else "pass"
        out.frames[m.name] = frames[m.name] = made
    return out
