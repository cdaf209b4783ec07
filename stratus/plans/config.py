"""Pipeline configuration: dictionaries, JSON or YAML files, environment overrides, checks.

Control plane only: a few records on the driver. Unknown keys are errors, so a misspelt option can't be ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

STAGE_TYPES = ("means", "metrics", "validation", "custom")
VALIDATORS = {"qaqc": "qaqc", "spatial": "spatial_outliers", "spatial_outliers": "spatial_outliers", "precipitation": "precipitation"}
ENV_PREFIX = "STRATUS_"


@dataclass
class Stage:
    """One step: its type, what it depends on (optional ones may fail) and its options; retry settings are accepted, and left to Spark's own for tasks."""

    id: str
    type: str = "custom"
    depends_on: tuple[str, ...] = ()
    optional_inputs: tuple[str, ...] = ()
    options: dict[str, Any] = field(default_factory=dict)
    retry_attempts: int = 0
    retry_delay_seconds: float = 0.0
    memory_gb: float = 0.0
    enabled: bool = True


@dataclass
class Pipeline:
    """Stages with the settings that hold for all of them."""

    id: str
    stages: list[Stage]
    base_path: str = "."
    continue_on_stage_failure: bool = False
    memory_gb: float = 0.0
    environments: dict[str, dict] = field(default_factory=dict)
    profiles: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def levels(self) -> list[list[str]]:
        """Stage ids in order of execution; the stages of a level don't depend on each other. A cycle is an error."""
        left = {s.id: set(s.depends_on) for s in self.stages}
        out: list[list[str]] = []
        while left:
            ready = [k for k, needs in left.items() if not needs & left.keys()]
            if not ready:
                raise ValueError(f"cycle among {sorted(left)}")
            out.append(ready)
            for k in ready:
                del left[k]
        return out

    def stage(self, id_: str) -> Stage:
        return next(s for s in self.stages if s.id == id_)

    def profile(self, name: str) -> Pipeline:
        """The pipeline with the stages of a profile; dependencies outside of it are dropped."""
        if name not in self.profiles:
            raise KeyError(f"unknown profile {name}; known: {sorted(self.profiles)}")
        kept = set(self.profiles[name])
        stages = [Stage(**{**s.__dict__, "depends_on": tuple(d for d in s.depends_on if d in kept)}) for s in self.stages if s.id in kept]
        return Pipeline(**{**self.__dict__, "stages": stages})

    def warnings(self) -> list[str]:
        """What is allowed but odd."""
        used = {d for s in self.stages for d in (*s.depends_on, *s.optional_inputs)}
        out = [f"{s.id}: nothing depends on it" for s in self.stages if s.id not in used and s.depends_on == () and len(self.stages) > 1]
        out += [f"{s.id}: memory over the pipeline's" for s in self.stages if self.memory_gb and s.memory_gb > self.memory_gb]
        roots = [s.id for s in self.stages if not s.depends_on]
        leaves = [s.id for s in self.stages if s.id not in used]
        out += [f"several roots: {roots}"] if len(roots) > 1 else []
        return out + ([f"several leaves: {leaves}"] if len(leaves) > 1 else [])


def _build(cls: type, raw: Mapping[str, Any], where: str):
    known = {f.name for f in fields(cls)}
    if unknown := set(raw) - known:
        raise ValueError(f"{where}: unknown keys {sorted(unknown)}; known: {sorted(known)}")
    return cls(**{k: tuple(v) if isinstance(v, list) and k != "stages" else v for k, v in raw.items()})


def _read(path: str) -> dict:
    text = Path(path).read_text()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ModuleNotFoundError as e:
        raise RuntimeError("YAML files need PyYAML; JSON works without it") from e
    return yaml.safe_load(text)


def _cast(text: str, like: Any) -> Any:
    if isinstance(like, bool):
        return text.strip().lower() in ("1", "true", "yes", "on")
    return type(like)(text) if isinstance(like, (int, float)) else text


def _merge(base: dict, over: Mapping) -> dict:
    return base | {k: _merge(base[k], v) if isinstance(v, Mapping) and isinstance(base.get(k), dict) else v for k, v in over.items()}


def load(source: str | Mapping[str, Any], environment: str | None = None, env: Mapping[str, str] | None = None) -> Pipeline:
    """A checked pipeline. The named environment's section goes over the file, and STRATUS_<KEY> variables over both."""
    raw = dict(_read(source) if isinstance(source, str) else source)
    if environment:
        sections = raw.get("environments", {})
        if environment not in sections:
            raise KeyError(f"unknown environment {environment}; known: {sorted(sections)}")
        raw = _merge(raw, sections[environment])
    for key, value in (os.environ if env is None else env).items():
        name = key.removeprefix(ENV_PREFIX).lower()
        plain = {f.name: f.default for f in fields(Pipeline) if isinstance(f.default, (str, bool, int, float))}
        if key.startswith(ENV_PREFIX) and name in plain:
            raw[name] = _cast(value, plain[name])
    stages = [_build(Stage, s, f"stage {s.get('id')}") for s in raw.get("stages", [])]
    out = _build(Pipeline, raw | {"stages": [s for s in stages if s.enabled]}, "pipeline")
    check(out)
    return out


def check(p: Pipeline) -> None:
    """Raises for what can't run."""
    ids = [s.id for s in p.stages]
    if not ids:
        raise ValueError("no stages")
    if len(set(ids)) != len(ids):
        raise ValueError("stage ids repeat")
    for s in p.stages:
        if s.type not in STAGE_TYPES:
            raise ValueError(f"{s.id}: unknown type {s.type}")
        for d in (*s.depends_on, *s.optional_inputs):
            if d not in ids:
                raise ValueError(f"{s.id}: unknown dependency {d}")
        for v in s.options.get("validators", ()):
            if v not in VALIDATORS:
                raise ValueError(f"{s.id}: unknown validator {v}; known: {sorted(VALIDATORS)}")
    p.levels()


def default() -> dict:
    """Means, metrics and validation in a row."""
    return {"id": "default", "stages": [{"id": "means", "type": "means"}, {"id": "metrics", "type": "metrics", "depends_on": ["means"]}, {"id": "validation", "type": "validation", "depends_on": ["metrics"], "options": {"validators": list(VALIDATORS)}}]}
