"""Pipeline configuration: JSON to checked, typed settings; every mistake is a ConfigError."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping
from dataclasses import MISSING, dataclass, field, fields
from pathlib import Path
from typing import Any

from .registry import GROUPS, load_plugins

#: Stages in the order of their data; a stage needs those named.
NEEDS = {"ingest": (), "dialogue": (), "respond": ("ingest",), "filter": ("dialogue", "respond"), "assemble": ("filter",), "export": ("assemble",)}
SESSION_STAGES = ("dialogue", "respond")


class ConfigError(ValueError):
    """The configuration cannot be used."""


def settings(kind: type, raw: Any, where: str):
    """A dataclass from a mapping: no unknown keys, no missing ones."""
    if not isinstance(raw, Mapping):
        raise ConfigError(f"{where}: an object is needed, not {type(raw).__name__}")
    known = {f.name: f for f in fields(kind)}
    if unknown := sorted(set(raw) - set(known)):
        raise ConfigError(f"{where}: unknown keys {unknown}; allowed: {sorted(known)}")
    if missing := sorted(n for n, f in known.items() if n not in raw and f.default is MISSING and f.default_factory is MISSING):
        raise ConfigError(f"{where}: missing keys {missing}")
    return kind(**raw)


def number(where: str, value: Any, least: float, whole: bool = False, above: bool = False) -> float:
    """A finite number, no boolean, not under (or, with ``above``, at) the least allowed."""
    ok = not isinstance(value, bool) and isinstance(value, int | float) and math.isfinite(value) and (not whole or float(value).is_integer())
    if not ok or value < least or (above and value == least):
        raise ConfigError(f"{where}: {'a whole' if whole else 'a'} number {'over' if above else 'of at least'} {least} is needed, not {value!r}")
    return int(value) if whole else float(value)


@dataclass(frozen=True)
class Teacher:
    model: str
    base_url: str = ""
    kind: str = "openai"
    temperature: float = 1.0
    top_p: float = 0.95
    max_tokens: int = 256
    concurrency: int = 64
    timeout: float = 300.0
    api_key: str | None = None


@dataclass(frozen=True)
class Source:
    format: str
    language: str
    license: str
    fields: list[str]
    url: str | None = None
    path: str | None = None
    extract: dict = field(default_factory=dict)

    def check(self, where: str) -> None:
        if bool(self.url) == bool(self.path):
            raise ConfigError(f"{where}: exactly one of url and path is needed")
        if not self.fields:
            raise ConfigError(f"{where}: fields are empty")
        if not re.fullmatch("[a-z]{2}", str(self.language).lower()):
            raise ConfigError(f"{where}: language must be a code of two letters, not {self.language!r}")


@dataclass(frozen=True)
class Student:
    model: str
    trust_remote_code: bool = True
    chat_template: str = "chatml"


@dataclass(frozen=True)
class Ingest:
    sources: list[str]
    teacher: str | None = None
    translator: str = "teacher"
    limit_per_source: int = 0
    min_chars: int = 2
    max_chars: int = 60
    topic_min_hits: int = 1
    download_timeout: float = 60
    blocked_stems: list[str] | None = None


@dataclass(frozen=True)
class Dialogue:
    teacher: str
    per_situation: int = 1
    turns: list[int] | None = None


@dataclass(frozen=True)
class Respond:
    teacher: str
    limit: int = 0


@dataclass(frozen=True)
class Filter:
    max_identical_assistant_turns: int = 20
    min_turns: int = 2
    max_turns: int = 16


@dataclass(frozen=True)
class Assemble:
    ratios: dict[str, float]
    max_sessions: int
    split: dict[str, float]


@dataclass(frozen=True)
class Export:
    name: str
    recipe: dict
    tokenizer: str | None = None


STAGES = {"ingest": Ingest, "dialogue": Dialogue, "respond": Respond, "filter": Filter, "assemble": Assemble, "export": Export}
_LEAST = {"limit_per_source": 0, "min_chars": 1, "max_chars": 1, "topic_min_hits": 0, "per_situation": 1, "limit": 0, "max_identical_assistant_turns": 1, "min_turns": 2, "max_turns": 2, "max_sessions": 1}


@dataclass(frozen=True)
class Pipeline:
    root: Path
    profile: str
    language: str
    seed: int
    persona_doc: Path
    data_root: Path
    datasets_root: Path
    student: Student
    teachers: dict[str, Teacher]
    sources: dict[str, Source]
    stages: dict[str, Any]
    plugins: tuple[str, ...] = ()
    path: Path | None = None
    raw: dict = field(default_factory=dict)

    def session_stages(self) -> list[str]:
        plugged = GROUPS["stages"].mapping()
        return [s for s in self.stages if s in SESSION_STAGES or (s in plugged and plugged[s].sessions)]

    def validate(self) -> None:
        """What stages ask of each other, before any job."""
        if "assemble" not in self.stages:
            raise ConfigError("stages.assemble is needed")
        if "respond" in self.stages and "ingest" not in self.stages:
            raise ConfigError("stages.respond needs stages.ingest")
        if "filter" not in self.stages:
            raise ConfigError("stages.filter is needed: assemble reads what it keeps")
        a = self.stages["assemble"]
        if extra := sorted(set(a.ratios) - set(self.session_stages())):
            raise ConfigError(f"stages.assemble.ratios: {extra} make no sessions")
        if abs(sum(a.ratios.values()) - 1) > 1e-6:
            raise ConfigError("stages.assemble.ratios must add up to 1")
        if set(a.split) != {"train", "val", "test"} or abs(sum(a.split.values()) - 1) > 1e-6:
            raise ConfigError("stages.assemble.split needs train, val and test adding up to 1")

    def _needs(self, stage: str) -> tuple[str, ...]:
        plugged = GROUPS["stages"].mapping()
        if stage == "filter":  # after every stage that makes sessions
            return tuple(self.session_stages())
        return plugged[stage].needs if stage in plugged else NEEDS[stage]

    def order(self, only: str | None = None) -> list[str]:
        """Configured stages, each after those it needs."""
        done: list[str] = []
        rest = list(self.stages)
        while rest:
            ready = [s for s in rest if not set(self._needs(s)) & set(rest)]
            if not ready:
                raise ConfigError(f"stages need each other: {rest}")
            done += ready
            rest = [s for s in rest if s not in ready]
        if only is not None and only not in done:
            raise ConfigError(f"stage {only!r} is not configured; there are {done}")
        return [s for s in done if only in (None, s)]


def parse(raw: Any, root: Path, path: Path | None = None) -> Pipeline:
    """Checked settings; plug-ins are loaded first, since they may bring stages."""
    if not isinstance(raw, Mapping):
        raise ConfigError("the configuration must be an object")
    for key in ("profile", "language", "seed", "persona_doc", "student", "stages"):
        if key not in raw:
            raise ConfigError(f"missing key {key!r}")
    allowed = {"profile", "language", "seed", "persona_doc", "student", "stages", "teachers", "sources", "plugins", "data_root", "datasets_root"}
    if unknown := sorted(set(raw) - allowed):
        raise ConfigError(f"unknown keys {unknown}")
    load_plugins(raw.get("plugins", ()), str(root))
    sources = {n: settings(Source, s, f"source {n!r}") for n, s in raw.get("sources", {}).items()}
    for n, s in sources.items():
        s.check(f"source {n!r}")
    stages, plugged = {}, GROUPS["stages"].mapping()
    for name, values in raw["stages"].items():
        if name not in STAGES and name not in plugged:
            raise ConfigError(f"unknown stage {name!r}; known: {[*STAGES, *plugged]}")
        s = stages[name] = settings(plugged[name].settings if name in plugged else STAGES[name], values, f"stages.{name}")
        if name in plugged:
            continue
        for key, least in _LEAST.items():
            if hasattr(s, key):
                number(f"stages.{name}.{key}", getattr(s, key), least, whole=True)
    teachers = {n: settings(Teacher, t, f"teacher {n!r}") for n, t in raw.get("teachers", {}).items()}
    if (d := stages.get("dialogue")) is not None and d.turns is not None:
        if not isinstance(d.turns, list) or not d.turns:
            raise ConfigError(f"stages.dialogue.turns: a list of whole numbers is needed, not {d.turns!r}")
        for turn in d.turns:
            number("stages.dialogue.turns", turn, 1, whole=True)
    if (a := stages.get("assemble")) is not None:
        for key, shares in (("ratios", a.ratios), ("split", a.split)):
            if not isinstance(shares, Mapping) or not shares:
                raise ConfigError(f"stages.assemble.{key}: an object of shares is needed, not {shares!r}")
            for name, share in shares.items():
                number(f"stages.assemble.{key}.{name}", share, 0)
    for name, s in stages.items():
        if (teacher := getattr(s, "teacher", None)) is not None and teacher not in teachers:
            raise ConfigError(f"stages.{name}: no teacher {teacher!r}")
    if "ingest" in stages and (missing := sorted(set(stages["ingest"].sources) - set(sources))):
        raise ConfigError(f"stages.ingest: no sources {missing}")
    language = str(raw["language"]).lower()
    if not re.fullmatch("[a-z]{2}", language):
        raise ConfigError("language must be a code of two letters")
    return Pipeline(
        root=root,
        profile=raw["profile"],
        language=language,
        seed=int(number("seed", raw["seed"], 0, whole=True)),
        persona_doc=root / raw["persona_doc"],
        data_root=root / raw.get("data_root", "data"),
        datasets_root=root / raw.get("datasets_root", "datasets"),
        student=settings(Student, raw["student"], "student"),
        teachers=teachers,
        sources=sources,
        stages=stages,
        plugins=tuple(raw.get("plugins", ())),
        path=path,
        raw=dict(raw),
    )


def load(path: str | Path) -> Pipeline:
    path = Path(path)
    try:
        raw = json.loads(path.read_text(encoding="utf-8"))
    except OSError as e:
        raise ConfigError(f"cannot read {path}: {e}") from e
    except ValueError as e:
        raise ConfigError(f"{path} is not JSON: {e}") from e
    return parse(raw, path.resolve().parent, path.resolve())
