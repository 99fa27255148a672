"""Extension points: names to objects, with where each came from."""

from __future__ import annotations

import importlib
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from importlib import metadata
from pathlib import Path
from typing import Any

from ..functions.rules import RULES
from ..operators.export import lora_recipe
from ..sources.extractors import EXTRACTORS
from ..sources.formats import FORMATS
from ..sources.teachers import ChatEndpoint, echo, translate
from .profiles import PROFILES

#: Who wins if a name is given twice: plug-ins, then entry points, then what is built in.
ORIGINS = ("plugins", "entry_point", "builtin")


class PluginError(RuntimeError):
    """A plug-in is missing or cannot be loaded."""


@dataclass(frozen=True)
class Entry:
    name: str
    value: Any
    origin: str
    path: str


class Registry:
    """One group of extensions. Entry points are looked up at the first question."""

    def __init__(self, group: str, builtin: dict[str, Any] | None = None):
        self.group, self._entries, self._looked = group, {}, False
        for name, value in (builtin or {}).items():
            self.add(name, value, "builtin")

    def add(self, name: str, value: Any, origin: str = "plugins", path: str | None = None) -> None:
        """A stronger or equal origin replaces a weaker one; the same object keeps its first origin."""
        if origin not in ORIGINS:
            raise PluginError(f"{self.group}: unknown origin {origin!r}")
        have = self._entries.get(name)
        if have and (have.value is value or ORIGINS.index(origin) > ORIGINS.index(have.origin)):
            return
        place = path or f"{getattr(value, '__module__', type(value).__module__)}:{getattr(value, '__name__', type(value).__name__)}"
        self._entries[name] = Entry(name, value, origin, place)

    def register(self, name: str):
        def keep(value):
            self.add(name, value)
            return value

        return keep

    def _look(self) -> None:
        if not self._looked:
            self._looked = True
            for point in metadata.entry_points(group=f"dialoom.{self.group}"):
                try:
                    self.add(point.name, point.load(), "entry_point", point.value)
                except Exception as e:
                    raise PluginError(f"{self.group}: entry point {point.name!r} does not load: {e}") from e

    def get(self, name: str) -> Any:
        self._look()
        if name not in self._entries:
            raise PluginError(f"{self.group}: {name!r} is not registered; there are {self.names()}")
        return self._entries[name].value

    def mapping(self) -> dict[str, Any]:
        """Names to what is registered now."""
        self._look()
        return {n: e.value for n, e in self._entries.items()}

    def names(self) -> list[str]:
        self._look()
        return sorted(self._entries)

    def describe(self) -> list[Entry]:
        self._look()
        return [self._entries[n] for n in sorted(self._entries)]

    def snapshot(self) -> dict:
        self._look()
        return dict(self._entries)

    def restore(self, entries: dict) -> None:
        self._entries = dict(entries)


GROUPS = {
    "formats": Registry("formats", FORMATS),
    "extractors": Registry("extractors", EXTRACTORS),
    "rules": Registry("rules", RULES),
    "teachers": Registry("teachers", {"fake": echo, "openai": ChatEndpoint}),
    "translators": Registry("translators", {"teacher": translate}),
    "profiles": Registry("profiles", PROFILES),
    "recipes": Registry("recipes", {"llamafactory": lora_recipe}),
    "stages": Registry("stages"),
}


@dataclass(frozen=True)
class StagePlugin:
    """A stage of a plug-in: ``run`` takes the pipeline's ``Run`` and returns counts; it runs after ``needs``.

    ``settings`` is a dataclass for its part of the configuration. One with ``sessions`` publishes a session table
    under its name in ``raw``, which filter and assemble then take like those of dialogue and respond.
    """

    name: str
    run: Callable[[Any], dict]
    settings: type
    needs: tuple[str, ...] = ()
    sessions: bool = False


def ship(context, modules: Iterable[str]) -> None:
    """Give executors the modules of plug-ins: teachers and UDFs of theirs run there."""
    for name in modules:
        origin = getattr(sys.modules.get(name), "__file__", None)
        if origin is None:
            continue
        path = Path(origin)
        if path.name != "__init__.py":
            context.addPyFile(str(path))
            continue
        top = path.parents[name.count(".") + 1]
        archive = Path(tempfile.mkdtemp(prefix="dialoom-plugin-")) / f"{name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for part in sorted(path.parent.rglob("*.py")):
                z.write(part, part.relative_to(top))
        context.addPyFile(str(archive))


def load_plugins(modules: Iterable[str], root: str | None = None) -> None:
    """Import modules that register extensions; ``root`` is importable meanwhile."""
    added = root is not None and root not in sys.path
    if added:
        sys.path.insert(0, root)
    try:
        for name in modules:
            try:
                importlib.import_module(name)
            except Exception as e:
                raise PluginError(f"plug-in module {name!r} does not load: {e}") from e
    finally:
        if added:
            sys.path.remove(root)
