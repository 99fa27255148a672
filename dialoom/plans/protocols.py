"""What extensions look like; any object of the shape will do, nothing need be inherited."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, SparkSession


class Format(Protocol):
    """Reads a path: the fields, and ``_row``, a long that increases with the input's order.

    An attribute ``json_cells`` that is true says that cells are JSON text.
    """

    def __call__(self, spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame: ...


class Extractor(Protocol):
    """A cell's texts, an array of strings, as an expression."""

    def __call__(self, cell: Column, settings: Mapping[str, object], json_cells: bool) -> Column: ...


class RuleFactory(Protocol):
    """Reasons with tests over a session's turns, for the persona's name and the rule's value."""

    def __call__(self, name: str, value: str) -> Sequence[tuple[str, Callable[[Column], Column]]]: ...


class Teacher(Protocol):
    """Answers ``key, system, user`` with ``key, text, completion_tokens``; a null text is a failure."""

    def check(self) -> None: ...

    def generate(self, requests: DataFrame) -> DataFrame: ...


class TeacherFactory(Protocol):
    def __call__(self, base_url: str, model: str, **settings: Any) -> Teacher: ...


class Translator(Protocol):
    """Rows of other languages with ``text`` in the target's, ``original_text`` and ``original_language``; failures null."""

    def __call__(self, utterances: DataFrame, answer: Callable[[DataFrame], DataFrame], target: str) -> DataFrame: ...


class Profile(Protocol):
    name: str
    assistant_label: str
    user_label: str
    turns: tuple[int, ...]
    required_sections: tuple[str, ...]
    constraints: Mapping[str, str]
    flows: tuple[str, ...]
    rule: str

    def document(self, persona_name: str) -> str: ...


class Recipe(Protocol):
    """Files of a recipe by name."""

    def __call__(
        self, name: str, model: str, cutoff_len: int, settings: Mapping[str, object], trust_remote_code: bool, template: str, folder: str, length_note: str
    ) -> Mapping[str, str]: ...


class Stage(Protocol):
    """See ``registry.StagePlugin``."""

    name: str
    settings: type
    needs: tuple[str, ...]
    sessions: bool

    def run(self, run: Any) -> dict: ...
