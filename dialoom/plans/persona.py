"""Persona documents: a strict Markdown reader on the driver, and its parts as small DataFrames."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..functions.rules import PersonaError
from ..functions.text import ASSISTANT_TAG, HANGUL_SYLLABLES, USER_TAG, bigrams_of

# Section headings and the rows that the core table must have.
CORE, CONSTRAINTS, PRINCIPLES = "핵심 정의", "제약", "발화 원칙"
SITUATIONS, BACKGROUND, PROHIBITIONS = "다룰 상황", "배경", "하지 않는 말과 행동"
VOCABULARY, FLOWS, EXAMPLES = "어휘와 표현", "대화 흐름", "예시 대화"
CORE_ROWS = ("이름", "정체성", "사용자와의 관계", "말투", "성격", "응답 길이", "지식 범위")


@dataclass(frozen=True)
class Persona:
    core: dict[str, str]
    constraints: dict[str, str]
    principles: tuple[str, ...]
    situations: tuple[str, ...]
    background: str | None = None
    prohibitions: tuple[str, ...] = ()
    vocabulary: dict[str, tuple[str, ...]] = field(default_factory=dict)
    flows: tuple[str, ...] = ()
    examples: tuple[tuple[tuple[str, str], ...], ...] = ()
    sha256: str = ""

    @property
    def name(self) -> str:
        return self.core["이름"]

    @property
    def beats(self) -> tuple[str, ...]:
        return tuple(part for line in self.situations for part in _listed(line))

    def signal(self, letters: str = HANGUL_SYLLABLES) -> list[str]:
        """Bigrams that mark a text as belonging to this persona's topics."""
        words = [*self.beats, *self.vocabulary, *(w for row in self.vocabulary.values() for w in row), self.background or ""]
        return sorted(set().union(*(bigrams_of(w, letters) for w in words)))

    def system_prompt(self) -> str:
        blocks = ["\n".join(f"{k}: {v}" for k, v in self.core.items())]
        if self.background:
            blocks.append(f"{BACKGROUND}:\n{self.background}")
        blocks.append("\n".join([f"{PRINCIPLES}:", *(f"{n}. {p}" for n, p in enumerate(self.principles, 1))]))
        if self.prohibitions:
            blocks.append("\n".join([f"{PROHIBITIONS}:", *(f"- {p}" for p in self.prohibitions)]))
        return "\n\n".join(blocks)


def _plain(cell: str) -> str:
    return re.sub(r"\*\*|`", "", cell).strip()


def _listed(cell: str) -> tuple[str, ...]:
    return tuple(x for x in map(str.strip, cell.split(",")) if x)


def _table(body: str, section: str) -> dict[str, str]:
    rows = [[c.strip() for c in line.strip().strip("|").split("|")] for line in body.splitlines() if line.strip().startswith("|")]
    rule = [k for k, cells in enumerate(rows) if all(re.fullmatch(r"[-: ]*", c) for c in cells)]
    drop = {*rule, *(k - 1 for k in rule[-1:])}  # the ruler and the heading above it
    kept = [cells for k, cells in enumerate(rows) if k not in drop]
    if wrong := next((cells for k, cells in enumerate(rows) if k not in rule and len(cells) != 2), None):
        raise PersonaError(f"section {section!r}: a row has not two columns: {wrong}")
    if not kept:
        raise PersonaError(f"section {section!r} has no table of two columns")
    return {_plain(a): _plain(b) for a, b in kept}


def _items(body: str, section: str, mark: str, stop: bool) -> tuple[str, ...]:
    """List items with indented continuations; with ``stop`` prose after the list ends it."""
    items: list[str] = []
    for line in body.splitlines():
        if m := re.match(mark, line):
            items.append(line[m.end() :].strip())
        elif items and line[:1] in (" ", "\t") and line.strip():
            items[-1] = f"{items[-1]} {line.strip()}"
        elif items and line.strip() and stop:
            break
    if not items:
        raise PersonaError(f"section {section!r} has no list")
    return tuple(map(_plain, items))


def _example(block: str) -> tuple[tuple[str, str], ...]:
    lines = [line.strip() for line in block.splitlines() if line.strip()]
    turns = []
    for k, line in enumerate(lines):
        tag, role = ((USER_TAG, "user"), (ASSISTANT_TAG, "assistant"))[k % 2]
        if not line.startswith(tag) or not line[len(tag) :].strip():
            raise PersonaError(f"line {k + 1} of an example must be {tag!r} with a text: {line!r}")
        turns.append((role, line[len(tag) :].strip()))
    if len(turns) < 2 or len(turns) % 2:
        raise PersonaError("an example needs an even number of lines, two or more")
    return tuple(turns)


def parse(text: str, required_sections: Iterable[str] = ()) -> Persona:
    """All or nothing: any missing or malformed part raises PersonaError."""
    parts = re.split(r"(?m)^##\s+(.+?)\s*$", text)
    if len(parts) < 3:
        raise PersonaError("the document has no '## ' section")
    sections = dict(zip(parts[1::2], parts[2::2], strict=True))
    for name in (*required_sections, CORE, CONSTRAINTS, PRINCIPLES, SITUATIONS):
        if name not in sections:
            raise PersonaError(f"section {name!r} is missing; there are {sorted(sections)}")
    core = _table(sections[CORE], CORE)
    if missing := [k for k in CORE_ROWS if k not in core]:
        raise PersonaError(f"section {CORE!r} lacks the rows {missing}")
    if not core["이름"]:
        raise PersonaError("the name is empty")
    number, bullet = r"\s*\d+\.\s", r"-\s+"
    return Persona(
        core=core,
        constraints=_table(sections[CONSTRAINTS], CONSTRAINTS),
        principles=_items(sections[PRINCIPLES], PRINCIPLES, number, True),
        situations=_items(sections[SITUATIONS], SITUATIONS, number, True),
        background=sections.get(BACKGROUND, "").strip() or None,
        prohibitions=_items(sections[PROHIBITIONS], PROHIBITIONS, bullet, False) if PROHIBITIONS in sections else (),
        vocabulary={k: _listed(v) for k, v in _table(sections[VOCABULARY], VOCABULARY).items()} if VOCABULARY in sections else {},
        flows=_items(sections[FLOWS], FLOWS, bullet, False) if FLOWS in sections else (),
        examples=tuple(_example(b) for b in re.findall(r"(?s)```text\n(.*?)\n```", sections.get(EXAMPLES, ""))),
        sha256=hashlib.sha256(text.encode()).hexdigest(),
    )


@functools.lru_cache(maxsize=8)
def load(path: str, required_sections: tuple[str, ...] = ()) -> Persona:
    file = Path(path)
    if not file.exists():
        raise PersonaError(f"no persona document at {path}")
    return parse(file.read_text(encoding="utf-8"), required_sections)


def beats_table(spark: SparkSession, persona: Persona) -> DataFrame:
    return spark.createDataFrame(list(enumerate(persona.beats)), "beat_index int, beat string")


def vocabulary_table(spark: SparkSession, persona: Persona) -> DataFrame:
    return spark.createDataFrame([(k, list(v)) for k, v in persona.vocabulary.items()], "label string, examples array<string>")


def constraints_table(spark: SparkSession, persona: Persona) -> DataFrame:
    return spark.createDataFrame(list(persona.constraints.items()), "rule string, value string")
