"""Prompts for teachers: what a persona is, what it must keep to, what form the answer has."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import ASSISTANT_TAG, USER_TAG
from .persona import Persona
from .profiles import Profile


# Rows of the vocabulary that a request for a dialogue, or for a reply, shows.
DIALOGUE_VOCABULARY, RESPOND_VOCABULARY = 4, 5


def vocabulary_sample(persona: Persona, n: int, key: Column, seed: int) -> Column:
    """``n`` vocabulary rows as lines, others for each request: the least hashes of seed, request and row.

    Few rows a request keep a corpus from drifting to the same phrases.
    """
    rows = [F.struct(F.sha2(F.concat(F.lit(f"{seed}:"), key, F.lit(f":{k}")), 256), F.lit(f"- {k}: {', '.join(v)}").alias("line")) for k, v in persona.vocabulary.items()]
    return F.array_join(F.transform(F.slice(F.array_sort(F.array(*rows)), 1, n), lambda r: r["line"]), "\n")


def persona_block(persona: Persona, vocabulary: int, key: Column, seed: int) -> Column:
    """Who speaks and how; wishes stand beside prohibitions, which alone make teachers refuse."""
    parts = [F.lit(persona.system_prompt())]
    if persona.vocabulary:
        parts.append(F.concat(F.lit("자주 쓰는 표현 (말투의 예일 뿐이니 그대로 베끼지 않는다):\n"), vocabulary_sample(persona, vocabulary, key, seed)))
    if persona.examples:
        tag = {"user": USER_TAG, "assistant": ASSISTANT_TAG}
        parts.append(F.lit("예시:\n" + "\n".join(f"{tag[r]} {t}" for r, t in persona.examples[0])))
    return F.concat_ws("\n\n", *parts)


def constraint_lines(persona: Persona, profile: Profile) -> str:
    """The constraint table as sentences."""
    lines = [f"- {k}: 쓰지 않는다." if v == "금지" else f"- {k}: {v}" for k, v in persona.constraints.items() if v not in ("허용", "자유", "혼용")]
    return "\n".join([*lines, f"- {profile.rule}"])


def dialogue_system(persona: Persona, profile: Profile, key: Column, seed: int) -> Column:
    """The system message of one request, named by ``key``."""
    form = f"한 줄에 한 발화를 쓴다. {profile.user_label}는 {USER_TAG}, {profile.assistant_label}는 {ASSISTANT_TAG}로 시작한다."
    return F.concat_ws("\n\n", persona_block(persona, DIALOGUE_VOCABULARY, key, seed), F.lit(constraint_lines(persona, profile)), F.lit(form))


def respond_system(persona: Persona, profile: Profile, key: Column, seed: int) -> Column:
    rules = f"{constraint_lines(persona, profile)}\n- 상대의 말투가 어떻든 자기 말투로 답한다.\n- 범위 밖의 말에는 모른다고 짧게 말하고 자기 화제로 돌아온다."
    return F.concat_ws("\n\n", persona_block(persona, RESPOND_VOCABULARY, key, seed), F.lit(rules), F.lit("답변 한 줄만 쓴다."))


def dialogue_user(profile: Profile, beat: Column, flow: Column, turns: Column) -> Column:
    """One request's text; the situation comes first and the length is stated in turns of each side."""
    return F.format_string(f"상황: %s\n흐름: %s\n길이: {profile.user_label} %d번, {profile.assistant_label} %d번\n\n대화를 하나 쓴다.", beat, flow, turns, turns)
