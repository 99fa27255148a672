"""Gate rules: a constraint row of a persona becomes column predicates over a session's turns.

A rule factory takes the persona's name and the constraint's value and returns ``(reason, predicate)``
pairs, none if the value switches the rule off. Predicates look at assistant turns only.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITE_SPACE, sentence_count, strip

Predicate = Callable[[Column], Column]
Rule = list[tuple[str, Predicate]]


class PersonaError(ValueError):
    """A persona document or one of its constraints is not usable."""


# Patterns, word lists and endings that decide the verdicts.
HONORIFIC = r"(요[.!?~…]?$|요\s|습니다|입니다|세요|십시오|하십|드립니다|드려요|예요|이에요)"
POLITE_ENDINGS = (
    "습니다", "ㅂ니다", "니다",
    "습니까", "ㅂ니까", "니까",
    "십시오", "시오",
    "세요", "셔요", "시죠", "군요", "네요", "나요", "가요",
    "까요", "데요", "지요", "요", "죠",
)
TRAILING = r"""[.!?~…\s"'”’)\]]*$"""
INTERJECTION = r"(?:아니오|아니요|네|예|아|음|흠|어머|아이고|아하|오호|저런|앗|하+|허+|호+|후+|오+)"
HANGUL = r"[가-힣\x{1100}-\x{11ff}\x{3130}-\x{318f}]"
CJK = r"[\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}]"
KANA = r"[\x{3040}-\x{30ff}]"
LATIN_WORD = r"[A-Za-z]{2,}"
EMOJI = r"[\p{So}\p{Sk}\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}]"
MARKDOWN = r"(?m)(^#{1,6}\s|\*\*|^\s*[-*+]\s|^\s*\d+\.\s|```|\[.+\]\(.+\))"
ROLE_LABEL = r"(?iU)(^|\s)(U|A|P|사용자|유저|user|assistant|pet)\s*[:：]"
AI_WORDS = (
    "AI", "A.I.", "인공지능", "언어모델", "언어 모델", "챗봇", "챗 봇", "프로그램",
    "컴퓨터", "모델이야", "시스템 프롬프트", "학습 데이터", "토큰",
)
SELF_PARTICLES = "이|이가|은|는|도|이도"
LENGTH_VALUE = r"^(\d+)\s*~\s*(\d+)\s*(글자|문장)$"
ELLIPSIS_VALUE = r"^최대\s*(\d+)\s*개$"


def assistant_texts(turns: Column) -> Column:
    return F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), lambda t: t["text"])


def any_text(test: Predicate) -> Predicate:
    """Whether the test holds for any assistant text."""
    return lambda turns: F.exists(assistant_texts(turns), test)


def _bad(key: str, value: str, allowed: str) -> PersonaError:
    return PersonaError(f"constraint {key!r} cannot be {value!r}; allowed: {allowed}")


def _switch(key: str, reason: str, test: Predicate) -> Callable[[str, str], Rule]:
    def build(name: str, value: str) -> Rule:
        if value == "금지":
            return [(reason, any_text(test))]
        if value == "허용":
            return []
        raise _bad(key, value, "금지, 허용")

    return build


def register_rule(name: str, value: str) -> Rule:
    if value == "반말":
        return [("honorific", any_text(lambda t: t.rlike(HONORIFIC)))]
    if value == "존댓말":
        ending = f"(?:{'|'.join(POLITE_ENDINGS)}){TRAILING}"
        short = rf"^{INTERJECTION}(?:[\s,·…]*{INTERJECTION})*{TRAILING}"
        return [("informal_ending", any_text(lambda t: ~(strip(t).rlike(ending) | strip(t).rlike(short))))]
    if value in ("서술체", "자유"):
        return []
    raise _bad("말투", value, "반말, 존댓말, 서술체, 자유")


def length_rule(name: str, value: str) -> Rule:
    m = re.match(LENGTH_VALUE, value)
    if not m or int(m[1]) > int(m[2]):
        raise _bad("발화 길이", value, "N~M글자, N~M문장")
    measure = F.char_length if m[3] == "글자" else sentence_count
    return [
        ("assistant_too_short", any_text(lambda t: measure(t) < int(m[1]))),
        ("assistant_too_long", any_text(lambda t: measure(t) > int(m[2]))),
    ]


def script_rule(name: str, value: str) -> Rule:
    def has(pattern: str) -> Predicate:
        return any_text(lambda t: t.rlike(pattern))

    if value == "한글":
        return [
            ("cjk_characters", has(CJK)),
            ("kana_characters", has(KANA)),
            ("latin_words", has(LATIN_WORD)),
            ("no_hangul", any_text(lambda t: ~t.rlike(HANGUL))),
        ]
    if value == "영문":
        return [("hangul_characters", has(HANGUL)), ("cjk_characters", has(CJK)), ("kana_characters", has(KANA))]
    if value == "혼용":
        return []
    raise _bad("문자", value, "한글, 영문, 혼용")


def third_person_rule(name: str, value: str) -> Rule:
    pattern = rf"^\Q{name}\E({SELF_PARTICLES})(?![\p{{L}}\p{{N}}_])"
    return _switch("3인칭 자칭", "third_person_self", lambda t: t.rlike(pattern))(name, value)


def name_suffix_rule(name: str, value: str) -> Rule:
    def baby_talk(t: Column) -> Column:
        words = F.regexp_extract_all(t, F.lit("([가-힣]+)"), 1)
        return F.exists(words, lambda w: (F.char_length(w) >= 2) & F.contains(F.lit(name), F.right(w, F.lit(1))) & ~w.startswith(name))

    return _switch("이름 어미", "name_suffix_babytalk", baby_talk)(name, value)


def ellipsis_rule(name: str, value: str) -> Rule:
    m = re.match(ELLIPSIS_VALUE, value)
    if not m:
        raise _bad("말줄임표", value, "최대 N개")
    return [("multiple_ellipsis", any_text(lambda t: F.regexp_count(t, F.lit("…")) > int(m[1])))]


def repeats(t: Column) -> Column:
    """A word of two letters or more said twice in a row, or a chunk of three characters or more doubled.

    Texts are normalised, so no chunk can be blank; evaluated last, being quadratic in a turn's length.
    """
    space = WHITE_SPACE
    black = space.replace("[", "[^", 1)
    word = rf"(?<!{black})({black}{{2,}}){space}+\1(?!{black})"
    return t.rlike(word) | t.rlike(r"(?s)(?!\s{3})(.{3,})\1")


def repeat_rule(name: str, value: str) -> Rule:
    if value != "금지":
        raise _bad("반복", value, "금지")
    return [("repeated_phrase", any_text(repeats))]


#: Rule factories by constraint key, in the order in which reasons are reported.
RULES: dict[str, Callable[[str, str], Rule]] = {
    "말투": register_rule,
    "발화 길이": length_rule,
    "문자": script_rule,
    "이모지": _switch("이모지", "emoji", lambda t: t.rlike(EMOJI)),
    "마크다운": _switch("마크다운", "markdown", lambda t: t.rlike(MARKDOWN)),
    "역할 표기": _switch("역할 표기", "role_label_in_text", lambda t: t.rlike(ROLE_LABEL)),
    "AI 자칭": _switch("AI 자칭", "claims_to_be_ai", lambda t: F.exists(F.array(*map(F.lit, AI_WORDS)), lambda w: F.contains(t, w))),
    "반복": repeat_rule,
    "3인칭 자칭": third_person_rule,
    "이름 어미": name_suffix_rule,
    "말줄임표": ellipsis_rule,
}


def structure_rule(min_turns: int, max_turns: int) -> Rule:
    """The shape every session must have; evaluated first, and alone on empty sessions."""

    def alternates(turns: Column) -> Column:
        rest = F.greatest(F.size(turns) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(turns, 1, rest), F.slice(turns, 2, rest), lambda a, b: a["role"].eqNullSafe(b["role"]))
        return F.exists(pairs, lambda same: same)

    return [
        ("empty", lambda turns: F.size(turns) == 0),
        ("too_few_turns", lambda turns: (F.size(turns) > 0) & (F.size(turns) < min_turns)),
        ("too_many_turns", lambda turns: F.size(turns) > max_turns),
        ("does_not_start_with_user", lambda turns: ~F.get(turns, F.lit(0))["role"].eqNullSafe("user") & (F.size(turns) > 0)),
        ("does_not_end_with_assistant", lambda turns: ~F.get(turns, F.size(turns) - 1)["role"].eqNullSafe("assistant") & (F.size(turns) > 0)),
        ("roles_not_alternating", alternates),
        ("utterance_empty", lambda turns: F.exists(turns, lambda t: F.coalesce(strip(t["text"]), F.lit("")) == "")),
    ]
