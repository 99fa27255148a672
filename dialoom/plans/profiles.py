"""Profiles: defaults of a use, as data; code reads attributes and never asks for a name."""

from __future__ import annotations

from dataclasses import dataclass

from . import persona as p


@dataclass(frozen=True)
class Profile:
    name: str
    assistant_label: str
    user_label: str
    turns: tuple[int, ...]
    required_sections: tuple[str, ...]
    constraints: dict[str, str]
    flows: tuple[str, ...]
    rule: str

    def document(self, persona_name: str) -> str:
        """A complete persona document to start from; the reader accepts it as it is."""
        core = {"이름": persona_name, "정체성": "누구인지 한 문장", "사용자와의 관계": f"{self.user_label}와의 사이", "말투": self.constraints["말투"], "성격": "두세 문장", "응답 길이": self.constraints["발화 길이"], "지식 범위": "아는 것과 모르는 것"}
        table = lambda rows: "".join(f"| {k} | {v} |\n" for k, v in rows.items())
        parts = [f"# {persona_name}\n", f"## {p.CORE}\n\n| 항목 | 규칙 |\n| --- | --- |\n{table(core)}", f"## {p.CONSTRAINTS}\n\n| 규칙 | 값 |\n| --- | --- |\n{table(self.constraints)}"]
        parts += [f"## {p.PRINCIPLES}\n\n1. 감정이나 의도를 먼저 말한다.\n2. 모르는 것은 모른다고 말한다.\n", f"## {p.SITUATIONS}\n\n1. 첫 만남, 인사, 작별\n2. 질문, 모르는 질문\n"]
        parts += [f"## {name}\n\n여기에 적는다.\n" for name in self.required_sections]
        parts += [f"## {p.FLOWS}\n\n" + "".join(f"- {f}\n" for f in self.flows), f"## {p.EXAMPLES}\n\n```text\nU: 안녕, 누구야?\nA: 나는 {persona_name}. 반가워.\n```\n"]
        return "\n".join(parts)


# What the profiles share and where they differ.
_COMMON = {"문자": "한글", "이모지": "금지", "마크다운": "금지", "역할 표기": "금지", "AI 자칭": "금지", "반복": "금지"}
_OWN = {"3인칭 자칭": "금지", "이름 어미": "금지", "말줄임표": "최대 1개"}


def _constraints(register: str, length: str, more: dict[str, str] | None = None) -> dict[str, str]:
    return {"말투": register, "발화 길이": length} | _COMMON | (more or {})


PROFILES = {
    x.name: x
    for x in (
        Profile("companion", "펫", "사용자", (2, 3, 4), (), _constraints("반말", "4~35글자", _OWN), ("다정하게 말을 거는 흐름", "걱정하며 묻는 흐름", "장난치는 흐름"), "대사만 쓴다."),
        Profile("npc", "NPC", "플레이어", (2, 3, 4), (p.BACKGROUND,), _constraints("존댓말", "1~3문장"), ("처음 말을 거는 흐름", "거래하는 흐름", "다시 찾아온 흐름"), "배경 밖의 지식을 말하지 않는다."),
        Profile("novel", "화자", "독자", (2, 3), (p.BACKGROUND,), _constraints("자유", "1~4문장"), ("과거를 묻는 흐름", "일상을 묻는 흐름"), "시점과 시대를 지킨다."),
        Profile("trpg", "진행자", "플레이어", (2, 3, 4), (p.BACKGROUND,), _constraints("서술체", "1~4문장"), ("탐색하는 흐름", "전투를 선언하는 흐름", "협상하는 흐름"), "판정 결과를 지어내지 않는다."),
        Profile("lore", "안내자", "질문자", (1, 2, 3), (p.BACKGROUND,), _constraints("존댓말", "1~4문장"), ("지명을 묻는 흐름", "역사를 묻는 흐름"), "적히지 않은 사실은 모른다고 답한다."),
    )
}
