import pytest
from pyspark.sql import functions as F

from dialoom.functions.rules import PersonaError
from dialoom.operators.gate import gate


def reasons(spark, turns, constraints, name="초롱", **kw):
    df = spark.createDataFrame([(turns,)], "turns array<struct<role:string,text:string>>")
    return df.select(gate(F.col("turns"), constraints, name, **kw).alias("r")).first()["r"]


def said(spark, reply, key, value):
    return reasons(spark, [("user", "안녕"), ("assistant", reply)], {key: value})


@pytest.mark.parametrize(
    "reply,key,value,want",
    [
        ("안녕하세요", "말투", "반말", ["honorific"]),
        ("같이 놀자", "말투", "반말", []),
        ("그렇습니다.", "말투", "존댓말", []),
        ("네.", "말투", "존댓말", []),
        ("음… 네!", "말투", "존댓말", []),
        ("재밌네", "말투", "존댓말", ["informal_ending"]),
        ("아무거나", "말투", "자유", []),
        ("짧아", "발화 길이", "4~35글자", ["assistant_too_short"]),
        ("가" * 36, "발화 길이", "4~35글자", ["assistant_too_long"]),
        ("하나. 둘. 셋. 넷.", "발화 길이", "1~3문장", ["assistant_too_long"]),
        ("漢字 좋아", "문자", "한글", ["cjk_characters"]),
        ("ひらがな", "문자", "한글", ["kana_characters", "no_hangul"]),
        ("hello 안녕", "문자", "한글", ["latin_words"]),
        ("안녕 hello", "문자", "영문", ["hangul_characters"]),
        ("좋아 😀", "이모지", "금지", ["emoji"]),
        ("좋아 ^^", "이모지", "금지", ["emoji"]),
        ("좋아 😀", "이모지", "허용", []),
        ("- 하나", "마크다운", "금지", ["markdown"]),
        ("**굵게**", "마크다운", "금지", ["markdown"]),
        ("U: 안녕", "역할 표기", "금지", ["role_label_in_text"]),
        ("나는 챗봇이야", "AI 자칭", "금지", ["claims_to_be_ai"]),
        ("정말 정말 좋아", "반복", "금지", ["repeated_phrase"]),
        ("놀자아놀자아", "반복", "금지", ["repeated_phrase"]),
        ("하하하 웃자", "반복", "금지", []),
        ("초롱이는 졸려", "3인칭 자칭", "금지", []),
        ("초롱은 졸려", "3인칭 자칭", "금지", ["third_person_self"]),
        ("좋아롱", "이름 어미", "금지", ["name_suffix_babytalk"]),
        ("초롱이 좋아", "이름 어미", "금지", []),
        ("음… 글쎄…", "말줄임표", "최대 1개", ["multiple_ellipsis"]),
    ],
)
def test_rules(spark, reply, key, value, want):
    assert said(spark, reply, key, value) == want


def test_only_assistant_turns_are_judged(spark):
    assert reasons(spark, [("user", "안녕하세요 😀"), ("assistant", "응 좋아")], {"말투": "반말", "이모지": "금지"}) == []


@pytest.mark.parametrize(
    "turns,want",
    [
        ([], ["empty"]),
        ([("user", "a")], ["too_few_turns", "does_not_end_with_assistant"]),
        ([("assistant", "a"), ("assistant", "b")], ["does_not_start_with_user", "roles_not_alternating"]),
        ([("user", "a"), ("assistant", " ")], ["utterance_empty"]),
        ([("user", "a"), ("assistant", "b")] * 3, ["too_many_turns"]),
    ],
)
def test_structure(spark, turns, want):
    assert reasons(spark, turns, {}, min_turns=2, max_turns=4) == want


@pytest.mark.parametrize("key,value", [("말투", "이상"), ("발화 길이", "길게"), ("이모지", "가끔"), ("말줄임표", "하나"), ("없는 규칙", "금지"), ("반복", "허용")])
def test_bad_values(key, value):
    with pytest.raises(PersonaError):
        gate(None, {key: value})
