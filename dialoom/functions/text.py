"""Text functions as column expressions: normalisation, case folding, counting, ChatML, parsing."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space as Python's str.split sees it, and the zero-width space that is deleted.
WHITE_SPACE = r"[\p{IsWhite_Space}\x{1c}-\x{1f}]"
ZERO_WIDTH_SPACE = "\u200b"

HANGUL_SYLLABLES = "가-힣"
#: Text that normalisation form C could change: combining marks, conjoining jamo, singletons, letters that it always takes apart.
MAYBE_NOT_NFC = r"[\p{M}\x{1100}-\x{11ff}\x{340}-\x{343}\x{374}\x{37e}\x{387}\x{958}-\x{95f}\x{9dc}-\x{9df}\x{a33}-\x{a36}\x{a59}-\x{a5e}\x{b5c}-\x{b5d}\x{f43}-\x{f69}\x{1f71}-\x{1fff}\x{2000}-\x{2001}\x{2126}-\x{212b}\x{2329}-\x{232a}\x{2adc}\x{f900}-\x{fb4e}\x{1d15e}-\x{1d1c0}\x{2f800}-\x{2fa1d}]"


@functools.cache
def case_folds() -> dict[str, str]:
    """Lower-case characters that full case folding changes further, such as ß, ς, ligatures and Cherokee."""
    every = map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x20000)))
    return {c: c.casefold() for c in every if c.casefold() != c == c.lower()}


def _ranges(letters: Iterable[str], gap: int = 64) -> str:
    """A class of few ranges that holds the letters, and some others near them."""
    codes = sorted(map(ord, letters))
    starts = [codes[0], *(b for a, b in zip(codes, codes[1:], strict=False) if b - a > gap)]
    ends = [*(a for a, b in zip(codes, codes[1:], strict=False) if b - a > gap), codes[-1]]
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends, strict=True)) + "]"


def collapse(text: Column, white_space: str = WHITE_SPACE) -> Column:
    """Delete zero-width spaces, trim, and put one space for every run of white space."""
    bare = F.replace(text, F.lit(ZERO_WIDTH_SPACE), F.lit(""))
    # a lone space between words, by far the most common run, is no match and costs no replacement
    return F.trim(F.regexp_replace(bare, f"(?! ){white_space}+| {white_space}+", " "))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{WHITE_SPACE}+|{WHITE_SPACE}+$", "")


@functools.cache
def _lower_letters() -> dict[str, str]:
    every = map(chr, (*range(0xD800), *range(0xE000, 0x20000)))
    return {c: c.lower()[0] for c in every if c.lower() != c}


def lower_letters(text: Column) -> Column:
    """Lower case letter by letter, whatever stands around: Σ is σ at the end of a word too, and İ is i."""
    letters = _lower_letters()
    # below U+0250 the quicker function does the same, but for İ
    return F.when(text.rlike(r"[\x{130}\x{250}-\x{10ffff}]"), F.translate(text, "".join(letters), "".join(letters.values()))).otherwise(F.lower(text))


def casefold(text: Column) -> Column:
    """Lower case plus the folds that lower case lacks; JVM-side throughout."""
    folds = {k: v for k, v in case_folds().items() if k != "ß"}
    low = F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))
    single = {k: v for k, v in folds.items() if len(v) == 1}
    out = F.translate(low, "".join(single), "".join(single.values()))
    several = {k: v for k, v in folds.items() if len(v) > 1}
    long = out
    for k, v in several.items():
        long = F.replace(long, F.lit(k), F.lit(v))
    # all but µ lie beyond U+0148: cheap ranges spare most rows the translation, and a pass for each of the long ones
    out = F.when(low.rlike(_ranges(several)), long).otherwise(out)
    return F.when(low.rlike(r"[\x{b5}\x{149}-\x{10ffff}]"), out).otherwise(low)


def nfc(text: Column) -> Column:
    """Normalisation form C.

    Spark has no normaliser. An Arrow UDF gets the texts that may need one and nulls for the others, almost
    all, so the input is read once and hardly any text leaves the JVM.
    """

    @F.pandas_udf("string")
    def compose(texts: pd.Series) -> pd.Series:
        return texts.str.normalize("NFC")

    # below U+0300 every text is composed: a cheap range decides for most rows
    needs = F.coalesce(text.rlike(r"[\x{300}-\x{10ffff}]") & text.rlike(MAYBE_NOT_NFC), F.lit(False))
    return F.coalesce(compose(F.when(needs, text)), text)


def normalise_column(df: DataFrame, name: str) -> DataFrame:
    """A string column in NFC with white space collapsed."""
    return df.withColumn(name, collapse(nfc(F.col(name))))


def sentence_count(text: Column) -> Column:
    """Non-blank pieces between sentence marks."""
    return F.size(F.filter(F.split(text, "[.?!…]+"), lambda s: strip(s) != ""))


def runs(text: Column, letters: str = HANGUL_SYLLABLES) -> Column:
    """Maximal runs of the given character class."""
    return F.regexp_extract_all(text, F.lit(f"([{letters}]+)"), 1)


def bigrams(text: Column, letters: str = HANGUL_SYLLABLES) -> Column:
    """Distinct two-letter windows inside each run."""

    def windows(run: Column) -> Column:
        places = F.when(F.char_length(run) >= 2, F.sequence(F.lit(1), F.char_length(run) - 1))
        return F.coalesce(F.transform(places, lambda i: run.substr(i, F.lit(2))), F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.transform(runs(text, letters), windows)))


def bigrams_of(text: str, letters: str = HANGUL_SYLLABLES) -> set[str]:
    """The same on the driver, for signal tables."""
    import re

    return {run[i : i + 2] for run in re.findall(f"[{letters}]+", text) for i in range(len(run) - 1)}


def begins_with_stem(text: Column, stems: Sequence[str], letters: str = HANGUL_SYLLABLES) -> Column:
    """Whether any run of letters begins with one of the stems."""
    if not stems:
        return F.lit(False)
    return F.exists(runs(text, letters), lambda t: F.exists(F.array(*map(F.lit, stems)), lambda s: t.startswith(s)))


def in_scope(text: Column, signal: Sequence[str], min_chars: int, max_chars: int, min_hits: int, letters: str = HANGUL_SYLLABLES) -> Column:
    """Length in range, a letter of the script, and enough bigrams shared with the signal."""
    hits = F.size(F.array_intersect(bigrams(text, letters), F.array(*map(F.lit, sorted(signal))).cast("array<string>")))
    return F.char_length(text).between(min_chars, max_chars) & text.rlike(f"[{letters}]") & (hits >= min_hits)


# Line tags of generated dialogues, role labels, and language names in prompts.
USER_TAG, ASSISTANT_TAG = "U:", "A:"
LEADING_ROLE = r"(?iU)^\s*(U|A|P|사용자|유저|user|assistant|pet)\s*[:：]\s*"
LANGUAGE_NAMES = {"ko": "한국어", "en": "영어", "ja": "일본어", "zh": "중국어", "es": "스페인어", "fr": "프랑스어", "de": "독일어"}

_TURN = "struct<role:string,text:string>"


def _unquote(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, '^"+|"+$', ""), "^'+|'+$", "")


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"\R"), strip), lambda x: x != "")


def parse_dialogue(text: Column) -> Column:
    """Tagged lines as turns; other lines are passed over; one empty body makes the whole result empty."""
    tagged = F.filter(_lines(text), lambda x: F.upper(F.substring(x, 1, 2)).isin(USER_TAG, ASSISTANT_TAG))
    turns = F.transform(
        tagged,
        lambda x: F.struct(
            F.when(F.upper(F.substring(x, 1, 2)) == USER_TAG, "user").otherwise("assistant").alias("role"),
            _unquote(strip(F.substr(x, F.lit(3)))).alias("text"),
        ),
    )
    empty = F.array().cast(f"array<{_TURN}>")
    return F.coalesce(F.when(F.exists(turns, lambda t: t["text"] == ""), empty).otherwise(turns), empty)


def repair_dialogue(turns: Column) -> Column:
    """Join neighbours of one role, cut leading assistant and trailing user turns; under two turns: none."""
    empty = F.array().cast(f"array<{_TURN}>")

    def join(done: Column, turn: Column) -> Column:
        last = F.element_at(done, -1)
        same = (F.size(done) > 0) & (F.when(F.size(done) > 0, last["role"]) == turn["role"])
        merged = F.struct(turn["role"].alias("role"), strip(F.concat_ws(" ", last["text"], turn["text"])).alias("text"))
        return F.when(same, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(merged))).otherwise(F.concat(done, F.array(turn)))

    merged = F.aggregate(turns, empty, join)
    # merged turns alternate, so at most one turn goes at either end
    first = F.when(F.get(merged, F.lit(0))["role"] == "assistant", 1).otherwise(0)
    last = F.when((F.size(merged) > 0) & (F.get(merged, F.size(merged) - 1)["role"] == "user"), 1).otherwise(0)
    size = F.size(merged) - first - last
    return F.when(size >= 2, F.slice(merged, first + 1, size)).otherwise(empty)


def render_dialogue(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.when(t["role"] == "user", USER_TAG).otherwise(ASSISTANT_TAG), F.lit(" "), t["text"])), "\n")


def reply_text(raw: Column) -> Column:
    """First non-blank line without role label and quotes."""
    line = F.get(_lines(F.coalesce(raw, F.lit(""))), F.lit(0))
    return F.coalesce(strip(_unquote(strip(F.regexp_replace(line, LEADING_ROLE, "")))), F.lit(""))


def language_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in LANGUAGE_NAMES.items() for x in kv])
    return F.coalesce(names[code], code)


def render_chatml(messages: Column) -> Column:
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>\n"))), "")
