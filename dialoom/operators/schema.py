"""Record kinds: what a session and an utterance must be, normalised, with fingerprints."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import casefold, collapse, nfc, strip

TURNS = "array<struct<role:string,text:string>>"
SESSION = f"id string, source string, scenario string, license string, generator array<string>, turns {TURNS}"
UTTERANCE = "id string, text string, source string, language string, license string, url string"


def _filled(name: str) -> Column:
    return F.coalesce(strip(F.col(name).cast("string")), F.lit(""))


def _first_error(checks: list[tuple[Column, str]]) -> Column:
    """The message of the first failing check, null if none fails."""
    return F.coalesce(*(F.when(~F.coalesce(good, F.lit(False)), F.lit(f"schema:{message}")) for good, message in checks))


def normalise_sessions(df: DataFrame) -> DataFrame:
    """Normalised turns and scenario, and ``_schema_error`` with the first violation.

    Roles must alternate from user to assistant in an even number of turns, two at least; every text must
    be non-blank; id and source must be present. Other columns pass.
    """

    # texts joined by a separator that no text keeps, so that one call serves a whole session
    joined = F.array_join(F.transform("turns", lambda t: F.coalesce(t["text"], F.lit("\u0001"))), "\u0000")
    df = df.withColumn("_texts", F.split(nfc(joined), "\u0000"))
    whole = F.zip_with("turns", "_texts", lambda t, x: F.struct(t["role"].alias("role"), F.when(t["text"].isNotNull(), collapse(x)).alias("text")))
    # no turns join to one empty text, which is not a turn
    df = df.withColumn("turns", F.when(F.size("turns") > 0, whole).otherwise(F.col("turns"))).drop("_texts")
    df = df.withColumn("scenario", F.when(_filled("scenario") == "", "unknown").otherwise(F.col("scenario")))

    def flaw(t: Column, i: Column) -> Column:
        role = t["role"].eqNullSafe(F.when(i % 2 == 0, "user").otherwise("assistant"))
        return F.when(~role, "role").when(F.coalesce(t["text"], F.lit("")) == "", "text")

    flaws = F.filter(F.transform("turns", flaw), lambda x: x.isNotNull())  # turn by turn, the role before the text
    checks = [
        (_filled("id") != "", "id"),
        (_filled("source") != "", "source"),
        (F.col("turns").isNotNull(), "turns"),
        (F.size("turns") >= 2, "too_short"),
        (F.size("turns") % 2 == 0, "even"),
        (~F.get(flaws, F.lit(0)).eqNullSafe("role"), "role"),
        (~F.get(flaws, F.lit(0)).eqNullSafe("text"), "text"),
    ]
    return df.withColumn("_schema_error", _first_error(checks))


def session_fingerprint(turns: Column) -> Column:
    lines = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return F.sha2(casefold(lines), 256)


def normalise_utterances(df: DataFrame) -> DataFrame:
    """Normalised text and language, and ``_schema_error``; checked in the order id, source, license, text, language."""
    df = df.withColumn("text", collapse(nfc(F.col("text")))).withColumn("language", F.lower(strip(F.col("language"))))
    checks = [
        (_filled("id") != "", "id"),
        (_filled("source") != "", "source"),
        (_filled("license") != "", "license"),
        (F.coalesce("text", F.lit("")) != "", "text"),
        (F.col("language").rlike("^[a-z]{2}$"), "language"),
    ]
    return df.withColumn("_schema_error", _first_error(checks))


def utterance_fingerprint(text: Column) -> Column:
    return F.sha2(casefold(text), 256)


@dataclass(frozen=True)
class RecordKind:
    name: str
    gated: bool
    normalise: Callable[[DataFrame], DataFrame]
    fingerprint: Callable[[], Column]


SESSIONS = RecordKind("session", True, normalise_sessions, lambda: session_fingerprint(F.col("turns")))
UTTERANCES = RecordKind("utterance", False, normalise_utterances, lambda: utterance_fingerprint(F.col("text")))
KINDS = {k.name: k for k in (SESSIONS, UTTERANCES)}
