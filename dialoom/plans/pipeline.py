"""Running a configured pipeline: stages in order, each a plan from tables to tables."""

from __future__ import annotations

import json
import logging
import shutil
import time
import uuid
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import export, ledger, stages
from ..operators.gate import gate
from ..operators.schema import SESSIONS, UTTERANCES, RecordKind
from ..sources import extractors, fetch, formats, sinks, teachers
from . import persona as personas
from . import prompts
from .config import ConfigError, Pipeline, Source
from .registry import GROUPS, ship

LOG = logging.getLogger("dialoom")
SPLITS = ("train", "val", "test")


class Run:
    """A configuration with its session, persona, profile and paths."""

    def __init__(self, spark: SparkSession, config: Pipeline):
        self.spark, self.config = spark, config
        self.profile = GROUPS["profiles"].get(config.profile)
        self.persona = personas.load(str(config.persona_doc), tuple(self.profile.required_sections))
        ship(spark.sparkContext, config.plugins)

    def path(self, area: str, name: str) -> str:
        return str(self.config.data_root / area / name)

    def table(self, area: str, name: str) -> DataFrame:
        path = self.path(area, name)
        if not Path(path).exists():
            raise FileNotFoundError(f"{path} is not there; run the stage {name!r} first")
        return self.spark.read.parquet(path)

    def describe(self, path: Path | None) -> str:
        """A path under the configuration's folder by its place there."""
        if path is None:
            return ""
        return path.relative_to(self.config.root).as_posix() if path.is_relative_to(self.config.root) else path.as_posix()

    def origin(self) -> dict:
        """What a manifest says of where its records come from."""
        c = self.config
        return {
            "generated_by": "dialoom",
            "created": time.strftime("%Y-%m-%dT%H:%M:%S"),
            "config_path": self.describe(c.path),
            "seed": c.seed,
            "profile": c.profile,
            "language": c.language,
            "persona_doc": self.describe(c.persona_doc),
            "persona_sha256": self.persona.sha256,
        }

    def stage_digest(self) -> dict[str, dict]:
        """Counts of the stages before this one, from their statistics files."""
        out = {}
        for area in ("raw", "filtered"):
            for path in sorted((self.config.data_root / area).glob("*.stats.json")):
                stats = json.loads(path.read_text(encoding="utf-8"))
                out[f"{area}/{stats['stage']}"] = {k: stats.get(k) for k in ("produced", "rejected", "yield_rate", "calls", "failures", "reject_reasons")}
        return out

    def stored(self, name: str, df: DataFrame) -> DataFrame:
        """Written under the data root and read back, for what several steps read."""
        path = self.path("work", name)
        sinks.write_table(df, path)
        return self.spark.read.parquet(path)

    def answer(self, teacher: str | None):
        """A function from requests to answers; HTTP answers are written before use."""
        if teacher is None:
            raise ConfigError("this stage needs a teacher")
        t = self.config.teachers[teacher]
        if t.kind == "fake":
            return teachers.echo
        endpoint = GROUPS["teachers"].get(t.kind)(t.base_url, t.model, timeout=t.timeout, concurrency=t.concurrency, max_tokens=t.max_tokens, temperature=t.temperature, top_p=t.top_p, api_key=t.api_key)
        endpoint.check()

        def ask(requests: DataFrame) -> DataFrame:
            path = self.path("answers", f"{teacher}-{time.time_ns()}")
            sinks.write_table(endpoint.generate(requests), path)
            return self.spark.read.parquet(path)

        return ask

    def model(self, teacher: str) -> str:
        return self.config.teachers[teacher].model

    def gate(self) -> Column:
        f = self.config.stages.get("filter")
        return gate(F.col("turns"), self.persona.constraints, self.persona.name, f.min_turns if f else 2, f.max_turns if f else 16, GROUPS["rules"].mapping())

    def publish(self, area: str, name: str, records: DataFrame, kind: RecordKind, gated: bool = True, extra: dict | None = None, metric: dict | None = None) -> dict:
        """Judge the records once, write kept and rejected rows and a sample, and return the stage's counts.

        ``metric`` is what the stage itself knows: calls, failures, completion_tokens, and by reason what it rejected
        before there was a record (``reject_reasons``) or passed over in the sources (``source_filter_reasons``).
        """
        entries = ledger.ledger(records, kind, self.gate() if gated else None)
        sinks.write_table(entries, self.path("ledger", f"{area}-{name}"))
        entries = self.spark.read.parquet(self.path("ledger", f"{area}-{name}"))
        sinks.write_table(ledger.kept(entries), self.path(area, name))
        sinks.write_table(ledger.rejected(entries), self.path(area, f"{name}.rejected"))
        sinks.write_table(ledger.sample(entries, seed=self.config.seed), self.path(area, f"{name}.sample"))
        metric = metric or {}
        own = {k: n for k, n in metric.get("reject_reasons", {}).items() if n}
        filtered = {k: n for k, n in metric.get("source_filter_reasons", {}).items() if n}
        row = ledger.yield_rate(entries, sum(own.values())).first().asDict()
        row["yield_rate"] = None if row["yield_rate"] is None else float(row["yield_rate"])
        reasons = Counter(own)
        reasons.update({r["reason"]: r["n"] for r in ledger.reason_counts(entries).collect()})
        stats = row | {"stage": name, "reject_reasons": dict(sorted(reasons.items(), key=lambda x: (-x[1], x[0])))}
        stats |= {k: metric.get(k, 0) for k in ("calls", "failures", "completion_tokens")}
        stats |= {"source_filtered": sum(filtered.values()), "source_filter_reasons": filtered, "extra": extra or {}}
        sinks.write_json(stats, self.path(area, f"{name}.stats.json"))
        return stats


def ingest(run: Run) -> dict:
    c, s = run.config, run.config.stages["ingest"]
    parts = []
    for name in s.sources:
        source = c.sources[name]
        path = fetch.fetch(name, c.root / source.path if source.path else None, source.url, c.data_root / "cache", s.download_timeout)
        if path is None:
            continue
        try:
            parts.append(extractors.utterances(source_texts(run.spark, source, path), name, source.language, source.license, source.url, len(parts)))
        except (formats.SourceError, OSError) as e:
            LOG.warning("source %s skipped: %s", name, e)
    if not parts:
        raise FileNotFoundError("no source could be read")
    raw = parts[0]
    for p in parts[1:]:
        raw = raw.unionByName(p)
    raw = raw.drop("_row", "_field", "_item")
    # every source is read for this table alone
    marked = run.stored("ingest-marked", stages.mark_distinct(raw, c.language, s.min_chars, s.max_chars))
    done = stages.sample_sources(marked.where("_distinct").drop("_distinct"), s.limit_per_source, c.seed)
    if any(c.sources[n].language != c.language for n in s.sources):
        translate = GROUPS["translators"].get(s.translator)
        done = translate(done, run.answer(s.teacher), c.language).withColumn("translator", F.when(F.col("original_text").isNotNull(), run.model(s.teacher)))
    stems = s.blocked_stems or stages.BLOCKED_STEMS
    judged = run.stored("ingest-judged", stages.judge_topics(done, run.persona.signal(), s.min_chars, s.max_chars, s.topic_min_hits, stems))
    none = dict.fromkeys(("raw", "distinct", *stages.COUNTS), 0)
    per_source = {n: dict(none) for n in s.sources}
    for r in stages.source_stats(marked, judged).collect():  # a row a source
        per_source[r["source"]] = {k: v for k, v in r.asDict().items() if k != "source"}
    total = Counter()
    for counts in per_source.values():
        total.update(counts)
    # sources follow each other in the configuration's order, records in their source's: positions without a gap
    first, before = {}, 0
    for name in s.sources:
        first[name], before = before, before + per_source[name]["in_scope"]
    start = F.create_map(*(F.lit(x) for pair in first.items() for x in pair))[F.col("source")]
    records = stages.utterance_records(judged, keep_index=True).withColumn("_pos", (start + F.col("_index")).cast("long")).drop("_index")
    failed = total["translation_failed"]
    metric = {"calls": total["translated"] + failed, "failures": failed, "reject_reasons": {"translation_failed": failed}}
    metric |= {"source_filter_reasons": {"off_topic": total["off_topic"], "unsafe_source": total["unsafe"]}}
    return run.publish("raw", "ingest", records, UTTERANCES, False, {"sources": per_source}, metric)


def source_texts(spark: SparkSession, source: Source, path: str) -> DataFrame:
    """The texts of one source, by the registered format and extractor."""
    known = GROUPS["formats"].mapping()
    rows = formats.read(spark, source.format, path, source.fields, known)
    extract = dict(source.extract)
    kind = extract.pop("kind", "field")
    json_cells = source.format in formats.JSON_CELLS or getattr(known[source.format], "json_cells", False)
    return extractors.extract(rows, kind, source.fields, extract, json_cells, GROUPS["extractors"].mapping())


def _calls(outcomes: DataFrame, reasons: tuple[str, ...]) -> dict:
    row = stages.call_counts(outcomes).first().asDict()
    return {"calls": row["calls"], "failures": row["teacher_error"], "completion_tokens": row["completion_tokens"], "reject_reasons": {r: row[r] for r in reasons}}


def dialogue(run: Run) -> dict:
    s = run.config.stages["dialogue"]
    beats = personas.beats_table(run.spark, run.persona)
    turns = s.turns or list(run.profile.turns)
    requests = stages.dialogue_requests(beats, s.per_situation, turns, list(run.persona.flows or run.profile.flows), ledger.stage_seed(run.config.seed, "dialogue"))
    user = prompts.dialogue_user(run.profile, F.col("beat"), F.col("flow"), F.col("turns"))
    system = prompts.dialogue_system(run.persona, run.profile, F.col("key"), run.config.seed)
    asked = requests.select("key", system.alias("system"), user.alias("user"))
    answers = requests.join(run.answer(s.teacher)(asked), "key", "left")
    answers = run.stored("dialogue-answers", answers)
    metric = _calls(stages.dialogue_outcomes(answers), ("teacher_error", "unparseable"))
    return run.publish("raw", "dialogue", stages.dialogue_sessions(answers, run.model(s.teacher)), SESSIONS, True, {}, metric)


def respond(run: Run) -> dict:
    s = run.config.stages["respond"]
    rows = run.table("raw", "ingest")
    if s.limit:
        rows = rows.orderBy(stages.hash_order(ledger.stage_seed(run.config.seed, "respond"), F.col("id")), "id").limit(s.limit)
    system = prompts.respond_system(run.persona, run.profile, F.col("id"), run.config.seed)
    answers = run.answer(s.teacher)(rows.select(F.col("id").alias("key"), system.alias("system"), F.col("text").alias("user")))
    metric = _calls(stages.response_outcomes(rows, answers), ("teacher_error", "empty_reply"))
    return run.publish("raw", "respond", stages.response_sessions(rows, answers, run.model(s.teacher)), SESSIONS, True, {}, metric)


def filter_(run: Run) -> dict:
    """Each session table by itself: overused lines first, then the ledger."""
    s = run.config.stages["filter"]
    out = {}
    for name in run.config.session_stages():
        if Path(run.path("raw", name)).exists():
            records = stages.mark_overused(run.table("raw", name), s.max_identical_assistant_turns)
            out[name] = run.publish("filtered", name, records, SESSIONS)
    if not out:
        raise FileNotFoundError("no session table to filter; run dialogue or respond first")
    return out


def assemble(run: Run) -> dict:
    s = run.config.stages["assemble"]
    pool = None
    for bucket in s.ratios:
        part = run.table("filtered", bucket).withColumn("bucket", F.lit(bucket))
        pool = part if pool is None else pool.unionByName(part, allowMissingColumns=True)
    rank = F.array_position(F.array(*map(F.lit, list(s.ratios))), F.col("bucket"))
    pool = pool.withColumn("_pos", F.struct(rank.alias("bucket"), F.col("_pos").alias("place")))
    seed = ledger.stage_seed(run.config.seed, "assemble")
    short = {r["bucket"]: r["shortfall"] for r in stages.shortfall(pool, stages.bucket_targets(run.spark, s.ratios, s.max_sessions)).collect()}
    drawn = stages.split_sessions(stages.draw(pool, s.ratios, s.max_sessions, seed), s.split, seed)
    stats = run.publish("final", "assemble", drawn, SESSIONS, True, {"shortfall": short})
    final = run.table("final", "assemble")
    stray = final.where(~F.coalesce(F.col("split").isin(*SPLITS), F.lit(False))).select("id", "split").limit(1).collect()
    if stray:
        raise ValueError(f"record {stray[0]['id']!r} has the unknown split {stray[0]['split']!r}")
    files = {}
    for split in SPLITS:
        path = run.config.data_root / "final" / f"{split}.jsonl"
        n = sinks.write_jsonl(final.where(F.col("split") == split).drop("bucket"), path)
        files[split] = {"path": run.describe(path), "records": n, "sha256": sinks.file_sha256(path)}
    selected = {b: 0 for b in s.ratios} | {r["name"]: r["n"] for r in stages.selected_counts(final).collect()}
    manifest = run.origin() | {
        "student": {"model": run.config.student.model, "chat_template": run.config.student.chat_template},
        "config": run.config.raw,
        "requested_ratios": s.ratios,
        "max_sessions": s.max_sessions,
        "selected": selected,
        "shortfall": short,
        "requested_split": s.split,
        "split_sessions": {k: f["records"] for k, f in files.items()},
        "files": files,
        "stages": run.stage_digest(),
        "stats": stats,
    }
    sinks.write_json(manifest, run.config.data_root / "final" / "manifest.json")
    return stats | {"shortfall": short}


def export_(run: Run, name: str | None = None) -> dict:
    """The dataset's folder, finished beside its place and then put there."""
    s, c = run.config.stages["export"], run.config
    name = name or s.name
    target = c.datasets_root / name
    out = target.with_name(f"{name}.tmp-{uuid.uuid4().hex}")
    out.mkdir(parents=True)
    try:
        manifest = _write_dataset(run, name, out, target)
        sinks.publish_folder(out, target)
    finally:
        shutil.rmtree(out, ignore_errors=True)
    return manifest


def _write_dataset(run: Run, name: str, out: Path, target: Path) -> dict:
    s, c, student = run.config.stages["export"], run.config, run.config.student
    final = run.table("final", "assemble").drop("bucket")
    prompt = run.persona.system_prompt()
    messages = export.rendered(export.to_messages(final, prompt))
    files = {}
    for split in SPLITS:
        n = sinks.write_jsonl(export.to_messages(final.where(F.col("split") == split), prompt), out / f"{split}.jsonl")
        files[split] = {"records": n, "sha256": sinks.file_sha256(out / f"{split}.jsonl")}
    lengths = export.token_lengths(messages, "rendered", s.tokenizer) if s.tokenizer else None
    method = "characters" if lengths is None else "tokens"
    if lengths is None:
        lengths = messages.select(F.char_length("rendered").alias("n"))
    report = export.length_report(lengths, "n", method).first().asDict()
    licenses = {r["source"]: r["licenses"] for r in export.license_sets(final).collect()}
    sources = {r["source"]: r["n"] for r in export.source_counts(final).orderBy(F.desc("n"), "source").collect()}
    (out / "chat_template.jinja").write_text(export.CHATML_JINJA, encoding="utf-8")
    sample = export.rendered(export.to_messages(final.where("split = 'train'"), prompt)).orderBy("_pos").limit(3)
    (out / "rendered_sample.txt").write_text("\n---\n".join(r["rendered"] for r in sample.collect()), encoding="utf-8")
    recipe = dict(s.recipe)
    kind = recipe.pop("kind", "llamafactory")
    folder = target / "recipe" / kind
    note = f"{report['method']}, p99 {report['p99']}"
    written = GROUPS["recipes"].get(kind)(name, student.model, report["cutoff_len"], recipe, student.trust_remote_code, student.chat_template, folder.resolve().as_posix(), note)
    for file, content in written.items():
        path = out / "recipe" / kind / file
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content, encoding="utf-8")
    corpus = c.data_root / "final" / "manifest.json"
    manifest = run.origin() | {
        "name": name,
        "format": "openai-messages",
        "persona": run.persona.name,
        "student": {"model": student.model, "trust_remote_code": student.trust_remote_code},
        "chat_template": student.chat_template,
        "records": sum(f["records"] for f in files.values()),
        "turns": final.agg(F.coalesce(F.sum(F.size("turns")), F.lit(0)).alias("n")).first()["n"],
        "files": files,
        "sources": sources,
        "licenses": licenses,
        "generators": {r["generator"]: r["n"] for r in export.generator_counts(final).orderBy(F.desc("n"), "generator").collect()},
        "source_datasets": [r.asDict() for r in export.dataset_summary(final).orderBy("source_dataset").collect()] if "source_dataset" in final.columns else [],
        "length_report": report,
        "recipe": {"kind": kind, **recipe, "files": [f"recipe/{kind}/{f}" for f in written]},
        "corpus_manifest_sha256": sinks.file_sha256(corpus) if corpus.exists() else None,
    }
    every = sorted({x for v in licenses.values() for x in v})
    counts = {k: f["records"] for k, f in files.items()}
    (out / "README.md").write_text(export.card(name, c.language, manifest["records"], every, counts, sources, manifest, prompt), encoding="utf-8")
    sinks.write_json(manifest, out / "manifest.json")
    return manifest


STAGES = {"ingest": ingest, "dialogue": dialogue, "respond": respond, "filter": filter_, "assemble": assemble, "export": export_}


def run_pipeline(spark: SparkSession, config: Pipeline, only: str | None = None) -> dict[str, dict]:
    config.validate()
    run = Run(spark, config)
    plugged = GROUPS["stages"].mapping()
    return {name: (plugged[name].run if name in plugged else STAGES[name])(run) for name in config.order(only)}


def check(spark: SparkSession, config: Pipeline) -> dict[str, str]:
    """What each stage would stumble over; empty texts mean ready."""
    config.validate()
    run = Run(spark, config)
    run.gate()
    found = {}
    for name in config.order():
        try:
            s = config.stages[name]
            if name == "ingest":
                for source in s.sources:
                    c = config.sources[source]
                    if c.path:
                        source_texts(spark, c, str(config.root / c.path)).limit(3).count()
            if getattr(s, "teacher", None):
                run.answer(s.teacher)
            found[name] = ""
        except Exception as e:  # every stage is reported
            found[name] = f"{type(e).__name__}: {e}"
    return found


def sample_sources(spark: SparkSession, config: Pipeline, n: int) -> dict[str, list[str]]:
    out = {}
    for name, c in config.sources.items():
        if c.path:
            texts = source_texts(spark, c, str(config.root / c.path))
            out[name] = [r["text"] for r in texts.orderBy("_row", "_field", "_item").limit(n).collect()]
    return out


def status(spark: SparkSession, config: Pipeline) -> dict[str, dict]:
    """Kept and rejected rows of each stage; the rate's denominator holds duplicates too."""
    out = {}
    sessions = config.session_stages()
    for area, name in [("raw", "ingest"), *(("raw", n) for n in sessions), *(("filtered", n) for n in sessions), ("final", "assemble")]:
        path = config.data_root / area / name
        if path.exists():
            kept, lost = (spark.read.parquet(str(p)).count() for p in (path, path.with_name(f"{name}.rejected")))
            out[f"{area}/{name}"] = {"kept": kept, "rejected": lost, "rate": kept / (kept + lost) if kept + lost else None}
    return out


__all__ = ["Run", "check", "run_pipeline", "sample_sources", "status"]
