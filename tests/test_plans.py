import json

import pytest
from pyspark.sql import functions as F

from dialoom.functions.rules import PersonaError
from dialoom.operators import export
from dialoom.plans import cli, config, persona, pipeline, profiles, registry


def raw_config(**stages):
    base = {
        "ingest": {"sources": ["lines"], "teacher": "echo", "min_chars": 2, "max_chars": 60, "topic_min_hits": 0},
        "dialogue": {"teacher": "echo", "per_situation": 3},
        "respond": {"teacher": "echo"},
        "filter": {"max_identical_assistant_turns": 20},
        "assemble": {"ratios": {"dialogue": 0.5, "respond": 0.5}, "max_sessions": 4, "split": {"train": 0.5, "val": 0.25, "test": 0.25}},
        "export": {"name": "small", "recipe": {"kind": "llamafactory", "lora_rank": 8}},
    }
    return {
        "profile": "companion",
        "language": "ko",
        "seed": 3,
        "persona_doc": "p.md",
        "student": {"model": "m"},
        "teachers": {"echo": {"kind": "fake", "model": "echo"}},
        "sources": {"lines": {"format": "text", "path": "lines.txt", "language": "ko", "license": "cc0", "fields": ["line"]}},
        "stages": base | stages,
    }


@pytest.mark.parametrize("name", sorted(profiles.PROFILES))
def test_profile_documents_parse(name):
    p = persona.parse(profiles.PROFILES[name].document("초롱"), profiles.PROFILES[name].required_sections)
    assert p.name == "초롱" and p.beats[:3] == ("첫 만남", "인사", "작별")
    assert p.constraints == profiles.PROFILES[name].constraints
    assert "첫만" not in p.signal() and "만남" in p.signal()
    assert p.system_prompt().startswith("이름: 초롱")


@pytest.mark.parametrize("cut", ["## 제약", "## 발화 원칙", "| 성격 |", "1. 감정"])
def test_broken_documents(cut):
    text = profiles.PROFILES["companion"].document("초롱")
    with pytest.raises(PersonaError):
        persona.parse(text.replace(cut, "x", 1).replace("2. 모르는 것", "y") if cut == "1. 감정" else text.replace(cut, "x"))


@pytest.mark.parametrize(
    "change",
    [
        {"assemble": {"ratios": {"dialogue": 0.5}, "max_sessions": 4, "split": {"train": 1, "val": 0, "test": 0}}},
        {"assemble": {"ratios": {"ingest": 1.0}, "max_sessions": 4, "split": {"train": 1, "val": 0, "test": 0}}},
        {"assemble": {"ratios": {"dialogue": 1.0}, "max_sessions": 4, "split": {"train": 1}}},
        {"dialogue": {"teacher": "nobody"}},
        {"dialogue": {"teacher": "echo", "per_situation": True}},
        {"filter": {"what": 1}},
        {"ingest": {"sources": ["none"]}},
        {"unknown": {}},
    ],
)
def test_bad_configurations(tmp_path, change):
    with pytest.raises(config.ConfigError):
        config.parse(raw_config(**change), tmp_path).validate()


def test_stage_order(tmp_path):
    c = config.parse(raw_config(), tmp_path)
    assert c.order() == ["ingest", "dialogue", "respond", "filter", "assemble", "export"]
    assert c.order("filter") == ["filter"]


def test_registry_priorities():
    r = registry.Registry("test", {"a": len})
    r.add("a", sum)
    assert r.get("a") is sum
    r.add("a", len, "builtin")
    assert r.get("a") is sum
    with pytest.raises(registry.PluginError):
        r.get("b")
    saved = r.snapshot()
    r.add("b", max)
    r.restore(saved)
    assert r.names() == ["a"]


def test_recipe_and_card():
    files = export.lora_recipe("n", "m", 320, {"lora_rank": 8})
    assert '"lora_rank": 8' not in files["lora_sft.yaml"] and "lora_rank: 8" in files["lora_sft.yaml"] and "cutoff_len: 320" in files["lora_sft.yaml"]
    assert set(json.loads(files["dataset_info.json"])) == {"n", "n_val"}
    with pytest.raises(ValueError):
        export.lora_recipe("n", "m", 1, {"rank": 1})
    assert "license: other" in export.card("n", "ko", 5, ["a", "b"], {"train": 5}, {"x": 5})


def test_whole_pipeline(spark, tmp_path):
    (tmp_path / "p.md").write_text(profiles.PROFILES["companion"].document("초롱").replace("4~35글자", "2~60글자"), encoding="utf-8")
    (tmp_path / "lines.txt").write_text("안녕 첫 만남이야\n오늘은 인사할래\n작별은 싫어\n작별은 싫어\n씨발 싫어\n", encoding="utf-8")
    c = config.parse(raw_config(), tmp_path)
    assert not any(pipeline.check(spark, c).values())
    stats = pipeline.run_pipeline(spark, c)
    per = stats["ingest"]["extra"]["sources"]["lines"]
    assert (per["raw"], per["distinct"], per["unsafe"], per["in_scope"]) == (5, 4, 1, 3)
    assert stats["dialogue"]["produced"] > 0 and stats["respond"]["produced"] == 3
    manifest = stats["export"]
    assert manifest["records"] == stats["assemble"]["produced"] > 0
    lines = [json.loads(x) for s in ("train", "val", "test") for x in (tmp_path / "datasets" / "small" / f"{s}.jsonl").read_text(encoding="utf-8").splitlines()]
    assert len(lines) == manifest["records"] and all(x["messages"][0]["role"] == "system" for x in lines)
    again = pipeline.run_pipeline(spark, c)
    assert again["export"]["files"] == manifest["files"]
    assert pipeline.status(spark, c)["raw/ingest"]["kept"] == 3


def test_cli_codes(spark, tmp_path, capsys):
    bad = tmp_path / "bad.json"
    bad.write_text("{", encoding="utf-8")
    assert cli.main(["check", "--config", str(bad)]) == 2
    assert cli.main(["plugins"]) == 0
    out = tmp_path / "doc.md"
    assert cli.main(["init", "--profile", "npc", "--name", "상인", "--out", str(out)]) == 0 and out.exists()
    assert cli.main(["init", "--profile", "npc", "--name", "상인", "--out", str(out)]) == 1


PLUGIN = """
from dataclasses import dataclass
from pyspark.sql import functions as F
from dialoom.operators.schema import SESSIONS
from dialoom.plans.registry import GROUPS, StagePlugin


@GROUPS["formats"].register("bars")
def bars(spark, path, fields):
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("_row"), F.split("value", "[|]").alias(fields[0]))


@GROUPS["extractors"].register("last")
def last(cell, settings, json_cells):
    return F.array(F.element_at(cell, -1))


@GROUPS["rules"].register("no questions")
def no_questions(name, value):
    return [("asks", lambda turns: F.exists(turns, lambda t: (t["role"] == "assistant") & t["text"].contains("?")))]


@GROUPS["translators"].register("shout")
def shout(utterances, answer, target):
    foreign = F.col("language") != target
    kept = utterances.withColumn("original_text", F.when(foreign, F.col("text"))).withColumn("original_language", F.when(foreign, F.col("language")))
    text = F.when(~foreign, F.col("text")).when(~F.col("text").contains("lost"), F.concat(F.lit("인사 "), F.col("text")))
    return kept.withColumn("text", text).withColumn("language", F.lit(target))


@dataclass(frozen=True)
class Settings:
    words: int


def chant(run):
    turns = F.array(*(F.struct(F.lit(r).alias("role"), F.lit(t).alias("text")) for r, t in (("user", "뭐 해"), ("assistant", "노래해"))))
    rows = run.spark.range(run.config.stages["chant"].words).select(F.format_string("c%d", "id").alias("id"), F.lit("chant").alias("source"), F.lit("x").alias("scenario"), F.lit("l").alias("license"), F.array(F.lit("m")).alias("generator"), turns.alias("turns"), F.col("id").alias("_pos"))
    return run.publish("raw", "chant", rows, SESSIONS)


GROUPS["stages"].add("chant", StagePlugin("chant", chant, Settings, (), True))
"""


def test_plugins_act(spark, tmp_path):
    before = {g: r.snapshot() for g, r in registry.GROUPS.items()}
    try:
        (tmp_path / "small_plugin.py").write_text(PLUGIN, encoding="utf-8")
        text = profiles.PROFILES["companion"].document("초롱").replace("4~35글자", "2~60글자")
        (tmp_path / "p.md").write_text(text.replace("| 반복 | 금지 |", "| 반복 | 금지 |\n| no questions | yes |"), encoding="utf-8")
        (tmp_path / "bars.txt").write_text("x|hello\ny|lost\nz|bye\n", encoding="utf-8")
        raw = raw_config(
            ingest={"sources": ["bars"], "teacher": "echo", "topic_min_hits": 0, "translator": "shout"},
            chant={"words": 3},
            assemble={"ratios": {"dialogue": 0.5, "respond": 0.25, "chant": 0.25}, "max_sessions": 4, "split": {"train": 0.5, "val": 0.25, "test": 0.25}},
        )
        raw["sources"] = {"bars": {"format": "bars", "path": "bars.txt", "language": "en", "license": "cc0", "fields": ["cells"], "extract": {"kind": "last"}}}
        raw["plugins"] = ["small_plugin"]
        (tmp_path / "c.json").write_text(json.dumps(raw), encoding="utf-8")
        c = config.load(tmp_path / "c.json")
        assert c.order().index("chant") < c.order().index("filter")
        stats = pipeline.run_pipeline(spark, c)
        ingest = stats["ingest"]
        assert ingest["extra"]["sources"]["bars"] == {"raw": 3, "distinct": 3, "sampled": 3, "translated": 2, "translation_failed": 1, "in_scope": 2, "unsafe": 0, "off_topic": 0}
        assert (ingest["calls"], ingest["failures"], ingest["reject_reasons"], ingest["rejected"]) == (3, 1, {"translation_failed": 1}, 1)
        assert (stats["chant"]["produced"], stats["chant"]["duplicates"]) == (1, 2)
        manifest = json.loads((tmp_path / "data" / "final" / "manifest.json").read_text(encoding="utf-8"))
        assert manifest["selected"]["chant"] == 1 and manifest["config"] == raw and "raw/chant" in manifest["stages"]
        assert sum(manifest["split_sessions"].values()) == sum(manifest["selected"].values())
        out = tmp_path / "datasets" / "small"
        made = json.loads((out / "manifest.json").read_text(encoding="utf-8"))
        assert made["recipe"]["files"] == [f"recipe/llamafactory/{f}" for f in ("dataset_info.json", "lora_sft.yaml", "README.md")]
        assert len(made["corpus_manifest_sha256"]) == 64 and [p.name for p in (tmp_path / "datasets").iterdir()] == ["small"]
        card = (out / "README.md").read_text(encoding="utf-8")
        assert "- korean" in card and "chat_template.jinja" in card and "이름: 초롱" in card and "cut at" in card
        trainer = (out / "recipe" / "llamafactory" / "lora_sft.yaml").read_text(encoding="utf-8")
        assert all(f"{k}: " in trainer for k in ("output_dir", "lora_target", "dataset_dir", "lr_scheduler_type", "bf16", "eval_strategy", "preprocessing_num_workers"))
        run = pipeline.Run(spark, c)
        assert run.table("filtered", "chant").count() == 1
    finally:
        for g, r in registry.GROUPS.items():
            r.restore(before[g])


def test_unknown_split_and_more_bad_settings(spark, tmp_path):
    for change in ({"dialogue": {"teacher": "echo", "turns": []}}, {"dialogue": {"teacher": "echo", "turns": "3"}}, {"dialogue": {"teacher": "echo", "turns": [0]}}, {"assemble": {"ratios": {"dialogue": "1"}, "max_sessions": 4, "split": {"train": 1, "val": 0, "test": 0}}}, {"assemble": {"ratios": {"dialogue": 1.0}, "max_sessions": 4, "split": {"train": 1.5, "val": -0.5, "test": 0}}}):
        with pytest.raises(config.ConfigError):
            config.parse(raw_config(**change), tmp_path).validate()
    (tmp_path / "p.md").write_text(profiles.PROFILES["companion"].document("초롱").replace("4~35글자", "2~60글자"), encoding="utf-8")
    run = pipeline.Run(spark, config.parse(raw_config(assemble={"ratios": {"dialogue": 1.0}, "max_sessions": 4, "split": {"train": 1.0, "val": 0.0, "test": 0.0}}), tmp_path))
    from dialoom.operators import stages

    keep, stages.split_sessions = stages.split_sessions, lambda drawn, *_: drawn.withColumn("split", F.lit("dev"))
    try:
        pipeline.dialogue(run)
        pipeline.filter_(run)
        with pytest.raises(ValueError, match="unknown split 'dev'"):
            pipeline.assemble(run)
    finally:
        stages.split_sessions = keep


def test_vocabulary_sample(spark):
    from dialoom.plans import prompts

    p = persona.parse(profiles.PROFILES["companion"].document("초롱") + "\n## 어휘와 표현\n\n| 감정 | 표현 |\n| --- | --- |\n" + "".join(f"| k{n} | a{n}, b{n} |\n" for n in range(9)))
    df = spark.range(40).select(prompts.vocabulary_sample(p, 4, F.col("id").cast("string"), 3).alias("v"))
    rows = [r["v"].split("\n") for r in df.collect()]
    assert all(len(set(r)) == 4 for r in rows) and len({tuple(r) for r in rows}) > 20 and len({x for r in rows for x in r}) == 9
