"""Export: chat messages, rendered texts, length statistics, provenance summaries, card and recipe."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import render_chatml

# The chat template that trainers get; the renderer gives the same bytes.
CHATML_JINJA = (
    "{%- for message in messages -%}\n"
    "{%- if message['role'] == 'assistant' -%}\n"
    "<|im_start|>assistant\n"
    "{% generation %}{{ message['content'] }}<|im_end|>\n{% endgeneration %}\n"
    "{%- else -%}\n"
    "<|im_start|>{{ message['role'] }}\n"
    "{{ message['content'] }}<|im_end|>\n"
    "{% endif -%}\n"
    "{%- endfor -%}\n"
    "{%- if add_generation_prompt -%}\n"
    "<|im_start|>assistant\n"
    "{% endif -%}\n"
)
SIZE_BUCKETS = ((1_000, "n<1K"), (10_000, "1K<n<10K"), (100_000, "10K<n<100K"), (1_000_000, "100K<n<1M"))
SIZE_ABOVE = "1M<n<10M"


def to_messages(sessions: DataFrame, system_prompt: str) -> DataFrame:
    """Sessions with ``messages`` in place of ``turns`` and ``split``, the system message first."""
    system = F.array(F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content")))
    rest = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    return sessions.withColumn("messages", F.concat(system, rest)).drop("turns", "split")


def rendered(messages: DataFrame) -> DataFrame:
    return messages.withColumn("rendered", render_chatml(F.col("messages")))


def length_report(lengths: DataFrame, column: str, method: str = "characters") -> DataFrame:
    """One row of nearest-rank percentiles and the cutoff length; zeros for no rows."""
    q = lambda p: F.expr(f"percentile_disc({p}) within group (order by {column})")
    row = lengths.agg(F.count(column).alias("count"), q(0.5).alias("p50"), q(0.95).alias("p95"), q(0.99).alias("p99"), F.max(column).alias("max"))
    whole = {c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")) for c in ("count", "p50", "p95", "p99", "max")}
    row = row.select(F.lit(method).alias("method"), *(v.alias(c) for c, v in whole.items()))
    if method == "tokens":
        cutoff = F.greatest(F.lit(256).cast("long"), (F.ceil(F.col("p99") / 64) * 64).cast("long"))
    else:
        cutoff = F.greatest(F.lit(1).cast("long"), F.col("p99"))
    return row.withColumn("cutoff_len", cutoff)


def token_lengths(texts: DataFrame, column: str, tokenizer_file: str) -> DataFrame | None:
    """``n`` tokens of each text by a tokenizer file, in Arrow batches; None if it cannot be loaded."""
    try:
        from tokenizers import Tokenizer

        Tokenizer.from_file(tokenizer_file)
    except Exception:  # the library raises bare exceptions; characters stand in for tokens then
        return None

    def run(batches):
        tokenizer = Tokenizer.from_file(tokenizer_file)
        for pdf in batches:
            yield pdf.assign(n=[len(e.ids) for e in tokenizer.encode_batch(pdf[column].tolist(), add_special_tokens=False)])[["n"]]

    return texts.select(column).mapInPandas(run, "n long")


def source_counts(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("source").agg(F.count("*").alias("n"))


def generator_counts(sessions: DataFrame) -> DataFrame:
    return sessions.select(F.explode("generator").alias("generator")).groupBy("generator").agg(F.count("*").alias("n"))


def license_sets(sessions: DataFrame) -> DataFrame:
    """Sorted distinct licences of each source; rows without a licence add none."""
    return sessions.groupBy("source").agg(F.array_sort(F.collect_set("license")).alias("licenses"))


def dataset_summary(sessions: DataFrame) -> DataFrame:
    """Per external dataset: count, and the first value in input order of its provenance columns."""

    def first(name: str) -> Column:
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.col("_pos")))

    names = ("license", "source_url", "original_language", "translator")
    rows = sessions.where("source_dataset is not null").groupBy("source_dataset")
    return rows.agg(F.count("*").alias("n"), *(first(c).alias(c) for c in names))


def size_bucket(n: Column) -> Column:
    out = None
    for bound, name in SIZE_BUCKETS:
        out = F.when(n < bound, name) if out is None else out.when(n < bound, name)
    return out.otherwise(SIZE_ABOVE)


# What every card says of its dataset, and what it adds for a language.
CARD_TASK, CARD_TAGS, LANGUAGE_TAGS = "text-generation", ("persona", "roleplay", "sft"), {"ko": "korean"}


def card(name: str, language: str, total: int, licenses: list[str], counts: Mapping[str, int], sources: Mapping[str, int], manifest: Mapping | None = None, system_prompt: str = "") -> str:
    """A dataset card: front matter, tables of splits and sources, and what the manifest knows of the making."""
    bucket = next((b for bound, b in SIZE_BUCKETS if total < bound), SIZE_ABOVE)
    tags = [*CARD_TAGS, *filter(None, [LANGUAGE_TAGS.get(language)])]
    head = ["---", "language:", f"- {language}", f"license: {licenses[0] if len(licenses) == 1 else 'other'}", "task_categories:", f"- {CARD_TASK}", "tags:", *(f"- {t}" for t in tags), "size_categories:", f"- {bucket}", "---", ""]
    out = [*head, f"# {name}", "", "| split | sessions |", "| --- | --- |", *(f"| {k} | {v} |" for k, v in counts.items())]
    m = manifest or {}
    of = m.get("licenses", {})
    out += ["", "## Sources", "", "| source | sessions | licence |", "| --- | --- | --- |", *(f"| {k} | {v} | {', '.join(of.get(k, []))} |" for k, v in sources.items())]
    if m.get("source_datasets"):
        out += ["", "User turns come from:", ""]
        for d in m["source_datasets"]:
            translated = f", translated from {d['original_language']} by {d['translator'] or 'a teacher'}" if d.get("original_language") else ""
            out.append(f"- `{d['source_dataset']}` ({d['license']}{translated}), {d['source_url'] or 'a local file'}, {d['n']} sessions")
    if m.get("generators"):
        out += ["", "## Models that wrote it", "", *(f"- `{k}`: {v} sessions" for k, v in m["generators"].items())]
    if "student" in m:
        lengths = m["length_report"]
        out += ["", "## Training", "", f"- model `{m['student']['model']}`, trust_remote_code {m['student']['trust_remote_code']}", f"- chat template `{m['chat_template']}`, in `chat_template.jinja`"]
        out += [f"- length in {lengths['method']}: p50 {lengths['p50']}, p95 {lengths['p95']}, p99 {lengths['p99']}, longest {lengths['max']}; cut at {lengths['cutoff_len']}", f"- recipe in `recipe/{m['recipe']['kind']}/`"]
    if system_prompt:
        out += ["", "## Format", "", "A line is a session. `messages` starts with the system message below; user and assistant follow in turn. Other fields tell where a session comes from.", "", "```", system_prompt, "```"]
    if "persona_sha256" in m:
        out += ["", "## Made from", "", f"- persona document `{m['persona_doc']}`, sha256 `{m['persona_sha256'][:16]}`", f"- configuration `{m['config_path']}`, seed {m['seed']}"]
    return "\n".join([*out, ""])


# The trainer settings of a recipe and their defaults; "auto" takes the length report's cutoff.
LORA_DEFAULTS = {
    "lora_rank": 16,
    "lora_alpha": 32,
    "lora_dropout": 0.05,
    "learning_rate": 2e-4,
    "epochs": 3.0,
    "cutoff_len": "auto",
    "batch_size": 8,
    "gradient_accumulation": 2,
    "warmup_ratio": 0.05,
}


#: The chat templates' names in the trainer.
TRAINER_TEMPLATES = {"chatml": "chatml"}


def lora_recipe(
    name: str, model: str, cutoff_len: int, settings: Mapping[str, object] | None = None, trust_remote_code: bool = False, template: str = "chatml", folder: str = ".", length_note: str = ""
) -> dict[str, str]:
    """Files of a LoRA fine-tuning recipe in ``folder``: dataset registration, trainer settings, a note."""
    unknown = set(settings or {}) - set(LORA_DEFAULTS)
    if unknown:
        raise ValueError(f"unknown recipe settings: {sorted(unknown)}")
    if template not in TRAINER_TEMPLATES:
        raise ValueError(f"no trainer template for {template!r}; there are {sorted(TRAINER_TEMPLATES)}")
    s = LORA_DEFAULTS | dict(settings or {})
    cutoff = cutoff_len if s["cutoff_len"] == "auto" else int(s["cutoff_len"])
    tags = {f"{k}_tag": k for k in ("role", "content", "user", "assistant", "system")}
    entry = lambda split: {"file_name": f"../../{split}.jsonl", "formatting": "sharegpt", "columns": {"messages": "messages"}, "tags": tags}
    info = {name: entry("train"), f"{name}_val": entry("val")}
    # What the trainer needs beside the settings.
    groups = {
        "model": {"model_name_or_path": model, "trust_remote_code": trust_remote_code},
        "method": {"stage": "sft", "do_train": True, "finetuning_type": "lora", **{k: s[k] for k in ("lora_rank", "lora_alpha", "lora_dropout")}, "lora_target": "all"},
        "dataset": {
            "dataset": name,
            "eval_dataset": f"{name}_val",
            "dataset_dir": folder,
            "template": TRAINER_TEMPLATES[template],
            "cutoff_len": cutoff,
            "train_on_prompt": False,
            "preprocessing_num_workers": 4,
        },
        "output": {"output_dir": f"saves/{name}/lora", "logging_steps": 10, "save_steps": 200, "plot_loss": True, "overwrite_output_dir": True, "report_to": "none"},
        "train": {
            "per_device_train_batch_size": s["batch_size"],
            "gradient_accumulation_steps": s["gradient_accumulation"],
            "learning_rate": s["learning_rate"],
            "num_train_epochs": s["epochs"],
            "lr_scheduler_type": "cosine",
            "warmup_ratio": s["warmup_ratio"],
            "bf16": True,
        },
        "eval": {"per_device_eval_batch_size": s["batch_size"], "eval_strategy": "steps", "eval_steps": 100},
    }
    value = lambda v: v if isinstance(v, str) and v.replace("_", "").replace("-", "").isalnum() else json.dumps(v, ensure_ascii=False)
    trainer = "\n".join(f"### {title}\n" + "".join(f"{k}: {value(v)}\n" for k, v in rows.items()) for title, rows in groups.items())
    note = [
        f"# {name}: LoRA",
        "",
        f"    llamafactory-cli train {folder}/lora_sft.yaml",
        "",
        f"* Model: `{model}`, chat template `{template}`; use the same template when the model answers.",
        f"* Texts are cut at {cutoff} tokens{f' ({length_note})' if length_note else ''}.",
        "* Only assistant turns count in the loss.",
        f"* `{name}_val` is evaluated every {groups['eval']['eval_steps']} steps.",
        "",
    ]
    return {"dataset_info.json": json.dumps(info, ensure_ascii=False, indent=2) + "\n", "lora_sft.yaml": trainer, "README.md": "\n".join(note)}
