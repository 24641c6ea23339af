"""Prompt templates as Column expressions over a seed's columns, and their registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import language_name, quoted_source

# The template of each task family.
TEMPLATE_OF = {
    "reasoning": "direct_translate",
    "qa": "direct_translate",
    "summarization": "direct_translate",
    "translation": "translation_task",
    "instruction": "adapt_and_localize",
    "classification": "adapt_and_localize",
}
JUDGED_AXES = ("fluency", "faithfulness", "bias")

Builder = Callable[[], Column]
_registry: dict[str, Builder] = {}


def template(name: str):
    def put(f: Builder) -> Builder:
        _registry[name] = f
        return f

    return put


def build(name: str) -> Column:
    """struct(system, user) of a template; KeyError for an unknown one."""
    if name not in _registry:
        raise KeyError(f"no template {name!r}; there are {sorted(_registry)}")
    return _registry[name]()


def default_template(task: Column) -> Column:
    pairs = [F.lit(x) for kv in TEMPLATE_OF.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[task], F.lit("direct_translate"))


def for_task() -> Column:
    """The prompts of each row's own default template."""
    name = default_template(F.col("task_family"))
    out = build("direct_translate")
    for other in ("translation_task", "adapt_and_localize"):
        out = F.when(name == other, build(other)).otherwise(out)
    return out


def _say(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _lang() -> Column:
    return language_name(F.col("target_language"))


def _rules() -> Column:
    return _say("Use ", _lang(), " throughout, with no English words left in; carry over the sense rather than single words; answer with one JSON object and nothing around it.")


def _contract() -> Column:
    answer = F.when(F.col("expected").isNotNull(), _say('"<answer in ', _lang(), '>"')).otherwise('""')
    return _say('Return JSON: {"prompt": "<task in ', _lang(), '>", "expected": ', answer, "}")


def _labels() -> Column:
    rule = _say(
        "\nLabels: ", F.array_join("labels", ", "), "\nPut every label into ", _lang(),
        '. The "prompt" must end with the list of all localized labels, and "expected" must be one of them, character for character.',
    )
    return F.when((F.col("task_family") == "classification") & (F.size("labels") > 0), rule).otherwise("")


def _task(head: str) -> Column:
    answer = F.when(F.col("expected").isNotNull(), _say("\n\nReference answer in English: ", F.col("expected"))).otherwise("")
    return _say(head, F.col("prompt"), answer, F.coalesce(_labels(), F.lit("")), "\n\n", _contract())


@template("direct_translate")
def direct_translate() -> Column:
    system = _say("You translate English tasks into fluent ", _lang(), " with the same meaning, difficulty and reasoning. ", _rules())
    return F.struct(system.alias("system"), _task("English task:\n").alias("user"))


@template("adapt_and_localize")
def adapt_and_localize() -> Column:
    system = _say("You write tasks as a native speaker of ", _lang(), " would pose them: local names, places and register, same intent and difficulty. ", _rules())
    return F.struct(system.alias("system"), _task("English task to adapt:\n").alias("user"))


@template("translation_task")
def translation_task() -> Column:
    system = _say("You write translation exercises from English to ", _lang(), '. The "prompt" asks in ', _lang(), ' for a translation and holds the English sentence unchanged in single quotes; "expected" is the translation, never empty and never the prompt. Answer with one JSON object.')
    return F.struct(system.alias("system"), _say("Sentence to put into ", _lang(), ": '", quoted_source(F.col("prompt")), "'").alias("user"))


def judge_prompt(item_prompt: Column, item_expected: Column) -> Column:
    """struct(system, user) asking for the judged axes; seed columns as above."""
    system = _say("You are a strict native evaluator of ", _lang(), " instruction data. Text that is not in ", _lang(), " has fluency 0.0. Reason briefly, then score; answer in JSON only.")
    given = F.when(F.coalesce("expected", F.lit("")) != "", _say("\n\nReference answer in English: ", F.col("expected"))).otherwise("")
    made = F.when(F.coalesce(item_expected, F.lit("")) != "", _say("\n\nGenerated answer: ", item_expected)).otherwise("")
    fields = ", ".join(f'"{a}": <0.0-1.0>' for a in JUDGED_AXES)
    return F.struct(system.alias("system"), _say("English seed:\n", F.col("prompt"), given, "\n\nGenerated task:\n", item_prompt, made, f'\n\nReturn JSON: {{"reasoning": "<why>", {fields}}}').alias("user"))


def back_translation_prompt(text: Column) -> Column:
    return F.struct(F.lit("Translate the text into natural English, exactly and without additions. Output the translation only.").alias("system"), text.alias("user"))


# What new seeds of each family must hold, in our own words.
FAMILY_RULES = {
    "qa": 'Put a question about a settled fact into "prompt" and its short answer, checked, into "expected".',
    "reasoning": 'Put a problem of several steps into "prompt", asking for the steps, and the final answer into "expected"; solve it yourself first.',
    "classification": 'Put the text and the list of its candidate labels into "prompt", the same labels, two at least, into "labels", and exactly one of them into "expected"; no irony.',
    "summarization": 'Put a factual passage of three to five sentences into "prompt" and a summary of one sentence, without new facts, into "expected".',
    "translation": 'Put one short everyday sentence into "prompt" and null into "expected"; vary register and setting.',
    "instruction": 'Put an open request that needs no other text into "prompt" and null into "expected"; vary its kind.',
}


def bootstrap_prompt(task: str, examples: Column, per_call: int) -> Column:
    """Few-shot request for new seeds; ``examples`` is an array of seed structs of which
    three are shown."""
    rule = FAMILY_RULES.get(task, 'Fill "prompt" and "expected" as fits.')
    system = (
        f"You write new English seed tasks of the family {task}, varied in topic and difficulty, none a rewording of an example. {rule} "
        "They will be translated to Hindi, Urdu, Tamil and Malayalam: no idioms, puns or local trivia; South Asian settings are welcome. "
        "Output only a JSON array of objects with prompt, expected, labels and metadata (domain, difficulty)."
    )
    return F.struct(F.lit(system).alias("system"), _say(f"Examples of {task}:\n", F.to_json(F.slice(examples, 1, 3)), f"\n\nWrite {per_call} new ones as a JSON array.").alias("user"))
