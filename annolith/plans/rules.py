"""The rules that a generating or judging model is given, as columns: by task, by look-alike, and the JSON bodies around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.plans.guidance import messages

GENERATOR, JUDGE, REPAIR = "Write one annotated sample and answer with JSON only.", "Judge one annotated sample and answer with JSON only.", "Repair one annotated sample and answer with JSON only."
BY_TYPE = {
    "positive": ["Tag each given value once, exactly as it is written.", "Add no other personal data.", "Make every value part of what happens."],
    "pure_negative": ["Use only the given role, action and object.", "Write no tag and list no entity.", "Keep to one event."],
    "hard_negative": ["Tag each given value once, exactly as it is written.", "Leave every look-alike untagged and unlisted.", "Put a cue of each look-alike in its own sentence.", "Let each look-alike matter to the event."],
    "decoy_only": ["Write no tag and list no entity.", "Leave every look-alike untagged.", "Put a cue of each look-alike in its own sentence.", "A look-alike may come twice where the event needs it."],
}
BY_DIFFICULTY = {"easy": "Write a plain main clause.", "medium": "Join two clauses at most.", "hard": "Use several clauses or turns about one event."}
BY_STRUCTURE = {
    "single_sentence": "Form: one sentence.", "two_sentence_note": "Form: a note of two sentences.", "short_dialogue": "Form: a few turns of two speakers.", "form_like_record": "Form: fields of a record.",
    "agreement_clause": "Form: a clause of an agreement.", "administrative_record": "Form: an entry of an office's record.", "company_notice": "Form: a notice to staff.", "handover_minutes": "Form: minutes of a handover.",
    "friend_chat": "Form: two friends chat.", "customer_support_chat": "Form: a customer and the support desk chat.", "custom_format": "Form: as the custom instruction says.",
}
BY_REGISTER = {"formal": "Tone: formal.", "neutral": "Tone: everyday.", "informal": "Tone: casual but clear.", "concise_technical": "Tone: terse and technical."}
BY_CONSTRAINT = {
    "teen_code": "Use a little teen spelling outside the values.", "light_typo": "Allow one typing slip outside the values.", "abbreviation": "Abbreviate one word outside the values.", "informal_chat": "Use chat particles outside the values.",
    "multi_sentence": "Write more than one sentence.", "numeric_noise": "Name one harmless number.",
}


def task_rules(decoy_only: bool = False, instruction: str | None = None) -> Column:
    """array<string> from sample_type, difficulty, document_structure, language_register and optional_constraints; unknown names add nothing."""
    table = lambda rows: F.create_map(*(x for k, v in rows.items() for x in (F.lit(k), F.array(*(F.lit(t) for t in v)) if isinstance(v, list) else F.lit(v))))
    kind = F.when((F.col("sample_type") == "hard_negative") & F.lit(decoy_only), "decoy_only").otherwise(F.col("sample_type"))
    by_type = F.coalesce(F.try_element_at(table(BY_TYPE), kind), F.array().cast("array<string>"))
    single = F.array(*(F.try_element_at(table(rows), F.col(name)) for name, rows in (("difficulty", BY_DIFFICULTY), ("document_structure", BY_STRUCTURE), ("language_register", BY_REGISTER))))
    drawn = F.transform("optional_constraints", lambda c: F.try_element_at(table(BY_CONSTRAINT), c))
    own = F.array(F.lit(instruction).cast("string"))
    return F.filter(F.concat(by_type, single, drawn, F.when(F.col("document_structure") == "custom_format", own).otherwise(F.array(F.lit(None).cast("string")))), lambda x: x.isNotNull())


def decoy_rules(decoys: Column) -> Column:
    """Two rules for each look-alike: where it stands, and what must not lead to it."""
    each = lambda d: F.array(
        F.concat(F.lit("Write "), d["value"], F.lit(" as "), d["semantic_type"], F.lit(", next to one of: "), F.array_join(d["required"], "; "), F.lit(".")),
        F.when(F.size(d["forbidden"]) > 0, F.concat(F.lit("Don't lead to "), d["value"], F.lit(" with: "), F.array_join(d["forbidden"], "; "), F.lit("."))),
    )
    return F.filter(F.flatten(F.transform(decoys, each)), lambda x: x.isNotNull())


def generation_query() -> Column:
    """What a generating model needs of a task."""
    return F.struct("task_id", "focus_labels", "difficulty", "sample_type", "max_entities", "language", "optional_constraints", "speaker_role", "intent", "document_structure", "language_register", "length_bucket", "context_frame_id")


def generation_messages(packs: DataFrame, decoy_only: bool = False, instruction: str | None = None) -> DataFrame:
    """packs with messages: system text, and one JSON object of task, seeds, rules, taxonomy guidance and feedback where there are any."""
    have = set(packs.columns)
    parts = {"task": generation_query(), "positive_entities": F.col("positives"), "decoys": F.col("decoys"), "content_seeds": F.col("content_seeds"), "rules": F.concat(task_rules(decoy_only, instruction), decoy_rules(F.col("decoys")))}
    parts |= {name: F.col(column) for name, column in (("taxonomy", "context"), ("reflection", "reflection")) if column in have}
    return packs.withColumn("messages", messages(GENERATOR, **parts))


def judge_messages(candidates: DataFrame) -> DataFrame:
    """candidates with messages to the judge: task, seeds, the text and what the checks found."""
    return candidates.withColumn("messages", messages(JUDGE, task=generation_query(), positive_entities=F.col("positives"), decoys=F.col("decoys"), tagged_text=F.col("tagged_text"), entities=F.col("entities"), issues=F.col("issues")))


def repair_messages(candidates: DataFrame) -> DataFrame:
    """candidates (with the judge's verdict as initial) with messages to the repairing model."""
    return candidates.withColumn("messages", messages(REPAIR, tagged_text=F.col("tagged_text"), entities=F.col("entities"), positive_entities=F.col("positives"), decoys=F.col("decoys"), issues=F.col("initial.issues")))
