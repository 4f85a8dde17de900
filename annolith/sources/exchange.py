"""Requests to generate, answers of models, result events, the summary of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolith.plans.planner import DIFFICULTIES, SAMPLE_TYPES

TASK = "struct<task_id:string,focus_labels:array<string>,difficulty:string,sample_type:string,max_entities:int,max_attempts:int,language:string,run_id:string,focus_label:string,robin_labels:array<string>,optional_constraints:array<string>>"
PACK = "struct<seed_pack_id:string,task_id:string,sample_type:string,hard_negative_mode:string,context_frame:struct<frame_id:string,domain:string,document_type:string,tone:string,max_sentences:int,supported_labels:array<string>>,positive_entities:array<struct<label:string,value:string,semantic_role:string,format_variant:string>>>"
REQUEST = f"task {TASK}, seed_pack {PACK}, attempt_no int, event_id string, correlation_id string, causation_id string"
ANSWER = "struct<choices:array<struct<message:struct<content:string>>>,usage:struct<prompt_tokens:int,completion_tokens:int,total_tokens:int>>"
#: Host suffixes of the deployment-style API.
DEPLOYMENT_HOSTS = (".openai.azure.com", ".cognitiveservices.azure.com")


def request_errors() -> Column:
    """Every rule that a request breaks."""
    task, pack = F.col("task"), F.col("seed_pack")
    absent = lambda s, names: F.greatest(*(s[n].isNull() for n in names), F.lit(False))
    most = F.coalesce(task["max_attempts"], F.lit(3))
    checks = {
        "task is missing a required field": absent(task, ("task_id", "focus_labels", "difficulty", "sample_type", "max_entities")),
        "no focus labels": F.size(task["focus_labels"]) == 0,
        "unknown difficulty": ~task["difficulty"].isin(*DIFFICULTIES),
        "unknown sample type": ~task["sample_type"].isin(*SAMPLE_TYPES),
        "max_entities is under 1": task["max_entities"] < 1,
        "seed pack is missing a required field": absent(pack, ("seed_pack_id", "task_id", "sample_type", "context_frame")),
        "attempt_no is not between 1 and max_attempts": ~F.coalesce(F.col("attempt_no").between(1, most), F.lit(False)),
    }
    return F.filter(F.array(*(F.when(c, F.lit(name)) for name, c in checks.items())), lambda x: x.isNotNull())


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Requests, one JSON object a line, with key (idempotency) and errors; a line that is no object is all null and has errors."""
    return checked_requests(spark.read.schema(REQUEST).json(path))


def stream_requests(spark: SparkSession, path: str, files_at_once: int = 100) -> DataFrame:
    """read_requests of a folder to which files are added, as a stream; see annolith.streaming.events.once for repeated keys."""
    return checked_requests(spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", files_at_once).json(path))


def checked_requests(rows: DataFrame) -> DataFrame:
    key = F.concat(F.col("task.task_id"), F.lit(":attempt:"), F.col("attempt_no").cast("string"), F.lit(":data-generation"))
    return rows.withColumns({"idempotency_key": key, "errors": request_errors()})


def parse_answer(raw: Column) -> Column:
    """struct<tagged_text, entities, input_tokens, output_tokens, total_tokens, error> of a chat completion's JSON.

    A list of parts as tagged_text is joined: strings as they are, of objects the member text."""
    answer = F.from_json(raw, ANSWER)
    content = F.element_at(answer["choices"], 1)["message"]["content"]
    parts = F.from_json(F.get_json_object(content, "$.tagged_text"), "array<string>")
    text = F.get_json_object(content, "$.tagged_text")
    joined = F.array_join(F.transform(parts, lambda p: F.when(p.startswith("{"), F.coalesce(F.get_json_object(p, "$.text"), F.lit(""))).otherwise(p)), "")
    text = F.when(text.startswith("[") & parts.isNotNull(), joined).otherwise(text)
    listed = F.get_json_object(content, "$.entities")
    entities = F.from_json(listed, "array<struct<label:string,value:string>>")
    tokens_in, tokens_out = (F.coalesce(answer["usage"][n], F.lit(0)) for n in ("prompt_tokens", "completion_tokens"))
    error = (
        F.when(content.isNull(), "the answer holds no message")
        .when(F.length(F.trim(F.coalesce(text, F.lit("")))) == 0, "no tagged_text")
        .when(listed.isNull() | ~listed.startswith("[") | entities.isNull(), "entities is no list")
        .when(F.exists(entities, lambda e: e.isNull()), "an entity is no object")
    )
    blank = lambda x: F.coalesce(x, F.lit(""))
    filled = F.transform(entities, lambda e: F.struct(blank(e["label"]).alias("label"), blank(e["value"]).alias("value")))
    return F.struct(text.alias("tagged_text"), filled.alias("entities"), tokens_in.alias("input_tokens"), tokens_out.alias("output_tokens"), F.coalesce(answer["usage"]["total_tokens"], tokens_in + tokens_out).alias("total_tokens"), error.alias("error"))


def api_style(base_url: Column) -> Column:
    """azure or openai, by the host."""
    host = F.lower(F.coalesce(F.try_parse_url(base_url, F.lit("HOST")), F.lit("")))
    return F.when(F.greatest(*(host.endswith(x) for x in DEPLOYMENT_HOSTS)), "azure").otherwise("openai")


def result_events(results: DataFrame) -> DataFrame:
    """Event envelopes of results (task_id, run_id, attempt_no, tagged_text, entities): one key an attempt, so a repeat is dropped downstream."""
    key = F.concat("task_id", F.lit(":attempt:"), F.col("attempt_no").cast("string"), F.lit(":data-generation"))
    return results.select(
        F.md5(key).alias("event_id"), F.lit("data.generated").alias("event_type"), F.lit(1).alias("event_version"), F.current_timestamp().alias("occurred_at"),
        F.col("run_id").alias("correlation_id"), F.col("task_id").alias("causation_id"), key.alias("idempotency_key"),
        F.to_json(F.struct("task_id", "attempt_no", "tagged_text", "entities", F.sha2("tagged_text", 256).alias("output_hash"))).alias("payload"),
    )


def run_summary(accepted: DataFrame, rejected: DataFrame, asked: int) -> DataFrame:
    """One row: status (COMPLETED if as many as asked were accepted, else FAILED), counts, summed tokens."""
    usage = [F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in ("input_tokens", "output_tokens")]
    both = accepted.select(F.lit(1).alias("ok"), "input_tokens", "output_tokens").unionByName(rejected.select(F.lit(0).alias("ok"), "input_tokens", "output_tokens"))
    rows = both.agg(F.coalesce(F.sum("ok"), F.lit(0)).cast("long").alias("accepted"), F.count("*").alias("attempted"), *usage)
    return rows.select(F.when(F.col("accepted") >= asked, "COMPLETED").otherwise("FAILED").alias("status"), "accepted", (F.col("attempted") - F.col("accepted")).alias("rejected"), "input_tokens", "output_tokens")
