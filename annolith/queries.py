"""The engine's queries over the test tables, each with equivalent DuckDB SQL where SQL can express it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolith import shared
from annolith.functions import detect, tags, templates, text, unique
from annolith.operators import audit, flow, novelty, samples, verify
from annolith.plans import catalog, guidance, runs, values
from annolith.plans.planner import compatible_frames, plan_tasks, unknown_labels
from annolith.plans.strategies import look_alikes, registry, strategies
from annolith.sources import dataset

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

EMAIL_SQL = r"'[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}'"
#: DuckDB rendition of the spans of documents' e-mail and IP addresses (RE2 has no look-around: numbers with dots are taken whole).
DETECTED_SQL = f"""
    select doc_id, 'EMAIL' as label, unnest(regexp_extract_all(text, {EMAIL_SQL})) as value from documents
    union all
    select doc_id, 'IP', v from (select doc_id, unnest(regexp_extract_all(text, '[\\d.]+')) as v from documents) where regexp_full_match(v, '(\\d{{1,3}}\\.){{3}}\\d{{1,3}}')
"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    def labelled(label: str):
        return F.transform(detect.all_matches(F.col("text"), label), lambda v: F.struct(F.lit(label).alias("label"), v.alias("value")))

    found = F.concat(labelled("EMAIL"), labelled("IP"))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(found).alias("m")).select("doc_id", "m.*")


@query(f"select doc_id, label, value, count(*) as n from ({DETECTED_SQL}) group by all")
def detect_structured_pii(spark, sf_dir):
    return detected(spark, sf_dir).groupBy("doc_id", "label", "value").agg(F.count("*").alias("n"))


@query(f"""
select doc_id, 'EMAIL' as label, regexp_extract(text, {EMAIL_SQL}) as value from documents where regexp_matches(text, {EMAIL_SQL})
union all select doc_id, 'IP', v[1] from (select doc_id, list_filter(regexp_extract_all(text, '[\\d.]+'), lambda x: regexp_full_match(x, '(\\d{{1,3}}\\.){{3}}\\d{{1,3}}')) as v from documents) where len(v) > 0
""")
def first_match_per_label(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select("doc_id", F.explode(detect.first_matches(F.col("text"))).alias("m"))
    return found.where(F.col("m.label").isin("EMAIL", "IP")).select("doc_id", "m.label", "m.value")


@query("""
with n as (select doc_id, unnest(regexp_extract_all(text, '\\d+')) as number from documents),
     c as (select doc_id, number, list_sum(list_transform(range(1, length(number) + 1), lambda i: case when i % 2 = 1 then number[-i]::int
             when number[-i]::int * 2 > 9 then number[-i]::int * 2 - 9 else number[-i]::int * 2 end)) as total from n where length(number) between 13 and 19)
select doc_id, number, total % 10 = 0 as luhn_valid, count(*) as n from c group by all
""")
def luhn_valid_cards(spark, sf_dir):
    numbers = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[0-9]+"), F.lit(0))).alias("number"))
    numbers = numbers.where(F.length("number").between(13, 19))
    check = detect.luhn_digit(F.expr("left(number, length(number) - 1)")) == F.right("number", F.lit(1))
    return numbers.groupBy("doc_id", "number", check.alias("luhn_valid")).agg(F.count("*").alias("n"))


def _tagged(spark, sf_dir) -> DataFrame:
    """Documents whose e-mail addresses are tagged in place; angle brackets of the text itself are taken out first."""
    plain = F.regexp_replace("text", "[<>]", " ")
    return table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace(plain, detect.DETECTORS["EMAIL"], "<EMAIL>$0</EMAIL>").alias("tagged")).where(F.col("tagged").contains("<EMAIL>"))


SPANS_SQL = rf"""
with t as (select doc_id, regexp_replace(text, '[<>]', ' ', 'g') as text from documents where regexp_matches(text, {EMAIL_SQL})),
     p as (select doc_id, text, regexp_extract_all(text, {EMAIL_SQL}) as v, string_split_regex(text, {EMAIL_SQL}) as parts from t),
     e as (select doc_id, v, parts, unnest(range(1, len(v) + 1)) as i from p),
     s as (select doc_id, i, v[i] as value, list_sum(list_transform(parts[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(v[:i - 1], lambda x: length(x))), 0) as b from e)
"""


@query(SPANS_SQL + 'select doc_id, \'EMAIL\' as label, cast(b as int) as start, cast(b + length(value) as int) as "end", value as text from s')
def tag_and_format_spans(spark, sf_dir):
    rows = _tagged(spark, sf_dir).select("doc_id", F.explode(tags.format_spans(F.col("tagged"))["entities"]).alias("e"))
    return rows.select("doc_id", "e.label", "e.start", "e.end", "e.text")


@query(SPANS_SQL + 'select doc_id, \'EMAIL\' as label, cast(b as int) as start, cast(b + length(value) as int) as "end", value as text from s')
def spans_table_function(spark, sf_dir):
    """tag_and_format_spans by SQL: a lateral join with the table function."""
    tags.register_spans(spark)
    view = f"tagged_{uuid.uuid4().hex}"
    _tagged(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(f"select doc_id, s.label, s.start, s.`end`, s.text from {view} as t, lateral spans(t.tagged) as s")


@query(SPANS_SQL + 'select doc_id, \'EMAIL\' as label, cast(b as int) as start, cast(b + length(value) as int) as "end", value as text, count(*) over () as published from s')
def published_spans(spark, sf_dir):
    """Spans of the tagged documents as the dataset sink has published them, with its manifest's count of the label."""
    path, rows = f"{shared.folder(spark)}/dataset-{uuid.uuid4().hex}", _tagged(spark, sf_dir).select("doc_id", tags.format_spans(F.col("tagged")).alias("f"))
    shared.written.append(path)
    dataset.publish(rows.select("doc_id", "f.text", "f.entities"), path, "tagged documents")
    told = dataset.manifest(spark, path, "tagged documents")["labels"]
    rows = dataset.read_published(spark, path, "tagged documents").select("doc_id", F.explode("entities").alias("e"))
    return rows.select("doc_id", "e.label", "e.start", "e.end", "e.text", F.lit(told.get("EMAIL", 0)).cast("long").alias("published"))


@query(SPANS_SQL + "select doc_id, cast(count(*) as bigint) as spans, true as valid from s group by doc_id")
def span_invariants(spark, sf_dir):
    rows = _tagged(spark, sf_dir).select("doc_id", tags.format_spans(F.col("tagged")).alias("f"))
    return rows.select("doc_id", F.size("f.entities").cast("long").alias("spans"), tags.spans_hold(F.col("f.text"), F.col("f.entities")).alias("valid"))


SKELETON_SQL = r"trim(regexp_replace(lower(text), '[ \t\n\x0B\f\r]+', ' ', 'g'))"


@query(f"select doc_id, sha256({SKELETON_SQL}) as skeleton from documents")
def sentence_skeletons(spark, sf_dir):
    """Skeletons in lower case, which leaves ß and its like; folded_skeletons has those that runs compare."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(tags.skeleton(F.col("text"), fold=F.lower), 256).alias("skeleton"))


@query(f"select doc_id, sha256(replace({SKELETON_SQL}, 'ß', 'ss')) as skeleton from documents")
def folded_skeletons(spark, sf_dir):
    """Case-folded skeletons. Of the letters that fold further than lower case, the tables hold ß alone."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(tags.skeleton(F.col("text")), 256).alias("skeleton"))


@query(f"select cast(sum(n) as bigint) as n, cast(sum(n - 1) as bigint) as duplicates from (select count(*) as n from documents group by {SKELETON_SQL})")
def exact_duplicate_rate(spark, sf_dir):
    return audit.duplicate_counts(table(spark, sf_dir, "documents").select(F.sha2(tags.skeleton(F.col("text"), fold=F.lower), 256).alias("skeleton")))


@query(f"select label, count(*) as n_values, count(distinct lower(trim(value))) as n_distinct from ({DETECTED_SQL}) group by label")
def entity_unique_ratio(spark, sf_dir):
    return audit.unique_ratios(detected(spark, sf_dir))


@query("select 'CARD_ISSUER' as label, count(*) as n_values, count(distinct lower(trim(c_mktsegment))) as n_distinct from customer")
def categorical_coverage(spark, sf_dir):
    return audit.unique_ratios(table(spark, sf_dir, "customer").select(F.lit("CARD_ISSUER").alias("label"), F.col("c_mktsegment").alias("value")))


@query("select source, lang, count(*) as n from documents group by all")
def frame_distribution(spark, sf_dir):
    return audit.frequencies(table(spark, sf_dir, "documents"), "source", "lang")


NGRAM_SQL = """
with b as (select item_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '') as t from benchmark),
     d as (select doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '') as t from documents),
     w as (select unnest([2, 3]) as w),
     gb as (select item_id, len(t) as size, w, list_distinct(list_transform(range(1, len(t) - w + 2), lambda i: array_to_string(t[i:i + w - 1], ' '))) as g from b, w),
     gd as (select doc_id, len(t) as size, w, list_distinct(list_transform(range(1, len(t) - w + 2), lambda i: array_to_string(t[i:i + w - 1], ' '))) as g from d, w),
     xb as (select item_id, size, w, len(g) as n, unnest(g) as gram from gb), xd as (select doc_id, size, w, len(g) as n, unnest(g) as gram from gd)
select doc_id, item_id, count(*) as common, cast(any_value(xd.n) + any_value(xb.n) - count(*) as bigint) as total from xd join xb using (w, gram)
where w = case when least(xd.size, xb.size) < 8 then 2 else 3 end group by doc_id, item_id
"""


@query(NGRAM_SQL)
def ngram_jaccard_benchmark(spark, sf_dir):
    """Every document and benchmark item that share an n-gram: shared and all n-grams of both."""
    tokens = text.ascii_tokens(F.col("text"))
    items = table(spark, sf_dir, "benchmark").select("item_id", tokens.alias("tokens"))
    return audit.shared_ngrams(table(spark, sf_dir, "documents").select("doc_id", tokens.alias("tokens")), items, "doc_id", "item_id")


def _h(*key: str) -> str:
    return f"cast('0x' || substr(md5(concat_ws('|', {', '.join(key)})), 1, 8) as bigint)"


def _bag_sql(values: list[str], axis: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    k = len(values)
    bag = f"cast(cast(floor((seq - 1) / {k}) as bigint) as varchar)"
    return f"list_transform(list_sort(list_transform([{items}], lambda v: {{'h': md5(concat_ws('|', '174', '{axis}', {bag}, v)), 'v': v}})), lambda x: x.v)[cast((seq - 1) % {k} + 1 as int)] as {axis}"


#: Customers as the tasks of a run: their numbers are the samples' numbers.
SEQ = "(select c_custkey + 1 as seq from customer)"


def _numbers(spark, sf_dir, name: str, key: str) -> DataFrame:
    return shared.spread(table(spark, sf_dir, name).select((F.col(key) + 1).alias("sequence_no")), 10)


def _demo_tasks(spark, sf_dir) -> DataFrame:
    return plan_tasks(spark, runs.demo(), _numbers(spark, sf_dir, "customer", "c_custkey"))


@query(f"""
select cast(seq as int) as sequence_no,
       case when {_h("'174'", "'difficulty'", "seq::varchar")} / 4294967296.0 < 0.4 then 'easy' when {_h("'174'", "'difficulty'", "seq::varchar")} / 4294967296.0 < 0.4 + 0.4 then 'medium' else 'hard' end as difficulty,
       case when {_h("'174'", "'sample_type'", "seq::varchar")} / 4294967296.0 < 0.6 then 'positive' when {_h("'174'", "'sample_type'", "seq::varchar")} / 4294967296.0 < 0.6 + 0.2 then 'pure_negative' else 'hard_negative' end as sample_type
from {SEQ}
""")
def plan_difficulty_types(spark, sf_dir):
    return _demo_tasks(spark, sf_dir).select("sequence_no", "difficulty", "sample_type")


@query(f"select cast(seq as int) as sequence_no, {', '.join(_bag_sql(v, k) for k, v in catalog.AXES.items())} from {SEQ}")
def plan_quota_axes(spark, sf_dir):
    return _demo_tasks(spark, sf_dir).select("sequence_no", *catalog.AXES)


POOL = "['PERSON', 'DATE', 'TIME', 'EMAIL', 'PHONE', 'ADDRESS', 'MONEY', 'CARD_NUMBER', 'ORGANIZATION', 'GENDER']"


@query(f"select cast(seq as int) as sequence_no, case when seq <= 200 then {POOL}[cast(floor((seq - 1) / 20) as int) + 1] else {POOL}[cast({_h("'174'", "'primary'", "seq::varchar")} % 10 as int) + 1] end as label from {SEQ}")
def plan_mandatory_labels(spark, sf_dir):
    return _demo_tasks(spark, sf_dir).select("sequence_no", F.element_at("focus_labels", 1).alias("label"))


_PLAN_SQL = f"""
with d as (select seq, {_h("'174'", "'difficulty'", "seq::varchar")} / 4294967296.0 as u, {_h("'174'", "'sample_type'", "seq::varchar")} / 4294967296.0 as v from {SEQ}),
     t as (select seq, case when u < 0.4 then 2 when u < 0.4 + 0.4 then 4 else 6 end as lim, case when v < 0.6 then 'p' when v < 0.6 + 0.2 then 'n' else 'h' end as k from d),
     c as (select *, case k when 'p' then least(lim, 6) when 'n' then lim else least(lim, 3, 2) end as most from t),
     b as (select *, case k when 'p' then greatest(0, 6 - most) when 'n' then 3 else greatest(0, 3 - most) end as budget,
             list_filter([{', '.join(f"case when {_h("'174'", f"'constraint:{n}'", "seq::varchar")} / 4294967296.0 < {p} then '{n}' end" for n, p in (("multi_sentence", 0.5), ("abbreviation", 0.3), ("numeric_noise", 0.2)))}], lambda x: x is not null) as drawn from c)
"""


@query(_PLAN_SQL + f"select cast(seq as int) as sequence_no, cast(lim as int) as max_entities, cast({_h("'174'", "'focus_count'", "seq::varchar")} % most + 1 as int) as n_labels, array_to_string(drawn[:budget], ',') as constraints from b")
def plan_complexity_budget(spark, sf_dir):
    return _demo_tasks(spark, sf_dir).select("sequence_no", "max_entities", F.size("focus_labels").alias("n_labels"), F.array_join("optional_constraints", ",").alias("constraints"))


_FRAMES_SQL = " union all ".join(f"select '{k}' as frame_id, {list(v[4])} as labels" for k, v in catalog.FRAMES.items())


@query(f"""
with f as ({_FRAMES_SQL}), s as (select a.event_type as x, b.event_type as y from (select distinct event_type from events) a, (select distinct event_type from events) b),
     l as (select x, y, [{", ".join("'" + v + "'" for v in catalog.LABELS)}][cast((length(x) * 7) % 44 as int) + 1] as a, [{", ".join("'" + v + "'" for v in catalog.LABELS)}][cast((length(y) * 11) % 44 as int) + 1] as b from s)
select x, y, a, b, frame_id from l join f on list_has_all(f.labels, [a, b])
""")
def label_frame_compat(spark, sf_dir):
    kinds = table(spark, sf_dir, "events").select("event_type").distinct()
    names = F.array(*(F.lit(x) for x in catalog.LABELS))
    label = lambda c, k: F.element_at(names, (F.length(c) * k % 44 + 1).cast("int"))
    pairs = kinds.select(F.col("event_type").alias("x")).crossJoin(F.broadcast(kinds.select(F.col("event_type").alias("y"))))
    pairs = pairs.withColumns({"a": label(F.col("x"), 7), "b": label(F.col("y"), 11)})
    return pairs.select("x", "y", "a", "b", F.explode(compatible_frames(F.array("a", "b"))).alias("frame_id"))


@query(f"select distinct upper(trim(event_type)) as label from events where upper(trim(event_type)) not in ({', '.join(repr(x) for x in catalog.LABELS)})")
def unknown_labels_anti(spark, sf_dir):
    asked = table(spark, sf_dir, "events").select(F.upper(F.trim("event_type")).alias("label"))
    return unknown_labels(asked, "label")


_ISSUES = ("missing_entity_metadata", "invalid_output", "decoy_context_unclear", "credential_risk")
_TYPES_SQL = "list_filter([" + ", ".join(f"case when event_id // {2 ** i} % 2 = 1 then '{x}' end" for i, x in enumerate(_ISSUES)) + "], lambda x: x is not null)"


@query(f"""
with t as (select event_id, {_TYPES_SQL} as types from events)
select event_id, case when len(types) = 0 then 'PASS' when list_contains(types, 'credential_risk') then 'REJECTED'
  when list_contains(types, 'missing_entity_metadata') and not list_contains(types, 'decoy_context_unclear') then 'FIXABLE' else 'REGENERATE' end as status,
  case when len(types) = 0 then null when list_contains(types, 'credential_risk') then 'critical'
  when list_contains(types, 'missing_entity_metadata') and not list_contains(types, 'decoy_context_unclear') then 'low' else 'high' end as severity from t
""")
def issue_routing(spark, sf_dir):
    types = F.filter(F.array(*(F.when(F.floor(F.col("event_id") / 2**i) % 2 == 1, F.lit(x)) for i, x in enumerate(_ISSUES))), lambda x: x.isNotNull())
    return table(spark, sf_dir, "events").select("event_id", flow.route(types).alias("r")).select("event_id", "r.status", "r.severity")


@query("""
select conv_id, case when bool_or(role = 'system') then 'SEEDS' when bool_or(role = 'assistant') then 'CONTEXT' when count(*) > 0 then 'TEXT' end as scope from conversations group by conv_id
""")
def regeneration_scope(spark, sf_dir):
    scope = F.when(F.col("role") == "system", "SEEDS").when(F.col("role") == "assistant", "CONTEXT").otherwise("TEXT")
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_set(scope).alias("scopes"))
    return rows.select("conv_id", flow.worst_scope(F.col("scopes")).alias("scope"))


@query("""
with n as (select event_id, user_id, event_type, row_number() over (partition by user_id order by event_id) as seq from events),
     p as (select *, max(seq) over (partition by user_id, event_type order by seq rows between unbounded preceding and 1 preceding) as last from n)
select event_id, user_id, coalesce(seq - last <= 3, false) as reused from p
""")
def recent_window_entity_reuse(spark, sf_dir):
    """Whether one of the user's last three events had the same type."""
    rows = table(spark, sf_dir, "events").withColumn("seq", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")))
    rows = rows.withColumns({"label": F.lit("VALUE"), "value": F.col("event_type")})
    return audit.reused_values(rows, "user_id", "seq", 3).select("event_id", "user_id", "reused")


_CALLS_SQL = """
calls as (select conv_id, turn, case role when 'user' then 'generator' when 'assistant' then 'judge' else 'repair' end as category, length(text) as i, length(text) // 2 as o from conversations),
priced as (select *, cast(round(cast(cast(i as decimal(18,0)) * 2.50 + cast(o as decimal(18,0)) * 10.00 as decimal(28,2)) / 1000000, 8) as decimal(20,8)) as cost from calls)
"""


def _calls(spark, sf_dir) -> DataFrame:
    role = F.when(F.col("role") == "user", "generator").when(F.col("role") == "assistant", "judge").otherwise("repair")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", role.alias("category"), F.length("text").alias("input_tokens"), F.floor(F.length("text") / 2).cast("int").alias("output_tokens"))
    return rows.withColumn("money_cost", text.token_cost(F.col("input_tokens"), F.col("output_tokens")))


@query(f"""
with {_CALLS_SQL}
select conv_id, cast(sum(case when category = 'generator' then i else 0 end) as bigint) as generator_input, cast(sum(case when category = 'judge' then i else 0 end) as bigint) as judge_input,
       cast(sum(case when category = 'repair' then o else 0 end) as bigint) as repair_output, cast(sum(i + o) as bigint) as total_tokens from priced group by conv_id
""")
def usage_rollup_by_slot(spark, sf_dir):
    return flow.usage_by_slot(_calls(spark, sf_dir), ["conv_id"]).select("conv_id", "generator_input", "judge_input", "repair_output", "total_tokens")


@query("select conv_id, turn, cast(round((length(text) * 250 + (length(text) // 2) * 1000)) as bigint) as cost_e8 from conversations")
def token_cost(spark, sf_dir):
    """Cost of each call in units of 1e-8."""
    return _calls(spark, sf_dir).select("conv_id", "turn", (F.col("money_cost") * 100_000_000).cast("long").alias("cost_e8"))


@query(f"with {_CALLS_SQL} select conv_id, category, min(turn) as turn from priced group by conv_id, category")
def usage_dedup(spark, sf_dir):
    return flow.first_by_key(_calls(spark, sf_dir), ["conv_id", "category"], ["turn"]).select("conv_id", "category", "turn")


@query("select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, event_type order by event_id desc) as n from events) where n = 1")
def slot_latest_replacement(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumns({"replacement_no": F.col("event_id"), "sequence_no": F.col("event_id")})
    return flow.latest_in_slot(rows, "user_id", "event_type").select("user_id", "event_type", "event_id")


@query("select o_orderkey as sequence_no, o_orderstatus as status from orders where o_orderstatus <> 'F'")
def pending_tasks(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "ACCEPTED").otherwise(F.col("o_orderstatus"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sequence_no"), status.alias("status"))
    return flow.pending(rows)


@query("""
select c.conv_id, min(c.turn) as first_turn, cast(count(*) as bigint) as turns, bool_and(ok) as alternates, count(distinct role) = 2 as two_speakers
from (select *, coalesce(role <> lag(role) over (partition by conv_id order by turn), true) as ok from conversations) c group by c.conv_id
""")
def chat_structure_check(spark, sf_dir):
    return audit.dialogue_shape(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role")


@query("select user_id, event_type, min(event_id) as event_id, count(*) as deliveries from events group by user_id, event_type")
def event_dedup_idempotent(spark, sf_dir):
    return flow.deliveries(table(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id")


@query("select time_bucket(interval '10 minutes', ts) as window_start, event_type, count(*) as n from events group by all")
def event_window_counts(spark, sf_dir):
    from annolith.streaming.events import counts

    return counts(table(spark, sf_dir, "events"), "ts")


@query("select doc_id, sha256(text) as output_hash from documents")
def output_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.output_hash(F.col("text")).alias("output_hash"))


@query()
def near_duplicate_rate(spark, sf_dir):
    """Conversation turns close to one of the 200 turns before them in their conversation."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", tags.skeleton(F.col("text")).alias("skeleton"))
    return audit.near_duplicates(rows, "conv_id", "turn", "skeleton").select("conv_id", "turn", F.round("best_ratio", 6).alias("best_ratio"), "near_duplicate")


@query()
def imitation_guard(spark, sf_dir):
    """Conversation turns against the first three turns of the next conversation."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    examples = rows.where("turn < 3").groupBy((F.col("conv_id") - 1).alias("conv_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("examples"))
    out = audit.imitation(rows.join(examples, "conv_id", "left"), "text", "examples")
    return out.select("conv_id", "turn", "closest", F.round("sequence", 6).alias("sequence"), F.round("ngram", 6).alias("ngram"), "imitates")


def _templates_sql(labels) -> str:
    rows = ", ".join(f"('{label}', [{', '.join(templates.sql_parts(parts) for _, parts in values.PARSED[label])}], {[name for name, _ in values.PARSED[label]]})" for label in labels)
    return f"templates(label, parts, variants) as (values {rows})"


def _pick(h: str, size: str) -> str:
    return f"cast({h} % {size} as int) + 1"


_UNIQUE_SQL = f"with each as (select c_custkey, unnest({list(catalog.LABELS)}) as label, c_custkey as counter from customer), {unique.sql_values('each', "'174'")}"


def _customer_values(spark, sf_dir) -> DataFrame:
    """A value of every label for each customer, none of them repeated while a label has values left."""
    keys = shared.spread(table(spark, sf_dir, "customer").select("c_custkey"), len(catalog.LABELS))
    rows = keys.select("c_custkey", F.col("c_custkey").alias("counter"), F.explode(F.array(*(F.lit(x) for x in catalog.LABELS))).alias("label"))
    return unique.with_values(rows, [F.lit("174")])


@query(_UNIQUE_SQL + "select c_custkey, label, value, variant, true as valid from unique_values")
def seed_values(spark, sf_dir):
    """A value, its variant and format check for every label and customer."""
    return _customer_values(spark, sf_dir).select("c_custkey", "label", "value", "variant", detect.valid_format(F.col("label"), F.col("value")).alias("valid"))


@query(_UNIQUE_SQL + ", c(label, capacity) as (values " + ", ".join(f"('{k}', {n}::bigint)" for k, n in unique.capacities().items()) + """)
select label, capacity, count(*) as n_values, count(distinct lower(trim(value))) as n_distinct, least(count(*), capacity) = count(distinct lower(trim(value))) as never_early from unique_values join c using (label) group by label, capacity
""")
def run_wide_unique_values(spark, sf_dir):
    """How many of a run's values are distinct, by label: all of them, or all that a label of small capacity has."""
    ratios = audit.unique_ratios(_customer_values(spark, sf_dir))
    capacity = spark.createDataFrame(list(unique.capacities().items()), "label string, capacity long")
    rows = ratios.join(F.broadcast(capacity), "label")  # 44 labels
    return rows.select("label", "capacity", "n_values", "n_distinct", (F.least("n_values", "capacity") == F.col("n_distinct")).alias("never_early"))


def _shuffled_sql(items: str, *key: str) -> str:
    return f"list_transform(list_sort(list_transform({items}, lambda v: {{'h': md5(concat_ws('|', {', '.join(key)}, v)), 'v': v}})), lambda x: x.v)"


DEMO_LABELS = runs.demo().focus_labels
_FRAME_LIST = "[" + ", ".join(f"{{'id': '{k}', 'labels': {list(v[4])}}}" for k, v in catalog.FRAMES.items()) + "]"
_FRAME_PLACE = "case f " + " ".join(f"when '{k}' then {i}" for i, k in enumerate(catalog.FRAMES, 1)) + " end"
_FRAME_BIT = "case f " + " ".join(f"when '{k}' then {1 << i}" for i, k in enumerate(catalog.FRAMES)) + " end"
_STRATEGY_LIST = ", ".join(
    f"('{label}', [" + ", ".join(f"{{'id': '{name}', 'cue': '{required[0]}', 'regex': $re${regex}$re$, 'parts': {templates.sql_parts(parts)}}}" for name, x, _, _, _, regex, required, *_, parts in sorted(registry(), key=lambda r: r[0]) if x == label) + "])"
    for label in DEMO_LABELS)
#: tasks of the demo run: number, id, type, labels, axes, frame.
TASKS_SQL = _PLAN_SQL + f""",
     p1 as (select *, case when seq <= 200 then {POOL}[cast(floor((seq - 1) / 20) as int) + 1] else {POOL}[{_pick(_h("'174'", "'primary'", "seq::varchar"), "10")}] end as first, cast({_h("'174'", "'focus_count'", "seq::varchar")} % most as int) as more from b),
     p2 as (select *, list_concat([first], {_shuffled_sql(f"list_filter({POOL}, lambda x: x <> first)", "'174'", "'label_order'", "seq::varchar")}[:more]) as labels from p1),
     p3 as (select *, list_transform(list_filter({_FRAME_LIST}, lambda f: list_has_all(f.labels, labels)), lambda f: f.id) as frames, array_to_string(list_sort(labels), ',') as key from p2),
     p4 as (select *, row_number() over (partition by key order by seq) - 1 as nth, md5('demo|174|' || seq) as task_id, case k when 'p' then 'positive' when 'n' then 'pure_negative' else 'hard_negative' end as sample_type from p3),
     tasks as (select *, {_shuffled_sql("frames", "'174'", "'frame'", "key", "cast(nth // len(frames) as varchar)")}[cast(nth % len(frames) as int) + 1] as frame, {', '.join(_bag_sql(v, n) for n, v in catalog.AXES.items())} from p4)
"""
#: ... with seeds and look-alikes of the first attempt.
PACKS_SQL = TASKS_SQL + f""", strategies(label, options) as (values {_STRATEGY_LIST}),
     each as (select seq, unnest(labels) as label, unnest(range(1, len(labels) + 1)) as place, seq - 1 as counter from tasks where k <> 'n'),
     {unique.sql_values("each", "'174'")},
     seeds as (select seq, list({{'label': label, 'value': value}} order by place) as seeds from unique_values group by seq),
     lures as (select seq, task_id, labels, unnest(range(0, cast({_h("'174'", "'decoys'", "task_id", "'0'")} % 2 as int) + 1)) as j from tasks where k = 'h'),
     picked as (select seq, task_id, j, labels[j % len(labels) + 1] as label, options[cast(({_h("'174'", "'strategy'", "task_id", "'0'")} + j // len(labels)) % 3 as int) + 1] as o from lures join strategies on strategies.label = labels[j % len(labels) + 1]),
     decoys as (select seq, list({{'id': o.id, 'cue': o.cue, 'value': value, 'fits': regexp_matches(value, o.regex)}} order by j) as decoys from (select *, {templates.sql_drawn("o.parts", "'174', 'decoy', task_id, '0', j::varchar")} as value from picked) group by seq),
     packs as (select tasks.*, seeds, decoys from tasks left join seeds using (seq) left join decoys using (seq))
"""


def _demo_packs(spark, sf_dir) -> DataFrame:
    config = runs.demo()
    return samples.seed_packs(_demo_tasks(spark, sf_dir), strategies(spark), config.random_seed, 0, False, config.min_decoys, config.max_decoys)


@query(PACKS_SQL + "select cast(seq as int) as sequence_no, sample_type, cast(coalesce(len(seeds), 0) as int) as n_seeds, d.id as strategy_id, d.value, 0 as n_issues from (select *, unnest(case when decoys is null then [null] else decoys end) as d from packs)")
def decoy_pick(spark, sf_dir):
    """Look-alikes of the demo run's tasks; every pack passes the seed-pack check."""
    checked = samples.seed_pack_issues(_demo_packs(spark, sf_dir), strategies(spark), False, 1, 2)
    return checked.select("sequence_no", "sample_type", F.size("positives").alias("n_seeds"), F.explode_outer("decoys").alias("d"), F.size("pack_issues").alias("n_issues")).select("sequence_no", "sample_type", "n_seeds", "d.strategy_id", "d.value", "n_issues")


def _map_sql(rows: dict[str, str], key: str) -> str:
    return f"case {key} " + " ".join(f"when '{k}' then '{v}'" for k, v in rows.items()) + " end"


_DOMAIN = _map_sql({k: v[0] for k, v in catalog.FRAMES.items()}, "frame")


def _terms_sql(name: str) -> str:
    general, place = samples.CONTENT[name]
    own = "[]" if place is None else "case " + _DOMAIN + " " + " ".join(f"when '{k}' then ['{v[place]}']" for k, v in samples.DOMAIN_TERMS.items()) + " else [] end"
    return _shuffled_sql(f"list_concat({general}, {own})", "'174'", f"'{name}'", "task_id", "'0'", _DOMAIN) + f"[:{samples.CONTENT_TERMS}]"


_CONTENT = [f"({_terms_sql(name)})[1]" for name in ("action", "object")]
#: ... and the text of the offline renderer.
RENDER_SQL = PACKS_SQL + f""",
     w as (select *, {_map_sql(samples.ROLES, "speaker_role")} as role, {_map_sql(samples.INTENTS, "intent")} as aim, {_map_sql(samples.MARKERS, "language_register")} as marker, {_map_sql({k: v[1] for k, v in catalog.FRAMES.items()}, "frame")} as document,
             case when k = 'n' then {_CONTENT[0]} || ' ' || {_CONTENT[1]} else array_to_string(list_transform(seeds, lambda s: '<' || s.label || '>' || s.value || '</' || s.label || '>'), '; ') end as content from packs),
     said as (select *, role || ' ' || aim || ' ' || content as said from w),
     rendered as (select *, case document_structure
        when 'short_dialogue' then upper(role[1]) || role[2:] || ': ' || aim || ' ' || content || '.' || chr(10) || 'Trực ban: Đã chép vào ' || document || '.'
        when 'two_sentence_note' then marker || ': ' || said || '. Phần này nằm trong ' || document || ' chờ duyệt.'
        when 'form_like_record' then upper(document) || ' / Bên gửi: ' || role || ' / Việc: ' || aim || ' / Phần chính: ' || content || '.'
        else marker || ': ' || said || ' theo ' || document || '.' end
        || coalesce(array_to_string(list_transform(decoys, lambda d: ' ' || upper(d.cue[1]) || d.cue[2:] || ' để chuyển bước sau là ' || d.value || '.'), ''), '') as tagged_text from said)
"""


@query(RENDER_SQL + "select cast(seq as int) as sequence_no, sample_type, tagged_text, true as valid from rendered")
def render_offline(spark, sf_dir):
    rows = runs.candidates(spark, _demo_tasks(spark, sf_dir), runs.demo(), 0)
    return rows.select("sequence_no", "sample_type", "tagged_text", "valid")


@query(RENDER_SQL + """
, dm as (select seq, k, labels, seeds, case when k = 'n' then null when seq % 5 = 0 then 0 when seq % 5 = 1 then 1 when seq % 5 = 2 and k = 'h' then 2 end as harm from rendered),
  em as (select seq, 'invalid_output' as type, null as label, null as value from dm where harm in (0, 1)
        union all select seq, 'missing_positive_seed', s.label, s.value from (select seq, unnest(seeds) as s from dm where harm = 0)
        union all select seq, 'duplicate_positive_seed', s.label, s.value from (select seq, unnest(seeds) as s from dm where harm = 0)
        union all select seq, 'missing_entity_metadata', seeds[1].label, seeds[1].value from dm where harm = 1
        union all select dm.seq, 'decoy_occurrence', labels[1], decoys[1].value from dm join decoys using (seq) where harm = 2
        union all select dm.seq, 'decoy_context_unclear', labels[1], decoys[1].value from dm join decoys using (seq) where harm = 3)
select cast(dm.seq as int) as sequence_no, em.type, case when em.type is null then null else 'TEXT' end as scope, em.label, em.value from dm left join em using (seq)
""")
def validate_output(spark, sf_dir):
    """Issues of candidates damaged in three ways: closing tags lost, the first entity unlisted, the first look-alike said twice."""
    rows = samples.render(_demo_packs(spark, sf_dir), runs.DOCUMENTS)
    n, seeded = F.col("sequence_no") % 5, F.col("sample_type") != "pure_negative"
    twice = F.concat("tagged_text", F.lit(" Nhắc lại "), F.get("decoys", F.lit(0))["required"][0], F.lit(" "), F.get("decoys", F.lit(0))["value"], F.lit("."))
    rows = rows.withColumns({
        "tagged_text": F.when((n == 0) & seeded, F.regexp_replace("tagged_text", "</[A-Z_]+>", "")).when((n == 2) & (F.col("sample_type") == "hard_negative"), twice).otherwise(F.col("tagged_text")),
        "entities": F.when((n == 1) & seeded, F.slice("entities", 2, 99)).otherwise(F.col("entities")),
    })
    return samples.validate(rows).select("sequence_no", F.explode_outer("issues").alias("i")).select("sequence_no", "i.type", "i.scope", "i.label", "i.value")


@query(_PLAN_SQL + "select cast(seq as int) as sequence_no, unnest(drawn[:budget]) as name from b")
def plan_constraints(spark, sf_dir):
    return _demo_tasks(spark, sf_dir).select("sequence_no", F.explode("optional_constraints").alias("name"))


@query(_PLAN_SQL + "select k, name, count(*) as n from (select case k when 'p' then 'positive' when 'n' then 'pure_negative' else 'hard_negative' end as k, unnest(drawn[:budget]) as name from b) group by all")
def constraint_distribution(spark, sf_dir):
    rows = _demo_tasks(spark, sf_dir).select(F.col("sample_type").alias("k"), F.explode("optional_constraints").alias("name"))
    return audit.frequencies(rows, "k", "name")


VARIANTS = {k: " ".join(v) for k, v in values.FORMAT_VARIANTS.items()}


@query("with v(label, names) as (values " + ", ".join(f"('{k}', string_split('{v}', ' '))" for k, v in VARIANTS.items()) + f"""),
     d as (select label, names[cast({_h("'174'", "'query'", "c_custkey::varchar", "label", "'variant'")} % 3 as int) + 1] as variant from customer, v)
select label, variant, count(*) as n from d group by all""")
def format_variant_distribution(spark, sf_dir):
    keys = shared.spread(table(spark, sf_dir, "customer").select("c_custkey"), len(VARIANTS))
    rows = keys.select("c_custkey", F.explode(F.array(*(F.lit(x) for x in VARIANTS))).alias("label"))
    made = samples.entity_value(F.col("label"), 174, "query", F.col("c_custkey").cast("string"), F.col("label"))
    return samples.with_templates(rows).select("label", made["variant"].alias("variant")).groupBy("label", "variant").agg(F.count("*").alias("n"))


NUMBERS_SQL = "(select distinct doc_id, unnest(regexp_extract_all(text, '[0-9]+')) as value from documents)"


@query(f"""
select doc_id, value, array_to_string(list_sort(list_filter([case when regexp_full_match(value, '(84|0)[35789][0-9]{{8}}') then 'PHONE' end, case when length(value) in (5, 6) then 'ZIP_CODE' end,
  case when length(value) between 13 and 19 then 'CARD_NUMBER' end, case when length(value) in (3, 4) then 'CVV' end, case when length(value) in (3, 4) then 'PIN' end], lambda x: x is not null)), ',') as labels from {NUMBERS_SQL}
""")
def value_structured_labels(spark, sf_dir):
    """The labels that each number in a document could stand for."""
    numbers = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0)))).alias("value"))
    return numbers.select("doc_id", "value", F.array_join(detect.structured_labels(F.col("value")), ",").alias("labels"))


FORMATS = {"dmy_slash": ("dd/MM/yyyy", "%d/%m/%Y"), "dmy_hyphen": ("dd-MM-yyyy", "%d-%m-%Y"), "iso": ("yyyy-MM-dd", "%Y-%m-%d"), "mdy_slash": ("MM/dd/yyyy", "%m/%d/%Y"), "dots": ("dd.MM.yyyy", "%d.%m.%Y")}


@query(" union all ".join(
    f"select o_orderkey, '{k}' as form, {'day(o_orderdate) <= 12' if k == 'mdy_slash' else str(k != 'dots').lower()} as valid from orders" for k in FORMATS))
def seed_format_checks(spark, sf_dir):
    """Whether order dates, written in five ways, have the format of DATE values."""
    forms = F.array(*(F.struct(F.lit(k).alias("form"), F.date_format("o_orderdate", v[0]).alias("value")) for k, v in FORMATS.items()))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(forms).alias("f"))
    return rows.select("o_orderkey", "f.form", detect.valid_format(F.lit("DATE"), F.col("f.value")).alias("valid"))


@query(rf"""
with e as (select doc_id, regexp_replace(text, '</?[A-Za-z][A-Za-z0-9_]*>', '', 'g') as t, regexp_extract(text, {EMAIL_SQL}) as v from documents where regexp_matches(text, {EMAIL_SQL})),
     p as (select doc_id, v, string_split(t, v) as parts from e), i as (select *, unnest(range(1, len(parts))) as i from p)
select doc_id, v as value, cast(i as int) as i, regexp_replace(regexp_extract(list_reduce(parts[:i], lambda a, b: a || v || b), '[^.!?;\n]*$') || v || regexp_extract(list_reduce(parts[i + 1:], lambda a, b: a || v || b), '^[^.!?;\n]*[.!?;\n]?'), '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g') as context from i
""")
def decoy_contexts(spark, sf_dir):
    """The sentence around each occurrence of a document's first e-mail address."""
    rows = table(spark, sf_dir, "documents").where(F.col("text").rlike(detect.DETECTORS["EMAIL"])).withColumn("value", F.regexp_extract("text", detect.DETECTORS["EMAIL"], 0))
    return rows.select("doc_id", "value", F.posexplode(tags.occurrence_contexts(F.col("text"), F.col("value"))).alias("at", "context")).select("doc_id", "value", (F.col("at") + 1).alias("i"), "context")


@query("""
with t as (select o_orderkey as task, o_custkey as slot_no, cast(row_number() over (partition by o_custkey order by o_orderkey) - 1 as int) as replacement_no, o_orderstatus from orders),
     s as (select l_orderkey as task, count(*) as n from lineitem group by l_orderkey)
select task, slot_no, replacement_no, n from t join s using (task) where o_orderstatus = 'F'
""")
def accepted_samples_ordered(spark, sf_dir):
    """Orders as tasks, customers as slots, lines as samples: those of accepted tasks, by slot and replacement."""
    number = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    status = F.when(F.col("o_orderstatus") == "F", "ACCEPTED").otherwise("CREATED")
    tasks = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task_id"), F.col("o_custkey").alias("slot_no"), F.col("o_orderkey").alias("sequence_no"), number.alias("replacement_no"), status.alias("status"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("task_id")).agg(F.count("*").alias("n"))
    return flow.accepted_samples(tasks, lines).select(F.col("task_id").alias("task"), "slot_no", "replacement_no", "n")


@query("""
select event_id, case event_id % 5 when 0 then 'PASS' when 1 then 'REGENERATE' when 2 then 'REJECTED' else case when event_id % 7 = 0 then 'REGENERATE' when event_id % 3 = 0 then 'FIXED' when event_id % 3 = 1 then 'REJECTED' else 'REGENERATE' end end as outcome,
       case when event_id % 5 < 3 then 1 when event_id % 7 = 0 then 2 else 3 end as calls from events
""")
def verification_outcomes(spark, sf_dir):
    """Judged path of one candidate an event, by stand-in models that decide by its number."""
    from annolith.shared import cut

    word = lambda xs, n: F.element_at(F.array(*(F.lit(x) for x in xs)), (F.col("event_id") % n + 1).cast("int"))
    none = F.array().cast(f"array<{verify.ISSUE}>")
    seed = F.struct(F.lit("TIME").alias("label"), F.date_format("ts", "HH:mm").alias("value"))
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.lit("positive").alias("sample_type"), F.array(F.lit("TIME")).alias("focus_labels"), F.lit(2).alias("max_entities"),
        F.array(F.struct(seed["label"].alias("label"), seed["value"].alias("value"), F.lit("24h").alias("variant"))).alias("positives"),
        F.array().cast("array<struct<strategy_id:string,label:string,value:string,required:array<string>,forbidden:array<string>>>").alias("decoys"),
        F.concat(F.lit("Lúc <TIME>"), seed["value"], F.lit("</TIME>.")).alias("tagged_text"), F.array(seed).alias("entities"))

    def judge(df):
        status = word(["PASS", "REGENERATE", "REJECTED", "FIXABLE", "FIXABLE"], 5) if "origin" not in df.columns else word(["PASS", "REJECTED", "FIXABLE"], 3)
        return df.withColumn("verdict", F.struct(status.alias("status"), none.alias("issues")))

    def repair(df):
        return df.withColumn("tagged_text", F.when(F.col("event_id") % 7 == 0, "Lúc này.").otherwise(F.concat("tagged_text", F.lit(" Sửa."))))

    out = verify.verify(rows, judge, repair, samples.validate, cut)
    return out.select("event_id", "outcome", F.size("stages").alias("calls"))


@query()
def novelty_guard(spark, sf_dir):
    """Conversation turns against those accepted before in their conversation; none is accepted twice."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", tags.skeleton(F.col("text")).alias("skeleton"), F.array().cast("array<struct<label:string,value:string>>").alias("entities"), F.lit(True).alias("valid"))
    out = novelty.guard(rows, "enforce", "conv_id", "turn")
    return out.select("conv_id", "turn", F.round("max_similarity", 6).alias("max_similarity"), F.size("nearest").alias("n_nearest"), F.array_join(novelty.issue_types(F.col("novelty_issues")), ",").alias("issues"), "accepted")


@query("""
select conv_id, turn, '{"role":' || to_json(role) || ',"length":' || length(text) || '}' as content from conversations where text is not null
""")
def message_envelopes(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").where("text is not null")
    made = guidance.messages("system", role=F.col("role"), length=F.length("text"))
    return rows.select("conv_id", "turn", made[1]["content"].alias("content"))


@query()
def audit_report(spark, sf_dir):
    planned = plan_tasks(spark, runs.demo(), _numbers(spark, sf_dir, "customer", "c_custkey"))
    accepted = runs.run(spark, runs.demo(), planned=planned).accepted
    values = lambda f: F.transform("decoys", lambda d: d[f])
    rows = accepted.select(F.lit("demo").alias("run_id"), "sequence_no", "tagged_text", "entities", values("value").alias("decoys"), F.col("context_frame_id").alias("frame_id"), values("strategy_id").alias("strategy_ids"), F.col("optional_constraints").alias("constraints"), F.col("positives").alias("variants"))
    flat = audit.report(rows)
    return flat.select("n", "duplicates", "exact_duplicate_rate", "near_duplicate_rate", F.to_json("unique_ratio").alias("unique_ratio"), F.to_json("coverage").alias("coverage"), F.to_json("frames").alias("frames"), F.to_json("strategies").alias("strategies"), F.to_json("constraint_counts").alias("constraints"), F.to_json("variant_counts").alias("variants"))


@query("""
with o as (select o_orderkey as k, 'ban.doc' || o_orderkey || '@vi-du.org' as email, '09' || lpad(cast(o_orderkey % 100000000 as varchar), 8, '0') as phone, 'https://vi-du.org/don/' || o_orderkey as url, strftime(o_orderdate, '%d/%m/%Y') as day,
             lpad(cast(o_orderkey % 24 as varchar), 2, '0') || ':' || lpad(cast(o_orderkey % 60 as varchar), 2, '0') as clock, '10.' || o_orderkey % 256 || '.' || o_custkey % 256 || '.7' as ip, 'USR-' || lpad(cast(o_orderkey as varchar), 6, '0') as account from orders),
     u as (unpivot o on email, phone, url, day, clock, ip, account into name label value found)
select k as o_orderkey, case label when 'email' then 'EMAIL' when 'phone' then 'PHONE' when 'url' then 'URL' when 'day' then 'DATE' when 'clock' then 'TIME' when 'ip' then 'IP' else 'ACCOUNT_ID' end as label, found as value from u
""")
def seven_detectors(spark, sf_dir):
    """The first match of each detector in a sentence about each order, past look-alikes that are none."""
    k, pad = F.col("o_orderkey").cast("string"), lambda x, n: F.lpad(x.cast("string"), n, F.lit("0"))
    parts = [
        F.lit("Mã 1234567890123456, ngày 45/13/2024, lúc 27:61, a@b, XUSR-99, 1.2.3.4.5: thư ban.doc"), k, F.lit("@vi-du.org gọi 09"), pad(F.col("o_orderkey") % 100000000, 8), F.lit(" xem https://vi-du.org/don/"), k, F.lit(" ngày "), F.date_format("o_orderdate", "dd/MM/yyyy"),
        F.lit(" lúc "), pad(F.col("o_orderkey") % 24, 2), F.lit(":"), pad(F.col("o_orderkey") % 60, 2), F.lit(" máy 10."), (F.col("o_orderkey") % 256).cast("string"), F.lit("."), (F.col("o_custkey") % 256).cast("string"), F.lit(".7 mã USR-"), pad(F.col("o_orderkey"), 6), F.lit("!"),
    ]
    rows = shared.spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), 7).select("o_orderkey", F.concat(*parts).alias("said")).select("o_orderkey", F.explode(detect.first_matches(F.col("said"))).alias("m"))
    return rows.select("o_orderkey", "m.label", "m.value")


#: A run in which tasks fail in every way, by their number: see the attempt below.
_FATE_SQL = """
with f as (select seq, seq % 8 as fate from (select s_suppkey + 1 as seq from supplier)),
     r as (select *, case when fate in (1, 2, 3, 5, 6) then 2 else 1 end as attempts, case when fate in (3, 5, 6) then 'REJECTED' when fate = 7 then 'VERIFYING' else 'ACCEPTED' end as status,
             case fate when 4 then 'FIXED' when 7 then 'VERIFYING' when 3 then 'REGENERATE' when 5 then 'REGENERATE' when 6 then 'REGENERATE' else 'PASS' end as outcome from f)
"""


def _eventful(spark, sf_dir):
    """A positive task for each supplier: of eight in turn 0 passes; 1 loses its tags once; 2 is refused by the judge once; 3 never has tags; 4 has an
    unlisted entity, which the repair mends; 5 is refused always; 6 imitates an example; 7 meets a judge that is down."""
    config = runs.demo(minimum_per_label=0, sample_type_distribution={"positive": 1.0, "pure_negative": 0.0, "hard_negative": 0.0}, quality_checks=True, max_regenerate_attempts=1, max_task_replacements=0)
    fate = F.col("slot_no") % 8

    def attempt(packs, n):
        rows = samples.render(packs, runs.DOCUMENTS)
        bare = F.regexp_replace("tagged_text", "</?[A-Z_]+>", "")
        copied = F.concat(F.lit("Câu mẫu dài để người ta so: "), F.array_join(F.transform("positives", lambda p: F.concat(F.lit("<"), p["label"], F.lit(">"), p["value"], F.lit("</"), p["label"], F.lit(">"))), " "))
        return rows.withColumns({
            "tagged_text": F.when((fate == 3) | ((fate == 1) & F.lit(n == 1)), bare).when(fate == 6, copied).otherwise(F.col("tagged_text")),
            "entities": F.when(fate == 4, F.slice("entities", 2, 99)).otherwise(F.col("entities")),
        })

    def judge(rows):
        refused = (fate == 5) | ((fate == 2) & (F.col("attempt_no") == 1))
        issue = F.array(F.struct(F.lit("UNCLEAR"), F.lit("high"), F.lit("candidate"), F.lit("said so")).cast(verify.ISSUE))
        status = F.when(fate == 7, "ERROR").when(refused, "REGENERATE").otherwise("PASS")
        return rows.withColumn("verdict", F.struct(status.alias("status"), F.when(refused, issue).otherwise(F.filter(issue, lambda i: F.lit(False))).alias("issues")))

    def repair(rows):
        return rows.withColumn("entities", F.transform("positives", lambda p: F.struct(p["label"].alias("label"), p["value"].alias("value"))))

    shot = lambda p: F.array(*(F.struct(F.lit(f"{p}{i}").alias("id"), F.lit(t).alias("expected_tagged_text"), F.lit("").alias("rationale")) for i, t in enumerate(["Câu mẫu dài để người ta so: <X>y</X>", "Khác.", "Nữa."])))
    taxonomy = spark.createDataFrame([(x,) for x in runs.demo().focus_labels], "code string").select("code", F.lit("d").alias("definition"), F.array(F.lit("r")).alias("rules"), F.struct(shot("p").alias("POSITIVE"), shot("n").alias("PURE_NEGATIVE"), shot("h").alias("HARD_NEGATIVE")).alias("examples"))
    planned = plan_tasks(spark, config, _numbers(spark, sf_dir, "supplier", "s_suppkey"))
    return runs.run(spark, config, attempt=attempt, taxonomy=taxonomy, judge=judge, repair=repair, planned=planned)


@query(_FATE_SQL + """
select cast(seq as int) as slot_no, status, cast(attempts as int) as attempts, outcome,
       cast(1 + 3 * attempts + case when fate in (3, 6) then 2 when fate = 1 then 1 else 0 end + case when fate in (0, 1, 4, 7) then 1 when fate in (2, 5) then 2 else 0 end
            + case fate when 2 then 1 when 5 then 2 else 0 end + case status when 'ACCEPTED' then 2 when 'REJECTED' then 1 else 0 end as bigint) as events from r
""")
def run_outcomes(spark, sf_dir):
    """Status, attempts, last outcome and events of each slot of a run in which tasks fail in every way."""
    from annolith.sources.events import run_events

    done = _eventful(spark, sf_dir)
    last = done.attempts.groupBy("task_id").agg(F.count("*").cast("int").alias("attempts"), F.max_by("outcome", "attempt_no").alias("outcome"))
    told = audit.frequencies(run_events(done, "2026-01-01 00:00:00").withColumnRenamed("causation_id", "task_id"), "task_id").withColumnRenamed("n", "events")
    return done.tasks.join(last, "task_id").join(told, "task_id").select("slot_no", "status", "attempts", "outcome", "events")


@query("""
select o_orderkey as task_id, case o_orderstatus when 'F' then 'VERIFYING' when 'O' then 'GENERATING' else 'CREATED' end as status,
  cast(case when nxt <= 3 then nxt end as int) as attempt_no from (select *, coalesce(last, 0) + case when o_orderstatus = 'F' and last is not null then 0 else 1 end as nxt
  from orders left join (select l_orderkey, max(least(l_linenumber, 4)) as last from lineitem where l_quantity < 20 group by l_orderkey) on l_orderkey = o_orderkey)
""")
def resume_attempts(spark, sf_dir):
    """Where work on each order, as a task, goes on, with its small lines as candidates."""
    tasks = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task_id"), F.when(F.col("o_orderstatus") == "F", "VERIFYING").when(F.col("o_orderstatus") == "O", "GENERATING").otherwise("CREATED").alias("status"), F.lit(3).alias("max_attempts"))
    made = table(spark, sf_dir, "lineitem").where("l_quantity < 20").select(F.col("l_orderkey").alias("task_id"), F.least("l_linenumber", F.lit(4)).alias("attempt_no"))
    return flow.next_attempt(tasks, made).select("task_id", "status", "attempt_no")


@query("select o_orderkey as sequence_no from orders where o_orderstatus <> 'F' order by o_orderkey limit 25")
def batch_limit(spark, sf_dir):
    """The first tasks of a batch: the smaller of limit and batch size."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sequence_no"), F.when(F.col("o_orderstatus") == "F", "ACCEPTED").otherwise("CREATED").alias("status"))
    return flow.batch(rows, 40, 25).select("sequence_no")


@query("select distinct l_orderkey as task_id, l_linenumber as attempt_no from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')")
def candidate_idempotency(spark, sf_dir):
    """Lines, delivered twice, as candidates; those of finished orders are known already."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("task_id"), F.col("l_linenumber").alias("attempt_no"))
    known = rows.join(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("task_id")), "task_id")
    return flow.new_candidates(rows.union(rows), known)


@query(PACKS_SQL + "select task_id, frame as frame_id, array_to_string(list_transform(coalesce(decoys, []), lambda d: d.id), ',') as strategies, array_to_string(list_transform(coalesce(decoys, []), lambda d: d.value), ',') as decoys from packs")
def seed_event_join(spark, sf_dir):
    """Results with the look-alikes and frame that their seed.validated events hold."""
    packs = _demo_packs(spark, sf_dir)
    decoys = F.transform("decoys", lambda d: F.struct(d["strategy_id"].alias("strategy_id"), d["value"].alias("value")))
    events = packs.select(F.lit("seed.validated").alias("event_type"), F.col("task_id").alias("causation_id"), F.concat("task_id", F.lit(":seed")).alias("idempotency_key"), F.to_json(F.struct(F.lit(1).alias("attempt"), F.col("context_frame_id").alias("frame"), decoys.alias("decoys"))).alias("payload"))
    out = audit.with_seed_events(_demo_tasks(spark, sf_dir).select("task_id"), events)
    return out.select("task_id", "frame_id", F.array_join("strategy_ids", ",").alias("strategies"), F.array_join("decoys", ",").alias("decoys"))


def _rules_sql() -> str:
    from annolith.plans import rules

    by = lambda rows, c: _map_sql({k: v.replace("'", "''") for k, v in rows.items()}, c)
    types = "case sample_type " + " ".join("when '{}' then [{}]".format(k, ", ".join("'" + x.replace("'", "''") + "'" for x in v)) for k, v in rules.BY_TYPE.items()) + " end"
    return TASKS_SQL + f"select cast(seq as int) as sequence_no, array_to_string(list_concat(list_concat({types}, [{by(rules.BY_DIFFICULTY, 'difficulty')}, {by(rules.BY_STRUCTURE, 'document_structure')}, {by(rules.BY_REGISTER, 'language_register')}]), list_transform(drawn[:budget], lambda c: {by(rules.BY_CONSTRAINT, 'c')})), chr(10)) as rules from (select *, case lim when 2 then 'easy' when 4 then 'medium' else 'hard' end as difficulty from tasks)"


@query(_rules_sql())
def prompt_rules(spark, sf_dir):
    """The rules that a generating model gets for each task of the demo run."""
    from annolith.plans import rules

    return _demo_tasks(spark, sf_dir).select("sequence_no", F.array_join(rules.task_rules(), "\n").alias("rules"))


@query(TASKS_SQL + "select cast(seq as int) as sequence_no, task_id, array_to_string(labels, ',') as labels, frame, case lim when 2 then 'easy' when 4 then 'medium' else 'hard' end as difficulty from tasks")
def generation_request(spark, sf_dir):
    """What a generating model is told of each task, read back from the JSON of its messages."""
    from annolith.plans import rules

    made = rules.generation_messages(_demo_packs(spark, sf_dir)).select("sequence_no", F.element_at("messages", 2)["content"].alias("c"))
    part = lambda p: F.get_json_object("c", f"$.task.{p}")
    return made.select("sequence_no", part("task_id").alias("task_id"), F.array_join(F.from_json(part("focus_labels"), "array<string>"), ",").alias("labels"), part("context_frame_id").alias("frame"), part("difficulty").alias("difficulty"))


@query(RENDER_SQL + "select cast(seq as int) as sequence_no, tagged_text, cast(coalesce(len(seeds), 0) as int) as seeds, cast(coalesce(len(decoys), 0) as int) as decoys, 0 as issues from rendered")
def judge_envelope(spark, sf_dir):
    """What a judging model is told of each candidate, read back from the JSON of its messages."""
    from annolith.plans import rules

    made = rules.judge_messages(runs.candidates(spark, _demo_tasks(spark, sf_dir), runs.demo(), 0)).select("sequence_no", F.element_at("messages", 2)["content"].alias("c"))
    part = lambda p: F.get_json_object("c", f"$.{p}")
    size = lambda p: F.json_array_length(part(p))
    return made.select("sequence_no", part("tagged_text").alias("tagged_text"), size("positive_entities").alias("seeds"), size("decoys").alias("decoys"), size("issues").alias("issues"))


@query(RENDER_SQL + """
select cast(seq as int) as sequence_no, case when k <> 'n' and seq % 4 = 1 then 'a seed is not among the entities: ' || seeds[1].label when k <> 'n' and seq % 4 = 2 then 'a seed stands outside its tag: ' || seeds[1].label
  when k = 'h' and seq % 4 = 3 then 'a look-alike must occur 1 to 1 times: ' || decoys[1].value when k <> 'n' and seq % 4 = 0 then 'a seed must stand once with its tag: ' || seeds[1].label end as error from rendered
""")
def seeded_contract(spark, sf_dir):
    """The first rule of seeds and look-alikes that answers damaged in four ways break."""
    rows = samples.render(_demo_packs(spark, sf_dir), runs.DOCUMENTS)
    n, first, lure = F.col("sequence_no") % 4, F.get("positives", F.lit(0)), F.get("decoys", F.lit(0))
    harmed = (
        F.when((n == 2) & first.isNotNull(), F.concat("tagged_text", F.lit(" Nhắc "), first["value"], F.lit(".")))
        .when((n == 3) & lure.isNotNull(), F.concat("tagged_text", F.lit(" Nhắc "), lure["value"], F.lit(".")))
        .when((n == 0) & first.isNotNull(), F.regexp_replace("tagged_text", "</?[A-Z_]+>", ""))
        .otherwise(F.col("tagged_text"))
    )
    listed = F.when(n == 1, F.slice("entities", 2, 99)).otherwise(F.col("entities"))
    return rows.select("sequence_no", samples.seeded_contract_error(harmed, listed, F.col("positives"), F.col("decoys")).alias("error"))


_VERDICTS = [
    ('{"status": "PASS", "score": 97, "issues": []}', None), ('{"status": "PASS", "score": 101, "issues": []}', "the score is not 0 to 100"), ("[1]", "the answer is no object"), ('{"status": "PASS", "issues": []}', "the verdict's keys differ"),
    ('{"status": "PASS", "score": 1, "issues": [], "x": 1}', "the verdict's keys differ"), ('{"status": "MAYBE", "score": 1, "issues": []}', "unknown status"), ('{"status": "REGENERATE", "score": 1, "issues": []}', "no issues"),
    ('{"status": "FIXABLE", "score": 50, "issues": [{"type": "a", "severity": "low", "field": "f", "reason": "r"}]}', None), ('{"status": "FIXABLE", "score": 50, "issues": [{"type": "a", "severity": "high", "field": "f", "reason": "r"}]}', "FIXABLE needs low severity"),
    ('{"status": "REJECTED", "score": 0, "issues": [{"type": "a", "severity": "critical", "field": "f", "reason": "r"}]}', None), ('{"status": "REJECTED", "score": 0, "issues": [{"type": "a", "severity": "low", "field": "f"}]}', "an issue's keys differ"),
    ('{"status": "REJECTED", "score": 0, "issues": [{"type": "a", "severity": "grave", "field": "f", "reason": "r"}]}', "unknown severity"),
]


@query("select event_id, [" + ", ".join("null" if e is None else "'" + e.replace("'", "''") + "'" for _, e in _VERDICTS) + f"][event_id % {len(_VERDICTS)} + 1] as error from events")
def verdict_contract(spark, sf_dir):
    """What is wrong with a judge's answer: twelve answers, one to each event in turn."""
    from annolith.sources.clients import parse_verdict

    answer = F.element_at(F.array(*(F.lit(v) for v, _ in _VERDICTS)), (F.col("event_id") % len(_VERDICTS) + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", parse_verdict(answer)["error"].alias("error"))


@query("""
select event_id, case event_id % 4 when 0 then 'ok ' || event_id when 1 then 'ok ' || event_id end as raw, case event_id % 4 when 2 then 'HTTP 400: bad' when 3 then 'HTTP 503: down' end as call_error, cast(case event_id % 4 when 0 then 1 when 1 then 3 when 2 then 1 else 4 end as int) as calls from events
""")
def model_calls(spark, sf_dir):
    """Calls to a stand-in model by event: at once, at the third try, refused for good, and down all the time."""
    from annolith.sources.clients import answers

    def connect():
        tries: dict[str, int] = {}

        def send(body: str) -> tuple[int, str]:
            kind, tries[body] = int(body) % 4, tries.get(body, 0) + 1
            if kind == 0 or (kind == 1 and tries[body] == 3):
                return 200, f"ok {body}"
            if kind == 1:
                raise OSError("no route")
            return (400, "bad") if kind == 2 else (503, "down")

        return send

    rows = table(spark, sf_dir, "events").select("event_id")
    return answers(rows, F.col("event_id").cast("string"), connect, wait=lambda s: None).select("event_id", "raw", "call_error", "calls")


@query("""
select conv_id, turn, case turn % 3 when 0 then 'E' || turn || ': broken [REDACTED] here' when 1 then 'plain [REDACTED] text' else '' end as detail from conversations
""")
def error_details(spark, sf_dir):
    """Error messages out of the bodies of failed calls, without the secret."""
    from annolith.sources.clients import error_detail

    nested = F.concat(F.lit('{"error": {"code": "E'), F.col("turn"), F.lit('", "message": "broken   s3cr3t\\n here"}}'))
    body = F.when(F.col("turn") % 3 == 0, nested).when(F.col("turn") % 3 == 1, "plain s3cr3t   text").otherwise("")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", error_detail(body, ["s3cr3t"]).alias("detail"))


@query("""
select event_id, quality, case status when 'PASS' then case when quality then 'JUDGE' else 'ACCEPT' end when 'FIXABLE' then case when quality then 'REPAIR' else 'REGENERATE' end when 'REJECTED' then 'REJECT' else 'REGENERATE' end as step
from (select event_id, ['PASS', 'FIXABLE', 'REJECTED', 'REGENERATE'][event_id % 4 + 1] as status, event_id % 3 = 0 as quality from events)
""")
def gate_steps(spark, sf_dir):
    """What follows a candidate's route, with and without quality checks."""
    status = F.element_at(F.array(*(F.lit(x) for x in ("PASS", "FIXABLE", "REJECTED", "REGENERATE"))), (F.col("event_id") % 4 + 1).cast("int"))
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 3 == 0).alias("quality"), status.alias("status"))
    return rows.select("event_id", "quality", F.when(F.col("quality"), flow.gate(F.col("status"), True)).otherwise(flow.gate(F.col("status"), False)).alias("step"))


@query("""
select event_id, case when st = 'PASS' and sev <> '' then 'PASS with issues' when st <> 'PASS' and sev = '' then 'no issues' when st = 'FIXABLE' and sev <> 'low' then 'FIXABLE needs low severity' when st = 'REJECTED' and sev <> 'critical' then 'REJECTED needs a critical issue' end as error
from (select event_id, ['PASS', 'FIXABLE', 'REJECTED', 'REGENERATE'][event_id % 4 + 1] as st, ['', 'low', 'critical'][event_id // 4 % 3 + 1] as sev from events)
""")
def decision_consistency(spark, sf_dir):
    """Verdicts that contradict their issues."""
    status = F.element_at(F.array(*(F.lit(x) for x in ("PASS", "FIXABLE", "REJECTED", "REGENERATE"))), (F.col("event_id") % 4 + 1).cast("int"))
    found = F.element_at(F.array(F.array().cast("array<string>"), F.array(F.lit("low")), F.array(F.lit("critical"))), (F.floor(F.col("event_id") / 4) % 3 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", flow.decision_error(status, found).alias("error"))


@query(f"select {list(catalog.LABELS)}[o_orderkey % 44 + 1] as label, count(*) as tasks, 3::bigint * count(*) as offers, 3::bigint as strategies, true as varied from orders group by 1")
def strategy_registry(spark, sf_dir):
    """Look-alikes that orders, as tasks of one label each, can choose from: three a label, of two families at least."""
    label = F.element_at(F.array(*(F.lit(x) for x in catalog.LABELS)), (F.col("o_orderkey") % 44 + 1).cast("int"))
    offers = table(spark, sf_dir, "orders").select("o_orderkey", label.alias("label")).join(F.broadcast(strategies(spark)), "label")  # 132 strategies
    each = offers.groupBy("label", "strategy_id", "family").agg(F.count("*").alias("n"))
    return each.groupBy("label").agg(F.max("n").alias("tasks"), F.sum("n").alias("offers"), F.count_distinct("strategy_id").alias("strategies"), (F.count_distinct("family") >= 2).alias("varied"))


@query(f"""
with s(label, strategy_id, parts, regex) as (values {", ".join(f"('{label}', '{name}', {templates.sql_parts(parts)}, $re${regex}$re$)" for name, label, _, _, _, regex, *_, parts in registry())})
select strategy_id, c_custkey, value, regexp_matches(value, regex) as fits from (select *, {templates.sql_drawn("parts", "'9', strategy_id, c_custkey::varchar")} as value from s, (select c_custkey from customer))
""")
def strategy_values(spark, sf_dir):
    """Look-alikes of every strategy, each held against its strategy's pattern."""
    return look_alikes(shared.spread(table(spark, sf_dir, "customer").select("c_custkey"), len(registry())), 9)


@query(TASKS_SQL + f"select cast(seq as int) as sequence_no, {_DOMAIN} as domain, {_CONTENT[0]} as action, {_CONTENT[1]} as object, " + ", ".join(f"array_to_string({_terms_sql(x)}, ' / ') as {x}s" for x in samples.CONTENT) + " from tasks where k = 'n'")
def content_seeds(spark, sf_dir):
    """Roles, actions and objects of samples without any entity, those of their frame's domain among them, and what the text is about."""
    rows = _demo_packs(spark, sf_dir).where("sample_type = 'pure_negative'")
    lists = (F.array_join(f"content_seeds.{x}s", " / ").alias(f"{x}s") for x in samples.CONTENT)
    return rows.select("sequence_no", "content_seeds.domain", "content_seeds.action", "content_seeds.object", *lists)


@query("""
with t as (select c_custkey, count(distinct cast('0x' || substr(md5(concat_ws('|', '5', c_custkey::varchar, 'GENDER', n::varchar, '0')), 1, 15) as bigint) % 3) as n from customer, (select unnest(range(0, 10)) as n) group by c_custkey)
select c_custkey, cast(c_custkey % 4 + 1 as int) as n_labels, cast(least(c_custkey % 4 + 1, n) as int) as n_values from t
""")
def unique_seed_values(spark, sf_dir):
    """Values for one to four seeds of a label that has three: none is kept twice, and ten draws are made for each."""
    labels = F.array_repeat(F.lit("GENDER"), (F.col("c_custkey") % 4 + 1).cast("int"))
    rows = samples.with_templates(shared.spread(table(spark, sf_dir, "customer").select("c_custkey"), 10)).select("c_custkey", F.size(labels).alias("n_labels"), _distinct_genders(labels).alias("made"))
    return rows.select("c_custkey", "n_labels", F.size(F.array_distinct(F.transform("made", lambda m: m["value"]))).alias("n_values"))


def _distinct_genders(labels):
    return samples.positive_seeds(labels, 5, F.col("c_custkey").cast("string"))


@query(f"""
with t as (select doc_id, regexp_replace(text, '[<>]', ' ', 'g') as clean, regexp_extract(text, {EMAIL_SQL}) as v from documents where regexp_matches(text, {EMAIL_SQL})), p as (select *, instr(clean, v) as pos from t)
select doc_id, v as value, regexp_replace(substr(clean, greatest(pos - 40, 1), pos + length(v) + 40 - greatest(pos - 40, 1)), '^[ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+$', '', 'g') as context from p
""")
def window_contexts(spark, sf_dir):
    """Forty characters on either side of a document's first e-mail address."""
    rows = table(spark, sf_dir, "documents").where(F.col("text").rlike(detect.DETECTORS["EMAIL"])).withColumn("value", F.regexp_extract("text", detect.DETECTORS["EMAIL"], 0))
    return rows.select("doc_id", "value", tags.window_context(F.regexp_replace("text", "[<>]", " "), F.col("value"), 40).alias("context"))


@query("""
select event_id, case event_id % 5 when 1 then 'nested, unknown or malformed tag' when 2 then 'label is not allowed' when 3 then 'metadata differs from tags' when 4 then 'text is empty' end as error from events
""")
def format_errors(spark, sf_dir):
    """Why tagged texts can't become spans: five kinds, one to each event in turn."""
    texts = ["Giờ <TIME>09:00</TIME>.", "Giờ <TIME>09:00</DATE>.", "Ngày <DATE>1/1/2020</DATE>.", "Giờ <TIME>10:00</TIME>.", "  "]
    said = F.element_at(F.array(*(F.lit(t) for t in texts)), (F.col("event_id") % 5 + 1).cast("int"))
    listed = F.when(F.col("event_id") % 5 == 4, F.array().cast("array<struct<label:string,value:string>>")).when(F.col("event_id") % 5 == 2, F.array(F.struct(F.lit("DATE").alias("label"), F.lit("1/1/2020").alias("value")))).otherwise(F.array(F.struct(F.lit("TIME").alias("label"), F.lit("09:00").alias("value"))))
    return table(spark, sf_dir, "events").select("event_id", tags.format_error(said, listed, F.array(F.lit("TIME"))).alias("error"))


@query("""
select c_custkey, 'json-taxonomy' as run_name, cast(c_custkey + 1 as int) as num_samples, case when c_custkey % 3 = 0 then 'DATE,TIME' else 'EMAIL' end as labels, case when c_custkey % 2 = 0 then 1.0 else 0.0 end::double as hard_negative,
       case when c_custkey % 5 = 0 then 'm' || c_nationkey else 'azure/gpt-4o' end as generator_model, 'https://x' || c_nationkey || '.test' as base_url, 'k' || c_custkey as api_key, 2500 as max_tokens from customer
""")
def settings_and_flags(spark, sf_dir):
    """Configurations from flags and settings from KEY=VALUE text, one of both for each customer's run."""
    from annolith.sources.settings import run_requests

    k, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    flags = F.concat(F.array(F.lit("--focus-labels"), F.when(k % 3 == 0, "date, TIME, Date").otherwise("email"), F.lit("--samples"), (k + 1).cast("string")), F.when(k % 2 == 0, F.array(F.lit("--hard-negative"))).otherwise(F.array().cast("array<string>")))
    settings = F.concat(F.lit("# note\nLLM_API_KEY='k"), k.cast("string"), F.lit("'\nBASE_URL=https://x"), nation, F.lit(".test/\n"), F.when(k % 5 == 0, F.concat(F.lit("MODEL=m"), nation)).otherwise(""))
    rows = shared.spread(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), 10).select("c_custkey", flags.alias("flags"), settings.alias("settings"))
    return run_requests(rows, "c_custkey").select("c_custkey", "run_name", "num_samples", "labels", "hard_negative", "generator_model", "base_url", "api_key", "max_tokens")


_USED = "[" + ", ".join(["0::bigint"] * len(catalog.FRAMES)) + "]"


@query(TASKS_SQL.replace("with ", "with recursive ", 1) + f""",
     w as (select frames, count(*) as n, row_number() over (order by len(frames), mask) as k from (select *, list_sum(list_transform(frames, lambda f: {_FRAME_BIT})) as mask from p3) group by frames, mask),
     pour as (select 0::bigint as k, {_USED} as used
              union all select k, list_transform(used, lambda u, i: u + coalesce(list_sum(list_transform(list_filter(got, lambda g: g.i = i), lambda g: g.q)), 0)::bigint) from (
                select k, used, list_transform(low[1:m], lambda x, r: {{'i': x.i, 'q': water // m - x.t + case when r <= water % m then 1 else 0 end}}) as got from (
                  select *, (n + list_sum(list_transform(low[1:m], lambda x: x.t)))::bigint as water from (
                    select *, len(list_filter(range(1, len(low) + 1), lambda m: m * low[m].t - list_sum(list_transform(low[1:m], lambda x: x.t)) < n)) as m from (
                      select w.k, n, used, list_sort(list_transform(list_transform(frames, lambda f: {_FRAME_PLACE}), lambda i: {{'t': used[i], 'i': i}})) as low from pour join w on w.k = pour.k + 1))))),
     final as (select used from pour order by k desc limit 1)
select context_frame_id, n from (select unnest({list(catalog.FRAMES)}) as context_frame_id, unnest(used) as n from final) where n > 0
""")
def frames_least_used(spark, sf_dir):
    """Use of the frames by a run that levels it over all its tasks."""
    planned = plan_tasks(spark, runs.demo(frame_policy="least_used"), _numbers(spark, sf_dir, "customer", "c_custkey"))
    return audit.frequencies(planned, "context_frame_id")


@query("""
select event_id, user_id::varchar as run, row_number() over (partition by user_id order by ts, event_id) as place from events where user_id is not null
""")
def event_log(spark, sf_dir):
    """Events appended to a log in two batches, the second twice, read back in each run's order."""
    from annolith.sources.files import append_events, read_events

    rows = table(spark, sf_dir, "events").where("user_id is not null")
    null = F.lit(None).cast("string")
    told = rows.select(
        F.col("event_id").cast("string").alias("event_id"), "event_type", F.lit(1).alias("event_version"), F.col("ts").cast("timestamp").alias("occurred_at"), F.col("user_id").cast("string").alias("correlation_id"), null.alias("causation_id"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("idempotency_key"), F.to_json(F.struct("value")).alias("payload"), F.unix_micros(F.col("ts").cast("timestamp")).alias("position"))
    log = f"{shared.folder(spark)}/log-{uuid.uuid4().hex}"
    shared.written.append(log)
    parts = F.col("event_id").cast("long") % 2
    for name, part in (("even", 0), ("odd", 1), ("odd", 1)):
        append_events(told.where(parts == part), log, name)
    place = F.row_number().over(Window.partitionBy("correlation_id").orderBy("position", F.col("event_id").cast("long"))).cast("long")
    return read_events(spark, log).select(F.col("event_id").cast("long").alias("event_id"), F.col("correlation_id").alias("run"), place.alias("place"))


@query("""
with l as (select l_orderkey, count(distinct l_linenumber) as n, arg_max(l_returnflag, l_linenumber) as flag from lineitem group by l_orderkey)
select o_orderkey::varchar as task_id, case when n is null then 'CREATED' when flag = 'R' then 'REGENERATING' when o_orderstatus = 'F' then 'ACCEPTED' when o_orderstatus = 'P' then 'VERIFYING' else 'VALIDATING' end as status,
       coalesce(n, 0)::int as attempts, case when flag = 'R' then 'REGENERATE' when n is null then null when o_orderstatus = 'F' then 'PASS' when o_orderstatus = 'P' then 'VERIFYING' end as outcome
from orders left join l on l_orderkey = o_orderkey
""")
def task_life_cycle(spark, sf_dir):
    """Where each order, as a task with its lines as attempts, stands after its events: returned lines fail, finished orders are accepted."""
    from annolith.streaming.lifecycle import task_states

    # of lines of one number that of the table's first row counts, whatever tasks read them
    place = F.struct("_metadata.file_path", "_metadata.row_index")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("long").alias("n"), (F.col("l_returnflag") == "R").alias("bad"), place.alias("place"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    lines = lines.groupBy("k", "n").agg(F.min_by("bad", "place").alias("bad")).join(orders.select("k"), "k", "left_semi")
    event = lambda kind, at, **payload: F.struct(F.lit(kind).alias("event_type"), at.alias("position"), F.to_json(F.struct(*(v.alias(k) for k, v in payload.items())) if payload else F.struct(F.lit(1).alias("v"))).alias("payload"))
    at = F.col("n") * 10
    steps = F.array(event("seed.validated", at), event("data.generated", at + 1), event("data.deterministic.validated", at + 2, route=F.when(F.col("bad"), "REGENERATE").otherwise("PASS")))
    steps = F.when(F.col("bad"), F.array_append(steps, event("data.generation.rejected", at + 3, route=F.lit("none")))).otherwise(steps)
    tried = lines.select("k", F.explode(steps).alias("e"))
    last = lines.groupBy("k").agg(F.max_by("bad", "n").alias("bad")).where("not bad").join(orders, "k")
    ends = F.when(F.col("s") == "F", event("sample.accepted", F.lit(1000).cast("long"))).when(F.col("s") == "P", event("data.verification.judged", F.lit(1000).cast("long"), outcome=F.lit("VERIFYING")))
    begun = orders.select("k", event("generation.task.created", F.lit(0).cast("long")).alias("e"))
    told = begun.unionByName(tried).unionByName(last.select("k", ends.alias("e")).where("e is not null")).select(F.col("k").cast("string").alias("causation_id"), "e.*")
    return task_states(told).select("task_id", "status", "attempts", "outcome")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
