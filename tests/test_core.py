from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from annolith.functions import detect, rng, tags, text
from annolith.operators import audit, flow, samples
from annolith.plans import catalog, runs
from annolith.plans.planner import RunConfig, config_errors, least_used_frames, plan_tasks
from annolith.sources.files import parse_config, read_taxonomy, write_dataset


def one(spark, expr, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(expr.alias("x")).first()["x"]


def test_spans_count_code_points(spark):
    f = one(spark, tags.format_spans(F.col("t")), t="😊 Gọi <PERSON>Hà</PERSON> ngay.")
    assert f.text == "😊 Gọi Hà ngay." and [(e.label, e.start, e.end, e.text) for e in f.entities] == [("PERSON", 6, 8, "Hà")]
    t = "Chị <PERSON>Lò Thị Cẩy</PERSON>, dân tộc <ETHNICITY>Cống</ETHNICITY>, vay vốn tại <CARD_ISSUER>Agribank</CARD_ISSUER>."
    assert [(e.start, e.end) for e in one(spark, tags.format_spans(F.col("t")), t=t).entities] == [(4, 14), (24, 28), (42, 50)]


def test_residual_tags_and_skeleton(spark):
    assert one(spark, tags.has_residual_tag(F.col("t")), t="<A>x</A> <B>y")
    assert not one(spark, tags.has_residual_tag(F.col("t")), t="<A>x</A> y")
    got = one(spark, tags.skeleton(F.col("t"), F.array(F.lit("SLA-TIME-03"))), t="Lúc  <TIME>14:30</TIME>\nMã SLA-TIME-03")
    assert got == "lúc <time> mã <decoy>"


@pytest.mark.parametrize(("t", "v", "want"), [
    ("Một. Mã X-1 ở đây! Hết", "X-1", ["Mã X-1 ở đây!"]),
    ("aa aa", "a", ["aa aa"] * 4),
    ("giá 1.5 là 1.5.", "1.5", ["giá 1.5", "5 là 1.5."]),
    ("không có", "zz", []),
])
def test_occurrence_contexts(spark, t, v, want):
    got = one(spark, tags.occurrence_contexts(F.col("t"), F.col("v")), t=t, v=v)
    assert len(got) == len(want) and (v == "1.5" or got == want)


@pytest.mark.parametrize(("label", "value", "ok"), [
    ("EMAIL", "a.b@example.test", True), ("EMAIL", "a@b", False), ("DATE", "21/10/2026", True), ("DATE", "32/10/2026", False), ("DATE", "2026-02-30", False),
    ("TIME", "02:30 PM", True), ("TIME", "25:00", False), ("PHONE", "0912345678", True), ("PHONE", "12345", False), ("URL", "https://x.test/a", True), ("URL", "ftp://x", False),
    ("IP", "192.0.2.7", True), ("IP", "999.1.1.1", False), ("IP", "2001:db8::1", True), ("CARD_NUMBER", "4242", True), ("CARD_NUMBER", "42 42", False), ("PERSON", " ", False),
])
def test_formats(spark, label, value, ok):
    assert one(spark, detect.valid_format(F.col("l"), F.col("v")), l=label, v=value) is ok


def test_detectors_and_structured_labels(spark):
    found = one(spark, detect.first_matches(F.col("t")), t="Gửi demo@example.test, gọi 0912345678 ngày 21/10/2026 lúc 14:30 tới 10.0.0.1, EMP-12345")
    assert [m.label for m in found] == ["EMAIL", "PHONE", "DATE", "TIME", "IP", "ACCOUNT_ID"]
    assert one(spark, detect.structured_labels(F.col("v")), v="1234") == ["CVV", "PIN"]
    assert one(spark, detect.luhn_digit(F.col("v")), v="424242424242424") == "2"


def test_cost_and_names(spark):
    assert one(spark, text.token_cost(F.col("i"), F.col("o")), i=1_000_000, o=500_000) == Decimal("7.50000000")
    assert one(spark, text.token_cost(F.col("i"), F.col("o")), i=100, o=50) == Decimal("0.00075000")
    assert one(spark, text.file_stem(F.col("n")), n="../vi data 001") == "vi_data_001" and one(spark, text.file_stem(F.col("n")), n="..") == "pii-run"


def test_ratio_bounds_change_nothing():
    import difflib
    import random

    r = random.Random(1)
    for _ in range(300):
        a, b = ("".join(r.choice("abc ") for _ in range(r.randrange(0, 40))) for _ in range(2))
        full = difflib.SequenceMatcher(None, a, b).ratio()
        assert (text.ratio(a, b, 0.8) >= 0.8) == (full >= 0.8 or a == b)


def test_quota_axis_uses_every_value_before_any_repeats(spark):
    rows = spark.range(1, 13).select("id", rng.bag(["a", "b", "c", "d"], F.col("id"), 1, "axis").alias("v")).collect()
    got = [r.v for r in sorted(rows)]
    assert all(sorted(got[i : i + 4]) == list("abcd") for i in (0, 4, 8))


def test_planner(spark):
    c = RunConfig(num_samples=20, focus_label="TIME", robin_labels=["PERSON", "DATE", "EMAIL", "PHONE"], min_robins=1, max_robins=2, sample_type_distribution={"positive": 1.0, "pure_negative": 0.0, "hard_negative": 0.0}, random_seed=174)
    rows = plan_tasks(spark, c).collect()
    assert all(r.focus_labels[0] == "TIME" and 2 <= len(r.focus_labels) <= 3 for r in rows) and len({tuple(r.focus_labels) for r in rows}) > 1
    assert rows == plan_tasks(spark, c).collect()
    c = RunConfig(num_samples=12, focus_labels=["DATE"], structure="chat")
    assert {r.document_structure for r in plan_tasks(spark, c).collect()} == set(catalog.CHAT_STRUCTURES)
    c = RunConfig(num_samples=30, focus_labels=["DATE", "TIME", "EMAIL"], minimum_per_label=10)
    assert [r.focus_labels[0] for r in plan_tasks(spark, c).orderBy("sequence_no").collect()] == ["DATE"] * 10 + ["TIME"] * 10 + ["EMAIL"] * 10


@pytest.mark.parametrize("bad", [
    {"difficulty_distribution": {"easy": 0.5, "medium": 0.2, "hard": 0.2}}, {"focus_labels": ["PHONE_NUMBER"]}, {"minimum_per_label": 1000}, {"max_entities": {"easy": 0, "medium": 1, "hard": 1}},
    {"focus_label": "TIME", "focus_labels": []}, {"structure": "custom"}, {"min_decoys": 3},
])
def test_wrong_configurations(bad):
    assert config_errors(RunConfig(**{"focus_labels": ["DATE"], **bad}))


def test_config_migration():
    c = parse_config('{"target_samples": 5, "difficulty": "easy", "max_entities": 3, "max_attempts": 2, "optional_constraints": ["x"], "focus_labels": [" date ", "DATE"], "language": "vi-VN"}')
    assert (c.num_samples, c.max_entities["hard"], c.max_regenerate_attempts, c.focus_labels, c.language) == (5, 3, 1, ["DATE"], "vi")
    with pytest.raises(ValueError, match="unknown keys"):
        parse_config('{"sampels": 5}')


def test_least_used_frame_is_balanced(spark):
    rows = spark.range(1, 13).select(F.lit("r").alias("run_id"), F.col("id").alias("sequence_no"), F.array(F.lit("DATE")).alias("focus_labels"))
    counts = [r["count"] for r in least_used_frames(rows).groupBy("frame_id").count().collect()]
    assert max(counts) - min(counts) <= 1


def test_entity_values_are_valid_and_varied(spark):
    rows = samples.with_templates(spark.range(100).crossJoin(catalog.labels(spark))).select("label", samples.entity_value(F.col("label"), 5, F.col("id").cast("string"), F.col("label")).alias("m"))
    got = rows.groupBy("label").agg(F.min(detect.valid_format(F.col("label"), F.col("m.value"))).alias("ok"), F.count_distinct("m.value").alias("n"), F.count_distinct("m.variant").alias("variants")).collect()
    by = {r.label: r for r in got}
    assert len(by) == 44 and all(r.ok for r in got)
    assert all(by[x].variants >= 2 for x in ("PERSON", "PHONE", "EMAIL", "ADDRESS", "DATE", "TIME", "MONEY", "URL", "IP", "CARD_NUMBER", "PLATE", "PASSPORT"))
    assert all(by[x].n >= 90 for x in ("PHONE", "EMAIL", "URL", "CARD_NUMBER", "PLATE", "PASSPORT"))


def _candidate(spark, **k):
    base = {"sample_type": "positive", "focus_labels": ["DATE"], "max_entities": 2, "positives": [("DATE", "21/10/2026", "x")], "decoys": [], "tagged_text": "Hẹn vào <DATE>21/10/2026</DATE>.", "entities": [("DATE", "21/10/2026")]} | k
    schema = "sample_type string, focus_labels array<string>, max_entities int, positives array<struct<label:string,value:string,variant:string>>, decoys array<struct<strategy_id:string,label:string,value:string,required:array<string>,forbidden:array<string>>>, tagged_text string, entities array<struct<label:string,value:string>>"
    return spark.createDataFrame([tuple(base.values())], schema)


def _types(df, **k):
    return [i.type for i in samples.validate(df, **k).first().issues]


def test_output_validator(spark):
    assert _types(_candidate(spark)) == []
    assert "missing_positive_seed" in _types(_candidate(spark, tagged_text="Hẹn vào <DATE>20/10/2026</DATE>.", entities=[("DATE", "20/10/2026")]))
    assert "duplicate_positive_seed" in _types(_candidate(spark, tagged_text="Ngày 21/10/2026: <DATE>21/10/2026</DATE>."))
    assert _types(_candidate(spark, entities=[])) == ["invalid_output", "missing_entity_metadata"]
    for t in ("Hãy gửi qua demo@example.test.", "Gọi số 0912345678.", "Hẹn ngày 21/10/2026."):
        assert _types(_candidate(spark, sample_type="pure_negative", positives=[], entities=[], tagged_text=t)) == ["pure_negative_contains_pii"]
    decoy = ("s", "DATE", "32/13/2026", ["dữ liệu lỗi"], ["ngày hẹn"])
    lure = lambda t: _types(_candidate(spark, sample_type="hard_negative", positives=[], entities=[], decoys=[decoy], tagged_text=t), decoy_only=True)
    assert lure("Bộ kiểm thử ghi nhận dữ liệu lỗi 32/13/2026 trong trường đầu vào.") == []
    assert lure("Bộ kiểm thử ghi nhận mã 32/13/2026 trong trường đầu vào.") == ["decoy_context_unclear"]
    assert "decoy_tagged" in lure("dữ liệu lỗi <DATE>32/13/2026</DATE>.")
    assert "decoy_occurrence" in lure("dữ liệu lỗi 32/13/2026 32/13/2026 32/13/2026.")
    assert "decoy_used_as_pii" in lure("dữ liệu lỗi có ngày hẹn 32/13/2026.")


def test_routing(spark):
    r = lambda *t: tuple(one(spark, flow.route(F.array(*(F.lit(x) for x in t)).cast("array<string>"))))
    assert r() == ("PASS", None) and r("invalid_output", "missing_entity_metadata") == ("FIXABLE", "low")
    assert r("decoy_context_unclear") == ("REGENERATE", "high") and r("credential_risk") == ("REJECTED", "critical") and r("invalid_output") == ("REGENERATE", "high")


def test_replacement_tasks(spark):
    lost = spark.createDataFrame([("r", "a", 1, 1, 0, 5, "REJECTED"), ("r", "b", 2, 2, 1, 6, "REJECTED")], "run_id string, task_id string, sequence_no int, slot_no int, replacement_no int, task_seed long, status string")
    new, spent = flow.replacements(lost, 10, 1)
    n = new.first()
    assert (n.slot_no, n.sequence_no, n.replacement_no, n.parent_task_id) == (1, 11, 1, "a") and n.task_seed != 5 and spent.count() == 1


def test_audit_numbers(spark):
    rows = spark.createDataFrame([("TIME", "14:30"), ("TIME", "09:15"), ("TIME", "14:30 ")], "label string, value string")
    r = audit.unique_ratios(rows).first()
    assert (r.n_values, r.n_distinct) == (3, 2)
    d = audit.duplicate_counts(spark.createDataFrame([("a",), ("a",), ("b",)], "skeleton string")).first()
    assert (d.n, d.duplicates) == (3, 1)


@pytest.fixture(scope="module")
def demo_run(spark):
    return runs.run(spark, runs.demo(num_samples=60, minimum_per_label=2))


def test_run_formats_and_writes(spark, tmp_path, demo_run):
    ok, bad = demo_run
    assert ok.count() + bad.count() == 60 and bad.count() == 0
    assert ok.where(~tags.spans_hold(F.col("formatted.text"), F.col("formatted.entities"))).count() == 0
    out = ok.select("formatted.text", "formatted.entities")
    early = write_dataset(out.limit(5), str(tmp_path), "../my run", partial=True)
    assert early.endswith("my_run.partial") and spark.read.json(early).count() == 5
    path = write_dataset(out, str(tmp_path), "../my run")
    assert path.endswith("my_run.final") and spark.read.json(path).count() == 60 and not (tmp_path / "my_run.partial").exists()


def test_taxonomy(spark, tmp_path):
    import json

    ex = [{"id": str(i), "expected_tagged_text": "x", "rationale": "y"} for i in range(3)]
    groups = {"POSITIVE": ex, "PURE_NEGATIVE": ex, "HARD_NEGATIVE": ex}
    (tmp_path / "t.json").write_text("﻿" + json.dumps([{"LABEL": "DATE", "DEFINITION": "d", "RULE": ["r"], "EXAMPLES": groups}, {"LABEL": "time", "DEFINITION": "d", "RULE": [], "EXAMPLES": groups | {"POSITIVE": ex[:1]}}]))
    got = {r.code: r.errors for r in read_taxonomy(spark, str(tmp_path / "t.json")).collect()}
    assert got["DATE"] == [] and len(got["time"]) == 2


def test_event_stream(spark, tmp_path):
    from annolith.streaming.events import counts, once

    rows = spark.createDataFrame([("k1", "a", "2026-01-01 00:01:00"), ("k1", "a", "2026-01-01 00:02:00"), ("k2", "b", "2026-01-01 00:03:00")], "idempotency_key string, event_type string, t string").selectExpr("idempotency_key", "event_type", "cast(t as timestamp) as occurred_at")
    rows.write.parquet(str(tmp_path / "in"))
    stream = once(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.idempotency_key for r in spark.sql("select * from seen").collect()) == ["k1", "k2"]
    assert sorted(r.n for r in counts(rows).collect()) == [1, 2]


def test_replacements_fill_slots_with_new_tasks(spark):
    from annolith.shared import cut

    config = runs.demo(num_samples=20, minimum_per_label=1, max_regenerate_attempts=1, max_task_replacements=1)
    good = lambda n: (F.col("slot_no") > 4) | (F.col("slot_no") > 1) & (F.col("replacement_no") == 1) & F.lit(n == 2)

    def attempt(packs, n):
        rows = samples.render(packs, runs.DOCUMENTS)
        return rows.withColumn("tagged_text", F.when(good(n), F.col("tagged_text")).otherwise(F.concat("tagged_text", F.lit(" </X>"))))

    done = runs.run(spark, config, cut, attempt)
    ok, lost = done
    rows = {r.slot_no: r for r in ok.collect()}
    assert sorted(rows) == list(range(2, 21)) and [r.slot_no for r in lost.collect()] == [1] and done.status == "FAILED"
    assert all(rows[s].replacement_no == 1 and rows[s].attempt_no == 2 and rows[s].sequence_no > 20 and rows[s].parent_task_id and rows[s].reflection.mandatory_repairs for s in (2, 3, 4))
    first = {r.slot_no: r for r in plan_tasks(spark, config).collect()}
    assert all(rows[s].focus_labels == first[s].focus_labels and rows[s].task_id != first[s].task_id for s in (2, 3, 4))
    status = {(r.slot_no, r.replacement_no): r.status for r in done.tasks.collect()}
    assert len(status) == 20 + 4 and status[1, 1] == "REJECTED" and status[2, 0] == "REJECTED" and status[2, 1] == status[9, 0] == "ACCEPTED"


def test_regeneration_scopes(spark):
    tasks = plan_tasks(spark, runs.demo(num_samples=3, minimum_per_label=0)).withColumns({"seed_attempt": F.lit(1), "attempt_no": F.lit(1)})
    scopes = F.element_at(F.array(F.lit("TEXT"), F.lit("CONTEXT"), F.lit("SEEDS")), F.col("sequence_no"))
    rows = tasks.withColumns({"issues": F.array(F.struct(F.lit("x").alias("type"), scopes.alias("scope"), F.lit("why").alias("reason"))), "was": F.col("context_frame_id")})
    got = {r.sequence_no: r for r in runs.regenerate(rows, 1).collect()}
    assert [got[i].seed_attempt for i in (1, 2, 3)] == [1, 1, 2] and [got[i].context_frame_id != got[i].was for i in (1, 2, 3)] == [False, True, False]


def test_repair_preservation_and_verification(spark):
    from annolith.operators import verify
    from annolith.shared import cut

    broken = lambda **k: [i.type for i in _candidate(spark, **k["now"]).select(verify.preservation_issues(F.lit(k.get("was", "")), F.col("tagged_text"), F.col("entities"), F.col("positives"), F.col("decoys")).alias("x")).first().x]
    assert broken(now={}) == []
    assert broken(now={"tagged_text": "Hẹn."}) == ["REPAIR_CHANGED_POSITIVE_SEED"]
    decoy = ("s", "DATE", "32/13/2026", ["q"], ["f"])
    assert broken(now={"decoys": [decoy], "tagged_text": "<DATE>21/10/2026</DATE> 32/13/2026"}, was="32/13/2026") == []
    assert broken(now={"decoys": [decoy], "tagged_text": "<DATE>21/10/2026</DATE>"}, was="32/13/2026") == ["REPAIR_CHANGED_DECOY"]
    assert broken(now={"decoys": [decoy], "tagged_text": "<DATE>21/10/2026</DATE> <X>32/13/2026</X>"}, was="32/13/2026") == ["REPAIR_CHANGED_DECOY"]

    rows = spark.range(7).withColumnRenamed("id", "k").crossJoin(_candidate(spark))
    first, later = ["PASS", "REGENERATE", "REJECTED"] + ["FIXABLE"] * 4, ["PASS", "REJECTED", "FIXABLE", "PASS"]
    table = lambda xs: F.array(*(F.lit(x) for x in xs))
    none = F.array().cast(f"array<{verify.ISSUE}>")

    def judge(df):
        status = F.element_at(table(later), (F.col("k") - 2).cast("int")) if "origin" in df.columns else F.element_at(table(first), (F.col("k") + 1).cast("int"))
        return df.withColumn("verdict", F.struct(status.alias("status"), none.alias("issues")))

    def repair(df):
        spoilt = F.regexp_replace("tagged_text", "<DATE>.*</DATE>", "x")
        return df.withColumn("tagged_text", F.when(F.col("k") == 6, spoilt).otherwise(F.concat(F.col("tagged_text"), F.lit(" Sửa."))))

    got = {r.k: r for r in verify.verify(rows, judge, repair, samples.validate, cut).collect()}
    assert [got[k].outcome for k in range(7)] == ["PASS", "REGENERATE", "REJECTED", "FIXED", "REJECTED", "REGENERATE", "REGENERATE"]
    assert got[3].tagged_text.endswith("Sửa.") and not got[4].tagged_text.endswith("Sửa.") and got[6].stages == ["judge", "repair"] and got[6].verdict_issues
    assert {r.outcome for r in verify.verify(rows, judge, repair, samples.validate, cut, max_repairs=0).where("k > 2").collect()} == {"REGENERATE"}


def test_novelty_guard(spark):
    from annolith.operators.novelty import guard

    entity = "array<struct<label:string,value:string>>"
    rows = spark.createDataFrame(
        [("r", 1, "a b c d e f g h", [("DATE", "1/1/2020")], True), ("r", 2, "a b c d e f g h", [], True), ("r", 3, "other words entirely", [("DATE", "1/1/2020 ")], True),
         ("r", 4, "zzz", [("GENDER", "nam")], False), ("r", 5, "zzz", [("GENDER", "nam")], True), ("q", 1, "a b c d e f g h", None, True), ("r", 6, "a b c d e f g i", [], True)],
        f"run_id string, sequence_no int, skeleton string, entities {entity}, valid boolean")
    got = {(r.run_id, r.sequence_no): r for r in guard(rows, "enforce").collect()}
    types = lambda *k: [i.type for i in got[k].novelty_issues]
    assert types("r", 2) == ["duplicate_sentence_skeleton"] and types("r", 3) == ["duplicate_entity_value"] and types("r", 5) == [] and types("r", 6) == ["near_duplicate_sentence"]
    assert [got["r", i].accepted for i in range(1, 7)] == [True, False, False, False, True, False] and got["q", 1].accepted and len(got["r", 6].nearest) == 2
    assert [r.accepted for r in guard(rows, "audit").where("run_id = 'r'").orderBy("sequence_no").collect()] == [True, True, True, False, True, True]
    assert guard(rows.limit(0)).count() == 0


def test_guidance(spark):
    from annolith.plans import guidance

    e = lambda p: [(f"{p}{i}", "t", "r") for i in range(5)]
    from annolith.sources.files import EXAMPLE

    tax = spark.createDataFrame([("DATE", "d", ["one", "two"], (e("p"), e("n"), e("h"))), ("TIME", "t", [], (e("p"), [], []))], f"code string, definition string, rules array<string>, examples struct<POSITIVE:{EXAMPLE},PURE_NEGATIVE:{EXAMPLE},HARD_NEGATIVE:{EXAMPLE}>")
    tasks = spark.createDataFrame([("a", ["DATE", "TIME"], "hard_negative"), ("b", ["TIME", "NONE"], "positive")], "task_id string, focus_labels array<string>, sample_type string")
    got = {r.task_id: r for r in guidance.taxonomy_context(tasks, tax, 3).collect()}
    ids = [x.id for x in got["a"].context.focus.examples]
    assert got["a"].context.focus.rule == "one\ntwo" and len(ids) == 3 and ids == sorted(ids) and ids[0].startswith("h") and got["a"].missing == []
    assert [(o.label, o.examples) for o in got["a"].context.others] == [("TIME", [])] and got["b"].missing == ["NONE"]
    m = one(spark, guidance.messages("s", x=F.lit(None).cast("string"), r=guidance.reflection(F.array(F.struct(F.lit("t").alias("type"), F.lit("why").alias("reason"))))))
    assert m[0].content == "s" and m[1].content == '{"x":null,"r":{"mandatory_repairs":["why"],"must_not_repeat":[{"type":"t","reason":"why"}]}}'


def test_exchange(spark, tmp_path, demo_run):
    import json

    from annolith.sources import exchange

    task = {"task_id": "t", "focus_labels": ["DATE"], "difficulty": "easy", "sample_type": "positive", "max_entities": 2}
    pack = {"seed_pack_id": "s", "task_id": "t", "sample_type": "positive", "context_frame": {"frame_id": "f"}}
    lines = [{"task": task, "seed_pack": pack, "attempt_no": 1}, {"task": task | {"difficulty": "odd"}, "seed_pack": pack, "attempt_no": 4}, {"task": {"task_id": "t"}, "attempt_no": 1}]
    (tmp_path / "r.json").write_text("\n".join(map(json.dumps, lines)) + "\nnot json\n")
    got = exchange.read_requests(spark, str(tmp_path / "r.json")).collect()
    assert got[0].errors == [] and got[0].idempotency_key == "t:attempt:1:data-generation"
    assert got[1].errors == ["unknown difficulty", "attempt_no is not between 1 and max_attempts"] and len(got[2].errors) == 2 and got[3].errors

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, lines)))
    q = exchange.stream_requests(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("asked").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(len(r.errors) for r in spark.sql("select errors from asked").collect()) == [0, 2, 2]

    def answer(content, **usage):
        return one(spark, exchange.parse_answer(F.col("a")), a=json.dumps({"choices": [{"message": {"content": json.dumps(content)}}], "usage": usage}))

    r = answer({"tagged_text": ["a ", {"text": "<X>b</X>"}], "entities": [{"label": "X", "value": "b"}, {}]}, prompt_tokens=3, completion_tokens=4)
    assert (r.tagged_text, [tuple(e) for e in r.entities], r.total_tokens, r.error) == ("a <X>b</X>", [("X", "b"), ("", "")], 7, None)
    assert answer({"tagged_text": " ", "entities": []}).error == "no tagged_text" and answer({"tagged_text": "x", "entities": 1}).error == "entities is no list"
    assert one(spark, exchange.parse_answer(F.col("a")), a="{}").error and answer({"tagged_text": "[x] y", "entities": []}).tagged_text == "[x] y"
    assert [one(spark, exchange.api_style(F.col("u")), u=u) for u in ("https://x.OpenAI.azure.com/v1", "https://api.x.test", "junk")] == ["azure", "openai", "openai"]
    ok, lost = demo_run
    assert tuple(exchange.run_summary(ok, lost, 60).first()) == ("COMPLETED", 60, 0, 4800, 2400) and exchange.result_events(ok).count() == 60
    flat = flow.accepted_samples(spark.createDataFrame([("a", 2, 0, "ACCEPTED"), ("b", 1, 1, "ACCEPTED"), ("c", 1, 0, "REJECTED")], "task_id string, slot_no int, replacement_no int, status string").withColumn("sequence_no", F.lit(9)), spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "task_id string, x int"))
    assert [r.x for r in flat.collect()] == [2, 1]


def test_near_duplicates_equal_brute_force(spark):
    import difflib
    import random

    r = random.Random(3)
    texts = ["".join(r.choice("ab ") for _ in range(r.randrange(3, 12))) for _ in range(40)]
    rows = spark.createDataFrame([("r", i, t) for i, t in enumerate(texts)], "run string, n int, t string")
    got = {x.n: x.near_duplicate for x in audit.near_duplicates(rows, "run", "n", "t", 0.8, 5).collect()}
    close = lambda i: any(p != texts[i] and difflib.SequenceMatcher(None, p, texts[i]).ratio() >= 0.8 for p in texts[max(0, i - 5) : i])
    want = {i: close(i) for i in range(40)}
    assert got == want and any(want.values()) and not all(want.values())


def test_imitation(spark):
    rows = spark.createDataFrame([(1, "Hẹn <DATE>1/2/2020</DATE> ở quán", ["khác hẳn hoàn toàn", "Hẹn <DATE>3/4/2021</DATE> ở quán"]), (2, "xyz", ["Hẹn gặp ở quán"]), (3, "a b c", ["a b c", "a b c"])], "k int, t string, e array<string>")
    got = {x.k: x for x in audit.imitation(rows, "t", "e").collect()}
    assert got[1].imitates and got[1].closest == 1 and got[1].sequence == 1.0 and not got[2].imitates and got[3].closest == 0


def test_imitation_keeps_every_row(spark):
    rows = spark.createDataFrame([(1, "a", []), (1, "a", []), (2, "b", None), (3, None, ["x"])], "k int, t string, e array<string>")
    got = audit.imitation(rows, "t", "e").collect()
    assert sorted(x.k for x in got) == [1, 1, 2, 3] and not any(x.imitates for x in got) and all((x.closest is None) == (x.k < 3) for x in got)


def test_near_duplicates_over_block_borders(spark, monkeypatch):
    """Blocks of ten rows and a window of four give what one block gives; other columns and repeated rows stay."""
    import random

    r = random.Random(5)
    rows = [("r", i // 2, "".join(r.choice("abc ") for _ in range(r.randrange(3, 9))), i) for i in range(70)] + [("r", 3, "abc abc", 99), ("r", 3, "abc abc", 98), ("q", 1, None, 97)]
    frame = spark.createDataFrame(rows, "run string, n int, t string, extra int")
    want = {x.extra: x.best_ratio for x in audit.near_duplicates(frame, "run", "n", "t", 0.7, 4).collect()}
    monkeypatch.setattr(audit, "BLOCK", 10)
    got = {x.extra: x.best_ratio for x in audit.near_duplicates(frame, "run", "n", "t", 0.7, 4).collect()}
    assert len(want) == len(rows) and {k: v for k, v in got.items() if k < 90} == {k: v for k, v in want.items() if k < 90} and any(want.values())


def test_strategies_are_varied_and_sound(spark):
    from annolith.plans import strategies

    found = strategies.registry()
    by = {x: [r for r in found if r[1] == x] for x in catalog.LABELS}
    assert len(found) == 132 and len({r[0] for r in found}) == 132 and all(len(v) == 3 and len({r[2] for r in v}) >= 2 for v in by.values())
    rows = spark.createDataFrame([(r[0], r[1], r[5], r[10], k) for r in found for k in range(30)], strategies.SCHEMA.split(",")[0] + f", label string, value_regex string, parts array<{strategies.templates.PART}>, k int")
    made = rows.select("label", "value_regex", strategies.templates.drawn(F.col("parts"), "t", F.col("strategy_id"), F.col("k").cast("string")).alias("v"))
    assert made.where(~F.regexp("v", F.col("value_regex"))).count() == 0
    assert made.where(F.size(F.array_except(detect.structured_labels(F.col("v")), F.array("label"))) > 0).count() == 0
    assert made.where(F.col("v").rlike(r"(?i)^[a-z_]+-\d+(?:-beta)?$")).count() == 0


PACK = "sample_type string, focus_labels array<string>, positives array<struct<label:string,value:string,variant:string>>, decoys array<struct<strategy_id:string,label:string,value:string,required:array<string>,forbidden:array<string>,negative_labels:array<string>,collision_labels:array<string>>>, content_seeds struct<role:string,action:string,object:string>, n int"


def test_seed_pack_check(spark):
    from annolith.plans.strategies import strategies

    lure = lambda **k: [tuple(({"strategy_id": "date_as_lot_mark", "label": "DATE", "value": "lô sản xuất A12/345", "required": ["c"], "forbidden": [], "negative_labels": ["DATE"], "collision_labels": []} | k).values())]
    base = {"sample_type": "hard_negative", "focus_labels": ["DATE"], "positives": [("DATE", "21/10/2026", "x")], "decoys": lure(), "content_seeds": None}
    pure = {"sample_type": "pure_negative", "positives": [], "decoys": []}
    none = ["unsupported_decoy"]
    cases = {  # (look-alikes only, least, most) -> what differs from a fit pack, and its issues
        (False, 1, 1): [
            ({}, []), ({"positives": [("DATE", "32/10/2026", "x")]}, ["malformed_seed"]), ({"positives": []}, ["missing_positive_seed"]), ({"positives": [("DATE", "21/10/2026", "x"), ("TIME", "09:00", "x")]}, ["invalid_seed"]),
            ({"positives": [("DATE", "lô sản xuất A12/345", "x")]}, ["malformed_seed", "invalid_seed"]), ({"decoys": []}, none), ({"decoys": lure() * 2}, none), ({"decoys": lure(strategy_id="none")}, none), ({"decoys": lure(value="lô sản xuất Z1")}, ["malformed_seed"]),
            ({"decoys": lure(required=[])}, none), ({"decoys": lure(negative_labels=["TIME"])}, ["invalid_seed"]), ({"decoys": lure(negative_labels=["DATE", "NOPE"])}, ["invalid_seed"]), ({"decoys": lure(value="1234")}, ["malformed_seed", "taxonomy_collision"]),
            ({"decoys": lure(value="1234", negative_labels=["DATE", "CVV", "PIN"], collision_labels=["PIN"])}, ["malformed_seed", "taxonomy_collision"]), ({"decoys": lure(value="date-12")}, ["malformed_seed", "unsupported_decoy"]),
            ({"focus_labels": ["TIME"], "positives": [("TIME", "09:00", "x")]}, none), ({"sample_type": "positive"}, ["invalid_seed"]), (pure | {"content_seeds": ("ai", "ghi", "sổ")}, []), (pure, ["invalid_seed"]),
            (pure | {"content_seeds": ("ai", "gọi", "0912345678")}, ["malformed_seed"]), (pure | {"decoys": lure(), "content_seeds": ("ai", "ghi", "sổ")}, ["invalid_seed"]),
        ],
        (False, 0, 1): [({"decoys": []}, [])],
        (True, 1, 1): [({}, ["invalid_seed"]), ({"positives": []}, []), ({"positives": [], "focus_labels": ["DATE", "TIME"]}, none)],
    }
    table = strategies(spark)
    for options, packs in cases.items():
        rows = spark.createDataFrame([(*(base | k).values(), n) for n, (k, _) in enumerate(packs)], PACK)
        got = {r.n: [i.type for i in r.pack_issues] for r in samples.seed_pack_issues(rows, table, *options).collect()}
        assert got == {n: want for n, (_, want) in enumerate(packs)}


def test_seed_packs_hold_as_many_look_alikes_as_asked(spark):
    from annolith.plans.strategies import strategies

    kinds = {"positive": 0.0, "pure_negative": 0.5, "hard_negative": 0.5}
    for mode, low, high in (("mixed_contrastive", 1, 3), ("decoy_only", 2, 2)):
        config = runs.demo(num_samples=60, minimum_per_label=0, sample_type_distribution=kinds, hard_negative_mode=mode, min_decoys=low, max_decoys=high)
        packs = samples.seed_packs(plan_tasks(spark, config), strategies(spark), 1, 0, mode == "decoy_only", low, high)
        rows = samples.seed_pack_issues(packs, strategies(spark), mode == "decoy_only", low, high).collect()
        assert not any(r.pack_issues for r in rows)
        hard = [r for r in rows if r.sample_type == "hard_negative"]
        assert {len(r.decoys) for r in hard} == set(range(low, high + 1)) and all(len({d.strategy_id for d in r.decoys}) == len(r.decoys) for r in hard)
        assert all(bool(r.positives) == (mode == "mixed_contrastive") for r in hard)
        assert len({(r.content_seeds.action, r.content_seeds.object) for r in rows if r.sample_type == "pure_negative"}) >= 10


def test_seed_rounds_draw_unfit_packs_anew(spark, monkeypatch):
    from annolith.shared import cut

    tasks = plan_tasks(spark, runs.demo(num_samples=10, minimum_per_label=1)).withColumns({"seed_attempt": F.lit(1)})
    real = samples.seed_pack_issues

    def picky(packs, *rest):  # packs whose first value has an odd digit last are refused
        bad = F.get("positives", F.lit(0))["value"].rlike("[13579]$")
        rows = real(packs, *rest)
        issue = F.array(F.struct(F.lit("malformed_seed"), F.lit("SEEDS"), F.lit("odd"), F.lit(None).cast("string"), F.lit(None).cast("string")).cast(samples.ISSUE))
        return rows.withColumn("pack_issues", F.when(F.coalesce(bad, F.lit(False)), issue).otherwise(F.col("pack_issues")))

    monkeypatch.setattr(samples, "seed_pack_issues", picky)
    fit, refused, unfit = runs.seed_rounds(tasks, runs.demo(max_seed_pack_attempts=3), cut)
    assert fit.count() + unfit.count() == 10 and refused.count() > 0 and {r.seed_try for r in fit.collect()} != {1}
    assert all(not (r.positives and r.positives[0].value[-1] in "13579") for r in fit.collect())


def test_novelty_inside_a_run(spark):
    """A generator that repeats itself: with enforce one sample is accepted, with audit all are, and each says what it resembles."""
    config = runs.demo(num_samples=4, minimum_per_label=0, sample_type_distribution={"positive": 0.0, "pure_negative": 1.0, "hard_negative": 0.0}, quality_checks=True, max_regenerate_attempts=0, max_task_replacements=0)
    same = lambda packs, n: samples.render(packs, runs.DOCUMENTS).withColumn("tagged_text", F.lit("Cùng một câu."))
    strict = runs.run(spark, runs.dataclasses.replace(config, novelty_mode="enforce"), attempt=same)
    assert strict.accepted.count() == 1 and strict.status == "FAILED" and {i.type for r in strict.lost.collect() for i in r.issues} == {"duplicate_sentence_skeleton"}
    loose = runs.run(spark, config, attempt=same)
    assert loose.accepted.count() == 4 and loose.status == "COMPLETED" and sorted(r.novelty.max_similarity for r in loose.accepted.collect()) == [0.0, 1.0, 1.0, 1.0]


def test_limit_counts_accepted_samples_and_judging_resumes(spark):
    from annolith.operators.verify import ISSUE
    from annolith.sources.clients import offline_judge, offline_repair

    config = runs.demo(num_samples=12, minimum_per_label=0, quality_checks=True, batch_size=5, max_regenerate_attempts=0, max_task_replacements=0)
    down = lambda df: df.withColumn("verdict", F.struct(F.when(F.col("sequence_no") == 2, "ERROR").otherwise("PASS").alias("status"), F.array().cast(f"array<{ISSUE}>").alias("issues")))
    done = runs.run(spark, config, judge=down, limit=4)
    assert done.status == "RUNNING" and done.accepted.count() == 4 and [r.sequence_no for r in done.waiting.collect()] == [2]
    again = runs.resume(done, offline_judge, offline_repair).collect()
    assert [(r.sequence_no, r.outcome, r.attempt_no) for r in again] == [(2, "PASS", 1)]
    cost = flow.usage_by_slot(flow.ledger(done.attempts), ["run_id", "slot_no"]).collect()
    assert {r.total_tokens for r in cost} == {120} and {r.money_cost for r in cost} == {Decimal("0.00060000")}


def test_frame_selection(spark):
    from annolith.plans.planner import select_frame

    pick = lambda preferred, *labels: one(spark, select_frame(F.lit(preferred), F.array(*(F.lit(x) for x in labels)), 1, F.lit("k")))
    assert pick("travel_booking", "PASSPORT") == "travel_booking" and pick("delivery_request", "PASSPORT") in {k for k, v in catalog.FRAMES.items() if "PASSPORT" in v[4]} and pick("travel_booking", "NOPE") is None
    rows = plan_tasks(spark, runs.demo(num_samples=300, minimum_per_label=0, focus_labels=["DATE", "TIME"], frame_policy="least_used")).collect()
    counts = {k: sum(r.context_frame_id == k for r in rows) for k in catalog.FRAMES}
    assert max(counts.values()) - min(counts.values()) <= 1
    by: dict = {}
    for r in plan_tasks(spark, runs.demo(num_samples=300, minimum_per_label=0, focus_labels=["DATE", "TIME", "PASSPORT"], frame_policy="balanced")).collect():
        by.setdefault(tuple(sorted(r.focus_labels)), []).append(r.context_frame_id)
    assert all(max(v.count(f) for f in v) - min(v.count(f) for f in set(v)) <= 1 for v in by.values())


def test_events_append_and_read(spark, tmp_path, demo_run):
    from annolith.sources.events import TYPES, run_events
    from annolith.sources.files import append_events, read_events

    found = run_events(demo_run, "2026-01-01 00:00:00")
    append_events(found, str(tmp_path / "e"), "one")
    append_events(found.limit(0), str(tmp_path / "e"), "two")
    append_events(found, str(tmp_path / "e"), "one")  # a retry
    append_events(found.where("event_type = 'data.generated'"), str(tmp_path / "e"), "again/elsewhere")
    rows = read_events(spark, str(tmp_path / "e"), "demo").collect()
    assert len(rows) == len({r.event_id for r in rows}) == 2 + 6 * 60 and {r.event_type for r in rows} <= set(TYPES) and "run.completed" in {r.event_type for r in rows}
    assert read_events(spark, str(tmp_path / "e"), "other").count() == 0


def test_settings():
    from annolith.sources.settings import read_settings

    s = read_settings("API_VERSION='v'\nMODEL=m", {"OPENAI_API_KEY": "k", "BASE_URL": "https://h/", "MODEL": "own", "VERIFIER_MODEL": "judge"})
    assert (s.model, s.generator_model, s.verifier_model, s.api_version, s.base_url, s.retries) == ("own", "own", "judge", "v", "https://h", 3)
    for bad in ({}, {"OPENAI_API_KEY": "k"}, {"OPENAI_API_KEY": "k", "BASE_URL": "ftp://h"}, {"OPENAI_API_KEY": "k", "BASE_URL": "http://h", "OPENAI_API_STYLE": "odd"}):
        with pytest.raises(ValueError):
            read_settings("", bad)


def test_waits_between_calls():
    from annolith.sources.clients import call

    waits: list = []
    assert call(lambda b: (503, "x"), "b", 5, waits.append) == (None, "HTTP 503: x", 6) and waits == [1, 2, 4, 8, 8]
