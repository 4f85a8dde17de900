import difflib
import random

import pytest
from pyspark.sql import functions as F

from annolith.functions import detect, similar, unique
from annolith.operators import audit, novelty, samples
from annolith.plans import catalog, runs
from annolith.plans.planner import level_quotas, least_used_frames, plan_tasks
from annolith.plans.strategies import strategies

SAMPLES = "run_id string, sequence_no int, skeleton string, entities array<struct<label:string,value:string>>, valid boolean, accepted boolean"


# ---- values that a run never repeats


def test_small_labels_give_each_value_once_before_any_repeats(spark):
    small = {k: n for k, n in unique.capacities().items() if n <= 4000}
    assert {"GENDER", "TIME", "AGE", "PREFIX", "LOCATION"} - set(small) == {"TIME"} and small["GENDER"] == 3 and small["AGE"] == 61
    rows = spark.createDataFrame([(k, i) for k, n in small.items() for i in range(2 * n)], "label string, counter long")
    got = unique.with_values(rows, [F.lit("7")]).groupBy("label", "cycle").agg(F.count_distinct(F.lower("value")).alias("n"), F.min(detect.valid_format(F.col("label"), F.col("value"))).alias("ok")).collect()
    assert {(r.label, r.cycle): r.n for r in got} == {(k, c): n for k, n in small.items() for c in (0, 1)} and all(r.ok for r in got)


def test_large_labels_never_repeat_and_take_variants_in_turn(spark):
    labels = [k for k, n in unique.capacities().items() if n > 4000]
    rows = spark.range(3000).select(F.col("id").alias("counter"), F.explode(F.array(*(F.lit(x) for x in labels))).alias("label"))
    made = unique.with_values(rows, [F.lit("7")])
    got = {r.label: r for r in made.groupBy("label").agg(F.count_distinct(F.lower("value")).alias("n"), F.min(detect.valid_format(F.col("label"), F.col("value"))).alias("ok"), F.max("cycle").alias("cycle")).collect()}
    assert len(got) == len(labels) and all(r.n == 3000 and r.ok and r.cycle == 0 for r in got.values())
    shares = {(r.label, r.variant): r["count"] for r in made.groupBy("label", "variant").count().collect()}
    assert all(shares["EMAIL", v] == 1000 for v in ("dot_local", "hyphen_local", "plus_alias"))
    cards = made.where("label = 'CARD_NUMBER'").select(F.expr("luhn_check(value)").alias("ok")).distinct().collect()
    assert [r.ok for r in cards] == [True]
    other = unique.with_values(rows, [F.lit("8")]).join(made.withColumnRenamed("value", "was"), ["label", "counter"]).where("label = 'PHONE'").where("value = was").count()
    assert other < 30  # another key, another order


def test_numbering_is_exact():
    for label, variants in {v[0]: [w for w in unique.tables()[1] if w[0] == v[0]] for v in unique.tables()[1]}.items():
        assert sum(v[3] * v[4] for v in variants) == unique.capacities()[label]


def test_tasks_and_their_retries_share_no_value(spark):
    config = runs.demo(num_samples=300, minimum_per_label=0, focus_labels=["PHONE", "EMAIL", "PERSON"], sample_type_distribution={"positive": 1.0, "pure_negative": 0.0, "hard_negative": 0.0})
    tasks = plan_tasks(spark, config)
    rows = None
    for draw in range(3):
        packs = samples.seed_packs(tasks.withColumns({"options": F.lit("own"), "templates": F.lit(1), "_attempt": F.lit(2)}), strategies(spark), 5, draw, draw=draw, stride=300)
        assert packs.select("options", "templates", "_attempt").distinct().collect() == [("own", 1, 2)]
        rows = packs if rows is None else rows.unionByName(packs)
    values = rows.select(F.explode("positives").alias("p")).select("p.label", "p.value")
    ratios = {r.label: (r.n_values, r.n_distinct) for r in audit.unique_ratios(values).collect()}
    assert set(ratios) == {"PHONE", "EMAIL", "PERSON"} and all(n == d for n, d in ratios.values())
    assert rows.where(F.size("positives") != F.size("focus_labels")).count() == 0


# ---- similarity and novelty


@pytest.mark.parametrize("kept_first", [False, True])
def test_recent_finds_what_difflib_finds(kept_first):
    r = random.Random(4)
    text = lambda: "".join(r.choice("aab ñ😊") for _ in range(r.choice([0, 3, 30, 260])))
    recent, texts = similar.Recent(20, kept_first), []
    for i in range(150):
        now = r.choice(texts)[:-1] + r.choice("ab") if texts and r.random() < 0.5 else text()
        last = texts[-20:]
        ratio = lambda s: 1.0 if s == now else difflib.SequenceMatcher(None, *((s, now) if kept_first else (now, s))).ratio()  # noqa: B023, E731
        assert recent.nearest(now, 3) == sorted(((ratio(s), s) for s in last), reverse=True)[:3]
        some = sorted(((ratio(s), s) for s in last if ratio(s) >= 0.8 and s != now), reverse=True)[:1]
        assert recent.nearest(now, 1, 0.8, differ=True) == some
        assert [t for t, _ in recent.in_order()] == last
        recent.add(now, i)
        texts.append(now)


def _samples(seed, n=260, runs_=3):
    r = random.Random(seed)
    words = "mau thu viec nha cua song nui".split()
    line = lambda: " ".join(r.choice(words) for _ in range(r.randrange(1, 9)))
    told = [line() for _ in range(30)]
    return [(f"r{r.randrange(runs_)}", i, r.choice([r.choice(told), line(), None]), [("PHONE", str(r.randrange(60))), ("GENDER", "nam")][: r.randrange(3)], r.random() < 0.8, None) for i in range(n)]


def _judged(rows, mode, window, limit=0.9, feedback=2):
    """guard by its definition."""
    out, kept = {}, {}
    for run, no, skeleton, entities, valid, _ in sorted(rows, key=lambda x: x[1]):
        recent = kept.setdefault(run, [])[-window:]
        text = skeleton or ""
        near = sorted(((1.0 if s == text else difflib.SequenceMatcher(None, text, s).ratio(), s) for s, _ in recent), reverse=True) if mode != "off" else []
        pairs = [(a, b) for a, b in entities if a not in catalog.CATEGORICAL]
        issues = ["duplicate_entity_value" for p in pairs if any(p in v for _, v in recent)] if mode != "off" else []
        if near and near[0][0] >= limit:
            issues.append("duplicate_sentence_skeleton" if near[0][0] == 1.0 else "near_duplicate_sentence")
        good = valid and not (mode == "enforce" and issues)
        if good:
            kept[run].append((text, pairs))
        out[run, no] = (near[0][0] if near else 0.0, [s for _, s in near[:feedback]], issues, good)
    return out


@pytest.mark.parametrize("mode", ["off", "audit", "enforce"])
def test_guard_equals_its_definition(spark, mode, monkeypatch):
    monkeypatch.setattr(novelty, "BLOCK", 16)  # runs are cut into blocks
    rows = _samples(3)
    got = novelty.guard(spark.createDataFrame(rows, SAMPLES), mode, window=12, feedback=2).collect()
    assert {(r.run_id, r.sequence_no): (r.max_similarity, r.nearest, [i.type for i in r.novelty_issues], r.accepted) for r in got} == _judged(rows, mode, 12)


def test_guard_goes_on_from_the_last_accepted_rows(spark):
    rows = _samples(9, 120, 1)
    frame = spark.createDataFrame(rows, SAMPLES)
    first = novelty.guard(frame.where("sequence_no < 80"), window=7, feedback=2)
    kept = novelty.last_accepted(frame.where("sequence_no < 80 and valid"), 7)
    assert kept.count() == 7
    later = novelty.guard(frame.where("sequence_no >= 80").withColumn("prior", F.lit(False)).unionByName(kept.withColumn("prior", F.lit(True))), window=7, feedback=2)
    got = {(r.run_id, r.sequence_no): (r.max_similarity, r.nearest, [i.type for i in r.novelty_issues], r.accepted) for r in first.unionByName(later).collect()}
    assert got == _judged(rows, "audit", 7)


def test_novelty_as_state_of_a_stream(spark, tmp_path):
    rows = _samples(5, 200)
    frame = spark.createDataFrame(rows, SAMPLES)
    whole = {tuple(map(str, r)) for r in novelty.guard(frame, "enforce", window=9).collect()}
    was = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        seen = []
        for n, part in enumerate((frame.where("sequence_no < 90"), frame.where("sequence_no >= 90"))):
            part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = novelty.guard_stream(spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in")), window=9)
            query = stream.writeStream.foreachBatch(lambda df, i: seen.extend(df.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
            query.awaitTermination(120)
            assert query.exception() is None and len(seen) == (90, 200)[n]  # the second start goes on with the first one's state
        assert {tuple(map(str, r)) for r in seen} == whole
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", was)


# ---- frames


def test_quotas_are_level():
    assert level_quotas({0b11: 5}) == {0b11: [(0, 3), (1, 2)]}
    got = level_quotas({0b001: 10, 0b011: 4, 0b111: 7})
    assert got == {0b001: [(0, 10)], 0b011: [(1, 4)], 0b111: [(1, 1), (2, 6)]}
    r = random.Random(2)
    for _ in range(50):
        counts = {r.randrange(1, 2048): r.randrange(1, 500) for _ in range(r.randrange(1, 9))}
        got = level_quotas(counts)
        assert all(sum(q for _, q in got[m]) == n and all(m >> i & 1 for i, _ in got[m]) for m, n in counts.items())


def test_frames_of_several_runs(spark):
    sets = [["DATE"], ["DATE", "TIME"], ["PASSPORT", "DATE"], ["IBAN"], ["NOPE"], list(catalog.LABELS)]
    r = random.Random(1)
    rows = [(f"r{i % 3}", i, r.choice(sets) if i % 3 else sets[1]) for i in range(900)]
    got = least_used_frames(spark.createDataFrame(rows, "run_id string, sequence_no int, focus_labels array<string>"), seed=3).collect()
    assert len(got) == 900
    use = {}
    for x in got:
        assert x.frame_id is None if "NOPE" in x.focus_labels else set(x.focus_labels) <= set(catalog.FRAMES[x.frame_id][4])
        use.setdefault(x.run_id, []).append(x.frame_id)
    counts = [use["r0"].count(f) for f in set(use["r0"])]
    assert sum(counts) == 300 and max(counts) - min(counts) <= 1
    greedy = {}
    for _, n, labels in sorted(x for x in rows if x[0] == "r1"):
        fit = [f for f in catalog.FRAMES if set(labels) <= set(catalog.FRAMES[f][4])]
        if fit:
            best = min(fit, key=lambda f: greedy.get(f, 0))
            greedy[best] = greedy.get(best, 0) + 1
    mine = {f: use["r1"].count(f) for f in greedy}
    assert max(mine.values()) <= max(greedy.values()) + 2  # poured once, the sets of few frames first


def test_masks_are_sets(spark):
    r = random.Random(6)
    rows = [(i, r.sample(catalog.LABELS, r.randrange(5)) + ["NOPE"] * (i % 7 == 0)) for i in range(60)]
    mask = catalog.mask(F.col("labels"))
    for x in spark.createDataFrame(rows, "i int, labels array<string>").select("labels", mask.alias("m"), catalog.label_array(mask).alias("back"), catalog.frame_ids(catalog.frame_set(mask)).alias("frames")).collect():
        assert x.m == catalog.mask_of(x.labels) and set(x.back) == set(x.labels) - {"NOPE"}
        assert x.frames == [k for k, v in catalog.FRAMES.items() if set(x.labels) <= set(v[4])]


# ---- events in order


def test_events_come_in_order_of_causation(spark, tmp_path):
    from annolith.sources.events import TYPES, run_events
    from annolith.sources.files import append_events, event_sink, read_events

    config = runs.demo(num_samples=12, minimum_per_label=0, max_regenerate_attempts=1, max_task_replacements=1)
    bad = lambda n: (F.col("slot_no") == 3) | (F.col("slot_no") == 5) & (F.col("replacement_no") == 0) | (F.col("slot_no") == 7) & F.lit(n == 1)
    attempt = lambda packs, n: (rows := samples.render(packs, runs.DOCUMENTS)).withColumn("tagged_text", F.when(bad(n), F.concat("tagged_text", F.lit(" </X>"))).otherwise(F.col("tagged_text")))  # noqa: E731, F841
    found = run_events(runs.run(spark, config, attempt=attempt), "2026-01-01 00:00:00")
    append_events(found, str(tmp_path / "log"), "a")
    rows = read_events(spark, str(tmp_path / "log"), "demo").collect()
    kinds = [r.event_type for r in rows]
    assert len({r.position for r in rows}) == len(rows) == found.count()
    assert kinds[0] == "run.created" and kinds[1:13] == ["generation.task.created"] * 12 and kinds[-1] == "run.failed"
    at = {}
    for i, r in enumerate(rows):
        at.setdefault(r.causation_id, []).append((i, r.event_type))
    for task, own in at.items():
        names = [k for _, k in own]
        if task == "demo":
            continue
        assert names[0] == "generation.task.created" and names[1] in ("seed.rejected", "seed.validated")
        tries = [k for k in names if k in ("seed.validated", "data.generated", "data.deterministic.validated", "data.generation.rejected")]
        assert all(tries[i : i + 3] == ["seed.validated", "data.generated", "data.deterministic.validated"] for i, k in enumerate(tries) if k == "seed.validated")
        ends = [k for k in names if k in ("sample.accepted", "generation.task.rejected", "generation.task.replaced")]
        assert names[-len(ends) :] == ends and ends in (["sample.accepted"], ["generation.task.rejected"], ["generation.task.rejected", "generation.task.replaced"])
    new = [i for i, r in enumerate(rows) if r.event_type == "generation.task.created"][12:]
    assert len(new) == 2 and all(i > max(j for j, k in enumerate(kinds) if k == "generation.task.replaced") for i in new)
    assert set(kinds) <= set(TYPES)
    # as a stream, with a micro-batch that comes twice
    found.coalesce(1).write.parquet(str(tmp_path / "in"))
    sink = event_sink(str(tmp_path / "streamed"), "q")

    def twice(batch, n):
        sink(batch, n)
        sink(batch, n)

    query = spark.readStream.schema(found.schema).parquet(str(tmp_path / "in")).writeStream.foreachBatch(twice).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    again = read_events(spark, str(tmp_path / "streamed"), "demo")
    assert [r.event_id for r in again.collect()] == [r.event_id for r in rows]
    assert spark.read.json(str(tmp_path / "streamed")).count() == len(rows)


def test_run_requests(spark):
    from annolith.sources.settings import run_requests

    env = "OPENAI_API_KEY=k\nBASE_URL=https://h/"
    rows = [(1, ["--focus-labels", "date,TIME", "--samples", "4"], env), (2, ["--samples", "x", "--focus-labels", "A"], env), (3, None, env), (4, ["--focus-labels", "A"], None), (5, ["--focus-labels", "A", "--odd"], env)]
    got = {r.id: r for r in run_requests(spark.createDataFrame(rows, "id int, flags array<string>, settings string"), "id").collect()}
    assert (got[1].labels, got[1].num_samples, got[1].base_url, got[1].error) == ("DATE,TIME", 4, "https://h", None)
    assert all(got[i].error and got[i].run_name is None for i in (2, 3, 4, 5))


# ---- look-alikes


def test_every_look_alike_makes_a_pack_without_issues(spark):
    """Many draws of each label's packs: all valid, and each of its strategies comes up."""
    config = runs.demo(num_samples=60, minimum_per_label=0, focus_labels=list(catalog.LABELS), sample_type_distribution={"positive": 0.0, "pure_negative": 0.0, "hard_negative": 1.0}, hard_negative_mode="decoy_only")
    base = plan_tasks(spark, config).limit(1)
    tasks = base.drop("focus_labels", "task_id", "sequence_no").crossJoin(catalog.labels(spark).select("label")).crossJoin(spark.range(1, 31).withColumnRenamed("id", "sequence_no"))
    tasks = tasks.withColumn("focus_labels", F.array("label")).withColumn("task_id", F.concat_ws("-", "label", "sequence_no")).drop("label")
    table = strategies(spark)
    packs = samples.seed_pack_issues(samples.seed_packs(tasks, table, 3, 0, True, 1, 1), table, True, 1, 1).cache()
    assert packs.count() == 44 * 30
    assert packs.where("size(pack_issues) > 0").select("task_id", "decoys", "pack_issues").limit(3).collect() == []
    seen = {r.label: r.n for r in packs.select(F.explode("decoys").alias("d")).groupBy("d.label").agg(F.count_distinct("d.strategy_id").alias("n")).collect()}
    assert seen == dict.fromkeys(catalog.LABELS, 3)
    packs.unpersist()


def test_collisions_of_look_alikes(spark):
    """A value that also has another label's format is refused, whether its strategy declares that or not."""
    schema = "sample_type string, focus_labels array<string>, positives array<struct<label:string,value:string,variant:string>>, content_seeds struct<role:string,action:string,object:string>, decoys array<struct<strategy_id:string,label:string,value:string,required:array<string>,forbidden:array<string>,negative_labels:array<string>,collision_labels:array<string>>>"
    decoy = lambda value, negative, collisions: ("hard_negative", ["PIN"], [], None, [("pin_as_pressure", "PIN", value, ["chỉ số đo"], [], negative, collisions)])
    rows = [decoy("123 bar mức A", ["PIN"], []), decoy("10000", ["PIN"], []), decoy("10000", ["PIN"], ["ZIP_CODE"]), decoy("10000", ["PIN", "ZIP_CODE"], []), decoy("123 bar mức A", ["PIN", "NOPE"], [])]
    got = samples.seed_pack_issues(spark.createDataFrame(rows, schema).coalesce(1), strategies(spark), True, 1, 1).collect()
    kinds = [[(i.type, i.reason) for i in r.pack_issues if "strategy" not in i.reason] for r in got]
    assert kinds[0] == [] and kinds[3] == []
    assert kinds[1] == [("taxonomy_collision", "also a value of ZIP_CODE")]
    assert kinds[2] == [("taxonomy_collision", "also a value of ZIP_CODE"), ("taxonomy_collision", "declared collision with ZIP_CODE")]
    assert kinds[4] == [("invalid_seed", "labels absent from the taxonomy: NOPE")]


def test_release_deletes_what_was_cut(spark):
    import os

    from annolith import shared

    kept, shared.written[:] = list(shared.written), []
    rows = shared.cut(spark.range(5))
    path = shared.written[0].removeprefix("file://")
    assert rows.count() == 5 and os.path.isdir(path)
    assert shared.release(spark) == 1 and not os.path.exists(path) and not shared.written
    shared.written[:] = kept
