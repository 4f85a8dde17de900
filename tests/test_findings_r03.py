"""What the findings of round 3 asked for."""

import os

from pyspark.sql import functions as F


def test_log_of_many_runs_has_few_folders(spark, tmp_path):
    from annolith.sources.files import BUCKETS, append_events, read_events

    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("event_id"), F.lit("run.created").alias("event_type"), F.lit(1).alias("event_version"), F.lit("2026-01-01").cast("timestamp").alias("occurred_at"), F.when(F.col("id") % 500 > 0, F.concat(F.lit("r"), F.col("id") % 500)).alias("correlation_id"),
        F.lit(None).cast("string").alias("causation_id"), F.concat(F.lit("k"), "id").alias("idempotency_key"), F.lit("{}").alias("payload"), (-F.col("id")).alias("position"))
    for _ in range(2):
        append_events(rows, str(tmp_path / "log"), "a")
    folders = [x for x in os.listdir(tmp_path / "log" / "batch=a") if "=" in x]
    assert 1 < len(folders) <= BUCKETS
    assert read_events(spark, str(tmp_path / "log")).count() == 3000
    own = read_events(spark, str(tmp_path / "log"), "r7")
    assert [r.event_id for r in own.collect()] == [str(i) for i in range(2507, 0, -500)] and {r.correlation_id for r in own.collect()} == {"r7"}
    assert read_events(spark, str(tmp_path / "log"), "").count() == 6


def test_of_lines_of_one_number_the_first_of_the_table_counts(spark, tmp_path):
    from annolith import queries as core

    (tmp_path / "lineitem.parquet").mkdir()
    spark.createDataFrame([(1, "F")], "o_orderkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    lines = lambda name, rows: spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_returnflag string").toPandas().to_parquet(tmp_path / "lineitem.parquet" / name)
    lines("a.parquet", [(1, 1, "R")])
    lines("b.parquet", [(1, 1, "N")] + [(k, 1, "N") for k in range(2, 5000)])  # the larger file is read first
    assert [(r.status, r.attempts) for r in core.task_life_cycle(spark, str(tmp_path)).collect()] == [("REGENERATING", 1)]


def test_batches_of_values_equal_drawn_columns(spark):
    from annolith.functions import templates
    from annolith.plans import values
    from annolith.plans.strategies import registry

    made = [(name, parts) for label, variants in values.PARSED.items() for name, parts in [(f"{label}.{i}", p) for i, (_, p) in enumerate(variants)]] + [(r[0], r[-1]) for r in registry()]
    keys = [None, "", "0", "17", "khóa"]
    rows = [(name, [tuple(p.values()) for p in parts], k) for name, parts in made for k in keys]
    df = spark.createDataFrame(rows, f"name string, parts array<{templates.PART}>, k string")
    told = {(r.name, r.k): r.v for r in df.select("name", "k", templates.drawn(F.col("parts"), 9, F.col("name"), F.col("k")).alias("v")).collect()}
    for name, parts in made:
        assert templates.drawn_batch([tuple(p.values()) for p in parts], f"9|{name}", keys).to_pylist() == [told[name, k] for k in keys], name


def test_short_keys_make_values_in_many_tasks(spark, tmp_path):
    from annolith import queries as core

    spark.range(100).select(F.col("id").alias("c_custkey"), F.lit(1).alias("c_nationkey")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    for name in ("strategy_values", "seed_values", "settings_and_flags"):
        used = core.QUERIES[name](spark, str(tmp_path)).select(F.spark_partition_id().alias("p")).distinct().count()
        assert used >= 8, name


def test_hot_print_keys_lose_no_pair(spark):
    """Prints whose equal keys never go on with an equal third integer: a key that many share must still lead them to each other."""
    import numpy as np

    from annolith.llm import audio_prints

    r = np.random.default_rng(3)
    rows = []
    for i in range(6):
        x = r.integers(0, 1 << 32, 96, dtype=np.uint32)
        y = np.where(np.arange(96) % 24 >= 16, x ^ np.uint32(1), x)
        rows += [(20 * i, x.astype("<u4").tobytes()), (20 * i + 1, y.astype("<u4").tobytes()), (20 * i + 2, np.roll(y, 3).astype("<u4").tobytes())]
    prints = spark.createDataFrame(rows, "id long, print binary")
    told = lambda **k: sorted(tuple(x) for x in audio_prints.align(prints, F.col("id") % 20 == 0, **k).collect())
    plain = told()
    assert {(x[0], x[2]) for x in plain} >= {(20 * i, 20 * i + 1) for i in range(6)}
    assert told(hot=1) == plain == told(hot=2)


def test_one_run_is_numbered_over_many_tasks(spark):
    from annolith.operators import audit

    rows = spark.range(4000).select(F.when(F.col("id") % 100 == 0, F.lit(None)).otherwise(F.lit("demo")).alias("_run"), (F.col("id") * 7919 % 4001).alias("_order"), (F.col("id") % 3).cast("string").alias("_text"))
    made = audit._numbered(rows)
    got = made.withColumn("p", F.spark_partition_id()).collect()
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan.split("windowspecdefinition(")[1].split(")")[0]  # no window over a whole run
    for run, n in (("demo", 3960), (None, 40)):
        assert sorted(r._at for r in got if r._run == run) == list(range(n))
    by = {(r._run, r._at): r for r in got}
    assert len(by) == 4000 and audit.near_duplicates(rows.withColumnsRenamed({"_run": "r", "_order": "o", "_text": "t"}), "r", "o", "t").count() == 4000


def test_ratios_of_many_pairs_are_those_of_difflib(monkeypatch):
    import difflib
    import random

    from annolith.functions import blocks

    r, firsts, seconds = random.Random(6), [], []
    some = lambda n, k: "".join(r.choice("ab cdefghijklmnopqrstuvwxyzếĐ😀\ud800\0"[:k]) for _ in range(n))
    for _ in range(300):
        k, n = r.choice([1, 2, 3, 12, 30]), r.choice([0, 1, 20, 150, 199, 200, 400])
        a = some(r.randint(0, n), k)
        p = r.randint(0, len(a))
        firsts.append(a)
        seconds.append(r.choice([some(r.randint(0, n), k), a[:p] + some(r.randint(0, 9), k) + a[p + r.randint(0, 9) :]]))
    want = [difflib.SequenceMatcher(None, a, b).ratio() for a, b in zip(firsts, seconds)]
    assert blocks.ratios(firsts, seconds).tolist() == want
    monkeypatch.setattr(blocks, "MOST", 500)  # pairs of too many equal places are halved, then left to difflib
    assert blocks.ratios(firsts, seconds).tolist() == want
    assert blocks.ratios([], []).tolist() == []


def test_imitation_measures_a_batch_at_once(monkeypatch):
    import pandas as pd

    from annolith.functions import text

    calls = []
    ratios = text.blocks.ratios
    monkeypatch.setattr(text.blocks, "ratios", lambda a, b: calls.append(len(a)) or ratios(a, b))
    texts = [f"câu số {i} nói về việc {i * 7919 % 97} của người {i % 5}" for i in range(40)]
    found = text.closest_example.func(pd.Series([*texts, None]), pd.Series([texts[i : i + 3] for i in range(1, 40)] + [None, [None]]))
    assert calls == [sum(len(texts[i : i + 3]) for i in range(1, 40)) + 1]
    assert found.sequence[0] == max(text.ratio(*(" ".join(text.imitation_tokens(x)) for x in (texts[0], e))) for e in texts[1:4])
    assert pd.isna(found.sequence[39])


def test_first_rows_of_many_runs_are_measured_at_once(monkeypatch):
    from annolith.functions import similar
    from annolith.operators import novelty

    calls = []
    ratios = similar.blocks.ratios
    monkeypatch.setattr(similar.blocks, "ratios", lambda a, b: calls.append(len(a)) or ratios(a, b))
    rows = [{"_run": i // 4, "_block": 0, "skeleton": f"lời thứ {i} trong số {i * 31 % 40}", "_told": i % 4 > 0} for i in range(40)]
    known = novelty.first_ratios(rows)
    assert calls == [60] == [len(known)]
    memory = novelty.Memory("enforce", 0.99, 100, 3, known)
    for r in rows[:4]:
        memory.judge(r["skeleton"], [], True)
    assert sum(calls) == 60  # what is known isn't measured again


def test_one_run_is_guarded_in_many_tasks_and_calls_are_few(spark, monkeypatch):
    from annolith.functions import similar
    from annolith.operators import novelty

    rows = spark.range(4000).select(F.lit("demo").alias("run_id"), F.col("id").alias("sequence_no"), F.concat(F.lit("câu "), F.col("id") % 7).alias("skeleton"), F.array().cast("array<struct<label:string,value:string>>").alias("entities"), (F.col("id") % 2 == 0).alias("valid"))
    found = novelty.guard(rows, "audit")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan.split("windowspecdefinition(")[1].split(")")[0]  # no window over a whole run
    got = found.select("*", F.spark_partition_id().alias("p")).collect()
    assert len({r.p for r in got}) > 2 and sorted(r.sequence_no for r in got) == list(range(4000))
    assert all(r.max_similarity == 1.0 for r in got if r.sequence_no > 14)
    calls = []
    ratios = similar.blocks.ratios
    monkeypatch.setattr(similar.blocks, "ratios", lambda a, b: calls.append(len(a)) or ratios(a, b))
    recent, searches, texts = similar.Recent(50), [], [f"lời thứ {i} trong số {i * 31 % 40}" for i in range(100)]
    for t in texts:
        searches.append(recent.search(t, 3))
        recent.add(t)
    near = similar.together(searches)
    assert len(calls) <= 6
    alone = similar.Recent(50)
    for t, n in zip(texts, near):
        assert alone.nearest(t, 3) == n
        alone.add(t)


def test_learnt_runs_lie_beside_their_texts():
    import numpy as np
    import public_tokenizers

    from annolith.llm import segments

    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        e = segments.SegmentEncoder(public_tokenizers.path(name))
        new = [b" onethat", b"\nThis", " đường".encode(), b" a1", b" thinor", b" x", b",", " Öchß,".encode()]
        learnt = e._learn(new)
        assert learnt == [np.array(x.ids, "<u4").tobytes() for x in e.library.encode_batch([x.decode() for x in new], add_special_tokens=False)]

        values, texts = e._values, []
        e._values = lambda distinct: texts.extend(distinct) or values(distinct)
        ids = e.encode_texts(["one that\nThis, and one", "", "đường 1"])
        assert all(type(x) is bytes for x in texts) and ids == [x.ids for x in e.library.encode_batch(["one that\nThis, and one", "", "đường 1"], add_special_tokens=False)]


def test_common_subsequences_leave_few_pairs_to_measure(monkeypatch):
    import difflib
    import random

    from annolith.functions import similar

    def longest(a, b):
        line = [0] * (len(b) + 1)
        for x in a:
            before, line = line, [0]
            for j, y in enumerate(b):
                line.append(before[j] + 1 if x == y else max(before[j + 1], line[j]))
        return line[-1]

    draw = random.Random(3)
    word = lambda n: "".join(draw.choice("abâ😀 <") for _ in range(n))
    common, others = similar.Common(), [word(n) for n in (0, 1, 63, 64, 65, 30)]
    for place in range(6):
        others[place] = word(draw.choice([0, 5, 40, 130]))
        common.lay(others)
        asked = word(50)
        assert common.lengths(asked).tolist() == [longest(asked, x) for x in others]

    parts = ["người mua", "cán bộ trực", "đơn vị đối tác"], ["xin đối soát", "báo tin mới", "cần trợ giúp"], ["<person>", "<money>; <email>", "<date>", "<address>; <time>", "<phone>; <gender>"], ["internal_note", "support_ticket", "booking_request"]
    texts = [" ".join(draw.choice(p) for p in parts) + f" {draw.randrange(50)}" for _ in range(150)]
    pairs = []
    ratios = similar.blocks.ratios
    monkeypatch.setattr(similar.blocks, "ratios", lambda a, b: pairs.append(len(a)) or ratios(a, b))
    for wide in (similar.WIDE, 45):  # some texts are longer than that
        monkeypatch.setattr(similar, "WIDE", wide)
        recent, pairs[:] = similar.Recent(100), []
        for i, t in enumerate(texts):
            near = recent.nearest(t, 3)
            assert i % 10 or near == sorted(((difflib.SequenceMatcher(None, t, x).ratio(), x) for x in texts[max(0, i - 100) : i]), reverse=True)[:3]
            recent.add(t)
        if wide > 45:
            assert sum(pairs) < 15 * len(texts)


def test_blocks_and_candidates_go_over_all_tasks(spark, monkeypatch):
    from annolith.operators import novelty
    from annolith.plans import runs

    monkeypatch.setattr(novelty, "BLOCK", 100)
    rows = spark.range(2400).select(F.lit("demo").alias("run_id"), F.col("id").alias("sequence_no"), F.lit("câu").alias("skeleton"), F.array().cast("array<struct<label:string,value:string>>").alias("entities"), F.lit(True).alias("valid"))
    used = novelty.guard(rows, "audit", window=10).select(F.spark_partition_id().alias("p")).distinct().count()
    assert used == 24  # a task for each block
    taxonomy = spark.createDataFrame([("DATE", "d", ["r"])], "code string, definition string, rules array<string>")
    example = "array<struct<id:string,expected_tagged_text:string,rationale:string>>"
    taxonomy = taxonomy.withColumn("examples", F.struct(*(F.array().cast(example).alias(x) for x in ("POSITIVE", "PURE_NEGATIVE", "HARD_NEGATIVE"))))
    packs = spark.range(300).select(F.concat(F.lit("t"), "id").alias("task_id"), F.col("id").alias("sequence_no"), F.lit("positive").alias("sample_type"), F.array(F.lit("DATE")).alias("focus_labels")).coalesce(1)
    for told in (None, taxonomy):
        dealt = runs.guided(packs, told, runs.demo()).select("task_id", F.spark_partition_id().alias("p")).collect()
        assert len({r.task_id for r in dealt}) == len(dealt) == 300 and len({r.p for r in dealt}) >= 8
