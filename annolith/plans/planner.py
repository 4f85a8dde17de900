"""Run configuration to task rows: weighted draws, quota axes, complexity budgets, label stratification, context frames."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolith.functions import rng
from annolith.plans import catalog

DIFFICULTIES, SAMPLE_TYPES = ("easy", "medium", "hard"), ("positive", "pure_negative", "hard_negative")
STRUCTURES = ("contract", "chat", "custom")


@dataclass
class RunConfig:
    run_name: str = "run"
    num_samples: int = 100
    language: str = "vi"
    minimum_per_label: int = 0
    batch_size: int = 100
    focus_labels: list[str] = field(default_factory=list)
    focus_label: str | None = None
    robin_labels: list[str] = field(default_factory=list)
    min_robins: int = 0
    max_robins: int = 2
    difficulty_distribution: dict[str, float] = field(default_factory=lambda: {"easy": 0.4, "medium": 0.4, "hard": 0.2})
    sample_type_distribution: dict[str, float] = field(default_factory=lambda: {"positive": 0.6, "pure_negative": 0.2, "hard_negative": 0.2})
    optional_constraint_distribution: dict[str, float] = field(default_factory=dict)
    max_entities: dict[str, int] = field(default_factory=lambda: {"easy": 2, "medium": 4, "hard": 6})
    complexity_limits: dict[str, int] = field(default_factory=lambda: {"positive": 6, "pure_negative": 3, "hard_negative": 4})
    hard_negative_mode: str = "mixed_contrastive"
    min_decoys: int = 1
    max_decoys: int = 2
    max_focus_labels: int = 2
    structure: str | None = None
    custom_instruction: str | None = None
    max_regenerate_attempts: int = 2
    max_task_replacements: int = 2
    random_seed: int = 0
    max_seed_pack_attempts: int = 5
    reject_mixed_locale: bool = True
    pure_negative_structured_scan: bool = True
    hard_negative_structured_scan: bool = True
    quality_checks: bool = False
    novelty_mode: str = "audit"
    near_duplicate_threshold: float = 0.9
    novelty_recent_window: int = 100
    max_novelty_feedback: int = 3
    max_repairs: int = 1
    #: least_used: the use of frames is levelled over the whole run; balanced: samples of equal label sets take the compatible frames in turn.
    frame_policy: str = "least_used"

    def __post_init__(self) -> None:
        self.language = {"vietnamese": "vi", "vi-vn": "vi", "vi_vn": "vi"}.get(self.language.strip().lower(), self.language.strip().lower())
        self.focus_labels = list(dict.fromkeys(x.strip().upper() for x in self.focus_labels))
        self.robin_labels = list(dict.fromkeys(x.strip().upper() for x in self.robin_labels))
        self.focus_label = self.focus_label.strip().upper() if self.focus_label else None

    @property
    def pool(self) -> list[str]:
        return [self.focus_label, *self.robin_labels] if self.focus_label else self.focus_labels


def config_errors(c: RunConfig) -> list[str]:
    """Everything that is wrong with a configuration; an empty list if nothing is."""
    out = []
    for name, have, keys in (("difficulty_distribution", c.difficulty_distribution, DIFFICULTIES), ("sample_type_distribution", c.sample_type_distribution, SAMPLE_TYPES)):
        if set(have) != set(keys):
            out.append(f"{name} needs exactly the keys {', '.join(keys)}")
        elif min(have.values()) < 0 or abs(sum(have.values()) - 1) > 1e-9:
            out.append(f"{name} must be non-negative and add up to 1")
    if any(not 0 <= p <= 1 for p in c.optional_constraint_distribution.values()):
        out.append("optional_constraint_distribution holds probabilities")
    if set(c.max_entities) != set(DIFFICULTIES) or any(not 1 <= v <= 10 for v in c.max_entities.values()):
        out.append("max_entities needs 1 to 10 for each difficulty")
    if not 1 <= c.num_samples <= 100_000:
        out.append("num_samples is 1 to 100000")
    if c.min_decoys > c.max_decoys or c.min_robins > c.max_robins:
        out.append("a minimum exceeds its maximum")
    if c.structure is not None and c.structure not in STRUCTURES:
        out.append("structure is contract, chat or custom")
    if (c.structure == "custom") != bool(c.custom_instruction):
        out.append("custom_instruction goes with the custom structure only")
    ranges = {
        "max_seed_pack_attempts": (c.max_seed_pack_attempts, 1, 20), "max_repairs": (c.max_repairs, 0, 1), "near_duplicate_threshold": (c.near_duplicate_threshold, 0.5, 1),
        "novelty_recent_window": (c.novelty_recent_window, 1, 10_000), "max_novelty_feedback": (c.max_novelty_feedback, 0, 10), "batch_size": (c.batch_size, 1, 10_000),
        "max_regenerate_attempts": (c.max_regenerate_attempts, 0, 4), "max_task_replacements": (c.max_task_replacements, 0, 10),
    }
    out += [f"{name} is {lo} to {hi}" for name, (value, lo, hi) in ranges.items() if not lo <= value <= hi]
    if c.novelty_mode not in ("off", "audit", "enforce"):
        out.append("novelty_mode is off, audit or enforce")
    if c.frame_policy not in ("balanced", "least_used"):
        out.append("frame_policy is balanced or least_used")
    if not c.pool:
        out.append("no labels")
    if unknown := sorted(set(c.pool) - set(catalog.LABELS)):
        out.append("absent from taxonomy: " + ", ".join(unknown))
    if c.focus_label:
        if c.focus_labels:
            out.append("focus_label excludes focus_labels")
        if c.focus_label in c.robin_labels:
            out.append("the anchor can't be one of its robins")
        if c.sample_type_distribution.get("pure_negative", 0) > 0:
            out.append("an anchor allows no pure negatives")
        if c.sample_type_distribution.get("hard_negative", 0) > 0 and c.hard_negative_mode != "mixed_contrastive":
            out.append("an anchor's hard negatives must be mixed_contrastive")
        for d, p in c.difficulty_distribution.items():
            for t, q in c.sample_type_distribution.items():
                if p > 0 and q > 0 and not out and _capacity(c, d, t) < 1 + c.min_robins:
                    out.append(f"no room for the robins in {d} {t} samples")
    elif c.minimum_per_label * len(c.focus_labels) > c.num_samples:
        out.append("minimum_per_label needs more samples")
    return out


def _capacity(c: RunConfig, difficulty: str, kind: str) -> int:
    reserved = c.min_decoys if kind == "hard_negative" else 0
    if kind == "pure_negative":
        return min(c.max_entities[difficulty], len(c.pool))
    if kind == "hard_negative" and c.hard_negative_mode == "decoy_only":
        return 1
    most = min(c.max_entities[difficulty], len(c.pool), max(1, c.complexity_limits[kind] - reserved))
    return min(most, c.max_focus_labels) if kind == "hard_negative" else most


def compatible_frames(labels: Column, excluded: list[str] = ()) -> Column:
    """Ids of the frames that support all labels."""
    return catalog.frame_ids(catalog.frame_set(catalog.mask(labels), excluded))


def plan_tasks(spark: SparkSession, c: RunConfig, slots: DataFrame | None = None) -> DataFrame:
    """One row per sample, each drawn by itself from (random_seed, axis, sequence_no); raises on a wrong configuration.

    slots: a table whose distinct sequence_no (1, 2, ...) are the samples, of any number; num_samples of them by default."""
    if errors := config_errors(c):
        raise ValueError("; ".join(errors))
    seq = F.col("sequence_no").cast("string")
    numbers = spark.range(1, c.num_samples + 1).select(F.col("id").alias("sequence_no")) if slots is None else slots
    rows = numbers.select(F.col("sequence_no").cast("int").alias("sequence_no"))
    rows = rows.withColumns({
        "difficulty": rng.weighted({d: c.difficulty_distribution[d] for d in DIFFICULTIES}, c.random_seed, "difficulty", seq),
        "sample_type": rng.weighted({t: c.sample_type_distribution[t] for t in SAMPLE_TYPES}, c.random_seed, "sample_type", seq),
    })
    limit = F.lit(None).cast("int")
    focus = F.lit(None).cast("int")
    for d in DIFFICULTIES:
        limit = F.when(F.col("difficulty") == d, c.max_entities[d]).otherwise(limit)
        for t in SAMPLE_TYPES:
            focus = F.when((F.col("difficulty") == d) & (F.col("sample_type") == t), _capacity(c, d, t)).otherwise(focus)
    kept = [F.when(rng.uniform(c.random_seed, f"constraint:{name}", seq) < p, F.lit(name)) for name, p in c.optional_constraint_distribution.items()]
    drawn = F.filter(F.array(*kept), lambda x: x.isNotNull()) if kept else F.array().cast("array<string>")
    budget = F.lit(0)
    for t in SAMPLE_TYPES:
        reserved = c.min_decoys if t == "hard_negative" else 0
        used = F.lit(0) if t == "pure_negative" or (t == "hard_negative" and c.hard_negative_mode == "decoy_only") else F.col("max_focus")
        budget = F.when(F.col("sample_type") == t, F.greatest(F.lit(0), F.lit(c.complexity_limits[t] - reserved) - used)).otherwise(budget)
    rows = rows.withColumns({"max_entities": limit, "max_focus": focus}).withColumn("optional_constraints", F.slice(drawn, F.lit(1), budget))
    pool = lambda xs: F.array(*(F.lit(x) for x in xs)) if xs else F.array().cast("array<string>")
    if c.focus_label:
        most = F.least(F.lit(min(c.max_robins, len(c.robin_labels))), F.greatest(F.lit(0), F.col("max_focus") - 1))
        count = (rng.bits(c.random_seed, "robins", seq) % (most - c.min_robins + 1) + c.min_robins).cast("int")
        primary, rest = F.lit(c.focus_label), rng.shuffled(pool(c.robin_labels), c.random_seed, "robin_order", seq)
    else:
        mandatory = c.minimum_per_label * len(c.focus_labels)
        primary = rng.choice(c.focus_labels, c.random_seed, "primary", seq)
        if mandatory:
            primary = F.when(F.col("sequence_no") <= mandatory, F.element_at(pool(c.focus_labels), (F.floor((F.least(F.col("sequence_no"), F.lit(mandatory)) - 1) / c.minimum_per_label) + 1).cast("int"))).otherwise(primary)
        count = (rng.bits(c.random_seed, "focus_count", seq) % F.col("max_focus")).cast("int")
        rest = rng.shuffled(F.filter(pool(c.focus_labels), lambda x: x != F.col("primary_label")), c.random_seed, "label_order", seq)
    rows = rows.withColumn("primary_label", primary)
    rows = rows.withColumn("focus_labels", F.concat(F.array("primary_label"), F.slice(rest, F.lit(1), count)))
    axes = {name: rng.bag(values, F.col("sequence_no"), c.random_seed, name) for name, values in catalog.AXES.items()}
    if c.structure == "contract":
        axes |= {"document_structure": rng.bag(catalog.CONTRACT_STRUCTURES, F.col("sequence_no"), c.random_seed, "contract"), "language_register": rng.choice(catalog.CONTRACT_REGISTERS, c.random_seed, "contract_register", seq)}
    elif c.structure == "chat":
        axes["document_structure"] = rng.bag(catalog.CHAT_STRUCTURES, F.col("sequence_no"), c.random_seed, "chat")
        axes["language_register"] = F.when(axes["document_structure"] == "friend_chat", "informal").otherwise("neutral")
    elif c.structure == "custom":
        axes["document_structure"] = F.lit("custom_format")
    rows = rows.withColumns(axes)
    if c.frame_policy == "balanced":  # in another order each time round
        labels = F.array_join(F.array_sort("focus_labels"), ",")
        rows = rows.withColumn("frames", compatible_frames(F.col("focus_labels"))).withColumn("at", F.row_number().over(Window.partitionBy(labels).orderBy("sequence_no")) - 1)
        at = F.col("at")
        order = rng.shuffled(F.col("frames"), c.random_seed, "frame", labels, F.floor(at / F.size("frames")).cast("string"))
        rows = rows.withColumn("context_frame_id", F.element_at(order, (at % F.size("frames") + 1).cast("int"))).drop("frames", "at")
    else:
        rows = least_used_frames(rows.withColumn("_of", F.lit(c.run_name)), "_of", c.random_seed).drop("_of").withColumnRenamed("frame_id", "context_frame_id")
    return rows.withColumns({
        "task_seed": rng.bits(c.random_seed, "task", seq),
        "task_id": F.md5(F.concat_ws("|", F.lit(c.run_name), F.lit(str(c.random_seed)), seq)),
        "slot_no": F.col("sequence_no"),
        "language": F.lit(c.language),
        "max_attempts": F.lit(c.max_regenerate_attempts + 1),
        "replacement_no": F.lit(0),
    }).drop("primary_label", "max_focus")


def level_quotas(counts: dict[int, int]) -> dict[int, list[tuple[int, int]]]:
    """For each frame set the samples that each of its frames gets, as (place of the frame, samples): sets of few frames first, each
    poured like water onto those of its frames that are used least. One set alone is levelled to a difference of one."""
    used = [0] * len(catalog.FRAMES)
    out: dict[int, list[tuple[int, int]]] = {}
    for frames in sorted(counts, key=lambda m: (m.bit_count(), m)):
        n = counts[frames]
        low = sorted((used[i], i) for i in range(len(used)) if frames >> i & 1)
        if not low:
            continue
        m = sum(k * low[k - 1][0] - sum(t for t, _ in low[:k]) < n for k in range(1, len(low) + 1))
        water, extra = divmod(n + sum(t for t, _ in low[:m]), max(m, 1))
        got = sorted((i, water - t + (r < extra)) for r, (t, i) in enumerate(low[:m]))
        for i, q in got:
            used[i] += q
        out[frames] = got
    return out


#: Parts of a frame set's samples that are numbered on their own.
NUMBERED = 1024


def least_used_frames(tasks: DataFrame, run_col: str = "run_id", seed: int = 0) -> DataFrame:
    """tasks (run, sequence_no, focus_labels) with frame_id: the use of each run's frames is levelled over its label sets, and
    differs by one at most where all tasks have one label set; null where no frame supports a task's labels.

    No task looks at the ones before. Tasks count by run and frame set (2,047 sets at most); a run's counts become quotas of its
    frames; and the tasks of a set, in an order drawn from the seed, take its frames up to their quotas. Numbers come from those
    within NUMBERED parts of a set and the sizes of the parts before, so that a set of any size is dealt over tasks."""
    own = tasks.withColumn("_run", F.coalesce(F.col(run_col).cast("string"), F.lit(""))).withColumn("_set", catalog.frame_set(catalog.mask(F.col("focus_labels"))))
    own = own.withColumn("_draw", rng.bits(seed, "frame", F.col("_run"), F.col("sequence_no").cast("string"))).withColumn("_part", F.col("_draw") % NUMBERED)
    sizes = own.groupBy("_run", "_set", "_part").agg(F.count("*").alias("n"))
    parts = sizes.withColumn("_before", F.sum("n").over(Window.partitionBy("_run", "_set").orderBy("_part")) - F.col("n")).select("_run", "_set", "_part", "_before")
    counts = sizes.groupBy("_run", "_set").agg(F.sum("n").alias("n"))

    def quotas(pdf):
        import pandas as pd

        got = level_quotas({int(m): int(n) for m, n in zip(pdf["_set"], pdf["n"], strict=True) if m})
        rows = []
        for frames, shares in got.items():
            ends = [sum(q for _, q in shares[: k + 1]) for k in range(len(shares))]
            rows.append((pdf["_run"].iloc[0], frames, ends, [i for i, _ in shares]))
        return pd.DataFrame(rows, columns=["_run", "_set", "_ends", "_frames"])

    shares = counts.groupBy("_run").applyInPandas(quotas, "_run string, _set int, _ends array<long>, _frames array<int>")
    place = F.row_number().over(Window.partitionBy("_run", "_set", "_part").orderBy("_draw", "sequence_no")) - 1
    own = own.withColumn("_place", place).join(parts, ["_run", "_set", "_part"]).join(shares, ["_run", "_set"], "left")
    names = F.array(*(F.lit(x) for x in catalog.FRAMES))
    passed = F.size(F.filter("_ends", lambda e: e <= F.col("_place") + F.col("_before")))
    return own.withColumn("frame_id", F.when(F.col("_ends").isNotNull(), F.get(names, F.get("_frames", passed)))).select(*tasks.columns, "frame_id")


def select_frame(preferred: Column, labels: Column, seed: int, *key) -> Column:
    """The preferred frame if it supports all labels, else a drawn one that does; null where none does."""
    fit = compatible_frames(labels)
    drawn = F.get(fit, (rng.bits(seed, "frame_pick", *key) % F.greatest(F.size(fit), F.lit(1))).cast("int"))
    return F.when(F.array_contains(fit, preferred), preferred).otherwise(drawn)


def unknown_labels(asked: DataFrame, column: str) -> DataFrame:
    """Distinct labels that are not in the domain."""
    return asked.where(~F.col(column).isin(*catalog.LABELS)).select(column).distinct()
