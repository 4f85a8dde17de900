import hashlib
import itertools
import math
import random
import zlib
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from annolith.llm import conv_trie, interval_join, simhash

TURNS = "conv_id long, turn long, role string, text string, depth long, id string"
CLICKS = "click_id long, ts timestamp_ntz, client_id long, kind string, value double, key string, lo string"
SALES = "sale_id long, client_id long, status string, sold_at timestamp_ntz, id string, first string"
LINES = "sale_id long, line_no int, shipped_at timestamp_ntz, shipped string"
DOCS = "doc_id long, text string, fp string, component_id string"


# ---- conversation prefix trie


def plain_trie(turns):
    """Nodes by their definition, from (conv_id, turn, role, text, ...) rows."""
    mark = lambda t: hashlib.md5(f"{len(t[0].encode())}:{t[0]}{t[1]}".encode()).digest()
    convs = defaultdict(list)
    for c, turn, role, text, *_ in turns:
        if c is not None:
            convs[c].append((turn, (role or "", text or "")))
    convs = {c: [t for _, t in sorted(own, key=lambda x: (x[0] is not None, x[0] or 0, mark(x[1])))] for c, own in convs.items()}
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(convs.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:])  # the remainder has c's sign, as in SQL
    members = defaultdict(list)
    for c, path in made.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)

    def sums(path):
        below = [sums(k) for k in kids[path]]
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        return sum(x for x, _ in below) or 1, own + sum(x for _, x in below)

    out = set()
    for path, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(made[c]) == len(path))))
        out.add((min(who), len(path), min(members[path[:-1]]) if path else None, len(who), len(kids[path]), *sums(path), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def some_turns(seed, convs=45):
    r = random.Random(seed)
    words = [("user", "hé"), ("assistant", "yes"), (None, "no"), ("user", None), ("user", ""), ("system", "go on 😊")]
    turns = []
    for c in r.sample(range(-7, 400), convs):
        shape = r.randrange(4)
        length = r.choice([1, 2, 3, 9, 14])
        path = [words[0]] * length if shape == 0 else [words[i % 2] for i in range(length)] if shape == 1 else [r.choice(words) for _ in range(length)]
        numbers = list(range(length)) if shape else [None, *range(length - 1)]
        turns += [(c, n, role, text, 1, "x") for n, (role, text) in zip(numbers, path, strict=True)]
    turns += [(400 + i, t, "user", f"same {t}", 1, "x") for i in range(30) for t in range(12)]  # copies and equal beginnings
    turns += [(500, t % 3, "user", "tie" + "x" * (t % 2), 1, "x") for t in range(9)]  # ties and repeated rows
    turns += [(505, t, "user", f"long {t // 7}", 1, "x") for t in range(300)]
    turns += [(506, t, "user", f"long {t // 7}", 1, "x") for t in range(301)]
    turns += [(None, 0, "user", "nobody", 1, "x")]
    r.shuffle(turns)
    return turns


@pytest.mark.parametrize("local", [3, 4096])
def test_trie_equals_its_definition(spark, local):
    turns = some_turns(local)
    got = conv_trie.conversation_trie(spark.createDataFrame(turns, TURNS), local=local)
    rows = [tuple(x) for x in got.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == plain_trie(turns)
    assert {t for _, t in got.dtypes[:-1]} == {"bigint"}


def test_trie_of_few_conversations(spark):
    for turns in ([], [(None, 1, "a", "b", 1, "x")], [(3, 1, "a", "b", 1, "x")], [(5, 1, "a", "b", 1, "x")], [(10, i, "a", "b", 1, "x") for i in range(3)]):
        rows = conv_trie.conversation_trie(spark.createDataFrame(turns, TURNS)).collect()
        assert {(x.conv_id, x.depth, x.parent_conv_id, x.n_convs, x.n_children, x.n_leaves, x.saved_tokens, x.ends_sha256) for x in rows} == plain_trie(turns)


def test_multikey_quicksort_visits_each_prefix_once():
    r = random.Random(3)
    paths = sorted({(7, *(r.randrange(3) for _ in range(r.randrange(6)))) for _ in range(80)})
    order = list(range(len(paths)))
    r.shuffle(order)
    nodes = conv_trie.multikey_nodes([list(paths[i]) for i in order], [[1] * len(paths[i]) for i in order], [100 + i for i in order], [1] * len(order), 4, -1)
    wanted = {p[:d]: min(100 + i for i, q in enumerate(paths) if q[:d] == p[:d]) for p in paths for d in range(1, len(p) + 1)}
    assert sorted((n[0], n[1]) for n in nodes) == sorted((c, 3 + len(p)) for p, c in wanted.items())
    assert {n[7] for n in nodes if n[7] is not None} == {100 + i for i in order}


# ---- interval overlap join


def plain_pairs(sales, lines, clicks):
    zero, half, slot = datetime(1970, 1, 1), timedelta(minutes=30), timedelta(hours=6)
    us = lambda t: (t - zero) // timedelta(microseconds=1)
    by = defaultdict(lambda: defaultdict(bool))
    for _, ts, client, kind, *_ in clicks:
        if ts is not None and client is not None:
            by[client][ts] |= kind == "error"
    found = defaultdict(list)
    for client, times in by.items():
        run = []
        for t in [*sorted(times), None]:
            if run and (t is None or t - run[-1] > half):
                found[client].append(((run[0] - zero) // slot, float("inf") if times[run[-1]] else (run[-1] - zero) // slot, zlib.crc32(str(us(run[0])).encode())))
                run = []
            run.append(t)
    out = {}
    for sale, client, status, sold, *_ in set(sales):
        if client is None or sold is None:
            continue
        a = (sold - zero) // slot
        b = float("inf") if status == "open" else (max([sold, *(x[2] for x in lines if x[0] == sale and sale is not None and x[2] is not None)]) - zero) // slot
        for lo, hi, crc in found[client]:
            if a > hi or lo > b:
                continue
            names = (("overlaps", "finished_by", "contains"), ("starts", "equals", "started_by"), ("during", "finishes", "overlapped_by"))
            name = names[(a > lo) - (a < lo) + 1][(b > hi) - (b < hi) + 1]
            shared = None if b == hi == float("inf") else min(b, hi) - max(a, lo) + 1
            n, s, c = out.get((sale, name), (0, None, 0))
            out[sale, name] = (n + 1, s if shared is None else (s or 0) + shared, c + crc)
    return {(sale, name, *x) for (sale, name), x in out.items()}


def shop(seed, clients=6, sales=120, clicks=700):
    r = random.Random(seed)
    start = datetime(2024, 1, 1)
    time = lambda days: start + timedelta(microseconds=r.randrange(days * 86_400_000_000))
    # half of all rows have one client
    client = lambda: r.choice([0, 0, 0, None, *range(1, clients)] if r.random() < 0.6 else [0])
    own, moment = [], {}
    for i in range(clicks):
        c = client()
        ts = moment.get(c, start) + r.choice([timedelta(0), timedelta(minutes=1), timedelta(minutes=30), timedelta(minutes=30, microseconds=1), timedelta(hours=7)]) if r.random() < 0.8 else time(30)
        moment[c] = ts
        own.append((i, None if r.random() < 0.03 else ts, c, r.choice(["view", "error", None, "click"]), None, "k", "l"))
    own += own[:40]
    bought = [(i, client(), r.choice(["open", "done", "held", None]), None if r.random() < 0.03 else time(30), "x", "y") for i in range(sales)]
    bought += bought[:10]
    lines = [(r.choice([None, *range(sales)]), j, None if r.random() < 0.05 else time(45), "z") for j in range(2 * sales)]
    return bought, lines, own


@pytest.mark.parametrize("shard", [3, 50, 8192])
def test_interval_join_equals_its_definition(spark, shard, monkeypatch):
    monkeypatch.setattr(interval_join, "SHARD", shard)
    monkeypatch.setattr(interval_join.relation_sums, "__defaults__", (shard,))
    bought, lines, own = shop(shard)
    got = interval_join.sale_sessions(spark.createDataFrame(bought, SALES), spark.createDataFrame(lines, LINES), spark.createDataFrame(own, CLICKS))
    assert got.columns == ["sale_id", "relation", "n_pairs", "overlap_slots", "sessions_crc"]
    rows = [tuple(x) for x in got.collect()]
    wanted = plain_pairs(bought, lines, own)
    assert len(rows) == len(set(rows)) and set(rows) == wanted
    assert {x[1] for x in rows} >= {"overlaps", "contains", "during", "finishes", "finished_by", "overlapped_by"}


def test_times_without_zone_are_the_same_in_any_session(spark):
    bought, lines, own = shop(5, sales=40, clicks=200)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frames = spark.createDataFrame(bought, SALES), spark.createDataFrame(lines, LINES), spark.createDataFrame(own, CLICKS)
        assert {tuple(x) for x in interval_join.sale_sessions(*frames).collect()} == plain_pairs(bought, lines, own)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_interval_join_on_empty_tables(spark):
    bought, lines, own = shop(1, sales=10, clicks=20)
    full = [(spark.createDataFrame(rows, schema)) for rows, schema in ((bought, SALES), (lines, LINES), (own, CLICKS))]
    none = [x.limit(0) for x in full]
    assert interval_join.sale_sessions(none[0], full[1], full[2]).count() == 0
    assert interval_join.sale_sessions(full[0], full[1], none[2]).count() == 0
    assert {tuple(x) for x in interval_join.sale_sessions(full[0], none[1], full[2]).collect()} == plain_pairs(bought, [], own)


def test_relation_sums_of_hot_key_in_shards(spark):
    r = random.Random(8)
    span = lambda: (lo := r.randrange(-200, 200), interval_join.OPEN if r.random() < 0.2 else lo + r.randrange(30))
    left = [(i, 1, *span()) for i in range(150)] + [(200, None, 1, 2), (201, 1, None, 4), (202, 1, 9, 3)]
    right = [(1, *span(), r.randrange(100)) for _ in range(150)]
    frames = spark.createDataFrame(left, "id long, key long, lo long, hi long"), spark.createDataFrame(right, "key long, lo long, hi long, value long")
    a, b = (sorted(tuple(x) for x in interval_join.relation_sums(*frames, shard=n).select("id", "relation", "n_pairs", F.coalesce("shared", F.lit(-1)), "total").collect()) for n in (10, 10_000))
    assert a == b
    pairs = [(i, v) for i, k, lo, hi in left if k and lo is not None for _, p, q, v in right if lo <= q and p <= hi and lo <= hi]
    assert sum(x[2] for x in a) == len(pairs) and sum(x[4] for x in a) == sum(v for _, v in pairs)


# ---- SimHash near duplicates


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps):
    part = list(range(len(fps)))
    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2 and part[a] != part[b]:
            lo, hi = part[a], part[b]
            part = [lo if p == hi else p for p in part]
    return [min((ids[j] for j in range(len(ids)) if part[j] == part[i] and ids[j] is not None), default=None) for i in range(len(ids))]


@pytest.mark.parametrize("crowd", [1, 4096])
def test_simhash_equals_its_definition(spark, crowd):
    r = random.Random(crowd)
    texts = [None, "", " \t\n", "one", "ONE", "one two", "One\x0btwo", "a b c", "A b  C", "É b c", "é b c", "x " * 5000]
    for _ in range(10):
        base = [f"w{r.randrange(300)}" for _ in range(r.randrange(150, 400))]
        for _ in range(r.randrange(1, 20)):
            copy = base[:]
            for _ in range(r.randrange(0, 3)):
                copy[r.randrange(len(copy))] = f"v{r.randrange(1000)}"
            texts.append("  ".join(copy))
    texts += [texts[-1]] * 30
    ids = [None if i in (4, 9) else 1000 - i for i in range(len(texts))]
    got = simhash.simhash_classes(spark.createDataFrame([(i, t, "f", "c") for i, t in zip(ids, texts, strict=True)], DOCS), crowd=crowd)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    fps = [plain_fingerprint(t) for t in texts]
    wanted = sorted(((i, f"{f:016x}", c) for i, f, c in zip(ids, fps, plain_components(ids, fps), strict=True)), key=str)
    assert sorted((tuple(x) for x in got.collect()), key=str) == wanted
    assert len({x[2] for x in wanted}) < len(set(fps))  # some differing fingerprints link


@pytest.mark.parametrize("crowd", [2, 40, 4096])
def test_links_within_crowds_of_one_segment(spark, crowd):
    r = random.Random(crowd)
    top = r.getrandbits(64)
    fps = {top ^ (1 << a) ^ (1 << b) ^ (1 << c) for a, b, c in ((r.randrange(12), r.randrange(32, 44), r.randrange(64)) for _ in range(600))} | {r.getrandbits(64) for _ in range(100)}
    fps |= {(5 << 32) ^ (1 << r.randrange(32)) ^ (1 << r.randrange(32)) for _ in range(100)}
    fps = sorted(fps)
    rows = spark.createDataFrame([(int(np.array(f, np.uint64).view(np.int64)),) for f in fps], "fp long")
    edges = [tuple(int(np.array(v, np.int64).view(np.uint64)) for v in x) for x in simhash.fingerprint_links(rows, crowd).collect()]
    assert all((a ^ b) for a, b in edges)
    place, part = {f: i for i, f in enumerate(fps)}, list(range(len(fps)))
    for a, b in edges:
        lo, hi = part[place[a]], part[place[b]]
        part = [lo if p == hi else p for p in part]
    assert [min(i for i, p in enumerate(part) if p == q) for q in part] == plain_components(list(range(len(fps))), fps)


def test_near_looks_up_what_comparison_finds():
    r = np.random.default_rng(1)
    table = np.unique(np.uint64(9 << 50) ^ r.integers(0, 1 << 12, 3500).astype(np.uint64))
    asked = np.concatenate([table, table ^ np.uint64(1 << 40), table ^ np.uint64(3 << 41), r.integers(0, 1 << 60, 50).astype(np.uint64)])
    i, j = simhash.near(table, asked)
    wanted = np.argwhere(np.bitwise_count(asked[:, None] ^ table[None, :]) <= 2)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(map(tuple, wanted.tolist()))
    assert len(table) > 20 * (1 + 12 + 66)  # so the ball is looked up
    few = np.sort(np.concatenate([table[:40], r.integers(0, 1 << 60, 40).astype(np.uint64)]))
    i, j = simhash.near(few, asked)
    assert len(i) == int((np.bitwise_count(asked[:, None] ^ few[None, :]) <= 2).sum())


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(f"Word{i % 91}" for i in range(3000)) + "\n" + "y" * 500 + " a"
    whole = simhash.fingerprint(text.encode())
    assert whole == plain_fingerprint(text)
    for chunk in (1, 7, 64, 1000):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        assert simhash.fingerprint(text.encode()) == whole
        assert simhash.fingerprint(b"  a   b ") == plain_fingerprint("a b")


def test_simhash_on_an_empty_table(spark):
    assert simhash.simhash_classes(spark.createDataFrame([], DOCS)).collect() == []
