"""The Jaccard join, hard-negative mining and conversation repair, each against a brute-force version."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strataflow.llm import conversation_repair as repair
from strataflow.llm import hard_negatives as hard
from strataflow.llm import jaccard_join as jaccard
from verification.compare import connect, differences

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- n-gram Jaccard join -------------------------------------------------------------------------------------------


def shingle_set(text: str | None, n: int = 5) -> set:
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def classes_by_hand(rows: list[tuple], percent: int = 80) -> list[tuple]:
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least: dict[int, int] = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(
        ((i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str
    )


def family(rng: random.Random, words: int, copies: int, edits: int) -> list[str]:
    """Texts that differ from one of them in a few words, and from each other in more."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.fixture(scope="module")
def texts() -> list[tuple]:
    rng = random.Random(11)
    found = [t for words, copies in ((6, 12), (9, 12), (14, 10), (30, 14), (70, 14), (130, 14), (400, 12)) for t in
             family(rng, words, copies, max(1, words // 25))]
    passage = " ".join(f"p{k}" for k in range(60))
    found += [f"{passage} " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))) for _ in range(25)]
    found += ["one two", "ONE\ttwo", "one two three four", "one two three four five", "", " \n\t ", " ", " "]
    found += [" ".join(["again"] * 50), " ".join(["again"] * 500), "word " * 20_000, found[0], found[0].upper()]
    found += [" ".join(f"l{k}" for k in range(30_000)), " ".join(f"l{k}" for k in range(2_000, 32_000))]
    rows = list(enumerate(found)) + [(None, found[3]), (None, None), (5, None), (7, "other words under a repeated id for sure")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("forms", [{}, {k: jaccard.DELETIONS for k in range(1, 12)}, {k: jaccard.ELEMENTS for k in range(12)},
                                   {k: jaccard.PLAIN for k in range(1, 12)}])
def test_classes_equal_all_pairs(spark, texts, forms, monkeypatch):
    """Whatever the form of a scheme; where a plain scheme has too few segments it moves on by itself."""
    monkeypatch.setattr(jaccard.Schemes, "form", lambda self, k: max(self.forms.get(k, 0), forms.get(k, jaccard.ELEMENTS if k == 0 else 0)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("n_shingles", F.lit(1)).withColumn("node", F.lit("x"))
    got = jaccard.similarity_classes(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == classes_by_hand(texts)


def test_crowded_lists_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CROWDED", 2)
    monkeypatch.setattr(jaccard, "_with_centre", lambda part, percent, *salt: part.select("node", F.col("node").alias("v")).toDF("u", "v").limit(0))
    rng = random.Random(5)
    rows = list(enumerate(t for words in (10, 40, 120) for t in family(rng, words, 25, words // 12)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.similarity_classes(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == classes_by_hand(rows)


def test_classes_of_nothing(spark):
    assert jaccard.similarity_classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_allocations_are_complete():
    """Any two sets within the bound share a key that the larger one may probe, even if all others are taken away."""
    schemes, rng = jaccard.Schemes(80), np.random.default_rng(3)
    for n in (1, 4, 5, 9, 13, 14, 30, 64, 95, 120, 310, 900):
        for _ in range(20):
            large = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            keep = max(1, n - int(rng.integers(0, n - -(-n * 80 // 100) + 1)))
            small = large[:keep]
            scheme = schemes.scheme(n)
            keys, slots, worth = schemes.entries(large, scheme)
            assert worth >= schemes.differences(2 * n) + 1
            assert scheme == schemes.scheme(keep) or scheme in schemes.larger(keep)
            shared = np.isin(keys, schemes.entries(small, scheme)[0])
            value = {(s >> 2 or key): s & 3 for key, s, same in zip(keys.tolist(), slots.tolist(), shared) if same}
            assert worth - sum(value.values()) <= schemes.differences(n + keep)


# --- hard negatives ------------------------------------------------------------------------------------------------


def negatives_by_hand(rows: list[tuple]) -> list[tuple]:
    good = [(i, int(l), np.floor(256 * np.array(v, float)).astype(np.int64)) for i, l, v in rows
            if l is not None and v is not None and None not in v and np.isfinite(v).all()]
    width = max((len(v) for *_, v in good), default=0)
    good = [(i, l, np.pad(v, (0, width - len(v)))) for i, l, v in good]
    good = [(i, (l + 1) % 10 if i is not None and i % 7 == 0 else l, v) for i, l, v in good]
    out = []
    for k, (anchor, label, vector) in enumerate(good):
        if anchor is None or anchor % 100:
            continue
        scored = sorted(((-int(v @ vector), i is None, i or 0, l, i) for j, (i, l, v) in enumerate(good) if j != k), key=lambda x: x[:3])
        for p in [s for s in scored if s[3] == label][:5]:
            fit = [s for s in scored if s[3] != label and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]]
            out += [(anchor, p[4], place, s[4], -p[0], -s[0]) for place, s in enumerate(fit[:10], 1)]
    return sorted(out, key=str)


def mined(spark, rows: list[tuple], schema: str = "vec_id long, label int, embedding array<float>") -> list[tuple]:
    table = spark.createDataFrame(rows, schema).withColumns({"row": F.lit("clash"), "Score": F.lit(1), "norm": F.lit(2)})
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard.mine(hard.prepare(table, label=label), F.col("vec_id") % 100 == 0)
    return sorted(map(tuple, found.collect()), key=str)


@pytest.fixture(scope="module")
def vectors() -> list[tuple]:
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(10, 12))
    rows = []
    for i in range(900):
        label = int(rng.integers(0, 3)) if i % 3 else 4  # a third has one label
        v = centres[label] + rng.normal(size=12) * rng.choice([0.05, 0.5, 3])
        rows.append((i, label, [float(np.float32(x)) for x in v]))
    same = rows[10][2]
    rows += [(1000 + k, k % 2, same) for k in range(40)]  # ties
    rows += [(100, 4, rows[3][2]), (100, 4, rows[3][2]), (None, 4, rows[4][2]), (None, None, same)]
    rows += [(2000, 1, [0.0] * 12), (2001, 1, [1.0, 2.0]), (2002, 2, []), (2100, 9, None), (2101, 2, [None] * 12)]
    rows += [(2200, 1, [float("nan")] * 12), (2201, 2, [float("inf")] + [0.0] * 11), (2300, 8, same), (-700, 1, same), (2007, 2, [3e38] * 12)]
    return rows


@pytest.mark.parametrize("held", [hard.GROUP_BYTES, 1])
def test_negatives_equal_all_scores(spark, vectors, held, monkeypatch):
    monkeypatch.setattr(hard, "GROUP_BYTES", held)
    monkeypatch.setattr(hard, "LEAST_GROUP", 200)
    fitting = [r for r in vectors if r[0] != 2007]  # scores beyond 64 bits take no part
    assert mined(spark, vectors) == negatives_by_hand(fitting)


def test_large_components_are_scored_exactly(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i % 3, (rng.normal(size=4) * scale).tolist()) for i, scale in enumerate([1.0, 300.0, 2e4, 2e5] * 60)]
    assert mined(spark, rows, "vec_id long, label int, embedding array<double>") == negatives_by_hand(rows)


def test_bounds_hold_and_runs_are_skipped(spark, vectors):
    prepared = hard.prepare(spark.createDataFrame(vectors, "vec_id long, label int, embedding array<float>"))
    table = prepared.toArrow()
    group = hard._Group(table)
    norm, label = table.column("norm").to_numpy(), table.column("label").to_numpy()
    angles = hard._matrix(table.column("angles").combine_chunks(), np.float32)
    own = hard._matrix(table.column("vector").combine_chunks(), np.int32)
    least, most = group.bounds(angles, norm)
    scores = group.scores(own, np.arange(len(group.row)), 2.0**40)
    for k, (a, b) in enumerate(zip(group.start, group.end)):
        assert (scores[:, a:b] >= least[:, k, None]).all() and (scores[:, a:b] <= most[:, k, None]).all()
    assert len(set(group.label[group.start])) == len(set(label))


def test_no_vectors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0])]) == []


def test_negatives_equal_sql(spark):
    assert differences(entry.queries()["op12_hard_negatives"](spark, SF), connect(SF), entry.oracle_sql()["op12_hard_negatives"]) is None


# --- conversation repair -------------------------------------------------------------------------------------------

AFTER = {"": "u", "s": "u", "a": "u", "u": "a"}
ROLE = {"u": "user", "a": "assistant"}


def repaired_by_hand(turns: list[tuple]) -> tuple:
    """Cheapest first, then least audit: the first finished way is the one."""
    seen, kinds, counts, illegal = set(), [], [0, 0, 0], 0
    for k, (_, role, text) in enumerate(turns):
        body = re.sub("[\x20\x09-\x0d]", "", text)
        fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        kinds.append((role[:1], fault))
        illegal += bool(k) and turns[k - 1][1][:1] + role[:1] not in ("su", "ua", "au")
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, at, state, out = heapq.heappop(heap)
        if at == len(turns) and state in ("", "a"):
            break
        if (at, state) in done:
            continue
        done.add((at, state))
        to = AFTER[state]
        heapq.heappush(heap, (cost + 3, audit + "I", at, to, (*out, (ROLE[to], ""))))
        if at < len(turns):
            initial, fault = kinds[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, state, out))
            if fault not in (0, 1):
                more = 3 if fault == 2 else 0
                heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, to, (*out, (ROLE[to], turns[at][2]))))
                if initial and state + initial in ("s", "u", "su", "au", "ua"):
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, initial, (*out, turns[at][1:])))
    named = [t[0] for t in turns if t[0] is not None]
    gaps = max(named) - min(named) + 1 - len(set(named)) if named else 0
    joined = "\n".join(f"{r}:{t}" for r, t in out)
    return gaps, *counts, illegal, cost, audit, hashlib.sha256(joined.encode()).hexdigest()


def damaged_by_hand(rows: list[tuple]) -> dict:
    chats = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        chats[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return {c: sorted(t, key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).hexdigest())) for c, t in chats.items()}


def test_repairs_equal_a_search_of_all_ways(spark):
    rng = random.Random(13)
    roles = ["user", "assistant", "system", "assistant", "user", "tool", "", "usher", None, "\U0001f600"]
    said = ["Yes.", "No!", "Why?", "cut short", "cut. \n", "", " \t\n", "Again.", None, " ", "end. "]
    rows = [
        (conv, rng.choice([None, *range(8)]) if conv % 5 == 0 else turn, rng.choice(roles[: 3 if conv % 2 else 10]), rng.choice(said[: 4 if conv % 3 else 11]))
        for conv in range(300) for turn in range(rng.randrange(1, 14))
    ]
    rows += [(None, 3, "user", "Hello."), (None, None, "assistant", "Hello."), (7000, None, None, None), (7001, -5, "user", "a." * 50_000), (7001, 2**40, "assistant", "b.")]
    rows += [(-9, 2, "user", "Same.")] * 40
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"audit": F.lit(1), "_conv": F.lit("x")})
    got = repair.repaired_digests(repair.damaged(repair.chat_rows(chats))).collect()
    want = {c: (c, *repaired_by_hand(t)) for c, t in damaged_by_hand(rows).items()}
    assert len(got) == len(want)
    for row in got:
        assert tuple(row) == want[row.conv_id]


def test_long_conversations_meet_in_the_middle():
    rng = random.Random(2)
    for n in (1, 2, 3, 65, 100, 257, 1500):
        for weights in ((8, 1, 1), (1, 1, 1)):
            turns = [(k, rng.choice(["user", "assistant", "system", "tool"]), f"{k}" + rng.choices([".", ", and", " "], weights)[0]) for k in range(n)]
            turns = [(k, r, t if rng.random() > 0.2 else "") for k, r, t in turns]
            kinds = bytes(repair.kind_of(r[:1], t.strip()[-1:] != ".", not t) for _, r, t in turns)
            want = repaired_by_hand(turns)
            assert repair.repair(kinds) == (want[5], want[6])


def test_many_turns_are_repaired_in_linear_space():
    kinds = bytes(random.Random(4).choices(range(16), k=200_000))
    cost, audit = repair.repair(kinds)
    assert cost > 0 and len(audit) - audit.count("I") == len(kinds)


def test_repaired_turns_are_well_formed(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "More."), (1, 2, "user", "Bye"), (2, 0, "user", ""), (3, 0, "system", "Be kind."), (3, 1, "user", "Now?")]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = repair.repaired_turns(repair.chat_rows(chats)).collect()
    by_conv = defaultdict(list)
    for t in sorted(turns, key=lambda t: (t.conv_id, t.place)):
        by_conv[t.conv_id].append((t.role, t.text, t.edit))
    assert by_conv == {
        1: [("user", "Hi.", "R"), ("assistant", "More.", "K")],  # dearer: an insert before each, the last turn deleted
        3: [("system", "Be kind.", "K"), ("user", "Now?", "K"), ("assistant", "", "I")],
    }


def test_no_conversations(spark):
    chats = repair.chat_rows(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert repair.repaired_digests(chats).collect() == [] and repair.repaired_turns(chats).collect() == []


def test_registered_queries_run(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    want = {c: (c, *repaired_by_hand(t)) for c, t in damaged_by_hand([tuple(r) for r in rows]).items()}
    got = entry.queries()["op13_conversation_repair"](spark, SF).collect()
    assert len(got) == len(want) and all(tuple(r) == want[r.conv_id] for r in got)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = entry.queries()["op11_jaccard_join"](spark, SF).collect()
    assert sorted(map(tuple, found), key=str) == classes_by_hand([tuple(r) for r in docs])
