"""Exact and near deduplication, URL rules, decontamination: against brute force and on odd rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from strataflow.llm import decontaminate, exact_dedup, near_dedup, url_rules
from strataflow.llm.queries import op2_exact_dedup, op5_decontamination, op6_url_rules, oracles
from tests.conftest import MEDIUM, SMALL
from verification.compare import connect, differences

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string"


@pytest.mark.parametrize("query", [op2_exact_dedup, op5_decontamination, op6_url_rules], ids=lambda q: q.__name__)
def test_query_equals_sql(spark, query):
    assert differences(query(spark, SMALL), connect(SMALL), oracles()[query.__name__]) is None


# -- exact -----------------------------------------------------------------------------------------


def exact_by_hand(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    keep = {k: min(v, key=lambda x: x[:3])[3] for k, v in groups.items()}
    out = []
    for i, t in rows:
        k = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        out.append((i, keep[k], len(groups[k]), hashlib.sha256(k.encode()).hexdigest()))
    return sorted(out, key=str)


ODD = [
    (1, None), (2, ""), (3, " \n"), (4, "ab c"), (5, "abc"), (6, "a b c"), (6, "a b c"), (None, "abc"),
    (8, "é" * 5000), (9, "é" * 2500 + " " + "é" * 2500), (10, "é" * 4999), (11, "x" * 40_000), (12, "x" * 40_000 + "\t"),
    (13, "y" + "x" * 39_999), (14, "x" * 39_999 + "y"),
]


@pytest.mark.parametrize("bits", [64, 2])
def test_names_tell_texts_apart(spark, bits):
    """With two bits every fingerprint is shared by many blocks, so the texts themselves must decide."""
    rng = random.Random(3)
    rows = ODD + [(100 + k, "".join(rng.choice("ab ") for _ in range(rng.randint(0, 7)))) for k in range(60)]
    named = exact_dedup.document_names(spark.createDataFrame(rows, DOCS), block=4 if bits == 2 else 1024, bits=bits)
    by_name = {}
    for r in named.collect():
        by_name.setdefault((r["level"], r["name"]), set()).add(r["text_sha256"])
    assert all(len(v) == 1 for v in by_name.values())
    assert len(by_name) == len({re.sub(r"\s", "", t or "") for _, t in rows})


def test_exact_groups_on_odd_rows(spark):
    rows = exact_dedup.exact_groups(spark.createDataFrame(ODD, DOCS)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str) == exact_by_hand(ODD)
    kept = [r for r in rows if r.kept]
    assert len(kept) == len({r.text_sha256 for r in rows}) and all(r.doc_id == r.keep_id for r in kept)


def test_drop_copies_keeps_columns_and_one_of_repeated_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS).withColumn("_digest", F.lit(1)).withColumn("LEVEL", F.lit("x"))
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [3, 6, 9, 10, 12, 13, 14]


def test_drop_copies_keeps_the_longest_of_rows_that_share_an_id(spark):
    rows = [(1, "a b"), (1, "a  b "), (1, "ab"), (2, "a   b   "), (2, "ab"), (3, "x"), (3, " x "), (3, "x  "), (4, None), (4, "")]
    for order in (rows, rows[::-1]):
        out = [(r.doc_id, r.text) for r in exact_dedup.drop_copies(spark.createDataFrame(order, DOCS).repartition(3)).collect()]
        assert (2, "a   b   ") in out and len(out) == 3
        assert {len(t) for i, t in out if i == 3} == {3}


@pytest.mark.parametrize("run", [exact_dedup.exact_groups, near_dedup.near_groups, exact_dedup.drop_copies, near_dedup.drop_near_copies])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], DOCS)).collect() == []


def test_exact_dedup_runs_no_python(spark):
    plan = op2_exact_dedup(spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- near ------------------------------------------------------------------------------------------


def near_by_hand(rows, n, percent=80):
    sets, parent = [], list(range(len(rows)))
    for _, t in rows:
        w = [x for x in re.split("[\x20\x09-\x0D]+", (t or "").translate(LOWER)) if x]
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(k)] = min(ids.get(find(k), i), i)
    return sorted(((i, len(sets[k]), ids.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def near_rows():
    rng = random.Random(11)
    words = [f"w{k}" for k in range(3000)]
    rows, i = [], 0
    for length in (4, 12, 60, 200):
        for _ in range(12):
            base = [rng.choice(words) for _ in range(length)]
            for _ in range(rng.randint(1, 6)):
                text = [rng.choice(words) if rng.random() < rng.choice([0, 0.01, 0.02, 0.05]) else w for w in base]
                rows.append((i, rng.choice([" ", "\n", "  "]).join(text)))
                i += 1
    return rows + [(900, None), (901, ""), (902, " \t"), (903, "One two"), (904, "one\nTWO"), (905, "two one"), (None, "one two"), (3, rows[3][1])]


@pytest.mark.parametrize("shingle", [4, 5])
def test_near_groups_equal_brute_force(spark, shingle):
    rows = near_rows()
    got = near_dedup.near_groups(spark.createDataFrame(rows, DOCS), shingle=shingle).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == near_by_hand(rows, shingle)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_a_hot_group_of_near_copies(spark):
    """Many variants of one text: linked through centres, never all pairs."""
    rng = random.Random(5)
    base = [f"v{k}" for k in range(150)]
    rows = [(k, " ".join(w if rng.random() > 0.015 else f"u{rng.randint(0, 99)}" for w in base)) for k in range(120)]
    got = near_dedup.near_groups(spark.createDataFrame(rows, DOCS), shingle=4).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == near_by_hand(rows, 4)


def test_crowded_keys_lose_no_link(spark, monkeypatch):
    """Many versions of one text, most of them similar at less than the bound: all links, though few are compared."""
    monkeypatch.setattr(near_dedup, "CROWDED", 3)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randint(3, 7)):  # the changes come from few places and words, so some are shared
            words[rng.randrange(0, 150, 10)] = f"x{rng.randint(0, 2)}"
        rows.append((i, " ".join(words[: 150 - rng.choice([0, 0, 20])])))
    got = near_dedup.near_groups(spark.createDataFrame(rows, DOCS), shingle=4).collect()
    want = near_by_hand(rows, 4)
    assert 10 < len({c for _, _, c in want}) < 110
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want


def test_a_group_does_not_meet_itself_under_a_shingle(spark):
    """100 near copies and one outsider share a rare shingle: about as many rows meet, not their square."""
    rows = [(5, k, 100, 0 if k < 100 else 100, 1) for k in range(101)] + [(6, k, 100, 0, 2) for k in range(100)]
    first = spark.createDataFrame(rows, "shingle long, node long, n long, root long, place long")
    met = [a.join(b, "shingle").select("node", "other", "root", "r") for a, b in near_dedup._sides(near_dedup._with_main(first), 80)]
    got = [tuple(r) for part in met for r in part.collect()]
    assert len(got) <= 201 and len(got) == len(set(got))
    assert {(a, b) for a, b, x, y in got if x != y} == {p for k in range(100) for p in ((k, 100), (100, k))}


def test_drop_near_copies_leaves_one_row_of_each_group(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumn("node", F.lit(1)).withColumn("_print", F.lit(2))
    out = near_dedup.drop_near_copies(docs)
    assert out.columns == docs.columns
    want = {c if n else i for i, n, c in near_by_hand(rows, 5)} - {None}
    got = [r.doc_id for r in out.collect()]
    assert sorted(got) == sorted(want)


def test_drop_near_copies_keeps_texts_that_share_an_id_or_have_none(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(40)) for _ in range(8)]
    rows = [(None, t) for t in texts[:4]] + [(7, t) for t in texts[3:7]] + [(7, texts[6] + " z"), (9, texts[7]), (None, texts[7] + " z")]
    rows += [(None, texts[0] + " z"), (8, texts[3] + " z"), (None, None), (7, ""), (7, texts[5])]
    out = [(r.doc_id, r.text) for r in near_dedup.drop_near_copies(spark.createDataFrame(rows, DOCS)).collect()]
    assert len(out) == len(set(out)) and {(None, None), (7, "")} <= set(out)
    left = [(i, t.removesuffix(" z")) for i, t in out if t]
    want = [(None, t) for t in texts[:3]] + [(7, t) for t in texts[3:7]] + [(9, texts[7])]
    assert sorted(left, key=str) == sorted(want, key=str)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    got = {r.node: r.root for r in near_dedup.components(links).collect()}
    assert {got[k] for k in range(1, 41)} == {0} and got[101] == 100


# -- URL rules -------------------------------------------------------------------------------------

URLS = [
    "http://Example.ORG/es/x", "https://a.b.example.org/en/12?q#f", "http://example.org/en/2", "http://notexample.org/es/",
    "http://x.com/fr/", "http://x.com/fr", "http://x.com/de/a#b", "ftp://com/de/", "no scheme", "", None, "http://", "http://org",
    "http://org/", "a://b://c.org/p", "http://x.org:80/es/", "http://" + "a." * 3000 + "example.org/es/" + "p" * 5000, "http://x.com/fr/",
]


def test_urls_against_plain_rules(spark):
    rows = list(enumerate(URLS))
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("labels", F.lit(0))
    got = url_rules.judge_urls(pages, url_rules.rule_table(spark)).collect()
    assert len(got) == len(rows)
    for r in got:
        url = r.url or ""
        host, path = "", ""
        if "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match("[^/?#]*", rest)[0]
            path = re.match("[^?#]*", rest[len(host) :])[0]
            host = host.translate(LOWER)
        fits = [(h + p, v) for h, p, v in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict), url


def test_short_digest_prefixes_are_confirmed(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    rules = url_rules.rule_table(spark)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(url_rules.judge_urls(pages, rules, prefix=1)) == key(url_rules.judge_urls(pages, rules))
    assert {r.verdict for r in url_rules.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


# -- decontamination -------------------------------------------------------------------------------


def test_both_ways_agree_and_odd_rows_are_whole(spark):
    items = [(1, "One two three"), (2, None), (3, "..."), (4, " ".join(f"t{k}" for k in range(20))), (1, "one TWO three"), (None, "zwölf")]
    docs = [
        (1, "x one, two; three y"), (1, "x one, two; three y"), (2, None), (3, ""), (4, "!!"), (None, "Zwölf"),
        (6, " ".join(f"t{k}" for k in range(3, 16)) + " a" * 400), (7, " ".join(f"T{k}" for k in range(12))), (8, "one two threé"),
    ]
    documents = spark.createDataFrame(docs, DOCS).withColumn("found", F.lit(0)).withColumn("_found", F.lit(1))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    name = decontaminate.found_column(documents)
    ways = [decontaminate.find_contamination(documents, benchmark, broadcast_bytes=b) for b in (1 << 20, 0)]
    one, two = (sorted(map(str, w.select("doc_id", "text", f"{name}.*").collect())) for w in ways)
    assert one == two and len(one) == len(docs)
    found = {r.doc_id: r[name] for r in ways[0].collect()}
    assert (found[1]["n_hit"], found[1]["items"], found[1]["contaminated"]) == (3, ["1"], True)
    assert (found[6]["n_words"], found[6]["n_hit"], found[6]["contaminated"]) == (413, 13, False)
    assert found[None]["items"] == [""] and found[7]["n_hit"] == 0 and found[8]["n_hit"] == 0
    clean = decontaminate.remove_contaminated(documents, benchmark)
    assert clean.columns == documents.columns and sorted(r.doc_id for r in clean.collect()) == [2, 3, 4, 6, 7, 8]


def test_cut_spans(spark):
    assert decontaminate.cut_spans("Ä one, Two three!", [("1", 3, "one two three")]) == "Ä ,  !"
    assert decontaminate.cut_spans(None, []) is None


def test_medium_decontamination_by_join(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").where("doc_id < 300")
    items = spark.read.parquet(f"{MEDIUM}/benchmark.parquet")
    name = decontaminate.found_column(docs)
    ways = [decontaminate.find_contamination(docs, items, broadcast_bytes=b) for b in (1 << 30, 0)]
    one, two = (sorted(map(str, w.select("doc_id", f"{name}.*").collect())) for w in ways)
    assert one == two
