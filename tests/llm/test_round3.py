"""Hard inputs of the text operators, and language identification by hand."""

from __future__ import annotations

import math
import time
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from strataflow.llm import bpe, exact_dedup, html_text, language, pii, url_rules
from strataflow.llm.words import mix

SF = "/root/testdata/sf0.001"

PAGES = {
    # declarations and comments that are none
    "<article>a<![foo[x]]>b</article>": "ab",
    "<article>a<![ x b</article>": "a",
    "<article><p>a<!x y><?php z?></ 1>b</article>": "ab",
    "<article><p>one</p><!-- two<p>three</p></article>": "one\nthree",
    "<article><p>one<!-->two<!--->three<!-- four --> five</article>": "onetwothree five",
    "<article><p>one</p><!-- four": "one",
    # names of headings, paragraphs and words say nothing
    "<article><h2 id=related-work>Related work</h2><p>x</p></article>": "Related work\nx",
    "<article><h2 id=search>S</h2><p id=notices>N <b class=menu>m</b></p></article>": "S\nN m",
    "<article><p class='ad-hoc'>Ad hoc</p></article>": "Ad hoc",
    # inside an article a whole name or a clear word counts
    "<article><section id=social-impact><p>Social</p></section><div class='share-price'>Price</div></article>": "Social\nPrice",
    "<article><p>a</p><div class=ad>Buy</div><div class='post-comments'><p>me</p></div><ul class=share><li>s</ul></article>": "a",
    "<article><p>a</p><div class='newsletter-box x'>Join</div><div class='related'>r</div></article>": "a",
    # mathematics is text
    "<article><p>Let <math><mi>x</mi><annotation>\\x</annotation></math> be.</p></article>": "Let x be.",
    # odd tags
    "<article><p>1 < 2 and 3 > 2 <3 &lt;b&gt; &amp;amp;</p></article>": "1 < 2 and 3 > 2 <3 <b> &amp;",
    "<article><p>a <b title='x>y'>bold</b> <i title=\"un>closed</i> c</p></article>": "a bold closed c",
    "<article><p>a<b a='1' a=2 / = >b</b ></P  x>c</article>": "ab\nc",
    "<ARTICLE><SCRIPT>if (a<b) '</p>'</SCRIPT><p>t</ARTICLE>": "t",
    "<article><p>a</p><b><div>x</b></div>y</b></article>": "a\nx\ny",
}


@pytest.mark.parametrize("page", PAGES)
def test_hard_pages(page):
    assert html_text.main_text(page) == PAGES[page]


@pytest.mark.parametrize("page", [
    "<div>x" * 20_000, "<a " * 20_000, "<b>" + "<div>x</b>" * 20_000, "<div class=sidebar>x" * 20_000, '<a x=">" ' * 20_000,
    "<div class=has-sidebar>" * 8_000 + "<article>y</article>" * 8_000, "</x>" * 20_000, "<!--" * 20_000, "<![ " * 20_000, '"<a b="' * 20_000,
])
def test_pages_of_any_shape_take_linear_time(page):
    start = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - start < 10  # was minutes


def test_extract_on_clashing_names_and_hard_pages(spark):
    rows = [(k, page, "own") for k, page in enumerate(PAGES)] + [(None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, Text string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got == {k: PAGES[p] if p else "" for k, p, _ in rows}


def test_rules_on_clashing_names(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "h", "r")], "page_id long, url string, Host string, rule string").withColumn("_url", F.lit(7))
    got = url_rules.judge_urls(pages, url_rules.rule_table(spark)).collect()
    assert [(r.host, r.path, r.rule, r.verdict, r._url) for r in got] == [("a.org", "/x", "org/", "allow", 7)]


def test_smallest_id_is_no_overflow(spark):
    docs = spark.createDataFrame([(-(2**63), "a b"), (2**63 - 1, "ab"), (None, "a  b"), (-(2**63), "x")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs).collect()), key=str)
    low = -(2**63)
    assert got == sorted([(low, None, 3, False), (2**63 - 1, None, 3, False), (None, None, 3, True), (low, low, 1, True)], key=str)


def test_added_spans_never_overlap_base_ones():
    text = "_".join(["1.2.3.4"] * 5) + "_078-05-1120@b.co ssn"
    spans = pii.find_spans(text)
    base = [s for s in spans if s.kind in pii.BASE]
    assert not any(s.start < b.end and b.start < s.end for s in spans if s.kind not in pii.BASE for b in base)


# --- BPE -----------------------------------------------------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_every_character_is_encoded_as_by_the_library(library):
    encoder = bpe.Encoder(bpe.load(PATH))
    shown = [f"a{chr(c)}b {chr(c)}{chr(c)} 1" for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(shown[k : k + 64]) for k in range(0, len(shown), 64)]
    for k in range(0, len(texts), 200):
        part = texts[k : k + 200]
        for text, (ids, shown), want in zip(part, encoder.encode_both(part), library.encode_batch(part, add_special_tokens=False)):
            assert np.frombuffer(ids, "<u4").tolist() == want.ids, text
            assert shown.decode() == library.decode(want.ids, skip_special_tokens=False)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PAIRS", 40)
    encoder = bpe.Encoder(bpe.load(PATH), max_letters=60)
    texts = ["the quick brown foxes jumped over lazier dogs", "dogs and foxes <|startoftext|> again the quick", "", "unbelievable"] * 5
    for text in texts:
        ((ids, shown),) = encoder.encode_both([text])
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want and shown.decode() == library.decode(want, skip_special_tokens=False)
    assert len(encoder.known.young) + len(encoder.known.old) < 40


def test_encoding_on_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, IDS long, shown string")
    got = bpe.encode_documents(docs, PATH, decoded="shown").first()
    assert got.shown == "a</w> b</w>" and len(got.ids) == 2


# --- language ------------------------------------------------------------------------------------------------------


def gains_by_hand(model, text: str) -> tuple[np.ndarray, int]:
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    shown = [b if 97 <= b <= 122 or b >= 128 else 32 for b in data]
    total, letters = np.zeros(len(model.languages)), 0
    for k, b in enumerate(shown):
        if b != 32 and len(data) >= 2:
            around = shown[k - 1] if k else 32, b, shown[k + 1] if k + 1 < len(shown) else 32
            code = np.array([around[0] << 16 | around[1] << 8 | around[2]], np.uint64)
            total += model.gain[:, int(mix(code)[0]) & (language.BUCKETS - 1)]
            letters += 1
    return total, letters


def soft(scores):
    raised = np.exp(np.array(scores) - max(scores))
    return raised / raised.sum()


def identified_by_hand(model, rows):
    """rows: (text, declared, host, suffix) -> (best, posterior, letters, accepted)."""
    n = len(model.languages)
    scored = [gains_by_hand(model, text or "") for text, *_ in rows]
    temper = [g * language.TRUST / max(language.TRUST, k) for g, k in scored]
    votes = [np.round(soft(t) * 1e6) / 1e6 if k else np.zeros(n) for t, (_, k) in zip(temper, scored)]
    parent = lambda h: ".".join(h.split(".")[-2:]) if "." in h else ""
    whole = sum(votes) + language.HALF
    table = whole / whole.sum()
    by_host, by_parent = defaultdict(lambda: np.zeros(n)), defaultdict(lambda: np.zeros(n))
    told = [defaultdict(lambda: np.zeros(n)), defaultdict(lambda: np.zeros(n))]
    seen = set()
    for (_, declared, host, suffix), vote, (_, letters) in zip(rows, votes, scored):
        if not letters:
            continue
        by_host[host or ""] += vote
        by_parent[parent(host or "")] += vote
        seen.add(host or "")
        for side, value in zip(told, (declared, suffix)):
            if value is not None:
                side[value if value in model.languages else "?"] += vote
    out = []
    for (_, declared, host, suffix), t, (gains, letters) in zip(rows, temper, scored):
        host = host or ""
        prior = np.log(table)
        if host and host in seen:
            lean, p = language.LEAN, parent(host)
            middle = (by_parent[p] + lean * table) / (by_parent[p].sum() + lean) if p else table
            prior = np.log((by_host[host] + lean * middle) / (by_host[host].sum() + lean))
        total = t + prior
        for side, value in zip(told, (declared, suffix)):
            if value in model.languages and value in side:
                total = total + np.log((side[value] + language.HALF) / (sum(side.values()) + language.HALF * (n + 1)))
        posterior = soft(total)
        reads = letters < language.LONG or gains.max() > letters * language.FLOOR
        out.append((model.languages[int(posterior.argmax())], posterior.max(), letters, letters > 0 and reads and posterior.max() >= language.SURE))
    return out


@pytest.mark.parametrize("keep_text", [True, False])
def test_posteriors_equal_the_fusion_by_hand(spark, keep_text):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    model = language.fit(docs)
    assert len(model.languages) >= 3
    pages = docs.withColumns({
        "host": F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("w"), F.col("doc_id") % 4, F.lit(".site.de")))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("h"), F.col("doc_id") % 5, F.lit(".org"))).otherwise(F.col("source")),
        "lang": F.when(F.col("doc_id") % 5 == 0, "xx").when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("lang")),
        "text": F.when(F.col("doc_id") % 11 == 0, F.substring("text", 1, 12)).when(F.col("doc_id") % 13 == 0, "12 ?").otherwise(F.col("text")),
        "language": F.lit("gives way"),
    })
    pages = pages.withColumn("suffix", language.suffix_of(F.col("host")))
    rows = [tuple(r) for r in pages.select("doc_id", "text", "lang", "host", "suffix").collect()]
    want = dict(zip((r[0] for r in rows), identified_by_hand(model, [r[1:] for r in rows])))
    got = language.identify(pages, model, declared="lang", host="host", suffix="suffix", keep_text=keep_text).collect()
    assert len(got) == len(want)
    for row in got:
        best, posterior, letters, accepted = want[row.doc_id]
        assert math.isclose(row.language.posterior, posterior, rel_tol=1e-6), row.doc_id
        assert row.language.letters == letters
        if letters:
            assert (row.language.best, row.language.accepted) == (best, bool(accepted))


def test_a_dirty_label_column_is_bounded(spark):
    rows = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("the house and the garden "), F.col("id")).alias("text"),
        F.when(F.col("id") % 3 == 0, "en").otherwise(F.concat(F.lit("x"), F.col("id") % 10_000)).alias("lang"),
    )
    model = language.fit(rows)
    assert model.languages == ["en"]
    assert language.identify(rows, model, declared="lang", keep_text=False).where("language.best = 'en'").count() == 30_000


@pytest.mark.parametrize("name", [q for q in entry.queries() if q.startswith("op") and q[2].isdigit()])
def test_every_registered_operator_runs(spark, name):
    """Over whole tables: a row for each document, page, conversation or its own result."""
    rows = entry.queries()[name](spark, SF).collect()
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    pages = spark.read.parquet(f"{SF}/pages.parquet").count()
    chats = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
    many = {"op1": chats + 1, "op6": pages, "op7": documents + pages, "op10": pages, "op12": len(rows), "op13": chats}
    assert len(rows) == many.get(name.split("_")[0], documents) > 0
