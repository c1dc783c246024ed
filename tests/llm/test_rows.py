"""Mixing, chat formatting, HTML, WARC, language ID and quality on small tables."""

import gzip
import io
import zipfile

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldload.llm import chat, langid, mixing, quality, site_style, warc
from fieldload.llm.queries import HOSTILE, op4_chat_format, op6_html_text, op8_language_id

SF = "/root/testdata/sf0.001"
MIX = "doc_id long, text string, source string, size string, target int"


def mixed(spark, rows, **options):
    return mixing.mix(spark.createDataFrame([(*r, "x", 0) for r in rows], MIX), **options).collect()


def test_mix_meets_targets_without_excess(spark):
    rows = [(i, "w " * (i % 90), f"s{i % 5}") for i in range(600)] + [(None, "a b", None), (7, None, "s1"), (7, "", "s1"), (8, "x " * 4000, "s2")]
    rows += [(9, "only one small source", "t")]
    got = mixed(spark, rows, block_tokens=16, unit_tokens=16, shard_tokens=2000)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert r["size"] * 3 >= r["taken"] >= 0
        t = by.setdefault(r["source"], [r["target"], 0, r["source_size"], r["quota"]])
        t[1] += r["taken"]
    for target, taken, size, quota in by.values():
        assert target <= 3 * size and abs(taken - target) <= 16 + 1e-6 and (taken == quota * 16 or taken == 3 * size)
    assert sum(t[0] for t in by.values()) == pytest.approx(sum(r["size"] for r in got))
    assert sorted(map(str, got)) == sorted(map(str, mixed(spark, rows, block_tokens=16, unit_tokens=16, shard_tokens=2000)))


def test_mix_small_sources_are_capped(spark):
    got = mixed(spark, [(1, "a " * 10, "a"), (2, "b " * 1000, "b"), (3, "c " * 2000, "c")], block_tokens=1)
    assert {r["source"]: r["taken"] for r in got} == {"a": 30, "b": 1192, "c": 1788}


def test_mix_small_sources_meet_their_targets(spark):
    """Sources far below a block, beside one of 100,000 words."""
    words = {"a": 20, "b": 40, "c": 30, "d": 55, "e": 100_000, "f": 1}
    rows = [(i * 100 + j, "w " * (n // 4 if j < 3 else n - 3 * (n // 4)), s) for i, (s, n) in enumerate(words.items()) for j in range(4)]
    got = mixed(spark, rows)
    for s in words:
        target = next(r["target"] for r in got if r["source"] == s)
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - target) < 1
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    assert {r["source"]: r["target"] for r in got if r["source"] in "abcd"} == {"a": 60, "b": 120, "c": 90, "d": 165}


def test_mix_of_nothing(spark):
    assert mixed(spark, []) == []
    assert [r["taken"] for r in mixed(spark, [(1, None, "a"), (2, "", None)])] == [0, 0]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=8), st.integers(0, 60))
def test_sainte_lague_takes_highest_quotients(spark, votes, seats):
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate(votes)], "g int, k int, v long").withColumn("seats", F.lit(seats))
    got = {r["k"]: r["quota"] for r in mixing.sainte_lague(df, ["g"], "k", "v", "seats").collect()}
    ranked = sorted(((-v / (2 * s + 1), k) for k, v in enumerate(votes) if v for s in range(seats)))[:seats]
    assert got == {k: sum(1 for _, x in ranked if x == k) for k in range(len(votes))}


# ------------------------------------------------------------ chat

TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb", "<|x", ""]), st.text(alphabet="a\\<|>n\nim_end é😀", max_size=30)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(TURNS)
def test_format_round_trip(turns):
    made, spans = chat.format_turns(turns, "assistant")
    assert chat.read_turns(made) == turns
    assert [chat.unescape(made[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_reply_tree_branches(spark):
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "good", 3.0), ("t", 3, 1, "assistant", "bad", 1.0),
            ("t", 4, 2, "user", "more", 1.0), ("t", 5, 99, "user", "orphan", None), ("u", 1, 7, None, None, 1.0)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    got = {(r["tree"], r["leaf"]): r for r in chat.format_trees(df).collect()}
    assert set(got) == {("t", 4), ("t", 3), ("t", 5), ("u", 1)}
    assert [t for _, t in chat.read_turns(got["t", 4]["formatted"])] == ["q", "good", "more"]
    assert chat.read_turns(got["u", 1]["formatted"]) == [("", "")]
    assert [got["t", x]["branch"] for x in (4, 3, 5)] == [1, 2, 3]
    best = chat.format_trees(df, per_tree=1).collect()
    assert {(r["tree"], r["leaf"]) for r in best} == {("t", 4), ("u", 1)}


def test_repeated_messages_count_once(spark):
    rows = [("t", 1, None, "user", "hi", 1.0), ("t", 2, 1, "assistant", "yo", 1.0), ("t", 2, 1, "assistant", "yo", 1.0), ("t", 2, 1, "assistant", "zo", 1.0)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    got = chat.format_trees(df).collect()
    assert [chat.read_turns(r["formatted"]) for r in got] == [[("user", "hi"), ("assistant", "yo")]]


def test_long_chain_and_cycle(spark):
    schema = "tree string, node long, parent long, role string, text string, score double"
    chain = spark.createDataFrame([("t", i, i - 1, "user", str(i), 1.0) for i in range(1, 71)], schema)
    (row,) = chat.format_trees(chain).collect()
    assert [t for _, t in chat.read_turns(row["formatted"])] == [str(i) for i in range(1, 71)]
    with pytest.raises(ValueError, match="cycle"):
        chat.paths(spark.createDataFrame([("t", 1, 2, "u", "x", 1.0), ("t", 2, 1, "u", "x", 1.0)], schema))
    assert chat.format_trees(spark.createDataFrame([], schema)).count() == 0


def test_conversation_rows_with_ties_and_nulls(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "assistant", "last"), (1, 1, None, None), (None, 0, "user", "n"),
            (1, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["tree"]: chat.read_turns(r["formatted"]) for r in chat.format_trees(chat.conversation_messages(df)).collect()}
    assert got == {"null": [("user", "n")], "1": [("user", "a"), ("user", "a"), ("user", "b"), ("", ""), ("assistant", "last")]}


def test_hostile_conversation(spark):
    (row,) = op4_chat_format(spark, SF).where("conv_id = -1").collect()
    assert (row["n_turns"], row["loss_chars"]) == (2, len(HOSTILE))


# ------------------------------------------------------------ html

PAGE = """<html><head><title>T &amp; x</title><style>p{}</style></head><body class="promo-page2"><header><h1>Site</h1></header>
<nav>menu</nav><div class="ad">buy <p>now</p></div><div role="search">find</div>{extra}<main><article><header><h1>Head &lt;b&gt;</h1></header>
<p>One <b>two</b>three<br>four &eacute;&nbsp;&#33;<p><i>five</p><!-- gone --><script>if (a < b) "</p>"</script><ul><li>x<li>y</ul>
<aside>side</aside><form>f<input></form><div id="comments"><p>first!</p></div><p></p> a < b &unknown;</article></main>
<div>tail</div><footer>&copy; f</footer>"""
ARTICLE = "Head <b> One twothree four é ! five x y a < b &unknown;"


def test_article_text(spark):
    rows = [(1, "http://a.com/1", PAGE.replace("{extra}", "")), (2, None, PAGE.replace("{extra}", "<section>notice</section>")), (3, "x", None),
            (4, "http://a.com/2", ""), (1, "http://a.com/1", PAGE.replace("{extra}", "")), (None, "http://a.com/3", "<p>unclosed <b")]
    df = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(((r["page_id"], r["text"]) for r in site_style.extract_text(df).collect()), key=str)
    assert got == sorted([(1, ARTICLE), (2, ARTICLE), (3, ""), (4, ""), (1, ARTICLE), (None, "unclosed <b")], key=str)


@pytest.mark.parametrize("bound", [32 << 20, 0])
def test_site_evidence_decides_pages_without_an_article(spark, bound):
    """On pages without an article, a block that all pages of the host repeat goes, on this host only."""
    page = "<body><div class='x'>Welcome to our site</div><div class='y'><p>story {i} of {h}</p></div></body>"
    rows = [(i, f"http://{h}.com/{i}", page.format(i=i, h=h)) for h in ("a", "b") for i in range(8)]
    rows += [(99, "http://c.com/1", page.format(i=99, h="c"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r["page_id"], r["url"][7]): r["text"] for r in site_style.extract_text(df, broadcast_bytes=bound).collect()}
    assert got == {(i, h): f"story {i} of {h}" for h in ("a", "b") for i in range(8)} | {(99, "c"): "Welcome to our site story 99 of c"}


@pytest.mark.parametrize("bound", [32 << 20, 0])
def test_copies_on_pages_without_an_article_stay(spark, bound):
    """Copies count as one page; a text that many pages share does not take others in its place along."""
    page = "<title>{i}</title><body><div class='top'>Our site</div><div class='content'><p>{t}</p><p>{t} more</p></div></body>"
    rows = [(i, f"http://a.com/{i}", page.format(i=i, t="copied" if i % 2 else f"own {i}")) for i in range(60)]
    rows += [(100 + i, "http://b.com/1", page.format(i=0, t="twice")) for i in range(2)]
    # Differing pages that share most of a place: the shared text goes, the others in its place stay.
    rows += [(200 + i, f"http://c.com/{i}", f"<div><p>{'shared' if i % 4 else f'only {i}'}</p><i>x</i></div><h2>head {i}</h2>") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in site_style.extract_text(df, broadcast_bytes=bound).collect()}
    want = {i: "copied copied more" if i % 2 else f"own {i} own {i} more" for i in range(60)}
    want |= {100 + i: "Our site twice twice more" for i in range(2)}
    assert {k: got[k] for k in want} == want
    assert all((f"only {i}" in got[200 + i]) if i % 4 == 0 else "shared" not in got[200 + i] for i in range(40))
    assert all(f"head {i}" in got[200 + i] for i in range(40))


def test_names_alone_take_no_unique_text(spark):
    """A furniture word in a name leaves unique text; what the site repeats under it, exact and composed names go."""
    body = (
        "<h2 id='related-work'>Work {i}</h2><p class='share-price'>Price {i}</p><section id='discussion'><p>Talk {i}</p></section>"
        "<div id='social-impact'><div><p>Impact {i}</p></div></div><table id='cookie-recipes'><tr><td>Dough {i}</td></tr></table>"
        "<h3 id='comments'>On comments {i}</h3><p>pre<span class='share-count'>fix{i}</span>, end</p>"
        "<div class='share-buttons'>Share this</div><div class='ad'>Buy {i}</div><div class='comments'><p>First {i}</p></div>"
    )
    shells = {"a": "<article><h1>T</h1>{x}</article>", "m": "<main>{x}</main>", "n": "<article id='share-report'>{x}</article>", "d": "<div class='content'>{x}</div>"}
    rows = [(i, f"http://{h}.com/{i}", s.replace("{x}", body.format(i=i))) for h, s in shells.items() for i in range(9)]
    rows += [(50, "http://one.com/", shells["a"].replace("{x}", body.format(i=50)))] * 3
    got = {(r["page_id"], r["url"]): r["text"] for r in site_style.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, url, _ in rows:
        want = f"Work {i} Price {i} Talk {i} Impact {i} Dough {i} On comments {i} prefix{i}, end"
        want = "T " + want if url[7:9] == "a." or i == 50 else want
        assert got[i, url] == want, url


ARTICLES = [
    ("<form id='aspnet'><nav>n</nav><article>In a form {i}</article><input></form>", "In a form {i}"),
    ("<form><main class='widget'><p>Main {i}</p></main></form>", "Main {i}"),
    ("<form><aside><article>Card {i}</article></aside></form><main>Own {i}</main>", "Own {i}"),
    ("<article>Own {i}<form><p>Your name {i}</p></form></article>", "Own {i}"),
    ("<article>Own {i}<ol class='comment-list'><li id='comment-{i}' class='comment even'>Nice {i}</li></ol></article>", "Own {i}"),
    ("<article>Own {i}<article class='comment'>Me too {i}</article></article>", "Own {i}"),
    ("<article>Own {i}<div class='cookie-notice'>Cookies {i}</div><div class='share__buttons'>Share {i}</div></article>", "Own {i}"),
    ("<article>Own {i}<div class='notice'>Old browser {i}</div><div id='newsletter-signup'>Mail {i}</div></article>", "Own {i}"),
    ("<article>Own {i}<p hidden>Unseen {i}</p><p style='x:y; DISPLAY : none'>None {i}</p><p data-hidden=1>Seen {i}</p></article>", "Own {i} Seen {i}"),
    ("<article><section id='cookie-notice'>Law {i}</section><p title='class=ad'>Kept {i}</p></article>", "Law {i} Kept {i}"),
    ("<article>Say <code><span class='hljs-comment'>x {i}</span></code></article>", "Say x {i}"),
    ("<article><p title='a > b'>Own {i}</p><p title=it's>Two</p><p>Three</p></article>", "Own {i} Two Three"),
    ("<article><p>Own {i}</p><a href=\"x>Link</a> and more</article>", "Own {i} Link and more"),
]


def test_articles_keep_their_text_and_lose_the_rest(spark):
    """Unique texts throughout, so that no repetition over the host decides."""
    rows = [(i, f"http://h{i}.com/", f"<body>{page.replace('{i}', str(i))}") for i, (page, _) in enumerate(ARTICLES)]
    got = {r["page_id"]: r["text"] for r in site_style.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: text.replace("{i}", str(i)) for i, (_, text) in enumerate(ARTICLES)}


@pytest.mark.parametrize(
    "page",
    ["<a \"" * 1_000_000, "<a b " * 1_000_000, "<a b " * 500_000 + ">", '<a =">" ' * 500_000 + '<b ="', "<" * 4_000_000, "<div>" * 100_000,
     "<x>" * 100_000 + "</p><p>" * 50_000, "<ul>" * 50_000 + "<li><x>" * 50_000, '<p class="' + "a-b " * 1_000_000 + '">'],
    ids=["quotes", "open", "late-end", "closed-quotes", "less-than", "nested", "end-tags", "scopes", "classes"],
)
def test_hostile_pages_take_linear_time(page):
    import time

    start = time.process_time()
    found, _ = site_style._read(page + "<article>end</article>", site_style.new_root())
    assert time.process_time() - start < 30
    assert len(found) <= 300_001


@pytest.mark.parametrize("bound", [32 << 20, 0])
def test_extracted_columns_may_clash(spark, bound):
    body = "<div><p>Own {i}</p><p>Same</p></div>"
    rows = [(i, "http://h.com/", body.replace("{i}", str(i)), i, i, i) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, __0 long, __row long, block long")
    got = site_style.extract_text(df, broadcast_bytes=bound)
    assert got.columns == ["page_id", "url", "__0", "__row", "block", "text"]
    assert sorted((r["page_id"], r["text"]) for r in got.collect()) == [(i, f"Own {i} Same") for i in range(30)]


def test_pages_against_plain_rules(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    want = {}
    for p in pages:
        inner = re.search(r"<article>(.*?)</article>", p["html"], re.DOTALL)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1)>|<br>", inner)]
        want[p["page_id"]] = " ".join(x for x in parts if x)
    got = op6_html_text(spark, SF).collect()
    assert {r["page_id"]: r["text"] for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)
    assert site_style.extract_text(spark.createDataFrame([], "url string, html string")).count() == 0


# ------------------------------------------------------------ warc


@pytest.mark.parametrize("zip64", [False, True])
def test_package_members_and_ranges(zip64, tmp_path):
    records = [gzip.compress(warc.record_bytes(str(i), f"http://x/%0A{i}\n", f"päge {i}".encode(), "D", None)) for i in range(3)]
    at = [sum(map(len, records[:i])) for i in range(3)]
    data = warc.package(records, [{"offset": a, "length": len(r)} for a, r in zip(at, records, strict=True)], zip64=zip64)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and set(z.namelist()) == {warc.ARCHIVE, warc.INDEX}
    path = tmp_path / "a.wacz"
    path.write_bytes(data)
    with path.open("rb") as f:
        def read(offset, n):
            f.seek(offset)
            return f.read(n)

        got = [payload for _, _, payload in warc.read_package(read, len(data))]
    assert got == [f"päge {i}".encode() for i in range(3)]


def test_zip64_directory_is_followed():
    """A directory whose end record is full points to the ZIP64 one."""
    data = warc.package([b"x"], [], zip64=True)
    end = data.rfind(warc.END)
    import struct

    count, size, start = struct.unpack("<H2I", data[end + 10 : end + 20])
    end64 = warc.END64 + struct.pack("<Q2H2I4Q", 44, 45, 45, 0, 0, count, count, size, start)
    locator = warc.LOCATOR64 + struct.pack("<IQI", 0, end, 1)
    full = data[end : end + 8] + struct.pack("<2H2I", 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF) + data[end + 20 :]
    wide = data[:end] + end64 + locator + full
    assert warc.members(warc.ranges_of(wide), len(wide)) == warc.members(warc.ranges_of(data), len(data))
    with pytest.raises(ValueError):
        warc.members(warc.ranges_of(b"no zip"), 6)


def records_of(names):
    return [warc.record_bytes(n, f"http://x/{n}", f"page {n}".encode(), sha_of(f"page {n}"), None) for n in names]


def sha_of(text):
    import base64
    import hashlib

    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def write_foreign(file):
    """Three archive members, one not in the index, one not compressed; CDXJ lines with keys; other members deflated."""
    import json

    packed = {"archive/a.warc.gz": [gzip.compress(x) for x in records_of("ab")], "archive/b.warc.gz": [gzip.compress(x) for x in records_of("cd")],
              "archive/e.warc": records_of("ef")}
    lines = "!meta {}\n" + "".join(
        f"com,x)/{n} 20250101000000 " + json.dumps({"offset": str(sum(map(len, v[:i]))), "length": str(len(x)), "filename": n.partition("/")[2]}) + "\n"
        for n, v in packed.items() if n != "archive/b.warc.gz" for i, x in enumerate(v)
    )
    with zipfile.ZipFile(file, "w", zipfile.ZIP_STORED) as z:
        z.writestr("datapackage.json", "{}" * 99, zipfile.ZIP_DEFLATED)
        z.writestr("indexes/extra.cdxj", lines, zipfile.ZIP_DEFLATED)
        for name, v in packed.items():
            z.writestr(name, b"".join(v))


def test_packages_of_other_writers(spark, tmp_path):
    held = io.BytesIO()
    write_foreign(held)
    df = spark.createDataFrame([("p", held.getvalue())], "path string, content binary")
    want = sorted((x, f"http://x/{x}", f"page {x}".encode()) for x in "abcdef")
    assert sorted((r["id"], r["url"], bytes(r["payload"])) for r in warc.read_records(df).collect()) == want
    # A file beyond 4 GB (sparse), of which only the ranges are read.
    path = tmp_path / "big file.wacz"
    with path.open("wb") as f:
        f.seek(5 << 30)
        write_foreign(f)
    for uri in (str(path), "file:" + str(path).replace(" ", "%20")):
        got = warc.read_files(spark.createDataFrame([(uri,)], "path string"))
        assert sorted((r["id"], r["url"], bytes(r["payload"])) for r in got.collect()) == want
    assert warc.read_files(spark.createDataFrame([], "path string")).count() == 0


def test_uncompressed_member_without_index_is_walked():
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("archive/x.warc", b"".join(records_of("abc")))
    data = held.getvalue()
    assert [p for _, _, p in warc.read_package(warc.ranges_of(data), len(data))] == [b"page a", b"page b", b"page c"]


def test_records_missing_from_the_index_are_read():
    records = [gzip.compress(x) for x in records_of("abcd")]
    data = warc.package(records, [{"offset": len(records[0]), "length": len(records[1])}])
    assert [p for _, _, p in warc.read_package(warc.ranges_of(data), len(data))] == [f"page {x}".encode() for x in "abcd"]


def test_warc_round_trip(spark):
    rows = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, "x\r\ny%41", "é" * 50_000), (4, None, None), (5, "e", ""), (2, "again", "same"),
            (None, "n", "same"), (None, "n", "alone")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, n string")
    got = {(r["id"], r["url"]): r for r in warc.round_trip(df, package_bytes=100).collect()}
    assert set(got) == {(None if a is None else str(a), u) for a, u, _ in rows}
    kind = {k: (r["record_type"], r["refers_to"]) for k, r in got.items()}
    assert kind["1", "http://a/1"] == ("revisit", "2") and kind["2", "http://a/2"] == kind["2", "again"] == ("response", None)
    assert kind["4", None] == ("revisit", "5") and kind[None, "n"] in (("revisit", "2"), ("response", None))
    assert bytes(got["3", "x\r\ny%41"]["payload"]).decode() == "é" * 50_000
    assert got["5", "e"]["payload_bytes"] == 0 and got["1", "http://a/1"]["payload_bytes"] == 4 and got["1", "http://a/1"]["payload"] is None
    assert {r["record_type"] for r in warc.round_trip(df, min_revisit_bytes=5).where("payload_bytes < 5").collect()} == {"response"}
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ------------------------------------------------------------ language and quality


def test_language_held_out_accuracy(spark):
    got = op8_language_id(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.98 and all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_rows(spark):
    rows = [(i, f"the cat number {i} sat on the mat", "en") for i in range(30)] + [(100 + i, f"le chat {i} mange la souris", "fr") for i in range(30)]
    rows += [(200, None, "en"), (201, "", None), (202, "123 !!", "en"), (203, "привет", None), (None, "the cat", "fr"), (1, "the cat", "en"),
             (204, "le chat " * 30_000, None)]
    df = spark.createDataFrame([(*r, 9.0) for r in rows], "doc_id long, text string, lang string, score double")
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in langid.identify(df).collect()}
    assert [got[k, t] for k, t in ((200, None), (201, ""), (202, "123 !!"))] == [("und", 0.0)] * 3
    assert got[204, "le chat " * 30_000][0] == "fr" and got[None, "the cat"][0] == "en" and got[203, "привет"][0] in ("en", "fr")
    assert langid.identify(df.where("false")).count() == 0
    assert {r["lang_pred"] for r in langid.identify(df.where("doc_id = 201 or doc_id = 203")).collect()} == {"und"}


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "source", "lang")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    seen = labels.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 0)
    got = quality.classify(docs, seen).join(labels.join(seen, "doc_id", "left_anti"), "doc_id").select("good", "quality", "probability").collect()
    hits = {q: np.mean([r["good"] == bool(q) for r in got if r["quality"] == q]) for q in (0, 1)}
    assert hits[1] > 0.95 and hits[0] > 0.8, hits


def test_quality_levels_come_from_urls(spark):
    urls = [("good", "http://A.com/x/{i}?q=/z/"), ("junk", "http://a.com/y/{i}"), ("good", "http://b.com/x/{i}#/y/")]
    docs = [(1000 * k + i, f"{w} {w} words", u.format(i=i), "same", "same") for k, (w, u) in enumerate(urls) for i in range(60)]
    df = spark.createDataFrame([*docs, (9000, "good words", None, None, None)], "doc_id long, text string, url string, source string, lang string")
    labels = spark.createDataFrame([(1000 * k + i, int(urls[k][0] == "good")) for k in range(3) for i in range(30)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.classify(df, labels).collect()}
    assert len(got) == len(docs) + 1
    assert [len({got[1000 * k + i]["path_rate"] for i in range(60)}) for k in range(3)] == [1, 1, 1]
    assert got[0]["host_rate"] == got[1000]["host_rate"] < got[2000]["host_rate"] and got[1000]["path_rate"] < got[0]["path_rate"]


def test_quality_shrinks_sparse_sites(spark):
    docs = [(i, "fine words here", "big", "a") for i in range(200)] + [(1000, "fine words here", "small", "a"), (None, None, None, None), (7, "", "big", "b")]
    docs += [(2000 + i, "junk junk junk", "bad", "a") for i in range(200)]
    df = spark.createDataFrame([(*d, 0.0) for d in docs], "doc_id long, text string, source string, lang string, evidence double")
    labels = spark.createDataFrame([(i, 1) for i in range(50)] + [(2000 + i, 0) for i in range(50)] + [(None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    got = quality.classify(df, labels).collect()
    assert len(got) == len(docs)
    rate = {r["doc_id"]: r["path_rate"] for r in got}
    assert rate[2000] < rate[1000] < rate[0] and all(0 <= r["probability"] <= 1 for r in got)
    assert quality.classify(df.where("false"), labels).count() == 0
    assert {round(r["evidence"], 6) for r in quality.classify(df.limit(3), labels.where("false")).collect()} == {0.0}
