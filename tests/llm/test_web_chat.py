import base64
import hashlib
import io
import random
import zlib

import duckdb
import pandas as pd
import pyarrow as pa
import pytest

from weft.llm import chat, html_extract, queries, url_filter, warc

PAGES = "page_id long, url string, html string, text string, rule string"


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame([(i, u, h, "t", "r") for i, u, h in rows], PAGES)


BODY = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body class="home page">
<header><a href="/">Site</a></header><nav><ul><li><a href=x>One</a></li></ul></nav><!-- ad --><div class="ad">Buy</div><div id="cookie-notice">We use <b>cookies</b></div>
<form><p>Search for a long time here</p><input name=q></form><aside class="sidebar"><p>Related long text that is not the article at all, really.</p></aside>
<article><h1>Head &amp; tail</h1><p><b>First  line<br>second.<p>Short.</p><ul><li>One</li><li>Two&nbsp;x</li></ul><div class="promo">Subscribe now</div>
<p>Last &#233; <a href="y">linked words</a> end.</p></article><section class="comments"><p>I disagree with all of this, said a reader at length.</p></section>
<footer>&copy; me <p>All rights</p></footer></body></html>"""


def test_html(pages):
    want = "Head & tail\nFirst line second.\nShort.\nOne\nTwo x\nLast é linked words end."
    rows = [(1, "u", BODY), (2, None, None), (3, "u", ""), (None, "u", "plain < text"), (4, "u", "<article><p>a<p>b"), (4, "u", "<article><p>a<p>b"), (5, "u", "<nav>x</nav>")]
    got = html_extract.extract(pages(rows)).collect()
    assert [(r.page_id, r.text) for r in got] == [(1, want), (2, ""), (3, ""), (None, "plain < text"), (4, "a\nb"), (4, "a\nb"), (5, "")]
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract(pages([])).collect() == []


def test_html_without_article():
    page = "<html><body><div class=menu><p>Menu</p></div><div><p>" + "Body text. " * 20 + "</p><p>More.</p></div><footer>F</footer>"
    assert html_extract.main_text(page) == ("Body text. " * 20).strip() + "\nMore."


LONG = "A sentence of running text that goes on for some time, as they do. " * 3


def test_html_by_length():
    """Pages of unmarked boxes: the windowed lengths decide, and short lines between long ones stay."""
    menu = "".join(f"<div>{w}</div>" for w in ("Home", "News", "Sport", "Shop", "Contact"))
    page = f"<body><div>{menu}</div><div><h2>Title</h2><p>{LONG}</p><p>Why?</p><p>Yes.</p><p>No.</p><p>So.</p><p>{LONG}</p><p>End.</p></div><div>{menu}</div><div>Terms</div></body>"
    assert html_extract.main_text(page).split("\n") == ["Title", LONG.strip(), "Why?", "Yes.", "No.", "So.", LONG.strip(), "End."]
    div = f"<body><div>{menu}</div><div>{LONG}</div><div>Short.</div><div>{LONG}</div><div>{menu}</div></body>"
    assert html_extract.main_text(div).split("\n") == [LONG.strip(), "Short.", LONG.strip()]


def test_html_priors():
    """An article box yields to far longer text outside it, class words to a page that is all in such a box."""
    teaser = f"<body><article><p>Teaser.</p></article><div><p>{LONG}</p><p>{LONG}</p></div></body>"
    assert html_extract.main_text(teaser).count(LONG.strip()) == 2
    boxed = f"<body><nav>Menu</nav><div class='widget'><p>{LONG}</p><p>More.</p></div></body>"
    assert html_extract.main_text(boxed) == LONG.strip() + "\nMore."
    listed = f"<body><article><p>{LONG}</p><ul>" + "<li>x</li>" * 9 + f"</ul></article><div>{LONG}</div></body>"
    assert html_extract.main_text(listed).split("\n") == [LONG.strip(), *"x" * 9]


def test_html_misleading_classes():
    """Class words that only look like boilerplate keep nothing out where the text is theirs."""
    story = f"<body><div class='top-menu'><p>Home</p></div><div class='share-story content'><p>{LONG}</p><p>{LONG}</p></div><div class='links'><p>More</p></div></body>"
    assert html_extract.main_text(story).split("\n") == [LONG.strip(), LONG.strip()]
    inside = f"<body><nav>Menu</nav><article><p>{LONG}</p><p class='notice-period'>{LONG}</p><section class='search-results-discussion'><p>{LONG}</p></section><div class='ad-slot-1 wide'>{LONG}</div></article></body>"
    assert html_extract.main_text(inside).split("\n") == [LONG.strip()] * 3


def test_html_surges_decide(monkeypatch):
    """Without the surges another text comes out: weights alone don't choose it."""
    menu = "".join(f"<div>{w}</div>" for w in ("Home", "News", "Sport", "Shop", "Contact"))
    page = f"<body><div>{menu}</div><div><p>{LONG}</p><p>{LONG}</p></div><div>{menu}</div></body>"
    assert html_extract.main_text(page).split("\n") == [LONG.strip(), LONG.strip()]
    monkeypatch.setattr(html_extract, "surges", lambda weights, *_: [(i, i + 1) for i, w in enumerate(weights) if w > 0])
    assert "Home" in html_extract.main_text(page)


def test_surges():
    assert html_extract.surges([0, 0, 5, 0, 5, 0, 0, 0, 7, 0], 2, 1) == [(2, 5), (8, 9)]


def test_warc(spark, pages):
    rows = [(3, "u", "same"), (1, "v\r\nw", "same"), (2, None, "same"), (4, "u", None), (5, "u", ""), (None, "u", "same"), (None, "u", "alone"), (7, "u", "x" * 300_000), (8, "u", "é\x1f\x8b\x08\x00"), (1, "v", "same")]
    got = warc.round_trip(pages(rows)).collect()
    want = []
    first = {"same": 1, "": 4}
    for i, _, h in rows:
        b = (h or "").encode()
        f = first.get(h or "")
        again = f == i and any(x[0] == i and x[1] == len(b) for x in want)
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if f in (None, i) and not again else "revisit", None if f in (None, i) and not again else f))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert warc.round_trip(pages([])).collect() == []
    longer = warc.read_warc(spark, warc.write_warc(pages(rows), min_bytes=5)).filter("record_type = 'revisit'")
    assert longer.count() == 0


@pytest.mark.parametrize("split", [100, 1000, 1 << 20])
def test_warc_ranges(spark, pages, split):
    """Each record is met once whatever the ranges, also where stored bytes look like members."""
    rng = random.Random(split)
    rows = [(i, f"http://x/{i}", "".join(chr(rng.randint(32, 500)) for _ in range(rng.randint(0, 400)))) for i in range(80)]
    files = warc.write_warc(pages(rows).coalesce(2))
    back = warc.read_warc(spark, files, split).collect()
    assert sorted((r.page_id, r.url, r.payload.decode()) for r in back) == rows
    fake = warc.MAGIC + b"junk"
    stored = fake + warc.record("response", {"WARC-Page-ID": "1"}, warc.http_block(b"a", 1)) + fake + warc.record("response", {"WARC-Page-ID": "2"}, warc.http_block(b"b", 1))
    seen = [int(h["warc-page-id"]) for lo in range(0, len(stored), 50) for _, h, *_ in warc.records_in(io.BytesIO(stored), len(stored), lo, min(lo + 50, len(stored)))]
    assert seen == [1, 2]


def plain_member(block: bytes) -> bytes:
    """A record whose deflate blocks are stored, so that its payload stands in the archive as it is."""
    z = zlib.compressobj(0, zlib.DEFLATED, 31)
    return z.compress(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Page-ID: 1\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n") + z.flush()


@pytest.mark.parametrize("split", [60, 200, 100_000])
def test_warc_members_in_a_payload(spark, tmp_path, split):
    """What stands inside a payload is no record, wherever a range starts; numbers that aren't numbers are passed over."""
    inner = [warc.record("response", {"WARC-Page-ID": str(n)}, warc.http_block(b"inner", 5)) for n in (98, 99)]
    outer = plain_member(warc.http_block(b"x" * 300 + inner[0] + b"y" * 150 + inner[1] + b"z" * 100, 0))
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    bad = z.compress(b"WARC/1.1\r\nContent-Length: abc\r\n\r\nx\r\n\r\n") + z.flush()
    data = outer + bad + warc.record("response", {"WARC-Page-ID": "two", "WARC-Payload-Length": "?"}, warc.http_block(b"b", 1)) + warc.record("response", {"WARC-Page-ID": "3"}, warc.http_block(b"c", 1))
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    back = warc.read_warc(spark, spark.createDataFrame([(str(path), len(data))], "path string, bytes long"), split)
    assert sorted((r.page_id or 0) for r in back.collect()) == [0, 1, 3]
    # Ranges are dealt to as many tasks.
    assert back.rdd.getNumPartitions() == -(-len(data) // split)


def brute_rule(host, path, rules):
    fits = [(len(r), r, v) for r, v in rules for h, p in [url_filter.split_rule(r)] if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else None


def test_url_filter(pages):
    rules = [*queries.URL_RULES, ("net", "block"), ("a.net/x/yy", "allow"), ("a.net/x/", "block"), ("b.a.net/", "allow")]
    rng = random.Random(3)
    urls = [None, "", "nothing", "http://", "HTTP://WWW.Example.ORG/es/x?y#z", "http://example.org", "http://org/", "x://a.net/x/yyy", "x://q.a.net/x/y?/x/yy", "http://com/fr/", "http://é.com/de/"]
    urls += [f"http://{'.'.join(rng.choice(['a', 'b', 'net', 'com', 'org', 'example']) for _ in range(rng.randint(1, 4)))}/{'/'.join(rng.choice(['es', 'en', '1', '12', 'x', 'yy', 'fr', 'de', '']) for _ in range(rng.randint(0, 4)))}" for _ in range(400)]
    got = url_filter.filter_urls(pages([(i, u, None) for i, u in enumerate(urls)]), rules).collect()
    for r in got:
        host, path = url_filter.split_url(urls[r.page_id])
        want = brute_rule(host, path, rules)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, want and want[0], want[1] if want else "allow")
    assert url_filter.filter_urls(pages([]), rules).collect() == []
    assert url_filter.filter_urls(pages([(None, None, None)] * 2), rules).count() == 2


TALK = [
    (1, 0, "user", "Hello there.\nHow are  you?\n\nSee you."), (1, 1, "assistant", "> how are you?\nFine."), (1, 2, "user", "> > How are you?\n> Fine.\nGood\n> unknown words\nend"),
    (1, 3, None, ">> see you.\n\n\n\nBye"), (1, 3, None, ">> see you.\n\n\n\nBye"), (2, 5, "user", None), (2, 900, "user", ">"), (2, 70, "system", "> Hello there."), (None, 1, "user", "a"), (None, 2, "user", "> a\nb"), (3, None, "user", "> x"),
]


def talk(spark, rows):
    return spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, level string, run long")


def test_quotes(spark):
    got = chat.link_quotes(talk(spark, TALK))
    by = {(r.conv_id, r.turn): r for r in got.collect()}
    assert len(got.collect()) == len(TALK)
    assert (by[1, 1].text, by[1, 1].reply_to, by[1, 1].n_linked) == ("Fine.", 0, 1)
    assert (by[1, 2].text, by[1, 2].reply_to, by[1, 2].n_quotes, by[1, 2].n_linked) == ("Good\nend", 1, 3, 2)
    assert (by[1, 3].text, by[1, 3].reply_to) == ("Bye", 0)
    assert by[2, 70].n_linked == 0 and by[2, 70].reply_to == 5 and by[2, 900].reply_to == 70
    assert by[None, 2].reply_to == 1 and by[3, None].reply_to is None
    assert chat.link_quotes(talk(spark, [])).collect() == []
    assert_sql(got, TALK)


def assert_sql(got, rows):
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    want = duckdb.sql(chat.SQL).fetchall()
    cols = ["conv_id", "turn", "role", "text", "n_quotes", "n_linked", "reply_to", "position", "line"]
    assert sorted(map(repr, (tuple(r) for r in got.select(cols).collect()))) == sorted(map(repr, want))


def brute_order(replies):
    """Preorder of a tree of replies {turn: reply_to}."""
    out = []

    def visit(t):
        out.append(t)
        for x in sorted(x for x, up in replies.items() if up == t):
            visit(x)

    visit(min(replies))
    return out


def test_reply_order(spark):
    """Long conversations with branches in branches: every message is followed by all replies to it."""
    rng = random.Random(4)
    rows = []
    for conv in (1, 2):
        for t in range(150):
            back = rng.randrange(max(1, t - 40), t) if t > 2 and rng.random() < 0.4 else None
            rows.append((conv, t, "user", f"> message {conv} {back} here\nmessage {conv} {t} here" if back is not None else f"message {conv} {t} here"))
    rows += [(3, t, "user", f"plain {t}") for t in (7, 70, 700)]
    got = chat.link_quotes(talk(spark, rows))
    for conv in (1, 2):
        own = got.filter(f"conv_id = {conv}").collect()
        assert sum(r.reply_to != r.turn - 1 for r in own) > 40
        assert [r.turn for r in sorted(own, key=lambda r: r.position)] == brute_order({r.turn: r.reply_to for r in own})
    assert [r.position for r in got.filter("conv_id = 3").orderBy("turn").collect()] == [1, 2, 3]
    assert_sql(got, rows)


def test_partial_quotes(spark):
    """Quotes of some lines, some paragraphs or some sentences of a message link to it."""
    first = "One line here.\nTwo is next\nThree ends it.\n\nSecond paragraph, first sentence. And its\nlast one! Is it?\n\nThird paragraph."
    rows = [
        (1, 0, "user", first), (1, 1, "user", "Nothing of it."),
        (1, 2, "user", "> Two is next\n> three ends it.\nLines."),
        (1, 3, "user", "> Second paragraph, first sentence. And its\n> last one! Is it?\n>\n> Third paragraph.\nParagraphs."),
        (1, 4, "user", "> And its last\n> one!\nA sentence, wrapped otherwise."),
        (1, 5, "user", "> One line here.\n> Three ends it.\nNot consecutive."),
        (2, 0, "user", "x"), (2, 100, "user", "> Two is next\n> Three ends it.\nAnother conversation."),
    ]
    linked = chat.link_quotes(talk(spark, rows))
    assert_sql(linked, rows)
    got = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.reply_to) for r in linked.collect()}
    assert [got[1, t] for t in (2, 3, 4, 5)] == [(1, 1, 0), (1, 1, 0), (1, 1, 0), (1, 0, 4)]
    assert got[2, 100] == (1, 0, 0)


def test_chats(spark):
    parts = chat.conversations(chat.link_quotes(talk(spark, TALK)))
    lines = [r.line for r in parts.collect() if r.conv_id == 1]
    assert lines[0].startswith("<|user|>Hello there.") and len(lines) == 5
    assert [r.position for r in parts.collect() if r.conv_id == 2] == [1, 2, 3]


def test_arrow_types():
    assert warc._batch([("p", 0, "response", "u", 1, None, "d", 1, b"x", "s")]).schema.field("payload").type == pa.binary()
