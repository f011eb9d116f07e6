"""Main-text extraction and WARC archives."""

import hashlib

import pytest

from stayline.llm import html_crf, warc

PAGE = "page_id long, url string, html string, text string, file string"


@pytest.fixture(scope="module")
def model():
    return html_crf.fit(html_crf.labelled_pages())


def test_blocks_of_a_page():
    page = (
        "<title>T</title><p>One <b>two<br>three<p>a &amp; b&nbsp;c &lt;d><script>if (a<b) '</p>'</script><div class='x Side-Bar' id=y>in<a href='>'>side</a></div>"
        "<!-- no <p>no</p> --><ul><li>1<li>2</ul><textarea>t</textarea>tail<style>p{}</style> &am<p"
    )
    blocks = html_crf.leaf_blocks(page)
    assert [b[0] for b in blocks] == ["One two three", "a & b c <d>", "inside", "1", "2", "tail &am"]
    assert {"side", "bar", "x", "y"} <= {w for _, names in blocks[2][1] for w in names}
    assert 0.6 < blocks[2][2] < 0.7 and blocks[3][2] == 0
    assert html_crf.leaf_blocks("no tags < at 3 <3") == [("no tags < at 3 <3", (), 0.0)]
    assert html_crf.leaf_blocks("<script>never closed <p>x</p>") == []
    assert html_crf.leaf_blocks('<a title="open <p>x</p>')[0][0] == "x"


def test_head_without_its_end_tag(model):
    """The end tags of head, and the tags of html and body, are optional."""
    given = "<title>T</title><meta charset=utf-8><link rel=x href=y><script>s</script><style>c</style>"
    body = "<nav><a href='/'>Home</a></nav><article><h1>Main title</h1><p>First paragraph, with words.<p>Another paragraph, with more words.</article>"
    whole = f"<html><head>{given}</head><body>{body}</body></html>"
    texts = ["Home", "Main title", "First paragraph, with words.", "Another paragraph, with more words."]
    assert [b[0] for b in html_crf.leaf_blocks(whole)] == texts
    for page in (f"<html><head>{given}<body>{body}</body></html>", f"<html><HEAD>{given}<body>{body}", f"<head>\n{given}\n<head><body>{body}"):
        assert [(t, p[-2:]) for t, p, _ in html_crf.leaf_blocks(page)] == [(t, p[-2:]) for t, p, _ in html_crf.leaf_blocks(whole)]
        assert html_crf.main_text(page, model) == html_crf.main_text(whole, model) == "\n".join(texts[1:])
    for opens in ("", "<div>", "<br>", "<unknown>", "<img src=x>", "<svg></svg>"):
        page = f"<!doctype html><html><head>{given}<!-- c --> {opens}Plain text<p>More <b>text</b>"
        blocks = html_crf.leaf_blocks(page)
        assert [b[0] for b in blocks] == ["Plain text", "More text"] and not any(tag == "head" for _, p, _ in blocks for tag, _ in p)
    assert html_crf.leaf_blocks(f"<html><head>{given}</html>") == []


def test_viterbi_is_the_best_of_all_sequences():
    from itertools import product

    moves, ends, scores = [[0.3, -1.0], [-0.7, 0.9]], [[0.1, -0.2], [0.0, 0.4]], [1.0, -2.0, 0.5, 0.2, -0.4, 3.0]
    def value(ys):
        return ends[0][ys[0]] + ends[1][ys[-1]] + sum(s * y for s, y in zip(scores, ys)) + sum(moves[a][b] for a, b in zip(ys, ys[1:]))
    assert value(html_crf.decode(scores, moves, ends)) == pytest.approx(max(map(value, product((0, 1), repeat=6))))
    assert html_crf.decode([], moves, ends) == []


def test_held_out_layouts(model):
    pages = html_crf.labelled_pages(200, seed=77)
    wanted = found = right = 0
    for page, main in pages:
        a, b = main.split("\n"), html_crf.main_text(page, model).split("\n")
        wanted, found, right = wanted + len(a), found + len(b), right + len([x for x in b if x in a])
    assert right / wanted > 0.985 and right / found > 0.985


def test_given_pages_are_their_articles(spark, sf, model):
    """In these tables the main text is the article element: its blocks in order."""
    rows = html_crf.extract(spark.read.parquet(f"{sf}/pages.parquet"), model).collect()
    for r in rows:
        blocks = [t for t, path, _ in html_crf.leaf_blocks(r["html"]) if any(tag == "article" for tag, _ in path)]
        assert r["text"] == "\n".join(blocks)


def test_page_cases(spark, model):
    article = "<article><h1>Main title</h1><p>First  paragraph,\nwith words.</p><p>Ti.</p><div class='comments'><p>Nice post, thanks!</p></div></article>"
    page = f"<body><nav><a href='/'>Home</a></nav><div class='cookie-notice'><p>We use cookies.</p></div>{article}<footer>&copy; x</footer></body>"
    rows = [(1, "u", page, "old", "f"), (1, "u", page, "old", "f"), (2, None, None, None, None), (3, "u", "", "", ""), (None, "u", "<p>" + "word " * 200_000, "", "")]
    got = html_crf.extract(spark.createDataFrame(rows, PAGE), model).collect()
    texts = sorted(((r["page_id"] or 0), r["text"]) for r in got)
    assert texts[1] == texts[2] == (1, "Main title\nFirst paragraph, with words.\nTi.")
    assert texts[3] == (2, "") and texts[4] == (3, "") and len(texts[0][1]) == 5 * 200_000 - 1
    assert html_crf.extract(spark.createDataFrame([], PAGE), model).count() == 0


def test_archives_round_trip(spark):
    big = "é<p>" * 400_000
    rows = [(3, "http://a/%41\r\nX: y", "same", "t", "f"), (1, None, "same", "t", "f"), (1, None, "same", "t", "f"), (7, "u", None, "t", "f"), (8, "u", "", "t", "f"), (9, "u", big, "t", "f"), (None, "n", "same", "t", "f"), (None, "n", "other", "t", "f")]
    pages = spark.createDataFrame(rows, PAGE).repartition(3)
    index = warc.write(pages)
    assert index.count() == len(rows)
    got = warc.read(index, payload=True, gap=10, most=1000).collect()
    assert len(got) == len(rows) and all(r["verified"] for r in got)
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0, r["html"] or "") for r in got)
    assert kinds == sorted([
        (3, "revisit", 1, ""), (1, "response", 0, "same"), (1, "response", 0, "same"), (7, "response", 0, ""), (8, "revisit", 7, ""), (9, "response", 0, big),
        (0, "revisit", 1, ""), (0, "response", 0, "other"),
    ])
    assert {r["url"] for r in got if r["page_id"] == 3} == {"http://a/%41\r\nX: y"}
    assert {r["payload_digest"] for r in got if r["page_id"] == 3} == {warc.sha1_base32(b"same")}
    assert {r["payload_bytes"] for r in got if r["page_id"] in (3, 9)} == {4, len(big.encode())}
    one = warc.read(index.filter("page_id = 9"), payload=True).collect()
    assert [hashlib.sha1(r["html"].encode()).hexdigest() for r in one] == [hashlib.sha1(big.encode()).hexdigest()]
    stored = warc.write(pages, least=1)
    assert stored.filter("page_id in (7, 8) and record_type = 'revisit'").count() == 0
    empty = warc.write(spark.createDataFrame([], PAGE))
    assert empty.count() == 0 and warc.read(empty).count() == 0


@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}", "{}/with a space"])
def test_folders_of_any_form(spark, tmp_path, form):
    """A bare path, and the URI forms that Hadoop and Spark give back."""
    pages = spark.createDataFrame([(1, "u", "<p>é", "t", "f"), (2, None, None, "t", "f")], PAGE)
    index = warc.write(pages, form.format(tmp_path))
    assert {r["file"][:8] for r in index.collect()} == {"file:///"}
    assert sorted((r["page_id"], r["html"]) for r in warc.read(index, payload=True).collect()) == [(1, "<p>é"), (2, "")]


def test_ranges_are_joined():
    assert list(warc.joined_ranges([0, 10, 30, 100], [10, 10, 10, 5], gap=10, most=1000)) == [(0, 3), (3, 4)]
    assert list(warc.joined_ranges([0, 10, 20], [10, 10, 10], gap=0, most=20)) == [(0, 2), (2, 3)]
    assert list(warc.joined_ranges([], [], 0, 1)) == []
