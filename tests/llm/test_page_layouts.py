"""Main text of hand-written pages in forms that the labelled pages do not have."""

import pytest

from stayline.llm import html_crf

A = "The old bridge over the river was closed on Monday after engineers found cracks in two of its piers."
B = "Traffic is led over the new road until spring, and buses leave from the market square instead of the station."
C = "The council will decide in March whether the bridge is repaired or replaced, a spokesman said."
D = "A similar case was settled ten years ago, when the mill weir broke during a storm and flooded the lower town."
H = "Bridge closed after cracks are found"

PAGES = [
    # tables for layout
    (f"<table><tr><td colspan=3>The Valley Post</td></tr><tr><td><a href=/>Home</a><br><a href=/s>Sport</a><br><a href=/c>Contact</a></td><td><h2>{H}</h2><p>{A}</p><p>{B}</p><p>{C}</p></td>"
     "<td><b>Weather</b><p>Rain, 12 degrees</p></td></tr><tr><td colspan=3>Copyright 2003 The Valley Post</td></tr></table>", [H, A, B, C]),
    (f"<center><table border=0><tr><td><a href=a>News</a> | <a href=b>Archive</a> | <a href=c>About us</a></td></tr><tr><td><h1>{H}</h1>{A}<p>{B}<p>{D}</td></tr><tr><td><font size=1>&copy; 2001 Post Group</font></td></tr></table></center>", [H, A, B, D]),
    # bare elements
    (f"<div>Home | About | Archive</div><div><h1>{H}</h1><p>{A}</p><p>{B}</p></div><div>Leave a comment</div><div>first! nice bridge</div><div>I drove over it for years.</div>", [H, A, B]),
    (f"<p><a href=/>Home</a> <a href=/n>News</a> <a href=/s>Sport</a></p><h1>{H}</h1><p>{A}</p><p>{D}</p><p>{C}</p><p>Copyright 2019 Valley Post. All rights reserved.</p>", [H, A, D, C]),
    (f"<div><div><a href=/>Valley Post</a></div><div><ul><li><a href=/1>Politics<li><a href=/2>Culture<li><a href=/3>Letters</ul></div><div><h1>{H}<p>{A}<p>{B}<p>{C}</div><div><h4>Recent posts</h4><ul><li><a href=/4>New school opens</a><li><a href=/5>Fair returns</a></ul></div></div>", [H, A, B, C]),
    # classes that tell nothing
    (f'<div class="x1"><a href=/>Start</a> <a href=/b>Blog</a></div><div class="x2"><h1>{H}</h1><p>{A}</p><p>{B}</p><p>{D}</p></div><div class="x3"><p>3 comments</p><p>Anna says:</p><p>My bus was an hour late.</p><p>Tom says:</p><p>They knew it all along.</p></div>', [H, A, B, D]),
    (f'<section class="css-9k2"><p>We use cookies to improve this site.</p></section><section class="css-1ab"><h1>{H}</h1><p>{A}</p><p>{C}</p></section><section class="css-77"><a href=/p>Privacy</a> <a href=/t>Terms</a> <a href=/i>Imprint</a></section>', [H, A, C]),
    # hidden text and notices inside the article
    (f'<article><h1>{H}</h1><p>{A}</p><p style="display: none">Buy cheap stone for bridges now, only here and only today.</p><p>{B}</p><p hidden>This paragraph is for machines only and says little.</p><p>{C}</p></article>', [H, A, B, C]),
    (f"<main><h1>{H}</h1><p>{A}</p><aside><h4>Newsletter</h4><p>Get our best stories by mail every morning.</p></aside><p>{B}</p><p>{D}</p></main>", [H, A, B, D]),
    (f'<article><h1>{H}</h1><p>{A}</p><div class="promo-box"><p>Sponsored: see the new tractors.</p></div><p>{B}</p><figure><figcaption>The bridge on Monday.</figcaption></figure><p>{C}</p></article>', [H, A, B, "The bridge on Monday.", C]),
    # names as other systems give them
    (f'<div id="hd"><div class="logo">Valley Post</div></div><div id="bd"><div class="entry"><h1>{H}</h1><p>{A}</p><p>{B}</p></div><div id="respond"><h3>Leave a Reply</h3><form><label>Name</label><input></form></div></div><div id="ft" class="footer"><p>Powered by Press</p></div>', [H, A, B]),
    (f'<div role="navigation"><a href=/>Index</a><a href=/a>Next</a></div><div role="main"><h1>{H}</h1><p>{D}</p><p>{C}</p></div><div role="contentinfo" class="site-footer">All rights reserved.</div>', [H, D, C]),
    (f"<body>{A}<br>{B}</body>", [f"{A} {B}"]),
    (f"<h1>{H}</h1><blockquote>{C}</blockquote><p>{A}</p><ol><li>Use the new road.</li><li>Leave the car at home.</li></ol><pre>bridge = None</pre>", [H, C, A, "Use the new road.", "Leave the car at home.", "bridge = None"]),
]


@pytest.fixture(scope="module")
def model():
    return html_crf.fit(html_crf.labelled_pages())


def test_layouts_that_the_fit_has_not_seen(model):
    wanted = found = right = 0
    for page, lines in PAGES:
        got = html_crf.main_text(f"<html><head><title>{H}</title></head><body>{page}</body></html>", model).split("\n")
        if got != lines:
            print("lost", [x for x in lines if x not in got], "kept", [x for x in got if x not in lines])
        wanted, found, right = wanted + len(lines), found + len(got), right + sum(x in lines for x in got)
    assert right / wanted >= 0.95 and right / found >= 0.95, (right, wanted, found)


def test_hidden_text_goes(model):
    for attribute in ("hidden", 'style="display: none"', "style='color:red;display:none'"):
        page = f"<article><h1>{H}</h1><p>{A}</p><p {attribute}>{D}</p><p>{B}</p></article>"
        assert html_crf.main_text(page, model).split("\n") == [H, A, B]
