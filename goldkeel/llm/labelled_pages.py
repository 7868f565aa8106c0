"""Hand-labelled pages from which the content weights are estimated.

Each is a list of parts: markup, and whether its words belong to the main text.
They show the usual furniture of pages and the usual shapes of articles; texts
stand for any text, only markup matters.
"""

WORDS = "one two three four five six seven eight nine ten eleven twelve"
LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in WORDS.split()[:6])
PARAGRAPHS = f"<h1>{WORDS[:24]}</h1>" + f"<p>{WORDS} <a href='/x'>four</a> <b>two</b> {WORDS}.</p>" * 4
LISTED = f"<h2>{WORDS[:13]}</h2><p>{WORDS}</p><ul><li>{WORDS}</li><li>{WORDS}</li></ul><p>{WORDS} {WORDS}</p>"
TABLED = f"<p>{WORDS}</p><table><tr><td>one</td><td>two</td></tr></table><blockquote>{WORDS}</blockquote><p>{WORDS}</p>"

PAGES: list[list[tuple[str, bool]]] = [
    [
        (f"<body><nav><ul>{LINKS}</ul></nav><div class='ad'>{WORDS[:30]}</div>", False),
        (f"<article>{PARAGRAPHS}</article>", True),
        ("<footer>one two three four</footer></body>", False),
    ],
    [
        (f"<body><header class='site-header'>one two</header><div id='menu'><ul class='menu'>{LINKS}</ul></div>", False),
        (f"<main>{LISTED}{PARAGRAPHS}</main>", True),
        (f"<aside class='sidebar widget'><h3>one</h3><ul>{LINKS}</ul><p>{WORDS}</p></aside>", False),
        (f"<section id='comments' class='comments'><div class='comment'><p>{WORDS}</p></div></section>", False),
        ("<div class='footer copyright'>one two three</div></body>", False),
    ],
    [
        (f"<body><div class='cookie-notice banner'>{WORDS} <button>one</button></div>", False),
        (f"<div class='navbar navigation breadcrumb'>{LINKS}</div>", False),
        (f"<div class='content post entry'>{PARAGRAPHS}{TABLED}</div>", True),
        ("<form action='/s'><label>one</label><input><select><option>two</option></select><button>three</button></form>", False),
        (f"<div class='related share social promo newsletter popup'><p>{WORDS}</p>{LINKS}</div>", False),
        (f"<div class='advert sponsored'><p>{WORDS}</p></div>", False),
        ("<footer><p>one two three four five</p></footer></body>", False),
    ],
    [
        (f"<body><div role='navigation'>{LINKS}</div><div role='banner'>one two</div>", False),
        (f"<div id='main' class='article-body'>{PARAGRAPHS}", True),
        (f"<div class='ads advertisement'>{WORDS}</div>", False),
        (f"{LISTED}</div>", True),
        (f"<div role='complementary'>{WORDS}</div><div role='contentinfo'>one two</div>", False),
        (f"<div class='notice alert'>{WORDS}</div><div id='disqus_thread' class='replies'><p>{WORDS}</p></div></body>", False),
    ],
]
