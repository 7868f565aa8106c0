"""Main text of pages of shapes that no weight was learned from."""

import pytest

from goldkeel.llm.html_text import main_text

TEXTS = [
    "Alpha beta gamma delta epsilon zeta eta theta.",
    "Iota kappa lambda mu nu xi omicron pi rho.",
    "Sigma tau upsilon phi chi psi omega again.",
]
ARTICLE = "<h1>T one</h1>" + "".join(f"<p>{t}</p>" for t in TEXTS)
PARAGRAPHS = ARTICLE.removeprefix("<h1>T one</h1>")
LINKS = "".join(f"<li><a href='/{i}'>Link number {i}</a></li>" for i in range(6))
SHAPES = {
    "plain body":f"<html><body>{ARTICLE}</body></html>",
    "div id content":f"<body><div id='top-nav'><ul>{LINKS}</ul></div><div id='content'>{ARTICLE}</div><div id='footer'>Copyright 2020 someone all rights reserved</div></body>",
    "main nested article, related inside":f"<body><header><a href='/'>Site</a><nav>{LINKS}</nav></header><main><article>{ARTICLE}<aside class='related'><ul>{LINKS}</ul></aside></article></main><footer>foot</footer></body>",
    "comments after":f"<body><main>{ARTICLE}<section id='comments'><h2>Comments</h2><div class='comment'><p>Great post I liked it a lot really</p></div></section></main></body>",
    "table layout":f"<body><table><tr><td class='sidebar'><ul>{LINKS}</ul></td><td class='content'>{ARTICLE}</td></tr></table></body>",
    "section post-body":f"<body><div class='wrapper'><div class='masthead'>My site name slogan</div><section class='post-body'>{ARTICLE}</section><div class='widget-area'><h3>Archive</h3><ul>{LINKS}</ul></div></div></body>",
    "role main":f"<body><div role='banner'>Name</div><div role='main'>{ARTICLE}</div><div role='contentinfo'>Legal stuff here</div></body>",
    "forms":f"<body><article>{ARTICLE}<form><label>Email address</label><input><button>Subscribe now</button></form></article></body>",
    "notice inside":f"<body><article><div class='notice'>This article is old and may be outdated</div>{ARTICLE}</article></body>",
    "ad between":f"<body><article><h1>T one</h1><p>{TEXTS[0]}</p><div class='ad-slot'>Buy now cheap things great price</div><p>{TEXTS[1]}</p><p>{TEXTS[2]}</p></article></body>",
    "article header/footer":f"<body><header>Site head</header><article><header><h1>T one</h1></header>{PARAGRAPHS}<footer>Filed under things</footer></article><footer>Site foot</footer></body>",
    "no classes, nav list":f"<body><ul>{LINKS}</ul>{ARTICLE}<ul>{LINKS}</ul></body>",
}


@pytest.mark.parametrize("name", SHAPES)
def test_held_out_shapes(name):
    assert main_text(SHAPES[name]) == "\n".join(["T one", *TEXTS])
