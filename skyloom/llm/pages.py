"""The labelled table that the extraction's tree is learned from: small pages of many layouts, with a sign for each block.

A page's blocks are, in order, main text (+) or not (-). Texts are filled up by rule: what tells is how long a block is, how
much of it is links, and where it stands.
"""

from __future__ import annotations

_FILL = "the old mill by the river was sold last spring to a baker who wants to grind his own flour again and show how it was done".split()


def say(n: int, start: int = 0, end: str = ".") -> str:
    """n words of running text."""
    words = [_FILL[(start + 7 * i) % len(_FILL)] for i in range(n)]
    return f"{' '.join(words).capitalize()}{end}"


def links(*names: str, tag: str = "li") -> str:
    return "".join(f'<{tag}><a href="/{n.lower()}">{n}</a></{tag}>' for n in names)


def paragraphs(*sizes: int) -> str:
    return "".join(f"<p>{say(n, i)}</p>" for i, n in enumerate(sizes))


MENU = links("Home", "News", "Sport")
RELATED = links("The mill that was sold last year", "Five ways to bake bread", "Who owns the river")
COMMENT = f"<p>anna wrote:</p><p>{say(47)}</p>"

# Pages and the labels of their blocks, in order.
LABELLED = [
    # semantic elements, a short and a long article
    (f"<nav><ul>{MENU}</ul></nav><article><h1>{say(6, 1, '')}</h1>{paragraphs(40, 3, 1, 22, 2)}</article><aside>{paragraphs(36, 57)}</aside><footer>&copy; 2020 The Mill. {say(41)}</footer>", "---++++++---"),
    (f"<header><h1>The Mill Gazette</h1><p>{say(7)}</p></header><main><h2>{say(4, 2, '')}</h2>{paragraphs(5, 60, 12, 1)}<ul><li>{say(3)}</li><li>flour</li></ul></main><aside><h3>Related</h3><ul>{RELATED}</ul></aside><footer><p>All rights reserved.</p></footer>", "--+++++++-----"),
    (f"<nav>{MENU}<p>{say(16)}</p></nav><div class=ad>{say(34)}</div><article><h1>Flour</h1><p>No.</p></article><footer>{say(15)} &copy;</footer>", "-----++-"),
    # an article with a head, a note of its own, a table, links in the text, and comments
    (f"<article><header><h1>{say(8, 3, '')}</h1><p>By Anna Bell</p></header><p>{say(20)} <a href=x>{say(3)}</a> {say(20)}</p><table><tr><td>flour</td><td>12</td></tr></table><p><a href=y>read the deed</a></p><section class=comments><h3>Comments</h3>{COMMENT}</section></article>", "++++++---"),
    (f"<main>{paragraphs(30, 2)}<blockquote><p>{say(9)}</p></blockquote><form><p>Your name</p><p>{say(12)}</p></form><div id=related-posts>{RELATED}</div></main>", "+++-----"),
    # classes and ids, no semantic elements
    (f"<div id=header><p>The Mill Gazette</p></div><div class=menu>{links('Home', 'About', tag='p')}</div><div class='post-content'><h1>{say(5, 4, '')}</h1>{paragraphs(18, 4, 1)}</div><div class=sidebar><p>{say(48)}</p><p>{say(39)}</p><p>{say(3)}</p></div><div id=footer><p>{say(52)}</p></div>", "---++++----"),
    (f"<div class=cookie-notice><p>{say(61)}</p><p>Accept</p></div><div id=main><p>{say(33)}</p><p>Yes.</p><div class=share>{links('Mail', 'Print', tag='p')}</div><p>{say(11)}</p></div><div class=newsletter><p>{say(43)}</p></div>", "--++--+-"),
    (f"<div class=breadcrumb><a href=/>Home</a> &gt; <a href=/n>News</a></div><div class=story><h2>{say(7, 5, '')}</h2>{paragraphs(3, 45, 2)}</div><div id=disqus_thread>{COMMENT}<p>{say(44)}</p><p>{say(90)}</p></div>", "-++++----"),
    # parts around the text, of any length, between its paragraphs and beside it
    (f"<div class=ad>{say(13)}</div><p>{say(51)}</p><div class=promo>{say(19)}</div><p>{say(33)}</p><div class='widget social'>{say(11)}</div><p>{say(47)}</p><footer>{say(17)}</footer>", "-+-+-+-"),
    (f"<aside>{paragraphs(14, 9, 21)}</aside><div><p>{say(39)}</p><p>{say(62)}</p></div><aside>{paragraphs(26, 12)}</aside><footer>{paragraphs(10, 16, 23)}</footer>", "---++-----"),
    (f"<div id=banner>{say(29)}</div><div class=post>{paragraphs(44, 7)}</div><div id=comments>{paragraphs(20, 35, 13, 8)}</div><div class=legal>{say(22)}</div>", "-++-----"),
    (f"<div class=menu>{say(3)}</div><article><p>Ha.</p></article><footer>{say(8)}</footer>", "-+-"), (f"<article><p>{say(30)}</p><p>So.</p></article><div class=ad>{say(12)}</div>", "++-"), (f"<nav>{say(2)}</nav><footer>{say(11)}</footer>", "--"),
    # hardly any text, links that belong to the text, and no foot
    ("<article><h1>Flour</h1><p>No.</p></article>", "++"),
    (f"<nav>{MENU}</nav><article>{paragraphs(2, 1, 1)}<p><a href=x>{say(4)}</a></p><p><a href=y>Deed</a></p><p><a href=z>{say(12)}</a></p><p>Ha.</p></article>", "---+++++++"),
    ("<div class=menu><p>Home</p><p>Shop</p></div><div class=entry><p>Yes.</p><p><a href=x>More</a></p><p>Or.</p></div>", "--+++"),
    (f"<p>Log in</p><p>Help</p><main><p>{say(3)}</p><p><a href=x>{say(5)}</a></p></main><p>Top</p><p>Site map</p>", "--++--"),
    # nothing but words and links tells: old layouts, menus, notes
    (f"<table><tr><td>{links('Home', 'Maps', 'Shop', tag='p')}</td><td><h1>{say(6, 6, '')}</h1>{paragraphs(50, 35, 8, 41)}</td></tr></table><p>Copyright 1999 by the mill. {say(5)}</p>", "---+++++-"),
    (f"<div>{links('Home', 'News', tag='div')}</div><div><div>{say(28)}</div><div>{say(4, 1)}</div><div>{say(36, 2)}</div></div><div>{links('Terms', 'Privacy', 'Contact us', tag='span')}</div><div>&copy; The Mill</div>", "--+++--"),
    (f"<p>{say(30)}</p><p>{say(26, 1)}</p><h2>Later</h2><p>{say(31, 2)}</p><p>Fine.</p><p>{say(12, 3)}</p>", "++++++"),
    (f"<ul>{MENU}</ul><p>Sign in</p><p>{say(40)}</p><p>{say(38, 4)}</p><ul>{RELATED}</ul><p>Powered by flour</p>", "----++----"),
    (f"<div><a href=a>Next page</a> | <a href=b>Previous page</a></div><p>{say(55)} <a href=c>{say(2)}</a></p><p>{say(6)}</p><p>{say(48)}</p><div>Tags: <a href=d>mill</a>, <a href=e>flour</a></div>", "-+++-"),
    (f"<h1>{say(5, 7, '')}</h1><p>{say(70)}</p><p>{say(15, 2)}</p>", "+++"),
    (f"<ul>{links('Home.', 'Is it new?', 'Bread!', 'Maps.')}</ul><p>{say(40, 1, '')}</p><p>{say(33, 2, '')}</p><p>{say(28, 3)}</p><ul>{links(say(9), say(12, 1), say(8, 2), say(11, 3))}</ul>", "----+++----"),
    (f"<p>{say(46, 5, '')}</p>", "+"), (f"<p>{say(24, 5, '')}</p><p>{say(37, 6, '')}</p><p>{say(19, 7, '')}</p>", "+++"),
    (f"<div>Menu.</div><div>{links(say(7), say(10, 2), tag='p')}</div><div>{say(52, 1, ' –')}</div><div>{say(29, 2, '')}</div><div>{links(say(14), say(13, 2), say(21, 4), tag='p')}</div><div>Sign up.</div>", "---++----"),
    (f"<h3>Links</h3><p><a href=a>{say(15)}</a></p><p><a href=b>{say(18)}</a></p><h3>Read</h3><p>{say(34, 0, '')}</p><p>{say(61, 0)}</p>", "---+++"),
    (f"<p>{say(4)}</p>", "+"),
    (f"<ul>{links('One', 'Two', 'Three', 'Four')}</ul><p>Advertisement</p><p>© 2001 {say(3)}</p>", "------"),
]
