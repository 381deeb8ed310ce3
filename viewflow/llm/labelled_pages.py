"""Labelled pages: elements marked as dropped, with all that is in them, are not content; all others are."""

DROPPED = "data-dropped"

_LONG = "This is a paragraph of running text that goes on for a while, with some commas, until it ends."
_WORDS = "Long running words without any end mark that stand as a paragraph of their own here"


def _d(tag: str, attrs: str, inner: str) -> str:
    """A dropped element."""
    return f"<{tag} {attrs} {DROPPED}>{inner}</{tag}>"


def _menu(n: int = 4) -> str:
    return "<ul>" + "".join(f'<li><a href="/{i}">Topic {i}</a></li>' for i in range(n)) + "</ul>"


_NAV = _d("nav", "", _menu())
_FOOT = _d("footer", "", "&copy; Some site &middot; All rights reserved for ever by the site.")
_BODY = f"<h1>A headline</h1><p>{_LONG}</p><p>Short.</p><p>{_WORDS}</p>"
_LIST = f"<p>{_LONG}</p><ul><li>First point</li><li>Second point of the list.</li></ul><blockquote><p>{_LONG}</p></blockquote>"
_TABLE = "<table><tr><th>Year</th><th>Value</th></tr><tr><td>1999</td><td>12</td></tr></table>"
_COMMENTS = _d("section", 'class="comments" id="comments"', f'<h2>Comments</h2><div class="comment"><p>{_LONG}</p></div><div class="comment"><p>Nice one!</p></div>')
_FORM = _d("form", 'class="newsletter" action="/s"', "<label>Your mail address</label><button>Subscribe now</button>")
_AD = _d("div", 'class="ad"', f"{_LONG}")
_COOKIE = _d("div", 'class="cookie-notice" role="alert"', f"<p>We use cookies. {_LONG}</p><button>Accept</button>")
_ASIDE = _d("aside", 'class="sidebar"', f"<h2>Related</h2><p>{_LONG}</p>{_menu()}")
_HEADER = _d("header", 'class="site-header"', f'<div class="logo">The site</div>{_menu(2)}')

PAGES = [
    f"<html><body>{_NAV}{_AD}<article>{_BODY}</article>{_FOOT}</body></html>",
    f"<html><body>{_NAV}{_AD}<article>{_BODY}<p><b>{_WORDS}<br><p>{_LONG}<p>End.</article>{_FOOT}</body></html>",
    f"<html><body>{_HEADER}<main><article>{_BODY}{_LIST}</article>{_COMMENTS}</main>{_ASIDE}{_FOOT}</body></html>",
    f"<html><body>{_COOKIE}{_HEADER}{_NAV}<article><header><h1>Headline</h1><p>An introduction.</p></header>{_LIST}{_TABLE}</article>{_FORM}{_FOOT}</body></html>",
    f'<html><body>{_d("div", "id=menu", _menu())}<div class="post-content">{_BODY}{_LIST}</div>{_d("div", "class=sidebar", f"<p>{_LONG}</p>" + _menu())}'
    f'{_d("div", "id=footer", f"<p>{_LONG}</p>")}</body></html>',
    f'<html><body>{_d("div", "class=top-nav", _menu())}<div id="content"><div class="story">{_BODY}</div>{_d("div", "class=share-buttons", "<p>Share this</p>" + _menu(3))}</div>'
    f'{_d("div", "class=comments-list", f"<p>{_LONG}</p><p>{_LONG}</p>")}{_d("div", "class=copyright", "All rights reserved.")}</body></html>',
    f'<html><body>{_d("header", "", "<h2>The site</h2>" + _menu())}<main>{_BODY}{_d("div", "class=advert", f"<p>{_LONG}</p>")}<p>{_LONG}</p></main>{_ASIDE}{_FOOT}</body></html>',
    f'<html><body><article>{_BODY}{_d("aside", "", f"<p>{_LONG}</p>")}<p>{_LONG}</p>{_d("footer", "", "Written by someone, filed under things.")}</article></body></html>',
    f'<html><body>{_d("div", "class=banner", "Buy this now, it is cheap and good.")}<section class="main"><h2>Part</h2>{_LIST}</section>'
    f'{_d("section", "class=related", f"<h2>More</h2><p>{_LONG}</p>")}{_d("form", "", "<p>Find</p><button>Search</button>")}</body></html>',
    f'<html><body>{_d("div", "class=breadcrumb", _menu(3))}<div>{_BODY}</div><div>{_LIST}</div>{_d("div", "class=reader-comments", f"<div><p>{_LONG}</p></div><div>{_WORDS}</div>")}</body></html>',
    f'<html><body>{_d("div", "class=modal hidden", f"<p>{_LONG}</p><button>Close</button>")}{_d("nav", "", "<p>Home</p>")}<div class="entry">{_BODY}{_TABLE}</div>'
    f'{_d("section", "id=discussion class=replies", f"<article><p>{_LONG}</p></article><article><p>{_LONG}</p></article>")}</body></html>',
    f"<p>{_LONG}</p><p>{_WORDS}</p><div>{_LONG}</div>",
    f"{_LONG}",
    f"<html><body><div><div><p>{_LONG}</p></div></div><pre>some code here</pre><dl><dt>Term</dt><dd>What it means.</dd></dl><figure><figcaption>A picture of it</figcaption></figure></body></html>",
    f'<html><body>{_NAV}<article>{_BODY}{_d("div", "class=subscribe", f"<p>{_LONG}</p>")}{_LIST}{_d("div", "class=notice", f"{_WORDS}")}</article>{_COMMENTS}{_d("aside", "", f"{_LONG}")}{_FOOT}</body></html>',
    f'<html><body>{_d("menu", "", "<li>Copy</li><li>Paste</li>")}{_d("dialog", "", f"<p>{_LONG}</p>")}<main><h1>Title here</h1><section><p>{_LONG}</p></section></main>'
    f'{_d("div", "class=sponsored", f"<p>{_LONG}</p>")}{_d("div", "class=popup", f"<p>{_WORDS}</p>")}</body></html>',
    f'<html><body><article>{_BODY}</article>{_d("div", "class=promo", f"<h2>Offer</h2><p>{_LONG}</p>")}{_d("aside", "id=widgets", _menu())}{_d("footer", "class=site-footer", f"<p>{_LONG}</p>" + _menu())}</body></html>',
    f'<html><body><div id="wrapper"><div class="container"><div class="row">{_NAV}<div class="col"><div><div><div>{_BODY}{_LIST}</div></div></div></div>{_ASIDE}</div></div></div>{_FOOT}</body></html>',
    f"<html><body>{'<div>' * 12}{_BODY}{_TABLE}{'</div>' * 12}{_FOOT}</body></html>",
    f"<html><body>{_NAV}<section><section><h2>Part</h2><p>{_LONG}</p><div>{_WORDS}</div></section></section>{_AD}</body></html>",
]
