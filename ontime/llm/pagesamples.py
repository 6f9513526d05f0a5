"""Labelled pages for fitting operator 12: made-up pages whose main text is known.

The pages are composed of parts that web pages commonly have, named the way web authors commonly name them,
with and without telling tags and class names, filled with sentences of random syllables.  Each block of
main text starts with ``MARK``, a private-use character that no other text here holds.
"""

from __future__ import annotations

import random

MARK = ""

# Common element and class names of the parts of a page.
MAIN = "article content main post story entry body text page-content post-content article-body entry-content single primary".split()
MENU = "nav navbar menu navigation main-menu site-nav topnav breadcrumbs breadcrumb links tabs pager toc".split()
HEADER = "header masthead top site-header topbar banner branding logo".split()
FOOTER = "footer bottom site-footer colophon copyright legal credits foot".split()
SIDE = "sidebar aside side rail widget related recommended popular trending secondary teaser more-stories".split()
ADVERT = "ad ads advert advertisement sponsor sponsored promo promoted adbox ad-slot banner-ad commercial".split()
NOTICE = "cookie cookie-notice consent gdpr notice alert popup modal message overlay paywall banner-message".split()
COMMENTS = "comments comment comment-list responses replies discussion disqus reader-comments respond feedback".split()
FORMS = "form newsletter subscribe signup login search search-form contact-form".split()
SHARE = "share social sharing follow tools actions meta tags".split()
PLAIN = "wrap container row col inner box block section group left right center outer c1 x2 module".split()
SYLLABLES = "ba be bi do du fa fe ga go ha hi ja ka ke la le li lo ma me mi mo na ne no nu pa pe ra re ri ro sa se si so ta te ti to un ver wa we za ón é ä ü st nd ck ng".split()
# End of the fixed values.


class _Writer:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.lexicon = ["".join(self.rng.choices(SYLLABLES, k=self.rng.randint(1, 4))) for _ in range(4000)]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def some(self, least: int, most: int) -> range:
        return range(self.rng.randint(least, most))

    def one(self, options: list):
        return self.rng.choice(options)

    def words(self, least: int, most: int) -> str:
        return " ".join(self.rng.choices(self.lexicon, k=self.rng.randint(least, most)))

    def sentences(self, least: int, most: int) -> str:
        out = []
        for _ in self.some(least, most):
            s = self.words(1, 18).capitalize()
            if self.chance(0.4):
                s = s.replace(" ", ", ", 1)
            if self.chance(0.1):
                s = s.replace(" ", " &amp; ", 1)
            if self.chance(0.1):
                s += f" {self.rng.randint(0, 2100)}"
            out.append(s + self.one([".", ".", ".", "!", "?"]))
        return " ".join(out)

    def attributes(self, names: list[str], p: float = 0.8) -> str:
        chosen = [self.one(names)] if self.chance(p) else [self.one(PLAIN)] if self.chance(0.5) else []
        if chosen and self.chance(0.3):
            chosen.append(self.one(PLAIN))
        if not chosen:
            return ""
        name, quote = self.one(["class", "class", "id"]), self.one(['"', '"', "'"])
        return f" {name}={quote}{' '.join(chosen)}{quote}"

    def wrapped(self, tags: list[str], names: list[str], inside: str, p: float = 0.8) -> str:
        tag = self.one(tags)
        if names is not COMMENTS and tag in ("nav", "header", "footer", "aside", "main", "article"):
            p = 0.3  # a telling tag needs no telling name
        return f"<{tag}{self.attributes(names, p)}>{inside}</{tag}>"

    def link(self, least: int = 1, most: int = 3) -> str:
        return f'<a href="/{self.words(1, 1)}">{self.words(least, most)}</a>'

    def link_list(self, most: int = 12, words: int = 3) -> str:
        links = [self.link(1, words) for _ in self.some(2, most)]
        form = self.rng.random()
        if form < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>"
        return self.one([" | ", " ", " &middot; "]).join(links)

    # ---- main text ---------------------------------------------------------------------------------

    def inline(self, text: str) -> str:
        parts = text.split(" ")
        if len(parts) > 3 and self.chance(0.4):
            at = self.rng.randrange(len(parts) - 1)
            tag = self.one(["b", "i", "em", "strong", 'a href="#"', "span"])
            parts[at] = f"<{tag}>{parts[at]}" + ("" if self.chance(0.15) and tag in ("b", "i") else f"</{tag.split()[0]}>")
        return " ".join(parts)

    def paragraph(self) -> str:
        text = self.inline(self.sentences(1, 1) if self.chance(0.25) else self.sentences(1, 7))
        if self.chance(0.12):
            text = self.words(1, 2) + "."
        form = self.rng.random()
        if form < 0.75:
            return f"<p>{MARK}{text}" + ("" if self.chance(0.1) else "</p>")
        if form < 0.82:
            return f"<div>{MARK}{text}</div>"
        if form < 0.86:
            return f"<blockquote>{MARK}{text}</blockquote>"
        if form < 0.9:
            return f"<h{self.one(['2', '3'])}>{MARK}{self.words(1, 7)}</h3>"
        if form < 0.95:
            tag = self.one(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{MARK}{self.inline(self.sentences(1, 2) if self.chance(.6) else self.words(1, 5))}</li>" for _ in range(4)) + f"</{tag}>"
        if form < 0.97:
            return "<table>" + "".join(f"<tr><td>{MARK}{self.words(1, 3)}</td><td>{MARK}{self.rng.randint(0, 999)}</td></tr>" for _ in range(3)) + "</table>"
        return f"<figure><img src='x.jpg'><figcaption>{MARK}{self.words(3, 12)}.</figcaption></figure>"

    def article(self) -> str:
        parts = [self.paragraph() for _ in range(self.one([1, 2, 4, 8, 16]))]
        for extra in (self.advert, self.share, self.newsletter, self.related, self.notice):
            if self.chance(0.12):
                parts.insert(self.rng.randint(0, len(parts)), extra())
        if self.chance(0.8):
            parts.insert(0, f"<h1>{MARK}{self.words(2, 10)}</h1>")
        inside = "".join(parts)
        if self.chance(0.5):
            inside = self.wrapped(["div", "section"], MAIN, inside, 0.6)
        return self.wrapped(["article", "main", "div", "div", "section", "td"], MAIN, inside, 0.65)

    # ---- the rest ----------------------------------------------------------------------------------

    def menu(self) -> str:
        return self.wrapped(["nav", "nav", "div", "ul", "header"], MENU, self.link_list())

    def page_header(self) -> str:
        inside = f"<h1>{self.words(1, 3)}</h1>" if self.chance(0.4) else f"<div>{self.link()}</div>"
        if self.chance(0.5):
            inside += f"<p>{self.words(2, 8)}</p>"
        if self.chance(0.4):
            inside += self.menu()
        return self.wrapped(["header", "div"], HEADER, inside, 1.0)

    def page_footer(self) -> str:
        inside = f"&copy; {self.rng.randint(1995, 2030)} {self.words(1, 3)}"
        inside += self.one([" &middot; ", ". ", "<br>"]) + (self.sentences(1, 2) if self.chance(0.5) else self.link_list(6))
        return self.wrapped(["footer", "footer", "div"], FOOTER, f"<p>{inside}</p>" if self.chance(0.4) else inside, 1.0)

    def advert(self) -> str:
        inside = self.sentences(1, 3) if self.chance(0.7) else self.link(2, 6)
        return self.wrapped(["div", "div", "aside", "section", "p"], ADVERT, inside, 1.0)

    def share(self) -> str:
        return self.wrapped(["div", "ul", "p"], SHARE, self.link_list(6, 1), 1.0)

    def related(self) -> str:
        items = "".join(f"<li>{self.link(3, 9)}{' ' + self.sentences(1, 2) if self.chance(0.4) else ''}</li>" for _ in range(4))
        return self.wrapped(["aside", "div", "section"], SIDE, f"<h3>{self.words(1, 3)}</h3><ul>{items}</ul>", 1.0)

    def sidebar(self) -> str:
        inside = "".join(self.one([self.related, self.advert, self.newsletter, self.text_box])() for _ in self.some(1, 3))
        return self.wrapped(["aside", "aside", "div", "section"], SIDE, inside, 1.0)

    def text_box(self) -> str:
        return f"<h4>{self.words(1, 3)}</h4><p>{self.sentences(1, 3)}</p>"

    def notice(self) -> str:
        inside = self.sentences(1, 3) + ("<button>OK</button>" if self.chance(0.5) else self.link(1, 2))
        return self.wrapped(["div", "div", "section", "aside", "p"], NOTICE, f"<p>{inside}</p>" if self.chance(0.4) else inside, 1.0)

    def newsletter(self) -> str:
        fields = "".join(f"<label>{self.words(1, 3)}</label><input name=x>" for _ in self.some(1, 3))
        inside = f"<p>{self.sentences(1, 2)}</p>{fields}<textarea>{self.words(2, 9)}</textarea><select><option>{self.words(1, 2)}</select><button>{self.words(1, 2)}</button>"
        return f"<form{self.attributes(FORMS, 0.6)}>{inside}</form>" if self.chance(0.8) else self.wrapped(["div"], FORMS, inside, 1.0)

    def comments(self) -> str:
        one = [f"{self.one(['<b>', '<cite>', '<p>'])}{self.words(1, 2)} {self.rng.randint(1, 28)} {self.words(1, 1)}</b><p>{self.sentences(1, 6)}</p>"
               for _ in self.some(1, 8)]
        tag = self.one(["div", "li", "article", "section"])
        inside = "".join(f"<{tag}{self.attributes(COMMENTS, 0.7)}>{c}</{tag}>" for c in one)
        return self.wrapped(["section", "div", "ol", "aside"], COMMENTS, f"<h3>{self.words(1, 3)}</h3>{inside}", 1.0)

    def page(self) -> str:
        form = self.rng.random()
        if form < 0.03:
            return f"{MARK}{self.sentences(1, 8)}"
        if form < 0.08:
            body = "".join(self.paragraph() for _ in range(5))
        else:
            before = [self.one([self.menu, self.page_header, self.notice, self.advert])() for _ in self.some(0, 4)]
            after = [part() for part, p in ((self.related, .3), (self.comments, .4), (self.share, .2), (self.newsletter, .25), (self.sidebar, .4),
                                            (self.advert, .2), (self.notice, .2), (self.menu, .2)) if self.chance(p)]
            middle = self.article()
            if self.chance(0.3):
                middle = self.wrapped(["div", "section", "main"], PLAIN + MAIN, middle + "".join(after))
                after = []
            if self.chance(0.3):
                before.append(self.sidebar())
            body = "".join([*before, middle, *after]) + (self.page_footer() if self.chance(0.8) else "")
            if self.chance(0.3):
                body = self.wrapped(["div"], PLAIN, body)
        script = "<script>var a='</p>';</script><style>p{}</style>" if self.chance(0.6) else ""
        out = f"<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title>{script}</head><body>{body}"
        out += "" if self.chance(0.1) else "</body></html>"
        return out.upper().replace("&AMP;", "&amp;").replace("&COPY;", "&copy;").replace("&MIDDOT;", "&middot;") if self.chance(0.03) else out


def labelled_pages(n: int, seed: int) -> list[str]:
    """``n`` pages; the blocks of their main text start with ``MARK``."""
    writer = _Writer(seed)
    return [writer.page() for _ in range(n)]
