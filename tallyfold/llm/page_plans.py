"""Labelled training pages: page plans filled with invented words, in many markups."""

from __future__ import annotations

import random
from collections.abc import Iterator

# Words that sites use to name the parts of their pages, and words of those parts.
CLASSES = {
    "menu": "nav menu navbar navigation main-menu topnav mega-menu site-nav primary-nav breadcrumb breadcrumbs tabs pagination pager toc skip-link nav-links language-switcher".split(),
    "header": "header masthead site-header top-bar topbar branding logo page-header tagline hero-banner".split(),
    "footer": "footer site-footer page-footer bottom copyright colophon legal imprint footer-links credits".split(),
    "sidebar": "sidebar aside side rail right-col secondary widget related recommended more-stories trending popular tags author-box related-posts most-read teaser promo-list".split(),
    "notice": "notice cookie cookie-banner consent gdpr alert message modal popup overlay privacy-notice banner disclaimer age-gate announcement".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo ad-slot dfp banner-ad adsbygoogle affiliate ad-container commercial".split(),
    "form": "form newsletter subscribe signup login search search-box contact-form mailing-list poll survey register".split(),
    "share": "share social share-buttons social-links follow sharing likes meta-actions print-link".split(),
    "comments": "comments comment comment-list comment-body discussion replies reply disqus respond reader-comments user-comment responses feedback".split(),
    "article": "article post entry content post-content entry-content article-body story story-body main-content text body-text prose page-content blog-post article-text".split(),
    "plain": "wrapper container row col inner outer block section grid layout box page wrap main-wrap clearfix".split(),
}
WORDS = {
    "menu": "home about contact news blog products services archive login help faq search menu next previous page".split(),
    "header": "welcome the daily site official online magazine since your source skip to content".split(),
    "footer": "© copyright all rights reserved privacy policy terms of use imprint sitemap contact powered by".split(),
    "sidebar": "related articles popular posts read more recent you may also like tags categories trending author".split(),
    "notice": "we use cookies to improve your experience accept decline settings this site uses javascript please enable".split(),
    "advert": "advertisement sponsored buy now free shipping sale offer discount click here save today only".split(),
    "form": "enter your email subscribe newsletter name password submit sign up log in forgot search required field".split(),
    "share": "share tweet facebook email print copy link whatsapp follow us".split(),
    "comments": "reply says ago comment posted thanks great post i agree likes report permalink anonymous".split(),
}
OWN_TAG = {"menu": ["nav", "ul", "div", "ol"], "header": ["header", "div"], "footer": ["footer", "div"], "sidebar": ["aside", "div", "section"], "notice": ["div", "section", "dialog", "p"], "advert": ["div", "aside", "section"], "form": ["form", "div", "section"], "share": ["div", "ul"], "comments": ["section", "div", "ol"]}
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve et ue en que la el os ción ment ung ich sch über ge ver ä ö é è ê ñ ó".split()


class Plan:
    def __init__(self, rng: random.Random):
        self.rng, self.apart = rng, random.Random(rng.getstate()[1][7])
        self.pool = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(300)]
        self.noise = ["", "%%%", "###", "***", "$$$", "&amp;&amp;&amp;"] if rng.random() < 0.12 else [""]
        self.bars = rng.random() < 0.15  # articles of words between bars, as tables and lists leave them
        self.kinds: list[str] = []
        self.bare = self.apart.random() < 0.18  # a page whose parts have no telling names: words, links and places decide

    def some(self, xs):
        return self.rng.choice(xs)

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def words(self, kind: str, lo: int, hi: int) -> str:
        own = WORDS.get(kind)
        out = [self.some(own) if own and self.chance(0.7 if self.bare else 0.5 if self.named else 0.35) else self.some(self.pool) + self.some(self.noise) for _ in range(self.rng.randint(lo, hi))]
        if kind == "article":
            if self.bars and self.chance(0.6):
                return " | ".join(out) + self.some(["", " |"])
            if self.chance(0.04):
                out.insert(0, self.some(["192.168.17.240", "+1 555 0137", "12,5", "a.b@example.com", "(c)", "2019-05-17", "§ 4", "http://example.org/x"]))
            if self.chance(0.04):
                out = [w for w in out[:6] for _ in range(self.rng.randint(4, 20))]
        return " ".join(out)

    def sentences(self, kind: str, lo: int, hi: int) -> str:
        out = []
        for _ in range(self.rng.randint(lo, hi)):
            s = self.words(kind, 1, 22)
            out.append(s[:1].upper() + s[1:] + self.some([".", ".", ".", "!", "?", "&hellip;"]))
        text = " ".join(out)
        if self.chance(0.15):
            at = text.split(" ")
            k = self.rng.randrange(len(at))
            at[k] = self.some(['<a href="/x">{}</a>', "<b>{}</b>", "<em>{}</em>", "<strong>{}</strong>", "<span>{}</span>", "{}<br>"]).format(at[k])
            text = " ".join(at)
        return text

    def mark(self, kind: str) -> str:
        """A marker that tells a block's kind; taken out again before the vectors are made."""
        self.kinds.append(kind)
        return f"\x02{len(self.kinds) - 1}\x03"

    def attr(self, kind: str) -> str:
        if self.bare:
            return f' class="{self.some(CLASSES["plain"])}"' if self.chance(0.3) else ""
        if not self.chance(0.85 if kind != "article" else 0.6):
            return ""
        names = [self.some(CLASSES[kind])]
        if self.chance(0.25):
            names.append(self.some(CLASSES["plain"]))
        if self.chance(0.15):
            names[0] += self.some(["-1", "__inner", "Wrapper", "-container", "_block"])
        return f' {self.some(["class", "class", "class", "id"])}="{" ".join(names)}"'

    def block(self, tag: str, kind: str, text: str, attr: str = "") -> str:
        end = "" if tag in ("p", "li") and self.chance(0.08) else f"</{tag}>"
        open_ = self.some(["", "", "", "", "", "<b>", "<span>"]) if tag == "p" else ""
        return f"<{tag}{attr}>{open_}{self.mark(kind)}{text}{self.some(['', '', '', '<br>'])}{end}"

    def links(self, kind: str, lo: int, hi: int) -> str:
        style = self.some(["li", "li", "div", "a", "p"])
        out = []
        for _ in range(self.rng.randint(lo, hi)):
            a = f'<a href="/{self.some(self.pool)}">{self.words(kind, 1, 4)}</a>'
            out.append(f"<{style}>{self.mark(kind)}{a}</{style}>" if style != "a" else a)
        if style == "a":
            return self.mark(kind) + self.some([" ", " | ", " &middot; "]).join(out)
        return ("<ul>" + "".join(out) + "</ul>") if style == "li" else "".join(out)

    def other(self, kind: str, inside: bool = False) -> str:
        self.named = self.chance(0.8)
        tag = self.some([t for t in OWN_TAG[kind] if t in ("div", "ul", "p")]) if self.bare else self.some(OWN_TAG[kind])
        attr = self.attr(kind) if tag in ("div", "p", "section", "ul", "ol") or self.chance(0.5) else ""
        if not self.bare and tag in ("div", "p", "section", "ul", "ol") and not attr and (inside or not self.named or self.chance(0.5)):
            attr = f' class="{self.some(CLASSES[kind])}"'
        if kind == "menu":
            body = self.links(kind, 2, 12)
        elif kind == "header":
            body = self.some([self.block("p", kind, self.words(kind, 1, 6)), self.block("h2", kind, self.words(kind, 1, 4)), self.mark(kind) + self.words(kind, 1, 6)]) + (self.links("menu", 2, 6) if self.chance(0.5) else "")
        elif kind == "footer":
            body = (self.links(kind, 2, 8) if self.chance(0.4) else "") + self.some([self.mark(kind) + "&copy; " + self.words(kind, 1, 8) + " &middot; " + self.sentences(kind, 1, 4), self.block("p", kind, self.sentences(kind, 1, 3)), self.block("div", kind, "&copy; 20" + str(self.rng.randint(10, 29)) + " " + self.words(kind, 2, 10))])
        elif kind == "sidebar":
            body = (self.block("h3", kind, self.words(kind, 1, 4)) if self.chance(0.7) else "") + self.some([self.links(kind, 2, 8), "".join(self.block("p", kind, self.sentences(kind, 1, 3)) for _ in range(self.rng.randint(1, 3))), self.links(kind, 1, 4) + self.block("p", kind, self.sentences(kind, 1, 2))])
        elif kind == "form":
            body = self.some(["", self.block("h3", kind, self.words(kind, 1, 4))]) + self.some([self.block("p", kind, self.sentences(kind, 1, 2)), self.block("div", kind, f"<label>{self.words(kind, 1, 3)}</label><input name=x>"), self.mark(kind) + self.words(kind, 2, 6) + ' <input type="text">']) + self.some(["", f"<button>{self.words(kind, 1, 2)}</button>"])
        elif kind == "comments":
            body = (self.block("h3", kind, self.words(kind, 1, 3)) if self.chance(0.7) else "")
            inner = self.some(["li", "div", "li", "div", "div" if self.bare else "article"])
            if inner == "article" and not attr:  # nothing else would tell such comments from an article
                attr = f' class="{self.some(CLASSES[kind])}"'
            for _ in range(self.rng.randint(1, 5)):
                c = f' class="{self.some(CLASSES["comments"])}"' if inner == "article" or (not self.bare and self.chance(0.7)) else ""
                body += f"<{inner}{c}>" + (self.block("div", kind, self.words(kind, 1, 4), ' class="meta"' if self.chance(0.5) else "") if self.chance(0.6) else "") + self.block("p", kind, self.sentences(kind, *((15, 40) if self.rare(0.05) else (1, 4)))) + f"</{inner}>"
        else:
            body = self.some([self.mark(kind) + self.sentences(kind, 1, 3), self.block("p", kind, self.sentences(kind, 1, 3)), self.block("div", kind, self.words(kind, 1, 10)), self.links(kind, 1, 4)])
        if tag == "p":
            return self.block("p", kind, self.sentences(kind, 1, 3), attr)
        if self.rare(0.15):
            body += self.inset(kind)
        if tag not in ("ul", "ol") and self.rare(0.12):
            body = self.deep(body)
        return f"<{tag}{attr}>{body}</{tag}>"

    def rare(self, p: float) -> bool:
        """Drawn apart, so that the rest of a page is as it would be without."""
        return self.apart.random() < p

    def deep(self, inner: str) -> str:
        """``inner`` in 10 to 40 plain wrappers."""
        n = self.apart.randint(10, 40)
        return "".join(self.apart.choice(["<div>", f'<div class="{self.apart.choice(CLASSES["plain"])}">']) for _ in range(n)) + inner + "</div>" * n

    def extra(self, kind: str) -> str:
        """What articles hold besides paragraphs: captions, definitions, folded parts, formulas, lines of a poem."""
        pick = self.apart.randrange(6)
        if pick == 0:
            return "<figure><img src=x>" + self.block("figcaption", kind, self.sentences(kind, 1, 2)) + "</figure>"
        if pick == 1:
            return "<dl>" + "".join(self.block("dt", kind, self.words(kind, 1, 3)) + self.block("dd", kind, self.sentences(kind, 1, 2)) for _ in range(2)) + "</dl>"
        if pick == 2:
            return "<details>" + self.block("summary", kind, self.words(kind, 1, 5)) + self.block("p", kind, self.sentences(kind, 1, 3)) + "</details>"
        if pick == 3:
            return self.block("p", kind, self.words(kind, 2, 9) + " <math><mi>x</mi><mo>=</mo><mn>2</mn></math> " + self.sentences(kind, 1, 2))
        if pick == 4:
            return "<table>" + self.block("caption", kind, self.words(kind, 2, 8)) + "<tr>" + "".join(self.block("th", kind, self.words(kind, 1, 2)) for _ in range(2)) + "</tr></table>"
        return "<ol>" + "".join(self.block("li", kind, self.words(kind, 2, 9)) for _ in range(3)) + "</ol>"

    def inset(self, kind: str) -> str:
        """Buttons, choices and what stands in for media: never article text."""
        name = self.apart.choice(["button", "select", "video", "audio", "canvas", "object"])
        words = self.apart.choice([self.words("form", 1, 3), "your browser does not support this " + name, "please update your browser", "copy", "download"])
        if name == "select":
            return f"<select><option>{self.mark('form')}{words}<option>{self.words('form', 1, 2)}</select>"
        return f"<{name}>{self.mark('notice')}{words}</{name}>"

    def article(self) -> str:
        self.named = False
        tag = "div" if self.bare else self.some(["article", "article", "div", "main", "section", "td"])
        attr = self.attr("article") if tag not in ("article", "main") or self.chance(0.5) else ""
        kind = "article"
        out = []
        if self.chance(0.85):
            out.append(self.block(self.some(["h1", "h1", "h2"]), kind, self.words(kind, 1, 12)))
        lo, hi = self.some([(1, 4), (2, 12), (6, 30)])
        for k in range(self.rng.randint(lo, hi)):
            p = self.rng.random()
            if p < 0.78:
                size = (20, 60) if self.rare(0.04) else self.some([(1, 1), (1, 3), (2, 10)])
                out.append(self.block(self.some(["p", "p", "p", "p", "div"]), kind, self.sentences(kind, *size)))
            elif p < 0.84:
                out.append(self.block(self.some(["h2", "h3"]), kind, self.words(kind, 1, 8)))
            elif p < 0.88:
                out.append("<ul>" + "".join(self.block("li", kind, self.sentences(kind, 1, 2)) for _ in range(self.rng.randint(2, 5))) + "</ul>")
            elif p < 0.91:
                out.append("<blockquote>" + self.block("p", kind, self.sentences(kind, 1, 3)) + "</blockquote>")
            elif p < 0.93:
                out.append("<pre>" + self.mark(kind) + self.words(kind, 3, 20) + "</pre>")
            elif p < 0.95:
                out.append("<table><tr>" + "".join(f"<td>{self.mark(kind)}{self.words(kind, 1, 4)}</td>" for _ in range(3)) + "</tr></table>")
            elif self.rare(0.5):
                out.append(self.extra(kind))
            elif k and p < 0.985:
                out.append(self.other(self.some(["advert", "share", "sidebar", "form", "notice"]), True))
                self.named = False
            if self.rare(0.06):
                out.append(self.inset("notice"))
        end = self.other("share", True) if self.chance(0.3) else ""
        self.named = False
        body = "".join(out) + end
        if self.rare(0.07):
            body = self.deep(body)
        if tag == "td":
            return f"<table><tr><td{attr}>{body}</td></tr></table>"
        return f"<{tag}{attr}>{body}</{tag}>"

    def page(self) -> str:
        top = [k for k, p in (("notice", 0.25), ("header", 0.5), ("menu", 0.85), ("advert", 0.35), ("form", 0.15)) if self.chance(p)]
        if self.chance(0.3):
            self.rng.shuffle(top)
        end = [k for k, p in (("share", 0.2), ("comments", 0.35), ("sidebar", 0.5), ("form", 0.25), ("advert", 0.2), ("menu", 0.15), ("notice", 0.1), ("footer", 0.85)) if self.chance(p)]
        body = [self.other(k) for k in top]
        if self.chance(0.15):
            body.append(self.other("sidebar"))
        if not self.chance(0.03):
            body.append(self.article())
        body += [self.other(k) for k in end]
        sep = self.some(["", "\n", "<!-- x -->", "<script>var a='<p>';</script>"])
        inner = sep.join(body)
        if self.chance(0.4):
            inner = f'<div class="{self.some(CLASSES["plain"])}">{inner}</div>'
        if self.rare(0.04):
            inner = self.deep(inner)
        return f"<!DOCTYPE html><html><head><title>{self.words('x', 1, 5)}</title><style>p{{}}</style></head><body>{inner}" + self.some(["</body></html>", ""])


def labelled_pages(n: int, seed: int) -> Iterator[tuple[list, list[int]]]:
    """Blocks of ``n`` pages with 1 for article text and 0 for all else."""
    import re

    from .html_blstm import read_blocks

    marker = re.compile("\x02(\\d+)\x03")
    for i in range(n):
        plan = Plan(random.Random(f"{seed}:{i}"))
        plan.named = True
        blocks, labels = [], []
        for b in read_blocks(plan.page()):
            kinds = [plan.kinds[int(k)] for k in marker.findall(b.text)]
            b.text = marker.sub("", b.text)
            b.linked = min(b.linked, len(b.text))
            if kinds and b.text.strip():
                b.text = b.text.strip()
                blocks.append(b)
                labels.append(int(kinds[0] == "article"))
        yield blocks, labels
