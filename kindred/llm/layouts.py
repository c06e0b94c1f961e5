"""Generated page layouts with known labels, which the block labeller is trained on.

Prose is invented words among the function words of four languages. Menus, notices, adverts and
the like take most of their words from lists of their kind, and stand under telling names or under
neutral ones, so that path, words and neighbours all carry part of the answer.
"""

from __future__ import annotations

import numpy as np

from kindred.llm.markup import SPACES, Block

# Names that sites give to parts of their pages.
CONTENT = "content post entry story text body main article page single blog news detail prose copy markdown richtext".split()
ASIDE = (
    "nav navbar menu menubar header masthead topbar footer bottom sidebar aside rail widget breadcrumb breadcrumbs cookie cookies consent notice banner alert "
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion newsletter subscribe signup login form search share sharing social related recommended more "
    "comment comments reply replies discussion respond disqus copyright legal popup modal overlay toolbar pager pagination tags meta author bio skip links archive categories"
).split()
SUFFIX = ["", "", "box", "wrapper", "container", "section", "area", "list", "block", "inner"]

# Words of the parts of a page that are no article, by kind, in English, German, French and Spanish.
KINDS = {
    "menu": "home about contact blog shop products services login register account archive sitemap careers help faq categories menu startseite kontakt produkte anmelden suche accueil connexion produits inicio contacto nosotros buscar".split(),
    "notice": "we use cookies to improve your experience on this website accept decline all preferences privacy policy consent settings wir verwenden cookies zustimmen ablehnen datenschutz nous utilisons des cookies accepter refuser confidentialité usamos aceptar rechazar privacidad".split(),
    "form": "subscribe to our newsletter sign up enter your email address name password submit send join weekly inbox free updates abonnieren newsletter absenden passwort inscrivez vous suscríbete correo enviar".split(),
    "advert": "buy now sale off discount shipping offer deal limited sponsored advertisement order save today click here price best anzeige angebot kaufen publicité annonce offre promo oferta publicidad comprar".split(),
    "footer": "copyright all rights reserved terms conditions privacy imprint powered by impressum rechte vorbehalten droits réservés mentions légales derechos reservados aviso legal".split(),
    "share": "share tweet facebook twitter follow us like print pin related posts read more recommended you may also next previous comments reply says posted teilen folgen mehr lesen partager suivez lire aussi compartir síguenos leer más".split(),
}
FUNCTION = "the of and to in is that it was for on with as be at by this from or an der die das und ist nicht ein zu den mit von sich auf le la les de et un une est que pour dans el los las y en por con para del se".split()
NEUTRAL = ["div", "div", "section", "div css x", "div sc ab", "div col", "div row", "div w f", "span", "p"]
LETTERS = np.array([*"abcdefghijklmnopqrstuvwxyzéäöüñß"], "<U1")


class Writer:
    """Draws one page: its blocks and their labels."""

    def __init__(self, random):
        self.r = random
        self.junk = random.random() < 0.2
        self.out: list[Block] = []
        self.labels: list[int] = []

    def one(self, some: list):
        return some[int(self.r.integers(len(some)))]

    def sentence(self, low: int, high: int, kind: str | None = None, share: float = 0.75) -> str:
        """Words of a kind with a few others; without a kind, prose with a stray word of some kind."""
        r = self.r
        n = int(r.integers(low, high))
        ends = np.cumsum(r.integers(1, 12, n)).tolist()
        drawn = LETTERS[r.integers(0, len(LETTERS), ends[-1])].tobytes().decode("utf-32-le")
        words = [drawn[a:b] for a, b in zip([0, *ends], ends)]
        listed = KINDS[kind or self.one(list(KINDS))]
        draw = r.random(n).tolist()
        limit = share if kind else 0.02
        common = limit + (0.1 if kind else 0.3 if low < high - 5 else 0.1)
        words = [self.one(listed) if d < limit else self.one(FUNCTION) if d < common else w for w, d in zip(words, draw)]
        if self.junk:
            words = [w + ["###", "***", "&&&", "!!", " |"][k] for w, k in zip(words, r.integers(0, 5, n).tolist())]
        else:
            words = [w + ("," if c else "") for w, c in zip(words, (r.random(n) < 0.08).tolist())]
        return " ".join(words).capitalize() + self.one([".", ".", ".", "", "!", "?"])

    def named(self, tag: str, names: list[str], some: float) -> str:
        if tag in ("div", "section", "ul", "table", "td", "span") or self.r.random() < some:
            extra = [self.one(names)]
            if self.r.random() < 0.4:
                extra.append(self.one(SUFFIX))
            return " ".join([tag, *(e for e in extra if e)])
        return tag

    def put(self, path, text: str, label: int, linked: bool = False) -> None:
        text = SPACES.sub(" ", text).strip()
        if text:
            self.out.append(Block(tuple(path), text, len(text) if linked else 0))
            self.labels.append(label)

    def aside(self, base: list[str], deep: bool = False) -> None:
        """A part that is no article, under telling names and any words, or under neutral names and telling words."""
        r = self.r
        if r.random() < 0.25:
            kind = self.one(list(KINDS))
            path = [*base, self.one(NEUTRAL[2:8] if deep else NEUTRAL)]  # a bare paragraph of an article is part of it
            for _ in range(int(r.integers(1, 4))):
                self.put([*path, "p"] if r.random() < 0.4 and path[-1] != "p" else path, self.sentence(3, 30, kind, 0.85), 0, r.random() < 0.15)
            return
        tag, names = self.one([["nav", ["menu", "nav", "navbar"]], ["header", ["header", "masthead"]], ["footer", ["footer", "copyright"]], ["aside", ["sidebar", "widget"]], ["form", ["form", "login", "search"]], ["div", ASIDE], ["div", ASIDE], ["section", ASIDE], ["ul", ASIDE], ["table", ASIDE]])
        if tag == "header" and deep:
            tag, names = "div", ASIDE
        path = [*base, self.named(tag, names, 0.3)]
        if r.random() < 0.3:
            path.append(self.one(["div", "div inner", "div wrapper", "section"]))
        kind = None if r.random() < 0.6 else self.one(list(KINDS))  # any words may stand under a telling name
        shape = r.random()
        for _ in range(int(r.integers(1, 8 if shape < 0.5 else 4))):
            if shape < 0.45:
                self.put([*path, "ul", "li"] if "ul" not in path[-1] else [*path, "li"], self.sentence(1, 4, kind and "menu"), 0, True)
            elif shape < 0.75:
                self.put(path if r.random() < 0.5 else [*path, "p"], self.sentence(2, 30, kind), 0, r.random() < 0.2)
            else:
                self.put([*path, self.one(["p", "h3", "h4", "blockquote", "div text", "div body", "div content", "article", "td"])], self.sentence(3, 50, kind), 0)

    def article(self, base: list[str]) -> None:
        r = self.r
        shape = r.random()
        if shape < 0.5:
            inside = [*base, self.named(self.one(["article", "main"]), CONTENT, 0.3)]
            if r.random() < 0.3:
                inside.append(self.named(self.one(["article", "section", "div"]), CONTENT, 0.5))
        elif shape < 0.88:
            inside = [*base, self.named(self.one(["div", "section", "td"]), CONTENT, 1)]
        else:
            inside = [*base, self.one(NEUTRAL[:7])]
        if r.random() < 0.85:
            self.put([*inside, *(["header"] if r.random() < 0.15 else []), self.one(["h1", "h1", "h2"])], self.sentence(1, 10), 1)
        for _ in range(int(r.integers(1, 14))):
            k = r.random()
            if k < 0.72:
                self.put([*inside, "p"], " ".join(self.sentence(1, 40) for _ in range(int(r.integers(1, 5)))), 1, r.random() < 0.03)
            elif k < 0.80:
                self.put([*inside, self.one(["h2", "h3", "h4"])], self.sentence(1, 8), 1)
            elif k < 0.88:
                for _ in range(int(r.integers(1, 5))):
                    self.put([*inside, self.one(["ul", "ol"]), "li"], self.sentence(1, 15), 1, r.random() < 0.1)
            elif k < 0.93:
                self.put([*inside, self.one(["blockquote", "pre", "figure", "figcaption", "dl", "div", "section"])] + (["p"] if r.random() < 0.5 else []), self.sentence(2, 30), 1)
            elif k < 0.96:
                for _ in range(int(r.integers(1, 5))):
                    self.put([*inside, "table", "tbody", "tr", "td"], self.sentence(1, 5), 1)
            else:
                self.aside(inside, True)
        for _ in range(int(r.integers(0, 3))):
            self.put([*inside, "p"], self.sentence(1, 6, self.one(list(KINDS)) if r.random() < 0.2 else None), 1)
        for _ in range(int(r.integers(0, 2))):
            self.aside(inside, True)


def laid_out(random) -> tuple[list[Block], list[int]]:
    """One generated page: blocks and labels."""
    page = Writer(random)
    base = ["html", "body"]
    if random.random() < 0.5:
        base.append(page.one(["div", "div wrapper", "div page", "div container", "div site", "div id root"]))
    for _ in range(int(random.integers(0, 4))):
        page.aside(base)
    page.article(base)
    for _ in range(int(random.integers(0, 4))):
        page.aside(base)
    return page.out, page.labels
