"""Pages of many layouts, made from given texts, whose blocks are known to be main text or not.

Landmark tags are rare on real pages; the layouts put the same texts under the names that page
authors use for their parts, under other names, and under none. They only serve for training.
"""

from __future__ import annotations

import numpy as np

# Names of page parts in class and id attributes.
MAIN = "content article post entry story text main body page copy prose single news blog document read".split()
BOILERPLATE = {
    "menu": "nav navbar navigation menu topnav breadcrumb breadcrumbs pagination tabs toc links skip subnav".split(),
    "header": "header masthead topbar logo branding banner top site tagline".split(),
    "footer": "footer copyright colophon legal bottom credits imprint disclaimer contentinfo".split(),
    "sidebar": "sidebar side aside widget related recommended trending popular more teaser rail recent archive complementary".split(),
    "notice": "cookie cookies notice consent gdpr alert popup modal newsletter subscribe paywall message overlay warning privacy".split(),
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion dfp outbrain taboola commercial".split(),
    "form": "form search login signup register contact poll survey feedback field".split(),
    "comments": "comments comment responses discussion disqus replies reply thread reactions respond guestbook".split(),
    "share": "share social follow tags sharing buttons tools rating meta".split(),
}
_LANDMARKS = {
    "menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "notice": "dialog", "advert": "ins",
    "form": "form", "comments": "section", "share": "menu",
}
_JUNK = "wrapper container row col inner outer grid box block clearfix layout section panel area wrap unit left right center js x".split()
_SUFFIX = "content body list inner box wrapper area section block items text title".split()

#: Marks before a block of boilerplate and of main text; of private use, so in no text.
MARKS = ("\ue000", "\ue001")


class Maker:
    def __init__(self, prose: list[str], short: list[str], seed: int):
        self.prose, self.short, self.rng = prose, short, np.random.default_rng(seed)

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def pick(self, given):
        return given[int(self.rng.integers(len(given)))]

    def junk(self) -> str:
        return self.pick(_JUNK) + (f"-{self.rng.integers(13)}" if self.chance(0.4) else "")

    def words(self, main: int, least: int = 1, most: int = 4) -> str:
        return MARKS[main] + self.pick(self.prose if most > 4 else self.short)

    def attributes(self, names: list[str], suffixes: bool = True) -> str:
        name = self.pick(names)
        if suffixes and self.chance(0.4):
            name += self.pick(["-", "_", "__"]) + self.pick(_SUFFIX)
        elif self.chance(0.15):
            name = self.pick(["js", "x", "the", "site", "m"]) + "-" + name
        if self.chance(0.15):
            name = name.title().replace("-", "").replace("_", "")
        if self.chance(0.3):
            name += " " + self.junk()
        return f' {self.pick(["class", "class", "class", "id", "id", "role"])}="{name}"'

    def wrapped(self, inside: str, bare: bool) -> str:
        while self.chance(0.3):
            inside = f"<div{'' if bare or self.chance(0.3) else f' class="{self.junk()}"'}>{inside}</div>"
        return inside

    def paragraph(self, main: int) -> str:
        text = self.words(main, most=9)
        return self.pick([f"<p>{text}</p>"] * 4 + [f"<p>{text}", f"<p><b>{text}<br>", f"<div>{text}</div>", f"<p>{text} <a href='/x'>{self.pick(self.short)}</a></p>"])

    def heading(self, least: int) -> str:
        """A heading that is not main text."""
        level = self.rng.integers(least, 7)
        return f"<h{level}>{self.words(0)}</h{level}>"

    def body(self, bare: bool) -> str:
        """Main text with headings, lists, tables and quotations."""
        out = [f"<h1>{self.words(1)}</h1>"] if self.chance(0.7) else []
        if out and self.chance(0.2) and not bare:
            out = [f"<header>{out[0]}</header>"]
        for _ in range(int(self.rng.integers(1, 9))):
            kind = self.rng.random()
            if kind < 0.68 or bare:
                out.append(self.paragraph(1))
            elif kind < 0.78:
                out.append(f"<h{self.rng.integers(2, 5)}>{self.words(1)}</h2>")
            elif kind < 0.84:
                out.append("<ul>" + "".join(f"<li>{self.words(1, most=self.pick([4, 9]))}" for _ in range(self.rng.integers(1, 5))) + "</ul>")
            elif kind < 0.89:
                out.append(f"<blockquote>{self.paragraph(1)}</blockquote>")
            elif kind < 0.93:
                row = lambda: "<tr>" + "".join(f"<td>{self.words(1)}</td>" for _ in range(2))
                out.append(f"<table>{row()}{row()}</table>")
            elif kind < 0.96:
                out.append(f"<pre>{self.words(1)}</pre>")
            else:
                out.append(f"<figure><figcaption>{self.words(1)}</figcaption></figure>")
        return "".join(out)

    def part(self, kind: str, bare: bool) -> str:
        """One part of a page that is not main text."""
        links = lambda: "".join(f"<li><a href='/y'>{self.words(0)}</a></li>" for _ in range(self.rng.integers(2, 8)))
        if bare:
            return f"<div><ul>{links()}</ul></div>"
        if kind == "menu":
            inside = self.pick([f"<ul>{links()}</ul>", " | ".join([f"<a href='/z'>{self.words(0)}</a>"] + [f"<a href='/z'>{self.pick(self.short)}</a>"] * 3)])
        elif kind == "form":
            inside = f"<label>{self.words(0)}</label><input name=q><p>{self.words(0, most=self.pick([4, 9]))}</p><button>ok</button>"
        elif kind == "comments":
            one = lambda: self.pick(["<div class='comment'>{}</div>", "<article class='comment'>{}</article>", "<li>{}</li>", "<div>{}</div>"]).format(
                self.heading(2) * self.chance(0.5) + self.paragraph(0)
            )
            inside = self.heading(2) * self.chance(0.6) + "".join(one() for _ in range(self.rng.integers(1, 6)))
        else:
            inside = self.pick(
                [self.words(0), self.words(0, most=9), self.paragraph(0), self.paragraph(0), f"{self.heading(2)}<ul>{links()}</ul>", f"{self.heading(2)}{self.paragraph(0)}"]
            )
        inside = self.wrapped(inside, False)
        if self.chance(0.3 if kind == "header" else 0.15):
            inside = self.heading(1 if kind == "header" else 2) + inside
        landmark = _LANDMARKS[kind]
        if self.chance(0.4) and kind not in ("comments", "notice", "advert", "share"):
            return f"<{landmark}{self.attributes(BOILERPLATE[kind]) if self.chance(0.3) else ''}>{inside}</{landmark}>"
        tag = self.pick(["div", "div", "section", "aside" if kind in ("sidebar", "advert") else "div"])
        return f"<{tag}{self.attributes(BOILERPLATE[kind])}>{inside}</{tag}>"

    def page(self) -> str:
        bare = self.chance(0.12)
        kinds = list(BOILERPLATE)
        pieces = [self.body(bare)]
        for _ in range(int(self.rng.integers(0, 3)) if not bare else 0):  # within the main text
            inner = self.part(self.pick(["advert", "sidebar", "form", "share", "notice", "menu"]), False)
            pieces += [inner, self.body(bare)] if self.chance(0.6) else [inner]
        if not bare and self.chance(0.3):
            pieces.append(self.part(self.pick(["comments", "comments", "footer", "share"]), False))
        main = self.wrapped("".join(pieces), bare)
        if not bare:
            tag = self.pick(["article"] * 4 + ["main", "main", "div", "div", "section", "td"])
            named = tag in ("div", "section", "td") or self.chance(0.3)
            main = f"<{tag}{self.attributes(MAIN) if named else ''}>{main}</{tag}>"
            if tag == "td":
                main = f"<table><tr>{main}</tr></table>"
        before = [self.wrapped(self.part(self.pick(kinds), bare), bare) for _ in range(self.rng.integers(0, 5))]
        after = [self.wrapped(self.part(self.pick(kinds), bare), bare) for _ in range(self.rng.integers(0, 5))]
        whole = self.wrapped("".join([*before, main, *after]), bare)
        return f"<!DOCTYPE html><html><head><title>t</title></head><body>{whole}" + "</body></html>" * self.chance(0.8)
