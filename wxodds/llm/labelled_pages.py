"""Labelled pages for training the main-text extractor.

Each layout is a page of a common kind, written by hand; a block is labelled by the marker before
its text: [+] belongs to the main text, [-] doesn't.  P, T, L and N stand for a paragraph, a title, a
few linked words and a short line; `pages` fills them with sentences, several times for each layout.
The markers are taken out of the text when it is read (see html_extract.training_blocks).
"""
from __future__ import annotations

import random

MAIN, OTHER = "[+]", "[-]"

SENTENCES = (
    "The committee met on Tuesday to review the plans for the old harbour.",
    "Prices rose again, although fewer people than last year had expected it.",
    "Nobody knew exactly where the river had left its former bed.",
    "After the storm, volunteers cleared the road between the two villages.",
    "Die Bibliothek bleibt bis zum Herbst geschlossen, weil das Dach erneuert wird.",
    "Im vergangenen Jahr kamen mehr Besucher als je zuvor.",
    "Les habitants ont attendu longtemps, mais le train n'est jamais parti.",
    "La recette demande peu de temps et presque aucun ingrédient rare.",
    "El museo abrió sus puertas en mayo y cerró poco después.",
    "Según los datos, la cosecha fue mejor de lo previsto.",
    "She wrote three letters; one of them survives.",
    "It works.",
    "Measurements were taken every hour, at four places along the coast, and compared with older ones.",
)
TITLES = ("A harbour changes hands", "Neue Wege am Fluss", "Le marché du samedi", "Cómo se hace el pan", "On measuring rain")
LINKS = ("Home", "About us", "Kontakt", "Archives", "Noticias", "Sport", "Impressum", "Next", "The weather", "Mode")
SHORT = ("Subscribe now", "Buy two, pay one!", "Read more", "Follow us", "Werbung", "By J. Miller", "3 min read",
         "Wir verwenden Cookies.", "All rights reserved.", "Tous droits réservés", "Great article, thanks.",
         "I don't agree with this at all, sorry.", "Sign up for our newsletter.", "Nicht angemeldet.")

MENU = "<nav><ul><li><a href='/'>[-]L</a></li><li><a href='/a'>[-]L</a></li><li><a href='/b'>[-]L</a></li></ul></nav>"
FOOT = "<footer>&copy; [-]example.com &middot; N</footer>"

LAYOUTS = (
    # plain semantic pages
    "<html><head><title>T</title></head><body>" + MENU + "<div class='ad'>[-]P</div><article><h1>[+]T</h1><p><b>[+]P<br>"
    "<p>[+]P</p><p>[+]P</p><p><b>[+]P<br><p>[+]N</p><p>[+]P</p></article><footer>[-]&copy; example.com &middot; P</footer></body></html>",
    "<body>" + MENU + "<div class='ad'>[-]N</div><article><h1>[+]N</h1><p>[+]N</p></article><footer>[-]&copy; P</footer></body>",
    "<body><header><h1>[-]Site</h1>" + MENU + "</header><main><h1>[+]T</h1><p>[+]P</p><h2>[+]T</h2><p>[+]P</p><ul><li>[+]P</li>"
    "<li>[+]N</li><li>[+]N</li></ul><blockquote>[+]P</blockquote><p>[+]P</p></main><aside><h3>[-]N</h3><p>[-]P</p>"
    "<ul><li><a href='#'>[-]L</a></li></ul></aside>" + FOOT + "</body>",
    # an article with things inside it
    "<body>" + MENU + "<article><header><h1>[+]T</h1><p class='byline'>[-]N</p></header><p>[+]P</p><p>[+]P</p>"
    "<div class='advert'><p>[-]P</p></div><p>[+]P</p><aside class='related'><h4>[-]Related</h4><ul><li><a href='/x'>[-]T</a></li>"
    "<li><a href='/y'>[-]T</a></li></ul></aside><p>[+]P</p><div class='share-buttons'><a href='#'>[-]L</a> <a href='#'>L</a></div>"
    "<section class='comments'><h3>[-]2 comments</h3><div class='comment'><p>[-]N</p></div><div class='comment'><p>[-]P</p></div>"
    "</section><footer>[-]N</footer></article>" + FOOT + "</body>",
    "<body><div role='banner'><div>[-]N</div></div><div role='main'><h1>[+]T</h1><p>[+]P</p><form action='/s'><label>[-]N</label>"
    "<p>[-]P</p></form><p>[+]P</p><table><tr><td>[+]N</td><td>[+]N</td></tr></table><p>[+]P</p></div>"
    "<div role='complementary'><p>[-]P</p></div><div role='contentinfo'><p>[-]N</p></div></body>",
    # divisions with classes
    "<body><div id='header'><div class='logo'>[-]N</div><div class='menu'><a href='/'>[-]L</a> <a href='/'>L</a> <a href='/'>L</a></div>"
    "</div><div class='cookie-notice'><p>[-]P</p></div><div id='content'><h1>[+]T</h1><div class='post-body'><p>[+]P</p><p>[+]P</p>"
    "<p>[+]N</p><p>[+]P</p></div></div><div class='sidebar'><div class='widget'><h3>[-]N</h3><p>[-]P</p></div></div>"
    "<div id='comments'><ol><li><p>[-]P</p></li><li><p>[-]N</p></li></ol></div><div id='footer'><p>[-]N</p></div></body>",
    "<body><div class='top-bar'>[-]N</div><div class='sidebar left'><p>[-]P</p><ul><li><a href='/'>[-]L</a></li><li><a href='/'>[-]L</a>"
    "</li></ul></div><div class='entry-content'><h2>[+]T</h2><p>[+]P</p><div class='promo'>[-]N</div><p>[+]P</p><pre>[+]N</pre>"
    "<p>[+]P</p></div><div class='newsletter'><p>[-]N</p><form><p>[-]P</p></form></div><div class='bottom'>[-]&copy; N</div></body>",
    "<body><div class='alert notice'>[-]P</div><div class='breadcrumbs'><a href='/'>[-]L</a> &gt; <a href='/'>L</a></div>"
    "<section class='story'><h1>[+]T</h1><p>[+]P</p><figure><img src='a.jpg'><figcaption>[+]N</figcaption></figure><p>[+]P</p><p>[+]P</p>"
    "</section><section class='sponsored'><h3>[-]N</h3><p>[-]P</p></section><section class='responses'><p>[-]P</p><p>[-]N</p></section>"
    "<div class='site-footer'><p>[-]P</p></div></body>",
    # no hints but the text
    "<body><div><a href='/'>[-]L</a> | <a href='/'>L</a> | <a href='/'>L</a></div><div><h1>[+]T</h1><p>[+]P</p><p>[+]P</p><p>[+]P</p>"
    "<p>[+]N</p><p>[+]P</p></div><div>[-]&copy; N</div></body>",
    "<body><table><tr><td><a href='/'>[-]L</a><br><a href='/'>L</a></td><td><h2>[+]T</h2><p>[+]P</p><p>[+]P</p><p>[+]P</p></td></tr></table>"
    "<p><a href='/'>[-]L</a> <a href='/'>L</a></p></body>",
    "<body><h1>[+]T</h1><p>[+]P</p><p>[+]P</p><p>[+]P</p></body>",
    "<article><p>[+]P</p><p>[+]P</p></article>",
    "<body><p>[+]P</p><p>[+]P <a href='/'>L</a> and so on.</p><dl><dt>[+]N</dt><dd>[+]P</dd></dl></body>",
    # long menus, notices over the article, comments in the main part
    "<body><ul class='nav'><li><a href='/'>[-]L</a></li><li><a href='/'>[-]L</a></li><li><a href='/'>[-]L</a></li><li><a href='/'>[-]L</a></li>"
    "<li><a href='/'>[-]L</a></li></ul><main><div class='banner'><p>[-]P</p></div><article><h1>[+]T</h1><div class='meta'>[-]N</div><p>[+]P</p>"
    "<h3>[+]T</h3><p>[+]P</p><ol><li>[+]P</li><li>[+]P</li></ol><p>[+]P</p></article><div class='comment-list'><article class='comment'>"
    "<p>[-]P</p></article><article class='comment'><p>[-]N</p><p>[-]P</p></article></div><form class='reply'><p>[-]N</p></form></main>"
    "<aside id='sidebar'><p>[-]P</p></aside>" + FOOT + "</body>",
    "<body><div id='nav'><p><a href='/'>[-]L</a></p><p><a href='/'>[-]L</a></p></div><div class='notification'>[-]P</div><div class='article-text'>"
    "<h1>[+]T</h1><p>[+]P</p><div class='advertisement'><p>[-]P</p><p>[-]N</p></div><p>[+]P</p><p>[+]P</p></div><div class='user-comments'>"
    "<p>[-]P</p><p>[-]P</p></div><div class='related-posts'><h3>[-]N</h3><p><a href='/'>[-]T</a></p></div><div class='copyright'>[-]N</div></body>",
)


def pages(copies: int = 10, seed: int = 5) -> list[str]:
    rng = random.Random(seed)

    def paragraph() -> str:
        return " ".join(rng.choice(SENTENCES) for _ in range(rng.choice((1, 1, 2, 3, 4, 6))))

    fill = {"P": paragraph, "T": lambda: rng.choice(TITLES), "L": lambda: rng.choice(LINKS), "N": lambda: rng.choice(SHORT)}
    out = []
    for layout in LAYOUTS:
        for _ in range(copies):
            parts = []
            for k, c in enumerate(layout):
                alone = c in fill and not layout[k - 1].isalpha() and not layout[k + 1:k + 2].isalpha()
                parts.append(fill[c]() if alone else c)
            out.append("".join(parts))
    return out
