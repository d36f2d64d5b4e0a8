"""The small labelled table that the page classifier is trained on: invented pages put together by rule from labelled lines."""

from __future__ import annotations

import random
import re

# Example lines by language and role. Roles of the frame come before those of the article.
LINES = {
    "en": {
        "nav": ["Home", "Pricing", "Features", "Docs", "Log in", "Blog", "Contact", "Integrations", "Careers"],
        "top": ["Skip to content", "Search", "Open in app", "English | Français | Deutsch", "Previous | 1 2 3 | Next", "Menu"],
        "consent": ["We use cookies to count visits. You can change this at any time.", "This site stores small files on your device to remember you.", "Your privacy matters to us, which is why you choose.", "Cookies and similar means help us to learn what works.", "By going on you agree to this use, as laid down in the policy."],
        "button": ["Accept all", "Reject", "Got it", "Manage choices"],
        "widget": ["Related tools", "You may also like", "Sponsored", "More from {site}"],
        "insert": ["Advertisement", "Log in to leave a review", "Share · Copy link · Print", "1.2k shares", "Was this page helpful? Yes No", "Loading comments"],
        "subscribe": ["Join 4,000 readers of the {site} letter.", "Get one short mail a week with new tools. No spam.", "Enter your email to stay in the loop"],
        "foot": ["Privacy", "Terms", "Imprint", "Cookie settings", "Sitemap"],
        "legal": ["© 2025 {site}. All rights reserved.", "(c) 2019-2024 {site}, made with care", "{site} is a trademark of {site} Holdings.", "{site} helps buyers find tools.", "The people behind {site} test what they list.", "{site}, your guide to better tools since 2011."],
        "heading": ["Overview", "Pricing", "Features", "How it works", "Verdict", "Integrations", "About {name}"],
        "sentence": ["{name} sorts the inbox of a small shop.", "Plans start at 9 dollars and grow with the team.", "It asks visitors for consent to cookies in 12 languages.", "Every newsletter ends with a link to unsubscribe.", "Menus and footers are edited in one place.", "Is it enough for {who}?", "{who} like {what}, but find {what} hard to learn.", "It brings {what} and {what} to {who}.", "With {what}, {who} save an hour a day.", "{name} is made for {who} who need {what}.", "Unlike {other}, it keeps {what} apart from {what}."],
        "item": ["12 seats included", "$40 per month", "Works with {other}", "Up to 9 projects", "{what} for {who}", "3 seats", "{what}", "From 12 euros", "Free for students"],
        "message": ["This page could not be found.", "You need to enable JavaScript to run this app.", "Access denied", "502 Bad Gateway", "Go back to the start page", "Lorem ipsum dolor sit amet.", "404", "#", "[title]", "Reference 81.2a5"],
    },
    "fr": {
        "nav": ["Accueil", "Tarifs", "Aide", "Blog", "Connexion", "Fonctionnalités"],
        "top": ["Aller au contenu", "Rechercher", "Haut de page"],
        "consent": ["Nous utilisons des cookies pour compter les visites.", "Ce site dépose de petits fichiers ; consultez notre politique."],
        "button": ["Tout accepter", "Refuser", "Paramétrer"],
        "widget": ["Outils voisins", "À lire aussi"],
        "insert": ["Connectez-vous pour laisser un avis", "Publicité"],
        "subscribe": ["Inscrivez-vous à notre infolettre", "Recevez la lettre de {site} chaque semaine."],
        "foot": ["Confidentialité", "CGU", "Mentions légales", "Plan du site"],
        "legal": ["{site} © 2024", "Certains liens de {site} sont rémunérés.", "{site} aide les acheteurs.", "L'équipe de {site} essaie chaque outil."],
        "heading": ["Présentation", "Tarifs", "Limites", "Pour qui ?"],
        "sentence": ["{name} trie les messages d'une petite équipe.", "La formule gratuite suffit pour trois projets.", "Est-ce suffisant pour {who} ?", "Avec {what}, {who} gagnent du temps.", "{name} convient à {who} pour {what}.", "{what} et {what} restent séparés."],
        "item": ["12 places incluses", "Compatible avec {other}", "{what}", "9 € par mois"],
        "message": ["Oups, cette page n'existe pas.", "Veuillez activer JavaScript pour afficher cette page."],
    },
}
_CHANGES = {"de": {"nav": ["Startseite", "Preise", "Hilfe", "Kontakt"], "top": ["Zum Inhalt springen", "Suche"], "consent": ["Wir verwenden Cookies für Statistik."], "button": ["Alle annehmen", "Ablehnen"], "widget": ["Beliebt", "Ähnliche Werkzeuge"], "foot": ["Impressum", "Datenschutz", "AGB"], "heading": ["Überblick", "Preise", "Grenzen"], "sentence": ["{name} ordnet die Post kleiner Teams.", "Der freie Tarif reicht für drei Projekte."]},
            "es": {"nav": ["Inicio", "Precios", "Ayuda", "Contacto"], "top": ["Saltar al contenido", "Buscar"], "consent": ["Usamos cookies para medir visitas."], "button": ["Aceptar todo", "Rechazar"], "widget": ["Lo más visto", "Herramientas relacionadas"], "foot": ["Privacidad", "Condiciones", "Aviso legal"], "heading": ["Resumen", "Precios", "Límites"], "sentence": ["{name} ordena el correo de un equipo pequeño.", "El plan gratuito cubre tres proyectos."]}}
LINES |= {language: LINES["fr"] | own for language, own in _CHANGES.items()}
#: What the sentences of articles speak of, so that few of them repeat.
WHAT = "shared boards|page templates|privacy features|blog search|voice notes|price alerts|file history|mail rules|smart lists|live captions|task timers|guest seats|map views|stock photos|code reviews|lead scores|quiz banks|form logic".split("|")
WHO = "small shops|support teams|pricing teams|contact centres|school clubs|law firms|travel blogs|film crews|dental clinics|book sellers|sports teams|city guides|game studios|food banks|tax advisers".split("|")
_SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu va wo ye zi".split()


OTHERS = ["Balo", "Mirun Desk", "Tevak", "Sorel Hub", "Pinu Board", "Kadem"]
MORE = ["Lirano", "Deska Flow", "Omuti", "Varel Sheet", "Pado", "Kinu Cast", "Seltor", "Rima Note", "Zovek"]


def _word(draw: random.Random, most: int = 4) -> str:
    return "".join(draw.choices(_SYLLABLES, k=draw.randint(2, most))).capitalize()


def labelled_pages(pages: int = 900, seed: int = 11, sites: int = 60) -> list[tuple[str, str, list[tuple[str, int]]]]:
    """(name, site, [(line, 1 for frame or 0 for article)]) of ``pages`` invented pages.

    A third of the pages are on one site, and many sites have few pages. Sites share labels, notices and headings in words
    that no list knows: only where they stand and that they repeat tells what they are.
    """
    draw, lists = random.Random(seed), random.Random(seed + 1)  # lists have draws of their own: their length changes nothing else
    label = lambda: _word(draw) if draw.random() < 0.7 else f"{_word(draw)} {_word(draw).lower()}"
    labels, headings = [label() for _ in range(40)], [label() for _ in range(12)]
    notices = [" ".join(_word(draw).lower() for _ in range(draw.randint(5, 11))).capitalize() + "." for _ in range(14)]
    hosts = [(_word(draw), draw.sample(labels, 6), draw.sample(notices, draw.randint(0, 2))) for _ in range(sites)]
    made = []
    for number in range(pages):
        own = LINES[("en", "en", "fr", "de", "es")[number % 5]]
        site, labels_here, notices_here = hosts[0 if number % 3 == 0 else int(sites * draw.random() ** 1.5)]
        name, rows = f"{_word(draw)}{draw.choice(['', '', ' Kit', ' Mail', ' Studio'])}", []
        own = own | {role: draw.sample(own[role], 2 * len(own[role]) // 3) + labels_here[: draw.randint(0, 3)] for role in ("nav", "foot")}
        own = own | {"legal": own["legal"] + notices_here, "consent": own["consent"] + notices_here[:1], "button": own["button"] + labels_here[:1]}
        own = own | {"heading": own["heading"] + draw.sample(headings, 3)}

        def fill(line: str) -> str:
            line = re.sub("{what}", lambda _: draw.choice(WHAT), line)
            line = re.sub("{who}", lambda _: draw.choice(WHO), line).format(name=name, site=site, other=_word(draw) + draw.choice(["", " Desk"]))
            return line[:1].upper() + line[1:]

        def add(role: str, mark: int, count: int = 1, form: str = "{}") -> None:
            for line in draw.sample(own[role], min(count, len(own[role]))):
                rows.append((form.format(fill(line)), mark))

        def joined(role: str) -> None:
            """One line of one to three sentences."""
            rows.append((" ".join(map(fill, draw.sample(own[role], min(len(own[role]), draw.choice([1, 1, 2, 3]))))), 1))

        def consent() -> None:
            joined("consent")
            add("button", 1, draw.randint(0, 3))

        def widget(most: int, longest: int = 0) -> None:
            add("widget", 1)
            kind = draw.randrange(3)
            others = draw.sample(OTHERS, draw.randint(2, most))
            if longest:
                others = lists.sample(OTHERS + MORE, min(lists.randint(1, longest), lists.randint(1, longest)))
            for other in others:
                rows.append(([other, f"{other} – page builder", own["sentence"][0].replace("{name}", other)][kind], 1))

        early = draw.random() < 0.4
        bare = draw.random() < 0.15  # a page that starts with its article
        if early and not bare:
            consent()
        if draw.random() < 0.5 and not bare:
            add("top", 1)
        if bare:
            pass
        elif draw.random() < 0.45:
            add("nav", 1, draw.randint(3, 8), draw.choice(["{}", "→ {}"]))
        elif draw.random() < 0.9:
            glue = draw.choice([" | ", " / ", " · ", "  ", "\t", " "])
            rows.append((glue.join(draw.sample(own["nav"], min(len(own["nav"]), draw.randint(3, 7)))), 1))
        if draw.random() < 0.4 and not bare:
            rows.append((draw.choice([" › ", " / ", " > ", " » "]).join([*draw.sample(own["nav"], 2), name]), 1))
        if draw.random() < 0.8:
            rows.append((name, 0))
        if draw.random() < 0.2:
            add("message", 0, draw.randint(1, 2))
        else:
            for _ in range(draw.randint(2, 16)):
                pick = draw.random()
                if pick < 0.3:
                    add("heading", 0)
                if pick < 0.7:
                    rows.append((" ".join(map(fill, draw.choices(own["sentence"], k=draw.choice([1, 1, 2, 3, 5, 8])))), 0))
                elif pick < 0.92:
                    form = draw.choice(["{}", "- {}", "• {}", "✓ {}"])
                    for _ in range(draw.randint(2, 6)):
                        add("item", 0, 1, form)
                elif pick < 0.96:
                    add("insert", 1)
                else:
                    widget(2)
                    add("item", 0, 2, "✓ {}")
        if draw.random() < 0.2:  # a page that ends with its article
            made.append((name, f"{site.lower()}.example", rows))
            continue
        if draw.random() < 0.6:
            widget(4, 15)
        for role, odds in (("insert", 0.4), ("subscribe", 0.5), ("legal", 0.6)):
            if draw.random() < odds:
                joined(role) if role != "insert" else add(role, 1)
        if draw.random() < 0.5:
            add("foot", 1, draw.randint(1, 5))
        elif draw.random() < 0.8:
            rows.append((draw.choice([" | ", " · "]).join(draw.sample(own["foot"], 2)), 1))
        if draw.random() < 0.6:
            joined("legal")
        if not early and draw.random() < 0.6:
            consent()
        made.append((name, f"{site.lower()}.example", rows))
    return made
