"""What the lines of a page look like: words of site frames in four languages, and features of lines and their neighbours."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import xxhash

# Labels of navigation, footers, consent and sharing that stand alone on a line or between separators.
NAVIGATION = """home|pricing|features|integrations|customers|enterprise|solutions|templates|careers|partners|community|changelog|newsletter|
status|docs|blog|compare|contact|about us|help center|log in|sign in|sign up|submit a tool|start free|book a demo|categories|resources|support|
accueil|tarifs|fonctionnalités|connexion|modèles|aide|essai gratuit|comparer|partenaires|catégories|à propos|
inicio|precios|funciones|entrar|plantillas|ayuda|prueba gratis|comparar|socios|categorías|nosotros|contacto|
startseite|preise|funktionen|anmelden|vorlagen|hilfe|kostenlos testen|vergleich|partner|kategorien|über uns|kontakt"""
LABELS = """cookie settings|terms|privacy|imprint|security|accessibility|sitemap|do not sell my data|legal|cookies|accept all|reject|reject all|
got it|ok, understood|allow selection|manage choices|search|menu|back to top|skip to content|open in app|loading comments|follow us|
log in to leave a review|sign in to leave a review|share on social media|share this page|send by mail|copy link|share|print|english|français|deutsch|español|
tout accepter|refuser|paramétrer|confidentialité|cgu|mentions légales|plan du site|rechercher|haut de page|aller au contenu|connectez-vous pour laisser un avis|
aceptar todo|rechazar|configurar|condiciones|privacidad|aviso legal|mapa del sitio|buscar|volver arriba|saltar al contenido|inicia sesión para opinar|
alle annehmen|ablehnen|einstellungen|agb|impressum|datenschutz|suche|nach oben|zum inhalt springen|zum bewerten bitte anmelden|advertisement|publicité|anuncio|anzeige|werbung|
please enable scripts for the best experience.|next|previous"""
WIDGETS = """related tools|you may also like|recently added|popular comparisons|trending this week|sponsored|les plus vus|outils voisins|à lire aussi|
herramientas relacionadas|lo más visto|también te puede gustar|beliebt|ähnliche werkzeuge|das könnte sie auch interessieren|more tools|similar tools"""
BOTH = """pricing|features|integrations|tarifs|fonctionnalités|precios|funciones|preise|funktionen|templates|support|resources"""
HEADINGS = """overview|who it is for|verdict|how it works|questions and answers|limits|présentation|pour qui ?|limites|resumen|para quién|límites|überblick|für wen?|grenzen"""

NAVIGATION, LABELS, WIDGETS, BOTH, HEADINGS = ({x.strip() for x in text.replace("\n", "").split("|")} for text in (NAVIGATION, LABELS, WIDGETS, BOTH, HEADINGS))

#: Sentences of frames, by how they start, and by what they hold: consent, rights, subscription, sharing, paid links.
FRAME_START = re.compile(
    r"(?ix) your\ privacy\b | cookies\ and\ similar | copyright\b | join\ [\d.,]+ | subscribe\b | enter\ your\ email | get\ one\  | never\ miss\ a\b | inscrivez-vous | recevez\b | abonnez-vous"
    r"| suscríbete | recibe\b | newsletter\b | abonnieren\b | some\ links\ on\b | certains\ liens\ de\b | algunos\ enlaces\ (?:de|en)\b | einige\ links\ auf\b"
    r"| [\d.,]+k?\ shares$ | was\ this\ page\ helpful | previous\ \| | call\ us: | \W*\w*\{?footer"
)
FRAME_INSIDE = re.compile(
    r"(?ix) \b(?:we|our|us|this\ site|nous|ce\ site|usamos|este\ sitio|wir|diese\ seite)\b .{0,60}? \b(?:cookies?|small\ files|keep\ data|petits\ fichiers|pequeños\ archivos|kleine\ dateien)\b"
    r"| ©|\(c\)\s?\d|all\ rights\ reserved|is\ a\ (?:registered\ )?trademark\ of | \bsign\ up\ for\ the\b | \b(?:in\ your\ inbox|im\ postfach|dans\ votre\ boîte|en\ tu\ correo)\b"
)
#: What a line must hold before the second pattern can match, which spares most lines the search.
_HINTS = ("cookie", "small files", "keep data", "petits fichiers", "pequeños archivos", "kleine dateien", "©", "(c)", "rights reserved", "trademark", "sign up", "inbox", "postfach", "boîte", "correo")
WIDGET_START = re.compile(r"(?i)^(?:more from|plus de|autres outils de|más de|mehr von)\s+\S+$")
SEPARATOR = re.compile(r"\s*(?:\s[|·•/›»>→–—-]\s|\t|\s{2,}|\s[|·•/›»>→]|^[→›»>]\s)\s*")
BULLET = re.compile(r"^(?:[-*•✓✔▪–]|\d{1,2}[.)])\s")
STOPS = re.compile(r"[.!?…](?=[\s\"»”)]|$)")
NAME = re.compile(r"^[A-ZÀ-Ý][\w'-]+(?: [A-Z][\w'-]+){0,2}$")
TEASER = re.compile(r"^[A-ZÀ-Ý][\w'-]+(?: [A-Z][\w'-]+){0,2} [–—-] \S")

FEATURES = (
    "words words_before words_after links links_before links_after links_near repeated repeated_before repeated_after sites of_site of_site_before of_site_after stops bullet "
    "is_name has_name number cue label both widget_title widget_run heading crumbs from_top from_end short short_before short_after"
).split()


def site_of(*urls: str | None) -> str:
    """Host of the first url that has one: lower case, without scheme, login, port and ``www.``."""
    for url in urls:
        host = re.sub(r"^[a-z][a-z0-9+.-]*://", "", (url or "").strip().lower())
        host = re.split(r"[/?#\s]", host.lstrip("/"))[0].rpartition("@")[2].split(":")[0].rstrip(".")
        host = host.removeprefix("www.")
        if host:
            return host
    return ""


def segments(line: str) -> list[str]:
    return [x for x in (s.strip(" \t\xa0|·•/›»>→") for s in SEPARATOR.split(line)) if x]


def frame_sentence(line: str) -> bool:
    """Whether a line says what frames say."""
    if FRAME_START.match(line):
        return True
    lower = line.lower()
    return any(x in lower for x in _HINTS) and bool(FRAME_INSIDE.search(line))


def _label_share(line: str) -> float:
    """Share of the words that stand in navigation labels, the flat-text stand-in for link density."""
    lower = line.lower()
    if lower in NAVIGATION or lower in LABELS:
        return 1.0
    words = lower.replace("→", " ").split()
    if not words:
        return 0.0
    inside = sum(len(x.split()) for x in segments(lower) if x in NAVIGATION or x in LABELS)
    if inside == 0 and len(words) > 2 and not STOPS.search(line):  # labels with blanks between them
        at = 0
        while at < len(words):
            size = next((n for n in (4, 3, 2, 1) if " ".join(words[at : at + n]) in NAVIGATION), 0)
            inside += size
            at += size or 1
    return min(1.0, inside / len(words))


def _kind(line: str, own: str) -> str:
    """What a line in a list of other tools may be: a name, a name with a word on it, or one sentence not about this tool."""
    if own and own in line or BULLET.match(line):
        return ""
    if NAME.match(line):
        return "name"
    stops = len(STOPS.findall(line))
    if TEASER.match(line) and not stops:
        return "teaser"
    return "sentence" if stops == 1 and len(line.split()) > 3 else ""


@lru_cache(100_000)
def _look(line: str) -> tuple:
    """What a line shows by itself, whatever page it stands on; frames repeat, so most looks are remembered."""
    lower = line.lower()
    words, stops = len(line.split()), len(STOPS.findall(line))
    heading = lower in HEADINGS or lower.startswith(("about ", "à propos de ", "sobre ", "über ")) and lower not in NAVIGATION
    title = lower in WIDGETS or bool(WIDGET_START.match(line))
    return words, _label_share(line), stops, bool(BULLET.match(line)), frame_sentence(line), lower in LABELS, lower in BOTH, title, heading


def _runs(lines: list[str], looks: list[tuple], own: str) -> list[bool]:
    """Which lines stand in a list of other tools: it starts under a widget's title and goes on while its lines are of one kind."""
    out, run, kind = [], False, ""
    for line, look in zip(lines, looks):
        in_run = False
        if look[7]:
            run, kind = True, ""
        elif run:
            lower = line.lower()
            here = "" if look[4] or look[8] or lower in NAVIGATION or lower in LABELS else _kind(line, own)
            in_run = bool(here) and (not kind or here == kind)
            run, kind = in_run, here if in_run else ""
        out.append(in_run)
    return out


def _replace_word(text: str, word: str, sign: str) -> str:
    """Puts ``sign`` wherever ``word`` stands by itself."""
    at = text.find(word)
    while at >= 0:
        end = at + len(word)
        if (at and (text[at - 1].isalnum() or text[at - 1] == "_")) or (end < len(text) and (text[end].isalnum() or text[end] == "_")):
            at = text.find(word, at + 1)
        else:
            text = text[:at] + sign + text[end:]
            at = text.find(word, at + len(sign))
    return text


def mask(line: str, name: str, site: str) -> str:
    """The line in lower case with the names of tool and site and all numbers masked."""
    line = " ".join(line.lower().split())
    if len(name) > 2:
        line = _replace_word(line, name.lower(), "<name>")
    if len(label := site.split(".")[0]) > 2:
        line = _replace_word(line, label, "<site>")
    return _NUMBER.sub("#", line)


def line_key(masked: str) -> int:
    return xxhash.xxh64_intdigest(masked) - 2**63


def segments_of(masked: str) -> list[str]:
    """The parts of a masked line that separators set off, or the line itself."""
    parts = segments(masked) if _MAY_SEPARATE.search(masked) else [masked]
    return parts if len(parts) > 1 else [masked]


def in_frame(lines: list[str], name: str, site: str) -> list[bool]:
    """Whether a line is frame by what it says alone: for those who need no more than that."""
    own, label = (name or "").strip(), site.split(".")[0]
    looks = [_look(x) for x in lines]
    out = []
    for line, look, run in zip(lines, looks, _runs(lines, looks, own)):
        crumbs = bool(own) and line.endswith(own) and len(x := segments(line)) > 1 and x[-1] == own
        of_site = bool(label) and label in line.lower() and not (own and own in line)
        out.append(look[4] or look[5] or look[7] or run or crumbs or of_site or look[1] >= 0.5 and not look[6])
    return out


def line_features(lines: list[str], name: str, site: str, levels: dict[int, float], own_lines: set[int]) -> np.ndarray:
    """One row of FEATURES for every (stripped, not blank) line of a page.

    ``levels`` tells how common a line is among sites, and ``own_lines`` which lines many pages of this site have, by ``line_key``.
    """
    own = (name or "").strip()
    looks = [_look(x) for x in lines]
    runs = _runs(lines, looks, own)
    count = len(lines)
    x, rows = np.zeros((count, len(FEATURES))), []
    for i, (line, look) in enumerate(zip(lines, looks)):
        words, links, stops, bullet, cue, is_label, both, title, heading = look
        masked = mask(line, own, site)
        parts = segments_of(masked)
        key = line_key(masked)
        sites, of_site = levels.get(key, 0.0), key in own_lines
        if len(parts) == 1:
            repeated = float(words <= 4 and bool(sites or of_site))
        else:
            repeated = sum(n for p in parts if (n := p.count(" ") + 1) <= 4 and ((k := line_key(p)) in levels or k in own_lines)) / max(1, words)
        crumbs = len(parts) > 1 and bool(own) and parts[-1] == "<name>"
        rows.append((
            words, links, min(1.0, repeated), sites, of_site, stops, bullet, line == own, bool(own) and own in line, "#" in masked,
            cue or "<site>" in masked and "<name>" not in masked, is_label, both, title, runs[i], heading, crumbs, min(i, 30), min(count - 1 - i, 30), words <= 4 and not stops,
        ))
    if rows:
        x[:, _OWN] = np.array(rows, np.float64)
    for own_column, before, after in _NEIGHBOURS:
        x[1:, before] = x[:-1, own_column]
        x[:-1, after] = x[1:, own_column]
    if count:
        links = np.concatenate([np.zeros(3), x[:, _LINKS], np.zeros(3)])
        x[:, _NEAR] = sum(links[3 + d : 3 + d + count] for d in (-3, -2, -1, 1, 2, 3)) / 6
    return x


_NUMBER = re.compile(r"\d+")
_MAY_SEPARATE = re.compile(r"[|·•/›»>→–—\t]|\s-\s")
_OWN = [FEATURES.index(f) for f in "words links repeated sites of_site stops bullet is_name has_name number cue label both widget_title widget_run heading crumbs from_top from_end short".split()]
_NEIGHBOURS = [tuple(FEATURES.index(f"{f}{side}") for side in ("", "_before", "_after")) for f in ("words", "links", "repeated", "of_site", "short")]
_LINKS, _NEAR = FEATURES.index("links"), FEATURES.index("links_near")


def title_has_frame(title: str, name: str, site: str) -> bool:
    """Whether a title carries words of its site: the site's name, a navigation label or a counter, set off by a separator."""
    parts = [x.strip() for x in re.split(r"\s+(?:[|·•/›»>→–—-]|::|:)\s+|^[→›»>]\s+", " ".join(title.split())) if x and x.strip()]
    label = site.split(".")[0]
    own = (name or "").strip().lower()
    if re.match(r"^\(\d+\)\s", title.strip()) or re.match(r"^[→›»>]", title.strip()):
        return True
    return any((p := part.lower()) != own and (p == label or p == site or p in NAVIGATION or p in LABELS) for part in parts)
