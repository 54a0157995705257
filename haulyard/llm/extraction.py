"""Main text of web pages by consensus paths per host.

Every page's containers are scored by the letters and digits they hold outside boilerplate and links; the page
votes for the path of the innermost container that holds all of them, quotes, tables and figures aside. A path is the tags and classes
from the root, digits generalised, so that ``div.post-17`` and ``div.post-18`` are one. Votes are added up per
host in Spark; the pages are then extracted again, with the winning path of their host. A page that has
less on that path than its own container holds keeps its own, so no text outside boilerplate and links is lost.

The text: blocks in page order, one line each; character references decoded, white space inside a block made
one blank. Menus, headers, footers, sidebars, adverts, forms, comments, scripts and styles are left out by tag, role
and class wherever they stand; ids count on wrappers only. Words that articles use too ("discussion", "related",
"notice") only make a wrapper doubtful: it does not count in the choice of the container, and is left out if most of
its text is links or if it stands outside the container.

Defined cases: a null, empty or text-free page gives the empty text. Pages without a readable host are each
their own. Ties of votes go to the path with more text, then to the first by name. Repeated pages vote each.
Result columns replace input columns of the same name.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulyard.llm.frames import add_columns, bounded, col
from haulyard.session import materialise

# fixed values: elements by kind
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
SKIPPED = frozenset(
    "nav header footer aside form script style noscript template button select option textarea svg math iframe object menu dialog head title canvas audio video".split()
)
CONTAINERS = frozenset("main article section div td table tbody tr center blockquote details figure".split())
BLOCKS = CONTAINERS | frozenset(
    "html body p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre address hgroup figcaption thead tfoot th caption fieldset summary hr search".split()
)
# containers that are no page's main one: parts of a text
PARTS = frozenset("table tbody tr td blockquote figure details".split())
# a new block of these ends an open one of the same kind
ENDS_ITSELF = frozenset("p li dt dd tr td th option".split())
# fixed values: words in classes and ids that mark boilerplate
BOILER = frozenset(
    """nav navbar breadcrumb breadcrumbs sidebar masthead topbar footer bottombar ad ads adv advert adverts advertisement sponsored promo
    cookie cookies gdpr popup modal newsletter subscribe signup share sharing comments commentlist disqus pagination pager toolbar""".split()
)
# words that also name parts of articles: boilerplate only with evidence
DOUBTFUL = frozenset(
    """navigation menu menus side header advertising sponsor promotion banner consent notice notices alert overlay subscription social related
    recommended recommendations comment respond reply replies discussion widget widgets login search complementary contentinfo dialog""".split()
)
ROLES = frozenset("navigation search complementary contentinfo banner dialog alertdialog menu menubar toolbar".split())
# elements whose ids, and doubtful classes, are looked at
WRAPPERS = frozenset("div section ul ol dl table td center details fieldset".split())
KEEPERS = frozenset("html body main article".split())
NEGATING = frozenset("no with has without".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
INVISIBLE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
NO_WORD = re.compile(r"[\W_]+")
DIGITS = re.compile(r"[0-9]+")


def parsed(attributes: str) -> dict[str, str]:
    """The attributes by lower-cased name; of repeated ones the first."""
    found: dict[str, str] = {}
    for a in ATTRIBUTE.finditer(attributes):
        found.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
    return found


def is_boilerplate(tag: str, attributes: dict[str, str]) -> bool | None:
    """Whether an element is boilerplate; None if that is doubtful."""
    if tag in SKIPPED:
        return True
    if not attributes or tag in KEEPERS:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true" or INVISIBLE.search(attributes.get("style", "")):
        return True
    wrapper = tag in WRAPPERS
    if wrapper and ROLES.intersection(attributes.get("role", "").lower().split()):
        return True
    doubtful = False
    for name in (attributes.get("class", "") + " " + (attributes.get("id", "") if wrapper else "")).lower().split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        if words and words[0] not in NEGATING:
            if words[0] in BOILER or words[-1] in BOILER:
                return True
            doubtful = doubtful or (wrapper and (words[0] in DOUBTFUL or words[-1] in DOUBTFUL))
    return None if doubtful else False


def step_of(tag: str, attributes: dict[str, str]) -> str:
    """A container's step in a path: its tag and classes, digits generalised."""
    classes = attributes.get("class", "")
    return tag + "".join("." + c for c in sorted(set(DIGITS.sub("#", classes.lower()).split())))


class Page:
    """The blocks of a page outside boilerplate, each with the containers it stands in.

    ``containers`` holds (path, containers around it and itself); ``blocks`` (text, container, letters and digits outside links).
    """

    def __init__(self, source: str):
        self.containers: list[tuple[str, tuple[int, ...]]] = [("", (0,))]
        self.parts: set[int] = set()  # containers that are parts of a text, or in one
        self.blocks: list[tuple[str, int, int]] = []
        self._stack: list[tuple[str, int, bool, bool, int]] = []  # tag, container, skipped, link, doubtful element or 0
        self._doubts = [(0, 0)]  # letters and digits of each doubtful element: outside links, in links
        self._inside: list[int] = []  # the doubtful element of each block, or 0
        self._pieces: list[str] = []
        self._own = 0
        self._read(source)
        linked = {i for i, (own, links) in enumerate(self._doubts) if i and links > own}
        both = [(b, d) for b, d in zip(self.blocks, self._inside) if d not in linked]
        if any(b[2] for b, d in both if not d):  # doubtful text does not choose the container
            both = [((b[0], b[1], 0) if d else b, d) for b, d in both]
        self.blocks = [b for b, _ in both]

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            tag = TOKEN.search(source, at)
            self._text(source[at : tag.start() if tag else n])
            if not tag:
                break
            at = tag.end()
            if not tag[2]:
                continue
            name = tag[2].lower()
            if tag[1]:
                self._close(name)
                continue
            self._open(name, tag[3])
            if name in RAW:
                end = re.compile(f"</{name}", re.I).search(source, at)
                at = end.start() if end else n
        self._flush()

    def _here(self) -> tuple[int, bool, bool, int]:
        return self._stack[-1][1:] if self._stack else (0, False, False, 0)

    def _text(self, piece: str) -> None:
        _, skipped, link, doubt = self._here()
        if piece and not skipped:
            piece = html.unescape(piece) if "&" in piece else piece
            self._pieces.append(piece)
            size = len(NO_WORD.sub("", piece)) if doubt or not link else 0
            if not link:
                self._own += size
            if doubt:
                own, links = self._doubts[doubt]
                self._doubts[doubt] = (own, links + size) if link else (own + size, links)

    def _flush(self) -> None:
        if self._pieces:
            text = " ".join("".join(self._pieces).split())
            if text:
                self.blocks.append((text, self._here()[0], self._own))
                self._inside.append(self._here()[3])
            self._pieces, self._own = [], 0

    def _pop(self, i: int) -> None:
        if any(x[0] in BLOCKS for x in self._stack[i:]):
            self._flush()
        del self._stack[i:]

    def _close(self, name: str) -> None:
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i][0] == name:
                return self._pop(i)
            # an inline end tag does not reach out of its block, nor any out of a table cell
            if name not in BLOCKS and self._stack[i][0] in BLOCKS:
                return None
        return None

    def _open(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self._flush()
            for i in range(len(self._stack) - 1, -1, -1):
                tag = self._stack[i][0]
                if tag == "p" or (tag == name and name in ENDS_ITSELF):
                    self._pop(i)
                    break
                if tag in CONTAINERS or tag in ("ul", "ol", "dl"):
                    break
        if name in VOID:
            if name == "br":
                self._text(" ")
            return
        container, skipped, link, doubt = self._here()
        known = parsed(attributes) if attributes and not skipped else {}
        judged = skipped or is_boilerplate(name, known)
        mine = bool(judged)
        if judged is None and not doubt:
            self._doubts.append((0, 0))
            doubt = len(self._doubts) - 1
        if name in CONTAINERS and not mine:
            path, around = self.containers[container]
            self.containers.append((f"{path}>{step_of(name, known)}", (*around, len(self.containers))))
            if name in PARTS or container in self.parts:
                self.parts.add(len(self.containers) - 1)
            container = len(self.containers) - 1
        if name in BLOCKS or mine != skipped or name == "a":
            self._stack.append((name, container, mine, link or name == "a", doubt))

    def best(self) -> tuple[int, int]:
        """The innermost container with all of the text, and how much that is."""
        held: dict[int, int] = {}
        for _, container, score in self.blocks:
            if score:
                for c in self.containers[container][1]:
                    held[c] = held.get(c, 0) + score
        total = held.get(0, 0)
        good = [c for c, n in held.items() if n == total and c not in self.parts]
        best = max(good, key=lambda c: (len(self.containers[c][1]), -c), default=0)
        return best, total

    def text(self, wanted: set[int]) -> str:
        return "\n".join(t for t, c, _ in self.blocks if wanted.intersection(self.containers[c][1]))


def vote(source: str) -> tuple[str, int]:
    page = Page(source)
    best, held = page.best()
    return page.containers[best][0], held


def extract(source: str, path: str | None) -> str:
    """The page's text on ``path``, or in its own best container."""
    page = Page(source)
    best, held = page.best()
    if path is not None:
        wanted = {i for i, (p, _) in enumerate(page.containers) if p == path}
        own = sum(s for _, c, s in page.blocks if wanted.intersection(page.containers[c][1]))
        if own and own >= held:
            return page.text(wanted)
    return page.text({best})


def _source(data: bytes | None) -> str:
    return data.decode("utf-8", "replace") if data else ""


def winners(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """(host, path, votes): the path most pages of a host voted for."""
    slim = pages.select(F.try_parse_url(col(url), F.lit("HOST")).alias("host"), col(source).alias("html")).where(F.col("host").isNotNull())

    def compute(texts, _):
        found = [vote(_source(t)) for t in texts]
        return {"path": [p for p, _ in found], "held": [h for _, h in found]}

    votes = add_columns(slim, "html", "path string, held long", compute, drop=("html",)).where("held > 0")
    counted = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("held").alias("held"))
    # more votes, then more text, then the first by name
    last = F.struct(F.col("votes"), F.col("held"), F.translate("path", "abcdefghijklmnopqrstuvwxyz", "zyxwvutsrqponmlkjihgfedcba"), F.col("path").alias("path"))
    return counted.groupBy("host").agg(F.max(last).alias("w")).select("host", "w.path", "w.votes")


def main_text(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """``pages`` without the source, with the columns text and n_chars (code points)."""
    won = materialise(winners(pages, url, source)).select(F.col("host").alias("_host"), F.col("path").alias("_path"))
    hosted = pages.withColumn("_h", F.try_parse_url(col(url), F.lit("HOST")))
    # a row per host: broadcast while that is small; else a shuffle join, whose hot hosts adaptive execution splits
    hosted = hosted.join(bounded(won, "_path"), F.col("_h") == F.col("_host"), "left").drop("_h", "_host")

    def compute(texts, part):
        paths = part.column(part.schema.names.index("_path")).to_pylist()
        return {"text": [extract(_source(t), p) for t, p in zip(texts, paths)]}

    done = add_columns(hosted, source, "text string", compute, drop=(source, "_path"))
    keep = [c for c in done.columns if c.lower() != "n_chars"]
    return done.select(*[col(c) for c in keep], F.length("text").cast("long").alias("n_chars"))
