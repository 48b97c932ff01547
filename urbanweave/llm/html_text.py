"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())  # their text holds no tags
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPH_ENDS = BLOCKS - {"option", "optgroup", "legend", "caption"}
FURNITURE = frozenset("nav header footer aside menu button select dialog head fieldset label input template".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
#: Words of class and id names that mark furniture.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs sidebar aside widget related recommended recommendations teaser share sharing social "
    "footer header masthead topbar comment comments reply replies respond discussion disqus cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login paywall copyright legal disclaimer "
    "pagination pager tags tagcloud search skip toolbar".split()
)
CONTENT = frozenset("article content entry main post story text body".split())

# A place where markup starts; the rest of a tag, with quotes; and without regard to them, for a page with open quotes.
START = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)|<(?=[^A-Za-z/!?])|</[^A-Za-z][^>]*>?", re.S)
REST = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
LOOSE_REST = re.compile(r"([^>]*+)>")
OPEN_QUOTES = 16  # tags of a page that may search for a closing quote in vain; later ones end at the first >
DEPTH = 512  # nesting from which an element takes the path of its parent, as browsers build it
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")
SPACES = re.compile(r"\s+")

SMOOTH = 1.0  # standard deviation, in paths, of the Gaussian over neighbouring paths
THRESHOLD = 0.1  # of the mean fused ratio
CONTENT_WEIGHT, MARK_WEIGHT = 4.0, 0.001  # of paths below a content name, and below a furniture name
MOST = 0.5  # share of the page's text from which a wrapper is no furniture, whatever its name


class Path:
    """One root-to-leaf tag path: whether furniture is on it, which paths on it have furniture or content names, and what it holds."""

    def __init__(self, name: int, furniture: bool, wrappers: tuple[int, ...], content: tuple[int, ...], article: bool):
        self.name, self.furniture, self.wrappers, self.content, self.article = name, furniture, wrappers, content, article
        self.chars = self.marks = self.nodes = 0


def _is_furniture(tag: str, attributes: str) -> bool:
    if tag in FURNITURE:
        return True
    if not attributes.strip():
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def read_blocks(page: str) -> list[tuple[Path, str]]:
    """Text blocks in page order, each with the tag path of its text."""
    stack: list[tuple[str, Path]] = []
    opened: Counter[str] = Counter()
    paths: dict[tuple, Path] = {}
    labels: dict[tuple, int] = {}
    root = Path(-1, False, (), (), False)
    blocks: list[tuple[Path, str]] = []
    held: list[str] = []
    owner: Path | None = None

    def close_block() -> None:
        nonlocal owner
        if held:
            text = SPACES.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text and owner is not None:
                blocks.append((owner, text))
        owner = None

    def cut(k: int) -> None:
        opened.subtract(t for t, _ in stack[k:])
        del stack[k:]

    def pop(tag: str) -> None:
        if not opened[tag]:
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == tag:
                if tag in BLOCKS or any(t in BLOCKS for t, _ in stack[k:]):
                    close_block()
                cut(k)
                return
            if stack[k][0] in BLOCKS and tag not in BLOCKS:
                return  # an inline end tag closes nothing outside its block

    def text(chunk: str) -> None:
        nonlocal owner
        if chunk:
            here = stack[-1][1] if stack else root
            if chunk.strip():
                if owner is not None and (owner.furniture, owner.wrappers) != (here.furniture, here.wrappers):
                    close_block()
                if owner is None:
                    owner = here
            held.append(chunk)

    at, n, vain = 0, len(page), 0
    while at < n:
        m = START.search(page, at)
        text(page[at : m.start() if m else n])
        if not m:
            break
        at = m.end()
        slash, tag = m.group(1), m.group(2)
        if tag is None:
            if m.group(0) == "<":
                text("<")
            continue
        rest = REST.match(page, at) if vain < OPEN_QUOTES else None
        if rest is None:
            vain += 1
            rest = LOOSE_REST.match(page, at)
        if rest is None:  # the page breaks off in a tag
            break
        attributes, at = rest.group(1), rest.end()
        tag = tag.lower()
        if slash:
            if tag == "p" and not opened["p"]:
                close_block()
            pop(tag)
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                close_block()
            continue
        if tag in RAW and not attributes.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if tag == "xmp":  # shown as it stands
                close_block()
                text(html.escape(page[at : end.start() if end else n]))
                close_block()
            at = end.end() if end else n
            continue
        if tag in BLOCKS:
            close_block()
            if tag in PARAGRAPH_ENDS:
                if opened["p"]:  # one at most
                    cut(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == "p"))
            if tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
                same = {"dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
                if stack and stack[-1][0] in same:
                    cut(len(stack) - 1)
        if attributes.rstrip().endswith("/") and tag not in BLOCKS:
            continue
        above = stack[-1][1] if stack else root
        names = {p.lower() for name, v in ATTRIBUTE.findall(attributes) if name.lower() in ("class", "id") for p in NAME_PARTS.findall(v)}
        bad = above.furniture or _is_furniture(tag, attributes)
        label = labels.setdefault((above.name, tag, frozenset(names)), len(labels))
        article = tag in ("article", "main")
        # "post-with-sidebar" names a page by what stands beside it
        marked = tag == "form" or bool(names & MARKS and not article and tag not in ("html", "body"))
        named = article or bool(names & CONTENT and tag in ("div", "section", "td"))
        key = (label, bad, above.wrappers + (label,) * marked, above.content + (label,) * named, above.article or article)
        if len(stack) >= DEPTH:
            key = (above.name, bad, above.wrappers, above.content, above.article)
        if key not in paths:
            paths[key] = Path(*key)
        stack.append((tag, paths[key]))
        opened[tag] += 1
    close_block()
    return blocks


def fused_scores(paths: list[Path]) -> list[float]:
    """Text and punctuation per node of each path, smoothed over neighbouring paths of the page, and multiplied."""
    reach = int(3 * SMOOTH)
    weights = [2.718281828 ** (-(d * d) / (2 * SMOOTH * SMOOTH)) for d in range(reach + 1)]

    def smooth(values: list[float]) -> list[float]:
        out = []
        for i in range(len(values)):
            near = [(weights[abs(d)], values[i + d]) for d in range(-reach, reach + 1) if 0 <= i + d < len(values)]
            out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
        return out

    text = smooth([p.chars / max(p.nodes, 1) for p in paths])
    marks = smooth([p.marks / max(p.nodes, 1) for p in paths])
    return [t * (1 + m) for t, m in zip(text, marks, strict=True)]


def main_text(page: str | None) -> str:
    """The blocks of the content paths, in page order, one per line.

    Text length and punctuation are summed per tag path over the nodes that carry it; both ratios are smoothed over the
    order in which paths appear and fused with a third one, the weight of the path: 0 on furniture (menus, headers,
    footers, hidden text), ``MARK_WEIGHT`` below a form or a name of sidebars, notices, adverts or comments,
    ``CONTENT_WEIGHT`` below article, main or a content name, else 1. A name does not count against a wrapper that holds
    more than ``MOST`` of the page's text, unless an article or main stands beside it. A path counts whose fused score is
    at least ``THRESHOLD`` of the mean; below a content name that such a path shares, shorter ones without a furniture
    name count too: a short heading inside the article is text, a short stray line outside of any is not. An empty or
    null page, and one without text, gives the empty text.
    """
    blocks = read_blocks(page) if page else []
    paths = list({id(p): p for p, _ in blocks}.values())
    for path, text in blocks:
        path.chars += len(text)
        path.marks += len(PUNCTUATION.findall(text))
        path.nodes += 1
    shown = [p for p in paths if not p.furniture]
    total = sum(p.chars for p in shown)
    held: dict[int, int] = {}
    for p in shown:
        for w in dict.fromkeys(p.wrappers):
            held[w] = held.get(w, 0) + p.chars
    most = {w for w, n in held.items() if n > MOST * total and not any(p.article and w not in p.wrappers for p in shown)}
    marked = [any(w not in most for w in p.wrappers) for p in paths]
    weight = [
        0.0 if p.furniture else MARK_WEIGHT if m else CONTENT_WEIGHT if p.content else 1.0 for p, m in zip(paths, marked, strict=True)
    ]
    scores = [s * w for s, w in zip(fused_scores(paths), weight, strict=True)]
    limit = THRESHOLD * sum(scores) / max(len(shown), 1)
    first = [s > 0 and s >= limit for s in scores]
    roots = {c for p, m, f in zip(paths, marked, first, strict=True) if f and not m for c in p.content}
    chosen = {
        id(p)
        for p, s, m, f in zip(paths, scores, marked, first, strict=True)
        if f or (s > 0 and not m and any(c in roots for c in p.content))
    }
    return "\n".join(text for path, text in blocks if id(path) in chosen)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    Pages are read one by one in Arrow batches, without a shuffle: repeated rows and null ids or urls stay as they are,
    an empty table gives an empty one, and columns beside the three named are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
