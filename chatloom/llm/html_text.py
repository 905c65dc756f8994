"""Main text of web pages by tag-path ratios.

A page is read as text nodes, each with its path of tags from the root; inline tags
aren't part of a path. Per path, text length and punctuation are summed and divided by
the number of nodes. Both ratios are smoothed with those of the paths beside it under
the same parent, and fused as a product. The container whose paths weigh most holds the
article; its paths are content, as are others that come near its best one, and the headings,
lists, quotations and paragraphs that stand between content blocks or directly before them.
Paths that
pass through an element for navigation, notices, adverts, forms or comments, by tag,
role or class, have no ratio, unless hardly any text is left outside such elements: the
largest whose text reads as prose is then judged by its ratios.

Each page is work of its own, in batches by Arrow; nothing is shuffled.

Defined results: null and empty pages, and pages without content, give an empty text; a
page that breaks off in a tag, a script or a style ends there; another raw element that is never
closed counts as its tag alone, and so does a self-closed svg or math; repeated rows repeat.
"""

import html as entities
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp".split())
FOREIGN = frozenset(["svg", "math"])  # may close themselves
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
AWAY = frozenset(
    "head nav footer header aside form button select menu dialog object audio video canvas fieldset".split()
)
CLOSED_BY = {  # an open element that a following tag ends
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
        "header hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "tr": frozenset(["tr"]),
    "option": frozenset(["option"]),
}
SCOPES = frozenset("ul ol dl table article section main div body html td th blockquote".split())
AWAY_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|popup|modal|"
    r"side-?bar|menu|nav\w*|breadcrumbs?|footer|masthead|comments?|replies|disqus|share|social|related|"
    r"subscribe|newsletter|login|search)(?:$|[\s_-])",
    re.I,
)
#: of names that tell what a page or an element has, not what it is
STATE = re.compile(
    r"^(?:has|no|not|with|without|is)[_-]|[_-](?:open|opened|closed|enabled|disabled|on|off|active|visible|hidden|"
    r"collapsed|expanded)$",
    re.I,
)
PAGE = frozenset("html body main article".split())  # never away by name
NAMES = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
AWAY_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FLOW = HEADINGS | frozenset("p ul ol dl blockquote pre".split())  # what goes with content around it
NEARLY = 0.9  # of a page's text, for elements that aren't content to be judged by their ratios
PROSE = 80  # characters of a block with punctuation that is content by itself
NEAR = 0.5  # of the best path's weight, for paths outside the container


def nodes(page: str):
    """(block number, path, away, raw text) of each text node; a path is a tuple of tags, ``away`` the
    numbers of the elements that aren't content and that it passes through, outermost first."""
    stack: list[tuple[str, int]] = []  # tag, and a number above 0 if it isn't content
    open_ended = set()  # raw tags without a closing one in the rest of the page
    at = block = 0
    n = len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            yield block, *_path(stack), page[at:lt]
        if lt >= n:
            return
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = TAG.match(page, lt) or LOOSE_TAG.match(page, lt)
        if m is None:
            if re.match(r"</?[A-Za-z]", page[lt : lt + 3]):
                return  # the page breaks off in a tag
            yield block, *_path(stack), "<"
            at = lt + 1
            continue
        at, tag = m.end(), m[2].lower()
        if m[1]:
            if tag == "br":
                yield block, *_path(stack), " "
            elif tag not in INLINE:
                block += 1
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
            continue
        if tag in RAW:
            if tag in open_ended or tag in FOREIGN and m[3].rstrip().endswith("/"):
                continue
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            if end is None:
                if tag in ("script", "style"):
                    return
                open_ended.add(tag)
                continue
            at = page.find(">", end.end())
            at = n if at < 0 else at + 1
            continue
        if tag in INLINE:
            if tag == "br":
                yield block, *_path(stack), " "
            continue
        block += 1
        _close_for(stack, tag)
        if tag not in VOID and not m[3].rstrip().endswith("/"):
            away = tag in AWAY or tag not in PAGE and _away(m[3])
            stack.append((tag, block if away else 0))


def _close_for(stack, tag):
    for k in range(len(stack) - 1, -1, -1):
        name = stack[k][0]
        if tag in CLOSED_BY.get(name, ()):
            del stack[k:]
            return
        if name in SCOPES:
            return


def _away(attributes: str) -> bool:
    for value in NAMES.findall(attributes):
        names = value.strip("\"'").split()
        if any(n.lower() in AWAY_ROLE or AWAY_NAME.search(n) and not STATE.search(n) for n in names):
            return True
    return False


def _path(stack):
    return tuple(tag for tag, _ in stack), tuple(away for _, away in stack if away)


def content_blocks(found: list[tuple[tuple, tuple, str]]) -> list[tuple[tuple, str]]:
    """(path, text) of the blocks outside elements that aren't content, from (path, away, text)."""
    marked = {n for _, away, _ in found for n in away}
    if any(not away and not {"article", "main"}.isdisjoint(path) for path, away, _ in found):
        return [(path, text) for path, away, text in found if not away]
    total = sum(len(text) for *_, text in found)
    while marked:
        held, free = defaultdict(list), []
        for _, away, text in found:
            first = next((n for n in away if n in marked), 0)
            (held[first] if first else free).append(text)
        if sum(map(len, free)) > (1 - NEARLY) * total or any(len(t) >= PROSE and PUNCTUATION.search(t) for t in free):
            break
        prose = [
            (sum(map(len, texts)), -n)
            for n, texts in held.items()
            if sum(len(PUNCTUATION.findall(t)) for t in texts) >= len(texts)
            or any(len(t) >= PROSE and PUNCTUATION.search(t) for t in texts)
        ]
        if not prose:
            break
        marked.discard(-max(prose)[1])
    return [(path, text) for path, away, text in found if not marked.intersection(away)]


def content(found: list[tuple[tuple, str]]) -> list[str]:
    """Texts of the article, from (path, text) of the blocks in page order."""
    paths, best = content_paths(found)
    taken = [k for k, (path, _) in enumerate(found) if path in paths]
    if not taken:
        return []
    whole = best  # the lowest container of all content
    for path in paths:
        while path[: len(whole)] != whole:
            whole = whole[:-1]
    first, last = taken[0], taken[-1]
    keep = set(taken)
    keep.update(k for k in range(first, last) if _flow(found[k][0], whole) is not None)
    # Before the content: what leads up to it in its container or one around it. Lists
    # only after a heading; before it they are mostly menus.
    lists = []
    for k in range(first - 1, -1, -1):
        path = found[k][0]
        depth = next((n for n, tag in enumerate(path) if tag in FLOW), None)
        kind = path[depth] if depth is not None and path[:depth] == best[:depth] else None
        if kind is None:
            break
        if kind in ("ul", "ol", "dl"):
            lists.append(k)
            continue
        keep.update(lists if kind in HEADINGS else [], [k])
        if kind not in HEADINGS and lists:
            break
        lists = []
    return [found[k][1] for k in sorted(keep)]


def _flow(path: tuple, container: tuple) -> str | None:
    """First tag of ``FLOW`` on a path below ``container``."""
    if path[: len(container)] != container:
        return None
    return next((tag for tag in path[len(container) :] if tag in FLOW), None)


def content_paths(found: list[tuple[tuple, str]]) -> tuple[set[tuple], tuple]:
    """Paths of the article and the container of most weight, from (path, text) of the blocks."""
    length, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for path, text in found:
        length[path] += len(text)
        marks[path] += len(PUNCTUATION.findall(text))
        count[path] += 1
    if not count:
        return set(), ()
    beside = defaultdict(list)
    for path in count:
        beside[path[:-1]].append(path)

    def smooth(of, path):
        around = [of[p] / count[p] for p in beside[path[:-1]]]
        return (of[path] / count[path] + max(around) + sum(around) / len(around)) / 3

    weight = {p: smooth(length, p) * (1 + smooth(marks, p)) for p in count}
    held = defaultdict(float)
    for p in count:
        held[p[:-1]] += weight[p] * length[p]
    best = max(held, key=lambda c: (held[c], -len(c), c))
    for k in range(len(best), 0, -1):  # a part of an article or main stands for the whole
        if best[k - 1] in ("article", "main"):
            best = best[:k]
            break
    top = max(weight[p] for p in count if p[: len(best)] == best)
    return {p for p in count if p[: len(best)] == best or weight[p] >= NEAR * top}, best


def extract(page: str) -> str:
    """Blocks of the article in page order, joined by an empty line."""
    blocks: dict[tuple[int, tuple, tuple], list[str]] = {}
    for block, path, away, text in nodes(page):
        blocks.setdefault((block, path, away), []).append(text)
    found = []
    for (_, path, away), parts in blocks.items():
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            found.append((path, away, text))
    return "\n\n".join(content(content_blocks(found)))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars``."""

    def run(batches):
        for b in batches:  # Arrow alone: pandas would turn long ids with a null into doubles
            texts = [extract(h or "") for h in b.column("html").to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), sizes],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = dict(pages.dtypes)["page_id"]
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long"
    )
