"""The main text of a web page: its best-scoring contiguous region.

A page is a sequence of words and tags. Words score positive and tags
negative; a linear scan finds the contiguous run of the greatest sum. The
weights come from labelled pages:

* the weight of a tag is the log of how much oftener it stands outside the
  main text than inside it, per word;
* the words outside the main text are put down to the outermost kind of
  element around them (a word of its class, id or role, or its name) that
  holds hardly any main text. Words in elements of such a kind score negative
  and are left out of a region that runs across them.

Labelled pages are the hand-marked ``EXAMPLES`` below and a bounded sample of
pages whose own markup names the main text (one ``article`` or ``main``).
The region is then completed to whole blocks, and to the element that holds
it if that is not the page itself.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import giving_back, prepare, rows_in_batches

SAMPLE = 400

# Elements by the HTML standard. Text of RAW ones is not shown; VOID ones have no end.
RAW = frozenset("script style noscript template textarea title iframe object svg math select datalist canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split())
#: An open element of the first ends where one of the second begins.
CLOSED_BY = {"p": BLOCK - {"option"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
             "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

DEEPEST = 512
FRAMES = ("article", "main")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_NAME = re.compile(r"[a-z]+")

# Hand-labelled pages: the main text stands between <!--main--> and <!--/main-->.
EXAMPLES = [
    '<html><body><header><a href="/">Town News</a><p>News from the town and its parks</p></header><nav><ul><li><a>Home</a></li><li><a>Sport</a></li></ul></nav>'
    '<div id="content"><!--main--><h1>Bridge opens</h1><p>The new bridge over the river was opened on Monday by the mayor.</p><p>It took two years to build.</p>'
    '<ul><li>It is wide.</li><li>It is long.</li></ul><!--/main--></div><aside class="sidebar"><h3>Most read</h3><ul><li><a>Bakery wins prize</a></li></ul></aside>'
    '<footer><p>All rights reserved by the town news company</p></footer></body></html>',
    '<body><div class="cookie-notice"><p>We use cookies to make this site work for you. Please accept them.</p><button>Accept</button></div>'
    '<div class="menu"><a>Start</a> <a>Shop</a> <a>Help</a></div><div class="post"><!--main--><h2>How to plant a tree</h2><div><p>Dig a hole that is wide and deep.</p>'
    '<p>Set the tree in it, <em>fill</em> the hole with earth and <a>water</a> it well.</p></div><blockquote>A tree is a gift.</blockquote><!--/main--></div>'
    '<div class="comments"><h3>Comments</h3><div class="comment"><p>I planted three of them last year and all of them grew very well in my garden.</p></div>'
    '<div class="comment"><p>Thank you for this text, it was a great help to me and to my family.</p></div></div></body>',
    '<body><div id="banner" class="ad"><p>Buy two pairs of shoes and get the third pair free, this week only.</p></div><div role="navigation"><a>One</a><a>Two</a></div>'
    '<div id="main"><div class="breadcrumb"><a>Home</a> / <a>Food</a></div><!--main--><h1>Soup</h1><p>Boil the water, then add salt.</p><table><tr><td>Salt</td><td>one spoon</td></tr></table>'
    '<p>Serve it hot.</p><!--/main--><form><label>Your name</label><input><p>Sign up to get our letter every week</p></form><div class="related"><h4>See also</h4><a>Bread</a></div></div>'
    '<div class="footer">Contact us by mail or by telephone at any time</div></body>',
    '<body><div class="site-header"><p>The daily reader, since many years the paper of this land</p></div><div class="share social"><a>Tell a friend</a></div>'
    '<section><!--main--><h1>Rain</h1><p>It will rain on Friday, and it will be cold in the hills.</p><figure><img><figcaption>Clouds over the hills</figcaption></figure>'
    '<p>Saturday stays dry.</p><!--/main--><div class="advert promo sponsored"><p>Umbrellas of all kinds, made to last, in our shop by the station.</p></div></section>'
    '<section id="disqus" class="reader-comments"><p>It never rains here at all, says one reader who has lived here for a long time.</p></section>'
    '<div class="newsletter subscribe"><p>Get the weather in your mail every morning before you get up.</p></div><div class="legal copyright"><p>No part may be used without leave.</p></div></body>',
    '<body><div class="site-content page"><article class="post-content entry-content article-body story text"><!--main--><header class="article-header entry-header"><h1>Wool</h1><p>From sheep to shirt.</p></header>'
    '<section><h2>Sheep</h2><p>A sheep is shorn once a year, in <span>spring</span>.</p><!--/main--><aside class="ad">Warm socks, now at half the price in our shop</aside><!--main--><dl><dt>Fleece</dt><dd>the wool of one sheep</dd></dl></section>'
    '<pre>wash, card, spin</pre><!--/main--><footer><p>Filed under animals and farms</p></footer><section class="comments"><p>My sheep is shorn twice a year, since it is a big one.</p></section></article></div></body>',
    '<body><div class="masthead topbar top"><p>Letters to the paper, from all over the land</p></div><div class="gdpr consent privacy"><p>Your data is safe with us, as our rules say.</p></div>'
    '<div class="layout row"><div class="col body copy"><!--main--><h1>Letter</h1><h2>To the editor</h2><p>Your last issue was a joy to read.</p><p><strong>Yours</strong>, a reader</p><!--/main-->'
    '<div class="ads advertisement"><p>Pens and ink, and paper too, from the mill.</p></div><nav class="toc"><a>Back</a></nav></div><div class="sidebar rail"><p>Write to us, we print the best letters of the week</p></div></div>'
    '<ul class="replies responses"><li class="reply">I do not agree with this letter at all, as I wrote last week.</li></ul><div class="feedback survey"><p>Was this page of use to you?</p></div></body>',
    '<body><div class="alert notice warning"><p>This site will be down for an hour on Sunday night while we work on it.</p></div><div class="toolbar"><a>Print</a></div>'
    '<main><!--main--><h1>Minutes</h1><p>The meeting began at nine and ended at ten.</p><ol><li>Budget was agreed.</li><li>Roads will be mended.</li></ol><!--/main--></main>'
    '<div class="widget"><p>Opening hours are from nine to five on all working days</p></div><div class="pagination pager"><a>1</a><a>2</a></div><div class="tags"><a>town</a></div>'
    '<div class="popup modal overlay"><p>Stay with us, we have many more stories for you to read today</p></div><div class="skip"><a>Skip to text</a></div></body>',
]


@dataclass
class _Page:
    """The tokens of a page: runs of words and tags, in order."""

    text: list[str] = field(default_factory=list)    # of a run of words; empty for a tag
    tag: list[str] = field(default_factory=list)     # name of a tag; empty for words
    path: list[tuple[int, ...]] = field(default_factory=list)   # the elements around the token
    linked: list[bool] = field(default_factory=list)
    main: list[bool] = field(default_factory=list)   # between the marks of a labelled page
    names: list[str] = field(default_factory=list)   # of the elements, by number
    kinds: list[tuple[str, ...]] = field(default_factory=list)  # what each element is called


def _kinds(name: str, attrs: str, framed: bool) -> tuple[str, ...]:
    """What an element is called: the words of its class, id and role, then its
    name, with a mark if no element around it is said to be the main text."""
    words = ["." + w for _, v in _ATTR.findall(attrs) for w in _NAME.findall(v.lower())] if "=" in attrs else []
    return tuple(w if framed else w + "^" for w in (*words, name))


def parse(page: str) -> _Page:
    """The tokens of a page. Unclosed and stray tags, and nesting beyond ``DEEPEST``, are taken about as browsers do."""
    out = _Page()
    stack: list[tuple[str, int]] = []  # name, number
    path: tuple[int, ...] = ()
    marked = False
    at, end = 0, len(page)

    def settle():
        nonlocal path
        path = tuple(n for _, n in stack)

    def token(text: str, tag: str):
        out.text.append(text)
        out.tag.append(tag)
        out.path.append(path)
        out.linked.append(any(n == "a" for n, _ in stack))
        out.main.append(marked)

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None or m.start() > at:
            token(page[at:m.start() if m else end], "")
        if m is None:
            break
        at = m.end()
        name = (m.group("name") or "").lower()
        if not name:
            mark = m.group()
            marked = mark == "<!--main-->" or marked and mark != "<!--/main-->"
            continue
        if m.group("end"):
            if any(n == name for n, _ in stack):
                token("", "/" + name)
                while stack.pop()[0] != name:
                    pass
                settle()
            elif name == "p":
                token("", "/p")
            continue
        if name in BLOCK:
            while stack and name in CLOSED_BY.get(stack[-1][0], ()):
                stack.pop()
            # a paragraph ends where a block begins, whatever inline elements are open in it
            open_p = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCK), None)
            if open_p is not None and stack[open_p][0] == "p" and name in CLOSED_BY["p"]:
                del stack[open_p:]
            settle()
        if name not in VOID and len(stack) < DEEPEST:
            stack.append((name, len(out.names)))
            out.names.append(name)
            out.kinds.append(_kinds(name, m.group("attrs"), any(n in FRAMES for n, _ in stack[:-1])))
            settle()
        token("", name)
        if name in RAW and stack and stack[-1][0] == name:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            stack.pop()
            settle()
    return out


@dataclass(frozen=True)
class Weights:
    """Scores of tags by name, and the kinds of elements that hold no main text."""

    tags: dict[str, float]
    other_tag: float
    outside: frozenset[str]


def learn(corpora: list[list[_Page]]) -> Weights:
    """Weights of labelled pages (``main`` says what is main text). A kind of
    element that holds main text in any of the corpora is not outside."""
    tags, words = (Counter(), Counter()), [1, 1]
    inside: set[str] = set()
    outside: set[str] = set()
    for pages in corpora:
        kinds = Counter(), Counter()
        for p in pages:
            for text, tag, path, main in zip(p.text, p.tag, p.path, p.main):
                tags[main].update([tag] if tag else [])
                n = len(text.split())
                words[main] += n
                for k in {k for e in path for k in p.kinds[e]} if n else ():
                    kinds[main][k] += n
        inside |= {k for k, n in kinds[True].items() if n * 50 > kinds[False][k]}
    for p in (p for pages in corpora for p in pages):
        for text, path, main in zip(p.text, p.path, p.main):
            if text.strip() and not main:
                outside |= next((b for b in (set(p.kinds[e]) - inside for e in path) if b), set())

    def cost(tag: str) -> float:
        ratio = (tags[0][tag] + 1) / words[0] / ((tags[1][tag] + 1) / words[1])
        return -min(8.0, max(0.1, math.log(ratio)))

    return Weights({t: cost(t) for t in tags[0] | tags[1]}, -1.0, frozenset(outside))


def _runs(page: _Page, weights: Weights):
    """Score of every token, and whether it is a word of possible main text."""
    out = [not weights.outside.isdisjoint(k) for k in page.kinds]
    scores, usable, around = [], [], {}
    for text, tag, path, linked in zip(page.text, page.tag, page.path, page.linked):
        if path not in around:
            around[path] = any(out[e] for e in path)
        n = len(text.split())
        if tag:
            scores.append(weights.tags.get(tag, weights.other_tag))
        else:
            scores.append(-n if around[path] else 0.25 * n if linked else n)
        usable.append(n > 0 and not around[path])
    return scores, usable


def region(page: _Page, weights: Weights) -> list[bool]:
    """Which tokens are main text: the best contiguous run by one linear scan, completed, without what is outside."""
    scores, usable = _runs(page, weights)
    best, total, begin, span = 0.0, 0.0, 0, None
    for i, s in enumerate(scores):
        total += s
        if total <= 0:
            total, begin = 0.0, i + 1
        elif total > best:
            best, span = total, (begin, i)
    if span is None:
        return [False] * len(scores)
    held = [i for i in range(span[0], span[1] + 1) if usable[i]]
    if not held:
        return [False] * len(scores)
    # The element around all of the region, unless it is the page itself.
    shared = page.path[held[0]]
    for i in held[1:]:
        n = next((k for k, (x, y) in enumerate(zip(shared, page.path[i])) if x != y), min(len(shared), len(page.path[i])))
        shared = shared[:n]
    frame = next((k for k in range(len(shared) - 1, -1, -1) if page.names[shared[k]] in FRAMES), None)
    if frame is not None:
        shared = shared[:frame + 1]
    first, last = held[0], held[-1]
    if shared and page.names[shared[-1]] not in ("html", "body"):  # what the scan left at its ends, but for links outside a frame
        depth = len(shared)
        inside = [i for i, p in enumerate(page.path) if usable[i] and p[:depth] == shared and (frame is not None or not page.linked[i])]
        first, last = min([first, *inside[:1]]), max([last, *inside[-1:]])
    while first > 0 and not _breaks(page, first - 1):  # whole blocks
        first -= 1
    while last + 1 < len(scores) and not _breaks(page, last + 1):
        last += 1
    return [first <= i <= last and usable[i] for i in range(len(scores))]


def _breaks(page: _Page, i: int) -> bool:
    return page.tag[i].lstrip("/") in BLOCK


def main_text(html: str | None, weights: Weights) -> str:
    """Main text of a page: a line per block, character references decoded, white space as one space."""
    if not html:
        return ""
    page = parse(html)
    blocks: list[list[str]] = [[]]
    for i, keep in enumerate(region(page, weights)):
        if keep or not (page.tag[i] or page.text[i].strip()):
            blocks[-1].append(page.text[i])
        elif page.tag[i] == "br":
            blocks[-1].append(" ")
        elif page.tag[i] and _breaks(page, i):
            blocks.append([])
    lines = (" ".join(_html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def labelled(html: str) -> _Page | None:
    """A page whose own markup names its main text by one ``article`` or ``main``, labelled by it; None for others."""
    page = parse(html)
    frames = [i for i, n in enumerate(page.names) if n in FRAMES]
    if len(frames) != 1:
        return None
    page.main = [frames[0] in p for p in page.path]
    return page


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE, longest: int = 200_000) -> Weights:
    """Weights learned from ``EXAMPLES`` and from at most ``sample`` pages of at
    most ``longest`` characters that name their main text (those of the least
    hash of id and page, so the same ones every time)."""
    key = F.xxhash64(F.col(id_col).cast("string"), html_col)
    named = pages.where((F.length(html_col) <= longest) & F.col(html_col).rlike("(?i)<(article|main)[\\s>]"))
    keys = [r[0] for r in named.select(key.alias("k")).distinct().orderBy("k").limit(sample).collect()]
    texts = [r[0] for r in named.where(key.isin(keys)).select(html_col).distinct().orderBy(html_col).limit(sample).collect()] if keys else []
    return learn([[parse(e) for example in EXAMPLES for e in (example, f"<article>{example}</article>")], [p for p in map(labelled, texts) if p is not None]])


def extract(pages: DataFrame, weights: Weights | None = None, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``pages`` with text (the main text) and n_chars (its code points) in
    place of ``html_col``.

    ``weights`` are those of ``fit`` on these pages unless given. Null and
    empty pages, pages without words and pages without a run of words that
    outweighs its tags have an empty text. Pages are read whole, broken and
    cut-off markup included; every row stays, repeated ids and rows too. Input
    columns named like the new ones are replaced. An empty table gives no rows.
    """
    prepare(pages.sparkSession)
    weights = weights or fit(pages, id_col, html_col)
    pages = pages.drop(*[c for c in ("text", "n_chars") if c != html_col])
    kept = [f for f in pages.schema.fields if f.name != html_col]
    pages = pages.select(*[F.col(f.name) for f in kept], html_col)

    def run(batches):
        for b in rows_in_batches(batches, 500):
            texts = [main_text(h, weights) for h in b.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(kept)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [*[f.name for f in kept], "text", "n_chars"])

    schema = T.StructType([*kept, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.mapInArrow(giving_back(run), schema)
