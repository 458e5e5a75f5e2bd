"""Main text of web pages by the maximum-scoring contiguous run of words and tags.

A page is read as a sequence of tags and runs of words. Words score above zero (less in links and
in elements that are named as advertising, menus or the like), tags below, and what is left out nothing; one linear scan finds
the run with the largest sum, and its words are the text, with those of the blocks in which it begins and ends. Tags within
a line are free, and lists, tables and headings are no dearer than paragraphs where their words aren't linked. Elements of the kinds that never belong to
an article are left out of the run as well, unless they hold the article.

Weights come from pages that label themselves: exactly one ``article`` (else ``main``) element
marks what is inside. They start as log-odds of being inside and are then mended by a structured
perceptron until the best run is the marked one. Training is bounded to ``TRAIN_PAGES`` pages in
order of a hash of the id and the page (repeated rows are learned from once); without any labelled page ``PLAIN`` weights hold.

Defined cases: null html is empty and gives the empty text; unclosed elements end with the page;
repeated rows are extracted each; an empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.sources.stores import saved

TRAIN_PAGES, EPOCHS = 300, 10
UNSEEN = "unseen"
#: Kinds of tags whose weights aren't learned.
FREE = ("inline", "flow", "/flow", "out", "word out")
#: Weights where no page of the corpus labels itself.
PLAIN = {"word": 1.0, "word a": -0.5, "word out": 0.0, "out": 0.0, "word named": -0.5, "p": -0.01, "/p": -0.01, "flow": -0.01, "/flow": -0.01, "inline": 0.0, UNSEEN: -3.0}
#: Elements without page text, elements around an article, inline elements.
HIDDEN = "script style noscript template title textarea iframe svg object canvas"
OUTSIDE = set("nav aside form footer menu dialog button select".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that divide text inside an article: where the words next to them aren't linked they are no dearer than a paragraph.
FLOW = set("li dt dd dl ul ol td th tr table thead tbody tfoot caption pre blockquote h2 h3 h4 h5 h6 figcaption figure section br hr".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
NAMED = re.compile(
    r"(?i)(?:class|id|role)\s*=\s*[\"']?[^\"'>]*(?<![a-z])(?:ads?|adverts?|advertisement|adbox|banner|breadcrumbs?|comments?|comment-list|cookies?|consent|disqus|footer|gdpr|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|paywall|popup|promo|promoted|related|respond|search|share|sharing|sidebar|social|sponsor|sponsored|subscribe|toolbar|widget)(?![a-z])"
)
#: Whole class, id or role tokens of elements to leave out; NAMED has them as parts too.
NAMES = set(
    "ad ads advert adverts advertisement adbox banner breadcrumb breadcrumbs comment comments comment-list cookie cookies consent disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice paywall popup promo promoted related respond search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
_TOKENS = re.compile(r"(?i)(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: Tags that end open elements by HTML's rules, and the elements in which such ends stay.
_BLOCK = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "option": {"option"}}
_ENDS |= {n: {"td", "th", "tr", "thead", "tbody", "tfoot"} for n in ("thead", "tbody", "tfoot")} | {n: {"p"} for n in _BLOCK}
_SCOPES = {n: {"table"} for n in ("td", "th", "tr", "thead", "tbody", "tfoot")} | {n: set("ul ol menu dl table td th select".split()) for n in ("li", "dt", "dd", "option")}
_P_SCOPE = set("table td th caption button object".split())
_DROP = re.compile(rf"(?is)<!--.*?(?:-->|\Z)|<svg\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>|<({HIDDEN.replace(' ', '|')})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)[^>]*>")


def _elements(tags: list[tuple[str, bool]]) -> list[int]:
    """For each (name, close) the index of the tag that ends its element; its own for end tags and void ones."""
    ends = list(range(len(tags)))
    stack: list[int] = []
    open_: Counter = Counter()

    def pop(i: int) -> str:
        j = stack.pop()
        ends[j] = i
        open_[tags[j][0]] -= 1
        return tags[j][0]

    for i, (name, close) in enumerate(tags):
        if close:
            if not open_[name]:
                continue
            if name in INLINE:  # doesn't end blocks in it
                k = len(stack) - 1
                while tags[stack[k]][0] != name and tags[stack[k]][0] in INLINE:
                    k -= 1
                if tags[stack[k]][0] != name:
                    continue
            while pop(i) != name:
                pass
            continue
        gone = _ENDS.get(name)
        if gone and any(open_[g] for g in gone):
            stay = _SCOPES.get(name, _P_SCOPE)
            k, cut = len(stack) - 1, len(stack)
            while k >= 0 and tags[stack[k]][0] not in stay:
                if tags[stack[k]][0] in gone:
                    cut = k
                    if name not in ("tr", "thead", "tbody", "tfoot"):
                        break
                elif "p" in gone and tags[stack[k]][0] not in INLINE:
                    break
                k -= 1
            while len(stack) > cut:
                pop(i)
        if name not in VOID:
            stack.append(i)
            open_[name] += 1
    while stack:
        pop(len(tags))
    return ends


def tokens(page: str) -> list[tuple[str, int, str, bool]]:
    """(key, words, text, out) of each tag (no words) and run of words; out: in an element to leave out.

    Left out are elements of the OUTSIDE kinds and those that have one of NAMES as a whole token, but
    none that holds an article or main element, and for its name (or as a form) none that holds
    most of the page's words. Outside of articles a name as a part only gives words a key of their own.
    """
    page = _DROP.sub(" ", page)
    found = [(m, (m[2] or m[5]).lower(), bool(m[1] if m[2] else m[4])) for m in _TAG.finditer(page)]
    ends = _elements([(name, close) for _, name, close in found])
    pieces = [page[(found[i - 1][0].end() if i else 0) : (found[i][0].start() if i < len(found) else len(page))] for i in range(len(found) + 1)]
    counts = [len(p.split()) for p in pieces]
    before, articles = [0], [0]
    for i, (_, name, close) in enumerate(found):
        before.append(before[-1] + counts[i])
        articles.append(articles[-1] + (name in ("article", "main") and not close))
    total = before[-1] + counts[-1]
    before.append(total)
    made: list[tuple[str, int, str, bool]] = []
    out, named, links, article, last = -1, -1, 0, 0, -1  # the tags that end what is left out or named

    for i, (m, name, close) in enumerate(found):
        if pieces[i]:
            made.append(("word out" if out >= i else "word a" if links else "word named" if named >= i and article <= 0 else "word", counts[i], pieces[i], out >= i))
        if name in ("article", "main"):
            article += -1 if close else 1
        if out <= i and not close and name not in VOID and name not in ("html", "body", "article", "main"):
            rest, end = m[3] or "", ends[i]
            hit = rest and NAMED.search(rest)
            whole = hit and any(t in NAMES for a in _TOKENS.findall(rest) for t in "".join(a).lower().split())
            most = 2 * (before[min(end, len(found)) + 1] - before[i + 1]) > total
            kind = name in OUTSIDE or (name == "header" and article <= 0)
            holds = articles[min(end, len(found))] > articles[i]
            if not holds and ((kind and not (name == "form" and most)) or (whole and not most)):
                out = end
                if end < len(found) and found[end][1:] == (name, True):
                    last = end
            elif hit and not holds and not most:
                named = max(named, end)
        if name == "a":
            links = 0 if close else 1
        # an implied end leaves out the tag before, not the one that ends it; an end tag of its own goes too
        made.append((("/" if close else "") + name, 0, "", out > i or last == i))
    if pieces[-1]:
        i = len(found)
        made.append(("word out" if out >= i else "word a" if links else "word named" if named >= i and article <= 0 else "word", counts[-1], pieces[-1], out >= i))
    return _classed(made)


def _classed(made: list[tuple[str, int, str, bool]]) -> list[tuple[str, int, str, bool]]:
    """What is left out weighs nothing; inline tags but links are one kind, and so are tags of FLOW where the words they hold are an article's own.

    For a start tag these are the next words, for an end tag those before it.
    """
    follow, near = [""] * len(made), ""
    for i in range(len(made) - 1, -1, -1):
        follow[i] = near
        if made[i][1] and not made[i][3]:
            near = made[i][0]
    out, before = [], ""
    for (key, n, text, gone), after in zip(made, follow, strict=True):
        name = key.lstrip("/")
        if gone:
            key = "word out" if key[:4] == "word" else "out"
        elif n:
            before = key
        elif name in INLINE and name != "a":
            key = "inline"
        elif name in FLOW and (before if key[0] == "/" else after) == "word":
            key = "/flow" if key[0] == "/" else "flow"
        out.append((key, n, text, gone))
    return out


def best(items: list[tuple[str, int]], weights: dict[str, float]) -> tuple[int, int]:
    """The run [lo, hi) with the largest sum above zero; the first and shortest of several."""
    unseen = weights.get(UNSEEN, PLAIN[UNSEEN])
    top, lo, hi, total, start = 0.0, 0, 0, 0.0, 0
    for i, (key, n) in enumerate(items):
        if total <= 0:
            total, start = 0.0, i
        total += weights.get(key, unseen) * n if n or key[:4] == "word" else weights.get(key, unseen)
        if total > top:
            top, lo, hi = total, start, i + 1
    return lo, hi


def extended(items: list[tuple[str, int]], lo: int, hi: int) -> tuple[int, int]:
    """The run with the whole blocks in which it begins and ends: words and inline tags up to the next other tag."""
    if lo == hi:
        return lo, hi
    within = lambda key: key[:4] == "word" or key in ("inline", "a", "/a")
    while lo and within(items[lo][0]) and within(items[lo - 1][0]):
        lo -= 1
    while hi < len(items) and within(items[hi - 1][0]) and within(items[hi][0]):
        hi += 1
    return lo, hi


def label(items: list[tuple[str, int]]) -> tuple[int, int] | None:
    """What the page's one article (or main) element holds; None if it hasn't just one."""
    for name in ("article", "main"):
        first = [i for i, (k, _) in enumerate(items) if k == name]
        last = [i for i, (k, _) in enumerate(items) if k == "/" + name]
        if len(first) == 1 and len(last) == 1 and last[0] > first[0]:
            return first[0] + 1, last[0]
    return None


def learn(pages: list[list[tuple[str, int]]]) -> dict[str, float]:
    """Weights of keys from labelled pages."""
    marked = [(p, r) for p in pages if (r := label(p))]
    if not marked:
        return dict(PLAIN)
    inside, outside = Counter(), Counter()
    for items, (lo, hi) in marked:
        for i, (key, n) in enumerate(items):
            (inside if lo <= i < hi else outside)[key] += n if key[:4] == "word" else 1
    weights = {}
    for key in inside.keys() | outside.keys():
        odds = (inside[key] + 0.5) / (outside[key] + 0.5)
        weights[key] = min(max(odds - 1, -1.0), 1.0) if key[:4] == "word" else min(-0.01, 10.0 * (min(odds, 1.0) - 1))
    weights |= {k: PLAIN[k] for k in FREE}
    weights.setdefault("word", 1.0)
    weights.setdefault("word named", PLAIN["word named"])
    weights["word"] = max(weights["word"], 0.1)
    weights[UNSEEN] = PLAIN[UNSEEN]

    def tight(items: list, lo: int, hi: int) -> tuple[int, int]:
        """Without the tags at its ends, which never belong to a best run."""
        while lo < hi and not items[lo][1]:
            lo += 1
        while hi > lo and not items[hi - 1][1]:
            hi -= 1
        return lo, hi

    for _ in range(EPOCHS):
        wrong = 0
        for items, (lo, hi) in marked:
            want, got = tight(items, lo, hi), best(items, weights)
            if want == got:
                continue
            wrong += 1
            step: Counter = Counter()
            for (a, b), sign in ((want, 1), (got, -1)):
                for key, n in items[a:b]:
                    step[key] += sign * (n if key[:4] == "word" else 1)
            scale = 1.0 / (1 + max(map(abs, step.values()), default=1))
            for key, n in step.items():
                if key in FREE:
                    continue
                weights[key] += scale * n
                if key == "word":
                    weights[key] = max(weights[key], 0.1)
                elif key[:4] != "word":
                    weights[key] = min(weights[key], -0.01)
        if not wrong:
            break
    return weights


def extract(page: str, weights: dict[str, float]) -> str:
    found = tokens(page)
    items = [(k, n) for k, n, _, _ in found]
    lo, hi = extended(items, *best(items, weights))
    parts = []
    for key, _, text, out in found[lo:hi]:
        if key[:4] == "word":
            parts.append(" " if out else html.unescape(text))
        elif key not in ("inline", "a", "/a"):
            parts.append(" ")
    return " ".join("".join(parts).split())


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [tokens(p or "") for p in batch["html"].to_pylist()]
        keys = pa.array([[t[0] for t in p] for p in made], pa.list_(pa.string()))
        counts = pa.array([[t[1] for t in p] for p in made], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch["place"], keys, counts], ["place", "keys", "counts"])


def trained(pages: DataFrame) -> dict[str, float]:
    own = pages.select("page_id", "html").where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    place = F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.xxhash64("html").cast("string")))
    own = own.select(place.alias("place"), "html")
    picked = saved(own.select("place").distinct().orderBy("place").limit(TRAIN_PAGES))
    kind = "place string, keys array<string>, counts array<int>"
    rows = own.join(F.broadcast(picked), "place").dropDuplicates(["place"]).mapInArrow(_tokens, kind).collect()  # at most TRAIN_PAGES
    rows = sorted(rows, key=lambda r: (r["place"], r["keys"]))
    return learn([list(zip(r["keys"], r["counts"], strict=True)) for r in rows])


def extracted(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages``."""
    weights = trained(pages) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [extract(p or "", weights) for p in part["html"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
