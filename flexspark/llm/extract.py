"""Main text of web pages: the maximum-scoring contiguous run of a page's words and tags.

A page is read as a row of tags and text runs, tolerant of what browsers tolerate: tags left open or closed twice, quotes left open, a page cut off
anywhere. Comments, declarations and the content of scripts, styles and their like are no text. A tag ends a paragraph, cell or list entry that HTML lets end
unsaid.

Furniture never is text: elements that are no article by their meaning (DROPPED; a page's header, not an article's own) and those that say so in
their class, id or role (HINTS), with all they hold, except an article or main element in one that isn't for comments or related pages.

Scores: a text run scores its words' weight each, positive for the article's words, negative for others; a tag scores its (negative) weight.
Kadane's linear scan finds the run of highest score, and the blocks it touches, less the furniture, are the text. Weights are log odds of
standing in the article, learned from labelled pages: those that mark their article themselves (an article element, else a main one). They
are kept for words inside a mark, beside it, and for unmarked pages (from the same pages, marks ignored), by the innermost block element and
whether in a link. The labelled pages are a bounded sample (LABELLED pages, those with the smallest key hashes); all pages are extracted.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELLED = 4000

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header"
    " hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
INLINE = frozenset("a abbr acronym b bdi bdo big br button canvas cite code del dfn em font i img input ins kbd label map mark object q rp rt ruby s samp small span strike strong sub sup svg time tt u var video wbr".split())
DROPPED = frozenset("aside button canvas dialog footer form head iframe math menu nav noscript object script search select style svg template textarea title".split())
ENDS_P = BLOCK - frozenset("body caption dd dt frameset head html legend li optgroup option tbody td tfoot th thead tr".split())
# which open elements a start tag ends unsaid, and the elements behind which it doesn't look for them
ENDED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "a": ({"a"}, {"table", "td"}),
}

# First or last part of a class name or id.
HINTS = frozenset(
    "ad ads adbanner adbox adsense adslot advert advertisement advertisements advertising adverts aside banner breadcrumb breadcrumbs byline-share colophon comment commentlist"
    " comments consent cookie cookies disclaimer discussion disqus footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices overlay pager"
    " pagination popup promo promoted promotion related recommended recommendations replies reply respond rail search share sharebar sharing sidebar signup social sponsor sponsored"
    " subscribe subscription toolbar topbar widget widgets".split()
)
FIRM = frozenset("comment comments commentlist discussion disqus replies reply respond related recommended recommendations promoted sponsored".split())
NEGATED = frozenset("has with no without not js is".split())
OWN = frozenset("article content entry post story".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
PART = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")

NONE, SOFT, HARD = 0, 1, 2
FREE, ARTICLE, MAIN = 0, 1, 2


class Run(NamedTuple):
    """A text run: its text, number of words, block number, innermost block element, whether in a link, furniture, in an article, in main."""

    text: str
    words: int
    block: int
    inside: str
    link: bool
    dropped: bool
    article: bool
    main: bool


def hinted(attributes: str) -> int:
    """What class, id and role say of an element: nothing, furniture, or furniture whatever it holds."""
    level = NONE
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value = html.unescape(a or b or c)
        if name.lower() == "role":
            level = max(level, SOFT if value.strip().lower() in ROLES else NONE)
            continue
        for token in value.split():
            parts = [p.lower() for p in PART.findall(token)]
            if not parts or parts[0] in NEGATED:
                continue
            for p in (parts[0], parts[-1]):
                if p in HINTS and not (p == "header" and parts[0] in OWN):
                    level = max(level, HARD if p in FIRM else SOFT)
    return level


def marks_main(attributes: str) -> bool:
    return any(n.lower() == "role" and (a or b or c).strip().lower() == "main" for n, a, b, c in ATTRIBUTE.findall(attributes))


def read(page: str) -> list[Run | tuple[str, bool, bool]]:
    """The page's text runs and tags (name, in an article, in main), in order."""
    out: list = []
    stack: list[tuple[str, int, bool, bool]] = []  # element, furniture, in an article, in main
    open_ = Counter()
    block, at, size = 0, 0, len(page)

    def state() -> tuple[int, bool, bool]:
        return stack[-1][1:] if stack else (NONE, False, False)

    def text(s: str) -> None:
        if s and not s.isspace():
            s = html.unescape(s)
            drop, article, main = state()
            inside = next((e[0] for e in reversed(stack[-32:]) if e[0] in BLOCK), "body")
            out.append(Run(s, len(s.split()), block, inside, open_["a"] > 0, drop > 0, article, main))
        elif s:
            out.append(Run(" ", 0, block, "", False, state()[0] > 0, *state()[1:]))

    def close(depth: int) -> None:
        for e in stack[depth:]:
            open_[e[0]] -= 1
        del stack[depth:]

    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        if m[1] is None:
            continue
        name, attributes = m[1].lower(), m[2]
        if page[m.start() + 1] == "/":
            if name in BLOCK:
                block += 1
                if open_[name] > 0:
                    close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            elif name == "br":
                text(" ")
            elif open_[name] > 0:
                # an inline element ends alone, also under blocks left open
                low = next((i for i in range(len(stack) - 1, max(-1, len(stack) - 65), -1) if stack[i][0] == name), None)
                if low is not None:
                    if any(e[0] in BLOCK for e in stack[low + 1 :]):
                        open_[name] -= 1
                        del stack[low]
                    else:
                        close(low)
            out.append((f"/{name}", *state()[1:]))
            continue
        if name in BLOCK:
            block += 1
        if name in ENDS_P and open_["p"] > 0:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in ("button", "td", "th", "table", "caption", "object"):
                    break
        if name in ENDED:
            ended, behind = ENDED[name]
            if any(open_[e] > 0 for e in ended):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ended:
                        close(i)
                        break
                    if stack[i][0] in behind:
                        break
        out.append((name, *state()[1:]))
        if name in VOID:
            if name == "br":
                text(" ")
            continue
        drop, article, main = state()
        said = hinted(attributes) if attributes else NONE
        if name in ("article", "main"):
            drop = HARD if drop == HARD or said == HARD else NONE
            article, main = article or (name == "article" and drop == NONE), main or name == "main"
        elif name not in ("html", "body"):
            if name in DROPPED or (name == "header" and not article):
                said = max(said, SOFT)
            drop = max(drop, said)
        if attributes and marks_main(attributes):
            main, drop = True, HARD if drop == HARD else NONE
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else size
        stack.append((name, drop, article, main))
        open_[name] += 1
    return out


def marked(tokens: list) -> int:
    """How the page marks its article: by an article element with words, by a main element, or not."""
    runs = [t for t in tokens if isinstance(t, Run) and t.words and not t.dropped]
    return ARTICLE if any(r.article for r in runs) else MAIN if any(r.main for r in runs) else FREE


def _feature(t, mark: int) -> tuple[str, bool]:
    """Weight's name for a run or tag, and whether it stands in the mark."""
    if isinstance(t, Run):
        within = t.article if mark == ARTICLE else t.main
        return f"{t.inside if t.inside in BLOCK else 'other'} {'link' if t.link else 'text'}", within
    name = t[0].lstrip("/")
    return f"<{name if name in BLOCK or name in INLINE else 'other'}>", t[1] if mark == ARTICLE else t[2]


def learn(pages: DataFrame) -> DataFrame:
    """(feature, within, beside): words and tags of the labelled pages (column html) in and beside their articles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[str, list[int]] = {}
        for batch in batches:
            for i in range(len(batch)):
                tokens = read(batch["html"][i].as_py() or "")
                mark = marked(tokens)
                if mark == FREE:
                    continue
                for t in tokens:
                    if isinstance(t, Run) and (t.dropped or not t.words):
                        continue
                    name, within = _feature(t, mark)
                    n.setdefault(name, [0, 0])[0 if within else 1] += t.words if isinstance(t, Run) else 1
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([v[0] for v in n.values()], pa.int64()), pa.array([v[1] for v in n.values()], pa.int64())], names=["feature", "within", "beside"])

    return pages.select("html").mapInArrow(run, "feature string, within long, beside long").groupBy("feature").agg(F.sum("within").alias("within"), F.sum("beside").alias("beside"))


PRIOR = 20.0
WORD, LINK, TAG, BESIDE, CROSSED = 1.0, -0.5, -0.05, -1.0, -0.2


def weights(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Score of each feature on unmarked pages: log odds, between -1 and 1, drawn to the prior by PRIOR observations; tags stay negative."""
    total = [sum(v[i] for v in counts.values()) + PRIOR for i in (0, 1)]
    out = {}
    for name, (within, beside) in counts.items():
        prior = TAG if name[0] == "<" else LINK if name.endswith("link") else WORD
        n = within + beside
        odds = np.log((within + 1) / total[0]) - np.log((beside + 1) / total[1])
        score = (n * float(np.clip(odds, -1, 1)) + PRIOR * prior) / (n + PRIOR)
        out[name] = min(TAG, score) if name[0] == "<" else score
    return out


def scored(tokens: list, learned: dict[str, float]) -> np.ndarray:
    """The score of each run and tag."""
    mark = marked(tokens)
    out = np.zeros(len(tokens))
    for i, t in enumerate(tokens):
        name, within = _feature(t, mark)
        if not isinstance(t, Run):
            out[i] = (TAG / 10 if within else BESIDE) if mark else learned.get(name, TAG)
        elif t.dropped:
            out[i] = 0.0 if mark and within else CROSSED * t.words
        elif mark:
            out[i] = (WORD if within else BESIDE) * t.words
        else:
            out[i] = learned.get(name, LINK if t.link else WORD) * t.words
    return out


def best(scores: np.ndarray) -> tuple[int, int]:
    """First and last place of the run with the highest sum (the first of several, the shortest at its start); (0, -1) if none is above 0."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    low = np.minimum.accumulate(total)
    gain = total[1:] - low[:-1]
    if not len(gain) or gain.max() <= 0:
        return 0, -1
    last = int(np.argmax(gain))
    return last - int(np.argmin(total[last::-1] > low[last])), last


def main_text(page: str | None, learned: dict[str, float]) -> str:
    """The article's blocks, white space made single, joined by blank lines; empty if there is none."""
    tokens = read(page or "")
    first, last = best(scored(tokens, learned))
    if last < first:
        return ""
    mark = marked(tokens)
    touched = {t.block for t in tokens[first : last + 1] if isinstance(t, Run) and t.words and not t.dropped}
    blocks: dict[int, list[str]] = {}
    for t in tokens:
        if isinstance(t, Run) and t.block in touched and not t.dropped and (mark == FREE or (t.article if mark == ARTICLE else t.main)):
            blocks.setdefault(t.block, []).append(t.text)
    made = (" ".join("".join(b).split()) for b in blocks.values())
    return "\n\n".join(b for b in made if b)


def fit(pages: DataFrame, key: str = "page_id", column: str = "html") -> dict[str, float]:
    """Weights from the pages that mark their article, of LABELLED keys at most (all rows of a key). No such page: the priors."""
    rows = pages.select(F.col(f"`{key}`").alias("k"), F.col(f"`{column}`").alias("html"))
    named = rows.where(F.col("html").rlike(r"(?i)<(article|main)[\s>]") & F.col("k").isNotNull()).select("k").distinct()
    taken = named.orderBy(F.xxhash64("k"), "k").limit(LABELLED)
    sample = rows.join(F.broadcast(taken), "k", "left_semi")  # LABELLED keys
    return weights({r["feature"]: (r["within"], r["beside"]) for r in learn(sample).collect()})  # one row for each element name and kind


def extract(pages: DataFrame, keep: list[str], column: str = "html", key: str = "page_id", learned: dict[str, float] | None = None) -> DataFrame:
    """The kept columns, ``text`` and ``n_chars`` (code points) of every row; one pass without shuffle after the weights are known.

    A null or empty page, one of furniture alone and one whose best run scores nothing have empty text. Rows that repeat give a row each, null keys
    included; pages of any length are read whole. Other columns are ignored. A form that holds a page's article in neither an article nor a
    main element is a form, and its text is lost.
    """
    learned = fit(pages, key, column) if learned is None else learned
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{column}`").alias("__html"))
    fields = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-1])
    shared = pages.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = [main_text(part["__html"][i].as_py(), learned) for i in range(len(part))]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(keep))], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    return rows.mapInArrow(run, f"{fields}, text string, n_chars long")
