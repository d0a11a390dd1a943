"""Main text of web pages by a graphical model on the tree of their blocks.

Every block element is a node with two states, content and boilerplate. Its own
features and a potential between parent and child say how likely each state is;
sum-product messages, first up the tree and then down, give exact marginals.
"""

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 240  # labelled pages the potentials are learned from
SAMPLE_BYTES = 256 << 10  # longer pages teach nothing
ROUNDS = 20
PULL = 0.02  # towards the prior, an update

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")
_CUT = re.compile(r"<[a-zA-Z/!?]")

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template textarea title svg math iframe object audio video canvas select button datalist".split())
RAW = {"script", "style", "title", "textarea"}  # hold no tags, and go on to the end of the page without an end tag
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label map mark meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "body": {"head"}}
WALLS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
BOUNDARY = set("html body article section main div nav aside header footer table td th form ul ol".split())
# Words in class, id and role that tell menus, adverts, notices and comments from articles.
BAD = set("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie cookies consent disqus footer form gdpr header hero login masthead menu modal nav navbar navigation newsletter notice pagination pager popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget".split())
GOOD = set("article articlebody body content entry main post story text".split())
LANDMARKS = {"article", "main"}
ASIDE = {"nav", "aside", "footer", "header", "form", "head"}
PRIOR = {"tag:nav": -4, "tag:footer": -4, "tag:aside": -4, "tag:header": -4, "tag:form": -4, "tag:head": -4, "tag:fieldset": -3, "tag:menu": -3, "tag:dialog": -3, "tag:article": 3, "tag:main": 2, "tag:p": 0.5, "tag:h1": 0.3,
         "bad": -4, "good": 1, "links:2": -1.5, "links:3": -3, "size:6": 0.5, "size:7": 1, "size:8": 1, "size:9": 1, "size:10": 1}
PAIR_PRIOR = [[1.5, -1.0], [-1.0, 1.5]]  # [parent][child]; 1 is content


class Page:
    """Block tree: parent, tag and attribute words of each node, and the pieces of text in page order."""

    def __init__(self, html: str):
        self.parent, self.tag, self.words = [-1], ["html"], [[]]
        self.pieces: list[tuple[int, str]] = []
        self.links = [0]
        self._open, self._inside_link = [0], 0
        at, n, ends = 0, len(html), {}
        for m in iter(lambda: _TAG.search(html, at), None):
            self._text(html[at : m.start()])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            if m[1] or m[4]:
                self._end(name)
            elif name in HIDDEN:
                closed = name not in RAW and m[0].endswith("/>")
                if not closed and name not in ends:  # no end tag is looked for twice
                    ends[name] = re.compile(rf"</{name}(?![\w:-])[^>]*>", re.I)
                end = ends[name].search(html, at) if not closed and ends[name] else None
                if end:
                    at = end.end()
                elif name in RAW:
                    at = n
                elif not closed:
                    ends[name] = None
                self._text(" ")
            else:
                self._start(name, m[3] or m[6] or "")
        tail = html[at:]
        cut = _CUT.search(tail)
        self._text(tail[: cut.start()] if cut else tail)

    def _text(self, text: str) -> None:
        if text:
            text = unescape(text) if "&" in text else text
            self.pieces.append((self._open[-1], text))
            if self._inside_link:
                self.links[self._open[-1]] += len(text)

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._text("\n")
            return
        if name == "a":
            self._inside_link = 1
        if name in VOID or name in INLINE:
            return
        self._inside_link = 0
        if name in CLOSES_P:
            self._close({"p"}, BOUNDARY)
        if name in CLOSED_BY:
            self._close(CLOSED_BY[name], WALLS.get(name, set()))
        words = [w for _, value in _ATTRIBUTE.findall(attributes) for w in _WORD.findall(value.lower())] if attributes else []
        if name in ("html", "body") and name in [self.tag[i] for i in self._open]:
            return
        self.parent.append(self._open[-1])
        self.tag.append(name)
        self.words.append(words)
        self.links.append(0)
        self._open.append(len(self.tag) - 1)

    def _end(self, name: str) -> None:
        if name == "a":
            self._inside_link = 0
        if name not in INLINE and name not in VOID and name not in ("html", "body"):
            self._close({name}, BOUNDARY - {name} if name in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6") else set())

    def _close(self, names: set, walls: set) -> None:
        for k in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[k]]
            if tag in names:
                del self._open[k:]
                return
            if tag in walls:
                return

    def features(self, landmarks: bool = True) -> list[list[str]]:
        sizes, ends = [0] * len(self.tag), [False] * len(self.tag)
        for node, text in self.pieces:
            if stripped := text.strip():
                sizes[node] += len(stripped)
                ends[node] = stripped[-1] in ".!?…"
        out = []
        for tag, words, size, links, end in zip(self.tag, self.words, sizes, self.links, ends, strict=True):
            own = ["bias", f"tag:{tag if landmarks or tag not in LANDMARKS else 'div'}"]
            if words:
                known = set(words)
                own += [f"word:{w}" for w in known]
                if known & BAD:
                    own.append("bad")
                elif known & GOOD:
                    own.append("good")
            if size:
                own += [f"size:{min(10, size.bit_length())}", f"links:{min(3, 4 * links // size)}"]
                if end:
                    own.append("sentence")
            out.append(own)
        return out

    def labels(self) -> list[int] | None:
        """Content is what lies in a landmark and in no aside; None without landmarks."""
        out = []
        for parent, tag, words in zip(self.parent, self.tag, self.words, strict=True):
            inherited = out[parent] if parent >= 0 else 0
            if tag in ASIDE or BAD & set(words):
                inherited = -1
            elif tag in LANDMARKS and inherited >= 0:
                inherited = 1
            out.append(inherited)
        return [int(x == 1) for x in out] if 1 in out else None

    def text(self, content: list[float]) -> str:
        out, last = [], None
        for node, text in self.pieces:
            if content[node] >= 0.5:
                if node != last:
                    out.append("\n")
                out.append(text)
            last = node
        return " ".join("".join(out).split())


def _either(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def marginals(parent: list[int], score: list[float], pair: list[list[float]]) -> tuple[list[float], list[tuple]]:
    """P(content) of every node, and for each node but the root the joint of parent and child states (00, 01, 10, 11).

    ``score`` is each node's log-odds by itself; parents come before their children.
    """
    n = len(parent)
    (p00, p01), (p10, p11) = pair
    below0, below1 = [0.0] * n, list(score)
    up0, up1 = [0.0] * n, [0.0] * n
    for i in range(n - 1, 0, -1):
        up0[i], up1[i] = _either(p00 + below0[i], p01 + below1[i]), _either(p10 + below0[i], p11 + below1[i])
        below0[parent[i]] += up0[i]
        below1[parent[i]] += up1[i]
    full0, full1 = list(below0), list(below1)  # with what comes from above
    out, edges = [0.0] * n, []
    for i in range(n):
        if i:
            above0, above1 = full0[parent[i]] - up0[i], full1[parent[i]] - up1[i]
            joint = (above0 + p00 + below0[i], above0 + p01 + below1[i], above1 + p10 + below0[i], above1 + p11 + below1[i])
            top = max(joint)
            joint = [math.exp(x - top) for x in joint]
            total = sum(joint)
            edges.append(tuple(x / total for x in joint))
            full0[i] += _either(above0 + p00, above1 + p10)
            full1[i] += _either(above0 + p01, above1 + p11)
        gap = min(700.0, max(-700.0, full0[i] - full1[i]))
        out[i] = 1 / (1 + math.exp(gap))
    return out, edges


class Model:
    def __init__(self):
        self.weights, self.pair = dict(PRIOR), [list(row) for row in PAIR_PRIOR]

    def content(self, page: Page) -> list[float]:
        w = self.weights
        return marginals(page.parent, [sum(w.get(f, 0.0) for f in own) for own in page.features()], self.pair)[0]

    def fit(self, pages: list[Page], rate: float = 0.5) -> "Model":
        """Gradient ascent on the likelihood of the labels. Landmark tags are hidden in every other page, so that other evidence is learned too."""
        seen = [(p.parent, p.features(k % 2 == 0), labels) for k, p in enumerate(pages) if (labels := p.labels())]
        grown: dict[str, float] = {}
        for _ in range(ROUNDS):
            for parent, features, labels in seen:
                p, edges = marginals(parent, [sum(self.weights.get(f, 0.0) for f in own) for own in features], self.pair)
                for own, y, q in zip(features, labels, p, strict=True):
                    if abs(y - q) > 1e-3:
                        for f in own:
                            w = self.weights.get(f, 0.0)
                            step = y - q - PULL * (w - PRIOR.get(f, 0.0))
                            grown[f] = grown.get(f, 1.0) + step * step
                            self.weights[f] = w + rate * step / math.sqrt(grown[f])
                for i, joint in enumerate(edges, 1):
                    for a in (0, 1):
                        for b in (0, 1):
                            gap = (labels[parent[i]] == a and labels[i] == b) - joint[2 * a + b]
                            self.pair[a][b] += 0.01 * (gap - PULL * (self.pair[a][b] - PAIR_PRIOR[a][b]))
        return self


def learn(pages: DataFrame, sample: int = SAMPLE_PAGES, most: int = SAMPLE_BYTES) -> Model:
    """Potentials from a bounded sample, labelled by the pages' own landmarks; the prior alone if none has any.

    The sample is the ``sample`` different pages of at most ``most`` bytes whose html has the smallest hashes, so neither copies nor
    the order of rows matter.
    """
    usable = pages.select(F.col("html").cast("string").alias("html")).where(F.octet_length("html") <= most)
    hashed = usable.select("html", F.xxhash64("html", F.lit(29)).alias("h"), F.xxhash64("html", F.lit(31)).alias("g"))
    chosen = hashed.select("h", "g").distinct().orderBy("h", "g").limit(sample)
    rows = hashed.join(F.broadcast(chosen), ["h", "g"]).groupBy("h", "g").agg(F.first("html").alias("html")).collect()
    return Model().fit([Page(r.html) for r in sorted(rows, key=lambda r: r.html)])


def extract(pages: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns, text and n_chars of every row; null and empty html give the empty text. Repeated rows stay."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                texts = []
                for html in batch.column("__html").to_pylist():
                    page = Page(html or "")
                    texts.append(page.text(own.content(page)))
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col("html").cast("string").alias("__html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, text string, n_chars long")
