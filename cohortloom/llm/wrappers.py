"""Main text of pages through wrappers: union-free regular expressions inferred for every template of a host.

A page is a stream of block tags and texts, read as a tree.  The trees of all pages of a host with the
same upper elements (a template) are aligned: equal neighbours become a repeated group, what only one
side has becomes an optional group, differing texts become a slot.  Tasks align the pages they read;
what they found is aligned in lots, then by template, and by host for templates of few pages.  The
wrapper tells where the varying text lies and which texts never vary; it is then applied to every page.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterable
from functools import lru_cache, reduce
from hashlib import blake2b
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import held, parts, small_batches

#: Pages of a host with the same elements down to this depth have one template.
TEMPLATE_DEPTH = 3
#: More neighbours of different labels than this, or more nodes in a wrapper, become one repeated group of optional elements.
MOST_KIDS, MOST_NODES = 100, 20_000
#: Templates and nodes that a task holds before it hands its wrappers on; tasks whose wrappers are aligned together.
HELD_TEMPLATES, HELD_NODES, LOT_TASKS = 512, 200_000, 128
#: Longer constant texts stand in a wrapper as a digest of the whole text.
LONG_TEXT = 256
#: Elements nested deeper than this are read as if they stood at this depth.
DEEPEST = 100
#: A text that is the same on so many different pages belongs to the wrapper, where no article is marked.
FIXED_PAGES = 3

# Names of elements, and words of class, id and role attributes.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas", "audio", "video")
CHROME = set("nav header footer aside form menu dialog button select fieldset head".split())
CHROME_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice alert popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended share sharing social "
    "comment comments respond reply replies disqus newsletter subscribe subscription signup login search toolbar pagination pager tags skip".split()
)
MAIN = ("article", "main")
#: Never frame, whatever words they have.
BODY = ("html", "body", *MAIN)
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLOCKS_IN_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

# A quotation mark opens a value only behind an equals sign, and is part of the value where none closes it; nothing is
# matched twice, so a broken page takes time in proportion to its length.
_VALUE = r"""=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>=]++|{_VALUE})*+)(?:>|\Z)", re.S)
_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I | re.A) for name in RAW}
_NAME = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)


class Element:
    __slots__ = ("name", "label", "chrome", "worded", "kids")

    def __init__(self, name: str, attributes: str = ""):
        self.name = name
        words = [w for _, v in _NAME.findall(attributes) for w in re.split(r"[^a-z]+", v.lower()) if w] if attributes else []
        self.label = ".".join([name, *sorted(set(words))])
        named = name in CHROME or name in RAW
        self.worded = not named and name not in BODY and any(w in CHROME_WORDS for w in words)  # frame by its words alone
        self.chrome = named or self.worded
        self.kids: list = []  # elements and texts


def parse(page: str) -> Element:
    """The tree of block elements; inline tags leave no trace, a line break is an empty element."""
    root = Element("page")
    stack, at, size = [root], 0, len(page)

    def text(upto: int) -> None:
        if upto > at:
            stack[-1].kids.append(page[at:upto])

    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            text(size)
            break
        text(found.start())
        at = found.end()
        closing, name = found[1], (found[2] or "").lower()
        if not name:
            continue
        if name in RAW and not closing:
            if found[3].rstrip().endswith("/"):
                continue
            end = _END[name].search(page, at)
            close = page.find(">", end.end()) if end else -1
            at = size if close < 0 else close + 1
            stack[-1].kids.append(Element(name))
            continue
        if name in INLINE and name != "br":
            continue
        if closing:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name), 0)
            if depth:
                del stack[depth:]
            continue
        if name in BLOCKS_IN_P and stack[-1].name == "p":
            stack.pop()
        while len(stack) > 1 and stack[-1].name in CLOSES.get(name, ()):
            stack.pop()
        element = Element(name, found[3])
        stack[-1].kids.append(element)
        if name not in VOID and len(stack) < DEEPEST:
            stack.append(element)
    return root


# ---- inference ------------------------------------------------------------------------------------


class Pattern:
    """A node of a wrapper: its element or text, how often it occurs, and what varies."""

    __slots__ = ("label", "name", "chrome", "kids", "optional", "repeated", "loose", "text", "letters", "pages", "worded", "size")

    def __init__(self, label: str, name: str = "", chrome: bool = False, pages: tuple[int, ...] = (0,)):
        self.label, self.name, self.chrome = label, name, chrome
        self.worded = False
        self.pages = pages  # digests of pages that have it, the FIXED_PAGES smallest
        self.kids: list[Pattern] = []
        self.optional = self.repeated = False
        self.loose = False  # the kids come in any order: a repeated group of optional elements
        self.text: str | None = None  # a constant; None in a text node is a slot
        self.letters = 0
        self.size = 1

    def expression(self) -> str:
        if self.label == "#":
            inner = "#" if self.text is None else re.sub(r"([()#?+<>\\])", r"\\\1", self.text)
        else:
            kids = "".join(k.expression() for k in self.kids)
            inner = f"<{self.label}>" + (f"({kids})+" if self.loose else kids) + f"</{self.name}>"
        return f"({inner})" + ("+" if self.repeated else "") + ("?" if self.optional else "") if self.repeated or self.optional else inner

    def dump(self) -> list:
        flags = sum(bit << k for k, bit in enumerate((self.chrome, self.worded, self.optional, self.repeated, self.loose)))
        return [self.label, self.name, flags, self.text, self.letters, self.pages, [k.dump() for k in self.kids]]


def loaded(dump: list) -> Pattern:
    label, name, flags, text, letters, pages, kids = dump
    out = Pattern(label, name, bool(flags & 1), tuple(pages))
    out.worded, out.optional, out.repeated, out.loose = (bool(flags >> k & 1) for k in range(1, 5))
    out.text, out.letters = text, letters
    return with_kids(out, [loaded(k) for k in kids])


def with_kids(node: Pattern, kids: list[Pattern]) -> Pattern:
    node.kids = kids
    node.size = 1 + sum(k.size for k in kids)
    return node


def clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


def digest(text: str, size: int) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=size).hexdigest()


def constant(words: str) -> str:
    """A text as it stands in a wrapper: a long one as the digest of the whole of it."""
    return words if len(words) <= LONG_TEXT else "\0" + digest(words, 16)


def pattern_of(element: Element, pages: tuple[int, ...] = (0,)) -> Pattern:
    own = Pattern(element.label, element.name, element.chrome, pages)
    own.worded = element.worded
    kids = []
    for kid in element.kids:
        if isinstance(kid, str):
            words = clean(kid)
            if words:
                node = Pattern("#", pages=pages)
                node.text, node.letters = constant(words), len(words)
                kids.append(node)
        else:
            kids.append(pattern_of(kid, pages))
    return ordered(own, folded(kids))


def folded(kids: list[Pattern]) -> list[Pattern]:
    """Equal neighbours as one repeated group."""
    out: list[Pattern] = []
    for kid in kids:
        if out and out[-1].label == kid.label:
            out[-1] = merged(out[-1], kid)
            out[-1].repeated = True
        else:
            out.append(kid)
    return out


def ordered(node: Pattern, kids: list[Pattern], most: int = MOST_KIDS) -> Pattern:
    """The node with these kids, in their order or, where they are too many, in any."""
    if node.loose or len(kids) > most:
        node.loose = True
        kids = any_order(kids)
    return with_kids(node, kids)


def any_order(kids: list[Pattern]) -> list[Pattern]:
    """One optional, repeated kid for each name; names beyond MOST_KIDS share one."""
    out: dict[str, Pattern] = {}
    for kid in kids:
        if kid.label != "#":
            kid.label = kid.name = kid.name if kid.name in out or len(out) < MOST_KIDS else "*"
        out[kid.label] = merged(out[kid.label], kid) if kid.label in out else kid
    for kid in out.values():
        kid.optional = kid.repeated = True
    return [out[label] for label in sorted(out)]


def merged(a: Pattern, b: Pattern) -> Pattern:
    """The least union-free expression of this kind for what either describes."""
    out = Pattern(a.label, a.name, a.chrome or b.chrome, a.pages if a.pages == b.pages else tuple(sorted({*a.pages, *b.pages})[:FIXED_PAGES]))
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    out.letters = a.letters + b.letters
    out.worded = a.worded
    out.loose = a.loose or b.loose
    if a.label == "#":
        out.text = a.text if a.text == b.text else None
        return out
    if out.loose:
        return ordered(out, [*a.kids, *b.kids])
    kids: list[Pattern] = []
    for x, y in aligned(a.kids, b.kids):
        if x and y:
            kids.append(merged(x, y))
        else:
            kids.append(x or y)
            kids[-1].optional = True
    return ordered(out, folded(kids))


def together(a: Pattern, b: Pattern) -> Pattern:
    """Two wrappers as one of at most MOST_NODES nodes, looser where it would be larger."""
    out, most = merged(a, b), MOST_KIDS
    while out.size > MOST_NODES and most > 1:
        most //= 2
        out = loosened(out, most)
    return out


def loosened(node: Pattern, most: int) -> Pattern:
    return ordered(node, [loosened(k, most) for k in node.kids], most)


def aligned(a: list[Pattern], b: list[Pattern]):
    """Pairs of equal labels in order (a longest common subsequence); the rest stands alone."""
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i].label == b[j].label else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and a[i].label == b[j].label:
            yield a[i], b[j]
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            yield a[i], None
            i += 1
        else:
            yield None, b[j]
            j += 1


def framed(node: Element | Pattern, words: bool = True) -> bool:
    """Whether an element belongs to the page's frame, by its name or, with `words`, by its attributes."""
    return node.chrome and (words or not node.worded)


def variable_letters(node: Pattern, words: bool = True) -> int:
    """Letters in slots below a node, without what belongs to the page's frame."""
    if node.label == "#":
        return node.letters if node.text is None else 0
    return 0 if framed(node, words) else sum(variable_letters(k, words) for k in node.kids)


def main_path(wrapper: Pattern) -> list[str]:
    """Labels from the root to the element that holds the article: a marked one, or the deepest with most of the varying text.

    Elements that only their words make frame are entered where four fifths of that text lie in them.
    """
    best: dict[bool, tuple[int, list[str]]] = {False: (-1, []), True: (-1, [])}  # outside and inside such elements
    stack = [(wrapper, [], False)]
    while stack:
        node, path, inside = stack.pop()
        for kid in node.kids:
            if kid.label != "#" and not framed(kid, words=False):
                below = inside or kid.worded
                if kid.name in MAIN and (n := variable_letters(kid)) > best[below][0]:
                    best[below] = (n, [*path, kid.label])
                stack.append((kid, [*path, kid.label], below))
    (outer, marked), (inner_, hidden) = best[False], best[True]
    if hidden and (not marked or inner_ > 0 and 10 * inner_ >= 8 * (inner_ + outer)):
        return hidden
    if marked:
        return marked
    node, path = wrapper, []
    while True:
        strict, whole = (sum(variable_letters(k, w) for k in node.kids) for w in (True, False))
        words = 10 * strict > 2 * whole
        whole = strict if words else whole
        inner = [k for k in node.kids if k.label != "#" and not framed(k, words) and not k.repeated and 10 * variable_letters(k, words) >= 8 * max(1, whole)]
        if not inner:
            return path
        node = inner[0]
        path.append(node.label)


def fixed_texts(node: Pattern) -> list | None:
    """Places of texts that FIXED_PAGES pages have and that never vary, in no repeated group.

    A place is [label, text or null, kids]; kids without such a text stand as labels alone.
    """
    if node.repeated or len(node.pages) < FIXED_PAGES:
        return None
    if node.label == "#":
        return None if node.text is None else ["#", node.text, []]
    kids = [fixed_texts(k) for k in node.kids]
    if not any(kids):
        return None
    return [node.label, None, [k or [own.label, None, []] for k, own in zip(kids, node.kids)]]


def template(root: Element) -> str:
    """The digest of the distinct paths down to TEMPLATE_DEPTH."""
    paths, level = set(), [(root, "")]
    for _ in range(TEMPLATE_DEPTH):
        level = [(k, f"{path}/{k.label}") for e, path in level for k in e.kids if not isinstance(k, str)]
        paths.update(path for _, path in level)
    return digest("\n".join(sorted(paths)), 8)


def page_pattern(page: str) -> tuple[str, Pattern]:
    """The template of a page, and the page as a wrapper of its own."""
    root = parse(page)
    return template(root), pattern_of(root, (int(digest(page, 7), 16),))


def described(wrapper: Pattern) -> tuple[str, list[str], list[str]]:
    """Expression, path to the main element and fixed texts of a wrapper (their places, as one JSON text)."""
    path = main_path(wrapper)
    marked = any(label.split(".")[0] in MAIN for label in path)
    fixed = None if marked else fixed_texts(wrapper)
    return wrapper.expression(), path, [json.dumps(fixed)] if fixed else []


def infer(pages: list[str]) -> tuple[str, list[str], list[str]]:
    """Expression, path to the main element and fixed texts of the pages' one wrapper."""
    if not pages:
        return "", [], []
    return described(reduce(together, (page_pattern(p)[1] for p in sorted(set(pages)))))


class Wrappers:
    """The wrappers of a task's pages by host and template, handed on before they grow large."""

    def __init__(self):
        self.own: dict[tuple[str, str], Pattern] = {}
        self.nodes = 0

    def add(self, host: str, page: str) -> bool:
        """Whether it is time to hand them on."""
        form, one = page_pattern(page)
        before = self.own.get((host, form))
        now = one if before is None else together(before, one)
        self.own[host, form] = now
        self.nodes += now.size - (before.size if before else 0)
        return len(self.own) >= HELD_TEMPLATES or self.nodes >= HELD_NODES

    def take(self) -> Iterable[tuple[str, str, str]]:
        """host, template, wrapper; the template '' stands for the host's pages of all templates."""
        hosts: dict[str, Pattern] = {}
        for (host, form), own in sorted(self.own.items()):
            written = json.dumps(own.dump())
            yield host, form, written
            own = loaded(json.loads(written))
            hosts[host] = together(hosts[host], own) if host in hosts else own
        for host, own in hosts.items():
            yield host, "", json.dumps(own.dump())
        self.own, self.nodes = {}, 0


# ---- extraction -----------------------------------------------------------------------------------


def _along(root: Element, path: list[str]) -> list[Element]:
    level = [root]
    for label in path:
        level = [k for e in level for k in e.kids if not isinstance(k, str) and k.label == label]
    return level if path else []


def _named(root: Element, words: bool = True) -> list[Element]:
    """Outermost article or main elements outside the frame."""
    out, stack = [], [root]
    while stack:
        e = stack.pop()
        for kid in reversed(e.kids):
            if not isinstance(kid, str) and not framed(kid, words):
                stack.append(kid)
        if e.name in MAIN:
            out.append(e)
            for kid in e.kids:
                if not isinstance(kid, str) and not framed(kid, words):
                    stack.remove(kid)
    return out


class Place:
    """A place of fixed texts in a wrapper, or neighbours of one label in a page."""

    __slots__ = ("label", "text", "kids")

    def __init__(self, label: str, text: str | None, kids: list):
        self.label, self.text, self.kids = label, text, kids


@lru_cache(64)
def places(fixed: str) -> Place:
    def place(node: list) -> Place:
        return Place(node[0], node[1], [place(k) for k in node[2]])

    return place(json.loads(fixed))


def without_fixed(root: Element, fixed: Place) -> None:
    """Empties the texts of a page that stand at their places in the wrapper."""
    stack = [(root, fixed)]
    while stack:
        element, place = stack.pop()
        runs: list[Place] = []  # kids: places in element.kids
        for k, kid in enumerate(element.kids):
            if not isinstance(kid, str) or clean(kid):
                label = "#" if isinstance(kid, str) else kid.label
                if runs and runs[-1].label == label:
                    runs[-1].kids.append(k)
                else:
                    runs.append(Place(label, None, [k]))
        same = 0
        while same < min(len(runs), len(place.kids)) and runs[same].label == place.kids[same].label:
            same += 1
        for run, at in [*zip(runs[:same], place.kids[:same]), *aligned(runs[same:], place.kids[same:])]:
            if run and at and len(run.kids) == 1:
                kid = element.kids[run.kids[0]]
                if at.text is not None and constant(clean(kid)) == at.text:
                    element.kids[run.kids[0]] = ""
                elif at.kids:
                    stack.append((kid, at))


def main_text(page: str, path: list[str], fixed: set[str]) -> str:
    """Blocks of the main element in page order; a page the wrapper does not fit is read by its own marks."""
    root = parse(page)
    for wrapper in fixed:
        without_fixed(root, places(wrapper))
    start = _along(root, path)
    if not any(label.split(".")[0] in MAIN for label in path):
        start = _named(root) or start
    start = start or _named(root) or _named(root, words=False)
    for element in start:
        element.chrome = framed(element, words=False)
    blocks = read(start or [root])
    return "\n".join(blocks if blocks or start else read([root], words=False))


def read(start: list[Element], words: bool = True) -> list[str]:
    """Blocks of elements in page order, without the frame."""
    blocks: list[str] = []
    line: list[str] = []

    def end_block() -> None:
        text = clean("".join(line))
        line.clear()
        if text:
            blocks.append(text)

    stack: list = list(reversed(start))
    while stack:
        item = stack.pop()
        if item is None:
            end_block()
        elif isinstance(item, str):
            line.append(item)
        else:
            end_block()
            if not framed(item, words):
                stack.append(None)
                stack.extend(reversed(item.kids))
    end_block()
    return blocks


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").removeprefix("www.")
    except ValueError:
        return ""


def _of_pages(url: str, content: str) -> list:
    return [F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{content}`").cast("string").alias("html")]


def infer_wrappers(pages: DataFrame, url: str = "url", content: str = "html") -> DataFrame:
    """host, template, expression, path, fixed: one wrapper for each template, from all its pages.

    A template of fewer than FIXED_PAGES different pages has the wrapper of all pages of its host.  Pages
    without html say nothing; those without a host share the host ''.  A task reads its pages one after
    the other; the wrappers of LOT_TASKS tasks are aligned first, then those of a template, so the
    pages of a host, however many, never meet in a task.
    """
    slim = pages.select(*_of_pages(url, content)).where("html IS NOT NULL")

    def read_pages(batches):
        held_back = Wrappers()

        def handed_on():
            columns = list(zip(*held_back.take())) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["host", "template", "wrapper"])

        for batch in parts(batches):
            for where, page in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                if held_back.add(host_of(where), page):
                    yield handed_on()
        yield handed_on()

    def one(rows: pd.DataFrame) -> Pattern:
        return reduce(together, (loaded(json.loads(w)) for w in sorted(rows["wrapper"])))

    def lot(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": rows["host"].iloc[:1], "template": rows["template"].iloc[:1], "wrapper": [json.dumps(one(rows).dump())]})

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        wrapper = one(rows)
        expression, path, fixed = described(wrapper)
        enough = len(wrapper.pages) >= FIXED_PAGES
        return pd.DataFrame({"host": rows["host"].iloc[:1], "template": rows["template"].iloc[:1], "enough": [enough], "expression": [expression], "path": [path], "fixed": [fixed]})

    written = "host string, template string, wrapper string"
    read = slim.mapInArrow(read_pages, written).withColumn("lot", F.floor(F.spark_partition_id() / LOT_TASKS))
    lots = read.groupBy("host", "template", "lot").applyInPandas(lot, written)
    found = held(lots.groupBy("host", "template").applyInPandas(whole, "host string, template string, enough boolean, expression string, path array<string>, fixed array<string>"))
    parts_of = ("expression", "path", "fixed")
    hosts = found.where("template = ''").select("host", F.struct(*parts_of).alias("all"))
    own = found.where("template <> ''").select("host", "template", "enough", F.struct(*parts_of).alias("own"))
    return own.join(hosts, "host").select("host", "template", F.expr("IF(enough, own, all)").alias("w")).select("host", "template", "w.*")


def extract(pages: DataFrame, url: str = "url", content: str = "html", carry: list[str] | None = None) -> DataFrame:
    """`row` (the carried columns), text and n_chars of every page.

    Null and empty html have an empty text.  Repeated rows are extracted each, and count as one page
    where different pages are asked for; an empty table gives no rows; long pages are read like any
    other; carried columns may have any name.
    """
    small_batches(pages.sparkSession)
    wrappers = infer_wrappers(pages, url, content)
    kept = F.struct(*[F.col(f"`{c}`") for c in (pages.columns if carry is None else carry)])
    slim = pages.select(kept.alias("row"), *_of_pages(url, content))
    row = slim.schema["row"]
    placed = T.StructType([row, *(T.StructField(name, T.StringType()) for name in ("host", "template", "html"))])
    schema = T.StructType([row, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def place(batches):
        for batch in parts(batches):
            hosts = [host_of(u) for u in batch.column(1).to_pylist()]
            forms = [None if h is None else template(parse(h)) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hosts, pa.string()), pa.array(forms, pa.string()), batch.column(2)], names=placed.names)

    def run(batches):
        for batch in parts(batches):
            texts = [main_text(h or "", p or [], set(f or ())) for h, p, f in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names)

    joined = slim.mapInArrow(place, placed).join(wrappers.select("host", "template", "path", "fixed"), ["host", "template"], "left")
    return joined.select("row", "html", "path", "fixed").mapInArrow(run, schema)


def main_texts(pages: DataFrame) -> DataFrame:
    return extract(pages, carry=["page_id", "url"]).select("row.page_id", "row.url", "text", "n_chars")
