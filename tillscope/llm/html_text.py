"""Main text of web pages by differencing with the page of nearest URL.

A page is cut into lines, one per block. Menus, forms, adverts, comments and the like go
by their elements, roles and classes. Pages are sorted by host and URL path, and each is
paired with the neighbour on its host whose path shares more with its own. The lines of
both are aligned by a longest common subsequence; lines they share belong to the site.
The main text is the subtree that holds the lines which are not shared (``main_part``):
kept whole where nearly all of it is the page's own, without shared lines elsewhere.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import need
from tillscope.sources.lake import stage

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?][^>]*>?|<[a-zA-Z/][^>]*\Z", re.S
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
TELLING = re.compile(r"(?i)class|\bid|role|itemprop|hidden")
RAW = {t: re.compile(rf"(?is)</{t}\s*>|\Z") for t in ("script", "style", "textarea", "title", "noscript", "template", "iframe")}

#: Element, role and class names of HTML and of common page layouts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul option".split()
)
AUTO_CLOSE = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
SCOPE = frozenset("article aside body div footer form header html main nav ol section table td th ul blockquote".split())
CORE = frozenset(("article", "main"))
DROPPED = frozenset(
    "aside audio button canvas datalist dialog footer form head iframe input menu nav noscript object script "
    "select style svg template textarea title video".split()
)
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
DROPPED_NAMES = frozenset(
    "ad ads adsense adslot advert advertisement adverts banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright discussion disqus footer gdpr login masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices overlay pager pagination popup promo promoted promotion recommended related "
    "replies respond sharing share sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
#: Beside a name above these leave it the name of a part of the page; other words, as in has-sidebar, do not.
LAYOUT_NAMES = frozenset(
    "area bar block bottom box col column container footer form group header holder inner item left link links "
    "list main mobile module outer page panel placeholder post posts primary right row secondary section side site slot "
    "top unit wrap wrapper".split()
) | DROPPED_NAMES
_CLOSES_P = BLOCK - {"li", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "body", "html", "head"}


def _named(name: str) -> bool:
    """Whether a class or id names boilerplate: a dropped name, alone or with layout words and numbers."""
    words = [w for w in re.split(r"[^a-z]+", re.sub(r"\d+x\d+", "", name)) if w]
    return not DROPPED_NAMES.isdisjoint(words) and LAYOUT_NAMES.issuperset(words)


def _about(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element's attributes mark it as boilerplate, and as the article. An article's class and id say nothing."""
    drop = core = False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").strip().lower()
        if name == "hidden":
            drop = True
        elif name == "role":
            drop, core = drop or value in DROPPED_ROLES, core or value in ("main", "article")
        elif name == "itemprop":
            core = core or value == "articlebody"
        elif name in ("class", "id") and tag != "article":
            drop = drop or any(map(_named, value.split()))
    return drop, core


class Page:
    """A page's blocks in order and the tree of elements that hold them.

    ``text`` and ``node`` are per block; ``parent``, ``core`` and ``drop`` per element, element 0 being the
    whole page and ``core`` an article's own mark. Blocks dropped by structure are left out by ``kept``.
    """

    def __init__(self):
        self.text, self.node = [], []
        self.parent, self.core, self.drop, self.form = [-1], [False], [False], [False]

    def add(self, parent: int, core: bool, drop: bool, form: bool) -> int:
        for column, value in zip((self.parent, self.core, self.drop, self.form), (parent, core, drop, form)):
            column.append(value)
        return len(self.parent) - 1

    def open_forms(self, at: int) -> None:
        """Forms around an article are frames of the page, not parts of it."""
        while at > 0:
            self.drop[at] = self.drop[at] and not self.form[at]
            at = self.parent[at]

    def gone(self) -> list[bool]:
        """Per element whether it or one around it is dropped."""
        out: list[bool] = []
        for parent, drop in zip(self.parent, self.drop):
            out.append(drop or parent >= 0 and out[parent])
        return out

    def kept(self) -> list[int]:
        """Blocks that are not dropped. A form that holds most of what would be left without forms stays."""
        if any(f and d for f, d in zip(self.form, self.drop)):
            without = Page()
            without.parent, without.drop = self.parent, [d and not f for d, f in zip(self.drop, self.form)]
            out = without.gone()
            chars = [0] * len(out)
            for t, n in zip(self.text, self.node):
                chars[n] += 0 if out[n] else len(t)
            for n in range(len(chars) - 1, 0, -1):
                chars[self.parent[n]] += chars[n]
            self.drop = [d and not (f and 2 * c > chars[0]) for d, f, c in zip(self.drop, self.form, chars)]
        gone = self.gone()
        return [k for k, n in enumerate(self.node) if not gone[n]]


def read_page(page: str) -> Page:
    """Blocks and elements of a page. What a dropped inline element holds is cut out of the block around it."""
    out = Page()
    held: list[str] = []
    stack: list[tuple[str, int, bool, list[str] | None]] = []  # element, node, whether it ends a block, text held around it
    nodes, at, cores = [0], 0, 0

    def flush():
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out.text.append(text)
                out.node.append(nodes[-1])

    def pop_to(k: int):
        nonlocal cores
        while len(stack) > k:
            _, node, ends, around = stack.pop()
            if ends:
                flush()
            if around is not None:
                held[:] = around
            if node:
                nodes.pop()
                cores -= out.core[node]

    while at < len(page):
        m = TAG.search(page, at)
        if m is None:
            held.append(page[at:])
            break
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCK:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop_to(k)
                    break
                if tag not in BLOCK and stack[k][0] in SCOPE:
                    break  # an inline end tag closes nothing outside its block
            continue
        if tag == "br":
            held.append(" ")
            continue
        raw = RAW.get(tag)
        if raw is not None:
            at = raw.search(page, at).end()
            continue
        about = m[3]
        drop, core = _about(tag, about) if about and TELLING.search(about) else (False, False)
        block = tag in BLOCK
        if block:
            ends = AUTO_CLOSE.get(tag, ()) or ({"p"} if tag in _CLOSES_P else ())
            if tag in _CLOSES_P:
                ends = {*ends, "p"}
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    pop_to(k)
                    break
                if stack[k][0] in SCOPE and stack[k][0] not in ends:
                    break
            flush()
        core = core or tag in CORE
        form = tag == "form" and not drop
        drop = drop and tag not in ("html", "body", "main") or tag in DROPPED or tag == "header" and not cores
        if tag in VOID or m[3].endswith("/") and tag in DROPPED:
            continue
        around = None
        if core and not block:
            flush()
        elif drop and not block:
            around, held[:] = held[:], []
        node = 0
        if drop or core or block and tag not in ("html", "body"):
            node = out.add(nodes[-1], core, drop, form)
            nodes.append(node)
            cores += core
            if core:
                out.open_forms(node)
        stack.append((tag, node, block or core, around))
    pop_to(0)
    flush()
    return out


def lines(page: str) -> list[str]:
    """Blocks of a page that structure does not drop, in order."""
    found = read_page(page)
    return [found.text[k] for k in found.kept()]


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row[1:] = np.maximum(row[1:], row[:-1] + (b == x))
        np.maximum.accumulate(row, out=row)
    return row


def common(a: np.ndarray, b: np.ndarray, at: int = 0) -> list[int]:
    """Places in ``a`` of a longest common subsequence, in memory linear in the longer side."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    first = list(range(at, at + head))
    last = list(range(at + len(a) - tail, at + len(a)))
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    if not len(x) or not len(y):
        return first + last
    if len(x) == 1:
        return first + ([at + head] if (y == x[0]).any() else []) + last
    half = len(x) // 2
    split = int(np.argmax(_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]))
    middle = common(x[:half], y[:split], at + head) + common(x[half:], y[split:], at + head + half)
    return first + middle + last


#: The first hash of a page; tests make it collide.
page_key = F.xxhash64


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def shared_lines(own: np.ndarray, other: np.ndarray) -> list[int]:
    """Places of the lines of ``own`` that the other page has too; none if the pages are alike throughout."""
    if not len(own) or not len(other) or np.array_equal(own, other):
        return []
    known = Counter(other.tolist())
    some = np.array([k for k, x in enumerate(own.tolist()) if x in known], np.int64)
    if not len(some):
        return []
    mine = set(own.tolist())
    return some[common(own[some], other[[x in mine for x in other.tolist()]])].tolist()


def pack(found: Page) -> tuple[list[str], bytes]:
    """The blocks that structure leaves, and they and their elements as bytes."""
    kept = found.kept()
    text = [found.text[k] for k in kept]
    parent, core = np.array(found.parent), np.array(found.core)
    used = np.zeros(len(parent), bool)
    for n in {0, *(found.node[k] for k in kept)}:
        while n >= 0 and not used[n]:
            used[n] = True
            n = parent[n]
    name = np.cumsum(used) - 1
    node = name[[found.node[k] for k in kept]] if kept else np.zeros(0)
    up = np.arange(1, used.sum()) - name[parent[used][1:]]  # distance to the element around it
    head = np.array([len(text), used.sum()], np.int32)
    arrays = (head, np.diff(node, prepend=0).astype(np.int32), up.astype(np.int32), core[used].astype(np.uint8))
    return text, b"".join(x.tobytes() for x in arrays) + "\n".join(text).encode("utf-8", "surrogatepass")


def unpack(packed: bytes, shared: list[int]) -> str:
    """The main text of a packed page, given the blocks that its neighbour has too."""
    n, size = np.frombuffer(packed, np.int32, 2)
    if not n:
        return ""
    node = np.cumsum(np.frombuffer(packed, np.int32, n, 8))
    up = np.frombuffer(packed, np.int32, size - 1, 8 + 4 * n)
    core = np.frombuffer(packed, np.uint8, size, 8 + 4 * (n + size - 1)).astype(bool)
    text = packed[8 + 4 * (n + size - 1) + size :].decode("utf-8", "surrogatepass").split("\n")
    own = np.ones(n, bool)
    own[shared] = False
    parent = np.concatenate(([-1], np.arange(1, size) - up)).astype(int)
    return "\n".join(text[k] for k in main_part(np.array([len(t) for t in text]), own, node, parent, core))


#: A subtree with this share of a page's own text is gone into; one with the only article needs ``LIKELY``.
CONCENTRATED, LIKELY = 0.9, 0.5
#: A subtree whose text is the page's own to this share is kept whole, with the sentences that others have too.
OWN = 0.75
#: What a character tells: the page's own inside an article, shared inside an article, own outside.
IN_ARTICLE, SHARED_IN_ARTICLE, OUTSIDE = 4, 1, 1


def main_part(chars: np.ndarray, own: np.ndarray, node: np.ndarray, parent: np.ndarray, core: np.ndarray) -> list[int]:
    """Blocks of the main text: those of the subtree that holds what the neighbour lacks.

    From the whole page it goes into the child that holds nearly all of the page's own text, as long as there
    is one with children of its own. Article elements are evidence: their text weighs more, and an only one
    needs less. An article is kept whole, any other subtree if most of it is the page's own; else
    shared blocks are deleted. Of several articles side by side all are kept.
    """
    if not own.any():
        own = np.ones(len(own), bool)
    size = len(parent)
    inside = core.copy()  # in an article
    for n in range(1, size):
        inside[n] |= inside[parent[n]]
    weight = chars * np.where(inside[node], np.where(own, IN_ARTICLE, SHARED_IN_ARTICLE), np.where(own, OUTSIDE, 0))
    whole = np.bincount(node, weight, size)
    article = np.bincount(node, weight * inside[node], size)
    children: list[list[int]] = [[] for _ in range(size)]
    for n in range(size - 1, 0, -1):
        whole[parent[n]] += whole[n]
        article[parent[n]] += article[n]
        children[parent[n]].append(n)
    at = 0
    while not core[at] and children[at]:
        best = max(children[at], key=lambda n: (whole[n], -n))
        alone = article[best] > 0 and article[best] == article[at]
        if not (children[best] or core[best]) or whole[best] < (LIKELY if alone else CONCENTRATED) * whole[at] or not whole[best]:
            break
        at = best
    under = np.zeros(size, bool)
    under[at] = True
    for n in range(at + 1, size):
        under[n] = under[parent[n]]
    here = under[node]
    if not core[at]:
        if article[at] and article[at] >= LIKELY * whole[at]:
            here = here & inside[node]
        elif not at or chars[here & own].sum() < OWN * chars[here].sum():
            here = here & own
    return np.flatnonzero(here).tolist()


def _neighbours(pages: DataFrame) -> DataFrame:
    """``pages`` (key, twin, host, path, hashes) with the partner's ``other`` hashes; without a partner a row has none.

    Range partitions of the sorted pages are written; neighbours come from a window in
    each, and across the ends from the last and first pages of the partitions, of which
    there are as many as partitions. So a host may have any share of all pages.
    """
    order = ["host", "path", "key", "twin"]
    # Repeated rows lie in one range, so that dropping them needs no further shuffle.
    parts = pages.repartitionByRange(*order).dropDuplicates(order).withColumn("_part", F.spark_partition_id())
    parts = stage(parts, "pages")
    page = F.struct("host", "path", "hashes")
    w = Window.partitionBy("_part").orderBy(*order)
    rank = F.struct(*order)
    ends = parts.groupBy("_part").agg(F.min_by(page, rank).alias("_first"), F.max_by(page, rank).alias("_last"))
    across = Window.orderBy("_part")
    ends = ends.select("_part", F.lag("_last").over(across).alias("_above"), F.lead("_first").over(across).alias("_below"))
    both = parts.select("*", F.lag(page).over(w).alias("_lag"), F.lead(page).over(w).alias("_lead")).join(ends, "_part")
    before, after = F.coalesce("_lag", "_above"), F.coalesce("_lead", "_below")

    def near(side: Column) -> Column:
        # Characters that both paths begin with, -1 for a page of another host.
        @F.pandas_udf("int")
        def shared(a, b):
            import os

            return a.combine(b, lambda x, y: len(os.path.commonprefix([x or "", y or ""])))

        return F.when(side["host"] == F.col("host"), shared(F.col("path"), side["path"])).otherwise(-1)

    marked = both.select("key", "twin", "hashes", before.alias("b"), after.alias("a"), "host", "path")
    marked = marked.withColumn("nb", near(F.col("b"))).withColumn("na", near(F.col("a")))
    other = F.when((F.col("nb") >= F.col("na")) & (F.col("nb") >= 0), F.col("b.hashes")).when(F.col("na") >= 0, F.col("a.hashes"))
    return marked.select("key", "twin", "hashes", other.alias("other"))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per row of ``pages``: identifier, URL, ``text``, ``n_chars``, ``n_shared``.

    Lines are joined by one line feed; white space in a line is one space. ``n_shared``
    counts the lines, dropped ones apart, that the page of nearest URL has too; where it has all,
    they are alike and nothing is deleted. NULL html is empty and has an empty text; pages without
    a host have no partner; rows repeated are one page for the pairing. An empty table gives an
    empty result; other columns are not read.
    """
    need(pages, id_col, url_col, html_col)
    parts = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)"
    url, page = F.col(url_col).cast("string"), F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(url, parts, 1))
    told = [x for c in (id_col, url_col, html_col) for x in (F.col(c), F.col(c).isNull())]
    # Two hashes of different seeds name a page: 128 bits.
    rows = pages.select(
        page_key(*told).alias("key"), F.xxhash64(F.lit("twin"), *told).alias("twin"), F.col(id_col).alias("id"),
        url.alias("url"), F.when(host != "", host).alias("host"), F.regexp_extract(url, parts, 2).alias("path"),
        page.alias("html"),
    )
    kind = rows.schema["id"].dataType.simpleString()

    def read(batches):
        for batch in batches:
            hashes, packed = [], []
            for p in batch["html"]:
                text, whole = pack(read_page(p.as_py()))
                hashes.append([_hash(t) for t in text])
                packed.append(zlib.compress(whole))
            names = ["key", "twin", "id", "url", "host", "path"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), pa.array(hashes, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
                [*names, "hashes", "packed"],
            )

    # Every page is parsed once; its lines travel compressed.
    made = f"key long, twin long, id {kind}, url string, host string, path string, hashes array<long>, packed binary"
    table = stage(rows.mapInArrow(read, made), "lines")

    def align(batches):
        for batch in batches:
            keys, twins, places = [], [], []
            for key, twin, own, other in zip(batch["key"].to_pylist(), batch["twin"].to_pylist(), batch["hashes"], batch["other"]):
                if other.is_valid and (same := shared_lines(own.values.to_numpy(), other.values.to_numpy())):
                    keys.append(key), twins.append(twin), places.append(same)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(twins, pa.int64()), pa.array(places, pa.list_(pa.int32()))],
                ["key", "twin", "shared"],
            )

    light = table.select("key", "twin", "host", "path", "hashes")
    shared = _neighbours(light).mapInArrow(align, "key long, twin long, shared array<int>")

    def whole(batches):
        for batch in batches:
            deleted = [d or [] for d in batch["shared"].to_pylist()]
            texts = [unpack(zlib.decompress(p.as_py()), d) for p, d in zip(batch["packed"], deleted)]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([len(d) for d in deleted], pa.int32())], ["id", "url", "text", "n_chars", "n_shared"],
            )

    return (
        table.select("key", "twin", "id", "url", "packed").join(shared, ["key", "twin"], "left")
        .mapInArrow(whole, f"id {kind}, url string, text string, n_chars long, n_shared int")
        .withColumnsRenamed({"id": id_col, "url": url_col})
    )
